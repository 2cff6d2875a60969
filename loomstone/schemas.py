"""Schemas of the exchanged tables, as DDL. Time is epoch seconds in UTC; structural metrics are strings as landed."""

from __future__ import annotations

LINEAGE = "sha string, parent_shas array<string>, timestamp string"
METHODS = "array<struct<name:string,long_name:string>>"
LEDGER = f"sha string, timestamp bigint, author_name string, author_email string, modifications array<struct<file:string,old_file:string,lines_added:int,lines_deleted:int,change_type:string,changed_methods:{METHODS}>>"
LOCATION = "struct<filePath:string,startLine:int,endLine:int>"
REFACTORING = f"struct<type:string,description:string,leftSideLocations:array<{LOCATION}>,rightSideLocations:array<{LOCATION}>>"
REFACTORINGS = f"repository string, sha1 string, timestamp bigint, refactorings array<{REFACTORING}>"
FILE_DIFF = "struct<file:string,added:array<string>,removed:array<string>,n_added:int,n_removed:int>"
DIFFS = f"repository string, sha1 string, timestamp bigint, message string, files array<{FILE_DIFF}>, n_files int, n_files_total int, truncated boolean, is_merge boolean, n_parents int, status string"
STRUCTURE = "sha string, timestamp bigint, status string, n_classes int, n_methods int, csv_source string, scope string, ck_jar string, ck_jar_sha256 string, n_removed int, report array<map<string,string>>"
UNIFIED = "record_id bigint, channel string, timestamp bigint, author string, text string, labels array<string>, file_path string, parent_id bigint, parent_channel string"
COMMITS = UNIFIED.replace("record_id bigint", "record_id string") + ", author_email string"
ISSUES = UNIFIED + ", closed_at bigint"
PULLS = UNIFIED + ", closed_at bigint, merged_at bigint, merge_commit_sha string"
REVIEWS = UNIFIED + ", diff_line int, commit_sha string"
COMMENTS = UNIFIED
UNIVERSE = "repo string, head_sha string, head_commits int, near_mainline_shas array<string>"
GRID = "repo string, head_sha string, entries array<struct<tag:string,snapshot_sha:string,sha:string>>, versions array<string>"
CHANNEL_STATE = "repo string, platform string, channel string, processed_ids array<string>, last_page_done int, next_url string, window_since string, is_complete boolean, rate_limit_reset bigint, records_written int"
VIOLATIONS = "sha string, status string, violations array<struct<filename:string,violations:array<struct<rule:string,priority:int,beginline:int,endline:int,description:string,metric_value:double>>>>"
