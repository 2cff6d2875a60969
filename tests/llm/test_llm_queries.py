from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", [n for n in entry.oracle_sql() if n.startswith("op")])
def test_same_as_sql(spark, name):
    db = duckdb.connect()
    for t in ("documents", "benchmark", "pages", "labels"):
        db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = entry.queries()[name](spark, SF)
    found = db.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    assert sorted(columns) == sorted(df.columns)
    rows = sorted(map(str, (tuple(r[c] for c in columns) for r in df.collect())))
    assert rows == sorted(map(str, found.fetchall()))


def test_pipeline(spark):
    import corpus_pipeline
    from loomstone.llm import edit_join, kneser_ney, positional_index, simhash_vptree
    from loomstone.llm.common import docs_of

    docs = docs_of(spark, SF)
    ids = lambda df: {r[0] for r in df.select("doc_id").collect()}
    rejected = ids(kneser_ney.classify(docs, docs_of(spark, SF, "labels")).where("NOT kept"))
    left, held = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, SF)
        assert left.columns == docs.columns, name
        held.append(ids(left))
    assert held[0] == ids(docs) - rejected and held[1] == held[0] and held[3] <= held[2] <= held[1]
    lines = edit_join.deduplicated(docs.where(~docs.doc_id.isin(*rejected)))
    groups = simhash_vptree.near_duplicates(lines, **simhash_vptree.SIMILAR).where("doc_id = component_id")
    assert held[2] == ids(groups)
    found = positional_index.search(positional_index.build_index(lines.join(groups.select("doc_id"), "doc_id")), docs_of(spark, SF, "benchmark"))
    assert held[3] == ids(found.where("n_hit = 0"))
    last = corpus_pipeline.run(spark, SF)
    assert ids(last) == held[3] and last.where("size(ids) <> n_tokens").count() == 0


COLUMNS = {
    "op1_robust_outliers": "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean",
    "op2_bpe_lexicon": "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    "op3_kneser_ney": "doc_id bigint, perplexity double, kept boolean",
    "op4_html_crf": "page_id bigint, url string, text string, n_chars bigint",
    "op5_pii_crf": "doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, base_sha256 string, spans string, n_spans bigint",
    "op6_sentence_spans": "doc_id bigint, text string, n_sentences bigint, n_removed bigint",
    "op7_simhash_vptree": "doc_id bigint, fingerprint string, component_id bigint",
    "op8_url_filter": "page_id bigint, host string, path string, rule string, verdict string",
    "op9_edit_join": "doc_id bigint, text string, n_lines bigint, n_removed bigint",
    "op10_positional_decontamination": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, n_near bigint, near_sha256 string",
}


@pytest.mark.parametrize("name", COLUMNS)
def test_columns_and_rows(spark, name):
    df = entry.queries()[name](spark, SF)
    kinds = dict(df.dtypes)
    assert {c: kinds.get(c) for c in (x.split()[0] for x in COLUMNS[name].split(", "))} == dict(x.split() for x in COLUMNS[name].split(", "))
    table, key = ("pages", "page_id") if "page_id" in COLUMNS[name] else ("documents", "doc_id")
    want = spark.read.parquet(f"{SF}/{table}.parquet").select(key)
    assert sorted(r[0] for r in df.select(key).collect()) == sorted(r[0] for r in want.collect())


@pytest.mark.parametrize("empty", [False, True])
def test_pipeline_of_odd_rows(spark, tmp_path, empty):
    """Nulls, empty and very long texts, repeated rows, rows of one id, columns named like the stages' own, an empty table."""
    import corpus_pipeline

    text = [" ".join(f"{a}{k} word{k % 7}" for k in range(60)) for a in "abcdef"]
    rows = [(1, text[0]), (1, text[0]), (1, text[1]), (None, text[2]), (None, text[3]), (None, None), (2, None), (3, ""), (4, " \n "), (5, "x" * 400_000), (6, text[4] + "\n" + text[5]), (7, "plain words " + "of the item that is in the benchmark here now"), (8, text[0])]
    schema = "doc_id long, text string, lang string, source string, n_chars long, __id int, h long, block int, bucket int, grams int, root int, node int, own int, __removed int"
    docs = spark.createDataFrame([] if empty else [(d, t, "en" if k % 3 else None, "s", len(t or ""), *range(9)) for k, (d, t) in enumerate(rows)], schema)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([] if empty else [(1, 1, 0), (6, 1, 0), (None, 1, 0), (3, None, None)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([] if empty else [("i", "of the item that is in the benchmark here now"), ("n", None)], "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, left, str(tmp_path)).write.parquet(path)
        left = spark.read.parquet(path)
        assert left.columns == docs.columns and left.schema["n_chars"].dataType == docs.schema["n_chars"].dataType, name
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    kept = [(r["doc_id"], r["text"]) for r in left.collect()]
    assert len(found) == len(kept) and all(len(r["ids"]) == r["n_tokens"] for r in found)
    if not empty:
        assert not any(t and "benchmark here now" in t for _, t in kept) and len(set(kept)) == len(kept)
        assert (5, "x" * 400_000) in kept or not any(d == 5 for d, _ in kept)
