"""The keyed table: each id once, only the needed files opened, nothing lost by failures."""

from __future__ import annotations

import random

import pytest

from loomstone.sources import hosting, keyed, sinks, store
from loomstone.sources.keyed import BUCKET, KeyedTable
from loomstone.streaming import channels

SCHEMA = "record_id long, text string"


def rows_of(table):
    return sorted((r["record_id"], r["text"]) for r in table.read().collect())


def opened(table, spark, ids):
    """The files of the table that a batch of these ids reads."""
    batch = spark.createDataFrame([(i, "x") for i in ids], SCHEMA)
    found = table.to_open(batch.withColumn(BUCKET, table.bucket()))
    return [] if found is None else found.inputFiles()


def test_each_id_once_against_a_set(spark, tmp_path):
    rng, table, want = random.Random(1), KeyedTable.at(spark, str(tmp_path / "t"), "record_id", buckets=8, blocks=2), {}
    assert table.read() is None
    for k in range(4):
        batch = [(rng.choice([None, *range(60)]), f"{k}-{p}", p) for p in range(50)]
        for i, text, _ in batch:
            if i is not None:
                want.setdefault(i, text)
        df = spark.createDataFrame(batch, f"{SCHEMA}, place int").repartition(3)
        table.append_new(df, "place", forget=True)
        assert rows_of(table) == sorted(want.items())
    table.append_new(df, "place", forget=True)  # the same batch again
    assert rows_of(table) == sorted(want.items()) and table.read().columns == ["record_id", "text"]


def test_a_batch_opens_only_the_buckets_it_touches(spark, tmp_path):
    table = KeyedTable.at(spark, str(tmp_path / "t"), "record_id", buckets=32, blocks=2)
    for k in range(3):
        table.append_new(spark.range(k * 3000, k * 3000 + 3000).selectExpr("id AS record_id", "'x' AS text"))
    files = table.read().inputFiles()
    assert len(files) >= 3 * 32
    assert opened(table, spark, range(10**9, 10**9 + 3)) == []  # new ids open nothing
    one = opened(table, spark, [17])
    assert 0 < len(one) <= 3 and len({f.split(f"{BUCKET}=")[1].split("/")[0] for f in one}) == 1
    few = opened(table, spark, [5, 4000, 8000, 10**9 + 1])
    assert len(few) <= 9 + 3
    wrong = sum(bool(opened(table, spark, [10**9 + k])) for k in range(8))
    assert wrong <= 1  # filters that are sharp seldom send a new id to the table
    held = table.to_open(spark.createDataFrame([(17, "x")], SCHEMA).withColumn(BUCKET, table.bucket()))
    assert "PushedFilters" in held._jdf.queryExecution().toString() and [r["record_id"] for r in held.collect()] == [17]


def test_filters_know_all_ids_and_few_others(spark, tmp_path):
    table = KeyedTable.at(spark, str(tmp_path / "t"), "record_id", buckets=4, blocks=2)
    n = table.ids_expected() // 2
    table.append_new(spark.range(n).selectExpr("id AS record_id", "'x' AS text"))
    asked = spark.range(n - 500, n + 4000).selectExpr("id AS record_id", "'y' AS text").withColumn(BUCKET, table.bucket())
    found = {r["record_id"] for r in table._perhaps_known(asked, list(range(4))).collect()}
    assert set(range(n - 500, n)) <= found and len(found) - 500 < 80


def test_a_failure_between_filters_and_rows_loses_nothing(spark, tmp_path, monkeypatch):
    table, batch = KeyedTable.at(spark, str(tmp_path / "t"), "record_id", buckets=4), spark.createDataFrame([(k, "a") for k in range(20)], SCHEMA)
    table.append_new(batch.where("record_id < 5"))
    put = KeyedTable._put

    def broken(rows, folder, *within):
        if not folder.endswith("/_filters"):
            raise OSError("the store is gone")
        put(rows, folder, *within)

    monkeypatch.setattr(KeyedTable, "_put", staticmethod(broken))
    with pytest.raises(OSError):
        table.append_new(batch)
    monkeypatch.setattr(KeyedTable, "_put", staticmethod(put))
    assert len(rows_of(table)) == 5
    table.append_new(batch)
    assert [i for i, _ in rows_of(table)] == list(range(20))


def test_text_ids_compaction_and_settings(spark, tmp_path):
    table = KeyedTable.at(spark, str(tmp_path / "t"), "sha", buckets=3, blocks=1)
    for ids in (["a", "", "é"], ["b", "a"], ["c"]):
        table.append_new(spark.createDataFrame([(i, i) for i in ids], "sha string, text string"))
    again = KeyedTable.at(spark, str(tmp_path / "t"), "sha", buckets=99)
    assert (again.buckets, again.blocks) == (3, 1)  # the table's own hold
    small = table.compact(str(tmp_path / "small"))
    assert sorted(r[0] for r in small.read().select("sha").collect()) == ["", "a", "b", "c", "é"]
    assert len(small.read().inputFiles()) <= 3 < len(table.read().inputFiles())
    small.append_new(spark.createDataFrame([("a", "later"), ("d", "d")], "sha string, text string"))
    assert {r["sha"]: r["text"] for r in small.read().collect()} == {"": "", "a": "a", "b": "b", "c": "c", "d": "d", "é": "é"}
    with pytest.raises(ValueError, match="keyed by sha"):
        KeyedTable.at(spark, str(tmp_path / "t"), "other")
    spark.range(2).write.parquet(str(tmp_path / "plain"))
    with pytest.raises(ValueError, match="no keyed table"):
        KeyedTable.at(spark, str(tmp_path / "plain"), "id")
    with pytest.raises(ValueError, match="own column"):
        table.append_new(spark.createDataFrame([("a", 1)], f"sha string, {BUCKET} int"))
    table.append_new(spark.createDataFrame([], "sha string, text string"))
    assert table.read().count() == 5 and keyed.BITS % 8 == 0


def test_the_first_page_and_place_count(spark, tmp_path):
    spark.dataSource.register(hosting.PagedSource)
    stream = spark.readStream.format("paged").option("fetch", "recorded_pages:fetch").option("channel", "comments").option("pages", "2").load()
    query = channels.insert_only(stream, str(tmp_path / "t"), str(tmp_path / "c"), normalise=hosting.comments, order=hosting.DELIVERED)
    query.awaitTermination()
    found = KeyedTable.at(spark, str(tmp_path / "t"), "record_id").read()
    assert {r["record_id"]: r["text"] for r in found.collect()}[2] == "b" and "page" not in found.columns
    raw = spark.createDataFrame([('{"id": 9, "body": "second"}', 2, 0), ('{"id": 9, "body": "first"}', 1, 7), ('{"id": 9, "body": "later"}', 1, 8)], "raw string, page int, place int").repartition(3)
    sinks.append_new(hosting.comments(raw), str(tmp_path / "u"), "record_id", *hosting.DELIVERED)
    assert [(r["text"], r["page"], r["place"]) for r in spark.read.parquet(str(tmp_path / "u")).collect()] == [("first", 1, 7)]


def test_documents(spark, tmp_path):
    path = str(tmp_path / "d" / "x.json")
    assert store.read_document(spark, path) is None and store.children(spark, str(tmp_path / "d")) == []
    store.write_document(spark, path, {"a": 1})
    store.write_document(spark, path, {"a": "é"})
    assert store.read_document(spark, path) == {"a": "é"} and store.children(spark, str(tmp_path / "d")) == ["x.json"]
    store.delete(spark, path)
    assert not store.exists(spark, path)
