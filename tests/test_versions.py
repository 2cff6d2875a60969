"""Versioned tables: readers during and after writes, killed writers, upserts that touch few buckets; last attempts by a stream."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from loomstone.operators import state
from loomstone.sources import sinks, store
from loomstone.sources.versions import KEPT, VersionedTable, WriteConflict
from loomstone.streaming import attempts


def ids(df):
    return sorted(r[0] for r in df.collect())


def test_readers_see_the_old_or_the_new_table(spark, tmp_path, monkeypatch):
    table = VersionedTable(spark, str(tmp_path / "t"))
    assert table.read() is None and table.version() == 0
    table.replace(spark.range(3))
    before = table.read()  # resolved before the write, read after it
    seen = []
    for step in ("_written", "_publish"):
        true = getattr(VersionedTable, step)
        monkeypatch.setattr(VersionedTable, step, lambda self, x, true=true: (seen.append(ids(table.read())), true(self, x))[1])
    table.replace(spark.range(5))
    assert seen == [[0, 1, 2]] * 2 and ids(before) == [0, 1, 2] and ids(table.read()) == [0, 1, 2, 3, 4] and ids(table.read(1)) == [0, 1, 2]


def test_a_replaced_table_is_written_where_its_rows_are(spark, tmp_path):
    """No exchange of all rows towards their one part: each task's rows are a file."""
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(0, 100_000, 1, 5))
    assert len(table.read().inputFiles()) == 5 and table.read().count() == 100_000 and table.read().columns == ["id"]
    table.replace(spark.range(0))
    assert table.read().count() == 0 and table.read().columns == ["id"]


@pytest.mark.parametrize("dies_in", ["_written", "_publish", "create", "pointer"])
def test_a_killed_writer_changes_nothing(spark, tmp_path, monkeypatch, dies_in):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.replace(spark.range(3))

    def dead(*_):
        raise KeyboardInterrupt

    with monkeypatch.context() as m:
        if dies_in in ("create", "pointer"):
            m.setattr(store, "create_document" if dies_in == "create" else "write_document", dead)
        else:
            m.setattr(VersionedTable, dies_in, dead)
        with pytest.raises(KeyboardInterrupt):
            table.replace(spark.range(5))
    assert ids(table.read()) == [0, 1, 2] and table.version() == 1
    whole = dies_in == "pointer"  # its version was described: whoever comes next finishes it
    table.replace(spark.range(7))
    assert ids(table.read()) == list(range(7)) and table.version() == 2 + whole and len(store.children(spark, str(tmp_path / "t" / "_data"))) == 2 + whole
    assert not whole or ids(table.read(2)) == [0, 1, 2, 3, 4]
    assert not table.recover()


def test_two_writers_of_one_version(spark, tmp_path, monkeypatch):
    """Another upsert gets in between the reading and the writing of one: the second fails, and done again keeps both."""
    table, rows = VersionedTable(spark, str(tmp_path / "t")), lambda *x: spark.createDataFrame([(i, "x") for i in x], "id long, text string")
    table.upsert(rows(1), "id", buckets=2)
    true = VersionedTable._written

    def late(self, df):
        monkeypatch.setattr(VersionedTable, "_written", true)
        VersionedTable(spark, table.path).upsert(rows(2), "id")
        return true(self, df)

    monkeypatch.setattr(VersionedTable, "_written", late)
    with pytest.raises(WriteConflict):
        table.upsert(rows(3), "id")
    assert ids(table.read().select("id")) == [1, 2]
    table.upsert(rows(3), "id")
    assert ids(table.read().select("id")) == [1, 2, 3]


def test_versions_that_stay(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    for n in range(1, 7):
        assert table.replace(spark.range(n)) == n
    assert [ids(table.read(n)) for n in (4, 5, 6)] == [list(range(n)) for n in (4, 5, 6)]
    with pytest.raises(ValueError, match="no version"):
        table.read(3)
    assert len(store.children(spark, str(tmp_path / "t" / "_data"))) == KEPT
    table.replace(spark.range(0))
    assert table.read().columns == ["id"] and table.read().count() == 0


def test_upserts_against_a_dictionary(spark, tmp_path):
    rng, table, want = random.Random(2), VersionedTable(spark, str(tmp_path / "t")), {}
    for k in range(4):
        new = {rng.choice([None, *range(50)]): f"{k}-{p}" for p in range(12)}
        want |= new
        table.upsert(spark.createDataFrame(list(new.items()), "id long, text string"), "id", buckets=8)
        assert {r["id"]: r["text"] for r in table.read().collect()} == want and table.read().count() == len(want)
    n = table.version()
    assert table.upsert(spark.createDataFrame([], "id long, text string"), "id") == n
    with pytest.raises(ValueError, match="not kept by"):
        table.upsert(spark.range(1), "other")


def test_upserts_leave_other_buckets_alone(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    table.upsert(spark.range(2000).selectExpr("id", "'a' AS text"), "id", buckets=32)
    before = set(table.read().inputFiles())
    table.upsert(spark.createDataFrame([(7, "b")], "id long, text string"), "id")
    after = set(table.read().inputFiles())
    assert len(before - after) <= 2 and len(before & after) >= 30 and table.read().where("text = 'b'").count() == 1 and table.read().count() == 2000


def test_tables_of_any_kind(spark, tmp_path):
    sinks.refresh(spark.range(2), str(tmp_path / "v"))
    sinks.append_new(spark.range(3), str(tmp_path / "k"), "id")
    sinks.append_attempts(spark.range(4), str(tmp_path / "p"))
    assert [sinks.read_table(spark, str(tmp_path / x)).count() for x in "vkp"] == [2, 3, 4] and sinks.read_table(spark, str(tmp_path / "none")) is None
    assert sinks.read_table(spark, str(tmp_path / "k")).columns == ["id"]


ATTEMPTS = "unit long, at long, place int, status string"


def test_last_attempts_by_a_stream(spark, tmp_path):
    """Three batches, each a run of its own from the same checkpoint; late attempts and repeated files among them."""
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(40)]), rng.randrange(30), k, rng.choice(["success", "crash", None])) for k in range(300)]
    rows += [(100, 1, 900, "success"), (100, 2, 901, "crash"), (101, 2, 902, "success"), (101, 1, 903, "crash")]
    rng.shuffle(rows)
    table, seen = VersionedTable(spark, str(tmp_path / "t")), []
    for k in range(3):
        spark.createDataFrame(rows[k::3], ATTEMPTS).write.parquet(str(tmp_path / "in" / str(k)))
        stream = spark.readStream.schema(ATTEMPTS).parquet(str(tmp_path / "in" / "*"))
        attempts.keep_latest(stream, table.path, str(tmp_path / "c"), "unit", ["at", "place"], "status", buckets=4).awaitTermination()
        have = spark.createDataFrame([r for j in range(k + 1) for r in rows[j::3]], ATTEMPTS)
        want = state.latest_attempts(have, "unit", F.struct("at", "place"), "status")
        assert sorted(map(str, table.read().collect())) == sorted(map(str, want.collect()))
        seen.append(table.version())
    assert seen == [1, 2, 3]  # one batch each: a restart reads nothing again
    told = {r["unit"]: r["status"] for r in table.read().collect()}
    assert told[100] == "crash" and told[101] == "success"
    attempts.keep_latest(stream, table.path, str(tmp_path / "c"), "unit", ["at", "place"], "status").awaitTermination()
    assert table.version() == 3
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")
    assert any("RocksDB" in p.read_text(errors="ignore") for p in (tmp_path / "c" / "offsets").iterdir() if p.name.isdigit())


def test_a_batch_that_runs_again_after_a_failure(spark, tmp_path, monkeypatch):
    spark.createDataFrame([(1, 1, 0, "success"), (2, 1, 0, "crash")], ATTEMPTS).write.parquet(str(tmp_path / "in" / "0"))
    stream = spark.readStream.schema(ATTEMPTS).parquet(str(tmp_path / "in" / "*"))
    table = VersionedTable(spark, str(tmp_path / "t"))
    start = lambda: attempts.keep_latest(stream, table.path, str(tmp_path / "c"), "unit", ["at", "place"], "status").awaitTermination()
    true = VersionedTable.upsert

    def dies(self, *args):
        true(self, *args)
        raise OSError("after the write, before the batch is done")

    with monkeypatch.context() as m:
        m.setattr(VersionedTable, "upsert", dies)
        with pytest.raises(Exception, match="before the batch is done"):
            start()
    start()
    assert {(r["unit"], r["attempts"], r["status"]) for r in table.read().collect()} == {(1, 1, "success"), (2, 1, "crash")}
