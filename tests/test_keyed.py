"""Bucketed keyed tables: upserts, merges, compaction, writers that overtake each other."""

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from cabtally.functions.trips import content_id
from cabtally.operators.reports import identified
from cabtally.sources import keyed
from cabtally.sources.keyed import KeyedTable, delete, insert, update
from cabtally.sources.storage import Storage

SCHEMA = "k int, v string, n bigint"


@pytest.fixture
def table(spark, folder):
    return KeyedTable(spark, f"{folder}/t", SCHEMA, ["k"], buckets=4)


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def content(table):
    return sorted((tuple(r) for r in table.read().collect()), key=str)


def files_of(spark, table):
    """Files of each bucket, by segment."""
    storage, root = Storage(spark, table._path), f"{table._path}/segments"
    return {
        (segment, bucket): sorted(storage.names(f"{root}/{segment}/{bucket}"))
        for segment in storage.names(root)
        for bucket in storage.names(f"{root}/{segment}")
        if bucket.startswith("_bucket")
    }


def test_last_row_of_a_key_counts(spark, table):
    assert content(table) == []
    table.upsert(frame(spark, [(1, "a", 1), (2, "b", 2), (3, None, None)]))
    table.upsert(frame(spark, [(2, None, 20), (4, "d", 4)]))
    table.upsert(frame(spark, [(2, "again", 21)]))
    assert content(table) == sorted([(1, "a", 1), (2, "again", 21), (3, None, None), (4, "d", 4)], key=str)


def test_an_upsert_writes_touched_buckets_only(spark, table):
    table.upsert(spark.range(1000).selectExpr("cast(id AS int) AS k", "'x' AS v", "id AS n"))
    before = files_of(spark, table)
    assert len(before) == 4
    table.upsert(frame(spark, [(7, "y", 0)]))
    after = files_of(spark, table)
    assert {k: after[k] for k in before} == before
    assert len(after) == 5
    (segment, bucket), = set(after) - set(before)
    assert table.manifest().buckets[bucket.partition("=")[2]][-1] == segment
    assert table.read().count() == 1000 and table.read().where("v = 'y'").count() == 1


def test_a_batch_counts_once(spark, table):
    assert table.upsert(frame(spark, [(1, "a", 1)]), "s", 0)
    assert table.upsert(frame(spark, [(1, "b", 1)]), "s", 1)
    assert not table.upsert(frame(spark, [(1, "a", 1)]), "s", 0)
    assert not table.merge(frame(spark, [(1, "c", 1)]), [update({"v": "s.v"})], "s", 1)
    assert content(table) == [(1, "b", 1)]


def test_repeated_and_null_keys_are_refused(spark, table):
    with pytest.raises(Exception, match="two rows of the key"):
        table.upsert(frame(spark, [(1, "a", 1), (1, "b", 2)]))
    with pytest.raises(Exception, match="a key is null"):
        table.upsert(frame(spark, [(None, "a", 1)]))
    with pytest.raises(Exception, match="two changes of the key"):
        table.merge(frame(spark, [(1, "a", 1), (1, "a", 1)]), [insert()])
    assert content(table) == []
    table.upsert(frame(spark, [(1, "a", 1), (1, "b", 2)]), order=F.col("n"))
    assert content(table) == [(1, "b", 2)]


def test_merge_takes_the_first_action_that_holds(spark, table):
    table.upsert(frame(spark, [(k, "old", k) for k in range(6)]))
    changes = spark.createDataFrame([(k, k * 10) for k in (1, 2, 3, 8, 9)], "k int, plus int")
    table.merge(
        changes,
        [
            delete(F.expr("s.plus = 10")),
            update({"n": "t.n + s.plus"}, F.expr("t.n < 3")),
            insert({"v": F.lit("new"), "n": "s.plus"}, F.expr("s.k <> 9")),
        ],
    )
    want = [(0, "old", 0), (2, "old", 22), (3, "old", 3), (4, "old", 4), (5, "old", 5), (8, "new", 80)]
    assert content(table) == want
    table.merge(frame(spark, [(1, "back", 1)]), [insert()])  # a key that was deleted is new
    assert (1, "back", 1) in content(table)
    with pytest.raises(ValueError, match="cannot be set"):
        table.merge(changes, [update({"k": "s.k"})])


def test_merge_reads_and_writes_touched_buckets_only(spark, table):
    table.upsert(spark.range(1000).selectExpr("cast(id AS int) AS k", "'x' AS v", "id AS n"))
    before = table.manifest().buckets
    table.merge(frame(spark, [(7, "y", 0)]), [update({"v": "s.v"})])
    changed = [b for b, own in table.manifest().buckets.items() if own != before[b]]
    assert len(changed) == 1 and content(table).count((7, "y", 7)) == 1


def test_compaction_keeps_rows_and_what_has_come_since(spark, table, monkeypatch):
    for i in range(5):
        table.upsert(frame(spark, [(k, f"v{i}", i) for k in range(i, 20)]))
    table.merge(frame(spark, [(19, "", 0)]), [delete()])
    rows = content(table)
    write = KeyedTable._write

    def overtaken(self, new):
        segment = write(self, new)
        monkeypatch.setattr(KeyedTable, "_write", write)
        KeyedTable(spark, table._path, SCHEMA, ["k"]).upsert(frame(spark, [(3, "since", 9)]))
        return segment

    monkeypatch.setattr(KeyedTable, "_write", overtaken)
    assert table.compact(most=2) == 4
    assert sorted(map(len, table.manifest().buckets.values())) == [1, 1, 1, 2]
    assert content(table) == sorted([*(r for r in rows if r[0] != 3), (3, "since", 9)], key=str)
    assert table.compact(most=2) == 0


def test_a_merge_that_is_overtaken_is_worked_out_again(spark, table, monkeypatch):
    table.upsert(frame(spark, [(1, "a", 1), (2, "b", 2)]))
    write = KeyedTable._write

    def overtaken(self, new):
        segment = write(self, new)
        monkeypatch.setattr(KeyedTable, "_write", write)
        KeyedTable(spark, table._path, SCHEMA, ["k"]).upsert(frame(spark, [(1, "other", 100)]))
        return segment

    monkeypatch.setattr(KeyedTable, "_write", overtaken)
    table.merge(frame(spark, [(1, "", 5)]), [update({"n": "t.n + s.n"})])
    assert content(table) == [(1, "other", 105), (2, "b", 2)]


def test_writers_side_by_side_lose_nothing(spark, table):
    table.upsert(frame(spark, [(0, "sum", 0)]))

    def add(i):
        own = KeyedTable(spark, table._path, SCHEMA, ["k"])
        own.upsert(frame(spark, [(i, "own", i)]))
        own.merge(frame(spark, [(0, "", 1)]), [update({"n": "t.n + s.n"})])

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(add, range(1, 5)))
    assert content(table) == [(0, "sum", 4), *[(i, "own", i) for i in range(1, 5)]]


def test_old_versions_and_segments_are_dropped(spark, table, monkeypatch):
    monkeypatch.setattr(keyed, "KEPT_MANIFESTS", 3)
    for i in range(8):
        table.upsert(frame(spark, [(k, f"v{i}", i) for k in range(8)]))
        table.compact(most=1)
    storage = Storage(spark, table._path)
    assert len(storage.names(f"{table._path}/_commits")) <= 4
    assert len(storage.names(f"{table._path}/segments")) <= 8
    assert content(table) == [(k, "v7", 7) for k in range(8)]


def test_a_segment_that_may_have_been_dropped_is_written_again(spark, table, monkeypatch):
    monkeypatch.setattr(keyed, "KEPT_MANIFESTS", 2)
    table.upsert(frame(spark, [(1, "a", 1)]))
    write = KeyedTable._write

    def overtaken(self, new):
        segment = write(self, new)
        monkeypatch.setattr(KeyedTable, "_write", write)
        for i in range(6):
            KeyedTable(spark, table._path, SCHEMA, ["k"]).upsert(frame(spark, [(5, "x", i)]))
            table.compact(most=1)
        return segment

    monkeypatch.setattr(KeyedTable, "_write", overtaken)
    table.upsert(frame(spark, [(2, "late", 2)]))
    assert content(table) == [(1, "a", 1), (2, "late", 2), (5, "x", 5)]


def test_keys_of_several_columns_and_times(spark, folder):
    schema = "a string, t timestamp_ntz, n int"
    table = KeyedTable(spark, f"{folder}/two", schema, ["a", "t"])
    rows = spark.sql("SELECT 'x' AS a, TIMESTAMP_NTZ '2024-01-01 00:00:00' AS t, 1 AS n UNION ALL SELECT 'x', TIMESTAMP_NTZ '2024-01-02 00:00:00', 2")
    table.upsert(rows)
    table.upsert(rows.withColumn("n", F.col("n") + 10))
    assert sorted(r.n for r in table.read().collect()) == [11, 12]
    with pytest.raises(ValueError, match="keys"):
        KeyedTable(spark, f"{folder}/none", schema, ["b"])


def test_ids_do_not_depend_on_run_or_partitions(spark):
    rows = frame(spark, [(1, "a", 1), (1, "a", 1), (1, None, 1), (None, None, None)])
    ids = sorted(r.id for r in identified(rows).collect())
    assert ids == sorted(r.id for r in identified(rows.repartition(3, "n")).collect())
    assert len(set(ids)) == 4
    assert set(ids).isdisjoint(r.id for r in identified(rows, F.lit("file 2")).collect())


def test_ids_are_name_based_uuids(spark):
    import uuid

    from cabtally.fixed_values import ID_NAMESPACE

    got = spark.range(1).select(content_id(F.lit("ab"), F.lit(None).cast("string"), F.lit(5)).alias("id")).first().id
    assert got == str(uuid.uuid5(uuid.UUID(ID_NAMESPACE), "2:ab|-|1:5"))
