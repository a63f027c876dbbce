"""Snapshot tables: versions, replays, leftovers, concurrent writers, connectors."""

import os

import pytest

from cabtally.operators.statistics import PASSENGERS, PAYMENT_TYPE
from cabtally.plans.jobs import copy_to, seed_from
from cabtally.sources.storage import Storage, scratch_folder, shared_folder
from cabtally.sources.tables import KEPT_VERSIONS, SnapshotTable, read_keyed, upsert_keyed
from cabtally.streaming.statistics import open_table

SCHEMA = "k int, n bigint"


def rows(frame):
    return sorted(map(tuple, frame.collect()))


def put(table, frame, *batch):
    return table.update(lambda content: frame, *batch)


def make(spark, *values):
    return spark.createDataFrame(list(values), SCHEMA)


@pytest.fixture
def table(spark, folder):
    return SnapshotTable(spark, f"{folder}/table", SCHEMA)


def folders(tmp_path):
    return sorted(n for n in os.listdir(tmp_path / "table") if n.startswith("version-"))


def test_a_new_table_is_empty_and_typed(table):
    assert table.read().dtypes == [("k", "int"), ("n", "bigint")]
    assert rows(table.read()) == []


def test_commit_replaces_the_content_it_is_computed_from(spark, table):
    put(table, make(spark, (1, 1)))
    table.update(lambda content: content.unionByName(make(spark, (2, 2))))
    assert rows(table.read()) == [(1, 1), (2, 2)]


def test_a_repeated_batch_is_skipped(spark, table):
    assert put(table, make(spark, (1, 1)), "s", 0)
    assert put(table, make(spark, (1, 2)), "s", 1)
    for batch in (0, 1):
        assert table.has("s", batch)
        assert not put(table, make(spark, (1, 99)), "s", batch)
    assert rows(table.read()) == [(1, 2)]
    assert not table.has("s", 2)


def test_streams_count_their_batches_apart(spark, table):
    put(table, make(spark, (1, 1)), "old checkpoint", 5)
    assert put(table, make(spark, (1, 2)), "new checkpoint", 0)
    assert table.has("old checkpoint", 5) and not table.has("new checkpoint", 1)
    put(table, make(spark, (1, 3)))
    assert table.has("old checkpoint", 5) and table.has("new checkpoint", 0)


def test_the_state_outlives_the_object(spark, folder, table):
    put(table, make(spark, (1, 1)), "s", 3)
    again = SnapshotTable(spark, f"{folder}/table", SCHEMA)
    assert again.has("s", 3) and rows(again.read()) == [(1, 1)]


def test_old_versions_go_but_earlier_ones_stay(spark, tmp_path, table):
    put(table, make(spark, (1, 0)))
    for n in range(1, KEPT_VERSIONS + 3):
        previous = table.read()
        put(table, make(spark, (1, n)))
        assert rows(previous) == [(1, n - 1)]
    assert len(folders(tmp_path)) == KEPT_VERSIONS
    commits = [n for n in os.listdir(tmp_path / "table" / "_commits") if n[0] != "."]
    assert len(commits) == KEPT_VERSIONS


def test_a_write_that_failed_before_its_commit_is_not_seen(spark, tmp_path, table):
    put(table, make(spark, (1, 1)), "s", 0)
    make(spark, (1, 99)).write.parquet(f"{tmp_path}/table/version-0000000002-lost")
    assert rows(table.read()) == [(1, 1)]
    assert put(table, make(spark, (1, 2)), "s", 1)
    assert rows(table.read()) == [(1, 2)]
    for n in range(KEPT_VERSIONS):
        put(table, make(spark, (1, n)))
    assert not [name for name in folders(tmp_path) if name.endswith("lost")]


def test_a_writer_that_comes_second_starts_again_from_the_new_content(spark, folder, table):
    other = SnapshotTable(spark, f"{folder}/table", SCHEMA)
    tries = []

    def add_late(content):
        if not tries:
            put(table, make(spark, (1, 1)), "first", 0)
        tries.append(rows(content))
        return content.unionByName(make(spark, (2, 2)))

    assert other.update(add_late, "second", 0)
    assert tries == [[], [(1, 1)]]
    assert rows(table.read()) == [(1, 1), (2, 2)]
    assert table.has("first", 0) and table.has("second", 0)


def test_a_table_that_never_rests_is_given_up(spark, folder, table):
    other = SnapshotTable(spark, f"{folder}/table", SCHEMA)
    other._state = lambda state=other._state(): state
    put(table, make(spark, (1, 1)))
    with pytest.raises(RuntimeError):
        put(other, make(spark, (1, 2)))
    assert rows(table.read()) == [(1, 1)]


def test_storage_writes_and_moves_without_replacing(spark, folder):
    storage = Storage(spark, folder)
    storage.write_new(f"{folder}/a/note", "Größe")
    assert storage.read(f"{folder}/a/note") == "Größe"
    assert storage.names(f"{folder}/none") == []
    storage.write_new(f"{folder}/a/other", "x")
    with pytest.raises(FileExistsError):
        storage.rename(f"{folder}/a/other", f"{folder}/a/note")


def test_scratch_lies_in_the_folder_the_session_names(spark):
    assert scratch_folder(spark, "test").startswith(shared_folder(spark).rstrip("/") + "/")
    named = spark.conf.get("spark.checkpoint.dir", None)
    assert named is None or shared_folder(spark) == named


def test_connector_tables_receive_presented_totals(spark, folder):
    statistic = PAYMENT_TYPE
    table = open_table(spark, f"{folder}/stats", statistic)
    put(table, spark.createDataFrame([(1, 5), (9, 1)], statistic.schema))
    copy_to("parquet", path=f"{folder}/copy")(statistic, table)
    copied = read_keyed(spark, "parquet", path=f"{folder}/copy")
    assert copied.columns == ["payment_type", "count", "payment_type_name", "partition_key"]
    assert len(rows(copied.na.fill("none"))) == 2


def test_totals_are_taken_over_from_a_connector_table(spark, folder):
    schema = "passenger_number string, count int, partition_key int"
    text_keys = spark.createDataFrame([("2", 7, 1), ("10", 3, 1)], schema)
    upsert_keyed(text_keys, "parquet", path=f"{folder}/source")
    seed_from(spark, PASSENGERS, f"{folder}/stats", "parquet", path=f"{folder}/source")
    seeded = open_table(spark, f"{folder}/stats", PASSENGERS).read()
    assert rows(seeded) == [(2, 7), (10, 3)]


def overtake(table, frame, times=KEPT_VERSIONS + 1):
    for _ in range(times):
        table.update(lambda content: content.unionByName(frame))


def test_a_writer_overtaken_by_more_than_the_kept_versions_begins_anew(spark, table):
    put(table, make(spark, (0, 0)))
    calls = []

    def slow(content):
        calls.append(1)
        if len(calls) == 1:
            overtake(table, make(spark, (1, 1)))
            return make(spark, (2, 2))  # does not read what it replaces
        return content.unionByName(make(spark, (2, 2)))

    assert table.update(slow, "s", 0)
    assert len(calls) == 2
    assert table.has("s", 0)
    assert rows(table.read()) == sorted([(0, 0), (2, 2)] + [(1, 1)] * (KEPT_VERSIONS + 1))


def test_a_slow_reader_of_dropped_content_begins_anew(spark, table):
    put(table, make(spark, (0, 0)))
    calls = []

    def slow(content):
        calls.append(1)
        if len(calls) == 1:
            overtake(table, make(spark, (1, 1)))
        return content.unionByName(make(spark, (2, 2)))

    assert table.update(slow)
    assert len(calls) == 2
    assert rows(table.read()) == sorted([(0, 0), (2, 2)] + [(1, 1)] * (KEPT_VERSIONS + 1))


def test_another_failure_of_an_update_is_raised(spark, table):
    put(table, make(spark, (0, 0)))
    with pytest.raises(ZeroDivisionError):
        table.update(lambda content: 1 / 0)


def test_old_totals_are_read_by_a_wider_type(spark, folder):
    old = SnapshotTable(spark, f"{folder}/money", "k int, total decimal(18,2)")
    put(old, spark.sql("SELECT 1 AS k, 12.50BD AS total").selectExpr("k", "cast(total AS decimal(18,2)) AS total"))
    new = SnapshotTable(spark, f"{folder}/money", "k int, total decimal(38,2)")
    assert [str(r.total) for r in new.read().collect()] == ["12.50"]


def test_copy_takes_a_table_option(spark, folder):
    tables, copies = f"{folder}/tables", f"{folder}/copy"
    open_table(spark, tables, PASSENGERS).update(
        lambda content: spark.sql("SELECT 1 AS passenger_number, 2L AS count")
    )
    copy_to("parquet", table="other", path=copies)(PASSENGERS, open_table(spark, tables, PASSENGERS))
    assert spark.read.parquet(copies).count() == 1
