"""CSV files and messages of other layouts than the usual one, and rows without a time."""

import glob
import os
import shutil

import pytest
from oracle_check import assert_same, connect

from cabtally.fixed_values import TRIP_FIELDS
from cabtally.plans.jobs import follow_stored, publish_files
from cabtally.plans.oracle import ORACLE
from cabtally.plans.registry import QUERIES
from cabtally.sources.files import read_csv, read_trips
from cabtally.streaming.landing import land_batch

NAMES = list(TRIP_FIELDS)


def write(path, header, values):
    os.makedirs(path.parent, exist_ok=True)
    path.write_text(",".join(header) + "\n" + ",".join(values) + "\n")


@pytest.fixture
def mixed(tmp_path):
    """17, 18, 19 and reordered columns in one folder; each value names its column's place."""
    numbers = {name: str(i) for i, name in enumerate(NAMES)}
    for name in ("tpep_pickup_datetime", "tpep_dropoff_datetime"):
        numbers[name] = "2024-01-01 00:00:00"
    numbers["store_and_fwd_flag"] = "N"
    layouts = {
        "usual": NAMES,
        "older": NAMES[:-1],
        "newer": [*NAMES, "Airport_fee"],
        "turned": NAMES[::-1],
    }
    for name, header in layouts.items():
        write(tmp_path / "csv" / f"{name}.csv", header, [numbers.get(n, "7.5") for n in header])
    return tmp_path / "csv"


def test_each_value_is_in_its_column(spark, mixed):
    rows = read_trips(spark, str(mixed)).collect()
    assert len(rows) == 4
    for row in rows:
        assert row.vendorid == 0 and row.total_amount == NAMES.index("total_amount")
        assert row.store_and_fwd_flag == "N"
    assert sorted(r.congestion_surcharge is None for r in rows) == [False, False, False, True]


def test_other_columns_are_published(spark, mixed, folder):
    publish_files(spark, str(mixed), "text", f"{folder}/messages", {})
    messages = [r.value for r in spark.read.text(f"{folder}/messages").collect()]
    assert sum('"airport_fee":"7.5"' in m for m in messages) == 1
    assert sum('"vendorid"' in m for m in messages) == 4
    assert "airport_fee" in read_csv(spark, str(mixed), others=True).columns


def test_other_fields_are_landed(spark, folder):
    values = ['{"vendorid":1,"airport_fee":1.25,"x":{"y":[1]}}', '{"vendorid":2}', '{"z":3}', "bad"]
    messages = spark.createDataFrame([(v,) for v in values], "value string")
    land_batch(messages, f"{folder}/landed", "batch")
    landed = spark.read.option("escape", '"').csv(f"{folder}/landed/batch", header=True)
    got = {(r.vendorid, r.rest) for r in read_csv(spark, f"{folder}/landed/batch", others=True).collect()}
    assert landed.count() == 3
    assert {v for v, _ in got} == {1.0, 2.0, None}
    assert sum("airport_fee" in (rest or "") for _, rest in got) == 1
    assert sum("z" in (rest or "") for v, rest in got if v is None) == 1


def test_a_stream_takes_one_layout_of_any_kind(spark, mixed, tmp_path):
    with pytest.raises(ValueError, match="different headers"):
        follow_stored(spark, str(mixed))
    for kind in ("older", "newer", "turned"):
        target = tmp_path / kind
        target.mkdir()
        shutil.copy(mixed / f"{kind}.csv", target)
        rows = follow_stored(spark, str(target))
        query = rows.writeStream.format("memory").queryName(kind).trigger(availableNow=True).start()
        query.awaitTermination()
        (row,) = spark.table(kind).collect()
        assert row.total_amount == NAMES.index("total_amount")


@pytest.fixture(scope="module")
def without_times(spark, sf_dir, tmp_path_factory):
    """The given tables, with no time in a tenth of the events."""
    target = tmp_path_factory.mktemp("tables")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        if not path.endswith("events.parquet"):
            os.symlink(path, target / os.path.basename(path))
    connection = connect(sf_dir)
    connection.execute(
        "COPY (SELECT * REPLACE (CASE WHEN event_id % 10 = 3 THEN NULL ELSE ts END AS ts) FROM events)"
        f" TO '{target}/events.parquet' (FORMAT parquet)"
    )
    return str(target)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_row_is_lost_to_a_missing_time(spark, without_times, name):
    assert assert_same(QUERIES[name](spark, without_times), connect(without_times), ORACLE[name]) > 0
