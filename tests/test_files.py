"""CSV files and option assembly of the connectors that are not installed here."""

from datetime import datetime

import pytest

from cabtally.plans.fixtures import FIELDS, trips
from cabtally.sources.files import import_table, jdbc_options, read_csv, read_trips, read_zones
from cabtally.sources.streams import kafka_sink_options, kafka_source_options

HEADER = (
    "VendorID,tpep_pickup_datetime,tpep_dropoff_datetime,passenger_count,trip_distance,RatecodeID,"
    "store_and_fwd_flag,PULocationID,DOLocationID,payment_type,fare_amount,extra,mta_tax,"
    "tip_amount,tolls_amount,improvement_surcharge,total_amount,congestion_surcharge"
)
LINE = "1,2024-01-01 00:57:55,2024-01-01 01:17:43,1,1.72,1,N,186,79,2,17.7,1,0.5,0,0,1,22.7,2.5"
GAPS = "2,2024-01-01 00:57:55,2024-01-01 01:17:43,1.0,,,,186,79,,17.7,1,0.5,0,0,1,NaN,"


def test_many_files_nested_folders_and_whole_numbers_with_fractions(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "a" / "one.csv").write_text(f"{HEADER}\n{LINE}\n")
    (tmp_path / "two.csv").write_text(f"{HEADER}\n{GAPS}\n")
    first, second = read_trips(spark, str(tmp_path)).orderBy("vendorid").collect()
    assert (first.pulocationid, first.total_amount, first.store_and_fwd_flag) == (186, 22.7, "N")
    assert first.tpep_pickup_datetime == datetime(2024, 1, 1, 0, 57, 55)
    assert (second.passenger_count, second.payment_type, second.total_amount) == (1, None, None)


def test_columns_in_another_order_are_matched_by_name(spark, tmp_path):
    swapped = HEADER.replace("PULocationID,DOLocationID", "DOLocationID,PULocationID")
    (tmp_path / "swapped.csv").write_text(f"{swapped}\n{LINE}\n")
    (row,) = read_trips(spark, str(tmp_path)).collect()
    assert (row.dolocationid, row.pulocationid) == (186, 79)


def test_columns_can_be_inferred(spark, tmp_path):
    (tmp_path / "one.csv").write_text(f"{HEADER}\n{LINE}\n")
    kinds = dict(read_csv(spark, str(tmp_path), fields=None).dtypes)
    assert kinds["vendorid"] == "int" and kinds["total_amount"] == "double"


def test_csv_round_trip_keeps_every_value(spark, sf_dir, folder):
    original = trips(spark, sf_dir)
    original.write.csv(f"{folder}/trips", header=True)
    back = read_trips(spark, f"{folder}/trips", FIELDS)
    assert back.dtypes == original.dtypes
    assert back.exceptAll(original).isEmpty() and original.exceptAll(back).isEmpty()


def test_zone_file(spark, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(
        "LocationID,Borough,Zone,service_zone,latitude,longitude\n"
        "1,North,Old Mill,Blue,40.5,-74.25\n264,Nowhere,None,N/A,#N/A,-116.5\n"
    )
    one, two = read_zones(spark, str(path)).orderBy("locationid").collect()
    assert (one.locationid, one.zone, one.latitude) == (1, "Old Mill", "40.5")
    assert (two.locationid, two.latitude, two.longitude) == (264, "#N/A", "-116.5")


def test_jdbc_options():
    assert jdbc_options("jdbc:x", "t", user="me") == {"url": "jdbc:x", "dbtable": "t", "user": "me"}
    split = jdbc_options("jdbc:x", "t", "id", (1, 900), 9)
    assert split["partitionColumn"] == "id" and split["numPartitions"] == "9"
    assert (split["lowerBound"], split["upperBound"]) == ("1", "900")
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", splits=4)


def test_import_needs_one_target(spark):
    with pytest.raises(ValueError):
        import_table(spark, {})
    with pytest.raises(ValueError):
        import_table(spark, {}, path="p", table="t")


def test_kafka_options():
    source = kafka_source_options("b:9092", "trips", per_batch=1_000_000)
    assert source == {
        "kafka.bootstrap.servers": "b:9092",
        "subscribe": "trips",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "1000000",
    }
    assert kafka_source_options("b", "t", "earliest")["startingOffsets"] == "earliest"
    assert kafka_sink_options("b", "t") == {"kafka.bootstrap.servers": "b", "topic": "t"}
