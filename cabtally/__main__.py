"""Command line: ``spark-submit --py-files .. -m cabtally <job> ..`` or ``python -m cabtally``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from cabtally.fixed_values import LANDING_BATCH, PREVIEW_ROWS, TRIP_FIELDS
from cabtally.operators import reports
from cabtally.operators.statistics import REVENUE_PER_DAY, STATISTICS, fields_of
from cabtally.plans import jobs
from cabtally.sources.files import import_table, jdbc_options
from cabtally.sources.records import decode_trips
from cabtally.sources.streams import kafka_sink_options, kafka_source_options, open_stream
from cabtally.streaming.landing import land_stream
from cabtally.streaming.statistics import latest, open_table, running_totals_stream


def _pairs(texts: list[str]) -> dict[str, str]:
    return dict(text.split("=", 1) for text in texts)


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.text:
        return open_stream(spark, "text", args.text, options=_file_options(args))
    options = kafka_source_options(args.servers, args.topic, args.starting, args.per_batch)
    return open_stream(spark, "kafka", options=options)


def _file_options(args: argparse.Namespace) -> dict[str, str]:
    return {"maxFilesPerTrigger": str(args.files_per_batch)} if args.files_per_batch else {}


def _committed(args: argparse.Namespace):
    return jobs.copy_to(args.copy_to, **_pairs(args.option)) if args.copy_to else None


def _print(frame: DataFrame) -> None:
    """All rows, fetched one partition at a time."""
    print(*frame.columns, sep="\t")
    for row in frame.toLocalIterator():
        print(*row, sep="\t")


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="cabtally", description=__doc__)
    add = root.add_subparsers(dest="job", required=True).add_parser

    def messages(job: argparse.ArgumentParser, per_batch: int | None = None) -> None:
        job.add_argument("--text", help="folder of message files; otherwise Kafka is read")
        job.add_argument("--servers", default="localhost:9092")
        job.add_argument("--topic")
        job.add_argument("--starting", default="latest", help="offsets of the first start")
        job.add_argument("--per-batch", type=int, default=per_batch, help="messages, for Kafka")
        job.add_argument("--files-per-batch", type=int)
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--every", help="e.g. '10 seconds'; otherwise take what is there and end")

    def tables(job: argparse.ArgumentParser, many: bool = True) -> None:
        job.add_argument("statistic", nargs="+" if many else 1, choices=list(STATISTICS))
        job.add_argument("--tables", required=True, help="folder of the stored statistics")

    def connector(job: argparse.ArgumentParser, name: str, required: bool = False) -> None:
        job.add_argument(name, required=required, help="format of a connector with keyed tables")
        job.add_argument("--option", action="append", default=[], help="key=value")

    def trips(job: argparse.ArgumentParser) -> None:
        job.add_argument("--trips", required=True, help="folder of trip files")
        job.add_argument("--kind", default="csv", choices=["csv", "parquet"])

    job = add("publish", help="CSV files to JSON messages")
    job.add_argument("--csv", required=True)
    job.add_argument("--text", help="folder for message files; otherwise Kafka")
    job.add_argument("--servers", default="localhost:9092")
    job.add_argument("--topic")

    job = add("land", help="JSON messages to de-duplicated CSV files")
    messages(job, LANDING_BATCH)
    job.add_argument("--out", required=True)

    job = add("batch", help="add new CSV files to statistics")
    tables(job)
    trips(job)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--files-per-batch", type=int)
    connector(job, "--copy-to")

    job = add("stream", help="add messages to statistics")
    tables(job)
    messages(job)
    connector(job, "--copy-to")

    job = add("running", help="keep a statistic in the state store")
    tables(job, many=False)
    messages(job)

    job = add("seed", help="take over a statistic from a connector table")
    tables(job, many=False)
    connector(job, "--from", required=True)

    job = add("show", help="show statistics")
    tables(job)

    job = add("report", help="show the revenue per day in calendar order")
    job.add_argument("--tables", required=True)

    job = add("stages", help="row counts of the revenue stages")
    trips(job)
    job.add_argument("--tables", required=True)

    for name, text in (("heat", "trips per point"), ("locations", "zones that occur")):
        job = add(name, help=text)
        job.add_argument("place", choices=list(jobs.LOCATIONS))
        trips(job)
        job.add_argument("--zones", required=True)
        job.add_argument("--out", required=True)

    job = add("store", help="append new CSV files to the Parquet trip store")
    job.add_argument("--csv", required=True)
    job.add_argument("--out", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--files-per-batch", type=int)

    job = add("preview", help="show the first trips of a store")
    job.add_argument("--store", required=True)
    job.add_argument("--rows", type=int, default=PREVIEW_ROWS)

    job = add("import", help="copy a JDBC table")
    job.add_argument("--url", required=True)
    job.add_argument("--table", required=True)
    job.add_argument("--option", action="append", default=[], help="key=value, e.g. user=me")
    job.add_argument("--split-by")
    job.add_argument("--bounds", nargs=2, type=int)
    job.add_argument("--splits", type=int, default=1)
    job.add_argument("--out", help="folder for Parquet files")
    job.add_argument("--catalog-table")
    return root


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    chosen = [STATISTICS[name] for name in getattr(args, "statistic", [])]

    def stored() -> DataFrame:
        return jobs.read_stored(spark, args.trips, args.kind)

    match args.job:
        case "publish":
            kind = "text" if args.text else "kafka"
            options = {} if args.text else kafka_sink_options(args.servers, args.topic)
            jobs.publish_files(spark, args.csv, kind, args.text, options)
        case "land":
            land_stream(
                _messages(spark, args), args.out, args.checkpoint, every=args.every
            ).awaitTermination()
        case "batch":
            jobs.update_from_files(
                spark,
                chosen,
                args.trips,
                args.tables,
                args.checkpoint,
                args.kind,
                _committed(args),
                _file_options(args),
            ).awaitTermination()
        case "stream":
            jobs.update_from_messages(
                _messages(spark, args),
                chosen,
                args.tables,
                args.checkpoint,
                _committed(args),
                every=args.every,
            ).awaitTermination()
        case "running":
            running_totals_stream(
                decode_trips(_messages(spark, args), fields_of(chosen, TRIP_FIELDS)),
                chosen[0],
                args.tables,
                args.checkpoint,
                every=args.every,
            ).awaitTermination()
        case "seed":
            connector = getattr(args, "from")
            jobs.seed_from(spark, chosen[0], args.tables, connector, **_pairs(args.option))
        case "show":
            for statistic in chosen:
                _print(latest(spark, args.tables, statistic))
        case "report":
            totals = open_table(spark, args.tables, REVENUE_PER_DAY).read()
            _print(reports.ordered_report(totals))
        case "stages":
            _print(jobs.revenue_stages(stored(), args.tables))
        case "heat":
            jobs.heat_points(stored(), args.zones, args.place).write.parquet(args.out)
        case "locations":
            jobs.location_table(stored(), args.zones, args.place).write.parquet(args.out)
        case "store":
            jobs.update_trip_store(
                spark, args.csv, args.out, args.checkpoint, _file_options(args)
            ).awaitTermination()
        case "preview":
            # Any rows will do, so nothing is ordered and a few files are read.
            _print(spark.read.parquet(args.store).limit(args.rows))
        case "import":
            options = jdbc_options(
                args.url,
                args.table,
                args.split_by,
                tuple(args.bounds) if args.bounds else None,
                args.splits,
                **_pairs(args.option),
            )
            import_table(spark, options, args.out, args.catalog_table)


def main() -> None:
    args = parser().parse_args()
    spark = SparkSession.builder.appName(f"cabtally-{args.job}").getOrCreate()
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
