"""Command line: the deployed jobs, runnable with ``spark-submit``.

    python -m meterlake ingest   [--path P] [--checkpoint C] [--table T] [--wire json|raw] [--key "meter_id string"]
    python -m meterlake watch    [--wire zone|json|raw] [--topic T] [--offsets latest] [--spool S] [--drain]
    python -m meterlake latest   [--path P | --table T] [--limit N] [--array]
    python -m meterlake clean    --raw R --out O [--policy batch|stream] [--partition-by year,month]
    python -m meterlake features --cleaned C --hourly H --daily D [--rows R]
    python -m meterlake publish  --raw R [--spool S]
    python -m meterlake fold     --root R [--partition-by year,month,day] [--at-least N] [--keep-hours H]
    python -m meterlake sql      [--view name=parquet_path ...] [--array] "SELECT ..."

Kafka brokers, topic, offsets, the trigger interval and what ``--path``,
``--checkpoint``, ``--table`` and ``--limit`` leave out come from the
environment (``Settings.from_env``). ``sql`` and ``latest`` print one JSON
object per result row, or with ``--array`` one JSON array (a failed query:
one object with its error), fetched partition by partition, never the whole
result at once. ``--hive`` before the command keeps tables in the cluster's
metastore, so that they outlive the application.
"""

from __future__ import annotations

import argparse
import json
import sys
from collections.abc import Callable, Sequence

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from meterlake.operators import reports
from meterlake.plans import catalog, jobs
from meterlake.plans.sql import run_sql
from meterlake.schema import PARTITION_COLUMNS
from meterlake.session import HIVE_CONF, build_session
from meterlake.settings import Settings
from meterlake.sinks.messages import json_array, result_json
from meterlake.sources.messages import LEGACY_TOPIC, read_kafka, read_spool
from meterlake.streaming.ingest import run_until_stopped, start_kafka_ingest, start_watch


def _split(value: str) -> tuple[str, ...]:
    return tuple(v.strip() for v in value.split(",") if v.strip())


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="meterlake")
    p.add_argument("--hive", action="store_true", help="tables in the cluster's Hive metastore")
    sub = p.add_subparsers(dest="command", required=True)

    ing = sub.add_parser("ingest", help="Kafka topic -> cleaned, partitioned Parquet (runs until stopped)")
    ing.add_argument("--path")
    ing.add_argument("--checkpoint")
    ing.add_argument("--table", help="an empty name: no table")
    ing.add_argument("--wire", choices=("json", "raw"), default="json")
    ing.add_argument("--key", action="append", default=[], help="a message field to store, as 'name type'; may repeat")

    wa = sub.add_parser("watch", help="messages of a topic, or of a spool folder, printed batch by batch")
    wa.add_argument("--wire", choices=("zone", "json", "raw"), default="zone")
    wa.add_argument("--topic", help=f"default: {LEGACY_TOPIC} for zone messages, else the topic of the settings")
    wa.add_argument("--offsets", default="latest")
    wa.add_argument("--spool")
    wa.add_argument("--drain", action="store_true", help="stop when all that is there has been printed")

    la = sub.add_parser("latest", help="newest readings as JSON")
    la.add_argument("--path")
    la.add_argument("--table")
    la.add_argument("--limit", type=int)
    la.add_argument("--array", action="store_true")

    cl = sub.add_parser("clean", help="raw ';' text -> cleaned Parquet")
    cl.add_argument("--raw", required=True)
    cl.add_argument("--out", required=True)
    cl.add_argument("--policy", choices=("batch", "stream"), default="batch")
    cl.add_argument("--partition-by", type=_split, default=())

    fe = sub.add_parser("features", help="cleaned Parquet -> hourly and daily features")
    fe.add_argument("--cleaned", required=True)
    fe.add_argument("--hourly", required=True)
    fe.add_argument("--daily", required=True)
    fe.add_argument("--rows")

    pu = sub.add_parser("publish", help="raw ';' text -> JSON messages in the topic, or in a spool folder")
    pu.add_argument("--raw", required=True)
    pu.add_argument("--spool")

    fo = sub.add_parser("fold", help="fold the landed batches of a snapshot table, remove what left it long ago")
    fo.add_argument("--root", required=True)
    fo.add_argument("--partition-by", type=_split, default=PARTITION_COLUMNS)
    fo.add_argument("--at-least", type=int, default=2, help="live directories from which folding is worth it")
    fo.add_argument("--keep-hours", type=float, default=24.0, help="how long replaced directories stay for readers")

    sq = sub.add_parser("sql", help="run SQL text, print JSON lines")
    sq.add_argument("--view", action="append", default=[], help="name=parquet_path, may repeat")
    sq.add_argument("--array", action="store_true")
    sq.add_argument("text")
    return p


def _print_result(make: Callable[[], DataFrame], array: bool, out) -> int:
    """JSON lines, or one array: then a failed query is an object with its
    error, and the status 1, unless lines have been printed already."""
    if not array:
        for row in result_json(make()).toLocalIterator():
            print(row.json, file=out)
        return 0
    begun = False
    try:
        for line in json_array(make()):
            begun = True
            print(line, file=out)
    except Exception as failure:  # a task's failure reaches the iterator as an error of the bridge
        if begun:
            raise
        print(json.dumps({"error": str(failure)}), file=out)
        return 1
    return 0


def main(argv: Sequence[str] | None = None, out=None) -> int:
    p = parser()
    args = p.parse_args(argv)
    out = out or sys.stdout
    settings = Settings.from_env()
    place = (getattr(args, "path", None) or settings.data_path) if args.command in ("ingest", "latest") else ""
    if args.command == "ingest":
        checkpoint = args.checkpoint or settings.checkpoint_path
        if not place or not checkpoint:
            p.error("ingest needs a path and a checkpoint, as options or in the environment")
        try:
            keys = T.StructType.fromDDL(", ".join(args.key)).fields if args.key else []
        except PySparkException:
            p.error(f"not fields with types: {args.key}")
    if args.command == "latest" and not place and not args.table:
        p.error("latest needs a path or a table")
    name = f"meterlake-{args.command}"
    spark = build_session(name, HIVE_CONF) if args.hive else build_session(name)
    if args.command == "ingest":
        table = settings.table_name if args.table is None else args.table
        query = start_kafka_ingest(spark, settings, place, checkpoint, table, args.wire, carry=keys)
        run_until_stopped(query)
    elif args.command == "watch":
        topic = args.topic or (LEGACY_TOPIC if args.wire == "zone" else settings.kafka_topic)
        source = read_spool(spark, args.spool) if args.spool else read_kafka(spark, settings, topic=topic, starting_offsets=args.offsets)
        run_until_stopped(start_watch(spark, source, args.wire, trigger={"availableNow": True} if args.drain else None))
    elif args.command == "latest":
        limit = settings.latest_limit if args.limit is None else args.limit

        def newest() -> DataFrame:
            table = catalog.read_table(spark, args.table) if args.table else spark.read.parquet(place)
            return reports.latest(table, limit=limit, partitioned=set(PARTITION_COLUMNS) <= set(table.columns))

        return _print_result(newest, args.array, out)
    elif args.command == "clean":
        jobs.clean_job(spark, args.raw, args.out, policy=args.policy, partition_by=args.partition_by)
    elif args.command == "features":
        paths = jobs.FeaturePaths(args.hourly, args.daily, args.rows)
        jobs.feature_job(spark, spark.read.parquet(args.cleaned), paths)
    elif args.command == "publish":
        jobs.publish_job(spark, args.raw, args.spool, None if args.spool else settings)
    elif args.command == "fold":
        jobs.fold_job(spark, args.root, args.partition_by, args.at_least, args.keep_hours * 3600)
    elif args.command == "sql":
        views = {}
        for item in args.view:
            name, _, path = item.partition("=")
            views[name] = spark.read.parquet(path)
        try:
            return _print_result(lambda: run_sql(spark, args.text, views), args.array, out)
        finally:  # in a shared session they would shadow stored tables
            for name in views:
                spark.catalog.dropTempView(name)
    return 0


if __name__ == "__main__":
    sys.exit(main())
