"""Commands with settings of the environment, legacy messages as a stream,
meter keys in the stored form, files a partition, one JSON array."""

from __future__ import annotations

import glob
import io
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake import __main__ as commands
from meterlake.operators import clean, reports
from meterlake.plans import catalog
from meterlake.schema import METER, STORED, stored_schema
from meterlake.session import HIVE_CONF
from meterlake.settings import Settings
from meterlake.sinks.messages import json_array, legacy_message_value, to_messages, write_spool
from meterlake.sources import messages
from meterlake.sources.readings import readings
from meterlake.streaming import ingest

from data_dirs import SF_SMALL

NOW = {"availableNow": True}
KEY = T.StructField("meter_id", T.LongType(), True)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _keyed_spool(spark, path):
    write_spool(to_messages(readings(spark, SF_SMALL, keep_meter=True), carry=("meter_id",)), path)


def test_ingest_takes_what_is_left_out_from_the_environment(spark, monkeypatch):
    seen = {}

    def start(spark, settings, path, checkpoint, table, wire, carry):
        seen.update(path=path, checkpoint=checkpoint, table=table, topic=settings.kafka_topic, keys=[(f.name, f.dataType) for f in carry])

    monkeypatch.setattr(commands, "start_kafka_ingest", start)
    monkeypatch.setattr(commands, "run_until_stopped", lambda query: None)
    monkeypatch.setenv("DATA_PATH", "/data/energy")
    monkeypatch.setenv("SPARK_CHECKPOINT_LOCATION", "/data/ck")
    monkeypatch.setenv("HIVE_TABLE_NAME", "meters")
    monkeypatch.setenv("KAFKA_TOPIC", "t")
    assert commands.main(["ingest", "--key", "meter_id long"]) == 0
    assert seen == {"path": "/data/energy", "checkpoint": "/data/ck", "table": "meters", "topic": "t", "keys": [("meter_id", T.LongType())]}
    assert commands.main(["ingest", "--path", "/other", "--table", ""]) == 0
    assert (seen["path"], seen["table"], seen["keys"]) == ("/other", "", [])


@pytest.mark.parametrize("argv", [["ingest"], ["ingest", "--path", "p"], ["latest"], ["ingest", "--path", "p", "--checkpoint", "c", "--key", "a b c d("]])
def test_commands_that_lack_a_place_are_refused(spark, monkeypatch, argv):
    for name in ("DATA_PATH", "SPARK_CHECKPOINT_LOCATION"):
        monkeypatch.delenv(name, raising=False)
    with pytest.raises(SystemExit):
        commands.main(argv)


def test_hive_flag_asks_for_the_metastore(spark, monkeypatch):
    asked = []
    monkeypatch.setattr(commands, "build_session", lambda name, conf=None: asked.append(conf) or spark)
    assert commands.main(["--hive", "sql", "SELECT 1 AS a"], out=io.StringIO()) == 0
    assert commands.main(["sql", "SELECT 1 AS a"], out=io.StringIO()) == 0
    assert asked == [HIVE_CONF, None]
    assert HIVE_CONF["spark.sql.catalogImplementation"] == "hive"


def test_latest_command_over_stored_readings(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "stored")
    stored = ingest.to_stored(readings(spark, SF_SMALL))
    stored.write.partitionBy("year", "month", "day", "hour").parquet(path)
    monkeypatch.setenv("DATA_PATH", path)
    monkeypatch.setenv("DASHBOARD_LATEST_LIMIT", "7")
    assert Settings.from_env().latest_limit == 7
    lines, array = io.StringIO(), io.StringIO()
    assert commands.main(["latest"], out=lines) == 0
    assert commands.main(["latest", "--limit", "5", "--array"], out=array) == 0
    got = [json.loads(x) for x in lines.getvalue().splitlines()]
    want = [r.datetime.isoformat() for r in reports.latest(stored, limit=7).collect()]
    assert [r["datetime"] for r in got] == want
    assert json.loads(array.getvalue()) == got[:5]


def test_json_array_of_any_length_and_of_a_failed_query(spark):
    for n in (0, 1, 3):
        df = spark.range(n).select("id", F.lit(None).cast("string").alias("a.b")).orderBy("id")
        assert json.loads("\n".join(json_array(df))) == [{"id": i, "a.b": None} for i in range(n)]
    out = io.StringIO()
    assert commands.main(["sql", "--array", "SELECT x FROM no_such_table"], out=out) == 1
    assert set(json.loads(out.getvalue())) == {"error"}
    out = io.StringIO()
    assert commands.main(["sql", "--array", "SELECT raise_error('no') AS x FROM range(3)"], out=out) == 1
    assert set(json.loads(out.getvalue())) == {"error"}


def test_legacy_stream_equals_batch_and_prints(spark, tmp_path, monkeypatch):
    spool = str(tmp_path / "spool")
    legacy = clean.clean_stream(readings(spark, SF_SMALL)).select(legacy_message_value().alias("value"))
    broken = spark.createDataFrame([("no json",), ("",), ('{"power": "much", "zone": "zone1"}',)], "value string")
    write_spool(legacy.union(broken), spool)
    batch = ingest.parse_wire(messages.read_spool(spark, spool, stream=False), "zone")
    assert batch.columns == ["timestamp", "zone", "power"]
    stream = ingest.parse_wire(messages.read_spool(spark, spool), "zone")
    assert stream.isStreaming
    query = ingest.start_memory_sink(stream, "legacy_rows", trigger=NOW)
    query.awaitTermination()
    assert _rows(spark.table("legacy_rows")) == _rows(batch)
    assert batch.where("power is null and zone = 'zone1'").count() == 1
    shown = []
    monkeypatch.setattr(commands, "run_until_stopped", lambda query: (query.awaitTermination(), shown.append(query)))
    assert commands.main(["watch", "--spool", spool, "--drain"]) == 0
    progress = shown[0].recentProgress
    assert "Console" in progress[0]["sink"]["description"] and shown[0].exception() is None
    assert sum(p["numInputRows"] for p in progress) == batch.count()


def test_watch_needs_kafka_and_legacy_messages_are_not_stored(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        commands.main(["watch"])
    with pytest.raises(ValueError, match="watched"):
        ingest.start_kafka_ingest(spark, Settings(), "p", "c", wire="zone")
    with pytest.raises(ValueError, match="carry"):
        ingest.parse_wire(spark.createDataFrame([], "value string"), "raw", carry=[KEY])


def test_meter_key_is_stored_and_in_the_table(spark, tmp_path):
    spool, out, ck = (str(tmp_path / n) for n in ("spool", "out", "ck"))
    _keyed_spool(spark, spool)
    spark.createDataFrame([('{"datetime": "2024-01-01 00:00:00"' + "".join(f', "{m}": 1.0' for m in METER.measures) + "}",)], "value string").write.mode("append").text(spool)
    parsed = ingest.parse_wire(messages.read_spool(spark, spool), "json", carry=[KEY])
    ingest.start_ingest(spark, parsed, out, ck, table="meters_by_key", trigger=NOW, by=["meter_id"]).awaitTermination()
    table = catalog.read_table(spark, "meters_by_key")
    assert table.columns == stored_schema(METER, [KEY]).names
    want = ingest.to_stored(readings(spark, SF_SMALL, keep_meter=True), by=["meter_id"])
    assert _rows(table.where("meter_id is not null")) == _rows(want)
    assert table.where("meter_id is null").count() == 1  # a message without the key
    newest = reports.latest(table.where("meter_id is not null"), limit=1, by=["meter_id"])
    assert newest.count() == want.select("meter_id").distinct().count()
    catalog.drop_table(spark, "meters_by_key")


def test_table_that_lacks_the_key_is_refused(spark, tmp_path):
    place = str(tmp_path / "t")
    catalog.create_table(spark, "meters_plain", place, STORED)
    catalog.create_table(spark, "meters_plain", place, STORED)
    with pytest.raises(ValueError, match="meter_id"):
        catalog.create_table(spark, "meters_plain", place, stored_schema(METER, [KEY]))
    catalog.drop_table(spark, "meters_plain")


@pytest.mark.parametrize("files", [1, 6])
def test_files_a_partition_are_bounded(spark, tmp_path, files):
    """Many source files, each with rows of every day, and one day that holds
    most rows: as many files a day as asked for, not one a source task."""
    spool, out, ck = (str(tmp_path / n) for n in ("spool", "out", "ck"))
    rows = spark.range(4000).select(
        (F.lit(1704067200) + F.when(F.col("id") % 3 > 0, F.col("id") % 60).otherwise(F.col("id") * 600)).cast("timestamp").alias("datetime"),
        *[(F.col("id") * F.lit(1.0)).alias(m) for m in METER.measures])
    write_spool(to_messages(rows.repartition(8)), spool)
    days = ("year", "month", "day")
    parsed = messages.parse_json(messages.read_spool(spark, spool))
    ingest.start_ingest(spark, parsed, out, ck, trigger=NOW, partition_by=days, files_per_partition=files).awaitTermination()
    found = [len(glob.glob(f"{d}/*.parquet")) for d in glob.glob(f"{out}/year=*/month=*/day=*")]
    assert len(found) > 20 and max(found) <= files
    assert spark.read.parquet(out).count() == 4000
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # which would join tasks this small
    try:
        tasks = ingest.deal_by_partition(rows.withColumn("day", F.to_date("datetime")), ["day"], files).withColumn("task", F.spark_partition_id()).groupBy("day").agg(
            F.count_distinct("task").alias("n"), F.count(F.lit(1)).alias("rows")).orderBy(F.desc("rows")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r.n for r in tasks) <= files and (tasks[0].n > 1) == (files > 1)  # the hot day is spread
    with pytest.raises(ValueError):
        ingest.deal_by_partition(rows, days, 0)
