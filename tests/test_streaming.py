"""Structured Streaming: same rules as batch, exactly-once file sink across
restarts, watermarked windows, repeat dropping, replay-safe landing."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from meterlake.operators import clean
from meterlake.plans import catalog
from meterlake.schema import METER, Meter
from meterlake.sinks.messages import to_messages, write_spool
from meterlake.sources import messages
from meterlake.sources.readings import readings
from meterlake.streaming import aggregates, ingest, landing

from data_dirs import SF_SMALL

NOW = {"availableNow": True}


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_batch(spark, tmp_path):
    spool, out, ck = (str(tmp_path / n) for n in ("spool", "out", "ck"))
    write_spool(to_messages(readings(spark, SF_SMALL)), spool)
    parsed = messages.parse_json(messages.read_spool(spark, spool))
    assert parsed.isStreaming
    q = ingest.start_ingest(spark, parsed, out, ck, trigger=NOW)
    q.awaitTermination()
    assert q.exception() is None
    stored = spark.read.parquet(out)
    batch = ingest.to_stored(messages.parse_json(messages.read_spool(spark, spool, stream=False)))
    cols = ingest.stored_columns()
    assert _rows(stored.select(*cols)) == _rows(batch.select(*cols))
    # partition directories as the original layout
    assert os.path.isdir(os.path.join(out, "_spark_metadata"))
    assert any(d.startswith("year=") for d in os.listdir(out))


def test_restart_resumes_without_duplicates(spark, tmp_path):
    spool, out, ck = (str(tmp_path / n) for n in ("spool", "out", "ck"))
    data = readings(spark, SF_SMALL)
    first, second = data.filter(F.col("event_id") % 2 == 0), data.filter(F.col("event_id") % 2 == 1)
    write_spool(to_messages(first), spool)

    def run():
        parsed = messages.parse_json(messages.read_spool(spark, spool))
        q = ingest.start_ingest(spark, parsed, out, ck, trigger=NOW)
        q.awaitTermination()

    run()
    n1 = spark.read.parquet(out).count()
    run()  # restart, nothing new: nothing written again
    assert spark.read.parquet(out).count() == n1
    write_spool(to_messages(second), spool, mode="append")
    run()  # restart, only the new files are processed
    total = spark.read.parquet(out).count()
    assert total == clean.clean_stream(data).count()
    assert n1 < total


def test_table_created_before_stream_sees_new_rows(spark, tmp_path):
    spool, out, ck = (str(tmp_path / n) for n in ("spool", "out", "ck"))
    write_spool(to_messages(readings(spark, SF_SMALL)), spool)
    parsed = messages.parse_json(messages.read_spool(spark, spool))
    q = ingest.start_ingest(spark, parsed, out, ck, table="stream_tbl", trigger=NOW)
    q.awaitTermination()
    assert catalog.partition_columns(spark, "stream_tbl") == ["year", "month", "day", "hour"]
    assert spark.table("stream_tbl").count() == spark.read.parquet(out).count()
    catalog.drop_table(spark, "stream_tbl")


def test_hourly_windows_emit_only_closed_windows(spark, tmp_path):
    spool, out, ck = (str(tmp_path / n) for n in ("spool", "out", "ck"))
    write_spool(to_messages(readings(spark, SF_SMALL)), spool)
    parsed = clean.clean_stream(messages.parse_json(messages.read_spool(spark, spool)))
    q = ingest.start_parquet_sink(aggregates.hourly_windows(parsed, delay="1 hour"), out, ck, partition_by=(), trigger=NOW)
    q.awaitTermination()
    got = spark.read.parquet(out)
    newest = clean.clean_stream(readings(spark, SF_SMALL)).agg(F.max("datetime")).first()[0]
    assert got.count() > 0
    # watermark = newest - 1 h; only windows ending at or before it are final
    assert got.agg(F.max("window_end")).first()[0] <= newest - __import__("datetime").timedelta(hours=1)
    # every emitted window is complete: same count as a batch aggregation
    batch = (
        clean.clean_stream(readings(spark, SF_SMALL))
        .groupBy(F.date_trunc("hour", "datetime").alias("window_start"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    joined = got.join(batch, "window_start")
    assert joined.filter(F.col("n") != F.col("record_count")).count() == 0
    assert joined.count() == got.count()


def test_drop_repeats_in_stream(spark, tmp_path):
    spool, ck = str(tmp_path / "spool"), str(tmp_path / "ck")
    rows = readings(spark, SF_SMALL).na.drop().withColumnRenamed("event_id", "message_id")
    msgs = to_messages(rows, carry=("message_id",))
    carry = [T.StructField("message_id", T.LongType())]
    write_spool(msgs, spool)
    write_spool(msgs.limit(50), spool, mode="append")  # a publisher retried 50 sends
    # one file a batch: the copies come in another batch than the originals
    parsed = messages.parse_json(messages.read_spool(spark, spool, max_files_per_trigger=1), carry=carry)
    deduped = aggregates.drop_repeats(parsed, delay="1 day")
    q = ingest.start_memory_sink(deduped, "dedup_out", trigger=NOW)
    q.awaitTermination()
    got = spark.table("dedup_out")
    assert aggregates.late_rows(q) >= 0 and q.lastProgress["batchId"] >= 1
    expected = messages.parse_json(messages.read_spool(spark, spool, stream=False), carry=carry).distinct()
    assert got.count() == expected.count() == msgs.distinct().count()


def test_drop_repeats_keeps_distinct_readings_in_same_minute(spark):
    df = readings(spark, SF_SMALL).na.drop()
    twice = df.union(df)
    assert aggregates.drop_repeats(twice, keys=("event_id",)).count() == df.distinct().count() == df.count()


def test_drop_repeats_keeps_equal_readings_of_two_meters(spark):
    df = readings(spark, SF_SMALL).na.drop().drop("event_id")
    both = df.selectExpr("*", "1 AS meter_id").union(df.selectExpr("*", "2 AS meter_id"))
    keys = ("meter_id", "datetime", *METER.measures)
    assert aggregates.drop_repeats(both, keys=keys).count() == 2 * df.distinct().count()
    with pytest.raises(ValueError):
        aggregates.drop_repeats(both)
    with pytest.raises(ValueError):
        aggregates.drop_repeats(both, keys=())


def test_messages_of_another_meter_layout_carry_their_key(spark):
    meter = Meter(active="kw", submeters=("kitchen",))
    rows = spark.createDataFrame([(7, 1.5, 0.1, 230.0, 4.0, 2.0)], "meter_id long, kw double, global_reactive_power double, voltage double, global_intensity double, kitchen double")
    rows = rows.selectExpr("timestamp'2024-01-01 00:05:00' AS datetime", "*")
    back = messages.parse_json(to_messages(rows, meter, carry=("meter_id",)), meter=meter, carry=[T.StructField("meter_id", T.LongType())])
    assert back.select(rows.columns).collect() == rows.collect()


def test_landing_is_replay_safe_and_registers_partitions(spark, tmp_path):
    path = str(tmp_path / "landing")
    stored = ingest.to_stored(readings(spark, SF_SMALL))
    catalog.create_table(spark, "landing_tbl", path, schema=landing.landing_schema(),
                         partition_by=["batch_id", "year", "month", "day", "hour"])
    n = landing.land_batch(spark, stored, 0, path, "landing_tbl")
    assert n > 0
    landing.land_batch(spark, stored, 0, path, "landing_tbl")  # replay of batch 0
    assert spark.table("landing_tbl").count() == stored.count()
    catalog.drop_table(spark, "landing_tbl")


def test_landing_stream(spark, tmp_path):
    spool, path, ck = (str(tmp_path / n) for n in ("spool", "landing", "ck"))
    write_spool(to_messages(readings(spark, SF_SMALL)), spool)
    stored = ingest.to_stored(messages.parse_json(messages.read_spool(spark, spool)))
    q = landing.start_landing(spark, stored, path, ck, "landing_stream_tbl", trigger=NOW)
    q.awaitTermination()
    # no repair needed: partitions were added batch by batch
    assert spark.table("landing_stream_tbl").count() == clean.clean_stream(readings(spark, SF_SMALL)).count()
    catalog.drop_table(spark, "landing_stream_tbl")


def test_processing_time_trigger_and_console_sink(spark, tmp_path):
    spool = str(tmp_path / "spool")
    write_spool(to_messages(readings(spark, SF_SMALL).limit(5)), spool)
    parsed = messages.parse_json(messages.read_spool(spark, spool))
    q = ingest.start_console_sink(parsed, trigger=ingest.interval(1))
    try:
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()


def test_run_until_stopped_reraises(spark, tmp_path):
    class Boom:
        id = "x"

        def awaitTermination(self):
            raise KeyboardInterrupt

        stopped = False

        def stop(self):
            Boom.stopped = True

    import pytest

    with pytest.raises(KeyboardInterrupt):
        ingest.run_until_stopped(Boom())
    assert Boom.stopped


def test_raw_line_stream_equals_batch(spark, tmp_path):
    from meterlake.sources.text import raw_line

    spool, out, ck = (str(tmp_path / n) for n in ("spool", "out", "ck"))
    readings(spark, SF_SMALL).select(raw_line().alias("value")).write.text(spool)
    lines = messages.read_spool(spark, spool)
    q = ingest.start_ingest(spark, ingest.parse_wire(lines, "raw"), out, ck, trigger=NOW)
    q.awaitTermination()
    batch = ingest.to_stored(ingest.parse_wire(messages.read_spool(spark, spool, stream=False), "raw"))
    cols = ingest.stored_columns()
    assert _rows(spark.read.parquet(out).select(*cols)) == _rows(batch.select(*cols))


def test_kafka_ingest_without_connector_raises(spark, tmp_path):
    import pytest
    from meterlake.settings import Settings

    with pytest.raises(Exception, match="(?i)kafka"):
        ingest.start_kafka_ingest(spark, Settings(), str(tmp_path / "out"), str(tmp_path / "ck"))


def test_stream_rollup_merges_batches_and_compacts(spark, tmp_path):
    from meterlake.operators import features, rollup
    from meterlake.streaming import rollup as stream_rollup

    spool, parts, ck, out = (str(tmp_path / n) for n in ("spool", "parts", "ck", "compact"))
    write_spool(to_messages(readings(spark, SF_SMALL).repartitionByRange(3, "event_id")), spool)
    parsed = messages.parse_json(messages.read_spool(spark, spool, max_files_per_trigger=1))
    q = stream_rollup.start_rollup(clean.clean_stream(parsed), parts, ck, trigger=NOW)
    q.awaitTermination()
    assert len([d for d in os.listdir(parts) if d.startswith("batch_id=")]) == 3
    partials = stream_rollup.read_partials(spark, parts)
    direct = features.daily_features(clean.clean_stream(readings(spark, SF_SMALL)))
    key = ["year", "month", "day"]

    def as_map(df):
        return {tuple(r[k] for k in key): r for r in df.collect()}

    want = as_map(direct)
    for got in (as_map(rollup.daily_features(partials)),
                as_map(rollup.daily_features(stream_rollup.compact(spark, parts, out)))):
        assert got.keys() == want.keys()
        for k, r in got.items():
            for c in direct.columns:
                a, b = r[c], want[k][c]
                assert (a is None and b is None) or abs(a - b) <= 1e-9 * max(1.0, abs(b)), (k, c)
    # a replayed batch overwrites its own partials: totals unchanged
    n_before = rollup.statistics(partials).first().total_records
    first = sorted(d for d in os.listdir(parts) if d.startswith("batch_id="))[0]
    spark.read.parquet(os.path.join(parts, first)).write.mode("overwrite").parquet(os.path.join(str(tmp_path), "copy"))
    spark.read.parquet(os.path.join(str(tmp_path), "copy")).write.mode("overwrite").parquet(os.path.join(parts, first))
    assert rollup.statistics(stream_rollup.read_partials(spark, parts)).first().total_records == n_before


def test_landing_survives_a_failure_after_the_write(spark, tmp_path):
    import pytest

    spool, path, ck = (str(tmp_path / n) for n in ("spool", "landing", "ck"))
    write_spool(to_messages(readings(spark, SF_SMALL).repartitionByRange(3, "event_id")), spool)
    table = "landing_crash_tbl"
    catalog.drop_table(spark, table)
    catalog.create_table(spark, table, path, schema=landing.landing_schema(),
                         partition_by=["batch_id", "year", "month", "day", "hour"])
    failed = []

    def each(batch, batch_id):
        landing.land_batch(spark, batch, batch_id, path, table)
        if batch_id == 1 and not failed:
            failed.append(batch_id)
            raise RuntimeError("lost after writing batch 1, before the commit")

    def run():
        stored = ingest.to_stored(messages.parse_json(messages.read_spool(spark, spool, max_files_per_trigger=1)))
        q = stored.writeStream.foreachBatch(each).option("checkpointLocation", ck).trigger(availableNow=True).start()
        q.awaitTermination()

    with pytest.raises(Exception):
        run()
    run()  # restart: batch 1 is replayed and overwrites its own directory
    assert failed == [1]
    assert sorted(d for d in os.listdir(path) if d.startswith("batch_id=")) == ["batch_id=0", "batch_id=1", "batch_id=2"]
    assert spark.table(table).count() == clean.clean_stream(readings(spark, SF_SMALL)).count()
    catalog.drop_table(spark, table)
