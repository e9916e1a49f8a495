"""The original pipeline end to end: raw household text →
producer publishes JSON messages → streaming consumer lands partitioned
Parquet behind a catalog table → the four dashboard reports as JSON."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from meterlake.operators import clean, reports
from meterlake.plans import catalog
from meterlake.plans.queries import checked
from meterlake.schema import RAW_HEADER
from meterlake.sinks.messages import result_json, to_messages, write_spool
from meterlake.sources import messages, text
from meterlake.sources.readings import readings
from meterlake.streaming import ingest

from data_dirs import SF_SMALL


def _json_rows(df):
    return sorted(json.dumps(json.loads(r.json), sort_keys=True) for r in result_json(checked(df)).collect())


def test_raw_file_to_dashboard(spark, tmp_path):
    raw, spool, data, ck = (str(tmp_path / n) for n in ("raw", "spool", "data", "ck"))
    header = spark.createDataFrame([(";".join(RAW_HEADER),)], "value string")
    header.union(readings(spark, SF_SMALL).select(text.raw_line().alias("value"))).coalesce(1).write.text(raw)

    # producer: load, drop incomplete rows, publish one JSON message per reading
    produced = text.read_raw(spark, raw).na.drop()
    write_spool(to_messages(produced), spool)

    # consumer: table first, then the stream (append, checkpointed)
    parsed = messages.parse_json(messages.read_spool(spark, spool))
    q = ingest.start_ingest(spark, parsed, data, ck, table="energy_data_e2e", trigger={"availableNow": True})
    q.awaitTermination()
    table = catalog.read_table(spark, "energy_data_e2e")

    # the same readings cleaned in batch: the reference answers
    expected = clean.clean_stream(text.read_raw(spark, raw))
    assert table.count() == expected.count() == produced.count()

    for report in (
        lambda d, stored: reports.latest(d, limit=100, partitioned=stored,
                                         tiebreak=["global_active_power", "global_reactive_power", "voltage",
                                                   "global_intensity", "sub_metering_1", "sub_metering_2",
                                                   "sub_metering_3"]),
        lambda d, stored: reports.statistics(d),
        lambda d, stored: reports.timeseries(d, limit=100, partitioned=stored),
        lambda d, stored: reports.hour_profile(d),
    ):
        assert _json_rows(report(table, True)) == _json_rows(report(expected, False))

    # stored layout: partition columns from the directory tree, zone kept
    assert set(catalog.partition_columns(spark, "energy_data_e2e")) == {"year", "month", "day", "hour"}
    assert table.filter(F.col("zone").isNull()).count() == 0
    catalog.drop_table(spark, "energy_data_e2e")
