"""Catalog operations, file sinks, settings and source options."""

from __future__ import annotations

import csv
import glob
import os

import pytest
from pyspark.sql import functions as F

from meterlake.operators import reports
from meterlake.plans import catalog
from meterlake.plans.sql import parquet_source, run_sql
from meterlake.settings import Settings
from meterlake.sinks import files
from meterlake.sinks.messages import result_json
from meterlake.sources import messages, text
from meterlake.sources.readings import readings
from meterlake.streaming import ingest

from data_dirs import SF_SMALL


@pytest.fixture()
def stored(spark):
    return ingest.to_stored(readings(spark, SF_SMALL))


def test_table_lifecycle(spark, stored, tmp_path):
    path = str(tmp_path / "t")
    files.write_parquet(stored, path, partition_by=("year", "month", "day", "hour"))
    catalog.create_table(spark, "life_tbl", path)
    assert catalog.table_exists(spark, "life_tbl")
    assert "life_tbl" in catalog.list_tables(spark)
    assert catalog.partition_columns(spark, "life_tbl") == ["year", "month", "day", "hour"]
    assert spark.table("life_tbl").count() == 0  # partitions not registered yet
    catalog.repair(spark, "life_tbl")
    assert spark.table("life_tbl").count() == stored.count()
    catalog.drop_table(spark, "life_tbl")
    assert not catalog.table_exists(spark, "life_tbl")
    assert spark.read.parquet(path).count() == stored.count()  # external: files stay


def test_ensure_table_recreates_unpartitioned_table(spark, stored, tmp_path):
    path = str(tmp_path / "t")
    files.write_parquet(stored, path, partition_by=("year", "month", "day", "hour"))
    spark.sql(f"CREATE TABLE flat_tbl USING parquet LOCATION '{tmp_path / 'other'}' AS SELECT 1 AS x")
    assert catalog.partition_columns(spark, "flat_tbl") == []
    catalog.drop_table(spark, "flat_tbl")
    spark.sql(f"CREATE TABLE flat_tbl (x INT) USING parquet LOCATION '{tmp_path / 'other'}'")
    assert catalog.ensure_table(spark, "flat_tbl", path) is True
    assert catalog.partition_columns(spark, "flat_tbl") == ["year", "month", "day", "hour"]
    assert spark.table("flat_tbl").count() == stored.count()
    assert catalog.ensure_table(spark, "flat_tbl", path) is False
    catalog.drop_table(spark, "flat_tbl")


def test_managed_tables_are_never_dropped(spark, tmp_path):
    spark.range(3).write.mode("overwrite").saveAsTable("own_tbl")
    with pytest.raises(ValueError):
        catalog.ensure_table(spark, "own_tbl", str(tmp_path / "t"))
    with pytest.raises(ValueError):
        catalog.drop_table(spark, "own_tbl")
    assert spark.table("own_tbl").count() == 3
    spark.sql("DROP TABLE own_tbl")


def test_ensure_table_follows_the_location(spark, stored, tmp_path):
    one, two = str(tmp_path / "it's one"), str(tmp_path / "two")
    files.write_parquet(stored, one, partition_by=("year", "month", "day", "hour"))
    files.write_parquet(stored.limit(5), two, partition_by=("year", "month", "day", "hour"))
    assert catalog.ensure_table(spark, "moved_tbl", one) is True
    assert spark.table("moved_tbl").count() == stored.count()
    with pytest.raises(ValueError):
        catalog.create_table(spark, "moved_tbl", two)
    assert catalog.ensure_table(spark, "moved_tbl", two) is True
    assert spark.table("moved_tbl").count() == 5
    assert catalog.ensure_table(spark, "moved_tbl", "file:" + two) is False
    catalog.drop_table(spark, "moved_tbl")
    with pytest.raises(ValueError):
        catalog.add_partitions(spark, "moved_tbl", [{"year": None}])


@pytest.mark.parametrize("form", ["{}", "file:{}", "file://{}", "{}/", "{}/below"])
def test_overlap_in_every_spelling(spark, stored, tmp_path, form):
    path = str(tmp_path / "t")
    files.write_parquet(stored, path)
    with pytest.raises(ValueError):
        files.write_parquet(spark.read.parquet(path).filter("voltage > 1"), form.format(path))
    files.write_parquet(spark.read.parquet(path), path + "-beside")


def test_add_partitions(spark, stored, tmp_path):
    path = str(tmp_path / "t")
    files.write_parquet(stored, path, partition_by=("year", "month", "day", "hour"))
    catalog.create_table(spark, "add_tbl", path)
    first = stored.select("year", "month", "day", "hour").orderBy("year", "month", "day", "hour").first().asDict()
    catalog.add_partitions(spark, "add_tbl", [first, first])
    expected = stored.filter(" AND ".join(f"{k} = {v}" for k, v in first.items())).count()
    assert spark.table("add_tbl").count() == expected
    catalog.drop_table(spark, "add_tbl")


def test_year_slice_prunes_partitions(spark, stored, tmp_path):
    path = str(tmp_path / "t")
    files.write_parquet(stored, path, partition_by=("year", "month", "day", "hour"))
    plan = reports.year_slice(spark.read.parquet(path), 2024)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan and "(year#" in plan


def test_write_refuses_overlap(spark, stored, tmp_path):
    path = str(tmp_path / "t")
    files.write_parquet(stored, path)
    src = spark.read.parquet(path)
    with pytest.raises(ValueError):
        files.write_parquet(src, path)
    with pytest.raises(ValueError):
        files.write_parquet(src, str(tmp_path))


def test_export_csv(spark, tmp_path):
    df = reports.hour_profile(ingest.to_stored(readings(spark, SF_SMALL)))
    out = str(tmp_path / "csv")
    files.export_csv(df, out)
    parts = glob.glob(os.path.join(out, "part-*.csv"))
    rows = [r for p in parts for r in csv.DictReader(open(p))]
    assert len(rows) == df.count() and set(rows[0]) == set(df.columns)


def test_compact_coarser_layout(spark, stored, tmp_path):
    src, dst = str(tmp_path / "fine"), str(tmp_path / "coarse")
    files.write_parquet(stored, src, partition_by=("year", "month", "day", "hour"))
    files.compact(spark.read.parquet(src), dst, partition_by=("year", "month"))
    coarse = spark.read.parquet(dst)
    assert coarse.count() == stored.count()
    assert set(coarse.columns) >= {"datetime", "year", "month", "zone"}
    assert all(not d.startswith("day=") for _, dirs, _ in os.walk(dst) for d in dirs)


def test_result_json_iso_and_nulls(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 05:03:00' AS datetime, CAST(NULL AS DOUBLE) AS x, 1.5BD AS d")
    assert result_json(df).first().json == '{"datetime":"2024-01-01T05:03:00","x":null,"d":1.5}'


def test_sql_passthrough_raises_on_error(spark):
    with pytest.raises(Exception):
        run_sql(spark, "SELECT * FROM no_such_table_anywhere").collect()


def test_sql_over_parquet_path(spark, stored, tmp_path):
    path = str(tmp_path / "t")
    files.write_parquet(stored, path)
    n = run_sql(spark, f"SELECT COUNT(*) AS n FROM {parquet_source(path)}").first().n
    assert n == stored.count()


def test_preview_limit(spark, stored):
    assert reports.preview(stored, 10).count() == 10


def test_settings_from_env():
    s = Settings.from_env({"KAFKA_BROKER": "a:1, b:2", "KAFKA_TOPIC": "t", "SPARK_PROCESSING_INTERVAL": "5",
                           "KAFKA_FAIL_ON_DATA_LOSS": "true"})
    assert s.brokers == ["a:1", "b:2"] and s.kafka_topic == "t" and s.trigger_seconds == 5 and s.fail_on_data_loss
    assert Settings.from_env({}) == Settings()


def test_kafka_options():
    opts = messages.kafka_options(Settings(kafka_brokers="k1:9092,k2:9093"), starting_offsets="latest")
    assert opts == {"kafka.bootstrap.servers": "k1:9092,k2:9093", "subscribe": "energy_stream",
                    "startingOffsets": "latest", "failOnDataLoss": "false"}
    capped = messages.kafka_options(Settings.from_env({"KAFKA_MAX_OFFSETS_PER_TRIGGER": "100000",
                                                       "KAFKA_MIN_PARTITIONS": "64"}))
    assert capped["maxOffsetsPerTrigger"] == "100000" and capped["minPartitions"] == "64"


def test_missing_path_raises(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        text.read_raw(spark, str(tmp_path / "absent.txt")).count()


def test_directory_is_a_legal_raw_input(spark, tmp_path):
    d = tmp_path / "raw"
    d.mkdir()
    (d / "a.txt").write_text("Date;Time;Global_active_power;Global_reactive_power;Voltage;Global_intensity;"
                             "Sub_metering_1;Sub_metering_2;Sub_metering_3\n16/12/2006;17:24:00;1;1;230;1;0;0;0\n")
    (d / "b.txt").write_text("Date;Time;Global_active_power;Global_reactive_power;Voltage;Global_intensity;"
                             "Sub_metering_1;Sub_metering_2;Sub_metering_3\n16/12/2006;17:25:00;1;1;230;1;0;0;0\n")
    assert text.read_raw(spark, str(d)).filter(F.col("datetime").isNotNull()).count() == 2


def test_sorted_partitioned_write_keeps_time_order_per_file(spark, stored, tmp_path):
    import pyarrow.parquet as pq

    path = str(tmp_path / "sorted")
    files.write_parquet(stored, path, partition_by=("year", "month"), sort_by=("datetime",))
    for f in glob.glob(os.path.join(path, "year=*", "month=*", "*.parquet")):
        times = pq.read_table(f, columns=["datetime"]).column(0).to_pylist()
        assert times == sorted(times)


def test_other_meter_layout(spark):
    from meterlake.operators import clean, features, insights
    from meterlake.schema import Meter

    m = Meter(time="ts", active="p", reactive="q", voltage="u", intensity="i", submeters=("a", "b"))
    src = readings(spark, SF_SMALL).select(
        F.col("datetime").alias("ts"), F.col("global_active_power").alias("p"),
        F.col("global_reactive_power").alias("q"), F.col("voltage").alias("u"),
        F.col("global_intensity").alias("i"), F.col("sub_metering_1").alias("a"),
        F.col("sub_metering_2").alias("b"))
    cleaned = clean.clean_stream(src, m)
    assert set(r.zone for r in cleaned.select("zone").distinct().collect()) <= {"zone1", "zone2"}
    assert reports.hour_profile(cleaned, m).count() == 24
    assert features.daily_features(cleaned, m).count() > 0
    assert insights.peaks(cleaned, meter=m).count() >= 0
    assert reports.latest(cleaned, 5, m).columns == ["ts", "p", "q", "u", "i", "a", "b"]


def test_shared_dir_refuses_machine_local_folder_on_a_cluster():
    from types import SimpleNamespace

    from meterlake.session import checkpoint_root

    unset = SimpleNamespace(isDefined=lambda: False)
    sc = SimpleNamespace(
        master="yarn",
        getConf=lambda: SimpleNamespace(get=lambda key, default=None: default),
        _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: unset)),
    )
    fake = SimpleNamespace(sparkContext=sc, conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(fake)
    named = SimpleNamespace(sparkContext=SimpleNamespace(**{**vars(sc), "setCheckpointDir": lambda d: None}),
                            conf=SimpleNamespace(get=lambda key, default=None: "hdfs://shared/ckpt"))
    assert checkpoint_root(named) == "hdfs://shared/ckpt"


def test_publish_kafka_without_connector_raises(spark):
    from meterlake.sinks.messages import publish_kafka, to_messages

    msgs = to_messages(readings(spark, SF_SMALL).limit(3))
    with pytest.raises(Exception, match="(?i)kafka"):
        publish_kafka(msgs, Settings(kafka_brokers="localhost:1"))
