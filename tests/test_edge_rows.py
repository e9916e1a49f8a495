"""Edge rows (FIXTURES.md §2) through parsing, cleaning, features, reports."""

from __future__ import annotations

import datetime as dt
import json
import math

from pyspark.sql import functions as F

from meterlake.operators import clean, features, insights, reports
from meterlake.schema import RAW_HEADER
from meterlake.sources import messages, text

HEADER = ";".join(RAW_HEADER)
NORMAL = "16/12/2006;17:24:00;4.216;0.418;234.840;18.400;0.000;1.000;17.000"


def parse(lines_df, lines):
    return text.parse_raw_lines(lines_df(lines))


def test_normal_line_parses_and_labels(lines_df):
    rows = parse(lines_df, [NORMAL]).collect()
    assert len(rows) == 1
    r = rows[0]
    assert r.datetime.replace(tzinfo=None) == dt.datetime(2006, 12, 16, 17, 24)
    assert (r.global_active_power, r.voltage, r.sub_metering_3) == (4.216, 234.84, 17.0)
    z = clean.clean_stream(parse(lines_df, [NORMAL])).select("zone", "year", "month", "day", "hour").first()
    assert tuple(z) == ("zone3", 2006, 12, 16, 17)


def test_unpadded_date(lines_df):
    r = parse(lines_df, ["1/1/2007;00:00:00;1;1;230;1;0;0;0"]).first()
    assert r.datetime.replace(tzinfo=None) == dt.datetime(2007, 1, 1)


def test_missing_markers_become_null_and_row_is_dropped(lines_df):
    df = parse(lines_df, ["28/4/2007;00:21:00;?;?;?;?;?;?;"])
    r = df.first()
    assert all(getattr(r, c) is None for c in df.columns[1:])
    assert clean.clean_stream(df).count() == 0


def test_header_and_blank_lines_are_skipped(lines_df):
    assert parse(lines_df, [HEADER, "", "   ", NORMAL]).count() == 1


def test_padded_number(lines_df):
    r = parse(lines_df, ["16/12/2006;17:24:00; 1.5 ;0.1;230;1;0;0;0"]).first()
    assert r.global_active_power == 1.5


def test_bad_date_is_null_counted_and_dropped(lines_df):
    df = parse(lines_df, ["x;y;1;1;230;1;0;0;0", NORMAL])
    assert df.filter(F.col("datetime").isNull()).count() == 1
    q = insights.quality(df).first()
    assert q.missing_datetime == 1 and q.total_records == 2
    assert clean.clean_stream(df).count() == 1


def test_csv_reader_file_with_header_and_blank_line(spark, tmp_path):
    p = tmp_path / "household.txt"
    p.write_text("\n".join([HEADER, NORMAL, "", "1/1/2007;00:00:00;?;?;?;?;?;?;"]) + "\n")
    df = text.read_raw(spark, str(p))
    assert df.count() == 2
    assert clean.clean_stream(df).count() == 1
    assert df.columns == ["datetime", "global_active_power", "global_reactive_power", "voltage",
                          "global_intensity", "sub_metering_1", "sub_metering_2", "sub_metering_3"]


def test_bad_json_gives_nulls_and_is_dropped(lines_df):
    df = messages.parse_json(lines_df(["not json"]))
    r = df.first()
    assert all(v is None for v in r)
    assert clean.clean_stream(df).count() == 0


def test_json_number_as_string_nulls_only_that_field(lines_df):
    doc = {"datetime": "2006-12-16 17:24:00", "global_active_power": 1.0, "global_reactive_power": 0.1,
           "voltage": "234.8", "global_intensity": 1.0, "sub_metering_1": 0.0,
           "sub_metering_2": 0.0, "sub_metering_3": 1.0}
    r = messages.parse_json(lines_df([json.dumps(doc)])).first()
    assert r.voltage is None
    assert r.global_active_power == 1.0 and r.datetime is not None


def _reading(spark, **kw):
    base = dict(datetime=dt.datetime(2006, 12, 16, 17, 24), global_active_power=1.0, global_reactive_power=0.1,
                voltage=230.0, global_intensity=1.0, sub_metering_1=0.0, sub_metering_2=0.0, sub_metering_3=1.0)
    base.update(kw)
    return base


def _frame(spark, rows):
    schema = ("datetime timestamp, global_active_power double, global_reactive_power double, voltage double, "
              "global_intensity double, sub_metering_1 double, sub_metering_2 double, sub_metering_3 double")
    cols = schema.split(", ")
    names = [c.split()[0] for c in cols]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], schema)


def test_nan_measure_dropped(spark):
    df = _frame(spark, [_reading(spark, voltage=float("nan")), _reading(spark)])
    assert clean.clean_stream(df).count() == 1


def test_negative_and_zero_active_policies(spark):
    df = _frame(spark, [_reading(spark, global_active_power=-0.5), _reading(spark, global_active_power=0.0)])
    stream = clean.clean_stream(df).select("global_active_power").collect()
    assert sorted(r[0] for r in stream) == [0.0, 0.0]
    assert clean.clean_batch(df).count() == 0
    ratio = features.row_features(clean.clean_stream(df)).select("reactive_ratio").collect()
    assert all(r[0] is None for r in ratio)


def test_negative_reactive_clamped_null_kept_in_expression(spark):
    df = _frame(spark, [_reading(spark, global_reactive_power=-0.2)])
    assert clean.clean_stream(df).first().global_reactive_power == 0.0


def test_zero_voltage(spark):
    df = _frame(spark, [_reading(spark, voltage=0.0)])
    assert features.row_features(df).first().power_per_voltage is None


def test_zone_ties(spark):
    df = _frame(spark, [
        _reading(spark, sub_metering_1=5.0, sub_metering_2=5.0, sub_metering_3=1.0),
        _reading(spark, sub_metering_1=1.0, sub_metering_2=5.0, sub_metering_3=5.0),
        _reading(spark, sub_metering_1=0.0, sub_metering_2=0.0, sub_metering_3=0.0),
    ])
    zones = [r.zone for r in clean.with_zone(df).collect()]
    assert zones == ["zone1", "zone2", "zone1"]


def test_one_row_day_has_null_stability(spark):
    df = _frame(spark, [_reading(spark)])
    assert features.daily_features(df).first().voltage_stability_daily is None


def test_empty_table_statistics(spark):
    df = _frame(spark, [_reading(spark)]).limit(0)
    r = reports.statistics(df).first()
    assert r.total_records == 0 and r.avg_active_power is None and r.total_sub_metering is None


def test_saturday_is_weekend(spark):
    df = _frame(spark, [_reading(spark, datetime=dt.datetime(2006, 12, 16, 10, 0))])
    r = features.row_features(df).first()
    assert (r.weekday, r.is_weekend) == (7, 1)


def test_sub_total_skips_rows_with_a_null_submeter(spark):
    df = _frame(spark, [_reading(spark, sub_metering_2=None), _reading(spark)])
    assert reports.statistics(df).first().total_sub_metering == 1.0


def test_raw_line_round_trip(spark):
    df = _frame(spark, [_reading(spark, global_active_power=None)])
    line = df.select(text.raw_line().alias("value"))
    assert line.first().value == "16/12/2006;17:24:00;?;0.100;230.000;1.000;0.000;0.000;1.000"
    back = text.parse_raw_lines(line).first()
    assert back.global_active_power is None and back.voltage == 230.0


def test_message_round_trip_is_identity(spark):
    df = _frame(spark, [_reading(spark), _reading(spark, global_intensity=None)])
    back = messages.parse_json(__import__("meterlake.sinks.messages", fromlist=["x"]).to_messages(df))
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def test_wire_message_has_required_fields(spark):
    from meterlake.sinks.messages import to_messages

    doc = json.loads(to_messages(_frame(spark, [_reading(spark)])).first().value)
    assert list(doc) == ["datetime", "global_active_power", "global_reactive_power", "voltage",
                         "global_intensity", "sub_metering_1", "sub_metering_2", "sub_metering_3"]
    assert doc["datetime"] == "2006-12-16 17:24:00"
    assert not any(isinstance(v, float) and math.isnan(v) for v in doc.values())


def test_legacy_wire(lines_df):
    r = messages.parse_json_zone(lines_df(['{"timestamp": "2024-01-01 00:00:00", "zone": "zone2", "power": 1.5}'])).first()
    assert tuple(r) == ("2024-01-01 00:00:00", "zone2", 1.5)


def test_daily_from_rollup_edge_days(spark):
    df = _frame(spark, [
        _reading(spark),  # one reading: stddev NULL
        _reading(spark, datetime=dt.datetime(2006, 12, 17, 1, 0), voltage=None),  # no voltage at all
        _reading(spark, datetime=dt.datetime(2006, 12, 18, 1, 0), voltage=230.0),
        _reading(spark, datetime=dt.datetime(2006, 12, 18, 2, 0), voltage=230.0),  # zero spread
    ])
    from meterlake.operators import rollup

    rows = {r.day: r for r in rollup.daily_features(rollup.hourly_rollup(df)).collect()}
    assert rows[16].voltage_stability_daily is None
    assert rows[17].voltage_stability_daily is None
    assert rows[18].voltage_stability_daily == 0.0


def test_binary_message_values_parse(spark):
    from meterlake.sinks.messages import to_messages

    msgs = to_messages(_frame(spark, [_reading(spark)])).selectExpr("CAST(value AS BINARY) AS value")
    assert msgs.schema["value"].dataType.simpleString() == "binary"
    r = messages.parse_json(msgs).first()
    assert r.voltage == 230.0 and r.datetime.replace(tzinfo=None) == dt.datetime(2006, 12, 16, 17, 24)


def test_header_names_with_spaces_read_by_position(spark, tmp_path):
    p = tmp_path / "spaced.txt"
    p.write_text(" Date ; Time ;Global_active_power ; Global_reactive_power;Voltage;Global_intensity;"
                 "Sub_metering_1;Sub_metering_2;Sub_metering_3\n" + NORMAL + "\n")
    r = text.read_raw(spark, str(p)).first()
    assert r.global_active_power == 4.216 and r.sub_metering_3 == 17.0


def test_display_rounding_follows_binary_value(spark):
    from meterlake.functions.display import rounded

    values = [1.005, -1.005, 0.125, 2.675, 123.4567]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r.y for r in df.select(rounded(F.col("x"), 2).alias("y")).collect()]
    # the scaled binary value rounded half away from zero, as C and DuckDB do
    want = [math.copysign(math.floor(abs(v) * 100 + 0.5), v) / 100 for v in values]
    assert got == want == [1.0, -1.0, 0.13, 2.68, 123.46]
