"""Property tests: Spark expressions against plain-Python statements of the
same rules, over generated rows (a few DataFrames, many rows each)."""

from __future__ import annotations

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from meterlake.operators import clean
from meterlake.sources import text

SCHEMA = ("datetime timestamp, global_active_power double, global_reactive_power double, voltage double, "
          "global_intensity double, sub_metering_1 double, sub_metering_2 double, sub_metering_3 double")

small = st.integers(min_value=0, max_value=6).map(float)
measure = st.one_of(st.none(), st.integers(min_value=-5000, max_value=50000).map(lambda i: i / 1000))
moment = st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2030, 12, 31)).map(
    lambda d: d.replace(second=0, microsecond=0))

SLOW = settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def expected_zone(subs):
    top = max(subs)
    return f"zone{subs.index(top) + 1}"


@SLOW
@given(st.lists(st.tuples(small, small, small), min_size=1, max_size=60))
def test_zone_is_first_largest_submeter(spark, triples):
    rows = [(dt.datetime(2024, 1, 1), 1.0, 0.1, 230.0, 1.0, *t) for t in triples]
    got = [r.zone for r in clean.with_zone(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert got == [expected_zone(list(t)) for t in triples]


@SLOW
@given(st.lists(st.tuples(moment, *[measure] * 7), min_size=1, max_size=60))
def test_raw_text_round_trip(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    back = text.parse_raw_lines(df.select(text.raw_line().alias("value"))).collect()
    assert len(back) == len(rows)
    for src, got in zip(rows, back):
        assert got.datetime.replace(tzinfo=None) == src[0]
        for a, b in zip(src[1:], list(got)[1:]):
            assert (a is None and b is None) or abs(a - b) < 1e-9


@SLOW
@given(st.lists(st.tuples(moment, *[measure] * 7), min_size=1, max_size=60))
def test_stream_policy_matches_python_rule(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.datetime.replace(tzinfo=None), r.global_active_power, r.global_reactive_power)
                 for r in clean.clean_stream(df).collect())
    want = sorted((r[0], max(r[1], 0.0), max(r[2], 0.0)) for r in rows if all(v is not None for v in r))
    assert got == want


@SLOW
@given(
    st.dictionaries(
        st.integers(min_value=0, max_value=40),
        st.one_of(st.none(), st.integers(min_value=-1000, max_value=1000).map(lambda i: i / 10)),
        min_size=1,
        max_size=30,
    ),
    st.lists(st.integers(min_value=1, max_value=9), min_size=1, max_size=3, unique=True),
)
def test_align_shifted_equals_brute_force_join(spark, series, shifts):
    from pyspark.sql import functions as F

    from meterlake.operators.insights import align_shifted

    df = spark.createDataFrame([(t, v) for t, v in series.items()], "t int, v double")
    got = align_shifted(df, "t", "v", {f"lag_{s}": F.lit(s) for s in shifts}, current="cur").collect()
    got = {r.t: tuple(r[c] for c in ["cur", *[f"lag_{s}" for s in shifts]]) for r in got}
    # brute force: every time that is an input time or an input time + shift
    times = set(series) | {t + s for t in series for s in shifts}
    want = {t: (series.get(t), *[series.get(t - s) for s in shifts]) for t in times}
    assert got == want


@SLOW
@given(
    st.lists(
        st.tuples(
            st.integers(min_value=0, max_value=71),  # hour offset within three days
            st.one_of(st.none(), st.integers(min_value=2000, max_value=2500).map(lambda i: i / 10)),  # voltage
            st.integers(min_value=0, max_value=3000).map(lambda i: i / 1000),  # active power
            st.integers(min_value=0, max_value=3),  # which split (micro-batch) holds the row
        ),
        min_size=1,
        max_size=80,
    )
)
def test_rollup_of_splits_merges_to_rollup_of_whole(spark, rows):
    from meterlake.operators import features, reports, rollup

    base = dt.datetime(2024, 1, 1)
    data = [(base + dt.timedelta(hours=h, minutes=i % 60), a, 0.1, v, 1.0, 1.0, 2.0, 3.0, part)
            for i, (h, v, a, part) in enumerate(rows)]
    df = spark.createDataFrame(data, SCHEMA + ", part int")
    splits = None
    for p in sorted({r[-1] for r in data}):
        one = rollup.hourly_rollup(df.filter(f"part = {p}").drop("part"))
        splits = one if splits is None else splits.unionByName(one)
    whole = df.drop("part")
    key = ["year", "month", "day"]
    got = {tuple(r[k] for k in key): r for r in rollup.daily_features(splits).collect()}
    want = {tuple(r[k] for k in key): r for r in features.daily_features(whole).collect()}
    assert got.keys() == want.keys()
    for k, r in want.items():
        for c in ("avg_power_daily", "voltage_stability_daily", "total_submetering_daily", "avg_intensity_daily"):
            a, b = got[k][c], r[c]
            assert (a is None and b is None) or abs(a - b) <= 1e-9 * max(1.0, abs(b)), (k, c, a, b)
    stats_split, stats_whole = rollup.statistics(splits).first(), reports.statistics(whole).first()
    assert stats_split.total_records == stats_whole.total_records == len(data)
    assert stats_split.max_active_power == stats_whole.max_active_power
