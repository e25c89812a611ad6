"""Property tests on small random event lists (hypothesis).

Events and ranges are drawn on the driver, then one Spark job per example
checks: cover sum = contained minutes; cover rows never overlap; the
generated cover keys equal the filtered cover rows; cascade = direct.
"""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from eventrollup.functions.buckets import ALL_LEVELS, GRAIN_CODES, bucket_end_for, bucket_start
from eventrollup.operators import rollup
from eventrollup.plans import serving
from eventrollup.plans.cover import cover_keys

BASE = dt.datetime(2015, 12, 20)
offsets = st.integers(min_value=0, max_value=60 * 24 * 90)  # minutes over ~3 months
seconds = st.integers(min_value=0, max_value=59)
event_lists = st.lists(st.tuples(offsets, seconds), min_size=1, max_size=25)
levels_st = st.sampled_from([("D", "H", "M", "Y", "m"), ("Y", "M", "D", "H", "m"), ("D", "H", "m"),
                             ("H", "m"), ("m",), ("M", "m")])
SETTINGS = settings(max_examples=10, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture])


def _frame(spark, evs):
    rows = [("E", (BASE + dt.timedelta(minutes=o, seconds=s)).isoformat(sep=" ")) for o, s in evs]
    return spark.createDataFrame(rows, "event string, t string").select(
        "event", F.col("t").cast("timestamp_ntz").alias("ts"))


def _truth(evs, lo, hi):
    n = 0
    for o, s in evs:
        minute = BASE + dt.timedelta(minutes=o)
        if minute >= lo and minute + dt.timedelta(minutes=1) <= hi:
            n += 1
    return n


@SETTINGS
@given(evs=event_lists, a=offsets, b=offsets, sa=seconds, levels=levels_st)
def test_cover_sum_equals_contained_minutes(spark, evs, a, b, sa, levels):
    lo = BASE + dt.timedelta(minutes=min(a, b), seconds=sa)
    hi = BASE + dt.timedelta(minutes=max(a, b))
    hi = max(hi, lo)
    view = rollup.multi_grain_view(_frame(spark, evs)).cache()
    cover = serving.view_cover(view, lo, hi, levels)
    rows = cover.select("bucket", "bdate", bucket_end_for("bucket", "bdate").alias("end"), "count").collect()
    assert sum(r["count"] for r in rows) == _truth(evs, lo, hi)
    spans = sorted((r["bdate"], r["end"]) for r in rows)
    for (s1, e1), (s2, _) in zip(spans, spans[1:]):
        assert e1 <= s2  # no overlap
    # Keys generated from the bounds alone select the same rows.
    keys = (view.sparkSession.range(1)
            .select(F.explode(cover_keys(levels, lo, hi)).alias("k"))
            .select(F.lit("E").alias("event"), "k.bucket", "k.bdate"))
    joined = keys.join(view, ["event", "bucket", "bdate"])
    assert sorted((r["bucket"], r["bdate"]) for r in joined.collect()) == \
        sorted((r["bucket"], r["bdate"]) for r in rows)
    view.unpersist()


@SETTINGS
@given(evs=event_lists)
def test_cascade_equals_direct(spark, evs):
    ev = _frame(spark, evs)
    casc = rollup.cascade(ev)
    for code in GRAIN_CODES:
        direct = ev.groupBy("event", bucket_start(code, "ts").alias("bdate")).agg(
            F.count(F.lit(1)).alias("count"))
        assert sorted(map(tuple, casc[code].collect())) == sorted(map(tuple, direct.collect()))


@SETTINGS
@given(evs=event_lists, a=offsets, b=offsets)
def test_merge_with_empty_speed_is_batch(spark, evs, a, b):
    lo = BASE + dt.timedelta(minutes=min(a, b), seconds=7)
    hi = max(BASE + dt.timedelta(minutes=max(a, b), seconds=3), lo)
    view = rollup.multi_grain_view(_frame(spark, evs))
    empty = view.limit(0)
    merged = serving.merged_cover(view, empty, lo, hi, ALL_LEVELS)
    alone = serving.view_cover(view, lo, hi, ALL_LEVELS)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, alone.collect()))


@SETTINGS
@given(evs=event_lists, reqs=st.lists(st.tuples(offsets, seconds, offsets, seconds), min_size=1, max_size=8),
       hz=offsets)
def test_many_ranges_equal_brute_force(spark, evs, reqs, hz):
    """Edge-profile lookups + coarse keys give the contained-minute total per request,
    with one view and with a batch/speed split at a minute-aligned horizon."""
    ev = _frame(spark, evs)
    rows = []
    for i, (a, sa, b, sb) in enumerate(reqs):
        lo = BASE + dt.timedelta(minutes=a, seconds=sa)
        hi = BASE + dt.timedelta(minutes=b, seconds=sb)
        rows.append((i, "E", lo, hi))
    requests = spark.createDataFrame(rows, "request_id int, event string, from_ts timestamp_ntz, to_ts timestamp_ntz")
    view = rollup.multi_grain_view(ev)
    got = {r["request_id"]: r["count"] for r in serving.count_many_ranges(requests, view).collect()}
    h = BASE + dt.timedelta(minutes=hz)
    h_lit = F.lit(h.isoformat(sep=" ")).cast("timestamp_ntz")
    batch = rollup.multi_grain_view(ev.where(F.col("ts") < h_lit))
    spd = rollup.multi_grain_view(ev.where(F.col("ts") >= h_lit), ("m", "H"))
    split = {r["request_id"]: r["count"] for r in
             serving.count_many_ranges(requests, batch, spd, horizon=h).collect()}
    for i, _, lo, hi in rows:
        want = _truth(evs, lo, hi) if hi >= lo else None
        assert got[i] == want
        assert split[i] == want
