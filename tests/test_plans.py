"""Plan checks: no Python UDFs, two shuffles for the multi-grain view,
filters reaching the Parquet scan, the catalogue broadcast."""

import os

from conftest import SF001
from pyspark.sql import functions as F

from eventrollup import registry as R
from eventrollup.operators import rollup, views
from eventrollup.operators.profiles import edge_profiles
from eventrollup.plans import serving
from eventrollup.sources import landing, master
from eventrollup.sources.tables import event_frame


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_no_python_udf_in_any_batch_query(spark):
    for key, fn in R.QUERIES.items():
        text = _optimized(fn(spark, SF001))
        assert "PythonUDF" not in text and "BatchEvalPython" not in text, key


def test_multi_grain_view_shuffles_raw_rows_once(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        view = rollup.multi_grain_view(event_frame(spark, SF001))
        plan = _plan(view)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Minutes, hours and the coarser grains: one exchange each, the first two reused.
    own = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert len(own) == 3 and plan.count("ReusedExchange") == 2 and plan.count("FileScan") == 1
    # Only the two needed columns are read from the events table.
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plan or \
        "ReadSchema: struct<event_type:string,ts:timestamp_ntz>" in plan


def test_view_range_read_pushes_filters(spark, tmp_dir):
    path = os.path.join(tmp_dir, "view")
    views.write_view(rollup.multi_grain_view(event_frame(spark, SF001)), path)
    rows = views.read_view(spark, path, codes=("H",), events=("click",), left=R.RANGE[0], right=R.RANGE[1])
    plan = _plan(rows)
    assert "PartitionFilters" in plan and "grain" in plan and "hour" in plan
    assert "PushedFilters" in plan and "bdate" in plan and "event" in plan


def test_cut_join_is_planned_without_a_cache(spark):
    batch, spd = R._batch_speed(spark, SF001)
    plan = _plan(serving.merged_cover(batch, spd, *R.RANGE))
    assert "InMemoryRelation" not in plan and "InMemoryTableScan" not in plan


def test_many_ranges_one_lookup_join(spark):
    """Both views' pieces of every request go through a single equi-join, and the
    request table is scanned once; ``narrow`` adds the semi joins that reduce each
    view below its profiles (AQE off: the static plan shape)."""
    batch, spd = R._batch_speed(spark, SF001)
    requests = (event_frame(spark, SF001)
                .selectExpr("monotonically_increasing_id() AS request_id", "event",
                            "ts - INTERVAL 20 HOURS AS from_ts", "ts + INTERVAL 40 HOURS AS to_ts"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan, narrow = (_plan(serving.count_many_ranges(requests, batch, spd, horizon=R.BATCH_BEFORE, narrow=n)) for n in (False, True))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("SortMergeJoin") + plan.count("BroadcastHashJoin") + plan.count("ShuffledHashJoin") == 1
    assert plan.count("events.parquet") == 1
    joins = [line for line in narrow.split("\n") if "Join" in line]
    semi, outer = (sum(kind in line for line in joins) for kind in ("LeftSemi", "LeftOuter"))
    # The speed side is a union (stored and summed grains), which the semi join enters.
    assert outer == 1 and semi == 3 and len(joins) == 4


def test_profiles_hold_only_what_is_asked_for(spark):
    view = rollup.multi_grain_view(event_frame(spark, SF001))
    wanted = view.where((F.col("bucket") == "D") & (F.col("event") == "click")).limit(2) \
        .select("event", F.lit("H").alias("bucket"), F.col("bdate").alias("parent"))
    rows = edge_profiles(view, ("m", "H"), wanted).collect()
    whole = {(r["event"], r["bucket"], r["parent"]): r["cum"] for r in edge_profiles(view, ("m", "H")).collect()}
    assert len(rows) == 2 < len(whole) and all(whole[r["event"], r["bucket"], r["parent"]] == r["cum"] for r in rows)


def test_serving_prunes_year_folders(spark):
    """Views read with their year folder: the cover's literal bounds prune
    `period=` folders of both the batch view and the speed partials."""
    batch, spd = R._batch_speed(spark, SF001)
    plan = _plan(serving.count_by_period(batch, spd, *R.RANGE))
    scans = [line for line in plan.split("\n") if "PartitionFilters" in line and "grain" in line]
    pruned = [line for line in scans if "period" in line and ">= 2024" in line and "<= 2024" in line]
    assert len(pruned) >= 2


def test_refresh_reads_only_the_touched_days(spark, tmp_dir):
    from eventrollup.plans import batch as runs
    from eventrollup.sources import landing

    land, mdir, vpath, ckpt = (os.path.join(tmp_dir, n) for n in ("l", "m", "v", "c"))
    ev = event_frame(spark, SF001)
    landing.land_batch(landing.to_raw_json(ev.where("ts < timestamp_ntz'2024-01-15 12:00:00'")), land)
    runs.refresh(spark, land, mdir, vpath, ckpt)
    rows = runs.recount(spark, mdir, vpath, [(2024, 1, 3), (2024, 1, 9)])
    scans = [line for line in _plan(rows).split("\n") if "FileScan" in line and "minute" in line]
    assert scans and all("PartitionFilters" in s and "day" in s for s in scans)
    read = set()
    for f in runs.master.read_days(spark, mdir, [(2024, 1, 3), (2024, 1, 9)]).select("_metadata.file_path").distinct().collect():
        read.add(f[0].split("/day=")[1].split("/")[0])
    assert read == {"3", "9"}
    # A late file for one day, then nothing new: the view stays exact.
    landing.land_batch(landing.to_raw_json(ev.where("ts >= timestamp_ntz'2024-01-15 12:00:00'")), land)
    for _ in range(2):
        runs.refresh(spark, land, mdir, vpath, ckpt)
        assert views.read_view(spark, vpath).exceptAll(rollup.multi_grain_view(ev)).isEmpty()


def _scanned_rows(df):
    """Rows that the (last) file scan handed on when ``df`` was run."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return [leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size())
            if leaves.apply(i).metrics().contains("numOutputRows")][-1]


def _many_minutes(spark, days):
    """One event every two minutes of ``days`` days, three names."""
    start = F.lit("2024-01-01 00:00:10").cast("timestamp_ntz")
    return spark.range(0, days * 720, numPartitions=1).select(
        F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("c"))).alias("event"),
        F.timestamp_add("MINUTE", F.col("id").cast("int") * 2, start).alias("ts"))


def test_range_reads_skip_pages(spark, tmp_dir):
    """A read of one event's two days decodes a part of the folder only."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        path = os.path.join(tmp_dir, "view")
        views.write_view(rollup.multi_grain_view(_many_minutes(spark, 180), ("m",)).coalesce(1), path)
        rows = views.read_view(spark, path, codes=("m",), events=("b",), left="2024-05-01 00:00:00", right="2024-05-03 00:00:00")
        assert rows.count() == 2 * 720 and _scanned_rows(rows) < 3 * 180 * 720 / 3
        served = views.read_view(spark, path, with_period=True)
        one = serving.view_cover(served, "2024-05-01 00:00:00", "2024-05-03 00:00:00", ("m",), events="b")
        assert one.count() == 2 * 720 and _scanned_rows(one) < 3 * 180 * 720 / 3
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_master_range_skips_pages_inside_a_day(spark, tmp_dir):
    path = os.path.join(tmp_dir, "master")
    second = spark.range(0, 86400, numPartitions=1).select(
        F.lit("a").alias("event"), F.timestamp_add("SECOND", F.col("id").cast("int"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")).alias("ts"))
    lines = landing.to_raw_json(second.orderBy(F.xxhash64("ts")))
    master.write_master(master.to_master(landing.good_rows(landing.parse_raw(lines))), path)
    part = master.read_master(spark, path, "2024-01-01 10:00:00.5", "2024-01-01 10:30:00.5")
    assert "GreaterThanOrEqual(at," in _plan(part) and "cast(timestamp" not in _plan(part)
    assert part.count() == 1800 and _scanned_rows(part) < 86400 / 2
