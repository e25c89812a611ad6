"""Hand-made edge fixtures (FIXTURES.md section 3)."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import SF001, SF0001, events_df
from eventrollup.functions.buckets import bucket_end, bucket_start
from eventrollup.operators import rollup, views
from eventrollup.plans import serving
from eventrollup.sources import landing, master
from eventrollup.streaming import speed

CATALOGUE = ("LOGIN_WEB", "LOGIN_MOBILE", "BANK_TRANSFER", "PAY_BILL", "VIEW_STATEMENT", "CREATE_ACCOUNT")


def _counts(df):
    return {(r["bucket"], r["bdate"]): r["count"] for r in df.collect()}


def test_readme_sample_counts_duplicates(spark):
    ev = events_df(spark, [("AAA", "2015-06-10 12:54:43"), ("AAA", "2015-06-10 12:54:43"),
                           ("AAA", "2015-06-10 14:54:43"), ("ZZZ", "2015-06-25 12:54:43"),
                           ("ZZZ", "2015-06-25 12:54:53")])
    m = {(r["event"], r["bdate"]): r["count"] for r in rollup.minute_counts(ev).collect()}
    assert m[("AAA", dt.datetime(2015, 6, 10, 12, 54))] == 2
    assert m[("AAA", dt.datetime(2015, 6, 10, 14, 54))] == 1
    assert m[("ZZZ", dt.datetime(2015, 6, 25, 12, 54))] == 2


def test_one_event_per_minute(spark):
    ev = (spark.range(0, 2 * 1440)
          .select(F.lit("E").alias("event"),
                  F.timestamp_add("MINUTE", F.col("id").cast("int"),
                                  F.lit(dt.datetime(2016, 2, 28)).cast("timestamp_ntz")).alias("ts")))
    view = rollup.multi_grain_view(ev)
    got = view.groupBy("bucket").agg(F.min("count").alias("lo"), F.max("count").alias("hi"),
                                     F.count(F.lit(1)).alias("n")).collect()
    stats = {r["bucket"]: (r["lo"], r["hi"], r["n"]) for r in got}
    assert stats["m"] == (1, 1, 2880)
    assert stats["H"] == (60, 60, 48)
    assert stats["D"] == (1440, 1440, 2)
    assert stats["M"] == (2880, 2880, 1)


def test_partial_edges_drop_partial_minutes(spark):
    view = rollup.multi_grain_view(events_df(spark, [("E", "2024-01-01 10:00:10"),
                                                     ("E", "2024-01-01 10:01:10")]))
    res = serving.count_by_period(view, None, "2024-01-01 10:00:05", "2024-01-01 10:02:00", "E")
    assert res.first()["result"] == 1


def test_one_sided_edge_counterexample(spark):
    """The walk over-counts here (4); the cover gives the right answer 3."""
    view = rollup.multi_grain_view(events_df(spark, [("E", "2015-12-25 22:30:00"),
                                                     ("E", "2015-12-26 10:00:00"),
                                                     ("E", "2015-12-27 00:10:00")]))
    for levels in (("D", "H", "M", "Y", "m"), ("Y", "M", "D", "H", "m"), ("D", "H", "m")):
        res = serving.count_by_period(view, None, "2015-12-25 21:30", "2015-12-27 00:30", "E",
                                      levels=levels)
        assert res.first()["result"] == 3
    rows = serving.get_events(view, None, "2015-12-25 21:30", "2015-12-27 00:30", "E")
    assert [(r["bucket"], r["date"]) for r in rows.collect()] == [
        ("H", "2015-12-25 22:00"), ("D", "2015-12-26 00:00"), ("m", "2015-12-27 00:10")]


def test_empty_and_inverted_range(spark):
    view = rollup.multi_grain_view(events_df(spark, [("E", "2024-01-01 10:00:10")]))
    res = serving.count_by_period(view, None, "2024-01-01 10:00", "2024-01-01 10:00", "E")
    assert res.first()["result"] == 0
    assert serving.get_events(view, None, "2024-01-01 10:00", "2024-01-01 10:00", "E").count() == 0
    with pytest.raises(ValueError):
        serving.count_by_period(view, None, "2024-01-02", "2024-01-01", "E")


def test_compare_unknown_event_zero_and_order(spark):
    view = rollup.multi_grain_view(events_df(spark, [("view", "2024-01-01 10:00:10"),
                                                     ("view", "2024-01-01 11:00:10")]))
    res = serving.compare_events(view, None, "view, nope", "2024-01-01", "2024-01-02").collect()
    assert [(r["event"], r["count"]) for r in res] == [("view", 2), ("nope", 0)]


def test_unknown_bucket_code_fails_before_any_job(spark):
    view = rollup.multi_grain_view(events_df(spark, [("E", "2024-01-01 10:00:10")]))
    with pytest.raises(ValueError):
        serving.timeseries(view, None, "2024-01-01", "2024-01-02", "X")


def test_month_and_leap_ends(spark):
    df = events_df(spark, [("E", "2016-02-29 23:59:00"), ("E", "2015-12-31 23:59:00")])
    got = df.select(bucket_end("D", bucket_start("D", "ts")).alias("d"),
                    bucket_end("M", bucket_start("M", "ts")).alias("m"),
                    bucket_end("Y", bucket_start("Y", "ts")).alias("y")).collect()
    assert got[0]["d"] == dt.datetime(2016, 3, 1) and got[0]["m"] == dt.datetime(2016, 3, 1)
    assert got[1]["d"] == dt.datetime(2016, 1, 1) and got[1]["y"] == dt.datetime(2016, 1, 1)


def _write_lines(folder, name, lines):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as fh:
        fh.write("\n".join(lines) + "\n")


def test_tmp_files_skipped_and_bad_lines_rejected(spark, tmp_dir):
    day = os.path.join(tmp_dir, "ingest_day=24-01-01")
    _write_lines(day, "a.json", ['{"event":"A","timestamp":"2024-01-01 10:00:00"}', "broken",
                                 '{"event":"A"}', '{"event":"A","timestamp":"x"}'])
    _write_lines(day, "b.json.tmp", ['{"event":"A","timestamp":"2024-01-01 10:00:00"}'])
    good, rejects = landing.read_events(spark, tmp_dir)
    assert good.count() == 1
    reasons = sorted(r["reason"] for r in rejects.collect())
    assert reasons == ["bad timestamp", "malformed json", "missing timestamp"]


def test_missing_landing_directory_is_empty(spark, tmp_dir):
    good, rejects = landing.read_events(spark, os.path.join(tmp_dir, "nope"))
    assert good.count() == 0 and rejects.count() == 0
    assert master.read_master(spark, os.path.join(tmp_dir, "nope")).count() == 0


def test_master_partition_bounds_prune(spark, tmp_dir):
    ev = events_df(spark, [("A", "2024-01-01 10:00:00"), ("A", "2024-01-02 10:00:00"),
                           ("A", "2024-01-03 10:00:00")])
    lines = landing.to_raw_json(ev)
    land, out = os.path.join(tmp_dir, "land"), os.path.join(tmp_dir, "master")
    landing.land_batch(lines, land)
    master.ingest(spark, land, out, mode="overwrite")
    part = master.read_master(spark, out, "2024-01-02 00:00", "2024-01-02 12:00")
    assert part.count() == 1
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "day" in plan


def test_late_event_lands_in_its_bucket(spark, tmp_dir):
    src = os.path.join(tmp_dir, "src")
    view_path, ckpt = os.path.join(tmp_dir, "speed"), os.path.join(tmp_dir, "ckpt")
    _write_lines(src, "1.json", ['{"event":"A","timestamp":"2024-01-01 10:00:00"}'])
    q = speed.start_speed_layer(landing.text_source(spark, src), view_path, ckpt, available_now=True)
    speed.run_until_done(q)
    _write_lines(src, "2.json", ['{"event":"A","timestamp":"2020-05-05 05:05:05"}',
                                 '{"event":"A","timestamp":"2024-01-01 10:00:30"}'])
    q = speed.start_speed_layer(landing.text_source(spark, src), view_path, ckpt, available_now=True)
    speed.run_until_done(q)
    got = _counts(views.read_speed_view(spark, view_path))
    assert got[("m", dt.datetime(2024, 1, 1, 10, 0))] == 2
    assert got[("H", dt.datetime(2024, 1, 1, 10, 0))] == 2
    assert got[("m", dt.datetime(2020, 5, 5, 5, 5))] == 1
    # Restart with no new files: unchanged.
    q = speed.start_speed_layer(landing.text_source(spark, src), view_path, ckpt, available_now=True)
    speed.run_until_done(q)
    assert _counts(views.read_speed_view(spark, view_path)) == got


def test_batch_replay_is_idempotent(spark, tmp_dir):
    view_path = os.path.join(tmp_dir, "speed")
    lines = landing.to_raw_json(events_df(spark, [("A", "2024-01-01 10:00:00"),
                                                  ("A", "2024-01-01 10:30:00")]))
    speed.process_batch(lines, 0, view_path)
    once = _counts(views.read_speed_view(spark, view_path))
    speed.process_batch(lines, 0, view_path)
    assert _counts(views.read_speed_view(spark, view_path)) == once
    speed.process_batch(lines, 1, view_path)
    twice = _counts(views.read_speed_view(spark, view_path))
    assert twice[("H", dt.datetime(2024, 1, 1, 10, 0))] == 4


def test_upsert_twice_and_changed_rows(spark, tmp_dir):
    path = os.path.join(tmp_dir, "view")
    v1 = rollup.multi_grain_view(events_df(spark, [("A", "2024-01-01 10:00:00")]))
    v2 = rollup.multi_grain_view(events_df(spark, [("A", "2024-01-01 10:00:00"),
                                                   ("A", "2024-01-01 10:00:30"),
                                                   ("B", "2025-03-01 00:00:00")]))
    views.create_view(spark, path)
    assert views.upsert_view(spark, v1, path).count() == 5
    changes = views.upsert_view(spark, v2, path)
    assert changes.count() == 10  # five A rows changed, five B rows new
    assert views.upsert_view(spark, v2, path).count() == 0
    stored = views.read_view(spark, path)
    assert sorted(map(tuple, stored.collect())) == sorted(map(tuple, v2.collect()))
    assert views.check_floored(stored).count() == 0
    views.empty_view(spark, path)
    assert views.read_view(spark, path).count() == 0


def test_half_seen_hour(spark):
    """Reference cut-over loses the other half of a half-seen hour; horizon does not."""
    from eventrollup import registry as R

    batch, spd = R._batch_speed(spark, SF001)
    default = {r["event"]: r["result"] for r in
               serving.count_by_period(batch, spd, *R.RANGE).collect()}
    assert default == {"click": 1033, "error": 1072, "purchase": 1011, "signup": 1054, "view": 1027}
    horizon = {r["event"]: r["result"] for r in
               serving.count_by_period(batch, spd, *R.RANGE, cutover=serving.CUT_HORIZON,
                                       horizon=R.BATCH_BEFORE).collect()}
    assert horizon == {**default, "click": 1034, "purchase": 1012}


def test_catalogue_list_semi_join(spark):
    view = rollup.multi_grain_view(events_df(spark, [("LOGIN_WEB", "2024-01-01 10:00:10"),
                                                     ("OTHER", "2024-01-01 10:00:10")]))
    rows = serving.get_events(view, None, "2024-01-01", "2024-01-02", event="",
                              catalogue=CATALOGUE).collect()
    assert {r["event"] for r in rows} == {"LOGIN_WEB"}


def _view_rows(spark, path):
    return sorted(map(tuple, views.read_view(spark, path).collect()))


def test_rebuild_is_idempotent_and_refresh_is_incremental(spark, tmp_dir):
    from eventrollup.plans import batch as batch_runs

    ev = events_df(spark, [("A", "2015-12-25 22:30:00"), ("A", "2015-12-26 10:00:00"),
                           ("B", "2015-12-27 00:10:00")])
    land, mdir, vpath = (os.path.join(tmp_dir, n) for n in ("land", "master", "view"))
    landing.land_batch(landing.to_raw_json(ev), land)
    batch_runs.rebuild(spark, land, mdir, vpath)
    first = _view_rows(spark, vpath)
    assert first == sorted(map(tuple, rollup.multi_grain_view(ev).collect()))
    batch_runs.rebuild(spark, land, mdir, vpath)
    assert _view_rows(spark, vpath) == first
    assert master.read_master(spark, mdir).count() == 3

    # Incremental: only files not seen by the checkpoint are ingested.
    mdir2, vpath2, ckpt = (os.path.join(tmp_dir, n) for n in ("master2", "view2", "ckpt"))
    assert batch_runs.refresh(spark, land, mdir2, vpath2, ckpt).count() == len(first)
    assert batch_runs.refresh(spark, land, mdir2, vpath2, ckpt).count() == 0
    late = events_df(spark, [("A", "2015-12-25 22:30:30")])
    landing.land_batch(landing.to_raw_json(late), land)
    changed = batch_runs.refresh(spark, land, mdir2, vpath2, ckpt)
    # The late row raises A's minute, hour, day, month and year by one.
    assert {r["bucket"] for r in changed.collect()} == set("mHDMY")
    assert master.read_master(spark, mdir2).count() == 4


def test_tags_from_calendar_columns(spark):
    """Bucket code and start rebuilt from the master's calendar fields
    (lower fields default to 1/1 00:00) equal the floor of the timestamp."""
    from eventrollup.functions.buckets import GRAIN_CODES, tag
    from eventrollup.sources.tables import event_frame

    ev = event_frame(spark, SF001).select("event", "ts",
                                          *[F.expr(f"{f}(ts)").alias(f) for f in
                                            ("year", "month", "day", "hour", "minute")])
    for code in GRAIN_CODES:
        tagged = tag(ev, code)
        bad = tagged.where((F.col("bucket") != code) | (F.col("bdate") != bucket_start(code, "ts")))
        assert bad.count() == 0, code


def test_rebuild_and_refresh_refuse_each_others_master(spark, tmp_dir):
    """The streaming sink's log would hide a rebuild's files from readers, so
    a master folder serves one kind of run only; mixing fails loudly."""
    from eventrollup.plans import batch as runs

    land = os.path.join(tmp_dir, "landing")
    lines = spark.createDataFrame([('{"event":"A","timestamp":"2015-06-10 12:54:43"}',)], "value string")
    landing.land_batch(lines, land)
    rebuilt, refreshed = os.path.join(tmp_dir, "m1"), os.path.join(tmp_dir, "m2")
    runs.rebuild(spark, land, rebuilt, os.path.join(tmp_dir, "v1"))
    with pytest.raises(ValueError, match="rebuild"):
        runs.refresh(spark, land, rebuilt, os.path.join(tmp_dir, "v1"), os.path.join(tmp_dir, "c1"))
    runs.refresh(spark, land, refreshed, os.path.join(tmp_dir, "v2"), os.path.join(tmp_dir, "c2"))
    with pytest.raises(ValueError, match="refresh"):
        runs.rebuild(spark, land, refreshed, os.path.join(tmp_dir, "v2"))
    assert master.read_master(spark, rebuilt).count() == 1
    assert master.read_master(spark, refreshed).count() == 1


def test_windowed_variant_with_cluster_state_store(spark):
    """The RocksDB state store named in CLUSTER_CONF gives the same windows."""
    import __spark_entry__ as E
    from eventrollup.session import CLUSTER_CONF

    key = "spark.sql.streaming.stateStore.providerClass"
    want = sorted(tuple(r) for r in E.queries()["speed_windowed_append"](spark, SF0001).collect())
    before = spark.conf.get(key)
    spark.conf.set(key, CLUSTER_CONF[key])
    try:
        got = sorted(tuple(r) for r in E.queries()["speed_windowed_append"](spark, SF0001).collect())
    finally:
        spark.conf.set(key, before)
    assert got == want and len(got) > 0


def test_speed_layer_refuses_a_new_checkpoint_on_an_old_view(spark, tmp_dir):
    src, view_path = os.path.join(tmp_dir, "in"), os.path.join(tmp_dir, "speed")
    _write_lines(src, "1.json", ['{"event":"A","timestamp":"2024-01-01 10:00:00"}'])
    rows = []

    def start(ckpt, **more):
        return speed.start_speed_layer(landing.text_source(spark, src), view_path, os.path.join(tmp_dir, ckpt),
                                       available_now=True, on_batch=lambda i, n: rows.append((i, n)), **more)

    speed.run_until_done(start("c1"))
    assert rows == [(0, 2)]            # one minute row and one hour row were written
    with pytest.raises(ValueError, match="another stream run"):
        start("c2")
    speed.run_until_done(start("c3", reset=True))
    assert sum(_counts(views.read_speed_view(spark, view_path)).values()) == 2


def test_compaction_folds_committed_batches_only(spark, tmp_dir):
    path, ckpt = os.path.join(tmp_dir, "speed"), os.path.join(tmp_dir, "ckpt")
    one = rollup.multi_grain_view(events_df(spark, [("A", "2024-01-01 10:00:00")]), ("m", "H"))
    for i in range(3):
        views.write_partials(one, path, i)
    assert views.compact_partials(spark, path, ckpt) == -1
    os.makedirs(os.path.join(ckpt, "commits"))
    for i in (0, 1):
        open(os.path.join(ckpt, "commits", str(i)), "w").close()
    assert views.compact_partials(spark, path, ckpt) == 1
    want = {("m", dt.datetime(2024, 1, 1, 10, 0)): 3, ("H", dt.datetime(2024, 1, 1, 10, 0)): 3}
    assert _counts(views.read_speed_view(spark, path)) == want
    views.write_partials(one, path, 1)         # a retry of a folded batch
    assert _counts(views.read_speed_view(spark, path)) == want


def test_many_ranges_default_cut_needs_hours_and_minutes(spark):
    view = rollup.multi_grain_view(events_df(spark, [("A", "2024-01-01 10:00:00")]))
    req = spark.createDataFrame([(1, "A")], "request_id int, event string").selectExpr(
        "request_id", "event", "timestamp_ntz'2024-01-01 00:00:00' from_ts", "timestamp_ntz'2024-01-02 00:00:00' to_ts")
    with pytest.raises(ValueError, match="hours and minutes"):
        serving.count_many_ranges(req, view, view, levels=("D", "H"))
    recent = view.where(F.col("bucket").isin("m", "H"))
    assert serving.count_many_ranges(req, view, recent).first()["count"] == 1


def test_rebuild_refuses_a_missing_landing_folder(spark, tmp_dir):
    from eventrollup.plans import batch as runs

    with pytest.raises(FileNotFoundError):
        runs.rebuild(spark, os.path.join(tmp_dir, "nowhere"), os.path.join(tmp_dir, "m"), os.path.join(tmp_dir, "v"))


def test_only_the_raw_timestamp_form_is_good(spark):
    texts = ["2024-01-01 10:00:00", "2024", "2024-01-01", "2024-01-01 10:00:00+02:00", "2024-01-01T10:00:00", "2024-13-01 10:00:00"]
    lines = spark.createDataFrame([(f'{{"event":"A","timestamp":"{t}"}}',) for t in texts], "value string")
    reasons = {r["timestamp"]: r["reason"] for r in landing.parse_raw(lines).collect()}
    assert reasons.pop(texts[0]) is None and set(reasons.values()) == {"bad timestamp"}
