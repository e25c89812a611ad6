"""Stores that readers resolve by a manifest or a pointer: tiers, deltas, snapshots."""

import datetime as dt
import itertools
import random

import pytest
from conftest import events_df
from pyspark.sql import functions as F

from eventrollup import files
from eventrollup.functions.buckets import GRAIN_CODES
from eventrollup.operators import deltas, rollup, runs, tiers, views
from eventrollup.plans import batch, serving, snapshots
from eventrollup.plans.successor import first_buckets
from eventrollup.sources import landing, master
from eventrollup.streaming import speed


def _times(rng, n, start=dt.datetime(2023, 12, 30), hours=24 * 9):
    return [(rng.choice("abc"), (start + dt.timedelta(seconds=rng.randrange(hours * 3600))).strftime("%Y-%m-%d %H:%M:%S"))
            for _ in range(n)]


def _rows(view):
    return sorted((r["event"], r["bucket"], r["bdate"], r["count"]) for r in view.collect())


def _minutes(spark, rows):
    return spark.createDataFrame([(e, dt.datetime.fromisoformat(t), n) for e, t, n in rows], "event string, t timestamp_ntz, count bigint") \
        .select("event", F.lit("m").alias("bucket"), F.col("t").alias("bdate"), "count").coalesce(1)


# --- tiers ---------------------------------------------------------------------------

def test_a_hundred_batches_leave_few_runs(spark, tmp_dir):
    root, total = f"{tmp_dir}/store", {}
    for k in range(100):
        key = ("a", f"2024-01-01 00:{k % 7:02d}:00")
        total[key] = total.get(key, 0) + k
        tiers.commit_batch(_minutes(spark, [(*key, k)]), root, k)
        tiers.merge_tiers(spark, root, k - 1, fanout=4)
    live = runs.manifest(spark, root).runs
    assert len(live) <= 3 * 4 + 1 and max(r.level for r in live) == 3
    assert runs.vacuum(spark, root, grace_seconds=0) > 90
    # What a listing sees is bounded too: live folders, one manifest.
    assert len(files.entries(spark, f"{root}/data")) == len(live)
    assert len([n for n in files.entries(spark, f"{root}/manifest") if n.endswith(".json")]) == 1
    got = {(r["event"], r["bdate"].isoformat(sep=" ")): r["count"] for r in tiers.read_speed_store(spark, root).collect()}
    assert got == total and tiers.last_batch(spark, root) == 99


def test_replayed_batches_count_once(spark, tmp_dir):
    root = f"{tmp_dir}/store"
    for k in range(4):
        tiers.commit_batch(_minutes(spark, [("a", "2024-01-01 00:00:00", 1)]), root, k)
    tiers.commit_batch(_minutes(spark, [("a", "2024-01-01 00:00:00", 5)]), root, 3)
    assert _rows(tiers.read_speed_store(spark, root))[0][3] == 8
    tiers.merge_tiers(spark, root, 2, fanout=3)
    assert sorted((r.level, r.first, r.last) for r in runs.manifest(spark, root).runs) == [(0, 3, 3), (1, 0, 2)]
    assert tiers.commit_batch(_minutes(spark, [("a", "2024-01-01 00:00:00", 9)]), root, 1) == 0
    assert tiers.commit_batch(_minutes(spark, []), root, 4) == 0
    assert _rows(tiers.read_speed_store(spark, root))[0][3] == 8
    assert tiers.read_speed_store(spark, f"{tmp_dir}/none").collect() == []


def test_readers_keep_dropped_runs_for_the_grace_period(spark, tmp_dir):
    root = f"{tmp_dir}/store"
    for k in range(2):
        tiers.commit_batch(_minutes(spark, [("a", "2024-01-01 00:00:00", 1)]), root, k)
    open_before = tiers.read_speed_store(spark, root)
    tiers.merge_tiers(spark, root, 1, fanout=2)
    # A run that no manifest lists is a failed writer's.
    orphan = runs.write_run(views._to_stored(_minutes(spark, [("x", "2024-01-01 00:00:00", 1)])), root, 0, 9, 9)
    assert runs.vacuum(spark, root, grace_seconds=3600) == 0
    assert _rows(open_before)[0][3] == 2
    assert runs.vacuum(spark, root, grace_seconds=0) == 3
    assert f"run={orphan.name}" not in files.entries(spark, f"{root}/data")
    assert _rows(tiers.read_speed_store(spark, root))[0][3] == 2
    old = runs.Manifest()
    with pytest.raises(FileExistsError):
        runs.publish(spark, root, runs.Manifest(runs.manifest(spark, root).version - 1), old.runs)


def test_store_reads_prune_folders(spark, tmp_dir):
    root = f"{tmp_dir}/store"
    view = rollup.multi_grain_view(events_df(spark, _times(random.Random(1), 300)), ("m", "H"))
    tiers.commit_batch(view, root, 0)
    tiers.commit_batch(view, root, 1)
    part = tiers.read_speed_store(spark, root, codes=("H",), events=("a",), left="2024-01-01 00:00:00", right="2024-01-03 00:00:00", with_period=True)
    assert "period=2024/" in "".join(part.where(F.col("period") >= 2024).inputFiles()) or part.count() > 0
    plan = part._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "grain" in plan.split("PartitionFilters: [")[1].split("]")[0]
    want = [(e, b, d, 2 * n) for e, b, d, n in _rows(view) if b == "H" and e == "a" and dt.datetime(2024, 1, 1) <= d < dt.datetime(2024, 1, 3)]
    assert _rows(part.drop("period")) == want


# --- deltas --------------------------------------------------------------------------

def test_upserts_equal_the_rewriting_view(spark, tmp_dir):
    rng, root, path = random.Random(4), f"{tmp_dir}/deltas", f"{tmp_dir}/folders"
    events = []
    for k in range(6):
        events += _times(rng, 40 if k == 0 else 3)
        view = rollup.multi_grain_view(events_df(spark, events))
        changes = deltas.upsert(view, root, fanout=2, share=0.5)
        assert _rows(changes) == _rows(views.upsert_view(spark, view, path))
        assert _rows(deltas.read_store(spark, root)) == _rows(views.read_view(spark, path))
        assert deltas.stored_grains(spark, root) == set(GRAIN_CODES)
    lo, hi = "2024-01-01 00:00:00", "2024-01-05 12:30:00"
    for codes in (("m",), ("H", "D"), None):
        assert _rows(deltas.read_store(spark, root, codes, ["a", "b"], lo, hi)) == _rows(views.read_view(spark, path, codes, ["a", "b"], lo, hi))
    assert deltas.upsert(view.limit(0), root).collect() == []


def test_a_late_event_writes_only_its_rows(spark, tmp_dir):
    root = f"{tmp_dir}/deltas"
    events = _times(random.Random(5), 3000)
    deltas.write_base(rollup.multi_grain_view(events_df(spark, events)), root)
    base = runs.manifest(spark, root).runs[0]
    late = rollup.multi_grain_view(events_df(spark, [*events, ("a", "2024-01-02 03:04:05")]))
    assert deltas.upsert(late, root).count() == 5
    now = runs.manifest(spark, root).runs
    assert now[0] == base and [(r.level, r.rows) for r in now[1:]] == [(0, 5)]
    size = {r.name: sum(n for f, n in files.files_below(spark, runs.folder(root, r)) if f.endswith(".parquet")) for r in now}
    assert size[now[1].name] < size[base.name] / 2
    assert _rows(deltas.read_store(spark, root)) == _rows(late)
    # The same again changes nothing.
    assert deltas.upsert(late, root).count() == 0 and runs.manifest(spark, root).runs == now


def test_base_rows_are_not_regrouped(spark, tmp_dir):
    root = f"{tmp_dir}/deltas"
    view = rollup.multi_grain_view(events_df(spark, _times(random.Random(6), 200)))
    deltas.write_base(view, root)
    plan = deltas.read_store(spark, root)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    assert _rows(deltas.read_store(spark, root)) == _rows(view)


# --- refresh and recount ---------------------------------------------------------------

def test_recount_with_every_grain_list(spark, tmp_dir):
    rows = [("a", "2024-01-01 05:00:00")] * 3 + [("a", "2024-02-01 00:00:30"), ("b", "2023-12-31 23:59:59")]
    late = [("a", "2024-01-02 06:00:00")] * 2
    store = f"{tmp_dir}/master"
    for n, part in enumerate((rows, late)):
        landing.land_batch(landing.to_raw_json(events_df(spark, part).coalesce(1)), f"{tmp_dir}/landing{n}")
        master.ingest(spark, f"{tmp_dir}/landing{n}", store)
    before = rollup.multi_grain_view(events_df(spark, rows)).checkpoint()
    after = rollup.multi_grain_view(events_df(spark, rows + late)).collect()
    for grains in [g for n in range(1, 6) for g in itertools.combinations(GRAIN_CODES, n)]:
        def read(spark, path, codes, with_period, grains=grains):
            assert set(codes) <= set(grains)       # only grains that the view stores
            return before.where(F.col("bucket").isin(list(codes))).withColumn("period", F.year("bdate"))

        got = {(r["event"], r["bucket"], r["bdate"]): r["count"] for r in batch.recount(spark, store, "", [(2024, 1, 2)], grains, read).collect()}
        touched = {"m": "2024-01-02 06:00", "H": "2024-01-02 06:00", "D": "2024-01-02 00:00", "M": "2024-01-01 00:00", "Y": "2024-01-01 00:00"}
        want = {(r["event"], r["bucket"], r["bdate"]): r["count"] for r in after if r["bucket"] in grains}
        assert all(want[k] == n for k, n in got.items())
        assert {("a", g, dt.datetime.fromisoformat(touched[g])) for g in grains} <= set(got)


def test_refresh_keeps_the_grains_it_began_with(spark, tmp_dir):
    landing.land_batch(landing.to_raw_json(events_df(spark, [("a", "2024-01-01 05:00:00")])), f"{tmp_dir}/landing")
    where = (f"{tmp_dir}/landing", f"{tmp_dir}/master", f"{tmp_dir}/view", f"{tmp_dir}/ckpt")
    batch.refresh(spark, *where, grains=("H", "M"))
    with pytest.raises(ValueError, match="holds the grains"):
        batch.refresh(spark, *where, grains=("H", "D", "M"))


def test_rebuild_refuses_what_is_not_finished(spark, tmp_dir):
    land = f"{tmp_dir}/landing"
    for name in ("part-0.tmp", "_SUCCESS", ".part-1.crc"):
        files.create_text(spark, f"{land}/ingest_day=24-01-01/{name}", "x")
    files.create_text(spark, f"{land}/ingest_day=24-01-01/part-2", "")
    for root in (land, f"{tmp_dir}/missing"):
        with pytest.raises(FileNotFoundError):
            batch.check_landing(spark, root)
        batch.check_landing(spark, root, allow_empty=True)
    files.create_text(spark, f"{land}/ingest_day=24-01-01/part-3", "x")
    batch.check_landing(spark, land)


def test_a_backfill_writes_few_files(spark, tmp_dir):
    rows = events_df(spark, _times(random.Random(3), 400)).repartition(8)
    landing.land_batch(landing.to_raw_json(rows), f"{tmp_dir}/landing")
    for clustered in (False, True):
        master.ingest(spark, f"{tmp_dir}/landing", f"{tmp_dir}/{clustered}", clustered=clustered)
    files_of = {c: [f for f, _ in files.files_below(spark, f"{tmp_dir}/{c}") if f.endswith(".parquet")] for c in (False, True)}
    assert len(files_of[True]) <= 10 < len(files_of[False])          # ten days
    columns = ["event", "timestamp", "at", "year", "month", "day"]
    assert sorted(map(tuple, master.read_master(spark, f"{tmp_dir}/True").select(columns).collect())) == \
        sorted(map(tuple, master.read_master(spark, f"{tmp_dir}/False").select(columns).collect()))


# --- snapshots -------------------------------------------------------------------------

def test_snapshots_are_seen_whole_or_not_at_all(spark, tmp_dir):
    root = f"{tmp_dir}/root"

    def land(n, rows):
        landing.land_batch(landing.to_raw_json(events_df(spark, rows)), f"{tmp_dir}/landing{n}")
        return f"{tmp_dir}/landing{n}"

    assert snapshots.current(spark, root) is None and snapshots.read_view(spark, root).collect() == []
    one = [("a", "2024-01-01 05:00:00")]
    first = snapshots.rebuild(spark, land(1, one), root)
    opened = snapshots.read_view(spark, root)
    failed = snapshots.begin(spark, root)
    views.write_view(opened.limit(1), failed.view)
    slow = snapshots.begin(spark, root)
    newest = snapshots.rebuild(spark, land(2, one * 2), root)
    assert [s.number for s in (first, failed, slow, newest)] == [1, 2, 3, 4]
    # A version that is finished late does not replace a newer one.
    snapshots.publish(spark, root, slow)
    assert snapshots.current(spark, root) == newest
    assert {r["count"] for r in opened.collect()} == {1} and {r["count"] for r in snapshots.read_view(spark, root).collect()} == {2}
    assert snapshots.read_master(spark, root).count() == 2
    assert snapshots.retire(spark, root, keep=2, grace_seconds=3600) == []
    assert snapshots.retire(spark, root, keep=1, grace_seconds=0) == [1, 2, 3]
    assert sorted(n for n in files.entries(spark, root) if n.startswith("v=")) == ["v=4"]
    with pytest.raises(FileNotFoundError):
        snapshots.rebuild(spark, f"{tmp_dir}/nothing", root)
    assert snapshots.current(spark, root) == newest


# --- many ranges with the default cut -----------------------------------------------------

def _requests(rng, n):
    out = []
    for i in range(n):
        lo = dt.datetime(2023, 12, 28) + dt.timedelta(seconds=rng.randrange(14 * 86400))
        hi = lo + dt.timedelta(seconds=rng.choice([-50, 0, 30, 90, 3000, 9000, 86400, 5 * 86400, 400 * 86400]) + rng.randrange(60))
        if i % 4 == 0:
            lo = lo.replace(minute=0, second=0)
        if i % 6 == 0:
            hi = hi.replace(minute=0, second=0)
        out.append((i, rng.choice(["a", "b", "c", "none"]), lo, hi))
    return out


def test_first_bucket_of_many_ranges(spark):
    rng = random.Random(8)
    sparse = [(e, t) for e, t in _times(rng, 60)] + [("a", "2026-05-01 00:00:00")]
    view = rollup.multi_grain_view(events_df(spark, sparse), ("m", "H"))
    asked = _requests(rng, 200)
    req = spark.createDataFrame(asked, "id int, event string, _lo timestamp_ntz, _hi timestamp_ntz")
    got = {r["id"]: r["_cut"] for r in first_buckets(req, view, ["id", "event", "_lo", "_hi"], (2023, 2025)).collect()}
    stored = {c: {(r["event"], r["bdate"]) for r in view.where(F.col("bucket") == c).collect()} for c in "mH"}
    hour, minute = dt.timedelta(hours=1), dt.timedelta(minutes=1)
    assert len(got) == len(asked)
    for i, event, lo, hi in asked:
        whole = [d for e, d in stored["H"] if e == event and d >= lo and d + hour <= hi]
        single = [d for e, d in stored["m"] if e == event and d >= lo and d + minute <= hi
                  and not (d.replace(minute=0) >= lo and d.replace(minute=0) + hour <= hi)]
        assert got[i] == min(whole + single, default=None), (event, lo, hi)


def test_many_ranges_equal_single_ones(spark):
    rng = random.Random(9)
    batch_view = rollup.multi_grain_view(events_df(spark, _times(rng, 400)))
    speed_view = rollup.multi_grain_view(events_df(spark, _times(rng, 30, dt.datetime(2024, 1, 3, 7, 20))), ("m", "H"))
    asked = [r for r in _requests(rng, 8) if r[3] >= r[2]]
    req = spark.createDataFrame([*asked, (99, "a", dt.datetime(2024, 1, 2), dt.datetime(2024, 1, 1)), (98, "a", None, None)],
                                "request_id int, event string, from_ts timestamp_ntz, to_ts timestamp_ntz")
    got = {r["request_id"]: r["count"] for r in serving.count_many_ranges(req, batch_view, speed_view).collect()}
    narrow = serving.count_many_ranges(req, batch_view, speed_view, narrow=True).collect()
    assert {r["request_id"]: r["count"] for r in narrow} == got
    for i, event, lo, hi in asked:
        one = serving.count_by_period(batch_view, speed_view, lo.isoformat(sep=" "), hi.isoformat(sep=" "), event=event,
                                      levels=("Y", "M", "D", "H", "m")).collect()
        assert got[i] == one[0]["result"], (event, lo, hi)
    assert got[99] is None and len(got) == len(asked) + 2


# --- the tiered speed layer ------------------------------------------------------------------

def test_tiered_stream_restarts_and_refuses_foreign_checkpoints(spark, tmp_dir):
    store = speed.SpeedStore(f"{tmp_dir}/store")
    land, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/ckpt"
    seen = []
    for k in range(3):
        rows = spark.createDataFrame([('{"event":"a","timestamp":"2024-01-01 00:00:0%d"}' % k,), ("junk",)], "value string")
        landing.land_batch(rows, land)
        speed.run_until_done(speed.start_tiered(landing.text_source(spark, land), store, ckpt, available_now=True,
                                                on_batch=lambda i, f: seen.append((i, f))))
    speed.run_until_done(speed.start_tiered(landing.text_source(spark, land), store, ckpt, available_now=True))
    assert seen == [(k, (2, 1, 2)) for k in range(3)]
    assert {r["count"] for r in tiers.read_speed_store(spark, store.counts).collect()} == {3}
    assert speed.read_rejects(spark, store).count() == 3
    assert sorted(tuple(r) for r in speed.read_figures(spark, store).select("rows_in", "rejected", "written", "batch_id").collect()) == [
        (2, 1, 2, k) for k in range(3)]
    with pytest.raises(ValueError, match="another stream run"):
        speed.start_tiered(landing.text_source(spark, land), store, f"{tmp_dir}/other", available_now=True)
