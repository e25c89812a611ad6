"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each statement computes its answer directly from the raw tables with plain
GROUP BY / JOIN / WHERE: no roll-up cascade, no cover walk.  Tables
``events`` and ``orders`` are views registered by the caller.
"""

from __future__ import annotations

from eventrollup import registry as R

UNITS = {"m": "minute", "H": "hour", "D": "day", "M": "month", "Y": "year"}
SRC = {
    "events": "SELECT event_type AS event, ts FROM events",
    "orders": "SELECT o_orderpriority AS event, o_orderdate AS ts FROM orders",
    "lineitem": "SELECT l_returnflag AS event, l_shipdate AS ts FROM lineitem",
}


def _ts(text: str) -> str:
    return f"TIMESTAMP '{text}'"


def _grain_sql(src: str, code: str) -> str:
    unit = UNITS[code]
    return (f"SELECT event, '{code}' AS bucket, date_trunc('{unit}', ts) AS bdate, "
            f"CAST(count(*) AS BIGINT) AS count FROM ({src}) GROUP BY ALL")


def _view_sql(src: str, grains=("m", "H", "D", "M", "Y")) -> str:
    return " UNION ALL ".join(_grain_sql(src, g) for g in grains)


def _end(code: str, expr: str) -> str:
    return f"({expr} + INTERVAL 1 {UNITS[code].upper()})"


def _contained(code: str, lo: str, hi: str, b: str = "bdate") -> str:
    return f"({b} >= {lo} AND {_end(code, b)} <= {hi})"


def _enclosing(code: str, lo: str, hi: str, b: str = "bdate") -> str:
    s = f"date_trunc('{UNITS[code]}', {b})"
    return f"({s} >= {lo} AND {_end(code, s)} <= {hi})"


def _cover_where(chain, lo: str, hi: str) -> str:
    terms = []
    for i, code in enumerate(chain):
        parts = [f"bucket = '{code}'", _contained(code, lo, hi)]
        parts += [f"NOT {_enclosing(c, lo, hi)}" for c in chain[:i]]
        terms.append("(" + " AND ".join(parts) + ")")
    return "(" + " OR ".join(terms) + ")"


def _split_sources():
    b = f"SELECT * FROM ({SRC['events']}) WHERE ts < {_ts(R.BATCH_BEFORE)}"
    s = f"SELECT * FROM ({SRC['events']}) WHERE ts >= {_ts(R.SPEED_FROM)}"
    return b, s


def _merge_sql(b_chain, s_chain, lo: str, hi: str, speed: str | None = None) -> str:
    """Speed cover; per-event cut = its first bucket; batch cover up to the cut."""
    b, s = _split_sources()
    s = speed or s
    return f"""
WITH bv AS ({_view_sql(b)}),
     sv AS ({_view_sql(s, ('m', 'H'))}),
     sc AS (SELECT event, bucket, bdate, count FROM sv WHERE {_cover_where(s_chain, lo, hi)}),
     cut AS (SELECT event, min(bdate) AS cut FROM sc GROUP BY event),
     bc AS (SELECT bv.event, bv.bucket, bv.bdate, bv.count FROM bv LEFT JOIN cut ON bv.event = cut.event
            WHERE {_cover_where(b_chain, lo, f'COALESCE(cut.cut, {hi})')})
SELECT * FROM bc UNION ALL SELECT * FROM sc"""


def _minutes_in(src: str, lo: str, hi: str) -> str:
    return (f"SELECT event, CAST(count(*) AS BIGINT) AS total FROM ({src}) "
            f"WHERE date_trunc('minute', ts) >= {lo} AND date_trunc('minute', ts) + INTERVAL 1 MINUTE <= {hi} "
            f"GROUP BY event")


LO, HI = _ts(R.RANGE[0]), _ts(R.RANGE[1])
OLO, OHI = _ts(R.ORDERS_RANGE[0]), _ts(R.ORDERS_RANGE[1])
EV = SRC["events"]


def _shaped(inner: str) -> str:
    return (f"SELECT event, bucket, bdate, strftime(bdate, '%Y-%m-%d %H:%M') AS date, count "
            f"FROM ({inner})")


def _speed_view_sql() -> str:
    return _view_sql(EV, ("m", "H"))


def _windowed_sql() -> str:
    """Append-mode windows: a minute or hour window is emitted once the final
    watermark (latest event time, whole seconds as landed, minus the delay)
    has passed its end; the still-open ones are not.  Exact when no row
    arrives behind an earlier batch's watermark (one landing file here)."""
    return f"""
WITH wm AS (SELECT max(date_trunc('second', ts)) - INTERVAL {R.WATERMARK_MINUTES} MINUTE AS w FROM ({EV}))
SELECT v.event, v.bucket, v.bdate, v.count FROM ({_view_sql(EV, ("m", "H"))}) v, wm
WHERE (v.bucket = 'm' AND v.bdate + INTERVAL 1 MINUTE <= wm.w)
   OR (v.bucket = 'H' AND v.bdate + INTERVAL 1 HOUR <= wm.w)"""


def _compare_sql() -> str:
    names = [n.strip() for n in R.COMPARE_LIST.split(",")]
    values = ", ".join(f"({i}, '{n}')" for i, n in enumerate(names))
    return f"""
WITH req(pos, event) AS (VALUES {values}),
     t AS (SELECT event, sum(count) AS total FROM ({_merge_sql(('D', 'H', 'm'), ('H', 'm'), LO, HI)}) GROUP BY event)
SELECT CAST(req.pos AS INTEGER) AS pos, req.event, CAST(COALESCE(t.total, 0) AS BIGINT) AS count
FROM req LEFT JOIN t ON req.event = t.event"""


def _many_ranges_sql() -> str:
    b, a = R.REQUEST_BEFORE_HOURS, R.REQUEST_AFTER_HOURS
    return f"""
WITH m AS (SELECT event_type AS event, date_trunc('minute', ts) AS bdate, count(*) AS c FROM events GROUP BY ALL),
     q AS (SELECT event_id AS request_id, event_type AS event,
                  ts - INTERVAL {b} HOUR AS from_ts, ts + INTERVAL {a} HOUR AS to_ts FROM events),
     r AS (SELECT *, row_number() OVER () AS row FROM (
               SELECT * FROM q UNION ALL SELECT * FROM q WHERE request_id % 7 = 0
               UNION ALL SELECT NULL, event, from_ts, to_ts FROM q WHERE request_id % 11 = 0))
SELECT r.request_id, r.event, r.from_ts, r.to_ts, CAST(COALESCE(sum(m.c), 0) AS BIGINT) AS count
FROM r LEFT JOIN m ON m.event = r.event AND m.bdate >= r.from_ts AND m.bdate + INTERVAL 1 MINUTE <= r.to_ts
GROUP BY r.row, r.request_id, r.event, r.from_ts, r.to_ts"""


def _requests_sql() -> str:
    b, a = R.REQUEST_BEFORE_HOURS, R.REQUEST_AFTER_HOURS
    return f"""
     q AS (SELECT event_id AS request_id, event_type AS event,
                  ts - INTERVAL {b} HOUR AS from_ts, ts + INTERVAL {a} HOUR AS to_ts FROM events),
     r AS (SELECT *, row_number() OVER () AS row FROM (
               SELECT * FROM q UNION ALL SELECT * FROM q WHERE request_id % 7 = 0
               UNION ALL SELECT NULL, event, from_ts, to_ts FROM q WHERE request_id % 11 = 0))"""


def _many_ranges_default_cut_sql() -> str:
    """Per request: its speed cover, the first bucket of it, batch minutes before."""
    b, s = _split_sources()
    return f"""
WITH {_requests_sql().strip()},
     sv AS ({_view_sql(s, ('m', 'H'))}),
     bm AS ({_grain_sql(b, 'm')}),
     d AS (SELECT DISTINCT event, from_ts, to_ts FROM r),
     c AS (SELECT d.event, d.from_ts, d.to_ts, min(sv.bdate) AS cut, sum(sv.count) AS n
           FROM d LEFT JOIN sv ON sv.event = d.event
                AND {_cover_where(('H', 'm'), 'd.from_ts', 'd.to_ts').replace('bdate', 'sv.bdate').replace('bucket', 'sv.bucket')}
           GROUP BY ALL),
     t AS (SELECT c.event, c.from_ts, c.to_ts, coalesce(any_value(c.n), 0) + coalesce(sum(bm.count), 0) AS n
           FROM c LEFT JOIN bm ON bm.event = c.event AND bm.bdate >= c.from_ts
                AND bm.bdate + INTERVAL 1 MINUTE <= coalesce(c.cut, c.to_ts)
           GROUP BY c.event, c.from_ts, c.to_ts)
SELECT r.request_id, r.event, r.from_ts, r.to_ts, CAST(t.n AS BIGINT) AS count
FROM r JOIN t ON t.event = r.event AND t.from_ts = r.from_ts AND t.to_ts = r.to_ts"""


def _good_drop() -> str:
    return "SELECT event_type AS event, ts FROM events WHERE event_id % 5 = 0"


def _later_speed() -> str:
    """Speed source after the second micro-batch of ``merge_after_new_batch``."""
    return (f"SELECT * FROM ({EV}) WHERE ts >= {_ts(R.SPEED_FROM)} "
            f"OR (ts >= {_ts(R.SPEED_EARLIER)} AND event <> '{R.ONE_EVENT}')")


def _one(names) -> str:
    """The merge of the chosen events alone, from their own rows."""
    chosen = ", ".join(f"'{n}'" for n in names)
    return f"SELECT * FROM ({_merge_sql(('D', 'H', 'm'), ('H', 'm'), LO, HI)}) WHERE event IN ({chosen})"


def _starts(prefix: str) -> str:
    return ", ".join(f"date_trunc('{u}', ts) AS {prefix}_{u}" for u in UNITS.values())


ORACLES: dict[str, str] = {
    "calendar_enrich": (
        "SELECT event_id, event_type AS event, CAST(year(ts) AS INTEGER) AS year, "
        "CAST(month(ts) AS INTEGER) AS month, CAST(day(ts) AS INTEGER) AS day, "
        "CAST(hour(ts) AS INTEGER) AS hour, CAST(minute(ts) AS INTEGER) AS minute FROM events"),
    "bucket_start_all": f"SELECT event_id, {_starts('start')} FROM events",
    "bucket_end_all": "SELECT event_id, " + ", ".join(
        f"date_trunc('{u}', ts) + INTERVAL 1 {u.upper()} AS end_{u}" for u in UNITS.values()) + " FROM events",
    "count_minute": (f"SELECT event, date_trunc('minute', ts) AS bdate, CAST(count(*) AS BIGINT) AS count "
                     f"FROM ({EV}) GROUP BY ALL"),
    "count_hour": (f"SELECT event, date_trunc('hour', ts) AS bdate, CAST(count(*) AS BIGINT) AS count "
                   f"FROM ({EV}) GROUP BY ALL"),
    "count_day": (f"SELECT event, date_trunc('day', ts) AS bdate, CAST(count(*) AS BIGINT) AS count "
                  f"FROM ({EV}) GROUP BY ALL"),
    "count_month": (f"SELECT event, date_trunc('month', ts) AS bdate, CAST(count(*) AS BIGINT) AS count "
                    f"FROM ({SRC['orders']}) GROUP BY ALL"),
    "count_year": (f"SELECT event, date_trunc('year', ts) AS bdate, CAST(count(*) AS BIGINT) AS count "
                   f"FROM ({SRC['orders']}) GROUP BY ALL"),
    "batch_view": _view_sql(EV),
    "batch_rebuild": _view_sql(EV),
    "batch_refresh": _view_sql(EV),
    "batch_view_orders": _view_sql(SRC["orders"]),
    "batch_view_lineitem": _view_sql(SRC["lineitem"]),
    "event_types": "SELECT DISTINCT event_type AS event FROM events",
    "bucket_tags": _view_sql(EV),
    "unfloored_rows": (f"SELECT event, 'H' AS bucket, ts AS bdate, CAST(1 AS BIGINT) AS count FROM ({EV}) "
                       "WHERE ts <> date_trunc('hour', ts)"),
    "json_rejects_all_reasons": """
SELECT CASE event_id % 5 WHEN 1 THEN 'malformed json' WHEN 2 THEN 'missing event'
                         WHEN 3 THEN 'missing timestamp' ELSE 'bad timestamp' END AS reason,
       CAST(count(*) AS BIGINT) AS count
FROM events WHERE event_id % 5 <> 0 GROUP BY ALL""",
    "master_keeps_fields": ("SELECT event_type AS event, CAST(sum(user_id) AS BIGINT) AS users, "
                            "count(props) AS with_props FROM events GROUP BY ALL"),
    "refresh_tmp_and_old_files": _view_sql(EV),
    "rebuild_unfinished_landing": _view_sql(EV),
    "rebuild_snapshot": (f"SELECT *, 'before' AS reader FROM ({_view_sql(_split_sources()[0])}) "
                         f"UNION ALL SELECT *, 'after' AS reader FROM ({_view_sql(EV)})"),
    "refresh_without_days": _view_sql(EV, ("H", "M")),
    "refresh_merge_on_read": _view_sql(EV),
    "upsert_merge_on_read": _view_sql(EV),
    "speed_view_tiered": _view_sql(_good_drop(), ("m", "H")),
    "speed_rejects": f"""
SELECT (event_id // 5) % {R.SPEED_DROPS} AS batch_id,
       CASE event_id % 5 WHEN 1 THEN 'malformed json' WHEN 2 THEN 'missing event'
                         WHEN 3 THEN 'missing timestamp' ELSE 'bad timestamp' END AS reason,
       CAST(count(*) AS BIGINT) AS count
FROM events WHERE event_id % 5 <> 0 GROUP BY ALL""",
    "speed_batch_rows": f"""
WITH e AS (SELECT (event_id // 5) % {R.SPEED_DROPS} AS batch_id, event_id % 5 = 0 AS good, event_type AS event, ts FROM events)
SELECT batch_id, count(*) AS rows_in, count(*) FILTER (NOT good) AS rejected,
       count(DISTINCT (event, date_trunc('minute', ts))) FILTER (good)
       + count(DISTINCT (event, date_trunc('hour', ts))) FILTER (good) AS written
FROM e GROUP BY batch_id""",
    "rebuild_corrected_landing": _view_sql(_split_sources()[0]),
    "merge_after_new_batch": _merge_sql(("D", "H", "m"), ("H", "m"), LO, HI, _later_speed()),
    "count_by_period_one": f"""
SELECT r.event, '{R.RANGE[0]}' AS "from", '{R.RANGE[1]}' AS "to", CAST(COALESCE(sum(t.count), 0) AS BIGINT) AS result
FROM (VALUES ('{R.ONE_EVENT}'), ('{R.UNKNOWN_EVENT}')) r(event) LEFT JOIN ({_one([R.ONE_EVENT])}) t ON t.event = r.event
GROUP BY r.event""",
    "timeseries_one": _shaped(
        f"SELECT * FROM ({_merge_sql(('H',), ('H',), LO, HI)}) WHERE event = '{R.ONE_EVENT}'"),
    "get_events_one": _shaped(_one([R.ONE_EVENT])),
    "get_events_catalogue": _shaped(_one(R.CATALOGUE)),
    "json_roundtrip": (f"SELECT event, date_trunc('minute', ts) AS bdate, CAST(count(*) AS BIGINT) AS count "
                       f"FROM ({EV}) GROUP BY ALL"),
    "json_rejects": ("SELECT 'missing event' AS reason, CAST(count(*) AS BIGINT) AS count "
                     "FROM events WHERE props IS NOT NULL"),
    "master_dataset": ("SELECT CAST(year(ts) AS INTEGER) AS year, CAST(month(ts) AS INTEGER) AS month, "
                       "CAST(day(ts) AS INTEGER) AS day, event_type AS event, CAST(count(*) AS BIGINT) AS count "
                       "FROM events GROUP BY ALL"),
    "master_range": _view_sql(f"SELECT * FROM ({EV}) WHERE ts >= {LO} AND ts < {HI}", ("m", "H", "D")),
    "raw_landing": "SELECT event_type AS event, CAST(count(*) AS BIGINT) AS count FROM events GROUP BY ALL",
    "changed_rows": f"""
WITH n AS ({_view_sql(EV)}),
     o AS ({_view_sql(f"SELECT * FROM ({EV}) WHERE ts < {_ts(R.BATCH_BEFORE)}")})
SELECT n.event, n.bucket, n.bdate, n.count FROM n
LEFT JOIN o ON n.event = o.event AND n.bucket = o.bucket AND n.bdate = o.bdate
WHERE n.count IS DISTINCT FROM o.count""",
    "upsert_batch_view": _view_sql(EV),
    "view_range_read": f"SELECT * FROM ({_grain_sql(EV, 'H')}) WHERE {_contained('H', LO, HI)}",
    "speed_view": _speed_view_sql(),
    "speed_view_replay": _speed_view_sql(),
    "speed_view_compacted": _speed_view_sql(),
    "speed_windowed_append": _windowed_sql(),
    "range_predicates": """
SELECT event_id,
  date_trunc('hour', ts) = date_trunc('minute', ts) AS a_empty,
  date_trunc('minute', ts) >= date_trunc('hour', ts) AS a_valid,
  date_trunc('hour', ts) >= ts AS rev_valid,
  (epoch_us(date_trunc('minute', ts)) - epoch_us(date_trunc('hour', ts))) // 1000 AS a_length_ms,
  (epoch_us(ts) - epoch_us(date_trunc('day', ts))) // 1000 AS b_length_ms,
  date_trunc('hour', ts) = date_trunc('day', ts) AS a_starts_b,
  date_trunc('minute', ts) = ts AS a_ends_b,
  (epoch_us(date_trunc('minute', ts)) - epoch_us(date_trunc('hour', ts))) // 1000
    > (epoch_us(ts) - epoch_us(date_trunc('day', ts))) // 1000 AS a_wider_b
FROM events""",
    "range_cover_dhm": f"SELECT * FROM ({_view_sql(EV)}) WHERE {_cover_where(('D', 'H', 'm'), LO, HI)}",
    "range_cover_full": (f"SELECT * FROM ({_view_sql(SRC['orders'])}) "
                         f"WHERE {_cover_where(('Y', 'M', 'D', 'H', 'm'), OLO, OHI)}"),
    "range_cover_equals_minutes": _minutes_in(EV, LO, HI),
    "merge_batch_speed": _merge_sql(("D", "H", "m"), ("H", "m"), LO, HI),
    "merge_batch_speed_horizon": _minutes_in(EV, LO, HI),
    "count_by_period": f"""
WITH t AS (SELECT event, sum(count) AS total FROM ({_merge_sql(('D', 'H', 'm'), ('H', 'm'), LO, HI)}) GROUP BY event),
     e AS (SELECT DISTINCT event_type AS event FROM events)
SELECT e.event, '{R.RANGE[0]}' AS "from", '{R.RANGE[1]}' AS "to", CAST(COALESCE(t.total, 0) AS BIGINT) AS result
FROM e LEFT JOIN t ON e.event = t.event""",
    "timeseries_hour": _shaped(_merge_sql(("H",), ("H",), LO, HI)),
    "timeseries_day": _shaped(
        f"SELECT * FROM ({_view_sql(_split_sources()[0], ('D',))}) WHERE {_cover_where(('D',), LO, HI)}"),
    "get_events": _shaped(_merge_sql(("D", "H", "m"), ("H", "m"), LO, HI)),
    "get_events_all": _shaped(_merge_sql(("D", "H", "m"), ("H", "m"), LO, HI)),
    "compare_events": _compare_sql(),
    "count_many_ranges": _many_ranges_sql(),
    "count_many_ranges_default_cut": _many_ranges_default_cut_sql(),
}
