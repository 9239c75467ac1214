"""DuckDB SQL for the registered queries, over the same Parquet tables."""

from __future__ import annotations

from .queries import ARM_NOW, LADDER_OPEN, T0, T1

MSG = """
base AS (SELECT *, epoch_us(ts) AS us FROM events),
msg AS (
  SELECT event_id, user_id,
    concat('KXSIM-24JAN', lpad(CAST(user_id % 8 + 1 AS VARCHAR), 2, '0'), '12-T', user_id % 8) AS ticker,
    1704067200000000 + (us - 1704067200000000) // 1000 AS recv_ts_us,
    CASE WHEN event_type = 'signup' AND event_id % 5 = 0 THEN 'snapshot' WHEN event_type = 'purchase' THEN 'trade'
         WHEN event_type = 'error' AND event_id % 7 = 0 THEN 'gap' ELSE 'delta' END AS kind,
    CASE WHEN event_id % 2 = 0 THEN 'yes' ELSE 'no' END AS side,
    CAST((1 + (event_id * 7 + user_id) % 9) * 50000 AS BIGINT) AS price_micro,
    CAST(round(value * 100) AS BIGINT) * CASE WHEN event_type IN ('click', 'error') THEN -1 ELSE 1 END AS qty_centi,
    row_number() OVER (PARTITION BY user_id % 8 ORDER BY us, event_id) - 1 AS line_no
  FROM base)"""

BOOK = MSG + """,
num AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY line_no) - 1 AS event_idx FROM msg WHERE kind IN ('snapshot', 'delta')),
flat AS (
  SELECT ticker, event_idx, recv_ts_us, line_no AS seq, true AS is_snapshot, s.side,
    CAST((1 + (event_id * 7 + k.k * 2) % 9) * 50000 AS BIGINT) AS price_micro,
    CAST(1000 + (event_id % 50) * 100 + k.k * 10 AS BIGINT) AS qty_centi, s.o * 3 + k.k AS pos
  FROM num, (VALUES ('yes', 0), ('no', 1)) s(side, o), (VALUES (0), (1), (2)) k(k) WHERE kind = 'snapshot'
  UNION ALL
  SELECT ticker, event_idx, recv_ts_us, line_no, false, side, price_micro, qty_centi, 0 FROM num WHERE kind = 'delta'),
be AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY event_idx, pos) - 1 AS file_row FROM flat)"""

LEVELS = BOOK + """,
ep AS (SELECT *, coalesce(max(CASE WHEN is_snapshot THEN event_idx END) OVER (PARTITION BY ticker ORDER BY event_idx RANGE UNBOUNDED PRECEDING), -1) AS epoch FROM be),
sm AS (SELECT *, sum(qty_centi) OVER (PARTITION BY ticker, epoch, side, price_micro ORDER BY event_idx) AS s FROM ep),
mn AS (SELECT *, min(s) OVER (PARTITION BY ticker, epoch, side, price_micro ORDER BY event_idx) AS m FROM sm),
lv AS (
  SELECT *, CAST(s - least(0, m) AS BIGINT) AS qty_after, lead(event_idx) OVER (PARTITION BY ticker, epoch, side, price_micro ORDER BY event_idx) AS next_idx
  FROM mn),
lvb AS (SELECT *, coalesce(lag(qty_after) OVER (PARTITION BY ticker, epoch, side, price_micro ORDER BY event_idx), 0) AS qty_before FROM lv)"""

TOP = LEVELS + """,
ev AS (SELECT ticker, epoch, event_idx, recv_ts_us, seq, bool_or(is_snapshot) AS snap FROM ep GROUP BY ALL),
live AS (
  SELECT e.ticker, e.event_idx, l.side, l.price_micro AS p, l.qty_after AS q
  FROM ev e JOIN lv l ON l.ticker = e.ticker AND l.epoch = e.epoch AND l.event_idx <= e.event_idx AND e.event_idx < coalesce(l.next_idx, 9223372036854775807)
  WHERE l.qty_after > 0 OR l.is_snapshot),
agg AS (
  SELECT ticker, event_idx,
    max(p) FILTER (side = 'yes') AS yb, max_by(q, p) FILTER (side = 'yes') AS ybs, max(p) FILTER (side = 'no') AS nb, max_by(q, p) FILTER (side = 'no') AS nbs,
    sum(q) FILTER (side = 'yes') AS yt, sum(q) FILTER (side = 'no') AS nt, count(*) FILTER (side = 'yes') AS yl, count(*) FILTER (side = 'no') AS nl
  FROM live GROUP BY ALL),
top AS (
  SELECT e.ticker, e.event_idx, recv_ts_us, recv_ts_us AS event_ts_us, seq, CASE WHEN snap THEN 'snapshot' ELSE 'delta' END AS event,
    yb AS yes_bid_micro, coalesce(ybs, 0) AS yes_bid_sz_centi,
    CASE WHEN nb IS NOT NULL THEN greatest(1000000 - nb, 0) END AS yes_ask_micro, coalesce(nbs, 0) AS yes_ask_sz_centi,
    CASE WHEN nb IS NOT NULL THEN (yb + greatest(1000000 - nb, 0)) // 2 END AS mid_micro,
    CASE WHEN nb IS NOT NULL THEN greatest(1000000 - nb, 0) - yb END AS spread_micro,
    CAST(coalesce(yt, 0) AS BIGINT) AS yes_total_centi, CAST(coalesce(nt, 0) AS BIGINT) AS no_total_centi,
    CAST(coalesce(yl, 0) AS BIGINT) AS yes_levels, CAST(coalesce(nl, 0) AS BIGINT) AS no_levels,
    CASE WHEN coalesce(yt, 0) + coalesce(nt, 0) <> 0
      THEN CAST(coalesce(yt, 0) - coalesce(nt, 0) AS DOUBLE) / CAST(coalesce(yt, 0) + coalesce(nt, 0) AS DOUBLE) END AS imbalance
  FROM ev e LEFT JOIN agg a ON e.ticker = a.ticker AND e.event_idx = a.event_idx)"""

_TRADE_BODY = """,
tr0 AS (
  SELECT ticker, event_id, recv_ts_us + 1200000 AS event_ts_us, price_micro, qty_centi AS count_centi, side AS taker_side, recv_ts_us, line_no AS seq,
    CASE WHEN event_id % 2 = 0 THEN 'bid' ELSE 'ask' END AS taker_book_side, CASE WHEN event_id % 13 <> 0 THEN concat('t', event_id) END AS trade_id
  FROM msg WHERE kind = 'trade' AND event_id % 11 <> 0
  UNION ALL
  SELECT ticker, event_id, recv_ts_us + 1200000, price_micro, qty_centi, side, 1800000000000000, NULL, NULL, concat('t', event_id)
  FROM msg WHERE kind = 'trade' AND (event_id % 3 = 0 OR event_id % 11 = 0)),
tr AS (
  SELECT * EXCLUDE (event_id), row_number() OVER (PARTITION BY ticker ORDER BY seq IS NULL, event_id) - 1 AS file_row,
    CASE WHEN seq IS NULL THEN event_ts_us ELSE recv_ts_us END AS eff_ts_us, CASE WHEN seq IS NULL THEN 'rest_backfill' ELSE 'ws' END AS source
  FROM tr0),
rk AS (
  SELECT *, row_number() OVER (PARTITION BY ticker, trade_id ORDER BY seq IS NULL, eff_ts_us, seq, file_row) AS p,
    row_number() OVER (PARTITION BY ticker, trade_id, source ORDER BY eff_ts_us, seq, file_row) AS r, count(*) OVER (PARTITION BY ticker, trade_id) AS n
  FROM tr WHERE trade_id IS NOT NULL),
dd AS (
  SELECT p.ticker, p.trade_id, p.eff_ts_us, p.recv_ts_us, p.event_ts_us, p.seq, p.file_row, p.source,
    coalesce(r.price_micro, p.price_micro) AS price_micro, coalesce(r.count_centi, p.count_centi) AS count_centi, coalesce(r.taker_side, p.taker_side) AS taker_side,
    coalesce(r.taker_book_side, p.taker_book_side) AS taker_book_side, p.n AS copies
  FROM rk p LEFT JOIN (SELECT * FROM rk WHERE source = 'rest_backfill' AND r = 1) r ON p.ticker = r.ticker AND p.trade_id = r.trade_id WHERE p.p = 1
  UNION ALL
  SELECT ticker, trade_id, eff_ts_us, recv_ts_us, event_ts_us, seq, file_row, source, price_micro, count_centi, taker_side, taker_book_side, 1 FROM tr WHERE trade_id IS NULL)"""

_GAP_BODY = """,
gp AS (
  SELECT ticker, recv_ts_us, line_no AS seq, line_no - 1 AS last_seq, line_no + 1 AS observed_seq, 'seq_jump' AS reason, 'orderbook' AS channel, concat('seq jumped ', line_no - 1, ' -> ', line_no + 1) AS detail,
    row_number() OVER (PARTITION BY ticker ORDER BY line_no) - 1 AS file_row
  FROM msg WHERE kind = 'gap')"""

TRADES, GAPS = MSG + _TRADE_BODY, MSG + _GAP_BODY

_SPAN_BODY = """,
span AS (SELECT ticker, min(recv_ts_us) AS a, max(recv_ts_us) AS b FROM be GROUP BY ticker),
hl AS (
  SELECT g.ticker, g.recv_ts_us, g.reason, g.channel, g.detail, g.sn AS snap, coalesce(g.sn, CASE WHEN s.b >= g.recv_ts_us THEN s.b END) AS hole_end_us, s.a, s.b
  FROM (SELECT gp.*, (SELECT min(recv_ts_us) FROM be WHERE be.ticker = gp.ticker AND be.is_snapshot AND be.recv_ts_us >= gp.recv_ts_us) AS sn FROM gp) g
  JOIN span s ON s.ticker = g.ticker)"""

_COVER_BODY = _SPAN_BODY + """,
cl AS (SELECT ticker, greatest(recv_ts_us, a) AS x, least(hole_end_us, b) AS y FROM hl),
ok AS (SELECT *, max(y) OVER (PARTITION BY ticker ORDER BY x, y ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS far FROM cl WHERE y > x),
isl AS (SELECT *, sum(CASE WHEN far IS NULL OR x > far THEN 1 ELSE 0 END) OVER (PARTITION BY ticker ORDER BY x, y ROWS UNBOUNDED PRECEDING) AS k FROM ok),
un AS (SELECT ticker, sum(len) AS h FROM (SELECT ticker, k, max(y) - min(x) AS len FROM isl GROUP BY ALL) GROUP BY ticker),
cov AS (
  SELECT s.ticker, true AS has_book, s.a AS span_start_us, s.b AS span_end_us, s.b - s.a AS span_us,
    (SELECT count(DISTINCT event_idx) FROM be WHERE be.ticker = s.ticker) AS n_events,
    (SELECT count(DISTINCT event_idx) FROM be WHERE be.ticker = s.ticker AND is_snapshot) AS n_snapshots,
    (SELECT count(*) FROM tr WHERE tr.ticker = s.ticker) AS n_trades, (SELECT count(*) FROM gp WHERE gp.ticker = s.ticker) AS n_gaps,
    (SELECT count(*) FROM hl WHERE hl.ticker = s.ticker AND snap IS NULL) AS n_unresolved, CAST(coalesce(un.h, 0) AS BIGINT) AS hole_us,
    1 - CAST(coalesce(un.h, 0) AS DOUBLE) / CAST(s.b - s.a AS DOUBLE) AS uptime
  FROM span s LEFT JOIN un ON s.ticker = un.ticker)"""

COVER = BOOK + _TRADE_BODY + _GAP_BODY + _COVER_BODY

_STREAM_BODY = """,
lanes AS (
  SELECT ticker, recv_ts_us AS ts, 0 AS sc, seq, 0 AS lane, 0 AS ei, file_row, 'gap' AS kind, NULL AS source, NULL AS event_idx, NULL AS side, NULL AS price_micro, NULL AS qty_centi, NULL AS n_levels, CAST(NULL AS VARCHAR) AS levels, NULL AS trade_id, NULL AS taker_book_side, reason, detail FROM gp
  UNION ALL
  SELECT ticker, min(recv_ts_us), 0, min(seq), 1, event_idx, min(file_row), CASE WHEN bool_or(is_snapshot) THEN 'snapshot' ELSE 'delta' END, NULL, event_idx,
    CASE WHEN bool_or(is_snapshot) THEN NULL ELSE min(side) END, CASE WHEN bool_or(is_snapshot) THEN NULL ELSE min(price_micro) END,
    CASE WHEN bool_or(is_snapshot) THEN NULL ELSE min(qty_centi) END, CASE WHEN bool_or(is_snapshot) THEN count(*) END,
    CASE WHEN bool_or(is_snapshot) THEN string_agg(concat(side, ':', price_micro, ':', qty_centi), ',' ORDER BY file_row) END, NULL, NULL, NULL, NULL
  FROM be GROUP BY ticker, event_idx
  UNION ALL
  SELECT ticker, eff_ts_us, CASE WHEN seq IS NULL THEN 1 ELSE 0 END, seq, 2, 0, file_row, 'trade', source, NULL, taker_side, price_micro, count_centi, NULL, NULL, trade_id, taker_book_side, NULL, NULL FROM dd),
stream AS (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY ts, sc, seq, lane, ei, file_row) - 1 AS pos FROM lanes)"""

STREAM = BOOK + _TRADE_BODY + _GAP_BODY + _STREAM_BODY

_PENDING = """
SELECT * FROM stream s WHERE kind = 'gap' AND ts < {t}
  AND pos > coalesce((SELECT max(pos) FROM stream z WHERE z.ticker = s.ticker AND z.kind = 'snapshot' AND z.ts < {t}), -1)"""

_VERIFY_BODY = """,
lad AS (
  SELECT e.ticker, e.event_idx, e.epoch, e.recv_ts_us AS t, coalesce(y.a, []) AS yes, coalesce(n.a, []) AS no
  FROM ev e
  LEFT JOIN (SELECT ticker, event_idx, list({'price': p, 'quantity': q} ORDER BY p) AS a FROM live WHERE side = 'yes' GROUP BY ALL) y ON y.ticker = e.ticker AND y.event_idx = e.event_idx
  LEFT JOIN (SELECT ticker, event_idx, list({'price': p, 'quantity': q} ORDER BY p) AS a FROM live WHERE side = 'no' GROUP BY ALL) n ON n.ticker = e.ticker AND n.event_idx = e.event_idx),
st AS (SELECT *, lead(t) OVER (PARTITION BY ticker ORDER BY event_idx) AS succ FROM lad),
ob AS (
  SELECT v.ticker, v.event_idx AS i, v.t + 1 AS ts, v.t AS cur_t, v.yes AS cy, v.no AS cn, v.epoch,
    CASE WHEN (v.event_idx // 50) % 5 = 4 THEN list_append(s.yes, {'price': CAST(990000 AS BIGINT), 'quantity': CAST(7 AS BIGINT)}) ELSE s.yes END AS ry, s.no AS rn
  FROM st v JOIN st s ON s.ticker = v.ticker AND s.event_idx = v.event_idx - (v.event_idx // 50) % 4
  WHERE v.event_idx % 50 = 0 AND v.event_idx > 0),
obn AS (SELECT *, lead(ts) OVER (PARTITION BY ticker ORDER BY i) AS nv FROM ob),
fact AS (
  SELECT o.*,
    (SELECT max(recv_ts_us) FROM gp WHERE gp.ticker = o.ticker AND gp.recv_ts_us <= o.ts) AS g0,
    (SELECT min(recv_ts_us) FROM gp WHERE gp.ticker = o.ticker AND gp.recv_ts_us > o.ts) AS g1,
    (SELECT min(t) FROM st WHERE st.ticker = o.ticker AND st.event_idx = o.epoch) AS snap_t,
    (SELECT max(t) FROM st WHERE st.ticker = o.ticker AND st.event_idx < o.i AND st.succ > o.cur_t - 5000000 AND st.succ >= o.ts - 5000000 AND st.yes = o.ry AND st.no = o.rn) AS bt,
    (SELECT min(t) FROM st WHERE st.ticker = o.ticker AND st.event_idx > o.i AND st.t <= o.ts + 5000000 AND st.yes = o.ry AND st.no = o.rn) AS ahead,
    (SELECT min(t) FROM st WHERE st.ticker = o.ticker AND st.event_idx > o.i AND st.t > o.ts + 5000000) AS late
  FROM obn o),
outc AS (
  SELECT *, least(coalesce(g1, 9223372036854775807), coalesce(nv, 9223372036854775807), coalesce(ahead, 9223372036854775807), coalesce(late, 9223372036854775807)) AS f FROM fact),
oc AS (
  SELECT *, CASE WHEN g0 IS NOT NULL AND (snap_t IS NULL OR g0 > snap_t) THEN 'skipped_gap' WHEN cy = ry AND cn = rn THEN 'matched' WHEN bt IS NOT NULL THEN 'matched'
    WHEN f = 9223372036854775807 THEN 'truncated' WHEN ahead = f THEN 'matched' WHEN g1 = f THEN 'skipped_gap' ELSE 'mismatch' END AS outcome
  FROM outc)"""

VERIFY = TOP + _GAP_BODY + _VERIFY_BODY

MARKETS = """
mk0 AS (
  SELECT o_orderkey AS pos, concat('KXO', o_custkey % 20) AS series,
    concat('KXO', o_custkey % 20, '-', upper(strftime(o_orderdate, '%y%b%d')), lpad(CAST(o_orderkey % 24 AS VARCHAR), 2, '0')) AS stamp,
    CASE o_orderstatus WHEN 'F' THEN 'finalized' WHEN 'O' THEN 'active' ELSE CASE WHEN o_orderkey % 3 = 0 THEN 'closed' ELSE 'open' END END AS status,
    epoch_us(date_trunc('day', o_orderdate)) + (o_orderkey % 24) * 3600000000 AS open_us,
    CASE o_orderkey % 5 WHEN 0 THEN 60 WHEN 1 THEN 1440 WHEN 2 THEN 10000 WHEN 3 THEN 20000 ELSE 200 + o_custkey % 7 END AS minutes
  FROM orders),
mk AS (
  SELECT pos, series, concat(stamp, '-T', pos % 7) AS ticker, CASE WHEN pos % 11 <> 0 THEN stamp END AS event, status, open_us, open_us + minutes * 60000000 AS close_us FROM mk0)"""

_CADENCE = """CASE WHEN {m} > 10860 THEN 'Long' WHEN {m} BETWEEN 50 AND 70 THEN 'Hourly' WHEN {m} BETWEEN 1380 AND 1620 THEN 'Daily'
  WHEN {m} BETWEEN 9360 AND 10860 THEN 'Weekly' ELSE 'Other' END"""
_TERMINAL = "coalesce({s} IN ('closed', 'settled', 'finalized', 'determined'), false)"

COHORTS = MARKETS + """,
fs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ticker ORDER BY pos) AS rn FROM mk) WHERE rn = 1),
co AS (
  SELECT coalesce(event, regexp_extract(ticker, '^(.*)-[^-]*$', 1)) AS event, min(open_us) AS open_us, max(close_us) AS close_us, count(*) AS n_markets,
    string_agg(ticker, ',' ORDER BY pos) AS tickers
  FROM fs WHERE NOT """ + _TERMINAL.format(s="status") + " GROUP BY 1)"

SERIES = """
se AS (
  SELECT p_type AS category, concat(p_brand, '-', p_type) AS ticker, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS volume
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY ALL)"""

_MONTHS = "JAN|FEB|MAR|APR|MAY|JUN|JUL|AUG|SEP|OCT|NOV|DEC"


def _date(text: str) -> str:
    p = f"'-(\\d{{2}})({_MONTHS})(\\d{{2}})'"
    month = f"lpad(CAST(list_position(['{_MONTHS.replace('|', chr(39) + ', ' + chr(39))}'], regexp_extract({text}, {p}, 2)) AS VARCHAR), 2, '0')"
    return f"TRY_CAST(concat('20', regexp_extract({text}, {p}, 1), '-', {month}, '-', regexp_extract({text}, {p}, 3)) AS DATE)"


_EVENT_START = f"""
WITH {MARKETS},
e AS (SELECT DISTINCT concat(series, '-', regexp_extract(ticker, '-([^-]+)-', 1), lpad(CAST(pos % 60 AS VARCHAR), 2, '0')) AS event FROM mk),
p AS (SELECT event, {_date('event')} AS d, CAST(event[-4:-3] AS INT) AS hh, CAST(event[-2:] AS INT) AS mm FROM e),
s AS (SELECT *, make_date(year(d), 3, 8) AS m8, make_date(year(d), 11, 1) AS n1 FROM p),
z AS (SELECT *, m8 + CAST((7 - dayofweek(m8)) % 7 AS INT) AS st, n1 + CAST((7 - dayofweek(n1)) % 7 AS INT) AS en FROM s)
SELECT event, CAST(epoch_us(d) + CAST(hh + CASE WHEN d >= st AND d < en THEN 4 ELSE 5 END AS BIGINT) * 3600000000 + CAST(mm AS BIGINT) * 60000000 AS BIGINT) AS start_us FROM z
"""


def _parse_error(scale: int, most: int, signed: bool) -> tuple[str, str]:
    v = f"TRY_CAST(concat(regexp_extract(text, '^(-?[0-9]+)', 1), rpad(regexp_extract(text, '\\.([0-9]+)$', 1), {scale}, '0')) AS HUGEINT)"
    neg = "" if signed else "WHEN text LIKE '-%' THEN 'negative' "
    return f"""CASE WHEN text = '' THEN 'empty' WHEN NOT regexp_full_match(text, '-?[0-9]+(\\.[0-9]+)?') THEN 'not_numeric'
      WHEN length(regexp_extract(text, '\\.([0-9]+)$', 1)) > {scale} THEN 'too_many_decimals' {neg}WHEN {v} > {most} THEN 'overflow' END""", v


_PE, _PV = _parse_error(6, 4294967295, False)
_DE, _DV = _parse_error(2, 9223372036854775807, True)

_OHOLE = "SELECT ticker, recv_ts_us, reason, channel, detail, hole_end_us, snap IS NOT NULL AS resolved, hole_end_us - recv_ts_us AS hole_us FROM hl"

_SUSPECT_LANE = """,
shifted AS (SELECT * REPLACE (recv_ts_us - CASE WHEN event_idx % 29 = 7 THEN 60000000 ELSE 0 END AS recv_ts_us) FROM be),
ln AS (
  SELECT ticker, 0 AS lane, file_row, recv_ts_us AS ts, seq, 0 AS event_idx FROM gp
  UNION ALL SELECT ticker, 1, min(file_row), min(recv_ts_us), min(seq), event_idx FROM shifted GROUP BY ticker, event_idx),
lg AS (SELECT *, lag({'a': ts, 'b': seq, 'c': event_idx, 'd': file_row}) OVER (PARTITION BY ticker, lane ORDER BY file_row) AS p FROM ln)
SELECT ticker, CAST(lane AS INTEGER) AS lane, file_row, ts, p.a AS prev_ts FROM lg WHERE {'a': ts, 'b': seq, 'c': event_idx, 'd': file_row} < p"""

ORACLE: dict[str, str] = {
    "book_events_flatten": f"WITH {BOOK} SELECT ticker, event_idx, recv_ts_us, recv_ts_us AS event_ts_us, seq, CAST(NULL AS BIGINT) AS sid, is_snapshot, side, price_micro, qty_centi, file_row FROM be",
    "book_level_replay": f"WITH {LEVELS} SELECT ticker, epoch, event_idx, recv_ts_us, is_snapshot, side, price_micro, qty_centi, qty_after, next_idx FROM lv",
    "book_underflows": f"WITH {LEVELS} SELECT ticker, event_idx, side, price_micro, qty_before, qty_centi, count(*) OVER (PARTITION BY ticker ORDER BY event_idx) AS underflows FROM lvb WHERE NOT is_snapshot AND qty_before + qty_centi < 0",
    "book_top": f"WITH {TOP} SELECT * FROM top",
    "book_top_dollars": f"WITH {TOP} SELECT ticker, event_idx, yes_bid_micro / 1e6 AS yes_bid, yes_ask_micro / 1e6 AS yes_ask, mid_micro / 1e6 AS mid FROM top",
    "two_sided_by_ticker": f"WITH {TOP} SELECT ticker, count(*) AS n_events, count(*) FILTER (yes_bid_micro IS NOT NULL AND yes_ask_micro IS NOT NULL) AS n_two_sided, bool_or(yes_bid_micro IS NOT NULL AND yes_ask_micro IS NOT NULL) AS two_sided, count(*) FILTER (yes_levels = 0 AND no_levels = 0) AS n_empty FROM top GROUP BY ticker",
    "trades_tape": f"WITH {TRADES} SELECT ticker, file_row, recv_ts_us, event_ts_us, seq, price_micro, count_centi, price_micro / 1e6 AS yes_price, count_centi / 1e2 AS count, taker_side, taker_book_side, trade_id FROM tr",
    "trades_dedup": f"WITH {TRADES} SELECT * FROM dd",
    "trades_top10": f"WITH {TRADES} SELECT ticker, file_row, price_micro, count_centi, trade_id FROM tr ORDER BY count_centi DESC, ticker, file_row LIMIT 10",
    "taker_pressure": f"WITH {TRADES} SELECT ticker, taker_side, CAST(sum(count_centi) AS BIGINT) AS count_centi, count(*) AS n FROM tr GROUP BY ALL",
    "gap_markers": f"""WITH {GAPS},
      mk AS (SELECT CAST(right(ticker, 1) AS BIGINT) % 2 AS sid, CASE WHEN seq % 5 = 0 THEN 'reconnect' ELSE 'seq_jump' END AS kind, recv_ts_us, last_seq, observed_seq FROM gp),
      tk AS (SELECT DISTINCT ticker, CAST(right(ticker, 1) AS BIGINT) % 2 AS sid FROM gp),
      ch AS (SELECT sid, kind, recv_ts_us, CASE WHEN kind = 'seq_jump' THEN last_seq END AS last_seq, CASE WHEN kind = 'seq_jump' THEN observed_seq END AS observed_seq, unnest(CASE WHEN kind = 'reconnect' THEN ['orderbook', 'trade'] ELSE ['orderbook'] END) AS channel FROM mk)
      SELECT ticker, channel, kind, count(*) AS n, min(recv_ts_us) AS first_us, max(recv_ts_us) AS last_us, min(last_seq) AS least_last_seq, max(observed_seq) AS most_observed_seq FROM ch JOIN tk USING (sid) GROUP BY ALL""",
    "seq_gap_detect": f"""WITH {MSG},
      fr AS (SELECT ticker AS sid, line_no, kind, CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_id % 23 = 0 THEN line_no - 1 WHEN event_id % 17 = 3 THEN line_no + 2 ELSE line_no END AS seq FROM msg WHERE kind <> 'gap'),
      er AS (SELECT *, sum(CASE WHEN kind = 'snapshot' THEN 1 ELSE 0 END) OVER (PARTITION BY sid ORDER BY line_no) AS era FROM fr),
      la AS (SELECT *, last_value(seq IGNORE NULLS) OVER (PARTITION BY sid, era ORDER BY line_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_seq FROM er)
      SELECT sid, line_no, kind, seq, last_seq, CASE WHEN kind = 'snapshot' OR seq IS NULL OR last_seq IS NULL OR seq = last_seq + 1 THEN 'accept' WHEN seq = last_seq THEN 'duplicate' ELSE 'gap' END AS verdict FROM la""",
    "gap_holes": f"WITH {BOOK}{_GAP_BODY}{_SPAN_BODY} {_OHOLE}",
    "coverage_by_ticker": f"WITH {COVER} SELECT * FROM cov",
    "coverage_rollup_by_date": f"WITH {COVER} SELECT CAST({_date('ticker')} AS VARCHAR) AS date, round(avg(uptime), 6) AS mean_uptime, CAST(sum(hole_us) AS BIGINT) AS hole_us, count(*) AS n FROM cov GROUP BY 1",
    "merged_stream": f"WITH {STREAM} SELECT ticker, pos, ts, kind, source, CASE WHEN kind IN ('gap', 'trade') THEN 0 ELSE event_idx END AS event_idx, side, price_micro, qty_centi, n_levels, levels, trade_id, taker_book_side, reason, detail FROM stream",
    "order_violations": f"WITH {BOOK}{_GAP_BODY}{_SUSPECT_LANE}",
    "range_replay": f"""WITH {LEVELS}{_TRADE_BODY}{_GAP_BODY}{_STREAM_BODY},
      pend AS ({_PENDING.format(t=T0)}),
      ope AS (SELECT ticker, count(*) AS n, string_agg(concat(side, ':', price_micro, ':', qty_after), ',' ORDER BY side DESC, price_micro) AS l FROM (SELECT *, max(epoch) OVER (PARTITION BY ticker) AS le, row_number() OVER (PARTITION BY ticker, epoch, side, price_micro ORDER BY event_idx DESC) AS rn FROM lv WHERE recv_ts_us < {T0}) WHERE epoch = le AND rn = 1 AND qty_after > 0 GROUP BY ticker)
      SELECT ticker, 0 AS lead, ts, kind, source, 0 AS event_idx, side, price_micro, qty_centi, n_levels, levels, trade_id, taker_book_side, reason, detail, false AS synthetic FROM pend
      UNION ALL SELECT t.ticker, 1, {T0}, 'snapshot', NULL, -1, NULL, NULL, NULL, coalesce(n, 0), coalesce(l, ''), NULL, NULL, NULL, NULL, true FROM (SELECT DISTINCT ticker FROM stream WHERE ts < {T1}) t LEFT JOIN ope USING (ticker)
      UNION ALL SELECT ticker, 2, ts, kind, source, CASE WHEN kind IN ('gap', 'trade') THEN 0 ELSE event_idx END, side, price_micro, qty_centi, n_levels, levels, trade_id, taker_book_side, reason, detail, false FROM stream WHERE ts >= {T0} AND ts < {T1}""",
    "book_at_instant": f"""WITH {LEVELS}
      SELECT ticker, side, price_micro, qty_after AS qty_centi FROM (SELECT *, max(epoch) OVER (PARTITION BY ticker) AS le, row_number() OVER (PARTITION BY ticker, epoch, side, price_micro ORDER BY event_idx DESC) AS rn FROM lv WHERE recv_ts_us < {T0})
      WHERE epoch = le AND rn = 1 AND qty_after > 0""",
    "pending_gaps": f"WITH {STREAM} SELECT ticker, ts, seq, reason FROM ({_PENDING.format(t=T1)})",
    "event_kind_counts": f"WITH {STREAM} SELECT kind, source, count(*) AS n FROM stream GROUP BY ALL",
    "trade_book_asof": f"WITH {TOP}{_TRADE_BODY} SELECT tr.ticker, file_row, eff_ts_us, price_micro, count_centi, top.event_idx, yes_bid_micro, yes_ask_micro FROM tr ASOF LEFT JOIN top ON tr.ticker = top.ticker AND tr.eff_ts_us >= top.recv_ts_us",
    "events_book_join": f"WITH {TOP} SELECT be.ticker, file_row, be.event_idx, side, price_micro, yes_bid_micro, yes_ask_micro, mid_micro FROM be JOIN top ON be.ticker = top.ticker AND be.event_idx = top.event_idx",
    "verify_outcomes": f"""WITH {VERIFY} SELECT ticker, i AS event_idx, ts AS recv_ts_us, outcome,
      CASE WHEN outcome <> 'matched' THEN NULL WHEN cy = ry AND cn = rn THEN 0 WHEN bt IS NOT NULL THEN greatest(bt, ts - 5000000) - ts ELSE ahead - ts END AS match_lag_us FROM oc""",
    "verify_level_diff": f"""WITH {VERIFY},
      sd AS (SELECT ticker, i, 'yes' AS side, cy AS a, ry AS b FROM oc WHERE outcome = 'mismatch' UNION ALL SELECT ticker, i, 'no', cn, rn FROM oc WHERE outcome = 'mismatch'),
      xa AS (SELECT ticker, i, side, l.price AS p, l.quantity AS q FROM (SELECT ticker, i, side, unnest(a) AS l FROM sd)),
      xb AS (SELECT ticker, i, side, l.price AS p, l.quantity AS q FROM (SELECT ticker, i, side, unnest(b) AS l FROM sd)),
      d AS (SELECT coalesce(xa.ticker, xb.ticker) AS ticker, coalesce(xa.i, xb.i) AS i, coalesce(xa.side, xb.side) AS side, coalesce(xa.p, xb.p) AS p, xa.q AS o, xb.q AS r FROM xa FULL JOIN xb ON xa.ticker = xb.ticker AND xa.i = xb.i AND xa.side = xb.side AND xa.p = xb.p WHERE xa.q IS DISTINCT FROM xb.q),
      f AS (SELECT ticker, i AS event_idx, side, count(*) AS n_differing, min(p) AS first_price_micro, arg_min({{'o': o, 'r': r}}, p) AS z FROM d GROUP BY ALL)
      SELECT ticker, event_idx, side, n_differing, first_price_micro, z.o AS our_qty_centi, z.r AS rest_qty_centi, concat(first_price_micro // 1000000, '.', lpad(CAST(first_price_micro % 1000000 AS VARCHAR), 6, '0')) AS first_price FROM f""",
    "manifest_summary": f"""WITH {TOP}{_TRADE_BODY}{_GAP_BODY}
      SELECT ticker, count(*) AS records, min(recv_ts_us) AS first_recv_us, max(recv_ts_us) AS last_recv_us,
        (SELECT count(*) FROM be WHERE be.ticker = msg.ticker) AS book_events, (SELECT count(*) FROM tr WHERE tr.ticker = msg.ticker) AS trades, (SELECT count(*) FROM gp WHERE gp.ticker = msg.ticker) AS gaps,
        (SELECT bool_or(yes_bid_micro IS NOT NULL AND yes_ask_micro IS NOT NULL) FROM top WHERE top.ticker = msg.ticker) AS two_sided
      FROM msg GROUP BY ticker""",
    "digest": f"""WITH {LEVELS}{_TRADE_BODY}{_GAP_BODY}{_COVER_BODY},
      uf AS (SELECT ticker, count(*) AS u FROM lvb WHERE NOT is_snapshot AND qty_before + qty_centi < 0 GROUP BY ticker)
      SELECT count(DISTINCT split_part(cov.ticker, '-', 1)) AS n_sessions, count(*) AS n_tickers, count(*) FILTER (NOT n_gaps < 40) AS n_incomplete, CAST(sum(n_gaps) AS BIGINT) AS n_gaps,
        CAST(NULL AS BIGINT) AS n_mismatches, CAST(sum(u) AS BIGINT) AS n_underflows, min(uptime) AS worst_uptime, arg_min(cov.ticker, {{'a': uptime, 'b': cov.ticker}}) AS worst_ticker, count(*) FILTER (uptime < 0.5) AS n_below_floor
      FROM cov LEFT JOIN uf ON cov.ticker = uf.ticker""",
    "mid_summary": f"WITH {TOP} SELECT ticker, count(*) AS n, min(mid_micro) AS min_mid, max(mid_micro) AS max_mid FROM top WHERE mid_micro IS NOT NULL GROUP BY ticker",
    "hourly_completeness": f"""WITH {MARKETS},
      lb AS (SELECT series, regexp_extract(ticker, '-(\\d{{2}}[A-Z]{{3}}\\d{{2}})(\\d{{2}})-', 1) AS dd, regexp_extract(ticker, '-(\\d{{2}}[A-Z]{{3}}\\d{{2}})(\\d{{2}})-', 2) AS hour FROM mk),
      wd AS (SELECT series, concat(dd[1:2], lpad(CAST(dayofyear({_date("concat('-', dd)")}) // 35 AS VARCHAR), 2, '0')) AS day, hour FROM lb),
      h AS (SELECT series, day, count(DISTINCT hour) AS n_hours FROM wd GROUP BY ALL)
      SELECT series, day, n_hours, CASE WHEN n_hours = 24 THEN 'full' WHEN day = min(day) OVER (PARTITION BY series) OR day = max(day) OVER (PARTITION BY series) THEN 'edge' WHEN n_hours >= 22 THEN 'maint' ELSE 'incomplete' END AS class FROM h""",
    "category_rollup": f"WITH {SERIES} SELECT category, count(*) AS n_series, CAST(sum(volume) AS BIGINT) AS volume FROM se GROUP BY category",
    "rank_series": f"WITH {SERIES} SELECT category, ticker, volume, row_number() OVER (ORDER BY volume DESC, ticker) AS position FROM se",
    "top_24h": f"WITH {SERIES} SELECT * FROM se ORDER BY volume DESC, ticker LIMIT 10",
    "cadence_classes": f"WITH {MARKETS} SELECT {_CADENCE.format(m='((close_us - open_us) // 60000000)')} AS cadence, {_TERMINAL.format(s='status')} AS terminal, count(*) AS n FROM mk GROUP BY ALL",
    "cohorts": f"WITH {COHORTS} SELECT * FROM co",
    "arm_plan": f"""WITH {COHORTS},
      c AS (SELECT event, {_CADENCE.format(m='((close_us - open_us) // 60000000)')} AS cadence, (open_us // 3600000000) % 30 AS k, open_us, close_us FROM co),
      q AS (SELECT *, k % 2 = 0 AS windowed, k % 3 = 0 AS clash, CASE WHEN k % 5 = 0 THEN open_us END AS st FROM c),
      d AS (SELECT *, CASE WHEN k = 7 OR k = 11 THEN 'excluded' WHEN st IS NOT NULL AND {ARM_NOW} < st - 600000000 THEN 'deferred'
        WHEN st IS NULL AND cadence IN ('Daily', 'Weekly') AND NOT clash THEN 'skipped' WHEN st IS NULL AND cadence IN ('Daily', 'Weekly') AND {ARM_NOW} < close_us - 4200000000 THEN 'deferred'
        WHEN st IS NULL AND cadence = 'Long' THEN 'skipped' WHEN st IS NULL AND cadence IN ('Hourly', 'Other') AND {ARM_NOW} < open_us - 600000000 THEN 'deferred' ELSE 'candidate' END AS dec FROM q),
      r AS (SELECT *, row_number() OVER (PARTITION BY dec ORDER BY event) AS rn, (SELECT count(*) FROM q WHERE k = 7) AS used FROM d)
      SELECT event, CASE WHEN dec <> 'candidate' THEN dec WHEN rn <= 3000 - used THEN 'arm' ELSE 'capped' END AS decision, dec = 'candidate' AND st IS NULL AND cadence = 'Other' AND windowed AS no_start FROM r""",
    "largest_ladder": f"WITH {MARKETS}, c AS (SELECT event, count(*) AS n FROM mk WHERE event IS NOT NULL AND open_us = {LADDER_OPEN} GROUP BY event) SELECT event, n FROM c ORDER BY n DESC, event DESC LIMIT 1",
    "ladder_band": """WITH p AS (SELECT p_brand AS event, p_partkey AS pos, p_size AS strike,
        CASE WHEN p_brand IN ('Brand#1', 'Brand#2') THEN NULL WHEN p_partkey % 4 = 0 THEN CAST(p_partkey % 101 AS DOUBLE) / 100 END AS price, CASE WHEN p_brand = 'Brand#2' THEN CAST(20.4 AS DOUBLE) END AS anchor FROM part),
      s AS (SELECT event, strike, min(pos) AS pos, min(price) AS price, min(anchor) AS anchor FROM p GROUP BY ALL),
      n AS (SELECT *, row_number() OVER (PARTITION BY event ORDER BY strike, pos) - 1 AS i, count(*) OVER (PARTITION BY event) AS n FROM s),
      c AS (SELECT event, coalesce(arg_min(i, {'a': abs(price - 0.5), 'b': pos}) FILTER (price IS NOT NULL), arg_min(i, {'a': abs(strike - anchor), 'b': i}) FILTER (anchor IS NOT NULL), max(n) // 2) AS c FROM n GROUP BY event)
      SELECT event, CAST(strike AS BIGINT) AS strike, i - c AS "offset" FROM n JOIN c USING (event) WHERE abs(i - c) <= 3""",
    "parse_fixed_point": f"""WITH t AS (SELECT CASE l_orderkey % 10 WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN concat('-', CAST(l_quantity AS BIGINT)) WHEN 3 THEN '0.0800' WHEN 4 THEN '0.1234567' WHEN 5 THEN '5000'
        WHEN 6 THEN concat(CAST(l_quantity AS BIGINT), '.5') WHEN 7 THEN '1.' WHEN 8 THEN '-0' ELSE concat('0.', lpad(CAST(l_orderkey % 1000000 AS VARCHAR), 6, '0')) END AS text FROM lineitem),
      e AS (SELECT text, {_PE} AS price_error, {_DE} AS delta_error, {_PV} AS pv, {_DV} AS dv FROM t)
      SELECT text, CASE WHEN price_error IS NULL THEN CAST(pv AS BIGINT) END AS micro, price_error, CASE WHEN delta_error IS NULL THEN CAST(dv AS BIGINT) END AS delta, delta_error, count(*) AS n FROM e GROUP BY ALL""",
    "ticker_dates": f"WITH {MARKETS} SELECT DISTINCT ticker, CAST({_date('ticker')} AS VARCHAR) AS date, regexp_extract(ticker, '^([^-]+-\\d{{2}}[A-Z]{{3}}\\d{{4}})', 1) AS label FROM mk",
    "event_start": _EVENT_START,
    "diagonal_union": f"WITH {TRADES}{_GAP_BODY} SELECT ticker, 'trades' AS source_path, count(*) AS n, count(price_micro) AS n_price, CAST(0 AS BIGINT) AS n_reason FROM tr GROUP BY ticker UNION ALL SELECT ticker, 'gaps', count(*), 0, count(reason) FROM gp GROUP BY ticker",
    "settled_units": f"""WITH {MARKETS}, tg AS (SELECT DISTINCT concat('u', pos % 500) AS unit, CASE WHEN pos % 9 = 4 THEN concat(ticker, '-X') ELSE ticker END AS ticker FROM mk), la AS (SELECT ticker, arg_max(status, pos) AS status FROM mk GROUP BY ticker)
      SELECT unit, bool_and({_TERMINAL.format(s='status')}) AS all_settled, count(*) AS n_targets, count(*) FILTER ({_TERMINAL.format(s='status')}) AS n_terminal FROM tg LEFT JOIN la USING (ticker) GROUP BY unit""",
    "first_seen_markets": f"WITH {MARKETS} SELECT ticker, min(pos) AS pos, arg_min(status, pos) AS status FROM mk GROUP BY ticker",
    "market_search": f"WITH {MARKETS} SELECT ticker, pos, close_us FROM mk WHERE (contains(lower(ticker), 'kxo1-') OR contains(lower(coalesce(event, '')), 'kxo1-')) AND close_us >= {ARM_NOW} AND close_us < {ARM_NOW + 200 * 86_400_000_000}",
    "name_functions": """WITH t AS (SELECT p_partkey AS k, concat(' ', p_name, ' & ', p_brand, '!') AS text FROM part UNION ALL SELECT s_suppkey, s_name FROM supplier)
      SELECT k, text, regexp_replace(regexp_replace(lower(text), '[^a-z0-9]+', '-', 'g'), '^-|-$', '', 'g') AS slug, regexp_full_match(text, '[A-Za-z0-9._-]+') AND NOT regexp_full_match(text, '\\.+') AS safe,
        CASE WHEN k % 3 = 0 THEN 'EV' WHEN text LIKE '%-%' THEN regexp_extract(text, '^(.*)-[^-]*$', 1) ELSE concat('id', k) END AS session FROM t""",
    "capture_report": f"WITH {MSG} SELECT ticker, CASE WHEN kind = 'trade' THEN 'trade' ELSE 'orderbook' END AS channel, count(*) FILTER (kind = 'snapshot') AS n_snapshot, count(*) FILTER (kind = 'delta') AS n_delta, count(*) FILTER (kind = 'trade') AS n_trade, count(*) FILTER (kind = 'gap') AS n_gap FROM msg GROUP BY ALL",
    "time_windows": f"WITH {MSG} SELECT ticker, (recv_ts_us - 1704067200000000) // 300000000 * 300000000 + 1704067200000000 AS lo_us, count(*) AS n FROM msg GROUP BY ALL",
    "json_decode_outcomes": f"""WITH {MSG},
      k AS (SELECT *, CASE WHEN kind = 'snapshot' AND event_id % 3 = 0 THEN 'verify' ELSE kind END AS kind0, event_id % 31 AS e FROM msg),
      c AS (SELECT kind0, qty_centi, price_micro, event_id, e, CASE WHEN e IN (5, 7, 8, 10, 12, 13) THEN 'json parse' WHEN e = 6 THEN 'schema' WHEN e = 11 AND kind <> 'gap' THEN 'json parse' WHEN kind IN ('delta', 'snapshot') AND e IN (1, 2) THEN 'json parse'
        WHEN kind = 'trade' AND (e = 3 OR qty_centi < 0) THEN 'json parse' WHEN kind = 'gap' AND e = 4 THEN 'json parse' END AS error_class FROM k)
      SELECT kind0, error_class, count(*) AS n, CAST(sum(CASE WHEN kind0 = 'delta' AND e <> 5 THEN qty_centi END) AS BIGINT) AS delta_sum,
        CAST(sum(CASE WHEN kind0 = 'trade' AND e <> 5 THEN CASE WHEN e = 3 THEN -1 ELSE price_micro END END) AS BIGINT) AS price_sum,
        CAST(sum(CASE WHEN kind0 IN ('snapshot', 'verify') AND error_class IS NULL THEN CASE WHEN event_id % 2 = 0 THEN 3 ELSE 6 END END) AS BIGINT) AS n_levels,
        CAST(sum(CASE WHEN kind0 IN ('snapshot', 'verify') AND error_class IS NULL THEN 3 * (1000 + event_id % 50 * 100) + 30 END) AS BIGINT) AS yes_quantity,
        count(*) FILTER (error_class IS NULL AND e = 9) AS n_wrapped FROM c GROUP BY ALL""",
    "frame_decode_outcomes": f"""WITH {MSG},
      c AS (SELECT *, CASE WHEN event_id % 29 = 3 THEN 'raw' WHEN kind = 'snapshot' THEN 'snapshot' WHEN kind = 'gap' THEN CASE WHEN event_id % 2 = 0 THEN 'control' ELSE 'raw' END
        WHEN kind = 'trade' THEN CASE WHEN event_id % 29 = 1 OR qty_centi < 0 THEN 'raw' ELSE 'trade' END WHEN event_id % 29 = 2 THEN 'raw' ELSE 'delta' END AS outcome,
        CASE WHEN event_id % 29 = 3 OR kind = 'gap' THEN NULL WHEN kind = 'trade' THEN 'trade' ELSE 'orderbook' END AS channel FROM msg)
      SELECT outcome, channel, count(*) AS n, CAST(sum(CASE WHEN outcome = 'delta' THEN qty_centi END) AS BIGINT) AS delta_sum, CAST(sum(CASE WHEN outcome IN ('delta', 'trade') THEN price_micro END) AS BIGINT) AS price_sum,
        CAST(sum(CASE WHEN outcome = 'snapshot' THEN CASE WHEN event_id % 3 = 0 THEN 0 ELSE 1 END END) AS BIGINT) AS n_yes,
        CAST(sum(CASE WHEN outcome = 'delta' AND event_id % 29 <> 4 THEN recv_ts_us // 1000 * 1000 - recv_ts_us WHEN outcome IN ('snapshot', 'trade', 'delta') THEN 0 END) AS BIGINT) AS lag_us FROM c GROUP BY ALL""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
