"""The same queries as plain SQL over the same tables, for checking results in another engine."""

from __future__ import annotations

# Written out here and not taken from the library, so that a wrong value there does not stay unseen.
REGIONS = {
    "NORTH": ["AM", "RR", "PA", "TO", "AC", "RO", "MA", "AP"],
    "NORTHEAST": ["MA", "BA", "AL", "PE", "RN", "CE", "PB", "SE", "PI"],
    "SOUTH": ["RS", "PR", "SC"],
    "SOUTHEAST": ["MG", "SP", "RJ", "ES"],
    "MIDWEST": ["MT", "GO", "MS"],
}
PERIODS = {"PT1M": 60, "PT10M": 600, "PT1H": 3600}
GRAINS = {"REGION": ["region"], "STATE": ["region", "state"], "STORE": ["region", "state", "store_id"]}
NO_STATE, NO_STORE = "NN", -1
REGION, STATE, STORE = "NORTHEAST", "BA", 10
DAY, CUTOFF = "2024-01-15", "2024-01-20 02:00:00"
PAGE_START = "PT10M#2024-01-20 00:00:00.000#2024-01-20 00:00:00.000"

_PAIRS = [(r, s) for r, states in REGIONS.items() for s in states]
_DIM = ", ".join(f"({i},'{r}','{s}')" for i, (r, s) in enumerate(_PAIRS))

EVENTS = f"""region_dim AS (SELECT * FROM (VALUES {_DIM}) AS d(idx, region, state)),
kpi_events AS (
  SELECT e.event_id, e.ts AS event_time, e.ts + to_seconds((e.event_id % 7) * 97) AS ingest_time,
    d.region, d.state, CAST(e.user_id % 15 + 1 AS int) AS store_id,
    CAST(floor(e.value) AS int) AS kpi_1,
    CAST(CAST(json_extract_string(e.props, '$.k') AS int) % 51 AS int) AS kpi_2,
    CAST(json_extract_string(e.props, '$.k') AS int) AS kpi_3,
    CAST(e.event_id % 61 AS int) AS kpi_4, CAST(e.event_id % 241 AS int) AS kpi_5
  FROM events e JOIN region_dim d ON d.idx = e.user_id % 27)"""

_SUMS = ", ".join(f"sum(kpi_{i})::BIGINT AS kpi_{i}_sum" for i in range(1, 6))
_DAY_AFTER = f"(DATE '{DAY}' + INTERVAL 1 DAY)"
_ON_DAY = f"event_time >= TIMESTAMP '{DAY}' AND event_time < {_DAY_AFTER}"


def _bucket(period: str, column: str) -> str:
    return f"time_bucket(INTERVAL '{PERIODS[period]} seconds', {column})"


def _rollup(grain: str, period: str) -> str:
    dims = GRAINS[grain]
    state = "state" if "state" in dims else f"'{NO_STATE}'"
    store = "store_id" if "store_id" in dims else str(NO_STORE)
    i, e = _bucket(period, "ingest_time"), _bucket(period, "event_time")
    return f"""SELECT 'BY_{grain}_{period}' AS type, region, {state} AS state, {store} AS store_id, {_SUMS},
  count(*) AS n_rec, {i} AS ingest_time, {e} AS event_time
FROM kpi_events GROUP BY {", ".join(dims)}, {i}, {e}"""


def _keyed(source: str) -> str:
    kpis = ", ".join(f"kpi_{i}_sum AS kpi{i}" for i in range(1, 6))
    return f"""SELECT CASE WHEN type LIKE '%STORE%' THEN region || '#' || state || '#' || store_id
    WHEN type LIKE '%STATE%' THEN region || '#' || state ELSE region END AS pk,
  split_part(type, '_', 3) || '#' || strftime(event_time, '%Y-%m-%d %H:%M:%S.%g') || '#'
    || strftime(ingest_time, '%Y-%m-%d %H:%M:%S.%g') AS sk,
  type, split_part(type, '_', 2) AS grain, split_part(type, '_', 3) AS period, region, state, store_id,
  {kpis}, n_rec, ingest_time, event_time
FROM {source}"""


_ALL = "\nUNION ALL\n".join(_rollup(g, p) for p in PERIODS for g in GRAINS)
_ITEM = "pk, sk, kpi1, kpi2, kpi3, kpi4, kpi5, n_rec, event_time, ingest_time"
_K4 = "kpi1, kpi2, kpi3, kpi4"
_PK_STATE = f"{REGION}#{STATE}"


def _events(sql: str) -> str:
    return f"WITH {EVENTS}\n{sql}"


def _items(sql: str, grain: str | None = None, period: str | None = None) -> str:
    """SQL over ``items``: the keyed store, or only one grain and period of it."""
    rows = _rollup(grain, period) if grain and period else _ALL
    return f"WITH {EVENTS},\nrollups AS ({rows}),\nitems AS ({_keyed('rollups')})\n{sql}"


def _calendar(space: str, fmt: str, where: str) -> str:
    kpis = ", ".join(f"sum(kpi_{i})::BIGINT AS kpi{i}" for i in range(1, 6))
    return _events(f"""SELECT * FROM (SELECT region AS pk, '{space}#' || strftime(event_time, '{fmt}') AS sk,
  {kpis}, count(*) AS n_rec FROM kpi_events GROUP BY 1, 2) WHERE pk = '{REGION}' AND {where}""")


def _ten_seconds(grain: str) -> str:
    dims = ", ".join(GRAINS[grain])
    return _events(f"""SELECT {dims}, sum(kpi_1)::BIGINT AS kpi_1_sum, sum(kpi_2)::BIGINT AS kpi_2_sum,
  date_trunc('minute', ingest_time) AS ingest_time
FROM kpi_events GROUP BY {dims}, date_trunc('minute', ingest_time),
  time_bucket(INTERVAL '10 seconds', ingest_time)""")


_VALUE = """pk, sk, CAST(regexp_extract(sk, '(.*)#(.*)#(.*)', 2) AS TIMESTAMP) AS time_utc,
  CAST(regexp_extract(sk, '(.*)#(.*)#(.*)', 2) AS TIMESTAMP) - INTERVAL 3 HOUR AS time_local, kpi1 AS value"""


def _latest(grain: str, period: str, pk: str, day: bool) -> str:
    where = f"pk = '{pk}' AND period = '{period}'" + (f" AND {_ON_DAY}" if day else "")
    return _items(
        f"SELECT {_VALUE} FROM (SELECT * FROM items WHERE {where} ORDER BY sk DESC LIMIT 15)", grain, period
    )


_DEDUP = """SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
  PARTITION BY pk, period, ingest_time ORDER BY sk DESC) AS rn FROM {source}) WHERE rn = 1"""

_WIRE = f"""WITH {EVENTS},
wire AS (SELECT event_id,
  CASE event_id % 9 WHEN 0 THEN 'BY_REGION_PT1M' WHEN 1 THEN 'by_region_pt10m' WHEN 2 THEN 'BY_REGION_PT1H'
    WHEN 3 THEN 'by_state_pt1m' WHEN 4 THEN 'BY_STATE_PT10M' WHEN 5 THEN 'BY_STATE_PT1H'
    WHEN 6 THEN 'BY_STORE_PT1M' WHEN 7 THEN 'BY_STORE_PT10M'
    ELSE CASE WHEN event_id % 2 = 0 THEN 'BY_STORE_PT1H' ELSE 'BY_CITY_PT5M' END END AS type,
  CASE WHEN event_id % 41 = 0 THEN NULL ELSE region END AS region,
  CASE WHEN event_id % 43 = 0 THEN NULL ELSE state END AS state,
  CASE WHEN event_id % 47 = 0 THEN NULL ELSE store_id END AS store_id,
  kpi_1, kpi_2, kpi_3, kpi_4, kpi_5,
  CASE WHEN event_id % 53 = 0 THEN NULL ELSE 1 END AS n_rec,
  CASE WHEN event_id % 59 = 0 THEN NULL ELSE event_time END AS event_time, ingest_time
  FROM kpi_events),
typed AS (SELECT * REPLACE (upper(type) AS type, coalesce(event_time, TIMESTAMP '2019-01-01') AS event_time),
  CASE WHEN upper(type) LIKE '%STORE%' THEN 'STORE' WHEN upper(type) LIKE '%STATE%' THEN 'STATE'
    WHEN upper(type) LIKE '%REGION%' THEN 'REGION' END AS grain,
  CASE WHEN upper(type) LIKE '%PT10M%' THEN 'PT10M' WHEN upper(type) LIKE '%PT1H%' THEN 'PT1H'
    WHEN upper(type) LIKE '%PT1M%' THEN 'PT1M' ELSE 'UNK' END AS period
  FROM wire),
judged AS (SELECT *, CASE WHEN region IS NULL THEN 'missing_region'
    WHEN grain IN ('STATE', 'STORE') AND state IS NULL THEN 'missing_state'
    WHEN grain = 'STORE' AND store_id IS NULL THEN 'missing_store' END AS fault FROM typed),
classified AS (SELECT event_id,
  CASE WHEN fault IS NOT NULL THEN 'error' WHEN grain IS NULL THEN 'dead_letter' ELSE 'ok' END AS status,
  CASE WHEN fault IS NULL AND grain IS NULL THEN 'unknown_type' ELSE fault END AS reason,
  CASE WHEN fault IS NOT NULL THEN NULL WHEN grain = 'STORE' THEN region || '#' || state || '#' || store_id
    WHEN grain = 'STATE' THEN region || '#' || state ELSE region END AS pk,
  CASE WHEN fault IS NULL THEN CASE WHEN grain IS NULL THEN 'UNK' ELSE period END || '#'
    || strftime(event_time, '%Y-%m-%d %H:%M:%S.%g') || '#'
    || strftime(ingest_time, '%Y-%m-%d %H:%M:%S.%g') END AS sk,
  type, grain, period, region, coalesce(state, 'NN') AS state,
  coalesce(CAST(store_id AS varchar), '0') AS store_id,
  kpi_1::BIGINT AS kpi1, kpi_2::BIGINT AS kpi2, kpi_3::BIGINT AS kpi3, kpi_4::BIGINT AS kpi4,
  kpi_5::BIGINT AS kpi5, coalesce(n_rec, 0)::BIGINT AS n_rec, event_time, ingest_time
  FROM judged)
"""

_STATS = """SELECT stat, key, count(*) AS n FROM (
  SELECT 'total' AS stat, 'all' AS key FROM classified
  UNION ALL SELECT 'total', CASE WHEN status = 'ok' THEN 'ok' ELSE 'err' END FROM classified
  UNION ALL SELECT 'grain', grain FROM classified WHERE status = 'ok'
  UNION ALL SELECT 'period', period FROM classified WHERE status <> 'error'
  UNION ALL SELECT 'state', state FROM classified WHERE status = 'ok' AND grain = 'STATE'
  UNION ALL SELECT 'region', region FROM classified WHERE status = 'ok' AND grain = 'REGION')
GROUP BY stat, key"""

_SUM4 = ", ".join(f"sum(kpi{i})::BIGINT AS kpi{i}" for i in range(1, 5))
_SERVED = "grain IN ('REGION', 'STATE')"

_TOTALS = f"""SELECT pk, period, {", ".join(f"sum(kpi{i})::BIGINT AS kpi{i}_sum" for i in range(1, 5))},
  {", ".join(f"format('{{:,}}', sum(kpi{i})::BIGINT) AS kpi{i}_text" for i in range(1, 5))}
FROM (SELECT *, row_number() OVER (PARTITION BY pk, period ORDER BY sk DESC) AS rn FROM items WHERE {_SERVED})
WHERE rn <= 200 GROUP BY pk, period"""

_WIDE = """kpi_2 AS kpi_1, kpi_3 AS kpi_2, kpi_4 AS "TicketMedio", kpi_5 AS "FatBruto",
  CAST(event_id % 1001 AS int) AS kpi_6, CAST(event_id % 997 AS int) AS kpi_7,
  CAST(event_id % 991 AS int) AS "QtdAtendimentos", CAST(event_id % 983 AS int) AS "ValorTotal"
FROM kpi_events"""

_DAILY = f"""SELECT pk, strftime(ingest_time, '%Y-%m-%d') AS day,
  {", ".join(f"sum(kpi{i})::BIGINT AS kpi{i}" for i in range(1, 6))} FROM items GROUP BY 1, 2"""

DASHBOARD: dict[str, str] = {
    **{f"rollup_{g.lower()}_{p.lower()}": _events(_rollup(g, p)) for p in PERIODS for g in GRAINS},
    **{f"rollup_10s_{g.lower()}": _ten_seconds(g) for g in GRAINS},
    "rollup_all": _events(_ALL),
    "keyed_rollup": _items("SELECT * FROM items"),
    "classify": _WIRE + "SELECT * FROM classified",
    "dead_letter": _WIRE + "SELECT * EXCLUDE (grain) FROM classified WHERE status = 'dead_letter'",
    "load_stats": _WIRE + _STATS,
    "prefix_scan": _items(
        f"SELECT {_ITEM} FROM items WHERE pk = '{_PK_STATE}' AND starts_with(sk, 'PT1H#{DAY}')", "STATE", "PT1H"
    ),
    "range_scan": _calendar(
        "SLOT", "%Y-%m-%d_%H:%M", "sk BETWEEN 'SLOT#2024-01-10_00:00' AND 'SLOT#2024-01-12_23:59'"
    ),
    "scan_day": _calendar("D", "%Y-%m-%d", "starts_with(sk, 'D#')"),
    "scan_month": _calendar("M", "%Y-%m", "starts_with(sk, 'M#')"),
    "key_scan": _items("SELECT pk, sk FROM items"),
    "latest_store": _latest("STORE", "PT1M", f"{_PK_STATE}#{STORE}", False),
    "latest_state": _latest("STATE", "PT10M", _PK_STATE, True),
    "latest_region": _latest("REGION", "PT1H", REGION, True),
    "page_after": _items(
        f"SELECT {_ITEM} FROM items WHERE pk = '{_PK_STATE}' AND sk < '{PAGE_START}' ORDER BY sk DESC LIMIT 100",
        "STATE", "PT10M",
    ),
    "kpi_rows": _items(
        f"SELECT pk, ingest_time, {_K4} FROM ("
        + _DEDUP.format(source=f"(SELECT * FROM items WHERE pk = '{_PK_STATE}' AND {_ON_DAY})")
        + ")",
        "STATE", "PT10M",
    ),
    "newer_than": _items(
        "SELECT pk, period, ingest_time, kpi1, kpi2, kpi3, kpi4, kpi5, n_rec, event_time FROM ("
        + _DEDUP.format(source="items")
        + f") WHERE pk = '{REGION}' AND ingest_time >= TIMESTAMP '{CUTOFF}'",
        "REGION", "PT1M",
    ),
    "newer_than_stats": _items(
        f"""SELECT pk, count(*) AS records_parsed,
  count(*) FILTER (WHERE ingest_time >= TIMESTAMP '{CUTOFF}') AS records_returned,
  count(DISTINCT ingest_time) FILTER (WHERE ingest_time >= TIMESTAMP '{CUTOFF}') AS records_kept
FROM items GROUP BY pk""",
        "REGION", "PT1M",
    ),
    "dedup_ingest": _items(
        "SELECT pk, period, ingest_time, kpi1, kpi2, kpi3, kpi4, kpi5, n_rec, event_time FROM ("
        + _DEDUP.format(source="items") + ")"
    ),
    "dashboard_totals": _items(_TOTALS),
    "chart_series": _items(
        f"""SELECT pk, sk, ingest_time, '{REGION} - ' || upper(kpi) AS series, value FROM (
  UNPIVOT (SELECT pk, sk, ingest_time, {_K4} FROM items WHERE pk = '{_PK_STATE}' ORDER BY sk DESC LIMIT 200)
  ON {_K4} INTO NAME kpi VALUE value)""",
        "STATE", "PT10M",
    ),
    "kpi_day_month": _items(
        f"""SELECT pk, {_SUM4} FROM items WHERE {_SERVED}
  AND ((period = 'PT10M' AND {_ON_DAY}) OR (period = 'PT1H' AND NOT ({_ON_DAY}))) GROUP BY pk"""
    ),
    "kpi_day_month_compat": _items(
        f"""SELECT pk, {_SUM4} FROM ({_DEDUP.format(source=f'''(SELECT * FROM items WHERE {_SERVED}
  AND ((period = 'PT10M' AND {_ON_DAY}) OR period = 'PT1H'))''')}) GROUP BY pk"""
    ),
    "daily_kpis": _items(_DAILY, "REGION", "PT1M"),
    "daily_kpis_map": _items(
        f"SELECT pk, day, kpi, value FROM (UNPIVOT ({_DAILY}) ON kpi1, kpi2, kpi3, kpi4, kpi5"
        " INTO NAME kpi VALUE value)",
        "REGION", "PT1M",
    ),
    "region_totals": _items(
        """SELECT region, sum(kpi4)::BIGINT AS kpi4_sum, sum(kpi1)::BIGINT AS kpi1_sum,
  sum(kpi2)::BIGINT AS kpi2_sum, sum(kpi5)::BIGINT AS kpi5_sum, count(*) AS recs FROM items GROUP BY region""",
        "REGION", "PT1M",
    ),
    "local_time": _items(f"SELECT {_VALUE} FROM items", "REGION", "PT1H"),
    "date_keys": _events(
        """SELECT event_id, strftime(event_time, '%Y-%m') AS month, strftime(event_time, '%Y-%m-%d') AS day,
  strftime(event_time, '%Y-%m-%d_%H:%M') AS minute FROM kpi_events"""
    ),
    "region_states": _events(
        """SELECT d.region, d.state, count(e.event_id) AS n_events
FROM region_dim d LEFT JOIN kpi_events e ON e.region = d.region AND e.state = d.state GROUP BY 1, 2"""
    ),
    "filter_sets": """SELECT * FROM orders WHERE o_orderstatus IN ('F', 'O')
  AND o_orderpriority IN ('1-URGENT', '2-HIGH')
  AND o_orderdate > TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01'""",
    "json_number": """SELECT c_custkey, CASE WHEN a % 1 > 0 THEN NULL ELSE CAST(trunc(a) AS bigint) END AS as_int,
  CASE WHEN a % 1 > 0 THEN CAST(a AS double) END AS as_float, CAST(a AS double) AS always_float
FROM (SELECT c_custkey, CAST(c_acctbal AS DECIMAL(18,2)) AS a FROM customer)""",
    "wide_month": _events(
        "SELECT event_id, CAST(kpi_1 AS varchar) AS pk, 'PT10M#' || strftime(event_time, '%Y-%m') AS sk, " + _WIDE
    ),
    "wide_minute": _events(
        "SELECT event_id, CAST(kpi_1 AS varchar) AS pk, 'm#' || strftime(event_time, '%Y-%m-%d_%H:%M') AS sk, "
        + _WIDE
    ),
}
DASHBOARD |= {
    "label_periods": """SELECT event_id, CASE event_id % 4 WHEN 0 THEN 'PT1H' WHEN 1 THEN 'PT10M' ELSE 'PT1M' END AS period
FROM events""",
    "plain_insert": DASHBOARD["wide_minute"],
    "placed_events": _events(
        f"SELECT event_id, region, state, store_id, kpi_1 FROM kpi_events WHERE region = '{REGION}' AND state = '{STATE}'"
    ),
}

_COMMANDS = """commands AS (
  SELECT o_orderkey AS cmd_id, o_orderdate AS ts,
    CASE o_orderkey % 3 WHEN 0 THEN 'MoneyDeposit' WHEN 1 THEN 'MoneyWithdraw' ELSE 'MoneyTransfer' END AS kind,
    CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_orderkey % 101 = 0 THEN -1 ELSE o_custkey END AS src,
    CASE WHEN o_orderkey % 3 = 1 THEN NULL WHEN o_orderkey % 103 = 0 THEN -1
      WHEN o_orderkey % 3 = 0 THEN o_custkey WHEN o_orderkey % 97 = 2 THEN o_custkey
      ELSE (o_custkey * 7 + 1) % (SELECT count(*) FROM customer) END AS dst,
    CASE WHEN o_orderkey % 50 = 0 THEN CAST(0 AS DECIMAL(18,2))
      WHEN o_orderkey % 50 = 1 THEN CAST(0.99 AS DECIMAL(18,2))
      ELSE CAST(o_totalprice AS DECIMAL(18,2)) END AS amount
  FROM orders),
accounts AS (SELECT c_custkey AS acc_id, CAST(c_acctbal AS DECIMAL(18,2)) AS opening FROM customer),
checked AS (SELECT c.*, s.opening AS src_open, d.opening AS dst_open,
    CASE WHEN trunc(amount) <= 0 THEN 'Invalid amount'
      WHEN src = dst THEN 'Same source and destination accounts not allowed'
      WHEN (src IS NOT NULL AND s.acc_id IS NULL) OR (dst IS NOT NULL AND d.acc_id IS NULL)
        THEN 'No account data found' END AS fault
  FROM commands c LEFT JOIN accounts s ON s.acc_id = c.src LEFT JOIN accounts d ON d.acc_id = c.dst)"""

# Replay in SQL: in each step every account may apply its next command, once the
# other account of that command is as far.
_REPLAY = f"""WITH RECURSIVE {_COMMANDS},
chosen AS (SELECT * FROM checked WHERE {{chosen}}),
legs AS (SELECT cmd_id, acc, row_number() OVER (PARTITION BY acc ORDER BY ts, cmd_id) AS n FROM (
    SELECT cmd_id, ts, src AS acc FROM chosen WHERE fault IS NULL AND src IS NOT NULL
    UNION ALL SELECT cmd_id, ts, dst FROM chosen WHERE fault IS NULL AND dst IS NOT NULL)),
todo AS MATERIALIZED (SELECT c.cmd_id, c.src, c.dst, c.amount, s.n AS n_src, d.n AS n_dst
  FROM chosen c LEFT JOIN legs s ON s.cmd_id = c.cmd_id AND s.acc = c.src
    LEFT JOIN legs d ON d.cmd_id = c.cmd_id AND d.acc = c.dst WHERE fault IS NULL),
steps(what, id, amount, n) USING KEY (what, id) AS (
  SELECT 'balance' AS what, acc_id AS id, CAST(opening AS DECIMAL(18,2)) AS amount, CAST(0 AS BIGINT) AS n
  FROM accounts
  UNION
  (WITH ready AS (SELECT t.*, coalesce(s.amount >= t.amount, true) AS ok, s.amount AS src_has, d.amount AS dst_has
    FROM todo t
      LEFT JOIN recurring.steps s ON s.what = 'balance' AND s.id = t.src AND s.n + 1 = t.n_src
      LEFT JOIN recurring.steps d ON d.what = 'balance' AND d.id = t.dst AND d.n + 1 = t.n_dst
    WHERE (t.src IS NULL OR s.id IS NOT NULL) AND (t.dst IS NULL OR d.id IS NOT NULL))
  SELECT 'balance', src, CAST(src_has - CASE WHEN ok THEN amount ELSE 0 END AS DECIMAL(18,2)), n_src
  FROM ready WHERE src IS NOT NULL
  UNION ALL
  SELECT 'balance', dst, CAST(dst_has + CASE WHEN ok THEN amount ELSE 0 END AS DECIMAL(18,2)), n_dst
  FROM ready WHERE dst IS NOT NULL
  UNION ALL
  SELECT 'verdict', cmd_id, CAST(CASE WHEN ok THEN 1 ELSE 0 END AS DECIMAL(18,2)), 0 FROM ready)),
verdicts AS (SELECT c.cmd_id, coalesce(v.amount = 1, false) AS accepted,
    coalesce(c.fault, CASE WHEN v.amount = 0 THEN 'Insufficient balance' END) AS reason
  FROM chosen c LEFT JOIN steps v ON v.what = 'verdict' AND v.id = c.cmd_id),
accepted AS (SELECT c.* FROM commands c JOIN verdicts v ON v.cmd_id = c.cmd_id AND v.accepted),
postings AS (SELECT acc_id, CASE WHEN kind = 'MoneyDeposit' OR (kind = 'MoneyTransfer' AND indicator = 'Debit')
      THEN 'TX_' ELSE 'TX#' END || strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '#' || cmd_id AS sort,
    cmd_id, ts, indicator, amount, kind, coalesce(CAST(src AS varchar), 'External') AS src_account,
    coalesce(CAST(dst AS varchar), 'External') AS dst_account
  FROM (SELECT *, src AS acc_id, 'Debit' AS indicator FROM accepted WHERE src IS NOT NULL
    UNION ALL SELECT *, dst, 'Credit' FROM accepted WHERE dst IS NOT NULL))
"""
_REPLAY_OWN = _REPLAY.format(chosen="kind <> 'MoneyTransfer'")
_REPLAY_ALL = _REPLAY.format(chosen="true")

# The same with creations as commands that set a balance. An account that is not there has no balance, so a command that
# names it is rejected when its turn comes.
_CREATED = f"""WITH RECURSIVE {_COMMANDS.split("accounts AS (")[0]}
accounts AS (SELECT c_custkey AS acc_id, CAST(c_acctbal AS DECIMAL(18,2)) AS opening FROM customer WHERE c_custkey % 5 <> 0),
chosen AS (
  SELECT cmd_id, ts, kind, src, dst, amount, CASE WHEN trunc(amount) <= 0 THEN 'Invalid amount'
    WHEN src = dst THEN 'Same source and destination accounts not allowed' END AS fault FROM commands WHERE cmd_id % 29 <> 0
  UNION ALL
  SELECT o_orderkey, o_orderdate, 'Create', NULL, o_custkey, CAST(o_totalprice AS DECIMAL(18,2)), NULL FROM orders WHERE o_orderkey % 29 = 0),
legs AS (SELECT cmd_id, acc, row_number() OVER (PARTITION BY acc ORDER BY ts, cmd_id) AS n FROM (
    SELECT cmd_id, ts, src AS acc FROM chosen WHERE fault IS NULL AND src IS NOT NULL
    UNION ALL SELECT cmd_id, ts, dst FROM chosen WHERE fault IS NULL AND dst IS NOT NULL)),
todo AS MATERIALIZED (SELECT c.cmd_id, c.kind, c.src, c.dst, c.amount, s.n AS n_src, d.n AS n_dst
  FROM chosen c LEFT JOIN legs s ON s.cmd_id = c.cmd_id AND s.acc = c.src
    LEFT JOIN legs d ON d.cmd_id = c.cmd_id AND d.acc = c.dst WHERE fault IS NULL),
steps(what, id, amount, n) USING KEY (what, id) AS (
  SELECT 'balance' AS what, id, CAST(opening AS DECIMAL(18,2)) AS amount, CAST(0 AS BIGINT) AS n
  FROM (SELECT acc_id AS id FROM accounts UNION SELECT acc FROM legs) LEFT JOIN accounts ON acc_id = id
  UNION
  (WITH ready AS (SELECT t.*, s.amount AS src_has, d.amount AS dst_has,
      kind = 'Create' OR ((src IS NULL OR s.amount IS NOT NULL) AND (dst IS NULL OR d.amount IS NOT NULL)) AS known,
      known AND coalesce(s.amount >= t.amount, true) AS ok
    FROM todo t
      LEFT JOIN recurring.steps s ON s.what = 'balance' AND s.id = t.src AND s.n + 1 = t.n_src
      LEFT JOIN recurring.steps d ON d.what = 'balance' AND d.id = t.dst AND d.n + 1 = t.n_dst
    WHERE (t.src IS NULL OR s.id IS NOT NULL) AND (t.dst IS NULL OR d.id IS NOT NULL))
  SELECT 'balance', src, CAST(src_has - CASE WHEN ok THEN amount ELSE 0 END AS DECIMAL(18,2)), n_src FROM ready WHERE src IS NOT NULL
  UNION ALL
  SELECT 'balance', dst, CAST(CASE WHEN kind = 'Create' THEN amount ELSE dst_has + CASE WHEN ok THEN amount ELSE 0 END END AS DECIMAL(18,2)), n_dst
  FROM ready WHERE dst IS NOT NULL
  UNION ALL SELECT 'Debit', cmd_id, CAST(src_has - amount AS DECIMAL(18,2)), 0 FROM ready WHERE src IS NOT NULL AND ok
  UNION ALL SELECT 'Credit', cmd_id, CAST(dst_has + amount AS DECIMAL(18,2)), 0 FROM ready WHERE dst IS NOT NULL AND kind <> 'Create' AND ok
  UNION ALL SELECT 'verdict', cmd_id, CAST(CASE WHEN ok THEN 1 WHEN known THEN 0 ELSE 2 END AS DECIMAL(18,2)), 0 FROM ready)),
verdicts AS (SELECT c.*, coalesce(v.amount = 1, false) AS accepted,
    coalesce(c.fault, CASE v.amount WHEN 0 THEN 'Insufficient balance' WHEN 2 THEN 'No account data found' END) AS reason
  FROM chosen c LEFT JOIN steps v ON v.what = 'verdict' AND v.id = c.cmd_id WHERE kind <> 'Create')
"""

_STATEMENT = """SELECT p.acc_id, ts, cmd_id, kind, indicator, p.amount, CAST(a.opening + sum(
    CASE WHEN indicator = 'Credit' THEN p.amount ELSE -p.amount END)
    OVER (PARTITION BY p.acc_id ORDER BY ts, cmd_id ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,2)) AS balance
FROM postings p JOIN accounts a ON a.acc_id = p.acc_id"""

LEDGER: dict[str, str] = {
    "creation_replay": _CREATED + "SELECT cmd_id, accepted, reason FROM verdicts",
    "creation_statement": _CREATED
    + """SELECT CASE s.what WHEN 'Debit' THEN src ELSE dst END AS acc_id, ts, cmd_id, kind, s.what AS indicator, v.amount, s.amount AS balance
FROM verdicts v JOIN steps s ON s.id = v.cmd_id AND s.what IN ('Debit', 'Credit')""",
    "creation_balances": _CREATED + "SELECT id AS acc_id, amount AS balance FROM steps WHERE what = 'balance' AND amount IS NOT NULL",
    "account_statement": _REPLAY_ALL + _STATEMENT + " WHERE p.acc_id = 7",
    "command_check": f"""WITH {_COMMANDS}
SELECT cmd_id, kind, fault IS NULL AS valid, fault AS reason FROM checked""",
    "account_replay": _REPLAY_OWN + "SELECT * FROM verdicts",
    "transfer_replay": _REPLAY_ALL + "SELECT * FROM verdicts",
    "postings": _REPLAY_ALL + "SELECT * FROM postings",
    "statement": _REPLAY_ALL + _STATEMENT,
    "statement_compat": _REPLAY_ALL + "SELECT * FROM postings WHERE starts_with(sort, 'TX_')",
    "balances": _REPLAY_ALL
    + """, requested AS (SELECT DISTINCT acc_id FROM (
    SELECT src AS acc_id FROM commands UNION ALL SELECT dst FROM commands) WHERE acc_id IS NOT NULL)
SELECT r.acc_id, coalesce(c.amount, 0)::DECIMAL(18,2) AS balance, 'Credit' AS indicator,
  c.id IS NOT NULL AS result, CASE WHEN c.id IS NULL THEN 'No account data found!' END AS error_msg
FROM requested r LEFT JOIN steps c ON c.what = 'balance' AND c.id = r.acc_id""",
    "open_accounts": """SELECT acc_id, balance, 'Credit' AS indicator, n_creations FROM (
  SELECT o_custkey AS acc_id, CAST(o_totalprice AS DECIMAL(18,2)) AS balance,
    count(*) OVER (PARTITION BY o_custkey) AS n_creations,
    row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
WHERE rn = 1""",
}


def _items_of(events: str, sql: str) -> str:
    """SQL over the items of some of the events only."""
    return f"""WITH {EVENTS.replace("kpi_events AS (", "every_event AS (")},
kpi_events AS (SELECT * FROM every_event WHERE {events}),
rollups AS ({_ALL}),
items AS ({_keyed("rollups")})
{sql}"""


def _days_and_months() -> str:
    rows = []
    for grain in ("REGION", "STATE"):
        pk = "region" if grain == "REGION" else "region || '#' || state"
        for space, form in (("D", "%Y-%m-%d"), ("M", "%Y-%m")):
            kpis = ", ".join(f"sum(kpi_{i})::BIGINT AS kpi{i}" for i in range(1, 6))
            rows.append(f"SELECT '{grain}' AS grain, {pk} AS pk, '{space}#' || strftime(event_time, '{form}') AS sk, {kpis}, count(*) AS n_rec FROM kpi_events GROUP BY 2, 3")
    return _events("\nUNION ALL\n".join(rows))


_WHOLE_RAW = "event_id % 50 NOT IN (0, 1, 2)"
_UPTO = "((event_id % 2 = 0 AND ingest_time < TIMESTAMP '2024-01-15') OR (event_id % 2 = 1 AND ingest_time < TIMESTAMP '2024-01-20'))"


def _whole(period: str) -> str:
    """All rollups of one period."""
    rows = "\nUNION ALL\n".join(_rollup(g, period) for g in GRAINS)
    return f"WITH {EVENTS}\nSELECT * FROM ({rows})"


STREAMS: dict[str, str] = {
    **{f"stream_rollup_{p.lower()}": _whole(p) for p in PERIODS},
    "account_stream": _REPLAY_OWN
    + """SELECT v.cmd_id, coalesce(c.src, c.dst) AS acc_id, accepted, reason
FROM verdicts v JOIN commands c ON c.cmd_id = v.cmd_id""",
    "parsed_events": _events(
        """SELECT event_time, ingest_time, region, state, store_id, kpi_1, kpi_2, kpi_3, kpi_4, kpi_5,
  CAST(NULL AS varchar) AS bad_record FROM kpi_events"""
    ),
    "decoded_records": _WIRE + "SELECT * FROM classified",
    "store_stream": _items("SELECT * FROM items"),
    "quarantine": _WIRE + "SELECT event_id, reason FROM classified WHERE status = 'error'",
    "rollup_wire": _items("SELECT 'ok' AS status, pk, sk, n_rec FROM items"),
    "fan_out_rollups": _items_of(_WHOLE_RAW, "SELECT * FROM items"),
    "fan_out_counts": _events(
        f"""SELECT 'archive' AS sink, 'records' AS key, count(*) AS n FROM kpi_events
UNION ALL SELECT 'quarantine', ['unreadable', 'missing_region', 'missing_time'][event_id % 50 + 1], count(*) FROM kpi_events
  WHERE NOT ({_WHOLE_RAW}) GROUP BY 2
UNION ALL SELECT 'rollups', 'records', count(*) FROM kpi_events WHERE {_WHOLE_RAW}
UNION ALL SELECT 'total', 'all', count(*) FROM kpi_events
UNION ALL SELECT 'total', 'ok', count(*) FROM kpi_events WHERE {_WHOLE_RAW}
UNION ALL SELECT 'total', 'err', count(*) FROM kpi_events WHERE NOT ({_WHOLE_RAW})
UNION ALL SELECT 'region', region, count(*) FROM kpi_events WHERE {_WHOLE_RAW} GROUP BY 2"""
    ),
    "store_compacted": _items(
        "SELECT reader, pk, sk, kpi1, kpi2, kpi3, kpi4, kpi5, n_rec FROM items, (VALUES ('old'), ('new')) AS r(reader)"
    ),
    "calendar_increment": _days_and_months(),
    "purged": _items(
        """SELECT * FROM items WHERE NOT (region = 'NORTHEAST' AND state = 'BA'
  AND event_time >= TIMESTAMP '2024-01-10' AND event_time < TIMESTAMP '2024-01-13')"""
    ),
    "final_items": _items_of(
        _UPTO,
        f"""SELECT items.* FROM items, (SELECT least(max(ingest_time) FILTER (event_id % 2 = 0), max(ingest_time) FILTER (event_id % 2 = 1)) AS upto
  FROM every_event WHERE {_UPTO}) WHERE items.ingest_time
  + to_seconds(CASE period WHEN 'PT1M' THEN 60 WHEN 'PT10M' THEN 600 ELSE 3600 END) <= upto""",
    ),
    "intake_stats": _WIRE + _STATS,
    "late_accounts": _CREATED.replace("FROM commands WHERE cmd_id % 29 <> 0", "FROM commands WHERE cmd_id % 29 <> 0 AND kind <> 'MoneyTransfer'")
    + """, own AS (SELECT *, coalesce(src, dst) AS acc_id FROM verdicts),
moves AS (SELECT acc_id, ts, cmd_id, 1 AS turn, CASE WHEN accepted THEN CASE WHEN src IS NULL THEN amount ELSE -amount END ELSE 0 END AS change, accepted, reason FROM own
  UNION ALL SELECT dst, ts, cmd_id, 0, amount, NULL, NULL FROM chosen WHERE kind = 'Create'
  UNION ALL SELECT acc_id, NULL, NULL, 0, opening, NULL, NULL FROM accounts),
cut AS (SELECT *, sum(1 - turn) OVER (PARTITION BY acc_id ORDER BY ts NULLS FIRST, cmd_id, turn ROWS UNBOUNDED PRECEDING) AS segment FROM moves)
SELECT cmd_id, acc_id, accepted, reason, CASE WHEN segment > 0 THEN CAST(sum(change) OVER (PARTITION BY acc_id, segment ORDER BY ts NULLS FIRST, cmd_id, turn ROWS UNBOUNDED PRECEDING) AS DECIMAL(18,2)) END AS balance
FROM cut QUALIFY turn = 1""",
    "upsert_view": _items(
        "SELECT pk, sk, kpi1 + CASE WHEN n_rec % 2 = 0 THEN 1000 ELSE 0 END AS kpi1, n_rec FROM items", "REGION", "PT1H"
    ),
}
