"""The SQL each query is checked against, written for DuckDB on the same tables."""

from __future__ import annotations

from riskloom.functions.prompts import PROMPT
from riskloom.schema import FEATURES

from .fixtures import fixed_layers, fixed_weight
from .queries import GOOD_TIMES, LOAD_TS, RUN_TS, STRANGE_TIMES

# Inputs

TX_HOURLY = """tx_h AS (
  SELECT e.event_id AS tx_id, CAST(e.user_id AS VARCHAR) AS customer_id,
         e.value AS transaction_amount, c.c_acctbal * 0.05 AS account_balance,
         CASE WHEN e.event_type = 'error' THEN 'fail_tx'
              WHEN e.event_type = 'purchase' THEN 'purchase' ELSE 'click' END AS event_type,
         e.ts AS created_at
  FROM events e JOIN customer c ON e.user_id = c.c_custkey)"""

MKT_HOURLY = """mkt_h AS (
  SELECT CAST(user_id AS VARCHAR) AS customer_id,
         CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS clicks,
         CASE WHEN event_type IN ('click', 'view') THEN 1 ELSE 0 END AS impressions,
         CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END AS conversion,
         ts AS created_at
  FROM events)"""

TX_DAILY = """tx_d AS (
  SELECT o.o_orderkey AS tx_id, CAST(o.o_custkey AS VARCHAR) AS customer_id,
         o.o_totalprice AS transaction_amount, c.c_acctbal * 50 AS account_balance,
         CASE WHEN o.o_orderstatus = 'F' THEN 'fail_tx' ELSE 'purchase' END AS event_type,
         o.o_orderdate AS created_at
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey)"""

LINE_KEY = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice"

MKT_DAILY = f"""mkt_d AS (
  SELECT CAST(o.o_custkey AS VARCHAR) AS customer_id,
         CASE WHEN l.l_discount >= 0.1 THEN 1 ELSE 0 END AS clicks,
         CAST(l.l_quantity AS INTEGER) AS impressions,
         CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END AS conversion,
         l.l_shipdate AS created_at, {LINE_KEY}
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey)"""


def r(expression: str, digits: int = 4) -> str:
    """Rounded like the queries' doubles."""
    return f"round({expression} + 3.7e-{digits + 2}, {digits}) + 0.0"


def with_(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def select(source: str, plain: str = "", doubles: str = "", tail: str = "", digits: int = 4) -> str:
    """Columns as they are and doubles rounded, from ``source``."""
    columns = [c.strip() for c in plain.split(",") if c.strip()]
    columns += [f"{r(c.strip(), digits)} AS {c.strip()}" for c in doubles.split(",") if c.strip()]
    return f"SELECT {', '.join(columns)} FROM {source} {tail}"


# Features

FIN_DOUBLES = "total_tx_amount, avg_tx_amount, max_tx_amount, std_tx_amount, avg_account_balance"
MKT_PLAIN = "active_users, total_clicks, total_impressions"
MKT_DOUBLES = "conversion_rate, avg_clicks_per_user"


def fin(name: str, source: str, key: str, bucket: str, risky: bool = True) -> str:
    extra = (
        """,
         CAST(SUM(CASE WHEN transaction_amount > account_balance * 0.8 THEN 1 ELSE 0 END) AS BIGINT)
           AS risky_tx_count"""
        if risky
        else ""
    )
    return f"""{name} AS (
  SELECT {bucket} AS {key}, COUNT(*) AS tx_count,
         SUM(transaction_amount) AS total_tx_amount, AVG(transaction_amount) AS avg_tx_amount,
         MAX(transaction_amount) AS max_tx_amount, STDDEV_SAMP(transaction_amount) AS std_tx_amount,
         AVG(account_balance) AS avg_account_balance{extra}
  FROM {source} GROUP BY 1)"""


def mkt(name: str, source: str, key: str, bucket: str) -> str:
    return f"""{name} AS (
  SELECT {bucket} AS {key}, COUNT(DISTINCT customer_id) AS active_users,
         CAST(SUM(clicks) AS BIGINT) AS total_clicks,
         CAST(SUM(impressions) AS BIGINT) AS total_impressions,
         AVG(conversion) AS conversion_rate, AVG(clicks) AS avg_clicks_per_user
  FROM {source} GROUP BY 1)"""


HOUR, DAY = "date_trunc('hour', created_at)", "CAST(created_at AS DATE)"
FIN_H = fin("fin_h", "tx_h", "event_hour", HOUR)
FIN_D = fin("fin_d", "tx_d", "event_day", DAY)
MKT_H = mkt("mk_h", "mkt_h", "event_hour", HOUR)
MKT_D = mkt("mk_d", "mkt_d", "event_day", DAY)


def feat(name: str, f: str, m: str, key: str, integer: bool = False) -> str:
    shown = "NULLIF(m.total_impressions, 0)"
    ctr = (
        f"CAST(m.total_clicks // {shown} AS DOUBLE)"
        if integer
        else f"CAST(m.total_clicks AS DOUBLE) / {shown}"
    )
    return f"""{name} AS (
  SELECT f.*, m.active_users, m.total_clicks, m.total_impressions, m.conversion_rate,
         m.avg_clicks_per_user, f.total_tx_amount / NULLIF(f.tx_count, 0) AS avg_tx_per_event,
         {ctr} AS ctr
  FROM {f} f LEFT JOIN {m} m ON f.{key} = m.{key})"""


FEAT_H = [TX_HOURLY, MKT_HOURLY, FIN_H, MKT_H, feat("feat_h", "fin_h", "mk_h", "event_hour")]
FEAT_D = [TX_DAILY, MKT_DAILY, FIN_D, MKT_D, feat("feat_d", "fin_d", "mk_d", "event_day")]
FEAT_PLAIN = f"tx_count, risky_tx_count, {MKT_PLAIN}"
FEAT_DOUBLES = f"{FIN_DOUBLES}, {MKT_DOUBLES}, avg_tx_per_event, ctr"

LABEL_H = """lab_h AS (
  SELECT event_hour,
         CASE WHEN risky_tx_count >= 3 AND tx_count >= 10 AND ctr < 0.02 THEN 1 ELSE 0 END
           AS fraud_label,
         CASE WHEN risky_tx_count >= 3 THEN 'HIGH_TX_VS_BALANCE'
              WHEN ctr < 0.02 THEN 'LOW_MARKETING_QUALITY' ELSE 'NORMAL' END AS fraud_reason
  FROM feat_h)"""

RAW_D = """raw_d AS (
  SELECT *,
         CAST(risky_tx_count AS DOUBLE) / NULLIF(NULLIF(tx_count, 1), 0) * 0.4
         + avg_tx_amount / NULLIF(NULLIF(avg_account_balance, 1), 0) * 0.3
         + std_tx_amount / NULLIF(NULLIF(avg_tx_amount, 1), 0) * 0.2
         + (1 - COALESCE(ctr, 0)) * 0.1 AS raw_score
  FROM feat_d)"""

LABEL_D = """lab_d AS (
  SELECT event_day, LEAST(1.0, raw_score) AS fraud_score,
         CASE WHEN raw_score >= 0.7 THEN 1 ELSE 0 END AS fraud_label,
         CASE WHEN risky_tx_count >= 3 THEN 'HIGH_TX_VS_BALANCE'
              WHEN ctr < 0.01 THEN 'LOW_CTR'
              WHEN std_tx_amount > avg_tx_amount * 2 THEN 'TX_VARIANCE_SPIKE'
              ELSE 'NORMAL' END AS fraud_reason
  FROM raw_d)"""

ALERT = """alert AS (
  SELECT event_day, fraud_score, fraud_label,
         CASE WHEN fraud_score >= 0.8 THEN 'HIGH RISK'
              WHEN fraud_score >= 0.5 THEN 'MEDIUM RISK' ELSE 'LOW RISK' END AS alert_level
  FROM lab_d)"""

ALERTS = [*FEAT_D, RAW_D, LABEL_D, ALERT]
TRAINING_D = [*FEAT_D, RAW_D, LABEL_D, "train_d AS (SELECT * FROM feat_d JOIN lab_d USING (event_day))"]

CUSTOMER_DAY = """cust_day AS (
  SELECT customer_id, CAST(created_at AS DATE) AS event_date,
         CAST(SUM(clicks) AS BIGINT) AS total_clicks,
         CAST(SUM(impressions) AS BIGINT) AS total_impressions,
         CAST(SUM(conversion) AS BIGINT) AS total_conversion,
         CASE WHEN SUM(impressions) > 0
              THEN CAST(SUM(clicks) AS DOUBLE) / SUM(impressions) ELSE 0.0 END AS ctr
  FROM mkt_d GROUP BY 1, 2)"""

FIN_DAY = fin("fin_day", "tx_d", "event_date", DAY, risky=False)
DAY_JOIN = """day_join AS (
  SELECT m.customer_id AS user_id, m.event_date, f.* EXCLUDE (event_date),
         m.total_clicks, m.total_impressions, m.total_conversion, m.ctr
  FROM cust_day m JOIN fin_day f ON m.event_date = f.event_date)"""
SCORED = """scored AS (
  SELECT *, CAST(EXTRACT(DOW FROM event_date) AS INTEGER) AS weekday,
         CAST(EXTRACT(MONTH FROM event_date) AS INTEGER) AS month,
         CAST(EXTRACT(YEAR FROM event_date) AS INTEGER) AS year,
         max_tx_amount / NULLIF(NULLIF(avg_tx_amount, 1), 0) + ctr AS fraud_score
  FROM day_join)"""
# The two neighbours of the 0.8 quantile, blended so that equal ones stay exact.
THRESHOLD = """thr AS (
  SELECT MIN(v) + MAX(w) * (MAX(v) - MIN(v)) AS fraud_threshold
  FROM (SELECT fraud_score AS v, row_number() OVER (ORDER BY fraud_score) - 1 AS i,
               0.8::DOUBLE * (COUNT(*) OVER () - 1) AS pos, 0.8::DOUBLE * (COUNT(*) OVER () - 1)
                 - floor(0.8::DOUBLE * (COUNT(*) OVER () - 1)) AS w
        FROM scored WHERE fraud_score IS NOT NULL) x
  WHERE i = floor(pos) OR i = ceil(pos))"""
LABELLED = """lab_cd AS (
  SELECT s.*, CASE WHEN s.fraud_score >= (SELECT fraud_threshold FROM thr) THEN 1 ELSE 0 END
    AS fraud_label
  FROM scored s)"""
SCORED_CD = [TX_DAILY, MKT_DAILY, CUSTOMER_DAY, FIN_DAY, DAY_JOIN, SCORED]
LABELLED_CD = [*SCORED_CD, THRESHOLD, LABELLED]
CD_PLAIN = """user_id, event_date, tx_count, total_clicks, total_impressions, total_conversion,
  weekday, month, year"""
CD_DOUBLES = f"{FIN_DOUBLES}, ctr, fraud_score"

JUDGED = """judged AS (
  SELECT *, CASE WHEN fraud_probability >= 0.5 THEN 1 ELSE 0 END AS fraud_prediction
  FROM (SELECT *, LEAST(1.0, GREATEST(0.0, ctr * 10)) AS fraud_probability FROM lab_cd) x)"""
JUDGED_CD = [*LABELLED_CD, JUDGED]

MINMAX = """scaled AS (
  SELECT *, (fraud_score - MIN(fraud_score) OVER ())
    / CASE WHEN MAX(fraud_score) OVER () = MIN(fraud_score) OVER () THEN 1.0
           ELSE MAX(fraud_score) OVER () - MIN(fraud_score) OVER () END
    * (0.99::DOUBLE - 0.25::DOUBLE) + 0.25::DOUBLE AS p
  FROM scored)"""

TX_PLAIN = "tx_id, customer_id, event_type, created_at"
TX_DOUBLES = "transaction_amount, account_balance"
STREAM_COLUMNS = f"""customer_id, {r('transaction_amount')} AS transaction_amount,
  CAST(NULL AS DOUBLE) AS account_balance, event_type, created_at"""
BROKEN = "'{bad ' || CAST(tx_id AS VARCHAR)"


def key_hash(key: str) -> str:
    return f"CAST(('0x' || substr(md5({key}), 1, 8)) AS BIGINT)"


def quantile(source: str, value: str, q: float) -> str:
    """Exact interpolated quantile by rank."""
    pos = f"{q}::DOUBLE * (COUNT(*) OVER () - 1)"
    return f"""(SELECT MIN(v) + MAX(pos - floor(pos)) * (MAX(v) - MIN(v))
      FROM (SELECT {value} AS v, row_number() OVER (ORDER BY {value}) - 1 AS i, {pos} AS pos
            FROM {source} WHERE {value} IS NOT NULL) q
      WHERE i = floor(pos) OR i = ceil(pos))"""


def describe_column(name: str) -> str:
    quartiles = ", ".join(
        f"{r(quantile('lineitem', name, q))} AS q{round(q * 100)}" for q in (0.25, 0.5, 0.75)
    )
    return f"""SELECT '{name}' AS "column", COUNT({name}) AS count, {r(f'AVG({name})')} AS mean,
      {r(f'STDDEV_SAMP({name})')} AS std, {r(f'MIN({name})')} AS min, {r(f'MAX({name})')} AS max,
      {quartiles} FROM lineitem"""


FEATURE_DAILY_TYPES = {
    "event_day": "date",
    "tx_count": "bigint",
    "total_tx_amount": "double",
    "avg_tx_amount": "double",
    "max_tx_amount": "double",
    "std_tx_amount": "double",
    "avg_account_balance": "double",
    "risky_tx_count": "bigint",
    "active_users": "bigint",
    "total_clicks": "bigint",
    "total_impressions": "bigint",
    "conversion_rate": "double",
    "avg_clicks_per_user": "double",
    "avg_tx_per_event": "double",
    "ctr": "double",
}


def prompt_sql() -> str:
    """The prompt text with its places filled, from a table of rounded values."""
    text = PROMPT.replace("'", "''")
    for name in ("fraud_probability", "ctr"):
        value = f"COALESCE(printf('%.4f', {name}), 'nan')"
        text = text.replace("{" + name + ":.4f}", f"' || {value} || '")
    for name in (
        "tx_count total_tx_amount avg_tx_amount max_tx_amount std_tx_amount avg_account_balance "
        "total_clicks total_impressions total_conversion"
    ).split():
        value = f"COALESCE(CAST({name} AS VARCHAR), 'nan')"
        text = text.replace("{" + name + "}", f"' || {value} || '")
    return f"'{text}'"


FULL_TX_H = with_(TX_HOURLY) + select("tx_h", TX_PLAIN, TX_DOUBLES)
FULL_TX_D = with_(TX_DAILY) + select("tx_d", TX_PLAIN, TX_DOUBLES)
FIN_DAILY = with_(TX_DAILY, FIN_D) + select("fin_d", "event_day, tx_count, risky_tx_count", FIN_DOUBLES)
FIN_HOURLY = with_(TX_HOURLY, FIN_H) + select(
    "fin_h", "event_hour, tx_count, risky_tx_count", FIN_DOUBLES
)
MKT_HOURLY_SQL = with_(MKT_HOURLY, MKT_H) + select("mk_h", f"event_hour, {MKT_PLAIN}", MKT_DOUBLES)
MKT_DAILY_SQL = with_(MKT_DAILY, MKT_D) + select("mk_d", f"event_day, {MKT_PLAIN}", MKT_DOUBLES)
TRAINING_CD = with_(*LABELLED_CD) + select("lab_cd", f"{CD_PLAIN}, fraud_label", CD_DOUBLES)
CUSTOMER_FEATURES = with_(TX_DAILY) + f"""SELECT customer_id,
  {r('AVG(transaction_amount)')} AS avg_tx_amount,
  CAST(SUM(CASE WHEN event_type = 'fail_tx' THEN 1 ELSE 0 END) AS BIGINT) AS failed_tx_count,
  COUNT(*) AS tx_count FROM tx_d GROUP BY 1"""

ID_TEXT = "'AA' || lpad(CAST({n} AS VARCHAR), CAST(GREATEST(3, length(CAST({n} AS VARCHAR))) AS INTEGER), '0')"
CUSTOMERS = f"""cust AS (SELECT {ID_TEXT.format(n='(c_custkey + 1)')} AS customer_id,
  {r('c_acctbal')} AS account_balance FROM customer)"""

HISTOGRAM = """span AS (SELECT MIN(l_extendedprice) AS lo, MAX(l_extendedprice) AS hi FROM lineitem),
hist AS (
  SELECT LEAST(CAST(floor(30 * (l_extendedprice - lo) / (hi - lo)) AS BIGINT) + 1, 30) AS bin,
         COUNT(*) AS n
  FROM lineitem, span GROUP BY 1),
edges AS (SELECT unnest(range(1, 31)) AS bin)"""

KDE = """stats AS (SELECT MIN(value) AS lo, MAX(value) AS hi, COUNT(value) AS n,
  STDDEV_SAMP(value) * pow(COUNT(value), -0.2) AS h FROM events),
vals AS (SELECT value AS v, COUNT(*) AS k FROM events WHERE value IS NOT NULL GROUP BY 1),
grid AS (SELECT CAST(unnest(range(0, 200)) AS INTEGER) AS point)"""

BOX = f"""box AS (SELECT {quantile('events', 'value', 0.25)} AS q1,
  {quantile('events', 'value', 0.5)} AS median, {quantile('events', 'value', 0.75)} AS q3)"""

AUC = """ranked AS (
  SELECT fraud_label AS y, rank() OVER (ORDER BY fraud_probability)
    + (COUNT(*) OVER (PARTITION BY fraud_probability) - 1) / 2.0 AS mid
  FROM judged WHERE fraud_label IS NOT NULL AND fraud_probability IS NOT NULL)"""

BINS = """binned AS (
  SELECT fraud_label, CAST(GREATEST(1, LEAST(199, ceil(fraud_probability * 199))) AS INTEGER)
    AS fraud_probability
  FROM judged)"""
POSITIVES, NEGATIVES = "COUNT(*) FILTER (y = 1)", "COUNT(*) FILTER (y = 0)"
RANK_SUM = f"SUM(mid) FILTER (y = 1) - {POSITIVES} * ({POSITIVES} + 1) / 2.0"
AUC_ROW = f"""SELECT {r(f'({RANK_SUM}) / ({POSITIVES} * {NEGATIVES})')} AS auc,
  {POSITIVES} AS positives, {NEGATIVES} AS negatives FROM ranked"""

REPORT = """counts AS (
  SELECT CAST(COUNT(*) AS BIGINT) AS n,
    COUNT(*) FILTER (fraud_label = 0) AS a0, COUNT(*) FILTER (fraud_label = 1) AS a1,
    COUNT(*) FILTER (fraud_prediction = 0) AS p0, COUNT(*) FILTER (fraud_prediction = 1) AS p1,
    COUNT(*) FILTER (fraud_label = 0 AND fraud_prediction = 0) AS h0,
    COUNT(*) FILTER (fraud_label = 1 AND fraud_prediction = 1) AS h1
  FROM judged),
m AS (
  SELECT *, COALESCE(h0 / NULLIF(p0, 0), 0.0) AS pr0, COALESCE(h1 / NULLIF(p1, 0), 0.0) AS pr1,
    COALESCE(h0 / NULLIF(a0, 0), 0.0) AS re0, COALESCE(h1 / NULLIF(a1, 0), 0.0) AS re1,
    COALESCE(2 * h0 / NULLIF(p0 + a0, 0), 0.0) AS f0,
    COALESCE(2 * h1 / NULLIF(p1 + a1, 0), 0.0) AS f1c
  FROM counts)"""


def report_row(name: str, precision: str, recall: str, f1: str, support: str) -> str:
    return f"""SELECT '{name}' AS class, {r(precision)} AS precision, {r(recall)} AS recall,
  {r(f1)} AS f1, {support} AS support FROM m"""


def weighted(metric: str) -> str:
    return f"({metric.format(0)} * a0 + {metric.format(1)} * a1) / n"


ROW_COUNTS = {
    "feature.finance_fraud_features": "SELECT COUNT(DISTINCT date_trunc('hour', created_at)) FROM tx_d",
    "feature.marketing_fraud_features": "SELECT COUNT(DISTINCT date_trunc('hour', created_at)) FROM mkt_d",
    "feature.feature_fraud": "SELECT COUNT(DISTINCT date_trunc('hour', created_at)) FROM tx_d",
    "label.fraud_label": "SELECT COUNT(DISTINCT date_trunc('hour', created_at)) FROM tx_d",
    "feature.training_fradu_dataset": "SELECT COUNT(DISTINCT date_trunc('hour', created_at)) FROM tx_d",
    "feature.finance_fraud_daily": "SELECT COUNT(*) FROM fin_day",
    "feature.marketing_fraud_daily": "SELECT COUNT(DISTINCT CAST(created_at AS DATE)) FROM mkt_d",
    "feature.feature_fraud_daily": "SELECT COUNT(*) FROM fin_day",
    "label.fraud_label_daily": "SELECT COUNT(*) FROM fin_day",
    "feature.training_fraud_daily": "SELECT COUNT(*) FROM fin_day",
    "alert.daily_fraud_alert": "SELECT COUNT(*) FROM fin_day",
    "feature.finance": "SELECT COUNT(*) FROM fin_day",
    "feature.marketing": "SELECT COUNT(*) FROM cust_day",
    "feature.marketing_scores": "SELECT COUNT(*) FROM cust_day",
    "feature.training_fraud_dataset": "SELECT COUNT(*) FROM day_join",
}



def scaled(name: str, source: str, columns: list[str]) -> list[str]:
    """CTEs: every row of ``source`` with x1, x2, … standardised over all its rows."""
    moments = ", ".join(
        f"AVG(CAST({c} AS DOUBLE)) AS m{n}, stddev_pop(CAST({c} AS DOUBLE)) AS s{n}" for n, c in enumerate(columns, 1)
    )
    values = ", ".join(
        f"COALESCE((CAST({c} AS DOUBLE) - m{n}) / CASE WHEN s{n} > abs(m{n}) * 1e-13 THEN s{n} ELSE 1 END, 0) AS x{n}"
        for n, c in enumerate(columns, 1)
    )
    return [
        f"{name}_m AS (SELECT {moments} FROM {source})",
        f"{name} AS (SELECT {source}.*, {values} FROM {source} CROSS JOIN {name}_m)",
    ]


def forward(name: str, source: str, inputs: int) -> list[str]:
    """CTEs: every row of ``source`` with its probability ``p`` from the fixed network."""
    parts, before, prefix = [], source, "x"
    layers = fixed_layers(inputs)
    for depth, (a, b, first) in enumerate(layers, 1):
        sums = [
            " + ".join(
                [f"({fixed_weight(first + o + i * b)}) * {prefix}{i + 1}" for i in range(a)]
                + [f"({fixed_weight(first + a * b + o)})"]
            )
            for o in range(b)
        ]
        last = depth == len(layers)
        shown = [f"{s} AS z{o + 1}" if last else f"1 / (1 + exp(-({s}))) AS h{depth}_{o + 1}" for o, s in enumerate(sums)]
        parts.append(f"{name}_{depth} AS (SELECT *, {', '.join(shown)} FROM {before})")
        before, prefix = f"{name}_{depth}", f"h{depth}_"
    return [*parts, f"{name} AS (SELECT *, 1 / (1 + exp(z1 - z2)) AS p FROM {before})"]


DAYS_WITH_DAY = 'days AS (SELECT *, EXTRACT(DAY FROM event_date) AS "Day" FROM lab_cd)'
QUOTED_FEATURES = [f'"{c}"' for c in FEATURES]
NETWORK = [*LABELLED_CD, DAYS_WITH_DAY, *scaled("sc", "days", QUOTED_FEATURES), *forward("net", "sc", len(FEATURES))]
TX_FEATURES = "txf AS (SELECT *, CASE WHEN event_type = 'fail_tx' THEN 1 ELSE 0 END AS failed_tx FROM tx_d)"
TX_NETWORK = [
    TX_DAILY,
    TX_FEATURES,
    *scaled("sc", "txf", ["transaction_amount", "account_balance", "failed_tx"]),
    *forward("net", "sc", 3),
]


def drawn(key: str) -> str:
    """Whether a row goes to the test part."""
    return f"{key_hash(key)} / 4294967296.0 < 0.2"


SPLIT_DAYS = f"""keyed AS (SELECT *, {key_hash("user_id || '|' || event_date || '|42'")} AS h FROM lab_cd),
cuts AS (SELECT fraud_label AS label, quantile_disc(h, 0.2) AS cut FROM keyed GROUP BY 1),
parts AS (SELECT keyed.*, h <= cut AS test FROM keyed JOIN cuts ON fraud_label IS NOT DISTINCT FROM label)"""
TEST_ROWS = "(SELECT COUNT(*) FROM parts WHERE test)"

ORACLE: dict[str, str] = {
    # Sources and sinks
    "src_csv_header": FULL_TX_D,
    "src_csv_semicolon": f"SELECT {LINE_KEY}, l_quantity, l_returnflag FROM lineitem",
    "load_finance": with_(TX_DAILY)
    + f"""SELECT CAST(NULL AS VARCHAR) AS customer_id, {r('transaction_amount')} AS transaction_amount,
  {r('account_balance')} AS account_balance, CAST(NULL AS VARCHAR) AS event_type,
  TIMESTAMP '{LOAD_TS}' AS created_at FROM tx_d""",
    "load_finance_own_times": with_(TX_DAILY)
    + f"""SELECT CAST(NULL AS VARCHAR) AS customer_id, {r('transaction_amount')} AS transaction_amount,
  {r('account_balance')} AS account_balance, CAST(NULL AS VARCHAR) AS event_type,
  CASE WHEN event_type = 'purchase' THEN created_at ELSE TIMESTAMP '{LOAD_TS}' END AS created_at FROM tx_d""",
    "load_marketing": with_(MKT_DAILY)
    + f"""SELECT {ID_TEXT.format(n='n')} AS customer_id, clicks, impressions, conversion,
  TIMESTAMP '{LOAD_TS}' AS created_at
  FROM (SELECT *, row_number() OVER (ORDER BY {LINE_KEY}) AS n FROM mkt_d) x""",
    "src_parquet": "SELECT * FROM orders",
    "sink_parquet_overwrite": FULL_TX_H,
    "sink_append_chunked": FULL_TX_D,
    "src_table": FIN_DAILY,
    "ctas_replace": FIN_DAILY,
    "ctas_if_absent": FIN_HOURLY,
    "ctas_strict": with_(*ALERTS)
    + select("alert", "event_day, fraud_label, alert_level, true AS refused", "fraud_score"),
    "namespaces": with_(*FEAT_D, *FEAT_H)
    + """SELECT 'raw.finance' AS table_name, COUNT(*) AS row_count FROM tx_h
UNION ALL SELECT 'feature.finance_fraud_features', COUNT(*) FROM fin_h
UNION ALL SELECT 'label.fraud_label', COUNT(*) FROM feat_h
UNION ALL SELECT 'alert.daily_fraud_alert', COUNT(*) FROM feat_d""",
    "query_registry": MKT_HOURLY_SQL,
    # Projections
    "silver_clean": f"""SELECT CAST(o_custkey AS VARCHAR) AS customer_id, o_orderkey AS tx_id,
  {r('o_totalprice')} AS transaction_amount,
  CASE WHEN o_orderstatus = 'F' THEN 'fail_tx' ELSE 'purchase' END AS event_type,
  CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS failed_tx
  FROM orders WHERE o_orderpriority <> '1-URGENT' AND o_orderstatus IN ('F', 'O')""",
    "rename_select": f"SELECT {r('o_totalprice')} AS transaction_amount, o_orderkey AS tx_id FROM orders",
    "drop_columns": with_(*LABELLED_CD)
    + select(
        "lab_cd",
        "tx_count, total_clicks, total_impressions, total_conversion, weekday, month, year",
        CD_DOUBLES,
    ),
    "ctr_proxy_target": with_(MKT_DAILY, CUSTOMER_DAY)
    + f"""SELECT customer_id, event_date, total_clicks, total_impressions, total_conversion,
  {r('ctr')} AS ctr, CASE WHEN ctr > 0.1 THEN 1 ELSE 0 END AS target FROM cust_day""",
    "decision_threshold": with_(*SCORED_CD, MINMAX)
    + f"""SELECT user_id, event_date, {r('p')} AS fraud_probability,
  CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS fraud_prediction FROM scaled""",
    "feature_matrix": with_(*SCORED_CD)
    + "SELECT user_id, event_date, "
    + ", ".join(
        f"{r(f'COALESCE(CAST({c} AS DOUBLE), 0)')} AS {c}"
        for c in (
            "tx_count total_tx_amount avg_tx_amount max_tx_amount std_tx_amount "
            "avg_account_balance total_clicks total_impressions total_conversion ctr weekday "
            "month year fraud_score"
        ).split()
    )
    + ', CAST(EXTRACT(DAY FROM event_date) AS DOUBLE) AS "Day" FROM scored',
    "day_of_month": with_(TX_DAILY)
    + 'SELECT tx_id, CAST(EXTRACT(DAY FROM created_at) AS INTEGER) AS "Day" FROM tx_d',
    # Aggregations and joins
    "finance_hourly": FIN_HOURLY,
    "finance_daily": FIN_DAILY,
    "marketing_hourly": MKT_HOURLY_SQL,
    "marketing_daily": MKT_DAILY_SQL,
    "finance_hourly_rollup": FIN_HOURLY,
    "finance_daily_rollup": with_(TX_HOURLY, fin("fin_hd", "tx_h", "event_day", DAY))
    + select("fin_hd", "event_day, tx_count, risky_tx_count", FIN_DOUBLES),
    "marketing_daily_rollup": MKT_DAILY_SQL,
    "marketing_customer_day": with_(MKT_DAILY, CUSTOMER_DAY)
    + select(
        "cust_day",
        "customer_id, event_date, total_clicks, total_impressions, total_conversion",
        "ctr",
    ),
    "finance_day_basic": with_(TX_DAILY, FIN_DAY)
    + select("fin_day", "event_date, tx_count", FIN_DOUBLES),
    "customer_features": CUSTOMER_FEATURES,
    "feature_hourly": with_(*FEAT_H) + select("feat_h", f"event_hour, {FEAT_PLAIN}", FEAT_DOUBLES),
    "feature_daily": with_(*FEAT_D) + select("feat_d", f"event_day, {FEAT_PLAIN}", FEAT_DOUBLES),
    "feature_daily_integer_ctr": with_(
        TX_DAILY, MKT_DAILY, FIN_D, MKT_D, feat("feat_i", "fin_d", "mk_d", "event_day", integer=True)
    )
    + select("feat_i", f"event_day, {FEAT_PLAIN}", FEAT_DOUBLES),
    "training_hourly": with_(*FEAT_H, LABEL_H)
    + select(
        "(SELECT * FROM feat_h JOIN lab_h USING (event_hour)) x",
        f"event_hour, {FEAT_PLAIN}, fraud_label, fraud_reason",
        FEAT_DOUBLES,
    ),
    "training_daily": with_(*TRAINING_D)
    + select(
        "train_d",
        f"event_day, {FEAT_PLAIN}, fraud_label, fraud_reason",
        f"{FEAT_DOUBLES}, fraud_score",
    ),
    "customer_day_join": with_(TX_DAILY, MKT_DAILY, CUSTOMER_DAY, FIN_DAY, DAY_JOIN)
    + select(
        "day_join",
        "user_id, event_date, tx_count, total_clicks, total_impressions, total_conversion",
        f"{FIN_DOUBLES}, ctr",
    ),
    "threshold_cross": with_(*LABELLED_CD)
    + select("lab_cd", "user_id, event_date, fraud_label", "fraud_score"),
    "fraud_threshold": with_(*SCORED_CD, THRESHOLD) + select("thr", "", "fraud_threshold"),
    "row_count": "SELECT COUNT(*) AS row_count FROM lineitem",
    "label_distribution": with_(*LABELLED_CD)
    + "SELECT fraud_label, COUNT(*) AS row_count FROM lab_cd GROUP BY 1",
    # Ids
    "assign_customer_ids": with_(MKT_DAILY)
    + f"""SELECT {ID_TEXT.format(n='n')} AS customer_id, {LINE_KEY.replace('l_extendedprice', '')}
  {r('l_extendedprice')} AS l_extendedprice
  FROM (SELECT *, row_number() OVER (ORDER BY {LINE_KEY}) AS n FROM mkt_d WHERE impressions <> 50) x
UNION ALL
SELECT 'C' || customer_id, {LINE_KEY.replace('l_extendedprice', '')} {r('l_extendedprice')}
  FROM mkt_d WHERE impressions = 50""",
    "customer_id_valid": """WITH shaped AS (
  SELECT CASE WHEN o_orderstatus = 'P' THEN NULL
              WHEN o_orderpriority = '1-URGENT' THEN 'CUSTOMER-' || CAST(o_custkey AS VARCHAR)
              ELSE CAST(o_custkey AS VARCHAR) END AS customer_id FROM orders),
per AS (SELECT customer_id, COUNT(*) AS rows FROM shaped GROUP BY 1)
SELECT customer_id, 'null' AS violation, rows FROM per WHERE customer_id IS NULL
UNION ALL SELECT customer_id, 'duplicate', rows FROM per WHERE customer_id IS NOT NULL AND rows > 1
UNION ALL SELECT customer_id, 'too_long', rows FROM per WHERE length(customer_id) > 10""",
    # Order, limit, sample, union
    "first_customers": with_(CUSTOMERS) + "SELECT * FROM cust ORDER BY customer_id LIMIT 10",
    "last_customers": with_(CUSTOMERS) + "SELECT * FROM cust ORDER BY customer_id DESC LIMIT 10",
    "daily_risk_report": with_(*TRAINING_D)
    + select("train_d", "event_day, tx_count, fraud_label", "ctr, fraud_score", "ORDER BY event_day"),
    "seeded_sample": with_(TX_DAILY)
    + select(
        "tx_d",
        TX_PLAIN,
        TX_DOUBLES,
        "ORDER BY md5(CAST(tx_id AS VARCHAR) || '|42'), tx_id LIMIT 100",
    ),
    "head": with_(TX_DAILY) + select("tx_d", TX_PLAIN, TX_DOUBLES, "ORDER BY tx_id LIMIT 5"),
    "source_row_counts": with_(TX_HOURLY, MKT_HOURLY, FIN_H, MKT_H)
    + """SELECT 'finance_fraud_features' AS table_name, COUNT(*) AS row_count FROM fin_h
UNION ALL SELECT 'marketing_fraud_features', COUNT(*) FROM mk_h""",
    # Scalar functions
    "calendar_parts": with_(TX_DAILY)
    + """SELECT tx_id, CAST(created_at AS DATE) AS event_date,
  CAST(EXTRACT(DOW FROM created_at) AS INTEGER) AS weekday,
  CAST(EXTRACT(MONTH FROM created_at) AS INTEGER) AS month,
  CAST(EXTRACT(YEAR FROM created_at) AS INTEGER) AS year FROM tx_d""",
    "epoch_to_ts": "SELECT event_id, ts FROM events",
    # Rules
    "risky_flag": with_(TX_HOURLY)
    + """SELECT tx_id, CASE WHEN transaction_amount > account_balance * 0.8 THEN 1 ELSE 0 END AS risky
  FROM tx_h""",
    "label_hourly": with_(*FEAT_H, LABEL_H) + "SELECT * FROM lab_h",
    "fraud_score_daily": with_(*FEAT_D, RAW_D)
    + f"""SELECT event_day, {r('raw_score')} AS raw_score,
  {r('LEAST(1.0, raw_score)')} AS fraud_score FROM raw_d""",
    "label_daily": with_(*FEAT_D, RAW_D, LABEL_D)
    + select("lab_d", "event_day, fraud_label, fraud_reason", "fraud_score"),
    "daily_fraud_alert": with_(*ALERTS)
    + select("alert", "event_day, fraud_label, alert_level", "fraud_score"),
    "alert_actions": with_(*ALERTS)
    + f"""SELECT event_day, {r('fraud_score')} AS fraud_score,
  replace(alert_level, ' RISK', '') AS alert_level,
  CASE alert_level WHEN 'HIGH RISK' THEN 'Freeze high-value tx'
       WHEN 'MEDIUM RISK' THEN 'Monitor' ELSE 'Ignore' END AS action FROM alert""",
    "alert_payload": with_(
        *ALERTS,
        """leveled AS (SELECT *, CASE alert_level WHEN 'HIGH RISK' THEN 'ERROR'
             WHEN 'MEDIUM RISK' THEN 'WARNING' ELSE 'INFO' END AS level,
           CASE alert_level WHEN 'HIGH RISK' THEN '#ff0000'
             WHEN 'MEDIUM RISK' THEN '#ffae42' ELSE '#439FE0' END AS color FROM alert)""",
    )
    + f"""SELECT event_day, level, color,
  '{{"attachments":[{{"color":"' || color || '","title":"[' || level || '] Daily fraud alert '
  || CAST(event_day AS VARCHAR) || '","text":"' || alert_level || ', label '
  || CAST(fraud_label AS VARCHAR) || '","footer":"RISK | {RUN_TS} UTC"}}]}}' AS payload
  FROM leveled""",
    "training_customer_day": TRAINING_CD,
    "synthetic_fraud": with_(TX_DAILY)
    + f"""SELECT tx_id, {r('transaction_amount')} AS transaction_amount,
  {r('account_balance')} AS account_balance,
  CASE WHEN transaction_amount > account_balance * 0.95 THEN 1 ELSE 0 END AS fraud FROM tx_d""",
    "daily_risk_summary": with_(*TRAINING_D)
    + select(
        "train_d",
        "event_day, tx_count, risky_tx_count, fraud_label, fraud_reason",
        "avg_tx_amount, ctr, fraud_score",
    ),
    # Data quality
    "validate_dataset": with_(TX_DAILY, FIN_DAY)
    + """SELECT 'daily_fraud_alert' AS query_key, 'success' AS validation_status,
  CAST(NULL AS VARCHAR) AS reason, COUNT(*) AS row_count,
  'event_day,fraud_score,fraud_label,alert_level' AS columns FROM fin_day
UNION ALL SELECT 'label_fraud', 'failed', 'empty table', NULL, NULL
UNION ALL SELECT 'no_such_key', 'error', 'Invalid query_key', NULL, NULL""",
    "describe": " UNION ALL ".join(
        describe_column(c) for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ),
    "null_counts": with_(*FEAT_D)
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", COUNT(*) - COUNT({c}) AS nulls FROM feat_d"""
        for c in FEATURE_DAILY_TYPES
    ),
    "schema_info": with_(*FEAT_D)
    + " UNION ALL ".join(
        f"""SELECT {i} AS position, '{c}' AS "column", '{t}' AS dtype, COUNT({c}) AS non_null
  FROM feat_d"""
        for i, (c, t) in enumerate(FEATURE_DAILY_TYPES.items())
    ),
    "histogram": with_(HISTOGRAM)
    + f"""SELECT e.bin, {r('lo + (e.bin - 1) * ((hi - lo) / 30)')} AS low,
  {r('lo + e.bin * ((hi - lo) / 30)')} AS high, COALESCE(h.n, 0) AS rows
  FROM edges e LEFT JOIN hist h ON e.bin = h.bin, span""",
    "kde": with_(KDE)
    + f"""SELECT point, {r('ANY_VALUE(lo + point * (hi - lo) / 199)', 8)} AS x,
  {r('SUM(k * exp(-0.5 * pow((lo + point * (hi - lo) / 199 - v) / h, 2))) / ANY_VALUE(n * h * sqrt(2 * pi()))', 8)}
    AS density
  FROM grid, stats, vals GROUP BY point""",
    "boxplot_stats": with_(BOX)
    + f"""SELECT {r('MAX(q1)')} AS q1, {r('MAX(median)')} AS median, {r('MAX(q3)')} AS q3,
  {r('MIN(value) FILTER (value >= q1 - 1.5 * (q3 - q1))')} AS whisker_low,
  {r('MAX(value) FILTER (value <= q3 + 1.5 * (q3 - q1))')} AS whisker_high,
  COUNT(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers
  FROM events, box""",
    # Model preparation and metrics
    "train_test_split": f"""SELECT o_orderkey AS tx_id,
  CASE WHEN {key_hash("CAST(o_orderkey AS VARCHAR) || '|42'")} / 4294967296.0 < 0.2
       THEN 'test' ELSE 'train' END AS split
  FROM orders JOIN customer ON o_custkey = c_custkey""",
    "stratified_split": with_(
        TX_DAILY,
        f"""hashed AS (SELECT tx_id, CASE WHEN event_type = 'fail_tx' THEN 1 ELSE 0 END AS failed_tx,
          {key_hash("CAST(tx_id AS VARCHAR) || '|42'")} AS h FROM tx_d)""",
        """ranked AS (SELECT *, rank() OVER (PARTITION BY failed_tx ORDER BY h) AS i,
          ceil(0.2 * COUNT(*) OVER (PARTITION BY failed_tx)) AS cut FROM hashed)""",
    )
    + "SELECT tx_id, failed_tx, CASE WHEN i <= cut THEN 'test' ELSE 'train' END AS split FROM ranked",
    "validation_holdout": with_(TX_DAILY)
    + """SELECT tx_id, created_at,
  CASE WHEN row_number() OVER (ORDER BY created_at, tx_id) <= floor(COUNT(*) OVER () * 0.8)
       THEN 'train' ELSE 'validation' END AS split FROM tx_d""",
    "standard_scale": with_(
        TX_DAILY,
        f"""parts AS (SELECT *, CASE WHEN {key_hash("CAST(tx_id AS VARCHAR) || '|42'")}
          / 4294967296.0 < 0.2 THEN 'test' ELSE 'train' END AS split FROM tx_d)""",
        """fit AS (SELECT AVG(transaction_amount) AS m1, STDDEV_POP(transaction_amount) AS s1,
          AVG(account_balance) AS m2, STDDEV_POP(account_balance) AS s2
          FROM parts WHERE split = 'train')""",
    )
    + f"""SELECT tx_id, {r('(transaction_amount - m1) / s1')} AS transaction_amount,
  {r('(account_balance - m2) / s2')} AS account_balance, CAST(0.0 AS DOUBLE) AS constant, split
  FROM parts, fit""",
    "minmax_scale": with_(*SCORED_CD, MINMAX)
    + f"SELECT user_id, event_date, {r('p')} AS fraud_score FROM scaled",
    "confusion_matrix": with_(*JUDGED_CD, "cells AS (SELECT * FROM (VALUES (0,0),(0,1),(1,0),(1,1)) v(a, p))")
    + """SELECT a AS actual, p AS predicted,
  (SELECT COUNT(*) FROM judged WHERE fraud_label = a AND fraud_prediction = p) AS rows FROM cells""",
    "classification_report": with_(*JUDGED_CD, REPORT)
    + " UNION ALL ".join(
        [
            report_row("0", "pr0", "re0", "f0", "a0"),
            report_row("1", "pr1", "re1", "f1c", "a1"),
            report_row("accuracy", "CAST(NULL AS DOUBLE)", "CAST(NULL AS DOUBLE)", "(h0 + h1) / n", "n"),
            report_row("macro avg", "(pr0 + pr1) / 2", "(re0 + re1) / 2", "(f0 + f1c) / 2", "n"),
            report_row(
                "weighted avg", weighted("pr{}"), weighted("re{}"), "(f0 * a0 + f1c * a1) / n", "n"
            ),
        ]
    ),
    "roc_auc": with_(*JUDGED_CD, AUC) + AUC_ROW,
    "roc_auc_binned": with_(*JUDGED_CD, BINS, AUC.replace("judged", "binned"))
    + AUC_ROW,
    "log_loss": with_(*JUDGED_CD, """clipped AS (SELECT fraud_label AS y,
  GREATEST(1e-7, LEAST(1 - 1e-7, fraud_probability)) AS p FROM judged)""")
    + f"SELECT {r('AVG(-(y * ln(p) + (1 - y) * ln(1 - p)))')} AS log_loss FROM clipped",
    "prediction_summary": with_(*JUDGED_CD)
    + f"""SELECT COUNT(*) AS rows, {r('MIN(fraud_probability)')} AS min_probability,
  {r('MAX(fraud_probability)')} AS max_probability, {r('AVG(fraud_probability)')} AS mean_probability,
  CAST(SUM(fraud_prediction) AS BIGINT) AS predicted_frauds FROM judged""",
    "risk_prompt": with_(
        *JUDGED_CD,
        "shown AS ("
        + select("judged", CD_PLAIN, f"{CD_DOUBLES}, fraud_probability")
        + f"), texts AS (SELECT user_id, event_date, {prompt_sql()} AS prompt FROM shown)",
    )
    + "SELECT user_id, event_date, md5(prompt) AS prompt_md5, CAST(length(prompt) AS INTEGER) AS prompt_length FROM texts",
    "model_store": with_(TX_DAILY, MKT_DAILY, CUSTOMER_DAY, FIN_DAY, DAY_JOIN)
    + "SELECT COUNT(*) AS rows, CAST(0 AS BIGINT) AS changed FROM day_join",
    "train_mlp": with_(*LABELLED_CD)
    + """SELECT user_id, event_date, true AS is_probability, true AS decision_agrees, true AS learned
  FROM lab_cd""",
    "early_stopping": "SELECT true AS best_is_first_maximum, true AS stopped_in_time, true AS learned",
    "training_run": with_(*LABELLED_CD, SPLIT_DAYS)
    + f"""SELECT true AS best_is_first_maximum, true AS stopped_in_time, true AS learned,
  {TEST_ROWS} AS test_rows, true AS holds_on_test_rows""",
    "score_model": with_(*NETWORK)
    + f"""SELECT user_id, event_date, fraud_label, {r('p')} AS fraud_probability,
  CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS fraud_prediction FROM net""",
    "scoring_run": with_(
        *LABELLED_CD,
        "lab_r AS (" + select("lab_cd", f"{CD_PLAIN}, fraud_label", CD_DOUBLES) + ")",
        DAYS_WITH_DAY.replace("lab_cd", "lab_r"),
        *scaled("sc", "days", QUOTED_FEATURES),
        *forward("net", "sc", len(FEATURES)),
        "low AS (SELECT MIN(fraud_score) AS lo, MAX(fraud_score) AS hi FROM lab_r)",
        "scores AS (SELECT *, p AS fraud_probability FROM net)",
    )
    + f"""SELECT user_id, event_date, {r('p')} AS fraud_probability,
  CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS fraud_prediction,
  {r('(fraud_score - lo) / (hi - lo) * 0.74 + 0.25')} AS scaled_score, md5({prompt_sql()}) AS prompt_md5 FROM scores, low""",
    "transaction_inference": with_(*TX_NETWORK)
    + f"""SELECT tx_id AS transaction_id, {r('p')} AS fraud_probability,
  CASE WHEN p >= 0.5 THEN 1 ELSE 0 END AS fraud_label FROM net""",
    "marketing_model": with_(
        MKT_DAILY,
        CUSTOMER_DAY,
        f"""keyed AS (SELECT *, {drawn("customer_id || '|' || event_date || '|42'")} AS test FROM cust_day)""",
        "sizes AS (SELECT COUNT(*) FILTER (test) AS t, COUNT(*) FILTER (NOT test) AS n FROM keyed)",
    )
    + """SELECT 'test' AS part, t AS "rows", true AS learned FROM sizes
UNION ALL SELECT 'validation', n - CAST(floor(n * 0.8) AS BIGINT), true FROM sizes""",
    "anomaly_isolation": with_(TX_DAILY)
    + """SELECT tx_id, true AS in_range, true AS flag_agrees, CAST(NULL AS BOOLEAN) AS planted_flagged FROM tx_d
UNION ALL SELECT -n, true, true, true FROM range(1, 4) t(n)""",
    # Streaming
    "parse_events_strange_times": f"""SELECT CAST(c_custkey AS VARCHAR) AS customer_id, x."end" AS "end", x.seconds AS seconds
FROM customer CROSS JOIN (
  SELECT 'good' AS "end", CAST(unnest([{', '.join(GOOD_TIMES)}]) AS DOUBLE) AS seconds
  UNION ALL SELECT 'reject', CAST(NULL AS DOUBLE) FROM range({len(STRANGE_TIMES)})) x""",
    "ingest_run": with_(
        TX_HOURLY,
        f"""streamed AS (
  SELECT customer_id, transaction_amount, event_type, CAST(created_at AS DATE) AS day FROM tx_h
  WHERE event_type <> 'fail_tx'
  UNION ALL
  SELECT CAST(c_custkey AS VARCHAR), 1.5, 'click',
    CAST(to_timestamp(CAST(unnest([{', '.join(GOOD_TIMES)}]) AS DOUBLE)) AT TIME ZONE 'UTC' AS DATE) FROM customer)""",
    )
    + f"""SELECT customer_id, event_type, day, COUNT(*) AS "rows", {r('SUM(transaction_amount)')} AS amount
FROM streamed GROUP BY 1, 2, 3
UNION ALL SELECT NULL, 'reject', NULL,
  (SELECT COUNT(*) FROM tx_h WHERE event_type = 'fail_tx') + {len(STRANGE_TIMES)} * (SELECT COUNT(*) FROM customer), 0.0""",
    "ingest_beside_loads": with_(TX_HOURLY, TX_DAILY, f"""filled AS (
  SELECT 'events' AS writer, event_type, transaction_amount, created_at FROM tx_h
  UNION ALL SELECT 'load', CAST(NULL AS VARCHAR), transaction_amount, created_at FROM tx_d)""")
    + f"""SELECT "first", writer, event_type, CAST(created_at AS DATE) AS day,
  CAST(date_trunc('month', created_at) AS DATE) AS event_month, COUNT(*) AS "rows",
  {r('SUM(transaction_amount)')} AS amount, MAX(created_at) AS latest
FROM filled, (SELECT unnest(['load', 'stream']) AS "first") o GROUP BY 1, 2, 3, 4, 5""",
    "ingest_compacted": with_(TX_HOURLY)
    + f"""SELECT 'events' AS writer, event_type, CAST(created_at AS DATE) AS day,
  CAST(date_trunc('month', created_at) AS DATE) AS event_month, COUNT(*) AS "rows",
  {r('SUM(transaction_amount)')} AS amount, MAX(created_at) AS latest, CAST(1 AS BIGINT) AS places_a_month
FROM tx_h GROUP BY 1, 2, 3, 4""",
    "ingest_features": with_(*FEAT_H)
    + select("feat_h", "event_hour, tx_count, active_users, total_clicks", "total_tx_amount, max_tx_amount"),
    "parse_events": with_(TX_HOURLY)
    + f"SELECT {STREAM_COLUMNS} FROM tx_h WHERE event_type <> 'fail_tx'",
    "parse_event_rejects": with_(TX_HOURLY)
    + f"SELECT {BROKEN} AS value FROM tx_h WHERE event_type = 'fail_tx'",
    "stream_source": "SELECT event_id || '|' || event_type || '|' || props AS value FROM events",
    "stream_append": with_(TX_HOURLY) + f"SELECT {STREAM_COLUMNS} FROM tx_h",
    # Jobs
    "medallion_run": CUSTOMER_FEATURES,
    "feature_run": with_(TX_DAILY, MKT_DAILY, CUSTOMER_DAY, FIN_DAY, DAY_JOIN)
    + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, ({sql}) AS row_count" for name, sql in ROW_COUNTS.items()
    ),
    "feature_run_training": TRAINING_CD,
}

# Hourly tables of the feature job over the daily input.
_HOURS = [
    TX_DAILY,
    MKT_DAILY,
    fin("fin_x", "tx_d", "event_hour", HOUR),
    mkt("mk_x", "mkt_d", "event_hour", HOUR),
    feat("feat_h", "fin_x", "mk_x", "event_hour"),
]
_HOURS_LABELLED = [*_HOURS, LABEL_H]

ORACLE |= {
    "stored_finance_hourly": with_(*_HOURS) + select("fin_x", "event_hour, tx_count, risky_tx_count", FIN_DOUBLES),
    "stored_marketing_hourly": with_(*_HOURS) + select("mk_x", f"event_hour, {MKT_PLAIN}", MKT_DOUBLES),
    "stored_feature_hourly": with_(*_HOURS) + select("feat_h", f"event_hour, {FEAT_PLAIN}", FEAT_DOUBLES),
    "stored_label_hourly": with_(*_HOURS_LABELLED) + "SELECT event_hour, fraud_label, fraud_reason FROM lab_h",
    "stored_training_hourly": with_(*_HOURS_LABELLED)
    + select(
        "(SELECT * FROM feat_h JOIN lab_h USING (event_hour)) x",
        f"event_hour, {FEAT_PLAIN}, fraud_label, fraud_reason",
        FEAT_DOUBLES,
    ),
    "stored_finance_daily": FIN_DAILY,
    "stored_marketing_daily": MKT_DAILY_SQL,
    "stored_feature_daily": ORACLE["feature_daily"],
    "stored_label_daily": ORACLE["label_daily"],
    "stored_training_daily": ORACLE["training_daily"],
    "stored_alert": ORACLE["daily_fraud_alert"],
    "stored_finance_day": ORACLE["finance_day_basic"],
    "stored_customer_day": ORACLE["marketing_customer_day"],
    "stored_marketing_scores": ORACLE["ctr_proxy_target"],
}
