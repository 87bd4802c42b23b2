"""SQL for DuckDB that answers each registered query over the same parquet tables."""

from __future__ import annotations

# Raw tables with known anomalies, one payment and one settlement per order at most.
RAW = """
raw_merchants AS (
  SELECT c_custkey AS c, concat(' M', c_custkey) AS merchant_id, concat(c_name, ' ') AS merchant_name,
         CASE WHEN c_custkey % 89 = 7 THEN NULL
              ELSE CAST(CAST(25 + (c_custkey % 5) * 5 AS DECIMAL(9,0))
                        * CAST('0.001' AS DECIMAL(9,9)) AS DECIMAL(18,9)) END AS fee_rate
  FROM customer WHERE c_custkey % 97 <> 13),
raw_orders AS (
  SELECT o_orderkey AS k, o_custkey AS c, concat('O', o_orderkey) AS order_id,
         concat('M', o_custkey, ' ') AS merchant_id,
         CAST(floor(o_totalprice) AS BIGINT) AS order_amount, o_orderdate AS ordered_at
  FROM orders),
raw_payments AS (
  SELECT k, c, merchant_id, ordered_at, base, concat('P', k) AS payment_id, order_id,
         CASE WHEN k % 167 = 71 THEN 'n/a' ELSE CAST(base AS VARCHAR) END AS payment_amount,
         CASE WHEN k % 107 = 17 THEN 'failed' WHEN k % 2 = 0 THEN ' success ' ELSE 'SUCCESS' END
           AS payment_status,
         CASE WHEN k % 107 = 17 THEN ' ' ELSE concat('B', k) END AS settlement_batch_id,
         CASE WHEN k % 127 = 31 THEN NULL
              WHEN k % 109 = 19 THEN ordered_at - INTERVAL '1' DAY
              ELSE ordered_at + INTERVAL '1' MINUTE END AS paid_at
  FROM (SELECT *, order_amount - CASE WHEN k % 103 = 11 THEN 500 ELSE 0 END AS base
        FROM raw_orders WHERE k % 101 <> 5)),
raw_settlements AS (
  SELECT concat('S', k) AS settlement_id, concat(' B', k) AS settlement_batch_id,
         CASE WHEN k % 131 = 37 THEN 'M-X' ELSE merchant_id END AS merchant_id,
         base + CASE WHEN k % 137 = 41 THEN 250 ELSE 0 END AS gross_amount,
         fee0 + CASE WHEN k % 139 = 43 THEN 1 ELSE 0 END AS fee_amount,
         base - fee0 - CASE WHEN k % 149 = 47 THEN 100 ELSE 0 END AS net_amount,
         CASE WHEN k % 151 = 53 THEN 'pending' ELSE 'completed ' END AS settlement_status,
         CASE WHEN k % 163 = 61 THEN NULL
              WHEN k % 157 = 59 THEN ordered_at - INTERVAL '2' DAY
              ELSE ordered_at + INTERVAL '3' DAY END AS settled_at
  FROM (SELECT p.*, coalesce(CAST(round(CAST(p.base AS DECIMAL(19,0)) * m.fee_rate) AS BIGINT), 0)
                 AS fee0
        FROM raw_payments p LEFT JOIN raw_merchants m ON p.c = m.c)
  WHERE k % 113 <> 23 AND k % 107 <> 17)"""

# Text only, with duplicates, orphans, shared batches, null keys and values that do not cast.
MESSY_RAW = """
m_customer AS (
  SELECT c_custkey AS c, concat(chr(9), 'M', c_custkey) AS merchant_id,
         concat(chr(12288), c_name) AS merchant_name,
         CASE WHEN c_custkey % 89 = 7 THEN '3%'
              WHEN c_custkey % 83 = 5 THEN '12345678901.5'
              ELSE concat('0.0', CAST(25 + (c_custkey % 5) * 5 AS VARCHAR)) END AS fee_rate
  FROM customer),
raw_merchants AS (
  SELECT * FROM m_customer WHERE c % 41 <> 5 UNION ALL SELECT * FROM m_customer WHERE c % 30 = 4),
m_order AS (
  SELECT o_orderkey AS k,
         CASE WHEN o_orderkey % 40 <> 3 THEN concat('O', o_orderkey, chr(12288)) END AS order_id,
         CASE WHEN o_orderkey % 45 <> 8 THEN concat('M', o_custkey, chr(9)) END AS merchant_id,
         CASE WHEN o_orderkey % 53 = 2 THEN 'abc'
              ELSE CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR) END AS order_amount,
         CASE WHEN o_orderkey % 59 = 1 THEN 'soon' WHEN o_orderkey % 61 = 1 THEN '10:30'
              ELSE CAST(o_orderdate AS VARCHAR) END AS ordered_at,
         CAST(floor(o_totalprice) AS BIGINT) AS price, o_custkey AS c, o_orderdate AS day
  FROM orders),
raw_orders AS (SELECT * FROM m_order UNION ALL SELECT * FROM m_order WHERE k % 60 = 7),
m_settlement AS (
  SELECT k, CASE WHEN k % 67 <> 8 THEN concat('S', k) END AS settlement_id,
         CASE WHEN k % 71 <> 9 THEN concat('B', k, ' ') END AS settlement_batch_id,
         concat('M', c, ' ') AS merchant_id, CAST(price AS VARCHAR) AS gross_amount,
         CAST(price % 1000 AS VARCHAR) AS fee_amount,
         CASE WHEN k % 73 = 4 THEN '' ELSE CAST(price - price % 1000 AS VARCHAR) END AS net_amount,
         CASE k % 4 WHEN 0 THEN 'completed' WHEN 1 THEN 'COMPLETED ' WHEN 2 THEN ' pending' END
           AS settlement_status,
         CASE WHEN k % 79 <> 6 THEN CAST(day + INTERVAL '30' DAY AS VARCHAR) END AS settled_at
  FROM m_order),
raw_settlements AS (
  SELECT * FROM m_settlement UNION ALL SELECT * FROM m_settlement WHERE k % 50 = 0),
raw_payments AS (
  SELECT CASE WHEN s % 61 <> 5 THEN concat('P', k, '-', l_linenumber) END AS payment_id,
         CASE WHEN s % 43 = 1 THEN NULL WHEN s % 47 = 3 THEN concat('X', k)
              WHEN s % 41 = 2 THEN concat('O', k, chr(10))
              WHEN s % 41 = 3 THEN concat('O', k, chr(13), chr(10))
              ELSE concat(' O', k, chr(9)) END AS order_id,
         CASE WHEN s % 37 = 2 THEN 'n/a'
              ELSE CAST(CAST(floor(l_extendedprice) AS BIGINT) AS VARCHAR) END AS payment_amount,
         CASE s % 6 WHEN 0 THEN 'failed' WHEN 1 THEN concat(chr(12288), 'success ')
                    WHEN 2 THEN concat('SUCCESS', CASE WHEN s % 5 = 1 THEN chr(8232) ELSE chr(13) END)
                    WHEN 3 THEN 'Success' WHEN 4 THEN 'refunded' END
           AS payment_status,
         CASE WHEN s % 31 = 6 THEN NULL WHEN s % 29 = 4 THEN concat(chr(9), ' ')
              WHEN s % 23 = 5 THEN concat('B', k, chr(133))
              ELSE concat(' B', k) END AS settlement_batch_id,
         CASE WHEN s % 83 = 2 THEN '2026-13-45' ELSE CAST(l_shipdate AS VARCHAR) END AS paid_at
  FROM (SELECT *, l_orderkey AS k, l_orderkey + l_linenumber AS s FROM lineitem))"""

SPACES = "concat(' ', chr(9), chr(10), chr(13), chr(133), chr(8232), chr(12288))"

STAGING = f"""
stg_merchants AS (
  SELECT trim(merchant_id, {SPACES}) AS merchant_id, trim(merchant_name, {SPACES}) AS merchant_name,
         TRY_CAST(fee_rate AS DECIMAL(38,9)) AS fee_rate
  FROM raw_merchants),
stg_orders AS (
  SELECT trim(order_id, {SPACES}) AS order_id, trim(merchant_id, {SPACES}) AS merchant_id,
         TRY_CAST(order_amount AS BIGINT) AS order_amount,
         TRY_CAST(ordered_at AS TIMESTAMP) AS ordered_at
  FROM raw_orders),
stg_payments AS (
  SELECT trim(payment_id, {SPACES}) AS payment_id, trim(order_id, {SPACES}) AS order_id,
         TRY_CAST(payment_amount AS BIGINT) AS payment_amount,
         upper(trim(payment_status, {SPACES})) AS payment_status,
         nullif(trim(settlement_batch_id, {SPACES}), '') AS settlement_batch_id,
         TRY_CAST(paid_at AS TIMESTAMP) AS paid_at
  FROM raw_payments),
stg_settlements AS (
  SELECT trim(settlement_id, {SPACES}) AS settlement_id,
         trim(settlement_batch_id, {SPACES}) AS settlement_batch_id,
         trim(merchant_id, {SPACES}) AS merchant_id,
         TRY_CAST(gross_amount AS BIGINT) AS gross_amount,
         TRY_CAST(fee_amount AS BIGINT) AS fee_amount, TRY_CAST(net_amount AS BIGINT) AS net_amount,
         upper(trim(settlement_status, {SPACES})) AS settlement_status,
         TRY_CAST(settled_at AS TIMESTAMP) AS settled_at
  FROM raw_settlements)"""

# Flag, category number, category, display number, reason.
CATALOG = [
    ("is_payment_missing", 1, "データ欠損", 1, "決済データ欠損"),
    ("is_merchant_missing", 1, "データ欠損", 2, "加盟店マスタ欠損"),
    ("is_fee_rate_missing", 1, "データ欠損", 3, "手数料率欠損"),
    ("is_settlement_missing", 1, "データ欠損", 4, "精算データ欠損"),
    ("is_settlement_not_completed", 2, "処理状態異常", 5, "精算未完了"),
    ("is_order_payment_amount_mismatch", 3, "データ不一致", 6, "注文・決済金額不一致"),
    ("is_merchant_mismatch", 3, "データ不一致", 7, "加盟店不一致"),
    ("is_gross_amount_mismatch", 3, "データ不一致", 8, "決済・精算総額不一致"),
    ("is_fee_amount_mismatch", 3, "データ不一致", 9, "手数料額不一致"),
    ("is_net_amount_mismatch", 3, "データ不一致", 10, "入金額不一致"),
    ("is_payment_datetime_invalid", 4, "日時不正", 11, "決済日時不正"),
    ("is_settlement_datetime_invalid", 4, "日時不正", 12, "精算日時不正"),
]
FLAGS = [code for code, *_ in CATALOG]
FLAG_SUM = " + ".join(f"CAST({code} AS BIGINT)" for code in FLAGS)

# When a flag is raised, given whether the order is paid, settled and listed in the master.
# A comparison of times that cannot be made counts as a failed one. An expected fee exists only if
# amount and rate do.
CONDITIONS = {
    "is_payment_missing": "NOT paid",
    "is_merchant_missing": "NOT listed",
    "is_fee_rate_missing": "listed AND fee_rate IS NULL",
    "is_settlement_missing": "paid AND NOT settled",
    "is_settlement_not_completed": "settled AND coalesce(settlement_status, '?') <> 'COMPLETED'",
    "is_order_payment_amount_mismatch": "paid AND order_amount IS DISTINCT FROM payment_amount",
    "is_merchant_mismatch": "settled AND settlement_merchant_id IS DISTINCT FROM merchant_id",
    "is_gross_amount_mismatch": "paid AND settled AND payment_amount IS DISTINCT FROM gross_amount",
    "is_fee_amount_mismatch":
        "settled AND expected_fee_amount <> coalesce(actual_fee_amount, expected_fee_amount + 1)",
    "is_net_amount_mismatch":
        "settled AND expected_net_amount <> coalesce(actual_net_amount, expected_net_amount + 1)",
    "is_payment_datetime_invalid": "paid AND NOT coalesce(paid_at >= ordered_at, FALSE)",
    "is_settlement_datetime_invalid": "settled AND NOT coalesce(settled_at >= paid_at, FALSE)",
}
RAISED = ", ".join(f"coalesce({rule}, FALSE) AS {code}" for code, rule in CONDITIONS.items())

MART = f"""
settled_payments AS (
  SELECT p.* EXCLUDE (payment_status), s.settlement_id, s.merchant_id AS settlement_merchant_id,
         s.gross_amount, s.fee_amount AS actual_fee_amount, s.net_amount AS actual_net_amount,
         s.settlement_status, s.settled_at
  FROM stg_payments p LEFT JOIN stg_settlements s USING (settlement_batch_id)
  WHERE p.payment_status = 'SUCCESS'),
priced AS (
  SELECT o.*, p.* EXCLUDE (order_id), m.merchant_id AS merchant_master_id,
         m.merchant_name, m.fee_rate,
         TRY_CAST(CAST(trunc(m.fee_rate) AS HUGEINT) * p.payment_amount AS BIGINT)
           + CAST(round(CAST(m.fee_rate - trunc(m.fee_rate) AS DECIMAL(9,9))
                        * CAST(p.payment_amount AS DECIMAL(19,0))) AS BIGINT)
           AS expected_fee_amount
  FROM stg_orders o
  LEFT JOIN stg_merchants m USING (merchant_id)
  LEFT JOIN settled_payments p ON p.order_id = o.order_id),
joined AS (SELECT *, payment_amount - expected_fee_amount AS expected_net_amount FROM priced),
flagged AS (
  SELECT * EXCLUDE (merchant_master_id, paid, settled, listed), {RAISED}
  FROM (SELECT *, payment_id IS NOT NULL AS paid, settlement_id IS NOT NULL AS settled,
               merchant_master_id IS NOT NULL AS listed FROM joined)),
counted AS (SELECT *, {FLAG_SUM} AS error_count FROM flagged),
fct AS (
  SELECT *, if(error_count = 0, 'MATCHED', 'ERROR') AS reconciliation_status FROM counted)"""

CATALOG_ROWS = (
    "catalog(error_code, category_sort_order, error_category, sort_order, error_reason) AS (VALUES "
    + ", ".join(f"('{code}', {a}, '{b}', {c}, '{d}')" for code, a, b, c, d in CATALOG)
    + ")"
)
LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT *, '{code}' AS error_code, {code} AS has_error FROM fct" for code in FLAGS
) + ")"
ERRORS = """
errors AS (
  SELECT order_id, merchant_id, merchant_name, payment_id, settlement_id, error_code, error_reason,
         order_amount, payment_amount, gross_amount, actual_fee_amount, expected_fee_amount,
         actual_net_amount, expected_net_amount, ordered_at, paid_at, settled_at
  FROM long JOIN catalog USING (error_code) WHERE has_error)"""

METRICS = f"""
metrics AS (
  UNPIVOT (
    SELECT count(*) AS total_orders,
           count(*) FILTER (reconciliation_status = 'MATCHED') AS matched_orders,
           count(*) FILTER (reconciliation_status = 'ERROR') AS error_orders,
           {", ".join(f"count(*) FILTER ({code}) AS {code}" for code in FLAGS)},
           (SELECT count(*) FROM errors) AS error_detail_rows
    FROM fct)
  ON COLUMNS(*) INTO NAME metric VALUE actual_value)"""

PAID = "(k % 101 <> 5 AND k % 107 <> 17)"
SETTLED = f"({PAID} AND k % 113 <> 23)"
LISTED = "(c % 97 <> 13)"
RATED = f"({LISTED} AND c % 89 <> 7)"
READABLE = "(k % 167 <> 71)"
EXPECTED_FLAGS = {
    "is_payment_missing": f"NOT {PAID}",
    "is_merchant_missing": f"NOT {LISTED}",
    "is_fee_rate_missing": f"{LISTED} AND NOT {RATED}",
    "is_order_payment_amount_mismatch": f"{PAID} AND (k % 103 = 11 OR NOT {READABLE})",
    "is_settlement_missing": f"{PAID} AND NOT {SETTLED}",
    "is_settlement_not_completed": f"{SETTLED} AND k % 151 = 53",
    "is_merchant_mismatch": f"{SETTLED} AND k % 131 = 37",
    "is_gross_amount_mismatch": f"{SETTLED} AND (k % 137 = 41 OR NOT {READABLE})",
    "is_fee_amount_mismatch": f"{SETTLED} AND {RATED} AND {READABLE} AND k % 139 = 43",
    "is_net_amount_mismatch": f"{SETTLED} AND {RATED} AND {READABLE} AND k % 149 = 47",
    "is_payment_datetime_invalid": f"{PAID} AND (k % 127 = 31 OR k % 109 = 19)",
    "is_settlement_datetime_invalid":
        f"{SETTLED} AND (k % 127 = 31 OR k % 163 = 61 OR k % 157 = 59)",
}
EXPECTED_COUNT = " + ".join(f"CAST(expected_{code} AS BIGINT)" for code in FLAGS)
EXPECTED = f"""
labelled AS (
  SELECT k, {", ".join(f"{rule} AS expected_{code}" for code, rule in EXPECTED_FLAGS.items())}
  FROM (SELECT o_orderkey AS k, o_custkey AS c FROM orders)),
expected AS (
  SELECT CASE WHEN k % 223 = 7 THEN concat('X', k) ELSE concat('O', k) END AS order_id,
         * EXCLUDE (k), {EXPECTED_COUNT} AS expected_error_count,
         CASE WHEN (k % 211 = 100) = ({EXPECTED_COUNT} > 0) THEN 'MATCHED' ELSE 'ERROR' END
           AS expected_reconciliation_status
  FROM labelled)"""
COMPARED = [*FLAGS, "error_count", "reconciliation_status"]
ORDER_DIFF = f"""
SELECT e.*, {", ".join(f"a.{name}" for name in COMPARED)}
FROM expected e LEFT JOIN fct a ON a.order_id = e.order_id
WHERE row({", ".join(f"a.{name}" for name in COMPARED)})
   IS DISTINCT FROM row({", ".join(f"e.expected_{name}" for name in COMPARED)})"""
EXPECTED_METRICS = f"""
expected_metrics AS (
  UNPIVOT (
    SELECT count(*) AS total_orders,
           count(*) FILTER (expected_reconciliation_status = 'MATCHED') AS matched_orders,
           count(*) FILTER (expected_reconciliation_status = 'ERROR') AS error_orders,
           {", ".join(f"count(*) FILTER (expected_{code}) AS {code}" for code in FLAGS)},
           CAST(sum(expected_error_count) AS BIGINT) AS error_detail_rows
    FROM expected)
  ON COLUMNS(*) INTO NAME metric VALUE expected_value)"""

SUMMARY = """
SELECT c.*, count(e.error_code) AS error_count
FROM catalog c LEFT JOIN errors e ON e.error_code = c.error_code
GROUP BY ALL"""
DETAILS = """
SELECT e.* EXCLUDE (merchant_name, error_code, actual_net_amount),
       e.payment_amount AS expected_gross_amount, e.actual_net_amount AS net_amount,
       r.settlement_status
FROM errors e LEFT JOIN (SELECT order_id, settlement_status FROM fct) r USING (order_id)"""

# Which column carries which check.
NOT_NULL = [
    ("stg_merchants", "stg_merchants", ["merchant_id"]),
    ("stg_orders", "stg_orders", ["order_id", "merchant_id", "order_amount"]),
    ("stg_payments", "stg_payments", ["payment_id", "order_id"]),
    ("stg_settlements", "stg_settlements", ["settlement_id", "settlement_batch_id"]),
    ("fct", "fct_payment_reconciliation",
     ["order_id", *FLAGS, "error_count", "reconciliation_status"]),
    ("errors", "fct_reconciliation_errors", ["order_id", "error_code", "error_reason"]),
]
UNIQUE = [
    ("stg_merchants", "stg_merchants", "merchant_id"),
    ("stg_orders", "stg_orders", "order_id"),
    ("stg_payments", "stg_payments", "payment_id"),
    ("stg_settlements", "stg_settlements", "settlement_id"),
    ("stg_settlements", "stg_settlements", "settlement_batch_id"),
    ("fct", "fct_payment_reconciliation", "order_id"),
]
ACCEPTED = [
    ("stg_payments", "stg_payments", "payment_status", ["SUCCESS", "FAILED"]),
    ("fct", "fct_payment_reconciliation", "reconciliation_status", ["MATCHED", "ERROR"]),
    ("errors", "fct_reconciliation_errors", "error_code", FLAGS),
]


def _line(table: str, check: str, column: str, rest: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{check}' AS check_name, '{column}' AS column_name, "
        f"count(*) AS failing_rows FROM {rest}"
    )


CHECKS = {
    "not_null": [
        _line(table, "not_null", column, f"{source} WHERE {column} IS NULL")
        for source, table, columns in NOT_NULL
        for column in columns
    ],
    "unique": [
        _line(
            table, "unique", key,
            f"(SELECT {key} FROM {source} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)",
        )
        for source, table, key in UNIQUE
    ],
    "accepted_values": [
        _line(
            table, "accepted_values", column,
            f"{source} WHERE {column} NOT IN ({', '.join(repr(v) for v in values)})",
        )
        for source, table, column, values in ACCEPTED
    ],
    "relationships": [
        _line("stg_payments", "relationships", "order_id",
              "stg_payments p WHERE order_id IS NOT NULL "
              "AND NOT EXISTS (SELECT 1 FROM stg_orders o WHERE o.order_id = p.order_id)"),
        _line("fct_reconciliation_errors", "relationships", "order_id",
              "errors e WHERE order_id IS NOT NULL "
              "AND NOT EXISTS (SELECT 1 FROM fct f WHERE f.order_id = e.order_id)"),
    ],
    "error_count": [
        _line("fct_payment_reconciliation", "error_count", "error_count",
              f"fct WHERE error_count <> {FLAG_SUM}"),
    ],
    "status": [
        _line("fct_payment_reconciliation", "status", "reconciliation_status",
              "fct WHERE (error_count = 0 AND reconciliation_status <> 'MATCHED') "
              "OR (error_count > 0 AND reconciliation_status <> 'ERROR')"),
    ],
}


def _checks(*names: str) -> str:
    return " UNION ALL ".join(line for name in names for line in CHECKS[name])


def _with(select: str, raw: str = RAW) -> str:
    """All common tables in front of one select. DuckDB evaluates only those it uses."""
    tables = [raw, STAGING, MART, CATALOG_ROWS, LONG, ERRORS, METRICS, EXPECTED, EXPECTED_METRICS]
    return "WITH " + ",\n".join(part.strip() for part in tables) + "\n" + select.strip()


JOINED_COLUMNS = (
    "order_id, merchant_id, merchant_name, order_amount, ordered_at, payment_id, payment_amount, "
    "settlement_batch_id, paid_at, settlement_id, settlement_merchant_id, gross_amount, "
    "actual_fee_amount, actual_net_amount, settlement_status, settled_at, fee_rate, "
    "expected_fee_amount, expected_net_amount, merchant_master_id"
)
SUCCESSFUL = (
    "(SELECT * EXCLUDE (payment_status) FROM stg_payments WHERE payment_status = 'SUCCESS')"
)


def oracles() -> dict[str, str]:
    selects = {
        **{f"stg_{name}": f"SELECT * FROM stg_{name}"
           for name in ("merchants", "orders", "payments", "settlements")},
        **{f"reload_csv_{name}": f"SELECT * FROM stg_{name}"
           for name in ("merchants", "orders", "payments", "settlements")},
        "successful_payments": "SELECT * FROM stg_payments WHERE payment_status = 'SUCCESS'",
        "join_order_payment":
            f"SELECT * FROM stg_orders LEFT JOIN {SUCCESSFUL} USING (order_id)",
        "join_order_merchant":
            "SELECT o.*, m.merchant_id AS merchant_master_id, m.merchant_name, m.fee_rate "
            "FROM stg_orders o LEFT JOIN stg_merchants m ON o.merchant_id = m.merchant_id",
        "join_payment_settlement":
            "SELECT p.*, s.settlement_id, s.merchant_id AS settlement_merchant_id, s.gross_amount, "
            "s.fee_amount AS actual_fee_amount, s.net_amount AS actual_net_amount, "
            f"s.settlement_status, s.settled_at FROM {SUCCESSFUL} p LEFT JOIN stg_settlements s "
            "ON p.settlement_batch_id = s.settlement_batch_id",
        "joined_orders": f"SELECT {JOINED_COLUMNS} FROM joined",
        "expected_amounts":
            "SELECT order_id, payment_amount, fee_rate, expected_fee_amount, expected_net_amount "
            "FROM joined",
        **{f"rule_{code}": f"SELECT order_id, {code} FROM fct" for code in FLAGS},
        "error_count_status": "SELECT order_id, error_count, reconciliation_status FROM fct",
        "fct_payment_reconciliation": "SELECT * FROM fct",
        "unpivot_flags": "SELECT order_id, error_code, has_error FROM long",
        "fct_reconciliation_errors": "SELECT * FROM errors",
        "error_counts": "SELECT error_code, count(*) AS error_count FROM errors GROUP BY 1",
        "error_type_summary": SUMMARY,
        "rebuild_warehouse": SUMMARY,
        "reconciliation_error_details": DETAILS,
        "metric_distribution": "SELECT * FROM metrics",
        "golden_order_diff": ORDER_DIFF,
        "golden_metric_diff":
            "SELECT metric, expected_value, actual_value "
            "FROM expected_metrics LEFT JOIN metrics USING (metric) "
            "WHERE actual_value IS DISTINCT FROM expected_value",
        **{f"check_{name}": _checks(name) for name in CHECKS},
        "quality_report": _checks(*CHECKS),
        "catalog_round_trip": "SELECT * FROM fct",
        "reload_records_merchants":
            "SELECT merchant_id, concat(merchant_name, chr(10), '\"', merchant_id, '\",', chr(10), chr(10)) "
            "AS merchant_name, '0.1' AS fee_rate FROM raw_merchants",
        "reload_parquet_payments": "SELECT * FROM stg_payments",
        "reload_namespace_orders": "SELECT * FROM stg_orders",
        "reload_golden_orders": "SELECT * FROM expected",
        "snapshot_settlements": "SELECT * FROM stg_settlements",
        "csv_good_lines": """
            SELECT concat('M', c_custkey) AS merchant_id, concat(c_name, ', "x"') AS merchant_name,
                   '0.03' AS fee_rate
            FROM customer WHERE c_custkey % 7 NOT IN (1, 2, 3)""",
        "csv_bad_lines": """
            SELECT concat('M', c_custkey, ',', c_name) AS bad_line
            FROM customer WHERE c_custkey % 7 = 1
            UNION ALL SELECT concat('M', c_custkey, ',', c_name, ',1,000')
            FROM customer WHERE c_custkey % 7 = 2
            UNION ALL SELECT unnest([concat('M', c_custkey, ',half'), concat('B', c_custkey, ',0.1')])
            FROM customer WHERE c_custkey % 7 = 3""",
    }
    messy = {
        "clean_text_status":
            "SELECT payment_id, order_id, payment_status, settlement_batch_id FROM stg_payments",
        "safe_casts":
            "SELECT order_id, order_amount, ordered_at FROM stg_orders",
        "safe_rates": "SELECT merchant_id, merchant_name, fee_rate FROM stg_merchants",
        "messy_fct_payment_reconciliation": "SELECT * FROM fct",
        "messy_fct_reconciliation_errors": "SELECT * FROM errors",
        "messy_error_type_summary": SUMMARY,
        "messy_metric_distribution": "SELECT * FROM metrics",
        "messy_quality_report": _checks(*CHECKS),
        "messy_duplicate_orders":
            "SELECT order_id, count(*) AS n_records FROM fct WHERE order_id IS NOT NULL "
            "GROUP BY 1 HAVING count(*) > 1",
        "messy_unexpected_statuses":
            "SELECT payment_status, count(*) AS n_records FROM stg_payments "
            "WHERE payment_status NOT IN ('SUCCESS', 'FAILED') GROUP BY 1",
        "messy_orphan_payments":
            "SELECT order_id, count(*) AS n_records FROM stg_payments p "
            "WHERE order_id IS NOT NULL "
            "AND NOT EXISTS (SELECT 1 FROM stg_orders o WHERE o.order_id = p.order_id) GROUP BY 1",
    }
    return {
        **{name: _with(select) for name, select in selects.items()},
        **{name: _with(select, MESSY_RAW) for name, select in messy.items()},
    }
