"""The registered queries in DuckDB SQL over the same tables."""

from __future__ import annotations

from paylake.plans.bindings import CONTEXT, ZIP
from paylake.plans.stages import GOLD_COMMENT
from paylake.schema import GOLD_COLUMNS, SILVER_FROM_RAW, raw_schema

_P0 = """
p0 AS (
  SELECT o_orderkey,
    CASE WHEN o_orderkey % 23 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS Record_ID,
    'Covered Recipient Physician' AS Covered_Recipient_Type,
    CAST(o_custkey AS VARCHAR) AS recipient_npi,
    'first_' || CAST(o_custkey % 97 AS VARCHAR) AS recipient_first_name,
    'last_' || CAST(o_custkey % 89 AS VARCHAR) AS recipient_last_name,
    CASE WHEN o_custkey % 41 <> 0 THEN o_orderstatus END AS recipient_state,
    'city_' || CAST(o_custkey % 50 AS VARCHAR) AS recipient_city,
    CASE WHEN o_custkey % 11 <> 0
         THEN 'specialty_' || CAST(o_custkey % 7 AS VARCHAR) END AS physician_specialty,
    'payer_' || CAST(o_custkey % 13 AS VARCHAR) AS payer_name,
    CASE WHEN o_orderkey % 19 = 0 THEN NULL
         WHEN o_orderkey % 31 = 0 THEN CAST('NaN' AS DOUBLE)
         WHEN o_orderkey % 37 = 0 THEN CAST(1e30 AS DOUBLE)
         ELSE o_totalprice END AS payment_amount_usd,
    CASE WHEN o_orderkey % 17 = 0 THEN '02/30/1997'
         WHEN o_orderkey % 29 = 0 THEN strftime(o_orderdate, '%-m/%-d/%Y')
         WHEN o_orderkey % 211 = 0 THEN '01/05/23'
         ELSE strftime(o_orderdate, '%m/%d/%Y') END AS payment_date_str,
    CASE WHEN o_custkey % 2 = 0 THEN 'Cash or cash equivalent'
         ELSE 'In-kind items and services' END AS payment_form,
    o_orderpriority AS payment_nature,
    CAST(year(o_orderdate) AS VARCHAR) AS program_year
  FROM orders
)"""

_PASS_THROUGH = ", ".join(GOLD_COLUMNS[:-2])
_DATE = "CAST(try_strptime(payment_date_str, '%m/%d/%Y') AS DATE)"
_AMOUNT = "TRY_CAST(payment_amount_usd AS DECIMAL(38,9))"

_LAYERS = f"""WITH {_P0.strip()},
silver AS (SELECT {", ".join(SILVER_FROM_RAW)} FROM p0 WHERE Record_ID IS NOT NULL),
gold AS (
  SELECT {_PASS_THROUGH}, {_DATE} AS payment_date, {_AMOUNT} AS payment_amount_usd
  FROM silver WHERE {_DATE} IS NOT NULL AND {_AMOUNT} IS NOT NULL
)
"""

_MONTH = "CAST(date_trunc('month', payment_date) AS DATE)"
_IN_RANGE = "payment_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"
_SILVER = _LAYERS + "SELECT * FROM silver"
_GOLD = _LAYERS + "SELECT * FROM gold"
_BY_NATURE = "SELECT payment_nature, count(*) AS record_count FROM gold {} GROUP BY payment_nature"
_BY_MONTH = (
    f"SELECT {_MONTH} AS payment_month, "
    "CAST(sum(payment_amount_usd) AS DECIMAL(38,9)) AS total_amount_usd "
    "FROM gold {} GROUP BY 1"
)
_DOCUMENTS = "SELECT doc_id, text, lang, source, n_chars FROM documents"
_CONTEXT_SQL = CONTEXT.replace("'", "''")


def _raw_columns() -> str:
    """The 91 columns with their types, and in how many records each has a value."""
    own = {src: f"count({name})" for name, src in SILVER_FROM_RAW.items()}
    own["Covered_Recipient_Profile_ID"] = own["Contextual_Information"] = "count(*)"
    own["Recipient_Zip_Code"] = "count(*)"
    own["Number_of_Payments_Included_in_Total_Amount"] = "count_if(o_orderkey % 7 <> 0)"
    rows = [
        f"SELECT {i} AS position, '{f.name}' AS name, '{f.dataType.simpleString()}' AS type, "
        f"(SELECT {own.get(f.name, 'count(NULL)')} FROM p0) AS n_values"
        for i, f in enumerate(raw_schema(), 1)
    ]
    return _LAYERS + " UNION ALL ".join(rows)


def oracle_sql() -> dict[str, str]:
    by_nature, by_nature_1996 = (_LAYERS + _BY_NATURE.format(w) for w in ("", f"WHERE {_IN_RANGE}"))
    by_month, by_month_1996 = (_LAYERS + _BY_MONTH.format(w) for w in ("", f"WHERE {_IN_RANGE}"))
    by_state = "SELECT recipient_state, count(*) AS record_count FROM gold GROUP BY recipient_state"
    return {
        "csv_multiline_scan": _DOCUMENTS,
        "csv_line_scan": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,"
        " CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority FROM orders",
        "csv_bad_values": f"""
            SELECT CAST(o_orderkey AS VARCHAR) AS profile_id,
                   CASE WHEN o_orderkey % 19 = 0 THEN NULL
                        WHEN o_orderkey % 31 = 0 THEN CAST('NaN' AS DOUBLE)
                        WHEN o_orderkey % 37 = 0 THEN CAST(1e30 AS DOUBLE)
                        ELSE o_totalprice END AS amount,
                   CAST(CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 5 END AS INTEGER)
                     AS n_payments,
                   '{_CONTEXT_SQL}' AS context,
                   '{ZIP}' AS zip_code
            FROM orders""",
        "silver_transform": _SILVER,
        "silver_from_csv": _SILVER,
        "silver_from_layouts": _SILVER,
        "silver_overwrite_roundtrip": _SILVER,
        "parquet_glob_stage": _SILVER,
        "parquet_register_stage": _SILVER,
        "safe_parse_date": _LAYERS
        + f"SELECT payment_date_str, {_DATE} AS payment_date FROM p0",
        "safe_cast_numeric": _LAYERS
        + f"SELECT Record_ID, recipient_npi, {_AMOUNT} AS payment_amount_usd FROM p0",
        "gold_transform": _GOLD,
        "gold_replace_idempotent": _GOLD,
        "gold_partitioned_table": _GOLD,
        "gold_from_csv": _GOLD,
        "gold_years": _LAYERS + "SELECT *, CAST(program_year AS INTEGER) AS year FROM gold",
        "gold_lookup": _GOLD + " WHERE recipient_npi = '7'",
        "parquet_merged": _LAYERS
        + """SELECT * REPLACE (
                CAST(recipient_npi AS DECIMAL(20,0)) AS recipient_npi,
                CASE WHEN CAST(Record_ID AS BIGINT) % 3 <> 0 THEN payment_form END AS payment_form)
             FROM silver""",
        "gold_published": _GOLD,
        "gold_versions": _LAYERS
        + f"""SELECT 1 AS version, false AS shown, count(*) AS record_count
              FROM gold WHERE {_IN_RANGE}
              UNION ALL SELECT 2, true, count(*) FROM gold""",
        "raw_count": "SELECT count(*) AS record_count FROM orders",
        "gold_count": _LAYERS + "SELECT count(*) AS record_count FROM gold",
        "layer_counts": _LAYERS
        + """SELECT 'raw' AS layer, count(*) AS record_count FROM p0
             UNION ALL SELECT 'silver', count(*) FROM silver
             UNION ALL SELECT 'gold', count(*) FROM gold""",
        "count_by_nature": by_nature,
        "count_by_state": _LAYERS + by_state,
        "monthly_total": by_month,
        "monthly_total_lineitem": """
            SELECT CAST(date_trunc('month', l_shipdate) AS DATE) AS payment_month,
                   CAST(sum(TRY_CAST(l_extendedprice AS DECIMAL(38,9))) AS DECIMAL(38,9))
                     AS total_amount_usd
            FROM lineitem GROUP BY 1""",
        "count_by_status_lineitem": """
            SELECT l_linestatus, count(*) AS record_count FROM lineitem GROUP BY l_linestatus""",
        "date_range_filter": _LAYERS + f"SELECT * FROM gold WHERE {_IN_RANGE}",
        "count_by_nature_in_range": by_nature_1996,
        "monthly_total_in_range": by_month_1996,
        "state_filter": _LAYERS + "SELECT * FROM gold WHERE recipient_state = 'F'",
        "stored_count_by_nature": by_nature,
        "stored_count_by_state": _LAYERS + by_state,
        "stored_monthly_total": by_month,
        "stored_count_by_nature_in_range": by_nature_1996,
        "stored_monthly_total_in_range": by_month_1996,
        "stored_state_filter": _LAYERS + "SELECT * FROM gold WHERE recipient_state = 'F'",
        "gold_summary": _LAYERS
        + """SELECT recipient_state, payment_nature, count(*) AS record_count,
                    CAST(sum(payment_amount_usd) AS DECIMAL(38,9)) AS total_amount_usd, payment_date
             FROM gold GROUP BY payment_date, recipient_state, payment_nature""",
        "summary_count": _LAYERS + "SELECT count(*) AS record_count FROM gold",
        "summary_count_by_nature": by_nature,
        "summary_count_by_state_in_range": _LAYERS
        + f"""SELECT recipient_state, count(*) AS record_count FROM gold WHERE {_IN_RANGE}
              GROUP BY recipient_state""",
        "summary_monthly_total": by_month,
        "summary_monthly_total_of_state": _LAYERS
        + _BY_MONTH.format("WHERE recipient_state = 'F'"),
        "preview_raw": _LAYERS
        + f"""SELECT CAST(o_orderkey AS VARCHAR) AS Covered_Recipient_Profile_ID,
                     CASE WHEN o_orderkey % 23 <> 0 THEN CAST(o_orderkey AS VARCHAR) END
                       AS Record_ID,
                     '{_CONTEXT_SQL}' AS Contextual_Information,
                     '{ZIP}' AS Recipient_Zip_Code,
                     CAST(year(o_orderdate) AS VARCHAR) AS Program_Year
              FROM orders ORDER BY o_orderkey LIMIT 5""",
        "run_log": _LAYERS
        + f""", n AS (
                SELECT (SELECT count(*) FROM p0) AS raw,
                  (SELECT count(*) FROM p0 WHERE Record_ID IS NULL) AS refused,
                  (SELECT count(*) FROM silver) AS silver,
                  (SELECT count(*) FROM silver WHERE {_DATE} IS NULL OR {_AMOUNT} IS NULL)
                    AS rejected,
                  (SELECT count(*) FROM gold) AS gold
              ), stages(run, run_status, stage, stage_status) AS (
                VALUES (1, 'failed', 'silver', 'done'), (1, 'failed', 'quality', 'failed'),
                  (2, 'done', 'silver', 'skipped'), (2, 'done', 'quality', 'done'),
                  (2, 'done', 'staging', 'done'), (2, 'done', 'gold', 'done'),
                  (3, 'done', 'silver', 'skipped'), (3, 'done', 'quality', 'done'),
                  (3, 'done', 'staging', 'done'), (3, 'done', 'gold', 'skipped')
              )
              SELECT run, run_status, stage, stage_status,
                CASE WHEN stage = 'silver' THEN n.raw END AS raw,
                CASE WHEN stage = 'silver' THEN n.refused END AS refused,
                CASE WHEN stage = 'silver' THEN n.silver END AS silver,
                CASE WHEN stage = 'silver' THEN n.rejected END AS rejected,
                CASE WHEN stage = 'gold' THEN n.gold END AS gold
              FROM stages, n""",
        "quarantined_records": _LAYERS
        + f"""SELECT {", ".join(SILVER_FROM_RAW)},
                CASE WHEN Record_ID IS NULL THEN 'silver' ELSE 'gold' END AS refused_by,
                concat_ws(',', CASE WHEN Record_ID IS NULL THEN 'missing_key' END,
                  CASE WHEN payment_amount_usd IS NULL AND o_orderkey % 2 = 0
                       THEN 'bad_value:Total_Amount_of_Payment_USDollars' END,
                  CASE WHEN o_orderkey % 7 = 0
                       THEN 'bad_value:Number_of_Payments_Included_in_Total_Amount' END,
                  CASE WHEN {_DATE} IS NULL THEN 'bad_date' END,
                  CASE WHEN {_AMOUNT} IS NULL THEN 'bad_amount' END) AS faults
              FROM p0 WHERE Record_ID IS NULL OR {_DATE} IS NULL OR {_AMOUNT} IS NULL""",
        "quarantine_balance": _LAYERS
        + f"""SELECT (SELECT count(*) FROM p0) AS raw,
                     (SELECT count(*) FROM silver) AS silver,
                     (SELECT count(*) FROM gold) AS gold,
                     (SELECT count(*) FROM p0 WHERE Record_ID IS NULL) AS refused_by_silver,
                     (SELECT count(*) FROM silver WHERE {_DATE} IS NULL OR {_AMOUNT} IS NULL)
                       AS refused_by_gold,
                     0::BIGINT AS raw_left, 0::BIGINT AS silver_left""",
        "raw_columns": _raw_columns(),
        "gold_comment": _LAYERS
        + f"""SELECT '{GOLD_COMMENT}' AS table_comment, count(*) AS record_count FROM gold""",
        "gold_replace_fewer_days": _GOLD + f" WHERE {_IN_RANGE}",
        "layer_balance": _LAYERS
        + f"""SELECT (SELECT count(*) FROM p0) AS raw,
                     (SELECT count(*) FROM p0 WHERE Record_ID IS NULL) AS missing_key,
                     (SELECT count(*) FROM silver) AS silver,
                     (SELECT count(*) FROM silver WHERE {_DATE} IS NULL OR {_AMOUNT} IS NULL)
                       AS rejected,
                     (SELECT count(*) FROM gold) AS gold""",
        "preview_rows": _LAYERS
        + """SELECT * FROM gold ORDER BY CAST(Record_ID AS BIGINT) LIMIT 5""",
        "dq_metrics": _LAYERS
        + f"""SELECT count(*) AS row_count,
                     count(*) FILTER (WHERE Record_ID IS NULL) AS missing_key,
                     count(*) FILTER (WHERE {_DATE} IS NULL) AS bad_date,
                     count(*) FILTER (WHERE {_AMOUNT} IS NULL) AS bad_amount
              FROM p0""",
        "duplicate_keys": """SELECT l_orderkey, count(*) AS row_count FROM lineitem
              WHERE l_orderkey IS NOT NULL GROUP BY l_orderkey HAVING count(*) > 1""",
        "key_uniqueness": _LAYERS
        + """, twice AS (
                SELECT 'silver' AS rows_of, Record_ID FROM silver
                UNION ALL SELECT 'delivered_twice', Record_ID FROM silver
                UNION ALL SELECT 'delivered_twice', Record_ID FROM silver
                  WHERE payment_date_str LIKE '%1995'),
              by_key AS (SELECT rows_of, Record_ID, count(*) AS n FROM twice GROUP BY ALL)
              SELECT rows_of, count(*) FILTER (WHERE n > 1) AS double_keys,
                     CAST(sum(n - 1) AS BIGINT) AS surplus_rows,
                     coalesce(max(n) FILTER (WHERE n > 1), 0) AS most_rows
              FROM by_key GROUP BY rows_of""",
        "dq_metrics_gold": _LAYERS
        + """SELECT count(*) AS row_count,
                    count(*) FILTER (WHERE Record_ID IS NULL) AS missing_key,
                    count(*) FILTER (WHERE payment_date IS NULL) AS bad_date,
                    count(*) FILTER (WHERE payment_amount_usd IS NULL) AS bad_amount
             FROM gold""",
    }
