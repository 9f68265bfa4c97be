"""DuckDB SQL that answers the registered queries over the same tables."""

from __future__ import annotations

# Sales with defects, already typed: what safe casts make of the raw text.
SALES = """
base AS (
  SELECT l.*, o.o_custkey, strftime(o.o_orderdate, '%Y-%m') AS batch,
         (l_orderkey * 7 + l_linenumber * 13 + l_partkey) % 100 AS b,
         CAST(l_quantity AS INTEGER) AS q,
         floor(l_extendedprice * 100 / l_quantity) / 100 AS price
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
),
sales AS (
  SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS order_id,
         CASE WHEN b BETWEEN 0 AND 3 THEN '' WHEN b BETWEEN 17 AND 18 THEN '-1'
              ELSE CAST(o_custkey AS VARCHAR) END AS customer_id,
         CASE WHEN b BETWEEN 14 AND 16 THEN '-1' ELSE CAST(l_partkey AS VARCHAR) END AS product_id,
         CASE WHEN b BETWEEN 8 AND 10 THEN -q ELSE q END AS quantity_int,
         price AS unit_price_dbl,
         CASE WHEN b BETWEEN 4 AND 7 THEN NULL
              WHEN b BETWEEN 8 AND 10 THEN -(l_quantity * price)
              WHEN b BETWEEN 19 AND 21 THEN l_quantity * price * 1.5
              ELSE l_quantity * price END AS order_amount_dbl,
         CASE WHEN b BETWEEN 11 AND 13 THEN NULL ELSE CAST(l_shipdate AS DATE) END AS order_date_parsed,
         CASE WHEN b BETWEEN 11 AND 13 THEN '2025-13-40'
              ELSE strftime(l_shipdate, '%Y-%m-%d') END AS order_date_text,
         batch, l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
         l_returnflag, l_linestatus
  FROM base
)"""

ARRIVAL = """l_shipdate, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount,
           l_tax, l_returnflag, l_linestatus"""

PREPARED = SALES + f""",
prepared AS (
  SELECT s.*, row_number() OVER (PARTITION BY order_id ORDER BY {ARRIVAL}) AS copy_rank,
         p.key IS NOT NULL AS product_exists, c.key IS NOT NULL AS customer_exists
  FROM sales s
  LEFT JOIN (SELECT DISTINCT CAST(p_partkey AS VARCHAR) AS key FROM part) p ON p.key = s.product_id
  LEFT JOIN (SELECT DISTINCT CAST(c_custkey AS VARCHAR) AS key FROM customer) c
         ON c.key = s.customer_id
)"""


def judged(source: str, name: str = "judged") -> str:
    """The eight checks over prepared rows."""
    return f"""
{name}_checks AS (
  SELECT *,
    coalesce(trim(customer_id) <> '', FALSE) AS completeness_customer_id,
    order_amount_dbl IS NOT NULL AS completeness_order_amount,
    coalesce(quantity_int > 0, FALSE) AS validity_quantity_positive,
    order_date_parsed IS NOT NULL AS validity_order_date,
    copy_rank = 1 AS uniqueness_order_id,
    product_exists AS integrity_product_id,
    customer_exists AS integrity_customer_id,
    coalesce(abs(order_amount_dbl - quantity_int * unit_price_dbl) <= 0.01, FALSE)
      AS accuracy_amount_matches
  FROM {source}
),
{name} AS (
  SELECT *,
    concat_ws('; ',
      CASE WHEN NOT completeness_customer_id THEN 'completeness_customer_id' END,
      CASE WHEN NOT completeness_order_amount THEN 'completeness_order_amount' END,
      CASE WHEN NOT validity_quantity_positive THEN 'validity_quantity_positive' END,
      CASE WHEN NOT validity_order_date THEN 'validity_order_date' END,
      CASE WHEN NOT uniqueness_order_id THEN 'uniqueness_order_id' END,
      CASE WHEN NOT integrity_product_id THEN 'integrity_product_id' END,
      CASE WHEN NOT integrity_customer_id THEN 'integrity_customer_id' END) AS reason,
    CASE WHEN NOT accuracy_amount_matches THEN 'accuracy_amount_matches' ELSE '' END AS warnings,
    completeness_customer_id AND completeness_order_amount AND validity_quantity_positive
      AND validity_order_date AND uniqueness_order_id AND integrity_product_id
      AND integrity_customer_id AS passed
  FROM {name}_checks
)"""


JUDGED = PREPARED + "," + judged("prepared")

# Check name, dimension, severity.
CHECKS = [
    ("completeness_customer_id", "completeness", "error"),
    ("completeness_order_amount", "completeness", "error"),
    ("validity_quantity_positive", "validity", "error"),
    ("validity_order_date", "validity", "error"),
    ("uniqueness_order_id", "uniqueness", "error"),
    ("integrity_product_id", "integrity", "error"),
    ("integrity_customer_id", "integrity", "error"),
    ("accuracy_amount_matches", "accuracy", "warn"),
]


def _metric_rows(by: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT {by} AS run_id, '{name}' AS rule_name, '{dimension}' AS dimension,
        '{severity}' AS severity, count(*) AS rows_evaluated,
        count(*) FILTER (WHERE {name}) AS rows_passed FROM judged GROUP BY {by}"""
        for name, dimension, severity in CHECKS
    )


def metrics(by: str) -> str:
    return f"""
counted AS ({_metric_rows(by)}),
metrics AS (
  SELECT run_id, 'orders' AS dataset, rule_name, dimension, severity, rows_evaluated, rows_passed,
         rows_evaluated - rows_passed AS rows_failed,
         round(rows_passed / rows_evaluated, 6) AS pass_rate
  FROM counted
)"""


def _suggested() -> str:
    """What holds for every row, found without sketches."""
    numbers = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_discount")
    discrete = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus")
    every = [*numbers, "l_returnflag", "l_linestatus"]
    keys = {"orders": "o_orderkey", "part": "p_partkey", "supplier": "s_suppkey", "customer": "c_custkey"}
    parts = []
    for source, columns in (("lineitem", every), ("orders", ["o_orderkey"])):
        for c in columns:
            head = f"SELECT '{source}' AS table_name, '{c}' AS column_name"
            parts.append(f"{head}, 'not_null' AS rule, NULL AS detail FROM {source} HAVING count(*) = count({c}) AND count(*) > 0")
            parts.append(f"{head}, 'key', NULL FROM {source} HAVING count(DISTINCT {c}) = count(*) AND count(*) > 0")
            if c in numbers or source == "orders":
                parts.append(f"{head}, CASE WHEN min({c}) > 0 THEN 'positive' ELSE 'not_negative' END, NULL FROM {source} HAVING min({c}) >= 0")
            if c in discrete or source == "orders":
                parts.append(
                    f"{head}, 'one_of', string_agg(v, '|' ORDER BY v) FROM (SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM {source})"
                    " HAVING count(*) BETWEEN 1 AND 20"
                )
    for c in discrete[:4]:
        for name, key in keys.items():
            parts.append(
                f"SELECT 'lineitem', '{c}', 'references', '{name}' FROM lineitem"
                f" HAVING count(*) FILTER (WHERE {c} NOT IN (SELECT {key} FROM {name})) = 0"
            )
    return " UNION ALL ".join(parts)


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


HISTORY = JUDGED + "," + metrics("batch") + """,
history AS (
  SELECT *, run_id || '-01' AS measured_at FROM metrics
),
newest AS (SELECT max(run_id) AS run_id FROM history),
recent AS (
  SELECT *, row_number() OVER (PARTITION BY rule_name ORDER BY measured_at DESC, run_id DESC) AS recency
  FROM history
)"""

CUSTOMERS = """
spelled AS (
  SELECT CAST(c_custkey AS VARCHAR) AS customer_id, c_name AS name, c_mktsegment AS company,
         ['PL', 'NL', 'DE', 'GB', 'FR', 'ES', 'IT'][c_nationkey % 7 + 1] AS code,
         c_custkey % 12 = 0 AS noisy, c_custkey // 12 AS pick
  FROM customer
),
noisy AS (
  SELECT customer_id, name, company,
         CASE WHEN NOT noisy THEN code
              WHEN code = 'PL' THEN ['Poland', 'pl', 'POL'][pick % 3 + 1]
              WHEN code = 'NL' THEN ['Netherlands', 'nl'][pick % 2 + 1]
              WHEN code = 'DE' THEN ['Germany', 'de'][pick % 2 + 1]
              ELSE code END AS country
  FROM spelled
),
conformed AS (
  SELECT customer_id, name, company,
         CASE lower(trim(country)) WHEN 'poland' THEN 'PL' WHEN 'pl' THEN 'PL' WHEN 'pol' THEN 'PL'
              WHEN 'netherlands' THEN 'NL' WHEN 'nl' THEN 'NL' WHEN 'germany' THEN 'DE'
              WHEN 'de' THEN 'DE' ELSE upper(country) END AS country
  FROM noisy
)"""

DAY = "year({0}) * 10000 + month({0}) * 100 + day({0})"
TEXT_TIME = "'%Y-%m-%d %H:%M:%S'"


def _rule(name: str) -> str:
    return _with(
        JUDGED,
        f"""SELECT order_id, customer_id, product_id, CAST(quantity_int AS VARCHAR) AS quantity,
        order_date_text AS order_date FROM judged WHERE NOT {name}""",
    )


# Columns of lineitem: n for numbers, t for times.
LINE_COLUMNS = [
    ("l_orderkey", "n"), ("l_partkey", "n"), ("l_suppkey", "n"), ("l_linenumber", "n"), ("l_quantity", "n"),
    ("l_extendedprice", "n"), ("l_discount", "n"), ("l_tax", "n"), ("l_returnflag", ""),
    ("l_linestatus", ""), ("l_shipdate", "t"),
]


def _profiled(name: str, kind: str, source: str, more: str = "") -> str:
    ends = {
        "n": (f"CAST(min({name}) AS DOUBLE)", f"CAST(max({name}) AS DOUBLE)"),
        "t": (f"epoch(CAST(min({name}) AS TIMESTAMP))", f"epoch(CAST(max({name}) AS TIMESTAMP))"),
        "": ("NULL::DOUBLE", "NULL::DOUBLE"),
    }[kind]
    sign = f"CASE WHEN min({name}) > 0 THEN 'positive' WHEN min({name}) = 0 THEN 'not_negative' END"
    return f"""SELECT '{name}' AS column_name, count(*) AS rows, count(*) - count({name}) AS nulls,
        round((count(*) - count({name})) / count(*), 6) AS null_rate, {more}
        CAST({ends[0]} AS DOUBLE) AS min_value, CAST({ends[1]} AS DOUBLE) AS max_value,
        concat_ws(',', CASE WHEN count(*) = count({name}) THEN 'not_null' END,
          {sign if kind == "n" else "NULL"}) AS suggested
        FROM {source}"""


def _volume(rows: str, name: str, low: float, high: float) -> str:
    """Daily volume of (source, ts) rows with every day of each source."""
    return f"""
        WITH arrived AS ({rows}),
        daily AS (SELECT source, CAST(ts AS DATE) AS day, count(*) AS n FROM arrived GROUP BY ALL),
        days AS (SELECT source, CAST(unnest(generate_series(CAST(first AS TIMESTAMP), CAST(last AS TIMESTAMP),
                   INTERVAL 1 DAY)) AS DATE) AS day
          FROM (SELECT source, min(day) AS first FROM daily GROUP BY source),
               (SELECT max(day) AS last FROM daily)),
        filled AS (SELECT source, day, coalesce(n, 0) AS rows FROM days LEFT JOIN daily USING (source, day)),
        averaged AS (SELECT *, avg(rows) OVER (PARTITION BY source ORDER BY day
          ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS trailing_mean FROM filled)
        SELECT source AS {name}, day, rows, trailing_mean,
        CASE WHEN rows < trailing_mean * {low} THEN 'low' WHEN rows > trailing_mean * {high} THEN 'high'
        ELSE 'ok' END AS status FROM averaged"""


def statements() -> dict[str, str]:
    day = DAY.format("order_date_parsed")
    parties = """SELECT c_custkey AS party_id, c_name AS name, c_nationkey AS nation FROM customer"""
    sql = {
        "gate_metrics": _with(
            JUDGED + "," + metrics("'run-1'"),
            "SELECT run_id, dataset, rule_name, dimension, severity, rows_evaluated, rows_passed,"
            " rows_failed, pass_rate FROM metrics",
        ),
        "unpivot_metrics": _with(
            JUDGED + "," + metrics("'run-1'"),
            "SELECT rule_name, dimension, severity, rows_evaluated, rows_passed FROM metrics",
        ),
        "gate_evaluate": _with(
            JUDGED,
            "SELECT order_id, product_id, " + ", ".join(c[0] for c in CHECKS)
            + ", reason AS failed_rules, warnings, passed FROM judged",
        ),
        "failed_rule_array": _with(
            JUDGED,
            """SELECT order_id, reason AS failed_rules,
            CAST(CASE WHEN reason = '' THEN 0 ELSE len(string_split(reason, '; ')) END AS INTEGER) AS failed,
            CAST(CASE WHEN warnings = '' THEN 0 ELSE 1 END AS INTEGER) AS warned FROM judged""",
        ),
        "gate_clean": _with(
            JUDGED,
            """SELECT order_id, customer_id, product_id, order_date_text AS order_date, warnings
            FROM judged WHERE passed""",
        ),
        "gate_quarantine": _with(
            JUDGED, "SELECT order_id, customer_id, product_id, reason FROM judged WHERE NOT passed"
        ),
        "silver_orders": _with(
            JUDGED,
            """SELECT order_id, customer_id, product_id, quantity_int AS quantity,
            unit_price_dbl AS unit_price, order_amount_dbl AS order_amount,
            order_date_parsed AS order_date, warnings AS dq_warnings FROM judged WHERE passed""",
        ),
        "write_guard": _with(
            JUDGED,
            """SELECT order_id, customer_id, product_id, quantity_int AS quantity,
            order_amount_dbl AS order_amount, order_date_parsed AS order_date
            FROM judged WHERE passed""",
        ),
        "guard_stops_writes": _with(
            JUDGED,
            " UNION ALL ".join(
                f"""SELECT '{name}' AS guard, count(*) FILTER (WHERE NOT coalesce({holds}, false)) AS rows_broken,
                count(*) FILTER (WHERE NOT coalesce({holds}, false)) > 0 AS stopped,
                count(*) FILTER (WHERE passed) AS rows_published FROM judged"""
                for name, holds in (
                    ("customer_id_filled", "trim(customer_id) <> ''"),
                    ("order_amount_filled", "order_amount_dbl IS NOT NULL"),
                    ("order_date_filled", "order_date_parsed IS NOT NULL"),
                    ("quantity_positive", "quantity_int > 0"),
                )
            ),
        ),
        "quarantine_rows": _with(
            JUDGED,
            f"""SELECT order_id, customer_id, product_id, CAST(quantity_int AS VARCHAR) AS quantity,
            unit_price_dbl AS unit_price, order_amount_dbl AS order_amount,
            order_date_text AS order_date, 'lineitem' AS _source_file,
            strftime(l_shipdate, {TEXT_TIME}) AS _ingested_at, reason AS failed_rules, reason,
            'run-1' AS run_id FROM judged WHERE NOT passed""",
        ),
        "strip_scratch": _with(
            PREPARED,
            """SELECT order_id, customer_id, product_id, order_date_text AS order_date, quantity_int,
            copy_rank > 1 AS is_repeat FROM prepared""",
        ),
        "typed_orders": _with(
            SALES,
            """SELECT order_id, quantity_int, unit_price_dbl, order_amount_dbl, order_date_parsed
            FROM sales""",
        ),
        "prepared_orders": _with(
            PREPARED,
            """SELECT order_id, quantity_int, unit_price_dbl, order_amount_dbl, order_date_parsed,
            copy_rank > 1 AS is_repeat, product_exists, customer_exists FROM prepared""",
        ),
        "dedup_rank": _with(
            PREPARED,
            "SELECT order_id, product_id, copy_rank, copy_rank > 1 AS is_repeat FROM prepared",
        ),
        "fk_product_exists": _with(
            PREPARED, "SELECT order_id, product_id, product_exists FROM prepared"
        ),
        "fk_customer_exists": _with(
            PREPARED, "SELECT order_id, customer_id, customer_exists FROM prepared"
        ),
        "orphans_anti_join": _with(
            PREPARED, "SELECT order_id, customer_id FROM prepared WHERE NOT customer_exists"
        ),
        "inject_defects": _with(
            SALES,
            """SELECT order_id, customer_id, product_id, CAST(quantity_int AS VARCHAR) AS quantity,
            unit_price_dbl AS unit_price, order_amount_dbl AS order_amount,
            order_date_text AS order_date FROM sales""",
        ),
        "conform_country": _with(CUSTOMERS, "SELECT * FROM conformed"),
        "dim_customer": _with(CUSTOMERS, "SELECT * FROM conformed"),
        "dim_product": """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS product_name,
            p_type AS category, p_retailprice AS unit_price FROM part""",
        "date_dim": _with(
            JUDGED,
            f"""SELECT DISTINCT CAST({day} AS INTEGER) AS date_key, order_date_parsed AS date,
            CAST(year(order_date_parsed) AS INTEGER) AS year,
            CAST(month(order_date_parsed) AS INTEGER) AS month,
            CAST(day(order_date_parsed) AS INTEGER) AS day FROM judged WHERE passed""",
        ),
        "fact_sales": _with(
            JUDGED,
            f"""SELECT order_id, customer_id, product_id, CAST({day} AS INTEGER) AS date_key,
            quantity_int AS quantity, unit_price_dbl AS unit_price, order_amount_dbl AS order_amount
            FROM judged WHERE passed""",
        ),
        "revenue_by_country": _with(
            JUDGED + "," + CUSTOMERS,
            """SELECT country,
            CAST(round(sum(CAST(CAST(order_amount_dbl AS VARCHAR) AS DECIMAL(38,20))), 2) AS DOUBLE) AS revenue,
            count(DISTINCT order_id) AS orders
            FROM judged JOIN conformed USING (customer_id) WHERE passed GROUP BY country""",
        ),
        "revenue_by_category": _with(
            JUDGED,
            """SELECT p_type AS category,
            CAST(round(sum(CAST(CAST(order_amount_dbl AS VARCHAR) AS DECIMAL(38,20))), 2) AS DOUBLE) AS revenue,
            CAST(sum(quantity_int) AS BIGINT) AS units
            FROM judged JOIN part ON CAST(p_partkey AS VARCHAR) = product_id
            WHERE passed GROUP BY p_type""",
        ),
        "quarantine_by_rule": _with(
            JUDGED,
            """SELECT rule, count(*) AS rows FROM (
              SELECT unnest(string_split(reason, '; ')) AS rule FROM judged WHERE NOT passed)
            GROUP BY rule""",
        ),
        "reasons_for_run": _with(
            JUDGED + ", newest AS (SELECT max(batch) AS batch FROM judged)",
            """SELECT reason, count(*) AS rows FROM judged JOIN newest USING (batch)
            WHERE NOT passed GROUP BY reason""",
        ),
        "layer_counts": _with(
            JUDGED,
            """SELECT 'clean' AS layer, count(*) AS rows FROM judged WHERE passed
            UNION ALL SELECT 'quarantine', count(*) FROM judged WHERE NOT passed""",
        ),
        "distinct_keys": _with(SALES, "SELECT DISTINCT customer_id FROM sales"),
        "audit_duplicates": _with(
            JUDGED,
            """SELECT 'bronze' AS layer, count(*) AS rows, count(DISTINCT order_id) AS distinct_keys,
            count(*) - count(DISTINCT order_id) AS surplus_rows FROM judged
            UNION ALL SELECT 'silver', count(*), count(DISTINCT order_id),
            count(*) - count(DISTINCT order_id) FROM judged WHERE passed""",
        ),
        "audit_clean_fraction": _with(
            JUDGED,
            """SELECT count(*) FILTER (WHERE passed) AS clean_rows,
            count(*) FILTER (WHERE NOT passed) AS quarantined_rows,
            count(*) FILTER (WHERE passed) / count(*) AS clean_fraction FROM judged""",
        ),
        "audit_report": _with(
            JUDGED
            + """,
seen AS (
  SELECT count(*) FILTER (WHERE passed) AS clean, count(*) AS total,
         count(*) FILTER (WHERE passed)
           - count(DISTINCT order_id) FILTER (WHERE passed) AS surplus FROM judged
)""",
            """SELECT 'clean_rows' AS audit_check, CAST(clean AS DOUBLE) AS observed,
            1000.0::DOUBLE AS at_least, NULL::DOUBLE AS at_most, clean >= 1000 AS holds FROM seen
            UNION ALL SELECT 'clean_fraction', clean / total, 0.55, 0.95,
            clean / total BETWEEN 0.55 AND 0.95 FROM seen
            UNION ALL SELECT 'duplicate_keys', CAST(surplus AS DOUBLE), NULL, 0.0, surplus <= 0 FROM seen""",
        ),
        "metrics_latest_run": _with(
            HISTORY,
            """SELECT rule_name, dimension, severity, pass_rate, rows_failed, rows_evaluated
            FROM history JOIN newest USING (run_id)""",
        ),
        "kpi_table": _with(
            HISTORY,
            """SELECT rule_name, dimension, severity, rows_evaluated, rows_failed, pass_rate
            FROM history JOIN newest USING (run_id)""",
        ),
        "top_failing_rules": _with(
            HISTORY,
            """SELECT rule_name, dimension, rows_failed FROM history JOIN newest USING (run_id)
            ORDER BY rows_failed DESC, rule_name LIMIT 5""",
        ),
        "pass_rate_trend": _with(
            HISTORY,
            """SELECT rule_name, dimension, severity, run_id, measured_at,
            CAST(recency AS INTEGER) AS recency, pass_rate, rows_failed, rows_evaluated,
            severity = 'error' AND pass_rate < 0.8 AS is_low FROM recent WHERE recency <= 3""",
        ),
        "latest_per_rule": _with(
            HISTORY,
            """SELECT run_id, dataset, rule_name, dimension, severity, rows_evaluated, rows_passed,
            rows_failed, pass_rate, measured_at FROM recent WHERE recency = 1""",
        ),
        "sla_breaches": _with(
            JUDGED + "," + metrics("'run-1'"),
            """SELECT rule_name, dimension, pass_rate,
            format('{} ({}) holds for {:.3f} of the rows, agreed are 0.8', rule_name, dimension, round(pass_rate + 1e-9, 3))
              AS message
            FROM metrics WHERE severity = 'error' AND pass_rate < 0.8""",
        ),
        "worst_hard_rate_trend": _with(
            HISTORY,
            """SELECT measured_at, min(pass_rate) AS worst_hard_rule_pass_rate FROM history
            WHERE severity = 'error' GROUP BY measured_at""",
        ),
        "soft_rule_spikes": _with(
            HISTORY
            + """,
rates AS (
  SELECT *, 1.0::DOUBLE - pass_rate AS failure_rate FROM history WHERE severity <> 'error'
),
averaged AS (
  SELECT *, avg(failure_rate) OVER (PARTITION BY rule_name ORDER BY measured_at
    ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS trailing_mean FROM rates
)""",
            """SELECT rule_name, run_id, rows_failed, rows_evaluated,
            round(failure_rate, 6) AS failure_rate, round(trailing_mean, 6) AS trailing_mean
            FROM averaged WHERE failure_rate > 1.1 * trailing_mean""",
        ),
        "version_diff": _with(
            JUDGED,
            """SELECT order_id, customer_id, product_id, quantity_int AS quantity,
            unit_price_dbl AS unit_price, order_amount_dbl AS order_amount,
            order_date_parsed AS order_date, warnings AS dq_warnings FROM judged
            EXCEPT SELECT order_id, customer_id, product_id, quantity_int, unit_price_dbl,
            order_amount_dbl, order_date_parsed, warnings FROM judged WHERE passed""",
        ),
        "freshness_by_source": f"""SELECT event_type, strftime(max(ts), {TEXT_TIME}) AS last_arrival
            FROM events GROUP BY event_type""",
        "volume_by_source": "SELECT source, count(*) AS rows FROM documents GROUP BY source",
        "period_over_period": """
            WITH totals AS (
              SELECT o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
              CAST(round(sum(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,20))), 2) AS DOUBLE) AS current
              FROM orders GROUP BY ALL),
            calendar AS (SELECT t.*, p.current AS previous FROM totals t LEFT JOIN totals p
              ON p.o_orderpriority = t.o_orderpriority
              AND p.period = CAST(t.period - INTERVAL 1 MONTH AS DATE))
            SELECT *, current - previous AS change FROM calendar""",
        "period_gaps": """
            WITH totals AS (
              SELECT o_custkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS period,
              CAST(round(sum(CAST(CAST(o_totalprice AS VARCHAR) AS DECIMAL(38,20))), 2) AS DOUBLE) AS current
              FROM orders GROUP BY ALL),
            calendar AS (SELECT t.*, p.current AS previous FROM totals t LEFT JOIN totals p
              ON p.o_custkey = t.o_custkey AND p.period = CAST(t.period - INTERVAL 1 MONTH AS DATE))
            SELECT *, current - previous AS change FROM calendar""",
        "volume_outages": _volume(
            "SELECT c_nationkey AS source, o_orderdate AS ts FROM orders JOIN customer ON o_custkey = c_custkey",
            "c_nationkey", 0.5, 10.0),
        "late_sources": f"""
            WITH newest AS (SELECT max(o_orderdate) AS now FROM orders),
            seen AS (SELECT o_custkey, max(o_orderdate) AS last FROM orders GROUP BY o_custkey)
            SELECT o_custkey, strftime(last, {TEXT_TIME}) AS last_arrival,
            strftime(last + INTERVAL 30 DAY, {TEXT_TIME}) AS due, now > last + INTERVAL 30 DAY AS is_late
            FROM seen, newest""",
        "volume_anomaly": _volume("SELECT event_type AS source, ts FROM events", "event_type", 0.9, 1.1),
        "idempotent_append": """SELECT o_orderkey, o_custkey FROM orders
            WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""",
        "profile_columns": " UNION ALL ".join(_profiled(c, kind, "lineitem") for c, kind in LINE_COLUMNS),
        "profile_values": _with(
            SALES,
            " UNION ALL ".join(
                _profiled(c, kind, "sales", f"count(DISTINCT {c}) AS distinct_values,")
                for c, kind in (
                    ("order_id", ""), ("quantity_int", "n"), ("unit_price_dbl", "n"),
                    ("order_amount_dbl", "n"), ("order_date_parsed", "t"),
                )
            ),
        ),
        "scd2_customer": f"""
            WITH seen AS (SELECT o_custkey, o_orderdate, o_orderkey, o_orderpriority,
              lag(o_orderpriority) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS before
              FROM orders),
            changes AS (SELECT * FROM seen WHERE before IS NULL OR before <> o_orderpriority),
            periods AS (SELECT *, lead(o_orderdate)
              OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS until FROM changes)
            SELECT o_custkey, o_orderpriority, strftime(o_orderdate, {TEXT_TIME}) AS valid_from,
            strftime(until, {TEXT_TIME}) AS valid_to, until IS NULL AS is_current FROM periods""",
        "reprocess_quarantine": _with(
            JUDGED
            + f""",
again AS (
  SELECT * EXCLUDE (copy_rank, quantity_int, order_amount_dbl, completeness_customer_id,
      completeness_order_amount, validity_quantity_positive, validity_order_date,
      uniqueness_order_id, integrity_product_id, integrity_customer_id, accuracy_amount_matches,
      reason, warnings, passed),
    abs(quantity_int) AS quantity_int, abs(order_amount_dbl) AS order_amount_dbl,
    row_number() OVER (PARTITION BY order_id ORDER BY {ARRIVAL}) AS copy_rank
  FROM judged
  WHERE NOT passed AND order_id NOT IN (SELECT order_id FROM judged WHERE passed)
),"""
            + judged("again", "rejudged"),
            """SELECT order_id, customer_id, product_id, quantity_int AS quantity,
            order_amount_dbl AS order_amount, order_date_parsed AS order_date, passed, reason
            FROM rejudged""",
        ),
        "src_csv_all_string": _with(
            SALES,
            """SELECT order_id, nullif(customer_id, '') AS customer_id, product_id,
            CAST(quantity_int AS VARCHAR) AS quantity, unit_price_dbl AS unit_price,
            order_amount_dbl AS order_amount, order_date_text AS order_date FROM sales""",
        ),
        "src_json_multiline": """SELECT CAST(p_partkey AS VARCHAR) AS product_id,
            p_name AS product_name, p_type AS category, p_retailprice AS unit_price FROM part""",
        "contract_feed": """
WITH c AS (
  SELECT c_custkey AS k, c_custkey % 3 AS load, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer
),
r AS (
  SELECT *, CASE WHEN load < 2 THEN NULL WHEN k % 5 = 0 THEN 'malformed'
    ELSE nullif(concat_ws('; ', CASE WHEN k % 7 = 0 THEN 'retyped: nation' END,
                                CASE WHEN k % 11 = 0 THEN 'missing: party_id' END), '') END AS reason
  FROM c
)
SELECT 'accepted' AS part, k AS party_id, c_name AS name, c_nationkey AS nation, CASE WHEN load = 1 THEN c_acctbal END AS balance,
       CASE WHEN load = 1 THEN c_mktsegment END AS segment, reason FROM r WHERE reason IS NULL
UNION ALL SELECT 'refused', NULL, NULL, NULL, NULL, NULL, reason FROM r WHERE reason IS NOT NULL""",
        "lineage_columns": """SELECT c_custkey, c_name, '2025-01-01 00:00:00' AS _ingested_at,
            'customer.parquet' AS _source_file FROM customer""",
        "sink_append_merge_schema": f"""{parties.replace(' FROM', ', NULL::DOUBLE AS balance FROM')}
            UNION ALL SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier""",
        "sink_overwrite": """SELECT s_suppkey AS party_id, s_name AS name, s_nationkey AS nation,
            s_acctbal AS balance FROM supplier""",
        "table_as_of": parties,
        "table_restore": parties,
        "medallion_run": _with(
            JUDGED + "," + CUSTOMERS,
            """SELECT 'bronze_orders' AS layer, count(*) AS rows FROM judged
            UNION ALL SELECT 'silver_orders', count(*) FROM judged WHERE passed
            UNION ALL SELECT 'quarantine_orders', count(*) FROM judged WHERE NOT passed
            UNION ALL SELECT 'dq_metrics', 8
            UNION ALL SELECT 'dim_customer', count(*) FROM customer
            UNION ALL SELECT 'dim_product', count(*) FROM part
            UNION ALL SELECT 'dim_date', count(DISTINCT order_date_parsed) FROM judged WHERE passed
            UNION ALL SELECT 'fact_sales', count(*) FROM judged WHERE passed
            UNION ALL SELECT 'revenue_by_country', count(DISTINCT country)
              FROM judged JOIN conformed USING (customer_id) WHERE passed
            UNION ALL SELECT 'revenue_by_category', count(DISTINCT p_type)
              FROM judged JOIN part ON CAST(p_partkey AS VARCHAR) = product_id WHERE passed""",
        ),
        "streaming_gate": _with(
            PREPARED
            + f""",
placed AS (
  SELECT *, CAST(floor((year(l_shipdate) - (SELECT min(year(l_shipdate)) FROM lineitem)) / 2) AS INTEGER)
         + CASE WHEN l_partkey % 20 = 0 THEN 1 ELSE 0 END AS delivered
  FROM prepared
),
clock AS (
  SELECT delivered, max(max(l_shipdate)) OVER (ORDER BY delivered ROWS BETWEEN UNBOUNDED PRECEDING AND 2 PRECEDING)
         - INTERVAL 90 DAYS AS behind
  FROM placed GROUP BY delivered
),
timed AS (
  SELECT placed.* EXCLUDE (copy_rank), coalesce(l_shipdate <= behind, FALSE) AS late
  FROM placed JOIN clock USING (delivered)
),
streamed AS (
  SELECT *, row_number() OVER (PARTITION BY late, order_id ORDER BY delivered, {ARRIVAL}) AS copy_rank FROM timed
),"""
            + judged("streamed"),
            """SELECT order_id, customer_id, product_id, CASE WHEN late THEN 'late' ELSE reason END AS failed_rules,
            passed AND NOT late AS passed FROM judged""",
        ),
    }
    revenue = "CAST(round(sum(CAST(CAST(order_amount_dbl AS VARCHAR) AS DECIMAL(38,20))), 2) AS DOUBLE)"
    sql["medallion_metrics"] = sql["gate_metrics"]
    sql["stopped_run"] = _with(
        JUDGED + "," + metrics("'run-1'"),
        """SELECT 'breach' AS part, rule_name AS name, pass_rate AS value FROM metrics
        WHERE severity = 'error' AND pass_rate < 1
        UNION ALL SELECT 'published', 'silver_orders', 0.0
        UNION ALL SELECT 'dq_metrics', run, CAST((SELECT count(*) FROM metrics) AS DOUBLE)
          FROM (VALUES ('run-1'), ('run-2')) r(run)
        UNION ALL SELECT 'quarantine_orders', run, CAST((SELECT count(*) FROM judged WHERE NOT passed) AS DOUBLE)
          FROM (VALUES ('run-1'), ('run-2')) r(run)
        UNION ALL SELECT 'silver_orders', 'run-1', CAST((SELECT count(*) FROM judged WHERE passed) AS DOUBLE)""",
    )
    sql["audit_published"] = sql["audit_report"]
    sql["suggested_rules"] = _suggested()
    sql["scd2_incremental"] = sql["scd2_customer"]
    sql["sink_by_name"] = sql["sink_append_merge_schema"]
    sql["medallion_values"] = _with(
        JUDGED + "," + CUSTOMERS,
        f"""SELECT 'quarantine' AS part, reason AS name, CAST(count(*) AS DOUBLE) AS value
        FROM judged WHERE NOT passed GROUP BY reason
        UNION ALL SELECT 'country', country, {revenue} FROM judged JOIN conformed USING (customer_id)
          WHERE passed GROUP BY country
        UNION ALL SELECT 'category', p_type, {revenue} FROM judged
          JOIN part ON CAST(p_partkey AS VARCHAR) = product_id WHERE passed GROUP BY p_type
        UNION ALL SELECT 'customer', concat_ws('|', customer_id, name, company, country), 1.0 FROM conformed
        UNION ALL SELECT 'product', concat_ws('|', CAST(p_partkey AS VARCHAR), p_name, p_type), p_retailprice FROM part
        UNION ALL SELECT DISTINCT 'date', strftime(order_date_parsed, '%Y-%m-%d'), CAST({day} AS DOUBLE)
          FROM judged WHERE passed""",
    )
    sql["recovered_tables"] = _with(
        JUDGED + "," + CUSTOMERS + """,
again AS (
  SELECT * EXCLUDE (copy_rank, quantity_int, order_amount_dbl, completeness_customer_id,
      completeness_order_amount, validity_quantity_positive, validity_order_date,
      uniqueness_order_id, integrity_product_id, integrity_customer_id, accuracy_amount_matches,
      reason, warnings, passed),
    reason AS first_reason, abs(quantity_int) AS quantity_int, abs(order_amount_dbl) AS order_amount_dbl,
    row_number() OVER (PARTITION BY order_id ORDER BY order_date_text, nullif(customer_id, '') NULLS FIRST, product_id,
      CAST(abs(quantity_int) AS VARCHAR)) AS copy_rank
  FROM judged
  WHERE NOT passed AND order_id NOT IN (SELECT order_id FROM judged WHERE passed)
),""" + judged("again", "rejudged") + """,
silver AS (
  SELECT order_id, customer_id, product_id, quantity_int, order_amount_dbl, order_date_parsed FROM judged WHERE passed
  UNION ALL SELECT order_id, customer_id, product_id, quantity_int, order_amount_dbl, order_date_parsed FROM rejudged WHERE passed
),
remaining AS (
  SELECT reason, count(*) AS n FROM judged WHERE NOT passed GROUP BY reason
  UNION ALL SELECT first_reason, -count(*) FROM rejudged WHERE passed GROUP BY first_reason
)""",
        f"""SELECT 'silver' AS part, concat_ws('|', order_id, customer_id, product_id, quantity_int) AS name, order_amount_dbl AS value FROM silver
        UNION ALL SELECT 'fact', strftime(order_date_parsed, '%Y%m%d'), CAST(count(*) AS DOUBLE) FROM silver GROUP BY order_date_parsed
        UNION ALL SELECT DISTINCT 'date', strftime(order_date_parsed, '%Y-%m-%d'), 1.0 FROM silver
        UNION ALL SELECT 'country', country, {revenue} FROM silver JOIN conformed USING (customer_id) GROUP BY country
        UNION ALL SELECT 'category', p_type, {revenue} FROM silver JOIN part ON CAST(p_partkey AS VARCHAR) = product_id GROUP BY p_type
        UNION ALL SELECT 'quarantine', reason, CAST(sum(n) AS DOUBLE) FROM remaining GROUP BY reason HAVING sum(n) > 0""",
    )
    sql["skewed_prepared_orders"] = sql["prepared_orders"]
    sql["skewed_fk_customer"] = sql["fk_customer_exists"]
    sql["skewed_fk_sparse"] = _with(
        SALES,
        """SELECT order_id, product_id, product_id IN (SELECT CAST(p_partkey AS VARCHAR) FROM part WHERE p_size <= 5) AS is_small
        FROM sales""",
    )
    sql["skewed_revenue_by_country"] = sql["revenue_by_country"]
    sql["skewed_append"] = sql["idempotent_append"]
    sql["skewed_dedup_rank"] = _with(
        SALES,
        """SELECT customer_id, order_id, product_id, row_number() OVER (PARTITION BY customer_id
        ORDER BY l_shipdate, order_id, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax,
        l_returnflag, l_linestatus) AS copy_rank FROM sales""",
    )
    for query, check in RULE_QUERIES.items():
        sql[query] = _rule(check)
    return sql


RULE_QUERIES = {
    "rule_completeness_key": "completeness_customer_id",
    "rule_completeness_amount": "completeness_order_amount",
    "rule_validity_positive": "validity_quantity_positive",
    "rule_validity_date": "validity_order_date",
    "rule_uniqueness": "uniqueness_order_id",
    "rule_integrity_product": "integrity_product_id",
    "rule_integrity_customer": "integrity_customer_id",
    "rule_accuracy_soft": "accuracy_amount_matches",
}
