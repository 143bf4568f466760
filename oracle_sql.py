"""DuckDB SQL for every registered query, over the driver's tables.

A second opinion on the Spark code: nothing is imported from it, the sources
are rebuilt from the driver's tables in SQL, and where the library has an
algorithm this file takes another one. Islands are differences of two row
numbers instead of running sums over lags; facts find their version by ASOF
joins instead of ranges; the end of a version is looked up in the list of its
customer's starts; rejected invoices and monthly revenue are taken from the
snapshots without any dimension. Each query is one WITH statement that pulls in
the relations it needs. Types are pinned where the two engines differ (counts
and version numbers bigint, sums decimal(38,2), months as DATE).
"""

from __future__ import annotations

# name -> (sql, dependencies)
CTES: dict[str, tuple[str, tuple[str, ...]]] = {}


def _cte(name: str, sql: str, *deps: str) -> None:
    CTES[name] = (sql, deps)


# ---------------------------------------------------------------- sources
_cte("plans", """
SELECT 'PLAN-' || CAST(r_regionkey AS VARCHAR) AS plan_id, r_name AS plan_name,
       100 * (r_regionkey + 1) AS monthly_price, lower(r_name) AS tier
FROM region""")

_cte("snap_days", "SELECT DISTINCT CAST(ts AS DATE) AS d FROM events")

_cte("crm_customers", """
SELECT c.c_custkey AS customer_id, c.c_name AS name,
       lower(c.c_name) || '@example.com' AS email, n.n_name AS company,
       'PLAN-' || CAST((c.c_custkey + CASE WHEN c.c_custkey % 3 = 0
            THEN CAST(floor((c.c_custkey * 7 + extract(day FROM s.d)) / 11.0) AS INTEGER)
            ELSE 0 END) % 5 AS VARCHAR) AS plan_id,
       'REGION-' || CAST((n.n_regionkey + CASE WHEN c.c_custkey % 7 = 1
            THEN CAST(floor((c.c_custkey + extract(day FROM s.d)) / 13.0) AS INTEGER)
            ELSE 0 END) % 5 AS VARCHAR) AS region,
       CASE WHEN c.c_custkey % 5 = 2
             AND CAST(floor((c.c_custkey + extract(day FROM s.d)) / 9.0) AS INTEGER) % 2 = 1
            THEN 'SWITCHED' ELSE c.c_mktsegment END AS segment,
       DATE '2023-06-01' AS signup_date,
       s.d AS snapshot_date
FROM customer c
JOIN nation n ON c.c_nationkey = n.n_nationkey
CROSS JOIN snap_days s
WHERE NOT (c.c_custkey % 10 = 9 AND extract(day FROM s.d) < 8)
  AND NOT (c.c_custkey % 13 = 5 AND extract(day FROM s.d) IN (14, 15))""", "snap_days")

_cte("invoices_base", """
SELECT o_orderkey AS invoice_id,
       CASE WHEN o_orderkey % 67 = 0 THEN o_custkey + 1000000 ELSE o_custkey END AS customer_id,
       'PLAN-' || CAST(o_custkey % 5 AS VARCHAR) AS plan_id,
       CASE WHEN o_orderkey % 50 = 3 THEN DATE '2023-12-20' + CAST(o_orderkey % 7 AS INTEGER)
            ELSE DATE '2024-01-01' + CAST(o_orderkey % 30 AS INTEGER) END AS invoice_date,
       CASE WHEN o_orderkey % 53 = 0 THEN ''
            WHEN o_orderkey % 61 = 0 THEN 'n/a'
            WHEN o_orderkey % 59 = 0 THEN '-' || CAST(o_totalprice AS VARCHAR)
            ELSE CAST(o_totalprice AS VARCHAR) END AS amount,
       CASE WHEN o_orderstatus <> 'P' THEN 'paid'
            WHEN o_orderkey % 2 = 0 THEN 'failed' ELSE 'refunded' END AS status
FROM orders""")

_cte("invoices", """
SELECT * FROM invoices_base
UNION ALL
SELECT * FROM invoices_base WHERE invoice_id % 50 = 7""", "invoices_base")

_cte("usage_events", """
SELECT event_id,
       CASE WHEN event_id % 97 = 0 THEN user_id + 1000000 ELSE user_id END AS customer_id,
       CASE event_type WHEN 'view' THEN 'login' WHEN 'click' THEN 'api_call'
            ELSE event_type END AS event_type,
       ts AS event_timestamp, props AS feature_used
FROM events""")

# ---------------------------------------------------------------- staging
_cte("stg_plans", """
SELECT plan_id, plan_name, CAST(monthly_price AS DECIMAL(10, 2)) AS monthly_price, tier
FROM plans""", "plans")

_cte("stg_customers", """
SELECT customer_id, name, email, company, plan_id, region, segment,
       CAST(signup_date AS DATE) AS signup_date, CAST(snapshot_date AS DATE) AS snapshot_date
FROM crm_customers""", "crm_customers")

_cte("invoices_ranked", """
SELECT *, row_number() OVER (
    PARTITION BY invoice_id
    ORDER BY customer_id ASC NULLS FIRST, invoice_date ASC NULLS FIRST,
             amount ASC NULLS FIRST, status ASC NULLS FIRST, plan_id ASC NULLS FIRST
) AS dedup_rank
FROM invoices""", "invoices")

_cte("stg_invoices", """
SELECT invoice_id, customer_id, plan_id, invoice_date, amount, status,
       CASE WHEN amount IS NULL OR amount < 0 THEN true ELSE false END AS has_bad_amount
FROM (
    SELECT invoice_id, customer_id, plan_id, CAST(invoice_date AS DATE) AS invoice_date,
           TRY_CAST(amount AS DECIMAL(10, 2)) AS amount, status
    FROM invoices_ranked WHERE dedup_rank = 1
) t""", "invoices_ranked")

_cte("stg_usage_events", """
SELECT event_id, customer_id, event_type,
       CAST(event_timestamp AS TIMESTAMP) AS event_timestamp,
       CAST(event_timestamp AS DATE) AS event_date, feature_used
FROM usage_events""", "usage_events")

# ---------------------------------------------------------------- intermediate
# The n-th row of a customer is the m-th with its attributes: n - m stays the
# same exactly while the attributes do.
_ISLANDS = """
SELECT {key}, {state}, min({day}) AS valid_from, max({day}) AS last_seen_date
FROM (SELECT *, row_number() OVER (PARTITION BY {of} ORDER BY {day})
              - row_number() OVER (PARTITION BY {of}, {state} ORDER BY {day}) AS shift
      FROM {rows})
GROUP BY {key}, {state}, {of}, shift"""

_STATE = "name, email, company, plan_id, region, segment, signup_date"

_cte("islands", _ISLANDS.format(key="customer_id", state=_STATE, of="customer_id",
                                day="snapshot_date", rows="stg_customers"), "stg_customers")

_cte("int_customer_history", f"""
SELECT customer_id, {_STATE}, row_number() OVER (PARTITION BY customer_id ORDER BY valid_from)
       AS version_id, valid_from, last_seen_date
FROM islands""", "islands")

_cte("starts", """
SELECT customer_id, list(valid_from ORDER BY valid_from) AS days
FROM islands GROUP BY customer_id""", "islands")

_cte("int_customer_scd", f"""
SELECT concat_ws('-', h.customer_id, h.version_id) AS customer_key, h.customer_id, {_STATE},
       h.version_id, h.valid_from, s.days[h.version_id + 1] - 1 AS valid_to,
       h.version_id = len(s.days) AS is_current
FROM int_customer_history h JOIN starts s USING (customer_id)""", "int_customer_history", "starts")

# A customer's ranges follow each other without end: the latest one that has
# begun is the one that holds.
_cte("int_invoice_resolved", """
SELECT i.invoice_id, i.customer_id, i.plan_id, i.invoice_date, i.amount, i.status,
       i.has_bad_amount, v.customer_key
FROM stg_invoices i ASOF LEFT JOIN int_customer_scd v
  ON i.customer_id = v.customer_id AND i.invoice_date >= v.valid_from""",
     "stg_invoices", "int_customer_scd")

# ---------------------------------------------------------------- marts
_cte("dim_customer", """
SELECT customer_key, customer_id, name, email, company, plan_id, region, segment,
       signup_date, version_id, valid_from, valid_to, is_current
FROM int_customer_scd""", "int_customer_scd")

_cte("dim_plan", "SELECT plan_id, plan_name, monthly_price, tier FROM stg_plans", "stg_plans")

_cte("dim_date", """
SELECT CAST(d AS DATE) AS date_day,
       CAST(extract(year FROM d) AS BIGINT) AS year,
       CAST(extract(month FROM d) AS BIGINT) AS month,
       CAST(extract(day FROM d) AS BIGINT) AS day,
       CAST(extract(dow FROM d) AS BIGINT) AS day_of_week,
       strftime(d, '%A') AS day_name,
       strftime(d, '%B') AS month_name,
       CASE WHEN extract(dow FROM d) IN (0, 6) THEN true ELSE false END AS is_weekend
FROM (
    SELECT unnest(generate_series(CAST(min(snapshot_date) - 7 AS TIMESTAMP),
                                  CAST(max(snapshot_date) + 3 AS TIMESTAMP),
                                  INTERVAL 1 DAY)) AS d
    FROM stg_customers
) t""", "stg_customers")

_cte("fact_invoice", """
SELECT invoice_id, customer_key, customer_id, plan_id, invoice_date, amount, status,
       CASE WHEN has_bad_amount THEN 'flagged_for_review' ELSE status END AS status_clean,
       has_bad_amount
FROM int_invoice_resolved
WHERE customer_key IS NOT NULL""", "int_invoice_resolved")

_cte("first_seen", """
SELECT customer_id, min(snapshot_date) AS first_day FROM stg_customers GROUP BY customer_id""",
     "stg_customers")

_cte("fact_invoice_rejected", """
SELECT i.* EXCLUDE (has_bad_amount), CASE WHEN first_day IS NULL THEN 'orphan_customer_id'
       ELSE 'invoice_predates_scd_coverage' END AS rejection_reason
FROM stg_invoices i LEFT JOIN first_seen f USING (customer_id)
WHERE first_day IS NULL OR i.invoice_date < first_day""", "stg_invoices", "first_seen")

_cte("events_by_day", """
SELECT customer_id, event_date, count(*) AS event_count,
       len(list(DISTINCT event_type)) AS distinct_event_types,
       coalesce(sum((event_type = 'login')::INT), 0)::BIGINT AS login_count,
       coalesce(sum((event_type = 'api_call')::INT), 0)::BIGINT AS api_call_count
FROM stg_usage_events GROUP BY ALL""", "stg_usage_events")

_cte("fact_usage_daily", """
SELECT e.customer_id, v.customer_key, e.event_date, e.event_count, e.distinct_event_types,
       e.login_count, e.api_call_count
FROM events_by_day e ASOF JOIN int_customer_scd v
  ON e.customer_id = v.customer_id AND e.event_date >= v.valid_from""",
     "events_by_day", "int_customer_scd")

# The segment is that of the customer's last snapshot up to the invoice.
# arpu: sum / customers rounded half-up to cents in exact integer arithmetic.
_cte("mrr_monthly", """
SELECT invoice_month, plan_name, tier, segment, paying_customers, mrr,
       CAST(((CAST(mrr * 100 AS HUGEINT) * 2 + paying_customers)
             // nullif(2 * paying_customers, 0)) AS DOUBLE) / 100.0 AS arpu
FROM (
    SELECT CAST(date_trunc('month', i.invoice_date) AS DATE) AS invoice_month, plan_name, tier,
           s.segment, count(DISTINCT i.customer_id) AS paying_customers,
           CAST(sum(i.amount) AS DECIMAL(38, 2)) AS mrr
    FROM (SELECT * FROM stg_invoices WHERE status = 'paid' AND NOT has_bad_amount) i
    ASOF JOIN stg_customers s
      ON i.customer_id = s.customer_id AND i.invoice_date >= s.snapshot_date
    JOIN stg_plans p ON p.plan_id = i.plan_id
    GROUP BY ALL
) t""", "stg_invoices", "stg_customers", "stg_plans")


def compose(final_sql: str, *needs: str) -> str:
    """WITH <needed relations in dependency order> <final_sql>."""
    order: list[str] = []

    def visit(name: str) -> None:
        if name in order:
            return
        for dep in CTES[name][1]:
            visit(dep)
        order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return final_sql
    body = ",\n".join(f"{n} AS (\n{CTES[n][0].strip()}\n)" for n in order)
    return f"WITH {body}\n{final_sql.strip()}"


def model(name: str) -> str:
    return compose(f"SELECT * FROM {name}", name)


# ---------------------------------------------------------------- checks and reports
def _unique(model: str, cols: list[str]) -> str:
    c = ", ".join(cols)
    nn = " AND ".join(f"{x} IS NOT NULL" for x in cols)
    return (f"SELECT 'unique' AS check_name, '{model}' AS model, '{','.join(cols)}' AS column_name, "
            f"CAST(count(*) AS BIGINT) AS failures, CAST(coalesce(sum(n), 0) AS BIGINT) AS failing_rows "
            f"FROM (SELECT {c}, count(*) AS n FROM {model} WHERE {nn} GROUP BY {c} "
            f"HAVING count(*) > 1) t")


def _not_null(model: str, col: str) -> str:
    return (f"SELECT 'not_null' AS check_name, '{model}' AS model, '{col}' AS column_name, "
            f"CAST(count(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS failures, "
            f"CAST(count(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS failing_rows FROM {model}")


def _accepted(model: str, col: str, values: list[str]) -> str:
    vals = ", ".join(f"'{v}'" for v in values)
    return (f"SELECT 'accepted_values' AS check_name, '{model}' AS model, '{col}' AS column_name, "
            f"CAST(count(*) AS BIGINT) AS failures, CAST(coalesce(sum(n), 0) AS BIGINT) AS failing_rows "
            f"FROM (SELECT {col}, count(*) AS n FROM {model} "
            f"WHERE {col} IS NOT NULL AND {col} NOT IN ({vals}) GROUP BY {col}) t")


def _relationship(model: str, col: str, parent: str, field: str) -> str:
    return (f"SELECT 'relationships' AS check_name, '{model}' AS model, '{col}' AS column_name, "
            f"CAST(count(*) AS BIGINT) AS failures, CAST(count(*) AS BIGINT) AS failing_rows "
            f"FROM {model} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {parent} p WHERE p.{field} = c.{col})")


def _half_up(num: str, den: str, digits: int) -> str:
    scale = 10 ** digits
    return (f"CAST(((CAST({num} AS HUGEINT) * {scale} * 2 + CAST({den} AS HUGEINT)) "
            f"// (2 * CAST({den} AS HUGEINT))) AS DOUBLE) / {float(scale)}")


def _zscore(counts_sql: str, day: str, threshold: float = 2.0) -> str:
    """Leave-one-out z over `counts_sql` (columns: day, row_count), exact
    HUGEINT arithmetic for the variance."""
    return f"""
SELECT {day}, row_count, mean_others, std_others, z_score,
       coalesce(abs(z_score) > {threshold}, false) AS is_anomaly
FROM (
    SELECT {day}, row_count,
           CASE WHEN n > 0 THEN CAST(s1 - x AS DOUBLE) / CAST(n AS DOUBLE) END AS mean_others,
           CASE WHEN n > 0 THEN sqrt(CAST(v AS DOUBLE)) / CAST(n AS DOUBLE) END AS std_others,
           CASE WHEN n = 0 THEN NULL
                WHEN v = 0 THEN (CASE WHEN num = 0 THEN 0.0 WHEN num > 0 THEN 999.0 ELSE -999.0 END)
                ELSE CAST(num AS DOUBLE) / sqrt(CAST(v AS DOUBLE)) END AS z_score
    FROM (
        SELECT {day}, row_count, x, n, s1,
               n * (s2 - x * x) - (s1 - x) * (s1 - x) AS v,
               n * x - (s1 - x) AS num
        FROM (
            SELECT {day}, CAST(row_count AS BIGINT) AS row_count,
                   CAST(row_count AS HUGEINT) AS x,
                   CAST((SELECT count(*) FROM ({counts_sql}) a) - 1 AS HUGEINT) AS n,
                   (SELECT CAST(sum(row_count) AS HUGEINT) FROM ({counts_sql}) a) AS s1,
                   (SELECT sum(CAST(row_count AS HUGEINT) * CAST(row_count AS HUGEINT))
                      FROM ({counts_sql}) a) AS s2
            FROM ({counts_sql}) c
        ) p
    ) q
) r"""


_SNAPSHOT_COUNTS = "SELECT snapshot_date, count(*) AS row_count FROM crm_customers GROUP BY snapshot_date"


def _volume_summary(scored_sql: str) -> str:
    mean = _half_up("s1", "n_days", 1)
    return f"""
SELECT CAST(n_days AS BIGINT) AS n_days_checked,
       CASE WHEN n_days > 0 THEN {mean} ELSE 0.0 END AS mean_count,
       CASE WHEN n_days > 0 THEN round(sqrt(CAST(n_days * s2 - s1 * s1 AS DOUBLE)) / CAST(n_days AS DOUBLE), 1)
            ELSE 0.0 END AS std_count,
       CAST(n_anomalies AS BIGINT) AS n_anomalies,
       CASE WHEN n_anomalies > 0 THEN 'alert' ELSE 'ok' END AS volume_status
FROM (
    SELECT CAST(count(*) AS HUGEINT) AS n_days,
           CAST(coalesce(sum(row_count), 0) AS HUGEINT) AS s1,
           coalesce(sum(CAST(row_count AS HUGEINT) * CAST(row_count AS HUGEINT)), 0) AS s2,
           count(*) FILTER (WHERE is_anomaly) AS n_anomalies
    FROM ({scored_sql}) z
) t"""


_QUARANTINE = f"""
SELECT CAST(total AS BIGINT) AS total_rows, CAST(q AS BIGINT) AS quarantined_rows,
       CASE WHEN total > 0 THEN {_half_up("q", "total", 4)} ELSE 0.0 END AS quarantine_rate,
       CASE WHEN total > 0 AND CAST(q AS DOUBLE) > 0.05 * CAST(total AS DOUBLE)
            THEN 'warn' ELSE 'ok' END AS rate_status
FROM (SELECT (SELECT count(*) FROM fact_invoice) + (SELECT count(*) FROM fact_invoice_rejected) AS total,
             (SELECT count(*) FROM fact_invoice_rejected) AS q) t"""

_LINEITEM_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
                   "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


# The declared expectations, stated here once more.
MODELS = ("stg_plans", "stg_customers", "stg_invoices", "stg_usage_events",
          "int_customer_history", "int_customer_scd", "int_invoice_resolved",
          "dim_customer", "dim_plan", "dim_date", "fact_invoice",
          "fact_invoice_rejected", "fact_usage_daily", "mrr_monthly")
UNIQUE = [("stg_plans", "plan_id"), ("stg_invoices", "invoice_id"),
          ("stg_usage_events", "event_id"), ("dim_customer", "customer_key"),
          ("dim_plan", "plan_id"), ("dim_date", "date_day"), ("fact_invoice", "invoice_id")]
NOT_NULL = {
    "stg_plans": ["plan_id"], "stg_customers": ["customer_id", "snapshot_date"],
    "stg_invoices": ["invoice_id"], "stg_usage_events": ["event_id"],
    "dim_customer": ["customer_key", "customer_id", "valid_from"], "dim_plan": ["plan_id"],
    "dim_date": ["date_day"], "fact_invoice": ["invoice_id", "customer_key"],
    "fact_invoice_rejected": ["invoice_id"], "fact_usage_daily": ["customer_key"],
    "mrr_monthly": ["mrr"]}
ACCEPTED_VALUES = [
    ("dim_customer", "segment", ["SMB", "Mid-Market", "Enterprise"]),
    ("dim_plan", "tier", ["starter", "growth", "scale", "enterprise"]),
    ("fact_invoice", "status_clean", ["paid", "failed", "refunded", "flagged_for_review"]),
    ("fact_invoice_rejected", "rejection_reason",
     ["orphan_customer_id", "invoice_predates_scd_coverage"])]
RELATIONSHIPS = [("fact_invoice", "customer_key", "dim_customer", "customer_key"),
                 ("fact_invoice", "plan_id", "dim_plan", "plan_id"),
                 ("fact_usage_daily", "customer_key", "dim_customer", "customer_key")]

# Each range against the latest end of all ranges that begin before it.
_OVERLAPS = """
SELECT {key}, least(v, w.v) AS version_a, if(v < w.v, f, w.f) AS a_valid_from,
       if(v < w.v, t, w.t) AS a_valid_to, greatest(v, w.v) AS version_b,
       if(v < w.v, w.f, f) AS b_valid_from, if(v < w.v, w.t, t) AS b_valid_to
FROM (
    SELECT *, max({{'e': e, 'v': v, 'f': f, 't': t}}) OVER (
        PARTITION BY {key} ORDER BY f, v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS w
    FROM (SELECT {key}, version_id AS v, valid_from AS f, valid_to AS t,
                 coalesce(valid_to, DATE '9999-12-31') AS e FROM {rows})
)
WHERE w.e >= f"""

_CSV_FIELDS = ("doc_id", "text", "lang", "source", "n_chars")


def _csv_record() -> str:
    quoted = ["""coalesce('"' || replace(CAST(%s AS VARCHAR), '"', '""') || '"', '')""" % c
              for c in _CSV_FIELDS]
    comma = " || ',' || "
    return f"""CASE WHEN doc_id % 50 = 7 THEN {comma.join(quoted[:-1])}
      WHEN doc_id % 50 = 9 THEN {comma.join(quoted)} || ',"x"' END"""


def oracle_queries() -> dict[str, str]:
    q = {name: model(name) for name in MODELS}
    src = ("plans", "crm_customers", "invoices", "usage_events")
    q["load_summary"] = compose(" UNION ALL ".join(
        f"SELECT '{s}' AS table_name, count(*) AS row_count FROM {s}" for s in src), *src)

    uniq = [_unique(m, [c]) for m, c in UNIQUE] + [_unique("lineitem", ["l_orderkey", "l_linenumber"])]
    q["expect_unique"] = compose(" UNION ALL ".join(uniq), *[m for m, _ in UNIQUE])
    q["expect_not_null"] = compose(" UNION ALL ".join(
        _not_null(m, c) for m, cols in NOT_NULL.items() for c in cols), *NOT_NULL)
    q["expect_accepted_values"] = compose(" UNION ALL ".join(
        _accepted(m, c, v) for m, c, v in ACCEPTED_VALUES), *[m for m, _, _ in ACCEPTED_VALUES])
    q["expect_relationships"] = compose(" UNION ALL ".join(
        _relationship(*r) for r in RELATIONSHIPS),
        *sorted({r[0] for r in RELATIONSHIPS} | {r[2] for r in RELATIONSHIPS}))

    q["assert_no_scd_overlap"] = compose(
        _OVERLAPS.format(key="customer_id", rows="dim_customer"), "dim_customer")
    q["scd_overlaps"] = _OVERLAPS.format(key="customer_id", rows="""(
        SELECT o_custkey AS customer_id, o_orderkey AS version_id,
               CAST(o_orderdate AS DATE) AS valid_from,
               CASE WHEN o_orderkey % 97 = 0 THEN NULL
                    ELSE CAST(o_orderdate AS DATE) + CAST(o_orderkey % 40 AS INTEGER) END AS valid_to
        FROM orders)""")
    q["paid_negative_invoices"] = compose(
        "SELECT *, status AS status_clean FROM stg_invoices "
        "WHERE status = 'paid' AND coalesce(amount, -1) < 0", "stg_invoices")
    q["unresolved_invoices"] = compose("""
SELECT i.*, CAST(NULL AS VARCHAR) AS customer_key
FROM stg_invoices i LEFT JOIN first_seen f USING (customer_id)
WHERE first_day IS NULL OR i.invoice_date < first_day""", "stg_invoices", "first_seen")
    q["csv_documents"] = """
SELECT doc_id, nullif(text, '') AS text, lang, source, n_chars FROM documents
WHERE doc_id % 50 NOT IN (7, 9)"""
    q["csv_split_documents"] = """
SELECT CAST(doc_id AS VARCHAR) AS doc_id, nullif(text, '') AS text, nullif(lang, '') AS lang,
       nullif(source, '') AS source, CAST(n_chars AS VARCHAR) AS n_chars
FROM documents"""
    q["csv_rejects"] = f"""
SELECT 'documents' AS table_name, {_csv_record()} AS record FROM documents
WHERE doc_id % 50 IN (7, 9)"""
    null_ids = _ISLANDS.format(
        key="customer_id", state=_STATE, of="coalesce(CAST(customer_id AS VARCHAR), name)",
        day="snapshot_date", rows="anonymous")
    q["scd_null_ids"] = compose(f"""
SELECT CAST(customer_id AS VARCHAR) || '-' || CAST(version_id AS VARCHAR) AS customer_key,
       customer_id, {_STATE}, version_id, valid_from, days[version_id + 1] - 1 AS valid_to,
       version_id = len(days) AS is_current
FROM (
    SELECT *, row_number() OVER (PARTITION BY record ORDER BY valid_from) AS version_id,
           list(valid_from) OVER (PARTITION BY record ORDER BY valid_from
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS days
    FROM (SELECT *, coalesce(CAST(customer_id AS VARCHAR), name) AS record FROM (
        WITH anonymous AS (SELECT * REPLACE (
            CASE WHEN customer_id % 10 = 4 THEN NULL ELSE customer_id END AS customer_id)
            FROM stg_customers) {null_ids})))""", "stg_customers")
    q["assert_paid_non_negative"] = compose(
        "SELECT * FROM fact_invoice WHERE status_clean = 'paid' AND (amount IS NULL OR amount < 0)",
        "fact_invoice")
    q["assert_fact_resolved"] = compose(
        "SELECT * FROM fact_invoice WHERE customer_key IS NULL", "fact_invoice")

    q["dq_volume_zscore"] = compose(_zscore(_SNAPSHOT_COUNTS, "snapshot_date"), "crm_customers")
    q["dq_volume_summary"] = compose(
        _volume_summary(_zscore(_SNAPSHOT_COUNTS, "snapshot_date")), "crm_customers")
    q["dq_quarantine_rate"] = compose(_QUARANTINE, "fact_invoice", "fact_invoice_rejected")
    q["dq_health_report"] = compose(f"""
SELECT v.*, r.*,
       CASE WHEN v.volume_status = 'alert' OR r.rate_status = 'warn' THEN 'alert' ELSE 'ok' END
           AS overall_status
FROM ({_volume_summary(_zscore(_SNAPSHOT_COUNTS, "snapshot_date"))}) v,
     ({_QUARANTINE}) r""", "crm_customers", "fact_invoice", "fact_invoice_rejected")

    q["invoice_reconciliation"] = compose("""
SELECT raw_rows, deduplicated_rows, raw_rows - deduplicated_rows AS duplicates_collapsed,
       resolved_rows, flagged_rows, rejected_rows, orphan_rows, predates_rows,
       deduplicated_rows = resolved_rows + rejected_rows AS balanced
FROM (
    SELECT (SELECT count(*) FROM invoices) AS raw_rows,
           (SELECT count(*) FROM stg_invoices) AS deduplicated_rows,
           (SELECT count(*) FROM fact_invoice) AS resolved_rows,
           (SELECT count(*) FROM fact_invoice WHERE status_clean = 'flagged_for_review') AS flagged_rows,
           (SELECT count(*) FROM fact_invoice_rejected) AS rejected_rows,
           (SELECT count(*) FROM fact_invoice_rejected
             WHERE rejection_reason = 'orphan_customer_id') AS orphan_rows,
           (SELECT count(*) FROM fact_invoice_rejected
             WHERE rejection_reason = 'invoice_predates_scd_coverage') AS predates_rows
) t""", "invoices", "stg_invoices", "fact_invoice", "fact_invoice_rejected")
    q["rejection_counts"] = compose(
        "SELECT rejection_reason, count(*) AS row_count FROM fact_invoice_rejected GROUP BY 1",
        "fact_invoice_rejected")
    q["mrr_by_plan_segment"] = compose(
        "SELECT plan_name, segment, mrr, paying_customers FROM mrr_monthly ORDER BY plan_name, segment",
        "mrr_monthly")
    q["reports_by_name"] = compose("""
SELECT plan_name || '/' || segment AS item, mrr AS amount, paying_customers AS row_count FROM mrr_monthly
UNION ALL
SELECT rejection_reason, NULL, count(*) FROM fact_invoice_rejected GROUP BY 1""",
        "mrr_monthly", "fact_invoice_rejected")
    q["scd_change_summary"] = compose("""
SELECT versions, customers, customers_changed, snapshot_days,
       CAST(versions - customers AS DOUBLE)
         / CAST(nullif((snapshot_days - 1) * customers, 0) AS DOUBLE) AS change_rate
FROM (
    SELECT CAST(sum(n) AS BIGINT) AS versions, count(*) AS customers,
           count(*) FILTER (WHERE n > 1) AS customers_changed,
           (SELECT count(DISTINCT snapshot_date) FROM stg_customers) AS snapshot_days
    FROM (SELECT customer_id, count(*) AS n FROM int_customer_scd GROUP BY customer_id) per_key
) t""", "int_customer_scd", "stg_customers")

    q["profile_snapshot_rows"] = compose(
        "SELECT CAST(snapshot_date AS DATE) AS snapshot_date, count(*) AS row_count "
        "FROM crm_customers GROUP BY 1", "crm_customers")
    q["profile_daily_changes"] = compose("""
SELECT c.snapshot_date, count(*) AS customers_compared,
       count(*) FILTER (WHERE c.plan_id IS DISTINCT FROM p.plan_id
                           OR c.region IS DISTINCT FROM p.region
                           OR c.segment IS DISTINCT FROM p.segment) AS customers_changed
FROM (SELECT * FROM (SELECT customer_id, CAST(snapshot_date AS DATE) AS snapshot_date,
                            plan_id, region, segment,
                            row_number() OVER (PARTITION BY customer_id, CAST(snapshot_date AS DATE)
                                ORDER BY plan_id NULLS FIRST, region NULLS FIRST,
                                         segment NULLS FIRST) AS rn
                     FROM crm_customers) x WHERE rn = 1) c
JOIN (SELECT * FROM (SELECT customer_id, CAST(snapshot_date AS DATE) AS snapshot_date,
                            plan_id, region, segment,
                            row_number() OVER (PARTITION BY customer_id, CAST(snapshot_date AS DATE)
                                ORDER BY plan_id NULLS FIRST, region NULLS FIRST,
                                         segment NULLS FIRST) AS rn
                     FROM crm_customers) y WHERE rn = 1) p
  ON c.customer_id = p.customer_id AND c.snapshot_date = p.snapshot_date + 1
GROUP BY c.snapshot_date""", "crm_customers")
    q["profile_invoices"] = compose("""
SELECT raw_rows, distinct_ids, raw_rows - distinct_ids AS duplicate_ids, orphan_rows,
       bad_amount_rows, pre_window_rows
FROM (
    SELECT count(*) AS raw_rows, count(DISTINCT invoice_id) AS distinct_ids,
           count(*) FILTER (WHERE amount IS NULL OR amount = ''
               OR coalesce(regexp_matches(amount, '^-[0-9.]+$')
                           AND TRY_CAST(amount AS DOUBLE) < 0, false)) AS bad_amount_rows,
           count(*) FILTER (WHERE CAST(invoice_date AS DATE)
               < (SELECT min(CAST(snapshot_date AS DATE)) FROM crm_customers)) AS pre_window_rows,
           (SELECT count(*) FROM invoices i WHERE NOT EXISTS
               (SELECT 1 FROM crm_customers c WHERE c.customer_id = i.customer_id)) AS orphan_rows
    FROM invoices
) t""", "invoices", "crm_customers")
    q["profile_events"] = compose("""
SELECT event_rows, unknown_customer_rows, unknown_customer_rows = 0 AS all_known
FROM (
    SELECT count(*) AS event_rows,
           (SELECT count(*) FROM usage_events e WHERE NOT EXISTS
               (SELECT 1 FROM crm_customers c WHERE c.customer_id = e.customer_id))
               AS unknown_customer_rows
    FROM usage_events
) t""", "usage_events", "crm_customers")
    q["profile_plans"] = compose("""
SELECT plan_rows, distinct_plan_ids, rows_with_missing,
       rows_with_missing = 0 AND plan_rows = distinct_plan_ids AS complete
FROM (
    SELECT count(*) AS plan_rows, count(DISTINCT plan_id) AS distinct_plan_ids,
           count(*) FILTER (WHERE plan_id IS NULL OR CAST(plan_id AS VARCHAR) = ''
               OR plan_name IS NULL OR CAST(plan_name AS VARCHAR) = ''
               OR monthly_price IS NULL OR CAST(monthly_price AS VARCHAR) = ''
               OR tier IS NULL OR CAST(tier AS VARCHAR) = '') AS rows_with_missing
    FROM plans
) t""", "plans")

    order = ", ".join(f"{c} ASC NULLS FIRST" for c in _LINEITEM_ORDER)
    q["dedup_lineitem"] = f"""
SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn
      FROM lineitem) t
WHERE rn = 1"""
    order_versions = """
WITH daily AS (
    SELECT o_custkey, CAST(o_orderdate AS DATE) AS order_day,
           arg_max(o_orderpriority, o_orderkey) AS o_orderpriority
    FROM orders GROUP BY ALL
), islands AS (""" + _ISLANDS.format(key="o_custkey", state="o_orderpriority", of="o_custkey",
                                     day="order_day", rows="daily") + """
), versions AS (
    SELECT o_custkey, o_orderpriority, valid_from,
           row_number() OVER (PARTITION BY o_custkey ORDER BY valid_from) AS version_id,
           list(valid_from) OVER (PARTITION BY o_custkey ORDER BY valid_from
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS days
    FROM islands
), closed AS (
    SELECT concat_ws('-', o_custkey, version_id) AS version_key, o_custkey, o_orderpriority,
           version_id, valid_from, days[version_id + 1] - 1 AS valid_to,
           version_id = len(days) AS is_current
    FROM versions
)"""
    q["scd_from_orders"] = order_versions + " SELECT * FROM closed"
    q["lineitem_versions"] = order_versions + """
SELECT l.l_orderkey, l.l_linenumber, l.o_custkey, l.ship_day, c.version_key, c.o_orderpriority
FROM (SELECT l_orderkey, l_linenumber, o_custkey, CAST(l_shipdate AS DATE) AS ship_day
      FROM lineitem JOIN orders ON l_orderkey = o_orderkey) l
ASOF LEFT JOIN closed c ON l.o_custkey = c.o_custkey AND l.ship_day >= c.valid_from"""
    q["volume_events"] = _zscore(
        "SELECT CAST(ts AS DATE) AS event_day, count(*) AS row_count FROM events GROUP BY 1",
        "event_day")
    q["scd_incremental"] = q["scd_two_levels"] = q["int_customer_scd"]
    return q
