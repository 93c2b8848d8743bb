"""DuckDB SQL for the driver-table bindings (independent of the Spark code).

``with_ctes(body, *names)`` prefixes ``body`` with the named CTEs and their
dependencies in definition order.  Every oracle query reads the registered
driver views (lineitem, orders, ...), never intermediate files.
"""

from __future__ import annotations

from salesmart.sources.bindings import (GIFT_MAPPING, GIFT_MAPPING_BY_YEAR, LUNAR_NEW_YEAR,
                                        MID_AUTUMN, THRESHOLD_CHANGES, TYPE_CATEGORY)


def hu2(money: str, count: str, ty: str = "DECIMAL(18,2)") -> str:
    """Half-up money/count to 2 decimals in integer cents (mirrors the Spark helper)."""
    return (f"CAST(CAST(CASE WHEN {count} > 0 THEN (CAST({money} * 100 AS BIGINT) * 2 + {count}) "
            f"// (CAST({count} AS BIGINT) * 2) END AS DECIMAL(20,0)) / 100 AS {ty})")


def pct(a: str, b: str, d: int = 1) -> str:
    return f"ROUND(CAST({a} AS DOUBLE) * 100.0 / NULLIF(CAST({b} AS DOUBLE), 0), {d})"


def avg_exact(x: str, in_scale: int, out_scale: int) -> str:
    units = f"CAST(ROUND(CAST({x} AS DOUBLE) * {10 ** in_scale}) AS BIGINT)"
    return (f"CAST(CAST(CASE WHEN COUNT({x}) > 0 THEN (SUM({units}) * {10 ** (out_scale - in_scale) * 2} "
            f"+ COUNT({x})) // (COUNT({x}) * 2) END AS DECIMAL(38,0)) / {10 ** out_scale} AS DOUBLE)")


def _threshold(year_sql: str) -> str:
    parts = " ".join(f"WHEN {year_sql} >= {start} THEN {t}" for start, t in reversed(THRESHOLD_CHANGES))
    return f"(CASE {parts} END)"


def _sqlv(v):
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _values(rows, names, types):
    vals = ", ".join("(" + ", ".join(_sqlv(v) for v in r) + ")" for r in rows)
    cols = ", ".join(f"CAST({n} AS {t}) AS {n}" for n, t in zip(names, types))
    return f"SELECT {cols} FROM (VALUES {vals}) AS v({', '.join(names)})"


_TYPE_CASE = " ".join(f"WHEN p.p_type = '{k}' THEN '{v}'" for k, v in TYPE_CATEGORY.items())
_THR = _threshold("year(o.o_orderdate)")

CTES: dict[str, tuple[list[str], str]] = {}


def cte(name, deps, sql):
    CTES[name] = (deps, sql)


cte("dim_store", [], """
SELECT s.s_suppkey AS store_id,
       'S' || lpad(CAST(s.s_suppkey AS VARCHAR), 6, '0') AS store_code,
       replace(s.s_name, '#', '-') AS store_name, n.n_name AS store_short_name,
       CASE WHEN s.s_suppkey % 10 = 8 THEN 'HQ' WHEN s.s_suppkey % 10 = 9 THEN 'Web' ELSE 'store' END AS store_type,
       r.r_name AS area, s.s_suppkey AS display_order, TRUE AS is_active
FROM supplier s LEFT JOIN nation n ON s.s_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
UNION ALL
SELECT CAST(-1 AS BIGINT), 'GRAND', 'GRAND TOTAL', CAST(NULL AS VARCHAR), 'grand_total',
       CAST(NULL AS VARCHAR), CAST(999999999 AS BIGINT), TRUE""")

cte("store_daily", [], f"""
SELECT report_date, store_id, sales_result, transfer_amount,
       CAST(sales_result + transfer_amount AS DECIMAL(18,2)) AS sales_incl_result,
       CAST(customer_count AS BIGINT) AS customer_count,
       {hu2('sales_result', 'customer_count', 'DECIMAL(12,2)')} AS unit_price
FROM (SELECT CAST(l_shipdate AS DATE) AS report_date, l_suppkey AS store_id,
             CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS sales_result,
             CAST(-SUM(CASE WHEN l_returnflag = 'R' THEN CAST(l_extendedprice AS DECIMAL(18,2))
                            ELSE CAST(0 AS DECIMAL(18,2)) END) AS DECIMAL(18,2)) AS transfer_amount,
             COUNT(DISTINCT l_orderkey) AS customer_count
      FROM lineitem GROUP BY 1, 2)""")

cte("grand_daily", ["store_daily"], f"""
SELECT g.report_date, CAST(-1 AS BIGINT) AS store_id, g.sales_result, g.transfer_amount,
       CAST(g.sales_result + g.transfer_amount AS DECIMAL(18,2)) AS sales_incl_result,
       CAST(c.customer_count AS BIGINT) AS customer_count,
       {hu2('g.sales_result', 'c.customer_count', 'DECIMAL(12,2)')} AS unit_price
FROM (SELECT report_date, CAST(SUM(sales_result) AS DECIMAL(18,2)) AS sales_result,
             CAST(SUM(transfer_amount) AS DECIMAL(18,2)) AS transfer_amount
      FROM store_daily GROUP BY 1) g
LEFT JOIN (SELECT CAST(l_shipdate AS DATE) AS report_date, COUNT(DISTINCT l_orderkey) AS customer_count
           FROM lineitem GROUP BY 1) c ON g.report_date = c.report_date""")

cte("daily_all", ["store_daily", "grand_daily"],
    "SELECT * FROM store_daily UNION ALL SELECT * FROM grand_daily")

cte("mtd_all", ["daily_all"], f"""
SELECT report_date, store_id, sales_result, transfer_amount, sales_incl_result, customer_count,
       {hu2('sales_result', 'customer_count', 'DECIMAL(12,2)')} AS unit_price
FROM (SELECT report_date, store_id,
             CAST(SUM(sales_result) OVER w AS DECIMAL(18,2)) AS sales_result,
             CAST(SUM(transfer_amount) OVER w AS DECIMAL(18,2)) AS transfer_amount,
             CAST(SUM(sales_incl_result) OVER w AS DECIMAL(18,2)) AS sales_incl_result,
             CAST(SUM(customer_count) OVER w AS BIGINT) AS customer_count
      FROM daily_all
      WINDOW w AS (PARTITION BY store_id, date_trunc('month', report_date) ORDER BY report_date
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""")

_FACT_COLS = "report_date, store_id, {rt} AS record_type, sales_result, transfer_amount, sales_incl_result, customer_count, unit_price"
cte("fact_sales", ["daily_all", "mtd_all"],
    f"SELECT {_FACT_COLS.format(rt=chr(39) + 'DAILY' + chr(39))} FROM daily_all UNION ALL "
    f"SELECT {_FACT_COLS.format(rt=chr(39) + 'MTD' + chr(39))} FROM mtd_all")

cte("category_sales_monthly", [], f"""
SELECT CAST(year(o.o_orderdate) AS INTEGER) AS report_year,
       CAST(month(o.o_orderdate) AS INTEGER) AS report_month,
       CASE WHEN o.o_totalprice >= 400000 THEN 'GIFT_5000_UP' {_TYPE_CASE}
            ELSE 'GIFT_' || CAST({_THR} AS VARCHAR) ||
                 CASE WHEN p.p_retailprice < {_THR} THEN '_DOWN' ELSE '_UP' END END AS category,
       CAST(SUM(CAST(l.l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS sales_result
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN part p ON l.l_partkey = p.p_partkey
GROUP BY 1, 2, 3""")

cte("cat_monthly_all", ["category_sales_monthly"], """
SELECT report_year, report_month, category, sales_result FROM category_sales_monthly
UNION ALL
SELECT report_year, report_month, 'TOTAL', CAST(SUM(sales_result) AS DECIMAL(18,2))
FROM category_sales_monthly GROUP BY 1, 2""")

cte("cat_periods", ["cat_monthly_all"], """
SELECT report_year, report_month, 'MONTHLY' AS period_type, category, sales_result FROM cat_monthly_all
UNION ALL
SELECT report_year, CAST(NULL AS INTEGER), CASE WHEN report_month <= 6 THEN 'H1' ELSE 'H2' END, category,
       CAST(SUM(sales_result) AS DECIMAL(18,2))
FROM cat_monthly_all GROUP BY report_year, category, CASE WHEN report_month <= 6 THEN 'H1' ELSE 'H2' END
UNION ALL
SELECT report_year, CAST(NULL AS INTEGER), 'ANNUAL', category, CAST(SUM(sales_result) AS DECIMAL(18,2))
FROM cat_monthly_all GROUP BY report_year, category""")

_PREV = ("PARTITION BY category, period_type, report_month ORDER BY report_year "
         "RANGE BETWEEN 1 PRECEDING AND 1 PRECEDING")
cte("category_fact", ["cat_periods"], f"""
SELECT report_year, report_month, period_type, category, sales_result,
       {pct('sales_result', 'prev_sales')} AS sales_yoy_pct,
       composition_curr_pct,
       MAX(composition_curr_pct) OVER ({_PREV}) AS composition_prev_pct
FROM (SELECT *, MAX(sales_result) OVER ({_PREV}) AS prev_sales,
             {pct('sales_result', "MAX(CASE WHEN category = 'TOTAL' THEN sales_result END) OVER (PARTITION BY report_year, period_type, report_month)")} AS composition_curr_pct
      FROM cat_periods)""")

cte("kpi_fact", ["category_fact"], f"""
SELECT c.report_year, c.report_month, 'MONTHLY' AS period_type,
       CAST(k.customer_count AS INTEGER) AS customer_count,
       {hu2('c.sales_result', 'k.customer_count', 'DECIMAL(12,2)')} AS unit_price,
       {hu2('c.sales_result', 'c.dd', 'DECIMAL(18,2)')} AS avg_daily_sales,
       CAST(c.dd AS INTEGER) AS day_in_month_curr
FROM (SELECT *, day(last_day(make_date(report_year, report_month, 1))) AS dd
      FROM category_fact WHERE category = 'TOTAL' AND period_type = 'MONTHLY') c
LEFT JOIN (SELECT CAST(year(o_orderdate) AS INTEGER) AS report_year, CAST(month(o_orderdate) AS INTEGER) AS report_month,
                  COUNT(DISTINCT o_custkey) AS customer_count FROM orders GROUP BY 1, 2) k
       ON k.report_year = c.report_year AND k.report_month = c.report_month
UNION ALL
SELECT c.report_year, CAST(NULL AS INTEGER), 'ANNUAL',
       CAST(k.customer_count AS INTEGER),
       {hu2('c.sales_result', 'k.customer_count', 'DECIMAL(12,2)')},
       {hu2('c.sales_result', 'c.dd', 'DECIMAL(18,2)')},
       CAST(c.dd AS INTEGER)
FROM (SELECT *, dayofyear(make_date(report_year, 12, 31)) AS dd
      FROM category_fact WHERE category = 'TOTAL' AND period_type = 'ANNUAL') c
LEFT JOIN (SELECT CAST(year(o_orderdate) AS INTEGER) AS report_year, COUNT(DISTINCT o_custkey) AS customer_count
           FROM orders GROUP BY 1) k ON k.report_year = c.report_year""")

cte("gift_mapping", [], _values(
    GIFT_MAPPING, ["source_category", "canonical_group", "threshold_floor", "threshold_ceiling", "sort_order"],
    ["VARCHAR", "VARCHAR", "INTEGER", "INTEGER", "INTEGER"]))

cte("gift_mapping_by_year", [], _values(
    GIFT_MAPPING_BY_YEAR, ["raw_category", "canonical_group", "threshold_floor", "threshold_ceiling",
                           "year_from", "year_to"],
    ["VARCHAR", "VARCHAR", "INTEGER", "INTEGER", "INTEGER", "INTEGER"]))

cte("month_spine", [], """
SELECT CAST(year(m) AS INTEGER) AS report_year, CAST(month(m) AS INTEGER) AS report_month,
       CAST(m AS DATE) AS month_start
FROM (SELECT unnest(generate_series(date_trunc('month', min(o_orderdate)), date_trunc('month', max(o_orderdate)),
                                    INTERVAL 1 MONTH)) AS m FROM orders)""")

cte("order_month_metrics", [], """
SELECT CAST(year(o_orderdate) AS INTEGER) AS report_year, CAST(month(o_orderdate) AS INTEGER) AS report_month,
       COUNT(*) AS order_count,
       CAST(ROUND(AVG(o_totalprice), 2) AS DECIMAL(18,2)) AS avg_order_price,
       COUNT(DISTINCT o_custkey) AS distinct_customers,
       CAST(CAST((count_if(o_orderpriority = '1-URGENT') * 2000000 + COUNT(*)) // (COUNT(*) * 2) AS DECIMAL(20,0))
            / 10000 AS DECIMAL(9,4)) AS urgent_share_pct
FROM orders GROUP BY 1, 2""")

cte("holidays", [], _values([("LNY", d) for d in LUNAR_NEW_YEAR] + [("MA", d) for d in MID_AUTUMN],
                            ["festival", "festival_date"], ["VARCHAR", "DATE"]))

cte("macro_long", ["month_spine", "order_month_metrics", "holidays"], """
SELECT 'order_count' AS metric, report_year, report_month, CAST(order_count AS VARCHAR) AS value FROM order_month_metrics
UNION ALL SELECT 'avg_order_price', report_year, report_month, CAST(avg_order_price AS VARCHAR) FROM order_month_metrics
UNION ALL SELECT 'distinct_customers', report_year, report_month, CAST(distinct_customers AS VARCHAR) FROM order_month_metrics
UNION ALL SELECT 'urgent_share_pct', report_year, report_month, CAST(urgent_share_pct AS VARCHAR) FROM order_month_metrics
UNION ALL
SELECT 'lunar_calendar', report_year, report_month,
       concat_ws('|', CASE WHEN lny IS NOT NULL THEN 'LNY:' || CAST(lny AS VARCHAR) END,
                      CASE WHEN ma IS NOT NULL THEN 'MA:' || CAST(ma AS VARCHAR) END)
FROM (SELECT s.report_year, s.report_month,
             MAX(CASE WHEN h.festival = 'LNY' THEN day(h.festival_date) END) AS lny,
             MAX(CASE WHEN h.festival = 'MA' THEN day(h.festival_date) END) AS ma
      FROM month_spine s LEFT JOIN holidays h
        ON year(h.festival_date) = s.report_year AND month(h.festival_date) = s.report_month
      GROUP BY 1, 2)
UNION ALL
SELECT 'working_days', report_year, report_month,
       'WD:' || CAST(len(list_filter(generate_series(CAST(month_start AS TIMESTAMP), CAST(last_day(month_start) AS TIMESTAMP), INTERVAL 1 DAY), lambda x: isodow(x) <= 5)) AS VARCHAR)
       || '|CD:' || CAST(day(last_day(month_start)) AS VARCHAR)
FROM month_spine""")


def _payload_int(x: str, tag: str) -> str:
    return f"TRY_CAST(NULLIF(regexp_extract({x}, '{tag}:(\\d+)', 1), '') AS INTEGER)"


cte("macro", ["macro_long", "month_spine"], f"""
SELECT report_year, report_month,
       TRY_CAST(order_count AS BIGINT) AS order_count,
       TRY_CAST(avg_order_price AS DECIMAL(18,2)) AS avg_order_price,
       TRY_CAST(distinct_customers AS BIGINT) AS distinct_customers,
       TRY_CAST(urgent_share_pct AS DECIMAL(9,4)) AS urgent_share_pct,
       contains(lunar, 'LNY') AS has_lunar_new_year,
       {_payload_int('lunar', 'LNY')} AS lunar_new_year_day,
       contains(lunar, 'MA') AS has_mid_autumn,
       {_payload_int('lunar', 'MA')} AS mid_autumn_day,
       CAST(COALESCE({_payload_int('wdp', 'WD')}, (cd * 5) // 7) AS INTEGER) AS working_days,
       CAST(cd AS INTEGER) AS calendar_days,
       CAST(COALESCE(cd, 0) - COALESCE(COALESCE({_payload_int('wdp', 'WD')}, (cd * 5) // 7), 0) AS INTEGER) AS weekend_days
FROM (SELECT s.report_year, s.report_month,
             w.order_count, w.avg_order_price, w.distinct_customers, w.urgent_share_pct,
             COALESCE(w.lunar_calendar, '') AS lunar, w.working_days AS wdp,
             COALESCE({_payload_int('w.working_days', 'CD')}, day(last_day(s.month_start))) AS cd
      FROM month_spine s LEFT JOIN (
        SELECT report_year, report_month,
               MAX(CASE WHEN metric = 'order_count' THEN value END) AS order_count,
               MAX(CASE WHEN metric = 'avg_order_price' THEN value END) AS avg_order_price,
               MAX(CASE WHEN metric = 'distinct_customers' THEN value END) AS distinct_customers,
               MAX(CASE WHEN metric = 'urgent_share_pct' THEN value END) AS urgent_share_pct,
               MAX(CASE WHEN metric = 'lunar_calendar' THEN value END) AS lunar_calendar,
               MAX(CASE WHEN metric = 'working_days' THEN value END) AS working_days
        FROM macro_long GROUP BY 1, 2) w
      ON w.report_year = s.report_year AND w.report_month = s.report_month)""")


def with_ctes(body: str, *names: str, local: dict[str, str] | None = None) -> str:
    """Prefix ``body`` with base CTEs ``names`` (plus dependencies) and then
    query-local CTEs ``local`` (in the given order)."""
    need: set[str] = set()

    def add(n):
        if n in need:
            return
        for d in CTES[n][0]:
            add(d)
        need.add(n)
    for n in names:
        add(n)
    parts = [f"{n} AS ({CTES[n][1]}\n)" for n in CTES if n in need]
    parts += [f"{n} AS ({sql}\n)" for n, sql in (local or {}).items()]
    return ("WITH " + ",\n".join(parts) + "\n" + body) if parts else body
