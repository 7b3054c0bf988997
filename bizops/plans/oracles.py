"""DuckDB SQL for every registered query, written against the raw tables.

Each text stands alone: the views it names come first as common table expressions.
"""

from __future__ import annotations

from bizops.sources.schemas import MACHINE_RATES

VIEWS = {
    "sales": """
        SELECT l.l_orderkey AS ticket_id, CAST(o.o_orderdate AS DATE) AS sale_date,
               o.o_custkey AS customer_id, l.l_partkey AS product_id, s.s_nationkey AS store_id,
               l.l_linenumber AS line_number, p.p_type AS category,
               CAST(l.l_quantity AS DECIMAL(10,0)) AS qty,
               CAST(l.l_discount AS DECIMAL(4,2)) AS discount,
               CAST(p.p_retailprice AS DECIMAL(10,2)) * 2 AS list_price,
               CAST(p.p_retailprice AS DECIMAL(10,2)) * CAST(1.5 AS DECIMAL(2,1)) AS unit_cost,
               CAST(l.l_extendedprice AS DECIMAL(14,2))
                 * (CAST(1 AS DECIMAL(4,2)) - CAST(l.l_discount AS DECIMAL(4,2))) AS revenue,
               CAST(p.p_retailprice AS DECIMAL(10,2)) * CAST(1.5 AS DECIMAL(2,1))
                 * CAST(l.l_quantity AS DECIMAL(6,0)) AS cost,
               revenue - cost AS margin
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
        JOIN part p ON l.l_partkey = p.p_partkey JOIN supplier s ON l.l_suppkey = s.s_suppkey""",
    "customers": """
        SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS segment,
               n_name AS city, r_name AS region
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "stores": """
        SELECT n_nationkey AS store_id, n_name AS store_name, r_name AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "products": """
        SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
               CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price,
               CAST(p_retailprice AS DECIMAL(10,2)) * CAST(1.5 AS DECIMAL(2,1)) AS unit_cost,
               5 + p_partkey % 16 AS lead_time_days, 1500 + (p_partkey % 85) * 100 AS order_cost,
               p_size * 5 AS stock_policy, p_size AS stock_coverage
        FROM part""",
    "demand": """
        SELECT l_partkey AS sku, CAST(date_trunc('month', l_shipdate) AS DATE) AS month_start,
               SUM(CAST(l_quantity AS DECIMAL(10,0))) AS units
        FROM lineitem GROUP BY 1, 2""",
    "stock_sheet": """
        SELECT p.product_id, p.category, p.stock_coverage AS stock, p.unit_cost,
               COALESCE(SUM(CASE WHEN d.month_start = DATE '2001-02-01' THEN d.units END), 0) AS m1,
               COALESCE(SUM(CASE WHEN d.month_start = DATE '2001-03-01' THEN d.units END), 0) AS m2,
               COALESCE(SUM(CASE WHEN d.month_start = DATE '2001-04-01' THEN d.units END), 0) AS m3,
               COALESCE(SUM(CASE WHEN d.month_start = DATE '2001-05-01' THEN d.units END), 0) AS m4,
               COALESCE(SUM(CASE WHEN d.month_start = DATE '2001-06-01' THEN d.units END), 0) AS m5,
               COALESCE(SUM(CASE WHEN d.month_start = DATE '2001-07-01' THEN d.units END), 0) AS m6,
               MAX(d.month_start) AS last_movement
        FROM products p LEFT JOIN demand d ON d.sku = p.product_id GROUP BY 1, 2, 3, 4""",
    "stoppages": """
        SELECT event_id AS stoppage_id, CAST(ts AS DATE) AS stop_date, user_id AS machine_id,
               CASE WHEN event_type = 'signup' THEN 'planned' ELSE 'unplanned' END AS stop_type,
               CASE event_type WHEN 'signup' THEN 'planned' WHEN 'error' THEN 'mechanical'
                               WHEN 'click' THEN 'electrical' ELSE 'operational' END AS cause,
               CAST(value AS DECIMAL(12,2)) AS minutes
        FROM events""",
    "machines": """
        SELECT user_id AS machine_id, 9800 + (user_id % 48) * 100 AS hourly_cost,
               120 + 30 * (user_id % 3) AS service_interval_days,
               DATE '2023-06-01' + CAST(user_id % 300 AS INT) AS last_service,
               (79 + user_id % 16) / 100.0 AS performance, (95 + user_id % 5) / 100.0 AS quality
        FROM (SELECT DISTINCT user_id FROM events)""",
    "unplanned": "SELECT * FROM stoppages WHERE stop_type = 'unplanned'",
    "activity": """
        SELECT customer_id, bool_or(sale_date < DATE '2000-01-01') AS in_base,
               bool_or(sale_date >= DATE '2000-01-01') AS in_next,
               SUM(CASE WHEN sale_date < DATE '2000-01-01' THEN margin END) AS margin_base
        FROM sales WHERE sale_date >= DATE '1999-01-01' AND sale_date < DATE '2001-01-01' GROUP BY 1""",
    "negative": """
        SELECT product_id, SUM(qty) AS units, round(SUM(revenue), 2) AS revenue,
               round(SUM(margin), 2) AS margin,
               ((CAST(SUM(discount) * 100 AS BIGINT) * 20 + COUNT(*)) // (2 * COUNT(*))) / CAST(1000 AS DOUBLE) AS avg_discount
        FROM sales GROUP BY 1 HAVING round(SUM(margin), 2) < 0""",
    "rhythm": """
        SELECT product_id, SUM(qty) AS units_total,
               SUM(CASE WHEN sale_date >= DATE '2001-02-01' AND sale_date < DATE '2001-08-01'
                        THEN qty ELSE 0 END) AS units_recent,
               COUNT(DISTINCT strftime(sale_date, '%Y-%m')) AS months_sold
        FROM sales GROUP BY 1""",
    "slow": """
        SELECT p.product_id, p.product_name, p.category, p.unit_cost, units_total, units_recent, months_sold,
               round(CAST(units_recent AS DOUBLE) / 6, 1) AS units_per_month,
               round(CAST(p.unit_cost AS DOUBLE) * (CAST(units_recent AS DOUBLE) / 6) * 3, 0) AS tied_capital
        FROM products p JOIN rhythm USING (product_id) ORDER BY units_recent, product_id LIMIT 8""",
    "store_sums": """
        SELECT store_id, COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT ticket_id) AS tickets,
               SUM(revenue) AS revenue, SUM(margin) AS margin,
               round(CAST(SUM(revenue) AS DOUBLE) / COUNT(DISTINCT ticket_id), 2) AS avg_ticket
        FROM sales GROUP BY 1""",
    "network": """
        SELECT median(avg_ticket) AS med, CAST(SUM(margin) AS DOUBLE) / CAST(SUM(revenue) AS DOUBLE) AS share,
               (SELECT COUNT(DISTINCT strftime(sale_date, '%Y-%m')) FROM sales) AS months
        FROM store_sums""",
    "gaps": """
        SELECT store_id, store_name, tickets, avg_ticket, med AS median_ticket,
               round(avg_ticket - med, 3) AS gap, round(100.0 * (avg_ticket - med) / med, 1) AS gap_pct,
               round(greatest(med - avg_ticket, 0) * tickets * share * 0.5, 2) AS gain,
               round(greatest(med - avg_ticket, 0) * tickets * share * 0.5 * 12 / months, 2) AS gain_per_year
        FROM store_sums JOIN stores USING (store_id), network""",
    "rfm_ranked": """
        SELECT *, COUNT(*) OVER () AS n,
               row_number() OVER (ORDER BY recency, customer_id) AS rr,
               row_number() OVER (ORDER BY frequency, customer_id) AS rf,
               row_number() OVER (ORDER BY monetary, customer_id) AS rm
        FROM (SELECT customer_id, date_diff('day', MAX(sale_date), (SELECT MAX(sale_date) FROM sales) + 1) AS recency,
                     COUNT(DISTINCT ticket_id) AS frequency, SUM(revenue) AS monetary, SUM(margin) AS margin
              FROM sales GROUP BY 1)""",
    "rfm_bins": """
        SELECT customer_id, recency, frequency, monetary, margin,
               6 - greatest(1, CAST(ceil(5.0 * (rr - 1) / (n - 1)) AS INT)) AS r,
               greatest(1, CAST(ceil(5.0 * (rf - 1) / (n - 1)) AS INT)) AS f,
               greatest(1, CAST(ceil(5.0 * (rm - 1) / (n - 1)) AS INT)) AS m
        FROM rfm_ranked""",
    "rfm": """
        SELECT *, CASE WHEN r >= 4 AND fm >= 4 THEN 'Campeones' WHEN r >= 3 AND fm >= 3 THEN 'Leales'
                       WHEN r >= 4 AND fm <= 2 THEN 'Potenciales'
                       WHEN r = 3 AND fm <= 2 THEN 'Necesitan atención'
                       WHEN r <= 2 AND fm >= 3 THEN 'En riesgo' ELSE 'Hibernando / Perdidos' END AS segment
        FROM (SELECT *, CAST(round_even((f + m) / 2.0, 0) AS INT) AS fm FROM rfm_bins)""",
    "segments": """
        SELECT segment, COUNT(*) AS customers, round_even(CAST(SUM(margin) AS DOUBLE), 0) AS margin_total,
               round_even(CAST(SUM(monetary) AS DOUBLE) / COUNT(*), 0) AS monetary_mean
        FROM rfm GROUP BY 1""",
    "stats": """
        SELECT sku, demand_avg, demand_std, demand_sum,
               demand_std / CASE WHEN demand_avg = 0 THEN 1 ELSE demand_avg END AS cv
        FROM (SELECT sku, CAST(SUM(units) AS DOUBLE) / COUNT(units) AS demand_avg,
                     sqrt(CAST(COUNT(units) * SUM(CAST(units AS HUGEINT) * CAST(units AS HUGEINT)) - CAST(SUM(units) AS HUGEINT) * CAST(SUM(units) AS HUGEINT) AS DOUBLE)
                          / nullif(CAST(COUNT(units) * (COUNT(units) - 1) AS DOUBLE), 0)) AS demand_std,
                     SUM(units) AS demand_sum
              FROM demand GROUP BY 1)""",
    "abc": """
        SELECT *, CASE WHEN running <= 0.80 * total THEN 'A' WHEN running <= 0.95 * total THEN 'B' ELSE 'C' END AS abc
        FROM (SELECT sku, revenue, SUM(revenue) OVER (ORDER BY revenue DESC, sku ROWS UNBOUNDED PRECEDING) AS running,
                     SUM(revenue) OVER () AS total
              FROM (SELECT d.sku, SUM(d.units * p.unit_price) AS revenue
                    FROM demand d JOIN products p ON p.product_id = d.sku GROUP BY 1))""",
    "classed": """
        SELECT sku, product_name AS name, category, abc, xyz, abc || xyz AS class, cv, revenue, running, total,
               demand_avg, demand_std, lead_time_days, order_cost, stock_policy AS stock_on_hand,
               unit_cost, unit_price
        FROM abc JOIN (SELECT *, CASE WHEN cv < 0.30 THEN 'X' WHEN cv < 0.60 THEN 'Y' ELSE 'Z' END AS xyz
                       FROM stats) USING (sku)
        JOIN products ON product_id = sku""",
    "sized": """
        SELECT *, CAST(round_even(greatest(ss, 0), 0) AS BIGINT) AS safety_stock,
               CAST(round_even(greatest(demand_avg * lt + ss, 0), 0) AS BIGINT) AS reorder_point,
               CAST(round_even(eoq, 0) AS BIGINT) AS order_quantity,
               CAST(round_even(greatest(demand_avg * lt + ss + eoq / 2, 0), 0) AS BIGINT) AS optimal_stock
        FROM (SELECT *, z_score * COALESCE(demand_std, 0) * sqrt(lt) AS ss,
                     sqrt(2.0 * (demand_avg * 12) * order_cost
                          / CASE WHEN unit_cost = 0 THEN 1 ELSE CAST(unit_cost AS DOUBLE) * 0.25 END) AS eoq
              FROM (SELECT *, CAST(lead_time_days AS DOUBLE) / 30 AS lt FROM levelled))""",
    "policy": """
        SELECT *, greatest(stock_on_hand - (reorder_point + order_quantity), 0) AS excess_units,
               greatest(reorder_point - stock_on_hand, 0) AS deficit_units,
               stock_on_hand < reorder_point AS below_reorder_point,
               greatest(stock_on_hand - (reorder_point + order_quantity), 0) * unit_cost AS tied_capital,
               greatest(reorder_point - stock_on_hand, 0) * unit_price AS sales_at_risk
        FROM sized""",
    "frequency": """
        SELECT *, greatest(order_cost * (12 - orders_optimal), 0) AS order_saving
        FROM (SELECT *, least(demand_avg * 12 / CASE WHEN order_quantity = 0 THEN 1 ELSE order_quantity END, 52)
                        AS orders_optimal FROM policy)""",
    "covered": """
        SELECT *, CASE WHEN cover_days < 7 THEN 'QUIEBRE' WHEN cover_days < 14 THEN 'CRÍTICO'
                       WHEN cover_days <= 90 THEN 'NORMAL' WHEN cover_days <= 180 THEN 'SOBRESTOCK'
                       ELSE 'STOCK MUERTO' END AS state
        FROM (SELECT *, COALESCE(CAST(stock AS DOUBLE) / nullif(mean_monthly / 30, 0), 9999) AS cover_days
              FROM (SELECT *, m1 + m2 + m3 + m4 + m5 + m6 AS sold,
                           CAST(m1 + m2 + m3 + m4 + m5 + m6 AS DOUBLE) / 6 AS mean_monthly,
                           CAST(stock * unit_cost AS DOUBLE) AS capital FROM stock_sheet))""",
    "acted": """
        SELECT *, CASE state WHEN 'QUIEBRE' THEN 'REPOSICIÓN URGENTE' WHEN 'CRÍTICO' THEN 'Revisar orden de compra'
                             WHEN 'NORMAL' THEN 'Stock en niveles óptimos' WHEN 'SOBRESTOCK' THEN 'Reducir próxima compra'
                             ELSE 'LIQUIDAR / DEVOLVER' END AS action FROM covered""",
    "costed": """
        SELECT u.*, m.hourly_cost, round_even(CAST(minutes * hourly_cost AS DOUBLE) / 60, 0) AS cost
        FROM stoppages u LEFT JOIN machines m USING (machine_id)""",
    "machine_hours": """
        SELECT m.*, COALESCE(CAST(SUM(u.minutes) AS DOUBLE) / 60, 0) AS hours
        FROM machines m LEFT JOIN unplanned u USING (machine_id) GROUP BY ALL""",
    "effect": """
        SELECT *, availability * performance * quality AS oee
        FROM (SELECT machine_id, hours, CAST(performance AS DOUBLE) AS performance,
                     CAST(quality AS DOUBLE) AS quality,
                     least(greatest((720.0 - hours) / 720.0, 0.0), 1.0) AS availability FROM machine_hours)""",
}

# Views that only exist with a parameter filled in.
FLAT_LEVEL = "SELECT *, CAST(1.645 AS DOUBLE) AS z_score FROM classed"
LEVEL_BY_CLASS = """SELECT *, CAST(CASE class WHEN 'AX' THEN 2.054 WHEN 'CZ' THEN 1.282 ELSE 1.645 END
                    AS DOUBLE) AS z_score FROM classed"""


def _even(total: str) -> str:
    return f"round_even(CAST({total} AS DOUBLE), 0)"


def _pareto(key: str) -> str:
    return f"""
        SELECT {key}, row_number() OVER (ORDER BY minutes DESC, {key}) AS rank,
               CAST(minutes AS DOUBLE) / 60 AS hours,
               CAST(minutes AS DOUBLE) / CAST(SUM(minutes) OVER () AS DOUBLE) AS share,
               CAST(SUM(minutes) OVER (ORDER BY minutes DESC, {key} ROWS UNBOUNDED PRECEDING) AS DOUBLE)
                 / CAST(SUM(minutes) OVER () AS DOUBLE) AS cumulative_share
        FROM (SELECT {key}, SUM(minutes) AS minutes FROM unplanned GROUP BY 1)"""


def _kpis(dim: str) -> str:
    return f"""
        SELECT {dim}, round_even(CAST(SUM(revenue) AS DOUBLE), 0) AS revenue,
               round_even(CAST(SUM(margin) AS DOUBLE), 0) AS margin, COUNT(DISTINCT ticket_id) AS tickets,
               round_even(CAST(SUM(margin) AS DOUBLE) / CAST(SUM(revenue) AS DOUBLE) * 100, 1) AS margin_pct
        FROM sales JOIN stores USING (store_id) GROUP BY 1"""


PRICED = "SELECT *, round(list_price * (1 - discount), 2) AS unit_price FROM sales"
CHURN = """
    SELECT COUNT(*) FILTER (in_base AND NOT in_next) AS lost_customers,
           COUNT(*) FILTER (in_base) AS base_customers,
           round(100.0 * COUNT(*) FILTER (in_base AND NOT in_next) / COUNT(*) FILTER (in_base), 1) AS churn_pct,
           CAST(round(SUM(margin_base) FILTER (in_base AND NOT in_next), 2) AS DOUBLE) AS margin_lost
    FROM activity"""
NEGATIVE_IMPACT = """
    SELECT CAST(COALESCE(SUM(abs(margin)), 0) AS DOUBLE) AS recoverable,
           round(CAST(COALESCE(SUM(abs(margin)), 0) AS DOUBLE)
                 / (SELECT COUNT(DISTINCT strftime(sale_date, '%Y-%m')) FROM sales) * 12, 2) AS impact
    FROM negative"""

# query -> (views in order of use, body)
BODIES: dict[str, tuple[str, str]] = {
    "discounted_price": ("sales", f"""
        SELECT ticket_id, product_id, line_number, CAST(list_price AS DOUBLE) AS list_price,
               CAST(discount AS DOUBLE) AS discount, CAST(unit_price AS DOUBLE) AS unit_price FROM ({PRICED})"""),
    "line_margin": ("sales", f"""
        SELECT ticket_id, product_id, line_number, CAST(qty AS BIGINT) AS qty,
               CAST(unit_price AS DOUBLE) AS unit_price, CAST(unit_cost AS DOUBLE) AS unit_cost,
               CAST(revenue AS DOUBLE) AS revenue, CAST(cost AS DOUBLE) AS cost,
               CAST(revenue - cost AS DOUBLE) AS margin
        FROM (SELECT ticket_id, product_id, line_number, qty, unit_price, unit_cost,
                     round(unit_price * qty, 2) AS revenue, round(unit_cost * qty, 2) AS cost FROM ({PRICED}))"""),
    "negative_margin_lines": ("sales",
        "SELECT COUNT(*) AS lines, COUNT(*) FILTER (margin < 0) AS negative_lines FROM sales"),
    "margin_pct": ("sales", """
        SELECT category, round(100.0 * CAST(SUM(margin) AS DOUBLE) / CAST(SUM(revenue) AS DOUBLE), 1) AS margin_pct,
               round_even(CAST(SUM(margin) AS DOUBLE) / CAST(SUM(revenue) AS DOUBLE) * 100, 1) AS margin_pct_half_even
        FROM sales GROUP BY 1"""),
    "profile": ("sales", """
        SELECT COUNT(*) AS sale_lines, MIN(sale_date) AS first_date, MAX(sale_date) AS last_date,
               (SELECT COUNT(*) FROM customer) AS customers, (SELECT COUNT(*) FROM part) AS products,
               (SELECT COUNT(*) FROM nation) AS stores,
               CAST(round(SUM(revenue), 0) AS DOUBLE) AS revenue, CAST(round(SUM(margin), 0) AS DOUBLE) AS margin,
               round(100.0 * CAST(SUM(margin) AS DOUBLE) / CAST(SUM(revenue) AS DOUBLE), 1) AS margin_pct
        FROM sales"""),
    "period_slice": ("sales", """
        SELECT COUNT(*) AS lines, COUNT(DISTINCT customer_id) AS customers, CAST(SUM(revenue) AS DOUBLE) AS revenue
        FROM sales WHERE sale_date >= DATE '1999-01-01' AND sale_date < DATE '2000-01-01'"""),
    "negative_margin_products": ("sales products negative", """
        SELECT product_id, product_name, category, CAST(units AS BIGINT) AS units,
               CAST(revenue AS DOUBLE) AS revenue, CAST(margin AS DOUBLE) AS margin, avg_discount,
               CAST(abs(margin) AS DOUBLE) AS recoverable
        FROM negative JOIN products USING (product_id)"""),
    "slow_movers": ("sales products rhythm slow", """
        SELECT product_id, product_name, category, CAST(unit_cost AS DOUBLE) AS unit_cost,
               CAST(units_total AS BIGINT) AS units_total, CAST(units_recent AS BIGINT) AS units_recent,
               months_sold, units_per_month, tied_capital FROM slow"""),
    "customer_churn": ("sales activity", CHURN),
    "churned_customer_list": ("sales customers activity", """
        SELECT customer_id, customer_name, segment, region, CAST(round(margin_base, 2) AS DOUBLE) AS margin_base
        FROM activity LEFT JOIN customers USING (customer_id) WHERE in_base AND NOT in_next"""),
    "retained_customers": ("sales activity", """
        SELECT customer_id, CAST(round(margin_base, 2) AS DOUBLE) AS margin_base
        FROM activity WHERE in_base AND in_next"""),
    "sales_of_members": ("sales customers", """
        SELECT segment, COUNT(*) AS lines, CAST(SUM(revenue) AS DOUBLE) AS revenue
        FROM sales JOIN customers USING (customer_id) WHERE region = 'EUROPE' GROUP BY 1"""),
    "store_ticket": ("sales stores store_sums", """
        SELECT CAST(store_id AS BIGINT) AS store_id, store_name, region, customers, tickets,
               CAST(round(revenue, 0) AS DOUBLE) AS revenue, CAST(round(margin, 0) AS DOUBLE) AS margin, avg_ticket
        FROM store_sums JOIN stores USING (store_id)"""),
    "store_gap": ("sales stores store_sums network gaps",
        "SELECT * REPLACE (CAST(store_id AS BIGINT) AS store_id) FROM gaps"),
    "store_gap_trend": ("sales", """
        SELECT month, CAST(store_id AS BIGINT) AS store_id, avg_ticket, med AS median_ticket,
               round(avg_ticket - med, 3) AS gap, round(100.0 * (avg_ticket - med) / med, 1) AS gap_pct
        FROM (SELECT *, median(avg_ticket) OVER (PARTITION BY month) AS med
              FROM (SELECT CAST(date_trunc('month', sale_date) AS DATE) AS month, store_id,
                           round(CAST(SUM(revenue) AS DOUBLE) / COUNT(DISTINCT ticket_id), 2) AS avg_ticket
                    FROM sales GROUP BY 1, 2))"""),
    "sales_enriched": ("sales customers stores", """
        SELECT ticket_id, product_id, customer_id, CAST(s.store_id AS BIGINT) AS store_id,
               strftime(sale_date, '%Y-%m') AS period, segment, city, c.region AS region, store_name,
               st.region AS region_store, category, CAST(qty AS BIGINT) AS qty,
               CAST(revenue AS DOUBLE) AS revenue, CAST(margin AS DOUBLE) AS margin
        FROM sales s LEFT JOIN customers c USING (customer_id) LEFT JOIN stores st ON st.store_id = s.store_id"""),
    "monthly_kpis": ("sales", """
        SELECT period, round_even(revenue, 0) AS revenue, round_even(margin, 0) AS margin, tickets, customers,
               round_even(margin / revenue * 100, 1) AS margin_pct, round_even(revenue / tickets, 0) AS avg_ticket,
               round_even((revenue / lag(revenue) OVER (ORDER BY period) - 1) * 100, 1) AS revenue_change_pct
        FROM (SELECT strftime(sale_date, '%Y-%m') AS period, CAST(SUM(revenue) AS DOUBLE) AS revenue,
                     CAST(SUM(margin) AS DOUBLE) AS margin, COUNT(DISTINCT ticket_id) AS tickets,
                     COUNT(DISTINCT customer_id) AS customers FROM sales GROUP BY 1)"""),
    "yearly_kpis": ("sales", """
        SELECT period, round_even(revenue, 0) AS revenue, round_even(margin, 0) AS margin, tickets, customers,
               round_even(margin / revenue * 100, 1) AS margin_pct, round_even(revenue / tickets, 0) AS avg_ticket
        FROM (SELECT strftime(sale_date, '%Y') AS period, CAST(SUM(revenue) AS DOUBLE) AS revenue,
                     CAST(SUM(margin) AS DOUBLE) AS margin, COUNT(DISTINCT ticket_id) AS tickets,
                     COUNT(DISTINCT customer_id) AS customers FROM sales GROUP BY 1)"""),
    "loaded_star": ("sales customers products stores", """
        SELECT CAST(store_id AS VARCHAR) AS store_id, store_name, COUNT(*) AS lines, COUNT(DISTINCT customer_id) AS customers,
               MIN(sale_date) AS first_date, CAST(SUM(CAST(revenue AS DECIMAL(16,2))) AS DOUBLE) AS revenue,
               CAST(SUM(CAST(margin AS DECIMAL(16,2))) AS DOUBLE) AS margin,
               COUNT(DISTINCT CASE WHEN product_id % 3 = 0 THEN product_id END) AS thin_products
        FROM sales JOIN stores USING (store_id) WHERE customer_id IN (SELECT customer_id FROM customers) GROUP BY 1, 2"""),
    "loaded_inventory": ("demand products", """
        SELECT CAST(product_id AS VARCHAR) AS sku, product_name AS name, COUNT(*) AS months, CAST(SUM(units) AS BIGINT) AS units,
               MIN(month_start) AS first_month, CAST(stock_policy AS INTEGER) AS stock_on_hand, CAST(lead_time_days AS INTEGER) AS lead_time_days
        FROM demand JOIN products ON product_id = sku GROUP BY 1, 2, 6, 7"""),
    "loaded_plant": ("stoppages machines", f"""
        SELECT machine_id, COALESCE(CAST(SUM(minutes_) AS DOUBLE) / 60, 0) AS hours, CAST(hourly_cost AS BIGINT) AS hourly_cost,
               machine_id % {len(MACHINE_RATES) + 1} <> {len(MACHINE_RATES)} AS rated
        FROM machines LEFT JOIN (
            SELECT machine_id, CAST((CAST(minutes * 100 AS BIGINT) + 30) // 60 AS DECIMAL(12,0)) * CAST(0.6 AS DECIMAL(2,1)) AS minutes_
            FROM stoppages WHERE stop_type = 'unplanned') USING (machine_id)
        GROUP BY machine_id, hourly_cost"""),
    "mom_change": ("sales", """
        SELECT period, revenue, lag(revenue) OVER (ORDER BY period) AS previous_revenue,
               round_even((revenue / lag(revenue) OVER (ORDER BY period) - 1) * 100, 1) AS change_pct
        FROM (SELECT strftime(sale_date, '%Y-%m') AS period, CAST(SUM(revenue) AS DOUBLE) AS revenue
              FROM sales GROUP BY 1)"""),
    "kpis_by_store": ("sales stores", _kpis("store_name")),
    "kpis_by_category": ("sales stores", _kpis("category")),
    "rfm_scores": ("sales rfm_ranked rfm_bins rfm", """
        SELECT customer_id, recency, frequency, CAST(monetary AS DOUBLE) AS monetary,
               CAST(margin AS DOUBLE) AS margin, r, f, m, fm, segment,
               CASE segment WHEN 'Campeones' THEN 'Fidelizar: programa VIP y acceso anticipado'
                            WHEN 'Leales' THEN 'Upsell y recompensas por lealtad'
                            WHEN 'Potenciales' THEN 'Incentivar la segunda compra (frecuencia)'
                            WHEN 'Necesitan atención' THEN 'Ofertas reactivadoras antes de que se enfríen'
                            WHEN 'En riesgo' THEN 'Campaña de recuperación URGENTE (cupón dirigido)'
                            ELSE 'Recuperación de bajo costo; no sobreinvertir' END AS action
        FROM rfm"""),
    "rfm_segment_summary": ("sales rfm_ranked rfm_bins rfm segments", """
        SELECT segment, customers, margin_total, monetary_mean,
               round_even(CAST(customers AS DOUBLE) / CAST(SUM(customers) OVER () AS DOUBLE) * 100, 1) AS pct_customers
        FROM segments"""),
    "rfm_impact": ("sales rfm_ranked rfm_bins rfm segments", """
        SELECT CAST(60 AS BIGINT) AS hours_saved, CAST(270000 AS DOUBLE) AS hours_value,
               CAST(customers AS BIGINT) AS customers_at_risk, round_even(won, 0) AS recoverable,
               round_even(270000 + won, 0) AS total_impact
        FROM (SELECT customers, margin / (months / CAST(12 AS DOUBLE)) * CAST(0.3 AS DOUBLE) AS won
              FROM (SELECT COALESCE(SUM(customers), 0) AS customers, COALESCE(SUM(margin_total), 0) AS margin,
                           (SELECT COUNT(DISTINCT strftime(sale_date, '%Y-%m')) FROM sales) AS months
                    FROM segments WHERE segment = 'En riesgo'))"""),
    "sku_revenue": ("products demand abc", "SELECT sku, CAST(revenue AS DOUBLE) AS revenue FROM abc"),
    "abc_classes": ("products demand abc", """
        SELECT sku, CAST(revenue AS DOUBLE) AS revenue, CAST(revenue AS DOUBLE) / CAST(total AS DOUBLE) AS revenue_share,
               CAST(running AS DOUBLE) / CAST(total AS DOUBLE) AS cumulative_share, abc FROM abc"""),
    "demand_stats": ("demand stats", """
        SELECT sku, demand_avg, demand_std,
               CAST(demand_sum AS BIGINT) AS demand_sum, cv FROM stats"""),
    "xyz_classes": ("demand stats", """
        SELECT sku, cv,
               CASE WHEN cv < 0.30 THEN 'X' WHEN cv < 0.60 THEN 'Y' ELSE 'Z' END AS xyz FROM stats"""),
    "abc_xyz": ("products demand stats abc classed", """
        SELECT sku, name, category, abc, xyz, class, cv, CAST(revenue AS DOUBLE) AS revenue_total,
               CAST(revenue AS DOUBLE) / CAST(total AS DOUBLE) AS revenue_share,
               CAST(running AS DOUBLE) / CAST(total AS DOUBLE) AS cumulative_share FROM classed"""),
    "abc_xyz_matrix": ("products demand stats abc classed", """
        SELECT abc, xyz, COUNT(*) AS skus, CAST(SUM(revenue) AS DOUBLE) AS revenue FROM classed GROUP BY 1, 2"""),
    "abc_share": ("products demand stats abc classed", """
        SELECT abc, skus, revenue, round(CAST(skus AS DOUBLE) / CAST(SUM(skus) OVER () AS DOUBLE) * 100, 6) AS pct_skus,
               round(revenue / SUM(revenue) OVER () * 100, 6) AS pct_revenue
        FROM (SELECT k.abc, COUNT(sku) AS skus, CAST(COALESCE(SUM(revenue), 0) AS DOUBLE) AS revenue
              FROM (VALUES ('A'), ('B'), ('C')) k(abc) LEFT JOIN classed USING (abc) GROUP BY 1)"""),
    "inventory_policy": ("products demand stats abc classed levelled sized policy", """
        SELECT sku, name, category, class, demand_avg, demand_std,
               cv, lead_time_days, safety_stock, reorder_point, order_quantity,
               CAST(stock_on_hand AS BIGINT) AS stock_on_hand, optimal_stock, excess_units,
               CAST(tied_capital AS DOUBLE) AS tied_capital, deficit_units,
               CAST(sales_at_risk AS DOUBLE) AS sales_at_risk, below_reorder_point FROM policy"""),
    "policy_by_service_level": ("products demand stats abc classed levelled_by_class sized policy", """
        SELECT sku, class, z_score, safety_stock, reorder_point, order_quantity, optimal_stock, excess_units,
               deficit_units FROM policy"""),
    "class_with_policy": ("products demand stats abc classed levelled sized policy",
        "SELECT sku, class, below_reorder_point, excess_units FROM policy"),
    "stock_health": ("products demand stats abc classed levelled sized policy", """
        SELECT skus, overstock, below_reorder_point, skus - overstock - below_reorder_point AS healthy,
               round_even(CAST(skus - overstock - below_reorder_point AS DOUBLE) / skus * 100, 1) AS healthy_pct
        FROM (SELECT COUNT(*) AS skus, COUNT(*) FILTER (excess_units > 0) AS overstock,
                     COUNT(*) FILTER (below_reorder_point) AS below_reorder_point FROM policy)"""),
    "inventory_impact": ("products demand stats abc classed levelled sized policy frequency", """
        SELECT *, round(tied_capital + sales_at_risk + order_saving + time_saving, 2) AS total
        FROM (SELECT CAST(SUM(tied_capital) AS DOUBLE) AS tied_capital,
                     CAST(SUM(sales_at_risk) AS DOUBLE) AS sales_at_risk,
                     round(SUM(order_saving), 2) AS order_saving, CAST(270000 AS DOUBLE) AS time_saving,
                     COUNT(*) FILTER (below_reorder_point) AS skus_below_reorder_point,
                     COUNT(*) FILTER (excess_units > 0) AS skus_overstock FROM frequency)"""),
    "eoq_frequency": ("products demand stats abc classed levelled sized policy frequency", """
        SELECT sku, CAST(12 AS BIGINT) AS orders_now, orders_optimal, order_saving FROM frequency"""),
    "eoq_saving_by_class": ("products demand stats abc classed levelled sized policy frequency", """
        SELECT class, COUNT(*) AS skus, round(avg(orders_optimal), 2) AS orders_optimal_mean,
               round(SUM(order_saving), 2) AS order_saving FROM frequency GROUP BY 1"""),
    "top_overstock": ("products demand stats abc classed levelled sized policy", """
        SELECT sku, CAST(tied_capital AS DOUBLE) AS tied_capital FROM policy WHERE policy.tied_capital > 0 ORDER BY policy.tied_capital DESC, sku LIMIT 10"""),
    "top_stockout_risk": ("products demand stats abc classed levelled sized policy", """
        SELECT sku, CAST(sales_at_risk AS DOUBLE) AS sales_at_risk FROM policy WHERE policy.sales_at_risk > 0 ORDER BY policy.sales_at_risk DESC, sku LIMIT 10"""),
    "stock_coverage": ("products demand stock_sheet covered acted", """
        SELECT product_id, category, CAST(stock AS BIGINT) AS stock, mean_monthly, cover_days, state, action
        FROM acted"""),
    "stock_kpis": ("products demand stock_sheet covered acted", """
        SELECT product_id, cover_days, CAST(sold AS DOUBLE) / nullif(CAST(stock AS DOUBLE), 0) AS turnover, capital,
               state, cover_days < 7 AS stockout_alert,
               date_diff('day', last_movement, DATE '2001-08-01') AS days_without_movement, action FROM acted"""),
    "pct_of_total": ("products demand stock_sheet covered", """
        SELECT product_id, CAST(sold AS BIGINT) AS sales,
               CAST(sold AS DOUBLE) / CAST(SUM(sold) OVER () AS DOUBLE) AS share FROM covered"""),
    "coverage_abc": ("products demand stock_sheet covered", """
        SELECT product_id, mean_monthly, CASE WHEN mean_monthly >= p80 THEN 'A' WHEN mean_monthly >= p50 THEN 'B'
               ELSE 'C' END AS abc
        FROM covered, (SELECT quantile_cont(mean_monthly, 0.8) AS p80, quantile_cont(mean_monthly, 0.5) AS p50
                       FROM covered)"""),
    "coverage_state_counts": ("products demand stock_sheet covered", """
        SELECT k.state, COUNT(product_id) AS products, COALESCE(CAST(SUM(stock * unit_cost) AS DOUBLE), 0) AS capital
        FROM (VALUES ('QUIEBRE'), ('CRÍTICO'), ('NORMAL'), ('SOBRESTOCK'), ('STOCK MUERTO')) k(state)
        LEFT JOIN covered USING (state) GROUP BY 1"""),
    "capital_by_category": ("products demand stock_sheet covered", """
        SELECT category, CAST(SUM(stock * unit_cost) AS DOUBLE) AS capital FROM covered GROUP BY 1"""),
    "dead_stock_capital": ("products demand stock_sheet covered", """
        SELECT dead_products, CAST(dead AS DOUBLE) AS dead_capital, CAST(every AS DOUBLE) AS total_capital,
               round(CAST(dead AS DOUBLE) / CAST(every AS DOUBLE) * 100, 1) AS dead_pct
        FROM (SELECT COUNT(*) FILTER (state = 'STOCK MUERTO') AS dead_products,
                     COALESCE(SUM(stock * unit_cost) FILTER (state = 'STOCK MUERTO'), 0) AS dead,
                     SUM(stock * unit_cost) AS every FROM covered)"""),
    "monthly_sales_trend": ("products demand", """
        SELECT strftime(month_start, '%Y-%m') AS month, CAST(SUM(units) AS BIGINT) AS sales
        FROM demand JOIN products ON product_id = sku
        WHERE month_start >= DATE '2001-02-01' AND month_start < DATE '2001-08-01' GROUP BY 1"""),
    "top_capital": ("products demand stock_sheet covered", """
        SELECT product_id, category, capital, state FROM covered ORDER BY capital DESC, product_id LIMIT 10"""),
    "stock_alerts": ("products demand stock_sheet covered acted", """
        SELECT CASE state WHEN 'QUIEBRE' THEN 1 WHEN 'STOCK MUERTO' THEN 2 WHEN 'SOBRESTOCK' THEN 3 ELSE 4 END AS priority,
               state AS alert, product_id, category, cover_days, CAST(stock AS BIGINT) AS stock, capital, action
        FROM acted WHERE state <> 'NORMAL'"""),
    "state_from_label": ("products demand stock_sheet covered", """
        SELECT product_id, CASE product_id % 5 WHEN 0 THEN lower(category) WHEN 1 THEN 'NORMAL / ' || named ELSE named END AS label,
               CASE WHEN product_id % 5 = 0 THEN NULL
                    WHEN product_id % 5 = 1 AND state IN ('SOBRESTOCK', 'STOCK MUERTO') THEN 'NORMAL' ELSE state END AS state
        FROM (SELECT product_id, category, state, '* ' || lower(category) || ' - ' || state || ' !' AS named FROM covered)"""),
    "clean_extract_parts": ("", """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS category,
               CASE WHEN p_size <= 40 THEN p_retailprice END AS price, CAST(p_size AS DOUBLE) AS size
        FROM part WHERE p_size % 10 <> 3 AND p_type IN ('ECONOMY', 'STANDARD', 'PROMO')"""),
    "next_service": ("machines", """
        SELECT machine_id, last_service, last_service + CAST(service_interval_days AS INT) AS next_service,
               date_diff('day', DATE '2024-02-01', last_service + CAST(service_interval_days AS INT)) AS days_left
        FROM machines"""),
    "service_light": ("machines", """
        SELECT machine_id, days_left, CASE WHEN days_left < 0 THEN 'VENCIDO' WHEN days_left < 30 THEN 'URGENTE'
               WHEN days_left < 60 THEN 'PRÓXIMO' ELSE 'OK' END AS light
        FROM (SELECT machine_id, date_diff('day', DATE '2024-02-01',
                     last_service + CAST(service_interval_days AS INT)) AS days_left FROM machines)"""),
    "stoppage_cost": ("stoppages machines costed", """
        SELECT stoppage_id, machine_id, CAST(minutes AS DOUBLE) AS minutes, hourly_cost, cost FROM costed"""),
    "unplanned_stoppages": ("stoppages unplanned", """
        SELECT stoppage_id, stop_date, machine_id, cause, CAST(minutes AS DOUBLE) AS minutes FROM unplanned"""),
    "downtime_by_machine": ("stoppages machines unplanned machine_hours",
        "SELECT machine_id, hours FROM machine_hours"),
    "oee": ("stoppages machines unplanned machine_hours effect", """
        SELECT machine_id, hours, availability, oee,
               CASE WHEN oee >= 0.85 THEN 'Excelente ≥ 85%' WHEN oee >= 0.65 THEN 'Aceptable ≥ 65%'
                    ELSE 'Bajo < 65%' END AS rating FROM effect"""),
    "downtime_kpis": ("stoppages machines unplanned machine_hours effect costed", """
        SELECT (SELECT CAST(SUM(minutes) AS DOUBLE) / 60 FROM unplanned) AS hours, SUM(cost) AS cost,
               COUNT(*) AS events, (SELECT round(avg(oee), 6) FROM effect) AS mean_oee
        FROM costed WHERE stop_type = 'unplanned'"""),
    "critical_share": ("stoppages unplanned", """
        SELECT CAST(part AS DOUBLE) / 60 AS critical_hours, CAST(every AS DOUBLE) / 60 AS total_hours,
               CAST(part AS DOUBLE) / CAST(every AS DOUBLE) AS share
        FROM (SELECT COALESCE(SUM(minutes) FILTER (machine_id IN (3, 6, 7)), 0) AS part, SUM(minutes) AS every
              FROM unplanned)"""),
    "critical_share_top": ("stoppages unplanned", f"""
        SELECT round(SUM(hours), 6) AS critical_hours, MAX(cumulative_share) AS share
        FROM ({_pareto('machine_id')}) WHERE rank <= 3"""),
    "monthly_stoppages": ("stoppages", """
        SELECT strftime(stop_date, '%Y-%m') AS month, stop_type, cause, COUNT(*) AS events,
               CAST(SUM(minutes) AS DOUBLE) / 60 AS hours FROM stoppages GROUP BY 1, 2, 3"""),
    "downtime_pareto_machine": ("stoppages unplanned", f"""
        SELECT *, CASE WHEN rank <= 3 THEN 'Plan preventivo urgente' WHEN rank <= 5 THEN 'Monitorear'
                  ELSE 'Sin intervención prioritaria' END AS plan FROM ({_pareto('machine_id')})"""),
    "downtime_pareto_cause": ("stoppages unplanned", f"""
        SELECT *, CASE WHEN rank = 1 THEN 'Causa principal'
                       WHEN cumulative_share <= 0.80 THEN 'Top 3 — 80 % del downtime'
                       ELSE 'Causa secundaria' END AS label FROM ({_pareto('cause')})"""),
    "impact_negative_margin": ("sales negative", NEGATIVE_IMPACT),
    "impact_slow_movers": ("sales products rhythm slow", """
        SELECT COALESCE(SUM(tied_capital), 0) AS impact,
               round(COALESCE(SUM(tied_capital), 0) * 0.08, 2) AS impact_per_year FROM slow"""),
    "impact_churn": ("sales activity", f"""
        SELECT margin_lost, round(margin_lost * CAST(0.3 AS DOUBLE), 2) AS impact FROM ({CHURN})"""),
    "findings_ranked": ("sales products stores activity negative rhythm slow store_sums network gaps", f"""
        SELECT CAST(row_number() OVER (ORDER BY impact DESC, finding) AS INT) AS rank, finding, impact,
               round(impact / SUM(impact) OVER (), 6) AS share,
               round(SUM(impact) OVER (ORDER BY impact DESC, finding ROWS UNBOUNDED PRECEDING)
                     / SUM(impact) OVER (), 6) AS cumulative_share,
               round(SUM(impact) OVER (), 6) AS total
        FROM (SELECT 'negative_margin' AS finding, impact FROM ({NEGATIVE_IMPACT})
              UNION ALL SELECT 'churn', round(margin_lost * CAST(0.3 AS DOUBLE), 2) FROM ({CHURN})
              UNION ALL (SELECT 'store_gap', gain_per_year FROM gaps ORDER BY gap, store_id LIMIT 1)
              UNION ALL SELECT 'slow_movers', COALESCE(SUM(tied_capital), 0) FROM slow)"""),
    "preventive_saving": ("stoppages machines unplanned", f"""
        SELECT round(h, 6) AS hours, round(h * CAST(0.65 AS DOUBLE), 6) AS hours_saved,
               round(c / h, 6) AS weighted_hourly_cost, round(c * CAST(0.65 AS DOUBLE), 6) AS saving
        FROM (SELECT SUM(hours) AS h, SUM(hours * hourly_cost) AS c
              FROM ({_pareto('machine_id')}) JOIN machines USING (machine_id) WHERE rank <= 3)"""),
    "cause_reduction_saving": ("stoppages unplanned", """
        SELECT 'mechanical' AS cause, round(h, 6) AS hours, round(h * CAST(0.4 AS DOUBLE), 6) AS hours_saved,
               round(h * CAST(0.4 AS DOUBLE) * 12000, 6) AS saving
        FROM (SELECT CAST(SUM(minutes) AS DOUBLE) / 60 AS h FROM unplanned WHERE cause = 'mechanical')"""),
    "orphan_keys": ("", """
        SELECT 'lineitem.l_orderkey->orders' AS relation, COUNT(*) AS orphan_rows FROM lineitem
          WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = l_orderkey)
        UNION ALL SELECT 'lineitem.l_partkey->part', COUNT(*) FROM lineitem
          WHERE NOT EXISTS (SELECT 1 FROM part WHERE p_partkey = l_partkey)
        UNION ALL SELECT 'lineitem.l_suppkey->supplier', COUNT(*) FROM lineitem
          WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = l_suppkey)
        UNION ALL SELECT 'orders.o_custkey->customer', COUNT(*) FROM orders
          WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey)
        UNION ALL SELECT 'orders.o_orderkey->lineitem', COUNT(*) FROM orders
          WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"""),
    "quality_report": ("lines", """
        SELECT 'null_ids' AS rule, COUNT(*) FILTER (ticket_id IS NULL) AS failing_rows FROM lines
        UNION ALL SELECT 'revenue_mismatch', COUNT(*) FILTER (
            CAST(abs(unit_price * qty - revenue) AS DOUBLE) > CAST(0.01 AS DOUBLE) + CAST(0.00001 AS DOUBLE) * CAST(revenue AS DOUBLE))
          FROM lines
        UNION ALL SELECT 'duplicate_rows', (SELECT COUNT(*) FROM lines) - (SELECT COUNT(*) FROM (SELECT DISTINCT * FROM lines))
        UNION ALL SELECT 'orphan_customers', COUNT(*) FROM lines
          WHERE customer_id IS NULL OR customer_id NOT IN (SELECT c_custkey FROM customer)"""),
    "control_totals": ("sales", """
        SELECT total, e.expected, a.actual, a.actual - e.expected AS difference FROM (
            SELECT 'lines' AS total, CAST(COUNT(*) AS DOUBLE) AS expected FROM lineitem
            UNION ALL SELECT 'revenue', CAST(SUM(revenue) AS DOUBLE) FROM sales
            UNION ALL SELECT 'margin', CAST(SUM(margin) AS DOUBLE) FROM sales) e
        JOIN (UNPIVOT (
            SELECT CAST(SUM(n) AS DOUBLE) AS lines, CAST(SUM(r) AS DOUBLE) AS revenue, CAST(SUM(m) AS DOUBLE) AS margin
            FROM (SELECT store_id, COUNT(*) AS n, SUM(revenue) AS r, SUM(margin) AS m FROM sales GROUP BY 1))
            ON lines, revenue, margin INTO NAME total VALUE actual) a USING (total)"""),
    "date_range_check": ("keys customers stores products", """
        SELECT 'dates_out_of_range' AS "check", COUNT(*) FILTER (
            sale_date < DATE '1999-01-01' OR sale_date >= DATE '2001-01-01' OR sale_date IS NULL) AS "rows" FROM keys
        UNION ALL SELECT 'customers_without_sales', COUNT(*) FROM customers
          WHERE customer_id NOT IN (SELECT customer_id FROM keys WHERE customer_id IS NOT NULL)
        UNION ALL SELECT 'products_without_sales', COUNT(*) FROM products
          WHERE product_id NOT IN (SELECT product_id FROM keys WHERE product_id IS NOT NULL)
        UNION ALL SELECT 'stores_without_sales', COUNT(*) FROM stores
          WHERE store_id NOT IN (SELECT store_id FROM keys WHERE store_id IS NOT NULL)"""),
    "saved_star_slice": ("sales", """
        SELECT strftime(sale_date, '%Y-%m') AS sale_month, COUNT(*) AS lines, CAST(SUM(revenue) AS DOUBLE) AS revenue
        FROM sales WHERE sale_date >= DATE '1999-01-01' AND sale_date < DATE '2000-01-01' GROUP BY 1"""),
    "monthly_snapshot": ("stoppages", """
        SELECT period, cause, COUNT(*) AS events, CAST(SUM(minutes) AS DOUBLE) / 60 AS hours
        FROM stoppages, (VALUES ('2024-01'), ('2024-02')) k(period)
        WHERE strftime(stop_date, '%Y-%m') <= period GROUP BY strftime(stop_date, '%Y-%m'), 1, 2"""),
    "published_inventory": ("products demand stats abc classed levelled sized policy", """
        SELECT 'classification' AS "table", sku, class, CAST(revenue AS DOUBLE) AS revenue,
               CAST(NULL AS BIGINT) AS order_quantity, CAST(NULL AS DOUBLE) AS tied_capital, CAST(NULL AS DOUBLE) AS sales_at_risk
        FROM policy
        UNION ALL SELECT 'policy', sku, class, NULL, CAST(order_quantity AS BIGINT), CAST(tied_capital AS DOUBLE),
               CAST(sales_at_risk AS DOUBLE) FROM policy"""),
    "published_report": ("sales stores rfm_ranked rfm_bins rfm", f"""
        SELECT 'monthly' AS report, period AS entry, COUNT(DISTINCT customer_id) AS customers, COUNT(DISTINCT ticket_id) AS tickets,
               {_even('SUM(revenue)')} AS revenue, {_even('SUM(margin)')} AS margin
          FROM (SELECT *, strftime(sale_date, '%Y-%m') AS period FROM sales) GROUP BY period
        UNION ALL SELECT 'by_store', store_name, NULL, COUNT(DISTINCT ticket_id), {_even('SUM(revenue)')}, {_even('SUM(margin)')}
          FROM sales JOIN stores USING (store_id) GROUP BY store_name
        UNION ALL SELECT 'by_category', category, NULL, COUNT(DISTINCT ticket_id), {_even('SUM(revenue)')}, {_even('SUM(margin)')}
          FROM sales GROUP BY category
        UNION ALL SELECT 'segments', segment, COUNT(*), NULL, NULL, {_even('SUM(margin)')} FROM rfm GROUP BY segment
        UNION ALL SELECT 'customers', CAST(customer_id AS VARCHAR), NULL, frequency, CAST(monetary AS DOUBLE), CAST(margin AS DOUBLE) FROM rfm"""),
}

LINES = """
        SELECT l_orderkey AS ticket_id, l_linenumber AS line_number, o_custkey AS customer_id,
               CAST(l_quantity AS DECIMAL(5,0)) AS qty,
               CAST(CAST(CAST(round(l_extendedprice * 100) AS BIGINT) // CAST(l_quantity AS BIGINT) AS DECIMAL(14,0)) * 0.01 AS DECIMAL(12,2)) AS unit_price,
               CAST(l_extendedprice AS DECIMAL(14,2)) AS revenue
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey"""

#: Keys of every line, those without an order or a supplier included.
KEYS = """
        SELECT CAST(o_orderdate AS DATE) AS sale_date, o_custkey AS customer_id, l_partkey AS product_id, s_nationkey AS store_id
        FROM lineitem LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN supplier ON l_suppkey = s_suppkey"""

_SOURCES = {
    **VIEWS,
    "lines": LINES,
    "keys": KEYS,
    "levelled": FLAT_LEVEL,
    "levelled_by_class": LEVEL_BY_CLASS,
}
_NAMES = {"levelled_by_class": "levelled"}


def sql(name: str) -> str:
    views, body = BODIES[name]
    ctes = [f"{_NAMES.get(v, v)} AS ({_SOURCES[v]})" for v in views.split()]
    return ("WITH " + ",\n".join(ctes) + "\n" if ctes else "") + body


def oracle_sql() -> dict[str, str]:
    return {name: sql(name) for name in BODIES}
