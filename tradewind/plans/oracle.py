"""Independent SQL for the registered queries, for a single-process SQL engine on the same files."""

from __future__ import annotations

import re

# Shared sub-queries; ``sql`` puts the ones a statement mentions in front of it.
CTES = {
    "f_sales": """
        SELECT CAST(o_custkey AS VARCHAR) AS customer_num, c_name AS customer_name, p_type AS srp_1_desc,
               substring(p_brand, 7) AS srp_2_code, p_brand AS srp_2_desc, p_name AS srp_3_desc,
               CAST(o_orderkey AS VARCHAR) AS dtl_invoice_num, CAST(o_orderkey AS VARCHAR) AS dtl_order_num,
               l_linenumber AS dtl_line_num, CAST(o_orderdate AS DATE) AS dtl_invoice_dt,
               CAST(o_orderdate AS DATE) AS dtl_order_dt, CAST(l_shipdate AS DATE) AS dtl_actual_ship_dt, CAST(l_quantity AS BIGINT) AS dtl_qty_ordered,
               l_extendedprice AS dtl_extended_price, l_extendedprice / l_quantity AS dtl_unit_price,
               p_retailprice AS dtl_unit_cost, l_discount + 0.0 AS total_discount, l_linestatus AS dtl_line_type,
               l_returnflag AS dtl_value_package, n_name AS state, r_name AS county,
               c_mktsegment AS customer_price_group
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey
        WHERE o_orderstatus IN ('F', 'O')""",
    "f_before": "SELECT * FROM f_sales WHERE dtl_invoice_dt <= DATE '1999-12-31'",
    "f_after": "SELECT * FROM f_sales WHERE dtl_invoice_dt > DATE '1999-12-31'",
    "f_opps": """
        SELECT CAST(o_custkey AS VARCHAR) AS customer_num, CAST(o_orderkey AS VARCHAR) AS opp_id, p_brand AS srp_2_desc,
               min(p_type) AS family, CASE WHEN o_orderstatus = 'F' THEN 'True' ELSE 'False' END AS iswon,
               CASE WHEN o_orderstatus = 'F' THEN 'Closed Won' ELSE 'Closed Lost' END AS stagename,
               CAST(o_orderdate AS DATE) AS create_dt, max(CAST(l_shipdate AS DATE)) AS close_dt,
               round(sum(l_extendedprice), 2) AS amount
        FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        WHERE o_orderstatus IN ('F', 'P')
        GROUP BY o_custkey, o_orderkey, p_brand, o_orderstatus, o_orderdate""",
    "f_opps_before": "SELECT * FROM f_opps WHERE create_dt <= DATE '1999-12-31'",
    "f_rentals": """
        SELECT CAST(o_custkey AS VARCHAR) AS customer_num, p_brand AS srp_2_desc, substring(p_brand, 7) AS srp_2_code,
               CAST(l_shipdate AS DATE) AS billing_from_dt, CAST(l_quantity AS BIGINT) AS bill_days,
               l_extendedprice AS extended_amount
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
        WHERE l_returnflag = 'R'""",
    "f_baseline": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_num, CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_name END AS customer_name,
               CASE WHEN c_acctbal >= 0 THEN 'Y' ELSE 'N' END AS active_cust_yn, c_mktsegment AS customer_class,
               concat('PG', CAST(c_nationkey % 4 AS VARCHAR)) AS customer_price_group,
               concat('T', CAST(c_custkey % 3 AS VARCHAR)) AS customer_type
        FROM customer WHERE c_custkey % 10 <> 3""",
    "f_crosswalk": """
        SELECT CAST(c_custkey AS VARCHAR) AS customer_num, CAST(c_custkey AS VARCHAR) AS definitive_id, c_name AS customer_name
        FROM customer WHERE c_custkey % 2 = 0""",
    "f_external": """
        SELECT CAST(s_suppkey AS VARCHAR) AS definitive_id, s_name AS customer_name,
               CASE WHEN s_suppkey % 7 = 0 THEN NULL ELSE CAST(s_suppkey % 97 AS DOUBLE) END AS staffed_beds,
               s_acctbal AS net_income, r_name AS hospital_type
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "f_curated_raw": """
        SELECT concat(lpad(CAST(n AS VARCHAR), 3, '0'), ' ', p_brand) AS code_srp_2_desc, CAST(n AS VARCHAR) AS srp_2_code,
               concat('PT', CAST(n % 4 AS VARCHAR)) AS product_type, CASE WHEN n > 20 THEN 'N' ELSE 'Y' END AS active,
               CASE WHEN n > 20 THEN concat(lpad(CAST(n - 20 AS VARCHAR), 3, '0'), ' Brand#', CAST(n - 20 AS VARCHAR)) END AS replacement,
               CASE WHEN n > 20 THEN concat(CAST(n - 20 AS VARCHAR), '.0') WHEN n % 2 = 0 THEN '0' END AS replacement_srp_2_code,
               CASE WHEN n <= 22 THEN r_name ELSE '*BLANK*' END AS location
        FROM (SELECT DISTINCT p_brand, CAST(substring(p_brand, 7) AS INTEGER) AS n FROM part) JOIN region ON n % 5 = r_regionkey""",
    "f_curated": """
        SELECT substring(code_srp_2_desc, 5) AS srp_2_desc, srp_2_code, product_type, active, replacement,
               CASE WHEN replacement_srp_2_code IS NULL OR CAST(CAST(replacement_srp_2_code AS DOUBLE) AS BIGINT) = 0 THEN srp_2_code
                    ELSE CAST(CAST(CAST(replacement_srp_2_code AS DOUBLE) AS BIGINT) AS VARCHAR) END AS replacement_srp_2_code,
               CASE WHEN replacement IS NULL THEN substring(code_srp_2_desc, 5) ELSE substring(replacement, 5) END AS updated,
               nullif(location, '*BLANK*') AS location
        FROM f_curated_raw""",
    "f_catalog": "SELECT DISTINCT p_type AS srp_1_desc, substring(p_brand, 7) AS srp_2_code, p_brand AS srp_2_desc, p_name AS srp_3_desc FROM part",
    "f_raw": """
        SELECT l_orderkey, l_partkey, l_linenumber,
               CASE WHEN l_linenumber = 1 THEN '~' WHEN l_linenumber = 2 THEN 'nan'
                    WHEN l_linenumber = 3 THEN concat(CAST(CAST(round(l_discount * 100, 0) AS BIGINT) AS VARCHAR), '%')
                    ELSE concat(CAST(CAST(floor(l_extendedprice / 1000) AS BIGINT) AS VARCHAR), ',',
                                lpad(CAST(CAST(floor(l_extendedprice) AS BIGINT) % 1000 AS VARCHAR), 3, '0')) END AS amount_text
        FROM lineitem""",
    "f_amounts": """
        SELECT l_orderkey, l_partkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
               CASE WHEN amount_text IN ('~', 'nan') THEN NULL ELSE CAST(replace(replace(amount_text, ',', ''), '%', '') AS DOUBLE) END AS amount_text
        FROM f_raw""",
    "f_invoices": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_num, srp_2_desc, dtl_invoice_num
            ORDER BY dtl_line_num, dtl_invoice_dt, dtl_qty_ordered, dtl_unit_cost, dtl_line_type, dtl_value_package) AS rn FROM f_sales) WHERE rn = 1""",
    "f_inv_before": "SELECT DISTINCT customer_num, srp_2_desc, dtl_invoice_num, dtl_invoice_dt FROM f_before",
    "f_last_next": """
        SELECT customer_num, srp_2_desc, max(dtl_invoice_dt) FILTER (WHERE dtl_invoice_dt <= DATE '1999-12-31') AS last_dt,
               min(dtl_invoice_dt) FILTER (WHERE dtl_invoice_dt > DATE '1999-12-31') AS next_dt
        FROM f_sales GROUP BY ALL HAVING last_dt IS NOT NULL""",
    "f_lags": """
        SELECT customer_num, srp_2_desc, dtl_invoice_num, dtl_invoice_dt, lag(dtl_invoice_dt, 1) OVER w AS inv_1, lag(dtl_invoice_dt, 2) OVER w AS inv_2,
               lag(dtl_invoice_dt, 3) OVER w AS inv_3, lag(dtl_invoice_dt, 4) OVER w AS inv_4, lag(dtl_invoice_dt, 5) OVER w AS inv_5
        FROM f_inv_before WINDOW w AS (PARTITION BY customer_num, srp_2_desc ORDER BY dtl_invoice_dt, dtl_invoice_num)""",
    "f_gaps": """
        SELECT customer_num, srp_2_desc, dtl_invoice_num, CAST(dtl_invoice_dt - inv_1 AS BIGINT) AS gap_1, CAST(inv_1 - inv_2 AS BIGINT) AS gap_2,
               CAST(inv_2 - inv_3 AS BIGINT) AS gap_3, CAST(inv_3 - inv_4 AS BIGINT) AS gap_4, CAST(inv_4 - inv_5 AS BIGINT) AS gap_5
        FROM f_lags""",
    "f_gap_stats": "SELECT customer_num, srp_2_desc, avg(gap_1) AS gap_mean, stddev_samp(gap_1) AS gap_std FROM f_gaps GROUP BY ALL",
    "f_nearest": """
        SELECT customer_num, srp_2_desc, dtl_invoice_num, dtl_order_dt, opp_id, close_dt, family, delta FROM (
            SELECT i.customer_num, i.srp_2_desc, i.dtl_invoice_num, i.dtl_invoice_dt AS dtl_order_dt, o.opp_id, o.close_dt, o.family,
                   CAST(abs(o.close_dt - i.dtl_invoice_dt) AS BIGINT) AS delta,
                   row_number() OVER (PARTITION BY i.customer_num, i.srp_2_desc, i.dtl_invoice_num
                                      ORDER BY abs(o.close_dt - i.dtl_invoice_dt), o.opp_id) AS rn
            FROM f_inv_before i JOIN f_opps_before o ON i.customer_num = o.customer_num AND i.srp_2_desc = o.srp_2_desc AND o.iswon = 'True')
        WHERE rn = 1 AND delta <= 90""",
    "f_qty": "SELECT customer_num, srp_2_desc, sum(dtl_qty_ordered) AS qty FROM f_before GROUP BY ALL",
    "f_rating": """
        SELECT customer_num, srp_2_desc, qty / max(qty) OVER (PARTITION BY customer_num) * 2 - 1 AS rating FROM f_qty""",
    "f_rank": """
        SELECT customer_num, srp_2_desc, rating,
               rank() OVER (PARTITION BY customer_num ORDER BY rating DESC) + (count(*) OVER (PARTITION BY customer_num, rating) - 1) / 2.0 AS rank
        FROM f_rating""",
    "f_scored": """
        SELECT customer_num, srp_2_desc, round(total_discount * 10, 2) AS win_prob,
               CASE WHEN round(total_discount * 10, 2) >= 0.5 THEN 'True' ELSE 'False' END AS predicted,
               CASE WHEN dtl_line_type = 'F' THEN 'True' ELSE 'False' END AS truth FROM f_before""",
    "f_signed": "SELECT *, (CASE WHEN predicted = truth THEN win_prob ELSE 1 - win_prob END) * 2 - 1 AS rating FROM f_scored",
    "f_mrr": """
        SELECT a.customer_num, a.srp_2_desc, rank, 1.0 / rank AS reciprocal_rank, coalesce(location, 'Others') AS location
        FROM f_after a JOIN f_rank r ON a.customer_num = r.customer_num AND a.srp_2_desc = r.srp_2_desc
        LEFT JOIN f_curated c ON a.srp_2_desc = c.srp_2_desc""",
    "f_scored_pairs": """
        SELECT customer_num, srp_2_desc, round(rating, 6) AS rating, CAST(substring(srp_2_desc, 7) AS BIGINT) % 2 AS outcome,
               CAST(customer_num AS BIGINT) % 2 AS imputed FROM f_rating""",
    "f_ids": """
        SELECT customer_num, 'CSD' AS source FROM f_before UNION SELECT customer_num, 'SFD' FROM f_opps_before
        UNION SELECT customer_num, 'RSD' FROM f_rentals WHERE billing_from_dt <= DATE '1999-12-31'
        UNION SELECT customer_num, 'CBD' FROM f_baseline UNION SELECT customer_num, 'CWD' FROM f_crosswalk""",
    "f_customers": """
        SELECT customer_num, bool_or(source = 'CBD') AS IN_CBD, bool_or(source = 'CSD') AS IN_CSD, bool_or(source = 'CWD') AS IN_CWD,
               bool_or(source = 'RSD') AS IN_RSD, bool_or(source = 'SFD') AS IN_SFD FROM f_ids GROUP BY ALL""",
    "f_presence": """
        SELECT coalesce(k.customer_num, '') AS customer_num, coalesce(k.definitive_id, e.definitive_id, '') AS definitive_id,
               coalesce(IN_CBD, false) AS IN_CBD, coalesce(IN_CSD, false) AS IN_CSD, coalesce(IN_CWD, false) AS IN_CWD,
               e.definitive_id IS NOT NULL AS IN_EDD, coalesce(IN_RSD, false) AS IN_RSD, coalesce(IN_SFD, false) AS IN_SFD,
               e.customer_name AS edd_name
        FROM (SELECT c.*, w.definitive_id FROM f_customers c LEFT JOIN f_crosswalk w ON c.customer_num = w.customer_num) k
        FULL JOIN f_external e ON k.definitive_id = e.definitive_id""",
    "f_named": """
        SELECT p.*, upper(coalesce(b.customer_name, p.edd_name, s.customer_name, w.customer_name)) AS customer_name
        FROM f_presence p LEFT JOIN f_baseline b ON p.customer_num = b.customer_num
        LEFT JOIN (SELECT DISTINCT customer_num, customer_name FROM f_before) s ON p.customer_num = s.customer_num
        LEFT JOIN f_crosswalk w ON p.customer_num = w.customer_num""",
    "f_key": """
        SELECT concat(customer_num, '_', definitive_id) AS unique_id,
               CASE WHEN customer_num = '' THEN concat('_', definitive_id) ELSE customer_num END AS customer_num, definitive_id, IN_CSD, IN_SFD, IN_EDD, customer_name
        FROM f_named""",
    "f_prod": """
        SELECT c.srp_2_desc, product_type, location, avg_order_amount
        FROM f_curated c LEFT JOIN (SELECT srp_2_desc, avg(dtl_qty_ordered) AS avg_order_amount FROM f_before GROUP BY 1) a ON c.srp_2_desc = a.srp_2_desc""",
    "f_buyers": "SELECT DISTINCT srp_2_desc, customer_num FROM f_before",
    "f_buyer_n": "SELECT srp_2_desc, count(*) AS n FROM f_buyers GROUP BY 1",
    "f_shared": """
        SELECT a.srp_2_desc AS id_i, b.srp_2_desc AS id_j, count(*) AS s FROM f_buyers a JOIN f_buyers b
        ON a.customer_num = b.customer_num AND a.srp_2_desc < b.srp_2_desc GROUP BY ALL""",
    "f_ppairs": """
        SELECT a.srp_2_desc AS id_i, b.srp_2_desc AS id_j,
               CASE WHEN a.product_type = b.product_type THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS product_type,
               CASE WHEN a.location = b.location THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS location,
               coalesce(abs(a.avg_order_amount - b.avg_order_amount) / (1 + abs(a.avg_order_amount - b.avg_order_amount)), 1.0) AS avg_order_amount,
               CASE WHEN na.n IS NULL OR nb.n IS NULL THEN 1.0 ELSE 1.0 - coalesce(s, 0)::DOUBLE / (na.n + nb.n - coalesce(s, 0)) END AS sales_list
        FROM f_prod a JOIN f_prod b ON a.srp_2_desc < b.srp_2_desc
        LEFT JOIN f_buyer_n na ON na.srp_2_desc = a.srp_2_desc LEFT JOIN f_buyer_n nb ON nb.srp_2_desc = b.srp_2_desc
        LEFT JOIN f_shared ON id_i = a.srp_2_desc AND id_j = b.srp_2_desc""",
    "f_pd": "SELECT id_i, id_j, (product_type + 2 * location + 3 * avg_order_amount + 4 * sales_list) / 10 AS d FROM f_ppairs",
    "f_pmir": "SELECT id_i AS a, id_j AS b, d FROM f_pd UNION ALL SELECT id_j, id_i, d FROM f_pd",
    "f_plabel": "SELECT srp_2_desc AS id, CAST(srp_2_code AS BIGINT) % 5 AS cluster FROM f_curated",
    "f_cust": """
        SELECT b.*, CAST(c_nationkey AS BIGINT) AS cluster FROM f_baseline b JOIN customer ON b.customer_num = CAST(c_custkey AS VARCHAR)""",
    "f_cmir": """
        SELECT a.customer_num AS a, b.customer_num AS b, a.cluster AS ca, b.cluster AS cb,
               (CASE WHEN a.customer_class = b.customer_class THEN 0 ELSE 1 END + CASE WHEN a.customer_type = b.customer_type THEN 0 ELSE 2 END
                + CASE WHEN a.active_cust_yn = b.active_cust_yn THEN 0 ELSE 3 END
                + CASE WHEN a.customer_price_group = b.customer_price_group THEN 0 ELSE 2 END)::DOUBLE / 8 AS d
        FROM f_cust a JOIN f_cust b ON a.customer_num <> b.customer_num""",
    "f_features": """
        SELECT c.*, purchase_per_year, avg_order_amount, staffed_beds, net_income, coalesce(hospital_type, 'none') AS hospital_type, sales_list, won_list, lost_list, rental_list
        FROM f_cust c
        LEFT JOIN (SELECT customer_num, sum(dtl_qty_ordered) / nullif(max(dtl_order_dt) - min(dtl_order_dt), 0) * 365 AS purchase_per_year,
                   avg(dtl_qty_ordered) AS avg_order_amount, list_sort(list(DISTINCT srp_2_desc)) AS sales_list FROM f_before GROUP BY 1) s USING (customer_num)
        LEFT JOIN (SELECT customer_num, list_sort(list(DISTINCT srp_2_desc)) AS won_list FROM f_opps_before WHERE iswon = 'True' GROUP BY 1) w USING (customer_num)
        LEFT JOIN (SELECT customer_num, list_sort(list(DISTINCT srp_2_desc)) AS lost_list FROM f_opps_before WHERE iswon = 'False' GROUP BY 1) l USING (customer_num)
        LEFT JOIN (SELECT customer_num, list_sort(list(DISTINCT srp_2_desc)) AS rental_list FROM f_rentals GROUP BY 1) r USING (customer_num)
        LEFT JOIN f_crosswalk k USING (customer_num) LEFT JOIN f_external e ON k.definitive_id = e.definitive_id""",
    "f_fmir": "SELECT x.customer_num AS a, y.customer_num AS b, x.cluster AS ca, y.cluster AS cb, ("
    + " + ".join(
        f"{1 + i % 4} * " + text.format(c=c)
        for i, (c, text) in enumerate(
            [(c, "CASE WHEN x.{c} = y.{c} THEN 0 ELSE 1 END") for c in ("customer_class", "customer_type", "active_cust_yn", "customer_price_group", "hospital_type")]
            + [(c, "coalesce(abs(x.{c} - y.{c}) / (abs(x.{c} - y.{c}) + 1), 1)") for c in ("purchase_per_year", "avg_order_amount", "staffed_beds", "net_income")]
            + [(c, "coalesce(1 - len(list_intersect(x.{c}, y.{c})) / (len(x.{c}) + len(y.{c}) - len(list_intersect(x.{c}, y.{c}))), 1)") for c in ("sales_list", "won_list", "lost_list", "rental_list")]
        )
    )
    + ")::DOUBLE / 31 AS d FROM f_features x JOIN f_features y ON x.customer_num <> y.customer_num",
    "f_lost": "SELECT DISTINCT customer_num FROM f_opps_before WHERE iswon = 'False'",
}


def sql(statement: str) -> str:
    """The statement behind a WITH clause holding every shared sub-query it needs."""
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in CTES:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(CTES[name])
                if name not in needed:
                    needed.append(name)

    visit(statement)
    if not needed:
        return statement
    shared = ", ".join(f"{n} AS ({CTES[n]})" for n in needed)
    own = re.match(r"\s*WITH\s+", statement)
    return f"WITH {shared}, {statement[own.end():]}" if own else f"WITH {shared} {statement}"


def _stat(name: str, frame: str) -> str:
    parts = [
        f"SELECT '{name}' AS name, '{metric}' AS metric, CAST({value} AS BIGINT) AS value FROM {frame}"
        for metric, value in (
            ("n_rows", "count(*)"),
            ("n_customers", "count(DISTINCT customer_num)"),
            ("n_products", "count(DISTINCT srp_2_desc)"),
            ("n_pairs", "count(DISTINCT row(customer_num, srp_2_desc))"),
        )
    ]
    return " UNION ALL ".join(parts)


_TYPED_CORR = """(SELECT dtl_qty_ordered, dtl_unit_cost, dtl_unit_price, dtl_extended_price,
    dense_rank() OVER (ORDER BY srp_1_desc) - 1 AS type_code, dense_rank() OVER (ORDER BY dtl_value_package) - 1 AS package_code FROM f_before)"""
_CORR_COLS = ["dtl_qty_ordered", "dtl_unit_cost", "dtl_unit_price", "dtl_extended_price", "type_code", "package_code"]
_CORR = " UNION ALL ".join(
    f"SELECT '{a}' AS a, '{b}' AS b, abs(corr({a}, {b})) AS abs_corr FROM {_TYPED_CORR}"
    for i, a in enumerate(_CORR_COLS)
    for b in _CORR_COLS[i + 1 :]
)

RELATIONAL = {
    "scan_csv": "SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey, CAST(l_linenumber AS VARCHAR) AS l_linenumber, amount_text FROM f_raw",
    "scan_parquet": "SELECT c_custkey, c_mktsegment FROM customer",
    "write_stage": "SELECT customer_num, srp_2_desc, dtl_invoice_num, dtl_invoice_dt, dtl_qty_ordered FROM f_before",
    "write_partitioned_matrix": """SELECT CAST(c_nationkey AS BIGINT) AS cluster, count(*) AS n_pairs, round(avg(rating), 6) AS mean_rating
        FROM f_rating JOIN customer ON customer_num = CAST(c_custkey AS VARCHAR) GROUP BY ALL""",
    "scan_matrix": """SELECT CAST(c_nationkey AS BIGINT) AS cluster, customer_num, srp_2_desc, round(rating, 6) AS rating
        FROM f_rating JOIN customer ON customer_num = CAST(c_custkey AS VARCHAR) WHERE c_nationkey = 3""",
    "merge_stats": _stat("sales", "f_before") + " UNION ALL " + _stat("rentals", "f_rentals"),
    "rename_columns": "SELECT c_custkey AS customer_num, c_name AS customer_name, c_mktsegment AS customer_class FROM customer",
    "drop_columns": "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders",
    "project": "SELECT customer_num, srp_2_desc, county, dtl_line_type, dtl_unit_cost FROM f_sales",
    "drop_constant_columns": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, (count(DISTINCT {c}) + CASE WHEN count(*) > count({c}) THEN 1 ELSE 0 END) <= 1 AS is_constant FROM f_opps WHERE iswon = 'True'"
        for c in ["customer_num", "opp_id", "srp_2_desc", "family", "iswon", "stagename", "create_dt", "close_dt", "amount"]
    ),
    "null_tokens": "SELECT l_orderkey, l_partkey, l_linenumber, CASE WHEN amount_text IN ('~', 'nan') THEN NULL ELSE amount_text END AS amount_text FROM f_raw",
    "clean_numeric": "SELECT l_orderkey, l_partkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, amount_text FROM f_amounts",
    "cast_schema": "SELECT * FROM f_amounts",
    "fix_values": """SELECT o_orderkey, CASE CAST(o_orderdate AS DATE) WHEN DATE '1995-01-01' THEN DATE '1996-01-01' WHEN DATE '1996-02-29' THEN DATE '1996-03-01'
        WHEN DATE '2001-07-31' THEN DATE '2001-08-01' ELSE CAST(o_orderdate AS DATE) END AS dt FROM orders""",
    "cast_report": """SELECT 'l_orderkey' AS column_name, CAST(0 AS BIGINT) AS n_failed UNION ALL
        SELECT 'amount_text', count(*) FROM f_raw WHERE amount_text NOT IN ('~', 'nan') AND NOT regexp_full_match(amount_text, '[0-9]+')""",
    "strip_code_prefix": "SELECT srp_2_code, substring(code_srp_2_desc, 5) AS code_srp_2_desc FROM f_curated_raw",
    "replacement_code": "SELECT srp_2_code, replacement_srp_2_code FROM f_curated",
    "effective_product": "SELECT srp_2_desc, updated, location, replacement FROM f_curated",
    "upper_name": "SELECT customer_num, upper(customer_name) AS customer_name FROM f_baseline",
    "composite_key": "SELECT unique_id, customer_num, definitive_id FROM f_key",
    "cutoff_split_sales": """SELECT CASE WHEN dtl_invoice_dt <= DATE '1999-12-31' THEN 'BEFORE' ELSE 'AFTER' END AS cutoff_tag, count(*) AS n,
        min(dtl_invoice_dt) AS first_dt, max(dtl_invoice_dt) AS last_dt FROM f_sales GROUP BY 1""",
    "cutoff_split_opps": "SELECT customer_num, srp_2_desc, opp_id, create_dt, CASE WHEN create_dt <= DATE '1999-12-31' THEN 'BEFORE' ELSE 'AFTER' END AS cutoff_tag FROM f_opps",
    "cutoff_split_rentals": "SELECT customer_num, srp_2_desc, billing_from_dt, bill_days, CASE WHEN billing_from_dt <= DATE '1999-12-31' THEN 'BEFORE' ELSE 'AFTER' END AS cutoff_tag FROM f_rentals",
    "filter_interacted": "SELECT customer_num, definitive_id FROM f_presence WHERE IN_CSD OR IN_SFD OR IN_EDD",
    "filter_outcome": "SELECT customer_num, srp_2_desc, opp_id, amount FROM f_opps WHERE iswon = 'False'",
    "drop_incomplete": "SELECT * FROM f_external WHERE staffed_beds IS NOT NULL AND net_income IS NOT NULL",
    "isin_filter": "SELECT srp_2_desc, count(*) AS n FROM f_sales WHERE srp_2_desc IN (SELECT srp_2_desc FROM f_curated WHERE active = 'Y') GROUP BY 1",
    "bin_outcome": """SELECT customer_num, srp_2_desc, CAST(next_dt - DATE '1999-12-31' AS DOUBLE) AS days,
        CAST(CASE WHEN next_dt - DATE '1999-12-31' <= 365 THEN 1 ELSE 0 END AS BIGINT) AS outcome FROM f_last_next""",
    "rating_from_probability": "SELECT customer_num, srp_2_desc, win_prob, predicted, truth, round(rating, 6) AS rating FROM f_signed",
    "truncate_decimals": "SELECT customer_num, srp_2_desc, dtl_invoice_num, trunc(dtl_unit_price * 10000) / 10000 AS dtl_unit_price FROM f_sales",
    "day_diff": """SELECT l_orderkey, l_linenumber, l_partkey, CAST(floor((epoch(l_shipdate) - epoch(o_orderdate) - 7 * 3600) / 86400) AS BIGINT) AS days
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "cutoff_to_next_purchase": """SELECT customer_num, srp_2_desc, CAST(coalesce(next_dt - last_dt, 5000) - (DATE '1999-12-31' - last_dt) AS BIGINT) AS days FROM f_last_next""",
    "days_to_cutoff": "SELECT customer_num, srp_2_desc, CAST(DATE '1999-12-31' - last_dt AS BIGINT) AS days_to_cutoff, DATE '1999-12-31' + 365 AS horizon_dt FROM f_last_next",
    "remark_labels": """SELECT l_orderkey, l_linenumber, outcome, imputed,
        CASE outcome WHEN 1 THEN 'Near Sale' WHEN 0 THEN 'Far Sale' WHEN -1 THEN 'No Remark (Unknown Customer)' WHEN -2 THEN 'No Remark (Unknown Product)'
             ELSE 'No Remark (Unknown Customer and Product)' END AS "Remark", CASE WHEN imputed = 0 THEN 'Known Pair' ELSE 'New Pair' END AS "History"
        FROM (SELECT l_orderkey, l_linenumber, l_orderkey % 5 - 3 AS outcome, CAST(l_linenumber AS BIGINT) % 3 - 1 AS imputed FROM lineitem)""",
    "default_label": """SELECT dtl_line_type, 'True' AS iswon, 'Closed Won' AS stagename, count(*) AS n FROM f_before GROUP BY 1 UNION ALL
        SELECT NULL, iswon, stagename, count(*) FROM f_opps_before GROUP BY 2, 3""",
    "conditional_override": """SELECT customer_num, srp_2_desc, opp_id, CASE srp_2_desc WHEN 'Brand#5' THEN 'COMMUNICATIONS' WHEN 'Brand#9' THEN 'TABLES' ELSE family END AS family FROM f_opps""",
    "presence_full_outer": "SELECT * EXCLUDE (edd_name) FROM f_presence",
    "coalesce_name": "SELECT customer_num, definitive_id, customer_name FROM f_named",
    "enrich_left": """SELECT s.customer_num, CAST(sum(dtl_qty_ordered) AS BIGINT) AS qty, customer_class, customer_type, active_cust_yn
        FROM f_sales s LEFT JOIN f_baseline b ON s.customer_num = b.customer_num GROUP BY ALL""",
    "enrich_left_with_gaps": """SELECT b.customer_num, arg_min(family, opp_id) FILTER (iswon = 'True') AS family, arg_min(stagename, opp_id) FILTER (iswon = 'False') AS lost_stage
        FROM (SELECT o.*, row_number() OVER (PARTITION BY customer_num, opp_id, iswon ORDER BY family, stagename) AS rn FROM f_opps o) o
        RIGHT JOIN f_baseline b ON o.customer_num = b.customer_num AND rn = 1 GROUP BY 1""",
    "first_per_key_with_gaps": """SELECT srp_2_desc, min_by(family, (opp_id, customer_num)) FILTER (iswon = 'True') AS family,
        min_by(close_dt, (opp_id, customer_num)) FILTER (iswon = 'False') AS close_dt FROM f_opps GROUP BY 1""",
    "inner_pair_join": """SELECT g.customer_num, g.srp_2_desc, round(gap_mean, 6) AS gap_mean, round(gap_std, 6) AS gap_std, last_dt, next_dt
        FROM f_gap_stats g JOIN f_last_next l ON g.customer_num = l.customer_num AND g.srp_2_desc = l.srp_2_desc""",
    "nearest_match": "SELECT * FROM f_nearest",
    "upsert_keep_last": """SELECT customer_num, srp_2_desc, CAST(coalesce(a.qty, b.qty) AS BIGINT) AS qty
        FROM (SELECT customer_num, srp_2_desc, sum(dtl_qty_ordered) AS qty FROM f_after GROUP BY ALL) a
        FULL JOIN f_qty b USING (customer_num, srp_2_desc)""",
    "group_fill": """SELECT customer_num, srp_2_desc, doc,
            CAST(coalesce(dtl_qty_ordered, arg_min(dtl_qty_ordered, place) FILTER (WHERE dtl_qty_ordered IS NOT NULL) OVER (PARTITION BY customer_num)) AS DOUBLE) AS dtl_qty_ordered,
            coalesce(family, arg_min(family, place) FILTER (WHERE family IS NOT NULL) OVER (PARTITION BY srp_2_desc)) AS family
        FROM (SELECT customer_num, srp_2_desc, doc, concat_ws('|', doc, customer_num, srp_2_desc) AS place, dtl_qty_ordered, family FROM (
            SELECT customer_num, srp_2_desc, dtl_invoice_num AS doc, arg_min(dtl_qty_ordered, row(dtl_line_num, dtl_qty_ordered)) AS dtl_qty_ordered, NULL AS family
            FROM f_before GROUP BY ALL
            UNION ALL SELECT customer_num, srp_2_desc, concat('opp', opp_id), NULL, family FROM f_opps_before))""",
    "self_pairs": """SELECT a.srp_2_desc AS id_i, b.srp_2_desc AS id_j FROM (SELECT DISTINCT srp_2_desc FROM f_sales) a
        JOIN (SELECT DISTINCT srp_2_desc FROM f_sales) b ON a.srp_2_desc < b.srp_2_desc""",
    "cross_score_grid": "SELECT customer_num, srp_2_desc FROM (SELECT DISTINCT customer_num FROM f_sales) CROSS JOIN (SELECT srp_2_desc FROM f_curated)",
    "drop_unowned_services": """SELECT g.customer_num, g.srp_2_desc FROM (SELECT customer_num, srp_2_desc FROM (SELECT DISTINCT customer_num FROM f_sales)
            CROSS JOIN (SELECT srp_2_desc FROM f_curated)) g
        WHERE NOT EXISTS (SELECT 1 FROM (VALUES ('Brand#1', 'Brand#2'), ('Brand#3', 'Brand#2'), ('Brand#4', 'Brand#4')) m(product, service)
            WHERE m.service = g.srp_2_desc AND NOT EXISTS (SELECT 1 FROM f_qty q WHERE q.customer_num = g.customer_num AND q.srp_2_desc = m.product))""",
    "purchases_with_rank": """SELECT a.customer_num, a.srp_2_desc, a.dtl_invoice_num, rank FROM f_after a JOIN (
        SELECT customer_num, srp_2_desc, CAST(rank() OVER (PARTITION BY customer_num ORDER BY rating DESC) + (count(*) OVER (PARTITION BY customer_num, rating) - 1) / 2.0 AS DOUBLE) AS rank FROM f_scored_pairs) r
        ON a.customer_num = r.customer_num AND a.srp_2_desc = r.srp_2_desc""",
    "first_per_key": "SELECT customer_num, srp_2_desc, dtl_invoice_num, dtl_invoice_dt, dtl_qty_ordered, dtl_unit_cost, dtl_line_type, dtl_value_package FROM f_invoices",
    "collect_products": """SELECT customer_num, string_agg(srp_2_desc, '|' ORDER BY srp_2_desc) AS items, CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_items
        FROM (SELECT customer_num, srp_2_desc, count(*) AS n FROM f_before GROUP BY ALL) GROUP BY 1""",
    "product_members": """SELECT srp_2_desc, count(*) AS n_rows, count(DISTINCT customer_num) AS n_distinct, 'sales_list' AS list_name FROM f_before GROUP BY 1
        UNION ALL SELECT srp_2_desc, count(*), count(DISTINCT dtl_order_num), 'order_list' FROM f_before GROUP BY 1
        UNION ALL SELECT srp_2_desc, count(*), count(DISTINCT customer_num), 'rental_list' FROM f_rentals GROUP BY 1
        UNION ALL SELECT srp_2_desc, count(*), count(DISTINCT opp_id), 'opp_won_list' FROM f_opps_before WHERE iswon = 'True' GROUP BY 1""",
    "purchase_rate": """SELECT customer_num, round(sum(dtl_qty_ordered) / nullif(max(dtl_order_dt) - min(dtl_order_dt), 0) * 365, 6) AS purchase_per_year FROM f_before GROUP BY 1""",
    "avg_order_amount": "SELECT srp_2_code, srp_2_desc, round(avg(dtl_qty_ordered), 6) AS avg_order_amount FROM f_before GROUP BY ALL",
    "last_next_purchase": "SELECT * FROM f_last_next",
    "gap_stats": "SELECT customer_num, srp_2_desc, round(gap_mean, 6) AS gap_mean, round(gap_std, 6) AS gap_std FROM f_gap_stats",
    "mean_rating": "SELECT customer_num, srp_2_desc, round(avg(rating), 6) AS rating FROM f_signed GROUP BY ALL",
    "dataset_stats": """SELECT 'customer sales' AS name, count(*) AS n_rows, CAST(22 AS BIGINT) AS n_cols, count(DISTINCT customer_num) AS n_customers,
        count(DISTINCT srp_2_desc) AS n_products, count(DISTINCT row(customer_num, srp_2_desc)) AS n_pairs FROM f_sales""",
    "merged_sketches": """SELECT 'customer sales' AS name, count(*) AS n_rows, TRUE AS n_customers_near, TRUE AS n_products_near, TRUE AS n_pairs_near FROM f_sales""",
    "mean_by_group": "SELECT srp_2_desc, round(avg(reciprocal_rank), 6) AS mean_reciprocal_rank FROM f_mrr GROUP BY 1",
    "rank_histogram": "SELECT location, CAST(rank AS DOUBLE) AS rank, count(*) AS n FROM f_mrr GROUP BY ALL",
    "value_histogram": """SELECT CAST(least(floor((reciprocal_rank - lo) * 10 / (hi - lo)), 9) AS BIGINT) AS bin, count(*) AS n
        FROM f_mrr, (SELECT min(reciprocal_rank) AS lo, max(reciprocal_rank) AS hi FROM f_mrr) GROUP BY 1""",
    "mode_value": """SELECT customer_num, srp_2_desc, dtl_qty_ordered AS mode FROM (SELECT *, row_number() OVER (PARTITION BY customer_num, srp_2_desc ORDER BY n DESC, dtl_qty_ordered) AS rn
        FROM (SELECT customer_num, srp_2_desc, dtl_qty_ordered, count(*) AS n FROM f_sales GROUP BY ALL)) WHERE rn = 1""",
    "correlation_matrix": f"SELECT a, b, round(abs_corr, 6) AS abs_corr FROM ({_CORR})",
    "feature_prune_by_corr": f"""WITH high AS (SELECT a, b FROM ({_CORR}) WHERE abs_corr > 0.2)
        SELECT DISTINCT b AS column_name FROM high WHERE a NOT IN (SELECT b FROM high)""",
    "lag_invoices": "SELECT * FROM f_lags",
    "day_gaps": """SELECT customer_num, srp_2_desc, dtl_invoice_num, CAST(gap_1 AS DOUBLE) AS gap_1, CAST(gap_2 AS DOUBLE) AS gap_2,
        CAST(gap_3 AS DOUBLE) AS gap_3, CAST(gap_4 AS DOUBLE) AS gap_4, CAST(gap_5 AS DOUBLE) AS gap_5 FROM f_gaps""",
    "last_row_per_pair": """SELECT customer_num, srp_2_desc, dtl_invoice_num, dtl_invoice_dt, dtl_order_dt, dtl_qty_ordered FROM (
        SELECT *, row_number() OVER (PARTITION BY customer_num, srp_2_desc ORDER BY dtl_invoice_dt DESC, dtl_invoice_num DESC, dtl_line_num, dtl_qty_ordered) AS rn FROM f_before) WHERE rn = 1""",
    "rank_products": """SELECT customer_num, srp_2_desc, rating, CAST(rank() OVER (PARTITION BY customer_num ORDER BY rating DESC) + (count(*) OVER (PARTITION BY customer_num, rating) - 1) / 2.0 AS DOUBLE) AS rank
        FROM f_scored_pairs""",
    "cluster_max_score": """SELECT customer_num AS id, cluster, score, max(score) OVER (PARTITION BY cluster) AS cluster_max,
        row_number() OVER (PARTITION BY cluster ORDER BY score DESC, customer_num) AS pos
        FROM (SELECT customer_num, CAST(c_nationkey AS BIGINT) AS cluster, CAST(sum(dtl_qty_ordered) AS DOUBLE) AS score FROM f_before JOIN customer ON customer_num = CAST(c_custkey AS VARCHAR) GROUP BY ALL)""",
    "sort_purchases": "SELECT * FROM f_inv_before ORDER BY customer_num, srp_2_desc, dtl_invoice_dt, dtl_invoice_num",
    "top_k_products": """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_num ORDER BY rating DESC, outcome DESC, imputed, srp_2_desc) AS pos FROM f_scored_pairs) WHERE pos <= 10""",
    "feature_ranking": """SELECT feature, weight, row_number() OVER (ORDER BY weight DESC, feature) AS pos
        FROM (SELECT srp_2_desc AS feature, CAST(sum(dtl_qty_ordered) AS BIGINT) AS weight FROM f_sales GROUP BY 1)""",
    "union_missing": """SELECT customer_num, srp_2_desc, dtl_line_type, CAST(dtl_qty_ordered AS DOUBLE) AS dtl_qty_ordered, NULL AS iswon, NULL AS family FROM f_before UNION ALL
        SELECT customer_num, srp_2_desc, NULL, NULL, iswon, family FROM f_opps_before""",
    "union_tagged": "SELECT customer_num, srp_2_desc, dtl_invoice_num, dtl_line_num, CASE WHEN dtl_invoice_dt <= DATE '1999-12-31' THEN 'BEFORE' ELSE 'AFTER' END AS cutoff_tag FROM f_sales",
    "distinct_pairs": "SELECT DISTINCT customer_num, srp_2_desc FROM f_sales",
    "known_entities": """SELECT coalesce(a.customer_num, b.customer_num) AS id, a.customer_num IS NOT NULL AS in_train, b.customer_num IS NOT NULL AS in_pairs
        FROM (SELECT DISTINCT customer_num FROM f_before) a FULL JOIN f_baseline b ON a.customer_num = b.customer_num""",
    "sorted_dimension_lists": "SELECT DISTINCT updated FROM f_curated ORDER BY 1",
}


def _quadrants(sales: str, opps: str, fill: str, keep: str) -> str:
    by_customer = ["customer_name", "state", "county", "customer_price_group"]
    by_product = ["dtl_line_type", "dtl_value_package", "dtl_qty_ordered", "dtl_unit_cost", "dtl_unit_price", "dtl_extended_price", "total_discount",
        "dtl_actual_ship_dt", "srp_1_desc", "srp_3_desc", "family"]
    own = ", ".join(by_customer + by_product[:-1])
    lines = ", ".join(by_product[:-1])
    none = ", ".join("NULL" for _ in by_customer + by_product[:-1])
    pick = ", ".join("arg_min({0}, place) FILTER (WHERE {0} IS NOT NULL) AS x_{0}".format(c) for c in by_customer)
    pick_p = ", ".join("arg_min({0}, place) FILTER (WHERE {0} IS NOT NULL) AS x_{0}".format(c) for c in by_product)
    fam = """CASE t.srp_2_desc WHEN 'Brand#5' THEN 'COMMUNICATIONS' WHEN 'Brand#9' THEN 'TABLES' ELSE coalesce(family, x_family) END AS family"""
    out = ", ".join(f"coalesce({c}, x_{c}) AS {c}" for c in by_customer + by_product if c != "family")
    whole = " AND ".join(f"{c} IS NOT NULL" for c in by_customer + by_product)
    return f"""WITH s AS (SELECT *, CASE WHEN dtl_invoice_dt <= DATE '1999-12-31' THEN 'BEFORE' ELSE 'AFTER' END AS tag FROM {sales}),
        o AS (SELECT *, CASE WHEN create_dt <= DATE '1999-12-31' THEN 'BEFORE' ELSE 'AFTER' END AS tag FROM {opps}),
        inv AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_num, srp_2_desc, dtl_invoice_num
            ORDER BY dtl_line_num, {lines}) AS rn FROM s) WHERE rn = 1),
        near AS (SELECT * FROM (SELECT i.customer_num, i.srp_2_desc, i.dtl_invoice_num, o.family, abs(o.close_dt - i.dtl_order_dt) AS delta,
            row_number() OVER (PARTITION BY i.customer_num, i.srp_2_desc, i.dtl_invoice_num ORDER BY abs(o.close_dt - i.dtl_order_dt), o.opp_id) AS rn
            FROM inv i JOIN o ON i.customer_num = o.customer_num AND i.srp_2_desc = o.srp_2_desc AND o.iswon = 'True') WHERE rn = 1 AND delta <= 90),
        total AS (SELECT concat_ws('|', 'sale', i.dtl_invoice_num, i.customer_num, i.srp_2_desc) AS place, i.tag, i.customer_num, i.srp_2_desc, {own}, family, 'True' AS iswon
            FROM inv i LEFT JOIN near n ON i.customer_num = n.customer_num AND i.srp_2_desc = n.srp_2_desc AND i.dtl_invoice_num = n.dtl_invoice_num
            UNION ALL SELECT concat_ws('|', 'opp', opp_id, customer_num, srp_2_desc), tag, customer_num, srp_2_desc, {none}, family, 'False'
            FROM o WHERE iswon = 'False'),
        fc AS (SELECT customer_num, {pick} FROM total WHERE {fill} GROUP BY 1),
        fp AS (SELECT srp_2_desc, {pick_p} FROM total WHERE {fill} GROUP BY 1)
        SELECT * FROM (SELECT t.customer_num, t.srp_2_desc, {out}, {fam}, iswon
            FROM total t LEFT JOIN fc ON t.customer_num = fc.customer_num LEFT JOIN fp ON t.srp_2_desc = fp.srp_2_desc WHERE {keep}) WHERE {whole}"""


def _sizes(name: str, frame: str, element: str) -> str:
    return f"(SELECT srp_2_desc AS k, count(*) AS {name}_rows, count(DISTINCT {element}) AS {name}_items FROM {frame} GROUP BY 1) {name} ON {name}.k = c.srp_2_desc"


_TRIALS = " UNION ALL ".join(
    f"SELECT {i} AS trial, {i * 3 % 10 + 1} AS w1, {(i * 4 + 1) % 10 + 1} AS w2, {(i * 5 + 2) % 10 + 1} AS w3" for i in range(20)
)

_SILHOUETTE = """SELECT a AS id, ca AS cluster, round(CASE WHEN own IS NULL THEN 0 WHEN greatest(own, other) = 0 THEN 0 ELSE (other - own) / greatest(own, other) END, 6) AS score
    FROM (SELECT a, ca, max(m) FILTER (WHERE ca = cb) AS own, min(m) FILTER (WHERE ca <> cb) AS other
          FROM (SELECT a, ca, cb, avg(d) AS m FROM {pairs} GROUP BY ALL) GROUP BY ALL)"""
_LABELLED_PAIRS = "(SELECT a, b, d, x.cluster AS ca, y.cluster AS cb FROM f_pmir JOIN f_plabel x ON a = x.id JOIN f_plabel y ON b = y.id)"
_WCSS = """SELECT sum(s / 2 / n) AS wcss, count(*) AS n_clusters FROM (SELECT cluster, count(*) AS n FROM {labels} GROUP BY 1)
    JOIN (SELECT ca AS cluster, sum(d * d) AS s FROM {pairs} WHERE ca = cb GROUP BY 1) USING (cluster)"""
_P_WCSS = _WCSS.format(labels="f_plabel", pairs=_LABELLED_PAIRS)

BUILDING = {
    "customer_interactions": "SELECT * EXCLUDE (edd_name) FROM f_named",
    "customer_details": """SELECT k.unique_id, k.customer_num, k.definitive_id, k.customer_name, active_cust_yn, customer_class, customer_price_group, customer_type,
            staffed_beds, net_income, hospital_type, sales_list, salesforce_list, rental_list, purchase_per_year
        FROM f_key k LEFT JOIN f_baseline b ON k.customer_num = b.customer_num LEFT JOIN f_external e ON k.definitive_id = e.definitive_id
        LEFT JOIN (SELECT customer_num, string_agg(DISTINCT srp_2_desc, '|' ORDER BY srp_2_desc) AS sales_list,
            round(sum(dtl_qty_ordered) / nullif(max(dtl_order_dt) - min(dtl_order_dt), 0) * 365, 6) AS purchase_per_year FROM f_before GROUP BY 1) s ON k.customer_num = s.customer_num
        LEFT JOIN (SELECT customer_num, string_agg(DISTINCT srp_2_desc, '|' ORDER BY srp_2_desc) AS salesforce_list FROM f_opps_before WHERE iswon = 'True' GROUP BY 1) o ON k.customer_num = o.customer_num
        LEFT JOIN (SELECT customer_num, string_agg(DISTINCT srp_2_desc, '|' ORDER BY srp_2_desc) AS rental_list FROM f_rentals WHERE billing_from_dt <= DATE '1999-12-31' GROUP BY 1) r ON k.customer_num = r.customer_num
        WHERE IN_CSD OR IN_SFD OR IN_EDD""",
    "product_details": f"""SELECT c.srp_2_code, c.srp_2_desc, replacement_srp_2_code AS new_srp_2_code, updated AS new_srp_2_desc, product_type, location, srp_3_desc,
            * EXCLUDE (srp_2_code, srp_2_desc, product_type, active, replacement, replacement_srp_2_code, updated, location, srp_3_desc, k)
        FROM (SELECT * FROM f_curated) c LEFT JOIN (SELECT srp_2_desc AS k, min(srp_3_desc) AS srp_3_desc FROM f_catalog GROUP BY 1) u ON u.k = c.srp_2_desc
        LEFT JOIN {_sizes('sales_list', 'f_before', 'customer_num')} LEFT JOIN {_sizes('order_list', 'f_before', 'dtl_order_num')}
        LEFT JOIN {_sizes('rental_list', 'f_rentals', 'customer_num')} LEFT JOIN {_sizes('salesforce_list', 'f_opps_before', 'customer_num')}
        LEFT JOIN {_sizes('opp_won_list', "(SELECT * FROM f_opps_before WHERE iswon = 'True')", 'opp_id')}
        LEFT JOIN {_sizes('opp_lost_list', "(SELECT * FROM f_opps_before WHERE iswon = 'False')", 'opp_id')}
        LEFT JOIN (SELECT srp_2_desc AS k, round(avg(dtl_qty_ordered), 6) AS avg_order_amount,
            round(sum(dtl_qty_ordered) / nullif(max(dtl_order_dt) - min(dtl_order_dt), 0) * 365, 6) AS avg_sales_per_year FROM f_before GROUP BY 1) a ON a.k = c.srp_2_desc""",
    "prediction_train": _quadrants("f_before", "f_opps_before", "true", "true"),
    "prediction_test_filled_from_all": _quadrants("f_sales", "f_opps", "TRUE", "tag = 'AFTER'"),
    "prediction_test": _quadrants("f_sales", "f_opps", "tag = 'BEFORE'", "tag = 'AFTER'"),
    "propensity_train": """WITH inv AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY customer_num, srp_2_desc, dtl_invoice_num ORDER BY dtl_line_num, dtl_line_type,
            dtl_qty_ordered, dtl_unit_cost, dtl_unit_price, dtl_value_package, total_discount, srp_1_desc, srp_3_desc) AS rn FROM f_before) WHERE rn = 1),
        latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_num, srp_2_desc ORDER BY dtl_invoice_dt DESC, dtl_invoice_num DESC) AS rn FROM inv) WHERE rn = 1)
        SELECT l.customer_num, l.srp_2_desc, dtl_invoice_dt, dtl_line_type, dtl_qty_ordered, dtl_unit_cost, dtl_unit_price, dtl_value_package, total_discount,
            srp_1_desc, srp_3_desc, county, customer_price_group, round(gap_mean, 6) AS gap_mean, round(gap_std, 6) AS gap_std,
            CAST(DATE '1999-12-31' - last_dt AS BIGINT) AS last_purchase_to_cutoff,
            CAST(CASE WHEN coalesce(next_dt - last_dt, 5000) - (DATE '1999-12-31' - last_dt) <= 365 THEN 1 ELSE 0 END AS BIGINT) AS outcome
        FROM latest l JOIN f_gap_stats g ON l.customer_num = g.customer_num AND l.srp_2_desc = g.srp_2_desc
        JOIN f_last_next n ON l.customer_num = n.customer_num AND l.srp_2_desc = n.srp_2_desc WHERE gap_std IS NOT NULL""",
    "propensity_test": "SELECT customer_num, srp_2_desc, CAST(CASE WHEN min(dtl_invoice_dt) <= DATE '1999-12-31' + 365 THEN 1 ELSE 0 END AS BIGINT) AS outcome FROM f_after GROUP BY ALL",
    "dist_numeric": "SELECT id_i, id_j, round(avg_order_amount, 6) AS d FROM f_ppairs",
    "dist_matching": "SELECT id_i, id_j, location AS d FROM f_ppairs",
    "dist_jaccard": "SELECT id_i, id_j, round(sales_list, 6) AS d FROM f_ppairs",
    "pairwise_features": "SELECT id_i, id_j, product_type, location, round(avg_order_amount, 6) AS avg_order_amount, round(sales_list, 6) AS sales_list FROM f_ppairs",
    "weighted_distance": "SELECT id_i, id_j, round(d, 6) AS d FROM f_pd",
    "nearest_entity": """SELECT a AS id, b AS nearest, round(d, 6) AS d FROM (SELECT a, b, d, row_number() OVER (PARTITION BY a ORDER BY d, b) AS rn FROM f_pmir
        WHERE a IN (SELECT srp_2_desc FROM f_curated WHERE active = 'N') AND b IN (SELECT srp_2_desc FROM f_curated WHERE active = 'Y')) WHERE rn = 1""",
    "nearest_by_profile": """SELECT a AS id, b AS nearest, round(d, 6) AS d FROM (SELECT a, b, d, row_number() OVER (PARTITION BY a ORDER BY d, b) AS rn FROM f_cmir
        WHERE a NOT IN (FROM f_lost) AND b IN (FROM f_lost)) WHERE rn = 1""",
    "affinity_weights": """SELECT a AS target, b AS source, round(1 / greatest(d, 0.000001) / sum(1 / greatest(d, 0.000001)) OVER (PARTITION BY a), 6) AS w FROM f_pmir
        WHERE a IN (SELECT srp_2_desc FROM f_curated WHERE active = 'N') AND b IN (SELECT srp_2_desc FROM f_curated WHERE active = 'Y')""",
    "wcss": f"SELECT round(wcss, 6) AS wcss, n_clusters FROM ({_P_WCSS})",
    "silhouette": _SILHOUETTE.format(pairs=_LABELLED_PAIRS),
    "silhouette_by_profile": _SILHOUETTE.format(pairs="f_cmir"),
    "silhouette_mixed": _SILHOUETTE.format(pairs="f_fmir"),
    "wcss_by_profile": f"SELECT round(wcss, 6) AS wcss, n_clusters FROM ({_WCSS.format(labels='f_cust', pairs='f_cmir')})",
    "cluster_summary": f"""SELECT 'wcss' AS metric, round(wcss, 4) AS value FROM ({_P_WCSS}) UNION ALL SELECT 'n_clusters', CAST(n_clusters AS DOUBLE) FROM ({_P_WCSS})
        UNION ALL SELECT 'silhouette', round(avg(score), 4) FROM ({_SILHOUETTE.format(pairs=_LABELLED_PAIRS)})
        UNION ALL SELECT * FROM (VALUES ('cutoff', 2.0), ('weight product_type', 1.0), ('weight location', 2.0), ('weight avg_order_amount', 3.0), ('weight sales_list', 4.0))""",
    "best_run_weights": f"""WITH best AS (SELECT w1, w2, w3 FROM (SELECT trial, w1, w2, w3, sum(d2 / n) AS wcss FROM (
            SELECT trial, w1, w2, w3, x.cluster AS cluster, ((w1 * product_type + w2 * location + w3 * sales_list) / (w1 + w2 + w3)) ** 2 AS d2
            FROM f_ppairs JOIN f_plabel x ON id_i = x.id JOIN f_plabel y ON id_j = y.id AND x.cluster = y.cluster, ({_TRIALS}))
            JOIN (SELECT cluster, count(*) AS n FROM f_plabel GROUP BY 1) USING (cluster) GROUP BY ALL) ORDER BY wcss, trial LIMIT 1)
        SELECT 'product_type' AS feature, CAST(w1 AS DOUBLE) AS weight FROM best UNION ALL SELECT 'location', w2 FROM best UNION ALL SELECT 'sales_list', w3 FROM best
        UNION ALL SELECT 'avg_order_amount', round((w1 + w2 + w3) / 3.0, 6) FROM best""",
}


CTES["f_propensity"] = BUILDING["propensity_train"]
CTES["f_win_train"] = BUILDING["prediction_train"]
CTES["f_active"] = "SELECT srp_2_desc FROM f_curated WHERE active = 'Y'"
CTES["f_train"] = """
        SELECT customer_num, srp_2_desc, CASE WHEN predicted = 'True' THEN 1 ELSE 0 END AS v, win_prob, count(*) AS n
        FROM f_scored GROUP BY ALL"""
CTES["f_near_c"] = """
        SELECT a AS id, b AS nearest FROM (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY d, b) AS rn FROM f_cmir
        WHERE a NOT IN (SELECT customer_num FROM f_train) AND b IN (SELECT customer_num FROM f_train)) WHERE rn = 1"""
CTES["f_near_p"] = """
        SELECT a AS id, b AS nearest FROM (SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY d, b) AS rn FROM f_pmir
        WHERE a NOT IN (SELECT srp_2_desc FROM f_train) AND b IN (SELECT srp_2_desc FROM f_train)) WHERE rn = 1"""
CTES["f_rated"] = """
        SELECT CAST(c_nationkey AS BIGINT) AS cluster, customer_num, srp_2_desc, rating FROM f_rating JOIN customer ON customer_num = CAST(c_custkey AS VARCHAR)"""
CTES["f_recs"] = """
        SELECT *, row_number() OVER (PARTITION BY customer_num ORDER BY rating DESC, outcome DESC, imputed, srp_2_desc) AS pos FROM (
            SELECT customer_num, updated AS srp_2_desc, avg(rating) AS rating, CAST(substring(updated, 7) AS BIGINT) % 2 AS outcome,
                   CAST(customer_num AS BIGINT) % 2 AS imputed
            FROM f_rating r JOIN f_curated c ON r.srp_2_desc = c.srp_2_desc GROUP BY customer_num, updated) g
        WHERE NOT EXISTS (SELECT 1 FROM (VALUES ('Brand#1', 'Brand#2'), ('Brand#3', 'Brand#2'), ('Brand#4', 'Brand#4')) m(product, service)
            WHERE m.service = g.srp_2_desc AND NOT EXISTS (SELECT 1 FROM f_qty q WHERE q.customer_num = g.customer_num AND q.srp_2_desc = m.product))"""


def _imputed(requests: str, value: str = "v") -> str:
    """Outcome of every requested pair, by listing the rows of its customer or its product."""
    return f"""(WITH req AS ({requests}),
        r AS (SELECT q.customer_num AS c, q.srp_2_desc AS p, coalesce(tc.customer_num, nc.nearest) AS c2, coalesce(tp.srp_2_desc, np.nearest) AS p2
            FROM req q LEFT JOIN (SELECT DISTINCT customer_num FROM f_train) tc ON q.customer_num = tc.customer_num LEFT JOIN f_near_c nc ON q.customer_num = nc.id
            LEFT JOIN (SELECT DISTINCT srp_2_desc FROM f_train) tp ON q.srp_2_desc = tp.srp_2_desc LEFT JOIN f_near_p np ON q.srp_2_desc = np.id),
        own AS (SELECT customer_num AS c, srp_2_desc AS p, val FROM (SELECT *, row_number() OVER (PARTITION BY customer_num, srp_2_desc ORDER BY n DESC, val) AS rn
            FROM (SELECT customer_num, srp_2_desc, {value} AS val, sum(n) AS n FROM f_train GROUP BY ALL)) WHERE rn = 1),
        cand AS (SELECT c, p, t.{value} AS val, n FROM r JOIN f_train t ON t.customer_num = c2 WHERE p2 IS NOT NULL
            UNION ALL SELECT c, p, t.{value}, n FROM r JOIN f_train t ON t.srp_2_desc = p2 AND t.customer_num <> c2),
        best AS (SELECT c, p, val FROM (SELECT *, row_number() OVER (PARTITION BY c, p ORDER BY n DESC, val) AS rn FROM (SELECT c, p, val, sum(n) AS n FROM cand GROUP BY ALL)) WHERE rn = 1)
        SELECT r.c AS customer_num, r.p AS srp_2_desc,
            coalesce(own.val, best.val, CASE WHEN c2 IS NULL THEN -1 ELSE 0 END + CASE WHEN p2 IS NULL THEN -2 ELSE 0 END) AS outcome,
            CASE WHEN own.val IS NOT NULL THEN 0 WHEN c2 IS NOT NULL AND p2 IS NOT NULL THEN 1 ELSE -1 END AS imputed
        FROM r LEFT JOIN own ON r.c = own.c AND r.p = own.p LEFT JOIN best ON r.c = best.c AND r.p = best.p)"""


_ALL_REQUESTS = """SELECT CAST(c_custkey AS VARCHAR) AS customer_num, srp_2_desc FROM customer
    CROSS JOIN (SELECT srp_2_desc FROM f_curated UNION SELECT srp_1_desc FROM f_catalog)"""
_AFTER_PAIRS = "SELECT DISTINCT customer_num, srp_2_desc FROM f_after"
_REMARK = """CASE outcome WHEN 1 THEN 'Near Sale' WHEN 0 THEN 'Far Sale' WHEN -1 THEN 'No Remark (Unknown Customer)' WHEN -2 THEN 'No Remark (Unknown Product)'
    WHEN -3 THEN 'No Remark (Unknown Customer and Product)' END"""


def _unseen(weight: str) -> str:
    return f"""SELECT m.ca AS cluster, a AS customer_num, srp_2_desc, round(sum({weight} * rating) / sum({weight}), 6) AS rating
        FROM f_cmir m JOIN f_rated e ON e.customer_num = m.b WHERE m.ca = m.cb AND a NOT IN (SELECT customer_num FROM f_rated) GROUP BY ALL"""


def _class(c: int) -> str:
    text = "True" if c else "False"
    return f"""SELECT {c} AS c, count(*) FILTER (WHERE truth = '{text}') AS support, count(*) FILTER (WHERE predicted = '{text}') AS called,
        count(*) FILTER (WHERE truth = '{text}' AND predicted = '{text}') AS hits FROM f_scored"""


_RATES = f"""(SELECT c, coalesce(hits / nullif(called, 0), 0) AS p, coalesce(hits / nullif(support, 0), 0) AS r, coalesce(2 * hits / nullif(called + support, 0), 0) AS f, support, hits
    FROM ({_class(0)} UNION ALL {_class(1)}))"""

MODELLING = {
    "encode_features": """SELECT customer_num, srp_2_desc, dtl_invoice_num, dense_rank() OVER (ORDER BY srp_1_desc) - 1 AS srp_1_desc_code,
        dense_rank() OVER (ORDER BY dtl_value_package) - 1 AS dtl_value_package_code, dense_rank() OVER (ORDER BY customer_num) - 1 AS customer_num_code FROM f_before""",
    "train_test_split": """SELECT customer_num, srp_2_desc, opp_id, CASE WHEN ('0x' || substring(md5(concat_ws('|', customer_num, srp_2_desc, opp_id)), 1, 8))::BIGINT % 100 < 80
        THEN 'train' ELSE 'test' END AS split FROM f_opps""",
    "undersample": """SELECT customer_num, srp_2_desc, opp_id, iswon FROM (SELECT *, row_number() OVER (PARTITION BY iswon ORDER BY md5(concat_ws('|', customer_num, srp_2_desc, opp_id))) AS rn FROM f_opps)
        WHERE rn <= (SELECT min(n) FROM (SELECT count(*) AS n FROM f_opps GROUP BY iswon))""",
    "smote_upsample": """WITH c AS (SELECT o, count(*) AS n FROM (SELECT CASE WHEN next_dt - DATE '1999-12-31' <= 365 THEN 1 ELSE 0 END AS o
            FROM f_gap_stats g JOIN f_last_next l ON g.customer_num = l.customer_num AND g.srp_2_desc = l.srp_2_desc WHERE gap_std IS NOT NULL) GROUP BY o)
        SELECT CAST(o AS BIGINT) AS outcome, (SELECT max(n) FROM c) AS n, (SELECT max(n) FROM c) - n AS n_new, TRUE AS inside FROM c""",
    "batch_predict": "SELECT iswon, count(*) AS n, TRUE AS in_range FROM f_win_train GROUP BY 1",
    "rate_pairs": "SELECT customer_num, srp_2_desc, count(*) AS n, TRUE AS in_range FROM f_win_train GROUP BY ALL",
    "als_fill": """SELECT CAST(n_regionkey AS BIGINT) AS cluster, count(DISTINCT (customer_num, srp_2_desc)) AS n_cells, TRUE AS close FROM f_signed
        JOIN customer ON customer_num = CAST(c_custkey AS VARCHAR) JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
    "logistic_mf": """SELECT CAST(n_regionkey AS BIGINT) AS cluster, count(*) FILTER (rating > 0) AS n_liked, count(*) FILTER (rating <= 0) AS n_other, TRUE AS apart
        FROM (SELECT customer_num, srp_2_desc, avg(rating) AS rating FROM f_signed GROUP BY ALL)
        JOIN customer ON customer_num = CAST(c_custkey AS VARCHAR) JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
    "accuracy": "SELECT round(avg(CASE WHEN truth = predicted THEN 1 ELSE 0 END), 6) AS accuracy FROM f_scored",
    "classification_report": f"""SELECT CAST(c AS VARCHAR) AS label, round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, CAST(support AS BIGINT) AS support FROM {_RATES}
        UNION ALL SELECT 'macro avg', round(avg(p), 6), round(avg(r), 6), round(avg(f), 6), CAST(sum(support) AS BIGINT) FROM {_RATES}
        UNION ALL SELECT 'weighted avg', round(sum(p * support) / sum(support), 6), round(sum(r * support) / sum(support), 6), round(sum(f * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM {_RATES}
        UNION ALL SELECT 'accuracy', round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), round(sum(hits) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM {_RATES}""",
    "confusion_matrix": """SELECT CAST(a AS BIGINT) AS label, CAST(b AS BIGINT) AS predicted, (SELECT count(*) FROM f_scored WHERE (truth = 'True') = (a = 1) AND (predicted = 'True') = (b = 1)) AS n
        FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(a, b)""",
    "impute_predict": f"SELECT customer_num, srp_2_desc, CAST(outcome AS BIGINT) AS outcome, CAST(imputed AS BIGINT) AS imputed FROM {_imputed(_ALL_REQUESTS)}",
    "score_grid": f"""SELECT customer_num, srp_2_desc, CAST(outcome AS BIGINT) AS outcome, CAST(imputed AS BIGINT) AS imputed
        FROM {_imputed("SELECT customer_num, srp_2_desc FROM (SELECT DISTINCT customer_num FROM f_after) CROSS JOIN f_active")}""",
    "impute_accuracy": f"""SELECT round(avg(CASE WHEN outcome = truth THEN 1 ELSE 0 END), 6) AS accuracy FROM {_imputed(_AFTER_PAIRS)} i
        JOIN (SELECT customer_num, srp_2_desc, max(CASE WHEN dtl_line_type = 'F' THEN 1 ELSE 0 END) AS truth FROM f_after GROUP BY ALL) USING (customer_num, srp_2_desc)""",
    "cluster_ratings": """SELECT CAST(c_nationkey AS BIGINT) AS cluster, customer_num, srp_2_desc, round(avg(rating), 6) AS rating
        FROM f_signed JOIN customer ON customer_num = CAST(c_custkey AS VARCHAR) GROUP BY ALL""",
    "factorisation_rmse": """SELECT cluster, round(sqrt(avg(mse)), 6) AS rmse FROM (SELECT CAST(c_nationkey AS BIGINT) AS cluster, srp_2_desc, avg((a.r - rating) ** 2) AS mse
        FROM (SELECT customer_num, srp_2_desc, avg(rating) AS r FROM f_signed GROUP BY ALL) a JOIN f_rating USING (customer_num, srp_2_desc)
        JOIN customer ON customer_num = CAST(c_custkey AS VARCHAR) GROUP BY ALL) GROUP BY 1""",
    "fill_unseen_customers": _unseen("(1 / greatest(d, 0.000001))"),
    "fill_unseen_customers_by_distance": _unseen("greatest(d, 0.000001)"),
    "fill_unseen_products": """SELECT CAST(c_nationkey AS BIGINT) AS cluster, customer_num, a AS srp_2_desc, round(sum(rating / d) / sum(1 / d), 6) AS rating
        FROM f_rating JOIN f_pmir ON b = srp_2_desc JOIN f_plabel x ON x.id = a JOIN f_plabel y ON y.id = b AND x.cluster = y.cluster
        JOIN customer ON customer_num = CAST(c_custkey AS VARCHAR) WHERE b IN (FROM f_active) AND a NOT IN (FROM f_active) GROUP BY ALL""",
    "replacement_rollup": "SELECT customer_num, updated AS srp_2_desc, round(avg(rating), 6) AS rating FROM f_rating JOIN f_curated USING (srp_2_desc) GROUP BY ALL",
    "recommend": "SELECT customer_num, srp_2_desc, round(rating, 6) AS rating, outcome, imputed, pos FROM f_recs",
    "recommend_with_remark": f"""SELECT customer_num AS "Customer", srp_2_desc AS "Product", trunc(rating * 10000) / 10000 AS "Rating", {_REMARK} AS "Remark",
        CASE WHEN imputed = 0 THEN 'Known Pair' ELSE 'New Pair' END AS "History", pos FROM f_recs WHERE pos <= 10""",
    "mrr_rows": "SELECT customer_num, srp_2_desc, CAST(rank AS DOUBLE) AS rank, round(reciprocal_rank, 6) AS reciprocal_rank, location FROM f_mrr",
    "mrr": "SELECT round(avg(reciprocal_rank), 6) AS mrr FROM f_mrr",
    "mrr_by_location": "SELECT location, round(avg(reciprocal_rank), 6) AS mrr FROM f_mrr GROUP BY 1",
    "precision_recall_at_k": """SELECT round(avg(hits / 10), 6) AS precision, round(avg(hits / n), 6) AS recall FROM (
        SELECT customer_num, sum(hit) AS hits, count(*) AS n FROM (SELECT DISTINCT customer_num, srp_2_desc, CASE WHEN rank <= 10 THEN 1.0 ELSE 0.0 END AS hit FROM f_mrr) GROUP BY 1)""",
    "customer_lookup": """SELECT s.customer_num, CASE WHEN b.customer_num IS NULL THEN 'No name found in record' ELSE b.customer_name END AS customer_name
        FROM (SELECT DISTINCT customer_num FROM f_sales) s LEFT JOIN f_baseline b ON s.customer_num = b.customer_num""",
    "propensity_lookup": f"""SELECT customer_num, srp_2_desc, CASE WHEN trunc(w.outcome * 100) / 100 < 0.5 THEN '' ELSE {_REMARK.replace("outcome", "n.outcome")} END AS "Remark",
        CASE WHEN n.imputed = 0 THEN 'Known Pair' ELSE 'New Pair' END AS "History", trunc(w.outcome * 100) / 100 AS win_prob
        FROM {_imputed(_AFTER_PAIRS)} n JOIN {_imputed(_AFTER_PAIRS, "win_prob")} w USING (customer_num, srp_2_desc)""",
    "coverage_stats": "SELECT count(DISTINCT customer_num) AS n_customers, count(DISTINCT c_nationkey) AS n_clusters FROM f_signed JOIN customer ON customer_num = CAST(c_custkey AS VARCHAR)",
}

GROUPS = [RELATIONAL, BUILDING, MODELLING]


def statements() -> dict[str, str]:
    return {name: sql(text) for group in GROUPS for name, text in group.items()}
