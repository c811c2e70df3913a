"""DuckDB SQL equivalents of ``fieldlake.plans.mapped`` (same column names)."""

_CUST_REGION = """
  cust AS (SELECT c.c_custkey, r.r_name AS region FROM customer c
           JOIN nation n ON c.c_nationkey = n.n_nationkey
           JOIN region r ON n.n_regionkey = r.r_regionkey),
  daily AS (SELECT cu.region, CAST(o.o_orderdate AS DATE) AS flow_date,
                   round(sum(o.o_totalprice), 2) AS discharge
            FROM orders o JOIN cust cu ON o.o_custkey = cu.c_custkey GROUP BY 1, 2)"""

SQL = {}

SQL["water_year_summary"] = f"""
WITH {_CUST_REGION},
feat AS (SELECT *, discharge - lag(discharge) OVER (PARTITION BY region ORDER BY flow_date) AS change_cfs,
                CAST(CASE WHEN month(flow_date) >= 10 THEN year(flow_date) + 1 ELSE year(flow_date) END AS INTEGER) AS water_year
         FROM daily),
s AS (SELECT region, water_year, count(*) AS days_of_record,
             (floor((avg(discharge)) * 10000 + 0.5) / 10000) AS mean_cfs, (floor((min(discharge)) * 10000 + 0.5) / 10000) AS min_cfs,
             (floor((max(discharge)) * 10000 + 0.5) / 10000) AS max_cfs,
             (floor((quantile_cont(discharge, 0.5)) * 10000 + 0.5) / 10000) AS median_cfs,
             (floor((quantile_cont(discharge, 0.1)) * 10000 + 0.5) / 10000) AS p10_cfs,
             (floor((quantile_cont(discharge, 0.9)) * 10000 + 0.5) / 10000) AS p90_cfs,
             sum(abs(change_cfs)) AS sum_abs_change, sum(discharge) AS sum_discharge,
             round(sum(discharge) * 86400.0 / 43560.0, 0) AS annual_volume_af
      FROM feat GROUP BY 1, 2)
SELECT region, water_year, days_of_record, mean_cfs, min_cfs, max_cfs, median_cfs, p10_cfs, p90_cfs,
       round(sum_abs_change, 2) AS sum_abs_change, round(sum_discharge, 2) AS sum_discharge,
       annual_volume_af,
       (floor((CASE WHEN sum_discharge > 0 THEN sum_abs_change / sum_discharge END) * 1000000 + 0.5) / 1000000) AS rb_flashiness_index,
       CAST(rank() OVER (PARTITION BY region ORDER BY annual_volume_af DESC) AS INTEGER) AS wettest_year_rank
FROM s WHERE days_of_record >= 30
"""

_NULLK = "'_dbt_utils_surrogate_key_null_'"
_LINE_SK = (f"md5(concat_ws('-', coalesce(CAST(l_orderkey AS VARCHAR), {_NULLK}), "
            f"coalesce(CAST(l_linenumber AS VARCHAR), {_NULLK}))) AS line_sk")
_LINE_TB = "l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus"

SQL["surrogate_key_dedup_first"] = f"""
SELECT {_LINE_SK}, * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_shipdate ASC NULLS LAST, {_LINE_TB}) = 1"""

SQL["surrogate_key_dedup_last"] = f"""
SELECT {_LINE_SK}, * FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_shipdate DESC NULLS FIRST, {_LINE_TB}) = 1"""

SQL["keep_largest"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC NULLS FIRST,
                           l_linenumber, l_partkey) = 1"""

SQL["dominant_child"] = """
SELECT l_orderkey, l_suppkey AS dominant_suppkey, l_quantity FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC NULLS LAST,
                           l_linenumber, l_suppkey, l_partkey) = 1"""

SQL["latest_per_entity"] = """
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1"""

SQL["duplicate_report"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""

SQL["decode_status"] = """
SELECT o_orderstatus, count(*) AS n_orders,
       CASE o_orderstatus WHEN 'F' THEN 'Fulfilled' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Partial'
            ELSE 'Unknown' END AS status_label
FROM orders GROUP BY 1"""

SQL["threshold_bins"] = """
SELECT CASE WHEN l_quantity < 5 THEN '1-5 in' WHEN l_quantity < 10 THEN '5-10 in'
            WHEN l_quantity < 15 THEN '10-15 in' WHEN l_quantity < 20 THEN '15-20 in'
            WHEN l_quantity < 30 THEN '20-30 in' WHEN l_quantity < 40 THEN '30-40 in'
            ELSE '40+ in' END AS quantity_class,
       count(*) AS n_lines, sum(l_quantity) AS sum_qty
FROM lineitem GROUP BY 1"""

SQL["size_class_bins"] = """
SELECT CASE WHEN o_totalprice >= 100000 THEN 'Megafire (100k+ ac)'
            WHEN o_totalprice >= 10000 THEN 'Large (10k-100k ac)'
            WHEN o_totalprice >= 1000 THEN 'Moderate (1k-10k ac)'
            WHEN o_totalprice >= 100 THEN 'Small (100-1k ac)' ELSE 'Minor (<100 ac)' END AS size_class,
       count(*) AS n_orders
FROM orders GROUP BY 1"""

SQL["stage_bins"] = """
SELECT CASE WHEN p_size IS NULL THEN 'Unknown' WHEN p_size < 20 THEN 'Regeneration (<20 yr)'
            WHEN p_size < 40 THEN 'Young (20-40 yr)' WHEN p_size < 80 THEN 'Mature (40-80 yr)'
            WHEN p_size < 150 THEN 'Late (80-150 yr)' ELSE 'Old growth (150+ yr)' END AS stage,
       count(*) AS n_parts
FROM part GROUP BY 1"""

SQL["pattern_class"] = """
SELECT CASE WHEN p_name ILIKE '%RING%' THEN 'Ring' WHEN p_name ILIKE '%WIDGET%' THEN 'Widget'
            WHEN p_name ILIKE '%BOLT%' THEN 'Bolt' WHEN p_name ILIKE '%GEAR%' THEN 'Gear'
            ELSE 'Other' END AS part_class,
       count(*) AS n_parts
FROM part GROUP BY 1"""

SQL["range_filter"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1999-01-01'
  AND o_orderstatus IN ('F', 'O')"""

SQL["like_filter"] = """
SELECT p_partkey, p_name, p_type, upper(p_name) = 'SMALL RING' AS is_target FROM part
WHERE p_type ILIKE '%o%' AND NOT p_type ILIKE '%promo%'"""

SQL["flag_derive"] = """
SELECT nullif(l_discount, 0.0) IS NOT NULL AS is_discounted, l_returnflag = 'R' AS is_returned,
       count(*) AS n_lines
FROM lineitem GROUP BY 1, 2"""

_SUPP_REGION = """
  sr AS (SELECT s.s_suppkey, s.s_name, r.r_name FROM supplier s
         JOIN nation n ON s.s_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey)"""

SQL["scoped_inner_join"] = f"""
WITH {_SUPP_REGION}
SELECT sr.s_suppkey, sr.s_name, count(*) AS n_lines, sum(l.l_quantity) AS sum_qty
FROM lineitem l JOIN sr ON l.l_suppkey = sr.s_suppkey
WHERE sr.r_name = 'ASIA' GROUP BY 1, 2"""

SQL["left_lookup"] = """
SELECT p.p_type, count(*) AS n_lines,
       CAST(sum(CAST(round(l.l_extendedprice * 100) AS BIGINT)) AS DOUBLE) / 100.0 AS sum_price
FROM lineitem l LEFT JOIN (SELECT * FROM part WHERE p_size <= 40) p ON l.l_partkey = p.p_partkey
GROUP BY 1"""

SQL["semi_join"] = """
SELECT p_partkey, p_name FROM part
WHERE EXISTS (SELECT 1 FROM lineitem l WHERE l.l_quantity > 45 AND l.l_partkey = part.p_partkey)"""

SQL["anti_join"] = """
SELECT o_orderkey, o_custkey FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_returnflag = 'R' AND l.l_orderkey = orders.o_orderkey)"""

SQL["agg_join"] = """
SELECT c.c_custkey, c.c_name, a.max_price, a.last_order FROM customer c
JOIN (SELECT o_custkey, max(o_totalprice) AS max_price, max(o_orderdate) AS last_order
      FROM orders GROUP BY 1) a ON c.c_custkey = a.o_custkey"""

SQL["coverage_join"] = """
WITH stats AS (
  SELECT c.c_nationkey, count(*) AS n_orders, min(o.o_orderdate) AS first_order,
         max(o.o_orderdate) AS last_order
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
  WHERE o.o_orderdate >= TIMESTAMP '1997-01-01' AND o.o_orderdate < TIMESTAMP '1997-03-01'
  GROUP BY 1)
SELECT n.n_nationkey, n.n_name, coalesce(s.n_orders, 0) AS n_orders, s.first_order, s.last_order
FROM nation n LEFT JOIN stats s ON n.n_nationkey = s.c_nationkey"""

SQL["conditional_agg"] = """
SELECT l_returnflag, count(*) AS total_lines,
       CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS open_lines,
       (floor((avg(CASE WHEN l_linestatus = 'O' THEN l_quantity END)) * 10000 + 0.5) / 10000) AS avg_open_qty,
       max(CASE WHEN l_linestatus = 'O' THEN l_discount END) AS max_open_discount,
       (floor((CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS DOUBLE) * 100.0
             / nullif(CAST(count(*) AS DOUBLE), 0.0)) * 10000 + 0.5) / 10000) AS pct_open
FROM lineitem GROUP BY 1"""

SQL["pivot_pairs"] = """
WITH piv AS (
  SELECT l_partkey,
         max(CASE WHEN l_linestatus = 'F' THEN l_quantity END) AS pre_qty,
         max(CASE WHEN l_linestatus = 'O' THEN l_quantity END) AS post_qty,
         max(CASE WHEN l_linestatus = 'F' THEN l_extendedprice END) AS pre_price,
         max(CASE WHEN l_linestatus = 'O' THEN l_extendedprice END) AS post_price
  FROM lineitem GROUP BY 1)
SELECT *, post_qty - pre_qty AS qty_change,
       (floor(((post_price - pre_price) / nullif(pre_price, 0.0) * 100) * 10000 + 0.5) / 10000) AS pct_price_change
FROM piv WHERE pre_qty IS NOT NULL AND post_qty IS NOT NULL"""

SQL["expansion_agg"] = """
SELECT l_returnflag,
       CAST(sum(CASE WHEN l_linestatus = 'O' THEN CAST(round(l_extendedprice * 100) AS BIGINT)
                     * CAST(l_quantity AS BIGINT) END) AS DOUBLE) / 200000.0 AS open_expanded,
       CAST(sum(CASE WHEN l_linestatus = 'F' THEN CAST(round(l_extendedprice * 100) AS BIGINT)
                     * CAST(l_quantity AS BIGINT) END) AS DOUBLE) / 200000.0 AS closed_expanded
FROM lineitem GROUP BY 1"""

SQL["share_having"] = """
SELECT l_suppkey, count(*) AS n_lines,
       CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned_lines,
       (floor((CAST(sum(CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) * 100.0
             / nullif(CAST(count(*) AS DOUBLE), 0.0)) * 10000 + 0.5) / 10000) AS pct_returned
FROM lineitem GROUP BY 1 HAVING count(*) >= 550"""

SQL["percentiles"] = """
SELECT user_id, count(*) AS n_events,
       (floor((quantile_cont(value, 0.5)) * 10000 + 0.5) / 10000) AS median_value,
       (floor((quantile_cont(value, 0.1)) * 10000 + 0.5) / 10000) AS p10_value,
       (floor((quantile_cont(value, 0.9)) * 10000 + 0.5) / 10000) AS p90_value
FROM events GROUP BY 1"""

SQL["mode_per_group"] = """
WITH c AS (SELECT o_custkey, o_orderpriority, count(*) AS n FROM orders
           WHERE o_orderpriority IS NOT NULL GROUP BY 1, 2)
SELECT o_custkey, o_orderpriority AS mode_priority FROM c
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, o_orderpriority ASC) = 1"""

# ---------------------------------------------------------------- part 2
_EV_SERIES = """
  s AS (SELECT user_id, event_id, ts, value,
               lag(value) OVER w AS prev_value, value - lag(value) OVER w AS change
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id))"""

SQL["variant_project"] = """
SELECT event_id, event_type, CAST(props->>'$.k' AS INTEGER) AS k, TRY_CAST(props->>'$.k' AS DOUBLE) AS k_double
FROM events WHERE CAST(props->>'$.k' AS INTEGER) IS NOT NULL"""

SQL["lag_change_rolling"] = """
SELECT user_id, event_id, ts, value, lag(value) OVER w AS prev_value, value - lag(value) OVER w AS change,
       (floor((avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)) * 1000000 + 0.5) / 1000000) AS rolling_mean
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)"""

SQL["daily_flow_features"] = f"""
WITH {_CUST_REGION}
SELECT region, flow_date, discharge, lag(discharge) OVER w AS prev_discharge,
       discharge - lag(discharge) OVER w AS change_cfs,
       (floor((avg(discharge) OVER (PARTITION BY region ORDER BY flow_date
                                  ROWS BETWEEN 3 PRECEDING AND 3 FOLLOWING)) * 1000000 + 0.5) / 1000000) AS rolling_7d_mean,
       CAST(CASE WHEN month(flow_date) >= 10 THEN year(flow_date) + 1 ELSE year(flow_date) END AS INTEGER) AS water_year
FROM daily WINDOW w AS (PARTITION BY region ORDER BY flow_date)"""

SQL["share_of_group"] = """
SELECT l_returnflag, l_linestatus, count(*) AS n,
       (floor((CAST(count(*) AS DOUBLE) * 100.0 / CAST(sum(count(*)) OVER (PARTITION BY l_returnflag) AS DOUBLE)) * 10000 + 0.5) / 10000) AS pct_of_flag
FROM lineitem GROUP BY 1, 2"""

SQL["top_jumps"] = f"""
WITH {_EV_SERIES}
SELECT user_id, event_id, ts, value, prev_value, change, abs(change) AS abs_change
FROM s WHERE change IS NOT NULL ORDER BY abs(change) DESC, event_id LIMIT 20"""

SQL["jump_by_weekday"] = f"""
WITH {_EV_SERIES}
SELECT strftime(ts, '%a') AS weekday, count(*) AS n_jumps FROM s WHERE abs(change) >= 300 GROUP BY 1"""

SQL["diurnal_profile"] = """
WITH h AS (SELECT event_type, CAST(hour(timezone('America/Los_Angeles', timezone('UTC', ts))) AS INTEGER) AS local_hour,
                  count(*) AS n_events, avg(value) AS m
           FROM events GROUP BY 1, 2)
SELECT event_type, local_hour, n_events, (floor((m) * 10000 + 0.5) / 10000) AS mean_value,
       (floor(((max(m) OVER (PARTITION BY event_type) - min(m) OVER (PARTITION BY event_type)) / 2
             / avg(m) OVER (PARTITION BY event_type) * 100) * 10000 + 0.5) / 10000) AS amplitude_pct
FROM h"""

SQL["around_max"] = f"""
WITH {_EV_SERIES},
top AS (SELECT user_id, ts AS event_time FROM s WHERE change IS NOT NULL ORDER BY abs(change) DESC, event_id LIMIT 1)
SELECT e.user_id, e.event_id, e.ts, e.value FROM events e JOIN top t ON e.user_id = t.user_id
 AND e.ts >= t.event_time - INTERVAL 2 HOUR AND e.ts <= t.event_time + INTERVAL 2 HOUR"""

SQL["corr_leave_one_out"] = """
WITH vol AS (SELECT c.c_nationkey, ln(sum(o.o_totalprice)) AS x
             FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey GROUP BY 1),
bal AS (SELECT c_nationkey, avg(c_acctbal) AS y FROM customer GROUP BY 1),
b AS (SELECT vol.c_nationkey, x, y FROM vol JOIN bal ON vol.c_nationkey = bal.c_nationkey),
t AS (SELECT count(*) AS n, sum(x) AS sx, sum(y) AS sy, sum(x * y) AS sxy, sum(x * x) AS sxx, sum(y * y) AS syy,
             corr(x, y) AS corr_all FROM b),
z AS (SELECT b.*, t.corr_all,
             (t.n - 1) * (t.sxy - x * y) - (t.sx - x) * (t.sy - y) AS num,
             sqrt(((t.n - 1) * (t.sxx - x * x) - (t.sx - x) * (t.sx - x))
                  * ((t.n - 1) * (t.syy - y * y) - (t.sy - y) * (t.sy - y))) AS den
      FROM b CROSS JOIN t)
SELECT c_nationkey, (floor((x) * 1000000 + 0.5) / 1000000) AS log_volume, (floor((y) * 1000000 + 0.5) / 1000000) AS avg_acctbal, (floor((corr_all) * 1000000 + 0.5) / 1000000) AS corr_all,
       (floor((CASE WHEN den > 0 THEN num / den END) * 1000000 + 0.5) / 1000000) AS corr_without FROM z"""

SQL["ratio_of_totals"] = """
WITH b AS (SELECT l_returnflag, l_extendedprice AS bv, l_extendedprice * (1 - l_discount) AS av FROM lineitem
           WHERE l_extendedprice IS NOT NULL AND l_extendedprice <> 0)
SELECT l_returnflag, count(*) AS n_pairs, (floor((sum(av) / sum(bv) - 1) * 1000000 + 0.5) / 1000000) AS ratio_of_totals,
       (floor((avg(av / bv - 1)) * 1000000 + 0.5) / 1000000) AS mean_of_ratios, (floor((quantile_cont(av / bv - 1, 0.5)) * 1000000 + 0.5) / 1000000) AS median_of_ratios
FROM b GROUP BY 1"""

SQL["record_length"] = """
SELECT user_id, count(ts) AS n_records, min(ts) AS first_seen, max(ts) AS last_seen
FROM events GROUP BY 1 HAVING count(ts) >= 70"""

SQL["profile_table"] = """
SELECT 'l_orderkey' AS column_name, count(*) AS n_rows, count(l_orderkey) AS n_non_null,
       count(DISTINCT l_orderkey) AS n_distinct, CAST(min(l_orderkey) AS VARCHAR) AS min_value,
       CAST(max(l_orderkey) AS VARCHAR) AS max_value FROM lineitem
UNION ALL SELECT 'l_quantity', count(*), count(l_quantity), count(DISTINCT l_quantity),
       CAST(min(l_quantity) AS VARCHAR), CAST(max(l_quantity) AS VARCHAR) FROM lineitem
UNION ALL SELECT 'l_returnflag', count(*), count(l_returnflag), count(DISTINCT l_returnflag),
       CAST(min(l_returnflag) AS VARCHAR), CAST(max(l_returnflag) AS VARCHAR) FROM lineitem
UNION ALL SELECT 'l_shipdate', count(*), count(l_shipdate), count(DISTINCT l_shipdate),
       CAST(min(l_shipdate) AS VARCHAR), CAST(max(l_shipdate) AS VARCHAR) FROM lineitem"""

SQL["topk_with_label"] = """
WITH t AS (SELECT l_partkey, count(*) AS n_lines FROM lineitem GROUP BY 1 ORDER BY n_lines DESC, l_partkey LIMIT 10)
SELECT t.l_partkey AS p_partkey, p.p_name, t.n_lines FROM t LEFT JOIN part p ON t.l_partkey = p.p_partkey"""

_ORDER_PAIRS = """
  ptr AS (SELECT o_orderkey, o_custkey, o_orderdate, o_totalprice, o_orderpriority,
                 lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS prev_orderkey
          FROM orders),
  pairs AS (SELECT c.o_orderkey, c.prev_orderkey, c.o_custkey, c.o_orderpriority,
                   CAST(date_diff('day', p.o_orderdate, c.o_orderdate) AS INTEGER) AS interval_days,
                   round(c.o_totalprice - p.o_totalprice, 2) AS price_change,
                   round(c.o_totalprice - p.o_totalprice, 2)
                         / nullif(CAST(date_diff('day', p.o_orderdate, c.o_orderdate) AS INTEGER), 0) AS daily_rate
            FROM ptr c JOIN orders p ON c.prev_orderkey = p.o_orderkey
            WHERE c.o_orderdate > p.o_orderdate)"""

SQL["predecessor_self_join"] = f"WITH {_ORDER_PAIRS} SELECT * FROM pairs"

SQL["growth_by_site"] = f"""
WITH {_ORDER_PAIRS}
SELECT o_orderpriority, count(*) AS n_pairs, (floor((avg(daily_rate)) * 10000 + 0.5) / 10000) AS mean_rate,
       (floor((avg(interval_days)) * 10000 + 0.5) / 10000) AS mean_interval,
       (floor((quantile_cont(daily_rate, 0.5)) * 10000 + 0.5) / 10000) AS median_rate, (floor((quantile_cont(daily_rate, 0.9)) * 10000 + 0.5) / 10000) AS p90_rate
FROM pairs WHERE interval_days BETWEEN 30 AND 1000 GROUP BY 1 HAVING count(*) >= 50"""

SQL["before_after_change"] = """
WITH ev AS (SELECT o_custkey, CAST(year(min(o_orderdate)) AS INTEGER) AS event_year FROM orders
            WHERE o_orderpriority = '1-URGENT' GROUP BY 1),
j AS (SELECT o.o_custkey, ev.event_year, CAST(year(o.o_orderdate) AS INTEGER) AS y, o.o_totalprice,
             CASE WHEN year(o.o_orderdate) > ev.event_year THEN 'Post-fire'
                  WHEN year(o.o_orderdate) < ev.event_year THEN 'Pre-fire' ELSE 'Same year' END AS timing
      FROM orders o JOIN ev ON o.o_custkey = ev.o_custkey),
piv AS (SELECT o_custkey, event_year,
               max(CASE WHEN timing = 'Pre-fire' THEN y END) AS pre_year,
               max(CASE WHEN timing = 'Post-fire' THEN y END) AS post_year,
               max(CASE WHEN timing = 'Pre-fire' THEN o_totalprice END) AS pre_total,
               max(CASE WHEN timing = 'Post-fire' THEN o_totalprice END) AS post_total
        FROM j GROUP BY 1, 2)
SELECT *, post_year - pre_year AS remeasure_interval, round(post_total - pre_total, 2) AS total_change,
       (floor(((post_total - pre_total) / nullif(pre_total, 0) * 100) * 10000 + 0.5) / 10000) AS pct_change
FROM piv WHERE pre_year IS NOT NULL AND post_year IS NOT NULL"""

SQL["merge_incremental"] = """
WITH tgt AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderdate AS loaded_at
             FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
stg AS (SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate,
               o_orderdate + INTERVAL 1 DAY AS loaded_at, 1 AS revision
        FROM orders WHERE o_orderdate >= TIMESTAMP '1998-12-01'),
inc AS (SELECT * FROM stg WHERE loaded_at > (SELECT max(loaded_at) - INTERVAL 14 DAY FROM tgt))
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, loaded_at, CAST(NULL AS INTEGER) AS revision
FROM tgt WHERE o_orderkey NOT IN (SELECT o_orderkey FROM inc)
UNION ALL SELECT * FROM inc"""

SQL["scd2_history"] = """
WITH e2 AS (
  SELECT s_suppkey, CASE WHEN s_acctbal < 0 THEN s_name || ' (renamed)' ELSE s_name END AS s_name,
         CASE WHEN s_acctbal > 9000 THEN s_nationkey + 1 ELSE s_nationkey END AS s_nationkey,
         CASE WHEN s_acctbal BETWEEN 4000 AND 4500 THEN s_acctbal + 100 ELSE s_acctbal END AS s_acctbal
  FROM supplier WHERE NOT (s_acctbal BETWEEN 0 AND 500)
  UNION ALL SELECT s_suppkey + 1000000, s_name, s_nationkey, s_acctbal FROM supplier WHERE s_acctbal BETWEEN 500 AND 1000),
snap AS (SELECT s_suppkey, s_name, s_nationkey, s_acctbal, TIMESTAMP '2024-01-01' AS valid_from,
                CAST(NULL AS TIMESTAMP) AS valid_to FROM supplier)
SELECT s.* FROM snap s JOIN e2 c ON s.s_suppkey = c.s_suppkey
 WHERE s.s_name IS NOT DISTINCT FROM c.s_name AND s.s_nationkey IS NOT DISTINCT FROM c.s_nationkey
UNION ALL
SELECT s.s_suppkey, s.s_name, s.s_nationkey, s.s_acctbal, s.valid_from, TIMESTAMP '2024-02-01'
FROM snap s LEFT JOIN e2 c ON s.s_suppkey = c.s_suppkey
 WHERE c.s_suppkey IS NULL OR s.s_name IS DISTINCT FROM c.s_name OR s.s_nationkey IS DISTINCT FROM c.s_nationkey
UNION ALL
SELECT c.s_suppkey, c.s_name, c.s_nationkey, c.s_acctbal, TIMESTAMP '2024-02-01', CAST(NULL AS TIMESTAMP)
FROM e2 c LEFT JOIN snap s ON s.s_suppkey = c.s_suppkey
 WHERE s.s_suppkey IS NULL OR s.s_name IS DISTINCT FROM c.s_name OR s.s_nationkey IS DISTINCT FROM c.s_nationkey"""

SQL["dq_report"] = """
WITH r AS (
  SELECT 'not_null_l_orderkey' AS check_name, 'not_null' AS kind, 'error' AS severity,
         count(*) FILTER (WHERE l_orderkey IS NULL) AS failing_rows FROM lineitem
  UNION ALL SELECT 'accepted_values_l_returnflag', 'accepted_values', 'warn',
         count(*) FILTER (WHERE l_returnflag IS NOT NULL AND l_returnflag NOT IN ('A', 'N')) FROM lineitem
  UNION ALL SELECT 'accepted_range_l_discount', 'accepted_range', 'error',
         count(*) FILTER (WHERE l_discount IS NOT NULL AND (l_discount < 0 OR l_discount > 0.08)) FROM lineitem
  UNION ALL SELECT 'price_positive', 'expression', 'error',
         count(*) FILTER (WHERE l_extendedprice <= 0) FROM lineitem
  UNION ALL SELECT 'unique_l_orderkey_l_linenumber', 'unique', 'error', count(*) FROM
         (SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
          GROUP BY 1, 2 HAVING count(*) > 1)
  UNION ALL SELECT 'relationships_l_orderkey', 'relationships', 'error', count(*) FROM lineitem l
         WHERE l.l_orderkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey))
SELECT 'lineitem' AS table_name, check_name, kind, severity, failing_rows,
       CASE WHEN failing_rows = 0 THEN 'pass' WHEN severity = 'warn' THEN 'warn' ELSE 'fail' END AS status
FROM r"""

SQL["freshness"] = """
WITH m AS (SELECT max(ts) AS max_loaded_at FROM events)
SELECT 'events' AS source, max_loaded_at,
       (epoch_us(TIMESTAMP '2024-02-05 00:00:00') - epoch_us(max_loaded_at)) / 3600000000.0 AS age_hours,
       CASE WHEN max_loaded_at IS NULL THEN 'error'
            WHEN (epoch_us(TIMESTAMP '2024-02-05 00:00:00') - epoch_us(max_loaded_at)) / 86400000000.0 > 8 THEN 'error'
            WHEN (epoch_us(TIMESTAMP '2024-02-05 00:00:00') - epoch_us(max_loaded_at)) / 86400000000.0 > 4 THEN 'warn'
            ELSE 'pass' END AS status
FROM m"""

SQL["clean_keys"] = r"""
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) || '.0' AS key_text,
       regexp_replace(CAST(o_orderkey AS VARCHAR) || '.0', '\.0$', '') AS clean_key,
       TRY_CAST(regexp_replace(CAST(o_orderkey AS VARCHAR) || '.0', '\.0$', '') AS BIGINT) = o_orderkey AS round_trips,
       trim(upper('  ' || lower(o_orderpriority) || ' ')) AS priority_clean
FROM orders"""

SQL["concat_name"] = "SELECT p_partkey, p_brand || ' ' || p_type AS brand_type FROM part"

SQL["decade"] = """
SELECT CAST(floor(year(o_orderdate) / 10) * 10 AS INTEGER) AS decade, count(*) AS n_orders FROM orders GROUP BY 1"""

SQL["coverage_share"] = """
WITH pc AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1),
agg AS (SELECT c.c_nationkey, count(*) AS n_customers,
               sum(CASE WHEN pc.n IS NULL THEN 1 ELSE 0 END) AS idle_customers,
               coalesce(sum(pc.n), 0) AS n_orders
        FROM customer c LEFT JOIN pc ON c.c_custkey = pc.o_custkey GROUP BY 1),
j AS (SELECT n.n_nationkey, n.n_name, n.n_regionkey, coalesce(a.n_customers, 0) AS n_customers,
             CAST(coalesce(a.idle_customers, 0) AS BIGINT) AS idle_customers, CAST(coalesce(a.n_orders, 0) AS BIGINT) AS n_orders
      FROM nation n LEFT JOIN agg a ON n.n_nationkey = a.c_nationkey)
SELECT *, (floor((CAST(n_orders AS DOUBLE) * 100.0 / CAST(sum(n_orders) OVER (PARTITION BY n_regionkey) AS DOUBLE)) * 10000 + 0.5) / 10000) AS pct_of_region
FROM j"""

SQL["genus_rollup"] = """
SELECT split_part(p.p_name, ' ', 1) AS genus, count(*) AS n_lines,
       CAST(sum(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS BIGINT) AS returned_lines,
       (floor((CAST(sum(CASE WHEN l.l_returnflag = 'R' THEN 1 ELSE 0 END) AS DOUBLE) * 100.0
             / nullif(CAST(count(*) AS DOUBLE), 0.0)) * 10000 + 0.5) / 10000) AS pct_returned
FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey GROUP BY 1"""

SQL["owner_summary"] = """
WITH j AS (SELECT s.s_nationkey, l.l_returnflag = 'R' AS ret, CAST(round(l.l_extendedprice * 100) AS BIGINT) AS cents
           FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey),
a AS (SELECT s_nationkey, count(*) AS n_lines, CAST(sum(CASE WHEN ret THEN 1 ELSE 0 END) AS BIGINT) AS returned_lines,
             sum(cents) AS tot, sum(CASE WHEN ret THEN cents ELSE 0 END) AS rv FROM j GROUP BY 1)
SELECT s_nationkey, n_lines, returned_lines,
       (floor((CAST(returned_lines AS DOUBLE) * 100.0 / nullif(CAST(n_lines AS DOUBLE), 0.0)) * 10000 + 0.5) / 10000) AS pct_returned_by_count,
       (floor((CAST(rv AS DOUBLE) * 100.0 / nullif(CAST(tot AS DOUBLE), 0.0)) * 10000 + 0.5) / 10000) AS pct_returned_by_value
FROM a"""

SQL["stand_structure"] = """
WITH a AS (
  SELECT l_returnflag,
         CASE WHEN l_quantity < 5 THEN '1-5 in' WHEN l_quantity < 10 THEN '5-10 in'
              WHEN l_quantity < 15 THEN '10-15 in' WHEN l_quantity < 20 THEN '15-20 in'
              WHEN l_quantity < 30 THEN '20-30 in' WHEN l_quantity < 40 THEN '30-40 in'
              ELSE '40+ in' END AS quantity_class,
         count(*) AS line_count, sum(l_quantity) AS sum_qty, (floor((avg(l_discount)) * 10000 + 0.5) / 10000) AS avg_discount
  FROM lineitem WHERE l_linestatus = 'O' GROUP BY 1, 2)
SELECT *, (floor((CAST(line_count AS DOUBLE) * 100.0
                / CAST(sum(line_count) OVER (PARTITION BY l_returnflag) AS DOUBLE)) * 10000 + 0.5) / 10000) AS pct_of_lines
FROM a"""

# ---------------------------------------------------------------- geometry (brute force)
from ..constants import EARTH_RADIUS_M as _R  # noqa: E402
import math as _m  # noqa: E402

_DEGR = _m.pi / 180.0 * _R

_NATION_V = """
  off AS (SELECT * FROM (VALUES (0, 0, 8, 0), (0, 1, 0, 8), (0, 2, -8, 0), (0, 3, 0, -8), (0, 4, 8, 0),
                                (1, 0, -2, -2), (1, 1, 2, -2), (1, 2, 2, 2), (1, 3, -2, 2), (1, 4, -2, -2))
          t(ring, idx, dx, dy)),
  v AS (SELECT n.n_nationkey, o.ring, o.idx, CAST(-170 + 14 * n.n_nationkey + o.dx AS DOUBLE) AS x,
               CAST(-60 + 30 * (n.n_nationkey % 5) + o.dy AS DOUBLE) AS y
        FROM nation n CROSS JOIN off o WHERE o.ring = 0 OR n.n_nationkey % 2 = 0),
  e AS (SELECT n_nationkey, ring, idx, x AS x1, y AS y1,
               lead(x) OVER (PARTITION BY n_nationkey, ring ORDER BY idx) AS x2,
               lead(y) OVER (PARTITION BY n_nationkey, ring ORDER BY idx) AS y2 FROM v),
  e2 AS (SELECT * FROM e WHERE x2 IS NOT NULL)"""


_SUPP_V = """
  soff AS (SELECT * FROM (VALUES (0, 0, 1.0, 0.0), (0, 1, 0.0, 1.0), (0, 2, -1.0, 0.0), (0, 3, 0.0, -1.0), (0, 4, 1.0, 0.0),
                                 (1, 0, -0.25, -0.25), (1, 1, 0.25, -0.25), (1, 2, 0.25, 0.25), (1, 3, -0.25, 0.25),
                                 (1, 4, -0.25, -0.25)) t(ring, idx, dx, dy)),
  sc AS (SELECT s_suppkey, -170 + (s_suppkey * 7919) % 340 AS cx, -60 + (s_suppkey * 104729) % 120 AS cy FROM supplier),
  v AS (SELECT sc.s_suppkey, o.ring, o.idx, CAST(sc.cx AS DOUBLE) + CAST(o.dx AS DOUBLE) AS x,
               CAST(sc.cy AS DOUBLE) + CAST(o.dy AS DOUBLE) AS y
        FROM sc CROSS JOIN soff o WHERE o.ring = 0 OR sc.s_suppkey % 2 = 0),
  e AS (SELECT s_suppkey, ring, idx, x AS x1, y AS y1,
               lead(x) OVER (PARTITION BY s_suppkey, ring ORDER BY idx) AS x2,
               lead(y) OVER (PARTITION BY s_suppkey, ring ORDER BY idx) AS y2 FROM v),
  e2 AS (SELECT * FROM e WHERE x2 IS NOT NULL)"""

_CUST_PTS = """
  pts AS (SELECT c_custkey, c_nationkey,
                 CAST(-180.0 AS DOUBLE) + (CAST((c_custkey * 7919) % 360000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(1000.0 AS DOUBLE) AS lon,
                 CAST(-70.0 AS DOUBLE) + (CAST((c_custkey * 104729) % 140000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(1000.0 AS DOUBLE) AS lat
          FROM customer)"""

_SUPP_PTS = """
  spts AS (SELECT s_suppkey, s_nationkey,
                  ((CAST(-170.0 AS DOUBLE) + 14 * s_nationkey)
                   + (CAST((s_suppkey * 7919) % 24000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(1000.0 AS DOUBLE)) - CAST(12.0 AS DOUBLE) AS lon,
                  ((CAST(-60.0 AS DOUBLE) + 30 * (s_nationkey % 5))
                   + (CAST((s_suppkey * 104729) % 24000 AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST(1000.0 AS DOUBLE)) - CAST(12.0 AS DOUBLE) AS lat
           FROM supplier)"""

# boundary counts as inside (same tolerance as the library's contains_point)
_ONEDGE = ("(abs((e2.x2 - e2.x1) * (p.lat - e2.y1) - (e2.y2 - e2.y1) * (p.lon - e2.x1)) <= 1e-12 "
           "AND p.lon BETWEEN least(e2.x1, e2.x2) - 1e-12 AND greatest(e2.x1, e2.x2) + 1e-12 "
           "AND p.lat BETWEEN least(e2.y1, e2.y2) - 1e-12 AND greatest(e2.y1, e2.y2) + 1e-12)")
_CROSS = "CASE WHEN ((e2.y1 > p.lat) <> (e2.y2 > p.lat)) AND (p.lon < (e2.x2 - e2.x1) * (p.lat - e2.y1) / (e2.y2 - e2.y1) + e2.x1) THEN 1 ELSE 0 END"


def _hav_sql(x1, y1, x2, y2):
    return (f"(2 * asin(least(1.0, sqrt(pow(sin((radians({y2}) - radians({y1})) / 2), 2) + cos(radians({y1})) * cos(radians({y2})) "
            f"* pow(sin((radians({x2}) - radians({x1})) / 2), 2)))))")


def _bearing_sql(x1, y1, x2, y2):
    dx = f"(radians({x2}) - radians({x1}))"
    return (f"atan2(sin({dx}) * cos(radians({y2})), cos(radians({y1})) * sin(radians({y2})) - sin(radians({y1})) * cos(radians({y2})) * cos({dx}))")


def _seg_dist_sql(px, py):
    """Haversine distances to the ends; between them the cross-track distance."""
    to_p, to_b = _hav_sql("x1", "y1", px, py), _hav_sql("x1", "y1", "x2", "y2")
    turn = f"({_bearing_sql('x1', 'y1', px, py)} - {_bearing_sql('x1', 'y1', 'x2', 'y2')})"
    along = f"atan2(sin({to_p}) * cos({turn}), cos({to_p}))"
    ends = f"least({to_p}, {_hav_sql('x2', 'y2', px, py)})"
    return (f"{_R!r} * (CASE WHEN {to_b} > 1e-12 AND cos({turn}) >= 0 AND {along} <= {to_b} "
            f"THEN abs(asin(greatest(-1.0, least(1.0, sin({to_p}) * sin({turn}))))) ELSE {ends} END)")


SQL["spatial_join_grid"] = f"""
WITH {_NATION_V}, {_CUST_PTS},
cr AS (SELECT p.c_custkey, e2.n_nationkey, sum({_CROSS}) AS c, bool_or({_ONEDGE}) AS edge
       FROM pts p CROSS JOIN e2 GROUP BY 1, 2)
SELECT c_custkey, n_nationkey FROM cr WHERE c % 2 = 1 OR edge"""

SQL["point_in_polygon"] = f"""
WITH {_NATION_V}, {_CUST_PTS},
cr AS (SELECT p.c_custkey, e2.n_nationkey, sum({_CROSS}) AS c, bool_or({_ONEDGE}) AS edge
       FROM pts p CROSS JOIN e2 GROUP BY 1, 2),
hits AS (SELECT c_custkey, count(*) AS n FROM cr WHERE c % 2 = 1 OR edge GROUP BY 1)
SELECT p.c_custkey, coalesce(h.n, 0) AS n_polygons, h.n IS NOT NULL AS inside
FROM pts p LEFT JOIN hits h ON p.c_custkey = h.c_custkey"""

_RING_AREA = (f"abs(sum((radians(x2) - radians(x1)) * (2 + sin(radians(y1)) + sin(radians(y2))))) * {_R * _R / 2.0!r}")
_HAV = (f"2 * {_R!r} * asin(sqrt(pow(sin((radians(y2) - radians(y1)) / 2), 2) + "
        f"cos(radians(y1)) * cos(radians(y2)) * pow(sin((radians(x2) - radians(x1)) / 2), 2)))")

SQL["polygon_area"] = f"""
WITH {_SUPP_V},
ra AS (SELECT s_suppkey, ring, {_RING_AREA} AS a, sum({_HAV}) AS len FROM e2 GROUP BY 1, 2),
pa AS (SELECT s_suppkey, sum(CASE WHEN ring = 0 THEN a ELSE -a END) AS a, sum(len) AS len FROM ra GROUP BY 1),
nv AS (SELECT s_suppkey, CAST(count(*) AS INTEGER) AS n_vertices FROM v GROUP BY 1)
SELECT pa.s_suppkey, (floor((a / 1e6) * 1000000 + 0.5) / 1000000) AS area_km2,
       (floor((len / 1e3) * 1000000 + 0.5) / 1000000) AS perimeter_km,
       (floor((len / (2 * sqrt(pi() * a))) * 1000000 + 0.5) / 1000000) AS compactness, nv.n_vertices
FROM pa JOIN nv ON pa.s_suppkey = nv.s_suppkey"""

SQL["geo_distance"] = f"""
WITH {_NATION_V}, {_SUPP_PTS}
SELECT p.s_suppkey, e2.n_nationkey, round(min({_seg_dist_sql('p.lon', 'p.lat')}), 3) AS distance_m
FROM spts p JOIN e2 ON p.s_nationkey = e2.n_nationkey GROUP BY 1, 2"""

SQL["nearest_geom"] = f"""
WITH {_NATION_V}, {_SUPP_PTS},
d AS (SELECT p.s_suppkey, e2.n_nationkey, min({_seg_dist_sql('p.lon', 'p.lat')}) AS dist
      FROM spts p CROSS JOIN e2 GROUP BY 1, 2)
SELECT s_suppkey, n_nationkey, round(dist, 3) AS distance_m FROM d
QUALIFY row_number() OVER (PARTITION BY s_suppkey ORDER BY dist, n_nationkey) = 1"""

SQL["nearest_three"] = f"""
WITH {_NATION_V}, {_SUPP_PTS},
d AS (SELECT p.s_suppkey, e2.n_nationkey, min({_seg_dist_sql('p.lon', 'p.lat')}) AS dist
      FROM spts p CROSS JOIN e2 GROUP BY 1, 2)
SELECT s_suppkey, row_number() OVER (PARTITION BY s_suppkey ORDER BY dist, n_nationkey) AS rank, n_nationkey, round(dist, 3) AS distance_m FROM d
QUALIFY rank <= 3"""

SQL["bbox_assign"] = f"""
WITH {_CUST_PTS},
b AS (SELECT n_nationkey, CAST(-170 + 14 * n_nationkey - 8 AS DOUBLE) AS xmin, CAST(-170 + 14 * n_nationkey + 8 AS DOUBLE) AS xmax,
             CAST(-60 + 30 * (n_nationkey % 5) - 8 AS DOUBLE) AS ymin, CAST(-60 + 30 * (n_nationkey % 5) + 8 AS DOUBLE) AS ymax
      FROM nation)
SELECT p.c_custkey, b.n_nationkey FROM pts p JOIN b
  ON p.lon BETWEEN b.xmin AND b.xmax AND p.lat BETWEEN b.ymin AND b.ymax"""

SQL["wkt_roundtrip"] = f"""
WITH {_SUPP_V},
rt AS (SELECT s_suppkey, ring, '(' || string_agg(CAST(x AS VARCHAR) || ' ' || CAST(y AS VARCHAR), ', ' ORDER BY idx) || ')' AS t
       FROM v GROUP BY 1, 2)
SELECT s_suppkey, 'POLYGON (' || string_agg(t, ', ' ORDER BY ring) || ')' AS wkt_out FROM rt GROUP BY 1"""

_ORIENT = "sign(({qx} - {px}) * ({ry} - {py}) - ({qy} - {py}) * ({rx} - {px}))"


def _o(p, q, r):
    return _ORIENT.format(px=f"{p}x", py=f"{p}y", qx=f"{q}x", qy=f"{q}y", rx=f"{r}x", ry=f"{r}y")


_TOUCH = (f"((({_o('sc', 'sd', 'sa')}) * ({_o('sc', 'sd', 'sb')}) < 0 AND ({_o('sa', 'sb', 'sc')}) * ({_o('sa', 'sb', 'sd')}) < 0) OR "
          f"((({_o('sc', 'sd', 'sa')}) * ({_o('sc', 'sd', 'sb')}) <= 0 AND ({_o('sa', 'sb', 'sc')}) * ({_o('sa', 'sb', 'sd')}) <= 0) AND "
          "greatest(least(sax, sbx), least(scx, sdx)) <= least(greatest(sax, sbx), greatest(scx, sdx)) AND "
          "greatest(least(say, sby), least(scy, sdy)) <= least(greatest(say, sby), greatest(scy, sdy))))")

SQL["geometry_validity"] = f"""
WITH {_SUPP_V},
bowoff AS (SELECT * FROM (VALUES (0, 1.0, 0.0), (1, -1.0, 0.0), (2, 0.0, 1.0), (3, 0.0, -1.0), (4, 1.0, 0.0)) t(idx, dx, dy)),
vb AS (SELECT sc.s_suppkey, 0 AS ring, o.idx, CAST(sc.cx AS DOUBLE) + CAST(o.dx AS DOUBLE) AS x,
              CAST(sc.cy AS DOUBLE) + CAST(o.dy AS DOUBLE) AS y
       FROM sc CROSS JOIN bowoff o WHERE sc.s_suppkey % 2 = 1 AND sc.s_suppkey % 3 = 0),
vv AS (SELECT * FROM v WHERE NOT (s_suppkey % 2 = 1 AND s_suppkey % 3 = 0) UNION ALL SELECT * FROM vb),
ee AS (SELECT s_suppkey, ring, idx, x AS sax, y AS say,
              lead(x) OVER (PARTITION BY s_suppkey, ring ORDER BY idx) AS sbx,
              lead(y) OVER (PARTITION BY s_suppkey, ring ORDER BY idx) AS sby,
              count(*) OVER (PARTITION BY s_suppkey, ring) AS nv FROM vv),
ed AS (SELECT * FROM ee WHERE sbx IS NOT NULL),
bad AS (SELECT DISTINCT e1.s_suppkey FROM ed e1
        JOIN (SELECT s_suppkey, ring, idx, sax AS scx, say AS scy, sbx AS sdx, sby AS sdy FROM ed) e2
          ON e1.s_suppkey = e2.s_suppkey AND e1.ring = e2.ring AND e2.idx >= e1.idx + 2
         AND NOT (e1.idx = 0 AND e2.idx = e1.nv - 2)
        WHERE {_TOUCH})
SELECT s.s_suppkey, b.s_suppkey IS NULL AS is_valid,
       CASE WHEN b.s_suppkey IS NOT NULL THEN 'self-intersection' END AS reason
FROM supplier s LEFT JOIN bad b ON s.s_suppkey = b.s_suppkey"""

def _albers_sql():
    from ..functions.geo import _albers_constants
    k = _albers_constants()
    a, e2, n, C, rho0, qp = k["a"], k["e2"], k["n"], k["C"], k["rho0"], k["qp"]
    e4, e6 = e2 * e2, e2 * e2 * e2
    c1 = e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040
    c2 = 23 * e4 / 360 + 251 * e6 / 3780
    c3 = 761 * e6 / 45360
    X = f"(x - {k['x0']!r})"
    Y = f"(y - {k['y0']!r})"
    rho = f"sqrt({X} * {X} + ({rho0!r} - {Y}) * ({rho0!r} - {Y}))"
    theta = f"atan2({X}, {rho0!r} - {Y})"
    qv = f"(({C!r} - {rho} * {rho} * {n * n!r} / {a * a!r}) / {n!r})"
    beta = f"asin(greatest(-1.0, least(1.0, {qv} / {qp!r})))"
    phi = f"({beta} + {c1!r} * sin(2 * {beta}) + {c2!r} * sin(4 * {beta}) + {c3!r} * sin(6 * {beta}))"
    lon = f"({k['lon0']!r} + degrees({theta} / {n!r}))"
    return f"""
WITH xy AS (SELECT c_custkey, CAST((c_custkey * 7919) % 4000000 AS DOUBLE) - 2000000.0 AS x,
                   CAST((c_custkey * 104729) % 2500000 AS DOUBLE) + 500000.0 AS y FROM customer)
SELECT c_custkey, round({lon}, 7) AS lon, round(degrees({phi}), 7) AS lat FROM xy"""


SQL["reproject_points"] = _albers_sql()

SQL["class_summary"] = """
SELECT o_orderpriority, count(*) AS n_orders,
       avg(CAST(round(o_totalprice * 100) AS BIGINT)) / 100.0 AS mean_total
FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY 1"""

SQL["load_audit"] = """
SELECT count(*) AS n_rows, CAST(min(year(o_orderdate)) AS INTEGER) AS min_year,
       CAST(max(year(o_orderdate)) AS INTEGER) AS max_year,
       count(*) FILTER (WHERE year(o_orderdate) >= 2000) AS n_since_2000
FROM orders"""

SQL["point_report"] = f"""
WITH {_NATION_V}, {_CUST_PTS},
ed AS (SELECT p.c_custkey, e2.n_nationkey, sum({_CROSS}) AS c, bool_or({_ONEDGE}) AS edge,
              min({_seg_dist_sql('p.lon', 'p.lat')}) AS dmin
       FROM pts p JOIN e2 ON p.c_nationkey = e2.n_nationkey GROUP BY 1, 2)
SELECT c_custkey, n_nationkey, (c % 2 = 1 OR edge) AS inside,
       round(CASE WHEN c % 2 = 1 OR edge THEN 0.0 ELSE dmin END / 1000.0, 3) AS distance_km
FROM ed"""

SQL["repair_geometry"] = """
WITH off AS (SELECT * FROM (VALUES (0, 1, 0), (1, 1, 0), (2, 0, 1), (3, -1, 0), (4, 0, -1)) t(idx, dx, dy)),
sc AS (SELECT s_suppkey, -170 + (s_suppkey * 7919) % 340 AS cx, -60 + (s_suppkey * 104729) % 120 AS cy FROM supplier),
v AS (SELECT sc.s_suppkey, o.idx, CAST(sc.cx + o.dx AS DOUBLE) AS x, CAST(sc.cy + o.dy AS DOUBLE) AS y
      FROM sc CROSS JOIN off o),
d AS (SELECT *, lag(x) OVER w AS px, lag(y) OVER w AS py
      FROM v WINDOW w AS (PARTITION BY s_suppkey ORDER BY idx)),
kept AS (SELECT s_suppkey, idx, x, y FROM d WHERE px IS NULL OR NOT (x = px AND y = py)),
lastv AS (SELECT s_suppkey, arg_max(x, idx) AS lx, arg_max(y, idx) AS ly, min(idx) AS i0, max(idx) AS imax FROM kept GROUP BY 1),
firstv AS (SELECT k.s_suppkey, k.x AS fx, k.y AS fy FROM kept k JOIN lastv l ON k.s_suppkey = l.s_suppkey AND k.idx = l.i0),
closed AS (SELECT s_suppkey, idx, x, y FROM kept
           UNION ALL
           SELECT f.s_suppkey, l.imax + 1, f.fx, f.fy FROM firstv f JOIN lastv l ON f.s_suppkey = l.s_suppkey
           WHERE NOT (f.fx = l.lx AND f.fy = l.ly)),
before AS (SELECT s_suppkey, CASE WHEN count(*) < 4 THEN 'ring too short'
                                  WHEN arg_min(x, idx) <> arg_max(x, idx) OR arg_min(y, idx) <> arg_max(y, idx)
                                  THEN 'ring not closed' END AS reason_before FROM v GROUP BY 1)
SELECT c.s_suppkey, b.reason_before,
       'POLYGON ((' || string_agg(CAST(c.x AS VARCHAR) || ' ' || CAST(c.y AS VARCHAR), ', ' ORDER BY c.idx) || '))' AS wkt_after,
       count(*) >= 4 AS valid_after
FROM closed c JOIN before b ON c.s_suppkey = b.s_suppkey GROUP BY c.s_suppkey, b.reason_before"""

SQL["overlap_fraction"] = f"""
WITH {_SUPP_V},
bv AS (SELECT r_regionkey, c.idx,
              CASE WHEN c.idx IN (1, 2) THEN (CAST(-172.9 AS DOUBLE) + 70 * r_regionkey) + 30
                   ELSE CAST(-172.9 AS DOUBLE) + 70 * r_regionkey END AS x,
              CASE WHEN c.idx IN (2, 3) THEN CAST(30.1 AS DOUBLE) ELSE CAST(-20.1 AS DOUBLE) END AS y
       FROM region CROSS JOIN (SELECT * FROM range(0, 5) t(idx)) c),
be AS (SELECT r_regionkey, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2
       FROM bv WINDOW w AS (PARTITION BY r_regionkey ORDER BY idx)),
be2 AS (SELECT * FROM be WHERE x2 IS NOT NULL),
bb AS (SELECT s_suppkey, min(x) AS xmin, max(x) AS xmax, min(y) AS ymin, max(y) AS ymax FROM v GROUP BY 1),
lat AS (SELECT bb.s_suppkey, i.i, j.j,
               bb.xmin + (CAST(i.i AS DOUBLE) + CAST(0.5 AS DOUBLE)) * CAST(0.35 AS DOUBLE) AS lon,
               bb.ymin + (CAST(j.j AS DOUBLE) + CAST(0.5 AS DOUBLE)) * CAST(0.35 AS DOUBLE) AS lat
        FROM bb, range(0, 6) i(i), range(0, 6) j(j)),
inb AS (SELECT p.s_suppkey, p.i, p.j, p.lon, p.lat FROM lat p JOIN e2 ON p.s_suppkey = e2.s_suppkey
        GROUP BY 1, 2, 3, 4, 5 HAVING sum({_CROSS}) % 2 = 1),
burned AS (SELECT p.s_suppkey, p.i, p.j FROM inb p CROSS JOIN be2 e2
           GROUP BY p.s_suppkey, p.i, p.j, e2.r_regionkey HAVING sum({_CROSS}) % 2 = 1),
bd AS (SELECT DISTINCT s_suppkey, i, j FROM burned),
tot AS (SELECT s_suppkey, sum(cos(radians(lat))) AS t FROM inb GROUP BY 1),
hit AS (SELECT b.s_suppkey, sum(cos(radians(p.lat))) AS h FROM bd b
        JOIN inb p ON b.s_suppkey = p.s_suppkey AND b.i = p.i AND b.j = p.j GROUP BY 1)
SELECT s.s_suppkey,
       (floor((CASE WHEN coalesce(t.t, 0.0) > 0 THEN coalesce(h.h, 0.0) / t.t * 100 ELSE 0.0 END) * 1000000 + 0.5) / 1000000) AS pct_burned
FROM supplier s LEFT JOIN tot t ON s.s_suppkey = t.s_suppkey LEFT JOIN hit h ON s.s_suppkey = h.s_suppkey"""


SQL["anomalous_hour_dates"] = """
WITH l AS (SELECT event_type, value, timezone('America/Los_Angeles', timezone('UTC', ts)) AS lt FROM events)
SELECT event_type, CAST(lt AS DATE) AS local_day, count(*) AS n_events,
       (floor((avg(value)) * 10000 + 0.5) / 10000) AS mean_value
FROM l WHERE hour(lt) = 13 GROUP BY 1, 2"""

SQL["stream_dedup"] = "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events"

SQL["rb_flashiness"] = ("SELECT region, water_year, sum_abs_change, sum_discharge, rb_flashiness_index FROM ("
                        + SQL["water_year_summary"] + ")")
SQL["wettest_rank"] = ("SELECT region, water_year, annual_volume_af, wettest_year_rank FROM ("
                       + SQL["water_year_summary"] + ")")

_ORDER_VERSIONS = """
tgt AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderdate AS loaded_at
        FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
stg AS (SELECT o_orderkey, o_custkey, 'F' AS o_orderstatus, o_totalprice + 1.0 AS o_totalprice, o_orderdate,
               o_orderdate + INTERVAL 1 DAY AS loaded_at, 1 AS revision
        FROM orders WHERE o_orderdate >= TIMESTAMP '1998-12-01')"""

SQL["lookback"] = f"""
WITH {_ORDER_VERSIONS}
SELECT * FROM stg WHERE loaded_at > (SELECT max(loaded_at) - INTERVAL 14 DAY FROM tgt)"""

SQL["append_columns"] = "SELECT o_orderkey, o_orderstatus, revision FROM (" + SQL["merge_incremental"] + ")"

SQL["top_values"] = """
SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_partkey LIMIT 10"""

# every cell of the level that a polygon's box touches; a middle on an edge counts as inside
_CELL = 360.0 / 2 ** 12
SQL["overlap_adaptive"] = f"""
WITH {_SUPP_V},
bv AS (SELECT r_regionkey, c.idx,
              CASE WHEN c.idx IN (1, 2) THEN (CAST(-172.9 AS DOUBLE) + 70 * r_regionkey) + 30
                   ELSE CAST(-172.9 AS DOUBLE) + 70 * r_regionkey END AS x,
              CASE WHEN c.idx IN (2, 3) THEN CAST(30.1 AS DOUBLE) ELSE CAST(-20.1 AS DOUBLE) END AS y
       FROM region CROSS JOIN (SELECT * FROM range(0, 5) t(idx)) c),
be AS (SELECT r_regionkey, x AS x1, y AS y1, lead(x) OVER w AS x2, lead(y) OVER w AS y2
       FROM bv WINDOW w AS (PARTITION BY r_regionkey ORDER BY idx)),
be2 AS (SELECT * FROM be WHERE x2 IS NOT NULL),
bb AS (SELECT s_suppkey, floor((min(x) + 180) / {_CELL!r}) AS cx0, floor((max(x) + 180) / {_CELL!r}) AS cx1,
              floor((min(y) + 180) / {_CELL!r}) AS cy0, floor((max(y) + 180) / {_CELL!r}) AS cy1 FROM v GROUP BY 1),
cells AS (SELECT s_suppkey, cx0 + i.i AS cx, cy0 + j.j AS cy FROM bb, range(0, 26) i(i), range(0, 26) j(j) WHERE cx0 + i.i <= cx1 AND cy0 + j.j <= cy1),
lat AS (SELECT s_suppkey, cx, cy, (cx + 0.5) * {_CELL!r} - 180 AS lon, (cy + 0.5) * {_CELL!r} - 180 AS lat FROM cells),
inb AS (SELECT p.s_suppkey, p.cx, p.cy, p.lon, p.lat FROM lat p JOIN e2 ON p.s_suppkey = e2.s_suppkey
        GROUP BY 1, 2, 3, 4, 5 HAVING sum({_CROSS}) % 2 = 1 OR bool_or({_ONEDGE})),
burned AS (SELECT DISTINCT s_suppkey, cx, cy FROM (
             SELECT p.s_suppkey, p.cx, p.cy FROM inb p CROSS JOIN be2 e2
             GROUP BY p.s_suppkey, p.cx, p.cy, e2.r_regionkey HAVING sum({_CROSS}) % 2 = 1 OR bool_or({_ONEDGE}))),
w AS (SELECT i.s_suppkey, sin(radians((i.cy + 1) * {_CELL!r} - 180)) - sin(radians(i.cy * {_CELL!r} - 180)) AS area, b.cx IS NOT NULL AS hit
      FROM inb i LEFT JOIN burned b ON i.s_suppkey = b.s_suppkey AND i.cx = b.cx AND i.cy = b.cy)
SELECT s_suppkey, floor((sum(CASE WHEN hit THEN area ELSE 0 END) / sum(area) * 100) * 1000000 + 0.5) / 1000000 AS pct_burned FROM w GROUP BY 1"""

SQL["ring_crossings"] = f"""
WITH {_CUST_PTS},
c AS (SELECT c_custkey // 64 AS block, c_custkey, lon, lat, row_number() OVER k AS ki, row_number() OVER l AS li, count(*) OVER (PARTITION BY c_custkey // 64) AS n
      FROM pts WINDOW k AS (PARTITION BY c_custkey // 64 ORDER BY c_custkey), l AS (PARTITION BY c_custkey // 64 ORDER BY lon, c_custkey)),
rv AS (SELECT block, 0 AS ring, ki AS i, lon AS x, lat AS y FROM c
       UNION ALL SELECT block, 0, n + 1, lon, lat FROM c WHERE ki = 1
       UNION ALL SELECT block, 1, li, lon, lat FROM c
       UNION ALL SELECT block, 1, n + 1, lon, 80 FROM c WHERE li = n
       UNION ALL SELECT block, 1, n + 2, lon, 80 FROM c WHERE li = 1
       UNION ALL SELECT block, 1, n + 3, lon, lat FROM c WHERE li = 1),
re AS (SELECT block, ring, i, x, y, lead(x) OVER w AS bx, lead(y) OVER w AS by_, count(*) OVER (PARTITION BY block, ring) - 1 AS m
       FROM rv WINDOW w AS (PARTITION BY block, ring ORDER BY i)),
pr AS (SELECT a.block, a.ring, a.i, b.i AS j, a.m, a.x AS sax, a.y AS say, a.bx AS sbx, a.by_ AS sby, b.x AS scx, b.y AS scy, b.bx AS sdx, b.by_ AS sdy
       FROM re a JOIN re b ON a.block = b.block AND a.ring = b.ring AND b.i >= a.i + 2 AND a.bx IS NOT NULL AND b.bx IS NOT NULL
                          AND NOT (a.i = 1 AND b.i = a.m)),
hit AS (SELECT DISTINCT block, ring FROM pr WHERE {_TOUCH})
SELECT b.block, bool_or(coalesce(h.ring = 0, false)) AS by_key_crosses, bool_or(coalesce(h.ring = 1, false)) AS by_lon_crosses
FROM (SELECT DISTINCT block FROM c) b LEFT JOIN hit h ON b.block = h.block GROUP BY 1"""
