"""DuckDB SQL stating, independently of Spark, the result of every registered
query (same column names and types). Runs on the driver tables registered as
views. Every statement reads whole tables."""

from __future__ import annotations

ORACLE: dict[str, str] = {
    "species_replace": """
        SELECT CAST(p_partkey AS INTEGER) AS species_id, p_name || ' ' || p_partkey AS species_acpt_sci_name,
               p_size <= 25 AS aggregate
        FROM part""",
    "store_refusal": """
        SELECT 'b_count' AS tbl, 'not_null' AS "check", count(*) FILTER (l_linenumber >= 7) AS n FROM lineitem
        UNION ALL SELECT 'b_count', 'primary_key', CAST(coalesce(sum(n), 0) AS BIGINT)
            FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
        UNION ALL SELECT 'b_count', 'fk_visit_id', count(*) FROM lineitem
        UNION ALL SELECT 'b_count', 'fk_site_id', count(*) FROM lineitem
        UNION ALL SELECT 'b_count', 'fk_species_id', count(*) FROM lineitem
            WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 25)""",
    "unknown_species": """
        SELECT l_returnflag AS bms_id, p_name || ' ' || p_size AS sci_name, count(*) AS n
        FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_size <= 25 GROUP BY ALL""",
    "load_rejects": """
        SELECT o_orderstatus AS bms_id, 'visit_date' AS col, '2023-13-45' AS value, count(*) AS n
        FROM orders WHERE o_orderpriority = '5-LOW' GROUP BY ALL
        UNION ALL SELECT o_orderstatus, 'start_time', '25:' || o_orderstatus, count(*)
        FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY ALL
        UNION ALL SELECT o_orderstatus, 'completed', 'maybe', count(*)
        FROM orders WHERE o_totalprice > 100000 GROUP BY ALL""",
    "species_reference": """
        SELECT DISTINCT CAST(p_partkey AS INTEGER) AS species_id, p_name AS species_acpt_sci_name,
               p_size > 25 AS aggregate
        FROM part""",
    "keep_first": """
        SELECT p_name, p_partkey, p_brand FROM (
          SELECT *, row_number() OVER (PARTITION BY p_name ORDER BY p_partkey) AS rn FROM part) WHERE rn = 1""",
    "merge_checklist": """
        WITH k AS (SELECT nullif(p_name, 'cold widget') AS nm, min(p_partkey) AS species_id FROM part GROUP BY 1),
        x AS (SELECT l_orderkey, l_linenumber, l_partkey, nullif(p_name, 'cold widget') AS nm
              FROM lineitem JOIN part ON l_partkey = p_partkey)
        SELECT l_orderkey, l_linenumber, l_partkey, k.species_id
        FROM x LEFT JOIN k ON x.nm IS NOT DISTINCT FROM k.nm""",
    "fill_missing": """
        SELECT o_orderkey,
               coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END, 9999) AS recorder_code,
               coalesce(CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END, 9999) AS bms_observer_id
        FROM orders""",
    "distinct_on": """
        SELECT DISTINCT ON (o_custkey) o_custkey, o_orderkey, o_totalprice
        FROM orders ORDER BY o_custkey, o_orderdate NULLS LAST, o_orderkey""",
    "site_dim": """
        WITH st AS (
          SELECT DISTINCT r_name AS bms_id, r_name || '.' || n_name AS transect_id, s_name AS section_id,
                 CAST(s_suppkey AS INTEGER) AS bms_site_id, CAST(CAST(s_acctbal AS DECIMAL(20,6)) AS DOUBLE) AS section_length,
                 CASE WHEN s_acctbal < 0 THEN '2' ELSE '31' END AS monitoring_type
          FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
        SELECT row_number() OVER (ORDER BY transect_id, section_id, bms_site_id) AS site_id, bms_id, transect_id,
               section_id, bms_site_id, section_length, monitoring_type
        FROM st""",
    "recorder_dim": """
        SELECT row_number() OVER (ORDER BY v.obs NULLS LAST) AS recorder_id, d.r_name AS bms_id,
               CAST(v.obs AS VARCHAR) AS bms_observer_id
        FROM (SELECT DISTINCT CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS obs FROM orders) AS v,
             (SELECT r_name FROM region WHERE r_name = 'EUROPE') AS d""",
    "visit_fact": """
        WITH v AS (SELECT * FROM (SELECT o.*, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
                                  FROM orders o) WHERE rn = 1),
        r AS (SELECT CAST(o_orderkey AS VARCHAR) AS obs, row_number() OVER (ORDER BY o_orderkey) AS recorder_id
              FROM (SELECT DISTINCT o_orderkey FROM orders WHERE o_orderpriority <> '5-LOW'))
        SELECT row_number() OVER (ORDER BY v.o_custkey) AS visit_id, CAST(v.o_custkey AS INTEGER) AS bms_visit_id,
               r.recorder_id, 'EUROPE' AS bms_id, 'EUROPE.' || v.o_orderpriority AS transect_id,
               CAST(CAST(v.o_orderdate AS DATE) AS VARCHAR) AS visit_date,
               CASE v.o_orderstatus WHEN 'F' THEN true WHEN 'O' THEN false END AS completed,
               CAST(round_even(v.o_totalprice / 5000.0, 0) AS INTEGER) AS visit_cloud
        FROM v LEFT JOIN r ON CAST(v.o_orderkey AS INTEGER) = CAST(r.obs AS INTEGER)""",
    "count_fact": """
        WITH s AS (SELECT row_number() OVER (ORDER BY 'EUROPE.' || CAST(s_nationkey AS VARCHAR), s_name,
                          CASE WHEN s_nationkey < 10 THEN s_suppkey ELSE -s_suppkey END) AS site_id, CASE WHEN s_nationkey < 10 THEN s_suppkey ELSE -s_suppkey END AS s_suppkey
                   FROM supplier),
        v AS (SELECT row_number() OVER (ORDER BY k) AS visit_id, k AS o_orderkey
              FROM (SELECT CASE WHEN o_orderstatus = 'F' THEN o_orderkey ELSE -o_orderkey END AS k FROM orders)),
        c AS (SELECT v.visit_id, s.site_id, CAST(l_partkey AS INTEGER) AS species_id,
                     CAST(round_even(l_quantity, 0) AS INTEGER) AS butterfly_count
              FROM lineitem JOIN v ON v.o_orderkey = l_orderkey JOIN s ON s.s_suppkey = l_suppkey)
        SELECT row_number() OVER (ORDER BY site_id, visit_id, species_id, butterfly_count) AS count_id,
               visit_id, site_id, species_id, butterfly_count
        FROM c""",
    "batch_number": """
        SELECT batch, count(*) AS n, min(l_suppkey) AS first_site FROM (
          SELECT l_suppkey, CAST(floor((row_number() OVER (ORDER BY l_suppkey, l_orderkey, l_linenumber, l_partkey,
                 l_extendedprice) - 1) / 1000) AS BIGINT) AS batch FROM lineitem) GROUP BY batch""",
    "page": """
        SELECT o_orderkey, o_custkey FROM orders ORDER BY o_custkey NULLS LAST, o_orderkey LIMIT 100 OFFSET 200""",
    "delete_using": """
        SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
        WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderkey = l_orderkey)""",
    "delete_in": """
        WITH s AS (SELECT s_suppkey, s_name, CASE WHEN s_acctbal >= 0 THEN s_nationkey END AS s_nationkey
                   FROM supplier)
        SELECT s_suppkey, s_name, s_nationkey FROM s
        WHERE s_nationkey IS NULL OR s_nationkey NOT IN (SELECT n_nationkey FROM nation WHERE n_regionkey = 2)""",
    "cascade_delete": """
        WITH n AS (SELECT n_nationkey FROM nation JOIN region ON n_regionkey = r_regionkey WHERE r_name = 'ASIA'),
        c AS (SELECT c_custkey FROM customer WHERE c_nationkey IN (SELECT n_nationkey FROM n)),
        o AS (SELECT o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM c)),
        s AS (SELECT s_suppkey FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM n))
        SELECT 'nation' AS tbl, count(*) AS n FROM nation WHERE n_nationkey NOT IN (SELECT n_nationkey FROM n)
        UNION ALL SELECT 'customer', count(*) FROM customer WHERE c_custkey NOT IN (SELECT c_custkey FROM c)
        UNION ALL SELECT 'supplier', count(*) FROM supplier WHERE s_suppkey NOT IN (SELECT s_suppkey FROM s)
        UNION ALL SELECT 'orders', count(*) FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM o)
        UNION ALL SELECT 'lineitem', count(*) FROM lineitem
          WHERE l_orderkey NOT IN (SELECT o_orderkey FROM o) AND l_suppkey NOT IN (SELECT s_suppkey FROM s)""",
    "scheme_replace": """
        WITH st AS (SELECT n_name AS bms_id, n_name || '.' || CAST(s_nationkey AS VARCHAR) AS transect_id,
                           s_name AS section_id, s_suppkey, s_acctbal
                    FROM supplier JOIN nation ON s_nationkey = n_nationkey),
        first AS (SELECT row_number() OVER (ORDER BY transect_id, section_id, s_suppkey) AS site_id, * FROM st),
        hw AS (SELECT count(*) AS m FROM st)
        SELECT site_id, bms_id, CAST(s_suppkey AS INTEGER) AS bms_site_id FROM first
        WHERE bms_id NOT IN ('NATION_7', 'NATION_8')
        UNION ALL
        SELECT hw.m + row_number() OVER (ORDER BY transect_id, section_id, s_suppkey), bms_id,
               CAST(s_suppkey AS INTEGER)
        FROM st, hw WHERE bms_id = 'NATION_7' AND s_acctbal >= 0""",
    "update_from": """
        SELECT s.s_suppkey, CASE WHEN n.n_nationkey IS NOT NULL THEN n.n_name ELSE s.s_name END AS label
        FROM supplier AS s LEFT JOIN (SELECT * FROM nation WHERE n_regionkey < 3) AS n
          ON s.s_nationkey = n.n_nationkey""",
    "flag_by_level": """
        SELECT event_id, CASE WHEN event_type = 'view' THEN true WHEN event_type = 'click' THEN false END
               AS section_geom_true
        FROM events""",
    "parse_time_lenient": """
        WITH src AS (
          SELECT event_id, CASE event_type
            WHEN 'view' THEN CAST(hour(ts) AS VARCHAR) || ':' || CAST(minute(ts) AS VARCHAR)
            WHEN 'click' THEN CAST(hour(ts) AS VARCHAR) || 'h' || lpad(CAST(minute(ts) AS VARCHAR), 2, '0')
            WHEN 'signup' THEN CAST(hour(ts) AS VARCHAR) || '.' || lpad(CAST(minute(ts) AS VARCHAR), 2, '0') || ' uhr'
            WHEN 'purchase' THEN CAST(hour(ts) AS VARCHAR) || ':' || lpad(CAST(minute(ts) AS VARCHAR), 2, '0')
                 || ' - ' || CAST(hour(ts) + 1 AS VARCHAR) || ':' || lpad(CAST(second(ts) AS VARCHAR), 2, '0')
            ELSE props END AS v
          FROM events),
        -- the characters that count, filled up to eight, as the digit groups of a time
        k AS (SELECT event_id, array_to_string([c FOR c IN string_split(v, '') IF contains('0123456789.:,-', c)], '') AS k FROM src),
        g AS (SELECT event_id, substr(k || substr(':00:00', 1, greatest(0, 8 - length(k))), 1, 8) AS k FROM k),
        p AS (SELECT event_id, [CAST(x AS INTEGER) FOR x IN regexp_extract_all(k, '[0-9]+')] AS p,
                     regexp_full_match(k, '[0-9]{1,2}[^0-9][0-9]{1,2}([^0-9][0-9]{1,2})?[^0-9]*') AS ok FROM g),
        s AS (SELECT event_id, p, ok AND p[2] <= 59 AND coalesce(p[3], 0) <= 60 AS ok,
                     p[1] * 3600 + p[2] * 60 + coalesce(p[3], 0) AS secs FROM p)
        SELECT event_id, CASE WHEN ok AND p[1] <= 24 AND secs <= 86400 AND (p[1] < 24 OR secs = 86400)
                              THEN printf('%02d:%02d:%02d', secs // 3600, (secs // 60) % 60, secs % 60) END AS tm
        FROM s""",
    "extract_integer": """
        WITH src AS (
          SELECT event_id, CASE event_type
            WHEN 'view' THEN props
            WHEN 'click' THEN printf('%.2f', value)
            WHEN 'signup' THEN replace(printf('%.2f', value), '.', ',') || ' C'
            WHEN 'error' THEN '-' || printf('%.2f', value)
            ELSE CAST(user_id AS VARCHAR) || '-' || CAST(event_id AS VARCHAR) END AS v
          FROM events),
        -- four characters that count, up to a minus sign: whole digits, at most one point, digits behind it
        h AS (SELECT event_id, regexp_extract(array_to_string([c FOR c IN string_split(v, '') IF contains('0123456789.,-', c)][1:4], ''), '^[^-]*') AS x
              FROM src),
        n AS (SELECT event_id, regexp_full_match(x, '[0-9]*[.,]?[0-9]*') AND regexp_matches(x, '[0-9]') AS ok,
                     coalesce(TRY_CAST(regexp_extract(x, '^[0-9]*') AS INTEGER), 0)
                     + CASE WHEN regexp_matches(x, '[.,][0-9]*[1-9]') THEN 1 ELSE 0 END AS up
              FROM h)
        SELECT event_id, CASE WHEN ok THEN CAST(CASE WHEN up >= 1000 THEN up // 100 WHEN up >= 100 THEN up // 10 ELSE up END AS INTEGER) END AS i
        FROM n""",
    "normalise_clock": """
        WITH src AS (
          SELECT event_id, CASE event_type
            WHEN 'view' THEN '0'
            WHEN 'click' THEN CAST(hour(ts) + 1 AS VARCHAR) || ':' || CAST(minute(ts) AS VARCHAR)
            WHEN 'signup' THEN CAST(hour(ts) AS VARCHAR) || ':' || CAST(minute(ts) AS VARCHAR) || ':'
                 || CAST(second(ts) AS VARCHAR)
            WHEN 'purchase' THEN '00:00' END AS v
          FROM events),
        p AS (SELECT event_id, v, regexp_full_match(v, '[0-9]{1,2}:[0-9]{1,2}(:[0-9]{1,2})?') AS ok FROM src)
        SELECT event_id, CASE WHEN v IN ('00:00', '0', '00:00:00') THEN '00:00:00'
          WHEN ok AND CAST(split_part(v, ':', 1) AS INTEGER) <= 23 AND CAST(split_part(v, ':', 2) AS INTEGER) <= 59
               AND CAST(coalesce(nullif(split_part(v, ':', 3), ''), '0') AS INTEGER) <= 59
          THEN printf('%02d:%02d:%02d', CAST(split_part(v, ':', 1) AS INTEGER), CAST(split_part(v, ':', 2) AS INTEGER),
                      CAST(coalesce(nullif(split_part(v, ':', 3), ''), '0') AS INTEGER)) END AS tm
        FROM p""",
    "clock_to_minute": """
        SELECT event_id, CASE WHEN event_type = 'error' THEN NULL
                              ELSE strftime(date_trunc('minute', ts), '%H:%M:%S') END AS visit_start
        FROM events""",
    "parse_date": """
        SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN NULL
                                ELSE CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS visit_date
        FROM orders""",
    "parse_bool": """
        SELECT event_id, CASE event_type WHEN 'view' THEN true WHEN 'click' THEN false WHEN 'signup' THEN true END
               AS completed
        FROM events""",
    "assign_int": """
        SELECT event_id, CAST(round_even(value, 0) AS INTEGER) AS i, CAST(round_even(value * 2, 0) AS INTEGER) AS j
        FROM events""",
    "make_point": """
        SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE
               'SRID=3035;POINT(' || CAST(event_id AS VARCHAR) || ' '
               || CASE WHEN value = floor(value) THEN CAST(CAST(value AS BIGINT) AS VARCHAR)
                       ELSE CAST(value AS VARCHAR) END || ')' END AS geom
        FROM events""",
    "fk_violations": """
        SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
        WHERE l_partkey IS NOT NULL AND NOT EXISTS (SELECT 1 FROM part WHERE p_size < 40 AND p_partkey = l_partkey)""",
    "key_violations": """
        SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "domain_violations": """
        SELECT 'cloud_0_100' AS rule, count(*) FILTER (WHERE value < 0 OR value > 100) AS n FROM events
        UNION ALL SELECT 'wind_0_12', count(*) FILTER (WHERE hour(ts) < 0 OR hour(ts) > 12) FROM events
        UNION ALL SELECT 'aggregate_above_1000', count(*) FILTER (WHERE (p_size > 25) <> (p_partkey > 1000)) FROM part
        UNION ALL SELECT 'aggregate_at_1000', count(*) FILTER (WHERE p_partkey = 1000) FROM part
        UNION ALL SELECT 'monitoring_type', count(*) FILTER (WHERE s_acctbal < 0) FROM supplier
        UNION ALL SELECT 'site_info_quality_1_3', count(*) FILTER (WHERE s_acctbal < 5000 AND s_nationkey % 5 IN (0, 4)) FROM supplier""",
    "load_audit": """
        WITH sr AS (SELECT s_suppkey, r_name FROM supplier JOIN nation ON s_nationkey = n_nationkey
                    JOIN region ON n_regionkey = r_regionkey),
        orr AS (SELECT o_orderkey, o_custkey, r_name FROM orders JOIN customer ON o_custkey = c_custkey
                JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
        SELECT 'bms_detail' AS tbl, r_name AS bms_id, count(*) AS n FROM region GROUP BY r_name
        UNION ALL SELECT 'm_site', r_name, count(*) FROM sr GROUP BY r_name
        UNION ALL SELECT 'b_recorder', r_name, count(DISTINCT o_custkey) FROM orr GROUP BY r_name
        UNION ALL SELECT 'm_visit', r_name, count(*) FROM orr GROUP BY r_name
        UNION ALL SELECT 'b_count', orr.r_name, count(*) FROM lineitem JOIN orr ON l_orderkey = o_orderkey
          JOIN sr ON l_suppkey = s_suppkey AND sr.r_name = orr.r_name GROUP BY orr.r_name
        UNION ALL SELECT 'm_site_geo', r_name, count(*) FROM sr GROUP BY r_name""",
    "section_length_check": """
        SELECT l_orderkey, abs(sum(l_quantity) - 60) <= 10 AS section_transect_length_equal
        FROM lineitem GROUP BY l_orderkey""",
    "site_info_quality": """
        SELECT event_id, CASE WHEN value > 100 AND event_type = 'view' THEN 1
                              WHEN value > 100 AND event_type = 'click' THEN 2 ELSE 3 END AS q
        FROM events""",
    "append_schemes": """
        SELECT 'A' AS bms_id, CAST(s_suppkey AS INTEGER) AS bms_site_id, s_name AS transect_id,
               CAST(NULL AS DOUBLE) AS site_area FROM supplier
        UNION ALL SELECT 'B', CAST(c_custkey AS INTEGER), c_name, CAST(NULL AS DOUBLE) FROM customer""",
    "rekey_cascade": """
        SELECT o_orderkey, CASE WHEN o_orderpriority >= '4' THEN regexp_replace(o_orderpriority, '^[0-9]+-', '')
                                ELSE o_orderpriority END AS o_orderpriority
        FROM orders""",
    "geo_dim": """
        WITH ms AS (SELECT n_nationkey * 10 AS site_id, n_nationkey AS k FROM nation WHERE n_regionkey < 4
                    UNION ALL SELECT n_nationkey * 10 + 5, n_nationkey FROM nation WHERE n_regionkey = 0),
        m AS (SELECT k, min(site_id) AS site_id FROM ms GROUP BY k),
        g AS (SELECT m.site_id, s_nationkey * 1000 AS x, CASE WHEN s_nationkey <= 20 THEN s_nationkey * 500 END AS y,
                     CASE WHEN s_nationkey < 10 THEN true WHEN s_nationkey < 20 THEN false END AS section_geom_true
              FROM supplier LEFT JOIN m ON m.k = s_nationkey)
        SELECT DISTINCT CAST(site_id AS BIGINT) AS site_id,
               CASE WHEN y IS NOT NULL THEN 'SRID=3035;POINT(' || CAST(x AS VARCHAR) || ' ' || CAST(y AS VARCHAR) || ')'
               END AS centroid_geom, section_geom_true
        FROM g""",
    "observer_fanout": """
        WITH v AS (SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT'
                                           THEN '0' || CAST(o_custkey AS VARCHAR)
                                           ELSE CAST(o_custkey AS VARCHAR) END AS obs
                   FROM orders),
        r AS (SELECT obs, row_number() OVER (ORDER BY obs) AS recorder_id FROM (SELECT DISTINCT obs FROM v)),
        j AS (SELECT v.o_orderkey, r.recorder_id FROM v LEFT JOIN r ON CAST(v.obs AS INTEGER) = CAST(r.obs AS INTEGER))
        SELECT row_number() OVER (ORDER BY o_orderkey, recorder_id) AS visit_id,
               CAST(o_orderkey AS INTEGER) AS bms_visit_id, recorder_id
        FROM j""",
    "dropped_counts": """
        SELECT 'EUROPE' AS bms_id, l_orderkey AS bms_visit_id, l_suppkey AS bms_site_id,
               l_partkey AS species_id, l_quantity AS count
        FROM lineitem
        WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')
           OR l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_nationkey < 10)""",
    "load_warnings": """
        WITH sr AS (SELECT r_name, s_suppkey, s_nationkey, s_acctbal FROM supplier
                    JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
        v AS (SELECT DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN '0' || CAST(o_custkey AS VARCHAR)
                                   ELSE CAST(o_custkey AS VARCHAR) END AS obs FROM orders)
        SELECT 'duplicate_bms_site_id' AS warning, count(*) AS n
          FROM (SELECT r_name, s_suppkey FROM sr GROUP BY 1, 2 HAVING count(*) > 1)
        UNION ALL SELECT 'duplicate_observer_int', count(*)
          FROM (SELECT CAST(obs AS INTEGER) AS k FROM v GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'degree_like_point', count(*) FROM sr WHERE abs(s_nationkey) <= 180 AND abs(s_acctbal) <= 90""",
}
