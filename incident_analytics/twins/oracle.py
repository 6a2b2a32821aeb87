"""The same results as ANSI SQL on the benchmark tables.

The SQL takes the direct way: dates, hours and prices as the tables hold them, without the
text that the Spark side renders and parses back.
"""

from __future__ import annotations

from incident_analytics.functions.times import DAYPARTS, DAYPARTS_GREEK
from incident_analytics.operators.joins import STRATEGIES

MONTHS = """
g AS (
  SELECT CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m, count(*) AS n
  FROM orders GROUP BY year(o_orderdate), month(o_orderdate)
),
r AS (
  SELECT y, m, n, CAST(row_number() OVER (PARTITION BY y ORDER BY n DESC, m) AS INT) AS ranking
  FROM g
)"""

HAVERSINE = """
pow(sin((radians(y) - radians(lat)) / 2), 2)
  + cos(radians(lat)) * cos(radians(y)) * pow(sin((radians(x) - radians(lon)) / 2), 2)"""

KM = "6371.0e0 * 2 * atan2(sqrt(a), sqrt(1 - a))"

STATIONS = """
SELECT s_suppkey, s_name, 33.7e0 + s_nationkey * 0.02e0 AS y, -118.6e0 + s_nationkey * 0.015e0 AS x
FROM supplier"""

LABEL = """
CASE {code} WHEN '1-URGENT' THEN 'Urgent' WHEN '2-HIGH' THEN 'High'
     WHEN '3-MEDIUM' THEN 'High' ELSE {code} END"""

DAYPART = """
CASE WHEN h >= 5 AND h < 12 THEN 'Morning' WHEN h >= 12 AND h < 17 THEN 'Afternoon'
     WHEN h >= 17 AND h < 21 THEN 'Evening' ELSE 'Night' END"""

ZIPS = """
SELECT floor(c_custkey / 2) AS place, min(CAST(90000 + c_custkey AS VARCHAR)) AS zip
FROM customer GROUP BY floor(c_custkey / 2)"""

ORDER_COLUMNS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"""

CUSTOMER_COLUMNS = """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer"""


def _victims(direction: str) -> str:
    return f"""
WITH zips AS ({ZIPS}),
income AS (
  SELECT CAST(90000 + p_partkey AS VARCHAR) AS zip,
         CASE WHEN p_type <> 'ECONOMY' THEN floor(p_retailprice) * 50 END AS income
  FROM part
),
f AS (
  SELECT z.zip, i.income, o.o_orderpriority AS v
  FROM orders o
  JOIN zips z ON z.place = floor(o.o_custkey / 2)
  JOIN income i ON i.zip = z.zip
  WHERE year(o.o_orderdate) = 1995 AND o.o_orderpriority <> '4-NOT SPECIFIED'
),
picked AS (
  SELECT DISTINCT income FROM f WHERE income IS NOT NULL ORDER BY income {direction} LIMIT 3
)
SELECT {LABEL.format(code="v")} AS victim_descent, count(*) AS total_victims
FROM f WHERE zip IN (SELECT zip FROM f WHERE income IN (SELECT income FROM picked))
GROUP BY v"""


ODD = """
SELECT CASE WHEN c_nationkey < 4 THEN 'PARK "' || c_name || '", EAST'
  WHEN c_nationkey < 8 THEN '  ' || c_name || ',| ' WHEN c_nationkey < 12 THEN ''
  WHEN c_nationkey < 16 THEN c_name || '"' WHEN c_nationkey < 20 THEN chr(92) || c_name
  END{end} AS odd_name,
  c_custkey, c_acctbal
FROM customer"""


NEAREST = f"""
WITH spots AS (
  SELECT DISTINCT floor(o_custkey / 2) AS place FROM orders
),
spot AS (
  SELECT place, 33.5e0 + floor(place / 500) * 0.001e0 + 0.0003e0 AS y,
         -118.9e0 + (place - floor(place / 500) * 500) * 0.001e0 + 0.0002e0 AS x
  FROM spots
),
known AS (
  SELECT floor(c_custkey / 2) AS owner, min(CAST(90000 + c_custkey AS VARCHAR)) AS zip
  FROM customer WHERE c_custkey < 800 GROUP BY floor(c_custkey / 2)
),
placed AS (
  SELECT zip, 33.5e0 + floor(owner / 500) * 0.001e0 AS lat,
         -118.9e0 + (owner - floor(owner / 500) * 500) * 0.001e0 AS lon
  FROM known
),
pairs AS (SELECT place, zip, lat, lon, {HAVERSINE} AS a FROM spot, placed),
far AS (SELECT place, zip, lat, lon, {KM} AS km FROM pairs),
best AS (
  SELECT place, zip, km, row_number() OVER (PARTITION BY place ORDER BY km, lat, lon) AS n
  FROM far WHERE km <= 0.2e0
)
SELECT o_orderkey, zip, round(km, 6) AS km
FROM orders JOIN best ON best.place = floor(o_custkey / 2) AND n = 1"""


def _base() -> dict[str, str]:
    top_months = f"WITH {MONTHS} SELECT y, m, n, ranking FROM r WHERE ranking <= 3"
    years = (
        "SELECT CAST(year(o_orderdate) AS INT) AS y, count(*) AS n "
        "FROM orders GROUP BY year(o_orderdate)"
    )
    labels = (
        f"SELECT {LABEL.format(code='o_orderpriority')} AS label, count(*) AS n "
        "FROM orders GROUP BY o_orderpriority"
    )
    dayparts = (
        "WITH e AS (SELECT hour(ts) AS h FROM events WHERE event_type = 'click') "
        f"SELECT {DAYPART} AS daypart, count(*) AS n FROM e GROUP BY 1"
    )
    prefix2 = (
        "WITH e AS (SELECT CAST(substr(CAST(hour(ts) * 100 + minute(ts) AS VARCHAR), 1, 2) AS INT)"
        " AS h FROM events WHERE event_type = 'click') "
        f"SELECT {DAYPART} AS daypart, count(*) AS n FROM e GROUP BY 1"
    )
    greek = dayparts
    for english, label in zip(DAYPARTS, DAYPARTS_GREEK, strict=True):
        greek = greek.replace(f"'{english}'", f"'{label}'")
    joined = (
        "SELECT c_mktsegment, count(*) AS n, count(DISTINCT o_custkey) AS custs "
        "FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_mktsegment"
    )
    distance = f"""
WITH f AS (
  SELECT l_orderkey, l_suppkey, 33.7e0 + (l_discount + l_tax) AS lat,
         -118.6e0 + l_linenumber * 0.05e0 AS lon
  FROM lineitem
  WHERE (l_quantity = 1 OR l_quantity BETWEEN 10 AND 19) AND l_tax <> 0 AND l_discount <> 0
),
st AS ({STATIONS}),
j AS (SELECT s_name, l_orderkey, {HAVERSINE} AS a FROM f JOIN st ON l_suppkey = s_suppkey)
SELECT s_name AS division, round(avg({KM}), 2) AS average_distance,
       count(l_orderkey) AS incidents_total
FROM j GROUP BY s_name"""
    return {
        "csv_roundtrip": ORDER_COLUMNS,
        "csv_roundtrip_pipe": ORDER_COLUMNS,
        "parquet_roundtrip": CUSTOMER_COLUMNS,
        "csv_to_parquet": CUSTOMER_COLUMNS,
        "unreadable_counts": """
SELECT 'rows' AS counted, count(*) AS n FROM customer
UNION ALL SELECT 'lat', count(CASE WHEN c_nationkey < 7 THEN 1 END) FROM customer
UNION ALL SELECT 'lon', count(CASE WHEN c_nationkey BETWEEN 9 AND 11 THEN 1 END) FROM customer""",
        "unreadable_in_query": """
SELECT 'rows' AS counted, count(*) AS n FROM part
UNION ALL SELECT 'median_income', count(CASE WHEN p_type = 'ECONOMY' THEN 1 END) FROM part""",
        "convert_incremental": CUSTOMER_COLUMNS,
        "parquet_zorder": """
SELECT l_orderkey, CAST(l_suppkey AS VARCHAR) AS area, round(33.7e0 + (l_discount + l_tax), 6) AS lat
FROM lineitem
WHERE l_tax <> 0 AND 33.7e0 + (l_discount + l_tax) BETWEEN 33.755e0 AND 33.805e0
  AND l_discount <> 0 AND -118.6e0 + l_linenumber * 0.05e0 BETWEEN -118.51e0 AND -118.39e0""",
        "union_all_eras": years,
        "union_all_eras_sql": years,
        "parse_us_timestamp": """
SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS y, CAST(month(o_orderdate) AS INT) AS m,
       CAST(day(o_orderdate) AS INT) AS d
FROM orders""",
        "count_by_year_month": f"WITH {MONTHS} SELECT y, m, n FROM g",
        "padded_ranking": f"""
WITH {MONTHS}
SELECT rpad(CAST(y AS VARCHAR), 4, ' ') AS y, rpad(CAST(m AS VARCHAR), 5, ' ') AS m,
       rpad(CAST(n AS VARCHAR), 11, ' ') AS n, rpad(CAST(ranking AS VARCHAR), 7, ' ') AS ranking
FROM r""",
        "topk_months_per_year": top_months,
        "topk_months_per_year_sql": top_months,
        "topk_months_per_year_csv": top_months,
        "topk_months_per_year_csv_sql": top_months,
        "topk_months_per_year_parquet": top_months,
        "topk_months_per_year_parquet_sql": top_months,
        "topk_months_script": top_months,
        "topk_months_from_state": top_months,
        "filter_equals": "SELECT event_id, user_id FROM events WHERE event_type = 'click'",
        "filter_text_year": (
            "SELECT o_orderkey, o_custkey FROM orders WHERE year(o_orderdate) = 1995"
        ),
        "currency_to_int": """
SELECT p_partkey, CAST(CASE WHEN p_size < 10 THEN floor(p_retailprice)
  WHEN p_size < 20 THEN -floor(p_retailprice) WHEN p_size < 30 THEN floor(p_retailprice) * 10000000
  WHEN p_size < 40 THEN NULL ELSE floor(p_retailprice) END AS BIGINT) AS price
FROM part""",
        "csv_quoted_roundtrip": ODD.format(end=""),
        "csv_quoted_lines_roundtrip": ODD.format(end=" || chr(10)"),
        "parquet_code_partitions": (
            "SELECT c_custkey * 0.5e0 AS lat, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS zip "
            "FROM customer"
        ),
        "topk_rows_per_mode": """
SELECT * FROM (
  SELECT l_returnflag, l_orderkey, l_linenumber, CAST(row_number() OVER (
    PARTITION BY l_returnflag ORDER BY l_orderkey DESC, l_linenumber) AS INT) AS ranking
  FROM lineitem) t
WHERE ranking <= 2500""",
        "decode_labels_table": """
SELECT coalesce(n_name, CAST(s_nationkey AS VARCHAR)) AS label, n
FROM (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY s_nationkey) s
LEFT JOIN (SELECT * FROM nation WHERE n_regionkey >= 2) k ON n_nationkey = s_nationkey""",
        "daypart_counts_csv_sql": dayparts,
        "daypart_counts_parquet": dayparts,
        "daypart_counts_greek": greek,
        "victims_both_sides": (
            f"SELECT 'top' AS side, * FROM ({_victims('DESC')}) a "
            f"UNION ALL SELECT 'bottom' AS side, * FROM ({_victims('ASC')}) b"
        ),
        "filter_code_prefix": (
            "SELECT l_orderkey, l_linenumber FROM lineitem "
            "WHERE l_quantity = 1 OR l_quantity BETWEEN 10 AND 19"
        ),
        "filter_null_island": (
            "SELECT count(*) AS n FROM lineitem WHERE l_tax <> 0 AND l_discount <> 0"
        ),
        "haversine_km": f"""
WITH p AS (SELECT s_suppkey, y, x, 34.05e0 AS lat, -118.24e0 AS lon FROM ({STATIONS}) s),
d AS (SELECT s_suppkey, {HAVERSINE} AS a FROM p)
SELECT s_suppkey, round({KM}, 3) AS km FROM d""",
        "decode_labels": labels,
        "decode_labels_sql": labels,
        "count_non_null": (
            "SELECT event_type, count(CASE WHEN value > 50 THEN event_id END) AS n "
            "FROM events GROUP BY event_type"
        ),
        "avg_round": (
            "SELECT l_returnflag, round(avg(l_quantity), 2) AS q "
            "FROM lineitem GROUP BY l_returnflag"
        ),
        "avg_exact": (
            "SELECT l_returnflag, round(avg(l_extendedprice), 2) AS price, "
            "round(avg(l_discount), 6) AS discount FROM lineitem GROUP BY l_returnflag"
        ),
        "distinct_values": "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer",
        "top_n_distinct": "SELECT DISTINCT p_size FROM part ORDER BY p_size DESC LIMIT 3",
        "bottom_n_distinct": "SELECT DISTINCT p_size FROM part ORDER BY p_size LIMIT 3",
        "dedupe_lookup": f"SELECT zip FROM ({ZIPS}) z",
        "join_composite_key": (
            f"SELECT o_orderkey, zip FROM orders JOIN ({ZIPS}) z ON place = floor(o_custkey / 2)"
        ),
        "join_inner_single_key": (
            "SELECT n_name, count(*) AS n FROM customer "
            "JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name"
        ),
        "join_left_semi": (
            "SELECT o_orderpriority, count(*) AS n FROM orders WHERE o_custkey IN "
            "(SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING') "
            "GROUP BY o_orderpriority"
        ),
        "join_heavy_keys": """
SELECT s_nationkey, count(*) AS n, CAST(sum(l_linenumber) AS BIGINT) AS lines
FROM lineitem JOIN supplier
  ON s_suppkey = CASE WHEN l_returnflag = 'N' THEN 1 ELSE l_suppkey END
GROUP BY s_nationkey""",
        "join_nearest_cell": NEAREST,
        "join_bucketed": joined,
        "pruned_by_selection": """
SELECT CAST(year(o_orderdate) AS INT) AS rptd_year, count(*) AS n FROM orders
WHERE year(o_orderdate) IN (
  SELECT n_nationkey + 1990 FROM nation WHERE n_name IN ('NATION_6', 'NATION_9', 'NATION_11'))
GROUP BY year(o_orderdate)""",
        "join_strategies": joined,
        "daypart_counts": dayparts,
        "daypart_counts_sql": dayparts,
        "daypart_counts_csv": dayparts,
        "daypart_counts_prefix2": prefix2,
        "daypart_counts_prefix2_sql": prefix2,
        "division_distance": distance,
        "division_distance_broadcast": distance,
        "division_distance_repartition": distance,
        "division_distance_csv": distance,
        "division_distance_parquet": distance,
        "victims_top_income": _victims("DESC"),
        "victims_bottom_income": _victims("ASC"),
    }


def all_oracles() -> dict[str, str]:
    """SQL by query name. Queries that differ only in route share their SQL."""
    found = _base()
    for report in ("join_strategies", "victims_top_income", "victims_bottom_income"):
        for strategy in STRATEGIES:
            found[f"{report}_{strategy}"] = found[report]
    for side in ("top", "bottom"):
        for route in ("csv", "parquet"):
            found[f"victims_{side}_income_{route}"] = found[f"victims_{side}_income"]
    return found
