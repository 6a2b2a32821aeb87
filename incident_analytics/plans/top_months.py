"""The months with the most incidents of each year."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from incident_analytics.functions.text import pad
from incident_analytics.functions.times import us_timestamp
from incident_analytics.operators.ranking import top_k_per_group
from incident_analytics.operators.views import run_script, run_sql

# How the text of a date without a time of day ends, and the column widths of
# the printed report.
MIDNIGHT = " 12:00:00 AM"
REPORT_WIDTHS = {"year": 4, "month": 5, "crime_total": 11, "ranking": 7}

# Incidents as (year, month, n); the two forms stand for each other.
_DATED_SQL = """
dated AS (
  SELECT year(date_occ) AS year, month(date_occ) AS month, 1L AS n FROM {incidents}
)"""
_DATED_TEXT_SQL = """
split AS (
  SELECT CASE WHEN endswith(date_occ_text, :midnight) THEN date_occ_text END AS day_text,
         CASE WHEN NOT endswith(date_occ_text, :midnight) THEN date_occ END AS moment
  FROM {incidents}
),
counted AS (
  SELECT day_text, year(moment) AS year, month(moment) AS month, count(*) AS n FROM split
  GROUP BY day_text, year(moment), month(moment)
),
parsed AS (
  SELECT *, try_to_timestamp(day_text, 'MM/dd/yyyy hh:mm:ss a') AS day FROM counted
),
dated AS (
  SELECT coalesce(year(day), year) AS year, coalesce(month(day), month) AS month, n FROM parsed
)"""
_TOP_MONTHS_SQL = """
monthly AS (
  SELECT year, month, sum(n) AS crime_total FROM dated GROUP BY year, month
),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY year ORDER BY crime_total DESC, month) AS ranking
  FROM monthly
)
SELECT year, month, crime_total, ranking FROM ranked
WHERE ranking <= :k
ORDER BY year, ranking
"""


# The same report as statements: a variable, and a branch that spares the ranking where k is 0.
_SCRIPT = """
BEGIN
  DECLARE most BIGINT DEFAULT 0;
  SET most = greatest(:k, 0);
  IF most = 0 THEN
    SELECT CAST(NULL AS INT) AS year, CAST(NULL AS INT) AS month, 0L AS crime_total, 0 AS ranking WHERE false;
  ELSE
    WITH %s,%s;
  END IF;
END
"""


def month_counts(incidents: DataFrame) -> DataFrame:
    """Incidents per year and month of occurrence; unreadable dates count under null.

    Parsing a date text costs about as much as reading it. Where the input has the text
    (``date_occ_text``), rows without a time of day are counted per text, and only the
    distinct texts, at most one per day, are parsed.
    """
    if "date_occ_text" not in incidents.columns:
        months = incidents.select(
            F.year("date_occ").alias("year"), F.month("date_occ").alias("month")
        )
        return months.groupBy("year", "month").agg(F.count("*").alias("crime_total"))
    text = F.col("date_occ_text")
    split = incidents.select(
        F.when(text.endswith(MIDNIGHT), text).alias("day_text"),
        F.when(~text.endswith(MIDNIGHT), F.col("date_occ")).alias("moment"),
    )
    counted = split.groupBy(
        "day_text", F.year("moment").alias("year"), F.month("moment").alias("month")
    ).agg(F.count("*").alias("n"))
    parsed = counted.withColumn("day", us_timestamp(F.col("day_text")))
    dated = parsed.select(
        F.coalesce(F.year("day"), "year").alias("year"),
        F.coalesce(F.month("day"), "month").alias("month"),
        "n",
    )
    return dated.groupBy("year", "month").agg(F.sum("n").alias("crime_total"))


def top_months(incidents: DataFrame, k: int = 3) -> DataFrame:
    """The ``k`` months with the most incidents of each year: year, month, crime_total,
    ranking. Of months with equal totals the earlier one ranks first."""
    ranked = top_k_per_group(
        month_counts(incidents), ["year"], [F.desc("crime_total"), F.asc("month")], k
    )
    return ranked.orderBy("year", "ranking")


def top_months_sql(spark: SparkSession, incidents: DataFrame, k: int = 3) -> DataFrame:
    """`top_months` as SQL text."""
    values: dict[str, object] = {"k": k}
    dated = _DATED_SQL
    if "date_occ_text" in incidents.columns:
        dated, values["midnight"] = _DATED_TEXT_SQL, MIDNIGHT
    text = f"WITH {dated},{_TOP_MONTHS_SQL}"
    return run_sql(spark, text, {"incidents": incidents}, values)


def top_months_script(spark: SparkSession, incidents: DataFrame, k: int = 3) -> DataFrame:
    """`top_months` as a script of several SQL statements."""
    values: dict[str, object] = {"k": k}
    dated = _DATED_SQL
    if "date_occ_text" in incidents.columns:
        dated, values["midnight"] = _DATED_TEXT_SQL, MIDNIGHT
    text = _SCRIPT % (dated, _TOP_MONTHS_SQL.replace("ranking <= :k", "ranking <= most"))
    return run_script(spark, text, {"incidents": incidents}, values)


def top_months_report(ranked: DataFrame) -> DataFrame:
    """`top_months` as padded text columns, for printing."""
    return pad(ranked, REPORT_WIDTHS)
