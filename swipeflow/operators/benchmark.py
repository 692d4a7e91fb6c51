"""Each person's metric beside the same metric of their department, site and company.

All four levels come from one aggregation with grouping sets (one Expand, one shuffle); each level's rows
are then joined back to the person rows on that level's key by shuffle, never broadcast; the
company level, one row, is a scalar subquery. Grouping ids tell a rolled-up column from a null value, so a null
department is a department of its own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEVELS = ["site_id", "department_name", "person_id"]


def presence_benchmark(mart: DataFrame) -> DataFrame:
    """site_id, department_name, person_id, days, avg_minutes and department_, site_, company_avg_minutes.

    The metric is the mean of a person-day's minutes in all zones (mart rows with a person), summed in
    tenths of a minute so that every level adds whole numbers.
    """
    days = (mart.filter(F.col("person_id").isNotNull())
            .groupBy(*LEVELS, "report_date").agg(F.sum(F.round(F.col("total_minutes") * 10).cast("long")).alias("tenths")))
    levels = days.groupingSets([LEVELS, LEVELS[:2], LEVELS[:1], []], *LEVELS).agg(
        F.sum("tenths").alias("tenths"), F.count("*").alias("days"), F.grouping_id().alias("level"))
    mean = (F.col("tenths") / F.col("days") / F.lit(10.0))
    person = levels.filter(F.col("level") == 0).select(*LEVELS, F.col("days").cast("long").alias("days"), mean.alias("avg_minutes"))
    department = levels.filter(F.col("level") == 1).select(
        F.col("site_id").alias("d_site"), F.col("department_name").alias("d_name"), mean.alias("department_avg_minutes"))
    site = levels.filter(F.col("level") == 3).select(F.col("site_id").alias("s_site"), mean.alias("site_avg_minutes"))
    company = levels.filter(F.col("level") == 7).select(mean).scalar()
    joined = (person.join(department, (F.col("site_id").eqNullSafe(F.col("d_site"))) & F.col("department_name").eqNullSafe(F.col("d_name")))
              .join(site, F.col("site_id").eqNullSafe(F.col("s_site"))))
    return joined.select(*LEVELS, "days", "avg_minutes", "department_avg_minutes", "site_avg_minutes",
                         company.alias("company_avg_minutes"))
