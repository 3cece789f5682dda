"""Runs of adjacent positive segments merged into ranges (gaps and islands)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def merge_adjacent(rows: DataFrame, by: list[str], order: list[str], start: str, end: str, positive: str, confidence: str) -> DataFrame:
    """One row per run: first row's start, last row's end, mean of confidences rounded to four places.

    A row's place less its place among the positives is the same throughout a run.
    """
    every = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    numbered = rows.withColumn("place", every).where(F.col(positive) == 1)
    among = F.row_number().over(Window.partitionBy(*by).orderBy("place"))
    runs = numbered.withColumn("run", F.col("place") - among).groupBy(*by, "run")
    merged = runs.agg(
        F.min_by(start, "place").alias("first_start"),
        F.max_by(end, "place").alias("last_end"),
        F.avg(F.round(F.col(confidence), 4)).alias("confidence"),
        F.min("place").alias("place"),
    )
    return merged.select(*by, "place", F.round("first_start", 3).alias("soundbite_start"), F.round("last_end", 3).alias("soundbite_end"), "confidence")
