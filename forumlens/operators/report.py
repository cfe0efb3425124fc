"""Extraction results rolled up per community and run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forumlens import schemas

# A rate below 70 is red, below 90 yellow, else green.
RED_BELOW, YELLOW_BELOW = 70, 90


def explode_statistics(statistics: DataFrame, column: str = "statistics") -> DataFrame:
    """``map<car, map<community, struct>>`` to one row per car and community."""
    by_car = statistics.select(F.explode(column).alias("car_id", "_communities"))
    return by_car.select("car_id", F.explode("_communities").alias("community", "_result")).select(
        "car_id", "community", "_result.*"
    )


def parse_result(result: Column) -> Column:
    """The ``body`` of a JSON result as a struct; text that is no JSON gives nulls."""
    return F.from_json(result, f"struct<body:{schemas.EXTRACTION_BODY.simpleString()}>")["body"]


def status_rollup(cars: DataFrame, communities: list[str], results: DataFrame) -> DataFrame:
    """One status per configured (car, community); a missing result counts as failed.

    ``results`` holds ``car_id, community, result`` with the result as JSON text. A result that
    cannot be read keeps the default: success without counts.
    """
    listed = F.array(*[F.lit(name) for name in communities])
    grid = cars.select("car_id").distinct().withColumn("community", F.explode(listed))
    joined = grid.join(results, ["car_id", "community"], "left").withColumn(
        "body", parse_result(F.col("result"))
    )
    missing, succeeded = F.col("result").isNull(), F.col("body.success")
    return joined.select(
        "car_id",
        "community",
        (~missing & F.coalesce(succeeded, F.lit(True))).alias("success"),
        F.when(missing, "No data returned from task").when(~succeeded, F.col("body.error")).alias("error"),
        F.when(succeeded, F.col("body.attempted_posts_count")).alias("attempted_posts_count"),
        F.when(succeeded, F.col("body.extracted_posts_count")).alias("extracted_posts_count"),
    )


def community_totals(results: DataFrame, communities: DataFrame | None = None) -> DataFrame:
    """Attempted and extracted per community, nulls skipped."""
    totals = results.groupBy("community").agg(
        F.coalesce(F.sum("attempted_posts_count"), F.lit(0)).alias("attempted"),
        F.coalesce(F.sum("extracted_posts_count"), F.lit(0)).alias("extracted"),
    )
    if communities is None:
        return totals
    return communities.join(totals, "community", "left").na.fill(0, ["attempted", "extracted"])


def success_rate(attempted: Column, extracted: Column) -> Column:
    """Percent extracted, 0 when nothing was attempted."""
    return F.when(attempted > 0, F.lit(100.0) * extracted / attempted).otherwise(F.lit(0.0))


def rate_band(rate: Column) -> Column:
    return F.when(rate < RED_BELOW, "red").when(rate < YELLOW_BELOW, "yellow").otherwise("green")


def with_rates(totals: DataFrame) -> DataFrame:
    rated = totals.withColumn("success_rate", success_rate(F.col("attempted"), F.col("extracted")))
    return rated.withColumn("band", rate_band(F.col("success_rate")))


def attempt_accounting(attempts: DataFrame, keys: list[str]) -> DataFrame:
    """Attempted and extracted posts of each run from per-post states.

    A failed request is attempted only, a post out of range neither, a saved post both.
    """
    return attempts.groupBy(*keys).agg(
        F.count_if(F.col("status") != "skipped").alias("attempted"),
        F.count_if(F.col("status") == "saved").alias("extracted"),
    )


def accumulate(runs: DataFrame, keys: list[str]) -> DataFrame:
    """Sum the counts of keyword runs, as often as a post was found."""
    return runs.groupBy(*keys).agg(F.sum("attempted").alias("attempted"), F.sum("extracted").alias("extracted"))


def last_attempt(attempts: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Retried results: the last attempt of a key wins."""
    rest = [c for c in attempts.columns if c not in keys and c != order]
    last = F.max(F.struct(order, *rest)).alias("_row")
    return attempts.groupBy(*keys).agg(last).select(*keys, "_row.*").select(*attempts.columns)


def date_span(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """First and last date per page."""
    return rows.groupBy(*keys).agg(F.min(column).alias("first_date"), F.max(column).alias("last_date"))
