"""Car, community and batch configuration."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_cars(spark: SparkSession, path: str) -> DataFrame:
    """``car_id, keywords`` from one JSON array."""
    return spark.read.schema("car_id string, keywords array<string>").option("multiLine", True).json(path)


def car_keywords(cars: DataFrame) -> DataFrame:
    """One row per car and search keyword."""
    return cars.select("car_id", F.explode("keywords").alias("keyword"))


def read_communities(spark: SparkSession, path: str) -> list[str]:
    """The configured communities: one JSON array of names."""
    return json.loads(spark.read.text(path, wholetext=True).first()[0])


def read_batches(spark: SparkSession, path: str) -> DataFrame:
    """``date, time, batch`` of earlier runs from a JSON array."""
    return spark.read.schema("date string, time string, batch int").option("multiLine", True).json(path)
