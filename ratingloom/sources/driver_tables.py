"""Ratings and items derived from order and part tables.

A customer rates the parts they ordered: the quantity becomes a half-step rating and
the shipping date its time. Some items have no year or no genres, some parts are in no catalogue, and
``dirty_ratings`` has ratings that are null or NaN.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ratingloom.functions.titles import NO_GENRES


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def order_ratings(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_shipdate")
    orders = table(spark, folder, "orders").select("o_orderkey", "o_custkey")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.col("o_custkey").alias("userId"),
        F.col("l_partkey").alias("movieId"),
        (F.ceil(F.col("l_quantity") / 5).cast("double") / 2).alias("rating"),
        F.unix_timestamp(F.col("l_shipdate").cast("timestamp")).alias("timestamp"),
    )


def dirty_ratings(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("userId") + F.col("movieId")
    rating = F.when(key % 41 == 0, None).when(key % 43 == 0, float("nan")).otherwise(F.col("rating"))
    return order_ratings(spark, folder).withColumn("rating", rating)


def part_items(spark: SparkSession, folder: str) -> DataFrame:
    key, name = F.col("p_partkey"), F.col("p_name")
    dated = F.concat(name, F.lit(" ("), (1950 + F.col("p_size")).cast("string"), F.lit(")"))
    listed = F.concat_ws("|", F.col("p_type"), F.replace(name, F.lit(" "), F.lit("|")))
    return table(spark, folder, "part").where(key % 29 != 0).select(
        key.alias("movieId"),
        F.when(key % 17 == 0, name).otherwise(dated).alias("title"),
        F.when(key % 23 == 0, NO_GENRES).otherwise(listed).alias("genres"),
    )
