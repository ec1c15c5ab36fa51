"""Declared schemas of the tables that enter the library."""

from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

RATINGS = StructType(
    [
        StructField("userId", LongType()),
        StructField("movieId", LongType()),
        StructField("rating", DoubleType()),
        StructField("timestamp", LongType()),  # epoch seconds
    ]
)

ITEMS = StructType(
    [
        StructField("movieId", LongType()),
        StructField("title", StringType()),
        StructField("genres", StringType()),  # pipe-separated
    ]
)
