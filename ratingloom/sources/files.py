"""File sources and sinks."""

from __future__ import annotations

from pyspark.ml.recommendation import ALSModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegralType, StringType, StructField, StructType

from ratingloom import schemas


BROKEN = "_broken"  # the line of a row with too few or too many values


def _typed(name: str, kind) -> Column:
    """The text value as ``kind``, null where it is none; whole numbers may be written as ``2.0`` or ``1e3``."""
    text = F.trim(F.col(f"`{name}`"))
    if isinstance(kind, IntegralType):
        number = text.try_cast("decimal(38,9)")
        return F.when(number == F.floor(number), number.try_cast(kind))
    return F.col(f"`{name}`") if isinstance(kind, StringType) else text.try_cast(kind)


def scan_csv(spark: SparkSession, path: str, schema: StructType | str, multiline: bool = False) -> DataFrame:
    """The columns of ``schema`` by header name, typed, and ``_rejected``: why a row is unusable, else null.

    The order of the columns in the file does not matter and other columns are left out; a missing column or path
    raises, as do files of one folder with different headers. Empty values are null. Quotes are doubled.
    ``multiline`` allows line ends inside quotes, and then a file is not split.
    """
    if isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multiline}
    header = spark.read.options(**options).csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in header]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}; it has {', '.join(header)}")
    texts = StructType([StructField(name, StringType()) for name in [*header, BROKEN]])
    rows = spark.read.schema(texts).options(**options, enforceSchema=False, columnNameOfCorruptRecord=BROKEN).csv(path)
    typed = {f.name: _typed(f.name, f.dataType) for f in schema.fields}
    reason = F.when(F.col(BROKEN).isNotNull(), F.lit("number of values"))
    for name, value in typed.items():
        reason = reason.when(F.col(f"`{name}`").isNotNull() & value.isNull(), F.lit(name))
    return rows.select(*(v.alias(name) for name, v in typed.items()), reason.alias("_rejected"))


def read_csv(spark: SparkSession, path: str, schema: StructType | str, multiline: bool = False) -> DataFrame:
    """The usable rows of ``scan_csv``; ``csv_audit`` counts the others."""
    return scan_csv(spark, path, schema, multiline).where(F.col("_rejected").isNull()).drop("_rejected")


def csv_audit(spark: SparkSession, path: str, schema: StructType | str, multiline: bool = False) -> DataFrame:
    """``(reason, n_rows)``: rejected rows by the column that could not be read, and the rows read under a null reason."""
    rows = scan_csv(spark, path, schema, multiline)
    return rows.groupBy(F.col("_rejected").alias("reason")).agg(F.count("*").alias("n_rows"))


def read_ratings_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.RATINGS)


def read_items_csv(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.ITEMS)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_parquet(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def read_json(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.json(path)


def write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def save_matrix(matrix: DataFrame, path: str) -> None:
    """Store an interaction matrix in coordinate form, ``(user_idx, item_idx, value)``."""
    write_parquet(matrix.select("user_idx", "item_idx", "value"), path)


def load_matrix(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("user_idx long, item_idx long, value double").parquet(path)


def save_encoder(encoder: DataFrame, path: str) -> None:
    write_parquet(encoder.select("id", "idx"), path)


def load_encoder(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("id long, idx long").parquet(path)


def save_als(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_als(path: str) -> ALSModel:
    return ALSModel.load(path)


def nested_recommendations(recs: DataFrame, key: str = "user_id") -> DataFrame:
    """One row per user with the ordered list; a list holds at most the requested number of rows."""
    entry = F.struct("rank", *[c for c in recs.columns if c not in (key, "rank")])
    return recs.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("recommendations"))
