"""Readers and small source-side derivations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowtide.schemas import EDGES, NODES, TVL_DOCUMENT
from flowtide.session import SETTINGS
from flowtide.sources.documents import document_bodies

_ZONE = SETTINGS["spark.sql.session.timeZone"]


def read_table(spark: SparkSession, name: str, limit: int | None = None) -> DataFrame:
    table = spark.table(name)
    return table if limit is None else table.limit(limit)


def read_parquet(spark: SparkSession, *paths: str, schema: StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*paths)


def read_tvl_documents(spark: SparkSession, *paths: str) -> DataFrame:
    """Nested documents from JSON files; amounts stay text until ``flatten_tvl`` turns them into numbers.

    A file may hold any number of documents in any layout: see ``document_bodies``, which also splits large files. A malformed document
    is an error.
    """
    texts = document_bodies(spark, *paths)
    return texts.select(F.from_json("text", TVL_DOCUMENT, {"mode": "FAILFAST"}).alias("d")).select("d.*")


def _read_csv(spark: SparkSession, schema: StructType, paths: tuple[str, ...], nanoseconds: bool) -> DataFrame:
    rows = spark.read.schema(schema).option("header", True).option("timeZone", _ZONE).csv(list(paths))
    return rows.withColumn("time", F.unix_micros("time") * 1000) if nanoseconds else rows


def read_edges(spark: SparkSession, *paths: str, nanoseconds: bool = False) -> DataFrame:
    """Edge CSVs ``time, source, target, size``; ``time`` as a timestamp or as epoch nanoseconds."""
    return _read_csv(spark, EDGES, paths, nanoseconds)


def read_nodes(spark: SparkSession, *paths: str, nanoseconds: bool = False) -> DataFrame:
    return _read_csv(spark, NODES, paths, nanoseconds)


def price_rows(responses: DataFrame, column: str = "prices") -> DataFrame:
    """``[[milliseconds, price], …]`` (array or JSON text) to rows ``time, price``, other columns kept."""
    pairs = F.col(column)
    if responses.schema[column].dataType.typeName() == "string":
        pairs = F.from_json(pairs, "array<array<double>>")
    others = [c for c in responses.columns if c != column]
    return responses.select(*others, F.explode(pairs).alias("_pair")).select(
        *others,
        F.timestamp_millis(F.get("_pair", F.lit(0)).cast("bigint")).alias("time"),
        F.get("_pair", F.lit(1)).alias("price"),
    )


def last_modified(files: DataFrame) -> DataFrame:
    """Newest modification time of the files behind a freshly read frame, as text."""
    newest = files.select(F.col("_metadata.file_modification_time").alias("modified")).agg(F.max("modified").alias("m"))
    return newest.select(F.date_format("m", "yyyy-MM-dd HH:mm:ss z").alias("last_modified"))


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))
