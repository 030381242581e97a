"""Table maintenance and writers."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from flowtide.operators.aggregates import latest_dates
from flowtide.operators.mapping import Mapping
from flowtide.session import ensure_checkpoints, folder_names, path_exists, remove_folder, stored_bytes, touch  # noqa: F401


#: Table property with the cluster columns.
CLUSTER_PROPERTY = "flowtide.clustered-by"
#: Bytes of small files that make up one compacted file, at most.
COMPACTED_BYTES = 128 << 20


def clustered(df: DataFrame, cluster_by: list[str]) -> DataFrame:
    """Range-partition and sort by the cluster columns, so that row groups carry narrow statistics.

    The remaining columns follow in the range key: a frequent cluster value spreads over many files.
    """
    rest = [c for c in df.columns if c not in cluster_by]
    return df.repartitionByRange(*cluster_by, *rest).sortWithinPartitions(*cluster_by)


def create_table(
    spark: SparkSession,
    name: str,
    data: DataFrame | None = None,
    schema: StructType | None = None,
    partition_by: list[str] | None = None,
    cluster_by: list[str] | None = None,
    path: str | None = None,
) -> None:
    """Create a parquet table from data (an error if it exists) or from a schema (kept if it exists).

    With ``path`` the files lie there and outlive the table.
    """
    if data is None and schema is None:
        raise ValueError("either data or schema is needed")
    if data is None:
        if table_exists(spark, name):
            return
        data = spark.createDataFrame([], schema)
    elif cluster_by:
        data = clustered(data, cluster_by)
    location = {"path": path} if path else {}
    data.write.mode("errorifexists").format("parquet").saveAsTable(name, partitionBy=partition_by, **location)
    if cluster_by:
        _set_properties(spark, name, **{CLUSTER_PROPERTY: ",".join(cluster_by)})


def _set_properties(spark: SparkSession, name: str, **values: str) -> None:
    listed = ", ".join(f"'{k}' = '{v}'" for k, v in values.items())
    spark.sql(f"ALTER TABLE IDENTIFIER(:name) SET TBLPROPERTIES ({listed})", args={"name": name})


def table_properties(spark: SparkSession, name: str) -> dict[str, str]:
    rows = spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:name)", args={"name": name}).collect()
    return {r["key"]: r["value"] for r in rows}


def cluster_columns(spark: SparkSession, name: str) -> list[str]:
    """The columns a table was created to be clustered by."""
    return [c for c in table_properties(spark, name).get(CLUSTER_PROPERTY, "").split(",") if c]


def append_table(df: DataFrame, name: str) -> None:
    """Append by column name, clustered as the table is."""
    spark = df.sparkSession
    rows = df.select(*spark.table(name).columns)
    by = cluster_columns(spark, name)
    (clustered(rows, by) if by else rows).write.insertInto(name)


def append_parquet(spark: SparkSession, path: str, name: str) -> None:
    append_table(spark.read.parquet(path), name)


def drop_table(spark: SparkSession, name: str) -> None:
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})


def table_location(spark: SparkSession, name: str) -> str:
    """Folder a table's files lie in now."""
    rows = spark.sql("DESCRIBE TABLE EXTENDED IDENTIFIER(:name)", args={"name": name})
    return rows.where("col_name = 'Location'").first()["data_type"]


def table_exists(spark: SparkSession, name: str) -> bool:
    return spark.catalog.tableExists(name)


def partition_columns(spark: SparkSession, name: str) -> list[str]:
    return [c.name for c in spark.catalog.listColumns(name) if c.isPartition]


def refresh_table(df: DataFrame, name: str, place: str) -> None:
    """Replace a table by new content (the protocol dimension on every ingest), which may be computed from the table.

    The content goes to a fresh folder under ``place`` first, and only then the table changes: a failed refresh
    leaves the old one as it was. An unpartitioned table is made to point to the new folder. Of a partitioned one the new table, with
    its partitions, is made under another name and takes the place of the old one. Clustering and partitioning are
    kept; the replaced folder is removed.
    """
    spark = df.sparkSession
    exists = table_exists(spark, name)
    by, parts = (cluster_columns(spark, name), partition_columns(spark, name)) if exists else ([], [])
    fresh = f"{place}/{uuid.uuid4().hex}"
    if not exists:
        df.write.parquet(fresh)
        spark.catalog.createTable(name, path=fresh, source="parquet")
        return
    old = table_location(spark, name)
    if parts:
        new = f"{name}__{uuid.uuid4().hex}"
        try:
            create_table(spark, new, data=df.select(*spark.table(name).columns), partition_by=parts, cluster_by=by, path=fresh)
        except Exception:
            drop_table(spark, new)
            remove_folder(spark, fresh)
            raise
        drop_table(spark, name)
        spark.sql(f"ALTER TABLE IDENTIFIER(:new) RENAME TO {'.'.join(f'`{p}`' for p in name.split('.'))}", args={"new": new})
    else:
        (clustered(df, by) if by else df).write.parquet(fresh)
        spark.sql(f"ALTER TABLE IDENTIFIER(:name) SET LOCATION '{fresh}'", args={"name": name})
    spark.catalog.refreshTable(name)
    remove_folder(spark, old)


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """``target`` with rows of ``source`` inserted, or replacing the rows of equal key.

    A key given twice in ``source`` is an error, raised when the result is computed.
    """
    values = [c for c in target.columns if c not in keys]
    grouped = source.groupBy(*keys).agg(
        F.count("*").alias("_n"), *[F.any_value(F.col(c)).alias(c) for c in values]
    )
    repeated = F.raise_error(F.lit("upsert: a key occurs twice in the source"))
    checked = grouped.where(F.when(F.col("_n") > 1, repeated.cast("boolean")).otherwise(F.lit(True)))
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.select(*target.columns).unionByName(checked.select(*target.columns))


def compact_parquet(spark: SparkSession, paths: list[str], target: str, files: int, largest: int = COMPACTED_BYTES) -> None:
    """Rewrite many small files as ``files`` files of about equal size; no input, no output.

    They are more than ``files`` where a file, and the one task that writes it, would have more than ``largest`` bytes of the input.
    """
    if paths:
        files = max(files, -(-stored_bytes(spark, paths) // largest))
        spark.read.parquet(*paths).repartition(files).write.mode("overwrite").parquet(target)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_snapshots(document: DataFrame, path: str, period: str = "period") -> None:
    """Network JSON lines, one directory per date of ``period``."""
    rows = document.withColumn("date", F.date_format(period, "yyyy-MM-dd"))
    # by date and content: a few files per date, and a date of any size still spreads
    spread = rows.select("part", "json", "date").repartition("date", F.pmod(F.xxhash64("json"), F.lit(8)))
    spread.write.mode("overwrite").partitionBy("date").json(path)


def write_latest_dates(facts: DataFrame, path: str) -> None:
    write_csv(latest_dates(facts), path)


def _mapping_versions(spark: SparkSession, path: str) -> list[str]:
    """Folders of whole saved mappings, oldest first; one that was not finished has no mark and does not count."""
    return [f"{path}/{n}" for n in folder_names(spark, path) if n.startswith("v") and path_exists(spark, f"{path}/{n}/{_WHOLE}")]


#: Empty file that is written last.
_WHOLE = "_WHOLE"


def save_mapping(mapping: Mapping, path: str) -> None:
    """Save the tables as a new version, which counts from the moment that all of them are there.

    Readers see the old version or the new one, never tables of two. The version before stays for those that still read
    it, and since the new tables may be computed from it; older ones, and what was left half written before them, go.
    """
    spark = mapping.rev_map.sparkSession
    before = _mapping_versions(spark, path)
    number = int(before[-1].rsplit("/v", 1)[1].split("-")[0]) + 1 if before else 1
    fresh = f"{path}/v{number:010d}-{uuid.uuid4().hex}"
    try:
        for name, table in mapping._asdict().items():
            table.write.parquet(f"{fresh}/{name}")
        touch(spark, f"{fresh}/{_WHOLE}")
    except Exception:
        remove_folder(spark, fresh)
        raise
    oldest_kept = before[-1] if before else fresh
    for name in folder_names(spark, path):
        if f"{path}/{name}" < oldest_kept:
            remove_folder(spark, f"{path}/{name}")


def load_mapping(spark: SparkSession, path: str) -> Mapping:
    """The newest whole mapping; ``FileNotFoundError`` if there is none."""
    saved = _mapping_versions(spark, path)
    if not saved:
        raise FileNotFoundError(f"no saved mapping in {path}")
    return Mapping(*[spark.read.parquet(f"{saved[-1]}/{name}") for name in Mapping._fields])


def load_or_build_mapping(spark: SparkSession, path: str, build) -> Mapping:
    """Saved mapping tables; if one cannot be read, ``build()`` makes them and they are saved first."""
    try:
        return load_mapping(spark, path)
    except FileNotFoundError:
        pass
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
    save_mapping(build(), path)
    return load_mapping(spark, path)
