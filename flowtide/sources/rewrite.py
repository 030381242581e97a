"""Replacing some files of a stored parquet table, and leaving all others as they are.

New rows are written beside the table's files, in a folder that readers do not see, with the list of the files they replace. One rename makes the
replacement final; what follows - moving files in, deleting the replaced ones - can be repeated, and is finished by the next
call if a driver dies on the way. While files move, a reader may see old and new rows together.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtide.session import remove_folder
from flowtide.sources import tables

FILE = "_metadata.file_path"


def _path(spark: SparkSession, text: str):
    made = spark._jvm.org.apache.hadoop.fs.Path(text)
    return made.getFileSystem(spark._jsc.hadoopConfiguration()), made


def _decoded(spark: SparkSession, uri: str) -> str:
    """A path as Hadoop names it, from the encoded form that Spark reports."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).toString()


def read_files(spark: SparkSession, name: str, files: list[str]) -> DataFrame:
    """Rows of some files of a table alone, with its columns and types."""
    table = spark.table(name)
    if not files:
        return table.limit(0)
    reader = spark.read.schema(table.schema).option("basePath", tables.table_location(spark, name))
    return reader.parquet(*[_decoded(spark, f) for f in files])


def replace_files(rows: DataFrame, name: str, files: list[str]) -> None:
    """Put ``rows`` in the place of ``files`` (as ``_metadata.file_path`` names them), clustered and partitioned as the table is."""
    spark = rows.sparkSession
    place = tables.table_location(spark, name)
    ident = uuid.uuid4().hex
    staged = f"{place}/_staged-{ident}"
    by, parts = tables.cluster_columns(spark, name), tables.partition_columns(spark, name)
    try:
        writer = (tables.clustered(rows, by) if by else rows).write
        (writer.partitionBy(*parts) if parts else writer).parquet(f"{staged}/rows")
        spark.createDataFrame([(f,) for f in files], "value string").coalesce(1).write.text(f"{staged}/replaced")
    except Exception:
        remove_folder(spark, staged)
        raise
    system, path = _path(spark, staged)
    if not system.rename(path, _path(spark, f"{place}/_ready-{ident}")[1]):
        raise OSError(f"cannot rename {staged}")
    finish_replacements(spark, name)


def finish_replacements(spark: SparkSession, name: str) -> None:
    """Finish what replacements a driver left half done; nothing to do is no error."""
    place = tables.table_location(spark, name)
    system, path = _path(spark, place)
    if not system.exists(path):
        return
    ready = [s.getPath().toString() for s in system.listStatus(path) if s.getPath().getName().startswith("_ready-")]
    for folder in ready:
        replaced = [r.value for r in spark.read.text(f"{folder}/replaced").collect()]
        root = _path(spark, f"{folder}/rows")[1]
        if system.exists(root):
            base = system.getFileStatus(root).getPath().toString()
            found = system.listFiles(root, True)
            while found.hasNext():
                file = found.next().getPath()
                if file.getName().startswith(("_", ".")):
                    continue
                target = _path(spark, place + file.toString().removeprefix(base))[1]
                system.mkdirs(target.getParent())
                if not system.rename(file, target):
                    raise OSError(f"cannot rename {file.toString()}")
        for file in replaced:
            system.delete(_path(spark, _decoded(spark, file))[1], False)
        remove_folder(spark, folder)
    if ready:
        if tables.partition_columns(spark, name):
            spark.sql("MSCK REPAIR TABLE IDENTIFIER(:name)", args={"name": name})
        spark.catalog.refreshTable(name)


def _in_range(table: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose keys lie within the source's smallest and largest ones: a filter that files' statistics answer."""
    ends = source.agg(*[f(k).alias(f"{k}_{n}") for k in keys for f, n in ((F.min, "low"), (F.max, "high"))]).first()
    for k in keys:
        if ends[f"{k}_low"] is not None:
            table = table.where(F.col(k).between(F.lit(ends[f"{k}_low"]), F.lit(ends[f"{k}_high"])))
    return table


def upsert_table(source: DataFrame, name: str, keys: list[str]) -> None:
    """``tables.upsert`` into a stored table of the same columns: only files that hold a key of ``source`` are written anew.

    A key given twice in ``source`` is an error, and leaves the table as it was.
    """
    spark = source.sparkSession
    finish_replacements(spark, name)
    held = _in_range(spark.table(name), source, keys).select(*keys, F.col(FILE).alias("_file"))
    touched = held.join(source.select(*keys).distinct(), keys, "left_semi").select("_file").distinct()
    files = sorted(r[0] for r in touched.collect())
    replace_files(tables.upsert(read_files(spark, name, files), source, keys), name, files)


def remove_table_duplicates(spark: SparkSession, name: str, limit: int | None = None) -> int:
    """Of equal rows one stays, the first by file and place; files that lose no row stay untouched. How many rows went.

    With ``limit`` at most so many rows go, the first by file and place.
    """
    finish_replacements(spark, name)
    table = spark.table(name)
    columns = table.columns
    marked = table.select(*columns, F.col(FILE).alias("_file"), F.col("_metadata.row_index").alias("_row"), F.xxhash64(*columns).alias("_hash"))
    groups = marked.groupBy(*columns, "_hash").agg(F.count("*").alias("_n"), F.min(F.struct("_file", "_row")).alias("_first"))
    groups = groups.where("_n > 1").select("_hash", "_first", *[F.col(c).alias(f"_same_{c}") for c in columns])
    on = marked["_hash"] == groups["_hash"]
    for c in columns:
        on &= marked[c].eqNullSafe(groups[f"_same_{c}"])
    again = marked.join(groups, on).where((F.col("_file") != F.col("_first._file")) | (F.col("_row") != F.col("_first._row")))
    doomed = again.select("_file", "_row")
    if limit is not None:
        doomed = doomed.orderBy("_file", "_row").limit(limit)
    tables.ensure_checkpoints(spark)
    doomed = doomed.checkpoint()
    count = doomed.count()
    if count:
        files = sorted(r[0] for r in doomed.select("_file").distinct().collect())
        rows = read_files(spark, name, files).select(*columns, F.col(FILE).alias("_file"), F.col("_metadata.row_index").alias("_row"))
        replace_files(rows.join(doomed, ["_file", "_row"], "left_anti").select(*columns), name, files)
    return count
