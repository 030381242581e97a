"""Intermediate results as Parquet in the folder that all executors share, and rows carried as one column."""

from __future__ import annotations

import atexit
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowtide.session import shared_dir

_made: dict[str, object] = {}


def scratch(spark: SparkSession) -> str:
    """A new folder, which is removed when its readers are done (``discard``) or else when Python ends."""
    place = f"{shared_dir(spark)}/flowtide-llm-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(place)
    _made[place] = (path.getFileSystem(spark._jsc.hadoopConfiguration()), path)
    return place


def stored(df: DataFrame, places: list[str] | None = None) -> DataFrame:
    """``df`` written once and read back: later steps neither recompute it nor depend on lost executors.

    Its folder is added to ``places``, for ``discard`` when nothing reads it any more.
    """
    spark = df.sparkSession
    place = scratch(spark)
    df.write.parquet(place)
    if places is not None:
        places.append(place)
    return spark.read.schema(df.schema).parquet(place)


def discard(places: list[str]) -> None:
    """Remove folders that nothing reads any more, through Spark's own file systems."""
    while places:
        files, path = _made.pop(places.pop())
        files.delete(path, True)


@atexit.register
def _discard_all() -> None:
    try:
        discard(list(_made))
    except Exception:  # noqa: BLE001 - the session may be gone, and its scratch folder with it
        _made.clear()


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def whole_row(df: DataFrame, *left_out: str, name: str = "_row") -> Column:
    """All columns as one, so that no name of a step can clash with theirs."""
    return F.struct(*[F.col(quoted(c)) for c in df.columns if c not in left_out]).alias(name)


def from_row(df: DataFrame, columns: list[str], name: str = "_row", **changed: Column) -> list[Column]:
    """The columns of a row again, some of them replaced."""
    return [changed.get(c, F.col(name).getField(c)).alias(c) for c in columns]


def free_name(name: str, columns: list[str]) -> str:
    """``name`` with as many underscores before it as it takes to be new."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
