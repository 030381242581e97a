"""Continuous pickup of landed fact files with a per-key high-water mark.

Layout under the sink path::

    data/batch_id=K/               rows accepted from micro-batch K
    maxima/batch_id=K/bucket=B/    newest date per (id, chain, token) among them
    snapshots/upto=K/bucket=B/     newest date per key over all batches up to K
    marks/upto=K/                  one row: snapshot K is complete

Every batch overwrites its own directories and reads only those of earlier batches, so a replay after a
failure writes the same rows again instead of dropping or doubling them. The high-water mark is read
from the newest earlier snapshot plus the maxima since then, never from the data. Keys are dealt into buckets by their
hash, and within a bucket sorted by it: a batch reads only the buckets of its keys, and of these, where it has few keys, only the
row groups whose range and Bloom filter allow one of their hashes. Snapshots older than the last three are removed, and
the maxima that no snapshot left needs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from flowtide.operators.aggregates import latest_dates
from flowtide.schemas import FACTS, as_facts
from flowtide.session import folder_names, remove_folder
from flowtide.sources.ingest import incremental_rows

KEYS = ["id", "chain_name", "token_name"]
#: Snapshots that stay for replays.
KEPT_SNAPSHOTS = 3
#: Buckets of keys. A sink keeps the number it was created with.
BUCKETS = 64
#: Up to so many keys of a batch are looked up by their hashes.
FEW_KEYS = 10
_MAXIMA = StructType([FACTS[k] for k in KEYS] + [StructField("latest_date", FACTS["date"].dataType)])
_BUCKETED = StructType([*_MAXIMA.fields, StructField("key_hash", LongType())])


class FactSink:
    """Parquet fact store fed by micro-batches."""

    def __init__(self, spark: SparkSession, path: str, snapshot_every: int = 20, buckets: int = BUCKETS):
        self.spark = spark
        self.path = path
        self.snapshot_every = snapshot_every
        self.buckets = buckets

    def create(self, existing: DataFrame | None = None) -> FactSink:
        """Lay the directories down, with ``existing`` facts as the content before the first batch."""
        rows = self.spark.createDataFrame([], FACTS) if existing is None else as_facts(existing)
        rows.write.mode("ignore").parquet(f"{self.path}/data/batch_id=-1")
        self._write_maxima(latest_dates(rows), f"{self.path}/snapshots/upto=-1", "ignore")
        self._write_maxima(self.spark.createDataFrame([], _MAXIMA), f"{self.path}/maxima/batch_id=-1", "ignore")
        self._mark(-1)
        return self

    def _hashed(self, rows: DataFrame) -> DataFrame:
        """With the hash and the bucket of each key."""
        hashed = rows.withColumn("key_hash", F.xxhash64(*KEYS))
        return hashed.withColumn("bucket", F.pmod("key_hash", F.lit(self.buckets)).cast("int"))

    def _write_maxima(self, rows: DataFrame, path: str, mode: str = "overwrite") -> None:
        dealt = self._hashed(rows.select(*_MAXIMA.names)).repartition("bucket").sortWithinPartitions("bucket", "key_hash")
        dealt.write.mode(mode).option("parquet.bloom.filter.enabled#key_hash", "true").partitionBy("bucket").parquet(path)

    def facts(self) -> DataFrame:
        return self.spark.read.schema(FACTS).parquet(f"{self.path}/data").select(*FACTS.names)

    def latest_before(self, batch_id: int, keys: DataFrame | None = None) -> DataFrame:
        """Newest stored date per key, from the batches before ``batch_id`` alone; only for ``keys`` where given."""
        upto = self._marks().where(F.col("upto") < batch_id).agg(F.max("upto")).first()[0]
        if upto is None:
            raise ValueError(f"no snapshot before batch {batch_id} is left")
        since = self._read("maxima/batch_id=*", StructType([*_BUCKETED.fields, StructField("bucket", IntegerType()), StructField("batch_id", IntegerType())]))
        since = since.where((F.col("batch_id") > upto) & (F.col("batch_id") < batch_id)).drop("batch_id")
        snapshot = self._read(f"snapshots/upto={upto}", StructType([*_BUCKETED.fields, StructField("bucket", IntegerType())]))
        if keys is None:
            known = snapshot.unionByName(since)
        else:
            hashed = self._hashed(keys.select(*KEYS)).select("bucket", "key_hash").distinct()
            wanted = F.col("bucket").isin([r.bucket for r in hashed.select("bucket").distinct().collect()])
            few = [r.key_hash for r in hashed.limit(FEW_KEYS + 1).collect()]
            if len(few) <= FEW_KEYS:
                wanted &= F.col("key_hash").isin(few)
            known = snapshot.where(wanted).unionByName(since.where(wanted)).join(keys, KEYS, "left_semi")
        return known.groupBy(*KEYS).agg(F.max("latest_date").alias("latest_date"))

    def write_batch(self, batch: DataFrame, batch_id: int) -> None:
        # a micro-batch runs in a session of its own
        here = FactSink(batch.sparkSession, self.path, self.snapshot_every, self.buckets)
        data, maxima = f"{self.path}/data/batch_id={batch_id}", f"{self.path}/maxima/batch_id={batch_id}"
        keys = batch.select(*KEYS).distinct()
        incremental_rows(batch, here.latest_before(batch_id, keys)).write.mode("overwrite").parquet(data)
        accepted = here.spark.read.schema(FACTS).parquet(data)
        here._write_maxima(latest_dates(accepted), maxima)
        if (batch_id + 1) % self.snapshot_every == 0:
            newest = here.latest_before(batch_id + 1)
            here._write_maxima(newest, f"{self.path}/snapshots/upto={batch_id}")
            here._mark(batch_id)
            here._drop_old_snapshots(batch_id)

    def _mark(self, upto: int) -> None:
        one = self.spark.range(1).select(F.lit(upto).alias("upto"))
        one.write.mode("overwrite").parquet(f"{self.path}/marks/upto={upto}/rows")

    def _marks(self) -> DataFrame:
        return self.spark.read.schema("upto int").parquet(f"{self.path}/marks/*/rows")

    def _drop_old_snapshots(self, upto: int) -> None:
        """Keep the newest ones: a replay of a recent batch still finds where to start."""
        marks = [r.upto for r in self._marks().where(F.col("upto") <= upto).orderBy(F.desc("upto")).limit(KEPT_SNAPSHOTS + 1).collect()]
        for old in marks[KEPT_SNAPSHOTS:]:
            remove_folder(self.spark, f"{self.path}/marks/upto={old}")
            remove_folder(self.spark, f"{self.path}/snapshots/upto={old}")
        # no batch looks behind the oldest snapshot that is left
        for name in folder_names(self.spark, f"{self.path}/maxima"):
            if name.startswith("batch_id=") and -1 < int(name.removeprefix("batch_id=")) <= min(marks[:KEPT_SNAPSHOTS]):
                remove_folder(self.spark, f"{self.path}/maxima/{name}")

    def _read(self, name: str, schema: StructType) -> DataFrame:
        return self.spark.read.schema(schema).option("basePath", f"{self.path}/{name.split('/')[0]}" if "*" in name else f"{self.path}/{name}").parquet(f"{self.path}/{name}")


def stream_landed_files(
    spark: SparkSession, landing: str, sink: FactSink, checkpoint: str, files_per_batch: int | None = None
) -> StreamingQuery:
    """Start a query that appends what has landed in a directory and stops when it has caught up."""
    reader = spark.readStream.schema(FACTS)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return (
        reader.parquet(landing)
        .writeStream.foreachBatch(sink.write_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
