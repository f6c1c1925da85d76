"""Incremental ingest: new document files are upserted into a Parquet table as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from qirtas.operators.graph import upsert

#: Parts of the table by a hash of the key; a batch rewrites only those it has keys of.
BUCKETS = 64


def merge_batch(spark: SparkSession, target: str, batch: DataFrame, number: int, key: str = "id", order: str = "updated_at", buckets: int = BUCKETS) -> None:
    """Upsert one batch into the versions below ``target``.

    The touched buckets are written as version ``number``, from their greatest
    version before, so a batch that is run again writes the same. Rows without a
    key are left out; of several rows of a key in a batch the last values win,
    in the first batch too.
    """
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")
    batch = batch.where(F.col(key).isNotNull())
    # At most one row per bucket.
    touched = [r[0] for r in batch.select(bucket).distinct().collect()]
    if not touched:
        return
    old = latest_version(spark, target, before=number, only=touched)
    old = batch.limit(0) if old is None else old.drop("bucket")
    merged = upsert(old, batch, key, order).withColumn("bucket", bucket)
    merged.repartition(min(buckets, len(touched)), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{target}/version={number}")


def ingest_stream(spark: SparkSession, source: str, schema, target: str, checkpoint: str, key: str = "id", order: str = "updated_at") -> StreamingQuery:
    """Upsert JSON documents of ``source`` into ``target`` (see ``merge_batch``); read it with ``latest_version``."""
    stream = spark.readStream.schema(schema).option("multiLine", True).json(source)
    merge = lambda batch, number: merge_batch(spark, target, batch, number, key, order)
    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_version(spark: SparkSession, target: str, before: int | None = None, only: list[int] | None = None) -> DataFrame | None:
    """The greatest version of every bucket below ``target`` (below ``before`` and of the buckets ``only``, if given), or None."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{target}/version=*/bucket=*")
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    newest: dict[int, int] = {}
    for status in fs.globStatus(path) or []:
        found = status.getPath()
        bucket, version = int(found.getName().split("=")[1]), int(found.getParent().getName().split("=")[1])
        if (before is None or version < before) and (only is None or bucket in only):
            newest[bucket] = max(version, newest.get(bucket, version))
    paths = [f"{target}/version={v}/bucket={b}" for b, v in sorted(newest.items())]
    return spark.read.option("basePath", target).parquet(*paths).drop("version") if paths else None
