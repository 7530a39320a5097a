"""Places and small helpers that the corpus operators share.

Intermediate tables and archives go to the folder named by ``spark.checkpoint.dir``, which every
executor can reach; a folder of our own is set only when that setting is absent (tests).
"""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
from collections.abc import Iterator

from pyarrow import fs
from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of one Arrow batch handed to Python; whole texts are in them, so the batches stay small.
BATCH_ROWS = 512
#: Bytes of one; a text that is longer has a batch of its own.
BATCH_BYTES = 32 << 20


def shared_root(spark: SparkSession) -> str:
    """The URI of the folder that driver and executors share."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        held = spark.sparkContext.getCheckpointDir()
        if held is None:
            master = spark.sparkContext.master
            if not (master == "local" or master.startswith("local[")):
                raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="filingmill-"))
            held = spark.sparkContext.getCheckpointDir()
        root = held
    return root.rstrip("/")


def fresh_dir(spark: SparkSession, tag: str) -> str:
    """A new path below the shared folder; nothing exists there yet."""
    return f"{shared_root(spark)}/{tag}-{uuid.uuid4().hex}"


def staged(df: DataFrame, tag: str, scratch: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back, which cuts its lineage; ``scratch`` takes note of its path."""
    spark = df.sparkSession
    path = fresh_dir(spark, tag)
    df.write.parquet(path)
    if scratch is not None:
        scratch.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_dirs(spark: SparkSession, scratch: list[str]) -> None:
    """Delete the folders that ``staged`` noted, once nothing that is still to run reads them."""
    jvm = spark.sparkContext._jvm
    while scratch:
        target = jvm.org.apache.hadoop.fs.Path(scratch.pop())
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def small_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of whole texts, in rows and bytes, so that they fit in a worker's memory.

    The planner reads both settings from the session when the query runs, so they are lowered there and
    stay; a session that has smaller ones keeps them.
    """
    for key, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS), ("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)):
        now = spark.conf.get(key)
        held = int(now) if now.lstrip("-").isdigit() else None
        if held is None or held <= 0 or held > most:
            spark.conf.set(key, str(most))


def opened(uri: str) -> tuple[fs.FileSystem, str]:
    """The Arrow file system and path of a URI; a bare path is a local one."""
    if "://" in uri or uri.startswith("file:"):
        if uri.startswith("file:"):
            return fs.LocalFileSystem(), "/" + uri[5:].lstrip("/")
        return fs.FileSystem.from_uri(uri)
    return fs.LocalFileSystem(), uri


@contextlib.contextmanager
def whole_file(uri: str) -> Iterator:
    """An output stream whose file appears under ``uri`` only when it is complete.

    Every attempt of a task writes its own temporary name and moves it in place, so a task that
    dies or runs twice leaves one whole file.
    """
    store, path = opened(uri)
    store.create_dir(os.path.dirname(path), recursive=True)
    partial = f"{path}.{uuid.uuid4().hex}.partial"
    stream = store.open_output_stream(partial)
    try:
        yield stream
    except BaseException:
        stream.close()
        store.delete_file(partial)
        raise
    stream.close()
    store.move(partial, path)


def text_bytes(col: str | Column) -> Column:
    """UTF-8 bytes of a text, null as no bytes."""
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit("")).cast("binary")


def broadcast_value(spark: SparkSession, value):
    """Broadcast a driver-side value of proven bounded size."""
    context: SparkContext = spark.sparkContext
    return context.broadcast(value)


def never_sent(df: DataFrame) -> DataFrame:
    """One side of a join whose sides are both shuffled, whatever the planner takes them for.

    The planner goes by the size of the files read, and rows that are exploded, or that pack well, are many times
    that: such a side would pass through the driver and to every executor.
    """
    return df.hint("merge")


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Deal few rows of much work each to as many tasks as shuffles have; adaptive execution keeps their number."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *[F.col(k) for k in keys])


#: Bits of the filter of ``possibly_in``, as a power of two.
FILTER_BITS = 24


def possibly_in(df: DataFrame, hashed: Column, members: DataFrame) -> DataFrame:
    """Add ``__hit``: false only where ``hashed`` is none of ``members`` (h bigint).

    The members set bits of a table of at most 2 ** FILTER_BITS bits, which is broadcast whatever their
    number, so rows that can't match need no shuffle. More members than bits make hits of more rows.
    """
    word = lambda h: F.shiftright(h, 6).bitwiseAND(F.lit((1 << FILTER_BITS - 6) - 1)).cast("int")
    bit = lambda h: h.bitwiseAND(F.lit(63)).cast("int")
    one = F.expr("shiftleft(1L, cast(h & 63 as int))")
    words = members.select(word(F.col("h")).alias("__word"), one.alias("one")).groupBy("__word").agg(F.bit_or("one").alias("__bits"))
    found = df.withColumn("__hash", hashed).withColumn("__word", word(F.col("__hash")))
    hit = F.coalesce(F.getbit("__bits", bit(F.col("__hash"))) == 1, F.lit(False))
    return found.join(F.broadcast(words), "__word", "left").withColumn("__hit", hit).drop("__word", "__bits", "__hash")
