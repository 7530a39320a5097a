"""The evidence lake: Parquet tables with declared schemas and keys, in buckets, with snapshots.

A table's rows lie in folders by bucket of its key, and a manifest lists the folders of each version
(``commits``). A replacing write adds rows of a new generation with the keys that it covers, also
those that end up without rows, in one commit; readers take, for every key, the rows of the latest
generation that covers it. Reading some keys lists the folders of their buckets alone. Compaction
writes the current rows anew and drops what is superseded; files stay until ``vacuum``, so readers
that began before it see what they saw.
"""

from __future__ import annotations

import tempfile
import time
import uuid
import zlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from filingmill.sources.commits import Commits, Conflict, Folder, Manifest
from filingmill.sources.schemas import KEYS, SCHEMAS, conformed

AUDIT, ANALYTICS = "audit", "analytics"
#: Buckets of a new table.
BUCKETS = 16
KEY_SCHEMA = "key string, generation bigint"


def scratch_root(spark: SparkSession) -> str:
    """A folder for a lake that lasts as long as a query: below spark.checkpoint.dir, or a temporary one in local mode only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    master = spark.sparkContext.master
    if not (master == "local" or master.startswith("local[")):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    return tempfile.mkdtemp(prefix="filingmill-lake-")


def bucket_of(key: str, buckets: int) -> int:
    """The bucket of a key; null keys have that of the empty one."""
    return zlib.crc32(key.encode()) % buckets


def _bucket(key: str | Column, buckets: int) -> Column:
    col = F.col(key) if isinstance(key, str) else key
    return (F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")) % buckets).cast("int")


class Lake:
    """Tables below a root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, table: str) -> str:
        return f"{self.root}/{ANALYTICS if table == 'trusted_facts' else AUDIT}/{table}"

    def commits(self, table: str) -> Commits:
        return Commits(self.spark, f"{self._path(table)}/versions")

    def exists(self, path: str) -> bool:
        """Whether a file or folder is there, in whatever store Spark reads."""
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(at)

    def initialize(self, buckets: int = BUCKETS) -> None:
        """Create every declared table that isn't there; a second call changes nothing."""
        for table in SCHEMAS:
            self.commits(table).begin(buckets)

    def _schema(self, table: str) -> T.StructType:
        return T.StructType([*[T.StructField(f.name, f.dataType, True) for f in SCHEMAS[table].fields], T.StructField("generation", T.LongType())])

    def _write(self, table: str, kind: str, rows: DataFrame, key: str, buckets: int) -> Folder:
        """Write rows by bucket; nothing refers to them yet."""
        path = f"{self._path(table)}/{kind}/{uuid.uuid4().hex}"
        rows.withColumn("bucket", _bucket(key, buckets)).write.partitionBy("bucket").parquet(path)
        jvm = self.spark.sparkContext._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        names = [s.getPath().getName() for s in at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).listStatus(at)]
        return Folder(path, kind, tuple(sorted(int(n.partition("=")[2]) for n in names if n.startswith("bucket="))))

    def _rows(self, table: str, manifest: Manifest, rows: DataFrame, generation: int) -> Folder:
        made = conformed(rows, table).withColumn("generation", F.lit(generation).cast("bigint"))
        return self._write(table, "rows", made, KEYS[table], manifest.buckets)

    def append(self, table: str, rows: DataFrame, generation: int = 0) -> None:
        """Add rows. A row of a key that a replacement has covered is read only if its generation is that replacement's."""
        log = self.commits(table)
        folder = self._rows(table, log.read(), rows, generation)
        log.commit(lambda now: ([folder] if folder.buckets else [], []))

    def replace(self, table: str, rows: DataFrame, covered: DataFrame, base: int | None = None) -> None:
        """Replace the rows of the keys in ``covered`` (a column of the table's key) by ``rows``, none included.

        Rows and covered keys appear together. With ``base``, the version that the new rows rest on, a later commit to a
        bucket of a covered key is a ``Conflict``; what was written is then never read.
        """
        key, log = KEYS[table], self.commits(table)
        start = log.read()
        generation = self.next_generation(table)
        written = self._rows(table, start, rows, generation)
        keys = covered.select(F.col(key).cast("string").alias("key")).distinct().withColumn("generation", F.lit(generation).cast("bigint"))
        listed = self._write(table, "keys", keys, "key", start.buckets)

        def change(now: Manifest):
            if base is not None and now.since(base) & {*written.buckets, *listed.buckets}:
                raise Conflict(f"{table} has changed since version {base}")
            return [f for f in (written, listed) if f.buckets], []

        log.commit(change)

    def next_generation(self, table: str) -> int:
        """The time in nanoseconds, after every replacement so far."""
        latest = self._keys(table, self.commits(table).read(), None).agg(F.max("generation").alias("g")).first()["g"] or 0
        return max(latest + 1, time.time_ns())

    def _keys(self, table: str, manifest: Manifest, buckets: set[int] | None) -> DataFrame:
        paths = manifest.of("keys", buckets)
        return self.spark.read.schema(KEY_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], KEY_SCHEMA)

    def _current(self, table: str, manifest: Manifest, buckets: set[int] | None) -> DataFrame:
        """The current rows with their generation."""
        paths, key = manifest.of("rows", buckets), KEYS[table]
        if not paths:
            return self.spark.createDataFrame([], self._schema(table))
        rows = self.spark.read.schema(self._schema(table)).parquet(*paths)
        if not manifest.of("keys", buckets):
            return rows
        latest = self._keys(table, manifest, buckets).groupBy("key").agg(F.max("generation").alias("__latest"))
        joined = rows.join(latest, rows[key].cast("string") == latest["key"], "left")
        return joined.where(F.col("generation") == F.coalesce("__latest", F.col("generation"))).drop("key", "__latest")

    def version(self, table: str) -> int:
        return self.commits(table).read().version

    def read(self, table: str, of: Sequence[str] | None = None, version: int | None = None) -> DataFrame:
        """The current rows, of one version: the latest by default.

        With ``of`` only rows of these values of the table's key, from the files of their buckets.
        """
        manifest, key = self.commits(table).read(version), KEYS[table]
        if of is None:
            return self._current(table, manifest, None).drop("generation")
        held = self._current(table, manifest, {bucket_of(k, manifest.buckets) for k in of})
        return held.where(F.col(key).cast("string").isin(*of)).drop("generation")

    def compact(self, table: str) -> int:
        """Write the current rows and the latest generation of every key anew; returns the new version.

        Readers and writers go on meanwhile: what others commit during the work stays beside it.
        """
        log = self.commits(table)
        start = log.read()
        rows = self._current(table, start, None)
        by_bucket = lambda df, key: df.repartition(start.buckets, _bucket(key, start.buckets))
        made = [self._write(table, "rows", by_bucket(rows, KEYS[table]), KEYS[table], start.buckets)]
        keys = self._keys(table, start, None).groupBy("key").agg(F.max("generation").alias("generation"))
        made.append(self._write(table, "keys", by_bucket(keys, "key"), "key", start.buckets))
        old = {f.path for f in start.folders}

        def change(now: Manifest):
            if not old <= {f.path for f in now.folders}:
                raise Conflict(f"{table} was compacted by another")
            return [f for f in made if f.buckets], [f for f in now.folders if f.path in old]

        return log.commit(change).version

    def vacuum(self, table: str, keep: int = 1) -> int:
        """Delete all but the last ``keep`` versions and the files that only they have; returns the number of folders deleted.

        Only for times without readers of older versions and without writers whose files aren't committed yet.
        """
        log = self.commits(table)
        kept = log.versions()[-keep:]
        used = {f.path for v in kept for f in log.read(v).folders}
        log.drop_before(kept[0])
        jvm, gone = self.spark.sparkContext._jvm, 0
        for kind in ("rows", "keys"):
            top = jvm.org.apache.hadoop.fs.Path(f"{self._path(table)}/{kind}")
            store = top.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
            for s in store.listStatus(top) if store.exists(top) else []:
                if f"{self._path(table)}/{kind}/{s.getPath().getName()}" not in used:
                    gone += bool(store.delete(s.getPath(), True))
        return gone
