"""A keyed table: hash-partitioned files, partial rewrites, key-pruned reads.

Rows live in ``buckets`` folders by a hash of their key, one row per key,
sorted by key within a bucket.  An upsert reads and rewrites only the buckets
its keys fall into, under a new version folder, and then switches to it with
one manifest file:

    <root>/data/v<n>-<id>/_bucket=<b>/*.parquet    files that version n wrote
    <root>/manifest/<n>.json                       the folder each bucket is in

The manifest is renamed into place, which fails where it exists: of two
writers that start from one version the second one fails and nothing it wrote
is visible, and a job that dies before the switch leaves the table as it was.  The driver holds one number for
each bucket and no rows.  A manifest also names the last batch that each
stream writer has applied: a batch that comes again changes nothing.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .joins import materialize
from .upsert import latest_per_key

BUCKET = "_bucket"
BUCKET_BYTES = 128 << 20


class ConcurrentWrite(RuntimeError):
    """Another writer has committed a version in the meantime."""


class KeyedTable:
    """One row per key; ``order`` columns decide which row of a key is newest."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    # --- manifest --------------------------------------------------------

    def _manifest_path(self, version: int) -> str:
        return f"{self.root}/manifest/{version:012d}.json"

    def version(self) -> int:
        """The newest committed version; -1 if there is no table here."""
        folder = self._path(f"{self.root}/manifest")
        if not self._fs.exists(folder):
            return -1
        names = (s.getPath().getName() for s in self._fs.listStatus(folder))
        return max((int(n[:-5]) for n in names if re.fullmatch(r"\d{12}\.json", n)), default=-1)

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        if version < 0:
            raise FileNotFoundError(f"no keyed table at {self.root}")
        stream = self._fs.open(self._path(self._manifest_path(version)))
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _commit(self, manifest: dict, version: int) -> None:
        """Makes ``manifest`` version ``version``: written under another name
        first, then renamed, which fails where that version exists."""
        jvm, sc = self.spark._jvm, self.spark.sparkContext
        part = self._path(f"{self.root}/manifest/.{version:012d}-{uuid.uuid4().hex}")
        stream = self._fs.create(part, False)
        stream.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        stream.close()
        none = sc._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        none[0] = getattr(jvm.org.apache.hadoop.fs, "Options$Rename").NONE
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(part.toUri(), sc._jsc.hadoopConfiguration())
        try:
            files.rename(self._fs.makeQualified(part), self._fs.makeQualified(self._path(self._manifest_path(version))), none)
        except Py4JJavaError as e:
            self._fs.delete(part, False)
            if "FileAlreadyExistsException" in str(e.java_exception.getClass().getName()):
                raise ConcurrentWrite(f"version {version} of {self.root} exists") from e
            raise

    # --- definition ------------------------------------------------------

    @classmethod
    def create(cls, spark: SparkSession, root: str, schema: StructType, keys: list[str], order: list[str],
               buckets: int | None = None, expected_bytes: int = 0) -> KeyedTable:
        """An empty table.  ``buckets`` defaults to the expected bytes over
        ``BUCKET_BYTES``, and at least the cluster's cores."""
        missing = [c for c in [*keys, *order] if c not in schema.names]
        if missing or not keys or not order or BUCKET in schema.names:
            raise ValueError(f"keys and order must name columns of the schema: {missing or schema.names}")
        table = cls(spark, root)
        if table.version() >= 0:
            raise FileExistsError(f"a keyed table is at {root}")
        buckets = buckets or max(spark.sparkContext.defaultParallelism, -(-expected_bytes // BUCKET_BYTES))
        table._commit({"schema": json.loads(schema.json()), "keys": keys, "order": order, "buckets": buckets,
                       "files": {}, "applied": {}}, 0)
        return table

    def _bucket_of(self, manifest: dict) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in manifest["keys"]]), F.lit(manifest["buckets"])).cast("int")

    # --- reads -----------------------------------------------------------

    def _read(self, manifest: dict, buckets: Iterable[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(manifest["schema"])
        files = manifest["files"]
        at = files if buckets is None else {str(b) for b in buckets} & set(files)
        paths = [f"{self.root}/data/{files[b]}/{BUCKET}={b}" for b in sorted(at, key=int)]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*paths)

    def read(self, version: int | None = None) -> DataFrame:
        """The whole table, now or at an earlier version."""
        return self._read(self.manifest(version))

    def lookup(self, keys: DataFrame) -> DataFrame:
        """Rows whose key is in ``keys`` (its key columns; repeated and null
        keys are fine).  Only the buckets of these keys are read."""
        manifest = self.manifest()
        wanted = keys.select(*manifest["keys"]).distinct()
        at = [r[0] for r in wanted.select(self._bucket_of(manifest).alias(BUCKET)).distinct().collect()]
        rows = self._read(manifest, at)
        same = [rows[k].eqNullSafe(wanted[k]) for k in manifest["keys"]]
        return rows.join(wanted, same, "left_semi")

    def get(self, *key) -> DataFrame:
        """The row of one key: one bucket is read, and inside its sorted file
        only row groups that may hold the key."""
        manifest = self.manifest()
        types = StructType.fromJson(manifest["schema"])
        values = [F.lit(v).cast(types[k].dataType) for k, v in zip(manifest["keys"], key, strict=True)]
        n = F.pmod(F.xxhash64(*values), F.lit(manifest["buckets"])).cast("int")
        rows = self._read(manifest, [self.spark.range(1).select(n).first()[0]])
        for k, v in zip(manifest["keys"], values):
            rows = rows.where(F.col(k).eqNullSafe(v))
        return rows

    # --- writes ----------------------------------------------------------

    def upsert(self, updates: DataFrame, writer: str | None = None, batch: int | None = None) -> bool:
        """Writes each key's newest row of table and ``updates``; equal order
        columns are decided by the rest of the row (greatest), so the result
        depends on the rows alone.  Returns whether a version was committed: a
        ``batch`` not above the last one of its ``writer`` is skipped, and
        so is an update without rows.
        """
        version = self.version()
        manifest = self.manifest(version)
        if writer is not None and batch is not None and batch <= manifest["applied"].get(writer, -1):
            return False
        schema = StructType.fromJson(manifest["schema"])
        updates = updates.select(*[F.col(f.name).cast(f.dataType) for f in schema])
        newest = latest_per_key(updates, manifest["keys"], manifest["order"])
        return self._switch(manifest, version, newest, merge=True, writer=writer, batch=batch)

    def overwrite(self, rows: DataFrame, confirm_truncate: bool = False) -> None:
        """Replaces all rows; as in a keyed store, only if truncation is confirmed."""
        if not confirm_truncate:
            raise ValueError("overwrite() empties the table first: pass confirm_truncate=True")
        version = self.version()
        manifest = self.manifest(version)
        schema = StructType.fromJson(manifest["schema"])
        rows = rows.select(*[F.col(f.name).cast(f.dataType) for f in schema])
        self._switch({**manifest, "files": {}}, version, latest_per_key(rows, manifest["keys"], manifest["order"]),
                     merge=False, writer=None, batch=None, even_empty=True)

    def _switch(self, manifest, version, newest, merge, writer, batch, even_empty=False) -> bool:
        """Merges one row per key into the touched buckets, and commits."""
        names = StructType.fromJson(manifest["schema"]).names
        dealt = materialize(newest.withColumn(BUCKET, self._bucket_of(manifest)))
        folder = f"v{version + 1}-{uuid.uuid4().hex[:12]}"  # its own: two writers may be at one version
        touched = [r[0] for r in dealt.select(BUCKET).distinct().collect()]  # at most one number per bucket
        if touched:
            if merge and set(map(str, touched)) & set(manifest["files"]):
                stored = self._read(manifest, touched).withColumn(BUCKET, self._bucket_of(manifest))
                dealt = dealt.unionByName(stored)
            # one exchange: bucket and key order serve the merge, the sorted
            # files and the partitioned write alike
            keys = [BUCKET, *manifest["keys"]]
            rest = [c for c in names if c not in manifest["keys"] and c not in manifest["order"]]
            order = [F.col(c).desc_nulls_last() for c in [*manifest["order"], *rest]]
            rows = dealt.repartition(max(1, len(touched)), BUCKET) \
                        .withColumn("_rank", F.row_number().over(W.partitionBy(*keys).orderBy(*order))) \
                        .where("_rank = 1").drop("_rank")
            rows.write.partitionBy(BUCKET).parquet(f"{self.root}/data/{folder}")
        elif not even_empty and writer is None:
            return False
        files = {**manifest["files"], **{str(b): folder for b in touched}}
        applied = {**manifest["applied"], **({writer: batch} if writer is not None and batch is not None else {})}
        self._commit({**manifest, "files": files, "applied": applied}, version + 1)
        return True

    def vacuum(self) -> list[str]:
        """Deletes the folders of committed versions that the newest manifest
        has no bucket in; earlier versions can then no longer be read."""
        version = self.version()
        used = set(self.manifest(version)["files"].values())
        folder = self._path(f"{self.root}/data")
        names = [s.getPath().getName() for s in self._fs.listStatus(folder)] if self._fs.exists(folder) else []
        gone = sorted(n for n in names if n not in used and int(n[1:].split("-")[0]) <= version)
        for name in gone:
            self._fs.delete(self._path(f"{self.root}/data/{name}"), True)
        return gone
