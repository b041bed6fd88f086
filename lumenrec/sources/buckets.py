"""A table in buckets by key hash, changed by small deltas and rewritten a bucket at a time.

``base/<id>/bucket=<k>/`` holds the rows of bucket k, ``delta/<id>/bucket=<k>/`` those of one batch of changes. The
manifest (see ``manifests``) names the folder of every bucket and the batches that are not merged yet. A reader of
some keys opens their buckets only; a merge rewrites the buckets that the waiting deltas touch and leaves the
files of all others as they are.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lumenrec.operators.reduced import distinct_keys
from lumenrec.sources import manifests
from lumenrec.sources.snapshots import _hadoop

BUCKET = "bucket"


@dataclass(frozen=True)
class BucketTable:
    """``rows`` and ``changes`` are the schemas of the table and of its deltas, both with the column ``key``;
    ``merge(rows, changes)`` gives the rows after the changes, and must work on each key by itself."""

    spark: SparkSession
    root: str
    rows: StructType
    changes: StructType
    merge: Callable[[DataFrame, DataFrame], DataFrame]
    key: str = "search_key"
    buckets: int = 64
    #: Files that a bucket may be written in, so that one with a hot key is no single task.
    files: int = 4

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def manifest(self) -> dict:
        return manifests.latest(self.spark, self.root)[1]

    def _write(self, df: DataFrame, kind: str) -> tuple[str, list[int]]:
        """Rows in a new folder, by bucket; its path and the buckets that got any."""
        path = f"{kind}/{uuid.uuid4().hex}"
        spread = F.pmod(F.hash(*df.columns), F.lit(self.files))
        df.withColumn(BUCKET, self.bucket()).repartition(F.col(BUCKET), spread).write.partitionBy(BUCKET).parquet(f"{self.root}/{path}")
        fs, folder = _hadoop(self.spark, f"{self.root}/{path}")
        names = [s.getPath().getName() for s in fs.listStatus(folder) if s.isDirectory()]
        return path, sorted(int(n.removeprefix(f"{BUCKET}=")) for n in names if n.startswith(f"{BUCKET}="))

    def _read(self, folders: Sequence[str], schema: StructType) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(*[f"{self.root}/{f}" for f in folders])

    def create(self, df: DataFrame) -> None:
        """The first rows. A table that is there already is left alone."""
        if self.manifest():
            return
        path, found = self._write(df.select(*self.rows.names), "base")
        first = {"base": {str(b): path for b in found}, "deltas": [], "writers": {}}
        manifests.change(self.spark, self.root, lambda content: content or first)

    def append(self, changes: DataFrame, batch: int, writer: str = "stream") -> bool:
        """Add a batch of changes; False if the writer had added this batch before."""
        if self.manifest().get("writers", {}).get(writer, -1) >= batch:
            return False
        path, found = self._write(changes.select(*self.changes.names), "delta")
        entries = [{"path": path, "buckets": found, "writer": writer, "batch": batch}] if found else []

        def edit(content: dict) -> dict:
            if content.get("writers", {}).get(writer, -1) >= batch:
                return {**content, "dropped": manifests.dropped(content, [path])}
            writers = {**content.get("writers", {}), writer: batch}
            return {**content, "deltas": [*content.get("deltas", []), *entries], "writers": writers}

        _, content = manifests.change(self.spark, self.root, edit)
        return path not in {d["path"] for d in content.get("dropped", [])}

    def batch(self, number: int, writer: str = "stream") -> DataFrame:
        """The changes of one batch that is not merged yet."""
        own = [d for d in self.manifest().get("deltas", []) if d["writer"] == writer and d["batch"] == number]
        return self._read([f"{d['path']}/{BUCKET}={b}" for d in own for b in d["buckets"]], self.changes)

    def buckets_of(self, keys: DataFrame) -> list[int]:
        """The buckets of some keys: at most ``buckets`` numbers."""
        return sorted(r[0] for r in keys.select(self.bucket()).distinct().collect())

    def read(self, keys: DataFrame | None = None) -> DataFrame:
        """The table, waiting changes included; with ``keys`` only their rows, out of their buckets."""
        content = self.manifest()
        wanted = range(self.buckets) if keys is None else self.buckets_of(keys)
        rows, changes = self._parts(content, wanted, content.get("deltas", []))
        if keys is not None:
            only = distinct_keys(keys, self.key)
            rows, changes = (df.join(only, self.key, "left_semi") for df in (rows, changes))
        return self.merge(rows.select(*self.rows.names), changes.select(*self.changes.names)).select(*self.rows.names)

    def _parts(self, content: dict, wanted: Sequence[int], deltas: list[dict]) -> tuple[DataFrame, DataFrame]:
        base = content.get("base", {})
        rows = [f"{base[str(b)]}/{BUCKET}={b}" for b in wanted if str(b) in base]
        held = set(wanted)
        changes = [f"{d['path']}/{BUCKET}={b}" for d in deltas for b in d["buckets"] if b in held]
        return self._read(rows, self.rows), self._read(changes, self.changes)

    def merge_deltas(self) -> list[int]:
        """Rewrite the buckets that waiting deltas touch; which these are.

        Deltas that come in meanwhile stay waiting. If another merge has replaced one of the buckets, this one
        gives up: its files are left to the sweep.
        """
        content = self.manifest()
        deltas = content.get("deltas", [])
        touched = sorted({b for d in deltas for b in d["buckets"]})
        if not deltas:
            return []
        rows, changes = self._parts(content, touched, deltas)
        path, found = self._write(self.merge(rows, changes).select(*self.rows.names), "base")
        done = {d["path"] for d in deltas}
        before = {str(b): content.get("base", {}).get(str(b)) for b in touched}

        def edit(now: dict) -> dict:
            held = now.get("base", {})
            if any(held.get(b) != p for b, p in before.items()) or not done <= {d["path"] for d in now["deltas"]}:
                raise manifests.Conflict(f"{self.root}: another merge was first")
            base = {b: p for b, p in held.items() if b not in before} | {str(b): path for b in found}
            gone = [f"{p}/{BUCKET}={b}" for b, p in before.items() if p is not None] + sorted(done)
            return {
                **now, "base": base, "deltas": [d for d in now["deltas"] if d["path"] not in done],
                "dropped": manifests.dropped(now, gone),
            }

        try:
            manifests.change(self.spark, self.root, edit)
        except manifests.Conflict:
            manifests.change(self.spark, self.root, lambda now: {**now, "dropped": manifests.dropped(now, [path])})
            return []
        return touched

    def sweep(self, lease: float = 86400.0) -> int:
        """Delete replaced files after the lease."""
        return manifests.sweep(self.spark, self.root, lease)
