"""A table kept by key: an update rewrites only the buckets it touches.

Rows are dealt to a fixed number of buckets by the hash of their key. A version is a manifest that names a folder for
every bucket; an update writes new folders for the buckets of its keys and publishes the next manifest, which
takes the other buckets over. So a reader sees a whole version or the one before, a failed update leaves the
table as it was, and an update that is run again under its number changes nothing. (Overwriting
partitions in place would lose a bucket if the job died between deleting and moving.)
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..files import exists, numbered, publish_json, read_json, remove
from ..session import cut_lineage, discard
from .joins import keyed_join

_BUCKET = "_bucket"


class KeyedTable:
    """``path`` lies in a shared folder; ``buckets`` is fixed when the first version is written.

    With n rows in b buckets an update of u keys rewrites at most min(u, b) of them, n / b rows each. ``dealt_by`` names
    the keys that decide the bucket, by default all; rows that agree in them lie in one bucket.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: str | StructType, keys: Sequence[str], buckets: int = 64,
        dealt_by: Sequence[str] | None = None,
    ):
        self.spark, self.path, self.keys, self.dealt_by = spark, path.rstrip("/"), list(keys), list(dealt_by or keys)
        empty = spark.createDataFrame([], schema)
        self.schema, self.columns, self.buckets = empty.schema, empty.columns, buckets

    def versions(self) -> list[int]:
        return numbered(f"{self.path}/versions")

    def _manifest(self, version: int | None = None) -> dict:
        there = self.versions()
        at = there[-1] if version is None and there else version
        if at not in there:
            return {"buckets": self.buckets, "folders": {}, "rewritten": []}
        return read_json(f"{self.path}/versions/{at}.json")

    def rewritten(self, version: int) -> list[int]:
        """Buckets that a version rewrote."""
        return self._manifest(version)["rewritten"]

    def bucket(self, n: int) -> Column:
        return F.pmod(F.xxhash64(*self.dealt_by), F.lit(n)).cast("int")

    def _read(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{f}" for f in folders])

    def read(self, version: int | None = None) -> DataFrame:
        """All rows of the latest version, or of the one with this number."""
        return self._read(list(self._manifest(version)["folders"].values()))

    def in_buckets(self, touched: Sequence[int], version: int | None = None) -> DataFrame:
        """All rows of some buckets."""
        folders = self._manifest(version)["folders"]
        return self._read([folders[str(b)] for b in touched if str(b) in folders])

    def held(self, keys: DataFrame, version: int | None = None) -> DataFrame:
        """Rows that agree with some row of ``keys`` in what decides the bucket; only the buckets of these are read."""
        manifest = self._manifest(version)
        touched = self._touched(keys, manifest["buckets"])
        rows = self._read([manifest["folders"][str(b)] for b in touched if str(b) in manifest["folders"]])
        return keyed_join(rows, keys.select(*self.dealt_by).distinct(), self.dealt_by, "left_semi", null_safe=True)

    def _touched(self, rows: DataFrame, n: int) -> list[int]:
        """Numbers of the buckets that hold the rows' keys: no more than there are buckets."""
        return sorted(r[0] for r in rows.select(self.bucket(n)).distinct().collect())

    def upsert(self, updates: DataFrame, version: int, latest: Sequence[str]) -> None:
        """Replace rows by key: of the old row and the updates, the one that is greatest by ``latest`` stays.

        Ties in ``latest`` go to the greatest of the other columns, so the result does not depend on the order of rows.
        """
        others = [c for c in self.columns if c not in self.keys]
        order = [*latest, *[c for c in others if c not in latest]]
        self.merge(updates, version, lambda rows: rows.groupBy(*self.keys).agg(
            F.max(F.struct(*order)).alias("_row")
        ).select(*self.keys, *[F.col("_row")[c].alias(c) for c in others]))

    def merge(self, updates: DataFrame, version: int, combine: Callable[[DataFrame], DataFrame]) -> None:
        """Version ``version``: in touched buckets, ``combine`` of old rows and updates together.

        ``combine`` keeps columns and must not change keys. Versions are numbered upwards; one that exists already is kept,
        which makes a retried micro-batch harmless when its number is the version.
        """
        manifest_file = f"{self.path}/versions/{version}.json"
        if exists(manifest_file):
            return
        there = self.versions()
        if there and there[-1] > version:
            raise ValueError(f"version {version} comes after {there[-1]}")
        manifest = self._manifest()
        n, folders = manifest["buckets"], dict(manifest["folders"])
        updates = cut_lineage(updates.select(*self.columns))
        touched = self._touched(updates, n)
        if touched:
            old = self._read([folders[str(b)] for b in touched if str(b) in folders])
            name = f"{version}-{uuid.uuid4().hex}"
            rows = combine(old.unionByName(updates)).select(*self.columns, self.bucket(n).alias(_BUCKET))
            rows.repartition(len(touched), _BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.path}/data/{name}")
            for b in touched:
                folder = f"{name}/{_BUCKET}={b}"
                if exists(f"{self.path}/data/{folder}"):
                    folders[str(b)] = folder
                else:
                    folders.pop(str(b), None)  # nothing is left of this bucket
        discard(updates)
        publish_json(manifest_file, {"buckets": n, "folders": folders, "rewritten": touched})

    def forget(self, keep: int = 2) -> None:
        """Delete all but the ``keep`` latest versions, and folders that only the deleted ones name."""
        there = self.versions()
        old, kept = there[:-keep], there[-keep:]
        named = {f for v in kept for f in self._manifest(v)["folders"].values()}
        for v in old:
            for folder in set(self._manifest(v)["folders"].values()) - named:
                remove(f"{self.path}/data/{folder}")
            remove(f"{self.path}/versions/{v}.json")
