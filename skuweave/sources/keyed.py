"""A table of key buckets: a batch rewrites only the buckets that it touches, and one small file publishes the result."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skuweave.sources.shared import remove

BUCKETS = 64


class KeyedTable:
    """Rows by bucket of their key, in folders data/v=<version>/bucket=<n>, and manifests that name each bucket's folder.

    A version is written whole before its manifest appears by a rename; readers take the newest manifest, so they see all of a
    batch or nothing. A version that is already published is not written again, so a micro-batch that a restarted
    stream repeats changes nothing. A manifest has one entry for each bucket, whatever the table's size.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], schema, buckets: int = BUCKETS):
        self.spark, self.path, self.keys, self.schema, self.buckets = spark, path.rstrip("/"), keys, schema, buckets

    def _fs(self, path: str):
        place = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def versions(self) -> list[int]:
        fs, place = self._fs(f"{self.path}/manifests")
        names = [s.getPath().getName() for s in fs.listStatus(place)] if fs.exists(place) else []
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))

    def manifest(self, version: int | None = None) -> dict:
        """{"buckets": {bucket: version}, ...} of the version (the newest); empty before the first."""
        every = self.versions()
        version = every[-1] if version is None and every else version
        if version is None:
            return {"buckets": {}}
        return json.loads("".join(r[0] for r in self.spark.read.text(f"{self.path}/manifests/{version}.json", wholetext=True).collect()))

    def _publish(self, version: int, manifest: dict) -> None:
        fs, place = self._fs(f"{self.path}/manifests/{version}.json")
        _, hidden = self._fs(f"{self.path}/manifests/.{version}.tmp")
        out = fs.create(hidden, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if not fs.rename(hidden, place):
            raise OSError(f"version {version} of {self.path} was published by somebody else")

    def bucket(self, *cols) -> F.Column:
        return F.pmod(F.xxhash64(*(cols or self.keys)), F.lit(self.buckets)).cast("int")

    def _read(self, entries: dict) -> DataFrame:
        paths = [f"{self.path}/data/v={v}/bucket={b}" for b, v in entries.items()]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, version: int | None = None) -> DataFrame:
        return self._read(self.manifest(version)["buckets"])

    def _rewrite(self, batch: DataFrame, version: int | None, merged, **properties) -> int:
        """merged(old rows of the touched buckets, batch) becomes those buckets' new rows; other buckets stay as they are."""
        every = self.versions()
        version = (every[-1] + 1 if every else 0) if version is None else version
        if every and version <= every[-1]:
            return every[-1]
        now = self.manifest()
        touched = sorted(r[0] for r in batch.select(self.bucket().alias("b")).distinct().collect())  # at most as many as there are buckets
        held = {b: v for b, v in now["buckets"].items() if int(b) in touched}
        rows = merged(self._read(held), batch.select(*self.schema.fieldNames()))
        where = f"{self.path}/data/v={version}"
        rows.withColumn("bucket", self.bucket()).repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(where)
        fs, place = self._fs(where)
        wrote = {s.getPath().getName()[7:] for s in fs.listStatus(place) if s.getPath().getName().startswith("bucket=")}
        kept = {b: v for b, v in now["buckets"].items() if int(b) not in touched}
        self._publish(version, {**{k: v for k, v in now.items() if k != "buckets"}, **properties, "buckets": {**kept, **dict.fromkeys(sorted(wrote), version)}})
        return version

    def upsert(self, batch: DataFrame, order: list[str], version: int | None = None, **properties) -> int:
        """Of each key the row with the largest `order` stays, of equal ones the first by all columns; returns the version."""

        def merged(old: DataFrame, new: DataFrame) -> DataFrame:
            whole = F.struct(*self.schema.fieldNames())
            return old.unionByName(new).groupBy(*self.keys).agg(F.max_by(whole, F.struct(*order, F.to_json(whole))).alias("_r")).select("_r.*")

        return self._rewrite(batch, version, merged, **properties)

    def replace(self, updates: DataFrame, by: list[str] | None = None, version: int | None = None) -> int:
        """All rows of the keys in updates go, then updates come in; the same call again changes nothing."""
        by = by or self.keys
        return self._rewrite(updates, version, lambda old, new: old.join(new.select(*by).distinct(), by, "left_anti").unionByName(new))

    def vacuum(self, keep: int = 2) -> list[int]:
        """Deletes what only manifests older than the newest `keep` name; returns the versions whose data went."""
        every = self.versions()
        used = {v for m in every[-keep:] for v in self.manifest(m)["buckets"].values()}
        for m in every[:-keep]:
            remove(self.spark, f"{self.path}/manifests/{m}.json")
        fs, place = self._fs(f"{self.path}/data")
        held = [int(s.getPath().getName()[2:]) for s in fs.listStatus(place)] if fs.exists(place) else []
        gone = sorted(v for v in held if v not in used and every and v <= every[-1])
        for v in gone:
            remove(self.spark, f"{self.path}/data/v={v}")
        return gone
