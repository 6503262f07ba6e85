"""One LOCATION table over many deliveries: only the buckets that a delivery touches are written again."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tractline.operators.locations import distinct_location
from tractline.schemas import LOCATION_COLUMNS
from tractline.session import discard, stored

BUCKETS = 64
_BUCKET = "_bucket"


class LocationStore:
    """A LOCATION table in ``folder``, in hash buckets of ``location_id``, that takes deliveries one after the other.

    ``manifest/<version>.json`` says in which version's folder each bucket lies and which deliveries it
    holds; the newest manifest is the table. A merge writes the buckets it changes into a folder of the next
    version and then puts its manifest in place by a rename. What stops before that leaves the table as it was,
    and the merge may be run again; a delivery that is in already changes nothing. One writer at a time.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = BUCKETS) -> None:
        self.spark, self.folder = spark, folder.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.folder).getFileSystem(spark._jsc.sc().hadoopConfiguration())
        self.buckets = self._manifest()["buckets"] if self.version() else buckets

    def version(self) -> int:
        """The number of the newest manifest; 0 before the first delivery."""
        home = self._path(f"{self.folder}/manifest")
        if not self._files.exists(home):
            return 0
        names = [s.getPath().getName() for s in self._files.listStatus(home)]
        return max((int(n.removesuffix(".json")) for n in names if n[0].isdigit() and n.endswith(".json")), default=0)

    def _manifest(self) -> dict:
        version = self.version()
        if not version:
            return {"buckets": self.buckets, "deliveries": [], "held": {}}
        text = self.spark.read.text(f"{self.folder}/manifest/{version}.json", wholetext=True).first().value
        return json.loads(text)

    def _read(self, held: dict[str, int]) -> DataFrame | None:
        paths = [f"{self.folder}/version={v}/{_BUCKET}={b}" for b, v in sorted(held.items())]
        # The folder names alone do not belong to the table's columns.
        return self.spark.read.parquet(*paths).select(*LOCATION_COLUMNS) if paths else None

    def read(self) -> DataFrame | None:
        """The table, each distinct row once; None before the first delivery."""
        return self._read(self._manifest()["held"])

    def merge(self, delivery: str, *frames: DataFrame) -> list[int]:
        """Add the distinct LOCATION rows of ``frames``; the buckets that were written again.

        Buckets whose rows are all in the table already are left alone.
        """
        manifest = self._manifest()
        if delivery in manifest["deliveries"]:
            return []
        version = self.version() + 1
        known = self.read()
        new = distinct_location(*frames)
        if known is not None:
            new = new.select(*[F.col(c).cast(known.schema[c].dataType).alias(c) for c in LOCATION_COLUMNS])
        new = stored(new.withColumn(_BUCKET, self._bucket()), "location-new")
        touched = self._touched(new, manifest)
        if touched:
            rows = new.where(F.col(_BUCKET).isin(touched)).drop(_BUCKET)
            held = self._read({b: v for b, v in manifest["held"].items() if int(b) in touched})
            rows = rows if held is None else rows.unionByName(held)
            # The bucket's number as a key keeps a bucket's rows in as few files as adaptive execution finds fit.
            merged = rows.dropDuplicates().withColumn(_BUCKET, self._bucket()).hint("rebalance", _BUCKET)
            merged.write.mode("overwrite").partitionBy(_BUCKET).parquet(f"{self.folder}/version={version}")
        manifest["held"] |= {str(b): version for b in touched}
        manifest["deliveries"].append(delivery)
        self._commit(version, manifest)
        discard(new)
        return touched

    def _bucket(self):
        return F.pmod(F.xxhash64("location_id"), F.lit(self.buckets)).cast("int")

    def _touched(self, new: DataFrame, manifest: dict) -> list[int]:
        wanted = [r[0] for r in new.select(_BUCKET).distinct().collect()]
        held = self._read({b: v for b, v in manifest["held"].items() if int(b) in wanted})
        if held is not None:
            # Set difference takes NULLs for equal, as the distinct rows do.
            added = new.drop(_BUCKET).exceptAll(held).withColumn(_BUCKET, self._bucket())
            wanted = [r[0] for r in added.select(_BUCKET).distinct().collect()]
        return sorted(wanted)

    def _commit(self, version: int, manifest: dict) -> None:
        target, draft = (self._path(f"{self.folder}/manifest/{name}") for name in (f"{version}.json", f"draft-{version}"))
        out = self._files.create(draft, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        if self._files.exists(target) or not self._files.rename(draft, target):
            raise RuntimeError(f"another writer made version {version} of {self.folder}")

    def drop_old(self) -> None:
        """Delete buckets that only earlier versions of the table hold; no reader may still be in one."""
        held = self._manifest()["held"]
        for status in self._files.listStatus(self._path(self.folder)):
            name = status.getPath().getName()
            if name.startswith("version="):
                for bucket in self._files.listStatus(status.getPath()):
                    number = bucket.getPath().getName().removeprefix(f"{_BUCKET}=")
                    if number.isdigit() and held.get(number) != int(name.removeprefix("version=")):
                        self._files.delete(bucket.getPath(), True)
