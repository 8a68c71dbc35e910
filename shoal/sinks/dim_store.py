"""Dimension tables that grow by micro-batches: only touched buckets are written anew.

A table's rows are dealt over buckets by a hash of their key. A micro-batch reads the
buckets that its keys fall into, puts its entries over theirs and writes those buckets
under its own folder, ``path/batch=<id>/sink_table=<t>/bucket=<b>/``; the newest whole batch that has a
bucket is that bucket's current version. Nothing is overwritten in place: a reader sees
each bucket as it was or as it is, never none, and a batch that fails half-way, or is
replayed, leaves the versions before it as they were. Versions that have been replaced
go ``keep`` batches later, so that readers at work can finish.

The number of buckets is noted with the first batch and holds from then on.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoal.operators.dims import dim_entries, dim_rows, newest_entries, state_from_entries
from shoal.sinks.writers import whole_folders

FIELDS = "pk string, column string, value string, ts long, seq long"
Bucket = tuple[str, int]  # sink table, bucket


class DimStore:
    def __init__(self, spark: SparkSession, path: str, buckets: int = 64, keep: int = 3):
        self.spark, self.path, self.keep = spark, path.rstrip("/"), keep
        self.buckets = self._layout(buckets)

    def _fs(self, path: str):
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()), found

    def _children(self, path: str) -> list[str]:
        fs, found = self._fs(path)
        return [s.getPath().getName() for s in fs.listStatus(found)] if fs.exists(found) else []

    def _layout(self, buckets: int) -> int:
        noted = [int(n.split("=")[1]) for n in self._children(f"{self.path}/layout")]
        if not noted:
            fs, note = self._fs(f"{self.path}/layout/buckets={buckets}")
            fs.mkdirs(note)
        return noted[0] if noted else buckets

    def versions(self, before: int | None = None) -> dict[Bucket, int]:
        """The batch that wrote each bucket's current version."""
        out: dict[Bucket, int] = {}
        for i in whole_folders(self.spark, self.path, "batch"):
            if before is None or i < before:
                for bucket in self._written(i):
                    out[bucket] = i
        return out

    def _written(self, batch_id: int) -> list[Bucket]:
        folder = f"{self.path}/batch={batch_id}"
        return [(self._name(t), int(b.split("=")[1])) for t in self._children(folder) if t.startswith("sink_table=")
                for b in self._children(f"{folder}/{t}") if b.startswith("bucket=")]

    def _name(self, folder: str) -> str:
        return self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName(folder.split("=", 1)[1])

    def _folder(self, bucket: Bucket, batch_id: int) -> str:
        name = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(bucket[0])
        return f"{self.path}/batch={batch_id}/sink_table={name}/bucket={bucket[1]}"

    def _read(self, buckets: Iterable[tuple[Bucket, int]]) -> DataFrame:
        folders = [self._folder(b, i) for b, i in buckets]
        schema = f"sink_table string, bucket int, {FIELDS}"
        if not folders:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(f"{FIELDS}, batch long, sink_table string, bucket int").option("basePath", self.path) \
            .parquet(*folders).select("sink_table", "bucket", "pk", "column", "value", "ts", "seq")

    def merge(self, routed: DataFrame, batch_id: int) -> list[Bucket]:
        """Put a batch of routed rows over the tables; the buckets that were written. Doing a batch
        again gives the same versions."""
        entries = newest_entries(dim_entries(routed)) \
            .withColumn("bucket", F.pmod(F.xxhash64("pk"), F.lit(self.buckets)).cast("int"))
        entries = entries.persist()  # read twice; a lost part is made again from the batch
        try:
            # a row for each bucket of each configured table at most
            touched = [(r[0], r[1]) for r in entries.select("sink_table", "bucket").distinct().collect()]
            if not touched:
                return []
            now = self.versions(before=batch_id)
            known = self._read([(b, now[b]) for b in touched if b in now])
            merged = newest_entries(known.drop("bucket").unionByName(entries.drop("bucket"))) \
                .withColumn("bucket", F.pmod(F.xxhash64("pk"), F.lit(self.buckets)).cast("int"))
            merged.repartition("sink_table", "bucket").write.mode("overwrite").partitionBy("sink_table", "bucket") \
                .parquet(f"{self.path}/batch={batch_id}")
        finally:
            entries.unpersist()
        self._clean(batch_id)
        return sorted(touched)

    def _clean(self, batch_id: int) -> None:
        """Remove versions that were replaced ``keep`` batches ago or earlier."""
        upto = batch_id - self.keep
        current = self.versions(before=upto + 1)
        for i in whole_folders(self.spark, self.path, "batch"):
            if i >= upto:
                break
            left = 0
            for bucket in self._written(i):
                if current.get(bucket) != i:
                    fs, old = self._fs(self._folder(bucket, i))
                    fs.delete(old, True)
                else:
                    left += 1
            if not left:
                fs, old = self._fs(f"{self.path}/batch={i}")
                fs.delete(old, True)

    def entries(self, sink_table: str | None = None) -> DataFrame:
        """The newest entry of each key and column."""
        now = self.versions().items()
        return self._read([(b, i) for b, i in now if sink_table is None or b[0] == sink_table])

    def state(self, sink_table: str | None = None) -> DataFrame:
        """``sink_table, pk, data`` of the tables as they are now."""
        return state_from_entries(self.entries(sink_table).drop("bucket"))

    def table(self, sink_table: str, sink_columns: str, sink_pk: str | None = None) -> DataFrame:
        """One dimension table with its configured columns."""
        return dim_rows(self.state(sink_table), sink_table, sink_columns, sink_pk)
