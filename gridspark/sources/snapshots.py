"""Month tables whose versions are committed whole.

Files are only ever added: a month that changes is written anew beside its old files, under a version of its own. A
manifest lists which version of each month belongs to the table. It is written under another name and renamed, which fails
where the name is taken, so a reader sees the old table or the new one, and of two writers one starts again. Files that no
manifest lists, as an ended job leaves them, are never read.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridspark.sources.sinks import scratch_path, with_month


class Conflict(RuntimeError):
    """Another writer has committed that version."""


class MonthTable:
    """A table by year and month under ``path``; its schema is that of the first rows written."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._hadoop = jvm.org.apache.hadoop
        self._where = self._hadoop.fs.Path(self.path)
        self._files = self._where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())

    # -- manifests

    def versions(self) -> list[int]:
        """Committed versions, in order."""
        folder = self._at("_manifests")
        if not self._files.exists(folder):
            return []
        names = [f.getPath().getName() for f in self._files.listStatus(folder)]
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def manifest(self, version: int | None = None) -> dict:
        """``months``: of each "year-month" its file version; ``batches``: of each stream its last batch; ``schema``."""
        found = self.versions()
        if version is None:
            version = found[-1] if found else 0
        if not version:
            return {"version": 0, "months": {}, "batches": {}, "schema": None}
        stream = self._files.open(self._at("_manifests", _name(version)))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _commit(self, manifest: dict) -> None:
        staged, final = self._at("_manifests", f".{uuid.uuid4().hex}"), self._at("_manifests", _name(manifest["version"]))
        self._files.mkdirs(self._at("_manifests"))
        out = self._files.create(staged, True)
        try:
            out.write(bytearray(json.dumps(manifest, sort_keys=True).encode()))
        finally:
            out.close()
        context = self._hadoop.fs.FileContext.getFileContext(self._files.getUri(), self._files.getConf())
        plain = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            context.rename(self._files.makeQualified(staged), self._files.makeQualified(final), plain)
        except Exception as e:
            self._files.delete(staged, False)
            if self._files.exists(final):
                raise Conflict(f"version {manifest['version']} of {self.path} is there already") from e
            raise

    # -- reading

    def read(self, version: int | None = None, months: list[tuple[int, int]] | None = None) -> DataFrame:
        """The rows of a version (by default the last), with year and month; of some months only if they are given. Only
        listed folders are read."""
        m = self.manifest(version)
        if m["schema"] is None:
            raise ValueError(f"{self.path} has no version yet")
        wanted = None if months is None else {_key(*x) for x in months}
        folders = [f"{self.path}/data/year={k.split('-')[0]}/month={k.split('-')[1]}/__version={v}" for k, v in sorted(m["months"].items()) if wanted is None or k in wanted]
        if not folders:
            return self.spark.createDataFrame([], schema=_schema(m["schema"]))
        reader = self.spark.read.schema(_schema(m["schema"])).option("basePath", f"{self.path}/data")
        return reader.parquet(*folders).drop("__version")

    def months(self, version: int | None = None) -> list[tuple[int, int]]:
        return sorted(tuple(map(int, k.split("-"))) for k in self.manifest(version)["months"])

    def missing(self, wanted: DataFrame) -> DataFrame:
        """The (year, month) of ``wanted`` that the table lacks, by its manifest: no data is read."""
        done = self.spark.createDataFrame(self.months(), "year int, month int")
        return wanted.select(F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month")).distinct().join(F.broadcast(done), ["year", "month"], "left_anti")

    # -- writing

    def replace(self, df: DataFrame, batch: tuple[str, int] | None = None) -> int:
        """The months in ``df`` have its rows from now on, others stay; the new version's number."""
        path = self._stage(df)
        return self._write(path, lambda staged, manifest, touched: staged, batch)

    def merge(self, df: DataFrame, keys: list[str], batch: tuple[str, int] | None = None) -> int:
        """The rows of ``df`` are added and replace stored rows of equal keys; missing keys are equal. Of rows of equal keys in ``df`` the
        greatest in its other columns, in their order, stays. With ``batch`` (a stream's name and the batch's number), one that
        is committed already changes nothing."""
        others = [c for c in df.columns if c not in keys]
        best = F.max(F.struct(*(F.col(c) for c in others))).alias("__best") if others else F.lit(1).alias("__best")
        one = df.groupBy(*keys).agg(best).select(*keys, *(F.col(f"__best.`{c}`").alias(c) for c in others)).select(*df.columns)

        def rows(staged: DataFrame, manifest: dict, touched: list[tuple[int, int]]) -> DataFrame:
            old = [m for m in touched if _key(*m) in manifest["months"]]
            if not old:
                return staged
            new = staged.select(*(F.col(k).alias(f"__{k}") for k in keys))
            equal = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
            stored = self.read(manifest["version"], old).select(*staged.columns)
            return staged.unionByName(stored.join(new, equal, "left_anti"))

        return self._write(self._stage(one), rows, batch)

    def vacuum(self, keep: int = 1) -> int:
        """Deletes files that none of the last ``keep`` versions has, and older manifests; the number of folders. Not while a writer is at work."""
        kept = self.versions()[-keep:]
        live = {(k, v) for n in kept for k, v in self.manifest(n)["months"].items()}
        gone = 0
        for status in self._files.globStatus(self._at("data", "year=*/month=*/__version=*")) or []:
            folder = status.getPath()
            parts = folder.toString().split("/")[-3:]
            if (f"{parts[0].partition("=")[2]}-{parts[1].partition("=")[2]}", parts[2].partition("=")[2]) not in live:
                self._files.delete(folder, True)
                gone += 1
        for n in self.versions():
            if n not in kept:
                self._files.delete(self._at("_manifests", _name(n)), False)
        return gone

    def _stage(self, df: DataFrame) -> str:
        """Written once: its months must be known before it is stored."""
        path = scratch_path(self.spark, "months")
        with_month(df).write.parquet(path)
        return path

    def _write(self, path: str, rows, batch: tuple[str, int] | None) -> int:
        staged = self.spark.read.parquet(path)
        try:
            touched = [(r.year, r.month) for r in staged.select("year", "month").distinct().collect()]
            if any(year is None for year, _ in touched):
                raise ValueError("rows without a date belong to no month")
            while True:
                manifest = self.manifest()
                if batch and manifest["batches"].get(batch[0], -1) >= batch[1]:
                    return manifest["version"]
                data = [c for c in staged.columns if c not in ("year", "month")]
                schema = manifest["schema"] or staged.select(*data, "year", "month").schema.json()
                version = "v" + uuid.uuid4().hex
                if touched:
                    # A month is dealt by day, so one long month is written by several tasks.
                    order = [c for c in ("date", "lat_idx", "lon_idx") if c in data]
                    out = rows(staged, manifest, touched).withColumn("__version", F.lit(version)).repartition("year", "month", F.dayofmonth("date") % 4)
                    out.sortWithinPartitions("year", "month", *order).write.mode("append").partitionBy("year", "month", "__version").parquet(f"{self.path}/data")
                months = manifest["months"] | {_key(*m): version for m in touched}
                batches = manifest["batches"] | ({batch[0]: batch[1]} if batch else {})
                try:
                    self._commit({"version": manifest["version"] + 1, "months": months, "batches": batches, "schema": schema})
                    return manifest["version"] + 1
                except Conflict:
                    continue
        finally:
            self._files.delete(self._hadoop.fs.Path(path), True)

    def _at(self, *parts: str):
        return self._hadoop.fs.Path("/".join([self.path, *parts]))


def _name(version: int) -> str:
    return f"{version:010d}.json"


def _key(year: int, month: int) -> str:
    return f"{year}-{month}"


def _schema(text: str):
    from pyspark.sql.types import StructType

    return StructType.fromJson(json.loads(text))
