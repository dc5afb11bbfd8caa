"""Keyed tables that rewrite only the files a change touches, with a change feed.

A table lies in files sorted by key.  A version is a manifest: one row a file, with its
rows and the least and greatest first key.  ``merge`` and ``delete`` look for files that
hold a changed key (ranges first, then a join of the key columns alone), rewrite these,
and write a manifest that keeps all others as they are.  The manifest's success marker
makes the version, so readers never see half a change.  One writer at a time: a second
one that finds the version taken fails.

Each version but the first leaves its changes (``insert``, ``delete``,
``update_preimage``, ``update_postimage``) under ``changes/_commit_version=N``.  They
are staged first and moved in place by one rename after the manifest, by the next writer
or reader if the first one dies between, so the feed shows committed versions only.
``changes_stream`` follows it as a stream: files are offsets, a restart goes on where
the checkpoint ends.

``ChangeFedView`` keeps an aggregate up to date from that feed.  Counts and sums of
whole numbers and decimals add what came and take back what went; averages of them
follow.  What cannot be taken back exactly (least, greatest, fractional sums) is computed
anew from the table's version, for the groups that changed only.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, IntegralType

from lakeops.operators.changes import merge_upsert, snapshot_changes
from lakeops.session import written

ROWS_PER_FILE = 1_000_000
FILES = 512


class KeyedTable:
    """``rows_per_file``: rows of a file that a change would rewrite, at most, in a table
    that has them in up to ``FILES`` such files.  Files of a larger table grow with it, up
    to ``ROWS_PER_FILE`` rows, so that listing and opening them doesn't become the work."""

    def __init__(self, spark: SparkSession, root: str, keys: list[str], rows_per_file: int = ROWS_PER_FILE):
        self.spark, self.root, self.keys, self.rows_per_file = spark, root.rstrip("/"), list(keys), rows_per_file

    def file_rows(self, rows: int) -> int:
        """Rows of a file, at most, of a table of ``rows`` rows."""
        return max(self.rows_per_file, min(-(-rows // FILES), ROWS_PER_FILE))

    # -- versions ------------------------------------------------------------
    def _path(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        p, fs = self._path(f"{self.root}/manifest/version=*/_SUCCESS")
        return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in fs.globStatus(p) or [])

    def _latest(self) -> int:
        found = self.versions()
        if not found:
            raise ValueError(f"no table at {self.root}")
        return found[-1]

    def manifest(self, version: int | None = None) -> DataFrame:
        """(file, rows, low, high, added): the files of a version and the version that wrote each."""
        return self.spark.read.parquet(f"{self.root}/manifest/version={self._latest() if version is None else version}")

    def read(self, version: int | None = None) -> DataFrame:
        return self._files([r.file for r in self.manifest(version).select("file").collect()])

    def _files(self, files: list[str]) -> DataFrame:
        schema = self.spark.read.parquet(f"{self.root}/schema").schema
        return self.spark.read.schema(schema).parquet(*files) if files else self.spark.createDataFrame([], schema)

    # -- writes --------------------------------------------------------------
    def create(self, df: DataFrame) -> "KeyedTable":
        df.limit(0).write.parquet(f"{self.root}/schema")
        self._commit(0, self._written(df, 0, df.count()), None)
        return self

    def merge(self, updates: DataFrame, delete_condition: str | None = None) -> int:
        """Upserts ``updates`` (unique on the keys); returns the new version."""
        updates = written(updates, "keyed-updates")
        return self._change(updates, lambda old: merge_upsert(old, updates, self.keys, delete_condition))

    def delete(self, doomed: DataFrame) -> int:
        """Deletes the rows whose key is in ``doomed``; returns the new version."""
        doomed = written(doomed.select(*self.keys).distinct(), "keyed-doomed")
        return self._change(doomed, lambda old: old.join(doomed, self.keys, "left_anti"))

    def _change(self, by: DataFrame, apply) -> int:
        version = self._latest()
        files = self.manifest(version).collect()
        low, high, n_by = by.agg(F.min(self.keys[0]), F.max(self.keys[0]), F.count(F.lit(1))).first()
        near = [f.file for f in files if low is not None and f.low <= high and f.high >= low]
        at = F.col("_metadata.file_path").alias("__file")
        hit = {r["__file"] for r in (self._files(near).select(*self.keys, at).join(by.select(*self.keys), self.keys, "left_semi")
                                     .select("__file").distinct().collect())} if near else set()
        old = self._files([f.file for f in files if f.file in hit])
        new = self._written(apply(old), version + 1, sum(f.rows for f in files) + n_by)
        kept = self.manifest(version).join(F.broadcast(self.spark.createDataFrame([(h,) for h in hit], "file string")),
                                           "file", "left_anti")
        changed = snapshot_changes(old, self._files([r.file for r in new.select("file").collect()]), self.keys)
        self._commit(version + 1, kept.unionByName(new), changed)
        return version + 1

    def _written(self, df: DataFrame, version: int, rows: int) -> DataFrame:
        """Writes rows as sorted files, sized for a table of ``rows`` rows, and returns
        their part of a manifest."""
        some = F.lit(True)
        for k in self.keys:
            some = some & F.col(f"`{k}`").isNotNull()
        first = self.keys[0]
        df = df.withColumn(first, F.when(some, F.col(f"`{first}`")).otherwise(
            F.raise_error(F.lit(f"null key {self.keys}")).cast(df.schema[first].dataType)))
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        (df.repartitionByRange(*self.keys).sortWithinPartitions(*self.keys).write
         .option("maxRecordsPerFile", self.file_rows(rows)).parquet(path))
        own = self.spark.read.schema(df.schema).parquet(path)
        return written(own.groupBy(F.col("_metadata.file_path").alias("file"))
                       .agg(F.count(F.lit(1)).alias("rows"), F.min(first).alias("low"), F.max(first).alias("high"))
                       .withColumn("added", F.lit(version)), "keyed-files")

    def _commit(self, version: int, files: DataFrame, changed: DataFrame | None) -> None:
        self._settle()
        if changed is not None:
            changed.write.mode("overwrite").parquet(f"{self.root}/staged/_commit_version={version}")
        files.coalesce(1).write.mode("errorifexists").parquet(f"{self.root}/manifest/version={version}")
        self._settle()

    def _settle(self) -> None:
        """Moves the staged changes of committed versions into the feed."""
        p, fs = self._path(f"{self.root}/staged/_commit_version=*/_SUCCESS")
        done = set(self.versions())
        for s in fs.globStatus(p) or []:
            own = s.getPath().getParent()
            if int(own.getName().split("=")[1]) in done:
                target, _ = self._path(f"{self.root}/changes/{own.getName()}")
                fs.mkdirs(target.getParent())
                fs.rename(own, target)

    # -- change feed ---------------------------------------------------------
    def _feed_schema(self) -> str:
        cols = self.spark.read.parquet(f"{self.root}/schema").schema
        return ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in cols), "_change_type string", "_commit_version int"])

    def changes(self, after: int = 0, through: int | None = None) -> DataFrame:
        """The changes of versions after ``after``, up to ``through``."""
        self._settle()
        p, fs = self._path(f"{self.root}/changes")
        if not fs.exists(p):
            return self.spark.createDataFrame([], self._feed_schema())
        rows = self.spark.read.schema(self._feed_schema()).parquet(f"{self.root}/changes")
        return rows.filter((F.col("_commit_version") > after) & (F.col("_commit_version") <= (
            self._latest() if through is None else through)))

    def changes_stream(self, max_files_per_trigger: int | None = None) -> DataFrame:
        """The changes of all versions, those to come included, as a stream."""
        self._settle()
        p, fs = self._path(f"{self.root}/changes")
        fs.mkdirs(p)
        r = self.spark.readStream.schema(self._feed_schema())
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return r.parquet(f"{self.root}/changes")


class ChangeFedView:
    """``SELECT keys, aggregates FROM table GROUP BY keys``, kept up to date from the
    table's change feed.  ``measures``: name -> (sum | count | avg | min | max, column)."""

    def __init__(self, table: KeyedTable, keys: list[str], measures: dict[str, tuple[str, str]], root: str):
        self.table, self.keys, self.measures, self.root = table, list(keys), dict(measures), root.rstrip("/")
        self.spark = table.spark
        types = {f.name: f.dataType for f in table.read(0).schema}
        exact = {n: fn == "count" or fn in ("sum", "avg") and isinstance(types[c], (IntegralType, DecimalType))
                 for n, (fn, c) in measures.items()}
        self.added = {n: m for n, m in self.measures.items() if exact[n]}
        self.anew = {n: m for n, m in self.measures.items() if not exact[n]}

    def _sums(self, rows: DataFrame, sign) -> DataFrame:
        cols = [F.sum(sign).alias("__rows")]
        for n, (fn, c) in self.added.items():
            cols.append(F.sum(F.when(F.col(c).isNotNull(), sign).otherwise(F.lit(0))).alias(f"{n}__n"))
            if fn != "count":
                cols.append(F.sum(F.coalesce(F.col(c) * sign, F.lit(0))).alias(f"{n}__s"))
        return rows.groupBy(*self.keys).agg(*cols)

    def _whole(self, rows: DataFrame) -> DataFrame:
        return rows.groupBy(*self.keys).agg(F.lit(True).alias("__known"), *[getattr(F, fn)(c).alias(n)
                                                                           for n, (fn, c) in self.anew.items()])

    def _write(self, batch: int, sums: DataFrame, groups: DataFrame, version: int) -> None:
        sums.write.mode("overwrite").parquet(f"{self.root}/sums/batch={batch}")
        if self.anew:
            groups.withColumn("__version", F.lit(version)).write.mode("overwrite").parquet(f"{self.root}/groups/batch={batch}")

    def create(self) -> "ChangeFedView":
        """Fills the view from version 0; ``refresh`` brings in the changes since."""
        rows = self.table.read(0)
        self._write(-1, self._sums(rows, F.lit(1)), self._whole(rows), 0)
        return self

    def _take(self, batch: DataFrame, batch_id: int) -> None:
        sign = F.when(F.col("_change_type").isin("insert", "update_postimage"), 1).otherwise(-1)
        sums = self._sums(batch, sign)
        touched = batch.select(*self.keys).distinct()
        top = batch.agg(F.max("_commit_version")).first()[0]
        if top is None:
            return
        mine = [F.col(f"t.`{k}`").eqNullSafe(F.col(f"g.`{k}`")) for k in self.keys]
        rows = self.table.read(top).alias("t").join(touched.alias("g"), mine, "left_semi")
        now = self._whole(rows)
        # a touched group without rows left is written as unknown
        same = [F.col(f"g.`{k}`").eqNullSafe(F.col(f"w.`{k}`")) for k in self.keys]
        groups = touched.alias("g").join(now.alias("w"), same, "left").select(
            *[F.col(f"g.`{k}`").alias(k) for k in self.keys], F.coalesce("w.__known", F.lit(False)).alias("__known"),
            *[F.col(f"w.`{n}`").alias(n) for n in self.anew])
        self._write(batch_id, sums, groups, top)

    def refresh(self, max_files_per_trigger: int | None = None) -> None:
        """Takes in all changes that have come; a later call, or one after a failure,
        goes on from the checkpoint (a repeated batch replaces itself)."""
        q = (self.table.changes_stream(max_files_per_trigger).writeStream.foreachBatch(self._take)
             .option("checkpointLocation", f"{self.root}/_checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
        if q.exception():
            raise q.exception()

    def read(self) -> DataFrame:
        sums = self.spark.read.parquet(f"{self.root}/sums")
        cols = []
        for n, (fn, c) in self.added.items():
            count, total = F.sum(f"{n}__n"), F.sum(f"{n}__s") if fn != "count" else None
            cols.append((count if fn == "count" else F.when(count > 0, total if fn == "sum" else total / count)).alias(n))
        out = sums.groupBy(*self.keys).agg(F.sum("__rows").alias("__rows"), *cols).filter("__rows > 0")
        if self.anew:
            names = ["__known", *self.anew]
            last = (self.spark.read.parquet(f"{self.root}/groups").groupBy(*self.keys)
                    .agg(F.max_by(F.struct(*names), F.struct("__version", "batch")).alias("x")))
            mine = [F.col(f"s.`{k}`").eqNullSafe(F.col(f"g.`{k}`")) for k in self.keys]
            out = out.alias("s").join(last.alias("g"), mine, "left").select(
                "s.*", *[F.col(f"g.x.`{n}`").alias(n) for n in self.anew])
        return out.select(*self.keys, *self.measures)
