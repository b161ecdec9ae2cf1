"""Tables that grow together by batches: a batch is seen in all of them or in none.

A batch writes its rows below ``<table>/batch=<name>`` of each table and then renames one small file to
``commits/<name>.json``; readers join the tables with the commits, so what a broken run left behind is never seen, and a
batch that runs again overwrites its own folders. A commit may name batches that it replaces, so that many small batches
are merged by one more commit.
"""

from __future__ import annotations

import json
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.operators.observed import FEW, small, written

_COMMIT = "batch string, ts timestamp, replaces array<string>, buckets array<int>"


class CommitLog:
    """``tables``: a schema for each name. ``keyed``: for some of them a key column and a number of buckets, by which their
    files are laid out, so that :meth:`known` reads only the buckets of the rows that it is asked about."""

    def __init__(self, spark: SparkSession, root: str, tables: dict[str, str], keyed: dict[str, tuple[str, int]] | None = None):
        self.spark, self.root, self.tables, self.keyed = spark, root.rstrip("/"), tables, keyed or {}

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def fs(self, name: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
        return at.getFileSystem(self.spark._jsc.hadoopConfiguration()), at

    def exists(self, name: str) -> bool:
        fs, at = self.fs(name)
        return fs.exists(at)

    def delete(self, name: str) -> None:
        fs, at = self.fs(name)
        fs.delete(at, True)

    def commits(self) -> DataFrame:
        """``batch, ts, replaces, buckets`` of what has been published."""
        return self.spark.read.schema(_COMMIT).json(self.path("commits")) if self.exists("commits") else self.spark.createDataFrame([], _COMMIT)

    def live(self) -> DataFrame:
        """``batch`` of what readers see."""
        found = self.commits()
        return found.select("batch").join(found.select(F.explode("replaces").alias("batch")), "batch", "left_anti")

    def published(self, batch: str) -> bool:
        return self.exists(f"commits/{batch}.json")

    def _bucket(self, name: str):
        key, n = self.keyed[name]
        return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")

    def write(self, batch: str, name: str, rows: DataFrame, **counts) -> tuple[DataFrame, dict[str, int]]:  # noqa: ANN003
        """A batch's rows of one table, not yet seen by readers; returns them as written, with observed counts."""
        columns = [c.split()[0] for c in self.tables[name].split(", ")]
        rows, path = rows.select(*columns), self.path(f"{name}/batch={batch}")
        if name not in self.keyed:
            return written(rows, path, **counts)
        dealt = rows.withColumn("bucket", self._bucket(name))
        dealt.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(path)
        return self.spark.read.schema(self.tables[name]).parquet(path), {}

    def publish(self, batch: str, replaces: tuple[str, ...] | list[str] = (), buckets: tuple[int, ...] | list[int] = ()) -> None:
        """Makes a batch seen. The rename is the commit: before it nothing of the batch counts, after it all does."""
        if self.published(batch):
            return
        fs, at = self.fs(f"commits/{batch}.json")
        _, part = self.fs(f"commits/.{batch}.part")
        out = fs.create(part, True)
        out.write(bytearray(json.dumps({"batch": batch, "ts": datetime.now(UTC).isoformat(), "replaces": list(replaces), "buckets": list(buckets)}).encode()))
        out.close()
        if not fs.rename(part, at) and not self.published(batch):
            raise OSError(f"{at}: the commit could not be renamed into place")

    def commit(self, batch: str, rows: dict[str, DataFrame]) -> None:
        """Rows of several tables at once."""
        for name, df in rows.items():
            self.write(batch, name, df)
        self.publish(batch)

    def _all(self, name: str, more: str = "") -> DataFrame:
        extra = ", batch string" + (", bucket int" if name in self.keyed else more)
        if not self.exists(name):
            return self.spark.createDataFrame([], self.tables[name] + extra)
        return self.spark.read.schema(self.tables[name] + extra).option("basePath", self.path(name)).parquet(self.path(name))

    def table(self, name: str) -> DataFrame:
        """What has been committed. The names of batches are joined, not collected; Spark prunes folders by them."""
        found = self._all(name).join(self.live(), "batch", "left_semi")
        return found.select(*[c.split()[0] for c in self.tables[name].split(", ")])

    def known(self, name: str, rows: DataFrame, key: str) -> DataFrame:
        """``rows`` (of a written table) whose ``key`` a keyed table has. Only the buckets of these keys are read: their
        numbers, at most as many as there are buckets, prune folders. Of these, only rows with one of the keys are shuffled
        if the keys are few: a batch then costs no more as the table grows, but for the reading."""
        column, n = self.keyed[name]
        keys = rows.where(F.col(key).isNotNull()).select(F.col(key).alias("__asked"))
        mine = {r.bucket: r["count"] for r in keys.groupBy(F.pmod(F.xxhash64("__asked"), F.lit(n)).cast("int").alias("bucket")).count().collect()}
        held = self._all(name).where(F.col("bucket").isin(list(mine))).join(self.live(), "batch", "left_semi").select(F.col(column).alias("__known"))
        if (total := sum(mine.values())) <= FEW:
            held = held.join(small(keys, total), F.col("__known") == F.col("__asked"), "left_semi")
        return rows.join(held.distinct(), rows[key] == F.col("__known"), "left_semi")

    def compact(self) -> str | None:
        """Merges all live batches into one, which replaces them; returns its name, or None where there is nothing to
        merge. Readers see the old ones until the new commit; :meth:`vacuum` takes them away."""
        old = self.live()
        names = [r.batch for r in old.limit(10_000).collect()]  # so many in one go; the next call merges the others
        if len(names) < 2:
            return None
        batch = f"merged-{datetime.now(UTC):%Y%m%dT%H%M%S%f}"
        some = self.spark.createDataFrame([(x,) for x in names], "batch string")
        for name in self.tables:
            if self.exists(name):
                self.write(batch, name, self._all(name).join(some, "batch", "left_semi"))
        self.publish(batch, names)
        return batch

    def vacuum(self) -> int:
        """Deletes the folders of batches that no reader sees; not while a run writes. Returns how many."""
        live, n = {r.batch for r in self.live().toLocalIterator()}, 0
        for name in self.tables:
            if self.exists(name):
                fs, at = self.fs(name)
                for s in fs.listStatus(at):
                    batch = s.getPath().getName().partition("=")[2]
                    if batch and batch not in live:
                        fs.delete(s.getPath(), True)
                        n += 1
        return n

    def reserve(self, prefix: str, owner: str) -> str:
        """The next free number behind ``prefix``: a file is created only where there is none, so two runs never get one.
        A number that the same owner left open, without :meth:`close`, is taken up again."""
        fs, folder = self.fs("ids")
        found = [s.getPath() for s in fs.listStatus(folder)] if fs.exists(folder) else []
        taken = {p.getName(): p for p in found}
        for name in sorted(taken):
            number, _, kind = name.rpartition(".")
            if kind == owner and number.startswith(prefix) and f"{number}.closed" not in taken:
                return number
        n = 1 + max((int(name.partition(".")[0][len(prefix) :]) for name in taken if name.startswith(prefix)), default=0)
        while True:
            number = f"{prefix}{n:03d}"
            _, claim = self.fs(f"ids/{number}.claim")
            if fs.createNewFile(claim):
                fs.createNewFile(self.fs(f"ids/{number}.{owner}")[1])
                return number
            n += 1

    def close(self, number: str) -> None:
        fs, at = self.fs(f"ids/{number}.closed")
        fs.createNewFile(at)


class KeyedTable:
    """A table with one row for each key, kept in hash buckets: an upsert writes the buckets of its keys anew, beside the
    old ones, and a commit makes them the current ones all at once. Cost follows the buckets that are touched and not the
    table; readers see the table before the upsert or after it. One writer at a time."""

    def __init__(self, spark: SparkSession, root: str, schema: str, key: str, buckets: int = 256):
        self.spark, self.key, self.n, self.schema = spark, key, buckets, schema
        self.columns = [c.split()[0] for c in schema.split(", ")]
        self.log = CommitLog(spark, root, {"rows": schema})

    def _bucket(self):
        return F.pmod(F.xxhash64(self.key), F.lit(self.n)).cast("int")

    def _current(self, some: list[int] | None = None) -> DataFrame:
        """Rows with their bucket, of each bucket as the last commit that wrote it has them. Names of batches ascend."""
        held = self.log._all("rows", ", bucket int")
        last = self.log.commits().select("batch", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.max("batch").alias("batch"))
        if some is not None:
            held, last = (x.where(F.col("bucket").isin(some)) for x in (held, last))
        return held.join(last, ["batch", "bucket"], "left_semi")

    def table(self) -> DataFrame:
        return self._current().select(*self.columns)

    def upsert(self, rows: DataFrame) -> list[int]:
        """Puts in or replaces rows by key; of several rows of a key any one stays, null keys are refused. Returns the
        buckets that were written, of which there are at most as many as the table has."""
        batch = f"{datetime.now(UTC):%Y%m%dT%H%M%S%f}"
        new, counts = written(rows.select(*self.columns, self._bucket().alias("bucket")), self.log.path(f"staging/{batch}"), nulls=F.count_if(F.col(self.key).isNull()))
        if counts["nulls"]:
            raise ValueError(f"{counts['nulls']} rows without {self.key}")
        some = sorted(r.bucket for r in new.select("bucket").distinct().collect())
        if some:
            one = new.dropDuplicates([self.key])
            old = self._current(some).select(*self.columns, "bucket").join(one.select(self.key), self.key, "left_anti")
            merged = one.unionByName(old).repartition(min(len(some), self.n), "bucket")
            merged.write.mode("overwrite").partitionBy("bucket").parquet(self.log.path(f"rows/batch={batch}"))
            self.log.publish(batch, buckets=some)
        self.log.delete(f"staging/{batch}")
        return some

    def vacuum(self) -> int:
        """Deletes batches of which no bucket is current, but for the last two; returns how many."""
        last = self.log.commits().select("batch", F.explode("buckets").alias("bucket")).groupBy("bucket").agg(F.max("batch").alias("batch"))
        live = {r.batch for r in last.select("batch").distinct().toLocalIterator()}
        fs, at = self.log.fs("rows")
        names = sorted(s.getPath().getName().partition("=")[2] for s in fs.listStatus(at)) if self.log.exists("rows") else []
        gone = [x for x in names[:-2] if x and x not in live]
        for x in gone:
            self.log.delete(f"rows/batch={x}")
        return len(gone)
