"""Tables that several writers may add to: append-only (K6), and with a
unique key (K7, R9).

Layout under ``path``::

    data/_commit=<token>/_b=<bucket>/   rows, dealt out by the key's hash
    bloom/_commit=<token>/              (_b, word, bits): Bloom words of the keys
    commits/<n>.json                    one small file per commit, in order

A batch looks its keys up in the Bloom words of their buckets and reads only
the buckets and commits that may hold one, key column alone.  What it adds is
written first and becomes visible by its commit file, which is put in place
atomically and never over another one.  A writer that finds its number taken
looks again at what the other has added and tries the next number, so two
writers cannot both insert a key.  A batch that names its writer and number is
inserted once, however often it is retried.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablekit.sources.sinks import insert_or_ignore


def put_if_absent(spark: SparkSession, path: str, body: str) -> bool:
    """Write a small file unless there is one: whole, or not at all."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    fs = target.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(target.getParent())
    temp = jvm.org.apache.hadoop.fs.Path(target.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(temp, False)
    out.write(bytearray(body.encode()))
    out.close()
    try:
        if fs.getScheme() == "file":
            # rename replaces files on local disks; a link never does
            def local(p):
                return jvm.java.nio.file.Path.of(fs.makeQualified(p).toUri())
            jvm.java.nio.file.Files.createLink(local(target), local(temp))
        else:
            none = spark.sparkContext._gateway.new_array(
                getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(
                target.toUri(), spark._jsc.hadoopConfiguration()).rename(temp, target, none)
        return True
    except Exception as e:  # py4j wraps what the file system throws
        if "FileAlreadyExists" in str(e):
            return False
        raise
    finally:
        fs.delete(temp, False)


class CommittedTable:
    """Rows in ``data/_commit=<token>``, visible once a commit names the token."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def commits(self) -> list[dict]:
        """Commits in order: number, token, writer, batch, rows, last id."""
        jvm = self.spark._jvm
        files = jvm.org.apache.hadoop.fs.Path(f"{self.path}/commits/*.json")
        fs = files.getFileSystem(self.spark._jsc.hadoopConfiguration())
        # the folder is there before the first commit of another writer is
        if not fs.globStatus(files):
            return []
        rows = self.spark.read.schema(
            "n long, token string, writer string, batch long, rows long, last_id long").json(
            f"{self.path}/commits/*.json").orderBy("n").collect()
        return [r.asDict() for r in rows]

    def read(self, commits: list[dict] | None = None) -> DataFrame | None:
        """All committed rows, with ``_commit``; None before the first commit
        with rows."""
        tokens = [c["token"] for c in (self.commits() if commits is None else commits) if c["rows"]]
        if not tokens:
            return None
        paths = [f"{self.path}/data/_commit={t}" for t in tokens]
        return self.spark.read.option("basePath", f"{self.path}/data").parquet(*paths)

    def _put(self, commit: dict) -> bool:
        return put_if_absent(self.spark, f"{self.path}/commits/{commit['n']:012d}.json", json.dumps(commit))


class AppendLog(CommittedTable):
    """Append-only table (registry, deployments): an append is there whole or
    not at all, and appends of several writers are put in one order."""

    def append(self, df: DataFrame) -> dict:
        token = uuid.uuid4().hex
        df.write.parquet(f"{self.path}/data/_commit={token}")
        n = self.spark.read.schema(df.schema).parquet(f"{self.path}/data/_commit={token}").count()
        commits = self.commits()
        commit = {"n": len(commits), "token": token, "rows": n}
        while True:  # only the number is contended; the rows are written once
            commit["n"] += 1
            if self._put(commit):
                return commit


class UniqueTable(CommittedTable):
    """``key``: the unique column; ``order``: columns that say which row of a
    batch comes first (and number new rows in ``id``)."""

    def __init__(self, spark: SparkSession, path: str, key: str, order: list[str], buckets: int = 256,
                 bloom_log2: int = 17):
        super().__init__(spark, path)
        self.key, self.order = key, order
        self.buckets, self.bloom_log2 = buckets, bloom_log2

    # ------------------------------------------------------------ lookups
    def _bucket(self, *spread: str) -> Column:
        """The key's bucket; null keys spread by other columns."""
        h = F.xxhash64(self.key)
        if spread:
            h = F.when(F.col(self.key).isNull(), F.xxhash64(*spread)).otherwise(h)
        return F.pmod(h, F.lit(self.buckets)).cast("int").alias("_b")

    def _places(self, keys: DataFrame) -> DataFrame:
        """(_b, key, word, bit): three Bloom bits of each key."""
        bits = F.array(*[F.pmod(F.xxhash64(self.key, F.lit(i)), F.lit(1 << self.bloom_log2)) for i in range(3)])
        return (keys.filter(F.col(self.key).isNotNull())
                .select(self.key, self._bucket(), F.explode(F.array_distinct(bits)).alias("at"))
                .select("_b", self.key, F.shiftright("at", 6).alias("word"),
                        F.expr("shiftleft(1L, cast(at % 64 as int))").alias("bit")))

    def stored(self, batch: DataFrame, commits: list[dict]) -> DataFrame | None:
        """(key) of the committed rows that a row of ``batch`` may collide
        with.  At most ``buckets`` numbers and one token a commit reach the
        driver; they prune the scan to those folders."""
        tokens = [c["token"] for c in commits if c["rows"]]
        if not tokens:
            return None
        bloom = (self.spark.read.option("basePath", f"{self.path}/bloom")
                 .parquet(*[f"{self.path}/bloom/_commit={t}" for t in tokens]))
        hit = (self._places(batch.select(self.key).distinct())
               .withColumn("of", F.count(F.lit(1)).over(Window.partitionBy(self.key)))
               .join(bloom, ["_b", "word"]).filter(F.col("bits").bitwiseAND(F.col("bit")) != 0)
               .groupBy("_commit", "_b", self.key, "of").agg(F.count(F.lit(1)).alias("n"))
               .filter("n = of").select("_commit", "_b").distinct())
        r = hit.agg(F.collect_set("_commit").alias("c"), F.collect_set("_b").alias("b")).first()
        if not r["c"]:
            return None
        return (self.read([c for c in commits if c["token"] in set(r["c"])])
                .filter(F.col("_b").isin(r["b"])).select(self.key))

    # ------------------------------------------------------------ inserts
    def insert(self, batch: DataFrame, writer: str | None = None, number: int | None = None) -> dict:
        """Insert the rows of ``batch`` whose key is new, the first of each
        key; null keys never collide.  Returns the commit."""
        from tablekit.operators.splits import group_rank
        while True:
            commits = self.commits()
            done = [c for c in commits if writer is not None and (c["writer"], c["batch"]) == (writer, number)]
            if done:
                return done[0]
            stored = self.stored(batch, commits)
            if stored is None:
                stored = batch.select(self.key).limit(0)
            new = insert_or_ignore(stored, batch, self.key, self.order, id_col=None)
            base = commits[-1]["last_id"] if commits else 0
            ranked = group_rank(new, self.order, name="id").withColumn("id", F.col("id").cast("long") + base)
            token = uuid.uuid4().hex
            data = f"{self.path}/data/_commit={token}"
            ranked.withColumn("_b", self._bucket(*self.order)).repartition("_b").write.partitionBy("_b").parquet(data)
            n = 0
            if self._has_files(data):
                back = self.spark.read.parquet(data)
                n = back.count()
                (self._places(back).groupBy("_b", "word").agg(F.bit_or("bit").alias("bits"))
                 .repartition("_b").sortWithinPartitions("_b", "word")
                 .write.parquet(f"{self.path}/bloom/_commit={token}"))
            commit = {"n": len(commits) + 1, "token": token, "writer": writer, "batch": number, "rows": n,
                      "last_id": base + n}
            if self._put(commit):
                return commit

    def _has_files(self, path: str) -> bool:
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return any(not s.getPath().getName().startswith("_SUCCESS") for s in fs.listStatus(p)
                   if not s.getPath().getName().startswith("."))
