"""Helpers shared by the training-data operators: shared scratch tables, row keys, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LOCAL: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a ``local[...]`` master may run without the setting (tests); there a
    temporary folder is used.  On a cluster a missing setting is an error,
    because executors would not see each other's files.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if d:
        return d.rstrip("/")
    master = spark.sparkContext.master
    if not (master.startswith("local[") or master == "local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL:
        _LOCAL[app] = tempfile.mkdtemp(prefix="ledgerline-llm-")
    return _LOCAL[app]


def table_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: later jobs, and retries after a lost executor, read
    the same rows instead of computing them again.
    """
    spark = df.sparkSession
    path = table_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Scratch:
    """Tables written for one piece of work: the shuffle files of each go when it is written, the tables when dropped."""

    CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def __init__(self):
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def written(self, df: DataFrame, name: str) -> DataFrame:
        conf = df.sparkSession.conf
        before = conf.get(self.CLEANUP, None)
        conf.set(self.CLEANUP, "true")
        try:
            path = table_path(df.sparkSession, name)
            df.write.mode("overwrite").parquet(path)
        finally:
            conf.unset(self.CLEANUP) if before is None else conf.set(self.CLEANUP, before)
        table = df.sparkSession.read.schema(df.schema).parquet(path)
        self.paths[id(table)] = table, path
        return table

    def drop(self, *tables: DataFrame) -> None:
        """Delete tables that no later work reads; without any given, all that are left."""
        for table, path in [self.paths.pop(id(t)) for t in tables or [t for t, _ in self.paths.values()]]:
            context = table.sparkSession.sparkContext
            folder = context._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def row_key(id_col: str = "doc_id", text_col: str = "text") -> Column:
    """64-bit key of a row's id and text; rows alike in both share it."""
    return F.xxhash64(F.col(id_col), F.col(text_col))


def components(edges: DataFrame, name: str = "components", max_rounds: int = 60) -> DataFrame:
    """Connected components of an undirected graph by alternating star contraction.

    ``edges`` has columns ``a`` and ``b`` of one orderable type.  Returns
    ``node, root`` with ``root`` the smallest node reachable, for every node on
    an edge between two different nodes.  Each round is two grouped minima and two joins;
    it needs a number of rounds that grows with the logarithm of the longest
    path.  Only a row count and a hash sum reach the driver.
    """
    e = written(edges.where("a is not null and b is not null and a <> b")
                .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), name)

    def state(x: DataFrame):
        r = x.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return r[0], r[1]

    last = state(e)
    if last[0] == 0:
        return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    for _ in range(max_rounds):
        # large star: every larger neighbour of u points to the least of u and its neighbours
        both = e.select("u", "v").unionAll(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .where("u <> v").distinct())
        # small star: u and its smaller neighbours point to the least of them
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionAll(least.select("u", F.col("m").alias("v"))).distinct())
        e = written(small, name)
        now = state(e)
        if now == last:
            break
        last = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.groupBy("u").agg(F.min("v").alias("root")).select(F.col("u").alias("node"), "root")
    return roots.unionAll(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def packed(docs: DataFrame) -> DataFrame:
    """``docs`` as one struct column ``row`` (and its ``doc_id``), so that no caller's column name can clash."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").alias("doc_id"))


def unpacked(columns: list[str], replace: dict[str, Column] | None = None) -> list[Column]:
    """The fields of ``row`` under their own names, some of them replaced."""
    return [(replace or {}).get(c, F.col("row").getField(c)).alias(c) for c in columns]
