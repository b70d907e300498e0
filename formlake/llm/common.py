"""Shared Spark helpers of the corpus operators: inputs, staged tables, components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a fresh local one if unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named:
        named = tempfile.mkdtemp(prefix="corpus-shared-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to a fresh Parquet table in the shared folder and read it back.

    This cuts the lineage: later jobs read files every executor can reach, so a lost
    executor costs only its running tasks.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/corpus-{label}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.staged_path = path
    return out


def delete_staged(*tables: DataFrame) -> None:
    """Delete staged tables that no later job reads, so a long job holds on disk what it still needs."""
    for df in tables:
        context = df.sparkSession.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(df.staged_path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def hash_sample(df: DataFrame, rows: int, key: str = "doc_id") -> DataFrame:
    """About ``rows`` rows, chosen by a hash of ``key`` (all, if there are no more)."""
    share = min(1.0, rows / max(1, df.count()))
    return df if share == 1.0 else df.filter(F.pmod(F.xxhash64(F.lit(17), key), F.lit(1_000_000)) < F.lit(int(share * 1_000_000)))


ROUND_ROWS = 50_000  # rows of a written file of a round, at least


def staged_round(df: DataFrame, label: str, rows: int | None = None) -> tuple[DataFrame, tuple[int, int]]:
    """A two-column table, ``staged``, and its (rows, order-free checksum), observed while it is written.

    ``rows`` is about how many there will be: a few rows are written by a few tasks.
    """
    seen = Observation(label)
    if rows is not None:
        df = df.coalesce(min(shuffle_tasks(df.sparkSession), 1 + rows // ROUND_ROWS))
    out = staged(df.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*df.columns).cast("decimal(38,0)")).alias("sum")), label)
    return out, (int(seen.get["n"] or 0), int(seen.get["sum"] or 0))


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of an undirected graph: (id, component = smallest id).

    ``edges`` has two columns of ids; nodes without an edge are not listed. Alternating
    large-star and small-star rounds: each is a minimum per node (partial aggregates first)
    and a join back, so no node's neighbours are gathered in one place. Every round is written
    to the shared folder; rounds stop when one changes nothing.
    """
    a, b = edges.columns
    pairs = edges.filter(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    now, before = staged_round(pairs, f"{label}-edges")
    while before[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(low, "u")
        star = joined.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.toDF("u", "v"))
        now, after = staged_round(star.distinct(), f"{label}-round", before[0])
        if after == before:
            break
        before = after
    return now.toDF("id", "component").unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())
