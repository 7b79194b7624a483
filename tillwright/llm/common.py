"""What the operators share: tables in shared storage, row keys, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillwright.session import scratch_folder


def settle(df: DataFrame, label: str, by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to shared storage and read it back; ``by`` names columns of folders.

    Later steps start from the files, so a lost executor costs them a reread and
    never the work before it.
    """
    spark = df.sparkSession
    path = scratch_folder(spark, label)
    df.write.partitionBy(*by or []).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# A row is known by its id and the hash of its text: ids may be null or repeated.
ROW_KEY = ["_id", "_text_hash"]


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """Two columns, never null, that tell rows apart.

    Rows with the same id and text get the same key; whatever is decided for one
    holds for the other.
    """
    return [
        F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("_id"),
        F.xxhash64(F.col(doc_id).isNull(), F.col(text).isNull(), F.col(text)).alias("_text_hash"),
    ]


def _by_node(rows: DataFrame, least: DataFrame) -> DataFrame:
    # The least neighbours are dealt anew, so that both sides of the join are plain
    # shuffles and the adaptive skew join can split a node with very many edges.
    return rows.join(least.hint("rebalance"), "u")


def _spread_large(edges: DataFrame) -> DataFrame:
    """Tie the larger neighbours of each node to its least neighbour."""
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("w")).select(
        "u", F.least("u", "w").alias("w")
    )
    return (
        _by_node(both.where("v > u"), least)
        .select(F.col("v").alias("u"), F.col("w").alias("v"))
        .where("u != v")
        .distinct()
    )


def _spread_small(edges: DataFrame) -> DataFrame:
    """Tie each node and its smaller neighbours to the least of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("w"))
    tied = _by_node(edges, least).select(F.col("v").alias("u"), F.col("w").alias("v"))
    return tied.union(least.select("u", F.col("w").alias("v"))).where("u != v").distinct()


def components(edges: DataFrame, label: str, a: str = "a", b: str = "b") -> DataFrame:
    """``(node, root)`` of every node on an edge; the root is its component's least node.

    Two steps alternate until nothing changes: each node ties its larger
    neighbours, then its smaller ones, to the least node it knows. Every round is
    a few shuffles of the edges, written to shared storage, and the number of
    rounds grows with the logarithm of the longest path. Nothing is collected but
    a count and a checksum per round. Null ends and loops are left out.
    """
    current = settle(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .distinct(),
        label,
    )
    mark = None
    while True:
        seen = current.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("u", "v").cast("decimal(20,0)")).alias("mark"),
        ).first()
        if seen == mark or seen.n == 0:
            break
        mark = seen
        current = settle(_spread_small(_spread_large(current)), label)
    tied = current.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return tied.union(current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
