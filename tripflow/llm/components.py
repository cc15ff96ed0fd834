"""Connected components of an edge table by alternating star operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.llm.common import stored


def connected_components(edges: DataFrame, label: str = "components") -> DataFrame:
    """Smallest node reachable from each node that has an edge: (node, component).

    ``edges`` has two columns of longs. The large star links each node's larger
    neighbours to the smallest node around; the small star does the same for
    the smaller ones (Kiveris et al. 2014). The rounds needed grow with the
    logarithm of the largest component; each is stored in the shared folder.
    """
    a, b = edges.columns
    pairs = edges.select(F.greatest(a, b).alias("node"), F.least(a, b).alias("other"))
    pairs = stored(pairs.filter("node <> other").distinct(), label)
    # Pairs are distinct, so none cancels another; unlike a sum, this has no largest table.
    print_of = (F.count(F.lit(1)), F.bit_xor(F.xxhash64("node", "other")))
    last = pairs.agg(*print_of).first()
    while True:
        pairs = stored(_large_star(pairs, label), f"{label}-large")
        pairs = stored(_small_star(pairs, label), f"{label}-small")
        now = pairs.agg(*print_of).first()
        if now == last:
            break
        last = now
    roots = pairs.select(F.col("other").alias("node")).distinct()
    return pairs.select("node", F.col("other").alias("component")).union(
        roots.select("node", F.col("node").alias("component"))
    )


def _large_star(pairs: DataFrame, label: str) -> DataFrame:
    """Minima are combined before the shuffle and stored, so that the join has
    two plain sides and Spark can split the partition of a hub.
    """
    both = pairs.union(pairs.select(F.col("other").alias("node"), F.col("node").alias("other")))
    least = both.groupBy("node").agg(F.least(F.min("other"), F.col("node")).alias("least"))
    least = stored(least, f"{label}-least")
    return (
        both.filter("other > node")
        .join(least, "node")
        .select(F.col("other").alias("node"), F.col("least").alias("other"))
        .distinct()
    )


def _small_star(pairs: DataFrame, label: str) -> DataFrame:
    """Here every pair already has its larger node first."""
    least = stored(pairs.groupBy("node").agg(F.min("other").alias("least")), f"{label}-least")
    moved = pairs.join(least, "node").select(
        F.col("other").alias("node"), F.col("least").alias("other")
    )
    return moved.union(least.select("node", F.col("least").alias("other"))).filter(
        "node <> other"
    ).distinct()
