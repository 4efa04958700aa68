"""Connected components of links between nodes, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from isotherm.llm.frames import stored


def _least(links: DataFrame) -> DataFrame:
    """Least neighbour of each node ``a``, combined on the map side."""
    return links.groupBy("a").agg(F.min("b").alias("least"))


def _stars(links: DataFrame) -> DataFrame:
    """One round over links with a > b: each node ties its neighbours to the least node it knows."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    known = both.join(_least(both), "a")
    large = known.where("b > a").select(F.col("b").alias("a"), F.least("a", "least").alias("b")).distinct()
    known = large.join(_least(large), "a")
    small = known.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(known.select("a", F.col("least").alias("b")))
    return small.where("a <> b").distinct()


def connected(links: DataFrame) -> DataFrame:
    """``a, b``: each node of ``links`` (``a, b``) but the least of its component, with that least one.

    Every round is written to the shared folder; the number of rounds grows with
    the logarithm of the longest chain. The driver gets a count and a checksum.
    """
    ordered = links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    state, seen = stored(ordered, "links"), None
    while True:
        mark = state.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen or not mark[0]:
            return state
        seen = mark
        state = stored(_stars(state), "links")
