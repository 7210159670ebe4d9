"""Connected components of a distributed edge list by contraction towards smaller neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lociforge.llm.storage import materialize, release


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """``(node, label)`` for every node of ``edges``; label is the smallest node reachable, itself included.

    Each round every node moves to its smallest neighbour (or stays) and the graph is contracted: parallel edges fold,
    inner edges go.  Rounds are logarithmic in practice; a round is two joins and two aggregations with map-side
    combining, written to the shared folder.  A hub costs one partially aggregated key, never a collected group.
    Null ends, loops and repeated edges are ignored; an empty edge list gives an empty table.
    """
    both = edges.select(F.col(src).cast("long").alias("a"), F.col(dst).cast("long").alias("b")).where("a <> b")
    live = materialize(both.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
    labels = None
    while not live.isEmpty():
        either = live.select("a", "b").unionAll(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        step = materialize(either.groupBy(F.col("a").alias("at")).agg(F.least(F.min("b"), F.first("a")).alias("to")), "cc-step")
        if labels is None:
            grown = step.select(F.col("at").alias("node"), F.col("to").alias("label"))
        else:
            grown = labels.join(step, labels.label == step["at"], "left").select("node", F.coalesce("to", "label").alias("label"))
        grown = materialize(grown, "cc-labels")
        ends = live.join(step, live.a == step["at"]).select(F.col("to").alias("a"), "b")
        ends = ends.join(step, ends.b == step["at"]).select("a", F.col("to").alias("b")).where("a <> b")
        fewer = materialize(ends.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-edges")
        for old in (live, step, labels):
            if old is not None:
                release(old)
        live, labels = fewer, grown
    if labels is None:
        return live.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return labels
