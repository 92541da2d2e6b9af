"""Connected components by minimum labels with pointer jumping, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessella.llm.common import BROADCAST_BYTES, HOT, cut

#: Rounds before labels are also followed to their labels: near copies are stars, whose labels settle at once.
PLAIN_ROUNDS = 3


def components(edges: DataFrame, hot: int = HOT) -> DataFrame:
    """(node, root) for every node of the edges (u, v): root is the smallest node of its component.

    Each round takes the smallest label among neighbours, later ones also the label of that label, so that long chains shrink
    exponentially; rounds end when none changes. Labels are cut to the shared folder in every round, only the number
    of changes comes to the driver. No edges give no rows.

    No key is hot: a node of many neighbours has a copy of its label for every `hot` of them, which its edges share out
    among themselves, and the labels that many nodes have are looked up by broadcast. Both are so few that they fit one.
    """
    pairs = edges.select("u", "v").where("u <> v")
    both = cut(pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct())
    # So many neighbours make a hub that all hubs together fit a broadcast.
    hot = max(hot, -(-both.count() * 40 // BROADCAST_BYTES))
    # Edges are counted in their tasks before they are shuffled, so that a hub is a row of each.
    first = both.groupBy("u").agg(F.min("v").alias("least"), F.count(F.lit(1)).alias("degree"))
    labels = cut(first.select(F.col("u").alias("node"), F.least("u", "least").alias("root"), F.ceil(F.col("degree") / F.lit(float(hot))).cast("int").alias("copies")))
    hubs = F.broadcast(labels.where("copies > 1").select(F.col("node").alias("v"), "copies"))
    spread = both.join(hubs, "v", "left").select("u", "v", F.when(F.col("copies").isNull(), F.lit(0)).otherwise(F.pmod(F.xxhash64("u"), F.col("copies"))).cast("int").alias("copy"))
    done = 0
    while True:
        shown = labels.select(F.col("node").alias("v"), F.col("root").alias("seen"), F.explode(F.sequence(F.lit(0), F.col("copies") - 1)).alias("copy"))
        seen = spread.join(shown, ["v", "copy"]).select(F.col("u").alias("node"), "seen", F.lit(None).alias("root"), F.lit(None).cast("int").alias("copies"))
        own = labels.select("node", F.col("root").alias("seen"), "root", "copies")
        after = own.unionByName(seen).groupBy("node").agg(F.min("seen").alias("new"), F.max("root").alias("old"), F.max("copies").alias("copies"))
        after = cut(after if done < PLAIN_ROUNDS else _jumped(cut(after), labels, hot))
        changed = after.where("new <> old").count()
        labels = after.select("node", F.col("new").alias("root"), "copies")
        done += 1
        if not changed:
            return labels.select("node", "root")


def _jumped(after: DataFrame, labels: DataFrame, hot: int) -> DataFrame:
    """Each new label replaced by its own label of the round before."""
    ends = labels.select(F.col("node").alias("new"), F.col("root").alias("far"))
    many = F.broadcast(cut(after.groupBy("new").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > hot).select("new")))
    known = F.broadcast(ends.join(many, "new"))
    end = F.least("new", F.coalesce("far", "new")).alias("new")
    columns = ["node", end, "old", "copies"]
    return after.join(known, "new").select(*columns).unionByName(after.join(many, "new", "left_anti").join(ends.hint("merge"), "new", "left").select(*columns))
