"""Sums over the subtrees of a forest whose nodes are rows."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Far more rounds than a tree of as many nodes as fit a cluster takes.
_MOST_ROUNDS = 400


def subtree_sums(nodes: DataFrame, amounts: Sequence[str]) -> DataFrame:
    """The sum of each amount over each node and all nodes below it.

    ``nodes`` has a unique key, the key of the parent (NULL at a root) and whole
    numbers. Returns key and the sums, one row per node; other columns are left
    out. No nodes give an empty table. Nodes on a cycle, or whose parent is
    missing, are an error.

    A round rakes all leaves, whose sums are then known, into their parents, and
    compresses chains: a node with one child is taken out if a coin that depends
    on its key and the round says so and its child stays; its child then hangs
    from its parent and owes it the difference. Each round takes out all leaves
    and a part of every chain, so the rounds grow with the logarithm of the
    nodes, also for a single chain. Nodes taken out are put back in the opposite
    order: their sum is that of their child and what was noted. Every join is on
    keys that are unique on both sides; amounts meet at a parent after partial
    sums.
    """
    owed = [f"owed_{k}" for k in range(len(amounts))]
    own = [f"own_{k}" for k in range(len(amounts))]
    tree = nodes.select(
        "key", "parent", *(F.col(c).alias(o) for c, o in zip(amounts, own, strict=True)), *(F.lit(0).cast("long").alias(o) for o in owed)
    )
    known: list[list[DataFrame]] = []  # sums by the step in which their nodes went
    taken: list[DataFrame] = []
    before = -1
    for step in range(_MOST_ROUNDS):
        below = tree.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key")).agg(F.count("*").alias("children"))
        counted = tree.join(below, "key", "left").withColumn("children", F.coalesce("children", F.lit(0)))
        counted = written(counted, "contracted")
        leaves, live = counted.where("children = 0"), counted.where("children > 0")
        known.append([leaves.select("key", *own)])
        left = live.count()
        if left == 0:
            break
        if left == before:
            raise ValueError("the parents do not make a forest")
        before = left

        alone = live.where("children = 1 AND parent IS NOT NULL").where(_coin(F.col("key"), step))
        child = live.where(~((F.col("children") == 1) & _coin(F.col("key"), step)))
        child = child.select(F.col("key").alias("child"), F.col("parent").alias("key"), *(F.col(o).alias(f"{o}_child") for o in owed))
        out = alone.join(child, "key").select(
            "key",
            "child",
            "parent",
            *((F.col(o) + F.col(f"{d}_child")).alias(o) for o, d in zip(own, owed, strict=True)),
            *((F.col(d) + F.col(o) + F.col(f"{d}_child")).alias(d) for o, d in zip(own, owed, strict=True)),
        )
        out = written(out, "compressed")
        taken.append(out.select("key", "child", *own))

        raked = leaves.where("parent IS NOT NULL").groupBy(F.col("parent").alias("key"))
        raked = raked.agg(*(F.sum(F.col(o) + F.col(d)).alias(f"{o}_raked") for o, d in zip(own, owed, strict=True)))
        moved = out.select(F.col("child").alias("key"), F.col("parent").alias("up"), *(F.col(d).alias(f"{d}_up") for d in owed))
        tree = live.join(out.select("key"), "key", "left_anti").join(raked, "key", "left").join(moved, "key", "left")
        tree = tree.select(
            "key",
            F.when(F.col("up").isNotNull(), F.col("up")).otherwise(F.col("parent")).alias("parent"),
            *((F.col(o) + F.coalesce(f"{o}_raked", F.lit(0))).alias(o) for o in own),
            *(F.coalesce(f"{d}_up", d).alias(d) for d in owed),
        )
    else:
        raise RuntimeError("the tree did not contract")

    for step in reversed(range(len(taken))):
        # a child went later than its parent, and with every step fewer nodes are left
        sums = _union([part for parts in known[step + 1 :] for part in parts])
        sums = sums.select(F.col("key").alias("child"), *(F.col(o).alias(f"{o}_child") for o in own))
        back = taken[step].join(sums, "child")
        back = back.select("key", *((F.col(o) + F.col(f"{o}_child")).alias(o) for o in own))
        known[step].append(written(back, "expanded"))
    sums = _union([part for parts in known for part in parts])
    return sums.select("key", *(F.col(o).alias(c) for c, o in zip(amounts, own, strict=True)))


def _union(parts: list[DataFrame]) -> DataFrame:
    whole = parts[0]
    for more in parts[1:]:
        whole = whole.unionByName(more)
    return whole


def _coin(key: Column, step: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(step)), F.lit(2)) == 0
