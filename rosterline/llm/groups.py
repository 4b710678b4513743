"""Connected groups of items that share a bucket and pass a check, without comparing all pairs.

Only the groups matter, so two members of a bucket have to be compared only while they are in
different groups. A round takes the first few members of every bucket that are outside its
largest group as pivots, compares them with all members of other groups, and joins groups over
the links that were found. A pivot is then done. Buckets of one group drop out, the others go on
with more pivots, until every member outside the largest group has been a pivot: all links that
could join two groups have been looked at, whatever the size of a bucket.

Two members may share many buckets. With ``once`` a pair is made in the smallest of their common
buckets only, whatever the round; every other bucket leaves it to that one.

All tables are written to the shared folder between steps, so that lost executors cost no more
than a step, and joins meet plain shuffles that Spark can split where a bucket is crowded.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rosterline.llm.common import Stored

#: Pivots of a bucket in the first round, and how many times as many in each round after.
FIRST_PIVOTS = 2
MORE_PIVOTS = 4


def crowded(rows: DataFrame) -> DataFrame:
    """Those of ``rows`` (bucket, node and more) that share their bucket with another row."""
    counts = Stored(
        rows.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("bucket"),
        "buckets",
    )
    return rows.join(counts.side(), "bucket", "left_semi")


def shared_sets(rows: DataFrame) -> DataFrame:
    """``bucket`` and ``node`` for each different set of nodes that share a bucket of ``rows``.

    One shuffle of ``rows`` (bucket, node; each once): a bucket's nodes are counted and hashed
    together where they meet, nodes that are alone go, and buckets of equal sets become one.
    """
    held = Window.partitionBy("bucket")
    marked = rows.select(
        "node",
        F.count("*").over(held).alias("n"),
        F.bit_xor(F.xxhash64("node")).over(held).alias("set"),
    )
    return marked.where(F.col("n") > 1).select(
        F.xxhash64("set", "n").alias("bucket"), "node"
    ).distinct()


def components(links: DataFrame) -> Stored:
    """``node`` and ``root``, the smallest node that is reachable, of every node in ``links`` (a, b).

    In turn every node takes the smallest label of its neighbours and then the label of its label,
    which halves the way to go.
    """
    both = Stored(
        links.select(F.col("a").alias("node"), F.col("b").alias("other"))
        .unionByName(links.select(F.col("b").alias("node"), F.col("a").alias("other")))
        .distinct(),
        "links",
    )
    labels = Stored(
        both.df.groupBy("node").agg(F.min("other").alias("least")).select(
            "node", F.least("node", "least").alias("root"), F.lit(True).alias("moved")
        ),
        "labels",
    )
    while True:
        names = labels.df.select(F.col("node").alias("other"), F.col("root").alias("theirs"))
        near = both.df.join(names, "other").groupBy("node").agg(F.min("theirs").alias("near"))
        taken = Stored(
            labels.df.join(near, "node").select(
                "node", F.col("root").alias("old"), F.least("root", "near").alias("root")
            ),
            "labels",
        )
        jump = taken.df.select(F.col("node").alias("root"), F.col("root").alias("further"))
        new = Stored(
            taken.df.join(jump, "root").select(
                "node",
                F.col("further").alias("root"),
                (F.col("further") != F.col("old")).alias("moved"),
            ),
            "labels",
        )
        taken.drop()
        labels.drop()
        labels = new
        if labels.df.where("moved").isEmpty():
            both.drop()
            return labels


def _merged(labels: Stored | None, links: DataFrame) -> Stored:
    """``labels`` after groups have been joined over ``links``: only links between groups count."""
    if labels is None:
        return components(links)
    known = labels.df.select("node", "root")
    for side in "ab":
        ends = known.select(F.col("node").alias(side), F.col("root").alias(f"root_{side}"))
        links = links.join(ends, side, "left")
    between = Stored(
        links.select(F.coalesce("root_a", "a").alias("a"), F.coalesce("root_b", "b").alias("b"))
        .where(F.col("a") != F.col("b"))
        .distinct(),
        "between",
    )
    if between.df.isEmpty():
        between.drop()
        return labels
    top = components(between.df)
    moved = top.df.select(F.col("node").alias("root"), F.col("root").alias("new"))
    old = known.join(moved, "root", "left").select(
        "node", F.coalesce("new", "root").alias("root")
    )
    fresh = top.df.select("node", "root").join(known.select("node"), "node", "left_anti")
    made = Stored(old.unionByName(fresh), "labels")
    for table in (between, top, labels):
        table.drop()
    return made


def _here() -> Column:
    """Whether this bucket is the smallest that both members are in."""
    return F.array_min(F.array_intersect("every", "pivot_every")) == F.col("bucket")


def link_groups(
    rows: DataFrame,
    verify: Callable[[DataFrame], DataFrame],
    once: bool = False,
    shared: bool = False,
) -> DataFrame | None:
    """``node`` and ``root`` of the nodes that have a link; None if there is no link at all.

    ``rows`` has ``bucket``, ``node``, ``rank`` (the order in which members become pivots),
    ``size`` and the sizes, ``low`` to ``high``, that a linked node can have; each bucket and node
    once. ``verify`` gets pairs (a, b), a < b, each once, and keeps those that are linked. ``once``
    is for nodes that are in a few dozen buckets at most, as every row then carries them all.
    ``shared`` says that no node is alone in its bucket.
    """
    members = Stored(rows if shared else crowded(rows), "members")
    if once:
        every = members.df.groupBy("node").agg(F.collect_list("bucket").alias("every"))
        single, members = members, Stored(members.df.join(every, "node"), "members")
        single.drop()
    carried = ["node", "root", "size", "low", "high", *(["every"] if once else [])]
    labels: Stored | None = None
    most = FIRST_PIVOTS
    while not members.df.isEmpty():
        placed = members.df.withColumn("root", F.col("node"))
        if labels is not None:
            roots = labels.df.select("node", F.col("root").alias("known"))
            placed = members.df.join(roots, "node", "left").select(
                *members.df.columns, F.coalesce("known", "node").alias("root")
            )
        placed = Stored(placed, "placed")
        largest = Stored(
            placed.df.groupBy("bucket", "root")
            .agg(F.count("*").alias("n"))
            .groupBy("bucket")
            .agg(
                F.max(F.struct("n", "root")).getField("root").alias("largest"),
                F.count("*").alias("groups"),
            )
            .where(F.col("groups") > 1)
            .select("bucket", "largest"),
            "largest",
        )
        members.drop()
        order = Window.partitionBy("bucket").orderBy("rank", "node")
        pivots = Stored(
            placed.df.join(largest.side(), "bucket")
            .where(F.col("root") != F.col("largest"))
            .withColumn("place", F.row_number().over(order))
            .where(F.col("place") <= most)
            .select(
                "bucket",
                *[F.col(c).alias(f"pivot_{c}") for c in carried],
            ),
            "pivots",
        )
        pairs = (
            placed.df.join(pivots.side(), "bucket")
            .where(F.col("root") != F.col("pivot_root"))
            .where(F.col("size").between(F.col("pivot_low"), F.col("pivot_high")))
            .where(F.col("pivot_size").between(F.col("low"), F.col("high")))
            .where(_here() if once else F.lit(True))
            .select(
                F.least("node", "pivot_node").alias("a"), F.greatest("node", "pivot_node").alias("b")
            )
            .distinct()
        )
        found = Stored(verify(pairs), "links")
        rest = (
            placed.df.join(largest.side(), "bucket", "left_semi")
            .join(
                pivots.side().select("bucket", F.col("pivot_node").alias("node")),
                ["bucket", "node"],
                "left_anti",
            )
            .select(*members.df.columns)
        )
        members = Stored(rest, "members")
        for table in (placed, largest, pivots):
            table.drop()
        if not found.df.isEmpty():
            labels = _merged(labels, found.df)
        found.drop()
        most *= MORE_PIVOTS
    members.drop()
    return None if labels is None else labels.df.select("node", "root")
