"""Connected components of an edge table by alternating star contractions.

Each round rewires every node to the least neighbour of itself or of its neighbours (large star, then
small star), which halves path lengths, so rounds grow with the logarithm of the diameter. Edges and
labels stay distributed; every round is written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from textloom.storage import discard, materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One contraction. ``edges`` holds (u, v), u <> v. Least neighbours come from a grouped aggregate
    joined back, not from collected neighbour lists, so a hub of any degree stays spread over tasks."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if large:
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        hop = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        down = both.where("v < u")
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        hop = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        hop = hop.union(least.select("u", F.col("m").alias("v")))
    return hop.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node in ``edges``; component = least node id of the component.

    Null ends and self loops are dropped, repeated edges count once, an empty table gives an empty
    table. Fails loudly if ``max_rounds`` do not suffice; never returns a partial answer.
    """
    cur = materialize(
        edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
        .select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .distinct(),
        "cc",
    )
    seen = None
    for _ in range(max_rounds):
        nxt = materialize(_star(_star(cur, True), False), "cc")
        stamp = nxt.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        discard(cur)
        cur = nxt
        if seen == stamp:
            roots = cur.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return cur.select(F.col("u").alias("node"), F.col("v").alias("component")).union(roots)
        seen = stamp
    raise RuntimeError(f"components not stable after {max_rounds} rounds")


def linked_groups(buckets: DataFrame, verify: Callable[[DataFrame], DataFrame], near: Callable[[Column, Column], Column] | None = None) -> DataFrame:
    """(node, component) of all nodes with a link, where any two nodes of a bucket may be linked and ``verify`` tells.

    ``buckets`` holds (bucket, node), nodes in as many buckets as they like; ``verify`` takes pairs (a, b) and keeps the
    linked ones. With ``near`` a column ``sketch`` of ``buckets`` travels along, and pairs whose sketches it
    refuses are not formed. A bucket's members are first tried against its least node only; then what stands in different
    groups of one bucket is tried, the members outside its largest group against all others. So every pair
    of a bucket is either in one group already or tried, and a crowd of like nodes costs as much as it has members,
    not pairs. Buckets of one node, and an empty table, link nothing.
    """
    if near is None:
        buckets, near = buckets.select("bucket", "node", F.lit(0).alias("sketch")), lambda x, y: F.lit(True)
    buckets = buckets.repartition("bucket")  # one exchange, read by the aggregate and by the join
    heads = buckets.groupBy("bucket").agg(F.min(F.struct("node", "sketch")).alias("h"), F.count("*").alias("n")).where("n > 1")
    shared = materialize(buckets.join(heads.select("bucket", F.col("h.node").alias("head"), F.col("h.sketch").alias("head_sketch")), "bucket"), "link-buckets")
    tried = shared.where((F.col("node") > F.col("head")) & near(F.col("sketch"), F.col("head_sketch")))
    first = materialize(verify(tried.select(F.col("head").alias("a"), F.col("node").alias("b")).distinct()).select("a", "b"), "link-first")
    groups = materialize(connected_components(first), "link-groups").select("node", F.col("component").alias("grp"))
    placed = shared.select("bucket", "node", "head", "sketch").join(groups, "node", "left").withColumn("grp", F.coalesce("grp", "node"))
    parts = placed.groupBy("bucket", "grp").agg(F.count("*").alias("n")).groupBy("bucket").agg(F.count("*").alias("parts"), F.max_by("grp", F.struct("n", "grp")).alias("main"))
    mixed = materialize(placed.join(parts.where("parts > 1").select("bucket", "main"), "bucket"), "link-mixed")
    # two nodes outside the main group meet twice, in both orders; pairs with the head have been tried
    x, y = mixed.where("grp <> main AND node <> head").alias("x"), mixed.where("node <> head").alias("y")
    once = (F.col("x.node") < F.col("y.node")) | (F.col("y.grp") == F.col("y.main"))
    apart = x.join(y, (F.col("x.bucket") == F.col("y.bucket")) & (F.col("x.grp") != F.col("y.grp")) & once & near(F.col("x.sketch"), F.col("y.sketch")))
    apart = apart.select(F.least("x.node", "y.node").alias("a"), F.greatest("x.node", "y.node").alias("b")).distinct()
    second = verify(apart).select("a", "b")
    return connected_components(first.union(second))
