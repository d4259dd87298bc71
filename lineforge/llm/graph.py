"""Links inside buckets of candidates, and connected components, without pairs of whole groups.

``connect`` takes buckets (groups of nodes, each pair of which may be linked) and a test for pairs. To
know who is connected, not every pair of a large group must be tested: in each round a few *centers*
per bucket are tested against the bucket's nodes of other components, what is linked becomes one
component, and only buckets that still hold several components go on, with more centers. In the last
round every node is a center, so every pair of a bucket has been tested or ruled out by a necessary
condition, or was connected already: no link between different components is lost, whatever the bucket's
size, and a group of n nodes that are all linked costs n tests instead of n squared.

Every step is a join or a grouping of written tables; a bucket or component of any size is only ever
aggregated or met by a join that adaptive execution can split.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lineforge.llm.tables import written

# Centers per bucket in the rounds before the last one, in which every node is a center.
CENTERS = (1, 64)

# Up to this many edges, of 16 bytes each, one task takes a step faster than a shuffle is begun.
FEW_EDGES = 100_000


def differing_bits(x: Column, y: Column, words: int) -> Column:
    """In how many places two bitmaps, arrays of ``words`` longs, differ."""
    return reduce(add, [F.bit_count(x[k].bitwiseXOR(y[k])) for k in range(words)])


def _is_done(edges: DataFrame) -> bool:
    """Whether every edge (a, b) leads from a node with no other edge up to a root without one."""
    ends = edges.select(F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("up")), F.struct(F.col("b").alias("node"), F.lit(0).alias("up")))).alias("e"))
    nodes = ends.groupBy("e.node").agg(F.sum("e.up").alias("up"), F.min("e.up").alias("least"))
    return nodes.where("up > 1 or (up = 1 and least = 0)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for all nodes of edges (a, b): root is the component's smallest node. Runs jobs.

    Alternates two steps until all nodes point at roots: all larger neighbours of a node move to its
    smallest neighbour, then all smaller ones do. The number of rounds is logarithmic in the nodes. Steps never
    add edges beyond a constant factor, so ``FEW_EDGES`` at the start stay few and are not dealt out anew.
    """
    now = edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    now = written(now, "edges")
    few = now.count() <= FEW_EDGES

    def kept(df: DataFrame, label: str) -> DataFrame:
        return written(df, label).coalesce(1) if few else written(df, label)

    now = now.coalesce(1) if few else now
    while not _is_done(now):
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low"))
        # Written, so that the join can split a node with very many neighbours.
        lowest = kept(lowest.withColumn("low", F.least("n", "low")), "lowest")
        large = now.join(lowest, F.col("b") == F.col("n")).select("a", F.col("low").alias("b")).where("a <> b").distinct()
        large = kept(large, "edges")
        lowest = large.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("low"))
        small = large.join(lowest, F.col("a") == F.col("n"))
        small = small.select("b", "low").unionAll(small.select("a", "low")).toDF("a", "b")
        now = kept(small.where("a <> b").distinct(), "edges")
    roots = now.select(F.col("b").alias("node")).distinct()
    return now.toDF("node", "root").unionAll(roots.select("node", F.col("node").alias("root")))


def connect(
    members: DataFrame,
    verified: Callable[[DataFrame], DataFrame],
    possible: Callable[[Callable[[str], Column], Callable[[str], Column]], Column],
    first: Column | None = None,
) -> tuple[DataFrame | None, DataFrame | None]:
    """Components (node, root) and links (a, b) of written ``members`` (bucket, node, center, weight, ...).

    ``center`` says whether a node may be the left side of a pair in that bucket; pairs of two nodes
    that may not are no candidates. Centers of small ``weight`` come first. ``possible(x, y)`` is a
    necessary condition on two members' columns, ``verified`` keeps the true links of pairs (a, b).
    ``first`` picks the buckets of an opening round, a few that hold most links, so that later rounds
    find most nodes connected. Both results are None without any link.
    """
    roots = links = tested = None
    carried = [c for c in members.columns if c not in ("bucket", "center")]
    rounds = [(first, CENTERS[0])] * (first is not None) + [(None, n) for n in (*CENTERS, None)]
    for picked, salts in rounds:
        now = members if picked is None else members.where(picked)
        if roots is None:
            now = now.withColumn("root", F.col("node"))
        else:
            now = now.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        several = now.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high")
        now = written(now.join(several.select("bucket"), "bucket", "left_semi"), "members")
        salt = F.col("node") if salts is None else F.pmod(F.xxhash64("node"), F.lit(salts))
        centers = (
            now.where("center")
            .groupBy("bucket", salt.alias("salt"))
            .agg(F.min(F.struct("weight", *[c for c in carried if c != "weight"], "root")).alias("c"), F.count("*").alias("n"))
        )
        centers = written(centers, "centers")
        last = picked is None and centers.where("n > 1").isEmpty()
        pairs = (
            now.join(centers.select("bucket", "c"), "bucket")
            .where((F.col("root") != F.col("c.root")) & possible(F.col, lambda name: F.col(f"c.{name}")))
            .select(F.greatest("node", "c.node").alias("a"), F.least("node", "c.node").alias("b"))
            .distinct()
        )
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = written(pairs, "pairs")
        if not pairs.isEmpty():
            tested = pairs if tested is None else tested.unionAll(pairs)
            found = written(verified(pairs).select("a", "b"), "links")
            if not found.isEmpty():
                links = found if links is None else links.unionAll(found)
                roots = written(components(links), "roots")
        if last:
            break
    return roots, links


def all_links(
    members: DataFrame,
    verified: Callable[[DataFrame], DataFrame],
    possible: Callable[[Callable[[str], Column], Callable[[str], Column]], Column],
) -> DataFrame | None:
    """Every link (a, b), also between nodes that others connect; parameters as for ``connect``. None without any.

    Every possible pair of a bucket is tested, so the work follows the number of links, not of nodes.
    """
    carried = [c for c in members.columns if c not in ("bucket", "center")]
    centers = members.where("center").select("bucket", F.struct(*carried).alias("c"))
    pairs = (
        members.join(centers, "bucket")
        .where((F.col("node") != F.col("c.node")) & possible(F.col, lambda name: F.col(f"c.{name}")))
        .select(F.greatest("node", "c.node").alias("a"), F.least("node", "c.node").alias("b"))
        .distinct()
    )
    pairs = written(pairs, "pairs")
    if pairs.isEmpty():
        return None
    links = written(verified(pairs).select("a", "b"), "links")
    return None if links.isEmpty() else links
