"""Connected components of links, as joins and sums over the links (alternating stars).

No node's neighbours are gathered in one task: the least neighbour of a node is an
aggregate, and the links of a node with very many of them are joined with it where they are.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hirelake.llm.arrow import importable
from hirelake.session import stage

LINK = "node long, low long"
#: At most so many nodes are broadcast as hubs (16 bytes each), and a node with fewer links than this is none.
HUBS = 100_000
FEW = 100


class UnionFind:
    """Groups of numbers; the least of a group is its root."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top

    def join(self, a: int, b: int) -> bool:
        """Put both into one group; False if they were in one already."""
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _local_groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each batch's links as a star per group: never more links than there were."""
    for batch in batches:
        groups = UnionFind()
        for a, b in zip(*(column.to_pylist() for column in batch.columns)):
            groups.join(a, b)
        stars = [(node, groups.root(node)) for node in groups.parent]
        stars = [(node, root) for node, root in stars if node != root]
        yield pa.record_batch([pa.array([x[k] for x in stars], pa.int64()) for k in (0, 1)], ["node", "low"])


def _with_least(links: DataFrame, both: DataFrame, most: int) -> DataFrame:
    """``links`` with ``least``, the least ``low`` that ``both`` has for their node.

    A node with more than one in :data:`HUBS` of all links (and more than :data:`FEW` of them) is a hub. There are at most
    :data:`HUBS` of these, so they are broadcast, and their links stay where they are; all others meet in a shuffle.
    """
    least = both.groupBy("node").agg(F.min("low").alias("least"), F.count("*").alias("links"))
    hub = F.col("links") > max(FEW, most // HUBS)
    marked = links.join(F.broadcast(least.where(hub).select("node", F.col("least").alias("hub_least"))), "node", "left")
    of_hubs = marked.where("hub_least is not null").select("node", "low", F.col("hub_least").alias("least"))
    others = marked.where("hub_least is null").select("node", "low")
    return of_hubs.union(others.join(least.where(~hub).select("node", "least"), "node").select("node", "low", "least"))


def _large_star(links: DataFrame, count: int) -> DataFrame:
    """Every node's larger neighbours point to the least of its neighbourhood; links may repeat."""
    both = links.union(links.select(F.col("low").alias("node"), F.col("node").alias("low")))
    larger = _with_least(both, both, 2 * count).where("low > node")
    return larger.select(F.col("low").alias("node"), F.least("node", "least").alias("low"))


def _small_star(links: DataFrame, count: int) -> DataFrame:
    """Every node and its smaller neighbours point to the least of them."""
    joined = _with_least(links, links, count)
    return (
        joined.select("node", F.col("least").alias("low"))
        .union(joined.where("low != least").select(F.col("low").alias("node"), F.col("least").alias("low"))).distinct()
    )


def _are_stars(links: DataFrame) -> bool:
    """Whether every node has one link and no node is the low end of another: then nothing is left to do."""
    ends = links.select(F.explode(F.array(
        F.struct(F.col("node").alias("end"), F.lit(1).alias("as_node"), F.lit(0).alias("as_low")),
        F.struct(F.col("low").alias("end"), F.lit(0).alias("as_node"), F.lit(1).alias("as_low")))).alias("x")).select("x.*")
    uses = ends.groupBy("end").agg(F.sum("as_node").alias("nodes"), F.max("as_low").alias("lows"))
    return uses.where("nodes > 1 or nodes = 1 and lows = 1").isEmpty()


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``low`` (the least node of its group) for links given as two columns of numbers.

    Every node of a link has a row but the least of its group; a node without links has none. Null
    ends and links of a node with itself are left out. Each round is written to the shared folder, so lost
    executors cost a re-read; rounds grow with the logarithm of the longest chain.
    """
    importable(links.sparkSession)
    a, b = links.columns
    plain = links.select(F.col(a).cast("long").alias("node"), F.col(b).cast("long").alias("low")).where("node != low")
    current = stage(plain.mapInArrow(_local_groups, LINK).distinct(), "links")
    while not _are_stars(current):
        count = current.count()
        larger = stage(_large_star(current, count), "links")
        current = stage(_small_star(larger, count), "links")
    return current
