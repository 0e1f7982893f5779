"""Connected components of a table of links, without gathering it anywhere.

Each task first joins its own links with a union-find and passes on a forest, at most one
link per node. What is left is joined by alternating star steps: every node hangs its larger
neighbours, then its smaller ones, on the smallest node it sees. The number of rounds grows
with the logarithm of the longest path. Rounds are written to the shared folder, so a lost
executor costs at most the current round.
"""

from pyspark.sql import functions as F

from pulse.llm.arrow import map_arrow, record_batch
from pulse.session import shared_folder

FOREST_LINKS = 500_000  # links a task joins before it passes the forest on


def _forest(batches, schema):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def trees():
        nodes = [x for x in parent if root(x) != x]
        return record_batch(schema, [nodes, [root(x) for x in nodes]])

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        if len(parent) > FOREST_LINKS:
            yield trees()
            parent.clear()
    yield trees()


def _written(df, purpose):
    folder = shared_folder(df.sparkSession, purpose)
    df.write.parquet(folder)
    return df.sparkSession.read.parquet(folder)


def _state(edges):
    """Number and sums of the edges, to see whether a round changed anything."""
    return edges.agg(
        F.count(F.lit(1)),
        F.sum(F.col("u").cast("decimal(38,0)")),
        F.sum(F.col("v").cast("decimal(38,0)")),
        F.bit_xor(F.xxhash64("u", "v")),
    ).first()


def smallest_reachable(links):
    """``node, component`` for every node in a link; the component is the smallest node."""
    pairs = links.select(F.col(links.columns[0]).alias("a"), F.col(links.columns[1]).alias("b"))
    pairs = pairs.where("a != b")
    edges = map_arrow(pairs, _forest, "u bigint, v bigint")  # u above v
    edges = _written(edges.distinct(), "forest")
    before = _state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        # larger neighbours of u hang on the smallest of u and its neighbours
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = _written(large.where("u != v").distinct(), "stars")
        # each node and its smaller neighbours hang on the smallest of them
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(
            F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v")
        edges = _written(small.where("u != v").distinct(), "stars")
        after = _state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("u"), "v").distinct()
    return edges.unionByName(roots).select(F.col("u").alias("node"), F.col("v").alias("component"))
