"""Connected components of an edge table by alternating stars.

Large star: every node links its larger neighbours to its smallest one. Small
star: every node links its smaller neighbours to the smallest. Both keep the
components and end in a star around each smallest node, after a logarithmic
number of rounds in practice. A node's minimum is a sum with map-side partial
aggregation, joined back to its edges: a hub's edges are split by AQE and never
gathered. Each round is written to the shared folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from movelake.llm.common import written


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (a, b), a > b."""
    turned = edges.select(F.col("b").alias("a"), F.col("a").alias("b"))
    near = edges.unionByName(turned) if large else edges
    low = written(near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), "components-low")
    near = (near.where("b > a") if large else near).join(low, "a")
    out = near.select(F.col("b").alias("a"), F.col("m").alias("b")).where("a != b")
    if not large:
        out = out.unionByName(low.select("a", F.col("m").alias("b")))
    return out.distinct()


def components(edges: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """(node, root): every node that has an edge to another, and the smallest
    node of its component. Loops, repeats, direction and null ends are ignored;
    no edges give no rows."""
    e = edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).where(f"{a} != {b}").distinct()
    e = written(e, "components")
    mark = lambda d: tuple(d.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
    state = mark(e)
    for _ in range(rounds if state[0] else 0):
        e = written(_star(_star(e, large=True), large=False), "components")
        before, state = state, mark(e)
        if state == before:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
    if state[0]:
        raise RuntimeError(f"components: not settled after {rounds} rounds")
    return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
