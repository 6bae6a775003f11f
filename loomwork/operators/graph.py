"""Connected components by repeated contraction (no graph library)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomwork.workspace import Workspace


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 64) -> DataFrame:
    """Columns ``node, component``: every node of an edge with the least node of its component.

    Each round lets every node choose the least among itself and its neighbours, follows the choices to their end by pointer
    doubling, and contracts the graph to those ends. An end that is not alone was chosen by a neighbour, so the number of nodes at least
    halves, and the least node of a component is never contracted away. Rounds, and doublings within one, are logarithmic, whatever the
    order of the ids; each writes a small table to the shared folder. Edges with a null end are ignored; a self loop makes a
    component of one.
    """
    ws = Workspace(edges.sparkSession, "cc")
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).dropna()
    e = ws.save(e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    maps: list[DataFrame] = []
    for _ in range(max_rounds):
        m = ws.save(e.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")))
        for _ in range(max_rounds):
            n = m.select(F.col("a").alias("m"), F.col("m").alias("n"))
            jumped = ws.save(m.join(n, "m").select("a", F.col("n").alias("m"), (F.col("n") < F.col("m")).alias("moved")))
            moved = not jumped.filter("moved").isEmpty()
            ws.drop(m)
            m = jumped.select("a", "m")
            if not moved:
                break
        maps.append(m)
        ma = m.select("a", F.col("m").alias("x"))
        mb = m.select(F.col("a").alias("b"), F.col("m").alias("y"))
        nxt = ws.save(e.join(ma, "a").join(mb, "b").filter("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct())
        ws.drop(e)
        e = nxt
        if e.isEmpty():
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    out = maps[-1].select(F.col("a").alias("node"), F.col("m").alias("component"))
    for m in reversed(maps[:-1]):
        later = out.select(F.col("node").alias("m"), "component")
        out = m.join(later, "m", "left").select(F.col("a").alias("node"), F.coalesce("component", "m").alias("component"))
    return out
