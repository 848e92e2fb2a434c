"""Connected components by repeated contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tremor.operators.skew import BROADCAST_ROWS, balanced_join, is_small
from tremor.workspace import materialise

MAX_ROUNDS = 100


def _follow(df: DataFrame, column: str, pointers: DataFrame, limit: int | None, small: bool) -> DataFrame:
    """Replace ``column`` by what ``pointers(node, root)`` says, where it has an entry."""
    other = [c for c in df.columns if c != column]
    target = pointers.select(F.col("node").alias(column), F.col("root").alias("_to"))
    joined = balanced_join(df, target, [column], "left", other, limit, small=small)
    return joined.withColumn(column, F.coalesce("_to", column)).select(df.columns)


def connected_components(edges: DataFrame, limit: int | None = None) -> DataFrame:
    """(node, label) for every node with a neighbour in the undirected pairs ``edges(u, v)``.

    Every round points each node at its smallest neighbour, follows the pointers
    twice, and redraws the edges between the nodes pointed at. At least half of
    the nodes drop out per round, so the edge table shrinks fast and the number
    of rounds grows with the logarithm of the graph. The smallest node of a
    component never moves, hence it ends up as the label.
    """
    u, v = F.col("u"), F.col("v")
    both = edges.select(F.explode(F.array(F.struct(u, v), F.struct(v.alias("u"), u.alias("v")))).alias("e")).select("e.*")
    current = materialise(both.filter("u <> v").distinct(), "edges")
    nodes = current.select(F.col("u").alias("node")).distinct()
    maps = []
    while size := current.count():
        if len(maps) == MAX_ROUNDS:
            raise RuntimeError(f"components did not settle within {MAX_ROUNDS} rounds")
        direct = current.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root")).filter("root < node")
        small = size <= (BROADCAST_ROWS if limit is None else limit)
        if not small:
            # The pointers may still be few; they never outnumber the edges.
            direct = materialise(direct, "pointers")
            small = is_small(direct, limit)
        pointers = direct
        for _ in range(2):
            pointers = _follow(pointers, "root", direct, limit, small)
        pointers = materialise(pointers, "pointers")
        maps.append((pointers, small))
        moved = _follow(_follow(current, "u", pointers, limit, small), "v", pointers, limit, small)
        current = materialise(moved.filter("u <> v").distinct(), "edges")
    labels = nodes.withColumn("label", F.col("node"))
    for pointers, small in maps:
        labels = _follow(labels, "label", pointers, limit, small)
    return materialise(labels, "labels")
