"""Connected components by repeated contraction."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from mercaflow.llm.storage import stored


def _order(column: str, turn: int) -> F.Column:
    return F.struct(F.xxhash64(F.col(column), F.lit(turn)).alias("h"), F.col(column).alias("id"))


def connected_components(edges: DataFrame) -> DataFrame:
    """Vertices of ``edges`` (``a``, ``b``: long) with ``root``, the smallest
    vertex of their component.

    In every turn each vertex joins its neighbour of least hash, and edges
    between joined vertices vanish. The hash changes with the turn, so that a
    chain shrinks by a constant factor too. Nothing is gathered by vertex but
    a minimum. Nulls and loops are left out; an empty input gives no rows.
    """
    current = stored(edges.filter("a is not null and b is not null and a <> b").select("a", "b").distinct(), "edges")
    both = current.select("a").union(current.select("b")).distinct()
    roots = stored(both.select(F.col("a").alias("id"), F.col("a").alias("root")), "roots")
    turn = 0
    while not current.isEmpty():
        ends = current.select("a", "b").union(current.select("b", "a"))
        least = ends.groupBy("a").agg(F.min(_order("b", turn)).alias("least"))
        own = _order("a", turn)
        joined = stored(
            least.select(F.col("a").alias("from"), F.least(own, F.col("least"))["id"].alias("to")), "joined"
        )
        a, b = joined.toDF("a", "to_a"), joined.toDF("b", "to_b")
        moved = current.join(a, "a").join(b, "b").filter("to_a <> to_b")
        ordered = moved.select(F.least("to_a", "to_b").alias("a"), F.greatest("to_a", "to_b").alias("b"))
        current = stored(ordered.distinct(), "edges")
        step = joined.toDF("root", "to")
        roots = roots.join(step, "root", "left").select("id", F.coalesce("to", "root").alias("root"))
        roots = stored(roots, "roots")
        turn += 1
    smallest = roots.groupBy("root").agg(F.min("id").alias("least"))
    return roots.join(smallest, "root").select("id", F.col("least").alias("root"))
