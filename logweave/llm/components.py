"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logweave.session import materialize


def connected_components(links: DataFrame) -> DataFrame:
    """``id, component``: the smallest id that each end of a link ``a, b`` reaches.

    Links with a null end or equal ends say nothing; ids without links are not in the result.
    In every round each node moves to the neighbour, or itself, that comes first in a random order, and links
    between different targets remain. A round leaves a constant share of the nodes on average, so long
    chains take few rounds, and a node with very many links is an aggregate, not a group.
    """
    edges = materialize(links.filter("a <> b").select("a", "b").distinct(), "links")
    moves = []
    while not edges.isEmpty():
        order = F.struct(F.xxhash64("other", F.lit(len(moves))), "other")
        both = edges.union(edges.select("b", "a")).toDF("id", "other")
        first = both.groupBy("id").agg(F.min(order).alias("first"))
        own = F.struct(F.xxhash64("id", F.lit(len(moves))), "id")
        target = F.when(own < F.col("first"), F.col("id")).otherwise(F.col("first.other"))
        move = materialize(first.select("id", target.alias("to")), "moves")
        moves.append(move)
        moved = (
            edges.join(move.toDF("a", "x"), "a").join(move.toDF("b", "y"), "b")
            .filter("x <> y")
            .select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
        )
        edges = materialize(moved.distinct(), "links")
    if not moves:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    place = moves[0]
    for move in moves[1:]:
        place = place.join(move.toDF("to", "next"), "to", "left").select(
            "id", F.coalesce("next", "to").alias("to")
        )
    place = materialize(place, "places")
    smallest = place.groupBy("to").agg(F.min("id").alias("component"))
    return materialize(place.join(smallest, "to").select("id", "component"), "components")
