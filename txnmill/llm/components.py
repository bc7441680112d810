"""Connected components of a link table, by contraction in a few joins a round."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txnmill.llm.common import staged


def components(links: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(node, root) for every node that has a link; nodes with one root are connected.

    In a round every node moves to the neighbour, or itself, that comes first in an order drawn
    anew for the round. A link then joins the new places of its ends, which keeps what is
    connected connected, and links within one place are done. The random order shortens long
    chains by a constant factor a round. Moves and links are written after each round; the
    moves are followed in the end from the first round to the last.

    A null end is no node. Links of a node with itself give it the root itself.
    """
    if not links.schema[left].dataType == links.schema[right].dataType:
        raise ValueError("both ends of a link must have one type")
    edges = links.select(F.col(left).alias("a"), F.col(right).alias("b")).dropna()
    edges = staged(edges.union(edges.select("b", "a")).distinct(), "edges")
    nodes = edges.select(F.col("a").alias("node")).distinct()
    places = staged(nodes.withColumn("root", F.col("node")), "places")
    turn = 0
    edges = edges.filter("a <> b")
    while not edges.isEmpty():
        turn += 1
        first = F.min(F.struct(F.xxhash64(F.lit(turn), "b").alias("h"), F.col("b").alias("to")))
        moves = edges.groupBy("a").agg(first.alias("best"))
        own = F.struct(F.xxhash64(F.lit(turn), "a").alias("h"), F.col("a").alias("to"))
        moves = moves.select("a", F.least("best", own)["to"].alias("to"))
        moves = staged(moves, f"moves{turn}")
        to_b = moves.select(F.col("a").alias("b"), F.col("to").alias("to_b"))
        edges = staged(
            edges.join(moves, "a")
            .join(to_b, "b")
            .filter("to <> to_b")
            .select(F.col("to").alias("a"), F.col("to_b").alias("b"))
            .distinct(),
            f"edges{turn}",
        )
        step = moves.select(F.col("a").alias("root"), "to")
        places = staged(
            places.join(step, "root", "left").select("node", F.coalesce("to", "root").alias("root")),
            f"places{turn}",
        )
    return places
