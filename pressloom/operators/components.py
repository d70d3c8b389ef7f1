"""Connected components of an edge table, by rounds of contraction."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pressloom.session import StepTables


#: Edges that are followed to their ends in one group.
FEW = 50_000


def _roots_of_few(edges: DataFrame) -> DataFrame:
    """(node, root) of the nodes of at most `FEW` edges; root is the smallest node of the component."""

    def run(rows: pd.DataFrame) -> pd.DataFrame:
        nodes, ends = np.unique(rows[["a", "b"]].to_numpy(), return_inverse=True)
        a, b = ends.reshape(-1, 2).T
        label = np.arange(len(nodes))
        while (label[a] != label[b]).any():
            x, y = label[a], label[b]
            np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
            while (label[label] != label).any():
                label = label[label]
        return pd.DataFrame({"node": nodes, "root": nodes[label]})

    kind = edges.schema["a"].dataType.simpleString()
    return edges.withColumn("all", F.lit(0)).groupBy("all").applyInPandas(run, f"node {kind}, root {kind}")


def components(edges: DataFrame, steps: StepTables, few: int = FEW) -> DataFrame:
    """(node, root) for every node of the edges (a, b); root is some node of the component.

    In each round every node joins the neighbour, or itself, that comes first in an order that changes with the round;
    the edges between the joined nodes are the next round's.  Only minima per node are aggregated, so a node with very
    many edges costs a row per task; the maps of the rounds are joined at the end.  The last `few` edges, a bounded number
    whatever the rounds began with, are finished in one group, in place of many rounds of hardly any rows.
    """
    maps: list[DataFrame] = []
    current = steps.save(edges.select("a", "b").where("a <> b").distinct(), "component-edges")
    empty = current.select(F.col("a").alias("node"), F.col("b").alias("root")).where(F.lit(False))
    while left := current.count():
        if left <= few:
            maps.append(steps.save(_roots_of_few(current), "component-roots"))
            steps.drop(current)
            break
        turn = F.lit(len(maps))
        placed = lambda c: F.struct(F.xxhash64(c, turn).alias("h"), F.col(c).alias("v"))  # noqa: B023, E731
        both = current.union(current.select("b", "a"))
        nearest = both.groupBy("a").agg(F.min(placed("b")).alias("first"))
        chosen = steps.save(nearest.select(F.col("a").alias("node"), F.least("first", placed("a"))["v"].alias("root")), "component-roots")
        maps.append(chosen)
        named = current.join(chosen.toDF("a", "ra"), "a").join(chosen.toDF("b", "rb"), "b").where("ra <> rb")
        following = steps.save(named.select(F.least("ra", "rb").alias("a"), F.greatest("ra", "rb").alias("b")).distinct(), "component-edges")
        steps.drop(current)
        current = following
    if not maps:
        return empty
    found = maps[0]
    for later in maps[1:]:
        found = found.join(later.toDF("root", "next"), "root", "left").select("node", F.coalesce("next", "root").alias("root"))
    return found
