"""Connected components of a link table, as joins and grouped minima."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetgauge.session import materialise


def _arrows(df: DataFrame, tail: str, head: str) -> DataFrame:
    return df.select(F.col(tail).alias("u"), F.col(head).alias("v"))


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``component``, the smallest node that links reach, for all linked nodes.

    Large stars and small stars take turns: each node's larger neighbours, then its
    smaller ones, are hung on the smallest neighbour it has, until every component is
    one star. Each round is written to the shared folder, so no lineage grows and no
    links pass through the driver. Links of a node to itself and links with a null count
    for nothing; repeated ones count once.
    """
    one = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"), F.col(a).alias("a"), F.col(b).alias("b"))
    one = one.filter("u > v and a is not null and b is not null").select("u", "v").distinct()
    stars = materialise(one, "links")
    while True:
        both = stars.unionByName(_arrows(stars, "v", "u"))
        lowest = both.groupBy("u").agg(F.min("v").alias("low")).select("u", F.least("u", "low").alias("low"))
        large = both.filter("v > u").join(lowest, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
        centre = large.groupBy("u").agg(F.min("v").alias("low"))
        moved = large.join(centre, "u").filter("v > low")
        small = _arrows(moved, "v", "low").unionByName(_arrows(centre, "u", "low")).distinct()
        stars = materialise(small, "links")
        # Done when every node hangs on one other, which hangs on none.
        twice = stars.groupBy("u").count().filter("count > 1").select("u")
        higher = stars.join(stars.select(F.col("u").alias("v")), "v", "left_semi").select("u")
        if twice.unionByName(higher).isEmpty():
            break
    nodes = stars.unionByName(stars.select(F.col("v").alias("u"), "v")).distinct()
    return nodes.select(F.col("u").alias("node"), F.col("v").alias("component"))


class Roots:
    """Union of points by index inside one task; a root is the smallest index of its set."""

    def __init__(self, size: int):
        self.of = np.arange(size)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        """Unite the sets of every pair."""
        of = self.of
        while True:
            x, y = of[a], of[b]
            apart = x != y
            if not apart.any():
                return
            a, b = a[apart], b[apart]
            x, y = x[apart], y[apart]
            np.minimum.at(of, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = of[of]
                if (up == of).all():
                    break
                of[:] = up
