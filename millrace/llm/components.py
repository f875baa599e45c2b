"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import materialize


def _signature(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("big", "small")), F.sum(F.pmod(F.xxhash64("small", "big"), F.lit(1 << 31)))).first()
    return tuple(row)


def connected_components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Return ``node, component`` for every node whose component is smaller than itself.

    ``edges`` has two long columns; each row links two nodes. Component is the smallest node reachable. Rows with a
    null end or both ends equal link nothing; repeated rows are one link; no rows give no rows. Nodes that are the
    smallest of their component are left out (callers coalesce). Every round is a few shuffles whose sums are combined
    before they are dealt out, and ends in a table in the shared folder; the number of rounds grows with the logarithm
    of the longest chain. Only a count and two hashes reach the driver.
    """
    ends = edges.where(F.col(a) != F.col(b))
    stars = materialize(ends.select(F.greatest(a, b).alias("big"), F.least(a, b).alias("small")).distinct(), "stars")
    seen = _signature(stars)
    for _ in range(max_rounds):
        if seen[0] == 0:
            break
        # large star: each larger neighbour of a node links to the smallest neighbour of that node
        both = stars.select("big", "small").unionByName(stars.select(F.col("small").alias("big"), F.col("big").alias("small")))
        least = both.groupBy(F.col("big").alias("node")).agg(F.min("small").alias("low"))
        large = stars.join(least, stars.small == least.node).select("big", F.least("small", "low").alias("small")).distinct()
        # small star: each node's smaller neighbours link to the smallest of them
        low = large.groupBy("big").agg(F.min("small").alias("low"))
        moved = large.join(low, "big").where("small != low").select(F.col("small").alias("big"), F.col("low").alias("small"))
        stars = materialize(moved.unionByName(low.select("big", F.col("low").alias("small"))).distinct(), "stars")
        now = _signature(stars)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return stars.select(F.col("big").alias("node"), F.col("small").alias("component"))


class Forest:
    """Union-find over the rows of one task: turns its pairs into at most one link a row."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def roots(self, x: np.ndarray) -> np.ndarray:
        """The roots of rows ``x``."""
        x = self.root[x]
        while (self.root[x] != x).any():
            x = self.root[x]
        return x

    def root_of(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = int(root[x])
        return x

    def add(self, x: np.ndarray, y: np.ndarray) -> None:
        """Take the pairs ``x, y``; the first of those that join two trees become links."""
        while len(x):
            rx, ry = self.root[x], self.root[y]
            while (self.root[rx] != rx).any() or (self.root[ry] != ry).any():
                rx, ry = self.root[rx], self.root[ry]
            apart = rx != ry
            x, y, rx, ry = x[apart], y[apart], rx[apart], ry[apart]
            if not len(x):
                return
            firsts = np.unique(rx * np.int64(len(self.root)) + ry, return_index=True)[1]
            for k in firsts.tolist():
                p, q = self.root_of(int(rx[k])), self.root_of(int(ry[k]))
                if p != q:
                    self.root[max(p, q)] = min(p, q)
                    self.links.append((int(x[k]), int(y[k])))
