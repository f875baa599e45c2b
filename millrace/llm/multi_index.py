"""Embedding near-dedup by an inverted multi-index: codebooks on both halves, cells visited in multi-sequence order."""

from __future__ import annotations

import heapq
import logging
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import Forest, connected_components
from millrace.llm.scratch import materialize
from millrace.llm.text import unit_hash

#: Vectors, about, that the codebooks are fitted on and that are turned to see how far the visits must go.
SAMPLE_ROWS = 8_000
#: Bytes of vectors that the sample may have on the driver, about; longer vectors make a smaller sample.
SAMPLE_BYTES = 64 << 20
#: Vectors that a cell should hold, about, and sampled vectors that a code word needs at least.
CELL_ROWS, CODE_SAMPLES = 200, 8
#: Links that are made from the sample to measure recall, at least, and the share of those at the least cosine that must be met.
MADE_LINKS, RECALL_AT_LEAST = 20_000, 0.99
#: A vector with so many copies, and more than a thousandth of all, meets its rows in HOT_PARTS tasks.
HOT_COPIES, HOT_PARTS = 10_000, 64
#: Vectors of one side of a comparison task, about.
TILE_ROWS = 4096


def _codes(half: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Code words of a half: k-means from a seeded start."""
    rng = np.random.default_rng(7)
    centres = half[rng.permutation(len(half))[:k]].copy()
    for _ in range(rounds):
        near = ((half * half).sum(1)[:, None] - 2 * half @ centres.T + (centres * centres).sum(1)).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, half)
        n = np.bincount(near, minlength=len(centres))
        centres[n > 0] = sums[n > 0] / n[n > 0][:, None]
    return centres


def multi_sequence(a: np.ndarray, b: np.ndarray, limit: float) -> Iterator[tuple[int, int]]:
    """Places (i, j) of two rising sequences in the order of a[i] + b[j], while that is at most ``limit``."""
    heap = [(a[0] + b[0], 0, 0)]
    while heap:
        total, i, j = heapq.heappop(heap)
        if total > limit:
            return
        yield i, j
        if j + 1 < len(b):
            heapq.heappush(heap, (a[i] + b[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (a[i + 1] + b[0], i + 1, 0))


class Index:
    """Codebooks of both halves for each length of vector, and how far a vector visits.

    A half of v that lies in another code word's cell than u's half is at least as far from it as the plane between the
    two code words, which u's half is at a distance m from. Cells are visited in rising m1^2 + m2^2 up to ``limit``. For
    unit vectors u and v at distance d, v's cell has m1^2 + m2^2 <= d^2, so a limit of 2 - 2 * cosine misses no pair;
    few pairs need as much, and ``reach`` sets the limit by what links of known angles need.
    """

    def __init__(self, samples: dict[int, np.ndarray], most: dict[int, int], cosine: float) -> None:
        self.codes: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.gaps: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        self.cosine, self.recall, self.recall_at_least = cosine, 1.0, 1.0
        self.limit = 2 - 2 * cosine + 1e-6  # more than what rounding adds to a margin
        for dim, rows in samples.items():
            unit = rows / np.linalg.norm(rows, axis=1)[:, None]
            k = int(min(max(1, len(rows) // CODE_SAMPLES), max(1, round((most[dim] / CELL_ROWS) ** 0.5))))
            cut = (dim + 1) // 2
            self.codes[dim] = (_codes(unit[:, :cut], k), _codes(unit[:, cut:], k))
            self.gaps[dim] = tuple(np.sqrt(np.maximum(0, (c * c).sum(1)[:, None] - 2 * c @ c.T + (c * c).sum(1))) for c in self.codes[dim])

    def needed(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """How far the visits must go for each unit row of ``u`` to meet that of ``v``: of two cells the lower one visits."""
        (one_u, two_u, m1_u, m2_u), (one_v, two_v, m1_v, m2_v) = self.margins(u), self.margins(v)
        k, row = m1_u.shape[1], np.arange(len(u))
        from_u = one_u * k + two_u < one_v * k + two_v
        return np.where(from_u, m1_u[row, one_v] + m2_u[row, two_v], m1_v[row, one_u] + m2_v[row, two_u])

    def reach(self, samples: dict[int, np.ndarray], recall: float) -> None:
        """Set the limit at which a share ``recall`` of links that are made from the sample would be met.

        Sampled vectors are turned by angles that are even from 0 to that of the least cosine, half of them in random
        directions and half towards other sampled vectors; at the least cosine itself, the hardest, at least 0.99 must
        be met. So the measure needs no links in the data and does not depend on how many there are. A sample of m
        vectors may hide a loss of 3 / m (in one of twenty samples), so both shares are raised by that.
        """
        rng, needs, total = np.random.default_rng(11), ([], []), sum(map(len, samples.values()))
        for dim, rows in samples.items():
            if dim < 2:
                continue
            unit = rows / np.linalg.norm(rows, axis=1)[:, None]
            for turn in range(-(-MADE_LINKS // (2 * max(1, total))) * 2):
                way = rng.normal(size=unit.shape) if turn % 2 else unit[rng.permutation(len(unit))] + 1e-9 * rng.normal(size=unit.shape)
                way = way - (way * unit).sum(1)[:, None] * unit
                way /= np.linalg.norm(way, axis=1)[:, None]
                most = np.full(len(unit), np.arccos(self.cosine))
                for found, angle in zip(needs, (most * rng.random(len(unit)), most)):
                    found.append(self.needed(unit, np.cos(angle)[:, None] * unit + np.sin(angle)[:, None] * way))
        if not needs[0]:
            return
        even, hardest = (np.concatenate(x) for x in needs)
        hidden = 3 / total
        limit = max(np.quantile(even, min(1.0, recall + hidden), method="higher"), np.quantile(hardest, min(1.0, min(recall, RECALL_AT_LEAST) + hidden), method="higher"))
        self.limit = min(self.limit, float(limit) + 1e-9)
        self.recall, self.recall_at_least = float((even <= self.limit).mean()), float((hardest <= self.limit).mean())

    def margins(self, unit: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each row: the code words nearest to its halves, and the squared distances to the planes between them and the others."""
        cut = (unit.shape[1] + 1) // 2
        out = []
        for half, codes, gaps in zip((unit[:, :cut], unit[:, cut:]), self.codes[unit.shape[1]], self.gaps[unit.shape[1]]):
            square = (codes * codes).sum(1) - 2 * half @ codes.T
            near = square.argmin(1)
            gap = gaps[near]
            m = (square - square.min(1)[:, None]) / np.where(gap > 0, 2 * gap, np.inf)
            out.append((near, m * m))
        return out[0][0], out[1][0], out[0][1], out[1][1]

    def visits(self, rows: np.ndarray) -> Iterator[tuple[int, list[int]]]:
        """Of each row: its own cell, and the cells that it visits, its own first."""
        dim = rows.shape[1]
        if dim not in self.codes:
            for _ in rows:
                yield 0, [0]
            return
        unit = rows / np.linalg.norm(rows, axis=1)[:, None]
        k = len(self.codes[dim][1])
        one, two, m1, m2 = self.margins(unit)
        order1, order2 = np.argsort(m1, axis=1, kind="stable"), np.argsort(m2, axis=1, kind="stable")
        for r in range(len(rows)):
            a, b = order1[r], order2[r]
            sorted1, sorted2 = m1[r, a].tolist(), m2[r, b].tolist()
            own = int(one[r]) * k + int(two[r])
            yield own, [int(a[i]) * k + int(b[j]) for i, j in multi_sequence(sorted1, sorted2, self.limit)]


def _fit(reps: DataFrame, cosine: float, recall: float) -> Index:
    """Codebooks and limit from a bounded sample picked by hash; what reaches the driver is SAMPLE_ROWS vectors, about.

    Lengths beyond the 64 most frequent get no codebook: the vectors of such a length (and label) are one cell, and all met.
    """
    by_label = reps.groupBy("dim", "label").agg(F.count("*").alias("n"))
    found = by_label.groupBy("dim").agg(F.sum("n").alias("n"), F.max("n").alias("most")).orderBy(F.desc("n"), "dim").limit(64).collect()
    n, most = {r["dim"]: r["n"] for r in found}, {r["dim"]: r["most"] for r in found}  # cells are of a label: the largest sets their number
    total = sum(n.values())
    rows = min(SAMPLE_ROWS, SAMPLE_BYTES * total // max(1, sum(8 * d * k for d, k in n.items()))) if total else 0
    picked = reps.where(unit_hash("rep", seed="codebook") < rows / max(1, total)).select("rep", "label", "dim", "vec").orderBy("rep").limit(2 * SAMPLE_ROWS).collect()
    picked = [r for r in picked if r["dim"] in n]
    samples = {d: np.array([r["vec"] for r in picked if r["dim"] == d], float) for d in {r["dim"] for r in picked}}
    index = Index(samples, most, cosine)
    if recall < 1:
        index.reach(samples, recall)
    return index


def _visit_rows(reps: DataFrame, index: Index) -> DataFrame:
    """``rep, label, dim, cell, home``: each vector's own cell (``home``) and those that it visits, ids only.

    Of two cells a pair is visited from one side.
    """
    sent = reps.sparkSession.sparkContext.broadcast(index)
    names = ["rep", "label", "dim", "cell", "home"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = sent.value
        for whole in batches:
            for start in range(0, whole.num_rows, 1024):
                batch = whole.slice(start, 1024)
                dims = np.array(batch.column(2).to_pylist())
                for dim in np.unique(dims).tolist():
                    rows = np.nonzero(dims == dim)[0]
                    vectors = np.array(batch.column(3).take(pa.array(rows)).to_pylist(), float)
                    take, cells, home = [], [], []
                    for r, (own, visited) in zip(rows.tolist(), index.visits(vectors)):
                        mine = [own, *(c for c in visited if c > own)]
                        take += [r] * len(mine)
                        cells += mine
                        home += [True] + [False] * (len(mine) - 1)
                    columns = [batch.column(k).take(pa.array(take, pa.int64())) for k in range(3)]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array(cells, pa.int64()), pa.array(home)], names=names)

    return reps.select("rep", "label", "dim", "vec").mapInArrow(run, "rep long, label string, dim int, cell long, home boolean")


def _compare(visits: DataFrame, reps: DataFrame, cosine: float) -> DataFrame:
    """``rep, links, other``: link counts (other null) and spanning links of the vectors that meet in a cell.

    A cell's members and visitors are dealt over tiles, each pair of a member tile and a visitor tile a task's group,
    so that a cell with a third of all vectors is many groups of bounded size. Tiles are dealt out as ids; a vector
    joins its tiles by its id.
    """
    where = ["label", "dim", "cell"]
    tiles = lambda flag: F.ceil(F.count_if(flag) / TILE_ROWS).cast("int")
    sizes = visits.groupBy(*where).agg(F.greatest(F.lit(1), tiles(F.col("home"))).alias("m"), F.greatest(F.lit(1), tiles(F.lit(True))).alias("v"), F.count("*").alias("n"))
    dealt = visits.join(sizes.where("n > 1"), where)
    part = F.xxhash64("rep")
    members = dealt.where("home").select(*where, "rep", "home", F.lit(True).alias("member"), F.pmod(part, F.col("m")).cast("int").alias("mt"), F.explode(F.sequence(F.lit(0), F.col("v") - 1)).alias("vt"))
    visitors = dealt.select(*where, "rep", "home", F.lit(False).alias("member"), F.explode(F.sequence(F.lit(0), F.col("m") - 1)).alias("mt"), F.pmod(part, F.col("v")).cast("int").alias("vt"))
    rows = members.unionByName(visitors).join(reps.select("rep", "vec", "copies"), "rep")

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        left, right = pdf[~pdf["member"]], pdf[pdf["member"]]
        reps = np.concatenate([left["rep"].to_numpy(), right["rep"].to_numpy()])
        unique, place = np.unique(reps, return_inverse=True)
        counts = np.zeros(len(unique), np.int64)
        forest = Forest(len(unique))
        if len(left) and len(right):
            a, b = np.array(left["vec"].tolist(), float), np.array(right["vec"].tolist(), float)
            at_a, at_b = place[: len(left)], place[len(left) :]
            copies_a, copies_b = left["copies"].to_numpy(), right["copies"].to_numpy()
            guest = ~left["home"].to_numpy(bool)
            norm_a, norm_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
            for i in range(0, len(a), 512):
                near = (a[i : i + 512] @ b.T) / (norm_a[i : i + 512, None] * norm_b) >= cosine
                near &= at_a[i : i + 512, None] != at_b
                x, y = np.nonzero(near)
                if len(x):
                    np.add.at(counts, at_a[x + i], copies_b[y])
                    # a pair within a cell is met from both sides, one of two cells from the guest's only
                    g = guest[x + i]
                    np.add.at(counts, at_b[y[g]], copies_a[x[g] + i])
                    forest.add(at_a[x + i], at_b[y])
        hit = np.nonzero(counts)[0]
        links = np.array(forest.links, np.int64).reshape(-1, 2)
        return pd.DataFrame({"rep": np.concatenate([unique[hit], unique[links[:, 0]]]), "links": np.concatenate([counts[hit], np.zeros(len(links), np.int64)]), "other": pd.array([None] * len(hit) + unique[links[:, 1]].tolist(), dtype="Int64")})

    return rows.groupBy(*where, "mt", "vt").applyInPandas(link, "rep long, links long, other long")


def _hot(reps: DataFrame) -> DataFrame:
    """Vectors with HOT_COPIES copies or more that are a thousandth of all rows each: a thousand at most."""
    total = reps.agg(F.sum("copies")).first()[0] or 0
    return reps.where((F.col("copies") >= HOT_COPIES) & (F.col("copies") * 1000 >= total)).select("rep")


def near_duplicates(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", cosine: float = 0.98, recall: float = 0.999) -> DataFrame:
    """Return ``vec_id, n_links, component_id, kept`` for each row of ``vectors``.

    Vectors with equal, non-null labels and lengths link at ``cosine`` or more (double precision); ones that are null,
    zero, or hold a null, NaN or infinite component link with nothing. Equal vectors of a label are compared once and
    counted by their copies. At a ``recall`` of 1 no link is missed; below it visits end where that share of links made
    from a sample is met (see ``Index.reach``), the same rule for every table. Repeated rows are vectors of their own; a
    null id is never a component's smallest, unless there is no other; an empty table gives an empty result.
    """
    v = F.col("vec")
    # floats stay floats in what is shuffled; tasks compute in doubles
    kind = "array<float>" if vectors.schema[vector_col].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"), F.col(vector_col).cast(kind).alias("vec"))
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    some = F.exists(v, lambda x: x != 0)
    # 0.0 and -0.0 are equal, so they must hash alike
    rows = rows.withColumn("vec", F.transform(v, lambda x: F.when(x == 0, F.abs(x)).otherwise(x))).withColumn("sound", F.coalesce(F.col("label").isNotNull() & ~odd & some, F.lit(False)))
    sound = rows.where("sound")
    groups = sound.groupBy("label", "vec").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
    for seed in range(8):  # a name for each vector of a label from its content, so reruns agree
        name = F.xxhash64(F.lit(seed), "label", "vec")
        reps = materialize(groups.withColumns({"rep": name, "dim": F.size("vec")}), "vectors")
        if reps.select("rep").distinct().count() == reps.count():
            break
    else:
        raise RuntimeError("names of vectors collide under eight seeds")
    index = _fit(reps, cosine, recall)
    logging.getLogger(__name__).info("visits up to %g, recall %g, at the least cosine %g", index.limit, index.recall, index.recall_at_least)
    visits = materialize(_visit_rows(reps, index), "visits")
    met = materialize(_compare(visits, reps, cosine), "links")
    counts = met.groupBy("rep").agg(F.sum("links").alias("links"))
    joined = connected_components(met.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    joined = materialize(joined, "joined")
    roots = joined.select("node", "component").unionByName(joined.select(F.col("component").alias("node"), "component")).distinct()
    linked = reps.join(roots, reps.rep == roots.node).select("rep", "first", "component")
    linked = linked.join(linked.groupBy("component").agg(F.min("first").alias("low")), "component").select("rep", "low")
    answer = reps.select("rep", "first", "copies").join(counts, "rep", "left").join(linked, "rep", "left")
    answer = answer.select("rep", (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("low", "first").alias("low"))
    hot = [r["rep"] for r in _hot(reps).collect()]
    is_hot = F.col("rep").isin(hot) if hot else F.lit(False)
    same = sound.select("id", name.alias("rep")).withColumn("__part", F.when(is_hot, F.pmod(F.xxhash64("id"), F.lit(HOT_PARTS))).otherwise(F.lit(0)))
    answer = answer.withColumnRenamed("rep", "__rep").withColumn("__of", F.explode(F.sequence(F.lit(0), F.when(F.col("__rep").isin(hot) if hot else F.lit(False), F.lit(HOT_PARTS - 1)).otherwise(F.lit(0)))))
    same = same.join(answer, (F.col("rep") == F.col("__rep")) & (F.col("__part") == F.col("__of"))).select("id", "n_links", "low")
    every = same.unionByName(rows.where(~F.col("sound")).select("id", F.lit(0).cast("long").alias("n_links"), F.lit(None).cast("long").alias("low")))
    out = every.select(F.col("id").alias("vec_id"), F.col("n_links").cast("long").alias("n_links"), F.coalesce("low", "id").alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
