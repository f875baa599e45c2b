"""SimHash near-dedup: 64-bit fingerprints of word shingles, exact tiled comparison within a Hamming radius."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import Forest, connected_components
from millrace.llm.scratch import fresh, materialize

#: Rows of one side of a numpy comparison.
TILE = 512
#: Fingerprints that one comparison task takes on average; larger groups are cut into pairs of tiles.
GROUP_ROWS = 4096


def _votes(h: np.ndarray) -> np.ndarray:
    """How many of the 64-bit hashes have each bit set; sums of 255 rows fit a byte."""
    rows = -len(h) % 255
    bits = np.unpackbits(np.concatenate([h, np.zeros(rows, h.dtype)]).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.add.reduce(bits.reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)


def _lane(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th independent hash made of a hash; the first is the hash itself."""
    if k == 0:
        return h
    x = h + np.uint64(k * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 (seed 42) of the shingles of a text, repeats included, in blocks; none if it has no words."""
    # bytes.lower and bytes.split treat exactly A-Z and exactly these six characters
    tokens = (text or "").encode().lower().split()
    if not tokens:
        return
    joined = b" ".join(tokens)
    ends = np.cumsum([len(t) + 1 for t in tokens]) - 1
    if len(tokens) <= shingle:
        starts, stops = [0], [len(joined)]
    else:
        starts = [0, *(ends[: len(tokens) - shingle] + 1).tolist()]
        stops = ends[shingle - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    step = 1 << 16  # bounds the memory that a very long text takes
    for k in range(0, len(starts), step):
        yield np.array([digest(joined[i:j], 42) for i, j in zip(starts[k : k + step], stops[k : k + step])], "<u8")


def shingle_set(text: str | None, shingle: int) -> np.ndarray:
    """The distinct hashes of a text's shingles, in order."""
    out = np.zeros(0, "<u8")
    for h in _hashes(text, shingle):
        out = np.union1d(out, h)
    return out


def signature(blocks: Iterable[np.ndarray], lanes: int) -> np.ndarray:
    """``lanes`` independent fingerprints of hashes: a bit is set if over half of them have it; all 0 without any."""
    counts, n = np.zeros((lanes, 64), np.int64), 0
    for h in blocks:
        n += len(h)
        for lane in range(lanes):
            counts[lane] += _votes(_lane(h, lane))
    return np.packbits(counts * 2 > n, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of ``text``: A-Z lowered, words split at space and U+0009-U+000D, ``shingle`` words joined by a space.

    Fewer words than ``shingle`` are one shingle; no word (or null) gives 0. A bit is set if it is set in over half of
    the shingles' XXH64 values (seed 42), repeats counted.
    """
    return int(signature(_hashes(text, shingle), 1)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``id, fp`` for each row of ``docs`` (fp: the 64 bits as a signed long)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = np.array([fingerprint(t.as_py(), shingle) for t in batch.column(1)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fp)], names=["id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "id long, fp long")


def tile_links(fp: np.ndarray, radius: int, same: Callable[[int, int], bool] | None = None) -> list[tuple[int, int]]:
    """Spanning links (positions) of all pairs of ``fp`` within ``radius``, by exclusive-or and bit counts of tiles.

    ``fp`` has a row of one or more 64-bit words for each fingerprint. With ``same``, only pairs for which it holds
    link; it is asked, nearest pairs first, about pairs that no links join yet.

    Rows are ordered by population count; a pair of tiles whose counts lie further apart than ``radius`` is skipped.
    """
    fp = fp.view(np.uint64).reshape(len(fp), -1)
    pops = np.bitwise_count(fp).sum(axis=1, dtype=np.int64)
    order = np.argsort(pops, kind="stable")
    fp, pops = fp[order], pops[order]
    forest = Forest(len(fp))
    for i in range(0, len(fp), TILE):
        left = fp[i : i + TILE]
        top = pops[min(i + TILE, len(fp)) - 1]
        for j in range(i, len(fp), TILE):
            if pops[j] - top > radius:
                break
            right = fp[j : j + TILE]
            far = np.zeros((len(left), len(right)), np.uint16)
            for lane in range(fp.shape[1]):
                far += np.bitwise_count(left[:, lane, None] ^ right[None, :, lane])
            near = far <= radius
            if i == j:
                near &= np.triu(np.ones(near.shape, bool), 1)
            x, y = np.nonzero(near)
            if same is None:
                forest.add(x + i, y + j)
                continue
            nearest = np.argsort(far[x, y], kind="stable")
            x, y = x[nearest] + i, y[nearest] + j
            for k in range(0, len(x), TILE):
                p, q = x[k : k + TILE], y[k : k + TILE]
                apart = forest.roots(p) != forest.roots(q)
                for a, b in zip(p[apart].tolist(), q[apart].tolist()):
                    if forest.root_of(a) != forest.root_of(b) and same(int(order[a]), int(order[b])):
                        forest.add(np.array([a]), np.array([b]))
    return [(int(order[x]), int(order[y])) for x, y in forest.links]


def _bands(radius: int) -> list[tuple[int, int]]:
    """(shift, width) of the radius + 1 parts of the 64 bits: two fingerprints within the radius agree on one part."""
    n = radius + 1
    edges = [round(64 * k / n) for k in range(n + 1)]
    return [(lo, hi - lo) for lo, hi in zip(edges, edges[1:])]


def near_links(distinct_fp: DataFrame, radius: int) -> DataFrame:
    """Links ``a, b`` that connect all fingerprints within ``radius`` of each other; ``distinct_fp`` has ``fp`` once each.

    Each fingerprint goes to the groups of its radius + 1 bands. Bands' values are hashed into so many groups that one
    holds about GROUP_ROWS; a band value with more than twice that many rows is instead dealt over pairs of tiles (by
    population count and hash), so that no task holds it whole; of those pairs, the ones whose population counts
    differ beyond the radius are not made. Exact: nothing is capped.
    """
    n = distinct_fp.count()
    groups = max(1, -(-n // GROUP_ROWS))
    band = [F.struct(F.lit(k).alias("band"), (F.shiftrightunsigned("fp", lo).bitwiseAND(F.lit((1 << width) - 1))).alias("value")) for k, (lo, width) in enumerate(_bands(radius))]
    rows = distinct_fp.select("fp", F.explode(F.array(*band)).alias("at")).select("fp", "at.band", "at.value")
    hot = rows.groupBy("band", "value").agg(F.count("*").alias("rows")).where(F.col("rows") > 2 * GROUP_ROWS)
    hot = hot.select("band", "value", F.ceil(F.col("rows") / GROUP_ROWS).cast("int").alias("tiles"))
    rows = rows.join(hot, ["band", "value"], "left")
    even = rows.where("tiles is null").select("fp", "band", F.pmod(F.xxhash64("value"), F.lit(groups)).alias("value"), F.lit("").alias("tile"))
    own = F.struct(F.bit_count("fp").alias("pop"), F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int").alias("part"))
    others = F.flatten(F.transform(F.sequence(F.lit(-radius), F.lit(radius)), lambda d: F.transform(F.sequence(F.lit(0), F.col("tiles") - 1), lambda s: F.struct((F.bit_count("fp") + d).alias("pop"), s.alias("part")))))
    paired = rows.where("tiles is not null").select("fp", "band", "value", own.alias("own"), F.explode(others).alias("other"))
    paired = paired.select("fp", "band", "value", F.concat_ws("/", *[F.concat_ws(":", f(F.col("own"), F.col("other")).pop, f(F.col("own"), F.col("other")).part) for f in (F.least, F.greatest)]).alias("tile"))

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy(np.int64)
        found = tile_links(fp, radius)
        return pd.DataFrame({"a": [fp[i] for i, _ in found], "b": [fp[j] for _, j in found]}, dtype="int64")

    return even.unionByName(paired).groupBy("band", "value", "tile").applyInPandas(link, "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2) -> DataFrame:
    """Return ``id, fp, component_id`` for each row of ``docs``: its fingerprint and the smallest id reachable by links.

    Two fingerprints link at ``radius`` or fewer differing bits. Null and empty texts have fingerprint 0 and link like
    any other. Repeated rows stay, with the same answer; a null id stays null and is never the smallest (a group of
    null ids alone has a null component). An empty table gives an empty result. Equal fingerprints are one node, so
    copies add no links.
    """
    prints = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("id").alias("first"), F.count("*").alias("rows")), "nodes")
    return _grouped(prints, nodes, "fp", near_links(nodes.select("fp"), radius))


def _grouped(prints: DataFrame, nodes: DataFrame, node: str, links: DataFrame) -> DataFrame:
    """``prints`` with ``component_id``, from the links between ``nodes`` (``node, first, rows``)."""
    joined = materialize(connected_components(links), "joined")
    roots = joined.select("node", "component").unionByName(joined.select(F.col("component").alias("node"), "component")).distinct()
    linked = nodes.join(roots, nodes[node] == roots.node).select(nodes[node], "first", "component")
    lows = linked.groupBy("component").agg(F.min("first").alias("low"))
    linked = linked.join(lows, "component").select(node, "low")
    copies = nodes.where("rows > 1").select(node, "first").join(linked.select(node), node, "left_anti").select(node, F.col("first").alias("low"))
    groups = linked.unionByName(copies)
    return prints.join(groups, node, "left").select("id", node, F.coalesce("low", "id").alias("component_id"))


# --- documents of a given similarity --------------------------------------------------------------------------------

#: 64-bit words of a signature, rows that a table's bucket should hold, and the share of pairs at the similarity that meet.
LANES, BUCKET_ROWS, RECALL = 6, 512, 0.999
#: Standard deviations of the bits that differ at the similarity, by which the radius of candidates lies beyond them.
DEVIATIONS = 4
#: Documents and shingles of one side of a task that compares shingle sets, about.
SET_ROWS, SET_SHINGLES = 2048, 1 << 20


def _angle(similarity: float) -> float:
    """Share of bits in which the signatures of two documents differ, whose shingle sets have this Jaccard similarity."""
    return math.acos(2 * similarity / (1 + similarity)) / math.pi


def signature_radius(similarity: float, lanes: int = LANES) -> int:
    """The bits that differ at ``similarity``, and DEVIATIONS standard deviations more, so that hardly such a pair is missed."""
    share, bits = _angle(similarity), 64 * lanes
    return round(share * bits + DEVIATIONS * math.sqrt(bits * share * (1 - share)))


def table_plan(n: int, similarity: float, lanes: int = LANES) -> list[np.ndarray]:
    """Bits of each table: so many that a bucket holds about BUCKET_ROWS of ``n`` rows, and so many tables that a pair at
    ``similarity`` shares a bucket with probability RECALL."""
    width = max(8, math.ceil(math.log2(max(2, n / BUCKET_ROWS))))
    tables = math.ceil(math.log(1 - RECALL) / math.log(1 - (1 - _angle(similarity)) ** width))
    rng = np.random.default_rng(11)
    order = np.concatenate([rng.permutation(64 * lanes) for _ in range(1 + tables * width // (64 * lanes))])
    return [order[k * width : (k + 1) * width] for k in range(tables)]


def _node(shingles: np.ndarray) -> int:
    """A name for a shingle set, as a signed long."""
    return int(np.uint64(xxhash.xxh64_intdigest(shingles.tobytes(), 7)).astype(np.int64))


def _signatures(docs: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """``id, node, sig, size`` of each row: the name, signature and size of its shingle set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for t in batch.column(1):
                one = shingle_set(t.as_py(), shingle)
                made.append((_node(one), signature([one], LANES).tobytes(), len(one)))
            nodes, sigs, sizes = zip(*made) if made else ((), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(nodes, pa.int64()), pa.array(sigs, pa.binary()), pa.array(sizes, pa.int64())], names=["id", "node", "sig", "size"])

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "id long, node long, sig binary, size long")


def _signature_links(nodes: DataFrame, similarity: float) -> DataFrame:
    """Links ``a, b`` that connect the signatures within the radius which share a bucket of a table.

    Buckets are dealt into groups of about GROUP_ROWS; one with more than twice as many rows is dealt over pairs of
    tiles, so that no task holds it whole. Signatures of unrelated texts lie far beyond the radius.
    """
    n = nodes.count()
    plan, radius, groups = table_plan(n, similarity), signature_radius(similarity), max(1, -(-n // GROUP_ROWS))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 2048):
                batch = whole.slice(start, 2048)
                bits = np.unpackbits(np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(batch.num_rows, -1), axis=1, bitorder="little")
                for k, at in enumerate(plan):
                    value = bits[:, at] @ (np.int64(1) << np.arange(len(at), dtype=np.int64))
                    yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(batch.num_rows, k, np.int32)), pa.array(value)], names=["node", "sig", "band", "value"])

    rows = nodes.select("node", "sig").mapInArrow(deal, "node long, sig binary, band int, value long")
    hot = rows.groupBy("band", "value").agg(F.count("*").alias("rows")).where(F.col("rows") > 2 * GROUP_ROWS)
    hot = materialize(hot.select("band", "value", F.ceil(F.col("rows") / GROUP_ROWS).cast("int").alias("tiles")), "hot")
    rows = rows.join(hot, ["band", "value"], "left")
    own = F.pmod("node", F.col("tiles")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1))
    rows = rows.withColumn("own", F.coalesce(own, F.lit(0))).withColumn("other", other)
    group = F.when(F.col("tiles").isNull(), F.pmod("value", F.lit(groups))).otherwise(F.col("value"))
    pair = F.when(F.col("tiles").isNull(), "").otherwise(F.concat_ws(":", F.least("own", "other"), F.greatest("own", "other")))

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("value", kind="stable")
        node, value = pdf["node"].to_numpy(np.int64), pdf["value"].to_numpy(np.int64)
        sig = np.frombuffer(b"".join(pdf["sig"]), "<u8").reshape(len(pdf), -1)
        cuts = np.concatenate([[0], np.nonzero(np.diff(value))[0] + 1, [len(value)]])
        found = [(i + x, i + y) for i, j in zip(cuts, cuts[1:]) if j - i > 1 for x, y in tile_links(sig[i:j], radius)]
        return pd.DataFrame({"a": [node[x] for x, _ in found], "b": [node[y] for _, y in found]}, dtype="int64")

    return rows.select("node", "sig", "band", "value", group.alias("group"), pair.alias("pair")).groupBy("band", "group", "pair").applyInPandas(link, "a long, b long")


def _similar_links(docs: DataFrame, nodes: DataFrame, similarity: float, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """Links ``a, b`` that connect the nodes whose shingle sets have this Jaccard similarity or more, by exact comparison.

    Candidates are the pairs within the radius of a component of ``_signature_links``. A component's sets are made
    again from the text of one document a node and compared in one task; components are dealt into groups of about
    SET_ROWS sets and SET_SHINGLES shingles, and a larger component is dealt over pairs of tiles of that size.
    """
    radius = signature_radius(similarity)
    chained = materialize(connected_components(_signature_links(nodes, similarity)), "chained")
    roots = chained.select("node", "component").unionByName(chained.select(F.col("component").alias("node"), "component")).distinct()
    members = materialize(roots.join(nodes.select("node", "first", "size"), "node"), "members")
    weight = F.greatest(F.count("*") / SET_ROWS, F.sum("size") / SET_SHINGLES)
    groups = max(1, math.ceil(members.agg(weight).first()[0] or 0))
    tiles = members.groupBy("component").agg(F.greatest(F.lit(1), F.ceil(weight)).cast("int").alias("tiles"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [shingle_set(t.as_py(), shingle) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array([_node(x) for x in made], pa.int64()), pa.array([x.tobytes() for x in made], pa.binary())], names=["node", "shingles"])

    # an id may stand for several texts: those that are no member's fall out when they are joined by node
    wanted = members.select(F.col("first").alias("id")).distinct()
    rows = docs.select(F.col(id_col).cast("long").alias("key"), F.col(text_col).alias("text"))
    texts = rows.join(wanted, rows.key.eqNullSafe(wanted.id), "left_semi").select("text")
    sets = texts.mapInArrow(run, "node long, shingles binary").join(members.join(tiles, "component").select("node", "component", "tiles"), "node")
    sets = sets.groupBy("node").agg(*[F.first(c).alias(c) for c in ("shingles", "component", "tiles")])
    own = F.pmod("node", F.col("tiles")).cast("int")
    sets = sets.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    group = F.when(F.col("tiles") == 1, F.pmod("component", F.lit(groups))).otherwise(F.col("component"))
    pair = F.when(F.col("tiles") == 1, "").otherwise(F.concat_ws(":", F.least("own", "other"), F.greatest("own", "other")))

    def link(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("component", kind="stable")
        node, component = pdf["node"].to_numpy(np.int64), pdf["component"].to_numpy(np.int64)
        made = [np.frombuffer(x, "<u8") for x in pdf["shingles"]]
        sig = np.array([signature([x], LANES) for x in made]).reshape(len(made), LANES)
        cuts = np.concatenate([[0], np.nonzero(np.diff(component))[0] + 1, [len(component)]])
        found = []
        for i, j in zip(cuts.tolist(), cuts[1:].tolist()):
            found += [(i + x, i + y) for x, y in tile_links(sig[i:j], radius, lambda x, y, i=i: jaccard(made[i + x], made[i + y]) >= similarity)]
        return pd.DataFrame({"a": [node[x] for x, _ in found], "b": [node[y] for _, y in found]}, dtype="int64")

    return sets.select("node", "shingles", "component", group.alias("group"), pair.alias("pair")).groupBy("group", "pair").applyInPandas(link, "a long, b long")


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sets of distinct values; 0 if one of them is empty."""
    if not len(a) or not len(b):
        return 0.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """Return ``id, node, component_id``: groups of documents linked by shingle sets of this Jaccard similarity or more.

    Each link is checked on the sets themselves. Candidates come from signatures of LANES SimHash fingerprints over
    distinct shingles, in which no more bits differ than ``signature_radius``. Which pairs are compared follows from
    tables of their bits, so the work grows little faster than the documents. Odd rows are treated as by
    ``near_duplicates``; texts with equal shingle sets are one node, texts without words too.
    """
    prints = materialize(_signatures(docs, id_col, text_col, shingle), "signatures")
    nodes = materialize(prints.groupBy("node").agg(F.first("sig").alias("sig"), F.first("size").alias("size"), F.min("id").alias("first"), F.count("*").alias("rows")), "nodes")
    links = materialize(_similar_links(docs, nodes, similarity, id_col, text_col, shingle), "similar")
    return _grouped(prints.select("id", "node"), nodes.select("node", "first", "rows"), "node", links)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """``docs`` without the near-duplicates: of each group the row with the smallest id stays, columns as they came.

    Rows without an id stay, as nothing tells them apart. Of rows that repeat both id and text one stays; the extra
    step for that is taken only if some id repeats.
    """
    groups = materialize(similar_documents(docs, id_col, text_col, shingle, similarity), "groups")
    gone = groups.where(F.col("id") != F.col("component_id")).select(F.col("id").alias(key := fresh(docs, "__gone"))).distinct()
    repeats = groups.where("id is not null").groupBy("id").agg(F.count("*").alias("rows")).where("rows > 1")
    if not repeats.isEmpty():
        named = docs.where(F.col(id_col).isNotNull()).dropDuplicates([id_col, text_col])
        docs = named.unionByName(docs.where(F.col(id_col).isNull()))
    return docs.join(gone, docs[id_col] == gone[key], "left_anti")
