"""Line dedup: a sharded minimal perfect hash over all distinct line keys indexes compact arrays that documents probe."""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import fresh, materialize

SPACES = " \t\n\x0b\x0c\r"
#: Rows of counts from which one shard of the index is built, about.
SHARD_ROWS = 1 << 20
#: Where the frequent part of the index has at most so many bytes, it is sent to every executor; else line hashes go to the shards.
BROADCAST_BYTES = 64 << 20
#: Probes of one shard that a task takes in that case, about.
PROBE_ROWS = 1 << 20
_MASK = (1 << 64) - 1
#: In place of a null id: below all others.
NO_ID = -(1 << 63)


def line_key(line: str) -> str:
    """The line without space and U+0009-U+000D at both ends. (A-Z are lowered when it is hashed.)"""
    return line.strip(SPACES)


def key_hashes(text: str | None, min_chars: int) -> tuple[list[str], list[int], list[int], list[int]]:
    """Lines of ``text``, then the positions of those with a key of ``min_chars`` or more, and two hashes of each key."""
    lines = (text or "").split("\n")
    at, first, second = [], [], []
    for k, line in enumerate(lines):
        if len(line) >= min_chars and len(key := line.strip(SPACES)) >= min_chars:
            data = key.encode().lower()  # bytes.lower changes A-Z only
            at.append(k)
            first.append(xxhash.xxh64_intdigest(data, 42))
            second.append(xxhash.xxh64_intdigest(data, 1042))
    return lines, at, first, second


# --- minimal perfect hash -------------------------------------------------------------------------------------------


def _mix(keys: np.ndarray, level: int, size: int) -> np.ndarray:
    """Position of each key in a level of ``size`` bits."""
    x = keys ^ np.uint64((level * 0x9E3779B97F4A7C15 + 0x7F4A7C15) & _MASK)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(31))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash of distinct 64-bit keys: levels of bit arrays, in which a bit is set where one key fell alone.

    A key's index is the number of set bits before its own, so n keys take the indexes 0 to n - 1 at about three bits
    a key. Keys that no level resolves are kept in a sorted tail. A key that was not indexed gets some index, or -1.
    """

    def __init__(self, keys: np.ndarray) -> None:
        self.levels: list[tuple[int, np.ndarray, np.ndarray]] = []
        left, done = np.unique(keys.astype(np.uint64)), 0
        while len(left) and len(self.levels) < 40:
            size = max(64, 2 * len(left) + 63 & ~63)
            at = _mix(left, len(self.levels), size)
            alone = np.bincount(at, minlength=size) == 1
            bits = np.packbits(alone, bitorder="little").view("<u8")
            ranks = done + np.concatenate([[0], np.cumsum(np.bitwise_count(bits).astype(np.int64))[:-1]])
            self.levels.append((size, bits, ranks))
            done += int(alone.sum())
            left = left[~alone[at]]
        self.tail, self.base = left, done

    def index(self, keys: np.ndarray) -> np.ndarray:
        keys = keys.astype(np.uint64)
        out = np.full(len(keys), -1, np.int64)
        open_ = np.arange(len(keys))
        for level, (size, bits, ranks) in enumerate(self.levels):
            if not len(open_):
                return out
            at = _mix(keys[open_], level, size)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            hit = (bits[word] >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(bits[word[hit]] & ((np.uint64(1) << bit[hit]) - np.uint64(1)))
            out[open_[hit]] = ranks[word[hit]] + below
            open_ = open_[~hit]
        if len(self.tail) and len(open_):
            at = np.minimum(np.searchsorted(self.tail, keys[open_]), len(self.tail) - 1)
            same = self.tail[at] == keys[open_]
            out[open_[same]] = self.base + at[same]
        return out


class Shard:
    """Arrays in the order of a perfect hash: the second hash of each key as fingerprint, its documents, the last of them."""

    def __init__(self, h1: np.ndarray, h2: np.ndarray, n_docs: np.ndarray, last: np.ndarray) -> None:
        """Rows of partial counts: those of a key are added up at the index that the hash gives it."""
        firsts = np.unique(h1, return_index=True)[1]
        self.hash = PerfectHash(h1[firsts])
        slot = self.hash.index(h1)
        self.fingerprint = np.zeros(len(firsts), np.uint64)
        self.fingerprint[slot[firsts]] = h2[firsts]
        own = self.fingerprint[slot] == h2
        self.n_docs = np.zeros(len(firsts), np.int64)
        self.last = np.full(len(firsts), NO_ID, np.int64)
        np.add.at(self.n_docs, slot[own], n_docs[own])
        np.maximum.at(self.last, slot[own], last[own])
        # keys that share the first hash with another (not expected below 2^32 keys a shard) are kept beside the arrays
        self.same: dict[tuple[int, int], tuple[int, int]] = {}
        for k in np.nonzero(~own)[0].tolist():
            n, at = self.same.get(pair := (int(h1[k]), int(h2[k])), (0, NO_ID))
            self.same[pair] = (n + int(n_docs[k]), max(at, int(last[k])))

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The documents that hold each key (0 if it is not indexed), and the last of them."""
        slot = self.hash.index(h1)
        n_docs, last = np.zeros(len(h1), np.int64), np.full(len(h1), NO_ID, np.int64)
        if len(self.fingerprint):
            found = (slot >= 0) & (self.fingerprint[np.maximum(slot, 0)] == h2)
            n_docs[found], last[found] = self.n_docs[slot[found]], self.last[slot[found]]
        for k in np.nonzero(n_docs == 0)[0].tolist() if self.same else ():
            n_docs[k], last[k] = self.same.get((int(h1[k]), int(h2[k])), (0, NO_ID))
        return n_docs, last


def frequent(h1: np.ndarray, h2: np.ndarray, shard: Shard, min_docs: int) -> np.ndarray:
    """Rows of hash, hash, documents and last document: the keys ``h1, h2`` of a shard with ``min_docs`` documents or more."""
    n_docs, last = shard.probe(h1, h2)
    often = n_docs >= min_docs
    return np.unique(np.stack([h1[often].view(np.int64), h2[often].view(np.int64), n_docs[often], last[often]], axis=1), axis=0)


# --- Spark ----------------------------------------------------------------------------------------------------------


def _counted_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """``h1, h2, n_docs, last``: the keys of the rows of ``docs``, counted once a row and added up within each batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: dict[tuple[int, int], list[int]] = {}
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                i = NO_ID if i is None else i
                _, _, first, second = key_hashes(text.as_py(), min_chars)
                for key in dict.fromkeys(zip(first, second)):
                    if (had := counts.get(key)) is None:
                        counts[key] = [1, i]
                    else:
                        had[0] += 1
                        had[1] = max(had[1], i)
            hashes = np.array(list(counts), np.uint64).reshape(-1, 2).view(np.int64)
            values = np.array(list(counts.values()), np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(hashes[:, 0]), pa.array(hashes[:, 1]), pa.array(values[:, 0]), pa.array(values[:, 1])], names=["h1", "h2", "n_docs", "last"])

    return docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).mapInArrow(run, "h1 long, h2 long, n_docs long, last long")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5) -> tuple[DataFrame, int]:
    """``shard, blob, often, probes`` of each shard of the index, and the number of shards.

    All distinct keys of ``min_chars`` or more code points are indexed: ``blob`` holds the shard, and ``often`` its
    keys in ``min_docs`` or more rows with their counts. Batches count their own lines before they are dealt out, so a line
    of a third of all documents is a row a batch; what is dealt is hashes, never lines.
    """
    lines = materialize(_counted_lines(docs, id_col, text_col, min_chars), "line-keys")
    shards = max(1, -(-lines.count() // SHARD_ROWS))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        h1, h2 = (pdf[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        shard = Shard(h1, h2, pdf["n_docs"].to_numpy(np.int64), pdf["last"].to_numpy(np.int64))
        often = frequent(h1, h2, shard, min_docs)
        return pd.DataFrame({"shard": [int(pdf["shard"].iloc[0])], "blob": [pickle.dumps(shard, protocol=5)], "often": [often.tobytes()], "probes": [int(pdf["n_docs"].sum())]})

    dealt = lines.withColumn("shard", F.pmod("h1", F.lit(shards)))
    return materialize(dealt.groupBy("shard").applyInPandas(build, "shard long, blob binary, often binary, probes long"), "line-index"), shards


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 40, min_docs: int = 5, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``docs`` with ``kept_text, n_lines, n_dropped`` (names lengthened on a clash): the texts without repeated lines.

    A line's key is the line stripped of space and U+0009-U+000D at both ends with A-Z lowered. Keys of ``min_chars``
    or more code points found in ``min_docs`` or more rows lose all their lines except in the rows with the largest id
    that holds them. Null and empty texts are one empty line and give an empty text. Repeated rows count as documents
    and get the same answer. A null id is below all others: such rows lose the lines that a row with an id holds, and
    keep those that only rows without one hold. An empty table gives an empty result.

    Where the frequent part of the index has at most ``broadcast_bytes``, as measured, it goes to the executors, and
    texts are read once more but never shuffled. Else line hashes (never lines) are dealt to the shards, in as many
    parts a shard as its probes need, and the hashes that a document loses come back to it.
    """
    index, shards = build_index(docs, id_col, text_col, min_chars, min_docs)
    size = index.agg(F.sum(F.length("often"))).first()[0] or 0
    names = [fresh(docs, n) for n in ("kept_text", "n_lines", "n_dropped")]
    drops_col = fresh(docs, "__drops")
    if size <= broadcast_bytes:
        often = np.frombuffer(b"".join(bytes(r["often"]) for r in index.select("often").toLocalIterator()), np.int64).reshape(-1, 4)
        sent = docs.sparkSession.sparkContext.broadcast(Shard(often[:, 0].view(np.uint64), often[:, 1].view(np.uint64), often[:, 2], often[:, 3]))
        source, drops_col = docs, None
    else:
        sent = None
        drops = _drops_by_shard(docs, id_col, text_col, min_chars, min_docs, index, shards, drops_col)
        source = docs.join(drops, F.xxhash64(F.col(id_col), F.col(text_col)) == F.col(f"{drops_col}_key"), "left").drop(f"{drops_col}_key")
    place = source.columns.index
    i_at, t_at, d_at = place(id_col), place(text_col), place(drops_col) if drops_col else None
    kept_columns = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = batch.columns
            ids = [NO_ID if i is None else i for i in columns[i_at].cast(pa.int64()).to_pylist()]
            found = [key_hashes(t, min_chars) for t in columns[t_at].to_pylist()]
            if sent:  # all keys of the batch at once
                one, two = (np.fromiter((h for f in found for h in f[k]), np.uint64) for k in (2, 3))
                n_docs, last = sent.value.probe(one, two)
                gone = iter(((n_docs >= min_docs) & (last != np.repeat(np.array(ids, np.int64), [len(f[1]) for f in found]))).tolist())
            else:
                lists = ({(x["h1"] & _MASK, x["h2"] & _MASK) for x in pairs or ()} for pairs in columns[d_at].to_pylist())
                gone = iter([pair in pairs for f, pairs in zip(found, lists) for pair in zip(f[2], f[3])])
            kept, n_lines, n_dropped = [], [], []
            for lines, at, *_ in found:
                dropped = {k for k, g in zip(at, gone) if g}
                kept.append("\n".join([x for k, x in enumerate(lines) if k not in dropped] if dropped else lines))
                n_lines.append(len(lines))
                n_dropped.append(len(dropped))
            out = [*columns[:kept_columns], pa.array(kept, pa.string()), pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())]
            yield pa.RecordBatch.from_arrays(out, names=[f"c{k}" for k in range(len(out))])

    flat = source.toDF(*[f"c{k}" for k in range(len(source.columns))])
    schema = ", ".join(f"c{k} {f.dataType.simpleString()}" for k, f in enumerate([*docs.schema.fields])) + f", c{kept_columns} string, c{kept_columns + 1} long, c{kept_columns + 2} long"
    return flat.mapInArrow(run, schema).toDF(*docs.columns, *names)


def _drops_by_shard(docs: DataFrame, id_col: str, text_col: str, min_chars: int, min_docs: int, index: DataFrame, shards: int, out: str) -> DataFrame:
    """``{out}_key, out``: the key hashes that each row loses (by a hash of its id and text), found shard by shard.

    A shard's probes are dealt by document into parts of about PROBE_ROWS, so a line of a third of all documents is
    many parts; the number of parts a shard is a number a shard, and goes to the tasks.
    """
    parts = {r["shard"]: -(-r["probes"] // PROBE_ROWS) for r in index.select("shard", "probes").toLocalIterator()}
    sent = docs.sparkSession.sparkContext.broadcast(parts)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for key, i, text in zip(*(batch.column(k).to_pylist() for k in range(3))):
                _, _, first, second = key_hashes(text, min_chars)
                rows += [(key, NO_ID if i is None else i, *pair) for pair in dict.fromkeys(zip(first, second))]
            table = np.array([(k & _MASK, i & _MASK, x, y) for k, i, x, y in rows], np.uint64).reshape(-1, 4).view(np.int64)
            shard = table[:, 2] % np.int64(shards)
            part = table[:, 0].view(np.uint64) % np.array([sent.value.get(s, 1) for s in shard.tolist()], np.uint64)
            columns = [*(table[:, k] for k in range(4)), shard, part.astype(np.int64)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["key", "id", "h1", "h2", "shard", "part"])

    keyed = docs.select(F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"), F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    probes = keyed.mapInArrow(deal, "key long, id long, h1 long, h2 long, shard long, part long")
    copies = index.select("shard", "blob", F.explode(F.sequence(F.lit(0), F.greatest(F.lit(1), F.ceil(F.col("probes") / PROBE_ROWS)) - 1)).alias("part"))

    def probe(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return left[["key", "h1", "h2"]].head(0)
        one, two = (left[c].to_numpy(np.int64).view(np.uint64) for c in ("h1", "h2"))
        n_docs, last = pickle.loads(bytes(right["blob"].iloc[0])).probe(one, two)
        return left.loc[(n_docs >= min_docs) & (last != left["id"].to_numpy(np.int64)), ["key", "h1", "h2"]]

    drops = probes.groupBy("shard", "part").cogroup(copies.groupBy("shard", "part")).applyInPandas(probe, "key long, h1 long, h2 long")
    return drops.distinct().groupBy(F.col("key").alias(f"{out}_key")).agg(F.collect_list(F.struct("h1", "h2")).alias(out))
