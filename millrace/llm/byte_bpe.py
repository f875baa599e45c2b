"""Byte-level BPE: ranks compiled into a lazily determinised finite-state transducer; decoding by a UTF-8 state machine."""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.scratch import fresh

#: States and arcs of a generation; a transducer keeps two, so memory is bounded on any text.
MAX_STATES = 70_000
MAX_ARCS = 150_000
#: Matches whose ids a worker remembers, and the longest that it remembers.
MAX_KNOWN = 200_000
MAX_KNOWN_CHARS = 48
#: Tokens below a node of the trie up to which they are listed.
FEW = 8


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank, from a file with a base64 token and its rank a line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in lines if line.strip())}


def merge(piece: bytes, ranks: dict[bytes, int], least: int = 1) -> list[bytes]:
    """Plain byte-pair merging: join the adjacent pair of lowest rank, the first of equals, until none has a rank.

    Stops at ``least`` parts.
    """
    parts = [piece[k : k + 1] for k in range(len(piece))]
    while len(parts) > least:
        best = min(range(len(parts) - 1), key=lambda k: ranks.get(parts[k] + parts[k + 1], 1 << 60))
        if parts[best] + parts[best + 1] not in ranks:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return parts


class Transducer:
    """Bytes in, token ids out, left to right, each token as soon as the bytes read leave no other.

    A list of tokens is the BPE of its bytes exactly if each neighbouring pair is the BPE of its own bytes, and each
    byte string has one such list. So a nondeterministic transducer reads tokens along a trie and lets a token follow
    another only if the two are such a pair. It is determinised as bytes arrive: a state is the set of the readings
    that are still open, each with the tokens it has read beyond those that all share (the lookahead, bounded since
    readings that lead nowhere drop out), its last token, and its place in the trie. What all readings share is emitted
    on the arc. Arcs are made when first taken and kept. A full set of them becomes the older generation, from which those
    that are met again are taken over; the one before it is dropped.
    """

    def __init__(self, ranks: dict[bytes, int]) -> None:
        self.ranks = ranks
        self.tokens = {rank: token for token, rank in ranks.items()}
        self.whole: dict[int, bool] = {}
        self.parts: dict[int, tuple[int, int] | None] = {}
        # trie: arcs by node * 256 + byte; token that ends at a node
        self.child: dict[int, int] = {}
        self.ends: list[int] = [-1]
        for token, rank in ranks.items():
            node = 0
            for byte in token:
                at = node << 8 | byte
                if (nxt := self.child.get(at)) is None:
                    nxt = self.child[at] = len(self.ends)
                    self.ends.append(-1)
                node = nxt
            self.ends[node] = rank
        # the tokens strictly below each node, where they are few
        self.below: list[tuple[int, ...] | None] = [()] * len(self.ends)
        for at, nxt in sorted(self.child.items(), key=lambda arc: -arc[1]):  # children have larger numbers
            own = (self.ends[nxt],) if self.ends[nxt] >= 0 else ()
            held, deeper = self.below[at >> 8], self.below[nxt]
            few = None if held is None or deeper is None else (*held, *own, *deeper)
            self.below[at >> 8] = None if few is None or len(few) > FEW else few
        self.number, self.states, self.arcs = {}, [], {}
        self._restart()

    def _restart(self) -> None:
        """Begin a generation; the present one becomes the older one."""
        self.older = self.number, self.states, self.arcs
        self.number: dict[tuple, int] = {((-1, 0, ()),): 0}
        self.states: list[tuple] = [((-1, 0, ()),)]
        self.final: list[tuple[int, ...] | None] = [()]
        self.arcs: dict[int, tuple[int, tuple[int, ...]]] = {}
        self.allowed: dict[int, tuple[int, ...]] = {}

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose merge made ``token``, the last of the merges of its bytes; None: no merge makes it."""
        if token not in self.parts:
            parts = merge(self.tokens[token], self.ranks, 2)
            self.parts[token] = (self.ranks[parts[0]], self.ranks[parts[1]]) if len(parts) == 2 else None
        return self.parts[token]

    def _usable(self, token: int) -> bool:
        """Whether merging the token's own bytes gives the token."""
        if (known := self.whole.get(token)) is None:
            known = self.whole[token] = len(merge(self.tokens[token], self.ranks)) == 1
        return known

    def _follows(self, last: int, token: int) -> bool:
        """Whether no merge joins the two tokens anywhere across the boundary between them.

        Goes back through the merges of both: of the two parts that touch, the one that was made later is undone, and a
        merge of the touching parts that would have come before that one shows that it would have been done first.
        """
        if not self._usable(token):
            return False
        if last < 0:
            return True
        tokens, rank_of, a, b, before = self.tokens, self.ranks.get, last, token, 1 << 60
        while True:
            if rank_of(tokens[a] + tokens[b], before) < before:
                return False
            made_a, made_b = (a if len(tokens[a]) > 1 else -1), (b if len(tokens[b]) > 1 else -1)
            if made_a > made_b:
                before, a = a, self._split(a)[1]
            elif made_b >= 0:
                # of equal ranks the left pair is merged first
                before, b = b + 1, self._split(b)[0]
            else:
                return True

    def _arc(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """Make the arc from ``state`` on ``byte``: the state that it leads to and the tokens on it.

        Readings stay in the order of the places where their current tokens began. Where few tokens lie below a node, the
        last token is replaced by those of them that may follow it; a reading that none may follow is dropped at once.
        """
        number, states, arcs = self.older
        if (known := arcs.get(number.get(self.states[state], -1) << 8 | byte)) is not None:
            return self._keep(state, byte, states[known[0]], known[1])
        open_, done, child, below = [], None, self.child, self.below
        for last, node, pending in self.states[state]:
            nxt = child.get(node << 8 | byte)
            if nxt is None:
                continue
            token = self.ends[nxt]
            if token >= 0 and (token in last if type(last) is tuple else self._follows(last, token)):
                done = (token, 0, (*pending, token))
            few = below[nxt]
            if few is not None:
                if type(last) is tuple:
                    last = last if len(few) >= len(last) and all(t in few for t in last) else tuple([t for t in last if t in few])
                else:
                    known = self.allowed.get(last << 32 | nxt)
                    if known is None:
                        known = self.allowed[last << 32 | nxt] = tuple([t for t in few if self._follows(last, t)])
                    last = known
                if not last:
                    continue
            open_.append((last, nxt, pending))
        if done:
            open_.append(done)
        out = os.path.commonprefix([pending for *_, pending in open_]) if open_ and open_[0][2] else ()
        n = len(out)
        return self._keep(state, byte, tuple([(last, node, pending[n:]) for last, node, pending in open_] if n else open_), out)

    def _keep(self, state: int, byte: int, key: tuple, out: tuple[int, ...]) -> tuple[int, tuple[int, ...]]:
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
            self.final.append(next((pending for _, node, pending in key if node == 0), None))
        arc = self.arcs[state << 8 | byte] = (to, out)
        return arc

    def run(self, piece: bytes) -> list[int]:
        """Ids of one match."""
        if len(self.states) > MAX_STATES or len(self.arcs) > MAX_ARCS:
            self._restart()
        arcs, state, out = self.arcs, 0, []
        for byte in piece:
            arc = arcs.get(state << 8 | byte)
            if arc is None:
                if len(self.states) > 4 * MAX_STATES:  # within one long match: replay what is pending from a new start
                    kept = self.states[state]
                    self._restart()
                    state = self.number[kept] = len(self.states)
                    self.states.append(kept)
                    self.final.append(next((pending for _, node, pending in kept if node == 0), None))
                    arcs = self.arcs
                arc = self._arc(state, byte)
            state, tokens = arc
            if tokens:
                out += tokens
        rest = self.final[state]
        if rest is None:
            raise ValueError("no tokens for these bytes: the ranks lack a single byte")
        out += rest
        return out


class Encoder:
    """Encodes whole texts match by match; ids are little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.machine = Transducer(ranks)
        self.known: dict[str, bytes] = {}

    def _piece(self, piece: str) -> bytes:
        data = piece.encode()
        rank = self.ranks.get(data)
        ids = self.machine.run(data) if rank is None else [rank]
        packed = np.array(ids, "<u4").tobytes()
        if len(piece) <= MAX_KNOWN_CHARS:
            if len(self.known) >= MAX_KNOWN:
                self.known.clear()
            self.known[piece] = packed
        return packed

    def encode(self, text: str | None) -> bytes:
        known, make = self.known.get, self._piece
        return b"".join([known(p) or make(p) for p in self.find(text or "")])


class Utf8Machine:
    """Incremental UTF-8: ``feed`` returns the characters that are complete and keeps the bytes of one that is not.

    The state is the number of continuation bytes still due and the range that the next one must lie in, which rules
    out overlong forms, surrogates and code points past U+10FFFF. Bytes that cannot go on become U+FFFD, one for each
    longest started sequence, as in the Unicode standard. The machine steps over the bytes at both ends of a chunk; what
    lies between begins and ends between characters and is decoded at once.
    """

    def __init__(self) -> None:
        self._start()

    def _start(self) -> None:
        self.held, self.due, self.low, self.high = b"", 0, 0x80, 0xBF

    @staticmethod
    def _lead(byte: int) -> tuple[int, int, int]:
        """Continuation bytes due after ``byte``, and the range of the first of them."""
        if 0xC2 <= byte <= 0xDF:
            return 1, 0x80, 0xBF
        if 0xE0 <= byte <= 0xEF:
            return 2, 0xA0 if byte == 0xE0 else 0x80, 0x9F if byte == 0xED else 0xBF
        if 0xF0 <= byte <= 0xF4:
            return 3, 0x90 if byte == 0xF0 else 0x80, 0x8F if byte == 0xF4 else 0xBF
        return 0, 0x80, 0xBF

    def step(self, byte: int) -> str:
        """Read one byte: the characters that it ends."""
        broken = ""
        if self.due:
            if self.low <= byte <= self.high:
                held, due = self.held + bytes([byte]), self.due - 1
                self._start()
                if not due:
                    return held.decode()
                self.held, self.due = held, due
                return ""
            broken = "\ufffd"
            self._start()
        self.due, self.low, self.high = self._lead(byte)
        if self.due:
            self.held = bytes([byte])
            return broken
        return broken + (chr(byte) if byte < 0x80 else "\ufffd")

    def feed(self, chunk: bytes) -> str:
        out, begin, end = [], 0, len(chunk)
        while self.due and begin < end:
            out.append(self.step(chunk[begin]))
            begin += 1
        # no character goes past a lead byte, and one that begins four bytes from the end is complete or broken
        last = next((k for k in range(end - 1, max(begin, end - 3) - 1, -1) if chunk[k] >= 0xC0), end)
        out.append(chunk[begin:last].decode("utf-8", "replace"))
        out += [self.step(byte) for byte in chunk[last:]]
        return "".join(out)

    def close(self) -> str:
        rest = "\ufffd" if self.due else ""
        self._start()
        return rest


class Decoder:
    """Bytes and text of ids."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        size = max(ranks.values(), default=-1) + 1
        self.tokens: list[bytes | None] = [None] * size
        for token, rank in ranks.items():
            self.tokens[rank] = token

    def stream(self, packed: bytes, step: int = 1 << 14) -> Iterator[bytes]:
        """The bytes of the ids, a chunk of ``step`` ids at a time."""
        table = self.tokens
        ids = np.frombuffer(packed, "<u4")
        for k in range(0, len(ids), step):
            yield b"".join([table[i] for i in ids[k : k + step].tolist()])

    def text(self, chunks: Iterable[bytes]) -> Iterator[str]:
        """Characters as soon as they are complete."""
        machine = Utf8Machine()
        for chunk in chunks:
            if out := machine.feed(chunk):
                yield out
        if out := machine.close():
            yield out


#: What a worker process keeps from one task to the next: an encoder's arcs and a decoder's table, of one vocabulary each.
_KEPT: dict[str, tuple[tuple, Encoder | Decoder]] = {}


class Coders:
    """A vocabulary on its way to the tasks.

    The ranks are read on the driver and broadcast; a worker process builds the transducer once and goes on with the
    arcs made in earlier tasks, which changes no result: an arc depends on the ranks alone, and the arcs kept are bounded.
    """

    def __init__(self, docs: DataFrame, ranks_path: str, pattern: str | None = None) -> None:
        ranks = read_ranks(ranks_path)
        self.sent, self.pattern = docs.sparkSession.sparkContext.broadcast(ranks), pattern
        self.mark = hashlib.sha256(repr(sorted(ranks.items())).encode()).hexdigest()

    def _kept(self, kind: str, key: tuple, make: Callable[[], Encoder | Decoder]) -> Encoder | Decoder:
        if kind not in _KEPT or _KEPT[kind][0] != key:
            _KEPT[kind] = key, make()
        return _KEPT[kind][1]

    def encoder(self) -> Encoder:
        return self._kept("encoder", (self.mark, self.pattern), lambda: Encoder(self.sent.value, self.pattern))

    def decoder(self) -> Decoder:
        return self._kept("decoder", (self.mark,), lambda: Decoder(self.sent.value))


def encode(docs: DataFrame, ranks_path: str, pattern: str, text_col: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (name lengthened on a clash): each whole text's token ids as an array of long.

    Null and empty texts have no ids. Special tokens' strings are ordinary text. Repeated rows get equal ids; an empty
    table gives an empty result. Each match of ``pattern`` is encoded separately; ``ranks_path`` is read on the driver
    and sent to the executors (a vocabulary's size, whatever the input).
    """
    coders = Coders(docs, ranks_path, pattern)
    at, n = docs.columns.index(text_col), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = coders.encoder()
        for batch in batches:
            for part in _slices(batch, at):
                ids = [np.frombuffer(encoder.encode(t.as_py()), "<u4").astype(np.int64) for t in part.column(at)]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(ids, pa.list_(pa.int64()))], names=[f"c{k}" for k in range(n + 1)])

    flat = docs.toDF(*[f"c{k}" for k in range(n)])
    schema = ", ".join(f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(docs.schema.fields)) + f", c{n} array<long>"
    return flat.mapInArrow(run, schema).toDF(*docs.columns, fresh(docs, "ids"))


def decode(docs: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """``docs`` with ``decoded`` (name lengthened on a clash): the text of the ids; null ids give an empty text."""
    coders = Coders(docs, ranks_path)
    at, n = docs.columns.index(ids_col), len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = coders.decoder()
        for batch in batches:
            texts = ["".join(decoder.text(decoder.stream(np.array(x or [], "<u4").tobytes()))) for x in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())], names=[f"c{k}" for k in range(n + 1)])

    flat = docs.toDF(*[f"c{k}" for k in range(n)])
    schema = ", ".join(f"c{k} {f.dataType.simpleString()}" for k, f in enumerate(docs.schema.fields)) + f", c{n} string"
    return flat.mapInArrow(run, schema).toDF(*docs.columns, fresh(docs, "decoded"))


def _slices(batch: pa.RecordBatch, at: int, most: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows with about ``most`` bytes of text, so that ids of long texts are not all held at once."""
    start, held = 0, 0
    for k, value in enumerate(batch.column(at)):
        held += len(value.as_buffer()) if value.is_valid else 0
        if held >= most:
            yield batch.slice(start, k + 1 - start)
            start, held = k + 1, 0
    if start < batch.num_rows:
        yield batch.slice(start)


def digests(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256, decoded_chars`` of each row: encoded, then decoded from the ids again.

    The ids of a text are hashed where they are made instead of being sent on; decoded bytes are hashed a chunk at a
    time, and their characters counted by the UTF-8 machine. Null texts count as empty, null ids stay null, repeated
    rows get equal rows, other columns (of whatever names) are not read, and an empty table gives no rows.
    """
    coders = Coders(docs, ranks_path, pattern)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = coders.encoder(), coders.decoder()
        for batch in batches:
            counts, ids, decoded, chars = [], [], [], []
            for value in batch.column(1):
                packed = encoder.encode(value.as_py())
                counts.append(len(packed) // 4)
                ids.append(hashlib.sha256(packed).hexdigest())
                digest, machine, n = hashlib.sha256(), Utf8Machine(), 0
                for chunk in decoder.stream(packed):
                    digest.update(chunk)
                    n += len(machine.feed(chunk))
                decoded.append(digest.hexdigest())
                chars.append(n + len(machine.close()))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(ids, pa.string()), pa.array(decoded, pa.string()), pa.array(chars, pa.int64())], names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "decoded_chars"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, decoded_chars long")
