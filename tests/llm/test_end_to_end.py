"""Whole queries on whole small tables against plain versions of them."""

from __future__ import annotations

import collections
import hashlib
import itertools

import public_tokenizers
import tiktoken
from pyspark.sql import functions as F
from test_text_operators import RANKS, brute_fingerprint, brute_lines, brute_targets, components, plain_language, words_of
from tiktoken.load import load_tiktoken_bpe

from millrace.llm import language_id, queries


def test_near_dedup_query_against_all_pairs(spark, sf, tmp_path):
    """Fingerprint and component of every row; copies, near copies, chains and texts without words are added to the table."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    words = [f"w{k}" for k in range(400)]
    chain = [" ".join(words[:k] + [f"x{j}" for j in range(k)] + words[k:]) for k in range(12)]
    more = [(900_000 + k, t) for k, t in enumerate([*chain, rows[0][1], (rows[1][1] or "") + " end", "", None, " \n"])]
    fields = {"doc_id": "id", "text": "text"}
    extra = spark.createDataFrame(more, "id long, text string")
    full = docs.unionByName(extra.select(*[F.col(fields[c]).alias(c) if c in fields else F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns]))
    full.write.parquet(f"{tmp_path}/documents.parquet")
    prints = {i: brute_fingerprint(t, 3) for i, t in rows + more}
    links = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2]
    root = components(sorted(prints), links)
    got = queries.op2_simhash_near_dedup(spark, str(tmp_path)).collect()
    assert {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in got} == {(i, f"{p:016x}", root[i]) for i, p in prints.items()}
    assert len(got) == len(prints) > len(set(root.values()))


def test_pipeline_against_plain_stages(spark, sf):
    """Every stage on what the plain version of the one before keeps; the mix by its targets, its whole copies and its limits."""
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = {r["doc_id"]: r for r in docs.collect()}

    dictionaries = language_id.learn(docs)
    texts = {}
    for i, r in rows.items():
        if any(c.isalpha() for c in r["text"] or "") and plain_language(r["text"], dictionaries)[1] >= 0.01:
            texts[i] = r["text"]
    out = stages["language_id"](spark, docs, sf)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == texts and len(texts) < len(rows)

    texts = {i: text for i, _, _, text in brute_lines(list(texts.items()), 5)}
    out = stages["line_dedup"](spark, out, sf)
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in out.collect()} == {i: (t, len(t)) for i, t in texts.items()}

    sets = {i: {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if (w := words_of(fold(t))) else set() for i, t in texts.items()}
    links = [(a, b) for a, b in itertools.combinations(sets, 2) if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = components(sorted(sets), links)
    texts = {i: t for i, t in texts.items() if root[i] == i}
    out = stages["simhash_near_dedup"](spark, out, sf)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == texts and len(texts) < len(sets)

    sizes, taken = collections.Counter(), collections.Counter()
    for i, t in texts.items():
        sizes[rows[i]["source"]] += len(words_of(t))
    targets = brute_targets(sizes)
    out = spark.createDataFrame(stages["mixing"](spark, out, sf).collect(), docs.schema)
    copies = collections.Counter((r["doc_id"], r["text"]) for r in out.collect())
    for i, t in texts.items():
        source = rows[i]["source"]
        taken[source] += copies[i, t] * len(words_of(t))
        assert not words_of(t) or int(targets[source] / sizes[source] + 1e-9) <= copies[i, t] <= 3
    assert {i for i, _ in copies} <= texts.keys() and all(texts[i] == t for i, t in copies)
    assert all(abs(taken[s] - targets[s]) <= 0.02 * targets[s] + 20 for s in targets)

    library = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=load_tiktoken_bpe(public_tokenizers.path(RANKS)), special_tokens={})
    want = collections.Counter()
    for (i, t), n in copies.items():
        ids = library.encode_ordinary(t)
        packed = b"".join(x.to_bytes(4, "little") for x in ids)
        want[i, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(t.encode()).hexdigest()] += n
    got = stages["byte_bpe"](spark, out, sf).collect()
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got) == want
    # the run as a whole makes the same rows
    whole = corpus_pipeline.run(spark, sf).collect()
    assert collections.Counter((r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in whole) == want


def fold(text: str) -> str:
    """A-Z in lower case, other letters as they are."""
    return text.translate({c: c + 32 for c in range(ord("A"), ord("Z") + 1)})
