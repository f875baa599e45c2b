"""Operators on documents against brute force, and their defined results on odd input."""

from __future__ import annotations

import collections
import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
import xxhash
import zstandard
from pyspark.sql import functions as F

from millrace.llm import byte_bpe, language_id, line_dedup, mixing, quality, queries, simhash
from millrace.llm.components import connected_components
from millrace.llm.queries import RANKS

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id string, kept string, lang_pred int, taken double"
LONG = "the shared line that is longer than forty characters, no doubt"


def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, and names that operators use themselves."""
    rng = random.Random(3)
    words = ["al", "ber", "cor", "dun", "eff", "gor", "hal"]
    body = [" ".join(rng.choice(words) for _ in range(80)) for _ in range(6)]
    rows = [(None, None, None, None), (1, None, "en", "a"), (2, "", None, None), (3, body[0], "en", "a"), (3, body[0], "en", "a"), (4, body[0], "de", "a"), (None, body[0], "en", "b"), (5, body[1] + " end", "en", "b")]
    rows += [(10 + k, f"{body[k % 6]}\n  {LONG.upper()}\t\n{LONG if k % 2 else ''}", "en" if k % 2 else "fr", "a") for k in range(8)]
    rows += [(30, " ".join(rng.choice(words) for _ in range(30_000)), "en", "c"), (31, " \t\r\x0b\x0c", "en", "c"), (32, "###$$$ %%%", "en", "c"), (33, "one two", "fr", "c")]
    return spark.createDataFrame([(*r, None, "x", "y", 1, 0.5) for r in rows], SCHEMA)


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def words_of(text):
    return [w for w in re.split("[\x20\x09-\x0d]+", text or "") if w]


def components(nodes, links):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        p, q = find(a), find(b)
        root[max(p, q)] = min(p, q)
    return {n: find(n) for n in nodes}


# --- components -----------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("links", [[], [(k, k + 1) for k in range(70)], [(0, k) for k in range(1, 40)] + [(50, 51), (51, 52), (60, 61), (61, 39)], [(5, 5), (None, 3), (7, 6), (7, 6)]])
def test_components(spark, links):
    got = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    sound = [(a, b) for a, b in links if a is not None and b is not None]
    assert got == {n: c for n, c in components({x for l in sound for x in l}, sound).items() if n != c}


# --- simhash --------------------------------------------------------------------------------------------------------


def brute_fingerprint(text, n):
    w = words_of(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not w:
        return 0
    shingles = [" ".join(w[i : i + n]) for i in range(max(1, len(w) - n + 1))]
    votes = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * votes[b] > len(shingles))


@pytest.mark.parametrize("text", [None, "", " \n", "One", "one TWO", "a b c", "Ä É ß a b c d", "x y z w v u\u0085t", "a " * 500])
def test_fingerprint(text):
    for n in (3, 5):
        assert simhash.fingerprint(text, n) == brute_fingerprint(text, n)


def test_tile_links_find_all():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    near = base[:200] ^ (np.uint64(1) << rng.integers(0, 63, 200).astype(np.uint64))
    fp = np.unique(np.concatenate([base, near, near[:50] ^ np.uint64(8)]))
    links = simhash.tile_links(fp.view(np.int64), 2)
    want = [(i, j) for i, j in itertools.combinations(range(len(fp)), 2) if int(fp[i] ^ fp[j]).bit_count() <= 2]
    assert components(range(len(fp)), links) == components(range(len(fp)), want)


@pytest.mark.parametrize("group_rows", [4096, 8])
def test_near_links_split_groups(spark, group_rows, monkeypatch):
    monkeypatch.setattr(simhash, "GROUP_ROWS", group_rows)
    rng = np.random.default_rng(2)
    ball = np.uint64(0x123456789ABCDEF0) ^ (np.uint64(1) << rng.integers(0, 20, 40).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 20, 40).astype(np.uint64))
    fp = np.unique(np.concatenate([ball, rng.integers(0, 1 << 63, 60, dtype=np.uint64)])).view(np.int64)
    got = [(r["a"], r["b"]) for r in simhash.near_links(spark.createDataFrame([(int(x),) for x in fp], "fp long"), 2).collect()]
    want = [(int(a), int(b)) for a, b in itertools.combinations(fp, 2) if ((int(a) ^ int(b)) & ((1 << 64) - 1)).bit_count() <= 2]
    assert components(fp.tolist(), got) == components(fp.tolist(), want)


def test_near_duplicates_on_odd_rows(spark):
    docs = odd_docs(spark)
    got = simhash.near_duplicates(docs, shingle=3, radius=2).collect()
    assert len(got) == docs.count()
    by = collections.defaultdict(set)
    for r in got:
        by[r["id"]].add(r["component_id"])
    assert by[2] == {1} and by[31] == {1} and by[4] == {3} and by[3] == {3}
    assert by[None] == {1, 3}  # null ids share the smallest id of their group
    assert simhash.near_duplicates(no_docs(spark)).count() == 0


@pytest.mark.parametrize("rows", [2048, 8])
def test_similar_documents_against_brute_force(spark, rows, monkeypatch):
    """Pairs on both sides of the similarity, and a group of near copies that is cut into tiles."""
    monkeypatch.setattr(simhash, "SET_ROWS", rows, raising=False)
    rng, texts = random.Random(4), []
    for k in range(60):
        words = [f"a{k}x{i}" for i in range(300)]
        texts.append(words)
        for changes in (4, 5, 6, 7, 8, 9, 10, 14):
            other = list(words)
            for at in rng.sample(range(0, 300, 10), changes):
                other[at] = f"b{k}x{at}x{changes}"
            texts.append(other)
    hot = [f"h{i}" for i in range(300)]
    for k in range(40):
        texts.append([f"z{k}" if i == 7 * k else w for i, w in enumerate(hot)])
    texts = [" ".join(t) for t in texts] + ["", None, "a b", "a b c"]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := (t or "").split()) else set() for t in texts]
    # texts of different k share no shingle
    links = [(i, j) for i, j in itertools.combinations(range(len(texts)), 2) if j - i < 50 and (sets[i] == sets[j] or len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]))]
    want = components(range(len(texts)), links)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r["id"]: r["component_id"] for r in simhash.similar_documents(docs).collect()}
    assert got == want and 60 < len(set(want.values())) < 500


def test_similar_documents_count_shingles_once(spark):
    words = [f"w{k}" for k in range(400)]
    texts = [" ".join(words), " ".join(words + 20 * words[40:80]), " ".join(f"v{k}" for k in range(400))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert sorted(r["doc_id"] for r in simhash.keep_one(docs).collect()) == [0, 2]


def test_keep_one(spark):
    docs = odd_docs(spark)
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(3) == 1 and 4 not in ids and 2 not in ids and ids.count(1) == 1 and 5 in ids
    assert simhash.keep_one(no_docs(spark)).count() == 0


# --- quality --------------------------------------------------------------------------------------------------------


def brute_measures(text):
    w = words_of(text)
    grams = collections.Counter(zip(w, w[1:], w[2:]))
    covered = {j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in (text or "").split("\n") if words_of(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_quality_measures(spark):
    docs = odd_docs(spark)
    more = spark.createDataFrame([(100, "a b c a b c\nx\nx\n \n", "en", "s"), (101, "a a a a", "en", "s"), (102, "\U0001f600 b " * 20, None, None)], "doc_id long, text string, lang string, source string")
    rows = docs.select("doc_id", "text", "lang", "source").unionByName(more)
    want = collections.Counter((r["doc_id"], *brute_measures(r["text"])) for r in rows.collect())
    got = quality.judge(rows).collect()
    assert collections.Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) for r in got) == want
    for r in got:
        assert r["base_failed"] == (r["n_words"] < 50 or 2 * r["n_repeat_words"] > r["n_words"])
        assert not (r["base_failed"] and r["kept"])
    assert quality.judge(no_docs(spark)).count() == 0


def test_quality_drops_symbols_and_keeps_clean(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    rows = [(k, " ".join(rng.choice(words) + ("###" if k % 20 == 0 else "") for _ in range(120)), "en", f"s{k % 3}") for k in range(600)]
    got = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert all(kept == (k % 20 != 0) for k, kept in got.items())


def test_quality_bounds_follow_their_group(spark):
    """Equal measures get different verdicts in a plain source and in one whose texts hold many symbols; so in small groups."""
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    text = lambda share: " ".join(rng.choice(words) + ("#" if rng.random() < share else "") for _ in range(200))
    rows = [(k, text(0.0), "en", "plain") for k in range(1500)] + [(2000 + k, text(rng.random() * 0.6), "en", "code") for k in range(1500)]
    middle = " ".join(w + ("#" if k % 2 else "") for k, w in enumerate(rng.choice(words) for _ in range(200)))
    rows += [(5001, middle, "en", "plain"), (5002, middle, "en", "code"), (5003, middle, "en", "tiny"), (5004, text(0.0), "xx", None)]
    got = {r["doc_id"]: r["kept"] for r in quality.judge(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not got[5001] and got[5002] and got[5003] and got[5004]
    assert sum(got[k] for k in range(1500)) >= 1490 and sum(got[2000 + k] for k in range(1500)) >= 1490


def test_quality_bound_of_repeated_lines_follows_its_group(spark):
    """A text with many repeated lines stays where they are usual and goes where they are not; a few stay in both."""
    rng = random.Random(9)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(8000)]
    line = lambda: " ".join(rng.choice(words) for _ in range(2))  # noqa: E731; windows of three words do not repeat with it

    def text(n, again):
        lines = [line() for _ in range(n - again)]
        return "\n".join(lines + rng.sample(lines[::2], again))

    rows = [(k, text(40, 0), "en", "plain") for k in range(2400)] + [(3000 + k, text(40, rng.randint(0, 9)), "en", "song") for k in range(800)]
    rows += [(5000, many := text(40, 8), "en", "plain"), (5001, many, "en", "song"), (5002, few := text(40, 3), "en", "plain"), (5003, few, "en", "song")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = {r["doc_id"]: r["kept"] for r in quality.judge(docs).collect()}
    assert not got[5000] and got[5001] and got[5002] and got[5003]
    assert all(got[k] for k in range(2400)) and sum(got[3000 + k] for k in range(800)) >= 790
    bounds = {r["source"]: r["dup_lines"] for r in quality.thresholds(quality.sketches(quality.measures(docs))).collect()}
    assert bounds["song"] > bounds["plain"] + 300


def test_quality_drops_few_of_an_exponential_tail(spark):
    """Of a measure with an exponential tail about one document in 6,000 is beyond its bound; of a normal one none, at either end."""
    rng = np.random.default_rng(4)
    for values, most in ((rng.exponential(2000.0, 60_000), 1 / 2000), (rng.normal(9000.0, 1000.0, 60_000), 0.0)):
        rows = spark.createDataFrame([("en", "s", int(v)) for v in values], "lang string, source string, v long")
        rules = (quality.Rule("up", "v", "v"), quality.Rule("down", "v", "v", low=True))
        bounds = quality.thresholds(quality.sketches(rows, rules), rules).first()
        assert np.mean((values > bounds["up"] * 1.04) | (values < bounds["down"] * 0.96)) <= most


def test_sketch_cells_merge(spark):
    values = spark.range(3000).select((F.col("id") * 7).alias("v"))
    cells = [(r["v"], r["c"]) for r in values.select("v", quality._cell(F.col("v")).alias("c")).collect()]
    assert all(c <= v <= c * 1.04 + 1 and (v >= 64 or v == c) for v, c in cells)


# --- mixing ---------------------------------------------------------------------------------------------------------


def brute_targets(sizes):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (1, 2, 3)[k % 3] for k, s in enumerate(names)}
    left, out, free = sum(sizes.values()), {}, set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level > 3 * sizes[s] * (1 + 1e-12)}
        if not over:
            return out | {s: weight[s] * level for s in free}
        for s in over:
            out[s] = 3.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def test_targets(spark):
    for sizes in ({"a": 10, "b": 1000, "c": 5, None: 2, "d": 400}, {"a": 7}, {"a": 1, "b": 1, "c": 1000}, {"a": 0, "b": 0}):
        got = {r["source"]: r["target"] for r in mixing.target_sizes(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()}
        want = brute_targets(sizes)
        assert got.keys() == want.keys()
        assert all(got[s] == pytest.approx(want[s]) for s in want)


def test_mix(spark):
    rng = random.Random(7)
    rows = [(k, " ".join(["w"] * int(rng.paretovariate(1.1) * 20 % 3000)), f"s{min(rng.randrange(9), 4)}") for k in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(docs).collect()
    assert len(got) == 3000
    taken, target = collections.Counter(), {}
    for r in got:
        assert r["size"] == len(words_of(rows[r["id"]][1])) and r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
    sizes = {r["source"]: r["source_size"] for r in got}
    for s in target:
        assert abs(taken[s] - target[s]) <= 0.01 * target[s]
    for r in got:  # whole copies are certain
        assert r["size"] == 0 or r["copies"] >= int(target[r["source"]] / sizes[r["source"]] + 1e-9)
    again = mixing.mix(docs.repartition(7)).collect()
    assert {(r["id"], r["taken"]) for r in again} == {(r["id"], r["taken"]) for r in got}
    out = mixing.mixed_rows(docs)
    assert out.columns == docs.columns
    assert collections.Counter(r["doc_id"] for r in out.collect()) == {r["id"]: r["copies"] for r in got if r["copies"]}


def test_mix_inclusion_rates(spark):
    """Over seeds, documents get one copy more as often as their stated probability says; each sample's size is fixed."""
    rng = random.Random(12)
    rows = [(k, f"s{k % 2}", rng.choice([16, 17, 30, 31, 64, 69, 71])) for k in range(600)]
    sizes = mixing.materialize(spark.createDataFrame(rows, "id long, source string, size long").withColumn("key", F.xxhash64("id")), "sizes")
    plan = mixing.materialize(mixing._plan(sizes, mixing.target_sizes(sizes), 3), "plan")
    whole = {(r["source"], r["stratum"]): (r["copies"], r["more"]) for r in plan.collect()}
    got = collections.defaultdict(list)
    for seed in range(10):
        taken = collections.Counter()
        for r in mixing._taken(sizes, mixing._cut(sizes, plan, str(seed)), str(seed)).collect():
            more = r["copies"] - whole[r["source"], r["__stratum"]][0]
            taken[r["source"], r["__stratum"]] += more
            got[r["source"], r["size"], r["inclusion"]].append(more)
        assert all(taken[k] == n for k, (_, n) in whole.items())
    sampled = {k: v for k, v in got.items() if 0 < k[2] < 0.99}
    assert len({k[2] for k in sampled}) > 2
    for (_, _, p), taken in sampled.items():
        assert abs(sum(taken) / len(taken) - p) < 4 * (p * (1 - p) / len(taken)) ** 0.5 + 0.02


def test_mix_inclusion_sums_to_the_sample(spark):
    """The probabilities sum to the sample's size, also where all but one are drawn; longer documents have the larger ones."""
    sizes = spark.range(1000).select("id", F.lit("s").alias("source"), (F.lit(16) + F.col("id") % 2).alias("size"), F.xxhash64("id").alias("key"))
    favours = sizes.agg(F.sum(mixing._favour(F.col("size")))).first()[0]
    for more in (1, 400, 500, 501, 980, 999):
        plan = spark.createDataFrame([("s", 16, 1000, favours, 0, more)], "source string, stratum long, rows long, favours long, copies int, more long")
        got = mixing._ranked(sizes, plan, "x").groupBy("size").agg(F.sum("inclusion").alias("sum"), F.min("inclusion").alias("low"), F.max("inclusion").alias("high")).orderBy("size").collect()
        assert sum(r["sum"] for r in got) == pytest.approx(more)
        assert 0 < got[0]["low"] == got[0]["high"] < got[1]["low"] == got[1]["high"] < 1


def test_mix_on_odd_rows(spark):
    docs = odd_docs(spark)
    got = mixing.mix(docs).collect()
    assert len(got) == docs.count()
    assert all(r["taken"] == 0 for r in got if r["size"] == 0)
    assert mixing.mixed_rows(docs).columns == docs.columns
    assert mixing.mix(no_docs(spark)).count() == 0 and mixing.mixed_rows(no_docs(spark)).count() == 0


# --- line dedup -----------------------------------------------------------------------------------------------------


def brute_lines(rows, min_docs):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))

    holders = collections.defaultdict(list)
    for i, text in rows:
        for k in {key(x) for x in (text or "").split("\n")}:
            if len(k) >= 40:
                holders[k].append(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if len(h := holders.get(key(x), [])) < min_docs or max((j for j in h if j is not None), default=i) == i]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return collections.Counter(out)


@pytest.mark.parametrize("limit", [line_dedup.BROADCAST_BYTES, 0])
def test_line_dedup(spark, limit):
    docs = odd_docs(spark)
    out = line_dedup.drop_repeated_lines(docs, broadcast_bytes=limit)
    assert out.columns == [*docs.columns, "kept_text", "n_lines", "n_dropped"]
    got = collections.Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in out.collect())
    want = brute_lines([(r["doc_id"], r["text"]) for r in docs.collect()], 5)
    assert got == want
    assert sum(n * k for (_, _, n, _), k in want.items()) > 0
    assert line_dedup.drop_repeated_lines(no_docs(spark), broadcast_bytes=limit).count() == 0


def test_perfect_hash():
    rng = np.random.default_rng(4)
    keys = np.unique(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64))
    h = line_dedup.PerfectHash(keys)
    assert sorted(h.index(keys).tolist()) == list(range(len(keys)))
    others = rng.integers(1 << 63, (1 << 64) - 1, 5000, dtype=np.uint64)
    assert (h.index(others) < len(keys)).all()
    shard = line_dedup.Shard(np.array([5, 5, 9, 5, 9], np.uint64), np.array([1, 2, 3, 2, 3], np.uint64), np.array([6, 7, 8, 1, 2]), np.array([60, 70, 80, 71, 5]))
    n_docs, last = shard.probe(np.array([5, 5, 9, 9, 4], np.uint64), np.array([2, 1, 3, 4, 1], np.uint64))
    assert n_docs.tolist() == [8, 6, 10, 0, 0] and last[:3].tolist() == [71, 60, 80]


@pytest.mark.parametrize("limit", [line_dedup.BROADCAST_BYTES, 0])
def test_line_dedup_in_many_shards(spark, limit, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_ROWS", 40)
    monkeypatch.setattr(line_dedup, "PROBE_ROWS", 8)
    rng = random.Random(13)
    lines = [f"line number {k} of a pool of lines that are all long enough" for k in range(90)]
    rows = [(k if k % 17 else None, "\n".join([LONG, *(rng.choice(lines) for _ in range(4)), f"a line of its own {k} that no other document has"])) for k in range(120)]
    out = line_dedup.drop_repeated_lines(spark.createDataFrame(rows, "doc_id long, text string"), broadcast_bytes=limit)
    assert collections.Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in out.collect()) == brute_lines(rows, 5)


# --- language ID ----------------------------------------------------------------------------------------------------


def plain_sizes(text, dictionaries):
    """Compressed sizes of a text by the library alone, in one call a block and language."""
    data = f" {regex.sub(r'[^\p{L}\p{M}]+', ' ', text.lower()).strip()} ".encode()
    blocks, out = [data[k : k + (32 << 10)] for k in range(0, len(data), 32 << 10)], {}
    params = zstandard.ZstdCompressionParameters.from_level(6, write_content_size=False, write_checksum=False, write_dict_id=False)
    for name, content in dictionaries.items():
        held = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        held.precompute_compress(compression_params=params)
        out[name] = sum(len(zstandard.ZstdCompressor(dict_data=held, compression_params=params).compress(b)) for b in blocks)
    return out


def plain_language(text, dictionaries):
    """Language and score by the stated rule: all dictionaries of one step cut to its length, longest step first."""
    length = {}
    for name, content in dictionaries.items():
        length[name] = max(map(len, dictionaries.values()))
        while length[name] > max(1, len(content)):
            length[name] = -(-length[name] // 4)
    best, second, score = None, None, None
    for step in sorted(set(length.values()), reverse=True):
        fresh = [k for k in length if length[k] == step]
        sizes = plain_sizes(text, {k: dictionaries[k][:step] for k in {*fresh, *filter(None, (best, second))}})
        if score is None:  # no two languages have met yet
            best, second = (sorted(sizes, key=lambda k: (sizes[k], k)) + [None])[:2]
            score = None if second is None else (sizes[second] - sizes[best]) / sizes[second]
            continue
        rival = min(fresh, key=lambda k: (sizes[k], k))
        lead = (sizes[best] - sizes[rival]) / sizes[best]
        if lead > score:
            best, second, score = rival, best, lead - score
        elif lead > 0:
            score -= lead
    return best, 1.0 if score is None else score


def test_language_id_query_against_plain_compression(spark, sf):
    """Every row of the query: fold, prediction and score by plain compression; dictionaries by a plain pick of the smallest hashes."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    held_out = {r["doc_id"]: zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2 for r in docs}
    pieces = collections.defaultdict(dict)
    for r in docs:
        if not held_out[r["doc_id"]] and r["lang"] is not None and r["text"]:
            for k in range(0, len(r["text"]), 1000):
                piece = r["text"][k : k + 1000]
                if any(c.isalpha() for c in piece):
                    pieces[r["lang"]][xxhash.xxh64_intdigest(piece.encode(), 17) >> 1] = piece
    dictionaries = {}
    for lang, found in pieces.items():
        joined, raw = b"", 0
        for h in sorted(found)[: 16 * (256 << 10) // 1000]:
            if raw < 2 * (256 << 10):
                joined += f" {regex.sub(r'[^\p{L}\p{M}]+', ' ', found[h].lower()).strip()} ".encode()
                raw += len(found[h].encode())
        dictionaries[lang] = joined[: 256 << 10]
    assert language_id.learn(spark.read.parquet(f"{sf}/documents.parquet"), where=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2) == dictionaries
    ok = n = 0
    got = {r["doc_id"]: r for r in queries.op9_language_id(spark, sf).collect()}
    assert len(got) == len(docs)
    for r in docs:
        row, text = got[r["doc_id"]], r["text"] or ""
        assert row["held_out"] == held_out[r["doc_id"]] and 0 <= row["score"] <= 1
        want = plain_language(text, dictionaries) if any(c.isalpha() for c in text) else ("und", 0.0)
        assert (row["lang_pred"], row["score"]) == want
        if held_out[r["doc_id"]] and r["lang"] is not None and want[0] != "und":
            n += 1
            ok += row["lang_pred"] == r["lang"]
    assert ok >= 0.95 * n > 0


def test_language_id_learns_every_language(spark):
    rng = random.Random(6)
    vocabulary = {"aa": "abcde", "bb": "fghij", "cc": "klmno"}
    vocabulary = {k: ["".join(rng.choice(v) for _ in range(rng.randint(4, 9))) for _ in range(60)] for k, v in vocabulary.items()}
    text = lambda lang, n: " ".join(rng.choice(vocabulary[lang]) for _ in range(n))
    one = text("bb", 150)
    rows = [("aa", text("aa", 150)) for _ in range(400)] + [("bb", text("bb", 150)) for _ in range(30)] + [("xx", "12 !"), (None, "zz"), ("yy", None)]
    docs = spark.createDataFrame(rows, "lang string, text string")
    docs = docs.unionByName(spark.range(20_000).select(F.lit("bb").alias("lang"), F.lit(one).alias("text")))
    learned = language_id.learn(docs, dictionary_bytes=64 << 10)
    assert learned.keys() == {"aa", "bb"} and len(learned["aa"]) == 64 << 10 and len(learned["bb"]) > 20_000
    rare = spark.createDataFrame([("cc", text("cc", 80))], "lang string, text string")
    more = language_id.learn(docs.unionByName(rare), dictionary_bytes=64 << 10)
    assert {k: more[k] for k in learned} == learned and more["cc"]
    model = language_id.Classifier(more)
    for lang in ("aa", "bb"):
        assert all(model(text(lang, 60))[0] == lang for _ in range(20))
    assert model(rare.first()["text"])[0] == "cc"


def test_language_id_keeps_vowel_signs():
    assert language_id._normal("हिन्दी, ที่นี่ 12!") == " हिन्दी ที่นี่ ".encode()


def test_language_id_on_odd_rows(spark):
    docs = odd_docs(spark)
    out = language_id.predict(docs, language_id.learn(docs))
    assert out.columns == [*docs.columns, "lang_pred_", "score", "rejected"]
    rows = out.collect()
    assert len(rows) == docs.count()
    for r in rows:
        lettered = any(c.isalpha() for c in r["text"] or "")
        assert (r["lang_pred_"] == "und") == (not lettered) and 0 <= r["score"] <= 1
        assert lettered or r["rejected"]
    assert language_id.learn(no_docs(spark)) == {}
    assert {r["lang_pred_"] for r in language_id.predict(docs, {}).collect()} == {"und"}
    assert language_id.predict(no_docs(spark), {}).count() == 0


# --- byte-level BPE -------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def bpe():
    ranks = byte_bpe.read_ranks(public_tokenizers.path(RANKS))
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return byte_bpe.Encoder(ranks, public_tokenizers.PATTERN), byte_bpe.Decoder(ranks), library


def test_bpe_equals_library(bpe):
    encoder, decoder, library = bpe
    rng, tokens = random.Random(9), list(library._mergeable_ranks)
    cases = ["", "a", " ", "\n\n \t", "don't we'll", "ÄÖß éà", "\U0001f600‍\U0001f525", "x" * 5000, "ab" * 3000, " " * 999 + "z", "<|endoftext|>", "0123456789" * 50]
    for _ in range(3000):
        kind = rng.randrange(3)
        if kind == 0:
            cases.append("".join(rng.choice("aeionrst hTH.,'\n") for _ in range(rng.randrange(60))))
        elif kind == 1:
            cases.append(b"".join(rng.choice(tokens) for _ in range(rng.randrange(1, 9))).decode("utf-8", "ignore"))
        else:
            cases.append("".join(chr(rng.choice([rng.randrange(32, 127), rng.randrange(160, 700), rng.randrange(0x4E00, 0x4F00)])) for _ in range(rng.randrange(30))))
    for text in cases:
        packed = encoder.encode(text)
        assert np.frombuffer(packed, "<u4").tolist() == library.encode_ordinary(text)
        assert "".join(decoder.text(decoder.stream(packed, 3))) == text


def test_bpe_starts_anew_when_full(bpe, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MAX_STATES", 20)
    monkeypatch.setattr(byte_bpe, "MAX_ARCS", 30)
    monkeypatch.setattr(byte_bpe, "MAX_KNOWN", 5)
    encoder = byte_bpe.Encoder(bpe[0].ranks, public_tokenizers.PATTERN)
    for text in ("thaninhe thhewh onstly " * 20, "q" * 400, "zxcvbnm" * 100):
        assert np.frombuffer(encoder.encode(text), "<u4").tolist() == bpe[2].encode_ordinary(text)


def test_utf8_machine():
    data = "aé€\U0001f600z".encode() + b"\xff\xc3" + "ü".encode() + b"\xed\xa0\x80\xf0\x9f"
    for cut in range(1, len(data) + 1):
        machine = byte_bpe.Utf8Machine()
        out = "".join(machine.feed(data[k : k + cut]) for k in range(0, len(data), cut)) + machine.close()
        assert out == data.decode("utf-8", "replace")
    rng = random.Random(3)
    parts = [b"a", b"\x80", b"\xbf", b"\xc0", b"\xc3", b"\xe0", b"\xa0", b"\xed", b"\x9f", b"\xf0", b"\x90", b"\xf4", b"\xf5", "é".encode(), "€".encode(), "\U0001f600".encode()]
    for _ in range(4000):
        data = b"".join(rng.choice(parts) for _ in range(rng.randrange(12)))
        machine, out, at = byte_bpe.Utf8Machine(), "", 0
        while at < len(data):
            size = rng.randrange(1, 6)
            out += machine.feed(data[at : at + size])
            at += size
        assert out + machine.close() == data.decode("utf-8", "replace")


def test_bpe_frames(spark, bpe):
    docs = odd_docs(spark)
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    out = byte_bpe.decode(byte_bpe.encode(docs, path, pattern), path)
    assert out.columns == [*docs.columns, "ids", "decoded"]
    for r in out.collect():
        assert r["ids"] == bpe[2].encode_ordinary(r["text"] or "") and r["decoded"] == (r["text"] or "")
    for r in byte_bpe.digests(docs, path, pattern).join(docs.select(F.col("doc_id").alias("i"), "text"), F.col("i") == F.col("doc_id")).collect():
        ids = bpe[2].encode_ordinary(r["text"] or "")
        assert (r["n_tokens"], r["ids_sha256"]) == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())
        assert r["decoded_sha256"] == hashlib.sha256((r["text"] or "").encode()).hexdigest() and r["decoded_chars"] == len(r["text"] or "")
    assert byte_bpe.digests(no_docs(spark), path, pattern).count() == 0 and byte_bpe.encode(no_docs(spark), path, pattern).count() == 0
