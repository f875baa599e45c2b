"""Divergence, whitening and sharding against plain versions, on odd rows too."""

from __future__ import annotations

import collections
import math
import random
import re
import zlib

import numpy as np
import pytest

from millrace.llm import divergence, queries, sharding, whitening


def plain_audit(rows, least_docs=divergence.LEAST_DOCS, most=10):
    """``rows`` of (text, lang, source) by the definition, with a dictionary a group."""
    docs = [(re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate({c: c + 32 for c in range(65, 91)})), lang or "", source or "") for t, lang, source in rows]
    out = []
    for lang in {x[1] for x in docs}:
        mine = [(w, s) for w, x, s in docs if x == lang]
        seen = collections.Counter(t for w, _ in mine for t in set(w))
        kept = [t for t, n in seen.items() if n >= least_docs]
        groups = {s: collections.Counter() for _, s in mine}
        for w, s in mine:
            groups[s].update(w)
        everything = sum(groups.values(), collections.Counter())

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 10**9 * (counts[t] + 2) // (total + 2 * len(kept)) for t in kept}

        p = {s: shares(c) for s, c in groups.items()}
        q = shares(everything)
        f = lambda a, b: (a - b) ** 2 // (a + b)
        for s in groups:
            pairs = [(-sum(f(p[s][t], p[o][t]) for t in kept), o.encode(), o) for o in groups if o != s]
            terms = [(-f(p[s][t], q[t]), t.encode(), t) for t in kept if groups[s][t] and p[s][t] > q[t]]
            out += [(lang, s, "pair", i, -v, k + 1) for k, (v, _, i) in enumerate(sorted(pairs))]
            out += [(lang, s, "term", i, -v, k + 1) for k, (v, _, i) in enumerate(sorted(terms)[:most])]
    return sorted(out)


def audited(df, **options):
    return sorted((r["lang"], r["source"], r["part"], r["item"], r["value"], r["rank"]) for r in divergence.audit(df, **options).collect())


ODD_TEXTS = [None, "", "   ", "123 456 !?", "Straße ÄPFEL äpfel ÄPFEL", "x" * 5000, "a\x00b Cc\x85dd ee", "word word WORD other"]


def test_audit_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_TERMS", 7)
    monkeypatch.setattr(divergence, "TILE_GROUPS", 2)
    rng = random.Random(3)
    words = [f"{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(60)] + ["über", "ÜBER", "ñ", "漢字"]
    rows = [(" ".join(rng.choices(words, k=rng.randrange(30))), rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "c", "é", "Z", None])) for _ in range(150)]
    rows += [(t, lang, s) for t in ODD_TEXTS for lang, s in (("en", "a"), ("en", "b"), ("xx", "only"), ("yy", "u"), ("yy", "v"))] + rows[:20]
    df = spark.createDataFrame([(k, *r, "clash", 1) for k, r in enumerate(rows)], "doc_id long, text string, lang string, source string, term string, Value int")
    for least in (1, 3, 10_000):
        assert audited(df, least_docs=least) == plain_audit(rows, least)
    assert audited(df.limit(0)) == []


def test_audit_query_against_plain_version(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = plain_audit([(r["text"], r["lang"], r["source"]) for r in docs.collect()])
    got = queries.op11_source_divergence(spark, sf)
    assert sorted(tuple(r) for r in got.select("lang", "source", "part", "item", "value", "rank").collect()) == want and want


def test_terms_in_pieces(monkeypatch):
    text = "".join(random.Random(1).choices("abÄé .", k=3000)).encode()
    whole = [t for piece in divergence.term_pieces(text) for t in piece]
    monkeypatch.setattr(divergence, "PIECE_BYTES", 5)
    assert [t for piece in divergence.term_pieces(text) for t in piece] == whole
    assert [t.decode() for t in whole] == re.findall("[abÄé]+", text.decode())


def test_gallop_and_merge():
    rng = np.random.default_rng(0)
    for n, m, top in ((0, 0, 1), (0, 9, 20), (9, 0, 20), (700, 900, 1000), (3, 40_000, 10**6), (2000, 60_000, 10**5)):
        a, b = (np.sort(rng.choice(top, k, replace=False)) for k in (n, m)) if top >= max(n, m) else (None, None)
        assert (divergence.gallop(a, b) == np.searchsorted(b, a)).all()
        p, q = (rng.integers(1, 10**9, k) for k in (n, m))
        one, other = dict(zip(a.tolist(), p.tolist())), dict(zip(b.tolist(), q.tolist()))
        want = sum((one.get(t, 5) - other.get(t, 7)) ** 2 // (one.get(t, 5) + other.get(t, 7)) for t in one.keys() | other.keys())
        assert divergence.merge(a, p, 5, b, q, 7) == divergence.merge(b, q, 7, a, p, 5) == (want, len(one.keys() | other.keys()))


def eigen(vectors):
    """Whole steps of ``vectors``, the distinct ones, and their covariance's eigenvalues and eigenvectors, largest first."""
    x = np.array([[math.floor(256 * float(c)) for c in v] for v in vectors], dtype=object)
    fit = np.array(sorted({tuple(r) for r in x.tolist()}), dtype=object)
    n, sums = len(fit), fit.sum(axis=0)
    centred = np.array(fit - sums / n, float)
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    return x, n, sums, values[::-1], axes[:, ::-1], centred


def check_whitened(rows, vectors, ids, tolerance=1e-6):
    x, n, sums, values, axes, _ = eigen(vectors)
    got = {(r["id"], r["component"]): r for r in rows}
    count = max((c for _, c in got), default=0)
    assert len(got) == len(ids) * count
    for c in range(1, count + 1):
        mine = np.array([got[i, c]["whitened"] for i in ids])
        want = np.array(x - sums / n, float) @ axes[:, c - 1] / math.sqrt(values[c - 1])
        assert min(np.abs(mine - want).max(), np.abs(mine + want).max()) < tolerance
        assert all(got[i, c]["explained"] == pytest.approx(values[c - 1] / values.sum(), rel=1e-9) for i in ids)
        assert all(got[i, c]["identity_error"] < 1e-9 and got[i, c]["n"] == n for i in ids)
        assert [got[i, c]["deviation"] for i in ids] == [int(v) for v in ((n * x - sums) ** 2).sum(axis=1)]
    return count


def test_whitening_query_against_eigenvectors(spark, sf):
    table = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    rows = queries.op12_embedding_whitening(spark, sf).withColumnRenamed("vec_id", "id").collect()
    assert check_whitened(rows, [v for _, v in table], [i for i, _ in table]) == 4


def test_whitening_of_odd_rows(spark):
    rng = random.Random(5)
    scale = [40.0, 9.0, 2.0, 1.0, 0.5, 0.1]
    good = [[rng.gauss(0, s) + 3 for s in scale] for _ in range(80)]
    good = [[*v, v[0], 2 * math.floor(256 * v[1]) / 256, 7.0] for v in good]  # three columns that depend on others
    good += good[:10] * 3
    bad = [None, [], [None] * 9, [float("nan")] * 9, [float("inf"), *[0.0] * 8], [1.0] * 4]
    rows = [(k, v, 1.0, "s") for k, v in enumerate(good + bad)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, x double, ID string").repartition(7)
    assert check_whitened(whitening.whiten(df).collect(), good, range(len(good))) == 4
    model = whitening.fit(df, components=99)
    assert len(model.variances) == 6 and model.identity_error < 1e-9
    for some in ([], [[1.0, 2.0]], [[1.0, 2.0]] * 5, [None, [float("nan"), 1.0]]):
        few = spark.createDataFrame([(k, v) for k, v in enumerate(some)], "vec_id long, embedding array<float>")
        assert whitening.whiten(few).collect() == []
    two = [[0.0, 1.0], [1.0, 1.0], [1.0, 1.0]]
    assert check_whitened(whitening.whiten(spark.createDataFrame(list(enumerate(two)), "vec_id long, embedding array<float>")).collect(), two, range(3)) == 1


def test_whitening_of_narrow_and_wide_scales(spark):
    """The smallest of four variances is 10**-14 of the largest: beyond a Gram matrix in double precision by itself."""
    rng = random.Random(6)
    table = [[rng.randrange(-(10**7), 10**7) / 256, *[rng.randrange(-50, 50) / 256 + rng.randrange(2) for _ in range(2)], 0.0] for _ in range(300)]
    table = [[v[0], v[0] + v[1], v[2] - v[0], v[0] + rng.randrange(3) / 256] for v in table]
    df = spark.createDataFrame(list(enumerate(table)), "vec_id long, embedding array<double>").repartition(5)
    model = whitening.fit(df)
    x, n, sums, *_ = eigen(table)
    centred = np.array(np.unique(np.array(x, float), axis=0)) - np.array(sums / n, float)
    singular = np.linalg.svd(centred, compute_uv=False)
    assert len(model.variances) == 4 and np.allclose(model.variances, singular**2 / n, rtol=1e-6) and model.identity_error < 1e-6


def test_exact_parts_of_whitening():
    x = np.array([[1 << 40, -(1 << 50)], [5, 1 << 62], [3, 1 << 62]], np.int64)
    assert whitening.exact_sums(x) == [sum(c) for c in x.T.tolist()]
    assert whitening._deviations(np.array([[3, 1 << 40]], np.int64), 7, (2, 5)) == [None]
    r = np.triu(np.random.default_rng(2).normal(size=(70, 70))) + 9 * np.eye(70)
    a = np.random.default_rng(3).normal(size=(11, 70))
    assert np.allclose(whitening.solve_right(a, r) @ r, a)
    low = np.random.default_rng(4).normal(size=(9, 3)) @ np.random.default_rng(5).normal(size=(3, 6))
    f, picked = whitening.pivoted_cholesky(low.T @ low)
    assert len(picked) == 3 and np.allclose(f.T @ f, low.T @ low) and np.allclose(np.tril(f[:, picked], -1), 0)


def plain_shards(rows, shards):
    """``rows`` of (source, hash, rest): fractions of ranks, one sort, equal cuts."""
    by_source = collections.defaultdict(list)
    for r in rows:
        by_source[r[0]].append(r)
    placed = []
    for source, own in by_source.items():
        for k, r in enumerate(sorted(own, key=lambda r: r[1])):
            placed.append(((k + 0.5) / len(own), source is None, source or "", r[1], r[2]))
    placed.sort(key=lambda r: r[:4])
    out, filled = [], collections.Counter()
    for k, r in enumerate(placed):
        shard = k * shards // len(placed)
        out.append((r[4], shard, filled[shard]))
        filled[shard] += 1
    return out


def test_sharding_query_against_plain_version(spark, sf):
    from pyspark.sql import functions as F

    raw = F.coalesce("text", F.lit("")).cast("binary")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    keyed = docs.select("doc_id", "text", "source", F.xxhash64(F.lit("interleave"), "doc_id", "source", (F.octet_length(raw) + 16).cast("long"), F.crc32(raw)).alias("h")).collect()
    want = {i: (shard, slot) for i, shard, slot in plain_shards([(r["source"], r["h"], r["doc_id"]) for r in keyed], 40)}
    texts = {r["doc_id"]: (r["text"] or "").encode() for r in keyed}
    got = queries.op13_sharding(spark, sf).collect()
    assert len(got) == len(keyed) and {r["doc_id"]: (r["shard"], r["slot"]) for r in got} == want
    for r in got:
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(texts[r["doc_id"]]) + 16, zlib.crc32(texts[r["doc_id"]]), "rows", None)


def test_shards_match_the_mixture(spark, tmp_path):
    rng = random.Random(8)
    sources = ["hot"] * 400 + ["b"] * 200 + ["c"] * 37 + [None] * 100 + ["lone"]
    rows = [(rng.choice([None, rng.randrange(50)]), rng.choice([None, "", "text", "long " * 2000]), s, k % 3, {"k": k}) for k, s in enumerate(sources)] + [(1, "same", "hot", 1, {"k": 0})] * 300
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, Shard int, extra map<string,int>").repartition(9)
    kept = sharding.write_shards(df, str(tmp_path / "s"), 7)
    out = kept.collect()
    shard, slot = kept.columns[-2:]
    assert kept.columns[:5] == df.columns and (shard, slot) == ("shard_", "slot")
    assert collections.Counter((r["doc_id"], r["text"], r["source"]) for r in out) == collections.Counter(r[:3] for r in rows)
    for k in range(7):
        mine = [r for r in out if r[shard] == k]
        assert sorted(r[slot] for r in mine) == list(range(len(mine))) and abs(len(mine) - len(rows) / 7) < 1
        for s, n in collections.Counter(r[2] for r in rows).items():
            assert abs(sum(r["source"] == s for r in mine) - n / 7) <= 1 + 5 * n / len(rows)
    once, again = (sorted(map(str, sharding.assign(d.drop("Shard"), 7).drop("slot").collect())) for d in (df, df.repartition(3)))
    assert once == again
    assert sharding.assign(df.limit(0), 40).collect() == []
    few = sharding.assign(df.limit(3), 40).collect()
    assert len({r["shard"] for r in few}) == 3 and {r["slot"] for r in few} == {0}
