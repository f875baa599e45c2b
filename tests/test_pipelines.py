"""Text weights by both ways, and pipelines that are saved and loaded elsewhere."""

from __future__ import annotations

import collections
import math
import random
import subprocess
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace import catalog
from millrace.operators import encoding, models


def rows(n=60):
    rng = random.Random(3)
    words = ["red", "blue", "Café", "x1", "größe", "of", "a", "zeta"]
    out = [(k, " ".join(rng.choices(words, k=rng.randrange(9))), rng.choice(["u", "v", None]), rng.choice([1.0, 2.5, None]), "|".join(rng.choices(["SQL", " go", ""], k=2)), float(k % 7)) for k in range(n)]
    return [*out, (n, None, "u", None, None, 1.0), (n + 1, "", "v", 3.0, "", 2.0), (n + 2, "blue " * 5000, None, 0.0, "go", 3.0)]


SCHEMA = "id long, title string, kind string, size double, skills string, y double"


@pytest.mark.parametrize("room", [encoding.VOCABULARY_BYTES, 0])
def test_weights_with_and_without_a_broadcast_vocabulary(spark, room):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA).repartition(5)
    cfg = encoding.TfidfConfig(min_df=2)
    got = {(r["id"], r["term"]): r["weight"] for r in encoding.fit_tfidf(df, "title", cfg).weights(df, "id", "title", room).collect()}
    fold = str.maketrans("éöß", "eoß")
    words = {r[0]: [w for w in (r[1] or "").lower().translate(fold).split() if len(w) > 1] for r in data}
    terms = {k: w + [f"{a} {b}" for a, b in zip(w, w[1:])] for k, w in words.items()}
    df_of = collections.Counter(t for w in terms.values() for t in set(w))
    kept = {t: math.log((1 + len(data)) / (1 + n)) + 1 for t, n in df_of.items() if 2 <= n <= 0.95 * len(data)}
    want = {}
    for k, w in terms.items():
        raw = {t: (1 + math.log(n)) * kept[t] for t, n in collections.Counter(w).items() if t in kept}
        want |= {(k, t): v / math.sqrt(sum(x * x for x in raw.values())) for t, v in raw.items()}
    assert got.keys() == want.keys() and all(got[k] == pytest.approx(v) for k, v in want.items())
    sizes = {r["min_df"]: r["terms"] for r in encoding.vocabulary_sizes(df, "title", (1, 2)).collect()}
    assert sizes == {1: len(df_of), 2: sum(n > 1 for n in df_of.values())}
    assert encoding.fit_tfidf(df.limit(0), "title").weights(df.limit(0), "id", "title", room).collect() == []


FEATURES = encoding.FeatureSet("all", categories=("kind",), numbers=("size",), text="title", items="skills", item_encoding="tfidf", min_df=2)


def test_unseen_categories_are_zeros(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    made = encoding.feature_pipeline(df, encoding.FeatureSet("c", categories=("kind",)))
    odd = spark.createDataFrame([(1, "new"), (2, "u"), (3, None)], "id long, kind string")
    assert {(r["id"], r["position"]): r["value"] for r in encoding.cells(made.transform(odd), ["id"]).collect()} == {(2, 1): 1.0, (3, 0): 1.0}
    assert made.transform(odd).first()["features"].size == 3


LOADER = """
import sys
sys.path.insert(0, sys.argv[1])
from millrace.core.session import session
from millrace.operators import models
spark = session("local[2]", "loader", 2, spark__ui__enabled="false", spark__ui__showConsoleProgress="false")
df = spark.read.parquet(sys.argv[2] + "/rows")
models.score(models.Fitted.load(spark, sys.argv[2] + "/model"), df, 9).select("id", "prediction").write.parquet(sys.argv[2] + "/scores")
"""


def test_saved_model_scores_the_same_in_another_session(spark, tmp_path):
    df = spark.createDataFrame(rows(), SCHEMA)
    fitted = models.fit(df, FEATURES, "y")
    fitted.save(spark, str(tmp_path / "model"))
    df.write.parquet(str(tmp_path / "rows"))
    root = models.__file__.rsplit("/millrace/", 1)[0]
    subprocess.run([sys.executable, "-c", LOADER, root, str(tmp_path)], check=True, timeout=300, capture_output=True)
    want = {r["id"]: r["prediction"] for r in models.score(fitted, df, 9).collect()}
    got = {r["id"]: r["prediction"] for r in spark.read.parquet(str(tmp_path / "scores")).collect()}
    assert got == want and len(set(want.values())) > 5


def test_saved_baseline(spark, tmp_path):
    df = spark.createDataFrame(rows(), SCHEMA)
    fitted = models.fit(df, encoding.FeatureSet("E0", "median"), "y")
    fitted.save(spark, str(tmp_path / "m"))
    again = models.Fitted.load(spark, str(tmp_path / "m"))
    assert again == fitted and again.predict(df).select(F.count_distinct("prediction")).first()[0] == 1


def test_weights_of_fitted_rows_need_no_vocabulary_on_the_driver(spark, sf, monkeypatch):
    """The query brings two sums to the driver, and gives the weights of a vocabulary that is sent, over several chunks."""
    docs, brought = spark.read.parquet(f"{sf}/documents.parquet"), []
    collect = type(docs).collect
    wide = encoding.fit_tfidf(docs, "text").weights(docs, "doc_id", "text", 1 << 30)
    want = {(r["doc_id"], r["term"]): pytest.approx(r["weight"], abs=2e-6) for r in wide.collect()}
    monkeypatch.setattr(encoding, "CHUNK_BYTES", 1 << 16)
    monkeypatch.setattr(type(docs), "collect", lambda df: brought.append(len(found := collect(df))) or found)
    out = catalog.queries()["tfidf_weights"](spark, sf)
    assert sum(brought) <= 2
    monkeypatch.undo()
    got = out.collect()
    assert len(got) == len(want) and {(r["doc_id"], r["term"]): r["weight"] for r in got} == want
    narrow = encoding.fit_tfidf(docs, "text").weights(docs, "doc_id", "text", 0).collect()
    assert len(narrow) == len(want) and {(r["doc_id"], r["term"]): r["weight"] for r in narrow} == want


def test_ridge_is_solved_by_its_normal_equations(spark):
    """One pass over the rows gives the closed form; terms are counted by text, as by row."""
    rng = random.Random(5)
    data = [(rng.gauss(0, 1), rng.choice(["red box", "red red tin", "blue", "blue box", None]), rng.gauss(4, 1)) for _ in range(400)]
    df = spark.createDataFrame([(x, t, y + x + len(t or "")) for x, t, y in data], "x double, t string, y double")
    fitted = models.fit(df, encoding.FeatureSet("r", "ridge", numbers=("x",), text="t"), "y", {"alpha": 30.0})
    assert fitted.model.getSolver() == "normal"
    made = fitted.features.transform(df).select("features", "y").collect()
    a, b = np.array([r["features"].toArray() for r in made]), np.array([r["y"] for r in made])
    centred = a - a.mean(axis=0)
    want = np.linalg.solve(centred.T @ centred + 30.0 * np.eye(a.shape[1]), centred.T @ (b - b.mean()))
    assert fitted.model.coefficients.toArray() == pytest.approx(want, abs=1e-8)
    terms = df.select(encoding.text_tokens(F.col("t")).alias("w"), "t")
    maker = encoding.Terms("t", "w2")
    want = sorted(collections.Counter(w for r in terms.collect() for w in set(r["w"])).items(), key=lambda x: (-x[1], x[0]))
    assert encoding.term_counts(terms, "w") == encoding.term_counts(terms, "w2", made_by=maker) == (want, 400)
