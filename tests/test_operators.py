"""Operators on small tables with the anomalies that they are for."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.core import fingerprint, schemas
from millrace.core.schemas import CleaningRule, ForeignKey, TableSchema, ValidationRules, ValueRule
from millrace.functions import columns as C
from millrace.functions import geography
from millrace.operators import align, clean, consolidate, encoding, features, groups, models, ordered, series, sets, split, target, validate
from millrace.sources import readers, writers

WIDGETS = TableSchema({"widget_id": "bigint", "name": "string", "quantity": "bigint", "note": "string"}, {"widget_id": ("id",), "quantity": ("qty",)}, ("widget_id",))


def test_align(spark):
    df = spark.createDataFrame([(1, "a", 5, "x")], "ID long, NAME string, Qty long, extra string")
    out = align.align(df, WIDGETS)
    assert out.columns == ["widget_id", "name", "quantity", "note", "unmapped__extra"] and out.first()["note"] is None
    assert align.align(df, WIDGETS, keep_unmapped=False).columns == ["widget_id", "name", "quantity", "note"]
    assert align.align(df, None) is df
    with pytest.raises(ValueError, match="widget_id"):
        align.align(df.drop("ID"), WIDGETS)
    report = {(r["action"], r["column"]) for r in align.alignment_report(df, WIDGETS).collect()}
    assert ("missing", "note") in report and ("renamed", "widget_id") in report and ("preserved", "unmapped__extra") in report
    empty = align.empty_required(spark.createDataFrame([(None,)], "widget_id long"), WIDGETS).first()
    assert (empty["column"], empty["non_null"]) == ("widget_id", 0)


def test_align_takes_a_stream(spark):
    stream = spark.readStream.format("rate").load().select(F.col("value").alias("id"), F.lit("n").alias("name"))
    assert align.align(stream, WIDGETS).isStreaming


def test_validate(spark):
    rows = [(1, "a", "5", "active", 1), (1, None, "5000", "odd", 2), (2, "c", "x", None, 9), (3, "d", "-1", "retired", None)]
    df = spark.createDataFrame(rows, "id long, name string, qty string, status string, warehouse_id long")
    rules = ValidationRules(("id",), ("name", "gone"), {"qty": ValueRule(low=0, high=1000), "status": ValueRule(allowed=("active", "retired"), pattern="[a-n]")}, foreign_keys=(ForeignKey("warehouse_id", "warehouses", "id"),))
    houses = spark.createDataFrame([(1,), (2,)], "id long")
    got = {(r["check"], r["column"]): r["violations"] for r in validate.validate_version({"widgets": df, "warehouses": houses}, {"widgets": rules}).collect()}
    assert got == {("structure", "gone"): 1, ("null", "name"): 1, ("value", "qty"): 2, ("value", "status"): 2, ("type", "qty"): 1, ("duplicate", "id"): 2, ("orphan", "warehouse_id"): 1}
    report = validate.validate(df, rules, "widgets")
    assert validate.validation_summary(report, ["widgets", "other"]).first().asDict() == {"passed": 0, "failed": 1, "skipped": 1, "violations": 7}
    with pytest.raises(ValueError, match="null: 1, value: 4"):
        validate.enforce(report, ("null", "value", "duplicate"))
    validate.enforce(report, ("duplicate",))


def test_clean_version(spark):
    tables = {
        "companies": spark.createDataFrame([("1", "  Acme   Inc "), ("2", None), ("2", "Twice")], "company_id string, name string"),
        "postings": spark.createDataFrame([("10", "1.0", " A  b "), ("11", None, "x"), ("12", "999", "y"), ("13", "2", "nan"), ("13", "2", "later")], "job_id string, company_id string, title string"),
        "salaries": spark.createDataFrame([("10", "5.5"), ("10", "-1"), ("12", "7")], "job_id string, med_salary string"),
    }
    types = {t: schemas.LISTING_SCHEMAS[t].columns for t in tables}
    order = {t: [F.monotonically_increasing_id()] for t in tables}
    rules = {t: schemas.LISTING_CLEANING[t] for t in tables}
    done, failed = clean.clean_version(tables, rules, types, order)
    assert not failed
    assert {tuple(r) for r in done["companies"].collect()} == {(1, "Acme Inc"), (2, "Unknown Company")}
    assert {tuple(r) for r in done["postings"].collect()} == {(10, 1, "A b"), (13, 2, None)}
    assert {tuple(r) for r in done["salaries"].collect()} == {(10, 5.5)}
    once, _ = clean.clean_version(done, rules, types, order)
    assert {tuple(r) for r in once["postings"].collect()} == {tuple(r) for r in done["postings"].collect()}
    report = {r["table"]: r["removed"] for r in clean.cleaning_report(tables, done).collect()}
    assert report == {"companies": 1, "postings": 3, "salaries": 2}
    bad = {"postings": CleaningRule(("job_id",), low_values="wrong", lower_bounds={"job_id": 0})}
    assert "postings" in clean.clean_version({"postings": tables["postings"]}, bad, {}, order)[1]
    with pytest.raises(ValueError):
        clean.clean_version({"postings": tables["postings"]}, bad, {}, order, continue_on_error=False)
    assert clean.parents_first(schemas.LISTING_CLEANING).index("postings") > clean.parents_first(schemas.LISTING_CLEANING).index("companies")


def test_clean_version_in_a_folder(spark, tmp_path):
    tables = {"a": spark.createDataFrame([(1, "x"), (1, "y"), (2, "z")], "id long, v string"), "b": spark.createDataFrame([(1,), (3,), (None,), (None,)], "a_id long")}
    rules = {"a": CleaningRule(("id",)), "b": CleaningRule((), foreign_keys=(ForeignKey("a_id", "a", "id"),))}
    done, failed = clean.clean_version(tables, rules, {}, {"a": [F.col("v")]}, folder=str(tmp_path))
    assert not failed and (tmp_path / "a").is_dir()
    assert {tuple(r) for r in done["a"].collect()} == {(1, "x"), (2, "z")}
    assert sorted((r["a_id"] or 0) for r in done["b"].collect()) == [0, 1]  # whole rows are compared without a key
    assert "order" in clean.clean_version(tables, rules, {}, {})[1]["a"]


def test_rows_without_a_key_are_kept(spark):
    left = spark.createDataFrame([(None, f"r{k}") for k in range(50)] + [(1, "one"), (2, "two")], "id long, v string")
    right = spark.createDataFrame([(1, "a"), (None, "never")], "key long, w string")
    out, _ = consolidate.safe_left_join(left, right, "id", "key", "hit")
    assert out.columns == ["id", "v", "w", "hit"] and out.count() == 52
    assert [tuple(r) for r in out.where("w is not null").collect()] == [(1, "one", "a", True)]
    parent = right.select(F.col("key").alias("id"))
    assert clean.drop_orphans(left, (ForeignKey("id", "p", "id"),), {"p": parent}).count() == 51
    assert left.select(C.null_salt(left, "id").alias("s")).distinct().count() > 20


def test_positions(spark):
    words = sorted({f"{k * 7919 % 1000:03d}é" for k in range(700)} | {"", "a", "zz", "Ünder"}, key=lambda s: s.encode())
    df = spark.createDataFrame([(w,) for w in words], "w string").repartition(7)
    for ranges in (1, 2, 64):
        assert [r["w"] for r in ordered.positions(df, "w", ranges).orderBy("position").collect()] == words
    assert {r["position"] for r in ordered.positions(df, "w", 64).collect()} == set(range(len(words)))
    assert ordered.positions(df.limit(0), "w").count() == 0


def test_accents(spark):
    df = spark.createDataFrame([("Ünïcödé ñandú ș Å e\u0301 й ß ø ≮",), (None,)], "t string")
    assert [r[0] for r in df.select(C.without_accents(F.lower("t"))).collect()] == ["unicode nandu s a e и ß ø ≮", None]


def test_text_vectors_have_the_weights_of_the_table(spark):
    texts = ["red red red car", "blue car", "red boat boat", "café cafe sky", None, "boat car red"]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, title string")
    want = {}
    for r in encoding.fit_tfidf(df, "title", encoding.TfidfConfig(min_df=1)).weights(df, "id", "title").collect():
        want.setdefault(r["id"], []).append(round(r["weight"], 9))
    made = encoding.feature_pipeline(df, encoding.FeatureSet("t", text="title", min_df=1)).transform(df)
    got = {r["id"]: sorted(round(float(x), 9) for x in r["text_vector"].toArray() if x) for r in made.collect()}
    assert {k: v for k, v in got.items() if v} == {k: sorted(v) for k, v in want.items()} and got[4] == []


def test_trials_share_their_features(spark):
    df = spark.createDataFrame([(float(k), "ab"[k % 2], k * 0.1 + (k % 2)) for k in range(60)], "x double, c string, y double")
    f = encoding.FeatureSet("f", "ridge", ("c",), ("x",))
    board, fitted = models.run_trials(df, df, f, {"low": {"alpha": 0.001}, "bad": {"alpha": -1.0}, "high": {"alpha": 100.0}}, "y")
    got = {r["experiment"]: r for r in board.collect()}
    assert got["bad"]["status"] == "failed" and got["low"]["log_rmse"] < got["high"]["log_rmse"]
    assert fitted["low"].features is fitted["high"].features and fitted["low"].predict(df).count() == 60
    alone, _ = models.run_experiments(df, df, [models.Experiment(f, {"alpha": 100.0})], "y")
    assert alone.first()["log_rmse"] == pytest.approx(got["high"]["log_rmse"], rel=1e-6)


def test_clean_parts(spark):
    df = spark.createDataFrame([(1, " a ", 1.0), (1, "None", -2.0), (2, "", None)], "k long, s string, v double")
    assert {r["column"]: r["modified"] for r in clean.modified_cells(df).collect()} == {"s": 3}
    assert clean.apply_bounds(df, {"v": 0.0}, "nullify").where("v is null").count() == 2
    assert clean.count_low(df, {"v": 0.0}).first()["low"] == 1
    for keep, n in (("first", 1.0), ("last", -2.0)):
        assert clean.dedupe(df, ["k"], [F.col("v").desc()] if keep == "x" else [-F.col("v")], keep).where("k = 1").first()["v"] == n
    assert [r["k"] for r in clean.dedupe(df, ["k"], None, "drop_all").collect()] == [2]
    assert clean.castable(df.select(F.lit("x").alias("a"), F.lit("1").alias("b")), {"a": "double", "b": "double"}) == {"a": False, "b": True}


def test_consolidate(spark):
    fact = spark.createDataFrame([(1, 7, "t"), (2, 8, "u"), (3, None, "v")], "job_id long, company_id long, name string")
    tables = {
        "postings": fact,
        "companies": spark.createDataFrame([(7, "B", "c"), (7, "A", "d"), (9, "Z", "e")], "company_id long, label string, name string"),
        "counts": spark.createDataFrame([(7, 5.0, 1), (7, None, 9), (7, 6.0, 2), (8, None, 4)], "company_id long, at double, n int"),
        "links": spark.createDataFrame([(1, "x"), (1, "x"), (1, "y"), (1, None), (None, "x"), (2, "q"), (2, "p")] + [(3, f"v{k:02d}") for k in range(15)], "job_id long, code string"),
        "names": spark.createDataFrame([("x", "Ex"), ("y", "Why"), ("p", "Pe"), ("q", "Qu")] + [(f"v{k:02d}", f"n{k:02d}") for k in range(15)], "code string, text string"),
    }
    dims = (consolidate.DimensionJoin("companies", "company_id", "company_id", order=("label",)),)
    snaps = (consolidate.SnapshotJoin("counts", "company_id", "company_id", "at", rename={"n": "headcount"}, columns=("n",)),)
    bridges = (consolidate.BridgeSummary("links", "job_id", "code", "skill", "names", "code", "text"),)
    out, skipped = consolidate.consolidate(tables, "postings", dims, snaps, bridges, markers=True)
    rows = {r["job_id"]: r for r in out.collect()}
    assert skipped["companies"] == ["name"] and rows[1]["label"] == "A" and rows[1]["name"] == "t"
    assert rows[1]["headcount"] == 2 and rows[2]["headcount"] == 4 and rows[3]["headcount"] is None
    assert (rows[1]["skill_count"], rows[1]["top_skill"], rows[1]["skill_list"]) == (2, "Ex", ["Ex", "Why"])
    assert rows[2]["top_skill"] == "Pe" and len(rows[3]["skill_list"]) == 10 and rows[3]["skill_count"] == 15
    stats = {r["table"]: r["matched"] for r in consolidate.match_stats(out, ["companies", "counts", "links"]).collect()}
    assert stats == {"companies": 1, "counts": 2, "links": 3}
    consolidate.check_integrity(fact, out, "job_id")
    with pytest.raises(ValueError):
        consolidate.check_integrity(fact, out.unionByName(out), "job_id")
    assert consolidate.union_versions({"a": fact, "b": fact.drop("name")}).columns[-1] == "dataset_version"


def test_feature_store(spark):
    df = spark.createDataFrame(
        [(1, 5.0, 1704067200000.0, "1", " Full time ", "cafﬁ   x", ["b a", "A"], None), (2, None, None, "no", "nan", None, None, 3.0), (3, 7.0, 1.0, None, "full TIME", "", ["c"], 9.0)],
        "job_id long, views double, listed_time double, sponsored string, work_type string, title string, skill_list array<string>, min_salary double",
    )
    out = features.build_features(df)
    rows = sorted(out.collect(), key=lambda r: r["skill_count"], reverse=True)
    assert "job_id" not in out.columns and rows[0]["skill_list"] == ["A", "B_A"] and rows[0]["title"] == "caffi x"
    assert rows[0]["work_type"] == "full time" and rows[0]["sponsored"] is True and {r["views"] for r in rows} == {5.0, 6.0, 7.0}
    assert str(rows[0]["listed_time"]).startswith("2024-01-01") and [r["salary_available"] for r in rows] == [False, True, True]
    features.check_store(out, ("skill_count", "salary_available"))
    with pytest.raises(ValueError):
        features.check_store(out, ("nothing",))


def test_functions(spark):
    df = spark.createDataFrame([("['a b', 'c']", "x|y;z/ x", "Ünïted", None)], "a string, b string, c string, d string")
    r = df.select(C.list_items(F.col("a")).alias("a"), C.standard_list(C.list_items(F.col("b"))).alias("b"), C.without_marks(F.col("c")).alias("c"), C.boolean(F.col("d")).alias("d"), C.group_id(F.col("c"), F.col("d")).alias("g")).first()
    assert r["a"] == ["a b", "c"] and r["b"] == ["X", "Y", "Z"] and r["c"] == "United" and r["d"] is None and len(r["g"]) == 64
    found = spark.createDataFrame([("C++ and c, java; javascript",)], "t string").select(C.mentions(F.col("t"), ["c", "c++", "java", "javascript"]).alias("m")).first()["m"]
    assert found == ["c++", "c", "java", "javascript"]
    rows = spark.createDataFrame([("New York, NY", "US"), ("N.J.", "us "), ("Kansas", "US"), ("TX or OH", "US"), ("90210", "US"), ("Ontario", "CA"), (None, "US")], "s string, c string")
    assert [r["o"] for r in geography.with_us_state(rows, "s", "c", "o").collect()] == ["new york", "new jersey", "kansas", None, None, None, None]


def test_pay_funnel(spark):
    rows = [
        (40000.0, 60000.0, None, "YEARLY", "USD"), (None, None, 20.0, "hourly", "usd"), (None, None, 400.0, "HOURLY", "USD"), (50.0, 40.0, None, "YEARLY", "USD"), (60000.0, 60000.0, None, "YEARLY", "EUR"),
        (60000.0, 60000.0, None, "ONCE", "USD"), (1.0, 1.0, None, "YEARLY", "USD"), (9.0, 1.0, 70000.0, "ANNUAL", "USD"), (60000.0, 60000.0, None, "YEARLY", None),
    ]
    df = spark.createDataFrame(rows, "min_salary double, max_salary double, med_salary double, pay_period string, currency string")
    out = target.with_target(df)
    assert target.funnel(out).first().asDict() == {"rows": 9, "candidates": 8, "no_pay": 1, "hourly_too_high": 1, "currency": 2, "period": 1, "out_of_bounds": 1, "accepted": 3}
    assert sorted(r[0] for r in out.where("target_annual_salary is not null").select("target_annual_salary").collect()) == [41600.0, 50000.0, 70000.0]
    frame = target.modelling_frame(out.withColumn("title", F.lit("t")))
    assert frame.count() == 3 and not set(frame.columns) & set(target.LEAKS)
    assert set(target.violations(frame).first()) == {0}
    with pytest.raises(ValueError):
        target.resolve_predictors(df, ("title", "min_salary"))


def test_group_split_is_exact(spark):
    rows = [(k, f"g{k % 37}") for k in range(400)] + [(1000 + k, "hot") for k in range(200)]
    df = spark.createDataFrame(rows, "id long, g string")
    out = split.group_split(df, "g")
    counts = {r["split"]: r["n"] for r in out.groupBy("split").agg(F.count_distinct("g").alias("n")).collect()}
    assert counts == {"test": 8, "validation": 4, "train": 26}  # ceil(0.2 * 38), ceil(0.125 * 30), the rest
    assert split.overlap(out, "g").first()[0] == 0
    assert split.conserved(df, out, "id").first().asDict() == {"rows_before": 600, "rows_after": 600, "shared_rows": 0}
    assert {(r["id"], r["split"]) for r in split.group_split(df.repartition(5), "g").collect()} == {(r["id"], r["split"]) for r in out.collect()}
    with pytest.raises(ValueError):
        split.check_input(df.withColumn("t", F.lit(0.0)), "g", "t")


def test_series_edges(spark):
    one = spark.createDataFrame([("2024-03-01 10:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert series.daily(one, "t").count() == series.weekly(one, "t").count() == 1
    gap = one.unionByName(spark.createDataFrame([("2024-03-05 01:00:00",), (None,)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t")))
    assert [r["n"] for r in series.daily(gap, "t").orderBy("day").collect()] == [1, 0, 0, 0, 1]
    assert series.daily(gap.limit(0), "t").count() == 0
    year = spark.createDataFrame([("2023-12-31 00:00:00",), ("2024-01-01 00:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("t"))
    assert [str(r["week"]) for r in series.weekly(year, "t").orderBy("week").collect()] == ["2023-12-31", "2024-01-07"]


def test_leaderboard_and_search(spark):
    board = spark.createDataFrame([("a", 2.0, 0.1), ("b", float("nan"), 0.9), ("c", 1.0, 0.5)], "experiment string, rmse double, r2 double").withColumns({"mae": F.lit(1.0), "train_seconds": F.lit(1.0)})
    assert [r["experiment"] for r in models.rank(board).orderBy("rank").collect()] == ["c", "a", "b"]
    assert [r["experiment"] for r in models.rank(board, "r2").orderBy("rank").collect()] == ["b", "c", "a"]
    better = models.compare_to_baseline(board, 1.5)
    assert models.preferred(better, {"a": {"x": 1}, "c": {"x": 2}}, {"x": 0}) == {"x": 2}
    assert models.preferred(models.compare_to_baseline(board, 0.5), {}, {"x": 0}) == {"x": 0}
    assert len(models.grid({"a": [1, 2], "b": [3]})) == 2 and models.random_search({"a": list(range(9))}, 4) == models.random_search({"a": list(range(9))}, 4)
    for bad in (("nothing", {}), ("ridge", {"x": 1}), ("ridge", {"alpha": 0})):
        with pytest.raises(ValueError):
            models.check_params(*bad)


def test_failed_experiment_is_a_row(spark):
    df = spark.createDataFrame([(float(k), float(k) / 10) for k in range(40)], "x double, target_log_salary double")
    board, fitted = models.run_experiments(df, df, [models.Experiment(encoding.FeatureSet("good", numbers=("x",))), models.Experiment(encoding.FeatureSet("bad", numbers=("y",)))])
    rows = {r["experiment"]: r for r in board.collect()}
    assert rows["bad"]["status"] == "failed" and "y" in rows["bad"]["error"] and rows["good"]["r2"] > 0.95 and set(fitted) == {"good"}


def test_ridge_equals_closed_form(spark):
    import numpy as np

    rng = np.random.default_rng(1)
    x, y = rng.normal(size=(200, 2)), rng.normal(size=200) * 3
    y += x @ [2.0, -1.0]
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "a double, b double, target_log_salary double")
    got = models.fit(df, encoding.FeatureSet("r", numbers=("a", "b")), params={"alpha": 5.0}).model.coefficients.toArray()
    z = (x - x.mean(0)) / x.std(0)
    want = np.linalg.solve(z.T @ z + 5.0 * np.eye(2), z.T @ (y - y.mean()))
    assert got == pytest.approx(want, abs=1e-3)


def test_sources_round_trip(spark, tmp_path):
    root = tmp_path / "raw"
    for v in (2, 10):
        folder = root / f"Version_{v}"
        folder.mkdir(parents=True)
        (folder / "job_postings.csv").write_text('job_id,title,description\n1,"a ""b""","line\nline"\n2,N/A,\n')
        for t in ("companies", "industries", "job_industries"):
            (folder / f"{t}.csv").write_text(f"{t}_id,x\n1,2\n")
    (root / "Version_x").mkdir()
    assert readers.discover_versions(spark, str(root)) == ["Version_2", "Version_10"]
    tables, absent = readers.load_version(spark, str(root / "Version_2"))
    rows = tables["postings"].orderBy("job_id").collect()
    assert rows[0]["title"] == 'a "b"' and rows[0]["description"] == "line\nline" and rows[1]["title"] is None and "skills" in absent
    (root / "Version_2" / "industries.csv").unlink()
    with pytest.raises(FileNotFoundError, match="industries"):
        readers.load_catalog(spark, str(root))
    with pytest.raises(FileNotFoundError):
        readers.discover_versions(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        readers.load_table(spark, str(root / "x.txt"))
    df = spark.createDataFrame([(1, ["a", "b"], "train"), (2, None, "test")], "id long, items array<string>, split string")
    paths = writers.write_dataset(df, str(tmp_path / "out"), report=df.drop("items"), run_id="r1")
    assert spark.read.parquet(paths["archive"] + "/data").count() == 2
    assert spark.read.json(paths["latest"] + "/metadata").first()["schema_fingerprint"] == fingerprint.schema_fingerprint(df)
    writers.write_csv(df, str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).where("id = 1").first()["items"] == "a|b"
    writers.write_splits(df, str(tmp_path / "splits"))
    assert {k: v.count() for k, v in writers.read_splits(spark, str(tmp_path / "splits")).items()} == {"train": 1, "test": 1}
    assert readers.with_ordinal(spark.read.parquet(paths["latest"] + "/data")).columns[-1] == readers.ORDINAL


def test_fingerprints(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "a long, b string")
    assert fingerprint.unchanged(a.orderBy(F.desc("a")), fingerprint.content_fingerprint(a))
    assert not fingerprint.unchanged(a.limit(1), fingerprint.content_fingerprint(a))
    assert fingerprint.schema_fingerprint(a) == fingerprint.schema_fingerprint(a.select("b", "a"))
    assert fingerprint.schema_fingerprint(a, ordered=True) != fingerprint.schema_fingerprint(a.select("b", "a"), ordered=True)


def test_clip_by_group(spark):
    df = spark.range(100).select((F.col("id") % 2).alias("g"), F.col("id").cast("double").alias("x"))
    assert sets.clip_percentiles(df, "x", 0.1, 0.9, by="g").count() == 80
    assert sets.iqr_outliers(df.limit(0), "x").count() == 0
