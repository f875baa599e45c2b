"""Encoding, fitting, comparing and scoring, on line items and parts."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.core.scratch import new_path
from millrace.operators import encoding, models, target_stats
from millrace.plans.registry import Registry, rounded, table

R = Registry()


@R.add(r"""with w as (select doc_id, regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}_]{2,}') as w from documents),
t as (select doc_id, unnest(list_concat(w, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]))) as term from w),
tf as (select doc_id, term, count(*) as tf from t group by 1, 2), n as (select count(*) as n from w),
v as (select term, count(*) as df, ln((1 + any_value(n)) / (1.0 + count(*))) + 1 as idf from tf, n group by term having count(*) >= 5 and count(*) <= 0.95 * any_value(n)),
x as (select doc_id, term, (1 + ln(tf)) * idf as w from tf join v using (term))
select doc_id, term, round(w / sqrt(sum(w * w) over (partition by doc_id)), 6) as weight from x""")
def tfidf_weights(spark: SparkSession, d: str) -> DataFrame:
    return rounded(encoding.fit_weights(table(spark, d, "documents"), "doc_id", "text"), 6)


_PARTS_TFIDF = r"""with w as (select p_partkey, regexp_extract_all(strip_accents(lower(p_name)), '[\p{L}\p{N}_]{2,}') as w from part),
t as (select p_partkey, unnest(list_concat(w, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]))) as term from w),
tf as (select p_partkey, term, count(*) as tf from t group by 1, 2), n as (select count(*) as n from w),
v as (select term, ln((1 + any_value(n)) / (1.0 + count(*))) + 1 as idf from tf, n group by term having count(*) >= 5 and count(*) <= 0.95 * any_value(n)),
x as (select p_partkey, term, (1 + ln(tf)) * idf as w from tf join v using (term)), y as (select p_partkey, term, w / sqrt(sum(w * w) over (partition by p_partkey)) as weight from x)"""


@R.add(_PARTS_TFIDF + " select term, round(sum(weight) / (select count(*) from part), 6) as mean_weight from y group by 1 order by sum(weight) desc, term limit 30")
def mean_weights(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    weights = encoding.fit_tfidf(part, "p_name").weights(part, "p_partkey", "p_name")
    return rounded(encoding.mean_weights(weights, part.count(), 30), 6)


@R.add(_PARTS_TFIDF + " select (select count(*) from v) as width, count(*) as filled, round(1 - count(*) / ((select count(*) from v) * (select count(*) from part)::double), 6) as sparsity from y")
def matrix_shape(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    model = encoding.fit_tfidf(part, "p_name")
    return rounded(encoding.shape(model.weights(part, "p_partkey", "p_name"), model.vocabulary.count(), part.count()), 6)


@R.add(r"""with w as (select doc_id, regexp_extract_all(strip_accents(lower(text)), '[\p{L}\p{N}_]{2,}') as w from documents),
t as (select distinct doc_id, unnest(list_concat(w, list_transform(generate_series(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1]))) as term from w), c as (select term, count(*) as df from t group by 1)
select min_df, count(*) filter (where df >= min_df) as terms from c, (values (1), (2), (5), (10), (20)) v(min_df) group by 1""")
def vocabulary_sizes(spark: SparkSession, d: str) -> DataFrame:
    return encoding.vocabulary_sizes(table(spark, d, "documents"), "text")


@R.add("""with r as (select distinct p_partkey, unnest(string_split(p_name, ' ')) as item from part), v as (select item, row_number() over (order by item) - 1 as position from (select distinct item from r) x)
select p_partkey, item, position from r join v using (item)""")
def multihot(spark: SparkSession, d: str) -> DataFrame:
    return encoding.multi_hot(table(spark, d, "part"), "p_partkey", encoding.list_tokens(F.regexp_replace("p_name", " ", "|")))


def _lines(spark: SparkSession, d: str) -> DataFrame:
    """Line items with their part, a price to learn, and a split by part, so that no part is in two splits."""
    part = table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
    rows = table(spark, d, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey"))
    k = F.col("p_partkey") % 10
    return rows.select(
        "l_orderkey", "l_linenumber", "p_partkey", F.col("p_name").alias("title"), F.regexp_replace("p_name", " ", "|").alias("skill_list"), "p_brand", "p_type", F.col("p_size").cast("double").alias("p_size"),
        "l_quantity", "l_returnflag", F.log1p(F.col("l_quantity") * F.col("p_retailprice") * (1 - F.col("l_discount"))).alias("target_log_salary"), F.when(k < 2, "test").when(k == 2, "validation").otherwise("train").alias("split"),
    )


def _parts(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    rows = _lines(spark, d)
    return tuple(rows.where(F.col("split") == s).drop("split") for s in ("train", "validation", "test"))


CATEGORIES, NUMBERS = ("p_brand", "p_type", "l_returnflag"), ("l_quantity", "p_size")


@R.add("""with r as (select l_orderkey, l_linenumber, p_brand, p_type, l_returnflag, cast(l_quantity as double) as l_quantity, cast(case when p_partkey % 7 <> 0 then p_size end as double) as p_size, p_partkey % 10 as k from lineitem join part on l_partkey = p_partkey),
t as (select * from r where k > 2),
b as (select p_brand, row_number() over (order by p_brand) - 1 as i from (select distinct p_brand from t) x), y as (select p_type, row_number() over (order by p_type) - 1 as i from (select distinct p_type from t) x),
f as (select l_returnflag, row_number() over (order by l_returnflag) - 1 as i from (select distinct l_returnflag from t) x),
w as (select (select count(*) from b) as b, (select count(*) from y) as y, (select count(*) from f) as f),
m as (select median(l_quantity) as q, median(p_size) as s from t),
n as (select avg(l_quantity) as qa, stddev_pop(l_quantity) as qs, avg(coalesce(p_size, s)) as sa, stddev_pop(coalesce(p_size, s)) as ss from t, m),
v as (select * from r where k = 2)
select l_orderkey, l_linenumber, cast(position as integer) as position, round(value, 6) as value from (
  select l_orderkey, l_linenumber, b.i as position, 1.0::double as value from v join b using (p_brand)
  union all select l_orderkey, l_linenumber, w.b + y.i, 1.0 from v join y using (p_type), w
  union all select l_orderkey, l_linenumber, w.b + w.y + f.i, 1.0 from v join f using (l_returnflag), w
  union all select l_orderkey, l_linenumber, w.b + w.y + w.f, (l_quantity - qa) / qs from v, n, w
  union all select l_orderkey, l_linenumber, w.b + w.y + w.f + 1, (coalesce(p_size, s) - sa) / ss from v, m, n, w) x where value <> 0""")
def feature_matrix(spark: SparkSession, d: str) -> DataFrame:
    """The filled cells of the validation rows, by a pipeline that was fitted on the training rows, saved and loaded."""
    train, validation, _ = (df.withColumn("p_size", F.when(F.col("p_partkey") % 7 != 0, F.col("p_size"))) for df in _parts(spark, d))
    path = new_path(spark, "features")
    encoding.feature_pipeline(train, encoding.FeatureSet("matrix", categories=CATEGORIES, numbers=NUMBERS)).write().save(path)
    return rounded(encoding.cells(PipelineModel.load(path).transform(validation), ["l_orderkey", "l_linenumber"]), 6)


@R.add("""with x as (select ln(1 + l_quantity * p_retailprice * (1 - l_discount)) as y, l_partkey % 10 as k from lineitem join part on l_partkey = p_partkey), m as (select median(y) as p from x where k > 2), v as (select y, p from x, m where k = 2)
select round(avg(abs(exp(y) - exp(p))), 2) as mae, round(sqrt(avg(pow(exp(y) - exp(p), 2))), 2) as rmse, round(1 - sum(pow(exp(y) - exp(p), 2)) / (var_pop(exp(y) - 1) * count(*)), 4) as r2, count(*) as n from v""")
def median_baseline(spark: SparkSession, d: str) -> DataFrame:
    train, validation, _ = _parts(spark, d)
    fitted = models.fit(train, encoding.FeatureSet("E0", "median"))
    m = models.metrics(fitted.predict(validation))
    return m.select(F.round("mae", 2).alias("mae"), F.round("rmse", 2).alias("rmse"), F.round("r2", 4).alias("r2"), "n")


@R.add("""with x as (select ln(1 + l_extendedprice) as y, ln(1 + l_extendedprice * (1 - l_discount)) as p from lineitem)
select round(avg(abs(exp(y) - exp(p))), 2) as mae, round(sqrt(avg(pow(exp(y) - exp(p), 2))), 2) as rmse, round(1 - sum(pow(exp(y) - exp(p), 2)) / (var_pop(exp(y) - 1) * count(*)), 6) as r2,
round(avg(abs(y - p)), 6) as log_mae, round(sqrt(avg(pow(y - p, 2))), 6) as log_rmse, round(1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*)), 6) as log_r2, round(100 * median(abs(exp(y) - exp(p)) / (exp(y) - 1)), 4) as median_ape, count(*) as n from x""")
def regression_metrics(spark: SparkSession, d: str) -> DataFrame:
    price = F.col("l_extendedprice")
    rows = table(spark, d, "lineitem").select(F.log1p(price).alias("target_log_salary"), F.log1p(price * (1 - F.col("l_discount"))).alias("log_prediction"))
    m = models.metrics(rows)
    return m.select(F.round("mae", 2).alias("mae"), F.round("rmse", 2).alias("rmse"), *[F.round(c, 6).alias(c) for c in ("r2", "log_mae", "log_rmse", "log_r2")], F.round("median_ape", 4).alias("median_ape"), "n")


@R.add("with x as (select l_extendedprice as p from lineitem) select count(*) as rows, count(*) filter (where p is null or isnan(p) or isinf(p)) as bad from x")
def prediction_checks(spark: SparkSession, d: str) -> DataFrame:
    return models.check_predictions(table(spark, d, "lineitem").withColumnRenamed("l_extendedprice", "prediction"))


_STATS = "p as (select l_orderkey, l_linenumber, p_brand, case when l_suppkey % 5 = 0 then null else l_suppkey end as supplier, ln(1 + l_extendedprice) as y, l_partkey, l_suppkey, md5('42:' || l_orderkey || ':' || l_linenumber || ':' || l_partkey || ':' || l_suppkey) as o from lineitem join part on l_partkey = p_partkey), m as (select avg(y) as m from p)"


@R.add(f"""with {_STATS}, w as (select *, sum(y) over b as bs, count(y) over b as bn, sum(y) over s as ss, count(y) over s as sn from p
window b as (partition by p_brand order by o rows between unbounded preceding and 1 preceding), s as (partition by supplier order by o rows between unbounded preceding and 1 preceding))
select l_orderkey, l_linenumber, l_partkey, l_suppkey, round((coalesce(bs, 0) + 10 * m) / (coalesce(bn, 0) + 10), 6) as brand_stat, round((coalesce(ss, 0) + 10 * m) / (coalesce(sn, 0) + 10), 6) as supplier_stat from w, m""")
def ordered_target_statistics(spark: SparkSession, d: str) -> DataFrame:
    """Brand and supplier (a fifth unknown) as the mean log price of the rows before each in a random order."""
    rows = table(spark, d, "lineitem").join(table(spark, d, "part").select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    rows = rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "p_brand", F.when(F.col("l_suppkey") % 5 != 0, F.col("l_suppkey")).alias("supplier"), F.log1p("l_extendedprice").alias("y"))
    out = target_stats.ordered_statistics(rows, {"brand_stat": "p_brand", "supplier_stat": "supplier"}, "y", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"])
    return rounded(out.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "brand_stat", "supplier_stat"), 6)


@R.add()
def ridge_ladder(spark: SparkSession, d: str) -> DataFrame:
    train, validation, _ = _parts(spark, d)
    board, _ = models.run_experiments(train, validation, models.ladder(CATEGORIES, NUMBERS))
    return models.rank(board).drop("train_seconds")


@R.add()
def forest(spark: SparkSession, d: str) -> DataFrame:
    train, validation, _ = _parts(spark, d)
    fitted = models.fit(train, encoding.FeatureSet("forest", "forest", CATEGORIES, NUMBERS), params={"trees": 8, "depth": 6})
    return models.evaluate(fitted, validation)


@R.add()
def boosting(spark: SparkSession, d: str) -> DataFrame:
    """The one-hot family at its full size: 300 rounds of depth 6."""
    train, validation, _ = _parts(spark, d)
    fitted = models.fit(train, encoding.FeatureSet("boosting", "boosting", CATEGORIES, NUMBERS))
    return models.evaluate(fitted, validation)


@R.add()
def tuning(spark: SparkSession, d: str) -> DataFrame:
    """A seeded search over the ridge penalty, compared with the default's error."""
    train, validation, _ = _parts(spark, d)
    base = encoding.FeatureSet("base", "ridge", CATEGORIES, NUMBERS)
    trials = {f"alpha={p['alpha']}": p for p in models.random_search({"alpha": [0.1, 1.0, 10.0, 100.0]}, 3)}
    board, _ = models.run_trials(train, validation, base, trials | {"default": {}})
    default = board.where("experiment = 'default'").first()["rmse"]
    return models.compare_to_baseline(models.rank(board.where("experiment <> 'default'")), default).select("experiment", "rank", "rmse", "gain", "gain_pct", "better")


@R.add("""with o as (select o_orderpriority as experiment, case when o_orderpriority = '3-MEDIUM' then null else avg(o_totalprice) end as rmse from orders group by 1)
select experiment, row_number() over (order by coalesce(rmse, 'inf'::double), experiment) as rank from o""")
def leaderboard(spark: SparkSession, d: str) -> DataFrame:
    board = table(spark, d, "orders").groupBy(F.col("o_orderpriority").alias("experiment")).agg(F.avg("o_totalprice").alias("rmse"))
    board = board.withColumn("rmse", F.when(F.col("experiment") != "3-MEDIUM", F.col("rmse")))
    return models.rank(board, ties=("experiment",)).select("experiment", "rank")


@R.add()
def batch_score(spark: SparkSession, d: str) -> DataFrame:
    train, validation, test = _parts(spark, d)
    fitted, _, holdout = models.final_fit(train, validation, test, encoding.FeatureSet("E1", "ridge", CATEGORIES, NUMBERS), {}, {"min_r2": -1.0})
    fit_rows, rejected = models.prepare_requests(test.withColumn("title", F.when(F.col("l_linenumber") != 7, F.col("title"))), ("title",), ("p_type",), "skill_list")
    scored = models.score(fitted, fit_rows).select("l_orderkey", "l_linenumber", "skill_count", "prediction", F.lit(None).cast("string").alias("reject_reason"))
    return scored.unionByName(rejected.select("l_orderkey", "l_linenumber", "skill_count", F.lit(None).cast("double").alias("prediction"), "reject_reason"))


_ONE = """x as (select ln(1 + l_quantity * p_retailprice * (1 - l_discount)) as y, cast(l_quantity as double) as q, l_partkey % 10 as k from lineitem join part on l_partkey = p_partkey),
s as (select avg(q) as m, stddev_pop(q) as d from x where k > 2), t as (select y, (q - m) / d as z from x, s where k > 2), c as (select avg(y) as a, sum(z * (y - (select avg(y) from t))) / (count(*) + 100.0) as b from t),
v as (select y, a + b * (q - m) / d as p from x, s, c where k = 2)"""


@R.add(f"with {_ONE} select round(avg(abs(y - p)), 5) as log_mae, round(sqrt(avg(pow(y - p, 2))), 5) as log_rmse, round(1 - sum(pow(y - p, 2)) / (var_pop(y) * count(*)), 5) as log_r2, count(*) as n from v")
def ridge_one_number(spark: SparkSession, d: str) -> DataFrame:
    """A ridge fit on one scaled number with a penalty of 100, whose slope has a closed form."""
    train, validation, _ = _parts(spark, d)
    fitted = models.fit(train, encoding.FeatureSet("one", "ridge", numbers=("l_quantity",)), params={"alpha": 100.0})
    m = models.metrics(fitted.predict(validation))
    return rounded(m.select("log_mae", "log_rmse", "log_r2", "n"), 5)


@R.add("""with r as (select case when l_linenumber = 7 then 'title' end as reason, len(list_distinct(string_split(p_name, ' '))) as skills from lineitem join part on l_partkey = p_partkey where l_partkey % 10 < 2)
select reason as reject_reason, count(*) as rows, cast(sum(skills) as double) as skills, case when reason is null then count(*) else 0 end as scored from r group by 1""")
def batch_reasons(spark: SparkSession, d: str) -> DataFrame:
    """What a batch of requests comes to: rows by the reason they were rejected for, their skills, and how many got a prediction."""
    scored = batch_score(spark, d)
    return scored.groupBy("reject_reason").agg(F.count("*").alias("rows"), F.sum("skill_count").alias("skills"), F.count("prediction").alias("scored"))


@R.add("""with b as (select p_brand as experiment, avg(p_retailprice) as rmse from part group by 1), m as (select avg(p_retailprice) as base from part)
select experiment, round(base - rmse, 6) as gain, round(100 * (base - rmse) / base, 6) as gain_pct, base - rmse > 0 and 100 * (base - rmse) / base > 0.5 as better, row_number() over (order by rmse, experiment) as rank from b, m""")
def trials_against_baseline(spark: SparkSession, d: str) -> DataFrame:
    """A board of trials (here the mean price of each brand as the error) against a baseline, with the least gain that counts."""
    part = table(spark, d, "part")
    board = part.groupBy(F.col("p_brand").alias("experiment")).agg(F.avg("p_retailprice").alias("rmse"))
    base = part.agg(F.avg("p_retailprice")).first()[0]
    return rounded(models.rank(models.compare_to_baseline(board, base, least_gain_pct=0.5), ties=("experiment",)).select("experiment", "gain", "gain_pct", "better", "rank"), 6)


@R.add()
def derived_ladder(spark: SparkSession, d: str) -> DataFrame:
    """The structured set as winner, with more numbers, more categories, and both."""
    train, validation, _ = (df.withColumn("discounted", F.col("l_quantity") * F.col("p_size")) for df in _parts(spark, d))
    winner = encoding.FeatureSet("E1", "ridge", CATEGORIES[:2], NUMBERS[:1])
    board, _ = models.run_experiments(train, validation, [models.Experiment(winner), *models.extended_ladder(winner, ("p_size", "discounted"), ("l_returnflag",))])
    return models.rank(board).drop("train_seconds")


@R.add()
def family_comparison(spark: SparkSession, d: str) -> DataFrame:
    """All families on fixed features, the ensembles at a size that runs in seconds."""
    train, validation, _ = _parts(spark, d)
    small = {"median": {}, "ridge": {}, "forest": {"trees": 8, "depth": 6}, "boosting": {"rounds": 6, "depth": 4, "rate": 0.1}, "ordered_boosting": {"rounds": 6, "depth": 4, "rate": 0.1}}
    board, _ = models.run_experiments(train, validation, [models.Experiment(encoding.FeatureSet(f, f, CATEGORIES, NUMBERS), p) for f, p in small.items()])
    return models.rank(board).drop("train_seconds")
