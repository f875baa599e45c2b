"""Series, group statistics, profiles, outliers and text statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import columns as C
from millrace.operators import groups, ordered, series, sets
from millrace.plans.registry import Registry, rounded, table, text

R = Registry()

_DAYS = "c as (select cast(ts as date) as d, count(*) as n from events group by 1), g as (select cast(unnest(generate_series((select min(d) from c)::timestamp, (select max(d) from c)::timestamp, interval 1 day)) as date) as d), s as (select g.d, coalesce(n, 0) as n from g left join c using (d))"
ORDER_STATUS, PRIORITIES, EVENT_TYPES = ["F", "O", "P"], ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], ["click", "error", "purchase", "signup", "view"]


def _days(spark: SparkSession, d: str) -> DataFrame:
    return series.daily(table(spark, d, "events"), "ts")


@R.add(f"with {_DAYS} select strftime(d, '%Y-%m-%d') as day, n from s")
def daily_dense(spark: SparkSession, d: str) -> DataFrame:
    return _days(spark, d).select(text("day").alias("day"), "n")


@R.add("""with c as (select event_type, cast(ts as date) as d, count(*) as n from events group by 1, 2), g as (select event_type, cast(unnest(generate_series((select min(d) from c)::timestamp, (select max(d) from c)::timestamp, interval 1 day)) as date) as d from (select distinct event_type from c) x)
select g.event_type, strftime(g.d, '%Y-%m-%d') as day, coalesce(n, 0) as n from g left join c using (event_type, d)""")
def daily_by_category(spark: SparkSession, d: str) -> DataFrame:
    return series.daily(table(spark, d, "events"), "ts", ["event_type"]).select("event_type", text("day").alias("day"), "n")


@R.add(f"with {_DAYS} select strftime(d, '%Y-%m-%d') as day, n, case when count(*) over w = 7 then round(avg(n) over w, 4) end as rolling from s window w as (order by d rows between 6 preceding and current row)")
def rolling7(spark: SparkSession, d: str) -> DataFrame:
    return rounded(series.rolling_mean(_days(spark, d)).withColumn("day", text("day")))


@R.add("""with c as (select cast(date_trunc('week', o_orderdate) as date) + 6 as w, count(*) as n from orders group by 1),
g as (select cast(unnest(generate_series((select min(w) from c)::timestamp, (select max(w) from c)::timestamp, interval 7 day)) as date) as w)
select strftime(w, '%Y-%m-%d') as week, coalesce(n, 0) as n from g left join c using (w)""")
def weekly(spark: SparkSession, d: str) -> DataFrame:
    return series.weekly(table(spark, d, "orders"), "o_orderdate").select(text("week").alias("week"), "n")


@R.add("""with c as (select cast(date_trunc('month', o_orderdate) as date) as m, count(*) as n from orders group by 1),
g as (select cast(unnest(generate_series((select min(m) from c)::timestamp, (select max(m) from c)::timestamp, interval 1 month)) as date) as m)
select strftime(last_day(m), '%Y-%m-%d') as month, coalesce(n, 0) as n from g left join c using (m)""")
def monthly(spark: SparkSession, d: str) -> DataFrame:
    return series.monthly(table(spark, d, "orders"), "o_orderdate").select(text("month").alias("month"), "n")


@R.add("select isodow(ts) - 1 as weekday, count(*) as n from events group by 1")
def day_of_week(spark: SparkSession, d: str) -> DataFrame:
    return series.by_weekday(table(spark, d, "events"), "ts")


@R.add(f"""with {_DAYS}, a as (select d, n, case when count(*) over w = 7 then avg(n) over w end as trend, (row_number() over (order by d) - 1) % 7 as p from s window w as (order by d rows between 3 preceding and 3 following)),
b as (select *, avg(n - trend) over (partition by p) as m from a), e as (select avg(m) as c from (select distinct p, m from b) x)
select strftime(d, '%Y-%m-%d') as day, n, round(trend, 4) as trend, round(m - c, 4) as season, round(n - trend - (m - c), 4) as residual from b, e""")
def seasonal(spark: SparkSession, d: str) -> DataFrame:
    return rounded(series.decompose(_days(spark, d)).withColumn("day", text("day")))


@R.add(f"""with {_DAYS}, x as (select row_number() over (order by d) as i, n - avg(n) over () as x, count(*) over () as c from s), l as (select a.i as i, a.x * b.x as p, b.i - a.i as lag, a.c as c from x a join x b on b.i >= a.i)
select lag, round(sum(p) / (select sum(p) from l where lag = 0), 6) as acf from l where lag <= least(30, c // 2 - 1) group by lag""")
def acf(spark: SparkSession, d: str) -> DataFrame:
    return rounded(series.autocorrelation(_days(spark, d)), 6)


@R.add("""select o_orderpriority, count(*) filter (where o_orderdate < timestamp '1998-01-01') as first_half, count(*) filter (where o_orderdate >= timestamp '1998-01-01') as second_half,
round(100.0 * (count(*) filter (where o_orderdate >= timestamp '1998-01-01') - count(*) filter (where o_orderdate < timestamp '1998-01-01')) / nullif(count(*) filter (where o_orderdate < timestamp '1998-01-01'), 0), 4) as growth_pct from orders group by 1""")
def growth_halves(spark: SparkSession, d: str) -> DataFrame:
    return rounded(series.growth_halves(table(spark, d, "orders"), "o_orderdate", "o_orderpriority", F.lit("1998-01-01").cast("timestamp_ntz")))


@R.add("""with c as (select o_orderpriority as p, cast(date_trunc('week', o_orderdate) as date) + 6 as w, count(*) as n from orders group by 1, 2),
g as (select p, cast(unnest(generate_series((select min(w) from c)::timestamp, (select max(w) from c)::timestamp, interval 7 day)) as date) as w from (select distinct p from c) x)
select p as o_orderpriority, count(*) as weeks, round(avg(coalesce(n, 0)), 6) as mean, round(stddev_samp(coalesce(n, 0)) / avg(coalesce(n, 0)), 6) as cv from g left join c using (p, w) group by p""")
def volatility(spark: SparkSession, d: str) -> DataFrame:
    return rounded(series.volatility(table(spark, d, "orders"), "o_orderdate", "o_orderpriority"), 6)


@R.add("select strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') as month, o_orderpriority, count(*) as n, round(100.0 * count(*) / sum(count(*)) over (partition by date_trunc('month', o_orderdate)), 4) as pct from orders group by date_trunc('month', o_orderdate), o_orderpriority")
def period_share(spark: SparkSession, d: str) -> DataFrame:
    return rounded(series.period_share(table(spark, d, "orders"), "o_orderdate", "o_orderpriority").withColumn("month", text("month")))


@R.add("select l_suppkey as value, count(*) as n from lineitem group by 1 order by n desc, value limit 20")
def topn_values(spark: SparkSession, d: str) -> DataFrame:
    return groups.value_counts(table(spark, d, "lineitem"), "l_suppkey", 20)


@R.add("select o_orderpriority, o_orderkey, round(o_totalprice, 2) as o_totalprice, rank from (select *, row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) as rank from orders) x where rank <= 10")
def topn_per_group(spark: SparkSession, d: str) -> DataFrame:
    return rounded(sets.top_per_group(table(spark, d, "orders"), "o_orderpriority", "o_totalprice", 10, "o_orderkey").select("o_orderpriority", "o_orderkey", "o_totalprice", "rank"), 2)


@R.add("""select 'low' as side, * from (select o_orderkey, round(o_totalprice, 2) as o_totalprice from orders where o_totalprice > 0 order by orders.o_totalprice, o_orderkey limit 20) a
union all select 'high', * from (select o_orderkey, round(o_totalprice, 2) from orders order by orders.o_totalprice desc, o_orderkey limit 20) b""")
def extremes(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    low = sets.extremes(orders, "o_totalprice", 20, "o_orderkey", low=True).select(F.lit("low").alias("side"), "o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice"))
    return low.unionByName(sets.extremes(orders, "o_totalprice", 20, "o_orderkey").select(F.lit("high").alias("side"), "o_orderkey", F.round("o_totalprice", 2).alias("o_totalprice")))


@R.add("""select position, o_orderstatus, n from (select * from (values (0, 'P'), (1, 'X'), (2, 'F'), (3, 'O')) v(position, o_orderstatus)) v left join (select o_orderstatus, count(*) as n from orders group by 1) c using (o_orderstatus)""")
def declared_order(spark: SparkSession, d: str) -> DataFrame:
    counts = table(spark, d, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return sets.in_order(counts, "o_orderstatus", ["P", "X", "F", "O"])


@R.add("select o_orderkey, o_totalprice from orders order by md5('42:' || o_orderkey), o_orderkey limit 100")
def seeded_sample(spark: SparkSession, d: str) -> DataFrame:
    return sets.seeded_sample(table(spark, d, "orders"), "o_orderkey", 100).select("o_orderkey", "o_totalprice")


def _lines(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").join(table(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))


@R.add("select p_brand, count(*) as n, round(avg(l_extendedprice), 4) as mean, round(median(l_extendedprice), 4) as median from lineitem join part on l_partkey = p_partkey group by 1 having count(*) >= 100 order by median(l_extendedprice) desc, p_brand limit 15")
def group_stats_support(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.group_stats(_lines(spark, d), "p_brand", "l_extendedprice", 100, 15))


@R.add("""select p_brand, count(*) as n, round(quantile_cont(l_extendedprice, 0.25), 4) as q1, round(median(l_extendedprice), 4) as median, round(quantile_cont(l_extendedprice, 0.75), 4) as q3,
round(quantile_cont(l_extendedprice, 0.75) - quantile_cont(l_extendedprice, 0.25), 4) as iqr, round(stddev_samp(l_extendedprice), 4) as std from lineitem join part on l_partkey = p_partkey group by 1""")
def group_quartiles(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.group_quartiles(_lines(spark, d), "p_brand", "l_extendedprice"))


@R.add("""select p_brand, round(median(l_extendedprice), 4) as median, (select round(median(l_extendedprice), 4) from lineitem) as overall, round(100 * (median(l_extendedprice) / (select median(l_extendedprice) from lineitem) - 1), 4) as pct
from lineitem join part on l_partkey = p_partkey group by 1""")
def vs_overall(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.median_vs_overall(_lines(spark, d), "p_brand", "l_extendedprice"))


@R.add("select p_brand, median_price, 1 + count(*) filter (where other > median_price) + (count(*) filter (where other = median_price) - 1) / 2.0 as rank from (select a.*, b.median_price as other from (select p_brand, round(median(l_extendedprice), 4) as median_price from lineitem join part on l_partkey = p_partkey group by 1) a, (select p_brand as x, round(median(l_extendedprice), 4) as median_price from lineitem join part on l_partkey = p_partkey group by 1) b) y group by all")
def median_ranks(spark: SparkSession, d: str) -> DataFrame:
    medians = ordered.group_quantiles(_lines(spark, d), ["p_brand"], "l_extendedprice", [0.5]).select("p_brand", F.round("q0", 4).alias("median_price"))
    ranks = groups.average_ranks(medians.withColumn("down", -F.col("median_price")), "down", "rank")
    return ranks.select("p_brand", "median_price", "rank")


_PIVOT = ", ".join(f"count(*) filter (where event_type = '{e}') as {e}" for e in EVENT_TYPES)


@R.add(f"select strftime(date_trunc('day', ts), '%Y-%m-%d') as day, {_PIVOT} from events group by 1")
def pivot_month(spark: SparkSession, d: str) -> DataFrame:
    return groups.pivot_counts(table(spark, d, "events"), text(F.to_date("ts")), "day", "event_type", EVENT_TYPES)


@R.add("select o_orderpriority, " + ", ".join(f"round(median(o_totalprice) filter (where o_orderstatus = '{s}'), 4) as \"{s}\"" for s in ORDER_STATUS) + " from orders group by 1")
def two_way_median(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.pivot_median(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus", "o_totalprice", ORDER_STATUS))


@R.add("select o_orderpriority, o_orderstatus, count(*) as n, round(count(*) / sum(count(*)) over (partition by o_orderpriority), 6) as share from orders group by 1, 2")
def crosstab_share(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.crosstab_share(table(spark, d, "orders"), "o_orderpriority", "o_orderstatus"), 6)


@R.add("select o_custkey, count(*) as n, (list(o_orderstatus order by o_orderkey))[1] as o_orderstatus, (list(o_orderpriority order by o_orderkey))[1] as o_orderpriority from orders group by 1")
def rollup_first(spark: SparkSession, d: str) -> DataFrame:
    return groups.rollup_first(table(spark, d, "orders"), "o_custkey", "o_orderkey", ["o_orderstatus", "o_orderpriority"])


@R.add("select l_shipyear, count(*) as n, count(*) filter (where l_returnflag = 'R') as hits, round(100.0 * count(*) filter (where l_returnflag = 'R') / count(*), 4) as pct from (select *, year(l_shipdate) as l_shipyear from lineitem) x group by 1")
def rate_by_group(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.rate_by_group(table(spark, d, "lineitem").withColumn("l_shipyear", F.year("l_shipdate")), "l_shipyear", F.col("l_returnflag") == "R"))


def _labelled(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", "lang", "source", "n_chars").join(table(spark, d, "labels"), "doc_id", "left")


_LABELLED = "x as (select d.doc_id, lang, source, n_chars, quality, toxic from documents d left join labels l on d.doc_id = l.doc_id)"


def _profile_sql(columns: dict[str, str]) -> str:
    return f"with {_LABELLED} " + " union all ".join(f"select '{c}' as \"column\", '{k}' as dtype, count({c}) as non_null, round(100.0 * (count(*) - count({c})) / count(*), 4) as null_pct, count(distinct {c}) as \"distinct\", round(100.0 * count(distinct {c}) / count(*), 4) as distinct_pct from x" for c, k in columns.items())


@R.add(_profile_sql({"lang": "string", "source": "string", "quality": "int", "toxic": "int", "doc_id": "bigint"}))
def profile(spark: SparkSession, d: str) -> DataFrame:
    return groups.profile(_labelled(spark, d), ["lang", "source", "quality", "toxic", "doc_id"])


def _audit_sql(c: str, source: str) -> str:
    qs = ", ".join(f"round(quantile_cont({c}, {p / 100}), 4) as p{str(p).replace('.', '_')}" for p in groups.PERCENTS)
    return f"select '{c}' as \"column\", count({c}) as n, count(*) - count({c}) as missing, round(min({c}), 4) as low, {qs}, round(max({c}), 4) as high, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std, count(*) filter (where {c} = 0) as zeros, count(*) filter (where {c} < 0) as negatives from {source}"


@R.add(f"{_audit_sql('c_acctbal', 'customer')}")
def numeric_audit(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.numeric_audit(table(spark, d, "customer"), ["c_acctbal"]))


def _moments(x: str) -> str:
    return f"(select avg({x}) as m, var_pop({x}) as v, count({x}) as n from orders)"


@R.add(" union all ".join(
    f"select '{name}' as scale, round((select avg(pow({x} - m, 3)) / pow(any_value(v), 1.5) from orders, {_moments(x)} s), 4) as skewness, round((select avg(pow({x} - m, 4)) / pow(any_value(v), 2) - 3 from orders, {_moments(x)} s), 4) as kurtosis, " + ", ".join(f"round((select quantile_cont({x}, {p / 100}) from orders), 4) as p{p}" for p in (5, 25, 50, 75, 95))
    for name, x in (("raw", "o_totalprice"), ("log1p", "ln(1 + o_totalprice)"))
))
def distribution(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.distribution(table(spark, d, "orders"), "o_totalprice"))


@R.add(f"with {_LABELLED}, y as (" + " union all ".join(f"select '{c}' as \"column\", count(*) - count({c}) as missing, round(100.0 * (count(*) - count({c})) / count(*), 4) as pct from x" for c in ("lang", "quality", "toxic")) + ") select *, case when pct = 0 then 'complete' when pct < 5 then 'low' when pct < 20 then 'moderate' when pct < 50 then 'high' else 'severe' end as band from y")
def missing_bands(spark: SparkSession, d: str) -> DataFrame:
    return groups.missing_bands(_labelled(spark, d), ["lang", "quality", "toxic"])


@R.add('with c as (select l_partkey, count(*) as n from lineitem group by 1) select "limit", count(*) filter (where n <= "limit") as categories, cast(coalesce(sum(n) filter (where n <= "limit"), 0) as bigint) as rows, round(100.0 * coalesce(sum(n) filter (where n <= "limit"), 0) / sum(n), 4) as row_pct from c, (values (1), (5), (10), (20), (50)) v("limit") group by "limit"')
def rare_categories(spark: SparkSession, d: str) -> DataFrame:
    return groups.rare_categories(table(spark, d, "lineitem"), "l_partkey")


_BINS = [("few", 0, 2), ("3-5", 2, 5), ("6-10", 5, 10), ("11-20", 10, 20), ("20+", 20, 1e9)]


@R.add("select bin, count(*) as n, round(median(l_extendedprice), 4) as median from (select *, case " + " ".join(f"when l_quantity > {a} and l_quantity <= {b} then '{n}'" for n, a, b in _BINS) + " end as bin from lineitem) x where bin is not null group by 1")
def bins(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.binned(table(spark, d, "lineitem"), "l_quantity", _BINS, "l_extendedprice"))


_SCENARIOS = {"label": ["quality"], "label_and_lang": ["quality", "lang"], "all": ["lang", "source"]}


@R.add(f"with {_LABELLED} " + " union all ".join(f"select '{s}' as scenario, count(*) filter (where {w}) as n, round(100.0 * count(*) filter (where {w}) / count(*), 4) as coverage_pct, round(median(n_chars) filter (where {w}), 4) as median, round(100 * (median(n_chars) filter (where {w}) / median(n_chars) - 1), 4) as vs_all_pct from x" for s, w in ((s, " and ".join(f"{c} is not null" for c in cs)) for s, cs in _SCENARIOS.items())))
def scenarios(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.scenarios(_labelled(spark, d), _SCENARIOS, "n_chars"))


@R.add('select "limit", count(*) filter (where o_totalprice > "limit") as above from orders, (values (100000.0::double), (200000.0), (300000.0), (400000.0)) v("limit") group by "limit"')
def thresholds(spark: SparkSession, d: str) -> DataFrame:
    return groups.threshold_counts(table(spark, d, "orders"), "o_totalprice", [100000, 200000, 300000, 400000])


@R.add("select count(*) as keys, round(avg(n), 4) as mean, round(stddev_samp(n), 4) as std, min(n) as low, round(median(n), 4) as median, max(n) as high from (select count(*) as n from lineitem group by l_orderkey) x")
def key_cardinality(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.key_cardinality(table(spark, d, "lineitem"), ["l_orderkey"]))


_NUMBERS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_PAIRS = [(a, b) for i, a in enumerate(_NUMBERS) for b in _NUMBERS[i + 1 :]]


@R.add(" union all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as r from lineitem" for a, b in _PAIRS))
def correlations(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.correlations(table(spark, d, "lineitem"), _NUMBERS), 6)


@R.add(" union all ".join(f"select '{a}' as a, '{b}' as b, round(corr(ln(1 + {a}), ln(1 + {b})), 6) as r from lineitem" for a, b in _PAIRS))
def loglog_correlations(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.correlations(table(spark, d, "lineitem"), _NUMBERS, "loglog"), 6)


@R.add("with x as (select " + ", ".join(f"rank() over (order by {c}) + (count(*) over (partition by {c}) - 1) / 2.0 as {c}" for c in _NUMBERS) + " from lineitem) " + " union all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as r from x" for a, b in _PAIRS))
def spearman(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.correlations(table(spark, d, "lineitem"), _NUMBERS, "spearman"), 6)


@R.add("select * from (" + " union all ".join(f"select '{a}' as a, '{b}' as b, round(corr({a}, {b}), 6) as r from lineitem" for a, b in _PAIRS) + ") x where abs(r) > 0.6")
def strong_pairs(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.strong_pairs(table(spark, d, "lineitem"), _NUMBERS), 6)


# the tail of F by the continued fraction of the incomplete beta function: row k of l holds its state after k terms
@R.add("""with recursive r as (select l_extendedprice as v, p_brand, l_returnflag, l_linestatus from lineitem join part on l_partkey = p_partkey),
x as (select 'p_brand' as category, p_brand as g, v from r union all select 'l_returnflag', l_returnflag, v from r union all select 'l_linestatus', l_linestatus, v from r),
g as (select category, g, count(*) as n, avg(v) as m, var_pop(v) as w, median(v) as md from x where v is not null group by 1, 2 having count(*) > 1),
t as (select category, sum(n * m) / sum(n) as gm from g group by 1),
a as (select category, count(*) as groups, cast(sum(n) as bigint) as n, (sum(n * pow(m - gm, 2)) / (count(*) - 1)) / (sum(n * w) / (sum(n) - count(*))) as f, cast(count(*) - 1 as double) as d1, cast(sum(n) - count(*) as double) as d2, max(md) - min(md) as median_spread from g join t using (category) group by 1),
i as (select category, case when flip then d1 / 2 else d2 / 2 end as a, case when flip then d2 / 2 else d1 / 2 end as b, case when flip then 1 - y else y end as y, flip
      from (select category, d1, d2, d2 / (d2 + d1 * f) as y, d2 / (d2 + d1 * f) >= (d2 / 2 + 1) / (d1 / 2 + d2 / 2 + 2) as flip from a) z),
l as (
  select category, a, b, y, 2 as k, 1.0::double as c, 1 / (1 - (a + b) * y / (a + 1)) as d, 1 / (1 - (a + b) * y / (a + 1)) as o from i
  union all
  select category, a, b, y, k + 1, 1 + e / c, 1 / (1 + e * d), o * (1 + e / c) / (1 + e * d)
  from (select *, case when k % 2 = 0 then (k // 2) * (b - k // 2) * y / ((a + 2 * (k // 2) - 1) * (a + 2 * (k // 2))) else -(a + k // 2) * (a + b + k // 2) * y / ((a + 2 * (k // 2)) * (a + 2 * (k // 2) + 1)) end as e from l where k <= 201) s),
p as (select l.category, exp(lgamma(a + b) - lgamma(a) - lgamma(b) + a * ln(y) + b * ln(1 - y)) / a * o as q from l where k = 202)
select a.category, groups, n, round(f, 4) as f, round(case when flip then 1 - q else q end, 4) as p, cast(d1 as bigint) as df_between, cast(d2 as bigint) as df_within, round(median_spread, 4) as median_spread
from a join i using (category) join p using (category)""")
def anova_f(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.anova(_lines(spark, d), ["p_brand", "l_returnflag", "l_linestatus"], "l_extendedprice"))


_KEYWORDS = ["the", "that", "with", "from", "this"]


@R.add("select keyword, count(*) as n, round(median(n_chars), 4) as median, round(avg(n_chars), 4) as mean from (select n_chars, lower(text) as t from documents) x, (values " + ", ".join(f"('{k}')" for k in _KEYWORDS) + r") v(keyword) where regexp_matches(t, '\b' || keyword || '\b') group by 1")
def keyword_gradient(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.keyword_gradient(table(spark, d, "documents"), "text", "n_chars", _KEYWORDS))


@R.add("""with w as (select doc_id, list_filter(regexp_extract_all(lower(text), '[a-z]{2,}'), lambda x: x not in ('the', 'of')) as w from documents),
t as (select 'token' as kind, unnest(w) as term from w union all select 'bigram', w[i] || ' ' || w[i + 1] from (select w, unnest(generate_series(1, len(w) - 1)) as i from w where len(w) > 1) x)
select kind, term, n from (select *, row_number() over (partition by kind order by n desc, term) as r from (select kind, term, count(*) as n from t group by 1, 2) y) z where r <= 50""")
def tokens_bigrams(spark: SparkSession, d: str) -> DataFrame:
    words = table(spark, d, "documents").select(C.tokens(F.col("text"), ("the", "of")).alias("w"))
    one = groups.value_counts(words.select(F.explode("w").alias("t")), "t", 50).select(F.lit("token").alias("kind"), F.col("value").alias("term"), "n")
    return one.unionByName(groups.value_counts(words.select(F.explode(C.bigrams(F.col("w"))).alias("t")), "t", 50).select(F.lit("bigram").alias("kind"), F.col("value").alias("term"), "n"))


@R.add(r"""select conv_id, turn, array_to_string(list_sort(list_distinct(regexp_extract_all(' ' || regexp_replace(lower(text), '[^a-z0-9]+', '  ', 'g') || ' ', ' (le|la|the|of|de) ', 1))), '|') as terms from conversations""")
def skill_extract(spark: SparkSession, d: str) -> DataFrame:
    plain = F.regexp_replace(F.lower("text"), "[^a-z0-9]+", "  ")
    found = C.mentions(plain, ["le", "la", "the", "of", "de"])
    return table(spark, d, "conversations").select("conv_id", "turn", F.array_join(F.array_sort(found), "|").alias("terms"))


@R.add("""select round(q[1], 4) as q1, round(q[2], 4) as q3, round(q[1] - 1.5 * (q[2] - q[1]), 4) as low_fence, round(q[2] + 1.5 * (q[2] - q[1]), 4) as high_fence,
(select count(*) from lineitem where l_extendedprice not between q[1] - 1.5 * (q[2] - q[1]) and q[2] + 1.5 * (q[2] - q[1])) as outliers,
round(100.0 * (select count(*) from lineitem where l_extendedprice not between q[1] - 1.5 * (q[2] - q[1]) and q[2] + 1.5 * (q[2] - q[1])) / (select count(*) from lineitem), 4) as pct
from (select quantile_cont(l_extendedprice, [0.25, 0.75]) as q from lineitem) x""")
def outliers_iqr(spark: SparkSession, d: str) -> DataFrame:
    return rounded(sets.iqr_outliers(table(spark, d, "lineitem"), "l_extendedprice"))


@R.add("select o_orderkey, round(o_totalprice, 2) as o_totalprice from orders where o_totalprice between (select quantile_cont(o_totalprice, 0.01) from orders) and (select quantile_cont(o_totalprice, 0.99) from orders)")
def clip_percentile(spark: SparkSession, d: str) -> DataFrame:
    return rounded(sets.clip_percentiles(table(spark, d, "orders"), "o_totalprice").select("o_orderkey", "o_totalprice"), 2)


@R.add("select l_returnflag, count(l_extendedprice / l_quantity) as n, round(median(l_extendedprice / l_quantity), 4) as ratio from lineitem group by 1")
def ratio_by_group(spark: SparkSession, d: str) -> DataFrame:
    return rounded(sets.median_ratio(table(spark, d, "lineitem"), "l_returnflag", F.col("l_extendedprice"), F.col("l_quantity")))


@R.add("select round(100 * avg((abs(l_extendedprice * (1 - l_discount) - l_extendedprice) < 100)::int), 4) as pct from lineitem")
def close_share(spark: SparkSession, d: str) -> DataFrame:
    price = F.col("l_extendedprice")
    return rounded(sets.close_share(table(spark, d, "lineitem"), price * (1 - F.col("l_discount")), price, 100.0))


@R.add("select distinct l_quantity as value, round(cume_dist() over (order by l_quantity), 6) as share from lineitem")
def ecdf(spark: SparkSession, d: str) -> DataFrame:
    return rounded(sets.ecdf(table(spark, d, "lineitem"), "l_quantity"), 6)


@R.add("""select 'custkey' as keys, count(*) as rows, count(*) - count(distinct o_custkey) as duplicates, round(100.0 * (count(*) - count(distinct o_custkey)) / count(*), 4) as pct from orders
union all select 'custkey_status', count(*), count(*) - count(distinct (o_custkey, o_orderstatus)), round(100.0 * (count(*) - count(distinct (o_custkey, o_orderstatus))) / count(*), 4) from orders""")
def duplicate_rates(spark: SparkSession, d: str) -> DataFrame:
    return groups.duplicate_rate(table(spark, d, "orders"), {"custkey": ["o_custkey"], "custkey_status": ["o_custkey", "o_orderstatus"]})


@R.add("""select count(text) as n, round(100.0 * count(text) / count(*), 4) as coverage_pct, round(avg(length(text)), 4) as mean, round(median(length(text)), 4) as median, round(quantile_cont(length(text), 0.95), 4) as p95, max(length(text)) as longest from documents""")
def text_lengths(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.text_lengths(table(spark, d, "documents"), "text"))


@R.add(f"with {_LABELLED} select case when quality is null and lang is null and n_chars is null then 'none' else concat_ws('+', case when quality is not null then 'quality' end, case when lang is not null then 'lang' end, case when n_chars is not null then 'n_chars' end) end as pattern, count(*) as n from x group by 1")
def presence_patterns(spark: SparkSession, d: str) -> DataFrame:
    return groups.presence_patterns(_labelled(spark, d), ["quality", "lang", "n_chars"])


@R.add(r"select round(100 * avg(regexp_matches(text, '(?i)licen[sc]e')::int), 4) as pct, round(100 * avg(case when lang = 'en' then regexp_matches(text, '(?i)licen[sc]e')::int end), 4) as flagged_pct from documents")
def pattern_share(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.pattern_share(table(spark, d, "documents"), "text", "(?i)licen[sc]e", F.col("lang") == "en"))


@R.add("select count(*) as n, count(*) filter (where list_contains(string_split(p_name, ' '), 'small')) as agree, round(100 * avg(list_contains(string_split(p_name, ' '), 'small')::int), 4) as pct from part")
def set_agreement(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.agreement(table(spark, d, "part"), F.array_contains(F.split("p_name", " "), "small")))


@R.add("""select event_type, count(*) filter (where extract(hour from ts) < 12) / count(*)::double as am, count(*) filter (where extract(hour from ts) >= 12) / count(*)::double as pm from events group by 1""")
def crosstab_wide(spark: SparkSession, d: str) -> DataFrame:
    halves = table(spark, d, "events").withColumn("half", F.when(F.hour("ts") < 12, "am").otherwise("pm"))
    return groups.crosstab_wide(halves, "event_type", "half", ["am", "pm"], normalise=True)


@R.add("""with p as (select split_part(p_type, ' ', 1) as a, split_part(p_type, ' ', 2) as b, p_brand from part),
g as (select p_brand, a, count(*) as n from p group by 1, 2), t as (select p_brand, a, row_number() over (partition by p_brand order by n desc, a) as r from g)
select p.p_brand, count(*) as n, count(*) filter (where p.a = t.a) as agree, round(100 * avg((p.a = t.a)::int), 4) as pct from p join t on p.p_brand = t.p_brand and t.r = 1 group by 1""")
def top_value_agreement(spark: SparkSession, d: str) -> DataFrame:
    """How far a group's most frequent value stands for its rows."""
    part = table(spark, d, "part").select("p_brand", F.split("p_type", " ")[0].alias("a"))
    return rounded(groups.top_agreement(part, "p_brand", "a"))


@R.add("""with x as (select lower(replace(o_orderpriority, '_', ' ')) as a, lower(replace(case when o_orderkey % 3 = 0 then upper(replace(o_orderpriority, ' ', '_')) when o_orderkey % 3 = 1 then o_orderpriority else '5-LOW' end, '_', ' ')) as b,
o_orderpriority as ra, case when o_orderkey % 3 = 0 then upper(replace(o_orderpriority, ' ', '_')) when o_orderkey % 3 = 1 then o_orderpriority else '5-LOW' end as rb from orders)
select (select count(*) from (select distinct ra, rb from x) d) as pairs, count(*) filter (where a = b) as agree, round(100.0 * count(*) filter (where a = b) / count(*), 4) as pct from x""")
def category_pairs(spark: SparkSession, d: str) -> DataFrame:
    """Rows in which two spellings of a category mean the same."""
    key, priority = F.col("o_orderkey") % 3, F.col("o_orderpriority")
    other = F.when(key == 0, F.upper(F.translate(priority, " ", "_"))).when(key == 1, priority).otherwise("5-LOW")
    return rounded(groups.same_category(table(spark, d, "orders").withColumn("other", other), "o_orderpriority", "other"))
