"""Feature columns, missing values, pay targets and splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.core import fingerprint
from millrace.core.scratch import new_path
from millrace.functions import columns as C
from millrace.functions import geography
from millrace.operators import features, groups, split, target
from millrace.operators.steps import StepLog
from millrace.plans.registry import Registry, rounded, table, text

R = Registry()


@R.add("""select p_partkey, array_to_string(list_sort(list_distinct(list_transform(string_split(p_name || ' ' || p_type, ' '), lambda x: upper(x)))), '|') as items,
len(list_distinct(list_transform(string_split(p_name || ' ' || p_type, ' '), lambda x: upper(x)))) as n from part""")
def list_normalise(spark: SparkSession, d: str) -> DataFrame:
    items = C.standard_list(C.list_items(F.regexp_replace(F.concat_ws(" ", "p_name", "p_type"), " ", "|")))
    return table(spark, d, "part").select("p_partkey", F.array_join(items, "|").alias("items"), C.list_length(items).alias("n"))


_ITEMS = "i as (select p_partkey, p_retailprice as v, unnest(list_distinct(string_split(p_name, ' '))) as item from part)"


@R.add(f"with {_ITEMS} select item, count(*) as n, round(100.0 * count(*) / (select count(*) from part), 4) as pct from i group by item")
def list_frequency(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.item_frequency(table(spark, d, "part"), F.split("p_name", " ")))


@R.add(f"with {_ITEMS} select item, count(*) as n, round(avg(v), 4) as mean, round(median(v), 4) as median, round(stddev_samp(v), 4) as std, round(min(v), 4) as low, round(max(v), 4) as high from i group by item having count(*) >= 5")
def list_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.item_stats(table(spark, d, "part"), F.split("p_name", " "), "p_retailprice", 5))


@R.add(f"""with {_ITEMS}, t as (select item, count(*) as n from i group by item order by n desc, item limit 10),
x as (select t.item, t.n, p_retailprice as v, list_contains(string_split(p_name, ' '), t.item) as has from t, part)
select item, max(n) as n, round(median(case when has then v end), 4) as with_median, round(median(case when not has then v end), 4) as without_median, round(median(case when has then v end) - median(case when not has then v end), 4) as difference from x group by item""")
def with_without(spark: SparkSession, d: str) -> DataFrame:
    return rounded(groups.with_without(table(spark, d, "part"), F.split("p_name", " "), "p_retailprice", 10))


@R.add("""select event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') as seconds, year(ts) as y, month(ts) as m, quarter(ts) as q, (isodow(ts) - 1) as dow, strftime(date_trunc('month', ts), '%Y-%m-%d') as month_start,
date_diff('day', date '2024-01-01', cast(ts as date)) as days, case when event_id % 5 = 0 then null else epoch_us(ts) // 1000 end as ms from events""")
def epoch_and_dates(spark: SparkSession, d: str) -> DataFrame:
    ts = F.col("ts").cast("timestamp")
    ms = F.when(F.col("event_id") % 5 == 0, "no date").otherwise(F.unix_millis(ts).cast("string"))
    rows = table(spark, d, "events").select("event_id", "ts", ms.alias("ms")).withColumn("back", C.epoch_ms(F.col("ms")))
    return rows.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("seconds"), F.year("ts").alias("y"), F.month("ts").alias("m"), F.quarter("ts").alias("q"), F.weekday("ts").alias("dow"),
        text(F.trunc("ts", "month")).alias("month_start"), F.datediff("ts", F.lit("2024-01-01").cast("date")).alias("days"), F.unix_millis("back").alias("ms"),
    )


@R.add("select d.doc_id, case when quality is null then null else quality = 1 end as good, case when lang is null then null else lang in ('t', 'y', 'true', 'yes', '1') end as lang_true from documents d left join labels l on d.doc_id = l.doc_id")
def booleans(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    return rows.select("doc_id", C.boolean(F.col("quality")).alias("good"), C.boolean(F.col("lang")).alias("lang_true"))


@R.add(r"""select c_custkey, lower(trim(c_mktsegment)) as segment, regexp_replace(regexp_replace(upper(regexp_replace(trim(c_name), '[^A-Za-z0-9]+', '_', 'g')), '^_+', ''), '_+$', '') as name_code from customer""")
def categories(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "customer").select("c_custkey", C.category(F.col("c_mktsegment")).alias("segment"), C.upper_snake(F.col("c_name")).alias("name_code"))


@R.add("""with x as (select d.doc_id, quality, case when d.doc_id % 3 = 0 then null else source end as source, case when d.doc_id % 4 = 0 then null else n_chars end as n_chars, lang from documents d left join labels l on d.doc_id = l.doc_id),
m as (select round(median(quality)) as q, median(n_chars) as c, (select source from x where source is not null group by source order by count(*) desc, source limit 1) as s from x)
select doc_id, coalesce(quality, cast(q as int)) as quality, coalesce(source, s) as source, coalesce(n_chars, cast(round(c) as bigint)) as n_chars, lang from x, m""")
def fill_missing(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    rows = rows.select("doc_id", "quality", F.when(F.col("doc_id") % 3 != 0, F.col("source")).alias("source"), F.when(F.col("doc_id") % 4 != 0, F.col("n_chars")).alias("n_chars"), "lang")
    return features.fill_missing(rows, {"quality": "median", "source": "mode", "n_chars": "median", "lang": "leave"})


# Orders stand in for listings: keys as applications, dates as epoch texts (some unreadable), priorities as kinds and skills.
_STORE = """x as (select case when o_orderkey % 5 <> 0 then o_custkey end as applies, case when o_orderkey % 3 <> 0 then o_orderdate end as listed, case o_orderstatus when 'F' then 'Yes' when 'O' then '0' end as remote,
case when o_orderkey % 7 <> 0 then o_orderpriority end as kind, case when o_orderstatus <> 'P' then 'Order ' || o_orderstatus end as title, o_orderpriority as skills, case when o_orderstatus = 'F' then o_totalprice end as pay from orders),
m as (select round(median(applies)) as a, (select remote from x where remote is not null group by 1 order by count(*) desc, 1 limit 1) as r, (select kind from x where kind is not null group by 1 order by count(*) desc, 1 limit 1) as k from x),
f as (select cast(coalesce(applies, a) as bigint) as applies, strftime(listed, '%Y-%m-%d') as listed_time, lower(coalesce(remote, r)) in ('yes', '1') as remote_allowed, lower(coalesce(kind, k)) as work_type, coalesce(title, 'UNKNOWN') as title,
array_to_string(list_sort(list_transform(string_split(skills, '-'), lambda x: trim(regexp_replace(upper(x), '[^A-Z0-9]+', '_', 'g'), '_'))), '|') as skill_list, pay as min_salary, pay is not null as salary_available, listed is not null as listing_age_available,
len(string_split(skills, '-')) as skill_count from x, m)"""


def _listings(spark: SparkSession, d: str) -> DataFrame:
    key, status, priority = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    return table(spark, d, "orders").select(
        key.alias("job_id"), F.when(key % 5 != 0, F.col("o_custkey")).alias("applies"), F.when(key % 3 != 0, F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string")).otherwise("soon").alias("listed_time"),
        F.when(status == "F", "Yes").when(status == "O", "0").alias("remote_allowed"), F.when(key % 7 != 0, F.concat(F.lit(" "), priority, F.lit(" "))).alias("work_type"),
        F.when(status != "P", F.concat(F.lit("  Order   "), status)).alias("title"), F.translate(priority, "-", "|").alias("skill_list"), F.when(status == "F", F.col("o_totalprice")).alias("min_salary"),
    )


@R.add(f"with {_STORE} select distinct * from f")
def feature_store(spark: SparkSession, d: str) -> DataFrame:
    """The feature store as a whole, checked for what it must hold."""
    store = features.build_features(_listings(spark, d))
    features.check_store(store, ("salary_available", "listing_age_available", "skill_count"))
    return store.withColumns({"listed_time": F.date_format("listed_time", "yyyy-MM-dd"), "skill_list": F.array_join("skill_list", "|")})


@R.add(f"""with {_STORE}, u as (select distinct * from f),
n as (select count(*) as n, 4 * count(*) - count(applies) - count(remote) - count(kind) - count(title) as filled, count(*) - count(pay) as pay, count(*) filter (where listed is null) as lost from x),
s as (select 0 as step, 'input' as name, 8 as columns, n as rows, filled + pay as nulls from n union all select 1, 'types', 7, n, filled + pay from n union all select 2, 'dates', 7, n, filled + pay + lost from n
  union all select 3, 'missing values', 7, n, pay + lost from n union all select 4, 'values', 7, n, pay + lost from n union all select 5, 'derived', 10, n, pay + lost from n
  union all select 6, 'duplicates', 10, count(*), 2 * count(*) - count(listed_time) - count(min_salary) from u)
select 'features' as "table", step, name, metric, cast(value as bigint) as value from (
  select step, name, 'rows' as metric, rows as value from s union all select step, name, 'columns', columns from s union all select step, name, 'nulls', nulls from s union all select 1, 'types', 'lost', lost from n) y""")
def feature_steps(spark: SparkSession, d: str) -> DataFrame:
    """Rows, columns, nulls and unreadable dates of every step of the store, from the run that writes it."""
    log = StepLog()
    log.write(features.build_features(_listings(spark, d), log=log), new_path(spark, "store"))
    return log.report(spark)


@R.add(r"""select doc_id, nullif(trim(regexp_replace(nfc_normalize(text), '[\s\x0B\x85\p{Z}]+', ' ', 'g')), '') as text from documents""")
def text_cleanup(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select("doc_id", C.clean_text(F.col("text")).alias("text"))


@R.add("select d.doc_id, quality is not null as salary_available, text is not null as has_description, len(string_split(text, ' ')) as skill_count from documents d left join labels l on d.doc_id = l.doc_id")
def derived_features(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    rows = rows.select("doc_id", F.col("quality").alias("min_salary"), F.col("text").alias("description"), F.split("text", " ").alias("skill_list"))
    return features.derived(rows).select("doc_id", "salary_available", "has_description", "skill_count")


# Line items stand in for listings: a price range, a period by return flag, a currency by line status.
_PAY_SQL = """p as (select l_orderkey, l_linenumber, l_partkey, l_extendedprice * (1 - l_discount) as lo, case when l_linenumber = 3 then l_extendedprice * 0.5 else l_extendedprice * (1 + l_tax) end as hi,
case when l_linenumber = 4 then 250 else l_extendedprice end as mid, case l_returnflag when 'A' then 'YEARLY' when 'N' then 'MONTHLY' else 'HOURLY' end as period, case l_linestatus when 'F' then 'USD' else 'EUR' end as cur, l_quantity, l_suppkey from lineitem),
q as (select *, case when lo > 0 and hi > 0 and lo <= hi and l_linenumber <> 4 then (lo + hi) / 2 when mid > 0 then mid end as raw, case when lo > 0 and hi > 0 and lo <= hi and l_linenumber <> 4 then 'midpoint' when mid > 0 then 'median' end as src from p),
r as (select *, raw * case period when 'YEARLY' then 1 when 'MONTHLY' then 12 else 2080 end as annual from q),
f as (select *, case when raw is null then 'no_pay' when period = 'HOURLY' and raw > 300 then 'hourly_too_high' when cur <> 'USD' then 'currency' when annual not between 10000 and 1000000 then 'out_of_bounds' end as reason from r)"""


def _pay(spark: SparkSession, d: str) -> DataFrame:
    li = table(spark, d, "lineitem")
    price = F.col("l_extendedprice")
    single = F.col("l_linenumber") == 4
    rows = li.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", F.when(~single, price * (1 - F.col("l_discount"))).alias("min_salary"),
        F.when(F.col("l_linenumber") == 3, price * 0.5).otherwise(price * (1 + F.col("l_tax"))).alias("max_salary"), F.when(single, 250.0).otherwise(price).alias("med_salary"),
        F.when(F.col("l_returnflag") == "A", "YEARLY").when(F.col("l_returnflag") == "N", "MONTHLY").otherwise("HOURLY").alias("pay_period"), F.when(F.col("l_linestatus") == "F", "USD").otherwise("EUR").alias("currency"),
    )
    return target.with_target(rows)


@R.add(f"""with {_PAY_SQL} select count(*) as rows, count(raw) as candidates, count(*) filter (where reason = 'no_pay') as no_pay, count(*) filter (where reason = 'hourly_too_high') as hourly_too_high,
count(*) filter (where reason = 'currency') as currency, 0 as period, count(*) filter (where reason = 'out_of_bounds') as out_of_bounds, count(*) filter (where reason is null) as accepted from f""")
def pay_funnel(spark: SparkSession, d: str) -> DataFrame:
    return target.funnel(_pay(spark, d))


@R.add(f"""with {_PAY_SQL} select l_orderkey, l_linenumber, l_partkey, src as salary_target_source, round(annual, 6) as target_annual_salary, round(ln(1 + annual), 6) as target_log_salary from f where reason is null""")
def pay_target(spark: SparkSession, d: str) -> DataFrame:
    rows = _pay(spark, d).where("target_annual_salary is not null")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "salary_target_source", F.round("target_annual_salary", 6).alias("target_annual_salary"), F.round("target_log_salary", 6).alias("target_log_salary"))


@R.add(f"with {_PAY_SQL} select count(*) filter (where annual is null) as null_target, count(*) filter (where isinf(annual)) as infinite_target, count(*) filter (where annual not between 10000 and 1000000) as out_of_bounds, 0 as log_differs from f where reason is null")
def target_integrity(spark: SparkSession, d: str) -> DataFrame:
    return target.violations(_pay(spark, d).where("target_annual_salary is not null"))


@R.add(f"with {_PAY_SQL} select src as salary_target_source, count(*) as rows, round(min(annual), 2) as low, round(max(annual), 2) as high, round(avg(annual), 2) as mean, round(median(annual), 2) as median, round(stddev_samp(annual), 2) as std from f where reason is null group by src")
def target_description(spark: SparkSession, d: str) -> DataFrame:
    rows = _pay(spark, d).where("target_annual_salary is not null")
    return rounded(target.describe(rows, "target_annual_salary", ["salary_target_source"]), 2)


@R.add("select o_orderkey, round(ln(1 + o_totalprice), 6) as logged, case when o_totalprice - 200000 >= 0 then round(ln(1 + o_totalprice - 200000), 6) end as shifted from orders")
def log_features(spark: SparkSession, d: str) -> DataFrame:
    return rounded(table(spark, d, "orders").select("o_orderkey", C.safe_log1p(F.col("o_totalprice")).alias("logged"), C.safe_log1p(F.col("o_totalprice") - 200000).alias("shifted")), 6)


@R.add(r"select c_custkey, sha256(regexp_replace(lower(trim(c_name)), '\s+', ' ', 'g') || '||' || lower(c_mktsegment) || '||' || coalesce(lower(n_name), 'unknown')) as posting_group_id from customer left join nation on n_nationkey = c_nationkey and n_regionkey < 3")
def group_id(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").join(table(spark, d, "nation").where("n_regionkey < 3"), F.col("n_nationkey") == F.col("c_nationkey"), "left")
    return rows.select("c_custkey", C.group_id(F.col("c_name"), F.col("c_mktsegment"), F.col("n_name")).alias("posting_group_id"))


_CITY = "(case c_custkey % 9 when 0 then 'San Jose, CA' when 1 then 'N.Y.' when 2 then 'Californie' when 3 then '94105' when 4 then 'Remote' when 5 then 'Texas / Ohio' when 6 then 'West Virginia' when 7 then 'WASHINGTON' else 'Ålaska' end)"


@R.add(f"""select c_custkey, case when c_nationkey % 5 = 4 then null else case c_custkey % 9 when 0 then 'california' when 1 then 'new york' when 2 then 'california' when 6 then 'west virginia' when 7 then 'washington' when 8 then 'alaska' end end as state,
case when c_nationkey % 5 = 4 then null else 'us' end as country, {_CITY} as raw from customer""")
def geography_names(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "customer").select("c_custkey", F.expr(_CITY).alias("raw"), F.when(F.col("c_nationkey") % 5 == 4, " n/a ").otherwise(" US").alias("c"))
    return geography.with_us_state(rows, "raw", "c", "state").select("c_custkey", "state", geography.country(F.col("c")).alias("country"), "raw")


@R.add("""with d as (select doc_id, sha256(coalesce(text, '')) as g from documents), g as (select g, row_number() over (order by md5('42:' || g), g) as place, count(*) over () as n from d group by g),
c as (select g, place, ceil(0.2 * n) as test, ceil(0.125 * (n - ceil(0.2 * n))) as validation from g)
select doc_id, case when place <= test then 'test' when place <= test + validation then 'validation' else 'train' end as split from d join c using (g)""")
def group_split(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("group"))
    return split.group_split(docs, "group").select("doc_id", "split")


_SPLIT = "s as (select *, case when o_custkey % 10 < 2 then 'test' when o_custkey % 10 = 2 then 'validation' else 'train' end as split from orders)"


def _by_rule(spark: SparkSession, d: str) -> DataFrame:
    k = F.col("o_custkey") % 10
    return table(spark, d, "orders").withColumn("split", F.when(k < 2, "test").when(k == 2, "validation").otherwise("train"))


@R.add(f"with {_SPLIT} select split, count(*) as rows, round(100.0 * count(*) / (select count(*) from orders), 4) as pct from s group by split")
def split_audit(spark: SparkSession, d: str) -> DataFrame:
    return split.ratio_audit(_by_rule(spark, d))


@R.add("select count(*) as shared_groups from (select o_orderpriority from orders group by 1 having count(distinct case when o_custkey % 10 < 2 then 0 when o_custkey % 10 = 2 then 1 else 2 end) > 1) x")
def split_leakage(spark: SparkSession, d: str) -> DataFrame:
    return split.overlap(_by_rule(spark, d), "o_orderpriority")


@R.add("select count(*) as rows_before, count(*) as rows_after, 0 as shared_rows from orders")
def split_conserved(spark: SparkSession, d: str) -> DataFrame:
    return split.conserved(table(spark, d, "orders"), _by_rule(spark, d), "o_orderkey")


@R.add(f"with {_SPLIT} select split, count(*) as rows, round(min(o_totalprice), 2) as low, round(max(o_totalprice), 2) as high, round(avg(o_totalprice), 2) as mean, round(median(o_totalprice), 2) as median, round(stddev_samp(o_totalprice), 2) as std from s group by split")
def split_target_stats(spark: SparkSession, d: str) -> DataFrame:
    return rounded(target.describe(_by_rule(spark, d), "o_totalprice", ["split"]), 2)


@R.add("select 2 * count(*) as rows, true as agree from orders")
def dataset_fingerprint(spark: SparkSession, d: str) -> DataFrame:
    """Equal content in another order and partitioning has an equal fingerprint."""
    orders = table(spark, d, "orders")
    a = fingerprint.content_fingerprint(orders).select(F.lit("as read").alias("of"), "rows", "hash_sum", "hash_xor")
    b = fingerprint.content_fingerprint(orders.repartition(7, "o_custkey")).select(F.lit("dealt anew").alias("of"), "rows", "hash_sum", "hash_xor")
    same = F.count_distinct("rows", "hash_sum", "hash_xor") == 1
    both = a.unionByName(b)
    return both.agg(F.sum("rows").alias("rows"), same.alias("agree"))


@R.add("""with g as (select count(distinct coalesce(text, '')) as g from documents), t as (select g, ceil(0.2 * g) as test from g), v as (select g, test, ceil(0.125 * (g - test)) as validation from t)
select 'test' as split, cast(test as bigint) as groups from v union all select 'validation', cast(validation as bigint) from v union all select 'train', cast(g - test - validation as bigint) from v""")
def group_split_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Groups in each part of the split; no group is in two."""
    docs = table(spark, d, "documents").select(F.coalesce("text", F.lit("")).alias("text"))
    docs = docs.select("text", F.sha2("text", 256).alias("group"))
    return split.group_split(docs, "group").groupBy("split").agg(F.count_distinct("group").alias("groups"))


@R.add(f"""with {_PAY_SQL} select round(annual, 6) as target_annual_salary, src as salary_target_source, l_quantity as company_employee_count, round(ln(1 + l_quantity), 6) as log_company_employee_count, cast(null as double) as log_company_follower_count,
sha256('part ' || l_partkey || '||unknown||unknown') as posting_group_id, 'v1' as dataset_version, 'part ' || l_partkey as title from f where reason is null""")
def modelling_rows(spark: SparkSession, d: str) -> DataFrame:
    """What a model may learn from: rows with a target, predictors that leak nothing, logged numbers, group and metadata."""
    rows = _pay(spark, d).withColumns({"title": F.concat(F.lit("part "), F.col("l_partkey")), "company_employee_count": F.col("l_quantity"), "dataset_version": F.lit("v1")})
    out = target.modelling_frame(rows)
    assert not set(out.columns) & (set(target.LEAKS) - set(target.METADATA))
    return rounded(out.drop("target_log_salary"), 6)


@R.add("""with o as (select count(*) as n, count(*) filter (where o_totalprice <= 0) as bad, count(distinct o_custkey) as groups from orders)
select name, broken from (select 'sound' as name, false as broken union all select 'null group', true union all select 'bad target', true union all select 'few groups', true) x""")
def split_contract(spark: SparkSession, d: str) -> DataFrame:
    """Which tables a split refuses: with null groups, targets that are not positive, or fewer than ten groups."""
    orders = table(spark, d, "orders").select("o_custkey", "o_totalprice", "o_orderstatus")
    tried = {
        "sound": (orders, "o_custkey"), "null group": (orders.withColumn("o_custkey", F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey"))), "o_custkey"),
        "bad target": (orders.withColumn("o_totalprice", F.col("o_totalprice") - 100000), "o_custkey"), "few groups": (orders, "o_orderstatus"),
    }
    rows = []
    for name, (df, group) in tried.items():
        try:
            split.check_input(df, group, "o_totalprice")
            rows.append((name, False))
        except ValueError:
            rows.append((name, True))
    return spark.createDataFrame(rows, "name string, broken boolean")
