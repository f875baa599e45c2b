"""Aligning, validating, cleaning and joining, on the order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.core.schemas import CleaningRule, ForeignKey, TableSchema, ValidationRules, ValueRule
from millrace.core.scratch import materialize, new_path
from millrace.operators import align, clean, consolidate, sets, sketches, skew, validate
from millrace.operators.steps import StepLog
from millrace.plans.registry import Registry, rounded, table

R = Registry()

PART = TableSchema({"part_id": "bigint", "name": "string", "brand": "string", "weight": "double", "price": "double"}, {"part_id": ("p_partkey",), "name": ("p_name",), "brand": ("P_BRAND",), "price": ("p_retailprice",)}, ("part_id",))


@R.add("select p_partkey as part_id, p_name as name, p_brand as brand, cast(null as double) as weight, p_retailprice as price, p_type as unmapped__p_type, p_size as unmapped__p_size from part")
def align_aliases(spark: SparkSession, d: str) -> DataFrame:
    return align.align(table(spark, d, "part"), PART)


@R.add("""select action, count(*) as columns, 1 as tables from (select case column_name when 'p_type' then 'preserved' when 'p_size' then 'preserved' else 'renamed' end as action
from (select unnest(['p_partkey','p_name','p_brand','p_retailprice','p_type','p_size']) as column_name, (select count(*) from part) as n) union all select 'missing') group by action""")
def alignment_report(spark: SparkSession, d: str) -> DataFrame:
    return align.alignment_summary(align.alignment_report(table(spark, d, "part"), PART, "v", "part"))


LINE_RULES = ValidationRules(
    not_null=("l_orderkey", "l_shipdate"),
    values={"l_quantity": ValueRule(low=5, high=45), "l_returnflag": ValueRule(allowed=("A", "R")), "l_linestatus": ValueRule(pattern="[F]$"), "l_discount": ValueRule(allowed=(0, 0.05), high=0.08)},
    numeric=("l_returnflag",),
)


@R.add("""select 'lineitem' as "table", * from (
select 'null' as "check", 'l_orderkey' as "column", count(*) - count(l_orderkey) as violations from lineitem
union all select 'null', 'l_shipdate', count(*) - count(l_shipdate) from lineitem
union all select 'value', 'l_quantity', count(*) filter (where l_quantity < 5 or l_quantity > 45) from lineitem
union all select 'value', 'l_returnflag', count(*) filter (where l_returnflag not in ('A', 'R')) from lineitem
union all select 'value', 'l_linestatus', count(*) filter (where l_linestatus <> 'F') from lineitem
union all select 'value', 'l_discount', count(*) filter (where l_discount not in (0, 0.05) or l_discount > 0.08) from lineitem
union all select 'type', 'l_returnflag', count(l_returnflag) from lineitem
union all select 'type', 'l_quantity', count(l_quantity) - count(try_cast(l_quantity as double)) from lineitem
union all select 'type', 'l_discount', count(l_discount) - count(try_cast(l_discount as double)) from lineitem) x""")
def validate_lineitem(spark: SparkSession, d: str) -> DataFrame:
    return validate.validate(table(spark, d, "lineitem"), LINE_RULES, "lineitem")


@R.add("""select cast(sum(n) as bigint) as duplicate_rows, count(*) as duplicate_keys, (select string_agg(k, ';' order by k) from (select l_partkey || '|' || l_suppkey as k from lineitem group by l_partkey, l_suppkey having count(*) > 1 order by k limit 5) s) as sample_keys
from (select count(*) as n from lineitem group by l_partkey, l_suppkey having count(*) > 1) x""")
def duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return validate.duplicate_keys(table(spark, d, "lineitem"), ("l_partkey", "l_suppkey"))


@R.add("""select 'labels' as child, count(*) as orphans from labels l where not exists (select 1 from documents d where d.doc_id = l.doc_id and d.lang = 'en')
union all select 'orders', count(*) from orders o where not exists (select 1 from customer c where c.c_custkey = o.o_custkey and c.c_acctbal >= 0)""")
def orphan_counts(spark: SparkSession, d: str) -> DataFrame:
    english = table(spark, d, "documents").where("lang = 'en'")
    solvent = table(spark, d, "customer").where("c_acctbal >= 0")
    a = validate.orphan_count(table(spark, d, "labels"), "doc_id", english, "doc_id").select(F.lit("labels").alias("child"), "orphans")
    return a.unionByName(validate.orphan_count(table(spark, d, "orders"), "o_custkey", solvent, "c_custkey").select(F.lit("orders").alias("child"), "orphans"))


@R.add("""select o_orderkey, case when o_custkey % 7 = 0 then null else o_custkey end as o_custkey from orders
where o_custkey % 7 = 0 or o_custkey in (select c_custkey from customer where c_acctbal >= 0)""")
def drop_orphans(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_custkey") % 7 != 0, F.col("o_custkey")).alias("o_custkey"))
    return clean.drop_orphans(orders, (ForeignKey("o_custkey", "customer", "c_custkey"),), {"customer": table(spark, d, "customer").where("c_acctbal >= 0")})


@R.add(r"""select doc_id, case when t in ('', 'nan', 'none', '<na>') then null else t end as text, url from
(select doc_id, lower(regexp_replace(regexp_replace(text, '^[\s\x0B\x85\p{Z}]+|[\s\x0B\x85\p{Z}]+$', '', 'g'), '[\s\x0B\x85\p{Z}]+', ' ', 'g')) as t from documents) x
left join (select page_id, regexp_replace(url, '\s+', ' ', 'g') as url from pages) p on p.page_id = x.doc_id""")
def clean_strings(spark: SparkSession, d: str) -> DataFrame:
    docs = clean.clean_strings(table(spark, d, "documents").select("doc_id", "text"), lowercase=("text",))
    pages = clean.clean_strings(table(spark, d, "pages").select("page_id", "url"))
    return docs.join(pages, F.col("page_id") == F.col("doc_id"), "left").select("doc_id", "text", "url")


@R.add(r"""select 'text' as "column", count(*) filter (where text is distinct from case when t in ('', 'nan', 'None', '<NA>') then null else t end) as modified from
(select text, regexp_replace(regexp_replace(text, '^[\s\x0B\x85\p{Z}]+|[\s\x0B\x85\p{Z}]+$', '', 'g'), '[\s\x0B\x85\p{Z}]+', ' ', 'g') as t from documents) x
union all select 'source', 0 from documents where doc_id = (select min(doc_id) from documents)""")
def modified_cells(spark: SparkSession, d: str) -> DataFrame:
    return clean.modified_cells(table(spark, d, "documents").select("text", "source"))


@R.add("""select policy, event_id, user_id, event_type from (
select *, 'first' as policy from (select *, row_number() over (partition by user_id, event_type order by ts, event_id) as n from events) a where n = 1
union all select *, 'last' from (select *, row_number() over (partition by user_id, event_type order by ts desc, event_id desc) as n from events) b where n = 1
union all select *, 'drop_all' from (select *, count(*) over (partition by user_id, event_type) as n from events) c where n = 1) x""")
def dedupe_policies(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events")
    order = [F.col("ts"), F.col("event_id")]
    parts = [clean.dedupe(events, ["user_id", "event_type"], order, k).select(F.lit(k).alias("policy"), "event_id", "user_id", "event_type") for k in ("first", "last", "drop_all")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@R.add("select distinct o_custkey, o_orderstatus, o_orderpriority from orders")
def dedupe_rows(spark: SparkSession, d: str) -> DataFrame:
    return clean.dedupe(table(spark, d, "orders").select("o_custkey", "o_orderstatus", "o_orderpriority"), None)


@R.add("""select 'drop_row' as policy, count(*) as n, count(c_acctbal) as filled, round(sum(c_acctbal), 2) as total from customer where c_acctbal >= 0 or c_acctbal is null
union all select 'nullify', count(*), count(case when c_acctbal >= 0 then 1 end), round(sum(case when c_acctbal >= 0 then c_acctbal end), 2) from customer
union all select 'leave', count(*), count(c_acctbal), round(sum(c_acctbal), 2) from customer""")
def bounds_policies(spark: SparkSession, d: str) -> DataFrame:
    parts = []
    for policy in ("drop_row", "nullify", "leave"):
        kept = clean.apply_bounds(table(spark, d, "customer"), {"c_acctbal": 0.0}, policy)
        parts.append(kept.agg(F.lit(policy).alias("policy"), F.count("*").alias("n"), F.count("c_acctbal").alias("filled"), F.round(F.sum("c_acctbal"), 2).alias("total")))
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@R.add("""select o_orderkey, cast(o_custkey as bigint) as key_from_text, try_cast(o_orderpriority as double) as number, case when o_orderkey % 2 = 0 then o_orderkey end as half
from orders""")
def convert_types(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "orders")
    texts = rows.select("o_orderkey", F.concat(F.col("o_custkey").cast("string"), F.when(F.col("o_orderkey") % 2 == 0, ".0").otherwise("")).alias("key_from_text"), F.col("o_orderpriority").alias("number"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey").cast("string")).otherwise("x").alias("half"))
    return clean.convert(texts, {"key_from_text": "bigint", "number": "double", "half": "bigint"})


@R.add("""select o.o_orderkey, c.c_name as customer_name, c.c_mktsegment as customer_segment from orders o left join customer c on o.o_custkey = c.c_custkey and c.c_acctbal >= 0""")
def dimension_join(spark: SparkSession, d: str) -> DataFrame:
    tables = {"orders": table(spark, d, "orders").select("o_orderkey", "o_custkey"), "customer": table(spark, d, "customer").where("c_acctbal >= 0")}
    spec = consolidate.DimensionJoin("customer", "o_custkey", "c_custkey", {"c_name": "customer_name", "c_mktsegment": "customer_segment"}, ("c_name", "c_mktsegment"), order=("c_name",))
    return consolidate.consolidate(tables, "orders", (spec,))[0].select("o_orderkey", "customer_name", "customer_segment")


@R.add("""select c_custkey, o_orderkey as latest_order, o_totalprice as latest_price from customer left join
(select *, row_number() over (partition by o_custkey order by o_orderdate desc nulls last, o_orderkey) as n from orders) o on o.o_custkey = c_custkey and n = 1""")
def snapshot_join(spark: SparkSession, d: str) -> DataFrame:
    tables = {"customer": table(spark, d, "customer").select("c_custkey"), "orders": table(spark, d, "orders")}
    spec = consolidate.SnapshotJoin("orders", "c_custkey", "o_custkey", "o_orderdate", ("o_orderkey",), {"o_orderkey": "latest_order", "o_totalprice": "latest_price"}, ("o_orderkey", "o_totalprice"))
    return consolidate.consolidate(tables, "customer", snapshots=(spec,))[0]


def _master(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    tables = {n: table(spark, d, n) for n in ("orders", "customer", "lineitem", "part", "events")}
    dims = (consolidate.DimensionJoin("customer", "o_custkey", "c_custkey", {"c_name": "customer_name"}, ("c_name", "c_mktsegment"), order=("c_name",)),)
    snaps = (consolidate.SnapshotJoin("events", "o_custkey", "user_id", "ts", ("event_id",), {"event_type": "last_event"}, ("event_type",)),)
    bridges = (consolidate.BridgeSummary("lineitem", "l_orderkey", "l_partkey", "part", "part", "p_partkey", "p_name", "o_orderkey", most=3),)
    return tables["orders"], consolidate.consolidate(tables, "orders", dims, snaps, bridges, markers=True)[0]


_BRIDGE = """pairs as (select l_orderkey as k, p_name as v, count(*) as n from lineitem join part on l_partkey = p_partkey group by 1, 2),
b as (select k, count(*) as part_count, (list(v order by n desc, v))[1] as top_part, array_to_string((list(v order by v))[1:3], '|') as part_list from pairs group by k),
s as (select user_id, event_type as last_event from (select *, row_number() over (partition by user_id order by ts desc nulls last, event_id) as n from events) x where n = 1)"""


@R.add(f"""with {_BRIDGE} select o_orderkey, c_name as customer_name, c_mktsegment, last_event, coalesce(part_count, 0) as part_count, top_part, part_list
from orders left join customer on o_custkey = c_custkey left join s on user_id = o_custkey left join b on k = o_orderkey""")
def bridge_summary(spark: SparkSession, d: str) -> DataFrame:
    before, after = _master(spark, d)
    return after.select("o_orderkey", "customer_name", "c_mktsegment", "last_event", "part_count", "top_part", F.array_join("part_list", "|").alias("part_list"))


@R.add(f"""with {_BRIDGE}, m as (select c_custkey is not null as c, s.user_id is not null as e, b.k is not null as l from orders left join customer on o_custkey = c_custkey left join s on user_id = o_custkey left join b on k = o_orderkey)
select 'customer' as "table", count(*) as total, count(*) filter (where c) as matched, count(*) filter (where not c) as unmatched, round(avg(c::int), 6) as rate from m
union all select 'events', count(*), count(*) filter (where e), count(*) filter (where not e), round(avg(e::int), 6) from m
union all select 'lineitem', count(*), count(*) filter (where l), count(*) filter (where not l), round(avg(l::int), 6) from m""")
def join_match_stats(spark: SparkSession, d: str) -> DataFrame:
    return consolidate.match_stats(_master(spark, d)[1], ["customer", "events", "lineitem"])


@R.add("select count(*) as rows_before, count(*) as rows_after, 0 as duplicate_keys, 0 as null_keys from orders")
def join_integrity(spark: SparkSession, d: str) -> DataFrame:
    before, after = _master(spark, d)
    return consolidate.integrity(before, after, "o_orderkey")


@R.add("""select 'quality' as "column", round(avg((quality is not null)::int), 6) as coverage from documents d left join labels l on d.doc_id = l.doc_id
union all select 'toxic', round(avg((toxic is not null)::int), 6) from documents d left join labels l on d.doc_id = l.doc_id""")
def column_coverage(spark: SparkSession, d: str) -> DataFrame:
    return consolidate.coverage(table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left"), ["quality", "toxic"])


@R.add("""select o_orderkey, o_custkey, o_orderpriority, 'v1' as dataset_version from orders where year(o_orderdate) = 1996
union all select o_orderkey, o_custkey, null, 'v2' from orders where year(o_orderdate) = 1997""")
def master_union(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    v1 = orders.where(F.year("o_orderdate") == 1996).select("o_orderkey", "o_custkey", "o_orderpriority")
    v2 = orders.where(F.year("o_orderdate") == 1997).select("o_orderkey", "o_custkey")
    return consolidate.union_versions({"v1": v1, "v2": v2})


_YEARS = "a as (select distinct o_custkey as k from orders where year(o_orderdate) = 1996), b as (select distinct o_custkey as k from orders where year(o_orderdate) = 1997)"


@R.add(f"""with {_YEARS}, c as (select (select count(*) from a join b using (k)) as "both", (select count(*) from a where k not in (select k from b)) as only_left, (select count(*) from b where k not in (select k from a)) as only_right)
select "both", only_left, only_right, round(100.0 * "both" / ("both" + only_left), 4) as left_in_right_pct, round(100.0 * "both" / ("both" + only_right), 4) as right_in_left_pct from c""")
def version_overlap(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    return sets.key_overlap(orders.where(F.year("o_orderdate") == 1996), orders.where(F.year("o_orderdate") == 1997), "o_custkey", "o_custkey")


@R.add("""with a as (select o_orderkey, o_custkey, o_orderdate from orders where year(o_orderdate) = 1996), b as (select o_orderkey, case when o_custkey % 10 = 0 then null else o_custkey end as o_custkey, o_totalprice from orders where year(o_orderdate) = 1997)
select 'o_orderkey' as "column", 'bigint' as left_type, 'bigint' as right_type, 0::double as left_null_pct, 0::double as right_null_pct, null as left_low, null as left_high
union all select 'o_custkey', 'bigint', 'bigint', 0::double, (select round(100 * avg((o_custkey is null)::int), 4) from b), null, null
union all select 'o_orderdate', 'string', null, 0::double, null, (select strftime(min(o_orderdate), '%Y-%m-%d') from a), (select strftime(max(o_orderdate), '%Y-%m-%d') from a)
union all select 'o_totalprice', null, 'double', null, 0::double, null, null""")
def version_diff(spark: SparkSession, d: str) -> DataFrame:
    orders = table(spark, d, "orders")
    left = orders.where(F.year("o_orderdate") == 1996).select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"))
    right = orders.where(F.year("o_orderdate") == 1997).select("o_orderkey", F.when(F.col("o_custkey") % 10 != 0, F.col("o_custkey")).alias("o_custkey"), "o_totalprice")
    return sets.version_diff(left, right, ("o_orderdate",)).drop("right_low", "right_high")


@R.add("select o_custkey, count(distinct year(o_orderdate)) as versions from orders group by 1 having count(distinct year(o_orderdate)) > 1")
def cross_version_keys(spark: SparkSession, d: str) -> DataFrame:
    return sets.repeated_across(table(spark, d, "orders").withColumn("v", F.year("o_orderdate")), ["o_custkey"], "v")


@R.add("select distinct l_partkey as key from lineitem where l_partkey not in (select p_partkey from part where p_size > 10)")
def missing_foreign_keys(spark: SparkSession, d: str) -> DataFrame:
    return sets.missing_keys(table(spark, d, "lineitem"), "l_partkey", table(spark, d, "part").where("p_size > 10"), "p_partkey")


@R.add("select 'orders' as version, count(*) as rows from orders union all select 'customer', count(*) from customer")
def version_rows(spark: SparkSession, d: str) -> DataFrame:
    return sets.row_counts({n: table(spark, d, n) for n in ("orders", "customer")})


# rows of each step: c_acctbal under 0 goes; customers of every eleventh key are unreadable, and so one key
_STEPS = """c as (select count(*) as n, count(*) filter (where c_acctbal < 0) as low, count(*) - count(c_mktsegment) as filled, count(*) - count(c_acctbal) as bal from customer),
o as (select count(*) as n, count(*) filter (where o_custkey % 11 = 0) as lost, count(*) - count(o_orderpriority) as filled from orders),
k as (select distinct case when o_custkey % 11 <> 0 then o_custkey end as key, o_orderstatus from orders),
u as (select count(*) as n, count(*) filter (where key is null) as nulls from k),
h as (select count(*) as n, count(*) filter (where key is null) as nulls from k where key is null or key in (select c_custkey from customer where not coalesce(c_acctbal < 0, false)))"""


@R.add(f"""with {_STEPS} select 'customer' as "table", 0 as v, n as rows_before, n - low as rows_after, low as removed, round(100.0 * low / n, 4) as removed_pct from c
union all select 'orders', 0, o.n, h.n, o.n - h.n, round(100.0 * (o.n - h.n) / o.n, 4) from o, h""")
def cleaning_report(spark: SparkSession, d: str) -> DataFrame:
    return rounded(_cleaned(spark, d).changes(spark).withColumn("v", F.lit(0)))


def _cleaned(spark: SparkSession, d: str) -> StepLog:
    """Customers and orders cleaned and written once; the counts of all steps come from those two runs."""
    tables = {"customer": table(spark, d, "customer"), "orders": table(spark, d, "orders").withColumn("o_custkey", F.when(F.col("o_custkey") % 11 != 0, F.col("o_custkey").cast("string")).otherwise(F.lit(" n/a  ")))}
    rules = {
        "customer": CleaningRule(("c_custkey",), fill_null={"c_mktsegment": "NONE"}, lowercase=("c_name",), lower_bounds={"c_acctbal": 0.0}, low_values="drop_row"),
        "orders": CleaningRule(("o_custkey", "o_orderstatus"), fill_null={"o_orderpriority": "NONE"}, foreign_keys=(ForeignKey("o_custkey", "customer", "c_custkey"),)),
    }
    order, log = {"customer": [F.col("c_custkey")], "orders": [F.col("o_orderkey")]}, StepLog()
    clean.clean_version(tables, rules, {"orders": {"o_custkey": "bigint"}}, order, continue_on_error=False, folder=new_path(spark, "cleaned"), log=log)
    return log


@R.add(f"""with {_STEPS},
s as (
  select 'customer' as "table", 0 as step, 'input' as name, n as rows, filled + bal as nulls, 'rows' as extra, n as value from c union all select 'customer', 1, 'strings', n, filled + bal, 'rows', n from c
  union all select 'customer', 2, 'nulls dropped', n, filled + bal, 'filled', filled from c union all select 'customer', 3, 'nulls filled', n, bal, 'lost', 0 from c
  union all select 'customer', 4, 'types', n, bal, 'low', low from c union all select 'customer', 5, 'bounds', n - low, bal, 'rows', n - low from c
  union all select 'customer', 6, 'duplicates', n - low, bal, 'rows', n - low from c union all select 'customer', 7, 'orphans', n - low, bal, 'rows', n - low from c
  union all select 'orders', 0, 'input', n, filled, 'rows', n from o union all select 'orders', 1, 'strings', n, filled, 'rows', n from o
  union all select 'orders', 2, 'nulls dropped', n, filled, 'filled', filled from o union all select 'orders', 3, 'nulls filled', n, 0, 'lost', lost from o
  union all select 'orders', 4, 'types', n, lost, 'low', 0 from o union all select 'orders', 5, 'bounds', n, lost, 'rows', n from o
  union all select 'orders', 6, 'duplicates', n, nulls, 'rows', n from u union all select 'orders', 7, 'orphans', n, nulls, 'rows', n from h)
select "table", step, name, metric, cast(value as bigint) as value from (
  select "table", step, name, 'rows' as metric, rows as value from s union all select "table", step, name, 'nulls', nulls from s
  union all select s."table", step, name, 'columns', (select count(*) from information_schema.columns i where i.table_name = s."table") from s
  union all select "table", step, name, extra, value from s where extra <> 'rows') x""")
def cleaning_steps(spark: SparkSession, d: str) -> DataFrame:
    """Rows, columns, nulls and further counts of every step of cleaning two tables, from the runs that write them."""
    return _cleaned(spark, d).report(spark)


@R.add("""with m as (select c_custkey is not null as c, c_mktsegment, l.k is not null as l from orders left join customer on o_custkey = c_custkey and c_acctbal >= 0 left join (select distinct l_orderkey as k from lineitem where l_quantity > 40) l on l.k = o_orderkey)
select 'orders' as "table", step, name, metric, cast(value as bigint) as value from (
  select 0 as step, 'fact' as name, 'rows' as metric, count(*) as value from m union all select 1, 'customer', 'rows', count(*) from m union all select 2, 'lineitem', 'rows', count(*) from m
  union all select 0, 'fact', 'columns', 2 union all select 1, 'customer', 'columns', 3 union all select 2, 'lineitem', 'columns', 4
  union all select 0, 'fact', 'nulls', 0 union all select 1, 'customer', 'nulls', count(*) - count(c_mktsegment) from m union all select 2, 'lineitem', 'nulls', count(*) - count(c_mktsegment) from m
  union all select 1, 'customer', 'matched', count(*) filter (where c) from m union all select 2, 'lineitem', 'matched', count(*) filter (where l) from m) x""")
def build_steps(spark: SparkSession, d: str) -> DataFrame:
    """Rows, columns, nulls and matches after every join of a build, from the run that writes the joined table."""
    tables = {"orders": table(spark, d, "orders").select("o_orderkey", "o_custkey"), "customer": table(spark, d, "customer").where("c_acctbal >= 0"), "lineitem": table(spark, d, "lineitem").where("l_quantity > 40")}
    dims = (consolidate.DimensionJoin("customer", "o_custkey", "c_custkey", columns=("c_mktsegment",), order=("c_mktsegment",)),)
    bridges = (consolidate.BridgeSummary("lineitem", "l_orderkey", "l_partkey", "part", fact_key="o_orderkey", with_list=False, with_top=False),)
    log = StepLog()
    built, _ = consolidate.consolidate(tables, "orders", dims, (), bridges, log=log)
    log.write(built, new_path(spark, "built"))
    return log.report(spark)


_HOT = "h as (select l_orderkey, l_linenumber, case when l_orderkey % 3 = 0 then 7 when l_orderkey % 7 = 1 then null else l_partkey end as k from lineitem)"


@R.add(f"""with {_HOT} select case when k = 7 then 'hot' when k is null then 'none' else 'other' end as kind, count(*) as rows, count(p_partkey) as matched, round(coalesce(sum(p_retailprice), 0), 2) as price
from h left join part on k = p_partkey and p_size > 10 group by 1""")
def hot_key_join(spark: SparkSession, d: str) -> DataFrame:
    """A join in which one key has a third of the rows: measured, and dealt with copies of its one row of the other side."""
    order = F.col("l_orderkey")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(order % 3 == 0, F.lit(7).cast("long")).when(order % 7 != 1, F.col("l_partkey")).alias("k"))
    joined, _ = consolidate.safe_left_join(lines, table(spark, d, "part").where("p_size > 10").select("p_partkey", "p_retailprice"), "k", "p_partkey", marker="hit", hot_share=skew.HOT_SHARE)
    kind = F.when(F.col("k") == 7, "hot").when(F.col("k").isNull(), "none").otherwise("other")
    return joined.groupBy(kind.alias("kind")).agg(F.count("*").alias("rows"), F.count("hit").alias("matched"), F.round(F.coalesce(F.sum("p_retailprice"), F.lit(0.0)), 2).alias("price"))


@R.add(f"""with {_HOT} select h.k as key, count(*) as rows from h left join part on k = p_partkey and p_size > 10 where h.k is null or p_partkey is not null group by 1""")
def hot_key_orphans(spark: SparkSession, d: str) -> DataFrame:
    order = F.col("l_orderkey")
    lines = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(order % 3 == 0, F.lit(7).cast("long")).when(order % 7 != 1, F.col("l_partkey")).alias("key"))
    kept = clean.drop_orphans(lines, (ForeignKey("key", "part", "p_partkey"),), {"part": table(spark, d, "part").where("p_size > 10")}, hot_share=skew.HOT_SHARE)
    return kept.groupBy("key").agg(F.count("*").alias("rows"))


_SKETCHED = """y as (select year(o_orderdate) as y, o_custkey as c, o_custkey || '|' || o_orderpriority as p from orders where year(o_orderdate) in (1995, 1996, 1997)),
k as (select y, 'customer' as key, cast(c as varchar) as v from y union all select y, 'customer, priority', p from y), u as (select distinct y, key, v from k), r as (select key, v, count(*) as n, count(*) filter (where y = 1996) as a, count(*) filter (where y = 1997) as b from u group by 1, 2)"""


@R.add(f"""with {_SKETCHED} select *, true as within from (
select key, 'distinct' as measure, count(*) as exact from r group by 1 union all select key, 'repeated', count(*) filter (where n > 1) from r group by 1 union all select key, 'both', count(*) filter (where a > 0 and b > 0) from r group by 1
union all select key, 'only_left', count(*) filter (where a > 0 and b = 0) from r group by 1 union all select key, 'only_right', count(*) filter (where b > 0 and a = 0) from r group by 1) x""")
def sketched_versions(spark: SparkSession, d: str) -> DataFrame:
    """Estimates from stored sketches of three versions beside the exact counts: do they lie within the stated error?"""
    orders = table(spark, d, "orders").withColumn("version", F.year("o_orderdate").cast("string"))
    keys, years = {"customer": ["o_custkey"], "customer, priority": ["o_custkey", "o_orderpriority"]}, ["1995", "1996", "1997"]
    parts = [sketches.key_sketches(orders.where(F.col("version") == y), y, keys) for y in years]
    stored = materialize(parts[0].unionByName(parts[1]).unionByName(parts[2]), "key-sketches")
    overlap = sketches.overlap_estimates(stored, "1996", "1997")
    tall = [sketches.union_estimates(stored).select("key", F.lit("distinct").alias("measure"), F.col("distinct").alias("estimate")), sketches.repeated_estimates(stored, years).select("key", F.lit("repeated").alias("measure"), F.col("repeated").alias("estimate"))]
    tall += [overlap.select("key", F.lit(m).alias("measure"), F.col(m).alias("estimate")) for m in ("both", "only_left", "only_right")]
    found = tall[0]
    for t in tall[1:]:
        found = found.unionByName(t)
    exact = []
    for name, columns in keys.items():
        own = orders.where(F.col("version").isin(*years)).groupBy(*columns).agg(F.count_distinct("version").alias("n"), F.max(F.col("version") == "1996").alias("a"), F.max(F.col("version") == "1997").alias("b"))
        counts = {"distinct": F.count("*"), "repeated": F.count_if(F.col("n") > 1), "both": F.count_if(F.col("a") & F.col("b")), "only_left": F.count_if(F.col("a") & ~F.col("b")), "only_right": F.count_if(F.col("b") & ~F.col("a"))}
        exact.append(own.agg(F.array(*[F.struct(F.lit(name).alias("key"), F.lit(m).alias("measure"), c.alias("exact")) for m, c in counts.items()]).alias("x")).select(F.inline("x")))
    both = exact[0].unionByName(exact[1]).join(found, ["key", "measure"])
    whole = F.max(F.when(F.col("measure") == "distinct", F.col("exact"))).over(Window.partitionBy("key"))
    return both.select("key", "measure", "exact", (F.abs(F.col("estimate") - F.col("exact")) <= sketches.stated_error() * whole).alias("within"))
