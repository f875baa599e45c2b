"""Writing and reading back, null policies, validation summaries and collision-safe joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.core.schemas import LISTING_VALIDATION, CleaningRule
from millrace.core.scratch import materialize, new_path
from millrace.operators import clean, consolidate, validate
from millrace.plans.registry import Registry, rounded, table
from millrace.sources import readers, versions, writers

R = Registry()


@R.add("""select c_custkey, c_name, c_mktsegment, array_to_string(string_split(c_name, '#'), '|') as parts, round(c_acctbal, 2) as c_acctbal from customer""")
def csv_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A table written as CSV, lists joined, and read back as text with its missing values."""
    path = new_path(spark, "csv")
    rows = table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", F.split("c_name", "#").alias("parts"), "c_acctbal")
    writers.write_csv(rows, path)
    back = readers.read_csv(spark, path, multiline=False)
    return back.select(F.col("c_custkey").cast("long").alias("c_custkey"), "c_name", "c_mktsegment", "parts", F.round(F.col("c_acctbal").cast("double"), 2).alias("c_acctbal"))


@R.add("""select place, p.* from (select p_partkey, p_name, p_size from part) p, (values ('latest'), ('archive')) v(place)""")
def latest_and_archive(spark: SparkSession, d: str) -> DataFrame:
    """Both copies of a dataset, read back from where they were written."""
    rows = table(spark, d, "part").select("p_partkey", "p_name", "p_size")
    paths = writers.write_dataset(rows, new_path(spark, "dataset"), report=rows.agg(F.count("*").alias("rows")), run_id="run")
    parts = [spark.read.parquet(f"{paths[place]}/data").withColumn("place", F.lit(place)) for place in ("latest", "archive")]
    return parts[0].unionByName(parts[1])


@R.add("""select case when o_orderkey % 10 < 2 then 'test' when o_orderkey % 10 = 2 then 'validation' else 'train' end as split, count(*) as rows, sum(o_orderkey) as keys from orders group by 1""")
def splits_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """Splits in folders of their own, read back one by one."""
    path, k = new_path(spark, "splits"), F.col("o_orderkey") % 10
    writers.write_splits(table(spark, d, "orders").withColumn("split", F.when(k < 2, "test").when(k == 2, "validation").otherwise("train")), path)
    parts = [df.agg(F.lit(name).alias("split"), F.count("*").alias("rows"), F.sum("o_orderkey").alias("keys")) for name, df in sorted(writers.read_splits(spark, path).items())]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@R.add("""with x as (select d.doc_id, quality, toxic from documents d left join labels l on d.doc_id = l.doc_id)
select 'drop' as policy, count(*) as rows, count(toxic) as toxic_known, cast(coalesce(sum(quality), 0) as bigint) as quality from x where quality is not null
union all select 'fill', count(*), count(coalesce(toxic, 0)), cast(sum(coalesce(quality, -1)) as bigint) from x""")
def null_policies(spark: SparkSession, d: str) -> DataFrame:
    rows = table(spark, d, "documents").select("doc_id").join(table(spark, d, "labels"), "doc_id", "left")
    parts = {"drop": clean.handle_nulls(rows, drop=("quality",)), "fill": clean.handle_nulls(rows, fill={"quality": -1, "toxic": 0})}
    each = [df.agg(F.lit(p).alias("policy"), F.count("*").alias("rows"), F.count("toxic").alias("toxic_known"), F.coalesce(F.sum("quality"), F.lit(0)).cast("long").alias("quality")) for p, df in parts.items()]
    return each[0].unionByName(each[1])


# Orders, customers and line items as listings, companies and skills: with repeated keys, nulls, values out of their domain and orphans.
_LISTINGS = """p as (select case when o_orderkey % 50 = 0 then 7 else o_orderkey end as job_id, case when o_custkey % 13 <> 0 then o_custkey end as company_id, case when o_orderstatus <> 'P' then o_orderpriority end as title, o_totalprice - 50000 as min_salary,
case o_orderstatus when 'F' then 'YEARLY' when 'O' then 'MONTHLY' else 'DAILY' end as pay_period, o_orderkey % 3 as remote_allowed, case when o_orderkey % 4 = 0 then 'full time' else 'FULL_TIME' end as work_type,
case when o_orderkey % 5 = 0 then 12 when o_orderkey % 5 <> 1 then epoch_ms(o_orderdate) end as listed_time, o_orderkey % 5 = 1 as no_time from orders),
c as (select c_custkey as company_id, c_name from customer where c_acctbal >= 0), s as (select l_orderkey as job_id, l_returnflag as skill from lineitem)"""
_VIOLATIONS = f"""with {_LISTINGS}, report as (
select 'postings' as "table", 'structure' as "check", x as "column", 1 as violations from (values ('original_listed_time'), ('expiry'), ('closed_time'), ('formatted_experience_level')) v(x)
union all select 'postings', 'null', 'job_id', count(*) - count(job_id) from p union all select 'postings', 'null', 'company_id', count(*) - count(company_id) from p union all select 'postings', 'null', 'title', count(*) - count(title) from p
union all select 'postings', 'value', 'min_salary', count(*) filter (where min_salary < 0) from p union all select 'postings', 'value', 'max_salary', 0
union all select 'postings', 'value', 'listed_time', count(*) filter (where listed_time < 946684800000) from p union all select 'postings', 'value', 'remote_allowed', count(*) filter (where remote_allowed = 2) from p
union all select 'postings', 'value', 'work_type', count(*) filter (where work_type = 'full time') from p union all select 'postings', 'value', 'pay_period', count(*) filter (where pay_period = 'DAILY') from p
union all select 'postings', 'type', 'min_salary', 0 union all select 'postings', 'type', 'max_salary', 0 union all select 'postings', 'type', 'listed_time', count(*) filter (where no_time) from p
union all select 'postings', 'duplicate', 'job_id', cast(coalesce(sum(n), 0) as bigint) from (select count(*) as n from p group by job_id having count(*) > 1) d
union all select 'postings', 'orphan', 'company_id', count(*) from p where company_id is not null and company_id not in (select company_id from c)
union all select 'companies', 'null', 'company_id', 0 union all select 'companies', 'null', 'name', count(*) - count(c_name) from c union all select 'companies', 'duplicate', 'company_id', 0
union all select 'job_skills', 'null', 'job_id', 0 union all select 'job_skills', 'null', 'skill_abr', count(*) - count(skill) from s
union all select 'job_skills', 'orphan', 'job_id', count(*) from s where job_id not in (select job_id from p) union all select 'job_skills', 'orphan', 'skill_abr', count(*) from s where skill not in ('A', 'N')
union all select 'skills', 'null', 'skill_abr', 0 union all select 'skills', 'duplicate', 'skill_abr', 0)"""


def _version(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    key = F.col("o_orderkey")
    postings = table(spark, d, "orders").select(
        F.when(key % 50 == 0, F.lit(7)).otherwise(key).alias("job_id"), F.when(F.col("o_custkey") % 13 != 0, F.col("o_custkey")).alias("company_id"), F.when(F.col("o_orderstatus") != "P", F.col("o_orderpriority")).alias("title"),
        (F.col("o_totalprice") - 50000).alias("min_salary"), F.col("o_totalprice").alias("max_salary"), F.when(F.col("o_orderstatus") == "F", "YEARLY").when(F.col("o_orderstatus") == "O", "MONTHLY").otherwise("DAILY").alias("pay_period"),
        (key % 3).alias("remote_allowed"), F.when(key % 4 == 0, "full time").otherwise("FULL_TIME").alias("work_type"),
        F.when(key % 5 == 0, "12").when(key % 5 == 1, "soon").otherwise(F.unix_millis(F.col("o_orderdate").cast("timestamp")).cast("string")).alias("listed_time"),
    )
    return {
        "postings": postings, "companies": table(spark, d, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("company_id"), F.col("c_name").alias("name")),
        "job_skills": table(spark, d, "lineitem").select(F.col("l_orderkey").alias("job_id"), F.col("l_returnflag").alias("skill_abr")),
        "skills": spark.createDataFrame([("A",), ("N",)], "skill_abr string"), "extra": table(spark, d, "region"),
    }


@R.add(_VIOLATIONS + ' select "table", "check", "column", cast(violations as bigint) as violations from report')
def validate_version(spark: SparkSession, d: str) -> DataFrame:
    """All tables of a version against the default rules: structure, nulls, values, types, repeated keys, orphans."""
    return validate.validate_version(_version(spark, d), LISTING_VALIDATION)


@R.add(_VIOLATIONS + """, t as (select "table", sum(violations) as v from report group by 1)
select cast(count(*) filter (where v = 0) as bigint) as passed, cast(count(*) filter (where v > 0) as bigint) as failed, cast(1 as bigint) as skipped, cast(sum(v) as bigint) as violations from t""")
def validation_summary(spark: SparkSession, d: str) -> DataFrame:
    """Tables of the version that pass, fail or have no rule, and all violations."""
    tables = _version(spark, d)
    return validate.validation_summary(validate.validate_version(tables, LISTING_VALIDATION), list(tables))


@R.add(_VIOLATIONS + """, g as (select "check", sum(violations) as v from report group by 1)
select policy, (select count(*) > 0 from g where v > 0 and list_contains(string_split(policy, ','), g."check")) as raised from (values ('orphan'), ('duplicate,null'), ('structure,type'), ('other')) p(policy)""")
def validation_gate(spark: SparkSession, d: str) -> DataFrame:
    """Which policies would stop the run: each raises one error that names all its violated checks."""
    report = materialize(validate.validate_version(_version(spark, d), LISTING_VALIDATION), "validation")
    rows = []
    for policy in ("orphan", "duplicate,null", "structure,type", "other"):
        try:
            validate.enforce(report, tuple(policy.split(",")))
            rows.append((policy, False))
        except ValueError:
            rows.append((policy, True))
    return spark.createDataFrame(rows, "policy string, raised boolean")


@R.add("""select c_custkey, c_name, c_nationkey, n_name, n_name is not null as matched from customer left join nation on c_nationkey = n_nationkey""")
def safe_join(spark: SparkSession, d: str) -> DataFrame:
    """Columns that the left side has already are left out, whatever the case of their names."""
    nation = table(spark, d, "nation").select("n_nationkey", "n_name", F.col("n_name").alias("C_NAME"))
    left = table(spark, d, "customer").select("c_custkey", "c_name", "c_nationkey")
    joined, skipped = consolidate.safe_left_join(left, nation, "c_nationkey", "n_nationkey", marker="matched")
    assert skipped == ["C_NAME"]
    return rounded(joined.withColumn("matched", F.coalesce("matched", F.lit(False))))


@R.add("""with c as (select c_custkey, c_nationkey, c_mktsegment, c_acctbal, c_custkey % 3 + 8 as v from customer)
select 'Version_' || v as dataset_version, count(*) as rows, count(distinct c_nationkey) as nations, count(case when v = 10 then null else c_mktsegment end) as segments, round(sum(c_acctbal), 2) as balance from c where v in (9, 10) group by v""")
def version_scan(spark: SparkSession, d: str) -> DataFrame:
    """Three versions written as CSV, the last without a column; one read of the two newer ones, whose files alone are opened."""
    root, key = new_path(spark, "versions"), F.col("c_custkey") % 3 + 8
    customers = table(spark, d, "customer").select("c_custkey", "c_nationkey", "c_mktsegment", "c_acctbal")
    for v in (8, 9, 10):
        own = customers.where(key == v)
        writers.write_csv(own if v < 10 else own.drop("c_mktsegment"), f"{root}/Version_{v}/customer.csv")
    rows = versions.read_versions(spark, root, "customer", only=("Version_9", "Version_10"))
    return rows.groupBy("dataset_version").agg(F.count("*").alias("rows"), F.count_distinct("c_nationkey").alias("nations"), F.count("c_mktsegment").alias("segments"), F.round(F.sum(F.col("c_acctbal").cast("double")), 2).alias("balance"))


@R.add("""with c as (select c_custkey, c_acctbal, c_custkey % 11 = 3 or c_custkey % 13 = 5 as torn from customer)
select case when torn then 'bad' else 'good' end as kind, count(*) as rows, cast(sum(c_custkey) as bigint) as keys from c group by torn
union all select 'bad, by file', count(*) filter (where torn), null from c""")
def csv_bad_records(spark: SparkSession, d: str) -> DataFrame:
    """Customers as CSV lines, some with a field too few or too many, and an empty file: good rows, and bad ones by file."""
    path, key = new_path(spark, "torn"), F.col("c_custkey")
    fields = [key.cast("string"), F.col("c_name"), F.col("c_acctbal").cast("string")]
    line = F.when(key % 11 == 3, F.concat_ws(",", *fields[:2])).when(key % 13 == 5, F.concat_ws(",", *fields, F.lit("more"))).otherwise(F.concat_ws(",", *fields))
    lines = table(spark, d, "customer").select(line.alias("value"))
    lines.write.text(path)
    lines.limit(0).coalesce(1).write.mode("append").text(path)
    good, bad = readers.read_csv_checked(spark, path, ["key", "name", "balance"])
    parts = [df.agg(F.lit(kind).alias("kind"), F.count("*").alias("rows"), F.sum(k.cast("long")).alias("keys")) for kind, df, k in (("good", good, F.col("key")), ("bad", bad, F.regexp_extract("record", r"^\d+", 0)))]
    by_file = readers.bad_record_counts(bad).agg(F.lit("bad, by file").alias("kind"), F.sum("records").alias("rows"), F.lit(None).cast("long").alias("keys"))
    return parts[0].unionByName(parts[1]).unionByName(by_file)


@R.add("""select 'json' as form, o_orderstatus as name, cast(count(*) as bigint) as n from orders group by 2 union all select 'csv', strftime(ts, '%Y-%m-%d'), count(*) from events group by 2""")
def reports_round_trip(spark: SparkSession, d: str) -> DataFrame:
    """A report as JSON lines and a daily series as CSV, read back."""
    report = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("name")).agg(F.count("*").alias("n"))
    series = table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM-dd").alias("name")).agg(F.count("*").alias("n"))
    paths = new_path(spark, "report"), new_path(spark, "series")
    writers.write_report(report, paths[0])
    writers.write_csv(series, paths[1])
    back = spark.read.schema("name string, n long").json(paths[0]).select(F.lit("json").alias("form"), "name", "n")
    return back.unionByName(readers.read_csv(spark, paths[1], multiline=False).select(F.lit("csv").alias("form"), "name", F.col("n").cast("long").alias("n")))


@R.add("""select 'customer' as "table", true as done, cast(count(*) as bigint) as rows from customer where c_acctbal >= 0 or c_acctbal is null
union all select 'orders', false, count(*) from orders union all select 'part', true, count(*) from part""")
def cleaning_failures(spark: SparkSession, d: str) -> DataFrame:
    """A table whose rule cannot be kept is left as it came; the others are cleaned."""
    tables = {n: table(spark, d, n) for n in ("customer", "orders", "part")}
    rules = {
        "customer": CleaningRule(("c_custkey",), lower_bounds={"c_acctbal": 0.0}, low_values="drop_row"), "orders": CleaningRule(("o_orderkey",), lower_bounds={"o_totalprice": 0.0}, low_values="no such policy"),
        "part": CleaningRule(("p_partkey",)),
    }
    order = {"customer": [F.col("c_custkey")], "orders": [F.col("o_orderkey")], "part": [F.col("p_partkey")]}
    done, failed = clean.clean_version(tables, rules, {}, order, folder=new_path(spark, "cleaned"))
    parts = [done[n].agg(F.lit(n).alias("table"), F.lit(n not in failed).alias("done"), F.count("*").alias("rows")) for n in tables]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
