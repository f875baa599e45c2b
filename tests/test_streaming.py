"""A stream through the stateless operators gives what a batch gives."""

from __future__ import annotations

from millrace.core.schemas import LISTING_CLEANING, LISTING_SCHEMAS
from millrace.streaming import stateless


def test_stream_equals_batch(spark, tmp_path):
    rows = [("1", " A  job ", "7", "40000", "60000", "YEARLY", "USD"), ("2.0", "nan", None, None, None, None, None), ("3", "x", "8.0", "9", "1", "ONCE", "USD")]
    df = spark.createDataFrame(rows, "ID string, job_title string, company_id string, min_salary string, max_salary string, pay_period string, currency string")
    df.write.parquet(str(tmp_path / "in"))
    schema, rule = LISTING_SCHEMAS["postings"], LISTING_CLEANING["postings"]
    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = stateless.write_parquet(stateless.prepare_listings(stream, schema, rule), str(tmp_path / "out"), str(tmp_path / "state"))
    query.awaitTermination(120)
    got = {tuple(r) for r in spark.read.parquet(str(tmp_path / "out")).select("job_id", "title", "company_id", "target_annual_salary", "reject_reason").collect()}
    want = {tuple(r) for r in stateless.prepare_listings(df, schema, rule).select("job_id", "title", "company_id", "target_annual_salary", "reject_reason").collect()}
    assert got == want == {(1, "A job", 7, 50000.0, None), (3, "x", 8, None, "no_pay")}
