"""Versions as one data source, and records that do not fit their header."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from millrace.sources import readers, versions


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


def test_versions_are_pruned_before_their_files_are_opened(spark, tmp_path):
    write(tmp_path / "Version_2" / "t.csv", 'id,name\n1,"a ""q"", b\nc"\n2,nan\n')
    write(tmp_path / "Version_10" / "t.csv" / "part-0.csv", "name,id,more\nz,3,x\n")
    write(tmp_path / "Version_10" / "t.csv" / "part-1.csv", "id,name,more\n4,NULL,\n")
    write(tmp_path / "Version_10" / "t.csv" / "_SUCCESS", "")
    write(tmp_path / "Version_11" / "other.csv", "id\n9\n")
    write(tmp_path / "notes" / "t.csv", "id\n9\n")
    df = versions.read_versions(spark, str(tmp_path), "t")
    assert df.columns == ["id", "name", "more", "dataset_version"]
    want = {("1", 'a "q", b\nc', None, "Version_2"), ("2", None, None, "Version_2"), ("3", "z", "x", "Version_10"), ("4", None, None, "Version_10")}
    assert {tuple(r) for r in df.collect()} == want
    newer = versions.read_versions(spark, str(tmp_path), "t", only=("Version_10",))
    assert (df.rdd.getNumPartitions(), newer.rdd.getNumPartitions()) == (3, 2)
    assert {r["id"] for r in df.where("dataset_version = 'Version_10' and id > 3").collect()} == {"4"}
    assert (df.where("dataset_version = 'Version_2'").count(), df.count()) == (2, 4)
    # a file that cannot be read does not matter to a query of the other version
    (tmp_path / "Version_2" / "t.csv").write_text("id,name\n1,2,3\n")
    assert newer.count() == versions.read_versions(spark, str(tmp_path), "t", only=("Version_10",)).count() == 2
    with pytest.raises(Exception, match="Expected 2 columns"):
        df.count()
    with pytest.raises(Exception, match="Version_4 not in"):
        versions.read_versions(spark, str(tmp_path), "t", only=("Version_4",))


def test_versions_of_parquet_files(spark, tmp_path):
    spark.createDataFrame([(1, [1.5], None), (2, None, "x")], "k long, v array<double>, s string").write.parquet(str(tmp_path / "Version_1" / "t.parquet"))
    spark.createDataFrame([(3, "2024-01-02")], "k long, d string").select("k", F.to_date("d").alias("d")).write.parquet(str(tmp_path / "Version_2" / "t.parquet"))
    df = versions.read_versions(spark, f"file://{tmp_path}", "t")
    assert {r["k"]: (r["v"], r["s"], str(r["d"]), r["dataset_version"]) for r in df.collect()} == {1: ([1.5], None, "None", "Version_1"), 2: (None, "x", "None", "Version_1"), 3: (None, None, "2024-01-02", "Version_2")}
    spark.createDataFrame([("3",)], "k string").write.parquet(str(tmp_path / "Version_3" / "t.parquet"))
    with pytest.raises(Exception, match="k is int64 and, in Version_3, string"):
        versions.read_versions(spark, str(tmp_path), "t")
    with pytest.raises(Exception, match="no version in"):
        versions.read_versions(spark, str(tmp_path), "absent")
    with pytest.raises(Exception, match="no Nothing_"):
        versions.read_versions(spark, str(tmp_path), "t", prefix="Nothing_")


def test_bad_records_are_kept_beside_the_good_ones(spark, tmp_path):
    write(tmp_path / "a.csv", 'id,name,v\n1,"x, y",2\n2,short\n3,a,b,c\n4,NA,\n')
    write(tmp_path / "empty.csv", "")
    write(tmp_path / "header.csv", "id,name,v\n")
    good, bad = readers.read_csv_checked(spark, str(tmp_path / "a.csv"))
    assert {tuple(r) for r in good.collect()} == {("1", "x, y", "2"), ("4", None, None)}
    assert {r["record"] for r in bad.collect()} == {"2,short", "3,a,b,c"}
    write(tmp_path / "b.csv", "id,name,v\n7,y,1\n8\n")
    good, bad = readers.read_csv_checked(spark, str(tmp_path))
    assert {r["id"] for r in good.collect()} == {"1", "4", "7"}
    assert {r["file"].rsplit("/", 1)[1]: r["records"] for r in readers.bad_record_counts(bad).collect()} == {"a.csv": 2, "b.csv": 1}
    for name in ("empty.csv", "header.csv"):
        with pytest.raises(Exception):
            readers.read_csv_checked(spark, str(tmp_path / name), ["id", "name", "v"] if name == "empty.csv" else None)
