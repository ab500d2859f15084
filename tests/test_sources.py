from __future__ import annotations

import os
from pathlib import Path

import pytest

from starmart.sources import readers, schemas, writers
from tests.plans import plan_of


def write(path: Path, text: str, encoding: str = "utf-8") -> str:
    path.write_bytes(text.encode(encoding))
    return str(path)


def test_byte_order_mark_and_missing_final_newline(spark, tmp_path):
    path = write(
        tmp_path / "c.csv",
        "product_category_name,product_category_name_english\nbeleza,beauty\ncama,bed",
        "utf-8-sig",
    )
    df = readers.read_csv(spark, path, schemas.RAW_COLUMNS["category_translation"])
    assert df.columns == ["product_category_name", "product_category_name_english"]
    assert {tuple(r) for r in df.collect()} == {("beleza", "beauty"), ("cama", "bed")}


def test_quotes_and_line_breaks(spark, tmp_path):
    text = (
        "review_id,order_id,review_score,review_comment_title,review_comment_message,"
        "review_creation_date,review_answer_timestamp\n"
        'r1,o1,5,,"line one\nsays ""hi"", bye",2018-01-01 00:00:00,2018-01-02 00:00:00\n'
        "r2,o2,x,,,2018-01-01 00:00:00,\n"
    )
    path = write(tmp_path / "reviews.csv", text)
    df = readers.read_csv(spark, path, schemas.RAW_COLUMNS["reviews"], multi_line=True)
    rows = {r["review_id"]: r for r in df.collect()}
    assert rows["r1"]["review_comment_message"] == 'line one\nsays "hi", bye'
    assert rows["r1"]["review_score"] == 5 and rows["r2"]["review_score"] is None


def test_types_go_by_name_and_other_columns_are_text(spark, tmp_path):
    path = write(tmp_path / "g.csv", "extra,geolocation_lat,geolocation_zip_code_prefix\n7,-23.5,01001\n")
    df = readers.read_csv(spark, path, schemas.RAW_COLUMNS["geolocation"])
    assert tuple(df.first()) == ("7", -23.5, "01001")
    inferred = readers.read_csv(spark, path, infer=True)
    assert tuple(inferred.first()) == (7, -23.5, 1001)


def test_files_with_another_header_are_refused(spark, tmp_path):
    write(tmp_path / "a.csv", "k,v\n1,2\n")
    write(tmp_path / "b.csv", "v,k\n1,2\n")
    with pytest.raises(Exception, match="does not conform"):
        readers.read_csv(spark, str(tmp_path), {"k": "int", "v": "int"}).collect()


def test_csv_is_pruned_to_the_columns_in_use(spark, tmp_path):
    path = write(tmp_path / "t.csv", "a,b,c\n1,2,3\n")
    df = readers.read_csv(spark, path, {"a": "int"}).select("a")
    assert "ReadSchema: struct<a:int>" in plan_of(df) and df.first()["a"] == 1


def test_parquet_reads_used_columns_and_pushes_filters(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.overwrite_parquet(spark.range(10).selectExpr("id", "id * 2 as x", "'t' as note"), path)
    plan = plan_of(readers.read_parquet(spark, path).filter("x > 4").select("id"))
    assert "GreaterThan(x,4)" in plan and "note" not in plan


def test_overwrite_replaces_and_append_adds(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        writers.overwrite_parquet(spark.range(5), path)
    writers.append_parquet(spark.range(5), path)
    assert readers.read_parquet(spark, path).count() == 10


def test_partitioned_append_makes_few_files(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.range(1000).selectExpr("id", "2018 as year", "cast(id % 3 as int) as month")
    for _ in range(2):
        writers.append_partitioned(rows.repartition(8), path, "year", "month")
    df = readers.read_parquet(spark, path)
    assert df.count() == 2000 and len(df.inputFiles()) == 6
    assert "PartitionFilters: [" in plan_of(df.filter("month = 1"))


def test_hot_directory_is_cut_into_several_tasks(spark, tmp_path):
    from tests.plans import settings

    path = str(tmp_path / "t")
    rows = spark.range(200_000).selectExpr(
        "id", "sha2(cast(id as string), 256) as note", "if(id % 10 < 7, 1, id % 10) as month"
    )
    with settings(spark, spark__sql__adaptive__advisoryPartitionSizeInBytes="1MB"):
        writers.append_partitioned(rows, path, "month")
    months = [Path(f).parent.name for f in readers.read_parquet(spark, path).inputFiles()]
    assert months.count("month=1") >= 4


def test_create_if_missing_leaves_an_existing_table_alone(spark, tmp_path):
    path = str(tmp_path / "t")
    writers.create_if_missing(spark.range(3), path)
    assert readers.read_parquet(spark, path).count() == 0
    writers.append_parquet(spark.range(3), path)
    writers.create_if_missing(spark.range(9), path)
    assert readers.read_parquet(spark, path).count() == 3


def test_report_is_one_ordered_file_with_header(spark, tmp_path):
    path = tmp_path / "report"
    rows = [(2018, 2, 3.5), (2017, 12, 1.0), (2018, 1, 2.25)]
    df = spark.createDataFrame(rows, "year int, month int, revenue double")
    writers.write_csv_report(df.repartition(3).orderBy("year", "month"), str(path))
    files = list(path.glob("*.csv"))
    assert len(files) == 1
    assert files[0].read_text().split() == [
        "year,month,revenue",
        "2017,12,1.0",
        "2018,1,2.25",
        "2018,2,3.5",
    ]


def test_counts_come_with_the_write(spark, tmp_path):
    rows, taken = writers.observed(spark.range(123), "count_test")
    writers.overwrite_parquet(rows, str(tmp_path / "t"))
    assert taken.get["rows"] == 123


def test_jdbc_write_asks_for_the_driver_of_the_target(spark):
    """As far as it goes without a database: Spark looks for the driver class and stops."""
    target = writers.JdbcTarget("jdbc:none://nowhere", driver="no.such.Driver")
    with pytest.raises(Exception, match="no.such.Driver"):
        writers.overwrite_jdbc(spark.range(1), target, "t")


def test_jdbc_options_take_credentials_from_the_environment(monkeypatch):
    """Options only: the write itself needs a database, and tests start none."""
    target = writers.JdbcTarget("jdbc:postgresql://host/db")
    monkeypatch.setenv("STARMART_JDBC_USER", "me")
    monkeypatch.delenv("STARMART_JDBC_PASSWORD", raising=False)
    options = target.options("fact_sales")
    assert options["dbtable"] == "fact_sales" and options["truncate"] == "true"
    assert options["user"] == "me" and "password" not in options
    assert "STARMART_JDBC_PASSWORD" not in os.environ


def test_a_cluster_needs_a_named_folder(spark, monkeypatch):
    from types import SimpleNamespace

    from starmart import session

    def session_of(master, **conf):
        held = SimpleNamespace(master=master, getCheckpointDir=lambda: None, setCheckpointDir=lambda path: None)
        held.getConf = lambda: SimpleNamespace(contains=lambda key: key in conf)
        values = {"spark.sql.warehouse.dir": "/made/up"}
        return SimpleNamespace(sparkContext=held, conf=SimpleNamespace(get=lambda key, *other: values.get(key, *other)))

    assert session.shared_folder(session_of("local[2]")) == "/made/up/_shared"
    assert session.shared_folder(session_of("yarn", **{"spark.sql.warehouse.dir": "x"})) == "/made/up/_shared"
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.shared_folder(session_of("spark://host:7077"))
