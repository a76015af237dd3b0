import datetime as dt
import json
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from supplyscope import sources as S


def test_csv_sink_writes_blanks_and_source_reads_them_as_null(spark, rows, tmp_path):
    data = [(1, None, True, 1.5, dt.date(2020, 1, 2)), (2, "", None, None, None), (3, 'say "x", y', False, 0.0, None)]
    df = spark.createDataFrame(data, "i bigint, t string, b boolean, d double, day date")
    path = str(tmp_path / "out")
    S.write_report(df.coalesce(1), path)
    (part,) = (tmp_path / "out").glob("part-*.csv")
    assert part.read_text().splitlines() == [
        "i,t,b,d,day", "1,,true,1.5,2020-01-02", "2,,,,", '3,"say ""x"", y",false,0.0,',
    ]
    back = S.read_csv_table(spark, path, df.schema)
    assert rows(back) == [(1, None, True, 1.5, dt.date(2020, 1, 2)), (2, None, None, None, None), (3, 'say "x", y', False, 0.0, None)]


def test_csv_columns_are_found_by_name_and_na_texts_are_null(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text('b,a,c\nNA,1,x\n"n/a",2.0, y \nz,bad,\n')
    got = S.read_csv_table(spark, str(tmp_path), "a bigint, b string, c string")
    assert rows(got) == [(None, "z", None), (1, None, "x"), (2, None, " y ")]


def test_csv_files_with_different_headers_are_refused(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n")
    (tmp_path / "b.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="(?i)header"):
        S.read_csv_table(spark, str(tmp_path), "a bigint, b bigint").collect()


def test_csv_multiline(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text('a,b\n1,"x\ny"\n')
    assert rows(S.read_csv_table(spark, str(tmp_path), "a int, b string", multiline=True)) == [(1, "x\ny")]


def test_csv_strings(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_text("reference,end-date,other\n1,2020,x\n2,,y\n")
    got = S.read_csv_strings(spark, str(tmp_path), ["reference", "end-date"], "end-date")
    assert got.columns == ["reference", "end_date"]
    assert rows(got) == [("1", "2020")]


def test_columnar_pages_may_order_columns_differently(spark, rows, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps({"columns": ["a", "b"], "rows": [[1, "x"], [2, None]]}, indent=1))
    (tmp_path / "2.json").write_text(json.dumps({"columns": ["b", "a"], "rows": [["y", 3]]}))
    (tmp_path / "3.json").write_text(json.dumps({"columns": ["a", "b"], "rows": []}))
    got = S.read_pages(spark, str(tmp_path / "*.json"), "a bigint, b string, c string", "columnar")
    assert rows(got) == [(1, "x", None), (2, None, None), (3, "y", None)]


def test_json_records_keep_blanks(spark, rows, tmp_path):
    (tmp_path / "1.json").write_text(json.dumps([{"a": 1, "b": ""}, {"a": 2, "b": None}], indent=1))
    (tmp_path / "2.json").write_text(json.dumps([{"a": 3}]))
    got = S.read_pages(spark, str(tmp_path / "*.json"), "a bigint, b string")
    assert rows(got) == [(1, ""), (2, None), (3, None)]


def test_entities_with_hyphens_and_defaults(spark, rows, tmp_path):
    spark.createDataFrame([("1", "n", "7")], "entity string, name string, `organisation-entity` string").write.parquet(str(tmp_path / "x"))
    spark.createDataFrame([(2, "m", "r", None)], "entity bigint, name string, reference string, organisation_entity bigint").write.parquet(str(tmp_path / "y"))
    paths = {"x": str(tmp_path / "x"), "y": str(tmp_path / "y")}
    columns = {"entity": "bigint", "name": "string", "reference": "string", "organisation_entity": "bigint"}
    got = S.read_entities(spark, paths, columns, {"reference": ""})
    assert rows(got) == [("x", 1, "n", "", 7), ("y", 2, "m", "r", None)]
    with pytest.raises(ValueError, match="reference"):
        S.read_entities(spark, paths, columns)


def test_specification(spark, rows):
    text = '[{"dataset": "tree", "fields": [{"field": "a"}, {"field": "b"}]}, {"dataset": "x", "fields": []}]'
    got = S.read_specification(spark.createDataFrame([(text,)], "json string"))
    assert rows(got) == [("tree", "a"), ("tree", "b")]


def test_slugs(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("b",)], "dataset string")
    assert [r.dataset for r in S.dataset_slugs(df).collect()] == ["a", "b"]


def test_split_and_empty_reports(spark, tmp_path):
    df = spark.createDataFrame([(1, "x"), (2, "y")], "i int, t string")
    S.write_split(df, {str(tmp_path / "one"): (F.col("i") == 1, None), str(tmp_path / "all"): (None, ["t"])})
    assert spark.read.csv(str(tmp_path / "one"), header=True).collect() == [("1", "x")]
    assert spark.read.csv(str(tmp_path / "all"), header=True).columns == ["t"]
    S.write_report(df.filter("i > 5"), str(tmp_path / "none"))
    (part,) = (tmp_path / "none").glob("part-*.csv")
    assert part.read_text() == "i,t\n"


def test_intermediate_tables_go_to_the_shared_folder(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    df = S.materialise(spark.createDataFrame([(1, None)], "i int, t string"), "t")
    assert [tuple(r) for r in df.collect()] == [(1, None)]
    assert any(p.name.startswith("t-") for p in shared.iterdir())


def test_a_cluster_must_name_a_shared_folder():
    no_setting = SimpleNamespace(get=lambda name, default: default)
    cluster = SimpleNamespace(conf=no_setting, sparkContext=SimpleNamespace(master="spark://host:7077"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        S.scratch_dir(cluster, "x")
