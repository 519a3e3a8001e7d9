import pytest
from pyspark.sql import functions as F

from sluicebox.operators.profile import ROW_ORDER
from sluicebox.operators.validate import check_written
from sluicebox.plans.workspace import Workspace
from sluicebox.sources import csv, tables
from sluicebox.sources.artifacts import Artifacts


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return path


def test_types_found_in_a_csv(spark, tmp_path):
    path = write(tmp_path / "t.csv", (
        "Id,,Whole,Gaps,Part,Flag,Half Flag,Note,Note,Void\n"
        '007,x,1,1,1.5,True,True,"say ""hi"", [1]",a,\n'
        "8,y,2,,2,FALSE,N/A,multi †,NA,\n"
        "9,Beyoncé,-3,3,1e3,true,False,- ,null,\n"
    ))
    df = csv.read_csv(spark, path)
    assert dict(df.dtypes) == {
        "id": "bigint", "unnamed_1": "string", "whole": "bigint", "gaps": "double", "part": "double", "flag": "boolean",
        "half_flag": "string", "note": "string", "note_1": "string", "void": "double", ROW_ORDER: "bigint"}
    assert [tuple(r) for r in df.orderBy(ROW_ORDER).drop(ROW_ORDER).collect()] == [
        (7, "x", 1, 1.0, 1.5, True, "True", 'say "hi",', "a", None),
        (8, "y", 2, None, 2.0, False, None, "multi", None, None),
        (9, "Beyonc", -3, 3.0, 1000.0, True, "False", "-", None, None)]


def test_latin1_is_recognised(spark, tmp_path):
    path = write(tmp_path / "l.csv", "name,n\nCafé,1\nplain,2\n", "latin-1")
    raw = csv.read_csv(spark, path, clean=False)
    assert {r["name"] for r in raw.collect()} == {"Café", "plain"}
    path = write(tmp_path / "u.csv", "name\nCafé �\n")
    assert csv.read_csv(spark, path, clean=False).first()["name"] == "Café �"


def test_paths(spark, tmp_path):
    write(tmp_path / "a.csv", "x\n1\n")
    assert csv.resolve("a", tmp_path) == str(tmp_path / "a.csv")
    assert csv.resolve("s3://bucket/a") == "s3://bucket/a"
    with pytest.raises(FileNotFoundError):
        csv.resolve("b", tmp_path)
    write(tmp_path / "B.CSV", "x\n1\n")
    write(tmp_path / "c.txt", "")
    assert [p.rsplit("/", 1)[1] for p in csv.list_csv(spark, tmp_path)] == ["B.CSV", "a.csv"]


def test_row_order_over_several_files(spark, tmp_path):
    for part in range(3):
        write(tmp_path / f"p{part}.csv", "n\n" + "\n".join(str(part * 10 + i) for i in range(4)) + "\n")
    df = csv.read_csv(spark, tmp_path)
    assert [r["n"] for r in df.orderBy(ROW_ORDER).collect()] == [p * 10 + i for p in range(3) for i in range(4)]


def test_quoted_line_breaks(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'a,b\n"x\ny",1\nz,2\n')
    df = csv.read_csv(spark, path, multi_line=True)
    assert [tuple(r)[:2] for r in df.orderBy(ROW_ORDER).collect()] == [("xy", 1), ("z", 2)]


def test_quoted_line_breaks_by_default(spark, tmp_path):
    path = write(tmp_path / "m.csv", 'a,b\n"x\ny",1\nz,2\n')
    df = csv.read_csv(spark, path, clean=False)
    assert [tuple(r)[:2] for r in df.orderBy(ROW_ORDER).collect()] == [("x\ny", 1), ("z", 2)]


def test_malformed_records_are_reported(spark, tmp_path, caplog):
    path = write(tmp_path / "m.csv", "a,b\n1,2\n3,4,5\n")
    assert csv.read_csv(spark, path).count() == 2
    assert "1 records" in caplog.text
    with pytest.raises(ValueError):
        csv.read_csv(spark, path, strict=True)


def test_headers_must_agree(spark, tmp_path):
    (tmp_path / "x").mkdir()
    write(tmp_path / "x" / "p0.csv", "a,b\n1,2\n")
    write(tmp_path / "x" / "p1.csv", "b,a\n1,2\n")
    with pytest.raises(Exception):
        csv.read_csv(spark, tmp_path / "x").collect()


def test_large_whole_numbers_keep_their_digits(spark, tmp_path):
    path = write(tmp_path / "n.csv", "a,b,c\n9007199254740993,1,x\n,2,y\n1200000000000000251,,z\n")
    df = csv.read_csv(spark, path)
    assert dict(df.dtypes)["a"] == "bigint" and dict(df.dtypes)["b"] == "double"
    assert {r["a"] for r in df.collect()} == {9007199254740993, None, 1200000000000000251}


def test_custom_missing_words(spark, tmp_path):
    path = write(tmp_path / "q.csv", "a\n?\n1\n")
    assert dict(csv.read_csv(spark, path).dtypes)["a"] == "string"
    assert dict(csv.read_csv(spark, path, missing_words=("", "?")).dtypes)["a"] == "double"


def test_files_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", x', 2.5, None), (2, "b", None, True)], "i bigint, t string, d double, b boolean")
    df = df.withColumn(ROW_ORDER, F.lit(1))
    back = tables.read_cleaned(spark, tables.write_parquet(df, str(tmp_path / "p")))
    assert back.columns == ["i", "t", "d", "b"] and back.count() == 2
    back = tables.read_cleaned(spark, tables.write_csv(df, str(tmp_path / "c")))
    assert {tuple(r)[:3] for r in back.collect()} == {(1, 'say "hi", x', 2.5), (2, "b", None)}
    lines = spark.read.text(tables.write_text(df, str(tmp_path / "t"), "|"))
    assert {r[0] for r in lines.collect()} == {'1|say "hi", x|2.5|', "2|b||true"}


def test_catalog(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "a int, year_end int").withColumn(ROW_ORDER, F.lit(1))
    name = tables.write_table(df, "My Data v2_20260103_120000.csv")
    assert name == "`my_data_v2`.`transformed_my_data_v2`"
    assert tables.find_table(spark, "MY_DATA") == ("my_data_v2", "transformed_my_data_v2")
    assert "my_data_v2" in tables.list_databases(spark)
    assert check_written(spark, name, 2) == ({"a": 0}, 2)
    tables.write_table(df.limit(1), "My Data v2")
    assert tables.read_table(spark, "my_data_v2", "transformed_my_data_v2").count() == 1
    with pytest.raises(AssertionError):
        check_written(spark, name, 2)
    with pytest.raises(AssertionError):
        check_written(spark, name, allowed=())
    with pytest.raises(LookupError):
        tables.find_table(spark, "no such table")


def test_a_table_is_there_at_every_step(spark, monkeypatch):
    """A failure of the check, or between the steps of a replacement, leaves the old rows; the new ones come at once."""
    first = spark.createDataFrame([(1, "a")], "k int, t string")
    name = tables.write_table(first, "steps")
    read = lambda: sorted(map(tuple, spark.table(name).collect()))

    def refuse(source):
        assert spark.table(source).count() == 2 and read() == [(1, "a")]
        raise AssertionError("refused")
    two = spark.createDataFrame([(2, "b"), (3, "c")], "k int, t string")
    with pytest.raises(AssertionError):
        tables.write_table(two, "steps", check=refuse)
    assert read() == [(1, "a")]
    old = spark.table(name)
    tables.write_table(two, "steps")
    assert read() == [(2, "b"), (3, "c")] and old.count() == 1

    wider = two.withColumn("w", F.lit(1.5))
    real = type(spark.catalog).createTable
    monkeypatch.setattr(type(spark.catalog), "createTable", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        tables.write_table(wider, "steps")
    assert read() == [(2, "b"), (3, "c")]
    monkeypatch.setattr(type(spark.catalog), "createTable", real)
    tables.write_table(wider, "steps")
    assert spark.table(name).columns == ["k", "t", "w"] and [t for _, t in tables.list_tables(spark, ["steps"])] == ["transformed_steps"]
    tables.write_table(wider.limit(0), "steps")
    assert read() == [] and spark.table(name).columns == ["k", "t", "w"]
    for k in range(3):
        tables.write_table(wider.withColumn("k", F.lit(k)), "steps")
    path, system = tables._files(spark, spark.catalog.getDatabase("steps").locationUri + "/versions_steps")
    assert len(system.listStatus(path)) == 2 and {r["k"] for r in spark.table(name).collect()} == {2}


def test_a_managed_table_of_that_name_is_replaced(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS managed")
    spark.range(3).write.saveAsTable("managed.transformed_managed")
    name = tables.write_table(spark.range(5), "managed")
    assert spark.table(name).count() == 5


def test_artifacts(tmp_path):
    kept = Artifacts(tmp_path / "json")
    assert kept.load("d", kept.PLAN) is None
    kept.save("d_20260103_120000", kept.PLAN, {"columns": {}})
    kept.save("d", kept.EXECUTION, {"applied_at": "now"})
    assert kept.load("d", kept.PLAN) == {"columns": {}}


def test_workspace(spark):
    space = Workspace(spark)
    df = space.stage(spark.range(5).withColumn("a b", F.lit("x")), "t")
    assert df.columns == ["id", "a b"] and df.count() == 5
    space.close()
    with pytest.raises(Exception):
        spark.read.parquet(space.root + "/t").count()
