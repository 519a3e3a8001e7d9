"""Whole runs on a small invented table with every sort of dirt."""
import pytest
from pyspark.sql import functions as F

from sluicebox.operators.profile import ROW_ORDER
from sluicebox.plans import batch, clean, transform
from sluicebox.plans.workspace import Workspace
from sluicebox.sources.artifacts import Artifacts

CSV = """Rank,Best,Cost,Builder,Bridge name,Built,Spans,Ref.
1,1,"$12,000,000",Ann Lee,Long Span †,1998–2001,4,[1]
2,1[2],"$9,500,000",Bo Ek,Old Arch,2003,3,[2]
3,,"$8,100,000[b]",Ann Lee,Café Bridge ‡[4],1999–2002,7,[3]
4,,"$7,700,000",Cy Fox,North Gate,2004–2008,2,[4][5]
5,2[7],"$7,100,000",Bo Ek,South Gate,2010,9,[6]
6,,"$6,000,000",Di Gray,West Gate,2011–2013,1,[7]
7,,"$5,200,000[d]",Cy Fox,East Gate,2012–2015,12,[8]
8,,"$4,900,000",Ann Lee,The 1990 Crossing,2016–2018,5,[9]
"""


@pytest.fixture
def source(tmp_path):
    folder = tmp_path / "data"
    folder.mkdir()
    (folder / "bridges.csv").write_text(CSV, encoding="utf-8")
    return folder


def test_clean_csv(spark, source, tmp_path):
    artifacts = Artifacts(tmp_path / "json")
    run = clean.clean_csv(spark, "bridges", data_dir=source, artifacts=artifacts)
    assert run.shape == (8, 8)
    assert run.routes == {
        "rank": "keep", "best": "keep", "cost": "numeric", "builder": "strip", "bridge_name": "strip",
        "built": "year", "spans": "keep", "ref": "keep"}
    assert run.dropped == ["ref"]
    assert run.imputed == {"numeric": 5, "text": 3, "datetime": 0}
    assert run.schema == {
        "rank": "integer", "best": "integer", "cost": "integer", "builder": "text", "bridge_name": "text",
        "built": "integer", "spans": "integer", "built_end": "integer"}
    assert {tuple(r) for r in run.missing_before.collect()} == {("best", 5)}
    assert [tuple(r) for r in run.df.orderBy(ROW_ORDER).drop(ROW_ORDER).collect()] == [
        (1, 1, 12000000, "Ann Lee", "Long Span", 1998, 4, 2001), (2, 1, 9500000, "Bo Ek", "Old Arch", 2003, 3, None),
        (3, 1, 8100000, "Ann Lee", "Caf Bridge", 1999, 7, 2002), (4, 1, 7700000, "Cy Fox", "North Gate", 2004, 2, 2008),
        (5, 2, 7100000, "Bo Ek", "South Gate", 2010, 9, None), (6, 1, 6000000, "Di Gray", "West Gate", 2011, 1, 2013),
        (7, 1, 5200000, "Cy Fox", "East Gate", 2012, 12, 2015), (8, 1, 4900000, "Ann Lee", "The 1990 Crossing", 2016, 5, 2018)]
    assert run.dedup.aborted and run.dedup.keys == ["builder"]
    assert run.validation.status == "PASS"
    assert artifacts.load("bridges", Artifacts.SCHEMA) == run.schema
    assert artifacts.load("bridges", Artifacts.VALIDATION)["checks"]["no_nulls"]["message"] == "Only structural nulls found (2); expected"
    # Before cleaning the glued year ranges read as numbers.
    assert {r["column"] for r in run.outliers_before.collect()} == {"rank", "built", "spans"}
    assert {r["column"] for r in run.outliers_after.collect()} == {"rank", "best", "cost", "spans", "built", "built_end"}
    assert {tuple(r)[1] for r in run.missing_after.collect()} == {0}


@pytest.mark.parametrize("strategy, count", [("drop", 0), ("fill", 8), (None, 8)])
def test_other_strategies(spark, source, strategy, count):
    """Dropping rows with gaps drops all of them, since one column is empty."""
    run = clean.clean_csv(spark, source / "bridges.csv", strategy=strategy, fill_value="0", with_outliers=False)
    assert run.df.count() == count


def test_a_dropped_sparse_column_is_reported(spark):
    df = spark.range(40).select(
        F.col("id").alias("Key Id"), F.when(F.col("id") < 4, F.lit(2001)).alias("Audit Year"), F.lit("x").alias("Word"))
    run = clean.clean_frame(df, "audit", with_outliers=False)
    assert run.dropped == ["audit_year"] and run.validation.as_dict()["checks"]["schema_match"]["status"] == "FAIL"
    assert run.dedup.keys == ["key_id"] and run.dedup.executed


def test_first_duplicate_in_file_order_stays(spark, tmp_path):
    lines = ["user_id,v"] + [f"{i},{i}" for i in range(60)] + ["5,again", "7,again"]
    (tmp_path / "d.csv").write_text("\n".join(lines) + "\n")
    run = clean.clean_csv(spark, tmp_path / "d.csv", with_outliers=False)
    assert run.dedup.executed and run.dedup.removed == 2 and run.dedup.keys == ["user_id"]
    kept = {r["user_id"]: r["v"] for r in run.df.collect()}
    assert len(kept) == 60 and kept[5] != "again" and kept[7] != "again"


def test_directory_to_tables(spark, source, tmp_path):
    (source / "second.csv").write_text("Word,Value\n" + "".join(f"w{i % 4},{i}.5\n" for i in range(20)))
    artifacts = Artifacts(tmp_path / "json")
    target = str(tmp_path / "out")
    runs = {r.dataset: r for r in batch.clean_directory(spark, source, target, artifacts, with_outliers=False)}
    assert set(runs) == {"bridges", "second"} and runs["second"].df.count() == 20
    cleaned = {name: f"{target}/{name}_cleaned" for name in runs}
    plans = batch.plan_directory(spark, cleaned, artifacts)
    assert plans["second"]["columns"]["word"]["enabled"] == {"lowercase": True, "strip": True}
    plans["second"]["columns"]["value"]["enabled"]["bins"] = True
    artifacts.save("second", Artifacts.PLAN, plans["second"])
    written = {w.table: w for w in batch.transform_directory(spark, cleaned, artifacts)}
    second = written["`second`.`transformed_second`"]
    assert second.rows == 20 and set(second.nulls.values()) == {0}
    assert spark.table(second.table).columns == ["word", "value", "value_bin"]
    assert spark.table(second.table).groupBy("value_bin").count().count() == 4
    report = artifacts.load("second", Artifacts.EXECUTION)
    assert report["generated_columns"] == ["value_bin"]
    again = transform.apply_saved_plan(spark.read.parquet(cleaned["second"]), "second", artifacts)
    assert again.report["column_transformations"] == report["column_transformations"]


def test_a_grown_directory_reads_new_files_only(spark, source, tmp_path):
    artifacts, target = Artifacts(tmp_path / "json"), str(tmp_path / "out")
    (source / "second.csv").write_text("Word,Value\n" + "".join(f"w{i % 4},{i}.5\n" for i in range(20)))
    run = lambda where=target, **more: {
        r.dataset: r for r in batch.clean_directory(spark, source, where, artifacts, with_outliers=False, skip_unchanged=True, **more)}
    first = run()
    assert all(isinstance(r, clean.CleanRun) for r in first.values())
    (source / "third.csv").write_text("Word,Value\na,1\nb,2\n")
    (source / "second.csv").write_text("Word,Value\n" + "".join(f"w{i % 4},{i}.5\n" for i in range(21)))
    second = run()
    assert {n for n, r in second.items() if isinstance(r, batch.KeptRun)} == {"bridges"} and second["second"].df.count() == 21
    full = {r.dataset: r for r in batch.clean_directory(spark, source, str(tmp_path / "full"), Artifacts(tmp_path / "other"), with_outliers=False)}
    for name, r in second.items():
        assert sorted(map(tuple, r.df.collect()), key=repr) == sorted(map(tuple, full[name].df.collect()), key=repr)
    assert second["bridges"].schema == first["bridges"].schema and second["bridges"].validation["status"] == "PASS"
    assert all(isinstance(r, clean.CleanRun) for r in run(strategy="drop").values())
    assert all(isinstance(r, clean.CleanRun) for r in run(str(tmp_path / "elsewhere"), strategy="drop").values())


def test_csv_directory_output(spark, source, tmp_path):
    target = str(tmp_path / "out")
    [run] = batch.clean_directory(spark, source, target, Artifacts(tmp_path / "json"), "csv", with_outliers=False)
    assert run.df.count() == 8 and dict(run.df.dtypes)["cost"] == "bigint"


def test_a_given_workspace_is_used(spark, source):
    space = Workspace(spark)
    run = clean.clean_csv(spark, source / "bridges.csv", with_outliers=False, workspace=space)
    assert run.workspace is space and spark.read.parquet(space.root + "/filled").count() == 8
