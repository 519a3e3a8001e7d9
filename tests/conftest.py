import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from sluicebox.session import configure

    folder = tempfile.mkdtemp(prefix="sluicebox-tests-")
    builder = (
        configure(SparkSession.builder).master("local[*]").appName("tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.warehouse.dir", f"{folder}/warehouse")
        .config("spark.driver.memory", "8g")
    )
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluates a rule on a list of cells."""
    def evaluate(rule, cells, column_type="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, c) for i, c in enumerate(cells)], f"i int, c {column_type}")
        results = rule(F.col("c"))
        results = results if isinstance(results, tuple) else (results,)
        rows = df.coalesce(1).select("i", *[r.alias(f"r{n}") for n, r in enumerate(results)]).orderBy("i").collect()
        values = [tuple(r)[1:] for r in rows]
        return [v[0] for v in values] if len(results) == 1 else values
    return evaluate
