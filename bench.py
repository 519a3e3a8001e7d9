"""Times the headline runs at $BENCH_SF_DIR on local[$BENCH_CPUS] and prints one JSON line."""
from __future__ import annotations

import json
import os
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession, functions as F  # noqa: E402

from sluicebox.operators.outliers import boxplot_stats  # noqa: E402
from sluicebox.operators.profile import ALL_GROUPS, collect_stats  # noqa: E402
from sluicebox.operators.transform import apply_plan, suggest_plan  # noqa: E402
from sluicebox.plans.clean import clean_csv, clean_frame  # noqa: E402
from sluicebox.plans.workspace import shared_folder  # noqa: E402
from sluicebox.session import configure  # noqa: E402
from sluicebox.sources.tables import write_csv, write_table  # noqa: E402
from workload import QUERIES  # noqa: E402
from workload.registry import table  # noqa: E402
from workload.runs import MESSY_LINES, MESSY_ORDERS  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

OPERATORS = [
    "clean_text_documents", "clean_numeric_amounts", "extract_year_range", "detect_schema_documents",
    "impute_auto", "boxplot_stats", "quartiles", "dedup_guarded", "derive_keys", "quantile_bins",
    "plan_groupby", "describe_customer", "csv_round_trip",
]


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def clean_lineitem(spark):
    """The whole run, box plots included, and the cleaned rows produced."""
    run = clean_frame(MESSY_LINES.frame(spark, SF_DIR), "lineitem")
    consume(run.df)
    run.workspace.close()


def profile_lineitem(spark):
    collect_stats(MESSY_LINES.frame(spark, SF_DIR), groups=ALL_GROUPS)


def wide(spark):
    """Sixty columns of mixed kinds."""
    lines = MESSY_LINES.frame(spark, SF_DIR)
    return lines.select(*[F.col(f"`{c}`").alias(f"{c} {k}") for k in range(6) for c in lines.columns])


def clean_wide(spark):
    run = clean_frame(wide(spark).where("`Line Ref. 0` < '2'"), "wide")
    consume(run.df)
    run.workspace.close()


def clean_csv_orders(spark):
    """From CSV to the cleaned rows."""
    where = f"{shared_folder(spark)}/bench-{uuid.uuid4().hex}"
    write_csv(MESSY_ORDERS.frame(spark, SF_DIR), where)
    run = clean_csv(spark, where, multi_line=False)
    consume(run.df)
    run.workspace.close()


def plan_and_write(spark):
    """Suggest a plan, apply it with every step on, and write the table."""
    lines = table(spark, SF_DIR, "lineitem")
    plan = suggest_plan(lines, "lineitem", enable_all=True)
    name = write_table(apply_plan(lines, plan).df, f"bench_{uuid.uuid4().hex[:8]}")
    spark.sql(f"DROP TABLE {name}")


def boxplots(spark):
    consume(boxplot_stats(table(spark, SF_DIR, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]))


def main() -> None:
    spark = (
        configure(SparkSession.builder).master(f"local[{CPUS}]").appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", "12g")
        .config("spark.sql.warehouse.dir", f"/tmp/bench-{uuid.uuid4().hex}")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = {
        "clean_lineitem": clean_lineitem,
        "profile_lineitem": profile_lineitem,
        "plan_and_write": plan_and_write,
        "boxplots_lineitem": boxplots,
        "clean_wide": clean_wide,
        "clean_csv_orders": clean_csv_orders,
    }
    for name in OPERATORS:
        runs[name] = lambda spark, name=name: consume(QUERIES[name](spark, SF_DIR))
    # Load classes and start the executor before timing.
    consume(table(spark, SF_DIR, "nation").groupBy("n_regionkey").count())
    times = {}
    for name, run in runs.items():
        start = time.perf_counter()
        run(spark)
        times[name] = round(time.perf_counter() - start, 3)
    # The long runs once more, with classes loaded and code compiled.
    for name in ("clean_lineitem", "profile_lineitem", "plan_and_write"):
        start = time.perf_counter()
        runs[name](spark)
        times[f"{name}_warm"] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
