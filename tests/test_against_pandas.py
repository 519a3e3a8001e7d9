"""The rules against pandas on random cells."""
import random
import warnings

import numpy as np
import pandas as pd
import pytest

from sluicebox.functions import parsing
from sluicebox.operators import dedup, profile, transform
from sluicebox.operators.profile import ROW_ORDER
from sluicebox.sources import csv


def random_cells(seed, n=3000):
    rng = random.Random(seed)
    alphabet = "0123456789" * 3 + "..--+eE ,$x_dfinfna"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 7))) for _ in range(n)]


def test_parse_number(one):
    cells = random_cells(1) + ["inf", "-inf", "Infinity", " 1 ", "1e5", "1E-2", ".5", "5.", "+3", "0012", "1e400", "-0"]
    got = one(parsing.parse_number, cells)
    expected = [pd.to_numeric(pd.Series([c]), errors="coerce")[0] for c in cells]
    # pandas rejects zeros with a huge exponent, as in 0E316.
    bad = [
        (c, g, e) for c, g, e in zip(cells, got, expected)
        if g != 0 and ((g is None) != bool(pd.isna(e)) or (g is not None and g != e))
    ]
    assert not bad, bad[:20]


def test_csv_types(spark, tmp_path):
    rng = random.Random(3)
    pools = [
        ["1", "2", "30"], ["1", "", "3"], ["1.5", "2", "NA"], ["True", "False", "TRUE"], ["True", "", "False"], ["a", "b", "nan"],
        ["2020-01-01", "x"], ["1e3", "inf"], ["007", "8"], [" 1", "2 "], ["-", "1"], ["", "NULL"], ["0", "1"], ["1,5", "2"],
    ]
    columns = {f"c{i}": [rng.choice(pool) for _ in range(40)] for i, pool in enumerate(pools)}
    path = tmp_path / "t.csv"
    pd.DataFrame(columns).to_csv(path, index=False)
    expected = pd.read_csv(path, na_values=[""], keep_default_na=True)
    df = csv.read_csv(spark, path, clean=False)
    names = {"int64": "bigint", "float64": "double", "bool": "boolean", "object": "string"}
    assert {c: t for c, t in df.dtypes if c != ROW_ORDER} == {c: names[str(t)] for c, t in expected.dtypes.items()}
    got = df.orderBy(ROW_ORDER).drop(ROW_ORDER).collect()
    for i, row in enumerate(got):
        for c in expected.columns:
            e = expected[c][i]
            # A truth value in a column with gaps stays the text that was read.
            e = str(e) if isinstance(e, bool) and isinstance(row[c], str) else e
            assert (row[c] is None and pd.isna(e)) or row[c] == e, (c, i, row[c], e)


@pytest.mark.parametrize("seed", range(4))
def test_quartile_bins(spark, seed):
    rng = np.random.default_rng(seed)
    values = [rng.normal(0, 10, 200), rng.integers(0, 6, 200).astype(float), rng.exponential(0.01, 200), rng.normal(0, 1e6, 200).round(2)][seed]
    expected = pd.qcut(pd.Series(values), q=4, duplicates="drop")
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i int, v double")
    got = [r["v_bin_index"] for r in transform.quantile_bins(df, ["v"])[0].orderBy("i").collect()]
    assert got == list(expected.cat.codes)
    edges = transform.quantile_bins(df, ["v"])[1]["v"]
    pairs = [float(x) for label in transform.bin_labels(edges) for x in label.strip("(]").split(",")]
    assert pairs == pytest.approx([x for i in expected.cat.categories for x in (i.left, i.right)])


def test_modes(spark):
    rng = random.Random(5)
    frame = pd.DataFrame({
        "s": [rng.choice(["b", "a", "10", "2", "ß", "Z", None]) for _ in range(300)],
        "d": [rng.choice([1.5, -2.0, 0.0, None]) for _ in range(300)],
        "u": [f"k{rng.random()}" for _ in range(300)],
    })
    df = spark.createDataFrame([tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False)], "s string, d double, u string")
    modes = profile.collect_modes(df, ["s", "d", "u"])
    row = spark.range(1).select(*[v.alias(c) for c, v in modes.items()]).first()
    assert (row["s"], row["d"], row["u"]) == tuple(frame[c].mode().iloc[0] for c in ("s", "d", "u"))


@pytest.mark.parametrize("keep", ["first", "last", False])
def test_drop_duplicates(spark, keep):
    rng = random.Random(6)
    rows = [(i, rng.choice([1, 2, 3, None]), rng.choice(["a", "b", None]), rng.random()) for i in range(200)]
    frame = pd.DataFrame(rows, columns=["i", "k", "t", "v"])
    expected = set(frame.drop_duplicates(subset=["k", "t"], keep=keep)["i"])
    df = spark.createDataFrame(rows, "i int, k int, t string, v double").repartition(5)
    assert {r["i"] for r in dedup.keep_one(df, ["k", "t"], keep, "i").collect()} == expected


def test_dates_of_one_format(spark):
    cells = {
        "iso": ["2024-01-02", "2024-13-01", "2024-02-30", None, "2023-12-31"],
        "american": ["01/25/2020", "02/30/2020", "12/31/1999", "x", "11/11/2011"],
        "seconds": ["2024-01-02 03:04:05", "2024-01-02 25:00:00", "2024-01-02 23:59:59", "", "2024-06-01 00:00:00"],
        "names": ["Jul 1, 2004", "Feb 30, 2004", "Dec 25, 1999", "Foo 1, 2000", "Jan 31, 2001"],
    }
    df = spark.createDataFrame(list(zip(*cells.values())), ", ".join(f"{c} string" for c in cells))
    counts = profile.date_counts(df, df.columns)
    for name, values in cells.items():
        with warnings.catch_warnings():
            warnings.simplefilter("ignore")
            fits = int(pd.to_datetime(pd.Series(values), errors="coerce").notna().sum())
        assert max(counts[name].values()) == fits, name
