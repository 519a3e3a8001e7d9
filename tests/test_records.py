import random

import pytest

from sluicebox.plans.workspace import Workspace
from sluicebox.sources import csv
from sluicebox.operators.profile import ROW_ORDER
from sluicebox.sources.records import read_records, scan_lines

PLAIN = ["", "a", "12", "b c", 'x"y', ' "z', "é", "1.5", "tail "]
QUOTED = ['""', '"a"', '"a,b"', '"say ""hi"""', '"line\nbreak"', '"\n\n"', '"end""\n"', '",\n,"', '"""\n"""', '"x\n' + "y\n" * 9 + 'z,"']


@pytest.fixture
def split(spark):
    """Splits of a few bytes, so that records span many of them."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")

    def size(n):
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(n))
    yield size
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def messy(rng, rows, quoted):
    out = ['"first\nname",b,c']
    for _ in range(rows):
        out.append(",".join(rng.choice(QUOTED) if rng.random() < quoted else rng.choice(PLAIN) for _ in range(3)))
        if rng.random() < 0.05:
            out.append(rng.choice(["", "  "]))
    return "\n".join(out) + rng.choice(["", "\n"])


def whole(spark, path):
    """The same file by Spark's reader, in one task."""
    df = spark.read.option("quote", '"').option("escape", '"').option("multiLine", True).option("header", True).csv(str(path))
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("quoted,size", [(0.0, 40), (0.02, 50), (0.3, 20), (0.3, 64), (0.9, 33), (0.3, 10 ** 8)])
def test_against_the_reader_of_whole_files(spark, tmp_path, split, quoted, size):
    path = tmp_path / "m.csv"
    path.write_text(messy(random.Random(int(quoted * 100) + size), 120, quoted), newline="")
    wanted = [r for r in whole(spark, path) if any(c and c.strip() for c in r) or len([c for c in r if c is not None]) > 1]
    split(size)
    df, names = csv.read_strings(spark, str(path))
    assert names[0] == "first\nname" and names[1:] == ["b", "c"]
    got = [tuple(r)[:3] for r in df.orderBy(ROW_ORDER).collect()]
    assert [r for r in got if any(c and c.strip() for c in r) or len([c for c in r if c is not None]) > 1] == wanted and len(wanted) > 90


def test_one_file_gives_a_task_for_each_split(spark, tmp_path, split):
    path = tmp_path / "m.csv"
    path.write_text("a,b\n" + '"x\ny",1\nplain,2\n' * 500)
    size = path.stat().st_size
    split(size // 9)
    assert scan_lines(spark, str(path)).rdd.getNumPartitions() >= 9
    df = csv.read_csv(spark, path)
    assert df.rdd.getNumPartitions() >= 9 and df.count() == 1000
    split(size // 2)
    space = Workspace(spark)
    found = read_records(spark, str(path), work=space)
    assert [r["record"] for r in found.df.orderBy("row").limit(2).collect()] == ['"x\ny",1', "plain,2"]
    space.close()


def test_a_record_over_many_blocks(spark, tmp_path, split):
    """Whole blocks inside one cell, then blocks without openers that begin inside it, and an opener in the block that closes it."""
    inner = "\n".join(f"line {k}, with commas" for k in range(60))
    text = f'a,b\n1,"{inner}"\n2,x\n3,"{inner} ""quoted"" ",\n4,"y\nz"\n5,w\n'
    path = tmp_path / "m.csv"
    path.write_text(text)
    for size in (30, 77, 400):
        split(size)
        df, _ = csv.read_strings(spark, str(path))
        rows = [tuple(r)[:2] for r in df.orderBy(ROW_ORDER).collect()]
        assert rows == [("1", inner), ("2", "x"), ("3", inner + ' "quoted" '), ("4", "y\nz"), ("5", "w")]


def test_each_file_by_its_own_encoding(spark, tmp_path, caplog):
    (tmp_path / "u.csv").write_bytes("name,n\nCafé,1\n\"über\nall\",2\n".encode())
    (tmp_path / "l.csv").write_bytes("name,n\nCafé,3\n\"über\nall\",4\n".encode("latin-1"))
    (tmp_path / "p.csv").write_bytes(b"name,n\nplain,5\n")
    df = csv.read_csv(spark, tmp_path, clean=False)
    assert {(r["name"], r["n"]) for r in df.collect()} == {("Café", 1), ("über\nall", 2), ("Café", 3), ("über\nall", 4), ("plain", 5)}
    assert "l.csv" in caplog.text and "u.csv" not in caplog.text
    forced = csv.read_csv(spark, tmp_path / "u.csv", encoding="latin-1", clean=False)
    assert "CafÃ©" in {r["name"] for r in forced.collect()}


def test_other_encodings_are_read_whole(spark, tmp_path):
    (tmp_path / "w.csv").write_bytes("name,n\n\"Café\nx\",1\n".encode("utf-16"))
    df = csv.read_csv(spark, tmp_path / "w.csv", encoding="utf-16", clean=False)
    assert [(r["name"], r["n"]) for r in df.collect()] == [("Café\nx", 1)]


def test_line_ends_marks_and_empty_files(spark, tmp_path):
    (tmp_path / "r.csv").write_bytes("﻿a,b\r\n\"x\r\ny\",1\r\n\r\nz,2\r\n".encode())
    df = csv.read_csv(spark, tmp_path / "r.csv", clean=False)
    assert [tuple(r)[:2] for r in df.orderBy(ROW_ORDER).collect()] == [("x\ny", 1), ("z", 2)] and df.columns[:2] == ["a", "b"]
    (tmp_path / "e.csv").write_bytes(b"")
    with pytest.raises(ValueError):
        csv.read_csv(spark, tmp_path / "e.csv")
    (tmp_path / "h.csv").write_bytes(b"\n\na,b\n")
    assert csv.read_csv(spark, tmp_path / "h.csv").count() == 0
    (tmp_path / "q.csv").write_bytes(b'a,b\n1,2\n3,"open\n4,5\n')
    rows = csv.read_strings(spark, str(tmp_path / "q.csv"))[0].orderBy(ROW_ORDER).collect()
    assert [tuple(r)[:2] for r in rows][0] == ("1", "2") and len(rows) == 2


def test_lines_as_records(spark, tmp_path):
    (tmp_path / "n.csv").write_text('a,b\n1,"2\n3,4\n')
    rows = csv.read_strings(spark, str(tmp_path / "n.csv"), multi_line=False)[0].collect()
    assert len(rows) == 2
