import datetime
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from sluicebox.functions import parsing, text


def python_clean(cell):
    """The cleaning rule step by step, as the words describe it."""
    cell = unicodedata.normalize("NFKC", cell)
    cell = re.sub(r"\[[^\]]*\]", "", cell)
    cell = re.sub(r"[†‡*]", "", cell)
    cell = re.sub(r"[^\x20-\x7E]", "", cell)
    return re.sub(r" +", " ", cell).strip(" ")


def test_clean_text_cases(one):
    cells = ["Beyoncé", "2023–2024", "Tour ‡[4][a]", "a\tb\nc", "  x   y ", "“q” it’s", "[1]", "[[a]b]", None, "",
             "ﬁx ½ ™ …", "［x］y", "ét", "open [ bracket", "ＡＢＣ １２３", "x y"]
    expected = [None if c is None else python_clean(c) for c in cells]
    assert one(text.clean_text, cells) == expected
    assert expected[0] == "Beyonc" and expected[1] == "20232024" and expected[10] == "fix 12 TM ..."


def test_clean_text_can_keep_punctuation(one):
    assert one(lambda c: text.clean_text(c, keep_punctuation=True), ["“q” it’s 2–3—4"]) == ["\"q\" it's 2-3-4"]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=st.characters(blacklist_categories=("Cs", "Cn")), max_size=40), min_size=1, max_size=60))
def test_clean_text_any_text(one, cells):
    assert one(text.clean_text, cells) == [python_clean(c) for c in cells]


def test_mojibake(one):
    assert one(text.fix_mojibake, ["CafÃ©", "Tour â€¡", "x â€ y", "é"]) == ["Café", "Tour ", "x y", "é"]


def test_strip_takes_all_white_space(one):
    assert one(text.strip, ["  x y\t\n", "\x1fz　", "", " ", None]) == ["x y", "z", "", "", None]


def test_null_missing_is_exact(one):
    kept = ["Null", "n/a", "?", "    ", "NA", "x", "nAn"]
    gone = ["", " ", "  ", "   ", "\t", "\n", "nan", "NaN", "NAN", "null", "NULL", "none", "None", "NONE", "-", "--", "—", "<NA>"]
    assert one(text.null_missing, kept + gone + [None]) == kept + [None] * (len(gone) + 1)


def test_parse_number(one):
    cells = ["1", " 2.5 ", "-3e2", "+.5", "7.", "inf", "-Infinity", "nan", "1d", "1f", "0x10", "1_000", "1,000", "", "--1", None]
    inf = float("inf")
    assert one(parsing.parse_number, cells) == [
        1.0, 2.5, -300.0, 0.5, 7.0, inf, -inf, None, None, None, None, None, None, None, None, None]


def test_clean_numeric(one):
    cells = {
        "$229,100,000[b]": 229100000.0, "€103.5M": 103500000.0, "₹2k": 2000.0, "£1b": 1e9, "Jul 1, 2004": 12004.0,
        "1,000 to 4,999": 10004999.0, "(500)": 500.0, "1-2": None, "words": None, " 12K [x]": 12.0, "12K[x]": 12000.0,
        "-$5": -5.0, "5 K": 5000.0, "": None, "1.2.3": None, "Album 1989 (Deluxe)": 1989.0, None: None,
    }
    assert one(parsing.clean_numeric, list(cells)) == list(cells.values())


def test_clean_numeric_keeps_what_it_cannot_read(one):
    cells = ["$12,345,678", "1-2", "words", "€2.55", None]
    assert one(parsing.clean_numeric_or_keep, cells) == ["12345678.0", "1-2", "words", "2.55", None]


def test_year_bounds(one):
    cells = ["2023–2024", "20232024", "2009", "from 1999 to 2001, then 2005", "1850", "none", None, "2010−2011"]
    assert one(parsing.year_bounds, cells) == [
        (2023, 2024), (2023, 2024), (2009, None), (1999, 2005), (None, None), (None, None), (None, None), (2010, 2011)]


@pytest.mark.parametrize("name, cell, expected", [
    ("iso_date", "2024-2-29", datetime.datetime(2024, 2, 29)),
    ("iso_date", "2023-02-29", None),
    ("iso_second", "2024-01-02 03:04:05.25", datetime.datetime(2024, 1, 2, 3, 4, 5, 250000)),
    ("iso_t", "2024-01-02T03:04:05", datetime.datetime(2024, 1, 2, 3, 4, 5)),
    ("iso_minute", "2024-01-02 03:04", datetime.datetime(2024, 1, 2, 3, 4)),
    ("slash_mdy", "12/31/2020", datetime.datetime(2020, 12, 31)),
    ("slash_mdy", "31/12/2020", None),
    ("slash_dmy", "31/12/2020", datetime.datetime(2020, 12, 31)),
    ("slash_mdy_minute", "1/2/2020 9:30", datetime.datetime(2020, 1, 2, 9, 30)),
    ("dash_mdy", "12-31-2020", datetime.datetime(2020, 12, 31)),
    ("dash_dmy", "31-12-2020", datetime.datetime(2020, 12, 31)),
    ("slash_ymd", "2020/1/2", datetime.datetime(2020, 1, 2)),
    ("month_name", "Jul 1, 2004", datetime.datetime(2004, 7, 1)),
    ("month_full", "January 15, 2004", datetime.datetime(2004, 1, 15)),
    ("day_month_name", "3 Mar 1999", datetime.datetime(1999, 3, 3)),
    ("iso_date", "junk", None),
])
def test_parse_date(one, name, cell, expected):
    shown = one(lambda c: F.date_format(parsing.parse_date(c, name), "yyyy-MM-dd HH:mm:ss.SSSSSS"), [cell])[0]
    assert shown == (expected.strftime("%Y-%m-%d %H:%M:%S.%f") if expected else None)


def test_parse_boolean(one):
    assert one(parsing.parse_boolean, ["Yes", "NO", "1", "0", "TRUE", "false", "t", "y", None]) == [
        True, False, True, False, True, False, None, None, None]


def test_delimiters_and_multi_values(one):
    assert one(text.normalize_delimiters, ["a; b / c:d ,e", "http://x", "a ; , b", None]) == [
        "a,b,c,d,e", "http,,,x", "a,,b", None]
    assert one(text.split_multi_values, [" C#;HTML/CSS; JS "]) == ["c#,html/css, js"]
    assert one(text.multi_values, ["C#;HTML / JS"]) == [["C#", "HTML", "JS"]]


def test_split_year(one):
    cells = ["2018-2020", "2018", "x-2020", "2018-2019-2020", "2018.0-2019", None]
    assert one(parsing.split_year, cells) == [
        (2018, 2020), (2018, None), (None, 2020), (2018, None), (2018, 2019), (None, None)]


def test_number_text_round_trips(one):
    cells = [12345678.0, 1e15, 0.5, -3.0, 1e300, None]
    shown = one(parsing.number_text, cells, "double")
    assert shown[:4] == ["12345678.0", "1000000000000000.0", "0.5", "-3.0"]
    assert [None if s is None else float(s) for s in shown] == cells


def test_quick_looks_before_the_patterns_change_no_answer(spark):
    """What a look at bytes and lengths rules out, the patterns would have refused."""
    from sluicebox import fixed_values as fv
    from sluicebox.functions.parsing import parse_number
    from sluicebox.functions.text import is_one_of, may_have_edge_space, needs_cleaning, strip
    from sluicebox.operators.profile import _date_like

    cells = [
        "", " ", "1", " 1 ", "+1.5e3", "-.5", "1e999", "9" * 310, "inf", "-Infinity", "iNF", "i", "$5", "1/2", "\t7\n", "12:3", "1d", "é1",
        "2020-01-02", "2020/1/2 ", "2020-01-02 ", "Jan 2, 2020", "2020-01-02x", " a", "a ", "a\x1f", "*", "[x", "a  b", "†", "—", "<NA>", "<NA>x", None,
    ]
    shapes = "|".join(shape.strip("^$") for _, shape, _ in fv.DATE_FORMATS)
    c = F.col("c")
    rows = spark.createDataFrame([(v,) for v in cells], "c string").select(
        "c", parse_number(c).alias("number"), F.when(c.rlike(fv.NUMBER), c.try_cast("double")).alias("cast"),
        _date_like(c).alias("date"), ((F.octet_length(c) >= 8) & c.rlike(f"^(?:{shapes})$")).alias("date_shape"),
        needs_cleaning(c).alias("dirty"), may_have_edge_space(c).alias("edge"), (F.octet_length(strip(c)) < F.octet_length(c)).alias("stripped"),
        is_one_of(c, fv.MISSING_WORDS).alias("missing"),
    ).collect()
    for r in rows:
        if r["c"] is None:
            assert all(v is None for v in r)
            continue
        beyond = r["cast"] is not None and abs(r["cast"]) == float("inf") and "inf" not in r["c"].lower()
        assert r["number"] == (None if beyond else r["cast"]), r
        assert r["date"] == r["date_shape"], r
        assert r["dirty"] == bool(re.search(r"[^\x20-\x7E]|[\[*]|  |^ | \Z", r["c"])), r
        assert r["edge"] or not r["stripped"], r
        assert r["missing"] == (r["c"] in fv.MISSING_WORDS), r
