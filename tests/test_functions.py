from datetime import date

import pytest
from pyspark.sql import functions as F

from starloom.functions.dates import date_key, parse_date
from starloom.functions.numbers import percent, to_number
from starloom.functions.text import title_case


@pytest.mark.parametrize(
    "text, expected",
    [
        ("2024-01-15", date(2024, 1, 15)),
        ("15/11/2024", date(2024, 11, 15)),
        ("Nov 15 2024", date(2024, 11, 15)),
        ("Jan 01 2020", date(2020, 1, 1)),
        ("Dec 31 2025", date(2025, 12, 31)),
        ("29/02/2024", date(2024, 2, 29)),
        ("29/02/2023", None),
        ("2024-13-01", None),
        ("Abc 01 2024", None),
        ("pas-une-date", None),
        ("2024/01/05", None),
        ("20240115", None),
        ("15-Nov-2024", None),
        ("2024-01-15 ", date(2024, 1, 15)),
        (" 2024-01-05", date(2024, 1, 5)),
        ("5/1/2024", date(2024, 1, 5)),
        ("Mar 5 2024", date(2024, 3, 5)),
        ("2024-1-5", date(2024, 1, 5)),
        ("5/13/2024", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_date(frame, text, expected):
    assert frame("t string", (text,)).select(parse_date(F.col("t"))).first()[0] == expected


def test_date_key(frame):
    df = frame("d date", (date(2024, 3, 5),))
    assert df.select(date_key(F.col("d"))).first()[0] == 20240305


@pytest.mark.parametrize(
    "text, expected",
    [
        ("electronique", "Electronique"),
        ("ÉLECTRONIQUE", "Électronique"),
        ("el-mansouri sara", "El-Mansouri Sara"),
        ("o'neil 2nd", "O'Neil 2Nd"),
        ("", ""),
        (None, None),
    ],
)
def test_title_case(frame, text, expected):
    assert frame("t string", (text,)).select(title_case(F.col("t"))).first()[0] == expected


@pytest.mark.parametrize("text, expected", [("5", 5), (" 12.5 ", 12.5), ("-3", -3), ("123456789012345", 123456789012345), ("0.00004", 0.00004), ("2.000049", 2.000049), ("x", None), ("", None), (None, None)])
def test_to_number(frame, text, expected):
    value = frame("t string", (text,)).select(to_number(F.col("t"))).first()[0]
    assert (None if value is None else float(value)) == expected


@pytest.mark.parametrize(
    "part, whole, digits, expected",
    [(1, 8, 2, 12.5), (1, 800, 2, 0.13), (1, 3, 2, 33.33), (2, 3, 1, 66.7), (0, 5, 2, 0.0), (1, 0, 2, None), (-1, 8, 1, -12.5)],
)
def test_percent(frame, part, whole, digits, expected):
    value = frame("a bigint, b bigint", (part, whole)).select(percent(F.col("a"), F.col("b"), digits)).first()[0]
    assert (None if value is None else float(value)) == expected


@pytest.mark.parametrize("text", ["123456789012345678901", "1e25", "0.00000000001", "-1e-30"])
def test_a_number_that_would_be_lost_stops_the_job(frame, text):
    with pytest.raises(Exception, match="out of range"):
        frame("t string", (text,)).select(to_number(F.col("t"))).collect()


@pytest.mark.parametrize("text", ["NaN", "Infinity", "1e999", "0.0", "-0"])
def test_what_is_no_finite_number_or_zero(frame, text):
    assert frame("t string", (text,)).select(to_number(F.col("t"))).first()[0] in (None, 0)


@pytest.mark.parametrize(
    "text",
    ["2024-01-1T", "2024-01-1\t", "\t024-01-01", "+999-01-01", "2024-01- 1", "1T/01/2024", "1\t/01/2024", "anF 15 2024", "Jan 5  2024", "jan 15 2024", "2024-01-1\u0661"],
)
def test_dates_cut_by_place_are_as_strict_as_the_patterns(frame, text):
    assert frame("t string", (text,)).select(parse_date(F.col("t"))).first()[0] is None
