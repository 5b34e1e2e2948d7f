"""Text expressions."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def title_case(text: Column) -> Column:
    """Upper-case the first letter of every run of letters, lower-case the others.

    initcap only looks at blanks: it would leave 'el-mansouri' as 'El-mansouri'.
    """
    runs = F.regexp_extract_all(text, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    capital = F.transform(runs, lambda r: F.concat(F.upper(F.left(r, F.lit(1))), F.lower(F.substr(r, F.lit(2)))))
    return F.array_join(capital, "")


def match_key(text: Column) -> Column:
    """Form under which free text is looked up."""
    return F.lower(F.trim(text))


def map_code(code: Column, codes: Mapping[str, str], otherwise: str) -> Column:
    """Replace a code by its meaning; unknown or null codes become `otherwise`."""
    pairs = [F.lit(x) for pair in codes.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), code), F.lit(otherwise))
