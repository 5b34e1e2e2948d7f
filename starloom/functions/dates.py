"""Date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_MONTHS = "JanFebMarAprMayJunJulAugSepOctNovDec"


def parse_date(text: Column) -> Column:
    """Date from ISO, DD/MM/YYYY or 'Mon DD YYYY' text; anything else is null.

    Blanks around the text and a missing leading zero of day or month change
    nothing. The text is brought to ISO by its shape and cast once, so that no
    parser exception is thrown and caught for each row of another format.
    Two-digit days and months, nearly all there are, are cut out by their places; only
    what does not read so goes through the patterns, which decide the rest.
    """
    text = F.trim(text)
    length = F.length(text)
    return F.coalesce(_by_place(text, length), F.when(length.between(8, 11), _by_pattern(text)))


def _month(text: Column) -> Column:
    """Two digits for the month name that text starts with; "00" for anything else."""
    month = ((F.position(F.substring(text, 1, 3), F.lit(_MONTHS)) + 2) / 3).cast("int")
    return F.lpad(month.cast("string"), 2, "0")


def _by_place(text: Column, length: Column) -> Column:
    def marks(mark: str, first: int, second: int) -> Column:
        return (F.substring(text, first, 1) == mark) & (F.substring(text, second, 1) == mark)

    def cut(start: int, size: int) -> Column:
        return F.substring(text, start, size)

    name = F.position(cut(1, 3), F.lit(_MONTHS)) % 3 == 1
    iso = (
        F.when((length == 10) & marks("-", 5, 8), text)
        .when((length == 10) & marks("/", 3, 6), F.concat(cut(7, 4), F.lit("-"), cut(4, 2), F.lit("-"), cut(1, 2)))
        .when((length == 11) & marks(" ", 4, 7) & name, F.concat(cut(8, 4), F.lit("-"), _month(text), F.lit("-"), cut(5, 2)))
    )
    # The cast asks for digits, but would pass over a blank or a T at the end.
    return F.when(F.substring(iso, 10, 1).between("0", "9"), iso).try_cast("date")


def _by_pattern(text: Column) -> Column:
    def part(pattern: str, group: int) -> Column:
        return F.lpad(F.regexp_extract(text, pattern, group), 2, "0")

    iso, european, named = r"^(\d{4})-(\d{1,2})-(\d{1,2})\z", r"^(\d{1,2})/(\d{1,2})/(\d{4})\z", r"^[A-Z][a-z]{2} (\d{1,2}) (\d{4})\z"
    found = (
        F.when(text.rlike(iso), F.concat_ws("-", F.regexp_extract(text, iso, 1), part(iso, 2), part(iso, 3)))
        .when(text.rlike(european), F.concat_ws("-", F.regexp_extract(text, european, 3), part(european, 2), part(european, 1)))
        .when(text.rlike(named), F.concat_ws("-", F.regexp_extract(text, named, 2), _month(text), part(named, 1)))
    )
    return found.try_cast("date")


def date_key(day: Column) -> Column:
    """Integer YYYYMMDD."""
    return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)


def nth_name(names: tuple[str, ...], position: Column) -> Column:
    """The name at a 1-based position."""
    return F.element_at(F.array(*[F.lit(n) for n in names]), position.cast("int"))
