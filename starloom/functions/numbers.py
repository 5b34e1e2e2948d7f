"""Number expressions. Money stays DECIMAL until the report edge."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def to_number(text: Column) -> Column:
    """Number from text; null where it is none. 20 digits before the point and ten decimals are kept.

    A number that needs more digits before the point, or is not 0 but has none within ten decimals, stops
    the job: as null or 0 it would let a rule drop its row unseen.
    """
    written = F.trim(text.cast("string"))
    number, rough = written.try_cast("decimal(30,10)"), written.try_cast("double")
    finite = rough.between(F.lit(-1.7976931348623157e308), F.lit(1.7976931348623157e308))
    lost = finite & (number.isNull() | ((number == 0) & (rough != 0)))
    return F.when(lost, F.raise_error(F.concat(F.lit("number out of range: "), written)).cast("decimal(30,10)")).otherwise(number)


def percent(part: Column, whole: Column, digits: int) -> Column:
    """100 * part / whole, rounded half up; null when whole is 0 or null.

    Decimal division keeps 14 digits here, so the rounding is not
    disturbed by binary fractions.
    """
    ratio = part.cast("decimal(20,2)") * F.lit(100) / F.nullif(whole.cast("decimal(20,2)"), F.lit(0))
    return F.round(ratio, digits)


def mean(total: Column, count: Column) -> Column:
    """Unrounded average as DOUBLE; null when nothing was counted."""
    return total.cast("double") / F.nullif(count, F.lit(0)).cast("double")
