"""Cleaning rules for raw clients."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.functions.dates import parse_date
from starloom.functions.text import map_code, match_key
from starloom.operators.cities import harmonize_city
from starloom.operators.latest import keep_latest
from starloom.schemas import ARRIVAL
from starloom.settings import AGE_BANDS, EMAIL_PATTERN, SEX_CODES, UNKNOWN_SEX, Settings


def by_email(df: DataFrame) -> tuple[DataFrame, list[Column]]:
    """Clients with readable sign-up dates and normalized e-mails, and what the newest of them has most of."""
    dated = df.withColumn("date_inscription", parse_date(F.col("date_inscription")))
    newest = [F.col(c) for c in ("date_inscription", "id_client", ARRIVAL) if c in df.columns]
    return dated.withColumn("email_norm", match_key(F.col("email"))), newest


def latest_by_email(df: DataFrame) -> DataFrame:
    """Rule 1: one client per normalized e-mail, the most recent sign-up; unreadable dates lose."""
    normalized, newest = by_email(df)
    return keep_latest(normalized, ["email_norm"], [column.desc_nulls_last() for column in newest])


def standardize_sex(df: DataFrame) -> DataFrame:
    """Rule 2: three code systems to m, f or unknown."""
    return df.withColumn("sexe", map_code(match_key(F.col("sexe")), SEX_CODES, UNKNOWN_SEX))


def validate_birth_date(df: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Rule 3: birth dates outside the accepted ages become null; adds age and age band."""
    born = parse_date(F.col("date_naissance"))
    aged = df.withColumn("date_naissance", born).withColumn(
        "age", F.datediff(F.lit(settings.as_of), "date_naissance") / F.lit(365.25)
    )
    valid = F.col("age").between(settings.min_age, settings.max_age)
    kept = {c: F.when(valid, F.col(c)) for c in ("date_naissance", "age")}
    return aged.withColumns(kept).withColumn("tranche_age", age_band(F.col("age")))


def age_band(age: Column) -> Column:
    """Left-closed bands. A missing age counts as 0 and so falls in the first one."""
    known = F.coalesce(age, F.lit(0.0))
    band = F
    for upper, label in AGE_BANDS:
        band = band.otherwise(F.lit(label)) if upper is None else band.when(known < upper, label)
    return band


def validate_email(df: DataFrame) -> DataFrame:
    """Rule 4: malformed e-mails become null, the client stays."""
    return df.withColumn("email", F.when(F.col("email").rlike(EMAIL_PATTERN), F.col("email")))


def standardize_home_city(df: DataFrame, lookup: DataFrame) -> DataFrame:
    """Rule 5: home city by the city lookup."""
    return harmonize_city(df, "ville", lookup)


def clean_clients(raw: DataFrame, lookup: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """All five rules in order; e-mails are compared before they are validated."""
    return (
        raw.transform(latest_by_email)
        .transform(standardize_sex)
        .transform(validate_birth_date, settings)
        .transform(validate_email)
        .transform(standardize_home_city, lookup)
    )
