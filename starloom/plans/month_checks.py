"""Rules on the stored sales, their results kept by month, so that a load checks only the months it has written.

A stored result names the folder of the month it was taken from. Where that is no longer the live one, or the rules
differ, the month is checked again, whichever load wrote it. Whether a key is unique is counted across all months that
are checked together. A key cannot be both in one of these and in an older month: the key index names one month
for each key of a batch, and a load rewrites that month too. `warehouse.check_load` checks all sales regardless.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.operators import quality
from starloom.operators.quality import Rule
from starloom.session import stage
from starloom.sinks.generations import Generation, Load, read_parts
from starloom.sinks.upsert import FACT, MONTH, read_facts

CHECKS = "controles_ventes"
RULES = tuple(dict.fromkeys((*quality.LOAD_RULES[FACT], *quality.CONSTRAINTS[FACT])))
_RESULT = f"{MONTH} int, jeton string, cle string, regle string, colonne string, evalues long, echecs long"


def update_checks(load: Load, rules: Sequence[Rule] = RULES) -> list[int]:
    """Check the months of a load whose results are not those of their live folder; returns these months."""
    live = load.next.parts.get(FACT, {})
    known = _known(load)
    asked = {repr(rule) for rule in rules}
    stale = sorted(month for month, folder in live.items() if known.get(month) != (folder, asked))
    gone = sorted(known.keys() - live.keys())
    if stale or gone:
        sales = read_facts(load.spark, load.root, load.next, stale) if stale else None
        results = load.spark.createDataFrame([], _RESULT) if sales is None else check_months(sales, rules, live)
        load.rewrite(CHECKS, results, MONTH, [*stale, *gone])
    return stale


def _known(load: Load) -> dict[int, tuple[str, set[str]]]:
    """For each month with stored results the folder they are of, and the rules."""
    stored = read_parts(load.spark, load.root, load.next, CHECKS, MONTH)
    if stored is None:
        return {}
    rows = stored.groupBy(MONTH).agg(F.min("jeton").alias("jeton"), F.collect_set("cle").alias("cles")).collect()  # one row a month
    return {r[MONTH]: (r.jeton, set(r.cles)) for r in rows}


def check_months(sales: DataFrame, rules: Sequence[Rule], folders: Mapping[int, str]) -> DataFrame:
    """One row per month and rule. All counts but those of repeated values share one aggregation."""
    aggregates = []
    for i, rule in enumerate(rules):
        aggregates.append(rule.judged().alias(f"n{i}"))
        if rule.kind != "unique":
            aggregates.append(F.count_if(rule.broken()).alias(f"e{i}"))
    found = sales.groupBy(MONTH).agg(*aggregates)
    for i, rule in enumerate(rules):
        if rule.kind == "unique":
            repeated = _repeated(sales, rule.column, f"e{i}")
            found = found.join(F.broadcast(repeated), MONTH, "left").fillna(0, [f"e{i}"])  # a row a month
    lines = [
        F.struct(
            F.lit(repr(rule)).alias("cle"), F.lit(rule.kind).alias("regle"), F.lit(rule.column).alias("colonne"),
            F.col(f"n{i}").alias("evalues"), F.col(f"e{i}").alias("echecs"),
        )
        for i, rule in enumerate(rules)
    ]
    tokens = F.create_map(*[F.lit(value) for pair in sorted(folders.items()) for value in pair])
    return found.select(MONTH, tokens[F.col(MONTH)].alias("jeton"), F.inline(F.array(*lines)))


def _repeated(sales: DataFrame, column: str, name: str) -> DataFrame:
    """By month the rows whose value occurs again in any of the months.

    The values are counted first, combined before the shuffle; only where some repeat, their months are looked up.
    """
    given = sales.filter(F.col(column).isNotNull())
    often = stage(given.groupBy(column).agg(F.count("*").alias("n")).filter("n > 1").select(column), "repetes")
    if often.isEmpty():
        return sales.sparkSession.createDataFrame([], f"{MONTH} int, {name} long")
    by_month = given.groupBy(column, MONTH).agg(F.count("*").alias(name)).join(often, column, "left_semi")
    return by_month.groupBy(MONTH).agg(F.sum(name).alias(name))


def results_by_month(spark: SparkSession, root: str, held: Generation) -> DataFrame:
    """(annee_mois, regle, colonne, evalues, echecs, cle) of a generation."""
    stored = read_parts(spark, root, held, CHECKS, MONTH)
    return (spark.createDataFrame([], _RESULT) if stored is None else stored).drop("jeton")


def sales_report(spark: SparkSession, root: str, held: Generation, rules: Sequence[Rule] = RULES) -> DataFrame:
    """The stored results of all months together, as quality.check_table gives them for the whole fact."""
    asked = results_by_month(spark, root, held).filter(F.col("cle").isin([repr(rule) for rule in rules]))
    return asked.groupBy("cle", "regle", "colonne").agg(F.sum("evalues").alias("evalues"), F.sum("echecs").alias("echecs")).select(
        F.lit(FACT).alias("table_name"), "regle", "colonne", "evalues", "echecs", (F.col("echecs") == 0).alias("succes")
    )
