"""Results of rules kept by month, against a check of all sales."""

from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starloom import schemas
from starloom.operators import quality
from starloom.plans import month_checks
from starloom.sinks import generations
from starloom.sinks.upsert import FACT, MONTH, merge_facts, read_facts, upsert_facts

T0 = datetime(2026, 6, 1)


def sales(spark, *rows):
    full = [(k, d, 1, 1, 1, 1, q, Decimal(q), Decimal(q), None, None, Decimal(0), "livré") for k, d, q in rows]
    return spark.createDataFrame(full, schemas.TABLES[FACT])


def load(spark, root, *rows, rules=month_checks.RULES):
    new = generations.Load(spark, root)
    if rows:
        merge_facts(new, sales(spark, *rows), T0)
    checked = month_checks.update_checks(new, rules)
    new.publish(T0)
    return new, checked


def lines(df):
    return sorted((r.table_name, r.regle, r.colonne, r.evalues, r.echecs, r.succes) for r in df.collect())


def agree(spark, root, rules=month_checks.RULES):
    held = generations.current(spark, root)
    whole = quality.check_table(read_facts(spark, root, held), FACT, rules)
    stored = month_checks.sales_report(spark, root, held, rules)
    assert lines(stored) == lines(whole)
    return {(r.regle, r.colonne): (r.evalues, r.echecs) for r in stored.collect()}


def test_only_written_months_are_read(spark, tmp_path, monkeypatch):
    root, asked = str(tmp_path), []
    whole = month_checks.read_facts
    monkeypatch.setattr(month_checks, "read_facts", lambda s, r, h, months: asked.append(list(months)) or whole(s, r, h, months))
    one, checked = load(spark, root, ("a", 20240105, 1), ("b", 20240206, 2), ("c", 20240307, 3))
    assert checked == [202401, 202402, 202403]
    # b moves to the fourth month; the second one ends.
    two, checked = load(spark, root, ("b", 20240406, 2), ("d", 20240107, 9))
    assert checked == [202401, 202404] and asked == [[202401, 202402, 202403], [202401, 202404]]
    assert two.next.parts[month_checks.CHECKS] == {202401: two.token, 202403: one.token, 202404: two.token}
    assert agree(spark, root)[("unique", "id_commande")] == (4, 0)
    # Nothing was written: nothing is read.
    assert load(spark, root)[1] == [] and len(asked) == 2


def test_months_written_without_a_check_are_checked_later(spark, tmp_path):
    root = str(tmp_path)
    load(spark, root, ("a", 20240105, 1), ("b", 20240206, 2))
    upsert_facts(sales(spark, ("e", 20240207, 7)), root, T0)
    assert load(spark, root, ("f", 20240501, 1))[1] == [202402, 202405]
    agree(spark, root)


def test_other_rules_check_all_months_again(spark, tmp_path):
    root = str(tmp_path)
    load(spark, root, ("a", 20240105, 1), ("b", 20240206, 20))
    rules = (*month_checks.RULES, quality.between("quantite_vendue", high=10))
    assert load(spark, root, rules=rules)[1] == [202401, 202402]
    held = generations.current(spark, root)
    broken = month_checks.results_by_month(spark, root, held).filter("echecs > 0").collect()
    assert [(r[MONTH], r.regle, r.colonne, r.evalues, r.echecs) for r in broken] == [(202402, "between", "quantite_vendue", 1, 1)]


@pytest.mark.parametrize("rows, failures", [([("a", 1), ("a", 1), ("b", 1)], {1: 2}), ([("a", 1), ("a", 2), ("a", 2), ("b", 2)], {1: 1, 2: 2}), ([(None, 1), (None, 1)], {})])
def test_repeated_keys_count_in_each_month(frame, rows, failures):
    stored = frame(f"id_commande string, {MONTH} int", *rows)
    found = month_checks.check_months(stored, (quality.unique("id_commande"),), {1: "t", 2: "u"}).collect()
    assert {r[MONTH]: r.echecs for r in found if r.echecs} == failures
    total = quality.check_table(stored, FACT, (quality.unique("id_commande"),)).collect()[0]
    assert (sum(r.evalues for r in found), sum(r.echecs for r in found)) == (total.evalues, total.echecs)


def test_no_sales(spark, tmp_path):
    new, checked = load(spark, str(tmp_path))
    assert checked == [] and month_checks.sales_report(spark, str(tmp_path), new.next).isEmpty()
    assert month_checks.results_by_month(spark, str(tmp_path), new.next).filter(F.lit(True)).isEmpty()


def test_months_of_values_are_looked_up_only_where_some_repeat(spark, monkeypatch):
    staged, plain = [], month_checks.stage
    monkeypatch.setattr(month_checks, "stage", lambda df, name: staged.append(plain(df, name)) or staged[-1])
    keyed = lambda *rows: spark.createDataFrame(rows, f"id_commande string, {MONTH} int")
    apart = month_checks._repeated(keyed(("a", 202401), ("b", 202402), (None, 202402), (None, 202402)), "id_commande", "e0")
    assert "Aggregate" not in apart._jdf.queryExecution().optimizedPlan().toString() and apart.count() == 0
    twice = keyed(("a", 202401), ("a", 202402), ("a", 202402), ("b", 202402), ("c", 202403), (None, 202403), (None, 202403))
    found = month_checks._repeated(twice, "id_commande", "e0")
    assert sorted(tuple(r) for r in found.collect()) == [(202401, 1), (202402, 2)]
    assert [df.count() for df in staged] == [0, 1]
