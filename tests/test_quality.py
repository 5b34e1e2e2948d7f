import pytest

from starloom.operators import quality as q
from starloom.plans import integrity


@pytest.fixture
def clients(frame):
    return frame("sk int, nk string, seg string, n int", (1, "a", "Gold", 5), (2, None, "Or", -1), (2, "c", None, None))


def test_rules(clients):
    rules = [q.not_null("nk"), q.unique("sk"), q.in_set("seg", ("Gold",)), q.between("n", low=0), q.unique("nk"), q.between("n", 0, 4), *q.max_length(seg=3)]
    got = {(r.regle, r.colonne, r.evalues, r.echecs, r.succes) for r in q.check_table(clients, "t", rules).collect()}
    assert got == {
        ("not_null", "nk", 3, 1, False), ("unique", "sk", 3, 2, False), ("in_set", "seg", 2, 1, False),
        ("between", "n", 2, 1, False), ("unique", "nk", 2, 0, True), ("between", "n", 2, 2, False),
        ("max_length", "seg", 2, 1, False),
    }


def test_empty_tables_pass(clients):
    report = q.check_table(clients.limit(0), "t", [q.not_null("nk"), q.unique("sk")])
    assert [r.succes for r in report.collect()] == [True, True]


def test_failed_rules_stop_a_run(clients):
    q.require(q.check_table(clients, "t", [q.unique("nk")]))
    with pytest.raises(q.QualityError, match="t.sk unique: 2 of 3"):
        q.require(q.check_table(clients, "t", [q.unique("sk")]))


def test_scores_and_missing_tables(clients):
    rules = {"t": [q.not_null("nk"), q.unique("nk")], "absent": [q.not_null("x")]}
    scores = q.table_scores(q.check_star({"t": clients}, rules)).collect()
    assert [(r.table_name, r.regles_ok, r.regles, r.succes) for r in scores] == [("t", 1, 2, False)]
    with pytest.raises(ValueError):
        q.check_star({"t": clients.limit(0)}, rules, skip_empty=True)


def test_orphans_and_conflicts(frame):
    fact = frame("id_date int, id_produit int, id_client int, id_region int, id_livreur int",
                 (1, 1, 1, 1, 1), (2, 9, 1, None, 1), (2, 9, 1, 1, 1))
    star = {
        "fait_ventes": fact,
        "dim_temps": frame("id_date int", (1,)),
        "dim_produit": frame("id_produit_sk int, id_produit_nk string, est_actif boolean", (1, "p", True), (2, "p", True), (3, "r", False)),
        "dim_client": frame("id_client_sk int, id_client_nk string, est_actif boolean", (1, "c", True), (2, "c", False)),
        "dim_region": frame("id_region int", (1,)),
        "dim_livreur": frame("id_livreur int", (1,)),
    }
    orphans = {r.check_name: r.nb_orphelines for r in integrity.orphan_keys(star).collect()}
    assert orphans == {"fait -> dim_temps": 2, "fait -> dim_produit": 2, "fait -> dim_client": 0, "fait -> dim_region": 1,
                       "fait -> dim_livreur": 0}
    conflicts = [r.nb_anomalies for r in integrity.active_version_conflicts(star).collect()]
    assert conflicts == [1, 0]


def test_figures_for_display(frame):
    from pyspark.sql import functions as F

    df = frame("kpi string, valeur double", ("CA Total TTC (livrées)", 1234567.891), ("Nb clients distincts (faits)", 12.0),
               ("Taux de retour global", 51.9))
    assert [r[0] for r in df.select(integrity.show_figure(F.col("kpi"), F.col("valeur"))).collect()] == [
        "1,234,567.89 MAD", "12", "51.90%",
    ]
