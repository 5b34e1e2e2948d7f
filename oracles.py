"""DuckDB statements that compute the same results as the Spark queries.

Each statement is assembled from named common table expressions; only those a
statement mentions, directly or through others, are put in front of it.
"""

from __future__ import annotations

import re

from starloom.settings import AGE_BANDS, CITY_EXTRAS, DAY_NAMES, HOLIDAYS, MONTH_NAMES, RAMADAN, TRANSPORTS, ZONES


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _list(values) -> str:
    return "[" + ", ".join(_text(v) for v in values) + "]"


def _date(column: str) -> str:
    formats = ("%Y-%m-%d", "%d/%m/%Y", "%b %d %Y")
    return "CAST(coalesce(" + ", ".join(f"try_strptime({column}, '{f}')" for f in formats) + ") AS DATE)"


def _title(column: str) -> str:
    return (
        f"array_to_string(list_transform(regexp_extract_all({column}, '(\\p{{L}}+|[^\\p{{L}}]+)'), "
        "lambda t: upper(t[1]) || lower(t[2:])), '')"
    )


def _percent(part: str, whole: str, digits: int) -> str:
    """Exact half-up 100*part/whole for whole numbers of one unit, part of any sign."""
    p, w, scale = f"CAST({part} AS HUGEINT)", f"CAST({whole} AS HUGEINT)", 10**digits
    return (
        f"CASE WHEN {whole} = 0 THEN NULL ELSE CAST(sign({part}) AS DOUBLE) * "
        f"CAST((abs({p}) * {200 * scale} + {w}) // (2 * {w}) AS DOUBLE) / {scale}.0 END"
    )


def _cents(amount: str) -> str:
    return f"CAST({amount} * 100 AS HUGEINT)"


def _key(day: str) -> str:
    return f"CAST(strftime({day}, '%Y%m%d') AS INTEGER)"


_STATUS = """CASE WHEN statut IN ('livré', 'livre', 'LIVRE', 'DONE') THEN 'livré'
    WHEN statut IN ('annulé', 'annule', 'KO') THEN 'annulé'
    WHEN statut IN ('en_cours', 'OK') THEN 'en_cours'
    WHEN statut IN ('retourné', 'retourne') THEN 'retourné' ELSE 'inconnu' END"""
_SEX = """CASE WHEN lower(trim(sexe)) IN ('m', 'male', 'homme', 'h', '1') THEN 'm'
    WHEN lower(trim(sexe)) IN ('f', 'female', 'femme', '0') THEN 'f' ELSE 'inconnu' END"""
_EMAIL = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"
_AGE = "date_diff('day', naissance, DATE '2026-06-01') / 365.25"
_BAND = (
    "CASE "
    + " ".join(f"WHEN coalesce(age, 0) < {top} THEN '{label}'" for top, label in AGE_BANDS if top)
    + f" ELSE '{AGE_BANDS[-1][1]}' END"
)
_ALERT = "CASE WHEN taux > 54 THEN 'rouge' WHEN taux > 50 THEN 'orange' ELSE 'vert' END"
_TRACKED = ("nom_complet", "tranche_age", "sexe", "ville", "region_admin", "segment_client", "canal_acquisition")


def _segments(gold: int, silver: int) -> str:
    return f"""SELECT id_client, CASE WHEN ca >= {gold} THEN 'Gold' WHEN ca >= {silver} THEN 'Silver' ELSE 'Bronze' END AS segment_client,
      ca AS ca_12m
    FROM (SELECT id_client, sum(montant_ttc) AS ca FROM commandes
          WHERE statut = 'livré' AND date_commande >= (SELECT max(date_commande) FROM commandes) - INTERVAL 365 DAY
          GROUP BY id_client)"""


def _client_dimension(segments: str) -> str:
    return f"""SELECT CAST(row_number() OVER (ORDER BY date_inscription NULLS LAST, c.id_client) AS BIGINT) AS id_client_sk,
      c.id_client AS id_client_nk, {_title("trim(prenom) || ' ' || trim(nom)")} AS nom_complet, tranche_age, sexe, c.ville,
      coalesce(r.region_admin, 'Non renseignée') AS region_admin,
      coalesce(s.segment_client, 'Bronze') AS segment_client, canal_acquisition,
      DATE '2026-06-01' AS date_debut, DATE '9999-12-31' AS date_fin, true AS est_actif
    FROM clients c LEFT JOIN {segments} s ON s.id_client = c.id_client
    LEFT JOIN raw_regions r ON r.nom_ville_standard = c.ville"""


_CTES = {
    "raw_commandes": """SELECT concat('ORD', l_orderkey, '-', l_linenumber) AS id_commande,
      concat('C', o_custkey) AS id_client,
      concat(CASE WHEN l_partkey % 50 = 49 THEN 'X' ELSE 'P' END, l_partkey) AS id_produit,
      CASE WHEN l_orderkey % 20 < 8 THEN strftime(o_orderdate + INTERVAL 25 YEAR, '%Y-%m-%d')
           WHEN l_orderkey % 20 < 16 THEN strftime(o_orderdate + INTERVAL 25 YEAR, '%d/%m/%Y')
           WHEN l_orderkey % 20 < 19 THEN strftime(o_orderdate + INTERVAL 25 YEAR, '%b %d %Y')
           ELSE 'pas-une-date' END AS date_commande,
      CAST(CASE WHEN (l_orderkey + l_partkey) % 100 = 0 THEN -1 ELSE 1 END * CAST(l_quantity AS INTEGER) AS VARCHAR) AS quantite,
      CASE WHEN (l_partkey + l_suppkey) % 200 = 0 THEN '0'
           ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS prix_unitaire,
      CASE WHEN l_returnflag = 'R' THEN ['retourné', 'retourne'][l_linenumber % 2 + 1]
           WHEN l_returnflag = 'A' AND l_linestatus = 'F' THEN ['livré', 'livre', 'LIVRE', 'DONE'][l_linenumber % 4 + 1]
           WHEN l_returnflag = 'A' THEN ['OK', 'en_cours'][l_linenumber % 2 + 1]
           WHEN l_linestatus = 'F' THEN ['annulé', 'annule', 'KO'][l_linenumber % 3 + 1]
           WHEN l_linenumber = 7 THEN 'xyz' ELSE 'livre' END AS statut,
      CASE l_partkey % 4 WHEN 0 THEN upper(n_name) WHEN 1 THEN lower(n_name) WHEN 2 THEN ' ' || n_name || ' '
           ELSE CASE WHEN l_partkey % 16 = 3 THEN 'VilleXYZ' ELSE n_name END END AS ville_livraison,
      o_orderpriority AS mode_paiement,
      CASE WHEN l_orderkey % 14 = 0 THEN '' ELSE concat('L', l_suppkey) END AS id_livreur,
      CASE WHEN l_returnflag = 'R' OR (l_returnflag = 'A' AND l_linestatus = 'F') OR (l_returnflag = 'N' AND l_linestatus = 'O')
           THEN strftime(l_shipdate + INTERVAL 25 YEAR, '%Y-%m-%d') ELSE '' END AS date_livraison,
      l_shipdate, l_partkey, l_suppkey
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
    JOIN nation ON c_nationkey = n_nationkey""",
    "raw_clients": """SELECT concat('C', c_custkey) AS id_client, c_name AS nom, concat(' el-', lower(c_mktsegment)) AS prenom,
      CASE WHEN c_custkey % 50 = 0 THEN concat(lower(c_mktsegment), c_custkey % 1400)
           ELSE concat(upper(c_mktsegment[1]), lower(c_mktsegment[2:]), '.', c_custkey % 1400, '@mail.com',
                       CASE WHEN c_custkey % 11 = 0 THEN ' ' ELSE '' END) END AS email,
      CASE WHEN c_custkey % 40 = 0 THEN 'pas-une-date'
           ELSE strftime(DATE '1915-01-01' + CAST((c_custkey * 7919) % 40000 AS INTEGER), '%Y-%m-%d') END AS date_naissance,
      ['m', 'F', '1', '0', 'Homme', 'Femme', ' male', 'xyz', 'h'][c_custkey % 9 + 1] AS sexe,
      CASE c_custkey % 4 WHEN 0 THEN upper(n_name) WHEN 1 THEN lower(n_name) WHEN 2 THEN ' ' || n_name || ' '
           ELSE CASE WHEN c_custkey % 16 = 3 THEN 'VilleXYZ' ELSE n_name END END AS ville,
      '' AS telephone,
      CASE c_custkey % 3 WHEN 0 THEN strftime(DATE '2020-01-01' + CAST((c_custkey * 31) % 1600 AS INTEGER), '%Y-%m-%d')
           WHEN 1 THEN strftime(DATE '2020-01-01' + CAST((c_custkey * 31) % 1600 AS INTEGER), '%d/%m/%Y')
           ELSE strftime(DATE '2020-01-01' + CAST((c_custkey * 31) % 1600 AS INTEGER), '%b %d %Y') END AS date_inscription,
      c_mktsegment AS canal_acquisition
    FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "raw_produits": """SELECT concat('P', p_partkey) AS id_produit, p_name AS nom,
      CASE p_partkey % 3 WHEN 0 THEN upper(p_type) WHEN 1 THEN lower(p_type) ELSE ' ' || p_type || ' ' END AS categorie,
      p_name AS sous_categorie, ' ' || p_brand || ' ' AS marque, ' Fournisseur ' || p_brand AS fournisseur,
      CASE WHEN p_partkey % 20 = 0 THEN NULL ELSE p_retailprice END AS prix_catalogue,
      concat('Pays ', p_size) AS origine_pays, '' AS date_creation, p_partkey % 7 <> 0 AS actif, p_partkey
    FROM part""",
    "raw_regions": """SELECT concat('N', n_nationkey) AS code_ville, n_name AS nom_ville_standard,
      'Province ' || n_name AS province, r_name AS region_admin, r_name AS zone_geo, n_nationkey
    FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "extras": "SELECT * FROM (VALUES " + ", ".join(f"({_text(k)}, {_text(v)})" for k, v in CITY_EXTRAS.items()) + ") e(variante, ville)",
    "villes": f"""SELECT variante, ville FROM extras UNION ALL
    SELECT variante, arg_max(ville, n_nationkey) AS ville FROM (
      SELECT trim(nom_ville_standard) AS ville, n_nationkey, unnest([trim(nom_ville_standard), lower(trim(nom_ville_standard)),
        upper(trim(nom_ville_standard)), {_title("trim(nom_ville_standard)")}, lower(trim(code_ville)), upper(trim(code_ville))]) AS variante
      FROM raw_regions) WHERE variante NOT IN (SELECT variante FROM extras) GROUP BY variante""",
    "dernieres": """SELECT * FROM raw_commandes QUALIFY row_number() OVER (
      PARTITION BY id_commande ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC) = 1""",
    "datees": f"""SELECT * REPLACE ({_date("date_commande")} AS date_commande, {_date("date_livraison")} AS date_livraison)
    FROM dernieres WHERE {_date("date_commande")} IS NOT NULL""",
    "chiffrees": f"""SELECT id_commande, id_client, id_produit, date_commande, CAST(quantite AS DECIMAL(18,4)) AS quantite,
      CAST(prix_unitaire AS DECIMAL(18,4)) AS prix_unitaire, {_STATUS} AS statut,
      coalesce(v.ville, 'Non renseignée') AS ville_livraison, mode_paiement,
      CASE WHEN id_livreur = '' THEN '-1' ELSE id_livreur END AS id_livreur, date_livraison,
      round(CAST(quantite AS INTEGER) * CAST(prix_unitaire AS DECIMAL(12,2)), 2) AS montant_ht
    FROM datees LEFT JOIN villes v ON v.variante = lower(trim(ville_livraison))
    WHERE CAST(quantite AS INTEGER) > 0 AND CAST(prix_unitaire AS DECIMAL(12,2)) > 0""",
    "commandes": """SELECT *, round(montant_ht * 1.20, 2) AS montant_ttc,
      CASE WHEN statut IN ('livré', 'retourné') AND date_diff('day', date_commande, date_livraison) BETWEEN 0 AND 60
           THEN CAST(date_diff('day', date_commande, date_livraison) AS INTEGER) END AS delai_livraison_jours
    FROM chiffrees""",
    "clients_uniques": f"""SELECT * REPLACE ({_date("date_inscription")} AS date_inscription),
      lower(trim(email)) AS email_norm FROM raw_clients
    QUALIFY row_number() OVER (PARTITION BY lower(trim(email))
      ORDER BY {_date("date_inscription")} DESC NULLS LAST, id_client DESC) = 1""",
    "clients_ages": f"""SELECT *, CASE WHEN {_AGE} BETWEEN 16 AND 100 THEN {_AGE} END AS age,
      CASE WHEN {_AGE} BETWEEN 16 AND 100 THEN naissance END AS naissance_valide
    FROM (SELECT *, {_date("date_naissance")} AS naissance FROM clients_uniques)""",
    "clients": f"""SELECT id_client, nom, prenom, CASE WHEN regexp_matches(email, '{_EMAIL}') THEN email END AS email,
      naissance_valide AS date_naissance, {_SEX} AS sexe, coalesce(v.ville, 'Non renseignée') AS ville, telephone,
      date_inscription, canal_acquisition, email_norm, CAST(age AS DOUBLE) AS age, {_BAND} AS tranche_age
    FROM clients_ages c LEFT JOIN villes v ON v.variante = lower(trim(c.ville))""",
    "clients_1": """SELECT id_client FROM (SELECT * FROM raw_clients WHERE length(id_client) % 2 = 0)
    QUALIFY row_number() OVER (PARTITION BY lower(trim(email)) ORDER BY PLACEHOLDER DESC NULLS LAST, id_client DESC) = 1""".replace(
        "PLACEHOLDER", _date("date_inscription")
    ),
    "clients_2": "SELECT id_client FROM clients_1 UNION SELECT id_client FROM clients",
    "produits": f"""SELECT id_produit, nom, {_title("trim(categorie)")} AS categorie, {_title("trim(sous_categorie)")} AS sous_categorie,
      trim(marque) AS marque, trim(fournisseur) AS fournisseur,
      coalesce(CAST(prix_catalogue AS DECIMAL(10,2)), -1) AS prix_catalogue, origine_pays, date_creation, actif, p_partkey
    FROM raw_produits""",
    "segments": _segments(6000000, 2000000),
    "segments_bas": _segments(3000000, 1000000),
    "segments_hauts": _segments(12000000, 4000000),
    "etats_clients": " UNION ALL ".join(
        f"""SELECT c.id_client AS cle, DATE '{day}' AS jour, coalesce(s.segment_client, 'Bronze') AS valeur, c.ville
        FROM clients c LEFT JOIN {limits} s ON s.id_client = c.id_client WHERE {when}"""
        for day, limits, when in (
            ("2021-01-01", "segments", "c.date_inscription < DATE '2022-01-01'"),
            ("2022-07-01", "segments_hauts", "true"),
            ("2024-01-01", "segments_bas", "true"),
        )
    ),
    "etats_produits": "SELECT id_produit AS cle, d.jour, categorie || CASE WHEN length(nom) % d.n = 0 THEN d.fin ELSE '' END AS valeur, '' AS ville "
    "FROM produits, (VALUES (DATE '2021-01-01', 1, ''), (DATE '2022-07-01', 2, ' Ter'), (DATE '2024-01-01', 3, ' Bis')) d(jour, n, fin)",
    **{
        f"versions_{name}": f"""SELECT cle, valeur, ville, jour AS debut,
          coalesce(lead(jour) OVER (PARTITION BY cle ORDER BY jour) - 1, DATE '9999-12-31') AS fin,
          CASE WHEN row_number() OVER (PARTITION BY cle ORDER BY jour) = 1 THEN DATE '0001-01-01' ELSE jour END AS des
        FROM (SELECT * FROM etats_{name} QUALIFY lag(valeur) OVER (PARTITION BY cle ORDER BY jour) IS DISTINCT FROM valeur)"""
        for name in ("clients", "produits")
    },
    "dim_temps": f"""SELECT {_key("j")} AS id_date, CAST(day(j) AS INTEGER) AS jour, CAST(month(j) AS INTEGER) AS mois,
      CAST(quarter(j) AS INTEGER) AS trimestre, CAST(year(j) AS INTEGER) AS annee, CAST(weekofyear(j) AS INTEGER) AS semaine,
      {_list(DAY_NAMES)}[isodow(j)] AS libelle_jour, {_list(MONTH_NAMES)}[month(j)] AS libelle_mois,
      isodow(j) >= 6 AS est_weekend, strftime(j, '%Y-%m-%d') IN ({", ".join(_text(h) for h in HOLIDAYS)}) AS est_ferie_maroc,
      {" OR ".join(f"j BETWEEN DATE '{a}' AND DATE '{b}'" for a, b in RAMADAN)} AS periode_ramadan
    FROM (SELECT CAST(unnest(generate_series(DATE '2020-01-01', DATE '2025-12-31', INTERVAL 1 DAY)) AS DATE) AS j)""",
    "dim_produit": """SELECT CAST(row_number() OVER (ORDER BY p_partkey) AS BIGINT) AS id_produit_sk, id_produit AS id_produit_nk,
      nom AS nom_produit, categorie, sous_categorie, marque, fournisseur, prix_catalogue AS prix_standard, origine_pays,
      DATE '2026-06-01' AS date_debut, DATE '9999-12-31' AS date_fin, true AS est_actif FROM produits""",
    "dim_region": """SELECT CAST(row_number() OVER (ORDER BY n_nationkey) AS BIGINT) AS id_region, trim(nom_ville_standard) AS ville,
      province, region_admin, zone_geo, 'Maroc' AS pays FROM raw_regions""",
    "dim_client": _client_dimension("segments"),
    "dim_client_neuf": _client_dimension("segments_bas"),
    "dim_livreur": f"""SELECT id_livreur, nk AS id_livreur_nk,
      CASE WHEN nk = '-1' THEN 'Livreur inconnu' ELSE 'Livreur ' || nk END AS nom_livreur,
      CASE WHEN nk = '-1' THEN 'Inconnu' ELSE {_list(TRANSPORTS)}[id_livreur % 3 + 1] END AS type_transport,
      CASE WHEN nk = '-1' THEN 'Inconnue' ELSE {_list(ZONES)}[id_livreur % 7 + 1] END AS zone_couverture
    FROM (SELECT nk, CAST(row_number() OVER (ORDER BY nk) AS BIGINT) AS id_livreur
          FROM (SELECT id_livreur AS nk FROM commandes UNION SELECT '-1'))""",
    "fait": f"""SELECT c.id_commande, {_key("c.date_commande")} AS id_date, coalesce(p.id_produit_sk, 1) AS id_produit,
      coalesce(k.id_client_sk, 1) AS id_client, coalesce(r.id_region, 1) AS id_region,
      coalesce(l.id_livreur, (SELECT id_livreur FROM dim_livreur WHERE id_livreur_nk = '-1')) AS id_livreur,
      CAST(trunc(c.quantite) AS INTEGER) AS quantite_vendue, c.montant_ht, c.montant_ttc, c.delai_livraison_jours,
      c.statut AS statut_commande
    FROM commandes c LEFT JOIN dim_produit p ON p.id_produit_nk = c.id_produit
    LEFT JOIN dim_client k ON k.id_client_nk = c.id_client LEFT JOIN dim_region r ON r.ville = c.ville_livraison
    LEFT JOIN dim_livreur l ON l.id_livreur_nk = c.id_livreur""",
    "ca_mensuel": """SELECT annee, mois, trimestre, libelle_mois, periode_ramadan, region_admin, zone_geo, ville, categorie,
      sum(montant_ttc) AS ca_ttc, sum(montant_ht) AS ca_ht, CAST(sum(quantite_vendue) AS BIGINT) AS volume_vendu,
      count(DISTINCT id_client) AS nb_clients_actifs, count(DISTINCT id_commande) AS nb_commandes
    FROM fait f JOIN dim_temps t USING (id_date) JOIN dim_region r USING (id_region)
    JOIN dim_produit p ON p.id_produit_sk = f.id_produit WHERE statut_commande = 'livré' GROUP BY ALL""",
    "top_produits": """SELECT annee, trimestre, ville, id_produit_sk, nom_produit, categorie, marque,
      CAST(sum(quantite_vendue) AS BIGINT) AS qte_totale, sum(montant_ttc) AS ca_total,
      count(DISTINCT id_client) AS nb_clients_distincts,
      CAST(rank() OVER (PARTITION BY annee, trimestre, ville, categorie ORDER BY sum(montant_ttc) DESC) AS INTEGER) AS rang_dans_categorie,
      CAST(rank() OVER (PARTITION BY annee, trimestre, ville ORDER BY sum(montant_ttc) DESC) AS INTEGER) AS rang_global
    FROM fait f JOIN dim_temps t USING (id_date) JOIN dim_region r USING (id_region)
    JOIN dim_produit p ON p.id_produit_sk = f.id_produit WHERE statut_commande = 'livré'
    GROUP BY annee, trimestre, ville, id_produit_sk, nom_produit, categorie, marque""",
    "taux_retour": f"""SELECT annee, trimestre, categorie, sous_categorie, nb_livrees, nb_retournees,
      {_percent("nb_retournees", "(nb_livrees + nb_retournees)", 2)} AS taux
    FROM (SELECT annee, trimestre, categorie, sous_categorie,
            count(*) FILTER (WHERE statut_commande = 'livré') AS nb_livrees,
            count(*) FILTER (WHERE statut_commande = 'retourné') AS nb_retournees
          FROM fait f JOIN dim_temps t USING (id_date) JOIN dim_produit p ON p.id_produit_sk = f.id_produit
          WHERE statut_commande IN ('livré', 'retourné') GROUP BY ALL)""",
    "alimentation": """SELECT periode_ramadan, annee, mois, libelle_mois, CAST(sum(volume_vendu) AS BIGINT) AS volume_vendu,
      sum(ca_ttc) AS ca FROM ca_mensuel WHERE categorie = 'Economy' GROUP BY ALL""",
    "apres_lot": """SELECT * REPLACE (
        CASE WHEN id_date >= 20250101 AND statut_commande = 'inconnu' THEN 20251201 ELSE id_date END AS id_date,
        CASE WHEN id_date >= 20250101 AND statut_commande = 'en_cours' THEN 'livré' ELSE statut_commande END AS statut_commande),
      CASE WHEN id_date < 20250701 THEN DATE '2026-06-01' ELSE DATE '2026-06-02' END AS date_chargement
    FROM fait""",
}

# The order rules over the lines of one batch of a stream; the first batch leaves couriers with even numbers out.
for _batch, _when in ((1, "l_shipdate < DATE '1998-07-01'"), (2, "l_shipdate >= DATE '1998-07-01'")):
    _CTES[f"dernieres_{_batch}"] = _CTES["dernieres"].replace("FROM raw_commandes", f"FROM raw_commandes WHERE {_when}")
    _CTES[f"datees_{_batch}"] = _CTES["datees"].replace("FROM dernieres", f"FROM dernieres_{_batch}")
    _CTES[f"chiffrees_{_batch}"] = _CTES["chiffrees"].replace("FROM datees", f"FROM datees_{_batch}")
    _CTES[f"commandes_{_batch}"] = _CTES["commandes"].replace("FROM chiffrees", f"FROM chiffrees_{_batch}")
for _report in ("ca_mensuel", "top_produits", "taux_retour"):
    _CTES[f"{_report}_lot"] = _CTES[_report].replace("FROM fait f", "FROM apres_lot f")
_CTES["ca_mensuel_1"] = _CTES["ca_mensuel"].replace("WHERE", "WHERE id_date < 20250701 AND")


def _statement(body: str) -> str:
    """body with the common table expressions it needs, in order."""

    def mentioned(sql: str) -> set[str]:
        return {name for name in _CTES if re.search(rf"\b(FROM|JOIN)\s+{name}\b", sql)}

    needed: set[str] = set()
    todo = mentioned(body)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo |= mentioned(_CTES[name])
    if not needed:
        return body
    return "WITH " + ",\n".join(f"{n} AS ({_CTES[n]})" for n in _CTES if n in needed) + "\n" + body


_RAW_ORDER = (
    "id_commande, id_client, id_produit, date_commande, quantite, prix_unitaire, statut, ville_livraison, "
    "mode_paiement, id_livreur, date_livraison"
)
_ORDERS = """SELECT id_commande, id_client, id_produit, CAST(date_commande AS VARCHAR) AS date_commande, CAST(quantite AS DOUBLE) AS quantite,
  CAST(prix_unitaire AS DOUBLE) AS prix_unitaire, statut, ville_livraison, mode_paiement, id_livreur,
  CAST(date_livraison AS VARCHAR) AS date_livraison, CAST(montant_ht AS DOUBLE) AS montant_ht, CAST(montant_ttc AS DOUBLE) AS montant_ttc,
  CAST(delai_livraison_jours AS DOUBLE) AS delai_livraison_jours FROM commandes"""
_FACT_COLUMNS = """id_commande, id_date, id_produit, id_client, id_region, id_livreur, quantite_vendue,
  CAST(montant_ht AS DOUBLE) AS montant_ht, CAST(montant_ttc AS DOUBLE) AS montant_ttc, CAST(NULL AS DOUBLE) AS cout_livraison,
  CAST(delai_livraison_jours AS DOUBLE) AS delai_livraison_jours, CAST(0 AS DOUBLE) AS remise_pct, statut_commande"""
_FACT = f"SELECT {_FACT_COLUMNS} FROM fait"
_UPSERTED = f"SELECT {_FACT_COLUMNS}, CAST(date_chargement AS VARCHAR) AS date_chargement FROM apres_lot"
_VALIDITY = "CAST(date_debut AS VARCHAR) AS date_debut, CAST(date_fin AS VARCHAR) AS date_fin"
_PRODUCT_DIMENSION = f"SELECT * REPLACE (CAST(prix_standard AS DOUBLE) AS prix_standard, {_VALIDITY}) FROM dim_produit"
_CLIENT_DIMENSION = f"SELECT * REPLACE ({_VALIDITY}) FROM dim_client"
_TABLES = ("dim_temps", "dim_produit", "dim_client", "dim_region", "dim_livreur", "fait")
_COUNTS = " UNION ALL ".join(
    f"SELECT '{'fait_ventes' if t == 'fait' else t}' AS table_name, count(*) AS nb_lignes FROM {t}" for t in _TABLES
)


def _rule(table: str, kind: str, column: str, broken: str) -> str:
    name = "fait_ventes" if table == "fait" else table
    judged = "count(*)" if kind == "not_null" else f"count({column})"
    source = table
    failed = f"count(*) FILTER (WHERE {broken})"
    if kind == "unique":
        source = f"(SELECT {column}, count(*) OVER (PARTITION BY {column}) AS n FROM {table} WHERE {column} IS NOT NULL)"
        failed = "count(*) FILTER (WHERE n > 1)"
    return f"""SELECT '{name}' AS table_name, '{kind}' AS regle, '{column}' AS colonne, {judged} AS evalues,
      {failed} AS echecs, {failed} = 0 AS succes FROM {source}"""


def _not_null(table: str, *columns: str) -> list[str]:
    return [_rule(table, "not_null", c, f"{c} IS NULL") for c in columns]


def _unique(table: str, *columns: str) -> list[str]:
    return [_rule(table, "unique", c, "") for c in columns]


def _between(table: str, column: str, broken: str) -> str:
    return _rule(table, "between", column, f"{column} {broken}")


def _in_set(table: str, column: str, values: str) -> str:
    return _rule(table, "in_set", column, f"{column} NOT IN ({values})")


def _max_length(table: str, **columns: int) -> list[str]:
    return [_rule(table, "max_length", c, f"length({c}) > {n}") for c, n in columns.items()]


_SEGMENT_SET = _in_set("dim_client", "segment_client", "'Gold', 'Silver', 'Bronze'")
_STATUS_SET = _in_set("fait", "statut_commande", "'livré', 'annulé', 'en_cours', 'retourné', 'inconnu'")
_AMOUNTS = [_between("fait", "montant_ttc", "< 0"), _between("fait", "quantite_vendue", "< 1")]
_LOAD_RULES = " UNION ALL ".join(
    [
        *_not_null("dim_client", "id_client_nk"), *_unique("dim_client", "id_client_sk"), _SEGMENT_SET,
        *_unique("dim_produit", "id_produit_sk"), *_not_null("dim_produit", "id_produit_nk"),
        *_unique("fait", "id_commande"), *_not_null("fait", "id_commande"), *_AMOUNTS, _STATUS_SET,
    ]
)
_CONSTRAINTS = " UNION ALL ".join(
    [
        *_not_null("dim_temps", "id_date", "jour", "mois", "trimestre", "annee"), *_unique("dim_temps", "id_date"),
        _between("dim_temps", "jour", "NOT BETWEEN 1 AND 31"), _between("dim_temps", "mois", "NOT BETWEEN 1 AND 12"),
        _between("dim_temps", "trimestre", "NOT BETWEEN 1 AND 4"),
        *_not_null("dim_produit", "id_produit_sk", "id_produit_nk", "nom_produit", "date_debut", "date_fin", "est_actif"),
        *_unique("dim_produit", "id_produit_sk"),
        *_not_null("dim_client", "id_client_sk", "id_client_nk", "date_debut", "date_fin", "est_actif"),
        *_unique("dim_client", "id_client_sk"), _in_set("dim_client", "sexe", "'m', 'f', 'inconnu'"), _SEGMENT_SET,
        *_not_null("dim_region", "id_region", "ville"), *_unique("dim_region", "id_region", "ville"),
        *_not_null("dim_livreur", "id_livreur", "id_livreur_nk"), *_unique("dim_livreur", "id_livreur", "id_livreur_nk"),
        *_not_null("fait", "id_commande", "id_date", "id_produit", "id_client", "id_region", "quantite_vendue",
                   "montant_ht", "montant_ttc"),
        *_unique("fait", "id_commande"), *_AMOUNTS, _between("fait", "montant_ht", "< 0"), _STATUS_SET,
        *_max_length("dim_temps", libelle_jour=20, libelle_mois=20),
        *_max_length("dim_produit", id_produit_nk=20, nom_produit=200, categorie=100, sous_categorie=100, marque=100,
                     fournisseur=100, origine_pays=50),
        *_max_length("dim_client", id_client_nk=20, nom_complet=200, tranche_age=10, ville=100, region_admin=100,
                     segment_client=20, canal_acquisition=50),
        *_max_length("dim_region", ville=100, province=100, region_admin=100, zone_geo=50, pays=50),
        *_max_length("dim_livreur", id_livreur_nk=20, nom_livreur=100, type_transport=50, zone_couverture=100),
        *_max_length("fait", id_commande=30, statut_commande=20),
    ]
)


def _orphans(column: str, table: str, key: str) -> str:
    return f"""SELECT 'fait -> {table}' AS check_name, CAST(count(*) FILTER (WHERE d.{key} IS NULL) AS BIGINT) AS nb_orphelines
      FROM fait LEFT JOIN {table} d ON fait.{column} = d.{key}"""


def _conflicts(table: str, key: str) -> str:
    return f"""SELECT '{table} : nb NK avec > 1 version active' AS check_name, count(*) AS nb_anomalies
      FROM (SELECT {key} FROM {table} WHERE est_actif GROUP BY {key} HAVING count(*) > 1)"""


def _audit(source: str, rule: str, before: str, after: str, detail: str) -> str:
    return f"""SELECT '{source}' AS source, '{rule}' AS regle, {before} AS avant, {after} AS apres,
      {before} - {after} AS supprimees, {detail} AS detail"""


def _count(source: str, where: str = "true") -> str:
    return f"(SELECT count(*) FROM {source} WHERE {where})"


_QTY = "CAST(quantite AS INTEGER) > 0"
_PRICE = "CAST(prix_unitaire AS DECIMAL(12,2)) > 0"
_NO_CITY = "lower(trim({})) NOT IN (SELECT variante FROM villes)"
_N = {
    "raw": _count("raw_commandes"), "last": _count("dernieres"), "dated": _count("datees"),
    "qty": _count("datees", _QTY), "price": _count("datees", f"{_QTY} AND {_PRICE}"),
    "clients": _count("raw_clients"), "unique": _count("clients_uniques"), "products": _count("raw_produits"),
}
_AUDIT = " UNION ALL ".join(
    [
        _audit("commandes", "R1", _N["raw"], _N["last"], "0"),
        _audit("commandes", "R2", _N["last"], _N["dated"], f"{_N['last']} - {_N['dated']}"),
        _audit("commandes", "R3", _N["dated"], _N["dated"], _count("datees", _NO_CITY.format("ville_livraison"))),
        _audit("commandes", "R4", _N["dated"], _N["dated"], _count("datees", f"({_STATUS}) = 'inconnu'")),
        _audit("commandes", "R5", _N["dated"], _N["qty"], "0"),
        _audit("commandes", "R6", _N["qty"], _N["price"], "0"),
        _audit("commandes", "R7", _N["price"], _N["price"], _count("datees", f"{_QTY} AND {_PRICE} AND trim(id_livreur) = ''")),
        _audit("clients", "R1", _N["clients"], _N["unique"], "0"),
        _audit("clients", "R2", _N["unique"], _N["unique"], _count("clients", "sexe = 'inconnu'")),
        _audit("clients", "R3", _N["unique"], _N["unique"], _count("clients_ages", "naissance IS NOT NULL AND age IS NULL")),
        _audit("clients", "R4", _N["unique"], _N["unique"], _count("clients", "email IS NULL")),
        _audit("clients", "R5", _N["unique"], _N["unique"], _count("clients", "ville = 'Non renseignée'")),
        _audit("produits", "R1", _N["products"], _N["products"], "0"),
        _audit("produits", "R2", _N["products"], _N["products"], _count("raw_produits", "prix_catalogue IS NULL")),
        _audit("produits", "R3", _N["products"], _N["products"], _count("raw_produits", "NOT actif")),
    ]
)

_CHANGED = " OR ".join(f"c.{t} IS DISTINCT FROM n.{t}" for t in _TRACKED)

_BODIES = {
    "src_csv_text": f"SELECT {_RAW_ORDER} FROM raw_commandes",
    "src_csv_clients": """SELECT id_client, nom, prenom, email, date_naissance, sexe, ville, telephone, date_inscription,
      canal_acquisition FROM raw_clients""",
    "src_csv_regions": """SELECT code_ville, nom_ville_standard, province, region_admin, zone_geo, '' AS population, '' AS code_postal
    FROM raw_regions""",
    "clients_by_period": " UNION ALL ".join(
        f"""SELECT '{kind}' AS granularite, CAST({period} AS INTEGER) AS periode, ville, count(DISTINCT id_client) AS nb_clients
        FROM fait JOIN dim_temps USING (id_date) JOIN dim_region USING (id_region) WHERE statut_commande = 'livré' GROUP BY ALL"""
        for kind, period in (("mois", "annee * 100 + mois"), ("trimestre", "annee * 10 + trimestre"), ("annee", "annee"))
    ),
    "src_csv_quoted": """SELECT id_client, concat(nom, chr(10), '"dit, ', chr(10), chr(10), prenom, '"', chr(10)) AS nom, prenom,
      email, date_naissance, sexe, ville, telephone, date_inscription, canal_acquisition FROM raw_clients""",
    "src_json_array": """SELECT id_produit, concat(nom, ' }{ "\\ ]} ', id_produit) AS nom, categorie, sous_categorie, marque,
      fournisseur, prix_catalogue, origine_pays, date_creation, actif FROM raw_produits""",
    "src_json_explode": """SELECT id_produit, nom, categorie, sous_categorie, marque, fournisseur, prix_catalogue, origine_pays,
      date_creation, actif FROM raw_produits""",
    "city_lookup": "SELECT variante, ville FROM villes",
    "dedup_orders_last": f"SELECT {_RAW_ORDER} FROM dernieres",
    "clean_dates": f"""SELECT id_commande, CAST({_date("date_commande")} AS VARCHAR) AS date_commande,
        CAST({_date("date_livraison")} AS VARCHAR) AS date_livraison
      FROM raw_commandes WHERE {_date("date_commande")} IS NOT NULL""",
    "clean_cities": """SELECT id_commande, coalesce(v.ville, 'Non renseignée') AS ville_livraison
      FROM raw_commandes LEFT JOIN villes v ON v.variante = lower(trim(ville_livraison))""",
    "clean_status": f"SELECT id_commande, {_STATUS} AS statut FROM raw_commandes",
    "clean_quantity": f"SELECT id_commande, CAST(quantite AS DOUBLE) AS quantite FROM raw_commandes WHERE {_QTY}",
    "clean_test_orders": f"SELECT id_commande, CAST(prix_unitaire AS DOUBLE) AS prix_unitaire FROM raw_commandes WHERE {_PRICE}",
    "clean_courier": "SELECT id_commande, CASE WHEN id_livreur = '' THEN '-1' ELSE id_livreur END AS id_livreur FROM raw_commandes",
    "order_amounts": f"""SELECT id_commande, CAST(ht AS DOUBLE) AS montant_ht, CAST(round(ht * 1.20, 2) AS DOUBLE) AS montant_ttc
      FROM (SELECT id_commande, round(CAST(quantite AS INTEGER) * CAST(prix_unitaire AS DECIMAL(12,2)), 2) AS ht
            FROM raw_commandes WHERE {_QTY} AND {_PRICE})""",
    "delivery_delay": f"""SELECT id_commande, statut, CASE WHEN statut IN ('livré', 'retourné') AND jours BETWEEN 0 AND 60
        THEN CAST(jours AS DOUBLE) END AS delai_livraison_jours
      FROM (SELECT id_commande, {_STATUS} AS statut,
              date_diff('day', {_date("date_commande")}, {_date("date_livraison")}) AS jours
            FROM raw_commandes WHERE {_date("date_commande")} IS NOT NULL)""",
    "clean_orders_all": _ORDERS,
    "rule_audit": _AUDIT,
    "dedup_clients_email": "SELECT id_client, email_norm, CAST(date_inscription AS VARCHAR) AS date_inscription FROM clients_uniques",
    "clean_sex": f"SELECT id_client, {_SEX} AS sexe FROM raw_clients",
    "clean_birthdate_ageband": f"""SELECT id_client, CASE WHEN age IS NOT NULL THEN CAST(naissance AS VARCHAR) END AS date_naissance, age, {_BAND} AS tranche_age
      FROM (SELECT id_client, naissance, CASE WHEN {_AGE} BETWEEN 16 AND 100 THEN CAST({_AGE} AS DOUBLE) END AS age
            FROM (SELECT id_client, {_date("date_naissance")} AS naissance FROM raw_clients))""",
    "clean_email": f"SELECT id_client, CASE WHEN regexp_matches(email, '{_EMAIL}') THEN email END AS email FROM raw_clients",
    "clean_client_cities": """SELECT id_client, coalesce(v.ville, 'Non renseignée') AS ville
      FROM raw_clients c LEFT JOIN villes v ON v.variante = lower(trim(c.ville))""",
    "clean_clients_all": """SELECT * REPLACE (CAST(date_naissance AS VARCHAR) AS date_naissance,
      CAST(date_inscription AS VARCHAR) AS date_inscription) FROM clients""",
    "clean_products": "SELECT * EXCLUDE (p_partkey) REPLACE (CAST(prix_catalogue AS DOUBLE) AS prix_catalogue) FROM produits",
    "client_segments": "SELECT id_client, segment_client, CAST(ca_12m AS DOUBLE) AS ca_12m FROM segments",
    "surrogate_keys": """SELECT o_orderkey, CAST(row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS BIGINT) AS cle FROM orders""",
    "dim_temps": """SELECT t.*, coalesce(n, 0) AS nb_lignes FROM dim_temps t
      LEFT JOIN (SELECT id_date, count(*) AS n FROM fait GROUP BY id_date) f USING (id_date)""",
    "dim_produit": _PRODUCT_DIMENSION,
    "dim_client": _CLIENT_DIMENSION,
    "dim_region": "SELECT * FROM dim_region",
    "dim_livreur": "SELECT * FROM dim_livreur",
    "fk_product": """SELECT id_commande, c.id_produit AS id_produit_nk, coalesce(id_produit_sk, 1) AS id_produit, id_produit_sk IS NULL AS non_resolu
      FROM commandes c LEFT JOIN dim_produit p ON p.id_produit_nk = c.id_produit""",
    "fk_client": """SELECT id_commande, c.id_client AS id_client_nk, coalesce(id_client_sk, 1) AS id_client, id_client_sk IS NULL AS non_resolu
      FROM commandes c LEFT JOIN dim_client k ON k.id_client_nk = c.id_client""",
    "fk_region": """SELECT id_commande, ville_livraison AS ville, coalesce(id_region, 1) AS id_region, id_region IS NULL AS non_resolu
      FROM commandes c LEFT JOIN dim_region r ON r.ville = c.ville_livraison""",
    "fk_courier": """SELECT id_commande, c.id_livreur AS id_livreur_nk,
        coalesce(l.id_livreur, (SELECT id_livreur FROM dim_livreur WHERE id_livreur_nk = '-1')) AS id_livreur, l.id_livreur IS NULL AS non_resolu
      FROM commandes c LEFT JOIN dim_livreur l ON l.id_livreur_nk = c.id_livreur""",
    "fait_ventes": _FACT,
    "fact_point_in_time": """SELECT c.id_commande, CAST(strftime(c.date_commande, '%Y%m%d') AS INTEGER) AS id_date,
      k.cle AS id_client_nk, k.valeur AS segment_client, CAST(k.debut AS VARCHAR) AS date_debut_client, CAST(k.fin AS VARCHAR) AS date_fin_client,
      p.cle AS id_produit_nk, p.valeur AS categorie, CAST(p.debut AS VARCHAR) AS date_debut_produit, CAST(p.fin AS VARCHAR) AS date_fin_produit
    FROM commandes c
    LEFT JOIN versions_clients k ON k.cle = c.id_client AND c.date_commande BETWEEN k.des AND k.fin
    LEFT JOIN versions_produits p ON p.cle = c.id_produit AND c.date_commande BETWEEN p.des AND p.fin""",
    "dim_client_history": """SELECT cle AS id_client_nk, valeur AS segment_client, ville, CAST(debut AS VARCHAR) AS date_debut,
      CAST(fin AS VARCHAR) AS date_fin, fin = DATE '9999-12-31' AS est_actif FROM versions_clients""",
    "fact_summary": """SELECT statut_commande, count(*) AS nb_lignes, CAST(sum(montant_ttc) AS DOUBLE) AS montant_ttc
      FROM fait GROUP BY statut_commande""",
    "fact_assertions": " UNION ALL ".join(_AMOUNTS),
    "mv_monthly_revenue": """SELECT * REPLACE (CAST(ca_ttc AS DOUBLE) AS ca_ttc, CAST(ca_ht AS DOUBLE) AS ca_ht),
      CAST(ca_ttc AS DOUBLE) / nb_commandes AS panier_moyen, annee - 1 AS annee_n1 FROM ca_mensuel""",
    "mv_top_products": "SELECT * REPLACE (CAST(ca_total AS DOUBLE) AS ca_total) FROM top_produits",
    "mv_return_rate": f"SELECT * EXCLUDE (taux), taux AS taux_retour_pct, {_ALERT} AS alerte FROM taux_retour",
    "mv_courier_performance": f"""SELECT nom_livreur, zone_couverture, annee, mois, n AS nb_livraisons, jours / CAST(n AS DOUBLE) AS delai_moyen_jours,
        tard AS nb_livraisons_retard, {_percent("tard", "n", 2)} AS taux_retard_pct
      FROM (SELECT nom_livreur, zone_couverture, annee, mois, count(*) AS n, CAST(sum(delai_livraison_jours) AS DOUBLE) AS jours,
              count(*) FILTER (WHERE delai_livraison_jours > 3) AS tard
            FROM fait JOIN dim_livreur l USING (id_livreur) JOIN dim_temps t USING (id_date)
            WHERE statut_commande IN ('livré', 'retourné') AND delai_livraison_jours IS NOT NULL AND id_livreur_nk <> '-1'
            GROUP BY nom_livreur, zone_couverture, annee, mois)""",
    "q1_monthly_revenue_yoy": f"""SELECT annee, mois, libelle_mois, region_admin, CAST(n.ca AS DOUBLE) AS ca_ttc,
        CAST(p.ca AS DOUBLE) AS ca_ttc_n_moins_1,
        {_percent(f"({_cents('n.ca')} - {_cents('p.ca')})", _cents("p.ca"), 1)} AS evolution_pct
      FROM (SELECT annee, mois, libelle_mois, region_admin, sum(ca_ttc) AS ca FROM ca_mensuel GROUP BY ALL) n
      LEFT JOIN (SELECT annee + 1 AS annee, mois, region_admin, sum(ca_ttc) AS ca FROM ca_mensuel GROUP BY ALL) p
      USING (annee, mois, region_admin)""",
    "q2_top10_products_city": """SELECT annee, trimestre, nom_produit, categorie, marque, qte_totale, CAST(ca_total AS DOUBLE) AS ca_total,
      nb_clients_distincts, rang_global FROM top_produits WHERE ville = 'NATION_1' AND rang_global <= 10""",
    "q3_basket_by_segment": f"""SELECT segment_client, nb_clients, nb_commandes, CAST(ca AS DOUBLE) AS ca_total_ttc,
        CAST(({_cents("ca")} * 2 + nb_commandes) // (2 * nb_commandes) AS DOUBLE) / 100.0 AS panier_moyen_ttc,
        {_percent(_cents("ca"), _cents("(SELECT sum(montant_ttc) FROM fait WHERE statut_commande = 'livré')"), 1)} AS part_ca_pct
      FROM (SELECT segment_client, count(DISTINCT id_client) AS nb_clients, count(DISTINCT id_commande) AS nb_commandes, sum(montant_ttc) AS ca
            FROM fait JOIN dim_client c ON c.id_client_sk = fait.id_client
            WHERE statut_commande = 'livré' AND est_actif GROUP BY segment_client)""",
    "q4_return_rate": f"""SELECT * EXCLUDE (taux), taux AS taux_retour_pct, {_ALERT} AS alerte, CAST(54 AS DOUBLE) AS seuil_rouge,
      CAST(50 AS DOUBLE) AS seuil_orange FROM taux_retour""",
    "q5_period_effect": f"""SELECT annee, mois, libelle_mois, periode_ramadan, CAST(ca AS DOUBLE) AS ca_alimentation_ttc, volume_vendu,
        {_percent(f"({_cents('ca')} * m.n)", "m.somme", 1)} AS indice_vs_moyenne
      FROM alimentation CROSS JOIN (SELECT {_cents("sum(ca)")} AS somme, count(*) AS n FROM alimentation WHERE NOT periode_ramadan) m""",
    "table_counts": _COUNTS,
    "orphan_keys": " UNION ALL ".join(
        [_orphans("id_date", "dim_temps", "id_date"), _orphans("id_produit", "dim_produit", "id_produit_sk"),
         _orphans("id_client", "dim_client", "id_client_sk"), _orphans("id_region", "dim_region", "id_region"),
         _orphans("id_livreur", "dim_livreur", "id_livreur")]
    ),
    "measure_anomalies": """SELECT 'Montants TTC négatifs' AS check_name, count(*) AS nb_anomalies FROM fait WHERE montant_ttc < 0
      UNION ALL SELECT 'Quantités <= 0', count(*) FROM fait WHERE quantite_vendue <= 0
      UNION ALL SELECT 'Délais > 60 jours', count(*) FROM fait WHERE delai_livraison_jours > 60
      UNION ALL SELECT 'Statuts non standards', count(*) FROM fait
        WHERE statut_commande NOT IN ('livré', 'annulé', 'en_cours', 'retourné', 'inconnu')""",
    "status_distribution": f"""SELECT statut_commande, nb_commandes, {_percent("nb_commandes", _count("fait"), 1)} AS pct
      FROM (SELECT statut_commande, count(*) AS nb_commandes FROM fait GROUP BY statut_commande)""",
    "scd2_active_uniqueness": f"{_conflicts('dim_produit', 'id_produit_nk')} UNION ALL {_conflicts('dim_client', 'id_client_nk')}",
    "kpi_summary": f"""SELECT 'CA Total TTC (livrées)' AS kpi, CAST(sum(montant_ttc) AS DOUBLE) AS valeur FROM fait WHERE statut_commande = 'livré'
      UNION ALL SELECT 'Nb clients distincts (faits)', CAST(count(DISTINCT id_client) AS DOUBLE) FROM fait
      UNION ALL SELECT 'Taux de retour global', {_percent(_count("fait", "statut_commande = 'retourné'"), _count("fait", "statut_commande IN ('livré', 'retourné')"), 2)}
      UNION ALL SELECT 'Panier moyen TTC (livrées)',
        CAST((sum({_cents("montant_ttc")}) * 2 + count(*)) // (2 * count(*)) AS DOUBLE) / 100.0 FROM fait WHERE statut_commande = 'livré'""",
    "dq_report": _LOAD_RULES,
    "dq_table_score": f"""SELECT table_name, count(*) FILTER (WHERE succes) AS regles_ok, count(*) AS regles, bool_and(succes) AS succes
      FROM ({_LOAD_RULES}) GROUP BY table_name""",
    "dq_constraints": _CONSTRAINTS,
    "dim_replace": _CLIENT_DIMENSION,
    "sink_roundtrip": _FACT,
    "fact_upsert": _UPSERTED,
    "fact_upsert_idempotent": _UPSERTED,
    "fact_upsert_stream": _UPSERTED,
    "scd2_merge": f"""SELECT * REPLACE ({_VALIDITY}) FROM (SELECT c.id_client_sk, c.id_client_nk, {", ".join("c." + t for t in _TRACKED)}, c.date_debut,
        CASE WHEN {_CHANGED} THEN DATE '2026-06-30' ELSE c.date_fin END AS date_fin, NOT ({_CHANGED}) AS est_actif
      FROM dim_client c JOIN dim_client_neuf n USING (id_client_nk)
      UNION ALL
      SELECT CAST((SELECT max(id_client_sk) FROM dim_client) + row_number() OVER (ORDER BY n.id_client_nk) AS BIGINT),
        n.id_client_nk, {", ".join("n." + t for t in _TRACKED)}, DATE '2026-07-01', DATE '9999-12-31', true
      FROM dim_client c JOIN dim_client_neuf n USING (id_client_nk) WHERE {_CHANGED})""",
    "pipeline_second_run": """SELECT c.id_commande,
        coalesce(k.id_client, (SELECT id_client FROM clients WHERE date_inscription >= DATE '2022-01-01'
                               ORDER BY date_inscription, id_client LIMIT 1)) AS id_client_nk,
        coalesce(p.id_produit, (SELECT id_produit FROM produits WHERE actif ORDER BY p_partkey LIMIT 1)) AS id_produit_nk,
        coalesce(r.ville, (SELECT ville FROM dim_region WHERE id_region = 1)) AS ville, c.id_livreur AS id_livreur_nk
      FROM commandes c
      LEFT JOIN clients k ON k.id_client = c.id_client
        AND (c.date_commande >= DATE '2023-07-01' OR k.date_inscription >= DATE '2022-01-01')
      LEFT JOIN produits p ON p.id_produit = c.id_produit AND (c.date_commande >= DATE '2023-07-01' OR p.actif)
      LEFT JOIN dim_region r ON r.ville = c.ville_livraison""",
    "pipeline_end_to_end": f"""SELECT table_name, nb_lignes, CAST(coalesce(regles, 0) AS BIGINT) AS regles,
        CAST(coalesce(regles, 0) AS BIGINT) AS regles_ok
      FROM ({_COUNTS}) LEFT JOIN (VALUES ('dim_client', 2), ('dim_produit', 1), ('fait_ventes', 2)) r(table_name, regles) USING (table_name)""",
}

_BODIES["load_checks"] = (
    f"SELECT concat_ws(' ', table_name, colonne, regle) AS check_name, echecs AS nb_echecs FROM ({_CONSTRAINTS})"
    f" UNION ALL SELECT check_name, nb_orphelines FROM ({_BODIES['orphan_keys']})"
)
_BODIES["reports_refresh"] = " UNION ALL ".join(
    f"SELECT '{stored}' AS table_name, count(*) AS nb_lignes, CAST(sum({total}) AS BIGINT) AS total FROM ({_BODIES[report]})"
    for stored, report, total in (
        ("mv_ca_mensuel", "mv_monthly_revenue", "volume_vendu"), ("mv_top_produits", "mv_top_products", "qte_totale"),
        ("mv_taux_retour", "mv_return_rate", "nb_retournees"), ("mv_performance_livreurs", "mv_courier_performance", "nb_livraisons"),
    )
)
# A sale keeps the client and product that were known to its batch.
_BODIES["orders_stream"] = " UNION ALL ".join(
    f"""SELECT id_commande, {_key("date_commande")} AS id_date, CAST(trunc(quantite) AS INTEGER) AS quantite_vendue, statut AS statut_commande,
      CASE WHEN ville_livraison <> 'Non renseignée' THEN ville_livraison END AS ville, {courier} AS id_livreur_nk,
      (SELECT any_value(id_produit) FROM produits p WHERE p.id_produit = c.id_produit AND {product}) AS id_produit_nk,
      (SELECT any_value(k.id_client) FROM clients_{batch} k WHERE k.id_client = c.id_client) AS id_client_nk
    FROM commandes_{batch} c {rest}"""
    for batch, courier, product, rest in (
        (1, "CASE WHEN regexp_matches(id_livreur, '[02468]$') THEN '-1' ELSE id_livreur END", "p.actif",
         "WHERE id_commande NOT IN (SELECT id_commande FROM commandes_2)"),
        (2, "id_livreur", "true", ""),
    )
)
_SEEN = """SELECT {n} AS generation, count(*) AS nb_ventes, CAST(sum(quantite_vendue) AS BIGINT) AS quantite,
  count(DISTINCT id_date // 100) AS nb_mois, (SELECT CAST(sum(volume_vendu) AS BIGINT) FROM {report}) AS volume_vendu FROM {sales}"""
_BODIES["load_generations"] = " UNION ALL ".join((
    _SEEN.format(n=1, report="ca_mensuel_1", sales="fait WHERE id_date < 20250701"),
    _SEEN.format(n=2, report="ca_mensuel_lot", sales="apres_lot"),
))
_BODIES["reports_incremental"] = " UNION ALL ".join(
    f"""SELECT '{stored}' AS table_name, CAST({period} AS INTEGER) AS periode, {label} AS libelle,
    CAST({first} AS BIGINT) AS mesure_1, CAST({second} AS BIGINT) AS mesure_2 FROM {source}"""
    for stored, period, label, first, second, source in (
        ("mv_ca_mensuel", "annee * 100 + mois", "categorie", "volume_vendu", "nb_clients_actifs", "ca_mensuel_lot"),
        ("mv_top_produits", "annee * 10 + trimestre", "nom_produit", "qte_totale", "rang_global", "top_produits_lot"),
        ("mv_taux_retour", "annee * 10 + trimestre", "sous_categorie", "nb_livrees", "nb_retournees", "taux_retour_lot"),
        ("mv_performance_livreurs", "annee * 100 + mois", "nom_livreur", "nb_livraisons", "nb_livraisons_retard",
         f"({_BODIES['mv_courier_performance'].replace('FROM fait ', 'FROM apres_lot ')})"),
    )
)


def _by_month(rule: str, column: str, broken: str) -> str:
    judged = "count(*)" if rule == "not_null" else f"count({column})"
    return f"""SELECT CAST(id_date // 100 AS INTEGER) AS annee_mois, '{rule}' AS regle, '{column}' AS colonne, {judged} AS evalues,
      count(*) FILTER (WHERE {broken}) AS echecs FROM apres_lot GROUP BY 1"""


_BODIES["checks_incremental"] = " UNION ALL ".join(
    [
        *(_by_month("not_null", c, f"{c} IS NULL") for c in (
            "id_commande", "id_date", "id_produit", "id_client", "id_region", "quantite_vendue", "montant_ht", "montant_ttc")),
        *(_by_month("between", c, f"{c} {broken}") for c, broken in (
            ("montant_ht", "< 0"), ("montant_ttc", "< 0"), ("quantite_vendue", "< 1"), ("delai_livraison_jours", "> 5"))),
        _by_month("in_set", "statut_commande", "statut_commande NOT IN ('livré', 'annulé', 'en_cours', 'retourné', 'inconnu')"),
        _by_month("max_length", "id_commande", "length(id_commande) > 30"),
        _by_month("max_length", "statut_commande", "length(statut_commande) > 20"),
        _by_month("unique", "id_commande", "id_commande IN (SELECT id_commande FROM apres_lot GROUP BY 1 HAVING count(*) > 1)"),
    ]
)


def statements() -> dict[str, str]:
    return {name: _statement(body) for name, body in _BODIES.items()}
