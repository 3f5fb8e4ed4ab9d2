"""DuckDB oracle text: the fixture CTEs (FIXTURES.md section 2) and helpers.

Each oracle query is ``WITH <fixture CTEs>, <query CTEs> <select>`` over the raw
test tables, written independently of the Spark code it checks.
"""

from __future__ import annotations

FIXTURE_CTES = """
li AS (
  SELECT l_orderkey,
         count(*) AS n_lines,
         min(l_suppkey) AS hotel_key,
         min(l_partkey) AS part_key,
         cast(sum(l_quantity) AS bigint) AS qty,
         cast(round(max(l_discount)*100) AS int) AS remise,
         cast(round(max(l_extendedprice)) AS bigint) AS px,
         sum(CASE WHEN l_linestatus='O' THEN 1 ELSE 0 END) AS n_open
  FROM lineitem GROUP BY l_orderkey
),
base AS (
  SELECT o_orderkey, o_custkey,
         cast(o_orderdate AS date) AS date_reservation,
         n_lines, qty, remise, px,
         cast(floor(584.0E0 * pow(((o_orderkey*7919)%1000)/1000.0E0, 4)) AS int) AS delai_reservation_jours,
         CASE o_orderstatus WHEN 'F' THEN 'aucun' WHEN 'O' THEN 'partiel' ELSE 'total' END AS type_acompte,
         CASE WHEN n_open*2 > n_lines THEN 'oui' ELSE 'non' END AS tarif_remboursable,
         o_orderpriority, c_mktsegment, s_suppkey,
         sn.n_name AS ville, sr.r_name AS region_hotel, cr.r_name AS marche, p_type
  FROM orders
  JOIN li ON o_orderkey = l_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey
  JOIN region cr ON cn.n_regionkey = cr.r_regionkey
  JOIN supplier ON s_suppkey = hotel_key
  JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN region sr ON sn.n_regionkey = sr.r_regionkey
  JOIN part ON p_partkey = part_key
),
risk AS (
  SELECT *,
    (CASE
       WHEN delai_reservation_jours <= 7 THEN CASE type_acompte WHEN 'aucun' THEN 289 WHEN 'partiel' THEN 211 ELSE 101 END
       WHEN delai_reservation_jours <= 21 THEN CASE type_acompte WHEN 'aucun' THEN 304 WHEN 'partiel' THEN 210 ELSE 89 END
       WHEN delai_reservation_jours <= 45 THEN CASE type_acompte WHEN 'aucun' THEN 327 WHEN 'partiel' THEN 220 ELSE 102 END
       WHEN delai_reservation_jours <= 90 THEN CASE type_acompte WHEN 'aucun' THEN 378 WHEN 'partiel' THEN 245 ELSE 118 END
       ELSE CASE type_acompte WHEN 'aucun' THEN 486 WHEN 'partiel' THEN 344 ELSE 137 END
     END) + CASE WHEN tarif_remboursable = 'oui' THEN 40 ELSE -40 END AS permille
  FROM base
),
tgt AS (
  SELECT *, CASE WHEN (o_orderkey*104729)%1000 < permille THEN 1 ELSE 0 END AS reservation_annulee FROM risk
),
res AS (
  SELECT
    concat('R', lpad(cast(o_orderkey AS varchar), 9, '0')) AS reservation_id,
    date_reservation,
    date_reservation + delai_reservation_jours AS date_arrivee,
    region_hotel,
    ville,
    concat('dest_', lower(region_hotel)) AS type_destination,
    concat('H', cast(s_suppkey AS varchar)) AS hotel_id,
    cast(3 + s_suppkey%3 AS int) AS categorie_hotel,
    c_mktsegment AS segment_client,
    CASE WHEN o_orderkey%41=0 THEN NULL ELSE marche END AS marche_origine,
    CASE WHEN date_reservation >= DATE '2000-04-01' AND o_orderkey%25=0 THEN 'assistant_vocal' ELSE o_orderpriority END AS canal_reservation,
    p_type AS moyen_transport,
    delai_reservation_jours,
    cast(1+qty%14 AS int) AS nuits,
    cast(1+n_lines%4 AS int) AS adultes,
    CASE WHEN o_orderkey%23=0 THEN NULL ELSE cast(o_custkey%3 AS int) END AS enfants,
    cast(1+n_lines%3 AS int) AS chambres,
    CASE o_orderkey%4 WHEN 0 THEN 'petit_dejeuner' WHEN 1 THEN 'demi_pension' WHEN 2 THEN 'pension_complete' ELSE 'aucun' END AS formule_repas,
    tarif_remboursable,
    type_acompte,
    CASE WHEN o_orderkey%42=0 THEN NULL ELSE px/100.0E0 END AS prix_moyen_nuit_eur,
    remise AS remise_pct,
    px*(1+qty%14)*(1+n_lines%3)*(100-remise)/10000.0E0 AS montant_total_eur,
    CASE WHEN row_number() OVER w = 1 THEN 'nouveau' WHEN row_number() OVER w > 6 THEN 'fidele' ELSE 'connu' END AS client_type,
    cast(row_number() OVER w - 1 AS int) AS reservations_passees,
    cast(coalesce(sum(reservation_annulee) OVER (PARTITION BY o_custkey ORDER BY date_reservation, o_orderkey
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS int) AS annulations_passees,
    CASE WHEN o_orderkey%50=0 THEN NULL ELSE cast(n_lines%5 AS int) END AS demandes_speciales,
    CASE WHEN o_orderkey%3=0 THEN cast(o_orderkey%5 AS int) ELSE 0 END AS modifications_reservation,
    CASE WHEN o_orderkey%20=0 THEN cast(o_orderkey%31 AS int) ELSE 0 END AS jours_liste_attente,
    CASE WHEN o_orderkey%11=0 THEN 1 ELSE 0 END AS evenement_majeur,
    CASE WHEN extract(month FROM (date_reservation + delai_reservation_jours)) IN (6,7,8) THEN 1 ELSE 0 END AS haute_saison_regionale,
    CASE WHEN extract(isodow FROM (date_reservation + delai_reservation_jours)) IN (5,6) THEN 1 ELSE 0 END AS arrivee_weekend,
    CASE WHEN o_custkey%100<42 THEN NULL ELSE concat('A', cast(o_custkey%50 AS varchar)) END AS agent_id,
    reservation_annulee,
    (permille + (o_orderkey*31)%200 - 100 + 60)/1000.0E0 AS proba
  FROM tgt
  WINDOW w AS (PARTITION BY o_custkey ORDER BY date_reservation, o_orderkey)
),
train_raw AS (SELECT * EXCLUDE (proba) FROM res WHERE date_reservation < DATE '2000-04-01'),
test_raw AS (SELECT * EXCLUDE (proba, reservation_annulee) FROM res WHERE date_reservation >= DATE '2000-04-01'),
scored AS (SELECT 'fixture' AS model, reservation_id, reservation_annulee AS y, proba FROM res)
"""

# Cleaning (CLN1-6) as a SQL projection over a raw CTE named {src}.
CLEAN_SELECT = """
SELECT * REPLACE (
    coalesce(prix_moyen_nuit_eur, montant_total_eur / nullif(nuits*chambres*(1 - remise_pct/100.0E0), 0)) AS prix_moyen_nuit_eur,
    cast(coalesce(enfants, 0) AS double) AS enfants,
    cast(coalesce(demandes_speciales, 0) AS double) AS demandes_speciales,
    coalesce(marche_origine, 'Inconnu') AS marche_origine,
    coalesce(agent_id, 'DIRECT') AS agent_id,
    cast(categorie_hotel AS varchar) AS categorie_hotel),
  CASE WHEN prix_moyen_nuit_eur IS NULL THEN 1 ELSE 0 END AS prix_impute,
  CASE WHEN enfants IS NULL THEN 1 ELSE 0 END AS enfants_manquant,
  CASE WHEN demandes_speciales IS NULL THEN 1 ELSE 0 END AS demandes_manquant,
  CASE WHEN agent_id IS NULL THEN 1 ELSE 0 END AS reservation_directe
FROM {src}
"""

# Row-level features (FE1-17) over a cleaned CTE named {src}.
FEATURES_SELECT = """
SELECT *,
  log_delai * acompte_ord AS ix_delai_acompte,
  log_delai * remboursable AS ix_delai_remb,
  log_delai * reservation_directe AS ix_delai_direct,
  remboursable * acompte_ord AS ix_remb_acompte,
  log_delai * a_modifie AS ix_delai_modif,
  log_delai * demandes_speciales AS ix_delai_dem
FROM (
  SELECT *,
    acompte_ord - remboursable AS score_engagement,
    CASE WHEN coalesce(acompte_ord = 0 AND remboursable = 1, false) THEN 1 ELSE 0 END AS flexibilite_totale,
    sin(2 * pi() * mois_arrivee / 12) AS sin_mois,
    cos(2 * pi() * mois_arrivee / 12) AS cos_mois
  FROM (
    SELECT *,
      coalesce(cast(annulations_passees AS double) / nullif(reservations_passees, 0), 0.0E0) AS taux_annulation_passe,
      CASE WHEN reservations_passees = 0 THEN 1 ELSE 0 END AS sans_historique,
      adultes + enfants AS personnes,
      (adultes + enfants) / nullif(chambres, 0) AS personnes_par_chambre,
      CASE WHEN coalesce(enfants > 0, false) THEN 1 ELSE 0 END AS avec_enfants,
      montant_total_eur / CASE WHEN adultes + enfants IS NULL THEN NULL ELSE greatest(adultes + enfants, 1) END AS prix_par_personne,
      montant_total_eur / nullif(nuits, 0) AS montant_par_nuit,
      cast(CASE type_acompte WHEN 'aucun' THEN 0 WHEN 'partiel' THEN 1 WHEN 'total' THEN 2 END AS double) AS acompte_ord,
      CASE WHEN coalesce(tarif_remboursable = 'oui', false) THEN 1 ELSE 0 END AS remboursable,
      cast(extract(month FROM date_arrivee) AS int) AS mois_arrivee,
      cast(extract(month FROM date_reservation) AS int) AS mois_reservation,
      ln(1 + delai_reservation_jours) AS log_delai,
      delai_reservation_jours / nullif(nuits, 0) AS delai_par_nuit,
      CASE WHEN coalesce(modifications_reservation > 0, false) THEN 1 ELSE 0 END AS a_modifie
    FROM {src}
  )
)
"""

STD_CTES = (
    "train_clean AS (" + CLEAN_SELECT.format(src="train_raw") + "),\n"
    "test_clean AS (" + CLEAN_SELECT.format(src="test_raw") + "),\n"
    "train_fe AS (" + FEATURES_SELECT.format(src="train_clean") + "),\n"
    "test_fe AS (" + FEATURES_SELECT.format(src="test_clean") + ")"
)


def with_fixture(body: str, extra_ctes: str = "") -> str:
    """Full oracle text: fixture CTEs, standard cleaned/feature CTEs, extra CTEs, then ``body``."""
    ctes = FIXTURE_CTES.strip() + ",\n" + STD_CTES
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip()
    return "WITH " + ctes + "\n" + body


def r_py(expr: str, digits: int) -> str:
    """Python's ``round`` in DuckDB: the exact error of x * 10**k breaks apparent ties."""
    scale = f"1E{digits}"
    return (f"(SELECT CASE WHEN p - floor(p) = 0.5E0 AND e > 0 THEN floor(p) + 1 WHEN p - floor(p) = 0.5E0 AND e < 0 THEN floor(p) "
            f"ELSE round_even(p, 0) END / {scale} FROM (SELECT p, (hi * {scale} - p) + (x - hi) * {scale} AS e FROM "
            f"(SELECT x, x * {scale} AS p, x * 134217729E0 - (x * 134217729E0 - x) AS hi FROM (SELECT cast({expr} AS double) AS x))))")


def r(expr: str, digits: int) -> str:
    """numpy-style rounding in DuckDB (half to even on x * 10**k)."""
    scale = f"1E{digits}"
    return f"(round_even(({expr}) * {scale}, 0) / {scale})"
