"""Registered queries: exploratory aggregates (EDA1-20)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import eda
from ..oracle_sql import r, with_fixture
from ..registry import query
from ..sources.schema import TARGET
from . import inputs
from .q_data import REF_CTES


def _rate_sql(key: str, src: str = "train_fe") -> str:
    return with_fixture(f"""
SELECT {key}, count(*) AS effectif, {r('avg(reservation_annulee)', 3)} AS taux_annulation
FROM {src} WHERE {key} IS NOT NULL GROUP BY {key}""")


@query("eda1_rate_deposit_x_refundable", with_fixture(f"""
SELECT type_acompte,
  {r("avg(CASE WHEN tarif_remboursable='non' THEN reservation_annulee END)", 3)} AS non,
  {r("avg(CASE WHEN tarif_remboursable='oui' THEN reservation_annulee END)", 3)} AS oui
FROM train_fe WHERE type_acompte IS NOT NULL AND tarif_remboursable IS NOT NULL GROUP BY type_acompte"""))
def eda1(spark, sf):
    return eda.rate_pivot(inputs.engineered(spark, sf)[0], "type_acompte", "tarif_remboursable", ["non", "oui"])


@query("eda2_rate_by_lead_x_deposit", with_fixture(f"""
SELECT bin AS delai_reservation_jours,
  {r("avg(CASE WHEN type_acompte='aucun' THEN reservation_annulee END)", 3)} AS aucun,
  {r("avg(CASE WHEN type_acompte='partiel' THEN reservation_annulee END)", 3)} AS partiel,
  {r("avg(CASE WHEN type_acompte='total' THEN reservation_annulee END)", 3)} AS total
FROM (SELECT *, CASE
        WHEN delai_reservation_jours > 0 AND delai_reservation_jours <= 7 THEN '(0, 7]'
        WHEN delai_reservation_jours > 7 AND delai_reservation_jours <= 21 THEN '(7, 21]'
        WHEN delai_reservation_jours > 21 AND delai_reservation_jours <= 45 THEN '(21, 45]'
        WHEN delai_reservation_jours > 45 AND delai_reservation_jours <= 90 THEN '(45, 90]'
        WHEN delai_reservation_jours > 90 AND delai_reservation_jours <= 600 THEN '(90, 600]' END AS bin
      FROM train_fe)
WHERE bin IS NOT NULL AND type_acompte IS NOT NULL GROUP BY bin"""))
def eda2(spark, sf):
    return eda.rate_by_lead_x_deposit(inputs.engineered(spark, sf)[0])


@query("eda3_period_summary", with_fixture(f"""
SELECT 'train' AS jeu, count(*) AS n, {r('avg(reservation_annulee)', 6)} AS taux_annulation,
       min(date_reservation) AS debut, max(date_reservation) AS fin FROM train_raw
UNION ALL
SELECT 'test', count(*), NULL, min(date_reservation), max(date_reservation) FROM test_raw"""))
def eda3(spark, sf):
    tr, te = inputs.raw(spark, sf)
    return eda.period_summary(tr, te)


@query("eda4_target_counts", with_fixture(f"""
SELECT reservation_annulee, count(*) AS n, {r('count(*) / sum(count(*)) OVER ()', 6)} AS part
FROM train_raw GROUP BY reservation_annulee"""))
def eda4(spark, sf):
    return eda.target_counts(inputs.raw(spark, sf)[0])


@query("eda5_trivial_floors", with_fixture(f"""
SELECT {r('avg(reservation_annulee)', 6)} AS taux_annulation,
       {r('2.0E0 * avg(reservation_annulee) / (1.0E0 + avg(reservation_annulee))', 6)} AS f1_tout_annule,
       {r('1.0E0 - avg(reservation_annulee)', 6)} AS accuracy_tout_maintenu
FROM train_raw"""))
def eda5(spark, sf):
    return eda.trivial_floors(inputs.raw(spark, sf)[0])


_NULLABLE = ["marche_origine", "enfants", "prix_moyen_nuit_eur", "demandes_speciales", "agent_id"]


def _eda6_sql() -> str:
    from ..sources.schema import RESERVATION_SCHEMA, TARGET as T

    cols = [f.name for f in RESERVATION_SCHEMA.fields]
    tr = " UNION ALL ".join(
        f"SELECT '{c}' AS colonne, count(*) - count({c}) AS k, count(*) AS n FROM train_raw" for c in cols)
    te = " UNION ALL ".join(
        f"SELECT '{c}' AS colonne, count(*) - count({c}) AS k, count(*) AS n FROM test_raw" for c in cols if c != T)
    return with_fixture(f"""
SELECT a.colonne, a.k AS train_n, {r('a.k * 100.0E0 / a.n', 2)} AS train_pct, {r('b.k * 100.0E0 / b.n', 2)} AS test_pct
FROM ({tr}) a LEFT JOIN ({te}) b ON a.colonne = b.colonne WHERE a.k > 0""")


@query("eda6_null_profile", _eda6_sql())
def eda6(spark, sf):
    tr, te = inputs.raw(spark, sf)
    return eda.null_profile(tr, te)


@query("eda7_price_identity", with_fixture(f"""
SELECT count(*) AS n, {r('avg(rr)', 9)} AS ratio_moyen, {r('stddev_samp(rr)', 9)} AS ratio_ecart_type,
       {r('max(abs(rr - 1.0E0))', 9)} AS ecart_max
FROM (SELECT prix_moyen_nuit_eur / nullif(montant_total_eur / nullif(nuits*chambres*(1 - remise_pct/100.0E0), 0), 0) AS rr
      FROM train_raw WHERE prix_moyen_nuit_eur IS NOT NULL)"""))
def eda7(spark, sf):
    return eda.price_identity(inputs.raw(spark, sf)[0])


@query("eda8_9_date_weekend_identity", with_fixture(f"""
SELECT {r("avg(CASE WHEN coalesce(date_diff('day', date_reservation, date_arrivee) = delai_reservation_jours, false) THEN 1 ELSE 0 END)", 6)} AS part_delai_ok,
       {r("avg(CASE WHEN coalesce(CASE WHEN isodow(date_arrivee) IN (5, 6) THEN 1 ELSE 0 END = arrivee_weekend, false) THEN 1 ELSE 0 END)", 6)} AS part_weekend_ok
FROM train_raw"""))
def eda8_9(spark, sf):
    return eda.date_identity(inputs.raw(spark, sf)[0])


@query("eda10_region_dependency", with_fixture("""
SELECT region_hotel, count(DISTINCT ville) AS n_ville, count(DISTINCT type_destination) AS n_type_destination
FROM train_raw WHERE region_hotel IS NOT NULL GROUP BY region_hotel"""))
def eda10(spark, sf):
    return eda.functional_dependency(inputs.raw(spark, sf)[0])


@query("eda11_rate_by_channel", with_fixture(f"""
SELECT *, cast(row_number() OVER (ORDER BY taux_annulation, canal_reservation) AS int) AS ordre FROM (
SELECT canal_reservation, count(*) AS effectif, {r('avg(reservation_annulee)', 3)} AS taux_annulation
FROM train_fe WHERE canal_reservation IS NOT NULL GROUP BY canal_reservation)"""))
def eda11(spark, sf):
    rates = eda.rate_by(inputs.engineered(spark, sf)[0], "canal_reservation")
    return eda.ordered(rates, "taux_annulation", "canal_reservation")


@query("eda12_rate_by_modifications", _rate_sql("modifications_reservation"))
def eda12(spark, sf):
    return eda.rate_by(inputs.engineered(spark, sf)[0], "modifications_reservation")


@query("eda13_rate_by_requests", _rate_sql("demandes_speciales"))
def eda13(spark, sf):
    return eda.rate_by(inputs.engineered(spark, sf)[0], "demandes_speciales")


@query("eda14_rate_by_engagement", _rate_sql("score_engagement"))
def eda14(spark, sf):
    return eda.rate_by(inputs.engineered(spark, sf)[0], "score_engagement")


@query("eda15_quarterly_rate", with_fixture(f"""
SELECT last_day(s.q + INTERVAL 2 MONTH) AS trimestre, coalesce(c.effectif, 0) AS effectif,
       {r('c.m', 3)} AS taux_annulation
FROM (SELECT unnest(generate_series(min(date_trunc('quarter', date_reservation)),
                                    max(date_trunc('quarter', date_reservation)), INTERVAL 3 MONTH))::date AS q
      FROM train_fe) s
LEFT JOIN (SELECT date_trunc('quarter', date_reservation)::date AS q, count(*) AS effectif,
                  avg(reservation_annulee) AS m FROM train_fe GROUP BY 1) c ON s.q = c.q"""))
def eda15(spark, sf):
    return eda.quarterly_rate(inputs.engineered(spark, sf)[0])


_EDA16_COLS = ["region_hotel", "canal_reservation", "hotel_id", "agent_id", "marche_origine", "segment_client"]


def _eda16_sql() -> str:
    def stack(src):
        return " UNION ".join(
            f"SELECT '{c}' AS colonne, cast({c} AS varchar) AS valeur FROM {src} WHERE {c} IS NOT NULL"
            for c in _EDA16_COLS)
    return with_fixture(f"SELECT * FROM ({stack('test_clean')}) EXCEPT SELECT * FROM ({stack('train_clean')})")


@query("eda16_levels_only_in_test", _eda16_sql())
def eda16(spark, sf):
    tr, te = inputs.cleaned(spark, sf)
    return eda.unseen_levels(tr, te, _EDA16_COLS)


@query("eda17_channel_counts_after_remap", with_fixture(
    "SELECT *, cast(row_number() OVER (ORDER BY effectif DESC, canal_reservation) AS int) AS ordre FROM "
    "(SELECT canal_reservation, count(*) AS effectif FROM test_ref GROUP BY canal_reservation)",
    REF_CTES))
def eda17(spark, sf):
    from ..operators.reference import apply_reference, fit_reference

    tr, te = inputs.engineered(spark, sf)
    counts = eda.level_counts(apply_reference(te, fit_reference(tr)), "canal_reservation")
    return eda.ordered(counts, F.desc("effectif"), "canal_reservation")


_PREVIEW = ["reservation_id", "date_reservation", "region_hotel", "type_acompte", "delai_reservation_jours",
            "prix_moyen_nuit_eur", TARGET]


@query("eda18_preview", with_fixture(
    f"SELECT {', '.join(_PREVIEW)} FROM train_fe ORDER BY date_reservation, reservation_id LIMIT 5"))
def eda18(spark, sf):
    return eda.preview(inputs.engineered(spark, sf)[0], _PREVIEW)


@query("eda19_profile_rates", with_fixture(f"""
SELECT count(CASE WHEN b THEN 1 END) AS n_profil,
       {r('avg(CASE WHEN b THEN reservation_annulee END)', 6)} AS taux_profil,
       count(CASE WHEN b AND a_modifie = 1 THEN 1 END) AS n_profil_modifie,
       {r('avg(CASE WHEN b AND a_modifie = 1 THEN reservation_annulee END)', 6)} AS taux_profil_modifie
FROM (SELECT *, type_acompte = 'aucun' AND tarif_remboursable = 'oui' AND delai_reservation_jours > 90
                AND reservation_directe = 0 AS b FROM train_fe)"""))
def eda19(spark, sf):
    return eda.profile_rates(inputs.engineered(spark, sf)[0])


@query("eda20_rate_by_segment", _rate_sql("segment_client"))
def eda20(spark, sf):
    return eda.rate_by(inputs.engineered(spark, sf)[0], "segment_client")
