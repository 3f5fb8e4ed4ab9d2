"""Registered queries: error analysis, fairness (ERR1-9) and submission (SUB2-5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.columns import np_round
from ..functions.prefix import row_positions
from ..operators import errors as E
from ..operators import metrics as M
from ..operators import submission as S
from ..operators.cleaning import clean
from ..operators.features import engineer
from ..oracle_sql import r, r_py, with_fixture
from ..registry import query
from ..sources import fixture
from ..sources.schema import ERROR_COLUMNS
from .q_metrics import _ctes, best_sql, scored_oof, sweep_sql


def pooled_threshold(spark, sf) -> float:
    """Frozen decision threshold: best pooled out-of-fold F1 (one scalar on the driver)."""
    return M.best_threshold(M.sweep(scored_oof(spark, sf))).first()["seuil"]


def error_rows(spark, sf):
    """Last-fold validation rows, engineered, annotated with the error type at the frozen threshold."""
    from .inputs import fold_table

    val = fold_table(spark, sf).where((F.col("fold") == 4) & (F.col("role") == "val"))
    return E.error_frame(engineer(clean(val)), pooled_threshold(spark, sf))


def scored_test(spark, sf):
    """Test-period bookings with the stand-in probability and their position in time."""
    te = fixture.reservations(spark, sf).filter(~fixture.is_train())
    return row_positions(te, ["date_reservation", "reservation_id"], name="pos")


ERR_CTES = f"""
sw_ AS ({sweep_sql('oof', [])}),
bt_ AS ({best_sql('sw_', [])}),
err AS (
  SELECT f.*, s.proba, f.reservation_annulee AS y_reel,
         CASE WHEN s.proba >= (SELECT seuil FROM bt_) THEN 1 ELSE 0 END AS y_predit,
         CASE WHEN f.reservation_annulee = 1 AND s.proba >= (SELECT seuil FROM bt_) THEN 'vrai positif'
              WHEN f.reservation_annulee = 0 AND s.proba >= (SELECT seuil FROM bt_) THEN 'faux positif'
              WHEN f.reservation_annulee = 1 THEN 'faux négatif' ELSE 'vrai négatif' END AS type_erreur
  FROM assigned a JOIN train_fe f ON a.reservation_id = f.reservation_id
  JOIN res s ON a.reservation_id = s.reservation_id
  WHERE a.fold = 4 AND a.role = 'val'),
test_sc AS (
  SELECT *, row_number() OVER (ORDER BY date_reservation, reservation_id) - 1 AS pos
  FROM res WHERE date_reservation >= DATE '2000-04-01'),
sub AS (
  SELECT reservation_id, {r('proba', 6)} AS probabilite_annulation,
         CASE WHEN proba >= (SELECT seuil FROM bt_) THEN 1 ELSE 0 END AS reservation_annulee, pos
  FROM test_sc)
"""


def _group_body(col: str) -> str:
    return f"""
SELECT {col}, effectif, {r_py('rate', 3)} AS taux_annulation_reel,
  {r_py('coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0E0)', 3)} AS f1,
  {r_py('coalesce(tp / nullif(tp + fp, 0), 0.0E0)', 3)} AS precision,
  {r_py('coalesce(tp / nullif(tp + fn, 0), 0.0E0)', 3)} AS rappel
FROM (SELECT {col}, count(*) AS effectif, avg(y_reel) AS rate,
             cast(sum(y_reel * y_predit) AS double) AS tp, cast(sum((1 - y_reel) * y_predit) AS double) AS fp,
             cast(sum(y_reel * (1 - y_predit)) AS double) AS fn
      FROM err WHERE {col} IS NOT NULL GROUP BY {col}) WHERE effectif >= 60"""


def _group_sql(col: str) -> str:
    return with_fixture(_group_body(col), _ctes(ERR_CTES))


@query("err1_error_frame", with_fixture(
    "SELECT reservation_id, proba, y_reel, y_predit, type_erreur FROM err", _ctes(ERR_CTES)))
def err1(spark, sf):
    return error_rows(spark, sf).select("reservation_id", "proba", "y_reel", "y_predit", "type_erreur")


@query("err2_error_counts", with_fixture(
    "SELECT type_erreur, count(*) AS n FROM err GROUP BY type_erreur", _ctes(ERR_CTES)))
def err2(spark, sf):
    return E.error_counts(error_rows(spark, sf))


@query("err3_perf_by_region", _group_sql("region_hotel"))
def err3(spark, sf):
    return E.group_performance(error_rows(spark, sf), "region_hotel")


@query("err3_perf_by_destination", _group_sql("type_destination"))
def err3_dest(spark, sf):
    return E.group_performance(error_rows(spark, sf), "type_destination")


@query("err3_perf_by_city_min60", _group_sql("ville"))
def err3_city(spark, sf):
    return E.group_performance(error_rows(spark, sf), "ville")


@query("err4_perf_by_segment", _group_sql("segment_client"))
def err4(spark, sf):
    return E.group_performance(error_rows(spark, sf), "segment_client")


@query("err5_rate_f1_correlation", with_fixture(
    f"SELECT {r('corr(taux_annulation_reel, f1)', 9)} AS correlation FROM ({_group_body('ville')})", _ctes(ERR_CTES)))
def err5(spark, sf):
    perf = E.group_performance(error_rows(spark, sf), "ville")
    return E.rate_f1_correlation(perf).select(np_round("correlation", 9).alias("correlation"))


_TOP_SQL = ", ".join(ERROR_COLUMNS)


@query("err6_top5_false_positives", with_fixture(
    f"SELECT {_TOP_SQL} FROM err WHERE type_erreur = 'faux positif' "
    "ORDER BY proba DESC, date_reservation, reservation_id LIMIT 5", _ctes(ERR_CTES)))
def err6(spark, sf):
    return E.top_errors(error_rows(spark, sf), E.FP)


@query("err7_top5_false_negatives", with_fixture(
    f"SELECT {_TOP_SQL} FROM err WHERE type_erreur = 'faux négatif' "
    "ORDER BY proba ASC, date_reservation, reservation_id LIMIT 5", _ctes(ERR_CTES)))
def err7(spark, sf):
    return E.top_errors(error_rows(spark, sf), E.FN)


@query("err8_class_histogram", with_fixture("""
SELECT sp.classe, sp.bin, sp.bin * ((sp.hi - sp.lo) / 30.0E0) + sp.lo AS borne_basse,
       CASE WHEN sp.bin + 1 = 30 THEN sp.hi ELSE (sp.bin + 1) * ((sp.hi - sp.lo) / 30.0E0) + sp.lo END AS borne_haute,
       coalesce(c.n, 0) AS n
FROM (SELECT g.classe, g.lo, g.hi, cast(b.bin AS int) AS bin FROM rng g, range(30) b(bin)) sp
LEFT JOIN (
  SELECT classe, i3 AS bin2, count(*) AS n FROM (
    SELECT *, CASE WHEN x >= (CASE WHEN i2 + 1 = 30 THEN hi ELSE (i2 + 1) * ((hi - lo) / 30.0E0) + lo END) AND i2 <> 29
                   THEN i2 + 1 ELSE i2 END AS i3 FROM (
      SELECT *, CASE WHEN x < (CASE WHEN i1 = 30 THEN hi ELSE i1 * ((hi - lo) / 30.0E0) + lo END) THEN i1 - 1 ELSE i1 END AS i2
      FROM (SELECT e.y_reel AS classe, e.proba AS x, g.lo, g.hi,
                   CASE WHEN cast(trunc((e.proba - g.lo) / (g.hi - g.lo) * 30.0E0) AS bigint) = 30 THEN 29
                        ELSE cast(trunc((e.proba - g.lo) / (g.hi - g.lo) * 30.0E0) AS bigint) END AS i1
            FROM err e JOIN rng g ON e.y_reel = g.classe)))
  GROUP BY classe, i3) c ON sp.classe = c.classe AND sp.bin = c.bin2""", _ctes(ERR_CTES + """,
rng AS (SELECT classe, CASE WHEN a = b THEN a - 0.5E0 ELSE a END AS lo, CASE WHEN a = b THEN b + 0.5E0 ELSE b END AS hi
        FROM (SELECT y_reel AS classe, min(proba) AS a, max(proba) AS b FROM err GROUP BY y_reel))""")))
def err8(spark, sf):
    return E.class_histogram(error_rows(spark, sf))


@query("err9_median_lead_by_error_type", with_fixture("""
SELECT l.ordre, l.type_erreur, m.delai_median
FROM (VALUES (0, 'vrai positif'), (1, 'faux positif'), (2, 'faux négatif'), (3, 'vrai négatif')) l(ordre, type_erreur)
LEFT JOIN (SELECT type_erreur, median(delai_reservation_jours) AS delai_median FROM err GROUP BY type_erreur) m
ON l.type_erreur = m.type_erreur""", _ctes(ERR_CTES)))
def err9(spark, sf):
    return E.median_lead_by_error(error_rows(spark, sf))


# ------------------------------------------------------------------ submission
@query("sub2_submission", with_fixture(
    "SELECT reservation_id, probabilite_annulation, reservation_annulee FROM sub", _ctes(ERR_CTES)))
def sub2(spark, sf):
    return S.submission(scored_test(spark, sf), pooled_threshold(spark, sf)).drop("pos")


@query("sub3_contract_checks", with_fixture("""
SELECT count(s.reservation_id) AS n_lignes, count(t.reservation_id) AS n_attendu,
  count(CASE WHEN s.reservation_id IS NULL THEN 1 END) AS n_ids_manquants,
  count(CASE WHEN t.reservation_id IS NULL THEN 1 END) AS n_ids_en_trop,
  count(CASE WHEN s.pos <> t.pos THEN 1 END) AS n_ordre_faux,
  count(CASE WHEN NOT (s.probabilite_annulation BETWEEN 0.0 AND 1.0) THEN 1 END) AS n_proba_hors_bornes,
  count(CASE WHEN s.reservation_annulee NOT IN (0, 1) THEN 1 END) AS n_decision_invalide,
  true AS colonnes_ok,
  count(s.reservation_id) = count(t.reservation_id) AND count(CASE WHEN s.reservation_id IS NULL THEN 1 END) = 0
  AND count(CASE WHEN t.reservation_id IS NULL THEN 1 END) = 0 AND count(CASE WHEN s.pos <> t.pos THEN 1 END) = 0
  AND count(CASE WHEN NOT (s.probabilite_annulation BETWEEN 0.0 AND 1.0) THEN 1 END) = 0
  AND count(CASE WHEN s.reservation_annulee NOT IN (0, 1) THEN 1 END) = 0 AS conforme
FROM sub s FULL OUTER JOIN (SELECT reservation_id, pos FROM test_sc) t ON s.reservation_id = t.reservation_id""",
    _ctes(ERR_CTES)))
def sub3(spark, sf):
    """The submission as written (SNK2) and read again, against the template file: the order is that of two files."""
    from ..sources.readers import read_template
    from .q_data import csv_copies

    written = read_template(spark, _submission_file(spark, sf), position="pos")
    return S.contract_checks(written, S.template_from(read_template(spark, csv_copies(spark, sf, ["template_csv"])["template_csv"], position="pos")))


def _submission_file(spark, sf) -> str:
    """The stand-in scores of the test file's bookings, submitted in that file's order (SNK2); returns the path."""
    from ..sources.readers import read_csv
    from ..sources.schema import ID_COL, TEST_SCHEMA
    from ..sources.sinks import write_ordered
    from . import store
    from .q_data import csv_copies

    path = store.path_for(spark, "submission", "submission-v1", sf)
    if not store.exists(spark, path):
        test = read_csv(spark, csv_copies(spark, sf, ["test_csv"])["test_csv"], TEST_SCHEMA, position="pos").select(ID_COL, "pos")
        proba = fixture.reservations(spark, sf).filter(~fixture.is_train()).select(ID_COL, "proba")
        write_ordered(S.submission(test.join(proba, ID_COL), pooled_threshold(spark, sf)), path)
    return path


@query("snk2_submission_in_file_order", with_fixture(
    "SELECT s.reservation_id, s.probabilite_annulation, s.reservation_annulee, "
    "row_number() OVER (ORDER BY md5(s.reservation_id)) - 1 AS pos FROM sub s", _ctes(ERR_CTES)))
def snk2(spark, sf):
    from ..sources.readers import read_template

    return read_template(spark, _submission_file(spark, sf), position="pos")


@query("sub4_test_alert_rate", with_fixture(
    f"SELECT {r('avg(reservation_annulee)', 6)} AS taux_alerte, {r('avg(probabilite_annulation)', 6)} AS proba_moyenne "
    "FROM sub", _ctes(ERR_CTES)))
def sub4(spark, sf):
    return S.test_summary(S.submission(scored_test(spark, sf), pooled_threshold(spark, sf)))


@query("sub5_expected_cancellations_by_arrival", with_fixture(
    f"SELECT date_arrivee, count(*) AS reservations, {r('sum(proba)', 6)} AS annulations_attendues "
    "FROM test_sc GROUP BY date_arrivee", _ctes(ERR_CTES)))
def sub5(spark, sf):
    return S.expected_cancellations(scored_test(spark, sf))
