"""Registered queries: sources, cleaning, row features, reference statistics, folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..oracle_sql import with_fixture
from ..registry import query
from ..sources.schema import CATEGORICAL, RAW_NUMERIC
from . import inputs


@query("src1_reservations", with_fixture("SELECT * FROM res"))
def src1_reservations(spark, sf):
    from ..sources.fixture import reservations

    return reservations(spark, sf)


@query("cln_clean_train", with_fixture("SELECT * FROM train_clean"))
def cln_clean_train(spark, sf):
    return inputs.cleaned(spark, sf)[0]


@query("cln_clean_test", with_fixture("SELECT * FROM test_clean"))
def cln_clean_test(spark, sf):
    return inputs.cleaned(spark, sf)[1]


# log1p / sin / cos can differ from the oracle's ln(1 + x) in the last bit: compared at 9 decimals
TRANSCENDENTAL = ["log_delai", "ix_delai_acompte", "ix_delai_remb", "ix_delai_direct", "ix_delai_modif",
                  "ix_delai_dem", "sin_mois", "cos_mois"]


def _round_transcendental(df):
    from ..functions.columns import np_round

    return df.select(*[np_round(c, 9).alias(c) if c in TRANSCENDENTAL else F.col(c) for c in df.columns])


def _round_transcendental_sql(src: str) -> str:
    from ..oracle_sql import r

    return "SELECT * REPLACE (" + ", ".join(f"{r(c, 9)} AS {c}" for c in TRANSCENDENTAL) + f") FROM {src}"


@query("fe_all_rowwise", with_fixture(_round_transcendental_sql("train_fe")))
def fe_all_rowwise(spark, sf):
    return _round_transcendental(inputs.engineered(spark, sf)[0])


# ---------------------------------------------------------------- reference
REF_CTES = """
ref_hotel AS (SELECT hotel_id, median(prix_moyen_nuit_eur) AS prix_ref_hotel
              FROM train_fe WHERE hotel_id IS NOT NULL GROUP BY hotel_id),
ref_season AS (SELECT region_hotel, mois_arrivee, median(prix_moyen_nuit_eur) AS prix_ref_saison
               FROM train_fe WHERE region_hotel IS NOT NULL AND mois_arrivee IS NOT NULL
               GROUP BY region_hotel, mois_arrivee),
ref_global AS (SELECT median(prix_moyen_nuit_eur) AS prix_ref_global FROM train_fe),
ref_cats AS (
  SELECT DISTINCT colonne, valeur FROM (
    SELECT 'type_acompte' AS colonne, cast(type_acompte AS varchar) AS valeur FROM train_fe UNION ALL
    SELECT 'tarif_remboursable', cast(tarif_remboursable AS varchar) FROM train_fe UNION ALL
    SELECT 'canal_reservation', cast(canal_reservation AS varchar) FROM train_fe UNION ALL
    SELECT 'segment_client', cast(segment_client AS varchar) FROM train_fe UNION ALL
    SELECT 'marche_origine', cast(marche_origine AS varchar) FROM train_fe UNION ALL
    SELECT 'moyen_transport', cast(moyen_transport AS varchar) FROM train_fe UNION ALL
    SELECT 'formule_repas', cast(formule_repas AS varchar) FROM train_fe UNION ALL
    SELECT 'client_type', cast(client_type AS varchar) FROM train_fe UNION ALL
    SELECT 'region_hotel', cast(region_hotel AS varchar) FROM train_fe UNION ALL
    SELECT 'categorie_hotel', cast(categorie_hotel AS varchar) FROM train_fe)
),
test_rel AS (
  SELECT t.*,
    t.prix_moyen_nuit_eur / nullif(coalesce(h.prix_ref_hotel, g.prix_ref_global), 0) AS prix_relatif_hotel,
    t.prix_moyen_nuit_eur / nullif(coalesce(s.prix_ref_saison, g.prix_ref_global), 0) AS prix_relatif_saison
  FROM test_fe t
  LEFT JOIN ref_hotel h ON t.hotel_id = h.hotel_id
  LEFT JOIN ref_season s ON t.region_hotel = s.region_hotel AND t.mois_arrivee = s.mois_arrivee
  CROSS JOIN ref_global g
),
test_ref AS (
  SELECT * REPLACE (
""" + ",\n".join(
    f"    CASE WHEN cast({c} AS varchar) IN (SELECT valeur FROM ref_cats WHERE colonne = '{c}') "
    f"THEN cast({c} AS varchar) ELSE 'AUTRE' END AS {c}"
    for c in ["type_acompte", "tarif_remboursable", "canal_reservation", "segment_client", "marche_origine",
              "moyen_transport", "formule_repas", "client_type", "region_hotel", "categorie_hotel"]
) + """)
  FROM test_rel
)
"""


def _ref(spark, sf):
    from ..operators.reference import fit_reference

    tr, te = inputs.engineered(spark, sf)
    return fit_reference(tr), tr, te


@query("ref1_median_price_by_hotel", with_fixture("SELECT * FROM ref_hotel", REF_CTES))
def ref1(spark, sf):
    from ..operators.reference import hotel_medians

    return hotel_medians(inputs.engineered(spark, sf)[0])


@query("ref2_median_price_by_region_month", with_fixture("SELECT * FROM ref_season", REF_CTES))
def ref2(spark, sf):
    from ..operators.reference import season_medians

    return season_medians(inputs.engineered(spark, sf)[0])


@query("ref3_global_median", with_fixture("SELECT * FROM ref_global", REF_CTES))
def ref3(spark, sf):
    from ..operators.reference import global_median

    return global_median(inputs.engineered(spark, sf)[0])


@query("ref4_known_categories", with_fixture("SELECT * FROM ref_cats", REF_CTES))
def ref4(spark, sf):
    from ..operators.reference import known_categories

    return known_categories(inputs.engineered(spark, sf)[0])


@query("ref5_price_vs_hotel", with_fixture(
    "SELECT reservation_id, prix_relatif_hotel FROM test_rel", REF_CTES))
def ref5(spark, sf):
    from ..operators.reference import relative_prices

    ref, _, te = _ref(spark, sf)
    return relative_prices(te, ref).select("reservation_id", "prix_relatif_hotel")


@query("ref6_price_vs_season", with_fixture(
    "SELECT reservation_id, prix_relatif_saison FROM test_rel", REF_CTES))
def ref6(spark, sf):
    from ..operators.reference import relative_prices

    ref, _, te = _ref(spark, sf)
    return relative_prices(te, ref).select("reservation_id", "prix_relatif_saison")


@query("ref7_unseen_to_autre", with_fixture(
    "SELECT reservation_id, canal_reservation, region_hotel, categorie_hotel, client_type, marche_origine "
    "FROM test_ref", REF_CTES))
def ref7(spark, sf):
    from ..operators.reference import remap_unseen

    ref, _, te = _ref(spark, sf)
    return remap_unseen(te, ref).select(
        "reservation_id", "canal_reservation", "region_hotel", "categorie_hotel", "client_type", "marche_origine")


@query("ref8_fit_apply_test", with_fixture(_round_transcendental_sql("test_ref"), REF_CTES))
def ref8(spark, sf):
    from ..operators.reference import apply_reference

    ref, _, te = _ref(spark, sf)
    return _round_transcendental(apply_reference(te, ref))


# ---------------------------------------------------------------- folds
FOLD_CTES = """
pos_t AS (SELECT *, row_number() OVER (ORDER BY date_reservation, reservation_id) - 1 AS pos,
                 count(*) OVER () AS n_all FROM train_clean),
bounds AS (
  SELECT cast(i + 1 AS int) AS fold,
         cast(floor(n * (1 - 0.15E0 * (3 - i))) AS bigint) - cast(floor(n * 0.15E0) AS bigint) AS start_pos,
         cast(floor(n * (1 - 0.15E0 * (3 - i))) AS bigint) AS end_pos
  FROM (SELECT count(*) AS n FROM train_clean), range(4) r(i)
),
assigned AS (
  SELECT p.*, b.fold, CASE WHEN p.pos < b.start_pos THEN 'train' ELSE 'val' END AS role
  FROM pos_t p JOIN bounds b ON p.pos < b.end_pos
)
"""


@query("fld1_temporal_folds", with_fixture(
    "SELECT reservation_id, pos, fold, role FROM assigned", FOLD_CTES))
def fld1(spark, sf):
    from ..operators.folds import ORDER, assign_folds, with_positions

    positioned = with_positions(inputs.cleaned(spark, sf)[0].select(*ORDER)).checkpoint()  # counted, then assigned
    return assign_folds(positioned, positioned.count()).select("reservation_id", "pos", "fold", "role")


@query("fld1_folds_by_boundary_keys", with_fixture(
    "SELECT reservation_id, fold, role, reservation_annulee AS y FROM assigned", FOLD_CTES))
def fld1_keys(spark, sf):
    from ..operators.folds import temporal_folds

    return temporal_folds(inputs.cleaned(spark, sf)[0]).select("reservation_id", "fold", "role", F.col("reservation_annulee").alias("y"))


@query("fld2_fold_bounds", with_fixture("""
SELECT fold AS pli,
  min(CASE WHEN role='train' THEN date_reservation END) AS train_debut,
  max(CASE WHEN role='train' THEN date_reservation END) AS train_fin,
  count(CASE WHEN role='train' THEN 1 END) AS n_train,
  min(CASE WHEN role='val' THEN date_reservation END) AS val_debut,
  max(CASE WHEN role='val' THEN date_reservation END) AS val_fin,
  count(CASE WHEN role='val' THEN 1 END) AS n_val,
  round_even(avg(CASE WHEN role='val' THEN reservation_annulee END) * 1E4, 0) / 1E4 AS taux_annulation_val
FROM assigned GROUP BY fold""", FOLD_CTES))
def fld2(spark, sf):
    from ..operators.folds import fold_dates, temporal_folds

    return fold_dates(temporal_folds(inputs.cleaned(spark, sf)[0]))


_FLD3_SQL = """
SELECT reservation_id, reservation_annulee AS y,
       cast((row_number() OVER (PARTITION BY reservation_annulee ORDER BY md5(concat(reservation_id, ':42')), reservation_id) - 1) % 5 + 1 AS int) AS fold
FROM train_clean"""


@query("fld3_stratified_folds", with_fixture(_FLD3_SQL))
def fld3_rows(spark, sf):
    from ..operators.folds import stratified_folds

    return stratified_folds(inputs.cleaned(spark, sf)[0]).select("reservation_id", F.col("reservation_annulee").alias("y"), "fold")


@query("fld3_stratified_fold_counts", with_fixture(f"SELECT fold, y, count(*) AS n FROM ({_FLD3_SQL}) GROUP BY fold, y"))
def fld3(spark, sf):
    return fld3_rows(spark, sf).groupBy("fold", "y").agg(F.count(F.lit(1)).alias("n"))


@query("fld4_order_check", with_fixture("""
SELECT count(*) AS n_rows, count(CASE WHEN date_reservation < prev THEN 1 END) AS n_violations,
       count(CASE WHEN date_reservation < prev THEN 1 END) = 0 AS monotone
FROM (SELECT date_reservation, lag(date_reservation) OVER (ORDER BY reservation_id) AS prev FROM train_clean)"""))
def fld4(spark, sf):
    from ..operators.folds import order_violations

    return order_violations(inputs.cleaned(spark, sf)[0])


@query("fe18_model_matrix", with_fixture(f"SELECT {', '.join([*RAW_NUMERIC, *CATEGORICAL])} FROM train_fe"))
def fe18(spark, sf):
    from ..operators.features import build_matrix

    return build_matrix(inputs.engineered(spark, sf)[0], RAW_NUMERIC, CATEGORICAL)


# ---------------------------------------------------------------- sources and sinks
def _io_path(spark, sf, name):
    import hashlib

    from ..session import ensure_checkpoint_dir

    from .store import identity

    tag = hashlib.sha1(f"io-v3:{identity(spark, sf)}".encode()).hexdigest()[:16]
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/stayrisk-io/{tag}/{name}"


#: Order of the test file and its template: not that of time, so that only the files tell it.
TEST_FILE_ORDER = "md5(reservation_id)"


def csv_copies(spark, sf, names=("train_csv", "test_csv", "template_csv")):
    """Those of raw train/test and the template that are named as CSV (SNK2), once per checkpoint folder; returns their paths.

    The train file is in time order, the test file and the template in an order of their own.
    """
    from ..sources.fixture import _written
    from ..sources.sinks import write_ordered

    tr, te = inputs.raw(spark, sf)
    template = te.select("reservation_id", F.lit(0.5).alias("probabilite_annulation"), F.lit(0).alias("reservation_annulee"))
    by_time, own = F.struct("date_reservation", "reservation_id"), F.expr(TEST_FILE_ORDER)
    paths = {}
    for name, df, order in (("train_csv", tr, by_time), ("test_csv", te, own), ("template_csv", template, own)):
        if name not in names:
            continue
        p = _io_path(spark, sf, name)
        if not _written(spark, p):
            write_ordered(df.withColumn("pos", order), p)
        paths[name] = p
    return paths


@query("src1_csv_scan", with_fixture("SELECT * FROM train_raw"))
def src1_csv(spark, sf):
    from ..sources.readers import read_csv

    return read_csv(spark, csv_copies(spark, sf, ["train_csv"])["train_csv"])


@query("src2_load_train_test", with_fixture("SELECT * EXCLUDE (n_all) FROM pos_t", FOLD_CTES))
def src2(spark, sf):
    from ..sources.readers import load_train_test

    p = csv_copies(spark, sf, ["train_csv", "test_csv"])
    return load_train_test(spark, p["train_csv"], p["test_csv"])[0]


@query("src2_load_both_sets", with_fixture(
    "SELECT 'train' AS jeu, * EXCLUDE (n_all) FROM pos_t UNION ALL BY NAME SELECT 'test' AS jeu, *, "
    f"row_number() OVER (ORDER BY {TEST_FILE_ORDER}) - 1 AS pos FROM test_clean", FOLD_CTES))
def src2_both(spark, sf):
    from ..sources.readers import load_train_test

    p = csv_copies(spark, sf, ["train_csv", "test_csv"])
    tr, te = load_train_test(spark, p["train_csv"], p["test_csv"])
    return tr.withColumn("jeu", F.lit("train")).unionByName(te.withColumn("jeu", F.lit("test")), allowMissingColumns=True)


@query("src2_parquet_file_order", with_fixture(
    f"SELECT reservation_id, row_number() OVER (ORDER BY {TEST_FILE_ORDER}) - 1 AS pos FROM test_raw"))
def src2_parquet(spark, sf):
    """File order of a Parquet copy, from the row numbers its files carry."""
    from ..sources.fixture import _written
    from ..sources.readers import read_parquet
    from ..sources.schema import TEST_SCHEMA
    from ..sources.sinks import write_ordered

    p = _io_path(spark, sf, "test_parquet")
    if not _written(spark, p):
        write_ordered(inputs.raw(spark, sf)[1].withColumn("pos", F.expr(TEST_FILE_ORDER)), p, fmt="parquet")
    return read_parquet(spark, p, TEST_SCHEMA, position="pos").select("reservation_id", "pos")


@query("src3_template_scan", with_fixture(
    "SELECT reservation_id, 0.5E0 AS probabilite_annulation, 0 AS reservation_annulee FROM test_raw"))
def src3(spark, sf):
    from ..sources.readers import read_template

    return read_template(spark, csv_copies(spark, sf, ["template_csv"])["template_csv"])


@query("src3_template_file_order", with_fixture(
    f"SELECT reservation_id, row_number() OVER (ORDER BY {TEST_FILE_ORDER}) - 1 AS pos FROM test_raw"))
def src3_order(spark, sf):
    from ..sources.readers import read_template

    return read_template(spark, csv_copies(spark, sf, ["template_csv"])["template_csv"], position="pos").select("reservation_id", "pos")
