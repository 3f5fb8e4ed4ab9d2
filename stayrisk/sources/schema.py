"""Explicit schema of the reservation table and the fixed column lists.

Everything below the "fixed values" banner must equal the names and lists the
original pipeline uses, otherwise feature sets and reports stop lining up.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --------------------------------------------------------------------------
# Fixed values (must match the original data dictionary and column lists)
# --------------------------------------------------------------------------
TARGET = "reservation_annulee"
ID_COL = "reservation_id"
DATE_COLS = ["date_reservation", "date_arrivee"]

RESERVATION_SCHEMA = T.StructType([
    T.StructField("reservation_id", T.StringType(), False),
    T.StructField("date_reservation", T.DateType(), True),
    T.StructField("date_arrivee", T.DateType(), True),
    T.StructField("region_hotel", T.StringType(), True),
    T.StructField("ville", T.StringType(), True),
    T.StructField("type_destination", T.StringType(), True),
    T.StructField("hotel_id", T.StringType(), True),
    T.StructField("categorie_hotel", T.IntegerType(), True),
    T.StructField("segment_client", T.StringType(), True),
    T.StructField("marche_origine", T.StringType(), True),
    T.StructField("canal_reservation", T.StringType(), True),
    T.StructField("moyen_transport", T.StringType(), True),
    T.StructField("delai_reservation_jours", T.IntegerType(), True),
    T.StructField("nuits", T.IntegerType(), True),
    T.StructField("adultes", T.IntegerType(), True),
    T.StructField("enfants", T.IntegerType(), True),
    T.StructField("chambres", T.IntegerType(), True),
    T.StructField("formule_repas", T.StringType(), True),
    T.StructField("tarif_remboursable", T.StringType(), True),
    T.StructField("type_acompte", T.StringType(), True),
    T.StructField("prix_moyen_nuit_eur", T.DoubleType(), True),
    T.StructField("remise_pct", T.IntegerType(), True),
    T.StructField("montant_total_eur", T.DoubleType(), True),
    T.StructField("client_type", T.StringType(), True),
    T.StructField("reservations_passees", T.IntegerType(), True),
    T.StructField("annulations_passees", T.IntegerType(), True),
    T.StructField("demandes_speciales", T.IntegerType(), True),
    T.StructField("modifications_reservation", T.IntegerType(), True),
    T.StructField("jours_liste_attente", T.IntegerType(), True),
    T.StructField("evenement_majeur", T.IntegerType(), True),
    T.StructField("haute_saison_regionale", T.IntegerType(), True),
    T.StructField("arrivee_weekend", T.IntegerType(), True),
    T.StructField("agent_id", T.StringType(), True),
    T.StructField("reservation_annulee", T.IntegerType(), True),
])

TEST_SCHEMA = T.StructType([f for f in RESERVATION_SCHEMA.fields if f.name != TARGET])

SUBMISSION_SCHEMA = T.StructType([
    T.StructField("reservation_id", T.StringType(), False),
    T.StructField("probabilite_annulation", T.DoubleType(), True),
    T.StructField("reservation_annulee", T.IntegerType(), True),
])

# Categorical inputs of every model (ville and type_destination are left out).
CATEGORICAL = [
    "type_acompte",
    "tarif_remboursable",
    "canal_reservation",
    "segment_client",
    "marche_origine",
    "moyen_transport",
    "formule_repas",
    "client_type",
    "region_hotel",
    "categorie_hotel",
]

# Raw numeric columns (baseline model).
RAW_NUMERIC = [
    "delai_reservation_jours", "nuits", "adultes", "enfants", "chambres",
    "prix_moyen_nuit_eur", "remise_pct", "montant_total_eur", "reservations_passees",
    "annulations_passees", "demandes_speciales", "modifications_reservation",
    "jours_liste_attente", "evenement_majeur", "haute_saison_regionale",
    "arrivee_weekend",
]
MISSING_FLAGS = ["prix_impute", "enfants_manquant", "demandes_manquant", "reservation_directe"]
HISTORY = ["taux_annulation_passe", "sans_historique"]
STAY = ["personnes", "personnes_par_chambre", "avec_enfants", "prix_par_personne", "montant_par_nuit"]
TIME = ["log_delai", "delai_par_nuit", "sin_mois", "cos_mois"]
RELATIVE_PRICE = ["prix_relatif_hotel", "prix_relatif_saison"]
ENGAGEMENT = ["score_engagement", "flexibilite_totale", "a_modifie"]
INTERACTIONS = ["ix_delai_acompte", "ix_delai_remb", "ix_delai_direct",
                "ix_remb_acompte", "ix_delai_modif", "ix_delai_dem"]

# Numeric inputs of the enriched models (36 columns, ablation set G).
MODEL_NUMERIC = RAW_NUMERIC + MISSING_FLAGS + HISTORY + STAY + TIME + RELATIVE_PRICE + ENGAGEMENT

# Cumulative ablation configurations (name, numeric columns).
ABLATION_CONFIGS = [
    ("A. Variables brutes (baseline)", RAW_NUMERIC),
    ("B. + indicateurs de manque", RAW_NUMERIC + MISSING_FLAGS),
    ("C. + historique client", RAW_NUMERIC + MISSING_FLAGS + HISTORY),
    ("D. + composition du séjour", RAW_NUMERIC + MISSING_FLAGS + HISTORY + STAY),
    ("E. + transformations temporelles", RAW_NUMERIC + MISSING_FLAGS + HISTORY + STAY + TIME),
    ("F. + prix relatifs", RAW_NUMERIC + MISSING_FLAGS + HISTORY + STAY + TIME + RELATIVE_PRICE),
    ("G. + score d'engagement", MODEL_NUMERIC),
    ("H. + interactions explicites", MODEL_NUMERIC + INTERACTIONS),
]

# Deposit type -> ordinal.
DEPOSIT_ORDER = {"aucun": 0, "partiel": 1, "total": 2}

# Temporal protocol and threshold grid (lo, hi, count).
N_FOLDS = 4
VAL_FRACTION = 0.15
THRESHOLD_GRID = (0.05, 0.95, 181)
SEED = 42

# Unseen-category fallback, cleaning fill values.
UNSEEN = "AUTRE"
UNKNOWN_MARKET = "Inconnu"
DIRECT_AGENT = "DIRECT"

# Right-closed lead-time bins of the EDA table, calibration bins, risk tiers.
LEAD_BINS = [0, 7, 21, 45, 90, 600]
CALIBRATION_BINS = [0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 1.0]
RISK_TIERS = [("vert", 0.0, 0.20), ("orange", 0.20, 0.40), ("rouge", 0.40, 1.01)]

# Error-type labels, in report order.
ERROR_TYPES = ["vrai positif", "faux positif", "faux négatif", "vrai négatif"]

# Business cost weights (missed cancellation, useless alert).
COST_FN = 1.0
COST_FP = 0.25

# Columns shown in the top-5 error tables.
ERROR_COLUMNS = [
    "reservation_id", "proba", "delai_reservation_jours", "type_acompte",
    "tarif_remboursable", "canal_reservation", "segment_client", "nuits",
    "montant_total_eur", "demandes_speciales", "modifications_reservation",
]

# Model names and ensemble weights.
MODEL_BASELINE = "Régression logistique — baseline"
MODEL_LOGREG = "Régression logistique + FE"
MODEL_RF = "Forêt aléatoire"
MODEL_HGB = "HistGradientBoosting"
MODEL_LGBM = "LightGBM"
MODEL_ENSEMBLE = "Ensemble (final)"
ENSEMBLE_RAW_WEIGHTS = {MODEL_LOGREG: 0.50, MODEL_HGB: 0.25, MODEL_LGBM: 0.25}

# Nullable columns (profiled by the null report).
NA_STRINGS = ["", "NA", "N/A", "NaN", "nan", "-NaN", "-nan", "NULL", "null", "None",
              "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "1.#IND", "1.#QNAN", "<NA>", "n/a"]
