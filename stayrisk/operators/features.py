"""Row-level features (FE1-18): one narrow projection, no learned parameter."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import flag, map_values, safe_div
from ..sources.schema import DEPOSIT_ORDER


def engineer(df: DataFrame) -> DataFrame:
    """Add the row-wise features to a cleaned booking table."""
    c = F.col
    resa, annul = c("reservations_passees"), c("annulations_passees")
    d = df.select(
        "*",
        # FE1-2 customer history
        F.coalesce(safe_div(annul, F.when(resa > 0, resa)), F.lit(0.0)).alias("taux_annulation_passe"),
        flag(resa == 0).alias("sans_historique"),
        # FE3 stay composition
        (c("adultes") + c("enfants")).alias("personnes"),
        # FE8-9 commercial engagement
        map_values("type_acompte", DEPOSIT_ORDER).cast("double").alias("acompte_ord"),
        flag(c("tarif_remboursable") == "oui").alias("remboursable"),
        # FE12 calendar
        F.month("date_arrivee").alias("mois_arrivee"),
        F.month("date_reservation").alias("mois_reservation"),
        # FE14 log lead time
        F.log1p(c("delai_reservation_jours")).alias("log_delai"),
        # FE16 behaviour
        flag(c("modifications_reservation") > 0).alias("a_modifie"),
    )
    pers = c("personnes")
    two_pi = F.lit(2 * math.pi)
    d = d.select(
        "*",
        safe_div(pers, c("chambres")).alias("personnes_par_chambre"),  # FE4
        flag(c("enfants") > 0).alias("avec_enfants"),  # FE5
        safe_div(c("montant_total_eur"), F.when(pers.isNotNull(), F.greatest(pers, F.lit(1.0)))).alias(
            "prix_par_personne"),  # FE6
        safe_div(c("montant_total_eur"), c("nuits")).alias("montant_par_nuit"),  # FE7
        (c("acompte_ord") - c("remboursable")).alias("score_engagement"),  # FE10
        flag((c("acompte_ord") == 0) & (c("remboursable") == 1)).alias("flexibilite_totale"),  # FE11
        F.sin(two_pi * c("mois_arrivee") / F.lit(12)).alias("sin_mois"),  # FE13
        F.cos(two_pi * c("mois_arrivee") / F.lit(12)).alias("cos_mois"),
        safe_div(c("delai_reservation_jours"), c("nuits")).alias("delai_par_nuit"),  # FE15
    )
    ld = c("log_delai")
    return d.select(  # FE17 explicit interactions
        "*",
        (ld * c("acompte_ord")).alias("ix_delai_acompte"),
        (ld * c("remboursable")).alias("ix_delai_remb"),
        (ld * c("reservation_directe")).alias("ix_delai_direct"),
        (c("remboursable") * c("acompte_ord")).alias("ix_remb_acompte"),
        (ld * c("a_modifie")).alias("ix_delai_modif"),
        (ld * c("demandes_speciales")).alias("ix_delai_dem"),
    )


def build_matrix(df: DataFrame, numeric: Sequence[str], categorical: Sequence[str]) -> DataFrame:
    """FE18: the model input columns of an engineered table (column pruning reaches the scan)."""
    return df.select(*numeric, *categorical)
