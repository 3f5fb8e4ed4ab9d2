"""Deterministic row-wise cleaning (CLN1-6): no statistic is learned here.

Each missing-value flag is computed before its fill. The projection is a single
narrow ``select``: it pipelines into the scan, no shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import safe_div
from ..sources.schema import DIRECT_AGENT, UNKNOWN_MARKET


def rebuilt_price() -> F.Column:
    """Nightly price implied by total = price * nights * rooms * (1 - discount/100)."""
    denom = F.col("nuits") * F.col("chambres") * (F.lit(1) - F.col("remise_pct") / F.lit(100.0))
    return safe_div(F.col("montant_total_eur"), denom)


def clean(df: DataFrame) -> DataFrame:
    """Clean a raw booking table; adds 4 flags, keeps every other column in place."""
    price = F.col("prix_moyen_nuit_eur")
    replaced = {
        # CLN2: rebuild missing prices from the accounting identity (fills nulls only).
        "prix_moyen_nuit_eur": F.coalesce(price, rebuilt_price()),
        # CLN3: neutral fills.
        "enfants": F.coalesce(F.col("enfants").cast("double"), F.lit(0.0)),
        "demandes_speciales": F.coalesce(F.col("demandes_speciales").cast("double"), F.lit(0.0)),
        # CLN4, CLN5: explicit categories.
        "marche_origine": F.coalesce(F.col("marche_origine"), F.lit(UNKNOWN_MARKET)),
        "agent_id": F.coalesce(F.col("agent_id"), F.lit(DIRECT_AGENT)),
        # CLN6: hotel stars behave as a 3-level factor.
        "categorie_hotel": F.col("categorie_hotel").cast("string"),
    }
    flags = [
        price.isNull().cast("int").alias("prix_impute"),  # CLN1
        F.col("enfants").isNull().cast("int").alias("enfants_manquant"),
        F.col("demandes_speciales").isNull().cast("int").alias("demandes_manquant"),
        F.col("agent_id").isNull().cast("int").alias("reservation_directe"),
    ]
    cols = [replaced[c].alias(c) if c in replaced else F.col(c) for c in df.columns]
    return df.select(*cols, *flags)
