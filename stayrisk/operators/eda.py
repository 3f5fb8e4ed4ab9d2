"""Exploratory aggregates (EDA1-20) as grouped / pivoted DataFrame operators.

All are partial+final hash aggregates (map-side combine) whose outputs are
bounded by the number of groups; null group keys are dropped as pandas does.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import flag, interval_label, np_round, right_closed_bin, safe_div
from ..sources.schema import ID_COL, LEAD_BINS, TARGET
from .cleaning import rebuilt_price


def rate_pivot(df: DataFrame, row: str, col: str, values: Sequence[str], target: str = TARGET,
               digits: int = 3) -> DataFrame:
    """EDA1: mean target by ``row`` x ``col`` as a pivot table.

    With the pivot values known, one conditional aggregate per value gives the
    pivot in a single shuffle (``groupBy().pivot()`` aggregates twice).
    """
    base = df.where(F.col(row).isNotNull() & F.col(col).isNotNull())
    return base.groupBy(row).agg(*[
        np_round(F.avg(F.when(F.col(col) == F.lit(v), F.col(target))), digits).alias(v) for v in values])


def lead_bins_label(c: str = "delai_reservation_jours", edges: Sequence[int] = LEAD_BINS) -> F.Column:
    labels = [interval_label(edges[i - 1], edges[i]) for i in range(1, len(edges))]
    return right_closed_bin(c, edges, labels)


def rate_by_lead_x_deposit(df: DataFrame, deposits: Sequence[str] = ("aucun", "partiel", "total"),
                           target: str = TARGET) -> DataFrame:
    """EDA2: right-closed lead-time bins x deposit type, mean target, rows outside bins dropped (T4)."""
    binned = df.select(lead_bins_label().alias("delai_reservation_jours"), "type_acompte", target)
    return rate_pivot(binned, "delai_reservation_jours", "type_acompte", deposits, target)


def period_summary(train: DataFrame, test: DataFrame, target: str = TARGET) -> DataFrame:
    """EDA3: rows, cancellation rate and date range of each set."""
    def one(df, name, has_target):
        return df.agg(
            F.lit(name).alias("jeu"),
            F.count(F.lit(1)).alias("n"),
            (F.avg(target) if has_target else F.lit(None).cast("double")).alias("taux_annulation"),
            F.min("date_reservation").alias("debut"),
            F.max("date_reservation").alias("fin"),
        )
    out = one(train, "train", True).unionByName(one(test, "test", False))
    return out.withColumn("taux_annulation", np_round("taux_annulation", 6))


def target_counts(df: DataFrame, target: str = TARGET) -> DataFrame:
    """EDA4: value counts of the target, raw and normalised (share over a <= 2-row window)."""
    c = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    return c.select(target, "n", np_round(F.col("n") / F.sum("n").over(Window.partitionBy()), 6).alias("part"))


def trivial_floors(df: DataFrame, target: str = TARGET) -> DataFrame:
    """EDA5: F1 of 'everything cancelled' = 2p/(1+p); accuracy of 'nothing cancelled' = 1-p."""
    p = F.avg(target)
    return df.agg(
        np_round(p, 6).alias("taux_annulation"),
        np_round(F.lit(2.0) * p / (F.lit(1.0) + p), 6).alias("f1_tout_annule"),
        np_round(F.lit(1.0) - p, 6).alias("accuracy_tout_maintenu"),
    )


def _null_long(df: DataFrame, prefix: str) -> DataFrame:
    cols = df.columns
    wide = df.agg(*[F.sum(F.col(c).isNull().cast("long")).alias(c) for c in cols], F.count(F.lit(1)).alias("__n"))
    long = wide.select(F.col("__n"), F.explode(F.array(*[
        F.struct(F.lit(c).alias("colonne"), F.col(c).alias("k")) for c in cols])).alias("x"))
    return long.select(
        F.col("x.colonne").alias("colonne"),
        F.col("x.k").alias(f"{prefix}_n"),
        np_round(F.col("x.k") / F.col("__n") * F.lit(100.0), 2).alias(f"{prefix}_pct"),
    )


def null_profile(train: DataFrame, test: DataFrame) -> DataFrame:
    """EDA6: per column null count and share, train vs test (one pass each), columns with nulls."""
    tr = _null_long(train, "train")
    te = _null_long(test, "test").drop("test_n")
    return tr.join(te, "colonne", "left").where(F.col("train_n") > 0)


def price_identity(raw: DataFrame) -> DataFrame:
    """EDA7: observed / rebuilt price on rows with a price: mean, sample std, max |ratio - 1|."""
    ratio = safe_div(F.col("prix_moyen_nuit_eur"), rebuilt_price())
    base = raw.where(F.col("prix_moyen_nuit_eur").isNotNull()).select(ratio.alias("r"))
    return base.agg(
        F.count(F.lit(1)).alias("n"),
        np_round(F.avg("r"), 9).alias("ratio_moyen"),
        np_round(F.stddev_samp("r"), 9).alias("ratio_ecart_type"),
        np_round(F.max(F.abs(F.col("r") - F.lit(1.0))), 9).alias("ecart_max"),
    )


def date_identity(raw: DataFrame) -> DataFrame:
    """EDA8 + EDA9: share of rows where arrival - booking == lead time; weekend flag == Fri/Sat arrival."""
    lead_ok = F.datediff("date_arrivee", "date_reservation") == F.col("delai_reservation_jours")
    wk = F.weekday("date_arrivee").isin(4, 5).cast("int") == F.col("arrivee_weekend")
    return raw.agg(
        np_round(F.avg(flag(lead_ok)), 6).alias("part_delai_ok"),
        np_round(F.avg(flag(wk)), 6).alias("part_weekend_ok"),
    )


def functional_dependency(raw: DataFrame, key: str = "region_hotel",
                          dependents: Sequence[str] = ("ville", "type_destination")) -> DataFrame:
    """EDA10: distinct dependents per key (1 everywhere means a 1-1 mapping)."""
    return raw.where(F.col(key).isNotNull()).groupBy(key).agg(
        *[F.count_distinct(d).alias(f"n_{d}") for d in dependents])


def rate_by(df: DataFrame, key: str, target: str = TARGET, digits: int = 3) -> DataFrame:
    """EDA11-14, EDA20: size and mean target per level (null keys dropped)."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(
        F.count(F.lit(1)).alias("effectif"),
        np_round(F.avg(target), digits).alias("taux_annulation"),
    )


def ordered(table: DataFrame, *order) -> DataFrame:
    """A table of one row per level, sorted, with its row number from 1 in ``ordre``."""
    return table.withColumn("ordre", F.row_number().over(Window.orderBy(*order))).orderBy("ordre")


def quarterly_rate(df: DataFrame, date_col: str = "date_reservation", target: str = TARGET) -> DataFrame:
    """EDA15: quarter-end resample of (size, mean) including empty quarters.

    The calendar spine is generated from the (min, max) quarter: its size is the
    number of quarters spanned, not the data volume.
    """
    q = F.trunc(F.col(date_col), "quarter")
    counts = df.groupBy(q.alias("q")).agg(F.count(F.lit(1)).alias("effectif"), F.avg(target).alias("__m"))
    span = df.agg(F.min(q).alias("a"), F.max(q).alias("b"))
    spine = span.select(F.explode(F.sequence("a", "b", F.expr("INTERVAL 3 MONTHS"))).alias("q"))
    out = spine.join(counts, "q", "left")
    return out.select(
        F.last_day(F.add_months("q", 2)).alias("trimestre"),
        F.coalesce(F.col("effectif"), F.lit(0)).alias("effectif"),
        np_round("__m", 3).alias("taux_annulation"),
    )


def unseen_levels(train: DataFrame, test: DataFrame, columns: Sequence[str]) -> DataFrame:
    """EDA16: (column, value) pairs present in test but not in train (anti join), nulls dropped."""
    def stack(df):
        pairs = F.explode(F.array(*[
            F.struct(F.lit(c).alias("colonne"), F.col(c).cast("string").alias("valeur")) for c in columns]))
        return df.select(pairs.alias("p")).select("p.colonne", "p.valeur").where(F.col("valeur").isNotNull()).distinct()
    return stack(test).join(stack(train), ["colonne", "valeur"], "left_anti")


def level_counts(df: DataFrame, key: str) -> DataFrame:
    """EDA17: value counts of a (remapped) categorical column."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("effectif"))


def preview(df: DataFrame, columns: Sequence[str], n: int = 5, order: Sequence[str] = ("date_reservation", ID_COL)) -> DataFrame:
    """EDA18: first rows in time order (a top-n, TakeOrderedAndProject)."""
    return df.orderBy(*order).limit(n).select(*columns)


def profile_rates(df: DataFrame, target: str = TARGET) -> DataFrame:
    """EDA19: no deposit + refundable + lead > 90 + via an intermediary, then also modified."""
    base = ((F.col("type_acompte") == "aucun") & (F.col("tarif_remboursable") == "oui")
            & (F.col("delai_reservation_jours") > 90) & (F.col("reservation_directe") == 0))
    modified = base & (F.col("a_modifie") == 1)
    return df.agg(
        F.count(F.when(base, 1)).alias("n_profil"),
        np_round(F.avg(F.when(base, F.col(target))), 6).alias("taux_profil"),
        F.count(F.when(modified, 1)).alias("n_profil_modifie"),
        np_round(F.avg(F.when(modified, F.col(target))), 6).alias("taux_profil_modifie"),
    )
