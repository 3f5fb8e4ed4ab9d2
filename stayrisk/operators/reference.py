"""Reference statistics fitted on a training fold only, then applied (REF1-8).

``fit_reference`` learns hotel / (region, month) / global median prices and the
known levels of the categorical columns from the training rows; nothing uses the
target, and validation or test rows never feed the fit. ``apply_reference`` adds
the relative prices (left equi joins) and maps unseen levels to ``AUTRE``.

Scale notes: the two lookup tables hold one row per hotel / (region, month);
up to ``MAX_BROADCAST_ROWS`` rows, counted when they are fitted, they are broadcast, so the bookings are not sent by hotel and by
season; beyond, Spark and AQE choose the join from measured sizes. Category lists become
literal ``IN`` lists when their total size is bounded, else anti-join checks.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import safe_div
from ..sources.schema import CATEGORICAL, UNSEEN
from .features import engineer
from .quantiles import exact_median

PRICE = "prix_moyen_nuit_eur"
MAX_LITERAL_LEVELS = 20_000
#: Rows of the two lookup tables of prices up to which they are broadcast.
MAX_BROADCAST_ROWS = 100_000


@dataclass
class ReferenceStats:
    hotel: DataFrame  # hotel_id, prix_ref_hotel
    season: DataFrame  # region_hotel, mois_arrivee, prix_ref_saison
    global_median: float | None
    categories: DataFrame  # colonne, valeur
    known: dict[str, list[str]] | None = field(default=None)
    lookup_rows: int | None = field(default=None)  # of hotel and season together, where they were counted

    def save(self, path: str) -> None:
        """Three tables and one row of scalars under ``path``."""
        for name in ("hotel", "season", "categories"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")
        facts = json.dumps({"global_median": self.global_median, "known": self.known})
        self.hotel.sparkSession.createDataFrame([(facts,)], "facts string").write.mode("overwrite").parquet(f"{path}/facts")

    @staticmethod
    def load(spark: SparkSession, path: str) -> ReferenceStats:
        facts = json.loads(spark.read.parquet(f"{path}/facts").first()["facts"])
        return ReferenceStats(*[spark.read.parquet(f"{path}/{n}") for n in ("hotel", "season")], facts["global_median"],
                              spark.read.parquet(f"{path}/categories"), facts["known"])


def reference_medians(base: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """REF1-3 in one distributed job: exact median price per hotel, per (region, month) and overall (within each ``by``).

    The three groupings are stacked as (kind, k1, k2) keys and ranked with the
    skew-safe running sums, so a hotel holding a third of the rows is split over
    many tasks (a per-group value map would pin it to one). Null keys are dropped
    as pandas groupby does.
    """
    price = F.col(PRICE).cast("double")
    hotel_ok = F.col("hotel_id").isNotNull()
    season_ok = F.col("region_hotel").isNotNull() & F.col("mois_arrivee").isNotNull()
    keys = F.array(
        F.when(hotel_ok, F.struct(F.lit("hotel").alias("kind"), F.col("hotel_id").cast("string").alias("k1"),
                                  F.lit(0).alias("k2"))),
        F.when(season_ok, F.struct(F.lit("season").alias("kind"), F.col("region_hotel").cast("string").alias("k1"),
                                   F.col("mois_arrivee").cast("int").alias("k2"))),
        F.struct(F.lit("global").alias("kind"), F.lit("").alias("k1"), F.lit(0).alias("k2")),
    )
    stacked = base.select(*by, price.alias(PRICE), F.explode(F.filter(keys, lambda x: x.isNotNull())).alias("g")).select(
        *by, "g.kind", "g.k1", "g.k2", PRICE)
    return exact_median(stacked, PRICE, [*by, "kind", "k1", "k2"], name="mediane")


def hotel_medians(base: DataFrame, meds: DataFrame | None = None) -> DataFrame:
    """REF1: exact median price per hotel (null keys dropped)."""
    meds = reference_medians(base) if meds is None else meds
    return meds.where(F.col("kind") == "hotel").select(F.col("k1").alias("hotel_id"),
                                                       F.col("mediane").alias("prix_ref_hotel"))


def season_medians(base: DataFrame, meds: DataFrame | None = None) -> DataFrame:
    """REF2: exact median price per (region, arrival month)."""
    meds = reference_medians(base) if meds is None else meds
    return meds.where(F.col("kind") == "season").select(
        F.col("k1").alias("region_hotel"), F.col("k2").alias("mois_arrivee"), F.col("mediane").alias("prix_ref_saison"))


def global_median(base: DataFrame, meds: DataFrame | None = None) -> DataFrame:
    """REF3: exact global median."""
    meds = reference_medians(base) if meds is None else meds
    return meds.where(F.col("kind") == "global").select(F.col("mediane").alias("prix_ref_global"))


def known_categories(base: DataFrame, columns: Sequence[str] = CATEGORICAL, by: Sequence[str] = ()) -> DataFrame:
    """REF4: distinct levels of every categorical column in one pass (stack + distinct), within each ``by``."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(c).alias("colonne"), F.col(c).cast("string").alias("valeur")) for c in columns
    ])).alias("p")
    return base.select(*by, pairs).select(*by, "p.colonne", "p.valeur").distinct()


def fit_references(trains: dict[int, DataFrame], columns: Sequence[str] = CATEGORICAL) -> dict[int, ReferenceStats]:
    """REF8 fit of several cleaned training folds in the jobs of one (row features are derived first)."""
    parts = []
    for k, train in trains.items():
        base = engineer(train) if "mois_arrivee" not in train.columns else train
        parts.append(base.select(F.lit(k).cast("int").alias("__task"), PRICE, "hotel_id", "region_hotel", "mois_arrivee",
                                 *[c for c in columns if c not in ("hotel_id", "region_hotel")]))
    base = reduce(DataFrame.unionByName, parts)
    # one job for the median tables; the small results are checkpointed (lineage cut)
    meds = reference_medians(base, ["__task"]).checkpoint(eager=True)
    cats = known_categories(base, columns, ["__task"]).checkpoint(eager=True)
    overall = {r["__task"]: r["mediane"] for r in meds.where(F.col("kind") == "global").collect()}
    lookups = {r["__task"]: r["count"] for r in meds.groupBy("__task").count().collect()}
    sizes = {r["__task"]: r["count"] for r in cats.groupBy("__task").count().collect()}
    small = [k for k in trains if sizes.get(k, 0) <= MAX_LITERAL_LEVELS]
    known: dict[int, dict[str, list]] = {k: {c: [] for c in columns} for k in small}
    for row in cats.where(F.col("__task").isin(small)).collect():  # at most MAX_LITERAL_LEVELS a fold
        known[row["__task"]][row["colonne"]].append(row["valeur"])
    out = {}
    for k in trains:
        own = meds.where(F.col("__task") == k).drop("__task")
        out[k] = ReferenceStats(hotel=hotel_medians(own, own), season=season_medians(own, own), global_median=overall.get(k),
                                categories=cats.where(F.col("__task") == k).drop("__task"), known=known.get(k),
                                lookup_rows=lookups.get(k, 0))
    return out


def fit_reference(train: DataFrame, columns: Sequence[str] = CATEGORICAL) -> ReferenceStats:
    """REF8 fit: statistics of one cleaned training fold."""
    return fit_references({0: train}, columns)[0]


def relative_prices(df: DataFrame, ref: ReferenceStats) -> DataFrame:
    """REF5-6: price / median of its hotel and of its (region, month), global median as fallback."""
    g = F.lit(ref.global_median).cast("double")
    small = ref.lookup_rows is not None and ref.lookup_rows <= MAX_BROADCAST_ROWS
    hotel, season = (F.broadcast(t) if small else t for t in (ref.hotel, ref.season))  # a checkpointed table has no known size
    out = df.join(hotel, ["hotel_id"], "left")
    out = out.join(season, ["region_hotel", "mois_arrivee"], "left")
    return out.select(
        *[F.col(c) for c in df.columns],
        safe_div(F.col(PRICE), F.coalesce(F.col("prix_ref_hotel"), g)).alias("prix_relatif_hotel"),
        safe_div(F.col(PRICE), F.coalesce(F.col("prix_ref_saison"), g)).alias("prix_relatif_saison"),
    )


def remap_unseen(df: DataFrame, ref: ReferenceStats, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """REF7: levels never seen in the training fold become ``AUTRE``."""
    if ref.known is not None:
        repl = {}
        for c in columns:
            s = F.col(c).cast("string")
            repl[c] = F.when(s.isin(ref.known.get(c, [])), s).otherwise(F.lit(UNSEEN))
        return df.select(*[repl[c].alias(c) if c in repl else F.col(c) for c in df.columns])
    # Unbounded level lists: one left join per column against its known levels.
    out = df
    for c in columns:
        levels = ref.categories.where(F.col("colonne") == c).select(
            F.col("valeur").alias(f"__k_{c}"), F.lit(True).alias(f"__seen_{c}"))
        out = out.join(levels, F.col(c).cast("string") == F.col(f"__k_{c}"), "left")
    repl = {c: F.when(F.col(f"__seen_{c}"), F.col(c).cast("string")).otherwise(F.lit(UNSEEN)) for c in columns}
    return out.select(*[repl[c].alias(c) if c in repl else F.col(c) for c in df.columns])


def apply_reference(df: DataFrame, ref: ReferenceStats, columns: Sequence[str] = CATEGORICAL) -> DataFrame:
    """REF8 apply: row features (if missing), relative prices, then the unseen remap (in that order)."""
    base = engineer(df) if "mois_arrivee" not in df.columns else df
    return remap_unseen(relative_prices(base, ref), ref, columns)
