"""The ``reservations`` table derived from the TPC-H-like test tables.

The raw booking CSVs are not available, so a booking table with the same 34
columns is derived from ``orders``/``lineitem``/``customer``/``supplier``/
``part``/``nation``/``region`` (rules in FIXTURES.md section 2). Every step is
a Spark join / aggregation / window that is sliced by day for hot customers, so
the derivation grows with the tables.

Also exposes ``proba``, a deterministic stand-in score, so every metric
operator can be checked without fitting a model.
"""

from __future__ import annotations

import datetime as dt
import hashlib

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from .schema import RESERVATION_SCHEMA, TARGET

# --------------------------------------------------------------------------
# Fixed values of the derivation (FIXTURES.md 2.3)
# --------------------------------------------------------------------------
# Base cancellation rate in per mille, by lead-time bin (upper bound, days)
# and deposit type aucun / partiel / total.
PERMILLE_BY_LEAD = [
    (7, 289, 211, 101),
    (21, 304, 210, 89),
    (45, 327, 220, 102),
    (90, 378, 245, 118),
    (None, 486, 344, 137),
]
REFUNDABLE_ADJUST = 40
TEST_START = dt.date(2000, 4, 1)
MEAL_PLANS = ["petit_dejeuner", "demi_pension", "pension_complete", "aucun"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    return li.groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n_lines"),
        F.min("l_suppkey").alias("hotel_key"),
        F.min("l_partkey").alias("part_key"),
        F.sum("l_quantity").cast("bigint").alias("qty"),
        F.round(F.max("l_discount") * 100).cast("int").alias("remise"),
        F.round(F.max("l_extendedprice")).cast("bigint").alias("px"),
        F.sum(F.when(F.col("l_linestatus") == "O", 1).otherwise(0)).alias("n_open"),
    )


def _geo(spark: SparkSession, sf_dir: str, prefix: str) -> DataFrame:
    """nation x region as (<prefix>_nationkey, <prefix>_nation, <prefix>_region)."""
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    geo = nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias(f"{prefix}_nationkey"),
        F.col("n_name").alias(f"{prefix}_nation"),
        F.col("r_name").alias(f"{prefix}_region"),
    )
    return geo


def _base(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority")
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    li = _order_lines(spark, sf_dir)

    cgeo = _geo(spark, sf_dir, "cg")
    sgeo = _geo(spark, sf_dir, "sg")
    j = (
        orders.join(li, orders.o_orderkey == li.l_orderkey)
        .join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(cgeo, F.col("c_nationkey") == F.col("cg_nationkey"))
        .join(supplier, F.col("s_suppkey") == F.col("hotel_key"))
        .join(sgeo, F.col("s_nationkey") == F.col("sg_nationkey"))
        .join(part, F.col("p_partkey") == F.col("part_key"))
    )
    key = F.col("o_orderkey")
    delai = F.floor(F.lit(584.0) * F.pow(((key * 7919) % 1000) / F.lit(1000.0), F.lit(4.0))).cast("int")
    return j.select(
        key.alias("o_orderkey"),
        "o_custkey",
        F.col("o_orderdate").cast("date").alias("date_reservation"),
        "n_lines", "qty", "remise", "px",
        delai.alias("delai_reservation_jours"),
        F.when(F.col("o_orderstatus") == "F", "aucun")
        .when(F.col("o_orderstatus") == "O", "partiel")
        .otherwise("total").alias("type_acompte"),
        F.when(F.col("n_open") * 2 > F.col("n_lines"), "oui").otherwise("non").alias("tarif_remboursable"),
        "o_orderpriority", "c_mktsegment", "s_suppkey",
        F.col("sg_nation").alias("ville"),
        F.col("sg_region").alias("region_hotel"),
        F.col("cg_region").alias("marche"),
        "p_type",
    )


def _permille() -> F.Column:
    lead, dep = F.col("delai_reservation_jours"), F.col("type_acompte")
    base = None
    for upper, aucun, partiel, total in PERMILLE_BY_LEAD:
        val = F.when(dep == "aucun", aucun).when(dep == "partiel", partiel).otherwise(total)
        cond = lead <= upper if upper is not None else F.lit(True)
        base = F.when(cond, val) if base is None else base.when(cond, val)
    adjust = F.when(F.col("tarif_remboursable") == "oui", REFUNDABLE_ADJUST).otherwise(-REFUNDABLE_ADJUST)
    return base + adjust


#: Orders beyond which a customer's bookings are spread by date, and how many such customers are (the largest ones).
HOT_ORDERS, MOST_HOT = 100_000, 1_000


def _hot_customers(spark: SparkSession, sf_dir: str) -> list[int]:
    """Customers whose bookings would be too many for one task; which they are changes no result."""
    counts = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    hot = counts.where(F.col("o_custkey").isNotNull() & (F.col("n") > HOT_ORDERS)).orderBy(F.desc("n"), "o_custkey").limit(MOST_HOT)
    return [r["o_custkey"] for r in hot.collect()]


def _customer_history(tgt: DataFrame, hot: list[int]) -> DataFrame:
    """Add ``__rn`` and ``__cum_target``: running count and cancellations per customer, ordered by (date, order key).

    Rows are sent once, by (customer, slice): a customer in ``hot`` has a slice a day, any other a single one.
    The days before come from one row a day of the hot customers, joined by the same keys.
    """
    day = F.coalesce(F.unix_date("date_reservation"), F.lit(-2**31))  # nulls first
    sliced = tgt.withColumn("__slice", F.when(F.col("o_custkey").isin(hot), day).otherwise(0) if hot else F.lit(0))
    own = Window.partitionBy("o_custkey", "__slice").orderBy("date_reservation", "o_orderkey").rowsBetween(Window.unboundedPreceding, 0)
    rows = sliced.select("*", F.sum(F.lit(1)).over(own).alias("__rn"), F.sum(TARGET).over(own).alias("__cum_target"))
    if not hot:
        return rows.drop("__slice")
    earlier = Window.partitionBy("o_custkey").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    days = sliced.where(F.col("o_custkey").isin(hot)).groupBy("o_custkey", "__slice").agg(
        F.count(F.lit(1)).alias("__n"), F.sum(TARGET).alias("__t"))
    before = days.select("o_custkey", "__slice", F.sum("__n").over(earlier).alias("__n"), F.sum("__t").over(earlier).alias("__t"))
    joined = rows.join(before, ["o_custkey", "__slice"], "left")
    return joined.select(*[F.col(c) for c in tgt.columns], (F.col("__rn") + F.coalesce("__n", F.lit(0))).alias("__rn"),
                         (F.col("__cum_target") + F.coalesce("__t", F.lit(0))).alias("__cum_target"))


FIXTURE_VERSION = "v2"


def reservations(spark: SparkSession, sf_dir: str, with_proba: bool = True) -> DataFrame:
    """All derived bookings as a written table (derived once per checkpoint folder, then scanned).

    The derivation (joins + customer history over the raw tables) is written as
    parquet under the session's checkpoint folder and read back: later queries
    get a plain scan with filter pushdown and column pruning, and the lineage
    is cut, so a lost executor does not replay the whole derivation.
    """
    root = ensure_checkpoint_dir(spark)
    from ..plans.store import identity

    tag = hashlib.sha1(f"{FIXTURE_VERSION}:{identity(spark, sf_dir)}".encode()).hexdigest()[:16]
    path = f"{root.rstrip('/')}/stayrisk-reservations/{tag}"
    if not _written(spark, path):
        derive_reservations(spark, sf_dir).write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    return out if with_proba else out.drop("proba")


def _written(spark: SparkSession, path: str) -> bool:
    from ..plans.store import exists

    return exists(spark, path)


def derive_reservations(spark: SparkSession, sf_dir: str, with_proba: bool = True) -> DataFrame:
    """All derived bookings (train and test periods), target included, plus ``proba`` (lazy plan)."""
    key = F.col("o_orderkey")
    tgt = (
        _base(spark, sf_dir)
        .withColumn("permille", _permille())
        .withColumn(TARGET, F.when((key * 104729) % 1000 < F.col("permille"), 1).otherwise(0))
    )
    hist = _customer_history(tgt, _hot_customers(spark, sf_dir))
    rn = F.col("__rn").cast("int")
    arrival = F.date_add(F.col("date_reservation"), F.col("delai_reservation_jours"))
    cust = F.col("o_custkey")
    cols = {
        "reservation_id": F.concat(F.lit("R"), F.lpad(key.cast("string"), 9, "0")),
        "date_reservation": F.col("date_reservation"),
        "date_arrivee": arrival,
        "region_hotel": F.col("region_hotel"),
        "ville": F.col("ville"),
        "type_destination": F.concat(F.lit("dest_"), F.lower(F.col("region_hotel"))),
        "hotel_id": F.concat(F.lit("H"), F.col("s_suppkey").cast("string")),
        "categorie_hotel": (F.lit(3) + F.col("s_suppkey") % 3).cast("int"),
        "segment_client": F.col("c_mktsegment"),
        "marche_origine": F.when(key % 41 == 0, F.lit(None).cast("string")).otherwise(F.col("marche")),
        "canal_reservation": F.when((F.col("date_reservation") >= F.lit(TEST_START)) & (key % 25 == 0),
                                    F.lit("assistant_vocal")).otherwise(F.col("o_orderpriority")),
        "moyen_transport": F.col("p_type"),
        "delai_reservation_jours": F.col("delai_reservation_jours"),
        "nuits": (F.lit(1) + F.col("qty") % 14).cast("int"),
        "adultes": (F.lit(1) + F.col("n_lines") % 4).cast("int"),
        "enfants": F.when(key % 23 == 0, F.lit(None).cast("int")).otherwise((cust % 3).cast("int")),
        "chambres": (F.lit(1) + F.col("n_lines") % 3).cast("int"),
        "formule_repas": F.element_at(F.array(*[F.lit(m) for m in MEAL_PLANS]), (key % 4 + 1).cast("int")),
        "tarif_remboursable": F.col("tarif_remboursable"),
        "type_acompte": F.col("type_acompte"),
        "prix_moyen_nuit_eur": F.when(key % 42 == 0, F.lit(None).cast("double"))
        .otherwise(F.col("px") / F.lit(100.0)),
        "remise_pct": F.col("remise"),
        "montant_total_eur": F.col("px") * (F.lit(1) + F.col("qty") % 14) * (F.lit(1) + F.col("n_lines") % 3)
        * (F.lit(100) - F.col("remise")) / F.lit(10000.0),
        "client_type": F.when(rn == 1, "nouveau").when(rn > 6, "fidele").otherwise("connu"),
        "reservations_passees": (rn - 1).cast("int"),
        "annulations_passees": (F.col("__cum_target") - F.col(TARGET)).cast("int"),
        "demandes_speciales": F.when(key % 50 == 0, F.lit(None).cast("int")).otherwise((F.col("n_lines") % 5).cast("int")),
        "modifications_reservation": F.when(key % 3 == 0, (key % 5).cast("int")).otherwise(F.lit(0)),
        "jours_liste_attente": F.when(key % 20 == 0, (key % 31).cast("int")).otherwise(F.lit(0)),
        "evenement_majeur": F.when(key % 11 == 0, 1).otherwise(0),
        "haute_saison_regionale": F.when(F.month(arrival).isin(6, 7, 8), 1).otherwise(0),
        "arrivee_weekend": F.when(F.weekday(arrival).isin(4, 5), 1).otherwise(0),
        "agent_id": F.when(cust % 100 < 42, F.lit(None).cast("string"))
        .otherwise(F.concat(F.lit("A"), (cust % 50).cast("string"))),
        TARGET: F.col(TARGET).cast("int"),
    }
    out = [cols[f.name].cast(f.dataType).alias(f.name) for f in RESERVATION_SCHEMA.fields]
    if with_proba:
        proba = (F.col("permille") + (key * 31) % 200 - 100 + 60) / F.lit(1000.0)
        out.append(proba.alias("proba"))
    return hist.select(*out)


def is_train() -> F.Column:
    return F.col("date_reservation") < F.lit(TEST_START)


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(train with target, test without target) raw bookings, before cleaning."""
    res = reservations(spark, sf_dir, with_proba=False)
    return res.filter(is_train()), res.filter(~is_train()).drop(TARGET)


def scored(spark: SparkSession, sf_dir: str, model: str = "fixture") -> DataFrame:
    """Stand-in scored table ``(model, reservation_id, y, proba)`` over every booking."""
    res = reservations(spark, sf_dir)
    return res.select(F.lit(model).alias("model"), "reservation_id", F.col(TARGET).alias("y"), "proba")
