"""Golden identities: published tables that follow from other published figures.

Fixed values: the published per-fold metric rows (fold, model, f1, precision, recall, roc_auc, pr_auc)
and the published per-model summary they must reproduce exactly; rows of the published cost curve, pooled
comparison, risk deciles, region table, ablation and coefficients.
"""

import pytest
from stayrisk.operators import metrics as M
from stayrisk.operators.errors import rate_f1_correlation
from stayrisk.operators.metrics import summarize_folds

# --------------------------------------------------------------------------- fixed values
PER_FOLD = [
    (1, "Régression logistique — baseline", 0.4671968190854871, 0.33861671469740634, 0.7532051282051282, 0.6469522407022406, 0.36192612795483925),
    (1, "Régression logistique + FE", 0.4663316582914573, 0.3396778916544656, 0.7435897435897436, 0.6522255428505429, 0.3707425412542231),
    (1, "Forêt aléatoire", 0.4722222222222222, 0.34195402298850575, 0.7628205128205128, 0.6411519692769693, 0.36455997549959723),
    (1, "HistGradientBoosting", 0.47081339712918663, 0.33560709413369716, 0.7884615384615384, 0.6323523042273042, 0.3526291612607747),
    (1, "LightGBM", 0.45855758880516684, 0.34521880064829824, 0.6826923076923077, 0.6353877916377917, 0.35861949117693676),
    (1, "Ensemble (final)", 0.46596356663470756, 0.332421340629275, 0.7788461538461539, 0.6481325075075075, 0.36500903863317885),
    (2, "Régression logistique — baseline", 0.48079658605974396, 0.41935483870967744, 0.5633333333333334, 0.6954407407407407, 0.4237424020747611),
    (2, "Régression logistique + FE", 0.4893162393162393, 0.360062893081761, 0.7633333333333333, 0.7013851851851853, 0.44391084858363755),
    (2, "Forêt aléatoire", 0.48140495867768596, 0.34880239520958084, 0.7766666666666666, 0.688162962962963, 0.399020690828514),
    (2, "HistGradientBoosting", 0.49278579356270813, 0.36938435940099834, 0.74, 0.6909148148148148, 0.4226934185500614),
    (2, "LightGBM", 0.49596309111880044, 0.37918871252204583, 0.7166666666666667, 0.6983296296296296, 0.43161243231170077),
    (2, "Ensemble (final)", 0.49539170506912444, 0.3785211267605634, 0.7166666666666667, 0.702262962962963, 0.4382840646984367),
    (3, "Régression logistique — baseline", 0.47514910536779326, 0.3385269121813031, 0.7966666666666666, 0.6756666666666666, 0.3795236239172194),
    (3, "Régression logistique + FE", 0.47438330170777987, 0.33156498673740054, 0.8333333333333334, 0.6799814814814815, 0.39586326646330383),
    (3, "Forêt aléatoire", 0.4669509594882729, 0.3432601880877743, 0.73, 0.6752962962962963, 0.38695395771686036),
    (3, "HistGradientBoosting", 0.4690181124880839, 0.32843791722296395, 0.82, 0.6715185185185185, 0.3771753689301347),
    (3, "LightGBM", 0.4710351377018044, 0.3293492695883134, 0.8266666666666667, 0.6712296296296296, 0.3928213507768795),
    (3, "Ensemble (final)", 0.4743465634075508, 0.33424283765347884, 0.8166666666666667, 0.6787481481481481, 0.39561091311375074),
    (4, "Régression logistique — baseline", 0.47127393838467946, 0.3201357466063348, 0.8927444794952681, 0.6625998978246657, 0.39559368067288675),
    (4, "Régression logistique + FE", 0.4732824427480916, 0.3236658932714617, 0.8801261829652997, 0.6697878968672185, 0.4022545760640443),
    (4, "Forêt aléatoire", 0.47266313932980597, 0.32802937576499386, 0.8454258675078864, 0.6397855032492472, 0.36628435010065813),
    (4, "HistGradientBoosting", 0.4751847940865892, 0.35714285714285715, 0.7097791798107256, 0.6529646923486394, 0.38717348243099947),
    (4, "LightGBM", 0.47082906857727735, 0.3484848484848485, 0.7255520504731862, 0.657544719571578, 0.3901469480572912),
    (4, "Ensemble (final)", 0.4717948717948718, 0.3495440729483283, 0.7255520504731862, 0.6661510265763045, 0.39672402309624805),
]
SUMMARY = {
    "Régression logistique — baseline": (0.4736, 0.0058, 0.3542, 0.0443, 0.7515, 0.1383, 0.6702, 0.0205, 0.3902, 0.0263),
    "Régression logistique + FE": (0.4758, 0.0097, 0.3387, 0.0156, 0.8051, 0.0631, 0.6758, 0.0205, 0.4032, 0.0304),
    "Forêt aléatoire": (0.4733, 0.006, 0.3405, 0.0088, 0.7787, 0.0486, 0.6611, 0.0244, 0.3792, 0.0167),
    "HistGradientBoosting": (0.477, 0.0109, 0.3476, 0.0189, 0.7646, 0.0492, 0.6619, 0.0251, 0.3849, 0.0291),
    "LightGBM": (0.4741, 0.0157, 0.3506, 0.0208, 0.7379, 0.062, 0.6656, 0.0263, 0.3933, 0.0299),
    "Ensemble (final)": (0.4769, 0.0128, 0.3487, 0.0213, 0.7594, 0.047, 0.6738, 0.0227, 0.3989, 0.0301),
}
#: seuil, fp, fn, cout, f1
COST_CURVE = [(0.05, 3554, 2, 890.5, 0.40831946755407655), (0.055, 3534, 3, 886.5, 0.4094172649858073),
              (0.06, 3498, 3, 877.5, 0.41189316311103646), (0.14, 2616, 110, 764.0, 0.4508460918614021),
              (0.245, 1614, 350, 753.5, 0.4723267060720043), (0.34, 771, 699, 891.75, 0.4189723320158103),
              (0.54, 58, 1165, 1179.5, 0.09474463360473723), (0.79, 1, 1226, 1226.25, 0.004866180048661801)]
#: model, f1, precision, recall, tp, fp, fn, tn, alert rate
COMPARISON = [("Régression logistique — baseline", 0.4693, 0.3331, 0.7941, 976, 1954, 253, 1617, 0.6104),
              ("Régression logistique + FE", 0.4724, 0.3421, 0.7632, 938, 1804, 291, 1767, 0.5712),
              ("Forêt aléatoire", 0.47, 0.3366, 0.7787, 957, 1886, 272, 1685, 0.5923),
              ("HistGradientBoosting", 0.4733, 0.3456, 0.751, 923, 1748, 306, 1823, 0.5565),
              ("LightGBM", 0.4689, 0.3376, 0.7673, 943, 1850, 286, 1721, 0.5819),
              ("Ensemble (final)", 0.4744, 0.3512, 0.7307, 898, 1659, 331, 1912, 0.5327)]
#: decile, n, mean probability, observed rate, lift, share of cancellations
DECILES = [(1, 480, 0.076, 0.071, 0.28, 0.028), (2, 480, 0.114, 0.125, 0.49, 0.049), (3, 480, 0.151, 0.167, 0.65, 0.065),
           (4, 480, 0.191, 0.179, 0.7, 0.07), (5, 480, 0.232, 0.246, 0.96, 0.096), (6, 480, 0.272, 0.277, 1.08, 0.108),
           (7, 480, 0.309, 0.3, 1.17, 0.117), (8, 480, 0.351, 0.383, 1.5, 0.15), (9, 480, 0.403, 0.392, 1.53, 0.153),
           (10, 480, 0.51, 0.421, 1.64, 0.164)]
#: observed rate, f1 of the published regions
REGIONS = [(0.315, 0.547), (0.364, 0.545), (0.268, 0.504), (0.235, 0.483), (0.252, 0.473), (0.219, 0.462), (0.242, 0.439),
           (0.283, 0.416), (0.223, 0.34)]
#: f1, gain over the first, gain over the one before
ABLATION = [(0.4691, 0.0, None), (0.4686, -0.0004, -0.0005), (0.4696, 0.0005, 0.001), (0.4691, 0.0, -0.0005), (0.4693, 0.0002, 0.0002),
            (0.4704, 0.0014, 0.0011), (0.4724, 0.0034, 0.002), (0.4704, 0.0014, -0.002)]
#: variable, coefficient, odds ratio: the published top 12 in order
COEFFICIENTS = [("score_engagement", -0.4755980946653674, 0.6215132215376042), ("canal_reservation_entreprise", -0.3719263301919359, 0.689405028989649),
                ("taux_annulation_passe", 0.26599718417357954, 1.3047313847846504), ("annulations_passees", -0.24542713624689005, 0.7823702881532257),
                ("delai_reservation_jours", 0.23016225366011422, 1.2588042389557141), ("type_acompte_total", -0.22407755158903875, 0.79925314861413),
                ("reservation_directe", -0.21014189197475625, 0.8104692387303152), ("region_hotel_Liguria", -0.205061200180484, 0.8145974613742035),
                ("modifications_reservation", 0.1882934484565228, 1.2071877107484694), ("region_hotel_Trentino-Alto_Adige", -0.17460601365136183, 0.8397878205366761),
                ("canal_reservation_telephone", 0.14664815541095716, 1.15794647414635), ("demandes_speciales", -0.14261826227607127, 0.8670850047822924)]
#: coefficients published further down
SMALL = [("log_delai", -0.0031143182685204264, 0.9968905261902513), ("marche_origine_Europe_Ouest", 2.8349146886664503e-06, 1.0000028349187071)]
# ---------------------------------------------------------------------------------------


def test_fold_summary_reproduces_published_table(spark):
    df = spark.createDataFrame(PER_FOLD, "pli int, modele string, f1 double, precision double, rappel double, "
                                         "roc_auc double, pr_auc double")
    out = {r["modele"]: r for r in summarize_folds(df).collect()}
    cols = ["f1_mean", "f1_std", "precision_mean", "precision_std", "rappel_mean", "rappel_std",
            "roc_auc_mean", "roc_auc_std", "pr_auc_mean", "pr_auc_std"]
    for model, expected in SUMMARY.items():
        assert tuple(out[model][c] for c in cols) == expected, model


def test_models_keep_the_order_of_the_published_summary(spark):
    rows = [(*x, i) for i, x in enumerate(PER_FOLD)]
    df = spark.createDataFrame(rows, "pli int, modele string, f1 double, precision double, rappel double, roc_auc double, pr_auc double, ligne int")
    out = summarize_folds(df, first_seen=["ligne"]).orderBy("ordre").collect()
    assert [(r["ordre"], r["modele"]) for r in out] == list(enumerate(SUMMARY, 1))


def test_cost_curve(spark):
    swept = spark.createDataFrame([(s, fp, fn, f1) for s, fp, fn, _, f1 in COST_CURVE], "seuil double, fp long, fn long, f1 double")
    assert [tuple(r) for r in M.cost_curve(swept).orderBy("seuil").collect()] == COST_CURVE
    positives = 1229  # 976 + 253 of any model of the comparison
    for _, fp, fn, _, f1 in COST_CURVE:
        assert 2 * (positives - fn) / (2 * (positives - fn) + fp + fn) == pytest.approx(f1, abs=1e-15)


def test_pooled_comparison_from_its_confusion_counts(spark):
    """Scores that split the rows as published give the published figures at the best threshold, for every model at once."""
    rows = [(m, y, p) for m, *_, vp, fp, fn, vn, _ in COMPARISON for y, p, n in ((1, 0.9, vp), (0, 0.9, fp), (1, 0.01, fn), (0, 0.01, vn)) for _ in range(n)]
    out = {r["model"]: r for r in M.round_report(M.best_metrics(spark.createDataFrame(rows, "model string, y int, proba double"), ["model"]), 4, keep=["seuil"]).collect()}
    for m, *want in COMPARISON:
        assert [out[m][c] for c in ("f1", "precision", "rappel", "vp", "fp", "fn", "vn", "taux_alerte")] == want, m


def test_risk_deciles(spark):
    rows = [(int(i < round(rate * n)), p) for _, n, p, rate, _, _ in DECILES for i in range(n)]
    assert sum(y for y, _ in rows) == 1229
    out = M.deciles(spark.createDataFrame(rows, "y int, proba double")).orderBy("decile").collect()
    assert [(r["decile"], r["n"], r["proba_moyenne"], r["taux_reel"], r["lift"], r["part_annulations"]) for r in out] == DECILES


def test_rate_and_f1_of_the_regions_correlate(spark):
    perf = spark.createDataFrame(REGIONS, "taux_annulation_reel double, f1 double")
    assert round(rate_f1_correlation(perf).first()[0], 2) == 0.67


def test_ablation_gains(spark):
    """Marginal gains are those of the rounded F1; gains over the first were taken before rounding, so within one unit."""
    from stayrisk.plans.validation import ablation_table

    rows = [(i, f"C{i}", 1, f1, 0.0, 0.0, 0.0, 0.2) for i, (f1, _, _) in enumerate(ABLATION)]
    got = ablation_table(spark.createDataFrame(rows, "ordre int, model string, n_variables int, f1 double, precision double, rappel double, roc_auc double, seuil double")).orderBy("ordre").collect()
    assert [r["gain_marginal"] for r in got] == [g for _, _, g in ABLATION]
    assert all(abs(r["gain_vs_baseline"] - g) < 1.5e-4 for r, (_, g, _) in zip(got, ABLATION))


def test_coefficients_by_size_with_odds_ratios(spark):
    from types import SimpleNamespace

    from stayrisk.operators.models import coefficients, top_coefficients

    every = [*SMALL, *reversed(COEFFICIENTS)]
    model = SimpleNamespace(feature_names=[v for v, _, _ in every], weights=[0.0, *(c for _, c, _ in every)])
    got = coefficients(model, spark)
    assert [r["variable"] for r in got.collect()] == [v for v, _, _ in [*COEFFICIENTS, *SMALL]]
    top = top_coefficients(got).collect()
    assert [(r["variable"], r["coefficient"]) for r in top] == [(v, c) for v, c, _ in COEFFICIENTS]
    assert [r["odds_ratio"] for r in got.collect()] == pytest.approx([o for _, _, o in [*COEFFICIENTS, *SMALL]], rel=1e-14)
