import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from stayrisk.operators.cleaning import clean
from stayrisk.operators.features import engineer
from stayrisk.operators.folds import fold_bounds
from stayrisk.operators.reference import apply_reference, fit_reference
from stayrisk.sources.schema import RESERVATION_SCHEMA


def _row(i, **kw):
    base = dict(reservation_id=f"R{i:09d}", date_reservation=dt.date(2024, 1, 1 + i % 20),
                date_arrivee=dt.date(2024, 3, 1 + i % 20), region_hotel="Nord", ville="Lille",
                type_destination="dest_nord", hotel_id=f"H{i % 3}", categorie_hotel=3, segment_client="solo",
                marche_origine="Europe", canal_reservation="web", moyen_transport="train",
                delai_reservation_jours=10 + i, nuits=2, adultes=2, enfants=1, chambres=1,
                formule_repas="aucun", tarif_remboursable="oui", type_acompte="aucun",
                prix_moyen_nuit_eur=100.0 + i, remise_pct=10, montant_total_eur=180.0 + 2 * i, client_type="connu",
                reservations_passees=2, annulations_passees=1, demandes_speciales=0, modifications_reservation=0,
                jours_liste_attente=0, evenement_majeur=0, haute_saison_regionale=0, arrivee_weekend=0,
                agent_id="A1", reservation_annulee=i % 2)
    base.update(kw)
    return tuple(base[f.name] for f in RESERVATION_SCHEMA.fields)


def test_division_by_zero_and_nulls(spark):
    rows = [_row(0, nuits=0, prix_moyen_nuit_eur=None), _row(1, chambres=0, prix_moyen_nuit_eur=None),
            _row(2, remise_pct=100, prix_moyen_nuit_eur=None), _row(3, enfants=None, demandes_speciales=None,
                                                                    agent_id=None, marche_origine=None,
                                                                    type_acompte="inconnu", reservations_passees=0)]
    out = {r["reservation_id"]: r for r in engineer(clean(spark.createDataFrame(rows, RESERVATION_SCHEMA))).collect()}
    assert out["R000000000"]["prix_moyen_nuit_eur"] is None and out["R000000000"]["montant_par_nuit"] is None
    assert out["R000000001"]["personnes_par_chambre"] is None
    assert out["R000000002"]["prix_moyen_nuit_eur"] is None and out["R000000002"]["prix_impute"] == 1
    r3 = out["R000000003"]
    assert (r3["enfants"], r3["enfants_manquant"], r3["demandes_manquant"]) == (0.0, 1, 1)
    assert (r3["agent_id"], r3["reservation_directe"], r3["marche_origine"]) == ("DIRECT", 1, "Inconnu")
    assert r3["acompte_ord"] is None and r3["score_engagement"] is None and r3["flexibilite_totale"] == 0
    assert r3["taux_annulation_passe"] == 0.0 and r3["sans_historique"] == 1
    assert math.isclose(out["R000000000"]["log_delai"], math.log1p(10))


def test_reference_is_fitted_on_train_only_and_maps_unseen(spark):
    train = clean(spark.createDataFrame([_row(i) for i in range(6)], RESERVATION_SCHEMA))
    val_rows = [_row(10, canal_reservation="assistant_vocal", hotel_id="H99"), _row(11, hotel_id=None)]
    val = clean(spark.createDataFrame(val_rows, RESERVATION_SCHEMA))
    ref = fit_reference(train)
    out = {r["reservation_id"]: r for r in apply_reference(val, ref).collect()}
    glob = ref.global_median
    assert out["R000000010"]["canal_reservation"] == "AUTRE"
    assert math.isclose(out["R000000010"]["prix_relatif_hotel"], 110.0 / glob)
    assert math.isclose(out["R000000011"]["prix_relatif_hotel"], 111.0 / glob)
    # editing validation rows does not change the fitted statistics (no leakage)
    ref2 = fit_reference(train)
    assert ref2.global_median == glob
    assert sorted(ref.hotel.collect()) == sorted(ref2.hotel.collect())


@pytest.mark.parametrize("n,expected", [
    (14743, [(1, 5897, 8108), (2, 8109, 10320), (3, 10320, 12531), (4, 12532, 14743)]),
    (8000, [(1, 3200, 4400), (2, 4400, 5600), (3, 5600, 6800), (4, 6800, 8000)]),
])
def test_fold_bounds_keep_float_truncation(n, expected):
    assert fold_bounds(n) == expected


def test_lead_bins_right_closed(spark):
    from stayrisk.operators.eda import lead_bins_label

    df = spark.createDataFrame([(d,) for d in [0, 7, 8, 90, 91, 600, 601]], "delai_reservation_jours int")
    got = [r[0] for r in df.select(lead_bins_label().alias("b")).collect()]
    assert got == [None, "(0, 7]", "(7, 21]", "(45, 90]", "(90, 600]", "(90, 600]", None]
