"""The ready-made study rules, row by row against plain arithmetic."""

import random

import pytest
from pyspark.sql import functions as F

from cohortloom.operators.classifier import BoostingSettings
from cohortloom.operators.drift import dataset_drift, drift_scores
from cohortloom.plans import compound_study as study
from cohortloom.plans.medallion import clean_table, gold_features
from cohortloom.plans.modelling import evaluate_run, train_and_score
from cohortloom.operators.shift import shift_cohort

SCHEMA = (
    "key int, molecular_weight double, logP double, hbd_count long, hba_count long, rotatable_bonds long, "
    "tpsa double, cell_line_type string, patient_age long, patient_gender long, ecog_performance_score long, "
    "prior_chemotherapy long, biomarker_pdl1 double, dosage_mg double, treatment_cycles long, "
    "data_split string, data_version string, is_drift boolean"
)


def study_rows(n, seed=3):
    pick = random.Random(seed)
    return [
        (
            i, round(min(max(pick.gauss(340, 60), 150.0), 500.0), 2), round(min(max(pick.gauss(2.5, 1.2), -3.0), 7.0), 3),
            pick.randrange(6), pick.randrange(8), pick.randrange(10), round(min(max(pick.gauss(80, 20), 20.0), 160.0), 2),
            pick.choice(["NSCLC", "Breast ", "crc", "Leukemia", "Lymphoma", "unheard of"]),
            int(min(max(pick.gauss(54, 10), 25), 80)), pick.randrange(2), pick.choice([0, 1, 2, 3]), pick.randrange(2),
            round(min(max(pick.gauss(45, 20), 0.0), 100.0), 2), round(min(max(pick.gauss(125, 40), 50.0), 200.0), 1),
            1 + pick.randrange(8), "train" if i % 5 < 4 else "validation", "baseline_v1", False,
        )
        for i in range(n)
    ]


@pytest.fixture(scope="module")
def raw(spark):
    return study.with_outcome(spark.createDataFrame(study_rows(1500), SCHEMA)).cache()


def expected_score(r, penalty):
    score = (
        0.25 * (1 - (r.molecular_weight - 150) / 350)
        + 0.20 * (min(max(r.logP, 0), 5) / 5)
        + 0.20 * (1 - r.ecog_performance_score / 3)
        + 0.15 * r.biomarker_pdl1 / 100
        + 0.10 * (1 - (r.patient_age - 25) / 55)
    )
    return min(max(score - (0.15 if penalty and r.molecular_weight > 500 else 0), 0), 1)


def test_labels_follow_the_weights(raw):
    for r in raw.collect():
        score = expected_score(r, False)
        assert r.efficacy_score == pytest.approx(score, abs=6e-5)
        if abs(score - 0.5) > 1e-9:
            assert r.efficacy_label == int(score >= 0.5)


def test_cleaning_keeps_only_accepted_rows(spark, raw):
    columns = raw.columns
    bad = [
        {"patient_age": 17}, {"patient_age": 91}, {"molecular_weight": None}, {"molecular_weight": float("nan")},
        {"dosage_mg": 400.5}, {"logP": None}, {"biomarker_pdl1": -0.1}, {"efficacy_label": None},
    ]
    good = raw.limit(1).collect()[0].asDict()
    rows = [tuple({**good, **change}[c] for c in columns) for change in [{}, {}, *bad, {"patient_age": 90}]]
    clean = clean_table(spark.createDataFrame(rows, raw.schema), study.cleaning_rules())
    assert sorted(r.patient_age for r in clean.collect()) == sorted([good["patient_age"], 90])
    kinds = dict(clean.dtypes)
    assert kinds["patient_gender"] == kinds["efficacy_label"] == "int" and kinds["silver_processed"] == "boolean"


def test_features_row_by_row(spark, raw):
    rules = study.feature_rules()
    assert len(rules.names()) == 25
    clean = clean_table(raw, study.cleaning_rules())
    # the rows' own columns ride along under other names, to compute from in plain Python
    source = clean.select("*", *[F.col(c).alias(f"in_{c}") for c in ("cell_line_type", "key")])
    gold = gold_features(
        source, study.FeatureRules(rules.raw, rules.derived, rules.bounds, [*study.METADATA, "in_cell_line_type"])
    )
    assert gold.columns[:25] == rules.names()
    for r in gold.collect():
        assert r.cell_line_index == study.CELL_LINES.get(r.in_cell_line_type, 0)
        assert r.age_group_index == (0 if r.patient_age < 40 else 1 if r.patient_age < 60 else 2)
        assert r.lipinski_score == (r.molecular_weight < 500) + (r.logP < 5) + (r.hbd_count < 5) + (r.hba_count < 10)
        risk = r.patient_age / 80 * 0.4 + r.ecog_performance_score / 4 * 0.4 + r.prior_chemotherapy * 0.2
        assert r.patient_risk_score == pytest.approx(risk, abs=5.1e-5)
        assert r.dose_normalized_tpsa == pytest.approx(r.tpsa / r.dosage_mg, abs=5.1e-5)
        assert r.high_pdl1_flag == (r.biomarker_pdl1 > 50)
        for c, (low, high) in study.SCALES.items():
            assert r[f"{c}_norm"] == pytest.approx((r[c] - low) / (high - low), abs=5.1e-5)


def test_unknown_codes_can_be_told_apart(spark, raw):
    rules = study.feature_rules(unknown_cell_line=-1)
    codes = {r.cell_line_index for r in gold_features(raw, rules).select("cell_line_index").distinct().collect()}
    assert codes == {-1, 0, 1, 2, 3, 4}


def test_shifted_cohort_is_heavier_relabelled_and_detected(spark, raw):
    moved = study.with_outcome(shift_cohort(raw, study.shifts(), version="drift_v1"), heavy_penalty=True)
    means = moved.agg(F.avg("molecular_weight"), F.avg("patient_age"), F.avg("dosage_mg")).first()
    assert means[0] == pytest.approx(460, abs=8) and means[1] == pytest.approx(61, abs=2) and means[2] == pytest.approx(210, abs=8)
    for r in moved.limit(200).collect():
        assert r.efficacy_score == pytest.approx(expected_score(r, True), abs=6e-5)
    columns = ["data_version", *study.MONITORED]
    both = raw.select(*columns).unionByName(moved.select(*columns))
    scores = drift_scores(both, F.col("data_version") == "baseline_v1", study.monitors())
    got = {r.feature: r.drift_detected for r in scores.collect()}
    assert got == {
        "molecular_weight": True, "patient_age": True, "dosage_mg": True,
        "ecog_performance_score": False, "biomarker_pdl1": False, "logP": False,
    }
    summary = dataset_drift(scores).first()
    assert summary.dataset_drifted and summary.recommended_action == "IMMEDIATE_ROLLBACK"


def test_training_on_study_features_beats_chance(spark, raw):
    rules = study.feature_rules()
    gold = gold_features(clean_table(raw, study.cleaning_rules()), rules).cache()
    settings = BoostingSettings(trees=10, depth=3, learning_rate=0.3)
    _, scored = train_and_score(gold, rules.names(), study.LABEL, "data_split", settings, study.MONITORED)
    run = evaluate_run(scored, "r", "dev", F.lit("2024-01-01")).first()
    assert run.roc_auc > 0.85
