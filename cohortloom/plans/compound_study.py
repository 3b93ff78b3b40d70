"""Ready-made rules for a table of compounds, patients and treatment outcomes.

The general operators with the columns, bounds, codes and weights of that
domain, so that raw study rows become clean rows, features, labels and monitors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.category import bucketize, encode, normalise_text
from cohortloom.functions.numeric import clip, ratio, round_decimal, threshold_flag
from cohortloom.functions.scoring import label_from_score, label_score, rule_score, weighted_score
from cohortloom.operators.drift import Monitor
from cohortloom.operators.shift import DiscreteShift, Shift
from cohortloom.plans.medallion import CleaningRules, FeatureRules

# Columns, accepted ranges, scale bounds, codes, label weights, limits, and the moves of the shifted cohort.
RAW_FEATURES = [
    "molecular_weight",
    "logP",
    "hbd_count",
    "hba_count",
    "rotatable_bonds",
    "tpsa",
    "patient_age",
    "patient_gender",
    "ecog_performance_score",
    "prior_chemotherapy",
    "biomarker_pdl1",
    "dosage_mg",
    "treatment_cycles",
]
METADATA = ["data_split", "data_version", "is_drift", "efficacy_label"]
LABEL = "efficacy_label"
REQUIRED = ["efficacy_label", "molecular_weight", "patient_age", "dosage_mg"]
ACCEPTED = {
    "molecular_weight": (100, 800),
    "patient_age": (18, 90),
    "dosage_mg": (10, 400),
    "biomarker_pdl1": (0, 100),
    "logP": (-5, 10),
    "ecog_performance_score": (0, 4),
}
SCALES = {
    "molecular_weight": (100.0, 800.0),
    "logP": (-5.0, 10.0),
    "tpsa": (0.0, 200.0),
    "biomarker_pdl1": (0.0, 100.0),
    "dosage_mg": (10.0, 400.0),
    "patient_age": (18.0, 90.0),
}
CELL_LINES = {"NSCLC": 0, "BREAST": 1, "CRC": 2, "LEUKEMIA": 3, "LYMPHOMA": 4}
AGE_GROUPS = {"young": 0, "middle": 1, "senior": 2}
AGE_STEPS = [(40, "young"), (60, "middle")]
OLDEST = "senior"
LIPINSKI = {"molecular_weight": 500, "logP": 5, "hbd_count": 5, "hba_count": 10}
RISK = {"patient_age": (80.0, 0.4), "ecog_performance_score": (4.0, 0.4), "prior_chemotherapy": (None, 0.2)}
HIGH_PDL1 = 50
OUTCOME_WEIGHTS = {"molecular_weight": 0.25, "logP": 0.20, "ecog_performance_score": 0.20, "biomarker_pdl1": 0.15, "patient_age": 0.10}
OUTCOME_SCALES = {"molecular_weight": (150, 350.0), "logP": (0, 5.0), "ecog_performance_score": (0, 3.0), "biomarker_pdl1": (0, 100.0), "patient_age": (25, 55.0)}
HEAVY, HEAVY_PENALTY = 500, 0.15
# old mean and spread, new mean and spread, lowest, highest
MOVES = {
    "molecular_weight": ((340, 60), (460, 80), 200, 700),
    "patient_age": ((54, 10), (61, 11), 30, 85),
    "dosage_mg": ((125, 40), (210, 60), 75, 350),
}
WHOLE = ["patient_age"]
MOVED_ECOG = {0: 0.20, 1: 0.35, 2: 0.30, 3: 0.15}
OUTCOMES = ("Not Effective", "Effective")
PROFILED = ["molecular_weight", "patient_age", "dosage_mg", "biomarker_pdl1"]
MONITORED = [
    "molecular_weight",
    "patient_age",
    "dosage_mg",
    "ecog_performance_score",
    "biomarker_pdl1",
    "logP",
]


def cleaning_rules() -> CleaningRules:
    return CleaningRules(
        required=REQUIRED,
        bounds=ACCEPTED,
        types={"patient_gender": "int", "prior_chemotherapy": "int", "efficacy_label": "int"},
        categories=["cell_line_type"],
        tags={"silver_processed": True, "silver_version": "v1.0"},
    )


def feature_rules(
    rounding=round_decimal, unknown_cell_line: int | None = 0, unknown_age_group: int | None = 1
) -> FeatureRules:
    """The 25 features with the four metadata columns."""
    rules = [F.col(name) < limit for name, limit in LIPINSKI.items()]
    risk = [(F.col(name) / scale if scale else name, weight) for name, (scale, weight) in RISK.items()]
    age_group = bucketize("patient_age", AGE_STEPS, OLDEST)
    return FeatureRules(
        raw=RAW_FEATURES,
        derived={
            "cell_line_index": encode(normalise_text("cell_line_type"), CELL_LINES, unknown_cell_line),
            "age_group_index": encode(age_group, AGE_GROUPS, unknown_age_group),
            "lipinski_score": rule_score(*rules),
            "patient_risk_score": rounding(weighted_score(risk), 4),
            "dose_normalized_tpsa": rounding(ratio("tpsa", "dosage_mg"), 4),
            "high_pdl1_flag": threshold_flag("biomarker_pdl1", HIGH_PDL1),
        },
        bounds=SCALES,
        metadata=METADATA,
    )


def outcome_score(heavy_penalty: bool = False) -> Column:
    """Expected efficacy of a row; heavy compounds may be marked down.

    The random part of the original rule is left out.
    """
    weight, log_p, ecog, marker, age = (OUTCOME_WEIGHTS[c] for c in OUTCOME_WEIGHTS)
    terms = [
        (1 - (F.col("molecular_weight") - OUTCOME_SCALES["molecular_weight"][0]) / OUTCOME_SCALES["molecular_weight"][1], weight),
        (clip("logP", 0, 5) / OUTCOME_SCALES["logP"][1], log_p),
        (1 - F.col("ecog_performance_score") / OUTCOME_SCALES["ecog_performance_score"][1], ecog),
        (F.col("biomarker_pdl1") / OUTCOME_SCALES["biomarker_pdl1"][1], marker),
        (1 - (F.col("patient_age") - OUTCOME_SCALES["patient_age"][0]) / OUTCOME_SCALES["patient_age"][1], age),
    ]
    penalties = [(F.col("molecular_weight") > HEAVY, HEAVY_PENALTY)] if heavy_penalty else []
    return label_score(terms, penalties)


def with_outcome(df: DataFrame, heavy_penalty: bool = False, rounding=round_decimal) -> DataFrame:
    """The rows with ``efficacy_score`` (4 digits) and the label of the unrounded score."""
    score = outcome_score(heavy_penalty)
    kept = [c for c in df.columns if c not in ("efficacy_score", LABEL)]
    return df.select(
        *kept, rounding(score, 4).alias("efficacy_score"), label_from_score(score, 0.5).alias(LABEL)
    )


def shifts(key: Sequence[str] = ()) -> dict[str, Shift | DiscreteShift]:
    """Moves the usual cohort to heavier, older and higher dosed, in whole years of age.

    With the columns of a row's ``key`` the four-valued performance score is drawn anew with the shares of the moved cohort.
    """
    moved = {name: _between(*values, whole=name in WHOLE) for name, values in MOVES.items()}
    return {**moved, "ecog_performance_score": DiscreteShift(MOVED_ECOG, key)} if key else moved


def _between(old: tuple[float, float], new: tuple[float, float], low: float, high: float, whole: bool = False) -> Shift:
    """The shift that turns one mean and spread into another, within limits."""
    scale = new[1] / old[1]
    return Shift(scale, new[0] - old[0] * scale, low, high, whole)


def monitors() -> list[Monitor]:
    """Wasserstein distance for numbers, Jensen-Shannon for the four-valued score."""
    return [
        Monitor(c, "js" if c == "ecog_performance_score" else "wasserstein") for c in MONITORED
    ]
