"""Literal reference tables of the two review workflows.

Fixed values (must equal the studied workflow definitions): steps (code, order, label) in listing order, the
status → step mapping, and the allowed transitions. The listing position is the node ordinal used by W6.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Case-tracker workflow (10 steps).
CASE_STEPS = [
    ("1", 1, "Ouverture dossier"),
    ("2A", 2, "Création contrôle avec droit de visite"),
    ("2B", 2, "Création contrôle sans droit visite"),
    ("3A", 3, "Création PV avec natinfs"),
    ("3B", 3, "Création rapport de constatation (PV sans natinfs)"),
    ("4", 4, "Création courrier"),
    ("5", 5, "Création PV reactualisation"),
    ("6", 6, "Création décisions de justice"),
    ("7A", 7, "Clôture dossier avec remise en état"),
    ("7B", 7, "Clôture dossier autres raisons"),
]
CASE_TRANSITIONS = [
    ("1", "2A"), ("1", "2B"),
    ("2A", "3A"), ("2A", "3B"), ("2A", "7A"), ("2A", "7B"), ("2A", "6"),
    ("2B", "3A"), ("2B", "3B"), ("2B", "7A"), ("2B", "7B"), ("2B", "6"),
    ("3A", "4"), ("3A", "7A"), ("3A", "7B"), ("3A", "6"),
    ("3B", "4"), ("3B", "7A"), ("3B", "7B"), ("3B", "6"),
    ("4", "5"), ("4", "6"), ("4", "7A"), ("4", "7B"),
    ("5", "2A"), ("5", "2B"), ("5", "6"), ("5", "7A"), ("5", "7B"),
    ("6", "5"), ("6", "7A"), ("6", "7B"),
]

# Detection review workflow (13 steps).
REVIEW_STEPS = [
    ("0", 0, "Importé"),
    ("1", 1, "Détecté non vérifié"),
    ("2A", 2, "Suspect non controlé"),
    ("2B", 2, "Invalidé"),
    ("2C", 2, "Légitime"),
    ("3A", 3, "Non controlé - obsolete"),
    ("3B", 3, "Prescrit"),
    ("4", 4, "Courrier préalable envoyé"),
    ("5", 5, "Controlé terrain"),
    ("6A", 6, "PV Dressé"),
    ("6B", 6, "Rapport de constatation rédigé"),
    ("7", 7, "En astreinte administrative"),
    ("8", 8, "Remis en état"),
]
REVIEW_STATUS_MAPPING = [
    ("1", "DETECTED_NOT_VERIFIED.NOT_CONTROLLED.NOT_PRESCRIBED"),
    ("3B", "DETECTED_NOT_VERIFIED.NOT_CONTROLLED.PRESCRIBED"),
    ("6A", "DETECTED_NOT_VERIFIED.OFFICIAL_REPORT_DRAWN_UP.NOT_PRESCRIBED"),
    ("0", "IMPORTED.IMPORTED.IMPORTED"),
    ("2B", "INVALIDATED.NOT_CONTROLLED.NOT_PRESCRIBED"),
    ("2C", "LEGITIMATE.NOT_CONTROLLED.NOT_PRESCRIBED"),
    ("2C", "LEGITIMATE.OBSERVARTION_REPORT_REDACTED.NOT_PRESCRIBED"),
    ("5", "SUSPECT.CONTROLLED_FIELD.NOT_PRESCRIBED"),
    ("3B", "SUSPECT.CONTROLLED_FIELD.PRESCRIBED"),
    ("2A", "SUSPECT.NOT_CONTROLLED.NOT_PRESCRIBED"),
    ("3B", "SUSPECT.NOT_CONTROLLED.PRESCRIBED"),
    ("6B", "SUSPECT.OBSERVARTION_REPORT_REDACTED.NOT_PRESCRIBED"),
    ("3B", "SUSPECT.OBSERVARTION_REPORT_REDACTED.PRESCRIBED"),
    ("6A", "SUSPECT.OFFICIAL_REPORT_DRAWN_UP.NOT_PRESCRIBED"),
    ("3B", "SUSPECT.OFFICIAL_REPORT_DRAWN_UP.PRESCRIBED"),
    ("4", "SUSPECT.PRIOR_LETTER_SENT.NOT_PRESCRIBED"),
    ("8", "SUSPECT.REHABILITATED.NOT_PRESCRIBED"),
    ("3B", "SUSPECT.REHABILITATED.PRESCRIBED"),
]
REVIEW_TRANSITIONS = [
    ("0", "1"), ("0", "2C"), ("0", "2B"), ("0", "3B"),
    ("1", "2A"), ("1", "2B"), ("1", "2C"),
    ("2A", "3A"), ("2A", "3B"),
    ("2A", "4"), ("2A", "5"), ("2A", "8"),
    ("4", "5"), ("4", "8"),
    ("5", "6A"), ("5", "6B"), ("5", "8"),
    ("6A", "7"), ("6A", "8"), ("6B", "7"), ("6B", "8"),
    ("7", "8"),
]

WORKFLOWS = {
    "review": (REVIEW_STEPS, REVIEW_TRANSITIONS),
    "case": (CASE_STEPS, CASE_TRANSITIONS),
}


def workflow_steps(spark: SparkSession, workflow: str = "review") -> DataFrame:
    """(step_code, step_order, step_label, ordinal): ordinal = listing position (node id of the flow chart)."""
    steps, _ = WORKFLOWS[workflow]
    return spark.createDataFrame([(c, o, lbl, i) for i, (c, o, lbl) in enumerate(steps)],
                                 "step_code string, step_order int, step_label string, ordinal long")


def workflow_transitions(spark: SparkSession, workflow: str = "review") -> DataFrame:
    _, trans = WORKFLOWS[workflow]
    return spark.createDataFrame(trans, "from_step string, to_step string")


def status_mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(REVIEW_STATUS_MAPPING, "step_code string, status_code string")


def values_sql(rows, cols) -> str:
    """The same seed as an SQL VALUES relation (used by the oracles)."""
    def lit(v):
        return "'" + str(v).replace("'", "''") + "'" if isinstance(v, str) else str(v)

    body = ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows)
    return f"(select * from (values {body}) t({', '.join(cols)}))"
