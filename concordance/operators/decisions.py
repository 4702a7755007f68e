"""Scores into accepted / review / failed, with reasons in a fixed order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from concordance.functions.text import clamp

#: Least scores for two sources and for any other number; risk is a largest value (fixed values).
THRESHOLDS = {"overall": (0.85, 0.80), "type": (1.0, 2 / 3), "structure": (0.75, 0.70), "evidence": (0.65, 0.60), "validator": (0.75, 0.70), "risk": (0.30, 0.35)}


def threshold(name: str, models: Column) -> Column:
    two, other = THRESHOLDS[name]
    return F.when(models == 2, two).otherwise(other)


def accept_score(overall: Column, evidence: Column, validator: Column, risk: Column) -> Column:
    return F.round(0.35 * overall + 0.30 * evidence + 0.25 * validator + 0.10 * (1 - risk), 4)


def validation_scores(match: Column, add: Column, type_conflict: Column, structure_conflict: Column) -> Column:
    """struct<evidence, validator, risk> from match and addition ratios."""
    t, s = type_conflict.cast("double"), structure_conflict.cast("double")
    return F.struct(
        F.round(clamp(0.55 + 0.35 * match - 0.10 * add), 4).alias("evidence"), F.round(clamp(0.60 + 0.25 * match - 0.10 * t - 0.10 * s), 4).alias("validator"),
        F.round(clamp(0.10 + 0.35 * (1 - match) + 0.20 * add + 0.15 * s), 4).alias("risk"),
    )


def gate(models: Column, scores: dict[str, Column], errors: Column) -> Column:
    """Does every score reach its threshold, with more than one source and no error?"""
    ok = (models > 1) & (errors == 0)
    for name, value in scores.items():
        ok = ok & (value <= threshold(name, models) if name == "risk" else value >= threshold(name, models))
    return ok


def decide(models: Column, successes: Column, parsed: Column, scores: dict[str, Column], errors: Column) -> Column:
    return F.when((successes == 0) | (parsed == 0), "failed").when(parsed == 1, "review").when(gate(models, scores, errors), "accepted").otherwise("review")


#: Reason and escalation of each score below its threshold (fixed values).
REASONS = {
    "overall": ("overall consensus score below acceptance threshold", "low_consensus_score"),
    "type": ("image type agreement below acceptance threshold", "low_type_agreement"),
    "structure": ("structure agreement below acceptance threshold", "low_structure_agreement"),
    "evidence": ("evidence score below acceptance threshold", "low_evidence_score"),
    "validator": ("validator score below acceptance threshold", "low_validator_score"),
    "risk": ("hallucination risk above acceptance threshold", "high_hallucination_risk"),
}


def reasons(decision: Column, models: Column, successes: Column, parsed: Column, scores: dict[str, Column]) -> Column:
    """All reasons that hold, in order."""
    review = decision == "review"
    parts = [
        F.when(successes == 0, "no models succeeded").when(parsed == 0, "no parsable labels").when(parsed == 1, "single model result cannot be auto-accepted"),
        F.when((models > 0) & (successes < models / 2), "less than half models succeeded"),
    ]
    for name, (reason, _) in REASONS.items():
        bad = scores[name] > threshold(name, models) if name == "risk" else scores[name] < threshold(name, models)
        parts.append(F.when(review & bad, reason))
    return F.array_compact(F.array(*parts))


def many_low_support(low: Column, fused: Column) -> Column:
    """Too many edges without quorum: as many as fused, or three and over 0.35 of all."""
    return F.when(low == 0, False).when((fused == 0) | (low >= fused), True).otherwise((low >= 3) & (low / (low + fused) >= 0.35))
