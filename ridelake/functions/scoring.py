"""Fixed scoring rules, as expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ridelake.functions.clock import as_column

# Upper bound of the third feature, class and class probabilities.
THIRD_FEATURE_STEPS = (
    (2.5, 0, (0.9, 0.05, 0.05)),
    (5.0, 1, (0.05, 0.85, 0.1)),
    (None, 2, (0.05, 0.1, 0.85)),
)

# Weight of each feature, divisor, and upper score bound of classes 0 and 1.
LINEAR_WEIGHTS = (0.25, 0.15, 0.35, 0.25)
LINEAR_DIVISOR = 10.0
LINEAR_STEPS = ((0.45, 0), (0.75, 1), (None, 2))

# Fixed value: score from which a prediction counts as an anomaly.
ANOMALY_SCORE = 0.85


def _stepwise(value: Column, steps: list[tuple[float | None, Column]]) -> Column:
    """The outcome of the first step whose bound lies above the value; null stays null."""
    chosen = None
    for bound, outcome in steps:
        reached = value.isNotNull() if bound is None else value < bound
        chosen = F.when(reached, outcome) if chosen is None else chosen.when(reached, outcome)
    return chosen


def feature_error(features: str | Column) -> Column:
    """Why a feature array cannot be scored, or null."""
    features = as_column(features)
    return F.when(features.isNull() | (F.size(features) != 4), F.lit("exactly 4 features are required"))


def rule_score(features: str | Column) -> tuple[Column, Column]:
    """Class and class probabilities from the third of four features."""
    features = as_column(features)
    third = F.when(feature_error(features).isNull(), F.get(features, F.lit(2)))
    label = _stepwise(third, [(bound, F.lit(cls)) for bound, cls, _ in THIRD_FEATURE_STEPS])
    shares = _stepwise(
        third, [(bound, F.array(*map(F.lit, probs))) for bound, _, probs in THIRD_FEATURE_STEPS]
    )
    return label, shares


def linear_score(features: str | Column) -> tuple[Column, Column]:
    """Class and score: the weighted sum of four features over ten, held within 0 and 1."""
    features = as_column(features)
    total = None
    for position, weight in enumerate(LINEAR_WEIGHTS):
        term = F.get(features, F.lit(position)) * F.lit(weight)
        total = term if total is None else total + term
    usable = F.when(feature_error(features).isNull(), total / F.lit(LINEAR_DIVISOR))
    score = F.when(usable.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), usable)))
    return _stepwise(score, [(bound, F.lit(cls)) for bound, cls in LINEAR_STEPS]), score


def anomaly_result(score: str | Column, threshold: float = ANOMALY_SCORE) -> Column:
    """'anomaly' from the threshold on, else 'normal'; a missing score counts as 0."""
    flagged = F.coalesce(as_column(score), F.lit(0.0)) >= threshold
    return F.when(flagged, F.lit("anomaly")).otherwise(F.lit("normal"))


def expected_fare_ratio(fare: str | Column, zone_average: str | Column) -> Column:
    """Fare over the zone's average fare; null where that is zero or unknown."""
    fare, zone_average = as_column(fare), as_column(zone_average)
    return fare.cast("double") / F.nullif(zone_average.cast("double"), F.lit(0.0))
