"""Display texts for predicted classes and chart axes."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The wording of the live page (four classes).
LIVE_LABELS = {
    0: "Early (15+ min early)",
    1: "Slightly Early (0-15 min early)",
    2: "Slightly Late (0-30 min delay)",
    3: "Very Late (30+ min delay)",
}
# The wording of the batch page (three classes).
BATCH_LABELS = {
    0: "On Time (0-15 Minute Delay)",
    1: "Slightly Late (15-60 Minute Delay)",
    2: "Very Late (60+ Minute Delay)",
}
# Fixed value: longest axis label shown whole.
AXIS_CHARS = 14


def _pick(prediction: Column, labels: dict[int, str], otherwise: Column) -> Column:
    chosen = F
    for value, text in labels.items():
        chosen = chosen.when(prediction == value, F.lit(text))
    return chosen.otherwise(otherwise)


def live_label(prediction: Column) -> Column:
    """Four-class wording; an unknown class is shown as a number."""
    return _pick(prediction, LIVE_LABELS, F.concat(F.lit("Prediction: "), prediction.cast("string")))


def batch_label(prediction: Column) -> Column:
    """Three-class wording; any other class is blank."""
    return _pick(prediction, BATCH_LABELS, F.lit(""))


def axis_label(text: Column, limit: int = AXIS_CHARS) -> Column:
    """Shorten to ``limit`` characters and three dots."""
    return F.when(
        F.char_length(text) > limit, F.concat(F.substring(text, 1, limit), F.lit("..."))
    ).otherwise(text)


def prediction_text(prediction: Column) -> Column:
    """Class as stored text: a float, ``0.0`` when missing."""
    return F.coalesce(prediction.cast("double"), F.lit(0.0)).cast("string")
