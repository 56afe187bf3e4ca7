"""Readable text for results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# An exact 0 is an underflow, and is named as one; Cohen's limits for an effect.
P_UNDERFLOW = "below 1e-308"
EFFECT_LIMITS = ((0.2, "very small"), (0.5, "small"), (0.8, "medium"))
EFFECT_ABOVE = "large"


def p_text(p: Column) -> Column:
    # the JVM writes an exponent as e-05, as C does
    return (
        F.when(p.isNull(), F.lit(None).cast("string"))
        .when(p == 0, F.lit(P_UNDERFLOW))
        .when(p < 1e-4, F.format_string("%.3e", p))
        .otherwise(F.format_string("%.6f", p))
    )


def effect_label(d: Column) -> Column:
    size = F.abs(d)
    label = F.when(d.isNull() | F.isnan(d), F.lit(None).cast("string"))
    for limit, text in EFFECT_LIMITS:
        label = label.when(size < limit, F.lit(text))
    return label.otherwise(F.lit(EFFECT_ABOVE))
