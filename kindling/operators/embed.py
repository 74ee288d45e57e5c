"""Embedding representation: an ARRAY<FLOAT> column, L2-normalised in the JVM
with higher-order functions (a zero vector is left as is). The sentence
encoder itself is not part of the engine; the column is an input."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def l2_normalize(c: "Column | str") -> Column:
    c = F.col(c) if isinstance(c, str) else c
    d = F.transform(c, lambda x: x.cast("double"))
    norm = F.sqrt(F.aggregate(d, F.lit(0.0), lambda acc, x: acc + x * x))
    return F.when(norm > 0, F.transform(d, lambda x: x / norm)).otherwise(d)
