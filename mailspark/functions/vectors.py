"""Array arithmetic on embedding columns."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The smallest divisors of the normalisation and of the masked mean.
NORM_FLOOR = 1e-12
MASK_FLOOR = 1e-9


def l2_norm(v: Column) -> Column:
    squares = F.aggregate(v, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return F.sqrt(squares)


def l2_normalise(v: Column) -> Column:
    # The norm is bound once through a one-element array, not once per element.
    scaled = F.transform(
        F.array(F.greatest(l2_norm(v), F.lit(NORM_FLOOR))),
        lambda n: F.transform(v, lambda x: x.cast("double") / n),
    )
    return scaled[0]


def dot(v: Column, w: Column) -> Column:
    return F.aggregate(
        F.zip_with(v, w, lambda a, b: a.cast("double") * b.cast("double")),
        F.lit(0.0),
        lambda a, x: a + x,
    )
