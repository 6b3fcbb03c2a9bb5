"""Set-level checks of the response contract."""

from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.operators.joins import folded, unique


def off_taxonomy(rows, materials):
    """Material rows whose (class, material) is not in the taxonomy."""
    return rows.where(F.col("class") != fixed.ROLLUP_CLASS).join(
        unique(materials, ["class", "material"]), ["class", "material"], "left_anti"
    )


def fraction_check(rows, keys, tolerance=0.01):
    """Sum of the fractions of each audit and whether it is 1 within tolerance.

    The gap is rounded before it is compared: the order of a distributed sum is
    not fixed, and a sum on the very bound must not depend on it.
    """
    total = F.sum("estimated_percentage")
    return (
        rows.where(F.col("class") != fixed.ROLLUP_CLASS)
        .groupBy(*keys)
        .agg(total.alias("fraction_sum"))
        .withColumn("ok", F.round(F.abs(F.col("fraction_sum") - 1), 6) <= tolerance)
    )


def weight_check(rows, materials, keys, tolerance=0.01):
    """Reported weight of each audit against fraction x density."""
    density = folded(materials, "material", F.max("density").alias("density"))
    return (
        rows.where(F.col("class") != fixed.ROLLUP_CLASS)
        .join(density, "material", "left")
        .groupBy(*keys)
        .agg(
            F.sum(F.col("estimated_percentage") * F.coalesce("density", F.lit(0))).alias("expected_weight"),
            F.sum("scaled_weight").alias("reported_weight"),
        )
        .withColumn(
            "ok",
            F.round(F.abs(F.col("expected_weight") - F.col("reported_weight")), 6)
            <= F.round(F.abs(F.col("expected_weight")) * tolerance, 6),
        )
    )
