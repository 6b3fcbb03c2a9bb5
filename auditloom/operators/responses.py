"""Model responses to material and class rows."""

from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.functions import text as T
from auditloom.operators.once import computed

_ROW = "struct<class:string,material:string,estimated_percentage:double,scaled_weight:double>"


def parse_responses(df, text_col="response"):
    """Add `doc` (variant), `root` (its map form) and `reason`.

    `reason` is NULL when the response is usable.
    """
    text = F.col(text_col)
    parsed = (
        df.withColumn("_json", T.extract_json(text))
        .withColumn("doc", F.try_parse_json("_json"))
        .withColumn("root", T.as_object(F.col("doc")))
    )
    reason = T.failure_reason(text, F.col("_json"), F.col("doc"), F.col("root"))
    return computed(parsed.withColumn("reason", reason).drop("_json"), "reason", "root", "doc")


def _half_even_2(ratio):
    """Round to two places, half to even, on the exact decimal value."""
    return F.coalesce(F.bround(ratio.try_cast("decimal(38,9)"), 2).cast("double"), ratio)


def _items(total):
    """Numeric materials of each class, empty classes left out."""

    def one(entry):
        typed = F.transform(
            F.map_entries(T.as_object(entry["value"])),
            lambda m: F.struct(
                m["key"].alias("material"),
                T.kind(m["value"]).alias("kind"),
                m["value"].try_cast("double").alias("fraction"),
            ),
        )
        return F.struct(
            entry["key"].alias("class"),
            F.transform(
                F.filter(typed, lambda m: T.is_number_kind(m["kind"])),
                lambda m: F.struct(
                    m["material"].alias("material"),
                    m["kind"].alias("kind"),
                    m["fraction"].alias("fraction"),
                    (m["fraction"] * total).alias("weight"),
                ),
            ).alias("items"),
        )

    classes = F.filter(
        F.map_entries("root"), lambda e: e["key"] != F.lit(fixed.TOTAL_KEY)
    )
    return F.filter(F.transform(classes, one), lambda c: F.size(c["items"]) > 0)


def _unstorable(total, classes):
    """A value the result table refuses: it fails the whole audit."""

    def some(test):
        return F.exists(classes, lambda c: F.exists(c["items"], test))

    def boolean(i):
        return i["kind"] == "BOOLEAN"

    def infinite(i):
        return F.isnan(i["weight"]) | (F.abs(i["weight"]) == float("inf"))

    return F.when(
        some(lambda i: boolean(i) | infinite(i)),
        F.when(some(boolean), "boolean_fraction").otherwise("non_finite_weight"),
    ).when((total == 0) & (F.size(classes) > 0), "zero_total")


def score_rows(parsed):
    """Add `rows`, the material rows followed by the class rows of each audit.

    One response is one row, so its classes are summed inside that row: there
    is no shuffle, whatever the size of the table. `rows` is empty when there
    is no numeric total, and `reason` is filled when the audit cannot be stored.
    """
    total_value = F.try_element_at("root", F.lit(fixed.TOTAL_KEY))
    total, classes = F.col("total"), F.col("classes")
    materials = F.flatten(
        F.transform(
            classes,
            lambda c: F.transform(
                c["items"],
                lambda i: F.struct(
                    c["class"].alias("class"),
                    i["material"].alias("material"),
                    i["fraction"].alias("estimated_percentage"),
                    i["weight"].alias("scaled_weight"),
                ),
            ),
        )
    )

    def rollup(c):
        weight = F.aggregate(c["items"], F.lit(0.0), lambda a, i: a + i["weight"])
        return F.struct(
            F.lit(fixed.ROLLUP_CLASS).alias("class"),
            c["class"].alias("material"),
            _half_even_2(F.try_divide(weight, total)).alias("estimated_percentage"),
            weight.alias("scaled_weight"),
        )

    scored = (
        parsed.withColumn("total", F.when(T.is_number_kind(T.kind(total_value)), total_value.try_cast("double")))
        .withColumn("classes", F.when(total.isNotNull(), _items(total)))
        .withColumn("reason", F.coalesce(F.col("reason"), _unstorable(total, classes)))
        .withColumn(
            "rows",
            F.when(
                F.col("reason").isNull() & classes.isNotNull(),
                F.concat(materials, F.transform(classes, rollup)),
            ).otherwise(F.array().cast(f"array<{_ROW}>")),
        )
        .drop("total", "classes")
    )
    return computed(scored, "reason", "rows")


def with_payload(scored, name="model_result"):
    """Keep the whole response as JSON text next to its rows."""
    return scored.withColumn(name, F.to_json("doc"))


def explode_rows(scored):
    """One output row per element of `rows`.

    The outer form keeps Catalyst from deriving a size filter that would parse
    every response a second time.
    """
    kept = [c for c in scored.columns if c not in ("rows", "doc", "root", "reason")]
    return scored.select(*kept, F.inline_outer("rows")).where("class is not null")


def flatten_with_rollup(df, text_col="response"):
    """Response text to material and class rows; bad responses give none."""
    scored = score_rows(parse_responses(df, text_col))
    return explode_rows(scored).drop(text_col)


def class_rollup(rows, keys):
    """Class rows from stored material rows.

    Percentages are shares of the reported total; both sums are partial before
    the shuffle, so one large audit does not reach one task row by row.
    """
    return (
        rows.where(F.col("class") != fixed.ROLLUP_CLASS)
        .groupBy(*keys, "class")
        .agg(
            F.sum("scaled_weight").alias("scaled_weight"),
            F.sum("estimated_percentage").alias("share"),
        )
        .select(
            *keys,
            F.lit(fixed.ROLLUP_CLASS).alias("class"),
            F.col("class").alias("material"),
            _half_even_2(F.col("share")).alias("estimated_percentage"),
            "scaled_weight",
        )
    )
