"""Configuration: materials, prompt keys, versions and rendered prompts.

Sheets arrive as text columns plus `ord`, the row number in the sheet, because
later rows override earlier ones.
"""

from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.functions.objects import strip
from auditloom.operators.conform import whole_number
from auditloom.operators.joins import folded


def last_wins(df, keys, ord_col="ord"):
    """The last row of each key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*rest), F.col(ord_col)).alias("last")
    return folded(df, keys, last).select(*keys, "last.*")


def _filled(*cols):
    test = F.lit(True)
    for c in cols:
        test = test & F.coalesce(F.col(c) != "", F.lit(False))
    return test


def valid_materials(materials):
    """Rows with all four fields and a whole-number density."""
    number = whole_number(F.col("density"))
    return (
        materials.where(_filled("class", "material", "density", "description"))
        .withColumn("density", number)
        .where("density is not null")
    )


def general_values(general):
    """Key to value, the last one of a key winning."""
    return last_wins(general.where(_filled("key")).select("key", "value", "ord"), "key")


def normalise_models(models):
    """Version rows with all required fields and normalised switches."""
    level = F.upper(strip(F.col("thinking_level")))
    return (
        models.where(_filled("prompt_version_id", "model_name", "system_key", "prompt_key"))
        .withColumn(
            "thinking_level",
            F.coalesce(F.nullif(level, F.lit("")), F.lit(fixed.DEFAULT_THINKING_LEVEL)),
        )
        .withColumn(
            "code_execution", F.coalesce(F.upper("code_execution") == "TRUE", F.lit(False))
        )
    )


def resolve_prompts(models, general):
    """Versions with their template and prompt text, or the reason they drop."""
    values = general_values(general)
    system = values.select(F.col("key").alias("system_key"), F.col("value").alias("template"), F.lit(True).alias("_s"))
    prompt = values.select(F.col("key").alias("prompt_key"), F.col("value").alias("prompt_text"), F.lit(True).alias("_p"))
    absent = F.lit(None).cast("string")
    for mark in reversed(fixed.PLACEHOLDERS):
        absent = F.when(~F.coalesce(F.col("template").contains(mark), F.lit(False)), F.lit(mark)).otherwise(absent)
    reason = (
        F.when(F.col("_s").isNull(), "unknown_system_key")
        .when(F.col("_p").isNull(), "unknown_prompt_key")
        .when(absent.isNotNull(), F.concat(F.lit("missing_placeholder "), absent))
    )
    return (
        normalise_models(models)
        .join(system, "system_key", "left")
        .join(prompt, "prompt_key", "left")
        .withColumn("reason", reason)
        .drop("_s", "_p")
    )


def config_versions(models, general):
    """Usable versions; of a repeated version id the last usable row counts."""
    usable = resolve_prompts(models, general).where("reason is null").drop("reason")
    return last_wins(usable, "prompt_version_id")


def taxonomy(materials):
    """One row per class: its place and its materials in sheet order.

    Density and description of a material are those of its last row, whatever
    class that row names. A class is collected only after its rows are reduced
    to distinct materials.
    """
    valid = valid_materials(materials)
    info = last_wins(valid.select("material", "density", "description", "ord"), "material").drop("ord")
    pairs = valid.groupBy("class", "material").agg(F.min("ord").alias("ord"))
    return (
        pairs.join(info, "material")
        .groupBy("class")
        .agg(
            F.min("ord").alias("class_ord"),
            F.array_sort(
                F.collect_list(F.struct("ord", "material", "density", "description"))
            ).alias("materials"),
        )
    )


def _quoted(text):
    """A JSON string literal."""
    inside = F.to_json(F.array(text))
    return F.substr(inside, F.lit(2), F.length(inside) - 2)


def taxonomy_texts(classes):
    """One row with the three texts a template is filled with.

    material_details is JSON indented by two blanks; the other two are class
    definitions with one field per class.
    """

    def material(m):
        return F.concat(
            F.lit("    "), _quoted(m["material"]),
            F.lit(': {\n      "Density": '), m["density"].cast("string"),
            F.lit(',\n      "Description": '), _quoted(m["description"]), F.lit("\n    }"),
        )

    def entry(c):
        return F.concat(
            F.lit("  "), _quoted(c["class"]), F.lit(": {\n"),
            F.array_join(F.transform(c["materials"], material), ",\n"), F.lit("\n  }"),
        )

    def fields(ending):
        return F.array_join(
            F.transform("all", lambda c: F.concat(F.lit("    "), c["class"], F.lit(ending))), "\n"
        )

    ordered = classes.agg(
        F.array_sort(F.collect_list(F.struct("class_ord", "class", "materials"))).alias("all")
    )
    return ordered.select(
        F.concat(F.lit("{\n"), F.array_join(F.transform("all", entry), ",\n"), F.lit("\n}")).alias("material_details"),
        F.concat(F.lit(fixed.DENSITIES_HEADER), fields(fixed.DENSITIES_FIELD)).alias("material_densities_class"),
        F.concat(F.lit(fixed.DETECTED_HEADER), fields(fixed.DETECTED_FIELD)).alias("detected_materials"),
    )


def render_prompts(versions, materials):
    """Versions with `system_instruction`, the filled template.

    The texts are one value for the whole catalogue, made once. Doubled braces in
    a template become single ones.
    """
    names = ("material_details", "material_densities_class", "detected_materials")
    texts = taxonomy_texts(taxonomy(materials)).select(F.struct(*names))
    open_mark, close_mark = F.lit("\u0001"), F.lit("\u0002")
    body = F.replace(
        F.replace(F.col("template"), F.lit("{{"), open_mark), F.lit("}}"), close_mark
    )
    for name in names:
        body = F.replace(body, F.lit("{" + name + "}"), F.col("_texts")[name])
    body = F.replace(F.replace(body, open_mark, F.lit("{")), close_mark, F.lit("}"))
    return (
        versions.withColumn("_texts", texts.scalar())
        .withColumn("system_instruction", body)
        .drop("_texts")
    )


def with_prompts(tasks, rendered):
    """Tasks with the model, the prompt text and the filled instruction."""
    return tasks.join(
        rendered.select(
            "prompt_version_id", "model_name", "prompt_text", "system_instruction",
            "thinking_level", "code_execution",
        ),
        "prompt_version_id",
    )


def missing_keys(df, id_col, key_col, required):
    """(id, key) for every required key a catalogue id does not have.

    One set per id, holding required keys only, so its size is bounded by the
    list; no product of ids and keys is built.
    """
    wanted = F.array(*[F.lit(k) for k in required])
    held = F.collect_set(F.when(F.col(key_col).isin(*required), F.col(key_col)))
    return (
        df.groupBy(id_col)
        .agg(held.alias("_held"))
        .select(id_col, F.explode(F.array_except(wanted, F.col("_held"))).alias("missing_key"))
    )


def refusals(general, models, materials, keys=fixed.GENERAL_KEYS):
    """One row with `reasons`, why a set of sheets cannot be used; empty for a sound set.

    A set is refused when a required general key is absent, when no material is
    valid, or when no version is usable. All is one aggregate over the sheets.
    """
    known = general_values(general).agg(F.collect_set(F.when(F.col("key").isin(*keys), F.col("key"))))
    some_material = valid_materials(materials).agg(F.count("*") > 0)
    some_version = config_versions(models, general).agg(F.count("*") > 0)
    none = F.array().cast("array<string>")
    absent = [
        F.when(F.array_contains(known.scalar(), k), none).otherwise(F.array(F.lit(f"missing_key {k}"))) for k in keys
    ]
    return general.sparkSession.range(1).select(
        F.concat(
            *absent,
            F.when(some_material.scalar(), none).otherwise(F.array(F.lit("no_valid_material"))),
            F.when(some_version.scalar(), none).otherwise(F.array(F.lit("no_usable_version"))),
        ).alias("reasons")
    )


def verdicts(sources, keys=fixed.GENERAL_KEYS):
    """(place, source, reasons) of each named set of sheets, in the order of preference."""
    rows = [
        refusals(*sheets, keys).select(F.lit(place).alias("place"), F.lit(name).alias("source"), "reasons")
        for place, (name, sheets) in enumerate(sources.items())
    ]
    whole = rows[0]
    for row in rows[1:]:
        whole = whole.union(row)
    return whole


def chosen(sources, keys=fixed.GENERAL_KEYS):
    """(source, general, models, materials) of the first sound set among `sources`.

    `sources` maps names to sets of sheets, best first; the last one is taken if
    none is sound. The choice is a scalar of the plan, so the sheets are checked
    when the result is run and not by the driver beforehand.
    """
    sound = (F.size("reasons") == 0) | (F.col("place") == len(sources) - 1)
    pick = verdicts(sources, keys).where(sound).agg(F.min_by("source", "place").alias("source"))
    sheets = []
    for place in range(3):
        whole = None
        for name, one in sources.items():
            rows = one[place].withColumn("_source", F.lit(name))
            whole = rows if whole is None else whole.unionByName(rows)
        sheets.append(whole.where(F.col("_source") == pick.scalar()).drop("_source"))
    return pick, *sheets
