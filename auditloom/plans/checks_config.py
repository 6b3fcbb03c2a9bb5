"""Checked queries: configuration catalogue."""

from pyspark.sql import functions as F

from auditloom import fixed
from auditloom.operators import catalogue
from auditloom.plans import standins as S
from auditloom.plans.registry import query

VALID = """
, ok as (select class, material, cast(density as bigint) as density, description, ord from materials
  where density not in ('n/a', '') and description is not null),
info as (select material, arg_max(density, ord) as density, arg_max(description, ord) as description
  from ok group by material),
pairs as (select class, material, min(ord) as ord from ok group by class, material),
placed as (select p.class, p.material, p.ord, i.density, i.description,
  min(p.ord) over (partition by p.class) as class_ord from pairs p join info i on i.material = p.material)
"""


@query("config_materials", S.with_views("materials", VALID + "select * from ok"))
def config_materials(spark, sf_dir):
    return catalogue.valid_materials(S.view(spark, sf_dir, "materials"))


@query(
    "config_last_wins",
    S.with_views(
        "general",
        "select key, arg_max(value, ord) as value, max(ord) as ord from general where key <> '' group by key",
    ),
)
def config_last_wins(spark, sf_dir):
    return catalogue.general_values(S.view(spark, sf_dir, "general"))


@query("taxonomy", S.with_views("materials", VALID + "select * from placed"))
def taxonomy(spark, sf_dir):
    classes = catalogue.taxonomy(S.view(spark, sf_dir, "materials"))
    return classes.select("class", "class_ord", F.inline("materials"))


RESOLVED = """
, vals as (select key, arg_max(value, ord) as value from general where key <> '' group by key),
norm as (select prompt_version_id, model_name, system_key, prompt_key, ord,
  coalesce(nullif(upper(trim(thinking_level)), ''), 'HIGH') as thinking_level,
  upper(code_execution) = 'TRUE' as code_execution from models where model_name <> ''),
res as (select n.*, s.value as template, p.value as prompt_text,
  case when s.key is null then 'unknown_system_key' when p.key is null then 'unknown_prompt_key'
    when not contains(s.value, '{material_details}') then 'missing_placeholder {material_details}'
    when not contains(s.value, '{material_densities_class}') then 'missing_placeholder {material_densities_class}'
    when not contains(s.value, '{detected_materials}') then 'missing_placeholder {detected_materials}' end as reason
  from norm n left join vals s on s.key = n.system_key left join vals p on p.key = n.prompt_key),
good as (select * from (select *, row_number() over (partition by prompt_version_id order by ord desc) as rn
  from res where reason is null) t where rn = 1)
"""


@query(
    "config_reasons",
    S.with_views(
        "general models",
        RESOLVED + "select ord, prompt_version_id, thinking_level, code_execution, reason from res",
    ),
)
def config_reasons(spark, sf_dir):
    resolved = catalogue.resolve_prompts(
        S.view(spark, sf_dir, "models"), S.view(spark, sf_dir, "general")
    )
    return resolved.select("ord", "prompt_version_id", "thinking_level", "code_execution", "reason")


VERSION = ["prompt_version_id", "model_name", "thinking_level", "code_execution", "prompt_text", "template"]


@query(
    "config_versions",
    S.with_views("general models", RESOLVED + f"select {', '.join(VERSION)} from good"),
)
def config_versions(spark, sf_dir):
    return _versions(spark, sf_dir).select(*VERSION)


def _versions(spark, sf_dir):
    return catalogue.config_versions(
        S.view(spark, sf_dir, "models"), S.view(spark, sf_dir, "general")
    )


TEXTS = (
    r"""
, per_class as (select class, min(ord) as class_ord, string_agg('    "' || material || E'": {\n      "Density": ' || density
    || E',\n      "Description": "' || description || E'"\n    }', E',\n' order by ord) as body from placed group by class),
texts as (select
  E'{\n' || string_agg('  "' || class || E'": {\n' || body || E'\n  }', E',\n' order by class_ord) || E'\n}' as details,
  '$densities' || string_agg('    ' || class || ': Dict[str, Material]', E'\n' order by class_ord) as densities,
  '$detected' || string_agg('    ' || class || ': Dict[str, float]', E'\n' order by class_ord) as detected
  from per_class)
""".replace("$densities", fixed.DENSITIES_HEADER).replace("$detected", fixed.DETECTED_HEADER)
)


@query(
    "taxonomy_texts",
    S.with_views(
        "materials",
        VALID + TEXTS
        + "select details as material_details, densities as material_densities_class, detected as detected_materials from texts",
    ),
)
def taxonomy_texts(spark, sf_dir):
    return catalogue.taxonomy_texts(catalogue.taxonomy(S.view(spark, sf_dir, "materials")))


@query(
    "prompt_render",
    S.with_views(
        "materials general models",
        VALID + TEXTS + RESOLVED
        + """
        , filled as (select prompt_version_id, replace(replace(replace(replace(replace(template, '{{', chr(1)), '}}', chr(2)),
            '{material_details}', details), '{material_densities_class}', densities), '{detected_materials}', detected) as t
          from good cross join texts)
        select prompt_version_id, length(replace(replace(t, chr(1), '{'), chr(2), '}')) as chars, md5(replace(replace(t, chr(1), '{'), chr(2), '}')) as digest
        from filled""",
    ),
)
def prompt_render(spark, sf_dir):
    rendered = catalogue.render_prompts(_versions(spark, sf_dir), S.view(spark, sf_dir, "materials"))
    return rendered.select(
        "prompt_version_id",
        F.length("system_instruction").cast("bigint").alias("chars"),
        F.md5("system_instruction").alias("digest"),
    )


@query(
    "task_prompts",
    S.with_views(
        "general models",
        RESOLVED
        + """
        , t as (select o_orderkey, 'v' || (o_custkey - o_custkey % 2) as prompt_version_id from orders)
        select o_orderkey, t.prompt_version_id, model_name, prompt_text from t
        join good g on g.prompt_version_id = t.prompt_version_id""",
    ),
)
def task_prompts(spark, sf_dir):
    tasks = S.table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey", "'v' || (o_custkey - o_custkey % 2) as prompt_version_id"
    )
    rendered = catalogue.render_prompts(_versions(spark, sf_dir), S.view(spark, sf_dir, "materials"))
    return catalogue.with_prompts(tasks, rendered).select(
        "o_orderkey", "prompt_version_id", "model_name", "prompt_text"
    )


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]


@query(
    "config_missing",
    """
    with ids as (select distinct o_custkey from orders), keys as (select distinct o_orderpriority from orders)
    select o_custkey, k.o_orderpriority as missing_key from ids cross join keys k where not exists
      (select 1 from orders o where o.o_custkey = ids.o_custkey and o.o_orderpriority = k.o_orderpriority)""",
)
def config_missing(spark, sf_dir):
    orders = S.table(spark, sf_dir, "orders").select("o_custkey", "o_orderpriority")
    return catalogue.missing_keys(orders, "o_custkey", "o_orderpriority", PRIORITIES)


@query(
    "config_required",
    S.with_views(
        "models",
        """
        , g as (select prompt_version_id, bool_or(system_key = 'k1') as a, bool_or(prompt_key = 'k2') as b
          from models group by prompt_version_id)
        select count(*) as versions, cast(sum(case when a then 0 else 1 end) as bigint) as without_system from g""",
    ),
)
def config_required(spark, sf_dir):
    models = S.view(spark, sf_dir, "models")
    lacking = catalogue.missing_keys(models, "prompt_version_id", "system_key", ["k1"])
    total = models.agg(F.count_distinct("prompt_version_id").alias("versions"))
    return total.withColumn("without_system", lacking.agg(F.count("*")).scalar())


# A sound set of sheets and three that break one rule each.
CHOICE_KEYS = ("k1", "k2")


def sheet_sets(spark, sf_dir):
    general, models, materials = (S.view(spark, sf_dir, name) for name in ("general", "models", "materials"))
    return {
        "no_key": (general.where("key <> 'k1'"), models, materials),
        "no_material": (general, models, materials.withColumn("density", F.lit("n/a"))),
        "no_version": (general, models.withColumn("system_key", F.lit("unknown")), materials),
        "sound": (general, models, materials),
    }


@query(
    "config_choice",
    S.with_views(
        "general models materials",
        """
        , sets as (select unnest(['no_key', 'no_material', 'no_version', 'sound']) as source, unnest([0, 1, 2, 3]) as place),
        g as (select source, key, arg_max(value, ord) as value from sets, general
          where key <> '' and not (source = 'no_key' and key = 'k1') group by source, key),
        usable as (select m.source, m.prompt_version_id from
          (select source, models.* replace (case when source = 'no_version' then 'unknown' else system_key end as system_key)
           from sets, models where model_name <> '') m
          join g s on s.source = m.source and s.key = m.system_key join g p on p.source = m.source and p.key = m.prompt_key
          where contains(s.value, '{material_details}') and contains(s.value, '{material_densities_class}')
            and contains(s.value, '{detected_materials}')),
        sound_material as (select source, count(*) filter (source <> 'no_material' and density not in ('n/a', '')
          and description is not null) as n from sets, materials group by source),
        v as (select source, place,
          (select count(*) from (select unnest(['k1', 'k2']) as k) w
            where k not in (select key from g where g.source = sets.source)) as keys_absent,
          (select n from sound_material t where t.source = sets.source) > 0 as material,
          (select count(distinct prompt_version_id) from usable u where u.source = sets.source) as versions from sets)
        select source, keys_absent + (case when material then 0 else 1 end) + (case when versions > 0 then 0 else 1 end) as reasons,
          source = (select arg_min(source, place) from v where keys_absent = 0 and material and versions > 0) as chosen,
          (select versions from v x where x.place = (select min(place) from v
            where keys_absent = 0 and material and versions > 0)) as versions_in_use from v""",
    ),
)
def config_choice(spark, sf_dir):
    """Why each of four sets of sheets is refused, which one is chosen, and how many versions it has."""
    sources = sheet_sets(spark, sf_dir)
    source, general, models, _ = catalogue.chosen(sources, CHOICE_KEYS)
    versions = catalogue.config_versions(models, general).agg(F.count("*"))
    return catalogue.verdicts(sources, CHOICE_KEYS).select(
        "source",
        F.size("reasons").cast("bigint").alias("reasons"),
        (F.col("source") == source.scalar()).alias("chosen"),
        versions.scalar().alias("versions_in_use"),
    )
