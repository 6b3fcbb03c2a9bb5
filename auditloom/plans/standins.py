"""Input tables of the checked queries, derived from the driver's tables.

The driver's data holds no images, events or responses, so they are derived by
SQL that runs unchanged on Spark and on the checking engine. `$name` stands for
a driver table.
"""

import re

from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

NOW = "2024-02-01 00:00:00"


def uri_sql(u):
    return (
        f"'gs://audit-' || cast({u} % 3 as string) || '/site' || cast({u} % 10 as string)"
        f" || '/img' || cast({u} as string)"
        f" || case when {u} % 7 = 0 then '.txt' when {u} % 7 = 1 then '.JPEG' else '.jpg' end"
    )


OBJECT_EVENT = [
    "event_id",
    f"{uri_sql('user_id')} as gcs_uri",
    "case when event_id % 13 = 0 then null else event_id + 1 end as generation",
    "case when event_type = 'error' then 'delete' else 'finalize' end as kind",
]

# Objects that have jobs; every fifth one has none.
KNOWN = (
    "select user_id as u from $events where user_id % 5 <> 0"
    " union select o_orderkey as u from $orders where o_orderkey % 5 <> 0"
)

SQL = {
    "object_events": f"select {', '.join(OBJECT_EVENT)} from $events",
    "versions": """
        select 'v1' as prompt_version_id union all select 'v2' as prompt_version_id""",
    "jobs_by_age": f"""
        select {uri_sql('u')} as gcs_uri, 'v' || cast(v as string) as prompt_version_id, u, v,
          case (u + v) % 6 when 0 then 'QUEUED' when 1 then 'PROCESSING'
            when 2 then 'PROCESSED' when 3 then 'FAILED_RETRY'
            when 4 then 'FAILED_PERMANENT' else 'DELETING' end as status,
          case when u % 11 = 0 then null else u * 37 + v end as generation,
          u % 7 as attempts, (u * 17 + v * 5) % 240 as age_min,
          case when (u + v) % 6 in (3, 4) then 'broke ' || cast(u as string) end as error_message
        from (select u, 1 + u % 1 as v from ({KNOWN}) a
              union all select u, 2 + u % 1 as v from ({KNOWN}) b) e""",
    "inventory": f"""
        select {uri_sql('u')} as gcs_uri, u * 50 + 1 as generation
        from (select distinct user_id as u from $events where user_id % 3 <> 0) t""",
    "results": f"""
        select case when l_orderkey % 97 = 0 then null
            else 'img' || cast(l_orderkey - l_orderkey % 2 as string) end as image_id,
          case when l_orderkey % 89 = 0 then null when l_orderkey % 83 = 0 then ''
            when l_orderkey % 79 = 0 then 'gs://bare' else {uri_sql('l_orderkey')} end as gcs_uri,
          'v' || cast(1 + l_linenumber % 2 as string) as prompt_version_id,
          l_orderkey as row_id, l_linenumber as line_no,
          case l_orderkey % 4 when 1 then 'gs://thumbs/t' || cast(l_orderkey as string) || '_'
              || cast(l_linenumber as string) || '.webp'
            when 2 then 'nothumb' when 3 then '' end as gcs_thumb_uri,
          'https://old.example/' || cast(l_orderkey as string) as raw_signed_url,
          'https://old.example/t' || cast(l_linenumber as string) as thumb_signed_url,
          l_shipdate as processing_timestamp
        from $lineitem""",
    "updates": """
        select 'img' || cast(k as string) as image_id,
          'https://new.example/' || cast(k as string) as raw_signed_url,
          case when k % 4 = 0 then '' else 'https://new.example/t' || cast(k as string) end as thumb_signed_url,
          case when k % 9 = 0 then null else 'gs://thumbs/n' || cast(k as string) end as gcs_thumb_uri
        from (select distinct o_orderkey - o_orderkey % 2 as k from $orders where o_orderstatus = 'F') t""",
    "all_updates": """
        select 'img' || cast(o_orderkey as string) as image_id,
          'https://new.example/' || cast(o_orderkey as string) as raw_signed_url,
          case when o_orderkey % 4 = 0 then '' else 'https://new.example/t' || cast(o_orderkey as string) end
            as thumb_signed_url,
          case when o_orderkey % 9 = 0 then null else 'gs://thumbs/n' || cast(o_orderkey as string) end
            as gcs_thumb_uri
        from $orders""",
    "thumbs": """
        select 'gs://audit-' || cast(o_orderkey % 3 as string) || '-thumbnails/thumbnails/img'
          || cast(o_orderkey - o_orderkey % 2 as string) || '_thumb.webp' as thumb_uri
        from $orders where o_orderpriority < '4'
        union all
        select 'gs://thumbs/t' || cast(l_orderkey as string) || '_' || cast(l_linenumber as string)
          || '.webp' as thumb_uri
        from $lineitem where l_returnflag = 'A'""",
    "fractions": """
        select g.audit_id, g.class, g.material, g.q / t.total as estimated_percentage,
          t.total * (g.q / t.total) as scaled_weight, t.total
        from (select l_orderkey as audit_id, p_type as class, p_brand as material, sum(l_quantity) as q
              from $lineitem join $part on l_partkey = p_partkey group by l_orderkey, p_type, p_brand) g
        join (select l_orderkey as audit_id, sum(l_quantity) as total from $lineitem
              join $part on l_partkey = p_partkey group by l_orderkey) t on g.audit_id = t.audit_id""",
    "materials": """
        select p_type as class, p_brand as material,
          case when p_partkey % 10 = 0 then 'n/a' when p_partkey % 10 = 1 then ''
            else cast(p_size as string) end as density,
          case when p_partkey % 23 = 0 then null else p_name end as description, p_partkey as ord
        from $part""",
    "general": """
        select case when s_suppkey % 17 = 0 then '' else 'k' || cast(s_suppkey % 40 as string) end as key,
          case when s_suppkey % 5 = 0 then 'Only {material_details}'
            when s_suppkey % 7 = 0 then 'Use {material_details} and {detected_materials}'
            else s_name || ': {material_details} / {material_densities_class} / {detected_materials} {{end}}'
          end as value, s_suppkey as ord
        from $supplier""",
    "models": """
        select 'v' || cast(c_custkey - c_custkey % 2 as string) as prompt_version_id,
          case when c_custkey % 9 = 0 then '' else lower(c_mktsegment) end as model_name,
          case c_custkey % 4 when 0 then ' low ' when 2 then '' when 3 then 'Medium' end as thinking_level,
          'k' || cast(c_custkey % 45 as string) as system_key,
          'k' || cast(c_custkey % 41 as string) as prompt_key,
          case c_custkey % 3 when 0 then 'true' when 1 then 'TRUE' else 'no' end as code_execution,
          c_custkey as ord
        from $customer""",
}


def _on_spark(text, sf_dir):
    return re.sub(r"\$(\w+)", lambda m: f"parquet.`{sf_dir}/{m.group(1)}.parquet`", text)


def oracle_text(name):
    return re.sub(r"\$(\w+)", r"\1", SQL[name])


def with_views(names, body):
    """Oracle text: the stand-ins as common table expressions before `body`."""
    ctes = ",\n".join(f"{n} as ({oracle_text(n)})" for n in names.split())
    return f"with {ctes}\n{body}" if not body.lstrip().startswith(",") else f"with {ctes}{body}"


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark, sf_dir, name):
    return spark.sql(_on_spark(SQL[name], sf_dir))


def now():
    return F.lit(NOW).cast("timestamp")


def jobs(spark, sf_dir, extra=()):
    """Job table; ages before `now` become the lease times of each state."""
    then = now() - F.make_dt_interval(mins=F.col("age_min"))
    status = F.col("status")
    return view(spark, sf_dir, "jobs_by_age").select(
        "gcs_uri",
        "prompt_version_id",
        "status",
        F.when(status != "DELETING", then).alias("queued_at"),
        "generation",
        "attempts",
        F.when(~status.isin("QUEUED", "DELETING"), then).alias("last_processed_at"),
        "error_message",
        F.when(status == "DELETING", then).alias("deleting_at"),
        *extra,
    )


def finalize_events(spark, sf_dir):
    events = view(spark, sf_dir, "object_events")
    return events.where("kind = 'finalize'").drop("kind")


def delete_events(spark, sf_dir):
    events = view(spark, sf_dir, "object_events")
    return events.where("kind = 'delete'").drop("kind")


# Faults put into the responses: audit id divisible by the number.
FAULTS = {
    11: "no_json",
    13: "invalid_json",
    17: "empty_response",
    19: "empty_result",
    23: "not_an_object",
    29: "no_total",
    31: "boolean_fraction",
    37: "zero_total",
}


def fault_sql(col="audit_id"):
    """The fault of an audit as SQL; NULL for a sound response."""
    arms = " ".join(f"when {col} % {n} = 0 then '{f}'" for n, f in FAULTS.items())
    return f"case {arms} end"


def responses(spark, sf_dir):
    """One free-text response per order, holding class -> material -> fraction.

    Lines are summed per (order, class, material) before an order is folded
    into one row, so the folded list is bounded by the taxonomy.
    """
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    sums = (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("l_orderkey").alias("audit_id"), "p_type", "p_brand")
        .agg(F.sum("l_quantity").alias("q"))
    )
    orders = sums.groupBy("audit_id").agg(
        F.collect_list(F.struct("p_type", "p_brand", "q")).alias("items"),
        F.sum("q").alias("total"),
    )

    def materials(kind):
        mine = F.filter("items", lambda i: i["p_type"] == kind)
        return F.map_from_entries(
            F.transform(mine, lambda i: F.struct(i["p_brand"], (i["q"] / F.col("total"))))
        )

    kinds = F.array_distinct(F.transform("items", lambda i: i["p_type"]))
    body = F.to_json(F.map_from_entries(F.transform(kinds, lambda k: F.struct(k, materials(k)))))
    rest = F.substr(body, F.lit(2))

    def document(total):
        return F.concat(F.lit('{"TotalWeightLbs": '), total, F.lit(", "), rest)

    sound = document(F.col("total").cast("string"))
    fault = F.expr(fault_sql())
    payload = (
        F.when(fault == "invalid_json", F.lit('{"TotalWeightLbs": oops}'))
        .when(fault == "empty_result", F.lit("{}"))
        .when(fault == "not_an_object", F.lit("[1, 2]"))
        .when(fault == "no_total", body)
        .when(fault == "zero_total", document(F.lit("0")))
        .when(fault == "boolean_fraction", F.concat(F.lit('{"extra": {"flag": true}, '), F.substr(sound, F.lit(2))))
        .otherwise(sound)
    )
    fenced = F.concat(F.lit("The pile was measured in steps.\n```json\n"), payload, F.lit("\n```\nDone."))
    bare = F.concat(F.lit("Result: "), payload, F.lit(" end"))
    # An array is only found inside a fence.
    unfenced = (F.col("audit_id") % 7 == 0) & ~fault.eqNullSafe(F.lit("not_an_object"))
    return orders.select(
        "audit_id",
        F.when(fault == "no_json", "Nothing could be measured.")
        .when(fault == "empty_response", "")
        .when(unfenced, bare)
        .otherwise(fenced)
        .alias("response"),
    )
