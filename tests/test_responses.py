"""Flattening of responses, edge rows included."""

import json
import math

from pyspark.sql import functions as F

from auditloom.operators import quality, responses

CASES = {
    "plain": ('{"TotalWeightLbs": 10.0, "Cardboard": {"Boxes": 1.0}}', None,
              [("Cardboard", "Boxes", 1.0, 10.0), ("Class", "Cardboard", 1.0, 10.0)]),
    "no total": ('{"Cardboard": {"Boxes": 1.0}}', None, []),
    "text total": ('{"TotalWeightLbs": "10", "Cardboard": {"Boxes": 1.0}}', None, []),
    "boolean total": ('{"TotalWeightLbs": true, "A": {"b": 0.5}}', None,
                      [("A", "b", 0.5, 0.5), ("Class", "A", 0.5, 0.5)]),
    "zero total": ('{"TotalWeightLbs": 0, "A": {"b": 0.5}}', "zero_total", []),
    "zero total, nothing": ('{"TotalWeightLbs": 0}', None, []),
    "class not an object": ('{"TotalWeightLbs": 2, "A": 3, "B": [1], "C": {"x": 1}}', None,
                            [("C", "x", 1.0, 2.0), ("Class", "C", 1.0, 2.0)]),
    "text fraction": ('{"TotalWeightLbs": 2, "A": {"x": "0.5", "y": 0.25, "z": null}}', None,
                      [("A", "y", 0.25, 0.5), ("Class", "A", 0.25, 0.5)]),
    "boolean fraction": ('{"TotalWeightLbs": 2, "A": {"x": true, "y": 0.25}}', "boolean_fraction", []),
    "infinite": ('{"TotalWeightLbs": 1e308, "A": {"x": 100}}', "non_finite_weight", []),
    "empty class": ('{"TotalWeightLbs": 2, "A": {}}', None, []),
    "empty object": ("{}", "empty_result", []),
    "fenced array": ("```json [1] ```", "not_an_object", []),
    "fenced empty array": ("```json [] ```", "empty_result", []),
    "fenced null": ("```json null ```", "empty_result", []),
    "empty": ("", "empty_response", []),
    "absent": (None, "empty_response", []),
    "prose": ("nothing here", "no_json", []),
    "crossed": ("} {", "no_json", []),
    "empty fence": ('```json``` {"a": 1}', "no_json", []),
    "broken": ('{"a": }', "invalid_json", []),
    "repeated key": ('{"TotalWeightLbs": 1, "A": {"x": 0.1, "x": 0.4}}', None,
                     [("A", "x", 0.4, 0.4), ("Class", "A", 0.4, 0.4)]),
    "half even": ('{"TotalWeightLbs": 1, "A": {"x": 0.125}, "B": {"x": 0.375}}', None,
                  [("A", "x", 0.125, 0.125), ("B", "x", 0.375, 0.375),
                   ("Class", "A", 0.12, 0.125), ("Class", "B", 0.38, 0.375)]),
    "negative": ('{"TotalWeightLbs": 4, "A": {"x": -0.5, "y": 1}}', None,
                 [("A", "x", -0.5, -2.0), ("A", "y", 1.0, 4.0), ("Class", "A", 0.5, 2.0)]),
}


def frame(spark):
    return spark.createDataFrame([(k, v[0]) for k, v in CASES.items()], "name string, response string")


def test_rows_and_reasons(spark):
    scored = responses.score_rows(responses.parse_responses(frame(spark))).cache()
    reasons = {r.name: r.reason for r in scored.select("name", "reason").collect()}
    assert reasons == {k: v[1] for k, v in CASES.items()}
    got = {k: [] for k in CASES}
    for r in responses.explode_rows(scored).collect():
        got[r.name].append((r["class"], r.material, r.estimated_percentage, r.scaled_weight))
    for name, (_, _, want) in CASES.items():
        assert len(got[name]) == len(want), name
        for mine, theirs in zip(sorted(got[name]), sorted(want)):
            assert mine[:2] == theirs[:2], name
            assert all(math.isclose(a, b) for a, b in zip(mine[2:], theirs[2:])), name


def test_payload_keeps_the_document(spark):
    scored = responses.with_payload(responses.score_rows(responses.parse_responses(frame(spark))))
    kept = scored.where("name = 'plain'").first().model_result
    assert json.loads(kept) == json.loads(CASES["plain"][0])


def test_flatten_needs_no_shuffle_and_parses_once(spark, tmp_path):
    path = str(tmp_path / "responses")
    frame(spark).write.parquet(path)
    scored = responses.score_rows(responses.parse_responses(spark.read.parquet(path)))
    for df in (responses.explode_rows(scored), scored.where("reason is not null").select("name", "reason")):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan
        assert plan.count("parseJson") == 1


def test_rollup_of_stored_rows(spark):
    rows = responses.flatten_with_rollup(frame(spark)).cache()
    again = responses.class_rollup(rows, ["name"])
    want = rows.where("class = 'Class'").select("name", "class", "material", "estimated_percentage")
    got = again.select("name", "class", "material", "estimated_percentage")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_quality(spark):
    rows = spark.createDataFrame(
        [("a", "P", "x", 0.5, 50.0), ("a", "P", "y", 0.5, 75.0), ("a", "Class", "P", 1.0, 125.0),
         ("b", "P", "x", 0.5, 10.0), ("b", "Q", "z", 0.2, 1.0)],
        "id string, class string, material string, estimated_percentage double, scaled_weight double",
    )
    known = spark.createDataFrame(
        [("P", "x", 100), ("P", "y", 150)], "class string, material string, density bigint"
    )
    assert [r.material for r in quality.off_taxonomy(rows, known).collect()] == ["z"]
    assert {r.id: r.ok for r in quality.fraction_check(rows, ["id"]).collect()} == {"a": True, "b": False}
    assert {r.id: r.ok for r in quality.weight_check(rows, known, ["id"]).collect()} == {"a": True, "b": False}
