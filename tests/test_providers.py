import json

import pytest

from specweave.functions.providers import RulesProvider, adjustments, answered, proposals, proposed_candidates, provider


def counting():
    class Counting:
        name = "counting"

        def call(self, task, payload):
            if task == "attribute_candidates":
                return {"candidates": [{"raw_name": "Port Speed", "source_text_quote": "a port speed", "sentence": None}, {"raw_name": "Made Up", "source_text_quote": "not there", "sentence": None}]}
            return {"specificity_delta": 0.1, "real_world_delta": -0.1, "asked": payload.get("x")}

    return Counting()  # a class of this module isn't there on the workers


def test_rules_know_aliases_and_types():
    rules = RulesProvider(known=(("Line Card", "Resource", ("LC", "Line Board")),))
    got = rules.call("entity_proposals", {"chunk_id": "c", "source_text": "The line board and an Airline Card", "known_entities": ["Port"]})
    assert got == {"entities": [{"entity_name": "Line Card", "entity_type": "Resource", "chunk_id": "c", "evidence_quote": "line board"}]}
    assert rules.call("binding_judgement", {"source_text": "the Port has a speed", "entity": "port", "attribute": "speed"}) == {"bound": True}
    with pytest.raises(ValueError):
        rules.call("nonsense", {})
    with pytest.raises(ValueError):
        provider("nonsense")


def test_answers_are_kept_and_replayed(spark, tmp_path):
    requests = spark.createDataFrame([(i, json.dumps({"x": i % 3})) for i in range(9)], "id int, payload string")
    store = str(tmp_path / "answers")
    first = {r.id: json.loads(r.answer)["asked"] for r in answered(requests, "entity_quality", counting(), store=store).collect()}
    assert first == {i: i % 3 for i in range(9)} and spark.read.parquet(store).count() == 3
    again = answered(requests, "entity_quality", counting(), cache=spark.read.parquet(store), store=str(tmp_path / "more"))
    assert again.count() == 9 and spark.read.parquet(str(tmp_path / "more")).count() == 0
    with pytest.raises(ValueError):
        answered(requests, "entity_quality", None)


def test_what_a_model_adds(spark):
    chunks = spark.createDataFrame([("d", "c", "It has a port speed. The Port.", ["b0", "b1"], ["H"])], "document_id string, chunk_id string, source_text string, block_ids array<string>, heading_path array<string>")
    blocks = spark.createDataFrame([("d", "b0", "The Port."), ("d", "b1", "It has a port speed.")], "document_id string, block_id string, text string")
    assert [(r.raw_name, r.block_id, r.origin) for r in proposed_candidates(chunks, blocks, counting()).collect()] == [("Port Speed", "b1", "llm")]
    assert [(r.name, r.origin) for r in proposals(chunks, ["Port"], RulesProvider()).collect()] == [("Port", "llm")]
    cents = spark.createDataFrame([("d", "cent-1", "Port", "Resource", [("c", "The Port.")])], "document_id string, canonical_id string, canonical_name string, entity_type string, supporting_evidence array<struct<chunk_id:string,text:string>>")
    assert [(r.specificity_delta, r.real_world_delta) for r in adjustments(cents, counting()).collect()] == [(0.1, -0.1)]
