"""The whole pipeline over two small documents: what it finds, that documents don't mix, resuming, exit codes."""

import json
from xml.etree import ElementTree

import pytest

from specweave import config
from specweave.operators import duplicates, outputs
from specweave.plans import cli
from specweave.plans.pipeline import StageError, run_pipeline
from specweave.sources.lexicons import Lexicon
from specweave.sources.markdown import parse_texts

SPEC = """# Access Service Handbook

## 2 Overview

The operator offers an EVC between two UNIs. Each Subscriber SHALL have an IMSI and an MSISDN.

## 3 Attributes

### 3.1 EVC Service Attributes

| Attribute | Type | Units | M/O/C | Range | Default | Description |
| --- | --- | --- | --- | --- | --- | --- |
| CIR | Integer | Mbps | M | 10–1000 | 100 | Committed Information Rate of the EVC |
| Frame Delay | Number | ms | O | | 5 | One way |
| | Integer | ms | O | | 5 | has no name |

Page 1 of 1
"""
OTHER = "# Notes\n\nNothing but an EVC here.\n"


@pytest.fixture(scope="module")
def done(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run"))
    texts = spark.createDataFrame([("doc-1", SPEC), ("doc-2", OTHER), ("doc-3", ""), ("doc-4", None)], "document_id string, text string")
    return run_pipeline(parse_texts(texts), out), out, texts


def test_attributes(done):
    rows = {r.attribute_name: r for r in done[0].tables["attributes"].collect()}
    cir = rows["cir"]
    assert (cir.entity, cir.score.raw_sum, cir.confidence, cir.score.route, cir.optionality) == ("EVC", 1.5, 1.0, "accept", "M")
    assert (cir.unit.base, cir.unit.factor, cir.value_domain.kind, cir.value_domain["from"], cir.aliases) == ("bit/s", 1e6, "range", 10.0, ["Committed Information Rate"])
    assert rows["frameDelay"].entity == "EVC" and rows["imsi"].binding.scope == "syntactic"
    assert {r.document_id for r in rows.values()} == {"doc-1"}


def test_entities_mappings_and_edges(done):
    t = done[0].tables
    names = {(r.document_id, r.entity_name) for r in t["entities"].collect()}
    assert ("doc-1", "EVC") in names and not any(d == "doc-2" for d, _ in names)
    assert t["mappings"].filter("relationship_type = 'has_attribute'").count() >= 2
    kinds = {r.kind for r in t["trace_edges"].select("kind").distinct().collect()}
    assert {"document>chunk", "chunk>attribute", "attribute>entity", "entity>canonical", "attribute>mapping", "mapping>entity"} == kinds
    text = "".join(r.text for r in t["final"].filter("document_id = 'doc-1'").orderBy("seq").collect())
    final = json.loads(text)
    assert set(final) == {"attributes", "dangling", "document", "entities", "mappings", "review", "review_queue", "trace", "unmapped"}
    assert len(final["mappings"]) == t["mappings"].filter("document_id = 'doc-1'").count() and final["document"][0]["chunk_count"] == t["chunks"].filter("document_id = 'doc-1'").count()
    merged = t["canonical_entities"].filter("size(member_ids) > 1").count()
    assert t["review"].count() == merged + t["decisions"].filter("validation_status <> 'ACCEPT'").count() and t["dangling"].count() == t["attributes"].filter("entity is null").count()


def test_graphs(done):
    edges = done[0].tables["trace_edges"]
    said = {f: "".join(r.text for r in outputs.documents_graph(edges, f).filter("document_id = 'doc-1'").orderBy("seq").collect()) for f in ("json", "graphml")}
    mine = edges.filter("document_id = 'doc-1'")
    graph, xml = json.loads(said["json"]), ElementTree.fromstring(said["graphml"])
    assert len(graph["edges"]) == mine.distinct().count() and {n["id"] for n in graph["nodes"]} == {r.node_id for r in outputs.nodes(mine).collect()}
    assert len(list(xml.iter("{http://graphml.graphdrawing.org/xmlns}node"))) == len(graph["nodes"])


def test_wrong_outputs_are_refused(done, tmp_path):
    wrong = {"chunking": lambda run: {"chunks": done[0].tables["chunks"].unionByName(done[0].tables["chunks"])}}
    with pytest.raises(StageError, match="twice"):
        run_pipeline(parse_texts(done[2]), str(tmp_path), overrides=wrong)
    t = done[0].tables
    assert duplicates.partition_problems(t["entities"], t["canonical_entities"], t["decisions"]).count() == 0
    assert duplicates.partition_problems(t["entities"], t["canonical_entities"].limit(0), t["decisions"]).count() == t["entities"].count() + t["decisions"].count()


def test_resume(done):
    run, out, texts = done
    again = run_pipeline(parse_texts(texts), out)
    assert all(r.get("resumed") for r in again.records) and outputs.same_rows(again.tables["mappings"], run.tables["mappings"])
    with pytest.raises(StageError):
        run_pipeline(parse_texts(texts), out, resume_from="no_stage")
    with pytest.raises(StageError):
        run_pipeline(parse_texts(texts), out + "-new", resume_from="chunking")


def test_settings_and_command_line(capsys):
    assert config.load(env={"SPECWEAVE__chunking__max_tokens": "5"})["chunking"]["max_tokens"] == 5
    with pytest.raises(ValueError):
        config.load({"chunking": {"strategy": "none"}}, env={})
    with pytest.raises(ValueError):
        config.load({"scoring": {"review": 0.9}}, env={})
    assert config.fingerprint(config.load(env={}), Lexicon()) != config.fingerprint(config.load({"provider": "mock"}, env={}), Lexicon())
    assert cli.main(["stages", "--json"]) == 0 and "final_output" in capsys.readouterr().out
    assert cli.main(["nonsense"]) == 2
    assert cli.main(["config", "--config", "/no/such/file"]) == 2
