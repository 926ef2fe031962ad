"""Comparisons of entities without making all pairs: the results are those of all pairs."""

import random

import pandas as pd
from pyspark.sql import functions as F

from specweave.operators import duplicates, nearest
from specweave.operators.mapping import targets
from specweave.sources.lexicons import Lexicon

ENTITY = (
    "document_id string, entity_id string, entity_name string, normalized_entity_name string, entity_type string, source_chunks array<string>, source_attributes array<string>, "
    "supporting_evidence array<struct<chunk_id:string,text:string>>"
)
WORDS = ["relay", "Relay", "tray", "gateway", "Gatewya", "outage", "meter", "of", "copper", "circuit", "EVC"]


def entities(spark, sizes):
    rng = random.Random(7)
    rows = []
    for d, n in enumerate(sizes):
        for i in range(n):
            name = " ".join(rng.sample(WORDS, rng.randint(1, 3)))
            some = lambda p, k: rng.choice([None, [], *[[f"{p}{rng.randrange(max(2, n // 3))}" for _ in range(rng.randint(1, k))] for _ in range(6)]])  # noqa: E731, B023
            ev = [(f"c{rng.randrange(9)}", rng.choice([None, "", "ab", f"The {name} shall be {rng.randrange(20)} V", "Same text here"])) for _ in range(rng.randint(0, 3))]
            rows.append((f"d{d}", f"e{i:03d}", name, rng.choice([name.lower(), name.lower(), None, "relay tray"]), rng.choice(["Object", "Service", None]), some("c", 3), some("a", 4), rng.choice([None, ev, ev, ev])))
            if i and rng.random() < 0.3:  # told twice
                rows[-1] = (f"d{d}", f"e{i:03d}", *rows[-2][2:4], *rows[rng.choice([-1, -2])][4:5], *rows[-2][5:])
    return spark.createDataFrame(rows, ENTITY)


def all_pairs(e, lexicon):
    e = duplicates.compared(e)
    side = lambda p: e.select([F.col(c).alias(f"{p}_{c}") for c in e.columns])
    return duplicates.features(side("a").join(side("b"), (F.col("a_document_id") == F.col("b_document_id")) & (F.col("a_entity_id") < F.col("b_entity_id"))), lexicon)


def test_nearest_is_that_of_all_pairs(spark):
    e, lexicon = entities(spark, [1, 2, 9, 90]).cache(), Lexicon()
    every = all_pairs(e, lexicon)
    want = {(r.document_id, r.id): r.best for r in every.select("document_id", F.explode(F.array("a", "b")).alias("id"), "composite").groupBy("document_id", "id").agg(F.max("composite").alias("best")).collect()}
    for block in (8192, 20):  # one block, five blocks
        got = {(r.document_id, r.entity_id): r.nearest for r in nearest.nearest(e, lexicon, block).collect()}
        assert got.keys() == want.keys()
        assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_duplicates_are_those_of_all_candidates(spark):
    e, lexicon = entities(spark, [5, 60]).cache(), Lexicon(aliases={"relay": ["meter"], "copper circuit": ["EVC"]})
    rows = lambda df: {(r.document_id, r.a, r.b): (round(r.composite, 9), r.classification, r.reason) for r in df.filter("classification <> 'DISTINCT'").collect()}
    want = rows(duplicates.features(duplicates.candidate_pairs(e, lexicon), lexicon))
    assert want and rows(duplicates.duplicate_pairs(e, lexicon)) == want
    assert rows(duplicates.judged(nearest.likely_pairs(e, lexicon, 20))) == want


def test_few_names_of_a_large_document_are_compared():
    rng = random.Random(3)
    n = 600
    names = ["".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) + " " + rng.choice(WORDS) for _ in range(n)]
    rows = pd.DataFrame({"document_id": "d", "entity_id": [f"e{i}" for i in range(n)], "entity_name": names, "normalized_entity_name": names, "entity_type": "Object", "texts": [[f"evidence of {x}"] for x in names], "keys": [[x] for x in names], "side": 0})
    rows["source_chunks"] = rows["source_attributes"] = [[] for _ in range(n)]
    duplicates.token_set_ratio.cache_clear()
    assert len(nearest._nearest(rows, {})) == n
    assert duplicates.token_set_ratio.cache_info().misses < 0.1 * n * (n - 1) / 2


def test_targets_carry_no_texts_of_chunks_or_evidence(spark):
    e = spark.createDataFrame([("d", "e1", "Relay"), ("d", "e2", "Tray")], "document_id string, entity_id string, entity_name string")
    c = spark.createDataFrame([("d", "c1", ["e1"], ["k1"]), ("d", "c2", ["e2"], ["k9"])], "document_id string, canonical_id string, member_ids array<string>, source_chunks array<string>")
    q = spark.createDataFrame([("d", "c1", "ACCEPT", 0.9), ("d", "c2", "REVIEW", 0.9)], "document_id string, canonical_id string, validation_status string, overall_score double")
    bound = "struct<entity_name:string,evidence:string,scope:string,confidence:double>"
    a = spark.createDataFrame(
        [("d", f"a{i}", "k1", "It SHALL work", (name, None, "syntactic", 0.9), 0.9, []) for i, name in enumerate(["RELAY", "tray", None, "unheard of"])],
        f"document_id string, attribute_id string, source_chunk string, source_text string, binding {bound}, confidence double, evidence array<struct<chunk_id:string,text:string>>",
    )
    got = targets(a, e, c, q)
    assert not {"source_text", "_text", "evidence", "supporting"} & set(got.columns)
    assert {r.attribute_id: (r.canonical_id, r.rejection, r.relationship_type) for r in got.collect()} == {
        "a0": ("c1", None, "constrains"), "a1": ("c2", "ineligible_entity", "constrains"), "a2": (None, "dangling", "constrains"), "a3": (None, "unresolved_entity", "constrains"),
    }
