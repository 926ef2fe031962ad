import random

from specweave.operators import chunking, cleaning
from specweave.operators.chunking import _packed
from specweave.sources.lexicons import Lexicon

DDL = "document_id string, ord int, block_id string, page int, kind string, text string, heading_level int, tbl struct<caption:string,header:array<string>,rows:array<array<string>>,subject_hint:string>"


def blocks(spark, rows):
    return spark.createDataFrame([(d, i, f"{d}-{i}", p, k, t, n, None) for d, i, p, k, t, n in rows], DDL)


def test_packing_properties():
    rng = random.Random(1)
    for _ in range(200):
        rows = [(f"b{i}", 1, "table" if rng.random() < 0.1 else "paragraph", "", rng.randint(1, 60)) for i in range(rng.randint(0, 40))]
        done = list(_packed(iter(rows), 100, 30))
        fresh = [r[0] for held, at in done for r in held[at:]]
        assert fresh == [r[0] for r in rows]  # every block is new in exactly one chunk, in order
        for held, at in done:
            assert not any(r[2] == "table" for r in held[:at]) and sum(r[4] for r in held[:at]) <= 30
            assert len(held) == 1 or not any(r[2] == "table" for r in held)
            assert sum(r[4] for r in held) <= 100 + 60 or len(held) - at == 1


def test_heading_paths_and_ids(spark):
    b = blocks(spark, [("d", 0, 1, "heading", "A", 1), ("d", 1, 1, "paragraph", "x", None), ("d", 2, 1, "heading", "B", 2), ("d", 3, 2, "heading", "C", 4), ("d", 4, 2, "paragraph", None, None), ("d", 5, 2, "heading", "D", 1), ("e", 0, 1, "paragraph", "only", None)])
    got = {r.chunk_id: (r.heading_path, r.block_ids) for r in chunking.heading_aware(b).collect()}
    assert got == {
        "chunk-d-p0001-0000": (["A"], ["d-0", "d-1"]), "chunk-d-p0001-0001": (["A", "B", "C"], ["d-2", "d-3", "d-4"]), "chunk-d-p0002-0000": (["D"], ["d-5"]), "chunk-e-p0001-0000": ([], ["e-0"]),
    }
    assert chunking.chunk_problems(chunking.heading_aware(b), b).count() == 0
    assert {r.block_ids[0] for r in chunking.by_page(b).collect()} == {"d-0", "d-3", "e-0"}


def test_long_documents_in_buckets(spark):
    rows = [("d", i, 1 + i // 50, "heading" if i % 7 == 0 else "paragraph", f"t{i}", 1 + i % 3 if i % 7 == 0 else None) for i in range(300)]
    b = blocks(spark, rows)
    cut = lambda size: sorted(str(r) for r in chunking.heading_state(b, bucket=size).select("block_id", "section", "heading_path").collect())
    assert cut(4096) == cut(16) == cut(3)
    deep = blocks(spark, [("d", i, 1, "heading", f"H{n}", n) for i, n in enumerate((9, 10, 11, 10, 12, 2))])
    paths = {r.ord: r.heading_path for r in chunking.heading_state(deep, bucket=2).collect()}
    assert paths == {0: ["H9"], 1: ["H9", "H10"], 2: ["H9", "H10", "H11"], 3: ["H9", "H10"], 4: ["H9", "H10", "H12"], 5: ["H2"]}


def test_blocks_without_page(spark):
    b = blocks(spark, [("d", 0, 1, "paragraph", "one", None), ("d", 1, None, "paragraph", "two", None), ("d", 2, None, "paragraph", "w " * 700, None)])
    for made in (chunking.by_page(b), chunking.by_page(b, 3), chunking.fixed_tokens(b), chunking.heading_aware(b)):
        rows = made.collect()
        assert {x for r in rows for x in r.block_ids} == {"d-0", "d-1", "d-2"} and len({r.chunk_id for r in rows}) == len(rows)


def test_terms_are_found_as_they_are_written(spark):
    from specweave.operators.mentions import mentions

    texts = spark.createDataFrame([(1, "an Airline Card and a Line-Card"), (2, "two line cards"), (3, "the very long name of a thing that has nine words indeed"), (4, None), (5, "")], "id int, text string")
    terms = spark.createDataFrame([("entity", "Line Card", 0, "Line Card", 0), ("entity", "long", 1, "very long name of a thing that has nine words", 0)], "source string, canonical string, canonical_ord int, term string, term_ord int")
    assert {(r.id, r.canonical) for r in mentions(texts, ["id"], terms).collect()} == {(2, "Line Card"), (3, "long")}


def test_furniture_and_subjects(spark):
    b = blocks(spark, [("d", 0, 1, "paragraph", "Acme Manual", None), ("d", 1, 1, "paragraph", "text", None), ("d", 2, 2, "paragraph", "Acme Manual", None), ("d", 3, 2, "heading", "Ports", 2), ("d", 4, 2, "table", "t", None), ("d", 5, 2, "paragraph", "Table 3 – Port list", None), ("e", 0, 1, "paragraph", "Acme Manual", None), ("e", 1, 1, "paragraph", "Page 2 of 3", None), ("e", 2, 1, "table", "u", None)])
    assert {r.block_id for r in cleaning.mark_furniture(b, Lexicon()).filter("kind = 'furniture'").collect()} == {"d-0", "d-2", "d-5", "e-1"}
    assert {(r.block_id, r.caption, r.subject_hint) for r in cleaning.table_subjects(b).collect()} == {("d-4", "Table 3 – Port list", "Port list"), ("e-2", None, None)}
    assert cleaning.mark_furniture(blocks(spark, [])).count() == 0
