import random
from datetime import datetime, timedelta
from functools import reduce

from specweave.operators.references import TARGETS, current_orphans, deltas_of, missing_references, orphan_report

D = datetime
EXTRA = ", key string, target string, at string, live int, delta string"


def tables(spark, chunks=(), attributes=(), mappings=(), entities=(), cents=(), edges=()):
    pad = ("x", "y", "z", 1, "w")
    make = lambda rows, ddl: spark.createDataFrame([(*r, *pad) for r in rows], ddl + EXTRA)
    return {
        "chunks": make(chunks, "record_id bigint, chunk_id string, loaded_at timestamp_ntz, deleted_at timestamp_ntz"),
        "attributes": make(attributes, "record_id bigint, attribute_id string, source_chunk string, loaded_at timestamp_ntz, deleted_at timestamp_ntz"),
        "mappings": make(mappings, "record_id bigint, mapping_id string, entity_id string, loaded_at timestamp_ntz, deleted_at timestamp_ntz"),
        "entities": make(entities, "record_id bigint, entity_id string, source_attributes array<string>, loaded_at timestamp_ntz, deleted_at timestamp_ntz"),
        "canonical_entities": make(cents, "record_id bigint, canonical_id string, loaded_at timestamp_ntz, deleted_at timestamp_ntz"),
        "trace_edges": make(edges, "record_id bigint, to_id string, loaded_at timestamp_ntz"),
    }


def found(frames):
    return sorted(((r.table_name, r.record_id, r.ref_field, r.ref_id, r.period) for r in missing_references(frames).collect()), key=str)


def sample(spark):
    return tables(
        spark,
        chunks=[(1, "Chunk-a ", D(2024, 1, 2), None), (2, "chunk-b", D(2024, 1, 2), D(2024, 2, 1)), (3, "chunk-c", D(2024, 5, 1), D(2024, 4, 1)), (4, None, None, None), (5, "chunk-b", D(2024, 3, 1), None)],
        attributes=[
            (1, "attr-1", " CHUNK-A", D(2024, 1, 2), None),  # arrives together with its chunk
            (2, "attr-2", "chunk-a", D(2024, 1, 1), None),  # before it
            (3, "attr-3", "chunk-b", D(2024, 2, 1), None),  # withdrawn at this moment
            (4, "attr-4", "chunk-b", D(2024, 3, 2), None),  # delivered again
            (5, "attr-5", "chunk-c", D(2024, 6, 1), None),  # withdrawn before it came
            (6, "attr-6", " ", D(2024, 6, 1), None),
            (7, "attr-7", None, D(2024, 6, 1), None),
            (8, "attr-8", "chunk-a", None, None),
        ],
        mappings=[(1, "map-1", "ent-1", D(2024, 6, 1), None)],
        entities=[(1, "ent-1", ["attr-1", "ATTR-1 ", "attr-9", None, ""], D(2024, 6, 1), None), (2, "ent-2", None, D(2024, 6, 1), None)],
        edges=[(1, "map-1", D(2024, 7, 1)), (2, "map-2", D(2024, 7, 1)), (3, "what-2", D(2024, 7, 1)), (4, None, D(2024, 7, 1))],
    )


EXPECTED = sorted([
    ("attributes", 2, "source_chunk", "chunk-a", "2024-01"),
    ("attributes", 3, "source_chunk", "chunk-b", "2024-02"),
    ("attributes", 5, "source_chunk", "chunk-c", "2024-06"),
    ("attributes", 8, "source_chunk", "chunk-a", None),
    ("entities", 1, "source_attributes", "attr-9", "2024-06"),
    ("mappings", 1, "entity_id", "ent-1", "2024-06"),
    ("trace_edges", 2, "to_id", "map-2", "2024-07"),
], key=str)


def test_states_at_the_time_of_the_reference(spark):
    assert sorted(found(sample(spark)), key=str) == EXPECTED


def test_against_brute_force(spark):
    rng = random.Random(2)
    moment = lambda: None if rng.random() < 0.05 else D(2024, 1, 1) + timedelta(seconds=rng.choice((1, 20, 3600)) * rng.randint(0, 40))
    chunks = [(i, f"chunk-{rng.choice('abc')}", moment(), moment() if rng.random() < 0.6 else None) for i in range(60)]
    refs = [(i, f"attr-{i}", f"CHUNK-{rng.choice('abcd')}", moment(), None) for i in range(300)]

    def orphan(ref):
        alive = [1 for _, key, born, gone in chunks if ref[3] and key == ref[2].lower() and born and born <= ref[3] and (gone is None or gone > ref[3])]
        return not alive

    got = {r[1] for r in found(tables(spark, chunks=chunks, attributes=refs))}
    assert got == {r[0] for r in refs if orphan(r)} and 0 < len(got) < 300


def test_current_report_counts_withdrawn_references_and_rows(spark):
    frames = tables(
        spark,
        chunks=[(1, "chunk-a", D(2024, 1, 2), D(2024, 2, 1)), (2, "chunk-b", D(2024, 1, 2), None)],
        attributes=[(1, "attr-1", "chunk-a", D(2024, 1, 3), None), (2, "attr-2", "Chunk-A", D(2024, 1, 3), None), (3, "attr-3", "chunk-b", D(2024, 1, 3), None), (4, "attr-4", "chunk-z", D(2024, 1, 3), D(2024, 1, 4))],
    )
    deltas = reduce(lambda a, b: a.unionByName(b), [deltas_of(rows, name) for name, rows in frames.items()])
    assert [tuple(r) for r in current_orphans(deltas).collect()] == [("chunks", "chunk-a", 2)]


def test_stream(spark, tmp_path):
    from specweave.streaming.deltas import follow, orphans_now

    folders = {n: str(tmp_path / n) for n in ("chunks", "attributes", "chunks-back", "attributes-back")}
    plain = tables(spark)
    schemas = {n: plain[n].schema for n in ("chunks", "attributes")}
    for n, folder in folders.items():
        plain[n.removesuffix("-back")].write.parquet(folder)

    def step(**rows):
        for name, some in rows.items():
            n = name.replace("_", "-")
            tables(spark, **{n.removesuffix("-back"): some})[n.removesuffix("-back")].write.mode("append").parquet(folders[n])
        follow(spark, {n: folders[n] for n in schemas}, {n: folders[f"{n}-back"] for n in schemas}, schemas, str(tmp_path / "store"), str(tmp_path / "cp")).awaitTermination()
        return {tuple(r) for r in orphans_now(spark, str(tmp_path / "store")).collect()}

    ref, chunk = (1, "attr-1", "chunk-a", D(2024, 1, 3), None), (1, "chunk-a", D(2024, 2, 1), None)
    assert step(attributes=[ref]) == {("chunks", "chunk-a", 1)}
    assert step(chunks=[chunk]) == set()  # the target came a month later
    assert step(chunks_back=[chunk]) == {("chunks", "chunk-a", 1)}
    assert step(attributes_back=[ref]) == set()


def test_empty_tables(spark):
    assert found(tables(spark)) == []
    assert orphan_report(missing_references(tables(spark))).count() == 0
    assert set(TARGETS) < set(tables(spark))
