"""Quality of the given entities and mapping of attributes: rows with texts are moved where they are compared, and nowhere else."""

import __spark_entry__
from specweave.operators.cleaning import delivered_once, delivered_once_in_place
from specweave.session import Shelf

ROOT = "/root/testdata/sf0.001"


def kept_columns(monkeypatch, name, spark):
    """The columns of each table that a query writes on the way, and its rows."""
    kept, keep = [], Shelf.keep

    def spy(shelf, df):
        kept.append(set(df.columns))
        return keep(shelf, df)

    monkeypatch.setattr(Shelf, "keep", spy)
    return kept, __spark_entry__.queries()[name](spark, ROOT).collect()


def test_repeated_deliveries_are_left_out_in_place(spark):
    rows = [(1, "d", "a"), (2, "d", "a"), (3, "d", "b"), (4, None, "a"), (5, None, "a"), (None, "d", "c"), (7, "e", None), (6, "e", None)]
    df = spark.createDataFrame(rows, "record_id bigint, document_id string, chunk_id string")
    want = sorted(r.record_id for r in delivered_once(df, ["document_id", "chunk_id"]).collect())
    assert want == [1, 3, 4, 6]
    for few in (10, 0):
        assert sorted(r.record_id for r in delivered_once_in_place(df, ["document_id", "chunk_id"], few).collect()) == want


def test_quality_reviews_writes_no_texts_of_chunks(spark, monkeypatch):
    kept, rows = kept_columns(monkeypatch, "quality_reviews", spark)
    assert rows and not any("source_text" in columns for columns in kept)
    assert sum("supporting_evidence" in columns for columns in kept) == 1  # the canonical entities


def test_unmapped_attributes_writes_no_attributes(spark, monkeypatch):
    kept, rows = kept_columns(monkeypatch, "unmapped_attributes", spark)
    assert rows and not any({"source_text", "binding", "_entity_name"} & columns for columns in kept)
