"""Registered queries of the training-data operators and their DuckDB twins."""

from __future__ import annotations

from specweave.llm import components, fusion, leakage, lookalikes, names, scans, splitting, tokens

QUERIES = {
    "p1_found": fusion.p1_found,
    "p1_fused": fusion.p1_fused,
    "p4_found": scans.p4_found,
    "p4_paragraphs": scans.p4_paragraphs,
    "p5_found": components.p5_found,
    "p6_found": splitting.p6_found,
    "p6_pieces": splitting.p6_pieces,
    "p7_found": names.p7_found,
    "p7_unmatched": names.p7_unmatched,
    "p8_ids": tokens.p8_ids,
    "p9_found": leakage.p9_found,
    "p9_tolerant": leakage.p9_tolerant,
    "p10_found": lookalikes.p10_found,
    "p10_classes": lookalikes.p10_classes,
    "p10_repaired": lookalikes.p10_repaired,
}
ORACLES = {"p1_found": fusion.SQL_FOUND, "p5_found": components.SQL_FOUND, "p6_found": splitting.SQL_FOUND}
