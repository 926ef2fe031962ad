import random

import pytest

from specweave.llm.scans import Reader, line_hash, number_shape, placed, readable_paragraphs, scan_defects, segments
from specweave.session import Shelf

DDL = "record_id bigint, document_id string, ord int, page int, kind string, text string, edge boolean, recurring string, lo int"
SUBJECTS = "operator engineer planner technician customer dispatcher auditor coordinator".split()
THINGS = "assignment inventory restoration procedure certificate reservation transmission configuration maintenance".split()


def sentence(rng):
    return f"The {rng.choice(SUBJECTS)} records every carrier-grade {rng.choice(THINGS)} before the {rng.choice(THINGS)} of {rng.randint(100, 999)} units closes."


@pytest.fixture(scope="module")
def blocks(spark):
    rng = random.Random(2)
    rows, n = [], 0
    for d in range(60):
        for page in range(1, 5):
            lines = [f"NORTHERN NETWORK OFFICE | Unit {d % 7}"] + [f"{sentence(rng)}\n{sentence(rng)}" for _ in range(4)] + [f"Page {page} of 4"]
            for i, t in enumerate(lines):
                n += 1
                rows.append((n, f"doc-{d}", page * 100 + i, page, "paragraph", t, None, None, None))
    extra = [
        "The operator records the main-\ntenance.", "The carrier-\ngrade procedure closes.", "The oper@tor records the rec0rds, the pr0cedure closes.", "The engineer records the\nNORTHERN NETWORK OFFICE | Unit 3\nprocedure before it closes.", "The planner records the procedure\n3/4\nof the certificate.",
        "The proce­\ndure closes.", None, "", "  \n ", "a" * 60_000,
    ]
    rows += [(10_000 + i, "doc-x", i, 1, "paragraph", t, None, None, None) for i, t in enumerate(extra)]
    rows.append((20_000, None, None, None, None, "The procedure closes.", None, None, None))
    return spark.createDataFrame(rows, DDL)


def test_defects(blocks):
    got = {}
    for r in scan_defects(blocks).collect():
        got.setdefault(r.record_id, set()).add(r.defect)
    extra = {k: v for k, v in got.items() if k >= 10_000}
    assert extra == {10_000: {"hyphenation"}, 10_002: {"chars"}, 10_003: {"header"}, 10_004: {"page_number"}, 10_005: {"hyphenation"}}
    plain = {k: v for k, v in got.items() if k < 10_000}
    assert set(plain) == {k for k in range(1, 1441) if k % 6 in (0, 1)}
    assert all(v == ({"header"} if k % 6 == 1 else {"page_number"}) for k, v in plain.items())


def test_paragraphs(blocks):
    got = {r.record_id: r.text for r in readable_paragraphs(blocks).collect()}
    assert got[10_000] == "The operator records the maintenance." and got[10_001] == "The carrier-grade procedure closes."
    assert got[10_003] == "The engineer records the procedure before it closes." and got[10_004] == "The planner records the procedure of the certificate."
    assert got[10_002].startswith("The operator records") and 1 not in got and 10_006 not in got


def test_empty_table(blocks):
    assert scan_defects(blocks.limit(0)).count() == 0


def test_shapes():
    reader = Reader({})
    assert all(number_shape(t, reader) for t in ("Page 2 of 3", "- 4 -", "[ 7 ]", "xiv", "12/14", "p. 3", "Sheet 9", "— 2 —"))
    assert not any(number_shape(t, reader) for t in ("of units", "802.3ad", "35. If", "12 units"))
    assert segments("a    b\n\n| x     | y |") == [(0, "a"), (0, "b"), (2, "| x     | y |")]


def test_recurrence_counts_lines_of_all_blocks(spark):
    """A header merged into long or inner blocks recurs as well as one that stands alone at a page's edge."""
    head = "Trunk handbook, revision 7"
    rng, rows = random.Random(4), []
    for page in range(1, 5):
        long = "\n".join(sentence(rng) for _ in range(4))
        rows += [
            (page * 10, "doc-long", page * 10, page, None, f"{head}\n{long}", None, None, None),  # the first block of its page, over 160 characters
            (page * 10 + 1, "doc-long", page * 10 + 1, page, None, "Body.", None, None, None),
            (page * 10 + 2, "doc-inner", page * 10 + 1, page, None, f"{long}\n{head}\n{long}", None, None, None),
            (page * 10 + 3, "doc-inner", page * 10, page, None, f"First {'abcd'[page - 1]}.", None, None, None),
            (page * 10 + 4, "doc-inner", page * 10 + 2, page, None, f"Last {'abcd'[page - 1]}.", None, None, None),
        ]
    rows += [(90, "doc-mixed", 1, 1, None, head, None, None, None), (91, "doc-mixed", 2, 2, None, head, None, None, None), (92, "doc-mixed", 4, 3, None, f"{sentence(rng)}\n{head}\n{sentence(rng)}", None, None, None)]
    rows += [(93, "doc-mixed", 3, 3, None, "First.", None, None, None), (94, "doc-mixed", 5, 3, None, "Last.", None, None, None), (95, "doc-once", 1, 1, None, head, None, None, None)]
    marks = {r.record_id: {m.line: m.outer for m in r.recurring or ()} for r in placed(spark.createDataFrame(rows, "record_id bigint, document_id string, ord int, page int, kind string, text string, x string, y string, z string"), Shelf(spark)).collect()}
    line = line_hash(head)
    assert all(marks[page * 10].get(line) is True and marks[page * 10 + 2].get(line) is False for page in range(1, 5))
    assert marks[90] == marks[91] == {line: True} and marks[92] == {line: True}
    assert marks[93] == marks[94] == marks[95] == {}
