import itertools
import math
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from specweave.functions import numbers, text
from specweave.operators.naming import NOT_PLURAL, QUERIES, WRAPS, alias_table, normalized
from specweave.operators.duplicates import token_set_ratio
from specweave.sources.lexicons import ALIASES
from specweave.sources.markdown import blocks_of_text


def one(spark, column, **values):
    return spark.createDataFrame([tuple(values.values())], ", ".join(f"{k} string" for k in values)).select(column.alias("x")).first().x


@pytest.mark.parametrize("name, camel, head", [("EVC ID", "evcId", "id"), ("CIR", "cir", "cir"), ("port Speed (max)", "portSpeedMax", "speed"), ("", "", ""), ("MAC-address", "macAddress", "address")])
def test_names(spark, name, camel, head):
    assert one(spark, text.camel_case(F.col("n")), n=name) == camel
    assert one(spark, text.head_noun(F.col("n")), n=name) == head


def test_sentences_and_spans(spark):
    t = "A UNI is here.  The port is there. UNIs follow! Nothing else"
    assert one(spark, text.sentences(F.col("t")), t=t) == ["A UNI is here.", "The port is there.", "UNIs follow!", "Nothing else"]
    assert one(spark, text.merged_span(F.col("t"), F.lit("uni")), t=t) == "A UNI is here.  The port is there. UNIs follow!"
    assert one(spark, text.merged_span(F.col("t"), F.lit("EVC")), t=t) is None
    assert one(spark, text.token_count(F.col("t")), t="") == 0
    assert one(spark, text.token_count(F.col("t")), t="one two three") == 4


def test_precise_sum_equals_exact_sum(spark):
    weights = [0.20, 0.25, 0.15, 0.15, 0.10, 0.05, 0.10]
    rows = list(itertools.product([0.0, 1.0], repeat=7))
    names = [f"c{i}" for i in range(7)]
    got = spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names)).select(*names, numbers.precise_sum([F.lit(w) * F.col(n) for w, n in zip(weights, names)]).alias("s")).collect()
    assert all(r.s == math.fsum(w * r[n] for w, n in zip(weights, names)) for r in got)


@pytest.mark.parametrize("name, normal", [("Service Types", "service type"), ("Policies", "policy"), ("CoS", "cos"), ("SIMS", "sims"), ("User-Network Interface", "uni"), ("(\"Access Points\")", "access point"), ("ＵＮＩ", "uni"), ("status", "status")])
def test_normal_names(spark, name, normal):
    row = normalized(spark.createDataFrame([(name, 1)], "entity_name string, steps int").drop("steps")).first()
    assert row.normalized_entity_name == normal
    assert (row.reasoning == "no change") == (row.normalized_entity_name == name)


def plainly_normal(name):
    """The steps of a normal name one by one in plain Python."""
    if name is None:
        return None
    s = re.sub(r"\s+", " ", unicodedata.normalize("NFKC", name).strip())
    while len(s) >= 2 and s[0] + s[-1] in WRAPS:
        s = s[1:-1].strip()
    s = re.sub(r"[.,;:!?]+$", "", s).strip()
    s = re.sub(r"\s+", " ", re.sub("[-‐-―/]+", " ", s)).strip()
    out = []
    for b, f in zip(s.split(" "), s.lower().split(" ")):
        if b.isupper() and len(b) > 1 or len(f) <= 3 or f in NOT_PLURAL or "'" in f:
            out.append(f)
        elif f.endswith("ies") and len(f) > 4:
            out.append(f[:-3] + "y")
        else:
            out.append(f[:-1] if f.endswith("s") and not f.endswith("ss") else f)
    single = " ".join(out)
    return alias_table(ALIASES).get(single, single)


def test_normal_names_of_all_scripts(spark, tmp_path):
    """The registered query keeps every row: null, non-ASCII, and wrapped more than four times."""
    names = [None, "", "Ｓｅｒｖｉｃｅ　Ｔｙｐｅｓ", "“Access Points”", "Café Orders", "Сервис Types", "User–Network Interface", "‘(Trunk—Lines)’", "ﬁber Links", "№ Policies", "\u00a0Port\u2003Speeds ", "１０ＧＥ Ports", "éTUDES", "Plain Names"]
    names += ["(" * n + "Unit Ports" + ")" * n for n in (1, 4, 5, 9, 40)] + ["[({<“‘\"Deep  Names\"’”>})]!", "((((((", "(((((())))))", "((((( a ) ) ) ) ) )"]
    spark.createDataFrame(list(enumerate(names)), "record_id bigint, entity_name string").write.parquet(f"{tmp_path}/entities.parquet")
    got = {r.record_id: r.normal for r in QUERIES["normalized_names"](spark, str(tmp_path)).collect()}
    assert got == {i: plainly_normal(n) for i, n in enumerate(names)}


def test_token_sets():
    assert token_set_ratio("Service Order", "Service Order Item") == 100.0
    assert token_set_ratio("", "x") == 0.0
    assert token_set_ratio(None, None) == 0.0
    assert 80 < token_set_ratio("Service Order", "Service Border") < 100


def test_markdown_blocks():
    got = blocks_of_text("# Title\n\nfirst\nsecond  line\n- item\n2. other\n| a | b |\n|---|---|\n| 1 | |\n#tag\ntail")
    assert [(k, t, n) for k, t, n, _ in got] == [("heading", "Title", 1), ("paragraph", "first second line", None), ("list_item", "item", None), ("list_item", "other", None), ("table", "| a | b |\n| 1 |  |", None), ("heading", "tag", 1), ("paragraph", "tail", None)]
    assert got[4][3]["rows"] == [["1", ""]]
    assert blocks_of_text(None) == blocks_of_text(" \n\n") == []
