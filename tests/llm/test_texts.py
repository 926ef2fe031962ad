import base64
import random

import pytest
import tiktoken

from specweave.llm.leakage import MASKS, TOLERANT_MASKS, SeedIndex, hashed, leaks, longest_run, longest_tolerant, words
from specweave.llm.lookalikes import lookalike_classes, lookalike_pairs, visual_forms
from specweave.llm.names import mapped, normal_name, spelled_like
from specweave.llm.splitting import BLOCK, cut, split
from specweave.llm.tokens import PIECES, TOKENIZERS, VOCABULARY, GrowingText, PrefixEncoder, encoded
from specweave.llm.visual import base_form, latin_form

DOCS = "doc_id bigint, text string, key string, raw string, base string, item_id int, ids string"


def documents(spark, *texts):
    return spark.createDataFrame([(i, t, "k", "r", "b", 9, "i") for i, t in enumerate(texts)], DOCS)


# -- pieces


def test_pieces_make_up_the_text(spark):
    rng = random.Random(3)
    texts = ["".join(rng.choice(["word ", "long" * 9, ". ", "\n", "\n\n", "é", "𝓐", "日本"]) for _ in range(rng.randint(1, 600))) for _ in range(20)] + ["x" * 5000, "", None, "short", " " * 900, "\n" * 777]
    rows = spark.createDataFrame([("block", i % 20, t, "clash") for i, t in enumerate(texts)], "item_kind string, record_id bigint, text string, chunk_id string")
    got = split(rows.withColumn("record_id", rows.record_id + 0), 300, 40).collect()
    by = {}
    for i, t in enumerate(texts):
        by.setdefault(i % 20, []).append(t)
    assert {r.record_id for r in got} == {k for k, ts in by.items() if any(t and len(t) > 300 for t in ts)}
    one = split(rows.filter("record_id = 0").limit(1), 300, 40).orderBy("seq").collect()
    assert all(len(r.text) <= 300 for r in got)
    whole, end = "", 0
    for r in one:
        assert r.start in (max(0, end - 40), 0)
        whole += r.text[end - r.start :]
        end = r.start + len(r.text)
    assert whole == texts[0]
    assert len({r.chunk_id for r in one}) == len(one)


def test_boundaries_are_preferred(spark):
    text = "a b c. " * 20 + "\n\n" + "d e f. " * 60
    rows = spark.createDataFrame([("page", 1, text)], "item_kind string, record_id bigint, text string")
    first = split(rows, 250, 0).orderBy("seq").first().text
    assert first.endswith("\n\n")
    with pytest.raises(ValueError):
        split(rows, 10, 10)


def test_a_huge_text_in_blocks_of_pieces(spark):
    text = "".join(f"word{i} " for i in range(9000))
    rows = spark.createDataFrame([("page", 1, text), ("page", 2, "x" * 120)], "item_kind string, record_id bigint, text string")
    got = split(rows, 120, 70).orderBy("seq").collect()  # the overlap is longer than the shortest piece
    assert len(got) > 3 * BLOCK and all(len(r.text) <= 120 and text[r.start : r.start + len(r.text)] == r.text for r in got)
    ends = [0] + [r.start + len(r.text) for r in got]
    assert all(r.start == max(0, end - 70) for r, end in zip(got, ends)) and ends[-1] == len(text)
    assert [r.record_id for r in cut(rows, 120, 70).collect()] == [1] and cut(rows, 119, 70).count() == 2


# -- tokens


@pytest.fixture(scope="module")
def encoder():
    return PrefixEncoder(f"{TOKENIZERS}/{VOCABULARY}")


@pytest.fixture(scope="module")
def plain():
    with open(f"{TOKENIZERS}/{VOCABULARY}", "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=PIECES, mergeable_ranks=ranks, special_tokens={})


SAMPLES = ["Hello world", "", " ", "\n\n  x", "naïve café 日本語 👩‍🔧", "<|endoftext|> is text", "a" * 700, "don't we'll", "12345678901234567890", "​﻿", "SHALL carry 602 entrie5 †", "The quick brown fox " * 300, "zzzzqqqqxxxx" * 30]


def test_tokens_equal_merging(spark, encoder, plain):
    for t in SAMPLES:
        assert encoder.encode(t) == plain.encode_ordinary(t)
    got = {r.doc_id: r.ids for r in encoded(documents(spark, *SAMPLES, None)).collect()}
    assert got == {i: plain.encode_ordinary(t or "") for i, t in enumerate([*SAMPLES, None])}
    assert encoded(documents(spark).limit(0)).count() == 0


def test_appends_and_edits(encoder, plain):
    rng = random.Random(7)
    text = GrowingText(encoder, "start")
    for _ in range(120):
        if rng.random() < 0.7:
            text.append(rng.choice([" word", "ing", "  ", "\n", "7", "é", "'s", "!!", " The"]))
        else:
            text.replace_from(rng.randint(0, len(text.text)), rng.choice(["", " new end", "x"]))
        assert text.ids() == plain.encode_ordinary(text.text)
    for _ in range(200):
        start = rng.randint(0, len(text.text))
        text.replace(start, min(len(text.text), start + rng.randint(0, 6)), rng.choice(["", " ", "new", " it's", "\n\n", "9", "é "]))
        assert text.ids() == plain.encode_ordinary(text.text)
    long = GrowingText(encoder, "plain words of a text. " * 2000)
    assert long.replace(20_000, 20_005, "other") < 10 and long.ids() == plain.encode_ordinary(long.text)


# -- leaks


def test_leaks_against_brute_force(spark):
    rng = random.Random(11)
    vocabulary = [f"w{i}" for i in range(60)]
    items = [" ".join(rng.choice(vocabulary) for _ in range(rng.randint(5, 40))) for _ in range(30)]
    docs = []
    for _ in range(80):
        t = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        src = rng.choice(items).split()
        n = rng.randint(8, 20)
        t += [w.upper() + rng.choice([",", " -", ""]) for w in src[:n]]
        docs.append(" ".join(t))
    docs += [None, "", items[0].replace("w", "ｗ")]
    e = spark.createDataFrame([(i, t, 0) for i, t in enumerate(items)] + [(99, None, 0)], "item_id int, text string, doc_id int")
    want = set()
    for d, t in enumerate(docs):
        w = words(t or "")
        runs = {tuple(w[k : k + 12]) for k in range(len(w) - 11)}
        want |= {(d, i) for i, x in enumerate(items) for k in range(len(words(x)) - 11) if tuple(words(x)[k : k + 12]) in runs}
    assert len(want) > 20
    assert {(r.doc_id, r.item_id) for r in leaks(documents(spark, *docs), e).collect()} == want
    assert {(r.doc_id, r.item_id) for r in leaks(documents(spark, *docs), e, block_words=200).collect()} == want  # several blocks
    assert leaks(documents(spark).limit(0), e).count() == 0 and leaks(documents(spark, *docs), e.limit(0)).count() == 0


def test_replaced_words(spark):
    import numpy as np

    item = " ".join(f"v{i}" for i in range(30))
    doc = item.replace("v7 ", "other ").replace("v19 ", "else ")
    e = spark.createDataFrame([(5, item)], "item_id int, text string")
    assert [(r.overlap, r.replaced) for r in leaks(documents(spark, doc), e, tolerant=True).collect()] == [(30, 2)]
    assert leaks(documents(spark, doc), e).count() == 0  # eleven equal words in a row at most
    same = np.array([1, 1, 0, 1, 1, 1, 0, 0, 1], dtype=bool)
    assert longest_run(same) == 3 and longest_tolerant(same, 0.2) == (5, 1)[:2] or longest_tolerant(same, 0.2)[0] >= 5


def test_no_allowed_replacement_is_missed(spark):
    """Every choice of replaced words in overlaps of 12 to 29 words, and of up to two in windows of 20, gives a seed hit, so
    recall is 1 at every length; the one mask of equal runs would lose some."""
    from itertools import combinations

    from specweave.llm.leakage import _Hashes

    cache, missed = _Hashes(), {MASKS: 0, TOLERANT_MASKS: 0}
    cases = [(n, places) for n in range(12, 30) for k in range(n // 10 + 1) for places in combinations(range(1, n - 1), k)]
    cases += [(20, places) for k in range(3) for places in combinations(range(20), k)]
    texts = {n: " ".join(f"v{i}" for i in range(n)) for n in range(12, 30)}
    for masks in missed:
        indexes = {n: SeedIndex([1], [t], masks) for n, t in texts.items()}
        for n, places in cases:
            h = hashed(texts[n], cache).copy()
            h[list(places)] += 1
            missed[masks] += (0, 0) not in indexes[n].overlaps(h)
    assert missed[TOLERANT_MASKS] == 0 and missed[MASKS] > 0 and all("0" in m and len(m) <= 10 for m in TOLERANT_MASKS)

    cases = [(12, (4,)), (12, (9,)), (20, (7, 8)), (33, (8, 16, 25))]
    items = [" ".join(f"i{i}v{k}" for k in range(n)) for i, (n, _) in enumerate(cases)]
    docs = [" ".join("other" if k in places else w for k, w in enumerate(item.split())) for item, (_, places) in zip(items, cases)]
    e = spark.createDataFrame(list(enumerate(items)), "item_id int, text string")
    assert {(r.item_id, r.overlap, r.replaced) for r in leaks(documents(spark, *docs), e, tolerant=True).collect()} == {(i, n, len(p)) for i, (n, p) in enumerate(cases)}


# -- look-alikes


def test_visual_forms():
    assert base_form("ＡＢＣ　ﬁne​ é\r\n") == "ABC fine é\n"
    assert base_form("👩‍🔧") == "👩‍🔧" and base_form("a‍b") == "ab"
    assert latin_form("Ваnk") == "Bank" and base_form("10²") == "10²"


def test_pairs_and_classes(spark):
    texts = [
        "The Pylon carries a load", "The Рylоn carries a load", "The Pylon carries а load", "The Pylon carries a load", "the pylon carries a load", "The Pylon  carries a load", "", None, "​", " ", "Pylоn only", "Рylon only",
        "Оператор передаёт канал", "Oператоp передаёт канал", "Rated 10² cycles", "Rated 102 cycles", "x" * 50_000, "x" * 49_999 + "х",
        "caf\u00e9 Pylon", "cаf\u0435\u0301 Pylon", "сусӏеѕ Pylon", "cycles Pylon",
    ]
    got = {(r.doc_id_a, r.doc_id_b) for r in lookalike_pairs(documents(spark, *texts)).collect()}
    assert got == {(0, 1), (0, 2), (1, 2), (1, 3), (2, 3), (10, 11), (12, 13), (16, 17), (18, 19), (20, 21)}
    assert {(r.doc_id, r.class_id) for r in lookalike_classes(documents(spark, *texts)).collect() if r.class_id == 0} == {(0, 0), (1, 0), (2, 0), (3, 0)}
    repaired = {r.doc_id: r.text for r in visual_forms(documents(spark, *texts))[1].collect()}
    assert repaired[1] == texts[0] and repaired[13] == texts[12] and 20 not in repaired  # it mixes no scripts within a word
    assert lookalike_pairs(documents(spark).limit(0)).count() == 0


# -- names


def test_spelling():
    assert normal_name("The Pylon, Trunk.") == "the trunk pylon" or normal_name("Pylon, Trunk.") == "trunk pylon"
    assert normal_name("trunkPylon") == normal_name("TRUNK_PYLON") == normal_name(" (Trunk-Pylon) ") == normal_name("a Trunk Pylon object") == "trunk pylon"
    assert spelled_like("trnk pylon", "trunk pylon") == 1 and spelled_like("trunk museum", "trunk pylon") is None


def test_names_against_the_list(spark):
    known = spark.createDataFrame([(1, "Trunk Pylon", ["Trunk Mast", "TRPY"], 0), (2, "Metro Tray", None, 0), (3, "Standby Nexus", [], 0)], "known_id int, name string, aliases array<string>, record_id int")
    names = {"TPRY": 1, "TRQY": 1, "Trunk Pyoln": 1, "trunkMasts": 1, "(TRPY)": 1, "Тrunk Рylon": 1, "Tray, Metro": 2, "the Metro Trays": 2, "Standby Nexus [ref 12]": 3, "Stanbdy Nexs": 3, "Relay Bakery": 0, "Metro Museum": 0, "x" * 20_000: 0}
    rows = [(i, n, "clash") for i, n in enumerate([*names, None, " ", "TBD", "N/A", "Trunk Pyoln"])]
    got = {r.record_id: r.known_id for r in mapped(spark.createDataFrame(rows, "record_id bigint, entity_name string, normal string"), known).collect()}
    assert got == {**dict(enumerate(names.values())), len(names) + 4: 1}
    assert mapped(spark.createDataFrame([], "record_id bigint, entity_name string"), known).count() == 0
    assert {r.known_id for r in mapped(spark.createDataFrame([(1, "Trunk Pylon")], "record_id bigint, entity_name string"), known.limit(0)).collect()} == {0}
