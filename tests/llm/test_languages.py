"""Language identification against a plain model of dictionaries and by held-out accuracy."""

import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from samples import prose

from ledgerloom.llm.languages import START, UNIT, ContextTree, _lengths_of, grams, identify_languages

SCHEMA = "lang_pred string, doc_id long, text string, lang string, gram long, n int"
ONE, TWO = prose(1, 400), prose(2, 400).replace("a", "ö").replace("k", "x")


def model(texts):
    follow = defaultdict(Counter)
    for text in texts:
        data = bytes([START] * 3) + text.encode()
        for i in range(3, len(data)):
            for order in range(4):
                follow[data[i - order : i]][data[i]] += 1
    return follow


def code_length(follow, text):
    """In units, the escape chain with exclusion followed byte by byte."""
    data, out = bytes([START] * 3) + text.encode(), 0
    for i in range(3, len(data)):
        left_out, bits = set(), 0.0
        for order in (3, 2, 1, 0):
            counts = follow.get(data[i - order : i])
            if not counts:
                continue
            own = {b: n for b, n in counts.items() if b not in left_out}
            whole = sum(own.values()) + len(own)
            if data[i] in own:
                bits += math.log2(whole / own[data[i]])
                break
            if own:
                bits += math.log2(whole / len(own))
            left_out |= set(counts)
        else:
            bits += math.log2(256 - len(follow[b""]))
        out += round(bits * UNIT)
    return out


def tree(texts):
    codes, n = np.unique(grams([t.encode() for t in texts])[0], return_counts=True)
    first = np.bincount(codes & 255, weights=n, minlength=256).astype(np.int64)
    return ContextTree(codes, n, first)


def test_code_lengths_follow_the_escape_chain():
    learned = [ONE, "abra", "", "ünïcode 中文 🙂"]
    follow = model(learned)
    asked = ["", "a", "abra", ONE[:200], TWO[:300], "中🙂\x00", "zzzz üü" * 20]
    got = _lengths_of(asked, [tree(learned)], [np.ones(256, bool)])[:, 0].tolist()
    assert got == pytest.approx([code_length(follow, t) for t in asked], abs=300)


def test_probabilities_of_a_context_add_up_to_one():
    own = tree([ONE])
    for start in (b"aba", b"zzz", b"\xff\xff\xff", b" k\x00"):
        head = (start[0] << 24) | (start[1] << 16) | (start[2] << 8)
        lengths = own.lengths(np.arange(head, head + 256, dtype=np.uint32))
        assert abs(np.exp2(-lengths / UNIT).sum() - 1) < 1e-3


@pytest.fixture(scope="module")
def rows(spark):
    known = [("x", i, " ".join(t.split()[i * 9 : i * 9 + 60]), lang, 1, 2) for i in range(30) for t, lang in ((ONE, "aa"), (TWO, "bb"))]
    odd = [("x", 900, None, "aa", 1, 2), ("x", 901, "", "bb", 1, 2), ("x", 902, "12 !?", None, 1, 2), (None, None, "no id", "aa", 1, 2),
           ("x", 903, "İ", "aa", 1, 2), ("x", 904, ONE * 300, None, 1, 2), ("x", 905, TWO, "bb", 1, 2), ("x", 905, TWO, "bb", 1, 2)]
    return spark.createDataFrame(known + odd, SCHEMA).repartition(3)


def test_identify_languages(rows):
    asked = rows.where("doc_id >= 20")
    got = identify_languages(asked, rows.where("doc_id < 20 OR doc_id IS NULL OR doc_id = 900")).collect()
    assert sorted(r.doc_id for r in got) == sorted(r.doc_id for r in asked.collect())
    want = {(r.doc_id, r.lang_pred) for r in asked.where("doc_id < 900").selectExpr("doc_id", "lang AS lang_pred").collect()}
    assert {(r.doc_id, r.lang_pred) for r in got if r.doc_id < 900} == want
    by_id = {r.doc_id: (r.lang_pred, r.score) for r in got}
    assert by_id[900] == by_id[901] == by_id[902] == ("und", 0.0)
    assert by_id[904][0] == "aa" and by_id[905][0] == "bb" and by_id[903][0] in ("aa", "bb")
    assert all(0 <= r.score <= 1 for r in got)


def test_parts_give_the_same_result(rows):
    learned = rows.where("doc_id < 20")
    whole = sorted(map(tuple, identify_languages(rows, learned).collect()))
    assert sorted(map(tuple, identify_languages(rows, learned, part_grams=300).collect())) == whole


def test_nothing_learned_and_nothing_asked(rows):
    got = identify_languages(rows, rows.limit(0)).collect()
    assert len(got) == rows.where("doc_id IS NOT NULL").count()
    assert {(r.lang_pred, r.score) for r in got} == {("und", 0.0)}
    assert identify_languages(rows.limit(0), rows).count() == 0
