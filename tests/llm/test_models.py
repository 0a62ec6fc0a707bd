"""Links of vectors, text extraction, and the trained models."""

import numpy as np
import pytest
from samples import prose

from ledgerloom.llm.common import components
from ledgerloom.llm.html_text import extract_text, main_text, trained
from ledgerloom.llm.quality import USUAL, classify_quality, codes, symbols
from ledgerloom.llm.toxicity import label_model, score_toxicity
from ledgerloom.llm.vector_links import CoverTree, close_pairs, link_vectors, unit_vector



def test_components_of_a_path_and_a_star(frame):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)] + [(7, 7)]
    got = dict(map(tuple, components(frame("a long, b long", *edges)).collect()))
    assert got == {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 130)}}
    assert components(frame("a long, b long")).count() == 0


def clustered(seed, n, spread):
    random = np.random.default_rng(seed)
    centres = random.normal(size=(12, 16))
    return centres[random.integers(0, 12, n)] + spread * random.normal(size=(n, 16))


@pytest.mark.parametrize("spread", [0.05, 0.3, 2.0])
def test_dual_traversal_finds_each_pair(spread):
    points = np.stack([unit_vector(v) for v in clustered(1, 400, spread)])
    limit = float(np.sqrt(2 - 2 * 0.93))
    for one, two in ((points, points), (points[:150], points[150:])):
        trees = CoverTree(one, leaf=4), CoverTree(two, leaf=4)
        found = {(int(a), int(b)) for i, j in close_pairs(*trees, limit) for a, b in zip(i, j, strict=True)}
        want = set(zip(*map(np.ndarray.tolist, np.nonzero(one @ two.T >= 0.93)), strict=True))
        assert want <= found and all(one[a] @ two[b] >= 0.93 - 1e-6 for a, b in found)


def test_link_vectors(spark):
    rows = [(i, v.tolist(), i % 3, "x") for i, v in enumerate(clustered(2, 300, 0.2))]
    rows += [(400 + i, rows[0][1], 0, "copy") for i in range(5)]
    rows += [(500, None, 0, ""), (501, [0.0] * 16, 0, ""), (502, [float("nan")] * 16, 0, ""), (503, rows[0][1], None, ""),
             (504, [None, 1.0], 0, ""), (505, [], 0, ""), (506, [1e300] * 16, 1, ""), (507, [1e-300] * 16, 1, ""), (None, rows[0][1], 0, "")]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, size string")
    valid = {r[0]: (unit_vector(r[1]), r[2]) for r in rows if r[0] is not None and r[2] is not None and r[1] and None not in r[1]}
    valid = {i: v for i, v in valid.items() if v[0] is not None}
    links = {i: [j for j, w in valid.items() if j != i and w[1] == v[1] and v[0] @ w[0] >= 0.93] for i, v in valid.items()}
    top = {r[0]: r[0] for r in rows if r[0] is not None}
    for _ in range(20):
        top.update({i: min([top[i], *(top[j] for j in own)]) for i, own in links.items()})
    want = sorted((i, len(links.get(i, [])), t, t == i) for i, t in top.items())
    for cell in (8192, 20):
        assert sorted(map(tuple, link_vectors(frame, cell=cell, leaf=4).collect())) == want
    assert link_vectors(frame.limit(0)).count() == 0


PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1><p>All the news of the valley, every day of the year.</p></header>
<div class="cookie-banner"><p>We use cookies to improve your visit and to show you adverts.</p></div><main><article><header><h1>Title</h1></header>
<p>Para &lt;one&gt; with <a href=x>a link</a>,<br>and b<b>o</b>ld.</p><script>var t="</p>";</script><div class="ad"><p>Buy now and get another one for free.</p></div><p>End.
<section class="comments"><div class="comment"><p>I liked this article very much, thank you for writing it.</p></div></section></article>
<aside><ul><li><a>x</a></li></ul></aside></main><form><input><button>Send</button></form><footer>Foot</footer><!-- never closed"""


def test_extract_text(spark):
    rows = [(1, "u", PAGE, 0), (2, None, None, 0), (3, "u", "", 0), (4, "u", "no markup at all", 0), (5, "u", "<p", 0), (6, "u", "<article>a &amp;&nbsp;b", 0), (None, "u", PAGE, 0)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int")
    got = {r.page_id: r for r in extract_text(frame).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    assert got[1].text == "Title Para <one> with a link, and bold. End." and got[1].n_chars == len(got[1].text)
    assert got[2].text == got[3].text == "" and got[6].text == "a & b"
    assert extract_text(frame.limit(0)).count() == 0


def test_a_page_without_markup_for_its_parts():
    long = "The river rose through the night and by morning the lower fields had gone under water again, as in most springs."
    page = f"<div><a>Home</a></div><div><a>Sport</a> <a>Weather</a></div><div><p>{long}</p><p>{long}</p></div><div><a>Privacy</a></div>"
    assert main_text(page, trained()) == f"{long} {long}"


def quality_rows():
    good = [(1000 + i, prose(i, 150), "en") for i in range(200)]
    bad = [(100, prose(100, 60).upper(), "en"), (101, " ".join(f"{w}%%%" for w in prose(101, 60).split()), "en"), (102, "word " * 200, "en"),
           (103, "same line here\n" * 80, "en")]
    odd = [(110, None, "en"), (111, "", "en"), (112, prose(112, 40), None), (113, prose(113, 40), "xx"), (114, "a", "en"), (115, prose(115, 4000), "en"),
           (116, prose(116, 50), "en"), (116, prose(116, 50), "en"), (None, "x", "en")]
    return good + bad + odd


def test_quality(spark):
    frame = spark.createDataFrame([(*r, 1) for r in quality_rows()], "doc_id long, text string, lang string, code int").repartition(3)
    labels = spark.createDataFrame([(1000 + i, 1) for i in range(0, 200, 2)] + [(100, 0), (None, 1), (999, 1), (1003, None)], "doc_id long, quality int")
    rows = classify_quality(frame, labels, block_chars=30_000).collect()
    kept = {r.doc_id: r.kept for r in rows}
    assert len(rows) == len(quality_rows()) - 1
    assert not any(kept[i] for i in (100, 101, 102, 103)) and all(kept[i] for i in (110, 111, 112, 113, 115))
    assert sum(kept[1000 + i] for i in range(0, 200, 2)) >= 98  # trusted
    assert sum(kept[1000 + i] for i in range(1, 200, 2)) >= 80  # as good, but not in the model of 100 short texts
    assert all(classify_quality(frame, labels.limit(0)).select("kept").toPandas().kept)
    assert classify_quality(frame.limit(0), labels).count() == 0


def test_perplexity_equals_a_plain_model(spark):
    """Interpolated modified Kneser-Ney with dictionaries."""
    rows = [(i, prose(i, 25), "en") for i in range(8)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame([(i, 1) for i in range(5)], "doc_id long, quality int")
    got = {r.doc_id: r.perplexity for r in classify_quality(frame, labels).collect()}
    grams = lambda t: [(" " * 2 + symbols(t))[k : k + 3] for k in range(len(symbols(t)))]
    tables = {3: {}}
    for _, t, _ in rows[:5]:
        for g in grams(t):
            tables[3][g] = tables[3].get(g, 0) + 1
    for n in (2, 1):
        tables[n] = {}
        for g in tables[n + 1]:
            tables[n][g[1:]] = tables[n].get(g[1:], 0) + 1

    def chance(g, n):
        if n == 0:
            return 1 / (len(tables[1]) + 1)
        count = [sum(c == k for c in tables[n].values()) for k in (1, 2, 3, 4)]
        d = list(USUAL)
        if all(count):
            y = count[0] / (count[0] + 2 * count[1])
            raw = [k - (k + 1) * y * count[k] / count[k - 1] for k in (1, 2, 3)]
            d = [r if r > 0 else u for r, u in zip(raw, USUAL, strict=True)]
        below = {k: c for k, c in tables[n].items() if k[:-1] == g[-n:-1]}
        if not below:
            return chance(g, n - 1)
        cut = lambda c: min(c, d[min(c, 3) - 1])
        own = below.get(g[-n:], 0)
        return ((own - cut(own) if own else 0) + sum(map(cut, below.values())) * chance(g, n - 1)) / sum(below.values())

    for i, t, _ in rows:
        want = np.exp(-np.mean([np.log(chance(g, 3)) for g in grams(t)]))
        assert got[i] == pytest.approx(want, rel=1e-9)
    assert len(codes("", 3)) == 0


def test_label_model_finds_accurate_voters():
    random = np.random.default_rng(1)
    truth = random.random(2000) < 0.2
    votes = np.stack([np.where(random.random(2000) < a, truth, random.random(2000) < 0.2) for a in (0.9, 0.8, 0.8, 0.7, 0.0)], 1).astype(float)
    post, accuracy, correlation = label_model(votes, np.where(votes[:, :3].sum(axis=1) > 1, 0.8, 0.1), 0.2)
    assert ((post > 0.5) == truth).mean() > 0.93 and accuracy[0] > accuracy[4]
    assert correlation.shape == (5, 5)


def test_toxicity(spark):
    docs = [(i, prose(i, 50), "x") for i in range(600)]
    docs = [(i, t + (" you stupid moron grumblak" if i % 6 == 0 else ""), x) for i, t, x in docs]
    docs += [(700, None, ""), (701, "", ""), (702, "idiot", ""), (703, prose(703, 5000), ""), (704, prose(5, 30), ""), (704, prose(5, 30), ""), (None, "t", "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, score string")
    labels = spark.createDataFrame([(i, int(i % 6 == 0)) for i in range(600)] + [(None, 1), (800, 1), (5, None)], "doc_id long, toxic int")
    rows = score_toxicity(frame, labels).collect()
    got = {r.doc_id: r for r in rows}
    assert len(rows) == len(docs) - 1 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id < 600]
    assert len(held) > 100 and all(r.predicted == (r.doc_id % 6 == 0) for r in held)
    assert not any(got[i].predicted for i in (700, 701, 703, 704))
    plain = {r.doc_id: r.predicted for r in score_toxicity(frame, labels.limit(0)).collect()}
    assert plain[6] == 1 and plain[1] == 0 and plain[701] == 0
    assert score_toxicity(frame.limit(0), labels).count() == 0
