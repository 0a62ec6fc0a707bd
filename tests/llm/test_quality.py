"""The quality classifier on repeats and on texts that it has not seen."""

import pytest
from samples import prose

from ledgerloom.llm.quality import classify_quality, log_losses, symbols

SCHEMA = "doc_id long, text string, lang string"


def doubled(text: str, seed: int) -> str:
    """The text with a few of its words written twice and, in one text of six, one three times."""
    words = text.split()
    for k in range(3):
        at = (seed * 31 + k * 47) % len(words)
        words[at] = " ".join([words[at]] * (3 if seed % 6 == k == 0 else 2))
    return " ".join(words)


def filled(text: str, share: float, run: int) -> str:
    """The text with runs of one word, which make up a share of its words."""
    words, out = text.split(), []
    period = max(1, round(run / share) - run)
    for i, word in enumerate(words):
        out += [word] * (run + 1 if i % period == 0 else 1)
    return " ".join(out)


def test_repeated_words_and_lines_are_rejected_by_kind(spark):
    good = [(i, doubled(prose(i, 150), i), "en") for i in range(300)]
    bad = {
        "one word": ["word " * 200, "The " * 80],
        "long runs": [filled(prose(900 + i, 60), 0.8, 30) for i in range(10)],
        "half": [filled(prose(920 + i, 100), 0.5, 20) for i in range(10)],
        "lines": ["same line here\n" * 80, prose(940, 10) + "\n" + f"{prose(941, 5)}\n" * 60],
    }
    rows = [(1000 + 100 * k + i, t, "en") for k, own in enumerate(bad.values()) for i, t in enumerate(own)]
    frame = spark.createDataFrame(good + rows, SCHEMA)
    labels = spark.createDataFrame([(i, 1) for i in range(300)], "doc_id long, quality int")
    kept = {r.doc_id for r in classify_quality(frame, labels).where("kept").collect()}
    wrong = {name: sum(1000 + 100 * k + i in kept for i in range(len(own))) for k, (name, own) in enumerate(bad.items())}
    assert wrong == dict.fromkeys(bad, 0)
    assert sum(i in kept for i in range(300)) >= 298


@pytest.mark.parametrize(("text", "read"), [
    ("", ""), ("a  b", "a  b"), ("\n\na", "\n\na"), ("the the cat", "the\x01 cat"), ("a a a b b", "a\x01\x03 b\x01"),
    ("x y\nx y\nz", "x y\x02\nz"), (" ".join("a" * 12), "a\x01\x03\x04\x05\x06\x07\x08\x0e\x0e\x0e\x0e"),
])
def test_symbols(text, read):
    assert symbols(text) == read


@pytest.mark.parametrize("words", [12, 300])
def test_thresholds_are_those_of_texts_left_out(spark, words):
    """Each trusted text judged by a model that is built without it."""
    frame = spark.createDataFrame([(i, doubled(prose(i % 4, words), i % 4), "en") for i in range(5)], SCHEMA)
    labels = spark.createDataFrame([(i, 1) for i in range(5)], "doc_id long, quality int")
    left_out = sorted(
        classify_quality(frame, labels.where(f"doc_id <> {i}")).where(f"doc_id = {i}").first().perplexity for i in range(5)
    )
    for quantile, want in ((0.998, left_out[-1]), (0.5, left_out[2]), (0.1, left_out[0])):
        got = classify_quality(frame, labels, quantile=quantile).first().threshold
        assert got == pytest.approx(want, rel=1e-9)


def test_one_trusted_text_sets_no_threshold(spark):
    frame = spark.createDataFrame([(1, prose(1, 50), "en"), (2, prose(2, 50), "en")], SCHEMA)
    rows = classify_quality(frame, spark.createDataFrame([(1, 1)], "doc_id long, quality int")).collect()
    assert all(r.kept and r.threshold is None for r in rows)


def test_good_texts_outside_the_model_are_kept(spark):
    """The demands before thresholds were taken from the model's own texts."""
    good = [(1000 + i, prose(i, 150), "en") for i in range(200)]
    few = [(2000 + i, prose(300 + i, 150), "fr") for i in range(60)]
    frame = spark.createDataFrame(good + few, SCHEMA)
    labels = spark.createDataFrame([(i, 1) for i in (*range(1000, 1200, 2), *range(2000, 2020))], "doc_id long, quality int")
    kept = {r.doc_id for r in classify_quality(frame, labels).where("kept").collect()}
    assert sum(i in kept for i, *_ in good) >= 190
    assert sum(i in kept for i, *_ in few) >= 54


def test_copies_and_passages_outside_the_model_are_kept(documents, spark):
    """What the pipeline's test demanded when its fixture had these twelve labels."""
    labels = spark.createDataFrame([(i, 1) for i in range(12)], "doc_id long, quality int")
    kept = {r.doc_id for r in classify_quality(documents, labels).where("kept").collect()}
    assert {*range(12), 20, 30, 31} <= kept


def test_the_plan_of_the_losses_holds_each_count_once(spark):
    """The driver holds every update of a plan as text, so one that repeats its parts is dear there."""
    frame = spark.createDataFrame([(0, lang, code, code % 4) for lang in ("en", "de") for code in range(500)], "block int, lang string, code long, n long")
    plan = log_losses(frame, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate [") <= 3
