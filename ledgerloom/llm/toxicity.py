"""Toxicity by weak supervision: voters, a label model, a linear classifier."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored, texts_of

SCORED = "doc_id long, held_out boolean, score double, predicted int"
EDGE = re.compile(r"^[\W\d_]+|[\W\d_]+$")
PREFIXES = (4, 5, 6, 7, 8)
LEVELS = (3.0, 5.0, 7.0, 10.0, 14.0)  # of summed evidence, one voter each

# Hand-written voters. Words of a lexicon are compared whole, in lower case.
LEXICONS = {
    "insult": "idiot idiots moron morons imbecile fool dumb stupid stupidity loser losers clown pathetic worthless brainless dimwit halfwit",
    "contempt": "scum trash garbage filth vermin disgusting disgrace worthless pathetic revolting repulsive parasite lowlife",
    "threat": "kill murder destroy hurt strangle shoot stab die",
    "profanity": "damn crap bastard bitch ass asshole shit bullshit fuck fucking",
}
PATTERNS = {
    "second_person": r"\b(?:you|they|he|she)(?:'re| are| is)? (?:a |an |such an? |so |all )?(?:\w+ )?(?:idiots?|morons?|stupid|losers?|clowns?|pathetic|worthless|scum|trash|disgusting)\b",
    "dismissal": r"\b(?:shut up|get lost|go to hell|drop dead|nobody likes)\b",
    "masked": r"\b(?:1d10t|id[i1]0t|m0r[o0]n|st[u\*]p[i1]d|l[o0]s[e3]r|f[\*u]+ck|sh[\*i1]t)\b",
}


@dataclass
class Voters:
    """Terms (whole words and beginnings of words), the evidence and the voters of each, and
    patterns. The last voters fire by the summed evidence of the terms that a text holds."""

    words: dict[str, int]
    starts: dict[str, int]
    evidence: np.ndarray
    moves: list[tuple[int, ...]]
    patterns: list[tuple[re.Pattern, int]]
    size: int

    def of(self, token: str) -> tuple[int, ...]:
        """The terms that a token holds."""
        word = EDGE.sub("", token.lower())
        found = {self.words.get(word), *(self.starts.get(word[:n]) for n in PREFIXES if len(word) >= n)}
        return tuple(sorted(found - {None}))


class Hits:
    """How often each voter is moved by a text, the summed evidence and the number of words;
    remembers tokens up to a bound of memory."""

    def __init__(self, voters: Voters, kept: int = 400_000):
        self.voters, self.kept, self.known = voters, kept, {}

    def __call__(self, text: str) -> tuple[np.ndarray, float, int]:
        voters, known, tokens = self.voters, self.known, text.split()
        if len(known) > self.kept:
            known.clear()
        for token in set(tokens):
            if token not in known:
                known[token] = voters.of(token)
        out = np.zeros(voters.size)
        terms: set[int] = set()
        for found in filter(None, map(known.__getitem__, tokens)):
            terms.update(found)
            for term in found:
                for j in voters.moves[term]:
                    out[j] += 1
        low = text.lower() if voters.patterns else ""
        for pattern, j in voters.patterns:
            out[j] = len(pattern.findall(low))
        total = float(voters.evidence[list(terms)].sum()) if terms else 0.0
        out[-len(LEVELS) :] = [total >= level for level in LEVELS]
        return out, total, len(tokens)


def _terms(text: str) -> set[str]:
    """The words of a text, and their beginnings marked with a trailing *."""
    words = {EDGE.sub("", t) for t in set(text.lower().split())}
    return words | {f"{w[:n]}*" for w in words for n in PREFIXES if len(w) >= n}


def _count_terms(wanted: set[str] | None):
    """Documents of a task per term; all terms, or those wanted."""

    def run(frames):
        counts: dict[str, int] = {}
        for frame in frames:
            for text in frame.text:
                own = _terms(text)
                for term in own if wanted is None else own & wanted:
                    counts[term] = counts.get(term, 0) + 1
        yield pd.DataFrame({"term": list(counts), "n": list(counts.values())}).astype({"term": object, "n": np.int64})

    return run


def _document_counts(texts: DataFrame, wanted: set[str] | None, least: int, most: int) -> dict[str, int]:
    found = (
        texts.mapInPandas(_count_terms(wanted), "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least).orderBy(F.desc("n"), "term").limit(most)
    )
    return {r["term"]: r["n"] for r in found.collect()}


def choose_terms(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int, ratio: float = 6.0) -> dict[str, float]:
    """Terms that toxic documents hold far oftener than clean ones, most frequent first, with
    the logarithm of how much oftener, both counts taken at the doubtful end of their error.
    A term that adds nothing to its own beginning is left
    out."""
    chosen: dict[str, float] = {}
    for term, n in sorted(toxic.items(), key=lambda x: (-x[1], len(x[0]), x[0])):
        other = clean.get(term, 0) + 1
        weight = math.log((n - math.sqrt(n) + 0.01) / n_toxic) - math.log((other + 2 * math.sqrt(other)) / n_clean)
        if weight < math.log(ratio):
            continue
        bare = term.rstrip("*")
        own = [chosen[f"{bare[:k]}*"] for k in PREFIXES if k <= len(bare) and f"{bare[:k]}*" in chosen]
        if weight > max(own, default=0.0) + 0.5:
            chosen[term] = weight
    return chosen


def make_voters(terms: dict[str, float], own_voters: int = 48, shared: int = 8) -> Voters:
    """The hand-written voters, one voter for each of the first chosen terms, `shared` voters
    that divide the others between them, and the levels of evidence."""
    words: dict[str, int] = {}
    starts: dict[str, int] = {}
    evidence: list[float] = []
    moves: list[tuple[int, ...]] = []

    def place(term: str, weight: float, voter: int) -> None:
        table, key = (starts, term[:-1]) if term.endswith("*") else (words, term)
        if key not in table:
            table[key] = len(evidence)
            evidence.append(0.0)
            moves.append(())
        evidence[table[key]] = max(weight, evidence[table[key]])
        moves[table[key]] = (*moves[table[key]], voter)

    size = 0
    for lexicon in LEXICONS.values():
        for word in lexicon.split():
            place(word, 1.0, size)
        size += 1
    for i, (term, weight) in enumerate(terms.items()):
        place(term, weight, size + (i if i < own_voters else own_voters + i % shared))
    size += own_voters + shared
    patterns = [(re.compile(p), size + i) for i, p in enumerate(PATTERNS.values())]
    return Voters(words, starts, np.array(evidence), moves, patterns, size + len(patterns) + len(LEVELS))


def label_model(votes: np.ndarray, start: np.ndarray, prior: float, rounds: int = 12) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(posterior of each row, accuracy of each voter, correlations) of a two-class model.

    Each voter fires with a probability that depends on the hidden label. What two voters
    still have in common given the label is their correlation; a voter's evidence is divided
    by one plus the sum of its positive correlations, so copies of one voter do not count
    twice. Fitted by expectation and maximisation from the `start` posterior.
    """
    post = start.astype(float)
    weight = np.ones(votes.shape[1])
    correlation = np.eye(votes.shape[1])
    for step in range(rounds):
        n1, n0 = post.sum() + 1e-9, (1 - post).sum() + 1e-9
        on1 = (post @ votes + 0.1) / (n1 + 1)
        on0 = ((1 - post) @ votes + 0.1) / (n0 + 10)
        if step % 4 == 3:
            rest = votes - (np.outer(post, on1) + np.outer(1 - post, on0))
            spread = rest.std(axis=0) + 1e-6
            correlation = (rest.T @ rest) / len(votes) / np.outer(spread, spread)
            weight = 1 / (1 + np.clip(correlation - np.eye(len(spread)), 0, None).sum(axis=1))
        evidence = votes * (weight * np.log(on1 / on0)) + (1 - votes) * (weight * np.log((1 - on1) / (1 - on0)))
        logit = math.log(prior / (1 - prior)) + evidence.sum(axis=1)
        post = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    accuracy = post.mean() * on1 + (1 - post.mean()) * (1 - on0)
    return post, accuracy, correlation


def inputs(hits: np.ndarray, evidence: np.ndarray, words: np.ndarray) -> np.ndarray:
    """What the classifier sees: each voter's hits up to three, the evidence, and both against
    the length of the text."""
    total = hits[:, : -len(LEVELS)].sum(axis=1)
    return np.column_stack((
        np.minimum(hits, 3) / 3, np.minimum(evidence, 60) / 20, evidence / 20 / np.log(words + 20), np.log1p(total),
        np.minimum(1, total / np.maximum(words, 1)), np.log(words + 20) / 5, np.ones(len(hits)),
    ))


def fit_linear(x: np.ndarray, target: np.ndarray, penalty: float = 1.0, rounds: int = 15) -> np.ndarray:
    """Logistic regression on probabilities, by Newton steps."""
    w = np.zeros(x.shape[1])
    ridge = penalty * np.eye(len(w))
    ridge[-1, -1] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - target) + ridge @ w
        w -= np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, gradient)
    return w


def _matrix(hits: Hits, texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    found = [hits(t) for t in texts]
    return (
        np.array([h for h, _, _ in found]).reshape(-1, hits.voters.size), np.array([e for _, e, _ in found], float),
        np.array([n for _, _, n in found], float),
    )


def _votes(voters: Voters):
    def run(frames):
        hits = Hits(voters)
        for frame in frames:
            votes, evidence, words = _matrix(hits, frame.text)
            packed = [row.tobytes() for row in np.minimum(votes, 255).astype(np.uint8)]
            yield pd.DataFrame({"hits": packed, "evidence": evidence, "words": words, "toxic": frame.toxic})

    return run


def _score(voters: Voters, weights: np.ndarray, limit: float):
    def run(frames):
        hits = Hits(voters)
        for frame in frames:
            x = inputs(*_matrix(hits, frame.text))
            score = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            yield pd.DataFrame({"doc_id": frame.doc_id, "held_out": frame.held_out, "score": score, "predicted": (score >= limit).astype(np.int32)})

    return run


def train(votes: np.ndarray, evidence: np.ndarray, words: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """The classifier's weights. The known labels start the label model, softened, and are one
    more voter whose accuracy it estimates; the classifier is trained on its posterior."""
    start = np.where(toxic == 1, 0.9, 0.02)
    post, _, _ = label_model(np.column_stack((votes > 0, toxic == 1)).astype(float), start, float(toxic.mean()))
    return fit_linear(inputs(votes, evidence, words), post)


def held_out(doc_id: str = "doc_id"):
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(3)) == 1


def score_toxicity(
    documents: DataFrame, labels: DataFrame, train_rows: int = 20_000, terms: int = 20_000, limit: float = 0.7,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted (1 if score >= limit).

    Fitted on at most about `train_rows` labelled rows that are not held out, drawn by a hash:

    1. Terms (words and their beginnings) that toxic ones hold far oftener than clean ones, in
       three fourths of these rows, become voters beside hand-written lexicons and patterns; at
       most `terms` candidates come to the driver.
    2. On the other rows, a label model estimates the voters' accuracies and correlations.
    3. A linear classifier is trained on its posterior labels.

    Then every whole text is scored in a scan without a shuffle. Id, language and source are
    no inputs.

    Null or empty text: a score too, that of a text without hits. Null id: left out. Rows
    with a null label, and labels of unknown documents, do not count. Repeated rows: a row
    each. Without toxic or without clean labelled rows the hand-written voters alone decide.
    """
    docs = texts_of(documents, id_col, text_col)
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        F.col("doc_id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out()
    )
    every = max(1, math.ceil(usable.count() / train_rows))
    drawn = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(every)) == 0)
    # About train_rows rows of two numbers: bounded.
    part = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4))
    both = stored(docs.join(F.broadcast(drawn), "doc_id").groupBy(F.xxhash64("text").alias("copies"))
                  .agg(F.any_value("text").alias("text"), F.max("toxic").alias("toxic"), F.min(part).alias("part")), "labelled")
    sample, fitted = both.where("part < 3"), both.where("part = 3")
    sizes = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    voters, rows = make_voters({}), []
    if n_toxic and n_clean:
        toxic = _document_counts(sample.where("toxic = 1"), None, max(4, n_toxic // 100), terms)
        clean = _document_counts(sample.where("toxic = 0"), set(toxic), 1, terms)
        voters = make_voters(choose_terms(toxic, clean, n_toxic, n_clean))
        rows = fitted.mapInPandas(_votes(voters), "hits binary, evidence double, words double, toxic int").collect()
    if len({r["toxic"] for r in rows}) == 2:
        votes = np.frombuffer(b"".join(bytes(r["hits"]) for r in rows), np.uint8).reshape(len(rows), -1).astype(float)
        weights = train(votes, *(np.array([r[c] for r in rows], float) for c in ("evidence", "words", "toxic")))
    else:
        weights = np.concatenate((np.ones(voters.size), [0.0, 0.0, 1.0, 5.0, 0.0, -1.5]))
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInPandas(_score(voters, weights, limit), SCORED)
