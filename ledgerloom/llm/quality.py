"""Quality classifier: perplexity under a modified Kneser-Ney model of trusted text."""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

ROWS = "block int, lang string, code long, n long"
SCORED = "doc_id long, mark long, lang string, n_grams long, log_loss double, unseen_loss double"
BITS = 16
USUAL = (0.5, 1.0, 1.5)  # discounts where too few n-grams are rare to estimate them
AGAIN, AGAIN_LINE = "\x01\x03\x04\x05\x06\x07\x08\x0e", "\x02\x0f\x10\x11\x12\x13\x14\x15"


def _marked(parts: list[str], between: str, marks: str) -> str:
    """The parts joined, where a part that repeats the one before it becomes, with the space
    before it, the mark of how often it has been repeated by then."""
    out, before, times = [], None, 0
    for part in parts:
        times = times + 1 if part and part == before else 0
        out.append(marks[min(times, len(marks)) - 1] if times else part if before is None else between + part)
        before = part
    return "".join(out)


def symbols(text: str) -> str:
    """The text as the model reads it: a word or a line that repeats the one before it
    becomes a mark, its space included, so that nothing cheap stands between two repeats.

    Trusted text holds doubled words, seldom threefold ones. The first repeats have marks of
    their own, so that a doubled word costs what it does in trusted text and a long run costs
    the loss of an unseen mark for every further repeat.
    """
    return _marked(_marked(text.split("\n"), "\n", AGAIN_LINE).split(" "), " ", AGAIN)


def codes(text: str, order: int) -> np.ndarray:
    """The character n-grams as numbers of 16 bits per character, first character highest."""
    padded = " " * (order - 1) + symbols(text)
    points = np.frombuffer(padded.encode("utf-32-le", "replace"), np.uint32).astype(np.int64) & 0xFFFF
    size = len(points) - order + 1
    out = np.zeros(max(0, size), np.int64)
    for i in range(order):
        out = (out << BITS) | points[i : i + size]
    return out


def _distinct(texts, order: int, most: int = 2_000_000) -> tuple[np.ndarray, np.ndarray]:
    """The distinct n-grams of texts and their counts, about `most` characters at a time."""
    found, held, size = [], [np.zeros(0, np.int64)], 0
    for text in texts:
        held.append(codes(text, order))
        size += len(held[-1])
        if size > most:
            found.append(np.unique(np.concatenate(held), return_counts=True))
            held, size = [], 0
    found.append(np.unique(np.concatenate([np.zeros(0, np.int64), *held]), return_counts=True))
    distinct, place = np.unique(np.concatenate([f[0] for f in found]), return_inverse=True)
    return distinct, np.bincount(place, np.concatenate([f[1] for f in found]), len(distinct)).astype(np.int64)


def _count(order: int):
    """For a block: its distinct n-grams by language, with their count in trusted documents."""

    def run(key, frame):
        is_label = frame.text.isna()
        good = set(frame.doc_id[is_label & (frame.quality == 1)])
        docs = frame[~is_label]
        parts = []
        for lang, own in docs.groupby("lang"):
            trusted = own.doc_id.isin(good).to_numpy()
            seen, n = _distinct(own.text[trusted], order)
            more = np.setdiff1d(_distinct(own.text[~trusted], order)[0], seen)
            code = np.concatenate((seen, more))
            parts.append(pd.DataFrame({"block": int(key[0]), "lang": lang, "code": code, "n": np.concatenate((n, np.zeros(len(more), np.int64)))}))
        return pd.concat(parts) if parts else pd.DataFrame(columns=["block", "lang", "code", "n"])

    return run


def _discounts(met: np.ndarray) -> np.ndarray:
    """The discounts of counts 0, 1, 2 and from 3 on, where `met` n-grams were counted 1 to 4 times."""
    out = np.array([0.0, *USUAL])
    if met.min() > 0:
        y = met[0] / (met[0] + 2 * met[1])
        raw = np.arange(1, 4) - np.arange(2, 5) * y * met[1:] / met[:-1]
        out[1:] = np.where(raw > 0, raw, out[1:])
    return out


def unseen_loss(own: np.ndarray, known: np.ndarray, facts: np.ndarray, order: int) -> float | None:
    """The mean loss of a trusted document under the model of all other trusted text: every
    count, discount and vocabulary size is what it would be without the document.

    `own` are its n-grams; `facts` are those of the sorted n-grams `known`, by log_losses().
    None where no other trusted text is left.
    """
    gram, times = np.unique(own, return_counts=True)
    facts = facts[np.searchsorted(known, gram)]
    code, size, less = gram.view(np.uint64), int(facts[0, -1]), times
    levels = []
    for n in range(order, 0, -1):
        # The distinct n-grams of this order, a row of facts of each, and the place of each code in them.
        kind, row, key = np.unique(code & np.uint64((1 << BITS * n) - 1), return_index=True, return_inverse=True)
        count = facts[row, 5 * (n - 1)]
        if n < order:  # counts here are of the distinct characters before
            gone = levels[-1][4] == 0
            below = levels[-1][0][gone] & np.uint64((1 << BITS * n) - 1)
            less = np.bincount(np.searchsorted(kind, below), minlength=len(kind))
        left = count - less
        levels.append((kind, row, key, count, left))
    size -= int((levels[-1][4] == 0).sum())
    if size <= 1:
        return None
    p = np.full(len(gram), 1.0 / size)
    for n in range(1, order + 1):
        kind, row, key, count, left = levels[order - n]
        met = facts[0, 5 * order + 4 * (n - 1) : 5 * order + 4 * n].astype(float)
        was, now = (np.bincount(np.minimum(c, 5), minlength=6)[1:5] for c in (count, left))
        discount = _discounts(met - was + now)
        _, first, context = np.unique(kind >> np.uint64(BITS), return_index=True, return_inverse=True)
        stats = facts[row[first], 5 * (n - 1) + 1 : 5 * n].astype(float)
        total = stats[:, 0] - np.bincount(context, count - left, len(first))
        taken = np.zeros(len(first))
        for i in (1, 2, 3):
            fewer = (np.minimum(count, 3) == i).astype(int) - (np.minimum(left, 3) == i)
            taken += discount[i] * (stats[:, i] - np.bincount(context, fewer, len(first)))
        above = np.maximum(left - discount[np.minimum(left, 3)], 0.0)[key]
        total, taken = total[context][key], taken[context][key]
        p = np.where(total > 0, (above + taken * p) / np.maximum(total, 1.0), p)
    return float(-(np.log(p) * times).sum() / len(own))


def _score(order: int):
    """The mean negative log probability of each document of a block, and of trusted ones also
    the one that they would have unseen."""

    def run(key, frame, model):
        is_label = frame.text.isna()
        good = set(frame.doc_id[is_label & (frame.quality == 1)])
        tables = {}
        for lang, own in model.groupby("lang"):
            own = own.sort_values("code")
            met = own[own.n > 0]
            facts = np.stack(met.facts.to_list()) if len(met) else None
            tables[lang] = own.code.to_numpy(), own.loss.to_numpy(), met.code.to_numpy(), facts
        rows = []
        for doc, mark, lang, text in frame.loc[~is_label, ["doc_id", "mark", "lang", "text"]].itertuples(index=False):
            own = codes(text, order)
            mean = unseen = None
            if len(own):
                known, loss, met, facts = tables[lang]
                mean = float(loss[np.searchsorted(known, own)].mean())
                unseen = unseen_loss(own, met, facts, order) if doc in good else None
            rows.append((doc, mark, lang, len(own), mean, unseen))
        return pd.DataFrame(rows, columns=["doc_id", "mark", "lang", "n_grams", "log_loss", "unseen_loss"])

    return run


def _low(order: int) -> Column:
    return F.col("code").bitwiseAND(F.lit((1 << (BITS * order)) - 1))


def _languages(counts: dict[int, DataFrame], orders: range) -> DataFrame:
    """(lang, v, met1.., discounts1..), a row per language: its characters and one, and for each
    order how many n-grams are counted 1 to 4 times and the discounts of counts 1, 2 and more."""
    every = [counts[n].select("lang", F.lit(n).alias("n"), "c") for n in orders]
    of = lambda n, test: F.count_if((F.col("n") == n) & test)
    sums = reduce(DataFrame.union, every).groupBy("lang").agg(
        (of(1, F.lit(True)) + 1).alias("v"), *[F.array(*[of(n, F.col("c") == i) for i in (1, 2, 3, 4)]).alias(f"met{n}") for n in orders]
    )
    discounts = []
    for n in orders:
        met = [F.col(f"met{n}")[i].cast("double") for i in range(4)]
        y = F.try_divide(met[0], met[0] + 2 * met[1])
        raws = [i - (i + 1) * y * F.try_divide(met[i], met[i - 1]) for i in (1, 2, 3)]
        discounts.append(F.array(*[
            F.when((F.least(*met) > 0) & (raw > 0), raw).otherwise(usual) for raw, usual in zip(raws, USUAL, strict=True)
        ]).alias(f"discounts{n}"))
    return stored(sums.select("*", *discounts), "language-counts")


def log_losses(grams: DataFrame, order: int) -> DataFrame:
    """(lang, code, loss, facts): -log p of every n-gram in `grams` (block, lang, code, n), where n
    counts it in trusted text and may be 0.

    `facts` of an n-gram are, for each order from 1 on, its count, the sum of the counts of its
    context and how many of these are 1, 2 and more; then, for each order, how many counts of the
    language are 1 to 4; then the number of its characters and one.

    Interpolated modified Kneser-Ney: the highest order counts occurrences, lower orders
    count the distinct characters before; three discounts per order and language come from
    the numbers of n-grams seen once to four times, or are USUAL where one of them is none or
    the estimate is not positive, so that unseen n-grams keep a share. Every step is an aggregation or an
    equality join on (language, n-gram), sharded by that key.

    The counts of each order and the row of each language are stored when this is called: they are
    read several times, and one plan of all of it is large in the driver.
    """
    seen = stored(grams.groupBy("lang", "code").agg(F.sum("n").alias("c")), "counts")
    counts = {order: seen.where("c > 0")}
    for n in range(order - 1, 0, -1):
        counts[n] = stored(counts[n + 1].groupBy("lang", _low(n).alias("code")).agg(F.count("*").alias("c")), "counts")
    orders = range(1, order + 1)
    languages = _languages(counts, orders)
    out = seen.select("lang", "code").join(languages.select("lang", "v"), "lang", "left").withColumn("p", 1.0 / F.coalesce("v", F.lit(2)))
    for n in orders:
        taken = counts[n].join(languages.select("lang", F.col(f"discounts{n}").alias("d")), "lang").select(
            "lang", "code", "c", F.col("d")[F.least("c", F.lit(3)).cast("int") - 1].alias("discount")
        )
        contexts = taken.groupBy("lang", F.shiftrightunsigned("code", BITS).alias("before")).agg(
            F.sum("c").alias("total"), F.sum(F.least("discount", F.col("c").cast("double"))).alias("taken"),
            F.array(F.sum("c"), F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2), F.count_if(F.col("c") > 2)).alias(f"all{n}"),
        )
        gram = taken.select("lang", F.col("code").alias("key"), F.col("c").alias(f"c{n}"), F.greatest(F.col("c") - F.col("discount"), F.lit(0.0)).alias("left"))
        out = (
            out.withColumn("key", _low(n)).withColumn("before", F.shiftrightunsigned("key", BITS))
            .join(gram, ["lang", "key"], "left").join(contexts, ["lang", "before"], "left")
            .withColumn("p", F.when(F.col("total").isNull(), F.col("p")).otherwise(
                (F.coalesce("left", F.lit(0.0)) + F.col("taken") * F.col("p")) / F.col("total")))
            .drop("key", "before", "left", "total", "taken")
        )
    out = out.join(languages.select("lang", *[f"met{n}" for n in orders]), "lang", "left")
    facts = F.concat(*[x for n in orders for x in (F.array(f"c{n}"), F.col(f"all{n}"))], *[F.col(f"met{n}") for n in orders], F.array("v"))
    return out.select("lang", "code", (-F.log("p")).alias("loss"), facts.alias("facts"))


def classify_quality(
    documents: DataFrame, labels: DataFrame, order: int = 3, quantile: float = 0.998, block_chars: int = 24_000_000,
    id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """One row per document: doc_id, mark (a hash of the text), lang, n_grams, perplexity,
    threshold, kept.

    Trusted text is all documents labelled of good quality. Each language has its own model
    and its own threshold, the `quantile` of the perplexities that its trusted documents would
    have if the model had not seen them; what is above it is rejected.

    1. Documents and labels are dealt by id into blocks of about `block_chars` characters, once
       for counting and once for scoring. A block stores each distinct n-gram once.
    2. N-gram counts and probabilities are aggregated and joined by (language, n-gram), and
       come back to the blocks that hold the n-gram.
    3. A block scores its documents, trusted ones twice: as all others, and by counts without
       their own, which takes no second model. Languages' quantiles are mergeable sketches.

    Null or empty text: nothing to judge, kept, perplexity null. Null language: a language of
    its own. A language without two trusted texts has no threshold and keeps all. Null id: left
    out. Repeated rows: a row each. Of several labels of a document a good one counts. Labels
    of unknown documents do not count. No documents: no rows.
    """
    docs = documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("")).alias("lang"),
    ).where("doc_id IS NOT NULL")
    total = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = max(1, math.ceil(total / block_chars))
    block = F.pmod(F.xxhash64("doc_id"), F.lit(blocks)).cast("int")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality")).where(
        "doc_id IS NOT NULL AND quality = 1"
    )
    dealt = (
        docs.select(block.alias("block"), "doc_id", F.xxhash64("text").alias("mark"), "lang", "text", F.lit(None).cast("int").alias("quality"))
        .union(known.select(block.alias("block"), "doc_id", F.lit(0).cast("long"), F.lit(""), F.lit(None).cast("string"), "quality"))
        .repartition(blocks, "block")
    )
    grams = stored(dealt.groupBy("block").applyInPandas(_count(order), ROWS), "n-grams")
    own = grams.join(log_losses(grams, order), ["lang", "code"]).select(
        "block", "lang", "code", "n", "loss", F.when(F.col("n") > 0, F.col("facts")).alias("facts")
    )
    scored = stored(
        dealt.groupBy("block").cogroup(own.groupBy("block")).applyInPandas(_score(order), SCORED), "perplexities"
    )
    limits = scored.where("unseen_loss IS NOT NULL").groupBy("lang").agg(
        F.exp(F.percentile_approx("unseen_loss", quantile, 10_000)).alias("threshold")
    )
    return scored.join(limits, "lang", "left").select(
        "doc_id", "mark", "lang", "n_grams", F.exp("log_loss").alias("perplexity"), "threshold",
        F.coalesce(F.exp("log_loss") <= F.col("threshold"), F.lit(True)).alias("kept"),
    )
