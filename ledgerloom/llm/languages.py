"""Language identification by prediction by partial matching (PPM).

A language's model is a tree of byte contexts of up to three bytes. A node knows how often each
byte followed it. The next byte is coded in the deepest context that the tree holds. Where it was
never seen there, the escape is coded and the next shorter context tried, without the bytes that
the longer one would have coded (exclusion); below the empty context all bytes left are equally
likely. Escapes have the share q / (total + q), q being the number of different bytes (method C).
The language whose frozen statistics give a text the shortest code is predicted.

Code lengths are whole multiples of 2^-20 bit, so sums do not depend on order, batches or reruns.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored

UNKNOWN = "und"
PREDICTED = "doc_id long, lang_pred string, score double"
LENGTHS = "doc_id long, mark string, part int, lengths array<long>"
ORDER = 3
# Stands before each text; no UTF-8 text holds this byte.
START = 0xFF
UNIT = 1 << 20
CHUNK = 4_000_000


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Each byte behind its three predecessors as one number, texts one after the other, and
    where each text starts."""
    pad = bytes([START]) * ORDER
    flat = np.frombuffer(b"".join([pad + t for t in texts]), np.uint8).astype(np.uint32)
    codes = (flat[:-3] << 24) | (flat[1:-2] << 16) | (flat[2:-1] << 8) | flat[3:]
    sizes = np.array([len(t) for t in texts], np.int64)
    return codes[flat[3:] != START] if len(codes) else codes, np.cumsum(sizes) - sizes


def chunks(texts: list, chunk: int = CHUNK) -> Iterator[slice]:
    """Runs of texts of about `chunk` characters together."""
    at = size = 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= chunk or i + 1 == len(texts):
            yield slice(at, i + 1)
            at, size = i + 1, 0


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, back = np.unique(np.concatenate(keys), return_inverse=True)
    out = np.zeros(len(key), np.int64)
    np.add.at(out, back, np.concatenate(counts))
    return key, out


def _count(most: int = 2_000_000):
    def run(frames):
        held: dict[str, tuple[list, list]] = {}
        rows = 0

        def summed():
            for lang, (keys, counts) in held.items():
                key, n = _summed(keys, counts)
                yield lang, key, n

        def out():
            for lang, key, n in summed():
                yield pd.DataFrame({"lang": lang, "gram": key.astype(np.int64), "n": n})

        for frame in frames:
            for lang, own in frame.groupby("lang", sort=False):
                texts = own.text.tolist()
                for part in chunks(texts):
                    key, n = np.unique(grams([t.encode("utf-8", "replace") for t in texts[part]])[0], return_counts=True)
                    keys, counts = held.setdefault(lang, ([], []))
                    keys.append(key)
                    counts.append(n)
                    rows += len(key)
            if rows > most:
                held = {lang: ([key], [n]) for lang, key, n in summed()}
                rows = sum(len(keys[0]) for keys, _ in held.values())
                if rows > most // 2:
                    yield from out()
                    held, rows = {}, 0
        yield from out()

    return run


def count_grams(documents: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n) of all texts. Tasks add up before the shuffle, so no key is hot."""
    known = documents.select(
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"),
    ).where("lang IS NOT NULL")
    counted = known.mapInPandas(_count(), "lang string, gram long, n long")
    return counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def _found(sorted_keys: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, whether it is there) of keys."""
    if not len(sorted_keys):
        return np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(sorted_keys, keys), len(sorted_keys) - 1)
    return at, sorted_keys[at] == keys


class ContextTree:
    """Frozen statistics of one language, or of those of its contexts that end in some bytes.

    `key` and `n` are grams of four bytes and their counts; shorter contexts are added up from
    them. `first` has the counts of single bytes over the whole language.
    """

    def __init__(self, key: np.ndarray, n: np.ndarray, first: np.ndarray):
        self.first = first
        self.key, self.n, self.context, self.total, self.kinds, self.shared = [], [], [], [], [], []
        key = key.astype(np.uint64)
        levels = [(np.arange(256, dtype=np.uint64)[first > 0], first[first > 0])]
        for order in range(1, ORDER + 1):
            levels.append(_summed([key & np.uint64((1 << 8 * (order + 1)) - 1)], [n]))
        for order, (grams_, counts) in enumerate(levels):
            # Grams are sorted, so those of one context stand together.
            owner = grams_ >> np.uint64(8)
            context, start = np.unique(owner, return_index=True)
            self.key.append(grams_)
            self.n.append(counts)
            self.context.append(context)
            self.total.append(np.add.reduceat(counts, start) if len(start) else counts)
            self.kinds.append(np.diff(np.append(start, len(grams_))))
            if order:
                # What the next shorter context counts for the bytes that this one holds.
                lower = grams_ & np.uint64((1 << 8 * order) - 1)
                at, _ = _found(self.key[order - 1], lower)
                self.shared.append(np.add.reduceat(self.n[order - 1][at], start) if len(start) else counts)
            else:
                self.shared.append(np.zeros(len(context), np.int64))

    def lengths(self, codes: np.ndarray) -> np.ndarray:
        """Code length of each gram's last byte behind the three before it, in units."""
        codes = codes.astype(np.uint64)
        bits = np.zeros(len(codes))
        open_ = np.ones(len(codes), bool)
        less_total, less_kinds = np.zeros(len(codes), np.int64), np.zeros(len(codes), np.int64)
        for order in range(ORDER, -1, -1):
            own = codes & np.uint64((1 << 8 * (order + 1)) - 1)
            place, there = _found(self.context[order], own >> np.uint64(8))
            if not len(self.context[order]):
                continue
            total = np.where(there, self.total[order][place] - less_total, 0)
            kinds = np.where(there, self.kinds[order][place] - less_kinds, 0)
            at, seen = _found(self.key[order], own)
            seen = seen & open_ & there
            escape = open_ & there & ~seen & (total > 0)
            bits[seen] += np.log2((total[seen] + kinds[seen]) / self.n[order][at[seen]])
            bits[escape] += np.log2((total[escape] + kinds[escape]) / kinds[escape])
            open_ &= ~seen
            less_total = np.where(there, self.shared[order][place], 0)
            less_kinds = np.where(there, self.kinds[order][place], 0)
        # Below the empty context: all bytes that it does not hold.
        bits[open_] += np.log2(256 - np.count_nonzero(self.first))
        return np.rint(bits * UNIT).astype(np.int64)


def _lengths_of(texts: list[str], trees: list[ContextTree], ends: list[np.ndarray]) -> np.ndarray:
    """Code lengths of texts (rows) in languages (columns). A tree sees only the bytes whose
    predecessor is among its `ends`."""
    raw = [t.encode("utf-8", "replace") for t in texts]
    codes, starts = grams(raw)
    place, distinct = pd.factorize(codes)
    order = np.argsort(distinct)
    out = np.zeros((len(texts), len(trees)), np.int64)
    full = np.array([len(t) > 0 for t in raw])
    for j, (tree, end) in enumerate(zip(trees, ends, strict=True)):
        own = order[end[(distinct[order] >> np.uint32(8)) & np.uint32(0xFF)]]
        lengths = np.zeros(len(distinct), np.int64)
        lengths[own] = tree.lengths(distinct[own])
        if full.any():
            out[full, j] = np.add.reduceat(lengths[place], starts[full])
    return out


def _verdicts(langs: list[str], lengths: np.ndarray, texts: list[str | None]) -> tuple[list, list]:
    """(predicted, share of the best code among all) per text; equal lengths go to the first name."""
    if not langs:
        return [UNKNOWN] * len(texts), [0.0] * len(texts)
    best = lengths.argmin(axis=1)
    gap = (lengths - lengths[np.arange(len(lengths)), best][:, None]) / UNIT
    share = 1 / np.exp2(-gap).sum(axis=1)
    lettered = [t is not None and any(map(str.isalpha, t)) for t in texts]
    return (
        [langs[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)],
        np.where(lettered, share, 0.0).tolist(),
    )


def _parts(counts: DataFrame, part_grams: int) -> list[dict[str, list[int]]]:
    """Contexts dealt by language and last byte into parts of at most `part_grams` grams, as far
    as one last byte allows (2^24 at most): {language: last bytes}."""
    sizes = counts.groupBy("lang", ((F.col("gram") / 256).cast("long") % 256).cast("int").alias("end")).count()
    parts: list[dict[str, list[int]]] = []
    room = 0
    for row in sorted(sizes.collect()):
        if not parts or row["count"] > room:
            parts.append({})
            room = part_grams
        parts[-1].setdefault(row["lang"], []).append(row["end"])
        room -= row["count"]
    return parts


def _trees(counts: DataFrame, part: dict[str, list[int]], first: dict[str, np.ndarray]):
    """[(language, tree, last bytes)] of a part."""
    out = []
    wanted = counts.where(F.col("lang").isin(list(part)))
    end = (F.col("gram") / 256).cast("long") % 256
    for lang, ends in sorted(part.items()):
        own = wanted.where((F.col("lang") == lang) & end.isin(ends)).select("gram", "n").toPandas().sort_values("gram")
        mask = np.zeros(256, bool)
        mask[ends] = True
        out.append((lang, ContextTree(own.gram.to_numpy(np.uint64), own.n.to_numpy(np.int64), first[lang]), mask))
    return out


def identify_languages(
    documents: DataFrame, learned_from: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    lang_col: str = "lang", part_grams: int = 4_000_000,
) -> DataFrame:
    """One row per row of `documents`: doc_id, lang_pred, score.

    Learns from `lang_col` and the whole texts of all rows of `learned_from` whose language is not
    null; only ids and texts of `documents` are read. `score` is the share of the predicted
    language's likelihood among all languages', each as likely beforehand.

    The counts are added up in tasks, then by Spark, and stored. They go to the tasks in parts of
    at most `part_grams` grams (about 40 bytes each), dealt by language and a context's last byte;
    one last byte of one language holds 2^24 grams at most, whatever the data. One part: the
    documents are scanned once and nothing is shuffled. More: a scan per part, after each its part
    is freed, and the exact whole lengths of a document's parts are added up, so the number of
    parts does not change any result.

    Null text, or one without a letter: `und`, score 0. No language learned: the same for all.
    Equal lengths: the language that is first by name. Null id: left out. Repeated rows: a row
    each. Very long texts are scored whole. No documents: no rows.
    """
    spark = documents.sparkSession
    docs = documents.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    ).where("doc_id IS NOT NULL")
    counts = stored(count_grams(learned_from, text_col, lang_col), "grams")
    first: dict[str, np.ndarray] = {}
    for row in counts.groupBy("lang", (F.col("gram") % 256).cast("int").alias("byte")).agg(F.sum("n").alias("n")).collect():
        first.setdefault(row["lang"], np.zeros(256, np.int64))[row["byte"]] = row["n"]
    langs = sorted(first)
    parts = _parts(counts, part_grams)

    if len(parts) <= 1:
        model = spark.sparkContext.broadcast(_trees(counts, parts[0], first) if parts else [])

        def predict(frames):
            trees = [t for _, t, _ in model.value]
            ends = [e for _, _, e in model.value]
            for frame in frames:
                texts = [None if pd.isna(t) else t for t in frame.text.tolist()]
                known = [t or "" for t in texts]
                lengths = [_lengths_of(known[part], trees, ends) for part in chunks(known)]
                pred, score = _verdicts(langs, np.concatenate(lengths) if lengths else np.zeros((0, len(langs))), texts)
                yield pd.DataFrame({"doc_id": frame.doc_id, "lang_pred": pred, "score": score})

        return docs.mapInPandas(predict, PREDICTED)

    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    sums = None
    for number, part in enumerate(parts):
        model = spark.sparkContext.broadcast(_trees(counts, part, first))
        at = [langs.index(lang) for lang in sorted(part)]
        own = stored(keyed.mapInPandas(_partial(model, at, len(langs), number), LENGTHS), "lengths")
        model.unpersist()
        sums = own if sums is None else sums.union(own)
    # Equal rows have equal lengths: one stays per part, and their number is kept.
    once = sums.groupBy("doc_id", "mark", "part").agg(F.first("lengths").alias("lengths"), F.count("*").alias("copies"))
    whole = once.groupBy("doc_id", "mark").agg(F.collect_list("lengths").alias("all"), F.max("copies").alias("copies"))
    rows = whole.withColumn("_", F.explode(F.sequence(F.lit(1), F.col("copies"))))

    def decide(frames):
        for frame in frames:
            lengths = np.array([np.sum(np.stack(list(a)), axis=0) for a in frame["all"]], np.int64).reshape(-1, len(langs))
            texts = ["a" if m[0] == "1" else None for m in frame.mark]
            pred, score = _verdicts(langs, lengths, texts)
            yield pd.DataFrame({"doc_id": frame.doc_id, "lang_pred": pred, "score": score})

    return rows.select("doc_id", "mark", "all").mapInPandas(decide, PREDICTED)


def _partial(model, at: list[int], n_langs: int, number: int):
    """Lengths by one part. The mark tells texts of one id apart and says whether one has a letter."""

    def run(frames):
        trees, ends = [t for _, t, _ in model.value], [e for _, _, e in model.value]
        for frame in frames:
            texts = frame.text.tolist()
            out = np.zeros((len(texts), n_langs), np.int64)
            for part in chunks(texts):
                out[part, at] = _lengths_of(texts[part], trees, ends)
            marks = [("1" if any(map(str.isalpha, t)) else "0") + hashlib.sha256(t.encode("utf-8", "replace")).hexdigest() for t in texts]
            yield pd.DataFrame({"doc_id": frame.doc_id, "mark": marks, "part": number, "lengths": list(out)})

    return run
