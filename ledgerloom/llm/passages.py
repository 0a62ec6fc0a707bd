"""Removal of repeated passages with a suffix array over sampled suffixes."""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, texts_of

ANCHORS = "key long, doc_id long, pos int, sure boolean"
FLAGGED = "doc_id long, pos int"
SUFFIXES = "bucket int, lead binary, context binary, before int, doc_id long, start int, size int"
SPANS = "doc_id long, start int, size int"
KEPT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept_text string"
CHUNK = 1 << 20


class AnchorFinder:
    """Sampled positions of a byte string.

    Each window of `length` bytes has one anchor: of its `lead`-byte strings the one with the
    smallest hash, the leftmost of equals. Where an anchor lies in a window depends on the
    window's bytes alone, so equal windows have equal anchors at equal offsets.
    """

    def __init__(self, length: int, lead: int, seed: int = 3):
        random = np.random.default_rng(seed)
        self.length, self.lead, self.reach = length, lead, length - lead + 1
        self.code = random.integers(1, 1 << 63, 256, dtype=np.uint64)
        base = int(random.integers(1, 1 << 62)) * 2 + 1
        size = CHUNK + length + 1
        self.power = np.cumprod(np.full(size, base, np.uint64))
        self.inverse = np.cumprod(np.full(size, pow(base, -1, 1 << 64), np.uint64))

    def _hashes(self, data: np.ndarray) -> np.ndarray:
        """A hash of each `lead`-byte string, from differences of prefix sums."""
        sums = np.empty(len(data) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(self.code[data] * self.power[: len(data)], out=sums[1:])
        out = (sums[self.lead :] - sums[: -self.lead]) * self.inverse[: len(data) - self.lead + 1]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        return out

    def runs(self, data: np.ndarray):
        """(anchor, its hash, first window, end of windows) of each run of windows with one anchor."""
        found = []
        for at in range(0, max(0, len(data) - self.length + 1), CHUNK):
            hashes = self._hashes(data[at : at + CHUNK + self.length - 1])
            # The upper bits of the hash and the place in one number: the least is the leftmost of equals.
            least = (hashes & np.uint64(0xFFFFFFFFFE000000)) | np.arange(len(hashes), dtype=np.uint64)
            width = 1
            while 2 * width <= self.reach:
                least = np.minimum(least[:-width], least[width:])
                width *= 2
            rest = self.reach - width
            least = np.minimum(least[: len(least) - rest], least[rest:]) if rest else least
            place = (least & np.uint64(0x1FFFFFF)).astype(np.int64)
            first = np.flatnonzero(np.diff(place, prepend=-1))
            anchor = place[first]
            found.append((anchor + at, hashes[anchor].view(np.int64), first + at, np.append(first[1:], len(place)) + at))
        if not found:
            return (np.zeros(0, np.int64),) * 4
        return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _bytes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode(), np.uint8)


def _anchors(length: int, lead: int):
    """Anchors of all documents. What a batch holds twice is sure to repeat: one of them
    keeps its key, the others travel under keys of their own, so no key gathers more rows
    than there are batches."""

    def run(frames):
        finder = AnchorFinder(length, lead)
        for frame in frames:
            keys, docs, places = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for doc, text in zip(frame.doc_id, frame.text, strict=True):
                anchor, key, _, _ = finder.runs(_bytes(text))
                keys.append(key)
                places.append(anchor)
                docs.append(np.full(len(key), doc))
            key, doc, pos = np.concatenate(keys), np.concatenate(docs), np.concatenate(places)
            _, first, name, count = np.unique(key, return_index=True, return_inverse=True, return_counts=True)
            sure = (count > 1)[name]
            own = np.ones(len(key), bool)
            own[first] = False
            key[own] = (doc[own] * 1_000_003 + pos[own]) * np.int64(0x9E3779B97F4A7C1)
            yield pd.DataFrame({"key": key, "doc_id": doc, "pos": pos, "sure": sure})

    return run


def _repeated(frames):
    """Of rows sorted by key, those whose key occurs again."""
    last = None
    for frame in frames:
        if last is not None:
            frame = pd.concat([last, frame], ignore_index=True)
        key = frame.key.to_numpy()
        same = key[1:] == key[:-1]
        frame["sure"] |= np.append(same, False) | np.insert(same, 0, False)
        last = frame.tail(1)
        done = frame.iloc[:-1]
        yield done.loc[done.sure, ["doc_id", "pos"]]
    if last is not None:
        yield last.loc[last.sure, ["doc_id", "pos"]]


def _joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Overlapping or touching (start, end) as maximal runs."""
    out: list[list[int]] = []
    for start, end in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [(a, b) for a, b in out]


def _suffixes(length: int, lead: int, splitters: np.ndarray):
    """The suffixes at repeated anchors, with as many bytes before and after the anchor as
    its windows reach. Equal ones of a batch leave once, for the earliest; the later ones are
    repeats already and leave as spans."""

    def run(frames):
        finder = AnchorFinder(length, lead)
        for frame in frames:
            first: dict[tuple[int, bytes], tuple[int, int]] = {}
            spans: dict[int, list[tuple[int, int]]] = {}
            for doc, text, wanted in zip(frame.doc_id, frame.text, frame.places, strict=True):
                raw = text.encode()
                anchor, _, start, end = finder.runs(np.frombuffer(raw, np.uint8))
                keep = np.isin(anchor, wanted)
                for a, s, e in zip(anchor[keep].tolist(), start[keep].tolist(), end[keep].tolist(), strict=True):
                    key = (a - s, raw[s : e - 1 + length])
                    held = first.setdefault(key, (doc, s))
                    if held != (doc, s):
                        later = max(held, (doc, s))
                        first[key] = min(held, (doc, s))
                        spans.setdefault(later[0], []).append((later[1], later[1] + len(key[1])))
            rows = [(context[before : before + lead], context, before, doc, s, len(context)) for (before, context), (doc, s) in first.items()]
            out = pd.DataFrame(rows, columns=["lead", "context", "before", "doc_id", "start", "size"])
            leads = np.array(out.lead.tolist(), f"S{lead}")
            out.insert(0, "bucket", np.searchsorted(splitters, leads, side="right") if len(out) else [])
            yield out
            rows = [(doc, s, e - s) for doc, own in spans.items() for s, e in _joined(own)]
            out = pd.DataFrame(rows, columns=["doc_id", "start", "size"])
            out["bucket"] = out.start % (len(splitters) + 1)
            out["lead"], out["context"], out["before"] = None, None, 0
            yield out[["bucket", "lead", "context", "before", "doc_id", "start", "size"]]

    return run


def multikey_groups(rank: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Numbers rows so that two rows have one number when their rank and all their words are
    equal. Sorts by one word at a time; only rows still tied go on to the next word."""
    rank = np.unique(rank, return_inverse=True)[1]
    active = np.arange(len(rank))
    for column in range(words.shape[1]):
        word = words[active, column]
        order = np.lexsort((word, rank[active]))
        active = active[order]
        own, word = rank[active], word[order]
        new = np.ones(len(active), bool)
        new[1:] = (own[1:] != own[:-1]) | (word[1:] != word[:-1])
        start = np.flatnonzero(new)
        rank[active] = rank.max(initial=0) + 1 + np.cumsum(new)
        single = np.zeros(len(active), bool)
        single[start] = np.diff(np.append(start, len(active))) == 1
        active = active[~single]
        if not len(active):
            break
    return rank


def _compare(group: list, length: int):
    """Spans of the suffixes in `group` that an earlier one repeats. Each item is
    (lead number, bytes before the anchor, context, doc, start); no two have one context."""
    lead, before, doc, start = (np.array(x, np.int64) for x in zip(*[(g[0], g[1], g[3], g[4]) for g in group], strict=True))
    size = np.array([len(g[2]) for g in group])
    count = size - length + 1
    flat = np.frombuffer(b"".join(g[2] for g in group) + b"\0" * 8, np.uint8)
    row = np.repeat(np.arange(len(group)), count)
    step = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
    base = (np.cumsum(size) - size)[row] + step
    columns = []
    for at in range(0, length, 8):
        word = np.zeros(len(row), np.uint64)
        for i in range(at, min(at + 8, length)):
            word = word << np.uint64(8) | flat[base + i]
        columns.append(word)
    # Equal windows have their anchor at the same offset.
    number = multikey_groups(lead[row] * (length + 1) + before[row] - step, np.stack(columns, 1))
    docs, places = doc[row], start[row] + step
    order = np.lexsort((places, docs, number))
    number = number[order]
    later = np.zeros(len(row), bool)
    later[order[1:]] = number[1:] == number[:-1]
    # Runs of repeated windows of one suffix.
    same = np.concatenate(([False], row[1:] == row[:-1]))
    opens = np.flatnonzero(later & ~(same & np.concatenate(([False], later[:-1]))))
    shut = np.flatnonzero(later & ~np.concatenate((same[1:] & later[1:], [False])))
    return docs[opens], places[opens], places[shut] - places[opens] + length


def _sort_bucket(length: int, most: int):
    """Works through suffixes sorted by lead. Equal contexts of a lead meet in a table; leads
    with several contexts are compared window by window, many leads at a time."""

    def run(frames):
        current, contexts, waiting, windows, number = None, {}, [], 0, 0
        spans: list[tuple[int, int, int]] = []

        def close():
            nonlocal windows, number
            if len(contexts) > 1:
                number += 1
                waiting.extend((number, before, context, doc, start) for (before, context), (doc, start) in contexts.items())
                windows += sum(len(context) - length + 1 for _, context in contexts)
            contexts.clear()

        def out():
            nonlocal windows
            frame = pd.DataFrame(spans, columns=["doc_id", "start", "size"])
            spans.clear()
            if waiting:
                docs, starts, sizes = _compare(waiting, length)
                frame = pd.concat([frame, pd.DataFrame({"doc_id": docs, "start": starts, "size": sizes})])
                waiting.clear()
                windows = 0
            return frame.astype({"doc_id": np.int64, "start": np.int32, "size": np.int32})

        for frame in frames:
            for lead, context, before, doc, start, size in zip(
                frame.lead, frame.context, frame.before, frame.doc_id, frame.start, frame["size"], strict=True
            ):
                if lead is None:
                    spans.append((doc, start, size))
                    continue
                if lead != current:
                    close()
                    current = lead
                held = contexts.setdefault((before, context), (doc, start))
                if held != (doc, start):
                    later = max(held, (doc, start))
                    contexts[before, context] = min(held, (doc, start))
                    spans.append((*later, size))
                if windows > most:
                    yield out()
            yield out()
        close()
        yield out()

    return run


def _cut(frames):
    """What is left of each text."""
    for frame in frames:
        rows = []
        for doc, text, starts, sizes in zip(frame.doc_id, frame.text, frame.starts, frame.sizes, strict=True):
            raw = text.encode()
            spans = [] if starts is None else _joined([(s, min(s + n, len(raw))) for s, n in zip(starts.tolist(), sizes.tolist(), strict=True) if s < len(raw)])
            kept, at = [], 0
            for start, end in spans:
                kept.append(raw[at:start])
                at = end
            left = b"".join([*kept, raw[at:]])
            rows.append((doc, len(raw), len(raw) - len(left), len(spans), hashlib.sha256(left).hexdigest(), left.decode(errors="ignore")))
        yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept_text"])


def remove_passages(
    documents: DataFrame, length: int = 100, lead: int = 24, sample: int = 2000, windows: int = 100_000,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept_text.

    Removes each byte that a string of `length` bytes covers which also starts earlier, in a
    smaller id or before in the same text. Strings are judged on the input and never cross
    documents. In `kept_text` characters that the cut halves are left out.

    1. Of the suffixes one in about (length - lead) / 2 is sampled, by the bytes alone, so
       that two equal strings have a sampled suffix at the same place.
    2. Sampled suffixes whose first `lead` bytes occur once are dropped: hashes are sorted by
       range of the hash and only counted.
    3. The others are dealt to buckets by splitters of their leading bytes, taken from a
       bounded `sample` of documents, which steers the balance alone. Equal leading bytes
       share a bucket, so no string is divided by a boundary. In a bucket they are sorted by
       eight bytes at a time, ties only, and runs of equal strings give the repeats.

    Equal suffixes of one task leave it once, so a passage in a third of all rows is a row per
    batch. The edges of such a passage, where each copy goes on differently, stay rows each.

    Null or empty text, or a text under `length` bytes: nothing removed. Null id: left out.
    Rows that repeat an id: each is returned, and what repeats in one is removed from all of
    them. No documents: no rows.
    """
    docs = texts_of(documents, id_col, text_col)
    spark = documents.sparkSession
    parts = shuffle_partitions(spark)

    total = max(1, docs.count())
    drawn = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(max(1, total // sample))) == 0).mapInPandas(_leads(length, lead), "lead binary")
    leads = np.unique(np.array([bytes(r["lead"]) for r in drawn.toLocalIterator()], f"S{lead}"))
    splitters = np.unique(leads[np.linspace(0, len(leads) - 1, min(len(leads), 8 * parts)).astype(int)]) if len(leads) else leads

    flagged = (
        docs.mapInPandas(_anchors(length, lead), ANCHORS)
        .repartition(parts, "key").sortWithinPartitions("key").mapInPandas(_repeated, FLAGGED)
        .groupBy("doc_id").agg(F.collect_list("pos").alias("places"))
    )
    spans = (
        docs.join(flagged, "doc_id").mapInPandas(_suffixes(length, lead, splitters), SUFFIXES)
        .repartition(parts, "bucket").sortWithinPartitions("lead").mapInPandas(_sort_bucket(length, windows), SPANS)
        .groupBy("doc_id").agg(F.collect_list("start").alias("starts"), F.collect_list("size").alias("sizes"))
    )
    return docs.join(spans, "doc_id", "left").mapInPandas(_cut, KEPT)


def _leads(length: int, lead: int):
    """Up to eight leading strings of anchors per document."""

    def run(frames):
        finder = AnchorFinder(length, lead)
        for frame in frames:
            rows = []
            for text in frame.text:
                raw = text.encode()
                anchor = finder.runs(np.frombuffer(raw, np.uint8))[0]
                rows += [raw[a : a + lead] for a in anchor[:: max(1, len(anchor) // 8)][:8].tolist()]
            yield pd.DataFrame({"lead": rows})

    return run
