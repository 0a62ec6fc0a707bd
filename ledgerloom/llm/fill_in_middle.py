"""Fill-in-middle examples: texts cut in three at token boundaries and put in another order.

The boundaries of a text are a sorted list of offsets. A learned index over them maps a rank,
"after the k-th token", to an offset: straight segments, each within `reach` of every offset it
covers, predict it, and a stored residual of one byte corrects the prediction exactly. What is
kept of a text's boundaries is a few segments and a byte per token, not an offset per token.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts_of

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
EXAMPLES = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def boundaries(text: str) -> np.ndarray:
    """Offsets in code points of the ends of `[A-Za-z]+|[^A-Za-z]`, 0 first."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(codes):
        return np.zeros(1, np.int64)
    letter = ((codes | 32) - np.uint32(97)) < 26
    inner = np.flatnonzero(~(letter[1:] & letter[:-1])) + 1
    return np.concatenate(([0], inner, [len(codes)]))


class RankIndex:
    """offset(k) of sorted integer offsets, by segments and residuals.

    A segment starts at rank `first` with offset `base` and rises by `rise` in `run` ranks.
    Predictions are integers, so fitting and reading agree on every machine.
    """

    START = 4096

    def __init__(self, offsets: np.ndarray, reach: int = 127):
        self.residuals = np.zeros(len(offsets), np.int8 if reach < 128 else np.int64)
        segments, at = [], 0
        while at < len(offsets):
            size = self._span(offsets, at, reach)
            self.residuals[at : at + size] = self._errors(offsets, at, size)
            segments.append((at, int(offsets[at]), int(offsets[at + size - 1] - offsets[at]), max(size - 1, 1)))
            at += size
        self.first, self.base, self.rise, self.run = (np.array(c, np.int64) for c in zip(*segments, strict=True))

    @classmethod
    def _span(cls, offsets: np.ndarray, at: int, reach: int) -> int:
        """A length from `at` whose chord is within reach of its offsets: doubled while that
        holds, then bisected, so that the work grows with the length that is found."""

        def fits(size: int) -> bool:
            return int(np.abs(cls._errors(offsets, at, size)).max()) <= reach

        most = len(offsets) - at
        good, size = 1, min(cls.START, most)
        while fits(size):
            if size == most:
                return most
            good, size = size, min(2 * size, most)
        while size - good > 1:
            middle = (good + size) // 2
            good, size = (middle, size) if fits(middle) else (good, middle)
        return good

    @staticmethod
    def _errors(offsets: np.ndarray, at: int, size: int) -> np.ndarray:
        own = offsets[at : at + size]
        return own - own[0] - np.arange(size, dtype=np.int64) * int(own[-1] - own[0]) // max(size - 1, 1)

    def predict(self, rank: int) -> int:
        i = int(np.searchsorted(self.first, rank, side="right")) - 1
        return int(self.base[i]) + (rank - int(self.first[i])) * int(self.rise[i]) // int(self.run[i])

    def __getitem__(self, rank: int) -> int:
        return self.predict(rank) + int(self.residuals[rank])


def draws(seed: int, doc_id: int) -> list[int]:
    """Four numbers of 32 bits that depend on the seed and the id only."""
    digest = hashlib.sha256(f"{seed}:{doc_id}".encode()).digest()
    return [int.from_bytes(digest[i : i + 4], "big") for i in (0, 4, 8, 12)]


def transform(doc_id: int, text: str, seed: int, transformed_percent: int, spm_percent: int, reach: int) -> tuple:
    """(number of tokens, form, code points of prefix and middle, output)."""
    ends = boundaries(text)
    n, (h1, h2, h3, h4) = len(ends) - 1, draws(seed, doc_id)
    if not text or h3 % 100 >= transformed_percent or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    index = RankIndex(ends, reach)
    one, two = index[min(h1 % (n + 1), h2 % (n + 1))], index[max(h1 % (n + 1), h2 % (n + 1))]
    prefix, middle, suffix = text[:one], text[one:two], text[two:]
    if h4 % 100 < spm_percent:
        return n, "spm", one, two - one, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", one, two - one, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def fill_in_middle(
    documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", seed: int = 1,
    transformed_percent: int = 90, spm_percent: int = 20, reach: int = 127,
) -> DataFrame:
    """One row per document: doc_id, n tokens, form, prefix_chars, middle_chars, output.

    A scan without a shuffle; a task holds one batch of texts. Both cuts are drawn from a hash of
    the seed and the id, so reruns and lost executors give the same examples.

    `form` is `plain` (output is the text), `psm` or `spm`. Null or empty text: plain, no tokens.
    A text that holds one of the three marks: plain, as it could not be told apart again. Both
    draws equal: an empty middle. Very long texts are cut like others. Null id: left out. Repeated
    rows: a row each, equal where id and text are. No documents: no rows.
    """

    def run(frames):
        for frame in frames:
            rows = [
                (i, *transform(i, text, seed, transformed_percent, spm_percent, reach))
                for i, text in zip(frame.doc_id.tolist(), frame.text.tolist(), strict=True)
            ]
            out = pd.DataFrame(rows, columns=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])
            yield out.astype({"prefix_chars": "Int64", "middle_chars": "Int64"})

    return texts_of(documents, id_col, text_col).mapInPandas(run, EXAMPLES)


def restored(output: Column, form: Column) -> Column:
    """The text that an output came from. The first mark of a kind is the one that was put in: no
    part holds one, and none can begin in a part and end in a mark."""

    def between(start: str, end: str) -> Column:
        at = F.locate(start, output) + len(start)
        return output.substr(at, F.locate(end, output) - at)

    after = output.substr(F.locate(MIDDLE, output) + len(MIDDLE), F.length(output))
    psm = F.concat(between(PREFIX, SUFFIX), after, between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), after, between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
