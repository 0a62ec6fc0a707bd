"""Packing of documents into fixed sequences: first-fit decreasing on a tournament tree."""

from __future__ import annotations

import json
import math
import os
import re
import zlib
from array import array

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import byte_symbols
from .common import texts_of

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
COUNTED = "grp long, doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


class ByteEncoder:
    """Token ids of whole texts, as the tokenizers library gives them for the file at `path`.

    Ordinary text goes through the same vocabulary as merge ranks, in a fourth of the time;
    texts that hold a special token, or a very long run without white space, go through the
    library itself.
    """

    # The byte-level tokenizer's word pattern, with possessive repeats.
    PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
    LONG = re.compile(r"\S{20000}")

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as file:
            saved = json.load(file)
        as_byte = {s: b for b, s in enumerate(byte_symbols())}
        ranks = {bytes(map(as_byte.__getitem__, t)): i for t, i in saved["model"]["vocab"].items()}
        self.special = [t["content"] for t in saved["added_tokens"]]
        self.ordinary = tiktoken.Encoding("own", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> bytes:
        """The ids as little-endian unsigned 32-bit numbers."""
        if any(s in text for s in self.special) or self.LONG.search(text):
            ids = self.library.encode(text, add_special_tokens=False).ids
        else:
            ids = self.ordinary.encode_ordinary(text)
        return array("I", ids).tobytes()


def _tokenise(path: str, length: int, end_id: int, filler_every: int):
    """Cuts each document into whole sequences and a rest. Of one document in
    `filler_every` the ids of the rest travel along, so that it can be cut anywhere."""

    def run(frames):
        encode, end = ByteEncoder(path), np.array([end_id], "<u4").tobytes()
        for frame in frames:
            rows = []
            for doc, text, grp, filler in zip(frame.doc_id, frame.text, frame.grp, frame.filler, strict=True):
                ids = encode(text) + end
                total = len(ids) // 4
                for start in range(0, total, length):
                    piece = ids[4 * start : 4 * (start + length)]
                    kept = piece if filler % filler_every == 0 and len(piece) < 4 * length else None
                    rows.append((grp, doc, start, len(piece) // 4, zlib.crc32(piece), total, kept))
            yield pd.DataFrame(rows, columns=["grp", "doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    return run


class Tournament:
    """The room left in each of `bins` bins; each inner node holds the larger of its two."""

    def __init__(self, bins: int, room: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.best = [room] * (2 * self.leaves)

    def take(self, size: int) -> tuple[int, int]:
        """The first bin with room for `size`, and its room before."""
        best, node = self.best, 1
        while node < self.leaves:
            node *= 2
            if best[node] < size:
                node += 1
        room = best[node]
        best[node] -= size
        leaf = node - self.leaves
        while node > 1:
            node //= 2
            high = max(best[2 * node], best[2 * node + 1])
            if best[node] == high:
                break
            best[node] = high
        return leaf, room


def _pack_group(length: int):
    def run(key, frame):
        frame = frame.sort_values(["length", "doc_id", "start"], ascending=[False, True, True], ignore_index=True)
        loose = frame.ids.notna()
        whole, fillers = frame[~loose], frame[loose]
        tree, rows, used = Tournament(len(whole), length), [], 0
        rooms: dict[int, int] = {}
        for doc, start, size, crc, total in zip(whole.doc_id, whole.start, whole.length, whole.ids_crc32, whole.doc_tokens, strict=True):
            leaf, room = tree.take(size)
            rows.append((doc, start, size, crc, total, leaf, length - room))
            rooms[leaf] = room - size
            used = max(used, leaf + 1)
        # The fillers close the holes that first-fit leaves, cut where a hole ends.
        holes = sorted(((room, leaf) for leaf, room in rooms.items() if room), reverse=True)
        at, leaf, room = 0, used - 1, 0
        for doc, start, ids, total in zip(fillers.doc_id, fillers.start, fillers.ids, fillers.doc_tokens, strict=True):
            while ids:
                if not room:
                    if at < len(holes):
                        room, leaf = holes[at]
                        at += 1
                    else:
                        room, leaf, used = length, used, used + 1
                piece = ids[: 4 * room]
                size = len(piece) // 4
                rows.append((doc, start, size, zlib.crc32(piece), total, leaf, length - room))
                ids, start, room = ids[4 * room :], start + size, room - size
        out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])
        out["sequence_id"] += int(key[0]) << 32
        return out

    return run


def pack(
    documents: DataFrame, tokenizer_path: str, length: int = 2048, end_id: int = 1, group_documents: int = 8192,
    filler_every: int = 32, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document is its ids and `end_id`. What fills whole sequences is cut off, the rest goes
    to a group drawn by a hash, and each group is packed by itself: first-fit decreasing,
    the first bin with room found in a tournament tree. Only sizes and checksums are
    shuffled. One rest in `filler_every` also brings its ids and is cut to close the holes,
    so a group pads its last sequence alone; where fillers run out, holes stay and are padded.

    Empty text: one piece of one token. Null id: left out. Repeated rows: packed each. Very
    long texts: as many whole sequences as they fill. No documents: no rows.
    """
    docs = texts_of(documents, id_col, text_col)
    groups = max(1, math.ceil(docs.count() / group_documents))
    drawn = F.xxhash64("doc_id", F.xxhash64("text"))
    cut = docs.select(
        "doc_id", "text", F.pmod(drawn, F.lit(groups)).alias("grp"),
        F.pmod(F.xxhash64(drawn, F.lit(7)), F.lit(1 << 20)).alias("filler"),
    ).mapInPandas(_tokenise(tokenizer_path, length, end_id, filler_every), COUNTED)
    return cut.groupBy("grp").applyInPandas(_pack_group(length), PIECES)
