"""Byte-pair encoding and decoding in batched numpy merge rounds."""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame

from .common import texts_of

# The white space and the word pattern of the tokenizer's file.
SPACES = "\t-\r \x85\xa0  -     　"
WORD = rf"'s|'t|'re|'ve|'m|'ll|'d|[\p{{L}}]+|[\p{{N}}]|[^{SPACES}\p{{L}}\p{{N}}]+"
END = "</w>"
NONE = np.iinfo(np.int64).max
ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: itself where it is printable,
    else the next unused character from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    out, spare = [], 256
    for b in range(256):
        out.append(chr(b if b in shown else spare))
        spare += b not in shown
    return out


class MergeTable:
    """The vocabulary, and the merges as keys left * size + right in sorted order."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            saved = json.load(file)
        vocab = saved["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in saved["added_tokens"]}
        vocab = vocab | self.special
        self.size = max(vocab.values()) + 1
        self.tokens = [""] * self.size
        for token, i in vocab.items():
            self.tokens[i] = token
        pairs = [m.split(" ") if isinstance(m, str) else m for m in saved["model"]["merges"]]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        self.order = np.argsort(keys, kind="stable")  # sorted place -> rank
        self.keys = keys[self.order]
        self.merged = np.array([vocab[a + b] for a, b in pairs], np.int64)
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + END] for s in symbols], np.int64)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair by binary search, NONE for pairs that do not merge."""
        keys = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.order[at], NONE)

    def encode(self, words: list[bytes]) -> tuple[list[int], list[int]]:
        """The ids of all words, one word after the other, and where each word's ids end.

        Every round merges, in each word that is not done, all places of its lowest-ranked
        pair from left to right; only the pairs beside merged places are looked up again.
        """
        if not words:
            return [], []
        flat = np.frombuffer(b"".join(words), np.uint8)
        size = np.array([len(w) for w in words])
        sym = self.inner[flat]
        ends = np.cumsum(size)
        sym[ends - 1] = self.last[flat[ends - 1]]
        name = np.arange(len(words))
        # rank[i]: of the pair (i, i + 1); NONE at the last symbol of a word
        rank = np.full(len(sym), NONE)
        rank[:-1] = self.ranks(sym[:-1], sym[1:])
        rank[ends - 1] = NONE
        finished: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        while len(name):
            ends = np.cumsum(size)
            low = np.minimum.reduceat(rank, ends - size)
            done = low == NONE
            if done.any():
                keep = np.repeat(~done, size)
                finished.append((name[done], size[done], sym[~keep]))
                sym, rank, size, name, low = sym[keep], rank[keep], size[~done], name[~done], low[~done]
                ends = np.cumsum(size)
                if not len(name):
                    break
            at = np.flatnonzero(rank == np.repeat(low, size))
            # Places that touch are a run of one doubled symbol: every other one merges.
            fresh = np.concatenate(([True], np.diff(at) != 1))
            first = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
            at = at[(np.arange(len(at)) - first) % 2 == 0]
            word = np.searchsorted(ends, at, side="right")
            last = at + 1 == ends[word] - 1  # the merged pair closes its word
            sym[at] = self.merged[rank[at]]
            rank[at] = NONE
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            place = (np.cumsum(keep) - 1)[at]
            sym, rank = sym[keep], rank[keep]
            size = size - np.bincount(word, minlength=len(size))
            ends = np.cumsum(size)
            right = place[~last]
            rank[right] = self.ranks(sym[right], sym[right + 1])
            left = place[place > (ends - size)[word]] - 1
            rank[left] = self.ranks(sym[left], sym[left + 1])
        name, size, sym = (np.concatenate(x) for x in zip(*finished, strict=True))
        order = np.argsort(name, kind="stable")
        size, starts = size[order], (np.cumsum(size) - size)[order]
        ends = np.cumsum(size)
        take = np.arange(ends[-1]) + np.repeat(starts - (ends - size), size)
        return sym[take].tolist(), ends.tolist()


class BpeCodec:
    """Encodes texts and decodes ids; remembers the result of each piece between white space."""

    SEPARATED = re.compile("[\x1c-\x1f]")  # characters that str.split() takes for white space

    def __init__(self, path: str, kept: int = 500_000):
        self.table, self.kept = MergeTable(path), kept
        self.words, self.spaces = regex.compile(f"\n|{WORD}"), regex.compile(f"[{SPACES}]+")
        self.special = regex.compile("(" + "|".join(map(regex.escape, sorted(self.table.special))) + ")")
        self.numbers = [str(i) for i in range(self.table.size)]
        self.ids: dict[str, str] = {}
        self.decoded: dict[str, str] = {}

    def normalised(self, text: str) -> str:
        if text.isascii():
            return text.lower()
        text = unicodedata.normalize("NFC", text)
        return "".join(c.lower() for c in text) if "Σ" in text else text.lower()

    def decode(self, ids) -> str:
        """The tokens joined by a space, as the file names no decoder."""
        return " ".join([self.table.tokens[i] for i in ids])

    def _learn(self, pieces: list[str]) -> None:
        """Encodes pieces without special tokens, all their words in one batch."""
        if not pieces:
            return
        # A line end parts the pieces: it is white space, so none of them holds one.
        found = self.words.findall(self.normalised("\n".join(pieces)) + "\n")
        words = dict.fromkeys(found)
        words.pop("\n", None)
        ids, ends = self.table.encode([w.encode() for w in words])
        start = 0
        for word, end in zip(words, ends, strict=True):
            words[word] = ids[start:end]
            start = end
        numbers, tokens, own, at = self.numbers, self.table.tokens, [], 0
        for word in found:
            if word == "\n":
                self.ids[pieces[at]] = " ".join([numbers[i] for i in own])
                self.decoded[pieces[at]] = " ".join([tokens[i] for i in own])
                own, at = [], at + 1
            else:
                own = own + words[word] if own else words[word]

    def learn(self, pieces) -> None:
        plain = [p for p in pieces if "<|" not in p]
        marked = [p for p in pieces if "<|" in p]
        split = {p: [x for x in self.special.split(p) if x] for p in marked}
        parts = {x for s in split.values() for x in s}
        for token in parts & self.table.special.keys():
            self.ids[token] = str(self.table.special[token])
            self.decoded[token] = token
        self._learn(plain + [x for x in parts if x not in self.table.special])
        for piece, own in split.items():
            ids, decoded = " ".join([self.ids[x] for x in own]), " ".join([self.decoded[x] for x in own])
            self.ids[piece], self.decoded[piece] = ids, decoded

    def pieces(self, text: str) -> list[str]:
        return [p for p in self.spaces.split(text) if p] if self.SEPARATED.search(text) else text.split()

    def digests(self, texts: list[str]) -> list[tuple[int, str, str]]:
        """(number of ids, SHA-256 of the decimal ids, SHA-256 of the decoded text)."""
        parts = [self.pieces(t) for t in texts]
        if len(self.ids) > self.kept:
            self.ids.clear()
            self.decoded.clear()
        self.learn([p for p in set().union(*parts) if p not in self.ids])
        out = []
        for own in parts:
            ids, decoded = " ".join(map(self.ids.__getitem__, own)), " ".join(map(self.decoded.__getitem__, own))
            out.append((ids.count(" ") + 1 if own else 0, hashlib.sha256(ids.encode()).hexdigest(),
                        hashlib.sha256(decoded.encode()).hexdigest()))
        return out

    def encode(self, text: str) -> list[int]:
        own = self.pieces(text)
        self.learn([p for p in set(own) if p not in self.ids])
        return [int(i) for p in own for i in self.ids[p].split()]


def _encode(path: str, chunk: int):
    def run(frames):
        codec = BpeCodec(path)
        for frame in frames:
            texts, rows, at, size = frame.text.tolist(), [], 0, 0
            for i, text in enumerate(texts):
                size += len(text)
                if size >= chunk or i + 1 == len(texts):
                    rows += codec.digests(texts[at : i + 1])
                    at, size = i + 1, 0
            out = pd.DataFrame(rows, columns=["n_tokens", "ids_sha256", "decoded_sha256"])
            out.insert(0, "doc_id", frame.doc_id)
            yield out

    return run


def encode_documents(
    documents: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", chunk: int = 2_000_000
) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256.

    A scan without a shuffle. Each task keeps the ids of pieces it has met, up to a bound of
    memory, and encodes the new ones of about `chunk` characters together.

    Null or empty text: no tokens, the hashes of the empty string. Null id: left out.
    Repeated rows: a row each. No documents: no rows.
    """
    return texts_of(documents, id_col, text_col).mapInPandas(_encode(tokenizer_path, chunk), ENCODED)
