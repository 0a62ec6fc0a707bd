"""Operators over texts against brute force and the libraries they have to match."""

import hashlib
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerloom.llm.bpe import BpeCodec, encode_documents
from ledgerloom.llm.exact_copies import directory, exact_copies
from ledgerloom.llm.licences import BASE, rules, scan_licenses
from ledgerloom.llm.near_copies import near_copies
from ledgerloom.llm.packing import ByteEncoder, Tournament, pack
from ledgerloom.llm.passages import AnchorFinder, multikey_groups, remove_passages

WORD_FILE, BYTE_FILE = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("byte_bpe_50k.json")
ODD = st.text(st.sampled_from(list("aAbtheinIΣσß'ś\x1c \t\n\x85\xa012½中🙂-,.<|endoftxsar>가")), max_size=60)


def known(texts):
    return [(i, t or "") for i, t in texts if i is not None]


def test_word_bpe_codec_equals_the_library():
    library, codec = Tokenizer.from_file(WORD_FILE), BpeCodec(WORD_FILE)

    @settings(max_examples=300, deadline=None)
    @given(ODD)
    def check(text):
        ids = library.encode(text, add_special_tokens=False).ids
        assert codec.encode(text) == ids
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)

    check()


def test_byte_encoder_equals_the_library():
    library, encoder = Tokenizer.from_file(BYTE_FILE), ByteEncoder(BYTE_FILE)

    @settings(max_examples=300, deadline=None)
    @given(ODD)
    def check(text):
        assert np.frombuffer(encoder(text), "<u4").tolist() == library.encode(text, add_special_tokens=False).ids

    check()
    assert np.frombuffer(encoder("ab" * 15_000), "<u4").tolist() == library.encode("ab" * 15_000, add_special_tokens=False).ids


def test_encode_documents(documents, nothing, texts):
    library = Tokenizer.from_file(WORD_FILE)
    want = []
    for i, text in known(texts):
        ids = library.encode(text, add_special_tokens=False).ids
        digest = [hashlib.sha256(x.encode()).hexdigest() for x in (" ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False))]
        want.append((i, len(ids), *digest))
    assert sorted(map(tuple, encode_documents(documents, WORD_FILE, chunk=500).collect())) == sorted(want)
    assert encode_documents(nothing, WORD_FILE).count() == 0


@pytest.mark.parametrize(("group", "every"), [(8, 4), (1000, 1), (1000, 1000)])
def test_pack(documents, nothing, texts, group, every):
    library = Tokenizer.from_file(BYTE_FILE)
    rows = pack(documents, BYTE_FILE, group_documents=group, filler_every=every).collect()
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= 2048
    for i, text in known(texts):
        if i == 60:
            continue
        ids, at = [*library.encode(text, add_special_tokens=False).ids, 1], 0
        for r in sorted(pieces[i], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    assert len(pieces[60]) == 2
    assert pack(nothing, BYTE_FILE).count() == 0


def test_fillers_close_the_holes(documents):
    rows = pack(documents, BYTE_FILE, group_documents=1000, filler_every=1).collect()
    used = {}
    for r in rows:
        used[r.sequence_id] = used.get(r.sequence_id, 0) + r.length
    assert sum(n < 2048 for n in used.values()) <= 1


def test_tournament_takes_the_first_bin_with_room():
    tree, rooms = Tournament(5, 10), [10] * 5
    for size in (7, 6, 4, 3, 3, 10, 1):
        want = next(i for i, room in enumerate(rooms) if room >= size)
        assert tree.take(size) == (want, rooms[want])
        rooms[want] -= size


def test_exact_copies(documents, nothing, texts):
    groups = {}
    for i, text in known(texts):
        groups.setdefault(re.sub("[\x20\x09-\x0d]", "", text), []).append((-len(text), i))
    want = []
    for norm, own in groups.items():
        best, kept = min(own), 0
        for size, i in own:
            keep = (size, i) == best and not kept
            kept += keep
            want.append((i, best[1], len(own), keep, hashlib.sha256(norm.encode()).hexdigest()))
    for options in ({}, {"capacity": 1, "bits": 4, "budget": 300}):
        assert sorted(map(tuple, exact_copies(documents, **options).collect())) == sorted(want)
    assert exact_copies(nothing).count() == 0


def test_directory_splits_only_what_is_too_full():
    counts = np.array([9, 1, 0, 0, 1, 1, 1, 1])
    buckets = directory(counts, 4)
    totals = {int(b): int(counts[buckets == b].sum()) for b in set(buckets)}
    assert buckets[0] != buckets[1] and len(set(buckets[4:])) == 1
    assert all(n <= 4 or (buckets == b).sum() == 1 for b, n in totals.items())


def shingles(text):
    words = [w for w in re.split("[\x20\x09-\x0d]+", text.translate({c: c + 32 for c in range(65, 91)})) if w]
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def named(nodes, linked):
    parent = {i: i for i in nodes}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in linked:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in nodes}


def test_near_copies(documents, nothing, texts):
    sets = {i: shingles(t) for i, t in known(texts)}
    linked = [(a, b) for a in sets for b in sets if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    top = named(sets, linked)
    want = sorted((i, len(sets[i]), top[i], top[i] == i) for i, _ in known(texts))
    assert sorted(map(tuple, near_copies(documents).collect())) == want
    assert near_copies(nothing).count() == 0


def cut(rows, length):
    seen, out = set(), []
    for i, text in sorted(rows):
        raw = text.encode()
        gone = np.zeros(len(raw), bool)
        for p in range(len(raw) - length + 1):
            window = raw[p : p + length]
            if window in seen:
                gone[p : p + length] = True
            seen.add(window)
        runs = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        left = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out.append((i, len(raw), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return out


@pytest.mark.parametrize(("length", "lead"), [(100, 24), (30, 8)])
def test_remove_passages(documents, nothing, texts, length, lead):
    rows = [r for r in known(texts) if r[0] != 60]
    got = remove_passages(documents.where("doc_id <> 60"), length, lead, windows=50).drop("kept_text").collect()
    assert sorted(map(tuple, got)) == sorted(cut(rows, length))
    assert remove_passages(nothing).count() == 0


def test_anchors_depend_on_the_window_alone():
    finder = AnchorFinder(40, 10)
    data = np.frombuffer(b"abcab" * 30 + b"the quick brown fox jumps over the lazy dog" * 2, np.uint8)
    anchor, _, start, end = finder.runs(data)
    places = {p: a - p for a, s, e in zip(anchor, start, end, strict=True) for p in range(s, e)}
    assert sorted(places) == list(range(len(data) - 39))
    by = {}
    for p, offset in places.items():
        assert by.setdefault(data[p : p + 40].tobytes(), offset) == offset


def test_multikey_groups():
    words = np.array([[1, 2], [1, 3], [1, 2], [0, 2], [1, 2]], np.uint64)
    groups = multikey_groups(np.array([0, 0, 0, 0, 1]), words)
    assert groups[0] == groups[2] and len(set(groups.tolist())) == 4


def test_scan_licenses(documents, nothing, texts):
    got = {r.doc_id: r for r in scan_licenses(documents).collect()}
    lower = {c: c + 32 for c in range(65, 91)}
    for i, text in known(texts):
        words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text.translate(lower))
        found = [(p, label) for phrase, label in BASE.items() for p in range(len(words)) if words[p : p + len(phrase.split())] == phrase.split()]
        r = got[i]
        assert (r.n_words, r.n_base) == (len(words), len(found))
        assert (r.first_word, r.last_word) == ((min(found)[0], max(found)[0]) if found else (None, None))
        assert r.base_labels == ",".join(sorted({label for _, label in found}))
    assert got[52].labels == "cc-by,gpl,mit" and got[52].score == 1.0 and got[43].score == 0.0
    assert scan_licenses(nothing).count() == 0
    assert len(rules()) >= 200


@pytest.mark.parametrize(("text", "labels"), [
    ("CC BY-NC-SA 4.0", "cc-by,cc-by-nc-sa"), ("SPDX-License-Identifier: MPL-2.0", "mpl"), ("amit licenses nothing", ""),
    ("the GNU Lesser General Public License", "lgpl"), ("All rights reserved.", "proprietary"),
])
def test_contained_detections_are_suppressed(frame, text, labels):
    assert scan_licenses(frame("doc_id long, text string", (1, text))).first().labels == labels
