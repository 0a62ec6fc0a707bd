"""Pairs at the limit of similarity that the estimate must not drop."""

from inspect import signature
from math import comb
from random import Random

import numpy as np
import pytest
from samples import prose

from ledgerloom.llm import near_copies as near
from ledgerloom.llm.near_copies import near_copies


@pytest.mark.parametrize("seed", [2721, 5118])
def test_a_pair_at_the_limit_with_few_equal_minima(spark, seed):
    """Six of eight shingles are common, 75%, but by chance few of the kept bits agree."""
    words = prose(seed, 12).split()
    frame = spark.createDataFrame([(1, " ".join(words[:-1])), (2, " ".join(words[1:]))], "doc_id long, text string")
    assert {r.component_id for r in near_copies(frame).collect()} == {1}


def test_the_estimate_loses_less_than_the_bands():
    default = {name: p.default for name, p in signature(near_copies).parameters.items()}
    size, similar = default["size"], default["percent"] / 100
    least = size - int(size - size * (1 + 15 * (similar - default["margin"])) / 16)
    agree = (1 + 15 * similar) / 16
    dropped = sum(comb(size, k) * agree**k * (1 - agree) ** (size - k) for k in range(least))
    assert dropped < (1 - similar ** default["rows"]) ** default["bands"]


def brute_force(texts: dict[int, str]) -> dict[int, int]:
    """Each document's component by comparing all pairs of word sets."""
    sets = {}
    for doc, text in texts.items():
        words = text.lower().split()
        sets[doc] = {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    found = {doc: doc for doc in texts}
    changed = True
    while changed:
        changed = False
        for a in texts:
            for b in texts:
                if found[a] < found[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b]):
                    found[b], changed = found[a], True
    return found


@pytest.mark.parametrize("rows", [512, 7])
def test_a_family_around_the_limit_in_chunks(spark, monkeypatch, rows):
    """Members differ from a common text by up to six words, so that many pairs lie just below the limit."""
    monkeypatch.setattr(near, "CHUNK_ROWS", rows)
    draw = Random(9)
    base = prose(3, 90).split()
    texts = {}
    for doc in range(140):
        words = list(base)
        for place in draw.sample(range(len(words)), draw.randint(1, 6)):
            words[place] = f"w{draw.randint(0, 10**9)}"
        texts[doc] = " ".join(words)
    frame = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.component_id for r in near.near_copies(frame).collect()}
    assert got == brute_force(texts)
    assert len(set(got.values())) > 1


def test_pairs_in_tasks_are_the_brute_force_ones():
    """What a task compares: other components, the main one or a larger id, the first shared band, the limit."""
    draw = np.random.default_rng(4)
    n, bands, longs = 80, 6, 4
    group = {
        "left": draw.random(n) < 0.5, "rep": draw.permutation(n), "component": draw.integers(0, 5, n), "main": np.zeros(n, np.int64),
        "band": np.full(n, 2), "bits": draw.integers(-(1 << 63), 1 << 63, (n, longs)), "bands": draw.integers(0, 3, (n, bands)),
    }
    want = set()
    for x in range(n):
        for y in range(n):
            off = sum(
                (int(p) >> s & 15) != (int(q) >> s & 15) for p, q in zip(group["bits"][x], group["bits"][y], strict=True) for s in range(0, 64, 4)
            )
            first = next((i for i in range(bands) if group["bands"][x][i] == group["bands"][y][i]), None)
            ordered = group["component"][y] == 0 or group["rep"][x] < group["rep"][y]
            if group["left"][x] and not group["left"][y] and group["component"][x] != group["component"][y] and ordered and first == 2 and off <= 60:
                want.add((x, y, off))
    got = near._pairs(group, 60)
    assert want and set(zip(*(part.tolist() for part in got), strict=True)) == want
