"""Near-copies by b-bit MinHash, confirmed on full shingle sets."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import components, stored, texts_of

SKETCH = "doc_id long, n_shingles long, high long, low long, bits array<long>, bands array<long>"
MASK = 0x1111111111111111
# What one side of a comparison in a task holds at most, unless it is a single text.
CHUNK_ROWS, CHUNK_SHINGLES = 512, 2_000_000


class WordCodes(dict):
    """64-bit codes of words, remembered up to a bound of memory."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 400_000:
            self.clear()
        code = self[word] = xxhash.xxh3_64_intdigest(word)
        return code


class Shingler:
    """The distinct shingles of a text as sorted 64-bit hashes.

    Words are the runs between `[\\x20\\x09-\\x0D]` after lower-casing A-Z. A text of fewer
    words than a shingle has is one shingle, a text without words has none.
    """

    def __init__(self, words: int = 5, seed: int = 5):
        self.words, self.codes = words, WordCodes()
        self.factors = np.random.default_rng(seed).integers(1, 1 << 63, words, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        codes = np.fromiter(map(self.codes.__getitem__, words), np.uint64, len(words))
        count = max(1, len(words) - self.words + 1) if len(words) else 0
        out = np.full(count, len(words) if len(words) < self.words else self.words, np.uint64)
        for i in range(min(self.words, len(words))):
            out += (codes[i : i + count] ^ (codes[i : i + count] >> np.uint64(29))) * self.factors[i]
        out ^= out >> np.uint64(32)
        out *= np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
        return np.unique(out)


class Sketcher:
    """`size` minima of a shingle set: their low four bits packed, and a hash for each band of
    `rows` of the first ones."""

    def __init__(self, size: int, bands: int, rows: int, seed: int = 11):
        random = np.random.default_rng(seed)
        self.bands, self.rows = bands, rows
        self.flip = random.integers(0, 1 << 32, size, dtype=np.uint32)
        self.factor = random.integers(0, 1 << 31, size, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
        self.mix = random.integers(1, 1 << 63, rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.band = random.integers(1, 1 << 63, bands, dtype=np.uint64)

    def __call__(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        halves = [(shingles >> np.uint64(32)).astype(np.uint32), shingles.astype(np.uint32)]
        cut = len(self.flip) // 2
        low = np.full(len(self.flip), 0xFFFFFFFF, np.uint32)
        for at in range(0, len(shingles), 2048):
            for part, half in ((slice(0, cut), halves[0]), (slice(cut, None), halves[1])):
                values = half[at : at + 2048, None] ^ self.flip[part]
                values *= self.factor[part]
                np.minimum(low[part], values.min(axis=0), out=low[part])
        wide = low[: self.bands * self.rows].reshape(self.bands, self.rows).astype(np.uint64)
        bands = ((wide + np.uint64(1)) * self.mix).sum(axis=1, dtype=np.uint64) ^ self.band
        bands ^= bands >> np.uint64(31)
        bands *= np.uint64(0xBF58476D1CE4E5B9)
        mixed = low ^ (low >> np.uint32(16))
        mixed *= np.uint32(0x85EBCA6B)
        nibbles = (mixed >> np.uint32(13)).astype(np.uint8) & np.uint8(15)
        return (nibbles[::2] | nibbles[1::2] << np.uint8(4)).view(np.int64), bands.view(np.int64)


def _sketch(words: int, size: int, bands: int, rows: int):
    def run(frames):
        shingle, sketch = Shingler(words), Sketcher(size, bands, rows)
        for frame in frames:
            out = []
            for doc, text in zip(frame.doc_id, frame.text, strict=True):
                own = shingle(text)
                if len(own):
                    name = xxhash.xxh3_128_digest(own.tobytes())
                    high, low = np.frombuffer(name, np.int64).tolist()
                    bits, keys = sketch(own)
                    out.append((doc, len(own), high, low, bits, keys))
                else:
                    out.append((doc, 0, None, None, None, None))
            yield pd.DataFrame(out, columns=["doc_id", "n_shingles", "high", "low", "bits", "bands"]).astype(
                {"high": "Int64", "low": "Int64"}
            )

    return run


def similar(first: np.ndarray, second: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets share at least `percent` of their union."""
    if 100 * min(len(first), len(second)) < percent * max(len(first), len(second)):
        return False
    both = len(np.intersect1d(first, second, assume_unique=True))
    return both > 0 and 100 * both >= percent * (len(first) + len(second) - both)


def _confirm(words: int, percent: int):
    """Keeps pairs whose full sets are similar. Rows of one `a` follow each other."""

    def run(frames):
        shingle = Shingler(words)
        text_a, set_a = None, None
        for frame in frames:
            keep = np.zeros(len(frame), bool)
            for i, (first, second) in enumerate(zip(frame.text_a, frame.text_b, strict=True)):
                if first != text_a:
                    text_a, set_a = first, shingle(first)
                set_b = shingle(second)
                keep[i] = similar(set_a, set_b, percent)
            yield frame.loc[keep, ["a", "b"]]

    return run


def differing(left: str, right: str, longs: int) -> Column:
    """How many of the packed four-bit minima differ."""
    total = F.lit(0)
    for i in range(longs):
        x = F.col(left)[i].bitwiseXOR(F.col(right)[i])
        x = x.bitwiseOR(F.shiftrightunsigned(x, 2))
        x = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(MASK))
        total = total + F.bit_count(x)
    return total


def _by_group(batches: Iterable[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """The columns of each (band, key, i, j) in turn, lists as matrices; the rows are sorted."""
    held: list[dict[str, np.ndarray]] = []

    def joined() -> dict[str, np.ndarray]:
        return held[0] if len(held) == 1 else {name: np.concatenate([part[name] for part in held]) for name in held[0]}

    before = None
    for batch in batches:
        if not len(batch):
            continue
        columns = {}
        for name, column in zip(batch.schema.names, batch.columns, strict=True):
            if pa.types.is_list(column.type):
                columns[name] = column.flatten().to_numpy().reshape(len(batch), -1)
            else:
                columns[name] = column.to_numpy(zero_copy_only=False)
        columns["row"] = np.arange(len(batch))
        keys = np.column_stack([columns[name] for name in ("band", "key", "i", "j")])
        cuts = [0, *(np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1).tolist(), len(batch)]
        for start, end in zip(cuts, cuts[1:]):
            if held and tuple(keys[start]) != before:
                yield joined()
                held = []
            before = tuple(keys[start])
            held.append({name: values[start:end] for name, values in columns.items()})
    if held:
        yield joined()


def _pairs(group: dict[str, np.ndarray], most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places of the two rows, and their differing minima, for each pair of a left and a right row
    from two components that is within `most` and shares no earlier band."""
    left, right = np.flatnonzero(group["left"]), np.flatnonzero(~group["left"])
    rep, component, band = group["rep"], group["component"], group["band"][0]
    main = component[right] == group["main"][right]
    out = [(np.empty(0, np.int64),) * 3]
    for at in range(0, len(left), 32):
        some = left[at : at + 32]
        tried = (component[some][:, None] != component[right]) & (main | (rep[some][:, None] < rep[right]))
        x, y = np.nonzero(tried)
        x, y = some[x], right[y]
        bits = group["bits"][x] ^ group["bits"][y]
        bits |= (bits >> 2) & np.int64(0x3333333333333333)
        bits |= (bits >> 1) & np.int64(0x5555555555555555)
        off = np.bitwise_count(bits & np.int64(MASK)).sum(axis=1, dtype=np.int64)
        near = off <= most
        x, y, off = x[near], y[near], off[near]
        first = (group["bands"][x] == group["bands"][y]).argmax(axis=1) == band
        out.append((x[first], y[first], off[first]))
    return tuple(np.concatenate(parts) for parts in zip(*out))


def _close(most: int):
    """Keeps the rows that are in a pair."""

    def run(batches):
        for group in _by_group(batches):
            x, y, _ = _pairs(group, most)
            at = np.union1d(x, y)
            if len(at):
                yield pa.RecordBatch.from_pydict({
                    name: pa.array(list(values[at])) if values.ndim == 2 else pa.array(values[at])
                    for name, values in group.items() if name != "row"
                })

    return run


def _forest(words: int, percent: int, most: int):
    """Links that join the components of a group's rows; pairs of the best estimate come first."""

    def run(batches):
        shingle = Shingler(words)
        for group in _by_group(batches):
            x, y, off = _pairs(group, most)
            root: dict[int, int] = {}

            def top(c: int) -> int:
                while (up := root.get(c, c)) != c:
                    root[c] = root.get(up, up)
                    c = up
                return c

            sets: dict[int, np.ndarray] = {}
            links = []
            component, rep, text = group["component"].tolist(), group["rep"].tolist(), group["text"]
            for place in np.argsort(off, kind="stable").tolist():
                a, b = int(x[place]), int(y[place])
                low, high = sorted((top(component[a]), top(component[b])))
                if low == high:
                    continue
                for row in (a, b):
                    if rep[row] not in sets:
                        sets[rep[row]] = shingle(text[row])
                if similar(sets[rep[a]], sets[rep[b]], percent):
                    root[high] = low
                    links.append((rep[a], rep[b]))
            if links:
                yield pa.RecordBatch.from_pydict({name: pa.array(ids, pa.int64()) for name, ids in zip("ab", zip(*links))})

    return run


def near_copies(
    documents: DataFrame, percent: int = 75, words: int = 5, size: int = 256, bands: int = 32, rows: int = 4,
    margin: float = 0.16, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    Documents are linked when 100 * |intersection| >= percent * |union| of their shingles; a
    component is named by its smallest id, which is kept.

    1. One scan makes a sketch per document: `size` minima, of which four bits each are kept,
       and one hash for each band of `rows` minima. Equal sets become one representative.
       Two sets of similarity 0.75 share no band of four with probability 5e-6.
    2. Buckets of two and three bands at once hold very similar sets, those of one band the
       rest. In each, every member is compared with one leader. The packed bits estimate the
       similarity, corrected for chance agreement (1 in 16); pairs whose estimate is within
       `margin` of the limit, 5.7 standard deviations, are confirmed on full sets: all of the
       fine buckets, and each member's best of the others.
    3. Buckets that still hold several components compare the members outside their leader's
       component with all others: chunks of the one side meet chunks of the other in a task,
       where a pair inside a component is skipped, the best estimates are confirmed first, and
       each link joins its components, so that a task gives fewer links than it has members. A
       pair counts in its first shared bucket only. Rows that no estimate brings near another
       leave before the texts come; the rows of a bucket grow with the chunks it has.

    Null or empty text, or no words: no shingles, a component of its own. Null id: left out.
    Rows that repeat an id stand for one document that holds all their sets. No documents: no
    rows.
    """
    docs = texts_of(documents, id_col, text_col)
    longs = size // 16
    # agreement = 1/16 + 15/16 * similarity
    most = int(size - size * (1 + 15 * (percent / 100 - margin)) / 16)
    sketch = stored(docs.mapInPandas(_sketch(words, size, bands, rows), SKETCH), "sketch")
    classes = sketch.where("n_shingles > 0").groupBy("high", "low").agg(F.min("doc_id").alias("rep"))
    reps = stored(
        sketch.withColumnRenamed("doc_id", "rep").join(classes, ["high", "low", "rep"], "left_semi").select("rep", "n_shingles", "bits", "bands"),
        "representatives",
    )

    # Key 0..bands-1: one band; -1: three bands together; -2: two.
    fine = [F.struct(F.lit(-k).alias("band"), F.xxhash64(F.lit(i), *[F.col("bands")[i + j] for j in range(4 - k)]).alias("key"))
            for k in (1, 2) for i in range(0, bands - 4 + k + 1, 4 - k)]
    single = F.transform("bands", lambda key, i: F.struct(i.alias("band"), key.alias("key")))
    held = reps.select("rep", F.explode(F.concat(single, F.array(*fine))).alias("k")).select("rep", "k.band", "k.key")
    full = held.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("rep").alias("leader")).where("n > 1").drop("n")
    shared = stored(held.join(full, ["band", "key"]), "buckets")
    bits = reps.join(shared.select("rep").distinct(), "rep", "left_semi")
    texts = stored(
        docs.join(shared.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi"), "candidates"
    )

    def confirmed(pairs: DataFrame) -> DataFrame:
        b = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
        a = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
        return pairs.join(b, "b").join(a, "a").mapInPandas(_confirm(words, percent), "a long, b long").distinct()

    pairs = shared.where("rep <> leader").groupBy(F.col("leader").alias("a"), F.col("rep").alias("b")).agg(F.min("band").alias("band"))
    stars = (
        pairs.join(bits.select(F.col("rep").alias("a"), F.col("bits").alias("bits_a")), "a")
        .join(bits.select(F.col("rep").alias("b"), F.col("bits").alias("bits_b")), "b")
        .withColumn("off", differing("bits_a", "bits_b", longs)).where(F.col("off") <= most).select("a", "b", "band", "off")
    )
    best = stars.groupBy("b").agg(F.min("off").alias("least"))
    tried = stored(stars.join(best, "b").where("band < 0 OR off = least").select("a", "b"), "stars")
    links = stored(confirmed(tried), "links")

    joined = components(links)
    named = shared.where("band >= 0").join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(
        "band", "key", "leader", "rep", F.coalesce("component", "rep").alias("component")
    )
    mixed = named.groupBy("band", "key").agg(
        F.min("component").alias("low"), F.max("component").alias("high"),
        F.min(F.when(F.col("rep") == F.col("leader"), F.col("component"))).alias("main"),
    ).where("low <> high").select("band", "key", "main")
    members = named.join(mixed, ["band", "key"]).join(bits, "rep").withColumn("apart", F.expr("component <> main"))

    def chunks(rows: Column, shingles: Column) -> Column:
        return F.greatest(F.ceil(rows / CHUNK_ROWS), F.ceil(shingles / CHUNK_SHINGLES), F.lit(1))

    sizes = members.groupBy("band", "key").agg(
        chunks(F.count("*"), F.sum("n_shingles")).alias("all"),
        chunks(F.count_if("apart"), F.sum(F.when(F.col("apart"), F.col("n_shingles")))).alias("few"),
    )
    dealt = members.join(sizes, ["band", "key"])
    place = lambda n: F.pmod(F.xxhash64("rep"), n)
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    group, rest = ["band", "key", "i", "j"], ["rep", "component", "main", "bits", "bands"]
    left = dealt.where("apart").select("band", "key", place(F.col("few")).alias("i"), every("all").alias("j"), F.lit(True).alias("left"), *rest)
    right = dealt.select("band", "key", every("few").alias("i"), place(F.col("all")).alias("j"), F.lit(False).alias("left"), *rest)
    both = left.union(right)
    close = both.repartition(*group).sortWithinPartitions(*group).mapInArrow(_close(most), both.schema)
    whole = close.join(texts.withColumnRenamed("doc_id", "rep"), "rep")
    forest = whole.repartition(*group).sortWithinPartitions(*group).mapInArrow(_forest(words, percent, most), "a long, b long")
    joined = components(links.union(stored(forest, "links")))

    resolved = classes.join(joined.withColumnRenamed("node", "rep"), "rep", "left").select(
        "high", "low", F.coalesce("component", "rep").alias("component_id")
    )
    return sketch.select("doc_id", "n_shingles", "high", "low").join(resolved, ["high", "low"], "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"),
        (F.coalesce("component_id", "doc_id") == F.col("doc_id")).alias("kept"),
    )
