"""License scans with ordered signature rules, on DataFrame functions alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import texts_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
GAP = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
MARK = "\x02"
LEFT, RIGHT = 8, 12

# Phrases that count as base, and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}

# Signatures: label, keyword, and what follows the keyword, as patterns over lower-case words
# parted by single spaces. Keywords that are common words need their continuation.
SIGNATURES = [
    ("gpl", "gnu", " general public license"),
    ("gpl", "gnu", " gpl"),
    ("gpl", "gpl", ""),
    ("lgpl", "gnu", " (?:lesser|library) general public license"),
    ("lgpl", "lgpl", ""),
    ("agpl", "gnu", " affero general public license"),
    ("agpl", "agpl", ""),
    ("gfdl", "gnu", " free documentation license"),
    ("gfdl", "gfdl", ""),
    ("apache", "apache", " (?:software )?license"),
    ("apache", "apache", " 2 0"),
    ("mit", "mit", " license"),
    ("mit", "mit", " style license"),
    ("mit", "mit", " type license"),
    ("mit", "expat", " license"),
    ("x11", "x11", " license"),
    ("bsd", "bsd", "(?: [234] clause)?(?: style)? license"),
    ("bsd", "bsd", " [0234] clause"),
    ("isc", "isc", " license"),
    ("mpl", "mozilla", " public license"),
    ("mpl", "mpl", ""),
    ("epl", "eclipse", " public license"),
    ("epl", "eclipse", " distribution license"),
    ("cddl", "common", " development and distribution license"),
    ("cddl", "cddl", ""),
    ("cpl", "common", " public license"),
    ("artistic", "artistic", " license"),
    ("zlib", "zlib", "(?: libpng)? license"),
    ("boost", "boost", " software license"),
    ("python", "python", " software foundation license"),
    ("postgresql", "postgresql", " license"),
    ("ofl", "sil", " open font license"),
    ("odbl", "open", " (?:data commons|database) (?:open database )?license"),
    ("eupl", "european", " union public licen[cs]e"),
    ("eupl", "eupl", ""),
    ("unlicense", "unlicense", ""),
    ("wtfpl", "wtfpl", ""),
    ("public-domain", "public", " domain(?: dedication)?"),
    ("cc0", "cc0", ""),
    ("cc0", "cc", " zero"),
    ("cc-by", "cc", " by"),
    ("cc-by-nc", "cc", " by nc"),
    ("cc-by-nd", "cc", " by nd"),
    ("cc-by-sa", "cc", " by sa"),
    ("cc-by-nc-nd", "cc", " by nc nd"),
    ("cc-by-nc-sa", "cc", " by nc sa"),
    ("cc-by", "creative", " commons attribution(?: license)?"),
    ("cc-by-nc", "creative", " commons attribution non ?commercial"),
    ("cc-by-nd", "creative", " commons attribution no ?deriv(?:atives|s)?"),
    ("cc-by-sa", "creative", " commons attribution share ?alike"),
    ("proprietary", "all", " rights reserved"),
    ("proprietary", "proprietary", " and confidential"),
    ("warranty-disclaimer", "without", " warrant(?:y|ies) (?:of any kind|or conditions of any kind)"),
    ("warranty-disclaimer", "provided", " as is without warranty"),
]

VERSION = r"(?: (?:version|v))? v?\d+(?: \d+){0,2}"
# Frames around a signature, in order of priority: before, behind, weight.
FRAMES = [
    ("spdx licen[cs]e identifier ", f"(?:{VERSION})?(?: only| or later)?", 1.0),
    (r"(?:licensed|released|distributed|published|available|provided) under (?:the |an? )?(?:terms of (?:the )?)?", f"(?:{VERSION})?(?: license)?", 1.0),
    (r"(?:subject to|accordance with|governed by|terms of) (?:the )?", f"(?:{VERSION})?", 0.95),
    ("", f"{VERSION}(?: or (?:any |at your option any )?later(?: version)?)?", 0.9),
    ("", "", 0.8),
]
COMMON = {"mit", "all", "public", "without", "provided", "common", "open", "european", "x11", "isc", "sil", "python",
          "boost", "eclipse", "creative", "cc", "artistic", "bsd", "zlib"}


def rules() -> list[tuple[str, str, str, int, float]]:
    """(keyword, pattern, label, priority, weight): each signature in each frame. MARK stands
    before the keyword, whose place in the text a match has to contain."""
    out = []
    for rank, (before, behind, weight) in enumerate(FRAMES):
        for label, keyword, rest in SIGNATURES:
            out.append((keyword, f"(?<= ){before}{MARK}{keyword}{rest}{behind}(?= )", label, len(FRAMES) - rank, weight))
    return out


def gate() -> str:
    """A pattern over raw text that all texts with a signature have: the keyword, and for
    common words also the word behind it."""
    found = {keyword if keyword not in COMMON else f"{keyword}{GAP}{_first(rest)}" for _, keyword, rest in SIGNATURES}
    return rf"(?i)(?<![^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F])(?:{'|'.join(sorted(found))})"


def _first(rest: str) -> str:
    """The letters with which the word behind a keyword starts, where they are plain."""
    plain = rest[1:].split(" ")[0]
    return "" if any(c in plain for c in "[](?:|") else plain


def _table() -> Column:
    """keyword -> its rules, as one constant."""
    by: dict[str, list[Column]] = {}
    for keyword, pattern, label, priority, weight in rules():
        by.setdefault(keyword, []).append(
            F.struct(F.lit(pattern).alias("pattern"), F.lit(label).alias("label"), F.lit(priority).alias("priority"), F.lit(weight).alias("weight"))
        )
    return F.create_map(*[x for k, v in by.items() for x in (F.lit(k), F.array(*v))])


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _window(words: Column, at: Column) -> Column:
    """The words around word `at` (from 0), its place marked, with a space at either end."""
    low = F.greatest(at - LEFT, F.lit(0))
    return F.concat(
        F.lit(" "), F.array_join(F.slice(words, low + 1, at - low), " "), F.when(at > low, F.lit(" ")).otherwise(F.lit("")),
        F.lit(MARK), F.array_join(F.slice(words, at + 1, F.lit(RIGHT)), " "), F.lit(" "),
    )


def scan_licenses(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word, base_labels,
    labels, score.

    Words are lower-cased (A-Z) runs of digits, letters and characters beyond ASCII. A base
    place is where the words of a base phrase follow each other. A scan without a shuffle,
    and without Python on executors:

    1. A pattern of keywords lets the few texts pass that can hold a signature.
    2. At each keyword its own rules are tried on the words around it, so the work grows with
       the text and not with its square.
    3. Detections are sorted by start, then longest, then priority; one that ends within an
       earlier one is suppressed. The labels of the rest join the base labels, and the score
       is the largest weight among them, at least 0.8 where a base phrase stands.

    Null or empty text: no words, no labels, score 0. Null id: left out. Repeated rows: a row
    each. No documents: no rows.
    """
    docs = texts_of(documents, id_col, text_col)
    passed = F.col("text").rlike(gate())
    lowered = F.translate("text", UPPER, LOWER)
    base = docs.select(
        "doc_id", F.regexp_count("text", F.lit(WORD)).cast("long").alias("n_words"),
        F.when(passed, F.regexp_extract_all(lowered, F.lit(f"({WORD})"), F.lit(1))).otherwise(F.array().cast("array<string>")).alias("words"),
    ).withColumn("line", F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")))

    phrases = "|".join(BASE)
    marked = F.regexp_replace("line", f"(?<= )({phrases})(?= )", f"{MARK}$1")
    tail = F.substring_index("marked", MARK, -1)
    head = F.substring_index("marked", MARK, 1)
    found = base.withColumn("marked", marked).withColumn(
        "places", F.regexp_extract_all("marked", F.lit(f"{MARK}({phrases})"), F.lit(1))
    )
    labels = F.create_map(*[F.lit(x) for pair in BASE.items() for x in pair])

    table = _table()
    keywords = F.array(*[F.lit(k) for k in sorted({r[0] for r in rules()})])
    spots = F.filter(
        F.transform("words", lambda w, i: F.struct(w.alias("word"), i.alias("at"))), lambda s: F.array_contains(keywords, s["word"])
    )
    seen = F.transform(spots, lambda s: F.struct(s["word"].alias("word"), s["at"].alias("at"), _window(F.col("words"), s["at"]).alias("around")))

    def detections(s: Column) -> Column:
        tried = F.transform(
            F.element_at(table, s["word"]),
            lambda r: F.struct(r.alias("r"), F.call_function("regexp_extract", s["around"], r["pattern"], F.lit(0)).alias("match")),
        )
        return F.transform(
            F.filter(tried, lambda t: t["match"] != ""),
            lambda t: F.struct(
                (s["at"] - _spaces(F.substring_index(t["match"], MARK, 1))).alias("start"),
                (-(s["at"] + _spaces(F.substring_index(t["match"], MARK, -1)) + 1)).alias("minus_end"),
                (-t["r"]["priority"]).alias("minus_priority"), t["r"]["label"].alias("label"), t["r"]["weight"].alias("weight"),
            ),
        )

    start = F.struct(
        F.lit(0).alias("end"), F.array().cast("array<string>").alias("labels"), F.lit(0.0).alias("score")
    )
    scanned = F.aggregate(
        F.array_sort(F.flatten(F.transform("seen", detections))), start,
        lambda s, d: F.when(-d["minus_end"] <= s["end"], s).otherwise(
            F.struct(
                (-d["minus_end"]).alias("end"), F.array_union(s["labels"], F.array(d["label"])).alias("labels"),
                F.greatest(s["score"], d["weight"]).alias("score"),
            )
        ),
    )
    n = F.size("places")
    return (
        found.withColumn("seen", seen)
        .withColumn("scan", scanned)
        .withColumn("own", F.array_sort(F.array_distinct(F.transform("places", lambda p: F.element_at(labels, p)))))
        .select(
            "doc_id", "n_words", n.cast("long").alias("n_base"),
            F.when(n > 0, _spaces(head) - 1).cast("long").alias("first_word"),
            F.when(n > 0, _spaces(F.col("line")) - _spaces(tail) - 1).cast("long").alias("last_word"),
            F.array_join("own", ",").alias("base_labels"),
            F.array_join(F.array_sort(F.array_union("own", F.col("scan.labels"))), ",").alias("labels"),
            F.greatest(F.col("scan.score"), F.when(n > 0, F.lit(0.8)).otherwise(F.lit(0.0))).alias("score"),
        )
    )
