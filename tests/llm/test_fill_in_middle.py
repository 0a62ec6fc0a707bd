"""Fill-in-middle examples against a plain rewrite of the rules."""

import hashlib
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm.fill_in_middle import RankIndex, boundaries, fill_in_middle, restored

TOKEN = re.compile(r"[A-Za-z]+|[^A-Za-z]")
ODD = ["", "a", "ab c", "é🙂ab12 cd\x00\n", "x" * 70_000 + " " * 70_000 + "y z " * 30_000, "<<S", "a <P> b", "ab<S", "S><M"]


def plain(doc_id, text):
    tokens = TOKEN.findall(text)
    h = [int(hashlib.sha256(f"1:{doc_id}".encode()).hexdigest()[i : i + 8], 16) for i in (0, 8, 16, 24)]
    one, two = sorted((h[0] % (len(tokens) + 1), h[1] % (len(tokens) + 1)))
    prefix, middle, suffix = "".join(tokens[:one]), "".join(tokens[one:two]), "".join(tokens[two:])
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return doc_id, len(tokens), "plain", None, None, text
    form = "spm" if h[3] % 100 < 20 else "psm"
    output = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, len(tokens), form, len(prefix), len(middle), output


def test_fill_in_middle(spark, documents, nothing, texts):
    more = spark.createDataFrame([("o", 100 + i, ODD[i % len(ODD)], "en", 7, 8) for i in range(90)], documents.schema)
    rows = [(i, t or "") for i, t in texts if i is not None] + [(100 + i, ODD[i % len(ODD)]) for i in range(90)]
    out = fill_in_middle(documents.union(more))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted([plain(i, t) for i, t in rows], key=repr)
    back = out.select("doc_id", restored(F.col("output"), F.col("form")).alias("text")).collect()
    assert sorted(map(tuple, back)) == sorted(rows)
    assert {r.form for r in out.collect()} == {"plain", "psm", "spm"}
    assert fill_in_middle(nothing).count() == 0


@pytest.mark.parametrize("reach", [0, 3, 127, 1000])
@pytest.mark.parametrize("text", [*ODD, "ab " * 5000 + "q" * 100_000 + " ab" * 5000])
def test_the_index_gives_every_boundary(text, reach):
    ends = [0, *(m.end() for m in TOKEN.finditer(text))]
    assert boundaries(text).tolist() == ends
    index = RankIndex(boundaries(text), reach)
    assert np.abs(index.residuals.astype(int)).max() <= reach
    assert all(index[k] == ends[k] for k in range(0, len(ends), 1 + len(ends) // 2000))


def test_even_offsets_are_one_segment():
    assert len(RankIndex(np.arange(0, 1_000_000, 3)).first) == 1
