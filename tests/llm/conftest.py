"""Fixtures of the training-data tests."""


import pytest
from samples import prose


SCHEMA = "other string, doc_id long, text string, lang string, key long, bits int"


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text): copies, near-copies, shared passages, nulls, empty, short, long and odd texts."""
    base = prose(1, 300)
    words = base.split()
    near = [" ".join([*words[:k], "zzz", *words[k + 1 :]]) for k in (20, 150, 280)]
    shared = prose(2, 60)
    rows = [(i, prose(100 + i, 30 + 7 * i)) for i in range(12)]
    rows += [(20, base), (21, base), (22, base.replace(" ", "\n")), (23, base + "  "), (24, near[0]), (25, near[1]), (26, near[2])]
    rows += [(30, f"{prose(3, 40)} {shared} {prose(4, 30)}"), (31, f"{prose(5, 10)} {shared}"), (32, f"{shared} {shared}")]
    rows += [(40, None), (41, ""), (42, " \t\n"), (43, "one"), (44, "one"), (45, "ÄÖ ẞtraße naïve 中文 🙂🙂"), (46, "a" * 250), (47, "ab" * 300)]
    rows += [(50, prose(6, 9000)), (51, "x y\x0bz \x00 <|endoftext|> İΣ"), (52, "Licensed under the MIT License. MIT\n\nlicense, CC-BY 4.0; gnu general public license")]
    rows += [(60, "twice"), (60, "twice"), (None, "no id")]
    return rows


@pytest.fixture(scope="session")
def documents(spark, texts):
    """The texts between columns whose names the operators use inside."""
    return spark.createDataFrame([("o", i, t, "en", 7, 8) for i, t in texts], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)
