"""Small tables with every awkward row: nulls, empty and long texts, repeats, clashing columns."""

import pytest

LONG = " ".join(f"word{i % 97} part{i}" for i in range(30_000))
PROSE = "The quick brown fox jumps over the lazy dog while seven wizards make toxic brew tonight again"
TEXTS = [
    None,
    "",
    "   \n\t ",
    "\n\n",
    PROSE,
    PROSE,
    PROSE.upper(),
    PROSE + " and so on",
    "a",
    "naïve café \U0001F600 中文 text",
    LONG,
    LONG + " end",
    "mail me at joe@example.com or call +1 (803) 555-5351, host 10.0.0.1, card 4111 1111 1111 1111",
]


@pytest.fixture(scope="session")
def awkward(spark):
    """Documents with repeated rows, repeated and null ids, and columns named like the operators' own."""
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(TEXTS)]
    rows += [rows[4], rows[4], (5, "another text under an old id", "en", "s", 1), (None, PROSE, None, None, None), (None, None, None, None, None)]
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    clashing = ["id", "node", "n", "part", "key", "group", "ids", "label", "score", "toxic", "item_id", "shard"]
    wide = [(*r, *range(len(clashing))) for r in rows]
    kinds = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` long" for c in clashing)
    return spark.createDataFrame(wide, kinds).repartition(3), [dict(zip(names, r)) for r in rows]


@pytest.fixture(scope="session")
def nothing(awkward):
    return awkward[0].limit(0)
