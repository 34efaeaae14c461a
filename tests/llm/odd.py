"""Small tables with everything a table should not have."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long,"
    " row string, key string, did long, node long, digest string, score double"
)
LONG = " ".join(f"word{i % 977}" for i in range(40_000))


def documents(spark, rows):
    """Rows of ``(doc_id, text, lang, source)`` with columns named like the operators' own."""
    full = [(*r, None if r[1] is None else len(r[1]), "x", "y", 7, 8, "z", 0.5) for r in rows]
    return spark.createDataFrame(full, SCHEMA)


def odd_rows():
    """Nulls in every column, empty and long texts, repeated rows, copies, equal ids, no letters."""
    rng = random.Random(5)
    vocabulary = [f"{a}{b}" for a in "stone river cloud ember".split() for b in range(40)]

    def prose(n):
        return " ".join(rng.choice(vocabulary) for _ in range(n))

    base = prose(300)
    words = base.split()
    near = " ".join([*words[:150], "changed", *words[151:]])
    apart = " ".join(words[:100] + prose(200).split())
    return [
        (1, base, "en", "a"),
        (2, base, "en", "a"),
        (2, base, "en", "a"),
        (3, near, "en", "b"),
        (4, apart, None, None),
        (5, None, "en", "a"),
        (6, "", "fr", "b"),
        (7, " \t\n ", "fr", None),
        (8, "12345 ... !!", "fr", "b"),
        (9, LONG, "en", "c"),
        (10, "two words", "fr", "c"),
        (11, "Two Words É \U0001f600", None, "c"),
        (None, base, "en", "a"),
        (None, "alone without an id here", "en", None),
        (None, None, None, None),
        (12, "one\ntwo\none\n\none", "en", "a"),
        (13, LONG, "en", "c"),
    ]


def key(value):
    return (value is not None, value)
