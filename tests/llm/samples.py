"""Small tables with every kind of row the operators must take."""

import random

CLASHES = (
    "score kept llr fp component_id row number size target taken id q n word key held_out lang_pred path part "
    "window place index first_id _id _first is_trusted base begin stop start blocks"
).split()

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed: int, n: int, parts: str = "ta ri no se lu ma pe ko di va") -> str:
    """Made-up words, the same for a seed."""
    rng = random.Random(seed)
    return " ".join("".join(rng.choices(parts.split(), k=rng.randint(1, 3))) for _ in range(n))


def documents(spark, rows, clashes=True):
    """``documents`` of (doc_id, text, lang, source) with columns that operators use themselves."""
    df = spark.createDataFrame([(i, t, la, s, None if t is None else len(t)) for i, t, la, s in rows], DOCUMENT)
    return df.selectExpr("*", *[f"'x' AS {c}" for c in CLASHES]) if clashes else df


def odd_rows():
    """Nulls, empty and blank texts, a very long one, one very long word, copies, ties, a null id."""
    text = prose(1, 80)
    return [
        (1, None, None, None),
        (2, "", "en", "a"),
        (3, " \t\n\x0b\x0c\r ", "en", "a"),
        (4, text, "en", "a"),
        (4, text, "en", "a"),
        (5, text, "xx", "b"),
        (6, prose(2, 40_000), "en", "b"),
        (7, "x" * 50_000, "en", None),
        (None, prose(3, 90), "en", "c"),
        (8, "Ünï çödé   😀 ɐ b " * 30, "fr", "c"),
        (9, "one two", "en", "c"),
    ]
