"""Small tables with the hard cases: nulls, empty and long texts, ties, repeats."""

import random

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, shard int, score double, row int"


def sentence(r: random.Random, n: int) -> str:
    return " ".join("".join(r.choice("abcdefghij") for _ in range(r.randint(2, 6))) for _ in range(n))


def documents(seed: int = 3, n: int = 60) -> list[tuple]:
    """Rows (doc_id, text, lang, source, n_chars and clashing columns)."""
    r = random.Random(seed)
    texts: list[str | None] = [sentence(r, r.randint(1, 120)) for _ in range(n)]
    texts += [None, "", " \t\n", "one", "one two", "ONE two", "x" * 30_000, " ".join(["tick"] * 5_000)]
    texts += [texts[0]] * 12 + [texts[1].replace(" ", "\t\n")] * 2  # copies, and copies but for white space
    long = sentence(r, 400).split()
    for i in range(10):  # near copies
        w = long[:]
        w[17 * i + 3] = "changed"
        texts.append(" ".join(w))
    texts += ["naïve café, 漢字 😀 ▁ <|endoftext|> don't", "\x00 odd \x1c bytes here"]
    rows = [(i, t, r.choice(["en", "de", None]), r.choice(["a", "a", "a", "b", None, ""]),
             None if t is None else len(t), 7, 0.5, 1) for i, t in enumerate(texts)]
    return rows + [rows[5], rows[5], (None, "no id", None, None, None, 1, 1.0, 1)]


def frame(spark, rows=None):
    return spark.createDataFrame(documents() if rows is None else rows, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
