"""Small tables with the cases that every operator must stand: nulls, empty and long texts, ties, repeated rows, clashing names."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, n_chars long, _id long, _text string, mark string, chunk int, word string"


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice(["the", "of", "and"]) if rng.random() < 0.3 else f"w{rng.randrange(4000)}" for _ in range(n))


def rows() -> list[tuple]:
    rng = random.Random(4)
    passage, base = words(rng, 60), words(rng, 300)
    near = base.split()
    near[150] = "changed"
    texts = [
        None, "", "   \n\t ", "word", "Word", "a b", base, " ".join(near), base.replace(" ", "  "), base, passage,
        words(rng, 80) + " " + passage + " " + words(rng, 40), words(rng, 20) + "\n" + passage + "\n" + words(rng, 90),
        "same line here again\nother line\nsame line here again", "Same line here AGAIN\nlast", words(rng, 30) + "éü \U0001f642 " + passage,
        "x" * 9000, "x" * 9000 + "y", "é" * 700, "la " * 3000, words(rng, 9000), "don't <|endoftext|> it's    1234",
        "\x00nul\x00", "tail   sep\x1cword", *(words(rng, rng.randrange(1, 200)) for _ in range(40)),
    ]
    out = [(i * 3 + 1, t) for i, t in enumerate(texts)]
    out += [(None, "null id"), (None, base), (7, "other text of a repeated id"), out[6], out[6], (-5, passage), (2**52, "far")]
    rng.shuffle(out)
    return [(i, t, "en", None if t is None else len(t), 1, "clash", "clash", 2, "clash") for i, t in out]


def frame(spark, data=None, parts: int = 3):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(parts)


def order_key(row) -> tuple:
    return (row[0] is not None, row[0] or 0, (row[1] or "").encode())
