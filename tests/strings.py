"""Random texts over an alphabet that holds every awkward character."""

import random

ALPHABET = [
    "a", "b", "Z", "_", "9", ".", ":", "-", "(", ")", "{", "}", " ", "  ", "\t", "\n", "\n", "\r", "\r\n", "\x0b", "\x0c",
    "\x1c", "\x1d", "\x1e", "\x1f", "\x85", "\xa0", "\xe9", "\xdf", "cir.func", "llvm.func", "@main", "kernel",
    "// -----// IR Dump After ", "x: y (m)",
    # line and paragraph separator, em space, narrow no-break space, ideographic space
    *map(chr, (0x2028, 0x2029, 0x2003, 0x202F, 0x3000)),
    # three- and four-byte characters, one of them a letter, a combining accent, an Arabic digit, a Roman numeral
    *map(chr, (0x4E2D, 0x1F600, 0x1D400, 0x301, 0x663, 0x2167)),
]


def texts(count, longest=30, seed=7, alphabet=ALPHABET):
    rng = random.Random(seed)
    out = ["", "\n", "\r\n", "a", "\r", chr(0x2028), "\x85"]
    while len(out) < count:
        out.append("".join(rng.choice(alphabet) for _ in range(rng.randrange(longest))))
    return out


def column(spark, values, expressions):
    """Evaluate named expressions over one string column ``t``, in input order."""
    rows = spark.createDataFrame(list(enumerate(values)), "i int, t string").repartition(4)
    return [r.asDict() for r in rows.select("i", *[e.alias(n) for n, e in expressions.items()]).orderBy("i").collect()]
