"""Documents with everything that goes wrong, and columns named like the operators' own."""

import random

VOCABULARY = [a + b for a in "ka lo mi nu re so ti va".split() for b in "n r s t l m".split()]
EXTRA = ("fp string, text_key int, anchor string, words array<int>, start int, score string,"
         " bucket int, order string, piece string, component_id string, n_chars bigint, lang string")
SCHEMA = f"doc_id bigint, text string, {EXTRA}"


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


def frame(spark, rows):
    extra = ("x", 1, None, [1], 2, "y", 3, "z", "p", "c", None, "en")
    return spark.createDataFrame([(i, t, *extra) for i, t in rows], SCHEMA)


LONG = prose("long", 60_000)
ODD_ROWS = [
    (0, prose(0, 120)),
    (1, None),
    (2, ""),
    (3, " \t\n\x0b "),
    (4, "one two three"),
    (5, prose(0, 120)),  # a copy of 0
    (5, prose(0, 120)),  # the row repeated
    (6, prose(6, 300)),
    (6, prose(66, 80)),  # the id repeated with another text
    (7, prose(6, 300).replace(" ", "\n", 40)),
    (8, prose(8, 40) + " " + prose(0, 60) + " " + prose(88, 40)),
    (9, "Öl ßtraße x y \U0001f600 <|im_end|> \\n"),
    (10, LONG),
    (None, prose(0, 120)),
    (None, None),
    (11, "\U0001f600" * 70),
]


def odd_docs(spark):
    return frame(spark, ODD_ROWS)


def no_docs(spark):
    return frame(spark, [])
