"""Awkward documents shared by the tests: nulls, empty and long texts, repeated rows, clashing
column names, no rows."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, n_tokens string, "
          "kept string, row long, run string, part int, `a.b` string")


def rows(n=60, seed=3):
    rng = random.Random(seed)
    words = "the of and thonre ereati’s it's élan straße 中文字 ٣½ 0042 <|endoftext|> don't x".split()
    marks = [" ", " ", " ", "  ", "\n", "\n\n", "\t", ", ", ". ", " ", "!?", " \n "]
    out = [(None, "null id", "en"), (None, None, None), (1, None, "en"), (2, "", "en"),
           (3, " ", "en"), (4, "word", None), (5, "same text", "en"), (5, "same text", "en"),
           (5, "another text of the same id", "fr"), (6, "same text", "en"),
           (7, "a" * 5000, "en"), (8, "中文字" * 1500, "zh"), (9, "\n \n\t \r\n", "en"),
           (-4, "negative id", "en"), (2 ** 62, "large id", "en")]
    for i in range(n):
        k = rng.choice([3, 30, 300])
        out.append((100 + i, "".join(rng.choice(words) + rng.choice(marks) for _ in range(k)), "en"))
    out.append((1000, " ".join(rng.choice(words) for _ in range(9000)), "en"))
    return [(d, t, x, "src0", 0, "clash", "clash", 1, "clash", 2, "clash") for d, t, x in out]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
