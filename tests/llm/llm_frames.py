"""Rows the tests share."""

import random

EDGES = [
    (9001, None), (9002, ""), (9003, " \t\n"), (9004, "one"), (9005, "x\ty\n z"), (9006, "ÀÉ ñ ß"), (None, "nobody's words here"),
    (None, None), (9007, "repeated row"), (9007, "repeated row"), (9008, "repeated id, first text"), (9008, "repeated id, second text"),
]


def prose(rng: random.Random, n: int, words: int = 400) -> list[str]:
    return [f"w{rng.randrange(words)}" for _ in range(n)]


def frame(spark, rows):
    """Documents with columns the operators must not trip over."""
    wide = [(i, t, "en", "s", 1.0, "x") for i, t in rows]
    return spark.createDataFrame(wide, "doc_id long, text string, lang string, source string, score double, row string").repartition(5)
