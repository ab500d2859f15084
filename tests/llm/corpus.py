"""Small tables with every awkward case: nulls, blanks, ties, repeated rows, long texts, clashing columns."""

from __future__ import annotations

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, n string, size string"


def words(rng: random.Random, n: int) -> str:
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(n))


def documents(spark, seed: int = 1, rows: int = 60):
    """Columns named like those that operators use inside come along."""
    rng = random.Random(seed)
    texts = [words(rng, rng.randint(0, 120)) for _ in range(rows)]
    texts += [None, "", " \n\t ", "one", "one", words(rng, 20_000)]
    base = words(rng, 100)
    near = base.split()
    near[50] = "changed"
    texts += [base, base, " ".join(near), base.upper(), base + " tail"]
    made = [(i, t, "en", f"s{i % 4}" if i % 5 else None, 0, "r", "n", "z") for i, t in enumerate(texts)]
    made += [made[3], made[3], (None, base, None, None, None, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(made, SCHEMA)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
