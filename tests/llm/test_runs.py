"""Runs against their definition, and the query against plain Python over the contract."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from fractions import Fraction

import pytest

from starmart.llm import runs as R
from starmart.llm.queries import QUERIES
from tests.llm.corpus import SCHEMA, documents, empty

FOLDER = "/root/testdata/sf0.001"


def brute(words, exponent=4, least=6):
    """Every maximal stretch of every period; of one stretch the smallest period."""
    n, out = len(words), {}
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, exponent * q):
                out.setdefault((i, j + q), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in out.items())


def collapse(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_find_runs_by_definition():
    rng = random.Random(2)
    for _ in range(400):
        texts = []
        for _ in range(rng.randint(0, 5)):
            letters, n = rng.choice((1, 2, 3, 6)), rng.randint(0, 90)
            words = [b"%d" % rng.randrange(letters) for _ in range(n)]
            if n and rng.random() < 0.6:
                a = rng.randrange(n)
                p = rng.randint(1, (n - a) // 3 + 1)
                words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            texts.append(words)
        exponent, least = rng.choice((2, 3, 4, 7)), rng.choice((1, 6))
        assert R.runs_of(texts, exponent, least) == [brute(w, exponent, least) for w in texts]


def test_every_period_has_one_size_of_blocks_and_a_block_in_each_run():
    for exponent in (2, 3, 4, 9):
        periods = [q for level in range(12) for q in R.distances(level, exponent)]
        assert periods == list(range(1, len(periods) + 1))
        for level in range(12):
            assert all(2 * 2**level - 1 <= (exponent - 1) * q for q in R.distances(level, exponent))


def test_equal_fingerprints_of_other_words_are_no_run(monkeypatch):
    monkeypatch.setattr(R, "doubled", lambda prints, size: prints[:-size] * 0)
    rng = random.Random(4)
    words = [b"%d" % rng.randrange(3) for _ in range(200)] + [b"x", b"y"] * 9
    assert R.runs_of([words], 4, 6)[0] == brute(words)


def test_long_and_periodic_texts():
    for words in ([b"a"] * 50_000, [b"a", b"b"] * 20_000 + [b"c"], [b"%d" % (i % 997) for i in range(40_000)]):
        (run,) = R.runs_of([words], 4, 6)[0]
        assert run == (0, len(words) - (words[-1] == b"c"), {b"a": 1 if words[1] == b"a" else 2, b"0": 997}[words[0]])
    nested = ([b"a"] * 8 + [b"b"]) * 5
    assert R.runs_of([nested], 4, 6)[0] == brute(nested) and len(brute(nested)) == 6


def test_table(spark):
    docs = documents(spark)
    again = spark.createDataFrame(
        [(900, "go " * 9 + "on", None, None, None, "r", "n", "z"), (901, "x y " * 4, *[None] * 6), (901, "a\x0bb\xa0c " * 4, *[None] * 6)], SCHEMA
    )
    docs = docs.unionByName(again)
    found = R.collapse_runs(docs)
    assert found.columns == ["doc_id", "n_words", "text", "runs"]
    got = sorted(((r[0], r[1], r[2], [tuple(x) for x in r[3]]) for r in found.collect()), key=repr)
    wanted = []
    for doc_id, text in docs.select("doc_id", "text").collect():
        words = split(text)
        wanted.append((doc_id, len(words), collapse(words, brute(words)), brute(words)))
    assert got == sorted(wanted, key=repr)
    assert R.collapse_runs(empty(spark)).count() == 0
    with pytest.raises(ValueError):
        R.collapse_runs(docs, least_exponent=1)


def test_query(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    wanted = []
    for doc_id, text in docs:
        words = split(text)
        n, h = len(words), zlib.crc32(str(doc_id).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = brute(words)
        best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None,) * 3)
        milli = 1000 * best[1] // best[2] if runs else None
        lines = "".join(f"{a},{b},{c}\n" for a, b, c in runs)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (lines, collapse(words, runs))]
        wanted.append((doc_id, len(runs), *best, milli, *sha))
    found = QUERIES["op11_square_catching_runs"](spark, FOLDER)
    assert found.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert {f.dataType.simpleString() for f in found.schema} == {"bigint", "string"}
    assert sorted(map(tuple, found.collect())) == sorted(wanted)
    assert sum(r[1] > 0 for r in wanted) > 5
