from __future__ import annotations

import hashlib
import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from starmart.llm.substrings import LENGTH, anchors, digest, remove_repeats, sliding_minimum
from tests.llm import corpus


def brute(texts: list[str | None]):
    raws = [(t or "").encode() for t in texts]
    seen: dict[bytes, int] = {}
    for raw in raws:
        for k in range(len(raw) - LENGTH + 1):
            seen[raw[k : k + LENGTH]] = seen.get(raw[k : k + LENGTH], 0) + 1
    out = []
    for raw in raws:
        gone = np.zeros(len(raw), dtype=bool)
        for k in range(len(raw) - LENGTH + 1):
            if seen[raw[k : k + LENGTH]] > 1:
                gone[k : k + LENGTH] = True
        kept = bytes(np.frombuffer(raw, dtype=np.uint8)[~gone])
        spans = int(np.count_nonzero(np.diff(np.concatenate([[0], gone.astype(int)])) == 1))
        out.append((len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


def test_against_brute_force(spark):
    rng = random.Random(3)
    passage = corpus.words(rng, 60)
    texts = [corpus.words(rng, 30) + " " + passage + " " + corpus.words(rng, 20) for _ in range(12)]
    texts += [passage[:LENGTH], passage[5 : LENGTH + 4], "=" * 700, "ab" * 300, "ä" * 150, "x" * 199, "x" * 200, "y" * 201]
    cut = passage.replace(passage[150], "#")
    texts += [cut, cut + passage, passage[:260] + cut[:260], None, "", corpus.words(rng, 3000), *[texts[0]] * 3]
    rows = [(i, t, "r", "b") for i, t in enumerate(texts)] + [(0, texts[0], "r", "b"), (None, passage, "r", "b")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, row string, bucket string")
    got = digest(remove_repeats(docs.repartition(5))).collect()
    wanted = brute([r[1] for r in rows])
    assert sorted((r["doc_id"] or -1, *tuple(r)[1:]) for r in got) == sorted((r[0] or -1, *w) for r, w in zip(rows, wanted, strict=True))


def test_given_corpus_and_empty_table(spark):
    docs = corpus.documents(spark)
    rows = docs.collect()
    got = digest(remove_repeats(docs)).collect()
    wanted = brute([r["text"] for r in rows])
    assert sorted(tuple(r)[1:] for r in got) == sorted(wanted)
    assert remove_repeats(corpus.empty(spark)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 9), min_size=1, max_size=60), st.integers(1, 20))
def test_sliding_minimum(values, width):
    if width <= len(values):
        got = sliding_minimum(np.array(values, dtype=np.uint64), width)
        assert got.tolist() == [min(values[i : i + width]) for i in range(len(values) - width + 1)]


def test_every_string_has_one_anchor():
    raw = np.frombuffer(corpus.words(random.Random(1), 500).encode(), dtype=np.uint8)
    _, _, low, high, strings = anchors(raw)
    assert low[0] == 0 and high[-1] == strings.size - 1 == raw.size - LENGTH and (low[1:] == high[:-1] + 1).all()
