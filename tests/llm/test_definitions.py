"""The two trained models against plain definitions: tf-idf vectors and centroids in dictionaries, a Gaussian by its formula."""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pytest

from starmart.llm import langid, quality
from starmart.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


def mixed(value: int, multiplier: int) -> int:
    return value * multiplier % 2**32


def plain_grams(text: str) -> Counter:
    """Buckets of the n-grams of letters, one letter after the other."""
    letters = []
    for letter in text.lower():
        point = 32 if ord(letter) < 128 and not "a" <= letter <= "z" else ord(letter)
        if point != 32 or not letters or letters[-1] != 32:
            letters.append(point)
    first, second, third = (int(m) for m in langid.MULTIPLIERS)
    codes = [c ^ c >> 15 for c in (mixed(p, first) for p in letters)]
    out = Counter(c >> 21 for c in codes)
    pairs = [(mixed(a, second) + b) % 2**32 for a, b in zip(codes, codes[1:])]
    out.update(mixed(p, first) >> 21 for p in pairs)
    out.update(mixed((mixed(p, third) + c) % 2**32, first) >> 21 for p, c in zip(pairs, codes[2:]))
    return out


def test_languages_by_plain_vectors(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = [(r["doc_id"], r["text"] or "", r["lang"]) for r in docs.collect()]
    train = [(i, t, lang) for i, t, lang in rows if lang is not None and zlib.crc32(str(i).encode()) % 4 != 2]
    held = Counter(bucket for _, t, _ in train for bucket in plain_grams(t))
    idf = {b: np.log((1 + len(train)) / (1 + n)) + 1 for b, n in held.items()}
    most = np.log(1 + len(train)) + 1

    model = langid.fit(docs)
    assert np.allclose(model.idf, [idf.get(b, most) for b in range(langid.BUCKETS)])
    assert np.allclose(np.linalg.norm(model.centres, axis=1), 1) and set(model.languages) == {lang for _, _, lang in train}
    found = {r["doc_id"]: r for r in langid.predict(docs, model).collect()}
    for doc_id, text, _ in rows:
        weights = {b: np.log1p(n) * idf.get(b, most) for b, n in plain_grams(text).items()}
        length = np.sqrt(sum(w * w for w in weights.values()))
        cosines = [sum(w * centre[b] for b, w in weights.items()) / length if length else 0.0 for centre in model.centres]
        r = found[doc_id]
        if not any(map(str.isalpha, text)):
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        best = max(cosines)
        near = {model.languages[j] for j, c in enumerate(cosines) if c > best - 1e-9}
        assert r["lang_pred"] in near and r["score"] == pytest.approx(min(1.0, max(0.0, best)), abs=1e-9)


def test_quality_by_the_density_of_a_gaussian(spark):
    docs, labels = (spark.read.parquet(f"{FOLDER}/{name}.parquet") for name in ("documents", "labels"))
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    stats = {i: np.array(quality.statistics(t)) for i, t in texts.items()}
    known = [(stats[r["doc_id"]], r["quality"]) for r in labels.collect() if r["doc_id"] in stats and r["quality"] in (0, 1) and zlib.crc32(str(r["doc_id"]).encode()) % 5]
    groups = [np.array([x for x, y in known if y == label]) for label in (0, 1)]
    spreads = [np.cov(g.T, bias=True) for g in groups]
    pooled = sum(len(g) * s for g, s in zip(groups, spreads)) / len(known)

    def log_density(x, label):
        spread = 0.7 * spreads[label] + 0.3 * pooled
        spread = 0.95 * spread + 0.05 * np.diag(np.diag(spread)) + 1e-6 * np.eye(len(x))
        off = x - groups[label].mean(axis=0)
        return np.log(len(groups[label]) / len(known)) - 0.5 * off @ np.linalg.solve(spread, off) - 0.5 * np.linalg.slogdet(spread)[1]

    found = {r["doc_id"]: r for r in QUERIES["op9_quadratic_discriminant"](spark, FOLDER).collect()}
    assert set(found) == set(texts)
    for doc_id, x in stats.items():
        odds = np.clip(log_density(x, 1) - log_density(x, 0), -500, 500)
        assert found[doc_id]["score"] == pytest.approx(1 / (1 + np.exp(-odds)), abs=1e-6)
        assert found[doc_id]["predicted"] == int(found[doc_id]["score"] >= 0.3)
        assert found[doc_id]["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
