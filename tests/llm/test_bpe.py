"""Token counts against the library and against merging by definition."""

from __future__ import annotations

import random
from collections import Counter

import public_tokenizers
import pytest

from starmart.llm import bpe
from tests.llm.corpus import documents, empty

PATH = public_tokenizers.path("byte_bpe_50k.json")
AWKWARD = [
    None, "", " ", "\n\n  \t x", "don't I'LL we've", "a" * 5000, "ab" * 3000, "   　x y", "1234567 ٥½①",
    "<|endoftext|>", "a<|endoftext|><|endoftext|> b", "<|endoftext| >", "\u0000\x1c\x1d\x85", "\U0001f600‍\U0001f525 é",
    "՘࢏꟎ ꟎abc \U00010940\U00010941x", "你好世界" * 50, "'s 's's’s", "İǅ ẞ",
]


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(PATH)


def test_awkward_and_random_texts_count_as_the_library_says(library):
    counter, rng = bpe.Counter(bpe.read_merges(PATH)), random.Random(3)
    alphabet = "aeiou thnsr  .,'0123\n\téß中Ж\U0001f600՘꟎<|>endoftext"
    texts = AWKWARD + ["".join(rng.choices(alphabet, k=rng.randint(1, 300))) for _ in range(2000)]
    for text in texts:
        assert counter.count(text) == len(library.encode(text or "", add_special_tokens=False).ids), ascii(text)


def test_heap_and_list_merge_like_repeated_search():
    """Always the lowest rank, then the leftmost place, found anew each time."""
    rng = random.Random(5)
    pairs = {rng.randrange(6) << 32 | rng.randrange(6): 0 for _ in range(14)}
    pairs = {pair: rank for rank, pair in enumerate(pairs)}
    merges = bpe.Merges("", tuple(range(256)), pairs, tuple(rng.randrange(6) for _ in pairs), ())
    for _ in range(500):
        symbols = [rng.randrange(6) for _ in range(rng.randint(2, 40))]
        plain = list(symbols)
        while True:
            ranked = [(pairs[a << 32 | b], i) for i, (a, b) in enumerate(zip(plain, plain[1:])) if a << 32 | b in pairs]
            if not ranked:
                break
            rank, i = min(ranked)
            plain[i : i + 2] = [merges.made[rank]]
        assert bpe.merged_length(list(symbols), merges) == len(plain)


def test_long_texts_are_counted_piece_by_piece(library, monkeypatch):
    monkeypatch.setattr(bpe, "LISTED", 10)
    monkeypatch.setattr(bpe, "REMEMBERED", 7)
    counter = bpe.Counter(bpe.read_merges(PATH))
    text = " ".join(f"word{i} and some other ones," for i in range(400))
    assert counter.count(text) == len(library.encode(text, add_special_tokens=False).ids)


def test_table(spark, library):
    docs = documents(spark)
    rows = docs.select("doc_id", "text").collect()
    wanted = []
    for doc_id, text in rows:
        n = len(library.encode(text or "", add_special_tokens=False).ids)
        wanted.append((doc_id, len((text or "").encode()), n, n > 1024))
    found = bpe.token_counts(docs, PATH)
    assert [f.dataType.simpleString() for f in found.schema] == ["bigint", "bigint", "bigint", "boolean"]
    assert Counter(map(tuple, found.collect())) == Counter(wanted)
    assert any(r[3] for r in wanted)
    assert bpe.token_counts(empty(spark), PATH).count() == 0


def test_other_kinds_of_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.read_merges(public_tokenizers.path("word_bpe_49k.json"))
