from __future__ import annotations

import json
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from starmart.llm import simple8b, tokens
from starmart.llm.queries import word_tokenizer
from starmart.llm.tokens import LETTERS, WordEncoder, read_ids, read_index, token_digest, write_tokens
from tests.llm import corpus


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2**64 - 1) | st.integers(0, 40) | st.just(0), max_size=600), max_size=4))
def test_round_trip_of_any_integers(rows):
    lengths = np.array([len(r) for r in rows], dtype=np.int64)
    values = np.array([v for r in rows for v in r], dtype=np.uint64)
    words, per_block, blocks = simple8b.encode(values, lengths)
    assert per_block.sum() == words.size and blocks.sum() == per_block.size
    assert (simple8b.decode(words, per_block, lengths) == values).all()


def test_small_values_share_words():
    assert simple8b.encode(np.zeros(240, np.uint64), np.array([240]))[0].size == 4
    assert simple8b.encode(np.full(30, 1000, np.uint64), np.array([30]))[0].size == 5


@pytest.mark.parametrize("shards", [1, 5])
def test_files_hold_the_ids_of_whole_texts_in_order(spark, shards):
    from tokenizers import Tokenizer

    odd = ["ΟΔΟΣ. İx <|endoftext|>y don't é é a\x1cb ., .. A.B,", "가각 ſ ﬁ‍"]
    docs = corpus.documents(spark)
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(odd)], "doc_id long, text string")
    docs = docs.select("doc_id", "text", "row", "n").unionByName(extra, allowMissingColumns=True)
    index = read_index(spark, write_tokens(docs, word_tokenizer(), shards=shards))
    library = Tokenizer.from_file(word_tokenizer())
    start = 0
    rows = sorted(docs.collect(), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    got = sorted(token_digest(index).collect(), key=lambda r: r["start"])
    for row, made in zip(rows, got, strict=True):
        ids = [*library.encode(row["text"] or "", add_special_tokens=False).ids, 1]
        crc = zlib.crc32(np.array(ids, dtype="<u4").tobytes())
        assert tuple(made) == (row["doc_id"], start, len(ids), crc)
        start += len(ids)
    lists = {r["start"]: r["ids"] for r in read_ids(index).collect()}
    assert all(len(lists[r["start"]]) == r["n_tokens"] for r in got)


def test_empty_table(spark):
    path = write_tokens(corpus.empty(spark), word_tokenizer())
    assert token_digest(read_index(spark, path)).count() == 0


def library_ids(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(word_tokenizer())
    return [np.array(library.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes() for text in texts]


def test_certain_words_go_to_the_model_itself(monkeypatch):
    texts = ["The thé Über, ПРИВЕТ мир. OF!! the&&& a|b | 12.50 x_y ", "".join(LETTERS[:60]) + " " + "".join(LETTERS[60:120])]
    coder = WordEncoder(word_tokenizer())
    asked = []
    monkeypatch.setattr(coder, "ask_letters", lambda words: asked.extend(words))
    ask = coder.ask
    monkeypatch.setattr(coder, "ask", lambda *pieces: asked.extend(pieces) or ask(*pieces))
    assert coder.encode(texts) == library_ids(texts) and asked == []


def test_pieces_of_any_letters_and_marks():
    rng = random.Random(5)
    letters = [*LETTERS, *"'<|>endoftext .,&#19\u0301\u030c\u0307ΣςσJTHWŰſﬁ가각\x1c\t\x0bİ½²ªº_-~"]
    texts = ["".join(rng.choices(letters, k=rng.randint(0, 14))) for _ in range(5000)]
    texts += ["<|endoftext|>", "<|ENDOFTEXT|>", "x<|startoftext|>y", "J\u030c", "don't A'S", "ΟΔΟΣ.", "'", ""]
    assert WordEncoder(word_tokenizer()).encode(texts) == library_ids(texts)


def test_a_tokenizer_that_keeps_case_is_not_taken_for_the_other(tmp_path):
    held = json.loads(open(word_tokenizer(), encoding="utf-8").read())
    held["normalizer"]["normalizers"].pop()
    path = tmp_path / "cased.json"
    path.write_text(json.dumps(held), encoding="utf-8")
    assert WordEncoder(word_tokenizer()).as_expected() and not WordEncoder(str(path)).as_expected()


def test_few_remembered_words_change_no_id(monkeypatch):
    monkeypatch.setattr(tokens, "CACHED_WORDS", 3)
    rng = random.Random(6)
    texts = [corpus.words(rng, 40) + " ΟΔΟΣ. 가각 don't The the&&& " + corpus.words(rng, 3) for _ in range(20)]
    coder = WordEncoder(word_tokenizer())
    assert [made for k in range(0, 20, 5) for made in coder.encode(texts[k : k + 5])] == library_ids(texts)
    coder.encode(["a"])
    assert max(map(len, (coder.letters, coder.known))) <= 3
