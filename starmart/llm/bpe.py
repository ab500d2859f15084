"""Token counts of byte-level BPE vocabularies, by merging and without making ids.

A piece of text starts as a linked list with one symbol per byte. A heap holds the rank and place of every adjacent pair that
may be merged; the lowest rank (leftmost place among equal ones) is taken off, its two symbols become one, and the
two pairs that this makes enter the heap. Entries whose pair has changed since are skipped. A piece has as many tokens as symbols at first, less its merges.

The pieces that a text falls into are those of the library: its pattern, and its special strings as one token each.
"""

from __future__ import annotations

import heapq
import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed value: how byte-level vocabularies split text before they merge.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Counts of pieces that a worker remembers, and the characters up to which a piece is remembered.
REMEMBERED = 500_000
SHORT = 64
#: Characters from which the pieces of a text are counted one by one instead of listed.
LISTED = 1_000_000


@dataclass(frozen=True)
class Merges:
    """What counting needs of a vocabulary: its size is fixed by the file, whatever the corpus."""

    source: str
    by_byte: tuple[int, ...]  # symbol of each byte, -1 where the vocabulary has none
    pairs: dict[int, int]  # rank of left symbol << 32 | right symbol
    made: tuple[int, ...]  # symbol that each rank makes
    special: tuple[str, ...]  # strings that are one token wherever they stand


def byte_letters() -> list[str]:
    """The letter by which byte-level vocabularies write each byte: printable ones themselves, the others from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def read_merges(path: str) -> Merges:
    """The merges of a vocabulary file of the tokenizers library. Kinds of files that split text otherwise are refused."""
    with open(path, encoding="utf-8") as file:
        source = file.read()
    held = json.loads(source)
    model, split = held["model"], held["pre_tokenizer"] or {}
    as_written = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space")
    off = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    if model["type"] != "BPE" or held["normalizer"] or not as_written or any(model.get(name) for name in off):
        raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
    if any(added[flag] for added in held["added_tokens"] for flag in ("single_word", "lstrip", "rstrip", "normalized")):
        raise ValueError(f"special strings with conditions: {path}")
    vocabulary, pairs, made = model["vocab"], {}, []
    for merge in model["merges"]:
        left, right = merge.split(" ") if isinstance(merge, str) else merge
        pairs[vocabulary[left] << 32 | vocabulary[right]] = len(made)
        made.append(vocabulary[left + right])
    special = sorted((added["content"] for added in held["added_tokens"]), key=len, reverse=True)
    return Merges(source, tuple(vocabulary.get(letter, -1) for letter in byte_letters()), pairs, tuple(made), tuple(special))


def merged_length(symbols: list[int], merges: Merges) -> int:
    """Symbols left when no adjacent pair has a rank any more."""
    n, pairs, made = len(symbols), merges.pairs, merges.made
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [rank * n + i for i in range(n - 1) if (rank := pairs.get(symbols[i] << 32 | symbols[i + 1])) is not None]
    heapq.heapify(heap)
    left = n
    while heap:
        rank, i = divmod(heapq.heappop(heap), n)
        j = after[i]
        if symbols[i] < 0 or j == n or pairs.get(symbols[i] << 32 | symbols[j]) != rank:
            continue
        symbols[i], symbols[j] = made[rank], -1
        left -= 1
        k, p = after[j], before[i]
        after[i] = k
        if k < n:
            before[k] = i
            if (rank := pairs.get(symbols[i] << 32 | symbols[k])) is not None:
                heapq.heappush(heap, rank * n + i)
        if p >= 0 and (rank := pairs.get(symbols[p] << 32 | symbols[i])) is not None:
            heapq.heappush(heap, rank * n + p)
    return left


class PieceCounts(dict):
    """Tokens of pieces; those not known are merged. What is remembered is bounded and only saves time."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges

    def __missing__(self, piece: str) -> int:
        symbols = [s for b in piece.encode("utf-8") if (s := self.merges.by_byte[b]) >= 0]
        found = merged_length(symbols, self.merges) if len(symbols) > 1 else len(symbols)
        if len(piece) <= SHORT:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = found
        return found


class Counter:
    """Tokens of whole texts."""

    def __init__(self, merges: Merges):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_str(merges.source).pre_tokenizer
        self.known = PieceCounts(merges)
        self.split = regex.compile(PATTERN)
        self.special = regex.compile("|".join(map(regex.escape, merges.special))) if merges.special else None
        self.same: set[str] = set(map(chr, range(128)))
        self.other: set[str] = set()

    def differs(self, text: str) -> bool:
        """Whether a letter, digit or space of the library is none here: their editions of Unicode are not the same."""
        if text.isascii():
            return False
        letters = set(text)
        for letter in letters - self.same - self.other:
            probe = f"a{letter}b {letter}1{letter}{letter} ."
            theirs = [probe[a:b] for _, (a, b) in self.library.pre_tokenize_str(probe)]
            (self.same if theirs == self.split.findall(probe) else self.other).add(letter)
        return bool(self.other) and not self.other.isdisjoint(letters)

    def plain(self, text: str) -> int:
        if not text:
            return 0
        if self.differs(text):
            return sum(self.known[text[a:b]] for _, (a, b) in self.library.pre_tokenize_str(text))
        if len(text) < LISTED:
            return sum(map(self.known.__getitem__, self.split.findall(text)))
        return sum(self.known[m.group()] for m in self.split.finditer(text))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        if self.special is None:
            return self.plain(text)
        total = done = 0
        for found in self.special.finditer(text):
            total += self.plain(text[done : found.start()]) + 1
            done = found.end()
        return total + self.plain(text[done:] if done else text)


_COUNTERS: dict[str, Counter] = {}


def token_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per input row, for its whole text.

    ``vocabulary`` is a file of the driver; its merges are sent to the tasks. Counts are those of the library without
    begin, end or added tokens, truncation and padding; special strings in a text are one token each. A null text counts as empty and has none.
    Null ids and repeated rows are kept as they are; equal ranks are merged from the left; an empty table gives an empty table; other columns are
    ignored. A text of any length is counted whole: a task holds one batch of texts, and of its longest piece a few numbers per byte.
    """
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    merges = read_merges(vocabulary)
    shared = docs.sparkSession.sparkContext.broadcast(merges)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        counter = _COUNTERS.get(vocabulary)
        if counter is None:
            counter = _COUNTERS[vocabulary] = Counter(shared.value)
        for batch in batches:
            counts = [counter.count(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    sized = source.withColumn("n_bytes", F.octet_length("text").cast("long"))
    made = sized.mapInArrow(work, "doc_id long, n_bytes long, n_tokens long")
    return made.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
