"""Periodic runs of words, found by catchers over dyadic blocks.

A run is a stretch of consecutive words with smallest period q that no neighbouring word extends keeping it. Every
completed block of 2^k words, at a multiple of 2^k, has a catcher. It waits for the block to come again: words that are appended after
the block make suffixes, and each is compared with the block at the distances the catcher is responsible for. Where a suffix is equal, the
comparison goes on word by word in both directions; once the equal stretch is long enough there are squares at that
distance, and squares that touch merge into one run. Distances are dealt so that a run of the least exponent always has a whole
block of the right size inside, and no other size looks for it.

Words are not appended singly: the catchers of one size take all suffixes at one distance in one NumPy operation. Blocks are compared by
fingerprints that double with the size, and every stretch is then compared word by word. Texts are put one behind the
other with a word between them that occurs once, so no stretch leaves its text.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.tokens import slices

SCHEMA = "doc_id long, n_words long, text string, runs array<struct<start:long,length:long,period:long>>"
RUN = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))
_LEFT, _RIGHT = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def distances(level: int, exponent: int) -> range:
    """The periods that catchers over blocks of 2^level words look for.

    A run of period q and at least the exponent repeats at distance q over (exponent - 1) q words. These hold an aligned
    block if they are at least twice as many, less one; each period has the largest such block.
    """
    low, high = (-(-((2 << k) - 1) // (exponent - 1)) for k in (level, level + 1))
    return range(max(low, 1), high)


def doubled(prints: np.ndarray, size: int) -> np.ndarray:
    """Fingerprints of stretches of twice the size."""
    made = prints[:-size] * _LEFT + (prints[size:] ^ (prints[size:] >> np.uint64(29))) * _RIGHT
    return made ^ (made >> np.uint64(32))


def stretches(equal: np.ndarray) -> Iterator[tuple[int, int]]:
    """Begin and end of each stretch of true values."""
    edges = np.flatnonzero(np.diff(equal.astype(np.int8), prepend=0, append=0))
    return zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)


def find_runs(words: np.ndarray, longest: int, exponent: int, least_length: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, by start and period. ``longest``: words of the longest text."""
    n = words.size
    found: dict[tuple[int, int], int] = {}
    # Of the runs over a word, the end and period of the one that reaches farthest.
    reach, of_reach = np.zeros(n, np.int64), np.ones(n, np.int64)
    prints, size, level = words.astype(np.uint64) * _LEFT, 1, 0
    prints ^= prints >> np.uint64(31)
    while (periods := distances(level, exponent)).start * exponent <= longest:
        blocks = prints[::size]
        for q in periods:
            if q * exponent > longest or prints.size <= q:
                break
            caught = prints[q::size]
            hits = np.flatnonzero(blocks[: caught.size] == caught)
            if not hits.size:
                continue
            # Catches at neighbouring blocks are one stretch.
            first = np.concatenate([[True], np.diff(hits) > 1])
            begins, ends = hits[first] * size, (hits[np.concatenate([first[1:], [True]])] + 1) * size
            # A stretch within a run whose period divides q is that run again.
            known = (reach[begins] >= begins + q + size) & (q % of_reach[begins] == 0)
            for begin, end in zip(begins[~known].tolist(), ends[~known].tolist(), strict=True):
                low, high = max(begin - size, 0), min(end + size, n - q)
                for a, b in stretches(words[low:high] == words[low + q : high + q]):
                    start, stop = low + a, low + b + q
                    if stop - start < max(least_length, exponent * q) or (start, stop) in found:
                        continue
                    found[start, stop] = q
                    farther = reach[start:stop] < stop
                    of_reach[start:stop][farther] = q
                    reach[start:stop][farther] = stop
        if prints.size <= size:
            break
        prints, size, level = doubled(prints, size), 2 * size, level + 1
    return sorted((start, stop - start, q) for (start, stop), q in found.items())


def split_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space."""
    return text.encode("utf-8", "surrogatepass").split() if text else []


def runs_of(texts: list[list[bytes]], exponent: int, least_length: int) -> list[list[tuple[int, int, int]]]:
    """The runs of each of the texts."""
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    sizes = np.array([len(words) for words in texts], dtype=np.int64)
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    line = np.empty(starts[-1], np.int64)
    for i, words in enumerate(texts):
        line[starts[i] : starts[i] + sizes[i]] = np.fromiter(map(numbers.__getitem__, words), np.int64, sizes[i])
        line[starts[i + 1] - 1] = -1 - i
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    found = find_runs(line, int(sizes.max(initial=0)), exponent, least_length)
    owners = np.searchsorted(starts, [start for start, _, _ in found], side="right") - 1
    for owner, (start, length, period) in zip(owners.tolist(), found, strict=True):
        out[owner].append((start - int(starts[owner]), length, period))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words, of each run only the first period, joined by one space."""
    if runs:
        keep = np.ones(len(words), dtype=bool)
        for start, length, period in runs:
            keep[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(keep)]
    return b" ".join(words).decode("utf-8", "surrogatepass")


def collapse_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_exponent: int = 4, least_length: int = 6
) -> DataFrame:
    """doc_id, n_words, text, runs: one row per input row; its text without the repeats of its runs.

    Words stand between ASCII white space and are numbered from 0. A run has smallest period q and at least
    ``least_length`` and ``least_exponent`` * q words (a whole number, 2 or more); ``runs`` has them by start, then period. A word
    goes if any run holds it behind the run's first q words; the others are joined by one space.
    A null text counts as empty. Ids may be null or repeat, an empty table gives an empty table, other columns are ignored.
    Nothing is shuffled. A run may span its whole text, so a text is in one task: some 50 bytes for each of its words.
    """
    if least_exponent < 2:
        raise ValueError("a run repeats: its exponent is 2 or more")
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, b in slices(pa.compute.binary_length(texts).to_pylist()):
                split = [split_words(text) for text in texts.slice(a, b - a).to_pylist()]
                found = runs_of(split, least_exponent, least_length)
                made = [collapsed(words, runs) for words, runs in zip(split, found, strict=True)]
                listed = [[{"start": s, "length": n, "period": q} for s, n, q in runs] for runs in found]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), pa.array(map(len, split), pa.int64()), pa.array(made, pa.string()), pa.array(listed, RUN)],
                    names=["doc_id", "n_words", "text", "runs"],
                )

    return source.mapInArrow(work, SCHEMA)
