"""Token ids of a corpus in Simple-8b files.

The format is a Parquet table, so that Spark's committer writes it and a lost executor leaves no half
file behind: one row per document with the shard, the place of its first id in the shard, the number of
ids, the words of every block and the words themselves. Shards hold ascending ranges of document ids.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm import simple8b
from starmart.llm.bpe import byte_letters
from starmart.llm.common import map_batches
from starmart.session import scratch_path

FORMAT = "shard int, doc_id long, place long, n_tokens long, block_words binary, words binary"
SLICE_CHARS = 4_000_000
#: Words that an encoder remembers, and as many older ones.
CACHED_WORDS = 250_000
#: Printable ASCII but for the apostrophe, which begins words of its own, and what such a piece falls into once it is lower-cased.
SIMPLE = re.compile("[!-&(-~]*")
WORDS = re.compile("[a-z]+|[0-9]|[^a-z0-9]+")
#: Latin and Cyrillic letters. None joins with another to a third, so a word of them is normalized letter by letter.
LETTERS = [c for c in map(chr, (*range(0x41, 0x250), *range(0x400, 0x530))) if c.isalpha() and len(c.lower()) == 1]
_BYTES = str.maketrans(dict(enumerate(byte_letters())))


class Remembered(dict):
    """What was made for the last keys. When it is full its entries become the older ones, from which those still in use come back."""

    def __init__(self, make: Callable[[str], bytes]):
        super().__init__()
        self.make, self.older = make, {}

    def __missing__(self, key: str) -> bytes:
        made = self.older.get(key)
        if made is None:
            made = self.make(key)
        self.turn()
        self[key] = made
        return made

    def turn(self) -> None:
        if len(self) >= CACHED_WORDS:
            self.older = dict(self)
            self.clear()


class WordEncoder:
    """Ids of whole texts by the library, asked once per distinct word.

    That is exact for tokenizers that lower-case, split at white space and before marks, and drop white space. Pieces
    between two spaces that are letters with at most one full stop or comma behind share the ids of their
    letters; these are asked in long strings, in which every word is one of the library's words. All other
    pieces are asked one by one.

    Words of letters whose lower case and bytes are certain, and the words of SIMPLE pieces, go to the library's model itself. Whether
    the tokenizer treats them so is tried on all such letters and marks at the start; if it does not, none goes that way.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known = Remembered(self.ids_of)
        self.letters = Remembered(self.ask_model)
        self.marks = {"": b"", ".": self.ask(".")[0], ",": self.ask(",")[0]}
        self.added = [str(made) for made in self.tokenizer.get_added_tokens_decoder().values()]
        self.lower = {ord(c): c.lower() for c in LETTERS}
        self.direct = self.as_expected()
        self.certain = re.compile(f"[{''.join(LETTERS)}]+")
        self.plain = re.compile(f"[\\s!-~{''.join(LETTERS)}]*")

    def as_expected(self) -> bool:
        """Whether the tokenizer lower-cases all LETTERS one by one and splits simple pieces into WORDS, as bytes."""
        if self.tokenizer.normalizer is None or self.tokenizer.pre_tokenizer is None:
            return False
        marks = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'")
        ends = [f"{a}{m}{b}{m}{m}" for m in marks for a, b in ("aB", "19", "z0", "7Q")]
        pieces = ["".join(LETTERS), *(f"a{c}{c}z" for c in LETTERS), *ends, marks, "0123456789", "a1b22c"]
        wanted = [[p.translate(self.lower).encode().decode("latin-1").translate(_BYTES)] if p.isalpha() else WORDS.findall(p.lower()) for p in pieces]
        made = self.tokenizer.pre_tokenizer.pre_tokenize_str(self.tokenizer.normalizer.normalize_str(" ".join(pieces)))
        return [word for word, _ in made] == [word for words in wanted for word in words]

    def ask(self, *pieces: str) -> list[bytes]:
        encode = getattr(self.tokenizer, "encode_batch_fast", self.tokenizer.encode_batch)
        return [np.array(made.ids, dtype="<u4").tobytes() for made in encode(list(pieces), add_special_tokens=False)]

    def ask_model(self, word: str) -> bytes:
        """Ids of a word that is lower-cased already."""
        if not word.isascii():
            word = word.encode().decode("latin-1").translate(_BYTES)
        ids = [token.id for token in self.model.tokenize(word)]
        return struct.pack(f"<{len(ids)}I", *ids)

    def ask_letters(self, words: list[str]) -> None:
        for begin in range(0, len(words), 2000):
            some = words[begin : begin + 2000]
            made = self.tokenizer.encode(" ".join(some), add_special_tokens=False)
            cuts = np.flatnonzero(np.diff(np.array(made.word_ids, dtype=np.int64))) + 1
            if cuts.size + 1 != len(some):
                self.letters.update(zip(some, self.ask(*some), strict=True))
                continue
            raw, ends = np.array(made.ids, dtype="<u4").tobytes(), [0, *(4 * cuts).tolist(), 4 * len(made.ids)]
            self.letters.update((word, raw[ends[i] : ends[i + 1]]) for i, word in enumerate(some))

    def quick(self, piece: str) -> bytes | None:
        """Ids of a piece whose words go to the model itself; null for others."""
        mark = piece[-1:] if piece.endswith((".", ",")) else ""
        word = piece[:-1] if mark else piece
        if word.isalpha():
            if word.isascii():
                ids = self.letters[word.lower()]
            elif self.certain.fullmatch(word):
                ids = self.letters[word.translate(self.lower)]
            else:
                return None
            return ids + self.marks[mark] if mark else ids
        if SIMPLE.fullmatch(piece) and not any(made in piece for made in self.added):
            return b"".join([self.letters[x] for x in WORDS.findall(piece.lower())])
        return None

    def ids_of(self, piece: str) -> bytes:
        made = self.quick(piece) if self.direct else None
        return self.ask(piece)[0] if made is None else made

    def learn(self, new: list[str]) -> None:
        """Ids of pieces of other scripts, many at once."""
        parts, odd = [], []
        for piece in new:
            if self.direct and (made := self.quick(piece)) is not None:
                self.known[piece] = made
                continue
            mark = piece[-1:] if piece.endswith((".", ",")) else ""
            word = piece[:-1] if mark else piece
            if word.isascii():
                word = word.lower()
            if word.isalpha():
                parts.append((piece, word, mark))
            else:
                odd.append(piece)
        self.ask_letters(list({word for _, word, _ in parts if word not in self.letters}))
        self.known.update((piece, self.letters[word] + self.marks[mark]) for piece, word, mark in parts)
        self.known.update(zip(odd, self.ask(*odd), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        pieces = [text.replace("\n", " ").split(" ") for text in texts]
        other = [words for words, text in zip(pieces, texts, strict=True) if not self.direct or not self.plain.fullmatch(text)]
        self.known.turn()
        self.letters.turn()
        self.learn([piece for piece in set().union(*other) if piece not in self.known])
        return [b"".join(map(self.known.__getitem__, words)) for words in pieces]


_ENCODERS: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def slices(sizes: Iterable[int], most: int = SLICE_CHARS) -> Iterator[tuple[int, int]]:
    """Ranges of rows with about `most` characters each."""
    begin = total = end = 0
    for end, size in enumerate(sizes, 1):
        total += size or 0
        if total >= most:
            yield begin, end
            begin, total = end, 0
    if end > begin:
        yield begin, end


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    path: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    end_id: int = 1,
    shards: int | None = None,
) -> str:
    """Tokenize whole texts and write them in ascending order of ids; the folder written.

    A null text counts as empty and so has the end id alone. Null ids come first; rows with equal ids are
    ordered by text. Other columns are ignored. An empty table gives an empty folder of the format.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    shards = shards or int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_docs = (
        docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        .repartitionByRange(shards, "doc_id")
        .sortWithinPartitions("doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, place, codec = TaskContext.get().partitionId(), 0, encoder(tokenizer)
        end = np.array([end_id], dtype="<u4").tobytes()
        for batch in batches:
            ids, texts = batch.column(0), batch.column(1)
            for a, b in slices(pa.compute.binary_length(texts).to_pylist()):
                coded = [x + end for x in codec.encode(texts.slice(a, b - a).to_pylist())]
                lengths = np.array([len(x) // 4 for x in coded], dtype=np.int64)
                values = np.frombuffer(b"".join(coded), dtype="<u4").astype(np.uint64)
                words, per_block, blocks = simple8b.encode(values, lengths)
                block_ends = np.cumsum(blocks)
                word_ends = np.concatenate([[0], np.cumsum(per_block)])
                begins = block_ends - blocks
                places = place + np.cumsum(lengths) - lengths
                place = int(places[-1] + lengths[-1])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(b - a, shard, np.int32)),
                        ids.slice(a, b - a),
                        pa.array(places),
                        pa.array(lengths),
                        pa.array([per_block[x:y].astype("<u2").tobytes() for x, y in zip(begins, block_ends, strict=True)], pa.binary()),
                        pa.array([words[word_ends[x] : word_ends[y]].astype("<u8").tobytes() for x, y in zip(begins, block_ends, strict=True)], pa.binary()),
                    ],
                    names=["shard", "doc_id", "place", "n_tokens", "block_words", "words"],
                )

    sorted_docs.mapInArrow(run, FORMAT).write.parquet(path)
    return path


def decode_rows(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all documents of a batch of the format, laid end to end, and their lengths."""
    lengths = batch.column("n_tokens").to_numpy()
    per_block = np.frombuffer(b"".join(batch.column("block_words").to_pylist()), dtype="<u2").astype(np.int64)
    words = np.frombuffer(b"".join(batch.column("words").to_pylist()), dtype="<u8")
    return simple8b.decode(words, per_block, lengths), lengths


def read_index(spark, path: str) -> DataFrame:
    """The files of `write_tokens` with `start`, the ids of all documents before: shards before, then place."""
    rows = spark.read.schema(FORMAT).parquet(path)
    sizes = rows.groupBy("shard").agg(F.sum("n_tokens").alias("size"))
    order = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = sizes.select(F.col("shard").alias("of_shard"), F.coalesce(F.sum("size").over(order), F.lit(0)).alias("base"))
    return rows.join(bases, F.col("shard") == F.col("of_shard")).select(
        "doc_id", (F.col("base") + F.col("place")).alias("start"), "n_tokens", "block_words", "words"
    )


def token_digest(index: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the decoded words."""

    def digest(batch: pa.RecordBatch) -> pa.RecordBatch:
        crcs: list[int] = []
        for a, b in slices(batch.column("n_tokens").to_pylist(), SLICE_CHARS // 4):
            ids, lengths = decode_rows(batch.slice(a, b - a))
            raw, ends = memoryview(ids.astype("<u4").tobytes()), np.cumsum(lengths) * 4
            crcs += [zlib.crc32(raw[e - 4 * n : e]) for e, n in zip(ends.tolist(), lengths.tolist(), strict=True)]
        return pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("start"), batch.column("n_tokens"), pa.array(crcs, pa.int64())],
            names=["doc_id", "start", "n_tokens", "ids_crc32"],
        )

    return map_batches(index, digest, "doc_id long, start long, n_tokens long, ids_crc32 long")


def read_ids(index: DataFrame) -> DataFrame:
    """doc_id, start, ids: the token ids themselves."""

    def ids_of(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, lengths = decode_rows(batch)
        offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.astype(np.int64)))
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("start"), lists], names=["doc_id", "start", "ids"])

    return map_batches(index, ids_of, "doc_id long, start long, ids array<long>")
