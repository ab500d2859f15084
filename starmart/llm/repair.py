"""Repair of the turn structure of conversations with the cheapest edits.

The rows of a conversation, in order of their turns, are to become ``(system)? (user assistant)+`` or nothing. Each row is kept, given the
other role or deleted, and empty turns may be inserted anywhere. The edits make a path through a graph whose nodes are a row and the role
that stood last. A path weighs one integer: its high digits are the cost, its low digits, in octal and of a fixed
width, the letters of its edits from the left, with zeros behind the last one. So the least integer is the
cheapest path and, among paths of equal cost, the one whose letters come first in ASCII; nothing but ``min`` of integers decides. No path is
the beginning of another one of equal cost to the same node, as more letters over the same rows are insertions, which cost.

Conversations are cut into blocks of turns. A block is reduced on its own to the least weight between each two of the four roles that may stand
last before and after it; then the few weights of each conversation are put together from its end. So a long conversation
is many tasks, up to the audit itself, which is one value.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import staged

# What the edits cost, and their letters as octal digits in ASCII order.
REROLE, DELETE, INSERT, CUT_SHORT = 2, 3, 2, 1
LETTERS, DIGITS = "DIKR", "1234"
_TO_DIGITS, _TO_LETTERS = str.maketrans(LETTERS, DIGITS), str.maketrans(DIGITS, LETTERS)

#: What stood last: nothing, the system, a user whose answer is still open, an answer. A conversation may end at NOTHING and ANSWER.
NOTHING, SYSTEM, OPEN, ANSWER = range(4)
#: The state behind a user or assistant turn, whichever is due there.
DUE = (OPEN, OPEN, ANSWER, OPEN)
ROLES = {OPEN: "user", ANSWER: "assistant"}
#: What is cheapest at the end: cost and letters.
AT_END = {NOTHING: (0, ""), SYSTEM: (2 * INSERT, "II"), OPEN: (INSERT, "I"), ANSWER: (0, "")}
#: First letters of roles, and the state behind a kept row with each; others can't be kept.
INITIALS = {"s": SYSTEM, "u": OPEN, "a": ANSWER}
OTHER = 0
MAY_FOLLOW = {(SYSTEM, OPEN), (OPEN, ANSWER), (ANSWER, OPEN)}
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Turns of a block, and rows after which a block of many equal turns is cut again.
BLOCK = 256
WHITE = r"[\x20\x09-\x0D]"

PARTS = (
    "key string, block long, part long, n_rows long, blank long, duplicate long, truncated long, illegal long, first_initial int, last_initial int, "
    "low_turn long, high_turn long, n_turns long, costs array<long>, audits array<string>"
)
CHOSEN = (
    "key string, block long, entry int, piece string, first boolean, blank long, duplicate long, truncated long, illegal long, "
    "gaps long, cost long, audit string"
)


def followers(state: int, initial: int) -> Iterator[tuple[str, int, int]]:
    """Letter, cost and next state of the ways to leave a row in place."""
    if initial == SYSTEM and state == NOTHING or initial in ROLES and initial == DUE[state]:
        yield "K", 0, initial
    yield "R", REROLE, DUE[state]


def block_weights(rows: list[tuple[int, int]]) -> list[tuple[int, str] | None]:
    """Least (cost, letters) over the rows, each an initial and a fault, for every state before (slow) and after (fast)."""
    width = 9 * len(rows)  # three bits for each of three letters a row at most: two insertions and the row's own
    low = (1 << width) - 1

    def put(letter: str, cost: int, rest: int) -> int:
        return (rest >> width) + cost << width | int(letter.translate(_TO_DIGITS)) << width - 3 | (rest & low) >> 3

    out: list[list[tuple[int, str] | None]] = []
    for after in range(4):
        best: list[int | None] = [0 if state == after else None for state in range(4)]
        for initial, fault in reversed(rows):
            taken: list[int | None] = []
            for state in range(4):
                ways = []
                if best[state] is not None:
                    ways.append(put("D", DELETE, best[state]))
                if fault in (SOUND, TRUNCATED):
                    extra = CUT_SHORT if fault == TRUNCATED else 0
                    ways += [put(letter, cost + extra, best[then]) for letter, cost, then in followers(state, initial) if best[then] is not None]
                taken.append(min(ways, default=None))
            best = taken
            for _ in range(2):  # a third insertion in a row would come back to a state
                best = [
                    min((w for w in (taken[s], None if best[DUE[s]] is None else put("I", INSERT, best[DUE[s]])) if w is not None), default=None)
                    for s in range(4)
                ]
        out.append([None if w is None else (w >> width, read_letters(w & low)) for w in best])
    return [out[after][before] for before in range(4) for after in range(4)]


def read_letters(low: int) -> str:
    return oct(low)[2:].rstrip("0").translate(_TO_LETTERS) if low else ""


def joined(blocks: list[list[tuple[int, str] | None]]) -> tuple[int, str, list[tuple[int, str]]]:
    """Cost and letters of the least path over the blocks, and the state before and the letters of each."""
    width = 3 * (2 + sum(max(len(w[1]) for w in weights if w) for weights in blocks))
    low = (1 << width) - 1

    def before(weight: tuple[int, str], rest: int) -> int:
        cost, letters = weight
        digits = int(letters.translate(_TO_DIGITS), 8) << width - 3 * len(letters) if letters else 0
        return cost + (rest >> width) << width | digits | (rest & low) >> 3 * len(letters)

    best: list[int | None] = [before(AT_END[state], 0) for state in range(4)]
    turns = []
    for weights in reversed(blocks):
        # The state breaks no ties: two states behind one block are never reached by the same letters.
        ways = [[(before(w, best[after]), after) for after in range(4) if (w := weights[4 * state + after]) and best[after] is not None] for state in range(4)]
        chosen = [min(way, default=None) for way in ways]
        turns.append([None if c is None else c[1] for c in chosen])
        best = [None if c is None else c[0] for c in chosen]
    state, pieces = NOTHING, []
    for weights, then in zip(blocks, reversed(turns), strict=True):
        pieces.append((state, weights[4 * state + then[state]][1]))
        state = then[state]
    if pieces:
        pieces[-1] = (pieces[-1][0], pieces[-1][1] + AT_END[state][1])
    return best[NOTHING] >> width, read_letters(best[NOTHING] & low), pieces


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        yield from zip(*(column.to_pylist() for column in batch.columns), strict=True)


def batched(rows: Iterable[tuple], schema: pa.Schema, most: int = 4096, most_chars: int = 8_000_000) -> Iterator[pa.RecordBatch]:
    """Record batches bounded in rows and, by their text columns, in size."""
    held, chars = [], 0
    texts = [i for i, field in enumerate(schema) if pa.types.is_string(field.type)]
    for row in rows:
        held.append(row)
        chars += sum(len(row[i] or "") for i in texts)
        if len(held) >= most or chars >= most_chars:
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(schema)], schema=schema)
            held, chars = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in held], f.type) for i, f in enumerate(schema)], schema=schema)


def arrow_schema(names: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(name, kinds[kind]) for name, kind in (item.split(" ") for item in names.split(", "))])


def measured_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows (key, block, turn, digest, initial, fault), sorted: one tuple of PARTS for each block, and for each BLOCK rows of one."""
    here, part, held, before = None, 0, [], None

    def finish():
        codes = [(initial, fault) for _, initial, fault in held]
        turns = [turn for turn, _, _ in held if turn is not None]
        faults = [fault for _, fault in codes]
        illegal = sum((a[0], b[0]) not in MAY_FOLLOW for a, b in zip(codes, codes[1:]))
        weights = block_weights(codes)
        return (
            *here, part, len(held), *(faults.count(f) for f in (BLANK, DUPLICATE, TRUNCATED)), illegal, codes[0][0], codes[-1][0],
            turns[0] if turns else None, turns[-1] if turns else None, len(set(turns)),
            [None if w is None else w[0] for w in weights], [None if w is None else w[1] for w in weights],
        )

    for key, block, turn, digest, initial, fault in rows_of(batches):
        if (key, block) != here or len(held) >= BLOCK:
            if held:
                yield finish()
            here, part, held, before = (key, block), part + 1 if (key, block) == here else 0, [], before if (key, block) == here else None
        if fault in (SOUND, TRUNCATED) and before == (turn, digest):
            fault = DUPLICATE
        before = (turn, digest)
        held.append((turn, initial, fault))
    if held:
        yield finish()


def chosen_blocks(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of PARTS, sorted: one tuple of CHOSEN for each block of each conversation."""
    here, held = None, []

    def finish():
        cost, audit, pieces = joined([list(map(lambda c, a: None if c is None else (c, a), row[13], row[14])) for row in held])
        counts = [sum(row[i] for row in held) for i in (4, 5, 6)]
        illegal = sum(row[7] for row in held) + sum((a[9], b[8]) not in MAY_FOLLOW for a, b in zip(held, held[1:]))
        turns = [row for row in held if row[10] is not None]
        seen = sum(row[12] for row in turns) - sum(a[11] == b[10] for a, b in zip(turns, turns[1:]))
        gaps = turns[-1][11] - turns[0][10] + 1 - seen if turns else 0
        blocks: dict[int, list] = {}
        for row, (state, piece) in zip(held, pieces, strict=True):
            blocks.setdefault(row[1], [state, ""])[1] += piece
        for i, (block, (state, piece)) in enumerate(blocks.items()):
            yield (here, block, state, piece, i == 0, *counts, illegal, gaps, cost, audit if i == 0 else None)

    for row in rows_of(batches):
        if row[0] != here:
            if held:
                yield from finish()
            here, held = row[0], []
        held.append(row)
    if held:
        yield from finish()


def edited(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows (key, block, kind, entry, piece, initial, role, text), the letters of a block before its rows: the repaired rows."""
    here, state, letters, at, place = None, NOTHING, "", 0, 0

    def inserts():
        nonlocal state, at, place
        while at < len(letters) and letters[at] == "I":
            state, at, place = DUE[state], at + 1, place + 1
            yield (*here, place, ROLES[state], "")

    for key, block, kind, entry, piece, initial, role, text in rows_of(batches):
        if kind == 0:
            yield from inserts()
            here, state, letters, at, place = (key, block), entry, piece, 0, 0
            continue
        yield from inserts()
        letter = letters[at]
        at += 1
        if letter == "D":
            continue
        state = initial if letter == "K" else DUE[state]
        place += 1
        yield (*here, place, role if letter == "K" else ROLES[state], text)
    yield from inserts()


def streamed(df: DataFrame, work, names: str) -> DataFrame:
    """A function of the rows of a partition, in their order, that gives the rows of the result."""
    schema = arrow_schema(names)
    return df.mapInArrow(lambda batches: batched(work(batches), schema), names)


@dataclass(frozen=True)
class Repair:
    """``audits``: key, gaps, blank, duplicate, truncated, illegal, cost, audit of each conversation that has rows. ``turns``: key,
    block, place, role, text of the repaired rows, ordered by block and place in each conversation."""

    audits: DataFrame
    turns: DataFrame


def conversation_key(column: str):
    """A conversation's id as text; a space for null, so that these rows are a conversation too."""
    return F.coalesce(F.col(column).cast("string"), F.lit(" "))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> Repair:
    """Cheapest repair of each conversation.

    Rows stand in order of their turn, null turns first, rows of one turn by a digest of role and text; null roles and texts
    count as one space. A row's first fault holds: blank text, role and text seen earlier in the conversation, or a text that
    doesn't end with one of ``.!?``. Blank rows and duplicates must go. Repeated rows are duplicates, texts of any length are
    compared by a 128-bit digest; an empty table has no audits and no turns; other columns are ignored.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role_col, text_col))
    source = rows.select(conversation_key(conv_col).alias("key"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"), text.alias("text")).select(
        "key", "turn", "role", "text",
        F.coalesce(F.floor(F.col("turn") / F.lit(BLOCK)), F.lit(-(1 << 62))).alias("block"),
        F.unhex(F.md5(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"))).alias("digest"),
        F.coalesce(*[F.when(F.col("role").startswith(k), F.lit(v)) for k, v in INITIALS.items()], F.lit(OTHER)).alias("initial"),
    )
    narrow = source.select(
        "key", "block", "turn", "digest", "initial",
        F.when(~F.col("text").rlike(r"[^\x20\x09-\x0D]"), BLANK).when(F.col("text").rlike(rf"[.!?]{WHITE}*\z"), SOUND).otherwise(TRUNCATED).alias("fault"),
    )
    seat = F.struct("turn")
    first = (
        narrow.where(F.col("fault") != BLANK).groupBy("key", "digest").agg(F.min(seat).alias("first"), F.max(seat).alias("last"))
        .where(~F.col("first").eqNullSafe(F.col("last"))).select(F.col("key").alias("of_key"), F.col("digest").alias("of_digest"), "first")
    )
    later = (F.col("fault") != BLANK) & F.col("of_key").isNotNull() & ~seat.eqNullSafe(F.col("first"))
    judged = narrow.join(first, (F.col("key") == F.col("of_key")) & (F.col("digest") == F.col("of_digest")), "left").select(
        "key", "block", "turn", "digest", "initial", F.when(later, DUPLICATE).otherwise(F.col("fault")).alias("fault")
    )
    sorted_rows = judged.repartition("key", "block").sortWithinPartitions("key", "block", F.col("turn").asc_nulls_first(), "digest")
    parts = streamed(sorted_rows, measured_parts, PARTS)
    chosen = staged(streamed(parts.repartition("key").sortWithinPartitions("key", "block", "part"), chosen_blocks, CHOSEN), "audits")
    audits = chosen.where("first").select("key", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")
    letters = chosen.select("key", "block", F.lit(0).alias("kind"), "entry", "piece")
    together = letters.unionByName(source.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    ordered = together.repartition("key", "block").sortWithinPartitions("key", "block", "kind", F.col("turn").asc_nulls_first(), "digest")
    named = ordered.select("key", "block", "kind", "entry", "piece", "initial", "role", "text")
    return Repair(audits, streamed(named, edited, "key string, block long, place long, role string, text string"))


def transcript_digests(turns: DataFrame) -> DataFrame:
    """key, repaired_sha256: sha256 over the ``role:text`` of each conversation's rows, joined by line feeds.

    The rows pass in order and are not gathered: a task holds one batch and one digest.
    """

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        here, digest = None, None
        for key, role, text in rows_of(batches):
            if key != here:
                if digest is not None:
                    yield here, digest.hexdigest()
                here, digest = key, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(f"{role}:{text}".encode("utf-8", "surrogatepass"))
        if digest is not None:
            yield here, digest.hexdigest()

    ordered = turns.repartition("key").sortWithinPartitions("key", "block", "place").select("key", "role", "text")
    return streamed(ordered, work, "key string, repaired_sha256 string")
