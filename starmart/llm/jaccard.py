"""Links between documents whose sets of word n-grams are similar: a prefix-tree join.

All sets are written in one global order, rare n-grams first (n-grams that many documents share come last, by
counts over the whole corpus, then by hash). Two sets that are similar enough share one of the first n-grams
of both, so only sets that meet at such an n-gram are compared. Per n-gram every set is compared with one
pivot first, and with another in a further turn; sets that then still lie in different components are compared with each
other in blocks, as far as lengths, places and bitmaps leave a chance. So groups of copies cost a comparison per set, and no link
between components is lost.

A comparison of one set with many puts the many in a prefix tree, in the reverse global order, where near
copies share a path. The tree is walked depth first: the overlap of a shared path is computed once,
and a subtree is left when its overlap and what can still follow stay below the bound. Sorted sequences with the length of
the path shared with the one before are this tree.

Equal sets are one class from the start.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starmart.llm.common import discard, staged
from starmart.llm.components import components
from starmart.llm.tokens import slices

SIZE = 5
#: Links need 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Bound of the table of frequent n-grams that every task holds (9 bytes each), and bits by which n-grams are looked up first.
FREQUENT = 1_000_000
MARK_BITS = 24
Frequent = tuple[np.ndarray, np.ndarray, np.ndarray | None]
#: Characters within which a task counts what repeats.
COUNTED_CHARS = 16_000_000
TREE = 512
#: n-grams of the sets in one chunk of a component, beside TREE sets.
CHUNK_GRAMS = 1_000_000
#: Turns with another pivot before the sets that are still apart are compared with each other.
TURNS = 1
#: Level (logarithm of the count, and 1) from which the sets at an n-gram are dealt into SALTS parts.
HOT, SALTS = 17, 256
#: Bits of the bitmap by which a pair can be ruled out without its texts.
BITS = 1024
STEP = 64
_MIX = np.uint64(0x9E3779B97F4A7C15)


def grams(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the n-grams of words; with fewer words than SIZE the whole sequence is one."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.zeros(0, dtype=np.uint64)
    numbers = np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=np.uint64, count=len(words))
    width = min(SIZE, len(words))
    n = len(words) - width + 1
    made = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        made = (made ^ numbers[k : k + n]) * _MIX
        made ^= made >> np.uint64(32)
    return np.unique(made)


def ordered(own: np.ndarray, frequent: Frequent) -> np.ndarray:
    """A sorted set in the global order: by level of the table of frequent n-grams (0 if not there), then by hash."""
    table, levels, marks = frequent
    if not table.size or not own.size:
        return own
    # Most n-grams are not frequent, which a look at one bit settles.
    some = np.flatnonzero(marks[(own >> np.uint64(64 - MARK_BITS)).astype(np.int64)])
    if not some.size:
        return own
    at = np.minimum(np.searchsorted(table, own[some]), table.size - 1)
    level = np.zeros(own.size, np.uint8)
    level[some] = np.where(table[at] == own[some], levels[at], 0)
    return own[np.argsort(level, kind="stable")]


def marked(table: np.ndarray, levels: np.ndarray) -> Frequent:
    """The table with a mark for each value of the first MARK_BITS bits that occurs in it."""
    marks = np.zeros(1 << MARK_BITS, dtype=bool)
    marks[(table >> np.uint64(64 - MARK_BITS)).astype(np.int64)] = True
    return table, levels, marks


def bitmap(own: np.ndarray) -> bytes:
    """Parity of the set's hashes in BITS places: two bitmaps differ in as many places as the sets do, or fewer."""
    odd = np.bincount((own % np.uint64(BITS)).astype(np.int64), minlength=BITS) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def least_overlap(n: int, m: int) -> int:
    """Smallest intersection of sets of n and m that makes a link: 100 i >= P (n + m - i)."""
    return -(-PERCENT * (n + m) // (100 + PERCENT))


def prefix_length(n: int) -> int:
    """A partner has at least P % of n in common, so it shares one of so many first n-grams."""
    return n - -(-PERCENT * n // 100) + 1


def frequent_grams(docs: DataFrame) -> Frequent:
    """Sorted hashes of the FREQUENT n-grams that repeat most, counted over all documents, and their levels.

    Each task counts what repeats within COUNTED_CHARS and keeps the FREQUENT best; a level is the
    logarithm of the count. The table only shapes the global order, so what it misses costs time, never a link.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        kept = (np.zeros(0, np.uint64), np.zeros(0, np.int64))
        for batch in batches:
            texts = batch.column(0)
            for a, b in slices(pa.compute.binary_length(texts).to_pylist(), COUNTED_CHARS):
                # Equal texts count once here, as they will be one class.
                sets = [grams(t) for t in set(texts.slice(a, b - a).to_pylist())]
                found, counts = np.unique(np.concatenate(sets), return_counts=True)
                found, counts = np.concatenate([kept[0], found[counts > 1]]), np.concatenate([kept[1], counts[counts > 1]])
                found, back = np.unique(found, return_inverse=True)
                counts = np.bincount(back, counts, found.size).astype(np.int64)
                best = np.argsort(-counts, kind="stable")[:FREQUENT]
                kept = (found[best], counts[best])
        yield pa.RecordBatch.from_arrays([pa.array(kept[0].astype(np.int64)), pa.array(kept[1])], names=["gram", "n"])

    counted = docs.select("text").mapInArrow(work, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    best = counted.orderBy(F.col("n").desc(), "gram").limit(FREQUENT).toArrow()
    table = best.column("gram").to_numpy().astype(np.int64).view(np.uint64)
    levels = np.log2(best.column("n").to_numpy().astype(float)).astype(np.uint8) + np.uint8(1)
    order = np.argsort(table)
    return table[order], levels[order], None


def sketched(docs: DataFrame, frequent: Frequent) -> DataFrame:
    """doc_id, spot, n, cls, and of the first row of a class in each task: prefix, calm, bits.

    Size and class of each set, its first n-grams in the global order, how many of these are not HOT, and its bitmap. Copies beyond
    the first in a task add nothing to their class, so a text that stands in many rows is shuffled once per task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        table, levels, _ = shared.value
        order = marked(table, levels)
        hot = table[levels >= HOT]
        seen: set[int] = set()
        known: dict[int, tuple[int, int | None]] = {}
        for batch in batches:
            ids, texts, spots = batch.columns
            for a, b in slices(pa.compute.binary_length(texts).to_pylist()):
                rows = []
                for text in texts.slice(a, b - a).to_pylist():
                    same = xxhash.xxh3_128_intdigest((text or "").encode("utf-8", "surrogatepass"))
                    if same in known:
                        rows.append((*known[same], None, None, None))
                        continue
                    own = grams(text)
                    cls = class_of(own)
                    known[same] = own.size, cls
                    if cls is None or cls in seen:
                        rows.append((own.size, cls, None, None, None))
                        continue
                    seen.add(cls)
                    prefix = ordered(own, order)[: prefix_length(own.size)]
                    calm = prefix.size - int(np.isin(prefix, hot).sum()) if hot.size else prefix.size
                    rows.append((own.size, cls, prefix.astype(np.int64), calm, bitmap(own)))
                kinds = (pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(a, b - a), spots.slice(a, b - a), *(pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds))],
                    names=["doc_id", "spot", "n", "cls", "prefix", "calm", "bits"],
                )

    return docs.select("doc_id", "text", "spot").mapInArrow(work, "doc_id long, spot long, n int, cls long, prefix array<long>, calm int, bits binary")


def class_of(own: np.ndarray) -> int | None:
    """A number of a set, never negative; null for the empty set."""
    return xxhash.xxh3_64_intdigest(own.tobytes(), seed=own.size) >> 1 if own.size else None


def may_link(n: np.ndarray, pos: np.ndarray, m: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Lengths n and m allow a link, and so do the places pos and at of an n-gram, if it is the first that both sets have.

    Every pair that is a link passes at its first shared n-gram: no other can stand before it.
    """
    after = np.minimum(n - pos, m - at)
    return (np.minimum(n, m) * 100 >= np.maximum(n, m) * PERCENT) & (after * (100 + PERCENT) >= (n + m) * PERCENT)


def near_bits(x: np.ndarray, y: np.ndarray, both: np.ndarray) -> np.ndarray:
    """Bitmaps differ in no more places than the sets of a link can. both: sum of the two sizes."""
    apart = np.bitwise_count(x ^ y).sum(axis=-1, dtype=np.int64)
    return apart <= both - 2 * -(-both * PERCENT // (100 + PERCENT))


def met(sets: DataFrame) -> DataFrame:
    """gram, cls, n, pos, pivot, pivot_n, pivot_pos: the classes at each first n-gram that several have, and the least of them.

    All first n-grams pass once, sorted, and nothing but the least class of the n-gram at hand is held. Those of a HOT n-gram are dealt
    into SALTS parts with a pivot each; there the pivot comes along even if it is alone, as other parts may hold its partners.
    """
    rows = sets.where("prefix is not null").select("cls", "n", "calm", F.posexplode("prefix").alias("pos", "gram"))
    # Salts of HOT n-grams start at 1.
    salt = F.when(F.col("pos") >= F.col("calm"), F.pmod("cls", F.lit(SALTS)) + 1).otherwise(F.lit(0).cast("long"))
    dealt = rows.select("gram", salt.alias("salt"), "cls", "n", "pos").repartition("gram", "salt").sortWithinPartitions("gram", "salt", "cls")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        # gram, salt, cls of the row before, and cls, n, pos of the pivot
        last, pivot = None, (0, 0, 0)
        for batch in batches:
            if not batch.num_rows:
                continue
            gram, salt, cls, n, pos = (column.to_numpy().astype(np.int64) for column in batch.columns)
            same = np.concatenate([[last is not None and (gram[0], salt[0]) == last[:2]], (gram[1:] == gram[:-1]) & (salt[1:] == salt[:-1])])
            before = np.concatenate([[last[2] if last is not None else 0], cls[:-1]])
            first = np.maximum.accumulate(np.where(same, 0, np.arange(1, gram.size + 1)))
            held = [np.concatenate([[p], x]) for p, x in zip(pivot, (cls, n, pos), strict=True)]
            p_cls, p_n, p_pos = (x[first] for x in held)
            partner = same & (cls != p_cls) & (cls != before)
            # The pivot itself comes along with its first partner, at a HOT n-gram at once.
            opens = np.where(salt > 0, ~same, partner & (before == p_cls))
            columns = [np.concatenate([gram[partner], gram[opens]])]
            columns += [np.concatenate([x[partner], p[opens]]) for x, p in ((cls, p_cls), (n, p_n), (pos, p_pos))]
            columns += [np.concatenate([p[partner], p[opens]]) for p in (p_cls, p_n, p_pos)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["gram", "cls", "n", "pos", "pivot", "pivot_n", "pivot_pos"])
            last, pivot = (gram[-1], salt[-1], cls[-1]), (p_cls[-1], p_n[-1], p_pos[-1])

    return dealt.mapInArrow(work, "gram long, cls long, n long, pos long, pivot long, pivot_n long, pivot_pos long")


def not_ruled_out(pairs: DataFrame, maps: DataFrame) -> DataFrame:
    """The pairs (a, b) whose bitmaps allow a link."""
    sides = (
        pairs.join(maps.select(F.col("cls").alias("a"), F.col("n").alias("n_a"), F.col("bits").alias("bits_a")), "a")
        .join(maps.select(F.col("cls").alias("b"), F.col("n").alias("n_b"), F.col("bits").alias("bits_b")), "b")
        .select("a", "b", (F.col("n_a") + F.col("n_b")).cast("long").alias("both"), "bits_a", "bits_b")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint64).reshape(-1, BITS // 64) for i in (3, 4))
            yield batch.select(["a", "b"]).filter(pa.array(near_bits(x, y, batch.column(2).to_numpy())))

    return sides.mapInArrow(work, "a long, b long")


def walk(probe: np.ndarray, members: list[np.ndarray]) -> list[int]:
    """Overlap of the probe (sorted) with each member (reverse global order), -1 where it stays below the bound."""
    keys = [m.astype(">u8").tobytes() for m in members]
    order = sorted(range(len(members)), key=keys.__getitem__)
    out = [-1] * len(members)
    path, upto, done = np.zeros(0, np.uint64), np.zeros(1, np.int64), 0  # overlap before each depth, known to `done`
    for i in order:
        own = members[i]
        need = least_overlap(probe.size, own.size)
        low = min(done, own.size)
        differ = np.flatnonzero(path[:low] != own[:low])
        depth = int(differ[0]) if differ.size else low
        counts, total = [upto[: depth + 1]], int(upto[depth])
        while depth < own.size and total + min(own.size - depth, probe.size - total) >= need:
            some = own[depth : depth + STEP]
            hits = probe[np.minimum(np.searchsorted(probe, some), probe.size - 1)] == some
            counts.append(total + np.cumsum(hits))
            total, depth = int(counts[-1][-1]), depth + some.size
        path, upto, done = own, np.concatenate(counts), depth
        if depth == own.size and total >= need:
            out[i] = total
    return out


def verify(pairs: DataFrame, texts: DataFrame, frequent: Frequent) -> DataFrame:
    """a, b, shared: those of the pairs of classes that are links. texts: cls, text of one document of each class."""
    shared = pairs.sparkSession.sparkContext.broadcast(frequent)
    sizes = pairs.groupBy(F.col("b").alias("probe_cls")).agg(F.ceil(F.count("*") / TREE).cast("long").alias("trees"))
    probes = sizes.join(texts, F.col("probe_cls") == F.col("cls")).select(
        F.col("probe_cls").alias("b"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("trees") - 1)).alias("tree"), F.lit(0).alias("role"), F.lit(None).cast("long").alias("a"), "text"
    )
    members = (
        pairs.join(sizes, F.col("b") == F.col("probe_cls"))
        .join(texts, F.col("a") == F.col("cls"))
        .select("b", F.pmod(F.xxhash64("a"), "trees").alias("tree"), F.lit(1).alias("role"), "a", "text")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        here, probe, names, sets = None, None, [], []
        order = marked(*shared.value[:2])

        def finish():
            if probe is None or not sets:
                return
            found = walk(probe, sets)
            links = [(name, here[0], n) for name, n in zip(names, found, strict=True) if n >= 0]
            if links:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in range(3)], names=["a", "b", "shared"])

        for batch in batches:
            for b, tree, role, a, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (b, tree) != here or len(sets) >= TREE:
                    yield from finish()
                    names, sets = [], []
                    if (b, tree) != here:
                        here, probe = (b, tree), None
                if role == 0:
                    probe = grams(text)
                else:
                    names.append(a)
                    sets.append(ordered(grams(text), order)[::-1].copy())
        yield from finish()

    together = probes.unionByName(members).repartition("b", "tree").sortWithinPartitions("b", "tree", "role")
    return together.mapInArrow(work, "a long, b long, shared long")


def gram_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, n_links, component_id: one row per input row.

    n_links counts the other rows whose sets are similar enough, rows with an equal set included. Empty and null texts have no
    n-grams and link with nothing; equal sets share a component; rows with one id and several texts are
    each placed by their own text. Rows with a null id link like others; their component is null if it has no id at all.
    Other columns are ignored; an empty table gives an empty table; of a very long text a task holds 8 bytes a word.
    """
    return linked_rows(docs, id_col, text_col).select("doc_id", "n_shingles", "n_links", "component_id")


def linked_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """As gram_links, with spot (a hash of the text) and root (a class of the component; null without words)."""
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("spot", F.xxhash64("text"))
    frequent = frequent_grams(source)
    sets = staged(sketched(source, frequent), "gram-sets")
    members = staged(met(sets), "gram-members")
    known = members.select("cls").distinct()
    maps = staged(sets.where("bits is not null").select("cls", "n", "bits").dropDuplicates(["cls"]).join(known, "cls"), "gram-bits")
    slim = staged(sets.select("doc_id", "spot", "n", "cls"), "gram-rows")
    discard(sets)
    at_pivot = members.where(F.col("cls") != F.col("pivot")).mapInArrow(_placed_pairs, "a long, b long").distinct()
    pairs = staged(not_ruled_out(at_pivot, maps), "gram-pairs")
    texts = staged(class_texts(source, slim, pairs), "gram-texts")
    links = staged(verify(pairs, texts, frequent), "gram-links")
    discard(pairs)
    group = components(links)
    for last in (False,) * TURNS + (True,):
        # Sets of different components that meet at an n-gram: with one more pivot of it, at last with each other.
        left = still_open(members, group)
        if left.isEmpty():
            discard(left)
            break
        pairs = staged(not_ruled_out(new_pivots(left), maps) if not last else all_pairs(left, maps), "gram-pairs")
        discard(left)
        fresh = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct().join(texts, "cls", "left_anti")
        if not fresh.isEmpty():
            before, texts = texts, staged(texts.unionByName(class_texts(source, slim, fresh.select(F.col("cls").alias("a"), F.col("cls").alias("b")))), "gram-texts")
            discard(before)
        more = staged(verify(pairs, texts, frequent), "gram-links")
        discard(pairs)
        if not more.isEmpty():
            # The components found so far are stars, and new links join stars.
            group = components(group.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more.select("a", "b")))
    group = staged(group, "gram-groups")
    discard(members, maps)
    linked = staged(
        slim.where("cls is not null").groupBy("cls").agg(F.count("*").alias("copies"), F.first("n").alias("n")).join(group, F.col("cls") == F.col("node"), "left").select("cls", "copies", "n", "root"), "gram-classes"
    )
    counts = links_inside(linked.where("root is not null"), texts)
    ends = staged(
        linked.where("root is not null or copies > 1").join(counts, F.col("cls") == F.col("end"), "left")
        .select(F.col("cls").alias("node"), "root", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links")), "gram-counts"
    )
    discard(texts, linked)
    named = (
        slim.join(ends, F.col("cls") == F.col("node"), "left")
        .select("doc_id", "spot", F.col("n").cast("long").alias("n_shingles"), F.coalesce("links", F.lit(0).cast("long")).alias("n_links"), F.coalesce("root", "cls").alias("root"))
    )
    smallest = named.where("root is not null").groupBy(F.col("root").alias("of_root")).agg(F.min("doc_id").alias("first_id"))
    known_id = F.when(F.col("root").isNull(), F.col("doc_id")).otherwise(F.col("first_id")).alias("component_id")
    return named.join(smallest, F.col("root") == F.col("of_root"), "left").select("doc_id", "spot", "root", "n_shingles", "n_links", known_id)


def _placed_pairs(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
    for batch in batches:
        _, cls, n, pos, pivot, pivot_n, pivot_pos = (column.to_numpy() for column in batch.columns)
        keep = may_link(n, pos, pivot_n, pivot_pos)
        yield pa.RecordBatch.from_arrays([pa.array(cls[keep]), pa.array(pivot[keep])], names=["a", "b"])


def new_pivots(left: DataFrame) -> DataFrame:
    """a, b: each set that lies open at an n-gram, with one other of the n-gram in another component, if it may link with that."""
    pivot = F.min_by(F.struct("cls", "n", "pos", "root"), F.xxhash64("cls", "gram")).alias("pivot")
    pivots = left.groupBy(F.col("gram").alias("of_gram")).agg(pivot)
    sides = left.join(pivots, F.col("gram") == F.col("of_gram")).where(F.col("root") != F.col("pivot.root"))
    return sides.select("gram", "cls", "n", "pos", F.col("pivot.cls").alias("pivot_cls"), F.col("pivot.n").alias("pivot_n"), F.col("pivot.pos").alias("pivot_pos")).mapInArrow(_placed_pairs, "a long, b long").distinct()


def all_pairs(left: DataFrame, maps: DataFrame) -> DataFrame:
    """a, b: the pairs of sets of different components at each n-gram that may link, by places and bitmaps.

    The sets at an n-gram are dealt into chunks, every two chunks are one block, and a block passes on only pairs that none of
    the bounds rules out.
    """
    total = left.groupBy(F.col("gram").alias("of_gram")).agg(F.ceil(F.count("*") / F.lit(TREE)).cast("long").alias("chunks"))
    blocks = (
        left.join(total, F.col("gram") == F.col("of_gram")).join(maps.select(F.col("cls").alias("of_cls"), "bits"), F.col("cls") == F.col("of_cls"))
        .withColumn("own", F.pmod(F.xxhash64("cls"), F.col("chunks")))
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
        .select("gram", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"), "own", "cls", "n", "pos", "root", "bits")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        here, held, out = None, [], []

        def small():
            for i, (own, cls, n, pos, root, bits) in enumerate(held):
                for other, cls2, m, at, root2, bits2 in held[i + 1 :]:
                    both = n + m
                    if root == root2 or (here[1] != here[2] and own == other) or min(n - pos, m - at) * (100 + PERCENT) < both * PERCENT:
                        continue
                    if min(n, m) * 100 >= max(n, m) * PERCENT and (bits ^ bits2).bit_count() <= both - 2 * least_overlap(n, m):
                        out.append((max(cls, cls2), min(cls, cls2)))

        def finish():
            if len(held) <= 24:
                for row in held:
                    row[5] = int.from_bytes(row[5], "little")
                small()
            else:
                own, cls, n, pos, root = (np.array([r[i] for r in held], np.int64) for i in range(5))
                bits = np.frombuffer(b"".join(r[5] for r in held), np.uint64).reshape(-1, BITS // 64)
                for i in range(len(held) - 1):
                    rest = slice(i + 1, None)
                    may = may_link(n[i], pos[i], n[rest], pos[rest]) & (root[rest] != root[i])
                    if here[1] != here[2]:
                        may &= own[rest] != own[i]
                    for j in (np.flatnonzero(may) + i + 1)[near_bits(bits[i], bits[rest][may], n[i] + n[rest][may])].tolist():
                        out.append((max(held[i][1], held[j][1]), min(held[i][1], held[j][1])))

        def pairs():
            unique = list(dict.fromkeys(out))
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array([p[i] for p in unique], pa.int64()) for i in (0, 1)], names=["a", "b"])

        for batch in batches:
            for gram, low, high, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (gram, low, high) != here:
                    finish()
                    here, held = (gram, low, high), []
                held.append(list(row))
            if len(out) > 100_000:
                yield pairs()
        finish()
        yield pairs()

    return blocks.repartition("gram", "low", "high").sortWithinPartitions("gram", "low", "high").mapInArrow(work, "a long, b long").distinct()


def links_inside(linked: DataFrame, texts: DataFrame) -> DataFrame:
    """end, links: rows of other classes that are similar to each class. linked: cls, copies (rows), n and root; texts: cls, text.

    A component is dealt into chunks by hash, and every two of its chunks are one block. A block counts the overlap of each
    pair of its sets once, so a pair is never a row.
    """
    total = linked.groupBy(F.col("root").alias("of_root")).agg(
        F.ceil(F.greatest(F.count("*") / TREE, F.sum("n") / CHUNK_GRAMS)).cast("long").alias("chunks")
    )
    dealt = (
        linked.join(total, F.col("root") == F.col("of_root"))
        .withColumn("own", F.pmod(F.xxhash64("cls"), F.col("chunks")))
        .select("cls", "copies", "root", "own", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("other"))
        .select("cls", "copies", "root", "own", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"))
    )
    blocks = dealt.join(texts, "cls").select("root", "low", "high", "own", "cls", "copies", "text")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        here, held = None, []

        def finish():
            if len(held) > 1:
                found = block_links([x[0] for x in held], np.array([x[1] for x in held]), np.array([x[2] for x in held]), here[1] == here[2])
                yield pa.RecordBatch.from_arrays([pa.array([x[3] for x in held], pa.int64()), pa.array(found, pa.int64())], names=["end", "links"])

        for batch in batches:
            for root, low, high, own, cls, copies, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (root, low, high) != here:
                    yield from finish()
                    here, held = (root, low, high), []
                held.append((grams(text), copies, own, cls))
        yield from finish()

    together = blocks.repartition("root", "low", "high").sortWithinPartitions("root", "low", "high")
    return together.mapInArrow(work, "end long, links long").groupBy("end").agg(F.sum("links").alias("links"))


def block_links(sets: list[np.ndarray], copies: np.ndarray, side: np.ndarray, inside: bool) -> np.ndarray:
    """Rows of other sets that each set is similar to: of all sets if `inside`, else of those of the other side only."""
    sizes = np.array([s.size for s in sets])
    known, numbers = np.unique(np.concatenate(sets), return_inverse=True)
    starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    present = np.zeros(known.size, dtype=bool)
    links = np.zeros(len(sets), dtype=np.int64)
    for k in range(len(sets) - 1):
        own = numbers[starts[k] : starts[k] + sizes[k]]
        present[own] = True
        # Only sets behind this one, so each pair is counted once.
        both = np.add.reduceat(present[numbers[starts[k + 1] :]], starts[k + 1 :] - starts[k + 1], dtype=np.int64)
        present[own] = False
        similar = both * (100 + PERCENT) >= PERCENT * (sizes[k] + sizes[k + 1 :])
        if not inside:
            similar &= side[k + 1 :] != side[k]
        links[k] += copies[k + 1 :][similar].sum()
        links[k + 1 :][similar] += copies[k]
    return links


def still_open(members: DataFrame, group: DataFrame) -> DataFrame:
    """gram, cls, n, pos, root of the sets at n-grams where sets of different components meet."""
    marked = members.select("gram", "cls", "n", "pos").join(group, F.col("cls") == F.col("node"), "left").select("gram", "cls", "n", "pos", F.coalesce("root", "cls").alias("root"))
    spread = marked.groupBy(F.col("gram").alias("of_gram")).agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low <> high").select("of_gram")
    return staged(marked.join(spread, F.col("gram") == F.col("of_gram")).select("gram", "cls", "n", "pos", "root").distinct(), "gram-open")


def class_texts(docs: DataFrame, rows: DataFrame, pairs: DataFrame) -> DataFrame:
    """cls, text: the text of one row of each class of the pairs. docs: doc_id, spot, text; rows: doc_id, spot, cls."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    # Rows with an id first: it tells copies apart, so that one of them is fetched.
    named = rows.join(wanted, "cls").groupBy("cls").agg(F.max(F.struct("doc_id", "spot")).alias("one")).select("cls", F.col("one.doc_id").alias("of_doc"), F.col("one.spot").alias("of_spot"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        for batch in batches:
            same = [class_of(grams(t)) == c for c, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)]
            yield batch.filter(pa.array(same, pa.bool_()))

    found = docs.join(named, (F.col("spot") == F.col("of_spot")) & F.col("doc_id").eqNullSafe(F.col("of_doc"))).select("cls", "text")
    # Two texts may have one hash; those of another class go, and repeated rows are one.
    return found.mapInArrow(work, "cls long, text string").dropDuplicates(["cls"])


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs`, with all their columns, of one document of each component: the one with the smallest id.

    Where no row of a component has an id, the text with the least hash stays. Of rows with equal ids and texts one stays; rows without
    words are no copies of each other, so all with different ids, and all without an id, stay.
    """
    found = linked_rows(docs, id_col, text_col)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "spot")).alias("first")
    keep = found.where("root is not null").groupBy("root").agg(first).select(F.col("first.doc_id").alias("kept_id"), F.col("first.spot").alias("kept_spot")).distinct()
    blank = found.where("root is null").select(F.col("doc_id").alias("kept_id"), F.col("spot").alias("kept_spot")).distinct()
    chosen = keep.withColumn("blank", F.lit(False)).unionByName(blank.withColumn("blank", F.lit(True)))
    names = docs.columns
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("kept_row")).withColumns(
        {"of_id": F.col(f"kept_row.`{id_col}`").cast("long"), "of_spot": F.xxhash64(F.col(f"kept_row.`{text_col}`").cast("string"))}
    )
    known = whole.join(chosen, (F.col("of_spot") == F.col("kept_spot")) & F.col("of_id").eqNullSafe(F.col("kept_id")))
    alone = F.when(F.col("blank") & F.col("of_id").isNull(), F.monotonically_increasing_id())
    nth = F.row_number().over(Window.partitionBy("of_id", "of_spot", "alone").orderBy(F.lit(1)))
    return known.withColumn("alone", alone).withColumn("nth", nth).where("nth = 1").select("kept_row.*")
