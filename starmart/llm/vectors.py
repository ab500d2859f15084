"""Near-duplicate vectors by an inverted multi-index.

Vectors are cut in two halves with a codebook each; the product of both codebooks is a grid of cells. A
vector is stored in the cell of its two nearest codes and visits cells in the order of the sum of the
distances of its halves to both codes (the multi-sequence order: a heap over both sorted lists of codes) until the target
recall is reached: up to the excess over its own cell that was calibrated on pairs which lie exactly at the threshold. In a
visited cell all stored vectors are compared by cosine in double precision.

Equal vectors are one class and are compared once. Neighbouring cells of one left code stand on a shelf, and a vector
is sent once to each shelf with the cells that it visits there, not once per cell. A shelf with many vectors is cut into
chunks. What leaves a chunk is one row per vector that has links there (how many, and one member of its group), never all pairs.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starmart.llm.common import discard, map_batches, staged
from starmart.llm.components import components

PER_CELL = 16
#: Vectors stored on a shelf, or fewer if they take more than SHELF_BYTES as doubles.
SHELF, SHELF_BYTES = 16_384, 16 << 20
#: Rows that are compared at once.
SLICE = 1024
SAMPLE = 20_000
#: Codes of a half; the grid has at most its square (about a million) of cells, whose counts the driver holds.
MOST_CODES = 1024


def packed(values: np.ndarray) -> bytes:
    """Components as single floats if all of them are such, else as doubles."""
    with np.errstate(over="ignore"):
        single = values.astype("<f4")
    return (single if (single == values).all() else values.astype("<f8")).tobytes()


def unit(rows: list[bytes], size: int) -> np.ndarray:
    """Vectors of length 1 of packed rows with `size` components."""
    short = np.array([len(r) == 4 * size for r in rows], dtype=bool)
    data = np.empty((len(rows), size))
    for kind, chosen in (("<f4", short), ("<f8", ~short)):
        at = np.flatnonzero(chosen)
        data[at] = np.frombuffer(b"".join(rows[i] for i in at), dtype=kind).reshape(at.size, size)
    return data / np.linalg.norm(data, axis=1, keepdims=True)


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """row, vec_id, size, data: data is null unless all components are finite numbers and one is not zero."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, sizes = [], []
        for value in batch.column(2).to_pylist():
            row = np.array([np.nan if v is None else v for v in value] if value else [], dtype=float)
            good = row.size > 0 and bool(np.isfinite(row).all()) and 0 < float(np.linalg.norm(row)) < np.inf
            data.append(packed(row + 0.0) if good else None)
            sizes.append(row.size)
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(sizes, pa.int32()), pa.array(data, pa.binary())], names=["row", "vec_id", "size", "data"])

    source = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    return map_batches(source, work, "row long, vec_id long, size int, data binary")


def distances(halves: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Squared distances, each summed in one order whatever else is in the batch."""
    out = np.zeros((len(halves), len(codes)))
    for k in range(codes.shape[1]):
        out += (halves[:, k, None] - codes[None, :, k]) ** 2
    return out


def k_means(points: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 8) -> np.ndarray:
    codes = points[rng.choice(len(points), k, replace=False)].copy()
    for _ in range(rounds):
        near = np.argmin((codes**2).sum(axis=1) - 2 * points @ codes.T, axis=1)
        total = np.zeros_like(codes)
        np.add.at(total, near, points)
        count = np.bincount(near, minlength=k)
        codes[count > 0] = total[count > 0] / count[count > 0, None]
    # Near codes get near numbers, so that the cells that a vector visits share shelves.
    axis = np.linalg.svd(codes - codes.mean(axis=0), full_matrices=False)[2][0]
    return codes[np.argsort(codes @ axis, kind="stable")]


@dataclass(frozen=True)
class MultiIndex:
    """Codebooks of both halves, and how much further than its own cell a vector visits."""

    left: np.ndarray
    right: np.ndarray
    excess: float

    @classmethod
    def fit(cls, sample: np.ndarray, classes: int, least: float, recall: float, seed: int = 3) -> MultiIndex:
        rng = np.random.default_rng(seed)
        k = int(min(max(1, round((classes / PER_CELL) ** 0.5)), MOST_CODES, max(1, len(sample) // 8)))
        left, right = cls.halves(sample)
        index = cls(k_means(left, k, rng), k_means(right, k, rng), 0.0)
        some = sample[rng.choice(len(sample), min(len(sample), 4000), replace=False)]
        noise = rng.normal(size=some.shape)
        noise -= (noise * some).sum(axis=1, keepdims=True) * some
        length = np.linalg.norm(noise, axis=1, keepdims=True)
        noise = np.divide(noise, length, out=np.zeros_like(noise), where=length > 1e-9)
        partner = some * least + noise * np.sqrt(max(0.0, 1 - least * least))
        over = index.over(some)
        cell = index.cells(partner)
        rows = np.arange(len(some))
        needed = over[0][rows, cell[0]] + over[1][rows, cell[1]]
        return cls(index.left, index.right, float(np.quantile(needed, recall)) + 1e-9)

    @staticmethod
    def halves(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        # A vector of one component has no right half; a column of zeros stands for it.
        half = (vectors.shape[1] + 1) // 2
        right = vectors[:, half:]
        return vectors[:, :half], right if right.shape[1] else np.zeros((len(vectors), 1))

    def over(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each vector and code of either half, how much further than the nearest code it is."""
        made = []
        for points, codes in zip(self.halves(vectors), (self.left, self.right), strict=True):
            d = distances(points, codes)
            made.append(np.round(d - d.min(axis=1, keepdims=True), 9))
        return made[0], made[1]

    def cells(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        over = self.over(vectors)
        return np.argmin(over[0], axis=1), np.argmin(over[1], axis=1)

    def visits(self, over: tuple[np.ndarray, np.ndarray]) -> list[np.ndarray]:
        """Cells (left * codes + right) of each vector in multi-sequence order, up to the excess."""
        width, out = len(self.right), []
        for left, right in zip(*over, strict=True):
            sides = []
            for far in (left, right):
                near = np.flatnonzero(far <= self.excess)
                near = near[np.argsort(far[near], kind="stable")]
                sides.append((near.tolist(), far[near].tolist()))
            (i_of, x), (j_of, y) = sides
            cells: list[int] = []
            heap = [(x[0] + y[0], 0, 0)]
            while heap and heap[0][0] <= self.excess:
                _, i, j = heapq.heappop(heap)
                cells.append(i_of[i] * width + j_of[j])
                # Each place has one parent: the one above it in the first column, else the one before it.
                if j + 1 < len(y):
                    heapq.heappush(heap, (x[i] + y[j + 1], i, j + 1))
                if j == 0 and i + 1 < len(x):
                    heapq.heappush(heap, (x[i + 1] + y[0], i + 1, 0))
            out.append(np.array(cells, dtype=np.int32))
        return out


@dataclass(frozen=True)
class Shelves:
    """Which shelf each cell stands on (-1: no vector is stored in the cell), and the chunks of each shelf."""

    of_cell: np.ndarray
    chunks: np.ndarray

    @classmethod
    def of(cls, counts: np.ndarray, width: int, most: int) -> Shelves:
        """counts: vectors stored in each cell. Cells of one left code, in order, until `most` vectors are together."""
        grid = counts.reshape(-1, width)
        nth = (np.cumsum(grid, axis=1) - grid) // most
        used = np.flatnonzero(counts)
        keys = np.stack([used // width, nth.reshape(-1)[used]], axis=1)
        _, numbers = np.unique(keys, axis=0, return_inverse=True)
        of_cell = np.full(counts.size, -1, dtype=np.int32)
        of_cell[used] = numbers.reshape(-1)
        stored = np.zeros(int(of_cell.max(initial=-1)) + 1, dtype=np.int64)
        np.add.at(stored, of_cell[used], counts[used])
        return cls(of_cell, -(-stored // (2 * most)))


def local_groups(hit: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest id that rows and columns of a 0/1 block of links reach inside it."""
    none = np.iinfo(np.int64).max
    rows, cols = np.nonzero(hit)
    a, b = left.copy(), right.copy()
    while rows.size:
        before = a.sum(), b.sum()
        low = np.full(len(b), none)
        np.minimum.at(low, cols, a[rows])
        b = np.minimum(b, low)
        low = np.full(len(a), none)
        np.minimum.at(low, rows, b[cols])
        a = np.minimum(a, low)
        if (a.sum(), b.sum()) == before:
            break
    return a, b


def compare(index: MultiIndex, least: float, size: int):
    """Function over batches of (shelf, chunk, probe, cls, n, own, cells, data), sorted: rows stored in a chunk come before those that only visit it."""
    width = len(index.right)

    def shelved(parts: list[tuple]) -> dict[int, tuple]:
        """By cell: cls, n and vectors stored in it, their halves, and their distances to their nearest codes."""
        cls, n, own, _, _, data = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(own, kind="stable")
        made = {}
        for at in np.split(order, np.flatnonzero(np.diff(own[order])) + 1):
            halves = index.halves(data[at])
            nearest = [
                np.concatenate([distances(h[k : k + SLICE], codes).min(axis=1) for k in range(0, len(at), SLICE)])
                for h, codes in zip(halves, (index.left, index.right), strict=True)
            ]
            made[int(own[at[0]])] = cls[at], n[at], data[at], halves, nearest
        return made

    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        here, parts, stored, out = None, [], None, []

        def visiting(rows: tuple) -> None:
            cls, n, own, cells, of, data = rows
            order = np.argsort(cells, kind="stable")
            for some in np.split(order, np.flatnonzero(np.diff(cells[order])) + 1):
                here_stored = stored.get(int(cells[some[0]])) if some.size else None
                if here_stored is not None:
                    for k in range(0, some.size, SLICE):
                        at = of[some[k : k + SLICE]]
                        for j in range(0, len(here_stored[0]), 4 * SLICE):
                            links((cls[at], n[at], own[at], data[at]), here_stored, slice(j, j + 4 * SLICE))

        def links(probes: tuple, cell: tuple, part: slice) -> None:
            cls, n, vectors = (x[part] for x in cell[:3])
            hit = probes[3] @ vectors.T >= least
            hit &= probes[0][:, None] != cls[None, :]
            rows, cols = np.nonzero(hit)
            if not rows.size:
                return
            found = np.bincount(rows, n[cols], len(probes[0]))
            # The stored side counts the link here only if it does not visit the probe's cell itself.
            codes, nth = np.unique(probes[2][rows], return_inverse=True)
            far = np.zeros((len(cls), codes.size))
            for half, nearest, book, code in zip(cell[3], cell[4], (index.left, index.right), np.divmod(codes, width), strict=True):
                far += np.round(distances(half[part], book[code]) - nearest[part][:, None], 9)
            back = np.bincount(cols, probes[1][rows] * (far[cols, nth] > index.excess), len(cls))
            a, b = local_groups(hit, probes[0], cls)
            some, other = np.unique(rows), np.unique(cols)
            out.append((np.concatenate([probes[0][some], cls[other]]), np.concatenate([found[some], back[other]]).astype(np.int64), np.concatenate([a[some], b[other]])))

        def opened() -> None:
            """The stored rows are complete: index them by cell, and let them visit first."""
            nonlocal stored
            if stored is None:
                stored = shelved(parts) if parts else {}
                for rows in parts:
                    visiting(rows)
                parts.clear()

        def made(least_rows: int) -> Iterable[pa.RecordBatch]:
            if sum(len(x[0]) for x in out) > least_rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["cls", "links", "other"])
                out.clear()

        for batch in batches:
            keys = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
            edges = np.flatnonzero(np.any([np.diff(k.astype(np.int64)) != 0 for k in keys], axis=0)) + 1
            for begin, end in zip([0, *edges], [*edges, batch.num_rows], strict=True):
                if (keys[0][begin], keys[1][begin]) != here:
                    opened()
                    here, stored = (keys[0][begin], keys[1][begin]), None
                some = batch.slice(begin, end - begin)
                lists = some.column(6)
                of = np.repeat(np.arange(end - begin), pa.compute.list_value_length(lists).to_numpy())
                rows = (*(some.column(i).to_numpy() for i in (3, 4, 5)), lists.flatten().to_numpy(), of, unit(some.column(7).to_pylist(), size))
                if keys[2][begin]:
                    opened()
                    visiting(rows)
                else:
                    parts.append(rows)
                yield from made(20_000)
        opened()
        yield from made(0)

    return run


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", least: float = 0.95, recall: float = 0.995
) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row per input row.

    Vectors that are null, empty, zero or hold null or non-finite components link with nothing, and only
    vectors of one length are compared. Equal rows link with each other. Rows with null ids count as links
    but name no component. `recall` is the share of pairs at the threshold that one side alone visits.
    Codebooks come from SAMPLE classes per length at most, the first by a hash; everything else covers all.
    """
    spark = vectors.sparkSession
    read = staged(usable(vectors, id_col, vector_col).withColumn("digest", F.unhex(F.sha2("data", 256))), "vectors")
    classes = staged(
        read.where("data is not null").groupBy("digest").agg(F.min("row").alias("cls"), F.count("*").alias("n"), F.first("size").alias("size"), F.first("data").alias("data")),
        "vector-classes",
    )
    rows = staged(read.select("row", "vec_id", "digest"), "vector-rows")
    discard(read)
    found = None
    for size, count in classes.groupBy("size").count().orderBy("size").collect():  # one row per length of vectors
        own = classes.where(F.col("size") == size)
        sample = own.orderBy("digest").select("data").limit(SAMPLE).collect()
        index = MultiIndex.fit(unit([bytes(r[0]) for r in sample], size), count, least, recall)
        made = linked(own, index, least, size)
        found = made if found is None else found.unionByName(made)
    if found is None:
        found = spark.createDataFrame([], "cls long, links long, other long")
    found = staged(found.groupBy("cls", "other").agg(F.sum("links").alias("links")), "vector-links")
    group = components(found.select(F.col("cls").alias("a"), F.col("other").alias("b")))
    totals = found.groupBy(F.col("cls").alias("of_cls")).agg(F.sum("links").alias("links"))
    members = rows.select("row", "vec_id", "digest").join(classes.select("digest", "cls", "n"), "digest", "left")
    placed = (
        members.join(totals, F.col("cls") == F.col("of_cls"), "left")
        .join(group, F.col("cls") == F.col("node"), "left")
        .select("vec_id", (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("n") - 1, F.lit(0))).alias("n_links"), F.coalesce("root", "cls", "row").alias("root"))
    )
    smallest = placed.groupBy(F.col("root").alias("of_root")).agg(F.min("vec_id").alias("component_id"))
    return placed.join(smallest, F.col("root") == F.col("of_root")).select("vec_id", "n_links", "component_id", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def linked(classes: DataFrame, index: MultiIndex, least: float, size: int) -> DataFrame:
    """cls, links, other: links found in each chunk of each visited shelf, and a member of the same group."""
    width = len(index.right)

    def place(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, visited = [], []
        for k in range(0, batch.num_rows, SLICE):
            over = index.over(unit(batch.column(2).slice(k, SLICE).to_pylist(), size))
            own.append(np.argmin(over[0], axis=1) * width + np.argmin(over[1], axis=1))
            visited += index.visits(over)
        own = pa.array(np.concatenate(own).astype(np.int32)) if own else pa.array([], pa.int32())
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), own, pa.array(visited, pa.list_(pa.int32())), batch.column(2)], names=["cls", "n", "own", "visited", "data"])

    placed = staged(map_batches(classes.select("cls", "n", "data"), place, "cls long, n long, own int, visited array<int>, data binary"), "vector-cells")
    # Bounded by the cells of the grid, whatever the number of vectors.
    counts = np.zeros(len(index.left) * width, dtype=np.int64)
    stored = placed.groupBy("own").count().toPandas()
    counts[stored["own"].to_numpy()] = stored["count"].to_numpy()
    shared = classes.sparkSession.sparkContext.broadcast(Shelves.of(counts, width, max(1, min(SHELF, SHELF_BYTES // (8 * size)))))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        """Each vector to all chunks of the shelves with cells that it visits; it is stored in one chunk of its own cell's."""
        shelves = shared.value
        for batch in batches:
            at, shelf, chunk, probe, cells = [], [], [], [], []
            cls, own = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for nth, visited in enumerate(batch.column(3)):
                visited = visited.values.to_numpy()
                on = shelves.of_cell[visited]
                for s in np.unique(on[on >= 0]).tolist():
                    some, many = visited[on == s], int(shelves.chunks[s])
                    home = int(cls[nth]) * 0x9E3779B1 % many if s == shelves.of_cell[own[nth]] else -1
                    for c in range(many):
                        at.append(nth)
                        shelf.append(s)
                        chunk.append(c)
                        probe.append(c != home)
                        cells.append(some)
                if len(at) > 10_000 or nth + 1 == batch.num_rows:
                    rows = batch.select(["cls", "n", "own", "data"]).take(pa.array(at, pa.int64()))
                    columns = [pa.array(shelf, pa.int32()), pa.array(chunk, pa.int32()), pa.array(probe, pa.bool_()), *rows.columns[:3], pa.array(cells, pa.list_(pa.int32())), rows.column(3)]
                    yield pa.RecordBatch.from_arrays(columns, names=["shelf", "chunk", "probe", "cls", "n", "own", "cells", "data"])
                    at, shelf, chunk, probe, cells = [], [], [], [], []

    schema = "shelf int, chunk int, probe boolean, cls long, n long, own int, cells array<int>, data binary"
    together = placed.mapInArrow(send, schema).repartition("shelf", "chunk").sortWithinPartitions("shelf", "chunk", "probe")
    return together.mapInArrow(compare(index, least, size), "cls long, links long, other long")
