"""Best-fit packing by patterns of few documents, fitted by non-negative least squares.

Documents become token ids and an end id; longer ones than the capacity are cut, the first
piece taking the remainder. What is left to pack is a histogram of at most ``capacity``
lengths, whatever the corpus. Patterns of up to three lengths are fitted to the histogram by non-negative least squares:
of all patterns there are, those that would improve the fit most are brought in, the repeat counts are fitted again, and so on
until no pattern improves it. Counts are
rounded down, and what the patterns leave over is packed best-fit into their gaps and new
sequences. Each piece then finds its slot from its rank among the pieces of its length.

Defined results: a null text is an empty one, so a single end id; repeated rows are packed as often
as they come; a null id is passed through; an empty table gives an empty result; only the
named id and text columns are read, so other columns may have any names.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm import _text, tokens
from corvane.llm._storage import materialise

#: A sequence that is empty costs as much as missing the mean count of a length so many times.
EMPTY_COST = 50.0


def pieces(docs: DataFrame, path: str, id_col: str, text_col: str, capacity: int, end_id: int, with_ids: bool) -> DataFrame:
    def cut(batches):
        encode = tokens.encoder(path)
        for batch in batches:
            for part in _text.slices(batch, "text", 1 << 19):
                rows, found = [], []
                for key, text in zip(part.column("id").to_pylist(), part.column("text").to_pylist()):
                    ids = np.array(encode(text or "") + [end_id], "<u4")
                    found.append(ids)
                    at, k = 0, 0
                    while at < len(ids):
                        to = at + ((len(ids) - at - 1) % capacity + 1)
                        rows.append((key, k, at, to - at, zlib.crc32(ids[at:to].tobytes())))
                        at, k = to, k + 1
                columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
                if with_ids:  # pieces follow each other as their texts do
                    ends = np.cumsum([0, *(r[3] for r in rows)]).astype(np.int32)
                    columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found).astype(np.int64))))
                else:
                    columns.append(pa.nulls(len(rows), pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names)

    names = ["id", "piece", "start", "length", "ids_crc32", "ids"]
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(cut, "id long, piece int, start long, length long, ids_crc32 long, ids array<long>")


def improving(value: np.ndarray, lengths: np.ndarray, capacity: int, bound: float) -> np.ndarray:
    """For each length the pattern with it, of up to three lengths, 0 for none, whose sum of ``value`` by length is least, if it is under ``bound``.

    For each pair of lengths the best third that still fits is known, so every pattern is looked at.
    """
    at = np.concatenate([[0], np.sort(lengths)])
    w = np.full(capacity + 1, np.inf)
    w[at] = np.where(at > 0, value[at], 0.0)
    low = np.minimum.accumulate(w)
    third = np.maximum.accumulate(np.where(w == low, np.arange(capacity + 1), 0))  # of the lengths up to each, the one of least value
    left = capacity - at[1:, None] - at
    total = np.where(left >= 0, w[at[1:, None]] + w[at] + w[third[np.maximum(left, 0)]], np.inf)
    second = np.argmin(total, axis=1)
    rows = np.flatnonzero(total[np.arange(len(total)), second] < bound)
    b = at[second[rows]]
    a = at[1:][rows]
    return np.unique(-np.sort(-np.column_stack([a, b, third[capacity - a - b]]), axis=1), axis=0)


def fit_counts(shapes: np.ndarray, goal: np.ndarray, cost: np.ndarray, x: np.ndarray, rounds: int = 60) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative least squares by accelerated projected gradients from ``x``: repeats of each pattern, and what they hold of each length beyond ``goal``."""
    y, t, n = x.copy(), 1.0, len(goal)
    use = np.bincount(shapes.ravel(), minlength=n).astype(float)
    use[0] = 0
    step = 1.0 / use[shapes].sum(1)  # the sums of the rows of the matrix bound it by its diagonal

    def beyond(z: np.ndarray) -> np.ndarray:
        rest = np.bincount(shapes.ravel(), weights=np.repeat(z, 3), minlength=n) - goal
        rest[0] = 0
        return rest

    for _ in range(rounds):
        new = np.maximum(0.0, y - step * (beyond(y)[shapes].sum(1) + cost))
        if ((y - new) * (new - x) / step).sum() > 0:  # momentum that points uphill is dropped
            t = 1.0
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        x, y, t = new, new + (t - 1) / t2 * (new - x), t2
    return x, beyond(x)


def fit(histogram: np.ndarray, capacity: int, most_rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Patterns and their repeats; ends when no pattern of up to three lengths improves the fit by more than a tenth of a mean count, or after ``most_rounds``."""
    lengths, goal = np.flatnonzero(histogram), histogram.astype(float)
    scale = float(goal[lengths].mean())
    empty = lambda s: EMPTY_COST * scale * (capacity - s.sum(1)) / capacity
    shapes, x, rest = np.zeros((0, 3), np.int64), np.zeros(0), -goal
    for _ in range(most_rounds):
        value = rest - EMPTY_COST * scale * np.arange(capacity + 1) / capacity
        fresh = improving(value, lengths, capacity, -EMPTY_COST * scale - scale / 10)
        known = set(map(tuple, shapes[x > 0].tolist()))
        fresh = np.array([p for p in fresh.tolist() if tuple(p) not in known], np.int64).reshape(-1, 3)
        if not len(fresh):
            break
        shapes, x = np.concatenate([shapes[x > 0], fresh]), np.concatenate([x[x > 0], np.zeros(len(fresh))])
        x, rest = fit_counts(shapes, goal, empty(shapes), x)
    return shapes, x


def plan(histogram: np.ndarray, capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """(lengths of a sequence, how many such sequences) holding just what the histogram has."""
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    groups: list[tuple[tuple[int, ...], int]] = []
    here = np.flatnonzero(left)
    if len(here):
        shapes, x = fit(left, capacity)
        counts = np.floor(x + 1e-6).astype(np.int64)
        for i in np.lexsort((-counts, -shapes.sum(1))):
            if counts[i] > 0:
                shape = tuple(int(v) for v in shapes[i] if v)
                n = int(min(counts[i], *(left[v] // shape.count(v) for v in shape)))
                if n > 0:
                    groups.append((shape, n))
                    for v in shape:
                        left[v] -= n
    # Best fit, longest first, many equal sequences at a time.
    gaps: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    for shape, n in groups:
        gaps.setdefault(capacity - sum(shape), []).append((shape, n))
    for length in range(capacity, 0, -1):
        n = int(left[length])
        gap = length
        while n and gap <= capacity:
            while n and gaps.get(gap):
                shape, have = gaps[gap].pop()
                take = min(n, have)
                if have > take:
                    gaps[gap].append((shape, have - take))
                gaps.setdefault(gap - length, []).append(((*shape, length), take))
                n -= take
            gap += 1
        per = capacity // length
        for size, k in ((per, n // per), (n % per, 1)):
            if size and k and n:
                gaps.setdefault(capacity - size * length, []).append(((length,) * size, k))
    return [(shape, n) for _, same in sorted(gaps.items()) for shape, n in same]


def slots(groups: list[tuple[tuple[int, ...], int]], capacity: int) -> list[tuple[np.ndarray, ...]]:
    """By length: the first rank, first sequence and offset of each run of slots."""
    by: list[list[tuple[int, int, int]]] = [[] for _ in range(capacity + 1)]
    used, first = np.zeros(capacity + 1, np.int64), 0
    for shape, n in groups:
        at = 0
        for v in shape:
            by[v].append((int(used[v]), first, at))
            used[v] += n
            at += v
        first += n
    return [tuple(np.array(c, np.int64) for c in zip(*rows)) if rows else () for rows in by]


def pack(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, end_id: int = 2, with_ids: bool = False) -> DataFrame:
    """(id, piece, start, length, ids_crc32, ids, sequence_id, offset) for each piece; ``ids`` only ``with_ids``."""
    cut = materialise(pieces(docs, path, id_col, text_col, capacity, end_id, with_ids))
    # At most ``capacity`` rows come to the driver.
    histogram = np.zeros(capacity + 1, np.int64)
    for r in cut.groupBy("length").count().collect():
        histogram[r[0]] = r[1]
    found = slots(plan(histogram, capacity), capacity)
    # Ranks by length: counted in cells of even size, then numbered inside each cell. Written rows have a number that stays, so equal rows do not share a cell.
    cut = cut.withColumn("row", F.monotonically_increasing_id())
    cell = max(500, int(histogram.sum()) // 100_000)
    split = F.array(*(F.lit(int(1 + n // cell)) for n in histogram))
    rows = cut.withColumn("cell", F.pmod(F.xxhash64("row"), F.get(split, F.col("length").cast("int"))))
    sizes = rows.groupBy("length", "cell").count()
    before = Window.partitionBy("length").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(F.col("length").alias("l"), F.col("cell").alias("c"), F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before"))
    inside = Window.partitionBy("length", "cell").orderBy("row")
    ranked = rows.withColumn("n", F.row_number().over(inside)).join(sizes, (F.col("length") == F.col("l")) & (F.col("cell") == F.col("c")))
    cut = cut.drop("row")
    ranked = ranked.select(*cut.columns, (F.col("before") + F.col("n") - 1).alias("rank"))

    def place(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for v in np.unique(length):
                at = np.flatnonzero(length == v)
                ranks, first, place_ = found[v]
                run = np.searchsorted(ranks, rank[at], side="right") - 1
                sequence[at], offset[at] = first[run] + rank[at] - ranks[run], place_[run]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(sequence), pa.array(offset)], [*batch.schema.names[:-1], "sequence_id", "offset"])

    return ranked.mapInArrow(place, f"{', '.join(f'{f.name} {f.dataType.simpleString()}' for f in cut.schema.fields)}, sequence_id long, offset long")


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    return pack(docs, path or tokens.public_path()).drop("ids").withColumnRenamed("id", "doc_id")
