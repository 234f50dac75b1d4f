"""Documents in blocks, and counting hashes over the whole corpus block by block.

An input partition deals its rows into a few blocks of some megabytes, by a hash of id and text, so that blocks
grow in number, not in size, with the corpus, and rows that are equal in all columns are spread over as many
blocks as there are partitions. A block travels as compressed chunks of rows. What is asked
about it, or answered, is keyed by its number; its chunks are shuffled once for all that need them.

``send`` and ``answer`` exchange counts: a block sends each bucket of the hash space one sorted
array of its distinct hashes, a bucket adds up what it gets and answers in the same order. So
a very frequent hash costs a bucket one entry a block, not one a place.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import _text
from corvane.llm._storage import materialise

BLOCK_BYTES = 8 << 20
SENT = "block long, bucket long, hashes binary, counts binary"
ANSWER = "block long, bucket long, totals binary"
_ZSTD = pa.Codec("zstd", 1)


def press(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + _ZSTD.compress(data, asbytes=True)


def unpress(data: bytes) -> bytes:
    return _ZSTD.decompress(data[8:], int.from_bytes(data[:8], "little"), asbytes=True)


def steady(docs: DataFrame) -> DataFrame:
    """Rows whose partitions are the same whenever they are read: a plan with a shuffle is written first."""
    return materialise(docs) if "Exchange" in docs._jdf.queryExecution().executedPlan().toString() else docs


def deal(docs: DataFrame, id_col: str, text_col: str, carry: tuple[str, ...] = (), block_bytes: int = BLOCK_BYTES) -> tuple[DataFrame, int, str]:
    """Rows (block, chunk), about how many blocks there are, and the schema of a chunk's rows: id, text, carry_0 ..."""
    rows = steady(docs).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), *(F.col(f"`{c}`").alias(f"carry_{i}") for i, c in enumerate(carry)))
    sizes = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 16).alias("bytes"))
    # The largest partition sets into how many blocks each is dealt.
    total, most = sizes.agg(F.sum("bytes"), F.max("bytes")).first()
    each = 1 + (most or 0) // block_bytes
    placed = rows.withColumn("block", F.spark_partition_id().cast("long") * F.lit(each) + F.pmod(F.xxhash64("id", "text"), F.lit(each)))

    def squeeze_rows(batches):
        waiting: dict[int, list[pa.RecordBatch]] = {}
        size: dict[int, int] = {}
        for batch in batches:
            for part in _text.slices(batch, "text", _text.SLICE_BYTES):
                block = part.column(part.schema.get_field_index("block")).to_numpy()
                body = part.select([n for n in part.schema.names if n != "block"])
                order = np.argsort(block, kind="stable")
                for at in np.split(order, np.flatnonzero(np.diff(block[order])) + 1):
                    b, some = int(block[at[0]]), body.take(pa.array(at))
                    waiting.setdefault(b, []).append(some)
                    size[b] = size.get(b, 0) + some.nbytes
                    if size[b] >= _text.SLICE_BYTES:
                        yield _chunk(b, waiting.pop(b))
                        size.pop(b)
        for b, some in waiting.items():
            yield _chunk(b, some)

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema.fields)
    return placed.mapInArrow(squeeze_rows, "block long, chunk binary"), 1 + (total or 0) // block_bytes, schema


def _chunk(block: int, batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    table = pa.Table.from_batches(batches).combine_chunks()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int64()), pa.array([press(sink.getvalue())], pa.binary())], ["block", "chunk"])


def chunks(part: pa.Table):
    """A block's rows, some megabytes at most at a time, always in the same order."""
    for data in sorted(part.column("chunk").to_pylist()):
        table = pa.ipc.open_stream(unpress(data)).read_all()
        for batch in table.combine_chunks().to_batches():
            yield from _text.slices(batch, "text")


def bucket_edges(sorted_hashes: np.ndarray, n: int) -> np.ndarray:
    """Where each of ``n`` equal parts of the hash space begins in a sorted array."""
    lows = np.arange(1, n, dtype=np.uint64) * np.uint64((2**64 - 1) // n)
    return np.concatenate([[0], np.searchsorted(sorted_hashes, lows), [len(sorted_hashes)]])


def group(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct keys, each key's place among them, and how often each comes."""
    order = np.argsort(keys)
    s = keys[order]
    new = np.concatenate([[True], s[1:] != s[:-1]]) if len(s) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    place = np.empty(len(s), np.int64)
    place[order] = np.cumsum(new) - 1
    return s[at], place, np.diff(np.append(at, len(s)))


def distinct(hashes: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes and their counts, or sums of weights."""
    if weights is None:
        s = np.sort(hashes)
        at = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
        return s[at], np.diff(np.append(at, len(s)))
    known, place, _ = group(hashes)
    return known, np.bincount(place, weights=weights, minlength=len(known)).astype(np.int64)


def gaps(hashes: np.ndarray) -> bytes:
    """Sorted hashes as the gaps between them, all first bytes, then all second ones and so on: the high bytes are mostly zeros and compress."""
    return press(np.diff(hashes, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes())


def ungapped(data: bytes) -> np.ndarray:
    return np.cumsum(np.ascontiguousarray(np.frombuffer(unpress(data), np.uint8).reshape(8, -1).T).view(np.uint64).ravel(), dtype=np.uint64)


def send(block: int, hashes: np.ndarray, counts: np.ndarray, n_buckets: int, everywhere: bool = False) -> pa.Table:
    """A row to each bucket that has any of the hashes, or to all of them."""
    edges = bucket_edges(hashes, n_buckets)
    full = np.arange(n_buckets) if everywhere else np.flatnonzero(np.diff(edges))
    parts = [(block, int(b), gaps(hashes[edges[b] : edges[b + 1]]), squeeze(counts[edges[b] : edges[b + 1]])) for b in full]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
    columns = list(zip(*parts)) if parts else [()] * 4
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], ["block", "bucket", "hashes", "counts"])


def add_up(part: pa.Table) -> tuple[list[int], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of one bucket: blocks, how many hashes each has, the distinct hashes, their totals, and all entries' places in these."""
    blocks = part.column("block").to_pylist()
    hashes = [ungapped(x) for x in part.column("hashes").to_pylist()]
    counts = np.concatenate([spread(x) for x in part.column("counts").to_pylist()])
    known, place, _ = group(np.concatenate(hashes))
    return blocks, np.array([len(x) for x in hashes]), known, np.bincount(place, weights=counts, minlength=len(known)).astype(np.int64), place


def answer(part: pa.Table, least: int) -> pa.Table:
    """To each block, in the order of its hashes, the total of each; 0 under ``least``."""
    blocks, sizes, _, totals, place = add_up(part)
    value = np.where(totals >= least, totals, 0)[place]
    cut = np.cumsum([0, *sizes])
    bucket = part.column("bucket")[0].as_py()
    return pa.Table.from_arrays([pa.array(blocks, pa.int64()), pa.array([bucket] * len(blocks), pa.int64()), pa.array([squeeze(value[a:b]) for a, b in zip(cut[:-1], cut[1:])], pa.binary())], ["block", "bucket", "totals"])


def squeeze(values: np.ndarray) -> bytes:
    """Whole numbers as bytes, the larger ones apart."""
    small = np.minimum(values, 255).astype(np.uint8)
    return press(len(values).to_bytes(8, "little") + small.tobytes() + values[values >= 255].astype(np.int64).tobytes())


def spread(data: bytes) -> np.ndarray:
    data = unpress(data)
    n = int.from_bytes(data[:8], "little")
    values = np.frombuffer(data, np.uint8, n, 8).astype(np.int64)
    values[values == 255] = np.frombuffer(data, np.int64, -1, 8 + n)
    return values


def totals_of(answers: pa.Table) -> np.ndarray:
    """A block's totals in the order of its sorted hashes, from all buckets' answers."""
    got = sorted(zip(answers.column("bucket").to_pylist(), answers.column("totals").to_pylist()))
    return np.concatenate([spread(x) for _, x in got]) if got else np.zeros(0, np.int64)


def count_hashes(blocked: DataFrame, hashes_of, n_buckets: int, least: int = 2) -> DataFrame:
    """``ANSWER`` rows: totals over the corpus of what ``hashes_of(text column)`` gives for the chunks of each block."""

    def emit(part: pa.Table) -> pa.Table:
        found = [distinct(hashes_of(rows.column("text"))) for rows in chunks(part)]
        h, c = distinct(np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found]))
        return send(part.column("block")[0].as_py(), h, c, n_buckets)

    sent = blocked.groupBy("block").applyInArrow(emit, SENT)
    return sent.groupBy("bucket").applyInArrow(lambda part: answer(part, least), ANSWER)
