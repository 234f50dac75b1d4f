"""SimHash near-duplicates by covering each half of a fingerprint with anchors.

A fingerprint has 64 bits: bit b is 1 if more than half of a text's shingle hashes (XXH64, repeats included) have it.
Fingerprints link at ``MOST`` or fewer differing bits.

Three differing bits leave one of the two halves of 32 bits with at most one. For a half, the anchors are the words of
the Hamming code of 31 bits, with the last bit free: a covering code of radius 1, so each half has one home anchor, at
distance 0 or 1. If two halves differ in at most one bit, each lies within 1 + 1 of the other's home. So a
fingerprint is replicated to all anchors within 2 of each half, at most 17, and fingerprints are compared per anchor:
those at home there with all replicas. With 2 ** 27 anchors a half, unlike fingerprints hardly ever meet.

Equal fingerprints are one class throughout. Where many unlike ones share an anchor, as in a large group of near copies, not
all pairs are made: all are compared with the anchor's smallest one first, those found linked become components, and only
fingerprints of different components are compared further.

Defined results: a null or empty text, or one without words, has fingerprint zero, which links like any other; with one or
two words the whole sequence is the shingle; a null id is larger than any other and stays null where only such rows
link; repeated rows are one class; an empty table gives an empty result; texts of any length are hashed in
parts of ``PART`` shingles; only the named id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm import _text
from corvane.llm._storage import materialise
from corvane.llm.jaccard import components

#: Differing bits at most. Halves and their code of radius 1 are made for three.
MOST = 3
#: Shingles whose hashes are laid out as bits at a time.
PART = 1 << 16
SEED = 42


def fingerprints_of(column: pa.Array, k: int = 3) -> np.ndarray:
    """The fingerprint of each text of a chunk."""
    w = _text.split_words(column, lower=True)
    # The words, each with one space behind it, so a shingle is a slice up to its last word's space.
    size = w.ends - w.starts + 1
    end = np.cumsum(size)
    out = np.full(int(end[-1]) if len(end) else 0, 32, np.uint8)
    source = np.arange(len(out)) + np.repeat(w.starts - (end - size), size)
    body = np.ones(len(out), bool)
    body[end - 1] = False
    out[body] = w.buf[source[body]]
    # First and last word of each shingle; a text of fewer words has one.
    doc, many = w.doc, w.counts
    head = np.flatnonzero((np.arange(len(doc)) + k <= w.first[1:][doc]) | ((np.arange(len(doc)) == w.first[:-1][doc]) & (many[doc] < k)))
    tail = np.minimum(head + k, w.first[1:][doc[head]]) - 1
    begin, stop, owner = (end - size)[head], end[tail] - 1, doc[head]
    ones, total = np.zeros((len(many), 64), np.int64), np.bincount(owner, minlength=len(many))
    raw, hashed = memoryview(out), xxhash.xxh64_intdigest
    for at in range(0, len(head), PART):
        part = slice(at, at + PART)
        h = np.fromiter((hashed(raw[a:b], SEED) for a, b in zip(begin[part].tolist(), stop[part].tolist())), np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        mine = owner[part]
        new = np.flatnonzero(np.concatenate([[True], mine[1:] != mine[:-1]]))
        ones[mine[new]] += np.add.reduceat(bits, new, axis=0, dtype=np.int64)
    return np.packbits(2 * ones > total[:, None], axis=1, bitorder="little").view(np.uint64).ravel()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3) -> DataFrame:
    """(id, fp) of each row. Texts are hashed where they lie."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            for part in _text.slices(batch, "text"):
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(fingerprints_of(part.column("text"), k).view(np.int64))], ["id", "fp"])

    return rows.mapInArrow(run, "id long, fp long")


def _parity(x: Column) -> Column:
    return F.bit_count(x) % 2


def anchors(half: Column) -> tuple[Column, Column]:
    """The home of a 32-bit half, and all anchors within 2 of it, home included.

    Bits 1 to 31, by their numbers, carry the code: the exclusive or of the numbers of set bits is 0 in a code word, and else
    the number of the bit to flip. Two flips reach another code word where the numbers' exclusive or is the same.
    """
    wrong = sum((_parity(half.bitwiseAND(F.lit(sum(1 << (b - 1) for b in range(1, 32) if b >> j & 1)))) * (1 << j) for j in range(5)), F.lit(0))
    flip = lambda i: F.when(i == 0, F.lit(0).cast("long")).otherwise(F.call_function("shiftleft", F.lit(1).cast("long"), (i - 1).cast("int")))
    home = half.bitwiseXOR(flip(wrong))
    two = F.filter(F.sequence(F.lit(1), F.lit(31)), lambda i: (i < i.bitwiseXOR(wrong)) & (i != wrong))
    others = F.transform(two, lambda i: half.bitwiseXOR(flip(i)).bitwiseXOR(flip(i.bitwiseXOR(wrong))))
    return home, F.concat(F.array(home, home.bitwiseXOR(F.lit(1 << 31))), F.when(wrong != 0, others).otherwise(F.array().cast("array<bigint>")))


def replicas(distinct: DataFrame) -> DataFrame:
    """(half, anchor, fp, home) for each fingerprint and anchor within reach of either half."""
    sides = [F.col("fp").bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned("fp", 32)]
    each = []
    for i, side in enumerate(sides):
        home, within = anchors(F.col("side"))
        x = distinct.select("fp", side.alias("side")).select("fp", home.alias("at_home"), F.explode(within).alias("anchor"))
        each.append(x.select(F.lit(i).alias("half"), "anchor", "fp", (F.col("anchor") == F.col("at_home")).alias("home")))
    return each[0].unionAll(each[1])


def links(distinct: DataFrame, most: int = MOST) -> DataFrame:
    """(a, b): links between the fingerprints of ``distinct``, enough to connect all that any chain of links connects."""
    if not 0 <= most <= MOST:
        raise ValueError("two halves and a code of radius 1 find up to three differing bits")
    near = lambda x, y: F.bit_count(F.col(x).bitwiseXOR(F.col(y))) <= most
    all_rows = replicas(distinct)
    cells = all_rows.groupBy("half", "anchor").agg(F.count("*").alias("many"), F.min(F.when(F.col("home"), F.col("fp"))).alias("pivot")).filter("many > 1 and pivot is not null").select("half", "anchor", "pivot")
    members = materialise(all_rows.join(cells, ["half", "anchor"]))
    first = materialise(members.filter(F.col("fp") != F.col("pivot")).filter(near("fp", "pivot")).select(F.col("pivot").alias("a"), F.col("fp").alias("b")).distinct())
    roots = components(first).withColumnRenamed("node", "fp")
    rooted = members.drop("pivot").join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    open_ = rooted.groupBy("half", "anchor").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("half", "anchor")
    rooted = materialise(rooted.join(open_, ["half", "anchor"], "left_semi"))
    x, y = rooted.filter("home").alias("x"), rooted.alias("y")
    # Both are replicated to the other's home, so one direction is enough.
    met = (F.col("x.half") == F.col("y.half")) & (F.col("x.anchor") == F.col("y.anchor")) & (F.col("x.root") < F.col("y.root")) & near("x.fp", "y.fp")
    rest = x.join(y, met).select(F.col("x.root").alias("a"), F.col("y.root").alias("b")).distinct()
    return first.unionAll(rest)


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, most: int = MOST) -> DataFrame:
    """(id, fp, component_id) for each row; ``component_id`` is the smallest id in reach."""
    rows = materialise(fingerprints(docs, id_col, text_col, k))
    classes = materialise(rows.groupBy("fp").agg(F.min("id").alias("least")))
    tied = materialise(components(links(classes.select("fp"), most)).withColumnRenamed("node", "fp"))
    least = tied.join(classes, "fp").groupBy("root").agg(F.min("least").alias("component_id"))
    linked = tied.join(least, "root").select("fp", F.col("component_id").alias("linked"), F.lit(True).alias("is_linked"))
    of_class = classes.join(linked, "fp", "left").select("fp", F.when(F.col("is_linked"), F.col("linked")).otherwise(F.col("least")).alias("component_id"))
    return rows.join(of_class, "fp").select("id", "fp", "component_id")


def digest(docs: DataFrame) -> DataFrame:
    return groups(docs).select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
