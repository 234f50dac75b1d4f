"""Exact n-gram Jaccard join with set-relation skipping.

A document's set is its distinct ``k``-word shingles (by 64-bit hash). Document frequencies of
a fixed part of the hash space are counted over the corpus and give one global order, rare
shingles first, so that similar sets must share a shingle of their short prefixes. Shingles
that occur once cannot be shared; documents without a shareable prefix shingle link to none.

Equal sets become one class. Then, by set relations:

- Index lists keep positions: only a set's first positions count when it is the smaller one
  of a pair (its index prefix), and a token's list is looked at in blocks of known bounds.
- Of each list one pivot, the set with most copies, is compared with all others. Every other
  pair's answer is derived from these where it can be: sets that already are in one component need no
  comparison, and by the triangle inequality of the Jaccard distance two sets whose
  distances to the pivot differ by more than the threshold allows cannot link. The roots of two
  components are compared in their place, and members only as far as their distances to the roots
  leave a link possible. Whole blocks
  (token, component) are skipped by their bounds of size, position, distance and by their sketches
  (bits that shingles set, so bits only one side has bound the overlap); what is left is compared exactly.

No pair within a component is made beyond those with pivots, so a group of n near copies
costs n comparisons, not n squared.

Defined results: with fewer than ``k`` words the whole sequence is the one shingle; without words,
or with a null text, the set is empty and links with nothing; a null id is larger than any
other and stays null where a document stands alone; repeated rows link with each other; an
empty table gives an empty result; only the named id and text columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import _blocks, _text
from corvane.llm._storage import materialise

#: The part of the hash space whose frequencies are counted. Prefixes take a fifth of a set, so they nearly always lie in it.
COUNTED = 0.4
SETS = "id long, key long, holder long, n long, cls binary, prefix array<struct<token:long,pos:int>>, shingles binary, bits array<long>"
#: Bits of a set's sketch: each shingle sets one.
BITS = 512
#: Pairs of whole sets in an Arrow batch.
PAIR_ROWS = 200


def _sets(column, k: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Distinct (shingle, document), sorted by shingle, and the number of documents."""
    w = _text.split_words(column, lower=True)
    h = _text.hash_words(w)
    at = _text.inside(w, k)
    key, doc = _text.hash_windows(h, k)[at] if len(at) else h[:0], w.doc[at]
    short = np.flatnonzero((w.counts > 0) & (w.counts < k))
    key, doc = np.concatenate([key, _text.hash_spans(h, w.first[short], w.counts[short])]), np.concatenate([doc, short])
    order = np.argsort(key, kind="stable")
    key, doc = key[order], doc[order]
    # Stable, so a document's equal shingles that came from its windows are neighbours.
    order = np.lexsort((doc, key)) if len(short) else slice(None)
    key, doc = key[order], doc[order]
    new = np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]) if len(key) else np.zeros(0, bool)
    return key[new], doc[new], len(w.first) - 1


def _low(key: np.ndarray) -> int:
    return int(np.searchsorted(key, np.uint64(int(COUNTED * 2**64))))


def _describe(part: pa.Table, answers: pa.Table, k: int, percent: int) -> pa.Table:
    ids, keys, found, n_docs = [], [], [], 0
    for rows in _blocks.chunks(part):
        key, doc, n = _sets(rows.column("text"), k)
        found.append((key, doc + n_docs))
        ids.append(rows.column("id"))
        keys.append(rows.column("carry_0"))
        n_docs += n
    key, doc = (np.concatenate(x) for x in zip(*found))
    del found
    n = np.bincount(doc, minlength=n_docs)
    # answers hold 0 for what occurs once
    counted = np.flatnonzero(key < np.uint64(int(COUNTED * 2**64)))
    df = np.full(len(key), 1 << 62)
    if len(counted):
        df[counted] = _blocks.totals_of(answers)[_blocks.group(key[counted])[1]]
    order = np.lexsort((key, df, doc))
    key, df, doc = key[order], df[order], doc[order]
    first = np.searchsorted(doc, np.arange(n_docs + 1))
    pos = np.arange(len(key)) - first[doc]
    keep = (pos < n[doc] - (percent * n[doc] + 99) // 100 + 1) & (df > 1)
    shared = np.bincount(doc[keep], minlength=n_docs)
    ends = np.concatenate([[0], np.cumsum(shared)])
    total = np.zeros((len(key) + 1, 2), np.uint64)
    np.cumsum(np.stack([_text.mix(key), _text.mix(key ^ np.uint64(_text._STEP))], 1), axis=0, out=total[1:])
    sums = (total[first[1:]] - total[first[:-1]]) * np.uint64(_text._STEP) + n[:, None].astype(np.uint64)
    del total, order, df
    cls = [x.tobytes() if s else None for x, s in zip(sums, shared)]
    seen: set[bytes] = set()
    sets = []
    for i, c in enumerate(cls):
        sets.append(None if c is None or c in seen else np.sort(key[first[i] : first[i + 1]]).tobytes())
        seen.add(c)
    token, pos = pa.array(key[keep].view(np.int64)), pa.array(pos[keep].astype(np.int32))
    prefix = pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.StructArray.from_arrays([token, pos], ["token", "pos"]))
    held = np.array([x is not None for x in sets], bool)
    row = np.cumsum(held) - 1
    mine = held[doc]
    sketch = np.zeros((int(held.sum()), BITS), np.uint8)
    sketch[row[doc[mine]], (key[mine] >> np.uint64(7)) % np.uint64(BITS)] = 1
    words = np.packbits(sketch, axis=1).view(np.int64).ravel()
    bits = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(held * (BITS // 64))]).astype(np.int32)), pa.array(words))
    block = part.column("block")[0].as_py()
    return pa.Table.from_arrays([pa.concat_arrays(ids), pa.concat_arrays(keys), pa.array((block << 32) + np.arange(n_docs)), pa.array(n), pa.array(cls, pa.binary()), prefix, pa.array(sets, pa.binary()), bits], ["id", "key", "holder", "n", "cls", "prefix", "shingles", "bits"])


def describe(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int, block_bytes: int) -> DataFrame:
    """``SETS``: ``key`` is a hash of the text; ``cls`` names equal sets; class, prefix and set are only there where a link can be."""
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), F.xxhash64(F.col(f"`{text_col}`")).alias("key"))
    blocked, n, _ = _blocks.deal(rows, "id", "text", ("key",), block_bytes)

    def counted(column) -> np.ndarray:
        key, _, _ = _sets(column, k)
        return key[: _low(key)]

    answers = _blocks.count_hashes(blocked, counted, max(1, n // 2))
    whole = blocked.groupBy("block").cogroup(answers.groupBy("block"))
    return materialise(whole.applyInArrow(lambda part, answer: _describe(part, answer, k, percent), SETS))


def _compare(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b, shared, either) for pairs (a, b) of holders."""
    side = sets.filter(F.col("shingles").isNotNull()).select("holder", "shingles")
    one = pairs.join(side.select(F.col("holder").alias("a"), F.col("shingles").alias("of_a")), "a")
    both = one.join(side.select(F.col("holder").alias("b"), F.col("shingles").alias("of_b")), "b").select("a", "b", "of_a", "of_b")

    def run(batches):
        for batch in batches:
            shared, either = [], []
            for x, y in zip(batch.column("of_a"), batch.column("of_b")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                n = int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum())
                shared.append(n)
                either.append(len(x) + len(y) - n)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(shared, pa.int64()), pa.array(either, pa.int64())], ["a", "b", "shared", "either"])

    return both.mapInArrow(run, "a long, b long, shared long, either long")


def _tied(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes of (a, b) edges that are not roots themselves. Large-star and small-star steps by joins, until no star is tied to another."""
    e = materialise(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct())
    while True:
        # Stars: nobody has two roots, and no root has a root.
        ends = e.select(F.col("b").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(e.select(F.col("a").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        if not ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).filter("up + down > 1").count():
            return e.select(F.col("b").alias("node"), F.col("a").alias("root"))
        # large star: each larger neighbour is tied to the smallest of the neighbourhood
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).filter("a <> b").distinct()
        # small star: smaller neighbours, and the node, are tied to the smallest of them
        low = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(low, "b").select(F.col("m").alias("x"), F.explode(F.array("a", "b")).alias("y")).filter("x <> y")
        e = materialise(small.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct())


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of (a, b) edges; ``root`` is the smallest node in reach."""
    tied = _tied(edges)
    return tied.unionAll(tied.select(F.col("root").alias("node"), "root").distinct())


def _links(found: DataFrame, percent: int) -> DataFrame:
    return found.filter(F.col("shared") * 100 >= F.col("either") * percent).select("a", "b")


def link(sets: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Classes (cls, holder, copies, least_id), and (node, root) of the holders that have another as the root of their component."""
    classes = materialise(sets.filter(F.col("cls").isNotNull()).groupBy("cls").agg(F.min(F.when(F.col("shingles").isNotNull(), F.col("holder"))).alias("holder"), F.count("*").alias("copies"), F.min("id").alias("least_id"), F.first("n").alias("n")))
    listed = sets.filter(F.col("shingles").isNotNull()).select("holder", "prefix").join(classes, "holder").select("holder", "n", "copies", F.inline("prefix"))
    # The smaller set of a pair shares a shingle in its first n - ceil(percent * 2n / (100 + percent)) + 1 places.
    need = F.floor((2 * percent * F.col("n") + 99 + percent) / (100 + percent))
    listed = listed.withColumn("index", F.col("pos") < F.col("n") - need + 1)
    lists = listed.groupBy("token").agg(F.max(F.when(F.col("index"), F.struct("copies", (-F.col("holder")).alias("h"), F.col("n")))).alias("p"), F.count("*").alias("size"))
    pivots = lists.filter("size > 1 and p is not null").select("token", (-F.col("p.h")).alias("pivot"), F.col("p.n").alias("pivot_n"))
    members = materialise(listed.join(pivots, "token").select("token", "holder", "n", "pos", "index", "pivot", "pivot_n"))
    fits = lambda x, y: (F.least(x, y) * 100 >= F.greatest(x, y) * percent)
    near = members.filter(fits(F.col("n"), F.col("pivot_n")) & (F.col("holder") != F.col("pivot"))).select(F.col("pivot").alias("a"), F.col("holder").alias("b")).distinct()
    answers = materialise(_compare(near, sets, percent), PAIR_ROWS)
    links = _links(answers, percent)
    roots = _tied(links)
    # What the pivots' answers leave open.
    far = answers.select(F.col("a").alias("pivot"), F.col("b").alias("holder"), (1 - F.col("shared") / F.col("either")).alias("d"))
    m = members.join(far, ["pivot", "holder"], "left").join(roots.withColumnRenamed("node", "holder"), "holder", "left")
    # A set of a size that cannot link to the pivot has an unknown distance over the limit.
    limit = 1 - percent / 100
    m = m.withColumn("root", F.coalesce("root", "holder")).withColumn("d_low", F.when(F.col("holder") == F.col("pivot"), 0.0).otherwise(F.coalesce("d", F.lit(limit)))).withColumn("d_high", F.when(F.col("holder") == F.col("pivot"), 0.0).otherwise(F.coalesce("d", F.lit(1.0))))
    m = m.join(m.groupBy("token").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).filter("r0 <> r1").select("token"), "token", "left_semi").select("token", "holder", "n", "pos", "index", "root", "d_low", "d_high")
    m = materialise(m.join(sets.filter(F.col("shingles").isNotNull()).select("holder", "bits"), "holder"))
    # A component's root stands for it: how far its members are from it bounds their distances to all that its root is far from.
    own = _compare(m.filter("root <> holder").select(F.col("root").alias("a"), F.col("holder").alias("b")).distinct(), sets, percent)
    own = own.select(F.col("a").alias("root"), F.col("b").alias("holder"), (1 - F.col("shared") / F.col("either")).alias("d_own"))
    m = materialise(m.join(own, ["root", "holder"], "left").withColumn("d_own", F.coalesce("d_own", F.lit(0.0))), PAIR_ROWS)
    slack, n_words = limit + 1e-9, BITS // 64
    # Bits that one set has and the other lacks are shingles that only the one has; a block's are at least those of all its sets that no set of the other has.
    only = lambda x, y: sum((F.bit_count(x(i).bitwiseAND(F.bitwise_not(y(i)))) for i in range(n_words)), F.lit(0))
    may = lambda x, y, most, least: only(x, y) * (100 + percent) <= 100 * most - percent * least
    block_bits = (f(F.col("bits")[i]).alias(f"{name}_{i}") for i in range(n_words) for name, f in (("all", F.bit_and), ("any", F.bit_or)))
    blocks = m.groupBy("token", "root").agg(*block_bits, *(f(c).alias(f"{f.__name__}_{c}") for c in ("n", "d_low", "d_high") for f in (F.min, F.max)), F.max(F.col("n") - F.col("pos")).alias("rest"), F.max("index").alias("any_index"))
    x, y = blocks.alias("x"), blocks.alias("y")
    open_ = (F.col("x.token") == F.col("y.token")) & (F.col("x.root") < F.col("y.root"))
    # The smaller set has the token in its index prefix, and equally large ones both; blocks of one size are decided here.
    alike = (F.col("x.min_n") == F.col("y.max_n")) & (F.col("x.max_n") == F.col("y.min_n"))
    open_ &= F.when(F.col("x.max_n") < F.col("y.min_n"), F.col("x.any_index")).when(F.col("x.min_n") > F.col("y.max_n"), F.col("y.any_index")).when(alike, F.col("x.any_index") & F.col("y.any_index")).otherwise(F.col("x.any_index") | F.col("y.any_index"))
    # What follows the token in both is enough for the overlap.
    open_ &= F.least(F.col("x.rest"), F.col("y.rest")) * (100 + percent) >= percent * (F.col("x.min_n") + F.col("y.min_n"))
    open_ &= (F.col("x.min_n") * percent <= F.col("y.max_n") * 100) & (F.col("y.min_n") * percent <= F.col("x.max_n") * 100)
    open_ &= may(lambda i: F.col(f"x.all_{i}"), lambda i: F.col(f"y.any_{i}"), F.col("x.max_n"), F.col("y.min_n")) & may(lambda i: F.col(f"y.all_{i}"), lambda i: F.col(f"x.any_{i}"), F.col("y.max_n"), F.col("x.min_n"))
    open_ &= (F.col("x.min_d_low") - F.col("y.max_d_high") <= slack) & (F.col("y.min_d_low") - F.col("x.max_d_high") <= slack)
    kept = x.join(y, open_).select(F.col("x.root").alias("a"), F.col("y.root").alias("b")).distinct()
    # Components whose roots link are one. The others are looked into as far as their radii reach.
    between = materialise(_compare(kept, sets, percent), PAIR_ROWS)
    links = roots.select(F.col("root").alias("a"), F.col("node").alias("b")).unionAll(_links(between, percent))
    apart = between.filter(F.col("shared") * 100 < F.col("either") * percent).select(F.col("a").alias("rx"), F.col("b").alias("ry"), (1 - F.col("shared") / F.col("either")).alias("d_roots"))
    # From here on tokens no longer matter, so a pair comes once.
    held = materialise(m.select("root", "holder", "n", "bits", "d_own").dropDuplicates(["holder"]))
    whole = held.groupBy("root").agg(*(f(F.col("bits")[i]).alias(f"{name}_{i}") for i in range(n_words) for name, f in (("all", F.bit_and), ("any", F.bit_or))), F.min("n").alias("min_n"), F.max("n").alias("max_n"), F.max("d_own").alias("rad_y"))
    near = apart.join(whole.select(F.col("root").alias("rx"), F.col("rad_y").alias("rad_x")), "rx").join(whole.withColumnRenamed("root", "ry"), "ry")
    near = near.filter((F.col("rad_x") + F.col("rad_y") > 0) & (F.col("d_roots") - F.col("rad_x") - F.col("rad_y") <= slack))
    left, right = held.alias("l"), held.alias("r")
    ln, rn, reach = F.col("l.n"), F.col("r.n"), F.col("d_roots") - F.col("l.d_own")
    bit, low, high = (lambda side: lambda i: F.col(f"{side}.bits")[i]), (lambda i: F.col(f"all_{i}")), (lambda i: F.col(f"any_{i}"))
    sized = (F.col("min_n") * percent <= ln * 100) & (ln * percent <= F.col("max_n") * 100)
    pairs = near.join(left, (near["rx"] == F.col("l.root")) & (reach - F.col("rad_y") <= slack) & sized & may(bit("l"), high, ln, F.col("min_n")) & may(low, bit("l"), F.col("max_n"), ln))
    pairs = pairs.select("ry", "d_roots", F.struct("l.holder", "l.n", "l.bits", "l.d_own").alias("l"))
    pairs = pairs.join(right, (pairs["ry"] == F.col("r.root")) & (reach - F.col("r.d_own") <= slack) & fits(ln, rn) & may(bit("l"), bit("r"), ln, rn) & may(bit("r"), bit("l"), rn, ln))
    rest = pairs.select(F.least("l.holder", "r.holder").alias("a"), F.greatest("l.holder", "r.holder").alias("b"))
    rest = rest.join(answers.unionAll(between).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti")
    return classes, _tied(materialise(links.unionAll(_links(_compare(rest, sets, percent), percent)), PAIR_ROWS))


def _rooted(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int, block_bytes: int) -> tuple[DataFrame, DataFrame]:
    """``SETS`` of the rows, and the classes with the root of each one's component."""
    sets = describe(docs, id_col, text_col, k, percent, block_bytes)
    classes, roots = link(sets, percent)
    return sets, classes.join(roots.withColumnRenamed("node", "holder"), "holder", "left").withColumn("root", F.coalesce("root", "holder"))


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, block_bytes: int = _blocks.BLOCK_BYTES) -> DataFrame:
    """(id, key, n_shingles, component_id) for each row; ``key`` is a hash of the text."""
    sets, tied = _rooted(docs, id_col, text_col, k, percent, block_bytes)
    least = tied.groupBy("root").agg(F.min("least_id").alias("component_id"))
    of_class = tied.join(least, "root").select("cls", "component_id")
    alone = sets.filter(F.col("cls").isNull()).select("id", "key", F.col("n").alias("n_shingles"), F.col("id").alias("component_id"))
    return sets.filter(F.col("cls").isNotNull()).select("id", "key", "n", "cls").join(of_class, "cls").select("id", "key", F.col("n").alias("n_shingles"), "component_id").unionAll(alone)


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 80, block_bytes: int = _blocks.BLOCK_BYTES) -> DataFrame:
    """One document of each group: that of the smallest id, null ids last, and of these of the smallest hash of its text.

    Groups are components, whatever ids their rows have: an id may be in several, and each keeps its own document.
    Rows of equal id and text are one document. Decisions are ids and hashes of texts; the
    texts themselves are shuffled once, by these, which serves both the join and the removal of repeated rows.
    """
    sets, tied = _rooted(docs, id_col, text_col, k, percent, block_bytes)
    first = sets.filter(F.col("cls").isNotNull()).groupBy("cls").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("first"))
    stay = tied.join(first, "cls").groupBy("root").agg(F.min("first").alias("first")).select("first.id", "first.key")
    stay = stay.unionAll(sets.filter(F.col("cls").isNull()).select("id", "key").distinct())
    # An id as a text is never empty, so that stands for no id and the join needs no special equality.
    named = lambda c: F.coalesce(c.cast("long").cast("string"), F.lit(""))
    stay = materialise(stay.select(F.struct(named(F.col("id")).alias("i"), F.col("key").alias("k")).alias("which")))
    rows = docs.select(F.struct(named(F.col(f"`{id_col}`")).alias("i"), F.xxhash64(F.col(f"`{text_col}`")).alias("k")).alias("which"), F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return rows.join(stay, "which", "left_semi").dropDuplicates(["which"]).select("row.*")


def digest(docs: DataFrame) -> DataFrame:
    return groups(docs).select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


ORACLE_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), sh AS (
  SELECT doc_id, list_distinct(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(generate_series(1, len(ws) - 4), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS s FROM w
), flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sh),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.x = b.x AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), e AS (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs),
reach(doc_id, r) AS (
  SELECT doc_id, doc_id FROM sh UNION SELECT e.b, reach.r FROM reach JOIN e ON reach.doc_id = e.a
)
SELECT sh.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, min(r) AS component_id
FROM sh JOIN reach ON sh.doc_id = reach.doc_id GROUP BY sh.doc_id, s
"""
