"""Removing long repeated passages with a compacted de Bruijn graph of words.

Nodes are the ``k - 1``-word strings of all texts, edges the windows of ``k`` words between them. An edge that
stands at two places or more is repeated; all words of repeated edges go. The graph is built and compacted
bucket by bucket:

1. A node belongs to the bucket of its least ``ANCHOR``-word hash, so wherever it stands it falls into the same bucket.
   Neighbouring nodes of one bucket make up a run; a run is told by a second, independent hash of all its edges,
   those into its first and out of its last node included. Spark adds up the runs of each bucket. Where all runs
   are alike, every node in them has one edge in and one out, so each run is a piece of a nonbranching path, and it is
   repeated if there are two or more. Buckets with one run hold nothing repeated. Neither needs its edges one by one.
2. The other buckets' nodes become rows (node, edge in, edge out). Spark counts the edges, by two independent
   hashes, and the degrees of the nodes, over rows that keep the block of texts that is told.
3. Each text's repeated edges compact to paths, cut at nodes that branch or end anywhere. Each path is kept as a span
   of source coordinates with a hash of all its words; ``paths`` holds the places of a path against each other.

Only about one row in ten words is shuffled in step 1, and in step 2 those around the ends of repeats.

Defined results: a null or empty text has no words and nothing to remove; texts under ``k``
words are left alone; equal rows repeat each other like any other texts; a null id is passed
through; an empty table gives an empty result; columns that are carried may have any names.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm import _blocks, _text
from corvane.llm._storage import materialise

#: Words of the strings whose hashes choose a node's bucket.
ANCHOR = 12
SPANS = "array<struct<start:long,length:long,path:long,check:long>>"
RUNS = "block long, anchor long, content long, n long, loose boolean"
NODES = "block long, node long, edge long, second long, prev long, n long"
#: Kinds of what a block is told: anchors of repeated and of mixed buckets, repeated edges, nodes that cut a path.
SURE, MIXED, EDGE, CUT = range(4)


class Graph:
    """The nodes, edges and runs of a chunk of texts."""

    def __init__(self, column, k: int, seconds: bool = True):
        self.w = w = _text.split_words(column)
        hashes = _text.hash_words(w, 0, 1) if seconds else _text.hash_words(w)[None]
        self.h, self.k = hashes[0], k
        self.second = _text.hash_windows(hashes[1], k) if seconds else None
        m = min(ANCHOR, k - 1)
        #: whether an edge starts at each word; one more place stands for the word before the first
        self.edge_at = np.zeros(len(self.h) + 1, bool)
        self.edge_at[_text.inside(w, k)] = True
        node = _text.inside(w, k - 1)
        self.node = node[w.counts[w.doc[node]] >= k] if len(node) else node
        anchors = _text.hash_windows(self.h, m)
        low = _text.window_min(anchors, k - m)[self.node] if len(self.node) else anchors[:0]
        new = np.concatenate([[True], (np.diff(self.node) != 1) | (low[1:] != low[:-1])]) if len(low) else np.zeros(0, bool)
        self.head = np.flatnonzero(new)
        self.size = np.diff(np.append(self.head, len(low)))
        self.anchor = low[self.head]
        self._anchors, self._reach = anchors, k - 1 - m

    def edges(self) -> np.ndarray:
        return _text.hash_windows(self.h, self.k)

    def nodes(self) -> np.ndarray:
        return _text.hash_windows(self.h, self.k - 1)

    def contents(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each run, a hash of its edges in order, and whether its anchor stands in it more than once."""
        first, last = self.node[self.head], self.node[self.head + self.size - 1]
        start = first - self.edge_at[first - 1]
        content = _text.hash_spans(self.second, start, last + self.edge_at[last] - start)
        size = last - first + self._reach + 1
        at = np.cumsum(size) - size
        place = np.arange(int(size.sum())) + np.repeat(first - at, size)
        same = self._anchors[place] == np.repeat(self.anchor, size)
        return content, _text._reduce(same.astype(np.int64), at) > 1

    def of_runs(self, chosen: np.ndarray) -> np.ndarray:
        """The nodes' places in the chosen runs."""
        return self.node[np.repeat(chosen, self.size)]


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _summed(keys: list[np.ndarray], n: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of several keys, and the sums of ``n``."""
    if not len(n):
        return keys, n
    order = np.lexsort(keys[::-1])
    keys = [x[order] for x in keys]
    new = np.concatenate([[True], np.any([x[1:] != x[:-1] for x in keys], axis=0)])
    at = np.flatnonzero(new)
    return [x[at] for x in keys], np.add.reduceat(n[order], at)


def _rows(block: int, names: list[str], keys: list[np.ndarray], n: np.ndarray) -> dict:
    return {"block": pa.array(np.full(len(n), block, np.int64))} | {c: pa.array(x.view(np.int64)) for c, x in zip(names, keys)} | {"n": pa.array(n)}


def _emit_runs(part: pa.Table, k: int) -> pa.Table:
    found = []
    for rows in _blocks.chunks(part):
        g = Graph(rows.column("text"), k)
        if len(g.head):
            found.append((g.anchor, *g.contents()))
    a, c, loose = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, bool))
    (a, c, loose), n = _summed([a, c, loose], np.ones(len(a), np.int64))
    return pa.table(_rows(part.column("block")[0].as_py(), ["anchor", "content"], [a, c], n) | {"loose": pa.array(loose)}).select(["block", "anchor", "content", "n", "loose"])


def _told(answers: pa.Table, kind: int) -> np.ndarray:
    return np.unique(answers.filter(pc.equal(answers.column("kind"), kind)).column("value").to_numpy().view(np.uint64))


def _emit_nodes(part: pa.Table, answers: pa.Table, k: int) -> pa.Table:
    """The nodes of mixed buckets with their edges in and out, 0 for none."""
    mixed, found = _told(answers, MIXED), [[np.zeros(0, np.uint64)] * 4]
    for rows in _blocks.chunks(part) if len(mixed) and part.num_rows else ():
        g = Graph(rows.column("text"), k)
        at = g.of_runs(_among(g.anchor, mixed))
        if len(at):
            edge, here, before = g.edges(), g.edge_at[at], g.edge_at[at - 1]
            take = lambda x, p, there: np.where(there, x[np.where(there, p, 0)], 0)
            found.append([g.nodes()[at], take(edge, at, here), take(g.second, at, here), take(edge, at - 1, before)])
    keys = [np.concatenate(x).astype(np.uint64) for x in zip(*found)]
    keys, n = _summed(keys, np.ones(len(keys[0]), np.int64))
    block = part.column("block")[0].as_py() if part.num_rows else 0
    return pa.table(_rows(block, ["node", "edge", "second", "prev"], keys, n))


def _joined(w: _text.Words, keep: np.ndarray) -> tuple[bytes, np.ndarray]:
    """Kept words of all documents, each followed by a space, and each document's place therein."""
    start, size = w.starts[keep], w.ends[keep] - w.starts[keep] + 1
    end = np.cumsum(size)
    out = np.full(int(end[-1]) if len(end) else 0, 32, np.uint8)
    if len(end):
        source = np.arange(len(out)) + np.repeat(start - (end - size), size)
        body = np.ones(len(out), bool)
        body[end - 1] = False
        out[body] = w.buf[source[body]]
    before = np.concatenate([[0], np.cumsum(keep)])[w.first]
    return out.tobytes(), np.concatenate([[0], end])[before]


def _finish(rows: pa.RecordBatch, sure: np.ndarray, repeated: np.ndarray, cuts: np.ndarray, k: int, with_text: bool) -> pa.Table:
    text = rows.column("text")
    g = Graph(text, k, seconds=False)
    w, edge = g.w, g.edges()
    hit = np.zeros(len(g.edge_at), bool)
    hit[g.of_runs(_among(g.anchor, sure))] = True
    at = np.flatnonzero(g.edge_at)
    hit[at] |= _among(edge[at], repeated)
    hit &= g.edge_at
    at = np.flatnonzero(hit)
    cut = np.concatenate([[True], np.diff(at) != 1]) if len(at) else np.zeros(0, bool)
    if len(at):
        cut |= _among(g.nodes()[at], cuts)
    head = np.flatnonzero(cut)
    length = np.diff(np.append(head, len(at))) + k - 1
    start = at[head]
    check = _text.hash_spans(_text.hash_words(w, 1), start, length) if len(head) else edge[:0]
    change = np.zeros(len(g.h) + 1, np.int64)
    np.add.at(change, start, 1)
    np.add.at(change, start + length, -1)
    keep = np.cumsum(change[:-1]) == 0
    raw, place = _joined(w, keep)
    removed = np.diff(np.concatenate([[0], np.cumsum(~keep)])[w.first])
    kept = [raw[a : max(a, b - 1)] for a, b in zip(place[:-1].tolist(), place[1:].tolist())]
    owner = np.searchsorted(w.first, start, side="right") - 1
    offsets = np.searchsorted(owner, np.arange(len(w.first))).astype(np.int32)
    spans = pa.StructArray.from_arrays([pa.array(x.astype(np.int64)) for x in (start - w.first[owner], length, edge[start].view(np.int64), check.view(np.int64))], ["start", "length", "path", "check"])
    columns = {c: rows.column(c) for c in rows.schema.names if c != "text"}
    columns |= {"n_words": pa.array(w.counts), "n_removed": pa.array(removed), "kept_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in kept], pa.string()), "spans": pa.ListArray.from_arrays(pa.array(offsets), spans)}
    if with_text:
        columns["kept_text"] = pc.if_else(pa.array(removed > 0), pa.array(kept, pa.binary()).cast(pa.string()), text.cast(pa.string()))
    return pa.table(columns)


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 35, carry: tuple[str, ...] = (), with_text: bool = False, block_bytes: int = _blocks.BLOCK_BYTES) -> DataFrame:
    """(id, carried columns as carry_<i>, n_words, n_removed, kept_sha256, spans) and, ``with_text``, kept_text.

    ``kept_text`` is the text itself where nothing goes, else the kept words joined by one space.
    """
    blocked, _, kinds = _blocks.deal(docs, id_col, text_col, carry, block_bytes)
    by_block = blocked.groupBy("block")
    runs = by_block.applyInArrow(lambda part: _emit_runs(part, k), RUNS)
    # A row carries its bucket's, edge's or node's facts on: one shuffle serves to add up and to answer.
    bucket, edge, node = (Window.partitionBy(*by) for by in (["anchor"], ["edge", "second"], ["node"]))
    counted = runs.select("block", "anchor", F.sum("n").over(bucket).alias("total"), (F.min("content").over(bucket) != F.max("content").over(bucket)).alias("differ"), F.max("loose").over(bucket).alias("loose"))
    state = F.when(F.col("differ") | F.col("loose"), MIXED).otherwise(SURE)
    known = counted.filter("total > 1 or loose").select("block", state.alias("kind"), F.col("anchor").alias("value"))
    nodes = by_block.cogroup(known.groupBy("block")).applyInArrow(lambda part, told: _emit_nodes(part, told, k), NODES)
    twice = nodes.filter("edge <> 0").select("block", "edge", F.sum("n").over(edge).alias("total")).filter("total > 1")
    repeated = twice.select("block", F.lit(EDGE).alias("kind"), F.col("edge").alias("value"))
    # A node of one edge in and one out has the same two wherever it stands; 0 is the end of a text.
    ways = {"total": F.sum("n")} | {f"{c}{i}": f(c) for c in ("prev", "edge") for i, f in enumerate((F.min, F.max))}
    forks = nodes.select("block", "node", *(f.over(node).alias(c) for c, f in ways.items())).filter("total > 1 and (prev0 <> prev1 or edge0 <> edge1)")
    cuts = forks.select("block", F.lit(CUT).alias("kind"), F.col("node").alias("value")).distinct()
    answers = known.unionAll(repeated).unionAll(cuts)
    schema = ", ".join(x for x in kinds.split(", ") if not x.startswith("text ")) + f", n_words long, n_removed long, kept_sha256 string, spans {SPANS}" + ", kept_text string" * with_text

    def finish(part: pa.Table, told: pa.Table) -> pa.Table:
        sure, repeats, forked = (_told(told, x) for x in (SURE, EDGE, CUT))
        return pa.concat_tables([_finish(rows, sure, repeats, forked, k, with_text) for rows in _blocks.chunks(part)])

    return materialise(by_block.cogroup(answers.groupBy("block")).applyInArrow(finish, schema))


def paths(done: DataFrame) -> DataFrame:
    """One row per repeated path: (path, length, places, same_words), from the source coordinates of ``remove_repeats``.

    ``path`` is the hash of the first edge. Every place of a path has the same words, so its hash of all words is one
    and it stands at two places or more; a row that says otherwise would come of hashes that meet.
    """
    spans = done.select(F.explode("spans").alias("s")).select("s.*")
    by = spans.groupBy("path", "length").agg(F.count("*").alias("places"), (F.min("check") == F.max("check")).alias("same_words"))
    return by.select("path", "length", "places", "same_words")


def digest(docs: DataFrame) -> DataFrame:
    return remove_repeats(docs).select(F.col("id").alias("doc_id"), "n_words", "n_removed", "kept_sha256")


ORACLE_SQL = """
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents
), win AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 34], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(generate_series(1, len(ws) - 34)) AS i FROM w WHERE len(ws) >= 35)
), rep AS (
  SELECT h FROM win GROUP BY h HAVING count(*) > 1
), gone AS (
  SELECT doc_id, list(DISTINCT j) AS js FROM (SELECT doc_id, unnest(generate_series(i, i + 34)) AS j FROM win SEMI JOIN rep USING (h)) GROUP BY doc_id
), word AS (
  SELECT w.doc_id, len(ws) AS n, ws, coalesce(js, []) AS js FROM w LEFT JOIN gone USING (doc_id)
)
SELECT doc_id, CAST(n AS BIGINT) AS n_words, CAST(len(js) AS BIGINT) AS n_removed,
  sha256(array_to_string(list_filter(ws, lambda x, i: NOT list_contains(js, i)), ' ')) AS kept_sha256
FROM word
"""
