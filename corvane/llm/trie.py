"""A trie of conversation prefixes, built level by level.

A node of depth d is a distinct sequence of d turns with which conversations start; it is named by its depth and the
smallest conversation id of those, its members. At each depth the live conversations, those that still share
their node with another, are grouped by (parent node, next turn): each group is a node of the next level and
gets its smallest id. A conversation that is alone in its node leaves; all its further nodes are a
tail without branches, written at once at the end. Then joins go back level by level and roll up leaves and savings.

There are as many levels as turns that different conversations share at most, not as the longest one has. Turns are told
apart by MD5 hashes; texts are not shuffled after their order is known, and no conversation is gathered into a row.
The list of ids that end in a node, whose hash is asked for, is sorted in blocks of up to ``ID_BLOCK``, and the
blocks' texts stream through the hash one after the other.

Defined results: rows without a conversation id take no part; null roles and texts are empty ones; rows of one turn go
by role and text, and repeated rows are turns like any other; a conversation without turns is a member of the root
alone; an empty table has no nodes, not even a root; only the named columns are read.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm._order import numbered, placed
from corvane.llm._storage import materialise

#: Ids, at most, whose decimal numbers are put together in one row.
ID_BLOCK = 1000
NODES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns_of(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, pos, said, bytes) of each turn: its place from 1, a hash of role and text, and the text's UTF-8 bytes."""
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(""))
    rows = conversations.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text")).filter("conv_id is not null")
    said = F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text")))
    return numbered(placed(rows, ["conv_id", "turn", "role", "text"], ["conv_id", said.alias("said"), F.octet_length("text").cast("long").alias("bytes")]), "conv_id")


def _ends(ends: DataFrame) -> DataFrame:
    """(depth, node, ends_sha256) of (depth, node, conv_id) rows."""
    block = F.floor(F.col("conv_id") / F.lit(float(ID_BLOCK)))
    listed = ends.groupBy("depth", "node", block.alias("block")).agg(F.array_join(F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string")), ",").alias("ids"))

    def stream(batches):
        """A node's blocks follow each other; only the hash of the node at hand is held."""
        at, digest = None, None
        for batch in batches:
            done = []
            for depth, node, ids in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if at == (depth, node):
                    digest.update(b",")
                else:
                    if at is not None:
                        done.append((*at, digest.hexdigest()))
                    at, digest = (depth, node), hashlib.sha256()
                digest.update(ids.encode())
            yield _batch(done)
        if at is not None:
            yield _batch([(*at, digest.hexdigest())])

    in_order = listed.repartition("depth", "node").sortWithinPartitions("depth", "node", "block").select("depth", "node", "ids")
    return in_order.mapInArrow(stream, "depth long, node long, ends_sha256 string")


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    return pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(columns[2], pa.string())], ["depth", "node", "ends_sha256"])


def prefix_trie(turns: DataFrame, convs: DataFrame) -> DataFrame:
    """``NODES`` of conversations (conv_id), each once, and their turns (conv_id, depth from 1 without gaps, said, bytes)."""
    turns = turns.select("conv_id", F.col("depth").cast("long").alias("depth"), "said", "bytes")
    long = turns.groupBy("conv_id").agg(F.max("depth").alias("length"))
    convs = materialise(convs.select("conv_id").join(long, "conv_id", "left").select("conv_id", F.coalesce("length", F.lit(0)).alias("length")))
    top = convs.agg(F.min("conv_id")).first()[0]
    node = ["depth", "node", "parent", "n_convs", "bytes"]
    root = convs.agg(F.min("conv_id").alias("node"), F.count("*").alias("n_convs")).filter("n_convs > 0")
    levels = [root.select(F.lit(0).cast("long").alias("depth"), "node", F.lit(None).cast("long").alias("parent"), "n_convs", F.lit(0).cast("long").alias("bytes"))]
    live, ends = convs.withColumn("node", F.lit(top).cast("long")), []
    while True:
        depth = len(levels)
        ends.append(live.filter(F.col("length") < depth).select(F.lit(depth - 1).cast("long").alias("depth"), "node", "conv_id"))
        step = live.filter(F.col("length") >= depth).select("conv_id", "length", F.col("node").alias("parent")).join(turns.filter(F.col("depth") == depth).drop("depth"), "conv_id")
        found = step.groupBy("parent", "said").agg(F.min("conv_id").alias("node"), F.count("*").alias("n_convs"))
        # Written once: a node is the row of its smallest conversation, and all rows of shared nodes live on.
        step = materialise(step.join(found, ["parent", "said"]).drop("said"))
        levels.append(step.filter("conv_id = node").select(F.lit(depth).cast("long").alias("depth"), *node[1:]))
        live = step.filter("n_convs > 1").select("conv_id", "length", "node")
        if live.isEmpty():
            break
    # Back from the deepest level: what each node's children add up to.
    rolled, below = [], None
    for found in reversed(levels):
        if below is None:
            found = found.withColumns({"n_children": F.lit(0).cast("long"), "leaves": F.lit(None).cast("long"), "saved": F.lit(None).cast("long")})
        else:
            found = found.join(below, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
        found = found.withColumns({"leaves": F.coalesce("leaves", F.lit(1)), "saved": F.coalesce("saved", F.lit(0)) + (F.col("n_convs") - 1) * F.col("bytes")})
        rolled.append(materialise(found.select(*node, "n_children", "leaves", "saved")))
        below = rolled[-1].groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("n_children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    every, ended = rolled[0], ends[0]
    for x in rolled[1:]:
        every = every.unionAll(x)
    for x in ends[1:]:
        ended = ended.unionAll(x)
    none = F.lit(hashlib.sha256(b"").hexdigest())
    branching = every.filter("n_convs > 1 or depth = 0").join(_ends(ended), ["depth", "node"], "left")
    branching = branching.select("node", "depth", "parent", "n_convs", "n_children", "leaves", "saved", F.coalesce("ends_sha256", none).alias("ends"))
    # Tails: from where a conversation is alone to its end.
    alone = every.filter("n_convs = 1 and depth > 0").select(F.col("node").alias("conv_id"), F.col("depth").alias("begins"), "parent")
    tails = turns.select("conv_id", "depth").join(alone.join(convs, "conv_id"), "conv_id").filter("depth >= begins")
    last = F.col("depth") == F.col("length")
    tails = tails.select("conv_id", "depth", F.when(F.col("depth") == F.col("begins"), F.col("parent")).otherwise(F.col("conv_id")), F.lit(1).cast("long"), F.when(last, 0).otherwise(1).cast("long"), F.lit(1).cast("long"), F.lit(0).cast("long"), F.when(last, F.sha2(F.col("conv_id").cast("string"), 256)).otherwise(none))
    return branching.unionAll(tails).toDF(*NODES)


def rebuilt(turns: DataFrame, group: int = 5, most: int = 9) -> tuple[DataFrame, DataFrame]:
    """Turns and ids of conversations that share beginnings: the first h turns of the group's first one, then one's own after the first h; h = crc32(id) mod ``most``."""
    turns = materialise(turns)
    h = F.crc32(F.col("conv_id").cast("string")) % F.lit(most)
    first = turns.filter((F.col("conv_id") % group == 0) & (F.col("pos") < most)).withColumnRenamed("conv_id", "base")
    there = first.groupBy("base").agg(F.count("*").alias("there"))
    ids = turns.groupBy("conv_id").agg(F.lit(1).alias("one")).select("conv_id", (F.col("conv_id") - F.col("conv_id") % group).alias("base"), h.alias("h"))
    ids = materialise(ids.join(there, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("taken")))
    theirs = ids.filter("taken > 0").join(first, "base").filter("pos <= taken").select("conv_id", F.col("pos").alias("depth"), "said", "bytes")
    own = turns.filter(F.col("pos") > h).join(ids.select("conv_id", (F.col("h") - F.col("taken")).alias("shift")), "conv_id").select("conv_id", (F.col("pos") - F.col("shift")).alias("depth"), "said", "bytes")
    return materialise(theirs.unionAll(own)), ids.select("conv_id")


def digest(conversations: DataFrame) -> DataFrame:
    return prefix_trie(*rebuilt(turns_of(conversations)))


#: CRC-32 of the text s, whose bytes are ASCII, bit by bit.
CRC32 = "xor(list_reduce(range(0, 8 * strlen(s)), lambda c, i: xor((CASE WHEN i % 8 = 0 THEN xor(c, ord(s[i // 8 + 1])::BIGINT) ELSE c END) >> 1, 3988292384 * ((CASE WHEN i % 8 = 0 THEN xor(c, ord(s[i // 8 + 1])::BIGINT) ELSE c END) & 1)), 4294967295::BIGINT), 4294967295)"
ORACLE_SQL = f"""
WITH own AS (
  SELECT conv_id, list({{'r': coalesce(role, ''), 'x': coalesce(text, '')}} ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS ts
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), h AS (SELECT conv_id, ts, {CRC32} % 9 AS h FROM (SELECT *, conv_id::VARCHAR AS s FROM own)
), b AS (
  SELECT h.conv_id, list_concat(coalesce(p.ts, [])[1:h.h], h.ts[h.h + 1:]) AS ts FROM h LEFT JOIN own p ON p.conv_id = h.conv_id - h.conv_id % 5
), pre AS (
  SELECT conv_id, ts, d, md5(array_to_string(list_transform(ts[1:d], lambda z: concat(strlen(z.r), ':', z.r, strlen(z.x), ':', z.x)), '')) AS k
  FROM (SELECT *, unnest(range(0, len(ts) + 1)) AS d FROM b)
), node AS (
  SELECT d, k, min(conv_id) AS node, count(*) AS n, coalesce(max(strlen(ts[d].x)), 0) AS bytes,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(ts) = d), '')) AS ends FROM pre GROUP BY d, k
), member AS (SELECT conv_id, d, node FROM pre JOIN node USING (d, k)
), up AS (SELECT n.*, m.node AS parent FROM node n LEFT JOIN member m ON m.conv_id = n.node AND m.d = n.d - 1
), child AS (SELECT d - 1 AS d, parent AS node, count(*) AS n_children FROM up GROUP BY 1, 2
), full_node AS (SELECT up.*, coalesce(n_children, 0) AS n_children FROM up LEFT JOIN child USING (d, node)
), under AS (
  SELECT m.d, m.node, count(*) FILTER (x.n_children = 0) AS leaves, sum((x.n - 1) * x.bytes) AS saved
  FROM full_node x JOIN member m ON m.conv_id = x.node AND m.d <= x.d GROUP BY 1, 2
)
SELECT node AS conv_id, d AS depth, parent AS parent_conv_id, n AS n_convs, n_children, leaves AS n_leaves, saved::BIGINT AS saved_tokens, ends AS ends_sha256
FROM full_node JOIN under USING (d, node)
"""
