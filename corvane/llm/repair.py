"""Repairing the turn structure of conversations at least cost.

Wanted are role initials ``(s?(ua)+)?``. A conversation of n turns is a graph of nodes (turns read, state), the state
being what the last turn written was: none, system, user or assistant. Its arcs are edits: Keep, Rerole to
user or assistant, Delete, Insert an empty user or assistant turn. Costs are small whole numbers, so distances to the
end are found by Dial's buckets, one a distance, as many in a ring as the dearest arc costs and one more. From the
start the repair then walks along tight arcs, those that lose as much distance as they cost, and of several takes the
one whose initial comes first in ASCII; the initials are the audit.

Every node has one arc of each kind, at most, so an audit tells the repair. Arcs that cost nothing read a turn, so the
walk ends.

Turns are dealt by ranges of (conversation, turn, role, text) and keep their place; what the graph needs of a turn
is one byte. A conversation's bytes, and its audit, which is one value of the result, meet in one task; its texts stream
through the hash of the repaired text in order. Repeats are found per (conversation, role, text).

Defined results: faults, costs and orders as ``repair`` says; a null role or text is one space, so such a text is
blank; rows of one turn, and rows without a turn, which come first, go by role and text; rows without a conversation id are
one conversation; repeated rows are duplicates; an empty text is blank; an empty table gives an empty
result; only the named columns are read.
"""

from __future__ import annotations

import functools
import hashlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corvane.llm._order import placed

SPACE = " \t\n\u000b\f\r"
REROLE, DELETE, INSERT, CUT_OFF = 1, 2, 5, 5
#: What a turn's byte holds: its role's initial, s, u, a or another, and four times its fault.
INITIALS = "sua"
SOUND, BLANK, DUPLICATE, TRUNCATED = range(4)
GONE = 255
#: States: nothing written, and what was written last.
START, SYSTEM, USER, ASSISTANT = range(4)
#: The state that an inserted or reroled turn leads to, and the states that it comes from.
NEXT = (USER, USER, ASSISTANT, USER)
BEFORE = ((), (), (START, SYSTEM, ASSISTANT), (USER,))
#: States that a kept turn leads to, by state and initial; -1 for none.
KEPT = ((SYSTEM, USER, -1, -1), (-1, USER, -1, -1), (-1, -1, ASSISTANT, -1), (-1, USER, -1, -1))
DEAREST = max(INSERT, DELETE, REROLE + CUT_OFF)
FOUND = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def distances(turns: bytes) -> array:
    """Of each node 4 * (turns read) + state, the least cost from there to the end, by Dial's buckets; backwards from the two final nodes."""
    n = len(turns)
    far = (n + 2) * (DEAREST + INSERT)
    best = array("q", [far]) * (4 * (n + 1))
    buckets: list[list[int]] = [[] for _ in range(DEAREST + 1)]
    waiting = 0

    def reach(node: int, cost: int) -> None:
        nonlocal waiting
        if cost < best[node]:
            best[node] = cost
            buckets[cost % len(buckets)].append(node)
            waiting += 1

    reach(4 * n + START, 0)
    reach(4 * n + ASSISTANT, 0)
    cost = 0
    while waiting:
        bucket = buckets[cost % len(buckets)]
        while bucket:
            node = bucket.pop()
            waiting -= 1
            if best[node] != cost:
                continue  # reached at less meanwhile
            read, state = divmod(node, 4)
            for s in BEFORE[state]:
                reach(4 * read + s, cost + INSERT)
            if read:
                fault, initial = divmod(turns[read - 1], 4)
                reach(4 * (read - 1) + state, cost + DELETE)
                if fault in (SOUND, TRUNCATED):
                    more = CUT_OFF if fault == TRUNCATED else 0
                    for s in BEFORE[state]:
                        reach(4 * (read - 1) + s, cost + REROLE + more)
                    for s in range(4):
                        if KEPT[s][initial] == state:
                            reach(4 * (read - 1) + s, cost + more)
        cost += 1
    return best


def walk(turns: bytes, best: array) -> str:
    """The audit: tight arcs from the start, the least initial first."""
    out, read, state = [], 0, START
    while read < len(turns) or best[4 * read + state]:
        left = best[4 * read + state]
        fault, initial = divmod(turns[read], 4) if read < len(turns) else (BLANK, 3)
        more = CUT_OFF if fault == TRUNCATED else 0
        may = fault in (SOUND, TRUNCATED)
        kept = KEPT[state][initial]
        if read < len(turns) and best[4 * (read + 1) + state] + DELETE == left:
            out.append("D")
            read += 1
        elif best[4 * read + NEXT[state]] + INSERT == left:
            out.append("I")
            state = NEXT[state]
        elif may and kept >= 0 and best[4 * (read + 1) + kept] + more == left:
            out.append("K")
            read, state = read + 1, kept
        else:
            out.append("R")
            read, state = read + 1, NEXT[state]
    return "".join(out)


def edits(turns: bytes) -> tuple[int, str]:
    """The least cost and its audit."""
    best = distances(turns)
    return best[START], walk(turns, best)


#: Short conversations of equal bytes have one repair.
_short = functools.lru_cache(maxsize=1 << 14)(edits)


def _found(conv, turns: bytearray, first, last, several: int) -> tuple:
    b = np.frombuffer(turns, np.uint8)
    fault, initial = b >> 2, b & 3
    legal = np.isin(initial[:-1] * 4 + initial[1:], (1, 6, 9))  # su, ua, au
    cost, audit = (_short if len(turns) <= 64 else edits)(bytes(turns))
    gaps = 0 if first is None else last - first + 1 - several
    return (conv, gaps, *(int((fault == x).sum()) for x in (BLANK, DUPLICATE, TRUNCATED)), int(len(legal) - legal.sum()), cost, audit)


def _decide(batches):
    """Rows (conv_id, turn, code) in order to a row for each conversation."""
    begun, conv, turns, first, last, several = False, None, bytearray(), None, None, 0
    for batch in batches:
        done = []
        for c, turn, code in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if not begun or c != conv:
                if begun:
                    done.append(_found(conv, turns, first, last, several))
                begun, conv, turns, first, last, several = True, c, bytearray(), None, None, 0
            if code == GONE:
                continue
            turns.append(code)
            if turn is not None and (last is None or turn != last):
                first, last, several = turn if first is None else first, turn, several + 1
        yield _rows(done)
    if begun:
        yield _rows([_found(conv, turns, first, last, several)])


def _rows(rows: list[tuple], schema: str = FOUND) -> pa.RecordBatch:
    names, kinds = zip(*(x.split() for x in schema.split(", ")))
    columns = list(zip(*rows)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k == "long" else pa.string()) for c, k in zip(columns, kinds)], list(names))


def _hashed(batches):
    """Rows of a conversation, its findings first and then its turns, to the findings and the hash of the repaired text."""
    names = [x.split()[0] for x in FOUND.split(", ")]
    schema = f"{FOUND}, repaired_sha256 string"
    found, digest, audit, at, state, any_yet = None, None, "", 0, START, False

    def write(role: str, text: str) -> None:
        nonlocal any_yet
        digest.update((("\n" if any_yet else "") + f"{role}:{text}").encode())
        any_yet = True

    def inserted() -> None:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            state, at = NEXT[state], at + 1
            write("user" if state == USER else "assistant", "")

    def end() -> tuple:
        inserted()
        return (*found, digest.hexdigest())

    for batch in batches:
        done = []
        columns = {c: batch.column(c).to_pylist() for c in (*names, "place", "role", "text")}
        for i, place in enumerate(columns["place"]):
            if place < 0:
                if found is not None:
                    done.append(end())
                found, digest, at, state, any_yet = tuple(columns[c][i] for c in names), hashlib.sha256(), 0, START, False
                audit = found[-1]
                continue
            inserted()
            edit, at, role = audit[at], at + 1, columns["role"][i]
            if edit == "R":
                state = NEXT[state]
                write("user" if state == USER else "assistant", columns["text"][i])
            elif edit == "K":
                state = KEPT[state][INITIALS.index(role[0])]
                write(role, columns["text"][i])
        yield _rows(done, schema)
    if found is not None:
        yield _rows([end()], schema)


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", gone_col: str | None = None) -> DataFrame:
    """``FOUND`` and repaired_sha256, a row a conversation.

    Of a turn the first fault counts: blank (no visible character), duplicate (role and text seen earlier), truncated (the last
    visible character is none of ``.!?``). Keep costs 0, Rerole 1, Delete 2, which blank and duplicate turns need, Insert 5;
    truncated turns that are not deleted add 5. Rows that ``gone_col`` marks only say that their conversation exists.
    """
    text = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    gone = F.coalesce(F.col(f"`{gone_col}`"), F.lit(False)) if gone_col else F.lit(False)
    rows = turns.select(F.col(f"`{conv_col}`").cast("long").alias("conv_id"), F.col(f"`{turn_col}`").cast("long").alias("turn"), text(role_col).alias("role"), text(text_col).alias("text"), gone.alias("gone"))
    rows = placed(rows, ["conv_id", "turn", "role", "text"])
    seen = F.rtrim("text", F.lit(SPACE))
    fault = F.when(seen == "", BLANK).when(F.right(seen, F.lit(1)).isin(".", "!", "?"), SOUND).otherwise(TRUNCATED)
    initial = F.substring("role", 1, 1)
    letter = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    narrow = rows.select("conv_id", "place", "turn", "gone", letter.alias("letter"), fault.alias("fault"), F.unhex(F.md5(F.concat(F.octet_length("role").cast("string"), F.lit(":"), "role", "text"))).alias("said"))
    earlier = F.row_number().over(Window.partitionBy("conv_id", "gone", "said").orderBy("place")) > 1
    fault = F.when((F.col("fault") != BLANK) & earlier, DUPLICATE).otherwise(F.col("fault"))
    codes = narrow.select("conv_id", "place", "turn", F.when(F.col("gone"), GONE).otherwise(4 * fault + F.col("letter")).alias("code"))
    codes = codes.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "place").select("conv_id", "turn", "code")
    found = codes.mapInArrow(_decide, FOUND)
    none = lambda kind: F.lit(None).cast(kind)
    said = rows.filter(~F.col("gone")).select("conv_id", "place", "role", "text", *(none(x.split()[1]).alias(x.split()[0]) for x in FOUND.split(", ")[1:]))
    both = said.unionByName(found.withColumns({"place": F.lit(-1).cast("long"), "role": none("string"), "text": none("string")}))
    in_order = both.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "place")
    return in_order.mapInArrow(_hashed, f"{FOUND}, repaired_sha256 string")


def damaged(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, gone): rows damaged by a hash of their conversation and turn; nulls are one space."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn"))) % 20
    rows = conversations.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), kind.alias("kind"))
    said = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return rows.select("conv_id", "turn", F.when(F.col("kind") == 4, "user").otherwise(F.col("role")).alias("role"), said.alias("text"), (F.col("kind") == 0).alias("gone"), copies.alias("copy")).drop("copy")


def digest(conversations: DataFrame) -> DataFrame:
    return repair(damaged(conversations), gone_col="gone")


_CHEAPEST = "list_min([{}])"
_ADD = "{{'c': {0}.c + {1}, 'a': {0}.a || '{2}'}}"


def _add(state: str, cost: str, edit: str) -> str:
    return _ADD.format(state, cost, edit)


def _least(*ways: str) -> str:
    return _CHEAPEST.format(", ".join(ways))


def _inserting(b: str) -> str:
    """SQL: the cheapest ways to the four states, as (cost, audit), when turns may be inserted."""
    y = [f"{b}[{i}]" for i in range(1, 5)]
    user = _least(y[2], *(_add(y[i], "5", "I") for i in (0, 1, 3)))
    answer = _least(y[3], _add(y[2], "5", "I"), _add(y[0], "10", "II"), _add(y[1], "10", "II"))
    return f"[{y[0]}, {y[1]}, {user}, {answer}]"


def _reading(b: str) -> str:
    """SQL: the same after reading the turn x."""
    y, far = [f"{b}[{i}]" for i in range(1, 5)], "{'c': 1000000000::BIGINT, 'a': ''}"
    when = lambda test, way: f"CASE WHEN {test} THEN {way} ELSE {far} END"
    more, may = "(CASE WHEN x.f = 't' THEN 5 ELSE 0 END)", "x.f IN ('k', 't')"
    ways = [[_add(y[i], "2", "D")] for i in range(4)]
    ways[1] += [when(f"{may} AND x.l = 's'", _add(y[0], more, "K"))]
    for i in (0, 1, 3):
        ways[2] += [when(f"{may} AND x.l = 'u'", _add(y[i], more, "K")), when(may, _add(y[i], f"1 + {more}", "R"))]
    ways[3] += [when(f"{may} AND x.l = 'a'", _add(y[2], more, "K")), when(may, _add(y[2], f"1 + {more}", "R"))]
    return f"[{', '.join(_least(*x) for x in ways)}]"


def oracle_sql(crc32: str) -> str:
    """The cheapest edits forwards, turn by turn; ``crc32`` is SQL for the checksum of a text s."""
    start = "[{'c': 0::BIGINT, 'a': ''}, {'c': 1000000000::BIGINT, 'a': ''}, {'c': 1000000000::BIGINT, 'a': ''}, {'c': 1000000000::BIGINT, 'a': ''}]"
    visible = "[^\\x20\\x09-\\x0D]"
    return f"""
WITH src AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS s FROM conversations
), hit AS (SELECT *, {crc32} % 20 AS kind FROM src
), dam AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(CASE kind WHEN 0 THEN []::INTEGER[] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM hit
), num AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM dam
), bad AS (
  SELECT *, left(role, 1) AS l, CASE WHEN NOT regexp_matches(text, '{visible}') THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
    WHEN NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$') THEN 't' ELSE 'k' END AS f FROM num
), conv AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (f = 'b') AS blank, count(*) FILTER (f = 'd') AS dup, count(*) FILTER (f = 't') AS cut,
    list({{'l': l, 'f': f, 'role': role, 'text': text}} ORDER BY i) AS ts FROM bad GROUP BY conv_id
), every AS (
  SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(dup, 0) AS dup, coalesce(cut, 0) AS cut, coalesce(ts, []) AS ts
  FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN conv ON o.conv_id IS NOT DISTINCT FROM conv.conv_id
), way AS (
  SELECT *, list_reduce(ts, lambda b, x: {_inserting(_reading("b"))}, {_inserting(start)}) AS ends FROM every
), best AS (SELECT *, list_min([ends[1], ends[4]]) AS e FROM way
), ops AS (
  SELECT *, list_filter(list_transform(range(1, strlen(e.a) + 1), lambda j: {{'o': e.a[j], 't': ts[strlen(replace(e.a[1:j], 'I', ''))]}}), lambda z: z.o <> 'D') AS o FROM best
), said AS (
  SELECT *, (CASE WHEN o[1].o = 'K' AND o[1].t.l = 's' THEN 1 ELSE 0 END) AS sys FROM ops
)
SELECT conv_id, gaps, blank, dup AS duplicate, cut AS truncated,
  len(list_filter(range(2, len(ts) + 1), lambda j: (ts[j - 1].l || ts[j].l) NOT IN ('su', 'ua', 'au'))) AS illegal, e.c AS cost, e.a AS audit,
  sha256(array_to_string(list_transform(range(1, len(o) + 1), lambda j: concat(CASE WHEN o[j].o = 'K' THEN o[j].t.role WHEN (j - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END, ':', CASE WHEN o[j].o = 'I' THEN '' ELSE o[j].t.text END)), chr(10))) AS repaired_sha256
FROM said
"""
