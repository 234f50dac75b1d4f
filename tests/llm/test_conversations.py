"""Conversation repair and prefix trie against plain versions, on small tables with all the awkward rows."""

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest

from corvane.llm import _order, repair, trie
from corvane.llm.queries import oracle_sql, queries
from tests._sql import connect, same

SCHEMA = "conv_id long, turn long, role string, text string, place string, pos int, said string, gone string, node string, depth string, kind int"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def talk(seed=5, n=60):
    pick = random.Random(seed)
    rows = []
    for c in [*range(-12, n), 10**12]:
        said = 0 if c % 11 == 3 else pick.randrange(1, 14)
        for t in range(said):
            role = pick.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "u"])
            text = pick.choice(["Yes.", "No!\n", "why? ", "and then", "", " \t\n", "1. 2", "Ä ż 日本。", "Yes."]) + (f" {pick.randrange(4)}" if pick.random() < 0.4 else "") if pick.random() < 0.9 else None
            rows.append((c, None if pick.random() < 0.03 else t + (3 if pick.random() < 0.1 else 0), role, text))
    for i in range(4):  # several that are equal all along, and long
        rows += [(1000 + 5 * i, t, ("user", "assistant")[t % 2], f"turn {t}.") for t in range(11)]
    dropped = next(c for c in range(3001, 9000, 5) if zlib.crc32(f"{c}:0".encode()) % 20 == 0 and zlib.crc32(str(c).encode()) % 9 > 1)
    rows += [(dropped, 0, "user", "The group's first one is not there.")]
    rows += [(2000, t % 3, "user", "same.") for t in range(40)] + [rows[3], rows[3]] + [(None, 1, "user", "no id."), (None, 2, "assistant", "none"), (7, None, None, None)]
    return [(*r, "p", 1, "s", "g", "n", "d", 2) for r in rows]


ROWS = talk()


@pytest.fixture(scope="module")
def turns(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5).cache()


@pytest.mark.parametrize("digest", [repair.digest, trie.digest])
def test_empty_table(spark, digest):
    assert digest(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("name", ["op12_conversation_repair", "op13_prefix_trie"])
@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_equals_its_sql(spark, name, folder):
    same(queries()[name](spark, folder), connect(folder), oracle_sql()[name])


def test_insertions_can_be_cheapest(monkeypatch):
    """At other costs, that is."""
    monkeypatch.setattr(repair, "DELETE", 4)
    monkeypatch.setattr(repair, "INSERT", 1)
    assert repair.edits(bytes([1])) == (1, "KI")  # user
    assert repair.edits(bytes([0, 2])) == (1, "KIK")  # system, assistant


def plain_repair(rows):
    """Cheapest edits by a search of (cost, audit so far): the first end that comes off the heap has the least of both."""
    faults, seen = [], set()
    for role, text in rows:
        shown = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not shown else "duplicate" if (role, text) in seen else "truncated" if shown[-1] not in ".!?" else "")
        seen.add((role, text))
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, said = heapq.heappop(heap)
        if i == len(rows) and last in ("", "a"):
            break
        if (i, last) in done:
            continue
        done.add((i, last))
        heapq.heappush(heap, (cost + 5, audit + "I", i, NEXT[last], (*said, ("user" if NEXT[last] == "u" else "assistant", ""))))
        if i < len(rows):
            (role, text), fault = rows[i], faults[i]
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, last, said))
            if fault in ("", "truncated"):
                more = 5 if fault else 0
                if role[:1] == NEXT[last] or (role[:1] == "s" and last == ""):
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[:1], (*said, (role, text))))
                heapq.heappush(heap, (cost + 1 + more, audit + "R", i + 1, NEXT[last], (*said, ("user" if NEXT[last] == "u" else "assistant", text))))
    text = "\n".join(f"{r}:{t}" for r, t in said)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    return (faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit, hashlib.sha256(text.encode()).hexdigest())


def test_repair(turns):
    by = defaultdict(list)
    for c, turn, role, text, *_ in ROWS:
        role, text, by[c] = role if role is not None else " ", text if text is not None else " ", by[c]
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        by[c] += [(turn is not None, turn or 0, "user" if kind == 4 else role, text)] * (kind > 0) * (1 + (kind == 3))
    want = []
    for c, rows in by.items():
        rows.sort()
        known = [r[1] for r in rows if r[0]]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        want.append((c, gaps, *plain_repair([r[2:] for r in rows])))
    assert sorted(map(str, map(tuple, repair.digest(turns).collect()))) == sorted(map(str, want))
    assert {len(x[7]) for x in want} > {0, 1, 2}
    assert set("".join(x[7] for x in want)) == {"D", "K", "R"}, "at these costs a neighbour is deleted sooner than a turn inserted"


@pytest.mark.parametrize("seed", range(3))
def test_dial_equals_plain_search(seed):
    pick = random.Random(seed)
    for _ in range(150):
        rows = [(pick.choice(["system", "user", "assistant", "tool", ""]), pick.choice(["a.", "b", "c!", "", "d?", f"{pick.random()}."])) for _ in range(pick.randrange(9))]
        plain, seen, codes = plain_repair(rows), set(), []
        for role, text in rows:
            fault = repair.BLANK if not text else repair.DUPLICATE if (role, text) in seen else repair.SOUND if text[-1] in ".!?" else repair.TRUNCATED
            seen.add((role, text))
            codes.append(4 * fault + "sua".find(role[:1] or "x") % 4)
        assert repair.edits(bytes(codes)) == plain[4:6]


def test_long_conversation_keeps_its_order(spark):
    """Cut into many ranges, and read again in small batches."""
    n = 3000
    rows = [(1, t, ("user", "assistant")[t % 2], f"turn {t}." + " and so on." * (t % 7)) for t in range(n)] + [(2, 0, "assistant", "x" * 3_000_000)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "64")
    try:
        df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(7)
        found = {r.conv_id: r for r in repair.repair(df).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert (found[1].cost, found[1].audit) == (0, "K" * n)
    assert found[1].repaired_sha256 == hashlib.sha256("\n".join(f"{r[2]}:{r[3]}" for r in rows[:n]).encode()).hexdigest()
    assert (found[2].cost, found[2].audit, found[2].truncated) == (2, "D", 1)


def test_numbering_of_cut_keys(spark):
    df = spark.createDataFrame([(k, i) for k, n in ((1, 500), (2, 1), (3, 90)) for i in range(n)], "k long, i long").repartition(6)
    got = _order.numbered(_order.placed(df, ["k", "i"]), "k").collect()
    assert sorted((r.k, r.pos) for r in got) == sorted((r.k, r.i + 1) for r in got) and all(r.pos == r.i + 1 for r in got) and len(got) == 591


def plain_trie(sequences):
    members, texts = defaultdict(list), {}
    for c, said in sequences.items():
        for d in range(len(said) + 1):
            members[tuple(said[:d])].append(c)
    rows, parents = [], {x[:-1] for x in members if x}
    for node, who in members.items():
        under = [x for x in members if x[: len(node)] == node]
        ends = ",".join(str(c) for c in sorted(who) if len(sequences[c]) == len(node))
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in under if x)
        rows.append((min(who), len(node), min(members[node[:-1]]) if node else None, len(who), sum(len(x) == len(node) + 1 for x in under), sum(x not in parents for x in under), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return rows


def test_trie(turns):
    own = defaultdict(list)
    for c, turn, role, text, *_ in ROWS:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [x[2:] for x in sorted(v)] for c, v in own.items()}
    remainder = lambda c: c - c % 5 if c >= 0 else c + -c % 5  # noqa: E731  as SQL has it
    h = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    rebuilt = {c: tuple(own.get(remainder(c), [])[: h[c]] + own[c][h[c] :]) for c in own}
    assert any(not v for v in rebuilt.values()), "the table should have a conversation that loses all its turns"
    assert sorted(map(tuple, trie.digest(turns).collect()), key=str) == sorted(plain_trie(rebuilt), key=str)


def test_trie_of_one_conversation_and_of_none_with_turns(spark):
    turn = "conv_id long, depth long, said string, bytes long"
    one = trie.prefix_trie(spark.createDataFrame([(5, 1, "a", 3), (5, 2, "b", 4)], turn), spark.createDataFrame([(5,)], "conv_id long"))
    hashed = [hashlib.sha256(x).hexdigest() for x in (b"", b"5")]
    assert sorted(map(tuple, one.collect()), key=lambda r: r[1]) == [(5, 0, None, 1, 1, 1, 0, hashed[0]), (5, 1, 5, 1, 1, 1, 0, hashed[0]), (5, 2, 5, 1, 0, 1, 0, hashed[1])]
    bare = trie.prefix_trie(spark.createDataFrame([], turn), spark.createDataFrame([(8,), (9,)], "conv_id long"))
    assert list(map(tuple, bare.collect())) == [(8, 0, None, 2, 0, 1, 0, hashlib.sha256(b"8,9").hexdigest())]


def test_ends_of_many_in_one_node(spark):
    """More ids than a block has, negative ones too."""
    ids = range(-1500, 3000)
    root = trie.prefix_trie(spark.createDataFrame([], "conv_id long, depth long, said string, bytes long"), spark.createDataFrame([(i,) for i in ids], "conv_id long"))
    assert root.first().ends_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
