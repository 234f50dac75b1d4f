"""SimHash against a plain version over all pairs, and the anchors' promise."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from corvane.llm import simhash

SCHEMA = "doc_id long, text string, fp string, half int, anchor string, home string, root long, least int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(len(w) - 2, min(len(w), 1)))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(fps, ids):
    root = list(range(len(fps)))

    def find(i):
        while root[i] != i:
            root[i] = i = root[root[i]]
        return i

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    least = {}
    for i, x in enumerate(ids):
        if x is not None:
            least[find(i)] = min(least.get(find(i), x), x)
    return [least.get(find(i)) for i in range(len(fps))]


def table():
    pick = random.Random(9)
    prose = lambda n: " ".join(pick.choice(["Wort", "żółw", "日本", "a", "b", "c", "Ärger", *map(str, range(60))]) for _ in range(n))
    base = [prose(n) for n in (3, 7, 80, 300, 300, 1500)]
    texts = [None, "", " \n\t\x0b ", "one", "ONE", "a b", "a  b", "a\tb c", *base, *(b.upper() for b in base[:3])]
    for b in base[2:]:  # near copies
        for _ in range(25):
            w = b.split(" ")
            for _ in range(pick.randrange(1, 4)):
                w[pick.randrange(len(w))] = "new"
            texts.append(" ".join(w))
    rows = [(100 + i, t, "f", 1, "a", "h", 2, 3) for i, t in enumerate(texts)]
    return rows + rows[12:14] + [(None, base[3], "", 1, "", "", 2, 3), (None, "no one else", "", 1, "", "", 2, 3), (7, base[5] + " end", "", 1, "", "", 2, 3), (-3, "", "", 1, "", "", 2, 3)]


ROWS = table()


def test_digest(spark):
    got = simhash.digest(spark.createDataFrame(ROWS, SCHEMA).repartition(4)).collect()
    fps = [plain_fingerprint(r[1]) for r in ROWS]
    want = [(r[0], f"{f:016x}", c) for r, f, c in zip(ROWS, fps, plain_components(fps, [r[0] for r in ROWS]))]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    assert 20 < len({w[2] for w in want}) < len(want) - 20


def test_empty_table(spark):
    assert simhash.digest(spark.createDataFrame([], SCHEMA)).collect() == []


def test_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    fps = [plain_fingerprint(r.text) for r in rows]
    want = [(r.doc_id, f"{f:016x}", c) for r, f, c in zip(rows, fps, plain_components(fps, [r.doc_id for r in rows]))]
    assert sorted(map(tuple, simhash.digest(docs).collect())) == sorted(want)


def test_long_text_is_hashed_in_parts(monkeypatch):
    text = " ".join(str(i * i % 977) for i in range(20_000))
    monkeypatch.setattr(simhash, "PART", 1000)
    assert simhash.fingerprints_of(pa.array(["x y z", text, None, text + " end"])).tolist() == [plain_fingerprint(t) for t in ("x y z", text, None, text + " end")]


def test_anchors_cover_and_meet(spark):
    """Every half has a home within one bit; halves within one bit of each other lie at each other's home; none has over 17 anchors."""
    pick = random.Random(4)
    halves = [0, 2**32 - 1, 2**31, *(pick.randrange(2**32) for _ in range(150))]
    near = [(x, x ^ (1 << b)) for x in halves for b in range(32)]
    home, within = simhash.anchors(F.col("h"))
    of = {r.h: (r.home, set(r.within), len(r.within)) for r in spark.createDataFrame([(x,) for x in sorted({y for p in near for y in p})], "h long").select("h", home.alias("home"), within.alias("within")).collect()}
    for x, (at, anchors, many) in of.items():
        assert (x ^ at).bit_count() <= 1 and at in anchors and many == len(anchors) <= 17
        assert all((x ^ a).bit_count() <= 2 for a in anchors)
    assert all(of[x][0] in of[y][1] and of[y][0] in of[x][1] for x, y in near)


@pytest.mark.parametrize("most", [0, 2, 3])
def test_links_connect_what_all_pairs_connect(spark, most):
    """A dense group: all of a centre's neighbours up to some bits, beside random fingerprints."""
    pick = random.Random(most)
    flips = lambda n: sum(1 << b for b in pick.sample(range(64), n))
    fps = sorted({0xABCDEF0123456789 ^ flips(pick.randrange(7)) for _ in range(300)} | {pick.randrange(2**64) for _ in range(100)})
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    ties = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(x,) for x in signed], "fp long"), most).collect()}
    root = {x: x for x in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in ties:
        root[find(a)] = find(b)
    for i, a in enumerate(fps):
        for j, b in enumerate(fps[:i]):
            if (a ^ b).bit_count() <= most:
                assert find(signed[i]) == find(signed[j])


def test_more_bits_than_the_code_is_made_for(spark):
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 4)
