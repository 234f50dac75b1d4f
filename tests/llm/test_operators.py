"""Each operator against a plain version, on a small table with all the awkward rows."""

import hashlib
import math
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from corvane.llm import _blocks, jaccard, language, mixing, packing, preference, quality, scoring, substring, tokens, topk
from corvane.llm.queries import oracle_sql, queries
from tests._sql import SMALL, connect, same
from tests.test_growth import written

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, id long, block string, key string, carry_0 string, row string, bucket int, token string"
pick = random.Random(3)
VOCABULARY = [f"w{i}" for i in range(400)] + ["Ärger", "żółw", "日本", "x*#", "LOUD"]


def words(text):
    return WORD.findall(text or "")


def prose(n):
    return " ".join(pick.choice(VOCABULARY) for _ in range(n))


def table():
    base = [prose(120) for _ in range(12)]
    passage = prose(60)
    texts = [None, "", " \n\t ", "one", "a b c", "a b c", prose(9000), "spam " * 300, prose(49), prose(50)]
    texts += base + base[:3] + [base[0] + " end"] + [base[1].replace("w", "W")] + ["first " + base[2]]
    texts += [f"{prose(30)} {passage} {prose(20 + i)}" for i in range(5)] + ["line one\nline one\n\nline two\nline one"]
    near = prose(100).split(" ")
    texts += [" ".join(near[:i] + ["new"] + near[i + 1 :]) for i in range(0, 100, 9)]
    rows = [(i, t, ("en", "de", None)[i % 3], ("b", "a", None, "c")[i % 4], None if t is None else len(t), -i, "b", "k", "c", "r", 1, "t") for i, t in enumerate(texts)]
    return rows + [rows[12], (None, base[4], None, None, 1, None, None, None, None, None, None, None), (None, None, "en", "a", None, 1, "", "", "", "", 0, "")]


ROWS = table()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def ordered(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("digest", [mixing.digest, quality.digest, jaccard.digest, substring.digest, language.digest, scoring.digest, tokens.digest, packing.digest])
def test_empty_table(empty, digest):
    assert digest(empty).collect() == []


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_its_sql(spark, name):
    same(queries()[name](spark, SMALL), connect(), oracle_sql()[name])


# 1 ---------------------------------------------------------------------------

def plain_targets(rows):
    """Words by source, and their targets, for (id, text, source) rows."""
    size = Counter()
    for _, text, source in rows:
        size[source] += len(words(text))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(size, key=lambda s: (s is None, s)))}
    target, free, left = {}, set(size), float(sum(size.values()))
    while free:
        level = left / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > 3 * size[s]]
        for s in over or free:
            target[s] = 3.0 * size[s] if over else level * weight[s]
        left -= sum(target[s] for s in over)
        free = free - set(over) if over else set()
    return size, target


def plain_mix(rows):
    """Copies of each (id, text, source) row, ids being distinct, by the definition of Pareto order sampling."""
    size = {i: len(words(t)) for i, t, _ in rows}
    u = {i: (int(hashlib.md5(f"17|{i}|{t or ''}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52 for i, t, _ in rows}
    of, target = plain_targets(rows)
    out = {i: 0 for i in size}
    for s in of:
        mine = [i for i, _, source in rows if source == s and size[i]]
        appeal = {i: (1 + math.floor(math.log2(size[i]))) ** 0.5 for i in mine}
        low, high = 0.0, 10.0
        for _ in range(200):
            mid = (low + high) / 2
            low, high = (mid, high) if sum(size[i] * min(3, mid * appeal[i]) for i in mine) < target[s] else (low, mid)
        chance = {i: min(3, low * appeal[i]) for i in mine}
        chance = {i: round(e) if abs(e - round(e)) < 1e-9 else e for i, e in chance.items()}
        sure = {i: math.floor(e) for i, e in chance.items()}
        p = {i: chance[i] - sure[i] for i in mine if chance[i] > sure[i]}
        order = sorted(p, key=lambda i: u[i] / (1 - u[i]) * (1 - p[i]) / p[i])
        missing = target[s] - sum(size[i] * sure[i] for i in mine)
        take = min(range(len(order) + 1), key=lambda n: (abs(sum(size[i] for i in order[:n]) - missing), n)) if order else 0
        out |= {i: sure[i] + (i in order[:take]) for i in mine}
    return out


def test_mixing(docs):
    got = mixing.digest(docs).collect()
    size, target = plain_targets([(r[0], r[1], r[3]) for r in ROWS])
    assert ordered((r.doc_id, r.size, r.source_size, round(r.target, 6)) for r in got) == ordered((r[0], len(words(r[1])), size[r[3]], round(target[r[3]], 6)) for r in ROWS)
    assert all(r.taken % max(1, r.size) == 0 and r.taken <= 3 * r.size for r in got)
    by = Counter()
    for r in got:
        by[r.source_size] += r.taken
    most = {size[s]: max(len(words(r[1])) for r in ROWS if r[3] == s) for s in size}
    assert all(abs(by[size[s]] - target[s]) <= most[size[s]] for s in size)
    assert ordered(got) == ordered(mixing.digest(docs.repartition(5)).collect())
    assert sum(r.n_copies for r in got) == mixing.apply_mix(docs).count()
    assert mixing.apply_mix(docs).columns == docs.columns


def test_mixing_order_is_paretos(spark, monkeypatch):
    """Copies of each document by the definition; longer documents have better odds, and the join works without a broadcast."""
    draw = random.Random(31)
    rows = [(i, " ".join(["w"] * draw.randrange(1, 400)), "abc"[min(2, i % 7)]) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = plain_mix(rows)
    copies = lambda: {r.doc_id: r.n_copies for r in mixing.mix(df).select("row.doc_id", "n_copies").collect()}
    assert copies() == want and len(set(want.values())) > 1
    monkeypatch.setattr(mixing, "BROADCAST_ROWS", 0)
    assert copies() == want


# 2 ---------------------------------------------------------------------------

def plain_features(text):
    w = words(text)
    tri = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    covered = {i + j for i in range(len(w) - 2) if tri[tuple(w[i : i + 3])] > 1 for j in range(3)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), dup, len(covered)


def test_quality_features(docs):
    got = quality.digest(docs).collect()
    want = [(r[0], *plain_features(r[1])) for r in ROWS]
    assert ordered((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == ordered(want)
    for r in got:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed) and 0 <= r.p_good <= 1


def test_quality_on_labels(spark):
    got = quality.digest(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id").filter("not base_failed").toPandas()
    assert got[got.quality == 1].kept.mean() > 0.98 and got[got.quality == 0].kept.mean() < 0.05


def plain_em(ballots, rounds=100):
    """Two classes, votes independent given the class, ballot by ballot."""
    bad = [min(0.99, max(0.01, b.count(-1) / 2)) for b in ballots]
    for _ in range(rounds):
        share = [(sum(1 - x for x in bad) + 1) / (len(ballots) + 2), (sum(bad) + 1) / (len(ballots) + 2)]
        rates = []
        for weight in ([1 - x for x in bad], bad):
            rates.append([{v: (sum(w for w, b in zip(weight, ballots) if b[r] == v) + 1) / (sum(weight) + 3) for v in (-1, 0, 1)} for r in range(len(ballots[0]))])
        odds = [[share[k] * math.prod(rates[k][r][v] for r, v in enumerate(b)) for k in (0, 1)] for b in ballots]
        bad = [o[1] / sum(o) for o in odds]
    return [1 - x for x in bad]


def test_quality_posterior(docs):
    names = [f"vote_{k}" for k in quality.rules()]
    rows = quality.judge(docs).collect()
    ballots = [tuple(r[n] for n in names) for r in rows]
    want = plain_em(ballots)
    assert [r.p_good for r in rows] == pytest.approx(want, abs=1e-6)
    assert [r.kept for r in rows] == [not r.base_failed and p >= 0.5 for r, p in zip(rows, want)]


def test_quality_weighs_rules_by_their_accuracy():
    """A rule that calls a third of all good documents bad loses its weight: one bad vote from it is not one from a rule that agrees with others."""
    draw = random.Random(2)
    votes = lambda bad: tuple(-1 if draw.random() < (x if bad else y) else 1 for x, y in ((0.9, 0.01), (0.9, 0.01), (0.9, 0.01), (0.4, 0.33)))
    ballots = Counter(votes(i % 5 == 0) for i in range(4000))
    share, rates = quality.fit(list(ballots.items()))
    assert share[1] == pytest.approx(0.2, abs=0.02) and rates[0, :, 0] == pytest.approx([0.01, 0.01, 0.01, 0.33], abs=0.03) and rates[1, :3, 0] == pytest.approx([0.9] * 3, abs=0.03)
    good = lambda b: 1 / (1 + share[1] / share[0] * math.prod(rates[1, r, v + 1] / rates[0, r, v + 1] for r, v in enumerate(b)))
    assert good((1, 1, 1, -1)) > 0.99 > 0.9 > good((-1, 1, 1, 1)) and good((-1, -1, 1, 1)) < 0.1


def test_columns_of_any_name(spark):
    """Names with dots and those that operators use themselves."""
    df = spark.createDataFrame([(1, prose(60), "s", 5, "x"), (2, None, None, 6, "y")], "`doc.id` long, `the.text` string, `s.c` string, id int, _key_ string")
    options = {"id_col": "doc.id", "text_col": "the.text"}
    kept = quality.judge(df, **options, carry=tuple(df.columns))
    assert ordered(kept.select(*(F.col(f"carry_{i}") for i in range(5))).collect()) == ordered(df.collect())
    assert jaccard.keep_one(df, **options).columns == df.columns and substring.remove_repeats(df, **options, carry=("s.c", "id")).count() == 2
    assert tokens.count_tokens(df, tokens.public_path(), **options).count() == packing.pack(df, tokens.public_path(), **options).count() == scoring.score(df, **options).count() == 2


# 3 ---------------------------------------------------------------------------

def plain_components(rows):
    sets = []
    for i, text, *_ in rows:
        w = [re.sub("[A-Z]", lambda m: m[0].lower(), x) for x in words(text)]
        sets.append({tuple(w[a : a + 5]) for a in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
                root[find(a)] = find(b)
    least = {}
    for i, (k, *_) in enumerate(rows):
        if k is not None:
            least[find(i)] = min(least.get(find(i), k), k)
    return sorted(((k, len(s), least.get(find(i))) for i, ((k, *_), s) in enumerate(zip(rows, sets))), key=str)


def test_jaccard(docs):
    got = [tuple(r) for r in jaccard.digest(docs).collect()]
    assert ordered(got) == plain_components(ROWS)
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [r[0] for r in kept.collect()]
    want = {c for _, n, c in plain_components(ROWS) if n} | {r[0] for r in ROWS if not words(r[1]) and r[0] is not None}
    assert {i for i in ids if i is not None} == want and len(ids) == len(set(ids)) + (ids.count(None) - 1 if None in ids else 0)


def test_jaccard_chains(spark):
    """Chains of near copies and pairs about the threshold, over many blocks."""
    base = [prose(60).split(" ") for _ in range(8)]
    rows = []
    for b in base:
        w = list(b)
        for step in range(14):
            rows.append((len(rows), " ".join(w)))
            w[(step * 5) % 60] = f"n{pick.randrange(10**6)}"
            if step % 4 == 3:
                w[(step * 7 + 2) % 60] = "both"
    got = [tuple(r) for r in jaccard.groups(spark.createDataFrame(rows, "doc_id long, text string"), block_bytes=2000).select("id", "n_shingles", "component_id").collect()]
    assert ordered(got) == plain_components(rows)


def test_keep_one_is_by_group(spark):
    """An id in several groups keeps a document in each; of a group without any id one document stays."""
    draw = random.Random(11)
    text = lambda: [f"k{draw.randrange(10**6)}" for _ in range(80)]
    near = lambda w, i: w[:i] + ["other"] + w[i + 1 :]
    a, b, c, d = (text() for _ in range(4))
    # Group a has ids 1 and 2, group b id 1 again, group c no ids, group d none and 7; two texts of id 3 are alone.
    groups = {"a": [(1, a), (2, near(a, 40))], "b": [(1, b), (1, near(b, 3))], "c": [(None, c), (None, near(c, 20)), (None, near(c, 60)), (None, c)], "d": [(None, d), (7, near(d, 9))], "e": [(3, text())], "f": [(3, text())]}
    rows = [(i, " ".join(w), g) for g, members in groups.items() for i, w in members]
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id long, text string, g string"), block_bytes=1000).collect()
    assert ordered((r.g, r.doc_id) for r in kept) == ordered([("a", 1), ("b", 1), ("c", None), ("d", 7), ("e", 3), ("f", 3)])


# 4 ---------------------------------------------------------------------------

def test_top_k(spark):
    draw = random.Random(5)
    vectors = [(i, [draw.uniform(-1, 1) for _ in range(8)]) for i in range(300)] + [(50, None), (100, [0.5, None]), (150, [float("nan")] * 8), (None, [0.1] * 8)]
    vectors += [(i + 1000, vectors[3][1]) for i in range(8)]
    df = spark.createDataFrame([(*v, "x") for v in vectors], "vec_id long, embedding array<double>, id string")
    sound = [(i, [math.floor(256 * x) for x in v]) for i, v in vectors if i is not None and v is not None and None not in v and all(map(math.isfinite, v))]
    want = []
    for i, q in sound:
        if i % 50 == 0:
            best = sorted(((-sum(a * b for a, b in zip(q, v)), j) for j, v in sound if j != i))[:5]
            want += [(i, rank, j, -s) for rank, (s, j) in enumerate(best, 1)]
    assert ordered(tuple(r) for r in topk.digest(df).collect()) == ordered(want)
    from pyspark.sql import functions as F

    assert ordered(tuple(r) for r in topk.top_k(df, F.col("id") % 50 == 0, shard_rows=40, block_rows=3, leaf=8).collect()) == ordered(want)
    assert topk.digest(df.limit(0)).collect() == []


# 5 ---------------------------------------------------------------------------

def test_substring(docs):
    count = Counter(tuple(w[i : i + 35]) for r in ROWS for w in [words(r[1])] for i in range(len(w) - 34))
    want, texts = [], []
    for r in ROWS:
        w = words(r[1])
        gone = {i + j for i in range(len(w) - 34) if count[tuple(w[i : i + 35])] > 1 for j in range(35)}
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        want.append((r[0], len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
        texts.append((r[0], kept if gone else r[1]))
    assert ordered(tuple(r) for r in substring.digest(docs).collect()) == ordered(want)
    done = substring.remove_repeats(docs, with_text=True, carry=("source", "block"), block_bytes=3000)
    assert ordered((r.id, r.kept_text) for r in done.collect()) == ordered(texts)
    assert substring.paths(done).filter("places < 2 or not same_words").count() == 0


def plain_removed(texts, k):
    count = Counter(tuple(w[i : i + k]) for w in texts for i in range(len(w) - k + 1))
    return [len({i + j for i in range(len(w) - k + 1) if count[tuple(w[i : i + k])] > 1 for j in range(k)}) for w in texts]


def test_substring_branches(spark):
    """Paths that part after an edge, and one that ends where another begins, are cut there; places of each have the same words."""
    p = [f"p{i}" for i in range(35)]
    texts = [p + ["a"], p + ["b"], p[1:] + ["a"], p[1:] + ["b"], p[:34]]
    done = substring.remove_repeats(spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string"), block_bytes=200)
    assert ordered((r.id, r.n_removed) for r in done.collect()) == [(0, 36), (1, 36), (2, 35), (3, 35), (4, 0)]
    assert sorted((r.length, r.places, r.same_words) for r in substring.paths(done).collect()) == [(35, 2, True)] * 3


def test_substring_shuffles_runs_and_nodes_once(spark):
    """Adding up and answering share a shuffle: with two of each, 1.4 times the texts was written here."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    assert written(spark, lambda: substring.digest(docs)) < 1.3 * size


def test_substring_on_few_words(spark):
    """Texts over two or three words are full of forks, loops and repeats inside one text; long anchors come in them more than once."""
    draw = random.Random(23)
    texts = [[draw.choice("xyz"[: 2 + i % 2]) for _ in range(draw.randrange(1, 90))] for i in range(60)] + [["x"] * 50, ["x", "y"] * 40, ["x"] * 4, ["x"] * 5]
    texts += [texts[3][5:40] + texts[7][:30], texts[3] + ["z"]]
    df = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    for k in (5, 16):
        done = substring.remove_repeats(df, k=k, block_bytes=300)
        assert [r.n_removed for r in sorted(done.collect())] == plain_removed(texts, k)
        assert substring.paths(done).filter("places < 2 or not same_words").count() == 0


def test_words_that_meet_in_linear_hashes(spark):
    """Thue-Morse words and their opposites meet in every hash that is a polynomial modulo 2**64."""
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    other, rest = word.translate(str.maketrans("ab", "ba")), [f"r{i}" for i in range(40)]
    df = spark.createDataFrame([(0, " ".join(rest[:20] + [word] + rest[20:34])), (1, " ".join(rest[:20] + [other] + rest[20:34])), (2, f"{word} x\n{other} x\n{word} x")], "doc_id long, text string")
    assert [r.n_removed for r in sorted(substring.digest(df).collect())] == [0, 0, 0]
    assert [r.n_dup_lines for r in sorted(quality.digest(df).collect())] == [0, 0, 1]


# 6 ---------------------------------------------------------------------------

def test_preference(spark):
    turns = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes"), (0, 2, "user", "ok"), (1, 0, "user", "hi"), (1, 1, "assistant", "no"), (2, 0, "user", None), (3, 0, None, "x"), (4, 0, "user", "alone"), (6, 0, "user", "s"), (7, 0, "user", "s"), (7, 0, "user", "s"), (None, 0, "user", "u"), (0, None, "user", "u")]
    df = spark.createDataFrame([(*t, "z") for t in turns], "conv_id long, turn long, role string, text string, part string")
    segments = preference.digest(df)
    by = {r.pair_id: r for r in preference.assemble(segments).collect()}
    assert set(by) == {0, 1, 3}
    assert by[0].prompt == "<|user|>\nhi\n" and by[0].chosen == "<|assistant|>\nyes\n<|user|>\nok\n" and by[0].rejected == "<|assistant|>\nno\n"
    assert [t.trained for t in by[0].chosen_turns] == [True, False]
    assert by[1].prompt == "" and by[3].chosen == "" and by[3].prompt == "<|user|>\ns\n"


def test_preference_shared_prompts(spark):
    """Over all conversations of a table: what comes before the last answer is the prompt, and the other answer is another conversation's."""
    rows = spark.read.parquet(f"{SMALL}/conversations.parquet").collect()
    talks = {i: sorted((r.turn, r.role, r.text) for r in rows if r.conv_id == i) for i in {r.conv_id for r in rows}}
    last = {i: max(t for t in talk if t[1] == "assistant") for i, talk in talks.items() if any(t[1] == "assistant" for t in talk)}
    show = lambda turns: "".join(f"<|{role}|>\n{text}\n" for _, role, text in turns)
    got = preference.assemble(queries()["op6_preference_shared"](spark, SMALL)).collect()
    assert len(got) == len(talks)
    used = []
    for r in got:
        talk = talks[r.pair_id]
        cut = last[r.pair_id][0] if r.pair_id in last else math.inf
        assert r.prompt == show(t for t in talk if t[0] < cut) and r.chosen == show(t for t in talk if t[0] >= cut)
        if r.pair_id in last:
            tail = show(t for t in talk if t[0] > cut)
            assert r.rejected.endswith(tail) and r.rejected != r.chosen and r.rejected_turns[0].trained and r.chosen_turns[0].trained
            used.append(r.rejected.removesuffix(tail))
    assert sorted(used) == sorted(show([t]) for t in last.values()) and any(r.prompt and r.chosen for r in got)


# 7 ---------------------------------------------------------------------------

def test_language(spark, docs):
    got = language.digest(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).join(spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang", "text"), "doc_id").filter("lang is not null and lang_pred <> 'und'").toPandas()
    for r in got.head(50).itertuples():
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
    held = got[got.held_out & (got.text.str.split().str.len() >= 20)]
    assert (held.lang == held.lang_pred).mean() > 0.97
    odd = {r.doc_id: r for r in language.digest(docs).collect()}
    assert odd[0].lang_pred == "und" and odd[1].lang_pred == "und" and odd[0].score == 0 and odd[4].lang_pred in ("en", "de")
    assert all(0 <= r.score <= 1 for r in odd.values())


def test_language_sums_all_segmentations():
    names = [b"a", b"b", b"ab", b" ", b" a", b"ba", b"abababababababab"]
    pieces = language.Pieces(set(names))
    p = np.zeros((len(pieces.known) + 1, 2))
    chance = {x: (i + 1) / 40 for i, x in enumerate(names)}
    for x in names:
        p[np.searchsorted(pieces.known, np.uint64(language._piece_hash(x)))] = chance[x], chance[x] / 3

    def total(s, part):
        sums = [1.0]
        for end in range(1, len(s) + 1):
            sums.append(sum(chance[x] * part * sums[end - len(x)] for x in names if s[:end].endswith(x)))
        return sums[-1]

    for word in (b"a", b"ab", b"abba", b"ab" * 12, b"ab" * 40, b"abbaa" * 9):
        body = np.frombuffer(b" " + word, np.uint8)[None, :]
        got = language.Lattice(body, pieces).forward(p)[0]
        assert got == pytest.approx([math.log(total(b" " + word, 1.0)), math.log(total(b" " + word, 1 / 3))], abs=1e-9)


def test_language_takes_all_pieces_and_long_words(spark):
    """Every piece of the file is one; a language without spaces teaches from its long words, and a long word takes no time of its own kind."""
    import base64

    path = tokens.public_path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as f:
        n = len({base64.b64decode(x.split()[0]) for x in f if x.strip()} | {bytes([b]) for b in range(256)})
    assert len(language.Pieces.of_file(path).known) == n
    assert b"".join(language._parts(("日本語" * 40).encode())) == b" " + ("日本語" * 40).encode() and all(x.decode() for x in language._parts(("日本語" * 40).encode()))
    draw, kana, han = random.Random(9), "あいうえおかきくけこさしすせそ", "天地玄黄宇宙洪荒日月盈昃辰宿"
    texts = [("".join(draw.choice(a) for _ in range(draw.randrange(60, 200))), lang) for _ in range(60) for a, lang in ((kana, "ja"), (han, "zh"))]
    texts += [("あいうえお" * 4000, "ja")]
    got = language.digest(spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "doc_id long, text string, lang string")).collect()
    assert all(r.lang_pred == texts[r.doc_id][1] and r.score > 0.99 for r in got)


def test_language_em_raises_the_likelihood():
    pieces = language.Pieces({b"the", b"th", b"he", b" t", b" the"})
    words, counts = [b"the", b"then", b"he", b"x" * 100], np.array([9.0, 2.0, 3.0, 1.0])

    def likelihood(rounds):
        p = language.fit(words, counts, pieces, rounds)
        assert p.sum() == pytest.approx(1)
        return sum(n * language.Lattice(np.frombuffer(x, np.uint8)[None, :], pieces).forward(p[:, None])[0, 0] for w, n in zip(words, counts) for x in language._parts(w))

    values = [likelihood(i) for i in range(4)]
    assert values == sorted(values) and values[3] > values[0]


# 8 ---------------------------------------------------------------------------

def plain_share(counts, once):
    """The prior at which contexts of these counts back off for ``once`` of their tokens, by plain bisection."""
    low, high = 1e-3, 1e7
    for _ in range(100):
        a = math.sqrt(low * high)
        low, high = (a, high) if sum(c * a / (c + a) for c in counts) < once else (low, a)
    return low


def plain_model(rows, least=2):
    """Texts, counts of words, and p(context, word) by the recursive definition, not by states and arcs."""
    lower = lambda s: re.sub("[A-Z]", lambda m: m[0].lower(), s)
    texts = [(r[0], [*map(lower, words(r[1])), None], zlib.crc32(str("" if r[0] is None else r[0]).encode()) % 7 == 2) for r in rows]
    one, two, three = Counter(), Counter(), Counter()
    for _, t, held in texts:
        if not held:
            t = [0, *t]
            one.update(t)
            two.update(zip(t, t[1:]))
            three.update(zip(t, t[1:], t[2:]))
    n, v = sum(k for w, k in one.items() if w != 0), len([w for w in one if w != 0])
    a = plain_share([k for w, k in one.items() if w is not None], sum(k == 1 for k in two.values()))
    b = plain_share([k for k in two.values() if k >= least], sum(k == 1 for w, k in three.items() if two[w[:2]] >= least))

    def p(context, w):
        if not context:
            return (one[w] + 1) / (n + v + 1)
        if len(context) == 1:
            return (two[(*context, w)] + a * p((), w)) / (one[context[0]] + a)
        shorter = p(context[1:], w)
        return (three[(*context, w)] + b * shorter) / (two[context] + b) if two[context] >= least else shorter

    return texts, one, n, p


def plain_scores(rows):
    texts, one, n, p = plain_model(rows)
    for k, t, held in texts:
        full = [0, *t]
        whole = sum(math.log10(p(tuple(full[max(0, i - 2) : i]), full[i])) for i in range(1, len(full)))
        yield k, held, len(t), sum(one[w] > 0 for w in t), n, sum(math.log10(p((), w)) for w in t), whole


def test_scoring(docs):
    want, got = {}, {}
    for *key, base, whole in plain_scores(ROWS):
        want.setdefault(tuple(key), []).append((base, whole))
    for r in scoring.score(docs, block_bytes=20000).collect():
        got.setdefault((r.id, r.held_out, r.n_tokens, r.n_known, r.train_tokens), []).append((r.base_score, r.score))
    assert got.keys() == want.keys()
    for k in want:
        for x, y in zip(sorted(got[k]), sorted(want[k])):
            assert x == pytest.approx(y, abs=1e-6)


def test_scoring_learns_from_nothing(spark):
    held = [i for i in range(60) if zlib.crc32(str(i).encode()) % 7 == 2]
    rows = [(i, "a b a b", *[None] * 3) for i in held]
    got = scoring.digest(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()
    assert [(r.train_tokens, r.n_known, round(r.base_score, 9), round(r.score, 9)) for r in got] == [(0, 0, 0.0, 0.0)] * len(held)


def test_scoring_after_known_and_unknown_contexts(spark):
    """Held-out texts that go on with each word of the vocabulary and with a new one."""
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 7 == 2]
    train = [i for i in range(400) if i not in held]
    learnt = [(train[i], t) for i, t in enumerate(["a b a c b a", "a b a", "c b b", "a b c", "b"])]
    for before in ("a b", "c", "x y", ""):
        texts = [f"{before} {w}".strip() for w in ("a", "b", "c", "new")] + [before]
        got = {r.doc_id: r.score for r in scoring.digest(spark.createDataFrame(learnt + list(zip(held, texts)), "doc_id long, text string")).collect()}
        rows = [(*r, None, None, None) for r in learnt + list(zip(held, texts))]
        for r in plain_scores(rows):
            assert got[r[0]] == pytest.approx(r[-1], abs=1e-9)


def test_scoring_is_a_distribution():
    """After whatever words, the probabilities of the whole vocabulary, the end and one unknown word add up to one in the definition that ``test_scoring`` holds the automaton to."""
    _, one, _, p = plain_model([r for r in ROWS if len(r[1] or "") < 2000])
    every = [w for w in one if w != 0] + ["unknown"]
    known = [w for w in every if w is not None]
    for context in ((), (0,), (known[0],), ("unknown",), (0, known[0]), *zip(known[:12], known[1:13]), ("unknown", known[3])):
        assert sum(p(context, w) for w in every) == pytest.approx(1)


def test_smoothing_is_estimated():
    for counts, once in (([1, 1, 2, 5, 30], 7), ([3] * 9, 1), ([1], 1), ([9, 9], 0), ([], 0)):
        got = scoring.estimate([(1, c) for c in counts], once)
        assert got == pytest.approx(max(1e-3, plain_share(counts, once)), rel=1e-6)
    many = np.random.default_rng(1).integers(1, 10**6, 4000)
    of = scoring._classes(many)
    classes = [(int((of == c).sum()), int(many[of == c].sum())) for c in np.unique(of)]
    assert scoring.estimate(classes, int(many.sum() * 0.4)) == pytest.approx(plain_share(many.tolist(), int(many.sum() * 0.4)), rel=1e-3)


def test_held_out_texts_score_above_the_base(spark):
    """On whole tables, by half a digit a token; the bound holds at sf0.1 too."""
    r = scoring.digest(spark.read.parquet("/root/testdata/sf0.01/documents.parquet")).filter("held_out").agg(F.sum("n_tokens").alias("n"), F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert r.s / r.n > r.b / r.n + 0.3


# 9, 10 -----------------------------------------------------------------------

@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.public_path())


ODD = ["don't  stop <|endoftext|> now", "naïve – “quotes” 日本語 😀", "a" * 3000, " x y ͅz", "12 345", "x\ny\r\n\tz  "]


def test_token_counts(spark, docs, library):
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    rows = [(r[0], r[1]) for r in ROWS] + [(1000 + i, t) for i, t in enumerate(ODD)]
    got = tokens.digest(docs.select("doc_id", "text").unionAll(more)).collect()
    want = [(k, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for k, t in rows]
    assert ordered(map(tuple, got)) == ordered(want)
    # many pages and buckets, the same pre-tokens on all of them
    again = tokens.count_tokens(docs.select("doc_id", "text").unionAll(more).repartition(2), tokens.public_path(), most_known=0, bucket_bytes=9000).collect()
    assert ordered(map(tuple, again)) == ordered(w[:3] for w in want)


def test_token_counts_of_other_tokenizers(spark):
    """A tokenizer that cuts texts otherwise is asked for whole texts."""
    from tokenizers import Tokenizer

    path = tokens.public_path("word_bpe_49k.json")
    other = Tokenizer.from_file(path)
    got = tokens.count_tokens(spark.createDataFrame(list(enumerate([*ODD, None])), "doc_id long, text string"), path).collect()
    assert sorted((r.id, r.n_tokens) for r in got) == [(i, len(other.encode(t or "", add_special_tokens=False).ids)) for i, t in enumerate([*ODD, None])]


def test_packing(spark, docs, library):
    more = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(ODD)], "doc_id long, text string")
    rows = [(r[0], r[1]) for r in ROWS] + [(1000 + i, t) for i, t in enumerate(ODD)]
    got = packing.digest(docs.select("doc_id", "text").unionAll(more)).collect()
    want = []
    for k, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        at, piece = 0, 0
        while at < len(ids):
            to = at + (len(ids) - at - 1) % 1024 + 1
            want.append((k, piece, at, to - at, zlib.crc32(struct.pack(f"<{to - at}I", *ids[at:to]))))
            at, piece = to, piece + 1
    assert ordered(tuple(r)[:5] for r in got) == ordered(want)
    assert all(r.length == 1024 or r.piece == 0 for r in got)
    by = {}
    for r in got:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(by) <= math.ceil(sum(r.length for r in got) / 1024) + 2


def test_packing_patterns():
    """Of all patterns the best are found, and plans hold each length as often as it comes, in close to the fewest sequences."""
    draw = np.random.default_rng(4)
    value, lengths = draw.normal(size=31), np.array([3, 5, 7, 8, 11, 13, 20, 30])
    every = {tuple(sorted((a, b, c), reverse=True)) for a in lengths for b in (0, *lengths) for c in (0, *lengths) if a + b + c <= 30}
    total = {p: sum(value[v] for v in p if v) for p in every}
    found = {tuple(p) for p in packing.improving(value, lengths, 30, 0.0).tolist()}
    assert {total[p] for p in found} == {t for t in (min(total[p] for p in every if v in p) for v in lengths.tolist()) if t < 0}
    for n, spread in ((60, 1.0), (5000, 1.0), (100000, 2.0)):
        sizes = np.minimum(1024, 1 + (1024 * draw.random(n) ** spread).astype(int))
        histogram = np.bincount(sizes, minlength=1025)
        groups = packing.plan(histogram, 1024)
        held = np.zeros(1025, np.int64)
        for shape, k in groups:
            assert sum(shape) <= 1024
            for v in shape:
                held[v] += k
        assert (held == histogram).all()
        big = int((sizes > 512).sum())
        assert sum(k for _, k in groups) <= max(big, math.ceil(sizes.sum() / 1024)) * 1.02 + 2


# Many rows that say little ------------------------------------------------------

def test_many_empty_and_equal_rows(spark):
    """A hundred thousand empty rows and ten thousand equal ones without an id: spread over blocks, none lost."""
    text = prose(40)
    few = spark.range(4).select(F.col("id").alias("doc_id"), F.concat(F.lit(text), F.lit(" "), F.col("id").cast("string")).alias("text"))
    df = spark.range(100_000).select(F.col("id").alias("doc_id"), F.lit("").alias("text")).unionAll(spark.range(10_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit(text).alias("text"))).unionAll(few)
    blocked, n, _ = _blocks.deal(df, "doc_id", "text", block_bytes=200_000)
    assert n > 8 and blocked.select("block").distinct().count() > 8
    removed = {(r.n_words, r.n_removed): r["count"] for r in substring.remove_repeats(df, block_bytes=200_000).groupBy("n_words", "n_removed").count().collect()}
    assert removed == {(0, 0): 100_000, (40, 40): 10_000, (41, 40): 4}
    groups = {(r.n_shingles, r.component_id): r["count"] for r in jaccard.groups(df, block_bytes=200_000).filter("n_shingles > 0").groupBy("n_shingles", "component_id").count().collect()}
    assert groups == {(36, 0): 10_000, (37, 0): 4}
    assert scoring.score(df, block_bytes=200_000).groupBy("n_tokens").count().orderBy("n_tokens").collect() == [(1, 100_000), (41, 10_000), (42, 4)]
