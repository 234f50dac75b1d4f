"""The pipeline against the same five steps done plainly on a small table."""

import math
from collections import Counter

import corpus_pipeline
from corvane.llm import mixing, quality, tokens
from tests.llm.test_operators import ROWS, SCHEMA, plain_components, plain_em, plain_features, plain_mix, words

SYMBOLS = "#*$%&|<>"


def test_stages(spark, tmp_path):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    frames = []
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, "").write.parquet(f"{tmp_path}/{i}")
        docs = spark.read.parquet(f"{tmp_path}/{i}")
        frames.append(docs)
        assert i == 4 or docs.columns == frames[0].columns == [c.split(" ")[0] for c in SCHEMA.split(", ")]
    kept = {r.doc_id for r in quality.digest(spark.createDataFrame(ROWS, SCHEMA)).filter("kept").collect()}
    after = [tuple(r) for r in frames[0].collect()]
    assert {r[0] for r in after} == kept
    ids = [r[0] for r in frames[1].collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for _, _, c in plain_components(after) if c is not None})
    before = {r.doc_id: r.text for r in frames[1].collect()}
    for r in frames[2].collect():
        assert r.text == before[r.doc_id] or set(words(r.text)) <= set(words(before[r.doc_id])) and r.n_chars == len(r.text)
    want = sum(r.n_copies for r in mixing.digest(frames[2]).collect())
    assert frames[3].count() == want
    assert sum(r.length for r in frames[4].collect()) == sum(len(r.ids) for r in frames[4].collect())
    assert frames[4].filter("piece = 0").count() == want
    assert math.isclose(frames[4].select("sequence_id", "offset").distinct().count(), frames[4].count())


def plain_votes(text):
    """The ten quality rules and the base rule, word by word."""
    w = words(text)
    n, symbols = len(w), sum(c in SYMBOLS for c in text or "")
    _, chars, _, dup, repeat = plain_features(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    letters = [c for c in text or "" if c.isascii() and c.isalpha()]
    upper, far, top = sum(c.isupper() for c in letters), sum(not c.isascii() for c in text or ""), max(Counter(w).values(), default=0)
    with_symbol = lambda xs: sum(any(c in SYMBOLS for c in x) for x in xs)
    pairs = [
        (symbols * 20 > n, symbols * 100 <= n), (repeat * 10 > n * 3, repeat * 5 <= n), (dup > 2 and dup * 40 > n, dup <= 1 or dup * 100 <= n), (upper * 10 > len(letters) * 3, upper * 10 <= len(letters)),
        (chars < n * 2 or chars > n * 14, n * 3 <= chars <= n * 12), (top * 4 > n > 20, top * 8 <= n), (len(set(w)) * 5 < min(n, 2000), len(set(w)) * 3 >= min(n, 600)),
        (with_symbol(w) * 10 > n, with_symbol(w) * 100 <= n), (with_symbol(lines) * 3 > len(lines), with_symbol(lines) * 10 <= len(lines)), ((len(letters) + far) * 4 < chars * 3, (len(letters) + far) * 20 >= chars * 17),
    ]
    return tuple(-1 if bad else 1 if good else 0 for bad, good in pairs), n < 50 or 100 * repeat > 50 * n


def test_run_is_the_five_steps_done_plainly(spark):
    """run() over the whole small tables: the same documents stay, lose the same passages, are taken as often and come out as the same pieces."""
    from tokenizers import Tokenizer

    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    ballots = [plain_votes(t) for _, t, _ in rows]
    rows = [r for r, p, (_, failed) in zip(rows, plain_em([b for b, _ in ballots]), ballots) if p >= 0.5 and not failed]
    first = {c for _, _, c in plain_components(rows)}
    rows = [r for r in rows if r[0] in first]
    count = Counter(tuple(w[i : i + 35]) for _, t, _ in rows for w in [words(t)] for i in range(len(w) - 34))
    kept = []
    for i, t, source in rows:
        w = words(t)
        gone = {a + b for a in range(len(w) - 34) if count[tuple(w[a : a + 35])] > 1 for b in range(35)}
        if len(gone) < len(w) or not gone:
            kept.append((i, " ".join(x for k, x in enumerate(w) if k not in gone) if gone else t, source))
    copies, library, want = plain_mix(kept), Tokenizer.from_file(tokens.public_path()), Counter()
    for i, t, _ in kept:
        ids = library.encode(t or "", add_special_tokens=False).ids + [2]
        at, piece = 0, 0
        while at < len(ids):
            to = at + (len(ids) - at - 1) % 1024 + 1
            want[i, piece, at, tuple(ids[at:to])] += copies[i]
            at, piece = to, piece + 1
    got, places = corpus_pipeline.run(spark, folder).collect(), {}
    assert len(rows) < 200 and any(c > 1 for c in copies.values())
    assert Counter((r.doc_id, r.piece, r.start, tuple(r.ids)) for r in got) == +want
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in places.values():
        parts.sort()
        assert [a for a, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 1024
    assert len(places) <= math.ceil(sum(r.length for r in got) / 1024) * 1.02 + 2
