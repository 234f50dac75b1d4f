"""A text above one slice through every operator on texts; empty tables and odd rows for the rest."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from corvane.llm import _text, jaccard, language, mixing, packing, preference, quality, scoring, simhash, substring, tokens
from tests.llm.test_simhash import plain_fingerprint

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def long_docs(spark):
    pick = random.Random(8)
    vocabulary = [f"wort{i}" for i in range(3000)] + ["żółw", "日本"]
    text = " ".join(pick.choice(vocabulary) for _ in range(420_000))
    assert len(text.encode()) > 3 * _text.SLICE_BYTES
    passage = " ".join(text.split(" ")[200_000:200_050])
    texts = {1: text, 2: f"before {passage} after", 3: "plain short text", 4: text}
    df = spark.createDataFrame([(i, t, "de", "a", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars int").repartition(2).cache()
    return texts, df


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_long_text_quality(long_docs):
    texts, df = long_docs
    got = by_id(quality.digest(df))
    for i, t in texts.items():
        w = WORD.findall(t)
        assert (got[i].n_words, got[i].word_chars) == (len(w), sum(map(len, w)))


def test_long_text_sets_and_repeats(long_docs):
    texts, df = long_docs
    sets = by_id(jaccard.digest(df))
    w = {i: WORD.findall(t) for i, t in texts.items()}
    shingles = {i: {tuple(x[k : k + 5]) for k in range(max(1, len(x) - 4))} for i, x in w.items()}
    assert {i: (r.n_shingles, r.component_id) for i, r in sets.items()} == {i: (len(s), 1 if i == 4 else i) for i, s in shingles.items()}
    gone = by_id(substring.digest(df))
    assert {i: (r.n_words, r.n_removed) for i, r in gone.items()} == {1: (420_000, 420_000), 2: (52, 50), 3: (3, 0), 4: (420_000, 420_000)}
    assert gone[2].kept_sha256 == hashlib.sha256(b"before after").hexdigest()


def test_long_text_counts(long_docs):
    texts, df = long_docs
    assert {i: (r.size, r.taken <= 3 * r.size) for i, r in by_id(mixing.digest(df)).items()} == {i: (len(WORD.findall(t)), True) for i, t in texts.items()}
    scored = by_id(scoring.digest(df))
    assert {i: r.n_tokens for i, r in scored.items()} == {i: len(WORD.findall(t)) + 1 for i, t in texts.items()} and all(r.score < 0 for r in scored.values())
    assert {i: r.fingerprint for i, r in by_id(simhash.digest(df)).items()} == {i: f"{plain_fingerprint(t):016x}" for i, t in texts.items()}


def test_long_text_tokens(long_docs):
    from tokenizers import Tokenizer

    texts, df = long_docs
    library = Tokenizer.from_file(tokens.public_path())
    want = {i: len(library.encode(t, add_special_tokens=False).ids) for i, t in texts.items()}
    assert {i: r.n_tokens for i, r in by_id(tokens.digest(df)).items()} == want
    packed = {r.doc_id: r.n for r in packing.digest(df).groupBy("doc_id").agg(F.sum("length").alias("n")).collect()}
    assert packed == {i: n + 1 for i, n in want.items()}


def test_long_text_language(long_docs):
    _, df = long_docs
    assert all(0 <= r.score <= 1 for r in language.digest(df).collect())


TURNS = "conv_id long, turn long, role string, text string, pair_id int, chosen boolean, said string"


@pytest.mark.parametrize("digest", [preference.digest, preference.digest_shared, preference.digest_pairs])
def test_no_conversations(spark, digest):
    assert digest(spark.createDataFrame([], TURNS)).collect() == []


def test_odd_conversations(spark):
    """Null ids and turns take no part, repeated turns count once, one without an answer is its own rejected side, and so is the only one with an answer."""
    rows = [(1, 0, "user", "q"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (2, 0, "user", "lone"), (None, 0, "user", "x"), (3, None, "assistant", "y"), (4, 0, None, None)]
    got = sorted((r.pair_id, r.part, r.turn, r.content) for r in preference.digest_shared(spark.createDataFrame([(*r, 1, True, "s") for r in rows], TURNS)).collect())
    assert got == [(1, "prompt", 0, "<|user|>\nq\n"), (1, "prompt", 1, "<|assistant|>\na\n"), (2, "prompt", 0, "<|user|>\nlone\n"), (4, "prompt", 0, "<||>\n\n")]


def test_stages_on_an_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars int, key string, row int")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, "")
        assert out.collect() == [], name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
