"""Quality rules combined by weak supervision.

Each rule looks at one document and votes good, votes bad or abstains. How often the
rules agree tells how reliable each one is: expectation-maximisation over the table of
vote patterns (one row a pattern, whatever the corpus) estimates each rule's vote
rates under a hidden good/bad class. A document is kept when its posterior probability
of being good reaches the threshold, so no single rule decides alone.

Defined results: a null or empty text has zero words, fails the base rule and is dropped;
a null doc_id is passed through; repeated rows each get their row; an empty table gives
an empty result; columns other than the named id and text are not looked at, so clashing
names do no harm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corvane.llm import _text
from corvane.llm._storage import materialise

FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_upper long, n_letters long, n_far long, top_word long, n_distinct long, n_symbol_words long, n_lines long, n_symbol_lines long"
_SYMBOL = np.zeros(256, np.int64)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = 1
_CHAR = np.ones(256, np.int64)
_CHAR[0x80:0xC0] = 0
_UPPER = np.zeros(256, np.int64)
_UPPER[65:91] = 1
_LETTER = np.zeros(256, np.int64)
_LETTER[65:91] = _LETTER[97:123] = 1
#: Characters beyond ASCII begin with one of these bytes.
_FAR = np.zeros(256, np.int64)
_FAR[0xC0:] = 1


def _per_doc(values: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(values)])[at])


def _lines(buf: np.ndarray, off: np.ndarray) -> _text.Words:
    """The lines with a word, without their line feeds, as spans like words."""
    edge = np.zeros(len(buf) + 1, bool)
    edge[off] = True
    edge[1:][buf == 10] = True
    cut = np.flatnonzero(edge)
    if len(cut) < 2:
        return _text.Words(buf, cut[:0], cut[:0], np.zeros(len(off), np.int64))
    start, end = cut[:-1], cut[1:]
    end = end - (buf[end - 1] == 10)
    has = _per_doc(~_text._SPACE[buf], cut) > 0
    return _text.Words(buf, start[has], end[has], np.searchsorted(start[has], off))


def _dup_lines(lines: _text.Words) -> np.ndarray:
    """Per document, lines that equal an earlier line."""
    h, doc = _text.hash_words(lines, 1), lines.doc
    order = np.lexsort((h, doc))
    same = (doc[order][1:] == doc[order][:-1]) & (h[order][1:] == h[order][:-1])
    return np.bincount(doc[order][1:][same], minlength=len(lines.first) - 1)


def measure(column: pa.Array) -> list[np.ndarray]:
    """The columns of ``FEATURES`` for a chunk of texts."""
    buf, off = _text.text_bytes(column)
    w = _text.split_words(column)
    n, doc = len(off) - 1, w.doc
    h = _text.hash_words(w)
    # words in 3-word windows that occur twice or more in their text
    at = _text.inside(w, 3)
    key = _text.hash_windows(h, 3)[at] if len(at) else np.zeros(0, np.uint64)
    key = _text.mix(key + doc[at].astype(np.uint64) * _text._U(_text._STEP))
    s = np.sort(key)
    twice = np.unique(s[1:][s[1:] == s[:-1]])
    hit = at[np.isin(key, twice, kind="sort")] if len(twice) else at[:0]
    cover = np.zeros(len(doc) + 3, np.int64)
    np.add.at(cover, hit, 1)
    np.add.at(cover, hit + 3, -1)
    repeat = np.bincount(doc[np.cumsum(cover[: len(doc)]) > 0], minlength=n)
    # distinct words, and the most frequent one
    s = np.sort(_text.mix(h + doc.astype(np.uint64) * _text._U(_text._STEP)) >> _text._U(24) | (doc.astype(np.uint64) << _text._U(40)))
    run = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]])) if len(s) else np.zeros(0, np.int64)
    size, owner = np.diff(np.append(run, len(s))), (s[run] >> _text._U(40)).astype(np.int64)
    top = np.zeros(n, np.int64)
    np.maximum.at(top, owner, size)
    within = lambda table, spans: np.diff(np.concatenate([[0], np.cumsum(table[buf])])[np.stack([spans.starts, spans.ends])], axis=0)[0]
    some = lambda table, spans: np.bincount(spans.doc[within(table, spans) > 0], minlength=n)
    word_chars = np.bincount(doc, weights=within(_CHAR, w), minlength=n)
    lines = _lines(buf, off)
    return [w.counts, word_chars, _per_doc(_SYMBOL[buf], off), _dup_lines(lines), repeat, _per_doc(_UPPER[buf], off), _per_doc(_LETTER[buf], off), _per_doc(_FAR[buf], off), top, np.bincount(owner, minlength=n), some(_SYMBOL, w), lines.counts, some(_SYMBOL, lines)]


def features(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: tuple[str, ...] = ()) -> DataFrame:
    """``id`` (long), the carried columns as ``carry_<i>``, and ``FEATURES`` for each row. A text that is carried travels once."""
    names = [x.split()[0] for x in FEATURES.split(", ")]
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), *(F.col(f"`{c}`").alias(f"carry_{i}") for i, c in enumerate(carry) if c != text_col))
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema.fields} | {f"carry_{i}": "string" for i, c in enumerate(carry) if c == text_col}
    out = ["id", *(f"carry_{i}" for i in range(len(carry)))]

    def run(batches):
        for batch in batches:
            for part in _text.slices(batch, "text"):
                mine = [part.column(c if c in part.schema.names else "text") for c in out]
                yield pa.RecordBatch.from_arrays([*mine, *(pa.array(x.astype(np.int64)) for x in measure(part.column("text")))], [*out, *names])

    return rows.mapInArrow(run, f"{', '.join(f'{c} {kinds[c]}' for c in out)}, {FEATURES}")


def rules() -> dict[str, Column]:
    """Votes: 1 good, -1 bad, 0 abstains. The bounds between good and bad are where a rule has nothing to say."""
    c = F.col

    def vote(bad, good) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    return {
        "symbols": vote(c("n_symbols") * 20 > c("n_words"), c("n_symbols") * 100 <= c("n_words")),
        "repeats": vote(c("n_repeat_words") * 10 > c("n_words") * 3, c("n_repeat_words") * 5 <= c("n_words")),
        "lines": vote((c("n_dup_lines") > 2) & (c("n_dup_lines") * 40 > c("n_words")), (c("n_dup_lines") <= 1) | (c("n_dup_lines") * 100 <= c("n_words"))),
        "shouting": vote(c("n_upper") * 10 > c("n_letters") * 3, c("n_upper") * 10 <= c("n_letters")),
        "word_length": vote((c("word_chars") < c("n_words") * 2) | (c("word_chars") > c("n_words") * 14), (c("word_chars") >= c("n_words") * 3) & (c("word_chars") <= c("n_words") * 12)),
        "one_word": vote((c("top_word") * 4 > c("n_words")) & (c("n_words") > 20), c("top_word") * 8 <= c("n_words")),
        "variety": vote(c("n_distinct") * 5 < F.least(c("n_words"), F.lit(2000)), c("n_distinct") * 3 >= F.least(c("n_words"), F.lit(600))),
        "symbol_words": vote(c("n_symbol_words") * 10 > c("n_words"), c("n_symbol_words") * 100 <= c("n_words")),
        "symbol_lines": vote(c("n_symbol_lines") * 3 > c("n_lines"), c("n_symbol_lines") * 10 <= c("n_lines")),
        "letters": vote((c("n_letters") + c("n_far")) * 4 < c("word_chars") * 3, (c("n_letters") + c("n_far")) * 20 >= c("word_chars") * 17),
    }


def fit(patterns: list[tuple[tuple[int, ...], int]], rounds: int = 100) -> tuple[np.ndarray, np.ndarray]:
    """EM over vote patterns and their counts: shares of the classes good and bad, and vote rates [class, rule, vote -1, 0, 1].

    The start says which class is which: a document is bad by half for each bad vote that it has. From there on
    only agreement counts: a rule that calls many documents bad with which the others find nothing wrong
    ends with a high rate of bad votes on good documents, and so with little weight. One pseudo-count a vote keeps rates of rules that never vote defined.
    """
    votes = np.array([p for p, _ in patterns], int).reshape(len(patterns), -1)
    count = np.array([n for _, n in patterns], float)
    onehot = np.eye(3)[votes + 1]
    bad = np.clip((votes == -1).sum(1) / 2, 0.01, 0.99)
    q = np.column_stack([1 - bad, bad])
    for _ in range(rounds):
        share = (count @ q + 1) / (count.sum() + 2)
        rates = np.einsum("p,pk,prv->krv", count, q, onehot) + 1
        rates /= rates.sum(2, keepdims=True)
        score = np.log(share) + np.einsum("prv,krv->pk", onehot, np.log(rates))
        q = np.exp(score - score.max(1, keepdims=True))
        q /= q.sum(1, keepdims=True)
    return share, rates


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_good: float = 0.5, carry: tuple[str, ...] = ()) -> DataFrame:
    """``features`` with each rule's vote, ``p_good`` (the posterior), ``base_failed`` and ``kept``.

    Without carried columns texts are measured once and the measures written; with them, once more for the verdict, so that texts are neither written nor shuffled.
    """
    narrow = materialise(features(docs, id_col, text_col))
    measured = features(docs, id_col, text_col, carry) if carry else narrow
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    names = [f"vote_{k}" for k in rules()]
    ballots = {f"vote_{k}": v for k, v in rules().items()}
    # Patterns of votes come to the driver, at most 3 ** 10 and in practice some hundreds, from documents of any number.
    patterns = [(tuple(r[:-1]), r[-1]) for r in narrow.withColumns(ballots).groupBy(*names).count().collect()]
    voted = measured.withColumn("base_failed", base).withColumns(ballots)
    share, rates = fit(patterns or [((0,) * len(names), 1)])
    weight = []
    for k, part in enumerate(share):
        log_p = F.lit(float(np.log(part)))
        for r, name in enumerate(names):
            x = np.log(rates[k, r]).tolist()
            log_p = log_p + F.when(F.col(name) == -1, x[0]).when(F.col(name) == 1, x[2]).otherwise(x[1])
        weight.append(F.exp(log_p))
    p = weight[0] / sum(weight[1:], weight[0])
    return voted.withColumn("p_good", p).withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= least_good))


def digest(docs: DataFrame) -> DataFrame:
    r = judge(docs)
    return r.select(F.col("id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "p_good")
