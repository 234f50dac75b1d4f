"""Language-model scores by a weighted backoff automaton over words, of order three.

States are the root, each word of the training texts and the start of a text, and each pair of words that
follow each other ``least`` times or more in training. An arc reads a word that followed the state in training; where there is none,
a failure arc leads to the state of the shorter context, in the end to the root, whose arcs read any word. With
c the counts in training, N the tokens and V the distinct ones, arcs weigh

    root      p(w) = (c(w) + 1) / (N + V + 1)
    word v    p(w | v) = (c(vw) + a p(w)) / (c(v) + a),         failure arc  a / (c(v) + a)
    pair uv   p(w | uv) = (c(uvw) + b p(w | v)) / (c(uv) + b),  failure arc  b / (c(uv) + b)

so each state's weights add up to one, whatever comes. ``a`` and ``b`` are estimated from the training texts: as
Turing has it, the tokens that go on as never before are as many as pairs (triples) that were seen once, so ``a`` is where the
failure arcs take just that many of the training tokens, the sum over states of c a / (c + a). A text is read once from left to right;
each token takes its arc, after as many failure arcs as it needs, adds the log weights and moves on to the
state that the arc leads to.

The automaton is nowhere held as a whole. Documents lie in blocks; each block asks for the counts of just the
words and pairs that its texts contain, then for those of the triples whose pair is a state, is answered bucket by
bucket, and builds the part of the automaton that its texts run through. All its texts are read side by side, one token each at a time.

Defined results: a null or empty text has one token, the end; a document with a null id counts
as one with an empty id; repeated rows are counted and scored each; with no training text all counts are 0 and N = V = 0;
an empty table gives an empty result; only the named id and text columns are read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import _blocks, _text
from corvane.llm._storage import materialise

BLOCK_BYTES = 6 << 20
_END, _START = np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)
_ONE = np.uint64(1)
#: What a block is told: totals in the order of its keys. Block -1 stands for rows that sum the bucket up, ``n`` counts that add up to ``total``.
ANSWER = "block long, bucket long, totals binary, n long, total long"
PAIRS, TRIPLES = 0, 1
#: Counts of words, of pairs that are states, and of pairs or triples that were seen once.
WORDS, STATES, ONCE = range(3)
#: Counts are told apart up to this one, and in classes of a hundredth beyond.
EXACT = 4096
#: Bounds of ``a`` and ``b``.
LEAST_A, MOST_A = 1e-3, 1e7


def held_out(id_col: str, modulus: int, remainder: int):
    return F.pmod(F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))), F.lit(modulus)) == remainder


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _text.mix(a * np.uint64(_text._R_WORD) + (b ^ np.uint64(_text._STEP)))


class Tokens:
    """All tokens of a block: distinct words and pairs, sorted, and each token's place among them."""

    def __init__(self, part: pa.Table):
        hashes, lengths, self.ids, self.out = [], [], [], []
        for rows in _blocks.chunks(part):
            w = _text.split_words(rows.column("text"), lower=True)
            hashes.append(np.insert(_text.hash_words(w), w.first[1:], _END))
            lengths.append(w.counts + 1)
            self.ids.append(rows.column("id"))
            self.out.append(rows.column("carry_0"))
        self.length, h = np.concatenate(lengths), np.concatenate(hashes)
        del hashes
        #: each document's first token
        self.first = np.cumsum(self.length) - self.length
        before = np.empty_like(h)
        before[1:] = h[:-1]
        before[self.first] = _START
        pairs = _join(before, h)
        self.triples = np.empty_like(h)
        self.triples[1:] = _join(pairs[:-1], h[1:] + _ONE)
        self.begins = np.zeros(len(h), bool)
        self.begins[self.first] = True
        # The last bit tells words from pairs, so both lie in one sorted array.
        self.words, self.word, _ = _blocks.group(h & ~_ONE)
        self.pairs, self.pair, _ = _blocks.group(pairs | _ONE)
        self.end = int(np.searchsorted(self.words, _END & ~_ONE))

    @property
    def trained(self) -> np.ndarray:
        """1 for tokens of training texts, else 0."""
        out = np.concatenate([x.to_numpy(zero_copy_only=False).astype(bool) for x in self.out])
        return np.repeat(~out, self.length).astype(np.int64)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Words and pairs, sorted together, and their order."""
        both = np.concatenate([self.words, self.pairs])
        order = np.argsort(both)
        return both[order], order

    def told(self, answers: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        """Totals of the words and of the pairs."""
        both = np.empty(len(self.words) + len(self.pairs), np.int64)
        both[self.keys()[1]] = _blocks.totals_of(answers)
        return both[: len(self.words)], both[len(self.words) :]

    def open_triples(self, of_pair: np.ndarray, least: int) -> np.ndarray:
        """Tokens whose two predecessors are a state."""
        at = np.flatnonzero(~self.begins)
        return at[of_pair[self.pair[at - 1]] >= least]


def _sum(place: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    return np.bincount(place, weights=weight, minlength=n).astype(np.int64)


def _classes(counts: np.ndarray) -> np.ndarray:
    """A number for each count, the same for counts within a hundredth."""
    return np.where(counts <= EXACT, counts, EXACT + (64 * np.log2(np.maximum(counts, EXACT) / EXACT)).astype(np.int64))


def _answer(part: pa.Table, triples: bool, least: int) -> pa.Table:
    """To each block the totals of what it asked; and how often each count occurs in the bucket."""
    blocks, sizes, known, totals, place = _blocks.add_up(part)
    value, cut, bucket = totals[place], np.cumsum([0, *sizes]), part.column("bucket")[0].as_py()
    told = [(b, bucket, _blocks.squeeze(value[x:y]), None, None) for b, x, y in zip(blocks, cut[:-1], cut[1:])]
    words = (known & _ONE) == 0
    summed = {ONCE: totals[~words & (totals == 1)]}
    if not triples:
        summed |= {WORDS: totals[words & (totals > 0)], STATES: totals[~words & (totals >= least)]}
    for kind, counts in summed.items():
        of = _classes(counts)
        many, total = np.bincount(of), np.bincount(of, weights=counts)
        told += [(-1, int(kind << 32 | c), None, int(many[c]), int(total[c])) for c in np.flatnonzero(many).tolist()]
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    return pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*told), kinds)], ["block", "bucket", "totals", "n", "total"])


def _summed(answers: DataFrame) -> dict[int, list[tuple[int, int]]]:
    """By kind, how many counts there are and their sum, for each class of counts: some thousand rows, whatever the corpus."""
    found: dict[int, list[tuple[int, int]]] = {WORDS: [], STATES: [], ONCE: []}
    for r in answers.filter("block < 0").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        found[r["bucket"] >> 32].append((r["n"], r["total"]))
    return found


def estimate(contexts: list[tuple[int, int]], once: int) -> float:
    """Where the failure arcs of contexts, so many with counts that add up to so much, take ``once`` tokens; within ``LEAST_A`` and ``MOST_A``."""
    n, total = (np.array(x, float) for x in zip(*contexts)) if contexts else (np.zeros(0), np.zeros(0))
    low, high = math.log(LEAST_A), math.log(MOST_A)
    for _ in range(60):
        a = math.exp((low + high) / 2)
        low, high = ((low + high) / 2, high) if (total * a / (total / n + a)).sum() < once else (low, (low + high) / 2)
    return math.exp((low + high) / 2)


class Automaton:
    """States 0 (root), 1 ... (words, then the start of a text) and ``pair0`` ... (pairs); arcs are kept by the words that they read."""

    def __init__(self, t: Tokens, words: np.ndarray, pairs: np.ndarray, triple: np.ndarray, triples: np.ndarray, n: int, v: int, least: int, a: float, b: float):
        """``words``, ``pairs``, ``triples``: counts; ``triple``: each token's triple, -1 for none."""
        n_words = len(words)
        self.start, self.pair0 = n_words + 1, n_words + 2
        # A start is left as often as an end is read.
        count = np.concatenate([[0], words, [words[t.end]], pairs]).astype(float)
        prior = np.where(np.arange(len(count)) < self.pair0, a, b)
        self.back = np.log10(prior / (count + prior))
        last = np.zeros(len(pairs), np.int64)
        last[t.pair] = t.word
        left = np.zeros(len(pairs), np.int64)  # the word, or start, that a pair begins with
        left[t.pair[1:]] = t.word[:-1] + 1
        left[t.pair[t.begins]] = self.start
        word_state = np.where(words > 0, np.arange(1, n_words + 1), 0)
        self.fail = np.concatenate([np.zeros(n_words + 2, np.int64), word_state[last]])
        p1 = (words + 1.0) / (n + v + 1.0)
        c = count[left]
        p2 = np.where(c > 0, (pairs + a * p1[last]) / (c + a), p1[last])
        self.reads1, self.reads2 = np.log10(p1), np.log10(p2)
        self.to_word, self.to_pair = word_state, np.where(pairs >= least, self.pair0 + np.arange(len(pairs)), word_state[last])
        of = np.zeros(len(triples), np.int64)
        under = np.zeros(len(triples), np.int64)
        at = np.flatnonzero(triple >= 0)
        of[triple[at]], under[triple[at]] = t.pair[at - 1], t.pair[at]
        self.reads3 = np.log10((triples + b * p2[under]) / (pairs[of] + b)) if len(triples) else np.zeros(0)
        self.known1, self.known2, self.known3 = words > 0, pairs > 0, triples > 0

    def read(self, t: Tokens, triple: np.ndarray) -> np.ndarray:
        """Each document's log10 probability."""
        # Documents by falling length; token i of all that have one lie side by side.
        by = np.argsort(-t.length, kind="stable")
        length = t.length[by]
        alive = len(length) - np.searchsorted(length[::-1], np.arange(int(length[0]) if len(length) else 0), side="right")
        state, total = np.full(len(by), self.start), np.zeros(len(by))
        first = t.first[by]
        none = np.zeros(1, bool)
        known3, reads3 = np.concatenate([self.known3, none]), np.concatenate([self.reads3, np.zeros(1)])
        for i, many in enumerate(alive.tolist()):
            at = first[:many] + i
            word, pair, three, s = t.word[at], t.pair[at], triple[at], state[:many]
            on_pair = s >= self.pair0
            by3 = on_pair & known3[three]
            down = on_pair & ~by3
            gain = np.where(by3, reads3[three], np.where(down, self.back[s], 0.0))
            s = np.where(down, self.fail[s], s)
            on_word = ~by3 & (s > 0)
            by2 = on_word & self.known2[pair]
            gain += np.where(by2, self.reads2[pair], np.where(on_word, self.back[s], 0.0))
            root = ~by3 & ~by2
            total[:many] += gain + np.where(root, self.reads1[word], 0.0)
            state[:many] = np.where(root, self.to_word[word], self.to_pair[pair])
        out = np.empty(len(by))
        out[by] = total
        return out


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", modulus: int = 7, remainder: int = 2, smoothing: tuple[float, float] | None = None, least: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row, learning from all that are not held out; ``smoothing`` is estimated where it is not given."""
    marked = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"), held_out(f"`{id_col}`", modulus, remainder).alias("held_out"))
    blocked, buckets, _ = _blocks.deal(marked, "id", "text", ("held_out",), block_bytes)
    by_block = blocked.groupBy("block")

    def ask_pairs(part: pa.Table) -> pa.Table:
        t = Tokens(part)
        weight = t.trained
        counts = np.concatenate([_sum(t.word, weight, len(t.words)), _sum(t.pair, weight, len(t.pairs))])
        keys, order = t.keys()
        return _blocks.send(part.column("block")[0].as_py(), keys, counts[order], buckets)

    def ask_triples(part: pa.Table, told: pa.Table) -> pa.Table:
        t = Tokens(part)
        at = t.open_triples(t.told(told)[1], least)
        keys, place, _ = _blocks.group(t.triples[at] | _ONE)
        return _blocks.send(part.column("block")[0].as_py(), keys, _sum(place, t.trained[at], len(keys)), buckets)

    def walk(part: pa.Table, told: pa.Table) -> pa.Table:
        t = Tokens(part)
        of = lambda kind: told.filter(pc.equal(told.column("kind"), kind))
        words, pairs = t.told(of(PAIRS))
        at = t.open_triples(pairs, least)
        keys, place, _ = _blocks.group(t.triples[at] | _ONE)
        triple = np.full(len(t.word), -1)
        triple[at] = place
        machine = Automaton(t, words, pairs, triple, _blocks.totals_of(of(TRIPLES)), n, v, least, a, b)
        add = lambda x: np.add.reduceat(x, t.first) if len(t.first) else x
        columns = [pa.concat_arrays(t.ids), pa.concat_arrays(t.out), pa.array(t.length), pa.array(add(machine.known1[t.word].astype(np.int64))), pa.array(np.full(len(t.length), n)), pa.array(add(machine.reads1[t.word])), pa.array(machine.read(t, triple))]
        return pa.Table.from_arrays(columns, ["id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    # Written, as both what they sum up and what they tell is read; what was shuffled for them goes, or three steps' files would lie side by side.
    pairs = materialise(by_block.applyInArrow(ask_pairs, _blocks.SENT).groupBy("bucket").applyInArrow(lambda part: _answer(part, False, least), ANSWER), drop_shuffles=True)
    to_blocks = pairs.filter("block >= 0").select("block", "bucket", "totals")
    triples = by_block.cogroup(to_blocks.groupBy("block")).applyInArrow(ask_triples, _blocks.SENT).groupBy("bucket").applyInArrow(lambda part: _answer(part, True, least), ANSWER)
    triples = materialise(triples, drop_shuffles=True)
    twos, threes = _summed(pairs), _summed(triples)
    n, v = sum(x for _, x in twos[WORDS]), sum(x for x, _ in twos[WORDS])
    a, b = smoothing or (estimate(twos[WORDS], sum(x for x, _ in twos[ONCE])), estimate(twos[STATES], sum(x for x, _ in threes[ONCE])))
    told = to_blocks.withColumn("kind", F.lit(PAIRS)).unionAll(triples.filter("block >= 0").select("block", "bucket", "totals").withColumn("kind", F.lit(TRIPLES)))
    return by_block.cogroup(told.groupBy("block")).applyInArrow(walk, "id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def digest(docs: DataFrame) -> DataFrame:
    return score(docs).select(F.col("id").alias("doc_id"), "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")
