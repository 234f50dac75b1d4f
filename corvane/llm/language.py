"""Language identification by unigram pieces with all segmentations summed.

The pieces are all those of a fixed public vocabulary; every single byte is one, so any text can be cut into pieces. Each
language has its own piece probabilities, estimated by expectation-maximisation over the words of a bounded sample of labelled
documents. The probability of a word is the sum over all its segmentations, by the forward
algorithm, whatever its length; a text's is the product over its words. A task scores each distinct word once.

The sample: about ``per_language`` documents of each language, chosen by a hash of id and text; of these, words of over ``TAUGHT_BYTES``
bytes, such as whole sentences of languages without spaces, are taught in parts of that length, and all parts count.
Everything else covers whole texts of all documents.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every
text if no label is known; ties go to the first language in code point order; rows are
judged one by one, so repeated rows agree; an empty table gives an empty result; only the named
columns are read.
"""

from __future__ import annotations

import base64

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import _text

#: Bytes of the parts in which long words are taught.
TAUGHT_BYTES = 32
#: Words longer than this go through the forward algorithm one by one, with all pieces that end at a byte at once.
LONG_BYTES = 24
#: Doubles in the probabilities of distinct words that a task remembers, and in the arrays of a step.
MOST_KNOWN, MOST_AT_ONCE = 4_000_000, 2_000_000
_R = np.uint64(0x9E3779B97F4A7C15)


class Pieces:
    """A vocabulary: sorted hashes of the pieces, and the lengths in bytes that pieces have."""

    def __init__(self, pieces: set[bytes]):
        pieces = {x for x in pieces if x} | {bytes([b]) for b in range(256)}
        self.known = np.unique(np.array([_piece_hash(x) for x in pieces], np.uint64))
        self.sizes = sorted({len(x) for x in pieces})

    @classmethod
    def of_file(cls, path: str) -> Pieces:
        """Those of a rank file of base64 lines."""
        with open(path, "rb") as f:
            return cls({base64.b64decode(line.split()[0]) for line in f if line.strip()})


def _piece_hash(piece: bytes) -> int:
    x = 0
    for b in piece:
        x = (x * int(_R) + b + 1) % 2**64
    return x


class Lattice:
    """All pieces of equally long words: ``ids[size][:, i]`` is the piece of ``size`` bytes at ``i``, or -1."""

    def __init__(self, words: np.ndarray, pieces: Pieces):
        n, known = words.shape[1], pieces.known
        self.rows, self.n, self.ids = len(words), n, {}
        h = np.zeros(words.shape, np.uint64)
        for size in range(1, min(n, pieces.sizes[-1]) + 1):
            h = h[:, : n - size + 1] * _R + words[:, size - 1 :].astype(np.uint64) + np.uint64(1)
            if size in pieces.sizes:
                at = np.minimum(np.searchsorted(known, h), len(known) - 1)
                ids = np.where(known[at] == h, at, -1).astype(np.int32)
                if (ids >= 0).any():
                    self.ids[size] = ids

    def sums(self, p: np.ndarray) -> list[np.ndarray]:
        """p: [piece + one zero row at the end, language]. Sums over segmentations of each prefix, for words of at most ``LONG_BYTES``."""
        alpha = [np.ones((self.rows, p.shape[1]))]
        for end in range(1, self.n + 1):
            alpha.append(sum(alpha[end - size] * p[ids[:, end - size]] for size, ids in self.ids.items() if size <= end))
        return alpha

    def forward(self, p: np.ndarray) -> np.ndarray:
        """[word, language]: log sums over segmentations of whole words."""
        if self.n <= LONG_BYTES:
            return np.log(self.sums(p)[-1])
        return np.stack([self._one(row, p) for row in range(self.rows)])

    def _one(self, row: int, p: np.ndarray) -> np.ndarray:
        sizes, most = np.array(sorted(self.ids)), max(self.ids)
        alpha, scale = np.zeros((self.n + most + 1, p.shape[1])), np.zeros(p.shape[1])
        alpha[most] = 1  # place ``most + i`` is the prefix of i bytes
        step = max(1, MOST_AT_ONCE // (len(sizes) * p.shape[1]))
        for low in range(1, self.n + 1, step):
            ends = np.arange(low, min(self.n + 1, low + step))
            start = ends[:, None] - sizes
            ids = np.stack([self.ids[s][row][np.maximum(start[:, i], 0)] for i, s in enumerate(sizes.tolist())], 1)
            chance = np.where((start >= 0)[:, :, None], p[ids], 0.0)
            for i, end in enumerate(ends.tolist()):
                x = alpha[most + end] = (alpha[most + end - sizes] * chance[i]).sum(0)
                if end % 8 == 0:
                    alpha[end : most + end + 1] /= x
                    scale += np.log(x)
        return np.log(alpha[most + self.n]) + scale


def _groups(w: _text.Words, pick: np.ndarray, languages: int):
    """Words ``pick`` by length in bytes, each with a space before it: (places in pick, byte matrix)."""
    size = w.ends[pick] - w.starts[pick]
    order = np.argsort(size, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(size[order])) + 1):
        if len(part):
            n = int(size[part[0]])
            step = max(1, MOST_AT_ONCE // (n * (12 + languages)))
            for a in range(0, len(part), step):
                some = part[a : a + step]
                body = np.empty((len(some), n + 1), np.uint8)
                body[:, 0] = 32
                body[:, 1:] = w.buf[w.starts[pick[some]][:, None] + np.arange(n)]
                yield some, body


def _parts(word: bytes) -> list[bytes]:
    """A word with a space before it, cut between characters into parts of at most ``TAUGHT_BYTES`` bytes."""
    out, at, word = [], 0, b" " + word
    while at < len(word):
        to = min(len(word), at + TAUGHT_BYTES)
        while at + 4 < to < len(word) and 0x80 <= word[to] < 0xC0:
            to -= 1
        out.append(word[at:to])
        at = to
    return out


def fit(words: list[bytes], counts: np.ndarray, pieces: Pieces, rounds: int = 3) -> np.ndarray:
    """Piece probabilities by EM over distinct words with their counts."""
    known = pieces.known
    p = np.ones(len(known) + 1)
    p[-1] = 0
    taught: dict[bytes, float] = {}
    for word, n in zip(words, counts.tolist()):
        for part in _parts(word):
            taught[part] = taught.get(part, 0.0) + n
    by: dict[int, list[bytes]] = {}
    for part in taught:
        by.setdefault(len(part), []).append(part)
    parts = [(Lattice(np.frombuffer(b"".join(same), np.uint8).reshape(-1, n), pieces), np.array([taught[x] for x in same])) for n, same in by.items()]
    for step in range(rounds + 1):
        found = np.zeros(len(known) + 1)
        for lattice, count in parts:
            if step == 0:  # pieces as often as they stand anywhere
                for ids in lattice.ids.values():
                    found += np.bincount(ids.ravel() % len(p), weights=np.repeat(count, ids.shape[1]), minlength=len(p))
                continue
            alpha = [x[:, 0] for x in lattice.sums(p[:, None])]
            beta = [np.ones(len(count))]
            for start in range(lattice.n - 1, -1, -1):
                beta.append(sum(beta[lattice.n - start - size] * p[ids[:, start]] for size, ids in lattice.ids.items() if size <= lattice.n - start))
            for size, ids in lattice.ids.items():
                for start in range(lattice.n - size + 1):
                    share = alpha[start] * p[ids[:, start]] * beta[lattice.n - start - size] / alpha[-1]
                    found += np.bincount(ids[:, start] % len(p), weights=share * count, minlength=len(p))
        found[-1] = 0
        p = (found + 1e-4) / (found.sum() + 1e-4 * len(known))
        p[-1] = 0
    return p


class Scorer:
    """Log probabilities of words by language, each distinct word worked out once."""

    def __init__(self, pieces: Pieces, p: np.ndarray):
        self.pieces, self.p = pieces, p
        self.seen, self.value = np.zeros(0, np.uint64), np.zeros((0, p.shape[1]))

    def texts(self, column) -> np.ndarray:
        """[text, language]"""
        w, languages = _text.split_words(column, lower=True), self.p.shape[1]
        h = _text.hash_words(w)
        distinct, first, at = np.unique(h, return_index=True, return_inverse=True)
        place = np.minimum(np.searchsorted(self.seen, distinct), max(0, len(self.seen) - 1))
        old = self.seen[place] == distinct if len(self.seen) else np.zeros(len(distinct), bool)
        value = np.empty((len(distinct), languages))
        value[old] = self.value[place[old]]
        fresh = np.flatnonzero(~old)
        for some, body in _groups(w, first[fresh], languages):
            value[fresh[some]] = Lattice(body, self.pieces).forward(self.p)
        if (len(self.seen) + len(fresh)) * languages > MOST_KNOWN:
            self.seen, self.value = distinct, value
        else:
            seen, value_ = np.concatenate([self.seen, distinct[fresh]]), np.concatenate([self.value, value[fresh]])
            order = np.argsort(seen)
            self.seen, self.value = seen[order], value_[order]
        out = np.zeros((len(w.first) - 1, languages))
        for i in range(languages):
            total = np.zeros(len(h) + 1)
            np.cumsum(value[at, i], out=total[1:])
            out[:, i] = total[w.first[1:]] - total[w.first[:-1]]
        return out


def learn(docs: DataFrame, per_language: int, pieces: Pieces) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Languages, log priors and [piece + 1, language] from (id, text, lang) rows."""
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r[0]: r[1] for r in labelled.groupBy("lang").count().collect()}
    if not sizes:
        return [], np.zeros(0), np.zeros((len(pieces.known) + 1, 0))
    share = F.create_map(*(F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, per_language / n))))
    unit = F.pmod(F.xxhash64(F.lit(5), "id", "text"), F.lit(1 << 20)) / float(1 << 20)
    sample = labelled.filter(unit < share[F.col("lang")]).select("lang", "text")

    def split(batches):
        for batch in batches:
            for part in _text.slices(batch, "text"):
                w = _text.split_words(part.column("text"), lower=True)
                size = w.ends - w.starts
                body = np.zeros(len(w.buf) + 1, bool)
                np.logical_not(_text._SPACE[w.buf], out=body[:-1])
                words = pa.BinaryArray.from_buffers(pa.binary(), len(size), [None, pa.py_buffer(np.concatenate([[0], np.cumsum(size)]).astype(np.int32)), pa.py_buffer(w.buf[body[:-1]])])
                lang = pa.array(np.repeat(np.array(part.column("lang").to_pylist(), object), w.counts), pa.string())
                yield from pa.table({"lang": lang, "word": words}).group_by(["lang", "word"]).aggregate([([], "count_all")]).rename_columns(["lang", "word", "n"]).to_batches()

    counts = sample.mapInArrow(split, "lang string, word binary, n long").groupBy("lang", "word").agg(F.sum("n").alias("n")).toArrow()
    names, columns = sorted(sizes), []
    lang, word, n = counts.column("lang").to_numpy(), counts.column("word").to_pylist(), counts.column("n").to_numpy()
    for name in names:
        at = np.flatnonzero(lang == name)
        columns.append(fit([word[i] for i in at], n[at], pieces))
    p = np.stack(columns, 1)
    p = 0.98 * p + 0.02 * p.mean(1, keepdims=True)
    prior = np.array([sizes[x] for x in names], float) + 1
    return names, np.log(prior / prior.sum()), p


def identify(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", modulus: int = 4, remainder: int = 2, per_language: int = 600) -> DataFrame:
    """(id, held_out, lang_pred, score) for each row, learning from labelled rows that are not held out."""
    pieces = Pieces.of_file(path)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"), F.col(f"`{lang_col}`").cast("string").alias("lang"))
    out = F.pmod(F.crc32(F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(modulus)) == remainder
    rows = rows.withColumn("held_out", out).withColumn("letters", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))
    names, prior, p = learn(rows.filter("not held_out"), per_language, pieces)

    def judge(batches):
        scorer = Scorer(pieces, p)
        for batch in batches:
            for part in _text.slices(batch, "text", 2 << 20):
                n = part.num_rows
                pred, score = np.full(n, "und", object), np.zeros(n)
                if names:
                    x = scorer.texts(part.column("text")) + prior
                    q = np.exp(x - x.max(1, keepdims=True))
                    letters = part.column("letters").to_numpy(zero_copy_only=False).astype(bool)
                    pred[letters] = np.array(names, object)[x.argmax(1)][letters]
                    score[letters] = (q.max(1) / q.sum(1))[letters]
                yield pa.RecordBatch.from_arrays([part.column("id"), part.column("held_out"), pa.array(pred, pa.string()), pa.array(score)], ["id", "held_out", "lang_pred", "score"])

    return rows.select("id", "text", "held_out", "letters").mapInArrow(judge, "id long, held_out boolean, lang_pred string, score double")


def digest(docs: DataFrame, path: str | None = None) -> DataFrame:
    from corvane.llm.tokens import public_path

    return identify(docs, path or public_path("byte_bpe_multi_50k.tiktoken")).withColumnRenamed("id", "doc_id")
