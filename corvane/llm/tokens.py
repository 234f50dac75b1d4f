"""Token counts and ids by a public tokenizer file.

``count_tokens`` counts pieces once per distinct pre-token of the corpus and never builds the ids of a text. A task cuts its
texts into pre-tokens, numbers the distinct ones on pages of at most ``MOST_KNOWN``, and keeps of each document a table of
(number, frequency). The pages' pre-tokens go to the buckets of their hashes, where each distinct one is encoded once, and the
numbers of its pieces are joined back to the pages and summed over the documents' frequencies. Only numbers and distinct
pre-tokens are shuffled, no texts. A tokenizer that does not cut at the byte level's pre-tokens is asked for whole texts.

Defined results: a null text is an empty one and has no tokens; special strings in a text are
what the library makes of them by default; a null id is passed through; repeated rows each
get their row; an empty table gives an empty result; only the named id and text columns are
read, so other columns may have any names.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from functools import cached_property, lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvane.llm import _blocks, _text

#: Distinct pre-tokens on a page.
MOST_KNOWN = 300_000
#: Bytes of text for each bucket of pre-tokens.
BUCKET_BYTES = 64 << 20
PAGE = "to long, page long, data binary"
#: How byte-level tokenizers cut text; fixed by the vocabulary file's format.
BYTE_LEVEL = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Up to U+027F all libraries agree on what is a letter, a digit or white space.
_FAR = re.compile("[^\u0000-ɿ]")


def public_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class _Codes(dict):
    def __missing__(self, key):
        self[key] = n = len(self)
        return n


class PieceCounter:
    """Counts the tokens of texts as the library does, without making their ids."""

    def __init__(self, path: str):
        import regex

        self.path = path
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        added = spec.get("added_tokens") or []
        plain = all(not (a["single_word"] or a["lstrip"] or a["rstrip"] or a["normalized"]) for a in added)
        #: Whether cutting by BYTE_LEVEL between special strings is the same as the library's way.
        self.byte_level = pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and spec.get("normalizer") is None and plain
        self.cut = regex.compile(BYTE_LEVEL).findall
        self.special = re.compile("|".join(re.escape(a["content"]) for a in sorted(added, key=lambda a: -len(a["content"])))) if added else None

    @cached_property
    def tok(self):
        """The library's own tokenizer; it takes some memory and is only loaded where it is asked."""
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        return Tokenizer.from_file(self.path)

    def pre_tokens(self, text: str) -> tuple[list[str], int]:
        """A text's pre-tokens, and how many special strings stand between them."""
        if self.special is not None and self.special.search(text):
            parts = self.special.split(text)
            return [t for part in parts for t in self._cut(part)], len(parts) - 1
        return self._cut(text), 0

    def _cut(self, text: str) -> list[str]:
        if not _FAR.search(text):
            return self.cut(text)
        spans = self.tok.pre_tokenizer.pre_tokenize_str(text)
        return [text[a:b] for _, (a, b) in spans]

    def count(self, texts: list[str]) -> np.ndarray:
        """How many tokens each text has by itself."""
        return np.array([len(e.ids) for e in self.tok.encode_batch(texts, add_special_tokens=False)], np.int64)


def _message(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as out:
        out.write_table(table)
    return _blocks.press(sink.getvalue())


def _table(data: bytes) -> pa.Table:
    return pa.ipc.open_stream(_blocks.unpress(data)).read_all().combine_chunks()


def _rows(to: list[int], page: int, data: list[bytes]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(to, pa.int64()), pa.array([page] * len(to), pa.int64()), pa.array(data, pa.binary())], ["to", "page", "data"])


def _words_of(page: int, codes: dict[str, int], buckets: int) -> pa.RecordBatch:
    """The pre-tokens of a page with their numbers, bucket by bucket."""
    words = list(codes)
    bucket = np.array([zlib.crc32(x.encode()) for x in words], np.int64) % buckets
    order = np.argsort(bucket, kind="stable")
    parts = [x for x in np.split(order, np.flatnonzero(np.diff(bucket[order])) + 1) if len(x)]
    words = pa.array(words, pa.large_string())
    return _rows([int(bucket[x[0]]) for x in parts], page, [_message(pa.table({"word": words.take(pa.array(x)), "code": pa.array(x.astype(np.int32))})) for x in parts])


def _frequencies(part: pa.RecordBatch, counter: PieceCounter, codes: dict[str, int]) -> bytes:
    """Of each document the id, bytes, special strings and the sorted numbers and frequencies of its pre-tokens."""
    texts = ["" if t is None else t for t in part.column("text").to_pylist()]
    code, found, special = codes.__getitem__, [], np.zeros(len(texts), np.int64)
    ends = np.zeros(len(texts) + 1, np.int64)
    for i, text in enumerate(texts):
        pre, special[i] = counter.pre_tokens(text)
        found.extend(map(code, pre))
        ends[i + 1] = len(found)
    key = np.repeat(np.arange(len(texts)) << 32, np.diff(ends)) | np.array(found, np.int64)
    known, n = _blocks.distinct(key)
    _, off = _text.text_bytes(part.column("text"))
    docs = pa.table({"id": part.column("id"), "n_bytes": pa.array(np.diff(off)), "special": pa.array(special), "pre_tokens": pa.array(np.bincount(known >> 32, minlength=len(texts)))})
    # Numbers of a document rise, so their differences are small.
    steps = np.diff(known & 0xFFFFFFFF, prepend=0).astype(np.int32)
    return _message(pa.table({"docs": pa.array([_message(docs)], pa.binary()), "steps": pa.array([steps.tobytes()], pa.binary()), "n": pa.array([_blocks.squeeze(n)], pa.binary())}))


def _encode(part: pa.Table, path: str) -> pa.Table:
    """Of a bucket: every distinct pre-token encoded once, and to each page the numbers of its pieces."""
    if part.column("to")[0].as_py() < 0:
        return pa.Table.from_batches([_rows([], 0, [])])
    pages, tables = part.column("page").to_pylist(), [_table(x) for x in part.column("data").to_pylist()]
    words = pa.chunked_array([t.column("word").combine_chunks() for t in tables]).combine_chunks().dictionary_encode()
    pieces = PieceCounter(path).count(words.dictionary.to_pylist())[words.indices.to_numpy()]
    cut = np.cumsum([0, *(len(t) for t in tables)])
    told = [_message(pa.table({"code": t.column("code"), "pieces": pa.array(pieces[a:b].astype(np.int32))})) for t, a, b in zip(tables, cut[:-1], cut[1:])]
    return pa.Table.from_arrays([pa.array([-1 - p for p in pages], pa.int64()), pa.array(pages, pa.int64()), pa.array(told, pa.binary())], ["to", "page", "data"])


def _sum_up(part: pa.Table, answers: pa.Table) -> pa.Table:
    """A page's documents with their numbers of tokens."""
    pages = [_table(x) for x in part.column("data").to_pylist()] if part.num_rows and part.column("to")[0].as_py() < 0 else []
    told = [_table(x) for x in answers.column("data").to_pylist()] if pages else []
    pieces = np.zeros(1 + max((t.column("code").to_numpy().max(initial=0) for t in told), default=0), np.int64)
    for t in told:
        pieces[t.column("code").to_numpy()] = t.column("pieces").to_numpy()
    out = [pa.table({"id": pa.array([], pa.int64()), "n_bytes": pa.array([], pa.int64()), "n_tokens": pa.array([], pa.int64())})]
    for page in pages:
        docs = _table(page.column("docs")[0].as_py())
        code = np.cumsum(np.frombuffer(page.column("steps")[0].as_py(), np.int32), dtype=np.int64)
        total = np.concatenate([[0], np.cumsum(pieces[code] * _blocks.spread(page.column("n")[0].as_py()))])
        ends = np.concatenate([[0], np.cumsum(docs.column("pre_tokens").to_numpy())])
        out.append(pa.table({"id": docs.column("id"), "n_bytes": docs.column("n_bytes"), "n_tokens": pa.array(np.diff(total[ends]) + docs.column("special").to_numpy())}))
    return pa.concat_tables(out)


def count_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", most_known: int = MOST_KNOWN, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """(id, n_bytes, n_tokens) for each row; pages have about ``most_known`` distinct pre-tokens, and there is a bucket for every ``bucket_bytes`` of text."""
    rows = _blocks.steady(docs).select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def whole(batches):
        counter = PieceCounter(path)
        for batch in batches:
            for part in _text.slices(batch, "text"):
                _, off = _text.text_bytes(part.column("text"))
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(np.diff(off)), pa.array(counter.count(["" if t is None else t for t in part.column("text").to_pylist()]))], ["id", "n_bytes", "n_tokens"])

    if not PieceCounter(path).byte_level:
        return rows.mapInArrow(whole, "id long, n_bytes long, n_tokens long")
    buckets = 1 + (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // bucket_bytes

    def cut(batches):
        counter, codes, page = PieceCounter(path), _Codes(), TaskContext.get().partitionId() << 24
        for batch in batches:
            for part in _text.slices(batch, "text"):
                if len(codes) > most_known:
                    yield _words_of(page, codes, buckets)
                    codes, page = _Codes(), page + 1
                yield _rows([-1 - page], page, [_frequencies(part, counter, codes)])
        if codes:
            yield _words_of(page, codes, buckets)

    # Pages and pre-tokens come from one pass and lie in one shuffle, which both sides read.
    pages = rows.mapInArrow(cut, PAGE).groupBy("to")
    told = pages.applyInArrow(lambda part: _encode(part, path), PAGE)
    return pages.cogroup(told.groupBy("to")).applyInArrow(_sum_up, "id long, n_bytes long, n_tokens long")


def digest(docs: DataFrame, path: str | None = None, limit: int = 512) -> DataFrame:
    counted = count_tokens(docs, path or public_path())
    return counted.select(F.col("id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))


@lru_cache(maxsize=2)
def encoder(path: str):
    """A function from a text to its ids, equal to the library's ``encode(text, add_special_tokens=False)``.

    Where the file is a byte-level vocabulary whose ids follow its merges, a rank table does
    the same work faster; any other file, and texts with characters that the two libraries may class
    differently, go to the library itself.
    """
    counter = PieceCounter(path)

    def slow(text: str) -> list[int]:
        return counter.tok.encode(text, add_special_tokens=False).ids

    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    vocab, merges = spec["model"].get("vocab", {}), [m if isinstance(m, list) else m.split(" ") for m in spec["model"].get("merges", [])]
    if not counter.byte_level or any(vocab.get("".join(m)) != 256 + i for i, m in enumerate(merges)):
        return slow
    import tiktoken

    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(shown))}
    special = {a["content"]: a["id"] for a in spec.get("added_tokens", [])}
    ranks = {bytes(byte_of[c] for c in t): i for t, i in vocab.items() if t not in special}
    fast = tiktoken.Encoding("from_file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens=special)
    return lambda text: slow(text) if _FAR.search(text) else fast.encode(text, allowed_special="all")
