"""Packing documents into windows of at most 4,096 tokens: bounded-space online
best fit.

A task keeps ``open_windows`` windows. A document's ids (and a closing id) are
cut into full windows as long as they last; what remains goes into the open
window that it fills best. Where none fits and all are open, the fullest one is
filled up with the head of the piece and emitted, and the tail opens the next.
At its end a task merges its open windows into full ones and at most one
leftover; leftovers of ``MERGE`` tasks at a time are merged once more. So all
but one window in ``MERGE`` tasks are full, and each task holds a fixed number
of windows.

Tokenizing: a text of letters of the Latin ranges, digits and ASCII signs has
no token across white space, so its words' ids are kept in a bounded cache;
any other text goes to the tokenizer whole. Both give the tokenizer's ids.

Sequence ids come from the number of the task and its counter, so reruns over
the same files agree.

Defined cases: null text is empty and gives the closing id alone; rows that
repeat a doc_id are packed as documents of their own; an empty table gives an
empty result; a null doc_id stays null; extra columns are ignored; texts of any
length are packed whole.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.llm.common import cut_lineage, releasing, strings

WINDOW, OPEN, MERGE, CLOSING = 4096, 16, 64, 2
TOKENIZER = "word_bpe_49k.json"
CACHE_BYTES = 140 << 20     # of each of a worker's two caches, about
ENTRY_BYTES = 200           # of a dictionary entry with its key and value, about

_OTHER = re.compile("[^\t\n\r -~À-ÖØ-öø-įı-ňŊ-ž]|<\\|")


class _Cache(dict):
    """Text -> its ids as bytes of 16-bit numbers. What has been asked for since
    half of ``limit`` bytes came in is kept, and what was asked for in the half
    before is at hand, so its memory is bounded and frequent words stay."""

    def __init__(self, encode, limit: int):
        super().__init__()
        self.encode, self.limit, self.used, self.before = encode, limit, 0, {}

    def __missing__(self, text: str) -> bytes:
        ids = self.before.get(text)
        if ids is None:
            ids = self.encode(text)
        if self.used > self.limit // 2:
            self.before = self.copy()
            self.clear()
            self.used = 0
        self[text] = ids
        self.used += ENTRY_BYTES + len(text) + len(ids)
        return ids


def _packed(ids: list[int]) -> bytes:
    return array("H", ids).tobytes()


class Encoder:
    """``ids(text)`` of a tokenizers file, as an array.

    A single word can skip the alignment that the tokenizer keeps for its
    normalizers, most of its time: the word is lower-cased, split by the
    tokenizer's own pre-tokenizer pattern and given to its model. That, and the
    cache, are used only if a probe shows the same ids."""

    def __init__(self, path: str, cache_bytes: int = CACHE_BYTES):
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = t = Tokenizer.from_file(path)
        mapped = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        self.bytes = {c: mapped.pre_tokenize_str(chr(c))[0][0] for c in range(0xA1, 0x180)}
        self.pieces = _Cache(lambda p, tokenize=t.model.tokenize: _packed([x.id for x in tokenize(p)]), cache_bytes)
        self.pattern = _split_pattern(t)
        small = t.get_vocab_size() <= 65536
        self.by_word = small and all(self._whole(p) == [i for w in p.split() for i in self._whole(w)] for p in PROBES)
        quick = self.pattern is not None and all(
            _packed(self._whole(w)) == self._quick(w) for p in PROBES for w in p.split())
        self.words = _Cache(self._quick if quick else lambda w: _packed(self._whole(w)), cache_bytes)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _quick(self, word: str) -> bytes:
        word = word.lower()
        if word.isalpha():
            return self.pieces[word if word.isascii() else word.translate(self.bytes)]
        return b"".join([self.pieces[p.translate(self.bytes)] for p in self.pattern.findall(word)])

    def ids(self, text: str) -> np.ndarray:
        if self.by_word and not _OTHER.search(text):
            return np.frombuffer(b"".join([self.words[w] for w in text.split()]), np.uint16)
        return np.array(self._whole(text), np.uint32)


PROBES = ("a b", "a  b", "ab\ncd", "x, y. z'll 12 3a", " a ", "Dieüauß Èonai, öäte. ÀÉ-ñ it's <b>&amp;</b> (9.5%) Łódź \\o/ A1b2",
          "unbelievably Wordsworthian zzxxqq __init__ a'b 'tis O'Neill'd")


def _split_pattern(tokenizer):
    """The pre-tokenizer's split pattern, if splitting and byte mapping are
    all that it does."""
    import json

    import regex
    steps = (json.loads(tokenizer.to_str()).get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
    pattern = (steps[0].get("pattern") or {}).get("Regex")
    return regex.compile(pattern) if pattern and [x.get("type") for x in steps] == ["Split", "ByteLevel"] else None


_ENCODERS: dict[tuple[str, int], Encoder] = {}


def encoder(path: str, cache_bytes: int = CACHE_BYTES) -> Encoder:
    """One per Python worker, file and size of the caches."""
    if (path, cache_bytes) not in _ENCODERS:
        _ENCODERS[path, cache_bytes] = Encoder(path, cache_bytes)
    return _ENCODERS[path, cache_bytes]


class Packer:
    """Pieces are (doc_id, start, ids, doc_tokens)."""

    def __init__(self, window: int, slots: int, emit):
        self.window, self.slots, self.emit = window, slots, emit
        self.open: list[list] = []      # [used, pieces]

    def add(self, doc, ids: np.ndarray, start: int, total: int) -> None:
        while len(ids) >= self.window:
            self.emit([(doc, start, ids[:self.window], total)])
            ids, start = ids[self.window:], start + self.window
        if not len(ids):
            return
        free = [self.window - w[0] for w in self.open]
        fitting = [(f, k) for k, f in enumerate(free) if f >= len(ids)]
        if fitting:
            k = min(fitting)[1]
        elif len(self.open) < self.slots:
            self.open.append([0, []])
            k = len(self.open) - 1
        else:
            k = min(range(len(free)), key=free.__getitem__)
            head = free[k]
            fullest = self.open.pop(k)
            self.emit(fullest[1] + [(doc, start, ids[:head], total)])
            ids, start = ids[head:], start + head
            self.open.append([0, []])
            k = len(self.open) - 1
        w = self.open[k]
        w[0] += len(ids)
        w[1].append((doc, start, ids, total))
        if w[0] == self.window:
            self.emit(self.open.pop(k)[1])

    def merge(self) -> list:
        """Emits all that fills windows; the pieces left over."""
        used, kept = 0, []
        for _, pieces in sorted(self.open, key=lambda w: -w[0]):
            for doc, start, ids, total in pieces:
                while used + len(ids) >= self.window:
                    head = self.window - used
                    self.emit(kept + [(doc, start, ids[:head], total)])
                    ids, start, used, kept = ids[head:], start + head, 0, []
                if len(ids):
                    kept.append((doc, start, ids, total))
                    used += len(ids)
        self.open = []
        return kept


class _Rows:
    """Emitted windows as Arrow rows; leftovers carry their ids."""

    def __init__(self, first: int, kind: pa.DataType):
        self.next, self.kind, self.rows = first, kind, []

    def emit(self, pieces: list, rest: bool = False) -> None:
        at = 0
        for doc, start, ids, total in pieces:
            raw = np.ascontiguousarray(ids, "<u4").tobytes()
            self.rows.append((doc, start, len(ids), zlib.crc32(raw), total, self.next, at, raw if rest else None))
            at += len(ids)
        self.next += 1

    def batch(self) -> pa.RecordBatch:
        cols = list(zip(*self.rows, strict=True)) if self.rows else [[]] * 8
        self.rows = []
        kinds = (self.kind, *[pa.int64()] * 6, pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds, strict=True)], COLUMNS)


COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"]
SCHEMA = "doc_id {}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary"


def _pack_task(path: str, window: int, slots: int, closing: int, cache_bytes: int, keep: bool = True):
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, rows = encoder(path, cache_bytes), None
        for b in batches:
            if rows is None:
                rows = _Rows(TaskContext.get().partitionId() << 32, b.schema.field("doc_id").type)
                packer = Packer(window, slots, rows.emit)
            for a in range(0, b.num_rows, 500):
                part = b.slice(a, 500)
                for doc, text in zip(part.column("doc_id").to_pylist(), strings(part.column("text")), strict=True):
                    ids = enc.ids(text)
                    ids = np.append(ids, np.array(closing, ids.dtype))
                    packer.add(doc, ids, 0, len(ids))
                yield rows.batch()
        if rows is not None:
            rows.emit(packer.merge(), rest=True)
            yield rows.batch()
        if not keep:
            _ENCODERS.pop((path, cache_bytes), None)
    return run


def _merge_task(window: int):
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        rows = _Rows((1 << 62) + t.column("sequence_id")[0].as_py(), t.schema.field("doc_id").type)
        packer = Packer(window, 1, rows.emit)
        packer.open = [[0, [(d, s, np.frombuffer(i, "<u4"), n) for d, s, i, n in zip(
            *(t.column(c).to_pylist() for c in ("doc_id", "start", "ids", "doc_tokens")), strict=True)]]]
        if rest := packer.merge():
            rows.emit(rest)
        return pa.Table.from_batches([rows.batch()])
    return run


def pack(docs: DataFrame, tokenizer_path: str | None = None, window: int = WINDOW, open_windows: int = OPEN,
         closing_id: int = CLOSING, cache_bytes: int = CACHE_BYTES, keep_encoder: bool = True) -> DataFrame:
    """A row per piece: ``(doc_id, start, length, ids_crc32, doc_tokens,
    sequence_id, offset)``. ``cache_bytes``: of words' ids, about, in each of a
    worker's two caches; less of it costs time alone. ``keep_encoder``: whether a
    worker holds the tokenizer and the caches for its next task; else it loads them anew."""
    if tokenizer_path is None:
        import public_tokenizers
        tokenizer_path = str(public_tokenizers.path(TOKENIZER))
    schema = SCHEMA.format(docs.schema["doc_id"].dataType.simpleString())
    packed = cut_lineage(docs.select("doc_id", "text").mapInArrow(
        _pack_task(tokenizer_path, window, open_windows, closing_id, cache_bytes, keep_encoder), schema))
    left = packed.where("ids is not null").withColumn("g", F.expr(f"shiftright(sequence_id, 32) div {MERGE}"))
    merged = left.groupBy("g").applyInArrow(lambda t: _merge_task(window)(t.drop_columns(["g"])), schema)
    return packed.where("ids is null").unionByName(merged).drop("ids")
