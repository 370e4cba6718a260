"""Byte-level BPE encoding and decoding, long texts by tree concatenation.

A text of up to ``LONG`` bytes is encoded where it is read. A longer one is cut
into leaves of about ``LEAF`` bytes that are rows of their own, encoded in
parallel by any task, and joined upwards: each round every task joins the
halves of small subtrees (``FAN`` neighbours), until a text is one node.

Leaves end between pieces of the tokenizer's own pattern, where the tokens of
two sides stand beside each other unchanged. A piece that is longer than a leaf
(a very long word, line of signs or run of spaces) is unsplit text: it is cut by
bytes, and its halves are joined through windows. The window is some tokens on
either side of the join, encoded anew; where it shares a token (the same bytes,
the same id) with the left half and one with the right half, the left half up
to the first, the window between them and the right half from the second are
the encoding of the whole. Otherwise the window is doubled; one that has grown
to the whole piece is the encoding itself.

Why that is exact: merges run in the order of their ranks, and a merge can
cross the border of two neighbouring tokens only by what these two tokens hold.
So a sequence is the encoding of its bytes if every two neighbours in it are
neighbours in some encoding, and here every two are: inside the left half, the
window or the right half.

Defined cases: a null text is empty; an empty text has no ids; a special token's
string in a text is the special token, as the library has it; rows that repeat a
doc_id or a text are encoded each; a null doc_id stays null; an empty table
gives an empty result; extra columns are ignored; texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.llm.common import cut_lineage, strings
from riskgraph.llm.units import LONG_UNIT, OTHER, PATTERN, Kept, byte_alphabet, byte_level, split_units

LONG = 65_536           # bytes of a text that is encoded in one place
LEAF = 16_384
FAN = 8                 # neighbours that one task joins in a round
WINDOW = 8              # tokens on either side of a join, to begin with
SLICE = 200             # texts that are Python strings at a time
PIECES = 200_000        # pieces of at most LONG_UNIT characters that are remembered, some 60 MB
PROBES = ("a b", " a  b\n\n c", "x, y. z'll 12 3a don't we've", "Dieüauß Èonai, öäte. ÀÉ-ñ it's <b>&amp;</b> (9.5%) Łódź \\o/ A1b2",
          " ¡¿½²³¼ª·µ º«»¬±°§¶", "\t\tx \r\n\r\n  y", "naïve' 'tis O'Neill'd IJĲĳŉſ", "tab\there __init__ a'b")


class Codec:
    """Encoding and decoding with one tokenizers file."""

    def __init__(self, path: str):
        self.tokenizer, self.bytes = byte_level(path, plain_specials=False)
        self.specials = [a.content for a in self.tokenizer.get_added_tokens_decoder().values()]
        self.char = {b: c for c, b in byte_alphabet().items()}
        #: Latin characters as the model knows them: one or two bytes, as characters.
        self.latin = {x: "".join(self.char[b] for b in chr(x).encode()) for x in range(0x180)}
        self.kept = Kept(self._encode_units, len)
        self.piece: dict[str, bytes] = {}
        self.by_pattern = self._same_by_pattern()

    def _library(self, units: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes()
                for e in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]

    def _same_by_pattern(self) -> bool:
        """Whether the published pattern and the model give the library's ids."""
        return [self._quick(u) for p in PROBES for u in split_units(p)] == \
            self._library([u for p in PROBES for u in split_units(p)])

    def _quick(self, unit: str) -> bytes:
        """A unit of Latin characters: its pieces, by the pattern, go to the model
        straight, without the library's bookkeeping of offsets."""
        out = []
        for p in PATTERN.findall(unit):
            ids = self.piece.get(p)
            if ids is None:
                ids = np.array([t.id for t in self.tokenizer.model.tokenize(p.translate(self.latin))], "<u4").tobytes()
                if len(p) <= LONG_UNIT:
                    if len(self.piece) >= PIECES:
                        self.piece.clear()
                    self.piece[p] = ids
            out.append(ids)
        return b"".join(out)

    def _encode_units(self, units: list[str]) -> list[bytes]:
        """Ids of units; those with a special token's string or characters beyond
        the Latin ones go to the library."""
        if not self.by_pattern:
            return self._library(units)
        other = [u for u in units if OTHER.search(u) or any(s in u for s in self.specials)]
        slow = dict(zip(other, self._library(other), strict=True)) if other else {}
        return [slow[u] if u in slow else self._quick(u) for u in units]

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """Ids of each text, 32-bit little-endian."""
        units = [split_units(t) for t in texts]
        self.kept.fill(u for us in units for u in us)
        return [b"".join([self.kept[u] for u in us]) for us in units]

    def encode_piece(self, raw: bytes) -> list[int]:
        """Ids of bytes that the pattern does not split."""
        return [t.id for t in self.tokenizer.model.tokenize("".join(map(self.char.__getitem__, raw)))]

    def pieces(self, unit: str) -> Iterator[str]:
        """The pieces of a unit: special tokens, and what the pattern finds between them."""
        at = 0
        while at < len(unit):
            found = [(unit.find(s, at), s) for s in self.specials if s]
            nearest = min(((i, -len(s), s) for i, s in found if i >= 0), default=None)
            end = nearest[0] if nearest else len(unit)
            if end > at:
                for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(unit[at:end]):
                    yield unit[at + a:at + b]
            if nearest:
                yield nearest[2]
                end += len(nearest[2])
            at = end

    def decode(self, ids: np.ndarray) -> str:
        return b"".join(map(self.bytes.__getitem__, ids.tolist())).decode("utf-8", "replace")

    def join_piece(self, left: list[int], right: list[int], window: int = WINDOW) -> list[int]:
        """The encoding of a piece from those of its two halves."""
        while True:
            a, b = left[-window:], right[:window]
            raw = [self.bytes[i] for i in a + b]
            edge = sum(map(len, raw[:len(a)]))
            fresh = self.encode_piece(b"".join(raw))
            new = _spans(fresh, self.bytes)
            old_a, old_b = _spans(a, self.bytes), _spans(b, self.bytes, edge)
            where = {s: i for i, s in enumerate(new)}
            # the shared token nearest to the join on each side; none is needed at a piece's end
            i = next((k for k in range(len(a) - 1, -1, -1) if old_a[k] in where), None)
            j = next((k for k in range(len(b)) if old_b[k] in where), None)
            whole_a, whole_b = len(a) == len(left), len(b) == len(right)
            if (i is not None or whole_a) and (j is not None or whole_b):
                head = left[:len(left) - len(a) + i + 1] if i is not None else []
                start = where[old_a[i]] + 1 if i is not None else 0
                tail, stop = (right[j:], where[old_b[j]]) if j is not None else ([], len(fresh))
                return head + fresh[start:stop] + tail
            window *= 2


def _spans(ids: list[int], table: list[bytes], at: int = 0) -> list[tuple[int, int, int]]:
    out = []
    for i in ids:
        end = at + len(table[i])
        out.append((at, end, i))
        at = end
    return out


_CODECS: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One per Python worker and file."""
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def _ended(held: list[str]) -> list[str]:
    """One or two leaves of pieces. Of two runs of white space at the end the
    first is the second's look-ahead: apart from what follows they would be one
    piece, so they part here."""
    if len(held) > 1 and _space(held[-1]) and _space(held[-2]):
        return ["".join(held[:-1]), held[-1]]
    return ["".join(held)] if held else []


def _space(piece: str) -> bool:
    return piece.isspace() and not _SEPARATORS.search(piece)


_SEPARATORS = re.compile(r"[\x1c-\x1f]")        # white space to Python, not to the pattern


def leaves(c: Codec, text: str, leaf: int = LEAF) -> Iterator[tuple[bool, bool, bytes]]:
    """``(open, part, data)`` of the leaves of a text, in order. ``part``: data are
    bytes of one piece, else whole pieces; ``open``: the piece began in the leaf
    before."""
    held, size = [], 0
    for unit in split_units(text):
        for piece in (unit,) if len(unit) <= leaf // 4 else c.pieces(unit):
            n = len(piece.encode())
            unsplit = n > leaf and piece not in c.specials
            if not unsplit:
                held.append(piece)
                size += n
            if size >= leaf or unsplit:
                for whole in _ended(held):
                    yield False, False, whole.encode()
                held, size = [], 0
            if unsplit:
                raw = piece.encode()
                for at in range(0, n, leaf):
                    yield at > 0, True, raw[at:at + leaf]
    for whole in _ended(held):
        yield False, False, whole.encode()


_NODE = "row long, seq long, open boolean, head int, tail int, ids binary"


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _cut(path: str, leaf: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            for at in range(b.num_rows):            # one long text at a time
                one = b.slice(at, 1)
                row, rows, size = one.column("row")[0].as_py(), [], 0
                for seq, (opened, part, data) in enumerate(leaves(c, strings(one.column("text"))[0], leaf)):
                    rows.append((row, seq, opened, part, data))
                    size += len(data)
                    if size > 4 << 20:
                        yield _batch(rows, *_LEAF)
                        rows, size = [], 0
                yield _batch(rows, *_LEAF)
    return run


_LEAF = (["row", "seq", "open", "part", "data"], [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()])
_NODES = (["row", "seq", "open", "head", "tail", "ids"],
          [pa.int64(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.binary()])


def _encode_leaves(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                out = []
                for r in whole.slice(at, SLICE).to_pylist():
                    if r["part"]:       # head and tail: ids of pieces that go on beyond the leaf
                        ids = c.encode_piece(r["data"])
                        out.append((r["row"], r["seq"], r["open"], len(ids), len(ids), np.array(ids, "<u4").tobytes()))
                    else:
                        ids = c.encode_all([r["data"].decode()])[0]
                        out.append((r["row"], r["seq"], r["open"], 0, 0, ids))
                yield _batch(out, *_NODES)
    return run


class Node:
    """Ids of consecutive leaves. ``head`` and ``tail`` of them belong to a piece
    of which a part may lie before or behind."""

    def __init__(self, opened: bool, head: int, tail: int, ids: np.ndarray):
        self.opened, self.head, self.tail, self.ids = opened, head, tail, ids

    def joined(self, right: "Node", c: Codec) -> "Node":
        if not right.opened:
            return Node(self.opened, self.head, right.tail, np.concatenate((self.ids, right.ids)))
        n, m = len(self.ids) - self.tail, right.head
        middle = np.array(c.join_piece(self.ids[n:].tolist(), right.ids[:m].tolist()), "<u4")
        head = self.head if n else len(middle)                      # the piece may fill a whole side
        tail = right.tail if m < len(right.ids) else len(middle)
        return Node(self.opened, head, tail, np.concatenate((self.ids[:n], middle, right.ids[m:])))


def joined_halves(nodes: list[Node], c: Codec) -> Node:
    if len(nodes) == 1:
        return nodes[0]
    half = len(nodes) // 2
    return joined_halves(nodes[:half], c).joined(joined_halves(nodes[half:], c), c)


def _join(path: str):
    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["seq"])       # FAN rows at most
        one = joined_halves([Node(r["open"], r["head"], r["tail"], np.frombuffer(r["ids"], "<u4")) for r in rows],
                            codec(path))
        return pa.Table.from_batches([_batch(
            [(rows[0]["row"], rows[0]["seq"] // FAN, one.opened, one.head, one.tail, one.ids.tobytes())], *_NODES)])
    return run


def _encode_short(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                b = whole.slice(at, SLICE)
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), pa.array(c.encode_all(strings(b.column("text"))), pa.binary())], ["doc_id", "ids"])
    return run


def encode(docs: DataFrame, path: str, long: int = LONG, leaf: int = LEAF) -> DataFrame:
    """``(doc_id, ids)`` for every row; ids are 32-bit little-endian."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    rows = docs.select("doc_id", "text")
    short = rows.where(size <= long).mapInArrow(_encode_short(path), f"doc_id {kind}, ids binary")
    # written once, so that a text's number is the same whatever runs again
    whole = cut_lineage(rows.where(size > long).withColumn("row", F.monotonically_increasing_id()))
    cut = whole.select("row", "text").mapInArrow(
        _cut(path, leaf), "row long, seq long, open boolean, part boolean, data binary")
    nodes = cut_lineage(cut.repartition("row", "seq").mapInArrow(_encode_leaves(path), _NODE))
    while (nodes.agg(F.max("seq")).first()[0] or 0) > 0:
        nodes = cut_lineage(nodes.groupBy("row", F.floor(F.col("seq") / FAN).alias("subtree"))
                            .applyInArrow(_join(path), _NODE))
    return short.unionByName(whole.select("row", "doc_id").join(nodes.select("row", "ids"), "row").select("doc_id", "ids"))


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                b = whole.slice(at, SLICE)
                texts = [c.decode(np.frombuffer(x, "<u4")) for x in b.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), b.column("ids"), pa.array(texts, pa.string())], ["doc_id", "ids", "text"])
    return run


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """``(doc_id, ids, text)`` of ``(doc_id, ids)``; bytes that are no UTF-8 become
    replacement characters, as in the library."""
    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(_decode(path), f"doc_id {kind}, ids binary, text string")
