"""Language-model scoring by stupid backoff, from the corpus' own counts.

S(w | c) = count(c w) / count(c) if the n-gram occurs, else ``alpha`` times the
score with the context shortened by one word, down to count(w) / N. A
document's own occurrences are taken out of all counts (and of N), so a
document is scored by the rest of the corpus. A word that is nowhere else
counts as one.

The work is relational. Documents are exploded into n-grams (64-bit hashes); a
block of documents keeps each of its n-grams once, with its count, so what is
shuffled are distinct n-grams of blocks. They are grouped into count tables by
hash partition; each partition sums its n-grams over all blocks and joins the
sums back to the blocks' n-grams; the blocks' documents look theirs up and sum
their logarithms. A row carries a block's n-grams of one partition as an array
in order: the gaps between their hashes, byte by byte, compressed (under six
bytes an n-gram). What goes back is each n-gram's count in other blocks, nearly
always 0 for long n-grams, and so next to nothing. Texts are shuffled
compressed too. None of this drops an n-gram.

A block is the documents of one file split (by file name and start), in
``ceil(split size / 8 MB)`` parts by hash, so it has a bounded size, and a
partition's share shrinks as ``spark.sql.shuffle.partitions`` grows with the
data. No n-gram is hot: a block sends it once.

``docs`` must be a plain scan (blocks are told by its files); any other frame
is written first (``written=False``).

Defined cases: null and empty texts have no words, log_prob 0 and a null mean;
rows that repeat a doc_id are documents of their own; null doc_ids stay null; a
corpus of one document scores each word as seen nowhere else; an empty table
gives an empty result; extra columns are ignored; texts are read whole.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskgraph.llm.common import cut_lineage, mix64, strings, word_hashes

ORDER, ALPHA = 2, 0.4
_MUL = np.uint64(0xD6E8FEB86659FD93)
_PART_BYTES = 8 << 20


def ngrams(texts: list[str], order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the n-grams that end at each word, for n = 1 .. ``order``
    (0 where a document has too few words before it), and each word's
    document."""
    h, counts = word_hashes(texts)
    doc = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(h)) - np.repeat(np.cumsum(counts) - counts, counts)
    out = [h]
    for n in range(2, order + 1):
        longer = np.zeros_like(h)
        longer[1:] = out[-1][:-1] * _MUL + h[1:]
        longer = mix64(longer)
        longer[place < n - 1] = 0
        out.append(longer)
    return out, doc


def _part(grams: np.ndarray, parts: int) -> np.ndarray:
    return (grams % np.uint64(parts)).astype(np.int64)


_ZSTD = pa.Codec("zstd", compression_level=1)
_TEXTS = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=6))


def _packed(x: np.ndarray) -> bytes:
    """Whole numbers by byte planes (the high ones are mostly 0), compressed."""
    return _ZSTD.compress(x.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes(), asbytes=True) if len(x) else b""


def _unpacked(x: bytes, n: int) -> np.ndarray:
    if not n:
        return np.zeros(0, np.uint64)
    planes = np.frombuffer(_ZSTD.decompress(x, 8 * n, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view(np.uint64).ravel()


def _block_rows(block: str, texts: list[str], order: int, parts: int) -> list[tuple]:
    rows = []
    for n, g in enumerate(ngrams(texts, order)[0], 1):
        distinct, count = np.unique(g[g != 0] if n > 1 else g, return_counts=True)
        part = _part(distinct, parts)
        by = np.argsort(part, kind="stable")
        cuts = np.searchsorted(part[by], np.arange(parts + 1))
        # the partition tells the remainder; the quotients ascend
        distinct, count = distinct[by] // np.uint64(parts), count[by]
        rows += [(n * parts + p, block, int(z - a), _packed(np.diff(distinct[a:z], prepend=np.uint64(0))),
                  _packed(count[a:z])) for p, (a, z) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
    return rows


def _explode(order: int, parts: int):
    """Rows ``(part, block, size, grams, counts)`` of the blocks that a task reads."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[str]] = {}

        def give(block: str) -> pa.RecordBatch:
            cols = list(zip(*_block_rows(block, held.pop(block), order, parts), strict=True))
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    cols, (pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary()), strict=True)],
                ["part", "block", "size", "grams", "counts"])

        for b in batches:
            files = b.column("file")
            mine = set(pc.unique(files).to_pylist())
            # a task reads split after split: what this batch no longer has is complete
            for block in [k for k in held if k.rpartition("#")[0] not in mine]:
                yield give(block)
            for block, text in zip(b.column("block").to_pylist(), strings(b.column("text")), strict=True):
                held.setdefault(block, []).append(text)
        for block in list(held):
            yield give(block)
    return run


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``(block, docs)``: a block's documents of a batch, compressed."""
    for b in batches:
        blocks, docs = b.column("block"), b.select(["doc_id", "text"])
        out = []
        for block in pc.unique(blocks).to_pylist():
            sink = pa.BufferOutputStream()
            own = docs.filter(pc.equal(blocks, block))
            with pa.ipc.new_stream(sink, own.schema, options=_TEXTS) as w:
                w.write_batch(own)
            out.append((block, sink.getvalue().to_pybytes()))
        yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.string()),
                                          pa.array([x[1] for x in out], pa.binary())], ["block", "docs"])


def _sum_part(order_parts: int):
    """Sums one partition's n-grams over blocks, and gives each block how often
    its n-grams occur in others."""
    def run(t: pa.Table) -> pa.Table:
        sizes = t.column("size").to_pylist()
        grams = [np.cumsum(_unpacked(x, n), dtype=np.uint64)
                 for x, n in zip(t.column("grams").to_pylist(), sizes, strict=True)]
        counts = [_unpacked(x, n) for x, n in zip(t.column("counts").to_pylist(), sizes, strict=True)]
        distinct, at = np.unique(np.concatenate(grams), return_inverse=True)
        del grams
        total = np.bincount(at, np.concatenate(counts), minlength=len(distinct)).astype(np.uint64)
        words = int(total.sum()) if t.column("part")[0].as_py() < 2 * order_parts else 0
        ends = np.cumsum(sizes)
        others = [_packed(total[at[e - n:e]] - c) for c, n, e in zip(counts, sizes, ends, strict=True)]
        return pa.table({"part": t.column("part"), "block": t.column("block"), "size": t.column("size"),
                         "others": pa.array(others, pa.binary()),
                         "words": pa.array([words] * len(others), pa.int64())})
    return run


def _score(order: int, parts: int, alpha: float):
    """Scores the documents of a block with the sums of its n-grams."""
    def run(docs: pa.Table, sums: pa.Table) -> pa.Table:
        docs = pa.concat_tables(pa.ipc.open_stream(x).read_all() for x in docs.column("docs").to_pylist())
        texts = strings(docs.column("text"))
        grams, doc = ngrams(texts, order)
        arrived = {p: _unpacked(x, n) for p, n, x in zip(
            *(sums.column(c).to_pylist() for c in ("part", "size", "others")), strict=True)}
        own_words = np.bincount(doc, minlength=len(texts))
        rest = (sum(w or 0 for w in sums.column("words").to_pylist()) - own_words[doc]).astype(np.float64)
        other = []                      # of each word's n-grams: occurrences elsewhere
        for n, g in enumerate(grams, 1):
            real = g != 0 if n > 1 else np.ones(len(g), bool)
            distinct, at, total = np.unique(g[real], return_inverse=True, return_counts=True)
            part = _part(distinct, parts)
            by = np.argsort(part, kind="stable")
            if len(distinct):
                total[by] += np.concatenate([arrived[n * parts + p] for p in range(parts)]).astype(np.int64)
            pair = doc[real] * max(len(distinct), 1) + at
            elsewhere = np.zeros(len(g), np.int64)
            elsewhere[real] = total[at]
            del part, by, total, distinct, at
            _, where, times = np.unique(pair, return_inverse=True, return_counts=True)
            elsewhere[real] -= times[where]
            del pair, where, times, real
            other.append(elsewhere)
        del grams, arrived
        logp = np.log(np.maximum(other[0], 1) / np.maximum(rest, 1.0))
        place = np.arange(len(doc)) - np.searchsorted(doc, doc)
        longest = np.ones(len(doc), np.int64)
        for n in range(2, order + 1):
            context = np.zeros(len(doc), np.int64)
            context[1:] = other[n - 2][:-1]                 # the n-1 words before: they end one word earlier
            can, hit = place >= n - 1, (place >= n - 1) & (other[n - 1] > 0)
            logp = np.where(can, np.log(alpha) + logp, logp)
            logp[hit] = np.log(other[n - 1][hit] / context[hit])
            longest[hit] = n
        sums_ = np.bincount(doc, logp, minlength=len(texts))
        backed = np.bincount(doc, longest < np.minimum(place + 1, order), minlength=len(texts)).astype(np.int64)
        unseen = np.bincount(doc, other[0] == 0, minlength=len(texts)).astype(np.int64)
        return pa.table({"doc_id": docs.column("doc_id"), "n_words": pa.array(own_words, pa.int64()),
                         "n_backoff": pa.array(backed), "n_unseen": pa.array(unseen),
                         "log_prob": pa.array(sums_, pa.float64())})
    return run


def _split_parts(spark: SparkSession) -> int:
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]*)", spark.conf.get("spark.sql.files.maxPartitionBytes").lower()).groups()
    size = int(number) << {"k": 10, "m": 20, "g": 30, "t": 40}.get(unit[:1], 0)
    return max(1, -(-size // _PART_BYTES))


def lm_scores(docs: DataFrame, order: int = ORDER, alpha: float = ALPHA, written: bool = True) -> DataFrame:
    """``(doc_id, n_words, n_backoff, n_unseen, log_prob, mean_log_prob)`` for
    every row: words, words whose longest n-gram is nowhere else, words that
    are nowhere else, the sum of log scores and its mean."""
    spark, kind = docs.sparkSession, docs.schema["doc_id"].dataType.simpleString()
    docs = docs.select("doc_id", "text")
    docs = docs if written else cut_lineage(docs)
    parts = max(16, int(spark.conf.get("spark.sql.shuffle.partitions")))
    file = F.concat(F.input_file_name(), F.lit("#"), F.input_file_block_start().cast("string"))
    rows = docs.withColumn("file", file).withColumn("block", F.concat(
        "file", F.lit("#"), F.pmod(F.xxhash64("doc_id"), F.lit(_split_parts(spark))).cast("string")))
    exploded = rows.select("file", "block", "text").mapInArrow(
        _explode(order, parts), "part int, block string, size int, grams binary, counts binary")
    sums = exploded.groupBy("part").applyInArrow(
        _sum_part(parts), "part int, block string, size int, others binary, words long")
    texts = rows.select("doc_id", "block", "text").mapInArrow(_texts, "block string, docs binary")
    scored = texts.groupBy("block").cogroup(sums.groupBy("block")).applyInArrow(
        _score(order, parts, alpha), f"doc_id {kind}, n_words long, n_backoff long, n_unseen long, log_prob double")
    return scored.withColumn("mean_log_prob", F.when(F.col("n_words") > 0, F.col("log_prob") / F.col("n_words")))
