"""Repair of the turn structure of conversations, at least cost.

The roles of a repaired conversation are none at all, or a system row at most,
then user and assistant in turn, ending with the assistant: ``(s?(ua)+)?``. Each
row is kept, given the role that is due, or deleted, and empty rows may be put
in, at the costs below. A row's *symbol* is its role's initial (s, u, a or
another) and its fault: deletion is due (blank or duplicate), truncated, or none.
What a row does to the four states of the automaton (nothing yet; after the
system row; after a user; after an assistant) is a 4 x 4 matrix of costs, with
insertions before the row closed in; rows after each other are min-plus products.

Equal consecutive symbols are one *run*, advanced through the binary powers of its
matrix, which are kept for all conversations. Costs to the end are carried from
the last run to the first. Choices are then unrolled from the first row on: of
the edits that are on a cheapest way, the ASCII-least initial. In a run the costs
to the end, less their least, soon repeat, so a step is a look-up.

A conversation of more than ``CHUNK`` rows is dealt in chunks of rows that lie
together, by a range partitioning of all such conversations' rows, so one that
holds a third of all rows is spread like any others. A chunk gives its matrix;
the products of a conversation's chunks, one small row a chunk, give the costs at
each chunk's end; each chunk then unrolls its choices for the four states that it
may start in, and gives what it ends in. So the rows of a long conversation meet
only as chunks, at its end, as one audit and one digest are asked for.
Duplicates of rows in earlier chunks are found by digests of role and text,
aggregated to the first chunk that holds them.

Defined cases: a null role or text is a space (so its row is blank, or its role
none of the known); null turns come first; rows of a turn stand by role, then
text; null conv_ids are one conversation; a conversation without rows is not
given; extra columns are ignored; texts are read whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskgraph.llm.common import cut_lineage

#: What the edits cost.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5
#: Initials of edits, in ASCII order: ties are broken by it.
EDITS = "DIKR"
CHUNK = 4096                    # rows of a conversation that are dealt with at once
CHUNK_BYTES = 8 << 20
MAX_BROADCAST = 500_000        # conversations of many rows, whose ids are broadcast up to here

NEVER = 1 << 60
START, SYSTEM, USER, ASSISTANT = range(4)
#: The role that is due after each state, and the state after a role.
DUE = {START: "u", SYSTEM: "u", USER: "a", ASSISTANT: "u"}
AFTER = {"u": USER, "a": ASSISTANT}
FULL_ROLE = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}
SPACE = " \t\n\v\f\r"

Matrix = tuple[tuple[int, ...], ...]
Vector = tuple[int, ...]


def times(a: Matrix, b: Matrix) -> Matrix:
    """Min-plus product: first ``a``, then ``b``."""
    return tuple(tuple(min(NEVER, *(a[i][k] + b[k][j] for k in range(4))) for j in range(4)) for i in range(4))


def apply(m: Matrix, v: Vector) -> Vector:
    """Costs to the end before ``m`` from those after it."""
    return tuple(min(NEVER, *(m[i][k] + v[k] for k in range(4))) for i in range(4))


IDENTITY: Matrix = tuple(tuple(0 if i == j else NEVER for j in range(4)) for i in range(4))


def _row_edit(symbol: str, state: int, edit: str) -> tuple[int, int] | None:
    """``(cost, state)`` of an edit that uses up a row. ``symbol`` is the role's
    initial and the fault: ``x`` (deletion is due), ``t`` (truncated) or ``.``."""
    role, fault = symbol[:-1], symbol[-1]
    if edit == "D":
        return DELETE, state
    if fault == "x":
        return None
    more = TRUNCATED if fault == "t" else 0
    if edit == "R":
        return REROLE + more, AFTER[DUE[state]]
    if role == DUE[state]:
        return KEEP + more, AFTER[role]
    return (KEEP + more, SYSTEM) if role == "s" and state == START else None


@lru_cache(maxsize=None)
def _insertions() -> Matrix:
    """Costs of any number of insertions."""
    one = tuple(tuple(0 if i == j else INSERT if j == AFTER[DUE[i]] else NEVER for j in range(4)) for i in range(4))
    return times(times(one, one), times(one, one))


@lru_cache(maxsize=4096)
def power(symbol: str, k: int) -> Matrix:
    """The matrix of 2^k rows of a symbol, with insertions before each."""
    if k:
        half = power(symbol, k - 1)
        return times(half, half)
    row = [[NEVER] * 4 for _ in range(4)]
    for state in range(4):
        for edit in "DKR":
            got = _row_edit(symbol, state, edit)
            if got and got[0] < row[state][got[1]]:
                row[state][got[1]] = got[0]
    return times(_insertions(), tuple(map(tuple, row)))


def advance(symbol: str, n: int, v: Vector) -> Vector:
    """Costs to the end before a run of ``n`` rows, by the binary digits of ``n``."""
    k = 0
    while n:
        if n & 1:
            v = apply(power(symbol, k), v)
        n, k = n >> 1, k + 1
    return v


def runs_of(symbols: list[str]) -> list[tuple[str, int]]:
    out: list[list] = []
    for s in symbols:
        if out and out[-1][0] == s:
            out[-1][1] += 1
        else:
            out.append([s, 1])
    return [(s, n) for s, n in out]


def matrix(runs: list[tuple[str, int]]) -> Matrix:
    m = IDENTITY
    for s, n in runs:
        k = 0
        while n:
            if n & 1:
                m = times(m, power(s, k))
            n, k = n >> 1, k + 1
    return m


#: Costs after the last row: an end is due at once or after insertions.
END: Vector = apply(_insertions(), (0, NEVER, NEVER, 0))


def _least(v: Vector) -> tuple[Vector, int]:
    low = min(v)
    return tuple(min(x - low, NEVER) for x in v), low


@lru_cache(maxsize=65536)
def _back(symbol: str, v: Vector) -> Vector:
    return _least(apply(power(symbol, 0), v))[0]


@lru_cache(maxsize=65536)
def choose(symbol: str, state: int, after: Vector) -> tuple[str, int]:
    """Edits up to and with one row, and the state behind it. ``after``: costs to
    the end behind the row."""
    left = apply(power(symbol, 0), after)[state]
    edits = ""
    while True:
        for edit in EDITS:
            if edit == "I":
                to = AFTER[DUE[state]]
                rest = left - INSERT
                if apply(power(symbol, 0), after)[to] == rest:
                    edits, state, left = edits + edit, to, rest
                    break
            else:
                got = _row_edit(symbol, state, edit)
                if got and got[0] + after[got[1]] == left:
                    return edits + edit, got[1]


def unroll(runs: list[tuple[str, int]], after: Vector, state: int) -> tuple[list[str], int]:
    """The edits of each row (those put in before it included) and the state at
    the end, from ``state`` on; ``after``: costs behind the last row."""
    ends: list[Vector] = []                     # costs behind each run
    v = after
    for s, n in reversed(runs):
        ends.append(v)
        v = _least(advance(s, n, v))[0]
    edits: list[str] = []
    for (s, n), v in zip(runs, reversed(ends), strict=True):
        behind = [_least(v)[0]]                 # costs behind each row, from the last
        for _ in range(n - 1):
            behind.append(_back(s, behind[-1]))
        for v in reversed(behind):
            got, state = choose(s, state, v)
            edits.append(got)
    return edits, state


def closing(state: int) -> str:
    """Insertions after the last row."""
    return {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}[state]


def repaired(rows: list[tuple[str, str]], edits: list[str], state: int) -> Iterator[str]:
    """``role:text`` of the rows that remain or are put in. ``edits`` may have one
    more entry than there are rows: insertions after the last."""
    for k, own in enumerate(edits):
        for edit in own:
            if edit == "D":
                continue
            role, text = ("", "") if edit == "I" else rows[k]
            if edit == "K":
                state = SYSTEM if role[:1] == "s" and state == START else AFTER[role[:1]]
            else:
                role, state = FULL_ROLE[DUE[state]], AFTER[DUE[state]]
            yield f"{role}:{text}"


def fault_of(text: str, seen: bool) -> str:
    """blank, duplicate, truncated or nothing; the first that holds."""
    ink = text.rstrip(SPACE)
    if not ink:
        return "blank"
    if seen:
        return "duplicate"
    return "" if ink[-1] in ".!?" else "truncated"


_FAULT = {"blank": "x", "duplicate": "x", "truncated": "t", "": "."}


class Chunk:
    """Rows of one conversation that lie together, in order."""

    def __init__(self) -> None:
        self.rows: list[tuple[str, str]] = []
        self.keys: list[bytes] = []
        self.bytes = 0

    def add(self, role: str, text: str) -> None:
        self.rows.append((role, text))
        self.keys.append(hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest())
        self.bytes += len(role) + len(text) + 64

    def read(self, earlier: set[bytes]) -> "Chunk":
        """Faults, symbols and runs; ``earlier``: keys of rows in chunks before."""
        seen, self.count = set(earlier), {"blank": 0, "duplicate": 0, "truncated": 0, "": 0}
        symbols = []
        for (role, text), key in zip(self.rows, self.keys, strict=True):
            fault = fault_of(text, key in seen)
            seen.add(key)
            self.count[fault] += 1
            symbols.append(role[:1] + _FAULT[fault])
        self.runs = runs_of(symbols)
        initials = [role[:1] for role, _ in self.rows]
        self.illegal = sum(a + b not in LEGAL for a, b in zip(initials, initials[1:], strict=False))
        self.first, self.last = (initials[0], initials[-1]) if initials else ("", "")
        return self


PIECES = ("conv_id {kind}, piece long, whole boolean, blank long, duplicate long, truncated long, illegal long, "
          "cost long, audit string, repaired string")


def _finished(chunk: Chunk) -> tuple:
    """Counts, cost, audit and repaired rows of a conversation that is one chunk."""
    m = matrix(chunk.runs)
    edits, state = unroll(chunk.runs, END, START)
    edits.append(closing(state))
    lines = list(repaired(chunk.rows, edits, START))
    return (0, True, chunk.count["blank"], chunk.count["duplicate"], chunk.count["truncated"], chunk.illegal,
            apply(m, END)[START], "".join(edits), "\n".join(lines) if lines else None)


_OUT = ["conv_id", "piece", "whole", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired"]
_TYPES = [pa.int64(), pa.bool_(), *[pa.int64()] * 5, pa.string(), pa.string()]


def _arrow(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Conversations whose rows follow each other; each is one chunk."""
    conv, chunk, started, done, size, kind = None, Chunk(), False, [], 0, pa.int64()

    def out() -> pa.RecordBatch:
        return _arrow(done, _OUT, [kind, *_TYPES])

    for whole in batches:
        kind = whole.column("conv_id").type
        for at in range(0, whole.num_rows, 500):
            for r in whole.slice(at, 500).to_pylist():
                if started and r["conv_id"] != conv:
                    done.append((conv, *_finished(chunk.read(set()))))
                    size += chunk.bytes
                    chunk = Chunk()
                    if size > 4 << 20 or len(done) >= 5000:
                        yield out()
                        done, size = [], 0
                conv, started = r["conv_id"], True
                chunk.add(r["role"], r["text"])
    if started:
        done.append((conv, *_finished(chunk.read(set()))))
    yield out()


# ---- conversations of many rows -----------------------------------------------------

_CHUNK_NAMES = ["conv_id", "chunk", "roles", "texts", "keys"]


def _chunks(rows_a_chunk: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Consecutive rows of a conversation in a partition, as chunks numbered
        by their first row's place."""
        conv, place, chunk, kind = None, None, Chunk(), pa.int64()

        def out() -> pa.RecordBatch:
            return _arrow([(conv, place, [r for r, _ in chunk.rows], [t for _, t in chunk.rows], chunk.keys)],
                          _CHUNK_NAMES, [kind, pa.int64(), pa.list_(pa.string()), pa.list_(pa.string()),
                                         pa.list_(pa.binary())])

        for whole in batches:
            kind = whole.column("conv_id").type
            for at in range(0, whole.num_rows, 500):
                for r in whole.slice(at, 500).to_pylist():
                    if chunk.rows and (r["conv_id"] != conv or len(chunk.rows) >= rows_a_chunk
                                       or chunk.bytes >= CHUNK_BYTES):
                        yield out()
                        chunk = Chunk()
                    if not chunk.rows:
                        conv, place = r["conv_id"], r["place"]
                    chunk.add(r["role"], r["text"])
        if chunk.rows:
            yield out()
    return run


_READ = ["conv_id", "chunk", "blank", "duplicate", "truncated", "illegal", "first", "last", "matrix", "symbols", "lengths"]
_READ_SCHEMA = ("conv_id {kind}, chunk long, blank long, duplicate long, truncated long, illegal long, first string, "
                "last string, matrix array<long>, symbols array<string>, lengths array<long>")


def _chunk_of(r: dict) -> Chunk:
    c = Chunk()
    for role, text in zip(r["roles"], r["texts"], strict=True):
        c.add(role, text)
    return c


def _read_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(whole.num_rows):
            r = whole.slice(at, 1).to_pylist()[0]
            c = _chunk_of(r).read(set(r["earlier"] or ()))
            flat = [x for row in matrix(c.runs) for x in row]
            yield _arrow([(r["conv_id"], r["chunk"], c.count["blank"], c.count["duplicate"], c.count["truncated"],
                           c.illegal, c.first, c.last, flat, [s for s, _ in c.runs], [n for _, n in c.runs])],
                         _READ, [whole.column("conv_id").type, *[pa.int64()] * 5, pa.string(), pa.string(),
                                 pa.list_(pa.int64()), pa.list_(pa.string()), pa.list_(pa.int64())])


def _ends(table: pa.Table) -> pa.Table:
    """Costs behind each chunk of one conversation, from its chunks' matrices;
    the cost of all stands with the first."""
    rows = sorted(table.to_pylist(), key=lambda r: r["chunk"])
    v, out = END, []
    for r in reversed(rows):
        out.append(list(v))
        v = apply(tuple(tuple(r["matrix"][4 * i:4 * i + 4]) for i in range(4)), v)
    done = [(r["conv_id"], r["chunk"], w, 0 if k else v[START])
            for k, (r, w) in enumerate(zip(rows, reversed(out), strict=True))]
    return pa.Table.from_batches([_arrow(done, ["conv_id", "chunk", "after", "cost"],
                                         [table.column("conv_id").type, pa.int64(), pa.list_(pa.int64()), pa.int64()])])


def _unroll_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits of a chunk for each state that it may start in."""
    for whole in batches:
        for at in range(whole.num_rows):
            r = whole.slice(at, 1).to_pylist()[0]
            runs = list(zip(r["symbols"], r["lengths"], strict=True))
            after, low = tuple(r["after"]), min(r["after"])
            edits, ends = [], []
            for state in range(4):
                got, end = unroll(runs, tuple(x - low for x in after), state)
                edits.append("\n".join(got))
                ends.append(end)
            yield _arrow([(r["conv_id"], r["chunk"], edits, ends)], ["conv_id", "chunk", "edits", "ends"],
                         [whole.column("conv_id").type, pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32())])


def _starts(table: pa.Table) -> pa.Table:
    """The state in which each chunk of one conversation starts, what is put in
    after it, and whether its first row may not follow the row before it."""
    rows, state, out, last = sorted(table.to_pylist(), key=lambda r: r["chunk"]), START, [], None
    for k, r in enumerate(rows):
        before, state = state, r["ends"][state]
        out.append((r["conv_id"], r["chunk"], k, before, closing(state) if k + 1 == len(rows) else "",
                    int(last is not None and last + r["first"] not in LEGAL)))
        last = r["last"]
    return pa.Table.from_batches([_arrow(
        out, ["conv_id", "chunk", "piece", "start", "closing", "border"],
        [table.column("conv_id").type, pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.int64()])])


def _repaired_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(whole.num_rows):
            r = whole.slice(at, 1).to_pylist()[0]
            own = [*r["edits"][r["start"]].split("\n"), r["closing"]]
            lines = list(repaired(list(zip(r["roles"], r["texts"], strict=True)), own, r["start"]))
            yield _arrow([(r["conv_id"], r["piece"], False, r["blank"], r["duplicate"], r["truncated"],
                           r["illegal"] + r["border"], r["cost"], "".join(own), "\n".join(lines) if lines else None)],
                         _OUT, [whole.column("conv_id").type, *_TYPES])


def _long(rows: DataFrame, kind: str, rows_a_chunk: int) -> DataFrame:
    """Conversations of many rows. ``rows`` are theirs."""
    order = [F.col("conv_id"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]
    # equal rows may be very many, so they are parted by the place from which they come
    dealt = (rows.withColumn("__from", F.spark_partition_id())
             .repartitionByRange(*order, F.col("__from")).sortWithinPartitions(*order))
    placed = cut_lineage(dealt.select("conv_id", "role", "text", F.monotonically_increasing_id().alias("place")))
    chunks = cut_lineage(placed.mapInArrow(
        _chunks(rows_a_chunk), f"conv_id {kind}, chunk long, roles array<string>, texts array<string>, keys array<binary>"))
    # keys that a chunk has in common with one before it; a key is once in a chunk
    own = chunks.select("conv_id", "chunk", F.explode(F.array_distinct("keys")).alias("key"))
    first = own.groupBy(F.col("conv_id").alias("c"), F.col("key").alias("k")).agg(F.min("chunk").alias("first"))
    again = (own.join(first, F.col("key").eqNullSafe(F.col("k")) & F.col("conv_id").eqNullSafe(F.col("c"))
                      & (F.col("chunk") > F.col("first")))
             .groupBy("chunk").agg(F.collect_list("key").alias("earlier")))         # a chunk's keys at most
    read = cut_lineage(chunks.join(again, "chunk", "left").select(*_CHUNK_NAMES[:4], "earlier")
                       .mapInArrow(_read_chunks, _READ_SCHEMA.format(kind=kind)))
    ends = read.select("conv_id", "chunk", "matrix").groupBy("conv_id").applyInArrow(
        _ends, f"conv_id {kind}, chunk long, after array<long>, cost long").drop("conv_id")
    counted = cut_lineage(read.drop("matrix").join(ends, "chunk"))
    edits = cut_lineage(counted.select("conv_id", "chunk", "symbols", "lengths", "after")
                        .mapInArrow(_unroll_chunks, f"conv_id {kind}, chunk long, edits array<string>, ends array<int>"))
    starts = (edits.select("chunk", "ends").join(counted.select("conv_id", "chunk", "first", "last"), "chunk")
              .groupBy("conv_id").applyInArrow(
                  _starts, f"conv_id {kind}, chunk long, piece long, start int, closing string, border long"))
    return (chunks.select("conv_id", "chunk", "roles", "texts").join(edits.select("chunk", "edits"), "chunk")
            .join(counted.drop("conv_id", "symbols", "lengths", "after", "first", "last"), "chunk")
            .join(starts.drop("conv_id"), "chunk").mapInArrow(_repaired_chunks, PIECES.format(kind=kind)))


def _one_chunk(rows: DataFrame, kind: str) -> DataFrame:
    """Conversations of at most ``CHUNK`` rows, a task's one after the other."""
    return (rows.repartition("conv_id")
            .sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")
            .select("conv_id", "role", "text").mapInArrow(_short, PIECES.format(kind=kind)))


def repair(rows: DataFrame, rows_a_chunk: int = CHUNK, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """``rows(conv_id, turn, role, text)`` -> the pieces of every conversation, in
    order: faults, the cost (with the first piece), initials of the cheapest
    edits, and the repaired rows as text (``role:text``, joined by line feeds; null
    if none is left). A conversation of up to ``rows_a_chunk`` rows and ``chunk_bytes``
    is one piece (``whole``)."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    rows = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    size = rows.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    long = cut_lineage(size.where((F.col("n") > rows_a_chunk) | (F.col("bytes") > chunk_bytes))
                       .select(F.col("conv_id").alias("long_id")))
    n = long.count()
    if not n:
        return _one_chunk(rows, kind)
    side = F.broadcast(long) if n <= MAX_BROADCAST else long         # beyond it a shuffle, which AQE may split
    same = F.col("conv_id").eqNullSafe(F.col("long_id"))
    many = cut_lineage(rows.join(side, same, "left_semi"))
    return _one_chunk(rows.join(side, same, "left_anti"), kind).unionByName(_long(many, kind, rows_a_chunk))


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for the pieces of each conversation, which follow each other; a
    piece is dropped when it is hashed."""
    conv, started, done, kind = None, False, [], pa.int64()
    total, audit, digest, lines = [0] * 5, [], hashlib.sha256(), False

    def row() -> tuple:
        return conv, *total, "".join(audit), digest.hexdigest()

    for whole in batches:
        kind = whole.column("conv_id").type
        for at in range(whole.num_rows):
            r = whole.slice(at, 1).to_pylist()[0]
            if started and r["conv_id"] != conv:
                done.append(row())
                total, audit, digest, lines = [0] * 5, [], hashlib.sha256(), False
            conv, started = r["conv_id"], True
            total = [t + r[c] for t, c in zip(total, _OUT[3:8], strict=True)]
            audit.append(r["audit"])
            if r["repaired"] is not None:
                digest.update((("\n" if lines else "") + r["repaired"]).encode())
                lines = True
    if started:
        done.append(row())
    yield _arrow(done, _SUMMARY, [kind, *[pa.int64()] * 5, pa.string(), pa.string()])


_SUMMARY = ["conv_id", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def summary(pieces: DataFrame) -> DataFrame:
    """A row for every conversation, with the digest of its repaired text."""
    kind = pieces.schema["conv_id"].dataType.simpleString()
    schema = (f"conv_id {kind}, blank long, duplicate long, truncated long, illegal long, cost long, audit string, "
              "repaired_sha256 string")
    one = pieces.where("whole").select(*_SUMMARY[:-1], F.sha2(F.coalesce("repaired", F.lit("")), 256).alias(_SUMMARY[-1]))
    more = (pieces.where("not whole").repartition("conv_id").sortWithinPartitions("conv_id", "piece")
            .mapInArrow(_digests, schema))
    return one.unionByName(more)


def gaps(rows: DataFrame) -> DataFrame:
    """``(conv_id, gaps)``: turns that are missing between a conversation's first and last."""
    return rows.groupBy("conv_id").agg(F.coalesce(
        F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn"), F.lit(0)).cast("long").alias("gaps"))


def damage(rows: DataFrame) -> DataFrame:
    """Faults put into ``conversations`` by a hash of conversation and turn; nulls
    are a space."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    h = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(c, F.lit(" ")) for c in ("role", "text"))
    return (rows.withColumn("__h", h).where(F.col("__h") != 0)
            .withColumn("__copy", F.explode(F.when(F.col("__h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
            .select("conv_id", "turn", F.when(F.col("__h") == 4, F.lit("user")).otherwise(role).alias("role"),
                    F.when(F.col("__h") == 1, F.lit("")).when(F.col("__h") == 2, F.translate(text, ".!?", ""))
                    .otherwise(text).alias("text")))
