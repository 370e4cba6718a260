"""op13 against a search over all edits, in one chunk and in many."""

import hashlib
import random
import re
import zlib
from functools import lru_cache

import pytest
from pyspark.sql import functions as F

from riskgraph.llm import repair
from riskgraph.llm.queries import QUERIES
from tests.conftest import SF_SMALL


def brute(rows):
    """Summary of one conversation's rows (role, text), by dynamic programming
    over whole audits."""
    seen, faults = set(), []
    for role, text in rows:
        ink = re.findall(r"[^\x20\x09-\x0D]", text)
        faults.append("blank" if not ink else "duplicate" if (role, text) in seen else
                      "truncated" if ink[-1] not in ".!?" else "")
        seen.add((role, text))

    @lru_cache(maxsize=None)
    def best(i, state, room):
        """(cost, audit, repaired) from row i on; state: what may follow; room: insertions left here."""
        found = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        due = "a" if state == "u" else "u"
        full = {"u": "user", "a": "assistant"}[due]

        def add(cost, edit, line, rest):
            if rest is not None:
                found.append((cost + rest[0], edit + rest[1], (line, *rest[2]) if line else rest[2]))
        if room:
            add(5, "I", f"{full}:", best(i, due, room - 1))
        if i < len(rows):
            (role, text), fault = rows[i], faults[i]
            add(2, "D", None, best(i + 1, state, 3))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if role[:1] == due or (role[:1] == "s" and state == ""):
                    add(more, "K", f"{role}:{text}", best(i + 1, role[:1], 3))
                add(1 + more, "R", f"{full}:{text}", best(i + 1, due, 3))
        return min(found, key=lambda x: x[:2]) if found else None

    cost, audit, lines = best(0, "", 3)
    initials = [r[:1] for r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (faults.count("blank"), faults.count("duplicate"), faults.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def conversation(rng, n):
    return [(rng.choice(["user", "assistant", "assistant", "user", "system", "tool", " ", ""]),
             rng.choice(["a.", "b!", "c", " ", "", "d?\n", "Eé ", "f. g"]) + rng.choice(["", "", f" {rng.random()}."]))
            for _ in range(n)]


def test_every_small_conversation_is_repaired_at_least_cost():
    rng = random.Random(3)
    for n in [*range(9)] * 60:
        rows = conversation(rng, n)
        chunk = repair.Chunk()
        for r in rows:
            chunk.add(*r)
        got = repair._finished(chunk.read(set()))
        assert (*got[2:8], hashlib.sha256((got[8] or "").encode()).hexdigest()) == brute(rows), rows


def test_powers_of_a_run_equal_its_rows_one_by_one():
    for symbol in ("u.", "a.", "at", "ux", "s.", "?."):
        v = repair.END
        for n in range(1, 40):
            v = repair.apply(repair.power(symbol, 0), v)
            assert repair.advance(symbol, n, repair.END) == v


def summaries(spark, table, **kw):
    rows = spark.createDataFrame(table, "conv_id long, turn long, role string, text string, n int").repartition(5)
    got = repair.summary(repair.repair(rows, **kw)).collect()
    assert len(got) == len({r["conv_id"] for r in got})
    return {r["conv_id"]: tuple(r)[1:] for r in got}


def wanted(table):
    out = {}
    for conv in {r[0] for r in table}:
        rows = sorted(((t if t is not None else -1, r if r is not None else " ", x if x is not None else " ")
                       for c, t, r, x, _ in table if c == conv))
        out[conv] = brute([(r, x) for _, r, x in rows])
    return out


def test_long_conversations_equal_short_ones(spark):
    rng = random.Random(8)
    table = [(c, t if t else None, role, text if rng.random() > 0.1 else None, 1)
             for c, n in ((1, 60), (2, 3), (3, 33), (None, 25), (4, 1), (5, 17))
             for t, (role, text) in enumerate(conversation(rng, n))]
    table += [(6, 2, "user", "same.", 1)] * 40 + [(6, 1, "user", None, 1)]       # equal rows of one turn
    want = wanted(table)
    assert summaries(spark, table) == want
    assert summaries(spark, table, rows_a_chunk=4) == want


def test_empty_table_and_long_text(spark):
    assert summaries(spark, []) == {}
    table = [(1, 0, "user", "x" * 300_000, 1), (1, 1, "assistant", "ok.", 1)]
    assert summaries(spark, table) == wanted(table) == summaries(spark, table, chunk_bytes=1000)


@pytest.mark.parametrize("sf", [SF_SMALL])
def test_query_equals_brute_force(spark, sf):
    table = spark.read.parquet(f"{sf}/conversations.parquet").collect()
    got = {r["conv_id"]: r for r in QUERIES["op13_turn_repair"](spark, sf).collect()}
    assert set(got) == {r["conv_id"] for r in table}
    for conv in got:
        rows, turns = [], []
        for r in sorted((r for r in table if r["conv_id"] == conv), key=lambda r: r["turn"]):
            h, role, text = zlib.crc32(f"{conv}:{r['turn']}".encode()) % 20, r["role"], r["text"]
            if h == 0:
                continue
            role, text = "user" if h == 4 else role, "" if h == 1 else re.sub("[.!?]", "", text) if h == 2 else text
            rows += [(role, text)] * (2 if h == 3 else 1)
            turns.append(r["turn"])
        g = got[conv]
        assert g["gaps"] == (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0)
        assert (g["blank"], g["duplicate"], g["truncated"], g["illegal"], g["cost"], g["audit"],
                g["repaired_sha256"]) == brute(rows), conv


def test_damage_takes_nulls_as_spaces(spark):
    rows = spark.createDataFrame([(None, None, None, None), (7, None, "user", None)],
                                 "conv_id long, turn long, role string, text string")
    kinds = [zlib.crc32(k) % 20 for k in (b" : ", b"7: ")]
    assert all(k > 4 for k in kinds)            # untouched but for the nulls
    got = repair.damage(rows).orderBy(F.col("conv_id").asc_nulls_first()).collect()
    assert [tuple(r) for r in got] == [(None, None, " ", " "), (7, None, "user", " ")]
