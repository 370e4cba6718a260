"""op12 against the tokenizers library on whole texts."""

import hashlib
import random

import numpy as np
import pytest
from tokenizers import Tokenizer

from riskgraph.llm import bpe_tree
from riskgraph.llm.queries import QUERIES, tokenizer_file
from tests.conftest import SF_SMALL

PATH = tokenizer_file("byte_bpe_50k.json")
ALPHABETS = ["abcdefgh", "aab ", " \n\t  ", "abcABC123 .,'!", "東京都にある 日本、。", "é😀ñ  \x85᠎\x1c", "'s't ll re d",
             "=-_*#", "<|endoftext|> "]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def texts(n, seed, longest=300):
    rng = random.Random(seed)
    for _ in range(n):
        s = rng.choice(ALPHABETS) + rng.choice(["", *ALPHABETS])
        x = "".join(rng.choices(s, k=rng.randint(0, longest)))
        yield x[:50] + rng.choice(["", "", "<|endoftext|>", "the", "a" * 90, " " * 70, "don't"]) + x[50:]


def by_tree(c, text, leaf):
    nodes = []
    for opened, part, data in bpe_tree.leaves(c, text, leaf):
        if part:
            ids = c.encode_piece(data)
            nodes.append(bpe_tree.Node(opened, len(ids), len(ids), np.array(ids, "<u4")))
        else:
            nodes.append(bpe_tree.Node(opened, 0, 0, np.frombuffer(c.encode_all([data.decode()])[0], "<u4")))
    return bpe_tree.joined_halves(nodes, c).ids.tolist() if nodes else []


def test_units_and_trees_give_the_library_s_ids(library):
    c = bpe_tree.codec(PATH)
    for text in texts(700, 5):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(c.encode_all([text])[0], "<u4").tolist() == want, ascii(text)
        for leaf in (5, 16, 40):
            assert by_tree(c, text, leaf) == want, (leaf, ascii(text))
        assert c.decode(np.array(want, "<u4")) == library.decode(want, skip_special_tokens=False)


def test_windows_grow_until_both_sides_agree(library):
    c = bpe_tree.codec(PATH)
    rng = random.Random(2)
    for _ in range(300):
        word = "".join(rng.choices(rng.choice(["ab", "a", "thein", "=-", "xyzé"]), k=rng.randint(2, 200)))
        raw, cut = word.encode(), rng.randint(1, len(word.encode()) - 1)
        got = c.join_piece(c.encode_piece(raw[:cut]), c.encode_piece(raw[cut:]), window=1)
        assert got == c.encode_piece(raw) == library.encode(word, add_special_tokens=False).ids


def test_bytes_that_are_no_utf8_decode_as_in_the_library(library):
    c = bpe_tree.codec(PATH)
    rng = random.Random(1)
    for _ in range(300):
        ids = [rng.randrange(50257) for _ in range(rng.randint(0, 12))]
        assert c.decode(np.array(ids, "<u4")) == library.decode(ids, skip_special_tokens=False)


def test_rows_of_leaves_are_joined_over_rounds(spark, library):
    table = [(i, t) for i, t in enumerate(texts(60, 9))] + [
        (60, "x" * 5000), (60, "x" * 5000), (None, "ab" * 3000 + " end"), (61, None), (62, ""), (63, " " * 4000 + "\n\nq"),
        (64, "語" * 2500), (65, ("word " * 40 + "=" * 700) * 5)]
    docs = spark.createDataFrame([(i, t, 0) for i, t in table], "doc_id int, text string, ids int").repartition(4)
    got = bpe_tree.decode(bpe_tree.encode(docs, PATH, long=100, leaf=16), PATH).collect()
    rows = sorted(((r["doc_id"] or -1, r["text"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got))
    want = sorted(((i or -1, t or "", library.encode(t or "", add_special_tokens=False).ids) for i, t in table))
    assert rows == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe_tree.decode(bpe_tree.encode(docs, PATH), PATH).collect() == []


def test_query_equals_the_library(spark, library):
    want = {}
    for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect():
        ids = library.encode(r["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        want[r["doc_id"]] = (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                             hashlib.sha256(text.encode()).hexdigest())
    got = {r["doc_id"]: tuple(r)[1:] for r in QUERIES["op12_bpe_tree"](spark, SF_SMALL).collect()}
    assert got == want
