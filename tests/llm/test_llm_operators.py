"""The corpus operators against brute force, and their defined cases: nulls,
empty and long texts, ties, repeated rows, empty tables, extra columns."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskgraph.llm import (
    ann_vptree,
    chat_tree,
    html_lbd,
    lm_backoff,
    minhash_bottomk,
    mixing,
    packing,
    topk_balltree,
    toxicity_ws,
    url_filter,
)

DOCS = "doc_id long, text string, lang string, source string, n_chars long, sig string, key int, comp int"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def documents(spark, rows):
    """Rows (doc_id, text, source), with extra columns whose names clash."""
    return spark.createDataFrame([(i, t, "en", s, len(t or ""), "x", 1, 2) for i, t, s in rows], DOCS)


def rng_text(rng, n, vocab=400):
    return " ".join(f"w{int(x)}" for x in rng.integers(0, vocab, n))


@pytest.fixture(scope="module")
def corpus():
    """Distinct, near-equal, equal, null, empty, one-word and long texts; repeated ids and a null id."""
    rng = np.random.default_rng(3)
    rows = [(i, rng_text(rng, int(rng.integers(30, 200))), f"s{i % 4}") for i in range(60)]
    base = rng_text(rng, 120).split()
    for i in range(60, 90):                 # near copies of one text, at different distances
        t = list(base)
        for p in rng.integers(0, len(t), int(rng.integers(0, 14))):
            t[p] = f"e{int(rng.integers(0, 9999))}"
        rows.append((i, " ".join(t), "s0"))
    rows += [(100 + i, " ".join(base), "hot") for i in range(40)]
    rows += [(200, None, None), (201, "", "s1"), (202, "One", "s1"), (203, "ONE", "s2"), (204, "a b", "s2"),
             (205, "\t a\nb ", None), (206, rng_text(rng, 20000, 5000), "s3"), (100, " ".join(base), "hot"),
             (5, rng_text(rng, 50), "s1"), (None, rng_text(rng, 40), "s1")]
    return rows


# ---- near duplicates -------------------------------------------------
def brute_components(rows, words):
    sets = []
    for _, t, _ in rows:
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in WORD.findall(t or "")]
        sets.append({tuple(w[i:i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else ({tuple(w)} if w else set()))
    comp = list(range(len(rows)))

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            inter = len(a & b)
            if inter and 100 * inter >= 80 * (len(a) + len(b) - inter):
                comp[root(i)] = root(j)
    least = defaultdict(list)
    for i, r in enumerate(rows):
        if r[0] is not None:
            least[root(i)].append(r[0])
    return [(r[0], len(sets[i]), min(least[root(i)], default=None)) for i, r in enumerate(rows)]


@pytest.mark.parametrize("words", [2, 5])
def test_near_duplicates_equal_brute_force(spark, corpus, words, monkeypatch):
    monkeypatch.setattr(minhash_bottomk, "SHORT", 5)       # take the way of the long lists too
    monkeypatch.setattr(minhash_bottomk, "BLOCK", 3)
    got = minhash_bottomk.near_duplicates(documents(spark, corpus), words=words).collect()
    key = lambda r: tuple((x is None, x) for x in r)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got), key=key) == sorted(
        brute_components(corpus, words), key=key)
    assert all(r["kept"] == (r["doc_id"] == r["component_id"] or r["component_id"] is None) for r in got)


def test_one_document_of_each_group_stays(spark, corpus):
    docs = documents(spark, corpus)
    kept = minhash_bottomk.drop_duplicates(docs, words=2)
    assert kept.columns == docs.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    want = {c for i, n, c in brute_components(corpus, 2) if n and c is not None} | {200, 201, None}
    assert set(ids) == want and ids[100] <= 1


def test_near_duplicates_of_an_empty_table(spark):
    assert minhash_bottomk.near_duplicates(documents(spark, [])).count() == 0
    assert minhash_bottomk.drop_duplicates(documents(spark, [])).count() == 0


# ---- mixing ----------------------------------------------------------
def test_mix_meets_targets_and_reruns_agree(spark, corpus):
    docs = documents(spark, corpus)
    rows = mixing.plan_mix(docs).collect()
    assert len(rows) == len(corpus)
    per = defaultdict(lambda: [0, 0, 0.0])
    for r in rows:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["size"] >= 0
        p = per[r["source"]]
        p[0] += r["size"]
        p[1] += r["taken"]
        p[2] = r["target"]
        assert r["source_size"] >= r["size"]
    total = sum(p[0] for p in per.values())
    weights = {s: i % 3 + 1 for i, s in enumerate(sorted((x for x in per if x is not None)) + [None])}
    clamped = set()
    while True:
        left = total - sum(3 * per[s][0] for s in clamped)
        w = sum(weights[s] for s in per if s not in clamped)
        more = {s for s in per if s not in clamped and weights[s] * left > 3 * per[s][0] * w}
        if not more:
            break
        clamped |= more
    for s, (size, taken, target) in per.items():
        want = 3 * size if s in clamped else weights[s] * left / w
        assert target == pytest.approx(want) and abs(taken - target) < 1
    key = lambda r: (str(r["doc_id"]), r["size"], r["taken"])
    assert sorted(map(key, rows)) == sorted(map(key, mixing.plan_mix(docs.repartition(7)).collect()))
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns
    words = Counter()
    for r in mixed.collect():
        words[r["source"]] += len(WORD.findall(r["text"] or ""))
    assert all(abs(words[s] - taken) <= 1 for s, (_, taken, _) in per.items() if s != "hot")


def test_mix_of_empty_tables_and_texts(spark):
    assert mixing.plan_mix(documents(spark, [])).count() == 0
    assert mixing.mix(documents(spark, [])).count() == 0
    rows = mixing.plan_mix(documents(spark, [(1, None, "a"), (2, " ", "b")])).collect()
    assert [(r["size"], r["taken"], r["target"]) for r in rows] == [(0, 0, 0.0)] * 2


# ---- packing ---------------------------------------------------------
def test_packing_holds_each_id_once_with_little_padding(spark, corpus):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    odd = [(300, "naïve Straße ΑΣ 中文 e\u0301 \u00a0x it's <|endoftext|> 'S", "s"), (301, "\x1f a\x85b", "s")]
    rows = [r for r in corpus if r[0] is not None and r[0] not in (5, 100)] + odd
    pieces = packing.pack(documents(spark, rows).repartition(3)).collect()
    ids = {i: [*t.encode(x or "", add_special_tokens=False).ids, 2] for i, x, _ in rows}
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_seq[p["sequence_id"]].append(p)
        part = ids[p["doc_id"]][p["start"]:p["start"] + p["length"]]
        assert p["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes()) and p["doc_tokens"] == len(ids[p["doc_id"]])
    for i, own in by_doc.items():
        at = 0
        for p in sorted(own, key=lambda p: p["start"]):
            assert p["start"] == at and p["length"] > 0
            at += p["length"]
        assert at == len(ids[i])
    assert set(by_doc) == set(ids)
    for own in by_seq.values():
        at = 0
        for p in sorted(own, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= 4096
    total = sum(map(len, ids.values()))
    assert len(by_seq) == -(-total // 4096)         # one window at most is not full
    assert packing.pack(documents(spark, [])).count() == 0


# ---- LM scoring ------------------------------------------------------
def brute_lm(texts, alpha=0.4):
    words = [[w.translate({c: c + 32 for c in range(65, 91)}) for w in WORD.findall(t or "")] for t in texts]
    uni, bi = Counter(w for d in words for w in d), Counter(p for d in words for p in zip(d, d[1:], strict=False))
    n = sum(uni.values())
    for d in words:
        u, b = Counter(d), Counter(zip(d, d[1:], strict=False))
        total = 0.0
        for i, w in enumerate(d):
            pair = (d[i - 1], w) if i else None
            if pair and bi[pair] - b[pair]:
                total += math.log((bi[pair] - b[pair]) / (uni[d[i - 1]] - u[d[i - 1]]))
            else:
                total += math.log(max(uni[w] - u[w], 1) / max(n - len(d), 1)) + (math.log(alpha) if i else 0.0)
        yield len(d), total


@pytest.mark.parametrize("files", [1, 3])
def test_lm_scores_equal_brute_force(spark, corpus, files):
    docs = documents(spark, [(i, r[1], r[2]) for i, r in enumerate(corpus)]).repartition(files)
    got = {r["doc_id"]: r for r in lm_backoff.lm_scores(docs, written=False).collect()}
    for i, (n, total) in enumerate(brute_lm([r[1] for r in corpus])):
        assert got[i]["n_words"] == n and got[i]["log_prob"] == pytest.approx(total, abs=1e-6)
        assert (got[i]["mean_log_prob"] is None) == (n == 0)
    assert lm_backoff.lm_scores(documents(spark, []), written=False).count() == 0


# ---- vectors ---------------------------------------------------------
@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(5)
    v = rng.normal(size=(900, 12)).astype(np.float32) / 4
    v[300:600] = v[300]                     # a hot vector
    rows = [(int(i), [float(x) for x in v[i]], 1, 7) for i in range(900)]
    bad = [(20000, None), (20100, []), (20200, [0.0] * 12), (20300, [float("nan")] * 12), (20400, [None] * 12),
           (20500, [float("inf")] * 12), (20600, [1.0, 2.0]), (None, [1.0] * 12)]
    return rows + [(i, x, 2, 7) for i, x in bad] + [rows[0]]


def embeddings(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, block int")


def brute_top(rows, k, every, turn):
    clean = [(i, turn(np.array(x, np.float32).astype(float))) for i, x, *_ in rows
             if i is not None and x and all(y is not None and np.isfinite(y) for y in x)]
    want = {}
    for q, x in clean:
        if q % every == 0:
            scores = [(-float((x * y).sum()), i) for i, y in clean if i != q and len(x) == len(y)]
            want[q] = sorted(scores)[:k]
    return want


def test_balltree_is_exact(spark, vectors):
    got = defaultdict(list)
    for r in topk_balltree.topk(embeddings(spark, vectors), k=10, every=100, shard_rows=200, block_rows=4, leaf=16).collect():
        got[r["query_id"]].append((r["rank"], -r["score"], r["vec_id"]))
    want = brute_top(vectors, 10, 100, lambda x: np.floor(1024 * x))
    want = {q: [(n, s, i) for n, (s, i) in enumerate(w, 1)] for q, w in want.items() if w}
    assert {q: sorted(r) for q, r in got.items()} == want
    assert topk_balltree.topk(embeddings(spark, [])).count() == 0


@pytest.mark.parametrize("factor", [1.0, ann_vptree.FACTOR])
def test_vptree_finds_the_nearest(spark, vectors, factor):
    got = defaultdict(list)
    for r in ann_vptree.nearest(embeddings(spark, vectors), factor=factor, shard_rows=200, block_rows=16, leaf=16).collect():
        got[r["query_id"]].append((r["rank"], -r["score"], r["vec_id"]))
    want = {q: w for q, w in brute_top([v for v in vectors if v[0] != 20200], 20, 20, lambda x: x).items() if w}
    assert set(got) == set(want)
    hits = 0
    for q, w in want.items():
        mine = sorted(got[q])
        assert [n for n, _, _ in mine] == list(range(1, len(w) + 1))
        hits += len({i for _, _, i in mine} & {i for _, i in w})
        if factor == 1.0:
            assert [s for _, s, _ in mine] == pytest.approx([s for s, _ in w], abs=1e-12)
    assert hits >= 0.9 * sum(map(len, want.values()))
    assert ann_vptree.nearest(embeddings(spark, [])).count() == 0


# ---- URLs ------------------------------------------------------------
def test_url_rules(spark):
    cases = {
        "http://A.Example.ORG/es/x": ("a.example.org", "/es/x", "example.org/es/", "block"),
        "https://example.org/en/17?q#f": ("example.org", "/en/17", "example.org/en/1", "block"),
        "https://example.org/en/7": ("example.org", "/en/7", "org/", "allow"),
        "x://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://org": ("org", "", None, "allow"),
        "http://a.com/de/": ("a.com", "/de/", "com/de/", "block"),
        "http://a.com/DE/": ("a.com", "/DE/", None, "allow"),
        "http://telecom/de/": ("telecom", "/de/", None, "allow"),
        "http://x.net/ads/1": ("x.net", "/ads/1", None, "block"),
        "http://x.net/ads/policy/": ("x.net", "/ads/policy/", None, "allow"),
        "http://x.net/roads/1": ("x.net", "/roads/1", None, "allow"),
        "no scheme/ads/": ("", "", None, "block"), "": ("", "", None, "allow"), None: ("", "", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
    }
    rows = [(i, u, "h", "r") for i, u in enumerate([*cases, "http://org"])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, rule string")
    got = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in url_filter.judge(pages).collect()}
    assert got == dict(enumerate([*cases.values(), cases["http://org"]]))
    assert url_filter.judge(pages.limit(0)).count() == 0


# ---- HTML ------------------------------------------------------------
LONG = "Lorem ipsum dolor sit amet consectetur adipiscing elit sed do eiusmod tempor incididunt ut labore et dolore."


@pytest.mark.parametrize("page, want", [
    (None, ""), ("", ""), ("<p>a &lt;b&gt;&nbsp; c</p>", "a <b> c"), ("plain", "plain"), ("<script>var a='<p>x</p>'", ""),
    (f"<article><header><h1>T</h1></header><p>{LONG}<p>x<br>y<div class=ad>no</div><footer>f</footer></article><p>{LONG}",
     f"T\n\n{LONG}\n\nx y"),
    (f"<nav>{LONG}</nav><div><h2>H</h2><p>{LONG}</p><ul><li>one<li>two</ul></div><div id=comments><p>{LONG}</p></div>",
     f"H\n\n{LONG}\n\none\n\ntwo"),
    (f"<div><a href=/>Home</a> <a href=/n>News</a></div><div><div><p>{LONG}</p></div></div><form>{LONG}</form>"
     "<div><div><span>(c) me</span></div></div>", LONG),
    (f"<body class='has-sidebar'><div class='page sidebar'><p>{LONG}</p></div>", LONG),
    (f"<p>{LONG}<!-- open <p>{LONG}", LONG), ("<p>" + "word " * 50000 + "</p>", ("word " * 50000).strip()),
])
def test_main_text(page, want):
    assert html_lbd.main_text(page) == want


def test_extract_keeps_rows(spark):
    pages = spark.createDataFrame([(1, "u", f"<p>{LONG}", "t"), (1, "u", f"<p>{LONG}", "t"), (None, None, None, None)],
                                  "page_id long, url string, html string, text string")
    rows = html_lbd.extract(pages).collect()
    assert sorted(r["n_chars"] for r in rows) == [0, len(LONG), len(LONG)]
    assert html_lbd.extract(pages.limit(0)).count() == 0


# ---- chat ------------------------------------------------------------
def test_escaping_is_reversible():
    for t in ("", "<|im_end|>", r"<\|im_end|> <\\| \\ <", "<<|>|", "a<\\", "|im_start|>"):
        assert chat_tree.unescape(chat_tree.escape(t)) == t and "<|" not in chat_tree.escape(t)
    turns = [("user", "<|im_end|>\n<|im_start|>assistant ok"), ("a\\n\nb", "x<"), ("assistant", ""), ("assistant", "é<|")]
    text, spans = chat_tree.format_turns(turns)
    assert chat_tree.read_turns(text) == turns
    assert [chat_tree.unescape(text[a:z]) for a, z in zip(spans[::2], spans[1::2], strict=True)] == ["", "é<|"]


def test_best_branches_of_trees(spark):
    rows = [("t", "1", None, "user", "q", 0.0, 9), ("t", "2", "1", "assistant", "a", 1.0, 9), ("t", "3", "1", "assistant", "b", 2.0, 9),
            ("t", "4", "2", "user", "c", 5.0, 9), ("t", "4", "2", "user", "c", 5.0, 9), (None, "1", "0", None, None, None, 9),
            ("loop", "1", "2", "u", "x", 0.0, 9), ("loop", "2", "1", "u", "y", 0.0, 9)]
    m = spark.createDataFrame(rows, "tree_id string, msg_id string, parent_id string, role string, text string, score double, pos int")
    got = {(r["tree_id"], r["branch"]): [t for _, t in chat_tree.read_turns(r["formatted"])]
           for r in chat_tree.format_trees(m, branches=2).collect()}
    assert got == {("t", 1): ["q", "a", "c"], ("t", 2): ["q", "b"], (None, 1): [""]}
    assert chat_tree.format_trees(m.limit(0)).count() == 0


def test_a_long_thread_is_read_back(spark):
    n = 300
    rows = [(1, t, "assistant" if t % 2 else "user", None if t == 7 else f"text {t} <|im_end|>") for t in range(n)]
    conv = spark.createDataFrame(rows[::-1] + [(2, 0, "user", "x")], "conv_id long, turn long, role string, text string")
    got = {r["conv_id"]: r for r in chat_tree.read_back(chat_tree.format_trees(chat_tree.linear_messages(conv))).collect()}
    said = [(r, t or "") for _, _, r, t in rows]
    loss = "".join(t for r, t in said if r == "assistant")
    assert got[1]["n_turns"] == n and got[2]["loss_chars"] == 0
    assert got[1]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in said).encode()).hexdigest()
    assert got[1]["loss_chars"] == len(loss) and got[1]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()


# ---- toxicity --------------------------------------------------------
def test_toxicity_on_held_out_rows(spark):
    rng = np.random.default_rng(8)
    bad = ["nasty", "vilest", "crudo", "crudest", "crudely"]
    rows, labels = [], []
    for i in range(1200):
        w = rng_text(rng, 60).split()
        toxic = i % 6 == 0
        if toxic:
            for p in rng.integers(0, 60, 2):
                w[p] = bad[int(rng.integers(0, len(bad)))]
        rows.append((i, " ".join(w), "s"))
        labels.append((i, int(toxic), 1))
    rows += [(5000, None, "s"), (None, "", "s"), (5001, "crudish nasty, vilest!", "s")]
    lab = spark.createDataFrame([*labels, (None, 1, 1), (3, None, 1)], "doc_id long, toxic int, quality int")
    docs = documents(spark, rows)
    got = {r["doc_id"]: r for r in toxicity_ws.score_toxicity(docs, lab).collect()}
    assert len(got) == len(rows)
    held = [(r, r["doc_id"] % 6 == 0) for i, r in got.items() if i is not None and i < 1200 and r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items() if i is not None)
    right = sum((r["predicted"] == 1) == y for r, y in held)
    assert len(held) > 200 and right >= 0.97 * len(held)
    assert got[5001]["predicted"] == 1 and got[5000]["predicted"] == 0 and got[None]["predicted"] == 0
    kept = {r["doc_id"] for r in toxicity_ws.drop_toxic(docs, lab).collect()}
    assert kept == {i for i, r in got.items() if r["predicted"] == 0}
    # without labels, and on an empty table
    assert {r["predicted"] for r in toxicity_ws.score_toxicity(docs, lab.limit(0)).collect()} == {0}
    assert toxicity_ws.score_toxicity(docs.limit(0), lab).count() == 0
    # labels of held-out rows are not read
    flipped = lab.withColumn("toxic", F.when(toxicity_ws.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    again = {r["doc_id"]: r["score"] for r in toxicity_ws.score_toxicity(docs, flipped).collect()}
    assert again == {i: r["score"] for i, r in got.items()}


def test_label_model_discounts_correlated_voters():
    rng = np.random.default_rng(1)
    y = rng.random(20000) < 0.2
    fire = np.zeros((20000, toxicity_ws.VOTERS), bool)
    for j in range(4):                      # independent voters
        fire[:, j] = np.where(y, rng.random(20000) < 0.7, rng.random(20000) < 0.05)
    fire[:, 4:8] = fire[:, [3]]             # copies of one of them
    masks, counts = np.unique((fire * (1 << np.arange(toxicity_ws.VOTERS))).sum(1), return_counts=True)
    post, a, b, corr = toxicity_ws.label_model(masks, counts, 0.2)
    assert a[0] == pytest.approx(0.7, abs=0.1) and b[0] == pytest.approx(0.05, abs=0.03)
    assert corr[4, 5] > 0.9 > 0.3 > abs(corr[0, 1])
