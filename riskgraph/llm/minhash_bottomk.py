"""Near-duplicate documents by bottom-k sketches from one hash function.

A document's set holds the hashes of its distinct ``words``-word shingles
(A-Z lower-cased; fewer words: the whole sequence as one; no words: empty, and
linked with nothing). Two documents are linked if their sets' Jaccard
similarity is at least ``percent`` / 100, counted on the full sets.

1. One pass hashes each text and keeps the set's size, an order-free signature
   and its ``k`` smallest hashes (the sketch). Documents of equal sets become
   one node; copies are never paired.
2. Inverted lists: a sketch's neighbouring values, two at a time, are keys. Of
   two sets' union, each of the ``k`` smallest hashes is common with
   probability J, so two sets with J = 0.8 have 30 keys in common on average
   and fewer than ``SHARED`` = 9 with probability 4e-7 (k = 48; less above; sets
   smaller than ``k`` have at least ``(2 J - 1) n - 1`` for certain). A node with fewer
   keys that any other node has is done. The others are listed under all but
   the ``SHARED - 1`` most frequent of them, for two sets with that many common
   keys must share a rarer one. So very common words and passages make no lists.
3. Candidates grow with a list's length, not its square: a list pairs its
   members with one hub, and a member meets the hubs of its longest lists and of all
   its lists of two. Pairs whose overlap on the union's sketch is far below
   the threshold (``MARGIN`` standard deviations) are dropped, the others are
   verified on the full sets, which are taken from the texts again for the
   nodes in question alone.
4. Links give components. In lists of at most ``SHORT`` members that still hold
   several, every member outside the largest component is paired with all
   members of other components. The members of longer lists are listed anew by
   the rarest shingles of their full sets, where the same is done, in blocks of
   full sets: similar sets share one of these for certain, dissimilar ones that a
   common passage had brought together do not. So no link between different components of any list
   is lost, and no pair inside one is tried.

Signatures and shingle hashes have 64 bits (two different sets among 10^10
share a signature with odds of a few); nothing else is approximate but the
odds in step 2.

Defined cases: null text is empty; rows that repeat a doc_id are documents of
their own, named by the same doc_id; a null doc_id takes part as a copy or near
copy, but names no component (``component_id`` is the smallest non-null one;
null, and ``kept`` true, if there is none); an empty table gives an empty result; extra
columns are ignored; texts of any length are hashed whole.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from riskgraph.llm.common import cut_lineage, mix64, releasing, segments, strings, word_hashes
from riskgraph.operators.components import component_map

K = 48
SHARED = 9
SHORT = 50
MARGIN = 6.0
HUBS = 8                # hubs of lists of three or more that a node is paired with at first
BLOCK, BLOCK_GRAMS = 256, 65_536        # members and shingles of a block of full sets, about
FILTER_BITS = 22        # of the fixed-size filter by which texts are taken again

_MUL = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: list[str], words: int) -> Iterator[np.ndarray]:
    """The sorted distinct 64-bit shingle hashes (signed) of each text."""
    h, counts = word_hashes(texts)
    if len(h) >= words:
        rolled = np.zeros(len(h) - words + 1, np.uint64)
        for j in range(words):
            rolled = rolled * _MUL + h[j:len(h) - words + 1 + j]
        rolled = mix64(rolled)
    for a, z in segments(counts):
        n = z - a
        if n >= words:
            yield np.unique(rolled[a:z - words + 1].view(np.int64))
        elif n:
            one = np.uint64(n)
            for x in h[a:z]:
                one = one * _MUL + x
            yield mix64(np.array([one], np.uint64)).view(np.int64)
        else:
            yield np.zeros(0, np.int64)


def signature(s: np.ndarray) -> int:
    total = mix64(s.view(np.uint64) ^ _MUL).sum(dtype=np.uint64)
    return int(mix64(np.array([total + np.uint64(len(s))], np.uint64)).view(np.int64)[0])


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int64()))


def _sketcher(words: int, k: int):
    """Per text: signature, size and sketch."""
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for b in batches:
            for a in range(0, b.num_rows, 1000):
                part = b.slice(a, 1000)
                sets = list(shingle_sets(strings(part.column("text")), words))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text_hash"), pa.array([signature(s) for s in sets], pa.int64()),
                     pa.array([len(s) for s in sets], pa.int64()), _lists([s[:k] for s in sets])],
                    ["doc_id", "text_hash", "sig", "n", "sketch"])
    return run


def _full_sets(words: int):
    """Per ``(sig, text)``: the full set."""
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for b in batches:
            for a in range(0, b.num_rows, 1000):
                part = b.slice(a, 1000)
                yield pa.RecordBatch.from_arrays(
                    [part.column("sig"), _lists(list(shingle_sets(strings(part.column("text")), words)))], ["sig", "grams"])
    return run


def _confirm(words: int, percent: int):
    """The pairs whose texts' full sets are similar enough."""
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore")
        for b in batches:
            for a in range(0, b.num_rows, 500):
                part = b.slice(a, 500)
                both = zip(*(shingle_sets(strings(part.column(c)), words) for c in ("ta", "tb")), strict=True)
                common = [(len(np.intersect1d(x, y, assume_unique=True)), len(x) + len(y)) for x, y in both]
                yield part.select(["a", "b"]).filter(pa.array([100 * i >= percent * (n - i) for i, n in common], pa.bool_()))
    return run


def _keys(sketch: Column) -> Column:
    """Two neighbours at a time; a single value is its own key."""
    pair = F.transform(F.sequence(F.lit(1), F.size(sketch) - 1),
                       lambda i: F.xxhash64(F.element_at(sketch, i), F.element_at(sketch, i + 1)))
    return F.when(F.size(sketch) == 1, F.transform(sketch, lambda x: F.xxhash64(x))).when(F.size(sketch) > 1, pair)


def _ordered(a: str, b: str) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


class _Linker:
    """Verifies candidate pairs of nodes and gathers the links."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, words: int, k: int, percent: int):
        self.docs, self.nodes, self.words, self.k, self.percent = docs, nodes, words, k, percent
        j = percent / 100
        self.least = max(0.0, j - MARGIN * (j * (1 - j) / k) ** 0.5)
        self.links: DataFrame | None = None

    def texts(self, wanted: DataFrame) -> DataFrame:
        """``(sig, text)`` of the nodes ``wanted(sig)``. A filter of 2^22 bits
        over their texts' hashes (at most 65,536 rows, whatever the data)
        keeps most other texts from the shuffle; the join then is exact."""
        hashes = cut_lineage(self.nodes.join(wanted, "sig", "left_semi").select("text_hash", "sig"))
        at = f"(text_hash & {2 ** FILTER_BITS - 1})"
        word, bit = F.expr(f"shiftright({at}, 6)"), f"cast({at} & 63 as int)"
        bits = hashes.groupBy(word.alias("word")).agg(F.expr(f"bit_or(shiftleft(1L, {bit}))").alias("bits"))
        return cut_lineage(self.docs.withColumn("word", word).join(F.broadcast(bits), "word")
                           .where(F.expr(f"(shiftright(bits, {bit}) & 1L) = 1")).select("text", "text_hash")
                           .join(hashes, "text_hash").groupBy("sig").agg(F.first("text").alias("text")))

    def sets(self, wanted: DataFrame) -> DataFrame:
        """``(sig, grams)``: the full sets of the nodes ``wanted(sig)``."""
        return cut_lineage(self.texts(wanted).mapInArrow(_full_sets(self.words), "sig long, grams array<long>"))

    def verify(self, pairs: DataFrame) -> DataFrame:
        """Links ``(a, b)`` among the candidate ``pairs(a, b, na, nb)``."""
        sized = pairs.where(F.least("na", "nb") * 100 >= F.greatest("na", "nb") * self.percent).select("a", "b").distinct()
        side = lambda c: self.nodes.select(F.col("sig").alias(c), F.col("sketch").alias("s" + c))
        union = F.slice(F.array_sort(F.array_union("sa", "sb")), 1, self.k)
        common = F.size(F.array_intersect(union, F.array_intersect("sa", "sb")))
        near = cut_lineage(cut_lineage(sized).join(side("a"), "a").join(side("b"), "b")
                           .where(common >= F.size(union) * self.least).select("a", "b"))
        if not near.take(1):
            return near
        texts = self.texts(near.select(F.explode(F.array("a", "b")).alias("sig")).distinct())
        text = lambda c: texts.select(F.col("sig").alias(c), F.col("text").alias("t" + c))
        return cut_lineage(near.join(text("b"), "b").join(text("a"), "a").select("a", "b", "ta", "tb")
                           .mapInArrow(_confirm(self.words, self.percent), "a long, b long"))

    def gather(self, found: DataFrame) -> None:
        self.links = found if self.links is None else cut_lineage(self.links.unionByName(found))

    def labels(self) -> DataFrame:
        """``(sig, comp)`` after two rounds of smallest neighbour over the
        links so far. Nodes of one ``comp`` are connected, which is all that
        skipping pairs needs; a component may still have several."""
        both = cut_lineage(self.links.unionByName(self.links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
        one = both.groupBy("a").agg(F.least("a", F.min("b")).alias("comp"))
        return cut_lineage(both.join(one.select(F.col("a").alias("b"), "comp"), "b").groupBy(F.col("a").alias("sig"))
                           .agg(F.min("comp").alias("comp")))

    def components(self) -> DataFrame:
        """``(sig, comp)`` of all nodes with a link: the labels, and connected
        components over what links still cross them."""
        labels = self.labels()
        side = lambda c: labels.select(F.col("sig").alias(c), F.col("comp").alias("c" + c))
        cross = cut_lineage(self.links.join(side("a"), "a").join(side("b"), "b").where("ca != cb")
                            .select(F.col("ca").alias("src"), F.col("cb").alias("dst")).distinct())
        if not cross.take(1):
            return labels
        whole = component_map(cross).select(F.col("node").alias("comp"), F.col("comp").alias("whole"))
        return cut_lineage(labels.join(whole, "comp", "left").select("sig", F.coalesce("whole", "comp").alias("comp")))


def _with_comp(members: DataFrame, comps: DataFrame) -> DataFrame:
    """``members`` of the lists that hold more than one component."""
    m = cut_lineage(members.drop("comp").join(comps, "sig", "left").withColumn("comp", F.coalesce("comp", "sig")))
    mixed = cut_lineage(m.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"))
                        .where("lo < hi").select("key"))
    return cut_lineage(m.join(mixed, "key", "left_semi"))


def _largest(members: DataFrame) -> DataFrame:
    """``(key, top)``: each list's largest component."""
    counts = members.groupBy("key", "comp").agg(F.count(F.lit(1)).alias("c"))
    return cut_lineage(counts.groupBy("key").agg(F.max(F.struct("c", "comp")).alias("x")).select("key", F.col("x.comp").alias("top")))


def _star(members: DataFrame) -> DataFrame:
    """Members paired with hubs, the members of smallest hash of their lists:
    each with the hubs of its ``HUBS`` longest lists and of all its lists of two, for
    these are done with that. (What that leaves apart in longer lists is
    found by ``_crossing`` and ``_links_by_rare_shingles``, which lose nothing.)"""
    hubs = cut_lineage(members.groupBy("key").agg(F.min(F.struct("sig", "n")).alias("h"), F.count(F.lit(1)).alias("c"))
                       .select("key", F.col("h.sig").alias("hub"), F.col("h.n").alias("hn"), "c"))
    met = (members.join(hubs, "key").where(F.col("sig") != F.col("hub"))
           .groupBy("sig", "n", "hub", "hn").agg(F.max("c").alias("c")))
    longest = Window.partitionBy("sig").orderBy(F.desc("c"), "hub")             # a sketch's keys at most
    return (met.withColumn("at", F.row_number().over(longest)).where((F.col("at") <= HUBS) | (F.col("c") == 2))
            .select(*_ordered("sig", "hub"), F.col("n").alias("na"), F.col("hn").alias("nb")))


def _crossing(members: DataFrame) -> DataFrame:
    """Members outside their list's largest component, paired with all members
    of other components."""
    few = cut_lineage(members.join(_largest(members), "key").where(F.col("comp") != F.col("top")).select(
        "key", F.col("sig").alias("x"), F.col("n").alias("nx"), F.col("comp").alias("cx"), "top"))
    other = (F.col("comp") != F.col("cx")) & ((F.col("comp") == F.col("top")) | (F.col("comp") < F.col("cx")))
    return (members.join(few, "key").where(other)
            .select(*_ordered("sig", "x"), F.col("n").alias("na"), F.col("nx").alias("nb")))


def _blocked(members: DataFrame, grams: DataFrame, name: str) -> DataFrame:
    """``(g, name_blk, name)``: a group's members with their full sets, some
    ``BLOCK`` members or ``BLOCK_GRAMS`` shingles together, dealt by hash."""
    with_n = members.join(grams.select("sig", F.size("grams").alias("n")), "sig")
    blocks = F.ceil(F.greatest(F.count(F.lit(1)) / BLOCK, F.sum("n") / BLOCK_GRAMS))
    size = cut_lineage(with_n.groupBy("g").agg(blocks.alias("blocks")))
    dealt = cut_lineage(members.join(size, "g").select("g", "sig", "comp", F.pmod(F.xxhash64("sig"), "blocks").alias("blk")))
    return cut_lineage(dealt.join(grams.withColumn("n", F.size("grams")), "sig").groupBy("g", F.col("blk").alias(f"{name}_blk"))
                       .agg(F.collect_list(F.struct("sig", "comp", "n", "grams")).alias(name)))


def _link_blocks(percent: int):
    """The links between two blocks' members of different components."""
    @releasing
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(b.num_rows):
                x, y = (_members(b.column(c)[at].values) for c in ("x", "y"))
                g, found = b.column("g")[at].as_py(), ([], [])
                owner, flat = np.repeat(np.arange(len(y["n"])), y["n"]), y["grams"]
                ends = np.cumsum(x["n"])
                for i in range(len(x["n"])):
                    mine = x["grams"][ends[i] - x["n"][i]:ends[i]]
                    place = np.minimum(np.searchsorted(mine, flat), len(mine) - 1)
                    inter = np.bincount(owner[mine[place] == flat], minlength=len(y["n"]))
                    link = (100 * inter >= percent * (y["n"] + x["n"][i] - inter)) & (y["comp"] != x["comp"][i]) & \
                        ((y["comp"] == g) | (y["comp"] < x["comp"][i]))
                    found[0].extend([int(x["sig"][i])] * int(link.sum()))
                    found[1].extend(y["sig"][link].tolist())
                a, z = (np.array(v, np.int64) for v in found)
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, z)), pa.array(np.maximum(a, z))], ["a", "b"])
    return run


def _members(block: pa.StructArray) -> dict[str, np.ndarray]:
    out = {f: block.field(f).to_numpy(zero_copy_only=False) for f in ("sig", "comp", "n")}
    return {**out, "grams": block.field("grams").flatten().to_numpy(zero_copy_only=False)}


def _links_by_rare_shingles(grams: DataFrame, comps: DataFrame, percent: int) -> DataFrame:
    """Links ``(a, b)`` between components among full sets ``grams(sig,
    grams)``. A set of n is listed under its n - ceil(J n) + 1 rarest shingles
    (rarest among these sets); similar sets share one of them for certain. Lists
    that still hold several components are gathered by their largest one; in such
    a group, every member outside of it is compared with all members of other
    components, block by block, on the full sets. A set travels once a block pair,
    not once a list, and links alone leave the comparison."""
    sized = grams.withColumn("n", F.size("grams"))
    each = sized.select("sig", "n", F.explode("grams").alias("key"))
    shared = cut_lineage(each.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    spare = F.expr(f"size(of) - cast(ceil(n * {percent} / 100) as int) + 1")
    listed = cut_lineage(
        each.join(shared, "key").groupBy("sig", "n").agg(F.collect_list(F.struct("c", "key")).alias("of"))
        .withColumn("spare", spare).where("spare > 0")
        .select("sig", "n", F.slice(F.array_sort("of"), F.lit(1), F.col("spare"))["key"].alias("keys")))
    rare = _with_comp(listed.select("sig", F.explode("keys").alias("key")), comps)
    group = cut_lineage(rare.join(_largest(rare), "key").select(F.col("top").alias("g"), "sig", "comp").distinct())
    x, y = _blocked(group.where("comp != g"), grams, "x"), _blocked(group, grams, "y")
    pairs = x.select("g", "x_blk").join(y.select("g", "y_blk"), "g")
    both = pairs.join(x, ["g", "x_blk"]).join(y, ["g", "y_blk"]).select("g", "x", "y")
    return cut_lineage(both.mapInArrow(_link_blocks(percent), "a long, b long"))


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, k: int = K) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept, text_hash, group_id)`` for
    every row: ``component_id`` is the smallest doc_id reachable, ``kept``
    whether it is the row's own, ``text_hash`` Spark's xxhash64 of the text,
    ``group_id`` one value per component."""
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = cut_lineage(docs.mapInArrow(_sketcher(words, k),
                                       f"doc_id {kind}, text_hash long, sig long, n long, sketch array<long>"))
    nodes = cut_lineage(rows.where("n > 0").groupBy("sig").agg(
        F.min("doc_id").alias("doc_id"), F.min("text_hash").alias("text_hash"), F.first("n").alias("n"),
        F.first("sketch").alias("sketch")))
    keyed = nodes.select("sig", "n", F.explode(_keys(F.col("sketch"))).alias("key"))
    shared = cut_lineage(keyed.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 1"))
    need = F.when(F.col("n") >= k, SHARED).otherwise(
        F.greatest(F.lit(1), F.least(F.lit(SHARED), F.floor((F.col("n") * (2 * percent - 100) - 100) / 100)))).cast("int")
    rarest = (keyed.join(shared, "key").groupBy("sig", "n").agg(F.collect_list(F.struct("c", "key")).alias("of"))
              .withColumn("spare", F.size("of") - need + 1).where("spare > 0"))       # k - 1 keys at most
    members = cut_lineage(rarest.select("sig", "n", F.explode(F.slice(F.array_sort("of"), F.lit(1), F.col("spare"))).alias("x"))
                          .select("sig", "n", "x.key").withColumn("comp", F.col("sig")))
    linker = _Linker(docs, nodes, words, k, percent)
    linker.gather(linker.verify(_star(members)))
    comps = linker.labels()
    length = cut_lineage(members.groupBy("key").agg(F.count(F.lit(1)).alias("c")).where("c > 2"))
    members = _with_comp(members.join(length, "key"), comps)          # a list of two is done
    long = members.where(F.col("c") > SHORT)
    if long.take(1):
        grams = linker.sets(long.select("sig").distinct())
        linker.gather(_links_by_rare_shingles(grams, comps, percent))
    linker.gather(linker.verify(_crossing(members.where(F.col("c") <= SHORT))))
    comps = linker.components()
    named = nodes.select("sig", "doc_id").join(comps, "sig", "left").withColumn("comp", F.coalesce("comp", "sig"))
    named = cut_lineage(named)
    least = cut_lineage(named.groupBy("comp").agg(F.min("doc_id").alias("component_id")))
    group = cut_lineage(named.select("sig", "comp").join(least, "comp"))
    out = rows.select("doc_id", "n", "text_hash", "sig").join(group, "sig", "left")
    empty = F.col("n") == 0
    out = out.withColumn("component_id", F.when(empty, F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", F.col("n").alias("n_shingles"), "component_id",
                      F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"),
                      "text_hash", F.when(~empty, F.col("comp")).alias("group_id"))


def drop_duplicates(docs: DataFrame, **kw) -> DataFrame:
    """``docs`` with one row of each component (and all rows without words).
    Rows of equal doc_id and text are one document; only where such rows
    exist, one of them is picked."""
    found = near_duplicates(docs, **kw)
    stays = cut_lineage(found.where("kept").groupBy("doc_id", "text_hash", "group_id")
                        .agg(F.count(F.lit(1)).alias("rows")))
    stays = cut_lineage(stays.where("group_id is null").select("doc_id", "text_hash", "rows", F.lit(False).alias("pick"))
                        .unionByName(stays.where("group_id is not null").groupBy("group_id")
                                     .agg(F.min(F.struct("doc_id", "text_hash", "rows")).alias("x"))
                                     .select("x.*", (F.col("x.rows") > 1).alias("pick"))))
    s = stays.select(F.col("doc_id").alias("__d"), F.col("text_hash").alias("__t"), F.col("pick").alias("__p"))
    j = docs.join(s, F.col("doc_id").eqNullSafe(F.col("__d"))
                  & (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("__t")))
    if not stays.where("pick").take(1):
        return j.select(*docs.columns)
    one = j.where("__p").groupBy("__d", "__t").agg(F.min(F.struct(*docs.columns)).alias("x")).select("x.*")
    return j.where("not __p").select(*docs.columns).unionByName(one)
