"""N-gram Jaccard join: adaptive multi-match prefixes.

A document is the set of its distinct word shingles. Sets are ordered by a global order, rare
shingles first. Two sets with Jaccard similarity of at least t share ``l`` shingles of their prefixes of
``n - ceil(t n) + l`` shingles, for every ``l``. Each document chooses its ``l`` by estimated cost:
a longer prefix means more postings to read, but a pair must then share ``l`` of them before it is
verified. A pair counts what both prefixes hold at the smaller ``l`` of the two.

Steps, each a written table:

1. a sketch of shingle frequencies of fixed size, which only sets the order and the costs;
2. prefixes per document; equal sets become one node;
3. postings whose shingle occurs in two nodes or more;
4. a round in which every node is verified against one pivot, so that groups of near copies
   become components by as many pairs as they have members;
5. nodes that meet a common anchor keep how they differ from it. Two similar sets whose differences
   have nothing in common are both similar to the anchor, so they are in its component already.
   All other similar sets with this anchor share at least a known part of their differences, and a
   prefix join over these short sets finds them, first with one pivot a list, then between what is
   left apart: near copies that are just not similar enough are not compared one by one;
6. all remaining pairs between different components and anchors, verified. A posting list that lies
   within one component or anchor makes no pair; in the others, members of the list's largest class
   meet only the rest. Pairs inside a component can't change the result.

No pair of different components that may be similar is skipped, so components are exact. Texts
without words, also null and empty ones, have no shingles and are linked with nothing. Repeated rows
fall together; rows with a null ``doc_id`` take part but don't count for the smallest id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echolot.llm.common import BATCH_CONF, discard, staged
from echolot.llm.components import components
from echolot.session import settings

SHINGLE = 3
PERCENT = 90
SKETCH_BITS = 22
SKETCH_BLOCK = 65536
MAX_LEVEL = 24
VERIFY_COST = 8.0
ANCHOR_LEAST = 16  # smaller groups are cheaper pair by pair
ANCHOR_SPAN = 4  # differences that are kept, in multiples of what similar sets may differ by
ANCHOR_TOKENS = 512
FILTER_BLOCKS = 256
FILTER_BITS = 32768
MARKS = ("m0", "m1", "m2", "m3")
MEMO = 500_000
SET_BYTES = 32_000_000
BASE = 0x9E3779B97F4A7C15


class Shingler:
    """Sorted distinct shingle hashes of a text, by array operations.

    A word's hash comes from running sums of byte values times powers of an odd base.
    """

    def __init__(self, width: int) -> None:
        self.width = width
        self.values = mixed(np.arange(1, 257, dtype=np.uint64))
        self.powers = self.backward = np.empty(0, np.uint64)
        self.blank = np.zeros(256, np.int8)
        self.blank[[32, *range(9, 14)]] = 1

    def __call__(self, text: str | None) -> np.ndarray:
        data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), np.uint8)
        edges = np.flatnonzero(np.diff(self.blank[data], prepend=1, append=1))
        start, end = edges[::2], edges[1::2]
        if not len(start):
            return np.empty(0, np.uint64)
        if len(data) > len(self.powers):
            self.powers, self.backward = (
                np.multiply.accumulate(np.append(np.uint64(1), np.full(2 * len(data), b, np.uint64)))
                for b in (BASE, pow(BASE, -1, 2**64))
            )
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.values[data] * self.powers[: len(data)], out=sums[1:])
        h = mixed((sums[end] - sums[start]) * self.backward[start])
        n = max(1, len(h) - self.width + 1)
        out = np.zeros(n, np.uint64)
        for k in range(min(self.width, len(h))):
            out = mixed(out + h[k : k + n])
        return np.unique(out)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(BASE)
    return (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)


def _slots(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def sketch(docs: DataFrame, width: int) -> np.ndarray:
    """Counts of shingles by hash slot over all documents: ``2 ** SKETCH_BITS`` numbers of 4 bytes."""

    def blocks(total: np.ndarray) -> pd.DataFrame:
        parts = [zstandard.compress(b.tobytes(), 1) for b in total.reshape(-1, SKETCH_BLOCK)]
        return pd.DataFrame({"block": range(len(parts)), "counts": parts})

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, total = Shingler(width), np.zeros(2**SKETCH_BITS, np.uint32)
        for batch in batches:
            for text in batch["text"]:
                np.add.at(total, _slots(shingles(text)), 1)
        yield blocks(total)

    def add(key: tuple, parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(SKETCH_BLOCK, np.int64)
        for part in parts:
            for counts in part["counts"]:
                total += np.frombuffer(zstandard.decompress(counts), np.uint32)
        total = np.minimum(total, 2**32 - 1).astype(np.uint32)
        yield pd.DataFrame({"block": [key[0]], "counts": [total.tobytes()]})

    schema = "block int, counts binary"
    rows = docs.select("text").mapInPandas(count, schema).groupBy("block").applyInPandas(add, schema)
    total = np.zeros(2**SKETCH_BITS, np.uint32)
    with settings(docs.sparkSession, BATCH_CONF):
        blocks_of_all = rows.collect()  # 2 ** SKETCH_BITS / SKETCH_BLOCK rows of fixed size
    for row in blocks_of_all:
        at = row["block"] * SKETCH_BLOCK
        total[at : at + SKETCH_BLOCK] = np.frombuffer(row["counts"], np.uint32)
    return total


def least_overlap(n: int, percent: int) -> int:
    """Shingles that a set of n shares with any set that is similar to it."""
    return -(-percent * n // 100)


def choose_level(cost: np.ndarray, n: int, percent: int) -> int:
    """The number of prefix shingles that a pair must share, by estimated cost.

    ``cost`` has the estimated list lengths in prefix order. All postings are read; at most
    ``sum / level`` documents can occur ``level`` times in them and are verified.
    """
    base, best, level = n - least_overlap(n, percent), None, 1
    for k in range(1, min(MAX_LEVEL, least_overlap(n, percent)) + 1):
        reads = float(cost[: base + k].sum())
        total = reads + VERIFY_COST * reads / k
        if best is None or total < best:
            best, level = total, k
    return level


def prefixes(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, text_hash, signature, n, level, prefix) of each row; prefix in the global order."""
    spark = docs.sparkSession
    counts = spark.sparkContext.broadcast(sketch(docs, width))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, total = Shingler(width), counts.value
        noise = total.mean()
        for batch in batches:
            out = []
            for text in batch["text"]:
                h = shingles(text)
                n = len(h)
                if not n:
                    out.append((None, 0, 0, []))
                    continue
                f = total[_slots(h)].astype(np.int64)
                keep = min(n, n - least_overlap(n, percent) + MAX_LEVEL)
                order = np.lexsort((h, f))[:keep]
                level = choose_level(np.maximum(f[order] - noise, 1.0), n, percent)
                used = order[: n - least_overlap(n, percent) + level]
                out.append(
                    (hashlib.md5(h.tobytes()).digest(), n, level, h[used].astype(np.int64))
                )
            sig, n, level, prefix = zip(*out, strict=True) if out else ((), (), (), ())
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "text_hash": batch["text_hash"],
                    "signature": list(sig), "n": n, "level": level, "prefix": list(prefix),
                }
            )

    # ids travel as text, since pandas turns integers with nulls into floats
    rows = docs.select(F.col("doc_id").cast("string"), F.xxhash64("text").alias("text_hash"), "text").mapInPandas(
        run, "doc_id string, text_hash long, signature binary, n long, level int, prefix array<long>"
    )
    return rows.withColumn("doc_id", F.col("doc_id").cast("long"))


def _bit(column: str) -> tuple:
    """Block and bit of a hash in the filter of fixed size."""
    slot = F.pmod(F.col(column), F.lit(FILTER_BLOCKS * FILTER_BITS))
    return F.floor(slot / FILTER_BITS), slot % FILTER_BITS


def texts_of(docs: DataFrame, nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """(node, signature, packed) for both ends of the pairs (a, b): a text of the node, compressed, which moves
    at a third of what its shingles take. A written table.

    A bitmap of fixed size tells which texts may be wanted; it saves work and decides nothing. Texts whose
    hash is that of a wanted one come along; their shingles have another signature.
    """
    ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))
    wanted = staged(nodes.join(ends.distinct(), "node").select("node", "signature", "text_hash"), "wanted")
    block, bit = _bit("text_hash")
    bits = wanted.select(block.alias("block"), bit.alias("bit")).groupBy("block")
    bitmap = bits.agg(F.bitmap_construct_agg("bit").alias("bits"))  # 1 MB at most
    hashed = docs.select(F.xxhash64("text").alias("text_hash"), "text")
    byte = F.conv(F.hex(F.expr("substring(bits, cast(bit div 8 as int) + 1, 1)")), 16, 10).cast("int")
    hits = (
        hashed.withColumn("block", block)
        .withColumn("bit", bit)
        .join(F.broadcast(bitmap), "block")
        .where(byte.bitwiseAND(F.expr("shiftleft(1, cast(bit % 8 as int))")) != 0)
        .select("text_hash", "text")
    )

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = set()
        for batch in batches:
            rows = []
            for key, text in zip(batch["text_hash"], batch["text"], strict=True):
                raw = text.encode("utf-8", "surrogatepass")
                own = hashlib.md5(raw).digest()
                if own in seen:
                    continue
                if len(seen) > MEMO:
                    seen.clear()
                seen.add(own)
                rows.append((key, own, zstandard.compress(raw, 3)))
            yield pd.DataFrame(rows, columns=["text_hash", "text_id", "packed"])

    found = hits.mapInPandas(pack, "text_hash long, text_id binary, packed binary")
    one = wanted.join(found, "text_hash").groupBy("text_hash", "text_id", "node", "signature")
    texts = staged(one.agg(F.any_value("packed").alias("packed")).select("node", "signature", "packed"), "texts")
    discard(wanted)
    return texts


class SetMemo:
    """Shingle sets of packed texts; those of the last texts are kept within ``SET_BYTES``."""

    def __init__(self, width: int) -> None:
        self.shingles, self.known, self.held = Shingler(width), {}, 0

    def __call__(self, signature: bytes, packed: bytes) -> np.ndarray | None:
        """The set, or None where it is not the one that the signature names."""
        found = self.known.get(signature)
        if found is None:
            h = self.shingles(zstandard.decompress(packed).decode("utf-8", "surrogatepass"))
            if hashlib.md5(h.tobytes()).digest() != signature:
                return None
            if self.held > SET_BYTES:
                self.known.clear()
                self.held = 0
            self.known[signature] = found = h
            self.held += h.nbytes
        return found


def _both_sets(
    docs: DataFrame, nodes: DataFrame, pairs: DataFrame, width: int, schema: str,
    row_of: Callable[[int, int, np.ndarray, np.ndarray], tuple | None], name: str,
) -> DataFrame:
    """A written table of ``row_of`` each pair and its two sets, without its Nones; ``pairs`` is staged and goes."""
    texts = texts_of(docs, nodes, pairs)
    names = [part.split()[0] for part in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sets = SetMemo(width)
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                own, other = sets(row.signature_a, row.packed_a), sets(row.signature_b, row.packed_b)
                made = None if own is None or other is None else row_of(row.a, row.b, own, other)
                if made is not None:
                    rows.append(made)
            yield pd.DataFrame(rows, columns=names)

    def end(x: str) -> DataFrame:
        return texts.select(F.col("node").alias(x), F.col("signature").alias(f"signature_{x}"), F.col("packed").alias(f"packed_{x}"))

    made = staged(pairs.join(end("a"), "a").join(end("b"), "b").mapInPandas(run, schema), name)
    discard(texts, pairs)
    return made


def verified(docs: DataFrame, nodes: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar, as a written table; ``pairs`` is a staged one that goes."""

    def link(a: int, b: int, own: np.ndarray, other: np.ndarray) -> tuple | None:
        both = len(np.intersect1d(own, other, assume_unique=True))
        return (a, b) if 100 * both >= percent * (len(own) + len(other) - both) else None

    return _both_sets(docs, nodes, pairs, width, "a long, b long", link, "verified")


def similar_sizes(a: str, b: str, percent: int):
    return (100 * F.least(a, b)) >= (percent * F.greatest(a, b))


def labelled_lists(lists: DataFrame, known: DataFrame) -> DataFrame:
    """Postings with the component of their node, without lists that lie in one component; a written table."""
    lists = lists.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lists = staged(lists, "labelled")
    mixed = lists.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    some = staged(lists.join(mixed.where("lo < hi").select("token"), "token"), "open-postings")
    discard(lists)
    return some


def pivot_pairs(lists: DataFrame, percent: int) -> DataFrame:
    """For each node the pivot that it meets in most lists; a list's pivot is its smallest node in
    an order by hash."""
    order = F.struct(F.xxhash64(F.lit(0), "node").alias("o"), "node", "n", "component")
    pivots = lists.groupBy("token").agg(F.min(order).alias("p"))
    met = lists.join(pivots, "token").where(
        (F.col("p.component") != F.col("component")) & similar_sizes("n", "p.n", percent)
    )
    met = met.groupBy("node", F.col("p.node").alias("pivot")).agg(F.count(F.lit(1)).alias("met"))
    best = met.groupBy("node").agg(F.max(F.struct("met", "pivot")).alias("best"))
    return best.select(F.col("node").alias("a"), F.col("best.pivot").alias("b"))


def nearest_anchors(lists: DataFrame, percent: int) -> DataFrame:
    """(a, b): for nodes that meet a pivot of many nodes, the pivot of the most nodes."""
    order = F.struct(F.xxhash64(F.lit("anchor"), "node").alias("o"), "node", "n")
    pivots = lists.groupBy("token").agg(F.min(order).alias("p"))
    met = lists.join(pivots, "token").where(
        (F.col("p.node") != F.col("node")) & similar_sizes("n", "p.n", 2 * percent - 100)
    )
    met = staged(met.select("node", F.col("p.node").alias("pivot")).distinct(), "met")
    popular = met.groupBy("pivot").agg(F.count(F.lit(1)).alias("k")).where(F.col("k") >= ANCHOR_LEAST)
    best = met.join(popular, "pivot").groupBy("node").agg(F.max(F.struct("k", "pivot")).alias("best"))
    anchors = staged(best.select(F.col("node").alias("a"), F.col("best.pivot").alias("b")), "anchors")
    discard(met)
    return anchors


def differences_to(docs: DataFrame, nodes: DataFrame, anchors: DataFrame, width: int, percent: int) -> DataFrame:
    """(node, anchor, n, anchor_n, outside, marks, d): ``d`` holds what only one of the node and its anchor
    has, rare ones first; ``outside`` nodes are not similar to their anchor. The marks are a
    bitmap of ``d``: sets differ by at least as many shingles as their bitmaps by bits.

    Nodes that differ by much from their anchor are left out.
    """

    def difference(a: int, b: int, own: np.ndarray, other: np.ndarray) -> tuple | None:
        added = np.setdiff1d(own, other, assume_unique=True)
        gone = np.setdiff1d(other, own, assume_unique=True)
        size = len(added) + len(gone)
        apart, allowed = (100 + percent) * size, (100 - percent) * (len(own) + len(other))
        if apart > ANCHOR_SPAN * allowed or size > ANCHOR_TOKENS:
            return None
        d = np.concatenate([added, gone])
        marks = np.zeros(256, bool)
        marks[(d >> np.uint64(56)).astype(np.int64)] = True
        return a, b, len(own), len(other), d.astype(np.int64), apart > allowed, *np.packbits(marks).view(np.int64).tolist()

    schema = "node long, anchor long, n int, anchor_n int, d array<long>, outside boolean, " + ", ".join(f"{m} long" for m in MARKS)
    found = _both_sets(docs, nodes, anchors, width, schema, difference, "differences")
    ranked = staged(rare_first(found), "ranked-differences")
    discard(found)
    return ranked


def rare_first(differences: DataFrame) -> DataFrame:
    """``differences`` with each ``d`` in an order that all nodes of an anchor share: by how many of them list
    a shingle, then by the shingle. The prefixes of these sets then meet in short lists."""
    posts = differences.select("node", "anchor", F.explode("d").alias("token"))
    counts = posts.groupBy("anchor", "token").agg(F.count(F.lit(1)).alias("k"))
    ranked = F.array_sort(F.collect_list(F.struct("k", "token")))
    own = posts.join(counts, ["anchor", "token"]).groupBy("node").agg(ranked.getField("token").alias("d"))
    return differences.drop("d").join(own, "node")


def _anchored_postings(differences: DataFrame, known: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """Nodes with their component, and their differences as postings of lists that hold several components.

    Of each node that is similar to its anchor only a prefix is listed: one end of a wanted link is
    outside, which bounds from below how much the other's differences share with it.
    """
    scale, slack = 100 + percent, 100 - percent
    least = F.floor((scale * F.size("d") + slack * (F.col("anchor_n") - F.col("n"))) / (2 * scale)) + 1
    rows = differences.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = staged(rows.withColumn("prefix", F.size("d") - F.greatest(least, F.lit(1)) + 1), "anchored")
    posts = rows.select(
        "anchor", "node", "component", "outside", "prefix", "n", F.size("d").alias("size"), *MARKS,
        F.posexplode("d").alias("at", "token"),
    ).where("outside or at < prefix")
    mixed = posts.groupBy("anchor", "token").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    posts = posts.join(mixed.where("lo < hi").select("anchor", "token"), ["anchor", "token"])
    return rows, staged(posts, "anchored-postings")


def _near_by_difference(rows: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """The similar ones of pairs with a common anchor: sets differ by what only one differs from it in.
    A written table; ``pairs`` is staged and goes."""
    own = rows.select(F.col("node").alias("a"), F.col("n").alias("n_a"), F.col("d").alias("d_a"))
    other = rows.select(F.col("node").alias("b"), F.col("n").alias("n_b"), F.col("d").alias("d_b"))
    apart = F.size("d_a") + F.size("d_b") - 2 * F.size(F.array_intersect("d_a", "d_b"))
    similar = (100 + percent) * apart <= (100 - percent) * (F.col("n_a") + F.col("n_b"))
    links = staged(pairs.join(own, "a").join(other, "b").where(similar).select("a", "b"), "anchored-links")
    discard(pairs)
    return links


def _may_be_near(a: str, b: str, percent: int) -> Column:
    """Whether the bitmaps of two differences permit similar sets."""
    bits = sum((F.bit_count(F.col(f"{a}.{m}").bitwiseXOR(F.col(f"{b}.{m}"))) for m in MARKS), F.lit(0))
    return (100 + percent) * bits <= (100 - percent) * (F.col(f"{a}.n") + F.col(f"{b}.n"))


def anchored_pivot_links(differences: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Links of nodes to the pivots of their lists of differences: at most one pair for each posting.

    Every list draws its own pivot, so a node meets as many others as it has postings.
    """
    rows, posts = _anchored_postings(differences, known, percent)
    order = F.struct(F.xxhash64("token", "node").alias("o"), "node", "component", "n", *MARKS)
    pivots = posts.groupBy("anchor", "token").agg(F.min(order).alias("p"))
    drawn = pivots.select("anchor", "token", "p.*").alias("b")
    on = (F.col("a.anchor") == F.col("b.anchor")) & (F.col("a.token") == F.col("b.token"))
    apart = F.col("a.component") != F.col("b.component")
    met = posts.alias("a").join(drawn, on & apart & _may_be_near("a", "b", percent))
    ends = F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")
    links = _near_by_difference(rows, staged(met.select(*ends).distinct(), "anchored-pivots"), percent)
    discard(rows, posts)
    return links


def anchored_links(differences: DataFrame, known: DataFrame, percent: int) -> DataFrame:
    """Links between different components of nodes that have an anchor in common; a written table."""
    scale, slack = 100 + percent, 100 - percent
    rows, posts = _anchored_postings(differences, known, percent)
    a, b = posts.where("outside").alias("a"), posts.where("at < prefix").alias("b")
    # What two differences can share if the shingles at these places are the first that they share.
    shared = F.least(F.expr("a.size - a.at"), F.expr("b.size - b.at"))
    meets = (
        (F.col("a.anchor") == F.col("b.anchor"))
        & (F.col("a.token") == F.col("b.token"))
        & (F.col("a.component") != F.col("b.component"))
        & (~F.col("b.outside") | ((F.col("a.at") < F.col("a.prefix")) & (F.col("a.node") < F.col("b.node"))))
        & (scale * (F.col("a.size") + F.col("b.size") - 2 * shared) <= slack * (F.col("a.n") + F.col("b.n")))
        & _may_be_near("a", "b", percent)
    )
    pairs = a.join(b, meets).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()
    links = _near_by_difference(rows, staged(pairs, "anchored-pairs"), percent)
    discard(rows, posts)
    return links


def _remaining_pairs(lists: DataFrame, differences: DataFrame, percent: int) -> DataFrame:
    """All pairs of different components and anchors that share enough of their prefixes, each once,
    as a written table.

    Postings carry their place in the prefix instead of the prefix; a pair counts the shingles that both
    prefixes hold up to the length that the smaller of its levels asks for.
    """
    anchor = differences.select("node", (-F.col("anchor") - 1).alias("anchor"))
    classed = lists.join(anchor, "node", "left").withColumn("class", F.coalesce("anchor", "component"))
    classed = staged(classed.drop("anchor"), "classed")
    sizes = classed.groupBy("token", "class").agg(F.count(F.lit(1)).alias("k"))
    largest = sizes.groupBy("token").agg(
        F.max(F.struct("k", "class"))["class"].alias("main"), F.count(F.lit(1)).alias("classes")
    )
    some = staged(classed.join(largest.where("classes > 1").drop("classes"), "token"), "lists")
    a, b = some.where("class != main").alias("a"), some.alias("b")
    need = F.least("a.level", "b.level")
    meets = (
        (F.col("a.token") == F.col("b.token"))
        & (F.col("a.class") != F.col("b.class"))
        & (F.col("a.component") != F.col("b.component"))
        & ((F.col("b.class") == F.col("b.main")) | (F.col("a.node") < F.col("b.node")))
        & similar_sizes("a.n", "b.n", percent)
        & (F.col("a.at") < F.col("a.base") + need)
        & (F.col("b.at") < F.col("b.base") + need)
    )
    ends = F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")
    shared = a.join(b, meets).select(*ends, need.alias("need")).groupBy("a", "b", "need").count()
    pairs = staged(shared.where("count >= need").select("a", "b"), "pairs")
    discard(classed, some)
    return pairs


def grouped(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component, component_id) for each row of ``docs``.

    ``component`` numbers the classes of linked rows and is null for rows without shingles.
    """
    docs = docs.select("doc_id", "text")
    whole = staged(prefixes(docs, width, percent), "prefixes")
    first = whole.where("n > 0").groupBy("signature").agg(
        F.min("doc_id").alias("low"), F.min("text_hash").alias("text_hash"), F.any_value("n").alias("n"),
        F.any_value("level").alias("level"), F.any_value("prefix").alias("prefix"),
    )
    nodes = staged(first.withColumn("node", F.monotonically_increasing_id()), "nodes")
    rows = staged(whole.select("doc_id", "text_hash", "signature", "n"), "rows")
    discard(whole)

    base = F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100)
    postings = nodes.select("node", "n", "level", base.alias("base"), F.posexplode("prefix").alias("at", "token"))
    shared = postings.groupBy("token").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("token")
    lists = staged(postings.join(shared, "token"), "postings")
    narrow = staged(nodes.select("node", "signature", "low", "text_hash"), "node-keys")
    discard(nodes)
    nodes = narrow

    pairs = staged(pivot_pairs(lists.withColumn("component", F.col("node")), percent), "pairs")
    links = verified(docs, nodes, pairs, width, percent)
    known = components(links)

    labelled = labelled_lists(lists, known)
    anchors = nearest_anchors(labelled, percent)
    differences = differences_to(docs, nodes, anchors, width, percent)
    discard(labelled, known)
    near = differences.where("not outside").select(F.col("node").alias("a"), F.col("anchor").alias("b"))
    links = links.unionByName(near)
    known = components(links)
    links = links.unionByName(anchored_pivot_links(differences, known, percent))
    discard(known)
    known = components(links)
    links = links.unionByName(anchored_links(differences, known, percent))

    labelled = labelled_lists(lists, known)
    discard(lists, known)
    pairs = _remaining_pairs(labelled, differences, percent)
    discard(labelled)
    links = links.unionByName(verified(docs, nodes, pairs, width, percent))

    return classes(rows, nodes, links)


def classes(rows: DataFrame, nodes: DataFrame, links: DataFrame) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component, component_id) of rows with a signature, whose sets are
    nodes, from the links of the nodes."""
    known = components(links)
    member = nodes.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    member = member.select("signature", "low", "component")
    lowest = member.groupBy("component").agg(F.min("low").alias("component_id"))
    member = member.join(lowest, "component").select("signature", "component", "component_id")
    return rows.select("doc_id", "text_hash", F.col("n").alias("n_shingles"), "signature").join(
        member, "signature", "left"
    )


def link_documents(docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach; rows link where
    ``100 * intersection >= percent * union``.
    """
    low = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return grouped(docs, width, percent).select("doc_id", "n_shingles", low.alias("component_id"))


def keep_first(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """``docs`` with one row of each class of linked rows: the smallest ``doc_id`` (null last), of
    equal ids one text. Rows without words all stay."""
    last = F.lit(2**63 - 1)
    rows = staged(grouped(docs, width, percent), "classes")
    best = rows.where("n_shingles > 0").groupBy("component").agg(
        F.min(F.struct(F.coalesce("doc_id", last).alias("_id"), F.col("text_hash").alias("_text"))).alias("first")
    )
    keyed = docs.withColumn("_id", F.coalesce("doc_id", last)).withColumn("_text", F.xxhash64("text"))
    kept = keyed.join(best.select("first.*"), ["_id", "_text"], "left_semi").dropDuplicates(["_id", "_text"])
    wordless = F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)) == 0
    return kept.select(docs.columns).unionByName(docs.where(wordless))
