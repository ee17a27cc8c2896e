"""MinHash near-dedup by min-max hashing.

Each permutation of the shingle hashes gives two values of a set, its minimum and its maximum, so
``BANDS * ROWS`` permutations make a signature of twice as many values. Minimum and maximum of two sets
each agree with the probability of their Jaccard similarity J, so half as many permutations are evaluated
for as many values; the estimate from all of them is unbiased.
A band is the two values of ``ROWS`` permutations; sets that agree in a band are candidates. Of pairs
with J = 0.8 the bands miss (1 - 0.8^6)^48, one in two million; of more similar pairs far fewer.

Candidates are confirmed on their full sets, each list of a band by few pairs:

1. every set meets the pivot that it shares most bands with; confirmed pairs make components;
2. sets with a common anchor meet by how they differ from it, which is exact (``ngram_join``);
3. of the lists that still hold several components, the members of different components and anchors.
   The largest class of a list meets only the rest, so a large group of near copies makes no pairs of its own.

Texts without words, also null and empty ones, have no shingles and are linked with nothing. Equal sets
are one node, however many rows have them. Rows with a null ``doc_id`` take part but don't count for the
smallest id; a class without ids has none. Columns besides ``doc_id`` and ``text`` are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolot.llm.common import discard, staged
from echolot.llm.components import components
from echolot.llm.ngram_join import (
    Shingler,
    anchored_links,
    anchored_pivot_links,
    classes,
    differences_to,
    labelled_lists,
    mixed,
    nearest_anchors,
    pivot_pairs,
    similar_sizes,
    verified,
)

SHINGLE = 2
PERCENT = 80
BANDS = 48
ROWS = 3
BLOCK = 8192


class MinMax:
    """Minimum and maximum of a set's hashes under each of ``BANDS * ROWS`` permutations.

    A permutation of the 32-bit numbers is an exclusive or and a product with an odd number.
    """

    def __init__(self, bands: int = BANDS, rows: int = ROWS) -> None:
        self.bands, self.rows = bands, rows
        seeds = mixed(np.arange(1, 2 * bands * rows + 1, dtype=np.uint64))
        self.flips = (seeds[: bands * rows] >> np.uint64(32)).astype(np.uint32)[:, None]
        self.factors = (seeds[bands * rows :] >> np.uint64(32)).astype(np.uint32)[:, None] | np.uint32(1)

    def signature(self, h: np.ndarray) -> np.ndarray:
        """Two rows: minima and maxima."""
        h = (h >> np.uint64(32)).astype(np.uint32)
        low, high = None, None
        for at in range(0, len(h), BLOCK):  # long texts in blocks of bounded size
            v = (h[at : at + BLOCK] ^ self.flips) * self.factors
            a, b = v.min(axis=1), v.max(axis=1)
            low = a if low is None else np.minimum(low, a)
            high = b if high is None else np.maximum(high, b)
        return np.stack([low, high])

    def tokens(self, h: np.ndarray) -> np.ndarray:
        """One 64-bit number for each band."""
        low, high = self.signature(h).astype(np.uint64).reshape(2, self.bands, self.rows)
        token = mixed(np.arange(1, self.bands + 1, dtype=np.uint64))
        for k in range(self.rows):
            token = mixed(token + ((low[:, k] << np.uint64(32)) | high[:, k]))
        return token.astype(np.int64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Unbiased estimate of the Jaccard similarity from two signatures."""
    return float((a == b).mean())


def banded(docs: DataFrame, width: int, bands: int, rows: int) -> DataFrame:
    """(doc_id, text_hash, signature, n, tokens) of each row; ``signature`` tells equal sets."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        shingles, minmax = Shingler(width), MinMax(bands, rows)
        for batch in batches:
            out = []
            for text in batch["text"]:
                h = shingles(text)
                if len(h):
                    out.append((hashlib.md5(h.tobytes()).digest(), len(h), minmax.tokens(h)))
                else:
                    out.append((None, 0, []))
            made = pd.DataFrame(out, columns=["signature", "n", "tokens"], index=batch.index)
            yield pd.concat([batch[["doc_id", "text_hash"]], made], axis=1)

    # ids travel as text, since pandas turns integers with nulls into floats
    found = docs.select(
        F.col("doc_id").cast("string"), F.xxhash64("text").alias("text_hash"), "text"
    ).mapInPandas(run, "doc_id string, text_hash long, signature binary, n long, tokens array<long>")
    return found.withColumn("doc_id", F.col("doc_id").cast("long"))


def _remaining_pairs(lists: DataFrame, differences: DataFrame, percent: int) -> DataFrame:
    """All pairs of one list that belong to different components and anchors, each once; a written table."""
    anchor = differences.select("node", (-F.col("anchor") - 1).alias("anchor"))
    classed = lists.join(anchor, "node", "left").withColumn("class", F.coalesce("anchor", "component"))
    classed = staged(classed.drop("anchor"), "classed")
    sizes = classed.groupBy("token", "class").agg(F.count(F.lit(1)).alias("k"))
    largest = sizes.groupBy("token").agg(
        F.max(F.struct("k", "class"))["class"].alias("main"), F.count(F.lit(1)).alias("classes")
    )
    mixed_lists = staged(classed.join(largest.where("classes > 1").drop("classes"), "token"), "lists")
    a, b = mixed_lists.where("class != main").alias("a"), mixed_lists.alias("b")
    meets = (
        (F.col("a.token") == F.col("b.token"))
        & (F.col("a.class") != F.col("b.class"))
        & (F.col("a.component") != F.col("b.component"))
        & ((F.col("b.class") == F.col("b.main")) | (F.col("a.node") < F.col("b.node")))
        & similar_sizes("a.n", "b.n", percent)
    )
    ends = F.least("a.node", "b.node").alias("a"), F.greatest("a.node", "b.node").alias("b")
    pairs = staged(a.join(b, meets).select(*ends).distinct(), "pairs")
    discard(classed, mixed_lists)
    return pairs


def grouped(
    docs: DataFrame, width: int = SHINGLE, percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS
) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component, component_id) for each row of ``docs``."""
    docs = docs.select("doc_id", "text")
    whole = staged(banded(docs, width, bands, rows), "bands")
    first = whole.where("n > 0").groupBy("signature").agg(
        F.min("doc_id").alias("low"), F.min("text_hash").alias("text_hash"), F.any_value("n").alias("n"),
        F.any_value("tokens").alias("tokens"),
    )
    banded_nodes = staged(first.withColumn("node", F.monotonically_increasing_id()), "banded-nodes")
    members = staged(whole.select("doc_id", "text_hash", "signature", "n"), "rows")
    discard(whole)
    postings = banded_nodes.select(F.explode("tokens").alias("token"), "node", "n")
    shared = postings.groupBy("token").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select("token")
    lists = staged(postings.join(shared, "token"), "postings")
    nodes = staged(banded_nodes.drop("tokens"), "nodes")
    discard(banded_nodes)

    pairs = staged(pivot_pairs(lists.withColumn("component", F.col("node")), percent), "pairs")
    links = verified(docs, nodes, pairs, width, percent)
    known = components(links)

    mixed_lists = labelled_lists(lists, known)
    anchors = nearest_anchors(mixed_lists, percent)
    differences = differences_to(docs, nodes, anchors, width, percent)
    discard(mixed_lists, known)
    near = differences.where("not outside").select(F.col("node").alias("a"), F.col("anchor").alias("b"))
    links = links.unionByName(near)
    known = components(links)
    links = links.unionByName(anchored_pivot_links(differences, known, percent))
    discard(known)
    known = components(links)
    links = links.unionByName(anchored_links(differences, known, percent))

    mixed_lists = labelled_lists(lists, known)
    discard(lists, known)
    pairs = _remaining_pairs(mixed_lists, differences, percent)
    discard(mixed_lists)
    links = links.unionByName(verified(docs, nodes, pairs, width, percent))
    return classes(members, nodes, links)


def dedupe(docs: DataFrame, **options: int) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach; the row with that id is kept, and so are
    all rows without shingles. Options are those of ``grouped``.
    """
    low = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    rows = grouped(docs, **options).select("doc_id", "n_shingles", low.alias("component_id"))
    return rows.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
