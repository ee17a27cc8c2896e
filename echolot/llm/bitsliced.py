"""Exact top-k search: bit-sliced index.

Vectors become integers ``floor(SCALE * x)`` and are indexed in blocks of rows. A block keeps, for each
component, one bitmap per bit ("slice") of the value above the block's minimum. For a query, the
slices of all components are added with bitmap arithmetic: a component with weight w enters once for
each set bit of ``|w|``, complemented if w is negative, and full adders on whole bitmaps make the
slices of the score. The lowest ``bits - KEEP`` bits of a component are left out of the sum, so a
score is known up to a bound. Going from the most significant slice downward gives the k-th largest
of the coarse scores; rows within the bound of it are resolved by exact inner products.

Rows are dealt into groups of a block at most, and all queries of their dimension go to each group. A task holds the
index of one group at a time, built once, and its queries come past it in small batches; each query gets k rows of a
group. Scores are exact: where a sum may exceed 64 bits, the boundary rows are resolved with integers of any size,
and a score among the k best of a block that no 64-bit number holds fails the search. So does a component whose
scaled value none holds. An empty table gives no rows. Vectors that are null or hold null or non-finite components and rows
without id take no part. Vectors of different length are not compared. A row is never its own
candidate, another row with the same id is.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from echolot.llm.common import staged

SCALE = 256
KEEP = 7
BLOCK_ROWS = 65536
#: Components that a block holds at most; longer vectors come in blocks of fewer rows.
BLOCK_VALUES = 64 * BLOCK_ROWS
#: Rows whose exact scores are taken at once.
EXACT_ROWS = 4096


class Block:
    """Bit-sliced index over the rows of an integer matrix."""

    def __init__(self, values: np.ndarray) -> None:
        self.values = values
        n, dim = values.shape
        least, most = (values.min(axis=0), values.max(axis=0)) if values.size else (np.empty(0, np.int64),) * 2
        self.largest = max(abs(int(least.min())), abs(int(most.max()))) if values.size else 0
        # Unsigned, the difference is right also where it exceeds the signed range.
        least = least.astype(np.uint64)
        bits = int((most.astype(np.uint64) - least).max()).bit_length() if values.size else 0
        self.drop = max(0, bits - KEEP)
        above = np.zeros(n + -n % 64, np.uint64)
        self.rows = self._bitmap(np.arange(len(above)) < n)
        self.slices = []
        for j in range(dim):  # one column at a time, so that no copy of the matrix is made
            above[:n] = (values[:, j].astype(np.uint64) - least[j]) >> np.uint64(self.drop)
            self.slices.append(
                [self._bitmap((above >> np.uint64(i)) & np.uint64(1)) for i in range(bits - self.drop)]
            )

    @staticmethod
    def _bitmap(flags: np.ndarray) -> np.ndarray:
        return np.packbits(flags.astype(bool), bitorder="little").view(np.uint64)

    def scores(self, query: np.ndarray) -> list[np.ndarray]:
        """Slices of the coarse scores, least significant first."""
        columns: list[list[np.ndarray]] = []

        def put(at: int, bitmap: np.ndarray) -> None:
            while len(columns) <= at:
                columns.append([])
            columns[at].append(bitmap)

        for weight, slices in zip(query.tolist(), self.slices, strict=True):
            for i, bitmap in enumerate(slices):
                bitmap = ~bitmap if weight < 0 else bitmap
                for k in range(abs(weight).bit_length()):
                    if abs(weight) >> k & 1:
                        put(i + k, bitmap)
        out, at = [], 0
        while at < len(columns):
            stack = columns[at]
            while len(stack) > 2:  # full adder: three bitmaps of a weight to a sum and a carry
                a, b, c = stack.pop(), stack.pop(), stack.pop()
                ab = a ^ b
                stack.insert(0, ab ^ c)
                put(at + 1, (a & b) | (ab & c))
            if len(stack) == 2:
                a, b = stack
                put(at + 1, a & b)
                stack = [a ^ b]
            out.append(stack[0] if stack else np.zeros_like(self.rows))
            at += 1
        return out

    def top(self, query: np.ndarray, k: int, own: int | None) -> tuple[np.ndarray, np.ndarray]:
        """Rows that may be among the k best and their exact scores; ``own`` is left out."""
        rows = self.rows
        if own is not None:
            rows = rows.copy()
            rows[own // 64] &= ~(np.uint64(1) << np.uint64(own % 64))
        slices = self.scores(query)
        inside = rows
        if int(np.bitwise_count(rows).sum()) > k:
            above, equal, kth = np.zeros_like(rows), rows, 0
            for i in range(len(slices) - 1, -1, -1):
                ones = equal & slices[i]
                if int(np.bitwise_count(above).sum()) + int(np.bitwise_count(ones).sum()) >= k:
                    equal, kth = ones, kth + (1 << i)
                else:
                    above, equal = above | ones, equal & ~slices[i]
            bound = sum(map(abs, query.tolist())) * ((1 << self.drop) - 1)
            inside = rows & self._at_least(slices, max(0, kth - (bound >> self.drop) - 1))
        flags = np.unpackbits(inside.view(np.uint8), bitorder="little")
        found = np.flatnonzero(flags)
        return found, self.exact(found, query)

    def exact(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Inner products; Python integers where a sum may not fit in 64 bits."""
        if sum(map(abs, query.tolist())) * self.largest < 1 << 63:
            return self.values[rows] @ query
        wide = query.astype(object)
        parts = [rows[at : at + EXACT_ROWS] for at in range(0, len(rows), EXACT_ROWS)]
        return np.concatenate([np.empty(0, object)] + [self.values[x].astype(object) @ wide for x in parts])

    def _at_least(self, slices: list[np.ndarray], least: int) -> np.ndarray:
        above, equal = np.zeros_like(self.rows), ~np.zeros_like(self.rows)
        for i in range(len(slices) - 1, -1, -1):
            if least >> i & 1:
                equal = equal & slices[i]
            else:
                above, equal = above | (equal & slices[i]), equal & ~slices[i]
        return above | equal


def best_rows(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    if scores.dtype != object:
        return np.lexsort((ids, ~scores))[:k]  # the complement falls as the score rises, without overflow
    best = sorted(range(len(ids)), key=lambda i: (-scores[i], ids[i]))[:k]
    for i in best:
        if not -(1 << 63) <= scores[i] < 1 << 63:
            raise OverflowError(f"the score {scores[i]} of row {ids[i]} exceeds 64 bits")
    return np.asarray(best, np.int64)


def quantised(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """(key, id, dim, v): integer vectors of the rows that take part, with a key of the row."""
    x = F.col(vector)

    def scaled(e):
        value = e.cast("double") * SCALE
        text = F.concat(F.lit("a component of row "), F.col(key).cast("string"), F.lit(" exceeds 64 bits when scaled"))
        return F.when(F.abs(value) >= 2.0**63, F.raise_error(text)).otherwise(F.floor(value)).cast("long")

    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == F.lit(float("inf"))))
    rows = vectors.where(F.col(key).isNotNull() & x.isNotNull() & ~bad).select(
        F.monotonically_increasing_id().alias("row_no"),
        F.col(key).alias("id"),
        F.size(x).alias("dim"),
        F.transform(x, scaled).alias("v"),
    )
    return staged(rows, "quantised")


def grouped(candidates: DataFrame, queries: DataFrame) -> DataFrame:
    """(dim, group, asked, row_no, id, v): the candidates in groups of a block at most, the queries in each group of
    their dimension. A task gets its groups one after the other and the candidates of a group before its queries.
    """
    lanes = max(1, candidates.sparkSession.sparkContext.defaultParallelism)
    held = F.count("*") * F.greatest("dim", F.lit(BLOCK_VALUES // BLOCK_ROWS))
    sizes = candidates.groupBy("dim").agg(held.alias("held"))
    total = sizes.agg(F.sum("held")).first()[0] or 1
    tasks = lanes * -(-total // (lanes * BLOCK_VALUES))  # the last ones to start have as much to do as the others
    groups = F.broadcast(sizes.select("dim", F.expr(f"(held * {tasks} + {total - 1}) div {total}").alias("groups")))
    kept = ("row_no", F.col("id").cast("long").alias("id"), "v")
    of_row = F.pmod(F.xxhash64("row_no"), "groups").alias("group")
    of_query = F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("group")
    both = (
        candidates.join(groups, "dim")
        .select("dim", of_row, F.lit(False).alias("asked"), *kept)
        .union(queries.join(groups, "dim").select("dim", of_query, F.lit(True).alias("asked"), *kept))
    )
    # Groups of a dimension go to tasks in turn.
    task = F.pmod(F.pmod(F.xxhash64("dim"), F.lit(tasks)) + F.col("group"), F.lit(tasks)).cast("int")
    return both.repartitionById(tasks, task).sortWithinPartitions("dim", "group", "asked")


def top_k(candidates: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, id, score) over tables made by ``quantised``; ties go to the smaller id."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        """Rows of one group, all candidates or all queries: (dim, group), asked, row_nos, ids, vectors."""
        for batch in batches:
            dims, groups, asked, rows, ids = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(5))
            new = (np.diff(dims) != 0) | (np.diff(groups) != 0) | (np.diff(asked.astype(np.int8)) != 0)
            edges = [0, *(np.flatnonzero(new) + 1).tolist(), len(dims)]
            for a, b in zip(edges, edges[1:], strict=False):
                if a < b:
                    vectors = batch.column(5).slice(a, b - a).flatten().to_numpy(zero_copy_only=False)
                    yield (dims[a], groups[a]), asked[a], rows[a:b], ids[a:b], vectors.reshape(b - a, dims[a])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, parts, block = None, [], None
        for group, asked, rows, ids, vectors in runs(batches):
            if group != at:
                at, parts, block = group, [], None
            if not asked:
                parts.append((rows, ids, vectors))
                continue
            if parts:
                row_nos, own_ids, values = (np.concatenate(x) for x in zip(*parts, strict=True))
                parts, block = [], Block(values)
                place = {row: i for i, row in enumerate(row_nos.tolist())}
            if block is None:  # no candidate fell in this group
                continue
            out = []
            for row, query_id, query in zip(rows.tolist(), ids.tolist(), vectors, strict=True):
                found, scores = block.top(query, k, place.get(row))
                best = best_rows(own_ids[found], scores, k)
                near = own_ids[found[best]], scores[best].astype(np.int64)
                out.append((np.full(len(best), row), np.full(len(best), query_id), *near))
            columns = [np.concatenate(x).astype(np.int64) for x in zip(*out, strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in columns], ["row_no", "query_id", "id", "score"])

    result = "row_no long, query_id long, id long, score long"
    near = staged(grouped(candidates, queries).mapInArrow(search, result), "nearest")
    order = Window.partitionBy("row_no").orderBy(F.desc("score"), "id")
    return (
        near.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )
