"""Embedding whitening by Jacobi-Davidson on matrix-free products.

The covariance matrix is never formed. A product of it with a few columns is one Spark job: each block of
rows is centred, multiplied with the columns and back, and the products are summed. The driver holds what has
the size of some vectors: sums per dimension, the search space and the columns of a product.

The solver seeks all wanted pairs at once:

1. Rayleigh-Ritz in the search space gives approximate pairs and residuals;
2. leading pairs whose residual has reached double precision are locked, the others are sought orthogonal to them;
3. each open pair's correction equation, projected against the locked and the approximate vectors, is solved
   by MINRES; the recurrences of all pairs advance together, one product for all;
4. the corrections extend the search space, which restarts with its best vectors when it is full.

Entries become integers ``floor(scale * c) + shift``, so sums and deviations are exact. Rows whose vector is
null or empty or holds null or non-finite entries are left out. Entries whose scaled size exceeds 2^40 and
vectors of different lengths are refused by an error. Rows with a null id take part and come out with a
null id; repeated rows count as often as they occur. Components without variance (all vectors equal, fewer rows or
dimensions than components) are left out, so an empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echolot.llm.common import staged

COMPONENTS = 8
SCALE = 1024
SHIFT = 100_000
LARGEST = 2**40  # entries of a block of up to 2^22 rows are then summed exactly in 64 bits
BLOCK_BYTES = 4_000_000
EPS = np.finfo(np.float64).eps
TOLERANCE = 128 * EPS  # of the largest eigenvalue
INNER_STEPS = 12
SPACE = 6  # columns of the search space, in multiples of the components
OUTER_STEPS = 300

Product = Callable[[np.ndarray], np.ndarray]


class Table(NamedTuple):
    """Blocks of integer rows, with their exact sums."""

    blocks: DataFrame
    n: int
    sums: list[int]

    @property
    def dimensions(self) -> int:
        return len(self.sums)


class Fit(NamedTuple):
    vectors: np.ndarray
    values: np.ndarray
    trace: float
    products: int


def _rows_of(column: pa.ListArray) -> np.ndarray:
    lengths = np.unique(np.asarray(column.value_lengths()))
    if len(lengths) > 1:
        raise ValueError(f"vectors of different lengths: {lengths.tolist()}")
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def blocks_of(rows: DataFrame, id_column: str, vector: str, scale: int, shift: int) -> Table:
    """The rows as a written table of blocks: ids, their null marks, and entries as integers."""
    entry = F.col(vector).cast("array<double>")
    finite = F.forall(entry, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & finite)
    numbered = usable.select(F.col(id_column).cast("long").alias("id"), entry.alias("v"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            whole = np.floor(_rows_of(batch.column("v")) * float(scale))
            if np.abs(whole).max() > LARGEST:
                at = int(np.abs(whole).max(axis=1).argmax())
                raise ValueError(f"row {batch.column('id')[at].as_py()}: an entry is too large to be summed exactly")
            x = whole.astype(np.int64) + shift
            ids = batch.column("id")
            step = max(1, BLOCK_BYTES // (8 * x.shape[1]))
            for k in range(0, len(x), step):
                part, own = x[k : k + step], ids[k : k + step]
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "n": len(part), "d": x.shape[1], "sums": part.sum(axis=0).tolist(),
                            "ids": own.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64).tobytes(),
                            "unknown": own.is_null().to_numpy(zero_copy_only=False).tobytes(),
                            "data": part.tobytes(),
                        }
                    ],
                    schema=schema,
                )

    schema = pa.schema(
        [("n", pa.int64()), ("d", pa.int32()), ("sums", pa.list_(pa.int64())), ("ids", pa.binary()), ("unknown", pa.binary()), ("data", pa.binary())]
    )
    blocks = staged(
        numbered.mapInArrow(pack, "n long, d int, sums array<long>, ids binary, unknown binary, data binary"),
        "vector-blocks",
    )
    size = blocks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.min("d").alias("low"), F.max("d").alias("high")).first()
    if size["low"] != size["high"]:
        raise ValueError(f"vectors of different lengths: {size['low']} to {size['high']}")
    each = blocks.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    return Table(blocks, size["n"], [int(row["s"]) for row in each.orderBy("i").collect()])


class Centre:
    """Rows minus their mean without loss: the whole part of the mean leaves as an integer."""

    def __init__(self, table: Table) -> None:
        self.n = table.n
        pairs = [divmod(s, table.n) for s in table.sums]
        self.whole = np.array([q for q, _ in pairs], np.int64)
        self.rest = np.array([r for _, r in pairs], np.int64)

    def integers(self, data: bytes) -> np.ndarray:
        return np.frombuffer(data, np.int64).reshape(-1, len(self.whole)) - self.whole

    def __call__(self, data: bytes) -> np.ndarray:
        return self.integers(data) - self.rest / self.n

    def deviations(self, data: bytes) -> list[int]:
        """Exact sums over the dimensions of (n * x - S)^2."""
        x = self.integers(data)
        if (self.n * (int(np.abs(x).max()) + 1)) ** 2 * x.shape[1] < 2**63:
            return (np.square(x * self.n - self.rest).sum(axis=1)).tolist()
        # sums of (n x - r)^2 = n^2 sum x^2 - 2 n sum x r + sum r^2, of whole numbers of any size
        squares, crossed = np.square(x.astype(object)).sum(axis=1), (x.astype(object) * self.rest.astype(object)).sum(axis=1)
        own = int(np.square(self.rest.astype(object)).sum())
        return [self.n * self.n * int(a) - 2 * self.n * int(b) + own for a, b in zip(squares, crossed, strict=True)]


def total(table: Table, of_block: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all blocks of a small array made from each block's centred rows.

    Each task adds its blocks and passes on one number per entry; Spark sums the entries.
    """
    centre = Centre(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None
        for batch in batches:
            for data in batch.column("data"):
                part = of_block(centre(data.as_py()))
                own = part if own is None else own + part
        if own is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(own.size)), pa.array(own.ravel())], names=["i", "v"])

    parts = table.blocks.select("data").mapInArrow(run, "i long, v double")
    sums = {row["i"]: row["v"] for row in parts.groupBy("i").agg(F.sum("v").alias("v")).collect()}
    return np.array([sums[i] for i in range(len(sums))])


def product_of(table: Table) -> Product:
    """Covariance times columns."""

    def product(columns: np.ndarray) -> np.ndarray:
        return total(table, lambda x: x.T @ (x @ columns)).reshape(columns.shape) / table.n

    return product


def _orthonormal(columns: np.ndarray, against: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what the columns add to a space."""
    for _ in range(2):
        columns = columns - against @ (against.T @ columns)
        norm = np.linalg.norm(columns, axis=0)
        columns = columns[:, norm > 0] / norm[norm > 0]
        left, size, _ = np.linalg.svd(columns, full_matrices=False)
        columns = left[:, size > 1e-8] if len(size) else columns
    return columns


def corrections(product: Product, space: np.ndarray, shifts: np.ndarray, residuals: np.ndarray, goal: float) -> np.ndarray:
    """MINRES for (I - QQ') (C - shift) (I - QQ') t = -r, all columns together, until each residual fell by
    ``goal``. A column that is done keeps its solution while the others go on."""

    def projected(x: np.ndarray) -> np.ndarray:
        return x - space @ (space.T @ x)

    b = -projected(residuals)
    beta = np.linalg.norm(b, axis=0)
    target = beta * goal
    t, v_old = np.zeros_like(b), np.zeros_like(b)
    live = beta > 0
    v = np.divide(b, beta, out=np.zeros_like(b), where=live)
    phi, beta_now = beta.copy(), np.zeros_like(beta)
    cos, sin, cos_old, sin_old = (np.full_like(beta, k) for k in (1.0, 0.0, 1.0, 0.0))
    w, w_old = np.zeros_like(b), np.zeros_like(b)
    for _ in range(min(INNER_STEPS, len(b) - space.shape[1])):
        if not live.any():
            break
        at = np.flatnonzero(live)
        u = np.zeros_like(b)
        u[:, at] = product(v[:, at])
        u = projected(u - v * shifts) - v_old * beta_now
        alpha = (u * v).sum(axis=0)
        u = u - v * alpha
        beta_next = np.linalg.norm(u, axis=0)
        # the new column of the tridiagonal matrix, turned by the two rotations before it
        far = sin_old * beta_now
        near = cos * cos_old * beta_now + sin * alpha
        own = cos * alpha - sin * cos_old * beta_now
        size = np.hypot(own, beta_next)
        safe = np.where(size > 0, size, 1.0)
        cos_old, sin_old, cos, sin = cos, sin, own / safe, beta_next / safe
        w_old, w = w, (v - w_old * far - w * near) / safe
        t = t + np.where(live & (size > 0), cos * phi, 0.0) * w
        phi = -sin * phi
        v_old, beta_now = v, beta_next
        v = np.divide(u, beta_next, out=np.zeros_like(u), where=beta_next > 0)
        live = live & (np.abs(phi) > target) & (beta_next > EPS * np.abs(shifts).max()) & (size > 0)
    return t


def leading_pairs(product: Product, dimensions: int, wanted: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The eigenvectors of the largest eigenvalues, falling, by block Jacobi-Davidson with locking."""
    wanted = min(wanted, dimensions)
    most = min(dimensions, max(SPACE * wanted, wanted + 8))
    space = _orthonormal(np.random.default_rng(seed).standard_normal((dimensions, wanted)), np.zeros((dimensions, 0)))
    image = product(space)
    locked, locked_values = np.zeros((dimensions, 0)), np.zeros(0)
    goal = 0.5
    for _ in range(OUTER_STEPS):
        small = space.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        space, image = space @ turn, image @ turn
        largest = max(np.abs(values).max(), np.abs(locked_values).max(initial=0.0))
        residual = image - space * values
        residual -= locked @ (locked.T @ residual)
        bad = np.linalg.norm(residual, axis=0) > TOLERANCE * largest
        open_pairs = wanted - locked.shape[1]
        done = int(np.argmax(bad[:open_pairs])) if bad[:open_pairs].any() else min(open_pairs, space.shape[1])
        locked = np.hstack([locked, space[:, :done]])
        locked_values = np.append(locked_values, values[:done])
        if locked.shape[1] == wanted:
            break
        space, image, values, residual = space[:, done:], image[:, done:], values[done:], residual[:, done:]
        open_pairs = min(wanted - locked.shape[1], space.shape[1])
        if space.shape[1] + locked.shape[1] + open_pairs > most and space.shape[1] + locked.shape[1] < dimensions:
            keep = max(open_pairs, min(space.shape[1], 2 * wanted))  # thick restart
            if dimensions > most:
                space, image = space[:, :keep], image[:, :keep]
        known = np.hstack([locked, space[:, :open_pairs]])
        t = corrections(product, known, values[:open_pairs], residual[:, :open_pairs], goal)
        goal = max(goal / 2, 1e-3)
        new = _orthonormal(t, np.hstack([locked, space]))
        if not new.shape[1]:  # nothing left to add: what rounding leaves is all there is
            rest = np.random.default_rng(seed + locked.shape[1]).standard_normal((dimensions, 1))
            new = _orthonormal(rest, np.hstack([locked, space]))
        if new.shape[1] and space.shape[1] + locked.shape[1] < dimensions:
            new = new[:, : dimensions - space.shape[1] - locked.shape[1]]
            space, image = np.hstack([space, new]), np.hstack([image, product(new)])
        else:  # the space is whole: apply the matrix once more to its vectors, which only rounding separates
            space = _orthonormal(space, locked)
            image = product(space)
    else:
        raise ArithmeticError("residuals did not reach double precision")
    order = np.argsort(-locked_values, kind="stable")
    return locked[:, order], locked_values[order]


def fit(table: Table, components: int = COMPONENTS) -> Fit:
    """Leading components of the covariance over all rows of the table."""
    if not table.n:
        return Fit(np.zeros((0, 0)), np.zeros(0), 0.0, 0)
    calls = 0
    multiply = product_of(table)

    def product(columns: np.ndarray) -> np.ndarray:
        nonlocal calls
        calls += 1
        return multiply(columns)

    trace = float(total(table, lambda x: np.square(x).sum(keepdims=True).ravel())[0]) / table.n
    if not trace:
        return Fit(np.zeros((table.dimensions, 0)), np.zeros(0), 0.0, 0)
    vectors, values = leading_pairs(product, table.dimensions, components)
    real = values > 1e3 * EPS * trace
    return Fit(vectors[:, real], values[real], trace, calls)


def identity_error(table: Table, model: Fit) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity, over all rows."""
    turn = model.vectors / np.sqrt(model.values)
    k = len(model.values)
    mean = total(table, lambda x: (x @ turn).sum(axis=0)) / table.n

    def products(x: np.ndarray) -> np.ndarray:
        y = x @ turn - mean
        return y.T @ y

    return float(np.abs(total(table, products).reshape(k, k) / table.n - np.eye(k)).max())


def whiten(table: Table, model: Fit) -> DataFrame:
    """(id, component, n, deviation decimal(38,0), whitened, explained, identity_error) for each row and component."""
    schema = "id long, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    if not len(model.values):
        return table.blocks.sparkSession.createDataFrame([], schema)
    centre, k = Centre(table), len(model.values)
    turn, explained = model.vectors / np.sqrt(model.values), model.values / model.trace
    error = identity_error(table, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, unknown, data in zip(*(batch.column(c) for c in ("ids", "unknown", "data")), strict=True):
                data = data.as_py()
                y = centre(data) @ turn
                m = len(y)
                own = np.repeat(np.frombuffer(ids.as_py(), np.int64), k)
                gone = np.repeat(np.frombuffer(unknown.as_py(), bool), k)
                off = pa.array([str(x) for x in centre.deviations(data)]).cast(pa.decimal128(38, 0))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(own, mask=gone),
                        pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                        pa.array(np.full(m * k, centre.n)),
                        off.take(pa.array(np.repeat(np.arange(m), k))),
                        pa.array(y.ravel()),
                        pa.array(np.tile(explained, m)),
                        pa.array(np.full(m * k, error)),
                    ],
                    names=[part.split()[0] for part in schema.split(", ")],
                )

    return table.blocks.select("ids", "unknown", "data").mapInArrow(run, schema)


def report(rows: DataFrame, id_column: str, vector: str, components: int = COMPONENTS) -> DataFrame:
    """``whiten`` of all usable rows; a deviation that no 64-bit number holds is null."""
    table = blocks_of(rows, id_column, vector, SCALE, SHIFT)
    found = whiten(table, fit(table, components)).withColumnRenamed("id", id_column)
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))
