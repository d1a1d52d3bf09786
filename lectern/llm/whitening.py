"""Embedding whitening: covariances by one aggregation of generated expressions, eigenvectors by LAPACK.

Entries become whole numbers, x = floor(SCALE * c) + SHIFT.  The fit list holds each distinct vector of
these once.  For every pair of dimensions, the upper triangle of the covariance, an SQL expression
sums the product of two columns less their rounded means; all of them stand in one aggregation.  The sums
are whole numbers where the range of the entries proves that they fit 64 bits, so the covariance is
exact up to its last rounding; wider entries are summed in doubles.  Vectors of more than TILE dimensions
are cut into pieces, and the same aggregation runs by pair of pieces.  The driver holds the
covariance alone, dims x dims numbers, and LAPACK takes it apart.

Components are numbered by falling eigenvalue, and the sign of each makes its largest entry positive.  The
covariance of the whitened fit list is summed by the same aggregation and held against the identity.

Defined results: vectors that are null, empty, or hold null, non-finite or entries beyond FARTHEST are
left out; vectors of each length are whitened by themselves, with a fit list of their own; components
whose eigenvalue is zero up to rounding have no unit variance and are left out, so a table of
equal vectors gives no rows; rows without an id, and repeated rows, are rows like others; a deviation
beyond 64 bits is null; an empty table gives an empty result.  Other columns play no part.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lectern.llm.common import cut, drop_table, tidy

#: Whole numbers of an entry c: floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 64, 1_000_000
#: Components that each row gets at most.
COMPONENTS = 16
#: Dimensions of a piece of a vector; a pair of pieces is one group of the aggregation.  Few expressions are compiled as one, many are not.
TILE = 8
#: Largest size of an entry, so that its whole number and sums of dimensions fit 64 bits.
FARTHEST = 2.0**50
#: Share of the largest eigenvalue, for each dimension, below which another is rounding.
ROUNDING = 2.0**-50


def whole(table: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, x, dims): rows whose vectors have whole numbers."""
    some = table.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0))
    fine = F.forall("v", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) <= FARTHEST))
    x = F.transform("v", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    return some.where(fine).select("id", x.alias("x"), F.size("v").alias("dims"))


def _pieces(dims: int) -> list[tuple[int, int]]:
    return [(lo, min(lo + TILE, dims)) for lo in range(0, dims, TILE)]


def product_sums(table: DataFrame, column: str, dims: int, centres: list) -> np.ndarray:
    """Sums of (x_i - centre_i) * (x_j - centre_j) over the rows, for every pair of dimensions, as Python numbers.

    The expressions of one pair of pieces are those of every other, on the columns l0, l1, ... and r0, r1, ...
    """
    kind = table.schema[column].dataType.elementType.simpleString()
    pieces = _pieces(dims)
    parts = F.array(*(F.array(*(F.element_at(column, i + 1) - F.lit(centres[i]).cast(kind) for i in range(lo, hi))) for lo, hi in pieces))
    out = np.zeros((dims, dims), object)
    if len(pieces) == 1:
        names = [f"l{i}" for i in range(dims)]
        flat = table.select(*((F.element_at(column, i + 1) - F.lit(centres[i]).cast(kind)).alias(names[i]) for i in range(dims)))
        row = flat.selectExpr(*(f"sum({names[i]} * {names[j]}) AS p_{i}_{j}" for i in range(dims) for j in range(i, dims))).first()
        for i in range(dims):
            for j in range(i, dims):
                out[i, j] = out[j, i] = row[f"p_{i}_{j}"] or 0
        return out
    pairs = F.array(*(F.struct(F.lit(p).alias("p"), F.lit(q).alias("q")) for p in range(len(pieces)) for q in range(p, len(pieces))))
    dealt = table.select(parts.alias("parts")).select("parts", F.explode(pairs).alias("pair"))
    left, right = (F.element_at("parts", F.col(f"pair.{k}") + 1) for k in "pq")
    flat = dealt.select("pair.p", "pair.q", left.alias("left"), right.alias("right"))
    flat = flat.select("p", "q", *(F.get("left", F.lit(i)).alias(f"l{i}") for i in range(TILE)), *(F.get("right", F.lit(i)).alias(f"r{i}") for i in range(TILE)))
    sums = flat.groupBy("p", "q").agg(*(F.expr(f"sum(l{i} * r{j}) AS p_{i}_{j}") for i in range(TILE) for j in range(TILE)))
    for row in sums.toLocalIterator():
        (a, b), (c, d) = pieces[row["p"]], pieces[row["q"]]
        for i in range(a, b):
            for j in range(c, d):
                out[i, j] = out[j, i] = row[f"p_{i - a}_{j - c}"] or 0
    return out


def _bounds(fit: DataFrame, dims: int) -> tuple[int, list[int], list[int], list[int]]:
    """Vectors of the fit list, and the sums, least and largest entries of each dimension, exactly."""
    entries = [F.element_at("x", i + 1) for i in range(dims)]
    row = fit.agg(F.count("*"), *(F.sum(e.cast("decimal(20,0)")) for e in entries), *(F.min(e) for e in entries), *(F.max(e) for e in entries)).first()
    n, rest = row[0], [int(v or 0) for v in row[1:]]
    return n, rest[:dims], rest[dims : 2 * dims], rest[2 * dims :]


class Whitening:
    """Means, eigenvalues and components of one length of vectors."""

    def __init__(self, fit: DataFrame, dims: int):
        self.dims = dims
        self.n, self.sums, low, high = _bounds(fit, dims)
        n = self.n
        self.centres = [(2 * s + n) // (2 * n) for s in self.sums]  # the mean, rounded
        widest = max((max(h - c, c - m, 1) for h, m, c in zip(high, low, self.centres, strict=True)), default=1)
        self.exact = n * widest**2 < 1 << 62
        self.narrow = dims * (n * (widest + 1)) ** 2 < 1 << 62
        left = [s - n * c for s, c in zip(self.sums, self.centres, strict=True)]  # of each dimension, what rounding the mean leaves
        column = fit if self.exact else fit.select(F.col("x").cast("array<double>").alias("x"))
        products = product_sums(column, "x", dims, self.centres)
        cov = np.zeros((dims, dims))
        for i in range(dims):
            for j in range(i, dims):
                cov[i, j] = cov[j, i] = float((Fraction(products[i, j]) - Fraction(left[i] * left[j], n)) / n)
        values, vectors = np.linalg.eigh(cov)
        values, vectors = values[::-1], vectors[:, ::-1]
        kept = [k for k in range(min(COMPONENTS, dims)) if values[k] > ROUNDING * dims * max(values[0], 0)]
        sign = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(dims)])
        self.values, self.vectors = values[kept], (vectors * sign)[:, kept]
        self.rest = np.array([x / n for x in left])
        self.explained = self.values / np.trace(cov) if kept else self.values
        self.identity_error = self._error(fit) if kept else 0.0

    def whitened(self, x: np.ndarray) -> np.ndarray:
        """Rows of whole numbers by components."""
        return ((x - np.array(self.centres, np.int64)).astype(float) - self.rest) @ self.vectors / np.sqrt(self.values)

    def _error(self, fit: DataFrame) -> float:
        def rows(batches):
            for batch in batches:
                w = self.whitened(_matrix(batch.column(0), self.dims))
                yield pa.RecordBatch.from_arrays([pa.ListArray.from_arrays(pa.array(np.arange(0, w.size + 1, w.shape[1]), pa.int32()), pa.array(w.ravel()))], ["w"])

        k = len(self.values)
        table = cut(fit.select("x").mapInArrow(tidy(rows), "w array<double>"), "whitening-fit")
        means = list(table.agg(*(F.avg(F.element_at("w", i + 1)) for i in range(k))).first())
        cov = product_sums(table, "w", k, means).astype(float) / self.n
        drop_table(table)
        return float(np.abs(cov - np.eye(k)).max())

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Of each row, the sum over dimensions of (n * x - S)^2."""
        if self.narrow:
            off = (x - np.array(self.centres, np.int64)) * self.n - np.array([s - self.n * c for s, c in zip(self.sums, self.centres, strict=True)], np.int64)
            return (off * off).sum(1).tolist()
        out = [sum((self.n * v - s) ** 2 for v, s in zip(row, self.sums, strict=True)) for row in x.tolist()]
        return [v if v < 1 << 63 else None for v in out]


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims)


def _project(model: Whitening, kind: pa.DataType):
    k = len(model.values)

    def rows(batches):
        for batch in batches:
            x = _matrix(batch.column("x"), model.dims)
            at = pa.array(np.repeat(np.arange(len(x)), k))
            each = [np.tile(v, len(x)) for v in (np.arange(1, k + 1, dtype=np.int32), model.explained)]
            columns = [batch.column("id").take(at), pa.array(each[0]), pa.array(np.full(len(at), model.n)), pa.array(model.deviations(x), pa.int64()).take(at), pa.array(model.whitened(x).ravel()), pa.array(each[1]), pa.array(np.full(len(at), model.identity_error))]
            yield pa.RecordBatch.from_arrays([columns[0].cast(kind), *columns[1:]], ["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return tidy(rows)


def whiten(table: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """A row for each vector and component: id, component, n, deviation, whitened, explained, identity_error."""
    from pyspark.sql.pandas.types import to_arrow_type

    spark, id_type = table.sparkSession, table.schema[id_col].dataType
    rows = cut(whole(table, id_col, vec_col), "whitening-rows")
    lengths = sorted(r["dims"] for r in rows.select("dims").distinct().collect())
    schema = T.StructType([T.StructField("id", id_type), T.StructField("component", T.IntegerType()), T.StructField("n", T.LongType()), T.StructField("deviation", T.LongType()), T.StructField("whitened", T.DoubleType()), T.StructField("explained", T.DoubleType()), T.StructField("identity_error", T.DoubleType())])
    out = spark.createDataFrame([], schema)
    for dims in lengths:
        own = rows.where(F.col("dims") == dims)
        fit = cut(own.select("x").distinct(), "whitening-distinct")
        model = Whitening(fit, dims)
        drop_table(fit)
        if len(model.values):
            out = out.unionByName(own.select("id", "x").mapInArrow(_project(model, to_arrow_type(id_type)), schema))
    return out.withColumnRenamed("id", id_col)
