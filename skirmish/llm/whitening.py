"""Embedding whitening by upper-triangle column aggregates.

Entries become whole numbers, x = floor(64 c) + 1,000,000. The fit list is every different x vector once. One aggregation
of generated SQL sums the columns exactly; a second one, over columns centred by those sums, sums the product of every
pair of dimensions: the upper triangle of the covariance, in blocks of 8 x 8. Partial sums are taken where the rows lie, so what
travels and what the driver sees are about d * d / 2 numbers a task, however many rows there are.
LAPACK decomposes the covariance; rows are then projected where they lie. The whitened covariance is measured by the
same aggregation over the whitened fit list.

Vectors that are null or hold null or non-finite entries have no rows. Vectors of each length are whitened by themselves,
with a fit list of their own. Components whose eigenvalue isn't above the rounding of the largest can't be whitened and have
no rows: those beyond the rank, and all where one different vector is left. Equal eigenvalues are ties: any basis of their
space will do, the same for all rows. Repeated rows each have their rows, a null vec_id too. A deviation that a long can't hold is
null; an entry of 2**46 or more in size is an error, as centring would lose its last bits. Extra columns are ignored. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skirmish.llm.common import cut, prepare

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
LARGEST = float(1 << 46)
#: Columns of a block: an aggregation of 8 x 8 sums is one that Spark compiles whole.
BLOCK = 8
OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def whole_numbers(rows: DataFrame, vector: str = "embedding", ident: str = "vec_id") -> DataFrame:
    """vec_id and x of the rows whose vectors are finite."""
    entries = F.col(vector).cast("array<double>")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    x = F.transform(entries, lambda c: F.when(F.abs(c) < LARGEST, F.floor(c * SCALE) + SHIFT).otherwise(F.raise_error(F.lit("an entry of 2**46 or more"))).cast("long"))
    return rows.where(F.col(vector).isNotNull() & finite).select(F.col(ident).cast("long").alias("vec_id"), x.alias("x"))


def column_sums(rows: DataFrame, columns: list[str]) -> list:
    """The sum of each column, in one aggregation."""
    return list(rows.selectExpr(*[f"sum({c}) AS s{i}" for i, c in enumerate(columns)]).first())


def covariance(rows: DataFrame, centred: list[str], n: int) -> np.ndarray:
    """Covariance with divisor n of columns given as SQL that is centred already, in one aggregation: every row goes once for
    each pair of blocks of columns in the upper triangle, and of each pair of blocks all products are summed. Columns are
    filled up with zeros to whole blocks."""
    blocks = -(-len(centred) // BLOCK)
    filled = [*centred, *["0D"] * (blocks * BLOCK - len(centred))]
    at = ", ".join(f"named_struct('i', {i * BLOCK}, 'j', {j * BLOCK})" for i in range(blocks) for j in range(i, blocks))
    dealt = rows.selectExpr(f"array({', '.join(filled)}) AS c").selectExpr("c", f"explode(array({at})) AS at")
    sides = dealt.selectExpr("at.i", "at.j", *[f"coalesce(c[at.{s} + {k}], 0D) AS {s}{k}" for s in "ij" for k in range(BLOCK)])
    sums = sides.groupBy("i", "j").agg(*[F.expr(f"sum(i{k} * j{m})").alias(f"p{k * BLOCK + m}") for k in range(BLOCK) for m in range(BLOCK)])
    out = np.zeros((len(filled), len(filled)))
    for i, j, *products in sums.collect():
        out[i : i + BLOCK, j : j + BLOCK] = np.array(products).reshape(BLOCK, BLOCK) / n
    upper = np.triu(out)[: len(centred), : len(centred)]
    return upper + np.triu(upper, 1).T


@dataclass
class Whitening:
    """What fit() learns of vectors of one length: numbers that depend on the length alone, not on the rows."""

    n: int
    sums: list[int]
    values: np.ndarray  # eigenvalues, falling
    vectors: np.ndarray  # a column for each
    explained: np.ndarray
    identity_error: float = 0.0

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n, whole parts first."""
        whole, rest = np.array([divmod(s, self.n) for s in self.sums], np.int64).reshape(-1, 2).T
        return (x - whole).astype(np.float64) - rest / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.vectors / np.sqrt(self.values)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sums of squares of n x - S, exact; null beyond a long."""
        whole, rest = np.array([divmod(s, self.n) for s in self.sums], np.int64).reshape(-1, 2).T
        about = ((self.n * (x - whole).astype(np.float64) - rest) ** 2).sum(1)
        with np.errstate(over="ignore"):
            exact = ((self.n * (x - whole) - rest) ** 2).sum(1).tolist()
        for r in np.flatnonzero(about >= float(1 << 62)):
            exact[r] = sum((self.n * v - s) ** 2 for v, s in zip(x[r].tolist(), self.sums, strict=True))
        return [v if v < 1 << 63 else None for v in exact]


def decompose(v: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, falling; unit eigenvectors as columns; shares of the trace) of the first `most` components that stand above rounding."""
    values, vectors = np.linalg.eigh(v)
    values, vectors = values[::-1], vectors[:, ::-1]
    keep = np.flatnonzero(values > max(values[0], 0.0) * len(v) * np.finfo(float).eps)[:most]
    return values[keep], vectors[:, keep], values[keep] / (np.trace(v) or 1.0)


def _in_batches(rows: DataFrame, schema: str, made: Callable[[pa.RecordBatch, np.ndarray], dict]) -> DataFrame:
    """Rows that `made` gives for a batch and its vectors as a matrix; the vectors are of one length."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x = batch.column("x").flatten().to_numpy().reshape(batch.num_rows, -1)
                yield pa.RecordBatch.from_pydict(made(batch, x))

    return rows.mapInArrow(run, schema)


def fit(x: DataFrame, components: int = COMPONENTS) -> dict[int, Whitening]:
    """What whitens the vectors of each length; x: whole_numbers(). The different vectors are written down once and read by
    every aggregation."""
    prepare(x.sparkSession)
    different = cut(x.where(F.size("x") > 0).select("x").distinct())
    out = {}
    for d, n in different.groupBy(F.size("x")).count().collect():
        own = different.where(F.size("x") == d)
        sums = column_sums(own, [f"x[{i}]" for i in range(d)])
        centred = [f"(CAST(x[{i}] - {s // n} AS DOUBLE) - {(s % n) / n!r}D)" for i, s in enumerate(sums)]
        model = Whitening(n, sums, *decompose(covariance(own, centred, n), components))
        k = len(model.values)
        if k:
            white = _in_batches(own, ", ".join(f"w{i} double" for i in range(k)), lambda _, rows, m=model: {f"w{i}": w for i, w in enumerate(m.whitened(rows).T)})
            means = [s / n for s in column_sums(white, [f"w{i}" for i in range(k)])]
            measured = covariance(white, [f"(w{i} - ({m!r}D))" for i, m in enumerate(means)], n)
            model.identity_error = float(np.abs(measured - np.eye(k)).max())
        out[d] = model
    return out


def apply(x: DataFrame, models: dict[int, Whitening]) -> DataFrame:
    """OUT: a row for each row of x and component; no shuffle."""

    def made(model: Whitening):
        def rows(batch: pa.RecordBatch, x: np.ndarray) -> dict:
            m, k = len(x), len(model.values)
            return {
                "vec_id": batch.column("vec_id").take(pa.array(np.repeat(np.arange(m), k))),
                "component": np.tile(np.arange(1, k + 1, dtype=np.int32), m),
                "n": np.full(m * k, model.n),
                "deviation": pa.array(model.deviations(x), pa.int64()).take(pa.array(np.repeat(np.arange(m), k))),
                "whitened": model.whitened(x).ravel(),
                "explained": np.tile(model.explained, m),
                "identity_error": np.full(m * k, model.identity_error),
            }

        return rows

    out = x.sparkSession.createDataFrame([], OUT)
    for d, model in sorted(models.items()):
        if len(model.values):
            out = out.unionAll(_in_batches(x.where(F.size("x") == d), OUT, made(model)))
    return out


def whiten(rows: DataFrame, components: int = COMPONENTS, vector: str = "embedding", ident: str = "vec_id") -> DataFrame:
    """Rows of a table of vectors by their first `components` whitened components."""
    x = whole_numbers(rows, vector, ident)
    return apply(x, fit(x, components))
