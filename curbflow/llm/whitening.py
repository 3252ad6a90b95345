"""Whitening of embeddings: equal vectors are one row with a multiplicity, and each distinct vector is whitened once.

A fit is two passes over the distinct vectors: exact sums, then a centred product of matrices in every task.  What
reaches the driver is bounded by the number of components: one vector of sums and one matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbflow.llm.common import drop_stored, stored
from curbflow.llm.vectors import STEPS, common_dimensions, dimensions, matrices, whole_vectors

# Components with a smaller share of the largest eigenvalue have no variance but rounding errors.
LEAST_SHARE = 1e-12


@dataclass(frozen=True)
class Whitening:
    """A fit: weight of the list, exact sums by dimension, eigenvalues of the first components, and projections by column."""

    n: int
    sums: tuple[int, ...]
    trace: float
    eigenvalues: np.ndarray
    components: np.ndarray

    @property
    def scales(self) -> np.ndarray:
        """Factors to unit variance; NaN for components without variance."""
        least = LEAST_SHARE * max(self.eigenvalues, default=0.0)
        return np.array([1 / np.sqrt(e) if e > least else np.nan for e in self.eigenvalues])


def whiten(
    embeddings: DataFrame, *, key: str = "vec_id", vector: str = "embedding", components: int = 4, weights: str = "one", steps: int = STEPS
) -> DataFrame:
    """Per row with a usable vector and component: n, deviation, whitened, explained, identity_error, copies.

    The fit list holds each distinct whole vector x = floor(steps * component) once (`weights="one"`) or as often as it
    occurs ("count").  `deviation` is the sum over dimensions of (n * x - sum)**2, exact, as decimal (NULL beyond 38
    digits).  Components are numbered by falling eigenvalue of the covariance (divisor n, centred first); their sign makes the largest entry positive.
    `identity_error` is the largest absolute entry of the whitened covariance minus the identity.

    Rows whose vector is NULL, empty, or holds NULL or non-finite entries are left out, and so are vectors of another
    length than most have.  Fewer dimensions than `components` give fewer rows.  A component without variance has
    `whitened` NULL, an `explained` near 0 (NULL if nothing varies) and no part in `identity_error`, which is NULL if no component varies.  Repeated
    rows and NULL keys stay rows of their own; other columns are ignored; an empty table gives no rows.
    """
    rows = stored(whole_vectors(embeddings, vector, {"key": F.col(key)}, steps))
    size = common_dimensions(rows)
    rows = rows.filter(dimensions() == size)
    distinct = stored(rows.groupBy("x").agg(F.count(F.lit(1)).alias("copies")))
    weight = F.lit(1).cast("long") if weights == "one" else F.col("copies")
    fit = fitted(distinct.withColumn("weight", weight), size, components)
    single = stored(projected(distinct, fit, size))
    drop_stored(distinct)
    error = identity_error(single, weight, fit)
    z = F.col("z")
    explained = F.array(*[F.lit(float(e / fit.trace) if fit.trace > 0 else None).cast("double") for e in fit.eigenvalues])
    return (
        rows.join(single, "x")
        .select("key", "copies", "deviation", F.posexplode(z).alias("place", "whitened"))
        .select(
            F.col("key").alias(key),
            (F.col("place") + 1).alias("component"),
            F.lit(fit.n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(explained, F.col("place")).alias("explained"),
            F.lit(error).cast("double").alias("identity_error"),
            "copies",
        )
    )


def fitted(distinct: DataFrame, size: int, components: int) -> Whitening:
    """The fit of (x, weight) rows."""
    n, sums = _sums(distinct, size)
    if not n:
        return Whitening(0, (0,) * size, 0.0, np.zeros(0), np.zeros((size, 0)))
    mean = np.array([s / n for s in sums])
    covariance = _centred_products(distinct, mean) / n
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:components]
    chosen = vectors[:, order]
    chosen = chosen * np.sign(chosen[np.abs(chosen).argmax(axis=0), np.arange(chosen.shape[1])])
    return Whitening(n, tuple(sums), float(np.trace(covariance)), np.maximum(values[order], 0.0), chosen)


def _sums(distinct: DataFrame, size: int) -> tuple[int, list[int]]:
    """Weight of all rows and exact weighted sums by dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = [0] * (size + 1)
        for part, x in matrices(batches, size):
            w = part.column("weight").to_numpy(zero_copy_only=False)
            if _fits(np.abs(x.astype(float)).max(initial=0) * float(w.sum())):
                own = [int(w.sum()), *(w @ x).tolist()]
            else:
                own = [int(w.sum()), *(w.astype(object) @ x.astype(object))]
            total = [a + int(b) for a, b in zip(total, own)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(-1, size), pa.int32()), pa.array([str(t) for t in total])], ["dimension", "total"]
        )

    partial = distinct.select("x", "weight").mapInArrow(run, "dimension int, total string")
    rows = partial.groupBy("dimension").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()
    found = {row["dimension"]: int(row["total"]) for row in rows}
    return found.get(-1, 0), [found.get(k, 0) for k in range(size)]


def _centred_products(distinct: DataFrame, mean: np.ndarray) -> np.ndarray:
    """Weighted sum of the outer products of centred rows; the rounding of the mean itself is taken out again."""
    size = len(mean)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        products, rest, total = np.zeros((size, size)), np.zeros(size), 0.0
        for part, x in matrices(batches, size):
            w = part.column("weight").to_numpy(zero_copy_only=False).astype(float)
            centred = x - mean
            weighted = centred * w[:, None]
            products += weighted.T @ centred
            rest, total = rest + weighted.sum(axis=0), total + w.sum()
        # Row i of the matrix; below it the sums that a mean without rounding would make 0, and the weight.
        table = np.vstack([products, rest, np.full(size, total)])
        yield pa.RecordBatch.from_arrays([pa.array(range(size + 2), pa.int32()), pa.array(list(table), pa.list_(pa.float64()))], ["line", "numbers"])

    def added(table: pa.Table) -> pa.Table:
        # In order of value, so that the sum does not depend on the order in which tasks end.
        lines = np.sort(np.stack(table.column("numbers").to_numpy()), axis=0).sum(axis=0)
        return pa.table({"line": table.column("line").slice(0, 1), "numbers": pa.array([lines], pa.list_(pa.float64()))})

    kind = "line int, numbers array<double>"
    lines = distinct.select("x", "weight").mapInArrow(run, kind).groupBy("line").applyInArrow(added, kind).collect()
    table = np.array([row["numbers"] for row in sorted(lines)])
    products, rest, total = table[:size], table[size], table[size + 1]
    products = products - np.outer(rest, rest) / total[0]
    return (products + products.T) / 2


def projected(distinct: DataFrame, fit: Whitening, size: int) -> DataFrame:
    """Every distinct vector with its exact deviation and its whitened components `z`."""
    n, sums, turn = fit.n, fit.sums, fit.components * fit.scales
    most = max(map(abs, sums), default=0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = np.array(sums, np.int64) if most < 1 << 62 else None
        for part, x in matrices(batches, size):
            far = float(np.abs(x.astype(float)).max(initial=0))
            if whole is not None and _fits(size * (n * far + most) ** 2):
                from_mean = n * x - whole
                deviation = (from_mean * from_mean).sum(axis=1).tolist()
                centred = from_mean / n
            else:
                deviation = _long_deviations(x, n, sums, far)
                centred = x - np.array([s / n for s in sums])
            z = centred @ turn
            numbers = pa.array(z.ravel(), pa.float64(), mask=np.isnan(z.ravel()))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(z) + 1) * z.shape[1], pa.int32()), numbers)
            text = pa.array([str(d) if d < 10**38 else None for d in deviation], pa.string())
            yield pa.RecordBatch.from_arrays([part.column("x"), part.column("copies"), text, lists], ["x", "copies", "deviation", "z"])

    out = distinct.select("x", "copies").mapInArrow(run, "x binary, copies long, deviation string, z array<double>")
    return out.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def _long_deviations(x: np.ndarray, n: int, sums: tuple[int, ...], far: float) -> list[int]:
    """Deviations that a long does not hold: n**2 * sum(x**2) - 2 * n * sum(x * s) + sum(s**2), in whole numbers."""
    most = max(map(abs, sums), default=0)
    kind = np.int64 if _fits(len(sums) * far * max(far, float(most))) else object
    own = x.astype(kind)
    squares, mixed = (own * own).sum(axis=1).tolist(), (own @ np.array(sums, kind)).tolist()
    last = sum(s * s for s in sums)
    return [n * n * int(a) - 2 * n * int(b) + last for a, b in zip(squares, mixed)]


def _fits(bound: float) -> bool:
    """Whether whole numbers up to the bound fit in a long, rounding of the bound included."""
    return bound < 9.2e18


def identity_error(single: DataFrame, weight: Column, fit: Whitening) -> float | None:
    """Largest absolute entry of the covariance of z minus the identity, over components that vary."""
    varying = [k for k, s in enumerate(fit.scales) if s == s]
    if not varying:
        return None
    means = single.agg(F.sum(weight).alias("n"), *[F.sum(F.get("z", k) * weight).alias(f"s{k}") for k in varying]).first()
    centred = {k: F.get("z", k) - F.lit(means[f"s{k}"] / means["n"]) for k in varying}
    pairs = [(i, j) for i in varying for j in varying if i <= j]
    sums = single.agg(*[F.sum(centred[i] * centred[j] * weight).alias(f"p{i}_{j}") for i, j in pairs]).first()
    return max(abs(sums[f"p{i}_{j}"] / means["n"] - (i == j)) for i, j in pairs)
