"""Embedding whitening (operator 11): incremental eigendecomposition.

Vector entries become integers (``floor(SCALE * c) + OFFSET``). Each partition
keeps the spectrum of its covariance and changes it by one centred rank-one
update a row (``secular.py``: secular equation with deflation). The partitions'
spectra, one row each, are combined in rounds of ``FAN``, again by rank-one
updates. The combined vectors are a basis for the last step, a Rayleigh-Ritz
refinement: in one distributed pass the covariance is formed in that basis from
values centred on the exact mean, and the eigenvectors of this small matrix turn
the basis into the components. Only counts, sums, spectra and that matrix reach
the driver; their size depends on the dimension, not on the rows. An update
costs the cube of the dimension, whatever the number of rows before it.

``fit`` returns the model, ``transform`` applies it, ``identity_error`` measures
the whitened rows' covariance in a pass of its own.

Cases: rows whose vector is null, empty or holds null or non-finite entries (or
one of 2^30 and more in size) are dropped, and so are vectors of another length
than the most frequent one (of equally frequent ones: the longer); a null id
stays null; repeated rows count each; components without variance (rank below
eight, equal vectors, one row) are left out, so such input gives fewer or no
rows; a deviation too large for a long is null; an empty table gives no rows.
Other columns, whatever their names, are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from lendscope.llm.common import batch, staged
from lendscope.llm.secular import EPS, Spectrum

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Partial results combined by one group.
FAN = 8
LARGEST = float(1 << 30)
_LONG = 1 << 63

_SPECTRUM = "part long, n long, sums array<string>, mean array<double>, d array<double>, u array<double>"
_MATRIX = "part long, n long, mean array<double>, m array<double>"


@dataclass
class Whitening:
    """``axes`` has a component in each column; ``values`` are their variances."""
    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def explained(self) -> list[float]:
        return [float(v / self.trace) for v in self.values]


def integer_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> tuple[DataFrame, int]:
    """(vec_id, x array<long>) of the rows that take part, and the dimension."""
    v = F.col(vector_col).cast("array<double>")
    plain = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    # NaN is larger than any number, a comparison with null is null
    sound = plain.where((F.size("v") > 0) & F.forall("v", lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False))))
    top = sound.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    dim = top.dim if top else 0
    x = F.transform("v", lambda c: F.floor(c * SCALE) + OFFSET)
    return sound.where(F.size("v") == dim).select("vec_id", x.alias("x")), dim


def _matrix(b: pa.RecordBatch, dim: int) -> np.ndarray:
    return b.column("x").flatten().to_numpy().reshape(-1, dim)


def _spectra(dim: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s, sums = Spectrum(dim), [0] * dim
        for b in batches:
            x = _matrix(b, dim)
            sums = [a + int(c) for a, c in zip(sums, x.sum(0), strict=True)]
            for row in x.astype(float):
                s.add(row)
        if s.n:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()], pa.int64()), "n": pa.array([s.n], pa.int64()),
                "sums": [[str(c) for c in sums]], "mean": [s.mean], "d": [s.d], "u": [s.u.ravel()]})
    return run


def _spectrum(row, dim: int) -> Spectrum:
    s = Spectrum(dim)
    s.n, s.mean = int(row["n"]), np.array(row["mean"], float)
    s.d, s.u = np.array(row["d"], float), np.array(row["u"], float).reshape(dim, dim)
    return s


def _merge_spectra(dim: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        first, *others = rows.to_dict("records")
        s, sums = _spectrum(first, dim), [int(c) for c in first["sums"]]
        for other in others:
            s.merge(_spectrum(other, dim))
            sums = [a + int(c) for a, c in zip(sums, other["sums"], strict=True)]
        return pd.DataFrame({"part": [first["part"] // FAN], "n": [s.n], "sums": [[str(c) for c in sums]], "mean": [s.mean],
                             "d": [s.d], "u": [s.u.ravel()]})
    return run


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """x - sums / n, from the exact n x - sums where that fits 64 bits."""
    total = max(map(abs, sums), default=0)
    if n * int(np.abs(x).max(initial=0)) + total < _LONG:
        return (n * x - np.array(sums, np.int64)) / n
    return (x.astype(object) * n - np.array(sums, object)).astype(float) / n


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Sum over the dimensions of (n x - sums)^2, exact; None beyond 64 bits."""
    total = max(map(abs, sums), default=0)
    if n * int(np.abs(x).max(initial=0)) + total < _LONG:
        gap = n * x - np.array(sums, np.int64)
        if int(np.abs(gap).max(initial=0)) ** 2 * x.shape[1] < _LONG:
            return (gap * gap).sum(1).tolist()
        gap = gap.astype(object)
    else:
        gap = x.astype(object) * n - np.array(sums, object)
    found = (gap * gap).sum(1).tolist()
    return [s if s < _LONG else None for s in found]


def _moments(project, dim: int):
    """Count, mean and centred second moments of the projected rows, one row a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, m = 0, None, None
        for b in batches:
            y = project(_matrix(b, dim))
            if len(y):
                part = _moment(y)
                n, mean, m = part if n == 0 else _add_moments((n, mean, m), part)
        if n:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([TaskContext.get().partitionId()], pa.int64()), "n": pa.array([n], pa.int64()),
                "mean": [mean], "m": [m.ravel()]})
    return run


def _moment(y: np.ndarray) -> tuple[int, np.ndarray, np.ndarray]:
    mean = y.mean(0)
    return len(y), mean, (y - mean).T @ (y - mean)


def _add_moments(a: tuple, b: tuple) -> tuple[int, np.ndarray, np.ndarray]:
    gap, n = b[1] - a[1], a[0] + b[0]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


def _merge_moments(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("part")
    found = None
    for n, mean, m in zip(rows["n"], rows["mean"], rows["m"], strict=True):
        mean = np.array(mean, float)
        part = int(n), mean, np.array(m, float).reshape(len(mean), len(mean))
        found = part if found is None else _add_moments(found, part)
    return pd.DataFrame({"part": [rows["part"].iloc[0] // FAN], "n": [found[0]], "mean": [found[1]],
                         "m": [found[2].ravel()]})


def _combined(parts: DataFrame, schema: str, merge):
    """The one row left when groups of ``FAN`` partial rows are merged in rounds."""
    now = staged(parts, "whitening-parts")
    while now.count() > 1:
        now = staged(now.groupBy(F.expr(f"part div {FAN}")).applyInPandas(merge, schema), "whitening-parts")
    return now.first()


def _second_moments(rows: DataFrame, project, dim: int) -> tuple[np.ndarray, int]:
    row = _combined(rows.mapInArrow(_moments(project, dim), _MATRIX), _MATRIX, _merge_moments)
    size = len(row["mean"])
    return np.array(row["m"], float).reshape(size, size) / row["n"], row["n"]


def fit_integers(rows: DataFrame, dim: int, components: int = COMPONENTS) -> Whitening | None:
    """The model of (vec_id, x) rows, None where there is none or no variance."""
    row = _combined(rows.mapInArrow(_spectra(dim), _SPECTRUM), _SPECTRUM, _merge_spectra(dim)) if dim else None
    if row is None:
        return None
    n, sums = row["n"], [int(s) for s in row["sums"]]
    basis = np.linalg.qr(_spectrum(row, dim).u)[0]

    def project(x):
        return _centred(x, n, sums) @ basis

    ritz, _ = _second_moments(rows, project, dim)
    values, turn = np.linalg.eigh((ritz + ritz.T) / 2)
    order = np.argsort(-values, kind="stable")[:components]
    order = [k for k in order if values[k] > 16 * dim * EPS * values[-1]]
    if not order or not values[-1] > 0:
        return None
    axes, _ = np.linalg.qr(basis @ turn[:, order])  # unit length again, same axes
    return Whitening(n, sums, axes, values[order], float(np.trace(ritz)))


def fit(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
        components: int = COMPONENTS) -> Whitening | None:
    return fit_integers(*integer_vectors(vectors, id_col, vector_col), components)


def _whitened(model: Whitening):
    n, sums, axes, scale = model.n, model.sums, model.axes, np.sqrt(model.values)

    def run(x: np.ndarray) -> np.ndarray:
        # summed in one order whatever the batch, so that equal rows get equal values
        return np.einsum("ij,jk->ik", _centred(x, n, sums), axes) / scale
    return run


def transform(rows: DataFrame, dim: int, model: Whitening) -> DataFrame:
    """vec_id, deviation and whitened (array of one value a component) of (vec_id, x) rows."""
    whitened, n, sums = _whitened(model), model.n, model.sums
    out = pa.schema([("vec_id", pa.int64()), ("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b, dim)
            if len(x):
                yield batch(out, b.column("vec_id"), _deviations(x, n, sums), whitened(x).tolist())
    return rows.mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def identity_error(rows: DataFrame, dim: int, model: Whitening) -> float:
    """Largest absolute entry of the whitened rows' covariance minus the identity."""
    found, _ = _second_moments(rows, _whitened(model), dim)
    return float(np.abs(found - np.eye(len(found))).max())


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
           components: int = COMPONENTS) -> DataFrame:
    """One row per vector and component: vec_id, component, n, deviation,
    whitened, explained, identity_error."""
    rows, dim = integer_vectors(vectors, id_col, vector_col)
    model = fit_integers(rows, dim, components)
    if model is None:
        return vectors.sparkSession.createDataFrame([], "vec_id long, component int, n long, deviation long, "
                                                        "whitened double, explained double, identity_error double")
    error = identity_error(rows, dim, model)
    share = F.array(*[F.lit(s) for s in model.explained])
    return (transform(rows, dim, model)
            .select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
            .select("vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model.n).cast("long").alias("n"),
                    "deviation", "whitened", F.element_at(share, F.col("at") + 1).alias("explained"),
                    F.lit(error).alias("identity_error")))
