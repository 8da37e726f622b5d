"""Whitening of embeddings by an incremental eigendecomposition.

Each partition follows the eigendecomposition of its own scatter by one centred rank-one update
per vector; spectra are combined, some at a time, by further rank-one updates (see `spectra`). The
basis that results is refined by one distributed Rayleigh-Ritz step: the covariance of the vectors
projected on it, centred before multiplying, is summed over all rows and diagonalized. What meets
in one place has the size of a few d x d matrices, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplog.llm.common import prepared, stage
from shiplog.llm.spectra import Spectrum

#: Spectra that one task combines.
COMBINED = 16
SPECTRUM = (
    "part bigint, n bigint, sums array<bigint>, mean array<double>, basis_values array<double>, "
    "basis array<double>"
)
MOST_LONG = float(2**63)


def lattice(rows: DataFrame, key: str, vector: str, scale: int, offset: int) -> DataFrame:
    """(key, vector): vectors without null or non-finite entries, of the table's dimension.

    The dimension is the most frequent length of such vectors, the greater one of two. An entry c
    becomes floor(scale * c) + offset.
    """
    numbers = F.col(vector).cast("array<double>")
    whole = rows.select(F.col(key).alias("key"), numbers.alias("vector")).filter(
        F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
        & (F.size("vector") > 0)
    )
    sizes = whole.groupBy(F.size("vector").alias("dim")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("dim")).first()
    points = whole.filter(F.size("vector") == (top["dim"] if top else 0))
    return points.withColumn(
        "vector",
        F.transform("vector", lambda c: (F.floor(c * scale) + offset).cast("bigint")),
    )


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _packed(part: int, s: Spectrum) -> list:
    arrays = s.sums, s.mean, s.values, s.vectors.ravel()
    return [part, s.n, *(a.tolist() for a in arrays)]


def _unpacked(row) -> Spectrum:
    d = len(row.sums)
    return Spectrum(
        int(row.n),
        np.array(row.sums, np.int64),
        np.array(row.mean),
        np.array(row.basis_values),
        np.array(row.basis).reshape(d, d),
    )


def _spectra(points: DataFrame) -> DataFrame:
    """The spectrum of each partition."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(0)[0].as_py()
            x = _matrix(batch.column(1))
            held = held or Spectrum.nothing(x.shape[1])
            for row in x:
                held.add(row)
        if held is not None:
            names = [c.split()[0] for c in SPECTRUM.split(", ")]
            rows = {c: [v] for c, v in zip(names, _packed(part, held), strict=True)}
            yield pa.RecordBatch.from_pydict(rows)

    numbered = points.select(F.spark_partition_id().cast("bigint").alias("part"), "vector")
    return numbered.mapInArrow(run, SPECTRUM)


def _combined(group: pd.DataFrame) -> pd.DataFrame:
    rows = list(group.sort_values("part").itertuples())
    total = _unpacked(rows[0])
    for row in rows[1:]:
        total.absorb(_unpacked(row))
    names = [c.split()[0] for c in SPECTRUM.split(", ")]
    return pd.DataFrame([_packed(int(rows[0].part) // COMBINED, total)], columns=names)


def spectrum(points: DataFrame) -> Spectrum | None:
    """The spectrum of all rows of a table of lattice points; None if it has none.

    Partitions first, then groups of their spectra, level by level, each written to the shared
    folder; only the last one comes to the driver.
    """
    level = stage(_spectra(points), "spectra")
    while not level.isEmpty():
        if level.agg(F.max("part")).first()[0] == 0:
            return _unpacked(level.first())
        groups = level.groupBy(F.expr(f"part div {COMBINED}").alias("group"))
        level = stage(groups.applyInPandas(_combined, SPECTRUM), "spectra")
    return None


def ritz(points: DataFrame, total: Spectrum, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """The greatest eigenvalues of the covariance (divisor n), their unit vectors, and its trace.

    The products of the centred rows' coordinates in the basis of `total` are summed entry by
    entry over the tasks; d (d + 1) / 2 sums come to the driver.
    """
    basis, _ = np.linalg.qr(total.vectors[:, ::-1])
    n, sums = total.n, total.sums
    rows, columns = np.triu_indices(len(sums))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gram = np.zeros((len(sums), len(sums)))
        for batch in batches:
            if batch.num_rows:
                y = _centred(_matrix(batch.column(0)), n, sums) @ basis
                gram += y.T @ y
        yield pa.RecordBatch.from_arrays(
            [pa.array(rows), pa.array(columns), pa.array(gram[rows, columns])], ["i", "j", "value"]
        )

    parts = points.select("vector").mapInArrow(run, "i bigint, j bigint, value double")
    h = np.zeros((len(sums), len(sums)))
    for r in parts.groupBy("i", "j").agg(F.sum("value").alias("value")).collect():
        h[r.i, r.j] = h[r.j, r.i] = r.value / n
    values, turn = np.linalg.eigh(h)
    best = np.argsort(-values, kind="stable")[:count]
    return values[best], basis @ turn[:, best], float(np.trace(h))


def _centred(x: np.ndarray, n: int, sums: np.ndarray) -> np.ndarray:
    """x - sums / n, from the exact difference of integers where 64 bits hold it."""
    if n * max(int(np.abs(x).max()), 1) < 2**62:
        return (n * x - sums) / n
    return x - sums / n


def _deviations(x: np.ndarray, n: int, sums: np.ndarray) -> list[int | None]:
    """Sums of (n x - sums)^2, exact; None beyond 64 bits."""
    near = ((float(n) * x - sums) ** 2).sum(axis=1)
    if n * float(np.abs(x).max()) < MOST_LONG / 4 and (near < MOST_LONG / 2).all():
        return ((n * x - sums) ** 2).sum(axis=1).tolist()
    exact = [sum((n * int(a) - int(s)) ** 2 for a, s in zip(r, sums, strict=True)) for r in x]
    return [e if e < 2**63 else None for e in exact]


def whitened(
    rows: DataFrame,
    key: str = "vec_id",
    vector: str = "embedding",
    components: int = 8,
    scale: int = 1024,
    offset: int = 100_000,
) -> DataFrame:
    """(key, n, deviation, whitened, explained, identity_error): a row per usable vector.

    Entries are put on the lattice floor(scale * c) + offset. `whitened` has the coordinates of
    the centred vector along the first `components` unit eigenvectors of the covariance, by falling
    eigenvalue, each over the root of its eigenvalue; `explained` the eigenvalues' shares of the
    trace. `deviation` is the sum of (n x - S)^2 over the dimensions, exact; null beyond 64 bits.
    `identity_error` is the largest entry of the whitened rows' covariance minus the identity.

    Vectors that are null, empty, hold null or non-finite entries, or have another length than most
    are left out. Repeated rows count as often as they stand there; null keys stay; an empty table,
    or one without a usable vector, gives an empty one. Components without variance (eigenvalue
    below 1e-12 of the greatest) have null coordinates and take no part in `identity_error`, which is
    null if none is left. With fewer dimensions than `components`, all of them are given. Other
    columns, whatever their names, are not read.
    """
    spark = prepared(rows.sparkSession)
    kind = rows.select(F.col(key)).schema[0].dataType.simpleString()
    points = lattice(rows, key, vector, scale, offset)
    total = spectrum(points)
    result = f"key {kind}, deviation bigint, whitened array<double>"
    if total is None:
        found, values, shares = spark.createDataFrame([], result), np.zeros(0), []
    else:
        values, vectors, trace = ritz(points, total, components)
        alive = values > 1e-12 * max(float(values[0]), 1e-300)
        shares = (np.maximum(values, 0) / trace if trace > 0 else 0 * values).tolist()
        weights = vectors / np.sqrt(np.where(alive, values, 1.0))
        n, sums = total.n, total.sums

        def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if not batch.num_rows:
                    continue
                x = _matrix(batch.column(1))
                y = _centred(x, n, sums) @ weights
                empty = np.broadcast_to(~alive, y.shape).ravel()
                ends = np.arange(len(x) + 1, dtype=np.int32) * y.shape[1]
                flat = pa.array(y.ravel(), mask=empty)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array(_deviations(x, n, sums), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends), flat),
                    ],
                    ["key", "deviation", "whitened"],
                )

        found = stage(points.mapInArrow(run, result), "whitened")
        values = values[alive]
    return found.select(
        F.col("key").alias(key),
        F.lit(total.n if total else 0).cast("bigint").alias("n"),
        "deviation",
        "whitened",
        F.array(*map(F.lit, shares)).cast("array<double>").alias("explained"),
        F.lit(_identity_error(found, len(values))).cast("double").alias("identity_error"),
    )


def _identity_error(found: DataFrame, count: int) -> float | None:
    """Of the covariance of the first `count` whitened coordinates, which have variance."""
    pairs = [(i, j) for i in range(count) for j in range(i, count)]
    if not pairs:
        return None
    one = [F.col("whitened")[i] for i in range(count)]
    covariances = [F.covar_pop(one[i], one[j]).alias(f"c{i}_{j}") for i, j in pairs]
    row = found.agg(*covariances).first()
    return max(abs(c - (i == j)) for c, (i, j) in zip(row, pairs, strict=True))


def component_rows(found: DataFrame) -> DataFrame:
    """A row per vector and component, numbered from 1."""
    both = F.arrays_zip("whitened", "explained")
    each = found.select("vec_id", "n", "deviation", "identity_error", F.posexplode(both))
    return each.select(
        "vec_id",
        (F.col("pos") + 1).alias("component"),
        "n",
        "deviation",
        F.col("col")["whitened"].alias("whitened"),
        F.col("col")["explained"].alias("explained"),
        "identity_error",
    )
