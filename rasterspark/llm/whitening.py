"""Embedding whitening by QDWH spectral divide-and-conquer (Nakatsukasa and Higham 2013).

Tasks sum what the covariance needs; the driver has a matrix of dimensions squared, whatever the number of vectors. Its
spectrum is found by splitting: the polar factor of the covariance shifted by s is +1 on the eigenvectors above s and
-1 on those below, so (factor + 1) / 2 projects on the upper ones. A basis of each of the two subspaces is
taken from the projector, the covariance is compressed to it, and the halves are split again until each is one
component. The components go to all tasks, which project the vectors on them.

Entries are whole numbers, so sums and the covariance's numerators are exact and independent of partitions and retries.
"""

from __future__ import annotations

from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COMPONENTS, SCALE, SHIFT, SEED = 32, 64, 1_000_000, 13
#: Largest distance of an entry from the shift; larger ones are cut to it (2**46 in the embedding itself).
MAX_ENTRY = 1 << 52
#: Eigenvalues up to this share of the largest are rounding: there is nothing to divide by.
RANK = 1e-12
_EPS, _EXACT = float(np.finfo(np.float64).eps), 1 << 53


# --- the spectrum -------------------------------------------------------------------------------------------------------


def polar(a: np.ndarray, least: float) -> np.ndarray:
    """The orthogonal polar factor of symmetric ``a`` by QR-based dynamically weighted Halley iteration.

    ``least``: a lower bound of a's smallest singular value. At most some seven steps, for any condition.
    """
    n = len(a)
    top = np.linalg.norm(a, "fro")
    x, low = a / top, min(max(least / top, _EPS), 1.0)
    for _ in range(30):
        d = (4 * (1 - low * low) / low**4) ** (1 / 3)
        s = np.sqrt(1 + d)
        wa = s + 0.5 * np.sqrt(8 - 4 * d + 8 * (2 - low * low) / (low * low * s))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.concatenate([np.sqrt(wc) * x, np.eye(n)]))
        new = wb / wc * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        new = (new + new.T) / 2
        moved = np.linalg.norm(new - x, "fro")
        x, low = new, min(1.0, low * (wa + wb * low * low) / (1 + wc * low * low))
        if moved <= np.cbrt(_EPS) * 1e-3 and 1 - low < 1e-14:
            break
    return x


def _shifts(a: np.ndarray):
    """Where to cut: the middle of the diagonal for halves of about one size; the mean always has eigenvalues on both sides; then near it."""
    diagonal = np.diag(a)
    mean, wide = float(diagonal.mean()), float(np.linalg.norm(a - diagonal.mean() * np.eye(len(a)), "fro")) / np.sqrt(len(a))
    yield float(np.median(diagonal))
    for t in (0.0, 0.05, -0.05, 0.15, -0.15, 0.3, -0.3, 0.6, -0.6):
        yield mean + t * wide


def split(a: np.ndarray, rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases (upper, lower) of two invariant subspaces of symmetric ``a``; None if no cut tells its eigenvalues apart."""
    n, best = len(a), None
    size = np.linalg.norm(a, "fro")
    for shift in _shifts(a):
        moved = a - shift * np.eye(n)
        try:
            least = 1 / np.linalg.norm(np.linalg.inv(moved), "fro")
        except np.linalg.LinAlgError:
            continue  # the cut is an eigenvalue
        projector = (polar(moved, least) + np.eye(n)) / 2
        k = round(float(np.trace(projector)))
        if not 0 < k < n:
            continue
        q, _ = np.linalg.qr(np.concatenate([projector @ rng.standard_normal((n, k)), (np.eye(n) - projector) @ rng.standard_normal((n, n - k))], 1))
        q, _ = np.linalg.qr(np.concatenate([projector @ q[:, :k], q[:, k:] - projector @ q[:, k:]], 1))  # once more: a power step cleans both
        left = np.linalg.norm(q[:, k:].T @ a @ q[:, :k], "fro")
        if best is None or left < best[0]:
            best = left, q[:, :k], q[:, k:]
        if left <= 4 * n * _EPS * size:
            break
    if best is None or best[0] > np.sqrt(_EPS) * size:
        return None
    return best[1], best[2]


def spectrum(a: np.ndarray, most: int, seed: int = SEED) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of symmetric ``a``: the ``most`` largest, falling; upper halves are split first and what isn't wanted is never split."""
    rng, values, vectors = np.random.default_rng(seed), [], []
    todo = [np.eye(len(a))]
    while todo and len(values) < most:
        basis = todo.pop()
        part = basis.T @ a @ basis
        part = (part + part.T) / 2
        n = len(part)
        spread = np.linalg.norm(part - np.trace(part) / n * np.eye(n), "fro")
        halves = None if n == 1 or spread <= n * _EPS * np.linalg.norm(part, "fro") else split(part, rng)
        if halves is None:  # one eigenvalue: any basis of the subspace is one of eigenvectors
            for j in range(n):
                values.append(float(part[j, j]))
                vectors.append(basis[:, j])
        else:
            todo += [basis @ halves[1], basis @ halves[0]]
    order = np.argsort(-np.array(values), kind="stable")[:most]
    return np.array(values)[order], np.stack(vectors, 1)[:, order] if values else np.zeros((len(a), 0))


# --- the data -----------------------------------------------------------------------------------------------------------


def usable(vectors: DataFrame, vector_col: str, dim: int) -> DataFrame:
    """Rows whose vector is there, has ``dim`` entries and no null or non-finite one."""
    v = F.col(vector_col)
    bad = F.exists(v, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    return vectors.where(v.isNotNull() & (F.size(v) == dim) & ~F.coalesce(bad, F.lit(True)))


def _entries(column: pa.Array, dim: int) -> np.ndarray:
    """The batch's vectors as whole numbers, a row each."""
    flat = np.asarray(column.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dim)
    return np.clip(np.floor(SCALE * flat), -MAX_ENTRY, MAX_ENTRY).astype(np.int64) + SHIFT


def _sums(dim: int):
    def run(batches):
        n, s, low, high = 0, np.zeros(dim, object), None, None
        for b in batches:
            x = _entries(b.column(0), dim)
            if len(x):
                n += len(x)
                s += x.sum(0).astype(object) if np.abs(x).max() < 1 << 40 else x.astype(object).sum(0)
                lo, hi = x.min(0), x.max(0)
                low, high = (lo, hi) if low is None else (np.minimum(low, lo), np.maximum(high, hi))
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), pa.array([str(v) for v in s]), pa.array(low), pa.array(high)], ["i", "n", "s", "low", "high"])

    return run


def _products(dim: int, centre: np.ndarray, reach: int):
    """Per task: sums over rows of the products of centred entries, exact where a product and a block of them fit in 53 bits."""
    block = max(1, min(1 << 14, _EXACT // max(1, reach * reach)))

    def run(batches):
        exact = reach * reach < _EXACT
        total = np.zeros((dim, dim), object if exact else np.float64)
        some = False
        for b in batches:
            y = (_entries(b.column(0), dim) - centre).astype(np.float64)
            for i in range(0, len(y), block):
                part = y[i : i + block].T @ y[i : i + block]
                total += part.astype(np.int64).astype(object) if exact else part
                some = True
        if some:
            shown = pa.array([[str(v) for v in row] for row in total], pa.list_(pa.string())) if exact else pa.array(list(total))
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), shown], ["i", "row"])

    return run


def covariance(rows: DataFrame, dim: int) -> dict | None:
    """n, sums, extremes, and the covariance (divisor n) of the vectors of ``rows(v)``; None without rows.

    Entries are centred at the whole number next to their mean before they are multiplied, and what the mean differs
    from it is taken off in exact fractions, so the covariance is right to the last bit; entries that are too far
    apart for that (2**26) are centred and summed in doubles.
    """
    sums = rows.mapInArrow(_sums(dim), "i int, n long, s string, low long, high long")
    sums = sums.groupBy("i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.min("low").alias("low"), F.max("high").alias("high")).orderBy("i").collect()
    if not sums:
        return None
    n, s = sums[0].n, [int(r.s) for r in sums]
    low, high = (np.array([r[k] for r in sums], np.int64) for k in ("low", "high"))
    centre = np.array([round(Fraction(v, n)) for v in s], np.int64)
    reach = int(max((high - centre).max(), (centre - low).max()))
    exact = reach * reach < _EXACT
    kind = "decimal(38,0)" if exact else "double"
    parts = rows.mapInArrow(_products(dim, centre, reach), f"i int, row array<{'string' if exact else 'double'}>")
    cells = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum(F.col("v").cast(kind)).alias("v")).collect()
    if exact:
        p, off = np.zeros((dim, dim), object), [v - n * int(c) for v, c in zip(s, centre)]
        for r in cells:
            p[r.i, r.j] = int(r.v)
        v = np.array([[float(Fraction(n * p[i, j] - off[i] * off[j], n * n)) for j in range(dim)] for i in range(dim)])
    else:
        p, off = np.zeros((dim, dim)), np.array([float(Fraction(x, n) - int(c)) for x, c in zip(s, centre)])
        for r in cells:
            p[r.i, r.j] = r.v
        v = p / n - np.outer(off, off)
    return {"n": n, "sums": s, "low": low, "high": high, "covariance": (v + v.T) / 2}


def _project(x: np.ndarray, fit: dict) -> np.ndarray:
    """Whitened coordinates of a batch: centred, projected, divided by the spread."""
    return ((x - fit["whole"]).astype(np.float64) - fit["rest"]) @ fit["to"]


def _check(dim: int, fit: dict):
    def run(batches):
        k = fit["to"].shape[1]
        total, mean, some = np.zeros((k, k)), np.zeros(k), False
        for b in batches:
            w = _project(_entries(b.column(0), dim), fit)
            total, mean, some = total + w.T @ w, mean + w.sum(0), True
        if some:
            yield pa.RecordBatch.from_arrays([pa.array(range(k), pa.int32()), pa.array(mean), pa.array(list(total))], ["i", "m", "row"])

    return run


def _output(dim: int, fit: dict, wide: bool):
    n, k = fit["n"], fit["to"].shape[1]
    s = np.array(fit["sums"], object)
    small = None if wide else np.array(fit["sums"], np.int64)

    def run(batches):
        for b in batches:
            x = _entries(b.column(1), dim)
            for i in range(0, len(x), 1024):
                part = x[i : i + 1024]
                if wide:
                    deviation = [str(v) for v in ((n * part.astype(object) - s) ** 2).sum(1)]
                else:
                    deviation = ((n * part - small) ** 2).sum(1)
                m = len(part)
                ids = pa.array(np.repeat(np.arange(i, i + m), k))
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).take(ids), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)), pa.array(deviation).take(pa.array(np.repeat(np.arange(m), k))), pa.array(_project(part, fit).ravel()), pa.array(np.tile(fit["explained"], m))],
                    ["vec_id", "component", "deviation", "whitened", "explained"],
                )

    return run


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): a row per usable vector and component.

    Rows whose vector is null or has null or non-finite entries are dropped, and those of another length than most have
    (ties: the longer), and of length 0. An entry c becomes floor(64 c) + 1,000,000; ``deviation`` is a long, or a decimal where the largest
    would not fit one. Repeated rows are rows, and count as often; null ids stay; equal eigenvalues (ties) are numbered in
    an order that is the same for all rows; directions without spread are no components, so vectors that are all
    alike give no rows, as does an empty table; extra columns are ignored.
    """
    schema = "vec_id long, component int, deviation {}, whitened double, explained double"
    v = F.transform(F.col(vector_col), lambda c: c.cast("double"))
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), v.alias("v"))
    finish = lambda d, n, e: d.select("vec_id", "component", F.lit(n).cast("long").alias("n"), "deviation", "whitened", "explained", F.lit(e).cast("double").alias("identity_error"))
    lengths = rows.where("v is not null").groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    dim = lengths.d if lengths else 0
    rows = usable(rows, "v", dim)
    fit = covariance(rows.select("v"), dim) if dim > 0 else None
    if fit is not None:
        values, directions = spectrum(fit["covariance"], components)
        trace = float(np.trace(fit["covariance"]))
        real = values > RANK * max(float(values[0]), 0.0) if len(values) else np.zeros(0, bool)
    if fit is None or not real.any():
        return finish(vectors.sparkSession.createDataFrame([], schema.format("long")), 0, None)
    values, directions = values[real], directions[:, real]
    # the mean in two parts, so that the far shift takes no digits of it
    whole = np.array([v // fit["n"] for v in fit["sums"]], np.int64)
    rest = np.array([float(Fraction(v % fit["n"], fit["n"])) for v in fit["sums"]])
    known = {"n": fit["n"], "sums": fit["sums"], "whole": whole, "rest": rest, "to": directions / np.sqrt(values), "explained": values / trace}
    k, n = len(values), fit["n"]
    parts = rows.select("v").mapInArrow(_check(dim, known), "i int, m double, row array<double>")
    got = parts.groupBy("i").agg(F.sum("m").alias("m"), F.array(*[F.sum(F.col("row")[j]) for j in range(k)]).alias("row")).collect()
    mean, square = np.zeros(k), np.zeros((k, k))
    for r in got:
        mean[r.i], square[r.i] = r.m / n, np.array(r.row) / n
    error = float(np.abs(square - np.outer(mean, mean) - np.eye(k)).max())
    most = sum(max(abs(n * int(a) - s), abs(n * int(b) - s)) ** 2 for a, b, s in zip(fit["low"], fit["high"], fit["sums"]))
    wide = most >= 1 << 63 or max(abs(int(a)) for a in (*fit["low"], *fit["high"])) * n >= 1 << 63
    out = rows.mapInArrow(_output(dim, known, wide), schema.format("string" if wide else "long"))
    if wide:
        out = out.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))
    return finish(out, n, error)
