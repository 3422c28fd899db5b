"""Quality scores: random Fourier features, ridge regression, isotonic calibration.

Statistics of each whole text become standardised features, which are inputs of the regression themselves; cosines of random projections approximate a
Gaussian kernel over them (Rahimi and Recht 2007). Each partition sums its part of the normal equations,
the parts are summed by row over all tasks, and the driver solves one system whose size does not depend on the
data. The scores of a held-back quarter of the training rows are binned and made monotone by pooling
adjacent violators; between bins the calibrated score is interpolated.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, small_batches

FOURIER, RIDGE, SEED, BINS = 300, 1e-3, 11, 400
#: Tasks that sum equations: each ships a matrix of fixed size, so their number bounds what is shuffled.
PARTS = 256
FEATURES = ("bytes", "words", "lines", "word_length", "longest", "distinct", "repeated", "top", "repeated_lines", "short_lines", "capitals", "digits", "others", "stops", "commas", "exclaims", "bars", "marks", "shouted", "closed")
_MARKS = np.zeros(256, bool)
_MARKS[list(b"#$%&*@<>{}[]\\^~=+_/")] = True


def statistics(text: str | None) -> list[float]:
    """The features of one text, each bounded or on a log scale; a null text has those of an empty one."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = data.split()
    lines = [x for x in data.split(b"\n") if x.strip()]
    n, w, k = max(1, len(data)), max(1, len(words)), max(1, len(lines))
    count = np.bincount(np.frombuffer(data, np.uint8), minlength=256)
    common = Counter(words)
    letters = max(1, int(count[65:91].sum() + count[97:123].sum()))
    return [
        np.log1p(len(data)),
        np.log1p(len(words)),
        np.log1p(len(lines)),
        np.log1p(sum(map(len, words)) / w),
        np.log1p(max(map(len, words), default=0)),
        len(common) / w,
        sum(a == b for a, b in zip(words, words[1:])) / w,
        max(common.values(), default=0) / w,
        1 - len(set(lines)) / k if lines else 0.0,
        sum(len(x) < 30 for x in lines) / k,
        count[65:91].sum() / letters,
        count[48:58].sum() / n,
        count[128:].sum() / n,
        count[46] / w,
        count[44] / w,
        (count[33] + count[63]) / w,
        count[124] / w,
        count[_MARKS].sum() / w,
        sum(x.isupper() for x in words) / w,
        sum(x.rstrip().endswith((b".", b"!", b"?")) for x in lines) / k,
    ]


def _measure(batches):
    for b in batches:
        x = np.array([statistics(t) for t in b.column(1).to_pylist()], np.float64).reshape(-1, len(FEATURES))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))], ["doc_id", "x"])


def _matrix(column) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(len(column), -1)


class Map:
    """Standardised features to themselves, their random cosines and a one."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray, size: int = FOURIER, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.mean, self.spread, self.d = mean, np.where(spread > 1e-9, spread, 1.0), len(mean)
        self.w = rng.standard_normal((self.d, size)) / np.sqrt(self.d)
        self.shift = rng.uniform(0, 2 * np.pi, size)

    def __call__(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -6, 6)
        return np.hstack([z, np.sqrt(2 / len(self.shift)) * np.cos(z @ self.w + self.shift), np.ones((len(z), 1))])


def _equations(map_: Map):
    """The partition's sums: row i of Z'Z with the i-th of Z'y behind it."""

    def run(batches):
        total = None
        for b in batches:
            z = map_(_matrix(b.column(0)))
            y = np.asarray(b.column(1)).astype(np.float64)
            part = np.hstack([z.T @ z, (z.T @ y)[:, None]])
            total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total)), pa.int32()), pa.array(list(total))], ["i", "row"])

    return run


def _sum_rows(batches):
    total: dict[int, np.ndarray] = {}
    for b in batches:
        for i, row in zip(b.column(0).to_pylist(), _matrix(b.column(1))):
            total[i] = total[i] + row if i in total else row.copy()
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array(list(total.values()))], ["i", "row"])


def isotonic(weight: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Least-squares non-decreasing fit by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for w, v in zip(weight.tolist(), value.tolist()):
        blocks.append([w, v, 1])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w2, v2, n2 = blocks.pop()
            w1, v1, n1 = blocks[-1]
            blocks[-1] = [w1 + w2, (w1 * v1 + w2 * v2) / (w1 + w2), n1 + n2]
    return np.concatenate([np.full(int(n), v) for _, v, n in blocks]) if blocks else np.zeros(0)


def _score(map_: Map | None, solution, knots, values):
    def run(batches):
        for b in batches:
            n = b.num_rows
            raw = np.full(n, 0.5) if map_ is None else map_(_matrix(b.column(2))) @ solution
            score = np.interp(raw, knots, values) if len(knots) else np.clip(raw, 0, 1)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(np.clip(score, 0, 1)), pa.array(raw)], ["doc_id", "held_out", "score", "raw"])

    return run


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", fourier: int = FOURIER, ridge: float = RIDGE, seed: int = SEED) -> DataFrame:
    """(doc_id, held_out, score, predicted): one row per row of ``docs``.

    Rows whose crc32(doc_id as text) mod 3 is 1 are held out: their labels are never read. All other labelled rows
    take part, three quarters in the regression and one in the calibration. Null and empty texts get the score of
    an empty text; very long ones are measured whole; repeated rows are scored each; a null id is not held out; null labels
    count for nothing; without any label every score is 0.5; extra columns are ignored; an empty table gives an empty result.
    """
    small_batches(docs)
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    x = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(_measure, "doc_id long, x array<double>")
    x = materialise(x, "statistics").withColumn("held_out", F.coalesce(fold == 1, F.lit(False)))
    known = x.where("not held_out").join(labels.where("quality is not null").select("doc_id", F.col("quality").cast("double").alias("y")), "doc_id")
    known = materialise(known.select("x", "y", (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).alias("later")), "labelled")
    sums = known.where("not later").agg(F.count("*"), *[f(F.get("x", F.lit(i))) for i in range(len(FEATURES)) for f in (F.avg, F.stddev_pop)]).first()
    map_, solution, knots, values = None, None, np.zeros(0), np.zeros(0)
    if sums[0]:
        map_ = Map(np.array(sums[1::2]), np.array(sums[2::2]), fourier, seed)
        parts = known.where("not later").select("x", "y").coalesce(PARTS).mapInArrow(_equations(map_), "i int, row array<double>")
        rows = parts.repartition("i").mapInArrow(_sum_rows, "i int, row array<double>").collect()  # one system, of a fixed size
        a = np.array([r.row for r in sorted(rows, key=lambda r: r.i)])
        a, b = a[:, :-1], a[:, -1]
        solution = np.linalg.solve(a + ridge * sums[0] * np.eye(len(a)), b)
        raw = known.where("later").select(F.lit(None).cast("long").alias("doc_id"), (F.col("y") > 0.5).alias("y"), "x")
        binned = raw.mapInArrow(_score(map_, solution, knots, values), "doc_id long, held_out boolean, score double, raw double")
        binned = binned.groupBy(F.round(F.least(F.greatest("raw", F.lit(-1.0)), F.lit(2.0)) * BINS).alias("bin")).agg(F.count("*").alias("n"), F.avg(F.col("held_out").cast("double")).alias("y")).collect()
        if binned:  # at most 3 * BINS + 1 bins
            binned = sorted(binned, key=lambda r: r.bin)
            knots = np.array([r.bin for r in binned]) / BINS
            values = isotonic(np.array([r.n for r in binned], float), np.array([r.y for r in binned], float))
    out = x.select("doc_id", "held_out", "x").mapInArrow(_score(map_, solution, knots, values), "doc_id long, held_out boolean, score double, raw double")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
