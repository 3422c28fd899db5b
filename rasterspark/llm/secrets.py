"""Secret scans: patterns, and a character network over every other candidate.

Three patterns give the base findings. All other candidates, unbroken strings of 16 characters or more, and what
findings leave of those they overlap, go with their surroundings through a convolutional network in numpy.

The network is trained on all different labelled strings: those that a base finding covers, and secrets of
other formats made at random (``FORMATS``), planted in the surroundings of the corpus's own strings, against strings that
no finding covers and made-up harmless ones. What leads a pattern to its finding is blanked, so the string itself has
to tell. Strings are dealt by hash to shards of about ``SHARD`` of either label, as many as it takes. In each of ``ROUNDS`` rounds every shard
trains the network on from the mean of all shards' last ones, going through all its examples. Formats are left out in turn: networks trained
without them score them, Platt scaling turns scores into probabilities, and the threshold is the highest that keeps the
wanted recall on each format that was never seen. Scaling and thresholds come from counts of all scores, by 1/1024 of a logit.
"""

from __future__ import annotations

import functools
import hashlib
import re

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, small_batches

KINDS = ("assign", "access", "hex", "net")
SHARD, MADE, FOLDS, ROUNDS, STEPS, MEMBERS, RECALL, SEED = 3000, 250, 3, 4, 75, 3, 0.95, 5
GRID, FIXED = 1024, (1 << 36, 1 << 40, 1 << 50)
#: Tasks of a round of training: as many at least where there are so many shards and networks, and shards of a task where there are more.
TASKS, BUNDLE = 96, 4
LEFT, PIECE, RIGHT = 24, 64, 16
_CUE = re.compile(r"""(?:password|passwd|secret|token|api_?key)["']?\x20*[:=]?\x20*["']?""", re.IGNORECASE | re.ASCII)
_UPPER, _LOWER, _DIGITS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
_ALNUM = _UPPER + _LOWER + _DIGITS
#: Formats of secrets to learn from: (prefix, (alphabet, least, most length), ...) in turn; a lone string is put in as it is.
FORMATS = {
    "tagged": ("ghp_", (_ALNUM, 36, 36)),
    "dashed": ("xoxb-", (_DIGITS, 11, 13), "-", (_DIGITS, 11, 13), "-", (_ALNUM, 24, 24)),
    "live": ("sk_live_", (_ALNUM, 24, 32)),
    "base64": ((_ALNUM + "+/", 38, 64),),
    "padded": ((_ALNUM + "+/", 30, 62), "=="),
    "mixed": ((_UPPER + _LOWER, 16, 40),),
    "lower": ((_LOWER, 20, 40),),
    "base32": ((_UPPER + "234567", 20, 52),),
    "dotted": ("eyJ", (_ALNUM, 16, 24), ".", (_ALNUM + "_", 30, 60), ".", (_ALNUM + "_-", 43, 43)),
    "alnum": ((_ALNUM, 16, 48),),
    "lower36": ((_LOWER + _DIGITS, 20, 50),),
    "blocks": (("0123456789ABCDEF", 8, 8), "-", ("0123456789ABCDEF", 4, 8), "-", ("0123456789ABCDEF", 4, 8), "-", ("0123456789ABCDEF", 8, 12)),
}
_ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
_ACCESS, _HEX, _CANDIDATE = r"AKIA[A-Z0-9]+", r"[0-9a-f]{16,}", r"[A-Za-z0-9+/_.=-]{16,}"
_HINT = r"[0-9]|(?i:passw|secret|token|api_?key)|AKIA|[0-9a-f]{16}|[A-Za-z0-9+/_.=-]{16}"


def base_findings(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) by start, then kind as listed."""
    out = [(m.start(), m.end(), 0) for m in re.finditer(_ASSIGN, text, re.IGNORECASE | re.ASCII) if len(m[2]) >= 12]
    out += [(m.start(), m.end(), 1) for m in re.finditer(_ACCESS, text) if len(m[0]) >= 18]
    out += [(m.start(), m.end(), 2) for m in re.finditer(_HEX, text)]  # a run of these characters is matched whole
    return [(s, e, KINDS[k]) for s, e, k in sorted(out, key=lambda x: (x[0], x[2]))]


def _pieces(text: str, s: int, e: int) -> list[str]:
    """The candidate with its surroundings, in pieces of PIECE characters; \\1 and \\2 mark where it begins and ends."""
    out = []
    for a in range(s, e, PIECE):
        b = min(e, a + PIECE)
        out.append(text[max(0, a - LEFT) : a].replace("\1", " ").replace("\2", " ") + "\1" + text[a:b] + "\2" + text[b : b + RIGHT].replace("\1", " ").replace("\2", " "))
    return out


def _scan(batches):
    """For each text its base findings and its candidates; label 1 where a base finding overlaps, -1 for what it leaves: asked, but no example."""
    for b in batches:
        may = pc.match_substring_regex(pc.fill_null(b.column(1), ""), _HINT).to_pylist()
        base, cands = [], []
        for text, look in zip(b.column(1).to_pylist(), may):
            found = base_findings(text) if look else []
            rows = []
            for m in re.finditer(_CANDIDATE, text) if look else ():
                s, e = m.span()
                over = [(x, y) for x, y, _ in found if x < e and s < y]
                rows += [{"s": s, "e": e, "label": int(bool(over)), "piece": p} for p in _pieces(text, s, e)]
                for x, y in sorted([*over, (e, e)]) if over else ():
                    if x - s >= 16:
                        rows += [{"s": s, "e": x, "label": -1, "piece": p} for p in _pieces(text, s, x)]
                    s = max(s, y)
            base.append([{"s": s, "e": e, "kind": k} for s, e, k in found])
            cands.append(rows)
        span = pa.struct([("s", pa.int32()), ("e", pa.int32()), ("kind", pa.string())])
        cand = pa.struct([("s", pa.int32()), ("e", pa.int32()), ("label", pa.int32()), ("piece", pa.string())])
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(base, pa.list_(span)), pa.array(cands, pa.list_(cand))], ["doc_id", "base", "cands"])


def _codes(pieces: list[str]) -> np.ndarray:
    """Characters as numbers: 1 to 127 around the candidate, 129 to 255 in it, 0 behind the end."""
    out = np.zeros((len(pieces), LEFT + PIECE + RIGHT), np.int64)
    for row, p in zip(out, pieces):
        left, _, rest = p.partition("\1")
        mid, _, right = rest.partition("\2")
        x = np.frombuffer((left + mid + right).encode("ascii", "replace"), np.uint8).astype(np.int64)
        x[len(left) : len(left) + len(mid)] += 128
        row[: len(x)] = x
    return out


@functools.cache
def _keep_blocks() -> None:
    """Make the C library keep freed blocks of up to 30 MB for this process: a step's arrays are else got from the system anew, page by page, each time.

    A block of that size, freed at once, raises its limits (glibc; elsewhere nothing happens). None of its pages is touched.
    """
    np.empty(30 << 20, np.uint8)


class Network:
    """Embedding, one convolution, its maximum over all positions and its mean over the candidate's, one linear unit; trained by Adam."""

    WIDTH, DEPTH, FILTERS = 4, 8, 24

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.p = {
            "emb": rng.normal(0, 0.5, (256, self.DEPTH)),
            "w": rng.normal(0, (self.WIDTH * self.DEPTH) ** -0.5, (self.WIDTH * self.DEPTH, self.FILTERS)),
            "b": np.zeros(self.FILTERS),
            "v": rng.normal(0, self.FILTERS**-0.5, 2 * self.FILTERS),
            "c": np.zeros(1),
        }
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.m, self.s = ({k: np.zeros_like(v) for k, v in self.p.items()} for _ in range(2))
        self.scale, self.offset, self.threshold = 1.0, 0.0, 2.0

    def _forward(self, x: np.ndarray):
        """Logits and what their gradients need. Codes are cut behind the longest piece; the mean is worked out at the candidate's positions only."""
        end = min(x.shape[1], int(np.flatnonzero(x.any(0)).max(initial=0)) + 1 + self.WIDTH)  # one window behind the end is kept: all others equal it
        x, n, steps, b = x[:, :end], len(x), end - self.WIDTH + 1, self.p["b"][:, None]
        e = self.p["emb"].T.take(x, axis=1, mode="clip")
        cols = np.empty((self.WIDTH, self.DEPTH, n, steps), np.float32)
        for i in range(self.WIDTH):
            cols[i] = e[:, :, i : i + steps]
        cols = cols.reshape(-1, n * steps)
        top = self.p["w"].T @ cols
        best = top.reshape(-1, n, steps).argmax(2) + np.arange(n) * steps
        most = np.maximum(np.take_along_axis(top, best, 1) + b, 0)
        inside = (x[:, :steps] >= 128) & (x[:, self.WIDTH - 1 :] >= 128)
        at, count = np.flatnonzero(inside), inside.sum(1)
        top = np.maximum(top.take(at, axis=1) + b, 0)
        mean, some = np.zeros_like(most), np.flatnonzero(count)
        if len(some):
            mean[:, some] = np.add.reduceat(top, (np.cumsum(count) - count)[some], axis=1) / count[some].astype(np.float32)
        h = np.concatenate([most, mean]).T
        return h @ self.p["v"] + self.p["c"][0], h, best, cols, top, at, count

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        """Those of the mean loss. A maximum hangs on one position a filter: these are summed by character first."""
        z, h, best, cols, top, at, count = self._forward(x)
        n, (width, depth, filters) = len(x), (self.WIDTH, self.DEPTH, self.FILTERS)
        steps, w, v = cols.shape[1] // n, self.p["w"], self.p["v"][:, None]
        g = ((1 / (1 + np.exp(-np.clip(z, -30, 30))) - y) / n).astype(np.float32)
        mean = (top > 0) * v[filters:]
        mean *= np.repeat(g / np.maximum(count, 1).astype(np.float32), count)
        most = (h[:, :filters] > 0).T * v[:filters] * g
        tap, codes = np.arange(width)[:, None], x.ravel()
        first = (np.arange(n)[:, None] * x.shape[1] + np.arange(steps)).ravel()
        peaks = (tap[:, :, None] * filters + np.arange(filters)[:, None]) * 256 + codes[first[best] + tap[:, :, None]]
        sums = np.bincount(peaks.ravel(), np.broadcast_to(most, peaks.shape).ravel(), width * filters * 256).reshape(width, filters, 256).astype(np.float32)
        down = (w @ mean).reshape(width, depth, -1)
        code = codes[first[at] + tap].ravel()
        emb = np.stack([np.bincount(code, down[:, i].ravel(), 256) for i in range(depth)]) + (w.reshape(width, depth, filters) @ sums).sum(0)
        grad = cols.take(at, axis=1) @ mean.T + (sums @ self.p["emb"]).transpose(0, 2, 1).reshape(w.shape)
        return {"v": h.T @ g, "c": np.array([g.sum()]), "b": mean.sum(1) + most.sum(1), "w": grad, "emb": emb.T.astype(np.float32)}

    def logits(self, x: np.ndarray) -> np.ndarray:
        _keep_blocks()
        return np.concatenate([self._forward(x[i : i + 64])[0] for i in range(0, len(x), 64)]) if len(x) else np.zeros(0)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return self.squash(self.logits(x))

    def state(self) -> np.ndarray:
        """Parameters and Adam's two moments, a row each."""
        return np.stack([np.concatenate([v.ravel() for v in part.values()]) for part in (self.p, self.m, self.s)]).astype(np.float64)

    def load(self, state: np.ndarray) -> Network:
        ends = np.cumsum([v.size for v in self.p.values()])[:-1]
        self.p, self.m, self.s = ({k: v.reshape(self.p[k].shape).astype(np.float32) for k, v in zip(self.p, np.split(row, ends))} for row in state)
        return self

    def fit(self, x: np.ndarray, y: np.ndarray, seed: int | list[int] = SEED, steps: int = 300, batch: int = 128, rate: float = 5e-3, done: int = 0) -> None:
        """``steps`` steps after ``done``, or as many as it takes to go through all examples, in an order drawn anew each time through."""
        _keep_blocks()
        rng = np.random.default_rng(seed)
        steps = max(steps, -(-len(x) // batch))
        order = np.concatenate([rng.permutation(len(x)) for _ in range(-(-steps * batch // len(x)))])
        m, s = self.m, self.s
        for t in range(1, steps + 1):
            at = order[(t - 1) * batch : t * batch]
            for k, v in self._gradients(x[at], y[at]).items():
                m[k] = 0.9 * m[k] + 0.1 * v
                s[k] = 0.999 * s[k] + 0.001 * v * v
                self.p[k] = (self.p[k] - rate * (m[k] / (1 - 0.9 ** (done + t))) / (np.sqrt(s[k] / (1 - 0.999 ** (done + t))) + 1e-8)).astype(np.float32)

    def calibrate(self, x: np.ndarray, y: np.ndarray, recall: float) -> None:
        self.scale_to(self.logits(x), y, np.ones(len(x)))
        self.threshold = float(self.squash(_kept(self.logits(x)[y > 0], np.ones(int((y > 0).sum())), recall)))

    def squash(self, z: np.ndarray | float) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.scale * np.asarray(z, np.float64) + self.offset, -30, 30)))

    def scale_to(self, z: np.ndarray, y: np.ndarray, n: np.ndarray) -> None:
        """Platt scaling by Newton steps; ``n``: how often each score and label is there."""
        good, bad = float(n[y > 0].sum()), float(n[y <= 0].sum())
        t = np.where(y > 0, (good + 1) / (good + 2), 1 / (bad + 2))
        a, b = 1.0, 0.0
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(a * z + b, -30, 30)))
            w = n * np.maximum(p * (1 - p), 1e-9)
            g = np.array([(n * (p - t) * z).sum(), (n * (p - t)).sum()])
            hess = np.array([[(w * z * z).sum(), (w * z).sum()], [(w * z).sum(), w.sum()]]) + 1e-3 * np.eye(2)
            step = np.clip(np.linalg.solve(hess, g), -2, 2)
            a, b = a - step[0], b - step[1]
        self.scale, self.offset = float(a), float(b)


class Committee(Network):
    """Networks that differ in their start: the mean of their logits, since one alone depends much on it."""

    def __init__(self, members: list[Network]):
        self.members, self.scale, self.offset, self.threshold = members, 1.0, 0.0, 2.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.mean([m.logits(x) for m in self.members], axis=0)


def _kept(z: np.ndarray, n: np.ndarray, recall: float) -> float:
    """The highest score that keeps the wanted recall; ``n``: how often each is there."""
    order = np.argsort(z)
    ahead = np.cumsum(n[order])
    return float(z[order][np.searchsorted(ahead, np.floor((1 - recall) * ahead[-1]), side="right")])


def made_secret(fmt: tuple, rng: np.random.Generator) -> str:
    """A secret of the format, drawn at random."""
    draw = lambda p: "".join(rng.choice(list(p[0]), int(rng.integers(p[1], p[2] + 1))))
    return "".join(p if isinstance(p, str) else draw(p) for p in fmt)


def _harmless(rng: np.random.Generator) -> str:
    """A long string that is none: syllables, perhaps in parts as of hosts, paths and names."""
    soft = lambda n: "".join(rng.choice(list("bcdfghlmnprstv")) + rng.choice(list("aeiou")) + rng.choice(["", "n", "r", "s"]) for _ in range(n))
    joint = rng.choice(["", "", ".", "-", "_", "/", "="])
    parts = [soft(int(rng.integers(2, 5))) for _ in range(int(rng.integers(3, 6)))]
    out = joint.join(parts) if joint else "".join(parts)
    return (out.capitalize() if rng.random() < 0.2 else out)[:PIECE].ljust(16, "a")


def _planted(secret: str, around: str) -> str:
    """The first piece of a secret with the surroundings of another piece."""
    left, _, rest = around.partition("\1")
    return f"{left}\1{secret[:PIECE]}\2{rest.partition(chr(2))[2]}"


def examples(pieces: list[list[str]], seed: int = SEED, made: int = MADE) -> tuple[list[str], list[str]]:
    """(pieces, kinds) to learn from; kind is empty where there is no secret. ``pieces``: of strings without and with a finding.

    Every other piece with a finding gets the surroundings of one without; patterns' cues are blanked in all of them.
    """
    rng, (plain, found) = np.random.default_rng(seed), pieces
    around = plain or ["\1\2"]
    words = re.findall("[A-Za-z]{3,}", " ".join(q for p in (*plain, *found) for q in (p.partition("\1")[0], p.partition("\2")[2])))

    def joined() -> str:
        """Words of the surroundings run together: as long as a secret, and none."""
        out = ""
        while len(out) < 16:
            out += words[int(rng.integers(len(words)))]
        return out

    soft = [_harmless(rng) if i % 4 == 0 or not words else joined() for i in range(6 * made)]
    out = [(p, "") for p in plain] + [(_planted(w, around[int(rng.integers(len(around)))]), "") for w in soft]
    for i, p in enumerate(found):
        p = _CUE.sub(lambda m: " " * len(m[0]), p)
        mid = p.partition("\1")[2].partition("\2")[0].strip()
        kind = "hex" if re.fullmatch("[0-9a-f]+", mid) else "access" if mid.startswith("AKIA") else "assign"
        out.append((_planted(mid, around[int(rng.integers(len(around)))]) if i % 2 else p, kind))
    for name, fmt in FORMATS.items():
        out += [(_planted(made_secret(fmt, rng), around[int(rng.integers(len(around)))]), name) for _ in range(made)]
    return [p for p, _ in out], [k for _, k in out]


NAMES = sorted({*FORMATS, *KINDS[:3]})


def shards(found: DataFrame, seed: int = SEED, size: int = SHARD) -> DataFrame:
    """(shard, codes, kinds, unsure): all different labelled pieces of ``found`` with made-up ones, in rows of about ``size`` of either label.

    kinds has 0 where there is no secret, else the place in NAMES from 1; the first ``unsure`` examples are strings that no finding
    covers. An empty ``found`` gives one row of made-up ones.
    """
    spark = found.sparkSession
    rows = found.select(F.inline("cands")).where("label >= 0").select("piece", F.col("label").alias("y")).distinct()
    rows = materialise(rows, "secrets-pieces")
    n = max([1, *(-(-r["count"] // size) for r in rows.groupBy("y").count().collect())])
    dealt = rows.select(F.pmod(F.xxhash64("piece"), F.lit(n)).alias("shard"), "piece", "y")
    dealt = dealt.union(spark.range(n).select("id", F.lit(None).cast("string"), F.lit(None).cast("int")))

    def make(key, rows):
        parts = [sorted(rows.piece[rows.y == y]) for y in (0, 1)]
        rng = np.random.default_rng([seed, key[0]])
        parts = [[p[i] for i in rng.permutation(len(p))] for p in parts]
        pieces, kinds = examples(parts, seed + key[0])
        codes = _codes(pieces).astype(np.uint8).tobytes()
        return pd.DataFrame({"shard": [key[0]], "codes": [codes], "kinds": [bytes(NAMES.index(k) + 1 if k else 0 for k in kinds)], "unsure": [len(parts[0])]})

    return materialise(dealt.repartition(n, "shard").groupBy("shard").applyInPandas(make, _SHARD), "secrets-shards")


_SHARD = "shard long, codes binary, kinds binary, unsure int"


def _parts(batches):
    """(shard, codes, kinds, unsure) of each row."""
    for b in batches:
        for shard, codes, kinds, unsure in zip(*(b.column(i).to_pylist() for i in range(4))):
            yield shard, np.frombuffer(codes, np.uint8).reshape(-1, LEFT + PIECE + RIGHT), np.frombuffer(kinds, np.uint8), unsure


def _fold(kinds: np.ndarray) -> np.ndarray:
    """The fold of each example: a secret's by its kind, so that a fold's network never saw it; others' in turn."""
    return np.where(kinds > 0, (kinds.astype(np.int64) - 1) % FOLDS, np.arange(len(kinds)) % FOLDS)


def _chosen(kinds: np.ndarray, net: int) -> np.ndarray:
    """Which examples network ``net`` is judged on; it learns from all others. The last network is the one for use."""
    return _fold(kinds) == net if net < FOLDS else np.arange(len(kinds)) % 5 == 0


def _tasks(rows: int) -> int:
    """How many tasks share ``rows`` trainings."""
    return max(min(rows, TASKS), -(-rows // BUNDLE))


def _averaged(data: DataFrame, nets: list[Network], learns, seed: int) -> None:
    """Train ``nets`` in rounds, each shard on ``learns(net, kinds, unsure)`` of its examples; means are sums of integers, so order is no matter.

    A shard travels ``ways`` times, for as many parts of the networks: with many shards once. A task gives one sum per network, of all its shards.
    """
    n = data.count()
    ways = max(1, min(len(nets), TASKS // n))
    each = data.withColumn("way", F.explode(F.sequence(F.lit(0), F.lit(ways - 1)))).repartitionByRange(_tasks(n * ways), "way", "shard")
    for turn in range(ROUNDS):
        start = [net.state() for net in nets]

        def run(batches):
            sums: dict[int, np.ndarray] = {}
            for b in batches:
                for way, (shard, x, kinds, unsure) in zip(b.column(4).to_pylist(), _parts([b])):
                    for i in range(way, len(start), ways):
                        at = learns(i, kinds, unsure)
                        net = Network(seed).load(start[i])
                        net.fit(x[at], (kinds[at] > 0).astype(float), [seed, shard, turn, i % MEMBERS], STEPS, done=turn * STEPS)
                        sums[i] = sums.get(i, 0) + np.rint(net.state() * np.array(FIXED, np.float64)[:, None]).astype(np.int64).ravel()
            for i, out in sums.items():
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(out), i)), pa.array(np.arange(len(out))), pa.array(out)], ["net", "at", "v"])

        total = np.zeros((len(nets), start[0].size))
        for r in small_batches(each).mapInArrow(run, "net long, at long, v long").groupBy("net", "at").agg(F.sum("v").alias("v")).collect():
            total[r["net"], r["at"]] = r["v"] / n
        for net, v in zip(nets, total):
            net.load(v.reshape(3, -1) / np.array(FIXED, np.float64)[:, None])


def train(found: DataFrame, recall: float = RECALL, seed: int = SEED, size: int = SHARD) -> Network:
    """The network of all examples, with the threshold of networks that each had some kinds left out.

    Strings that no finding covers may be secrets all the same: those that a network of the other examples takes for one
    are no examples.
    """
    data, fresh = shards(found, seed, size), lambda: [Network(seed + i) for i in range(MEMBERS)]
    first = Committee(fresh())
    _averaged(data, first.members, lambda i, kinds, unsure: np.arange(len(kinds)) >= unsure, seed)

    def sure(batches):
        for shard, x, kinds, unsure in _parts(batches):
            keep = np.ones(len(x), bool)
            keep[:unsure] = first.logits(x[:unsure]) < 0
            yield pa.RecordBatch.from_pylist([{"shard": shard, "codes": x[keep].tobytes(), "kinds": kinds[keep].tobytes(), "unsure": int(keep[:unsure].sum())}], pa.schema([("shard", pa.int64()), ("codes", pa.binary()), ("kinds", pa.binary()), ("unsure", pa.int32())]))

    data = materialise(small_batches(data).mapInArrow(sure, _SHARD), "secrets-sure")
    nets = [Committee(fresh()) for _ in range(FOLDS + 1)]
    _averaged(data, [m for c in nets for m in c.members], lambda i, kinds, unsure: ~_chosen(kinds, i // MEMBERS), seed)

    def score(batches):
        for _, x, kinds, _ in _parts(batches):
            for i, net in enumerate(nets):
                at = _chosen(kinds, i)
                z = np.floor(np.clip(net.logits(x[at]), -32, 32) * GRID).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(z), i)), pa.array(kinds[at].astype(np.int64)), pa.array(z)], ["net", "kind", "z"])

    counts = small_batches(data).mapInArrow(score, "net long, kind long, z long").groupBy("net", "kind", "z").count().collect()
    net, kind, z, n = np.array(sorted(tuple(r) for r in counts), np.float64).T
    z, least = z / GRID, []
    for i, judge in enumerate(nets):
        judge.scale_to(z[net == i], kind[net == i] > 0, n[net == i])
        for k in set(kind[(net == i) & (kind > 0)]) if i < FOLDS else ():
            at = (net == i) & (kind == k)
            least.append(float(judge.squash(_kept(z[at], n[at], recall))))
    nets[-1].threshold = min(least)
    return nets[-1]


def _report(net: Network):
    def run(batches):
        for b in batches:
            out = []
            docs = list(zip(*(b.column(i).to_pylist() for i in range(3))))
            asked = [(i, c) for i, (_, _, cands) in enumerate(docs) for c in cands if c["label"] <= 0]
            added = [set() for _ in docs]
            for k in range(0, len(asked), 4096):
                part = asked[k : k + 4096]
                p = net.probability(_codes([c["piece"] for _, c in part]))
                for (i, c), v in zip(part, p.tolist()):
                    if v >= net.threshold:
                        added[i].add((c["s"], c["e"]))
            for (doc_id, base, _), new in zip(docs, added):
                spans = [(x["s"], x["e"], x["kind"]) for x in base]
                name = lambda rows: ",".join(f"{k}:{s}:{e}" for s, e, k in rows)
                every = sorted([*spans, *((s, e, "net") for s, e in new)], key=lambda x: (x[0], KINDS.index(x[2])))
                counts = [sum(k == kind for _, _, k in spans) for kind in KINDS[:3]]
                out.append((doc_id, *counts, hashlib.sha256(name(spans).encode()).hexdigest(), name(every)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"])

    return run


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", recall: float = RECALL) -> DataFrame:
    """(doc_id, n_assign, n_access, n_hex, base_sha256, spans): one row per row of ``docs``.

    Null and empty texts have no spans (base_sha256 is that of no bytes); very long ones are scanned whole; repeated rows are
    scanned each; extra columns are ignored; an empty table gives an empty result. With few findings in ``docs``
    the network learns from made-up ones.
    """
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, base array<struct<s:int,e:int,kind:string>>, cands array<struct<s:int,e:int,label:int,piece:string>>"
    found = materialise(texts.mapInArrow(_scan, schema), "secrets")
    return found.mapInArrow(_report(train(found, recall)), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
