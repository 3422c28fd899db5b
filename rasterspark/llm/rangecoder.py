"""An adaptive context-mixing range coder for token ids, over many lanes at once.

A block of ids is laid out as lanes of ``STEPS`` consecutive ids each, and lanes are coded ``GROUP`` at a time. The lanes
of a group move in step: at each step the model predicts all their next ids, their range coders advance, then
the model learns these ids; each group also knows all groups before it.

Three orders predict. Order 2 gives the id last seen behind the two ids before, with a confidence; order 1 gives
the distribution of what followed the id before, order 0 that of all ids, both of the block so far and taken
anew whenever it has grown by a half. How far orders 2 and 1 can be trusted is an adaptive hit rate for each
confidence; an online logistic mixer weighs both rates, in integers throughout, so encoder and decoder agree on any
machine. The id's interval is order 2's if that holds, else its share of order 1's, else of order 0's.
Coders are carry-less range coders with 64-bit states that emit 16-bit words.

A block is independent of all others: magic, sizes, crc32 of the ids and of the bytes, lane lengths, lane bytes.
"""

from __future__ import annotations

import math
import struct
import zlib

import numpy as np

MAGIC, STEPS, GROUP, BLOCK = b"RSB3", 256, 16384, 1 << 22
RENEW = 2  # distributions are taken anew when a block has grown by one part in so many
IDS = 1 << 16
_HEAD = "<4sIIII"
_PROB = 12  # bits of a hit rate
_BASE = 18  # bits of the totals of orders 0 and 1
_U = np.uint64
_WIDTH = (1 << 20) - 1
_TOP, _LOW = _U(1 << 48), _U(1 << 32)
_STRETCH = np.array([round(256 * math.log((i + 0.5) / ((1 << _PROB) - i - 0.5))) for i in range(1 << _PROB)], np.int64)
_SQUASH = np.array([min((1 << _PROB) - 32, max(32, round((1 << _PROB) / (1 + math.exp(-i / 256))))) for i in range(-2560, 2561)], np.int64)
_CTX2, _TABLE = 20, 21  # bits of an order-2 context and of the encoder's table of pairs


class Model:
    """What a block has shown so far. ``predict`` and ``learn`` take all lanes of a step.

    Confidences are 0 to 7: of order 2 how often its slot held lately, of order 1 how often its ids were seen on average
    (powers of two; 0: never). Rates and mixing weights depend on both only, so a step works out 64 cells,
    not each lane.
    """

    def __init__(self, decoding: bool):
        self.decoding = decoding
        self.slot2 = np.zeros(1 << _CTX2, np.int32)  # id and, in the low three bits, confidence
        self.rate = np.full((2, 8), 1 << 15, np.int64)  # 16-bit hit rates by order and confidence
        self.weight = np.zeros((2, 8, 8), np.int64)  # of the other order, by both confidences; 1 << 16 is one
        self.count = np.ones(IDS, np.int64)
        self.pair, self.times = np.zeros(0, np.int64), np.zeros(0, np.int64)  # order 1: id before and id, sorted; how often
        self.pending: list[np.ndarray] = []
        self.seen = self.due = 0
        self._renew()

    def _renew(self) -> None:
        """Distributions of orders 0 and 1 that sum to 1 << _BASE."""
        if self.pending:
            new, n = np.unique(now := np.concatenate(self.pending), return_counts=True)
            at = np.searchsorted(self.pair, new)
            old = np.zeros(len(new), bool) if not len(self.pair) else self.pair[np.minimum(at, len(self.pair) - 1)] == new
            self.times[at[old]] += n[old]
            self.pair, self.times = np.insert(self.pair, at[~old], new[~old]), np.insert(self.times, at[~old], n[~old])
            self.count += 32 * np.bincount(now & IDS - 1, minlength=IDS)
            self.pending = []
        room = (1 << _BASE) - IDS
        freq = self.count * room // self.count.sum() + 1
        freq[int(freq.argmax())] += (1 << _BASE) - int(freq.sum())
        self.share = (np.cumsum(freq) - freq) << 20 | freq  # start and width in one number
        before = self.pair >> 16
        kinds = np.bincount(before, minlength=IDS)
        upto, first = np.concatenate([[0], np.cumsum(self.times)]), np.concatenate([[0], np.cumsum(kinds)])
        total = upto[first[1:]] - upto[first[:-1]]
        own, of = upto[:-1] - upto[first[before]], np.maximum(total[before], 1)
        start1 = (own << _BASE) // of
        self.share1 = start1 << 20 | ((own + self.times << _BASE) // of - start1)
        ratio = total // np.maximum(kinds, 1)
        self.trust1 = np.minimum(np.where(kinds > 0, 1 + np.floor(np.log2(np.maximum(ratio, 1))), 0), 7).astype(np.int8)
        if self.decoding:
            self.symbol, self.place = np.repeat(np.arange(IDS, dtype=np.uint16), freq), before << _BASE | start1
        elif len(self.pair):
            self.table = np.zeros(1 << _TABLE, np.int32)
            rare_first = np.argsort(np.minimum(self.times, 65535).astype(np.uint16), kind="stable")
            self.table[_slot(self.pair[rare_first])] = rare_first

    def predict(self, a: np.ndarray, b: np.ndarray):
        """After ids a, b (b the nearer): order 2's id and the shares of orders 1 and 2, of 1 << _PROB."""
        self.b = b
        self.at2 = (a * 40503 ^ b * 2654435761) & ((1 << _CTX2) - 1)
        self.v2 = self.slot2[self.at2]
        self.p2, self.c2 = self.v2 >> 3, self.v2 & 7
        self.cell = self.c2 << 3 | self.trust1[b]
        s1, s2 = _STRETCH[self.rate[0] >> 4][None, :], _STRETCH[self.rate[1] >> 4][:, None]
        self.s1, self.s2 = s1, s2
        m2 = _SQUASH[np.clip(s2 + (s1 * self.weight[1] >> 16), -2560, 2560) + 2560]
        m1 = _SQUASH[np.clip(s1 + (s2 * self.weight[0] >> 16), -2560, 2560) + 2560]
        q2 = m2.copy()
        q2[0] = 0
        q1 = np.maximum(m1 * ((1 << _PROB) - q2) >> _PROB, 1)
        q1[:, 0] = 0
        self.m1, self.m2 = m1, m2
        return self.p2, q1.reshape(-1)[self.cell], q2.reshape(-1)[self.cell]

    def find(self, i: np.ndarray, x: np.ndarray):
        """Where order 1 holds x behind b in lanes i, and whether it is known to.

        Pairs that more frequent ones keep out of the table go by order 0, which the decoder need not know beforehand.
        """
        if not len(self.pair):
            return np.zeros(len(i), np.int64), np.zeros(len(i), bool)
        key = self.b[i] << 16 | x[i]
        at = self.table[_slot(key)]
        return at, self.pair[at] == key

    def learn(self, ids: np.ndarray, hit1: np.ndarray, hit2: np.ndarray) -> None:
        miss, h1, h2 = np.bincount(self.cell + (hit1 * 64 + hit2 * 128), minlength=192).reshape(3, 8, 8)
        n = miss + h1 + h2
        n1 = n - h2  # order 1 is asked where order 2 has failed
        for order, axis, h, of in ((0, 0, h1, n1), (1, 1, h2, n)):
            total = of.sum(axis)
            goal = (h.sum(axis) << 16) // np.maximum(total, 1)
            self.rate[order] += np.where(total > 0, goal - self.rate[order] >> 4, 0)
        np.clip(self.rate, 64, (1 << 16) - 64, out=self.rate)
        for order, h, of, m, s in ((0, h1, n1, self.m1, self.s2), (1, h2, n, self.m2, self.s1)):
            self.weight[order] += ((h << _PROB) - of * m) * s // np.maximum(of, 1) >> 10
        np.clip(self.weight, -(1 << 16), 1 << 16, out=self.weight)
        v, c = self.v2, self.c2
        kept = np.where(c > 1, v - (c + 1 >> 1), ids.astype(np.int32) << 3 | 1)
        self.slot2[self.at2] = np.where(self.p2 == ids, v + (c < 7), kept)
        self.pending.append(self.b << 16 | ids)
        self.seen += len(ids)
        if self.seen > self.due:
            self.due = self.seen + max(1024, self.seen // RENEW)
            self._renew()


def _slot(pair: np.ndarray) -> np.ndarray:
    return (pair * 0x9E3779B97F4A7C1 >> 20) & ((1 << _TABLE) - 1)


def _search(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Where each key would go; keys in order find their place sooner."""
    order = np.argsort(keys)
    out = np.empty(len(keys), np.int64)
    out[order] = np.searchsorted(table, keys[order])
    return out


def _lanes(n: int) -> tuple[int, np.ndarray]:
    """Number of lanes of a block of n ids, and the number of lanes that reach each step."""
    lanes = -(-n // STEPS)
    last = n - (lanes - 1) * STEPS
    return lanes, np.where(np.arange(STEPS) < last, lanes, lanes - 1)


def _shift(low: np.ndarray, span: np.ndarray):
    """Bring all lanes' ranges back to 2**32 or more: yields (lanes, words) as often as any lane emits one."""
    todo = None
    while True:
        lo, sp = (low, span) if todo is None else (low[todo], span[todo])
        same = (lo ^ (lo + sp)) < _TOP
        small = sp < _LOW
        go = np.flatnonzero(same | small)
        if not len(go):
            return
        lo, sp, same = lo[go], sp[go], same[go]
        sp = np.where(same, sp, (~lo + _U(1)) & (_LOW - _U(1)))
        todo = go if todo is None else todo[go]
        yield todo, (lo >> _U(48)).astype(np.uint16)
        low[todo] = lo << _U(16)
        span[todo] = sp << _U(16)


def encode_block(ids: np.ndarray) -> bytes:
    n = len(ids)
    lanes, active = _lanes(n)
    grid = np.zeros(lanes * STEPS, np.uint16)
    grid[:n] = ids
    grid = grid.reshape(lanes, STEPS).T.copy()
    model = Model(False)
    words, owner = [], []
    with np.errstate(over="ignore"):
        for g in range(0, lanes, GROUP):
            low, span = np.zeros(min(GROUP, lanes - g), _U), np.full(min(GROUP, lanes - g), (1 << 64) - 1, _U)
            a = b = np.zeros(len(low), np.int64)
            for t in range(STEPS):
                k = min(len(low), int(active[t]) - g)
                if k <= 0:
                    break
                x = grid[t, g : g + k].astype(np.int64)
                p2, q1, q2 = model.predict(a[:k], b[:k])
                hit2 = (p2 == x) & (q2 > 0)
                start, freq = np.zeros(k, np.int64), q2 << _BASE  # where order 2 holds
                i = np.flatnonzero(~hit2)
                at, known = model.find(i, x)
                known &= q1[i] > 0
                hit1 = np.zeros(k, bool)
                i1, i0, j = i[known], i[~known], at[known]
                hit1[i1] = True
                q = q1[i1]
                share = model.share1[j]
                start[i1], freq[i1] = (q2[i1] << _BASE) + q * (share >> 20), q * (share & _WIDTH)
                q, share = q1[i0] + q2[i0], model.share[x[i0]]
                start[i0], freq[i0] = (q << _BASE) + ((1 << _PROB) - q) * (share >> 20), ((1 << _PROB) - q) * (share & _WIDTH)
                start, freq = start.view(_U), freq.view(_U)
                r = span[:k] >> _U(_PROB + _BASE)
                low[:k] += start * r
                span[:k] = freq * r
                for lane, word in _shift(low[:k], span[:k]):
                    words.append(word)
                    owner.append(lane + g)
                model.learn(x, hit1, hit2)
                a, b = b[:k], x
            for _ in range(4):
                words.append((low >> _U(48)).astype(np.uint16))
                owner.append(np.arange(g, g + len(low)))
                low = low << _U(16)
    own = np.concatenate(owner)
    order = np.argsort(own.astype(np.uint16) if lanes <= 1 << 16 else own, kind="stable")
    body = np.concatenate(words)[order].astype("<u2").tobytes()
    sizes = np.bincount(own, minlength=lanes).astype("<u2").tobytes()
    return struct.pack(_HEAD, MAGIC, n, len(body), zlib.crc32(ids.astype("<u4").tobytes()), zlib.crc32(sizes + body)) + sizes + body


def block_size(data: bytes, at: int = 0) -> int:
    """Bytes of the block that starts at ``at``."""
    magic, n, body, _, _ = struct.unpack_from(_HEAD, data, at)
    if magic != MAGIC:
        raise ValueError("no block starts here")
    return struct.calcsize(_HEAD) + 2 * _lanes(n)[0] + body


def decode_block(data: bytes, at: int = 0) -> np.ndarray:
    magic, n, size, crc, own_crc = struct.unpack_from(_HEAD, data, at)
    if magic != MAGIC:
        raise ValueError("no block starts here")
    lanes, active = _lanes(n)
    at += struct.calcsize(_HEAD)
    if zlib.crc32(data[at : at + 2 * lanes + size]) != own_crc:
        raise ValueError("a block's bytes are damaged")
    sizes = np.frombuffer(data, "<u2", lanes, at).astype(np.int64)
    words = np.frombuffer(data, "<u2", size // 2, at + 2 * lanes).astype(_U)
    words = np.concatenate([words, np.zeros(8, _U)])
    begin = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    grid = np.zeros((STEPS, lanes), np.uint16)
    model = Model(True)
    with np.errstate(over="ignore"):
        for g in range(0, lanes, GROUP):
            m = min(GROUP, lanes - g)
            next_ = begin[g : g + m].copy()
            low, span, value = np.zeros(m, _U), np.full(m, (1 << 64) - 1, _U), np.zeros(m, _U)
            for _ in range(4):
                value = value << _U(16) | words[next_]
                next_ += 1
            a = b = np.zeros(m, np.int64)
            for t in range(STEPS):
                k = min(m, int(active[t]) - g)
                if k <= 0:
                    break
                p2, q1, q2 = model.predict(a[:k], b[:k])
                r = span[:k] >> _U(_PROB + _BASE)
                v = np.minimum((value[:k] - low[:k]) // r, _U((1 << _PROB + _BASE) - 1)).astype(np.int64)
                e = v >> _BASE
                hit2, hit1 = e < q2, (e >= q2) & (e < q1 + q2)
                x, start, freq = p2.astype(np.int64), np.zeros(k, np.int64), q2 << _BASE
                i = np.flatnonzero(hit1)
                if len(i):
                    q, before = q1[i], q2[i] << _BASE
                    j = _search(model.place, (b[:k][i] << _BASE | (v[i] - before) // q) + 1) - 1
                    share = model.share1[j]
                    x[i], start[i], freq[i] = model.pair[j] & 0xFFFF, before + q * (share >> 20), q * (share & _WIDTH)
                i = np.flatnonzero(~(hit1 | hit2))
                q = q1[i] + q2[i]
                y = model.symbol[(v[i] - (q << _BASE)) // ((1 << _PROB) - q)]
                share = model.share[y]
                x[i], start[i], freq[i] = y, (q << _BASE) + ((1 << _PROB) - q) * (share >> 20), ((1 << _PROB) - q) * (share & _WIDTH)
                start, freq = start.view(_U), freq.view(_U)
                low[:k] += start * r
                span[:k] = freq * r
                for lane, _ in _shift(low[:k], span[:k]):
                    value[lane] = value[lane] << _U(16) | words[next_[lane]]
                    next_[lane] += 1
                grid[t, g : g + k] = x
                model.learn(x, hit1, hit2)
                a, b = b[:k], x
    ids = grid.T.reshape(-1)[:n].astype("<u4")
    if zlib.crc32(ids.tobytes()) != crc:
        raise ValueError("a block's ids differ from those written")
    return ids


def encode(ids: np.ndarray, block: int = BLOCK) -> bytes:
    """Blocks of up to ``block`` ids; none for no ids."""
    if len(ids) and int(ids.max()) >= IDS:
        raise ValueError(f"ids must be below {IDS}")
    return b"".join(encode_block(ids[i : i + block]) for i in range(0, len(ids), block))
