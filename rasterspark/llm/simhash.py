"""SimHash near-duplicates by a segment-popcount embedding.

A 64-bit fingerprint becomes 32 counts, the set bits of each two-bit segment. Flipping one bit moves one
count by one, so the Manhattan distance of two count vectors is at most the Hamming distance of the
fingerprints. The counts are gridded: eight groups of four segments; two vectors at Manhattan distance 4
or less leave at least four groups untouched, so they share the grid cell of some choice of four groups.
Each fingerprint is dealt to its 70 cells and cells are range-joined inside sorted partitions: what is in one cell is
pruned by the Manhattan distance of the counts, and what is left is verified exactly on the fingerprints. Cells that hold more than ``max_cell`` fingerprints
take an exact way without pairs: two fingerprints at distance 4 or less have a common neighbour at
distance 2, so all are dealt to their neighbours within 2 and each neighbour links its group to its least.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import components, materialise, rows_of, salted_join, small_batches, text_keys

SEED, SHINGLE, BITS, GROUPS = 42, 4, 4, 8
_LOW = 0x5555555555555555
_EVEN = np.uint64(_LOW)
_CHUNK = 1 << 17


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """The unsigned fingerprint of one whole text; null, empty and blank texts have 0."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    data = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(shingle, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    digest, count = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for i in range(0, len(starts), _CHUNK):
        pairs = zip(starts[i : i + _CHUNK].tolist(), ends[i : i + _CHUNK].tolist())
        h = np.array([digest(data[s:e], SEED) for s, e in pairs], np.uint64)
        count += np.unpackbits(h.view(np.uint8), bitorder="little").reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * count > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, keyed: bool = False) -> DataFrame:
    """(doc_id, fp): one row per row of ``docs``, fp the fingerprint as a signed long. ``keyed``: also the row's ``text_keys``."""

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp), *b.columns[2:]], ["doc_id", "fp", *["k0", "k1"] * keyed])

    chosen = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *text_keys(F.col(text_col)) * keyed)
    return chosen.mapInArrow(run, "doc_id long, fp long" + ", k0 long, k1 long" * keyed)


def _masks() -> list[int]:
    """For each choice of GROUPS - BITS groups the mask of their bits, as signed longs."""
    width = 64 // GROUPS
    sets = [sum(((1 << width) - 1) << (g * width) for g in c) for c in combinations(range(GROUPS), GROUPS - BITS)]
    return [m - (1 << 64) if m >> 63 else m for m in sets]


def cells(fps: DataFrame) -> DataFrame:
    """(choice, cell, fp): the grid cells of each fingerprint's counts."""
    even, odd = F.col("fp").bitwiseAND(F.lit(_LOW)), F.shiftrightunsigned("fp", 1).bitwiseAND(F.lit(_LOW))
    counts = even.bitwiseXOR(odd).bitwiseOR(F.shiftleft(even.bitwiseAND(odd), 1))
    table = F.array(*[F.lit(m).cast("long") for m in _masks()])
    return fps.select("fp", counts.alias("_counts")).select("fp", F.posexplode(F.transform(table, lambda m: F.col("_counts").bitwiseAND(m))).alias("choice", "cell"))


def _close(x: np.ndarray, y: np.ndarray | np.uint64) -> np.ndarray:
    """Which of x and y are within BITS: those within it by the Manhattan distance of their counts are verified.

    A two-bit segment's count is 0, 1 or 2; counts differ by 2 where both bits differ and are equal in each fingerprint, by 1
    where one differs, by 0 else, so the distance needs no unpacking.
    """
    d = x ^ y
    one, two = (d ^ d >> np.uint64(1)) & _EVEN, d & d >> np.uint64(1) & ~(x ^ x >> np.uint64(1)) & _EVEN
    out = np.bitwise_count(one).astype(np.int64) + 2 * np.bitwise_count(two) <= BITS
    if x.ndim:
        left = np.flatnonzero(out)
        out[left] = np.bitwise_count(d[left]) <= BITS
    return out


def _span(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join whatever is reachable among x, at most one less than there are members."""
    rest, a, b = np.arange(len(x)), [], []
    while len(rest):
        todo, rest = [rest[0]], rest[1:]
        while todo and len(rest):
            i = todo.pop()
            near = _close(x[rest], x[i])
            hit = rest[near]
            a += [i] * len(hit)
            b += hit.tolist()
            todo += hit.tolist()
            rest = rest[~near]
    return x[np.array(a, np.int64)], x[np.array(b, np.int64)]


def _link(max_cell: int, small: int = 16):
    """Over rows sorted by (choice, cell): verified links; the members of overfull cells with b null."""

    def run(batches):
        held = None  # columns of the last cell, not yet complete
        over = None  # the cell that is overfull, if the last one is
        for batch in batches:
            c, k, f = (np.asarray(batch.column(i)) for i in range(3))
            if over is not None:
                same = (c == over[0]) & (k == over[1])
                n = int(same.argmin()) if not same.all() else len(same)
                if n:
                    yield _out(f[:n], None)
                c, k, f = c[n:], k[n:], f[n:]
                if not len(f):
                    continue
                over = None
            if held is not None:
                c, k, f = (np.concatenate(p) for p in zip(held, (c, k, f)))
            if not len(f):
                continue
            cut = np.flatnonzero((c[1:] != c[:-1]) | (k[1:] != k[:-1])) + 1
            last = int(cut[-1]) if len(cut) else 0
            held = (c[last:], k[last:], f[last:])
            yield from _cells(c[:last], k[:last], f[:last])
            if len(held[2]) > max_cell:
                over = (held[0][0], held[1][0])
                yield _out(held[2], None)
                held = None
        if held is not None:
            yield from _cells(*held)

    def _cells(c, k, f):
        if len(f) < 2:
            return
        x = f.view(np.uint64)
        edge = np.concatenate([[True], (c[1:] != c[:-1]) | (k[1:] != k[:-1])])
        start = np.flatnonzero(edge)
        sizes = np.diff(np.concatenate([start, [len(f)]]))
        size = np.repeat(sizes, sizes)
        group = np.cumsum(edge) - 1
        a, b = [], []
        for d in range(1, min(small, int(sizes.max()))):
            ok = (group[d:] == group[:-d]) & (size[d:] <= small)
            i = np.flatnonzero(ok)
            i = i[_close(x[i], x[i + d])]
            a.append(f[i])
            b.append(f[i + d])
        for s, n in zip(start[sizes > small].tolist(), sizes[sizes > small].tolist()):
            if n > max_cell:
                yield _out(f[s : s + n], None)
            else:
                p, q = _span(x[s : s + n])
                a.append(p.view(np.int64))
                b.append(q.view(np.int64))
        if a and sum(map(len, a)):
            pairs = np.unique(np.stack([np.concatenate(a), np.concatenate(b)]), axis=1)
            yield _out(pairs[0], pairs[1])

    def _out(a, b):
        a = np.ascontiguousarray(a)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.nulls(len(a), pa.int64()) if b is None else pa.array(np.ascontiguousarray(b))], ["a", "b"])

    return run


def _neighbour_links(members: DataFrame) -> DataFrame:
    """All links among ``members(fp)`` without pairs: each neighbour within 2 bits links its group to its least."""
    bits = [1 << i for i in range(64)]
    near = [0, *bits, *[p | q for p, q in combinations(bits, 2)]]
    table = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m).cast("long") for m in near])
    at = members.select("fp", F.explode(F.transform(table, lambda m: F.col("fp").bitwiseXOR(m))).alias("near"))
    least = at.groupBy("near").agg(F.min("fp").alias("least"), F.count("*").alias("n")).where("n > 1")
    return salted_join(at, least, ["near"]).where("fp <> least").select(F.col("fp").alias("a"), F.col("least").alias("b")).distinct()


def links(fps: DataFrame, max_cell: int = 20_000) -> DataFrame:
    """(a, b) over distinct ``fps(fp)``: enough links of at most 4 differing bits to reach all that is reachable."""
    dealt = cells(fps).select("choice", "cell", "fp").repartition("choice", "cell").sortWithinPartitions("choice", "cell")
    found = materialise(dealt.mapInArrow(_link(max_cell), "a long, b long"), "simhash-links")
    out = found.where("b is not null").distinct()
    crowded = found.where("b is null").select(F.col("a").alias("fp")).distinct()
    return out if crowded.isEmpty() else out.union(_neighbour_links(materialise(crowded, "simhash-crowded"))).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_cell: int = 20_000, keyed: bool = False) -> DataFrame:
    """(doc_id, fingerprint, component_id, component_size): one row per row of ``docs``.

    component_id is the least id reachable over links of at most 4 bits. Null, empty and blank texts have
    fingerprint zero and link like any other; rows with a null id belong to their component but never name
    it, so a component of null ids only has a null component_id. Repeated rows stay repeated; extra columns
    are ignored; an empty table gives an empty result. ``keyed``: also the row's ``text_keys`` and its group, never null.
    """
    rows = materialise(fingerprints(docs, id_col, text_col, keyed=keyed), "simhash")
    each = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("n")), "simhash-distinct")
    roots = components(links(each.select("fp"), max_cell)).select(F.col("node").alias("fp"), "root")
    named = each.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"), F.sum("n").alias("component_size"))
    known = salted_join(named.select("fp", "root"), ids, ["root"])
    return salted_join(rows, known, ["fp"]).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id", "component_size", *["k0", "k1", F.col("root").alias("group")] * keyed)


def joined(rows: DataFrame, more: DataFrame) -> DataFrame:
    """``rows(doc_id, k0, k1, group)`` with groups joined where members share a group of ``more``, of the same columns.

    Both know the same texts by ``text_keys``. The groups of ``rows`` that one group of ``more`` meets are linked to the least of them.
    """
    rows = materialise(rows.select("doc_id", "k0", "k1", "group"), "near-rows")
    both = rows.select("k0", "k1", "group").distinct().join(more.select("k0", "k1", F.col("group").alias("other")).distinct(), ["k0", "k1"])
    met = materialise(both.select("group", "other").distinct(), "near-met")
    least = met.groupBy("other").agg(F.min("group").alias("least"), F.count("*").alias("n")).where("n > 1").drop("n")
    roots = components(salted_join(met, least, ["other"]).where("group <> least").select(F.col("group").alias("a"), F.col("least").alias("b")))
    named = salted_join(rows, roots.select(F.col("node").alias("group"), "root"), ["group"], "left")
    return named.select("doc_id", "k0", "k1", F.coalesce("root", "group").alias("group"))


def keep_one(docs: DataFrame, more: DataFrame | None = None) -> DataFrame:
    """``docs`` with one row of each near-duplicate group: the one with the least doc_id, null ids last.

    Rows are told apart by id and text, so rows of different groups all stay whether their ids are null, repeated
    or neither; of rows alike in both, one stays, whole. Null, empty and blank texts are one group; very long texts are like
    others; extra columns stay, whatever their names; an empty table stays empty. Groups are those of ``near_duplicates``;
    ``more(doc_id, k0, k1, group)``: groups of ``docs`` by another measure, joined with them.
    """
    rows = near_duplicates(docs, keyed=True)
    if more is not None:
        rows = joined(rows, more)
    each = rows.groupBy("group", "doc_id", "k0", "k1").agg(F.count("*").alias("n"))
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k0", "k1", "n")
    kept = materialise(each.groupBy("group").agg(F.min(first).alias("r")).select("r.doc_id", "r.k0", "r.k1", "r.n"), "near-kept")
    many = kept.where("n > 1")
    if many.isEmpty():
        return rows_of(docs, kept, "left_semi")
    return rows_of(docs, kept.where("n = 1"), "left_semi").union(rows_of(docs, many, "left_semi").dropDuplicates(["doc_id", "text"]))
