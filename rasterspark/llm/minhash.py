"""Near-duplicates by Jaccard similarity of word shingles: min-hash candidates, each verified on the shingles.

A text is the set of its shingles, ``shingle`` lower-cased words each (a shorter text is one shingle). ``BANDS`` bands
of ``ROWS`` minima each make the candidates: texts of similarity s share a band with probability
1 - (1 - s**ROWS)**BANDS, 0.9996 at 0.8. Pairs in a band are not listed: its members are linked to ``CENTRES`` of them,
the least ones by as many orders, and each link is verified on the shingle sets. Groups are the components
of the verified links. A band whose members are not all in one component by then is looked at again, ``ROUNDS`` times at most: members of
up to as many of its components become centres for the members of all others, so two texts that are alike and both
unlike the first centres meet. The last round is exact (``_rest``): what is still in bands of several components is compared whole, so texts of
one band are in one group if they are alike, however many there are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, components, materialise, mix64, salted_join, small_batches, text_keys, word_hashes

SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS, CENTRES, ROUNDS, SEED = 20, 5, 3, 3, 11
#: Members of a part of a band, where all of its parts are compared.
CHUNK = 2000
_CHUNK = 1 << 14
_SALTS = np.uint64(0), np.uint64(0x9FB21C651E98DF25)
_letters, _words = Rolling(0xD6E8FEB86659FD93), Rolling(0xA0761D6478BD642F)


def shingles(text: str | None, shingle: int = SHINGLE) -> np.ndarray:
    """The sorted 64-bit hashes of the different shingles of one whole text; none without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(b" ".join(words), _letters)
    k = min(shingle, len(h))
    at = np.arange(len(h) - k + 1)
    return np.unique(mix64(_words.hashes(_words.sums(h), at, at + k) ^ np.uint64(k)))


def _bands(sets: list[np.ndarray], mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    """For each set the hashes of its bands."""
    low = np.full((len(sets), BANDS * ROWS), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for row, s in zip(low, sets):
            for i in range(0, len(s), _CHUNK):
                x = s[None, i : i + _CHUNK] * mult[:, None] + add[:, None]
                np.minimum(row, x.min(1), out=row)
        low = mix64(low).reshape(len(sets), BANDS, ROWS)
        out = np.broadcast_to(mix64(np.arange(BANDS, dtype=np.uint64)), low.shape[:2]).copy()
        for r in range(ROWS):
            out = mix64(out ^ low[:, :, r]) * np.uint64(2 * r + 3)
    return out


def _sign(shingle: int):
    rng = np.random.default_rng(SEED)
    mult, add = rng.integers(0, 1 << 63, (2, BANDS * ROWS), np.uint64)
    mult |= np.uint64(1)

    def run(batches):
        for b in batches:
            sets = [shingles(t, shingle) for t in b.column(1).to_pylist()]
            with np.errstate(over="ignore"):
                keys, checks = (np.array([mix64(np.array([mix64(s ^ salt).sum() ^ np.uint64(len(s))], np.uint64))[0] if len(s) else 0 for s in sets], np.uint64) for salt in _SALTS)
            bands = _bands(sets, mult, add).view(np.int64)
            short = [s.view(np.int64) >> 32 for s in sets]  # 32 bits of each hash tell the shingles of two texts apart
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *b.columns[2:], pa.array(keys.view(np.int64)), pa.array(checks.view(np.int64)), pa.array([x if len(s) else [] for x, s in zip(bands, sets)], pa.list_(pa.int64())), pa.array([x.astype(np.int32) for x in short], pa.list_(pa.int32()))],
                ["doc_id", "k0", "k1", "nr", "node", "check", "bands", "shingles"],
            )

    return run


def _similar(similarity: float):
    """Links whose shingle sets have at least this Jaccard similarity."""

    def run(batches):
        for b in batches:
            keep = []
            for x, y in zip(b.column(2), b.column(3)):
                x, y = (np.asarray(v.values) for v in (x, y))
                both = len(np.intersect1d(x, y))
                keep.append(both >= similarity * (len(np.unique(x)) + len(np.unique(y)) - both))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _verified(pairs: DataFrame, rows: DataFrame, lead: DataFrame, similarity: float) -> DataFrame:
    """(a, b): those of ``pairs(x, c)`` that are similar; a centre c may have very many x."""
    pairs = materialise(pairs, "minhash-candidates")
    involved = pairs.select(F.col("x").alias("node")).union(pairs.select("c")).distinct().join(lead, "node").select("nr")
    sets = materialise(rows.select("nr", "node", "shingles").join(involved, "nr", "left_semi").select("node", "shingles"), "minhash-sets")
    left = pairs.join(sets.toDF("x", "left"), "x")
    right = sets.join(pairs.select(F.col("c").alias("node")).distinct(), "node", "left_semi").toDF("c", "right")
    met = small_batches(salted_join(left, right, ["c"])).select("x", "c", "left", "right")
    return materialise(met.mapInArrow(_similar(similarity), "a long, b long"), "minhash-links")


def _apart(similarity: float):
    """Over two parts of a band: similar texts of different roots, one link for each text and root. Overlaps are counted by shingle, not pair by pair."""

    def run(t: pa.Table) -> pa.Table:
        node, root, part = (np.asarray(t[c].combine_chunks()) for c in ("node", "root", "part"))
        low, same = t["lo"][0].as_py(), t["lo"][0].as_py() == t["hi"][0].as_py()
        sets = t["shingles"].combine_chunks()
        size = np.diff(np.asarray(sets.offsets))
        owner, values = np.repeat(np.arange(len(node)), size), np.asarray(sets.flatten())
        order = values.argsort(kind="stable")
        lists, first = owner[order], np.flatnonzero(np.diff(values[order].astype(np.int64), prepend=-(1 << 40)))
        length = np.diff(first, append=len(values))
        of = np.empty(len(values), np.int64)
        of[order] = np.repeat(np.arange(len(first)), length)
        ends, a, b = np.cumsum(size), [], []
        for x in np.flatnonzero(part == low).tolist():
            mine = of[ends[x] - size[x] : ends[x]]
            n = length[mine]
            both = np.bincount(lists[np.repeat(first[mine] - np.cumsum(n) + n, n) + np.arange(n.sum())], minlength=len(node))
            hit = np.flatnonzero((both >= similarity * (size[x] + size - both)) & (root != root[x]) & (same | (part != low)))
            hit = hit[np.unique(root[hit], return_index=True)[1]]
            a += [node[x]] * len(hit)
            b += node[hit].tolist()
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})

    return run


def _rest(at: DataFrame, rows: DataFrame, lead: DataFrame, similarity: float, chunk: int = CHUNK) -> DataFrame:
    """(a, b): links of all similar texts of different roots in a band of ``at(node, band, root)``.

    A band's members of its commonest root and all others are dealt to parts of about ``chunk``. Each part of the others
    meets every part, itself included; those of the commonest root do not meet one another. So a band's rows grow with its members, and
    with their square over ``chunk`` only where so many are of other roots.
    """
    per = at.groupBy("band", "root").agg(F.count("*").alias("m")).groupBy("band").agg(F.max_by("root", F.struct("m", "root")).alias("major"), F.max("m").alias("p"), (F.sum("m") - F.max("m")).alias("q"))
    per = per.select("band", "major", *[F.ceil(F.col(c) / chunk).alias(c) for c in ("p", "q")])
    most, of = F.col("root") == F.col("major"), F.xxhash64(F.lit(CENTRES), "node")
    dealt = salted_join(at, per, ["band"]).withColumn("part", F.when(most, F.col("q") + F.pmod(of, "p")).otherwise(F.pmod(of, "q")))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.when(most, F.col("q")).otherwise(F.col("p") + F.col("q")) - 1)))
    dealt = materialise(dealt.select("node", "band", "root", "part", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi")), "minhash-parts")
    nodes = dealt.select("node").distinct().join(lead, "node").select("nr")
    sets = materialise(rows.select("nr", "node", F.array_distinct("shingles").alias("shingles")).join(nodes, "nr", "left_semi").select("node", "shingles"), "minhash-rest")
    met = dealt.join(sets, "node")  # a text is in few bands, so no key is hot and no set travels more than once for each
    return materialise(met.groupBy("band", "lo", "hi").applyInArrow(_apart(similarity), "a long, b long").distinct(), "minhash-links")


def links(rows: DataFrame, lead: DataFrame, similarity: float = SIMILARITY, rounds: int = ROUNDS) -> DataFrame:
    """(a, b): verified links between the different nodes of ``rows(nr, node, bands, shingles)``; ``lead(node, nr)``: a row of each.

    They reach all that similar pairs of one band reach.
    """
    every = rows.select("nr", "node", "bands").join(lead.select("nr"), "nr", "left_semi").select("node", F.explode("bands").alias("band"))
    order = [F.struct(F.xxhash64(F.lit(i), "node").alias("o"), "node") for i in range(CENTRES)]
    centres = every.groupBy("band").agg(F.count("*").alias("n"), *[F.min(o)["node"].alias(f"c{i}") for i, o in enumerate(order)]).where("n > 1").drop("n")
    at = materialise(salted_join(every, centres, ["band"]), "minhash-bands")
    met = at.select("node", F.explode(F.array_distinct(F.array(*[f"c{i}" for i in range(CENTRES)]))).alias("c")).where("node <> c")
    found = met.select(F.least("node", "c").alias("a"), F.greatest("node", "c").alias("b"), "c").groupBy("a", "b").agg(F.min("c").alias("c"))
    out = _verified(found.select(F.when(F.col("a") == F.col("c"), F.col("b")).otherwise(F.col("a")).alias("x"), "c"), rows, lead, similarity)
    at = at.select("node", "band")
    last = max(1, rounds - 1)
    for turn in range(1, last + 1):
        roots = components(out)
        placed = salted_join(at, roots, ["node"], "left").withColumn("root", F.coalesce("root", "node"))
        mixed = placed.groupBy("band").agg((F.min("root") < F.max("root")).alias("mixed"), F.count("*").alias("n")).where("mixed and n > 2").select("band")  # two have been compared
        at = materialise(salted_join(placed, mixed, ["band"]).select("node", "band", "root"), "minhash-mixed")
        if at.isEmpty():
            break
        if turn == last:  # the exact way stands for the last round
            out = out.union(_rest(at, rows, lead, similarity))
            break
        # one member of each component in a band, and of these the least of some orders
        one = at.groupBy("band", "root").agg(F.min(F.struct(F.xxhash64(F.lit(turn), "node"), "node"))["node"].alias("c"))
        orders = [F.struct(F.xxhash64(F.lit(turn * CENTRES + i), "c").alias("o"), F.struct("root", "c").alias("v")) for i in range(CENTRES)]
        heads = one.groupBy("band").agg(F.array_distinct(F.array(*[F.min(o)["v"] for o in orders])).alias("heads"))
        near = salted_join(at, heads, ["band"]).select("node", "root", F.inline("heads").alias("other", "c")).where("root <> other")
        out = out.union(_verified(near.select(F.col("node").alias("x"), "c").distinct(), rows, lead, similarity))
        at = at.select("node", "band")
    return out.distinct()


def _told_apart(rows: DataFrame) -> DataFrame:
    """``rows`` with nodes that different shingle sets share (64 bits of one hash) renamed by another hash."""
    clash = rows.groupBy("node").agg((F.min("check") < F.max("check")).alias("clash")).where("clash").select("node", "clash")
    if clash.isEmpty():
        return rows.drop("check")
    again = salted_join(rows, clash, ["node"], "left")
    return materialise(again.withColumn("node", F.when(F.col("clash"), F.xxhash64("node", "check")).otherwise(F.col("node"))).drop("clash", "check"), "minhash")


def groups(docs: DataFrame, shingle: int = SHINGLE, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """(doc_id, k0, k1, group): one row per row of ``docs``; k0 and k1 are ``text_keys``.

    Texts without words are one group; texts of equal shingle sets are one each; repeated rows stay repeated; very long texts are
    compared whole; extra columns are ignored; an empty table gives an empty result.
    """
    chosen = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), *text_keys(F.col(text_col)), F.monotonically_increasing_id().alias("nr"))
    rows = materialise(chosen.mapInArrow(_sign(shingle), "doc_id long, k0 long, k1 long, nr long, node long, check long, bands array<long>, shingles array<int>"), "minhash")
    rows = _told_apart(rows)
    lead = materialise(rows.where("size(bands) > 0").groupBy("node").agg(F.min("nr").alias("nr")), "minhash-nodes")
    roots = components(links(rows, lead, similarity, rounds)).select("node", F.col("root").alias("group"))
    return salted_join(rows.select("doc_id", "k0", "k1", "node"), roots, ["node"], "left").select("doc_id", "k0", "k1", F.coalesce("group", "node").alias("group"))
