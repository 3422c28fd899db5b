"""Repeated passages by prefix-partitioned suffix trees.

A suffix is a word position with at least ``HEAD`` (50) words to its end; only tree nodes at least that deep
matter. Suffixes are parted until a part's subtree fits in memory, and only what can still repeat goes on:

1. A suffix belongs to the part of its head's least ``GRAM``-word gram. Equal heads have equal least grams,
   so no node is split over parts. Parts with suffixes of one document only hold no repeat and end here.
2. Within a part, suffixes that follow one another form a run. Runs of equal words are one path of the tree: all later
   documents' suffixes on it are repeats. A path is named by 128 bits of BLAKE2b of its words, which no two
   different texts are known to share or can be made to. A part with a single path ends here.
3. The first document's run of each remaining path is opened, with its words. A part of up to ``WORDS`` words is one group.
   Suffixes of larger parts are parted by prefixes of their own, 8 words long, then 16 and so on, until a group is small
   enough; groups that are still too large at 48 words are grouped by the whole head.
4. Each group's subtree is built from the words themselves by prefix doubling: positions are ranked by 1, 2, 4 ... words, and
   equal ranks at 50 words are the internal nodes of that depth. A node is labelled with its least document.

Stretches of suffixes below nodes with a smaller document's label are the maximal repeats. Groups are reduced to a minimum
before each shuffle, and hot parts are dealt over salted tasks.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Rolling, materialise, mix64, salted_join, small_batches, word_hashes

HEAD, GRAM, WORDS = 50, 8, 2_000_000
_letters, _words = Rolling(0x9E3779B97F4A7C15), Rolling(0xD1342543DE82EF95)


def _split(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").split()


class Suffixes:
    """The suffixes of one document: the ``part`` of each position and the words they are told by.

    Parts come from a fast hash: texts that it takes for each other are dealt together, which costs time and changes nothing.
    """

    def __init__(self, words: list[bytes]):
        self.n = max(0, len(words) - HEAD + 1)
        if not self.n:
            self.part = np.zeros(0, np.uint64)
            return
        self.data = b" ".join(words)
        self.begin = np.concatenate([[0], np.cumsum([len(w) + 1 for w in words])])  # where each word begins; one past the last one's end
        sums = _words.sums(word_hashes(self.data, _letters))
        i = np.arange(len(words) - GRAM + 1)
        low = mix64(_words.hashes(sums, i, i + GRAM))
        width, done = HEAD - GRAM + 1, 1
        while 2 * done <= width:  # least over windows of 1, 2, 4 ... grams, then of width
            low = np.minimum(low[:-done], low[done:])
            done *= 2
        if width > done:
            low = np.minimum(low[: len(low) - (width - done)], low[width - done :])
        self.part = low

    def runs(self) -> tuple[np.ndarray, ...]:
        """part, path (a digest's two halves), first position and number of suffixes of each run."""
        cut = np.flatnonzero(self.part[1:] != self.part[:-1]) + 1
        s, e = np.concatenate([[0], cut]), np.concatenate([cut, [self.n]])
        digest, data = hashlib.blake2b, memoryview(self.data)
        stretches = zip(self.begin[s].tolist(), (self.begin[e - 1 + HEAD] - 1).tolist())
        path = np.frombuffer(b"".join(digest(data[i:j], digest_size=16).digest() for i, j in stretches), np.int64).reshape(-1, 2)
        return self.part[s].view(np.int64), path[:, 0].copy(), path[:, 1].copy(), s.astype(np.int32), (e - s).astype(np.int32)


def _digest(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _read(batches):
    """For each document its size, digest and runs."""
    for b in batches:
        n, sha, parts, sizes = [], [], [], []
        for text in b.column(2).to_pylist():
            words = _split(text)
            s = Suffixes(words)
            n.append(len(words))
            sha.append(_digest(words))
            sizes.append(0)
            if s.n:
                parts.append(s.runs())
                sizes[-1] = len(parts[-1][0])
        cols = [np.concatenate(c) for c in zip(*parts)] if parts else [np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.int32, np.int32)]
        runs = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.StructArray.from_arrays([pa.array(c) for c in cols], ["part", "p0", "p1", "s", "n"]))
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(sha, pa.string()), runs], ["doc_id", "key", "n_words", "sha", "runs"])


_RUN = ["part", "doc_id", "key", "s", "n", "words"]
_RUN_TYPES = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.string())


def _open(batches):
    """The runs that are left open, with their words."""
    for b in batches:
        out = []
        for doc, key, text, runs in zip(*(b.column(i).to_pylist() for i in range(4))):
            words = _split(text)
            for r in runs:
                out.append((r["part"], doc, key, r["s"], r["n"], b" ".join(words[r["s"] : r["s"] + r["n"] - 1 + HEAD]).decode("utf-8", "replace")))
            if len(out) > 20_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _RUN_TYPES)], _RUN)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), _RUN_TYPES)], _RUN)


def _ranks(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The rank of each pair (a, b)."""
    return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]


def _subtrees(part: pa.RecordBatch) -> pa.RecordBatch:
    """Over whole groups of runs: the suffixes below nodes of depth HEAD that a smaller document labels."""
    split = pc.split_pattern(part.column(5), " ")
    code = np.asarray(split.flatten().dictionary_encode().indices).astype(np.int64)
    begin, n = np.asarray(split.offsets)[:-1] - split.offsets[0].as_py(), np.asarray(part.column(4)).astype(np.int64)
    run = np.repeat(np.arange(len(n)), n)
    j = np.arange(len(run)) - np.repeat(np.cumsum(n) - n, n)
    at = begin[run] + j  # where each suffix begins among all words
    rank, ranks = code, {1: code}
    for k in (1, 2, 4, 8, 16):  # positions near the end of a run rank words of the next: no suffix begins there
        rank = ranks[2 * k] = _ranks(rank, np.concatenate([rank[k:], np.zeros(min(k, len(rank)), np.int64)]))
    node = _ranks(_ranks(ranks[32][at], ranks[16][at + 32]), ranks[2][at + 48])
    doc = np.asarray(part.column(1))[run]
    least = np.full(int(node.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, node, doc)
    i = np.flatnonzero(least[node] < doc)
    return pa.RecordBatch.from_arrays([pa.array(doc[i]), pa.array(np.asarray(part.column(2))[run[i]]), pa.array((np.asarray(part.column(3))[run[i]] + j[i]).astype(np.int32))], ["doc_id", "key", "at"])


def _grow(words: int):
    """Over runs sorted by group: the subtrees of as many whole groups at a time as hold up to ``words`` words."""

    def run(batches):
        held, size = [], 0
        for b in batches:
            held.append(b)
            size += int(np.asarray(b.column(4)).sum()) + (HEAD - 1) * b.num_rows
            if size < words:
                continue
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            keys = np.asarray(rows.column(0))
            cut = int(np.searchsorted(keys, keys[-1]))  # the last group may go on
            if cut:
                yield _subtrees(rows.slice(0, cut))
                held = [rows.slice(cut)]
                size = int(np.asarray(held[0].column(4)).sum()) + (HEAD - 1) * held[0].num_rows
        if held:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()
            if rows:
                yield _subtrees(rows[0])

    return run


def _cut(batches):
    """Number of removed words and the digest of what is kept."""
    for b in batches:
        out = []
        for doc, key, text, whole, single in zip(*(b.column(i).to_pylist() for i in range(5))):
            words = _split(text)
            gone = _covered(len(words), whole, single)
            out.append((doc, key, int(gone.sum()), _digest([w for w, g in zip(words, gone.tolist()) if not g])))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), (pa.int64(), pa.int64(), pa.int64(), pa.string()))], ["doc_id", "key", "n_removed", "sha"])


def _covered(n: int, whole: list | None, single: list | None) -> np.ndarray:
    step = np.zeros(n + 1, np.int64)
    for r in whole or []:
        step[r["s"]] += 1
        step[r["s"] + r["n"] - 1 + HEAD] -= 1
    at = np.array(single or [], np.int64)
    np.add.at(step, at, 1)
    np.add.at(step, at + HEAD, -1)
    return np.cumsum(step[:n]) > 0


_RUNS, _AT = "part long, doc_id long, key long, s int, n int, words string", "doc_id long, key long, at int"


def _by_group(rows: DataFrame, words: int) -> DataFrame:
    return rows.repartition("part").sortWithinPartitions("part").mapInArrow(_grow(words), _AT)


def _nodes(opened: DataFrame, words: int) -> DataFrame:
    """(doc_id, key, at): the suffixes of ``opened`` runs whose head a smaller document has too."""
    size = F.sum(F.col("n") + HEAD - 1).alias("size")
    large = materialise(opened.groupBy("part").agg(size).where(F.col("size") > words).select("part"), "suffix-large")
    if large.isEmpty():
        return _by_group(opened, words)
    out = _by_group(opened.join(large, "part", "left_anti"), words)
    # suffixes one by one, parted by prefixes of their own
    at = opened.join(large, "part", "left_semi").withColumn("w", F.split("words", " ")).select("doc_id", "key", F.posexplode(F.transform(F.sequence(F.lit(0), F.col("n") - 1), lambda j: F.struct((F.col("s") + j).alias("s"), F.array_join(F.slice("w", j + 1, HEAD), " ").alias("words")))).alias("_j", "x"))
    rest = materialise(at.select("doc_id", "key", "x.s", F.lit(1).alias("n"), "x.words"), "suffix-heads")
    for prefix in range(GRAM, HEAD, GRAM):
        keyed = rest.withColumn("part", F.xxhash64(F.substring_index("words", " ", prefix)))
        large = materialise(keyed.groupBy("part").agg(size).where(F.col("size") > words).select("part"), "suffix-large")
        out = out.union(_by_group(keyed.join(large, "part", "left_anti").select("part", "doc_id", "key", "s", "n", "words"), words))
        if large.isEmpty():
            return out
        rest = materialise(keyed.join(large, "part", "left_semi").select("doc_id", "key", "s", "n", "words"), "suffix-heads")
    nodes = rest.groupBy("words").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("hi")).where("least < hi").drop("hi")
    return out.union(salted_join(rest, nodes, ["words"]).where("least < doc_id").select("doc_id", "key", F.col("s").alias("at")))


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> tuple[DataFrame, DataFrame]:
    """(documents, repeats) of ``docs``.

    documents(doc_id, key, n_words, sha): one row per row of ``docs``. repeats(doc_id, key, whole, single): for
    documents with suffixes whose head also starts in a document of a smaller id, their runs (first position
    s, number n) and single positions. key tells apart rows that share an id. Null ids are neither smaller nor
    larger than others: such rows repeat nothing. Null and empty texts have no words; very long ones are cut whole; repeated
    rows (of one id) repeat nothing of each other; extra columns are ignored; an empty table gives empty results.
    ``words``: of a group whose subtree one task builds.
    """
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    base = materialise(texts.mapInArrow(_read, "doc_id long, key long, n_words long, sha string, runs array<struct<part:long,p0:long,p1:long,s:int,n:int>>"), "suffix-runs")
    runs = base.where("doc_id is not null").select("doc_id", "key", F.inline("runs"))
    path = F.struct("p0", "p1")
    parts = runs.groupBy("part").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), (F.min(path) < F.max(path)).alias("forked")).where("lo < hi").select("part", "forked")
    live = materialise(salted_join(runs, parts, ["part"]), "suffix-live")
    paths = live.groupBy("p0", "p1").agg(F.min("doc_id").alias("least"))
    todo = salted_join(live, paths, ["p0", "p1"]).groupBy("doc_id", "key").agg(
        F.collect_list(F.when(F.col("least") < F.col("doc_id"), F.struct("s", "n"))).alias("whole"),
        F.collect_list(F.when((F.col("least") == F.col("doc_id")) & F.col("forked"), F.struct("part", "s", "n"))).alias("open"),
    )
    todo = materialise(todo, "suffix-todo")
    opened = texts.join(todo.where("size(open) > 0").select("doc_id", "key", "open").hint("shuffle_hash"), ["doc_id", "key"])
    opened = materialise(opened.select("doc_id", "key", "text", "open").mapInArrow(_open, _RUNS), "suffix-open")
    single = _nodes(opened, words).groupBy("doc_id", "key").agg(F.collect_set("at").alias("single"))
    found = todo.select("doc_id", "key", "whole").join(single, ["doc_id", "key"], "left")
    return base.drop("runs"), materialise(found.where("size(whole) > 0 or single is not null"), "suffix-repeats")


def cut_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): one row per row of ``docs``; see ``repeats`` for nulls, long texts, repeated rows and extra columns."""
    base, found = repeats(docs, id_col, text_col, words)
    texts = small_batches(docs).select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.col(text_col)).alias("key"), F.col(text_col).alias("text"))
    cut = texts.join(found.hint("shuffle_hash"), ["doc_id", "key"]).select("doc_id", "key", "text", "whole", "single")
    cut = cut.mapInArrow(_cut, "doc_id long, key long, n_removed long, sha string").dropDuplicates(["doc_id", "key"]).withColumnRenamed("sha", "kept")
    return base.join(cut, ["doc_id", "key"], "left").select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"), F.coalesce("kept", "sha").alias("kept_sha256"))
