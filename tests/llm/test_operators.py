"""Every operator against a plain brute-force version on the smallest tables."""

import base64
import collections
import hashlib
import os
import re
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from rasterspark.llm import decontaminate, minhash, mixing, quality_model, rangecoder, rules, secrets, simhash, substrings, tokens, urlfilter, warc
from rasterspark.llm.common import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def by_id(rows):
    return {r.doc_id: r for r in rows}


def slow_fingerprint(text):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(w[i : i + 4]) for i in range(len(w) - 3)] or [" ".join(w)] * bool(w)
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_groups(fps):
    """id to least id reachable, of (id, fingerprint)."""
    root = {i: i for i, _ in fps}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for n, (i, a) in enumerate(fps):
        for j, b in fps[:n]:
            if (a ^ b).bit_count() <= 4:
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in root}


@pytest.mark.parametrize("max_cell", [20_000, 2])
def test_simhash(docs, max_cell):
    got = by_id(simhash.near_duplicates(docs, max_cell=max_cell).collect())
    fps = [(r.doc_id, slow_fingerprint(r.text)) for r in docs.collect()]
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == dict(fps)
    assert {i: r.component_id for i, r in got.items()} == slow_groups(sorted(fps))


def test_simhash_dense(spark):
    rng = np.random.default_rng(3)
    base = int(rng.integers(0, 1 << 62))
    fps = sorted({base ^ sum(1 << int(b) for b in rng.choice(63, 3, replace=False)) for _ in range(300)})
    want = slow_groups([(f, f) for f in fps])
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    for cap in (20_000, 40):
        roots = {r.node: r.root for r in components(simhash.links(df, cap)).collect()}
        assert {f: roots.get(f, f) for f in fps} == want


def test_minhash(spark):
    rng = np.random.default_rng(4)
    rows = []
    for base in range(12):
        words = [f"w{i}" for i in rng.integers(0, 2000, 200)]
        for copy in range(6):
            edited = list(words)
            for at in rng.choice(200, copy, replace=False):
                edited[at] = f"new{base}-{copy}-{at}"
            rows.append((len(rows), " ".join(edited).upper() if copy == 5 else " ".join(edited)))
    sets = {i: {tuple(t.lower().split()[k : k + 5]) for k in range(196)} for i, t in rows}
    pairs = {(i, j): len(sets[i] & sets[j]) / len(sets[i] | sets[j]) for i in sets for j in sets if i < j}
    assert any(0.8 <= v < 0.85 for v in pairs.values())
    df = spark.createDataFrame(rows, "doc_id long, text string")
    group = {r.doc_id: r.group for r in minhash.groups(df).collect()}
    assert all(group[i] == group[j] for (i, j), v in pairs.items() if v >= 0.8)
    assert all(i // 6 == j // 6 for i in group for j in group if group[i] == group[j])
    from corpus_pipeline import near_duplicates

    assert {r.doc_id for r in near_duplicates(spark, df, "").collect()} == {min(j for j in group if group[j] == g) for g in group.values()}


def test_minhash_recall_on_chains(spark):
    """Families of texts that drift apart step by step: neighbours are alike, ends are not. Thousands of pairs, against brute force."""
    rng = np.random.default_rng(8)
    rows = []
    for family in range(40):
        words = [f"f{family}w{i}" for i in rng.integers(0, 4000, 150)]
        for step in range(40):
            rows.append((len(rows), family, " ".join(words)))
            words[int(rng.integers(0, 150))] = f"n{family}s{step}"
    sets = [frozenset(tuple(t.split()[k : k + 5]) for k in range(146)) for _, _, t in rows]
    pairs = [(i, j) for f in range(40) for i in range(f * 40, f * 40 + 40) for j in range(i + 1, f * 40 + 40) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert len(pairs) > 3000
    df = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text string")
    group = {r.doc_id: r.group for r in minhash.groups(df).collect()}
    met = sum(group[i] == group[j] for i, j in pairs)
    assert met >= 0.99 * len(pairs)
    assert all(rows[i][1] == rows[j][1] for i in range(len(rows)) for j in (i - 1,) if i and group[i] == group[j])
    once = {r.doc_id: r.group for r in minhash.groups(df, rounds=1).collect()}
    assert met >= sum(once[i] == once[j] for i, j in pairs)


def test_minhash_settles_crowded_bands(spark):
    """Many unlike families in one band, half of their shingles common to all: whoever is alike is linked, against brute force."""
    rng, rows = np.random.default_rng(12), []
    common = rng.integers(0, 1 << 30, 60).tolist()
    for _ in range(70):
        own = rng.integers(0, 1 << 30, int(rng.integers(20, 120))).tolist()
        for copy in range(3):
            lost = int(rng.integers(0, 25))
            rows.append((common + own)[lost:] + rng.integers(0, 1 << 30, copy).tolist())
    sets = [frozenset(r) for r in rows]
    pairs = [(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j])]
    assert any(i // 3 != j // 3 for i, j in pairs) or len(pairs) > 70
    table = [(i, 1000 + i, [7], r) for i, r in enumerate(rows)]
    df = spark.createDataFrame(table, "nr long, node long, bands array<long>, shingles array<int>")
    found = minhash.links(df, df.select("node", "nr"))
    got = {r.node: r.root for r in components(found).collect()}
    alone = df.select("node", F.lit(7).cast("long").alias("band"), F.when(F.col("nr") < 30, 1030).otherwise(F.col("node")).alias("root"))
    want = {frozenset(p) for p in pairs if p[1] >= 30}
    for chunk in (2000, 17):  # one part and many
        links = {frozenset((r.a - 1000, r.b - 1000)) for r in minhash._rest(alone, df, df.select("node", "nr"), 0.8, chunk).collect()}
        assert links <= want and {p for p in want if min(p) >= 30} <= links
    root = {i: i for i in range(len(rows))}
    for _ in rows:  # least reachable, by relaxing
        before = dict(root)
        for i, j in pairs:
            root[i] = root[j] = min(root[i], root[j])
        if root == before:
            break
    assert {i: got.get(1000 + i, 1000 + i) - 1000 for i in root} == root


def test_nodes_of_different_sets_are_told_apart(spark):
    rows = spark.createDataFrame([(1, 5, 10), (2, 5, 10), (3, 5, 11), (4, 6, 1)], "doc_id int, node long, check long")
    got = {r.doc_id: r.node for r in minhash._told_apart(rows).collect()}
    assert got[1] == got[2] != got[3] and got[4] == 6
    assert {r.node for r in minhash._told_apart(rows.where("doc_id <> 3")).collect()} == {5, 6}


def test_listed_by_content(spark):
    at = "/root/testdata/sf0.01"
    pages, docs, labels = (spark.read.parquet(f"{at}/{t}.parquet") for t in ("pages", "documents", "labels"))

    def said(text):
        parts = (p.strip(". \t\r") for p in re.split(r"[\n<>]+|\. ", text or ""))
        return {p for p in parts if len(WORD.findall(p)) >= urlfilter.TELLING}

    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    bad, good = set(), set()
    for r in docs.collect():
        if r.doc_id in toxic:
            (bad if toxic[r.doc_id] else good).update(said(r.text))
    want = {r.url for r in pages.collect() if said(r.html) & (bad - good)}
    listed = urlfilter.bad_content(pages, docs, labels)
    assert {r.url for r in listed.collect()} == want and want
    assert not any(re.search("|".join(urlfilter.LISTED_WORDS), u.split("/")[2]) for u in want)  # no host test finds these
    from rasterspark.llm import queries

    rows = queries.op9_url_filter(spark, at).collect()
    by_content = {r.page_id for r in pages.collect() if r.url in want}
    assert {r.page_id for r in rows if r.listed} >= by_content and any(r.verdict == "block" and r.rule is None and r.page_id in by_content for r in rows)
    assert urlfilter.bad_content(pages, docs, labels.limit(0)).count() == 0
    odd = spark.createDataFrame([(None, None), ("http://a.b/c", None), (None, "x"), ("http://a.b/d", "<p>one two three four five six seven eight</p>"), ("http://a.b/d", "<p>one two three four five six seven eight</p>")], "url string, html string")
    texts = spark.createDataFrame([(1, None), (2, "One. one two three four five six seven eight. End"), (None, "x")], "doc_id long, text string")
    marks = spark.createDataFrame([(1, 1), (2, 1), (None, 1), (3, None)], "doc_id long, toxic int")
    assert [r.url for r in urlfilter.bad_content(odd, texts, marks).collect()] == ["http://a.b/d"]


def test_components_of_a_chain(spark):
    e = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 600)], "a long, b long")
    assert {r.node: r.root for r in components(e).collect()} == {i: 0 for i in range(201)} | {500: 500, 600: 500}


def test_mixing(docs):
    rows = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))
    source = {r.doc_id: r.source for r in docs.collect()}
    size = {r.doc_id: len(WORD.findall(r.text or "")) for r in docs.collect()}
    per = collections.Counter()
    for i, n in size.items():
        per[source[i]] += n
    want = mixing.targets(per)
    assert abs(sum(want.values()) - 1.5 * sum(per.values())) < 1e-3
    took = collections.Counter()
    for r in rows:
        assert r.size == size[r.doc_id] and r.source_size == per[source[r.doc_id]] and abs(r.target - want[source[r.doc_id]]) < 1e-6
        assert r.taken in (0, r.size, 2 * r.size)
        took[source[r.doc_id]] += r.taken
    for s, t in want.items():
        assert abs(took[s] - t) <= max(size[i] for i in size if source[i] == s)


def test_flow_uses_repetition_last():
    assert mixing.route({("a", "b"): 100, ("a",): 50}, {"a": 60, "b": 120}) == {("a", "b"): 130, ("a",): 50}
    assert mixing.route({("a", "b"): 10, ("a",): 10}, {"a": 10, "b": 10}) == {("a", "b"): 10, ("a",): 10}


def test_decontamination(docs, benchmark):
    norm = lambda t: " ".join(WORD.findall(t or ""))
    items = [(r.item_id, norm(r.text)) for r in benchmark.collect()]
    want = {r.doc_id: [i for i, t in items if t in norm(r.text)] for r in docs.collect()}
    got = by_id(decontaminate.contamination(docs, benchmark).collect())
    assert any(want.values())
    for i, found in want.items():
        assert set(found) <= set(got[i].items) and got[i].contaminated == bool(got[i].items)


def test_reparameterised(spark):
    item = "What mass of 5 kg does the strong Bob carry to the river when 5 kg are lost"
    d = spark.createDataFrame([(1, item.replace("5", "7").replace("Bob", "Alice")), (2, item.replace("5", "7", 1)), (3, item)], "doc_id long, text string")
    b = spark.createDataFrame([(9, item)], "item_id long, text string")
    got = by_id(decontaminate.contamination(d, b).collect())
    assert [got[i].contaminated for i in (1, 2, 3)] == [True, False, True]
    assert [got[i].verbatim for i in (1, 3)] == [False, True]


def test_redrawn_to_one_value(spark):
    item = "What mass of 3 kg does the strong man carry to the river when 4 kg are lost"
    d = spark.createDataFrame([(1, item.replace("3", "5").replace("4", "5")), (2, item.replace("3", "6").replace("4", "7"))], "doc_id long, text string")
    got = by_id(decontaminate.contamination(d, spark.createDataFrame([(9, item)], "item_id long, text string")).collect())
    assert [got[i].contaminated for i in (1, 2)] == [True, True]


def test_exact_way(spark):
    dense = "12 kg 14 m 7 s 3 h Alice 9 kg Bob 8 m 5 s Carol 4 h"
    short, listed = "Grass is green", "Name the seven long rivers of the north"
    long = " ".join(f"plain{i}x" for i in range(30)) + " of 5 kg " + " ".join(f"plain{i}y" for i in range(40)) + " of 5 kg"
    capital = "Find the sum of 4 and 9 apples"
    b = spark.createDataFrame(list(enumerate([dense, short, listed, long, capital, "...", None])), "item_id long, text string")
    texts = [f"note {dense} end", "we know (grass is GREEN), they say", f"List\n{listed}\nend", long.replace("5 kg", "7 kg", 1), "Quiz\nFind the sum of 3 and 8 apples", "grass is not green ... so"]
    got = by_id(decontaminate.contamination(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), b).collect())
    assert [got[i].items for i in range(6)] == [[0], [1], [2], [3], [4], []]
    assert [got[i].verbatim for i in range(5)] == [True, True, True, False, False]


def test_one_template_of_many_items(spark):
    """Work and result grow with items and documents, not with their product."""
    say = lambda a, b, c: f"A farmer has {a} green apples and gives {b} of them to the old baker who then bakes {c} pies for the whole village feast"
    n = 400
    items = spark.createDataFrame([(i, say(i + 1000, i * 7 + 3, i + 9000)) for i in range(n)], "item_id long, text string")
    texts = [f"note {k} " + say(k + 50000, k * 3 + 70000, k + 90000) for k in range(n)] + [say(1005, 38, 9005) + " indeed", "nothing of the kind is said here at all today", say(1005, 1005, 5)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    kinds = {tuple(r) for r in decontaminate.classes(items).select("text_id", "class_id").collect()}
    assert kinds == {(i, 0) for i in range(n)}
    units = decontaminate._units(decontaminate._items(items))
    index = decontaminate._index(units)
    assert units.where("kind = 'template'").count() == 1
    got = by_id(decontaminate.contamination(docs, items).collect())
    assert all(got[k].items == [0] and not got[k].verbatim and got[k].cover == 1 for k in range(n))
    assert got[n].items == [0, 5] and got[n].verbatim and got[n + 1].items == [] and got[n + 2].contaminated
    shared = index.groupBy("h", "form").count().agg(F.max("count")).first()[0]
    assert shared < 10  # no window of the index leads to more than a few units


def test_windows_that_all_items_share_find_none(spark):
    head = "Answer the following question as briefly as you can and then give a reason for it in one line"
    items = spark.createDataFrame([(i, head + " " + " ".join(f"w{i}x{j}y" for j in range(30))) for i in range(60)], "item_id long, text string")
    docs = spark.createDataFrame([(1, head), (2, head + " of something else"), (3, head + " " + " ".join(f"w7x{j}y" for j in range(30)))], "doc_id long, text string")
    got = by_id(decontaminate.contamination(docs, items).collect())
    assert [got[i].items for i in (1, 2, 3)] == [[], [], [7]] and got[3].verbatim
    windows = decontaminate._index(decontaminate._units(decontaminate._items(items)))
    assert windows.where(F.col("form").contains("briefly")).count() == 0


def slow_cut(docs):
    words = {i: WORD.findall(t or "") for i, t in docs.items()}
    least = {}
    for i in sorted(words):
        for k in range(len(words[i]) - 49):
            least.setdefault(tuple(words[i][k : k + 50]), i)
    out = {}
    for i, w in words.items():
        gone = [False] * len(w)
        for k in range(len(w) - 49):
            if least[tuple(w[k : k + 50])] < i:
                gone[k : k + 50] = [True] * 50
        out[i] = (len(w), sum(gone), hashlib.sha256(" ".join(x for x, g in zip(w, gone) if not g).encode()).hexdigest())
    return out


def test_substrings(docs):
    got = {r.doc_id: tuple(r)[1:] for r in substrings.cut_repeats(docs).collect()}
    assert got == slow_cut({r.doc_id: r.text for r in docs.collect()})


def test_substrings_forked(spark):
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in rng.integers(0, 50, 400)]
    texts = {}
    for i in range(40):
        w = list(base[int(rng.integers(0, 200)) :][: int(rng.integers(40, 200))])
        if i % 2:
            w[int(rng.integers(0, len(w)))] = f"new{i}"
        texts[i] = " ".join(w)
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    for words in (2_000_000, 500, 60):  # groups of any size, parted by longer and longer prefixes, and by whole heads
        assert {r.doc_id: tuple(r)[1:] for r in substrings.cut_repeats(df, words=words).collect()} == slow_cut(texts)


def alike():
    """Two words of 1,024 letters that polynomial hashes modulo 2**64 take for each other (Thue and Morse)."""
    word = "".join("ab"[i.bit_count() % 2] for i in range(1024))
    return word, word.translate(str.maketrans("ab", "ba"))


def test_words_that_hash_alike_are_told_apart(spark):
    one, other = alike()
    head, tail = " ".join(f"h{i}" for i in range(49)), " ".join(f"t{i}" for i in range(49))
    texts = {1: f"{head} {one} {tail}", 2: f"{head} {other} {tail}", 3: f"{head} {one} {tail} end"}
    got = {r.doc_id: tuple(r)[1:] for r in substrings.cut_repeats(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert got == slow_cut(texts) and got[2][1] == 0 and got[3][1] == 99
    assert len(np.intersect1d(minhash.shingles(texts[1]), minhash.shingles(texts[2]))) == 90


def test_subtrees_compare_words():
    words = [f"w{i}" for i in range(60)]
    other = [*words[:49], "new", *words[50:]]
    rows = [(1, 5, 0, 0, 11, " ".join(words)), (1, 7, 0, 3, 11, " ".join(words)), (1, 9, 0, 0, 11, " ".join(other))]
    batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), substrings._RUN_TYPES)], substrings._RUN)
    got = {(r["doc_id"], r["at"]) for r in substrings._subtrees(batch).to_pylist()}
    assert got == {(7, 3 + j) for j in range(11)}  # of the other 49 words in a row at most


def test_classifier(spark):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = by_id(quality_model.score(d, lab).collect())
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 3 == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    known = [(got[r.doc_id], r.quality) for r in lab.collect() if r.doc_id in got and got[r.doc_id].held_out]
    assert sum(r.predicted == q for r, q in known) / len(known) > 0.95


def test_isotonic():
    fit = quality_model.isotonic(np.ones(5), np.array([0.0, 0.6, 0.4, 0.5, 1.0]))
    assert np.allclose(fit, [0, 0.5, 0.5, 0.5, 1])


def test_warc(spark, pages):
    rows = [r for r in pages.collect()]
    both = pages.union(spark.createDataFrame([(10_000, "http://x/\r\ny", rows[0].html), (10_001, None, None), (10_002, "u", "")], pages.schema))
    got = {r.page_id: tuple(r)[1:] for r in warc.read(warc.normalise(warc.write(both, file_bytes=200_000))).collect()}
    first = {}
    for r in sorted(both.collect(), key=lambda r: r.page_id):
        first.setdefault(r.html or "", r.page_id)
    for r in both.collect():
        data, at = (r.html or "").encode(), first[r.html or ""]
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert got[r.page_id] == (len(data), digest, *(("response", None) if at == r.page_id else ("revisit", at)))
    assert got[10_002][3] == 10_001


def test_a_revisit_must_be_like_its_response(spark, tmp_path):
    for i, refers_to in enumerate((1, 7, 3)):  # as it should be, of no page, of a page with another payload
        rows = spark.createDataFrame([(1, "u", "same", None), (2, "u", "same", refers_to), (3, "u", "other", None)], "page_id long, url string, html string, refers_to long")
        files = rows.coalesce(1).mapInArrow(warc._writer(f"file://{tmp_path}/{i}", 1 << 20), "file string, n long")
        back = warc.read(warc.normalise(spark.createDataFrame(files.collect(), files.schema)))
        if not i:
            assert sorted((r.page_id, r.record_type, r.refers_to) for r in back.collect()) == [(1, "response", None), (2, "revisit", 1), (3, "response", None)]
        else:
            with pytest.raises(Exception, match="refers to no response"):
                back.collect()


def test_secrets(docs):
    got = by_id(secrets.scan(docs).collect())
    for r in docs.collect():
        t = r.text or ""
        spans = [(m.start(), 0, m.end()) for m in re.finditer(secrets._ASSIGN, t, re.I | re.A) if len(m[2]) >= 12]
        spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
        spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
        line = ",".join(f"{secrets.KINDS[k]}:{s}:{e}" for s, k, e in sorted(spans))
        assert got[r.doc_id].base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert set(filter(None, line.split(","))) <= set(got[r.doc_id].spans.split(","))


def test_unseen_formats_are_found(spark):
    """Planted secrets of formats that neither the patterns nor the examples know."""
    rng, alnum = np.random.default_rng(8), secrets._ALNUM
    formats = {"mail": ("SG.", (alnum, 22, 22), ".", (alnum + "_-", 43, 43)), "package": ("npm_", (alnum, 36, 36)), "letters": ((secrets._UPPER + secrets._LOWER, 24, 24),), "map": ("AIza", (alnum + "_-", 35, 35)), "key line": ((alnum + "+/", 64, 64),), "lab": ("glpat-", (alnum + "_-", 20, 20))}
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    planted = []
    texts = [r.text for r in docs.where("length(text) > 300").orderBy("doc_id").limit(240).collect()]
    for i, t in enumerate(texts):
        name = list(formats)[i % len(formats)]
        s, cut = secrets.made_secret(formats[name], rng), t.rfind(" ", 0, 150) + 1
        planted.append((1_000_000 + i, f"{t[:cut]}{s} {t[cut:]}", name, cut, cut + len(s)))
    df = docs.union(spark.createDataFrame([p[:2] for p in planted], docs.schema))
    got = by_id(secrets.scan(df).collect())
    hit = collections.Counter()
    for i, _, name, s, e in planted:
        spans = [x.split(":") for x in got[i].spans.split(",") if x]
        hit[name] += any(int(a) < e and s < int(b) for _, a, b in spans)
    assert all(hit[name] >= 0.9 * len(planted) / len(formats) for name in formats), hit
    clean = [r for i, r in got.items() if i < 1_000_000]
    assert sum("net:" in r.spans for r in clean) <= 0.01 * len(clean)


def test_every_finding_is_learnt_from(spark, docs):
    """All different labelled pieces are dealt to shards, once each, and every shard trains; none is cut off."""
    rows = [(i, f"note {i} token = {'Q7' * 6}{i:04d} and plain{'xyz' * 6}{i:04d} end") for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = spark.createDataFrame(df.mapInArrow(secrets._scan, "doc_id long, base array<struct<s:int,e:int,kind:string>>, cands array<struct<s:int,e:int,label:int,piece:string>>").collect(), "doc_id long, base array<struct<s:int,e:int,kind:string>>, cands array<struct<s:int,e:int,label:int,piece:string>>")
    pieces = {(c.label > 0, c.piece) for r in found.collect() for c in r.cands if c.label >= 0}
    got = secrets.shards(found, size=100).collect()
    assert len(got) >= 7 and sum(r.unsure for r in got) == sum(not y for y, _ in pieces) == 700
    named = sum(k - 1 in [secrets.NAMES.index(n) for n in secrets.KINDS[:3]] for r in got for k in r.kinds)
    assert named == sum(y for y, _ in pieces) == 700
    seen = []
    net = secrets.Network()
    net._forward = lambda x, f=net._forward: (seen.extend(x[:, 0].tolist()), f(x))[1]
    x = np.repeat(np.arange(1, 101, dtype=np.uint8)[:, None], secrets.LEFT + secrets.PIECE + secrets.RIGHT, axis=1)
    net.fit(x, np.arange(100) % 2.0, steps=1, batch=30)
    assert set(seen) == set(range(1, 101))


def test_network_learns():
    rng = np.random.default_rng(0)
    hexes = ["".join(rng.choice(list("0123456789abcdef"), 32)) for _ in range(200)]
    words = ["".join(rng.choice(list("etaoinshr"), 30)) + "1" for _ in range(200)]
    x = secrets._codes([f"some \1{w}\2 text" for w in hexes + words])
    y = np.array([1.0] * 200 + [0.0] * 200)
    net = secrets.Network()
    net.fit(x, y)
    net.calibrate(x, y, 0.95)
    p = net.probability(x)
    assert (p[:200] >= net.threshold).mean() >= 0.95 and (p[200:] >= net.threshold).mean() < 0.05


def _plain_step(p, x, y, depth=8, width=4):
    """Loss and gradients of the network by its definition: every position of every padded piece."""
    e, steps = p["emb"][x], x.shape[1] - width + 1
    cols = np.concatenate([e[:, i : i + steps] for i in range(width)], axis=2)
    top = np.maximum(cols @ p["w"] + p["b"], 0)
    n, best = p["b"].size, top.argmax(1)
    inside = (x[:, :steps] >= 128) & (x[:, width - 1 :] >= 128)
    share = inside / np.maximum(inside.sum(1, keepdims=True), 1)
    h = np.concatenate([np.take_along_axis(top, best[:, None], 1)[:, 0], (share[:, None] @ top)[:, 0]], axis=1)
    z = h @ p["v"] + p["c"][0]
    g = (1 / (1 + np.exp(-z)) - y) / len(x)
    up = share[:, :, None] * (g[:, None] * p["v"][n:])[:, None]
    up[np.arange(len(x))[:, None], best, np.arange(n)[None]] += g[:, None] * p["v"][:n]
    up *= top > 0
    down, emb = (up @ p["w"].T).reshape(len(x), steps, width, depth), np.zeros_like(p["emb"])
    for i in range(width):
        np.add.at(emb, x[:, i : i + steps], down[:, :, i])
    return z, {"v": h.T @ g, "c": np.array([g.sum()]), "b": up.sum((0, 1)), "w": (cols.transpose(0, 2, 1) @ up).sum(0), "emb": emb}


def test_network_skips_what_cannot_matter():
    """Same logits and gradients as by definition; no windows are multiplied behind the longest piece."""
    rng = np.random.default_rng(3)
    word = lambda n: "".join(rng.choice(list(secrets._ALNUM + "-_ "), n))
    sizes = [(rng.integers(0, 25), rng.integers(1, 65), rng.integers(0, 17)) for _ in range(60)] + [(24, 64, 16), (0, 1, 0), (0, 3, 5), (3, 4, 0)]
    x = secrets._codes([f"{word(a)}\1{word(b)}\2{word(c)}" for a, b, c in sizes])
    net, y = secrets.Network(4), rng.integers(0, 2, len(x)).astype(float)
    short = secrets._codes(["\1abcdefghijklmnop\2 end"] * 10)
    windows = net._forward(short)[3].size // (net.WIDTH * net.DEPTH)
    assert windows <= 10 * (20 + 1)
    net.p["b"] = rng.normal(0, 0.3, net.p["b"].shape).astype(np.float32)
    for part in (x, x[-3:], x[-3:-2], x[:1]):
        z, want = _plain_step({k: v.astype(float) for k, v in net.p.items()}, part, y[: len(part)])
        assert np.allclose(net.logits(part), z, atol=1e-5)
        got = net._gradients(part.astype(np.uint8), y[: len(part)])
        assert all(np.allclose(got[k], want[k], atol=1e-6) for k in want)


def test_many_shards_share_few_tasks(spark, monkeypatch):
    """A round's tasks do not grow with shards times networks, and its means are those of all shards trained one by one."""
    rng, n = np.random.default_rng(6), 30
    shards = [(i, rng.integers(1, 256, (6, 104), np.uint8), bytes(rng.integers(0, 2, 6).tolist()), 0) for i in range(n)]
    data = spark.createDataFrame([(i, bytearray(x.tobytes()), bytearray(k), u) for i, x, k, u in shards], secrets._SHARD)
    parts = []
    monkeypatch.setattr(secrets, "ROUNDS", 1)
    monkeypatch.setattr(secrets, "STEPS", 2)
    monkeypatch.setattr(secrets, "small_batches", lambda df: parts.append(df.rdd.getNumPartitions()) or df)
    nets, want = [secrets.Network(5 + i) for i in range(12)], np.zeros((12, 3, secrets.Network().state().shape[1]))
    for i, net in enumerate(nets):
        for shard, x, kinds, _ in shards:
            one = secrets.Network().load(net.state())
            one.fit(x, (np.frombuffer(kinds, np.uint8) > 0).astype(float), [5, shard, 0, i % secrets.MEMBERS], 2)
            want[i] += one.state() / n
    secrets._averaged(data, nets, lambda i, kinds, unsure: np.ones(len(kinds), bool), 5)
    assert parts and max(parts) <= 96
    assert all(np.allclose(net.state(), w, atol=1e-6) for net, w in zip(nets, want))


def test_training_keeps_its_memory():
    """Steps after the first few take no pages from the system."""
    code = """
import resource, numpy as np
from rasterspark.llm import secrets
x = np.random.default_rng(0).integers(1, 256, (256, 104), np.uint8)
net = secrets.Network()
net.fit(x, np.arange(256) % 2.0, steps=5)
before = resource.getrusage(resource.RUSAGE_SELF).ru_minflt
net.fit(x, np.arange(256) % 2.0, steps=20)
print(resource.getrusage(resource.RUSAGE_SELF).ru_minflt - before)
"""
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, cwd=Path(__file__).parents[2], env=os.environ | {"OMP_NUM_THREADS": "1"}, check=True)
    assert int(out.stdout) < 20 * 100


def test_scores_and_thresholds_are_in_the_same_precision():
    net = secrets.Network()
    net.scale, net.offset = 1.37, -0.21
    z = np.random.default_rng(1).normal(0, 2, 500).astype(np.float32)
    assert net.squash(z).tolist() == [float(net.squash(float(v))) for v in z]


def test_every_uncovered_candidate_is_asked():
    class Sure:
        threshold = 0.5

        def probability(self, x):
            return np.ones(len(x))

    texts = ["take QwXzKjVbGhPlMtRd with you", "take abcdefgh.jklmnopq.z with", "token=ABCDEFGHIJKL, 0123456789abcdef+QwXzKjVbGhPlMtRdAA", "none of it is long"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(4), pa.int64()), pa.array(texts)], ["doc_id", "text"])
    spans = [s for b in secrets._report(Sure())(secrets._scan([batch])) for s in b.column(5).to_pylist()]
    assert spans == ["net:5:21", "net:5:24", "assign:0:18,hex:20:36,net:36:55", ""]


def test_token_files(docs):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(tokens.default_vocabulary())
    got, at = {r.doc_id: tuple(r) for r in tokens.read(tokens.write(docs, block=5000)).collect()}, 0
    for r in sorted(docs.collect(), key=lambda r: r.doc_id):
        ids = tk.encode(r.text or "", add_special_tokens=False).ids + [2]
        assert got[r.doc_id] == (r.doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)


def test_words_one_by_one():
    texts = ["It's İstanbul <|endoftext|>x <|ENDOFTEXT|> ça—va ０１２ don't!! e\u0301a straße. ǅ ªº", None, "", "a.b, ... — —. x\u00a0y\x1cz", "S'T 'LL.", "it's. o'clock, I'm. ÉÀ. ß,", "(Straße) <|endoftext|> <|x|> \"çà!\" ÿ÷×Þ A-B __a__ $$$"]
    w = tokens.WordIds(tokens.default_vocabulary())
    ids, counts = w.encode(pa.array(texts), None)
    assert w.by_word
    want = [w.tokenizer.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert ids.tolist() == sum(want, []) and counts.tolist() == list(map(len, want))
    w.by_word = False
    ids, counts = w.encode(pa.array(texts), None)
    assert ids.tolist() == sum(want, []) and counts.tolist() == list(map(len, want))


def test_other_vocabularies_get_whole_texts():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    w, texts = tokens.WordIds(path), ["Some  text, with spaces\n kept", None, "  lead"]
    want = [Tokenizer.from_file(path).encode(t or "", add_special_tokens=False).ids for t in texts]
    ids, counts = w.encode(pa.array(texts), None)
    assert not w.by_word and ids.tolist() == sum(want, []) and counts.tolist() == list(map(len, want))


def test_a_full_memory_of_words_keeps_those_at_hand():
    w = tokens.WordIds(tokens.default_vocabulary())
    w.LIMIT = 50
    rng = np.random.default_rng(6)
    for turn in range(8):
        texts = [" ".join(f"w{i}x" for i in rng.integers(turn * 20, turn * 20 + 60, 40)), "", None, "Déjà vu, isn't it? <|x|> 12.5"]
        ids, counts = w.encode(pa.array(texts))
        want = [w.tokenizer.encode(t or "", add_special_tokens=False).ids + [tokens.END] for t in texts]
        assert ids.tolist() == sum(want, []) and counts.tolist() == list(map(len, want))
        assert len(w.index) == len(w.start) == len(w.size) < 200


def test_many_documents_in_many_blocks_and_files(spark):
    from tokenizers import Tokenizer

    tk = Tokenizer.from_file(tokens.default_vocabulary())
    rows = [(None, f"null number {i}") for i in range(400)] + [(i, " ".join(f"word{k}" for k in range(i % 7))) for i in range(3000)] + [(4000, "long " * 30_000), (4001, None), (4001, "twice"), (4001, "twice")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    files = tokens.write(df, block=300, file_ids=2_000, gather=20_000)
    got = tokens.read(files).collect()
    assert files.count() >= 3 and files.select("part").distinct().count() == files.count()
    want = collections.Counter((i, zlib.crc32(np.array(tk.encode(t or "", add_special_tokens=False).ids + [tokens.END], "<u4").tobytes())) for i, t in rows)
    assert collections.Counter((r.doc_id, r.ids_crc32) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    order = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert order == sorted(order, key=lambda i: (i is not None, i or 0))
    # rows of one id are several tasks' work
    first = F.col("doc_id").asc_nulls_first()
    one = df.where("doc_id is null").select("doc_id", F.xxhash64("text").alias("h"), F.monotonically_increasing_id().alias("nr")).repartitionByRange(4, first, "h", "nr")
    assert one.select(F.spark_partition_id().alias("p")).groupBy("p").count().agg(F.max("count")).first()[0] < 250


def test_token_writer_takes_few_texts_at_a_time(docs, monkeypatch, tmp_path):
    sizes = []

    class Words:
        def encode(self, texts):
            sizes.append(texts.nbytes)
            return np.full(len(texts), 2, np.uint16), np.ones(len(texts), np.int64)

    monkeypatch.setattr(tokens, "_word_ids", lambda _: Words())
    monkeypatch.setattr(tokens.TaskContext, "get", lambda: type("C", (), {"partitionId": staticmethod(lambda: 0)}))
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(500), pa.int64()), "text": ["word " * 400] * 500})
    (file,) = tokens._writer(f"file://{tmp_path}", "", tokens.BLOCK, tokens.FILE_IDS, tokens.GATHER)([batch] * 12)
    assert file.column("n_docs").to_pylist() == [6000] and max(sizes) < 6 << 20


def test_damaged_token_file(spark, docs, tmp_path):
    import glob
    import struct

    tokens.write(docs, f"file://{tmp_path}").count()
    file = sorted(glob.glob(f"{tmp_path}/*.rstf"))[0]
    data = open(file, "rb").read()
    tail = struct.calcsize(tokens._TAIL)
    at, size, *_ = struct.unpack(tokens._TAIL, data[-tail:])
    table = np.frombuffer(zlib.decompress(data[at : at + size]), "<i8").copy()
    table[-1] += 1
    table = zlib.compress(table.tobytes())
    n, nulls, magic = struct.unpack(tokens._TAIL, data[-tail:])[3:]
    open(file, "wb").write(data[:at] + table + struct.pack(tokens._TAIL, at, len(table), zlib.crc32(table), n, nulls, magic))
    with pytest.raises(Exception, match="fewer ids"):
        list(tokens._reader([pa.RecordBatch.from_pydict({"part": pa.array([0], pa.int32()), "file": [f"file://{file}"]})]))


@pytest.mark.parametrize("ids", [[0], [65535] * 700, list(range(5)) * 300, "random", "skewed"])
def test_range_coder(ids):
    rng = np.random.default_rng(2)
    x = rng.integers(0, 65536, 9000) if ids == "random" else np.minimum(rng.geometric(0.02, 20_000), 60_000) if ids == "skewed" else np.array(ids)
    data = rangecoder.encode_block(x.astype(np.uint32))
    assert rangecoder.block_size(data) == len(data) and (rangecoder.decode_block(data) == x).all()
    with pytest.raises(ValueError):
        rangecoder.decode_block(data[:-1] + bytes([data[-1] ^ 1]))


def test_coder_learns_what_follows():
    rng = np.random.default_rng(6)
    follow = rng.integers(0, 40_000, (500, 6))  # each id is followed by one of six
    x, at = [], 0
    for pick in rng.integers(0, 6, 300_000):
        x.append(at)
        at = int(follow[at % 500, pick])
    x = np.array(x, np.uint16)
    assert 8 * len(rangecoder.encode(x)) / len(x) < 5 and len(rangecoder.encode(x)) < len(zlib.compress(x.tobytes(), 9))


def test_urls(spark, pages):
    got = {r.page_id: r for r in urlfilter.judge(pages, bits_per_url=1).collect()}
    for r in pages.collect():
        m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", r.url or "")
        host, path = (m[1].lower(), m[2]) if m else ("", "")
        fit = [(len(h) + len(p), h + p, k) for k, h, p in urlfilter.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        bad = any(w in host for w in urlfilter.LISTED_WORDS)
        x = got[r.page_id]
        assert (x.host, x.path, x.rule) == (host, path, max(fit)[1] if fit else None)
        assert x.verdict == (max(fit)[2] if fit else "block" if bad else "allow") and x.listed == bad


def test_list_decides_without_a_rule(spark):
    urls = ["http://blog.adult-x.example.net/en/a", "http://free-bets.example.org/en/a", "http://m.ads-track.example.org/x", "http://clean.example.net/en/a", "https://www.clean.example.net/en/a/?utm_source=b", "http://clean.example.net/en/b"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.page_id: r for r in urlfilter.judge(df).collect()}
    assert [got[i].rule for i in range(6)] == [None] * 6
    assert [got[i].verdict for i in range(6)] == ["block"] * 3 + ["allow"] * 3
    got = {r.page_id: r.verdict for r in urlfilter.judge(df, spark.createDataFrame([(urls[3],)], "url string")).collect()}
    assert [got[i] for i in range(6)] == ["allow"] * 3 + ["block", "block", "allow"]


def test_bloom_misses_nothing_and_passes_little(spark):
    listed = spark.range(5000).select(F.xxhash64(F.concat(F.lit("bad.example/"), F.col("id"))).alias("h"))
    others = spark.range(40_000).select(F.xxhash64(F.concat(F.lit("good.example/"), F.col("id"))).alias("h"))
    blocks = 5000 * urlfilter.BITS_PER_URL // 256
    table = urlfilter.bloom(listed, blocks)
    for limit in (0, 1 << 18):  # joined by shuffle, broadcast
        assert urlfilter.may_be_listed(listed, table, blocks, limit).count() == 5000
        assert 0 < urlfilter.may_be_listed(others, table, blocks, limit).count() < 0.01 * 40_000


def test_first_of_equally_long_rules(spark):
    rules_ = (("block", "a.net", "/"), ("allow", "net", "/xx"))
    rule, verdict = urlfilter.rule_columns(F.lit("a.net"), F.lit("/xx"), rules_)
    assert tuple(spark.range(1).select(rule, verdict).first()) == ("a.net/", "block")


def slow_counts(t):
    t = t or ""
    w = WORD.findall(t)
    grams = [tuple(w[i : i + 3]) for i in range(len(w) - 2)]
    n = collections.Counter(grams)
    at = {j for i, g in enumerate(grams) if n[g] > 1 for j in (i, i + 1, i + 2)}
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(at), len(w) < 50 or 100 * len(at) > 50 * len(w))


def test_rules(docs, labels):
    got = {r.doc_id: tuple(r)[1:] for r in rules.assess(docs, labels).collect()}
    for r in docs.collect():
        assert got[r.doc_id][:6] == slow_counts(r.text) and not (got[r.doc_id][5] and got[r.doc_id][6])


def slow_level(reaches, bands):
    """The strictest level that no more than the binomial tail allows of the good documents fail."""
    import math

    n, best = len(reaches), -1
    for i in range(rules.LEVELS):
        k = sum(r <= i for r in reaches)
        if k >= n * rules.RISK or sum(math.comb(n, j) * rules.RISK**j * (1 - rules.RISK) ** (n - j) for j in range(k + 1)) > rules.DELTA / bands:
            return best
        best = i
    return best


@pytest.mark.parametrize("sizes,strata", [((900, 700, 800), (0, 1, 2)), ((100, 150, 800), (0, 0, 1)), ((100, 50, 20), (0, 0, 0)), ((900, 50, 20), (0, 0, 0)), ((900, 150, 120), (0, 1, 1)), ((0, 0, 0), (0, 0, 0))])
def test_levels_are_certified(spark, sizes, strata):
    rng = np.random.default_rng(5)
    rows = [(b * 10_000 + i, b, int(9 - min(9, rng.geometric(0.7) - 1)), 1) for b, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame([*rows, (99_999, 1, 0, 0), (99_998, 1, 0, None)], "doc_id long, band int, reach int, quality int")
    got = {r.band: r for r in rules.thresholds(df.withColumn("base_failed", F.lit(False)), df.select("doc_id", "quality")).collect()}
    for b in range(3):
        mine = [r[2] for r in rows if strata[r[1]] == strata[b]]
        assert (got[b].stratum, got[b].n, got[b].level) == (strata[b], len(mine), slow_level(mine, 3))


def test_rules_decide_beyond_the_base_rules(spark):
    d, lab = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = rules.assess(d, lab).where("not base_failed").join(lab, "doc_id").collect()
    bad, good = ([r for r in rows if r.quality == q] for q in (0, 1))
    assert any(not r.kept for r in bad) and sum(not r.kept for r in good) <= rules.RISK * len(good)
