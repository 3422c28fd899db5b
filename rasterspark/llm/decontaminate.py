"""Benchmark decontamination by template canonicalisation.

Words become template tokens: numbers, units and names turn into typed placeholders, all else is lower-cased
without outer punctuation. Windows of ``WINDOW`` tokens with at least ``LITERALS`` plain ones are hash-joined
between documents and benchmark items (items of fewer tokens give one window of their whole length). Matches
of one document and item on one diagonal (the same shift between their positions) are one alignment; its slots,
the words behind the placeholders, must map each item value to one document value. A document is contaminated if consistent alignments
cover at least ``COVER`` of an item's windows: verbatim if all slots are equal, else re-parameterised.
Windows of the lower-cased words themselves are joined beside them, whatever the words are (items of fewer words give
the whole item): a document with at least ``EXACT_COVER`` of these is contaminated too, verbatim if it has all.

What is joined are units, not items. Whether slots are consistent depends only on which of an item's slots are equal, so all
items of one template with one pattern of equal slots are one class, looked for once, by the one of least id. So are
the words of a template's windows without slots, where these alone make up ``EXACT_COVER``; else items of equal words are a
unit of their own (beside such a class, to be found word for word only). A unit is met by its rarest windows only: as many
as leave too few others to cover it (prefix filtering), so windows that many units share make no candidates.
A candidate's windows and the document's are then compared, a row each.
"""

from __future__ import annotations

import hashlib
import itertools
import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Rolling, materialise, mix64, rows_of, salted_join, small_batches, text_keys

WINDOW, LITERALS, SHORTEST, COVER, EXACT_COVER = 8, 5, 5, 0.5, 2 / 3
#: Bits (as a power of two) of the table of benchmark windows that is sent to all tasks: at least, at most.
FILTER_BITS = (22, 28)
#: Contaminated rows up to which their keys are sent to all tasks (24 bytes each).
DROP_BROADCAST = 2_000_000
# Common units of measure.
UNITS = frozenset(b"kg g mg lb lbs oz km m cm mm mi ft yd mile miles meter meters metre metres inch inches feet l ml litre litres liter liters gallon gallons s ms sec second seconds min minute minutes h hr hour hours day days week weeks month months year years mph kmh km/h m/s w kw kwh v mv a ma hz khz mhz ghz j kj cal kcal pa kpa k c f kb mb gb tb usd eur gbp dollar dollars cent cents euro euros pound pounds percent".split())
_EDGE = b"\"'`.,;:!?()[]{}<>*_|~#$%&/\\-+="
_NUMBER = re.compile(rb"[-+]?[$]?\d[\d,._/:]*(?:e[-+]?\d+)?([a-z%/]*)")
NUM, UNIT, NAME, NUM_UNIT = 1, 2, 3, 4
_words = Rolling(0xA0761D6478BD642F)


def _hash(b: bytes) -> int:
    return xxhash.xxh64_intdigest(b, 7) >> 4 << 3  # 63 bits, the low three free for flags


class _Forms(dict):
    """Word to its form: hash, bit 0 set if it may be a name, bit 1 if it ends a sentence, bit 2 for placeholders."""

    LIMIT = 1_000_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        stop = word[-1:] in b".,"
        core = word[:-1] if stop else word
        if core.isalpha() and core.islower() and core not in UNITS:  # most words: ASCII letters, perhaps a stop
            form = self[word] = _hash(core) | 2 * word.endswith(b".")
            return form
        core = word.strip(_EDGE)
        ends = 2 * word.rstrip(b"\"')]}*_").endswith((b".", b"!", b"?", b":"))
        low = core.lower()
        m = _NUMBER.fullmatch(low)
        if m and (not m[1] or m[1] == b"%" or m[1] in UNITS):
            form = _hash(b"\0%d" % (NUM_UNIT if m[1] else NUM)) | 4
        elif low in UNITS:
            form = _hash(b"\0%d" % UNIT) | 4
        else:
            text = core.decode("utf-8", "surrogatepass")
            form = _hash(text.lower().encode("utf-8", "surrogatepass")) | (text[:1].isupper() and not (len(text) > 1 and text.isupper()))
        self[word] = form | ends
        return form | ends


_NAME_FORM, _NONE = _hash(b"\0%d" % NAME), np.uint64(_hash(b""))
_EXACT = np.uint64(0xE7037ED1A0B428DB)


def template(words: list[bytes], forms: dict, begin: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each template token; whether it is a slot; hash of the word itself; whether it may be a name.

    A capital that starts no sentence makes a name. ``begin``: where texts begin, if the words are of several.
    """
    f = np.fromiter(map(forms.__getitem__, words), np.int64, len(words))
    start = np.concatenate([[True], (f[:-1] & 2) > 0]) if len(f) else np.zeros(0, bool)
    if begin is not None:
        start[begin] = True
    name = ((f & 1) > 0) & ~start
    plain = (f & ~7).astype(np.uint64)
    for i in np.flatnonzero(f & 4).tolist():
        plain[i] = _hash(words[i].strip(_EDGE).lower())
    return np.where(name, np.uint64(_NAME_FORM), (f & ~7).astype(np.uint64)), name | ((f & 4) > 0), plain, (f & 1) > 0


def windows(tokens: np.ndarray, slots: np.ndarray, size: int, first: np.ndarray | None = None, at: np.ndarray | None = None):
    """Hashes of all windows of ``size`` tokens; whether each has enough plain tokens.

    ``first``: those at ``at`` once more, their first token replaced by this one, a slot where it was none and the reverse;
    then both results are given.
    """
    n = len(tokens) - size + 1
    enough = min(LITERALS, size - 1)
    mixed = mix64(tokens)
    where = np.arange(max(0, n))
    h = _words.hashes(_words.sums(mixed), where, where + size)
    count = np.concatenate([[0], np.cumsum(~slots)])
    count = count[size:] - count[:-size]
    out = mix64(h ^ np.uint64(size)), count[: len(h)] >= enough
    if first is None:
        return out
    with np.errstate(over="ignore"):
        other = mix64(h[at] + (mix64(first[at]) - mixed[at]) ^ np.uint64(size))
    return out, (other, count[at] + np.where(slots[at], 1, -1) >= enough)


def exact_windows(plain: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all windows of ``size`` words as they are; whether any has a letter or digit in it."""
    n = max(0, len(plain) - size + 1)
    at = np.arange(n)
    h = mix64(_words.hashes(_words.sums(mix64(plain)), at, at + size) ^ _EXACT ^ np.uint64(size))
    count = np.concatenate([[0], np.cumsum(plain != _NONE)])
    return h, count[at + size] > count[at]


_HIT = "array<struct<h:long,at:int,form:string,slots:array<string>>>"


def window_table(hashes: DataFrame, count: int) -> np.ndarray:
    """A bit table of ``hashes(h)``, two bits each, of 64 times as many bits within FILTER_BITS; built by tasks, only its words are collected.

    What passes it is joined exactly, so a table too small for its benchmark lets more through and loses nothing.
    """
    low, high = FILTER_BITS
    words = 1 << min(max((64 * count).bit_length(), low), high) - 6
    spots = F.array(*[F.struct(F.shiftrightunsigned("h", 6 + 26 * i).bitwiseAND(F.lit(words - 1)).alias("word"), F.shiftrightunsigned("h", 58 * i).bitwiseAND(F.lit(63)).cast("int").alias("bit")) for i in range(2)])
    cells = hashes.select(F.inline(spots)).groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    table = np.zeros(words, np.uint64)
    table[np.asarray(cells.column("word").combine_chunks())] = np.asarray(cells.column("bits").combine_chunks()).view(np.uint64)
    return table


def _may_be(table: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Whether both bits of each hash are set."""
    mask, one = np.uint64(len(table) - 1), np.uint64(1)
    out = (table[(h >> np.uint64(6) & mask).astype(np.int64)] >> (h & np.uint64(63)) & one).astype(bool)
    at = np.flatnonzero(out)
    out[at] = table[(h[at] >> np.uint64(32) & mask).astype(np.int64)] >> (h[at] >> np.uint64(58)) & one
    return out


def _keys(words: list[bytes], slots: np.ndarray) -> dict:
    """Digests of an item's plain words and of its template, where each slot is known by the first one that it equals."""
    plain = [w.strip(_EDGE).lower() for w in words]
    seen: dict[bytes, int] = {}
    shape = [b"\0%d" % seen.setdefault(w, len(seen)) if s else w for w, s in zip(plain, slots.tolist())] if len(words) >= SHORTEST else plain
    return {k: hashlib.blake2b(b" ".join(v), digest_size=16).hexdigest() for k, v in (("words", plain), ("template", shape))}


def _finder(sizes: list[int], whole: bool, table: np.ndarray | None):
    """Over (id, text): the windows, all of them or those that ``table`` may hold. ``whole``: short texts count as one window.

    The form of a window of the words themselves begins with \\1.
    """

    def ways(size, tokens, slots, plain, names):
        """(places, hashes of the windows there, which count, slots or None, whether the first token is the other kind)."""
        n = max(0, len(plain) - size + 1)
        yield np.arange(n), *exact_windows(plain, size), None, False
        if size >= SHORTEST and whole:
            yield np.arange(n), *windows(tokens, slots, size), slots, False
        elif size >= SHORTEST:  # a capital at the start of a window, as a name and as none
            at = np.flatnonzero(names[:n])
            as_is, other = windows(tokens, slots, size, np.where(slots, plain, np.uint64(_NAME_FORM)), at)
            yield np.arange(n), *as_is, slots, False
            yield at, *other, slots, True

    def hit(h, words, i, at, size, slot_of, other, slots):
        cut = [w.strip(_EDGE).lower().decode("utf-8", "surrogatepass").lower().encode("utf-8", "replace").decode() for w in words[i : i + size]]
        if slot_of is None:
            return {"h": h, "at": at, "form": "\1" + " ".join(cut), "slots": [""] * bool(whole and slots[i : i + size].any())}
        slot = slot_of[i : i + size].tolist()
        slot[0] ^= other
        return {"h": h, "at": at, "form": " ".join("\0" if s else w for w, s in zip(cut, slot)), "slots": [w if s else None for w, s in zip(cut, slot)]}

    def run(batches):
        forms = _Forms()
        if table is not None:  # the first bit of each hash as a byte, folded to what a cache holds: one look for most windows
            first_bits = np.unpackbits(table.view(np.uint8), bitorder="little").view(bool)
            first = first_bits.reshape(-1, min(len(first_bits), 1 << 22)).any(0)
            mask = np.uint64(len(first) - 1)
        for b in batches:
            texts = [(t or "").encode("utf-8", "surrogatepass").split() for t in b.column(1).to_pylist()]
            n, hits, keys = list(map(len, texts)), [[] for _ in texts], [None] * len(texts)
            if whole:
                for words, rows, k in zip(texts, hits, range(len(texts))):
                    parts = template(words, forms)
                    keys[k] = _keys(words, parts[1])
                    for size in [min(WINDOW, len(words))] * (len(words) > 0):
                        for _, h, ok, slot_of, other in ways(size, *parts):
                            rows += [hit(int(h[i].view(np.int64)), words, i, i, size, slot_of, other, parts[1]) for i in np.flatnonzero(ok).tolist()]
            else:  # all texts of the batch in one line; windows end with their text
                words, bounds = list(itertools.chain.from_iterable(texts)), np.concatenate([[0], np.cumsum(n)])
                parts = template(words, forms, bounds[:-1][np.diff(bounds) > 0])
                left = np.repeat(bounds[1:], n) - np.arange(len(words))
                for size in sizes:
                    for places, h, ok, slot_of, other in ways(size, *parts):
                        if table is not None:
                            ok = ok & first[(h & mask).astype(np.int64)]
                        at = np.flatnonzero(ok)
                        at = at[left[places[at]] >= size]
                        if table is not None and len(at):
                            at = at[_may_be(table, h[at])]
                        at, h = places[at], h[at].view(np.int64)
                        of = np.searchsorted(bounds, at, "right") - 1
                        for i, key, d, local in zip(at.tolist(), h.tolist(), of.tolist(), (at - bounds[of]).tolist()):
                            hits[d].append(hit(key, words, i, local, size, slot_of, other, parts[1]))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int32()), pa.array(hits, pa.list_(pa.struct([("h", pa.int64()), ("at", pa.int32()), ("form", pa.string()), ("slots", pa.list_(pa.string()))]))), pa.array(keys, pa.struct([("words", pa.string()), ("template", pa.string())]))], ["id", "n", "hits", "keys"])

    return run


_FOUND = f"n int, hits {_HIT}, keys struct<words:string,template:string>"


def _items(benchmark: DataFrame) -> DataFrame:
    items = benchmark.select(F.col("item_id").alias("id"), "text").mapInArrow(_finder([], True, None), f"id long, {_FOUND}")
    return materialise(items.where("size(hits) > 0"), "templates")


def classes(benchmark: DataFrame) -> DataFrame:
    """(item_id, text_id, class_id): of each benchmark item the least ids of those of equal words and of those of its template class."""
    items = _items(benchmark).select("id", "keys.*")
    least = lambda k, name: items.groupBy(k).agg(F.min("id").alias(name))
    return salted_join(salted_join(items, least("words", "text_id"), ["words"]), least("template", "class_id"), ["template"]).select(F.col("id").alias("item_id"), "text_id", "class_id")


def _units(items: DataFrame) -> DataFrame:
    """(unit, item, kind, n, need, windows): what documents are compared with; ``n`` windows make it whole, ``need`` of them find it.

    Kinds: template, literal (a class's words without slots), words.
    """
    exact = F.filter("hits", lambda x: x["form"].startswith("\1"))
    free = F.filter(exact, lambda x: F.size(x["slots"]) == 0)
    texts = items.groupBy("keys.words").agg(F.min_by(F.struct("id", "hits", "keys.template"), "id").alias("t")).select("t.*")
    texts = texts.withColumns({"exact": exact, "free": free, "typed": F.filter("hits", lambda x: ~x["form"].startswith("\1"))})
    texts = texts.withColumn("broad", F.size("free") >= F.ceil(EXACT_COVER * F.size("exact")))
    shape = texts.groupBy("template").agg(F.min_by(F.struct("id", "typed", "free", "exact", "broad"), "id").alias("c"), F.count("*").alias("members"))
    of = lambda kind, item, n, need, windows: F.struct(F.lit(kind).alias("kind"), item.alias("item"), n.cast("int").alias("n"), need.cast("int").alias("need"), windows.alias("windows"))
    c = lambda k: F.col(f"c.{k}")
    enough = lambda k, share: F.ceil(F.lit(share) * F.size(k) - 1e-9)
    of_shape = F.array(of("template", c("id"), F.size("c.typed"), enough("c.typed", COVER), c("typed")), of("literal", c("id"), F.size("c.exact"), enough("c.exact", EXACT_COVER), F.when(c("broad") & (F.col("members") > 1), c("free")).otherwise(F.slice(c("free"), 1, 0))))
    several = shape.select("template", F.col("members") > 1)
    by_words = texts.join(several.toDF("template", "many"), "template").select(of("words", F.col("id"), F.size("exact"), F.when(F.col("broad") & F.col("many"), F.size("exact")).otherwise(enough("exact", EXACT_COVER)), F.col("exact")).alias("u"))
    units = shape.select(F.explode(of_shape).alias("u")).union(by_words).select("u.*").where("size(windows) > 0")
    return materialise(units.withColumn("unit", F.concat_ws(":", "kind", "item")), "units")


def _index(units: DataFrame) -> DataFrame:
    """(h, form, unit): the rarest windows of each unit: one more than it can lack and still be found."""
    every = units.select("unit", "need", F.size("windows").alias("size"), F.explode("windows").alias("w")).select("unit", "need", "size", "w.h", "w.form", "w.at")
    shared = every.groupBy("h", "form").agg(F.count("*").alias("units"))
    rank = F.row_number().over(Window.partitionBy("unit").orderBy("units", "at"))  # an item's windows
    kept = salted_join(every, shared, ["h", "form"]).withColumn("rank", rank).where("rank <= size - need + 1")
    return kept.select("h", "form", "unit").distinct()


def _compare(batches):
    """Candidates whose windows cover the unit: (nr, item, cover, same)."""
    for b in batches:
        out = []
        for nr, hits, item, kind, n, need, windows in zip(*(b.column(i).to_pylist() for i in range(7))):
            here: dict[str, list] = {}
            for w in windows:
                here.setdefault(w["form"], []).append(w)
            if kind != "template":
                forms = {x["form"] for x in hits}
                got = sum(len(ws) for form, ws in here.items() if form in forms)
                same = kind == "words" and got == n
            else:
                lines: dict[int, tuple[set, dict, list]] = {}
                for x in hits:
                    for w in here.get(x["form"], ()):
                        at, values, state = lines.setdefault(x["at"] - w["at"], (set(), {}, [True, True]))  # consistent, equal
                        at.add(w["at"])
                        for i, d in zip(w["slots"], x["slots"]):
                            if i is not None:
                                state[0] &= values.setdefault(i, d) == d
                                state[1] &= i == d
                good = [(at, state[1]) for at, _, state in lines.values() if state[0]]
                got, same = len(set().union(*(at for at, _ in good))), all(e for _, e in good)
            if got >= need:
                out.append((nr, item, min(got / n, 1.0), same))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(list(zip(*out)) or [()] * 4, (pa.int64(), pa.int64(), pa.float64(), pa.bool_()))], ["nr", "item", "cover", "same"])


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", keyed: bool = False) -> DataFrame:
    """(doc_id, contaminated, verbatim, n_items, items, cover): one row per row of ``docs``.

    items: in order, the least ids of the template classes found and of the texts (items of equal words) found word for word or
    nearly; ``classes`` has the ids of all members. cover: the largest share of a unit's windows. Null and
    empty texts contain nothing and items with null texts or without a letter or digit are never found, those of fewer
    than ``SHORTEST`` words only as they are; rows
    of one id are judged apart; very long texts are judged whole; extra columns are ignored; either table may be empty.
    ``keyed``: (doc_id, k0, k1) of the contaminated rows only; k0 and k1 are ``text_keys``.
    """
    small_batches(docs)
    items = _items(benchmark)
    units = _units(items)
    hashes = units.select(F.explode("windows.h").alias("h")).distinct()
    sizes = [r.n for r in items.select(F.least("n", F.lit(WINDOW)).alias("n")).distinct().collect()]  # WINDOW values at most
    table = window_table(hashes, hashes.count())
    key = F.struct(F.monotonically_increasing_id().alias("nr"), F.col(id_col).cast("long").alias("doc_id"), *text_keys(F.col(text_col)) * keyed)
    kind = "struct<nr:long,doc_id:long" + ",k0:long,k1:long" * keyed + ">"
    found = docs.select(key.alias("id"), F.col(text_col).alias("text")).mapInArrow(_finder(sizes, False, table), f"id {kind}, {_FOUND}")
    if keyed:
        found = found.where("size(hits) > 0")
    found = materialise(found.select("id.*", "hits"), "templates-found")
    hits = found.where("size(hits) > 0").select("nr", F.explode("hits").alias("x")).select("nr", "x.h", "x.form").distinct()
    index = materialise(_index(units), "unit-index")
    candidates = materialise(salted_join(hits, index, ["h", "form"]).select("nr", "unit").distinct(), "candidates")
    # a document has few candidates, a unit may be in very many documents
    pairs = candidates.join(found.select("nr", "hits").where("size(hits) > 0"), "nr")
    pairs = salted_join(pairs, units, ["unit"]).select("nr", "hits", "item", "kind", "n", "need", "windows")
    per = pairs.mapInArrow(_compare, "nr long, item long, cover double, same boolean")
    per = per.groupBy("nr").agg(F.array_sort(F.collect_set("item")).alias("items"), F.max("cover").alias("cover"), F.bool_or("same").alias("verbatim"))
    if keyed:
        return found.drop("hits").join(per, "nr", "left_semi").select("doc_id", "k0", "k1").distinct()
    out = found.drop("hits").join(per, "nr", "left")
    return out.select("doc_id", F.col("items").isNotNull().alias("contaminated"), F.coalesce("verbatim", F.lit(False)).alias("verbatim"), F.coalesce(F.size("items"), F.lit(0)).alias("n_items"), F.coalesce("items", F.array().cast("array<long>")).alias("items"), F.coalesce("cover", F.lit(0.0)).alias("cover"))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the rows that contain a benchmark item.

    Rows of null ids are judged like others and repeated rows go or stay together; extra columns stay, whatever their names.
    Only the keys of rows that go are written; up to DROP_BROADCAST of them, counted, are sent to all tasks.
    """
    return rows_of(docs, materialise(contamination(docs, benchmark, keyed=True), "contaminated"), "left_anti", DROP_BROADCAST)
