"""Mixing overlapping sources to target weights by min-cost flow.

Documents are aggregated by membership pattern (the set of sources they belong to). A flow network routes
words from patterns to source quotas: a pattern offers its words once at cost 0, and again at cost 1 for
the second pass, 2 for the third, so repetition is convex and used last. The network has a node per pattern
and source, never per document; its size is checked. The flow says how many words to take from each
pattern: whole passes over it, and one partial pass. The partial pass takes documents in seeded order up to
the number of words, found from a histogram of the order and exact running sums in the one bin that the
number falls in, and then, up to FILLS times, the one further document that comes closest to what is missing.
"""

from __future__ import annotations

from collections import defaultdict, deque

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, n_words

WEIGHTS, BUDGET, PASSES, SEED = (5, 2, 1), 1.5, 2, 20240607
BIN_BITS, FILLS = 12, 4


def targets(sizes: dict, weights: tuple = WEIGHTS, budget: float = BUDGET, passes: float = PASSES) -> dict:
    """Words wanted of each source: shares of ``budget`` times all sizes by weight, capped at ``passes`` times
    the source's size, what is above reshared by weight until none is above.

    Sources go by code point, null last, and take the weights in turn.
    """
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-8", "surrogatepass")))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, open_ = {}, set(names)
    left = budget * sum(sizes.values())
    while open_:
        total = sum(weight[s] for s in open_)
        share = {s: left * weight[s] / total for s in open_}
        above = [s for s in names if s in open_ and share[s] > passes * sizes[s]]
        if not above:
            return out | {s: float(share[s]) for s in open_}
        for s in above:
            out[s] = float(passes * sizes[s])
            left -= out[s]
            open_.remove(s)
    return out


def route(patterns: dict[tuple, int], quotas: dict, passes: int = PASSES) -> dict[tuple, int]:
    """Words to take of each pattern: a min-cost maximum flow by shortest augmenting paths.

    ``patterns``: set of sources to words; ``quotas``: source to words. Patterns that share no source, directly
    or over others, are separate networks.
    """
    of = defaultdict(list)
    for p in patterns:
        for s in p:
            of[s].append(p)
    flow: dict[tuple, int] = dict.fromkeys(patterns, 0)
    to: dict[tuple, int] = defaultdict(int)  # (pattern, source) -> words
    got: dict = defaultdict(int)
    seen: set = set()
    for first in patterns:
        if first in seen:
            continue
        part, todo = [], [first]
        seen.add(first)
        while todo:
            p = todo.pop()
            part.append(p)
            for s in p:
                for q in of[s]:
                    if q not in seen:
                        seen.add(q)
                        todo.append(q)
        for turn in range(passes):  # convex: all words of one pass before any of the next
            _augment(part, of, patterns, quotas, turn, flow, to, got)
    return flow


def _augment(part, of, patterns, quotas, turn, flow, to, got) -> None:
    """Push what pass ``turn`` can still add; a path leaves a pattern, may take back words that another routed, and ends at a source with room."""
    while True:
        back: dict = {}
        todo = deque()
        for p in part:
            if flow[p] < (turn + 1) * patterns[p]:
                back[p] = None
                todo.append(p)
        end = None
        while todo and end is None:
            p = todo.popleft()
            for s in p:
                if ("s", s) in back:
                    continue
                back["s", s] = p
                if got[s] < quotas[s]:
                    end = s
                    break
                for q in of[s]:
                    if q not in back and to[q, s] > 0:
                        back[q] = ("s", s)
                        todo.append(q)
        if end is None:
            return
        path, at = [], ("s", end)
        while at is not None:
            path.append(at)
            at = back[at]
        start, room = path[-1], quotas[end] - got[end]
        room = min(room, (turn + 1) * patterns[start] - flow[start], *[to[path[i], path[i + 1][1]] for i in range(1, len(path) - 1, 2)])
        for i in range(0, len(path) - 1, 2):
            to[path[i + 1], path[i][1]] += room
            if i + 2 < len(path):
                to[path[i + 1], path[i + 2][1]] -= room
        flow[start] += room
        got[end] += room


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple = WEIGHTS, budget: float = BUDGET, passes: int = PASSES, seed: int = SEED, carry: bool = False, max_patterns: int = 100_000) -> DataFrame:
    """(doc_id, size, source_size, target, taken): one row per row of ``docs``.

    ``source_col`` holds a source or an array of sources; size is the number of words (null text: 0); source_size
    and target are those of the source (of the first by code point, if there are several); taken is size times
    the number of passes that the mix makes over the document. A null source is a source of its own, last in
    order; repeated rows are rows; documents of no words are never taken. The order of the draw depends on
    ``seed``, id and text alone. More than ``max_patterns`` patterns are an error, as they are brought to the driver.
    ``carry``: also the whole row, as the struct _row.
    """
    spark = docs.sparkSession
    is_array = dict(docs.dtypes)[source_col].startswith("array")
    sources = F.array_sort(F.array_distinct(F.col(source_col))) if is_array else F.array(F.col(source_col))
    sources = F.when(F.size(sources) > 0, sources).otherwise(F.array(F.lit(None).cast("string"))).cast("array<string>")
    row = F.struct(*docs.columns).alias("_row")
    rows = docs.select(*[row] * carry, F.col(id_col).alias("doc_id"), sources.alias("pattern"), n_words(F.col(text_col)).alias("size"), F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)).alias("draw"))
    rows = materialise(rows.withColumn("nr", F.monotonically_increasing_id()), "mixing")
    bin_ = F.shiftrightunsigned("draw", 64 - BIN_BITS)
    bins = materialise(rows.groupBy("pattern", bin_.alias("bin")).agg(F.sum("size").alias("words")), "mixing-bins")
    found = bins.groupBy("pattern").agg(F.sum("words").alias("words")).limit(max_patterns + 1).collect()
    if len(found) > max_patterns:
        raise ValueError(f"more than {max_patterns} membership patterns")
    patterns = {tuple(r.pattern): r.words for r in found}
    sizes: dict = defaultdict(int)
    for p, n in patterns.items():
        for s in p:
            sizes[s] += n
    want = targets(sizes, weights, budget, passes)
    flow = route(patterns, {s: round(t) for s, t in want.items()}, passes)
    plan = []
    for p, n in patterns.items():
        whole = min(passes, flow[p] // n) if n else 0
        plan.append((list(p), sizes[p[0]], want[p[0]], whole, flow[p] - whole * n))
    plan = F.broadcast(spark.createDataFrame(plan, "pattern array<string>, source_size long, target double, whole int, need long"))  # at most max_patterns rows
    by_bin = Window.partitionBy("pattern").orderBy("bin")
    cut = bins.join(plan, "pattern").withColumn("upto", F.sum("words").over(by_bin)).where("upto - words <= need and need < upto")
    cut = F.broadcast(cut.select("pattern", F.col("bin").alias("cut"), (F.col("need") - F.col("upto") + F.col("words")).alias("rest")))  # one row a pattern
    at = rows.drop("_row").join(plan, "pattern").join(cut, "pattern", "left").withColumn("bin", bin_).where("bin >= cut")
    order = Window.partitionBy("pattern").orderBy("draw", "doc_id", "nr")
    edge = materialise(at.where("bin = cut").withColumn("upto", F.sum("size").over(order)).select("pattern", "nr", "rest", "upto"), "mixing-edge")
    took = edge.where("upto <= rest").select("nr")
    fits = F.max(F.when(F.col("upto") <= F.col("rest"), F.col("upto")))
    missing = {tuple(r.pattern): r.missing for r in edge.groupBy("pattern").agg((F.max("rest") - F.coalesce(fits, F.lit(0))).alias("missing")).collect()}  # a row per pattern
    picked: list[tuple[int]] = []
    for _ in range(FILLS):
        left = [(list(p), n) for p, n in missing.items() if n > 0]
        if not left:
            break
        state = F.broadcast(spark.createDataFrame(left, "pattern array<string>, missing long"))
        off = F.abs(F.col("size") - F.col("missing"))
        open_ = at.join(state, "pattern").where(off < F.col("missing")).join(took, "nr", "left_anti").join(F.broadcast(spark.createDataFrame(picked, "nr long")), "nr", "left_anti")
        found = open_.groupBy("pattern").agg(F.min(F.struct(off.alias("off"), "draw", "doc_id", "nr", "size")).alias("d")).collect()
        picked += [(r.d.nr,) for r in found]
        missing = {tuple(r.pattern): missing[tuple(r.pattern)] - r.d.size for r in found}
    more = materialise(took.union(spark.createDataFrame(picked, "nr long")), "mixing-more").withColumn("_more", F.lit(1))
    out = rows.join(plan, "pattern").join(cut, "pattern", "left").join(more, "nr", "left")
    times = F.col("whole") + F.when(F.col("cut").isNull(), 0).when(bin_ < F.col("cut"), 1).otherwise(F.coalesce("_more", F.lit(0)))
    return out.select(*["_row"] * carry, "doc_id", "size", "source_size", "target", (F.col("size") * times).cast("long").alias("taken"))


def take_mix(docs: DataFrame, **options) -> DataFrame:
    """``docs`` as the mix takes them: a row as often as it is taken."""
    mixed = mix(docs, carry=True, **options).where("taken > 0")
    return mixed.select(F.explode(F.array_repeat("_row", (F.col("taken") / F.col("size")).cast("int"))).alias("_row")).select("_row.*")
