"""Quality rules with risk-controlled thresholds, in DataFrame functions only.

Base rules are fixed. On top, documents are held to a ladder of levels, each with a cutoff for every metric, from lenient
to strict. The level of a stratum is chosen on labelled holdouts so that the share of good documents it rejects is
at most ``risk`` in every stratum, all of this together at probability 1 - ``delta``. A level passes if the exact binomial
tail P(Bin(n, risk) <= k) is at most delta / length bands, where n good documents were seen and k of them are rejected;
levels are tried from the most lenient one on, and trying stops at the first that fails. Fixed-sequence testing needs
no correction within a stratum; Bonferroni corrects over the strata. All labelled documents serve as holdout: nothing else is
learnt from them.

Strata are the length bands; bands with too few good documents for any level to pass are joined with the next ones, by their
numbers alone, never by what the rules say of them. With too few labels altogether the base rules rule.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

RISK, DELTA = 0.02, 0.05
#: Upper ends of the length bands, in words; the last band is open.
BANDS = (150, 600)
#: Metric to its cutoffs by level, from lenient to strict.
LADDER = {
    "symbols_per_word": (4.0, 2.0, 1.0, 0.7, 0.5, 0.35, 0.25, 0.15, 0.1),
    "dup_line_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2),
    "repeat_share": (0.48, 0.45, 0.42, 0.4, 0.35, 0.3, 0.25, 0.22, 0.2),
    "chars_per_word": (40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 13.0, 12.0),
    "capital_share": (0.9, 0.8, 0.7, 0.6, 0.5, 0.45, 0.4, 0.35, 0.3),
}
LEVELS = 9


def fewest(risk: float = RISK, delta: float = DELTA) -> int:
    """Good documents without a rejection that it takes for a level to pass."""
    return math.ceil(math.log(delta / (len(BANDS) + 1)) / math.log(1 - risk))


def _per(a: Column, b: Column) -> Column:
    return F.when(b > 0, a / b).otherwise(F.lit(0.0)).cast("double")


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", carry: bool = False) -> DataFrame:
    """Counts per row of ``docs``; null texts have no words, empty lines are no lines.

    ``carry``: keep the whole row as the struct _row.
    """
    text, row = F.coalesce(F.col(text_col), F.lit("")), ["_row"] if carry else []
    d = docs.select(*[F.struct(*docs.columns).alias(r) for r in row], F.col(id_col).alias("doc_id"), text.alias("_text"), F.filter(F.split(text, r"\s+"), lambda w: w != "").alias("_words"))
    d = d.withColumn("_lines", F.filter(F.split("_text", "\n"), lambda x: x.rlike(r"\S")))
    d = d.withColumn("n_words", F.size("_words").cast("long"))
    gram = lambda i: F.struct(F.xxhash64(F.get("_words", i), F.get("_words", i + 1), F.get("_words", i + 2)).alias("h"), i.alias("i"))
    d = d.select(
        *row,
        "doc_id",
        "n_words",
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count("_text", F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.size("_lines").cast("long").alias("n_lines"),
        F.regexp_count("_text", F.lit(r"\p{Lu}")).cast("long").alias("n_capitals"),
        F.when(F.col("n_words") >= 3, F.sort_array(F.transform(F.sequence(F.lit(0), F.greatest(F.size("_words") - 3, F.lit(0))), gram))).alias("_grams"),
    )
    h = lambda k: F.get("_grams", k)["h"]
    twice = lambda x, k: ((k > 0) & (h(F.greatest(k - 1, F.lit(0))) == x["h"])) | F.coalesce(h(k + 1) == x["h"], F.lit(False))
    d = d.withColumn("_at", F.array_sort(F.transform(F.filter("_grams", twice), lambda x: x["i"])))
    new = lambda s, i: F.struct(i.alias("last"), (s["n"] + F.least(F.lit(3), i - s["last"])).alias("n"))
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n"))
    d = d.withColumn("n_repeat_words", F.coalesce(F.aggregate("_at", start, new, lambda s: s["n"]), F.lit(0)).cast("long"))
    return d.drop("_grams", "_at")


def judge_base(counts: DataFrame) -> DataFrame:
    """Adds base_failed, the length band and reach: how many levels the document passes."""
    n = F.col("n_words")
    metrics = {
        "symbols_per_word": _per(F.col("n_symbols"), n),
        "dup_line_share": _per(F.col("n_dup_lines"), F.col("n_lines")),
        "repeat_share": _per(F.col("n_repeat_words"), n),
        "chars_per_word": _per(F.col("word_chars"), n),
        "capital_share": _per(F.col("n_capitals"), F.col("word_chars")),
    }
    band = sum(((n >= b).cast("int") for b in BANDS), F.lit(0))
    passed = [sum(((v <= c).cast("int") for c in LADDER[m]), F.lit(0)) for m, v in metrics.items()]
    return counts.withColumns({"base_failed": (n < 50) | (100 * F.col("n_repeat_words") > 50 * n), "reach": F.least(*passed), "band": band})


def thresholds(judged: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA) -> DataFrame:
    """(band, stratum, n, level): a row per length band, the strictest level certified for its stratum; -1 where none is.

    ``judged(doc_id, band, reach, base_failed)``; ``labels(doc_id, quality)``: rows with quality 1 are the good documents; null
    qualities and ids count for nothing. Documents that fail the base rules are no evidence about the levels.
    """
    bands, enough, alpha = range(len(BANDS) + 1), fewest(risk, delta), delta / (len(BANDS) + 1)
    good = judged.where("not base_failed").join(labels.where("quality = 1").select("doc_id"), "doc_id")
    seen = good.agg(F.array(*[F.count_if(F.col("band") == b) for b in bands]).alias("n"), F.array(*[F.array(*[F.count_if((F.col("band") == b) & (F.col("reach") <= i)) for i in range(LEVELS)]) for b in bands]).alias("k"))

    def step(s: Column, n: Column) -> Column:
        total = s["held"] + n
        full = total >= enough
        return F.struct(F.when(full, F.lit(0).cast("long")).otherwise(total).alias("held"), (s["next"] + full.cast("int")).alias("next"), F.concat(s["of"], F.array(s["next"])).alias("of"))

    start = F.struct(F.lit(0).cast("long").alias("held"), F.lit(0).alias("next"), F.array().cast("array<int>").alias("of"))
    # what is left over at the end joins the stratum before it
    seen = seen.withColumn("_s", F.aggregate("n", start, step)).withColumn("of", F.transform("_s.of", lambda g: F.greatest(F.least(g, F.col("_s.next") - 1), F.lit(0))))
    rows = seen.select("n", "k", "of", F.posexplode("of").alias("band", "stratum"))
    mine = lambda values: F.aggregate(F.zip_with(values, "of", lambda v, g: F.when(g == F.col("stratum"), v).otherwise(F.lit(0).cast("long"))), F.lit(0).cast("long"), lambda s, v: s + v)
    rows = rows.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(LEVELS - 1))))
    rows = rows.select("band", "stratum", "level", mine(F.col("n")).alias("n"), mine(F.transform("k", lambda k: F.get(k, F.col("level")))).alias("k"))
    n, k = F.col("n").cast("double"), F.col("k")
    first = F.struct((n * F.log(F.lit(1 - risk))).alias("log"), F.exp(n * F.log(F.lit(1 - risk))).alias("sum"))
    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<long>"))
    tail = F.aggregate(terms, first, lambda s, i: _next(s, i, n, risk), lambda s: s["sum"])
    passed = F.when(k < n * risk, tail <= alpha).otherwise(F.lit(False))
    stop = F.coalesce(F.min(F.when(~passed, F.col("level"))), F.lit(LEVELS))
    return rows.groupBy("band", "stratum", "n").agg((stop - 1).alias("level"))


def _next(s: Column, i: Column, n: Column, rate: float) -> Column:
    log = s["log"] + F.log(n - i + 1) - F.log(i.cast("double")) + F.log(F.lit(rate / (1 - rate)))
    return F.struct(log.alias("log"), (s["sum"] + F.exp(log)).alias("sum"))


def assess(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", risk: float = RISK, delta: float = DELTA, carry: bool = False) -> DataFrame:
    """One row per row of ``docs``: doc_id, the counts, base_failed, kept.

    Null and empty texts have no words, so they fail the base rules; very long texts are judged whole; repeated rows are
    judged each; extra columns are ignored; without labels or documents nothing is certified.
    """
    judged = materialise(judge_base(measure(docs, id_col, text_col, carry)), "quality")
    levels = F.broadcast(thresholds(judged, labels, risk, delta).select("band", "level"))  # a row per length band
    kept = ~F.col("base_failed") & (F.col("reach") > F.col("level"))
    return judged.join(levels, "band").select(*["_row"] * carry, "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that the rules reject, null and empty texts among them; repeated rows stay or go together; extra columns stay, whatever their names."""
    return assess(docs, labels, carry=True).where("kept").select("_row.*")
