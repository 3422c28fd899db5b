"""The registered queries of this subpackage: thin forms of its operators over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, mixing, ordermin, quality_model, resample, rules, secrets, simhash, substrings, tokens, urlfilter, warc, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and their components; one row per document. Nulls, empty, very long and repeated rows as the operator says."""
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document. Nulls, empty, very long and repeated rows as the operator says."""
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that each document contains. Nulls, empty, very long and repeated rows as the operator says."""
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op4_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document keeps without passages that a smaller doc_id has. Nulls, empty, very long and repeated rows as the operator says."""
    return substrings.cut_repeats(_table(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated scores of all documents, learnt from those not held out. Nulls, empty, very long and repeated rows as the operator says."""
    return quality_model.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the pages as read back from normalised archives. Nulls, empty, very long and repeated rows as the operator says."""
    return warc.read(warc.normalise(warc.write(_table(spark, sf_dir, "pages"))))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of each document, by patterns and by the network. Nulls, empty, very long and repeated rows as the operator says."""
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as read back from token files. Nulls, empty, very long and repeated rows as the operator says."""
    return tokens.read(tokens.write(_table(spark, sf_dir, "documents")))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all URLs, by rules and by the list. Nulls, empty, very long and repeated rows as the operator says."""
    pages = _table(spark, sf_dir, "pages")
    listed = urlfilter.bad_content(pages, _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))
    return urlfilter.judge(pages, listed, urlfilter.LISTED_WORDS)


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of the quality rules for each document. Nulls, empty, very long and repeated rows as the operator says."""
    return rules.assess(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of documents, of their edited texts, and how alike they are. A null text is empty; rows of one id follow each other; no rows give none."""
    return ordermin.compare_edited(_table(spark, sf_dir, "documents"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights towards the benchmark, scores and the ranks of what is drawn. A null text has no words and is never drawn; no rows give none."""
    drawn = resample.draw(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened embeddings, a row per vector and component. Vectors that are null or have null or non-finite entries go; no rows give none."""
    return whitening.whiten(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_simhash, op2_mixing, op3_decontamination, op4_substrings, op5_quality_classifier, op6_warc, op7_secret_scan, op8_token_files, op9_url_filter, op10_quality_rules, op11_order_minhash, op12_resampling, op13_whitening)}


def _rules_sql() -> str:
    """op10 in DuckDB: the same counts, levels by the binomial tail in logarithms, and verdicts."""
    enough, alpha, risk = rules.fewest(), rules.DELTA / (len(rules.BANDS) + 1), rules.RISK
    metrics = {
        "symbols_per_word": ("n_symbols", "n_words"),
        "dup_line_share": ("n_dup_lines", "n_lines"),
        "repeat_share": ("n_repeat_words", "n_words"),
        "chars_per_word": ("word_chars", "n_words"),
        "capital_share": ("n_capitals", "word_chars"),
    }
    share = {m: f"(case when {b} > 0 then {a}::double / {b} else 0 end)" for m, (a, b) in metrics.items()}
    passed = ", ".join("(" + " + ".join(f"({share[m]} <= {c}::double)::int" for c in cuts) + ")" for m, cuts in rules.LADDER.items())
    return rf"""
with texts as (select row_number() over () as nr, doc_id, coalesce(text, '') as t from documents),
 split as (select nr, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') as ws from texts),
 grams as (select nr, unnest(range(1, len(ws) - 1)) as i, ws from split where len(ws) >= 3),
 keyed as (select nr, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as g from grams),
 twice as (select nr, i from keyed qualify count(*) over (partition by nr, g) > 1),
 covered as (select nr, count(distinct i + d) as n from twice, (values (0), (1), (2)) k(d) group by nr),
 lines as (select nr, unnest(string_split(t, chr(10))) as line from texts),
 dups as (select nr, count(*) as n_lines, count(*) - count(distinct line) as n from lines where regexp_matches(line, '[^\x20\x09-\x0D]') group by nr),
 counts as (select s.nr, doc_id, len(ws)::bigint as n_words, length(array_to_string(ws, ''))::bigint as word_chars, len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols,
  coalesce(dups.n, 0)::bigint as n_dup_lines, coalesce(n_lines, 0)::bigint as n_lines, coalesce(covered.n, 0)::bigint as n_repeat_words, len(regexp_extract_all(t, '\p{{Lu}}'))::bigint as n_capitals
  from split s left join dups on dups.nr = s.nr left join covered on covered.nr = s.nr),
 judged as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed, {" + ".join(f"(n_words >= {b})::int" for b in rules.BANDS)} as band, least({passed}) as reach from counts),
 good as (select band, reach from judged j join labels l on l.doc_id = j.doc_id where l.quality = 1 and not base_failed),
 sizes as (select count(*) filter (band = 0) as a, count(*) filter (band = 1) as b, count(*) filter (band = 2) as c from good),
 strata as (select band, case when a >= {enough} then case when band = 0 then 0 when b >= {enough} then case when band = 2 and c >= {enough} then 2 else 1 end when b + c >= {enough} then 1 else 0 end
  when a + b >= {enough} and band = 2 and c >= {enough} then 1 else 0 end as stratum from sizes, range(3) r(band)),
 tests as (select stratum, level, count(*) as n, count(*) filter (reach <= level) as k from good join strata on strata.band = good.band, range({rules.LEVELS}) l(level) group by stratum, level),
 passed as (select *, k < n * {risk} and list_sum(list_transform(range(0, k + 1), lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({risk}) + (n - i) * ln(1 - {risk})))) <= {alpha} as ok from tests),
 levels as (select band, coalesce((select coalesce(min(level) filter (not ok), {rules.LEVELS}) from passed where passed.stratum = strata.stratum), 0) - 1 as level from strata)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and reach > level as kept from judged join levels on levels.band = judged.band"""


def oracle_sql() -> dict[str, str]:
    """op10 only; fingerprints, alignments, flows, codecs and models are tested against brute force."""
    return {"op10_quality_rules": _rules_sql()}
