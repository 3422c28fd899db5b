"""URL verdicts: host and path rules first, then a list of canonical URLs behind a blocked Bloom filter.

The filter is a table: a row per 256-bit block, four 64-bit words, in which each listed URL sets one bit per
word. It is built by grouped bit_or and probed by a join on the block number; only URLs whose four bits are
all set go on to the exact join with the list, which removes the false positives. The table's size is set
by the length of the list and checked: up to ``BROADCAST_BLOCKS`` blocks it is broadcast, beyond that it is joined
by shuffling the distinct URL hashes only.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WORD, materialise, salted_join

#: (verdict, host, path). The longest rule that fits wins.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))
#: Fewest words of a sentence that tells one page's content from another's.
TELLING = 8
#: Words in the host of a URL that put it on the list, where no list is given.
LISTED_WORDS = ("spam", "pills", "casino", "malware", "phish", "bets", "ads-", "adult")
BITS_PER_URL, BROADCAST_BLOCKS = 16, 1 << 18
# Query parameters that don't change the page.
TRACKING = r"(?:utm_[a-z]+|gclid|fbclid|ref|sessionid|sid)"


def _lower(c: Column) -> Column:
    """A-Z lower-cased, nothing else."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end; empty for null and without ://."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return _lower(F.regexp_extract(rest, r"^[^/?#]*", 0))


def path(url: Column) -> Column:
    """After the host up to ?, # or the end."""
    rest = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """The URL without scheme, www., default port, fragment, tracking parameters, index page and closing slash; null for null."""
    name = F.regexp_replace(F.regexp_replace(host(url), r"^www\.", ""), r":(80|443)$", "")
    place = F.regexp_replace(F.regexp_replace(path(url), r"/(?:index|default)\.(?:html?|php)$", "/"), r"/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.rlike(f"^{TRACKING}(=|$)"))), "&")
    return F.when(url.isNotNull(), F.concat(name, place, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise("")))


def _sentences(text: Column) -> Column:
    """Hashes (two of 64 bits) of a text's different sentences of ``TELLING`` words or more; markup parts sentences like line ends do."""
    parts = F.transform(F.split(text, r"[\n<>]+|\. "), lambda s: F.trim(s, F.lit(". \t\r")))
    telling = F.filter(parts, lambda s: F.regexp_count(s, F.lit(WORD)) >= TELLING)
    return F.array_distinct(F.transform(telling, lambda s: F.struct(F.xxhash64(s).alias("s0"), F.xxhash64(F.lit(1), s).alias("s1"))))


def bad_content(pages: DataFrame, docs: DataFrame, labels: DataFrame, url_col: str = "url", html_col: str = "html", id_col: str = "doc_id", text_col: str = "text", bad_col: str = "toxic") -> DataFrame:
    """(url): the URLs of pages that carry a sentence found in documents labelled bad and in none labelled otherwise.

    What a page says decides, not its host. Null texts, pages and labels say nothing; very long ones are read whole; repeated rows
    change nothing; extra columns are ignored; without labels the list is empty.
    """
    known = labels.where(F.col(bad_col).isNotNull()).groupBy(F.col(id_col).alias("_id")).agg(F.max(bad_col).alias("_bad"))
    # hashes of sentences meet the labels, not texts, and by shuffle at every size
    said = docs.select(F.col(id_col).alias("_id"), _sentences(F.col(text_col)).alias("_said")).where("size(_said) > 0")
    said = salted_join(said, known, ["_id"], hash_right=True).select("_bad", F.inline("_said"))
    bad = said.groupBy("s0", "s1").agg(F.min("_bad").alias("_bad")).where("_bad > 0").select("s0", "s1")
    shown = pages.where(F.col(url_col).isNotNull()).select(F.col(url_col).alias("url"), F.inline(_sentences(F.col(html_col))))
    return salted_join(shown, bad, ["s0", "s1"], "left_semi", hash_right=True).select("url").distinct()


def rule_columns(h: Column, p: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls; among equally long ones the first."""
    rule = verdict = F.lit(None).cast("string")
    for kind, name, start in sorted(reversed(rules), key=lambda r: len(r[1]) + len(r[2])):  # the longest is asked first
        fits = ((h == name) | h.endswith("." + name)) & p.startswith(start)
        rule, verdict = F.when(fits, name + start).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def _bits(h: str) -> list[Column]:
    return [F.expr(f"shiftleft(1L, cast(shiftrightunsigned(xxhash64({h}, {i}), 58) as int))") for i in range(4)]


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, w0, w1, w2, w3) of ``listed(h)``."""
    at = listed.select(F.pmod("h", F.lit(blocks)).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits("h"))])
    return at.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(4)])


def may_be_listed(probe: DataFrame, table: DataFrame, blocks: int, broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """Rows of ``probe(h, ...)`` whose four bits are all set in the table: all that are listed, and a few that are not."""
    met = probe.withColumn("block", F.pmod("h", F.lit(blocks))).join(F.broadcast(table) if blocks <= broadcast_blocks else table, "block")  # a checked number of 40-byte rows
    for i, bit in enumerate(_bits("h")):
        met = met.where(F.col(f"w{i}").bitwiseAND(bit) != 0)
    return met.drop("block", *[f"w{i}" for i in range(4)])


def judge(pages: DataFrame, listed: DataFrame | None = None, words: tuple | None = None, rules=RULES, id_col: str = "page_id", url_col: str = "url", bits_per_url: int = BITS_PER_URL, broadcast_blocks: int = BROADCAST_BLOCKS) -> DataFrame:
    """(page_id, host, path, rule, verdict, listed): one row per row of ``pages``.

    A rule decides; without one, a URL on the list is blocked and all others are allowed. The list are the URLs of
    ``listed(url)``, as of ``bad_content``, and those of ``pages`` whose host contains one of ``words``; without either ``LISTED_WORDS`` are taken. Null URLs and those
    without :// have empty host and path, no rule, and are on no list; very long ones are judged whole; repeated rows are
    judged each; extra columns are ignored; an empty list or table is no error.
    """
    url = F.col(url_col)
    known = [listed.select("url")] if listed is not None else []
    words = words or (LISTED_WORDS if listed is None else ())
    if words:
        known.append(pages.where(host(url).rlike("|".join(words))).select(url.alias("url")))
    known = functools.reduce(DataFrame.union, known) if known else pages.select(url.alias("url")).limit(0)
    known = materialise(known.where("url is not null").select(canonical(F.col("url")).alias("canon")).distinct().withColumn("h", F.xxhash64("canon")), "listed")
    blocks = max(1, known.count() * bits_per_url // 256)
    rows = pages.select(F.col(id_col).alias("page_id"), host(url).alias("host"), path(url).alias("path"), canonical(url).alias("canon"))
    rows = rows.withColumns({"h": F.xxhash64("canon"), "nr": F.monotonically_increasing_id()})
    rows = materialise(rows, "urls")
    table = bloom(known, blocks)
    met = may_be_listed(rows.where("canon is not null and host <> ''").select("h").distinct(), table, blocks, broadcast_blocks)
    # the exact join: distinct hashes that may be listed, then the URLs themselves
    hits = met.select("h").join(known, "h").select("h", "canon").withColumn("listed", F.lit(True))
    out = salted_join(rows, hits, ["h", "canon"], "left")
    rule, verdict = rule_columns(F.col("host"), F.col("path"), rules)
    on_list = F.coalesce("listed", F.lit(False))
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, F.when(on_list, "block").otherwise("allow")).alias("verdict"), on_list.alias("listed"))
