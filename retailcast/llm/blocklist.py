"""URL verdicts: allow and block rules first, then a list of URLs behind a blocked Bloom filter.

The filter is a table of blocks.  A listed URL sets one bit in each of the eight 32-bit lanes of
one block; a page passes as a possible hit if its block has all eight of its bits.  Only possible
hits go to the exact join on the canonical URL, which removes the false positives.  Everything
here is built-in DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailcast.llm.common import UPPER

LANES = 8
KEYS_PER_BLOCK = 16  # listed URLs per 256-bit block, about: 16 bits a URL
Rule = tuple[str, str, str]  # verdict, host, path


def host_of(url: Column) -> Column:
    """What stands between the first "://" and the next "/", "?", "#" or end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    """What follows the host up to "?", "#" or end; empty without "://"."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def canonical(host: Column, path: Column) -> Column:
    """Host without a leading "www." and a default port, path without page suffix and closing slashes.

    Scheme, query and fragment don't count.  No host: null, which matches nothing.
    """
    h = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    p = F.regexp_replace(F.regexp_replace(path, r"(?s)/+$", ""), r"\.html?$", "")
    return F.when(host != "", F.concat(h, p))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else null.  ``rules`` is a short list by hand."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1]) + len(r[2]), r[1], r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bit(key: Column, lane: int) -> Column:
    """The bit of a URL in a lane, as a long with one of its lower 32 bits set: five bits of a second hash."""
    place = F.shiftrightunsigned(F.xxhash64(F.lit(1), key), 5 * lane).bitwiseAND(F.lit(31).cast("long"))
    return F.element_at(F.array(*[F.lit(1 << k).cast("long") for k in range(32)]), place.cast("int") + 1)


def build_filter(listed: DataFrame, blocks: int) -> DataFrame:
    """(block, lane0..lane7) of a blocked Bloom filter over the column ``key``."""
    bits = listed.select(_block(F.col("key"), blocks).alias("block"), *[_bit(F.col("key"), k).alias(f"b{k}") for k in range(LANES)])
    return bits.groupBy("block").agg(*[F.bit_or(f"b{k}").alias(f"lane{k}") for k in range(LANES)])


def possible_hits(pages: DataFrame, filters: DataFrame, blocks: int) -> DataFrame:
    """Distinct keys of ``pages`` (column key) that the filter lets through.

    Equal keys are merged before the shuffle.  Spark broadcasts the filter only if its measured size
    is below its own threshold, and otherwise joins by block.
    """
    keys = pages.where("key is not null").select("key").distinct()
    hit = [F.col(f"lane{k}").bitwiseAND(_bit(F.col("key"), k)) != 0 for k in range(LANES)]
    both = keys.withColumn("block", _block(F.col("key"), blocks)).join(filters, "block")
    for h in hit:
        both = both.where(h)
    return both.select("key")


def judge_urls(pages: DataFrame, listed: DataFrame, rules: list[Rule] = (), keys_per_block: int = KEYS_PER_BLOCK) -> DataFrame:
    """page_id, host, path, rule, verdict, listed, one row per row of ``page_id, url``.

    ``listed`` has a column ``url``.  verdict is the rule's (allow or block) where one fits, else block
    if the canonical URL is listed, else allow.  Null or hostless URLs have empty host and path and are
    allowed.  Repeated rows stay; empty tables give no block; other columns are left out.
    """
    host, path = host_of(F.col("url")), path_of(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), list(rules))
    rows = rows.select("*", canonical(F.col("host"), F.col("path")).alias("key"), rule.alias("rule"), verdict.alias("ruled"))
    bad = listed.select(canonical(host_of(F.col("url")), path_of(F.col("url"))).alias("key")).where("key is not null").distinct()
    blocks = 1 + bad.count() // keys_per_block
    exact = possible_hits(rows, build_filter(bad, blocks), blocks).join(bad, "key", "left_semi").withColumn("listed", F.lit(True))
    # a key that very many pages share: Spark splits the skewed side of this join
    found = rows.join(exact, "key", "left")
    is_listed = F.coalesce("listed", F.lit(False))
    return found.select("page_id", "host", "path", "rule",
                        F.coalesce("ruled", F.when(is_listed, "block").otherwise("allow")).alias("verdict"), is_listed.alias("listed"))
