"""URL filters: a blocked Bloom filter of listed canonical URLs, then an exact hash join.

An entry is a canonical host with a path; it fits its host, all subdomains, and every path that
starts with its own. Rules (allow, block) and listed URLs (block, unless a rule fits) are entries
alike. The distinct (host, path) of the pages are expanded to the keys that could be listed: each
suffix of the host with each beginning of the path of a length that occurs in the list. A key
picks one block of the filter and one bit in each of its eight words, so a look-up reads one row;
keys that pass go to the exact join, which removes the false positives. The longest rule wins.

Null urls and urls without ``://`` have an empty host and path and fit nothing; empty tables give
empty results; repeated pages are judged alike; extra columns are ignored. Without entries every
page gets the default verdict.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbside.llm.common import fits_broadcast, stored

WORDS = 8
BITS_PER_KEY = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# odd multipliers, one per word of a block (fixed values)
SALTS = [0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B, 0x9EFC4947, 0x5C6BFB31]


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    """One bit of 32 per word of the key's block."""
    low = F.xxhash64(key, F.lit("bits")).bitwiseAND(0x7FFFFFFF)
    return [F.call_function("shiftleft", F.lit(1).cast("long"),
                            F.shiftright((low * F.lit(s)).bitwiseAND(0xFFFFFFFF), 27).cast("int")) for s in SALTS]


def bloom(entries: DataFrame, rows: int) -> tuple[DataFrame, int]:
    """(block, w0 to w7) of the filter's blocks that hold a key, and the number of blocks."""
    blocks = 1
    while blocks * WORDS * 32 < rows * BITS_PER_KEY:
        blocks *= 2
    key = F.col("key")
    bits = entries.select(_block(key, blocks).alias("block"), *[b.alias(f"w{i}") for i, b in enumerate(_bits(key))])
    return bits.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)]), blocks


def entries_of(rules: DataFrame, listed: DataFrame | None = None) -> DataFrame:
    """(key, rule, action, rank) from rules (host, path, action) and listed canonical URLs (url)."""
    found = rules.select(F.concat("host", "path").alias("key"), "action", F.lit(1).alias("rank"))
    if listed is not None:
        url = F.col("url")
        found = found.unionByName(listed.select(F.concat(host(url), path(url)).alias("key"), F.lit("block").alias("action"),
                                                F.lit(0).alias("rank")))
    return found.where(F.length("key") > 0).distinct()


def candidates(sites: DataFrame, lengths: list[int]) -> DataFrame:
    """(host, path, key): every suffix of the host with every beginning of the path of a listed length."""
    labels = F.split("host", "[.]")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(
        F.slice(labels, i, F.size(labels)), "."))
    starts = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length("path"))
    return (sites.select("host", "path", F.explode(suffixes).alias("suffix"))
            .select("host", "path", "suffix", F.explode(starts).alias("n"))
            .select("host", "path", F.concat("suffix", F.expr("substring(path, 1, n)")).alias("key"),
                    F.length("suffix").alias("host_chars")))


def judge(pages: DataFrame, rules: DataFrame, listed: DataFrame | None = None, default: str = "allow") -> DataFrame:
    """(page_id, host, path, rule, verdict) per row of ``pages``."""
    entries = stored(entries_of(rules, listed), "url-entries")
    rows = entries.count()
    judged = pages.select("page_id", host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    if rows == 0:
        return judged.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    # path lengths that occur in the list: bounded by the longest URL
    lengths = [r["n"] for r in entries.select(
        (F.length("key") - F.coalesce(F.nullif(F.instr("key", "/"), F.lit(0)) - 1, F.length("key"))).alias("n"))
        .distinct().collect()]
    keys = candidates(judged.select("host", "path").where("host <> ''").distinct(), sorted(lengths))
    filter_, blocks = bloom(entries, rows)
    if fits_broadcast(blocks, 4 + 8 * WORDS):
        filter_ = F.broadcast(filter_)
    bits = _bits(F.col("key"))
    passed = F.lit(True)
    for i, bit in enumerate(bits):
        passed = passed & (F.col(f"w{i}").bitwiseAND(bit) != 0)
    hits = (keys.withColumn("block", _block(F.col("key"), blocks)).join(filter_, "block").where(passed)
            .select("host", "path", "key", "host_chars"))
    exact = hits.join(entries, "key")       # the false positives end here
    best = (exact.groupBy("host", "path")
            .agg(F.max(F.when(F.col("rank") == 1, F.struct(F.length("key").alias("chars"), "host_chars", "key", "action"))).alias("rule"),
                 F.max(F.col("rank") == 0).alias("listed")))
    verdict = F.coalesce("best_action", F.when(F.col("listed"), "block"), F.lit(default))
    best = best.select("host", "path", F.col("rule.key").alias("rule"), F.col("rule.action").alias("best_action"), "listed")
    return (judged.join(best, ["host", "path"], "left")
            .select("page_id", "host", "path", "rule", verdict.alias("verdict")))
