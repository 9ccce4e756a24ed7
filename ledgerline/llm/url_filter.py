"""URL filter: a Bloom filter cascade with exact answers and no join, in DataFrame functions only.

Keys are (action, host, path prefix) strings. The listed keys are the rules and a block list of
hosts. The universe is every key that some url of the table could match: the suffixes of its host
at label borders, with the path prefixes that some listed key is as long as. Level 0 is a Bloom
filter of the listed keys; level 1 one of the universe's unlisted keys that level 0 lets through;
level 2 one of the listed keys that level 1 lets through, and so on until a level lets nothing
through. The first level that refuses a key decides it: even levels refuse unlisted keys, odd
levels listed ones. So each key of the universe is answered exactly.

Size: level 0 takes log2(unlisted / listed) bits a listed key, so what passes it is about as many
keys as are listed; later levels shrink by a constant. The whole cascade is proportional to the
list times the log of the universe. A list of more than ``MAX_LISTED`` keys is dealt by hash into
parts, each with a cascade of its own that answers for the keys of its part; a url asks the one
that its key belongs to. The cascades reach the tasks as scalar subqueries of bounded size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import stage_table
from .bits import bits_for, build_words, probe
from .common import ascii_lower

MAX_LISTED = 1_000_000
LATER_BITS, LATER_PROBES = 6.0, 4       # about 6 % pass
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def url_host(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    return F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def listed_keys(rules: DataFrame, blocked_hosts: DataFrame) -> DataFrame:
    """(key, labels, path_length) of rules (action, host, path) and of a block list (host)."""
    rule_keys = rules.select(F.substring("action", 1, 1).alias("kind"), "host", "path")
    host_keys = blocked_hosts.select(F.lit("l").alias("kind"), "host", F.lit("").alias("path"))
    both = rule_keys.unionByName(host_keys).where("host is not null and path is not null and host != ''")
    return (both.select(F.concat("kind", "host", "path").alias("key"), F.size(F.split("host", r"\.")).alias("labels"),
                        F.length("path").alias("path_length")).distinct())


def candidates(host: Column, path: Column, labels: int, lengths: list[int]) -> Column:
    """All (host suffix, path prefix) pairs that a listed key could equal, as an array of structs."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    prefixes = F.filter(F.array(*[F.when(F.length(path) >= k, F.substring(path, 1, k)) for k in lengths]),
                        lambda p: p.isNotNull())
    suffixes = F.transform(F.sequence(F.lit(1), F.least(n, F.lit(labels))),
                           lambda k: F.array_join(F.slice(parts, n - k + 1, k), "."))
    pairs = F.flatten(F.transform(suffixes, lambda h: F.transform(prefixes, lambda p: F.struct(h.alias("h"), p.alias("p")))))
    return F.when(host == "", F.array().cast("array<struct<h:string,p:string>>")).otherwise(pairs)


class Cascade:
    """Levels over one array of words. ``levels``: (first word, bits, probes, salt) of each."""

    def __init__(self, words: DataFrame, levels: list[tuple[int, int, int, int]], parts: int):
        self.words, self.levels, self.parts = words, levels, parts

    def contains(self, key: Column) -> Column:
        """Exact for keys of the universe."""
        words = self.words.scalar()
        out = F.lit(len(self.levels) % 2 == 1)          # passed every level: as the last level's keys
        for depth in reversed(range(len(self.levels))):
            first, n_bits, probes, salt = self.levels[depth]
            out = F.when(~probe(words, key, n_bits, probes, salt, first), F.lit(depth % 2 == 1)).otherwise(out)
        return out


def build_cascade(listed: DataFrame, universe: DataFrame) -> Cascade:
    """``listed`` and ``universe``: one column ``key`` each, without repeats."""
    spark = universe.sparkSession
    keys = stage_table(universe.join(listed.withColumn("is_listed", F.lit(True)), "key", "full")
                       .select("key", F.coalesce("is_listed", F.lit(False)).alias("is_listed")), "cascade-keys")
    count = {bool(r[0]): r[1] for r in keys.groupBy("is_listed").count().collect()}
    inside, outside = count.get(True, 0), count.get(False, 0)
    levels: list[tuple[int, int, int, int]] = []
    parts: list[DataFrame] = []
    first, depth = 0, 0
    left = keys.where("is_listed")
    others = keys.where("not is_listed")
    n = inside
    while n or depth == 0:
        if depth == 0:      # pass about as many unlisted keys as are listed
            probes = max(1, math.ceil(math.log2(max(2.0, outside / max(1, inside)))))
            bits = bits_for(n, 1.45 * probes + 1)
        else:
            probes, bits = LATER_PROBES, bits_for(n, LATER_BITS)
        salt = depth + 1
        words = stage_table(build_words(left, "key", bits, probes, salt), f"cascade-level-{depth}")
        levels.append((first, bits, probes, salt))
        parts.append(words)
        first += bits // 64
        through = stage_table(others.where(probe(words.scalar(), F.col("key"), bits, probes, salt)), "cascade-through")
        left, others = through, left
        n, depth = through.count(), depth + 1
    whole = spark.range(1).select(F.concat(*[p.scalar() for p in parts]).alias("words"))
    return Cascade(stage_table(whole, "cascade"), levels, len(parts))


def judge_urls(pages: DataFrame, rules: DataFrame, blocked_hosts: DataFrame, id_col: str = "page_id",
               url_col: str = "url", max_listed: int = MAX_LISTED) -> DataFrame:
    """One row per row of ``pages``: page_id, host, path, rule, verdict (allow or block), listed_host.

    A rule fits its host and all subdomains when the path starts with the rule's; the longest
    (host plus path, then host) wins, and a block rule wins over an equal allow rule. Without a
    rule, a url is blocked when its host or a parent domain is on the block list. Null or malformed
    urls have an empty host and path, no rule, and are allowed; repeated rows stay; no listed key
    at all means that everything is allowed.
    """
    urls = pages.select(F.col(f"`{id_col}`").alias("page_id"), F.col(f"`{url_col}`").alias("url"))
    parsed = stage_table(urls.select(F.monotonically_increasing_id().alias("row"), "page_id", url_host(F.col("url")).alias("host"),
                                     url_path(F.col("url")).alias("path")), "urls")
    listed = stage_table(listed_keys(rules, blocked_hosts), "listed")
    shape = listed.agg(F.max("labels"), F.collect_set("path_length"), F.count(F.lit(1))).first()
    labels, lengths, total = int(shape[0] or 1), sorted(int(x) for x in shape[1]) or [0], int(shape[2])

    cands = candidates(F.col("host"), F.col("path"), labels, lengths)
    pairs = parsed.select("host", F.substring("path", 1, max(lengths)).alias("path")).distinct().select(F.explode(cands).alias("c")).select("c.*").distinct()
    universe = stage_table(pairs.select(F.explode(F.array(*[F.concat(F.lit(k), "h", "p") for k in "abl"])).alias("key")).distinct(), "universe")

    chunks = max(1, math.ceil(total / max_listed))
    part = lambda key: F.pmod(F.xxhash64(key, F.lit(77)), F.lit(chunks))
    cascades = [build_cascade(listed.where(part(F.col("key")) == i).select("key"), universe.where(part(F.col("key")) == i))
                for i in range(chunks)]

    def member(key: Column) -> Column:
        out = cascades[-1].contains(key)
        for i in reversed(range(chunks - 1)):
            out = F.when(part(key) == i, cascades[i].contains(key)).otherwise(out)
        return out

    # each row's candidates are asked one by one; what is listed goes back to its row in one aggregation
    # over written row numbers (a bounded handful of rows each), without a join
    each = parsed.select("row", F.explode(cands).alias("c")).select(
        "row", "c.h", "c.p", F.explode(F.array(*[F.lit(k) for k in "abl"])).alias("kind"))
    hits = each.where(member(F.concat("kind", "h", "p")))
    fit = F.when(F.col("kind") != "l", F.struct((F.length("h") + F.length("p")).alias("size"), F.length("h").alias("host_size"),
                                                "kind", F.concat("h", "p").alias("rule")))
    hits = hits.select("row", fit.alias("fit"), (F.col("kind") == "l").alias("listed_host"))
    urls = parsed.unionByName(hits, allowMissingColumns=True).groupBy("row").agg(
        F.max("page_id").alias("page_id"), F.max("host").alias("host"), F.max("path").alias("path"), F.max("fit").alias("fit"),
        F.coalesce(F.bool_or("listed_host"), F.lit(False)).alias("listed_host"))
    verdict = F.when(F.col("fit").isNotNull(), F.when(F.col("fit.kind") == "a", "allow").otherwise("block")) \
               .otherwise(F.when(F.col("listed_host"), "block").otherwise("allow"))
    return urls.select("page_id", "host", "path", F.col("fit.rule").alias("rule"), verdict.alias("verdict"), "listed_host")


def rules_frame(spark: SparkSession, rules=None) -> DataFrame:
    return spark.createDataFrame(RULES if rules is None else rules, "action string, host string, path string")
