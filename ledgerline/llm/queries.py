"""The registered queries of this subpackage, their SQL where SQL can express them.

Each query applies its operator to the whole intended table and derives the result's columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import (alignment, decontaminate, exact_dedup, hmm, license_scan, minhash, packing, quality, secrets, token_counts, toxicity, url_filter,
               whitening)
from .common import read_table, ship_package

# Host labels of the block list that op3 derives from the table's own hosts (fixed values).
BLOCKED_LABELS = ("ads-track", "adult-x", "casino-win", "cheap-pills", "free-bets", "spam-farm")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = license_scan.known_digests(spark)
    return license_scan.license_scan(read_table(spark, sf_dir, "documents"), known)


def op1_license_notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = license_scan.known_digests(spark)
    return license_scan.notice_scan(read_table(spark, sf_dir, "documents"), known)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read_table(spark, sf_dir, "pages")
    host = url_filter.url_host(F.col("url"))
    spam = F.arrays_overlap(F.split(host, r"\."), F.array(*[F.lit(x) for x in BLOCKED_LABELS]))
    blocked = pages.where(spam).select(host.alias("host")).distinct()
    return url_filter.judge_urls(pages, url_filter.rules_frame(spark), blocked)


def op4_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_texts(read_table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(read_table(spark, sf_dir, "documents"))


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(read_table(spark, sf_dir, "documents"), shingle=2)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(read_table(spark, sf_dir, "documents"))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return quality.score_quality(docs, quality.fit(docs, read_table(spark, sf_dir, "labels")))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_overlaps(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(*exact_dedup.two_batches(read_table(spark, sf_dir, "documents")))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(read_table(spark, sf_dir, "embeddings"))


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` names no repositories: a source is an owner, and its texts of one language are a repository."""
    found = secrets.scan_secrets(read_table(spark, sf_dir, "documents"), owner=F.col("source"), repo=F.col("lang"))
    counted = [secrets.count_verdict(F.col("findings"), v).alias(f"n_{v}") for v in ("live", "example", "weak")]
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", secrets.spans_text(F.col("findings")).alias("spans"), *counted)


def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(read_table(spark, sf_dir, "documents"))[0]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_license_scan, op1_license_notices, op2_toxicity, op3_url_filter, op4_hmm, op5_packing, op6_minhash, op7_token_counts, op8_quality,
           op9_decontaminate, op10_exact_dedup, op11_whitening, op12_secrets, op13_alignment)

    def ready(f):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_checkpoint_dir(spark)
            ship_package(spark)
            return f(spark, sf_dir)
        return run

    return {f.__name__: ready(f) for f in own}


_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SPAM = ", ".join(f"'{x}'" for x in BLOCKED_LABELS)

ORACLE_SQL = {
    "op10_exact_dedup": f"""
WITH k AS (SELECT doc_id, sha256({_LOWER.format("coalesce(text, '')")}) AS text_sha256 FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = max(doc_id) OVER w AS kept, text_sha256
FROM k WINDOW w AS (PARTITION BY text_sha256)""",
    "op3_url_filter": f"""
WITH a AS (SELECT page_id, url, CASE WHEN position('://' IN url) > 0 THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
             regexp_extract(regexp_replace(rest, '^[^/?#]*', ''), '^[^?#]*') AS path FROM a),
c AS (SELECT *, CASE
    WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
    WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule,
  list_has_any(string_split(host, '.'), [{_SPAM}]) AS listed_host FROM b)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN listed_host THEN 'block' ELSE 'allow' END AS verdict, listed_host FROM c""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
