"""Secret scan by corpus-wide ownership frequency.

* Each task searches whole texts for candidates: assigned values, access keys, long hexadecimal runs (the
  base kinds) and bare runs that look like a live credential. A candidate is written as its span and a hash
  of its value; the value itself never leaves the task.
* Hashes are aggregated over the corpus, innermost first: occurrences by (value, owner, repository), then
  repositories by (value, owner), then owners by value. Each step is combined in the map tasks, so a value that
  a third of all rows repeat arrives as a few rows.
* A value of at most ``max_owners`` owners and ``max_repos`` repositories that looks live is ``live``; a value
  spread wider is an ``example`` that people copy; what remains is ``weak``. Base spans stay whatever
  their verdict; the method adds the bare runs that are ``live``.

The verdicts return to the occurrences by an equi-join on the value's hash. Values with more than one in
``HOT_SHARE`` of all occurrences, of which there are fewer than ``HOT_SHARE``, are broadcast; no other value
can fill a task.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import stage_table, work_dir

# Kinds in their order, patterns and least lengths of the contract.
KINDS = ("assign", "access", "hex", "bare")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")          # greedy, so equal to runs of any length of which 16 and more stay
ASSIGN_LEAST, ACCESS_LEAST = 12, 18

# What makes a value look live: parameters of this module.
BARE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
LETTER, DIGIT = re.compile(r"[A-Za-z]"), re.compile(r"[0-9]")
MIN_ENTROPY = 3.0                           # bits a character
PLACEHOLDERS = re.compile(r"example|sample|dummy|changeme|your|placeholder|test|xxxx|0123456|1234567|abcdef0", re.IGNORECASE)

HOT_SHARE = 1000

_FOUND = T.ArrayType(T.StructType([
    T.StructField("kind", T.IntegerType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
    T.StructField("value", T.BinaryType()), T.StructField("looks_live", T.BooleanType())]))


def looks_live(value: str) -> bool:
    """Letters and digits, no placeholder word, and enough entropy a character."""
    if not LETTER.search(value) or not DIGIT.search(value) or PLACEHOLDERS.search(value):
        return False
    n = len(value)
    return -sum(c / n * math.log2(c / n) for c in Counter(value).values()) >= MIN_ENTROPY


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, kind, end, value) of the three base kinds, leftmost and not overlapping within a kind, by
    start and then kind; a match that is too short uses up its characters and is dropped."""
    found = [(m.start(), 0, m.end(), m.group(2)) for m in ASSIGN.finditer(text) if len(m.group(2)) >= ASSIGN_LEAST]
    found += [(m.start(), 1, m.end(), m.group()) for m in ACCESS.finditer(text) if len(m.group()) >= ACCESS_LEAST]
    found += [(m.start(), 2, m.end(), m.group()) for m in HEX.finditer(text)]
    return sorted(found)


def bare_spans(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, int, str]]:
    """Runs that look live and touch no base span."""
    found = [(m.start(), 3, m.end(), m.group()) for m in BARE.finditer(text) if looks_live(m.group())]
    if not found or not base:
        return found
    out, at, reach = [], 0, 0                # both lists ascend by start
    for span in found:
        while at < len(base) and base[at][0] < span[2]:
            reach = max(reach, base[at][2])
            at += 1
        if reach <= span[0]:
            out.append(span)
    return out


def joined(spans) -> str:
    return ",".join(f"{KINDS[kind]}:{start}:{end}" for start, kind, end, _ in spans)


def _candidates(source: DataFrame) -> DataFrame:
    """source (doc_id, text, owner, repo) -> one row per row with its base columns and all candidates."""
    schema = T.StructType([
        T.StructField("doc_id", source.schema["doc_id"].dataType), T.StructField("owner", T.StringType()),
        T.StructField("repo", T.StringType()), T.StructField("n_assign", T.LongType()), T.StructField("n_access", T.LongType()),
        T.StructField("n_hex", T.LongType()), T.StructField("base_sha256", T.StringType()), T.StructField("found", _FOUND)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            counts: list[list[int]] = [[], [], []]
            digests, found = [], []
            for text in batch.column("text").to_pylist():
                base = base_spans(text)
                for kind in range(3):
                    counts[kind].append(sum(s[1] == kind for s in base))
                digests.append(hashlib.sha256(joined(base).encode()).hexdigest())
                found.append([{"kind": kind, "start": start, "end": end, "value": hashlib.sha256(value.encode()).digest(),
                               "looks_live": kind == 3 or looks_live(value)}
                              for start, kind, end, value in base + bare_spans(text, base)])
            columns = [batch.column("doc_id"), batch.column("owner"), batch.column("repo"), *counts, digests, found]
            yield pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                                              for c, f in zip(columns, arrow, strict=True)], schema=arrow)

    return source.mapInArrow(run, schema)


def ownership(found: DataFrame) -> DataFrame:
    """found (value, owner, repo) -> value, owners, repos, occurrences. A repository belongs to its owner; a
    null owner or repository is one owner or repository of its own."""
    copies = found.groupBy("value", "owner", "repo").agg(F.count(F.lit(1)).alias("occurrences"))
    by_owner = copies.groupBy("value", "owner").agg(F.count(F.lit(1)).alias("repos"), F.sum("occurrences").alias("occurrences"))
    return by_owner.groupBy("value").agg(F.count(F.lit(1)).alias("owners"), F.sum("repos").alias("repos"),
                                         F.sum("occurrences").alias("occurrences"))


def scan_secrets(docs: DataFrame, owner: Column | None = None, repo: Column | None = None, id_col: str = "doc_id",
                 text_col: str = "text", max_owners: int = 1, max_repos: int = 3, hot_share: int = HOT_SHARE) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_assign, n_access, n_hex, base_sha256 and ``findings``, an array by
    (start, kind) of kind, start, end (code points, end exclusive), value_sha256, owners, repos, occurrences and verdict:
    every base span, and the bare runs with the verdict ``live``.

    ``owner`` and ``repo`` are string columns of ``docs`` (the columns ``source`` and ``lang`` by default).
    Defined cases: a null text is empty and has no findings; an owner or repository that is null counts as one; rows
    that repeat an id or a whole row are scanned each, and a repeated value within one repository is more
    occurrences, not more repositories; null ids stay; an empty table gives no rows; further columns
    are ignored, whatever their names.
    """
    owner = F.col("`source`") if owner is None else owner
    repo = F.col("`lang`") if repo is None else repo
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"),
                         owner.cast("string").alias("owner"), repo.cast("string").alias("repo"))
    rows = stage_table(_candidates(source).withColumn("row", F.monotonically_increasing_id()), "secret-candidates")
    found = rows.select("row", "owner", "repo", F.explode("found").alias("f")).select(
        "row", "owner", "repo", "f.value", F.col("f").dropFields("value").alias("span"))

    path, seen = work_dir(docs.sparkSession, "stage-secret-owners"), Observation("secret-occurrences")
    ownership(found).observe(seen, F.sum("occurrences").alias("total")).write.parquet(path)
    frequency = docs.sparkSession.read.parquet(path)
    limit = (seen.get["total"] or 0) // hot_share
    hot = F.broadcast(frequency.where(F.col("occurrences") > limit)) if limit else None
    place = found.select("row", "value", "span")
    if hot is None:
        known = place.join(frequency, "value")
    else:
        cold = frequency.where(F.col("occurrences") <= limit)
        known = place.join(hot, "value").unionByName(place.join(hot, "value", "left_anti").join(cold, "value"))

    verdict = (F.when((F.col("owners") > max_owners) | (F.col("repos") > max_repos), "example")
               .when(F.col("span.looks_live"), "live").otherwise("weak"))
    kind = F.element_at(F.array(*[F.lit(k) for k in KINDS]), F.col("span.kind") + 1)
    judged = known.select("row", "span", verdict.alias("verdict"), "owners", "repos", "occurrences", "value", kind.alias("name")) \
                  .where((F.col("span.kind") < 3) | (F.col("verdict") == "live"))
    # a row's own findings: as many as its text holds; the two sort keys lead the struct
    findings = judged.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(
        F.col("span.start").alias("start"), F.col("span.kind").alias("order"), F.col("name").alias("kind"), F.col("span.end").alias("end"),
        F.lower(F.hex("value")).alias("value_sha256"), "owners", "repos", "occurrences", "verdict"))).alias("findings"))
    empty = F.array().cast(findings.schema["findings"].dataType)
    return rows.join(findings, "row", "left").select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256",
                                                     F.coalesce("findings", empty).alias("findings"))


def spans_text(findings: Column) -> Column:
    """``findings`` as kind:start:end, comma-joined."""
    return F.concat_ws(",", F.transform(findings, lambda f: F.concat_ws(":", f["kind"], f["start"].cast("string"), f["end"].cast("string"))))


def count_verdict(findings: Column, verdict: str) -> Column:
    return F.size(F.filter(findings, lambda f: f["verdict"] == verdict)).cast("long")
