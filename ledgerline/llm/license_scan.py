"""License scan by canonical digest lookup, in DataFrame functions only.

A text is brought to a canonical form:

* copyright notices go: a line that begins with the word or sign and then a sign, a year or a placeholder, or a
  paragraph of lines of the word and a name;
* a title before the text that names its licence goes;
* case, punctuation (bullets with it) and white space are levelled;
* equivalent spellings (the pairs of the SPDX matching guidelines) become one, and so do the parts of a text that
  its users replace: a holder's name in BSD, MIT and ISC clauses, clause numbers, the foundation's postal address.

The SHA-256 of the canonical text is hash-joined to the digests of known licences, so an entire text matches
or it doesn't. Known licences pass through the same expression, once whole and once up to the end of their terms
(the appendix on how to apply them is optional). The known texts are a table of
the caller; the default is the texts in ``licenses/``, MIT, ISC and one-line notices, a constant.

Notices inside longer documents: every line whose canonical length equals that of a known
one-line notice (an exact screen) is joined by digest in the same way.
"""

from __future__ import annotations

from importlib import resources

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_text

# Public licence texts and notices, in their published wording.
_MIT = """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """ISC License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
KNOWN_LICENSES = [
    ("MIT", _MIT),
    ("ISC", _ISC),
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0-only", "SPDX-License-Identifier: GPL-3.0-only"),
]
# Equivalent spellings as (pattern, replacement) families of the SPDX guidelines.
# They run on lower-case words separated by single spaces.
SPELLINGS = [
    (r"licence", "license"), (r"\bsub license", "sublicense"), (r"\bnon (infring|commercial)", "non$1"),
    (r"\b(fav|hon|lab)our", "$1or"), (r"\bcentre", "center"), (r"\bfulfil(?=s|ment|\b)", "fulfill"),
    (r"\b(acknowledg|judg)ement", "$1ment"), (r"\b(analog|catalog)ue", "$1"), (r"\bprogramme", "program"),
    (r"\b(author|initial|merchand|organ|real|recogn|util)is(?=e|ing|ation)", "$1iz"), (r"\bcopyright (owner|holder)", "copyright holder"),
    (r"\bpercent\b", "per cent"), (r"\bwhilst\b", "while"), (r"\bwilful", "willful"), (r"\bcheque", "check"),
    (r"\bhttps (?=(?:www )?(?:fsf|gnu|apache|mozilla|creativecommons) org)", "http "),
    (r"\blibrary general public license(?= instead)", "lesser general public license"),
]
# What users of a text replace in it, and the words that stand for it; they run after the spellings.
REPLACED = [
    (r"\b(?:\d|[a-z]|i{2,3}) (?=redistributions (?:of|in) |neither the names? of |the origin of this software |altered source versions |this notice may not be removed )", ""),
    (r"\bneither the names? of .{1,200}? nor the names of (?:(?:its|their|any|other) )?contributors may be used", "neither holder nor contributors may be used"),
    (r"\bsoftware is provided by .{1,200}? as is\b", "software is provided by holder as is"),
    (r"\bas is and .{1,200}? disclaims? all warranties\b", "as is and holder disclaims all warranties"),
    (r"\bin no event shall .{1,200}? be liable\b", "in no event shall holder be liable"),
    (r"\b(?:51 franklin st(?:reet)? (?:fifth floor|suite 500)|59 temple place suite 330|675 mass(?:achusetts)? ave(?:nue)?) (?:boston|cambridge) ma \d{5}(?: \d{4})?(?: usa)? ?", ""),
]
# Titles that name a licence, in canonical words. One at the start of a longer text goes.
TITLES = [
    "mit license", "mit license mit", "mit license expat", "expat license", "isc license", "zlib license", "apache license", "mozilla public license",
    "gnu general public license", "gnu lesser general public license", "gnu library general public license", "bsd license", "new bsd license",
    "modified bsd license", "revised bsd license", "simplified bsd license", "2 clause bsd license", "3 clause bsd license", "bsd 2 clause license",
    "bsd 3 clause license", "bsd 2 clause simplified license", "bsd 3 clause new or revised license",
]
END_OF_TERMS = "END OF TERMS AND CONDITIONS"
# One pass decides whether any family can apply, so that ordinary text pays for one regex only.
_TITLE = "^(?:the )?(?:" + "|".join(sorted(TITLES, key=len, reverse=True)) + r") (?=.)"
_ANY_FAMILY = "|".join([p for p, _ in SPELLINGS + REPLACED] + [_TITLE])
_DATED = r"(?:(?:19|20)\d\d\b|[<\[{][^\n>\]}]*[>\]}])"          # a year or a placeholder
# The words that follow "copyright" in the terms themselves, not in a notice.
_TERMS = (r"(?:notices?|owners?|holders?|laws?|licen[cs]es?|statements?|interests?|disclaimers?|rights?|treat(?:y|ies)|acts?|status|and|or|"
          r"in|on|by|to|the|is|are|for|of|as|with|that|this|permission|information|protection|infringement|act)")
_NAMED = r"[^\p{L}\p{N}\n]*copyright\b[ \t:,]*(?!" + _TERMS + r"\b)[^\s:,][^\n]{0,119}"
_COPYRIGHT = (r"(?im)(?:\A\s*|\n[^\p{L}\p{N}\n]*\n)" + _NAMED + r"(?:\n" + _NAMED + r")*(?=\s*\z|\n[^\p{L}\p{N}\n]*(?:\n|(?:all )?rights reserved))"
              r"|^[^\p{L}\p{N}©]*(?:©|copyright\b[\s:,]*(?:\(c\)|©|" + _DATED + r")|\(c\)\s*(?:copyright\b|©|" + _DATED + r"))[^\n]*$"
              r"|^[^\p{L}\p{N}\n]*(?:all )?rights reserved[^\p{L}\p{N}\n]*$")


def canonical(text: Column) -> Column:
    """The canonical form of a text or a line; '' for null, empty or punctuation only."""
    plain = F.regexp_replace(F.coalesce(text, F.lit("")), _COPYRIGHT, "")
    plain = F.trim(F.regexp_replace(F.lower(plain), r"[^\p{L}\p{N}]+", " "))
    levelled = plain
    for pattern, to in SPELLINGS + REPLACED:
        levelled = F.regexp_replace(levelled, pattern, to)
    levelled = F.regexp_replace(F.trim(levelled), _TITLE, "")
    return F.when(F.rlike(plain, F.lit(_ANY_FAMILY)), levelled).otherwise(plain)


def without_appendix(text: str) -> list[str]:
    """A known text in its forms: whole; where its terms have an end mark, also up to that mark, with and without it."""
    terms, mark, _ = text.partition(END_OF_TERMS)
    return [text, terms + mark, terms] if mark else [text]


def known_texts() -> list[tuple[str, str]]:
    """``KNOWN_LICENSES`` and the texts in ``licenses/``, each named by its SPDX id; read by the driver only."""
    folder = resources.files(__package__) / "licenses"
    return KNOWN_LICENSES + [(f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in sorted(folder.iterdir(), key=lambda f: f.name) if f.name.endswith(".txt")]


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(license_id, canon_length, digest) of the known texts, one row per digest."""
    forms = [(name, form) for name, text in (known if known is not None else known_texts()) for form in without_appendix(text)]
    frame = spark.createDataFrame(forms, "license_id string, known_text string")
    canon = frame.select("license_id", canonical(F.col("known_text")).alias("c")).where("c != ''")
    return (canon.groupBy(F.sha2(F.col("c").cast("binary"), 256).alias("digest"))
            .agg(F.min("license_id").alias("license_id"), F.min(F.length("c")).alias("canon_length")))


def license_scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, canonical_sha256, license_id (null: no known text).

    Null, empty and punctuation-only texts have the digest of '' and no licence; repeated rows
    stay; a text with known licence lines among others isn't a licence (see ``notice_scan``).
    """
    canon = id_text(docs, id_col, text_col).select("doc_id", canonical(F.col("text")).alias("c"))
    keyed = canon.select("doc_id", F.sha2(F.col("c").cast("binary"), 256).alias("canonical_sha256"))
    k = known.select(F.col("digest"), "license_id")
    return keyed.join(k, keyed["canonical_sha256"] == k["digest"], "left").select("doc_id", "canonical_sha256", "license_id")


def notice_scan(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, line_no from 1, license_id) of the lines that are a known text as a whole.

    The canonical lengths of the known texts (a constant list) screen lines before the join.
    """
    lengths = known.where("canon_length > 0").agg(F.collect_set("canon_length").alias("n"))
    lines = (id_text(docs, id_col, text_col)
             .select("doc_id", F.posexplode(F.split("text", "\n")).alias("at", "line"))
             .select("doc_id", (F.col("at") + 1).cast("bigint").alias("line_no"), canonical(F.col("line")).alias("c"))
             .where(F.array_contains(lengths.scalar(), F.length("c"))))
    keyed = lines.select("doc_id", "line_no", F.sha2(F.col("c").cast("binary"), 256).alias("canonical_sha256"))
    return (keyed.join(known, keyed["canonical_sha256"] == known["digest"])
            .select("doc_id", "line_no", "license_id"))
