"""Licence scan by canonical digest lookup, in DataFrame functions only.

A text is brought to canonical form -- case, copyright notices (not wrapped lines of a licence that begin with that word), punctuation and white space, equivalent spellings -- and the
digest of its whole canonical form is hash-joined to those of known licences: ``license_digests``, whose licences the README lists.

Defined cases: a null or empty text, or one without letters and digits, has an empty canonical form and matches no
licence; repeated rows are looked up each; an empty table gives an empty result; further columns are ignored; licences of
equal canonical form are one, named by the smallest id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import literal_rows, text_or_empty
from .license_digests import DIGESTS

#: Words that licence matching treats as equal, after the public SPDX guidelines.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"),
    ("authorisation", "authorization"), ("authorised", "authorized"), ("calibre", "caliber"), ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"), ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"),
    ("labour", "labor"), ("licence", "license"), ("licenced", "licensed"), ("licencing", "licensing"), ("maximise", "maximize"), ("modelled", "modeled"), ("modelling", "modeling"),
    ("offence", "offense"), ("optimise", "optimize"), ("organisation", "organization"), ("organise", "organize"),
    ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"),
    ("signalling", "signaling"), ("utilisation", "utilization"), ("whilst", "while"), ("wilful", "willful"),
    ("noncommercial", "non  commercial"), ("sublicence", "sublicense"), ("https", "http"),
)
#: Lines that the DuckDB SQL takes for notices: all that begin so.
_COPYRIGHT = r"(?md)^[^\p{L}\p{N}\n]*(?:copyright\b|\(c\)|©|all rights reserved)[^\n]*$"
#: What follows the word in the wrapped body of a licence, where its line is no notice.
_BODY = (r"holders?|owners?|ownership|notices?|and|or|laws?|lines?|disclaimers?|interests?|on|permission|resulting|licen[sc]es?|also|like|those|"
         r"treaty|are|is|if|in|to|for|as|patents?|statements?|of|doctrines|the(?=[ \t]*$)|the[ \t]+software")
_NOTICE = (r"(?md)^[^\p{L}\p{N}\n]*(?:copyright\b(?![ \t]*(?:$|[.,;)\"'/-]|(?:" + _BODY + r")\b))"
           r"|\(c\)(?![^\p{L}\p{N}\n]*(?:$|(?:the|you|your|a|an|any|each|if|in|to|under|representations)\b))|©|all rights reserved)[^\n]*$")

#: Texts of known licences and notices.
MIT = """MIT License

Copyright (c) <year> <copyright holders>

Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
ISC = """ISC License

Copyright (c) <year> <owner>

Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
BSD2 = """BSD 2-Clause License

Copyright (c) <year>, <owner>

Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.
"""
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("GPL-3.0-only", "This work is licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
)
KNOWN = (("MIT", MIT), ("ISC", ISC), ("BSD-2-Clause", BSD2), *NOTICES)


def canonical(text: Column) -> Column:
    """Lower case, no copyright lines, words of letters and digits between double blanks, one spelling."""
    low = F.regexp_replace(F.regexp_replace(F.lower(text), r"\r\n?", "\n"), _NOTICE, "")
    # two blanks, so that neighbouring words are both replaced
    words = F.concat(F.lit("  "), F.regexp_replace(low, r"[^\p{L}\p{N}]+", "  "), F.lit("  "))
    for spelled, kept in SPELLINGS:
        words = F.replace(words, F.lit(f" {spelled} "), F.lit(f" {kept} "))
    return F.trim(F.regexp_replace(words, " +", " "))


def known_digests(spark: SparkSession, known: tuple[tuple[str, str], ...] = KNOWN) -> DataFrame:
    """(license_id, known_digest) of licence texts given as (id, text)."""
    rows = literal_rows(spark, list(known), "license_id string, text string")
    return rows.select("license_id", F.sha2(canonical(F.col("text")), 256).alias("known_digest")).groupBy("known_digest").agg(
        F.min("license_id").alias("license_id"))


def shipped_digests(spark: SparkSession) -> DataFrame:
    """(known_digest, license_id) of the licences of the table ``DIGESTS``, which has those of ``KNOWN`` and many more."""
    return literal_rows(spark, list(DIGESTS), "license_id string, known_digest string").select("known_digest", "license_id")


def license_report(docs: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """doc_id, canonical_chars, canonical_sha256, license_id (null where no known licence is the whole text)."""
    known = shipped_digests(docs.sparkSession) if known is None else known
    rows = docs.select("doc_id", canonical(text_or_empty()).alias("canonical"))
    rows = rows.select("doc_id", F.char_length("canonical").cast("long").alias("canonical_chars"), F.sha2("canonical", 256).alias("canonical_sha256"))
    found = rows.join(known, (F.col("canonical_sha256") == F.col("known_digest")) & (F.col("canonical_chars") > 0), "left")
    return found.select("doc_id", "canonical_chars", "canonical_sha256", "license_id")
