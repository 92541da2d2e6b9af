"""License scans by canonical digest lookup.

Texts are normalised (case, copyright lines, equivalent spellings, punctuation, white space) and the digest of the
whole result is joined to the digests of known licence texts. Line breaks are white space like any other,
so that wrapping doesn't matter. A line is a copyright line if it begins with the word or sign, and then names a year, the sign or a
holder after `by`; at the beginning of a text, before or after a title, any line that begins so is one. A line of a
licence body that begins with "copyright notice" or "copyright holder" stays.

The same is done for every line as a text of its own, against known one-line notices, which are looked up in a literal map of a
fixed few entries, so that no line is exploded. The table of known texts is fixed and small, so it is
broadcast; documents aren't shuffled. Texts without any of ANCHORS, of which every known text and notice
has one in its canonical form, skip the normalisation.

Whole texts known: those of TEXTS, and by digest those of DIGESTS: Apache-2.0, Artistic-1.0, the BSD text of the University of California,
CC0-1.0, GFDL-1.2 and -1.3, GPL-1.0, -2.0 and -3.0, LGPL-2.0, -2.1 and -3.0, MPL-1.1 and -2.0.

Defined results: null and empty texts match nothing; a row stays a row, also if it repeats another or has no doc_id; repeated lines count
once per licence; a text that is several licences' is none of them. Other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_WARRANTY_MIT = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_WARRANTY_BSD = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD2 = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"""
_ISC_WARRANTY = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
"""

#: (licence, whole text). Copyright lines and titles may be there or not: titled variants are texts of their own.
TEXTS = [
    ("MIT", _MIT + _WARRANTY_MIT),
    ("MIT", "MIT License\n\n" + _MIT + _WARRANTY_MIT),
    ("MIT", "The MIT License (MIT)\n\n" + _MIT + _WARRANTY_MIT),
    ("BSD-2-Clause", _BSD2 + _WARRANTY_BSD),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD2 + _WARRANTY_BSD),
    ("BSD-3-Clause", _BSD2 + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n" + _WARRANTY_BSD),
    ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD2 + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n" + _WARRANTY_BSD),
    ("ISC", _ISC + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_WARRANTY),
    ("ISC", "ISC License\n\n" + _ISC + ", provided that the above copyright notice and this permission notice appear in all copies.\n" + _ISC_WARRANTY),
    ("0BSD", _ISC + ".\n" + _ISC_WARRANTY),
]
#: (licence, notice of one line).
NOTICES = [
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "This project is licensed under the terms of the MIT license."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", 'Licensed under the Apache License, Version 2.0 (the "License");'),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
]
#: (licence, SHA-256 of the canonical text), for texts too long to be listed here.
DIGESTS: list[tuple[str, str]] = [
    ("Apache-2.0", "6ed31aab79be61ef3197a09ceec1934e9c9c99181c892d83a2af9d37096fbb4e"),
    ("Artistic-1.0", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
    ("BSD-3-Clause-UC", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651"),
    ("CC0-1.0", "93ec2fa12c2b8b785bf1693758b00bf17f3d28a193dc27ed5d672795dc2facd1"),
    ("GFDL-1.2", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.3", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "586c3618658ef60aad1bc2ebb196d5ca77bda2718389a7bf943a62adc134b9fd"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "9445742bef21726ee53c21c26a7dbc9d839dac2b3cfa02bdf10ef5f88ce29f89"),
    ("MPL-2.0", "aa68eac73d9ffa524a89a43ee4c494b1a4993a2c8bbc6872f75af801dc59dffa"),
]
#: One of these is in every canonical text and notice; a text without them matches nothing.
ANCHORS = ("license", "licence", "permission", "redistribution", "licensing")
_MARK = r"(?:copyright|\(c\)|©)"
_LINE = r"[ \t\r/*#;>-]*"
#: (pattern, replacement), in order, over lower-cased text.
STEPS = [
    # At the beginning, before or after a title line: any copyright lines.
    (rf"\A(\s*(?:[^\n]*licen[sc]e[^\n]*\n)?)(?:{_LINE}(?:{_MARK}[^\n]*|all rights reserved[.]?[ \t\r]*)?\n)+", "$1\n"),
    # Elsewhere: those that name a sign, a year or a holder after `by`.
    (rf"(\n|\A){_LINE}(?:copyright[ \t:]*(?:\(c\)|©|[\[<{{(]?(?:yyyy|year|[0-9]{{4}})|by\b)|(?:\(c\)|©)[ \t]*(?:copyright|[0-9]{{4}}|by\b))[^\n]*", "$1"),
    (rf"(\n|\A){_LINE}all rights reserved[.]?[ \t\r]*(?=\n|\z)", "$1"),
    (r"licen[cs]ing", "licensing"),
    (r"licence", "license"),
    (r"[^\p{L}\p{N}\n]+", " "),
    (r" *\n[ \n]*", "\n"),
    (r"\A[ \n]+|[ \n]+\z", ""),
    # Words may stand on two lines.
    (r"\bsub[ \n](licens)", "sub$1"),
    (r"\bnon[ \n](infringement|commercial|exclusive|transferable)", "non$1"),
    (r"\bmerchantibility\b", "merchantability"),
    (r"\bcopyright([ \n])owner", "copyright$1holder"),
]


def canonical(text: Column) -> Column:
    """The normalised text, lines kept apart by single line feeds."""
    out = F.lower(text)
    for pattern, by in STEPS:
        out = F.regexp_replace(out, pattern, by)
    return out


def whole(canon: Column) -> Column:
    return F.replace(canon, F.lit("\n"), F.lit(" "))


def digest(canon: Column) -> Column:
    return F.sha2(whole(canon), 256)


def known(docs: DataFrame, rows: list[tuple[str, str]], digests: Sequence[tuple[str, str]] = ()) -> DataFrame:
    """(digest, license_id), from the same steps and from listed digests: a table of a fixed few rows."""
    listed = docs.sparkSession.createDataFrame(rows, "license_id string, text string").select(digest(canonical(F.col("text"))).alias("digest"), "license_id")
    given = docs.sparkSession.createDataFrame([(d, k) for k, d in digests], "digest string, license_id string")
    both = listed.unionByName(given).distinct()
    return both.groupBy("digest").agg(F.min("license_id").alias("license_id"), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")


def license_scan(docs: DataFrame, texts: list[tuple[str, str]] = TEXTS, notices: list[tuple[str, str]] = NOTICES, digests: Sequence[tuple[str, str]] = DIGESTS) -> DataFrame:
    """doc_id, license_id (of the entire text, or null), notices (licences of its lines, sorted)."""
    low = F.lower(F.coalesce(F.col("text"), F.lit("")))
    may = F.lit(False)
    for anchor in ANCHORS:
        may = may | F.contains(low, F.lit(anchor))
    canon = docs.select(F.col("doc_id").alias("doc_id"), F.when(may, canonical(F.col("text"))).alias("canon"))
    lines = F.array_distinct(F.transform(F.split(F.coalesce("canon", F.lit("")), "\n", -1), lambda x: F.sha2(x, 256)))
    hashed = canon.select("doc_id", digest(F.col("canon")).alias("digest"), F.when(F.col("canon").isNotNull(), lines).otherwise(F.array()).alias("lines"))
    texts_by_digest = F.broadcast(known(docs, texts, digests))
    # The notices as one literal map of a fixed few entries: lines are looked up where they are, none is exploded.
    listed = known(docs, notices).orderBy("digest").collect()
    table = F.create_map(*[F.lit(x) for r in listed for x in (r.digest, r.license_id)]) if listed else F.create_map().cast("map<string,string>")
    found = F.array_sort(F.array_distinct(F.filter(F.transform("lines", lambda x: F.try_element_at(table, x)), lambda x: x.isNotNull())))
    return hashed.join(texts_by_digest, "digest", "left").select("doc_id", "license_id", found.alias("notices"))
