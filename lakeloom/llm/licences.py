"""License scans: canonical digests of entire texts, joined by hash to those of known licences. SQL functions only.

The canonical form drops copyright lines, lower-cases, turns every run of other than letters and digits into one space and
applies equivalent spellings. A unit is a document's entire text or one entire line of it; a unit is a licence if its
canonical form's SHA-256 is that of a known text. The known texts are the fixed list below (or a given list of at most `MOST_KNOWN`);
their digests are broadcast.

Defined results: a null, empty or all-punctuation text has no licences; a licence found in several lines is named once and
counted each time; repeated documents are each reported; only the id and text columns are read, so other columns never clash; an empty
table gives no rows. A text is taken whole; a very long one takes several times its bytes in one task.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Known texts whose digests may be broadcast (about 100 bytes each).
MOST_KNOWN = 100_000

#: Equivalent spellings, applied in this order to canonical text with a space at both ends.
SPELLINGS = [
    ("licence", "license"),
    ("licenced", "licensed"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("merchantibility", "merchantability"),
    ("per cent", "percent"),
    (" analogue ", " analog "),
    (" favour ", " favor "),
    (" whilst ", " while "),
    (" wilful ", " willful "),
    (" fulfil ", " fulfill "),
    (" http ", " https "),
    (" ver ", " version "),
    (" v ", " version "),
]
#: A copyright line: a notice with a sign, a year, a blank to fill in or a name after it; "(c)" alone also numbers paragraphs.
COPYRIGHT_LINE = (
    r"^[^0-9A-Za-z(©]*((?i:copyright[\s,:]*(\(c\)|©|[0-9]{4}|[\[<{])|©|\(c\)\s*(copyright|[0-9]{4})|all rights reserved)"
    r"|(?i:\(c\))(\s+\S+){1,5}\s*$|Copyright\s+(by\s+)?[A-Z])"
)
#: A line wrapped before "copyright notice", "copyright holders" or the like is text of the licence.
COPYRIGHT_TEXT = r"(?i)^[^0-9A-Za-z(©]*copyright\s+(notices?|holders?|owners?|laws?|licen[sc]es?)\b"

_DISCLAIMER = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES,
INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED.
IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR
PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR
TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE
POSSIBILITY OF SUCH DAMAGE.
"""
_BSD_2 = """
Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following
conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following
disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_3 = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products
derived from this software without specific prior written permission.
"""
_NO_WARRANTY = """
THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED
WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR
CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,
NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.
"""
_MIT = """
Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation
files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy,
modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software
is furnished to do so, subject to the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES
OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE
LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR
IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.
"""
_PERMIT = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"
_KEEP = ", provided that the above copyright notice and this permission notice appear in all copies."

#: Fixed values: (SPDX identifier, entire text). Several texts may name one licence.
KNOWN: list[tuple[str, str]] = [
    ("MIT", _MIT),
    ("MIT", "MIT License" + _MIT),
    ("MIT", "The MIT License" + _MIT),
    ("MIT", "The MIT License (MIT)" + _MIT),
    ("BSD-2-Clause", _BSD_2 + _DISCLAIMER),
    ("BSD-2-Clause", "BSD 2-Clause License" + _BSD_2 + _DISCLAIMER),
    ("BSD-3-Clause", _BSD_2 + _BSD_3 + _DISCLAIMER),
    ("BSD-3-Clause", "BSD 3-Clause License" + _BSD_2 + _BSD_3 + _DISCLAIMER),
    ("ISC", _PERMIT + _KEEP + _NO_WARRANTY),
    ("ISC", "ISC License\n" + _PERMIT + _KEEP + _NO_WARRANTY),
    ("0BSD", _PERMIT + "." + _NO_WARRANTY),
    ("0BSD", "BSD Zero Clause License\n" + _PERMIT + "." + _NO_WARRANTY),
    *[("MIT", x) for x in ("Released under the MIT License", "Licensed under the MIT License", "SPDX-License-Identifier: MIT", "This project is licensed under the MIT License")],
    *[("Apache-2.0", x) for x in ("Licensed under the Apache License, Version 2.0", "Released under the Apache License, Version 2.0", "SPDX-License-Identifier: Apache-2.0")],
    *[("GPL-3.0", x) for x in ("This work is licensed under the GNU General Public License, version 3", "Licensed under the GNU General Public License, version 3", "Released under the GNU General Public License, version 3", "SPDX-License-Identifier: GPL-3.0-only")],
    *[("CC-BY-NC-4.0", x) for x in ("Licensed under CC BY-NC 4.0", "This work is licensed under CC BY-NC 4.0", "SPDX-License-Identifier: CC-BY-NC-4.0")],
    *[("CC-BY-4.0", x) for x in ("Licensed under CC BY 4.0", "This work is licensed under CC BY 4.0", "SPDX-License-Identifier: CC-BY-4.0")],
    *[("BSD-3-Clause", x) for x in ("Licensed under the BSD 3-Clause License", "SPDX-License-Identifier: BSD-3-Clause")],
]
#: Fixed values: (SPDX identifier, SHA-256 of the canonical form) of entire texts too long to be written out here, as published: with
#: all that follows their terms, and up to the end of the terms.
KNOWN_DIGESTS: list[tuple[str, str]] = [
    ("Apache-2.0", "ef9aa6097e8b8724e8bedf9a9a264cbc3142b55ef97f3c3f079b7aa1aeac425c"),
    ("Apache-2.0", "ed44d69699f98d45c0c3e52ef4574fb05d6045eb6e2cd0e5e3810f6177e87f84"),
    ("Apache-2.0", "65bfb6f56a10dc6dd6135cf4adeee0f5bc238b3d404067ac48dbf48c0ced3b32"),
    ("Artistic-1.0", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
    ("CC0-1.0", "0c3e4ca5ed7ced6289d3f5d9a83e4100f9f34d87983b17dc5865376a8a0a98f3"),
    ("GFDL-1.2", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.2", "8d636e2e2f248f9b102e9d9f78337901ec8bca3bfe91434cdcf261a01bf305b1"),
    ("GFDL-1.3", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GFDL-1.3", "8b8b57bd195ed50d50edb5da1dd173b409fb9b075910c69726be7d0363c40008"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-1.0", "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-2.0", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808"),
    ("GPL-3.0", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636"),
    ("GPL-3.0", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.0", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-2.1", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "e0ef9dbd531e1144276348572887b7d756d42277c948f3a4f9d02d4634742d16"),
    ("MPL-1.1", "a7b29941ddca0780fadb3e3a87ac07bb3585e036d5c8818dcb645cd491a8441b"),
    ("MPL-2.0", "4544af666fc42fe3ea03e86d5db9fef4f4c41c50c15f04550119fdb67822747b"),
    ("MPL-2.0", "075fcdf87448c49dbad8c5f7963f0eb6907a3d8eae1b431ba2988508499ec0de"),
]


def canonical_line(line: Column) -> Column:
    """Canonical form of one line; empty for a copyright line."""
    words = F.concat(F.lit(" "), F.trim(F.regexp_replace(F.lower(line), r"[^\p{L}\p{N}]+", " ")), F.lit(" "))
    for a, b in SPELLINGS:
        words = F.replace(words, F.lit(a), F.lit(b))
    notice = F.regexp_like(line, F.lit(COPYRIGHT_LINE)) & ~F.regexp_like(line, F.lit(COPYRIGHT_TEXT))
    return F.when(notice, "").otherwise(F.trim(words))


def canonical_lines(text: Column) -> Column:
    """Canonical forms of the lines that have one."""
    return F.filter(F.transform(F.split(F.coalesce(text, F.lit("")), "\n"), canonical_line), lambda x: x != "")


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """licence, digest of each known text (each digest once): of the given texts, or of the fixed ones."""
    rows = spark.createDataFrame(known or KNOWN, "licence string, text string")
    rows = rows.select("licence", F.sha2(F.array_join(canonical_lines(F.col("text")), " "), 256).alias("digest"))
    if known is None:
        rows = rows.unionByName(spark.createDataFrame(KNOWN_DIGESTS, "licence string, digest string"))
    return rows.groupBy("digest").agg(F.min("licence").alias("licence"))


def scan_licences(docs: DataFrame, known: list[tuple[str, str]] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, licences (sorted, comma-joined), n_lines that are a licence, whole_licence (of the entire text, or null)."""
    if known is not None and len(known) > MOST_KNOWN:
        raise ValueError(f"more than {MOST_KNOWN} known texts: their digests are broadcast")
    lines = docs.select(F.col(id_col).alias("_id"), F.monotonically_increasing_id().alias("_row"), canonical_lines(F.col(text_col).cast("string")).alias("_lines"))
    unit = lambda x, whole: F.struct(F.sha2(x, 256).alias("digest"), F.lit(whole).alias("whole"))
    units = F.concat(F.array(unit(F.array_join("_lines", " "), True)), F.transform("_lines", lambda x: unit(x, False)))
    found = lines.select("_id", "_row", F.inline(units)).join(F.broadcast(known_digests(docs.sparkSession, known)), "digest", "left")
    return found.groupBy("_row", "_id").agg(
        F.array_join(F.sort_array(F.collect_set("licence")), ",").alias("licences"),
        F.count_if(F.col("licence").isNotNull() & ~F.col("whole")).alias("n_lines"),
        F.max(F.when(F.col("whole"), F.col("licence"))).alias("whole_licence"),
    ).select(F.col("_id").alias(id_col), "licences", "n_lines", "whole_licence")


def canonical_text(text: str | None) -> str:
    """The canonical form of an entire text in plain Python, for tests and the SQL statement of known texts."""
    out = []
    for line in (text or "").split("\n"):
        if re.match(COPYRIGHT_LINE, line) and not re.match(COPYRIGHT_TEXT, line):
            continue
        words = " " + re.sub(r"[\W_]+", " ", line.lower()).strip() + " "
        for a, b in SPELLINGS:
            words = words.replace(a, b)
        if words.strip():
            out.append(words.strip())
    return " ".join(out)
