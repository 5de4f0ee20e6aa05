"""Licence scans by the digest of a canonical text (operator 6). DataFrame functions only.

A text is brought to one form: case, punctuation and spacing are levelled, copyright lines go,
equivalent spellings become one. Entire texts are then joined by digest to those of known licences.
Lines that are a notice by themselves are joined in the same way and reported beside.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import shared

#: Equivalent spellings, applied in this order to the levelled text (words between single spaces).
SPELLINGS = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("merchantibility", "merchantability"),
    ("organisation", "organization"),
    ("https", "http"),
    ("version 2 0", "version 2"),
    ("version 3 0", "version 3"),
    ("gnu gpl", "gnu general public license"),
    ("cc by nc", "creative commons attribution noncommercial"),
    ("non commercial", "noncommercial"),
)

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""

_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_2 = f"""Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. {_DISCLAIMER}"""
_BSD_3 = _BSD_2.replace(_DISCLAIMER, f"3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. {_DISCLAIMER}")
_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE. For more information, please refer to <https://unlicense.org>"""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or altered from any source distribution."""
_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

#: Known licences: name and text, whole or as a one-line notice. Fixed values.
KNOWN = (
    ("MIT", _MIT),
    ("MIT", "The MIT License " + _MIT),
    ("MIT", "The MIT License (MIT) " + _MIT),
    ("MIT", "MIT License " + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("ISC", _ISC),
    ("ISC", "ISC License " + _ISC),
    ("BSD-2-Clause", _BSD_2),
    ("BSD-2-Clause", "BSD 2-Clause License " + _BSD_2),
    ("BSD-2-Clause", "All rights reserved. " + _BSD_2),
    ("BSD-3-Clause", _BSD_3),
    ("BSD-3-Clause", "BSD 3-Clause License " + _BSD_3),
    ("BSD-3-Clause", "All rights reserved. " + _BSD_3),
    ("Unlicense", _UNLICENSE),
    ("Zlib", _ZLIB),
    ("Zlib", "zlib License " + _ZLIB),
    ("Apache-2.0", _APACHE_HEADER),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Released under the Apache License, Version 2.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under CC BY-NC 4.0."),
    ("all-rights-reserved", "All rights reserved."),
)
#: Known licences of greater length: name and digest of the canonical text, as published, and without
#: what follows its terms (how to apply it, exhibits, addenda). Fixed values.
DIGESTS = (
    ("Apache-2.0", "dc491bb5caf20a549b4a66b80fce0a7ce604702bfd0bf8fed47794c33aff087e"),
    ("Apache-2.0", "ae882a969c0de016a87da49fc8245f20318f91539ffc7dc716c628399501e159"),
    ("Artistic-1.0", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2"),
    ("BSD-3-Clause", "3d151449461c0c776e892a4dc41cac0d251eb00c9fc49d2d48802d9bed818fe9"),
    ("CC0-1.0", "96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f"),
    ("GFDL-1.2", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60"),
    ("GFDL-1.2", "84f3c9e8cdded0036378e7e6eb92ac6570731434d2fc46027f259264dc16501e"),
    ("GFDL-1.3", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826"),
    ("GFDL-1.3", "ccfa2750c2a3b9dae93f959cfa64078cc3a306c4a4cd4cfaf18365396202da90"),
    ("GPL-1.0", "8a4692e318e41e8d96d4610f021d16f03ff4485322f3d81c00d2621fdda7b2b1"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc"),
    ("GPL-2.0", "0248b317bc123a7424b6ff9799b9786ffde75241881994270612a604d03836cc"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34"),
    ("GPL-3.0", "29eecc09cdd688bf6add7d25aa71df775abdf43423eee3c39d927b090080f46d"),
    ("GPL-3.0", "f6e910952ff4741eb305128d599e488c6d0d321ffd70cd65bac3a2743fd8c8d3"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4"),
    ("LGPL-3.0", "af4f466bab5554afad60c219ff8bf29eddb00df6ef0f1fcf73fa05ad4b3289f5"),
    ("MPL-1.1", "469a6324726e3318515c938121859a1acfaba5d131d662968839e23a92b8a873"),
    ("MPL-2.0", "22c9324e5634aa07c32060365e6191d4f9ec61fafc6091ce7394333c6d7db95e"),
    ("MPL-2.0", "5d0db0c900007e609323363aa24206b85e8febd85af3266e88a960a60aaf01af"),
)

_COPYRIGHT = "(^|\n)[^\n]*(copyright \\(c\\)|copyright ©|copyright [0-9]|©)[^\n]*"


def levelled(text: Column) -> Column:
    """Canonical text with its line ends kept: lower case, words between single spaces, no copyright lines."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _COPYRIGHT, "$1")
    out = F.concat(F.lit(" "), F.regexp_replace(F.regexp_replace(out, "[^\\p{L}\\p{N}\n]+", " "), " ?\n ?", " \n "), F.lit(" "))
    return spelled(out)


def spelled(level: Column) -> Column:
    for one, other in SPELLINGS:
        level = F.replace(level, F.lit(f" {one} "), F.lit(f" {other} "))
    return level


def one_line(level: Column) -> Column:
    """A levelled text as one line; spellings may also have been broken by line ends."""
    return F.trim(spelled(F.regexp_replace(level, "[ \n]+", " ")))


def digest(canonical: Column) -> Column:
    return F.sha2(canonical, 256)


def of_texts(texts: DataFrame) -> DataFrame:
    """license and digest for a table of license and text, for scan()."""
    return texts.select("license", digest(one_line(levelled(F.col("text")))).alias("digest"))


def known(spark: SparkSession) -> DataFrame:
    """license and digest of each known text."""
    entries = lambda rows, names: spark.range(1).select(F.inline(F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(names, row, strict=True)]) for row in rows])))
    return of_texts(entries(KNOWN, ("license", "text"))).unionByName(entries(DIGESTS, ("license", "digest")))


def scan(docs: DataFrame, licenses: DataFrame | None = None) -> DataFrame:
    """One row for each row of docs: doc_id, license (of the whole text, else null), notices, n_notice_lines.

    licenses: license and digest, the known ones if None; of several names of a digest the first by
    name is taken. notices: the sorted names of licences that a whole line states, comma-joined, ''
    if none. n_notice_lines: how many lines do. Null and empty texts have none. Findings are gathered
    by text, so copies and repeated ids each get their row. The optimiser broadcasts the digests by
    their size; texts never move, only their digests do.
    """
    table = (known(docs.sparkSession) if licenses is None else licenses).groupBy("digest").agg(F.min("license").alias("license"))
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("key", F.sha2(F.coalesce("text", F.lit("")), 256))
    texts = keyed.select("key", levelled(F.col("text")).alias("level"))
    # A text of one line is also its own line; the position tells the two apart.
    pieces = texts.select("key", F.posexplode(F.concat(F.array(one_line(F.col("level"))), F.transform(F.split("level", "\n"), lambda x: F.trim(x)))).alias("line", "piece"))
    found = pieces.where("piece <> ''").withColumn("digest", digest(F.col("piece"))).join(F.broadcast(table) if licenses is None else table, "digest")
    by_text = (
        found.distinct()
        .groupBy("key")
        .agg(
            F.max(F.when(F.col("line") == 0, F.col("license"))).alias("license"),
            F.array_join(F.array_sort(F.collect_set(F.when(F.col("line") > 0, F.col("license")))), ",").alias("notices"),
            F.count(F.when(F.col("line") > 0, 1)).alias("n_notice_lines"),
        )
    )
    out = keyed.select("doc_id", "key").join(by_text, "key", "left")
    return out.select("doc_id", "license", F.coalesce("notices", F.lit("")).alias("notices"), F.coalesce("n_notice_lines", F.lit(0)).cast("long").alias("n_notice_lines"))


def op6_license_digests(spark, sf_dir: str) -> DataFrame:
    """The known licences that each whole document, or a whole line of it, states.

    Null and empty texts state none. Repeated rows each get their row, also with a null doc_id; an
    empty table gives no rows. Very long texts are levelled whole; other columns are ignored.
    """
    return scan(shared.table(spark, sf_dir, "documents"))


def oracle() -> str:
    """DuckDB SQL for scan() over documents."""

    def level(text: str) -> str:
        copyright_line = _COPYRIGHT.replace("\n", "\\n")
        out = f"regexp_replace(lower(coalesce({text}, '')), '{copyright_line}', '\\1', 'g')"
        out = f"' ' || regexp_replace(regexp_replace({out}, '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g'), ' ?\\n ?', ' ' || chr(10) || ' ', 'g') || ' '"
        return spell(out)

    def spell(out: str) -> str:
        for one, other in SPELLINGS:
            out = f"replace({out}, ' {one} ', ' {other} ')"
        return out

    def line(level: str) -> str:
        return "trim(" + spell(f"regexp_replace({level}, '[ \\n]+', ' ', 'g')") + ")"

    rows = ", ".join("('{}', '{}')".format(*(v.replace("'", "''") for v in row)) for row in KNOWN)
    digests = ", ".join(str(row) for row in DIGESTS)
    return f"""
    WITH known AS (SELECT min(license) AS license, d FROM (SELECT license, sha256({line(level('text'))}) d FROM (VALUES {rows}) v(license, text) UNION ALL VALUES {digests}) GROUP BY d),
    docs AS (SELECT row_number() OVER () r, CAST(doc_id AS BIGINT) doc_id, {level('text')} AS lev FROM documents),
    whole AS (SELECT r, license FROM docs JOIN known ON sha256({line('lev')}) = d),
    notices AS (SELECT r, license FROM (SELECT r, unnest(string_split(lev, chr(10))) piece FROM docs) JOIN known ON trim(piece) <> '' AND sha256(trim(piece)) = d),
    by_doc AS (SELECT r, string_agg(DISTINCT license, ',' ORDER BY license) notices, count(*) n FROM notices GROUP BY r)
    SELECT docs.doc_id, whole.license, coalesce(by_doc.notices, '') AS notices, coalesce(by_doc.n, 0) AS n_notice_lines
    FROM docs LEFT JOIN whole USING (r) LEFT JOIN by_doc USING (r)"""
