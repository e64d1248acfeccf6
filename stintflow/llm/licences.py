"""Licence scan by canonical digests: texts that differ in case, punctuation, copyright lines or equivalent spellings only have one digest,
and a hash join finds it among those of the known licences. Whole documents are looked up, and each of their lines as a notice.

Built-in functions only. Defined results: a NULL, empty or merely punctuated text has the digest of nothing and matches no licence; repeated rows are looked up
one by one; further columns are ignored.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..sources.shared import stage

# Public licence texts and notices, without their copyright lines.
_PERMISSION_TAIL = """THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF
MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE
SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the
"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish,
distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to
the following conditions:
The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.
""" + _PERMISSION_TAIL
_BSD_TAIL = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT
LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT
LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY
THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF
THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
_BSD_HEAD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions
are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the
documentation and/or other materials provided with the distribution.
"""
_BSD_THIRD = """3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this
software without specific prior written permission.
"""
_ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the
above copyright notice and this permission notice appear in all copies.
"""
_ISC_TAIL = """THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY
DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION,
ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
_ZERO_BSD = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n"
_APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a
copy of the License at http://www.apache.org/licenses/LICENSE-2.0
Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT
WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and
limitations under the License."""
TEXTS = (
    ("MIT", _MIT), ("MIT", "MIT License\n" + _MIT), ("MIT", "The MIT License (MIT)\n" + _MIT),
    ("BSD-2-Clause", _BSD_HEAD + _BSD_TAIL), ("BSD-3-Clause", _BSD_HEAD + _BSD_THIRD + _BSD_TAIL),
    ("ISC", _ISC + _ISC_TAIL), ("ISC", "ISC License\n" + _ISC + _ISC_TAIL), ("0BSD", _ZERO_BSD + _ISC_TAIL), ("Apache-2.0", _APACHE_NOTICE),
    ("MIT", "Released under the MIT License."), ("MIT", "Licensed under the MIT License."), ("MIT", "SPDX-License-Identifier: MIT"),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."), ("Apache-2.0", "Released under the Apache License, Version 2.0."), ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."), ("GPL-3.0", "Licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"), ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("BSD-3-Clause", "Released under the BSD 3-Clause License."), ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"), ("BSD-2-Clause", "Released under the BSD 2-Clause License."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."), ("CC0-1.0", "To the extent possible under law, the author has waived all copyright."),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."), ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."), ("CC-BY-ND-4.0", "Licensed under CC BY-ND 4.0."),
    ("CC-BY-NC-SA-4.0", "Licensed under CC BY-NC-SA 4.0."), ("CC-BY-NC-ND-4.0", "Licensed under CC BY-NC-ND 4.0."),
)
# Digests and first words of whole licence texts too long to be given here, with and without the appendix after the terms; made from the
# published texts by tests/llm/whole_licences.py, and so to be made anew if ``canonical_text`` changes.
WHOLE_TEXTS = (
    ("Apache-2.0", "119e2da0e9ec849d113a40405b338c1bbbd2ef9194c22bf2740fa4e195411c40", "apache"),
    ("Apache-2.0", "288d47ca3f7b819f2580b30ec089cc817c0ed74ae112323f6bed6c84c204649b", "apache"),
    ("Apache-2.0", "74a8f0fd55d55da51bb70b3db2f998cfea47a1f152534ad5b11aa9925c865b86", "apache"),
    ("Apache-2.0", "824065d72ca31b7c727341396be4cf76f464b15d9bef680a3638007ce92a009f", "apache"),
    ("Apache-2.0", "a16e866e11e8209e227639dc3bea1ceb32160e93464ea38b8c8bc94fb846b60f", "apache"),
    ("Apache-2.0", "ef36af97727268b60fb709836c24580bed9887f649dba6f0fd9ef4b18232fd25", "apache"),
    ("Artistic-1.0-Perl", "e963bc30f4d3c45f45030c34409ee37315564625649c1394e32bb5ddd99e01b2", "the"),
    ("BSD-3-Clause", "21ce5e311a0ef74591e636cf6d0a236029bcaa0ee86324ac68d5748657aa8651", "redistribution"),
    ("BSL-1.0", "4242941f56cc0aaf7a416006734167273b17a074704308b941e02a99526671b6", "boost"),
    ("CC0-1.0", "cccf7894e1b9f4ba9f97728bf0c5baf9e07bc2ac93da7a51556451b1fb2b868e", "creative"),
    ("GFDL-1.2", "94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60", "gnu"),
    ("GFDL-1.3", "a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826", "gnu"),
    ("GPL-1.0", "6375a768fd262bf5281905a9585411d2d0fb4ea15cb08cfcba49f73fedb82abc", "gnu"),
    ("GPL-1.0", "89f75ffda938e788be38679f9f83e317c2a03398fccf03ee60505d44d1bf9f70", "gnu"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224", "gnu"),
    ("GPL-2.0", "031ce0347a7bfaa9fea9fb34dc0def0f70d366e9b6aeab50cf9537178d0d9d50", "gnu"),
    ("GPL-2.0", "6d332dc4c3c5293a73c6c9da402f9bbc970b3bb1eb472f577e00580573469808", "gnu"),
    ("GPL-2.0", "aa997bc1c3422ccdc7ccabdc6f9aaa9ce2ebeed7be208887d2b13ff901326c75", "gnu"),
    ("GPL-2.0", "c2eea7a9d82a254e540a96d8107801d93d00bcef2742a78b7e8e8d0c0efcbd1c", "gnu"),
    ("GPL-2.0", "e1270b653c300290e7c039142bccb8776f9b5d14e8a05bc4e87dc7d1614a3b34", "gnu"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821", "gnu"),
    ("GPL-3.0", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191", "gnu"),
    ("GPL-3.0", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636", "gnu"),
    ("GPL-3.0", "eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a", "gnu"),
    ("LGPL-2.0", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2", "gnu"),
    ("LGPL-2.0", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260", "gnu"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908", "gnu"),
    ("LGPL-2.1", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4", "gnu"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891", "gnu"),
    ("LGPL-2.1", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df", "gnu"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be", "gnu"),
    ("MPL-1.1", "a1b36de49a400e3d3385d5987188db954a084f9876243aa7207cd91de3f24a7b", "mozilla"),
    ("MPL-2.0", "f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a", "mozilla"),
    ("Unlicense", "e2380bdfe57ca73b01d0b1848a4ee630998d729b260e63082b9267100b4a7229", "this"),
    ("Zlib", "1b8c5cd52eceb19ab0bc3cb40be110b1c0e7fa2671a3fe5866e59dd1502e69c7", "this"),
    ("Zlib", "99618428d879198d4ae824db7ad07a9d0f9214f15429de52839cbe667713f21a", "zlib"),
)
# Digests of editions with other addresses of the Free Software Foundation, whose texts are not at hand; they find whole documents only,
# and only where no line of the text begins with "copyright" or "(c)" in a sentence (an earlier canonical form left those out).
EARLIER_TEXTS = (
    ("GFDL-1.2", "35cb0454f88cfbae256a58984cf6fb558f773320608bc758cfdf19888c9dbae8"),
    ("GFDL-1.2", "c0957e93af12d2752c167608abfcc306758ec693f13901128772813f486d70be"),
    ("GPL-1.0", "3b2524d27cb227016df68d1515394e8993b4bbf50c77d600de91a4399cb28f90"),
    ("GPL-1.0", "7b86297a2762700b078231c8b488809b0f63cac5e298d74f4270d251bbef230f"),
    ("GPL-1.0", "98c96304603be152968c123e484f744c9b51ebd341914aee6eea5c39133891e1"),
    ("GPL-1.0", "9b80eb3145b87968fde482b384ff47a39c81a9f3f04b7b569a2876c47d7ebdf8"),
    ("GPL-1.0", "ac9f80a0d38a1e001427acb1e9fa5f9a23aee35e40ee2759901306fd4e382697"),
    ("GPL-1.0", "c0734228e33375b72256fed50d8056b50049dff71f408765af98cd4384a7434a"),
    ("GPL-2.0", "204354f4ce2c7d402ca9ad1c08c91b4301b495a0769207c9817a1e1536f3dab2"),
    ("GPL-2.0", "2d5106d375402f83b041785ad1b9925ed45196d448c7db5889cf8d50aece384b"),
    ("GPL-2.0", "2dddfb21baee920dbbc3d75228da3d2104eb54e673ef5f867ab4495e23c974fc"),
    ("GPL-2.0", "33ab1c6a096cf2e568cb5459a5fd96dad29376acb7b66a302e7ae2df2ef1dee8"),
    ("GPL-2.0", "765649880cdff92fe5ac36da2f80c5d70533878beda24dba289f983bd3913453"),
    ("GPL-2.0", "78ad6cb4ffec2339e6a8148b9e96146b4c307451f13f35fc22b5f4defb7afd3e"),
    ("GPL-2.0", "8c1c2994cc30a83607e645d0c7bfe94908618dbc8797ce927cf2fe8ebf674752"),
    ("GPL-2.0", "9bd057847abcffd3f15185fad140e3672c126a542d4849381ab82e33384d56a1"),
    ("GPL-2.0", "c41c3c5e5a1ac7429bff76cf9073f43db9fd2fc7eb1ed462caf35d5cc37c9663"),
    ("GPL-2.0", "c5e89a5ac934ea80b809fc743d9a526b2807c5c4308aeca039c2a0477a73b786"),
    ("GPL-2.0", "d23b02db0ea4788524c1e2555abcb0ca2b2d96c2b500b050847a5a76e3d3ef26"),
    ("GPL-2.0", "dbdc7b0f11c464a75899190d50c2b05f15db170837f89c100c7df949a75b7f47"),
    ("LGPL-2.0", "98ec73996b87246bf4761b08ca7087f0359b8de84b751b918719a1f4bdc08088"),
    ("LGPL-2.0", "b0a4a6e6c3ca3dccdcadb52e460bf216c41c1cbda920e410242396106c9c652b"),
    ("LGPL-2.0", "bfa3d8bc7c76d524eb4af570b918cc149adfa4bf7148c610c09c04eb4d4a29e8"),
    ("LGPL-2.0", "c26be402cc2073c83b528628b34fe49e1b657d94dbe0fd0088d17f6e9bd63983"),
    ("LGPL-2.0", "cf909639258ccf0ffbe7a0c35cab15194c33ccc5122aab7cae1ff4714ea5b6d9"),
    ("LGPL-2.0", "ed33c569ec8e3ad8aa929c8a72391fecc075480aeddbae1458869751511eb14e"),
    ("LGPL-2.1", "0fd99daaa7433e7fcca01fbbebd454bfcc1d89443c34d121231edb64f2052663"),
    ("LGPL-2.1", "8b358153da86e36622209928ad9247dc6d338dbfb5967f871d375390ac81fe2f"),
    ("LGPL-2.1", "bea748897aefc58c30c7fc0735f2df6882a46bc7ce57422440418cc888d3ca15"),
    ("LGPL-2.1", "c98a8c15b31c21caf4b4e075932a916789c46dfcde2e5e7cebcb3172180b2c79"),
    ("LGPL-2.1", "ca8bff9089b5903719c207d33cdaeccf944a3b27f9c8c67712808fcb765e6b92"),
    ("LGPL-2.1", "dc5634a2a8e727fa7d5f07389ecf0963e487b37e83548d12428b1108d5c0be5b"),
)
# Equivalent spellings in canonical text, applied in this order to whole words.
SPELLINGS = (
    ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"), ("sub license", "sublicense"), ("sub licence", "sublicense"), ("https", "http"),
    ("copyright owner", "copyright holder"), ("copyright owners", "copyright holders"), ("non commercial", "noncommercial"), ("non infringement", "noninfringement"),
    ("merchantibility", "merchantability"), ("whilst", "while"), ("per cent", "percent"), ("favour", "favor"), ("organisation", "organization"), ("acknowledgement", "acknowledgment"),
    ("modelled", "modeled"), ("programme", "program"), ("redistribute and use", "redistribution and use"),
)
# Lines that name a holder or a year: a sign, a year or "by" follows the word, or a capitalised holder that is none of the words of a sentence. They are
# taken out of the text as it is written, so a sentence that merely goes on with "copyright" on a new line stays, however it is wrapped.
MARKS = r"[ \t*#/;-]*"
SIGNED = r"(?i:copyright[ \t]*(?:\(c\)|©|&copy;|[,:]?[ \t]*[0-9]{4}|by[ \t])|(?:\(c\)|&copy;)[ \t]*(?:copyright[ \t]*)?[0-9]{4}|©)"
RESERVED = r"(?i:all rights reserved)[ \t\r.]*"
HOLDER = r"Copyright[ \t]+[A-Z]"
SENTENCE = r"Copyright[ \t]+(?:Holder|Owner|Notice|Statement|Law|Licen[cs]e|Act|Permission|Disclaimer|Treaty)"
COPYRIGHT = rf"(^|\n){MARKS}(?:(?:(?!{SENTENCE}){HOLDER}|{SIGNED})[^\n]*|{RESERVED}(?=\n|\Z))"
# The bytes between words, the same for Spark, Python and SQL.
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIRST = r"^[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]*([^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+)"


def canonical(text: Column) -> Column:
    """Lower-case words with a space before and behind each, without copyright lines, in one spelling."""
    text = F.coalesce(text, F.lit(""))
    hint = text.rlike("(?i)copyright|\\(c\\)|©|&copy;|all rights reserved")
    plain = F.translate(F.when(hint, F.regexp_replace(text, COPYRIGHT, "$1")).otherwise(text), UPPER, LOWER)
    spaced = F.concat(F.lit(" "), F.regexp_replace(plain, BETWEEN, "  "), F.lit(" "))
    for spelling, usual in SPELLINGS:
        spaced = F.replace(spaced, F.lit(f" {spelling.replace(' ', '  ')} "), F.lit(f" {usual.replace(' ', '  ')} "))
    return F.trim(F.replace(spaced, F.lit("  "), F.lit(" ")))


def canonical_text(text: str) -> str:
    plain = re.sub(COPYRIGHT, r"\1", text or "").translate(str.maketrans(UPPER, LOWER))
    spaced = " " + re.sub(BETWEEN, "  ", plain) + " "
    for spelling, usual in SPELLINGS:
        spaced = spaced.replace(f" {spelling.replace(' ', '  ')} ", f" {usual.replace(' ', '  ')} ")
    return spaced.replace("  ", " ").strip(" ")


def digest_of(text: str) -> str:
    return hashlib.sha256(canonical_text(text).encode()).hexdigest()


def known_digests() -> dict[str, tuple[str, str | None]]:
    """Licence and first word by digest; the first word is NULL where the text is not at hand."""
    found: dict[str, tuple[str, str | None]] = {digest: (name, None) for name, digest in EARLIER_TEXTS}
    found |= {digest: (name, first) for name, digest, first in WHOLE_TEXTS}
    return found | {digest_of(text): (name, canonical_text(text).split(" ")[0]) for name, text in TEXTS}


def _values() -> str:
    return ", ".join(f"('{d}', '{n}', {'NULL' if f is None else repr(f)})" for d, (n, f) in sorted(known_digests().items()))


def known(spark: SparkSession) -> DataFrame:
    """``digest, licence, first``: one row for each digest of ``TEXTS``, ``WHOLE_TEXTS`` and ``EARLIER_TEXTS``."""
    return spark.sql(f"SELECT digest, licence, CAST(first AS STRING) AS first FROM VALUES {_values()} AS t(digest, licence, first)")


def beginnings(firsts: Iterable[str]) -> list[str]:
    """Every word that may begin a line whose canonical text begins with one of ``firsts``."""
    out = set(firsts)
    for spelling, usual in reversed(SPELLINGS):
        if usual.split(" ")[0] in out:
            out.add(spelling.split(" ")[0])
    return sorted(out)


def scan(docs: DataFrame, licences: DataFrame) -> DataFrame:
    """One row per row of ``docs``: digest of the whole text, the licence it is, and the licences that whole lines of it state.

    ``licences`` (``digest, licence, first``) may have any size; Spark broadcasts it only if it is small. Only its first words, a set of at most
    as many words as languages of law use to begin a text, come to the driver: a line that begins otherwise equals no known text and gets no digest.
    """
    firsts = beginnings(row[0] for row in licences.select("first").where("first IS NOT NULL").distinct().collect())
    texts = stage(docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.sha2(canonical(F.col("text")), 256).alias("digest"),
                              F.filter(F.split(F.coalesce("text", F.lit("")), "\n"), lambda line: F.translate(F.regexp_extract(line, FIRST, 1), UPPER, LOWER).isin(firsts)).alias("lines")))
    stated = texts.where(F.size("lines") > 0).select("row", F.explode(F.array_distinct("lines")).alias("line")).select("row", F.sha2(canonical(F.col("line")), 256).alias("line")) \
        .join(licences.where("first IS NOT NULL").select(F.col("digest").alias("line"), F.col("licence").alias("notice")), "line") \
        .groupBy("row").agg(F.array_sort(F.collect_set("notice")).alias("found"))
    return texts.join(stated, "row", "left").join(licences.drop("first"), "digest", "left").select(
        "doc_id", "digest", "licence", F.coalesce(F.array_join("found", ","), F.lit("")).alias("notices"),
        F.coalesce(F.size("found"), F.lit(0)).cast("long").alias("n_notices"))


def statement() -> str:
    """The scan in SQL, on the table ``documents``: copyright lines are left out line by line."""
    def sql_canonical(text: str) -> str:
        named = f"(regexp_matches(x, '^{MARKS}{HOLDER}') AND NOT regexp_matches(x, '^{MARKS}{SENTENCE}')) OR regexp_matches(x, '^{MARKS}{SIGNED}') OR regexp_matches(x, '^{MARKS}{RESERVED}$')"
        kept = f"array_to_string(list_filter(string_split(coalesce({text}, ''), chr(10)), lambda x: NOT ({named})), chr(10))"
        out = f"' ' || regexp_replace(translate({kept}, '{UPPER}', '{LOWER}'), '{BETWEEN}', '  ', 'g') || ' '"
        for spelling, usual in SPELLINGS:
            out = f"replace({out}, ' {spelling.replace(' ', '  ')} ', ' {usual.replace(' ', '  ')} ')"
        return f"sha256(trim(regexp_replace({out}, ' +', ' ', 'g'), ' '))"
    return f"""
WITH known(digest, licence, first) AS (VALUES {_values()}),
numbered AS (SELECT row_number() OVER () AS r, doc_id, text, {sql_canonical('text')} AS digest FROM documents),
lines AS (SELECT r, {sql_canonical('line')} AS digest FROM (SELECT r, unnest(string_split(coalesce(text, ''), chr(10))) AS line FROM numbered)),
stated AS (SELECT r, string_agg(DISTINCT licence, ',' ORDER BY licence) AS notices, count(DISTINCT licence) AS n FROM lines JOIN known USING (digest) WHERE first IS NOT NULL GROUP BY r)
SELECT doc_id, numbered.digest, licence, coalesce(notices, '') AS notices, coalesce(n, 0) AS n_notices
FROM numbered LEFT JOIN stated USING (r) LEFT JOIN known ON known.digest = numbered.digest"""
