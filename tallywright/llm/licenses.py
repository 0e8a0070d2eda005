"""Licence scan by canonical digest, with DataFrame functions only.

A text is put into a canonical form: ASCII letters in lower case, lines that only state a copyright taken out, every run
of ASCII signs and spaces one space, and equivalent spellings, as whole words, made one. The digest of the whole text is
hash-joined to those of known licence texts: the short ones stand here, of the long ones only the digests do, and a caller
can add texts. The table is a constant (some dozen rows), so documents aren't shuffled. In the same pass each line
is compared with the known notices ("Released under the MIT License."), a subject, verb, article and name of a licence.

Defined cases: null and empty texts match nothing and have the digest of an empty text; doc_id may be null and repeat: each
row shows the licence and the notices of its own text; a notice that stands twice counts twice, its licence once; of two
known texts of one form the first counts; a very long text is one row in one task, like any; other columns are ignored,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywright.llm.decontaminate import let

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
COPYRIGHT = r"(?m)^[\x00-\x09\x0B-\x20/*#;-]*(copyright[ \t]*(\(c\)|©|[0-9]{4}|<year>|\[year\])|\(c\)[ \t]|©)[^\n]*$"
SIGNS = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"

# Spellings that mean the same, as (words, words kept).
SPELLINGS = (
    ("licence", "license"),
    ("sub license", "sublicense"),
    ("non commercial", "noncommercial"),
    ("organisation", "organization"),
    ("favour", "favor"),
    ("acknowledgement", "acknowledgment"),
    ("per cent", "percent"),
    ("owner", "holder"),
    ("all rights reserved", ""),
)

# Licence texts, without their copyright lines.
MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
ZERO_BSD = ISC.replace(", provided that the above copyright notice and this permission notice appear in all copies", "")
BSD_START = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
BSD_THIRD = """
3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.
"""
BSD_END = """
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""
ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution."""
UNLICENSE = """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
APACHE_NOTICE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."""

TEXTS = (("MIT", MIT), ("ISC", ISC), ("0BSD", ZERO_BSD), ("BSD-2-Clause", BSD_START + BSD_END), ("BSD-3-Clause", BSD_START + BSD_THIRD + BSD_END), ("Zlib", ZLIB), ("Unlicense", UNLICENSE), ("Apache-2.0", APACHE_NOTICE))
TITLES = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)"),
    "ISC": ("ISC License", "The ISC License"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"),
    "BSD-2-Clause": ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License'),
    "BSD-3-Clause": ("BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License'),
    "Zlib": ("zlib License", "The zlib License"),
    "Unlicense": ("The Unlicense",),
    "Apache-2.0": (),
}
# Names of licences in notices.
NAMES = (
    ("MIT", ("MIT", "MIT License", "MIT-License", "Expat License")),
    ("Apache-2.0", ("Apache License, Version 2.0", "Apache License 2.0", "Apache-2.0", "Apache 2.0", "Apache 2.0 License")),
    ("GPL-2.0", ("GNU General Public License, version 2", "GNU General Public License v2.0", "GNU GPL v2", "GPLv2", "GPL-2.0")),
    ("GPL-3.0", ("GNU General Public License, version 3", "GNU General Public License v3.0", "GNU GPL v3", "GPLv3", "GPL-3.0")),
    ("LGPL-2.1", ("GNU Lesser General Public License, version 2.1", "LGPLv2.1", "LGPL-2.1")),
    ("LGPL-3.0", ("GNU Lesser General Public License, version 3", "LGPLv3", "LGPL-3.0")),
    ("AGPL-3.0", ("GNU Affero General Public License, version 3", "AGPLv3", "AGPL-3.0")),
    ("MPL-2.0", ("Mozilla Public License, version 2.0", "Mozilla Public License 2.0", "MPL 2.0")),
    ("BSD-2-Clause", ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License")),
    ("BSD-3-Clause", ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Revised BSD License")),
    ("ISC", ("ISC License", "ISC")),
    ("Zlib", ("zlib License",)),
    ("Unlicense", ("Unlicense",)),
    ("EPL-2.0", ("Eclipse Public License 2.0", "EPL-2.0")),
    ("BSL-1.0", ("Boost Software License 1.0", "BSL-1.0")),
    ("CC0-1.0", ("CC0 1.0", "CC0", "Creative Commons Zero 1.0")),
    ("CC-BY-4.0", ("CC BY 4.0", "Creative Commons Attribution 4.0 International License")),
    ("CC-BY-SA-4.0", ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0 International License")),
    ("CC-BY-ND-4.0", ("CC BY-ND 4.0", "Creative Commons Attribution-NoDerivatives 4.0 International License")),
    ("CC-BY-NC-4.0", ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0 International License")),
    ("CC-BY-NC-SA-4.0", ("CC BY-NC-SA 4.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License")),
    ("CC-BY-NC-ND-4.0", ("CC BY-NC-ND 4.0", "Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License")),
)
# Digests of the canonical forms of whole licence texts as their stewards publish them.
DIGESTS = (
    ("Apache-2.0", "84ed161685d232dab5187a7a7101279668d583e8fcead2d41433e4fd4a1dbe68"),
    ("Artistic-1.0-Perl", "08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702"),
    ("CC0-1.0", "6e4a79b7eaf2cdc3879a899ef330c98026c9d697ee87d41a28ac5159e8e53348"),
    ("GFDL-1.2", "5379e6f33e826ba185b23fd11a414555c2161fda481478babd1e73a3ae098a71"),
    ("GFDL-1.3", "93d6108daecdddc5f284cf8f2512fb0d72f6e9ee12381feb9704ba194b00c3e6"),
    ("GPL-1.0", "8f586b09c093668e2db772bdcfc1d5dc0b03e0e862fccbff035e1bf134e9b224"),
    ("GPL-2.0", "efe73660e5476cf0368fc0fc143f624ff9d1b73c4484b14a9969dd20c5786821"),
    ("GPL-3.0", "a8cd54d6683aa630f0b8d05d56184ad91dc486756da2df61c94d3e4e8d5ecb68"),
    ("LGPL-2.0", "61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908"),
    ("LGPL-2.1", "4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891"),
    ("LGPL-3.0", "aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be"),
    ("MPL-1.1", "1cfb6cca26abe2169c9c61164807107b2d4a0b64955a2cf2de46fad3483acda1"),
    ("MPL-2.0", "95f6a0d094cf3da6a140310541c7b576789031b600469b70877b34f97918e4c9"),
)
SUBJECTS = ("", "This work is ", "This file is ", "This software is ", "This project is ", "This document is ", "This text is ")
VERBS = ("Licensed under ", "Released under ", "Distributed under ", "Available under ", "Published under ")
ARTICLES = ("", "the ", "a ", "the terms of the ")
SPDX = "SPDX-License-Identifier: "


def known_texts() -> list[tuple[str, str]]:
    return [(k, head + text) for k, text in TEXTS for head in ("", *(t + "\n\n" for t in TITLES[k]))]


def known_notices() -> list[tuple[str, str]]:
    """Every subject, verb and article before every name; and SPDX lines."""
    out = [(k, s + v + a + n) for k, names in NAMES for n in names for s, v, a in product(SUBJECTS, VERBS, ARTICLES)]
    return out + [(k, SPDX + k + end) for k, _ in NAMES for end in ("", "-only", "-or-later")]


def known_names() -> dict[str, str]:
    """Canonical name, or identifier after ``SPDX``, to licence."""
    own = {canonical(n): k for k, names in reversed(NAMES) for n in names}
    return own | {canonical(SPDX + k + end): k for k, _ in NAMES for end in ("", "-only", "-or-later")}


def _beginning() -> str:
    """A notice's words before the name, as a regular expression on canonical words."""
    some = ["|".join(sorted({canonical(x) + " " for x in words if x}, key=len, reverse=True)) for words in (SUBJECTS, VERBS, ARTICLES)]
    return f"^(?:{some[0]})?(?:{some[1]})(?:{some[2]})?"


def canonical_lines(text: Column) -> Column:
    """Lower case, copyright lines out, signs to spaces, one spelling; line ends stay. Each word has a space of its own on either
    side until the spellings are done, so that only whole words are replaced."""
    out = F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER)
    out = F.regexp_replace(out, COPYRIGHT, "")
    out = F.replace(F.regexp_replace(out, SIGNS, "  "), F.lit("\n"), F.lit(" \n "))
    out = F.concat(F.lit(" "), out, F.lit(" "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(_spaced(old)), F.lit(_spaced(new)))
    return F.replace(out, F.lit("  "), F.lit(" "))


def _spaced(words: str) -> str:
    return "".join(f" {w} " for w in words.split())


def _joined(lines: Column) -> Column:
    return F.btrim(F.regexp_replace(lines, "[ \n]+", " "), F.lit(" "))


def canonical_text(text: Column) -> Column:
    return _joined(canonical_lines(text))


def canonical(text: str) -> str:
    """The same for one string; used for the known texts only."""
    out = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    out = " " + re.sub(SIGNS, "  ", re.sub(COPYRIGHT, "", out)).replace("\n", " \n ") + " "
    for old, new in SPELLINGS:
        out = out.replace(_spaced(old), _spaced(new))
    return re.sub("[ \n]+", " ", out).strip(" ")


def digest_of(text: str) -> str:
    return hashlib.sha256(canonical(text).encode()).hexdigest()


def scan(documents: DataFrame, more: list[tuple[str, str]] = ()) -> DataFrame:
    """doc_id, text_sha256 (of the canonical text), license (of a whole text, or null), n_notices, notices (distinct, sorted, comma-joined).
    ``more``: further licence texts as (name, text), some hundred at most."""
    known = {d: k for k, d in reversed([*((k, digest_of(t)) for k, t in [*known_texts(), *more]), *DIGESTS])}
    texts = F.broadcast(documents.sparkSession.createDataFrame(sorted(known.items()), "digest string, license string"))
    names = known_names()
    pairs = F.create_map(*(F.lit(x) for pair in sorted(names.items()) for x in pair))
    longest, beginning = max(len(canonical(t)) for _, t in known_notices()), _beginning()

    def notice(line: Column) -> Column:
        return F.try_element_at(pairs, F.when(line.rlike(beginning), F.regexp_replace(line, beginning, "")).when(line.startswith(canonical(SPDX)), line))

    def read(form: Column) -> Column:
        lines = F.filter(F.transform(F.split(form, "\n"), lambda x: F.btrim(x, F.lit(" "))), lambda x: (F.length(x) > 0) & (F.length(x) <= longest))
        return F.struct(F.sha2(_joined(form), 256).alias("text_sha256"), F.filter(F.transform(lines, notice), lambda x: x.isNotNull()).alias("found"))

    each = documents.select("doc_id", let(canonical_lines(F.col("text")), read).alias("r")).select("doc_id", "r.*")
    named = each.join(texts, F.col("text_sha256") == F.col("digest"), "left")
    return named.select("doc_id", "text_sha256", "license", F.size("found").cast("long").alias("n_notices"), F.array_join(F.array_sort(F.array_distinct("found")), ",").alias("notices"))
