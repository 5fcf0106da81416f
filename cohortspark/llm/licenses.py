"""Licence scans by canonical digests of entire texts, with DataFrame functions only.

Canonical form: lower case; lines that are a copyright notice (with a year or sign) or begin with "all rights reserved" go; every run
of anything but letters and digits becomes one space; equivalent spellings are made one. The SHA-256 of that form is
joined with the digests of known licences: those of KNOWN, each with and without its usual headings and with terms that
are numbered or bulleted, and those of KNOWN_DIGESTS. The known licences are counted first: up to BROADCAST_ROWS are sent to
all tasks, beyond that Spark chooses the join.

Defined results: a null or empty text, or one of which nothing is left, has the digest of the empty form and no
licence; of known licences with one digest the smallest name counts; repeated rows give repeated rows; a null
doc_id is kept; texts of any length are hashed whole; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common

BROADCAST_ROWS = 100_000
NOTICE = r"(?m)^[^a-z0-9\n]*(\(c\)|©|copyright[^\n]*([0-9]{4}|\(c\)|©)|all rights reserved)[^\n]*$"
#: Equivalent spellings (of single words or neighbours); fixed values, after the public matching guidelines for licence texts.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("analyse", "analyze"), ("artefact", "artifact"), ("authorisation", "authorization"), ("authorised", "authorized"),
    ("calibre", "caliber"), ("cancelled", "canceled"), ("capitalisations", "capitalizations"), ("catalogue", "catalog"), ("categorise", "categorize"), ("centre", "center"),
    ("copyright holder", "copyright owner"), ("copyright holders", "copyright owners"), ("emphasised", "emphasized"), ("favour", "favor"), ("favourite", "favorite"), ("fulfil", "fulfill"), ("fulfilment", "fulfillment"),
    ("initialise", "initialize"), ("judgement", "judgment"), ("labelling", "labeling"), ("labour", "labor"), ("licence", "license"), ("licences", "licenses"), ("licenced", "licensed"),
    ("maximise", "maximize"), ("merchantibility", "merchantability"), ("modelled", "modeled"), ("modelling", "modeling"), ("non commercial", "noncommercial"), ("offence", "offense"), ("optimise", "optimize"),
    ("organisation", "organization"), ("organise", "organize"), ("per cent", "percent"), ("practise", "practice"), ("programme", "program"), ("realise", "realize"), ("recognise", "recognize"), ("recognised", "recognized"),
    ("signalling", "signaling"), ("sub license", "sublicense"), ("sub licence", "sublicense"), ("sublicence", "sublicense"), ("utilisation", "utilization"), ("utilise", "utilize"), ("whilst", "while"), ("wilful", "willful"),
)

_MIT_GRANT = 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so'
_MIT_NOTICE = "\n\nThe above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.\n\n"
_MIT_END = 'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE {who} BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.'
_MIT_WHO = _MIT_END.format(who="AUTHORS OR COPYRIGHT HOLDERS")
_AS_IS = 'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.'
_BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:
1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.
2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
"""
_BSD_END = 'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.'
_BSD_NAMES = "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"
_BSD_ADVERTISING = "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the organization.\n" + _BSD_NAMES.replace("3.", "4.")
#: Public licence texts without their headings and notices.
KNOWN = {
    "MIT": _MIT_GRANT + ", subject to the following conditions:" + _MIT_NOTICE + _MIT_WHO,
    "MIT-0": _MIT_GRANT + ".\n\n" + _MIT_WHO,
    "JSON": _MIT_GRANT + ", subject to the following conditions:" + _MIT_NOTICE + "The Software shall be used for Good, not Evil.\n\n" + _MIT_WHO,
    "X11": _MIT_GRANT + ", subject to the following conditions:" + _MIT_NOTICE + _MIT_END.format(who="X CONSORTIUM") + "\n\nExcept as contained in this notice, the name of the X Consortium shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization from the X Consortium.\n\nX Window System is a trademark of X Consortium, Inc.",
    "NCSA": _MIT_GRANT.replace("to deal in the Software", "to deal with the Software") + ", subject to the following conditions:\n\n* Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimers.\n* Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimers in the documentation and/or other materials provided with the distribution.\n* Neither the names of the authors, nor the names of its contributors may be used to endorse or promote products derived from this Software without specific prior written permission.\n\n"
    + _MIT_END.format(who="CONTRIBUTORS OR COPYRIGHT HOLDERS").replace("DEALINGS IN THE", "DEALINGS WITH THE"),
    "ISC": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.\n\n" + _AS_IS,
    "0BSD": "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.\n\n" + _AS_IS,
    "BSD-1-Clause": _BSD_TERMS[: _BSD_TERMS.index("2. ")] + _BSD_END,
    "BSD-2-Clause": _BSD_TERMS + _BSD_END,
    "BSD-3-Clause": _BSD_TERMS + _BSD_NAMES + _BSD_END,
    "BSD-3-Clause-Clear": _BSD_TERMS.replace("are permitted provided", "are permitted (subject to the limitations in the disclaimer below) provided") + _BSD_NAMES + "NO EXPRESS OR IMPLIED LICENSES TO ANY PARTY'S PATENT RIGHTS ARE GRANTED BY THIS LICENSE. " + _BSD_END,
    "BSD-4-Clause": _BSD_TERMS + _BSD_ADVERTISING + _BSD_END,
    "BSL-1.0": """Permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation covered by this license (the "Software") to use, reproduce, display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software, and to permit third-parties to whom the Software is furnished to do so, all subject to the following:

The copyright notices in the Software and this entire statement, including the above license grant, this restriction and the following disclaimer, must be included in all copies of the Software, in whole or in part, and all derivative works of the Software, unless such copies or derivative works are solely in the form of machine-executable object code generated by a source language processor.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE, TITLE AND NON-INFRINGEMENT. IN NO EVENT SHALL THE COPYRIGHT HOLDERS OR ANYONE DISTRIBUTING THE SOFTWARE BE LIABLE FOR ANY DAMAGES OR OTHER LIABILITY, WHETHER IN CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "Unlicense": """This is free and unencumbered software released into the public domain.

Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.

In jurisdictions that recognize copyright laws, the author or authors of this software dedicate any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in perpetuity of all present and future rights to this software under copyright law.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

For more information, please refer to <https://unlicense.org>""",
    "PostgreSQL": """Permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee, and without a written agreement is hereby granted, provided that the above copyright notice and this paragraph and the following two paragraphs appear in all copies.

IN NO EVENT SHALL THE UNIVERSITY OF CALIFORNIA BE LIABLE TO ANY PARTY FOR DIRECT, INDIRECT, SPECIAL, INCIDENTAL, OR CONSEQUENTIAL DAMAGES, INCLUDING LOST PROFITS, ARISING OUT OF THE USE OF THIS SOFTWARE AND ITS DOCUMENTATION, EVEN IF THE UNIVERSITY OF CALIFORNIA HAS BEEN ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.

THE UNIVERSITY OF CALIFORNIA SPECIFICALLY DISCLAIMS ANY WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE. THE SOFTWARE PROVIDED HEREUNDER IS ON AN "AS IS" BASIS, AND THE UNIVERSITY OF CALIFORNIA HAS NO OBLIGATIONS TO PROVIDE MAINTENANCE, SUPPORT, UPDATES, ENHANCEMENTS, OR MODIFICATIONS.""",
    "curl": """Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT OF THIRD PARTY RIGHTS. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.

Except as contained in this notice, the name of a copyright holder shall not be used in advertising or otherwise to promote the sale, use or other dealings in this Software without prior written authorization of the copyright holder.""",
    "FSFAP": "Copying and distribution of this file, with or without modification, are permitted in any medium without royalty provided the copyright notice and this notice are preserved. This file is offered as-is, without any warranty.",
    "FSFULLR": "This file is free software; the Free Software Foundation gives unlimited permission to copy and/or distribute it, with or without modifications, as long as this notice is preserved.",
    "Fair": 'Usage of the works is permitted provided that this instrument is retained with the works, so that any entity that uses the works is notified of this instrument.\n\nDISCLAIMER: THE WORKS ARE WITHOUT WARRANTY.',
    "WTFPL": "Everyone is permitted to copy and distribute verbatim or modified copies of this license document, and changing it is allowed as long as the name is changed.\n\nDO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\nTERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION\n\n0. You just DO WHAT THE FUCK YOU WANT TO.",
    "blessing": "The author disclaims copyright to this source code. In place of a legal notice, here is a blessing:\n\nMay you do good and not evil.\nMay you find forgiveness for yourself and forgive others.\nMay you share freely, never taking more than you give.",
    "NTP": "Permission to use, copy, modify, and distribute this software and its documentation for any purpose with or without fee is hereby granted, provided that the above copyright notice appears in all copies and that both the copyright notice and this permission notice appear in supporting documentation, and that the name of the author not be used in advertising or publicity pertaining to distribution of the software without specific, written prior permission. The author makes no representations about the suitability this software for any purpose. It is provided \"as is\" without express or implied warranty.",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.
2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.
3. This notice may not be removed or altered from any source distribution.""",
}
#: First lines that such texts often have.
HEADINGS = {
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT"), "MIT-0": ("MIT No Attribution", "MIT No Attribution License"), "JSON": ("The JSON License", "JSON License"), "X11": ("X11 License",),
    "NCSA": ("University of Illinois/NCSA Open Source License",), "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"), "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD"), "BSD-1-Clause": ("BSD 1-Clause License",),
    "BSD-2-Clause": ("BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "The BSD 2-Clause License", "BSD License"), "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "BSD License", "New BSD License"),
    "BSD-3-Clause-Clear": ("The Clear BSD License",), "BSD-4-Clause": ('BSD 4-Clause "Original" License', "BSD 4-Clause License"), "BSL-1.0": ("Boost Software License - Version 1.0 - August 17th, 2003",),
    "Unlicense": ("The Unlicense", "Unlicense"), "PostgreSQL": ("PostgreSQL License", "The PostgreSQL License"), "curl": ("COPYRIGHT AND PERMISSION NOTICE",), "Fair": ("Fair License",),
    "WTFPL": ("DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE\nVersion 2, December 2004",), "Zlib": ("zlib License", "The zlib License", "The zlib/libpng License"),
}
#: Digests of the canonical forms of longer public texts: whole, or up to the end of their terms; fixed values.
KNOWN_DIGESTS = (
    ("Apache-2.0", "0e46a6982816aaf9a9b89623a901102ee2121356b3780699508866bf034d006c"),
    ("Apache-2.0", "dc58175012730b621292757e915cc1fa644cb76371e0d543ab1b9d71c90770bf"),
    ("Apache-2.0", "bd9b50a68a290d9ca70875b69f8cea5e1101b30096f9cc6bb91dd712900c41d0"),
    ("Artistic-1.0-Perl", "7ae5717fe75ef6470d98cecef296cdf440da64842be4f8a6d7b886c4712ddd91"),
    ("CC0-1.0", "5caa6b96e2c9f66e9ca02d726096312a8662a9c4fea6446ff24fee66902e58dc"),
    ("GFDL-1.2", "0004c89678a131cd09daefeabc145649999b88c200b99802366660195815714f"),
    ("GFDL-1.3", "d5de84a3e453fafacdc3b6af763d30e2bbdd0d2b753443a1b7cc52e987fd9fc5"),
    ("GPL-1.0", "a833564c9d0fc0d908ecdcf3368dbc72128241e572e23e1d8fa61879f3714803"),
    ("GPL-1.0", "36769e2bb9c8205460a5eed129febfd0ebd59ed51d5ace4e68bb6187f29f9873"),
    ("GPL-1.0", "9391413a0b54c51d39fc51cd392afa28f5fc61140c41533fb7baf3913a5bf18a"),
    ("GPL-2.0", "2ab5f9967e3639dccd59569efa32efb2f55abd063e804e7fb46d77fd3b8d6bbf"),
    ("GPL-2.0", "36b9cbddea2d1efb11bd7a1ffd621106c545a40e067edf989a052c46bf392d4d"),
    ("GPL-2.0", "4d74092119a85921c10670055901ad899fc1c49bc550ca9be494200d612679f2"),
    ("GPL-3.0", "8ff5e4e07c26b18d639f3b4b5cc8cca035e60723552caab14167cfa83152a6ef"),
    ("GPL-3.0", "abeddc4e24d3ff8a5deefdd00bcf803193f456b144c9608b5fb8c15b955e39f9"),
    ("GPL-3.0", "649ccbb81fbf7264d2d798bdea88553112dd17c081ef5faf35482168260f13d8"),
    ("LGPL-2.0", "5a759d66867ebc12f57c6882a5c9963a599538f38ddb9d4499e725ad72be6f49"),
    ("LGPL-2.0", "f71cf989fe60c6917da9cf081789a3f06df1b0b98c1c4686f4e63ba75bf6dabb"),
    ("LGPL-2.0", "239ffc301f5446eca63d5557e63952ff76d90591655c8eb801f8d11fdd55dc8e"),
    ("LGPL-2.1", "1818ef05a2e9ae683f93e4055c6d52e4a7d3bc73f8b0941a3dda6645a212e33e"),
    ("LGPL-2.1", "43cfa5b15405258b5274b8060c4986322655326ff2ac6b602b6459d81d8f9315"),
    ("LGPL-2.1", "f65c47bf7effc3e51a3a7dba6f0144c0c908342afdbee4ee40e44e61be677d7b"),
    ("LGPL-3.0", "572947626844a56d29ace510237040204d4085696621f319533ca366aa897913"),
    ("MPL-1.1", "ef8433b8672e8a1bf29fb65570c8978aef9556a8e290d0ad08ff24a4aa6b8871"),
    ("MPL-1.1", "416055cf35b20f500d200a1b10367d61c9a058fe4dabc43a087940f11c133206"),
    ("MPL-2.0", "1f9b7661552309dc69cee928f7d32ed3280cbc918bfeced108b8b7d3f68f5452"),
    ("MPL-2.0", "ea1cd7ce2d410559107d4bbca2d7eaade4a6ce22fd3a06c1e11a80e2a4f03c5b"),
    ("PSF-2.0", "261baf0f14c4b4cf04d4ddf2aed42391a6e9bfbe396981b77f0fa1e090242380"),
)


def forms(name: str) -> list[str]:
    """A known text with and without its usual headings, its terms numbered or bulleted."""
    text = KNOWN[name]
    bulleted = re.sub(r"(?m)^[0-9]\. ", "* ", text)
    return [f"{h}\n\n{t}" if h else t for h in ("", *HEADINGS.get(name, ())) for t in dict.fromkeys((text, bulleted))]


def canonical_text(text: str) -> str:
    """canonical() of one text in plain Python."""
    out = re.sub(r"[\W_]+", "  ", re.sub(NOTICE, " ", text.lower()))
    out = f" {out} "
    for old, new in SPELLINGS:
        out = out.replace(f" {_spaced(old)} ", f" {_spaced(new)} ")
    return out.strip(" ")


def _spaced(spelling: str) -> str:
    return spelling.replace(" ", "  ")


def canonical(text: Column) -> Column:
    """The canonical form, with a space at both ends of every word."""
    out = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), NOTICE, " ")
    out = F.regexp_replace(out, r"[^\p{L}\p{N}]+", "  ")  # two: one for each of the words beside it
    out = F.concat(F.lit(" "), out, F.lit(" "))
    for old, new in SPELLINGS:
        out = F.replace(out, F.lit(f" {_spaced(old)} "), F.lit(f" {_spaced(new)} "))
    return F.btrim(out, F.lit(" "))


def known_licenses(spark: SparkSession) -> DataFrame:
    """license, text, digest: known texts, or the digests of their canonical forms."""
    rows = [(k, t, None) for k in KNOWN for t in forms(k)] + [(k, None, d) for k, d in KNOWN_DIGESTS]
    return spark.createDataFrame(rows, "license string, text string, digest string")


def scan(docs: DataFrame, known: DataFrame) -> DataFrame:
    """doc_id, digest, license (null if the text is none) of every text; known has license and text, and may have digest."""
    form = canonical(F.col("text"))
    own = F.when(form != "", F.sha2(form, 256))
    digest = F.coalesce("digest", own) if "digest" in known.columns else own
    digests = known.select("license", digest.alias("digest")).where("digest is not null").groupBy("digest").agg(F.min("license").alias("license"))
    digests = F.broadcast(digests) if known.count() <= BROADCAST_ROWS else digests
    return docs.select("doc_id", F.sha2(form, 256).alias("digest")).join(digests, "digest", "left").select("doc_id", "digest", "license")


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(common.table(spark, sf_dir, "documents"), known_licenses(spark))


def _sql() -> str:
    """The documents' side in SQL; the known digests come from canonical_text()."""
    form = f"regexp_replace(regexp_replace(lower(coalesce(text, '')), '{NOTICE}', ' ', 'g'), '[^\\p{{L}}\\p{{N}}]+', '  ', 'g')"
    form = f"' ' || {form} || ' '"
    for old, new in SPELLINGS:
        form = f"replace({form}, ' {_spaced(old)} ', ' {_spaced(new)} ')"
    form = f"trim({form}, ' ')"
    known = [(k, hashlib.sha256(canonical_text(t).encode()).hexdigest()) for k in KNOWN for t in forms(k)] + list(KNOWN_DIGESTS)
    rows = ", ".join(f"('{k}', '{d}')" for k, d in known)
    return f"""
WITH known(license, digest) AS (VALUES {rows}),
k AS (SELECT digest, min(license) AS license FROM known GROUP BY digest),
d AS (SELECT doc_id, sha256({form}) AS digest FROM documents)
SELECT doc_id, d.digest, license FROM d LEFT JOIN k ON d.digest = k.digest
"""


OP5_SQL = _sql()
