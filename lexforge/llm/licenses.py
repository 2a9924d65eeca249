"""License scans by canonical digest (operator 7).

A text is reduced to a canonical form (case, punctuation, copyright lines, equivalent
spellings, white space), and the SHA-256 of the whole form is joined with the digests of known
licences. The same is done for each line of a document, for the short notices that stand
on a line of their own. All expressions are built in.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Spellings that licence texts use alike, left to right.
SPELLINGS = {
    "acknowledgement": "acknowledgment", "analogue": "analog", "analyse": "analyze", "artefact": "artifact", "authorisation": "authorization",
    "authorised": "authorized", "calibre": "caliber", "cancelled": "canceled", "capitalisations": "capitalizations", "catalogue": "catalog",
    "categorise": "categorize", "centre": "center", "copyright owner": "copyright holder", "favour": "favor", "favourite": "favorite", "fulfil": "fulfill",
    "fulfilment": "fulfillment", "https": "http", "judgement": "judgment", "labelling": "labeling", "labour": "labor", "licence": "license",
    "licenced": "licensed", "licences": "licenses", "maximise": "maximize", "modelled": "modeled", "modelling": "modeling", "noncommercial": "non commercial",
    "offence": "offense", "optimise": "optimize", "organisation": "organization", "organise": "organize", "per cent": "percent", "practise": "practice",
    "programme": "program", "realise": "realize", "recognise": "recognize", "signalling": "signaling", "sub license": "sublicense", "sublicence": "sublicense",
    "utilisation": "utilization", "whilst": "while", "wilful": "wilfull",
}

#: Whole licence texts.
TEXTS = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.""",
    "ISC": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "0BSD": """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.""",
    "BSD-2-Clause": """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.""",
    "Zlib": """This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any damages arising from the use of this software.

Permission is granted to anyone to use this software for any purpose, including commercial applications, and to alter it and redistribute it freely, subject to the following restrictions:

1. The origin of this software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a product, an acknowledgment in the product documentation would be appreciated but is not required.

2. Altered source versions must be plainly marked as such, and must not be misrepresented as being the original software.

3. This notice may not be removed or altered from any source distribution.""",
}
TEXTS["BSD-3-Clause"] = TEXTS["BSD-2-Clause"].replace(
    "\n\nTHIS SOFTWARE IS PROVIDED",
    "\n\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n\nTHIS SOFTWARE IS PROVIDED",
)
TEXTS["MIT-0"] = "\n\n".join(p.removesuffix(", subject to the following conditions:") + "." * p.endswith("conditions:") for p in TEXTS["MIT"].split("\n\n") if not p.startswith("The above copyright"))

#: The names that a notice may give a licence.
NAMES = {
    "MIT": ("MIT License", "MIT"), "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU General Public License v3.0", "GPLv3"), "GPL-2.0": ("GNU General Public License, version 2", "GPLv2"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "LGPLv3"), "AGPL-3.0": ("GNU Affero General Public License, version 3", "AGPLv3"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "MPL 2.0"), "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License"), "ISC": ("ISC License",), "CC0-1.0": ("CC0 1.0", "CC0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0 International License"), "CC-BY-SA-4.0": ("CC BY-SA 4.0",),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0",), "CC-BY-ND-4.0": ("CC BY-ND 4.0",), "CC-BY-NC-SA-4.0": ("CC BY-NC-SA 4.0",), "CC-BY-NC-ND-4.0": ("CC BY-NC-ND 4.0",),
}
#: The sentences of a notice.
SENTENCES = (
    "Licensed under {0}.", "Licensed under the {0}.", "Released under {0}.", "Released under the {0}.", "Distributed under the {0}.",
    "This work is licensed under {0}.", "This work is licensed under the {0}.", "This work is licensed under a {0}.",
    "This file is licensed under the {0}.", "This software is licensed under the {0}.", "This project is licensed under the {0}.",
)
#: The titles that a file may put above a whole text.
TITLES = {
    "MIT": ("MIT License", "The MIT License", "MIT License (MIT)", "The MIT License (MIT)"), "ISC": ("ISC License", "The ISC License", "ISC License (ISC)", "The ISC License (ISC)"),
    "0BSD": ("BSD Zero Clause License", "Zero-Clause BSD License", "Zero-Clause BSD", "BSD Zero Clause License (0BSD)"),
    "BSD-2-Clause": ("BSD 2-Clause License", "The 2-Clause BSD License", "The BSD 2-Clause License", 'BSD 2-Clause "Simplified" License', "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The 3-Clause BSD License", "The BSD 3-Clause License", 'BSD 3-Clause "New" or "Revised" License', "New BSD License", "Modified BSD License"),
    "Zlib": ("zlib License", "The zlib License", "zlib/libpng License", "The zlib/libpng License"), "MIT-0": ("MIT No Attribution", "MIT No Attribution License", "MIT-0"),
}
#: Prose that speaks of copyright, as a wrapped line may begin with it; no holder is named so.
PROSE = "notices?|holders?|owners?|statements?|laws?|licen[sc]es?|permissions?|protections?|interests?|rights?|and|or|in|on|of|to|is|as|act"
#: A line of its own that names a holder or a year after the word: a mark, a year, or a capitalised name. Prose that a line break puts there stays, and so do the points (c) of a list.
COPYRIGHT_LINE = (
    r"(?m)^[\x20\t]*((?i:copyright)[\x20\t:,]*((?i:\(c\)|©|&copy;|\(r\)|®)|(?i:by[\x20\t])|[12][0-9]{3}\b|<year>|\[year\])"
    rf"|[Cc]opyright:?[\x20\t]+(?!(?i:{PROSE})\b)\p{{Lu}}"
    r"|(?i:\(c\)[\x20\t,]*(copyright|[12][0-9]{3}\b|<year>|\[year\])|©|all rights reserved))[^\n]*"
)


#: Digests of the canonical forms of long licences: the whole file as published, without what follows the terms, and the terms alone.
DIGESTS = {
    "Apache-2.0": ("6074c3536c43b739207170b87d1681477d0f07374ed3d862ba461334cce848e3", "f70a2718f78121f2da77cd6afbffffbd668d7c1fd36c85a3ef121e83cb5f48fe", "6aa661403864282a4d084f1551e8149a5f1a7b5e8b05b6db8e1a8a28d0badc64"),
    "Artistic-1.0-Perl": ("08f1dc258c8f9e175155356aa1dd0dead8cfdec586bc1bb4c8b1452699a91702",),
    "CC0-1.0": ("96bdc7f63190fb4bd1ae584b890300ed7517d858b34c945642a3b9b2f1612a5f",),
    "GFDL-1.2": ("94541e73869af10ab6bd68a29575eede324e54e7d5237e7386d12444f593af60",),
    "GFDL-1.3": ("a92fdbaeafedd9cbeb812ebbded06ee07e3b1427c81cfc333e682109c594d826",),
    "GPL-1.0": ("ec8a6b7d70e9f225b63d3962ed5b4721373f5535d7b967a06722b0d621f6892a", "74d0cd23803c9754c36f6ca0e1af411b418ed6b6564e757472bf0d870a1b5d1b", "af30c0af27b90ec812acdb040f3dcc944a87cd893456690efe35063f39e3eeeb"),
    "GPL-2.0": ("331b500eb3c5ee796906547305df82fff4a35b3aa03c1d3ea84d32078292b2e6", "1551b61aa183f987ecceedd8966ec1e9b2da3848f8862c2adedc0d82f41904ca", "c67cc53030ae25fe2e2f0143b59060eca5ad89da8d2beca1445641234d29fc88"),
    "GPL-3.0": ("eaab5d82fdcca441d83a1913bbf07e4de3a739e190578c0bffde24f84e93bb2a", "ac6b52d57c0104e687039148f7b8e370e04c9bb5705bb786f8ef814eb65e8636", "092a7f3b82e6c22949b46388bca99e725b6e756f1c2b1e3f575447fbd44b6191"),
    "LGPL-2.0": ("61af4dcea4e412e8ccfb8877fd2762bd6d962f8d42a9fa2c06cf7b4613f2c908", "504542bce5421b0f5a7e63ddb55443ccb300b27a65ba6bfc1370fed16a3af260", "430627da7218a92ab4a6d75d5140cdb70ee750be7a53f913299b37e0d1b0eea2"),
    "LGPL-2.1": ("4d55922bdeafabde164d75448bbfb0b474bf952bbb541325364010900acd9891", "48d2010e70a815a564f914b0c7c1e80d7a6843793348fed3684c957112fe0aa4", "bf2f0c6bf1c47b3b1e3cbedeefecddd1e7db21d1919858d45c2f918efaf426df"),
    "LGPL-3.0": ("aae2b222477171fb64e298e7965e768a9a6f85320646b266c94399ac029d42be",),
    "MPL-1.1": ("a1b36de49a400e3d3385d5987188db954a084f9876243aa7207cd91de3f24a7b",),
    "MPL-2.0": ("f82071285728ca3ec7685ee9bc4acdae0b8267142a4d20b8f1805eabedb4a98a",),
}


def known_texts() -> list[tuple[str, str, str]]:
    """(licence, kind, text) of all known texts and notices; a list fixed in this file."""
    whole = [(name, "text", text) for name, text in TEXTS.items()]
    whole += [(name, "text", f"{title}\n\n{TEXTS[name]}") for name, titles in TITLES.items() for title in titles]
    notices = {(s.format(n), name) for name, names in NAMES.items() for n in names for s in SENTENCES}
    return whole + [(name, "notice", text) for text, name in sorted(notices)]


def canonical_lines(text: Column) -> Column:
    """The canonical form with its line breaks."""
    text = F.lower(F.regexp_replace(text, COPYRIGHT_LINE, ""))
    text = F.regexp_replace(text, r"[^\p{L}\p{N}\n]+", " ")
    plain = text
    for old, new in SPELLINGS.items():
        plain = F.regexp_replace(plain, rf"\b{old}\b", new)
    return F.when(text.rlike(r"\b(" + "|".join(SPELLINGS) + r")\b"), plain).otherwise(text)


def canonical_text(lines: Column) -> Column:
    """All lines as one; spellings of two words also where a line break stood between them."""
    out = F.trim(F.regexp_replace(lines, r"[ \n]+", " "))
    for old, new in SPELLINGS.items():
        out = F.regexp_replace(out, rf"\b{old}\b", new) if " " in old else out
    return out


def _digest(x: Column) -> Column:
    return F.sha2(x.cast("binary"), 256)


def known_digests(spark: SparkSession) -> DataFrame:
    """(digest, license, kind) of the known texts, canonicalised by the same expressions, and of the long licences."""
    known = spark.createDataFrame(known_texts(), "license string, kind string, text string")
    long = spark.createDataFrame([(d, name, "text") for name, own in DIGESTS.items() for d in own], "digest string, license string, kind string")
    return known.select(_digest(canonical_text(canonical_lines(F.col("text")))).alias("digest"), "license", "kind").union(long)


def scan_licenses(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, digest of the canonical whole text, license (of a whole text, else null), n_notices, notices.

    `notices` lists the licences that lines of the text name, sorted, each once;
    `n_notices` counts those lines. Null texts have a null digest and no license or notice; texts
    without a letter or digit have the digest of the empty form, which no licence has. Of licences that share a
    form the first by name is told. Repeated rows are each reported, an empty table gives an empty result, texts
    of any length are read whole, and other columns are not read.
    """
    spark = docs.sparkSession
    known = [tuple(r) for r in known_digests(spark).collect()]  # as many as this file lists
    # A licence comes once for each digest, the first by name.
    whole = {d: name for d, name, _ in sorted(known, reverse=True)}
    table = spark.createDataFrame(list(whole.items()), "digest string, license string")
    lines = docs.select(F.col(key).alias(key), canonical_lines(F.col(text)).alias("lines"))
    of_line = F.create_map(*(F.lit(x) for pair in whole.items() for x in pair))
    short = max(len(t) for _, kind, t in known_texts() if kind == "notice")
    hits = F.filter(
        F.transform(F.filter(F.transform(F.split("lines", "\n"), lambda x: F.trim(x)), lambda x: F.char_length(x).between(1, short)), _digest),
        lambda d: d.isin(*(d for d, _, kind in known if kind == "notice")),
    )
    found = lines.select(key, _digest(canonical_text(F.col("lines"))).alias("digest"), F.coalesce(hits, F.array().cast("array<string>")).alias("hits"))
    names = F.array_sort(F.array_distinct(F.transform("hits", lambda d: F.element_at(of_line, d))))
    return found.join(F.broadcast(table), "digest", "left").select(
        key, "digest", "license", F.size("hits").cast("long").alias("n_notices"), names.alias("notices"),
    )
