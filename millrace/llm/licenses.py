"""Licence scan by sentences and rules, with DataFrame functions only.

Sentences are normalised and mapped to identifiers of known licence sentences. The sequence of
identifiers is then matched against ordered rules: the first rule that finds its sequence takes those
identifiers, and the later rules see what is left.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# How texts refer to a licence, names of licences, and sentences of licence texts.
REFERRING = (
    "licensed under", "released under", "distributed under", "available under", "this work is licensed under",
    "this project is licensed under", "this software is licensed under", "this file is licensed under", "published under",
)
NAMES = {
    "MIT": ("the mit license", "the mit licence", "mit"),
    "Apache-2.0": ("the apache license version 2.0", "the apache license 2.0", "apache 2.0"),
    "GPL-2.0": ("the gnu general public license version 2", "the gpl v2", "gpl 2.0"),
    "GPL-3.0": ("the gnu general public license version 3", "the gpl v3", "gpl 3.0"),
    "LGPL-2.1": ("the gnu lesser general public license version 2.1",),
    "LGPL-3.0": ("the gnu lesser general public license version 3",),
    "AGPL-3.0": ("the gnu affero general public license version 3",),
    "MPL-2.0": ("the mozilla public license version 2.0",),
    "BSD-2-Clause": ("the bsd 2 clause license",),
    "BSD-3-Clause": ("the bsd 3 clause license", "the bsd license"),
    "ISC": ("the isc license",),
    "Unlicense": ("the unlicense",),
    "CC-BY-4.0": ("cc by 4.0", "the creative commons attribution 4.0 international license"),
    "CC-BY-SA-4.0": ("cc by sa 4.0",),
    "CC-BY-NC-4.0": ("cc by nc 4.0",),
    "CC-BY-ND-4.0": ("cc by nd 4.0",),
    "CC-BY-NC-SA-4.0": ("cc by nc sa 4.0",),
    "CC0-1.0": ("cc0 1.0", "cc0"),
}
SENTENCES = {
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "isc-grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "as-is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "apache-comply": "you may not use this file except in compliance with the license",
    "apache-obtain": "you may obtain a copy of the license at",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose",
    "apache-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-see": "see the license for the specific language governing permissions and limitations under the license",
    "bsd-as-is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "isc-as-is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    "gnu-implied": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "public-domain": "this is free and unencumbered software released into the public domain",
}
#: GNU licences by their word in the header and the versions that headers name.
GNU = {"GPL": ("general", ("2", "3")), "LGPL": ("lesser general", ("2.1", "3")), "AGPL": ("affero general", ("3",))}
GNU_VERSIONS = {"2": "2.0", "2.1": "2.1", "3": "3.0"}
LATER = "either version {} of the license or at your option any later version"
HOLDERS = ("copyright holder", "copyright holders", "copyright owner", "author", "authors", "organization", "university", "project")
#: Identifiers that an SPDX line may give.
SPDX = (*NAMES, *(f"{name}-{v}-{how}" for name, (_, versions) in GNU.items() for v in map(GNU_VERSIONS.get, versions) for how in ("only", "or-later")))
#: Every known sentence holds one of these as a whole word. A word stays whole in any spacing and markup, so a text without any needs no splitting.
SIGNS = ("under", "permission", "warranty", "warranties", "redistribution", "redistributions", "license", "domain", "free", "mpl")


def gnu_rules() -> list[tuple[str, tuple[str, ...]]]:
    """The notices of GNU headers: the version in the sentence of the terms or in one of its own (GPL 2, LGPL 2.1)."""
    out = []
    for name, (_, versions) in GNU.items():
        for v in versions:
            for terms in ((f"{name.lower()}-terms-{v}",), (f"{name.lower()}-terms", f"later-{v}")):
                for ids in (("gnu-free", *terms, "gnu-hope", "gnu-implied"), ("gnu-free", *terms), terms):
                    out.append((f"{name}-{GNU_VERSIONS[v]}-or-later", ids))
    return sorted(out, key=lambda rule: -len(rule[1]))


BSD = ("bsd-grant", "bsd-source", "bsd-binary")
APACHE = ("ref-Apache-2.0", "apache-comply", "apache-obtain")
#: Ordered: a rule that needs more sentences stands before those that need fewer.
RULES = (
    ("MIT", ("mit-grant", "mit-notice", "as-is")), ("MIT", ("mit-grant", "mit-notice")),
    ("ISC", ("isc-grant", "isc-as-is")), ("ISC", ("isc-grant", "as-is")), ("ISC", ("isc-grant",)),
    ("BSD-3-Clause", (*BSD, "bsd-endorse", "bsd-as-is")), ("BSD-3-Clause", (*BSD, "bsd-endorse")),
    ("BSD-2-Clause", (*BSD, "bsd-as-is")), ("BSD-2-Clause", BSD),
    ("Apache-2.0", (*APACHE, "apache-as-is", "apache-see")), ("Apache-2.0", APACHE),
    ("GPL-3.0-or-later", ("gpl-free", "gpl-hope")), ("GPL-3.0-or-later", ("gpl-free",)), *gnu_rules(),
    ("MPL-2.0", ("mpl-terms", "mpl-obtain")), ("MPL-2.0", ("mpl-terms",)), ("Unlicense", ("public-domain",)),
    *((name, (f"ref-{name}",)) for name in SPDX),
)


def known_sentences() -> dict[str, str]:
    """Identifier of each known sentence in its normal form."""
    known = {f"{how} {name}": f"ref-{licence}" for licence, names in NAMES.items() for name in names for how in REFERRING}
    known |= {f"{how} the apache license version 2.0 the license": "ref-Apache-2.0" for how in REFERRING}
    for name in SPDX:
        known[f"spdx license identifier {name.lower().replace('-', ' ')}"] = f"ref-{name}"
    for name, (word, versions) in GNU.items():
        terms = f"you can redistribute it and or modify it under the terms of the gnu {word} public license as published by the free software foundation"
        known[terms] = f"{name.lower()}-terms"
        for v in versions:
            known |= {f"{terms} {LATER.format(v)}": f"{name.lower()}-terms-{v}", LATER.format(v): f"later-{v}"}
    for what in ("program", "library", "file"):
        known |= {f"this {what} is free software": "gnu-free", f"this {what} is distributed in the hope that it will be useful but without any warranty": "gnu-hope"}
    for url in ("http www.apache.org licenses license 2.0", "https www.apache.org licenses license 2.0"):
        # where comment signs fill the blank lines, the sentences around the address are one
        known |= {f"{SENTENCES['apache-obtain']} {url}": "apache-obtain", f"{SENTENCES['apache-obtain']} {url} {SENTENCES['apache-as-is']}": "apache-obtain"}
    for version in ("v", "v.2.0", "version 2.0"):
        known[f"this source code form is subject to the terms of the mozilla public license {version}"] = "mpl-terms"
    for url in ("http mozilla.org mpl 2.0", "https mozilla.org mpl 2.0"):
        known[f"if a copy of the mpl was not distributed with this file you can obtain one at {url}"] = "mpl-obtain"
    endorse = "may be used to endorse or promote products derived from this software without specific prior written permission"
    for holder in HOLDERS:
        known |= {f"neither the name of the {holder} nor the names of its contributors {endorse}": "bsd-endorse", f"neither the name of {holder} nor the names of its contributors {endorse}": "bsd-endorse"}
    known |= {f"nor the names of its contributors {endorse}": "bsd-endorse", f"the name of the author {endorse.replace('may be', 'may not be')}": "bsd-endorse"}
    return known | {sentence: key for key, sentence in SENTENCES.items()}


#: Patterns that Java's and other engines read alike: where sentences end, what is no part of the normal form.
ENDS, NOISE = r"[.!?:;]+\s|[.!?:;]+$|[\n\r]+", r"[^a-z0-9.]+"
WRAPPED = r"[.!?:;]+\s|[.!?:;]+$|\n\s*\n"
#: An SPDX line is one sentence, though a space follows its colon.
SPDX_GAP = r"(SPDX-License-Identifier:)[ \t]+"


def normal(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), NOISE, " "))


def identified(text: Column, ends: str, table: Column) -> Column:
    ids = F.transform(F.split(text, ends), lambda s: F.element_at(table, normal(s)))
    return F.filter(ids, lambda x: x.isNotNull())


def scan(df: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: doc_id, n_sentences (known ones), sentence_ids in order, licences (sorted, joined), n_unmatched.

    A sentence may stand in one line or be wrapped over several; the reading that knows more sentences
    counts. Null and empty texts have none: counts 0, the texts empty. Rows that repeat stay.
    """
    table = F.create_map(*[F.lit(x) for x in chain.from_iterable(known_sentences().items())])
    own = df.selectExpr(f"cast(`{doc_id}` as bigint) as doc_id", f"coalesce(`{text}`, '') as text")
    low = F.lower("text")
    likely = low.contains(SIGNS[0])
    for sign in SIGNS[1:]:
        likely = likely | low.contains(sign)
    none = F.expr("cast(array() as array<string>)")
    whole = F.regexp_replace("text", SPDX_GAP, "$1")
    lines, wrapped = identified(whole, ENDS, table), identified(whole, WRAPPED, table)
    found = own.select("doc_id", F.when(likely, F.struct(lines.alias("a"), wrapped.alias("b"))).alias("x"))
    best = F.when(F.col("x").isNull(), none).when(F.size("x.b") > F.size("x.a"), F.col("x.b")).otherwise(F.col("x.a"))
    found = found.select("doc_id", best.alias("ids"))
    rules = F.array(*[F.struct(F.lit(name).alias("licence"), F.lit("".join(f"|{i}|" for i in ids)).alias("sought")) for name, ids in RULES])

    def step(done, rule):
        here = done["left"].contains(rule["sought"])
        return F.struct(
            F.replace(done["left"], rule["sought"], F.lit("")).alias("left"),
            F.when(here, F.array_union(done["licences"], F.array(rule["licence"]))).otherwise(done["licences"]).alias("licences"),
        )

    sequence = F.array_join(F.transform("ids", lambda i: F.concat(F.lit("|"), i, F.lit("|"))), "")
    start = F.struct(sequence.alias("left"), none.alias("licences"))
    matched = found.withColumn("m", F.when(F.size("ids") > 0, F.aggregate(rules, start, step)).otherwise(start))
    return matched.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_sentences"), F.array_join("ids", ",").alias("sentence_ids"),
        F.array_join(F.array_sort("m.licences"), ",").alias("licences"),
        F.expr("cast((length(m.left) - length(replace(m.left, '|', ''))) / 2 as bigint)").alias("n_unmatched"),
    )
