"""Licence recognition: known sentences become identifiers, and rules are matched against their order."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyboard.llm.common import text_or_empty


@dataclass(frozen=True)
class LicenceRule:
    """A licence is recognised where these sentences follow each other, others not among the known ones between them."""

    licence: str
    sentences: tuple[str, ...]


# Sentences of published licence notices in normal form, by identifier.
SENTENCES = {
    # Apache
    "apache2_grant": "licensed under the apache license version 2 0 the license",
    "apache2_use": "you may not use this file except in compliance with the license",
    "apache2_copy": "you may obtain a copy of the license at",
    "apache2_basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache2_basis_short": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
    "apache2_see": "see the license for the specific language governing permissions and limitations under the license",
    "apache2_ref": "licensed under the apache license version 2 0",
    "apache2_ref_work": "this work is licensed under the apache license version 2 0",
    "apache2_ref_file": "this file is licensed under the apache license version 2 0",
    # MIT
    "mit_grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions",
    "mit_grant_short": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files",
    "mit_notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit_as_is": "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement",
    "as_is": "the software is provided as is without warranty of any kind",
    "mit_no_event": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "mit_ref": "released under the mit license",
    "mit_ref2": "licensed under the mit license",
    "mit_ref_project": "this project is licensed under the mit license",
    "mit_ref_work": "this work is licensed under the mit license",
    # BSD
    "bsd_redistribute": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd_source": "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer",
    "bsd_source_short": "redistributions of source code must retain the above copyright notice",
    "bsd_binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution",
    "bsd_binary_short": "redistributions in binary form must reproduce the above copyright notice",
    "bsd_endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd_as_is": "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd_ref": "licensed under the bsd license",
    # ISC
    "isc_grant": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc_as_is": "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness",
    # GNU
    "gpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "lgpl_free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "agpl_free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl_free_start": "this program is free software",
    "lgpl_free_start": "this library is free software",
    "gpl_terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl3_terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "gpl2_terms": "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version",
    "agpl3_terms": "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version",
    "lgpl21_terms": "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version",
    "gpl_later": "either version 3 of the license or at your option any later version",
    "gpl2_later": "either version 2 of the license or at your option any later version",
    "gpl_warranty": "this program is distributed in the hope that it will be useful but without any warranty",
    "gpl_implied": "without even the implied warranty of merchantability or fitness for a particular purpose",
    "gpl3_ref": "this work is licensed under the gnu general public license version 3",
    "gpl3_ref2": "licensed under the gnu general public license version 3",
    "gpl2_ref": "licensed under the gnu general public license version 2",
    # Mozilla
    "mpl2_ref": "this source code form is subject to the terms of the mozilla public license v 2 0",
    "mpl2_copy": "if a copy of the mpl was not distributed with this file you can obtain one at",
    # Creative Commons
    "ccbync4_ref": "licensed under cc by nc 4 0",
    "ccby4_ref": "licensed under cc by 4 0",
    "ccbysa4_ref": "licensed under cc by sa 4 0",
    "ccby4_work": "this work is licensed under a creative commons attribution 4 0 international license",
    "ccbysa4_work": "this work is licensed under a creative commons attribution sharealike 4 0 international license",
    "ccbync4_work": "this work is licensed under a creative commons attribution noncommercial 4 0 international license",
    # Others
    "unlicense_free": "this is free and unencumbered software released into the public domain",
    "all_rights": "all rights reserved",
}

# Identifiers of the SPDX list, and the licence names used here where those differ.
SPDX = {name: name for name in (
    "MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "MPL-2.0", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0",
    "CC-BY-NC-4.0", "0BSD", "Zlib", "BSL-1.0", "EPL-2.0",
)} | {
    "GPL-3.0-only": "GPL-3.0", "GPL-3.0-or-later": "GPL-3.0", "GPL-3.0": "GPL-3.0", "GPL-3.0+": "GPL-3.0",
    "GPL-2.0-only": "GPL-2.0", "GPL-2.0-or-later": "GPL-2.0", "GPL-2.0": "GPL-2.0", "GPL-2.0+": "GPL-2.0",
    "LGPL-2.1-only": "LGPL-2.1", "LGPL-2.1-or-later": "LGPL-2.1", "LGPL-2.1": "LGPL-2.1",
    "AGPL-3.0-only": "AGPL-3.0", "AGPL-3.0-or-later": "AGPL-3.0", "AGPL-3.0": "AGPL-3.0",
}


def normal_form(sentence: str) -> str:
    """A sentence as the expressions below write it."""
    return re.sub(r"[^a-z0-9]+", " ", sentence.lower()).strip()


# "GPL-3.0" and "GPL-3.0+" have one normal form.
_SPDX_SAID = {normal_form(f"SPDX-License-Identifier {name}"): licence for name, licence in SPDX.items()}
_SPDX_IDS = {said: "spdx_" + said.removeprefix("spdx license identifier ").replace(" ", "_") for said in _SPDX_SAID}
SENTENCES |= {name: said for said, name in _SPDX_IDS.items()}

RULES = (
    LicenceRule("Apache-2.0", ("apache2_grant", "apache2_use", "apache2_copy", "apache2_basis")),
    LicenceRule("Apache-2.0", ("apache2_grant", "apache2_use", "apache2_copy", "apache2_basis_short")),
    *[LicenceRule("Apache-2.0", (name,)) for name in ("apache2_ref", "apache2_ref_work", "apache2_ref_file")],
    LicenceRule("MIT", ("mit_grant", "mit_notice", "mit_as_is")),
    LicenceRule("MIT", ("mit_grant_short", "mit_notice", "as_is")),
    *[LicenceRule("MIT", (name,)) for name in ("mit_ref", "mit_ref2", "mit_ref_project", "mit_ref_work")],
    LicenceRule("AGPL-3.0", ("agpl_free",)),
    LicenceRule("AGPL-3.0", ("gpl_free_start", "agpl3_terms")),
    LicenceRule("LGPL-2.1", ("lgpl_free",)),
    LicenceRule("LGPL-2.1", ("lgpl_free_start", "lgpl21_terms")),
    LicenceRule("GPL-3.0", ("gpl_free",)),
    LicenceRule("GPL-3.0", ("gpl_free_start", "gpl3_terms")),
    LicenceRule("GPL-3.0", ("gpl_free_start", "gpl_terms", "gpl_later")),
    *[LicenceRule("GPL-3.0", (name,)) for name in ("gpl3_ref", "gpl3_ref2")],
    LicenceRule("GPL-2.0", ("gpl2_free",)),
    LicenceRule("GPL-2.0", ("gpl_free_start", "gpl2_terms")),
    LicenceRule("GPL-2.0", ("gpl_free_start", "gpl_terms", "gpl2_later")),
    LicenceRule("GPL-2.0", ("gpl2_ref",)),
    LicenceRule("BSD-3-Clause", ("bsd_redistribute", "bsd_source", "bsd_binary", "bsd_endorse")),
    LicenceRule("BSD-2-Clause", ("bsd_redistribute", "bsd_source", "bsd_binary", "bsd_as_is")),
    LicenceRule("BSD-2-Clause", ("bsd_redistribute", "bsd_source_short", "bsd_binary_short")),
    LicenceRule("BSD", ("bsd_ref",)),
    LicenceRule("ISC", ("isc_grant", "isc_as_is")),
    LicenceRule("MPL-2.0", ("mpl2_ref",)),
    *[LicenceRule("CC-BY-NC-4.0", (name,)) for name in ("ccbync4_ref", "ccbync4_work")],
    *[LicenceRule("CC-BY-4.0", (name,)) for name in ("ccby4_ref", "ccby4_work")],
    *[LicenceRule("CC-BY-SA-4.0", (name,)) for name in ("ccbysa4_ref", "ccbysa4_work")],
    LicenceRule("Unlicense", ("unlicense_free",)),
    *[LicenceRule(licence, (_SPDX_IDS[said],)) for said, licence in _SPDX_SAID.items()],
    LicenceRule("Proprietary", ("all_rights",)),
)

#: Comment marks before a line, and those that close a comment.
COMMENT = r"(?dm)^[ \t]*(?://+|#+|/\*+|\*+/?|--|;+|%+|<!--)|(?:\*+/|-->)[ \t]*$"
#: What has the marks of a sentence end but is none.
ADDRESS, ABBREVIATION = r"https?://\S+", r"(identifier|\bv)[.:] "
#: A line about copyright ends where one of these begins, though no mark stands between.
COPYRIGHT = (
    r"(copyright[^\n]*?)\b(permission is hereby|permission to use|licensed under|redistribution and use|this program is|this library is|this source code)"
)
#: Where a sentence ends: a full stop or the like before white space or the end, and a line break or an empty line.
STOP = r"[.!?;:](?:\s|$)"
LINES, PARAGRAPHS = rf"\n|{STOP}", rf"\n\s*\n|{STOP}"
NOT_WORD = r"[^a-z0-9]+"
#: The number of a list item.
ITEM = r"^[0-9]{1,2} (?=[a-z])"


def _plain(text: Column) -> Column:
    """Lower case without comment marks; an address ends a sentence, an abbreviation does not."""
    lines = F.regexp_replace(F.lower(text), r"\r\n?", "\n")
    bare = F.regexp_replace(F.regexp_replace(lines, COMMENT, ""), ADDRESS, "\n\n")
    return F.regexp_replace(F.regexp_replace(bare, ABBREVIATION, "$1 "), COPYRIGHT, "$1\n\n$2")


def normal_sentences(plain: Column, ends: str) -> Column:
    """The sentences, a single space for all that is not a letter or digit of ASCII, without numbers of list items."""
    return F.transform(
        F.split(plain, ends), lambda s: F.regexp_replace(F.trim(F.regexp_replace(s, NOT_WORD, " ")), ITEM, "")
    )


def _known(plain: Column, ends: str, sentences: dict[str, str]) -> Column:
    by_text = F.create_map(*[F.lit(x) for name, said in sentences.items() for x in (said, name)])
    known = F.filter(normal_sentences(plain, ends), lambda s: s.isin(*sentences.values()))
    return F.transform(known, lambda s: F.element_at(by_text, s))


def may_hold_sentence(text: Column, sentences: dict[str, str]) -> Column:
    """False only for texts without any known sentence: each holds one of a few long words."""
    left, words = {s: set(s.split()) for s in sentences.values()}, []
    while left:
        offered = {w for some in left.values() for w in some}
        best = max(sorted(offered), key=lambda w: (sum(w in some for some in left.values()) * (len(w) > 4), len(w)))
        words.append(best)
        left = {s: some for s, some in left.items() if best not in some}
    lower, found = F.lower(text), F.lit(False)
    for word in words:
        found = found | F.contains(lower, F.lit(word))
    return found


def licences(
    documents: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    sentences: dict[str, str] = SENTENCES,
    rules: tuple[LicenceRule, ...] = RULES,
) -> DataFrame:
    """One row per document with a known sentence: doc_id, sentence_ids and licences (strings, space between), n_sentences.

    A text is read twice, without comment marks: with every line break as the end of a sentence, and with lines joined up to
    an empty one. ``sentence_ids`` are the known sentences in order, of the reading with more of them (the first of
    equals). ``licences`` lists, in the order of the rules and once each, those with a rule whose identifiers follow
    each other in either reading; known sentences that no rule explains leave it empty.

    Everything is an expression on one row: nothing is shuffled. A null or empty text has no sentence and
    no row. Repeated rows are repeated in the result.
    """
    some = documents.select(F.col(doc_id).cast("long").alias("doc_id"), text_or_empty(text).alias("body"))
    plain = some.where(may_hold_sentence(F.col("body"), sentences)).select("doc_id", _plain(F.col("body")).alias("plain"))
    read = plain.select(
        "doc_id", _known(F.col("plain"), LINES, sentences).alias("lines"), _known(F.col("plain"), PARAGRAPHS, sentences).alias("joined")
    ).where((F.size("lines") > 0) | (F.size("joined") > 0))
    more = F.size("joined") > F.size("lines")
    found = read.select(
        "doc_id",
        F.when(more, F.col("joined")).otherwise(F.col("lines")).alias("ids"),
        *[F.concat(F.lit(" "), F.array_join(name, " "), F.lit(" ")).alias(name) for name in ("lines", "joined")],
    )
    hits = [
        F.when(F.contains("lines", F.lit(f" {run} ")) | F.contains("joined", F.lit(f" {run} ")), licence)
        for run, licence in ((" ".join(rule.sentences), rule.licence) for rule in rules)
    ]
    return found.select(
        "doc_id",
        F.array_join("ids", " ").alias("sentence_ids"),
        F.array_join(F.array_distinct(F.array_compact(F.array(*hits))), " ").alias("licences"),
        F.size("ids").cast("long").alias("n_sentences"),
    )
