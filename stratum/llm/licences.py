"""Licence recognition by sentences: texts become sequences of known licence-sentence identifiers,
and ordered rules over those identifiers name the licences.

A text is lower-cased and every run of other characters than a-z and 0-9 becomes one space. A known
sentence is found where it starts and ends at a boundary: a line end or ``. ! ? ;`` before white space.
It may run over single line ends and ``;`` (texts are wrapped, comment marks that begin a line
and list marks such as ``a)`` do not count), but not over blank lines and other ends of sentences. At each boundary
the longest one counts. Some sentences have a place for a name (``NAMED``). An SPDX line may name
several licences with OR and AND. Those found give their identifiers, in order; all else is left out. Rules are tried
in order, the most specific first; a rule matches where its identifiers stand next to each other
in the sequence, and uses them up, so the general rules see only what is left.

Everything is one projection: no shuffle, no Python. A text without any anchor word cannot hold a
known sentence (every one contains an anchor) and is not split. Null and empty texts give empty
results; repeated rows give equal rows; all other columns are passed through.
"""
from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh

# Known licence sentences (normalised) and their identifiers.
SENTENCES = {
    "released under the mit license": "MITref",
    "licensed under the mit license": "MITref",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITperm",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITnotice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITwarranty",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCperm",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness": "ISCwarranty",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDpre",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDsource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDbinary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDendorse",
    "licensed under the apache license version 2 0": "Apache2ref",
    "licensed under the apache license version 2 0 the license": "Apache2ref",
    "you may not use this file except in compliance with the license": "Apache2comply",
    "you may obtain a copy of the license at": "Apache2copy",
    "this work is licensed under the gnu general public license version 3": "GPL3ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3plus",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2plus",
    "see the gnu general public license for more details": "GPLdetails",
    "this source code form is subject to the terms of the mozilla public license v": "MPLform",
    "if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0": "MPLcopy",
    "licensed under cc by nc 4 0": "CCBYNC4ref",
    "licensed under cc by 4 0": "CCBY4ref",
    "licensed under cc by sa 4 0": "CCBYSA4ref",
    "this work is licensed under a creative commons attribution 4 0 international license": "CCBY4ref",
    "spdx license identifier mit": "SPDXMIT",
    "spdx license identifier apache 2 0": "SPDXApache2",
    "spdx license identifier gpl 3 0 or later": "SPDXGPL3",
    "all rights reserved": "AllRights",
    "license apache license version 2 0": "Apache2ref",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 2 as published by the free software foundation": "GPL2only",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license version 3 as published by the free software foundation": "GPL3only",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "LGPL21plus",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "LGPL3plus",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "LGPL3plus",
    "see the gnu lesser general public license for more details": "LGPLdetails",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "AGPL3plus",
    "see the gnu affero general public license for more details": "AGPLdetails",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0": "EPL2form",
    "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0 which accompanies this distribution and is available at http www eclipse org legal epl v10 html": "EPL1form",
    "this is free and unencumbered software released into the public domain": "Unlicenseform",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted": "0BSDperm",
    "distributed under the boost software license version 1 0": "Boostref",
    "this software is provided as is without any express or implied warranty": "Zlibwarranty",
    "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions": "Zlibperm",
}
# Licence identifiers of SPDX lines besides those above.
SPDX_IDS = ["0BSD", "AGPL-3.0-only", "AGPL-3.0-or-later", "BSD-2-Clause", "BSD-3-Clause", "BSL-1.0", "CC-BY-4.0", "CC-BY-NC-4.0", "CC-BY-SA-4.0", "CC0-1.0",
            "EPL-1.0", "EPL-2.0", "GPL-2.0", "GPL-2.0-only", "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "ISC", "LGPL-2.1-only", "LGPL-2.1-or-later",
            "LGPL-3.0-only", "LGPL-3.0-or-later", "MPL-2.0", "Unlicense", "Zlib"]
SPDX_LINE = "spdx license identifier "
SENTENCES |= {SPDX_LINE + re.sub("[^a-z0-9]+", " ", i.lower()): f"SPDX{i}" for i in SPDX_IDS}
# Known sentences with a place for names (normalised; up to twelve words), and the sentence that stands for each.
NAMED = {
    r"neither the names? of ([a-z0-9]+(?: [a-z0-9]+){0,11}) nor the names of (?:its|their|any) contributors may be used to endorse or promote products derived from this software without specific prior written permission":
        "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
}
ANCHORS = "licen[sc]e|permission|permitted|warrant|redistribut|reserved|software|mpl"

# Ordered rules, licence name and the identifiers it needs next to each other.
RULES = [
    ("MIT", ["MITperm", "MITnotice", "MITwarranty"]),
    ("MIT", ["MITperm", "MITnotice"]),
    ("ISC", ["ISCperm", "ISCwarranty"]),
    ("ISC", ["ISCperm"]),
    ("BSD-3-Clause", ["BSDpre", "BSDsource", "BSDbinary", "BSDendorse"]),
    ("BSD-2-Clause", ["BSDpre", "BSDsource", "BSDbinary"]),
    ("Apache-2.0", ["Apache2ref", "Apache2comply", "Apache2copy"]),
    ("Apache-2.0", ["Apache2ref", "Apache2comply"]),
    ("Apache-2.0", ["Apache2ref"]),
    ("GPL-3.0-or-later", ["GPL3plus", "GPLdetails"]),
    ("GPL-3.0-or-later", ["GPL3plus"]),
    ("GPL-2.0-or-later", ["GPL2plus", "GPLdetails"]),
    ("GPL-2.0-or-later", ["GPL2plus"]),
    ("GPL-3.0", ["GPL3ref"]),
    ("MPL-2.0", ["MPLform", "MPLcopy"]),
    ("MIT", ["MITref"]),
    ("CC-BY-NC-4.0", ["CCBYNC4ref"]),
    ("CC-BY-SA-4.0", ["CCBYSA4ref"]),
    ("CC-BY-4.0", ["CCBY4ref"]),
    ("MIT", ["SPDXMIT"]),
    ("Apache-2.0", ["SPDXApache2"]),
    ("GPL-3.0-or-later", ["SPDXGPL3"]),
    ("All-rights-reserved", ["AllRights"]),
    ("GPL-2.0-only", ["GPL2only", "GPLdetails"]),
    ("GPL-2.0-only", ["GPL2only"]),
    ("GPL-3.0-only", ["GPL3only", "GPLdetails"]),
    ("GPL-3.0-only", ["GPL3only"]),
    ("LGPL-2.1-or-later", ["LGPL21plus", "LGPLdetails"]),
    ("LGPL-2.1-or-later", ["LGPL21plus"]),
    ("LGPL-3.0-or-later", ["LGPL3plus", "LGPLdetails"]),
    ("LGPL-3.0-or-later", ["LGPL3plus"]),
    ("AGPL-3.0-or-later", ["AGPL3plus", "AGPLdetails"]),
    ("AGPL-3.0-or-later", ["AGPL3plus"]),
    ("EPL-2.0", ["EPL2form"]),
    ("EPL-1.0", ["EPL1form"]),
    ("Unlicense", ["Unlicenseform"]),
    ("0BSD", ["0BSDperm", "ISCwarranty"]),
    ("0BSD", ["0BSDperm"]),
    ("BSL-1.0", ["Boostref"]),
    ("Zlib", ["Zlibwarranty", "Zlibperm"]),
    ("Zlib", ["Zlibperm"]),
] + [(i, [f"SPDX{i}"]) for i in SPDX_IDS]

#: Sentence ends of ``scan_sql``, which knows sentences of one line only.
SPLIT = r"[\r\n]+|[.!?;]+(?:[ \t]+|$)"
#: What bounds sentences: marks that a known sentence cannot run over, and marks that it can.
HARD, SOFT = "\x01", "\x02"


def bounded(text: Column) -> Column:
    """The normalised text with its boundaries marked, one at either end."""
    out = F.concat(F.lit("\n"), F.translate(F.lower(text), HARD + SOFT, "  "), F.lit("\n"))
    for pattern, by in ((r"\r\n?", "\n"),
                        (r"\n[ \t/*#!;%<>|-]*+(?:(?:dnl|rem)[ \t]+)?", "\n"),  # comment marks
                        (r"\n\(?(?:[0-9]{1,2}|[a-z]|[ivx]{2,4})\)[ \t]+", "\n"),  # list marks
                        (r"\n[^a-z0-9\n]*+(?=\n)", HARD), (r"[.!?](?=[ \t\n])", HARD),
                        (r"\n|;(?=[ \t\n])", SOFT), (f"[^a-z0-9{HARD}{SOFT}]+", " ")):
        out = F.regexp_replace(out, pattern, by)
    return out


def _each_spdx(text: Column) -> Column:
    """Bounded text in which every identifier of an SPDX expression (``a OR b AND c``) has a line of its own."""
    ids = sorted((k.removeprefix(SPDX_LINE) for k in SENTENCES if k.startswith(SPDX_LINE)), key=len, reverse=True)
    # \G: where the last match ended; the group is atomic, as "gpl 3 0 or later" is one identifier
    return F.regexp_replace(text, rf"({SPDX_LINE}|\G(?<!^))((?>{'|'.join(ids)})) (?:or|and) (?={'|'.join(ids)})", f"$1$2{SOFT}{SPDX_LINE}")


def _unnamed(sentence: Column) -> Column:
    """A sentence with a name as the sentence that stands for it."""
    for pattern, plain in NAMED.items():
        sentence = F.regexp_replace(sentence, f"^{pattern}$", plain)
    return sentence


def sentence_ids(text: Column, sentences: dict[str, str] | None = None) -> Column:
    """Identifiers of the known sentences of a text, in order (array of strings)."""
    table = sentences or SENTENCES
    known = F.create_map(*[F.lit(x) for kv in table.items() for x in kv])
    gap = f"[ {SOFT}]+"
    any_of = "|".join(gap.join(map(re.escape, s.split(" "))) for s in sorted(table, key=len, reverse=True))
    if sentences is None:
        any_of = "|".join([any_of, *(s.replace("(", "(?:").replace("(?:?:", "(?:").replace(" ", gap) for s in NAMED)])
    pattern = f"[{HARD}{SOFT}] ?({any_of})(?= ?[{HARD}{SOFT}])"
    marked = _each_spdx(bounded(text)) if sentences is None else bounded(text)
    found = F.transform(F.regexp_extract_all(marked, F.lit(pattern), F.lit(1)),
                        lambda s: F.element_at(known, _unnamed(F.regexp_replace(s, gap, " "))))
    if sentences is not None:  # other sentences need not hold an anchor
        return found
    return F.when(text.rlike("(?i)" + ANCHORS), found).otherwise(F.array().cast("array<string>"))


def scan(docs: DataFrame, text_col: str = "text", rules: list[tuple[str, list[str]]] | None = None,
         sentences: dict[str, str] | None = None) -> DataFrame:
    """``docs`` with ``sentence_ids`` (array), ``licences`` (sorted names, no repeats) and ``unmatched`` (identifiers no rule used)."""
    rules = rules or RULES
    seq, names = fresh(docs.columns, "_seq", "_names")
    out = docs.withColumn("sentence_ids", F.coalesce(sentence_ids(F.col(f"`{text_col}`"), sentences), F.array().cast("array<string>")))
    # every identifier stands between its own pair of marks, so rules cannot match across names
    out = out.withColumns({seq: F.array_join(F.transform("sentence_ids", lambda s: F.concat(F.lit("<"), s, F.lit(">"))), ""),
                           names: F.array().cast("array<string>")})
    step = F.struct(F.col(seq).alias("s"), F.col(names).alias("n"))
    table = F.array(*[F.struct(F.lit(n).alias("name"), F.lit("".join(f"<{i}>" for i in ids)).alias("ids")) for n, ids in rules])

    def apply(acc: Column, rule: Column) -> Column:
        hit = F.contains(acc["s"], rule["ids"])
        return F.struct(F.replace(acc["s"], rule["ids"], F.lit("|")).alias("s"),
                        F.when(hit, F.array_append(acc["n"], rule["name"])).otherwise(acc["n"]).alias("n"))

    done = F.when(F.col(seq) != "", F.aggregate(table, step, apply)).otherwise(step)
    out = out.withColumn(seq, done)
    unmatched = F.length(F.col(seq)["s"]) - F.length(F.replace(F.col(seq)["s"], F.lit("<"), F.lit("")))
    return out.withColumns({"licences": F.array_sort(F.array_distinct(F.col(seq)["n"])), "unmatched": unmatched.cast("int")}).drop(seq, names)


def scan_sql() -> str:
    """DuckDB SQL of ``scan`` over documents, with the arrays joined by commas."""
    known = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in SENTENCES.items()) + "}"
    plain = "trim(regexp_replace(lower(x), '[^a-z0-9]+', ' ', 'g'))"
    for pattern, stands in NAMED.items():
        plain = f"regexp_replace({plain}, '^{pattern}$', '{stands}')"
    ctes = []
    for i, (name, ids) in enumerate(RULES):
        key = "".join(f"<{x}>" for x in ids)
        prev = "s" if i == 0 else f"r{i - 1}"
        ctes.append(f"r{i} AS (SELECT * REPLACE (replace(seq, '{key}', '|') AS seq, "
                    f"CASE WHEN contains(seq, '{key}') THEN list_append(names, '{name}') ELSE names END AS names) FROM {prev})")
    return f"""WITH k AS (SELECT {known} AS known),
s AS (SELECT doc_id, ids, array_to_string(list_transform(ids, lambda x: '<' || x || '>'), '') AS seq, CAST([] AS VARCHAR[]) AS names FROM (
  SELECT doc_id, CASE WHEN regexp_matches(text, '(?i){ANCHORS}') THEN list_filter(list_transform(
      string_split_regex(text, '{SPLIT}'), lambda x: known[{plain}]), lambda x: x IS NOT NULL)
    ELSE [] END AS ids FROM documents, k)),
{", ".join(ctes)}
SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentence_ids, coalesce(array_to_string(list_sort(list_distinct(names)), ','), '') AS licences,
       CAST(len(seq) - len(replace(seq, '<', '')) AS INTEGER) AS unmatched
FROM r{len(RULES) - 1}"""
