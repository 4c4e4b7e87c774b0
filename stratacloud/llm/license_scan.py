"""License scan by sentences and rules.

A text is cut into sentences; a sentence is normalised (A-Z lower-cased, other than letters and digits to one space, common
ways to say "under the ... license" to one) and looked up among known license sentences. The sequence of identifiers, with
one mark for each unknown sentence, is matched against ordered rules; a rule that matches takes its identifiers away, so that
later rules do not see them. Everything is a DataFrame expression over single rows: nothing is shuffled.

A line break ends a sentence unless the lines go on to a known sentence: one that is wrapped over any number of lines, with or
without comment leaders, is joined first and counts as one sentence. It starts and ends where a line or a sentence does, and
goes on over a sentence's end or a blank line only before a URL. Known sentences may be followed by (the "License"), and
titles of license files are known too, and sentences with a gap for a name. The SQL of scan_sql knows neither these nor wrapped
sentences, and agrees with scan_licenses on texts that have none of them. What is left of a list's marks (a number, a letter) is
no sentence.

Null or empty text: no sentence, no license. Repeated rows: each has its row. Texts are taken whole. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BREAK = r"([.!?;])[ \t\r\n\f]+"
UNDER = (
    "^(this (work|file|software|program|project|document|code|package|library) is )?"
    "(free software )?(licensed|released|distributed|published|available|made available|provided) under (the )?(terms of )?(the |an? )?"
)
#: What a list's mark leaves of itself.
MARK = "^([0-9]{1,2}|[a-z])$"
#: One of these stands in every known sentence: texts without any have none.
TRIGGERS = ["licen", "permission", "redistribut", "warrant", "copyright", "public domain", "gpl", "cc by", "cc0", "mpl", "creative commons"]
#: Known sentences, normalised, by identifier.
KNOWN = {
    "apache2": ["under apache license version 2 0", "under apache license 2 0", "under apache 2 0 license"],
    "apache2copy": ["you may obtain a copy of the license at http www apache org licenses license 2 0"],
    "apache2use": ["you may not use this file except in compliance with the license"],
    "mit": ["under mit license", "under mit licence"],
    "mitgrant": ["permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"],
    "mitnotice": ["the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"],
    "asis": ["the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"],
    "gpl3": ["under gnu general public license version 3", "under gnu general public license v3", "under gnu gpl version 3", "under gplv3"],
    "gpl3plus": ["under gnu general public license version 3 or at your option any later version", "under gnu general public license version 3 or later"],
    "gpl2": ["under gnu general public license version 2", "under gnu general public license v2", "under gnu gpl version 2", "under gplv2"],
    "lgpl21": ["under gnu lesser general public license version 2 1"],
    "lgpl3": ["under gnu lesser general public license version 3"],
    "agpl3": ["under gnu affero general public license version 3"],
    "mpl2": ["under mozilla public license version 2 0", "under mozilla public license v 2 0"],
    "bsd2": ["under bsd 2 clause license"],
    "bsd3": ["under bsd 3 clause license", "under bsd license"],
    "bsdgrant": ["redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"],
    "ccby4": ["under cc by 4 0", "under creative commons attribution 4 0 international license", "under creative commons attribution 4 0 international"],
    "ccbysa4": ["under cc by sa 4 0", "under creative commons attribution sharealike 4 0 international license", "under creative commons attribution sharealike 4 0 international"],
    "ccbync4": ["under cc by nc 4 0", "under creative commons attribution noncommercial 4 0 international license", "under creative commons attribution noncommercial 4 0 international"],
    "cc0": ["under cc0 1 0", "under cc0 1 0 universal"],
    "unlicense": ["this is free and unencumbered software released into the public domain"],
    "bsdsource": ["redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"],
    "bsdbinary": ["redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"],
    "bsdname": ["neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"],
    "isc": ["permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"],
    "zlib": ["permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"],
    "boost": ["under boost software license version 1 0"],
    "epl2": ["this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0"],
    "mplform": ["this source code form is subject to the terms of the mozilla public license v"],
    "mplcopy": ["if a copy of the mpl was not distributed with this file you can obtain one at https mozilla org mpl 2 0", "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"],
}
KNOWN["apache2copy"] += ["you may obtain a copy of the license at https www apache org licenses license 2 0"]
#: The foundation's licenses in file headers: names and versions by identifier; a header is one sentence or cut at semicolons.
GNU = {"gpl": ("gnu general public license", ("2", "3")), "lgpl": ("gnu lesser general public license", ("2 1", "3")), "agpl": ("gnu affero general public license", ("3",))}
for _name, (_title, _versions) in GNU.items():
    _you = f"you can redistribute it and or modify it under the terms of the {_title}"
    _as = "as published by the free software foundation"
    _free = [f"this {x} is free software " for x in ("program", "library", "file", "software")]
    KNOWN[f"{_name}you"] = [f"{x}{_you} {_as}" for x in ("", *_free)]
    for _v in _versions:
        _key = f"{_name}{_v.replace(' ', '')}"
        _later = [f"{_either} {_v} of the license or at your option any later version" for _either in ("either version", "version")]
        KNOWN[f"{_key}later"] = [f"{x}{_you} {_as} {y}" for x in ("", *_free) for y in _later]
        KNOWN[f"{_key}header"] = [f"{x}{_you} version {_v} {_as}" for x in ("", *_free)] + [f"{x}{_you} {_as} version {_v}{y}" for x in ("", *_free) for y in ("", " of the license", " only")]
        for _part, _texts in (("either", _later), ("version", [f"version {_v} of the license"])):
            for _t in _texts:
                KNOWN.setdefault(f"v{_v.replace(' ', '')}{_part}", [])
                KNOWN[f"v{_v.replace(' ', '')}{_part}"] += [_t] * (_t not in KNOWN[f"v{_v.replace(' ', '')}{_part}"])
#: License names of file tags.
TAGGED = (
    "MIT", "Apache-2.0", "BSD-2-Clause", "BSD-3-Clause", "ISC", "Zlib", "BSL-1.0", "EPL-2.0", "MPL-2.0", "Unlicense", "CC0-1.0", "CC-BY-4.0", "CC-BY-SA-4.0", "CC-BY-NC-4.0", "GPL-2.0", "GPL-2.0-only",
    "GPL-2.0-or-later", "GPL-3.0", "GPL-3.0-only", "GPL-3.0-or-later", "LGPL-2.1", "LGPL-2.1-only", "LGPL-2.1-or-later", "LGPL-3.0", "LGPL-3.0-only", "LGPL-3.0-or-later", "AGPL-3.0", "AGPL-3.0-only",
    "AGPL-3.0-or-later", "MIT OR Apache-2.0", "Apache-2.0 OR MIT", "Apache-2.0 WITH LLVM-exception",
)
for _tag in TAGGED:
    _plain_tag = _tag.lower().replace("-", " ").replace(".", " ")
    KNOWN["tag" + _plain_tag.replace(" ", "")] = [f"spdx license identifier {_plain_tag}"]
#: Sentences with a gap (*) of one to twelve words, by identifier.
GAPPED = {"bsdname": ["neither the name of * nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"]}
#: Titles of license files, normalised, by identifier.
TITLES = {
    "apache2": ["apache license version 2 0 january 2004", "apache license version 2 0"],
    "mit": ["mit license", "the mit license", "the mit license mit"],
    "gpl3": ["gnu general public license version 3 29 june 2007"],
    "gpl2": ["gnu general public license version 2 june 1991"],
    "lgpl21": ["gnu lesser general public license version 2 1 february 1999"],
    "lgpl3": ["gnu lesser general public license version 3 29 june 2007"],
    "agpl3": ["gnu affero general public license version 3 19 november 2007"],
    "mpl2": ["mozilla public license version 2 0"],
    "bsd2": ["bsd 2 clause license", "the bsd 2 clause license"],
    "bsd3": ["bsd 3 clause license", "the bsd 3 clause license"],
}
#: Ordered: longer sequences first; - stands for one unknown sentence.
RULES = [
    ("MIT", ["mitgrant", "mitnotice", "asis"]), ("MIT", ["mitgrant", "mitnotice"]), ("MIT", ["mitgrant"]), ("MIT", ["mit"]),
    ("Apache-2.0", ["apache2", "apache2use", "apache2copy"]), ("Apache-2.0", ["apache2use", "apache2copy"]), ("Apache-2.0", ["apache2"]),
    ("MPL-2.0", ["mplform", "-", "mplcopy"]), ("MPL-2.0", ["mplform", "-"]), ("MPL-2.0", ["mplcopy"]),
    ("BSD-3-Clause", ["bsdgrant", "bsdsource", "bsdbinary", "bsdname"]), ("BSD-2-Clause", ["bsdgrant", "bsdsource", "bsdbinary"]),
]
for _name, (_, _versions) in GNU.items():
    for _v in _versions:
        _key, _short = f"{_name}{_v.replace(' ', '')}", f"v{_v.replace(' ', '')}"
        _license = f"{_name.upper()}-{_v.replace(' ', '.') if ' ' in _v else _v + '.0'}"
        RULES += [(f"{_license}-or-later", [f"{_name}you", f"{_short}either"]), (f"{_license}-or-later", [f"{_key}later"]), (_license, [f"{_name}you", f"{_short}version"]), (_license, [f"{_key}header"])]
RULES += [
    ("GPL-3.0-or-later", ["gpl3plus"]), ("GPL-3.0", ["gpl3"]), ("GPL-2.0", ["gpl2"]), ("LGPL-2.1", ["lgpl21"]), ("LGPL-3.0", ["lgpl3"]), ("AGPL-3.0", ["agpl3"]),
    ("MPL-2.0", ["mpl2"]), ("BSD-2-Clause", ["bsd2"]), ("BSD-3-Clause", ["bsd3"]), ("BSD", ["bsdgrant"]),
    ("CC-BY-NC-4.0", ["ccbync4"]), ("CC-BY-SA-4.0", ["ccbysa4"]), ("CC-BY-4.0", ["ccby4"]), ("CC0-1.0", ["cc0"]), ("Unlicense", ["unlicense"]),
    ("ISC", ["isc"]), ("Zlib", ["zlib"]), ("BSL-1.0", ["boost"]), ("EPL-2.0", ["epl2"]),
    *((tag, [f"tag{tag.lower().replace('-', '').replace('.', '').replace(' ', '')}"]) for tag in TAGGED),
]


def _pattern(identifiers: list[str]) -> str:
    return "".join(f",{x}," for x in identifiers)


def _plain(s: Column) -> Column:
    return F.trim(F.regexp_replace(F.translate(s, UPPER, LOWER), "[^a-z0-9]+", " "))


def sentences(text: Column) -> Column:
    """Normalised sentences, without empty ones."""
    lines = F.split(F.regexp_replace(text, BREAK, "$1\n"), "\n")
    return _spoken(F.transform(lines, lambda s: F.regexp_replace(_plain(s), UNDER, "under ")))


def _spoken(pieces: Column) -> Column:
    return F.filter(pieces, lambda s: (s != "") & ~F.rlike(s, F.lit(MARK)))


def _wrapped(known: dict[str, list[str]]) -> Column:
    """Of each known sentence, longer ones first: words that a text with it holds, its pattern over lines, and its mark."""
    texts = sorted(((t, name) for name, ts in known.items() for t in ts), key=lambda x: (-len(x[0]), x[0]))
    rows = []
    for t, name in texts:
        words = t.removeprefix("under ")
        body = (UNDER.removeprefix("^") if words != t else "") + words
        body = re.sub(" (https?) ", "\n+\\1 ", body).replace(" ", "[ \n]").replace("[ \n]*[ \n]", "(?:[ \n][a-z0-9]+){1,12}[ \n]").replace("\n+http", "[ \n]\n*http")
        # list marks and what comment leaders leave may stand in front
        held = max(re.split(r" https? | \* ", words), key=len)
        rows.append(F.struct(F.lit(held).alias("words"), F.lit(f"(?<=\n)(?:(?:[0-9]{{1,2}}|[a-z]) )?{body}(?:[ \n]the[ \n]license)?(?=\n)").alias("pattern"), F.lit(f"#{name}").alias("mark")))
    return F.array(*rows)


def joined_sentences(text: Column, known: dict[str, list[str]]) -> Column:
    """Normalised sentences without empty ones; known ones as # and their identifier, joined where they are wrapped. Between
    lines stands one line break, at a sentence's end or a blank line several."""
    lines = F.split(F.regexp_replace(text, BREAK, "$1\n\n"), "\n")
    marked = F.concat(F.lit("\n"), F.array_join(F.transform(lines, _plain), "\n"), F.lit("\n"))

    let = lambda value, f: F.transform(F.array(value), f)[0]  # noqa: E731 - a value that is worked out once
    replaced = lambda m, flat: F.aggregate(F.filter(_wrapped(known), lambda row: F.contains(flat, row["words"])), m, lambda out, row: F.regexp_replace(out, row["pattern"], row["mark"]))
    flat = lambda m: F.regexp_replace(m, "\n+", " ")
    some = lambda x: reduce(Column.__or__, (F.contains(x, F.lit(t)) for t in TRIGGERS))
    marked = let(marked, lambda m: let(flat(m), lambda x: F.when(some(x), replaced(m, x)).otherwise(m)))
    return _spoken(F.transform(F.split(marked, "\n"), lambda s: F.regexp_replace(s, UNDER, "under ")))


def scan_licenses(docs: DataFrame, known: dict[str, list[str]] = KNOWN, rules: list[tuple[str, list[str]]] = RULES, titles: dict[str, list[str]] = TITLES, gapped: dict[str, list[str]] = GAPPED) -> DataFrame:
    """docs(doc_id, text): doc_id, n_sentences, n_known, identifiers (known ones in order), licenses (names in rule order)."""
    every = {name: [t for kind in (known, titles, gapped) for t in kind.get(name, [])] for name in dict.fromkeys([*known, *titles, *gapped])}
    out = docs.select("doc_id", F.coalesce(joined_sentences(F.col("text"), every), F.array().cast("array<string>")).alias("s"))
    out = out.select("doc_id", F.size("s").cast("long").alias("n_sentences"), F.transform("s", lambda s: F.when(s.startswith("#"), F.substring(s, 2, 100)).otherwise("-")).alias("ids"))
    found = F.filter("ids", lambda i: i != "-")
    table = F.array(*(F.struct(F.lit(name).alias("name"), F.lit(_pattern(ids)).alias("pattern")) for name, ids in rules))

    def step(state: Column, rule: Column) -> Column:
        hit = F.contains(state["left"], rule["pattern"])
        names = F.when(hit & ~F.array_contains(state["names"], rule["name"]), F.concat(state["names"], F.array(rule["name"]))).otherwise(state["names"])
        return F.struct(F.when(hit, F.replace(state["left"], rule["pattern"], F.lit(",-,"))).otherwise(state["left"]).alias("left"), names.alias("names"))

    start = F.struct(F.array_join(F.transform("ids", lambda i: F.concat(F.lit(","), i, F.lit(","))), "").alias("left"), F.array().cast("array<string>").alias("names"))
    matched = F.when(F.size(found) > 0, F.array_join(F.aggregate(table, start, step, lambda s: s["names"]), ",")).otherwise("")
    return out.select("doc_id", "n_sentences", F.size(found).cast("long").alias("n_known"), F.array_join(found, ",").alias("identifiers"), matched.alias("licenses"))


def scan_sql(table: str = "documents", known: dict[str, list[str]] = KNOWN, rules: list[tuple[str, list[str]]] = RULES) -> str:
    """The same in DuckDB's SQL."""
    pairs = ", ".join(f"'{t}': '{name}'" for name, texts in known.items() for t in texts)
    sql = f"""
    WITH cut AS (
      SELECT doc_id, list_filter(list_transform(string_split(regexp_replace(coalesce(text, ''), '([.!?;])[ \\t\\r\\n\\f]+', '\\1' || chr(10), 'g'), chr(10)),
        lambda s: regexp_replace(trim(regexp_replace(translate(s, '{UPPER}', '{LOWER}'), '[^a-z0-9]+', ' ', 'g')), '{UNDER}', 'under ')), lambda s: s <> '' AND NOT regexp_matches(s, '{MARK}')) AS s
      FROM {table}),
    known AS (
      SELECT doc_id, len(s) AS n_sentences, list_transform(s, lambda x: coalesce(MAP {{{pairs}}}[x], '-')) AS ids FROM cut),
    r0 AS (SELECT doc_id, n_sentences, list_filter(ids, lambda i: i <> '-') AS found, coalesce(array_to_string(list_transform(ids, lambda i: ',' || i || ','), ''), '') AS rest, []::VARCHAR[] AS names FROM known)"""
    for k, (name, ids) in enumerate(rules):
        p = _pattern(ids)
        sql += f""",
    r{k + 1} AS (SELECT doc_id, n_sentences, found, replace(rest, '{p}', ',-,') AS rest,
      CASE WHEN contains(rest, '{p}') AND NOT list_contains(names, '{name}') THEN list_append(names, '{name}') ELSE names END AS names FROM r{k})"""
    return f"""{sql}
    SELECT doc_id, CAST(n_sentences AS BIGINT) AS n_sentences, CAST(len(found) AS BIGINT) AS n_known, coalesce(array_to_string(found, ','), '') AS identifiers, coalesce(array_to_string(names, ','), '') AS licenses FROM r{len(rules)}"""
