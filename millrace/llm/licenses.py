"""License scans by ordered signature rules, in DataFrame functions only.

A text becomes its words joined by single blanks.  Hundreds of signature patterns
over that line come from hand-written names of license families, each in several
kinds of statement, and from sentences of the licenses' own texts.  A rule runs only
where one of its keywords is a word of the text, an everyday word only if one of its
companions is, too.  A detection inside another one goes; of two that overlap otherwise, the one
of the weaker kind goes (a lower priority number is stronger); detections of the
protected base phrases always stay.

Defined results: a null or empty text has no words, no labels and score 0; every
row is judged on its own, so repeated rows get the same result; places are word
positions from 0; the longest of detections that start together comes first, then
the stronger kind, then the earlier rule.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.frames import ascii_lower, named_again, plain_names, words_of

# Fixed value: what a word is.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
# The base phrases and their labels.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

#: label: (keywords, the family's name, its short identifier), as patterns over words.
#: Whatever a name or an identifier matches has a keyword among its words, else its rules wouldn't run there.
FAMILIES: dict[str, tuple[str, str, str]] = {
    "mit": ("mit expat", r"(?:mit|expat)(?: x11)?(?: style)?", "mit"),
    "mit-0": ("mit", r"mit (?:no attribution|0)", "mit 0"),
    "x11": ("x11", r"x11(?: mit)?", "x11"),
    "apache-1": ("apache apache1", r"apache(?: software)?(?: licen[sc]e)?(?: version| v)? ?1(?: [01])?", "apache 1 [01]"),
    "apache-2": ("apache apache2 asl", r"(?:apache(?: software)?(?: licen[sc]e)?(?: version| v)? ?2(?: 0)?|asl 2(?: 0)?)", "apache 2 0"),
    "gpl-1": ("gpl gnu gpl1", r"(?:gnu (?:general public licen[sc]e|gpl)|gpl)(?: version| v)? ?1(?: 0)?", "gpl 1 0(?: only| or later)?"),
    "gpl-2": ("gpl gnu gpl2 gplv gplv2", r"(?:gnu (?:general public licen[sc]e|gpl)|gpl)(?: version| v|v)? ?2(?: 0)?|gplv2", "gpl 2 0(?: only| or later)?"),
    "gpl-3": ("gpl gnu gpl3 gplv gplv3", r"(?:gnu (?:general public licen[sc]e|gpl)|gpl)(?: version| v|v)? ?3(?: 0)?|gplv3", "gpl 3 0(?: only| or later)?"),
    "gpl": ("gpl gnu", r"gnu (?:general public licen[sc]e|gpl)", "gpl"),
    "lgpl-2": ("lgpl gnu lgpl2", r"(?:gnu (?:library|lesser) general public licen[sc]e|lgpl)(?: version| v)? ?2(?: 0)?", "lgpl 2 0(?: only| or later)?"),
    "lgpl-2-1": ("lgpl gnu lgpl2", r"(?:gnu lesser general public licen[sc]e|lgpl)(?: version| v)? ?2 1", "lgpl 2 1(?: only| or later)?"),
    "lgpl-3": ("lgpl gnu lgpl3", r"(?:gnu lesser general public licen[sc]e|lgpl)(?: version| v)? ?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    "lgpl": ("lgpl gnu", r"gnu (?:lesser|library) general public licen[sc]e|gnu lgpl", "lgpl"),
    "agpl-3": ("agpl agpl3 affero", r"(?:(?:gnu )?affero general public licen[sc]e|agpl)(?: version| v)? ?3(?: 0)?", "agpl 3 0(?: only| or later)?"),
    "agpl": ("agpl affero", r"(?:gnu )?affero general public licen[sc]e|gnu agpl", "agpl"),
    "gfdl": ("gfdl gnu", r"gnu free documentation licen[sc]e(?: version 1(?: [1-3])?)?", "gfdl 1 [1-3](?: only| or later)?"),
    "bsd-2": ("bsd freebsd", r"(?:(?:2 clause|simplified|two clause) bsd|bsd (?:2|two) clause|freebsd)", "bsd 2 clause"),
    "bsd-3": ("bsd", r"(?:(?:3 clause|new|revised|modified|three clause) bsd|bsd (?:3|three) clause)", "bsd 3 clause"),
    "bsd-4": ("bsd", r"(?:(?:4 clause|original|old|four clause) bsd|bsd (?:4|four) clause)", "bsd 4 clause"),
    "bsd-0": ("bsd 0bsd", r"(?:0bsd|zero clause bsd|bsd zero clause)", "0bsd"),
    "bsd": ("bsd berkeley", r"(?:berkeley software distribution|bsd)(?: style)?", "bsd"),
    "isc": ("isc consortium", r"(?:isc|internet systems consortium)", "isc"),
    "mpl-1": ("mpl mozilla mpl1", r"(?:mozilla public licen[sc]e|mpl)(?: version| v)? ?1(?: [01])?", "mpl 1 [01]"),
    "mpl-2": ("mpl mozilla mpl2", r"(?:mozilla public licen[sc]e|mpl)(?: version| v)? ?2(?: 0)?", "mpl 2 0"),
    "epl-1": ("epl eclipse epl1", r"(?:eclipse public licen[sc]e|epl)(?: version| v)? ?1(?: 0)?", "epl 1 0"),
    "epl-2": ("epl eclipse epl2", r"(?:eclipse public licen[sc]e|epl)(?: version| v)? ?2(?: 0)?", "epl 2 0"),
    "edl": ("eclipse edl", r"eclipse distribution licen[sc]e(?: version| v)? ?1(?: 0)?", "edl 1 0"),
    "cddl": ("cddl cddl1 distribution", r"(?:common development and distribution licen[sc]e|cddl)(?: version| v)?(?: ?1(?: [01])?)?", "cddl 1 [01]"),
    "cpl": ("cpl common ibm", r"(?:common public licen[sc]e|ibm public licen[sc]e)(?: version| v)? ?1(?: 0)?", "cpl 1 0"),
    "eupl": ("eupl eupl1 european", r"(?:european union public licen[sc]e|eupl)(?: version| v)?(?: ?1(?: [0-2])?)?", "eupl 1 [0-2]"),
    "artistic-1": ("artistic", r"artistic licen[sc]e(?: version)? 1(?: 0)?", "artistic 1 0"),
    "artistic-2": ("artistic", r"artistic licen[sc]e(?: version)? 2(?: 0)?", "artistic 2 0"),
    "boost": ("boost bsl", r"boost software licen[sc]e(?: version)?(?: 1(?: 0)?)?", "bsl 1 0"),
    "busl": ("busl business", r"business source licen[sc]e(?: version)?(?: 1(?: 1)?)?", "busl 1 1"),
    "zlib": ("zlib", r"zlib(?: libpng)?", "zlib"),
    "libpng": ("libpng png", r"(?:png reference library|libpng)", "libpng(?: 2 0)?"),
    "unlicense": ("unlicense", r"(?:the )?unlicense", "unlicense"),
    "wtfpl": ("wtfpl fuck", r"(?:do what the fuck you want to public licen[sc]e|wtfpl)", "wtfpl"),
    "cc0": ("cc0 cc creative", r"(?:cc0|creative commons zero|cc zero)(?: 1 0)?(?: universal)?", "cc0 1 0"),
    "cc-by": ("cc creative", r"(?:cc by|creative commons attribution)(?: (?:[1-4] [05]))?(?: international| unported)?", "cc by [1-4] [05]"),
    "cc-by-sa": ("cc creative", r"(?:cc by sa|creative commons attribution share ?alike)(?: (?:[1-4] [05]))?", "cc by sa [1-4] [05]"),
    "cc-by-nd": ("cc creative", r"(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s)(?: (?:[1-4] [05]))?", "cc by nd [1-4] [05]"),
    "cc-by-nc": ("cc creative", r"(?:cc by nc|creative commons attribution non ?commercial)(?: (?:[1-4] [05]))?", "cc by nc [1-4] [05]"),
    "cc-by-nc-sa": ("cc creative", r"(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: (?:[1-4] [05]))?", "cc by nc sa [1-4] [05]"),
    "cc-by-nc-nd": ("cc creative", r"(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s)(?: (?:[1-4] [05]))?", "cc by nc nd [1-4] [05]"),
    "odbl": ("odbl database", r"(?:open database licen[sc]e|odbl)(?: v?1(?: 0)?)?", "odbl 1 0"),
    "odc-by": ("odc commons", r"(?:open data commons attribution licen[sc]e|odc by)(?: v?1(?: 0)?)?", "odc by 1 0"),
    "pddl": ("pddl dedication", r"(?:public domain dedication and licen[sc]e|pddl)(?: 1(?: 0)?)?", "pddl 1 0"),
    "ofl": ("ofl sil", r"(?:sil open font licen[sc]e|ofl)(?: version)?(?: 1(?: [01])?)?", "ofl 1 [01]"),
    "psf": ("psf python", r"python(?: software foundation)? licen[sc]e(?: version)?(?: 2)?", "(?:psf|python) 2 0"),
    "php": ("php", r"php licen[sc]e(?: version)?(?: 3(?: [01]+)?)?", "php 3 [01]+"),
    "ruby": ("ruby", r"ruby licen[sc]e", "ruby"),
    "openssl": ("openssl", r"openssl(?: ssleay)?", "openssl"),
    "postgresql": ("postgresql", r"postgresql", "postgresql"),
    "ncsa": ("ncsa", r"(?:university of illinois )?ncsa(?: open source)?", "ncsa"),
    "upl": ("upl universal", r"(?:universal permissive licen[sc]e|upl)(?: version)?(?: 1(?: 0)?)?", "upl 1 0"),
    "vim": ("vim", r"vim", "vim"),
    "w3c": ("w3c", r"w3c(?: software)?(?: notice and)?", "w3c"),
    "afl": ("afl academic afl1 afl2 afl3", r"(?:academic free licen[sc]e|afl)(?: version| v)? ?[1-3](?: [01])?", "afl [1-3] [01]"),
    "osl": ("osl osl1 osl2 osl3 software", r"(?:open software licen[sc]e|osl)(?: version| v)? ?[1-3](?: 0)?", "osl [1-3] 0"),
    "mulan": ("mulan mulanpsl mulanpsl2", r"mulan(?: permissive software licen[sc]e|psl)(?: version| v)?(?: ?2)?", "mulanpsl 2 0"),
    "mspl": ("microsoft ms", r"microsoft public licen[sc]e", "ms pl"),
    "msrl": ("microsoft ms", r"microsoft reciprocal licen[sc]e", "ms rl"),
    "sspl": ("sspl sspl1 server", r"(?:server side public licen[sc]e|sspl)(?: version| v)?(?: ?1)?", "sspl 1 0"),
    "elastic": ("elastic", r"elastic licen[sc]e(?: version| v)?(?: ?2(?: 0)?)?", "elastic 2 0"),
    "cecill": ("cecill", r"cecill(?: b| c)?(?: (?:version )?2(?: 1)?)?", "cecill 2 [01]"),
    "openrail": ("openrail rail", r"(?:creativeml |bigscience )?open ?rail(?: m)?", "(?:creativeml |bigscience )?openrail m"),
    "llama": ("llama llama2 llama3 llama4", r"llama [234](?: [0-9])? community", "llama[234]"),
}
#: label: (keywords, patterns of sentences that only this license's own text or header holds).
TEXTS: dict[str, tuple[str, tuple[str, ...]]] = {
    "mit": (
        "hereby",
        (
            r"permission is hereby granted free of charge(?: to any person obtaining a copy(?: of this software(?: and associated documentation files)?)?)?",
        ),
    ),
    "boost": ("hereby", (r"permission is hereby granted free of charge to any person or organi[sz]ation obtaining a copy of the software and accompanying documentation",)),
    "ofl": (
        "hereby font",
        (
            r"permission is hereby granted free of charge to any person obtaining a copy of the font software",
            r"this font software is licen[sc]ed under the sil open font licen[sc]e(?: version 1 [01])?",
        ),
    ),
    "upl": ("hereby", (r"permission is hereby granted to any person obtaining a copy of this software associated documentation and or data",)),
    "isc": ("hereby", (r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted",)),
    "bsd-0": ("hereby", (r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software",)),
    "postgresql": (
        "hereby",
        (r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted",),
    ),
    "w3c": ("hereby", (r"permission to copy modify and distribute this work with or without modification for any purpose and without fee or royalty is hereby granted",)),
    "bsd": ("redistribution", (r"redistribution and use in source and binary forms(?: with or without modification(?: are permitted)?)?",)),
    "bsd-3": ("endorse", (r"neither the names? of (?:[^ ]+ ){1,12}(?:may|nor the names of its contributors may) be used to endorse or promote products",)),
    "bsd-4": ("advertising", (r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment",)),
    "apache-1": ("apache", (r"this product includes software developed by the apache (?:software foundation|group)",)),
    "apache-2": (
        "apache compliance perpetual",
        (
            r"you may not use this file except in compliance with the licen[sc]e",
            r"apache licen[sc]e version 2 0 january 2004",
            r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright licen[sc]e",
        ),
    ),
    "gpl-1": ("gnu", (r"gnu general public licen[sc]e version 1 february 1989",)),
    "gpl-2": ("gnu", (r"gnu general public licen[sc]e version 2 june 1991", r"gnu general public licen[sc]e as published by the free software foundation either version 2")),
    "gpl-3": ("gnu", (r"gnu general public licen[sc]e version 3 29 june 2007", r"gnu general public licen[sc]e as published by the free software foundation either version 3")),
    "gpl": (
        "redistribute copyleft freedom",
        (
            r"this program is free software you can redistribute it and or modify it",
            r"the gnu general public licen[sc]e is a free copyleft licen[sc]e",
            r"the licen[sc]es for most software are designed to take away your freedom to share and change it",
        ),
    ),
    "lgpl": ("redistribute", (r"this library is free software you can redistribute it and or modify it",)),
    "lgpl-2-1": ("gnu", (r"gnu lesser general public licen[sc]e version 2 1 february 1999",)),
    "lgpl-3": ("gnu", (r"gnu lesser general public licen[sc]e version 3 29 june 2007",)),
    "agpl-3": ("affero", (r"gnu affero general public licen[sc]e version 3 19 november 2007", r"gnu affero general public licen[sc]e as published by the free software foundation either version 3")),
    "gfdl": ("gnu", (r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[sc]e",)),
    "mpl-1": ("mozilla", (r"the contents of this file are subject to the mozilla public licen[sc]e version 1 [01]",)),
    "mpl-2": ("mozilla", (r"this source code form is subject to the terms of the mozilla public licen[sc]e(?: v(?:ersion)? ?2 0)?",)),
    "epl-1": ("eclipse", (r"the accompanying materials are made available under the terms of the eclipse public licen[sc]e v(?:ersion)? ?1 0",)),
    "epl-2": ("eclipse", (r"the accompanying materials are made available under the terms of the eclipse public licen[sc]e v?(?:ersion)? ?2 0",)),
    "cddl": ("cddl distribution", (r"the contents of this file are subject to the terms of the common development and distribution licen[sc]e",)),
    "artistic-1": ("semblance", (r"the intent of this document is to state the conditions under which a package may be copied such that the copyright holder maintains some semblance of artistic control",)),
    "zlib": (
        "misrepresented warranty",
        (
            r"this software is provided as is without any express or implied warranty in no event will the authors be held liable",
            r"the origin of this software must not be misrepresented",
        ),
    ),
    "unlicense": ("unencumbered", (r"this is free and unencumbered software(?: released into the public domain)?",)),
    "wtfpl": ("verbatim", (r"copy and distribute verbatim or modified copies of this licen[sc]e document and changing it is allowed as long as the name is changed",)),
    "cc0": ("deed", (r"the person who associated a work with this deed has dedicated the work to the public domain",)),
    "ncsa": ("redistributions", (r"redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers",)),
    "openssl": ("openssl", (r"this product includes software developed by the openssl project",)),
    "php": ("php", (r"this product includes php software freely available from",)),
    "psf": ("psf python", (r"this licen[sc]e agreement is between the python software foundation",)),
    "busl": ("licensor", (r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use",)),
    "sspl": ("service", (r"if you make the functionality of the program or a modified version available to third parties as a service",)),
    "elastic": ("licensor", (r"the licensor grants you a non exclusive royalty free worldwide non sublicensable non transferable licen[sc]e to use copy distribute",)),
}
_LICENSE = "license licence licenses licences license1 license2 license3 licence1 licence2 licence3"
#: A keyword that is an everyday word opens its rules only beside one of these, which its patterns hold, too.
COMPANIONS: dict[str, str] = {
    **dict.fromkeys(
        "software server common business universal python database distribution dedication european academic elastic artistic "
        "eclipse boost mozilla microsoft ms ruby".split(),
        _LICENSE,
    ),
    "php": f"{_LICENSE} freely",
    "commons": "attribution",
    "creative": "commons",
    "consortium": "internet",
    "berkeley": "distribution",
    "llama": "community",
    "rail": "open",
    "png": "reference",
    "hereby": "granted",
    "redistribution": "binary",
    "redistributions": "retain",
    "endorse": "promote",
    "advertising": "materials",
    "compliance": _LICENSE,
    "perpetual": "irrevocable",
    "redistribute": "modify",
    "freedom": _LICENSE,
    "font": "sil copy",
    "verbatim": "copies",
    "warranty": "implied",
    "misrepresented": "origin",
    "deed": "dedicated",
    "licensor": "grants",
    "service": "functionality",
}
# kind: (priority, confidence, pattern with {n} for the name and {i} for the identifier)
KINDS: dict[str, tuple[int, float, str]] = {
    "tag": (1, 1.0, r"spdx licen[sc]e identifier {i}"),
    "notice": (
        2,
        0.95,
        r"(?:(?:dual |re)?licen[sc]ed|released|distributed|available|published|provided|covered|made available) "
        r"(?:to you )?(?:under|by|with)(?: the)?(?: terms of(?: the)?)? (?:{n})(?: licen[sc]e)?",
    ),
    "address": (3, 0.9, r"(?:https? )?(?:www )?(?:opensource|spdx) org licen[sc]es? {i}(?: html| php)?"),
    "heading": (4, 0.8, r"(?:the )?(?:{n}) licen[sc]e(?: agreement| text| terms)?"),
    "mention": (5, 0.6, r"licen[sc]es? (?:is |type )?(?:{n}|{i})"),
}
#: Names that say enough without the word license.
PLAIN_NAMES = (
    "apache-2 gpl-2 gpl-3 gpl lgpl-2 lgpl-2-1 lgpl-3 lgpl agpl-3 agpl gfdl mpl-2 epl-2 cddl eupl boost unlicense wtfpl "
    "cc0 cc-by-sa cc-by-nd cc-by-nc cc-by-nc-sa cc-by-nc-nd odbl ofl sspl elastic cecill mulan artistic-2 upl"
).split()

_RULE = "array<struct<id: int, base: boolean, priority: int, score: double, label: string, keywords: array<string>, pattern: string>>"

_PLACE = "array<struct<start: int, end: int, base: boolean, priority: int, id: int, label: string, score: double>>"


def rules() -> list[dict]:
    """All rules in order: the base phrases, then each kind of statement of each family."""
    found: list[dict] = []

    def add(label: str, keywords: str, priority: int, score: float, pattern: str, base: bool = False) -> None:
        whole = f"(?<= )(?:{pattern})(?= )"
        found.append({"id": len(found), "base": base, "priority": priority, "score": score, "label": label, "keywords": keywords.split(), "pattern": whole})

    for phrase, label in BASE.items():
        add(label, {"mit": "mit", "apache-2": "apache", "cc-by-nc": "cc"}[label], 0, 0.9, phrase, True)
    for priority, score, pattern in KINDS.values():
        for label, (keywords, name, short) in FAMILIES.items():
            add(label, keywords, priority, score, pattern.replace("{n}", name).replace("{i}", short))
    for label, (keywords, patterns) in TEXTS.items():
        for pattern in patterns:
            add(label, keywords, 2, 0.9, pattern)
    for label in PLAIN_NAMES:
        add(label, FAMILIES[label][0], 6, 0.5, FAMILIES[label][1])
    return found


def _nothing() -> Column:
    return F.array().cast(_PLACE)


def _blanks(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _places(line: Column, rule: Column) -> Column:
    """Where a rule's pattern stands in the line, in words."""
    between = F.transform(F.split(line, rule["pattern"], -1), _blanks)
    sizes = F.transform(F.regexp_extract_all(line, rule["pattern"], F.lit(0)), _blanks)
    zero = F.struct(F.lit(0).alias("seen"), _nothing().alias("out"))

    def step(state: Column, i: Column) -> Column:
        start = state["seen"] + between[i] - 1
        one = F.struct(
            start.alias("start"),
            (start + sizes[i] + 1).alias("end"),
            rule["base"].alias("base"),
            rule["priority"].alias("priority"),
            rule["id"].alias("id"),
            rule["label"].alias("label"),
            rule["score"].alias("score"),
        )
        return F.struct((start + 1 + sizes[i]).alias("seen"), F.concat(state["out"], F.array(one)).alias("out"))

    each = F.aggregate(F.sequence(F.lit(0), F.size(sizes) - 1), zero, step, lambda s: s["out"])
    return F.when(F.size(sizes) > 0, each).otherwise(_nothing())


def _order(a: Column, b: Column) -> Column:
    def less(x: Column, y: Column, rest: Column) -> Column:
        return F.when(x < y, -1).when(x > y, 1).otherwise(rest)

    rest = less(a["priority"], b["priority"], less(a["id"], b["id"], F.lit(0)))
    return less(a["start"], b["start"], less(b["end"], a["end"], rest))


def _resolved(found: Column) -> Column:
    """Without detections inside another one, and without the weaker of two that overlap."""
    zero = F.struct(F.lit(-1).alias("upto"), _nothing().alias("out"))

    def outer(state: Column, x: Column) -> Column:
        stays = (x["end"] > state["upto"]) | x["base"]
        out = F.when(stays, F.concat(state["out"], F.array(x))).otherwise(state["out"])
        return F.struct(F.greatest(state["upto"], x["end"]).alias("upto"), out.alias("out"))

    whole = F.aggregate(found, zero, outer, lambda s: s["out"])

    def stronger(out: Column, x: Column) -> Column:
        last = F.get(out, F.size(out) - 1)
        meets = last.isNotNull() & (x["start"] < last["end"]) & ~x["base"]
        weaker = meets & (x["priority"] > last["priority"])
        better = meets & (x["priority"] < last["priority"]) & ~last["base"]
        before = F.when(better, F.slice(out, 1, F.greatest(F.size(out) - 1, F.lit(0)))).otherwise(out)
        return F.when(weaker, out).otherwise(F.concat(before, F.array(x)))

    return F.aggregate(whole, _nothing(), stronger)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``n_words``, ``base`` (all places of base phrases) and ``detections`` to each row.

    Both are arrays of (start, end, base, priority, id, label, score).
    """
    plain, names = plain_names(docs)
    table = rules()
    opening = {k for r in table for k in r["keywords"]}
    beside = {k: w.split() for k, w in COMPANIONS.items()}
    looked = F.from_json(F.lit(json.dumps(sorted(opening.union(*beside.values())))), "array<string>")
    keywords = F.from_json(F.lit(json.dumps(sorted(opening))), "array<string>")
    companions = F.from_json(F.lit(json.dumps(beside)), "map<string, array<string>>")
    listed = F.from_json(F.lit(json.dumps(table)), _RULE)
    seen = plain.withColumn("words", words_of(ascii_lower(F.col(names[text])), WORD))
    seen = seen.withColumn("n_words", F.size("words").cast("long")).withColumn("met", F.array_intersect("words", looked))
    # An everyday word without its companions opens nothing.
    opened = F.filter("met", lambda w: F.coalesce(F.arrays_overlap(F.try_element_at(companions, w), F.col("met")), F.lit(True)))
    seen = seen.withColumn("present", F.array_intersect(opened, keywords))
    line = F.when(F.size("present") > 0, F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" "))).otherwise(F.lit(""))
    seen = seen.withColumn("line", line)
    gated = F.filter(listed, lambda r: F.arrays_overlap(r["keywords"], F.col("present")))
    found = F.flatten(F.transform(gated, lambda r: _places(F.col("line"), r)))
    seen = seen.withColumn("found", F.when(F.size("present") > 0, F.array_sort(found, _order)).otherwise(_nothing()))
    seen = seen.withColumn("base", F.filter("found", lambda x: x["base"]))
    seen = seen.withColumn("detections", F.when(F.size("found") > 0, _resolved(F.col("found"))).otherwise(_nothing()))
    return named_again(seen, names, n_words="n_words", base="base", detections="detections")


def labels(detections: Column) -> Column:
    """Distinct labels, sorted and comma-joined."""
    return F.array_join(F.array_sort(F.array_distinct(F.transform(detections, lambda x: x["label"]))), ",")
