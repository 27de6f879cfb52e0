"""License scans by ordered signature rules, in DataFrame operations only.

A rule is a regular expression over the text in lower case, a keyword that any match holds, a label, a priority
and a confidence. A text is searched for a rule only if it holds the rule's keyword, and for any rule only if it
holds one of the strings that all matches hold. Of the matches, one that lies within another of higher priority (or of the same priority and longer, or of the
same place and a label that sorts first) is suppressed. All work stays in a document's row: no shuffle, no Python.

Besides, the places of three plain phrases are counted over words (runs of digits, letters a to z and characters beyond
x7F); their labels always stay.

Defined results: a null text is like an empty one (no words, null places, labels '', score 0); a null doc_id passes
through; repeated rows give repeated results. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Phrases and labels of the base count.
PHRASES = {("mit", "license"): "mit", ("apache", "license"): "apache", ("general", "public", "license"): "gpl"}

#: label stem, full name as a regular expression, its keyword, short names, versions ('' : none in use).
FAMILIES = [
    ("apache", r"apache(?: software)?(?: foundation)? licen[sc]e", "apache", ["apache", "asl"], ["1.0", "1.1", "2.0"]),
    ("gpl", r"(?<!lesser )(?<!library )(?<!affero )general public licen[sc]e", "general public", ["gpl", "gnu gpl"], ["1", "2", "3"]),
    ("lgpl", r"(?:lesser|library) general public licen[sc]e", "general public", ["lgpl"], ["2.0", "2.1", "3"]),
    ("agpl", r"affero general public licen[sc]e", "affero", ["agpl"], ["1", "3"]),
    ("gfdl", r"free documentation licen[sc]e", "free documentation", ["gfdl", "fdl"], ["1.1", "1.2", "1.3"]),
    ("mpl", r"mozilla public licen[sc]e", "mozilla public", ["mpl"], ["1.0", "1.1", "2.0"]),
    ("epl", r"eclipse public licen[sc]e", "eclipse public", ["epl"], ["1.0", "2.0"]),
    ("cpl", r"common public licen[sc]e", "common public", ["cpl"], ["1.0"]),
    ("cddl", r"common development and distribution licen[sc]e", "common development", ["cddl"], ["1.0", "1.1"]),
    ("eupl", r"european union public licen[sc]e", "european union public", ["eupl"], ["1.0", "1.1", "1.2"]),
    ("osl", r"open software licen[sc]e", "open software", ["osl"], ["1.0", "2.0", "2.1", "3.0"]),
    ("afl", r"academic free licen[sc]e", "academic free", ["afl"], ["1.1", "2.0", "2.1", "3.0"]),
    ("artistic", r"artistic licen[sc]e", "artistic", ["artistic"], ["1.0", "2.0"]),
    ("bsl", r"boost software licen[sc]e", "boost", ["bsl"], ["1.0"]),
    ("ofl", r"(?:sil )?open font licen[sc]e", "open font", ["ofl"], ["1.0", "1.1"]),
    ("ms-pl", r"microsoft public licen[sc]e", "microsoft public", ["ms-pl"], [""]),
    ("ms-rl", r"microsoft reciprocal licen[sc]e", "microsoft reciprocal", ["ms-rl"], [""]),
    ("zpl", r"zope public licen[sc]e", "zope", ["zpl"], ["1.1", "2.0", "2.1"]),
    ("php", r"php licen[sc]e", "php", ["php license"], ["3.0", "3.01"]),
    ("python", r"python(?: software foundation)? licen[sc]e", "python", ["psf", "psfl"], ["2"]),
    ("lppl", r"latex project public licen[sc]e", "latex project", ["lppl"], ["1.0", "1.1", "1.2", "1.3", "1.3c"]),
    ("cecill", r"cecill(?: free software licen[sc]e)?", "cecill", ["cecill"], ["1.0", "2.0", "2.1"]),
    ("mulan", r"mulan permissive software licen[sc]e", "mulan", ["mulanpsl", "mulan psl"], ["1", "2"]),
    ("ncsa", r"university of illinois/ncsa open source licen[sc]e", "ncsa", ["ncsa"], [""]),
    ("isc", r"isc licen[sc]e", "isc", ["isc"], [""]),
    ("zlib", r"zlib(?:/libpng)? licen[sc]e", "zlib", ["zlib"], [""]),
    ("mit", r"(?:mit|expat|x11) licen[sc]e", "licen", ["mit"], [""]),
    ("wtfpl", r"do what the f[^ ]{1,4} you want to public licen[sc]e", "do what the", ["wtfpl"], [""]),
    ("unlicense", r"the unlicense", "unlicense", ["unlicense"], [""]),
    ("odbl", r"open (?:data commons open )?database licen[sc]e", "database licen", ["odbl"], ["1.0"]),
    ("pddl", r"public domain dedication and licen[sc]e", "public domain dedication", ["pddl"], ["1.0"]),
    ("openrail", r"(?:bigscience |creativeml )?open ?rail(?:-m)? licen[sc]e", "rail", ["openrail", "openrail-m"], [""]),
]
#: Creative Commons: elements by their words and letters.
COMMONS = {"by": r"attribution", "by-sa": r"attribution[ -]share ?alike", "by-nc": r"attribution[ -]non-?commercial", "by-nd": r"attribution[ -]no ?-?deriv(?:ative)?s?(?: works)?", "by-nc-sa": r"attribution[ -]non-?commercial[ -]share ?alike", "by-nc-nd": r"attribution[ -]non-?commercial[ -]no ?-?deriv(?:ative)?s?(?: works)?"}
COMMONS_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
#: Sentences of licenses' own texts and notices: label, regular expression, keyword.
TEXTS = [
    ("mit", r"permission is hereby granted, free of charge, to any person obtaining a copy", "hereby granted"),
    ("mit", r"the above copyright notice and this permission notice shall be included", "permission notice"),
    ("mit", r"the software is provided \"as is\", without warranty of any kind", "as is"),
    ("isc", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose", "permission to use"),
    ("bsd", r"redistribution and use in source and binary forms", "redistribution"),
    ("bsd-3-clause", r"neither the name of .{1,80} nor the names of its contributors", "neither the name"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software", "advertising materials"),
    ("bsd-2-clause", r"(?:simplified|freebsd|2-clause|two-clause) bsd(?: licen[sc]e)?|bsd[ -]2[ -]clause", "bsd"),
    ("bsd-3-clause", r"(?:new|modified|revised|3-clause|three-clause) bsd(?: licen[sc]e)?|bsd[ -]3[ -]clause", "bsd"),
    ("bsd-4-clause", r"(?:original|4-clause|four-clause) bsd(?: licen[sc]e)?|bsd[ -]4[ -]clause", "bsd"),
    ("0bsd", r"zero[ -]clause bsd|(?<![0-9a-z])0bsd(?![0-9a-z])", "bsd"),
    ("bsd", r"bsd licen[sc]e|bsd-style licen[sc]e", "bsd"),
    ("zlib", r"this software is provided 'as-is', without any express or implied warranty", "as-is"),
    ("gpl", r"you can redistribute it and/or modify it under the terms of the gnu general public licen[sc]e", "redistribute it"),
    ("lgpl", r"you can redistribute it and/or modify it under the terms of the gnu lesser general public licen[sc]e", "redistribute it"),
    ("agpl", r"you can redistribute it and/or modify it under the terms of the gnu affero general public licen[sc]e", "redistribute it"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered"),
    ("public-domain", r"(?:released|placed|dedicated|is|are) (?:in|into|to) the public domain", "public domain"),
    ("cc0-1.0", r"cc0(?: 1\.0)?(?: universal)?", "cc0"),
    ("cc0-1.0", r"public domain dedication(?! and)", "public domain dedication"),
    ("proprietary", r"all rights reserved", "all rights reserved"),
    ("proprietary", r"proprietary and confidential|confidential and proprietary", "proprietary"),
    ("proprietary", r"may not be (?:copied|reproduced|distributed)[^.]{0,60} without (?:the )?(?:prior |express )*(?:written )?permission", "may not be"),
    ("json", r"the software shall be used for good, not evil", "not evil"),
    ("apache-2.0", r"you may not use this file except in compliance with the licen[sc]e", "except in compliance"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public licen[sc]e,? v\.? ?2\.0", "source code form"),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public licen[sc]e version 1\.1", "contents of this file"),
    ("epl-2.0", r"the accompanying materials are made available under the terms of the eclipse public licen[sc]e v?\.? ?2\.0", "accompanying materials"),
    ("gpl", r"either version [0-9](?:\.[0-9])? of the licen[sc]e,? or \(?at your option\)? any later version", "at your option"),
    ("bsl-1.0", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy", "hereby granted"),
    ("zlib", r"altered source versions must be plainly marked as such", "altered source"),
    ("openssl", r"this product includes software developed by the openssl project", "openssl"),
    ("ofl-1.1", r"the requirement for fonts to remain under this licen[sc]e does not apply", "requirement for fonts"),
    ("artistic-1.0", r"modify it under the same terms as perl(?: itself)?", "same terms as"),
    ("python", r"psf hereby grants licensee a nonexclusive, royalty-free, world-?wide licen[sc]e", "royalty-free"),
    ("postgresql", r"permission to use, copy, modify, and distribute this software and its documentation for any purpose, without fee", "without fee"),
    ("x11", r"shall not be used in advertising or otherwise to promote the sale", "promote the sale"),
    ("cc0-1.0", r"waived all copyright and related or neigh?bou?ring rights", "waived all copyright"),
    ("gfdl", r"with no invariant sections, no front-cover texts,? and no back-cover texts", "invariant sections"),
    ("cecill", r"ce logiciel est r[e\u00e9]gi par la licence cecill", "ce logiciel"),
    ("proprietary", r"unauthori[sz]ed (?:copying|reproduction|distribution|use)[^.]{0,80} is (?:strictly )?prohibited", "prohibited"),
    ("proprietary", r"(?:contains|constitutes?) (?:the )?trade secrets?", "trade secret"),
    ("proprietary", r"for internal use only", "internal use only"),
    ("proprietary", r"no part of this (?:publication|book|document) may be reproduced", "no part of this"),
    ("public-domain", r"no copyright is claimed|dedicate any and all copyright interest", "copyright"),
    ("beerware", r"beer-?ware licen[sc]e|you can buy me a beer", "beer"),
]


def rules() -> list[dict]:
    """The rules in order: of two with the same priority the earlier stands first."""
    out = []

    def add(label, regex, keyword, priority, confidence):
        out.append({"label": label, "regex": regex, "keyword": keyword, "priority": priority, "confidence": confidence})

    for stem, name, key, shorts, versions in FAMILIES:
        for v in versions:
            label = f"{stem}-{v}" if v else stem
            num = v.replace(".", r"\.").removesuffix(r"\.0") + (r"(?:\.0)?" if v.endswith(".0") or "." not in v and v else "")
            end = r"(?![0-9a-z]|\.[0-9])"
            for short in shorts:
                add(label, rf"spdx-license-identifier: *{short.replace(' ', '-')}{'-' + num if v else ''}(?:-only|-or-later|\+)?{end}", "spdx-license-identifier", 100, 1.0)
            if v:
                add(label, rf"licen[sc]ed under (?:the )?(?:terms of the )?(?:gnu )?{name},? *\(?(?:version|v\.?)? *{num}{end}", key, 90, 0.98)
                add(label, rf"(?:gnu )?{name},? *\(?(?:version|v\.?)? *{num}{end}", key, 80, 0.95)
                add(label, rf"{name},? *\(?(?:version|v\.?)? *{num} or (?:\(at your option\) )?(?:any )?later", key, 85, 0.95)
                for short in shorts:
                    add(label, rf"(?<![0-9a-z]){short}(?: licen[sc]e)?[ -]?(?:version |v\.? ?)?{num}\+?{end}", short, 70, 0.85)
        add(stem, rf"(?:licen[sc]ed|released|distributed|available) under (?:the )?(?:terms of the )?(?:gnu )?{name}", key, 60, 0.9)
        add(stem, name, key, 40, 0.75)
        for short in shorts:
            add(stem, rf"(?:licen[sc]ed|released|distributed|available) under (?:the )?{short}(?![0-9a-z])", short, 50, 0.8)
    for letters, name in COMMONS.items():
        spelled = letters.replace("-", "[ -]")
        for v in COMMONS_VERSIONS:
            num = v.replace(".", r"\.")
            label = f"cc-{letters}-{v}"
            add(label, rf"cc[ -]{spelled}[ -](?:v\.? ?)?{num}(?!\.?[0-9])", "cc", 80, 0.95)
            add(label, rf"(?:creative commons )?{name} (?:licen[sc]e )?(?:version )?{num}(?: international| unported| generic)?", "attribution", 80, 0.95)
            add(label, rf"creativecommons\.org/licenses/{letters}/{num}", "creativecommons.org", 100, 1.0)
        add(f"cc-{letters}", rf"(?<![0-9a-z])cc[ -]{spelled}(?![a-z-])", "cc", 50, 0.8)
        add(f"cc-{letters}", rf"creative commons {name}", "creative commons", 50, 0.8)
    for label, regex, key in TEXTS:
        add(label, regex, key, 65, 0.9)
    return out


#: Strings of which each rule's matches hold one, but for those of short names with versions.
NOTICES = ["licen", "released under", "distributed under", "available under", "cecill", "cc by", "cc-by", "attribution", "commons", *dict.fromkeys(key for _, _, key in TEXTS)]


def short_names() -> str:
    """A regular expression that finds where a short name with a version may begin."""
    names = "|".join(sorted({s for *_, shorts, versions in FAMILIES if versions != [""] for s in shorts}))
    return rf"(?<![0-9a-z])(?:{names})(?: licen[sc]e)?[ -]?(?:version |v\.? ?)?[0-9]"


def searched(text: Column) -> Column:
    """Whether any rule can match: strings are looked for anywhere, as matches need not begin or end where words do."""
    out = text.rlike(short_names())
    for notice in reversed(NOTICES):
        out = F.contains(text, F.lit(notice)) | out
    return out


_MATCH = "struct<start:int,end:int,priority:int,label:string,confidence:double>"
#: The same in the order in which matches are swept.
_SORTED = "struct<start:int,minus_end:int,minus_priority:int,label:string,confidence:double>"
BLOCK = 64
_SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BASE_KEY = "license"


def _bind(value: Column, body) -> Column:
    """body(value) with value computed once, also where body uses it inside lambdas."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _scan(items: Column, zero: Column, kind: str, step, emit) -> Column:
    """emit(state, item) of each item, state going on by step(state, item). Results are appended to blocks of BLOCK, since an append copies its array: the time is linear in the number of items."""
    none = lambda t: F.expr(f"cast(array() as array<{t}>)").alias("out")

    def over(xs):
        last = F.greatest(F.lit(0), F.ceil(F.size(xs) / BLOCK).cast("int") - 1)
        blocks = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice(xs, i * BLOCK + 1, F.lit(BLOCK)))

        def block(acc, part):
            one = lambda a, x: F.struct(step(a["state"], x).alias("state"), F.array_append(a["out"], emit(a["state"], x)).alias("out"))
            done = F.aggregate(part, F.struct(acc["state"].alias("state"), none(kind)), one)
            return _bind(done, lambda d: F.struct(d["state"].alias("state"), F.array_append(acc["out"], d["out"]).alias("out")))

        return F.aggregate(blocks, F.struct(zero.alias("state"), none(f"array<{kind}>")), block, lambda acc: F.flatten(acc["out"]))

    return _bind(items, over)


def _places(text: Column, rule: Column) -> Column:
    """Where a rule matches, as MATCH sorts them: pieces between matches and the matches themselves give the starts."""
    found = F.regexp_extract_all(text, rule["regex"], F.lit(0))
    sizes = lambda f: F.zip_with(f, F.slice(F.split(text, rule["regex"], -1), F.lit(1), F.size(f)), lambda m, p: F.struct(F.length(p).alias("gap"), F.length(m).alias("size")))
    end = lambda at, x: at + x["gap"] + x["size"]
    match = lambda at, x: F.struct((at + x["gap"]).alias("start"), (-end(at, x)).alias("minus_end"), (-rule["priority"]).alias("minus_priority"), rule["label"].alias("label"), rule["confidence"].alias("confidence"))
    return _scan(_bind(found, sizes), F.lit(0), _SORTED, end, match)


def _kept(matches: Column) -> Column:
    """Matches that don't lie within another of higher priority, or of the same priority that is longer, or in the same place with a label that sorts first (or that is the same).

    In order of start, then of end downwards, priority downwards and label, whatever a match lies within stands before
    it, and it lies within one of them if their largest end reaches its own: for each priority the largest end of
    those with so much priority or more is carried along.
    """
    levels = sorted({r["priority"] for r in rules()})
    own = lambda state, x: F.coalesce(*(F.when(x["minus_priority"] == -p, state[f"p{p}"]) for p in levels))
    step = lambda state, x: F.struct(*(F.greatest(state[f"p{p}"], F.when(x["minus_priority"] <= -p, -x["minus_end"])).alias(f"p{p}") for p in levels))
    kept = lambda state, x: F.when(own(state, x) < -x["minus_end"], F.struct(x["start"], (-x["minus_end"]).alias("end"), (-x["minus_priority"]).alias("priority"), x["label"], x["confidence"]))
    zero = F.struct(*(F.lit(-1).alias(f"p{p}") for p in levels))
    return F.filter(_scan(F.array_sort(matches), zero, _MATCH, step, kept), lambda m: m.isNotNull())


def _base(ws: Column) -> Column:
    """Places of the phrases over words, in order of their starts."""

    def at(words_, word, i):
        out = F.lit(None).cast("string")
        for phrase, label in reversed(PHRASES.items()):
            fits = word == phrase[0]
            for j, follows in enumerate(phrase[1:], 1):
                fits = fits & (F.get(words_, i + j) == follows)
            out = F.when(fits, F.lit(label)).otherwise(out)
        return F.struct(i.cast("long").alias("at"), out.alias("label"))

    return _bind(ws, lambda q: F.filter(F.transform(q, lambda w, i: at(q, w, i)), lambda x: x["label"].isNotNull()))


def scan_licenses(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches) for each row of docs."""
    grouped: dict[str, list[dict]] = {}
    for rule in rules():
        grouped.setdefault(rule["keyword"], []).append(rule)
    by_key = F.from_json(F.lit(json.dumps(grouped)), "map<string,array<struct<label:string,regex:string,keyword:string,priority:int,confidence:double>>>")
    keys = F.array(*map(F.lit, grouped))
    # lower() beyond A to Z changes neither where words end nor whether they equal a phrase
    step = docs.select("doc_id", F.lower(F.coalesce("text", F.lit(""))).alias("low"))
    step = step.select("doc_id", "low", F.split("low", _SEPARATOR, -1).alias("pieces"))
    present = lambda t: F.filter(keys, lambda k: F.contains(t, k))
    applied = lambda t: F.flatten(F.transform(present(t), lambda k: F.element_at(by_key, k)))
    found = _bind(F.col("low"), lambda t: F.flatten(F.transform(applied(t), lambda r: _places(t, r))))
    edge = lambda i: (F.get("pieces", i) == "").cast("int")
    count = F.size("pieces") - edge(F.lit(0)) - F.when(F.size("pieces") > 1, edge(F.size("pieces") - 1)).otherwise(0)
    step = step.select(
        "doc_id",
        count.cast("long").alias("n_words"),
        F.when(F.array_contains("pieces", _BASE_KEY), _base(F.filter("pieces", lambda w: w != ""))).otherwise(F.expr("cast(array() as array<struct<at:bigint,label:string>>)")).alias("base"),
        F.when(searched(F.col("low")), _kept(found)).otherwise(F.expr(f"cast(array() as array<{_MATCH}>)")).alias("matches"),
    )
    named = lambda a: F.transform(a, lambda x: x["label"])
    joined = lambda a: F.array_join(F.array_sort(F.array_distinct(a)), ",")
    best = F.coalesce(F.array_max(F.transform("matches", lambda m: m["confidence"])), F.lit(0.0))
    return step.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.get("base", F.lit(0))["at"].alias("first_word"),
        F.get("base", F.size("base") - 1)["at"].alias("last_word"),
        joined(named(F.col("base"))).alias("base_labels"),
        joined(F.concat(named(F.col("base")), named(F.col("matches")))).alias("labels"),
        F.greatest(best, F.when(F.size("base") > 0, 0.5).otherwise(0.0)).alias("score"),
        "matches",
    )
