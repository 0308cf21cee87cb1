"""License detection by ordered signature rules, in DataFrame functions only.

Base: places where a phrase's words stand consecutively, counted in words. Method: some hundreds of rules, each a regex with a
label, a level (0 identifiers, 1 notices and full names, 2 mentions) and a keyword. A text is looked at only
if it holds one of the gate words, of which every rule needs one; a rule runs only if the text holds its keyword, which it needs
too. Detections are intervals of the normal form (lower case, words between single blanks). A detection is suppressed if one
of the same or a better level contains it; of equal intervals the first rule stays. Base labels always stay.

Null and empty texts have no words and no labels, score 0. Repeated rows get equal results. The score is the best
remaining level's weight, 0 without labels.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
WEIGHTS = (1.0, 0.9, 0.5)  # by level
VERBS = "(?:licensed|released|distributed|available)"
ASCII_UPPER, ASCII_LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Families of licenses: label, names in words, keyword of the names, short identifiers, versions.
FAMILIES: list[tuple[str, list[str], str, list[str], list[str]]] = [
    ("mit", ["mit license", "mit licence", "expat license"], "licen", ["mit"], []),
    ("apache", ["apache license", "apache licence", "apache software license"], "apache", ["apache"], ["1 0", "1 1", "2 0", "2"]),
    ("gpl", ["gnu general public license", "gnu gpl"], "gnu", ["gpl"], ["1 0", "1", "2 0", "2", "3 0", "3"]),
    ("lgpl", ["gnu lesser general public license", "gnu library general public license", "gnu lgpl"], "gnu", ["lgpl"], ["2 0", "2", "2 1", "3 0", "3"]),
    ("agpl", ["gnu affero general public license", "affero general public license", "gnu agpl"], "affero", ["agpl"], ["1 0", "3 0", "3"]),
    ("gfdl", ["gnu free documentation license"], "gnu", ["gfdl"], ["1 1", "1 2", "1 3"]),
    ("mpl", ["mozilla public license"], "mozilla", ["mpl"], ["1 0", "1 1", "2 0"]),
    ("epl", ["eclipse public license"], "eclipse", ["epl"], ["1 0", "2 0"]),
    ("cddl", ["common development and distribution license"], "distribution", ["cddl"], ["1 0", "1 1"]),
    ("cpl", ["common public license"], "public", ["cpl"], ["1 0"]),
    ("eupl", ["european union public licence", "european union public license"], "european", ["eupl"], ["1 0", "1 1", "1 2"]),
    ("osl", ["open software license"], "software", ["osl"], ["1 0", "2 0", "2 1", "3 0"]),
    ("afl", ["academic free license"], "academic", ["afl"], ["1 1", "1 2", "2 0", "2 1", "3 0"]),
    ("artistic", ["artistic license", "perl artistic license"], "artistic", ["artistic"], ["1 0", "2 0"]),
    ("bsl", ["boost software license"], "boost", ["bsl"], ["1 0"]),
    ("zlib", ["zlib license", "zlib libpng license"], "zlib", ["zlib"], []),
    ("isc", ["isc license", "internet systems consortium license"], "isc", ["isc"], []),
    ("unlicense", ["the unlicense"], "unlicense", ["unlicense"], []),
    ("wtfpl", ["do what the fuck you want to public license"], "what", ["wtfpl"], []),
    ("ofl", ["sil open font license", "open font license"], "font", ["ofl"], ["1 0", "1 1"]),
    ("psf", ["python software foundation license", "psf license agreement"], "license", ["psf"], ["2 0"]),
    ("php", ["php license"], "php", ["php"], ["3 0", "3 01"]),
    ("ms-pl", ["microsoft public license"], "microsoft", ["ms pl"], []),
    ("ms-rl", ["microsoft reciprocal license"], "microsoft", ["ms rl"], []),
    ("odbl", ["open database license", "open data commons open database license"], "database", ["odbl"], ["1 0"]),
    ("pddl", ["open data commons public domain dedication and license"], "domain", ["pddl"], ["1 0"]),
    ("odc-by", ["open data commons attribution license"], "commons", ["odc by"], ["1 0"]),
    ("cc-by", ["creative commons attribution"], "commons", ["cc by"], ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-sa", ["creative commons attribution share alike", "creative commons attribution sharealike"], "commons", ["cc by sa"], ["1 0", "2 0", "2 5", "3 0", "4 0"]),
    ("cc-by-nd", ["creative commons attribution no derivatives", "creative commons attribution noderivatives"], "commons", ["cc by nd"], ["2 0", "3 0", "4 0"]),
    ("cc-by-nc", ["creative commons attribution non commercial", "creative commons attribution noncommercial"], "commons", ["cc by nc"], ["2 0", "3 0", "4 0"]),
    ("cc-by-nc-sa", ["creative commons attribution noncommercial sharealike", "creative commons attribution non commercial share alike"], "commons", ["cc by nc sa"], ["2 0", "3 0", "4 0"]),
    ("cc-by-nc-nd", ["creative commons attribution noncommercial noderivatives", "creative commons attribution non commercial no derivatives"], "commons", ["cc by nc nd"], ["2 0", "3 0", "4 0"]),
    ("cc0", ["creative commons zero", "cc0 public domain dedication"], "c", ["cc0"], ["1 0"]),
    ("elastic", ["elastic license"], "elastic", ["elastic"], ["2 0"]),
    ("sspl", ["server side public license"], "server", ["sspl"], ["1"]),
    ("busl", ["business source license"], "business", ["busl"], ["1 1"]),
    ("bsd", ["bsd license", "berkeley software distribution license"], "licen", ["bsd"], []),
]

# Single rules: label, level, keyword, regex over the normal form. Each begins at a word and takes whole words.
SINGLE: list[tuple[str, int, str, str]] = [
    ("mit", 1, "permission", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mit", 1, "license", "(?:released|licensed|distributed|available|published) under (?:the )?mit license"),
    ("mit", 2, "mit", "mit licen[cs]ed?"),
    ("mit-0", 1, "attribution", "mit no attribution"),
    ("isc", 1, "permission", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd-4", 1, "advertising", "all advertising materials mentioning features or use of this software"),
    ("bsd-3", 1, "endorse", "neither the names? of [^ ]+(?: [^ ]+){0,8} nor the names of (?:its|their) contributors may be used to endorse"),
    ("bsd-3", 0, "bsd", "bsd 3 clause(?: license)?"),
    ("bsd-2", 0, "bsd", "bsd 2 clause(?: license)?"),
    ("bsd-0", 0, "bsd", "(?:0bsd|bsd 0 clause)(?: license)?"),
    ("bsd-2", 0, "simplified", "simplified bsd(?: license)?"),
    ("bsd-3", 0, "bsd", "(?:new|modified|revised) bsd(?: license)?"),
    ("bsd", 1, "redistribution", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("apache-2", 1, "apache", "licensed under the apache license version 2(?: 0)?"),
    ("apache-2", 1, "apache", "http www apache org licenses license 2 0"),
    ("apache-2", 1, "apache", "you may not use this file except in compliance with the license(?: [^ ]+){0,12} apache"),
    ("apache", 2, "apache", "apache licensed"),
    ("gpl-2", 1, "version", "free software foundation either version 2 of the license"),
    ("gpl-3", 1, "version", "free software foundation either version 3 of the license"),
    ("gpl-2-or-later", 1, "version", "version 2 of the license or (?:at your option )?any later version"),
    ("gpl-3-or-later", 1, "version", "version 3 of the license or (?:at your option )?any later version"),
    ("gpl", 1, "gnu", "http www gnu org licenses gpl(?: html)?"),
    ("lgpl", 1, "gnu", "http www gnu org licenses lgpl(?: html)?"),
    ("gpl", 2, "gpl", "(?:licensed|released|distributed) under (?:the )?gpl"),
    ("mpl-2", 1, "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl", 1, "mozilla", "http mozilla org mpl(?: 2 0)?"),
    ("cc-by", 1, "licenses", "creativecommons org licenses by [1-4] [05]"),
    ("cc-by-sa", 1, "licenses", "creativecommons org licenses by sa [1-4] [05]"),
    ("cc-by-nc", 1, "licenses", "creativecommons org licenses by nc [1-4] [05]"),
    ("cc-by-nd", 1, "licenses", "creativecommons org licenses by nd [1-4] [05]"),
    ("cc-by-nc-sa", 1, "licenses", "creativecommons org licenses by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", 1, "licenses", "creativecommons org licenses by nc nd [1-4] [05]"),
    ("cc0", 1, "zero", "creativecommons org publicdomain zero 1 0"),
    ("public-domain", 1, "domain", "(?:released|dedicated|placed) (?:in|in to|into|to) the public domain"),
    ("public-domain", 2, "domain", "public domain"),
    ("all-rights-reserved", 1, "reserved", "all rights reserved"),
    ("copyright", 2, "copyright", "copyright (?:c )?(?:19|20)[0-9][0-9]"),
    ("proprietary", 1, "proprietary", "(?:this is )?proprietary and confidential"),
    ("proprietary", 1, "unauthorized", "unauthorized copying of this file"),
    ("unlicense", 1, "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", 1, "what", "you just do what the fuck you want to"),
    ("zlib", 1, "as", "this software is provided as is without any express or implied warranty in no event will the authors"),
    ("bsl-1", 1, "boost", "distributed under the boost software license version 1 0"),
    ("spdx", 2, "spdx", "spdx license identifier [^ ]+"),
    ("creative-commons", 2, "creative", "(?:a )?creative commons licen[cs]e"),
    ("open-source", 2, "open", "open source licen[cs]e"),
    ("see-license", 2, "details", "see (?:the )?licen[cs]e(?: file)? for details"),
]

USUAL = ("licen", "spdx", "copyright", "apache", "gpl", "domain", "creative", "commons", "gnu", "bsd", "mozilla", "reserved",
         "permission", "redistribution", "proprietary", "unauthorized", "cc0", "cc", "mit", "advertising", "endorse",
         "affero", "font", "wtfpl", "boost", "eclipse", "warranty", "fuck")


def rules() -> list[tuple[str, int, str, str]]:
    """All rules in order: ``(label, level, keyword, regex)``; a family makes a rule per name, version and form."""
    made = []
    for label, names, keyword, shorts, versions in FAMILIES:
        key = lambda name, keyword=keyword: keyword if keyword in name else max(name.split(" "), key=len)
        for version in versions:
            tidy = label + "-" + version.replace(" 0", "").replace(" ", ".")
            for short in shorts:
                made.append((tidy, 0, short.split(" ")[0], f"spdx license identifier {short} {version}(?: only| or later)?"))
                made.append((tidy, 0, short.split(" ")[0], f"{short} (?:v |version )?{version}(?: only| or later)?"))
                if " " not in version and short in ("gpl", "lgpl", "agpl"):
                    made.append((tidy, 0, short, f"{short}v{version}(?: or later)?"))
            for name in names:
                made.append((tidy, 1, key(name), f"(?:{VERBS} under )?(?:the )?{name} (?:v |version )?{version}(?: only| or later)?"))
        for short in shorts:
            made.append((label, 0, "spdx", f"spdx license identifier {short}"))
        for name in names:
            made.append((label, 1, key(name), f"{VERBS} under (?:the )?{name}"))
            made.append((label, 2, key(name), f"(?:the )?{name}"))
    return made + SINGLE


def required(regex: str) -> list[str]:
    """What a match of the regex holds, for each choice among its alternatives: ``#`` stands for optional groups and
    letters and for classes, all else is literal.
    """
    regex = re.sub(r"\(\?:[^()]*\)(?:\?|\{0,\d+\})", "#", regex)
    group = re.search(r"\(\?:([^()]*)\)", regex)
    if group:
        return [form for one in group[1].split("|") for form in required(regex[: group.start()] + one + regex[group.end() :])]
    return [re.sub(r"\[[^\]]*\]\+?|.\?", "#", regex)]


def rare_words() -> tuple[str, ...]:
    """The longest whole word of each form of a rule or base phrase that holds none of the usual parts."""
    words = []
    for regex in [*BASE, *(regex for *_, regex in rules())]:
        for form in required(regex):
            whole = [word for word in form.split(" ") if word.isalnum()]
            if not any(part in form for part in USUAL) and not set(whole) & set(words):
                words.append(max(whole, key=len))
    return tuple(words)


RARE = rare_words()
GATES = USUAL + RARE  # every match of every rule and base phrase holds one


def phrase_counts(norm: Column, words: Column, phrase: str) -> Column:
    """``n, first, last`` of a phrase's places: number, smallest and largest start in words.

    Cutting the normal form at the phrase leaves pieces whose blanks count their words.
    """
    pieces = F.split(norm, f" {phrase}(?= )")
    n = F.size(pieces) - 1
    blanks = lambda piece: F.length(piece) - F.length(F.replace(piece, F.lit(" "), F.lit("")))
    first = blanks(F.element_at(pieces, 1))
    last = words - (blanks(F.element_at(pieces, -1)) - 1) - len(phrase.split(" "))
    return F.struct(n.cast("long").alias("n"), F.when(n > 0, first).cast("long").alias("first"), F.when(n > 0, last).cast("long").alias("last"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score`` and, further, ``detections``:
    the remaining ``(start, end, level, rule, label)`` of the method, characters of the normal form.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    table = rules()
    literal = F.array(
        *[
            F.struct(F.lit(i).alias("rule"), F.lit(label).alias("label"), F.lit(level).alias("level"), F.lit(key).alias("key"), F.lit(f" {regex}(?= )").alias("regex"))
            for i, (label, level, key, regex) in enumerate(table)
        ]
    )
    holds = lambda words: reduce(lambda a, b: a | b, [F.contains(F.lower(text), F.lit(word)) for word in words])
    edge = SEPARATORS.removesuffix("+")
    gate = holds(USUAL) | (holds(RARE) & F.rlike(F.lower(text), F.lit(f"(?:^|{edge})(?:{'|'.join(RARE)})(?:{edge}|\\z)")))
    plain = F.concat(F.lit(" "), F.translate(F.regexp_replace(text, SEPARATORS, " "), ASCII_UPPER, ASCII_LOWER), F.lit(" "))
    source = docs.select(
        docs[id_col].alias("doc_id"),
        F.regexp_count(F.coalesce(docs[text_col], F.lit("")), F.lit(WORDS)).cast("long").alias("n_words"),
        docs[text_col].alias("text"),
    )
    # Null where the gate is shut: everything that follows is skipped for such a row.
    normal = F.when(gate, F.regexp_replace(plain, " +", " ")).alias("norm")
    source = source.select("doc_id", "n_words", normal)

    found = [phrase_counts(F.col("norm"), F.col("n_words"), phrase).alias(f"base{i}") for i, phrase in enumerate(BASE)]
    live = F.when(F.col("norm").isNotNull(), F.filter(literal, lambda r: F.contains(F.col("norm"), r["key"])))
    source = source.select("*", *found, live.alias("live"))

    def places(r: Column) -> Column:
        """The intervals of a rule's matches: lengths of what lies between them and of themselves, summed up."""
        between = F.split(F.col("norm"), r["regex"])
        matches = F.regexp_extract_all(F.col("norm"), r["regex"], F.lit(0))
        zero = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,back:int,level:int,rule:int,label:string>>)").alias("all"))
        step = lambda acc, m: F.struct(
            (acc["at"] + F.length(m["between"]) + F.length(m["match"])).alias("at"),
            F.concat(
                acc["all"],
                F.array(
                    F.struct(
                        (acc["at"] + F.length(m["between"])).alias("start"),
                        (-(acc["at"] + F.length(m["between"]) + F.length(m["match"]))).alias("back"),
                        r["level"].alias("level"),
                        r["rule"].alias("rule"),
                        r["label"].alias("label"),
                    )
                ),
            ).alias("all"),
        )
        pairs = F.zip_with(F.slice(between, 1, F.size(matches)), matches, lambda b, m: F.struct(b.alias("between"), m.alias("match")))
        return F.when(F.size(matches) > 0, F.aggregate(pairs, zero, step, lambda acc: acc["all"])).otherwise(zero["all"])

    # Sorted by start, then longest first, then level and rule: a detection is contained if an earlier one
    # of its level or a better one reaches at least as far.
    hits = F.array_sort(F.flatten(F.transform(F.col("live"), places)))
    source = source.select("*", hits.alias("hits"))
    start = F.struct(F.array(*[F.lit(-1)] * 3).alias("reach"), F.slice(F.col("hits"), 1, 0).alias("kept"))

    def keep(acc: Column, d: Column) -> Column:
        end = -d["back"]
        contained = F.array_max(F.slice(acc["reach"], 1, d["level"] + 1)) >= end
        reach = F.transform(acc["reach"], lambda x, i: F.when(i == d["level"], F.greatest(x, end)).otherwise(x))
        return F.struct(reach.alias("reach"), F.when(contained, acc["kept"]).otherwise(F.concat(acc["kept"], F.array(d))).alias("kept"))

    kept = F.when(F.size("hits") > 0, F.aggregate("hits", start, keep, lambda acc: acc["kept"]))
    source = source.select("*", kept.alias("kept"))

    detection = lambda d: F.struct(
        d["start"].alias("start"), (-d["back"]).alias("end"), d["level"].alias("level"), d["rule"].alias("rule"), d["label"].alias("label")
    )
    total = sum((F.coalesce(F.col(f"base{i}.n"), F.lit(0)) for i in range(len(BASE))), F.lit(0)).cast("long")
    base = F.array_compact(F.array(*[F.when(F.col(f"base{i}.n") > 0, F.lit(label)) for i, label in enumerate(BASE.values())]))
    labels = F.array_distinct(F.concat(base, F.coalesce(F.transform("kept", lambda d: d["label"]), F.array().cast("array<string>"))))
    weight = F.transform("kept", lambda d: F.element_at(F.array(*map(F.lit, WEIGHTS)), d["level"] + 1))
    score = F.greatest(F.when(total > 0, 1.0).otherwise(0.0), F.coalesce(F.array_max(weight), F.lit(0.0)))
    return source.select(
        "doc_id",
        "n_words",
        total.alias("n_base"),
        F.least(*[F.col(f"base{i}.first") for i in range(len(BASE))]).alias("first_word"),
        F.greatest(*[F.col(f"base{i}.last") for i in range(len(BASE))]).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(labels), ",").alias("labels"),
        score.alias("score"),
        F.coalesce(F.transform("kept", detection), F.array().cast("array<struct<start:int,end:int,level:int,rule:int,label:string>>")).alias("detections"),
    )
