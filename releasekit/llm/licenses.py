"""License scan: ordered signature rules, gated by keywords, with containment suppression.

A text is lower-cased (A-Z) and cut into words.  Only texts with one of the gate keywords are
looked at further; there, only rules whose own keyword occurs are run.  A rule is a regular
expression over the words joined by single spaces, and matches whole words.  Rules have a
priority (full notices over names with a version over bare names); a detection inside one of
the same or a higher priority is suppressed.

The rules come from a table of licenses and a few phrase forms, and from single notices.
More than two hundred rules result; ``rules()`` lists them.

Edge cases: a null text counts as empty (no words, empty labels, null places, score 0); very
long texts are scanned whole; repeated rows are scanned one by one; words are never cut, so
``admit licenses`` is no ``mit license``; other columns are ignored.
"""

from __future__ import annotations

import functools
import re

from pyspark.sql import Column, DataFrame, functions as F

from releasekit.llm.base import ascii_lower, let, query, table

SEPARATOR = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: Phrases of the base, with their labels, as the query's contract states them.
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: license id | regular expression of its name | keywords, of which any match holds one.  Fixed values: names as licenses use them.
LICENSES = """
mit|(?:the )?(?:mit|expat)| mit / expat 
apache-1.1|apache (?:software )?(?:license )?(?:version |v)?1 1|apache
apache-2.0|apache (?:software )?(?:license )?(?:version |v)?2(?: 0)?|apache
gpl-2.0|(?:gnu )?(?:general public license|gpl)(?: version| v|v)? ?2(?: 0)?| gpl/general public
gpl-3.0|(?:gnu )?(?:general public license|gpl)(?: version| v|v)? ?3(?: 0)?| gpl/general public
lgpl-2.1|(?:gnu )?(?:lesser general public license|lgpl)(?: version| v|v)? ?2 1|lgpl/lesser general
lgpl-3.0|(?:gnu )?(?:lesser general public license|lgpl)(?: version| v|v)? ?3(?: 0)?|lgpl/lesser general
agpl-3.0|(?:gnu )?(?:affero general public license|agpl)(?: version| v|v)? ?3(?: 0)?|agpl/affero
gfdl-1.3|(?:gnu )?(?:free documentation license|fdl|gfdl)(?: version| v|v)? ?1 3|fdl/free documentation
bsd-2-clause|(?:simplified bsd|bsd 2 clause|2 clause bsd|two clause bsd|freebsd)|bsd
bsd-3-clause|(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)|bsd
bsd-4-clause|(?:original bsd|bsd 4 clause|4 clause bsd)|bsd
0bsd|(?:zero clause bsd|0bsd|bsd zero clause)|bsd
isc|(?:the )?isc| isc 
zlib|zlib(?: libpng)?|zlib
mpl-1.1|(?:mozilla public license|mpl)(?: version| v|v)? ?1 1| mpl/mozilla
mpl-2.0|(?:mozilla public license|mpl)(?: version| v|v)? ?2(?: 0)?| mpl/mozilla
epl-1.0|(?:eclipse public license|epl)(?: version| v|v)? ?1(?: 0)?| epl/eclipse
epl-2.0|(?:eclipse public license|epl)(?: version| v|v)? ?2(?: 0)?| epl/eclipse
cddl-1.0|(?:common development and distribution license|cddl)(?: version| v|v)? ?1 0|cddl/common development
cddl-1.1|(?:common development and distribution license|cddl)(?: version| v|v)? ?1 1|cddl/common development
eupl-1.2|(?:european union public licen[cs]e|eupl)(?: version| v|v)? ?1 2|eupl/european union
artistic-1.0|artistic license (?:version |v)?1(?: 0)?|artistic
artistic-2.0|artistic license (?:version |v)?2(?: 0)?|artistic
bsl-1.0|boost software license(?: version| v)?(?: 1 0)?|boost software
unlicense|(?:the )?unlicense|unlicense
wtfpl|(?:wtfpl|do what the fuck you want to public license)|wtfpl/what the fuck
cc0-1.0|(?:cc0|creative commons zero)(?: 1 0)?(?: universal)?|cc0/commons zero
cc-by-3.0|(?:cc by|creative commons attribution) 3 0| cc by/creative commons
cc-by-4.0|(?:cc by|creative commons attribution) 4 0| cc by/creative commons
cc-by-sa-3.0|(?:cc by sa|creative commons attribution share ?alike) 3 0| cc by/creative commons
cc-by-sa-4.0|(?:cc by sa|creative commons attribution share ?alike) 4 0| cc by/creative commons
cc-by-nc-4.0|(?:cc by nc|creative commons attribution non ?commercial) 4 0| cc by/creative commons
cc-by-nd-4.0|(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s) 4 0| cc by/creative commons
cc-by-nc-sa-4.0|(?:cc by nc sa|creative commons attribution non ?commercial share ?alike) 4 0| cc by/creative commons
cc-by-nc-nd-4.0|(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s) 4 0| cc by/creative commons
odbl-1.0|(?:open database license|odbl)(?: v?1 0)?|odbl/open database
ofl-1.1|(?:sil open font license|ofl)(?: version)?(?: 1 1)?| ofl/open font
psf-2.0|python software foundation license(?: version)?(?: 2)?|python
ruby|ruby s license|ruby
postgresql|postgresql|postgresql
openssl|openssl|openssl
ncsa|(?:university of illinois ncsa|ncsa open source)|ncsa
x11|x11|x11
ms-pl|microsoft public license|microsoft
upl-1.0|universal permissive license(?: v1 0)?|universal
""".strip()

#: Phrase forms around a name: suffix of the rule, expression, priority, strength of evidence.
FORMS = (
    ("notice", "(?:is |are |be )?(?:re)?(?:licensed|released|distributed|available|redistribute(?:d)?) under (?:the )?(?:terms of )?(?:the )?{}(?: licen[cs]e)?", 3, 1.0),
    ("terms", "under the (?:terms|conditions) (?:and conditions )?of (?:the )?{}(?: licen[cs]e)?", 3, 0.95),
    ("spdx", "spdx license identifier {}", 3, 1.0),
    ("named", "{} licen[cs]e", 2, 0.8),
    ("labelled", "licen[cs]e {}", 2, 0.7),
    ("versioned", "{}(?! [0-9])", 2, 0.6),  # for names that hold a version, which must end there (no Apache 2.4)
)

#: Single notices: label | expression | keyword | priority | strength.  Fixed values.
NOTICES = """
mit|permission is hereby granted free of charge to any person obtaining a copy|hereby|4|1.0
mit|the software is provided as is without warranty of any kind express or implied|warranty|4|0.9
isc|permission to use copy modify and or distribute this software for any purpose with or without fee|permission|4|1.0
bsd|redistribution and use in source and binary forms with or without modification are permitted|redistribution|4|1.0
apache-2.0|you may not use this file except in compliance with the license|compliance|4|0.95
gpl|this program is free software you can redistribute it and or modify it under the terms of the gnu general public license|redistribute|4|1.0
gpl|either version [23] of the license or at your option any later version|option|4|0.95
lgpl|this library is free software you can redistribute it and or modify it|library|4|0.95
mpl-2.0|this source code form is subject to the terms of the mozilla public license v 2 0|mozilla|4|1.0
unlicense|this is free and unencumbered software released into the public domain|unencumbered|4|1.0
cc|this work is licensed under a creative commons|creative|3|0.9
cc-by-nc|cc by nc|by nc|2|0.7
cc-by-sa|cc by sa|by sa|2|0.7
cc-by-nd|cc by nd|by nd|2|0.7
cc-by|cc by|cc by|1|0.6
public-domain|(?:released into|dedicated to|in) the public domain|public domain|3|0.8
proprietary|all rights reserved|reserved|3|0.7
proprietary|proprietary and confidential|confidential|3|0.8
gpl|gnu gpl|gpl|1|0.6
lgpl|lesser general public license|lesser|2|0.7
agpl|affero general public license|affero|2|0.7
gfdl|free documentation license|documentation|2|0.7
mpl|mozilla public license|mozilla|1|0.6
epl|eclipse public license|eclipse|1|0.6
artistic|artistic license|artistic|1|0.6
bsd|bsd (?:style )?license|bsd|1|0.6
mit|mit style license|mit|1|0.6
cc|creative commons|creative|1|0.5
""".strip()

#: A text whose words hold none of these has no detection: every match holds one of them (the
#: last two lines are for names with a version, which stand without any other word).
GATES = ("licen", " under ", "permission ", "warranty ", "redistribution ", "redistribute ", " compliance ", " later version ", " cc by", "public domain", "rights reserved",
         "proprietary and ", " gnu gpl ", "creative commons", " by n", "unencumbered ", " this library ", " this source code ",
         "apache", " gpl", "lgpl", "agpl", "fdl", "bsd", " mpl", " epl",
         "cddl", "eupl", "cc0", "odbl", " ofl")


@functools.cache
def rules() -> tuple[tuple[str, str, str, int, float, bool], ...]:
    """``(label, expression, keywords joined by /, priority, strength, base)`` in order."""
    out = [(label, phrase, phrase, 1, 0.6, True) for phrase, label in BASE]
    for line in LICENSES.splitlines():
        label, name, keyword = line.split("|", 1)[0], line.split("|", 1)[1].rsplit("|", 1)[0], line.rsplit("|", 1)[1]
        spdx = label.replace("-", " ").replace(".", " ")
        out += [(label, form.format(f"(?:{spdx}|{name})" if n == "spdx" else f"(?:{name})"), "spdx" if n == "spdx" else keyword, p, s, False)
                for n, form, p, s in FORMS if n != "versioned" or re.search(r"-\d", label)]
    for line in NOTICES.splitlines():
        label, rest = line.split("|", 1)
        expression, keyword, priority, strength = rest.rsplit("|", 3)
        out.append((label, expression, keyword, int(priority), float(strength), False))
    return tuple(out)


def detections(joined: Column) -> Column:
    """All matches in words joined by single spaces, with one space before and after: array of
    ``start, end`` (words from 0, end exclusive), ``label``, ``priority``, ``strength``, ``base``.

    Each match is put between two control characters, which no word holds; the places of the
    words that carry them are the matches' places."""
    table_ = F.array(*(F.struct(F.lit(label).alias("label"), F.lit(f"(?<= )(?:{e})(?= )").alias("expression"), F.array(*(F.lit(x) for x in k.split("/"))).alias("keywords"),
                                F.lit(p).alias("priority"), F.lit(s).alias("strength"), F.lit(b).alias("base")) for label, e, k, p, s, b in rules()))

    def matches(rule: Column) -> Column:
        marked = F.split(F.trim(F.regexp_replace(joined, rule["expression"], F.lit("\x01$0\x02"))), " ")

        def places(words: Column) -> Column:
            at = lambda mark: F.filter(F.transform(words, lambda w, k: F.when(mark(w), k)), lambda k: k.isNotNull())
            return F.arrays_zip(at(lambda w: F.startswith(w, F.lit("\x01"))).alias("start"), at(lambda w: F.endswith(w, F.lit("\x02"))).alias("last"))

        return F.transform(let(marked, places), lambda x: F.struct(
            x["start"].alias("start"), (x["last"] + 1).alias("end"), rule["label"].alias("label"),
            rule["priority"].alias("priority"), rule["strength"].alias("strength"), rule["base"].alias("base")))

    gated = F.filter(table_, lambda r: F.exists(r["keywords"], lambda k: F.contains(joined, k)) & F.rlike(joined, r["expression"]))
    return F.flatten(F.transform(gated, matches))


def unsuppressed(found: Column) -> Column:
    """Detections that lie in no other of the same or a higher priority.  Sorted by start, the
    longest and the highest priority first, a container stands before what it contains, so one
    sweep with the furthest end per priority decides.  Equal intervals of one priority: the
    first label stays."""
    key = F.transform(found, lambda d: F.struct(d["start"], (-d["end"]).alias("back"), (-d["priority"]).alias("rank"), d["label"], d["strength"]))
    levels = (4, 3, 2, 1)

    def step(acc: Column, d: Column) -> Column:
        end, priority = -d["back"], -d["rank"]
        above = F.greatest(*(F.when(priority <= p, acc[f"e{p}"]).otherwise(F.lit(-1)) for p in levels))
        kept = above < end
        return F.struct(*(F.when(priority == p, F.greatest(acc[f"e{p}"], end)).otherwise(acc[f"e{p}"]).alias(f"e{p}") for p in levels),
                        F.when(kept, F.concat(acc["kept"], F.array(F.struct(d["label"].alias("label"), d["strength"].alias("strength"))))).otherwise(acc["kept"]).alias("kept"))

    none = F.expr("cast(array() as array<struct<label:string,strength:double>>)")
    start = F.struct(*(F.lit(-1).alias(f"e{p}") for p in levels), none.alias("kept"))
    return F.aggregate(F.array_sort(key), start, step, lambda a: a["kept"])


def scan_licenses(documents: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_words, base`` (array of start, label), ``found`` (array of
    label, strength).  One pass, no shuffle."""
    words = F.filter(F.split(ascii_lower(F.coalesce(F.col("text"), F.lit(""))), SEPARATOR), lambda w: w != "")
    first = documents.select("doc_id", words.alias("words")).select(
        "doc_id", F.size("words").cast("long").alias("n_words"), F.concat(F.lit(" "), F.array_join("words", " "), F.lit(" ")).alias("joined"))
    gate = functools.reduce(lambda a, b: a | b, (F.contains(F.col("joined"), F.lit(g)) for g in GATES))
    second = first.select("doc_id", "n_words", F.when(gate, let(F.col("joined"), detections)).alias("all"))
    return second.select(
        "doc_id", "n_words",
        F.transform(F.filter("all", lambda d: d["base"]), lambda d: F.struct(d["start"].alias("start"), d["label"].alias("label"))).alias("base"),
        let(F.col("all"), unsuppressed).alias("found"))


@query("op9_license_scan")
def op9_license_scan(spark, sf_dir):
    scanned = scan_licenses(table(spark, sf_dir, "documents"))
    label = lambda c: F.transform(c, lambda d: d["label"])
    text = lambda c: F.array_join(F.array_sort(F.array_distinct(c)), ",")
    some = lambda c: F.coalesce(c, F.lit(""))
    starts = F.transform("base", lambda d: d["start"])
    return scanned.select(
        "doc_id", "n_words", F.when(F.col("base").isNull(), 0).otherwise(F.size("base")).cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        some(text(label(F.col("base")))).alias("base_labels"),
        some(text(F.concat(label(F.col("base")), label(F.col("found"))))).alias("labels"),
        F.coalesce(F.array_max(F.transform("found", lambda d: d["strength"])), F.lit(0.0)).alias("score"))
