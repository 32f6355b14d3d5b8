"""License scan by ordered signature rules, in DataFrame expressions only.

Rules are regular expressions over the words of a text, joined by single spaces. A license
has a row below; templates turn each row into rules: tags, grants, plain names, addresses.
Their order is their priority. A text is looked at only if a cheap pattern finds license
vocabulary in it, and a rule runs only on texts that contain its keyword. Detections are
then resolved from left to right: one inside another is suppressed, equal intervals go to
the rule of higher priority, and of two that overlap in part the higher priority stays.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Phrases whose places are counted, with their labels.
BASE = (
    ("under the mit license", "mit"),
    ("apache license version 2", "apache-2"),
    ("cc by nc", "cc-by-nc"),
)

# Label, keyword (a word of every form), the name's words as a pattern, the tag's words.
LICENSES = (
    ("mit", "mit", "mit", "mit"),
    ("apache-2", "apache", "apache(?: software)?(?: license)?(?: version)? v?2(?: 0)?", "apache 2 0"),
    ("apache-1.1", "apache", "apache(?: software)?(?: license)?(?: version)? v?1 1", "apache 1 1"),
    ("bsd-2-clause", "bsd", "(?:simplified bsd|bsd 2 clause|2 clause bsd|freebsd)", "bsd 2 clause"),
    ("bsd-3-clause", "bsd", "(?:new bsd|modified bsd|bsd 3 clause|3 clause bsd)", "bsd 3 clause"),
    ("bsd-4-clause", "bsd", "(?:original bsd|bsd 4 clause|4 clause bsd)", "bsd 4 clause"),
    ("gpl-2", "2", "(?:gnu )?(?:gpl|general public license)(?: version)? v?2(?: 0)?", "gpl 2 0(?: only| or later)?"),
    ("gpl-3", "3", "(?:gnu )?(?:gpl|general public license)(?: version)? v?3(?: 0)?", "gpl 3 0(?: only| or later)?"),
    ("lgpl-2.1", "2", "(?:gnu )?(?:lgpl|lesser general public license)(?: version)? v?2 1", "lgpl 2 1(?: only| or later)?"),
    ("lgpl-3", "3", "(?:gnu )?(?:lgpl|lesser general public license)(?: version)? v?3(?: 0)?", "lgpl 3 0(?: only| or later)?"),
    ("agpl-3", "3", "(?:gnu )?(?:agpl|affero general public license)(?: version)? v?3(?: 0)?", "agpl 3 0(?: only| or later)?"),
    ("gfdl", "free", "(?:gnu )?free documentation license(?: version 1 [1-3])?", "gfdl 1 [1-3](?: only| or later)?"),
    ("mpl-1.1", "1", "(?:mozilla public license|mpl)(?: version)? v?1 1", "mpl 1 1"),
    ("mpl-2", "2", "(?:mozilla public license|mpl)(?: version)? v?2(?: 0)?", "mpl 2 0"),
    ("epl-1", "1", "(?:eclipse public license|epl)(?: version)? v?1(?: 0)?", "epl 1 0"),
    ("epl-2", "2", "(?:eclipse public license|epl)(?: version)? v?2(?: 0)?", "epl 2 0"),
    ("cddl-1", "1", "(?:common development and distribution license|cddl)(?: version)? v?1(?: [01])?", "cddl 1 [01]"),
    ("cpl-1", "1", "(?:common public license|cpl)(?: version)? v?1(?: 0)?", "cpl 1 0"),
    ("isc", "isc", "isc", "isc"),
    ("zlib", "zlib", "zlib(?: libpng)?", "zlib"),
    ("bsl-1", "boost", "boost software(?: license)?(?: version)?(?: v?1(?: 0)?)?", "bsl 1 0"),
    ("unlicense", "unlicense", "unlicense", "unlicense"),
    ("wtfpl", "wtfpl", "wtfpl", "wtfpl"),
    ("artistic-1", "artistic", "artistic license(?: version)? v?1(?: 0)?", "artistic 1 0(?: perl)?"),
    ("artistic-2", "artistic", "artistic license(?: version)? v?2(?: 0)?", "artistic 2 0"),
    ("python-2", "python", "python software foundation(?: license)?", "(?:python|psf) 2 0"),
    ("php-3", "php", "php license(?: version)?(?: v?3(?: 0[01]?)?)?", "php 3 0[01]?"),
    ("ruby", "ruby", "ruby(?: s)?", "ruby"),
    ("openssl", "openssl", "openssl", "openssl"),
    ("postgresql", "postgresql", "postgresql", "postgresql"),
    ("ncsa", "ncsa", "(?:university of illinois )?ncsa(?: open source)?", "ncsa"),
    ("x11", "x11", "(?:x11|mit x11)", "x11"),
    ("afl-3", "academic", "academic free license(?: version)?(?: v?3(?: 0)?)?", "afl 3 0"),
    ("osl-3", "open", "open software license(?: version)?(?: v?3(?: 0)?)?", "osl 3 0"),
    ("eupl-1.2", "union", "european union public licen[cs]e(?: version)?(?: v?1 [12])?", "eupl 1 [12]"),
    ("cecill-2.1", "cecill", "cecill(?: version)?(?: 2(?: [01])?)?", "cecill 2 [01]"),
    ("ofl-1.1", "font", "(?:sil )?open font license(?: version)?(?: 1 1)?", "ofl 1 1"),
    ("odbl-1", "database", "open (?:data commons open )?database license(?: version)?(?: 1 0)?", "odbl 1 0"),
    ("upl-1", "universal", "universal permissive license(?: version)?(?: 1 0)?", "upl 1 0"),
    ("ms-pl", "microsoft", "microsoft public license", "ms pl"),
    ("ms-rl", "microsoft", "microsoft reciprocal license", "ms rl"),
    ("sspl-1", "server", "server side public license(?: version)?(?: 1)?", "sspl 1 0"),
    ("busl-1.1", "business", "business source license(?: version)?(?: 1 1)?", "busl 1 1"),
    ("elastic-2", "elastic", "elastic license(?: version)?(?: 2(?: 0)?)?", "elastic 2 0"),
    ("cc0", "cc0", "cc0(?: 1 0)?(?: universal)?", "cc0 1 0"),
    ("cc-by", "attribution", "creative commons attribution(?: [1-4] 0)?", "cc by [1-4] 0"),
    ("cc-by-sa", "by", "(?:cc|creative commons) by sa(?: [1-4] 0)?", "cc by sa [1-4] 0"),
    ("cc-by-nd", "by", "(?:cc|creative commons) by nd(?: [1-4] 0)?", "cc by nd [1-4] 0"),
    ("cc-by-nc", "by", "(?:cc|creative commons) by nc(?: [1-4] 0)?", "cc by nc [1-4] 0"),
    ("cc-by-nc-sa", "by", "(?:cc|creative commons) by nc sa(?: [1-4] 0)?", "cc by nc sa [1-4] 0"),
    ("cc-by-nc-nd", "by", "(?:cc|creative commons) by nc nd(?: [1-4] 0)?", "cc by nc nd [1-4] 0"),
)

# Pattern around a name or tag, and the confidence it earns; earlier ones have priority.
TAG = (("spdx license identifier {tag}", 0.99), ("license {tag}", 0.7))
NAMED = (
    ("(?:licen[sc]ed|released|distributed|published|available) under (?:the )?(?:terms of (?:the )?)?{name}(?: licen[sc]e)?", 0.95),
    ("under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{name}(?: licen[sc]e)?", 0.9),
    ("(?:subject to|governed by|covered by) (?:the )?{name}(?: licen[sc]e)?", 0.85),
    ("{name} licen[sc]e", 0.8),
    ("opensource org licenses {tag}", 0.9),
)
# Rules that name no license of the table.
GENERAL = (
    ("all-rights-reserved", "reserved", "all rights reserved", 0.6),
    ("public-domain", "domain", "(?:in|into|to) the public domain", 0.8),
    ("proprietary", "proprietary", "(?:proprietary and confidential|confidential and proprietary)", 0.7),
    ("copyright-notice", "copyright", "copyright (?:c )?(?:19|20)[0-9]{2}", 0.4),
    ("copyleft", "copyleft", "copyleft", 0.4),
    ("no-license", "without", "used without permission", 0.4),
    ("permission-notice", "permission", "permission is hereby granted free of charge", 0.6),
    ("redistribution", "redistribution", "redistribution and use in source and binary forms", 0.6),
    ("non-commercial", "commercial", "for non ?commercial use only", 0.6),
    ("see-license", "license", "see (?:the )?license (?:file )?for (?:more )?details", 0.3),
)

# What stands between words; letters keep their case.
GAPS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Every match of every rule contains one of these, or "cc" and "by" with a gap between.
GATE = (
    "license", "licence", "copyright", "copyleft", "reserved", "proprietary", "confidential", "permission",
    "redistribution", "commercial", "domain", "under", "subject", "governed", "covered",
)
BY_GATE = r"(?i)cc[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+by"


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: str
    confidence: float


def _literal_start(pattern: str) -> str:
    """The text with which every match of a pattern begins."""
    start = re.match(r"[a-z0-9 ]*", pattern)[0]
    return start[:-1] if pattern[len(start) : len(start) + 1] in ("?", "*") else start


def all_rules() -> list[Rule]:
    """Rules by priority: the base phrases, then template by template."""
    rules = [Rule(label, phrase, phrase, 0.9) for phrase, label in BASE]
    for template, confidence in (*TAG[:1], *NAMED, *TAG[1:]):
        for label, keyword, name, tag in LICENSES:
            pattern = template.format(name=name, tag=tag)
            start = _literal_start(pattern)
            rules.append(Rule(label, start if len(start) > len(keyword) else keyword, pattern, confidence))
    rules += [Rule(label, keyword, pattern, confidence) for label, keyword, pattern, confidence in GENERAL]
    return rules


def _rule_array(rules: list[Rule]) -> Column:
    return F.array(
        *(
            F.struct(
                F.lit(rule.keyword).alias("keyword"),
                F.lit(f" (?:{rule.pattern})(?= )").alias("pattern"),
                F.lit(number).alias("priority"),
                F.lit(rule.label).alias("label"),
                F.lit(rule.confidence).alias("confidence"),
            )
            for number, rule in enumerate(rules)
        )
    )


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _places(words: Column, match: Column) -> Column:
    """Intervals of words [start, end) where a rule matches.

    What lies between matches and the matches themselves add up to the text. A match
    starts with the space before its first word, so spaces number the words.
    """
    rule = match["rule"]
    between = F.transform(F.split(words, rule["pattern"], -1), _spaces)
    inside = F.transform(match["found"], _spaces)
    begin = F.aggregate(
        F.arrays_zip(between.alias("gap"), F.coalesce(inside, F.array().cast("array<int>")).alias("own")),
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,back:int>>").alias("found")),
        lambda held, step: F.struct(
            (held["at"] + step["gap"] + F.coalesce(step["own"], F.lit(0))).alias("at"),
            F.when(step["own"].isNull(), held["found"])
            .otherwise(
                F.concat(
                    held["found"],
                    F.array(
                        F.struct(
                            (held["at"] + step["gap"]).alias("start"),
                            (-(held["at"] + step["gap"] + step["own"])).alias("back"),
                        )
                    ),
                )
            )
            .alias("found"),
        ),
        lambda held: held["found"],
    )
    return F.transform(
        begin,
        lambda place: F.struct(
            place["start"].alias("start"),
            place["back"].alias("back"),  # minus the end: longer intervals sort first
            rule["priority"].alias("priority"),
            rule["label"].alias("label"),
            rule["confidence"].alias("confidence"),
        ),
    )


_FOUND = "array<struct<start:int,back:int,priority:int,label:string,confidence:double>>"


def _resolved(places: Column) -> Column:
    """Suppress contained intervals, then the weaker of two that overlap in part."""

    def step(held: Column, new: Column) -> Column:
        last = F.try_element_at(held, F.lit(-1))
        contained = -new["back"] <= -last["back"]
        overlaps = new["start"] < -last["back"]
        stronger = new["priority"] < last["priority"]
        without_last = F.slice(held, F.lit(1), F.greatest(F.size(held) - 1, F.lit(0)))
        return (
            F.when(F.size(held) == 0, F.array(new))
            .when(contained, held)
            .when(overlaps & stronger, F.concat(without_last, F.array(new)))
            .when(overlaps, held)
            .otherwise(F.concat(held, F.array(new)))
        )

    return F.aggregate(F.array_sort(places), F.array().cast(_FOUND), step)


def scan_licenses(documents: DataFrame, ident: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each row of ``documents``.

    ident, n_words, n_base, first_word, last_word, base_labels, labels, score, and
    ``detections``: array of (start, end, label, confidence) after resolution, words from 0.

    * A null text is empty: no words, no labels, score 0. The score is the best confidence.
    * Base labels are given wherever a base phrase stands, resolved away or not.
    * Repeated rows give repeated results; other columns are ignored. Texts are read whole,
      whatever their length. An empty table gives no rows.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    spaced = F.trim(F.regexp_replace(value, GAPS, " "))
    lowered = F.lower(value)
    gate = reduce(Column.__or__, [F.contains(lowered, F.lit(word)) for word in GATE])
    gate = gate | (F.contains(lowered, F.lit("cc")) & value.rlike(BY_GATE))
    plain = F.translate(F.col("spaced"), _UPPER, _LOWER)
    rules = _rule_array(all_rules())
    rows = documents.select(F.col(ident).alias("id"), spaced.alias("spaced"), gate.alias("gate")).select(
        "id",
        F.when(F.col("spaced") == "", 0).otherwise(_spaces(F.col("spaced")) + 1).cast("long").alias("n_words"),
        F.when(F.col("gate"), F.concat(F.lit(" "), plain, F.lit(" "))).alias("words"),
    )
    able = F.filter(F.col("rules"), lambda rule: F.contains(F.col("words"), rule["keyword"]))
    found = F.transform(
        able,
        lambda rule: F.struct(
            rule.alias("rule"), F.regexp_extract_all(F.col("words"), rule["pattern"], F.lit(0)).alias("found")
        ),
    )
    matches = F.filter(found, lambda match: F.size(match["found"]) > 0)
    places = F.flatten(F.transform(matches, lambda match: _places(F.col("words"), match)))
    rows = rows.withColumn("rules", F.when(F.col("words").isNotNull(), rules))
    rows = rows.withColumn("places", F.coalesce(places, F.array().cast(_FOUND)))
    base = F.filter("places", lambda place: place["priority"] < len(BASE))
    rows = rows.select("id", "n_words", base.alias("base"), _resolved(F.col("places")).alias("found"))
    base_labels = F.array_sort(F.array_distinct(F.transform("base", lambda place: place["label"])))
    own = F.transform("found", lambda place: place["label"])
    labels = F.array_sort(F.array_distinct(F.concat(own, F.transform("base", lambda place: place["label"]))))
    best = F.array_max(F.transform(F.concat("found", "base"), lambda place: place["confidence"]))
    starts = F.transform("base", lambda place: place["start"].cast("long"))
    return rows.select(
        F.col("id").alias(ident),
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(base_labels, ",").alias("base_labels"),
        F.array_join(labels, ",").alias("labels"),
        F.coalesce(best, F.lit(0.0)).alias("score"),
        F.transform(
            "found",
            lambda place: F.struct(
                place["start"].alias("start"), (-place["back"]).alias("end"), place["label"].alias("label"),
                place["confidence"].alias("confidence"),
            ),
        ).alias("detections"),
    )
