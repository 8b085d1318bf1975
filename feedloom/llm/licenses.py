"""Licence mentions by ordered signature rules.

A rule is a regular expression over the words of a text (lower case, joined by single
spaces), with a label, a priority and the keywords without which it cannot match. Rules
whose keywords a text lacks are not tried. Detections of all rules are then put in order
(priority, longer first, earlier first), and one that lies inside an accepted one is
suppressed: "mit license" inside the full permission notice, or a bare family name
inside a name with its version. The base phrases fixed by the task are always kept.

The score of a text is 1 - product(1 - confidence of each label it has).

Defined cases: a null text is an empty one, without detections and with score 0; a null
doc_id is a value like others; ties of detections go by label; repeated rows give
repeated results; further columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import functools
import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from feedloom.llm.common import sliced, text_of

# Fixed by the task: phrases that always count, and their labels.
BASE = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    priority: int
    confidence: float
    keywords: tuple[str, ...]


#: Sentences that only the text of a licence has: label and pattern.
NOTICES = (
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("mit", r"the software is provided as is without warranty of any kind express or implied"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification"),
    ("bsd", r"redistributions of source code must retain the above copyright notice"),
    ("bsd", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", r"neither the name of (?:\S+ ){1,12}nor the names of its contributors"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software"),
    ("apache-2.0", r"you may not use this file except in compliance with the license"),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing software distributed"),
    ("apache-2.0", r"www apache org licenses license 2 0(?: txt| html)?"),
    ("apache-1.1", r"this product includes software developed by the apache software foundation"),
    ("gpl", r"this program is free software you can redistribute it and or modify it"),
    ("gpl", r"you should have received a copy of the gnu general public licen[sc]e"),
    ("gpl-3.0-or-later", r"either version 3 of the license or at your option any later version"),
    ("gpl-2.0-or-later", r"either version 2 of the license or at your option any later version"),
    ("lgpl", r"this library is free software you can redistribute it and or modify it"),
    ("lgpl", r"you should have received a copy of the gnu (?:lesser|library) general public licen[sc]e"),
    ("lgpl-2.1-or-later", r"either version 2 1 of the license or at your option any later version"),
    ("agpl", r"you should have received a copy of the gnu affero general public licen[sc]e"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors"),
    ("boost-1.0", r"permission is hereby granted free of charge to any person or organization obtaining a copy"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document"),
    ("cc0-1.0", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("public-domain", r"(?:is|are|been|released|placed|dedicated) (?:in|into|to) the public domain"),
    ("proprietary", r"all rights reserved"),
    ("proprietary", r"proprietary and confidential"),
    ("proprietary", r"unauthori[sz]ed copying (?:of this file )?(?:via any medium )?is (?:strictly )?prohibited"),
    ("postgresql", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee"),
    ("openssl", r"this product includes software developed by the openssl project"),
    ("python", r"python software foundation license(?: version 2)?"),
)

#: Licence families: label, how the name is written, identifier stem, versions.
FAMILIES = (
    ("gpl", r"(?:gnu )?general public licen[sc]e", "gpl", ("1 0", "2 0", "3 0")),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public licen[sc]e", "lgpl", ("2 0", "2 1", "3 0")),
    ("agpl", r"(?:gnu )?affero general public licen[sc]e", "agpl", ("1 0", "3 0")),
    ("gfdl", r"(?:gnu )?free documentation licen[sc]e", "gfdl", ("1 1", "1 2", "1 3")),
    ("apache", r"apache(?: software)? licen[sc]e", "apache", ("1 0", "1 1", "2 0")),
    ("mpl", r"mozilla public licen[sc]e", "mpl", ("1 0", "1 1", "2 0")),
    ("epl", r"eclipse public licen[sc]e", "epl", ("1 0", "2 0")),
    ("cpl", r"common public licen[sc]e", "cpl", ("1 0",)),
    ("cddl", r"common development and distribution licen[sc]e", "cddl", ("1 0", "1 1")),
    ("eupl", r"european union public licen[sc]e", "eupl", ("1 0", "1 1", "1 2")),
    ("osl", r"open software licen[sc]e", "osl", ("1 0", "2 0", "2 1", "3 0")),
    ("afl", r"academic free licen[sc]e", "afl", ("1 1", "1 2", "2 0", "2 1", "3 0")),
    ("artistic", r"artistic licen[sc]e", "artistic", ("1 0", "2 0")),
    ("cecill", r"cecill (?:free software )?licen[sc]e", "cecill", ("1 0", "1 1", "2 0", "2 1")),
    ("ms-pl", r"microsoft public licen[sc]e", "ms pl", ()),
    ("ms-rl", r"microsoft reciprocal licen[sc]e", "ms rl", ()),
    ("ibm-pl", r"ibm public licen[sc]e", "ipl", ("1 0",)),
    ("sun-pl", r"sun public licen[sc]e", "spl", ("1 0",)),
    ("npl", r"netscape public licen[sc]e", "npl", ("1 0", "1 1")),
    ("qpl", r"q public licen[sc]e", "qpl", ("1 0",)),
    ("lppl", r"latex project public licen[sc]e", "lppl", ("1 0", "1 1", "1 2", "1 3")),
    ("ofl", r"(?:sil )?open font licen[sc]e", "ofl", ("1 0", "1 1")),
    ("odbl", r"open (?:data commons )?(?:open )?database licen[sc]e", "odbl", ("1 0",)),
    ("odc-by", r"open data commons attribution licen[sc]e", "odc by", ("1 0",)),
    ("bsl", r"boost software licen[sc]e", "bsl", ("1 0",)),
    ("busl", r"business source licen[sc]e", "busl", ("1 1",)),
    ("sspl", r"server side public licen[sc]e", "sspl", ("1 0",)),
    ("elastic", r"elastic licen[sc]e", "elastic", ("2 0",)),
    ("mit", r"(?:the )?mit (?:x11 )?licen[sc]e", "mit", ()),
    ("x11", r"x11 licen[sc]e", "x11", ()),
    ("isc", r"isc licen[sc]e", "isc", ()),
    ("zlib", r"zlib(?: libpng)? licen[sc]e", "zlib", ()),
    ("bsd", r"(?:new |modified |simplified |original |revised )?bsd licen[sc]e", "bsd", ()),
    ("bsd-2-clause", r"bsd 2 clause(?: simplified)?(?: licen[sc]e)?", "bsd 2 clause", ()),
    ("bsd-3-clause", r"bsd 3 clause(?: new| revised)?(?: licen[sc]e)?", "bsd 3 clause", ()),
    ("bsd-4-clause", r"bsd 4 clause(?: original)?(?: licen[sc]e)?", "bsd 4 clause", ()),
    ("0bsd", r"zero clause bsd(?: licen[sc]e)?", "0bsd", ()),
    ("ncsa", r"(?:university of illinois )?ncsa open source licen[sc]e", "ncsa", ()),
    ("unlicense", r"the unlicense", "unlicense", ()),
    ("wtfpl", r"do what the fuck you want to public licen[sc]e", "wtfpl", ()),
    ("php", r"php licen[sc]e", "php", ("3 0", "3 01")),
    ("ruby", r"ruby licen[sc]e", "ruby", ()),
    ("python", r"python licen[sc]e", "python", ("2 0",)),
    ("postgresql", r"postgresql licen[sc]e", "postgresql", ()),
    ("openssl", r"openssl licen[sc]e", "openssl", ()),
    ("curl", r"curl licen[sc]e", "curl", ()),
    ("ecl", r"educational community licen[sc]e", "ecl", ("1 0", "2 0")),
    ("upl", r"universal permissive licen[sc]e", "upl", ("1 0",)),
    ("blueoak", r"blue oak model licen[sc]e", "blueoak", ("1 0 0",)),
    ("mulan", r"mulan permissive software licen[sc]e", "mulanpsl", ("1 0", "2 0")),
    ("cc-by-sa", r"(?:creative commons|cc) (?:attribution share ?alike|by sa)", "cc by sa", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc", r"(?:creative commons|cc) (?:attribution non ?commercial|by nc)", "cc by nc", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nd", r"(?:creative commons|cc) (?:attribution no ?deriv(?:ative)?s?(?: works)?|by nd)", "cc by nd", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-sa", r"(?:creative commons|cc) (?:attribution non ?commercial share ?alike|by nc sa)", "cc by nc sa", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by-nc-nd", r"(?:creative commons|cc) (?:attribution non ?commercial no ?deriv(?:ative)?s?|by nc nd)", "cc by nc nd", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc-by", r"(?:creative commons|cc) (?:attribution|by)", "cc by", ("1 0", "2 0", "2 5", "3 0", "4 0")),
    ("cc0", r"(?:(?:creative commons|cc) zero|cc0)", "cc0", ("1 0",)),
)


def _keyword(pattern: str) -> str:
    """The longest literal text that every match of the pattern has."""
    plain = re.sub(r"\((?:[^()]|\([^()]*\))*\)[?*]?(?:\{[^}]*\})?", "\0", pattern)
    plain = re.sub(r"\[[^]]*\]|.\?", "\0", plain)
    return max(plain.split("\0"), key=len)


def _version(version: str) -> tuple[str, str]:
    """A pattern for a version and its name with dots; a last zero may be left out."""
    parts = version.split()
    tail = rf"(?: {parts[-1]})?" if parts[-1] == "0" and len(parts) == 2 else f" {parts[-1]}"
    return " ".join(parts[:-1]) + tail, ".".join(parts)


@functools.lru_cache(1)
def rules() -> tuple[Rule, ...]:
    """All rules by priority: notices, identifiers, names with version, names."""
    made = [Rule(label, pattern, 0, 0.95, (_keyword(pattern),)) for label, pattern in NOTICES]
    for label, name, stem, versions in FAMILIES:
        keys = (" creative commons ", " cc") if "commons|cc" in name else (_keyword(name),)
        tags = [(label, stem)]
        for version in versions:
            number, dotted = _version(version)
            found = f"{label}-{dotted}"
            tags.append((found, f"{stem} {number}"))
            written = rf"{name}(?: international| unported)? (?:version |v ?)?{number}"
            made.append(Rule(found, written, 2, 0.9, keys))
            made.append(Rule(found, rf"{stem} ?(?:version |v ?)?{number}", 3, 0.7, (f" {stem}",)))
        for found, tag in tags:
            spdx = "spdx license identifier "
            made.append(Rule(found, rf"{spdx}{tag}(?: only| or later)?", 1, 0.99, (spdx,)))
        terms = r"(?:licen[sc]ed|released|distributed|available) under (?:the )?(?:terms of (?:the )?)?"
        made.append(Rule(label, terms + name, 3, 0.85, keys))
        made.append(Rule(label, name, 4, 0.6, keys))
    return tuple(sorted(made, key=lambda rule: rule.priority))


#: Words, with all else a space, in UTF-8: digits, a-z and bytes of other characters.
_TO_WORDS = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 32
    for b in range(256)
)


@functools.lru_cache(1)
def _compiled():
    """(rule, compiled) grouped by the keywords, any of which a text must have."""
    groups: dict[tuple[bytes, ...], list] = {}
    for rule in rules():
        keys = tuple(key.encode() for key in rule.keywords)
        compiled = re.compile(rf"(?<= ){rule.pattern}(?= )".encode())
        groups.setdefault(keys, []).append((rule, compiled))
    return list(groups.items()), [(f" {phrase} ".encode(), label) for phrase, label in BASE]


def scan(words: bytes) -> tuple[list[tuple[int, str]], list[tuple[int, int, str, float]]]:
    """Base places (start, label) and accepted detections (start, end, label, confidence).

    ``words``: all words, joined by spaces, with a space before and after; places are
    offsets in it.
    """
    groups, base = _compiled()
    places = []
    for phrase, label in base:
        at = words.find(phrase)
        while at >= 0:
            places.append((at + 1, label))
            at = words.find(phrase, at + 1)
    found = [
        (rule.priority, m.start() - m.end(), m.start(), rule.label, m.end(), rule.confidence)
        for keys, group in groups
        if any(key in words for key in keys)
        for rule, compiled in group
        for m in compiled.finditer(words)
    ]
    return sorted(places), _accept(sorted(found))


def _accept(found: list[tuple]) -> list[tuple[int, int, str, float]]:
    """Detections, best first, without those inside one that is accepted.

    ``starts`` and ``ends`` are the accepted intervals that no other accepted one
    contains; both grow along the lists, so one look-up tells whether a new one is inside.
    """
    accepted, starts, ends = [], [], []
    for _, _, start, label, end, confidence in found:
        i = bisect_right(starts, start)
        if i and ends[i - 1] >= end:
            continue
        accepted.append((start, end, label, confidence))
        i = bisect_left(starts, start)
        j = i
        while j < len(ends) and ends[j] <= end:
            j += 1
        starts[i:j], ends[i:j] = [start], [end]
    return sorted(accepted)


_BASE = pa.list_(pa.struct([("word", pa.int32()), ("label", pa.string())]))
_FOUND = pa.list_(pa.struct([
    ("first", pa.int32()), ("last", pa.int32()), ("label", pa.string()), ("confidence", pa.float64()),
]))


def _run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in sliced(batches):
        counts, base, found = [], [], []
        for text in batch["text"].cast(pa.binary()).to_pylist():
            split = text.translate(_TO_WORDS).split(b" ")
            split = [word for word in split if word]
            words = b" %b " % b" ".join(split)
            places, detections = scan(words)
            at = lambda offset, words=words: words.count(b" ", 0, offset) - 1
            counts.append(len(split))
            base.append([{"word": at(start), "label": label} for start, label in places])
            found.append([
                {"first": at(start), "last": at(end), "label": label, "confidence": confidence}
                for start, end, label, confidence in detections
            ])
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(counts, pa.int64()), pa.array(base, _BASE), pa.array(found, _FOUND)],
            ["doc_id", "n_words", "base", "detections"],
        )


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, base (word, label) and detections (first, last, label, confidence)
    of every row; first and last are words, last included."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).mapInArrow(
        _run,
        "doc_id long, n_words long, base array<struct<word:int,label:string>>,"
        "detections array<struct<first:int,last:int,label:string,confidence:double>>",
    )


def summarise(found: DataFrame) -> DataFrame:
    """Counts, labels and score of every row that ``detect`` gave."""
    labels = lambda spans: F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"])))
    base = labels("base")
    everything = F.array_sort(F.array_union(base, labels("detections")))
    # The best confidence of each label; a base phrase alone has 0.6.
    confident = F.transform(everything, lambda label: F.greatest(
        F.when(F.array_contains(base, label), 0.6).otherwise(0.0),
        F.coalesce(F.array_max(F.transform(
            F.filter("detections", lambda d: d["label"] == label), lambda d: d["confidence"]
        )), F.lit(0.0)),
    ))
    words = F.transform("base", lambda s: s["word"].cast("long"))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(words).alias("first_word"), F.array_max(words).alias("last_word"),
        F.array_join(base, ",").alias("base_labels"), F.array_join(everything, ",").alias("labels"),
        (1 - F.aggregate(confident, F.lit(1.0), lambda left, c: left * (1 - c))).alias("score"),
    )
