"""License scans: ordered signature rules over normalised words.

A text is lower-cased (A-Z) and cut into words of digits, letters and non-ASCII characters. A rule is a regex over the
words joined by single spaces, with a label, a priority and a keyword: its regex runs only where the keyword occurs.
Rules are ordered by priority; a detection is suppressed if one of the same or a higher priority contains it, so a full
notice outweighs the short name inside it. The three base rules are never suppressed, and every place of theirs counts.

The score is the confidence of the best detection: 0.95 for identifiers, 0.9 for notices, 0.8 for base phrases, 0.6 for
named licenses, 0.4 for copyright lines, 0 without any. Null and empty texts have no words and no detections.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sluicebox.llm.common import raw, table

BASE = (("cc-by", b"cc by"), ("gpl", b"general public license"), ("reserved", b"all rights reserved"))

# Names of licenses as regexes over words: label, keyword, pattern. The forms below make the signatures.
NAMES = """
apache-2.0|apache|apache(?: software)? license(?: version)? 2(?: 0)?
apache-2.0|apache|apache 2 0
apache-1.1|apache|apache(?: software)? license(?: version)? 1 1
mit|mit|mit(?: expat)? licen[cs]e
bsd-2-clause|bsd|(?:bsd 2 clause|2 clause bsd|simplified bsd|freebsd)(?: license)?
bsd-3-clause|bsd|(?:bsd 3 clause|3 clause bsd|new bsd|revised bsd|modified bsd)(?: license)?
bsd-4-clause|bsd|(?:bsd 4 clause|4 clause bsd|original bsd)(?: license)?
bsd|bsd|bsd(?: style)? license
isc|isc|isc(?: license)?
gpl-1.0|gnu|gnu general public license(?: gpl)?(?: version| v)? v?1(?: 0)?
gpl-2.0|gnu|gnu general public license(?: gpl)?(?: version| v)? v?2(?: 0)?
gpl-3.0|gnu|gnu general public license(?: gpl)?(?: version| v)? v?3(?: 0)?
lgpl-2.0|gnu|gnu library general public license(?: version| v)? v?2(?: 0)?
lgpl-2.1|gnu|gnu lesser general public license(?: version| v)? v?2 1
lgpl-3.0|gnu|gnu lesser general public license(?: version| v)? v?3(?: 0)?
agpl-3.0|affero|(?:gnu )?affero general public license(?: version| v)? v?3(?: 0)?
gfdl-1.3|documentation|(?:gnu )?free documentation license(?: version| v)?(?: 1)?(?: 3)?
gpl-2.0|gpl|gpl ?v? ?2(?: 0)?
gpl-3.0|gpl|gpl ?v? ?3(?: 0)?
lgpl-2.1|lgpl|lgpl ?v? ?2 1
lgpl-3.0|lgpl|lgpl ?v? ?3(?: 0)?
agpl-3.0|agpl|agpl ?v? ?3(?: 0)?
mpl-1.1|mpl|mpl 1 1
mpl-2.0|mpl|mpl 2 0
epl-1.0|epl|epl 1 0
epl-2.0|epl|epl 2 0
mpl-1.1|mozilla|mozilla public license(?: version| v)? v?1 1
mpl-2.0|mozilla|mozilla public license(?: version| v)? v?2(?: 0)?
epl-1.0|eclipse|eclipse public license(?: version| v)? v?1(?: 0)?
epl-2.0|eclipse|eclipse public license(?: version| v)? v?2(?: 0)?
cddl-1.0|distribution|common development and distribution license(?: version)?(?: 1 0)?
cpl-1.0|common|common public license(?: version)?(?: 1 0)?
eupl-1.2|european|european union public licen[cs]e(?: version| v)?(?: 1 2)?
cc0-1.0|cc0|(?:creative commons )?cc0(?: 1 0)?(?: universal)?
cc-by-1.0|cc|cc by 1 0
cc-by-2.0|cc|cc by 2 0
cc-by-2.5|cc|cc by 2 5
cc-by-3.0|cc|cc by 3 0
cc-by-4.0|cc|cc by 4 0
cc-by-sa-2.0|cc|cc by sa 2 0
cc-by-sa-3.0|cc|cc by sa 3 0
cc-by-sa-4.0|cc|cc by sa 4 0
cc-by-nc-2.0|cc|cc by nc 2 0
cc-by-nc-3.0|cc|cc by nc 3 0
cc-by-nc-4.0|cc|cc by nc 4 0
cc-by-nd-3.0|cc|cc by nd 3 0
cc-by-nd-4.0|cc|cc by nd 4 0
cc-by-nc-sa-3.0|cc|cc by nc sa 3 0
cc-by-nc-sa-4.0|cc|cc by nc sa 4 0
cc-by-nc-nd-3.0|cc|cc by nc nd 3 0
cc-by-nc-nd-4.0|cc|cc by nc nd 4 0
cc-by-4.0|commons|creative commons attribution 4 0(?: international)?
cc-by-3.0|commons|creative commons attribution 3 0(?: unported)?
cc-by-sa-4.0|commons|creative commons attribution share ?alike 4 0(?: international)?
cc-by-sa-3.0|commons|creative commons attribution share ?alike 3 0(?: unported)?
cc-by-nc-4.0|commons|creative commons attribution non ?commercial 4 0(?: international)?
cc-by-nd-4.0|commons|creative commons attribution no ?deriv(?:ative)?s 4 0(?: international)?
cc-by-nc-sa-4.0|commons|creative commons attribution non ?commercial share ?alike 4 0(?: international)?
cc-by-nc-nd-4.0|commons|creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0(?: international)?
artistic-1.0|artistic|artistic license(?: version)? 1(?: 0)?
artistic-2.0|artistic|artistic license(?: version)? 2(?: 0)?
bsl-1.0|boost|boost software license(?: version)?(?: 1 0)?
zlib|zlib|zlib(?: libpng)?(?: license)?
unlicense|unlicense|unlicense
wtfpl|wtfpl|wtfpl(?: version 2)?
python-2.0|python|python(?: software foundation)? license(?: version)?(?: 2)?
php-3.01|php|php license(?: version)?(?: 3 01)?
ruby|ruby|ruby license
openssl|openssl|openssl license
postgresql|postgresql|postgresql license
odbl-1.0|database|open database license(?: version)?(?: 1 0)?
odc-by-1.0|commons|open data commons attribution(?: license)?(?: 1 0)?
pddl-1.0|dedication|public domain dedication and licen[cs]e(?: 1 0)?
ofl-1.1|font|(?:sil )?open font license(?: version)?(?: 1 1)?
ms-pl|microsoft|microsoft public license
ms-rl|microsoft|microsoft reciprocal license
osl-3.0|open|open software license(?: version| v)?(?: 3 0)?
afl-3.0|academic|academic free license(?: version| v)?(?: 3 0)?
ecl-2.0|educational|educational community license(?: version)?(?: 2 0)?
lppl-1.3c|latex|latex project public license(?: version)?(?: 1 3c?)?
ncsa|illinois|university of illinois ncsa(?: open source)? license
upl-1.0|universal|universal permissive license(?: version)?(?: 1 0)?
busl-1.1|business|business source license(?: version)?(?: 1 1)?
sspl-1.0|server|server side public license(?: version)?(?: 1)?
elastic-2.0|elastic|elastic license(?: version)?(?: 2 0)?
vim|vim|vim license
x11|x11|x11 license
""".strip()

# Names that are ordinary words in some language too: they count only in a form that speaks of a license.
ORDINARY = """
mit|mit|mit(?: expat)?
""".strip()

# How a license is named in a text: priority, confidence, keyword (if any besides the name's), form around the name.
FORMS = (
    (5, 0.95, b"spdx", "spdx license identifier {name}"),
    (4, 0.9, b"licen", "(?:dual |jointly )?licen[cs]ed under (?:the )?(?:terms of )?(?:the )?{name}"),
    (4, 0.9, b"under", "(?:released|distributed|available|published|provided|shared) under (?:the )?(?:terms of )?(?:the )?{name}"),
    # Only the name itself and "or" are matched, so the other name stays a detection of its own.
    (4, 0.9, b" or ", "{name} or(?= (?:the )?(?:apache|bsd|isc|zlib|[al]?gpl|mpl|unlicense))"),
    (4, 0.9, b" or ", "(?:(?<=[23] 0 )|(?<=license )|(?<=clause )|(?<=bsd )|(?<=isc )|(?<=zlib )|(?<=gpl ))or (?:the )?{name}"),
    (3, 0.6, b"", "{name}"),
)

# Whole notices and lines that name no license: label, priority, confidence, keyword, pattern.
NOTICES = (
    ("mit", 4, 0.9, b"permission is hereby granted", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("isc", 4, 0.9, b"permission to use copy", "permission to use copy modify and or distribute this software for any purpose with or without fee"),
    ("bsd", 4, 0.9, b"redistribution and use", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("apache-2.0", 4, 0.9, b"except in compliance", "you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0"),
    ("mpl-2.0", 4, 0.9, b"source code form", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("epl-2.0", 4, 0.9, b"accompanying materials", "this program and the accompanying materials are made available under the terms of the eclipse public license (?:version |v )?v?2 0"),
    ("lgpl-2.1-or-later", 5, 0.9, b"lesser general public", "under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    ("agpl-3.0-or-later", 5, 0.9, b"affero", "under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    ("cc-by-4.0", 4, 0.9, b"creative commons", "(?:licensed under (?:a|the) )?creative commons attribution 4 0 international(?: public)? licen[cs]e"),
    ("zlib", 4, 0.9, b"as is", "this software is provided as is without any express or implied warranty in no event"),
    ("gpl-2.0-or-later", 5, 0.9, b"any later version", "either version 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", 5, 0.9, b"any later version", "either version 3 of the license or at your option any later version"),
    ("public-domain", 4, 0.9, b"public domain", "(?:released|placed|dedicated|is) (?:in|into|to) the public domain"),
    ("proprietary", 4, 0.9, b"proprietary", "(?:confidential and proprietary|proprietary and confidential|proprietary license)"),
    ("proprietary", 4, 0.9, b"unauthorized", "unauthorized (?:copying|use|reproduction|distribution)(?: \\S+){0,6} (?:prohibited|forbidden)"),
    ("non-commercial", 3, 0.6, b"commercial", "(?:for )?non ?commercial use only"),
    ("copyright", 2, 0.4, b"copyright", "copyright (?:c )?(?:19|20)\\d\\d(?: (?:19|20)\\d\\d)?"),
    ("copyright", 1, 0.4, b"copyright", "copyright (?:c|by|notice|holders?|owners?)"),
)


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    keywords: tuple[bytes, ...]
    pattern: re.Pattern[bytes]


def _whole_words(pattern: str) -> re.Pattern[bytes]:
    return re.compile(rb"(?<![^ ])(?:" + pattern.encode() + rb")(?![^ ])")


def rules() -> list[Rule]:
    """All signatures, highest priority first."""
    found = [Rule(label, p, c, (key,), _whole_words(pattern)) for label, p, c, key, pattern in NOTICES]
    named = [(line, FORMS) for line in NAMES.splitlines()] + [(line, FORMS[:-1]) for line in ORDINARY.splitlines()]
    for line, forms in named:
        label, key, name = line.split("|", 2)
        for priority, confidence, needed, form in forms:
            keywords = tuple(k for k in (key.encode(), needed) if k)
            found.append(Rule(label, priority, confidence, keywords, _whole_words(form.replace("{name}", f"(?:{name})"))))
    return sorted(found, key=lambda rule: -rule.priority)


_LOWER = bytes(
    c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256)
)
_FORM_WORDS = frozenset(key for _, _, key, _ in FORMS if key)


class Scanner:
    def __init__(self, signatures: list[Rule]):
        self.rules = signatures
        self.keywords = sorted({key for rule in signatures for key in rule.keywords})
        self.base = [(label, phrase, _whole_words(phrase.decode())) for label, phrase in BASE]

    def scan(self, text: bytes) -> tuple:
        """Words, base places, first and last base word, base labels, all labels, score, and detections."""
        words = text.translate(_LOWER).split()
        line = b" ".join(words)
        starts: list[int] = []

        def word_at(place: int) -> int:
            if not starts:
                at = 0
                for word in words:
                    starts.append(at)
                    at += len(word) + 1
            return bisect_right(starts, place) - 1

        base_labels, base_at = set(), []
        for label, phrase, pattern in self.base:
            if phrase in line:
                places = [m.start() for m in pattern.finditer(line)]
                if places:
                    base_labels.add(label)
                    base_at += [word_at(place) for place in places]
        present = {key for key in self.keywords if key in line}
        spans: list[tuple[int, int, Rule]] = []
        if present - _FORM_WORDS:
            for rule in self.rules:
                if all(key in present for key in rule.keywords):
                    spans += [(m.start(), m.end(), rule) for m in rule.pattern.finditer(line)]
        kept = suppress(spans)
        labels = sorted(base_labels | {rule.label for _, _, rule in kept})
        score = max([0.8 if base_labels else 0.0, *(rule.confidence for _, _, rule in kept)])
        detections = [(rule.label, word_at(a), word_at(b - 1)) for a, b, rule in kept]
        first, last = (min(base_at), max(base_at)) if base_at else (None, None)
        return len(words), len(base_at), first, last, ",".join(sorted(base_labels)), ",".join(labels), score, detections


def suppress(spans: list[tuple[int, int, Rule]]) -> list[tuple[int, int, Rule]]:
    """Detections that no other of the same or a higher priority contains; of equal ones the first rule's stays."""
    kept: list[tuple[int, int, Rule]] = []
    reach: dict[int, int] = {}  # priority: the furthest end of what began so far
    for start, end, rule in sorted(spans, key=lambda s: (s[0], -s[1], -s[2].priority)):
        if any(priority >= rule.priority and furthest >= end for priority, furthest in reach.items()):
            continue
        kept.append((start, end, rule))
        reach[rule.priority] = max(reach.get(rule.priority, 0), end)
    return kept


KIND = (
    "struct<n_words: bigint, n_base: bigint, first_word: bigint, last_word: bigint, base_labels: string, labels: string, "
    "score: double, detections: array<struct<label: string, first_word: bigint, last_word: bigint>>>"
)


def scan_licenses(docs: DataFrame, text: str = "text", signatures: list[Rule] | None = None) -> DataFrame:
    """``docs`` with the struct ``licenses`` added: counts, labels, score and the detections that stay."""
    span = pa.struct([("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64())])
    kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
    names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
    scanner = Scanner(signatures if signatures is not None else rules())

    @F.arrow_udf(KIND)
    def scanned(texts: pa.Array) -> pa.Array:
        rows = [scanner.scan(value.as_py()) for value in texts]
        columns = list(zip(*rows, strict=True)) or [()] * len(names)
        columns[-1] = [[dict(zip(("label", "first_word", "last_word"), d, strict=True)) for d in found] for found in columns[-1]]
        return pa.StructArray.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    return docs.withColumn("licenses", scanned.asNondeterministic()(raw(text)))


def license_labels(spark, sf_dir) -> DataFrame:
    """Every document with its words, base places, labels and score."""
    found = scan_licenses(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "licenses.*").drop("detections")
