"""Licence recognition by sentence rules.

Comment markers go, and a text is cut into sentences at marks and blank lines; a sentence may run over several lines, and a line of it may begin
a sentence of its own (headings and references often have no mark). Each sentence is normalised (lower case, one space, no punctuation but version points), and known licence
sentences are replaced by identifiers; numbers in a sentence (versions, clauses) become part of the identifier. The sequence
of identifiers is then matched against ordered rules: at each place the first rule whose sequence begins there names the licence
and consumes its sentences. A sentence that clearly speaks of a licence but is not known becomes ``UNKNOWN``.

Defined cases: null and empty texts have no sentences. Whole texts are read; only sentences with a licence word are normalised, and every
known sentence has one. Repeated rows are judged one by one.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of which every licence sentence has one.
KEYWORDS = ("licen", "copyright", "redistribut", "permission", "warrant", "public domain", "as is", "spdx", "copyleft", "liab", "creative commons", "trademark", "all rights reserved")

_V = r"(?:v(?:ersion)?\s*)?(\d+(?:\.\d+)*)"
_GNU = (("GPL", "general public license|gpl"), ("LGPL", "(?:lesser|library) general public license|lgpl"), ("AGPL", "affero general public license|agpl"))
_FSF = "as published by the free software foundation"
#: Licences that are told by their name: label, and the name as it stands before "license" in a normalised sentence (fixed values).
NAMED: tuple[tuple[str, str], ...] = (
    ("Zlib", "zlib(?: libpng)?"), ("BSL", "boost software"), ("EPL", "eclipse public"), ("CPL", "common public"), ("IPL", "ibm public"),
    ("CDDL", "common development and distribution"), ("Artistic", "artistic"), ("Unlicense", "(?:the )?un"), ("WTFPL", "do what the fuck you want to public"),
    ("PostgreSQL", "postgresql"), ("PSF", "python software foundation|psf"), ("OFL", "sil open font|open font"), ("NCSA", "university of illinois(?: ncsa)?(?: open source)?|ncsa(?: open source)?"),
    ("EUPL", "european union public"), ("MS-PL", "microsoft public"), ("MS-RL", "microsoft reciprocal"), ("PHP", "php"), ("Vim", "vim"), ("Ruby", "ruby"), ("OpenSSL", "openssl"),
    ("X11", "x11"), ("AFL", "academic free"), ("OSL", "open software"), ("CeCILL", "cecill(?: [abc])?(?: free software)?"), ("LPPL", "latex project public"), ("QPL", "q public"),
    ("NPL", "netscape public"), ("SPL", "sun public"), ("APSL", "apple public source"), ("ECL", "educational community"), ("UPL", "universal permissive"), ("MulanPSL", "mulan permissive software"),
    ("ODbL", "open database"), ("OGL", "open government"), ("SSPL", "server side public"), ("BUSL", "business source"), ("Elastic", "elastic"), ("JSON", "json"), ("Beerware", "beerware"),
)
_UNDER = "(?:licensed|released|distributed|available|published|provided|covered|governed) (?:under|by) (?:the )?(?:terms (?:and conditions )?of )?(?:the |a |an )?"
#: Identifier and pattern of the normalised sentence; groups are appended to the identifier. The first that matches counts.
SENTENCES: tuple[tuple[str, str], ...] = (
    ("SPDX", r"spdx license identifier ([a-z0-9.+ -]+)"),
    *((f"{k}refPlus", rf".*(?:under the (?:terms of the )?)?gnu (?:{w}) (?:{_FSF} )?(?:either )?{_V}(?: of the license)?(?: {_FSF})? or (?:at your option )?any later version.*") for k, w in _GNU),
    *((f"{k}ref", rf".*under the (?:terms of the )?gnu (?:{w}) (?:{_FSF} {_V}(?: of the license)?|{_V}(?: of the license)? {_FSF}).*") for k, w in _GNU),
    ("GNUsee", r"see the gnu (?:lesser |library |affero )?general public license for more details"),
    ("GNUcopy", r"you should have received a copy of the gnu (?:lesser |library |affero )?general public license.*"),
    ("GPLref", rf"(?:this \w+ is |it is |)(?:free software )?(?:licensed|released|distributed|available|published)? ?under the (?:terms of the )?gnu (?:general public license|gpl) {_V}(?: only)?"),
    ("GPLrefPlus", rf".*gnu (?:general public license|gpl) {_V} or (?:\(?at your option\)? )?any later version"),
    ("LGPLref", rf".*under the (?:terms of the )?gnu (?:lesser|library) general public license {_V}.*"),
    ("AGPLref", rf".*under the (?:terms of the )?gnu affero general public license {_V}.*"),
    ("ApacheRef", rf"(?:this \w+ is |)(?:licensed|released|distributed|available) under the apache (?:software )?license {_V}(?: the license)?"),
    ("ApacheComply", r"you may not use this file except in compliance with the license"),
    ("ApacheObtain", r"you may obtain a copy of the license at.*"),
    ("ApacheAsIs", r"unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis.*"),
    ("ApacheSee", r"see the license for the specific language governing permissions and limitations under the license"),
    ("MITref", r"(?:this \w+ is |)(?:licensed|released|distributed|available|published) under the (?:terms of the )?(?:mit|expat) licen[sc]e"),
    ("MITgrant", r"permission is hereby granted free of charge to any person obtaining a copy.*"),
    ("MITnotice", r"the above copyright notice and this permission notice shall be included in all copies.*"),
    ("AsIsProvided", r"(?:the|this) software is provided (?:by .* )?as is.*"),
    ("NoLiability", r"in no event shall .* be liable.*"),
    ("BSDref", r"(?:this \w+ is |)(?:licensed|released|distributed) under the (?:(\d) clause )?bsd license"),
    ("BSDgrant", r"redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met.*"),
    ("BSDsource", r"(?:\d )?redistributions of source code must retain the above copyright notice.*"),
    ("BSDbinary", r"(?:\d )?redistributions in binary form must reproduce the above copyright notice.*"),
    ("BSDendorse", r"(?:\d )?neither the name of .* may be used to endorse or promote products.*permission"),
    ("MPLref", rf".*subject to the terms of the mozilla public license {_V}.*"),
    ("CCref", rf"(?:this \w+ is |)(?:licensed|released|available|published) under (?:a |the )?(?:cc|creative commons) ?((?:by|by nc|by sa|by nd|by nc sa|by nc nd|zero|0)) ?{_V}(?: \w+)? ?(?:international|license)?"),
    ("ISCgrant", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted.*"),
    ("PublicDomain", r".*(?:is|are|placed|released) (?:in|into|to) the public domain.*"),
    ("CopyrightLine", r"copyright(?: c)? .*\d{4}.*"),
    ("AllRights", r".*all rights reserved"),
    ("CCnamed", rf".*creative commons (attribution(?: (?:non ?commercial|share ?alike|no ?deriv(?:ative)?s))*) {_V}.*"),
    ("BSDstyle", rf".*{_UNDER}bsd style licen[sc]e.*"),
    ("MITtitle", r"(?:the )?mit licen[sc]e(?: mit)?"),
    ("BSDtitle", r"(?:the )?(?:new |simplified |modified )?bsd (\d) clause(?: \w+)? licen[sc]e"),
    ("ApacheTitle", rf"apache license {_V}(?: \w+ \d+)?"),
    ("GPLtitle", rf"gnu general public license {_V}(?: \d+)?(?: \w+ \d+)?"),
    ("LGPLtitle", rf"gnu lesser general public license {_V}(?: \d+)?(?: \w+ \d+)?"),
    ("AGPLtitle", rf"gnu affero general public license {_V}(?: \d+)?(?: \w+ \d+)?"),
    ("MPLtitle", rf"mozilla public license {_V}"),
    *((f"{label}named", rf".*{_UNDER}(?:{name}) ?licen[sc]e(?: agreement)?(?: {_V})?.*") for label, name in NAMED),
    *((f"{label}title", rf"(?:the )?(?:{name}) ?licen[sc]e(?: agreement)?(?: {_V})?") for label, name in NAMED),
)
COMPILED = tuple((name, re.compile(pattern)) for name, pattern in SENTENCES)


#: Beginnings of the sentences that have an open middle: the middle does not run past the next beginning, so a text is passed over once.
BEGINNINGS = {"AsIsProvided": "software is provided", "NoLiability": "in no event shall", "BSDendorse": "neither the name of"}


def _in_lines(name: str, pattern: str) -> re.Pattern:
    """The fixed part of a pattern within a sentence of several lines: it begins a line if the pattern has no open head, and ends one if it has no open tail."""
    core = pattern.removeprefix(".*").removesuffix(".*")
    middle = f"(?:(?!{BEGINNINGS[name]})[\\s\\S])*?".replace(" ", r"[ \n]") if name in BEGINNINGS else ".*"
    core = re.sub(r"\[[^\]]*\]|\.\*| ", lambda m: {" ": r"[ \n]", ".*": middle}.get(m[0], m[0]), core)
    end = "" if pattern.endswith(".*") else r"(?=\Z|[ \n]see\b|\n(?!(?:or|and|as|only)\b))"
    return re.compile((r"\b" if pattern.startswith(".*") else "^") + f"(?:{core}){end}", re.M)


#: The names of ``NAMED`` in front of "license", as one pattern: most texts have none.
ANY_NAMED = re.compile("(?:" + "|".join(name.replace(" ", r"[ \n]") for _, name in NAMED) + r")[ \n]?licen[sc]e")
OF_NAME = frozenset(f"{label}{form}" for label, _ in NAMED for form in ("named", "title"))


#: Identifier, pattern, whether the sentence may have more before it, and after it.
WITHIN = tuple((name, _in_lines(name, pattern), pattern.startswith(".*"), pattern.endswith(".*")) for name, pattern in SENTENCES)

#: Licence and the sentence identifiers that make it, in order; the first rule that fits counts. ``{}`` takes over what the identifier carries.
RULES: tuple[tuple[str, tuple[str, ...]], ...] = (
    ("Apache-{}", ("ApacheRef", "ApacheComply", "ApacheObtain", "ApacheAsIs", "ApacheSee")),
    ("Apache-{}", ("ApacheRef",)),
    ("MIT", ("MITgrant", "MITnotice", "AsIsProvided", "NoLiability")),
    ("MIT", ("MITgrant", "MITnotice", "AsIsProvided")),
    ("MIT", ("MITgrant",)),
    ("MIT", ("MITref",)),
    ("BSD-3-Clause", ("BSDgrant", "BSDsource", "BSDbinary", "BSDendorse")),
    ("BSD-2-Clause", ("BSDgrant", "BSDsource", "BSDbinary")),
    ("BSD-{}-Clause", ("BSDref",)),
    ("ISC", ("ISCgrant", "AsIsProvided")),
    ("ISC", ("ISCgrant",)),
    ("GPL-{}-or-later", ("GPLrefPlus",)),
    ("GPL-{}", ("GPLref",)),
    ("LGPL-{}-or-later", ("LGPLrefPlus",)),
    ("LGPL-{}", ("LGPLref",)),
    ("AGPL-{}-or-later", ("AGPLrefPlus",)),
    ("AGPL-{}", ("AGPLref",)),
    ("MPL-{}", ("MPLref",)),
    ("CC-{}", ("CCref",)),
    ("SPDX:{}", ("SPDX",)),
    ("Public-Domain", ("PublicDomain",)),
    ("CC-{}", ("CCnamed",)),
    ("BSD-style", ("BSDstyle",)),
    ("MIT", ("MITtitle", "MITgrant", "MITnotice", "AsIsProvided", "NoLiability")),
    ("MIT", ("MITtitle",)),
    ("BSD-{}-Clause", ("BSDtitle",)),
    ("Apache-{}", ("ApacheTitle",)),
    ("GPL-{}", ("GPLtitle",)),
    ("LGPL-{}", ("LGPLtitle",)),
    ("AGPL-{}", ("AGPLtitle",)),
    ("MPL-{}", ("MPLtitle",)),
    *((f"{label}-{{}}", (f"{label}{form}",)) for label, _ in NAMED for form in ("named", "title")),
)
LABELS = frozenset(label for label, _ in NAMED)
#: The rules by the identifier they begin with, in their order.
STARTING = {first: tuple(rule for rule in RULES if rule[1][0] == first) for first in {sequence[0] for _, sequence in RULES}}
#: Terms of the names of Creative Commons licences (fixed values).
TERMS = {"ATTRIBUTION": "BY", "NONCOMMERCIAL": "NC", "SHAREALIKE": "SA", "NODERIVS": "ND", "NODERIVATIVES": "ND"}

#: What an unknown sentence must have to be reported.
CLEAR = re.compile(r"\b(?:licen[sc]e|copyright|redistribut|spdx|copyleft)")
#: Ends of sentences; "; either version 2 of the License" goes on.
END = re.compile(r"[.!?]+(?=\s|$)|;+(?=\s|$)(?!\s+either\b)")
#: What a commented line begins with.
MARKER = re.compile(r"(?:(?:/\*+|\*+/|\*+|//+|#+|--+|;+|%+|>+|<!--+|\|+|dnl\b|rem\b)\s*)+")
URL = re.compile(r"<?(?:https?://|www\.)\S+")
PUNCTUATION = re.compile(r"[^\w.\s]|(?<!\d)\.|\.(?!\d)|_")


def paragraphs(text: str) -> Iterator[str]:
    """Runs of lines between blank ones, without comment markers. An address on a line of its own belongs to what is before it."""
    held: list[str] = []
    blank = False
    for line in text.split("\n"):
        line = line.strip()
        line = line[MARKER.match(line).end():] if MARKER.match(line) else line
        line = line.removesuffix("-->").rstrip("*/ \t") if line.endswith(("*/", "-->", "*")) else line
        if not line:
            blank = True
            continue
        if blank and held and not URL.fullmatch(line):
            yield "\n".join(held)
            held = []
        blank = False
        held.append(line)
    if held:
        yield "\n".join(held)


def sentences(text: str) -> Iterator[str]:
    """Sentences with a licence word, with their line breaks. Blank lines and marks before white space end a sentence."""
    low = text.lower()
    if not any(k in low for k in KEYWORDS) and "\n" not in low:
        return
    for paragraph in paragraphs(low):
        flat = paragraph.replace("\n", " ")
        if any(k in flat for k in KEYWORDS):
            for sentence in END.split(paragraph):
                flat = sentence.replace("\n", " ")
                if any(k in flat for k in KEYWORDS):
                    yield sentence


def normalised(sentence: str) -> str:
    """Words with one space between them; line breaks stay."""
    return "\n".join(line for line in (" ".join(PUNCTUATION.sub(" ", x).split()) for x in sentence.split("\n")) if line)


def identify(sentence: str) -> tuple[str, str]:
    """(identifier, what it carries) of a normalised sentence."""
    named = ANY_NAMED.search(sentence)
    for name, pattern in COMPILED:
        found = pattern.fullmatch(sentence) if named or name not in OF_NAME else None
        if found:
            return name, carried(found)
    return ("UNKNOWN", "") if CLEAR.search(sentence) else ("", "")


def carried(found: re.Match) -> str:
    groups = [" ".join(g.split()).upper() for g in found.groups() if g]
    groups = [re.sub("NON COMMERCIAL|SHARE ALIKE|NO DERIV", lambda m: m[0].replace(" ", ""), g) for g in groups]
    return "-".join("-".join(TERMS.get(w, w) for w in g.split()) for g in groups)


def identify_lines(sentence: str) -> list[tuple[str, str]]:
    """Identifiers in a normalised sentence that is not known as a whole: the longest known parts that do not overlap."""
    named = ANY_NAMED.search(sentence)
    parts = [(m.start(), m.end(), rank, m) for rank, (name, pattern, *_) in enumerate(WITHIN) if named or name not in OF_NAME for m in pattern.finditer(sentence)]
    chosen: list[tuple[int, int, int, re.Match]] = []
    # the chosen parts lie apart: only the neighbours in order can overlap a new one
    for part in sorted(parts, key=lambda x: (x[0] - x[1], x[2])):
        k = bisect_left(chosen, part[0], key=lambda x: x[0])
        if (k == 0 or chosen[k - 1][1] <= part[0]) and (k == len(chosen) or part[1] <= chosen[k][0]):
            chosen.insert(k, part)
    ids: list[tuple[str, str]] = []
    at, open_tail = 0, False
    for start, end, rank, found in chosen:
        name, _, head, tail = WITHIN[rank]
        gap = sentence[at:start]
        if at and "\n" not in gap and open_tail:  # the same line goes on
            at = end
            continue
        if not (head or open_tail):
            ids += _unknown(gap if not at else gap.partition("\n")[2])
        ids.append((name, carried(found)))
        at, open_tail = end, tail
    rest = sentence[at:]
    if not open_tail and not rest.lstrip().startswith("see "):
        ids += _unknown(rest if not at else rest.partition("\n")[2])
    return ids


def _unknown(text: str) -> list[tuple[str, str]]:
    return [("UNKNOWN", "")] if CLEAR.search(text) else []


def recognise(text: str | None) -> tuple[list[str], list[str]]:
    """(sentence identifiers, licences in order of first mention)."""
    ids = []
    for sentence in map(normalised, sentences(text or "")):
        known = identify(sentence) if "\n" not in sentence else ("", "")
        ids += [known] if known[0] not in ("", "UNKNOWN") else identify_lines(sentence)
    licences: list[str] = []
    at = 0
    while at < len(ids):
        step = 1
        for name, sequence in STARTING.get(ids[at][0], ()):
            if tuple(i for i, _ in ids[at: at + len(sequence)]) == sequence:
                label = sequence[0].removesuffix("named").removesuffix("title")
                licence = label if label in LABELS and not ids[at][1] else name.format(ids[at][1] or "unversioned")
                if licence not in licences:
                    licences.append(licence)
                step = len(sequence)
                break
        at += step
    return [f"{i}:{c}" if c else i for i, c in ids], licences


def scan_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [recognise(t.as_py()) for t in batch.column("text")]
        kind = pa.list_(pa.string())
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([i for i, _ in found], type=kind), pa.array([x for _, x in found], type=kind)], names=["doc_id", "sentence_ids", "licences"])


def scan(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """doc_id, sentence_ids, licences per row of ``docs``."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(scan_rows, f"doc_id {rows.dtypes[0][1]}, sentence_ids array<string>, licences array<string>")
