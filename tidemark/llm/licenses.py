"""License scan by ordered signature rules.

1. Normalise. A text becomes its words: A-Z lower-cased, everything in ASCII but letters
   and digits blanked, one space between words. Rules match whole words.
2. Prefilter. A rule is tried only if the text holds one of its keywords; the words of
   a text are looked up as a set, so most texts try no rule at all.
3. Match. Every rule is a regular expression over the words; a match is a detection, the
   half-open interval of its words.
4. Resolve. Rules are ordered by priority (full names and grants before identifiers before
   mentions). A detection whose interval lies within that of one of higher priority, or
   of a longer one (or of the earlier rule, if equal) of the same priority, is suppressed.

Base phrases are found everywhere they stand and never suppressed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base phrases and their labels (fixed values).
BASE = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))

NAME, TEXT, ID, MENTION = 1, 2, 3, 4  # priorities: a named version, license text, an identifier, a mention
WEIGHTS = {NAME: 0.9, TEXT: 0.8, ID: 0.7, MENTION: 0.35}  # what a label found so adds to the score
BASE_WEIGHT = 0.5

#: Texts, names and mentions: label, priority, keywords (one must occur), pattern. ``L`` stands for
#: license or licence, ``~n`` for up to n words.
SIGNATURES = (
    ("mit", NAME, "mit", r"(?:released|licensed|distributed|available|provided) under (?:the )?(?:terms of the )?mit L"),
    ("mit", ID, "mit", r"mit L|L mit|expat L"),
    ("mit", TEXT, "hereby", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", TEXT, "sublicense", r"use copy modify merge publish distribute sublicense and or sell copies"),
    ("mit", TEXT, "noninfringement", r"the software is provided as is without warranty of any kind~12noninfringement"),
    ("mit-0", NAME, "attribution", r"mit no attribution"),
    ("isc", NAME, "isc", r"isc L|L isc|internet systems consortium L"),
    ("isc", TEXT, "hereby", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("0bsd", NAME, "0bsd zero", r"0bsd|zero clause bsd|bsd zero clause"),
    ("bsd", TEXT, "redistribution", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd", TEXT, "redistributions", r"redistributions (?:of source code|in binary form) must (?:retain|reproduce) the above copyright notice"),
    ("bsd-3-clause", TEXT, "endorse", r"neither the names? of ~8nor the names of (?:its )?contributors may be used to endorse or promote"),
    ("bsd-4-clause", TEXT, "advertising", r"all advertising materials mentioning features or use of this software must display"),
    ("bsd-2-clause", NAME, "bsd freebsd", r"bsd 2 clause(?: L)?|2 clause bsd(?: L)?|simplified bsd L|freebsd L"),
    ("bsd-3-clause", NAME, "bsd", r"bsd 3 clause(?: L)?|3 clause bsd(?: L)?|(?:new|revised|modified) bsd L"),
    ("bsd-4-clause", NAME, "bsd", r"bsd 4 clause(?: L)?|4 clause bsd(?: L)?|original bsd L"),
    ("bsd", ID, "bsd", r"bsd(?: style)? L|berkeley software distribution L"),
    ("apache", ID, "apache", r"apache(?: software)? L"),
    ("apache-2.0", TEXT, "unless", r"unless required by applicable law or agreed to in writing software distributed under the L"),
    ("apache-2.0", TEXT, "apache", r"www apache org licenses L 2 0"),
    ("gpl", ID, "gpl", r"gpl|gnu gpl"),
    ("gpl", NAME, "general", r"gnu general public L"),
    ("gpl", TEXT, "redistribute", r"you can redistribute it and or modify it under the terms of the gnu general public L"),
    ("gpl", TEXT, "merchantability", r"without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("gpl", TEXT, "gnu", r"www gnu org licenses(?: gpl)?"),
    ("lgpl", NAME, "lesser library", r"gnu (?:lesser|library) general public L"),
    ("lgpl", ID, "lgpl", r"lgpl|gnu lgpl"),
    ("agpl", NAME, "affero", r"(?:gnu )?affero general public L"),
    ("agpl", ID, "agpl", r"agpl|gnu agpl"),
    ("gfdl", NAME, "documentation", r"gnu free documentation L"),
    ("gfdl", ID, "gfdl fdl", r"gfdl|gnu fdl"),
    ("gpl-exception", TEXT, "classpath", r"(?:gnu )?classpath exception"),
    ("gpl-exception", TEXT, "linking", r"linking exception|as a special exception ~10(?:permission to )?link"),
    ("mpl", ID, "mozilla mpl", r"mozilla public L|mpl L"),
    ("mpl-2.0", TEXT, "mozilla", r"this source code form is subject to the terms of the mozilla public L v(?:ersion)? ?2 0"),
    ("epl", ID, "eclipse", r"eclipse public L"),
    ("edl", NAME, "eclipse", r"eclipse distribution L"),
    ("cpl", NAME, "common", r"common public L"),
    ("ipl", NAME, "ibm", r"ibm public L"),
    ("cddl", ID, "cddl common", r"cddl|common development and distribution L"),
    ("cpal", NAME, "cpal attribution", r"common public attribution L|cpal"),
    ("eupl", ID, "eupl european", r"eupl|european union public L"),
    ("artistic", ID, "artistic", r"artistic L"),
    ("perl", NAME, "perl", r"same terms as perl(?: itself)?"),
    ("python", NAME, "python psf", r"python software foundation L|psf L"),
    ("ruby", NAME, "ruby", r"ruby L|same terms as ruby"),
    ("php", NAME, "php", r"php L"),
    ("zend", NAME, "zend", r"zend (?:engine )?L"),
    ("w3c", NAME, "w3c", r"w3c(?: software)?(?: notice and)? L"),
    ("zlib", NAME, "zlib libpng", r"zlib(?: libpng)? L|libpng L"),
    ("zlib", TEXT, "misrepresented", r"the origin of this software must not be misrepresented"),
    ("zlib", TEXT, "altered", r"altered source versions must be plainly marked as such"),
    ("boost", NAME, "boost", r"boost software L"),
    ("boost", TEXT, "machine", r"machine executable object code generated by a source language processor"),
    ("unlicense", NAME, "unlicense", r"(?:the )?unlicense"),
    ("unlicense", TEXT, "unencumbered", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", NAME, "wtfpl", r"wtfpl|do what the fuck you want to public L"),
    ("public-domain", NAME, "domain", r"(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", MENTION, "domain", r"public domain"),
    ("cc0", NAME, "cc0 cc", r"cc0|cc zero|creative commons zero"),
    ("cc0", TEXT, "waived", r"has waived all copyright and related or neighboring rights"),
    ("cc", NAME, "creative", r"creative commons(?: attribution)? L"),
    ("cc", TEXT, "creativecommons", r"creativecommons org licenses"),
    ("cc", MENTION, "creative", r"creative commons"),
    ("odbl", NAME, "odbl database", r"odbl|open (?:data commons )?(?:open )?database L"),
    ("odc-by", NAME, "odc commons", r"odc by|open data commons attribution L"),
    ("pddl", NAME, "pddl dedication", r"pddl|public domain dedication and L"),
    ("ogl", NAME, "government", r"open government L"),
    ("etalab", NAME, "etalab ouverte", r"(?:etalab )?licence ouverte|etalab open L"),
    ("dl-de", NAME, "datenlizenz", r"datenlizenz deutschland"),
    ("ofl", ID, "ofl sil", r"sil open font L|ofl"),
    ("ubuntu-font", NAME, "ubuntu", r"ubuntu font L"),
    ("lppl", ID, "lppl latex", r"lppl|latex project public L"),
    ("cecill", ID, "cecill", r"cecill(?: free software)?(?: L)?"),
    ("qpl", NAME, "qpl", r"qpl|q public L"),
    ("sleepycat", NAME, "sleepycat", r"sleepycat L"),
    ("openssl", NAME, "openssl ssleay", r"openssl L|ssleay L"),
    ("curl", NAME, "curl", r"curl L"),
    ("jpeg", TEXT, "jpeg", r"this software is based in part on the work of the independent jpeg group"),
    ("freetype", NAME, "freetype", r"freetype(?: project)? L"),
    ("icu", NAME, "icu unicode", r"icu L|unicode L"),
    ("x11", NAME, "x11", r"x11 L"),
    ("ntp", NAME, "ntp", r"ntp L"),
    ("hpnd", NAME, "historical", r"historical permission notice and disclaimer"),
    ("ncsa", NAME, "ncsa", r"(?:university of illinois )?ncsa(?: open source)? L"),
    ("afl", ID, "academic", r"academic free L"),
    ("osl", ID, "osl", r"osl|open software L"),
    ("ecl", NAME, "educational", r"educational community L"),
    ("rpl", NAME, "reciprocal", r"(?:microsoft |ms )?reciprocal (?:public )?L"),
    ("ms-pl", NAME, "microsoft ms", r"microsoft public L|ms pl"),
    ("ms-rl", NAME, "microsoft ms", r"microsoft reciprocal L|ms rl"),
    ("sspl", NAME, "sspl server", r"sspl|server side public L"),
    ("busl", NAME, "business busl", r"business source L|busl 1 1"),
    ("elastic", NAME, "elastic", r"elastic L"),
    ("commons-clause", TEXT, "clause", r"commons clause(?: L)? condition|commons clause"),
    ("polyform", NAME, "polyform", r"polyform (?:noncommercial|small business|strict|shield|perimeter|free trial) L"),
    ("openrail", NAME, "openrail rail", r"(?:creativeml |bigscience )?open ?rail(?: m| s)?(?: L)?"),
    ("llama", NAME, "llama", r"llama [0-9 ]*community L"),
    ("upl", NAME, "universal", r"universal permissive L"),
    ("vim", NAME, "vim charityware", r"vim L|charityware"),
    ("beerware", NAME, "beerware beer", r"beerware(?: L)?|beer ware L"),
    ("json", TEXT, "evil", r"the software shall be used for good not evil"),
    ("tcl", NAME, "tcl", r"tcl(?: tk)? L"),
    ("postgresql", NAME, "postgresql", r"postgresql L"),
    ("naist", NAME, "naist", r"naist L"),
    ("copyleft", MENTION, "copyleft", r"copyleft"),
    ("dual", TEXT, "dual dually", r"dual(?:ly)? licensed(?: under)?|dual L"),
    ("reserved", NAME, "reserved", r"(?:copyright|c|©) ~8all rights reserved"),
    ("reserved", TEXT, "reproduced", r"no part of this (?:publication|book|work|document|site) may be reproduced"),
    ("reserved", TEXT, "reproduction", r"reproduction (?:in whole or in part |of any part )?(?:without (?:written |prior )?permission )?is (?:strictly )?(?:prohibited|forbidden)"),
    ("reserved", MENTION, "reservados", r"todos los derechos reservados|todos os direitos reservados"),
    ("reserved", MENTION, "réservés", r"tous droits réservés"),
    ("reserved", MENTION, "vorbehalten", r"alle rechte vorbehalten"),
    ("proprietary", TEXT, "proprietary", r"proprietary and confidential|confidential and proprietary|proprietary L"),
    ("proprietary", TEXT, "disclose", r"may not (?:be )?(?:copy|copied|disclose|disclosed|distribute|distributed) ~6(?:without|except)"),
    ("proprietary", TEXT, "eula", r"end user L agreement|eula"),
    ("non-commercial", TEXT, "commercial noncommercial", r"(?:for )?non ?commercial (?:use|purposes)(?: only)?|not for commercial use"),
    ("non-commercial", TEXT, "personal", r"for (?:your )?personal use only|personal and non ?commercial use"),
    ("research-only", TEXT, "research", r"for (?:academic |scientific )?research (?:use|purposes) only|research and educational purposes only"),
    ("no-derivatives", TEXT, "derivative", r"no derivative works|may not create derivative works"),
    ("no-training", TEXT, "training", r"may not be used (?:for|to) (?:the )?train(?:ing)? ~4(?:ai|models?|machine)"),
    ("permission", TEXT, "permission", r"(?:used|reprinted|reproduced) (?:by|with) (?:kind )?permission(?: of)?"),
    ("permission", TEXT, "verbatim", r"permission is granted to (?:make and distribute|copy and distribute) verbatim copies"),
    ("fair-use", MENTION, "fair", r"fair (?:use|dealing)"),
    ("disclaimer", MENTION, "warranty", r"without (?:any )?warranty(?: of any kind)?|no warranty"),
    ("copyright", MENTION, "copyright", r"copyright (?:c |© )?(?:19|20)[0-9][0-9]"),
    ("copyright", MENTION, "©", r"© ?(?:19|20)[0-9][0-9]"),
    ("reference", MENTION, "license licence", r"see (?:the )?(?:accompanying |file )?L(?: file| txt| md)?|L (?:file|txt|md)|spdx L identifier"),
    ("reference", MENTION, "licensed", r"licen[cs]ed under(?: the)?(?: terms of)?"),
    ("reference", MENTION, "terms", r"terms of (?:use|service)|terms and conditions"),
    ("reference", MENTION, "licence", r"sous licence"),
    ("reference", MENTION, "lizenz lizenziert", r"(?:unter|lizenziert unter) der ~3lizenz|lizenziert unter"),
    ("reference", MENTION, "licencia", r"bajo (?:la )?licencia"),
)

#: Licenses with versions: label, its names, its identifiers, keywords, versions.
FAMILIES = (
    ("gpl", r"(?:gnu )?general public L", r"(?:gnu )?gpl", "general gpl", "1 2 3"),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public L", r"(?:gnu )?lgpl", "lesser library lgpl", "2 2.1 3"),
    ("agpl", r"(?:gnu )?affero general public L", r"(?:gnu )?agpl", "affero agpl", "1 3"),
    ("gfdl", r"gnu free documentation L", r"(?:gnu )?g?fdl", "documentation gfdl fdl", "1.1 1.2 1.3"),
    ("apache", r"apache(?: software)? L", r"apache|asl", "apache asl", "1.0 1.1 2.0"),
    ("mpl", r"mozilla public L", r"mpl", "mozilla mpl", "1.0 1.1 2.0"),
    ("epl", r"eclipse public L", r"epl", "eclipse epl", "1.0 2.0"),
    ("cddl", r"common development and distribution L", r"cddl", "common cddl", "1.0 1.1"),
    ("eupl", r"european union public L", r"eupl", "european eupl", "1.0 1.1 1.2"),
    ("artistic", r"artistic L", r"artistic", "artistic", "1.0 2.0"),
    ("afl", r"academic free L", r"afl", "academic afl", "1.1 1.2 2.0 2.1 3.0"),
    ("osl", r"open software L", r"osl", "open osl", "1.0 1.1 2.0 2.1 3.0"),
    ("lppl", r"latex project public L", r"lppl", "latex lppl", "1.0 1.1 1.2 1.3"),
    ("ofl", r"sil open font L", r"ofl", "sil ofl", "1.0 1.1"),
    ("cecill", r"cecill(?: free software)? L", r"cecill", "cecill", "1.0 1.1 2.0 2.1"),
    ("zpl", r"zope public L", r"zpl", "zope zpl", "1.1 2.0 2.1"),
    ("ecl", r"educational community L", r"ecl", "educational ecl", "1.0 2.0"),
    ("boost", r"boost software L", r"bsl", "boost bsl", "1.0"),
    ("python", r"python software foundation L", r"psf", "python psf", "2 2.0"),
)

#: Creative Commons: the conditions a label joins, and the words of their names.
CONDITIONS = {"by": "attribution", "nc": "non ?commercial", "nd": "no ?deriv(?:ative)?s?(?: works)?", "sa": "share ?alike"}
CC_KINDS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd")
CC_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")


@dataclass(frozen=True)
class Rule:
    """A signature: its label, priority, keywords of which a text must hold one, pattern."""

    label: str
    priority: int
    keywords: tuple[bytes, ...]
    pattern: re.Pattern


def rule(label: str, priority: int, keywords: str, pattern: str) -> Rule:
    """A rule from the notation of ``SIGNATURES``."""
    pattern = re.sub(r"\bL\b", "licen[cs]e", pattern)
    pattern = re.sub(r" ?~(\d+)", lambda m: rf" (?:[^ ]+ ){{0,{m[1]}}}?", pattern)
    return Rule(label, priority, tuple(k.encode() for k in keywords.split()), re.compile(rf"(?<![^ ])(?:{pattern})(?![^ ])".encode()))


def production_rules() -> tuple[Rule, ...]:
    """The signatures, then every version of every family, name and identifier apart."""
    found = [rule(*s) for s in SIGNATURES]
    for label, names, ids, keywords, versions in FAMILIES:
        for v in versions.split():
            number = v.replace(".", " ")
            number = number if " " in number else f"{number}(?: 0)?"
            later = "(?: or (?:any )?later(?: version)?)?"
            found.append(rule(f"{label}-{v}", NAME, keywords, f"(?:the )?(?:{names}) v(?:ersion)? ?{number}{later}"))
            found.append(rule(f"{label}-{v}", ID, keywords, f"(?:{ids}) ?v? ?{number}(?: only| or later| plus)?"))
    for kind in CC_KINDS:
        parts = kind.split("-")
        name = "creative commons " + " ".join(CONDITIONS[p] for p in parts)
        tail = "(?: international| generic| unported| L)*"
        found.append(rule(f"cc-{kind}", NAME, "creative", name + tail))
        found.append(rule(f"cc-{kind}", ID, "cc", "cc " + " ".join(parts)))
        for v in CC_VERSIONS:
            number = v.replace(".", " ")
            found.append(rule(f"cc-{kind}-{v}", NAME, "creative", f"{name}(?: L)? {number}{tail}"))
            found.append(rule(f"cc-{kind}-{v}", NAME, "cc", f"cc {' '.join(parts)} {number}"))
    return tuple(found)


_FROM = bytes(range(128))
_WORDS = bytes.maketrans(_FROM, bytes(b if chr(b).isalnum() else 32 for b in _FROM.lower()))


def words_of(text: str | None) -> list[bytes]:
    """The words of a text as UTF-8: A-Z lower-cased, runs of letters, digits and what is not ASCII."""
    return (text or "").encode().translate(_WORDS).split()


def resolve(found: Sequence[tuple[int, int, int, int]]) -> list[int]:
    """Of detections ``(priority, first, end, rule)`` those that no other suppresses, by place
    in ``found``: higher priority before lower, then longer, then the earlier rule."""
    kept: list[int] = []
    over_lo, over_hi = np.empty(0, np.int64), np.empty(0, np.int64)  # of higher priority
    by_priority: dict[int, list[int]] = {}
    for i, d in enumerate(found):
        by_priority.setdefault(d[0], []).append(i)
    for priority in sorted(by_priority):
        best: dict[tuple[int, int], int] = {}  # the earliest rule of each interval
        for i in by_priority[priority]:
            at = found[i][1:3]
            if at not in best or found[i][3] < found[best[at]][3]:
                best[at] = i
        # among them: by start, the longer first; contained if one before ends as late
        spans = sorted(best, key=lambda s: (s[0], -s[1]))
        lo, hi = (np.array(x, np.int64) for x in zip(*spans))
        before = np.concatenate([[-1], np.maximum.accumulate(hi)[:-1]])
        free = before < hi
        if len(over_lo):
            reach = np.concatenate([[-1], np.maximum.accumulate(over_hi)])
            free &= reach[np.searchsorted(over_lo, lo, "right")] < hi
        kept += [best[s] for s, ok in zip(spans, free) if ok]
        order = np.argsort(np.concatenate([over_lo, lo]), kind="stable")
        over_lo, over_hi = np.concatenate([over_lo, lo])[order], np.concatenate([over_hi, hi])[order]
    return sorted(kept, key=lambda i: (found[i][1], found[i][2], found[i][3]))


class Scanner:
    """Base phrases and rules, ready to scan one text after another."""

    def __init__(self, rules: Sequence[Rule], base: Sequence[tuple[str, str]]):
        self.rules = list(rules)
        self.by_keyword: dict[bytes, list[int]] = {}
        for i, r in enumerate(self.rules):
            for k in r.keywords:
                self.by_keyword.setdefault(k, []).append(i)
        # a look-ahead, so that places may overlap
        self.base = [(label, phrase.encode(), re.compile(rf"(?<![^ ])(?={re.escape(phrase)}(?![^ ]))".encode())) for phrase, label in base]

    def scan(self, text: str | None) -> tuple[int, list[tuple[str, int]], list[tuple[int, int, int, int]]]:
        """Number of words, base places ``(label, first word)``, detections left."""
        words = words_of(text)
        joined = b" ".join(words)
        spaces = None

        def word_at(char: int) -> int:
            nonlocal spaces
            if spaces is None:
                spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
            return int(np.searchsorted(spaces, char))

        places = [(label, word_at(m.start())) for label, phrase, at in self.base if phrase in joined for m in at.finditer(joined)]
        tried = {i for k in self.by_keyword.keys() & set(words) for i in self.by_keyword[k]}
        found = []
        for i in sorted(tried):
            r = self.rules[i]
            found += [(r.priority, word_at(m.start()), word_at(m.end() - 1) + 1, i) for m in r.pattern.finditer(joined)]
        return len(words), places, [found[i] for i in resolve(found)]

    def score(self, labels: dict[str, float]) -> float:
        """0 (nothing found) to 1: what the labels leave of the doubt."""
        doubt = 1.0
        for label in sorted(labels):
            doubt *= 1.0 - labels[label]
        return 1.0 - doubt


_OUT = pa.schema(
    [
        ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()),
        ("base_labels", pa.list_(pa.string())), ("labels", pa.list_(pa.string())), ("score", pa.float64()),
        ("detections", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("end", pa.int64()), ("priority", pa.int32())]))),
    ]
)
_OUT_DDL = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels array<string>, labels array<string>, score double, "
    "detections array<struct<label:string,first:long,end:long,priority:int>>"
)


def scan_licenses(
    docs: DataFrame, rules: Sequence[Rule] | None = None, base: Sequence[tuple[str, str]] = BASE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per input row: ``doc_id, n_words``; ``n_base`` places of base phrases, the first
    word of the first and the last of them (null: none); distinct sorted ``base_labels`` and
    ``labels`` (theirs and the rules'); ``score``; ``detections`` that resolution left, by place.

    Null and empty texts have no words, no labels and score 0. Whole texts are scanned,
    whatever their length. Null ids and repeated rows are kept; other columns are not read;
    an empty table gives an empty table. Nothing is shuffled.
    """
    rules = production_rules() if rules is None else tuple(rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules, base)
        for batch in batches:
            rows = []
            for doc_id, text in zip(*batch.columns):
                n, places, found = scanner.scan(text.as_py())
                at = [word for _, word in places]
                base_labels = {label: BASE_WEIGHT for label, _ in places}
                labels = dict(base_labels)
                for priority, _, _, i in found:
                    label = rules[i].label
                    labels[label] = max(labels.get(label, 0.0), WEIGHTS[priority])
                told = [{"label": rules[i].label, "first": a, "end": b, "priority": p} for p, a, b, i in found]
                rows.append((doc_id.as_py(), n, len(at), min(at, default=None), max(at, default=None), sorted(base_labels), sorted(labels), scanner.score(labels), told))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_OUT)], schema=_OUT)

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(run, _OUT_DDL)


def op12_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licenses named in every document."""
    from tidemark.sources.tables import table

    out = scan_licenses(table(spark, sf_dir, "documents"))
    joined = {c: F.array_join(c, ",").alias(c) for c in ("base_labels", "labels")}
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", joined["base_labels"], joined["labels"], "score")
