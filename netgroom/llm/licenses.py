"""License scans by ordered signature rules."""

from __future__ import annotations

import bisect
import re
from dataclasses import dataclass

import ahocorasick
from pyspark.sql import DataFrame

from netgroom.llm.common import map_texts, table, texts

_WORD_BYTES = bytes.maketrans(
    bytes(range(256)),
    bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)),
)

# Base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Name patterns, their label and the versions that exist.
_FAMILIES = [
    ("(?:gnu )?affero (?:gnu )?general public license", "agpl", "3"),
    ("(?:gnu )?(?:lesser|library) general public license", "lgpl", "2 2.1 3"),
    ("gnu general public license", "gpl", "1 2 3"),
    ("gnu free documentation license", "gfdl", "1.1 1.2 1.3"),
    ("apache(?: software)? license", "apache", "1.0 1.1 2.0"),
    ("mozilla public license", "mpl", "1.0 1.1 2.0"),
    ("eclipse public license", "epl", "1.0 2.0"),
    ("european union public licen[cs]e", "eupl", "1.0 1.1 1.2"),
    ("common development and distribution license", "cddl", "1.0 1.1"),
    ("common public license", "cpl", "1.0"),
    ("boost software license", "bsl", "1.0"),
    ("academic free license", "afl", "1.1 1.2 2.0 2.1 3.0"),
    ("open software license", "osl", "1.0 2.0 2.1 3.0"),
    ("artistic license", "artistic", "1.0 2.0"),
    ("microsoft public license", "ms-pl", ""),
    ("microsoft reciprocal license", "ms-rl", ""),
    ("python software foundation license", "psf", "2"),
    ("php license", "php", "3.0 3.01"),
    ("zope public license", "zpl", "1.1 2.0 2.1"),
    ("creative commons attribution sharealike", "cc-by-sa", "1.0 2.0 2.5 3.0 4.0"),
    ("creative commons attribution noncommercial", "cc-by-nc", "1.0 2.0 2.5 3.0 4.0"),
    ("creative commons attribution noderivs", "cc-by-nd", "1.0 2.0 2.5 3.0 4.0"),
    ("creative commons attribution", "cc-by", "1.0 2.0 2.5 3.0 4.0"),
    ("cc by sa", "cc-by-sa", "1.0 2.0 2.5 3.0 4.0"),
    ("cc by nc", "cc-by-nc", "1.0 2.0 2.5 3.0 4.0"),
    ("cc by nd", "cc-by-nd", "1.0 2.0 2.5 3.0 4.0"),
    ("cc by", "cc-by", "1.0 2.0 2.5 3.0 4.0"),
    ("(?:cc0|creative commons zero)", "cc0", "1.0"),
    ("open database license", "odbl", "1.0"),
    ("sil open font license", "ofl", "1.0 1.1"),
    ("(?:mit|expat) license", "mit", ""),
    ("isc license", "isc", ""),
    ("zlib license", "zlib", ""),
    ("(?:new|modified|revised|3 clause) bsd license", "bsd-3-clause", ""),
    ("(?:simplified|freebsd|2 clause) bsd license", "bsd-2-clause", ""),
    ("(?:(?:original|4 clause) bsd license|bsd 4 clause(?: license)?)", "bsd-4-clause", ""),
    ("bsd 3 clause(?: license)?", "bsd-3-clause", ""),
    ("bsd 2 clause(?: license)?", "bsd-2-clause", ""),
    ("bsd license", "bsd", ""),
    ("(?:the )?unlicense", "unlicense", ""),
    ("do what the fuck you want to public license", "wtfpl", "2"),
]

# Sentences that licences and notices consist of: pattern, label, weight.
_NOTICES = [
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 0.9),
    ("redistribution and use in source and binary forms with or without modification", "bsd", 0.9),
    ("permission to use copy modify and or distribute this software for any purpose", "isc", 0.9),
    ("this is free and unencumbered software released into the public domain", "unlicense", 0.9),
    ("all rights reserved", "all-rights-reserved", 0.6),
    ("released into the public domain", "public-domain", 0.8),
    ("spdx license identifier", "spdx", 0.7),
]

# Short ids (as SPDX has them) and their versions; a version stands behind them.
_SHORT = [
    ("gpl", "1 2 3"),
    ("lgpl", "2 2.1 3"),
    ("agpl", "1 3"),
    ("gfdl", "1.1 1.2 1.3"),
    ("apache", "1.0 1.1 2.0"),
    ("mpl", "1.0 1.1 2.0"),
    ("epl", "1.0 2.0"),
    ("eupl", "1.0 1.1 1.2"),
    ("cddl", "1.0 1.1"),
    ("afl", "1.1 1.2 2.0 2.1 3.0"),
    ("osl", "1.0 2.0 2.1 3.0"),
    ("ofl", "1.0 1.1"),
    ("odbl", "1.0"),
    ("zpl", "1.1 2.0 2.1"),
]

# Ids that count behind the SPDX tag only, and those among them with versions.
_TAGGED = {
    "mit": "mit", "isc": "isc", "zlib": "zlib", "unlicense": "unlicense", "wtfpl": "wtfpl", "0bsd": "0bsd", "ms pl": "ms-pl", "ms rl": "ms-rl",
    "bsd 2 clause": "bsd-2-clause", "bsd 3 clause": "bsd-3-clause", "bsd 4 clause": "bsd-4-clause", "cc0 1 0": "cc0-1.0",
}
_TAGGED_VERSIONS = [("cpl", "1.0"), ("bsl", "1.0"), ("artistic", "1.0 2.0"), ("psf", "2"), ("php", "3.0 3.01")]
_TAGGED_VERSIONS += [(f"cc by{kind}", "1.0 2.0 2.5 3.0 4.0") for kind in ("", " sa", " nc", " nd", " nc sa", " nc nd")]
_TAG = "spdx license identifier "


@dataclass(frozen=True)
class Rule:
    """A signature: lower ``priority`` wins; ``anchors`` are the words it can begin with."""

    priority: int
    label: str
    weight: float
    pattern: re.Pattern
    anchors: tuple[str, ...]


def wordings(pattern: str) -> list[str]:
    """All texts that a pattern of words, optional groups and alternatives matches."""
    found = re.search(r"\(\?:([^()]*)\)(\??)|\[(\w+)\]", pattern)
    if not found:
        return [pattern]
    choices = list(found[3]) if found[3] else found[1].split("|") + [""] * bool(found[2])
    return [w for c in choices for w in wordings(pattern[: found.start()] + c + pattern[found.end() :])]


def rules() -> list[Rule]:
    """A rule for each family, version and wording.

    A version without a label of its own keeps its family's, as the base labels do.
    """
    out = []
    for name, label, versions in _FAMILIES:
        anchors = [f" {w} " for w in wordings(name)]
        for v in versions.split():
            number = re.escape(v.replace(".", " ")).replace("\\ ", " ")
            short = number.removesuffix(" 0")
            exact = rf"{name} (?:version |v)?{number}"
            brief = rf"{name} (?:version |v)?{short}(?! \d )"
            out.append((1, f"{label}-{v}", 0.95, exact, anchors))
            if short != number:
                out.append((2, f"{label}-{v}", 0.9, brief, anchors))
            out.append((3, f"{label}-{v}-or-later", 0.97, rf"{name} (?:version |v)?(?:{number}|{short}) or (?:any )?later", anchors))
        out.append((4, label, 0.8, name, anchors))
    for word, versions in _SHORT + _TAGGED_VERSIONS:
        label = word.replace(" ", "-")
        tagged = (word, versions) in _TAGGED_VERSIONS
        behind = _TAG if tagged else f"(?:{_TAG})?"
        anchors = [f" {_TAG}{word}"] if tagged else [f" {_TAG}{word}", f" {word}"]
        for v in versions.split():
            # gpl-3.0 is gpl-3; other versions are written in full
            number = v.replace(".", " ") + ("" if "." in v else "(?: 0)?")
            short = rf"{behind}{word}(?: version | ?v ?| )?{number}"
            out.append((2, f"{label}-{v}", 0.9, rf"{short}(?: only)?(?! \d )", anchors))
            out.append((2, f"{label}-{v}-or-later", 0.95, rf"{short} or (?:any )?later", anchors))
    out += [(2, label, 0.95, f"{_TAG}{word}", [f" {_TAG}{word} "]) for word, label in _TAGGED.items()]
    out += [(5, label, weight, pattern, [f" {pattern} "]) for pattern, label, weight in _NOTICES]
    return [Rule(p, label, w, re.compile(rf"(?:{pattern})(?= )".encode()), tuple(a)) for p, label, w, pattern, a in out]


class Scanner:
    """Rules behind one automaton of all their anchors: a rule is tried only where one of its anchors stands."""

    def __init__(self, ordered: list[Rule] | None = None):
        self.rules = rules() if ordered is None else ordered
        behind: dict[str, list[int]] = {}
        for k, rule in enumerate(self.rules):
            for anchor in rule.anchors:
                behind.setdefault(anchor, []).append(k)
        self.anchors = ahocorasick.Automaton()
        for anchor, ks in behind.items():
            self.anchors.add_word(anchor, (len(anchor), ks))
        self.anchors.make_automaton()

    def detect(self, words: bytes) -> list[tuple[int, int, str, float]]:
        """(start, end, label, weight) of detections in words joined by single spaces, with one at each end.

        Of overlapping detections the longer stands; one contained in another goes;
        equal ones and partial overlaps go by priority, then by order of the rules.
        """
        hits = []
        for end, (size, ks) in self.anchors.iter(words.decode("latin-1")):
            for k in ks:
                rule = self.rules[k]
                m = rule.pattern.match(words, end - size + 2)
                if m:
                    hits.append((m.start() - m.end(), rule.priority, k, m.start(), m.end(), rule.label, rule.weight))
        hits.sort()
        # kept intervals never overlap: their neighbours in order of start decide
        starts: list[int] = []
        kept: list[tuple[int, int, str, float]] = []
        for *_, start, end, label, weight in hits:
            k = bisect.bisect_left(starts, end)
            if k and kept[k - 1][1] > start:
                continue
            starts.insert(k, start)
            kept.insert(k, (start, end, label, weight))
        return kept


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_base, first_word, last_word, base_labels, labels, score) of every whole text.

    Words are maximal runs of digits, letters and non-ASCII characters, A-Z in lower case.
    Base phrases count at every place; the rules add labels.  ``score`` is the
    chance that at least one detection holds, its weights taken as independent.
    A null or empty text has no words and no labels ('') and score 0; repeated rows are
    answered each.
    """

    def make():
        scanner = Scanner()
        phrases = [(f" {p} ".encode(), label) for p, label in BASE.items()]

        def work(i, text):
            words = (text or "").encode().translate(_WORD_BYTES).split()
            joined = b" " + b" ".join(words) + b" "
            places, base = [], set()
            for phrase, label in phrases:
                at = joined.find(phrase)
                while at >= 0:
                    places.append(at)
                    base.add(label)
                    at = joined.find(phrase, at + 1)
            ends = [joined.count(b" ", 0, at) for at in (min(places), max(places))] if places else [None, None]
            found = scanner.detect(joined)
            miss = 1.0
            for *_, weight in found:
                miss *= 1.0 - weight
            labels = base | {label for *_, label, _ in found}
            score = round(1.0 - miss, 6) if found else (0.8 if base else 0.0)
            yield i, len(words), len(places), *ends, ",".join(sorted(base)), ",".join(sorted(labels)), score

        return work

    schema = "id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    return map_texts(texts(df, id_col, text_col), schema, make).withColumnRenamed("id", id_col)


def op7_licenses(spark, sf_dir):
    return scan_licenses(table(spark, sf_dir, "documents"))
