"""Signature rules for license texts, notices and tags.

A rule's pattern is written over words parted by single blanks, all in lower case; digits and
letters around full stops and hyphens are words of their own (``apache 2 0``).
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

# Phrases that count by themselves, with their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

# Name of a family, its full names, its short names and its versions.
VERSIONED = (
    ("gpl", ("gnu general public license", "general public license"), ("gnu gpl", "gpl"), ("1.0", "2.0", "3.0")),
    ("lgpl", ("gnu lesser general public license", "lesser general public license", "gnu library general public license"), ("gnu lgpl", "lgpl"), ("2.0", "2.1", "3.0")),
    ("agpl", ("gnu affero general public license", "affero general public license"), ("gnu agpl", "agpl"), ("1.0", "3.0")),
    ("gfdl", ("gnu free documentation license",), ("gfdl", "gnu fdl"), ("1.1", "1.2", "1.3")),
    ("apache", ("apache license", "apache software license"), ("apache",), ("1.0", "1.1", "2.0")),
    ("mpl", ("mozilla public license",), ("mpl",), ("1.0", "1.1", "2.0")),
    ("epl", ("eclipse public license",), ("epl",), ("1.0", "2.0")),
    ("cpl", ("common public license",), ("cpl",), ("1.0",)),
    ("ipl", ("ibm public license",), (), ("1.0",)),
    ("cddl", ("common development and distribution license",), ("cddl",), ("1.0", "1.1")),
    ("eupl", ("european union public licence", "european union public license"), ("eupl",), ("1.0", "1.1", "1.2")),
    ("osl", ("open software license",), ("osl",), ("1.0", "1.1", "2.0", "2.1", "3.0")),
    ("afl", ("academic free license",), ("afl",), ("1.1", "1.2", "2.0", "2.1", "3.0")),
    ("artistic", ("artistic license",), (), ("1.0", "2.0")),
    ("ofl", ("sil open font license", "open font license"), ("sil ofl", "ofl"), ("1.0", "1.1")),
    ("lppl", ("latex project public license",), ("lppl",), ("1.0", "1.1", "1.2", "1.3a", "1.3c")),
    ("cecill", ("cecill free software license agreement", "cecill license"), ("cecill",), ("1.0", "1.1", "2.0", "2.1")),
    ("zpl", ("zope public license",), ("zpl",), ("1.1", "2.0", "2.1")),
    ("qpl", ("q public license",), ("qpl",), ("1.0",)),
    ("npl", ("netscape public license",), ("npl",), ("1.0", "1.1")),
    ("apsl", ("apple public source license",), ("apsl",), ("1.0", "1.1", "1.2", "2.0")),
    ("boost", ("boost software license",), ("bsl",), ("1.0",)),
    ("ecl", ("educational community license",), ("ecl",), ("1.0", "2.0")),
    ("php", ("php license",), (), ("3.0", "3.01")),
    ("psf", ("python software foundation license",), ("psf license",), ("2.0",)),
    ("sspl", ("server side public license",), ("sspl",), ("1.0",)),
    ("busl", ("business source license",), ("busl",), ("1.0", "1.1")),
    ("odbl", ("open database license", "open data commons open database license"), ("odbl",), ("1.0",)),
    ("odc-by", ("open data commons attribution license",), (), ("1.0",)),
    ("mulan-psl", ("mulan permissive software license",), ("mulan psl",), ("1.0", "2.0")),
    ("rpl", ("reciprocal public license",), (), ("1.1", "1.5")),
    ("cpal", ("common public attribution license",), ("cpal",), ("1.0",)),
    ("spl", ("sun public license",), (), ("1.0",)),
    ("cern-ohl", ("cern open hardware licence", "cern open hardware license"), ("cern ohl",), ("1.1", "1.2", "2.0")),
    ("elastic", ("elastic license",), (), ("2.0",)),
)

# Licenses without versions and the names that are clear by themselves.
NAMED = (
    ("mit", ("the mit license", "mit license", "mit licence", "expat license", "x11 license")),
    ("bsd", ("bsd license", "bsd licence", "bsd style license", "berkeley software distribution license")),
    ("bsd-2-clause", ("2 clause bsd license", "bsd 2 clause", "simplified bsd license", "freebsd license", "two clause bsd license")),
    ("bsd-3-clause", ("3 clause bsd license", "bsd 3 clause", "new bsd license", "modified bsd license", "revised bsd license", "three clause bsd license")),
    ("bsd-4-clause", ("4 clause bsd license", "bsd 4 clause", "original bsd license")),
    ("0bsd", ("zero clause bsd", "bsd zero clause license")),
    ("isc", ("isc license", "isc licence")),
    ("zlib", ("zlib license", "zlib libpng license", "zlib licence")),
    ("unlicense", ("the unlicense", "unlicense org")),
    ("wtfpl", ("wtfpl", "do what the fuck you want to public license")),
    ("cc0", ("cc0", "creative commons zero", "creativecommons org publicdomain zero")),
    ("ms-pl", ("microsoft public license",)),
    ("ms-rl", ("microsoft reciprocal license",)),
    ("openssl", ("openssl license",)),
    ("curl", ("curl license",)),
    ("ncsa", ("university of illinois ncsa open source license", "ncsa open source license")),
    ("postgresql", ("postgresql license",)),
    ("beerware", ("beer ware license", "beerware license")),
    ("json", ("the json license",)),
    ("ruby", ("ruby license",)),
    ("vim", ("vim license",)),
    ("w3c", ("w3c software notice and license", "w3c software license")),
    ("blueoak", ("blue oak model license",)),
    ("bigscience-rail", ("bigscience rail license", "responsible ai license")),
)

# Endings of the attribution family and their spelt-out names.
COMMONS = (
    ("cc-by", "attribution", "by"),
    ("cc-by-sa", "attribution share ?alike", "by sa"),
    ("cc-by-nd", "attribution no ?deriv(?:ative|ative works|s|atives)", "by nd"),
    ("cc-by-nc", "attribution non ?commercial", "by nc"),
    ("cc-by-nc-sa", "attribution non ?commercial share ?alike", "by nc sa"),
    ("cc-by-nc-nd", "attribution non ?commercial no ?deriv(?:ative|ative works|s|atives)", "by nc nd"),
)
COMMONS_VERSIONS = ("1.0", "2.0", "2.5", "3.0", "4.0")

# Sentences of license texts. Label, words that must stand in the text, pattern.
SENTENCES = (
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-3-clause", "may be used to endorse or promote products", "neither the name (?:[^ ]+ ){1,30}?may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "all advertising materials mentioning features", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("isc", "permission to use copy modify and", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted"),
    ("zlib", "altered source versions must be plainly marked", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("gpl", "redistribute it and or modify it under the terms", "is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "redistribute it and or modify it under the terms", "is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", "redistribute it and or modify it under the terms", "is free software you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl", "gnu general public license along with this", "you should have received a copy of the gnu general public license along with this"),
    ("gfdl", "distribute and or modify this document", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("apache-2.0", "licensed under the apache license version 2", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2.0", "apache org licenses license 2 0", "apache org licenses license 2 0"),
    ("apache-1.1", "this product includes software developed by the apache", "this product includes software developed by the apache software foundation"),
    ("mpl-2.0", "subject to the terms of the mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("epl-1.0", "eclipse org legal epl v10", "eclipse org legal epl v10(?: html)?"),
    ("epl-2.0", "eclipse org legal epl", "eclipse org legal epl (?:v20|2 0)(?: html)?"),
    ("boost-1.0", "boost org license 1 0 txt", "boost org license 1 0 txt"),
    ("unlicense", "free and unencumbered software", "this is free and unencumbered software released into the public domain"),
    ("public-domain", "released into the public domain", "(?:is|are|been) (?:hereby )?released into the public domain"),
    ("public-domain", "to the public domain", "dedicated? (?:[^ ]+ ){0,6}?to the public domain"),
    ("cc0", "waived all copyright and related", "waived all copyright and related or neighboring rights"),
    ("wtfpl", "you just do what the fuck you want to", "you just do what the fuck you want to"),
    ("ofl-1.1", "this font software is licensed under the sil", "this font software is licensed under the sil open font license version 1 1"),
    ("artistic-2.0", "the artistic license 2 0", "the artistic license 2 0"),
    ("openssl", "developed by the openssl project", "this product includes software developed by the openssl project"),
    ("psf-2.0", "psf hereby grants licensee", "psf hereby grants licensee a nonexclusive royalty free world ?wide license"),
    ("ncsa", "to deal with the software without restriction", "to deal with the software without restriction including without limitation the rights"),
    ("beerware", "buy me a beer in return", "you can buy me a beer in return"),
    ("json", "shall be used for good not evil", "the software shall be used for good not evil"),
    ("proprietary", "all rights reserved", "(?:confidential|proprietary) (?:[^ ]+ ){0,8}?all rights reserved"),
    ("proprietary", "unauthorized copying of this", "unauthorized copying of this (?:file|software|document)(?: [^ ]+){0,6}? is strictly prohibited"),
)

# Confidence and priority of the kinds of rules, the strongest first.
SENTENCE, TAG, NOTICE, LATER, VERSION, NAME, PHRASE = (
    (7, 1.0), (6, 1.0), (5, 0.95), (4, 0.95), (3, 0.9), (2, 0.8), (1, 0.7),
)


@dataclass(frozen=True)
class Rule:
    """`keyword` stands in every text that `pattern` matches."""

    label: str
    priority: int
    score: float
    keyword: str
    pattern: str
    base: bool = False


def _version(version: str) -> str:
    """Words of a version: ``2 0``, ``v2 0``, ``2``, ``version 2 0``."""
    major, minor = version.split(".")
    rest = "(?: 0)?" if minor == "0" else f" {minor}"
    return f"(?:version |ver |v )?v?{major}{rest}"


def _family(stem: str, full: tuple, short: tuple, versions: tuple) -> list[Rule]:
    out = []
    for name in full:
        out.append(Rule(stem, *NAME, name, name))
        out.append(Rule(stem, *NOTICE, name, f"(?:licensed|released|distributed|available|covered) under (?:the )?(?:terms of )?(?:the )?{name}"))
    for name in (*full, *short):
        for version in versions:
            label, number = f"{stem}-{version}", _version(version)
            out.append(Rule(label, *VERSION, name, f"{name} {number}"))
            later = f"{name} (?:as published by the free software foundation )?(?:either )?{number} (?:of the license )?or (?:at your option )?(?:any )?(?:later|newer)"
            out.append(Rule(f"{label}-or-later", *LATER, name, later))
    for version in versions:
        major, minor = version.split(".")
        tag = f"spdx license identifier {stem.replace('-', ' ')} {major} {minor}"
        out.append(Rule(f"{stem}-{version}", *TAG, tag, f"{tag}(?: only)?"))
        out.append(Rule(f"{stem}-{version}-or-later", *TAG, tag, f"{tag} or later"))
    return out


def _commons(label: str, spelt: str, letters: str) -> list[Rule]:
    out = [Rule(label, *NAME, "creative commons", f"creative commons {spelt}")]
    if letters != "by":  # the plain letters are a phrase of the base
        out.append(Rule(label, *NAME, f"cc {letters}", f"cc {letters}"))
    out.append(Rule(label, *TAG, "creativecommons org licenses", f"creativecommons org licenses {letters}"))
    for version in COMMONS_VERSIONS:
        major, minor = version.split(".")
        exact = f"{label}-{version}"
        out.append(Rule(exact, *VERSION, "creative commons", f"creative commons {spelt} {major} {minor}"))
        out.append(Rule(exact, *VERSION, f"cc {letters}", f"cc {letters} {major} {minor}"))
        out.append(Rule(exact, *TAG, "creativecommons org licenses", f"creativecommons org licenses {letters} {major} {minor}"))
    return out


@cache
def rules() -> tuple[Rule, ...]:
    """All rules in order; of two that tie, the earlier one counts."""
    out = [Rule(label, *PHRASE, phrase, phrase, True) for phrase, label in BASE.items()]
    out += [Rule(label, *SENTENCE, keyword, pattern) for label, keyword, pattern in SENTENCES]
    for family in VERSIONED:
        out += _family(*family)
    for parts in COMMONS:
        out += _commons(*parts)
    for label, names in NAMED:
        out += [Rule(label, *NAME, name, name) for name in names]
        tag = f"spdx license identifier {label.replace('-', ' ')}"
        out.append(Rule(label, *TAG, tag, tag))
    return tuple(out)
