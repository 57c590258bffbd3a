"""Signatures of licences, in order, over text of lower-case words with single blanks between them.

A rule is (label, priority, keyword, regex). A text is searched with a rule only if it holds the
rule's keyword. Priority 1 is a full reference with its version or a licence's own wording, 2 a
name with version, 3 a name, 4 a general phrase. Dots of versions are blanks here: "2 0".
"""

from __future__ import annotations

from typing import NamedTuple


class Rule(NamedTuple):
    label: str
    priority: int
    keyword: str
    regex: str
    base: bool = False


# The phrases that the contract names, with their labels (fixed values).
BASE = [
    Rule("cc-by", 3, "cc by", r"cc by", True),
    Rule("gpl", 3, "general public license", r"general public license", True),
    Rule("reserved", 4, "all rights reserved", r"all rights reserved", True),
]

# label, keyword, name as a regex, tokens of its short identifier, versions (as words)
FAMILIES = [
    ("gpl", "gpl", r"gpl", "gpl", ["1 0", "2 0", "3 0"]),
    ("gpl", "general public", r"(?:gnu )?general public licen[cs]e", None, ["1", "2", "3"]),
    ("lgpl", "lgpl", r"lgpl", "lgpl", ["2 0", "2 1", "3 0"]),
    ("lgpl", "general public", r"(?:gnu )?(?:lesser|library) general public licen[cs]e", None, ["2", "2 1", "3"]),
    ("agpl", "agpl", r"agpl", "agpl", ["1 0", "3 0"]),
    ("agpl", "affero", r"(?:gnu )?affero general public licen[cs]e", None, ["1", "3"]),
    ("gfdl", "free documentation", r"(?:gnu )?free documentation licen[cs]e", None, ["1 1", "1 2", "1 3"]),
    ("apache", "apache", r"apache(?: software)?(?: foundation)? licen[cs]e", "apache", ["1 0", "1 1", "2 0"]),
    ("mpl", "mozilla", r"mozilla public licen[cs]e", None, ["1 0", "1 1", "2 0"]),
    ("mpl", "mpl", r"mpl", "mpl", ["1 0", "1 1", "2 0"]),
    ("epl", "eclipse", r"eclipse public licen[cs]e", None, ["1 0", "2 0"]),
    ("epl", "epl", r"epl", "epl", ["1 0", "2 0"]),
    ("cpl", "common public", r"common public licen[cs]e", None, ["0 5", "1 0"]),
    ("cddl", "common development", r"common development and distribution licen[cs]e", None, ["1 0", "1 1"]),
    ("cddl", "cddl", r"cddl", "cddl", ["1 0", "1 1"]),
    ("eupl", "european union public", r"european union public licen[cs]e", None, ["1 0", "1 1", "1 2"]),
    ("eupl", "eupl", r"eupl", "eupl", ["1 0", "1 1", "1 2"]),
    ("osl", "open software", r"open software licen[cs]e", None, ["1 0", "1 1", "2 0", "2 1", "3 0"]),
    ("afl", "academic free", r"academic free licen[cs]e", None, ["1 1", "1 2", "2 0", "2 1", "3 0"]),
    ("artistic", "artistic", r"(?:the )?artistic licen[cs]e", "artistic", ["1 0", "2 0"]),
    ("lppl", "latex project", r"latex project public licen[cs]e", None, ["1 0", "1 1", "1 2", "1 3a", "1 3c"]),
    ("ofl", "open font", r"(?:sil )?open font licen[cs]e", None, ["1 0", "1 1"]),
    ("odbl", "open database", r"open database licen[cs]e", None, ["1 0"]),
    ("odc-by", "open data commons", r"open data commons attribution licen[cs]e", None, ["1 0"]),
    ("pddl", "public domain dedication", r"public domain dedication and licen[cs]e", None, ["1 0"]),
    ("psf", "python software", r"python software foundation licen[cs]e", None, ["2"]),
    ("php", "php", r"php licen[cs]e", "php", ["3 0", "3 01"]),
    ("zpl", "zope", r"zope public licen[cs]e", None, ["1 1", "2 0", "2 1"]),
    ("boost", "boost", r"boost software licen[cs]e", None, ["1 0"]),
    ("bsl", "business source", r"business source licen[cs]e", None, ["1 0", "1 1"]),
    ("sspl", "server side public", r"server side public licen[cs]e", None, ["1"]),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e", None, ["1 0"]),
    ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e", None, ["1 0"]),
    ("cecill", "cecill", r"cecill(?: (?:b|c))?", "cecill", ["1 0", "2 0", "2 1"]),
    ("w3c", "w3c", r"w3c software(?: notice)?(?: and)? licen[cs]e", None, ["1 0"]),
    ("openssl", "openssl", r"openssl licen[cs]e", None, ["1 0"]),
    ("ogl-uk", "open government", r"open government licen[cs]e", None, ["1 0", "2 0", "3 0"]),
    ("etalab", "etalab", r"(?:etalab )?licence ouverte|etalab", None, ["1 0", "2 0"]),
    ("dl-de", "datenlizenz", r"datenlizenz deutschland(?: namensnennung| zero)?", None, ["1 0", "2 0"]),
]
CC_KINDS = ["by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"]
CC_NAMES = {
    "by": r"attribution",
    "by sa": r"attribution share ?alike",
    "by nc": r"attribution non ?commercial",
    "by nd": r"attribution no ?deriv(?:ative)?s",
    "by nc sa": r"attribution non ?commercial share ?alike",
    "by nc nd": r"attribution non ?commercial no ?deriv(?:ative)?s",
}
CC_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]

# Wordings of single licences and general phrases.
SINGLE = [
    Rule("mit", 1, "permission is hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy of this software"),
    Rule("mit", 1, "without restriction including", r"to deal in the software without restriction including without limitation the rights"),
    Rule("mit", 1, "merchantability", r"the software is provided as is without warranty of any kind express or implied"),
    Rule("mit", 2, "mit", r"(?:released|licensed|distributed|available) under (?:the )?(?:terms of )?(?:the )?mit licen[cs]e"),
    Rule("mit", 2, "opensource org", r"opensource org licenses mit(?: license php)?"),
    Rule("mit", 3, "mit", r"(?:the )?(?:mit|expat) licen[cs]e"),
    Rule("x11", 3, "x11", r"x11 licen[cs]e"),
    Rule("isc", 1, "permission to use", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    Rule("isc", 3, "isc", r"isc licen[cs]e"),
    Rule("bsd", 1, "redistribution and use", r"redistribution and use in source and binary forms with or without modification are permitted"),
    Rule("bsd", 1, "redistributions of source", r"redistributions of source code must retain the above copyright notice"),
    Rule("bsd", 1, "redistributions in binary", r"redistributions in binary form must reproduce the above copyright notice"),
    Rule("bsd-3", 1, "neither the name", r"neither the name of .{1,80}? nor the names of its contributors"),
    Rule("bsd-4", 1, "advertising materials", r"all advertising materials mentioning features or use of this software"),
    Rule("bsd-2", 2, "bsd", r"(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)(?: licen[cs]e)?"),
    Rule("bsd-3", 2, "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[cs]e)?"),
    Rule("bsd-4", 2, "bsd", r"(?:original bsd|old bsd|bsd 4 clause|4 clause bsd)(?: licen[cs]e)?"),
    Rule("bsd-0", 2, "bsd", r"(?:zero clause bsd|0bsd|bsd zero clause)(?: licen[cs]e)?"),
    Rule("bsd", 3, "bsd", r"bsd(?: style)? licen[cs]e"),
    Rule("zlib", 1, "misrepresented", r"the origin of this software must not be misrepresented"),
    Rule("zlib", 3, "zlib", r"zlib(?: libpng)? licen[cs]e"),
    Rule("libpng", 3, "libpng", r"libpng licen[cs]e"),
    Rule("unlicense", 1, "unencumbered", r"this is free and unencumbered software released into the public domain"),
    Rule("unlicense", 3, "unlicense", r"(?:the )?unlicense"),
    Rule("wtfpl", 3, "wtfpl", r"wtfpl"),
    Rule("wtfpl", 1, "what the", r"do what the \w+ you want to public licen[cs]e"),
    Rule("beerware", 3, "beerware", r"beerware(?: licen[cs]e)?"),
    Rule("cc0", 1, "publicdomain zero", r"creativecommons org publicdomain zero 1 0"),
    Rule("cc0", 2, "cc0", r"cc0(?: 1 0)?(?: universal)?"),
    Rule("cc-pd", 1, "publicdomain mark", r"creativecommons org publicdomain mark 1 0"),
    Rule("cc", 3, "creative commons", r"creative commons(?: public)?(?: licen[cs]es?)?"),
    Rule("apache", 1, "compliance with the license", r"you may not use this file except in compliance with the license"),
    Rule("apache", 1, "apache org licenses", r"www apache org licenses license 2 0(?: txt| html)?"),
    Rule("apache", 3, "apache", r"asl 2 0|apache2"),
    Rule("gpl", 1, "either version", r"either version \d(?: of the license)? or at your option any later version"),
    Rule("gpl", 1, "free software foundation", r"as published by the free software foundation"),
    Rule("gpl", 1, "gnu org licenses", r"www gnu org licenses (?:old licenses )?gpl(?: \d 0)?(?: html| txt| en html)?"),
    Rule("lgpl", 1, "gnu org licenses", r"www gnu org licenses (?:old licenses )?lgpl(?: \d [01])?(?: html| txt| en html)?"),
    Rule("agpl", 1, "gnu org licenses", r"www gnu org licenses agpl(?: \d 0)?(?: html| txt| en html)?"),
    Rule("gfdl", 1, "gnu org licenses", r"www gnu org (?:copyleft|licenses) fdl(?: \d \d)?(?: html| txt)?"),
    Rule("mpl", 1, "mozilla org mpl", r"(?:www )?mozilla org mpl(?: 2 0| \d \d)?"),
    Rule("mpl", 1, "source code form", r"this source code form is subject to the terms of the mozilla public licen[cs]e v(?:ersion)? ?2 0"),
    Rule("epl", 1, "eclipse org legal", r"(?:www )?eclipse org legal epl(?: v10| v20| 2 0)?(?: html)?"),
    Rule("public-domain", 3, "public domain", r"(?:released|placed|dedicated|is) (?:in|into|to) the public domain"),
    Rule("public-domain", 4, "public domain", r"public domain"),
    Rule("proprietary", 2, "confidential", r"proprietary and confidential"),
    Rule("proprietary", 2, "unauthorized", r"unauthori[sz]ed (?:copying|reproduction|use|distribution)(?: or distribution)?(?: of this \w+)?(?: via any medium)? is (?:strictly )?prohibited"),
    Rule("proprietary", 2, "without permission", r"may not be (?:reproduced|copied|distributed|used) without (?:prior )?(?:written )?permission"),
    Rule("proprietary", 2, "prior written", r"without the (?:express )?prior written (?:permission|consent) of"),
    Rule("non-commercial", 3, "commercial use", r"(?:for )?non ?commercial use only"),
    Rule("copyright", 4, "copyright", r"copyright(?: c)? (?:19|20)\d\d(?: (?:19|20)\d\d)?"),
    Rule("copyright", 4, "copyright", r"copyright holders?"),
    Rule("licence", 4, "licensed under", r"(?:is |are )?licensed under (?:the|a|an)?"),
    Rule("licence", 4, "released under", r"released under (?:the|a|an)"),
    Rule("licence", 4, "distributed under", r"distributed under the terms of"),
    Rule("no-warranty", 4, "warrant", r"without (?:any )?warrant(?:y|ies)(?: of any kind)?"),
]


def _families() -> list[Rule]:
    made = []
    for label, keyword, name, short, versions in FAMILIES:
        for version in versions:
            major, _, minor = version.partition(" ")
            number = rf"{major}(?: {minor})?" if minor in ("", "0") else version
            made.append(Rule(f"{label}-{version.replace(' ', '.')}", 2, keyword, rf"(?:{name})(?: as published by the free software foundation)? (?:version |ver |v ?)?{number}(?: or (?:any )?(?:later|newer)(?: versions?)?| only)?"))
            if short:
                spdx = rf"spdx license identifier {short} {major}(?: {minor or 0})?(?: only| or later)?"
                made.append(Rule(f"{label}-{version.replace(' ', '.')}", 1, "spdx", spdx))
        if label not in ("mpl", "epl", "gpl") or " " in name:
            made.append(Rule(label, 3, keyword, name))
    return made


def _creative_commons() -> list[Rule]:
    made = []
    for kind in CC_KINDS:
        label = f"cc-{kind.replace(' ', '-')}"
        for version in CC_VERSIONS:
            full = f"{label}-{version.replace(' ', '.')}"
            made += [
                Rule(full, 1, "creativecommons", rf"creativecommons org licenses {kind} {version}(?: (?:deed|legalcode)(?: \w\w)?)?"),
                Rule(full, 2, "cc", rf"cc {kind} {version}(?: international| unported)?"),
                Rule(full, 2, "attribution", rf"(?:creative commons )?{CC_NAMES[kind]} {version}(?: international| unported| generic)?(?: licen[cs]e)?"),
            ]
        made.append(Rule(label, 3, "cc", rf"cc {kind}"))
        if kind != "by":
            made.append(Rule(label, 3, "attribution", rf"(?:creative commons )?{CC_NAMES[kind]}"))
    return made


def _named() -> list[Rule]:
    """Short identifiers of licences without versions."""
    names = ["mit", "isc", "zlib", "unlicense", "0bsd", "bsd 2 clause", "bsd 3 clause", "bsl 1 0", "cc0 1 0", "wtfpl", "postgresql", "ncsa"]
    return [Rule(n.replace(" ", "-"), 1, "spdx", rf"spdx license identifier {n}") for n in names]


RULES: list[Rule] = [*BASE, *SINGLE, *_named(), *_families(), *_creative_commons()]
