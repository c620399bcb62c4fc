"""Signature rules for licence texts, most specific first.

A rule is a regular expression over words in lower case with one blank between them. Rules come from licence families
crossed with the phrasings below; ``keyword`` is a part of a word that every match holds.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    priority: int  # of its phrasing; smaller wins, and of equal ones the longer match
    label: str
    keyword: str
    pattern: str
    weight: float


# Label, names as words of regular expressions.
FAMILIES = {
    "afl": "academic free",
    "agpl": "(?:gnu )?affero general public|agpl(?:v3)?",
    "apache": "apache(?: software)?",
    "apsl": "apple public source",
    "artistic": "(?:perl )?artistic",
    "beerware": "beerware|beer ware",
    "bsd": "(?:new |modified |simplified |original )?bsd(?: [234] clause)?|berkeley software distribution",
    "bsl": "boost software",
    "busl": "business source",
    "cc-by": "(?:creative commons )?attribution|cc by",
    "cc-by-sa": "(?:creative commons )?attribution share ?alike|cc by sa",
    "cc0": "cc0|creative commons zero",
    "cddl": "common development and distribution",
    "cecill": "cecill",
    "cpl": "common public",
    "ecl": "educational community",
    "epl": "eclipse public",
    "eupl": "european union public|eupl",
    "gfdl": "gnu free documentation|gfdl",
    "gpl": "(?:gnu )?general public|gnu gpl|gpl(?:v[23])?",
    "ipl": "ibm public",
    "isc": "isc",
    "lgpl": "(?:gnu )?(?:lesser|library) general public|lgpl(?:v[23])?",
    "lppl": "latex project public",
    "mit": "mit|expat|x11",
    "mpl": "mozilla public|mpl",
    "ms-pl": "microsoft public",
    "ms-rl": "microsoft reciprocal",
    "mulan": "mulan(?: permissive software)?",
    "ncsa": "university of illinois(?: ncsa)? open source|ncsa",
    "npl": "netscape public",
    "odbl": "open (?:data commons )?(?:open )?database|odbl",
    "ofl": "sil open font|open font",
    "openssl": "openssl",
    "osl": "open software",
    "php": "php",
    "postgresql": "postgresql",
    "psf": "python software foundation|psf",
    "qpl": "q public|qt public",
    "ruby": "ruby",
    "sspl": "server side public",
    "unlicense": "unlicense",
    "upl": "universal permissive",
    "vim": "vim",
    "w3c": "w3c(?: software)?",
    "wtfpl": "do what the fuck you want to public|wtfpl",
    "zlib": "zlib(?: libpng)?",
    "zpl": "zope public",
}

# Phrasings, most specific first: keyword, words around a name, weight.
PHRASINGS = [
    ("spdx", "spdx license identifier {name}(?: v?[0-9]+(?: [0-9]+)*)?(?: or later| only)?", 1.0),
    ("licens", "licensed under (?:the )?(?:terms of )?(?:the )?{name}(?: licen[sc]e)? v(?:ersion)? ?[0-9]+(?: [0-9]+)*", 1.0),
    ("licens", "licensed under (?:the )?(?:terms of )?(?:the )?{name} licen[sc]e", 0.95),
    ("licen", "(?:distributed|released|available|redistribute(?: it)?) under (?:the )?(?:terms of )?(?:the )?{name} licen[sc]e", 0.95),
    ("licens", "{name} license(?: as published by the free software foundation)?(?: v(?:ersion)? ?[0-9]+(?: [0-9]+)*)", 0.9),
    ("licens", "{name} (?:public )?license", 0.8),
    ("licenc", "{name} (?:public )?licence(?: v(?:ersion)? ?[0-9]+(?: [0-9]+)*)?", 0.8),
]

# Sentences from licence texts, after the phrasings: label, keyword, words, weight.
SENTENCES = [
    ("mit", "granted", "permission is hereby granted free of charge to any person obtaining a copy of this software", 1.0),
    ("bsd", "redistribut", "redistribution and use in source and binary forms with or without modification are permitted", 1.0),
    ("isc", "permission", "permission to use copy modify and or distribute this software for any purpose", 1.0),
    ("zlib", "altered", "altered source versions must be plainly marked as such", 1.0),
    ("apache", "compliance", "you may not use this file except in compliance with the license", 0.9),
    ("gpl", "redistribut", "you can redistribute it and or modify it under the terms of the gnu general public license", 1.0),
    ("unlicense", "unencumbered", "free and unencumbered software released into the public domain", 1.0),
    ("public-domain", "domain", "(?:placed|released|dedicated) (?:in|in ?to) the public domain", 0.8),
    ("proprietary", "reserved", "all rights reserved", 0.3),
    ("proprietary", "confidential", "proprietary and confidential", 0.7),
]


def signature_rules() -> list[Rule]:
    rules = []
    for rank, (keyword, words, weight) in enumerate(PHRASINGS):
        for label, names in FAMILIES.items():
            pattern = words.replace("{name}", f"(?:{names})")
            rules.append(Rule(rank, label, keyword, pattern, weight))
    for label, keyword, words, weight in SENTENCES:
        rules.append(Rule(len(PHRASINGS), label, keyword, words, weight))
    return rules
