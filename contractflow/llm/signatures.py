"""Signature rules of licences: hand-written expressions over the words of a text, in order of priority.

An expression is written over words with single spaces; it matches whole words only. ``keywords`` gate a rule: it is tried only on texts
that have one of them. A rule of a higher priority beats those of lower ones that it contains; so does a wider one of the same.
"""

from __future__ import annotations

from dataclasses import dataclass

#: Priorities: generic remarks, titles, notices and addresses, tags that machines read.
REMARK, TITLE, NOTICE, TAG = range(4)


@dataclass(frozen=True)
class Rule:
    name: str
    label: str
    expression: str
    keywords: tuple[str, ...]
    priority: int
    confidence: float
    base: bool = False


def phrase(label: str, words: str, keywords: str) -> Rule:
    """A base rule: its label stays whatever contains it. A phrase that can overlap itself has no places that stand apart, and is refused."""
    parts = words.split()
    if any(parts[:i] == parts[-i:] for i in range(1, len(parts))):
        raise ValueError(f"A phrase that can overlap itself: {words}")
    return Rule(f"phrase:{label}", label, words, tuple(keywords.split()), REMARK, 0.8, True)


#: The phrases of the contract.
BASE = (
    phrase("mit", "under the mit license", "license"),
    phrase("apache-2", "apache license version 2", "apache"),
    phrase("cc-by-nc", "cc by nc", "cc"),
)

#: Label, public identifier, title, keywords.
LICENCES = (
    ("0bsd", "0bsd", "(?:zero clause bsd|0bsd)(?: licen[sc]e)?", "bsd 0bsd"),
    ("academic-3", "afl 3 0", "academic free licen[sc]e(?: version| v)? 3 0", "academic"),
    ("agpl", "agpl", "(?:gnu )?affero general public licen[sc]e", "affero agpl"),
    ("agpl-3", "agpl 3 0(?: only| or later)?", "(?:gnu affero general public licen[sc]e|agpl)(?: version| v)? ?(?:3|v3)(?: 0)?", "affero agpl"),
    ("apache-1.1", "apache 1 1", "apache(?: software)? licen[sc]e(?: version| v)? 1 1", "apache"),
    ("apache-2", "apache 2 0", "apache(?: software)? licen[sc]e(?: version| v)? (?:2|v2)(?: 0)?", "apache"),
    ("artistic-1", "artistic 1 0(?: perl)?", "(?:perl )?artistic licen[sc]e(?: version)?(?: 1(?: 0)?)?", "artistic"),
    ("artistic-2", "artistic 2 0", "artistic licen[sc]e(?: version| v)? 2(?: 0)?", "artistic"),
    ("beerware", "beerware", "beer ?ware licen[sc]e", "beerware beer"),
    ("blueoak-1", "blueoak 1 0 0", "blue oak model licen[sc]e(?: 1 0 0)?", "oak"),
    ("bsd-1-clause", "bsd 1 clause", "(?:bsd 1 clause|1 clause bsd)(?: licen[sc]e)?", "bsd"),
    ("bsd-2-clause", "bsd 2 clause(?: patent)?", "(?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd)(?: licen[sc]e)?", "bsd freebsd"),
    ("bsd-3-clause", "bsd 3 clause(?: clear)?", "(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd)(?: licen[sc]e)?", "bsd"),
    ("bsd-4-clause", "bsd 4 clause(?: uc)?", "(?:original bsd|bsd 4 clause|4 clause bsd)(?: licen[sc]e)?", "bsd"),
    ("bsd", "bsd", "bsd(?: style)? licen[sc]e", "bsd"),
    ("boost-1", "bsl 1 0", "boost software licen[sc]e(?: version)?(?: 1 0)?", "boost"),
    ("busl-1.1", "busl 1 1", "business source licen[sc]e(?: 1 1)?", "busl business"),
    ("cc0-1", "cc0 1 0", "(?:cc0|creative commons zero)(?: v?1 0)?(?: universal)?", "cc0 creative"),
    ("cc-by", "cc by(?: [1-4] 0)?", "(?:cc|creative commons)(?: by| attribution)(?: [1-4] 0)?(?: international| unported)?(?: licen[sc]e)?", "cc creative"),
    ("cc-by-sa", "cc by sa(?: [1-4] 0)?", "(?:cc by sa|creative commons attribution share ?alike)(?: [1-4] 0)?(?: international| unported)?(?: licen[sc]e)?", "cc creative"),
    ("cc-by-nd", "cc by nd(?: [1-4] 0)?", "(?:cc by nd|creative commons attribution no ?deriv(?:ative)?s?)(?: [1-4] 0)?(?: international| unported)?(?: licen[sc]e)?", "cc creative"),
    ("cc-by-nc", "cc by nc(?: [1-4] 0)?", "(?:cc by nc|creative commons attribution non ?commercial)(?: [1-4] 0)?(?: international| unported)?(?: licen[sc]e)?", "cc creative"),
    ("cc-by-nc-sa", "cc by nc sa(?: [1-4] 0)?", "(?:cc by nc sa|creative commons attribution non ?commercial share ?alike)(?: [1-4] 0)?(?: international| unported)?(?: licen[sc]e)?", "cc creative"),
    ("cc-by-nc-nd", "cc by nc nd(?: [1-4] 0)?", "(?:cc by nc nd|creative commons attribution non ?commercial no ?deriv(?:ative)?s?)(?: [1-4] 0)?(?: international| unported)?(?: licen[sc]e)?", "cc creative"),
    ("cddl-1", "cddl 1 [01]", "(?:common development and distribution licen[sc]e|cddl)(?: version)?(?: 1 [01])?", "cddl distribution"),
    ("cecill-2.1", "cecill 2 1", "cecill(?: free software)?(?: licen[sc]e)?(?: agreement)?(?: v?2 1)?", "cecill"),
    ("cecill-b", "cecill b", "cecill b(?: licen[sc]e)?", "cecill"),
    ("cecill-c", "cecill c", "cecill c(?: licen[sc]e)?", "cecill"),
    ("cpl-1", "cpl 1 0", "common public licen[sc]e(?: version)?(?: 1 0)?", "cpl common"),
    ("curl", "curl", "curl licen[sc]e", "curl"),
    ("ecl-2", "ecl 2 0", "educational community licen[sc]e(?: version)?(?: 2 0)?", "ecl educational"),
    ("epl-1", "epl 1 0", "(?:eclipse public licen[sc]e|epl)(?: version| v)? 1 0", "eclipse epl"),
    ("epl-2", "epl 2 0", "(?:eclipse public licen[sc]e|epl)(?: version| v)? 2 0", "eclipse epl"),
    ("eupl-1.2", "eupl 1 [12]", "(?:european union public licen[sc]e|eupl)(?: version| v)?(?: 1 [12])?", "eupl european"),
    ("gfdl", "gfdl 1 [123](?: only| or later)?", "gnu free documentation licen[sc]e(?: version)?(?: 1 [123])?", "gfdl documentation"),
    ("gpl", "gpl", "(?:gnu )?general public licen[sc]e|gnu gpl", "gnu gpl general"),
    ("gpl-1", "gpl 1 0(?: only| or later)?", "(?:gnu general public licen[sc]e|gpl)(?: version| v)? (?:1|v1)(?: 0)?", "gnu gpl"),
    ("gpl-2", "gpl 2 0(?: only| or later)?", "(?:gnu general public licen[sc]e|gpl)(?: version| v)? (?:2|v2)(?: 0)?", "gnu gpl"),
    ("gpl-3", "gpl 3 0(?: only| or later)?", "(?:gnu general public licen[sc]e|gpl)(?: version| v)? (?:3|v3)(?: 0)?", "gnu gpl"),
    ("hpnd", "hpnd", "historical permission notice and disclaimer", "hpnd historical"),
    ("isc", "isc", "isc licen[sc]e", "isc"),
    ("lgpl", "lgpl", "(?:gnu )?(?:lesser|library) general public licen[sc]e|gnu lgpl", "lgpl lesser library"),
    ("lgpl-2", "lgpl 2 0(?: only| or later)?", "(?:gnu library general public licen[sc]e|lgpl)(?: version| v)? (?:2|v2)(?: 0)?", "lgpl library"),
    ("lgpl-2.1", "lgpl 2 1(?: only| or later)?", "(?:gnu lesser general public licen[sc]e|lgpl)(?: version| v)? (?:2|v2) 1", "lgpl lesser"),
    ("lgpl-3", "lgpl 3 0(?: only| or later)?", "(?:gnu lesser general public licen[sc]e|lgpl)(?: version| v)? (?:3|v3)(?: 0)?", "lgpl lesser"),
    ("libpng", "libpng(?: 2 0)?", "(?:libpng|png reference library) licen[sc]e", "libpng png"),
    ("lppl-1.3c", "lppl 1 3c", "latex project public licen[sc]e(?: version)?(?: 1 3c?)?", "latex lppl"),
    ("mit", "mit", "mit licen[sc]e", "license licence"),
    ("mit-0", "mit 0", "mit no attribution(?: licen[sc]e)?", "attribution"),
    ("mpl-1.1", "mpl 1 1", "(?:mozilla public licen[sc]e|mpl)(?: version| v)? 1 1", "mozilla mpl"),
    ("mpl-2", "mpl 2 0", "(?:mozilla public licen[sc]e|mpl)(?: version| v)? 2(?: 0)?", "mozilla mpl"),
    ("ms-pl", "ms pl", "microsoft public licen[sc]e", "microsoft"),
    ("ms-rl", "ms rl", "microsoft reciprocal licen[sc]e", "microsoft"),
    ("ncsa", "ncsa", "(?:university of illinois ncsa open source|ncsa) licen[sc]e", "ncsa"),
    ("odbl-1", "odbl 1 0", "(?:open database licen[sc]e|odbl)(?: v?1 0)?", "odbl database"),
    ("odc-by-1", "odc by 1 0", "open data commons attribution licen[sc]e(?: v?1 0)?", "odc commons"),
    ("ofl-1.1", "ofl 1 1", "(?:sil )?open font licen[sc]e(?: version)?(?: 1 [01])?", "ofl font"),
    ("openssl", "openssl", "openssl licen[sc]e", "openssl"),
    ("osl-3", "osl 3 0", "open software licen[sc]e(?: version| v)?(?: 3 0)?", "osl software"),
    ("pddl-1", "pddl 1 0", "public domain dedication and licen[sc]e", "pddl dedication"),
    ("php-3", "php 3 01?", "php licen[sc]e(?: version)?(?: 3 01?)?", "php"),
    ("postgresql", "postgresql", "postgresql licen[sc]e", "postgresql"),
    ("psf-2", "psf 2 0|python 2 0", "python software foundation licen[sc]e(?: version 2)?", "python psf"),
    ("qpl-1", "qpl 1 0", "q public licen[sc]e(?: version 1 0)?", "qpl q"),
    ("ruby", "ruby", "ruby licen[sc]e", "ruby"),
    ("sspl-1", "sspl 1 0", "server side public licen[sc]e(?: v?1)?", "sspl server"),
    ("unlicense", "unlicense", "(?:the )?unlicen[sc]e", "unlicense unlicence"),
    ("upl-1", "upl 1 0", "universal permissive licen[sc]e(?: v?1 0)?", "upl universal"),
    ("vim", "vim", "vim licen[sc]e", "vim"),
    ("w3c", "w3c(?: 20150513)?", "w3c software(?: notice)?(?: and)?(?: document)? licen[sc]e", "w3c"),
    ("wtfpl", "wtfpl", "wtfpl(?: licen[sc]e)?(?: version 2)?", "wtfpl"),
    ("zlib", "zlib(?: acknowledgement)?", "zlib(?: libpng)? licen[sc]e", "zlib"),
    ("zpl-2.1", "zpl 2 1", "zope public licen[sc]e(?: version)?(?: 2 1)?", "zope zpl"),
)

#: Label, words of a public address, keywords.
ADDRESSES = (
    ("apache-2", "apache org licenses license 2 0(?: html| txt)?", "apache"),
    ("agpl-3", "gnu org licenses agpl(?: 3 0)?(?: [a-z]+)?", "gnu"),
    ("boost-1", "boost org license 1 0(?: txt)?", "boost"),
    ("cc0-1", "creativecommons org publicdomain zero 1 0", "creativecommons"),
    ("cc-by", "creativecommons org licenses by [1-4] [05]", "creativecommons"),
    ("cc-by-sa", "creativecommons org licenses by sa [1-4] [05]", "creativecommons"),
    ("cc-by-nd", "creativecommons org licenses by nd [1-4] [05]", "creativecommons"),
    ("cc-by-nc", "creativecommons org licenses by nc [1-4] [05]", "creativecommons"),
    ("cc-by-nc-sa", "creativecommons org licenses by nc sa [1-4] [05]", "creativecommons"),
    ("cc-by-nc-nd", "creativecommons org licenses by nc nd [1-4] [05]", "creativecommons"),
    ("public-domain", "creativecommons org publicdomain mark 1 0", "creativecommons"),
    ("epl-1", "eclipse org legal epl v10(?: html)?", "eclipse"),
    ("epl-2", "eclipse org legal epl 2 0", "eclipse"),
    ("gfdl", "gnu org (?:licenses|copyleft) fdl(?: 1 [123])?(?: [a-z]+)?", "gnu"),
    ("gpl", "gnu org (?:licenses|copyleft) gpl(?: html)?", "gnu"),
    ("gpl-2", "gnu org licenses (?:old licenses )?gpl 2 0(?: [a-z]+)?", "gnu"),
    ("gpl-3", "gnu org licenses gpl 3 0(?: [a-z]+)?", "gnu"),
    ("lgpl", "gnu org (?:licenses|copyleft) lgpl(?: html)?", "gnu"),
    ("lgpl-2.1", "gnu org licenses (?:old licenses )?lgpl 2 1(?: [a-z]+)?", "gnu"),
    ("lgpl-3", "gnu org licenses lgpl 3 0(?: [a-z]+)?", "gnu"),
    ("mit", "(?:opensource org licenses|mit license org) mit(?: license)?(?: php| html)?", "opensource org"),
    ("bsd-2-clause", "opensource org licenses bsd 2 clause", "opensource"),
    ("bsd-3-clause", "opensource org licenses bsd 3 clause", "opensource"),
    ("isc", "opensource org licenses isc", "opensource"),
    ("mpl-1.1", "mozilla org mpl 1 1", "mozilla"),
    ("mpl-2", "mozilla org (?:en us )?mpl 2 0", "mozilla"),
    ("odbl-1", "opendatacommons org licenses odbl(?: 1 0)?", "opendatacommons"),
    ("odc-by-1", "opendatacommons org licenses by(?: 1 0)?", "opendatacommons"),
    ("ofl-1.1", "scripts sil org ofl", "sil"),
    ("unlicense", "unlicense org", "unlicense"),
    ("wtfpl", "wtfpl net", "wtfpl"),
    ("zlib", "zlib net zlib license(?: html)?", "zlib"),
)

#: Label, words that stand in a licence's own text, keywords.
CLAUSES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "hereby"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "copyright"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "hereby"),
    ("0bsd", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted the software is provided as is", "hereby"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution"),
    ("bsd", "redistributions of source code must retain the above copyright notice", "redistributions"),
    ("bsd-3-clause", "neither the names? of (?:[^ ]+ ){1,12}may be used to endorse or promote products", "endorse"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display", "advertising"),
    ("zlib", "the origin of this software must not be misrepresented", "misrepresented"),
    ("zlib", "altered source versions must be plainly marked as such", "plainly"),
    ("boost-1", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software", "hereby"),
    ("apache-2", "you may not use this file except in compliance with the license", "compliance"),
    ("apache-2", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis", "applicable"),
    ("apache-2", "terms and conditions for use reproduction and distribution", "reproduction"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "redistribute"),
    ("gpl-2", "either version 2 of the license or (?:at your option )?any later version", "version"),
    ("gpl-3", "either version 3 of the license or (?:at your option )?any later version", "version"),
    ("gpl", "you should have received a copy of the gnu general public license along with this", "gnu"),
    ("gpl-2", "gnu general public license version 2 june 1991", "gnu"),
    ("gpl-3", "gnu general public license version 3 29 june 2007", "gnu"),
    ("lgpl", "under the terms of the gnu (?:lesser|library) general public license", "gnu"),
    ("lgpl-2.1", "gnu lesser general public license version 2 1 february 1999", "gnu"),
    ("lgpl-3", "gnu lesser general public license version 3 29 june 2007", "gnu"),
    ("lgpl", "you should have received a copy of the gnu (?:lesser|library) general public license along with this", "gnu"),
    ("agpl-3", "under the terms of the gnu affero general public license", "affero"),
    ("agpl-3", "gnu affero general public license version 3 19 november 2007", "affero"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license", "gnu"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1", "mozilla"),
    ("epl-2", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", "eclipse"),
    ("epl-1", "this program and the accompanying materials are made available under the terms of the eclipse public license v1 0", "eclipse"),
    ("unlicense", "this is free and unencumbered software released into the public domain", "unencumbered"),
    ("unlicense", "anyone is free to copy modify publish use compile sell or distribute this software", "compile"),
    ("wtfpl", "you just do what the fuck you want to", "fuck"),
    ("beerware", "you can buy me a beer in return", "beer"),
    ("ofl-1.1", "this font software is licensed under the sil open font license", "font"),
    ("cc0-1", "to the extent possible under law (?:[^ ]+ ){1,8}waived all copyright and related or neighboring rights", "waived"),
    ("cc-by-sa", "if you remix transform or build upon the material you must distribute your contributions under the same license", "remix"),
    ("cc-by-nc", "you may not use the material for commercial purposes", "commercial"),
    ("cc-by-nd", "if you remix transform or build upon the material you may not distribute the modified material", "remix"),
    ("artistic-2", "everyone is permitted to copy and distribute verbatim copies of this license document but changing it is not allowed", "verbatim"),
    ("ncsa", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimers in the documentation", "disclaimers"),
    ("openssl", "this product includes software developed by the openssl project", "openssl"),
    ("php-3", "this product includes php software freely available", "php"),
    ("psf-2", "python software foundation license version 2", "python"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted", "hereby"),
    ("sspl-1", "if you make the functionality of the program or a modified version available to third parties as a service", "functionality"),
    ("busl-1.1", "the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use", "licensor"),
    ("eupl-1.2", "licensed under the eupl", "eupl"),
)

#: Label, remark, keywords.
REMARKS = (
    ("all-rights-reserved", "all rights reserved", "reserved"),
    ("proprietary", "proprietary and confidential", "proprietary"),
    ("proprietary", "confidential and proprietary(?: information)?", "proprietary"),
    ("proprietary", "unauthori[sz]ed (?:copying|reproduction|use|distribution)(?: [^ ]+){0,8} (?:strictly )?prohibited", "prohibited"),
    ("proprietary", "no part of this (?:book|publication|work|document) may be reproduced", "reproduced"),
    ("proprietary", "may not be (?:copied|reproduced|redistributed) without (?:[^ ]+ ){0,4}(?:permission|consent)", "permission consent"),
    ("proprietary", "end user licen[sc]e agreement", "agreement"),
    ("non-commercial", "for (?:personal (?:and|or) )?non ?commercial (?:use|purposes)(?: only)?", "commercial noncommercial"),
    ("non-commercial", "commercial use (?:is )?(?:not permitted|prohibited|strictly prohibited)", "commercial"),
    ("non-commercial", "for (?:research|academic|educational) (?:use|purposes) only", "research academic educational"),
    ("public-domain", "(?:in|into|to) the public domain", "domain"),
    ("public-domain", "no (?:known )?copyright restrictions", "restrictions"),
    ("no-ai-training", "may not be used (?:for|to) train(?:ing)?", "train training"),
    ("no-derivatives", "no derivative works", "derivative"),
    ("see-licence-file", "see (?:the )?(?:accompanying )?(?:file )?(?:license|licence|copying)(?: (?:file|txt|md))? for (?:[^ ]+ ){0,3}(?:details|information|terms)", "license licence copying"),
    ("see-licence-file", "licen[sc]e that can be found in the licen[sc]e file", "license licence"),
    ("dual-licensed", "dual licen[sc]ed", "dual"),
    ("dual-licensed", "at your option (?:either|any)", "option"),
    ("copyright", "copyright (?:c )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])?", "copyright"),
    ("open-government", "open government licen[sc]e", "government"),
)

_GRANT = "(?:licen[sc]ed|released|distributed|available|published|provided|covered|governed|redistributed|made|issued)"
_UNDER = "(?: [^ ]+){0,3}? under(?: [^ ]+){0,6}?"


def rules() -> tuple[Rule, ...]:
    """All rules: the phrases, and for each licence a tag, a notice and a title, its addresses and clauses, and general remarks."""
    out = list(BASE)
    for label, identifier, title, keywords in LICENCES:
        words = tuple(keywords.split())
        out.append(Rule(f"tag:{label}", label, f"spdx license identifier (?:{identifier})", ("spdx",), TAG, 1.0))
        out.append(Rule(f"notice:{label}", label, f"{_GRANT}{_UNDER} (?:{title})", words, NOTICE, 0.9))
        out.append(Rule(f"title:{label}", label, f"(?:{title})", words, TITLE, 0.6))
    for kind, table, priority, confidence in (("address", ADDRESSES, NOTICE, 0.95), ("clause", CLAUSES, NOTICE, 0.95), ("remark", REMARKS, REMARK, 0.4)):
        out += [Rule(f"{kind}:{i}", label, expression, tuple(keywords.split()), priority, confidence) for i, (label, expression, keywords) in enumerate(table)]
    return tuple(out)
