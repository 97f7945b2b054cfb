"""The rules of the license scan: hand-written signatures and the forms they are looked for in.

A text is a row of lower-case words.  A rule is a regular expression over them, and
its keyword the one or two words it starts with.  Names of licenses are written
once; a rule is made of each in each of its versions.
"""

from __future__ import annotations

import re
from typing import NamedTuple


class Rule(NamedTuple):
    """``keyword`` is how ``pattern`` starts; the smaller ``tier`` goes before."""

    keyword: str
    pattern: str
    label: str
    tier: int


#: What a finding is worth, by tier: a base phrase, a declared identifier, a text, a name with version, a name granted, a name, a hint.
TIERS = ("base", "identifier", "text", "versioned", "granted", "named", "hint")
WEIGHTS = (0.7, 1.0, 0.95, 0.9, 0.8, 0.6, 0.3)

# The base phrases and their labels.
BASE_PHRASES = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))

# Label, versions, ways to write the name.
FAMILIES = (
    ("agpl", "1.0 3.0", ["gnu affero( general public)?( licen[cs]e)?", "affero general public( licen[cs]e)?", "agpl"]),
    ("lgpl", "2.0 2.1 3.0", ["gnu lesser( general public)?( licen[cs]e)?", "gnu library( general public)?( licen[cs]e)?", "lesser general public( licen[cs]e)?", "lgpl"]),
    ("gpl", "1.0 2.0 3.0", ["gnu general public licen[cs]e", "gnu public licen[cs]e", "gnu gpl", "general public licen[cs]e", "gpl"]),
    ("gfdl", "1.1 1.2 1.3", ["gnu free documentation( licen[cs]e)?", "gfdl"]),
    ("apache", "1.0 1.1 2.0", ["apache licen[cs]e", "apache software licen[cs]e", "asl"]),
    ("mpl", "1.0 1.1 2.0", ["mozilla public licen[cs]e", "mpl"]),
    ("epl", "1.0 2.0", ["eclipse public licen[cs]e", "epl"]),
    ("cpl", "1.0", ["common public licen[cs]e"]),
    ("cddl", "1.0 1.1", ["common development and distribution( licen[cs]e)?", "cddl"]),
    ("eupl", "1.0 1.1 1.2", ["european union public licen[cs]e", "eupl"]),
    ("bsl", "1.0", ["boost software licen[cs]e"]),
    ("busl", "1.1", ["business source licen[cs]e", "busl"]),
    ("afl", "2.1 3.0", ["academic free licen[cs]e"]),
    ("osl", "2.1 3.0", ["open software licen[cs]e"]),
    ("artistic", "1.0 2.0", ["artistic licen[cs]e"]),
    ("ms-pl", "", ["microsoft public licen[cs]e", "ms pl"]),
    ("ms-rl", "", ["microsoft reciprocal licen[cs]e", "ms rl"]),
    ("odbl", "1.0", ["open database licen[cs]e", "odbl"]),
    ("odc-by", "1.0", ["open data commons attribution( licen[cs]e)?", "odc by"]),
    ("pddl", "1.0", ["open data commons public domain( dedication)?( and)?( licen[cs]e)?", "pddl"]),
    ("ofl", "1.0 1.1", ["sil open font( licen[cs]e)?", "open font licen[cs]e"]),
    ("zpl", "2.0 2.1", ["zope public licen[cs]e", "zpl"]),
    ("psf", "2.0", ["python software foundation( licen[cs]e)?", "psf licen[cs]e"]),
    ("php", "3.0 3.01", ["php licen[cs]e"]),
    ("ecl", "1.0 2.0", ["educational community( licen[cs]e)?"]),
    ("cecill", "2.0 2.1", ["cecill"]),
    ("sspl", "1.0", ["server side public licen[cs]e", "sspl"]),
    ("bsd-0-clause", "", ["0bsd", "zero clause bsd", "bsd zero clause"]),
    ("bsd-2-clause", "", ["bsd 2 clause( licen[cs]e)?", "bsd two clause( licen[cs]e)?", "simplified bsd( licen[cs]e)?", "freebsd licen[cs]e", "2 clause bsd( licen[cs]e)?", "two clause bsd( licen[cs]e)?"]),
    ("bsd-3-clause", "", ["bsd 3 clause( licen[cs]e)?", "bsd three clause( licen[cs]e)?", "new bsd( licen[cs]e)?", "modified bsd( licen[cs]e)?", "revised bsd( licen[cs]e)?", "3 clause bsd( licen[cs]e)?",
                          "three clause bsd( licen[cs]e)?"]),
    ("bsd-4-clause", "", ["bsd 4 clause( licen[cs]e)?", "original bsd licen[cs]e", "4 clause bsd( licen[cs]e)?"]),
    ("bsd", "", ["bsd licen[cs]e", "bsd style licen[cs]e", "berkeley software distribution( licen[cs]e)?"]),
    ("mit", "", ["mit licen[cs]e", "mit x11 licen[cs]e", "mit expat licen[cs]e", "mit style licen[cs]e", "expat licen[cs]e", "x11 licen[cs]e"]),
    ("isc", "", ["isc licen[cs]e", "internet systems consortium licen[cs]e"]),
    ("zlib", "", ["zlib licen[cs]e", "zlib libpng( licen[cs]e)?"]),
    ("unlicense", "", ["unlicense", "the unlicense"]),
    ("wtfpl", "2.0", ["wtfpl", "do what the fuck you want to public licen[cs]e"]),
    ("cc0", "1.0", ["cc0", "creative commons zero", "creative commons cc0"]),
    ("cc-by", "1.0 2.0 2.5 3.0 4.0", ["cc by", "creative commons attribution"]),
    ("cc-by-sa", "1.0 2.0 2.5 3.0 4.0", ["cc by sa", "creative commons attribution share ?alike", "creative commons by sa"]),
    ("cc-by-nd", "1.0 2.0 2.5 3.0 4.0", ["cc by nd", "creative commons attribution no ?deriv(atives|s)?( works)?", "creative commons by nd"]),
    ("cc-by-nc", "1.0 2.0 2.5 3.0 4.0", ["cc by nc", "creative commons attribution non ?commercial", "creative commons by nc"]),
    ("cc-by-nc-sa", "1.0 2.0 2.5 3.0 4.0", ["cc by nc sa", "creative commons attribution non ?commercial share ?alike", "creative commons by nc sa"]),
    ("cc-by-nc-nd", "1.0 2.0 2.5 3.0 4.0", ["cc by nc nd", "creative commons attribution non ?commercial no ?deriv(atives|s)?( works)?", "creative commons by nc nd"]),
    ("public-domain", "", ["public domain dedication", "public domain mark"]),
)

# Sentences of license texts, from their first telling words on.
TEXTS = (
    ("hereby granted", "free of charge to any person obtaining a copy", "mit"),
    ("without restriction", "including without limitation the rights to use copy modify merge publish", "mit"),
    ("redistribution and", "use in source and binary forms( with or without modification)?", "bsd"),
    ("redistributions of", "source code must retain the above copyright notice", "bsd"),
    ("redistributions in", "binary form must reproduce the above copyright notice", "bsd"),
    ("neither the", "name of .{1,80}? may be used to endorse or promote products", "bsd-3-clause"),
    ("advertising materials", "mentioning features or use of this software must display", "bsd-4-clause"),
    ("distribute this", "software for any purpose with or without fee is hereby granted", "isc"),
    ("warranties of", "merchantability fitness for a particular purpose and noninfringement", "mit"),
    ("redistribute it", "and or modify it under the terms of the gnu general public licen[cs]e", "gpl"),
    ("redistribute it", "and or modify it under the terms of the gnu lesser general public licen[cs]e", "lgpl"),
    ("redistribute it", "and or modify it under the terms of the gnu affero general public licen[cs]e", "agpl"),
    ("verbatim copies", "of this licen[cs]e document but changing it is not allowed", "gpl"),
    ("unencumbered software", "released into the public domain", "unlicense"),
    ("altered source", "versions must be plainly marked as such", "zlib"),
    ("covered software", "is provided under this licen[cs]e on an as is basis", "mpl"),
    ("in compliance", "with the licen[cs]e you may obtain a copy of the licen[cs]e at", "apache"),
    ("this font", "software is licensed under the sil open font licen[cs]e", "ofl"),
    ("machine executable", "object code generated by a source language processor", "bsl"),
    ("waives all", "(of )?(his or her|their) rights to the work worldwide", "cc0"),
    ("has dedicated", "the work to the public domain", "cc0"),
    ("the accompanying", "program is provided under the terms of this (common|eclipse) public licen[cs]e", "epl"),
)

# Addresses, as the words that are left of them.
ADDRESSES = (
    ("apache org", "licen[cs]es( license)? 2 0", "apache-2.0"), ("apache org", "licen[cs]es", "apache"), ("gnu org", "licen[cs]es agpl", "agpl"), ("gnu org", "licen[cs]es lgpl", "lgpl"),
    ("gnu org", "licen[cs]es gpl", "gpl"), ("gnu org", "(copyleft|licen[cs]es)", "gpl"), ("opensource org", "licen[cs]es mit", "mit"), ("opensource org", "licen[cs]es bsd( licen[cs]e)?", "bsd"),
    ("opensource org", "licen[cs]es isc", "isc"), ("mozilla org", "mpl( 2 0)?", "mpl"), ("unlicense org", "", "unlicense"), ("creativecommons org", "publicdomain zero", "cc0"),
    ("creativecommons org", "licen[cs]es by", "cc-by"), ("creativecommons org", "licen[cs]es by sa", "cc-by-sa"), ("creativecommons org", "licen[cs]es by nd", "cc-by-nd"),
    ("creativecommons org", "licen[cs]es by nc", "cc-by-nc"), ("creativecommons org", "licen[cs]es by nc sa", "cc-by-nc-sa"), ("creativecommons org", "licen[cs]es by nc nd", "cc-by-nc-nd"),
)

HINTS = (
    ("all rights", "reserved", "all-rights-reserved"), ("alle rechte", "vorbehalten", "all-rights-reserved"), ("tous droits", "r[ée]serv[ée]s", "all-rights-reserved"),
    ("todos los", "derechos reservados", "all-rights-reserved"), ("proprietary and", "confidential", "proprietary"), ("unauthorized copying", "of", "proprietary"),
    ("licensed under", "", "unknown-license"), ("released under", "(the|a) .{1,60}? licen[cs]e", "unknown-license"), ("distributed under", "(the|a) .{1,60}? licen[cs]e", "unknown-license"),
    ("dual licensed", "", "dual-license"), ("creative commons", "", "creative-commons"), ("public domain", "", "public-domain"), ("end user", "licen[cs]e agreement", "eula"),
)

# Short names with a version.
SHORT = (("apache 2", "", "apache-2.0"), ("apache 2", "0", "apache-2.0"), ("gplv2", "", "gpl-2.0"), ("gplv3", "", "gpl-3.0"), ("lgplv2", "", "lgpl-2.0"), ("lgplv3", "", "lgpl-3.0"), ("agplv3", "", "agpl-3.0"),
         ("mplv2", "", "mpl-2.0"), ("mit licensed", "", "mit"), ("bsd licensed", "", "bsd"), ("apache licensed", "", "apache"))

GRANTS = ("licensed under", "released under", "distributed under", "available under")


def _numbered(version: str) -> str:
    """``2.0`` as words behind a name: ``2``, ``2 0``, ``v2``, ``version 2 0``."""
    major, minor = version.split(".")
    plain = f"{major}( 0)?" if minor == "0" else f"{major} {minor}"
    return f"( licen[cs]e)?( version| ver)? v?{plain}( or (any )?later( version)?| only)?"


def _rule(pattern: str, label: str, tier: int) -> Rule:
    """The keyword: the first two words of the pattern, or its only one."""
    plain = re.match("[a-z0-9à-ÿ ]+", pattern).group()
    if pattern[len(plain):len(plain) + 1] in ("[", "?"):  # its last word is not whole
        plain = plain[:plain.rindex(" ")]
    return Rule(" ".join(plain.split()[:2]), pattern, label, tier)


def _spelled(way: str) -> list[str]:
    """A way whose second word is spelled in two ways, once for each."""
    first, _, rest = way.partition(" ")
    return [f"{first} licen{c}e{rest[10:]}" for c in "cs"] if rest.startswith("licen[cs]e") else [way]


def rules() -> list[Rule]:
    """All rules in the order of their priority."""
    out = [_rule(phrase, label, 0) for phrase, label in BASE_PHRASES]
    for label, versions, ways in FAMILIES:
        for version in [*versions.split(), ""]:
            full = f"{label}-{version}" if version else label
            number = _numbered(version) if version else ""
            out.append(_rule(f"spdx license identifier {re.sub('[-.]', ' ', full)}( or later| only| plus)?", full, 1))
            out += [_rule(spelled + number, full, 3 if version else 5) for way in ways for spelled in _spelled(way)]
        out += [_rule(f"{grant} ((the|a|an) )?(terms of the )?({'|'.join(ways)})", label, 4) for grant in GRANTS]
    for tier, table in ((2, TEXTS), (3, SHORT), (4, ADDRESSES), (6, HINTS)):
        out += [_rule(f"{head} {tail}".strip(), label, tier) for head, tail, label in table]
    return sorted(set(out), key=lambda r: (r.tier, -len(r.pattern), r))
