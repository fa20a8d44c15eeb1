"""Signature rules of the licence scan: wordings crossed with licence families.

A rule's regex runs over normalised text (words joined by single spaces), so
it needs no punctuation. The families and wordings are written by hand; the
rules are their product, in order.
"""

from __future__ import annotations

from dataclasses import dataclass

# Base phrases: their words in a row give the base label.
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)

# (keyword, name regex, label, versions). The keyword must be a word of every
# text the name regex matches. A version regex "{v}" stands behind the name.
FAMILIES = (
    ("affero", "(?:gnu )?affero general public licen[sc]e", "agpl", ("3",)),
    ("agpl", "gnu agpl", "agpl", ("3",)),
    ("gnu", "gnu (?:lesser|library) general public licen[sc]e|gnu lgpl", "lgpl", ("2", "2 1", "3")),
    ("gnu", "gnu general public licen[sc]e|gnu gpl", "gpl", ("1", "2", "3")),
    ("gnu", "gnu free documentation licen[sc]e|gnu fdl", "gfdl", ("1 1", "1 2", "1 3")),
    ("gpl", "gpl", "gpl", ("2", "3")),
    ("lgpl", "lgpl", "lgpl", ("2 1", "3")),
    ("agpl", "agpl", "agpl", ("3",)),
    ("apache", "apache (?:software )?licen[sc]e", "apache", ("1 0", "1 1", "2 0")),
    ("mit", "mit(?: x11)? licen[sc]e|mit x11", "mit", ()),
    ("expat", "expat licen[sc]e", "mit", ()),
    ("bsd", "bsd 2 clause(?: licen[sc]e)?|(?:simplified|freebsd) bsd licen[sc]e", "bsd-2-clause", ()),
    ("bsd", "bsd 3 clause(?: licen[sc]e)?|(?:new|modified|revised) bsd licen[sc]e", "bsd-3-clause", ()),
    ("bsd", "bsd 4 clause(?: licen[sc]e)?|original bsd licen[sc]e", "bsd-4-clause", ()),
    ("bsd", "bsd(?: style)? licen[sc]e", "bsd", ()),
    ("0bsd", "0bsd", "0bsd", ()),
    ("isc", "isc licen[sc]e", "isc", ()),
    ("mozilla", "mozilla public licen[sc]e", "mpl", ("1 0", "1 1", "2 0")),
    ("mpl", "mpl", "mpl", ("1 1", "2 0")),
    ("eclipse", "eclipse public licen[sc]e", "epl", ("1 0", "2 0")),
    ("epl", "epl", "epl", ("1 0", "2 0")),
    ("common", "common development and distribution licen[sc]e", "cddl", ("1 0", "1 1")),
    ("cddl", "cddl", "cddl", ("1 0", "1 1")),
    ("common", "common public licen[sc]e", "cpl", ("1 0",)),
    ("european", "european union public licen[sc]e", "eupl", ("1 1", "1 2")),
    ("eupl", "eupl", "eupl", ("1 1", "1 2")),
    ("artistic", "(?:clarified )?artistic licen[sc]e", "artistic", ("1 0", "2 0")),
    ("boost", "boost software licen[sc]e", "bsl", ("1 0",)),
    ("zlib", "zlib(?: libpng)? licen[sc]e", "zlib", ()),
    ("unlicense", "(?:the )?unlicense", "unlicense", ()),
    ("wtfpl", "wtfpl", "wtfpl", ("2",)),
    ("python", "python (?:software foundation )?licen[sc]e", "python", ("2",)),
    ("php", "php licen[sc]e", "php", ("3 0", "3 01")),
    ("openssl", "openssl licen[sc]e", "openssl", ()),
    ("academic", "academic free licen[sc]e", "afl", ("2 1", "3 0")),
    ("open", "open software licen[sc]e", "osl", ("2 1", "3 0")),
    ("microsoft", "microsoft public licen[sc]e", "ms-pl", ()),
    ("microsoft", "microsoft reciprocal licen[sc]e", "ms-rl", ()),
    ("sil", "sil open font licen[sc]e", "ofl", ("1 0", "1 1")),
    ("ofl", "ofl", "ofl", ("1 1",)),
    ("odbl", "odbl", "odbl", ("1 0",)),
    ("database", "open (?:data commons open )?database licen[sc]e", "odbl", ("1 0",)),
    ("cecill", "cecill(?: [bc])?", "cecill", ("1 0", "2 0", "2 1")),
    ("server", "server side public licen[sc]e", "sspl", ("1",)),
    ("business", "business source licen[sc]e", "busl", ("1 1",)),
    ("elastic", "elastic licen[sc]e", "elastic", ("2 0",)),
    ("cc", "cc by nc nd", "cc-by-nc-nd", ("2 0", "2 5", "3 0", "4 0")),
    ("cc", "cc by nc sa", "cc-by-nc-sa", ("2 0", "2 5", "3 0", "4 0")),
    ("cc", "cc by nc", "cc-by-nc", ("2 0", "2 5", "3 0", "4 0")),
    ("cc", "cc by nd", "cc-by-nd", ("2 0", "2 5", "3 0", "4 0")),
    ("cc", "cc by sa", "cc-by-sa", ("2 0", "2 5", "3 0", "4 0")),
    ("cc", "cc by", "cc-by", ("2 0", "2 5", "3 0", "4 0")),
    ("cc0", "cc0", "cc0", ("1 0",)),
    ("creative", "creative commons attribution non ?commercial no ?deriv(?:ative)?s", "cc-by-nc-nd", ("3 0", "4 0")),
    ("creative", "creative commons attribution non ?commercial share ?alike", "cc-by-nc-sa", ("3 0", "4 0")),
    ("creative", "creative commons attribution non ?commercial", "cc-by-nc", ("3 0", "4 0")),
    ("creative", "creative commons attribution no ?deriv(?:ative)?s", "cc-by-nd", ("3 0", "4 0")),
    ("creative", "creative commons attribution share ?alike", "cc-by-sa", ("3 0", "4 0")),
    ("creative", "creative commons attribution", "cc-by", ("3 0", "4 0")),
    ("creative", "creative commons zero", "cc0", ("1 0",)),
    ("public", "public domain", "public-domain", ()),
    ("rights", "all rights reserved", "all-rights-reserved", ()),
)

# (keyword, short name, label) that name a licence without a version, but only in a notice's wording.
SHORT = (
    ("gpl", "gpl", "gpl"), ("lgpl", "lgpl", "lgpl"), ("agpl", "agpl", "agpl"), ("mpl", "mpl", "mpl"), ("epl", "epl", "epl"),
    ("cddl", "cddl", "cddl"), ("eupl", "eupl", "eupl"), ("ofl", "ofl", "ofl"),
)

# (identifier, label) of SPDX identifiers that no family's name matches.
SPDX = (
    ("mit", "mit"), ("mit 0", "mit-0"), ("x11", "mit"), ("apache 1 0", "apache-1.0"), ("apache 1 1", "apache-1.1"),
    ("apache 2 0", "apache-2.0"), ("isc", "isc"), ("zlib", "zlib"), ("bsl 1 0", "bsl-1.0"), ("gpl 1 0", "gpl-1"),
    ("lgpl 2 0", "lgpl-2"), ("agpl 1 0", "agpl-1"), ("gfdl 1 1", "gfdl-1.1"), ("gfdl 1 2", "gfdl-1.2"),
    ("gfdl 1 3", "gfdl-1.3"), ("mpl 1 0", "mpl-1.0"), ("cpl 1 0", "cpl-1.0"), ("artistic 1 0", "artistic-1.0"),
    ("artistic 2 0", "artistic-2.0"), ("python 2 0", "python-2"), ("psf 2 0", "python-2"), ("php 3 0", "php-3.0"),
    ("php 3 01", "php-3.01"), ("openssl", "openssl"), ("afl 2 1", "afl-2.1"), ("afl 3 0", "afl-3.0"),
    ("osl 2 1", "osl-2.1"), ("osl 3 0", "osl-3.0"), ("ms pl", "ms-pl"), ("ms rl", "ms-rl"), ("sspl 1 0", "sspl-1"),
    ("busl 1 1", "busl-1.1"), ("elastic 2 0", "elastic-2.0"),
)

# (name, wording round the name, priority, weight); the smaller number wins
# among detections where one interval holds another. "{}" takes the name.
NOTICES = (
    ("spdx", "spdx licen[sc]e identifier (?:{})(?: (?:only|or later))?", 0, 1.0),
    ("notice", "(?:(?:re)?licen[sc]ed|released|distributed|published|made available|provided|available|covered|governed)"
               " (?:only )?(?:under|by|with)(?: the)?(?: terms of)?(?: the)? (?:{})(?: (?:only|or later))?", 1, 0.95),
    ("grant", "(?:under|subject to|according to)(?: the)? (?:terms|conditions)(?: and conditions)? of the (?:{})", 1, 0.9),
    ("name", "(?:{})", 2, 0.7),
)
# A version may stand apart from the name by these words.
VERSION = "(?:{n})(?: licen[sc]e)?(?: public licen[sc]e)?(?: version| v| ver)? v?{v}"


@dataclass(frozen=True)
class LicenseRule:
    name: str
    keyword: str
    regex: str
    label: str
    priority: int
    weight: float
    base: bool = False


def build_rules() -> list[LicenseRule]:
    """Base phrases first, then every family and version in every wording."""
    rules = [LicenseRule(f"base:{label}", phrase.split()[0], phrase, label, 2, 0.6, True)
             for phrase, label in BASE_PHRASES]
    for keyword, name, label, versions in FAMILIES:
        forms = [(VERSION.format(n=name, v=v), f"{label}-{v.replace(' ', '.')}") for v in versions]
        bare = name if " " in name or label in ("unlicense", "cc0", "0bsd", "wtfpl", "odbl") else None
        if bare:
            forms.append((bare, label))
        for form, lab in forms:
            for kind, wording, priority, weight in NOTICES:
                rules.append(LicenseRule(f"{kind}:{lab}:{keyword}", keyword, wording.format(form), lab, priority, weight))
    for keyword, name, label in SHORT:
        for kind, wording, priority, weight in NOTICES[:-1]:
            rules.append(LicenseRule(f"{kind}:{label}:{keyword}", keyword, wording.format(name), label, priority, weight))
    kind, wording, priority, weight = NOTICES[0]
    for name, label in SPDX:
        rules.append(LicenseRule(f"{kind}:{label}:id", "spdx", wording.format(name), label, priority, weight))
    return rules
