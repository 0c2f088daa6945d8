"""Signature rules for licenses, over words in lower case with one space between them.

Rules are made from families of licenses and the forms in which a license is named, a few
hundred in all.  The smaller its priority number, the more a rule says.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class LicenseRule:
    label: str
    priority: int
    #: Part of every match, so a text without it can't match.
    keyword: str
    regex: str


# Labels, names and versions of public licenses.
FAMILIES = {
    # label: (keyword, pattern of the name, versions)
    "mit": ("mit", "mit(?: x11)?", ()),
    "apache": ("apache", "apache(?: software)?", ("1 0", "1 1", "2 0")),
    "gpl": ("general public", "(?:gnu )?general public", ("1 0", "2 0", "3 0")),
    "gpl-short": ("gpl", "(?:gnu )?gpl", ("1 0", "2 0", "3 0")),
    "lgpl": ("lesser general", "(?:gnu )?lesser general public", ("2 1", "3 0")),
    "lgpl-library": ("library general", "(?:gnu )?library general public", ("2 0",)),
    "lgpl-short": ("lgpl", "(?:gnu )?lgpl", ("2 0", "2 1", "3 0")),
    "agpl": ("affero", "(?:gnu )?affero(?: general)? public", ("1 0", "3 0")),
    "agpl-short": ("agpl", "(?:gnu )?agpl", ("1 0", "3 0")),
    "gfdl": ("free documentation", "(?:gnu )?free documentation", ("1 1", "1 2", "1 3")),
    "bsd": ("bsd", "(?:simplified |new |revised |modified )?bsd", ()),
    "bsd-2-clause": ("bsd", "(?:bsd 2 clause|2 clause bsd|two clause bsd)", ()),
    "bsd-3-clause": ("bsd", "(?:bsd 3 clause|3 clause bsd|three clause bsd)", ()),
    "mpl": ("mozilla", "mozilla public", ("1 0", "1 1", "2 0")),
    "mpl-short": ("mpl", "mpl", ("1 0", "1 1", "2 0")),
    "epl": ("eclipse", "eclipse public", ("1 0", "2 0")),
    "eupl": ("european union", "european union public", ("1 0", "1 1", "1 2")),
    "cddl": ("common development", "common development and distribution", ("1 0", "1 1")),
    "cpl": ("common public", "common public", ("1 0",)),
    "isc": ("isc", "isc", ()),
    "zlib": ("zlib", "zlib(?: libpng)?", ()),
    "boost": ("boost", "boost(?: software)?", ("1 0",)),
    "artistic": ("artistic", "artistic", ("1 0", "2 0")),
    "perl": ("perl", "perl(?: 5)?", ()),
    "python": ("python", "python(?: software foundation)?", ("2 0",)),
    "ruby": ("ruby", "ruby", ()),
    "php": ("php", "php", ("3 0", "3 01")),
    "postgresql": ("postgresql", "postgresql", ()),
    "openssl": ("openssl", "openssl", ()),
    "openldap": ("openldap", "openldap public", ("2 8",)),
    "ofl": ("open font", "(?:sil )?open font", ("1 0", "1 1")),
    "osl": ("open software", "open software", ("1 0", "2 0", "2 1", "3 0")),
    "afl": ("academic free", "academic free", ("1 1", "2 0", "2 1", "3 0")),
    "ecl": ("educational community", "educational community", ("1 0", "2 0")),
    "ms-pl": ("microsoft", "microsoft public", ()),
    "ms-rl": ("microsoft", "microsoft reciprocal", ()),
    "nasa": ("nasa", "nasa open source", ("1 3",)),
    "ncsa": ("ncsa", "(?:university of illinois )?ncsa(?: open source)?", ()),
    "qpl": ("q public", "q public", ("1 0",)),
    "upl": ("universal permissive", "universal permissive", ("1 0",)),
    "vim": ("vim", "vim", ()),
    "w3c": ("w3c", "w3c(?: software)?", ()),
    "wtfpl": ("wtfpl", "wtfpl", ("2 0",)),
    "bsl": ("business source", "business source", ("1 0", "1 1")),
    "sspl": ("server side", "server side public", ("1 0",)),
    "elastic": ("elastic", "elastic", ("1 0", "2 0")),
    "odbl": ("open database", "open database", ("1 0",)),
    "cc-by": ("attribution", "(?:creative commons )?attribution", ("2 0", "2 5", "3 0", "4 0")),
    "cc-by-sa": ("share", "(?:creative commons )?attribution share ?alike", ("2 0", "2 5", "3 0", "4 0")),
    "cc-by-nc": ("commercial", "(?:creative commons )?attribution non ?commercial", ("2 0", "2 5", "3 0", "4 0")),
    "cc-by-nd": ("deriv", "(?:creative commons )?attribution no ?deriv(?:s|atives)", ("2 0", "2 5", "3 0", "4 0")),
    "cc0": ("cc0", "cc0", ("1 0",)),
}

# Sentences that need no name; label, keyword, pattern.
GRANTS = (
    ("mit", "hereby granted", "permission is hereby granted free of charge to any person"),
    ("isc", "permission to use", "permission to use copy modify and or distribute this software"),
    ("bsd", "redistribution and use", "redistribution and use in source and binary forms"),
    ("zlib", "provided as is", "this software is provided as is without any express or implied"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("public-domain", "public domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
)
MENTIONS = (
    ("public-domain", "public domain", "in the public domain"),
    ("proprietary", "reserved", "all rights reserved"),
    ("proprietary", "proprietary", "proprietary and confidential"),
    ("copyright", "copyright", "copyright (?:c )?(?:1[89]|20)[0-9]{2}"),
    ("creative-commons", "creative commons", "creative commons"),
    ("unlicense", "unlicense", "the unlicense"),
    ("spdx", "spdx", "spdx license identifier"),
)

SENTENCE, SPDX, VERSIONED, GRANTED, NAMED, MENTIONED = range(1, 7)
#: How sure a detection of each priority is.
CERTAINTY = {SENTENCE: 1.0, SPDX: 1.0, VERSIONED: 0.9, GRANTED: 0.8, NAMED: 0.6, MENTIONED: 0.3}

_GRANT = "(?:licensed|released|distributed|available|covered|published|provided|offered)"
_TERMS = "under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?"
_TAIL = "(?: public)?(?: licen[cs]e)?"


def _version(version: str) -> str:
    """The words of ``2.0``, where a zero at the end may be left out."""
    major, minor = version.split(" ")
    return f"{major}(?: {minor})?" if minor == "0" else f"{major} {minor}"


def _rules() -> list[LicenseRule]:
    rules = []
    for label, (keyword, name, versions) in FAMILIES.items():
        label = label.removesuffix("-short").removesuffix("-library")
        for version in versions:
            full = f"{label}-{version.replace(' ', '.')}"
            number = f"(?:v|version |v )?{_version(version)}"
            rules += [
                LicenseRule(full, SPDX, keyword, f"identifier {name} {number}"),
                LicenseRule(full, VERSIONED, keyword, f"{name}{_TAIL} {number}"),
                LicenseRule(full, VERSIONED, keyword, f"{_GRANT} {_TERMS}{name}{_TAIL} {number}"),
            ]
        rules += [
            LicenseRule(label, SPDX, keyword, f"identifier {name}"),
            LicenseRule(label, GRANTED, keyword, f"{_GRANT} {_TERMS}{name}(?: licen[cs]e)?"),
            LicenseRule(label, NAMED, keyword, f"(?:the )?{name} licen[cs]e"),
        ]
    rules += [LicenseRule(label, SENTENCE, keyword, x) for label, keyword, x in GRANTS]
    rules += [LicenseRule(label, MENTIONED, keyword, x) for label, keyword, x in MENTIONS]
    return rules


RULES = _rules()

# Phrases that are always looked for, by words.
BASE = {
    "mit": ("mit", "license"),
    "apache": ("apache", "license"),
    "gpl": ("general", "public", "license"),
}
BASE_CERTAINTY = CERTAINTY[NAMED]


def _gates() -> tuple[str, ...]:
    """The longest word of each keyword and base phrase, but for those that hold another one."""
    phrases = [r.keyword.split(" ") for r in RULES] + list(BASE.values())
    longest = {max(phrase, key=len) for phrase in phrases}
    return tuple(sorted(w for w in longest if not any(o != w and o in w for o in longest)))


#: A text with none of these in lower case has no keyword and no base phrase.
GATES = _gates()
