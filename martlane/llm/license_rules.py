"""Signature rules of the license scan.

A rule is (label, keyword, pattern, priority).  Patterns are matched against the words of a
text in lower case with one space between them, so punctuation is a space: version 2.0 reads
``2 0``.  The keyword is a word that every match holds; it gates the pattern.  Priority 1 is
a full title or identifier with a version, 2 a title, 3 a phrase that says that there is a
license or right without naming it.  Families with versions and parts are built from their
parameters.
"""

from __future__ import annotations

BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

V = r"(?:(?:v|version|ver|vers) ?)?"


def _creative_commons() -> list[tuple[str, str, str, int]]:
    parts = {"by": "attribution", "nc": "non ?commercial", "sa": "share ?alike", "nd": "no ?deriv(?:s|atives?|ative works)"}
    rules = []
    for kind in ("by", "by sa", "by nc", "by nd", "by nc sa", "by nc nd"):
        title = " ".join(parts[p] for p in kind.split())
        name = f"cc-{kind.replace(' ', '-')}"
        rules += [(name, "cc", f"cc {kind}(?! (?:sa|nc|nd) )", 2),
                  (name, "attribution", f"(?:creative commons )?{title}(?: (?:international|unported|generic))? (?:public )?licen[cs]e", 2)]
        for version in ("1.0", "2.0", "2.5", "3.0", "4.0"):
            v = version.replace(".", " ")
            rules += [(f"{name}-{version}", "cc", f"cc {kind} {V}{v}", 1),
                      (f"{name}-{version}", "attribution", f"(?:creative commons )?{title} {V}{v}", 1),
                      (f"{name}-{version}", "creativecommons", f"creativecommons org licenses {kind} {v}", 1)]
    return rules


def _gnu() -> list[tuple[str, str, str, int]]:
    rules = []
    for short, title, versions in (("gpl", "general public licen[cs]e", ("1.0", "2.0", "3.0")),
                                   ("lgpl", "(?:lesser|library) general public licen[cs]e", ("2.0", "2.1", "3.0")),
                                   ("agpl", "affero general public licen[cs]e", ("1.0", "3.0"))):
        rules += [(short, "public", f"(?:gnu )?{title}", 2), (short, short, f"(?:gnu )?{short}(?: licen[cs]ed?)?", 2)]
        for version in versions:
            number, minor = version.split(".")
            v = number if minor == "0" else f"{number} {minor}"
            tail = " 0" if minor == "0" else ""
            joined = f"{short}v{number}"
            rules += [(f"{short}-{version}", "public", f"(?:gnu )?{title} (?:as published by the free software foundation )?(?:either )?{V}{v}(?:{tail})?(?: (?:only|or later|or any later version|or at your option any later version))?", 1),
                      (f"{short}-{version}", short, f"(?:gnu )?{short} {V}{v}(?:{tail})?(?: (?:only|or later))?", 1),
                      (f"{short}-{version}", joined, f"(?:gnu )?{joined}(?: {minor})?", 1),
                      (f"{short}-{version}", "gnu", f"gnu org licenses (?:old licenses )?{short} {v}(?:{tail})?", 1)]
    return rules


TITLES: list[tuple[str, str, str, int]] = [
    ("mit", "mit", r"mit licen[cs]e", 2), ("mit", "mit", r"licen[cs]ed under (?:the )?mit", 2),
    ("mit", "mit", r"(?:spdx license identifier|opensource org licenses) mit", 1), ("mit", "expat", r"expat licen[cs]e", 2),
    ("mit", "charge", r"permission is hereby granted free of charge to any person obtaining a copy", 1),
    ("mit-0", "mit", r"mit (?:no attribution|0)(?: licen[cs]e)?", 1),
    ("apache", "apache", r"apache licen[cs]e", 2), ("apache", "apache", r"licen[cs]ed under (?:the )?apache", 2),
    ("apache-1.0", "apache", rf"apache (?:software )?(?:licen[cs]e )?{V}1 0", 1),
    ("apache-1.1", "apache", rf"apache (?:software )?(?:licen[cs]e )?{V}1 1", 1),
    ("apache-2.0", "apache", rf"apache (?:software )?(?:licen[cs]e )?{V}2(?: 0)?", 1),
    ("apache-2.0", "apache", r"apache org licenses license 2 0", 1),
    ("apache-2.0", "asl", rf"asl {V}2(?: 0)?", 1),
    ("bsd-2-clause", "bsd", r"bsd 2 clause(?: licen[cs]e)?", 1), ("bsd-2-clause", "bsd", r"(?:simplified|freebsd|two clause|2 clause) bsd licen[cs]e", 1),
    ("bsd-3-clause", "bsd", r"bsd 3 clause(?: licen[cs]e)?", 1), ("bsd-3-clause", "bsd", r"(?:new|modified|revised|three clause|3 clause) bsd licen[cs]e", 1),
    ("bsd-4-clause", "bsd", r"bsd 4 clause(?: licen[cs]e)?", 1), ("bsd-4-clause", "bsd", r"(?:original|four clause|4 clause) bsd licen[cs]e", 1),
    ("bsd-0-clause", "bsd", r"(?:zero clause bsd|bsd zero clause|0bsd)(?: licen[cs]e)?", 1), ("bsd-0-clause", "0bsd", r"0bsd", 1),
    ("bsd", "bsd", r"bsd(?: style)? licen[cs]e[ds]?", 2), ("bsd", "bsd", r"licen[cs]ed under (?:the )?bsd", 2),
    ("bsd", "redistribution", r"redistribution and use in source and binary forms with or without modification", 2),
    ("mpl", "mozilla", r"mozilla public licen[cs]e", 2), ("mpl", "mpl", r"mpl(?: licen[cs]e)?", 2),
    ("mpl-1.0", "mozilla", rf"mozilla public licen[cs]e {V}1 0", 1), ("mpl-1.0", "mpl", rf"mpl {V}1 0", 1),
    ("mpl-1.1", "mozilla", rf"mozilla public licen[cs]e {V}1 1", 1), ("mpl-1.1", "mpl", rf"mpl {V}1 1", 1),
    ("mpl-2.0", "mozilla", rf"mozilla public licen[cs]e {V}2(?: 0)?", 1), ("mpl-2.0", "mpl", rf"mpl {V}2(?: 0)?", 1),
    ("epl", "eclipse", r"eclipse public licen[cs]e", 2), ("epl-1.0", "eclipse", rf"eclipse public licen[cs]e {V}1 0", 1),
    ("epl-2.0", "eclipse", rf"eclipse public licen[cs]e {V}2(?: 0)?", 1), ("epl-1.0", "epl", rf"epl {V}1 0", 1), ("epl-2.0", "epl", rf"epl {V}2(?: 0)?", 1),
    ("edl", "eclipse", r"eclipse distribution licen[cs]e", 2), ("edl-1.0", "eclipse", rf"eclipse distribution licen[cs]e {V}1 0", 1),
    ("cddl", "cddl", r"cddl", 2), ("cddl-1.0", "cddl", rf"cddl {V}1 0", 1), ("cddl-1.1", "cddl", rf"cddl {V}1 1", 1),
    ("cddl", "distribution", r"common development and distribution licen[cs]e", 2),
    ("cddl-1.0", "distribution", rf"common development and distribution licen[cs]e {V}1 0", 1),
    ("cpl-1.0", "common", rf"common public licen[cs]e(?: {V}1 0)?", 1), ("cpal-1.0", "attribution", rf"common public attribution licen[cs]e(?: {V}1 0)?", 1),
    ("eupl", "eupl", r"eupl", 2), ("eupl-1.1", "eupl", rf"eupl {V}1 1", 1), ("eupl-1.2", "eupl", rf"eupl {V}1 2", 1),
    ("eupl", "union", r"european union public licen[cs]e", 2), ("eupl-1.2", "union", rf"european union public licen[cs]e {V}1 2", 1),
    ("isc", "isc", r"isc licen[cs]e", 2), ("isc", "isc", r"(?:spdx license identifier|licen[cs]ed under (?:the )?) ?isc", 1),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e", 2), ("libpng", "libpng", r"libpng licen[cs]e", 2),
    ("bsl-1.0", "boost", rf"boost software licen[cs]e(?: {V}1 0)?", 1), ("bsl-1.1", "business", rf"business source licen[cs]e(?: {V}1 1)?", 1),
    ("unlicense", "unlicense", r"(?:the )?unlicense", 2), ("unlicense", "unencumbered", r"free and unencumbered software released into the public domain", 1),
    ("wtfpl", "wtfpl", r"wtfpl", 2), ("wtfpl", "fuck", r"do what the fuck you want to public licen[cs]e", 1),
    ("cc0-1.0", "cc0", rf"cc0(?: {V}1 0)?(?: universal)?", 1), ("cc0-1.0", "zero", r"creative commons zero", 1),
    ("cc0-1.0", "creativecommons", r"creativecommons org publicdomain zero 1 0", 1), ("cc", "creative", r"creative commons(?: licen[cs]e[ds]?)?", 3),
    ("cc-pddc", "mark", r"public domain mark(?: 1 0)?", 1), ("public-domain", "domain", r"(?:in(?:to)? )?(?:the )?public domain", 2),
    ("public-domain", "domain", r"dedicated to the public domain", 1), ("artistic", "artistic", r"artistic licen[cs]e", 2),
    ("artistic-1.0", "artistic", rf"artistic licen[cs]e {V}1 0", 1), ("artistic-2.0", "artistic", rf"artistic licen[cs]e {V}2(?: 0)?", 1),
    ("perl", "perl", r"same terms as perl(?: itself)?", 1), ("python-2.0", "python", r"python (?:software foundation )?licen[cs]e(?: version)?(?: 2(?: 0)?)?", 1),
    ("psf", "psf", r"psf(?: 2 0)?(?: licen[cs]e)?", 2), ("ruby", "ruby", r"ruby licen[cs]e", 2), ("php-3.0", "php", rf"php licen[cs]e {V}3 0", 1),
    ("php-3.01", "php", rf"php licen[cs]e(?: {V}3 01)?", 1), ("postgresql", "postgresql", r"postgresql licen[cs]e", 2), ("openssl", "openssl", r"openssl licen[cs]e", 2),
    ("curl", "curl", r"curl licen[cs]e", 2), ("x11", "x11", r"x11 licen[cs]e", 2), ("ncsa", "ncsa", r"(?:university of illinois )?ncsa (?:open source )?licen[cs]e", 2),
    ("w3c", "w3c", r"w3c (?:software )?(?:notice and )?licen[cs]e", 2), ("ofl-1.1", "ofl", rf"(?:sil )?ofl(?: {V}1 1)?", 1),
    ("ofl-1.1", "font", rf"(?:sil )?open font licen[cs]e(?: {V}1 1)?", 1), ("odbl-1.0", "odbl", rf"odbl(?: {V}1 0)?", 1),
    ("odbl-1.0", "database", rf"open (?:data commons open )?database licen[cs]e(?: {V}1 0)?", 1), ("odc-by-1.0", "odc", rf"odc (?:by|attribution licen[cs]e)(?: {V}1 0)?", 1),
    ("pddl-1.0", "pddl", rf"pddl(?: {V}1 0)?", 1), ("gfdl", "documentation", r"(?:gnu )?free documentation licen[cs]e", 2),
    ("gfdl-1.1", "documentation", rf"(?:gnu )?free documentation licen[cs]e {V}1 1", 1), ("gfdl-1.2", "documentation", rf"(?:gnu )?free documentation licen[cs]e {V}1 2", 1),
    ("gfdl-1.3", "documentation", rf"(?:gnu )?free documentation licen[cs]e {V}1 3", 1), ("gfdl", "gfdl", r"(?:gnu )?gfdl", 2),
    ("ms-pl", "microsoft", r"microsoft public licen[cs]e", 1), ("ms-rl", "microsoft", r"microsoft reciprocal licen[cs]e", 1), ("ms-pl", "ms", r"ms pl", 1), ("ms-rl", "ms", r"ms rl", 1),
    ("osl-3.0", "open", rf"open software licen[cs]e(?: {V}3(?: 0)?)?", 1), ("afl-3.0", "academic", rf"academic free licen[cs]e(?: {V}3(?: 0)?)?", 1),
    ("afl-3.0", "afl", rf"afl {V}3(?: 0)?", 1), ("osl-3.0", "osl", rf"osl {V}3(?: 0)?", 1), ("upl-1.0", "universal", rf"universal permissive licen[cs]e(?: {V}1 0)?", 1),
    ("sspl-1.0", "sspl", rf"sspl(?: {V}1(?: 0)?)?", 1), ("sspl-1.0", "server", rf"server side public licen[cs]e(?: {V}1(?: 0)?)?", 1),
    ("elastic-2.0", "elastic", rf"elastic licen[cs]e(?: {V}2(?: 0)?)?", 1), ("mulan-psl-2.0", "mulan", rf"mulan (?:permissive software licen[cs]e|psl)(?: {V}2)?", 1),
    ("blueoak-1.0.0", "oak", r"blue oak model licen[cs]e(?: 1 0 0)?", 1), ("vim", "vim", r"vim licen[cs]e", 2), ("beerware", "beerware", r"beerware(?: licen[cs]e)?", 2),
    ("beerware", "beer", r"beer ware licen[cs]e", 2), ("json", "evil", r"software shall be used for good not evil", 1), ("icu", "icu", r"icu licen[cs]e", 2),
    ("unicode", "unicode", r"unicode (?:dfs 2016 )?licen[cs]e(?: agreement)?", 2), ("ijg", "jpeg", r"independent jpeg group s? ?(?:licen[cs]e|software)", 2),
    ("ipl-1.0", "ibm", rf"ibm public licen[cs]e(?: {V}1 0)?", 1), ("apsl-2.0", "apple", rf"apple public source licen[cs]e(?: {V}2(?: 0)?)?", 1),
    ("npl-1.1", "netscape", rf"netscape public licen[cs]e(?: {V}1 1)?", 1), ("spl-1.0", "sun", rf"sun public licen[cs]e(?: {V}1 0)?", 1),
    ("qpl-1.0", "qt", rf"qt public licen[cs]e(?: {V}1 0)?", 1), ("lppl-1.3", "latex", rf"latex project public licen[cs]e(?: {V}1 3[abc]?)?", 1),
    ("cecill", "cecill", rf"cecill(?: [bc])?(?: {V}\d)?", 2), ("nosl", "nethack", r"nethack general public licen[cs]e", 1),
    ("openrail", "openrail", r"(?:creativeml |bigscience )?openrail(?: m)?", 2), ("openrail", "rail", r"(?:bigscience )?(?:open )?rail licen[cs]e", 2),
    ("llama-community", "community", r"llama \d(?: \d)? community licen[cs]e(?: agreement)?", 1), ("gemma-terms", "gemma", r"gemma terms of use", 1),
    ("commercial", "commercial", r"commercial licen[cs]e", 3), ("proprietary", "proprietary", r"proprietary (?:and confidential|licen[cs]e|software)", 3),
    ("all-rights-reserved", "reserved", r"all rights reserved", 3), ("copyright", "copyright", r"copyright(?: c)? (?:19|20)\d\d(?: (?:19|20)\d\d)?", 3),
    ("copyright", "copyright", r"copyright (?:held )?by", 3), ("copyright", "copyrighted", r"copyrighted by", 3), ("warranty-disclaimer", "warranty", r"without warranty of any kind", 3),
    ("warranty-disclaimer", "warranties", r"without warranties or conditions of any kind", 3), ("warranty-disclaimer", "provided", r"provided as is without", 3),
    ("copyleft", "copyleft", r"copyleft", 3), ("eula", "eula", r"eula", 3), ("eula", "user", r"end user licen[cs]e agreement", 3),
    ("spdx", "spdx", r"spdx license identifier(?: [^ ]+){1,3}", 3), ("license", "licensed", r"licensed under", 3), ("license", "licenced", r"licenced under", 3), ("license", "terms", r"terms of (?:this|the) licen[cs]e", 3),
    ("license", "permissions", r"permissions and limitations under the licen[cs]e", 3), ("license", "released", r"released under (?:the )?(?:[^ ]+ ){1,4}licen[cs]e", 3),
    ("no-derivatives", "derivative", r"no derivative works", 3), ("non-commercial", "noncommercial", r"(?:for )?noncommercial (?:use|purposes) only", 3),
    ("non-commercial", "commercial", r"(?:for )?non commercial (?:use|purposes) only", 3), ("non-commercial", "commercial", r"not for commercial use", 3),
    ("research-only", "research", r"(?:for )?research (?:use|purposes) only", 3), ("fair-use", "fair", r"fair use", 3), ("royalty-free", "royalty", r"royalty free", 3),
]

RULES: list[tuple[str, str, str, int]] = [*TITLES, *_creative_commons(), *_gnu()]
