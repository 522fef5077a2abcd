"""Signature rules of the license scan, ordered by priority.

Each license has hand-written patterns of its names, its addresses and
sentences of its text; every name also gives the declaration forms of
``FORMS``. ``rules()`` compiles them all.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

# fixed values: license label -> (identifier pattern, name patterns, address patterns, sentences of the text);
# a blank in a pattern stands for any run of blanks
LICENSES: dict[str, tuple[str, list[str], list[str], list[str]]] = {
    "agpl-3.0": (r"AGPL-3\.0(?:-only|-or-later)?", [r"(?:GNU )?Affero General Public License(?:,? (?:version|v)\.? ?3)?", r"AGPL ?v?3"], [r"gnu\.org/licenses/agpl"], [r"remote network interaction"]),
    "lgpl-2.1": (r"LGPL-2\.1(?:-only|-or-later)?", [r"(?:GNU )?Lesser General Public License,? (?:version|v)\.? ?2\.1", r"LGPL ?v?2\.1"], [r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"], []),
    "lgpl-3.0": (r"LGPL-3\.0(?:-only|-or-later)?", [r"(?:GNU )?Lesser General Public License,? (?:version|v)\.? ?3", r"LGPL ?v?3"], [r"gnu\.org/licenses/lgpl-3"], []),
    "lgpl": (r"LGPL", [r"(?:GNU )?(?:Lesser|Library) General Public License"], [r"gnu\.org/licenses/lgpl"], []),
    "gpl-2.0": (r"GPL-2\.0(?:-only|-or-later|\+)?", [r"(?:GNU )?General Public License,? (?:version|v)\.? ?2", r"GPL ?v?2(?:\.0)?"], [r"gnu\.org/licenses/(?:old-licenses/)?gpl-2"], []),
    "gpl-3.0": (r"GPL-3\.0(?:-only|-or-later|\+)?", [r"(?:GNU )?General Public License,? (?:version|v)\.? ?3", r"GPL ?v?3(?:\.0)?"], [r"gnu\.org/licenses/gpl-3"], []),
    "gpl": (r"GPL", [r"(?:GNU )?General Public License", r"GNU GPL"], [r"gnu\.org/licenses/gpl", r"gnu\.org/copyleft/gpl"], [r"either version \d of the License, or \(at your option\) any later version"]),
    "gfdl": (r"GFDL-1\.[123](?:-only|-or-later)?", [r"(?:GNU )?Free Documentation License"], [r"gnu\.org/licenses/fdl"], [r"no Invariant Sections"]),
    "apache-1.1": (r"Apache-1\.1", [r"Apache Software License,? (?:version )?1\.1"], [r"apache\.org/licenses/LICENSE-1\.1"], []),
    "apache-2.0": (r"Apache-2\.0", [r"Apache(?: Software)? License,? (?:version |v)?2(?:\.0)?", r"ASL 2\.0"], [r"apache\.org/licenses/LICENSE-2\.0"], [r"you may not use this file except in compliance with the License"]),
    "apache": (r"Apache", [r"Apache(?: Software)? License"], [r"apache\.org/licenses"], []),
    "mit": (r"MIT", [r"MIT License", r"MIT-style license", r"Expat license", r"X11 license"], [r"opensource\.org/licenses/mit", r"mit-license\.org"], [r"Permission is hereby granted, free of charge, to any person obtaining a copy", r"THE SOFTWARE IS PROVIDED .AS IS., WITHOUT WARRANTY OF ANY KIND"]),
    "mit-0": (r"MIT-0", [r"MIT No Attribution"], [r"github\.com/aws/mit-0"], []),
    "bsd-2-clause": (r"BSD-2-Clause", [r"(?:2|two)[- ]clause BSD(?: license)?", r"simplified BSD(?: license)?", r"FreeBSD license"], [r"opensource\.org/licenses/bsd-2-clause"], []),
    "bsd-3-clause": (r"BSD-3-Clause", [r"(?:3|three)[- ]clause BSD(?: license)?", r"(?:new|revised|modified) BSD(?: license)?"], [r"opensource\.org/licenses/bsd-3-clause"], [r"may be used to endorse or promote products derived from this software"]),
    "bsd-4-clause": (r"BSD-4-Clause", [r"(?:4|four)[- ]clause BSD(?: license)?", r"original BSD license"], [], [r"All advertising materials mentioning features or use of this software"]),
    "bsd": (r"BSD", [r"BSD(?:-style)? license", r"Berkeley Software Distribution"], [r"opensource\.org/licenses/bsd"], [r"Redistribution and use in source and binary forms, with or without modification, are permitted"]),
    "0bsd": (r"0BSD", [r"zero[- ]clause BSD(?: license)?"], [r"opensource\.org/licenses/0bsd"], []),
    "isc": (r"ISC", [r"ISC license"], [r"opensource\.org/licenses/isc"], [r"Permission to use, copy, modify, and/?(?:or)? distribute this software for any purpose"]),
    "mpl-1.1": (r"MPL-1\.1", [r"Mozilla Public License,? (?:version |v)?1\.1", r"MPL 1\.1"], [r"mozilla\.org/MPL/MPL-1\.1", r"mozilla\.org/MPL/1\.1"], []),
    "mpl-2.0": (r"MPL-2\.0", [r"Mozilla Public License,? (?:version |v)\.? ?2(?:\.0)?", r"MPL ?v?2(?:\.0)?"], [r"mozilla\.org/MPL/2\.0"], []),
    "mpl": (r"MPL", [r"Mozilla Public License"], [r"mozilla\.org/MPL"], []),
    "epl-1.0": (r"EPL-1\.0", [r"Eclipse Public License,? (?:version |v)\.? ?1(?:\.0)?"], [r"eclipse\.org/legal/epl-v10"], []),
    "epl-2.0": (r"EPL-2\.0", [r"Eclipse Public License,? (?:version |v)\.? ?2(?:\.0)?"], [r"eclipse\.org/legal/epl-(?:2\.0|v20)"], []),
    "epl": (r"EPL", [r"Eclipse Public License"], [r"eclipse\.org/legal/epl"], []),
    "cddl": (r"CDDL-1\.[01]", [r"Common Development and Distribution License", r"CDDL"], [r"opensource\.org/licenses/cddl"], []),
    "cpl": (r"CPL-1\.0", [r"Common Public License"], [r"opensource\.org/licenses/cpl"], []),
    "eupl": (r"EUPL-1\.[012]", [r"European Union Public Licen[cs]e", r"EUPL"], [r"joinup\.ec\.europa\.eu/.{0,40}eupl"], []),
    "cc0-1.0": (r"CC0-1\.0", [r"CC0(?: 1\.0)?(?: Universal)?", r"Creative Commons Zero"], [r"creativecommons\.org/publicdomain/zero"], [r"waive all copyright and related rights"]),
    "cc-by-4.0": (r"CC-BY-4\.0", [r"Creative Commons Attribution 4\.0(?: International)?(?: License)?", r"CC BY 4\.0"], [r"creativecommons\.org/licenses/by/4\.0"], []),
    "cc-by-3.0": (r"CC-BY-3\.0", [r"Creative Commons Attribution 3\.0(?: Unported)?(?: License)?", r"CC BY 3\.0"], [r"creativecommons\.org/licenses/by/3\.0"], []),
    "cc-by-sa-4.0": (r"CC-BY-SA-4\.0", [r"Creative Commons Attribution[- ]Share ?Alike 4\.0(?: International)?(?: License)?", r"CC BY-SA 4\.0"], [r"creativecommons\.org/licenses/by-sa/4\.0"], []),
    "cc-by-sa-3.0": (r"CC-BY-SA-3\.0", [r"Creative Commons Attribution[- ]Share ?Alike 3\.0(?: Unported)?(?: License)?", r"CC BY-SA 3\.0"], [r"creativecommons\.org/licenses/by-sa/3\.0"], []),
    "cc-by-nc": (r"CC-BY-NC-\d\.0", [r"Creative Commons Attribution[- ]Non-?Commercial(?: License)?", r"CC BY-NC(?: \d\.0)?"], [r"creativecommons\.org/licenses/by-nc/"], []),
    "cc-by-nc-sa": (r"CC-BY-NC-SA-\d\.0", [r"Creative Commons Attribution[- ]Non-?Commercial[- ]Share ?Alike", r"CC BY-NC-SA(?: \d\.0)?"], [r"creativecommons\.org/licenses/by-nc-sa"], []),
    "cc-by-nd": (r"CC-BY-ND-\d\.0", [r"Creative Commons Attribution[- ]No ?Deriv(?:ative|s)(?: Works)?", r"CC BY-ND(?: \d\.0)?"], [r"creativecommons\.org/licenses/by-nd"], []),
    "cc-by": (r"CC-BY", [r"Creative Commons Attribution(?: License)?", r"CC BY"], [r"creativecommons\.org/licenses/by/"], []),
    "cc-by-sa": (r"CC-BY-SA", [r"Creative Commons Attribution[- ]Share ?Alike(?: License)?", r"CC BY-SA"], [r"creativecommons\.org/licenses/by-sa"], []),
    "unlicense": (r"Unlicense", [r"the Unlicense"], [r"unlicense\.org"], [r"This is free and unencumbered software released into the public domain"]),
    "public-domain": (r"LicenseRef-public-domain", [r"public domain"], [], [r"dedicated to the public domain", r"placed in the public domain"]),
    "wtfpl": (r"WTFPL", [r"WTFPL", r"Do What The F\w+ You Want To Public License"], [r"wtfpl\.net"], []),
    "zlib": (r"Zlib", [r"zlib(?:/libpng)? license"], [r"zlib\.net/zlib_license", r"opensource\.org/licenses/zlib"], [r"In no event will the authors be held liable for any damages arising from the use of this software"]),
    "libpng": (r"Libpng", [r"libpng license", r"PNG Reference Library License"], [r"libpng\.org/pub/png/src/libpng-LICENSE"], []),
    "boost-1.0": (r"BSL-1\.0", [r"Boost Software License"], [r"boost\.org/LICENSE_1_0"], []),
    "busl-1.1": (r"BUSL-1\.1", [r"Business Source License"], [r"mariadb\.com/bsl11"], []),
    "sspl": (r"SSPL-1\.0", [r"Server Side Public License", r"SSPL"], [r"mongodb\.com/licensing/server-side-public-license"], []),
    "elastic-2.0": (r"Elastic-2\.0", [r"Elastic License(?: 2\.0)?"], [r"elastic\.co/licensing/elastic-license"], []),
    "artistic-1.0": (r"Artistic-1\.0", [r"Artistic License,? (?:version )?1(?:\.0)?"], [r"opensource\.org/licenses/artistic-license-1\.0"], []),
    "artistic-2.0": (r"Artistic-2\.0", [r"Artistic License,? (?:version )?2(?:\.0)?"], [r"opensource\.org/licenses/artistic-license-2\.0"], []),
    "artistic": (r"Artistic", [r"Artistic License", r"same terms as Perl itself"], [r"dev\.perl\.org/licenses/artistic"], []),
    "psf-2.0": (r"PSF-2\.0|Python-2\.0", [r"Python Software Foundation License", r"PSF license"], [r"docs\.python\.org/.{0,12}license"], []),
    "postgresql": (r"PostgreSQL", [r"PostgreSQL License"], [r"opensource\.org/licenses/postgresql"], []),
    "openssl": (r"OpenSSL", [r"OpenSSL License"], [r"openssl\.org/source/license"], []),
    "php-3.01": (r"PHP-3\.01", [r"PHP License"], [r"php\.net/license"], []),
    "ruby": (r"Ruby", [r"Ruby License"], [r"ruby-lang\.org/.{0,8}LICENSE"], []),
    "vim": (r"Vim", [r"Vim License"], [r"vimhelp\.org/uganda"], []),
    "ofl-1.1": (r"OFL-1\.1", [r"SIL Open Font License", r"Open Font License"], [r"scripts\.sil\.org/OFL", r"openfontlicense\.org"], []),
    "odbl-1.0": (r"ODbL-1\.0", [r"Open Database License", r"ODbL"], [r"opendatacommons\.org/licenses/odbl"], []),
    "odc-by": (r"ODC-By-1\.0", [r"Open Data Commons Attribution License", r"ODC-By"], [r"opendatacommons\.org/licenses/by"], []),
    "pddl": (r"PDDL-1\.0", [r"Public Domain Dedication and License", r"PDDL"], [r"opendatacommons\.org/licenses/pddl"], []),
    "ms-pl": (r"MS-PL", [r"Microsoft Public License"], [r"opensource\.org/licenses/ms-pl"], []),
    "ms-rl": (r"MS-RL", [r"Microsoft Reciprocal License"], [r"opensource\.org/licenses/ms-rl"], []),
    "osl-3.0": (r"OSL-3\.0", [r"Open Software License"], [r"opensource\.org/licenses/osl"], []),
    "afl-3.0": (r"AFL-3\.0", [r"Academic Free License"], [r"opensource\.org/licenses/afl"], []),
    "ncsa": (r"NCSA", [r"University of Illinois/NCSA Open Source License", r"NCSA License"], [r"opensource\.org/licenses/ncsa"], []),
    "ecl-2.0": (r"ECL-2\.0", [r"Educational Community License"], [r"opensource\.org/licenses/ecl"], []),
    "upl-1.0": (r"UPL-1\.0", [r"Universal Permissive License"], [r"opensource\.org/licenses/upl"], []),
    "mulan-psl-2.0": (r"MulanPSL-2\.0", [r"Mulan Permissive Software License", r"Mulan PSL ?v2"], [r"license\.coscl\.org\.cn/MulanPSL2"], []),
    "openrail": (r"OpenRAIL(?:-M)?", [r"OpenRAIL(?:-M|\+\+)?(?: License)?", r"Responsible AI License"], [r"bigscience\.huggingface\.co/.{0,20}license"], []),
    "proprietary": (r"LicenseRef-proprietary", [r"proprietary license", r"commercial license"], [], [r"All rights reserved", r"unauthori[sz]ed copying of this (?:file|work)"]),
}

# fixed values: form of a declaration -> (priority in percent, pattern around a name or identifier)
FORMS: dict[str, tuple[int, str]] = {
    "identifier": (100, r"SPDX-License-Identifier: ?(?:\(?[\w.+-]+ (?:OR|AND|WITH) )*\(?({id})(?![\w.-])"),
    "field": (95, r"\blicen[cs]e ?[=:] ?[\"']?{id}(?![\w.-])"),
    "address": (90, r"{address}"),
    "granted": (85, r"\b(?:licensed|released|distributed|published|available|provided|covered|governed|redistribute it)(?: \w+){{0,4}}? (?:under|by|on|with)(?: the)?(?: terms of(?: the)?)? {name}\b"),
    "sentence": (70, r"{sentence}"),
    "name": (60, r"\b{name}\b"),
}


@dataclass(frozen=True)
class Rule:
    label: str
    form: str
    priority: int
    keyword: str
    pattern: re.Pattern


def _keyword(pattern: str) -> str:
    """The longest literal that every match of ``pattern`` holds, lower-cased."""
    depth, literal, best, i = 0, "", "", 0

    def flush():
        nonlocal literal, best
        if len(literal) > len(best):
            best = literal
        literal = ""

    while i < len(pattern):
        c = pattern[i]
        if c == "\\" and i + 1 < len(pattern) and not pattern[i + 1].isalnum():
            c, i = pattern[i + 1], i + 1
        elif c in "\\()[]|.{}^$ ":
            flush()
            if c == "\\":
                i += 2
                continue
            if c in "([{":  # skip groups and sets as a whole: they may be optional
                depth, closing = 1, {"(": ")", "[": "]", "{": "}"}[c]
                while depth:
                    i += 1
                    if pattern[i] == "\\":
                        i += 1
                    elif pattern[i] == c:
                        depth += 1
                    elif pattern[i] == closing:
                        depth -= 1
            i += 1
            if i < len(pattern) and pattern[i] in "?*+":
                i += 1
            continue
        if i + 1 < len(pattern) and pattern[i + 1] in "?*":
            flush()
            i += 2
            continue
        if c == "+":
            flush()
        elif depth == 0:
            literal += c.lower()
        i += 1
    flush()
    return best


def rules() -> list[Rule]:
    """Every rule, highest priority first; ties by label and pattern."""
    out = []

    def add(label, form, source, **part):
        priority, shape = FORMS[form]
        alternatives = len(source.split("|")) > 1 and "(" not in source
        body = f"(?:{source})" if alternatives or form in ("identifier", "field", "name", "granted") else source
        text = shape.format(**{part["slot"]: body}).replace(" ?", r"\s*").replace(" ", r"\s+")
        keyword = "" if alternatives else _keyword(source)
        if form in ("identifier", "field"):
            keyword = "spdx-license" if form == "identifier" else "licen"
        out.append(Rule(label, form, priority, keyword, re.compile(text, re.IGNORECASE | re.ASCII)))

    for label, (identifier, names, addresses, sentences) in LICENSES.items():
        add(label, "identifier", identifier, slot="id")
        add(label, "field", identifier, slot="id")
        for name in names:
            add(label, "granted", name, slot="name")
            add(label, "name", name, slot="name")
        for address in addresses:
            add(label, "address", address, slot="address")
        for sentence in sentences:
            add(label, "sentence", sentence, slot="sentence")
    return sorted(out, key=lambda r: (-r.priority, r.label, r.pattern.pattern))
