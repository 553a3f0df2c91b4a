"""Signature rules for licence texts.

A rule's expression runs over the words of a text: lower-cased, joined by one space, with one space at
either end. Its keyword is a string every match contains; a text without it never runs the expression.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Signature:
    label: str
    keyword: str
    pattern: str
    priority: int  # 1 (a name) to 4 (a grant in full words)
    weight: float  # how sure a match is

    @property
    def regex(self) -> str:
        return f"(?<= )(?:{self.pattern})(?= )"


# The phrases every scan reports, and their labels.
BASE = [
    Signature("gpl", "gnu general public license", "gnu general public license", 1, 0.9),
    Signature("apache", "apache license", "apache license", 1, 0.9),
    Signature("cc-by", " cc by ", "cc by", 1, 0.7),
    Signature("mit", "mit license", "mit license", 1, 0.9),
]

VERSION = r"(?: (?:version|v))? ?v?"

# label | keyword | expression
NAMES = r"""
gpl-1.0 | gnu g | gnu (?:gpl|general public license){v}1(?: 0)?
gpl-2.0 | gnu g | gnu (?:gpl|general public license){v}2(?: 0)?
gpl-3.0 | gnu g | gnu (?:gpl|general public license){v}3(?: 0)?
lgpl | lesser general public license | gnu lesser general public license
lgpl | library general public license | gnu library general public license
lgpl-2.0 | library general public license | gnu library general public license{v}2(?: 0)?
lgpl-2.1 | lesser general public license | gnu lesser general public license{v}2 1
lgpl-3.0 | lesser general public license | gnu lesser general public license{v}3(?: 0)?
agpl | affero general public license | (?:gnu )?affero general public license
agpl-3.0 | affero general public license | (?:gnu )?affero general public license{v}3(?: 0)?
gfdl | free documentation license | gnu free documentation license
gfdl-1.2 | free documentation license | gnu free documentation license{v}1 2
gfdl-1.3 | free documentation license | gnu free documentation license{v}1 3
gpl | gnu gpl | gnu gpl
apache-1.0 | apache | apache (?:software )?license{v}1 0
apache-1.1 | apache | apache (?:software )?license{v}1 1
apache-2.0 | apache | apache (?:software )?license{v}2(?: 0)?
apache | apache software license | apache software license
mit | expat license | expat license
mit | x11 license | x11 license
mit-0 | no attribution | mit no attribution(?: license)?
bsd | bsd license | (?:modified |new |revised |simplified |original |old )?bsd license
bsd-0-clause | zero clause bsd | zero clause bsd(?: license)?
bsd-2-clause | 2 clause | bsd 2 clause(?: license)?|2 clause bsd(?: license)?
bsd-2-clause | simplified bsd | simplified bsd license
bsd-3-clause | 3 clause | bsd 3 clause(?: license)?|3 clause bsd(?: license)?
bsd-3-clause | new bsd | new bsd license
bsd-4-clause | 4 clause | bsd 4 clause(?: license)?|4 clause bsd(?: license)?
mpl | mozilla public license | mozilla public license
mpl-1.0 | mozilla public license | mozilla public license{v}1 0
mpl-1.1 | mozilla public license | mozilla public license{v}1 1
mpl-2.0 | mozilla public license | mozilla public license{v}2(?: 0)?
epl | eclipse public license | eclipse public license
epl-1.0 | eclipse public license | eclipse public license{v}1 0
epl-2.0 | eclipse public license | eclipse public license{v}2(?: 0)?
eupl | european union public licen | european union public licen[cs]e
eupl-1.1 | european union public licen | european union public licen[cs]e{v}1 1
eupl-1.2 | european union public licen | european union public licen[cs]e{v}1 2
cddl | common development and distribution license | common development and distribution license
cddl-1.0 | common development and distribution license | common development and distribution license{v}1 0
cddl-1.1 | common development and distribution license | common development and distribution license{v}1 1
cpl-1.0 | common public license | common public license(?:{v}1 0)?
ipl-1.0 | ibm public license | ibm public license(?:{v}1 0)?
isc | isc license | isc license
zlib | zlib | zlib(?: libpng)? license
libpng | libpng license | libpng license
boost-1.0 | boost software license | boost software license(?:{v}1 0)?
artistic | artistic license | artistic license
artistic-1.0 | artistic license | artistic license{v}1 0
artistic-2.0 | artistic license | artistic license{v}2(?: 0)?
clarified-artistic | clarified artistic license | clarified artistic license
unlicense | unlicense | (?:the )?unlicense
wtfpl | do what the fuck you want | do what the fuck you want to public license
cc0 | cc0 | cc0(?: 1 0)?(?: universal)?
cc0 | public domain dedication | cc0 (?:1 0 )?(?:universal )?public domain dedication
public-domain | public domain | (?:released (?:in)?to |placed in |is in |in )the public domain
cc-by | creative commons attribution | creative commons attribution(?: license)?
cc-by-1.0 | cc by 1 0 | cc by 1 0
cc-by-2.0 | cc by 2 0 | cc by 2 0
cc-by-2.5 | cc by 2 5 | cc by 2 5
cc-by-3.0 | cc by 3 0 | cc by 3 0
cc-by-4.0 | cc by 4 0 | cc by 4 0
cc-by-sa | cc by sa | cc by sa
cc-by-sa-2.0 | cc by sa 2 0 | cc by sa 2 0
cc-by-sa-2.5 | cc by sa 2 5 | cc by sa 2 5
cc-by-sa-3.0 | cc by sa 3 0 | cc by sa 3 0
cc-by-sa-4.0 | cc by sa 4 0 | cc by sa 4 0
cc-by-nc | cc by nc | cc by nc
cc-by-nc-2.0 | cc by nc 2 0 | cc by nc 2 0
cc-by-nc-2.5 | cc by nc 2 5 | cc by nc 2 5
cc-by-nc-3.0 | cc by nc 3 0 | cc by nc 3 0
cc-by-nc-4.0 | cc by nc 4 0 | cc by nc 4 0
cc-by-nd | cc by nd | cc by nd
cc-by-nd-3.0 | cc by nd 3 0 | cc by nd 3 0
cc-by-nd-4.0 | cc by nd 4 0 | cc by nd 4 0
cc-by-nc-sa | cc by nc sa | cc by nc sa
cc-by-nc-sa-3.0 | cc by nc sa 3 0 | cc by nc sa 3 0
cc-by-nc-sa-4.0 | cc by nc sa 4 0 | cc by nc sa 4 0
cc-by-nc-nd | cc by nc nd | cc by nc nd
cc-by-nc-nd-3.0 | cc by nc nd 3 0 | cc by nc nd 3 0
cc-by-nc-nd-4.0 | cc by nc nd 4 0 | cc by nc nd 4 0
cc-by-sa | creative commons attribution sharealike | creative commons attribution sharealike(?: license)?
cc-by-sa | creative commons attribution share alike | creative commons attribution share alike(?: license)?
cc-by-nc | creative commons attribution noncommercial | creative commons attribution noncommercial(?: license)?
cc-by-nc | creative commons attribution non commercial | creative commons attribution non commercial(?: license)?
cc-by-nd | creative commons attribution noderiv | creative commons attribution noderiv(?:s|ative|atives)(?: license)?
cc-by-nc-sa | creative commons attribution noncommercial sharealike | creative commons attribution noncommercial sharealike(?: license)?
cc-by-nc-nd | creative commons attribution noncommercial noderiv | creative commons attribution noncommercial noderiv(?:s|ative|atives)(?: license)?
odbl-1.0 | open database license | (?:open data commons )?open database license(?:{v}1 0)?
odc-by-1.0 | open data commons attribution | open data commons attribution license(?:{v}1 0)?
pddl-1.0 | open data commons public domain | open data commons public domain dedication and license
ofl-1.1 | open font license | (?:sil )?open font license(?:{v}1 1)?
ofl-1.0 | open font license | (?:sil )?open font license{v}1 0
openssl | openssl license | openssl license
php-3.01 | php license | php license(?:{v}3 0 ?1)?
python-2.0 | python license | python license(?:{v}2(?: 0)?)?
psf-2.0 | python software foundation license | python software foundation license(?:{v}2(?: 0)?)?
ruby | ruby license | ruby license
postgresql | postgresql licen | postgresql licen[cs]e
ms-pl | microsoft public license | microsoft public license
ms-rl | microsoft reciprocal license | microsoft reciprocal license
ncsa | ncsa | (?:university of illinois )?ncsa open source license
afl-3.0 | academic free license | academic free license(?:{v}3 0)?
afl-2.1 | academic free license | academic free license{v}2 1
osl-3.0 | open software license | open software license(?:{v}3 0)?
osl-2.1 | open software license | open software license{v}2 1
qpl-1.0 | q public license | q public license(?:{v}1 0)?
w3c | w3c software | w3c software (?:notice and )?license
vim | vim license | vim license
cecill-2.1 | cecill | cecill(?: free software license agreement)?(?:{v}2 1)?
cecill-b | cecill b | cecill b
cecill-c | cecill c | cecill c
upl-1.0 | universal permissive license | universal permissive license(?:{v}1 0)?
mulan-psl-2.0 | mulan permissive | mulan permissive software license(?:{v}2)?
busl-1.1 | business source license | business source license(?:{v}1 1)?
sspl-1.0 | server side public license | server side public license(?:{v}1)?
elastic-2.0 | elastic license | elastic license(?:{v}2(?: 0)?)?
openrail-m | openrail | (?:creativeml |bigcode )?openrail (?:m|m license)
commons-clause | commons clause | commons clause(?: license condition)?
json | for good not evil | the software shall be used for good not evil
beerware | beerware license | beerware license
beerware | beer ware license | beer ware license
proprietary | all rights reserved | all rights reserved
proprietary | confidential and proprietary | confidential and proprietary
proprietary | proprietary | proprietary (?:software )?license(?: agreement)?
proprietary | end user license agreement | end user license agreement
proprietary | unauthorized copying | unauthorized copying of this (?:file|work|document|software)
"""

# Words of a grant before the name of a licence; the grant outranks the bare name it contains.
GRANTS = [
    r"(?:is |are )?licensed (?:to you )?under (?:the )?(?:terms of (?:the )?)?",
    r"(?:is |are )?(?:released|distributed|published|available|provided|covered) (?:under|by) (?:the )?(?:terms of (?:the )?)?",
]
GRANT_WORDS = ["licensed", "under"]

# Running texts that stand for a licence without naming it: label | keyword | expression
TEXTS = r"""
mit | permission is hereby granted free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software
mit | the above copyright notice and this permission notice | the above copyright notice and this permission notice shall be included in all copies
isc | permission to use copy modify | permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee
bsd | redistribution and use in source and binary forms | redistribution and use in source and binary forms with or without modification are permitted
bsd-3-clause | may be used to endorse or promote | neither the name of (?:[^ ]+ ){1,12}may be used to endorse or promote products
bsd-4-clause | all advertising materials mentioning | all advertising materials mentioning features or use of this software must display
apache-2.0 | you may not use this file except in compliance | you may not use this file except in compliance with the license
gpl | this program is free software | this program is free software you can redistribute it and or modify it
lgpl | this library is free software | this library is free software you can redistribute it and or modify it
gpl | without even the implied warranty | without even the implied warranty of merchantability or fitness for a particular purpose
mpl-2.0 | subject to the terms of the mozilla | this source code form is subject to the terms of the mozilla public license
unlicense | free and unencumbered software | this is free and unencumbered software released into the public domain
zlib | provided as is without any express or implied warranty | this software is provided as is without any express or implied warranty
cc0 | waived all copyright | has waived all copyright and related or neighboring rights
boost-1.0 | obtaining a copy of the software and accompanying | obtaining a copy of the software and accompanying documentation covered by this license
public-domain | disclaims copyright to this source code | the author disclaims copyright to this source code
"""

SPDX = """
AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-1.0 Artistic-2.0 BSD-2-Clause BSD-3-Clause BSD-4-Clause
BSL-1.0 BUSL-1.1 CC0-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-NC-SA-4.0 CC-BY-ND-4.0
CDDL-1.0 CDDL-1.1 CECILL-2.1 EPL-1.0 EPL-2.0 EUPL-1.2 GFDL-1.3-only GPL-2.0-only GPL-2.0-or-later GPL-3.0-only
GPL-3.0-or-later ISC LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0-only LGPL-3.0-or-later MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL
NCSA ODbL-1.0 OFL-1.1 OSL-3.0 PostgreSQL PSF-2.0 Python-2.0 SSPL-1.0 Unlicense UPL-1.0 Vim W3C WTFPL Zlib 0BSD
""".split()


def _rows(table: str):
    for line in table.strip().splitlines():
        yield (part.strip() for part in line.split(" | ", 2))


def signatures() -> list[Signature]:
    """All rules in order: base phrases, names, grants of those names, running texts, identifiers."""
    rules = list(BASE)
    names = [(label, key, pattern.replace("{v}", VERSION)) for label, key, pattern in _rows(NAMES)]
    for label, key, pattern in names:
        rules.append(Signature(label, key, pattern, 2, 0.7))
    for label, key, pattern in names + [(b.label, b.keyword.strip(), b.pattern) for b in BASE]:
        for grant in GRANTS:
            rules.append(Signature(label, key, f"{grant}(?:{pattern})", 3, 1.0))
    rules += [Signature(label, key, pattern, 4, 0.95) for label, key, pattern in _rows(TEXTS)]
    for name in SPDX:
        words = name.lower().replace("-", " ").replace(".", " ")
        rules.append(Signature(name.lower(), "spdx license identifier", f"spdx license identifier {words}", 4, 1.0))
    return rules
