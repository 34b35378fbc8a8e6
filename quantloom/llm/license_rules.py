"""Hand-written licence signatures. Fixed values, in reading order; earlier families have higher priority.

One line a rule: label ; keyword ; regex. A rule's regex runs only on texts that contain its keyword.
Texts are lower-cased (A-Z) first. Quantifiers are bounded, so a match is at most a few hundred characters.
"""

#: Identifier tags: the strongest evidence.
SPDX = r"""
mit ; spdx- ; spdx-license-identifier:\s{0,4}mit\b(?!-)
mit-0 ; spdx- ; spdx-license-identifier:\s{0,4}mit-0\b
apache-2.0 ; spdx- ; spdx-license-identifier:\s{0,4}apache-2\.0\b
apache-1.1 ; spdx- ; spdx-license-identifier:\s{0,4}apache-1\.1\b
gpl-2.0-only ; spdx- ; spdx-license-identifier:\s{0,4}gpl-2\.0(?:-only)?(?![-+.\w])
gpl-2.0-or-later ; spdx- ; spdx-license-identifier:\s{0,4}gpl-2\.0(?:\+|-or-later)
gpl-3.0-only ; spdx- ; spdx-license-identifier:\s{0,4}gpl-3\.0(?:-only)?(?![-+.\w])
gpl-3.0-or-later ; spdx- ; spdx-license-identifier:\s{0,4}gpl-3\.0(?:\+|-or-later)
lgpl-2.1 ; spdx- ; spdx-license-identifier:\s{0,4}lgpl-2\.1(?:\+|-only|-or-later)?
lgpl-3.0 ; spdx- ; spdx-license-identifier:\s{0,4}lgpl-3\.0(?:\+|-only|-or-later)?
agpl-3.0 ; spdx- ; spdx-license-identifier:\s{0,4}agpl-3\.0(?:\+|-only|-or-later)?
bsd-2-clause ; spdx- ; spdx-license-identifier:\s{0,4}bsd-2-clause\b
bsd-3-clause ; spdx- ; spdx-license-identifier:\s{0,4}bsd-3-clause\b
bsd-4-clause ; spdx- ; spdx-license-identifier:\s{0,4}bsd-4-clause\b
0bsd ; spdx- ; spdx-license-identifier:\s{0,4}0bsd\b
isc ; spdx- ; spdx-license-identifier:\s{0,4}isc\b
mpl-1.1 ; spdx- ; spdx-license-identifier:\s{0,4}mpl-1\.1\b
mpl-2.0 ; spdx- ; spdx-license-identifier:\s{0,4}mpl-2\.0\b
epl-1.0 ; spdx- ; spdx-license-identifier:\s{0,4}epl-1\.0\b
epl-2.0 ; spdx- ; spdx-license-identifier:\s{0,4}epl-2\.0\b
cddl-1.0 ; spdx- ; spdx-license-identifier:\s{0,4}cddl-1\.0\b
cddl-1.1 ; spdx- ; spdx-license-identifier:\s{0,4}cddl-1\.1\b
eupl-1.1 ; spdx- ; spdx-license-identifier:\s{0,4}eupl-1\.1\b
eupl-1.2 ; spdx- ; spdx-license-identifier:\s{0,4}eupl-1\.2\b
cc0-1.0 ; spdx- ; spdx-license-identifier:\s{0,4}cc0-1\.0\b
cc-by-3.0 ; spdx- ; spdx-license-identifier:\s{0,4}cc-by-3\.0\b
cc-by-4.0 ; spdx- ; spdx-license-identifier:\s{0,4}cc-by-4\.0\b
cc-by-sa-3.0 ; spdx- ; spdx-license-identifier:\s{0,4}cc-by-sa-3\.0\b
cc-by-sa-4.0 ; spdx- ; spdx-license-identifier:\s{0,4}cc-by-sa-4\.0\b
cc-by-nc-4.0 ; spdx- ; spdx-license-identifier:\s{0,4}cc-by-nc-4\.0\b
cc-by-nd-4.0 ; spdx- ; spdx-license-identifier:\s{0,4}cc-by-nd-4\.0\b
cc-by-nc-sa-4.0 ; spdx- ; spdx-license-identifier:\s{0,4}cc-by-nc-sa-4\.0\b
cc-by-nc-nd-4.0 ; spdx- ; spdx-license-identifier:\s{0,4}cc-by-nc-nd-4\.0\b
artistic-2.0 ; spdx- ; spdx-license-identifier:\s{0,4}artistic-2\.0\b
bsl-1.0 ; spdx- ; spdx-license-identifier:\s{0,4}bsl-1\.0\b
busl-1.1 ; spdx- ; spdx-license-identifier:\s{0,4}busl-1\.1\b
unlicense ; spdx- ; spdx-license-identifier:\s{0,4}unlicense\b
wtfpl ; spdx- ; spdx-license-identifier:\s{0,4}wtfpl\b
zlib ; spdx- ; spdx-license-identifier:\s{0,4}zlib\b
ncsa ; spdx- ; spdx-license-identifier:\s{0,4}ncsa\b
postgresql ; spdx- ; spdx-license-identifier:\s{0,4}postgresql\b
psf-2.0 ; spdx- ; spdx-license-identifier:\s{0,4}(?:psf|python)-2\.0\b
ofl-1.1 ; spdx- ; spdx-license-identifier:\s{0,4}ofl-1\.1\b
sspl-1.0 ; spdx- ; spdx-license-identifier:\s{0,4}sspl-1\.0\b
gfdl-1.3 ; spdx- ; spdx-license-identifier:\s{0,4}gfdl-1\.3\b
odbl-1.0 ; spdx- ; spdx-license-identifier:\s{0,4}odbl-1\.0\b
ms-pl ; spdx- ; spdx-license-identifier:\s{0,4}ms-pl\b
ms-rl ; spdx- ; spdx-license-identifier:\s{0,4}ms-rl\b
upl-1.0 ; spdx- ; spdx-license-identifier:\s{0,4}upl-1\.0\b
blueoak-1.0.0 ; spdx- ; spdx-license-identifier:\s{0,4}blueoak-1\.0\.0\b
mulanpsl-2.0 ; spdx- ; spdx-license-identifier:\s{0,4}mulanpsl-2\.0\b
w3c ; spdx- ; spdx-license-identifier:\s{0,4}w3c\b
vim ; spdx- ; spdx-license-identifier:\s{0,4}vim\b
spdx-other ; spdx- ; spdx-license-identifier:\s{0,4}[a-z0-9.+-]{1,39}[a-z0-9+]
"""

#: Sentences of the licence texts themselves.
TEXTS = r"""
mit ; permission is hereby granted ; permission is hereby granted, free of charge, to any person obtaining a copy\s{1,4}of this software and associated documentation files
mit ; shall be included in all copies ; the above copyright notice and this permission notice shall be\s{1,4}included in all copies or substantial portions
mit-or-x11 ; permission is hereby granted ; permission is hereby granted, free of charge
x11 ; x consortium ; except as contained in this notice, the name of the x consortium shall not
isc ; permission to use, copy, modify ; permission to use, copy, modify, and(?:/or)? distribute this software for any\s{1,4}purpose with or without fee is hereby granted
bsd-4-clause ; advertising materials ; all advertising materials mentioning features or use of this software\s{1,4}must display
bsd-3-clause ; neither the name of ; neither the name of .{2,80} nor the names of (?:its|any)\s{1,4}contributors may be used
bsd-2-clause ; redistribution and use in source ; redistribution and use in source and binary forms, with or without\s{1,4}modification, are permitted
apache-2.0 ; apache license ; licensed under the apache license, version 2\.0
apache-2.0 ; apache license ; apache license\s{1,4}version 2\.0, january 2004
apache-2.0 ; unless required by applicable law ; unless required by applicable law or agreed to in writing, software\s{1,4}distributed under the license
apache-1.1 ; apache software ; this product includes software developed by the\s{1,4}apache software foundation
gpl-3.0 ; general public license ; gnu general public license,? (?:version|v\.?) ?3(?:\.0)?
gpl-2.0 ; general public license ; gnu general public license,? (?:version|v\.?) ?2(?:\.0)?
gpl ; free software foundation ; under the terms of the gnu general public license as\s{1,4}published by the free software foundation
gpl-or-later ; any later version ; either version [123](?:\.\d)? of the license, or \(?at your\s{1,4}option\)? any later version
gpl ; without even the implied ; without even the implied warranty of\s{1,4}merchantability or fitness for a particular purpose\.\s{1,4}see the\s{1,4}gnu general public license
gpl ; gnu general public ; licensed under the gnu general public license
lgpl-3.0 ; lesser general public ; gnu lesser general public license,? (?:version|v\.?) ?3(?:\.0)?
lgpl-2.1 ; lesser general public ; gnu lesser general public license,? (?:version|v\.?) ?2\.1
lgpl ; lesser general public ; gnu lesser general public license
lgpl-2.0 ; library general public ; gnu library general public license
agpl-3.0 ; affero ; gnu affero general public license(?:,? (?:version|v\.?) ?3(?:\.0)?)?
mpl-2.0 ; mozilla public ; subject to the terms of the\s{1,4}mozilla public license, v\. 2\.0
mpl-1.1 ; mozilla public ; subject to the mozilla public license version\s{1,4}1\.1
epl-2.0 ; eclipse public ; eclipse public license,? (?:version|v\.?|-) ?2\.0
epl-1.0 ; eclipse public ; eclipse public license,? (?:version|v\.?|-) ?1\.0
cddl ; common development ; common development and distribution license
cpl-1.0 ; common public license ; common public license,? (?:version|v\.?) ?1\.0
eupl ; european union public ; european union public licen[cs]e
cecill ; cecill ; cecill(?:-[abc])? (?:free software )?licen[cs]e
artistic ; artistic license ; (?:the )?artistic license(?: 2\.0)?
zlib ; altered source versions ; altered source versions must be plainly marked as such
zlib ; origin of this software ; the origin of this software must not be misrepresented
bsl-1.0 ; boost software ; boost software license\s{0,3}[-,]?\s{1,4}version 1\.0
unlicense ; public domain ; this is free and unencumbered software released into the\s{1,4}public domain
public-domain ; public domain ; (?:released|placed|dedicated|donated) (?:in)?to the public domain
cc0-1.0 ; cc0 ; cc0 1\.0 universal
cc0-1.0 ; waived all copyright ; waived all copyright and related or neighbou?ring rights
wtfpl ; do what the fuck ; do what the fuck you want to public license
beerware ; beer-ware ; the beer-ware license
openssl ; openssl toolkit ; this product includes software developed by the openssl project\s{1,4}for use in the openssl toolkit
php-3.01 ; php license ; subject to version 3\.0\d? of the php license
python-2.0 ; python software foundation ; python software foundation license version 2
ncsa ; university of illinois ; university of illinois/ncsa\s{1,4}open source license
ofl-1.1 ; sil open font ; sil open font license,? (?:version|v\.?) ?1\.1
ofl ; sil open font ; sil open font license
gfdl ; free documentation ; gnu free documentation license
postgresql ; postgresql license ; (?:the )?postgresql license
w3c ; w3c ; w3c software (?:notice and|and document) (?:document )?license
sspl-1.0 ; server side public ; server side public license
busl-1.1 ; business source ; business source license(?: 1\.1)?
elastic-2.0 ; elastic license ; elastic license(?: 2\.0)?
commons-clause ; commons clause ; commons clause license condition v1\.0
ms-pl ; microsoft public ; microsoft public license
ms-rl ; microsoft reciprocal ; microsoft reciprocal license
upl-1.0 ; universal permissive ; universal permissive license
odbl-1.0 ; open database license ; open database license(?: \(odbl\))?
odc-by ; attribution license ; open data commons attribution license
pddl ; public domain dedication ; (?:open data commons )?public domain dedication (?:and|&) licen[cs]e
openrail ; openrail ; (?:creativeml |bigscience |bigcode )?openrail(?:-m|\+\+)?(?: license)?
llama-community ; community license ; llama (?:2|3(?:\.\d)?) community license
"""

#: Creative Commons deeds and names, most specific first.
CREATIVE = r"""
cc-by-nc-nd ; creative commons ; creative commons attribution[- ]non-?commercial[- ]no ?deriv(?:ative)?s?(?: works)?
cc-by-nc-sa ; creative commons ; creative commons attribution[- ]non-?commercial[- ]share-?alike
cc-by-nc ; creative commons ; creative commons attribution[- ]non-?commercial
cc-by-nd ; creative commons ; creative commons attribution[- ]no ?deriv(?:ative)?s?
cc-by-sa-4.0 ; creative commons ; creative commons attribution[- ]share-?alike 4\.0
cc-by-sa-3.0 ; creative commons ; creative commons attribution[- ]share-?alike 3\.0
cc-by-sa ; creative commons ; creative commons attribution[- ]share-?alike
cc-by-4.0 ; creative commons ; creative commons attribution 4\.0
cc-by-3.0 ; creative commons ; creative commons attribution 3\.0
cc-by ; creative commons ; creative commons attribution
cc-zero ; creative commons ; creative commons (?:zero|cc0)
cc-publicdomain ; creative commons ; creative commons public ?domain
cc-unspecified ; creative commons ; under (?:a|the) creative commons licen[cs]e
cc-by-nc-nd ; cc by ; \bcc[- ]by[- ]nc[- ]nd(?:[- ]\d\.\d)?
cc-by-nc-sa ; cc by ; \bcc[- ]by[- ]nc[- ]sa(?:[- ]\d\.\d)?
cc-by-nc ; cc by ; \bcc[- ]by[- ]nc(?:[- ]\d\.\d)?
cc-by-nd ; cc by ; \bcc[- ]by[- ]nd(?:[- ]\d\.\d)?
cc-by-sa ; cc by ; \bcc[- ]by[- ]sa(?:[- ]\d\.\d)?
cc-by ; cc by ; \bcc[- ]by(?:[- ]\d\.\d)?
cc-by-nc-nd ; cc-by ; \bcc-by-nc-nd(?:-\d\.\d)?
cc-by-nc-sa ; cc-by ; \bcc-by-nc-sa(?:-\d\.\d)?
cc-by-nc ; cc-by ; \bcc-by-nc(?:-\d\.\d)?
cc-by-nd ; cc-by ; \bcc-by-nd(?:-\d\.\d)?
cc-by-sa ; cc-by ; \bcc-by-sa(?:-\d\.\d)?
cc-by ; cc-by ; \bcc-by(?:-\d\.\d)?
"""

#: Addresses of licence texts.
ADDRESSES = r"""
apache-2.0 ; apache.org/lic ; https?://(?:www\.)?apache\.org/licenses/license-2\.0(?:\.txt|\.html)?
apache ; apache.org/lic ; https?://(?:www\.)?apache\.org/licenses/?
gpl-3.0 ; gnu.org/lic ; https?://(?:www\.)?gnu\.org/licenses/gpl-3\.0(?:[.-]\w{2,10}){0,2}
gpl-2.0 ; gnu.org/lic ; https?://(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0(?:[.-]\w{2,10}){0,2}
gpl ; gnu.org/lic ; https?://(?:www\.)?gnu\.org/licenses/gpl(?:\.\w{2,5})?
lgpl ; gnu.org/lic ; https?://(?:www\.)?gnu\.org/licenses/(?:old-licenses/)?lgpl(?:-[23]\.[01])?(?:\.\w{2,5})?
agpl-3.0 ; gnu.org/lic ; https?://(?:www\.)?gnu\.org/licenses/agpl(?:-3\.0)?(?:\.\w{2,5})?
gfdl ; gnu.org/ ; https?://(?:www\.)?gnu\.org/(?:licenses|copyleft)/fdl(?:-1\.[123])?(?:\.\w{2,5})?
gnu-unspecified ; gnu.org/lic ; https?://(?:www\.)?gnu\.org/licenses/?
mpl-2.0 ; mozilla.org/mpl ; https?://(?:www\.)?mozilla\.org/mpl/2\.0/?
mpl ; mozilla.org/mpl ; https?://(?:www\.)?mozilla\.org/mpl/?
mit ; opensource.org/lic ; https?://(?:www\.)?opensource\.org/licenses?/mit(?:-license\.php)?
bsd ; opensource.org/lic ; https?://(?:www\.)?opensource\.org/licenses?/bsd-(?:[234]-clause|license\.php)
isc ; opensource.org/lic ; https?://(?:www\.)?opensource\.org/licenses?/isc
artistic ; opensource.org/lic ; https?://(?:www\.)?opensource\.org/licenses?/artistic-(?:license-)?\d\.\d
cddl ; opensource.org/lic ; https?://(?:www\.)?opensource\.org/licenses?/cddl-?1?
epl ; eclipse.org/ ; https?://(?:www\.)?eclipse\.org/(?:legal/epl|org/documents/epl)-(?:v10|2\.0)(?:\.\w{2,5})?
bsl-1.0 ; boost.org/lic ; https?://(?:www\.)?boost\.org/license_1_0\.txt
unlicense ; unlicense.org ; https?://(?:www\.)?unlicense\.org/?
wtfpl ; wtfpl.net ; https?://(?:www\.)?wtfpl\.net/?(?:txt/copying/?)?
cc0-1.0 ; creativecommons.org ; https?://creativecommons\.org/publicdomain/zero/1\.0/?
cc-publicdomain ; creativecommons.org ; https?://creativecommons\.org/publicdomain/mark/1\.0/?
cc-by-nc-nd ; creativecommons.org ; https?://creativecommons\.org/licenses/by-nc-nd/\d\.\d/?
cc-by-nc-sa ; creativecommons.org ; https?://creativecommons\.org/licenses/by-nc-sa/\d\.\d/?
cc-by-nc ; creativecommons.org ; https?://creativecommons\.org/licenses/by-nc/\d\.\d/?
cc-by-nd ; creativecommons.org ; https?://creativecommons\.org/licenses/by-nd/\d\.\d/?
cc-by-sa ; creativecommons.org ; https?://creativecommons\.org/licenses/by-sa/\d\.\d/?
cc-by ; creativecommons.org ; https?://creativecommons\.org/licenses/by/\d\.\d/?
ofl-1.1 ; scripts.sil.org ; https?://scripts\.sil\.org/ofl
odbl-1.0 ; opendatacommons ; https?://(?:www\.)?opendatacommons\.org/licenses/odbl(?:/\d-\d)?/?
odc-by ; opendatacommons ; https?://(?:www\.)?opendatacommons\.org/licenses/by(?:/\d-\d)?/?
pddl ; opendatacommons ; https?://(?:www\.)?opendatacommons\.org/licenses/pddl(?:/\d-\d)?/?
eupl ; joinup.ec ; https?://joinup\.ec\.europa\.eu/.{0,60}eupl
python-2.0 ; python.org ; https?://(?:www\.)?python\.org/(?:psf/license|download/releases/[\d.]{3,6}/license)/?
zlib ; zlib.net ; https?://(?:www\.)?zlib\.net/zlib_license\.html
"""

#: Names of licences in running text.
NAMES = r"""
mit ; mit license ; (?:released|licensed|distributed|available|covered) under (?:the )?(?:terms of the )?mit license
mit ; mit license ; \bmit licensed?\b
mit ; mit-licen ; \bmit-licen[cs]ed\b
mit ; expat license ; \bexpat license\b
x11 ; x11 license ; \b(?:mit/)?x11 license\b
apache-2.0 ; apache ; \bapache(?: software)?(?: license)?,? ?(?:version |v\.? ?)?2(?:\.0)?(?: license)?\b
apache ; apache license ; \bapache (?:software )?license\b
asl-2.0 ; asl ; \basl ?2\.0\b
gpl-3.0-or-later ; gpl ; \bgpl ?v?3(?:\.0)?(?:\+| or later)
gpl-2.0-or-later ; gpl ; \bgpl ?v?2(?:\.0)?(?:\+| or later)
gpl-3.0 ; gpl ; \bgpl[ -]?v?3(?:\.0)?\b
gpl-2.0 ; gpl ; \bgpl[ -]?v?2(?:\.0)?\b
gpl ; gpl ; \b(?:gnu )?gpl(?: license| licensed|'d)?\b
gpl ; general public license ; \bgeneral public license\b
lgpl-3.0 ; lgpl ; \blgpl[ -]?v?3(?:\.0)?\+?
lgpl-2.1 ; lgpl ; \blgpl[ -]?v?2\.1\+?
lgpl ; lgpl ; \blgpl\b
agpl-3.0 ; agpl ; \bagpl[ -]?v?3(?:\.0)?\+?
agpl ; agpl ; \bagpl\b
bsd-2-clause ; bsd ; \b(?:2|two)[- ]clause bsd\b
bsd-3-clause ; bsd ; \b(?:3|three)[- ]clause bsd\b
bsd-4-clause ; bsd ; \b(?:4|four)[- ]clause bsd\b
bsd-2-clause ; bsd ; \b(?:simplified|freebsd) bsd license\b
bsd-3-clause ; bsd ; \b(?:new|modified|revised) bsd license\b
bsd-4-clause ; bsd ; \b(?:original|old) bsd license\b
bsd ; bsd ; \bbsd(?:-style)? licen[cs]ed?\b
isc ; isc license ; \bisc license\b
mpl-2.0 ; mpl ; \bmpl[ -]?v?2(?:\.0)?\b
mpl-1.1 ; mpl ; \bmpl[ -]?v?1\.1\b
mpl ; mozilla public license ; \bmozilla public license\b
epl ; eclipse public license ; \beclipse public license\b
cddl ; cddl ; \bcddl(?:[ -]?v?1\.[01])?\b
bsl-1.0 ; boost ; \bboost (?:software )?license\b
zlib ; zlib license ; \bzlib(?:/libpng)? license\b
libpng ; libpng license ; \blibpng license\b
curl ; curl license ; \bcurl license\b
ncsa ; ncsa license ; \bncsa license\b
php ; php license ; \bphp license\b
ruby ; ruby license ; \bruby license\b
perl ; same terms as perl ; same terms as perl(?: itself)?
vim ; vim license ; \bvim license\b
unlicense ; the unlicense ; \bthe unlicense\b
wtfpl ; wtfpl ; \bwtfpl\b
cc0-1.0 ; cc0 ; \bcc0(?:[- ]1\.0)?\b
odbl-1.0 ; odbl ; \bodbl(?:[- ]v?1\.0)?\b
sspl-1.0 ; sspl ; \bsspl\b
busl-1.1 ; busl ; \bbusl\b
ofl ; open font license ; \bopen font license\b
lppl ; latex project ; \blatex project public license(?:,? version 1\.3[abc]?)?
osl-3.0 ; open software license ; \bopen software license(?:,? (?:version|v\.?) ?3\.0)?
afl-3.0 ; academic free ; \bacademic free license(?:,? (?:version|v\.?) ?3\.0)?
ecl-2.0 ; educational community ; \beducational community license(?:,? version 2\.0)?
qpl ; q public license ; \bq public license(?: version 1\.0)?
ipl ; ibm public license ; \bibm public license(?:,? version 1\.0)?
apsl ; apple public source ; \bapple public source license(?: (?:version )?[12]\.\d)?
nasa ; nasa open source ; \bnasa open source agreement(?: version 1\.3)?
mulanpsl ; mulan ; \bmulan (?:permissive software|psl)(?: license)?(?:,? v?[12])?
"""

#: Statements of rights that name no licence.
RIGHTS = r"""
all-rights-reserved ; all rights reserved ; \ball rights reserved\b
proprietary ; proprietary ; \bproprietary (?:and confidential|software|license)\b
proprietary ; confidential ; \bunauthori[sz]ed (?:copying|use|distribution) (?:of this file )?.{0,60}strictly prohibited
non-commercial ; non-commercial ; \bfor (?:personal and )?non-commercial (?:use|purposes)(?: only)?
non-commercial ; noncommercial ; \bfor noncommercial (?:use|purposes)(?: only)?
no-redistribution ; redistribut ; \bmay not be (?:copied|reproduced|redistributed|published)(?:,? (?:copied|reproduced|redistributed|published|or)){0,4}
evaluation-only ; evaluation ; \bfor (?:internal )?evaluation (?:use|purposes) only
fair-use ; fair use ; \bfair (?:use|dealing) (?:notice|act|doctrine|provisions?)
royalty-free ; royalty-free ; \broyalty-free,? (?:perpetual|worldwide|non-exclusive|irrevocable)
open-government ; open government ; \bopen government licen[cs]e(?: v?[123]\.0)?
crown-copyright ; crown copyright ; \bcrown copyright\b
copyright-notice ; copyright ; \bcopyright (?:\(c\)|©)? ?(?:19|20)\d\d(?:\s?[-,]\s?(?:19|20)\d\d)?
copyright-notice ; © ; © ?(?:19|20)\d\d
see-license-file ; license ; \bsee (?:the )?(?:license|licence|copying)(?:\.txt|\.md)? (?:file )?for (?:details|more information|copying)
license-reference ; license ; \b(?:licensed|released|distributed) under (?:the )?(?:terms of )?(?:the |this |a )?[a-z0-9 .-]{2,40} licen[cs]e
"""

#: (family, score of a detection)
FAMILIES = ((SPDX, 1.0), (TEXTS, 0.95), (CREATIVE, 0.9), (ADDRESSES, 0.85), (NAMES, 0.7), (RIGHTS, 0.4))


#: A rule that names no licence; it ranks below its family.
GENERIC = "license-reference"


def level_ends() -> list[int]:
    """The priorities at which levels end: families in order, and the generic rule last."""
    scores = [(score, label == GENERIC) for _, label, score, *_ in rules()]
    return [i for i in range(1, len(scores) + 1) if i == len(scores) or scores[i] != scores[i - 1]]


def rules() -> list[tuple[int, str, float, str, str]]:
    """(priority, label, score, keyword, regex); a lower number goes first."""
    lines = [(score, *(x.strip() for x in line.split(" ; ", 2))) for text, score in FAMILIES for line in text.strip().split("\n")]
    return [(i, label, score, keyword, regex) for i, (score, label, keyword, regex) in enumerate(lines)]
