"""Signatures of license texts: grants, conditions, disclaimers and file headers, written rule by rule.

Every regex is on the lower-cased words of a text, single-spaced.  A rule is (label, priority, keyword,
regex): the keyword is part of whatever the regex matches.  Priority 4: words that only this license has;
3: words that tell the family; 2: a clause that several licenses share.
"""

from __future__ import annotations

#: Up to a dozen words that authors put in: names, years, places.
SOME = r"(?:[^ ]+ ){0,12}?"

SIGNATURES: list[tuple[str, int, str, str]] = [
    # permissive grants
    ("mit", 4, "hereby granted", rf"permission is hereby granted free of charge to any person obtaining a copy of this {SOME}software and associated documentation files {SOME}to deal in the {SOME}without restriction"),
    ("mit", 3, "hereby granted", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 3, "copyright notice", r"the above copyright notice and this permission notice (?:including the next paragraph )?shall be included in all copies or substantial portions of the"),
    ("mit-0", 4, "hereby granted", rf"permission is hereby granted free of charge to any person obtaining a copy of this {SOME}software and associated documentation files {SOME}to deal in the {SOME}without restriction including without limitation the rights to use copy modify merge publish distribute sublicen[cs]e and or sell copies of the software and to permit persons to whom the software is furnished to do so(?= the software is provided)"),
    ("x11", 4, "except as contained", rf"except as contained in this notice the names? of {SOME}shall not be used in advertising or otherwise to promote the sale"),
    ("isc", 4, "permission to use", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("0bsd", 4, "permission to use", r"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted(?= the software is provided)"),
    ("hpnd", 3, "permission to use", r"permission to use copy modify (?:and )?(?:distribute )?(?:and sell )?this software and its documentation for any purpose (?:is hereby granted )?(?:and )?without fee"),
    ("boost-1.0", 4, "any person or organization", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this licen[cs]e"),
    ("boost-1.0", 4, "machine executable object code", r"unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor"),
    ("zlib", 4, "freely", r"permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely"),
    ("zlib", 4, "misrepresented", r"the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
    ("zlib", 3, "altered source versions", r"altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ("unlicense", 4, "released into the public domain", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", 3, "anyone is free to copy", r"anyone is free to copy modify publish use compile sell or distribute this software"),
    ("wtfpl", 4, "fuck", r"do what the fuck you want to(?: public licen[cs]e)?"),
    ("beerware", 4, "beer", r"if we meet some day and you think this stuff is worth it you can buy me a beer(?: in return)?"),
    ("beerware", 3, "beer", r"the beer ware licen[cs]e"),
    ("cc0-1.0", 4, "waiv", r"(?:has )?(?:dedicated the work to the public domain by waiving|waived? all copyright and related or neighboring rights)"),
    ("cc0-1.0", 4, "cc0", r"cc0 1 0 universal"),
    ("cc0", 3, "publicdomain", r"creativecommons org publicdomain zero"),
    ("upl-1.0", 4, "larger works", r"the larger works? as to which the licen[cs]ed contributions? (?:is|are) (?:being )?contributed"),
    ("ncsa", 4, "with the software without restriction", r"to deal with the software without restriction including without limitation the rights"),
    ("ftl", 4, "freetype", r"freetype (?:project )?licen[cs]e"),
    ("ijg", 4, "independent jpeg group", r"this software is based in part on the work of the independent jpeg group"),
    ("postgresql", 4, "written agreement", r"for any purpose without fee and without a written agreement is hereby granted"),
    ("unicode", 4, "data files", r"to any person obtaining a copy of (?:the unicode )?data files and any associated documentation"),
    ("tcl", 4, "existing copyright notices", r"provided that existing copyright notices are retained in all copies and that this notice is included verbatim in any distributions"),
    ("openssl", 4, "openssl", r"this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", 4, "eric young", r"this product includes (?:cryptographic )?software written by eric young"),
    ("python-2.0", 4, "python software foundation", r"this licen[cs]e agreement is between the python software foundation"),
    ("ruby", 4, "ruby", r"(?:you can redistribute it and or modify it under either the terms of the|(?:under|on) the same terms as) (?:the )?(?:2 clause bsdl|ruby(?: itself)?)"),
    ("perl", 4, "same terms as perl", r"(?:redistribute it and or modify it )?under the same terms as perl(?: itself)?"),
    ("vim", 4, "vim", r"vim licen[cs]e"),
    ("json", 4, "good not evil", r"the software shall be used for good not evil"),
    ("fair", 4, "usage of the works", r"usage of the works is permitted provided that this instrument is retained with the works"),
    # BSD conditions
    ("bsd", 3, "source and binary forms", r"redistribution and use (?:of this software )?in source and binary forms with or without modification (?:are|is) permitted"),
    ("bsd", 2, "source code must retain", r"redistributions? of source code must retain the (?:above )?(?:above )?copyright notice"),
    ("bsd", 2, "binary form must reproduce", r"redistributions? in binary form must reproduce the above copyright notice"),
    ("bsd-2", 4, "binary form must reproduce", r"redistributions? in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution(?= this (?:software|library|program) is provided)"),
    ("bsd-3", 4, "endorse or promote", rf"neither the names? of {SOME}(?:nor|or) (?:the )?(?:names? of )?{SOME}contributors may be used to endorse or promote products derived from this"),
    ("bsd-3", 3, "endorse or promote", rf"the names? (?:of )?{SOME}may not be used to endorse or promote products derived from this software"),
    ("bsd-4", 4, "advertising materials", r"all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-3-clear", 4, "patent rights", r"no express or implied licen[cs]es to any party s patent rights are granted by this licen[cs]e"),
    ("bsd-1", 4, "source code must retain", r"redistributions? of source code must retain the above copyright notice this list of conditions and the following disclaimer(?= this software is provided)"),
    ("apache-1.1", 4, "apache", r"this product includes software developed by the apache software foundation"),
    ("bsd", 2, "regents", r"this software is provided by the regents and contributors as is"),
    # Apache
    ("apache-2.0", 4, "apache licen", r"licen[cs]ed under the apache licen[cs]e version 2 0 (?:the licen[cs]e )?you may not use this file except in compliance with the licen[cs]e"),
    ("apache-2.0", 4, "apache org licenses", r"(?:http |https )?(?:www )?apache org licenses license 2 0(?: txt| html)?"),
    ("apache-2.0", 4, "apache licen", r"apache licen[cs]e version 2 0 january 2004"),
    ("apache-2.0", 3, "contributor license agreements", r"licen[cs]ed to the apache software foundation asf under one or more contributor licen[cs]e agreements"),
    ("apache-2.0", 3, "compliance with the licen", r"you may not use this file except in compliance with the licen[cs]e you may obtain a copy of the licen[cs]e at"),
    ("apache-2.0", 3, "perpetual worldwide", r"each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright licen[cs]e"),
    ("llvm-exception", 4, "llvm", r"apache licen[cs]e v2 0 with llvm exceptions?"),
    # Mozilla, Eclipse and other file-wise licenses
    ("mpl-2.0", 4, "mozilla", r"this source code form is subject to the terms of the mozilla public licen[cs]e v 2 0"),
    ("mpl-2.0", 4, "mozilla org", r"(?:https? )?(?:www )?mozilla org mpl 2 0"),
    ("mpl-2.0", 3, "incompatible with secondary", r"incompatible with secondary licen[cs]es"),
    ("mpl-1.1", 4, "mozilla", r"the contents of this file are subject to the mozilla public licen[cs]e version 1 1"),
    ("mpl-1.0", 4, "mozilla", r"the contents of this file are subject to the mozilla public licen[cs]e version 1 0"),
    ("npl-1.1", 4, "netscape", r"the contents of this file are subject to the netscape public licen[cs]e version 1 1"),
    ("epl-2.0", 4, "eclipse", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e (?:v |version )?2 0"),
    ("epl-1.0", 4, "eclipse", r"(?:this program and the accompanying materials are made available|all rights reserved this program and the accompanying materials are made available) under the terms of the eclipse public licen[cs]e v1 0"),
    ("edl-1.0", 4, "eclipse distribution", r"eclipse distribution licen[cs]e v ?1 0"),
    ("cpl-1.0", 4, "common public", r"common public licen[cs]e(?: version| v)? 1 0"),
    ("ipl-1.0", 4, "ibm public", r"ibm public licen[cs]e(?: version| v)? 1 0"),
    ("cddl-1.0", 4, "common development", r"the contents of this file are subject to the terms of the common development and distribution licen[cs]e"),
    ("ms-pl", 4, "microsoft public", r"microsoft public licen[cs]e(?: ms pl)?"),
    ("ms-rl", 4, "microsoft reciprocal", r"microsoft reciprocal licen[cs]e(?: ms rl)?"),
    ("eupl-1.2", 4, "eupl", r"licen[cs]ed under the eupl(?: version)?(?: v)? ?1 2"),
    ("cecill", 4, "cecill", r"governed by the cecill(?: [bc])? licen[cs]e under french law"),
    ("ofl-1.1", 4, "open font", r"this font software is licen[cs]ed under the sil open font licen[cs]e version 1 1"),
    ("ofl-1.1", 3, "font software", r"the font software (?:modified or unmodified )?(?:in part or in whole )?must be distributed entirely under this licen[cs]e"),
    ("artistic-2.0", 4, "artistic licen", r"the artistic licen[cs]e 2 0"),
    ("qpl-1.0", 4, "q public", r"(?:the )?q public licen[cs]e(?: version)? 1 0"),
    ("lppl-1.3c", 4, "latex project public", r"latex project public licen[cs]e (?:either )?(?:version )?1 3c?"),
    ("osl-3.0", 4, "open software", r"licen[cs]ed under the open software licen[cs]e version 3 0"),
    # GNU
    ("gpl", 3, "general public", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public licen[cs]e"),
    ("lgpl", 3, "general public", r"this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public licen[cs]e"),
    ("gpl", 2, "general public", r"you should have received a copy of the gnu general public licen[cs]e along with"),
    ("lgpl", 2, "general public", r"you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e along with"),
    ("agpl", 2, "affero", r"you should have received a copy of the gnu affero general public licen[cs]e along with"),
    ("gpl-2.0", 4, "version 2 june 1991", r"gnu general public licen[cs]e version 2 june 1991"),
    ("gpl-3.0", 4, "version 3 29 june 2007", r"gnu general public licen[cs]e version 3 29 june 2007"),
    ("lgpl-2.1", 4, "version 2 1 february 1999", r"gnu lesser general public licen[cs]e version 2 1 february 1999"),
    ("lgpl-3.0", 4, "version 3 29 june 2007", r"gnu lesser general public licen[cs]e version 3 29 june 2007"),
    ("agpl-3.0", 4, "version 3 19 november 2007", r"gnu affero general public licen[cs]e version 3 19 november 2007"),
    ("agpl", 3, "remotely through a computer network", r"all users interacting with it remotely through a computer network"),
    ("gfdl", 3, "free documentation", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation licen[cs]e"),
    ("classpath-exception", 4, "statically or dynamically", r"linking this library statically or dynamically with other modules is making a combined work based on this library"),
    ("gcc-exception", 4, "gcc runtime library", r"gcc runtime library exception(?: version)?(?: 3 1)?"),
    ("autoconf-exception", 4, "configuration script", r"if you distribute this file as part of a program that contains a configuration script generated by autoconf"),
    ("all-permissive", 4, "copying and distribution", r"copying and distribution of this file with or without modification are permitted in any medium without royalty provided the copyright notice and this notice are preserved"),
    ("fsf-unlimited", 4, "unlimited permission", r"gives unlimited permission to copy and or distribute it with or without modifications as long as this notice is preserved"),
    # Creative Commons, data and model licenses
    ("cc-by-4.0", 4, "creativecommons org", r"creativecommons org licenses by 4 0"),
    ("cc-by-3.0", 4, "creativecommons org", r"creativecommons org licenses by 3 0"),
    ("cc-by-sa-4.0", 4, "creativecommons org", r"creativecommons org licenses by sa 4 0"),
    ("cc-by-sa-3.0", 4, "creativecommons org", r"creativecommons org licenses by sa 3 0"),
    ("cc-by-nc-4.0", 4, "creativecommons org", r"creativecommons org licenses by nc 4 0"),
    ("cc-by-nd-4.0", 4, "creativecommons org", r"creativecommons org licenses by nd 4 0"),
    ("cc-by-nc-sa-4.0", 4, "creativecommons org", r"creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", 4, "creativecommons org", r"creativecommons org licenses by nc nd 4 0"),
    ("cc-by-4.0", 4, "attribution 4 0", r"creative commons attribution 4 0(?: international)?(?: public)? licen[cs]e"),
    ("cc-by-sa-4.0", 4, "attribution sharealike 4 0", r"creative commons attribution sharealike 4 0(?: international)?(?: public)?(?: licen[cs]e)?"),
    ("cc-by-nc-4.0", 4, "attribution noncommercial 4 0", r"creative commons attribution noncommercial 4 0(?: international)?(?: public)?(?: licen[cs]e)?"),
    ("cc-by-sa-3.0", 4, "attribution sharealike 3 0", r"creative commons attribution sharealike 3 0(?: unported)?(?: licen[cs]e)?"),
    ("cc-by", 3, "creative commons attribution", r"creative commons attribution licen[cs]e"),
    ("odbl-1.0", 4, "opendatacommons org", r"opendatacommons org licenses odbl(?: 1 0)?"),
    ("odc-by-1.0", 4, "open data commons attribution", r"open data commons attribution licen[cs]e"),
    ("pddl-1.0", 4, "public domain dedication", r"(?:open data commons )?public domain dedication and licen[cs]e"),
    ("ogl-uk-3.0", 4, "open government", r"open government licen[cs]e v ?3 0"),
    ("openrail", 4, "rail", r"(?:creativeml )?open ?rail(?: (?:m|s|d))? licen[cs]e"),
    # source-available and proprietary
    ("sspl-1.0", 4, "server side public", r"server side public licen[cs]e(?: version)?(?: v)?(?: ?1)?"),
    ("busl-1.1", 4, "change date", rf"change date {SOME}change licen[cs]e"),
    ("elastic-2.0", 4, "elastic licen", r"elastic licen[cs]e(?: version)? 2 0"),
    ("commons-clause", 4, "commons clause", r"commons clause licen[cs]e condition"),
    ("polyform-nc-1.0", 4, "polyform noncommercial", r"polyform noncommercial licen[cs]e(?: 1 0 0)?"),
    ("proprietary", 3, "copying of this file via", r"unauthori[sz]ed copying of this file via any medium is strictly prohibited"),
    ("proprietary", 3, "trade secret", r"(?:contains|is) (?:the )?(?:confidential|proprietary) (?:and proprietary )?information (?:and|or) trade secrets? of"),
    ("proprietary", 3, "without the prior written", r"may (?:not )?be (?:reproduced|copied|distributed)(?: [^ ]+){0,12}? without the prior written (?:permission|consent)"),
    ("proprietary", 2, "end user licen", r"end user licen[cs]e agreement"),
    # disclaimers that several licenses share
    ("disclaimer", 2, "without warranty of any kind", r"the software is provided as is without warranty of any kind express or implied"),
    ("disclaimer", 2, "implied warranties", r"any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed"),
    ("disclaimer", 2, "without any warranty", r"but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("disclaimer", 2, "disclaims all warranties", r"the author disclaims all warranties with regard to this software"),
    ("disclaimer", 2, "without warranties or conditions", r"distributed on an as is basis without warranties or conditions of any kind"),
]

#: SPDX identifiers, as they stand after "SPDX-License-Identifier:"; fixed values.
SPDX = (
    "0BSD AFL-3.0 AGPL-3.0 AGPL-3.0-only AGPL-3.0-or-later Apache-1.1 Apache-2.0 Artistic-2.0 BlueOak-1.0.0 BSD-2-Clause BSD-3-Clause "
    "BSD-4-Clause BSL-1.0 BUSL-1.1 CC0-1.0 CC-BY-3.0 CC-BY-4.0 CC-BY-SA-3.0 CC-BY-SA-4.0 CC-BY-NC-4.0 CC-BY-ND-4.0 CDDL-1.0 CDDL-1.1 CECILL-2.1 "
    "CPL-1.0 curl ECL-2.0 EFL-2.0 Elastic-2.0 EPL-1.0 EPL-2.0 EUPL-1.1 EUPL-1.2 FTL GFDL-1.3 GPL-1.0 GPL-2.0 GPL-2.0-only GPL-2.0-or-later "
    "GPL-3.0 GPL-3.0-only GPL-3.0-or-later HPND ICU IJG ISC LGPL-2.0 LGPL-2.0-or-later LGPL-2.1 LGPL-2.1-only LGPL-2.1-or-later LGPL-3.0 "
    "LGPL-3.0-only LGPL-3.0-or-later Libpng LPPL-1.3c MIT MIT-0 MPL-1.1 MPL-2.0 MS-PL MS-RL MulanPSL-2.0 NCSA ODbL-1.0 OFL-1.1 OpenSSL OSL-3.0 "
    "PHP-3.01 PostgreSQL PSF-2.0 Python-2.0 QPL-1.0 Ruby SSPL-1.0 TCL Unicode-3.0 Unlicense UPL-1.0 Vim W3C WTFPL X11 Zlib ZPL-2.1"
).split()

#: The licenses of the file header that GNU's projects share, by the words before "general public license".
GNU = {"gpl": ("", (1, 2, 3)), "lgpl": ("(?:lesser|library) ", (2, "2 1", 3)), "agpl": ("affero ", (3,))}


def signatures() -> list[tuple[str, int, str, str]]:
    """All (label, priority, keyword, regex): the written ones, SPDX identifiers and GNU's file headers."""
    found = list(SIGNATURES)
    for spdx in SPDX:
        label = spdx.lower().removesuffix("-only").replace("-clause", "")
        words = spdx.lower().replace("-", " ").replace(".", " ")
        found.append((label, 4, "spdx", f"spdx licen[cs]e identifier {words}"))
    for label, (before, versions) in GNU.items():
        for version in versions:
            full = label + "-" + (str(version).replace(" ", ".") if " " in str(version) else f"{version}.0")
            digits = version if " " in str(version) else f"{version}(?: 0)?"
            head = rf"gnu {before}general public licen[cs]e (?:gpl |lgpl |agpl )?as published by the free software foundation (?:either )?version {digits}(?: of the licen[cs]e)?"
            found.append((full, 4, "general public", head))
            found.append((full + "-or-later", 4, "general public", head + r" or (?:at your option )?any later version"))
    return found
