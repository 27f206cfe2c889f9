"""License scans: ordered signature rules behind a keyword prefilter, with priorities and interval containment.

Each license of the table gives rules for its identifier tag, its address, its name and its short name beside the word
"license"; the rules of SIGNATURES and GENERAL are written out: grants, conditions, notices, exceptions. One Aho-Corasick
pass finds the rules' keywords; only rules whose keyword occurs run their regular expression, on the whole text with A-Z
lower-cased, whose blank runs and line ends with comment marks count as one blank; places are those of the text as it
stands. Detections are taken by priority, then length, then start; one that lies inside a taken one is dropped. The time
is n log n in the detections of a text.

Base phrases (words standing one after the other) are reported besides: see BASE. Words are
[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+ after lower-casing A-Z; null and empty texts have none, no labels and score 0.
Repeated rows each get their row, an empty table gives none.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from . import common

BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Label, how the license is named in prose (regular expression), its keywords, and where it lives.
LICENSES = [
    ("apache-1.1", r"apache (?:software )?licen[cs]e,? (?:version |v\.? ?)?1\.1", "apache", r"apache\.org/licenses/license-1\.1"),
    ("apache-2.0", r"apache (?:software )?licen[cs]e,? (?:version |v\.? ?)?2(?:\.0)?", "apache", r"apache\.org/licenses/license-2\.0"),
    ("mit", r"(?:the )?mit licen[cs]e", "mit licen", r"opensource\.org/licenses/mit\b"),
    ("mit-0", r"mit no attribution", "no attribution", r"opensource\.org/licenses/mit-0"),
    ("isc", r"\bisc licen[cs]e", "isc licen", r"opensource\.org/licenses/isc"),
    ("bsd-2-clause", r"(?:bsd[ -]2[ -]clause|simplified bsd|freebsd licen[cs]e)", "bsd", r"opensource\.org/licenses/bsd-2-clause"),
    ("bsd-3-clause", r"(?:bsd[ -]3[ -]clause|(?:new|revised|modified) bsd)", "bsd", r"opensource\.org/licenses/bsd-3-clause"),
    ("bsd-4-clause", r"(?:bsd[ -]4[ -]clause|original bsd)", "bsd", r"spdx\.org/licenses/bsd-4-clause"),
    ("0bsd", r"(?:bsd zero clause|zero-clause bsd)", "bsd", r"opensource\.org/licenses/0bsd"),
    ("gpl-1.0", r"(?:gnu )?general public licen[cs]e,? (?:version |v\.? ?)1(?:\.0)?\b", "general public", r"gnu\.org/licenses/gpl-1\.0"),
    ("gpl-2.0", r"(?:gnu )?general public licen[cs]e,? (?:version |v\.? ?)2(?:\.0)?\b", "general public", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gpl-3.0", r"(?:gnu )?general public licen[cs]e,? (?:version |v\.? ?)3(?:\.0)?\b", "general public", r"gnu\.org/licenses/gpl-3\.0"),
    ("lgpl-2.0", r"(?:gnu )?library general public licen[cs]e", "library general", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.0"),
    ("lgpl-2.1", r"(?:gnu )?lesser general public licen[cs]e,? (?:version |v\.? ?)2\.1", "lesser general", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("lgpl-3.0", r"(?:gnu )?lesser general public licen[cs]e,? (?:version |v\.? ?)3(?:\.0)?\b", "lesser general", r"gnu\.org/licenses/lgpl-3\.0"),
    ("agpl-3.0", r"(?:gnu )?affero general public licen[cs]e", "affero", r"gnu\.org/licenses/agpl-3\.0"),
    ("gfdl-1.1", r"(?:gnu )?free documentation licen[cs]e,? (?:version |v\.? ?)1\.1", "free documentation", r"gnu\.org/licenses/(?:old-licenses/)?fdl-1\.1"),
    ("gfdl-1.2", r"(?:gnu )?free documentation licen[cs]e,? (?:version |v\.? ?)1\.2", "free documentation", r"gnu\.org/licenses/(?:old-licenses/)?fdl-1\.2"),
    ("gfdl-1.3", r"(?:gnu )?free documentation licen[cs]e,? (?:version |v\.? ?)1\.3", "free documentation", r"gnu\.org/licenses/fdl-1\.3"),
    ("mpl-1.0", r"mozilla public licen[cs]e,? (?:version |v\.? ?)1\.0", "mozilla public", r"mozilla\.org/mpl/1\.0"),
    ("mpl-1.1", r"mozilla public licen[cs]e,? (?:version |v\.? ?)1\.1", "mozilla public", r"mozilla\.org/mpl/1\.1"),
    ("mpl-2.0", r"mozilla public licen[cs]e,? (?:version |v\.? ?)2(?:\.0)?", "mozilla public", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("epl-1.0", r"eclipse public licen[cs]e,? (?:version |v\.? ?|- ?v ?)?1\.0", "eclipse public", r"eclipse\.org/legal/epl-v10"),
    ("epl-2.0", r"eclipse public licen[cs]e,? (?:version |v\.? ?|- ?v ?)?2\.0", "eclipse public", r"eclipse\.org/legal/epl-2\.0"),
    ("cddl-1.0", r"common development and distribution licen[cs]e,? (?:version |v\.? ?)?1\.0", "common development", r"opensource\.org/licenses/cddl-1\.0"),
    ("cddl-1.1", r"common development and distribution licen[cs]e,? (?:version |v\.? ?)?1\.1", "common development", r"spdx\.org/licenses/cddl-1\.1"),
    ("cpl-1.0", r"common public licen[cs]e,? (?:version |v\.? ?)?1\.0", "common public", r"opensource\.org/licenses/cpl1\.0"),
    ("ipl-1.0", r"ibm public licen[cs]e", "ibm public", r"opensource\.org/licenses/ibmpl"),
    ("eupl-1.1", r"european union public licen[cs]e,? (?:version |v\.? ?)?1\.1", "european union public", r"spdx\.org/licenses/eupl-1\.1"),
    ("eupl-1.2", r"european union public licen[cs]e,? (?:version |v\.? ?)?1\.2", "european union public", r"spdx\.org/licenses/eupl-1\.2"),
    ("artistic-1.0", r"artistic licen[cs]e,? (?:version |v\.? ?)?1\.0", "artistic licen", r"opensource\.org/licenses/artistic-1\.0"),
    ("artistic-2.0", r"artistic licen[cs]e,? (?:version |v\.? ?)?2\.0", "artistic licen", r"opensource\.org/licenses/artistic-2\.0"),
    ("bsl-1.0", r"boost software licen[cs]e", "boost software", r"boost\.org/license_1_0"),
    ("busl-1.1", r"business source licen[cs]e", "business source", r"mariadb\.com/bsl11"),
    ("sspl-1.0", r"server side public licen[cs]e", "server side public", r"mongodb\.com/licensing/server-side-public-license"),
    ("zlib", r"\bzlib(?:/libpng)? licen[cs]e", "zlib", r"opensource\.org/licenses/zlib"),
    ("libpng", r"\blibpng licen[cs]e", "libpng", r"spdx\.org/licenses/libpng"),
    ("unlicense", r"\b(?:the unlicense|free and unencumbered software released into the public domain)", "unlicense|unencumbered", r"unlicense\.org"),
    ("wtfpl", r"do what the f\S* you want to public licen[cs]e", "you want to public", r"wtfpl\.net"),
    ("cc0-1.0", r"(?:cc0|creative commons zero)(?: 1\.0)?(?: universal)?", "cc0|creative commons zero", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("psf-2.0", r"python software foundation licen[cs]e", "python software", r"python\.org/psf/license"),
    ("postgresql", r"postgresql licen[cs]e", "postgresql licen", r"opensource\.org/licenses/postgresql"),
    ("php-3.01", r"php licen[cs]e,? (?:version |v\.? ?)?3\.01", "php licen", r"php\.net/license/3_01"),
    ("ruby", r"ruby(?:'s)? licen[cs]e", "ruby", r"ruby-lang\.org/en/about/license"),
    ("openssl", r"openssl licen[cs]e", "openssl licen", r"openssl\.org/source/license"),
    ("x11", r"\bx11 licen[cs]e", "x11 licen", r"spdx\.org/licenses/x11"),
    ("ofl-1.1", r"(?:sil )?open font licen[cs]e", "open font", r"scripts\.sil\.org/ofl"),
    ("ncsa", r"university of illinois/ncsa open source licen[cs]e", "ncsa", r"opensource\.org/licenses/ncsa"),
    ("ms-pl", r"microsoft public licen[cs]e", "microsoft public", r"opensource\.org/licenses/ms-pl"),
    ("ms-rl", r"microsoft reciprocal licen[cs]e", "microsoft reciprocal", r"opensource\.org/licenses/ms-rl"),
    ("osl-3.0", r"open software licen[cs]e,? (?:version |v\.? ?)?3\.0", "open software licen", r"opensource\.org/licenses/osl-3\.0"),
    ("afl-3.0", r"academic free licen[cs]e", "academic free", r"opensource\.org/licenses/afl-3\.0"),
    ("odbl-1.0", r"open database licen[cs]e", "open database", r"opendatacommons\.org/licenses/odbl"),
    ("odc-by-1.0", r"open data commons attribution licen[cs]e", "open data commons", r"opendatacommons\.org/licenses/by"),
    ("pddl-1.0", r"public domain dedication and licen[cs]e", "public domain dedication", r"opendatacommons\.org/licenses/pddl"),
    ("upl-1.0", r"universal permissive licen[cs]e", "universal permissive", r"opensource\.org/licenses/upl"),
    ("vim", r"\bvim licen[cs]e", "vim licen", r"spdx\.org/licenses/vim"),
    ("w3c", r"w3c software (?:notice and )?licen[cs]e", "w3c software", r"w3\.org/consortium/legal/.{0,60}copyright-software"),
    ("qpl-1.0", r"\bq public licen[cs]e", "q public", r"opensource\.org/licenses/qpl-1\.0"),
    ("rail", r"(?:responsible ai|open rail(?:-m)?) licen[cs]e", "rail|responsible ai", r"licenses\.ai"),
]
#: The parts of a Creative Commons license, and its versions.
CC_PARTS, CC_VERSIONS = ("by", "by-sa", "by-nd", "by-nc", "by-nc-sa", "by-nc-nd"), ("1.0", "2.0", "2.5", "3.0", "4.0")
CC_WORDS = {"by": "attribution", "sa": "share[- ]?alike", "nd": "no[- ]?deriv(?:ative)?s?", "nc": "non[- ]?commercial"}
#: Rules that stand for no single license: label, expression, keyword, priority, weight.
GENERAL = [
    ("gpl", r"\b(?:gnu )?general public licen[cs]e", "general public", 60, 0.9),
    ("lgpl", r"\b(?:gnu )?lesser general public licen[cs]e", "lesser general", 55, 0.9),
    ("apache", r"\bapache licen[cs]e", "apache", 60, 0.9),
    ("mpl", r"\bmozilla public licen[cs]e", "mozilla public", 60, 0.9),
    ("epl", r"\beclipse public licen[cs]e", "eclipse public", 60, 0.9),
    ("gfdl", r"\bfree documentation licen[cs]e", "free documentation", 60, 0.9),
    ("cc-by", r"\bcc[ -]by\b", "cc by|cc-by", 60, 0.9),
    ("creative-commons", r"\bcreative commons\b", "creative commons", 70, 0.6),
    ("reserved", r"\ball rights reserved\b", "all rights reserved", 70, 0.8),
    ("permissive-grant", r"permission is hereby granted, free of charge", "hereby granted", 40, 0.9),
    ("bsd-grant", r"redistribution and use in source and binary forms", "redistribution and use", 40, 0.9),
    ("warranty", r"the software is provided \"?as is\"?", "as is", 80, 0.4),
    ("copyright-line", r"(?:copyright|\(c\)|©) (?:\(c\) |© )?(?:19|20)\d\d", "copyright|(c)|©", 80, 0.4),
    ("public-domain", r"\b(?:in|into|to) the public domain\b", "public domain", 70, 0.6),
    ("proprietary", r"\b(?:proprietary and confidential|no part of this (?:work|publication|document) may be)\b", "proprietary and|no part of", 50, 0.8),
    ("licensed-under", r"\blicen[cs]ed under (?:the )?\S+", "licen", 90, 0.3),
    ("terms", r"\bterms of (?:use|service)\b", "terms of", 95, 0.1),
]


#: Signatures of license texts, notices and exceptions: label, expression, keyword. Priority 40, weight 0.9.
SIGNATURES = [
    ("mit", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software", "hereby granted"),
    ("mit", r"the above copyright notice and this permission notice (?:\(including the next paragraph\) )?shall be included in all copies", "permission notice"),
    ("mit", r"without restriction, including without limitation the rights to use, copy, modify, merge, publish", "without restriction"),
    ("isc", r"permission to use, copy, modify,? and(?:/or)? distribute this software for any purpose with or without fee is hereby granted", "hereby granted"),
    ("isc", r"the software is provided \"?as is\"? and (?:the author|isc|.{1,60}) disclaims all warranties", "as is"),
    ("hpnd", r"permission to use, copy, modify,? and distribute this software and its documentation for any purpose", "its documentation"),
    ("bsd", r"redistributions of source code must retain the (?:above )?copyright notice", "redistributions of source"),
    ("bsd", r"redistributions in binary form must reproduce the (?:above )?copyright notice", "redistributions in binary"),
    ("bsd-3-clause", r"neither the names? of .{1,120}? nor the names of (?:its|their|any) contributors may be used to endorse", "may be used to endorse"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display", "advertising materials"),
    ("bsd-clear", r"no express or implied licen[cs]es to any party's patent rights are granted by this licen[cs]e", "patent rights"),
    ("bsd", r"in no event shall the (?:copyright (?:owner|holder)s?|authors?|regents) or contributors be liable", "be liable"),
    ("apache-2.0", r"licensed under the apache licen[cs]e, version 2\.0", "apache"),
    ("apache-2.0", r"you may not use this (?:file|work) except in compliance with the licen[cs]e", "in compliance with the licen"),
    ("apache-2.0", r"unless required by applicable law or agreed to in writing, software distributed under the licen[cs]e", "agreed to in writing"),
    ("apache-2.0", r"grant of patent licen[cs]e\. subject to the terms and conditions of this licen[cs]e", "grant of patent"),
    ("apache-1.1", r"this product includes software developed by the apache (?:software foundation|group)", "apache"),
    ("gpl-2.0", r"either version 2 of the licen[cs]e, or \(at your option\) any later version", "at your option"),
    ("gpl-3.0", r"either version 3 of the licen[cs]e, or \(at your option\) any later version", "at your option"),
    ("lgpl-2.1", r"either version 2\.1 of the licen[cs]e, or \(at your option\) any later version", "at your option"),
    ("gpl", r"it under the terms of the gnu general public licen[cs]e as published by the free software foundation", "free software foundation"),
    ("gpl", r"this program is free software[:;,] you can redistribute it and/or modify", "free software"),
    ("gpl", r"without even the implied warranty of merchantability or fitness for a particular purpose", "implied warranty"),
    ("gpl", r"you should have received a copy of the gnu general public licen[cs]e", "have received a copy"),
    ("lgpl", r"you should have received a copy of the gnu (?:lesser|library) general public licen[cs]e", "have received a copy"),
    ("lgpl", r"this library is free software[:;,] you can redistribute it and/or", "this library is free"),
    ("agpl-3.0", r"you should have received a copy of the gnu affero general public licen[cs]e", "affero"),
    ("agpl-3.0", r"remote network interaction; use with the gnu general public licen[cs]e", "remote network interaction"),
    ("gpl-2.0", r"version 2 of the licen[cs]e (?:only|and no later version)", "version 2 of the licen"),
    ("gpl", r"distributed under the terms of the gpl", "terms of the gpl"),
    ("gpl-3.0", r"installation information\W{0,2} for a user product means any methods", "user product"),
    ("gfdl", r"permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation", "modify this document"),
    ("gfdl", r"with no invariant sections, (?:with )?no front-cover texts,? and (?:with )?no back-cover texts", "invariant sections"),
    ("mpl-2.0", r"this source code form is subject to the terms of the mozilla public licen[cs]e,? v\. ?2\.0", "mozilla public"),
    ("mpl-2.0", r"if a copy of the mpl was not distributed with this file", "copy of the mpl"),
    ("mpl-1.1", r"the contents of this file are subject to the mozilla public licen[cs]e version 1\.1", "mozilla public"),
    ("mpl-2.0", r"incompatible with secondary licen[cs]es", "secondary licen"),
    ("cddl-1.0", r"the contents of this file are subject to the terms of the common development and distribution licen[cs]e", "common development"),
    ("epl-2.0", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e 2\.0", "accompanying materials"),
    ("epl-1.0", r"this program and the accompanying materials are made available under the terms of the eclipse public licen[cs]e v1\.0", "accompanying materials"),
    ("edl-1.0", r"eclipse distribution licen[cs]e (?:v\.? ?|version )1\.0", "eclipse distribution"),
    ("bsl-1.0", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software and accompanying documentation", "person or organization"),
    ("bsl-1.0", r"distributed under the boost software licen[cs]e, version 1\.0", "boost software"),
    ("zlib", r"this software is provided '?as-is'?, without any express or implied warranty", "as-is"),
    ("zlib", r"the origin of this software must not be misrepresented", "must not be misrepresented"),
    ("zlib", r"altered source versions must be plainly marked as such", "altered source versions"),
    ("unlicense", r"anyone is free to copy, modify, publish, use, compile, sell, or distribute this software", "anyone is free to copy"),
    ("unlicense", r"dedicate any and all copyright interest in the software to the public domain", "copyright interest"),
    ("wtfpl", r"everyone is permitted to copy and distribute verbatim or modified copies of this licen[cs]e document", "verbatim or modified"),
    ("wtfpl", r"you just do what the f\S{1,6} you want to", "you just do"),
    ("gpl", r"everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document, but changing it is not allowed", "verbatim copies"),
    ("cc0-1.0", r"the person who associated a work with this deed has dedicated the work to the public domain", "this deed"),
    ("cc0-1.0", r"waived all (?:of )?(?:his or her|their) rights to the work worldwide under copyright law", "rights to the work"),
    ("cc-by", r"this work is licensed under (?:a|the) creative commons attribution (?:\d\.\d )?(?:international )?licen[cs]e", "creative commons"),
    ("cc-by-sa", r"if you remix, transform, or build upon the material, you must distribute your contributions under the same licen[cs]e", "build upon the material"),
    ("cc-by-nc", r"you may not use the material for commercial purposes", "use the material"),
    ("cc-by-nd", r"if you remix, transform, or build upon the material, you may not distribute the modified material", "build upon the material"),
    ("cc-by", r"you must give appropriate credit, provide a link to the licen[cs]e, and indicate if changes were made", "appropriate credit"),
    ("cc-sampling", r"creative commons sampling plus", "creative commons"),
    ("artistic-2.0", r"everyone is permitted to copy and distribute verbatim copies of this licen[cs]e document.{0,80}artistic", "verbatim copies"),
    ("artistic-1.0", r"the intent of this document is to state the conditions under which a package may be copied", "intent of this document"),
    ("perl", r"(?:free software[,;:] )?you can redistribute it and/or modify it under the same terms as perl itself", "as perl itself"),
    ("ofl-1.1", r"this font software is licensed under the sil open font licen[cs]e", "font software"),
    ("ofl-1.1", r"neither the font software nor any of its individual components.{0,80}may be sold by itself", "font software"),
    ("openssl", r"this product includes software developed by the openssl project", "openssl project"),
    ("openssl", r"this product includes cryptographic software written by eric young", "cryptographic software"),
    ("php-3.01", r"this product includes php software, freely available from", "php software"),
    ("psf-2.0", r"psf is making python available to licensee on an \"?as is\"? basis", "python available to licensee"),
    ("w3c", r"permission to copy, modify,? and distribute this software and its documentation, with or without modification, for any purpose", "with or without modification"),
    ("x11", r"except as contained in this notice, the name of .{1,80}? shall not be used in advertising", "except as contained in this notice"),
    ("ncsa", r"permission is hereby granted, free of charge.{0,200}to deal with the software without restriction", "deal with the software"),
    ("json", r"the software shall be used for good, not evil", "not evil"),
    ("beerware", r"if we meet some day, and you think this stuff is worth it, you can buy me a beer", "buy me a beer"),
    ("fsful", r"this (?:file|configure script) is free software; the free software foundation gives unlimited permission", "unlimited permission"),
    ("fsfap", r"copying and distribution of this file, with or without modification, are permitted in any medium without royalty", "without royalty"),
    ("ijg", r"this software is based in part on the work of the independent jpeg group", "independent jpeg"),
    ("curl", r"permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice", "with or without fee"),
    ("sleepycat", r"redistributions in any form must be accompanied by information on how to obtain complete source code", "obtain complete source"),
    ("busl-1.1", r"the licensor hereby grants you the right to copy, modify, create derivative works, redistribute, and make non-production use", "non-production use"),
    ("busl-1.1", r"effective on the change date, or the fourth anniversary", "change date"),
    ("sspl-1.0", r"if you make the functionality of the program or a modified version available to third parties as a service", "to third parties as a service"),
    ("elastic-2.0", r"you may not provide the software to third parties as a hosted or managed service", "hosted or managed service"),
    ("commons-clause", r"the licen[cs]e does not grant to you, the right to sell the software", "right to sell the software"),
    ("polyform", r"polyform (?:noncommercial|small business|shield|strict|perimeter) licen[cs]e", "polyform"),
    ("prosperity", r"the prosperity public licen[cs]e", "prosperity public"),
    ("parity", r"the parity public licen[cs]e", "parity public"),
    ("blue-oak", r"blue oak model licen[cs]e", "blue oak"),
    ("mulan-2.0", r"mulan psl ?v2|mulan permissive software licen[cs]e", "mulan"),
    ("cecill", r"cecill(?:-[bc])? (?:free software )?licen[cs]e", "cecill"),
    ("etalab-2.0", r"licence ouverte|etalab open licen[cs]e", "licence ouverte|etalab"),
    ("ogl-uk-3.0", r"open government licen[cs]e", "open government"),
    ("llama", r"llama \d(?:\.\d)? community licen[cs]e", "community licen"),
    ("gemma", r"gemma terms of use", "gemma"),
    ("rail", r"use restrictions\W{0,40}referenced in (?:paragraph|section) 5", "use restrictions"),
    ("jrl", r"java research licen[cs]e", "java research"),
    ("aladdin", r"aladdin free public licen[cs]e", "aladdin free"),
    ("apsl-2.0", r"apple public source licen[cs]e", "apple public source"),
    ("lppl-1.3c", r"latex project public licen[cs]e", "latex project"),
    ("naist", r"naist.{0,40}licen[cs]e", "naist"),
    ("tcl", r"the authors hereby grant permission to use, copy, modify, distribute, and licen[cs]e this software", "authors hereby grant"),
    ("ntp", r"permission to use, copy, modify, and distribute this software and its documentation for any purpose with or without fee", "its documentation"),
    ("icu", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation.{0,300}appear in supporting documentation", "supporting documentation"),
    ("unicode", r"unicode,? inc\.? licen[cs]e agreement", "unicode"),
    ("sissl", r"sun industry standards source licen[cs]e", "sun industry"),
    ("watcom", r"sybase open watcom public licen[cs]e", "watcom"),
    ("zpl-2.1", r"zope public licen[cs]e", "zope public"),
    ("ecl-2.0", r"educational community licen[cs]e", "educational community"),
    ("euDatagrid", r"eu datagrid software licen[cs]e", "datagrid"),
    ("mirOS", r"provided that these terms and disclaimer and all copyright notices are retained", "terms and disclaimer"),
    ("classpath-exception", r"as a special exception, the copyright holders of this library give you permission to link this library with independent modules", "independent modules"),
    ("classpath-exception", r"linking this library statically or dynamically with other modules is making a combined work", "combined work"),
    ("gcc-exception", r"gcc runtime library exception", "runtime library exception"),
    ("autoconf-exception", r"as a special exception to the gnu general public licen[cs]e, if you distribute this file as part of a program that contains a configuration script generated by autoconf", "generated by autoconf"),
    ("bison-exception", r"as a special exception, you may create a larger work that contains part or all of the bison parser skeleton", "bison parser"),
    ("font-exception", r"if you create a document which uses this font, and embed this font", "embed this font"),
    ("openssl-exception", r"permission to link the code of portions of this program with the openssl library", "openssl library"),
    ("llvm-exception", r"llvm exceptions to the apache 2\.0 licen[cs]e|apache-2\.0 with llvm-exception", "llvm"),
    ("linking-exception", r"as a special exception, if other files instantiate templates or use macros", "special exception"),
    ("syscall-exception", r"this copyright does \*?not\*? cover user programs that use kernel services by normal system calls", "kernel services"),
    ("ubuntu-font", r"ubuntu font licen[cs]e", "ubuntu font"),
    ("proprietary", r"unauthorized copying of this file,? via any medium,? is strictly prohibited", "strictly prohibited"),
    ("proprietary", r"this (?:software|program|document) (?:is|contains) (?:the )?(?:confidential|proprietary) (?:and proprietary )?(?:information|property) of", "confidential|proprietary"),
    ("proprietary", r"may not be reproduced,? (?:or )?(?:distributed|transmitted)[^.]{0,80}without (?:the )?(?:prior )?written permission", "written permission"),
    ("no-commercial", r"(?:for|only for) (?:personal,? )?non-?commercial (?:and educational )?(?:use|purposes)(?: only)?", "commercial"),
    ("no-training", r"may not be used (?:to train|for (?:the )?training of) (?:machine learning|artificial intelligence|ai) (?:models?|systems?)", "may not be used"),
    ("editorial", r"this article is (?:published|distributed|made available) under (?:a|the) (?:creative commons|cc)", "this article is"),
    ("free-use", r"(?:this|the) (?:text|work|image|article) may be (?:freely )?(?:copied|reproduced|redistributed) (?:freely|without (?:charge|restriction))", "may be freely|may be copied|may be reproduced|may be redistributed"),
]


def rules() -> list[tuple[int, str, str, str, float]]:
    """(priority, label, expression, keywords, weight), in order: tags 10, addresses 20, names 30, short names 50, general."""
    out = []
    for label, name, keyword, url in LICENSES:
        tag = re.escape(label)
        out.append((10, label, rf"spdx-license-identifier:\s*{tag}(?:-only|-or-later|\+)?\b", "spdx-license-identifier", 1.0))
        out.append((20, label, url, re.split(r"\\\.|[(\\]", url)[0][:12], 0.95))
        out.append((30, label, name, keyword, 0.9))
        out.append((50, label, rf"\b{tag} licen[cs]ed?\b|\blicen[cs]ed? (?:under )?(?:the )?{tag}\b", "|".join(f"{x} {label}" for x in ("license", "licence", "licensed", "licenced", "under", "the")) + f"|{label} licen", 0.7))
    for parts in CC_PARTS:
        words = r"[- ]".join(CC_WORDS[p] for p in parts.split("-"))
        for version in CC_VERSIONS:
            label, v = f"cc-{parts}-{version}", re.escape(version)
            out.append((10, label, rf"spdx-license-identifier:\s*cc-{parts}-{v}\b", "spdx-license-identifier", 1.0))
            out.append((20, label, rf"creativecommons\.org/licenses/{parts}/{v}", "creativecommons", 0.95))
            out.append((25, label, rf"\bcc[ -]{parts.replace('-', '[ -]')}[ -]v?{v}", "cc by|cc-by", 0.9))
            out.append((30, label, rf"creative commons {words} (?:licen[cs]e )?{v}", "creative commons", 0.9))
    out += [(40, label, expr, keyword, 0.9) for label, expr, keyword in SIGNATURES]
    out += [(priority, label, expr, keyword, weight) for label, expr, keyword, priority, weight in GENERAL]
    return sorted(out, key=lambda r: r[0])


#: What counts as one blank: a line end with the comment marks around it, and other runs of blanks but a lone space.
_BREAK = re.compile(r"(?=\s)(?:(?:[^\S\r\n]+(?:[*#/|%;]+|-->))?[^\S\r\n]*[\r\n](?:\s|[*#/;%>|!]|--|<!|(?:dnl|rem)\s)*|\s{2,}|[^\S ])")


def folded(text: str) -> tuple[str, Callable[[int], int]]:
    """The text with each _BREAK as one blank, and the place in the text of each place in that."""
    parts, at, size, after, gone = [], 0, 0, [0], [0]
    for m in _BREAK.finditer(text):
        parts += (text[at : m.start()], " ")
        size += m.start() - at + 1
        at = m.end()
        after.append(size)
        gone.append(at - size)
    if not parts:
        return text, lambda i: i
    return "".join(parts) + text[at:], lambda i: i + gone[bisect_right(after, i) - 1]


class Scanner:
    def __init__(self):
        self.rules = [(p, label, re.compile(expr), weight) for p, label, expr, _, weight in rules()]
        by_keyword: dict[str, list[int]] = {}
        for i, r in enumerate(rules()):
            for keyword in r[3].split("|"):
                by_keyword.setdefault(keyword, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for k, own in by_keyword.items():
            self.automaton.add_word(k, own)
        self.automaton.make_automaton()

    def detections(self, text: str) -> list[tuple[int, int, str, float]]:
        """Kept (start, end, label, weight) of a text with A-Z lower-cased, by start."""
        text, place = folded(text)
        todo: set[int] = set()
        for _, own in self.automaton.iter(text):
            todo.update(own)
        found = []
        for i in sorted(todo):
            priority, label, expr, weight = self.rules[i]
            found += [(priority, -(m.end() - m.start()), m.start(), m.end(), label, weight) for m in expr.finditer(text) if m.end() > m.start()]
        kept: list[tuple[int, int, str, float]] = []
        best_end = _Cover([x[2] for x in found])
        for _, _, start, end, label, weight in sorted(found):
            if not best_end.covers(start, end):
                best_end.add(start, end)
                kept.append((start, end, label, weight))
        return sorted((place(start), place(end - 1) + 1, label, weight) for start, end, label, weight in kept)


class _Cover:
    """Whether an interval lies inside one taken before: greatest ends over starts up to a place, as a tree of partial maxima."""

    def __init__(self, starts: list[int]):
        self.starts = sorted(set(starts))
        self.reach = [-1] * (len(self.starts) + 1)

    def covers(self, start: int, end: int) -> bool:
        i = bisect_right(self.starts, start)
        while i:
            if self.reach[i] >= end:
                return True
            i &= i - 1
        return False

    def add(self, start: int, end: int) -> None:
        i = bisect_right(self.starts, start)
        while i < len(self.reach):
            self.reach[i] = max(self.reach[i], end)
            i += i & -i


_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))


def lowered(text: str | None) -> str:
    """The text with A-Z, and only those, in lower case."""
    return (text or "").encode().translate(_LOWER).decode()


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """(first word, label) of each base phrase."""
    line, out = b" " + b" ".join(words) + b" ", []
    for phrase, label in BASE.items():
        want = b" " + phrase.encode() + b" "
        at, before, word = line.find(want), 0, 0
        while at >= 0:
            word += line.count(b" ", before, at)
            before = at
            out.append((word, label))
            at = line.find(want, at + 1)
    return out


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, detections; one narrow pass."""

    def start():
        scanner = common.resident(("licenses",), Scanner)

        def step(b: pa.RecordBatch):
            cols = [[] for _ in range(8)]
            for text in b.column(1).to_pylist():
                words = common.word_bytes(text)
                places = base_places(words)
                found = scanner.detections(lowered(text))
                base = {label for _, label in places}
                weight = dict.fromkeys(sorted(base), 0.8)
                for x in found:
                    weight[x[2]] = max(x[3], weight.get(x[2], 0.0))
                miss = 1.0
                for label in sorted(weight):
                    miss *= 1 - weight[label]
                row = (len(words), len(places), min((p for p, _ in places), default=None), max((p for p, _ in places), default=None), ",".join(sorted(base)), ",".join(sorted(base | {x[2] for x in found})), 1 - miss, [f"{x[2]}:{x[0]}:{x[1]}" for x in found])
                for c, v in zip(cols, row, strict=True):
                    c.append(v)
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.string())]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))], ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"])

        return step

    return common.map_rows(common.id_text(docs), "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<string>", start)
