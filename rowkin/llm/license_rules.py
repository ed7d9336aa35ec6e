"""The ordered license signatures, written by hand: label, gate word, priority, confidence and a pattern over words.

Texts are lower-cased and reduced to words between single spaces before a pattern
sees them, so "Apache License, Version 2.0" is said "apache license version 2 0".
The gate is a word that every match holds. Priorities: 1 a bare name or a general
phrase, 2 a grant or notice by name, 3 a name with its version or a single clause,
4 a sentence of a license's own text, 5 a machine-readable tag.
"""

from __future__ import annotations

#: Fixed values, one signature a line, in order: of detections of one place the earlier line wins.
SIGNATURES = """
mit | mit | 1 | 0.6 | (?:the )?mit licen[cs]e(?:s|d)?
mit | expat | 1 | 0.6 | expat licen[cs]e(?:s|d)?
mit | mit | 2 | 0.8 | (?:licensed|released|distributed|available|provided) under (?:the )?(?:terms of )?(?:the )?mit(?: licen[cs]e)?
mit | mit | 2 | 0.8 | (?:subject to|governed by|covered by) (?:the )?(?:terms of )?the mit licen[cs]e
mit | mit | 2 | 0.8 | see (?:the )?(?:license|licence|copying) (?:file )?for (?:the )?(?:full )?mit licen[cs]e
mit | spdx | 5 | 1.0 | spdx license identifier mit(?: only)?
mit | obtaining | 4 | 0.95 | permission is hereby granted free of charge to any person obtaining a copy(?: of this software(?: and associated documentation files)?)?
mit | deal | 4 | 0.9 | to deal in the software without restriction(?: including without limitation the rights to use copy modify merge publish distribute sublicense)?
mit | sublicense | 4 | 0.9 | use copy modify merge publish distribute sublicense and or sell copies of the software
mit | substantial | 4 | 0.9 | shall be included in all copies or substantial portions of the software
mit-0 | spdx | 5 | 1.0 | spdx license identifier mit 0
mit-0 | attribution | 3 | 0.9 | mit no attribution(?: licen[cs]e)?
mit-advertising | spdx | 5 | 1.0 | spdx license identifier mit advertising
mit-feh | spdx | 5 | 1.0 | spdx license identifier mit feh
mit-cmu | spdx | 5 | 1.0 | spdx license identifier mit cmu
x11 | x11 | 1 | 0.6 | (?:mit )?x11 licen[cs]e(?:s|d)?
x11 | spdx | 5 | 1.0 | spdx license identifier x11
x11 | consortium | 4 | 0.9 | except as contained in this notice the name of the x consortium shall not be used in advertising
isc | isc | 1 | 0.6 | isc licen[cs]e(?:s|d)?
isc | consortium | 1 | 0.6 | internet (?:systems|software) consortium licen[cs]e
isc | isc | 2 | 0.8 | (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?the isc(?: licen[cs]e)?
isc | spdx | 5 | 1.0 | spdx license identifier isc
isc | permission | 4 | 0.95 | permission to use copy modify and or distribute this software for any purpose(?: with or without fee is hereby granted)?
isc | disclaims | 4 | 0.85 | the author disclaims all warranties with regard to this software
isc | isc | 4 | 0.85 | in no event shall isc be liable for any special direct indirect or consequential damages
0bsd | spdx | 5 | 1.0 | spdx license identifier 0bsd
0bsd | zero | 2 | 0.8 | zero clause bsd(?: licen[cs]e)?
hpnd | spdx | 5 | 1.0 | spdx license identifier hpnd
hpnd | publicity | 4 | 0.85 | not be used in advertising or publicity pertaining to distribution of the software without specific written prior permission
bsd | bsd | 1 | 0.6 | (?:the )?bsd licen[cs]e(?:s|d)?
bsd | bsd | 1 | 0.6 | bsd style(?: licen[cs]e)?
bsd | bsd | 2 | 0.8 | (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the |a )?bsd(?: style)?(?: licen[cs]e)?
bsd | redistribution | 4 | 0.95 | redistribution and use in source and binary forms with or without modification are permitted
bsd | redistributions | 4 | 0.9 | redistributions of source code must retain the above copyright notice
bsd | redistributions | 4 | 0.9 | redistributions in binary form must reproduce the above copyright notice
bsd-2-clause | bsd | 3 | 0.9 | (?:simplified bsd|freebsd|bsd 2 clause|2 clause bsd|two clause bsd)(?: licen[cs]e)?
bsd-2-clause | spdx | 5 | 1.0 | spdx license identifier bsd 2 clause
bsd-2-clause-patent | spdx | 5 | 1.0 | spdx license identifier bsd 2 clause patent
bsd-3-clause | bsd | 3 | 0.9 | (?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd|three clause bsd)(?: licen[cs]e)?
bsd-3-clause | spdx | 5 | 1.0 | spdx license identifier bsd 3 clause
bsd-3-clause | endorse | 4 | 0.9 | may be used to endorse or promote products derived from this software without specific prior written permission
bsd-3-clause-clear | spdx | 5 | 1.0 | spdx license identifier bsd 3 clause clear
bsd-3-clause-clear | patent | 4 | 0.9 | no express or implied licenses to any party s patent rights are granted by this license
bsd-4-clause | bsd | 3 | 0.9 | (?:original bsd|old bsd|bsd 4 clause|4 clause bsd|four clause bsd)(?: licen[cs]e)?
bsd-4-clause | spdx | 5 | 1.0 | spdx license identifier bsd 4 clause
bsd-4-clause | advertising | 4 | 0.9 | all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd-source-code | spdx | 5 | 1.0 | spdx license identifier bsd source code
apache | apache | 1 | 0.6 | (?:the )?apache(?: software)? licen[cs]e(?:s|d)?
apache | asl | 1 | 0.5 | asl licen[cs]e(?:d)?
apache | apache | 2 | 0.8 | (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?apache(?: software)?(?: licen[cs]e)?
apache | foundation | 2 | 0.7 | licensed to the apache software foundation asf under one or more contributor license agreements
apache | compliance | 4 | 0.85 | you may not use this file except in compliance with the license
apache | apache | 4 | 0.85 | you may obtain a copy of the license at https? www apache org licenses
apache | conditions | 4 | 0.8 | without warranties or conditions of any kind either express or implied
apache | contributor | 4 | 0.85 | each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable (?:copyright|patent) license
apache | prominent | 4 | 0.85 | you must cause any modified files to carry prominent notices stating that you changed the files
apache | attribution | 4 | 0.85 | a readable copy of the attribution notices contained within such notice file
apache-1.0 | apache | 3 | 0.9 | apache(?: software)? licen[cs]e(?: version| v)? v?1 0
apache-1.0 | spdx | 5 | 1.0 | spdx license identifier apache 1 0
apache-1.1 | apache | 3 | 0.9 | apache(?: software)? licen[cs]e(?: version| v)? v?1 1
apache-1.1 | spdx | 5 | 1.0 | spdx license identifier apache 1 1
apache-1.1 | developed | 4 | 0.85 | this product includes software developed by the apache software foundation
apache-2.0 | apache | 3 | 0.9 | apache(?: software)?(?: licen[cs]e)?(?: version| v)? v?2(?: 0)?
apache-2.0 | apache | 3 | 0.9 | apache license version 2 0 january 2004
apache-2.0 | spdx | 5 | 1.0 | spdx license identifier apache 2 0
apache-2.0 | apache | 4 | 0.95 | www apache org licenses license 2 0
apache-2.0-llvm | llvm | 3 | 0.9 | apache license v?2 0 with llvm exceptions?
gpl | general | 1 | 0.6 | (?:the )?(?:gnu )?general public licen[cs]e(?:s|d)?
gpl | gpl | 1 | 0.6 | (?:gnu )?gpl(?: licen[cs]e)?(?:d)?
gpl | gpl | 2 | 0.8 | (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?gpl(?: licen[cs]e)?
gpl | general | 2 | 0.8 | (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?general public licen[cs]e
gpl | redistribute | 4 | 0.85 | you can redistribute it and or modify it under the terms of the gnu general public license
gpl | gnu | 4 | 0.85 | you should have received a copy of the gnu general public license
gpl | merchantability | 4 | 0.8 | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license
gpl | copyleft | 4 | 0.8 | the gnu general public license is a free copyleft license for software
gpl | freedom | 4 | 0.8 | our general public licenses are designed to make sure that you have the freedom to
gpl-1.0 | gpl | 3 | 0.9 | (?:gnu )?gpl(?: licen[cs]e)?(?: version| v)? v?1(?: 0)?(?: only| or later)?
gpl-1.0 | general | 3 | 0.9 | general public licen[cs]e(?: version| v)? v?1(?: 0)?
gpl-1.0 | spdx | 5 | 1.0 | spdx license identifier gpl 1 0(?: only| or later)?
gpl-2.0 | gpl | 3 | 0.9 | (?:gnu )?gpl(?: licen[cs]e)?(?: version| v)? v?2(?: 0)?
gpl-2.0 | gplv2 | 3 | 0.9 | gplv2(?: licen[cs]e)?
gpl-2.0 | general | 3 | 0.9 | general public licen[cs]e(?: version| v)? v?2(?: 0)?
gpl-2.0 | june | 4 | 0.95 | gnu general public license version 2 june 1991
gpl-2.0 | spdx | 5 | 1.0 | spdx license identifier gpl 2 0(?: only)?
gpl-2.0-or-later | general | 4 | 0.95 | general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-2.0-or-later | gplv2 | 3 | 0.9 | gplv2 or later
gpl-2.0-or-later | later | 3 | 0.9 | (?:gnu )?gpl(?: version| v)? v?2(?: 0)? or(?: any)? later(?: version)?
gpl-2.0-or-later | spdx | 5 | 1.0 | spdx license identifier gpl 2 0 or later
gpl-2.0-classpath | classpath | 4 | 0.95 | (?:with )?(?:the )?classpath exception(?: 2 0)?
gpl-2.0-classpath | independent | 4 | 0.85 | give you permission to link this library with independent modules to produce an executable
gpl-2.0-linux-syscall | syscall | 5 | 1.0 | with linux syscall note
gpl-3.0 | gpl | 3 | 0.9 | (?:gnu )?gpl(?: licen[cs]e)?(?: version| v)? v?3(?: 0)?
gpl-3.0 | gplv3 | 3 | 0.9 | gplv3(?: licen[cs]e)?
gpl-3.0 | general | 3 | 0.9 | general public licen[cs]e(?: version| v)? v?3(?: 0)?
gpl-3.0 | june | 4 | 0.95 | gnu general public license version 3 29 june 2007
gpl-3.0 | spdx | 5 | 1.0 | spdx license identifier gpl 3 0(?: only)?
gpl-3.0 | anti | 4 | 0.85 | protecting users legal rights from anti circumvention law
gpl-3.0 | convey | 4 | 0.85 | you may convey verbatim copies of the program s source code as you receive it
gpl-3.0-or-later | general | 4 | 0.95 | general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-3.0-or-later | gplv3 | 3 | 0.9 | gplv3 or later
gpl-3.0-or-later | later | 3 | 0.9 | (?:gnu )?gpl(?: version| v)? v?3(?: 0)? or(?: any)? later(?: version)?
gpl-3.0-or-later | spdx | 5 | 1.0 | spdx license identifier gpl 3 0 or later
gcc-exception | gcc | 4 | 0.9 | gcc runtime library exception(?: version 3 1)?
bison-exception | bison | 4 | 0.9 | as a special exception you may create a larger work that contains part or all of the bison parser skeleton
autoconf-exception | autoconf | 4 | 0.85 | if you distribute this file as part of a program that contains a configuration script generated by autoconf
font-exception | embed | 4 | 0.85 | if you create a document which uses this font and embed this font or unaltered portions of this font into the document
lgpl | lesser | 1 | 0.6 | (?:gnu )?lesser general public licen[cs]e(?:s|d)?
lgpl | library | 1 | 0.6 | gnu library general public licen[cs]e(?:s|d)?
lgpl | lgpl | 1 | 0.6 | (?:gnu )?lgpl(?: licen[cs]e)?(?:d)?
lgpl | lgpl | 2 | 0.8 | (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?lgpl
lgpl | lesser | 2 | 0.8 | (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?lesser general public licen[cs]e
lgpl | lesser | 4 | 0.85 | you should have received a copy of the gnu lesser general public license
lgpl | library | 4 | 0.8 | a program that contains no derivative of any portion of the library but is designed to work with the library
lgpl | relink | 4 | 0.8 | so that the user can modify the library and then relink
lgpl-2.0 | lgpl | 3 | 0.9 | lgpl(?: version| v)? v?2 0(?: only| or later)?
lgpl-2.0 | library | 3 | 0.9 | library general public licen[cs]e(?: version| v)? v?2(?: 0)?
lgpl-2.0 | spdx | 5 | 1.0 | spdx license identifier lgpl 2 0(?: only| or later)?
lgpl-2.1 | lgpl | 3 | 0.9 | lgpl(?: version| v)? v?2 1(?: only| or later)?
lgpl-2.1 | lesser | 3 | 0.9 | lesser general public licen[cs]e(?: version| v)? v?2 1
lgpl-2.1 | february | 4 | 0.95 | gnu lesser general public license version 2 1 february 1999
lgpl-2.1 | spdx | 5 | 1.0 | spdx license identifier lgpl 2 1(?: only| or later)?
lgpl-2.1-or-later | lesser | 4 | 0.95 | lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
lgpl-3.0 | lgpl | 3 | 0.9 | lgpl(?: version| v)? v?3(?: 0)?(?: only| or later)?
lgpl-3.0 | lesser | 3 | 0.9 | lesser general public licen[cs]e(?: version| v)? v?3(?: 0)?
lgpl-3.0 | spdx | 5 | 1.0 | spdx license identifier lgpl 3 0(?: only| or later)?
agpl | affero | 1 | 0.6 | (?:gnu )?affero general public licen[cs]e(?:s|d)?
agpl | agpl | 1 | 0.6 | (?:gnu )?agpl(?: licen[cs]e)?(?:d)?
agpl | agpl | 2 | 0.8 | (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?agpl
agpl | affero | 2 | 0.8 | (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?(?:gnu )?affero general public licen[cs]e
agpl | affero | 4 | 0.85 | you should have received a copy of the gnu affero general public license
agpl | remotely | 4 | 0.9 | must prominently offer all users interacting with it remotely through a computer network
agpl-1.0 | spdx | 5 | 1.0 | spdx license identifier agpl 1 0(?: only| or later)?
agpl-3.0 | agpl | 3 | 0.9 | agpl(?: version| v)? v?3(?: 0)?(?: only| or later)?
agpl-3.0 | agplv3 | 3 | 0.9 | agplv3(?: or later)?
agpl-3.0 | affero | 3 | 0.9 | affero general public licen[cs]e(?: version| v)? v?3(?: 0)?
agpl-3.0 | spdx | 5 | 1.0 | spdx license identifier agpl 3 0(?: only| or later)?
sspl | sspl | 1 | 0.7 | sspl(?: v?1(?: 0)?)?
sspl | server | 1 | 0.7 | server side public licen[cs]e(?: version 1| v1)?
sspl | service | 4 | 0.9 | if you make the functionality of the program or a modified version available to third parties as a service
gfdl | documentation | 1 | 0.6 | (?:gnu )?free documentation licen[cs]e(?:s|d)?
gfdl | gfdl | 1 | 0.6 | gfdl(?: licen[cs]e)?(?:d)?
gfdl | invariant | 4 | 0.9 | with no invariant sections(?: with)? no front cover texts and(?: with)? no back cover texts
gfdl-1.1 | documentation | 3 | 0.9 | free documentation licen[cs]e(?: version| v)? v?1 1
gfdl-1.1 | spdx | 5 | 1.0 | spdx license identifier gfdl 1 1(?: only| or later)?
gfdl-1.2 | documentation | 3 | 0.9 | free documentation licen[cs]e(?: version| v)? v?1 2
gfdl-1.2 | spdx | 5 | 1.0 | spdx license identifier gfdl 1 2(?: only| or later)?
gfdl-1.3 | documentation | 3 | 0.9 | free documentation licen[cs]e(?: version| v)? v?1 3
gfdl-1.3 | spdx | 5 | 1.0 | spdx license identifier gfdl 1 3(?: only| or later)?
mpl | mozilla | 1 | 0.6 | mozilla public licen[cs]e(?:s|d)?
mpl | mpl | 1 | 0.5 | mpl licen[cs]e(?:d)?
mpl | mpl | 2 | 0.8 | (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?mpl
mpl | mozilla | 2 | 0.8 | (?:subject to|licensed under) the (?:terms of the )?mozilla public licen[cs]e
mpl-1.0 | mozilla | 3 | 0.9 | mozilla public licen[cs]e(?: version| v)? v?1 0
mpl-1.0 | spdx | 5 | 1.0 | spdx license identifier mpl 1 0
mpl-1.1 | mozilla | 3 | 0.9 | mozilla public licen[cs]e(?: version| v)? v?1 1
mpl-1.1 | mpl | 3 | 0.9 | mpl(?: version| v)? v?1 1(?: gpl 2 0 lgpl 2 1)?
mpl-1.1 | spdx | 5 | 1.0 | spdx license identifier mpl 1 1
mpl-1.1 | basis | 4 | 0.85 | software distributed under the license is distributed on an as is basis without warranty of any kind either express(?:ed)? or implied see the license for the specific language
mpl-2.0 | mozilla | 3 | 0.9 | mozilla public licen[cs]e(?: version| v)? v?2(?: 0)?
mpl-2.0 | mpl | 3 | 0.9 | mpl(?: version| v)? v?2(?: 0)?
mpl-2.0 | mozilla | 4 | 0.95 | this source code form is subject to the terms of the mozilla public license
mpl-2.0 | mozilla | 4 | 0.95 | you can obtain one at https? (?:www )?mozilla org mpl 2 0
mpl-2.0 | incompatible | 4 | 0.9 | this source code form is incompatible with secondary licenses
mpl-2.0 | spdx | 5 | 1.0 | spdx license identifier mpl 2 0
epl | eclipse | 1 | 0.6 | eclipse public licen[cs]e(?:s|d)?
epl | accompanying | 4 | 0.85 | this program and the accompanying materials are made available under the terms of the eclipse public license
epl-1.0 | eclipse | 3 | 0.9 | eclipse public licen[cs]e(?: version| v)? v?1 0
epl-1.0 | spdx | 5 | 1.0 | spdx license identifier epl 1 0
epl-2.0 | eclipse | 3 | 0.9 | eclipse public licen[cs]e(?: version| v)? v?2(?: 0)?
epl-2.0 | spdx | 5 | 1.0 | spdx license identifier epl 2 0
edl-1.0 | eclipse | 3 | 0.9 | eclipse distribution licen[cs]e(?: version| v)?(?: v?1 0)?
cpl-1.0 | common | 1 | 0.6 | common public licen[cs]e(?: version| v)?(?: v?1 0)?
cpl-1.0 | spdx | 5 | 1.0 | spdx license identifier cpl 1 0
ipl-1.0 | ibm | 1 | 0.7 | ibm public licen[cs]e(?: version| v)?(?: v?1 0)?
cddl | development | 1 | 0.6 | common development and distribution licen[cs]e(?:s|d)?
cddl | cddl | 1 | 0.6 | cddl(?: licen[cs]e)?(?:d)?
cddl | cddl | 4 | 0.85 | do not alter or remove copyright notices or this header when distributing each file include this cddl header
cddl-1.0 | cddl | 3 | 0.9 | cddl(?: version| v)? v?1 0
cddl-1.0 | spdx | 5 | 1.0 | spdx license identifier cddl 1 0
cddl-1.1 | cddl | 3 | 0.9 | cddl(?: version| v)? v?1 1
cddl-1.1 | spdx | 5 | 1.0 | spdx license identifier cddl 1 1
eupl | european | 1 | 0.6 | european union public licen[cs]e(?:s|d)?
eupl-1.1 | spdx | 5 | 1.0 | spdx license identifier eupl 1 1
eupl-1.1 | eupl | 3 | 0.9 | eupl(?: version| v)? v?1 1
eupl-1.2 | spdx | 5 | 1.0 | spdx license identifier eupl 1 2
eupl-1.2 | eupl | 3 | 0.9 | eupl(?: version| v)? v?1 2
eupl | joinup | 4 | 0.85 | you may not use this work except in compliance with the licen[cs]e you may obtain a copy of the licen[cs]e at https? joinup
bsl-1.0 | boost | 1 | 0.6 | boost software licen[cs]e(?:d)?
bsl-1.0 | boost | 3 | 0.9 | boost software licen[cs]e(?: version| v)? v?1 0
bsl-1.0 | boost | 4 | 0.95 | distributed under the boost software license version 1 0 see accompanying file
bsl-1.0 | machine | 4 | 0.85 | unless such copies or derivative works are solely in the form of machine executable object code
bsl-1.0 | spdx | 5 | 1.0 | spdx license identifier bsl 1 0
busl-1.1 | business | 2 | 0.8 | business source licen[cs]e(?: version)?(?: 1 1)?
busl-1.1 | spdx | 5 | 1.0 | spdx license identifier busl 1 1
busl-1.1 | production | 4 | 0.85 | the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use of the licensed work
elastic-2.0 | elastic | 2 | 0.8 | elastic licen[cs]e(?: version| v)?(?: v?2 0)?
elastic-2.0 | managed | 4 | 0.85 | you may not provide the software to third parties as a hosted or managed service
commons-clause | commons | 3 | 0.9 | commons clause(?: license condition v1 0)?
polyform | polyform | 2 | 0.8 | polyform (?:noncommercial|small business|strict|shield|internal use) licen[cs]e
artistic | artistic | 1 | 0.6 | (?:perl )?artistic licen[cs]e(?:s|d)?
artistic | perl | 2 | 0.8 | (?:under the )?same terms as perl(?: itself)?
artistic-1.0 | artistic | 3 | 0.9 | artistic licen[cs]e(?: version| v)? v?1 0
artistic-1.0 | spdx | 5 | 1.0 | spdx license identifier artistic 1 0(?: perl| cl8)?
artistic-1.0 | semblance | 4 | 0.85 | the copyright holder maintains some semblance of artistic control over the development of the package
artistic-2.0 | artistic | 3 | 0.9 | artistic licen[cs]e(?: version| v)? v?2(?: 0)?
artistic-2.0 | spdx | 5 | 1.0 | spdx license identifier artistic 2 0
zlib | zlib | 1 | 0.6 | zlib(?: libpng)? licen[cs]e(?:s|d)?
zlib | zlib | 2 | 0.8 | (?:licensed|released|distributed|available) under (?:the )?(?:terms of )?(?:the )?zlib(?: licen[cs]e)?
zlib | altered | 4 | 0.9 | altered source versions must be plainly marked as such
zlib | misrepresented | 4 | 0.9 | the origin of this software must not be misrepresented
zlib | provided | 4 | 0.7 | this software is provided as is without any express or implied warranty in no event will the authors be held liable
zlib | spdx | 5 | 1.0 | spdx license identifier zlib
libpng | libpng | 2 | 0.8 | (?:png reference library|libpng) license(?: version 2)?
libpng | spdx | 5 | 1.0 | spdx license identifier libpng(?: 2 0)?
libtiff | spdx | 5 | 1.0 | spdx license identifier libtiff
ijg | jpeg | 4 | 0.85 | this software is based in part on the work of the independent jpeg group
bzip2 | spdx | 5 | 1.0 | spdx license identifier bzip2 1 0 6
curl | curl | 2 | 0.7 | curl licen[cs]e
curl | spdx | 5 | 1.0 | spdx license identifier curl
openssl | openssl | 1 | 0.6 | openssl licen[cs]e(?:d)?
openssl | ssleay | 1 | 0.6 | ssleay licen[cs]e
openssl | openssl | 4 | 0.85 | this product includes software developed by the openssl project for use in the openssl toolkit
openssl | cryptographic | 4 | 0.85 | this product includes cryptographic software written by eric young
openssl | spdx | 5 | 1.0 | spdx license identifier openssl
openldap | openldap | 2 | 0.8 | openldap public licen[cs]e(?: version| v)?(?: v?2 8)?
postgresql | postgresql | 2 | 0.8 | postgresql licen[cs]e
postgresql | spdx | 5 | 1.0 | spdx license identifier postgresql
python | python | 1 | 0.6 | python(?: software foundation)? licen[cs]e(?:s|d)?
python | psf | 1 | 0.6 | psf licen[cs]e(?:d)?
python-2.0 | python | 3 | 0.9 | python software foundation licen[cs]e(?: version| v)? v?2
python-2.0 | spdx | 5 | 1.0 | spdx license identifier python 2 0
python-2.0 | psf | 4 | 0.85 | psf hereby grants licensee a nonexclusive royalty free world wide license
php | php | 1 | 0.6 | php licen[cs]e(?:d)?
php-3.0 | php | 3 | 0.9 | php licen[cs]e(?: version| v)? v?3 0
php-3.01 | php | 3 | 0.9 | php licen[cs]e(?: version| v)? v?3 01
php-3.01 | spdx | 5 | 1.0 | spdx license identifier php 3 01
ruby | ruby | 1 | 0.6 | ruby(?: s)? licen[cs]e(?:d)?
ruby | spdx | 5 | 1.0 | spdx license identifier ruby
tcl | spdx | 5 | 1.0 | spdx license identifier tcl
w3c | w3c | 1 | 0.6 | w3c(?: software)?(?: notice and)?(?: document)? licen[cs]e(?:d)?
w3c | spdx | 5 | 1.0 | spdx license identifier w3c(?: 20150513)?
ofl | sil | 1 | 0.6 | sil open font licen[cs]e(?:s|d)?
ofl | font | 1 | 0.6 | open font licen[cs]e(?:d)?
ofl | reserved | 4 | 0.85 | no modified version of the font software may use the reserved font name
ofl | sold | 4 | 0.85 | neither the font software nor any of its individual components in original or modified versions may be sold by itself
ofl-1.0 | spdx | 5 | 1.0 | spdx license identifier ofl 1 0
ofl-1.1 | font | 3 | 0.9 | open font licen[cs]e(?: version| v)? v?1 1
ofl-1.1 | spdx | 5 | 1.0 | spdx license identifier ofl 1 1
ubuntu-font | ubuntu | 2 | 0.8 | ubuntu font licen[cs]e(?: version)?(?: 1 0)?
odbl | database | 1 | 0.6 | open database licen[cs]e(?:d)?
odbl-1.0 | database | 3 | 0.9 | open database licen[cs]e(?: odbl)?(?: version| v)? v?1 0
odbl-1.0 | spdx | 5 | 1.0 | spdx license identifier odbl 1 0
odc-by | odc | 2 | 0.8 | odc(?: by| attribution)(?: licen[cs]e)?(?: 1 0)?
pddl | pddl | 2 | 0.8 | (?:public domain dedication and licen[cs]e )?pddl(?: 1 0)?
cdla | cdla | 3 | 0.9 | cdla (?:permissive|sharing)(?: 1 0| 2 0)?
unlicense | unlicense | 1 | 0.6 | (?:the )?unlicense(?: license)?(?:d)?
unlicense | unencumbered | 4 | 0.95 | free and unencumbered software released into the public domain
unlicense | dedicate | 4 | 0.85 | dedicate any and all copyright interest in the software to the public domain
unlicense | unlicense | 4 | 0.85 | please refer to https? unlicense org
unlicense | spdx | 5 | 1.0 | spdx license identifier unlicense
wtfpl | wtfpl | 1 | 0.6 | wtfpl(?: licen[cs]e)?(?: version 2| v2)?
wtfpl | spdx | 5 | 1.0 | spdx license identifier wtfpl
beerware | beer | 2 | 0.8 | beer ?ware licen[cs]e(?: revision 42)?
beerware | beer | 4 | 0.85 | you can buy me a beer in return
blueoak-1.0.0 | oak | 2 | 0.8 | blue oak model licen[cs]e(?: 1 0 0)?
upl-1.0 | universal | 2 | 0.8 | universal permissive licen[cs]e(?: version| v)?(?: v?1 0)?
upl-1.0 | spdx | 5 | 1.0 | spdx license identifier upl 1 0
afl-3.0 | academic | 2 | 0.8 | academic free licen[cs]e(?: version| v)?(?: v?3 0)?
osl-3.0 | open | 2 | 0.7 | open software licen[cs]e(?: version| v)?(?: v?3 0)?
ecl-2.0 | educational | 2 | 0.8 | educational community licen[cs]e(?: version| v)?(?: v?2 0)?
ncsa | ncsa | 2 | 0.8 | (?:university of illinois )?ncsa open source licen[cs]e
ncsa | deal | 4 | 0.9 | to deal with the software without restriction
mulan | mulan | 2 | 0.8 | mulan (?:psl|permissive software licen[cs]e)(?: v2| version 2)?
cecill | cecill | 2 | 0.8 | cecill(?: b| c)?(?: free software)?(?: licen[cs]e)?(?: 2 0| 2 1)?
ms-pl | microsoft | 2 | 0.8 | microsoft public licen[cs]e(?: ms pl)?
ms-rl | microsoft | 2 | 0.8 | microsoft reciprocal licen[cs]e(?: ms rl)?
ms-pl | spdx | 5 | 1.0 | spdx license identifier ms pl
nvidia | nvidia | 2 | 0.7 | nvidia (?:software|source code) licen[cs]e(?: agreement)?
intel | intel | 2 | 0.7 | intel (?:simplified software|open source) licen[cs]e
openrail | openrail | 2 | 0.8 | (?:creativeml |bigscience )?openrail(?: m)?(?: licen[cs]e)?
cc0 | cc0 | 3 | 0.85 | cc0(?: 1 0)?(?: universal)?
cc0 | spdx | 5 | 1.0 | spdx license identifier cc0 1 0
cc0 | waived | 4 | 0.85 | has waived all copyright and related or neighboring rights to this work
cc-by | creative | 2 | 0.8 | creative commons attribution(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
cc-by | cc | 2 | 0.7 | cc by
cc-by-1.0 | cc | 3 | 0.9 | cc by 1 0
cc-by-2.0 | cc | 3 | 0.9 | cc by 2 0
cc-by-2.5 | cc | 3 | 0.9 | cc by 2 5
cc-by-3.0 | cc | 3 | 0.9 | cc by 3 0
cc-by-4.0 | cc | 3 | 0.9 | cc by 4 0
cc-by-sa | creative | 2 | 0.8 | creative commons attribution share ?alike(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
cc-by-sa | cc | 2 | 0.7 | cc by sa
cc-by-sa-2.0 | cc | 3 | 0.9 | cc by sa 2 0
cc-by-sa-2.5 | cc | 3 | 0.9 | cc by sa 2 5
cc-by-sa-3.0 | cc | 3 | 0.9 | cc by sa 3 0
cc-by-sa-4.0 | cc | 3 | 0.9 | cc by sa 4 0
cc-by-nc | creative | 2 | 0.8 | creative commons attribution non ?commercial(?: [1-4] [05])?(?: international| unported| generic)?(?: licen[cs]e)?
cc-by-nc | cc | 2 | 0.7 | cc by nc
cc-by-nc-2.0 | cc | 3 | 0.9 | cc by nc 2 0
cc-by-nc-3.0 | cc | 3 | 0.9 | cc by nc 3 0
cc-by-nc-4.0 | cc | 3 | 0.9 | cc by nc 4 0
cc-by-nd | creative | 2 | 0.8 | creative commons attribution no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-nd | cc | 2 | 0.7 | cc by nd
cc-by-nd-3.0 | cc | 3 | 0.9 | cc by nd 3 0
cc-by-nd-4.0 | cc | 3 | 0.9 | cc by nd 4 0
cc-by-nc-sa | creative | 2 | 0.8 | creative commons attribution non ?commercial share ?alike(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-nc-sa | cc | 2 | 0.7 | cc by nc sa
cc-by-nc-sa-3.0 | cc | 3 | 0.9 | cc by nc sa 3 0
cc-by-nc-sa-4.0 | cc | 3 | 0.9 | cc by nc sa 4 0
cc-by-nc-nd | creative | 2 | 0.8 | creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?(?: [1-4] [05])?(?: licen[cs]e)?
cc-by-nc-nd | cc | 2 | 0.7 | cc by nc nd
cc-by-nc-nd-3.0 | cc | 3 | 0.9 | cc by nc nd 3 0
cc-by-nc-nd-4.0 | cc | 3 | 0.9 | cc by nc nd 4 0
cc | creativecommons | 3 | 0.8 | creativecommons org licenses by(?: nc)?(?: sa| nd)? [1-4] [05]
cc0 | creativecommons | 3 | 0.9 | creativecommons org publicdomain zero 1 0
public-domain | domain | 2 | 0.7 | (?:released|placed|dedicated|is) (?:in|into|to) the public domain
public-domain | domain | 2 | 0.7 | (?:this (?:work|software|file) is )?(?:hereby )?(?:dedicated|committed) to the public domain
public-domain | uncopyrighted | 2 | 0.7 | (?:this work is )?uncopyrighted
public-domain | spdx | 5 | 1.0 | spdx license identifier (?:public domain|nist pd|pd)
us-government | copyright | 4 | 0.8 | not subject to copyright protection (?:and is in the public domain )?(?:within|in) the united states
proprietary | reserved | 1 | 0.4 | all rights reserved
proprietary | confidential | 2 | 0.6 | (?:proprietary and confidential|confidential and proprietary)(?: information)?
proprietary | unauthorized | 2 | 0.6 | unauthorized copying of this file (?:via any medium )?is strictly prohibited
proprietary | reverse | 3 | 0.7 | (?:may|shall) not reverse engineer decompile or disassemble(?: the software)?
proprietary | agreement | 2 | 0.6 | end user licen[cs]e agreement(?: eula)?
proprietary | transferable | 3 | 0.7 | a (?:limited )?non exclusive non transferable (?:revocable )?licen[cs]e
non-commercial | commercial | 2 | 0.6 | (?:for )?(?:personal|academic|educational|research)(?: use)? (?:and|or) non commercial (?:use|purposes)(?: only)?
non-commercial | commercial | 2 | 0.6 | (?:free for|limited to|only for) non commercial (?:use|purposes)
disclaimer | warranty | 1 | 0.3 | without (?:any )?warranty
disclaimer | warranty | 3 | 0.5 | the software is provided as is without warranty of any kind(?: express or implied)?
disclaimer | merchantability | 3 | 0.5 | (?:implied )?warrant(?:y|ies) of merchantability(?: and)?(?: or)? fitness for a particular purpose
disclaimer | noninfringement | 3 | 0.5 | fitness for a particular purpose and noninfringement
liability | liable | 3 | 0.4 | in no event shall the (?:authors or copyright holders|copyright (?:holder|owner) or contributors|author|regents or contributors) be liable
liability | tort | 3 | 0.4 | whether in an action of contract tort or otherwise
liability | exemplary | 3 | 0.4 | direct indirect incidental special exemplary or consequential damages
patent-grant | patent | 3 | 0.5 | (?:a|an additional) (?:perpetual )?(?:worldwide )?(?:royalty free )?(?:irrevocable )?(?:non exclusive )?patent licen[cs]e
patent-grant | litigation | 3 | 0.5 | if you institute patent litigation against any entity
notice | retain | 3 | 0.4 | must retain (?:all )?(?:the above )?copyright (?:and license )?notices?
notice | notice | 3 | 0.4 | the above copyright notice and this permission notice
notice | verbatim | 3 | 0.4 | everyone is permitted to copy and distribute verbatim copies of this license document
linking | linking | 3 | 0.5 | linking (?:this library )?statically or dynamically with other modules
linking | link | 3 | 0.5 | permission to link (?:the code of )?(?:portions of )?this program with
dual | dual | 2 | 0.5 | dual licensed under
dual | option | 2 | 0.5 | at your option(?: under)? (?:either|any) (?:of )?(?:the )?(?:following )?licen[cs]es?
contributor-agreement | contributor | 2 | 0.5 | contributor licen[cs]e agreement
contributor-agreement | origin | 2 | 0.5 | developer(?: s)? certificate of origin(?: version 1 1| 1 1)?
"""


def table() -> list[tuple[str, str, str, int, float]]:
    """(label, gate, pattern, priority, confidence) in order."""
    out = []
    for line in SIGNATURES.strip().splitlines():
        label, gate, priority, confidence, pattern = (x.strip() for x in line.split(" | "))
        out.append((label, gate, pattern, int(priority), float(confidence)))
    return out
