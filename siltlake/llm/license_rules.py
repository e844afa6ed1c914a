"""Licence signatures: one rule a line, under the label it gives.

A line holds a priority, the keyword without which the rule is not tried, and a regular
expression over the text's words in lower case, one space apart. Rules stand in order; among
overlapping detections the higher priority wins, then the longer, then the earlier rule.
Priorities: 90 full grant or exact identifier with version, 70 named with version, 50 named,
30 characteristic clause. Text under a # is a remark.
"""

RULES = r"""
gpl
 90 gnu gnu general public license(?: as published by the free software foundation)? (?:version|v) [123](?: 0)?(?: or (?:at your option )?any later version)?
 90 spdx spdx license identifier gpl [123] 0(?: only| or later| \+)?
 70 gpl gpl ?(?:version |v)?[123](?: 0)?(?: only| or later)?
 70 gplv3 gplv3(?: or later| only)?
 70 gplv2 gplv2(?: or later| only)?
 50 gnu gnu general public license
 50 gnu gnu gpl
 30 redistribute you can redistribute it and or modify it under the terms of the gnu
 30 warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu
 30 copyleft everyone is permitted to copy and distribute verbatim copies of this license document
lgpl
 90 lesser gnu lesser general public license (?:version|v) [23](?: [01])?(?: or (?:at your option )?any later version)?
 90 spdx spdx license identifier lgpl [23] [01](?: only| or later)?
 70 lgpl lgpl ?(?:version |v)?[23](?: [01])?(?: only| or later)?
 70 library gnu library general public license(?: version 2)?
 50 lesser gnu lesser general public license
agpl
 90 affero gnu affero general public license (?:version|v) 3(?: 0)?(?: or (?:at your option )?any later version)?
 90 spdx spdx license identifier agpl 3 0(?: only| or later)?
 70 agpl agpl ?(?:version |v)?3(?: 0)?(?: only| or later)?
 50 affero affero general public license
 30 network interacting with it remotely through a computer network
gfdl
 90 documentation gnu free documentation license version 1 [123](?: or any later version)?
 90 spdx spdx license identifier gfdl 1 [123](?: only| or later)?
 50 gfdl gfdl
 50 documentation gnu free documentation license
 30 invariant with no invariant sections no front cover texts and no back cover texts
apache
 90 apache licensed under the apache license version (?:2 0|1 1|1 0)
 90 spdx spdx license identifier apache (?:2 0|1 1|1 0)
 90 apache http www apache org licenses license 2 0
 70 apache apache license (?:version |v )?(?:2 0|1 1|1 0)
 70 apache apache 2 0
 70 asl asl 2 0
 50 apache apache license
 50 apache apache software license
 30 apache you may not use this file except in compliance with the license
 30 foundation licensed to the apache software foundation asf under one or more contributor license agreements
mit
 90 permission permission is hereby granted free of charge to any person obtaining a copy of this software
 90 spdx spdx license identifier mit(?: 0)?
 90 mit released under the mit license
 90 mit licensed under the mit license
 70 mit the mit license mit
 70 opensource opensource org licenses mit
 50 mit mit license
 50 expat expat license
 50 x11 x11 license
 30 sublicense to use copy modify merge publish distribute sublicense and or sell copies of the software
 30 noninfringement merchantability fitness for a particular purpose and noninfringement
bsd
 90 spdx spdx license identifier bsd [0234] clause(?: clear| patent)?
 70 bsd (?:the )?(?:new|modified|revised|simplified|original) bsd license
 70 bsd bsd [0234] clause(?: license)?
 70 clause (?:two|three|four|2|3|4) clause bsd(?: license)?
 70 opensource opensource org licenses bsd [23] clause
 50 bsd bsd license
 50 bsd bsd style license
 30 redistributions redistributions of source code must retain the above copyright notice
 30 redistributions redistributions in binary form must reproduce the above copyright notice
 30 endorse may be used to endorse or promote products derived from this software
 30 advertising all advertising materials mentioning features or use of this software
isc
 90 permission permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
 90 spdx spdx license identifier isc
 70 isc licensed under (?:the )?isc(?: license)?
 50 isc isc license
mpl
 90 mozilla this source code form is subject to the terms of the mozilla public license v 2 0
 90 spdx spdx license identifier mpl [12] [01](?: no copyleft exception)?
 70 mozilla mozilla public license (?:version |v )?[12] [01]
 70 mpl mpl [12] [01]
 50 mozilla mozilla public license
 30 mozilla mozilla org mpl
epl
 90 eclipse eclipse public license (?:version |v )?[12] 0
 90 spdx spdx license identifier epl [12] 0
 70 epl epl (?:v )?[12] 0
 50 eclipse eclipse public license
 50 eclipse eclipse distribution license
 30 eclipse eclipse org legal epl
cddl
 90 common common development and distribution license (?:version |v )?1 [01]
 90 spdx spdx license identifier cddl 1 [01]
 70 cddl cddl (?:v )?1 [01]
 50 common common development and distribution license
cpl
 90 common common public license (?:version |v )?(?:0 5|1 0)
 90 spdx spdx license identifier cpl 1 0
 50 common common public license
ipl
 90 ibm ibm public license (?:version |v )?1 0
 50 ibm ibm public license
eupl
 90 european european union public licen[cs]e (?:version |v )?1 [012]
 90 spdx spdx license identifier eupl 1 [012]
 70 eupl eupl (?:v )?1 [012]
 50 eupl licensed under the eupl
 50 european european union public licen[cs]e
cecill
 90 cecill cecill free software license agreement
 90 spdx spdx license identifier cecill (?:1 0|1 1|2 0|2 1|b|c)
 70 cecill cecill (?:v )?[12] [01]
 50 cecill (?:licence|license) cecill
artistic
 90 artistic the artistic license 2 0
 90 spdx spdx license identifier artistic [12] 0(?: perl| cl8)?
 70 perl under the same terms as perl(?: itself)?
 50 artistic artistic license
zlib
 90 zlib spdx license identifier zlib
 70 zlib zlib libpng license
 50 zlib zlib license
 30 altered altered source versions must be plainly marked as such
libpng
 90 libpng png reference library license version 2
 50 libpng libpng license
boost
 90 boost distributed under the boost software license version 1 0
 90 spdx spdx license identifier bsl 1 0
 70 boost boost software license (?:version )?1 0
 50 boost boost software license
 30 boost boost org license 1 0
bsl
 90 spdx spdx license identifier busl 1 1
 70 business business source license 1 1
 50 business business source license
 30 change on the change date or the fourth anniversary
unlicense
 90 unencumbered this is free and unencumbered software released into the public domain
 90 spdx spdx license identifier unlicense
 50 unlicense the unlicense
 30 unlicense unlicense org
wtfpl
 90 wtfpl spdx license identifier wtfpl
 50 wtfpl wtfpl
 50 fuck do what the fuck you want to public license
cc0
 90 cc0 spdx license identifier cc0 1 0
 90 cc0 cc0 1 0(?: universal)?
 50 cc0 cc0
 30 publicdomain creativecommons org publicdomain zero 1 0
 30 waive has waived all copyright and related or neighboring rights
cc-by
 90 spdx spdx license identifier cc by (?:[1-4] [05])
 90 creative creative commons attribution [1-4] [05](?: international| unported| generic)?
 90 licensed licensed under cc by(?: (?:nc|nd|sa))* [1-4] [05]
 70 cc cc by(?: (?:nc|nd|sa))* [1-4] [05]
 70 creativecommons creativecommons org licenses by(?: (?:nc|nd|sa))* [1-4] [05]
 50 cc cc by
 50 creative creative commons attribution(?: license)?
cc-by-sa
 90 spdx spdx license identifier cc by sa [1-4] [05]
 90 sharealike creative commons attribution share ?alike [1-4] [05](?: international| unported| generic)?
 95 sa cc by sa [1-4] [05]
 75 sa creativecommons org licenses by sa [1-4] [05]
 60 sa cc by sa
 60 sharealike creative commons attribution sharealike
cc-by-nc
 90 spdx spdx license identifier cc by nc [1-4] [05]
 90 noncommercial creative commons attribution non ?commercial [1-4] [05](?: international| unported| generic)?
 95 nc (?:licensed under )?cc by nc [1-4] [05]
 75 nc creativecommons org licenses by nc [1-4] [05]
 60 nc cc by nc
 60 noncommercial creative commons attribution noncommercial
cc-by-nd
 90 spdx spdx license identifier cc by nd [1-4] [05]
 90 noderivatives creative commons attribution no ?deriv(?:ative|atives|s) [1-4] [05](?: international| unported| generic)?
 95 nd (?:licensed under )?cc by nd [1-4] [05]
 75 nd creativecommons org licenses by nd [1-4] [05]
 60 nd cc by nd
cc-by-nc-sa
 90 spdx spdx license identifier cc by nc sa [1-4] [05]
 96 nc (?:licensed under )?cc by nc sa [1-4] [05]
 76 nc creativecommons org licenses by nc sa [1-4] [05]
 65 nc cc by nc sa
 65 noncommercial creative commons attribution noncommercial sharealike
cc-by-nc-nd
 90 spdx spdx license identifier cc by nc nd [1-4] [05]
 96 nc (?:licensed under )?cc by nc nd [1-4] [05]
 76 nc creativecommons org licenses by nc nd [1-4] [05]
 65 nc cc by nc nd
 65 noncommercial creative commons attribution noncommercial noderivs
odbl
 90 spdx spdx license identifier odbl 1 0
 70 database open database license (?:odbl )?v?1 0
 50 odbl odbl
 50 database open database license
odc-by
 90 spdx spdx license identifier odc by 1 0
 70 odc odc by 1 0
 50 data open data commons attribution license
pddl
 90 spdx spdx license identifier pddl 1 0
 50 pddl pddl
 50 public open data commons public domain dedication and license
cdla
 90 spdx spdx license identifier cdla (?:permissive|sharing) [12] 0
 50 cdla cdla (?:permissive|sharing)
 50 community community data license agreement
ofl
 90 sil sil open font license version 1 [01]
 90 spdx spdx license identifier ofl 1 [01]
 70 ofl ofl 1 [01]
 50 font open font license
 30 reserved with reserved font name
psf
 90 python python software foundation license version 2
 90 spdx spdx license identifier (?:psf|python) 2 0
 50 python python software foundation license
 50 psf psf license
 30 python psf is making python available to licensee on an as is basis
php
 90 php the php license version 3 0(?: ?1)?
 90 spdx spdx license identifier php 3 0(?: ?1)?
 50 php php license
ruby
 90 spdx spdx license identifier ruby
 50 ruby ruby license
 50 ruby same terms as ruby
openssl
 90 openssl this product includes software developed by the openssl project
 90 spdx spdx license identifier openssl
 50 openssl openssl license
ssleay
 90 eric this product includes cryptographic software written by eric young
 50 ssleay original ssleay license
postgresql
 90 spdx spdx license identifier postgresql
 50 postgresql postgresql license
 30 postgres regents of the university of california be liable to any party for direct indirect special
ms-pl
 90 spdx spdx license identifier ms pl
 70 microsoft microsoft public license
 50 ms ms pl
ms-rl
 90 spdx spdx license identifier ms rl
 70 microsoft microsoft reciprocal license
 50 ms ms rl
apsl
 90 apple apple public source license version [12] [012]
 90 spdx spdx license identifier apsl [12] [012]
 50 apple apple public source license
aal
 90 spdx spdx license identifier aal
 50 attribution attribution assurance license
afl
 90 academic academic free license (?:version |v )?[123] [012]
 90 spdx spdx license identifier afl [123] [012]
 50 academic academic free license
osl
 90 open open software license (?:version |v )?[123] [01]
 90 spdx spdx license identifier osl [123] [01]
 50 osl osl [123] [01]
ncsa
 90 illinois university of illinois ncsa open source license
 90 spdx spdx license identifier ncsa
vim
 90 spdx spdx license identifier vim
 50 vim vim license
w3c
 90 w3c w3c software notice and license
 90 spdx spdx license identifier w3c
 50 w3c w3c software and document license
json
 90 evil the software shall be used for good not evil
 90 spdx spdx license identifier json
curl
 90 spdx spdx license identifier curl
 50 curl curl license
ntp
 90 spdx spdx license identifier ntp
 50 ntp ntp license
unicode
 90 unicode unicode inc license agreement data files and software
 90 spdx spdx license identifier unicode dfs 201[56]
 50 unicode unicode license v3
upl
 90 universal universal permissive license (?:version |v )?1 0
 90 spdx spdx license identifier upl 1 0
mulan
 90 mulan mulan permissive software license v2
 90 spdx spdx license identifier mulanpsl 2 0
 50 mulan mulanpsl
sspl
 90 server server side public license (?:version |v )?1
 90 spdx spdx license identifier sspl 1 0
 50 sspl sspl
elastic
 90 elastic elastic license (?:version |v )?2 0
 90 spdx spdx license identifier elastic 2 0
 50 elastic elastic license
polyform
 90 polyform polyform (?:noncommercial|small business|strict|shield|perimeter) license 1 0 0
 50 polyform polyform project
openrail
 90 openrail creativeml open rail m license
 70 openrail bigscience openrail m
 50 openrail openrail m
llama
 90 llama llama [23](?: [0-9])? community license agreement
 50 llama llama community license
beerware
 90 beer the beer ware license
 50 beerware beerware
public-domain
 70 domain (?:this work|this file|this code|this software) is (?:hereby )?(?:placed |released )?in(?:to)? the public domain
 50 domain dedicated to the public domain
 50 domain released into the public domain
proprietary
 70 reserved copyright(?: c)?(?: \d{4})?(?: [^ ]+){1,6} all rights reserved
 50 proprietary proprietary and confidential
 50 confidential this document contains confidential information
 50 unauthorized unauthorized copying of this file via any medium is strictly prohibited
 30 eula end user license agreement
"""
