"""Signatures of licences: sentences of their texts, file headers, grants and short names.

One per line: label, priority, keyword that every match contains (several by commas, of which a
match contains one), expression over lower-case words joined by single spaces. ``{v}`` stands for
what may come between a name and its version. Higher priorities are longer evidence:
4 a sentence of the text or a header, 3 a grant, 2 a name with a licence word, 1 a bare name.
"""

from __future__ import annotations

VERSION = "(?: version | ?v ?| )"
SCORES = {4: 0.95, 3: 0.85, 2: 0.75, 1: 0.5}

TABLE = """
mit :: 4 :: free of charge to any person obtaining :: permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files(?: the software)?
mit :: 4 :: to deal in the software without restriction :: to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies
mit :: 4 :: copyright notice and this permission notice shall be :: the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software
mit :: 4 :: without warranty of any kind express or implied :: (?:the )?software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability
mit :: 4 :: authors or copyright holders be liable :: in no event shall the authors or copyright holders be liable for any claim damages or other liability
mit :: 3 :: under mit,under the mit,under an mit :: (?:licensed|released|distributed|published|available|provided|shared) under (?:the |an )?mit
mit :: 3 :: mit style,mit type,mit like :: (?:licensed|released|available) under an? mit (?:style|type|like) licen[cs]e
mit :: 2 :: mit licen :: mit licen[cs]ed
mit :: 2 :: license mit,licence mit :: licen[cs]e mit
mit :: 2 :: mit x11,mit expat,x11 licen,x11 style licen :: (?:mit x11|mit expat|x11) (?:style )?licen[cs]e
mit-0 :: 2 :: mit 0,mit no attribution :: mit (?:0|no attribution)(?: licen[cs]ed?)?
x11 :: 4 :: name of the x consortium :: except as contained in this notice the name of the x consortium shall not be used in advertising
jsonlicense :: 4 :: used for good not evil :: the software shall be used for good not evil
isc :: 4 :: permission to use copy modify and or distribute :: permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted
isc :: 4 :: disclaims all warranties with regard to this software :: (?:the )?software is provided as is and (?:the author|isc) disclaims all warranties with regard to this software
isc :: 3 :: under isc,under the isc :: (?:licensed|released|distributed|available) under (?:the )?isc
isc :: 2 :: isc licen,license isc,licence isc :: isc licen[cs]ed|licen[cs]e isc
0bsd :: 2 :: 0bsd,zero clause bsd :: 0bsd|zero clause bsd(?: license)?
hpnd :: 4 :: permission to use copy modify and distribute this software and its :: permission to use copy modify and distribute this software and its documentation for any purpose (?:and )?without fee is hereby granted
hpnd :: 2 :: historical permission notice :: historical permission notice and disclaimer
ntp :: 4 :: for any purpose with or without fee is hereby granted provided :: permission to use copy modify and distribute this software and its documentation for any purpose with or without fee is hereby granted provided
as-is :: 1 :: provided as is :: (?:the |this )?(?:software|code|program|library|material|work) is provided as is
as-is :: 1 :: without warrant :: without warrant(?:y|ies) (?:of any kind|or conditions of any kind)
all-rights-reserved :: 1 :: all rights reserved :: copyright (?:c )?(?:[0-9]{4} )?(?:[^ ]+ ){0,6}all rights reserved
proprietary :: 3 :: proprietary and confidential,confidential and proprietary :: (?:proprietary and confidential|confidential and proprietary)(?: information)?
proprietary :: 3 :: unauthorized copying of this file :: unauthorized copying of this file via any medium is strictly prohibited
proprietary :: 2 :: proprietary licen,commercial licen :: (?:proprietary|commercial) licen[cs]e(?: agreement)?
bsd :: 4 :: redistribution and use in source and binary forms :: redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
bsd :: 4 :: redistributions of source code must retain :: redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer
bsd :: 4 :: redistributions in binary form must reproduce :: redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation
bsd-3 :: 4 :: names of its contributors may be used to endorse,names of its contributors may be used :: neither the names? of (?:the )?(?:[^ ]+ ){1,8}nor the names of its contributors may be used to endorse or promote products
bsd-4 :: 4 :: mentioning features or use of this software :: all advertising materials mentioning features or use of this software must display the following acknowledge?ment
bsd :: 4 :: provided by the copyright holders and contributors as is :: this software is provided by the copyright holders and contributors as is and any express or implied warranties
bsd :: 4 :: provided by the regents and contributors :: this software is provided by the regents and contributors as is and any express or implied warranties
bsd :: 4 :: bsd style license that can be found,bsd license that can be found :: use of this source code is governed by a bsd (?:style )?license that can be found in the license file
bsd-2-patent :: 2 :: bsd 2 clause patent,bsd plus patent :: bsd (?:2 clause|plus) patent(?: license)?
bsd-3-clear :: 4 :: no express or implied licenses to any party :: no express or implied licenses to any party s patent rights are granted by this license
bsd-3-clear :: 2 :: clear bsd,3 clause clear :: (?:clear bsd|bsd 3 clause clear)(?: license)?
bsd :: 3 :: under bsd,under the bsd,under a bsd :: (?:licensed|released|distributed|published|available|provided) under (?:the |a )?bsd
bsd :: 2 :: bsd licen :: bsd licen[cs]ed
bsd :: 2 :: license bsd,licence bsd :: licen[cs]e bsd
bsd-3 :: 3 :: under 3 clause bsd,under the 3 clause bsd,under bsd 3,under the bsd 3 :: under (?:the )?(?:3 clause bsd|bsd 3(?: clause)?)
bsd-2 :: 3 :: under 2 clause bsd,under the 2 clause bsd,under bsd 2,under the bsd 2 :: under (?:the )?(?:2 clause bsd|bsd 2(?: clause)?)
bsd-2 :: 2 :: freebsd licen,freebsd copyright :: freebsd (?:licen[cs]e|copyright)
bsd-3 :: 2 :: bsd new,new bsd :: (?:bsd new|new bsd)(?: licen[cs]ed?)?
bsd-4 :: 2 :: bsd old,original bsd,old bsd :: (?:bsd old|original bsd|old bsd) licen[cs]e
apache-2 :: 4 :: licensed under the apache license :: licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
apache-2 :: 4 :: obtain a copy of the license at :: you may obtain a copy of the license at (?:http|https) www apache org licenses license 2 0
apache-2 :: 4 :: apache org licenses license 2 :: www apache org licenses license 2 0(?: txt| html)?
apache-2 :: 4 :: software distributed under the license is distributed on an as is :: unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
apache-2 :: 4 :: for use reproduction and distribution as defined by sections 1 through 9 :: terms and conditions for use reproduction and distribution as defined by sections 1 through 9
apache-2 :: 4 :: hereby grants to you a perpetual worldwide :: each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license
apache-2 :: 4 :: licenses this file to you under the apache :: the asf licenses this file to you under the apache license
apache-2 :: 3 :: under apache,under the apache :: (?:licensed|released|distributed|published|available|provided) under (?:the )?apache{v}2(?: 0)?
apache-2 :: 2 :: apache :: apache{v}2(?: 0)? licen[cs]ed?
apache-2 :: 2 :: license apache,licence apache :: licen[cs]e apache{v}2(?: 0)?
apache-2 :: 2 :: asl 2,asl2,al2 :: asl ?2 0|asl2|al2 0
apache-1.1 :: 4 :: developed by the apache software foundation :: this product includes software developed by the apache software foundation
apache-1 :: 4 :: developed by the apache group :: this product includes software developed by the apache group
apache :: 3 :: under apache,under the apache,under an apache :: (?:licensed|released|distributed|available) under (?:the |an )?apache(?: license)?
apache :: 2 :: apache licen :: apache licen[cs]ed?
gpl-2 :: 4 :: either version 2 of the license :: under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
gpl-3 :: 4 :: either version 3 of the license :: under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
gpl-2 :: 4 :: general public license version 2 june :: (?:gnu )?general public license version 2 june 1991
gpl-3 :: 4 :: general public license version 3 29 june :: (?:gnu )?general public license version 3 29 june 2007
gpl-1 :: 4 :: general public license version 1 :: (?:gnu )?general public license version 1 february 1989
gpl :: 4 :: this program is free software you can redistribute :: this program is free software you can redistribute it and or modify it under the terms of the gnu general public license
gpl :: 4 :: without even the implied warranty :: without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license
gpl :: 4 :: received a copy of the gnu general public license :: you should have received a copy of the gnu general public license along with this (?:program|software|package|file)
gpl :: 4 :: licenses for most software are designed to take away :: the licenses for most software are designed to take away your freedom to share and change it
gpl-3 :: 4 :: free copyleft license for software :: the gnu general public license is a free copyleft license for software and other kinds of works
gpl :: 4 :: activities other than copying distribution and modification :: activities other than copying distribution and modification are not covered by this license
gpl-2 :: 4 :: version 2 of the gnu general public :: (?:under )?version 2 of the gnu general public license
gpl-3 :: 4 :: version 3 of the gnu general public :: (?:under )?version 3 of the gnu general public license
gpl-2 :: 4 :: gnu org licenses gpl 2,gnu org licenses old licenses gpl 2 :: gnu org licenses (?:old licenses )?gpl 2 0
gpl-3 :: 4 :: gnu org licenses gpl 3 :: gnu org licenses gpl 3 0
gpl :: 3 :: under gpl,under the gpl,under gnu gpl,under the gnu gpl :: (?:licensed|released|distributed|published|available|provided) under (?:the )?(?:gnu )?gpl
gpl-2 :: 3 :: under gpl,under the gpl,under gnu gpl,under the gnu gpl :: under (?:the )?(?:gnu )?gpl{v}2(?: 0)?
gpl-3 :: 3 :: under gpl,under the gpl,under gnu gpl,under the gnu gpl :: under (?:the )?(?:gnu )?gpl{v}3(?: 0)?
gpl :: 2 :: gpl licen :: (?:gnu )?gpl licen[cs]ed?
gpl :: 2 :: gpl compatible :: gpl compatible licen[cs]e
gpl-2 :: 2 :: gpl 2 0 only,gpl 2 only :: gpl 2(?: 0)? only
gpl-2 :: 2 :: gpl 2 0 or later,gpl 2 or later,gplv2 :: gpl(?: |v)2(?: 0)? or later
gpl-3 :: 2 :: gpl 3 0 only,gpl 3 only :: gpl 3(?: 0)? only
gpl-3 :: 2 :: gpl 3 0 or later,gpl 3 or later,gplv3 :: gpl(?: |v)3(?: 0)? or later
gpl :: 2 :: license gpl,licence gpl :: licen[cs]e gpl
gpl-classpath :: 4 :: classpath exception :: (?:gpl(?:v2)? with (?:the )?)?classpath exception
gpl-classpath :: 4 :: linking this library statically or dynamically :: linking this library statically or dynamically with other modules is making a combined work
gpl-gcc-exception :: 4 :: gcc runtime library exception :: gcc runtime library exception(?: version 3 1)?
gpl-font-exception :: 4 :: font embedding exception,gpl font exception :: (?:font embedding|gpl font) exception
gpl-bison-exception :: 4 :: part or all of the bison parser skeleton :: as a special exception you may create a larger work that contains part or all of the bison parser skeleton
gpl-autoconf-exception :: 4 :: configuration script generated by autoconf :: a configuration script generated by autoconf
linux-syscall-note :: 4 :: linux syscall note :: (?:with )?linux syscall note
linux-syscall-note :: 4 :: normal use of the kernel :: user programs that use kernel services by normal system calls this is merely considered normal use of the kernel
gpl :: 1 :: general public licen :: (?:the )?(?:gnu )?general public licen[cs]e
lgpl :: 4 :: this library is free software you can redistribute :: this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license
lgpl-2.1 :: 4 :: either version 2 1 of the license :: either version 2 1 of the license or at your option any later version
lgpl-2.1 :: 4 :: lesser general public license version 2 1 february :: (?:gnu )?lesser general public license version 2 1 february 1999
lgpl-3 :: 4 :: lesser general public license version 3 29 june :: (?:gnu )?lesser general public license version 3 29 june 2007
lgpl-2 :: 4 :: library general public license version 2 june :: (?:gnu )?library general public license version 2 june 1991
lgpl-3 :: 4 :: incorporates the terms and conditions of version 3 :: this version of the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license
lgpl :: 4 :: received a copy of the gnu lesser,received a copy of the gnu library :: you should have received a copy of the gnu (?:lesser|library) general public license along with this (?:library|program)
lgpl-2.1 :: 4 :: gnu org licenses lgpl 2,gnu org licenses old licenses lgpl 2 :: gnu org licenses (?:old licenses )?lgpl 2 1
lgpl-3 :: 4 :: gnu org licenses lgpl 3 :: gnu org licenses lgpl 3 0
lgpl :: 3 :: under lgpl,under the lgpl,under gnu lgpl,under the gnu lgpl :: (?:licensed|released|distributed|published|available|provided) under (?:the )?(?:gnu )?lgpl
lgpl :: 2 :: lgpl licen,license lgpl,licence lgpl :: (?:gnu )?lgpl licen[cs]ed?|licen[cs]e lgpl
agpl-3 :: 4 :: gnu affero general public license version 3 19 :: gnu affero general public license version 3 19 november 2007
agpl-3 :: 4 :: terms of the gnu affero general public license :: under the terms of the gnu affero general public license as published by the free software foundation
agpl-3 :: 4 :: received a copy of the gnu affero :: you should have received a copy of the gnu affero general public license along with this program
agpl-3 :: 4 :: interacting with it remotely through a computer network :: all users interacting with it remotely through a computer network
agpl-3 :: 4 :: gnu org licenses agpl :: gnu org licenses agpl(?: 3 0)?
agpl-3 :: 3 :: under agpl,under the agpl,under gnu agpl,under the gnu agpl :: (?:licensed|released|distributed|available) under (?:the )?(?:gnu )?agpl
agpl-1 :: 2 :: affero general public license version 1,affero gpl version 1 :: affero (?:general public license|gpl) version 1
agpl :: 2 :: agpl licen,license agpl,licence agpl :: (?:gnu )?agpl licen[cs]ed?|licen[cs]e agpl
gfdl :: 4 :: copy distribute and or modify this document under :: permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
gfdl :: 4 :: no invariant sections :: with no invariant sections no front cover texts and no back cover texts
gfdl :: 2 :: gfdl,gnu fdl :: (?:gfdl|gnu fdl)(?:{v}1 [123])?
mpl-2 :: 4 :: source code form is subject to the terms of the mozilla :: this source code form is subject to the terms of the mozilla public license v 2 0
mpl-2 :: 4 :: mozilla org mpl 2 :: mozilla org mpl 2 0
mpl-2 :: 4 :: copy of the mpl was not distributed :: if a copy of the mpl was not distributed with this file you can obtain one at
mpl-1.1 :: 4 :: subject to the mozilla public license version 1 :: the contents of this file are subject to the mozilla public license version 1 1
mpl-1.0 :: 2 :: mozilla public license :: mozilla public license{v}1 0
mpl-2 :: 3 :: under mpl,under the mpl :: under (?:the )?mpl{v}2(?: 0)?
mpl-2 :: 2 :: mpl 2,mplv2 :: mpl(?: |v)2(?: 0)?(?: licen[cs]ed?)?
mpl-1.1 :: 2 :: mpl 1,mplv1 :: mpl(?: |v)1 1
mpl :: 3 :: under mpl,under the mpl :: (?:licensed|released|distributed|available) under (?:the )?mpl
mpl-tri :: 4 :: mpl 1 1 gpl 2 0 lgpl 2 1 :: begin license block version mpl 1 1 gpl 2 0 lgpl 2 1
npl-1.1 :: 2 :: netscape public license :: netscape public license(?:{v}1 [01])?
epl-1 :: 4 :: terms of the eclipse public license v1 :: made available under the terms of the eclipse public license v1 0
epl-2 :: 4 :: terms of the eclipse public license 2,terms of the eclipse public license v :: made available under the terms of the eclipse public license (?:v ?)?2 0
epl-1 :: 4 :: eclipse org legal epl v10 :: eclipse org legal epl v10
epl-2 :: 4 :: eclipse org legal epl 2,eclipse org legal epl v20 :: eclipse org legal epl (?:2 0|v20)
epl-2 :: 2 :: epl 2,eplv2 :: epl(?: |v)2(?: 0)?
epl-1 :: 2 :: epl 1,eplv1 :: epl(?: |v)1(?: 0)?
edl-1 :: 2 :: eclipse distribution license :: eclipse distribution license(?:{v}1 0)?
cddl-1 :: 4 :: common development and distribution license the license :: terms of the common development and distribution license the license you may not use this file except in compliance
cddl-1.1 :: 2 :: cddl 1 1 :: cddl 1 1
cddl-1 :: 2 :: cddl 1 0,cddl licen,under the cddl :: cddl (?:1 0|licen[cs]ed?)|under the cddl
cpl-1 :: 4 :: accompanying program is provided under the terms of this common :: the accompanying program is provided under the terms of this common public license
ipl-1 :: 2 :: ibm public license :: ibm public license(?:{v}1 0)?
apsl-2 :: 2 :: apple public source license :: apple public source license(?:{v}[12] [012])?
eupl-1.2 :: 4 :: licensed under the eupl :: licensed under the eupl(?: version)? 1 2
eupl-1.1 :: 4 :: licensed under the eupl :: licensed under the eupl(?: version)? 1 1
eupl :: 2 :: eupl 1,eupl v1,eupl1 :: eupl(?: v| )?1 [012]
cecill-2.1 :: 2 :: cecill 2 1,cecill version 2 1 :: cecill (?:version )?2 1
cecill-b :: 2 :: cecill b :: cecill b(?: licen[cs]e)?
cecill-c :: 2 :: cecill c :: cecill c(?: licen[cs]e)?
cecill :: 2 :: cecill licen,cecill free software :: cecill (?:free software )?licen[cs]e
osl-3 :: 2 :: open software license :: open software license(?:{v}[123] [012])?
osl-3 :: 4 :: licensed under the open software license :: licensed under the open software license version 3 0
afl-3 :: 2 :: academic free license :: academic free license(?:{v}[123] [012])?
afl-3 :: 4 :: licensed under the academic free license :: licensed under the academic free license version 3 0
zlib :: 4 :: misrepresented you must not claim :: the origin of this software must not be misrepresented you must not claim that you wrote the original software
zlib :: 4 :: altered source versions must be plainly marked :: altered source versions must be plainly marked as such and must not be misrepresented as being the original software
zlib :: 4 :: in no event will the authors be held liable :: this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages
zlib :: 3 :: under zlib,under the zlib :: (?:licensed|released|available) under (?:the )?zlib(?: libpng)?
libpng :: 2 :: libpng licen,png reference library licen :: (?:libpng|png reference library) licen[cs]e(?: version 2)?
bsl-1 :: 4 :: distributed under the boost software license :: distributed under the boost software license version 1 0
bsl-1 :: 4 :: boost software license version 1 0 august :: boost software license version 1 0 august 17th 2003
bsl-1 :: 4 :: boost org license 1 0 :: www boost org license 1 0 txt
bsl-1 :: 4 :: obtaining a copy of the software and accompanying documentation :: obtaining a copy of the software and accompanying documentation covered by this license
bsl-1 :: 2 :: boost licen :: boost licen[cs]ed?
unlicense :: 4 :: free and unencumbered software :: this is free and unencumbered software released into the public domain
unlicense :: 4 :: copy modify publish use compile sell :: anyone is free to copy modify publish use compile sell or distribute this software
unlicense :: 4 :: unlicense org :: (?:refer to )?(?:http |https )?unlicense org
cc0-1 :: 4 :: dedicated the work to the public domain by waiving :: dedicated the work to the public domain by waiving all of his or her rights
cc0-1 :: 4 :: creativecommons org publicdomain zero :: creativecommons org publicdomain zero 1 0
cc0-1 :: 4 :: cc0 1 0 universal :: (?:creative commons )?cc0 1 0 universal(?: public domain dedication)?
cc0-1 :: 3 :: under cc0,under the cc0,creative commons zero :: (?:licensed|released|available|published|dedicated) under (?:the )?(?:cc0|creative commons zero)
public-domain :: 4 :: placed in the public domain,released into the public domain,released to the public domain :: (?:hereby )?(?:placed in|released into|released to) the public domain
public-domain :: 4 :: dedicated to the public domain,dedicate any and all copyright :: dedicated to the public domain|dedicate any and all copyright interest in the software to the public domain
public-domain :: 4 :: publicdomain mark :: creativecommons org publicdomain mark 1 0
public-domain :: 3 :: is in the public domain :: (?:this|the) (?:work|text|file|code|software|image|book) is in the public domain
cc-by :: 4 :: creativecommons org licenses by :: creativecommons org licenses by [1234] 0
cc-by-sa :: 4 :: creativecommons org licenses by sa :: creativecommons org licenses by sa [1234] 0
cc-by-nc :: 4 :: creativecommons org licenses by nc :: creativecommons org licenses by nc [1234] 0
cc-by-nd :: 4 :: creativecommons org licenses by nd :: creativecommons org licenses by nd [1234] 0
cc-by-nc-sa :: 4 :: creativecommons org licenses by nc sa :: creativecommons org licenses by nc sa [1234] 0
cc-by-nc-nd :: 4 :: creativecommons org licenses by nc nd :: creativecommons org licenses by nc nd [1234] 0
cc-by :: 3 :: under cc by,under a cc by,under the cc by :: (?:licensed|released|available|published|shared|distributed) under (?:a |the )?cc by
cc-by :: 2 :: cc by licen :: cc by licen[cs]ed?
cc-by :: 2 :: license cc by,licence cc by :: licen[cs]e cc by
cc-by-4 :: 4 :: attribution 4 0 international :: (?:creative commons )?attribution 4 0 international(?: public license)?
cc-by-sa :: 4 :: attribution sharealike 4 0 international :: attribution sharealike 4 0 international(?: public license)?
cc-by-nc :: 4 :: attribution noncommercial 4 0 international :: attribution noncommercial 4 0 international(?: public license)?
cc-by-nc-sa :: 4 :: attribution noncommercial sharealike 4 0 international :: attribution noncommercial sharealike 4 0 international(?: public license)?
cc-by-nc-nd :: 4 :: attribution noncommercial noderivatives 4 0 international :: attribution noncommercial noderivatives 4 0 international(?: public license)?
cc-by-nd :: 4 :: attribution noderivatives 4 0 international :: attribution noderivatives 4 0 international(?: public license)?
cc :: 3 :: under a creative commons,under an creative commons,under the creative commons,under creative commons :: (?:licensed|released|available|published|shared) under (?:an? |the )?creative commons(?: licen[cs]e)?
cc :: 2 :: creative commons licen,some rights reserved :: creative commons licen[cs]e|some rights reserved
cc-sampling :: 2 :: sampling plus :: (?:creative commons )?sampling plus 1 0
artistic-1 :: 4 :: state the conditions under which a package may be copied :: the intent of this document is to state the conditions under which a package may be copied
artistic-1 :: 2 :: artistic license,clarified artistic :: (?:clarified )?artistic license 1 0
artistic-2 :: 4 :: artistic license 2 0 copyright :: the artistic license 2 0 copyright c 2000 2006
perl :: 4 :: same terms as perl :: (?:under|redistribute it and or modify it under) the same terms as perl(?: itself)?
python-2 :: 4 :: psf is making python available :: psf is making python available to licensee on an as is basis
python-2 :: 4 :: python software foundation license version 2 :: python software foundation license version 2
python-2 :: 2 :: psf licen,license psf,licence psf :: psf licen[cs]ed|licen[cs]e psf
php-3 :: 4 :: this product includes php :: this product includes php(?: software)? freely available from
php-3 :: 2 :: php license,php licence :: php licen[cs]e(?:{v}3(?: 01?)?)?
ruby :: 3 :: same terms as ruby,ruby license,ruby s license :: (?:under the same terms as ruby|ruby(?: s)? license)
openssl :: 4 :: developed by the openssl project :: this product includes software developed by the openssl project for use in the openssl toolkit
openssl :: 2 :: openssl license,openssl and ssleay license :: (?:openssl|dual openssl and ssleay) license
ssleay :: 4 :: written by eric young :: this product includes cryptographic software written by eric young
ofl-1.1 :: 4 :: licensed under the sil open font license :: this font software is licensed under the sil open font license version 1 1
ofl-1.1 :: 4 :: scripts sil org ofl :: scripts sil org ofl
ofl-1.1 :: 2 :: sil ofl,ofl 1 1 :: sil ofl(?: 1 1)?|ofl 1 1
ncsa :: 4 :: deal with the software without restriction :: to deal with the software without restriction including without limitation the rights to use
ncsa :: 2 :: illinois ncsa open source,ncsa license :: (?:university of )?illinois ncsa open source license|ncsa license
llvm-exception :: 4 :: llvm exception :: (?:apache (?:license )?(?:v|version )?2 0 )?(?:with )?llvm exceptions?
upl-1 :: 2 :: universal permissive license :: universal permissive license(?:{v}1 0)?
upl-1 :: 4 :: larger work to which the software is contributed :: larger work to which the software is contributed by such licensors
postgresql :: 4 :: use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement :: permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted
sspl-1 :: 4 :: server side public license version 1 :: under the terms of the server side public license version 1 as published by mongodb
sspl-1 :: 2 :: sspl :: sspl(?: v1| 1 0| licen[cs]ed?)
bsl-1.1 :: 4 :: change date change license,additional use grant :: (?:change date change license|additional use grant)
bsl-1.1 :: 4 :: use of this software is governed by the business source :: use of this software is governed by the business source license
elastic-2 :: 4 :: licensed under the elastic license :: licensed under the elastic license 2 0
elastic-2 :: 2 :: elv2 :: elv2
commons-clause :: 4 :: commons clause :: commons clause(?: license)?(?: condition)?(?: v1 0)?
commons-clause :: 4 :: does not include the right to sell,does not grant to you the right to sell :: the license does not include and the license does not grant to you the right to sell the software|does not include the right to sell the software
polyform :: 2 :: polyform :: polyform (?:noncommercial|small business|shield|strict|perimeter)(?: license)?(?: 1 0 0)?
prosperity :: 2 :: prosperity public license :: prosperity public license(?:{v}3 0 0)?
parity :: 2 :: parity public license :: parity public license(?:{v}7 0 0)?
hippocratic :: 2 :: hippocratic license :: hippocratic license(?:{v}[123](?: [01])?)?
anti-996 :: 2 :: anti 996 :: anti 996 licen[cs]e
wtfpl :: 4 :: everyone is permitted to copy and distribute verbatim or modified :: everyone is permitted to copy and distribute verbatim or modified copies of this license document and changing it is allowed
beerware :: 4 :: beer ware license,beerware license :: (?:the )?(?:beer ware|beerware) license(?: revision 42)?
beerware :: 4 :: you can buy me a beer :: if we meet some day and you think this stuff is worth it you can buy me a beer
vim :: 2 :: vim license :: vim license
curl :: 2 :: curl license,license curl :: curl license|license curl
fair :: 2 :: fair license :: (?:the )?fair license
icu :: 2 :: icu license,unicode license,icu inc license,unicode inc license :: (?:icu|unicode)(?: inc)? license(?: agreement)?
unicode :: 4 :: unicode data files and software :: unicode data files and software(?: the data files)?
w3c :: 2 :: w3c software :: w3c software (?:notice and )?(?:document )?license
w3c :: 4 :: copyright world wide web consortium :: copyright world wide web consortium massachusetts institute of technology
oasis :: 2 :: oasis open :: oasis open \\d{4} all rights reserved
ietf :: 4 :: ietf trust and the persons :: copyright c \\d{4} ietf trust and the persons identified as the document authors
lppl-1.3 :: 4 :: latex project public license :: conditions of the latex project public license
lppl-1.3 :: 2 :: latex project public license,lppl :: latex project public license(?:{v}1 [0123]c?)?|lppl(?: 1 [0123]c?)?
ms-pl :: 2 :: ms pl :: (?:licensed under |license )(?:the )?ms pl|ms pl licen[cs]ed?
ms-rl :: 2 :: ms rl :: (?:licensed under |license )(?:the )?ms rl|ms rl licen[cs]ed?
mulan-2 :: 2 :: mulan psl,mulan permissive :: mulan (?:psl|permissive software license)(?:{v}[12])?
odbl-1 :: 4 :: made available under the open database license :: made available under the open database license
odbl-1 :: 2 :: odbl :: odbl(?: 1 0| licen[cs]ed?)
odc-by :: 2 :: open data commons attribution,odc by :: open data commons attribution license|odc by(?: 1 0)?
pddl-1 :: 2 :: public domain dedication and license :: (?:odc |open data commons )?public domain dedication and license(?: pddl)?
dl-de :: 2 :: datenlizenz deutschland :: datenlizenz deutschland (?:namensnennung|zero)(?: (?:version )?2 0)?
ogl-uk :: 4 :: licensed under the open government :: (?:contains public sector information )?licensed under the open government licence v(?:ersion)? ?[123](?: 0)?
ogl-uk :: 2 :: open government licen :: open government licen[cs]e
etalab :: 2 :: licence ouverte,open licence etalab :: licence ouverte|open licence etalab
openrail :: 2 :: openrail :: (?:creativeml |bigscience )?openrail (?:m|s|d|ras|licen[cs]e)(?: licen[cs]e)?
llama :: 2 :: llama 2 community license,llama 3 community license :: (?:meta )?llama [23] community license(?: agreement)?
gutenberg :: 4 :: with almost no restrictions whatsoever :: (?:this ebook is )?for the use of anyone anywhere (?:[^ ]+ ){0,16}at no cost and with almost no restrictions whatsoever
gutenberg :: 2 :: project gutenberg license :: (?:full )?project gutenberg license
nasa :: 2 :: nasa open source agreement :: nasa open source agreement(?:{v}1 3)?
intel :: 4 :: intel open source license :: intel open source license
sleepycat :: 2 :: sleepycat license :: sleepycat license
qpl-1 :: 2 :: q public license :: q public license(?:{v}1 0)?
sissl :: 2 :: sun industry standards :: sun industry standards source license(?:{v}1 [12])?
watcom :: 2 :: sybase open watcom :: sybase open watcom public license(?:{v}1 0)?
rpl :: 2 :: reciprocal public license :: (?<!microsoft )reciprocal public license(?:{v}1 [15])?
cpal-1 :: 2 :: common public attribution :: common public attribution license(?:{v}1 0)?
ecl-2 :: 2 :: educational community license :: educational community license(?:{v}[12] 0)?
entessa :: 2 :: entessa public license :: entessa public license
frameworx :: 2 :: frameworx open license :: frameworx open license
motosoto :: 2 :: motosoto open source :: motosoto open source license
nokia :: 2 :: nokia open source :: nokia open source license
oclc-2 :: 2 :: oclc research public :: oclc research public license
ricoh :: 2 :: ricoh source code public :: ricoh source code public license
spl-1 :: 2 :: sun public license :: sun public license(?:{v}1 0)?
zpl-2.1 :: 2 :: zope public license,zpl 2 1 :: zope public license(?:{v}[12] [01])?|zpl 2 1
xnet :: 2 :: x net license :: x net license
vsl-1 :: 2 :: vovida software license :: vovida software license(?:{v}1 0)?
bittorrent :: 2 :: bittorrent open source :: bittorrent open source license(?:{v}1 [01])?
blueoak :: 2 :: blue oak model license :: blue oak model license(?: 1 0 0)?
blueoak :: 4 :: gives everyone as much permission :: gives everyone as much permission to work with this software as possible(?: while)?
ftl :: 2 :: freetype license,freetype project license :: freetype (?:project )?license
ijg :: 4 :: independent jpeg group :: this software is based in part on the work of the independent jpeg group
imagemagick :: 2 :: imagemagick license :: imagemagick license
glide :: 2 :: 3dfx glide :: 3dfx glide source code general public license
info-zip :: 2 :: info zip license :: info zip license
tcl :: 4 :: this software is copyrighted by the regents of :: this software is copyrighted by the regents of the university of california
aladdin :: 2 :: aladdin free public license :: aladdin free public license
cua-opl :: 2 :: cua office public :: cua office public license
lucent :: 2 :: lucent public license :: lucent public license(?:{v}1 0[2]?)?
eudatagrid :: 2 :: eu datagrid software :: eu datagrid software license
liliq :: 2 :: liliq :: liliq (?:p|r|r plus)(?: 1 1)?
"""


def signatures() -> list[tuple[str, str, tuple[str, ...], int, float]]:
    """``(label, expression, keywords, priority, score)`` in order."""
    out = []
    for line in TABLE.strip().splitlines():
        label, priority, words, expression = line.split(" :: ")
        number = int(priority)
        out.append((label, expression.replace("{v}", VERSION), tuple(words.split(",")), number, SCORES[number]))
    return out
