"""Signatures of licences, written for the normalised text that ``license_scan`` makes.

There, a text is its lower-case words (letters, digits, characters beyond ASCII) with
one space between; "GPL-3.0-or-later" reads "gpl 3 0 or later".  One rule a line:

    class | label | keyword | regular expression

A rule runs only on texts that contain its keyword, which every match of the
expression must contain.  It matches whole words.  Classes, by falling
priority: ``text`` (wording of a grant or of the licence), ``tag`` (a machine-readable
identifier or an address), ``name`` (the name with version or form), ``hint`` (the
bare name or an abbreviation).
"""

PRIORITY = {"text": 4, "tag": 3, "name": 2, "hint": 1}
#: Weight of the best detection of a label in the score of a text.
STRENGTH = {"text": 0.95, "tag": 0.98, "name": 0.85, "hint": 0.5, "base": 0.6}

RULES = r"""
text | mit | free of charge | permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files
text | mit | deal in the software | to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense
text | mit | above copyright notice and this permission | the above copyright notice and this permission notice shall be included in all copies or substantial portions
tag | mit | spdx | spdx license identifier mit
tag | mit | licenses mit | (?:www )?opensource org licenses mit(?: license(?: php| html)?)?
name | mit | mit | (?:released|licensed|distributed|available|covered|provided) under (?:the )?(?:terms of (?:the )?)?(?:expat )?mit licen[sc]e
name | mit | expat | expat licen[sc]e
hint | mit | mit | (?:the )?mit (?:style |type )?licen[sc]e
hint | mit | mit licensed | mit licensed
name | mit-0 | mit no attribution | mit no attribution(?: licen[sc]e)?
tag | mit-0 | spdx | spdx license identifier mit 0
name | x11 | x11 | x11 licen[sc]e
tag | x11 | spdx | spdx license identifier x11
text | x11 | x consortium | except as contained in this notice the name of the x consortium shall not be used in advertising
text | apache-2.0 | apache license | licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license
text | apache-2.0 | as is basis | unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis
text | apache-2.0 | terms and conditions for use | apache license version 2 0 january 2004(?: https? www apache org licenses)? terms and conditions for use reproduction and distribution
tag | apache-2.0 | spdx | spdx license identifier apache 2 0
tag | apache-2.0 | apache org | (?:www )?apache org licenses license 2 0(?: txt| html)?
tag | apache-2.0 | licenses apache | opensource org licenses apache 2 0
name | apache-2.0 | apache | apache(?: software)? licen[sc]e (?:version |v )?v?2(?: 0)?
name | apache-2.0 | apache | apache v?2(?: 0)?(?: licen[sc]e| licensed)
hint | apache-2.0 | asl | asl 2 0
name | apache-1.1 | apache | apache(?: software)? licen[sc]e (?:version |v )?1 1
tag | apache-1.1 | spdx | spdx license identifier apache 1 1
text | apache-1.1 | apache software foundation | this product includes software developed by the apache software foundation
name | apache-1.0 | apache | apache(?: software)? licen[sc]e (?:version |v )?1 0
hint | apache | apache | (?:the )?apache(?: software)? licen[sc]e
text | gpl-3.0 | gnu general public | gnu general public license version 3 29 june 2007
text | gpl-3.0-or-later | redistribute it | redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version
text | gpl-3.0-only | redistribute it | redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation version 3 of the license
tag | gpl-3.0-only | spdx | spdx license identifier gpl 3 0(?: only)?
tag | gpl-3.0-or-later | spdx | spdx license identifier gpl 3 0 or later
tag | gpl-3.0 | gnu org | (?:www )?gnu org licenses gpl 3 0(?: en)?(?: html| txt)?
name | gpl-3.0 | general public | (?:gnu )?general public licen[sc]e (?:\(?gpl\)? )?(?:version |v )?v?3(?: 0)?
name | gpl-3.0 | gpl | (?:gnu )?gpl (?:version |v )?v?3(?: 0)?
name | gpl-3.0 | gplv3 | (?:gnu )?gplv3
name | gpl-3.0-or-later | gplv3 | (?:gnu )?gplv3 or (?:later|newer|any later version)
name | gpl-3.0-or-later | general public | (?:gnu )?general public licen[sc]e (?:version |v )?v?3(?: 0)? or (?:later|any later version|at your option any later version)
text | gpl-2.0 | gnu general public | gnu general public license version 2 june 1991
text | gpl-2.0-or-later | redistribute it | redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version
text | gpl-2.0-only | redistribute it | redistribute it and or modify it under the terms of the gnu general public license version 2(?: only)? as published by the free software foundation
tag | gpl-2.0-only | spdx | spdx license identifier gpl 2 0(?: only)?
tag | gpl-2.0-or-later | spdx | spdx license identifier gpl 2 0 or later
tag | gpl-2.0 | gnu org | (?:www )?gnu org licenses (?:old licenses )?gpl 2 0(?: en)?(?: html| txt)?
name | gpl-2.0 | general public | (?:gnu )?general public licen[sc]e (?:version |v )?v?2(?: 0)?
name | gpl-2.0 | gpl | (?:gnu )?gpl (?:version |v )?v?2(?: 0)?
name | gpl-2.0 | gplv2 | (?:gnu )?gplv2
name | gpl-2.0-or-later | gplv2 | (?:gnu )?gplv2 or (?:later|newer|any later version)
name | gpl-1.0 | general public | (?:gnu )?general public licen[sc]e (?:version |v )?v?1(?: 0)?
tag | gpl-1.0 | spdx | spdx license identifier gpl 1 0(?: only| or later)?
text | gpl | without even the implied warranty | without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details
text | gpl | you should have received | you should have received a copy of the gnu general public license along with this (?:program|library|software|file)
hint | gpl | general public | gnu general public licen[sc]e
hint | gpl | gpl | gnu gpl
hint | gpl | gpl licensed | gpl licensed
name | gpl-classpath-exception | classpath | (?:with (?:the )?)?classpath exception(?: 2 0)?
name | gpl-linking-exception | linking exception | (?:with (?:the |a )?)?(?:special )?linking exception
name | gpl-font-exception | font exception | (?:with (?:the |a )?)?(?:gnu )?(?:gpl )?font exception
text | gcc-exception | gcc runtime library exception | gcc runtime library exception(?: version)?(?: 3 1)?
text | lgpl-3.0 | gnu lesser | gnu lesser general public license version 3 29 june 2007
text | lgpl-3.0-or-later | redistribute it | redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version
text | lgpl-2.1-or-later | redistribute it | redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version
text | lgpl-2.0-or-later | redistribute it | redistribute it and or modify it under the terms of the gnu library general public license as published by the free software foundation either version 2 of the license or at your option any later version
text | lgpl-2.1 | gnu lesser | gnu lesser general public license version 2 1 february 1999
tag | lgpl-3.0 | spdx | spdx license identifier lgpl 3 0(?: only| or later)?
tag | lgpl-2.1 | spdx | spdx license identifier lgpl 2 1(?: only| or later)?
tag | lgpl-2.0 | spdx | spdx license identifier lgpl 2 0(?: only| or later)?
tag | lgpl-3.0 | gnu org | (?:www )?gnu org licenses lgpl 3 0(?: en)?(?: html| txt)?
tag | lgpl-2.1 | gnu org | (?:www )?gnu org licenses (?:old licenses )?lgpl 2 1(?: en)?(?: html| txt)?
name | lgpl-3.0 | lesser general | (?:gnu )?lesser general public licen[sc]e (?:version |v )?v?3(?: 0)?
name | lgpl-2.1 | lesser general | (?:gnu )?lesser general public licen[sc]e (?:version |v )?v?2 1
name | lgpl-2.0 | library general | (?:gnu )?library general public licen[sc]e (?:version |v )?v?2(?: 0)?
name | lgpl-3.0 | lgpl | (?:gnu )?lgpl (?:version |v )?v?3(?: 0)?
name | lgpl-2.1 | lgpl | (?:gnu )?lgpl (?:version |v )?v?2 1
name | lgpl-3.0 | lgplv3 | (?:gnu )?lgplv3
name | lgpl-2.1 | lgplv2 | (?:gnu )?lgplv2 1
hint | lgpl | lesser general | (?:gnu )?lesser general public licen[sc]e
hint | lgpl | lgpl | (?:gnu )?lgpl
text | agpl-3.0 | affero | gnu affero general public license version 3 19 november 2007
text | agpl-3.0-or-later | redistribute it | redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version
tag | agpl-3.0 | spdx | spdx license identifier agpl 3 0(?: only| or later)?
tag | agpl-3.0 | gnu org | (?:www )?gnu org licenses agpl 3 0(?: en)?(?: html| txt)?
name | agpl-3.0 | affero | (?:gnu )?affero general public licen[sc]e (?:version |v )?v?3(?: 0)?
name | agpl-3.0 | agplv3 | (?:gnu )?agplv3
name | agpl-3.0 | agpl | (?:gnu )?agpl (?:version |v )?v?3(?: 0)?
name | agpl-1.0 | affero | affero general public licen[sc]e (?:version |v )?v?1(?: 0)?
hint | agpl | affero | (?:gnu )?affero (?:general public licen[sc]e|gpl)
hint | agpl | agpl | (?:gnu )?agpl
text | gfdl | free documentation | permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license
name | gfdl-1.3 | free documentation | (?:gnu )?free documentation licen[sc]e (?:version |v )?1 3
name | gfdl-1.2 | free documentation | (?:gnu )?free documentation licen[sc]e (?:version |v )?1 2
tag | gfdl-1.3 | spdx | spdx license identifier gfdl 1 3(?: only| or later)?
tag | gfdl-1.2 | spdx | spdx license identifier gfdl 1 2(?: only| or later)?
hint | gfdl | free documentation | (?:gnu )?free documentation licen[sc]e
hint | gfdl | gfdl | (?:gnu )?gfdl
text | bsd | redistribution and use in source | redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met
text | bsd-3-clause | endorse or promote | may be used to endorse or promote products derived from this software without specific prior written permission
text | bsd-4-clause | advertising materials | all advertising materials mentioning features or use of this software must display the following acknowledg?ement
text | bsd-2-clause | freebsd project | the views and conclusions contained in the software and documentation are those of the authors and should not be interpreted as representing official policies(?: either expressed or implied of the freebsd project)?
tag | bsd-2-clause | spdx | spdx license identifier bsd 2 clause
tag | bsd-3-clause | spdx | spdx license identifier bsd 3 clause
tag | bsd-4-clause | spdx | spdx license identifier bsd 4 clause
tag | 0bsd | spdx | spdx license identifier 0bsd
tag | bsd-2-clause | licenses bsd | opensource org licenses bsd 2 clause
tag | bsd-3-clause | licenses bsd | opensource org licenses bsd 3 clause
name | bsd-2-clause | bsd | (?:the )?(?:bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd|freebsd)(?: licen[sc]e)?
name | bsd-3-clause | bsd | (?:the )?(?:bsd (?:3|three) clause|(?:3|three) clause bsd|new bsd|modified bsd|revised bsd)(?: licen[sc]e)?
name | bsd-4-clause | bsd | (?:the )?(?:bsd (?:4|four) clause|(?:4|four) clause bsd|original bsd|old bsd)(?: licen[sc]e)?
name | 0bsd | bsd | (?:the )?(?:zero clause bsd|bsd zero clause|0 clause bsd)(?: licen[sc]e)?
hint | bsd | bsd | (?:the )?bsd (?:style |type )?licen[sc]e
hint | bsd | bsd licensed | bsd licensed
text | isc | isc | permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and isc disclaims
text | isc-style | with or without fee | permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted
tag | isc | spdx | spdx license identifier isc
name | isc | isc | (?:the )?isc licen[sc]e
text | mpl-2.0 | mozilla public | this source code form is subject to the terms of the mozilla public license v 2 0
text | mpl-2.0 | mpl was not distributed | if a copy of the mpl was not distributed with this file you can obtain one at
text | mpl-1.1 | mozilla public | the contents of this file are subject to the mozilla public license version 1 1
tag | mpl-2.0 | spdx | spdx license identifier mpl 2 0
tag | mpl-1.1 | spdx | spdx license identifier mpl 1 1
tag | mpl-2.0 | mozilla org | (?:www )?mozilla org mpl 2 0
name | mpl-2.0 | mozilla public | mozilla public licen[sc]e (?:version |v )?v?2(?: 0)?
name | mpl-1.1 | mozilla public | mozilla public licen[sc]e (?:version |v )?v?1 1
name | mpl-1.0 | mozilla public | mozilla public licen[sc]e (?:version |v )?v?1 0
name | mpl-2.0 | mpl | mpl (?:version |v )?v?2(?: 0)?
hint | mpl | mozilla public | mozilla public licen[sc]e
text | epl-2.0 | eclipse public | this program and the accompanying materials are made available under the terms of the eclipse public license v?(?: ?2 0)
text | epl-1.0 | eclipse public | this program and the accompanying materials are made available under the terms of the eclipse public license v?(?: ?1 0)
tag | epl-2.0 | spdx | spdx license identifier epl 2 0
tag | epl-1.0 | spdx | spdx license identifier epl 1 0
tag | epl-2.0 | eclipse org | (?:www )?eclipse org legal epl (?:v20|2 0)
tag | epl-1.0 | eclipse org | (?:www )?eclipse org legal epl v10
name | epl-2.0 | eclipse public | eclipse public licen[sc]e (?:version |v )?v?2(?: 0)?
name | epl-1.0 | eclipse public | eclipse public licen[sc]e (?:version |v )?v?1(?: 0)?
hint | epl | eclipse public | eclipse public licen[sc]e
name | edl-1.0 | eclipse distribution | eclipse distribution licen[sc]e(?: v?1 0)?
text | cddl-1.0 | common development and distribution | the contents of this file are subject to the terms of the common development and distribution license
tag | cddl-1.0 | spdx | spdx license identifier cddl 1 0
tag | cddl-1.1 | spdx | spdx license identifier cddl 1 1
name | cddl-1.1 | common development and distribution | common development and distribution licen[sc]e (?:version |v )?1 1
name | cddl-1.0 | common development and distribution | common development and distribution licen[sc]e (?:version |v )?1 0
hint | cddl | common development and distribution | common development and distribution licen[sc]e
hint | cddl | cddl | cddl
tag | cpl-1.0 | spdx | spdx license identifier cpl 1 0
name | cpl-1.0 | common public | common public licen[sc]e(?: (?:version |v )?1 0)?
name | ipl-1.0 | ibm public | ibm public licen[sc]e(?: (?:version |v )?1 0)?
text | eupl-1.2 | eupl | licensed under the eupl version 1 2
tag | eupl-1.2 | spdx | spdx license identifier eupl 1 2
name | eupl-1.2 | european union public | european union public licen[sc]e (?:version |v )?v?1 2
name | eupl-1.1 | european union public | european union public licen[sc]e (?:version |v )?v?1 1
hint | eupl | european union public | european union public licen[sc]e
hint | eupl | eupl | eupl
text | cc0-1.0 | waived all copyright | to the extent possible under law (?:\S+ ){1,12}has waived all copyright and related or neighboring rights
tag | cc0-1.0 | spdx | spdx license identifier cc0 1 0
tag | cc0-1.0 | publicdomain zero | creativecommons org publicdomain zero 1 0
name | cc0-1.0 | cc0 | (?:creative commons )?cc0 (?:1 0|universal)(?: universal)?
name | cc0-1.0 | creative commons zero | creative commons zero(?: v?1 0)?(?: universal)?
hint | cc0-1.0 | cc0 | cc0
text | cc-by-4.0 | creative commons | this work is licensed under a creative commons attribution 4 0 international license
text | cc-by-3.0 | creative commons | this work is licensed under a creative commons attribution 3 0 (?:unported|united states) license
text | cc-by-sa-4.0 | creative commons | this work is licensed under a creative commons attribution share ?alike 4 0 international license
text | cc-by-nc-4.0 | creative commons | this work is licensed under a creative commons attribution non ?commercial 4 0 international license
text | cc-by-nc-sa-4.0 | creative commons | this work is licensed under a creative commons attribution non ?commercial share ?alike 4 0 international license
text | cc-by-nd-4.0 | creative commons | this work is licensed under a creative commons attribution no ?deriv(?:ative)?s 4 0 international license
text | cc-by-nc-nd-4.0 | creative commons | this work is licensed under a creative commons attribution non ?commercial no ?deriv(?:ative)?s 4 0 international license
tag | cc-by-4.0 | licenses by | creativecommons org licenses by 4 0
tag | cc-by-3.0 | licenses by | creativecommons org licenses by 3 0
tag | cc-by-2.0 | licenses by | creativecommons org licenses by 2 [05]
tag | cc-by-sa-4.0 | licenses by | creativecommons org licenses by sa 4 0
tag | cc-by-sa-3.0 | licenses by | creativecommons org licenses by sa 3 0
tag | cc-by-sa-2.0 | licenses by | creativecommons org licenses by sa 2 [05]
tag | cc-by-nc-4.0 | licenses by | creativecommons org licenses by nc 4 0
tag | cc-by-nc-3.0 | licenses by | creativecommons org licenses by nc 3 0
tag | cc-by-nd-4.0 | licenses by | creativecommons org licenses by nd 4 0
tag | cc-by-nc-sa-4.0 | licenses by | creativecommons org licenses by nc sa 4 0
tag | cc-by-nc-nd-4.0 | licenses by | creativecommons org licenses by nc nd 4 0
name | cc-by-4.0 | cc by | cc by 4(?: 0)?
name | cc-by-3.0 | cc by | cc by 3(?: 0)?
name | cc-by-2.5 | cc by | cc by 2 5
name | cc-by-2.0 | cc by | cc by 2 0
name | cc-by-sa-4.0 | cc by sa | cc by sa 4(?: 0)?
name | cc-by-sa-3.0 | cc by sa | cc by sa 3(?: 0)?
name | cc-by-sa-2.5 | cc by sa | cc by sa 2 5
name | cc-by-nc-4.0 | cc by nc | cc by nc 4(?: 0)?
name | cc-by-nc-3.0 | cc by nc | cc by nc 3(?: 0)?
name | cc-by-nd-4.0 | cc by nd | cc by nd 4(?: 0)?
name | cc-by-nd-3.0 | cc by nd | cc by nd 3(?: 0)?
name | cc-by-nc-sa-4.0 | cc by nc sa | cc by nc sa 4(?: 0)?
name | cc-by-nc-sa-3.0 | cc by nc sa | cc by nc sa 3(?: 0)?
name | cc-by-nc-nd-4.0 | cc by nc nd | cc by nc nd 4(?: 0)?
name | cc-by-nc-nd-3.0 | cc by nc nd | cc by nc nd 3(?: 0)?
name | cc-by-4.0 | creative commons attribution | creative commons attribution 4 0(?: international)?
name | cc-by-sa-4.0 | creative commons attribution | creative commons attribution share ?alike 4 0(?: international)?
name | cc-by-sa-3.0 | creative commons attribution | creative commons attribution share ?alike 3 0(?: unported)?
name | cc-by-nc-4.0 | creative commons attribution | creative commons attribution non ?commercial 4 0(?: international)?
name | cc-by-nc-sa-4.0 | creative commons attribution | creative commons attribution non ?commercial share ?alike 4 0(?: international)?
hint | cc-by-sa | cc by sa | cc by sa
hint | cc-by-nc | cc by nc | cc by nc
hint | cc-by-nd | cc by nd | cc by nd
hint | cc-by-nc-sa | cc by nc sa | cc by nc sa
hint | cc-by-nc-nd | cc by nc nd | cc by nc nd
hint | creative-commons | creative commons | creative commons(?: attribution)? licen[sc]es?
text | unlicense | free and unencumbered | this is free and unencumbered software released into the public domain
tag | unlicense | spdx | spdx license identifier unlicense
tag | unlicense | unlicense org | (?:www )?unlicense org
name | unlicense | unlicense | the unlicense
text | public-domain | public domain | (?:hereby )?(?:dedicated?|released|placed|donated) (?:to|into|in) the public domain
hint | public-domain | public domain | this (?:work|file|code|software|document|text) is (?:in the )?public domain
text | wtfpl | do what the fuck | you just do what the fuck you want to
name | wtfpl | wtfpl | wtfpl(?: (?:version |v )?2)?
name | wtfpl | do what the fuck | do what the fuck you want to public licen[sc]e
tag | wtfpl | spdx | spdx license identifier wtfpl
text | zlib | altered source versions | altered source versions must be plainly marked as such and must not be misrepresented as being the original software
text | zlib | origin of this software | the origin of this software must not be misrepresented you must not claim that you wrote the original software
tag | zlib | spdx | spdx license identifier zlib
name | zlib | zlib | (?:the )?zlib(?: libpng)? licen[sc]e
text | libpng | png reference library | the png reference library is supplied as is
name | libpng | libpng | (?:the )?libpng licen[sc]e
text | bsl-1.0 | boost software | distributed under the boost software license version 1 0
text | bsl-1.0 | machine executable object | unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor
tag | bsl-1.0 | spdx | spdx license identifier bsl 1 0
tag | bsl-1.0 | boost org | (?:www )?boost org license 1 0 txt
name | bsl-1.0 | boost software | boost software licen[sc]e(?: (?:version |v )?1 0)?
text | artistic-2.0 | artistic license | the artistic license 2 0 copyright
tag | artistic-2.0 | spdx | spdx license identifier artistic 2 0
name | artistic-2.0 | artistic | (?:the )?artistic licen[sc]e (?:version |v )?2(?: 0)?
name | artistic-1.0 | artistic | (?:the )?artistic licen[sc]e (?:version |v )?1(?: 0)?
hint | artistic | artistic | (?:the )?artistic licen[sc]e
text | perl | same terms as perl | (?:it )?under the same terms as perl(?: itself)?
text | ofl-1.1 | open font | this font software is licensed under the sil open font license version 1 1
tag | ofl-1.1 | spdx | spdx license identifier ofl 1 1
tag | ofl-1.1 | scripts sil | scripts sil org ofl
name | ofl-1.1 | open font | (?:sil )?open font licen[sc]e(?: (?:version |v )?1 1)?
text | psf-2.0 | python software foundation | this license agreement is between the python software foundation
tag | psf-2.0 | spdx | spdx license identifier (?:psf 2 0|python 2 0)
name | psf-2.0 | python software foundation | python software foundation licen[sc]e(?: (?:version |v )?2)?
text | php-3.01 | php | this product includes php software freely available from
name | php-3.01 | php license | (?:the )?php license (?:version |v )?3 01
hint | php | php license | (?:the )?php license
text | ruby | ruby | (?:under|of) the same (?:license|terms) as ruby
name | ruby | ruby | (?:the )?ruby licen[sc]e
text | openssl | openssl project | this product includes software developed by the openssl project for use in the openssl toolkit
name | openssl | openssl | (?:the )?openssl licen[sc]e
text | ssleay | eric young | this product includes cryptographic software written by eric young
name | ntp | ntp license | (?:the )?ntp license
text | curl | curl | curl is licensed under a mit x derivate license
text | ijg | independent jpeg group | this software is based in part on the work of the independent jpeg group
text | ncsa | university of illinois | university of illinois ncsa open source license
tag | ncsa | spdx | spdx license identifier ncsa
tag | postgresql | spdx | spdx license identifier postgresql
name | postgresql | postgresql | (?:the )?postgresql licen[sc]e
text | postgresql | without a written agreement | without fee and without a written agreement is hereby granted
tag | afl-3.0 | spdx | spdx license identifier afl 3 0
name | afl-3.0 | academic free | academic free licen[sc]e(?: (?:version |v )?3 0)?
tag | osl-3.0 | spdx | spdx license identifier osl 3 0
name | osl-3.0 | open software | open software licen[sc]e(?: (?:version |v )?3 0)?
tag | ecl-2.0 | spdx | spdx license identifier ecl 2 0
name | ecl-2.0 | educational community | educational community licen[sc]e(?: (?:version |v )?2 0)?
tag | ms-pl | spdx | spdx license identifier ms pl
name | ms-pl | microsoft public | microsoft public licen[sc]e(?: ms pl)?
name | ms-rl | microsoft reciprocal | microsoft reciprocal licen[sc]e(?: ms rl)?
tag | upl-1.0 | spdx | spdx license identifier upl 1 0
name | upl-1.0 | universal permissive | universal permissive licen[sc]e(?: (?:version |v )?1 0)?
tag | odbl-1.0 | spdx | spdx license identifier odbl 1 0
tag | odbl-1.0 | opendatacommons | opendatacommons org licenses odbl(?: 1 0)?
name | odbl-1.0 | open database | open database licen[sc]e(?: odbl)?(?: v?1 0)?
name | odc-by-1.0 | open data commons | open data commons attribution licen[sc]e
name | pddl-1.0 | open data commons | open data commons public domain dedication(?: and)? licen[sc]e
name | ogl-uk-3.0 | open government | open government licen[sc]e (?:version |v )?v?3(?: 0)?
hint | ogl-uk | open government | open government licen[sc]e
name | cdla-permissive | community data | community data licen[sc]e agreement permissive(?: (?:version |v )?[12] 0)?
name | cdla-sharing | community data | community data licen[sc]e agreement sharing(?: (?:version |v )?1 0)?
tag | sspl-1.0 | spdx | spdx license identifier sspl 1 0
name | sspl-1.0 | server side public | server side public licen[sc]e(?: (?:version |v )?1)?
tag | busl-1.1 | spdx | spdx license identifier busl 1 1
name | busl-1.1 | business source | business source licen[sc]e(?: (?:version |v )?1 1)?
name | elastic-2.0 | elastic license | elastic license (?:version |v )?2 0
name | commons-clause | commons clause | commons clause (?:licen[sc]e )?condition(?: v?1 0)?
name | polyform-noncommercial | polyform | polyform noncommercial licen[sc]e(?: 1 0 0)?
name | openrail | openrail | (?:creativeml |bigscience )?(?:open )?openrail(?: m)?(?: licen[sc]e)?
name | rail | responsible ai | responsible ai licen[sc]e
name | w3c | w3c | w3c software (?:notice and licen[sc]e|and document notice and licen[sc]e)
text | unicode | unicode inc | unicode inc license agreement data files and software
name | unicode | unicode license | unicode license v3
name | vim | vim license | (?:the )?vim license
name | beerware | beer | (?:the )?beer ?ware licen[sc]e(?: revision 42)?
text | beerware | buy me a beer | you can buy me a beer in return
text | json | good not evil | the software shall be used for good not evil
name | cecill-2.1 | cecill | (?:licence )?cecill (?:version |v )?2 1
hint | cecill | cecill | cecill
name | qpl-1.0 | q public | (?:the )?q public licen[sc]e(?: version 1 0)?
name | sleepycat | sleepycat | (?:the )?sleepycat licen[sc]e
name | lppl-1.3c | latex project public | latex project public licen[sc]e(?: (?:version |v )?1 3c?)?
text | lppl-1.3c | latex project public | this work may be distributed and or modified under the conditions of the latex project public license
name | mulan-psl-2.0 | mulan | mulan (?:psl|permissive software licen[sc]e) ?(?:version |v )?v?2
name | blueoak-1.0.0 | blue oak | blue oak model licen[sc]e(?: 1 0 0)?
name | hippocratic | hippocratic | hippocratic licen[sc]e(?: (?:version )?[0-9]+(?: [0-9]+)*)?
text | all-rights-reserved | all rights reserved | copyright (?:c )?(?:\S+ ){1,12}all rights reserved
hint | all-rights-reserved | all rights reserved | all rights reserved
text | proprietary | strictly prohibited | unauthori[sz]ed (?:copying|use|reproduction|distribution)(?: \S+){0,12} is strictly prohibited
text | proprietary | proprietary and confidential | proprietary and confidential
hint | commercial | commercial license | commercial license(?: agreement)?
hint | eula | end user license | end user license agreement
hint | permissive | permissive license | permissive license
text | by-permission | reprinted with permission | reprinted with permission(?: of (?:the )?(?:author|publisher)s?)?
hint | gpl-compatible | gpl compatible | gpl compatible(?: licen[sc]e)?
"""


def rules() -> list[tuple[int, float, str, str, str]]:
    """(priority, strength, label, keyword, expression), in written order."""
    out = []
    for line in RULES.strip().splitlines():
        kind, label, keyword, expression = (x.strip() for x in line.split("|", 3))
        out.append((PRIORITY[kind], STRENGTH[kind], label, keyword, expression))
    return out
