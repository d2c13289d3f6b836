"""Licence texts and notices as template markup.

Plain words are mandatory.  ``[[ ... ]]`` is an optional region, which may hold replaceable words; ``{{a,b}}`` stands for a to b replaceable words,
such as the names in a copyright line.  Case, punctuation and line breaks do not count.  The wordings are fixed values: those
of the licences' own texts.
"""

from __future__ import annotations

_COPYRIGHT = "[[copyright [[c]] {{1,12}}]] [[all rights reserved]]"
_AS_IS = "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and [[non infringement]] [[noninfringement]]"
_BSD_WARRANTY = (
    "this software is provided by {{1,14}} as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed "
    "in no event shall {{1,14}} be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or "
    "profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software "
    "even if advised of the possibility of such damage"
)
_LIABLE = "be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection"
_MIT_GRANT = (
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation "
    "the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"
)
_MIT_CONDITIONS = "subject to the following conditions the above copyright notice and this permission notice [[including the next paragraph]] shall be included in all copies or substantial portions of the software"
_MIT_END = f"{_AS_IS} in no event shall {{{{1,8}}}} {_LIABLE} with the software or the use or other dealings in the software"
_ISC_END = (
    "the software is provided as is and {{1,6}} disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall {{1,6}} be liable for any special "
    "direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising out of or in connection with "
    "the use or performance of this software"
)
_NO_PROMOTION = "shall not be used in advertising or otherwise to promote the sale use or other dealings in this software without prior written authorization"
_BSD_TWO = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met [[1]] [[a]] redistributions of source code must retain the above "
    "copyright notice this list of conditions and the following disclaimer [[2]] [[b]] redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in "
    "the documentation and or other materials provided with the distribution"
)
_GNU_GRANT = (
    "is free software you can redistribute it and or modify it under the terms of the gnu {{KIND}} general public license as published by the free software foundation either version {{1,2}} of the license or [[at your option]] any later version"
)
_GNU_WARRANTY = "is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu {{KIND}} general public license for more details"


def _gnu(kind: str) -> str:
    return f"{_GNU_GRANT} {{{{1,4}}}} {_GNU_WARRANTY}".replace("{{KIND}} ", kind)


#: Label: template markup.
TEMPLATES = {
    "agpl-header": _gnu("affero "),
    "apache-2.0-header": (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at [[http]] [[https]] www apache org licenses "
        "license 2 0 [[txt]] [[html]] unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either "
        "express or implied see the license for the specific language governing permissions and limitations under the license"
    ),
    "apache-2.0-notice": "licensed under the apache license [[version]] 2 0 [[the license]]",
    "bsd-2-clause": f"{_BSD_TWO} {_BSD_WARRANTY}",
    "bsd-3-clause": (
        f"{_BSD_TWO} [[3]] [[c]] neither the name of {{{{1,10}}}} nor the names of [[its]] [[other]] contributors may be used to endorse or promote products derived from this software without specific prior written permission {_BSD_WARRANTY}"
    ),
    "0bsd": f"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted {_ISC_END}",
    "beerware": (
        "the beer ware license revision 42 {{1,4}} wrote this file as long as you retain this notice you can do whatever you want with this stuff if we meet some day and you think this stuff is worth it you can buy me a beer "
        "in return"
    ),
    "bsl-1.0": (
        "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute "
        "execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following the copyright notices in the "
        "software and this entire statement including the above license grant this restriction and the following disclaimer must be included in all copies of the software in whole or in part and all derivative works of the "
        "software unless such copies or derivative works are solely in the form of machine executable object code generated by a source language processor the software is provided as is without warranty of any kind express "
        "or implied including but not limited to the warranties of merchantability fitness for a particular purpose title and non infringement in no event shall the copyright holders or anyone distributing the software be "
        "liable for any damages or other liability whether in contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"
    ),
    "cc-notice": "licensed under [[a]] [[the]] [[creative commons]] cc by [[nc]] [[sa]] [[nd]] {{1,1}} 0 [[international]]",
    "cc-long-notice": "licensed under [[a]] [[the]] creative commons attribution [[noncommercial]] [[non commercial]] [[sharealike]] [[share alike]] [[noderivatives]] [[no derivatives]] {{1,1}} 0 [[international]] [[unported]] license",
    "copyright-line": "copyright [[c]] {{1,8}} all rights reserved",
    "gnu-notice": "this {{1,3}} is licensed under the gnu [[lesser]] [[affero]] general public license [[version {{1,1}}]]",
    "gpl-header": _gnu(""),
    "curl": (
        f"permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies {_AS_IS} of "
        f"third party rights in no event shall the authors or copyright holders {_LIABLE} with the software or the use or other dealings in the software except as contained in this notice the name of a copyright holder "
        f"{_NO_PROMOTION} of the copyright holder"
    ),
    "isc": f"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies {_ISC_END}",
    "lgpl-header": _gnu("lesser "),
    "mit": f"{_COPYRIGHT} {_MIT_GRANT} {_MIT_CONDITIONS} {_MIT_END}",
    "mit-0": f"{_COPYRIGHT} {_MIT_GRANT} {_MIT_END}",
    "mit-notice": "[[released]] [[licensed]] [[available]] [[distributed]] under the [[terms of the]] mit license",
    "mit-permission": "permission is hereby granted free of charge to any person obtaining a copy of this software",
    "mpl-2.0-header": (
        "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with this file you can obtain one at [[http]] [[https]] mozilla org mpl 2 0"
    ),
    "ncsa": (
        f"{_MIT_GRANT.replace('to deal in', 'to deal with')} subject to the following conditions redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimers "
        "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimers in the documentation and or other materials provided with the distribution neither the "
        "names of {{1,16}} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission "
        f"{_AS_IS} in no event shall the contributors or copyright holders {_LIABLE} with the software or the use or other dealings with the software"
    ),
    "postgresql": (
        "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted provided that the above copyright notice and this "
        "paragraph and the following two paragraphs appear in all copies in no event shall {{1,8}} be liable to any party for direct indirect special incidental or consequential damages including lost profits arising out of "
        "the use of this software and its documentation even if {{1,8}} has been advised of the possibility of such damage {{1,8}} specifically disclaims any warranties including but not limited to the implied warranties of "
        "merchantability and fitness for a particular purpose the software provided hereunder is on an as is basis and {{1,8}} [[has]] [[have]] no obligations to provide maintenance support updates enhancements or modifications"
    ),
    "unlicense": (
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any "
        "purpose commercial or non commercial and by any means in jurisdictions that recognize copyright laws the author or authors of this software dedicate any and all copyright interest in the software to the public "
        "domain we make this dedication for the benefit of the public at large and to the detriment of our heirs and successors we intend this dedication to be an overt act of relinquishment in perpetuity of all present and "
        f"future rights to this software under copyright law {_AS_IS} in no event shall the authors {_LIABLE} with the software or the use or other dealings in the software for more information please refer to [[http]] "
        "[[https]] unlicense org"
    ),
    "wtfpl": "do what the fuck you want to public license terms and conditions for copying distribution and modification 0 you just do what the fuck you want to",
    "x11": (
        f"{_MIT_GRANT} subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software {_AS_IS} in no event shall {{{{1,8}}}} "
        f"{_LIABLE} with the software or the use or other dealings in the software except as contained in this notice the name of {{{{1,8}}}} {_NO_PROMOTION} from {{{{1,8}}}}"
    ),
    "zlib": (
        "this software is provided as is without any express or implied warranty in no event will {{1,6}} be held liable for any damages arising from the use of this software permission is granted to anyone to use this "
        "software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions [[1]] the origin of this software must not be misrepresented you must not "
        "claim that you wrote the original software if you use this software in a product an acknowledgment in the product documentation would be appreciated but is not required [[2]] altered source versions must be plainly "
        "marked as such and must not be misrepresented as being the original software [[3]] this notice may not be removed or altered from any source distribution"
    ),
}
