"""Texts of common licenses that the registered scan looks for.

A license has several: its body, or of a body of many pages the opening; the header that
files carry (which the full texts of GPL, LGPL, AGPL, Apache and MPL repeat at their end);
and one-sentence notices. ``required`` phrases stand in this license or version only: texts
that differ in a few words from another's count only with all of them.
"""

from __future__ import annotations

from typing import NamedTuple


class Template(NamedTuple):
    license_id: str
    text: str
    required: tuple[str, ...] = ()


_MIT_GRANT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal in the Software
without restriction, including without limitation the rights to use, copy, modify, merge,
publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to
whom the Software is furnished to do so"""
_MIT_NOTICE = """, subject to the following conditions: The above copyright notice and this
permission notice shall be included in all copies or substantial portions of the Software."""
_MIT_WARRANTY = """. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR
PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY
CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING
FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""

_BSD_CONDITIONS = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met: 1. Redistributions
of source code must retain the above copyright notice, this list of conditions and the following
disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list
of conditions and the following disclaimer in the documentation and/or other materials provided
with the distribution. """
_BSD_NAMES = """3. Neither the name of the copyright holder nor the names of its contributors may
be used to endorse or promote products derived from this software without specific prior written
permission. """
_BSD_WARRANTY = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND
ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF
MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT
HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR
CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES;
LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF
LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING
IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

_ISC_GRANT = """Permission to use, copy, modify, and/or distribute this software for any purpose
with or without fee is hereby granted"""
_ISC_NOTICE = """, provided that the above copyright notice and this permission notice appear in
all copies"""
_ISC_WARRANTY = """. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT
SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES
WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE
OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS
SOFTWARE."""

_APACHE = """Licensed under the Apache License, Version 2.0 (the "License"); you may not use this
file except in compliance with the License. You may obtain a copy of the License at
http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing,
software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR
CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing
permissions and limitations under the License."""
_APACHE_OPENING = """Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND
CONDITIONS FOR USE, REPRODUCTION, AND DISTRIBUTION 1. Definitions. "License" shall mean the terms and
conditions for use, reproduction, and distribution as defined by Sections 1 through 9 of this document.
"Licensor" shall mean the copyright owner or entity authorized by the copyright owner that is granting
the License. "Legal Entity" shall mean the union of the acting entity and all other entities that
control, are controlled by, or are under common control with that entity."""

_MPL = """This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a
copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."""
_MPL_OPENING = """Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each
individual or legal entity that creates, contributes to the creation of, or owns Covered Software. 1.2.
"Contributor Version" means the combination of the Contributions of others (if any) used by a
Contributor and that particular Contributor's Contribution."""

_UNLICENSE = """This is free and unencumbered software released into the public domain. Anyone is free
to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or
as a compiled binary, for any purpose, commercial or non-commercial, and by any means."""
_ZLIB = """This software is provided 'as-is', without any express or implied warranty. In no event will
the authors be held liable for any damages arising from the use of this software. Permission is granted
to anyone to use this software for any purpose, including commercial applications, and to alter it and
redistribute it freely, subject to the following restrictions: 1. The origin of this software must not be
misrepresented; you must not claim that you wrote the original software. If you use this software in a
product, an acknowledgment in the product documentation would be appreciated but is not required. 2.
Altered source versions must be plainly marked as such, and must not be misrepresented as being the
original software. 3. This notice may not be removed or altered from any source distribution."""
_BOOST = """Permission is hereby granted, free of charge, to any person or organization obtaining a copy
of the software and accompanying documentation covered by this license (the "Software") to use, reproduce,
display, distribute, execute, and transmit the Software, and to prepare derivative works of the Software,
and to permit third-parties to whom the Software is furnished to do so, all subject to the following"""
_CC0 = """has waived all copyright and related or neighboring rights to"""


def _gnu_header(kind: str, version: str, thing: str = "This program") -> str:
    name = f"GNU {kind}General Public License"
    return f"""{thing} is free software: you can redistribute it and/or modify it under the terms of
the {name} as published by the Free Software Foundation, either version {version} of the License, or (at
your option) any later version. {thing} is distributed in the hope that it will be useful, but WITHOUT
ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.
See the {name} for more details. You should have received a copy of the {name} along with"""


def _gnu_only(kind: str, version: str) -> str:
    return f"""under the terms of the GNU {kind}General Public License version {version} as published
by the Free Software Foundation"""


def _gnu(license_id: str, kind: str, version: str, opening: str, opening_says: tuple[str, ...]) -> list[Template]:
    name = f"GNU {kind}General Public License"
    own = (f"the {name} as published", f"version {version} of the License")
    return [
        Template(license_id, _gnu_header(kind, version), own),
        Template(license_id, _gnu_only(kind, version), (f"{name} version {version} as published",)),
        Template(
            license_id,
            f"This work is licensed under the {name}, version {version}.",
            (f"the {name} version {version}",),
        ),
        Template(license_id, opening, opening_says),
    ]


_COPYING = """Everyone is permitted to copy and distribute verbatim copies of this license document, but
changing it is not allowed."""
_GPL3 = f"""GNU GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software Foundation,
Inc. {_COPYING} Preamble The GNU General Public License is a free, copyleft license for software and other
kinds of works. The licenses for most software and other practical works are designed to take away your
freedom to share and change the works. By contrast, the GNU General Public License is intended to guarantee
your freedom to share and change all versions of a program--to make sure it remains free software for all
its users."""
_GPL2 = f"""GNU GENERAL PUBLIC LICENSE Version 2, June 1991 Copyright (C) 1989, 1991 Free Software
Foundation, Inc. {_COPYING} Preamble The licenses for most software are designed to take away your freedom
to share and change it. By contrast, the GNU General Public License is intended to guarantee your freedom
to share and change free software--to make sure the software is free for all its users."""
_AGPL3 = f"""GNU AFFERO GENERAL PUBLIC LICENSE Version 3, 19 November 2007 Copyright (C) 2007 Free Software
Foundation, Inc. {_COPYING} Preamble The GNU Affero General Public License is a free, copyleft license for
software and other kinds of works, specifically designed to ensure cooperation with the community in the
case of network server software."""
_LGPL3 = f"""GNU LESSER GENERAL PUBLIC LICENSE Version 3, 29 June 2007 Copyright (C) 2007 Free Software
Foundation, Inc. {_COPYING} This version of the GNU Lesser General Public License incorporates the terms
and conditions of version 3 of the GNU General Public License, supplemented by the additional permissions
listed below."""
_LGPL21 = f"""GNU LESSER GENERAL PUBLIC LICENSE Version 2.1, February 1999 Copyright (C) 1991, 1999 Free
Software Foundation, Inc. {_COPYING} [This is the first released version of the Lesser GPL. It also counts
as the successor of the GNU Library Public License, version 2, hence the version number 2.1.]"""

#: Creative Commons licenses: id → elements of the full name, and of the short name.
_COMMONS = {
    "CC-BY": ("Attribution", "CC BY"),
    "CC-BY-SA": ("Attribution-ShareAlike", "CC BY-SA"),
    "CC-BY-ND": ("Attribution-NoDerivatives", "CC BY-ND"),
    "CC-BY-NC": ("Attribution-NonCommercial", "CC BY-NC"),
    "CC-BY-NC-SA": ("Attribution-NonCommercial-ShareAlike", "CC BY-NC-SA"),
    "CC-BY-NC-ND": ("Attribution-NonCommercial-NoDerivatives", "CC BY-NC-ND"),
}

TEMPLATES: tuple[Template, ...] = (
    Template("MIT", _MIT_GRANT + _MIT_NOTICE + _MIT_WARRANTY, ("this permission notice shall be included",)),
    Template("MIT-0", _MIT_GRANT + _MIT_WARRANTY, ("furnished to do so the software is provided",)),
    Template("MIT", "Released under the MIT License."),
    Template("MIT", "Licensed under the MIT License."),
    Template("BSD-3-Clause", _BSD_CONDITIONS + _BSD_NAMES + _BSD_WARRANTY, ("neither the name of",)),
    Template("BSD-2-Clause", _BSD_CONDITIONS + _BSD_WARRANTY, ("with the distribution this software is provided",)),
    Template("ISC", _ISC_GRANT + _ISC_NOTICE + _ISC_WARRANTY, ("this permission notice appear in all copies",)),
    Template("0BSD", _ISC_GRANT + _ISC_WARRANTY, ("is hereby granted the software is provided",)),
    Template("Apache-2.0", _APACHE, ("apache license version 2 0",)),
    Template("Apache-2.0", _APACHE_OPENING, ("apache license version 2 0",)),
    Template("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    Template("MPL-2.0", _MPL, ("mozilla public license v 2 0",)),
    Template("MPL-2.0", _MPL.split(" If a")[0], ("mozilla public license v 2 0",)),
    Template("MPL-2.0", _MPL_OPENING, ("mozilla public license version 2 0",)),
    *_gnu("GPL-3.0", "", "3", _GPL3, ("gnu general public license version 3",)),
    *_gnu("GPL-2.0", "", "2", _GPL2, ("gnu general public license version 2",)),
    *_gnu("AGPL-3.0", "Affero ", "3", _AGPL3, ("gnu affero general public license version 3",)),
    *_gnu("LGPL-3.0", "Lesser ", "3", _LGPL3, ("gnu lesser general public license version 3",)),
    *_gnu("LGPL-2.1", "Lesser ", "2.1", _LGPL21, ("gnu lesser general public license version 2 1",)),
    Template("LGPL-2.1", _gnu_header("Lesser ", "2.1", "This library"), ("version 2 1 of the license",)),
    Template("Unlicense", _UNLICENSE),
    Template("Zlib", _ZLIB),
    Template("BSL-1.0", _BOOST),
    Template("CC0-1.0", _CC0),
    *(
        Template(
            f"{key}-4.0",
            f"This work is licensed under a Creative Commons {name} 4.0 International License.",
            (f"creative commons {name} 4 0",),
        )
        for key, (name, _) in _COMMONS.items()
    ),
    *(Template(f"{key}-4.0", f"Licensed under {short} 4.0.") for key, (_, short) in _COMMONS.items()),
)
