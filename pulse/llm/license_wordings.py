"""Wordings of licenses and notices as templates: label, rare word, wording.

A template is tried in texts that hold its rare word. The label of a license is given for
its whole wording, or for a sentence that names it ("licensed under the MIT License"). The
first sentence alone has a label of its own, ending in ``-opening``: what follows it may
take the license back.
"""


def optional(wording):
    return f"<<optional>> {wording} <</optional>>"


def words(least, most):
    return f"<<var {least}-{most}>>"


# The public wordings of the licenses, with their replaceable parts marked.

_MIT_OPENING = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of "
    + words(1, 8)
    + " and associated documentation files (the " + words(1, 2) + "), to deal in the " + words(1, 2)
    + " without restriction, including without limitation the rights to use, copy, modify, merge,"
    " publish, distribute, sublicense, and/or sell copies of the " + words(1, 2)
    + ", and to permit persons to whom the " + words(1, 2)
    + " is furnished to do so, subject to the following conditions"
)

_AS_IS = (
    "THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED,"
    " INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR"
    " PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL " + words(1, 16)
    + " BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT"
    " OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
    " DEALINGS IN THE SOFTWARE"
)

_MIT = (
    _MIT_OPENING + ": The above copyright notice and this permission notice "
    + optional("(including the next paragraph)")
    + " shall be included in all copies or substantial portions of the " + words(1, 2) + ". " + _AS_IS
)

_BSD_OPENING = (
    "Redistribution and use in source and binary forms, with or without modification, are"
    " permitted provided that the following conditions are met"
)

_BSD_CONDITIONS = (
    ": " + optional("1") + " Redistributions of source code must retain the above copyright notice,"
    " this list of conditions and the following disclaimer. "
    + optional("2") + " Redistributions in binary form must reproduce the above copyright notice,"
    " this list of conditions and the following disclaimer in the documentation and/or other"
    " materials provided with the distribution. "
)

_BSD_NAMES = (
    optional("3") + " Neither the name of " + words(1, 16) + " nor the names of " + words(1, 6)
    + " may be used to endorse or promote products derived from this software without specific"
    " prior written permission. "
)

_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY " + words(1, 16) + " \"AS IS\" AND ANY EXPRESS OR IMPLIED"
    " WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND"
    " FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL " + words(1, 16)
    + " BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES"
    " (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,"
    " DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY,"
    " WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING"
    " IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE"
)

_ISC_OPENING = (
    "Permission to use, copy, modify, and" + optional("/or")
    + " distribute this software for any purpose with or without fee is hereby granted, provided"
    " that the above copyright notice and this permission notice appear in all copies"
)

_ISC = (
    _ISC_OPENING + ". THE SOFTWARE IS PROVIDED \"AS IS\" AND " + words(1, 12)
    + " DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF"
    " MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL " + words(1, 12)
    + " BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES"
    " WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT,"
    " NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR"
    " PERFORMANCE OF THIS SOFTWARE"
)

_ZLIB = (
    "This software is provided 'as-is', without any express or implied warranty. In no event will"
    " " + words(1, 12) + " be held liable for any damages arising from the use of this software."
    " Permission is granted to anyone to use this software for any purpose, including commercial"
    " applications, and to alter it and redistribute it freely, subject to the following"
    " restrictions: " + optional("1") + " The origin of this software must not be misrepresented;"
    " you must not claim that you wrote the original software. If you use this software in a"
    " product, an acknowledgment in the product documentation would be appreciated but is not"
    " required. " + optional("2") + " Altered source versions must be plainly marked as such, and"
    " must not be misrepresented as being the original software. " + optional("3")
    + " This notice may not be removed or altered from any source distribution"
)

_UNLICENSE_OPENING = (
    "This is free and unencumbered software released into the public domain"
)

_UNLICENSE = (
    _UNLICENSE_OPENING + ". Anyone is free to copy, modify, publish, use, compile, sell, or"
    " distribute this software, either in source code form or as a compiled binary, for any"
    " purpose, commercial or non-commercial, and by any means. In jurisdictions that recognize"
    " copyright laws, the author or authors of this software dedicate any and all copyright"
    " interest in the software to the public domain. We make this dedication for the benefit of"
    " the public at large and to the detriment of our heirs and successors. We intend this"
    " dedication to be an overt act of relinquishment in perpetuity of all present and future"
    " rights to this software under copyright law. " + _AS_IS
)

_APACHE_SENTENCE = "licensed under the Apache License, Version 2.0"

_APACHE = (
    _APACHE_SENTENCE + " (the \"License\"); you may not use " + words(1, 4)
    + " except in compliance with the License. You may obtain a copy of the License at "
    + words(1, 12) + " Unless required by applicable law or agreed to in writing, software"
    " distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR"
    " CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language"
    " governing permissions and limitations under the License"
)

_MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a"
    " copy of the MPL was not distributed with this file, You can obtain one at " + words(1, 1)
    + " " + optional("www") + " mozilla.org/MPL/2.0"
)

_CC0 = (
    "To the extent possible under law, " + words(1, 16)
    + " waived all copyright and related or neighboring rights to " + words(1, 16)
)

# label, name, version
_GNU = (
    ("gpl-2.0", "GNU General Public License", "2"),
    ("gpl-3.0", "GNU General Public License", "3"),
    ("lgpl-2.0", "GNU Library General Public License", "2"),
    ("lgpl-2.1", "GNU Lesser General Public License", "2.1"),
    ("lgpl-3.0", "GNU Lesser General Public License", "3"),
    ("agpl-3.0", "GNU Affero General Public License", "3"),
)

# code, name
_CC = (
    ("BY", "Attribution"),
    ("BY-SA", "Attribution-ShareAlike"),
    ("BY-NC", "Attribution-NonCommercial"),
    ("BY-ND", "Attribution-NoDerivatives"),
    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
    ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"),
)

_WORK = optional("this work is")
_TERMS = optional("the terms of")


def _gnu(label, name, version):
    """The sentence that names the license, the grant alone, and the whole notice.

    A grant is found from its "is" on, as its subject may be of any length. The lesser
    licenses are given for their notices only, not for a sentence that names them.
    """
    later = optional("or " + optional("(at your option)") + " any later version")
    grant = (
        "is free software: you can redistribute it and/or modify it under the terms of "
    )
    published = " as published by the Free Software Foundation"
    numbered = f"version {version}"
    grants = (
        grant + f"the {name}{published}; " + optional("either") + f" {numbered} "
        + optional("of the License") + " " + later,
        grant + f"the {name}, {numbered} {later} {published}",
    )
    rest = (
        " " + words(1, 4) + " is distributed in the hope that it will be useful, but WITHOUT ANY"
        " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR"
        f" PURPOSE. See the {name} for more details"
    )
    copy = optional(
        f"You should have received a copy of the {name} along with " + words(1, 4)
        + optional("If not, see " + words(1, 1) + " www.gnu.org/licenses")
    )
    sentence = f"{_WORK} licensed under {_TERMS} the {name}, {numbered} {later}"
    if not label.startswith("lgpl"):
        yield label, "gnu", sentence
    for text in grants:
        yield label + "-opening", "gnu", text
        yield label, "gnu", f"{text}. {rest}. {copy}"


def _creative_commons(code, name):
    """The license's name in full and by its code."""
    for version in ("3.0", "4.0"):
        label = f"cc-{code.lower()}-{version}"
        under = f"{_WORK} licensed under {optional('a')} {optional(_TERMS + ' the')}"
        place = optional("International") if version == "4.0" else optional("Unported")
        yield label, "creative", (
            f"{under} Creative Commons {name} {version} {place} {optional('Public')} License"
        )
        yield label, "cc", f"{under} CC {code} {version} {optional('license')}"


TEMPLATES = (
    ("apache-2.0", "apache", _APACHE_SENTENCE),
    ("apache-2.0", "apache", _APACHE),
    ("mit", "mit", optional("this " + words(1, 2) + " is") + f" released under {_TERMS} the MIT License"),
    ("mit", "mit", f"{_WORK} licensed under {_TERMS} the MIT License"),
    ("mit-opening", "granted", _MIT_OPENING),
    ("mit", "granted", _MIT),
    ("isc-opening", "granted", _ISC_OPENING),
    ("isc", "granted", _ISC),
    ("bsd-opening", "redistribution", _BSD_OPENING),
    ("bsd-2-clause", "redistribution", _BSD_OPENING + _BSD_CONDITIONS + _BSD_DISCLAIMER),
    ("bsd-3-clause", "redistribution", _BSD_OPENING + _BSD_CONDITIONS + _BSD_NAMES + _BSD_DISCLAIMER),
    ("zlib", "misrepresented", _ZLIB),
    ("unlicense-opening", "unencumbered", _UNLICENSE_OPENING),
    ("unlicense", "unencumbered", _UNLICENSE),
    ("mpl-2.0", "mozilla", _MPL),
    ("cc0-1.0", "waived", _CC0),
    *(t for row in _GNU for t in _gnu(*row)),
    *(t for row in _CC for t in _creative_commons(*row)),
    ("copyright", "copyright", "Copyright " + optional("(c)") + " " + words(1, 10) + " All rights reserved"),
)
