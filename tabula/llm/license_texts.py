"""Public licence texts and the one-line notices that name a licence."""

from __future__ import annotations

_DISCLAIMER = (
    'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO '
    "THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE "
    "AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
    "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS "
    "IN THE SOFTWARE.")
_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so")
_ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted")
_ISC_END = (
    'THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
    "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
    "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE.")
_BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met:\n"
    "1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer.\n"
    "2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution.\n")
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission.\n")
_BSD_END = (
    'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
    "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
    "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
    "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
    "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
    "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
    "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")

FULL_TEXTS = {
    "MIT": "MIT License\n" + _GRANT + ", subject to the following conditions:\nThe above copyright notice and this "
           "permission notice shall be included in all copies or substantial portions of the Software.\n" + _DISCLAIMER,
    "MIT-0": "MIT No Attribution\n" + _GRANT + ".\n" + _DISCLAIMER,
    "ISC": "ISC License\n" + _ISC_GRANT + ", provided that the above copyright notice and this permission notice appear "
           "in all copies.\n" + _ISC_END,
    "0BSD": "Zero-Clause BSD\n" + _ISC_GRANT + ".\n" + _ISC_END,
    "BSD-2-Clause": "BSD 2-Clause License\n" + _BSD_HEAD + _BSD_END,
    "BSD-3-Clause": "BSD 3-Clause License\n" + _BSD_HEAD + _BSD_THIRD + _BSD_END,
}

# SPDX identifier -> names by which notices call the licence
NAMES = {
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License", "Apache-2.0"),
    "MIT": ("MIT License", "MIT"),
    "ISC": ("ISC License", "ISC"),
    "BSD-2-Clause": ("BSD 2-Clause License", "BSD-2-Clause"),
    "BSD-3-Clause": ("BSD 3-Clause License", "BSD-3-Clause"),
    "GPL-2.0": ("GNU General Public License, version 2", "GNU GPL v2", "GPL-2.0"),
    "GPL-3.0": ("GNU General Public License, version 3", "GNU GPL v3", "GPL-3.0"),
    "LGPL-3.0": ("GNU Lesser General Public License, version 3", "GNU LGPL v3", "LGPL-3.0"),
    "AGPL-3.0": ("GNU Affero General Public License, version 3", "GNU AGPL v3", "AGPL-3.0"),
    "MPL-2.0": ("Mozilla Public License, version 2.0", "MPL 2.0", "MPL-2.0"),
    "CC0-1.0": ("CC0 1.0", "Creative Commons Zero 1.0", "CC0-1.0"),
    "CC-BY-4.0": ("CC BY 4.0", "Creative Commons Attribution 4.0", "CC-BY-4.0"),
    "CC-BY-SA-4.0": ("CC BY-SA 4.0", "Creative Commons Attribution-ShareAlike 4.0", "CC-BY-SA-4.0"),
    "CC-BY-NC-4.0": ("CC BY-NC 4.0", "Creative Commons Attribution-NonCommercial 4.0", "CC-BY-NC-4.0"),
    "Unlicense": ("Unlicense",),
}
FRAMES = ("Licensed under {}", "Licensed under the {}", "Released under {}", "Released under the {}",
          "This work is licensed under {}", "This work is licensed under the {}", "This software is released under the {}",
          "Distributed under the {}", "SPDX-License-Identifier: {}")


def notices() -> list[tuple[str, str]]:
    """Every name of every licence in every frame."""
    return [(spdx, frame.format(name)) for spdx, names in NAMES.items() for name in names for frame in FRAMES]


def variants() -> list[tuple[str, str]]:
    """Usual other forms of the whole texts: without the title, BSD with bullets for numbers
    and with the older third clause."""
    out = []
    for spdx, text in FULL_TEXTS.items():
        title, body = text.split("\n", 1)
        bodies = [body]
        if spdx.startswith("BSD"):
            thirds = [_BSD_THIRD] if spdx == "BSD-3-Clause" else [""]
            if spdx == "BSD-3-Clause":
                thirds += [_BSD_THIRD.replace("the copyright holder nor the names of its", who)
                           for who in ("the copyright holders nor the names of its", "the University nor the names of its",
                                       "the copyright holder nor the names of their", "the copyright owner nor the names of its")]
            numbered = [_BSD_HEAD + third + _BSD_END for third in thirds]
            bodies = [form for x in numbered for form in (x, x.replace("\n1. ", "\n* ").replace("\n2. ", "\n* ").replace("3. N", "* N"))]
        heads = [title, {"MIT": "The MIT License (MIT)", "BSD-3-Clause": "BSD 3-Clause \"New\" or \"Revised\" License",
                         "BSD-2-Clause": "BSD 2-Clause \"Simplified\" License"}.get(spdx, title), ""]
        if spdx == "MIT":
            heads.append("The MIT License")
        out += [(spdx, f"{head}\n{x}") for x in bodies for head in dict.fromkeys(heads)]
    return out
