"""Known licence texts and notices, by SPDX identifier.

Fixed values: the wording of the licences themselves.  Copyright lines are
left out, as the canonical form drops them.  Long texts are the files of
known_licences/, <identifier>.<variant>.txt."""

from pathlib import Path

_MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR
IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY,
FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE
AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER
LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM,
OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE
SOFTWARE."""

_ISC = """Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH
REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY
AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT,
INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM
LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR
OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR
PERFORMANCE OF THIS SOFTWARE."""

_0BSD = _ISC.replace(""", provided that the above
copyright notice and this permission notice appear in all copies""", "")

_BSD_2 = """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE
IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE
FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL
DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR
SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER
CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY,
OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE
OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

LICENCES = (
    ("MIT", _MIT),
    ("MIT", "MIT License\n\n" + _MIT),
    ("MIT", "Released under the MIT License."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("ISC", _ISC),
    ("ISC", "ISC License\n\n" + _ISC),
    ("0BSD", _0BSD),
    ("BSD-2-Clause", _BSD_2),
    ("BSD-2-Clause", "BSD 2-Clause License\n\n" + _BSD_2),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0-only"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "SPDX-License-Identifier: CC-BY-NC-4.0"),
)

# spellings that count as the same word: (variant, canonical), both in the canonical alphabet
EQUIVALENT = (
    ("licence", "license"), ("sub license", "sublicense"), ("non infringement", "noninfringement"),
    ("organisation", "organization"), ("authoris", "authoriz"), ("acknowledgement", "acknowledgment"),
    ("copyright owner", "copyright holder"), ("per cent", "percent"), ("https", "http"),
)

_BSD_3 = _BSD_2.replace("""THIS SOFTWARE IS""", """3. Neither the name of the copyright holder nor the names of its contributors
   may be used to endorse or promote products derived from this software
   without specific prior written permission.

THIS SOFTWARE IS""", 1)

_APACHE_HEADER = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""

_MPL_HEADER = """This Source Code Form is subject to the terms of the Mozilla Public
License, v. 2.0. If a copy of the MPL was not distributed with this
file, You can obtain one at {}://mozilla.org/MPL/2.0/."""

_GNU_HEADER = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU {name} as published by
the Free Software Foundation, {version}.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU {name} for more details.

You should have received a copy of the GNU {name}
along with this program.  If not, see <https://www.gnu.org/licenses/>."""

#: names of a licence in one-line notices
_NAMES = {
    "MIT": ("MIT License", "MIT"), "ISC": ("ISC License",), "0BSD": ("Zero-Clause BSD License", "BSD Zero Clause License"),
    "BSD-2-Clause": ("BSD 2-Clause License", "2-Clause BSD License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "3-Clause BSD License", "New BSD License", "Modified BSD License"),
    "Apache-2.0": ("Apache License, Version 2.0", "Apache License 2.0", "Apache 2.0 License"),
    "MPL-2.0": ("Mozilla Public License 2.0", "Mozilla Public License, Version 2.0", "Mozilla Public License, v. 2.0"),
    "Zlib": ("zlib License",), "Unlicense": ("Unlicense",), "BSL-1.0": ("Boost Software License, Version 1.0", "Boost Software License 1.0"),
    "EPL-2.0": ("Eclipse Public License 2.0", "Eclipse Public License, Version 2.0", "Eclipse Public License v2.0"),
    **{f"{k}-{v}{suffix}": tuple(f"{n}{tail}" for n in (f"GNU {name}, version {v[0] if v.endswith('.0') else v}", f"GNU {name} version {v[0] if v.endswith('.0') else v}",
                                                        f"GNU {name} v{v}", f"GNU {k} v{v[0] if v.endswith('.0') else v}"))
       for k, name, versions in (("GPL", "General Public License", ("2.0", "3.0")), ("LGPL", "Lesser General Public License", ("2.1", "3.0")),
                                 ("AGPL", "Affero General Public License", ("3.0",)))
       for v in versions for suffix, tail in (("", ""), ("-or-later", " or later"), ("-or-later", ", or any later version"))},
    **{f"CC-{k}-{v}": (f"CC {k} {v}", f"CC-{k}-{v}", f"Creative Commons {n} {v} International License") for v in ("4.0",)
       for k, n in (("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"), ("BY-ND", "Attribution-NoDerivatives"),
                    ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"), ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives"))},
}
_NOTICES = ("Licensed under {}.", "Released under {}.", "Distributed under {}.", "This work is licensed under {}.", "This project is licensed under {}.",
            "This software is licensed under {}.", "This software is released under {}.", "This file is licensed under {}.")

#: identifiers of SPDX lines; the one with -only names the version alone, as GPL-3.0 above
_SPDX = ("MIT", "MIT-0", "ISC", "0BSD", "BSD-1-Clause", "BSD-2-Clause", "BSD-3-Clause", "BSD-3-Clause-Clear", "BSD-4-Clause", "Apache-1.1", "Apache-2.0", "MPL-1.1",
         "MPL-2.0", "Zlib", "Unlicense", "BSL-1.0", "EPL-1.0", "EPL-2.0", "EUPL-1.1", "EUPL-1.2", "CDDL-1.0", "CDDL-1.1", "Artistic-2.0", "AFL-3.0", "OSL-3.0",
         "MS-PL", "MS-RL", "NCSA", "OFL-1.1", "PostgreSQL", "Python-2.0", "PSF-2.0", "WTFPL", "X11", "CC0-1.0", "ECL-2.0", "UPL-1.0", "BlueOak-1.0.0", "Unicode-3.0",
         "MulanPSL-2.0", "BUSL-1.1", "SSPL-1.0", *(f"CC-{k}-{v}" for v in ("2.0", "2.5", "3.0", "4.0") for k in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND")))
_GNU = ("GPL-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.0", "LGPL-2.1", "LGPL-3.0", "AGPL-1.0", "AGPL-3.0", "GFDL-1.1", "GFDL-1.2", "GFDL-1.3")


def known_licences() -> tuple[tuple[str, str], ...]:
    """(identifier, text) of everything that is looked up."""
    out = [*LICENCES, ("BSD-3-Clause", _BSD_3), ("BSD-3-Clause", "BSD 3-Clause License\n\n" + _BSD_3), ("Apache-2.0", _APACHE_HEADER),
           ("MPL-2.0", _MPL_HEADER.format("https"))]
    for k, name, version in (("GPL", "General Public License", "2"), ("GPL", "General Public License", "3"), ("LGPL", "Lesser General Public License", "3"),
                             ("AGPL", "Affero General Public License", "3")):
        for either in (f"either version {version} of the License, or\n(at your option) any later version", f"either version {version} of the License, or any later version"):
            out.append((f"{k}-{version}.0-or-later", _GNU_HEADER.format(name=name, version=either)))
        out.append((f"{k}-{version}.0", _GNU_HEADER.format(name=name, version=f"version {version} of the License")))
        out.append((f"{k}-{version}.0", _GNU_HEADER.format(name=name, version=f"version {version}")))
    out += [(k, notice.format(the + name)) for k, names in _NAMES.items() for name in names for notice in _NOTICES for the in ("", "the ")]
    out += [(k, f"SPDX-License-Identifier: {k}") for k in (*_SPDX, *_GNU)]
    out += [(k, f"SPDX-License-Identifier: {k}-only") for k in _GNU] + [(f"{k}-or-later", f"SPDX-License-Identifier: {k}-or-later") for k in _GNU]
    for file in sorted((Path(__file__).parent / "known_licences").glob("*.txt")):
        text, stem = file.read_text(encoding="utf-8"), file.name.removesuffix(".txt").removesuffix(".spdx").removesuffix(".short")
        out.append((stem, text))
        if stem == "Zlib":
            out.append((stem, "zlib License\n\n" + text))
    return tuple(out)
