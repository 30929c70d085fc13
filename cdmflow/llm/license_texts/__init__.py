"""Whole texts and standard notices of common licences, by SPDX name (GPL-3.0 for both -only and -or-later)."""

from __future__ import annotations

from pathlib import Path

_AS_IS = ('THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, '
          "INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE "
          "DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, "
          "SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR "
          "SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, "
          "WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE "
          "OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.")
_BSD = ("Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
        "following conditions are met: {1}Redistributions of source code must retain the above copyright notice, this list of "
        "conditions and the following disclaimer. {2}Redistributions in binary form must reproduce the above copyright notice, "
        "this list of conditions and the following disclaimer in the documentation and/or other materials provided with the "
        "distribution. ")
_THIRD = ("{3}Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
          "products derived from this software without specific prior written permission. ")
_ISC_END = ('THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL '
            "IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
            "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN "
            "AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
            "PERFORMANCE OF THIS SOFTWARE.")
_GRANT = "Permission to use, copy, modify, and{} distribute this software for any purpose with or without fee is hereby granted"
_KEEP = ", provided that the above copyright notice and this permission notice appear in all copies. "
_MIT = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation the '
        "rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit "
        "persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and "
        "this permission notice shall be included in all copies or substantial portions of the Software. "
        'THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR "
        "COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR "
        "OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.")
_GNU = ("This {what} is free software{sep} you can redistribute it and/or modify it under the terms of the GNU {name} as published "
        "by the Free Software Foundation; either version {v} of the License, or (at your option) any later version. "
        "This {what} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty "
        "of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {name} for more details.")
_MPL = ("This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
        "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.")
_APACHE = ('Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the '
           "License. You may obtain a copy of the License at https://www.apache.org/licenses/LICENSE-2.0 "
           "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "
           '"AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific '
           "language governing permissions and limitations under the License.")
# Where the binding text of a long licence begins and ends: what stands around it differs between copies.
_FROM_TO = {
    "Apache-2.0": ("TERMS AND CONDITIONS FOR USE, REPRODUCTION", "END OF TERMS AND CONDITIONS"),
    "GPL-2.0": ("Everyone is permitted to copy", "END OF TERMS AND CONDITIONS"),
    "GPL-3.0": ("Everyone is permitted to copy", "END OF TERMS AND CONDITIONS"),
    "LGPL-2.1": ("Everyone is permitted to copy", "END OF TERMS AND CONDITIONS"),
    "LGPL-3.0": ("Everyone is permitted to copy", None),
    "MPL-2.0": ("1. Definitions", "Exhibit A"),
    "CC0-1.0": ("Statement of Purpose", None),
}


def texts() -> list[tuple[str, str]]:
    """(license, text); several texts of a licence stand for its usual variants."""
    out = [("MIT", _MIT), ("MPL-2.0", _MPL), ("Apache-2.0", _APACHE)]
    for numbers in ({"1": "1. ", "2": "2. ", "3": "3. "}, {"1": "", "2": "", "3": ""}):
        fill = lambda t: t.replace("{1}", numbers["1"]).replace("{2}", numbers["2"]).replace("{3}", numbers["3"])  # noqa: B023, E731
        out += [("BSD-2-Clause", fill(_BSD) + _AS_IS), ("BSD-3-Clause", fill(_BSD + _THIRD) + _AS_IS)]
    for word in ("/or", ""):
        out += [("ISC", _GRANT.format(word) + _KEEP + _ISC_END), ("0BSD", _GRANT.format(word) + ". " + _ISC_END)]
    for name, gnu, v in (("GPL-2.0", "General Public License", "2"), ("GPL-3.0", "General Public License", "3"),
                         ("LGPL-2.1", "Lesser General Public License", "2.1"), ("LGPL-3.0", "Lesser General Public License", "3")):
        for what in ("program", "library"):
            out += [(name, _GNU.format(what=what, sep=sep, name=gnu, v=v)) for sep in (":",)]
    titles = {"MIT": ["MIT License", "The MIT License", "The MIT License (MIT)"], "ISC": ["ISC License"],
              "BSD-2-Clause": ["BSD 2-Clause License", "All rights reserved.", "BSD 2-Clause License All rights reserved."],
              "BSD-3-Clause": ["BSD 3-Clause License", "All rights reserved.", "BSD 3-Clause License All rights reserved."]}
    out += [(name, f"{title} {text}") for name, text in list(out) for title in titles.get(name, [])]
    for name, (start, end) in _FROM_TO.items():
        text = (Path(__file__).parent / f"{name}.txt").read_text(encoding="utf-8")
        at = text.index(start)
        stop = text.index(end, at) if end else len(text)
        out += [(name, text), (name, text[:stop]), (name, text[at:stop]), *([(name, text[:stop] + end)] if end else [])]
    return out
