"""Licence texts, the notices by which documents name licences, and the words that tell near ones apart.

Names are a licence's SPDX identifier, with ``-text`` for its full text,
``-header`` for what it asks to put into source files, and ``-notice``,
``-ported``, ``-short`` or ``-brief`` for a sentence that names it. The full texts are in
``licenses/``. Texts of one family differ in few words, so some stand for
others here, with the other's name put in: the body of AGPL 3 is that of GPL 3
with its own section 13; a variant of Creative Commons 2.0 to 4.0 has the body
of one variant of its version (of 2.5 for 2.0). The name in the text decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from importlib import resources


def _text(name: str) -> str:
    return resources.files(__package__).joinpath("licenses", f"{name}.txt").read_text("utf-8").strip()


BSD_TERMS = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that
the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of
conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this
list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution."""
BSD_NAMES = """Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote
products derived from this software without specific prior written permission."""
BSD_ADVERTISING = """3. All advertising materials mentioning features or use of this software must display the following
acknowledgement: This product includes software developed by the organization."""
BSD_DISCLAIMER = """THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED
WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE
DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL,
EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE,
DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT
LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF
THE POSSIBILITY OF SUCH DAMAGE."""

MPL_1_HEADER = """The contents of this file are subject to the Mozilla Public License Version 1.1 (the "License"); you may not
use this file except in compliance with the License. You may obtain a copy of the License at http://www.mozilla.org/MPL/
Software distributed under the License is distributed on an "AS IS" basis, WITHOUT WARRANTY OF ANY KIND, either express or
implied. See the License for the specific language governing rights and limitations under the License."""

GNU_HEADER = """This {it} is free software{a} you can redistribute it and/or modify it under the terms of the GNU {kind}General
Public License as published by the Free Software Foundation{b} either version {version} of the License, or (at your option)
any later version. This {it} is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the
implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU {kind}General Public License for more
details. You should have received a copy of the GNU {kind}General Public License along with this {it}"""
GNU_WRITE = """; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301
USA."""
GNU_SEE = """. If not, see <https://www.gnu.org/licenses/>."""

AGPL_13 = """  13. Remote Network Interaction; Use with the GNU General Public License.

  Notwithstanding any other provision of this License, if you modify the
Program, your modified version must prominently offer all users
interacting with it remotely through a computer network (if your version
supports such interaction) an opportunity to receive the Corresponding
Source of your version by providing access to the Corresponding Source
from a network server at no charge, through some standard or customary
means of facilitating copying of software.  This Corresponding Source
shall include the Corresponding Source for any work covered by version 3
of the GNU General Public License that is incorporated pursuant to the
following paragraph.

  Notwithstanding any other provision of this License, you have
permission to link or combine any covered work with a work licensed
under version 3 of the GNU General Public License into a single
combined work, and to convey the resulting work.  The terms of this
License will continue to apply to the part which is the covered work,
but the work with which it is combined will remain governed by version
3 of the GNU General Public License.

"""

# identifier: word before "General Public License", abbreviation, version
GNU = {
    "GPL-1.0": ("", "GPL", "1"),
    "GPL-2.0": ("", "GPL", "2"),
    "GPL-3.0": ("", "GPL", "3"),
    "LGPL-2.0": ("Library ", "LGPL", "2"),
    "LGPL-2.1": ("Lesser ", "LGPL", "2.1"),
    "LGPL-3.0": ("Lesser ", "LGPL", "3"),
    "AGPL-3.0": ("Affero ", "AGPL", "3"),
}
GNU_WORDS = {
    "GPL": (" gnu general ", " gpl ", " gplv"),
    "LGPL": (" lesser general ", " library general ", " lgpl ", " lgplv"),
    "AGPL": (" affero ", " agpl ", " agplv"),
}

CC_WORDS = {
    "NC": ("NonCommercial", (" noncommercial ", " non commercial ", " nc ")),
    "SA": ("ShareAlike", (" sharealike ", " share alike ", " sa ")),
    "ND": ("NoDerivatives", (" noderivatives ", " noderivs ", " no derivatives ", " no derivs ", " no derivative ", " nd ")),
}
CC_KINDS = ["BY", "BY-SA", "BY-ND", "BY-NC", "BY-NC-SA", "BY-NC-ND"]
CC_VERSIONS = {"1.0": "Generic", "2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}

# Of a template, groups of which one phrase each must stand in the text that
# matches, and phrases that must not. Phrases are of normalised words.
Rule = tuple[list[tuple[str, ...]], tuple[str, ...]]


def spelled(text: str) -> str:
    """The normalised words with a blank around each, to look for phrases in."""
    return " " + " ".join(re.findall("[0-9a-z]+", text.lower())) + " "


def agrees(rule: Rule | None, text: str) -> bool:
    if rule is None:
        return True
    words = spelled(text)
    return all(any(p in words for p in group) for group in rule[0]) and not any(p in words for p in rule[1])


def _gnu(name: str) -> Rule:
    _, short, version = GNU[name]
    marks = ["version ", "version", "v ", "v", *(f"{s}{v}" for s in ("gpl", "lgpl", "agpl") for v in ("", " ", "v", " v "))]
    number = spelled(version)[1:]
    least = tuple(f" {m}{number}" for m in marks)
    longer = tuple(f" {m}{version} {i} " for m in marks for i in range(1, 10)) if "." not in version else ()
    others = tuple(w for s, words in GNU_WORDS.items() if s != short for w in words)
    # the abbreviation GPL may stand beside a longer name, the longer names not beside GPL
    never = others if short == "GPL" else tuple(w for s in ("LGPL", "AGPL") if s != short for w in GNU_WORDS[s])
    return [least, GNU_WORDS[short]], (*never, *longer)


def _creative_commons(kind: str, version: str) -> Rule:
    number = spelled(version)[1:]
    must, never = [(f" {number}", f" v{number}"), (" attribution ", " by ")], []
    for part, (_, words) in CC_WORDS.items():
        if part in kind.split("-"):
            must.append(words)
        else:
            never.extend(words)
    return must, tuple(never)


def _named(kind: str, version: str) -> str:
    parts = [CC_WORDS[p][0] for p in kind.split("-")[1:]]
    return "-".join(["Attribution", *(p if version >= "4" else p.replace("NoDerivatives", "NoDerivs") for p in parts)])


def _versions(numbers: Iterable[str]) -> tuple[str, ...]:
    return tuple(f" {m}{spelled(n)[1:]}" for n in numbers for m in ("", "v", "version"))


def build(have: dict[str, str]) -> tuple[dict[str, str], dict[str, Rule]]:
    """Templates beside those of ``have``, and the rules of both."""
    out: dict[str, str] = {}
    rules: dict[str, Rule] = {}

    def add(name: str, text: str, rule: Rule | None) -> None:
        name = known.get(spelled(text), name)
        if name not in have:
            out[name] = text
        if rule:
            rules[name] = rule

    known = {spelled(t): name for name, t in have.items()}
    for name, (kind, short, version) in GNU.items():
        rule = _gnu(name)
        it = "library" if kind in ("Library ", "Lesser ") and version != "3" else "program"
        marks = (":", ",") if version == "3" else (";", ";")
        header = GNU_HEADER.format(it=it, kind=kind, version=version, a=marks[0], b=marks[1])
        add(f"{name}-header", header + (GNU_SEE if version == "3" else GNU_WRITE), rule)
        add(f"{name}-notice", f"This work is licensed under the GNU {kind}General Public License, version {version}.", rule)
        add(f"{name}-short", f"Licensed under the GNU {short} v{version}.", rule)
        add(f"{name}-brief", f"Licensed under the {short}v{version}.", rule)
    network = (" remote network interaction ",)
    gpl = _text("GPL-3.0")
    add("GPL-1.0-text", _text("GPL-1.0"), None)
    add("GPL-2.0-text", _text("GPL-2.0"), None)
    add("GPL-3.0-text", gpl, ([], network))
    add("LGPL-2.0-text", _text("LGPL-2.0"), ([(" gnu library general public license ",)], ()))
    add("LGPL-2.1-text", _text("LGPL-2.1"), ([(" gnu lesser general public license ",)], ()))
    add("LGPL-3.0-text", _text("LGPL-3.0"), None)
    head, tail = gpl.index("  13. Use with the GNU Affero"), gpl.index("  14. Revised Versions")
    front, back = (
        p.replace("GNU GENERAL", "GNU AFFERO GENERAL").replace("GNU General", "GNU Affero General")
        .replace("29 June 2007", "19 November 2007") for p in (gpl[:head], gpl[tail:])
    )
    add("AGPL-3.0-text", front + AGPL_13 + back, ([network], ()))

    rules["Apache-2.0"] = rules["Apache-2.0-header"] = ([_versions(["2.0", "2"])], ())
    add("Apache-2.0-text", _text("Apache-2.0"), None)
    add("Apache-1.1-notice", "Licensed under the Apache Software License, Version 1.1.", ([_versions(["1.1"])], ()))
    add("Apache-1.0-notice", "Licensed under the Apache Software License, Version 1.0.", ([_versions(["1.0"])], ()))

    rules["MPL-2.0-header"] = ([_versions(["2.0", "2"])], ())
    add("MPL-1.1-header", MPL_1_HEADER, ([_versions(["1.1"])], ()))
    for version in ("1.0", "1.1", "2.0"):
        add(f"MPL-{version}-notice", f"Licensed under the Mozilla Public License, Version {version}.", ([_versions([version])], ()))
    add("MPL-1.1-text", _text("MPL-1.1"), None)
    add("MPL-2.0-text", _text("MPL-2.0"), None)

    rules["BSD-2-Clause"] = ([], (" endorse ", " advertising "))
    three = f"{BSD_TERMS} 3. {BSD_NAMES} {BSD_DISCLAIMER}"
    add("BSD-3-Clause-text", three, ([(" endorse ",)], (" advertising ",)))
    four = f"{BSD_TERMS} {BSD_ADVERTISING} 4. {BSD_NAMES} {BSD_DISCLAIMER}"
    add("BSD-4-Clause-text", four, ([(" endorse ",), (" advertising ",)], ()))
    for n in "234":
        add(f"BSD-{n}-Clause-notice", f"Licensed under the BSD {n}-Clause License.", ([(f" {n} clause ",)], ()))

    add("CC0-1.0-text", _text("CC0-1.0"), None)
    for version, port in CC_VERSIONS.items():
        for kind in CC_KINDS:
            name, rule = f"CC-{kind}-{version}", _creative_commons(kind, version)
            title = f"Creative Commons {_named(kind, version)} {version}"
            add(f"{name}-notice", f"This work is licensed under a {title} {port} License.", rule)
            add(f"{name}-ported", f"This work is licensed under the {title} License.", rule)
            add(f"{name}-short", f"Licensed under CC {kind} {version}.", rule)
            if version == "1.0":
                continue
            base, of = ("BY", "3.0") if version == "3.0" and "SA" not in kind else ("BY-SA", max(version, "2.5"))
            full = _text(f"CC-{base}-{of}").replace(f"{_named(base, of)} {of}", f"{_named(kind, version)} {version}")
            title = spelled(f"{_named(kind, version)} {version}")
            add(f"{name}-text", full, ([(title, title.replace(" sharealike ", " share alike "))], ()))
    return out, rules
