import random
import re
from collections import Counter

import numpy as np
import pytest

from tablewright.llm.license_scan import TEMPLATES, THRESHOLD, Templates, _all_matches, best_license, matches, scan
from tablewright.llm.textbytes import Texts


def bag(text):
    w = re.findall(r"[0-9a-z\x80-\U0010ffff]+", re.sub("[ -‿©\xa0]", " ", re.sub("[A-Z]", lambda m: m[0].lower(), text)))
    return Counter(zip(w, w[1:]))


def plain(text):
    """All units against all templates."""
    text = text or ""
    paragraphs, held = [], []
    for line in [*text.split("\n"), ""]:
        if bag(line + " x"):
            held.append(line)
        else:
            paragraphs.append("\n".join(held))
            held = []
    found = set()
    for unit in {text, *text.split("\n"), *paragraphs}:
        u = bag(unit)
        for name, template in TEMPLATES.items():
            t = bag(template)
            dice = 2 * sum((u & t).values()) / max(sum(u.values()) + sum(t.values()), 1)
            if dice >= THRESHOLD:
                found.add((name, round(dice, 9)))
    return found


def test_whole_table(docs, texts):
    rows = scan(docs, "doc_id", "text").collect()
    assert len(rows) == len(texts)
    got = {r["doc_id"]: {(m["license"], round(m["dice"], 9)) for m in r["matches"]} for r in rows}
    assert got == {d: plain(t) for d, t in texts.items()}
    assert sum(map(bool, got.values())) > 0


@pytest.mark.parametrize("name", sorted(TEMPLATES))
def test_every_template_is_found(spark, name):
    text = TEMPLATES[name]
    words = text.split()
    changed = " ".join(words[:-1] if len(words) > 20 else words)
    rows = [(1, "Some prose before it.\n\n" + text.upper() + "\n\nand after."), (2, f"Copyright © 2020\n{changed}"), (3, "nothing here")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r["doc_id"]: r for r in scan(df, "doc_id", "text").collect()}
    assert name in {m["license"] for m in got[1]["matches"]} and name in {m["license"] for m in got[2]["matches"]}
    assert got[3]["matches"] == []
    for m in got[1]["matches"]:
        assert text.upper()[:10] in rows[0][1].encode()[m["from"] : m["to"]].decode()


def test_messy_documents(messy, empty):
    rows = best_license(scan(messy, "doc_id", "text")).collect()
    assert len(rows) == messy.count() and all(r["license"] is None and r["n_matches"] == 0 for r in rows)
    assert scan(empty, "doc_id", "text").count() == 0


def found_in(texts, templates, threshold=THRESHOLD, of=matches):
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    whole = Texts(np.frombuffer(b"".join(raw), np.uint8), offsets)
    return [(d, name, dice, raw[d][a:b].decode()) for d, name, dice, a, b, _ in of(whole, Templates(templates, threshold))]


def brute_windows(words, template, threshold):
    """(coefficient, first word, word after the last) of the best windows, each sharing no word with a better one."""
    t = bag(template)
    all_windows = []
    for a in range(len(words)):
        for b in range(a + 2, len(words) + 1):
            u = Counter(zip(words[a:b], words[a + 1 : b]))
            dice = 2 * sum((u & t).values()) / (b - a - 1 + sum(t.values()))
            if dice >= threshold:
                all_windows.append((-dice, a, b))
    taken = []
    for dice, a, b in sorted(all_windows):
        if all(b <= x or y <= a for _, x, y in taken):
            taken.append((dice, a, b))
    return {(round(-dice, 9), " ".join(words[a:b])) for dice, a, b in taken}


def test_windows_against_brute_force():
    r = random.Random(4)
    several = 0
    for case in range(200):
        templates = {"one": "a b c a b d e f", "two": "d e f a a a b", "three": "b c"}
        words = [r.choice("abcdefx") for _ in range(r.randrange(2, 30))]
        for _ in range(r.randrange(3)):
            at = r.randrange(len(words))
            words[at:at] = r.choice(list(templates.values())).split()
        # a text on either side, so that nothing may cross into it
        found = found_in(["a b c", " ".join(words), "d e f"], templates, 0.7, _all_matches)
        for name, template in templates.items():
            wanted = brute_windows(words, template, 0.7)
            # the one line is a unit as well, reported even where a window in it is better
            unit = 2 * sum((bag(" ".join(words)) & bag(template)).values()) / (len(words) - 1 + sum(bag(template).values()))
            if unit >= 0.7:
                wanted.add((round(unit, 9), " ".join(words)))
            assert {(round(dice, 9), text) for d, n, dice, text in found if d == 1 and n == name} == wanted
            several += len(wanted) > 1
    assert several > 5


@pytest.mark.parametrize("name", ["MIT", "BSD-2-Clause", "Apache-2.0-header", "GPL-3.0-header"])
def test_several_paragraphs_among_other_text(name):
    words = TEMPLATES[name].split()
    third = len(words) // 3
    text = "\n\n".join(" ".join(words[i : i + third + 1]) for i in range(0, len(words), third + 1))
    prose = "\n".join(f"line {i} of some other prose" for i in range(400))
    got = [(n, dice, span) for _, n, dice, span in found_in([f"{prose}\n\n{text}\n\n{prose}"], TEMPLATES) if n == name]
    assert [(n, dice, span.split()) for n, dice, span in got] == [(name, 1.0, words)]


def test_notice_inside_a_line():
    text = "It was made over several years and shared with all. Released under the MIT License. Then came more " + "words " * 90
    assert ("MIT-notice", 1.0, "Released under the MIT License.") in {x[1:] for x in found_in([text], TEMPLATES)}


def best_in(text):
    whole = Texts(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))
    found = [(-dice, name) for _, name, dice, _, _, named in matches(whole, Templates(TEMPLATES, THRESHOLD)) if named]
    return min(found)[1] if found else None


@pytest.mark.parametrize("text, name", [
    ("This work is licensed under the GNU General Public License, version 2.", "GPL-2.0-notice"),
    ("This work is licensed under the GNU General Public License, version 3.", "GPL-3.0"),
    ("This work is licensed under the GNU Lesser General Public License, version 2.1.", "LGPL-2.1-notice"),
    ("This work is licensed under the GNU General Public License, version 9.", None),
    ("This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.", "CC-BY-NC-4.0-notice"),
    ("This work is licensed under a Creative Commons Attribution-Share Alike 3.0 Unported License.", "CC-BY-SA-3.0-notice"),
    ("This work is licensed under the Creative Commons Attribution 3.0 United States License.", "CC-BY-3.0-ported"),
    ("Licensed under CC BY 4.0.", "CC-BY-4.0-short"), ("Licensed under CC BY-ND 7.0.", None),
    ("Licensed under the GPLv2.", "GPL-2.0-brief"), ("Licensed under the law of the land", None),
    ("Licensed under the Apache License, Version 2.0.", "Apache-2.0"), ("Licensed under the Apache License, Version 7.0.", None),
])
def test_versions_and_variants_are_told_apart(text, name):
    assert best_in(f"Some prose about it. {text} And so on.") == name


def test_headers_and_texts_near_others():
    agpl = TEMPLATES["GPL-3.0-header"].replace("GNU\nGeneral", "GNU Affero\nGeneral").replace("GNU General", "GNU Affero General")
    assert "Affero" in agpl and best_in(agpl) == "AGPL-3.0-header"
    assert best_in(TEMPLATES["GPL-3.0-header"].replace("version 3", "version 2")) == "GPL-2.0-header"
    clause = "3. Neither the name of the University nor the names of its contributors may be used to endorse or promote products\n"
    clause += "derived from this software without specific prior written permission.\n"
    first, last = TEMPLATES["BSD-2-Clause"].split("THIS SOFTWARE IS")
    assert best_in(f"{first}\n\n{clause}\n\nTHIS SOFTWARE IS{last}") == "BSD-3-Clause-text"
    assert best_in(TEMPLATES["BSD-2-Clause"]) == "BSD-2-Clause"


@pytest.mark.parametrize("name", ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "AGPL-3.0", "MPL-2.0", "CC-BY-SA-4.0", "CC-BY-NC-3.0"])
def test_full_texts_with_parts_missing(name):
    lines = TEMPLATES[f"{name}-text"].split("\n")
    text = "\n".join(lines[: len(lines) * 9 // 10])
    prose = "\n".join(f"line {i} of some other prose" for i in range(300))
    assert best_in(f"{prose}\n{text}\n{prose}") == f"{name}-text"
