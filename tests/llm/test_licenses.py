import math
import random
import re
from collections import Counter

from riskspark.llm.licenses import TEMPLATES, TEXTS, _text, scan_licenses

SCHEMA = "doc_id long, path string, text string, license string"


def brute(rows, threshold=0.8):
    """Plain vectors over all words, and a walk up the directories."""
    words = lambda t: set(re.findall(r"[^\W_]+", t.lower()))
    lines = [p for _, _, t, _ in rows for p in (t or "").split("\n") if p]
    known = {w for _, t in TEMPLATES for w in words(t)}
    holds = Counter(w for p in lines for w in words(p))
    idf = lambda w: math.log((len(lines) + 1) / (max(1, holds[w] if w in known else 1) + 1)) + 1

    def nearest(text):
        own, best = words(text), []
        if own:
            for name, t in TEMPLATES:
                dot = sum(idf(w) ** 2 for w in own & words(t))
                norm = math.sqrt(sum(idf(w) ** 2 for w in own) * sum(idf(w) ** 2 for w in words(t)))
                best.append((-round(dot / norm, 9), name))
        best = [b for b in best if -b[0] >= threshold]
        return min(best) if best else None

    own, spoken = [], {}
    for _, path, text, _ in rows:
        whole = nearest(text or "")
        found = [x for x in [whole, *map(nearest, filter(None, (text or "").split("\n")))] if x]
        best = min(found) if found else None
        own.append((best, whole is not None))
        if whole and path is not None:
            d = path.rpartition("/")[0]
            spoken[d] = min(spoken.get(d, best), best)
    out = []
    for (i, path, _, _), (best, whole) in zip(rows, own):
        inherited = (None, None)
        d = None if path is None else path.rpartition("/")[0]
        while best is None and d is not None:
            if d in spoken:
                inherited = (spoken[d][1], d)
                break
            d = d.rpartition("/")[0] if d else None
        out.append((i, path, best and best[1], best and -best[0], whole, *inherited))
    return sorted(out, key=str)


def test_against_brute_force(spark):
    rng = random.Random(1)
    filler = "the work of this version is licensed river stone garden public under free".split()
    rows = []
    for i in range(120):
        lines = [" ".join(rng.choices(filler, k=rng.randrange(1, 12))) for _ in range(rng.randrange(4))]
        if rng.random() < 0.25:
            lines.insert(rng.randrange(len(lines) + 1), rng.choice(TEMPLATES)[1] + rng.choice([".", " ok", ""]))
        if rng.random() < 0.1:
            lines = [rng.choice(TEMPLATES)[1]]
        path = "/".join(rng.choices("abc", k=rng.randrange(4)) + [f"f{i}"])
        rows.append((i, path, "\n".join(lines), "x"))
    rows += [(None, "a/b/n", "plain", "x"), (200, None, "plain", "x"), (201, None, TEMPLATES[0][1], "x"), (202, "", "", "x")]
    rows += [(203, "a/x", None, "x"), rows[3], (204, "a/b/c/a/b/long", "word " * 20_000, "x"), (205, "top", "plain", "x")]
    got = scan_licenses(spark.createDataFrame(rows, SCHEMA).repartition(3)).collect()
    assert sorted(map(tuple, got), key=str) == brute(rows)
    assert any(r["inherited"] for r in got)


def test_nearest_directory_wins(spark):
    rows = [
        (1, "LICENSE", "Released under the MIT License.", ""),
        (2, "lib/COPYING", "Licensed under the Apache License,\nVersion 2.0", ""),
        (3, "lib/deep/er/x.py", "nothing here", ""),
        (4, "other/x.py", "nothing there", ""),
        (5, "lib/y.py", "# Licensed under CC BY-NC 4.0.\ncode of all kinds", ""),
    ]
    got = {r["doc_id"]: r for r in scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert (got[3]["inherited"], got[3]["inherited_from"]) == ("Apache-2.0", "lib")
    assert (got[4]["inherited"], got[4]["inherited_from"]) == ("MIT", "")
    assert got[5]["license"] == "CC-BY-NC-4.0" and got[5]["inherited"] is None and not got[5]["whole_file"]
    assert scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0


MIT = """Copyright (c) 2021 Jo Doe

Permission is hereby granted, free of charge, to any person obtaining a copy
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
SOFTWARE.
"""
GPL = """# This file is part of Frob.
#
# Frob is free software: you can redistribute it and/or modify
# it under the terms of the GNU General Public License as published by
# the Free Software Foundation, either version 3 of the License, or
# (at your option) any later version.
#
# Frob is distributed in the hope that it will be useful,
# but WITHOUT ANY WARRANTY; without even the implied warranty of
# MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
# GNU General Public License for more details.
#
# You should have received a copy of the GNU General Public License
# along with Frob.  If not, see <http://www.gnu.org/licenses/>.
"""
APACHE = """/*
 * Copyright 2019 The Frob Authors
 *
 * Licensed under the Apache License, Version 2.0 (the "License");
 * you may not use this file except in compliance with the License.
 * You may obtain a copy of the License at
 *
 *     http://www.apache.org/licenses/LICENSE-2.0
 *
 * Unless required by applicable law or agreed to in writing, software
 * distributed under the License is distributed on an "AS IS" BASIS,
 * WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
 * See the License for the specific language governing permissions and
 * limitations under the License.
 */
"""
MPL = """/* This Source Code Form is subject to the terms of the Mozilla Public
 * License, v. 2.0. If a copy of the MPL was not distributed with this
 * file, You can obtain one at http://mozilla.org/MPL/2.0/. */
"""


def test_real_forms(spark):
    """Wrapped files and headers above code, notices on one line, and whole licences."""
    rng = random.Random(2)
    code = "".join(f"let {''.join(rng.choices('abcdefgh', k=7))} = call{i}(frob)\n" for i in range(200))
    one_line = lambda t: " ".join(re.findall(r"[^\s#*]+", t))
    forms = {"MIT": MIT, "GPL-3.0": GPL, "Apache-2.0": APACHE, "MPL-2.0": MPL}
    rows, want = [], {}
    for name, form in forms.items():
        for text, whole in ((form, True), (form + code, False), (code + one_line(form) + "\n" + code, False)):
            rows.append((len(rows), f"{len(rows)}/x", text, ""))
            want[len(rows) - 1] = (name, whole)
    for name in TEXTS:
        full = _text(name).split()
        text = "Frob, copyright 2020\n" + "\n".join(" ".join(full[i : i + 11]) for i in range(0, len(full), 11))
        rows.append((len(rows), f"{len(rows)}/x", text, ""))
        want[len(rows) - 1] = (name, True)
    rows.append((len(rows), "x/x", code, ""))
    want[len(rows) - 1] = (None, False)
    got = scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r["doc_id"]: (r["license"], r["whole_file"]) for r in got} == want
