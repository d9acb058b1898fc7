"""Licence scan: TF-IDF cosine of notices and licence files to templates, then inheritance by path."""

from __future__ import annotations

import math
import pkgutil
import re
from collections import Counter
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskspark.llm.common import text_slices, written

THRESHOLD = 0.8
# Directories up to this many are sent to every task; beyond it their join shuffles.
BROADCAST_ROWS = 200_000
# Public licence notices, headers and whole texts, by SPDX identifier.
_MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
    'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
    "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and "
    "to permit persons to whom the Software is furnished to do so, subject to the following conditions:"
)
_MIT_REST = (
    "The above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    'the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
    "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN "
    "ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
    "OTHER DEALINGS IN THE SOFTWARE."
)
_BSD_2 = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY "
    "EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS "
    "FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER "
    "CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR "
    "OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby "
    "granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS "
    'PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED '
    "WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, "
    "INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER "
    "IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR "
    "PERFORMANCE OF THIS SOFTWARE."
)
_APACHE = (
    'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with '
    "the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by "
    'applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, '
    "WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language "
    "governing permissions and limitations under the License."
)
_MPL = (
    "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not "
    "distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."
)


def _gnu(name: str, version: str) -> str:
    return (
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU "
        f"{name} as published by the Free Software Foundation, either version {version} of the License, or (at your "
        "option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY "
        "WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the "
        f"GNU {name} for more details. You should have received a copy of the GNU {name} along with this program. If "
        "not, see <https://www.gnu.org/licenses/>."
    )


# Whole licences, one file each beside this module.
TEXTS = ("Apache-2.0", "BSD-3-Clause", "CC0-1.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0")


def _text(name: str) -> str:
    return " ".join(pkgutil.get_data(__package__, f"license_texts/{name}.txt").decode().split())


TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("AGPL-3.0", _gnu("Affero General Public License", "3")),
    ("Apache-2.0", _APACHE),
    ("BSD-2-Clause", _BSD_2),
    ("GPL-2.0", _gnu("General Public License", "2")),
    ("GPL-3.0", _gnu("General Public License", "3")),
    ("ISC", _ISC),
    ("LGPL-2.1", _gnu("Lesser General Public License", "2.1")),
    ("LGPL-3.0", _gnu("Lesser General Public License", "3")),
    ("MIT", _MIT_GRANT),
    ("MIT", f"{_MIT_GRANT} {_MIT_REST}"),
    ("MPL-2.0", _MPL),
    *((name, _text(name)) for name in TEXTS),
)
_WORD = re.compile(r"[^\W_]+")


def terms(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


class Matcher:
    """Cosines to the templates; a term counts by its idf, whatever its count in a passage.

    Words that no template has weigh as much as a word can: like one seen in a single passage.
    """

    def __init__(self, templates: Sequence[tuple[str, str]], found: dict[str, int], passages: int) -> None:
        self.top = self.idf(1, passages)
        self.names = [n for n, _ in templates]
        sets = [terms(t) for _, t in templates]
        self.weight = {w: self.idf(found.get(w, 0), passages) for s in sets for w in s}
        self.sets, self.squares = sets, [sum(self.weight[w] ** 2 for w in s) for s in sets]

    @staticmethod
    def idf(found: int, passages: int) -> float:
        return math.log((passages + 1) / (max(found, 1) + 1)) + 1

    def mass(self, words: set[str]) -> float:
        return sum(self.weight.get(w, self.top) ** 2 for w in words)

    def near(self, words: set[str], threshold: float) -> Iterator[tuple[int, float]]:
        """Templates of which these words hold enough for the threshold, and how much of them.

        The squared cosine is at most the share of the template's square that its words here have.
        """
        own = words & self.weight.keys()
        most = self.mass(own)
        for k, (s, square) in enumerate(zip(self.sets, self.squares, strict=True)):
            least = threshold**2 * square * (1 - 1e-9)
            if most >= least and (held := self.mass(own & s)) >= least:
                yield k, held

    def cosine(self, k: int, held: float, square: float) -> float:
        return round(held / math.sqrt(self.squares[k] * square), 9)

    def best(self, words: set[str], threshold: float) -> tuple[float, str] | None:
        """The nearest template at the threshold or above; ties go to the smaller identifier."""
        square, found = None, None
        for k, held in self.near(words, threshold):
            square = square or self.mass(words)
            found = nearer(found, self.cosine(k, held, square), self.names[k], threshold)
        return found

    def best_of_lines(self, lines: list[set[str]], threshold: float) -> tuple[float, str] | None:
        """The same over all groups of consecutive lines, single ones and all of them among these."""
        found = None
        for k, _ in self.near(set().union(*lines), threshold):
            template, room = self.sets[k], self.squares[k] / threshold**2 * (1 + 1e-9)
            own = [words & template for words in lines]
            for first, begins in enumerate(own):
                if not begins:
                    continue
                seen: set[str] = set()
                left, held, square = set(begins), 0.0, 0.0
                for at in range(first, len(lines)):
                    if at > first:
                        left -= own[at]
                        if not left:  # from here on a group without the first line is no farther
                            break
                    new = lines[at] - seen
                    if not new:
                        continue
                    seen |= new
                    square += self.mass(new)
                    if square > room:  # more words only lead away
                        break
                    if added := new & template:
                        held += self.mass(added)
                        found = nearer(found, self.cosine(k, held, square), self.names[k], threshold)
        return found


def nearer(found: tuple[float, str] | None, cosine: float, name: str, threshold: float) -> tuple[float, str] | None:
    if cosine >= threshold and (found is None or (-cosine, name) < (-found[0], found[1])):
        return cosine, name
    return found


def passages(text: str) -> list[str]:
    return [p for p in text.split("\n") if p]


def _frequencies(texts: DataFrame, vocabulary: frozenset[str]) -> tuple[dict[str, int], int]:
    """Passages that hold each template word, and passages in all. One row per word and task."""

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for rows, _, _ in text_slices(batches):
            for text in rows.column(0).to_pylist():
                for passage in passages(text or ""):
                    counts[""] += 1
                    counts.update(vocabulary.intersection(_WORD.findall(passage.lower())))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts.keys()), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["w", "n"]
        )

    counts = texts.mapInArrow(apply, "w string, n long").groupBy("w").agg(F.sum("n").alias("n")).collect()
    found = {r["w"]: r["n"] for r in counts}
    return found, found.pop("", 0)


def directories(path: Column) -> Column:
    """Directories of a path, the nearest first; the last is the root, ''."""
    parts = F.split(path, "/")
    return F.transform(
        F.sequence(F.size(parts) - 1, F.lit(0), F.lit(-1)), lambda n: F.array_join(F.slice(parts, 1, n), "/")
    )


def scan_licenses(
    files: DataFrame,
    key: str = "doc_id",
    path: str = "path",
    text: str = "text",
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """(key, path, license, cosine, whole_file, inherited, inherited_from) of every row.

    ``license`` is the template nearest to any group of consecutive lines of the text, a single
    line or the text as a whole among them, from the threshold on; ``whole_file`` tells that the whole text is a licence. Such a
    file speaks for its directory: a file without a licence of its own inherits from the nearest
    directory above it that has one (of several, the nearest cosine, then the smaller identifier).

    Null and empty texts match nothing; null paths inherit nothing and speak for no directory.
    Repeated rows stay. An empty table gives an empty result, other columns are ignored.

    Inheritance is resolved for distinct directories, each joined with its ancestors, so a
    directory with many files costs one row there.
    """
    kind = files.select(F.col(f"`{key}`")).schema[0].dataType.simpleString()
    rows = files.select(
        F.col(f"`{key}`").alias("id"), F.col(f"`{path}`").cast("string").alias("path"), F.col(f"`{text}`").alias("text")
    )
    found, total = _frequencies(rows.select("text"), frozenset(w for _, t in templates for w in terms(t)))
    matcher = Matcher(templates, found, total)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, _, _ in text_slices(batches):
            names, cosines, whole = [], [], []
            for body in part.column(2).to_pylist():
                lines = passages(body or "")
                best = matcher.best_of_lines([terms(line) for line in lines], threshold) if lines else None
                # A text of several lines may be a licence as a whole, though none of them is.
                all_of_it = matcher.best(terms(body), threshold) if lines else None
                names.append(best and best[1])
                cosines.append(best and best[0])
                whole.append(all_of_it is not None)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(names, pa.string()), pa.array(cosines, pa.float64()), pa.array(whole, pa.bool_())],
                names=["id", "path", "license", "cosine", "whole_file"],
            )

    scanned = written(
        rows.mapInArrow(apply, f"id {kind}, path string, license string, cosine double, whole_file boolean"),
        "license-scan",
    ).withColumn("directory", directories(F.col("path"))[0])
    spoken = (
        scanned.where(F.col("whole_file") & F.col("directory").isNotNull())
        .groupBy("directory")
        .agg(F.min(F.struct(-F.col("cosine"), F.col("license"))).alias("best"))
        .select(F.col("directory").alias("above"), F.col("best.license").alias("inherited"))
    )
    asked = scanned.where(F.col("license").isNull() & F.col("directory").isNotNull()).select("directory").distinct()
    nearest = (
        # Ancestors of a directory, itself among them; how many there are is bounded by the path.
        asked.select("directory", F.posexplode(directories(F.concat("directory", F.lit("/x")))).alias("steps", "above"))
        .union(asked.where(F.col("directory") == "").select("directory", F.lit(0), F.lit("")))
        .join(spoken, "above")
        .groupBy("directory")
        .agg(F.min(F.struct("steps", "above", "inherited")).alias("n"))
        .select("directory", F.col("n.inherited").alias("inherited"), F.col("n.above").alias("inherited_from"))
    )
    nearest = written(nearest, "license-directories")
    small = nearest.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    own = F.col("license").isNull()
    return scanned.join(F.broadcast(nearest) if small else nearest, "directory", "left").select(
        F.col("id").alias(key),
        "path",
        "license",
        "cosine",
        "whole_file",
        F.when(own, F.col("inherited")).alias("inherited"),
        F.when(own, F.col("inherited_from")).alias("inherited_from"),
    )
