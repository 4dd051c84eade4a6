"""Licence scan: normalised text compared with licence templates by the Dice coefficient of word bigrams.

Every line of a text, and the text as a whole, is compared. The coefficient of sets of sizes a and b
is at most 2 * min(a, b) / (a + b), so only templates whose size lies within a factor of
threshold / (2 - threshold) are looked at; text of any other size is passed over without making
its bigrams. Passages, which may wrap over lines or be part of one, are found by sliding windows of
the sizes that the same bound allows over the words of the whole text.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Notices by which licences are usually named, and short licence texts.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "Apache-2.0-notice": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at',
    "MIT": "Released under the MIT License.",
    "MIT-licensed": "Licensed under the MIT License.",
    "MIT-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction',
    "BSD-3-Clause": "Licensed under the BSD 3-Clause License.",
    "BSD-2-Clause": "Licensed under the BSD 2-Clause License.",
    "BSD-redistribution": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "GPL-2.0": "This work is licensed under the GNU General Public License, version 2.",
    "GPL-notice": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation",
    "LGPL-3.0": "This work is licensed under the GNU Lesser General Public License, version 3.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0-long": "This work is licensed under a Creative Commons Attribution 4.0 International License.",
    "CC0-1.0": "This work is dedicated to the public domain under CC0 1.0.",
}

_NO_WARRANTY = "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
_BSD = "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. "
_GPL = "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version {0} of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/."
#: Whole notices and licence texts, which only passages are compared with.
WHOLE = {
    "Apache-2.0-notice-whole": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License.',
    "MIT-whole": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.',
    "BSD-2-Clause-whole": _BSD + _NO_WARRANTY,
    "BSD-3-Clause-whole": _BSD + "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. " + _NO_WARRANTY,
    "GPL-3.0-notice-whole": _GPL.format(3),
    "GPL-2.0-notice-whole": _GPL.format(2),
}

_NOT_WORD = re.compile("[^a-z0-9]+")


def words_of(text: str) -> list[str]:
    """Runs of a-z and 0-9 after lower-casing A-Z."""
    return _NOT_WORD.sub(" ", text.translate(_LOWER)).split()


_LOWER = {c: c + 32 for c in range(65, 91)}


def bigrams(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:], strict=False))


def compiled(templates: dict[str, str], percent: int) -> tuple[list[tuple[str, set]], list[list[int]]]:
    """Templates with their bigrams, and for each size of text the templates that it can reach."""
    made = [(name, bigrams(words_of(text))) for name, text in sorted(templates.items())]
    largest = max(len(b) for _, b in made) * (200 - percent) // percent
    # 2 * min(a, b) * 100 >= percent * (a + b) bounds the size
    by_size = [[i for i, (_, b) in enumerate(made) if 200 * min(n, len(b)) >= percent * (n + len(b))] for n in range(largest + 1)]
    return made, by_size


class Passages:
    """Finds runs of consecutive words that reach ``percent`` with a template."""

    def __init__(self, templates: dict[str, str], percent: int):
        self.percent = percent
        self.made = []
        for name, text in sorted(templates.items()):
            words = words_of(text)
            pairs = bigrams(words)
            # 200 * both >= percent * (size + m) with both <= size bounds both from below and size from above
            self.made.append((name, pairs, set(words), -(-percent * len(pairs) // (200 - percent)), len(pairs) * (200 - percent) // percent))
        self.vocabulary = set().union(*(w for _, _, w, _, _ in self.made))

    def windows(self, inside: np.ndarray, before: np.ndarray, name: str, size: int, need: int, most: int) -> Iterator[tuple]:
        """For each word where a window can begin the best one: (weight, first word, last word, name, overlap, size, template size).

        ``inside`` says of each bigram whether the template has it, ``before`` where it occurred last. All windows
        grow together, a bigram at a time; one counts in a window if it last occurred before the window.
        """
        hits = np.flatnonzero(inside)
        if len(hits) < need:
            return
        begins = hits[: len(hits) - need + 1]
        begins = begins[hits[need - 1 :] - begins < most]
        seen, both = np.zeros(len(begins), np.int64), np.zeros(len(begins), np.int64)
        best, last, best_both, best_seen = np.zeros(len(begins)), *(np.zeros(len(begins), np.int64) for _ in range(3))
        for step in range(most):
            n = int(np.searchsorted(begins, len(inside) - step))
            if not n:
                break
            at, own = begins[:n] + step, inside[begins[:n] + step]
            new = before[at] < begins[:n]
            seen[:n] += new
            both[:n] += new & own
            score = both[:n] / (seen[:n] + size)
            better = np.flatnonzero(own & (200 * both[:n] >= self.percent * (seen[:n] + size)) & (score > best[:n]))
            best[better], last[better], best_both[better], best_seen[better] = score[better], at[better] + 1, both[better], seen[better]
        for k in np.flatnonzero(last).tolist():
            yield float(best_both[k] * best[k]), int(begins[k]), int(last[k]), name, int(best_both[k]), int(best_seen[k]), size

    def find(self, words: list[str]) -> list[tuple]:
        """Windows that don't overlap, in the order of the text: of those that do, the one with the largest overlap times coefficient stays."""
        present = self.vocabulary.intersection(words)
        found, own, before = [], None, None
        for name, pairs, vocabulary, need, most in self.made:
            # each bigram misses at most two words, so every two missing words cost a bigram
            if len(vocabulary) - len(vocabulary & present) > 2 * (len(pairs) - need) or sum(a in present and b in present for a, b in pairs) < need:
                continue
            if own is None:
                own, at = list(zip(words, words[1:], strict=False)), {}
                before = np.empty(len(own), np.int64)
                for i, b in enumerate(own):
                    before[i] = at.get(b, -1)
                    at[b] = i
            found += self.windows(np.fromiter((b in pairs for b in own), bool, len(own)), before, name, len(pairs), need, most)
        found.sort(key=lambda x: (-x[0], x[1], x[3]))
        kept: list[tuple] = []
        for x in found:
            at = bisect_left(kept, x[1], key=lambda y: y[2])
            if at == len(kept) or kept[at][1] > x[2]:
                kept.insert(at, x)
        return kept


def scan_licenses(docs: DataFrame, percent: int = 80, templates: dict[str, str] | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every unit of text that reaches ``percent`` with a template: id, unit, license, overlap, unit_size, template_size.

    Units are the lines of a text, numbered from 0, and the whole text as unit -1 when it has more
    than one line. Of several templates the one with the largest coefficient is named, the first
    by name on ties. A passage that lies in no unit found so, and that is a run of words as near to a
    template or to a whole notice or licence text, has unit -2 - n if it begins on line n; its size
    is that of its own bigrams. Null and empty texts, and lines of one word, have no bigrams and no rows.
    Repeated rows give repeated rows; null ids stay null. Very long texts are looked at whole. An
    empty table gives no rows.
    """
    made, by_size = compiled(templates or TEMPLATES, percent)
    # a set of n bigrams needs at least n + 1 words; repeated bigrams only make it smaller
    fewest = next(n for n, x in enumerate(by_size) if x)
    passages = Passages(templates or TEMPLATES | WHOLE, percent)

    def unit(words: list[str]) -> tuple[str, int, int, int] | None:
        if len(words) - 1 < fewest:
            return None
        # a path over d different words has at least d - 1 different bigrams
        if len(words) > len(by_size) and len(set(words)) - 1 >= len(by_size):
            return None
        own = bigrams(words)
        if len(own) >= len(by_size):
            return None
        best = None
        for i in by_size[len(own)]:
            name, other = made[i]
            both = len(own & other)
            if 200 * both >= percent * (len(own) + len(other)):
                score = both / (len(own) + len(other))
                if best is None or score > best[0]:
                    best = (score, name, both, len(own), len(other))
        return best and best[1:]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                lines = [words_of(x) for x in (text or "").split("\n")]
                hits = {n: hit for n, words in enumerate(lines) if (hit := unit(words))}
                whole = [w for words in lines for w in words]
                if len(lines) > 1 and (hit := unit(whole)):
                    hits[-1] = hit
                rows += [(name, n, *hit) for n, hit in hits.items()]
                if -1 not in hits and (found := passages.find(whole)):
                    ends = list(accumulate(map(len, lines)))
                    for _, begin, last, *passage in found:
                        n = bisect_right(ends, begin)
                        if n not in hits or last >= ends[n]:
                            rows.append((name, -2 - n, *passage))
            if rows:
                types = [pa.int64(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], _ROWS.replace(",", "").split()[::2])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col)).mapInArrow(work, _ROWS)


_ROWS = "doc_id long, unit int, license string, overlap long, unit_size long, template_size long"
