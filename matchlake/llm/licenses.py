"""License scans by conditional compression.

Candidate blocks are the licence words of a text (``CUE``) with all words that
a template's wording around them can reach, in any layout; templates of like
size (powers of two) share their blocks. A block is read in windows of two
notices' length, so that each notice lies whole in one. A window's words are
compressed alone and with each template as zstandard raw dictionary; templates are ranked by the
bytes they save, and those that save less than ``SAVED`` of their own
compressed size are out. In this order the exact wording differences decide:
the first template of which a span has all but ``CHANGED`` of the words, and
all its telling words (names, versions, clause words) and no others, is
confirmed. Its spans are taken out and what is left is compressed again, until
nothing is confirmed. Long templates go first. A block whose best template saves ``CLEAR`` of its size
but is not confirmed, the other versions and clause counts included, counts as
unknown: the nearest name is never reported.

Texts without a licence word are settled in Spark; the others go through
Arrow batches, nothing is shuffled. Null and empty texts have no candidates,
an empty table gives an empty one; repeated rows each have a row, null ids
too. Of templates that save equally many bytes the lower (name, number) goes
first. Long texts are read whole, window by window. Other columns are not read.
"""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher

import pyarrow as pa
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CUE = (
    r"(?i)licen[cs]|copyright|permission|warrant|redistribut|spdx|public domain|creative commons|"
    r"cc[ -]?by|cc[ -]?0|(?<![a-z])as is(?![a-z])|merchantab|liabilit|all rights"
)
LEVEL = 16
SAVED = 0.05  # least share of a template's compressed size that it saves a window
CLEAR = 0.6  # a share that names a licence's kin, if no wording is confirmed
CHANGED = 0.2  # share of a template's words that may be deleted or inserted; one always may
REACH = 4  # words of a stretch to words of its template, when spans are looked for

# Words that tell licences apart. Numbers after one of VERSIONED
# or with a point tell, too; LATER after a notice makes it another one.
NAMES = frozenset(
    "apache mit expat x11 bsd isc gnu gpl lgpl agpl lesser library affero mozilla mpl creative commons cc cc0 "
    "attribution noncommercial sharealike noderivatives noderivs sa nc nd zlib boost eclipse epl unlicense "
    "eupl artistic academic modified neither endorse advertising acknowledgement acknowledgment later newer simplified "
    "appear substantial unencumbered sublicense altered patent".split()
)
VERSIONED = frozenset("version v license licence gpl lgpl agpl bsd apache mpl epl by sa nc nd cc".split())
LATER = frozenset(["later", "newer"])
TRAIL = 6  # words after a notice that LATER may be in

# Wordings of common licence notices, by SPDX id.
MIT_GRANT = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    'associated documentation files (the "Software"), to deal in the Software without restriction, including '
    "without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell "
    "copies of the Software, and to permit persons to whom the Software is furnished to do so"
)
MIT_NOTICE = (
    ", subject to the following conditions: The above copyright notice and this permission notice shall be "
    "included in all copies or substantial portions of the Software."
)
MIT_WARRANTY = (
    ' THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT '
    "LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO "
    "EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER "
    "IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE "
    "USE OR OTHER DEALINGS IN THE SOFTWARE."
)
X11_CLAUSE = (
    " Except as contained in this notice, the name of the copyright holders shall not be used in advertising or "
    "otherwise to promote the sale, use or other dealings in this Software without prior written authorization "
    "from the copyright holders."
)
BSD_HEAD = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided "
    "that the following conditions are met: Redistributions of source code must retain the above copyright "
    "notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce "
    "the above copyright notice, this list of conditions and the following disclaimer in the documentation "
    "and/or other materials provided with the distribution."
)
BSD_THIRD = (
    " Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
    "promote products derived from this software without specific prior written permission."
)
BSD_WARRANTY = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED '
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A "
    "PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY "
    "DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, "
    "PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING "
    "NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE "
    "POSSIBILITY OF SUCH DAMAGE."
)
ISC_GRANT = (
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is "
    "hereby granted"
)
ISC_NOTICE = ", provided that the above copyright notice and this permission notice appear in all copies"
ISC_WARRANTY = (
    '. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE '
    "INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR "
    "ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF "
    "USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF "
    "OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in '
        "compliance with the License. You may obtain a copy of the License at "
        "http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, "
        'software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR '
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing "
        "permissions and limitations under the License.",
    ],
    "MIT": ["under the MIT License.", MIT_GRANT + MIT_NOTICE + MIT_WARRANTY],
    "X11": [MIT_GRANT + MIT_NOTICE + MIT_WARRANTY + X11_CLAUSE],
    "MIT-0": [MIT_GRANT + "." + MIT_WARRANTY],
    "BSD-2-Clause": [
        BSD_HEAD + BSD_WARRANTY, "under the BSD 2-Clause License.", "under the 2-Clause BSD License.",
        "under the Simplified BSD License.",
    ],
    "BSD-3-Clause": [
        BSD_HEAD + BSD_THIRD + BSD_WARRANTY, "under the BSD 3-Clause License.", "under the 3-Clause BSD License.",
        "under the Modified BSD License.",
    ],
    "ISC": [ISC_GRANT + ISC_NOTICE + ISC_WARRANTY, "under the ISC License."][::-1],
    "0BSD": [ISC_GRANT + ISC_WARRANTY],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL "
        "was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
        "under the Mozilla Public License, version 2.0.",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public "
        "License 2.0 which is available at https://www.eclipse.org/legal/epl-2.0/",
    ],
    "BSL-1.0": ["Distributed under the Boost Software License, Version 1.0."],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors "
        "be held liable for any damages arising from the use of this software. Permission is granted to anyone to "
        "use this software for any purpose, including commercial applications, and to alter it and redistribute "
        "it freely, subject to the following restrictions: The origin of this software must not be "
        "misrepresented; you must not claim that you wrote the original software. If you use this software in a "
        "product, an acknowledgment in the product documentation would be appreciated but is not required. "
        "Altered source versions must be plainly marked as such, and must not be misrepresented as being the "
        "original software. This notice may not be removed or altered from any source distribution."
    ],
    "CC0-1.0": [
        "This work is dedicated to the public domain under CC0 1.0.",
        "under CC0 1.0 Universal.",
    ],
    "Unlicense": ["This is free and unencumbered software released into the public domain."],
}
GNU = {"GPL": ("", "2.0", "3.0"), "LGPL": ("Lesser ", "2.1", "3.0"), "AGPL": ("Affero ", "3.0")}
CC = {
    "BY": "Attribution", "BY-SA": "Attribution-ShareAlike", "BY-NC": "Attribution-NonCommercial",
    "BY-ND": "Attribution-NoDerivatives", "BY-NC-SA": "Attribution-NonCommercial-ShareAlike",
    "BY-NC-ND": "Attribution-NonCommercial-NoDerivatives",
}
CC_VERSIONS = {"2.0": "Generic", "2.5": "Generic", "3.0": "Unported", "4.0": "International"}
for _family, (_kind, *_versions) in GNU.items():
    for _v in _versions:
        _n = _v.removesuffix(".0")
        _full = f"the GNU {_kind}General Public License"
        _head = (
            "This program is free software: you can redistribute it and/or modify it under the terms of "
            f"{_full} as published by the Free Software Foundation, "
        )
        TEMPLATES[f"{_family}-{_v}"] = [
            f"under {_full}, version {_n}.", f"{_head}version {_n} of the License.", f"under the GNU {_family} version {_n}.",
            f"under the {_family} {_n} license.",
        ]
        TEMPLATES[f"{_family}-{_v}-or-later"] = [
            f"under {_full}, version {_n} or later.",
            f"{_head}either version {_n} of the License, or (at your option) any later version.",
            f"under {_full}, version {_n} or (at your option) any later version.",
            f"under the GNU {_family} version {_n} or later.",
        ]
for _short, _long in CC.items():
    for _v, _port in CC_VERSIONS.items():
        TEMPLATES[f"CC-{_short}-{_v}"] = [
            f"under CC {_short} {_v}.", f"under a Creative Commons {_long} {_v} {_port} License.",
        ]

_cue = regex.compile(CUE)
_word = regex.compile(r"[\p{L}\p{N}]+(?:\.\p{N}+)*")
_version = regex.compile(r"v?(\d+(?:\.\d+)*)$")


def normal(word: str) -> str:
    """Lower case; versions without their v and closing zeros: v2.0 is 2."""
    word = word.lower()
    number = _version.match(word)
    if number is None:
        return "version" if word == "v" else word
    digits = number[1]
    while digits.endswith(".0"):
        digits = digits[:-2]
    return digits


def blocks(words: list[tuple[int, int]], cues: list[tuple[int, int]], reach: int) -> list[tuple[int, int]]:
    """First word and word after the last of each candidate block: the words
    up to ``reach`` words from a licence word. All are given by their places in
    the text."""
    starts, ends = [a for a, _ in words], [b for _, b in words]
    out: list[tuple[int, int]] = []
    for a, b in cues:
        lo = max(0, bisect_right(ends, a) - reach)
        hi = min(len(words), bisect_left(starts, b) + reach)
        if out and lo <= out[-1][1]:
            out[-1] = out[-1][0], hi
        else:
            out.append((lo, hi))
    return out


def align(a: list[str], b: list[str | None]) -> tuple[int, int] | None:
    """(first word of b, word after the last) of the best alignment of a with
    a span of b."""
    same = [m for m in SequenceMatcher(None, a, b, autojunk=False).get_matching_blocks() if m.size]
    if not same:
        return None

    def gain(part: list) -> int:
        covered = sum(m.size for m in part)
        return 3 * covered - len(a) - (part[-1].b + part[-1].size - part[0].b)

    # outer matches that cost more words than they bring are chance
    trimmed = True
    while trimmed and len(same) > 1:
        trimmed = False
        for less in (same[1:], same[:-1]):
            if gain(less) > gain(same):
                same, trimmed = less, True
                break
    return same[0].b, same[-1].b + same[-1].size


def tells(words: list[str | None], i: int) -> bool:
    """Does word i tell licences apart? Taken words do."""
    w = words[i]
    return w is None or w in NAMES or (w[0].isdigit() and ("." in w or (i > 0 and words[i - 1] in VERSIONED)))


class Template:
    def __init__(self, name: str, number: int, wording: str, alone: zstandard.ZstdCompressor, plain: dict):
        self.name, self.number = name, number
        self.words = [normal(w) for w in _word.findall(wording)]
        self.wanted = Counter(self.words)
        self.telling = {w for w in self.words if w in NAMES or w[0].isdigit()}
        self.changes = max(1, math.floor(CHANGED * len(self.words)))
        data = " ".join(self.words).encode()
        self.cost = len(alone.compress(data)) - len(alone.compress(b""))
        content = zstandard.ZstdCompressionDict(data, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        content.precompute_compress(level=LEVEL)
        self.given = zstandard.ZstdCompressor(dict_data=content, **plain)

    def differences(self, words: list[str | None], lo: int, hi: int) -> int | None:
        """Words to delete or insert between the wording and words[lo:hi], or
        None where they are too many or one of them tells."""
        count = 0
        for tag, a, z, b, y in SequenceMatcher(None, self.words, words[lo:hi], autojunk=False).get_opcodes():
            if tag == "equal":
                continue
            count += z - a + y - b
            if count > self.changes or any(w in self.telling for w in self.words[a:z]):
                return None
            if any(tells(words, i) for i in range(lo + b, lo + y)):
                return None
        if "later" not in self.wanted and any(w in LATER for w in words[hi : hi + TRAIL]):
            return None
        return count

    def spans(self, words: list[str | None], hi: int, places: dict[str, list[int]]) -> Iterator[tuple[int, int, int]]:
        """(first word, word after the last, differences) of each confirmed
        span before word hi, left to right; ``places``: where words stand."""
        a, wanted = self.words, self.wanted
        need, width = len(a) - self.changes, REACH * len(a)
        if any(w not in places for w in self.telling):
            return
        if sum(min(n, len(places.get(w, ()))) for w, n in wanted.items()) < need:
            return
        at = sorted(i for w in wanted for i in places.get(w, ()))
        first, have, total, wait = 0, Counter(), 0, -1

        def drop(until: int) -> None:
            nonlocal first, total
            while first < len(at) and at[first] < until and have[words[at[first]]]:
                w = words[at[first]]
                total -= have[w] <= wanted[w]
                have[w] -= 1
                first += 1

        for i in at:
            have[words[i]] += 1
            total += have[words[i]] <= wanted[words[i]]
            drop(i - width + 1)
            if total < need or i < wait:
                continue
            start = at[first]
            got = align(a, words[start : min(hi, i + 2 * len(a))])
            differ = self.differences(words, start + got[0], start + got[1]) if got else None
            if differ is None:
                wait = i + 1
                # what the alignment chose is no notice: look behind its first word
                drop(start + got[0] + 1 if got else i)
            else:
                yield start + got[0], start + got[1], differ
                drop(start + got[1])
                wait = start + got[1]


class Scanner:
    def __init__(self, templates: dict[str, list[str]]):
        plain = {"write_content_size": False, "write_checksum": False, "write_dict_id": False}
        self.alone = zstandard.ZstdCompressor(level=LEVEL, **plain)
        sizes: dict[int, list[Template]] = {}
        for name, texts in sorted(templates.items()):
            for k, wording in enumerate([*texts, f"SPDX-License-Identifier: {name}"]):
                if _word.search(wording):
                    t = Template(name, k, wording, self.alone, plain)
                    sizes.setdefault((len(t.words) + t.changes).bit_length(), []).append(t)
        # (words a span may have, templates) by size, long ones first: a window
        # much longer than a template drowns what that saves
        self.sizes = [(max(len(t.words) + t.changes for t in group), group) for _, group in sorted(sizes.items(), reverse=True)]

    def ranked(self, words: list[str | None], group: list[Template]) -> list[tuple[int, float, Template]]:
        """(bytes saved, share of the template's size, template) of the
        templates that save enough, most bytes first."""
        data = " ".join(w for w in words if w).encode()
        whole = len(self.alone.compress(data))
        out = []
        for t in group:
            saved = whole - len(t.given.compress(data))
            if saved >= SAVED * t.cost:
                out.append((saved, saved / t.cost, t))
        return sorted(out, key=lambda r: (-r[0], r[2].name, r[2].number))

    def window(self, words: list[str | None], lo: int, span: int, hi: int, group: list[Template]) -> tuple[list[tuple], bool]:
        """Notices that start in words[lo:lo + span], taken out of ``words``:
        (first word, licence, share saved, words that differ); and whether a
        template saved a clear share."""
        out: list[tuple] = []
        clear = False
        while True:
            ranked = self.ranked(words[lo:hi], group)
            clear = clear or any(share >= CLEAR for _, share, _ in ranked)
            places: dict[str, list[int]] = {}
            for i in range(lo, hi):
                if words[i]:
                    places.setdefault(words[i], []).append(i)
            for _, share, t in ranked:
                found = [(a, z, differ) for a, z, differ in t.spans(words, hi, places) if a < lo + span]
                for a, z, differ in found:
                    words[a:z] = [None] * (z - a)
                    out.append((a, t.name, share, differ))
                if found:
                    break
            else:
                return out, clear

    def matches(self, text: str) -> tuple[int, list[tuple], int]:
        """Candidate blocks; (start in the text, licence, share saved, words
        that differ) of each notice, in order; blocks of an unknown licence."""
        cues = [m.span() for m in _cue.finditer(text)]
        if not cues or not self.sizes:
            return 0, [], 0
        places = [m.span() for m in _word.finditer(text)]
        words: list[str | None] = [normal(text[a:b]) for a, b in places]
        out: list[tuple] = []
        clear: list[int] = []
        for span, group in self.sizes:
            for first, last in blocks(places, cues, span):
                for lo in range(first, last, span):
                    found, seen = self.window(words, lo, span, min(last, lo + 2 * span), group)
                    out += found
                    if seen and not found:
                        clear.append(lo)
        widest = blocks(places, cues, self.sizes[0][0])
        unknown = sum(
            any(lo <= i < hi for i in clear) and not any(lo <= m[0] < hi for m in out) for lo, hi in widest
        )
        return len(widest), sorted((places[i][0], *rest) for i, *rest in out), unknown


def scan(docs: DataFrame, templates: dict[str, list[str]] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_candidates, n_confirmed,
    n_unknown (blocks that hold an unknown licence), licenses (sorted,
    comma-joined, null if none), first_line of the first confirmed notice,
    best_saved (greatest share of a template's size saved), wording_changes
    of that notice. Templates are looked for around the words of ``CUE``."""
    chosen = templates or TEMPLATES
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.when(F.col("text").rlike(CUE), F.col("text")).alias("text"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(chosen)
        for batch in batches:
            out: list[tuple] = []
            for t in batch.column("text"):
                text = t.as_py() if t.is_valid else ""
                candidates, hits, unknown = scanner.matches(text)
                best = max(hits, key=lambda m: (m[2], m[1]), default=None)
                out.append((
                    candidates, len(hits), unknown, ",".join(sorted({m[1] for m in hits})) or None,
                    text.count("\n", 0, hits[0][0]) if hits else None, best[2] if best else None, best[3] if best else None,
                ))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.float64(), pa.int64()]
            cols = list(zip(*out)) if out else [()] * 7
            yield pa.record_batch(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds))],
                ["doc_id", "n_candidates", "n_confirmed", "n_unknown", "licenses", "first_line", "best_saved", "wording_changes"],
            )

    return rows.mapInArrow(
        run,
        "doc_id bigint, n_candidates bigint, n_confirmed bigint, n_unknown bigint, licenses string, first_line bigint, "
        "best_saved double, wording_changes bigint",
    )
