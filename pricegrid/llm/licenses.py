"""License scans: passages compared with licence templates by the Dice
coefficient over word bigrams.

Texts and templates are lower-cased words without punctuation. A passage with
s bigrams and a template with t of them can reach a Dice coefficient d only if
s and t differ by at most the factor (2 - d) / d, and only if the passage shares
at least d t / (2 - d) bigrams. So a template is tried on a text only if the
text holds that many of its bigrams, and only passages within the size bounds
that begin and end at shared bigrams are measured. The upper bound also holds
for a passage's bigrams with their repeats, so a text that repeats a licence many
times is work in proportion to its length. Every word of every text is
looked at; the templates are a small fixed table, or the caller's.
"""

from __future__ import annotations

import re
from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from pricegrid.llm.common import hash_words, mixed, slices, words_of

THRESHOLD = 0.8
_PLAIN = re.compile(r"[^\w]+")


def _gnu(kind, version, thing="program", mark=";"):
    """The notice the GNU licences ask for, with the versions' own punctuation and wording."""
    return (
        f"This {thing} is free software{mark} you can redistribute it and/or modify it under the terms of the {kind} as published by the "
        f"Free Software Foundation; either version {version} of the License, or (at your option) any later version. This {thing} is "
        "distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY "
        f"or FITNESS FOR A PARTICULAR PURPOSE. See the {kind} for more details."
    )


def _eupl(version):
    return (
        f"Licensed under the EUPL, Version {version} or - as soon they will be approved by the European Commission - subsequent versions "
        "of the EUPL (the \"Licence\"); You may not use this work except in compliance with the Licence. You may obtain a copy of the "
        "Licence at: https://joinup.ec.europa.eu/software/page/eupl Unless required by applicable law or agreed to in writing, software "
        "distributed under the Licence is distributed on an \"AS IS\" basis, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express "
        "or implied. See the Licence for the specific language governing permissions and limitations under the Licence."
    )


def _creative_commons(short, words, version):
    kind = "International" if version == "4.0" else "Unported"
    return [f"Licensed under CC {short} {version}.", f"This work is licensed under a Creative Commons {words} {version} {kind} License."]


_BSD_TERMS = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions "
    "are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following "
    "disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution. "
)
_BSD_NAMES = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from "
    "this software without specific prior written permission. "
)
_BSD_DISCLAIMER = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT "
    "LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE "
    "COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES "
    "(INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) "
    "HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) "
    "ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)
_ISC_DISCLAIMER = (
    "THE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES "
    "OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR "
    "ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS "
    "ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."
)
_FEE = "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted"

#: Public licence texts and customary notices. Each version of a licence has its own.
TEMPLATES = {
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
        "files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, "
        "modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software "
        "is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be "
        "included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT WARRANTY OF ANY "
        "KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND "
        "NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
        "OTHER DEALINGS IN THE SOFTWARE.",
    ],
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the "
        "License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law "
        "or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR "
        "CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and "
        "limitations under the License.",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program "
        "is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of "
        "MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details.",
        "Licensed under the GNU General Public License v3.0.",
    ],
    "GPL-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License "
        "version 2 as published by the Free Software Foundation.",
        _gnu("GNU General Public License", "2"),
        "Licensed under the GNU General Public License v2.0.",
    ],
    "LGPL-2.0": [
        "This work is licensed under the GNU Library General Public License, version 2.",
        _gnu("GNU Library General Public License", "2", "library"),
    ],
    "LGPL-2.1": [
        "This work is licensed under the GNU Lesser General Public License, version 2.1.",
        _gnu("GNU Lesser General Public License", "2.1", "library"),
        _gnu("GNU Lesser General Public License", "2.1"),
    ],
    "LGPL-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        _gnu("GNU Lesser General Public License", "3", mark=":"),
        _gnu("GNU Lesser General Public License", "3", "library"),
    ],
    "AGPL-3.0": [
        "This work is licensed under the GNU Affero General Public License, version 3.",
        _gnu("GNU Affero General Public License", "3", mark=":"),
    ],
    "MPL-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed "
        "with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
        "conditions are met: Redistributions of source code must retain the above copyright notice, this list of conditions and the "
        "following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the "
        "following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the "
        "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software "
        "without specific prior written permission.",
        _BSD_TERMS + _BSD_NAMES + _BSD_DISCLAIMER,
    ],
    "BSD-2-Clause": ["Licensed under the BSD 2-Clause License.", _BSD_TERMS + _BSD_DISCLAIMER],
    "ISC": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, "
        "provided that the above copyright notice and this permission notice appear in all copies.",
        _FEE + ", provided that the above copyright notice and this permission notice appear in all copies. " + _ISC_DISCLAIMER,
    ],
    "0BSD": [_FEE + ". " + _ISC_DISCLAIMER],
    "Zlib": [
        "This software is provided 'as-is', without any express or implied warranty. In no event will the authors be held liable for any "
        "damages arising from the use of this software. Permission is granted to anyone to use this software for any purpose, including "
        "commercial applications, and to alter it and redistribute it freely, subject to the following restrictions: 1. The origin of this "
        "software must not be misrepresented; you must not claim that you wrote the original software. If you use this software in a "
        "product, an acknowledgment in the product documentation would be appreciated but is not required. 2. Altered source versions must "
        "be plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not be removed or "
        "altered from any source distribution.",
    ],
    "BSL-1.0": [
        "Distributed under the Boost Software License, Version 1.0.",
        "Distributed under the Boost Software License, Version 1.0. (See accompanying file LICENSE_1_0.txt or copy at "
        "http://www.boost.org/LICENSE_1_0.txt)",
    ],
    "EPL-1.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License v1.0 which "
        "accompanies this distribution, and is available at http://www.eclipse.org/legal/epl-v10.html",
    ],
    "EPL-2.0": [
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License 2.0 which is "
        "available at https://www.eclipse.org/legal/epl-2.0/",
    ],
    "EUPL-1.1": [_eupl("1.1")],
    "EUPL-1.2": [_eupl("1.2")],
    "Artistic-2.0": [
        "This program is free software; you can redistribute it and/or modify it under the terms of the Artistic License 2.0.",
        "Licensed under the Artistic License 2.0.",
    ],
    "WTFPL": [
        "DO WHAT THE FUCK YOU WANT TO PUBLIC LICENSE TERMS AND CONDITIONS FOR COPYING, DISTRIBUTION AND MODIFICATION 0. You just DO WHAT "
        "THE FUCK YOU WANT TO.",
    ],
    "Unlicense": [
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means.",
        "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, "
        "sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or "
        "non-commercial, and by any means. In jurisdictions that recognize copyright laws, the author or authors of this software dedicate "
        "any and all copyright interest in the software to the public domain. We make this dedication for the benefit of the public at "
        "large and to the detriment of our heirs and successors. We intend this dedication to be an overt act of relinquishment in "
        "perpetuity of all present and future rights to this software under copyright law. THE SOFTWARE IS PROVIDED \"AS IS\", WITHOUT "
        "WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A "
        "PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, "
        "WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER "
        "DEALINGS IN THE SOFTWARE. For more information, please refer to https://unlicense.org",
    ],
    **{
        f"CC-{short}-{version}": _creative_commons(short, words, version)
        for version in ("4.0", "3.0")
        for short, words in (
            ("BY", "Attribution"), ("BY-SA", "Attribution-ShareAlike"), ("BY-NC", "Attribution-NonCommercial"),
            ("BY-ND", "Attribution-NoDerivatives" if version == "4.0" else "Attribution-NoDerivs"),
            ("BY-NC-SA", "Attribution-NonCommercial-ShareAlike"),
            ("BY-NC-ND", "Attribution-NonCommercial-NoDerivatives" if version == "4.0" else "Attribution-NonCommercial-NoDerivs"),
        )
    },
    "CC0-1.0": ["To the extent possible under law, the author has waived all copyright and related rights to this work."],
}


def normalised(word):
    """Parts of a word (bytes) in lower case without punctuation, as one bytes of space-joined parts."""
    if word.isalnum():
        return word.lower()
    return _PLAIN.sub(" ", word.decode("utf-8", "replace").lower()).strip().encode()


def bigrams(texts):
    """Word starts per text, bigram hashes in order and where each text's bigrams start."""
    starts, codes, words = words_of(texts)
    parts = [normalised(w).split() for w in words]
    counts = np.array([len(p) for p in parts], np.int64)[codes] if words else np.zeros(0, np.int64)
    flat = hash_words([p for w in parts for p in w])
    place = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int64)
    ends = np.concatenate([[0], np.cumsum(counts)])
    total = int(ends[-1])
    index = np.arange(total) - np.repeat(ends[:-1], counts) + np.repeat(place[codes], counts) if total else np.zeros(0, np.int64)
    hashes = flat[index] if total else np.zeros(0, np.uint64)
    owner = ends[starts]
    pairs = mixed(hashes[:-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[1:]) if total > 1 else np.zeros(0, np.uint64)
    return owner, pairs


def prepared(templates):
    """(licence, variant, distinct bigrams, all bigrams' number) of every template with a bigram."""
    out = []
    for name, texts in templates.items():
        for k, text in enumerate(texts):
            _, pairs = bigrams([text])
            if len(pairs):
                out.append((name, k, np.unique(pairs), len(pairs)))
    return out


def passages(pairs, known, length, threshold):
    """Best passages of a text: (dice, first bigram, last bigram) over distinct bigrams.

    `pairs` are the bigrams of a text, `known` the template's, `length` their
    number with repeats. From every shared bigram the passages within the size
    bounds that end at a shared bigram are measured; the best, then longest, counts.
    """
    t = len(known)
    where = np.flatnonzero(np.isin(pairs, known)).tolist()
    if len(np.unique(pairs[where])) < threshold * t / (2 - threshold):
        return []
    most, longest = (2 - threshold) / threshold * t, (2 - threshold) / threshold * length
    found = []
    for i, first in enumerate(where):
        seen, shared, upto, best = set(), set(), first, None
        for last in where[i : i + int(longest) + 1]:
            seen.update(pairs[upto : last + 1].tolist())
            upto = last + 1
            if len(seen) > most or upto - first > longest:
                break
            shared.add(int(pairs[last]))
            dice = 2 * len(shared) / (len(seen) + t)
            if dice >= threshold and (best is None or dice >= best[0]):
                best = (dice, first, last)
        if best:
            found.append(best)
    return found


def disjoint(found):
    """Of overlapping passages the one with the highest coefficient, then the earliest and longest."""
    kept, firsts, lasts = [], [], []  # taken passages in order; they do not overlap
    for row in sorted(found, key=lambda r: (-r[0], r[1], -(r[2] - r[1]), r[3:])):
        k = bisect_left(firsts, row[1])
        if (k == 0 or lasts[k - 1] < row[1]) and (k == len(firsts) or firsts[k] > row[2]):
            kept.append(row)
            firsts.insert(k, row[1])
            lasts.insert(k, row[2])
    return sorted(kept, key=lambda r: r[1])


def scan(docs, templates=None, key="doc_id", text="text", threshold=THRESHOLD):
    """One row a passage: key, license, dice, first_word and n_words.

    Words are counted after normalisation. Passages of a document do not overlap.
    Null and empty texts and texts of one word have none; equal rows give equal
    rows. Other columns are dropped.
    """
    ready = prepared(TEMPLATES if templates is None else templates)
    every = np.unique(np.concatenate([b for _, _, b, _ in ready])) if ready else np.zeros(0, np.uint64)
    least = min((threshold * len(b) / (2 - threshold) for _, _, b, _ in ready), default=0)
    names = [key, "license", "dice", "first_word", "n_words"]
    schema = docs.select(key).schema.add("license", "string").add("dice", "double").add("first_word", "long").add("n_words", "long")

    def run(batches):
        for batch in batches:
            out, texts = [], batch.column("__text").to_pylist()
            for a, b in slices(texts):
                owner, pairs = bigrams(texts[a:b])
                hit = np.concatenate([[0], np.cumsum(np.isin(pairs, every))]) if len(pairs) else np.zeros(1, int)
                for k in range(a, b):
                    lo, hi = owner[k - a], owner[k - a + 1] - 1  # a text's last word starts no bigram of its own
                    if hi <= lo or hit[hi] - hit[lo] < least:
                        continue
                    held = np.intersect1d(pairs[lo:hi], every)
                    found = []
                    for name, variant, known, length in ready:
                        if np.isin(known, held, assume_unique=True).sum() < threshold * len(known) / (2 - threshold):
                            continue
                        found += [(d, i, j, name, variant) for d, i, j in passages(pairs[lo:hi], known, length, threshold)]
                    out += [(k, name, d, i, j - i + 2) for d, i, j, name, _ in disjoint(found)]
            if out:
                at, *found = zip(*out)
                arrays = [batch.column("__key").take(pa.array(at))]  # in Arrow, so that ids beside a null stay exact
                arrays += [pa.array(c, t) for c, t in zip(found, (pa.string(), pa.float64(), pa.int64(), pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col(key).alias("__key"), F.col(text).alias("__text")).mapInArrow(run, schema)
