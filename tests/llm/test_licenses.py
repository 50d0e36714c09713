"""License scans: base phrases against a regex brute force, automata against expansions."""
import re

import pytest

from edges import edge_docs, no_docs  # noqa: F401
from gridspark.llm import licenses as L


def brute(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    at = sorted((i, label) for p, label in L.BASE.items() for i in range(len(w)) if w[i:i + len(p.split())] == p.split())
    return len(w), [i for i, _ in at], ",".join(sorted({x for _, x in at}))


TEXTS = ["Released under the MIT License.", "Licensed under CC BY-NC 4.0. cc by nc", "under the mit  license under, the MIT-license",
         "Licensed under the Apache License, Version 2.0.", "apache license version 20", "under the mitlicense", "", None, "été CC\nBY\tNC É",
         "this is under the GNU General Public License, version 3.", "under the\x00mit{license}"]


def test_against_brute_force(spark):
    rows = L.scan_licenses(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id int, text string"), "doc_id", "text").collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        n, starts, labels = brute(TEXTS[r.doc_id])
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(starts), labels)
        assert (r.first_word, r.last_word) == ((min(starts), max(starts)) if starts else (None, None))
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score > 0) == (r.labels != "")
    assert {r.doc_id: r.labels for r in rows}[9] == "gpl-3"


def test_whole_sf_table(spark):
    from edges import SF001
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    text = dict(docs.select("doc_id", "text").collect())
    for r in L.scan_licenses(docs, "doc_id", "text").collect():
        n, starts, labels = brute(text[r.doc_id])
        assert (r.n_words, r.n_base, r.base_labels) == (n, len(starts), labels)


@pytest.mark.parametrize("template, yes, no", [
    ("a <<beginOptional>>b c<<endOptional>> d", ["a d", "a b c d"], ["a b d", "a c d", "a b c", "b c d"]),
    ("a <<var;name=x;original=y;words=1..2>> d", ["a x d", "a x y d"], ["a d", "a x y z d"]),
    ("<<beginOptional>>a <<beginOptional>>b<<endOptional>><<endOptional>> c <<var;words=0..1>> d",
     ["c d", "a c d", "a b c d", "a b c q d"], ["b d", "a b d"]),
])
def test_automaton(template, yes, no):
    a = L.Automaton(template)
    for t in yes:
        w = t.encode().split()
        assert a.match(w, 0) == len(w)
    for t in no:
        assert a.match(t.encode().split(), 0) is None


@pytest.mark.parametrize("bad", ["<<var;words=1..2>> a", "a <<beginOptional>> b", "<<beginOptional>>a<<endOptional>>", "a <<other>>", ""])
def test_malformed_templates(bad):
    with pytest.raises((ValueError, IndexError)):
        L.Automaton(bad)


def test_edges(edge_docs, no_docs):
    got = L.scan_licenses(edge_docs, "doc_id", "text")
    assert got.count() == edge_docs.count()
    assert got.filter("doc_id = 7 and base_labels = 'mit'").count() == 1
    assert got.filter("doc_id = 5").first().n_words == 240_000
    assert L.scan_licenses(no_docs, "doc_id", "text").count() == 0


def _labels(text):
    return sorted({x for x, base, _, _ in L.scan_words(L.words(text.encode()), L.compile_all(L.BASE, L.TEMPLATES)) if not base})


MIT = """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""
BSD = ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. ",
       "3. All advertising materials mentioning features or use of this software must display the following acknowledgement: This product includes software developed by the Example Group. ",
       "4. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission. ",
       'THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE.']


ISC = """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""
MPL = "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/."


@pytest.mark.parametrize("text, labels", [
    (ISC, ["isc"]), (ISC.replace("and/or distribute", "and distribute").replace("THE AUTHOR", "EXAMPLE CORP"), ["isc"]),
    (ISC.replace("with or without fee", "without fee"), []), (MPL, ["mpl-2"]), (MPL.replace("v. 2.0", "v. 1.1"), []),
    ("under the terms of the MIT license", ["mit"]), ("under the terms of the Apache license", []),
    ("Licensed under the terms of the Apache License, Version 2.0", ["apache-2"]), ("Apache License v2.0", []),
    ("licensed under the terms of the BSD license", ["bsd"]), ("under the terms of the ISC License", ["isc"]),
    ("GNU General Public License v3", ["gpl-3"]), ("GNU General Public License v2.0", ["gpl-2"]), ("GNU General Public License", []),
    ("SPDX-License-Identifier: MIT", ["mit"]), ("SPDX-License-Identifier: Apache-2.0", ["apache-2"]), ("SPDX-License-Identifier: MPL-2.0", ["mpl-2"]),
    ("SPDX-License-Identifier: GPL-3.0-or-later", ["gpl-3"]), ("SPDX-License-Identifier: LGPL-3.0-only", []),
    ("SPDX-License-Identifier: BSD-3-Clause", ["bsd-3"]), ("SPDX-License-Identifier: CC-BY-NC-4.0", ["cc-by-nc"]), ("License-Identifier: MIT", []),
    (MIT, ["mit"]), (MIT.replace("sublicense, and/or sell", "and sublicense"), []), (MIT[:300], []),
    ("Released under the MIT License", ["mit"]), ("under the MIT rules", []),
    (BSD[0] + BSD[3], ["bsd-2"]), (BSD[0] + BSD[2] + BSD[3], ["bsd-3"]), ("".join(BSD), ["bsd-4"]),
    (BSD[0], []), (BSD[0].replace("must retain", "may drop") + BSD[3], []),
    ("under the 3-clause BSD license", ["bsd"]), ("under the BSD rules", []),
    ("Licensed under the Apache License, Version 2.0", ["apache-2"]), ("Licensed under the Apache License, Version 1.1", []),
    ("GNU General Public License version 2", ["gpl-2"]), ("GNU General Public License, either version 3", ["gpl-3"]),
    ("GNU Lesser General Public License version 3", []),
    ("Creative Commons Attribution 4.0 International License", ["cc-by"]), ("Creative Commons Attribution Unported License", ["cc-by"]),
    ("Creative Commons Attribution 4.0 International Public License", ["cc-by"]),
    ("Creative Commons Attribution-ShareAlike License", ["cc-by-sa"]), ("Creative Commons Attribution-ShareAlike 3.0 Unported License", ["cc-by-sa"]),
    ("Creative Commons Attribution-NonCommercial 4.0 International License", ["cc-by-nc"]),
    ("Creative Commons Attribution Non-Commercial ShareAlike 4.0 International License", ["cc-by-nc"]),
    ("Creative Commons Attribution-NoDerivatives 4.0 International License", []), ("Creative Commons Attribution", []), ("cc by sa 4.0", ["cc-by-sa"]),
    ("Copyright (c) 2020 Owner. All rights reserved.", ["all-rights-reserved"]), ("Copyright (c) 2020 Owner. Some rights reserved.", []),
])
def test_labels_and_near_misses(text, labels):
    assert _labels("Some words. " + text + " And more.") == labels
