"""License scans by template-markup matching.

A license template is wording with markup: ``<<beginOptional>> ...
<<endOptional>>`` encloses words that may be left out, ``<<var;...;words=a..b>>``
stands for a to b words of any kind, and all else is mandatory.  Each
template compiles into an automaton over tokens; a place in a text is
accepted only where every mandatory word stands exactly as in the template.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import utf8

# Fixed values of the contract: phrase -> label.
BASE = {"under the mit license": "mit", "apache license version 2": "apache-2", "cc by nc": "cc-by-nc"}

_OPT, _END = "<<beginOptional>>", "<<endOptional>>"


def _item(*marks: str) -> str:
    """The mark of a list item, which may be left out."""
    return " ".join(f"{_OPT}{m}{_END}" for m in marks)


_DISCLAIMER = (
    "this software is provided by <<var;name=who;original=the copyright holders and contributors;words=1..12>> as is and any express "
    "or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular "
    "purpose are disclaimed in no event shall <<var;name=who;original=the copyright holder or contributors;words=1..12>> be liable "
    "for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of "
    "substitute goods or services loss of use data or profits or business interruption however caused and on any theory of "
    "liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of "
    "this software even if advised of the possibility of such damage")
_BSD = (
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following "
    f"conditions are met {_item('1', 'a')} redistributions of source code must retain the above copyright notice this list of "
    f"conditions and the following disclaimer {_item('2', 'b')} redistributions in binary form must reproduce the above copyright "
    "notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the "
    f"distribution {{}}{_DISCLAIMER}")
_ADVERTISING = (
    f"{_item('3', 'c')} all advertising materials mentioning features or use of this software must display the following "
    f"{_OPT}acknowledgement{_END} {_OPT}acknowledgment{_END} this product includes software developed by "
    "<<var;name=organization;original=the organization;words=1..20>> ")
_NO_ENDORSEMENT = (
    f"{_item('3', '4', 'c', 'd')} neither the name of <<var;name=holder;original=the copyright holder;words=1..12>> nor the names of "
    f"{_OPT}its{_END} {_OPT}their{_END} contributors may be used to endorse or promote products derived from this software without "
    "specific prior written permission ")
_GNU = (f"gnu general public license {_OPT}as published by the free software foundation{_END} "
        f"{_OPT}either{_END} version ")
_CC = f"creative commons attribution {{}} {_item('1 0', '2 0', '2 5', '3 0', '4 0')} {_item('international', 'unported', 'generic')} {{}}license"

_ISC = (
    f"permission to use copy modify {_item('and')} {_item('or')} distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is "
    "and <<var;name=who;original=the author;words=1..8>> disclaims all warranties with regard to this software including all implied "
    "warranties of merchantability and fitness in no event shall <<var;name=who;original=the author;words=1..8>> be liable for any "
    "special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits whether in "
    "an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software")
_MPL = (
    "this source code form is subject to the terms of the mozilla public license v 2 0 if a copy of the mpl was not distributed with "
    f"this file you can obtain one at {_item('http', 'https')} mozilla org mpl 2 0")


def _spdx(*names: str) -> list[str]:
    """The line of a source file that names its license by identifier."""
    return [f"spdx license identifier {name}" for name in names]


#: Label -> templates, beyond the base phrases: whole licenses (mit, isc, bsd-2, bsd-3, bsd-4) and the notices that name one.
TEMPLATES = {
    "mit": ["permission is hereby granted free of charge to any person obtaining a copy of "
            "<<var;name=work;original=this software;words=1..8>> "
            "<<beginOptional>>and associated documentation files<<endOptional>> <<beginOptional>>the software<<endOptional>> "
            "to deal in the software without restriction including without limitation the rights to use copy modify merge publish "
            "distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do "
            "so subject to the following conditions the above copyright notice and this permission notice "
            "<<beginOptional>>including the next paragraph<<endOptional>> shall be included in all "
            "copies or substantial portions of the software the software is provided as is without warranty of any kind express or "
            "implied including but not limited to the warranties of merchantability fitness for a particular purpose and "
            "noninfringement in no event shall <<var;name=who;original=the authors or copyright holders;words=1..8>> be liable for any "
            "claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in "
            "connection with the software or the use or other dealings in the software",
            "<<beginOptional>>licensed<<endOptional>> <<beginOptional>>released<<endOptional>> "
            "under the <<var;name=owner;original=terms of the mit;words=0..4>> mit <<beginOptional>>expat<<endOptional>> license",
            *_spdx("mit")],
    "isc": [_ISC, f"under the {_OPT}terms of the{_END} isc license", *_spdx("isc")],
    "mpl-2": [_MPL, *_spdx("mpl 2 0")],
    "apache-2": ["licensed under <<beginOptional>>the terms of<<endOptional>> the apache <<beginOptional>>software<<endOptional>> license "
                 "<<beginOptional>>version<<endOptional>> <<beginOptional>>v<<endOptional>> 2 <<beginOptional>>0<<endOptional>>",
                 *_spdx("apache 2 0")],
    "bsd": ["under the <<var;name=kind;original=terms of the 3 clause;words=0..5>> bsd <<beginOptional>>style<<endOptional>> license"],
    "bsd-2": [_BSD.format(""), *_spdx("bsd 2 clause")],
    "bsd-3": [_BSD.format(_NO_ENDORSEMENT), *_spdx("bsd 3 clause")],
    "bsd-4": [_BSD.format(_ADVERTISING + _NO_ENDORSEMENT), *_spdx("bsd 4 clause")],
    "gpl-3": [_GNU + "3", "gnu general public license v3", "gnu general public license v 3", *_spdx("gpl 3 0")],
    "gpl-2": [_GNU + "2", "gnu general public license v2", "gnu general public license v 2", *_spdx("gpl 2 0")],
    "cc-by": [_CC.format("", f"{_OPT}public{_END} "), *_spdx("cc by 4 0", "cc by 3 0")],
    "cc-by-nc": [_CC.format(f"{nc} {_item('sharealike', 'share alike', 'noderivatives', 'noderivs', 'no derivatives')}", f"{_OPT}public{_END} ")
                 for nc in ("noncommercial", "non commercial")] + _spdx("cc by nc 4 0", "cc by nc 3 0"),
    "cc-by-sa": ["cc by sa <<beginOptional>>4 0<<endOptional>>"]
                + [_CC.format(sa, f"{_OPT}public{_END} ") for sa in ("sharealike", "share alike")] + _spdx("cc by sa 4 0", "cc by sa 3 0"),
    "all-rights-reserved": ["copyright <<beginOptional>>c<<endOptional>> <<var;name=holder;original=2020 owner;words=1..8>> "
                            "all rights reserved"],
}

#: Bytes that end a word after lower-casing: everything in ASCII but digits and letters.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if c >= 0x80 or chr(c).isalnum() else 32 for c in range(256))

_MARK = re.compile(r"<<(.*?)>>", re.S)
_VAR = re.compile(r"words=(\d+)\.\.(\d+)")


def words(raw: bytes) -> list[bytes]:
    """The words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text, A-Z in lower case."""
    return raw.translate(_FOLD).split()


class Automaton:
    """The token automaton of one template.

    ``step[s]`` maps a token to the states behind it, ``any_[s]`` has the
    states behind any token, and ``free[s]`` those reached without one.  The
    start must demand a word: a template may not begin with a variable."""

    def __init__(self, template: str):
        self.step: list[dict[bytes, set[int]]] = []
        self.any_: list[set[int]] = []
        self.free: list[set[int]] = []
        at = start = self._state()
        opened: list[int] = []
        mandatory: list[bytes] = []
        pos = 0
        for mark in [*_MARK.finditer(template), None]:
            for w in words(template[pos:mark.start() if mark else None].encode()):
                new = self._state()
                self.step[at].setdefault(w, set()).add(new)
                at = new
                if not opened:
                    mandatory.append(w)
            if mark is None:
                break
            pos = mark.end()
            said = mark[1]
            if said == "beginOptional":
                opened.append(at)
            elif said == "endOptional":
                end = self._state()
                self.free[at].add(end)
                self.free[opened.pop()].add(end)
                at = end
            elif said.startswith("var;") and (m := _VAR.search(said)):
                least, most = int(m[1]), int(m[2])
                skips = []
                for i in range(most):
                    if i >= least:
                        skips.append(at)
                    new = self._state()
                    self.any_[at].add(new)
                    at = new
                for s in skips:
                    self.free[s].add(at)
            else:
                raise ValueError(f"unknown markup <<{said}>>")
        if opened or not mandatory:
            raise ValueError("a template needs mandatory words and closed optional regions")
        self.start, self.last = self._closed({start}), at
        if any(self.any_[s] for s in self.start) or self.last in self.start:
            raise ValueError("a template must begin with wording")
        self.first = {w for s in self.start for w in self.step[s]}
        self.seed = max(mandatory, key=lambda w: (len(w), w))  # a mandatory word: a text without it holds no match

    def _state(self) -> int:
        self.step.append({})
        self.any_.append(set())
        self.free.append(set())
        return len(self.step) - 1

    def _closed(self, states: set[int]) -> set[int]:
        todo, out = list(states), set(states)
        while todo:
            for t in self.free[todo.pop()] - out:
                out.add(t)
                todo.append(t)
        return out

    def match(self, tokens: list[bytes], at: int) -> int | None:
        """The end of the longest accepted run of tokens from ``at``, else None."""
        states, end = self.start, None
        while states:
            if self.last in states:
                end = at
            if at == len(tokens):
                break
            w = tokens[at]
            states = self._closed({t for s in states for t in (*self.step[s].get(w, ()), *self.any_[s])})
            at += 1
        return end


def compile_all(base: dict[str, str], templates: dict[str, list[str]]) -> list[tuple[str, bool, Automaton]]:
    """(label, is a base phrase, automaton) of every phrase and template."""
    return ([(label, True, Automaton(p)) for p, label in base.items()]
            + [(label, False, Automaton(t)) for label, ts in templates.items() for t in ts])


def scan_words(tokens: list[bytes], automata: list[tuple[str, bool, Automaton]]) -> list[tuple[str, bool, int, int]]:
    """(label, base, first word, end) of every place of every automaton."""
    found = []
    present = set(tokens)
    live = [x for x in automata if x[2].seed in present]
    if live:
        firsts = set().union(*(a.first for _, _, a in live))
        for i in [i for i, w in enumerate(tokens) if w in firsts]:
            for label, base, a in live:
                if tokens[i] in a.first and (end := a.match(tokens, i)) is not None:
                    found.append((label, base, i, end))
    return found


_OUT = ("n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
        "score double, matches array<struct<label:string,base:boolean,start:long,end:long>>")


def _scan(base: dict[str, str], templates: dict[str, list[str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automata = compile_all(base, templates)
        seeds = {a.seed for _, _, a in automata}
        for batch in batches:
            rows = []
            for raw in utf8(batch.column("text")):
                folded = (raw or b"").translate(_FOLD)
                tokens = folded.split()
                found = scan_words(tokens, automata) if any(s in folded for s in seeds) else []
                starts = [i for _, b, i, _ in found if b]
                covered: set[int] = set().union(*(range(i, e) for _, _, i, e in found)) if found else set()
                rows.append((len(tokens), len(starts), min(starts, default=None), max(starts, default=None),
                             ",".join(sorted({x for x, b, _, _ in found if b})), ",".join(sorted({x[0] for x in found})),
                             len(covered) / len(tokens) if tokens else 0.0,
                             [{"label": x, "base": b, "start": i, "end": e} for x, b, i, e in found]))
            cols = list(zip(*rows)) if rows else [()] * 8
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(pa.struct(
                [("label", pa.string()), ("base", pa.bool_()), ("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(list(c), t) for c, t in zip(cols, kinds))],
                ["id", *(x.split()[0] for x in _OUT.split(", "))])
    return run


def scan_licenses(docs: DataFrame, id_col: str, text_col: str, base: dict[str, str] | None = None,
                  templates: dict[str, list[str]] | None = None) -> DataFrame:
    """Per row: n_words, the base phrases' places (count, smallest and largest
    first word), base_labels, labels (those of templates too), score and every
    match with its words' range.

    Labels are distinct, sorted and comma-joined (empty if none); ``score`` is
    the share of the words that stand inside a match.  A null text counts as
    empty: no words, score 0.  Places may overlap and all are counted.  Rows
    are scanned one by one over the whole text, in one narrow pass: null ids,
    repeated rows and empty tables pass through, other columns are not read."""
    kind = docs.schema[id_col].dataType.simpleString()
    run = _scan(BASE if base is None else base, TEMPLATES if templates is None else templates)
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .mapInArrow(run, f"id {kind}, {_OUT}").withColumnRenamed("id", id_col))
