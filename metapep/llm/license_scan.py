"""License scans: exact set-similarity join of text blocks with license templates.

A template is a set of words; a block meets it if it holds at least `threshold` of
them.  Blocks are of `block` consecutive words at least, twice the template's length if
that is more, and begin every half block, so any whole copy lies inside one.  Template words are ordered by
their counts over all documents, rarest first.  A block that meets a template of m
words, of which it needs r, holds one of the first m - r + 1 (prefix filter); it has r
template words at all (length filter); and at the first shared word enough words must
follow on either side (positional filter).  What passes is counted exactly.

Templates are a fixed, small table and go to all executors; documents are scanned
twice, once to count and once to join, and never shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .common import bounded_batches

#: Phrases and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Words of usual notices and their labels.
TEMPLATES = (
    ("released under the mit license", "mit"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "mit"),
    ("licensed under the apache license version 2 0", "apache"),
    ("this work is licensed under the gnu general public license version 3", "gpl"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "bsd"),
    ("licensed under cc by 4 0", "cc-by"),
    ("licensed under cc by nc 4 0", "cc-by-nc"),
    ("licensed under cc by sa 4 0", "cc-by-sa"),
    ("this source code form is subject to the terms of the mozilla public license v 2 0", "mpl"),
    ("all rights reserved no part of this publication may be reproduced", "all-rights-reserved"),
    (
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software "
        "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
        "mit",
    ),
    (
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution "
        "this software is provided by the copyright holders and contributors as is and any express or implied warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption "
        "however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
        "bsd",
    ),
    (
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits "
        "whether in an action of contract negligence or other tortious action arising out of or in connection with the use or performance of this software",
        "isc",
    ),
    (
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
        "apache",
    ),
    (
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license for more details "
        "you should have received a copy of the gnu general public license along with this program if not see http www gnu org licenses",
        "gpl",
    ),
)
THRESHOLD = 0.9
BLOCK = 64


def block_of(template: str, least: int = BLOCK) -> int:
    """Words of the blocks that are held against a template: an even number."""
    return max(least + least % 2, 2 * len(template.split()))


class _Join:
    def __init__(self, templates, phrases, threshold: float, block: int):
        self.labels = [label for _, label in templates]
        self.blocks = [block_of(t, block) for t, _ in templates]
        self.sets = [sorted(set(t.split())) for t, _ in templates]
        self.need = [ceil(round(threshold * len(s), 9)) for s in self.sets]
        self.phrases = [(p.split(), label) for p, label in phrases]
        self.vocabulary = sorted({w for s in self.sets for w in s} | {w for p, _ in self.phrases for w in p})
        raw = np.frombuffer(" ".join(self.vocabulary).encode(), np.uint8)
        starts, ends, _ = W.spans(raw, np.array([0, len(raw)]), "alnum")
        h = W.grams(W.hashes(raw, starts, ends, True), 1)
        self.keys, self.word_of = np.unique(h), np.argsort(h)

    def order(self, counts: dict[int, int]) -> None:
        """Number the vocabulary by count over all documents, rarest first."""
        c = [(counts.get(int(k), 0), self.vocabulary[w], k, w) for k, w in zip(self.keys, self.word_of)]
        rank = {w: r for r, (_, _, _, w) in enumerate(sorted(c, key=lambda x: x[:2]))}
        self.number = np.array([rank[w] for w in self.word_of], np.int64)  # by place in keys
        at = {self.vocabulary[w]: r for w, r in rank.items()}
        self.tokens = [sorted(at[w] for w in s) for s in self.sets]
        self.chains = [([at[w] for w in p], label) for p, label in self.phrases]
        self.spelling = {r: self.vocabulary[w].encode() for w, r in rank.items()}
        self.prefix: dict[int, dict[int, list[tuple[int, int]]]] = {}  # by token and block length: templates, and the token's place in them
        for t, (tokens, need) in enumerate(zip(self.tokens, self.need)):
            for i in range(len(tokens) - need + 1):
                self.prefix.setdefault(tokens[i], {}).setdefault(self.blocks[t], []).append((t, i))
        self.is_prefix = np.zeros(len(self.vocabulary) + 1, bool)
        self.is_prefix[list(self.prefix)] = True
        self.sieve = W.Sieve(self.keys)

def blocks_at(place: int, n: int, block: int) -> list[int]:
    """Starts of the blocks of a text of n words that hold the place."""
    half = block // 2
    last = max(0, (max(1, n - half) - 1) // half)
    b = min(place // half, last)
    return [x * half for x in (b - 1, b) if x >= 0 and x * half <= place < x * half + block]


def _scan(batches: Iterator[pa.RecordBatch], join: _Join, keep: list[str]) -> Iterator[pa.RecordBatch]:
    base_type = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64())]))
    block_type = pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("containment", pa.float64())]))
    for batch in batches:
        n_words, base, blocks = [], [], []
        for a, b, raw, off in W.runs(batch["text"]):
            starts, ends, first = W.spans(raw, off, "alnum")
            at, k = join.sieve.find(W.grams(W.hashes(raw, starts, ends, True), 1))
            ids = np.full(len(starts) + 8, -1, np.int64)
            ids[at] = join.number[k]
            n_words += np.diff(first).tolist()
            places: dict[int, list] = {}
            for chain, label in join.chains:
                hit = at[ids[at] == chain[0]]
                for i, w in enumerate(chain[1:], 1):
                    hit = hit[ids[hit + i] == w]
                row = np.searchsorted(first, hit, "right") - 1
                for r, s in zip(row[ok := hit + len(chain) <= first[row + 1]], hit[ok]):
                    if all(W.fold_bytes(raw[starts[s + i] : ends[s + i]]).tobytes() == join.spelling[w] for i, w in enumerate(chain)):
                        places.setdefault(int(r), []).append((int(s - first[r]), label))
            found: dict[int, dict] = {}
            for s in at[join.is_prefix[ids[at]]]:
                r = int(np.searchsorted(first, s, "right")) - 1
                n, f = int(first[r + 1] - first[r]), int(first[r])
                for block, templates in join.prefix[int(ids[s])].items():
                    for begin in blocks_at(int(s) - f, n, block):
                        last = min(begin + block, n)
                        own = ids[f + begin : f + last]
                        have = np.unique(own[own >= 0])
                        j = int(np.searchsorted(have, ids[s]))
                        for t, i in templates:
                            m, need = len(join.tokens[t]), join.need[t]
                            if (t, begin) in found.get(r, {}) or len(have) < need or min(m - i, len(have) - j) + min(i, j) < need:
                                continue
                            if (c := len(np.intersect1d(have, join.tokens[t]))) >= need:
                                found.setdefault(r, {})[t, begin] = {"label": join.labels[t], "first": begin, "last": last - 1, "containment": c / m}
            base += [[{"label": x, "first": s} for s, x in sorted(places.get(r, []))] for r in range(b - a)]
            blocks += [[found[r][x] for x in sorted(found[r])] if r in found else [] for r in range(b - a)]
        yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(n_words, pa.int64()), pa.array(base, base_type), pa.array(blocks, block_type)], [*keep, "n_words", "base", "blocks"])


def license_scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), templates=TEMPLATES, phrases=PHRASES, threshold: float = THRESHOLD, block: int = BLOCK) -> DataFrame:
    """For each row of docs: its `keep` columns, n_words, base (places of the phrases) and blocks (those that meet a template, with containment).

    Null and empty texts have no words and no findings; a very long text is scanned whole; repeated rows each have their
    own; no rows give no rows.  Other columns are left out, so their names can't clash.
    """
    if clash := {"n_words", "base", "blocks"} & set(keep):
        raise ValueError(f"kept columns have names of results: {sorted(clash)}")
    bounded_batches(docs)
    join = _Join(templates, phrases, threshold, block)
    wanted = {1: join.keys}
    counts = docs.select("text").mapInArrow(lambda it: W.count_grams(it, wanted), "n int, h long, c long").groupBy("h").agg(F.sum("c").alias("c"))
    join.order({r.h & 0xFFFFFFFFFFFFFFFF: r.c for r in counts.collect()})
    names = list(keep)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    schema += ", n_words long, base array<struct<label:string,first:long>>, blocks array<struct<label:string,first:long,last:long,containment:double>>"
    return docs.select(*keep, *([] if "text" in keep else ["text"])).mapInArrow(lambda it: _scan(it, join, names), schema)
