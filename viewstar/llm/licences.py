"""Operator 7: licence scan with a positional index of rare words.

A template is a licence text in spans, some of which hold a mandatory key phrase;
words of different spans may lie any distance apart in a file.  The document
frequency of every licence word is counted over all files.  Postings give for each
word its templates' spans and places in them.

Of each file the highest-IDF licence words are looked up: for a span with a key phrase
whose words are all in the file the two rarest of the phrase, for any other span of
a template whose phrases' words are all there the ``RARE`` rarest of the span that the
file has.  A place in the file less a place in the span is a relative position; a
span is where two looked-up words meet in the same one (for a phrase: both).  At
those of a key phrase the whole phrase is verified, so no place of one is missed.

A template's labels count if every key phrase is verified somewhere in the file; its
score is the share, weighted by IDF, of its words that stand in place, each
span at the relative position that suits it best.  A file's score is its best template's.

Defined cases: null, blank or wordless text has no words, no places, null first
and last word, empty labels and score 0; overlapping places all count; rows keep
their order and number, whatever their ids; other columns are ignored; a table
without rows gives none.  A word is a run of digits, letters a-z (lower-cased) and
characters beyond ASCII.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from viewstar.llm.common import table
from viewstar.llm.kernel import ALNUM_WORDS, hash_spans, hash_words, pieces, text_bytes, words

# Label, key phrase, notice.  The first three are the base phrases.
TEMPLATES = [
    ("cc-by", "cc by", "this work is licensed under cc by"),
    ("gpl", "general public license", "licensed under the gnu general public license version"),
    ("reserved", "all rights reserved", "all rights reserved"),
    ("agpl", "affero general public license", "licensed under the gnu affero general public license version"),
    ("apache", "apache license", "licensed under the apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("cc-by-nc", "cc by nc", "licensed under cc by nc"),
    ("cc-by-sa", "cc by sa", "licensed under cc by sa"),
    ("isc", "permission to use copy modify and or distribute this software", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("lgpl", "lesser general public license", "licensed under the gnu lesser general public license version"),
    ("mit", "mit license", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("mpl", "mozilla public license", "subject to the terms of the mozilla public license v 2 0"),
    ("public-domain", "released into the public domain", "this is free and unencumbered software released into the public domain"),
]
N_BASE = 3
RARE = 4

# Longer texts, label and spans (mandatory key phrase or nothing, words).
_AS_IS = "the software is provided as is without warranty of any kind express or implied"
TEXTS = [
    ("mit", [
        ("permission is hereby granted free of charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
        ("", "including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so"),
        ("", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
        ("", _AS_IS + " including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
        ("", "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise"),
    ]),
    ("isc", [
        ("permission to use copy modify and or distribute this software", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
        ("", "the software is provided as is and the author disclaims all warranties with regard to this software including all implied warranties of merchantability and fitness"),
        ("", "in no event shall the author be liable for any special direct indirect or consequential damages or any damages whatsoever resulting from loss of use data or profits"),
    ]),
    ("bsd", [
        ("redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
        ("", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
        ("", "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
        ("", "this software is provided by the copyright holders and contributors as is and any express or implied warranties"),
    ]),
    ("bsd-3-clause", [
        ("redistribution and use in source and binary forms", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
        ("", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
        ("to endorse or promote products derived from this software", "may be used to endorse or promote products derived from this software without specific prior written permission"),
    ]),
    ("apache", [
        ("licensed under the apache license version 2 0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
        ("", "you may obtain a copy of the license at http www apache org licenses license 2 0"),
        ("", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
        ("", "see the license for the specific language governing permissions and limitations under the license"),
    ]),
    ("gpl", [
        ("general public license as published by the free software foundation", "you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
        ("", "in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
        ("", "you should have received a copy of the gnu general public license along with this program"),
    ]),
    ("lgpl", [
        ("lesser general public license as published by the free software foundation", "you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation"),
        ("", "in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ]),
    ("agpl", [
        ("affero general public license as published by the free software foundation", "you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation"),
        ("", "in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ]),
    ("mpl", [
        ("this source code form is subject to the terms of the mozilla public license", "this source code form is subject to the terms of the mozilla public license v 2 0"),
        ("", "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    ]),
    ("public-domain", [
        ("released into the public domain", "this is free and unencumbered software released into the public domain"),
        ("", "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ]),
    ("zlib", [
        ("the origin of this software must not be misrepresented", "the origin of this software must not be misrepresented you must not claim that you wrote the original software"),
        ("", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software"),
        ("", "altered source versions must be plainly marked as such and must not be misrepresented as being the original software"),
    ]),
    ("boost", [
        ("boost software license", "distributed under the boost software license version 1 0"),
    ]),
    ("cc0", [
        ("cc0 1 0 universal", "licensed under cc0 1 0 universal"),
    ]),
    ("cc-by", [
        ("creative commons attribution 4 0 international license", "this work is licensed under a creative commons attribution 4 0 international license"),
    ]),
    ("cc-by-sa", [
        ("creative commons attribution sharealike", "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    ]),
    ("cc-by-nc", [
        ("creative commons attribution noncommercial", "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    ]),
    ("epl", [
        ("eclipse public license", "made available under the terms of the eclipse public license"),
    ]),
]


def licences() -> list[tuple[str, list[tuple[str, str]]]]:
    """All templates as label and spans; the notices come first, a span each."""
    return [(label, [(key, notice)]) for label, key, notice in TEMPLATES] + TEXTS


def licence_words() -> list[str]:
    return sorted({w for _, spans in licences() for _, text in spans for w in text.split()})


@dataclass
class Span:
    template: int
    words: np.ndarray  # hashes
    weight: np.ndarray  # IDF of the words
    key: tuple[int, int]  # places of the key phrase; (0, 0): none
    needs: np.ndarray  # licence words that a file must have: those of all the template's phrases
    looked: np.ndarray  # licence words that may be looked up, the rarest first
    rare: int  # how many of them are
    posts: list[tuple[int, int]]  # licence word and place


@dataclass
class Index:
    known: np.ndarray  # sorted hashes of the licence words
    rank: np.ndarray  # of each licence word by IDF, the rarest 0
    labels: list[str]
    spans: list[Span]
    first: np.ndarray  # of each licence word in the postings
    post_span: np.ndarray
    post_at: np.ndarray


def _hashes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    buf, off = text_bytes(batch.column("text"))
    starts, ends, at = words(buf, off, ALNUM_WORDS)
    return hash_spans(buf, starts, ends), at


def _counter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task: files and files that hold each licence word; word -1 counts the files."""
    known = np.sort(hash_words(licence_words()))
    df, n = np.zeros(len(known), np.int64), 0
    for batch in batches:
        for piece in pieces(batch, "text"):
            h, at = _hashes(piece)
            slot = np.minimum(np.searchsorted(known, h), len(known) - 1)
            hit = np.flatnonzero(known[slot] == h)
            file = np.searchsorted(at, hit, "right") - 1
            df += np.bincount(np.unique(file * len(known) + slot[hit]) % len(known), minlength=len(known))
            n += piece.num_rows
    yield pa.RecordBatch.from_arrays([pa.array([-1, *range(len(known))], pa.int64()), pa.array([n, *df.tolist()], pa.int64())], ["word", "df"])


def idf_of(texts: DataFrame) -> dict[str, float]:
    """IDF of the licence words over all files; a number a licence word reaches the driver."""
    counts = dict(texts.select("text").mapInArrow(_counter, "word long, df long").groupBy("word").agg(F.sum("df")).collect())
    ws = licence_words()
    known = np.sort(hash_words(ws))
    n = counts.get(-1) or 0
    return {w: math.log((n + 1) / ((counts.get(int(np.searchsorted(known, h))) or 0) + 1)) for w, h in zip(ws, hash_words(ws))}


def index(idf: dict[str, float]) -> Index:
    ws = sorted(idf)
    hashed = hash_words(ws)
    known = np.sort(hashed)
    slot = {w: int(i) for w, i in zip(ws, np.searchsorted(known, hashed))}
    rank = np.zeros(len(ws), np.int64)
    for r, w in enumerate(sorted(ws, key=lambda w: (-idf[w], w))):
        rank[slot[w]] = r
    rarest = lambda some: np.array(sorted({slot[w] for w in some}, key=lambda i: rank[i]), np.int64)
    labels, spans = [], []
    for label, parts in licences():
        needs = rarest(w for key, _ in parts for w in key.split())
        for key, text in parts:
            t, k = text.split(), key.split()
            at = next(i for i in range(len(t)) if t[i:i + len(k)] == k)
            looked = rarest(k or t)
            rare = 2 if k else RARE
            # of a word that a phrase repeats one place is enough; every phrase has two words or more
            posts = [(slot[w], at + k.index(w)) for w in k if slot[w] in looked[:rare]] if k else [(slot[w], i) for i, w in enumerate(t)]
            spans.append(Span(len(labels), hash_words(t), np.array([idf[w] + 1e-9 for w in t]), (at, at + len(k)) if k else (0, 0), needs, looked, rare, sorted(set(posts))))
        labels.append(label)
    posts = sorted((w, s, at) for s, span in enumerate(spans) for w, at in span.posts)
    flat = np.array(posts, np.int64).reshape(-1, 3)
    return Index(known, rank, labels, spans, np.searchsorted(flat[:, 0], np.arange(len(ws) + 1)), flat[:, 1], flat[:, 2])


def positions(ix: Index, h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """File, span and relative position wherever looked-up words of a file meet."""
    n = len(at) - 1
    slot = np.minimum(np.searchsorted(ix.known, h), len(ix.known) - 1)
    hit = np.flatnonzero(ix.known[slot] == h)
    word, file = slot[hit], np.searchsorted(at, hit, "right") - 1
    present = np.zeros((n, len(ix.known)), bool)
    present[file, word] = True
    wanted, last = np.zeros_like(present), np.full((n, len(ix.spans)), -1)
    for s, span in enumerate(ix.spans):
        rows = np.flatnonzero(present[:, span.needs].all(axis=1))
        if len(rows):
            have = present[np.ix_(rows, span.looked)]
            use = have & (np.cumsum(have, axis=1) <= span.rare)
            wanted[np.ix_(rows, span.looked)] |= use
            last[rows, s] = np.where(use, ix.rank[span.looked], -1).max(axis=1)
    take = wanted[file, word]
    hit, word, file = hit[take], word[take], file[take]
    copies = ix.first[word + 1] - ix.first[word]
    spot = np.repeat(np.arange(len(hit)), copies)
    post = np.arange(len(spot)) - np.repeat(np.cumsum(copies) - copies, copies) + ix.first[word[spot]]
    s = ix.post_span[post]
    own = ix.rank[word[spot]] <= last[file[spot], s]
    spot, post, s = spot[own], post[own], s[own]
    f, d = file[spot], hit[spot] - ix.post_at[post]
    order = np.lexsort((d, s, f))
    f, s, d = f[order], s[order], d[order]
    new = np.ones(len(f), bool)
    new[1:] = (f[1:] != f[:-1]) | (s[1:] != s[:-1]) | (d[1:] != d[:-1])
    start = np.flatnonzero(new)
    meet = start[np.diff(np.append(start, len(f))) >= 2]
    return f[meet], s[meet], d[meet]


def _scanner(ix: Index):
    total = np.zeros(len(ix.labels))
    keys = np.zeros(len(ix.labels), np.int64)
    for span in ix.spans:
        total[span.template] += span.weight.sum()
        keys[span.template] += span.key[1] > 0

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in pieces(batch, "text"):
                h, at = _hashes(piece)
                n = piece.num_rows
                n_base = np.zeros(n, np.int64)
                first, last = np.full(n, np.iinfo(np.int64).max), np.full(n, -1)
                sums, verified = np.zeros((n, len(total))), np.zeros((n, len(total)), np.int64)
                files, spans, starts = positions(ix, h, at)
                for s in np.unique(spans).tolist():
                    span, own = ix.spans[s], spans == s
                    file, start = files[own], starts[own]
                    lo, hi = at[file], at[file + 1]
                    if span.key[1]:
                        a, b = span.key
                        fine = (start + a >= lo) & (start + b <= hi)
                        file, start, lo, hi = file[fine], start[fine], lo[fine], hi[fine]
                        for j in range(a, b):
                            fine = h[start + j] == span.words[j]
                            file, start, lo, hi = file[fine], start[fine], lo[fine], hi[fine]
                        verified[np.unique(file), span.template] += 1
                        if s < N_BASE:
                            np.add.at(n_base, file, 1)
                            np.minimum.at(first, file, start + a - lo)
                            np.maximum.at(last, file, start + a - lo)
                    share = np.zeros(len(file))
                    for j, (w, weight) in enumerate(zip(span.words, span.weight)):
                        inside = (start + j >= lo) & (start + j < hi)
                        share += weight * (inside & (h[np.where(inside, start + j, 0)] == w))
                    best = np.zeros(n)
                    np.maximum.at(best, file, share)
                    sums[:, span.template] += best
                whole = verified == keys
                score = np.minimum(np.where(whole, sums / total, 0).max(axis=1), 1) if n else np.empty(0)
                labels: list[set[str]] = [set() for _ in range(n)]
                base: list[set[str]] = [set() for _ in range(n)]
                for i, t in zip(*(x.tolist() for x in np.nonzero(whole))):
                    labels[i].add(ix.labels[t])
                    if t < N_BASE:
                        base[i].add(ix.labels[t])
                none = n_base == 0
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(np.diff(at)), pa.array(n_base), pa.array(first, mask=none), pa.array(last, mask=none),
                     pa.array([",".join(sorted(x)) for x in base], pa.string()), pa.array([",".join(sorted(x)) for x in labels], pa.string()), pa.array(score)],
                    ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"])
    return scan


def scan(files: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per file: n_words, n_base (places of base phrases), first_word, last_word, base_labels, labels, score."""
    rows = files.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(_scanner(index(idf_of(rows))), "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double")


def op7(spark, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents"))
