"""License scans (operator 2): diagonal voting.

Every rolling word k-gram hash of every text is joined, in Spark, with the
positions of the template k-grams. A hit votes for its diagonal (text position
minus template position); neighbouring diagonals whose hits lie close together
are merged into one region, padded by ``PAD`` words on both sides. Each region is
then verified against the text's own words: a base phrase must match word for
word, a template needs ``MIN_COVER`` of its words in order. Hash collisions
therefore never reach the result. A template's span reaches from the first to the
last of its words; spans of one template do not overlap (fullest, then shortest,
then first).

Tolerated for certain: 1 - ``MIN_COVER`` of the words missing or replaced, and
besides up to ``PAD`` words added in at most ``DRIFT`` places. The gram size of a
template follows from this (``gram_size``): so few cuts always leave a whole gram.
A license term (``TERMS``) that the template lacks names another license, so no
span reaches over it.

Templates are parameters of a fixed, small number, so their table is broadcast.
Spans are collected by document (bounded by its length). The verified pass is a
map over the documents when the span table is under ``BROADCAST_ROWS`` rows,
else a join by document; both give the same rows.

Cases: null or empty text has no words, no places and score 0; rows that repeat
an id are told apart by their text, equal rows each get the same result; a null
id stays null; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import bisect
import math
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from lendscope.llm.common import batch, byte_texts, staged
from lendscope.llm.words import ALNUM, LOWER, hash_words, mix, windows

#: phrase -> label (fixed values of the contract)
BASE_PHRASES = (
    ("gnu general public license", "gpl"),
    ("apache license", "apache"),
    ("cc by", "cc-by"),
    ("mit license", "mit"),
)
#: Notices of well-known licenses -> label of their own
TEMPLATES = (
    ("licensed under the apache license version 2 0", "apache-2.0"),
    ("you may not use this file except in compliance with the license you may obtain a copy of the license at",
     "apache-2.0"),
    ("this work is licensed under the gnu general public license version 3", "gpl-3.0"),
    ("this program is free software you can redistribute it and or modify it under the terms of the gnu general "
     "public license as published by the free software foundation either version 3 of the license or at your option "
     "any later version", "gpl-3.0"),
    ("licensed under cc by 4 0", "cc-by-4.0"),
    ("licensed under cc by nc 4 0", "cc-by-nc-4.0"),
    ("licensed under cc by sa 4 0", "cc-by-sa-4.0"),
    ("this work is licensed under a creative commons attribution 4 0 international license", "cc-by-4.0"),
    ("released under the mit license", "mit-notice"),
    ("permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
     "documentation files the software to deal in the software without restriction", "mit-text"),
    ("redistribution and use in source and binary forms with or without modification are permitted provided that the "
     "following conditions are met", "bsd"),
)
GRAM = 4
#: Diagonals this far apart, with hits at most this many words apart, are one span.
DRIFT = 3
GAP = 8
#: Words around a region that are verified too: added words move a template's ends off the diagonals of its hits.
PAD = DRIFT + GAP
MIN_COVER = 0.9
#: Terms that tell the Creative Commons licenses apart
TERMS = frozenset({b"nc", b"nd", b"sa"})
BROADCAST_ROWS = 200_000
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")

_HITS = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("pos", pa.int32()), ("gram", pa.int64())])
_OUT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
                  ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
                  ("labels", pa.string()), ("score", pa.float64()),
                  ("spans", pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()),
                                                ("end", pa.int32()), ("cover", pa.float64())])))])
_OUT_DDL = ("doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, "
            "labels string, score double, spans array<struct<label:string,start:int,end:int,cover:double>>")


def _grams(h: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    g, o = windows(h, offsets, k)
    return mix(g + np.uint64(k)).view(np.int64), o


def _rolling(sizes: Sequence[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                h, offsets = hash_words(byte_texts(part.column(2)), ALNUM)
                for k in sizes:
                    g, o = _grams(h, offsets, k)
                    n = np.diff(o)
                    row = pa.array(np.repeat(np.arange(len(n)), n))
                    pos = (np.arange(len(g)) - np.repeat(o[:-1], n)).astype(np.int32)
                    yield batch(_HITS, part.column(0).take(row), part.column(1).take(row), pos, g)
    return run


def needed(n_words: int, min_cover: float) -> int:
    """Words of a template of ``n_words`` that make ``min_cover``."""
    return math.ceil(min_cover * n_words - 1e-9)


def gram_size(n_words: int, min_cover: float) -> int:
    """The longest gram, up to ``GRAM``, that is left whole wherever the template
    is cut by missing words and ``DRIFT`` additions."""
    need = needed(n_words, min_cover)
    return max(1, min(GRAM, math.ceil(need / (n_words - need + DRIFT + 1))))


def _gram_sizes(templates: Sequence[tuple[str, str]], n_base: int, min_cover: float) -> list[int]:
    """Base phrases stand word for word, so only their length bounds the gram."""
    lengths = [len(t.split()) for t, _ in templates]
    return [min(GRAM, n) if i < n_base else gram_size(n, min_cover) for i, n in enumerate(lengths)]


def _template_rows(templates: Sequence[tuple[str, str]], sizes: Sequence[int]) -> list[tuple[int, int, int, int]]:
    """(gram, template number, position, gram size) of every template k-gram."""
    rows = []
    for t, ((text, _), k) in enumerate(zip(templates, sizes, strict=True)):
        h, o = hash_words([text.encode()], ALNUM)
        rows += [(int(g), t, p, k) for p, g in enumerate(_grams(h, o, k)[0])]
    return rows


def _places(template: list[bytes]) -> dict[bytes, list[int]]:
    """Word -> its positions in the template, last first."""
    out: dict[bytes, list[int]] = {}
    for p in range(len(template) - 1, -1, -1):
        out.setdefault(template[p], []).append(p)
    return out


def _matches(n: int, places: dict[bytes, list[int]], need: int, words: list[bytes],
             offset: int) -> set[tuple[int, int, int]]:
    """(words matched, start, end) of the stretches of ``words`` that hold ``need``
    or more of the template's ``n`` words in order, the shortest for each end."""
    spare, out = n - need, set()
    # last[t][s]: latest start of a match that ends with template word t and lacks s of the words before it
    last = [[-1] * (spare + 1) for _ in range(n)]
    for i, w in enumerate(words):
        if w not in places:
            if w in TERMS:
                last = [[-1] * (spare + 1) for _ in range(n)]
            continue
        for t in places[w]:
            for s in range(min(spare, t) + 1):
                start = i if s == t else max(last[t - 1 - j][s - j] for j in range(s + 1))
                last[t][s] = max(last[t][s], start)
                if start >= 0 and s + n - 1 - t <= spare:
                    out.add((t + 1 - s, offset + start, offset + i + 1))
    return out


def _apart(matches: set[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Matches that do not overlap: the fullest first, then the shortest, then the first in the text."""
    kept: list[tuple[int, int, int]] = []
    for m in sorted(matches, key=lambda m: (-m[0], m[2] - m[1], m[1])):
        at = bisect.bisect(kept, m[1], key=lambda k: k[1])
        if (at == 0 or kept[at - 1][2] <= m[1]) and (at == len(kept) or m[2] <= kept[at][1]):
            kept.insert(at, m)
    return kept


def _verify(templates: Sequence[tuple[str, str]], n_base: int, min_cover: float):
    words_of = [t.encode().split() for t, _ in templates]
    labels = [label for _, label in templates]
    places_of = [_places(t) for t in words_of]
    need = [needed(len(t), min_cover) for t in words_of]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, rows = byte_texts(b.column(1)), []
            for doc, text, spans in zip(b.column(0).to_pylist(), texts, b.column(2).to_pylist(), strict=True):
                if not spans:
                    rows.append((doc, _count(text), 0, None, None, "", "", 0.0, []))
                    continue
                words, places, found, matches = _WORD.findall(text.lower()), {}, [], {}
                for s in spans:
                    t, start, end = s["template"], max(0, s["start"]), min(len(words), s["end"])
                    if t < n_base:
                        if words[start:start + len(words_of[t])] == words_of[t]:
                            places[start, t] = 1
                            found.append((labels[t], start, start + len(words_of[t]), 1.0))
                    else:
                        matches.setdefault(t, set()).update(
                            _matches(len(words_of[t]), places_of[t], need[t], words[start:end], start))
                for t, m in matches.items():
                    found += [(labels[t], start, end, n / len(words_of[t])) for n, start, end in _apart(m)]
                starts = [p for p, _ in places]
                base = sorted({labels[t] for _, t in places})
                rows.append((doc, len(words), len(places), min(starts, default=None), max(starts, default=None),
                             ",".join(base), ",".join(sorted({f[0] for f in found})),
                             max((f[3] for f in found), default=0.0),
                             [dict(zip(("label", "start", "end", "cover"), f, strict=True))
                              for f in sorted(set(found), key=lambda f: (f[1], f[2], f[0]))]))
            if rows:
                yield batch(_OUT, *zip(*rows))
    return run


def _count(text: bytes) -> int:
    inside = ALNUM[LOWER[np.frombuffer(text, np.uint8)]]
    return int(inside[:1].sum() + (inside[1:] & ~inside[:-1]).sum())


def candidate_spans(docs: DataFrame, templates: Sequence[tuple[str, str]], n_base: int,
                    min_cover: float = MIN_COVER) -> DataFrame:
    """Merged diagonals: doc_id, text_key, template, start, end (in words; templates with ``PAD`` on both sides)."""
    spark = docs.sparkSession
    sizes = _gram_sizes(templates, n_base, min_cover)
    known = spark.createDataFrame(_template_rows(templates, sizes), "gram long, template int, tpos int, k int")
    lengths = [len(t.split()) for t, _ in templates]
    length = F.element_at(F.array(*[F.lit(n) for n in lengths]), F.col("template") + 1)
    key = ["doc_id", "text_key", "template"]
    hits = (docs.mapInArrow(_rolling(sorted(set(sizes))),
                            "doc_id long, text_key long, pos int, gram long")
            .join(F.broadcast(known), "gram")  # a few hundred template positions
            .select(*key, "pos", "k", (F.col("pos") - F.col("tpos")).alias("diagonal")).distinct())
    votes = hits.groupBy(*key, "diagonal").agg(F.count(F.lit(1)).alias("votes"), F.min("pos").alias("lo"),
                                               (F.max("pos") + F.max("k")).alias("hi"), F.max("k").alias("k"))
    exact = votes.where((F.col("template") < n_base) & (F.col("votes") == length - F.col("k") + 1))
    by_place = Window.partitionBy(*key).orderBy("lo", "diagonal")
    apart = ((F.col("lo") > F.lag("hi").over(by_place) + GAP)
             | (F.abs(F.col("diagonal") - F.lag("diagonal").over(by_place)) > DRIFT))
    merged = (votes.where(F.col("template") >= n_base)
              .withColumn("new", F.coalesce(apart, F.lit(True)).cast("int"))
              .withColumn("region", F.sum("new").over(by_place))
              .groupBy(*key, "region")
              .agg((F.min(F.least("lo", "diagonal")) - PAD).alias("start"),
                   (F.max(F.greatest(F.col("hi"), F.col("diagonal") + length)) + PAD).alias("end"))
              .select(*key, "start", "end"))
    return exact.select(*key, F.col("lo").alias("start"), F.col("hi").alias("end")).unionByName(merged)


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  base_phrases: Sequence[tuple[str, str]] = BASE_PHRASES,
                  templates: Sequence[tuple[str, str]] = TEMPLATES, min_cover: float = MIN_COVER,
                  broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_base, first_word, last_word,
    base_labels, labels, score, spans."""
    both = [*base_phrases, *templates]
    text = F.col(text_col).cast("string")
    keyed = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_key"),
                        text.alias("text"))
    spans = staged(candidate_spans(keyed, both, len(base_phrases), min_cover)
                   .groupBy("doc_id", "text_key")
                   .agg(F.collect_list(F.struct("template", "start", "end")).alias("spans")), "spans")
    other = spans.select(F.col("doc_id").alias("_doc"), F.col("text_key").alias("_key"), "spans")
    if spans.count() <= broadcast_rows:
        other = F.broadcast(other)
    found = keyed.join(other, keyed["doc_id"].eqNullSafe(other["_doc"]) & (keyed["text_key"] == other["_key"]), "left")
    return found.select("doc_id", "text", "spans").mapInArrow(_verify(both, len(base_phrases), min_cover), _OUT_DDL)
