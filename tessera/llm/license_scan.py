"""License scan: a positional index over rare licence words.

Templates are short word sequences with a label and mandatory key phrases.
1. One pass counts in how many documents each template word occurs (a
   vocabulary of a few hundred words, so the driver holds a bounded table).
2. A file's licence words are ranked by IDF, and the highest of them that a
   template holds are looked up in its postings (word, offset): where the file
   lacks a template's rarest word, its next ones take over.  ``position -
   offset`` is the place where the template would start, and a template is
   aligned where enough postings agree on it.
3. An aligned place counts only if one of the mandatory key phrases stands
   there word for word; a file without all words of a key phrase can't hold it
   and is not looked up.

A base phrase is itself a template whose every word must agree, so all places
of a phrase come out of the same postings.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblock as tb
from .common import documents

# Fixed values of the scan's contract: phrase -> label.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Opening words of public licences and notices (label, words,
# mandatory key phrase).
TEMPLATES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software",
     "permission is hereby granted free of charge"),
    ("apache-2", "licensed under the apache license version 2 0 the license you may not use this file",
     "apache license version 2 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted",
     "redistribution and use in source and binary forms"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms "
            "of the gnu general public license", "gnu general public license"),
    ("lgpl", "under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0",
     "mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee",
     "permission to use copy modify and or distribute"),
    ("unlicense", "this is free and unencumbered software released into the public domain",
     "free and unencumbered software"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license",
     "creative commons attribution 4 0"),
    ("cc0", "cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
]
ANCHORS = 6          # words of a file looked up per template, of highest IDF
MIN_AGREE = 0.6      # share of a template's words that must agree at the place


def _hash_words(words: list[str]) -> np.ndarray:
    data = [w.encode() for w in words]
    offs = np.concatenate([[0], np.cumsum([len(w) for w in data])]).astype(np.int64)
    return tb.span_hash(np.frombuffer(b"".join(data), np.uint8), offs[:-1], offs[1:])


def _vocabulary(templates) -> list[str]:
    return sorted({w for _, words, _ in templates for w in words})


def _doc_words(batch: pa.RecordBatch):
    """Yield (row range, bytes, word starts, ends, first word per row, hashes)."""
    for i, j, raw, offs in tb.blocks(tb.column(batch, "text")):
        buf = tb.LOWER[raw]
        s, e, first = tb.word_spans(buf, offs, tb.ALNUM_WORD)
        yield i, j, buf, s, e, first, tb.span_hash(buf, s, e)


class _Lexicon:
    """Word -> small integer, by 64-bit hash (places are checked by bytes)."""

    def __init__(self, words: list[str]):
        h = _hash_words(words)
        order = np.argsort(h)
        self.hash, self.code = h[order], order

    def find(self, hashes):
        """(index of each word that is in the lexicon, its code)."""
        at = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        hit = np.flatnonzero(self.hash[at] == hashes)
        return hit, self.code[at[hit]]


def document_frequencies(docs: DataFrame, words: list[str]) -> tuple[int, dict[str, int]]:
    """(documents, word -> documents that hold it) for a fixed word list."""

    def count(batches):
        lex, df, n = _Lexicon(words), np.zeros(len(words), np.int64), 0
        for batch in batches:
            n += batch.num_rows
            for i, j, buf, s, e, first, h in _doc_words(batch):
                hit, code = lex.find(h)
                row = np.searchsorted(first, hit, "right") - 1
                df += np.bincount(np.unique(row * len(words) + code) % len(words), minlength=len(words))
        yield pa.RecordBatch.from_pydict({"code": pa.array(np.arange(len(words) + 1)),
                                          "n": pa.array(np.append(df, n))})

    rows = docs.select("text").mapInArrow(count, "code bigint, n bigint") \
               .groupBy("code").agg(F.sum("n").alias("n")).collect()
    got = {r["code"]: r["n"] for r in rows}
    return got.get(len(words), 0), {w: got.get(c, 0) for c, w in enumerate(words)}


class _Index:
    """Postings of every template word, and the IDF order of the words.

    ``words[t]`` are a template's word codes, ``keys[t]`` those of its key phrase
    (None: a base phrase, all of it), ``ranked[t]`` its distinct codes from the
    highest IDF down, ``offsets[t, code]`` the word's places in it.
    """

    def __init__(self, rules, total: int, df: dict[str, int]):
        self.vocab = _vocabulary(rules)
        code = {w: i for i, w in enumerate(self.vocab)}
        idf = [math.log((1 + total) / (1 + df.get(w, 0))) for w in self.vocab]
        self.words = [np.array([code[w] for w in words]) for _, words, _ in rules]
        self.keys = [None if key is None else np.array([code[w] for w in key]) for _, _, key in rules]
        self.ranked = [sorted(set(x.tolist()), key=lambda c: (-idf[c], c)) for x in self.words]
        self.offsets = {(t, c): np.flatnonzero(x == c) for t, x in enumerate(self.words) for c in set(x.tolist())}
        self.needed = np.zeros((len(rules), len(self.vocab)), bool)
        for t, key in enumerate(self.keys):
            self.needed[t, self.words[t] if key is None else key] = True

    def open(self, codes: np.ndarray) -> tuple[np.ndarray, list[int]]:
        """(which words a file of these codes has, rules whose mandatory words are among them)."""
        here = np.zeros(len(self.vocab), bool)
        here[codes] = True
        return here, np.flatnonzero(~(self.needed & ~here).any(axis=1)).tolist()

    def places(self, seq: np.ndarray, here: np.ndarray, rules: list[int]):
        """[(rule, first word, end word, share)] in one document's word codes
        (-1: not in the vocabulary)."""
        out = []
        for t in rules:
            words, key = self.words[t], self.keys[t]
            # all words of a base phrase must be there, so its rarest is enough
            look = [c for c in self.ranked[t] if here[c]][:1 if key is None else ANCHORS]
            at = np.concatenate([(np.flatnonzero(seq == c)[:, None] - self.offsets[t, c]).ravel() for c in look])
            starts, votes = np.unique(at, return_counts=True)
            if key is None:
                out += [(t, at, at + len(words), 1.0) for at in starts.tolist()
                        if at >= 0 and np.array_equal(seq[at:at + len(words)], words)]
                continue
            for at in starts[votes >= min(2, len(words))].tolist():
                a, b = max(at, 0), min(at + len(words), len(seq))
                inside = seq[a:b]
                share = float((inside == words[a - at:b - at]).sum()) / len(words)
                if share >= MIN_AGREE and any(np.array_equal(inside[p:p + len(key)], key)
                                              for p in range(len(inside) - len(key) + 1)):
                    out.append((t, a, b, share))
        return out


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 phrases: dict[str, str] | None = None, templates=None) -> DataFrame:
    """Scan every whole text; one row per input row.

    Columns: doc_id, n_words, n_base (places of the base phrases), first_word
    and last_word (smallest and largest start word of those places, null if
    none), base_labels, labels (base labels and those of aligned templates,
    sorted, comma-joined), score (1 with a base place, else the best share of
    agreeing words of an accepted template, 0 without any), spans (label,
    first word, end word of every place).

    A null or empty text has no words.  Rows with a null or repeated doc_id
    are scanned like any other.  Overlapping places all count.  An empty
    table gives an empty result.
    """
    phrases = BASE_PHRASES if phrases is None else phrases
    rules = [(label, words.split(), None) for words, label in phrases.items()]
    rules += [(label, words.split(), key.split()) for label, words, key in (TEMPLATES if templates is None else templates)]
    docs = documents(docs, id_col, text_col)
    total, df = document_frequencies(docs, _vocabulary(rules))
    index = _Index(rules, total, df)
    labels = [label for label, _, _ in rules]

    def spelled(buf, s, e, word, place):
        """A base place, checked byte for byte."""
        t, a, b, _ = place
        return [buf[s[w]:e[w]].tobytes().decode("utf-8", "replace") for w in range(word + a, word + b)] == rules[t][1]

    def scan(batches):
        lex = _Lexicon(index.vocab)
        for batch in batches:
            rows: dict[str, list] = {k: [] for k in SCHEMA.names}
            rows["doc_id"] = batch.column(0).to_pylist()
            for i, j, buf, s, e, first, h in _doc_words(batch):
                hit, c = lex.find(h)
                at = np.searchsorted(hit, first)
                rows["n_words"] += np.diff(first).tolist()
                for r in range(j - i):
                    a, b = at[r], at[r + 1]
                    found = []
                    here, opened = index.open(c[a:b])
                    if opened:
                        seq = np.full(first[r + 1] - first[r], -1, np.int64)
                        seq[hit[a:b] - first[r]] = c[a:b]
                        found = [x for x in index.places(seq, here, opened)
                                 if x[0] >= len(phrases) or spelled(buf, s, e, first[r], x)]
                    base = [x for x in found if x[0] < len(phrases)]
                    rows["n_base"].append(len(base))
                    rows["first_word"].append(min((x[1] for x in base), default=None))
                    rows["last_word"].append(max((x[1] for x in base), default=None))
                    rows["base_labels"].append(",".join(sorted({labels[x[0]] for x in base})))
                    rows["labels"].append(",".join(sorted({labels[x[0]] for x in found})))
                    rows["score"].append(max((x[3] for x in found), default=0.0))
                    rows["spans"].append([{"label": labels[t], "first": p, "end": q} for t, p, q, _ in found])
            yield pa.RecordBatch.from_pydict(rows, schema=SCHEMA)

    return docs.mapInArrow(scan, SPARK_SCHEMA)


SPARK_SCHEMA = ("doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                "base_labels string, labels string, score double, "
                "spans array<struct<label:string,first:bigint,end:bigint>>")
SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_base", pa.int64()),
                    ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()),
                    ("labels", pa.string()), ("score", pa.float64()),
                    ("spans", pa.list_(pa.struct([("label", pa.string()), ("first", pa.int64()),
                                                  ("end", pa.int64())])))])
