"""Token counts per section, from one encoding of the whole document.

A document is encoded once; every token has its byte span in the text.  The
spans are joined with the sections' spans: a token inside a section counts
there, one that crosses boundaries is allocated by an explicit rule:

* ``most``: the section that holds most of its bytes, the first of equals;
* ``start``: the section that holds its first byte;
* ``share``: every section in proportion to the bytes it holds.

Sections are the document's lines or its sentences, each with the white space
that follows it (so a token that begins with that blank crosses into the next
sentence).  The vocabulary is a rank file of a byte-level tokenizer (base64 token and rank per line), given
as a parameter; tokens are byte strings that follow one another without gaps,
so their spans are the running sums of their lengths.
"""

from __future__ import annotations

import base64
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from . import textblock as tb
from .common import documents

RULES = ("most", "start", "share")
# Where a section ends: after a line's end, or after a sentence's end mark and white space.
SECTIONS = {"lines": re.compile(rb"\n"), "sentences": re.compile(rb"[.!?][\x20\x09-\x0D]+|\n[\x20\x09-\x0D]*")}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


# The characters with the Unicode property White_Space (\\s of the splitting pattern).
WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_WHITE = 10_000


def encode_text(enc, text: str, long_white: int = LONG_WHITE) -> np.ndarray:
    """Token ids of a text with white space of any length.

    The splitting pattern (whose blanks are ``\\s+(?!\\S)|\\s+``) backtracks over
    a run of white space, which its engine refuses for very long ones.  The
    split has a closed form: a run at the text's end is one piece; another run
    is one piece but for its last character, which begins the text behind it.
    """
    ids, at = [], 0
    for run in re.finditer(f"[{WHITE}]{{{long_white},}}", text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids.append(enc.encode_to_numpy(text[at:run.start()], disallowed_special=()))
        if end > run.start():
            ids.append(np.array(enc._encode_single_piece(text[run.start():end]), np.uint32))
        at = end
    return np.concatenate([*ids, enc.encode_to_numpy(text[at:], disallowed_special=())])


def section_starts(data: bytes, kind: str) -> np.ndarray:
    """First byte of every section of a text (one section for an empty text)."""
    ends = [m.end() for m in SECTIONS[kind].finditer(data)]
    if ends and ends[-1] == len(data):
        ends.pop()
    return np.array([0, *ends], np.int64)


def allocate(ends: np.ndarray, cuts: np.ndarray, size: int, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(tokens, tokens that cross into or out of it) of each section.

    ``ends``: end of each token (the first starts at 0); ``cuts``: start of each
    section.  This is an interval join of two sorted lists.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}")
    n = len(cuts)
    count, crossing = np.zeros(n), np.zeros(n, np.int64)
    if not len(ends):
        return count, crossing
    starts = np.concatenate([[0], ends[:-1]])
    a = np.searchsorted(cuts, starts, "right") - 1
    b = np.searchsorted(cuts, ends - 1, "right") - 1
    inside = a == b
    count += np.bincount(a[inside], minlength=n)
    bounds = np.append(cuts, size)
    two = np.flatnonzero(b == a + 1)              # nearly all crossing tokens
    if len(two):
        x, y = a[two], b[two]
        left = bounds[y] - starts[two]
        size_of = (ends - starts)[two]
        np.add.at(crossing, x, 1)
        np.add.at(crossing, y, 1)
        if rule == "share":
            np.add.at(count, x, left / size_of)
            np.add.at(count, y, 1 - left / size_of)
        else:
            count += np.bincount(x if rule == "start" else np.where(2 * left >= size_of, x, y), minlength=n)
    for t in np.flatnonzero(b > a + 1).tolist():
        own = np.arange(a[t], b[t] + 1)
        part = np.minimum(ends[t], bounds[own + 1]) - np.maximum(starts[t], bounds[own])
        crossing[own] += 1
        if rule == "share":
            count[own] += part / part.sum()
        else:
            count[own[0] if rule == "start" else own[int(part.argmax())]] += 1
    return count, crossing


def section_tokens(docs: DataFrame, rank_path: str, pattern: str, rule: str = "most",
                   sections: str = "sentences", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document row and section: doc_id, section (from 0), first_byte,
    n_bytes, n_tokens (double under ``share``, whole numbers else), n_crossing.

    The sections' tokens add up to the document's.  A null or empty text is
    one empty section without tokens.  Rows with null or repeated ids are
    treated one by one.  ``pattern`` is the tokenizer's splitting pattern.
    """
    if rule not in RULES or sections not in SECTIONS:
        raise ValueError(f"unknown rule {rule!r} or sections {sections!r}")
    docs = documents(docs, id_col, text_col)
    ranks = docs.sparkSession.sparkContext.broadcast((read_ranks(rank_path), pattern))

    def run(batches):
        import tiktoken
        table, pat = ranks.value
        enc = tiktoken.Encoding("sections", pat_str=pat, mergeable_ranks=table, special_tokens={})
        length = np.zeros(max(table.values()) + 1, np.int64)
        for token, rank in table.items():
            length[rank] = len(token)
        for batch in batches:
            ids, col = batch.column(0), tb.column(batch, "text")
            for i, j, buf, offs in tb.blocks(col):
                raw = buf.tobytes()
                row, section, first, n_bytes, n_tokens, n_crossing = [], [], [], [], [], []
                for r, text in enumerate(col.slice(i, j - i).to_pylist()):
                    size = int(offs[r + 1] - offs[r])
                    cuts = section_starts(raw[offs[r]:offs[r + 1]], sections)
                    ends = np.cumsum(length[encode_text(enc, text)]) if text else np.zeros(0, np.int64)
                    if len(ends) and ends[-1] != size:
                        raise ValueError("token spans do not cover the text")
                    count, crossing = allocate(ends, cuts, size, rule)
                    row.append(np.full(len(cuts), i + r))
                    section.append(np.arange(len(cuts)))
                    first.append(cuts)
                    n_bytes.append(np.diff(np.append(cuts, size)))
                    n_tokens.append(count)
                    n_crossing.append(crossing)
                yield pa.RecordBatch.from_arrays(
                    [ids.take(pa.array(np.concatenate(row))), *[pa.array(np.concatenate(x)) for x in
                                                                (section, first, n_bytes, n_tokens, n_crossing)]],
                    ["doc_id", "section", "first_byte", "n_bytes", "n_tokens", "n_crossing"])

    return docs.mapInArrow(run, "doc_id bigint, section bigint, first_byte bigint, n_bytes bigint, "
                                "n_tokens double, n_crossing bigint")
