"""Byte-pair encoding with a minimal acyclic transducer as its lexicon.

1. Words are counted in Spark over all documents; the most frequent, at most
   ``LEXICON_WORDS``, are encoded once on the driver.
2. They are compiled into a minimal acyclic automaton whose equal suffixes are
   shared.  Its transitions carry numbers that add up, along a word's path, to
   the word's rank, which points to its ids: a transducer from words to ids.
   The flat arrays go to the executors, which memory-map them.
3. A task walks all distinct words of a block through the automaton at once.
   Words that fall out of it are merged exactly, many at a time; very long
   ones by a heap.

The vocabulary file is a parameter (the ``tokenizers`` JSON format: NFC,
lower case, a splitting pattern, bytes as printable characters, an end-of-word
suffix and no decoder, so decoding joins the tokens by blanks).
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import tempfile
import unicodedata
from collections import Counter
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import textblock as tb
from .common import documents, stored

LEXICON_WORDS = 1 << 17
HELD_BYTES = 64 << 20       # of words and chunks that a task remembers
ENTRY_BYTES = 160           # of a remembered one, besides its letters and ids
LONG_WORD = 200            # symbols beyond which a word is merged by a heap
NO_RANK = np.int64(1 << 40)

# Unicode white space (what the splitting pattern's \\s stands for)
_SPACE = "".join((r"\t-\r\x20\x85\xa0", "\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"))
_SEPARATORS = re.compile("[\x1c-\x1f]")
_PRIVATE = 0xF0000         # private-use characters stand in for those of UnicodeGaps.others


def _byte_chars() -> list[str]:
    """The printable character that stands for each byte: itself where it is
    printable Latin-1, else the next code point from 256 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(spare)) for b in range(256)]


class UnicodeGaps(NamedTuple):
    """Characters newer than this Python's tables, as the tokenizers library
    sees them: those it takes for neither letters nor numbers, and lower case
    forms that ``str.lower`` lacks."""
    others: str
    lower: dict[str, str]

    @classmethod
    def of(cls, vocab_path: str) -> UnicodeGaps:
        new = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"
               and regex.match(r"[\p{L}\p{N}]", chr(c))]
        try:
            from tokenizers import Tokenizer
        except ImportError:
            return cls("".join(new), {})
        library = Tokenizer.from_file(vocab_path)
        split, normal = library.pre_tokenizer.pre_tokenize_str, library.normalizer.normalize_str
        lower = {c: normal(c) for c in new}
        return cls("".join(c for c in new if len(split(":" + c)) == 1), {c: x for c, x in lower.items() if x != c})


class Vocabulary:
    """Merge table, initial symbols and token strings of a vocabulary file."""

    def __init__(self, text: str, gaps: UnicodeGaps = UnicodeGaps("", {})):
        spec = json.loads(text)
        model = spec["model"]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or spec["decoder"] or spec["post_processor"]:
            raise ValueError("this vocabulary needs another normaliser, model or decoder")
        suffix = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        chars = _byte_chars()
        self.inner = np.array([vocab[c] for c in chars], np.int64)
        self.final = np.array([vocab[c + suffix] for c in chars], np.int64)
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in pairs], np.int64)
        right = np.array([vocab[b] for _, b in pairs], np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        key = left << 32 | right
        order = np.argsort(key, kind="stable")
        self.pair, self.rank, self.made = key[order], order.astype(np.int64), made[order]
        # all places of a word's lowest pair may merge at once only if a
        # token's merges all come after the merge that makes it
        born = {int(t): r for r, t in enumerate(made)}
        if len(born) != len(made) or any(born.get(int(t), -1) >= r for r in range(len(made))
                                         for t in (left[r], right[r])):
            raise ValueError("merges are not in the order in which their parts arise")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens: dict[int, bytes] = {i: t.encode() for t, i in vocab.items()}
        self.tokens.update({i: t.encode() for t, i in self.special.items()})
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(pattern.replace(r"\s", _SPACE))
        self.rare = frozenset(gaps.others).union(gaps.lower)
        self.high = re.compile(f"[{min(self.rare)}-\U0010ffff]") if self.rare else None
        self.lower = str.maketrans(gaps.lower)
        self.stand_in = {ord(c): _PRIVATE + i for i, c in enumerate(gaps.others)}
        self.back = {v: k for k, v in self.stand_in.items()}
        self.cut = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")") \
            if self.special else None

    # -- text to words ----------------------------------------------------

    def normal(self, text: str) -> str:
        if not text.isascii():
            # one character at a time there is no final-sigma rule
            text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
            if self.lower and self._has_gap(text):
                text = text.translate(self.lower)
        return text.lower()

    def _has_gap(self, text: str) -> bool:
        # nearly every text ends at one of the first two tests
        return bool(self.rare) and not text.isascii() and bool(self.high.search(text)) and not self.rare.isdisjoint(text)

    def chunks(self, text: str) -> list[str]:
        """Stretches between white space, normalised: no word crosses them, so
        they are what is remembered.  A special token comes as itself."""
        if self.cut is not None and any(t in text for t in self.special):
            return [c for part in self.cut.split(text)
                    for c in ([part] if part in self.special else self._split(part))]
        return self._split(text)

    def _split(self, text: str) -> list[str]:
        text = self.normal(text)
        # str.split() parts at \x1c-\x1f too, the pattern does not
        return self.pieces(text) if _SEPARATORS.search(text) else text.split()

    def pieces(self, chunk: str) -> list[str]:
        """Words of a chunk."""
        if chunk in self.special:
            return [chunk]
        if self._has_gap(chunk):
            return [w.translate(self.back) for w in self.pattern.findall(chunk.translate(self.stand_in))]
        return self.pattern.findall(chunk)

    def words(self, text: str) -> list[str]:
        """Words of a text, in order."""
        return [w for c in self.chunks(text) for w in self.pieces(c)]

    # -- exact merging ----------------------------------------------------

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        key = left << 32 | right
        at = np.minimum(np.searchsorted(self.pair, key), len(self.pair) - 1)
        hit = self.pair[at] == key
        return np.where(hit, self.rank[at], NO_RANK), self.made[at]

    def merge(self, words: list[bytes]) -> list[bytes]:
        """Ids (little-endian uint32) of each word, by merging from the bytes."""
        out: list = [None] * len(words)
        short = [i for i, w in enumerate(words) if 0 < len(w) <= LONG_WORD]
        for i, w in enumerate(words):
            if not 0 < len(w) <= LONG_WORD:
                out[i] = self._merge_long(w)
        if not short:
            return out
        offs = np.zeros(len(short) + 1, np.int64)
        np.cumsum([len(words[i]) for i in short], out=offs[1:])
        data = np.frombuffer(b"".join(words[i] for i in short), np.uint8)
        sym = self.inner[data]
        sym[offs[1:] - 1] = self.final[data[offs[1:] - 1]]
        owner = np.repeat(np.array(short), np.diff(offs))
        while len(sym):
            rank, made = self._ranks(sym[:-1], sym[1:])
            rank[owner[1:] != owner[:-1]] = NO_RANK
            rank, made = np.append(rank, NO_RANK), np.append(made, 0)
            first = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
            low = np.minimum.reduceat(rank, first)
            size = np.diff(np.append(first, len(sym)))
            done = low == NO_RANK
            if done.any():
                for w in np.flatnonzero(done).tolist():
                    a = first[w]
                    out[owner[a]] = sym[a:a + size[w]].astype("<u4").tobytes()
                live = np.repeat(~done, size)
                sym, owner, rank, made = sym[live], owner[live], rank[live], made[live]
                low, size = low[~done], size[~done]
                if not len(sym):
                    break
            take = rank == np.repeat(low, size)
            # of overlapping places (a run of one symbol) every second merges
            run = np.flatnonzero(take)
            if len(run):
                start = np.concatenate([[True], run[1:] != run[:-1] + 1])
                since = np.arange(len(run)) - np.maximum.accumulate(np.where(start, np.arange(len(run)), 0))
                take[run[since % 2 == 1]] = False
            sym = np.where(take, made, sym)
            keep = np.ones(len(sym), bool)
            keep[np.flatnonzero(take) + 1] = False
            sym, owner = sym[keep], owner[keep]
        return out

    def _merge_long(self, word: bytes) -> bytes:
        n = len(word)
        if not n:
            return b""
        data = np.frombuffer(word, np.uint8)
        sym = self.inner[data]
        sym[-1] = self.final[data[-1]]
        rank, made = self._ranks(sym[:-1], sym[1:])
        sym, after, before = sym.tolist(), [*range(1, n), -1], [-1, *range(n - 1)]
        heap = [(r, i, sym[i], sym[i + 1], m) for i, (r, m) in enumerate(zip(rank.tolist(), made.tolist())) if r < NO_RANK]
        heapq.heapify(heap)
        while heap:
            _, i, a, b, m = heapq.heappop(heap)
            j = after[i] if sym[i] == a else -1
            if j < 0 or sym[j] != b:
                continue
            sym[i], sym[j], after[i] = m, -1, after[j]
            if after[i] >= 0:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y >= 0:
                    at = int(np.searchsorted(self.pair, sym[x] << 32 | sym[y]))
                    if at < len(self.pair) and self.pair[at] == sym[x] << 32 | sym[y]:
                        heapq.heappush(heap, (int(self.rank[at]), x, sym[x], sym[y], int(self.made[at])))
        return np.array([s for s in sym if s >= 0], "<u4").tobytes()

    def decode(self, ids: np.ndarray) -> bytes:
        """Text of ids: their tokens joined by blanks (UTF-8)."""
        return b" ".join(map(self.tokens.__getitem__, ids.tolist()))


# -- the transducer ---------------------------------------------------------

class Transducer:
    """Minimal acyclic automaton over bytes with additive outputs.

    ``edges`` are (state << 8 | byte), sorted; ``target`` and ``add`` belong to
    them; ``final`` marks accepting states.  The sum of ``add`` along a word
    is its index among the sorted words, ``first[index]:first[index + 1]`` its
    ids.
    """

    FIELDS = (("edges", "<i8"), ("target", "<i4"), ("add", "<i4"), ("final", "u1"), ("first", "<i8"), ("ids", "<u4"))

    def __init__(self, arrays: dict[str, np.ndarray]):
        for name, _ in self.FIELDS:
            setattr(self, name, arrays[name])

    @classmethod
    def compile(cls, entries: dict[bytes, bytes]) -> Transducer:
        """Build from word -> ids, adding sorted words one by one and sharing
        every state that is equal to an earlier one (same finality, same
        transitions)."""
        words = sorted(entries)
        shared: dict[tuple, int] = {}
        done: list[tuple[bool, tuple]] = []      # state: (final, ((byte, target), ...))
        path: list[list] = [[False, []]]         # open states of the last word
        last = b""

        def settle(depth):
            while len(path) > depth + 1:
                final, out = path.pop()
                key = (final, tuple(out))
                state = shared.setdefault(key, len(done))
                if state == len(done):
                    done.append(key)
                path[-1][1].append((last[len(path) - 1], state))

        for w in words:
            same = 0
            while same < min(len(w), len(last)) and w[same] == last[same]:
                same += 1
            settle(same)
            path += [[False, []] for _ in range(len(w) - same)]
            path[-1][0] = True
            last = w
        settle(0)
        done.append((path[0][0], tuple(path[0][1])))
        root = len(done) - 1
        below = [0] * len(done)                  # words accepted from a state; targets come first
        edges, target, add = [], [], []
        for s, (final, out) in enumerate(done):
            n = int(final)
            name = 0 if s == root else s + 1     # the root is state 0
            for byte, t in out:
                edges.append(name << 8 | byte)
                target.append(t + 1)
                add.append(n)
                n += below[t]
            below[s] = n
        order = np.argsort(np.array(edges, np.int64), kind="stable")
        final = np.zeros(len(done) + 1, np.uint8)
        for s, (f, _) in enumerate(done):
            final[0 if s == root else s + 1] = f
        first = np.zeros(len(words) + 1, np.int64)
        np.cumsum([len(entries[w]) // 4 for w in words], out=first[1:])
        return cls({"edges": np.array(edges, np.int64)[order], "target": np.array(target, np.int32)[order],
                    "add": np.array(add, np.int32)[order], "final": final, "first": first,
                    "ids": np.frombuffer(b"".join(entries[w] for w in words), "<u4")})

    def to_bytes(self) -> bytes:
        parts = [np.ascontiguousarray(getattr(self, name), dtype) for name, dtype in self.FIELDS]
        return np.array([len(p) for p in parts], "<i8").tobytes() + b"".join(
            p.tobytes() + b"\0" * (-p.nbytes % 8) for p in parts)

    @classmethod
    def mapped(cls, data: bytes) -> Transducer:
        """Memory-map the arrays from an unnamed file (it vanishes with the process)."""
        with tempfile.TemporaryFile() as f:
            f.write(data)
            f.flush()
            whole = np.memmap(f, np.uint8, "r")
        sizes, at, arrays = whole[:8 * len(cls.FIELDS)].view("<i8"), 8 * len(cls.FIELDS), {}
        for (name, dtype), n in zip(cls.FIELDS, sizes.tolist()):
            nbytes = n * np.dtype(dtype).itemsize
            arrays[name] = whole[at:at + nbytes].view(dtype)
            at += nbytes + -nbytes % 8
        return cls(arrays)

    def lookup(self, words: list[bytes]) -> np.ndarray:
        """Index of each word, -1 if it is not in the lexicon."""
        n = len(words)
        lens = np.array([len(w) for w in words], np.int64)
        found = np.full(n, -1, np.int64)
        if not n or not len(self.edges):
            return found
        offs = np.concatenate([[0], np.cumsum(lens)])
        data = np.frombuffer(b"".join(words), np.uint8)
        who = np.flatnonzero(lens > 0)
        state, total, at = np.zeros(len(who), np.int64), np.zeros(len(who), np.int64), 0
        while len(who):
            key = state << 8 | data[offs[who] + at]
            e = np.minimum(np.searchsorted(self.edges, key), len(self.edges) - 1)
            ok = self.edges[e] == key
            who, e = who[ok], e[ok]
            state, total = self.target[e].astype(np.int64), total[ok] + self.add[e]
            at += 1
            end = lens[who] == at
            hit = end & (self.final[state] == 1)
            found[who[hit]] = total[hit]
            who, state, total = who[~end], state[~end], total[~end]
        return found


class Encoder:
    """Texts to ids: words through the transducer, the rest by exact merging.
    What is known of words and chunks is held, up to about ``held_bytes``."""

    def __init__(self, vocab: Vocabulary, lexicon: Transducer, held_bytes: int = HELD_BYTES):
        self.held_bytes = held_bytes
        self.vocab, self.lexicon = vocab, lexicon
        self.held: dict[str, bytes] = {}         # word -> ids
        self.chunk_ids: dict[str, bytes] = {}
        self.size = 0

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids (little-endian uint32) of each text."""
        chunks = [self.vocab.chunks(t) for t in texts]
        if self.size > self.held_bytes:
            self.held, self.chunk_ids, self.size = {}, {}, 0
        known = self.chunk_ids
        new = [c for c in set().union(*chunks) if c not in known]
        pieces = [self.vocab.pieces(c) for c in new]
        self.learn({w for p in pieces for w in p})
        held = self.held
        for c, p in zip(new, pieces):
            known[c] = got = held[p[0]] if len(p) == 1 else b"".join([held[w] for w in p])
            self.size += ENTRY_BYTES + len(c) + len(got)
        return [b"".join([known[c] for c in cs]) for cs in chunks]

    def learn(self, words: set[str]) -> None:
        """Resolve words that are not held yet."""
        new = [w for w in words if w not in self.held]
        self.size += sum(ENTRY_BYTES + 5 * len(w) for w in new)
        special = self.vocab.special
        for w in [w for w in new if w in special]:
            self.held[w] = np.array([special[w]], "<u4").tobytes()
        new = [w for w in new if w not in special]
        raw = [w.encode() for w in new]
        at = self.lexicon.lookup(raw)
        first, ids = self.lexicon.first, self.lexicon.ids.tobytes()
        rest = []
        cuts = (first * 4).tolist()
        for i, k in enumerate(at.tolist()):
            if k < 0:
                rest.append(i)
            else:
                self.held[new[i]] = ids[cuts[k]:cuts[k + 1]]
        for i, got in zip(rest, self.vocab.merge([raw[i] for i in rest])):
            self.held[new[i]] = got


def count_words(docs: DataFrame, vocab, held_bytes: int = HELD_BYTES) -> DataFrame:
    """(word, n) over all documents; ``vocab`` broadcasts Vocabulary's arguments."""

    def run(batches):
        v, chunks = Vocabulary(*vocab.value), Counter()

        def counted():
            words = Counter()
            for c, n in chunks.items():
                for w in v.pieces(c):
                    words[w] += n
            chunks.clear()
            return pa.RecordBatch.from_pydict({"word": list(words), "n": list(words.values())},
                                              pa.schema([("word", pa.string()), ("n", pa.int64())]))

        for batch in batches:
            for text in tb.column(batch, "text").to_pylist():
                chunks.update(v.chunks(text))
                if len(chunks) >= held_bytes // ENTRY_BYTES:
                    yield counted()
        yield counted()

    return docs.select("text").mapInArrow(tb.tidied(run), "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def build_lexicon(docs: DataFrame, vocab: tuple, size: int = LEXICON_WORDS, held_bytes: int = HELD_BYTES) -> Transducer:
    """Transducer of at most ``size`` words: those above the count that leaves
    no more of them (words that occur once are never frequent).  The cut is
    read off the histogram of the counts, so no more than ``size`` words
    reach the driver."""
    sc = docs.sparkSession.sparkContext
    v = Vocabulary(*vocab)
    counts = stored(count_words(docs, sc.broadcast(vocab), held_bytes).where("n > 1"), "words")
    cut, total = 1, 0
    for n, words in counts.groupBy("n").agg(F.count(F.lit(1)).alias("words")).orderBy(F.desc("n")).limit(size).collect():
        total += words
        if total > size:
            cut = n
            break
    words = [w.encode() for w, in counts.where(F.col("n") > cut).select("word").collect() if w not in v.special]
    return Transducer.compile(dict(zip(words, v.merge(words))))


def encode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text",
           lexicon_words: int = LEXICON_WORDS, columns: tuple[str, ...] = ("ids_le", "decoded"),
           held_bytes: int = HELD_BYTES) -> DataFrame:
    """One row per input row: doc_id, n_tokens and the ``columns`` asked for:
    ids_le (the ids as little-endian uint32 bytes), ids (array<int>), decoded
    (the ids' text), decoded_sha256 (lowercase hex of its UTF-8).

    Encodes every whole text without adding special tokens; a special token's
    own string in a text becomes its id.  A null or empty text, or one of
    white space only, has no tokens and decodes to the empty string.  Null and
    repeated ids are kept as they come.  The vocabulary file is read on the
    driver from ``vocab_path``.
    """
    docs = documents(docs, id_col, text_col)
    with open(vocab_path, encoding="utf-8") as f:
        spec = f.read(), UnicodeGaps.of(vocab_path)
    sc = docs.sparkSession.sparkContext
    vocab = sc.broadcast(spec)
    lexicon = sc.broadcast(build_lexicon(docs, spec, lexicon_words, held_bytes).to_bytes())

    def run(batches):
        v = Vocabulary(*vocab.value)
        enc = Encoder(v, Transducer.mapped(lexicon.value), held_bytes)
        for batch in batches:
            ids, col = batch.column(0), tb.column(batch, "text")
            for i, j, _, _ in tb.blocks(col):
                le = enc.encode(col.slice(i, j - i).to_pylist())
                made = {"doc_id": ids.slice(i, j - i), "n_tokens": pa.array([len(x) // 4 for x in le], pa.int64())}
                if "ids_le" in columns:
                    made["ids_le"] = pa.array(le, pa.binary())
                if "ids" in columns:
                    offs = np.concatenate([[0], np.cumsum([len(x) // 4 for x in le])]).astype(np.int32)
                    made["ids"] = pa.ListArray.from_arrays(pa.array(offs), pa.array(np.frombuffer(b"".join(le), "<i4")))
                if "decoded" in columns or "decoded_sha256" in columns:
                    decoded = [v.decode(np.frombuffer(x, "<u4")) for x in le]
                    made["decoded"] = pa.array(decoded, pa.binary()).cast(pa.string())
                    made["decoded_sha256"] = pa.array([hashlib.sha256(x).hexdigest() for x in decoded])
                yield pa.RecordBatch.from_arrays([made[c] for c in names], names)

    names = ["doc_id", "n_tokens", *columns]
    types = {"doc_id": "bigint", "n_tokens": "bigint", "ids_le": "binary", "ids": "array<int>", "decoded": "string",
             "decoded_sha256": "string"}
    return docs.mapInArrow(tb.tidied(run), ", ".join(f"{c} {types[c]}" for c in names))

