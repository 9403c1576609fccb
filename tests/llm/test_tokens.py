"""op2 and op7: tokenizers against the libraries' own results."""
import hashlib

import numpy as np
import pytest
from llm_helpers import EDGE_ROWS, SF, frame
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import bpe, token_counts as tc
from tessera.llm.queries import BYTE_PATTERN, QUERIES, TOKENIZERS

tokenizers = pytest.importorskip("tokenizers")
WORD = f"{TOKENIZERS}/word_bpe_49k.json"
RANKS = f"{TOKENIZERS}/byte_bpe_50k.tiktoken"


@pytest.fixture(scope="module")
def vocab():
    with open(WORD) as f:
        return bpe.Vocabulary(f.read(), bpe.UnicodeGaps.of(WORD))


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(WORD)


def _ids(vocab, text, lexicon):
    return np.frombuffer(bpe.Encoder(vocab, lexicon).encode([text])[0], "<u4")


EMPTY = bpe.Transducer.compile({})


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=80))
def test_any_text_encodes_like_the_library(vocab, library, text):
    ids = _ids(vocab, text, EMPTY)
    want = library.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == want
    assert vocab.decode(ids).decode() == library.decode(want, skip_special_tokens=False)


@pytest.mark.parametrize("text", ["<|startoftext|>Hi<|endoftext|>'S it's I'LL", "a" * 5000, "ab" * 3000 + "!" * 700,
                                  "ΑΣ ΟΔΟΣ İstanbul ﬁ Å", "\x00\x85\xa0　x\x1cy", "", "aaaa aaaaa"])
def test_odd_texts_encode_like_the_library(vocab, library, text):
    assert _ids(vocab, text, EMPTY).tolist() == library.encode(text, add_special_tokens=False).ids


def test_transducer_is_minimal_and_exact(vocab, rng):
    words = sorted({"".join(rng.choice("abcd") for _ in range(rng.randint(1, 7))).encode() for _ in range(500)})
    entries = dict(zip(words, vocab.merge(words)))
    t = bpe.Transducer.mapped(bpe.Transducer.compile(entries).to_bytes())
    others = [b"", b"e", b"abcdabcdabcd"] + [w + b"e" for w in words[:20]]
    at = t.lookup(words + others)
    assert at.tolist() == [*range(len(words)), *[-1] * len(others)]
    for i, w in enumerate(words):
        assert t.ids[t.first[i]:t.first[i + 1]].tobytes() == entries[w]
    # no two states accept the same set of suffixes
    out = {}
    for e, target in zip(t.edges.tolist(), t.target.tolist()):
        out.setdefault(e >> 8, []).append((e & 255, target))
    seen = [(int(t.final[s]), tuple(out.get(s, ()))) for s in range(len(t.final)) if s == 0 or s in t.target]
    assert len(set(seen)) == len(seen)


def test_bpe_query_matches_the_library(spark, pairs, library):
    got = {r.doc_id: r for r in QUERIES["op7_transducer_bpe"](spark, SF).collect()}
    for i, text in pairs:
        ids = library.encode(text, add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_bpe_edge_rows(spark, edge, nothing, library):
    got = bpe.encode(edge, WORD).collect()
    want = sorted(len(library.encode(t or "", add_special_tokens=False).ids) for _, t in EDGE_ROWS)
    assert sorted(r.n_tokens for r in got) == want
    assert bpe.encode(nothing, WORD).count() == 0


@pytest.mark.parametrize("rule", tc.RULES)
def test_allocation_rules(rng, rule):
    for _ in range(200):
        n, m = rng.randint(1, 12), rng.randint(1, 6)
        ends = np.cumsum([rng.randint(1, 6) for _ in range(n)])
        size = int(ends[-1])
        cuts = np.array(sorted({0, *(rng.randint(0, size - 1) for _ in range(m - 1))}))
        got, crossing = tc.allocate(ends, cuts, size, rule)
        want, cross = np.zeros(len(cuts)), np.zeros(len(cuts), int)
        for a, b in zip([0, *ends[:-1]], ends):
            part = [max(0, min(b, hi) - max(a, lo)) for lo, hi in zip(cuts, [*cuts[1:], size])]
            own = [i for i, p in enumerate(part) if p]
            for i in own if len(own) > 1 else ():
                cross[i] += 1
            if rule == "share":
                want += np.array(part) / sum(part)
            else:
                want[own[0] if rule == "start" else part.index(max(part))] += 1
        assert np.allclose(got, want) and crossing.tolist() == cross.tolist()


def test_section_tokens_add_up_to_the_library(spark, pairs):
    tiktoken = pytest.importorskip("tiktoken")
    enc = tiktoken.Encoding("t", pat_str=BYTE_PATTERN, mergeable_ranks=tc.read_ranks(RANKS), special_tokens={})
    rows = QUERIES["op2_section_token_counts"](spark, SF).collect()
    total, size = {}, {}
    for r in rows:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_tokens
        size[r.doc_id] = size.get(r.doc_id, 0) + r.n_bytes
    for i, t in pairs:
        assert total[i] == len(enc.encode_ordinary(t)) and size[i] == len(t.encode())
    assert sum(r.n_crossing for r in rows) > 0


def _byte_encoding():
    tiktoken = pytest.importorskip("tiktoken")
    return tiktoken.Encoding("t", pat_str=BYTE_PATTERN, mergeable_ranks=tc.read_ranks(RANKS), special_tokens={})


def test_white_space_is_cut_as_the_pattern_does(rng):
    enc = _byte_encoding()
    for _ in range(500):
        text = "".join(rng.choice(["a", "B7", "!", " ", "  ", "\t", "\n\n", "\u3000", "\x85", "\x1c", "é", "'s"])
                       for _ in range(rng.randint(0, 40)))
        for n in (1, 2, 3, 5):
            assert tc.encode_text(enc, text, n).tolist() == enc.encode_ordinary(text)


def test_very_long_white_space(spark):
    blanks = {1: " " * 1000000, 2: "\t" * 1000000 + "end", 3: "a " + "\n " * 600000 + " b", 4: "x" * 300000 + " " * 50000}
    got = tc.section_tokens(frame(spark, list(blanks.items())), RANKS, BYTE_PATTERN, "most", "lines").groupBy("doc_id") \
            .sum("n_tokens", "n_bytes").collect()
    enc = _byte_encoding()
    assert {r[0]: r[2] for r in got} == {i: len(t) for i, t in blanks.items()}
    assert {r[0]: r[1] for r in got} == {i: len(tc.encode_text(enc, t)) for i, t in blanks.items()}


def test_sections_match_plain_allocation(spark, rng):
    """Sections, boundary-crossing tokens and their allocation, token by token."""
    enc = _byte_encoding()
    texts = {i: "".join(rng.choice(["One two. ", "three!\n", "x.y ", "4? ", "\n\n", "é. ", "the end"]) for _ in range(12)) for i in range(30)}
    for rule in tc.RULES:
        got = {(r.doc_id, r.section): r for r in tc.section_tokens(
            frame(spark, list(texts.items())), RANKS, BYTE_PATTERN, rule, "sentences").collect()}
        for i, text in texts.items():
            raw = text.encode()
            cuts = [0, *[m.end() for m in tc.SECTIONS["sentences"].finditer(raw) if m.end() < len(raw)], len(raw)]
            want, crossing, at = [0.0] * (len(cuts) - 1), [0] * (len(cuts) - 1), 0
            for token in enc.decode_tokens_bytes(enc.encode_ordinary(text)):
                share = [max(0, min(at + len(token), b) - max(at, a)) for a, b in zip(cuts, cuts[1:])]
                held = [k for k, n in enumerate(share) if n]
                for k in held:
                    crossing[k] += len(held) > 1
                    if rule == "share":
                        want[k] += share[k] / len(token)
                if rule != "share":
                    want[held[0] if rule == "start" else share.index(max(share))] += 1
                at += len(token)
            rows = [got[i, k] for k in range(len(cuts) - 1)]
            assert [r.n_tokens for r in rows] == pytest.approx(want) and [r.n_crossing for r in rows] == crossing
            assert [(r.first_byte, r.n_bytes) for r in rows] == [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def test_section_edge_rows(spark, edge, nothing):
    got = tc.section_tokens(edge, RANKS, BYTE_PATTERN, "share", "lines").collect()
    assert {r.doc_id for r in got} == {i for i, _ in EDGE_ROWS}
    assert sum(r.n_tokens for r in got if r.doc_id == 1) == 0
    assert tc.section_tokens(nothing, RANKS, BYTE_PATTERN).count() == 0
