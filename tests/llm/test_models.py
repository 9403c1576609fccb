"""op3 and op5: held-out quality, decoding, edge cases."""
import numpy as np
import pytest
from llm_helpers import EDGE_ROWS, SF
from pyspark.sql import functions as F

from tessera.llm import langid, toxicity
from tessera.llm.queries import QUERIES

SF01 = "/root/testdata/sf0.01"


def test_codewords_differ_and_split():
    for n in (2, 3, 4, 5, 6, 12, 40):
        code = langid.codewords(n).astype(int)
        assert code.shape[0] == n and (np.abs(code.sum(axis=0)) < n).all()
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= (1 if n < 4 else code.shape[1] // 4)


def test_language_held_out_accuracy(spark):
    got = {r.doc_id: r for r in QUERIES["op5_ecoc_language_id"](spark, SF01).collect()}
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    held = [i for i, r in got.items() if r.held_out]
    assert len(got) == len(truth) and np.mean([got[i].lang_pred == truth[i] for i in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got.values())


def test_more_languages_than_the_exhaustive_code(spark):
    rng = np.random.RandomState(1)
    letters = "abcdefghijklmnopqrstuvwxyz"
    alphabets = ["".join(rng.permutation(list(letters))[:8]) for _ in range(9)]
    rows = [(f"l{k}", " ".join("".join(rng.choice(list(a), 5)) for _ in range(40)))
            for k, a in enumerate(alphabets) for _ in range(6)]
    model = langid.fit(spark.createDataFrame(rows, "lang string, text string"))
    df = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(rows)], "doc_id long, text string")
    got = {r.doc_id: r.lang_pred for r in langid.predict(df, model).collect()}
    assert np.mean([got[i] == rows[i][0] for i in got]) > 0.95


def test_language_edge_rows(spark, edge, nothing):
    model = langid.fit(edge.select("lang", "text"))
    got = {r.doc_id: r for r in langid.predict(edge, model, keep=("source",)).collect()}
    assert got[1].lang_pred == got[2].lang_pred == got[3].lang_pred == got[6].lang_pred == "und"
    assert got[4].lang_pred == "en" and got[7].lang_pred == "en"
    assert langid.predict(nothing, model).count() == 0
    empty = langid.fit(nothing.select("lang", "text"))
    assert {r.lang_pred for r in langid.predict(edge, empty).collect()} == {"und"}


def test_toxicity_held_out_quality(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    got = {r.doc_id: r for r in QUERIES["op3_noisy_channel_toxicity"](spark, SF01).collect()}
    assert len(got) == docs.count() and all(0 <= r.score <= 1 for r in got.values())
    rows = [(got[r.doc_id], r.toxic) for r in labels.collect()]
    right = [r.predicted == y for r, y in rows if r.held_out]
    assert np.mean(right) > 0.93
    assert all(r.predicted == int(r.score >= 0.5) for r, _ in rows)


@pytest.fixture(scope="module")
def decoder(docs):
    return toxicity.Decoder(toxicity.trigram_costs(toxicity.count_trigrams(docs)))


@pytest.mark.parametrize("seen,meant", [("1d10t", "idiot"), ("i d i o t", "idiot"), ("stuuuupid", "stupid"),
                                        ("l.o.s.e.r", "loser"), ("m0r0n", "moron"), ("cl0wn", "clown"),
                                        ("w0rthl3ss", "worthless"), ("p@thet1c", "pathetic"),
                                        ("the and of", "the and of"), ("well, all!", "well all")])
def test_decoder_restores(decoder, seen, meant):
    assert " ".join(decoder.restore(seen)) == meant


@pytest.mark.parametrize("glue", ["-", "/", ".", "_", "--", ",;"])
def test_decoder_restores_long_tokens(decoder, glue):
    words = {"1d10t": "idiot", "m0r0n": "moron", "w0rthl3ss": "worthless", "p@thet1c": "pathetic", "cl0wn": "clown", "loser": "loser"}
    token = glue.join([*words] * 2)
    assert len(token) > 40 and decoder.restore(token) == [*words.values()] * 2


def test_decoder_restores_letters_apart_in_a_long_token(decoder):
    assert decoder.restore("cl0wn/w0rthl3ss/s-t-u-p-1-d/p@thet1c/loser") == ["clown", "worthless", "stupid", "pathetic", "loser"]


@pytest.mark.parametrize("length", [20, 33, 50, 500])
@pytest.mark.parametrize("glue", ["-", "/", ".", "--"])
def test_decoder_restores_alike_at_any_length(decoder, glue, length):
    """A glued token gives the same words whatever its length, also where
    letters are set apart by mixed separators."""
    for unit, words in ((["cl0wn", "m0r0n"], {"clown", "moron"}), (["st.u-p1d"], None), (["p@thet1c", "s-t.u_p1d"], None)):
        once = glue.join(unit)
        token = glue.join(unit * (1 + length // len(once)))
        assert words is None or set(decoder.restore(token)) == words
        alone, many = "".join(decoder.restore(once)), "".join(decoder.restore(token))
        assert many == alone * (1 + length // len(once))


@pytest.mark.parametrize("n", range(1, 9))
def test_decoder_reads_whole_repeats(decoder, n):
    """Every repeat is in the lattice: no run is cut before decoding."""
    text = "s" + "o" * n + "0"
    assert len(decoder.lattice(text)) == len(text)
    best = _cheapest(decoder, text)
    assert _cheapest(decoder, text, decoder.decode(text)) == pytest.approx(best)


def _cheapest(decoder, text, out=None):
    """Cost of the cheapest path through the lattice, of those that spell ``out`` if given."""
    import itertools
    best = np.inf
    for path in itertools.product(*decoder.lattice(text)):
        word = "".join(x for x, _ in path)
        if out is None or word == out:
            codes = [0, 0, *(decoder._code(c) for c in word), 0]
            best = min(best, sum(c for _, c in path) + sum(decoder.costs[a][b][c] for a, b, c in zip(codes, codes[1:], codes[2:])))
    return best


def test_weights_match_plain_counts(spark):
    """Every feature of enough weight is kept, with its log-odds over the labelled rows."""
    import math
    import random
    rng, rows = random.Random(3), []
    for i in range(120):
        words = [rng.choice(["table", "floor", "window", "garden", "and", "the"]) for _ in range(20)]
        rows.append((i, " ".join(words + rng.sample(["grobian", "lummel", "schuft", "flegels"], 2) if i % 3 == 0 else words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    model = toxicity.fit(docs, spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows], "doc_id long, toxic int"))
    decoder, n = toxicity.Decoder(model.costs), {0: {}, 1: {}}
    for i, text in rows:
        for f in {f for w in decoder.restore(text) for f in toxicity.features(w)}:
            n[int(i % 3 == 0)][f] = n[int(i % 3 == 0)].get(f, 0) + 1
    odds = {f: math.log((k + .5) / 41) - math.log((n[0].get(f, 0) + .5) / 81) for f, k in n[1].items() if k >= toxicity.MIN_DOCS}
    want = {f: w for f, w in odds.items() if w >= toxicity.MIN_WEIGHT}
    assert len(want) >= 8 and model.weights == pytest.approx(want)


@pytest.mark.parametrize("n", [3, 5, 57, 70, 100_000])
def test_decoder_restores_long_repeats(decoder, n):
    assert decoder.restore("a stu" + "u" * n + "pid thing") == ["a", "stupid", "thing"]
    assert decoder.restore("stu" + "u" * n + "p1d") == ["stupid"]
    assert len(" ".join(decoder.restore("x1z" * n))) > 0


def test_viterbi_finds_the_cheapest_path(decoder):
    import itertools
    costs = np.array(decoder.costs)
    for text in ("1d10t", "s0", "a*b", "h3||o", "aaab"):
        best = None
        for path in itertools.product(*decoder.lattice(text)):
            a = b = 0
            total = 0.0
            for letter, channel in path:
                total += channel
                if letter:
                    c = decoder._code(letter)
                    total += costs[a][b][c]
                    a, b = b, c
            total += costs[a][b][0]
            best = min(best, total) if best is not None else total
            out = "".join(x for x, _ in path)
            if out == decoder.decode(text):
                found = min(total, locals().get("found", 1e9)) if locals().get("of") == text else total
                of = text
        assert found == pytest.approx(best)


def test_obfuscated_text_scores_like_plain(spark):
    docs, labels = (spark.read.parquet(f"{SF01}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = [(1, "The idiot was stupid and worthless"), (2, "The 1d10t was stuuupid and w0rthl3ss"),
            (3, "The i d i o t was s.t.u.p.i.d and worth1ess"), (4, "The table was on the floor"), (5, None)]
    got = {r.doc_id: r.score for r in toxicity.score(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got[1] > 0.5 and got[2] > 0.5 and got[3] > 0.5 and got[4] < 0.5 and got[5] < 0.5


def test_toxicity_edge_rows(spark, edge, nothing):
    labels = spark.createDataFrame([(1, 1), (4, 1), (5, 0), (5, 1), (None, 1), (8, None), (9, 0)], "doc_id long, toxic int")
    model = toxicity.fit(edge, labels)
    got = toxicity.score(edge, model).collect()
    assert len(got) == len(EDGE_ROWS) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score(nothing, toxicity.fit(nothing, labels.limit(0))).count() == 0
    assert toxicity.restored(edge, model.costs).count() == len(EDGE_ROWS)
    assert edge.select(toxicity.held_out(), langid.held_out()).where(F.col("doc_id").isNull()).count() == 2


def test_ngram_tables_are_added_in_two_levels(spark, docs, monkeypatch):
    plans, kind = [], type(docs)
    one, collect = langid.count_ngrams(docs.coalesce(1)), kind.collect
    monkeypatch.setattr(kind, "collect", lambda df: plans.append(df._jdf.queryExecution().toString()) or collect(df))
    many = langid.count_ngrams(docs.repartition(70))
    assert [x for x, _ in one] == [x for x, _ in many] and all((a == b).all() for (_, a), (_, b) in zip(one, many))
    assert plans[0].split("Physical Plan")[1].count("FlatMapGroupsInArrow") >= 2
