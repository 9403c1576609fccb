"""op9 and op10: licence scan and decontamination against brute force."""
import hashlib

import brute
from llm_helpers import EDGE_ROWS, SF, frame

from tessera.llm import license_scan as ls
from tessera.llm.decontaminate import decontaminate
from tessera.llm.queries import QUERIES


def test_license_query_matches_brute_force(spark, pairs):
    got = {r.doc_id: r for r in QUERIES["op9_license_scan"](spark, SF).collect()}
    for i, t in pairs:
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.license_base(t)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))


def test_license_phrases_in_odd_places(spark):
    texts = ["Under the MIT License", "under the mit,license! CC-BY-NC cc by nc", "apache license version 2.0",
             "under the mit licenses", "cc by ncé", "ccby nc", "under the under the mit license", "CC BY\nNC " * 3,
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"]
    got = {r.doc_id: r for r in ls.license_scan(frame(spark, list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.license_base(t)
    assert got[8].labels == "mit" and got[8].n_base == 0 and got[8].score > 0.9


def _edited(rng, words, key, share):
    """The words with a share of those outside the key phrase replaced."""
    at = next(p for p in range(len(words)) if words[p:p + len(key)] == key)
    free = [p for p in range(len(words)) if not at <= p < at + len(key)]
    gone = set(rng.sample(free, int(share * len(free))))
    return [f"x{rng.randint(0, 99)}" if p in gone else w for p, w in enumerate(words)]


def _holds(seq, words, key):
    """Whether some alignment agrees in enough words and holds the key phrase."""
    for at in range(1 - len(words), len(seq)):
        a, b = max(at, 0), min(at + len(words), len(seq))
        same = sum(seq[i] == words[i - at] for i in range(a, b))
        if same >= ls.MIN_AGREE * len(words) and any(seq[p:p + len(key)] == key for p in range(a, b - len(key) + 1)):
            return True
    return False


def test_edited_licences_are_found(spark, rng):
    """Recall of the aligned templates against every alignment, and no false label."""
    filler, rows, want = ["the", "of", "this", "file", "and", "word", "software", "license"], [], {}
    for share in (0.0, 0.2, 0.5, 0.9):
        for label, words, key in ls.TEMPLATES:
            body = _edited(rng, words.split(), key.split(), share)
            seq = [rng.choice(filler) for _ in range(30)] + body + [rng.choice(filler) for _ in range(30)]
            want[len(rows)] = {x for x, w, k in ls.TEMPLATES if _holds(seq, w.split(), k.split())}
            rows.append((len(rows), " ".join(seq)))
    got = {r.doc_id: set(filter(None, r.labels.split(","))) for r in ls.license_scan(frame(spark, rows), phrases={}).collect()}
    pairs = [(i, x) for i, labels in want.items() for x in labels]
    assert len(pairs) > 25 and sum(x in got[i] for i, x in pairs) >= 0.95 * len(pairs)
    assert all(got[i] <= want[i] for i in got)


def test_licence_without_its_rarest_words_is_found(spark):
    """The next words of the file by IDF take over from those it lacks."""
    rule = ("own", "zyx wvu tsr key phrase here and some more words", "key phrase")
    common = [(i, "key phrase here and some more words all over") for i in range(1, 9)]
    rows = [(0, "lead key phrase here and some more words tail"), (9, "zyx wvu tsr"), (10, "key words phrase")]
    got = {r.doc_id: r.labels for r in ls.license_scan(frame(spark, rows + common), phrases={}, templates=[rule]).collect()}
    assert got[0] == "own" and got[9] == got[10] == ""


def test_license_edge_rows(spark, edge, nothing):
    assert ls.license_scan(edge).count() == len(EDGE_ROWS)
    assert ls.license_scan(nothing).count() == 0


def _contamination(spark, rows, items, parts=3):
    df = decontaminate(frame(spark, rows, parts), spark.createDataFrame(items, "item_id long, text string"))
    assert {r.doc_id: (r.n_words, r.n_hit, r.n_items, ",".join(r.item_ids)) for r in df.collect()} == \
        brute.contamination(rows, items)


def test_contamination_of_random_texts(spark, rng):
    for words in (["a", "b"], list("abcdefghijklm"), ["a", "É", "é", "x9", "straße"]):
        items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 14)))) for i in range(12)]
        rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(0, 120))) + " "
                 + (rng.choice(items)[1].upper() if "É" not in words else "") + "," + rng.choice(words)) for i in range(40)]
        _contamination(spark, rows, items)


def test_contamination_query_matches_brute_force(spark, pairs):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute.contamination(pairs, items)
    for r in QUERIES["op10_benchmark_decontamination"](spark, SF).collect():
        n_words, n_hit, n_items, joined = want[r.doc_id]
        assert (r.n_words, r.n_hit, r.n_items) == (n_words, n_hit, n_items) and r.contaminated == (n_hit > 0)
        assert r.items_sha256 == hashlib.sha256(joined.encode()).hexdigest()


def test_contamination_runs_no_python(spark, docs):
    plan = decontaminate(docs, spark.read.parquet(f"{SF}/benchmark.parquet"))._jdf.queryExecution().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas"))


def test_proximity_matches_include_near_misses(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    near = item.replace("gamma", "other")
    df = decontaminate(frame(spark, [(1, near), (2, item), (3, "alpha kappa")]),
                       spark.createDataFrame([(5, item)], "item_id long, text string"))
    got = {r.doc_id: r for r in df.collect()}
    assert got[1].n_hit == 0 and got[1].near_item_ids in (["5"], [])
    assert got[2].item_ids == ["5"] and got[2].near_item_ids == ["5"] and not got[3].near_item_ids


def test_rows_without_id_are_judged_apart(spark):
    """Many null-id rows, half of them contaminated: each by its own text."""
    item = "one two three four five six seven eight nine ten eleven"
    rows = [(None, f"{item} tail {i}" if i % 2 else f"clean text number {i}") for i in range(400)] + [(7, item), (7, "other")]
    bench = spark.createDataFrame([("q", item)], "item_id string, text string")
    got = decontaminate(frame(spark, rows), bench).collect()
    assert sum(r.contaminated for r in got) == 201 and len(got) == 402
    assert {(r.n_words, r.n_hit) for r in got if r.doc_id is None} == {(13, 11), (4, 0)}


def test_contamination_edge_rows(spark, edge, nothing):
    bench = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (None, "one two three"), (3, "one")],
                                  "item_id long, text string")
    got = decontaminate(edge, bench).collect()
    assert len(got) == len(EDGE_ROWS)
    assert sorted(r.n_hit for r in got if r.doc_id in (4, 5)) == [1, 1, 1]
    assert decontaminate(nothing, bench).count() == 0
    assert decontaminate(edge, bench.limit(0)).where("contaminated").count() == 0


def test_contamination_by_items_that_stand_twice(spark, rng):
    words = [f"w{i}" for i in range(60)]
    short, long = (" ".join(rng.choice(words) for _ in range(n)) for n in (10, 25))
    items = [(1, short), (1, short), (2, long), (2, long), (2, long), (None, "x y z"), (None, "x y z"), (3, short)]
    rows = [(1, "before " + short + " after"), (2, " ".join(long.split()[4:19])), (3, long), (4, "clean")]
    _contamination(spark, rows, items[:5] + items[7:])
    df = decontaminate(frame(spark, [(1, "a x y z b")]), spark.createDataFrame(items, "item_id long, text string"))
    assert [(r.n_hit, r.n_items) for r in df.collect()] == [(3, 0)]
