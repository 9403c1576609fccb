"""Word counts against plain-Python tokenisers on fixture X1 cases."""
import re
import string
from collections import Counter

from pyspark.sql import functions as F

from tessera.operators.wordcount import word_count
from tessera.sinks import write_count_lines

from conftest import rows

LINES = [
    "",                                   # empty line
    "...Hello, world!!",                  # starts/ends with punctuation
    "?!.,;",                              # only punctuation
    "MiXeD case Words words WORDS",
    "café naïve Straße façade CAFÉ",      # accents
    "non\u00a0breaking space\u2003em",     # NBSP and EM SPACE are white space
    "tab\tseparated\nnew line  double",
    "  leading and trailing  ",
    "it's a dog's-life; e-mail",
]

# Fixed value: the delimiter set, punctuation and white space.
WORDSEP = re.compile(r"[%s\s]+" % re.escape(string.punctuation))


def fold(w):
    return w.upper().lower()


def py_whitespace(lines, keep_empty=False):
    c = Counter()
    for line in lines:
        for w in line.split():
            w = fold(w.translate(str.maketrans("", "", string.punctuation)))
            if w or keep_empty:
                c[w] += 1
    return c


def py_delimited(lines, keep_empty=False):
    c = Counter()
    for line in lines:
        for sub in line.split("\n"):
            for w in WORDSEP.split(sub):
                w = fold(w)
                if w or keep_empty:
                    c[w] += 1
    return c


def _frame(spark):
    return spark.createDataFrame([(t,) for t in LINES], "value string")


def _expected(counter):
    return sorted(counter.items())


def test_whitespace_matches_python(spark):
    got = rows(word_count(_frame(spark), "value", "whitespace"))
    assert got == _expected(py_whitespace(LINES))


def test_delimited_matches_python(spark):
    got = rows(word_count(_frame(spark), "value", "delimited"))
    assert got == _expected(py_delimited(LINES))


def test_keep_empty_counts_the_empty_token(spark):
    got = dict(rows(word_count(_frame(spark), "value", "delimited", keep_empty=True)))
    exp = dict(_expected(py_delimited(LINES, keep_empty=True)))
    assert got == exp and got[""] > 0


def test_case_fold_merges_raw_variants(spark):
    got = dict(rows(word_count(_frame(spark), "value", "delimited")))
    assert got["words"] == 3 and got["café"] == 2


def test_min_partitions_spreads_without_changing_result(spark):
    df = _frame(spark).coalesce(1)
    a = rows(word_count(df, "value", "delimited"))
    b = rows(word_count(df, "value", "delimited", min_partitions=4))
    assert a == b


def test_count_line_sink(spark, tmp_path):
    wc = word_count(_frame(spark), "value", "whitespace")
    out = str(tmp_path / "wc")
    write_count_lines(wc, out)
    lines = spark.read.text(out).collect()
    got = [r.value for r in lines]
    assert "words 3" in got and "hello 1" in got
    assert all(re.fullmatch(r"\S+ \d+", x) for x in got)


from hypothesis import given, settings, HealthCheck, strategies as st  # noqa: E402

ALPHABET = list("abcXYZéÉß ,.;!?'-\t\n") + [" ", " ", "\x1c", "　"]


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=ALPHABET, max_size=40), min_size=1, max_size=30))
def test_tokenisers_match_python_on_random_text(spark, lines):
    df = spark.createDataFrame([(t,) for t in lines], "value string")
    assert rows(word_count(df, "value", "whitespace")) == _expected(py_whitespace(lines))
    assert rows(word_count(df, "value", "delimited")) == _expected(py_delimited(lines))


def test_special_case_mappings(spark):
    words = ["Straße", "STRASSE", "ﬁn", "ﬂ", "ŉ", "İ", "ΟΔΟΣ", "οδός", "ΣΣ", "ǰ"]
    got = dict(rows(word_count(spark.createDataFrame([(" ".join(words),)], "value string"))))
    assert got == dict(py_whitespace([" ".join(words)]))


def test_whitespace_count_keeps_the_empty_word(spark):
    got = word_count(_frame(spark), keep_empty=True)
    assert rows(got) == _expected(py_whitespace(LINES, keep_empty=True))
    assert py_whitespace(LINES, keep_empty=True)[""] > 0


def test_words_are_cleaned_once_per_distinct_token(spark):
    df = spark.createDataFrame([(t,) for t in LINES], "value string")
    for keep_empty in (False, True):
        plan = word_count(df, keep_empty=keep_empty)._jdf.queryExecution().optimizedPlan().toString()
        _, _, below = plan[plan.rindex("Aggregate"):].partition("\n")
        assert "regexp_replace" in plan and "regexp_replace" not in below
        assert "replace(replace(" not in plan        # more code than the JVM compiles


def test_blanks_and_delimiters_of_every_code_point(spark):
    points = [c for c in range(1, 0x3100) if not 0xD800 <= c < 0xE000] + [0xFEFF, 0x1D7CE, 0x1F600]
    df = spark.createDataFrame([(f"a{chr(c)}b",) for c in points], "value string")
    lines = [f"a{chr(c)}b" for c in points]
    for mode, expected in (("whitespace", py_whitespace(lines)), ("delimited", py_delimited(lines))):
        got = dict(rows(word_count(df, mode=mode)))
        assert (got["a"], sum(got.values())) == (expected["a"], expected.total())


def test_every_special_mapping_inside_a_word(spark):
    from tessera.functions.text import special_folds
    lines = [f"x{c}\U0001F600é{c}Y, {c}" for c, _ in special_folds()] + ["--- ... Σ ΑΣ ΑΣΣΑ"]
    df = spark.createDataFrame([(t,) for t in lines], "value string")
    assert rows(word_count(df)) == _expected(py_whitespace(lines))
