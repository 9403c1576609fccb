"""Tokenisers and string helpers as JVM-side column expressions.

The regular expressions below run unchanged in Java (Spark) and RE2
(DuckDB), so the oracle SQL can reuse the very same pattern text.
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal Python's definitions for identical tokens).
# Python's ``string.punctuation``: the 32 ASCII characters
#   ! " # $ % & ' ( ) * + , - . / : ; < = > ? @ [ \ ] ^ _ ` { | } ~
# i.e. the ranges 0x21-0x2F, 0x3A-0x40, 0x5B-0x60, 0x7B-0x7E.
PUNCT_RANGES = r"!-/:-@\[-`{-~"
# Python's ``str.isspace()`` set (what ``str.split()`` and ``\s`` use):
#   U+0009-000D, U+001C-001F, U+0020, U+0085, U+00A0, U+1680,
#   U+2000-200A, U+2028, U+2029, U+202F, U+205F, U+3000.
SPACE_RANGES = (r"\t\n\x0B\f\r\x1C-\x1F \x{85}\x{A0}\x{1680}"
                r"\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}")
# Hadoop text input line terminators.
LINE_BREAK = r"\r\n|\r|\n"
# ---------------------------------------------------------------------------

PUNCT_CLASS = f"[{PUNCT_RANGES}]"
SPACE_RUN = f"[{SPACE_RANGES}]+"
DELIM_RUN = f"[{PUNCT_RANGES}{SPACE_RANGES}]+"
# The same sets for Java: a letter is tested against two ranges and the span of
# the other blanks, not against every range in turn (a third of the time).
_JAVA_SPACE = (r"\t-\r\x1C-\x20[\x{85}-\x{3000}&&[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
               r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]]")
SPACE_RUN_JAVA = rf"[{_JAVA_SPACE}]+"
DELIM_RUN_JAVA = rf"[{PUNCT_RANGES}{_JAVA_SPACE}]+"


@lru_cache(maxsize=1)
def special_folds() -> tuple[tuple[str, str], ...]:
    """(character, its ``upper().lower()``) where one character becomes
    several, e.g. sharp s or a ligature: the engines map one to one, Python
    does not.  About 100 characters, by rule instead of as a table."""
    return tuple((c, c.upper().lower()) for c in map(chr, range(0x80, 0x20000))
                 if len(c.upper()) > 1 or len(c.lower()) > 1)


FINAL_SIGMA = r"(\p{L})σ([^\p{L}]|$)"      # a word's last sigma is written ς


@lru_cache(maxsize=1)
def special_class() -> str:
    """Character class of everything that one-to-one mapping gets wrong."""
    return "[" + "".join(char for char, _ in special_folds()) + "Σσς]"


def case_fold(c: Column) -> Column:
    """Python's ``upper().lower()``; only a text that holds one of the special
    characters goes through their mapping, character by character (a nested
    ``replace`` each is more code than the JVM compiles: it is interpreted).
    ``c`` enters several times, so let it be a plain column."""
    plain = F.lower(F.upper(c))
    fold = F.create_map(*[F.lit(x) for pair in special_folds() for x in pair])
    chars = F.transform(F.split(c, ""), lambda x: F.when(F.octet_length(x) > 1, F.coalesce(fold[x], x)).otherwise(x))
    folded = F.regexp_replace(F.lower(F.upper(F.array_join(chars, ""))), FINAL_SIGMA, "$1ς$2")
    ascii_only = F.octet_length(c) == F.char_length(c)
    return F.when(ascii_only | ~c.rlike(special_class()), plain).otherwise(folded)


def strip_punctuation(c: Column) -> Column:
    return F.regexp_replace(c, PUNCT_CLASS, "")


def split_lines(c: Column) -> Column:
    """Array of lines, terminators as in Hadoop's line reader."""
    return F.split(c, LINE_BREAK, -1)


def whitespace_tokens(c: Column) -> Column:
    """Raw ``str.split()`` tokens (punctuation still in, not case folded).

    Empty strings (from leading white space) must be dropped by the caller
    after ``explode``, where a plain filter stays inside whole-stage codegen;
    punctuation deletion and case folding are per-token maps, so the word
    count applies them once per distinct raw token.
    """
    return F.split(c, SPACE_RUN_JAVA, -1)


def delimited_tokens(c: Column) -> Column:
    """``re.split('[punct\\s]+', line)`` tokens (not case folded).

    With ``keep_empty`` the empty strings ``re.split`` yields at a line's
    start/end (and for empty lines) are kept, reproducing the original job;
    the caller must then split into lines first.  Otherwise the caller
    drops empty tokens after exploding.
    """
    return F.split(c, DELIM_RUN_JAVA, -1)


def format_count_line(word: Column, count: Column) -> Column:
    """``'%s %i'`` text-sink line."""
    return F.format_string("%s %d", word, count)


# Fixed value: the hour stamp inside a page-count dump path.
HOUR_PATH_PATTERN = r"/pagecounts-(\d{8}-\d{2})"


def path_to_hour(path: Column) -> Column:
    """``YYYYMMDD-HH`` from ``.../pagecounts-YYYYMMDD-HH...``; null when the
    path has no such stamp (instead of failing the job)."""
    return F.nullif(F.regexp_extract(path, HOUR_PATH_PATTERN, 1), F.lit(""))
