"""Web access-log line parsing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The access-log pattern (host, time, path, bytes) and the
# time format of the bracketed field; the zone offset is matched, not kept.
LOG_PATTERN = r'^(\S+) - - \[(\S+) [+-]\d+\] "[A-Z]+ (\S+) HTTP/\d\.\d" \d+ (\d+)$'
LOG_TIME_FORMAT = "dd/MMM/yyyy:HH:mm:ss"


def log_fields(line: Column) -> Column:
    r"""The four groups as an array, with ONE regex evaluation per line.

    The anchored pattern rewrites a matching line to ``host\npath...``;
    the groups are ``\S+``/``\d+`` so none holds a newline, and a line
    that does not match comes back unchanged.  Lines containing a newline
    themselves (not possible from a line reader) are marked non-matching.
    """
    rewritten = F.regexp_replace(line, LOG_PATTERN, "$1\n$2\n$3\n$4")
    return F.when(~line.contains("\n"), F.split(rewritten, "\n"))


def log_time(text: Column) -> Column:
    """Wall-clock time of the bracketed field as ``timestamp_ntz``."""
    return F.try_to_timestamp(text, F.lit(LOG_TIME_FORMAT)).cast("timestamp_ntz")
