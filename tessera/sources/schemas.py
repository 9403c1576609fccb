"""Declared schemas of the original inputs (never inferred)."""

from __future__ import annotations

from pyspark.sql import types as T

# X1 text corpus
TEXT_SCHEMA = T.StructType([T.StructField("value", T.StringType())])

# X2 comments, short form
COMMENT_SCHEMA = T.StructType([
    T.StructField("subreddit", T.StringType()),
    T.StructField("score", T.LongType()),
    T.StructField("author", T.StringType()),
])

# X3 comments, full form (21 fields)
_X3 = [("archived", T.BooleanType()), ("author", T.StringType()),
       ("author_flair_css_class", T.StringType()), ("author_flair_text", T.StringType()),
       ("body", T.StringType()), ("controversiality", T.LongType()),
       ("created_utc", T.StringType()), ("distinguished", T.StringType()),
       ("downs", T.LongType()), ("edited", T.StringType()), ("gilded", T.LongType()),
       ("id", T.StringType()), ("link_id", T.StringType()), ("name", T.StringType()),
       ("parent_id", T.StringType()), ("retrieved_on", T.LongType()), ("score", T.LongType()),
       ("score_hidden", T.BooleanType()), ("subreddit", T.StringType()),
       ("subreddit_id", T.StringType()), ("ups", T.LongType())]
COMMENT_FULL_SCHEMA = T.StructType([T.StructField(n, t) for n, t in _X3])

# X4 page counts with the hour in the row (bytes unused)
PAGECOUNT_ROW_SCHEMA = T.StructType([
    T.StructField("hour", T.StringType()), T.StructField("language", T.StringType()),
    T.StructField("title", T.StringType()), T.StructField("views", T.LongType()),
    T.StructField("bytes", T.LongType()),
])

# X5 page counts with the hour in the file name
PAGECOUNT_FILE_SCHEMA = T.StructType([
    T.StructField("language", T.StringType()), T.StructField("title", T.StringType()),
    T.StructField("views", T.LongType()), T.StructField("bytes", T.LongType()),
])

# X6 daily station observations (CSV, no header)
WEATHER_SCHEMA = T.StructType([
    T.StructField("station", T.StringType()), T.StructField("date", T.StringType()),
    T.StructField("observation", T.StringType()), T.StructField("value", T.IntegerType()),
    T.StructField("mflag", T.StringType()), T.StructField("qflag", T.StringType()),
    T.StructField("sflag", T.StringType()), T.StructField("obstime", T.StringType()),
])

# Derived observations written as CSV (tessera.sources.derived.observations)
OBSERVATION_CSV_SCHEMA = T.StructType([
    T.StructField("station", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("observation", T.StringType()), T.StructField("value", T.IntegerType()),
    T.StructField("qflag", T.StringType()),
])

# X7/X8 parsed / stored web log
LOG_SCHEMA = T.StructType([
    T.StructField("host", T.StringType()), T.StructField("datetime", T.TimestampNTZType()),
    T.StructField("path", T.StringType()), T.StructField("bytes", T.LongType()),
    T.StructField("id", T.StringType()),
])
LOG_KEY = ("host", "id")

# X9 link graph edges
EDGE_SCHEMA = T.StructType([T.StructField("source", T.LongType()),
                            T.StructField("node", T.LongType())])

# X16 daily maximum temperature (CSV, no header)
TMAX_SCHEMA = T.StructType([
    T.StructField("station", T.StringType()), T.StructField("date", T.DateType()),
    T.StructField("latitude", T.FloatType()), T.StructField("longitude", T.FloatType()),
    T.StructField("elevation", T.FloatType()), T.StructField("tmax", T.FloatType()),
])

# X17 colour words (CSV, no header; file sources relax nullability)
COLOUR_SCHEMA = T.StructType([
    T.StructField("R", T.IntegerType(), False), T.StructField("G", T.IntegerType(), False),
    T.StructField("B", T.IntegerType(), False), T.StructField("word", T.StringType(), False),
    T.StructField("confidence", T.StringType(), False),
])
