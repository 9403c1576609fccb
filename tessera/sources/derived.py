"""Stand-ins for the original inputs, derived by Spark from the test tables.

The original jobs read station observations, page-count dumps, web logs,
link graphs and colour samples.  The test tables hold none of these, so
each view below rebuilds one from a test table with plain column
expressions; the same definitions appear as SQL in ``plans.oracle``.
All are lazy and grow with the table they read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.colour import COLOUR_RGB
from ..functions.numeric import cents
from ..operators.joins import broadcast_if_small
from .tables import load

# Fixed values of the derivations (kept identical in the oracle SQL).
TMAX_EVENT = "click"
TMIN_EVENT = "view"
QFLAG_EVERY = 10        # props k divisible by this -> quality flag 'X'
BAD_LINE_EVERY = 17     # props k divisible by this -> malformed log line / path


def props_k(props="props"):
    return F.regexp_extract(F.col(props), r"([0-9]+)", 1).cast("int")


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(station, date, observation, value, qflag) from ``events``."""
    ev = load(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("station"),
        F.col("ts").cast("date").alias("date"),
        F.when(F.col("event_type") == TMAX_EVENT, "TMAX")
         .when(F.col("event_type") == TMIN_EVENT, "TMIN")
         .otherwise(F.col("event_type")).alias("observation"),
        F.floor(F.col("value") * 10).cast("int").alias("value"),
        F.when(props_k() % QFLAG_EVERY == 0, F.lit("X")).alias("qflag"),
    )


def pagecounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(hour, language, title, views) from ``events``."""
    ev = load(spark, sf_dir, "events")
    return ev.select(
        F.date_format("ts", "yyyyMMdd-HH").alias("hour"),
        F.col("event_type").alias("language"),
        F.concat(F.lit("P"), F.col("user_id").cast("string")).alias("title"),
        F.floor("value").cast("bigint").alias("views"),
    )


def pagecount_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, path): dump-file paths, some without the hour pattern."""
    ev = load(spark, sf_dir, "events")
    good = F.concat(F.lit("/data/pagecounts-"), F.date_format("ts", "yyyyMMdd-HH"),
                    F.lit("0000.gz"))
    bad = F.concat(F.lit("/data/pagecounts-x"), F.col("event_id").cast("string"), F.lit(".gz"))
    return ev.select("event_id",
                     F.when(props_k() % BAD_LINE_EVERY == 0, bad).otherwise(good).alias("path"))


def loglines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(line_no, line): NASA-style access-log lines from ``events``.

    Bytes are the event's cents, or ``-`` (which the parser must reject)
    when the props number is a multiple of 17.
    """
    ev = load(spark, sf_dir, "events")
    nbytes = F.when(props_k() % BAD_LINE_EVERY == 0, F.lit("-")) \
              .otherwise(cents("value").cast("string"))
    line = F.concat(
        F.lit("h"), F.col("user_id").cast("string"), F.lit(" - - ["),
        F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss"), F.lit(" -0700] \"GET /"),
        F.col("event_type"), F.lit(" HTTP/1.0\" 200 "), nbytes)
    return ev.select(F.col("event_id").alias("line_no"), line.alias("line"))


MALFORMED_EVERY, WRONG_TYPE_EVERY, MISSING_EVERY = 17, 13, 11   # by the props number


def _faulty(good, malformed, wrong_type, missing):
    k = props_k()
    return (F.when(k % MALFORMED_EVERY == 0, malformed).when(k % WRONG_TYPE_EVERY == 0, wrong_type)
             .when(k % MISSING_EVERY == 0, missing).otherwise(good))


def comment_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): comments as JSON lines from ``events``; some are cut short,
    some have a score that is no number, some have none."""
    ev = load(spark, sf_dir, "events")
    head = F.concat(F.lit('{"author": "u'), F.col("event_id").cast("string"), F.lit('", "subreddit": "'), F.col("event_type"))
    score = F.concat(F.lit('", "score": '), cents("value").cast("string"))
    return ev.select(_faulty(F.concat(head, score, F.lit("}")), F.concat(head, score),
                             F.concat(head, F.lit('", "score": "many"}')), F.concat(head, F.lit('"}'))).alias("value"))


def observation_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(value): observations as CSV lines of eight fields from ``events``;
    some are cut short, some values are no number, some stations are empty."""
    ev = load(spark, sf_dir, "events")
    station, day = F.concat(F.lit("U"), F.col("user_id").cast("string")), F.date_format("ts", "yyyyMMdd")
    number = F.floor(F.col("value") * 10).cast("int").cast("string")
    rest = F.concat(F.lit(",,,E"), F.col("event_id").cast("string"), F.lit(",0700"))

    def line(who, value):
        return F.concat(who, F.lit(","), day, F.lit(","), F.col("event_type"), F.lit(","), value, rest)

    return ev.select(_faulty(line(station, number), F.concat(station, F.lit(","), day, F.lit(",E"), F.col("event_id").cast("string")),
                             line(station, F.lit("warm")), line(F.lit(""), number)).alias("value"))


def amenities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(amenid, amenity, tags{cuisine, kind, size}) from ``part``: the nested
    column's fields are the part's name, type and size."""
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("amenid"), F.when(F.col("p_size") % 2 == 0, "restaurant").otherwise("cafe").alias("amenity"),
        F.struct(F.col("p_name").alias("cuisine"), F.col("p_type").alias("kind"), F.col("p_size").alias("size")).alias("tags"))


def edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(source, node) link graph from ``lineitem``; node ids wrap at |part|.

    ``part.count`` enters as a scalar subquery, planned by Spark as a
    separate small job, not as a join.
    """
    li = load(spark, sf_dir, "lineitem")
    n_parts = load(spark, sf_dir, "part").select(F.count(F.lit(1))).scalar()
    return li.select(F.col("l_partkey").alias("source"),
                     (F.col("l_orderkey") % n_parts).alias("node")).distinct()


def adjacency_lines(edges_df: DataFrame, max_per_line: int = 1000) -> DataFrame:
    """Render an edge table as ``node: n1 n2 ...`` text lines (input format).

    A node with more than ``max_per_line`` neighbours is written as several
    lines (neighbours hashed into ``ceil(degree / max_per_line)`` chunks),
    so no line, and no aggregation group, grows with a hot node's degree;
    parsing the lines back gives the same edges.
    """
    # stored (and broadcast when its checked size allows), so the join back
    # is never an aggregate under a join: AQE can skew-split it when one
    # node holds most of the edges
    deg, _ = broadcast_if_small(edges_df.groupBy("source").agg(F.count(F.lit(1)).alias("_deg")))
    chunks = F.greatest(F.lit(1), F.ceil(F.col("_deg") / F.lit(max_per_line)))
    e = (edges_df.join(deg, "source")
                 .withColumn("_chunk", F.pmod(F.xxhash64("node"), chunks)))
    return (e.groupBy("source", "_chunk")
             .agg(F.array_join(F.array_sort(F.collect_list(F.col("node").cast("string"))), " ")
                  .alias("outs"))
             .select(F.concat(F.col("source").cast("string"), F.lit(": "), F.col("outs"))
                     .alias("value")))


def colours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(p_partkey, R, G, B, word) colour samples from ``part``: three
    independent channels from the key's md5, labelled with the nearest word of
    the colour table (the first of equals)."""
    digest = F.md5(F.col("p_partkey").cast("string").cast("binary"))
    channel = {c: F.conv(F.substring(digest, 1 + 2 * i, 2), 16, 10).cast("int").alias(c)
               for i, c in enumerate("RGB")}
    p = load(spark, sf_dir, "part").select("p_partkey", *channel.values())

    def apart(rgb):
        return sum(((F.col(c) - v) * (F.col(c) - v) for c, v in zip("RGB", rgb)), F.lit(0))

    nearest = F.least(*[apart(rgb) * 100 + i for i, rgb in enumerate(COLOUR_RGB.values())]) % 100
    words = F.array(*[F.lit(w) for w in COLOUR_RGB])
    return p.select("p_partkey", "R", "G", "B", F.get(words, nearest).alias("word"))


def tmax_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(station, date, latitude, longitude, elevation, tmax) from ``orders``.

    Every customer is a station, at a place given by its key; every order is
    an observation on its day and on the next one.  The temperature (tenths of
    a degree) has a yearly cycle, a station's level, a five-day weather term
    and a little noise from the order's price; a day's maximum counts.
    """
    k, price = F.col("o_custkey"), F.floor("o_totalprice").cast("bigint")
    day = F.to_date("o_orderdate")
    o = load(spark, sf_dir, "orders").select(
        k.alias("_k"), (price % 11).alias("_noise"), F.explode(F.array(day, F.date_add(day, 1))).alias("date"))
    k = F.col("_k")
    tenths = (F.lit(100) + F.abs((F.dayofyear("date") + 172) % 365 - 182) + k * 37 % 101
              + F.floor(F.datediff("date", F.lit("1992-01-01").cast("date")) / 5) * 7919 % 61 + F.col("_noise"))
    return (o.select(F.concat(F.lit("S"), k.cast("string")).alias("station"), "date",
                     (k % 120 - 60).cast("double").alias("latitude"),
                     (k * 7 % 360 - 180).cast("double").alias("longitude"),
                     (k * 13 % 2500).cast("double").alias("elevation"), tenths.alias("_t"))
             .groupBy("station", "date", "latitude", "longitude", "elevation")
             .agg((F.max("_t") / F.lit(10.0)).alias("tmax")))


def xy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(event_id, value) text ``"x y"`` points: x = event id, y = cents."""
    ev = load(spark, sf_dir, "events")
    return ev.select("event_id",
                     F.concat_ws(" ", F.col("event_id").cast("string"),
                                 cents("value").cast("string")).alias("value"))
