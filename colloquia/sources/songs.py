"""Song listings from search-API replies (the HTTP fetch itself is not built).

Input: ``artist, page, payload`` with the reply JSON of one search page.
Pages are read from 1 up to ``max_pages`` and stop at the first page that is
missing or has no hits; hits whose primary artist matches the searched name
(case-insensitive) are kept, the first ``max_songs`` per artist in
(page, hit) order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_SONGS = 40   # fixed value: songs listed per artist
MAX_PAGES = 5    # fixed value: search pages read per artist

RESULT = T.StructType([
    T.StructField("title", T.StringType()), T.StructField("url", T.StringType()),
    T.StructField("id", T.LongType()),
    T.StructField("primary_artist", T.StructType([T.StructField("name", T.StringType())]))])
REPLY_SCHEMA = T.StructType([T.StructField("response", T.StructType([
    T.StructField("hits", T.ArrayType(T.StructType([T.StructField("result", RESULT)])))]))])


def song_listing(replies: DataFrame, max_songs: int = MAX_SONGS,
                 max_pages: int = MAX_PAGES) -> DataFrame:
    """``artist, song_no, title, url, id``.

    Both windows are per artist over at most ``max_pages`` pages of hits, so
    every window partition is bounded by the paging parameters.
    """
    parsed = (replies.where(F.col("page").between(1, max_pages))
              .select("artist", "page",
                      F.from_json("payload", REPLY_SCHEMA)["response"]["hits"].alias("hits")))
    upto = Window.partitionBy("artist").orderBy("page").rowsBetween(Window.unboundedPreceding, 0)
    nonempty = F.coalesce(F.size("hits"), F.lit(0)) > 0
    pages = (parsed.withColumn("_run", F.sum(F.when(nonempty, 1).otherwise(0)).over(upto))
             .where(F.col("_run") == F.col("page")))   # pages 1..page all answered
    hits = pages.select("artist", "page", F.posexplode("hits").alias("pos", "h"))
    mine = hits.where(F.lower(F.col("h.result.primary_artist.name")) == F.lower(F.col("artist")))
    order = Window.partitionBy("artist").orderBy("page", "pos")
    ranked = mine.withColumn("song_no", (F.row_number().over(order) - 1).cast("long"))
    return ranked.where(F.col("song_no") < max_songs).select(
        "artist", "song_no", F.col("h.result.title").alias("title"),
        F.col("h.result.url").alias("url"), F.col("h.result.id").alias("id"))


SONG = T.StructType([T.StructField("song_no", T.LongType()), T.StructField("title", T.StringType()),
                     T.StructField("url", T.StringType()), T.StructField("id", T.LongType())])
LIST_SCHEMA = T.StructType([T.StructField("artist", T.StringType()),
                            T.StructField("songs", T.ArrayType(SONG))])


def write_song_lists(listing: DataFrame, path: str) -> None:
    """One JSON list per artist (``songs``), many artists to a file in artist order.

    A list holds at most ``MAX_SONGS`` entries, so gathering it is bounded.  The number of
    files follows the bytes (Spark joins small ranges), not the artists.  An index of one
    row per file, its first and last artist, is written to ``<path>_index``.
    """
    per_artist = listing.groupBy("artist").agg(
        F.sort_array(F.collect_list(F.struct("song_no", "title", "url", "id"))).alias("songs"))
    ordered = per_artist.repartitionByRange("artist").sortWithinPartitions("artist")
    ordered.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    written = listing.sparkSession.read.schema(LIST_SCHEMA).json(path)
    name = F.element_at(F.split(F.input_file_name(), "/"), -1)
    index = written.groupBy(name.alias("file")).agg(F.min("artist").alias("first"), F.max("artist").alias("last"))
    index.write.mode("overwrite").parquet(path.rstrip("/") + "_index")


def read_song_lists(spark, path: str, artist: str | None = None) -> DataFrame:
    """``artist, song_no, title, url, id`` from written lists (artist stays a string).

    With ``artist`` only the files whose range holds it are read."""
    lists = spark.read.schema(LIST_SCHEMA)
    if artist is None:
        return lists.json(path).select("artist", F.inline("songs"))
    index = spark.read.schema("file string, first string, last string").parquet(path.rstrip("/") + "_index")
    files = [r["file"] for r in index.where((F.col("first") <= artist) & (F.col("last") >= artist)).collect()]
    if not files:
        return lists.json(path).where(F.lit(False)).select("artist", F.inline("songs"))
    found = lists.json([f"{path.rstrip('/')}/{f}" for f in files]).where(F.col("artist") == artist)
    return found.select("artist", F.inline("songs"))
