"""Seed text files: one file per artist, ``#`` lines mark song titles.

Reading is line-mode (so one huge file is still split across tasks); the
reading order is (file, split start, row within split), carried as
``file, chunk, pos``.  Per-file line numbers and titles are then computed by
``chunked_scan`` over one-row-per-split summaries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from colloquia.functions.text import LB
from colloquia.operators.order import chunked_scan
from colloquia.session import local_path, ship_package

# File stems (case-insensitive) that are never seed text.
SKIP_STEMS = ("readme", "_readme", "example")


def read_seed_lines(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """``file, artist, chunk, pos, line`` for every line of the seed files."""
    raw = (spark.read.option("pathGlobFilter", glob).text(path)
           .select(F.col("_metadata.file_name").alias("file"),
                   F.col("_metadata.file_block_start").alias("chunk"),
                   "value"))
    stem = F.regexp_replace("file", "\\.[^.]*$", "")
    pieces = (raw.where(~F.lower(stem).isin(*SKIP_STEMS))
              .select("file", F.translate(stem, "_", " ").alias("artist"), "chunk",
                      F.explode(F.split("value", LB, -1)).alias("line")))
    # ids are consecutive per partition in reading order; a split is never
    # spread over two partitions, so (file, chunk, pos) is the file order
    return pieces.withColumn("pos", F.monotonically_increasing_id())


def seed_chunk_bound(spark: SparkSession, path: str, glob: str = "*.txt") -> int:
    """Upper bound on (file, split) chunks: files plus partition boundaries."""
    df = spark.read.option("pathGlobFilter", glob).text(path)
    return len(df.inputFiles()) + df.rdd.getNumPartitions()


def seed_text_scan(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """``file, artist, line_no, line``: raw lines with 0-based per-file numbers."""
    lines = read_seed_lines(spark, path, glob)
    numbered = chunked_scan(lines, ["file"], "chunk", "pos", index_col="line_no",
                            chunk_bound=seed_chunk_bound(spark, path, glob))
    return numbered.select("file", "artist", "line_no", "line")


def write_named_text_files(df: DataFrame, out_dir: str, name_col: str, line_col: str,
                           order_by: Sequence[str]) -> DataFrame:
    """Write ``{out_dir}/{name}.txt`` per distinct name, lines in ``order_by``.

    Hash-partitioned by name and sorted, so each file is streamed by one task
    from a sorted iterator (nothing is held in memory).  Each attempt writes a
    private temp file and renames it, so retries and speculation are safe.
    Returns ``name, lines`` per written file (lazily: run an action on it).
    """
    import pyarrow.fs as pafs

    ship_package(df.sparkSession)
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = (df.select(F.col(name_col).alias("name"), F.col(line_col).alias("line"),
                         *order_by)
               .repartition(n, "name")
               .sortWithinPartitions("name", *order_by)
               .select("name", "line"))

    def write(batches):
        import pandas as pd
        from pyspark import TaskContext

        if out_dir.startswith("file:") or "://" not in out_dir:
            fs, base = pafs.LocalFileSystem(), local_path(out_dir)
        else:
            fs, base = pafs.FileSystem.from_uri(out_dir)
        fs.create_dir(base, recursive=True)
        attempt = TaskContext.get().attemptNumber() if TaskContext.get() else 0
        current, stream, tmp, count = None, None, None, 0
        done = []

        def close():
            if stream is not None:
                stream.close()
                fs.move(tmp, f"{base}/{current}.txt")
                done.append((current, count))

        for pdf in batches:
            for name, grp in pdf.groupby("name", sort=False):
                if name != current:
                    close()
                    current, count = name, 0
                    tmp = f"{base}/.{name}.txt.attempt{attempt}"
                    stream = fs.open_output_stream(tmp)
                text = "".join(grp["line"].astype(str) + "\n")
                stream.write(text.encode("utf-8"))
                count += len(grp)
        close()
        yield pd.DataFrame(done, columns=["name", "lines"])

    return ordered.mapInPandas(write, "name string, lines long")
