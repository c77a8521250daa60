"""Order-carrying operators: dense global ids and per-file running state.

Row order decides ids, caps and titles in the reference, but a DataFrame has
no order, so every input carries explicit keys.  Two building blocks:

* ``dense_index`` -- 0-based consecutive ids in a global key order: the rows are written
  once by Spark's range partitioner, counted per range, and get their range's offset from
  a map of one row per range.  Never a window without ``partitionBy``.
* ``cut_key`` -- the key at a position of the order, by histograms refined around it; a cap
  or an exact split is then one comparison per row, and no row is moved.
* ``chunked_scan`` -- per-group line numbers and "last value seen" (the title
  state machine) for data whose order is (group, chunk, in-chunk position),
  e.g. (file, split start, row) of a text scan or (source, doc, line) of a
  table.  Each chunk is bounded (a file split, a document), so the only
  per-group work is on a one-row-per-chunk summary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from colloquia.session import reliable_checkpoint

# Above this many rows a summary table is left to AQE's runtime join choice.
BROADCAST_ROW_BOUND = 200_000

BYTES_PER_PARTITION = 128 << 20
BUCKETS = 1_024      # buckets of a histogram over numbers
FEW_ROWS = 10_000    # so few candidates are ordered instead of counted further


def _cols(cs: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cs]


def _flat(df: DataFrame, order_by: Sequence[str | Column]) -> list[Column]:
    """The order's columns with structs replaced by their fields."""
    def fields(c: Column, kind: T.DataType) -> list[Column]:
        if not isinstance(kind, T.StructType):
            return [c]
        return [x for f in kind.fields for x in fields(c.getField(f.name), f.dataType)]

    cols = _cols(order_by)
    kinds = [f.dataType for f in df.select(*[c.alias(f"k{i}") for i, c in enumerate(cols)]).schema.fields]
    return [x for c, kind in zip(cols, kinds) for x in fields(c, kind)]


def _key(cols: Sequence[Column]) -> Column:
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(cols)])


def input_bytes(df: DataFrame) -> int:
    """The bytes of the files that ``df`` reads."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size())]
    return sum(x for x in sizes if x < 1 << 60)   # a checkpointed table has no known size


def range_count(df: DataFrame) -> int:
    """Partitions for a range shuffle of ``df``, from the bytes of its inputs (at least
    spark.sql.shuffle.partitions)."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(1, least, input_bytes(df) // BYTES_PER_PARTITION)


def dense_index(df: DataFrame, order_by: Sequence[str | Column], index_col: str = "idx",
                num_partitions: int | None = None) -> DataFrame:
    """Append a 0-based consecutive ``index_col`` following ``order_by`` (ascending).

    ``order_by`` must be unique per row (add tie-breakers).  The rows are shuffled once,
    into sorted ranges, and written with their range and place; the offsets are sums over
    one row per range, joined back as a broadcast map.  What is written is numbered, so a
    task that runs again finds the same ids.
    """
    cols = _cols(order_by)
    dealt = df.repartitionByRange(num_partitions or range_count(df), *cols).sortWithinPartitions(*cols)
    written = reliable_checkpoint(dealt.withColumn("_ix_id", F.monotonically_increasing_id()))
    rows = written.withColumn("_ix_p", F.shiftright("_ix_id", 33))   # the range; its places fill the low bits
    sizes = sorted(rows.groupBy("_ix_p").agg(F.count(F.lit(1)).alias("n")).collect())
    offsets, total = [], 0
    for r in sizes:
        offsets.append((r["_ix_p"], total))
        total += r["n"]
    known = df.sparkSession.createDataFrame(offsets, "_ix_p long, _ix_off long")
    place = F.col("_ix_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (rows.join(F.broadcast(known), "_ix_p").withColumn(index_col, (F.col("_ix_off") + place).cast("long"))
            .select(*[c for c in df.columns if c != index_col], index_col))


def _steps(rows: DataFrame, name: str, chars: int):
    """Buckets of a column in its order, finer and finer; the last one is a single value."""
    kind, c = rows.schema[name].dataType, F.col(name)
    if isinstance(kind, T.StringType):
        length = 0
        while True:
            length += chars
            # a string that ends here is the only one of its bucket
            yield F.substring(c, 1, length), lambda b, n=length: b is None or len(b) < n
    if isinstance(kind, T.BooleanType):
        yield c, lambda b: True
        return
    if isinstance(kind, T.DateType):
        c = F.unix_date(c)
    elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        c = F.unix_micros(c.cast("timestamp"))
    elif not (isinstance(kind, T.IntegralType) or isinstance(kind, T.DecimalType) and kind.scale == 0):
        raise TypeError(f"cannot cut an order by {kind.simpleString()}")
    c = c.cast("decimal(38,0)")
    low, high = rows.agg(F.min(c), F.max(c)).first()
    if low is None:
        yield F.lit(None).cast("long"), lambda b: True
        return
    width = int(high) - int(low) + 1
    low = int(low)
    while width > 1:
        width = -(-width // BUCKETS)
        at = F.call_function("div", c - F.lit(str(low)).cast("decimal(38,0)"), F.lit(str(width)).cast("decimal(38,0)"))
        b = yield at, lambda b, w=width: b is None or w == 1
        low += int(b or 0) * width
    yield c, lambda b: True


def cut_key(df: DataFrame, order_by: Sequence[str | Column], position: int, chars: int = 1):
    """The key at a 0-based position of the order (integers, strings, dates; nulls first), or
    None if there are fewer rows.

    Rows are counted by buckets of the first column, then again inside the bucket that
    holds the position, and so on through the columns until ``FEW_ROWS`` may be it; those
    are ordered.  A pass brings ``BUCKETS`` rows to the driver, or one per distinct string of
    ``chars`` more characters."""
    cols = _flat(df, order_by)
    keys = df.select(*[c.alias(f"k{i}") for i, c in enumerate(cols)]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        rest, n = keys, keys.count()
        if position >= n:
            return None
        for name in keys.columns:
            steps, sent = None, None
            while n > FEW_ROWS:
                if steps is None:
                    steps = _steps(rest, name, chars)
                bucket, single = steps.send(sent)
                found = rest.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()
                # Spark orders strings by their UTF-8 bytes, which is the order of code points
                for r in sorted(found, key=lambda r: (r["b"] is not None, r["b"])):
                    if position < r["n"]:
                        break
                    position -= r["n"]
                rest, n, sent = rest.where(bucket.eqNullSafe(F.lit(r["b"]))), r["n"], r["b"]
                if single(sent):
                    break
        # more rows than a few here have all the same key
        return rest.orderBy(*keys.columns).offset(position if n <= FEW_ROWS else 0).limit(1).first()
    finally:
        keys.unpersist()


def before(df: DataFrame, order_by: Sequence[str | Column], cut, or_at: bool = False) -> Column:
    """Whether a row's key stands before ``cut`` (or at it); every row's if there is none."""
    if cut is None:
        return F.lit(True)
    cols = _flat(df, order_by)
    kinds = df.select(_key(cols).alias("k")).schema["k"].dataType
    at = F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(cut, kinds.fields)])
    return _key(cols) <= at if or_at else _key(cols) < at


def _carried(summary: DataFrame, group: list[str], order: str, fill: bool) -> DataFrame:
    """Rows and last value before each summary row of its group."""
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    sel = [*group, order, F.coalesce(F.sum("_cs_n").over(before), F.lit(0)).alias("_cs_off")]
    if fill:
        sel.append(F.last("_cs_last", ignorenulls=True).over(before).alias("_cs_carry"))
    return summary.select(*sel)


def chunked_scan(df: DataFrame, group_cols: Sequence[str], chunk_col: str, pos_col: str,
                 index_col: str | None = None, fill_col: str | None = None,
                 fill_out: str | None = None, fill_default: Column | None = None,
                 chunk_bound: int | None = None, chunk_block: int | None = None) -> DataFrame:
    """Per-group running index and forward fill over (chunk, pos) order.

    ``index_col`` gets the 0-based position of the row inside its group;
    ``fill_out`` gets the last non-null ``fill_col`` at or before the row
    (``fill_default`` when none).  ``chunk_bound`` is a caller-proven upper
    bound on the number of chunks; the summary is broadcast only under it.

    A group of very many chunks (a source holding a third of all documents) must not
    be carried through in one task: with ``chunk_block``, integer chunks are carried
    inside blocks of that many numbers, and only one row per block along the group.
    """
    g = list(group_cols)
    local = Window.partitionBy(*g, chunk_col).orderBy(pos_col)
    running = local.rowsBetween(Window.unboundedPreceding, 0)
    work = df
    if index_col:
        work = work.withColumn("_cs_rank", F.row_number().over(local) - 1)
    if fill_col:
        work = work.withColumn("_cs_fill", F.last(fill_col, ignorenulls=True).over(running))

    aggs = [F.count(F.lit(1)).alias("_cs_n")]
    if fill_col:
        aggs.append(F.max_by(F.col(fill_col), F.when(F.col(fill_col).isNotNull(),
                                                      F.col(pos_col))).alias("_cs_last"))
    summary = df.groupBy(*g, chunk_col).agg(*aggs)
    if chunk_block is None:
        summary = _carried(summary, g, chunk_col, bool(fill_col))
    else:
        summary = reliable_checkpoint(summary)   # read twice, and each time it would scan the rows
        blocked = summary.withColumn("_cs_b", F.floor(F.col(chunk_col) / F.lit(chunk_block)))
        sums = [F.sum("_cs_n").alias("_cs_n")]
        if fill_col:
            sums.append(F.max_by("_cs_last", F.when(F.col("_cs_last").isNotNull(), F.col(chunk_col))).alias("_cs_last"))
        blocks = _carried(blocked.groupBy(*g, "_cs_b").agg(*sums), g, "_cs_b", bool(fill_col))
        blocks = blocks.withColumnsRenamed({"_cs_off": "_cs_off0", "_cs_carry": "_cs_carry0"})
        inner = _carried(blocked, [*g, "_cs_b"], chunk_col, bool(fill_col)).join(blocks, [*g, "_cs_b"])
        summary = inner.select(*g, chunk_col, (F.col("_cs_off") + F.col("_cs_off0")).alias("_cs_off"), *(
            [F.coalesce("_cs_carry", "_cs_carry0").alias("_cs_carry")] if fill_col else []))
    if chunk_bound is not None and chunk_bound <= BROADCAST_ROW_BOUND:
        summary = F.broadcast(summary)

    out = work.join(summary, [*g, chunk_col])
    if index_col:
        out = out.withColumn(index_col, (F.col("_cs_off") + F.col("_cs_rank")).cast("long"))
    if fill_col:
        default = fill_default if fill_default is not None else F.lit(None)
        out = out.withColumn(fill_out or fill_col,
                             F.coalesce(F.col("_cs_fill"), F.col("_cs_carry"), default))
    return out.drop("_cs_rank", "_cs_fill", "_cs_off", "_cs_carry")
