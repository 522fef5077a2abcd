"""Keyed time-series windows that do not put a whole key into one task.

The natural spec ``Window.partitionBy(key).orderBy(time)`` sends every row
of a key to one task; with five regions (or any key holding a third of the
rows) that caps parallelism and memory. The operators here split each key
into blocks and add a bounded overlap, so the window stage is partitioned
by ``(key, block)``:

* ``row_window``   - row-offset frames (lag, lead, ``rowsBetween``). A global
  row index per key is built from per-(key, chunk) counts (a small table),
  rows are cut into blocks of ``block_rows`` and the last ``lookback`` /
  first ``lookahead`` rows of each block are copied into the neighbour.
* ``range_window`` - time-range frames (``rangeBetween`` over epoch
  seconds); blocks are fixed time spans and the overlap is a time span.
* ``forward_fill`` - unbounded "last non-null": fill inside (key, chunk),
  then carry the last value of earlier chunks through a small
  (key, chunk) summary.

All three are exact: the result equals the single-partition window.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from wattlake.functions.timecols import epoch_seconds

DEFAULT_BLOCK_ROWS = 100_000
# rows per (key, chunk) at one row per grain, and the grain assumed without a better one
CHUNK_ROWS = 2048
DEFAULT_GRAIN_SECONDS = 3600
DEFAULT_BLOCK_SECONDS = 90 * 24 * 3600

Build = Callable[[WindowSpec], dict[str, Column]]


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def time_chunk(order: str, grain_seconds: int = DEFAULT_GRAIN_SECONDS) -> Column:
    """Bucket of ``CHUNK_ROWS`` grains of the order column.

    With one row per key and grain, a (key, chunk) group holds at most
    ``CHUNK_ROWS`` rows whatever the grain is, and the summary of a key has
    one row for up to ``CHUNK_ROWS`` rows of data, so the per-key step over it
    stays small. Coarser data than the given grain only makes chunks smaller;
    give the grain of finer data.
    """
    return F.floor(epoch_seconds(order) / F.lit(CHUNK_ROWS * grain_seconds))


def row_index(
    df: DataFrame, key: str | Sequence[str], order: str, chunk: Column | None = None, name: str = "_idx",
    grain_seconds: int = DEFAULT_GRAIN_SECONDS,
) -> DataFrame:
    """Add a 0-based row position per key in ``order`` without a per-key task.

    Counts per (key, chunk) are a small table; their running sum gives each
    chunk's offset, and ``row_number`` runs inside (key, chunk).
    """
    keys = _keys(key)
    d = df.withColumn("_chunk", chunk if chunk is not None else time_chunk(order, grain_seconds))
    counts = d.groupBy(*keys, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_chunk", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # offsets has one row per (key, chunk); AQE turns this into a broadcast
    # join when the measured side is small and keeps a shuffle join otherwise.
    d = d.join(offsets, [*keys, "_chunk"], "inner")
    local = Window.partitionBy(*keys, "_chunk").orderBy(order)
    return d.withColumn(name, F.col("_off") + F.row_number().over(local) - 1).drop("_off", "_chunk")


def row_window(
    df: DataFrame,
    key: str | Sequence[str],
    order: str,
    build: Build,
    lookback: int = 0,
    lookahead: int = 0,
    block_rows: int = DEFAULT_BLOCK_ROWS,
    chunk: Column | None = None,
    grain_seconds: int = DEFAULT_GRAIN_SECONDS,
) -> DataFrame:
    """Evaluate row-offset window expressions per key, partitioned by (key, block).

    ``build(w)`` returns ``{name: expr over w}`` where ``w`` orders the rows of
    one key; any frame must stay within ``lookback`` rows before and
    ``lookahead`` rows after the current row.
    """
    if lookback > block_rows or lookahead > block_rows:
        raise ValueError("lookback/lookahead must not exceed block_rows")
    keys = _keys(key)
    cols = df.columns
    d = row_index(df, keys, order, chunk, grain_seconds=grain_seconds)
    blk = F.floor(F.col("_idx") / F.lit(block_rows))
    pos = F.col("_idx") - blk * F.lit(block_rows)
    copies = [blk]
    if lookback > 0:
        copies.append(F.when(pos >= F.lit(block_rows - lookback), blk + 1))
    if lookahead > 0:
        copies.append(F.when(pos < F.lit(lookahead), blk - 1))
    d = d.withColumn("_home_blk", blk)
    if len(copies) > 1:
        d = d.withColumn("_blk", F.explode(F.filter(F.array(*copies), lambda x: x.isNotNull())))
    else:
        d = d.withColumn("_blk", blk)
    w = Window.partitionBy(*keys, "_blk").orderBy("_idx")
    exprs = build(w)
    out = d.select(*cols, *[e.alias(n) for n, e in exprs.items()], (F.col("_blk") == F.col("_home_blk")).alias("_home"))
    return out.where("_home").drop("_home")


def range_window(
    df: DataFrame,
    key: str | Sequence[str],
    order: str,
    build: Build,
    lookback_seconds: int = 0,
    lookahead_seconds: int = 0,
    block_seconds: int = DEFAULT_BLOCK_SECONDS,
) -> DataFrame:
    """Evaluate ``rangeBetween`` expressions over epoch seconds of ``order``.

    ``build(w)`` gets a spec ordered by the epoch-seconds column ``_ts``; its
    frames must stay within the given look-back / look-ahead seconds.
    """
    if lookback_seconds > block_seconds or lookahead_seconds > block_seconds:
        raise ValueError("lookback/lookahead must not exceed block_seconds")
    keys = _keys(key)
    cols = df.columns
    d = df.withColumn("_ts", epoch_seconds(order))
    blk = F.floor(F.col("_ts") / F.lit(block_seconds))
    pos = F.col("_ts") - blk * F.lit(block_seconds)
    copies = [blk]
    if lookback_seconds > 0:
        copies.append(F.when(pos >= F.lit(block_seconds - lookback_seconds), blk + 1))
    if lookahead_seconds > 0:
        copies.append(F.when(pos < F.lit(lookahead_seconds), blk - 1))
    d = d.withColumn("_home_blk", blk)
    if len(copies) > 1:
        d = d.withColumn("_blk", F.explode(F.filter(F.array(*copies), lambda x: x.isNotNull())))
    else:
        d = d.withColumn("_blk", blk)
    w = Window.partitionBy(*keys, "_blk").orderBy("_ts")
    exprs = build(w)
    out = d.select(*cols, *[e.alias(n) for n, e in exprs.items()], (F.col("_blk") == F.col("_home_blk")).alias("_home"))
    return out.where("_home").drop("_home")


def forward_fill(
    df: DataFrame,
    cols: Sequence[str],
    key: str | Sequence[str],
    order: str,
    chunk: Column | None = None,
    grain_seconds: int = DEFAULT_GRAIN_SECONDS,
) -> DataFrame:
    """Replace nulls in ``cols`` with the last non-null value of the key.

    Phase 1 fills inside (key, chunk). Phase 2 takes the last value of every
    chunk (one row per chunk), carries it forward over earlier chunks, and
    fills what phase 1 left null at the start of a chunk.
    """
    keys = _keys(key)
    out_cols = df.columns
    d = df.withColumn("_chunk", chunk if chunk is not None else time_chunk(order, grain_seconds))
    upto = Window.partitionBy(*keys, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    d = d.select(
        *[c for c in d.columns if c not in cols],
        *[F.last(c, ignorenulls=True).over(upto).alias(c) for c in cols],
    )
    last_in_chunk = d.groupBy(*keys, "_chunk").agg(
        *[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order))).alias(f"_last_{c}") for c in cols]
    )
    earlier = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    carry = last_in_chunk.select(
        *keys, "_chunk", *[F.last(f"_last_{c}", ignorenulls=True).over(earlier).alias(f"_carry_{c}") for c in cols]
    )
    filled = d.join(carry, [*keys, "_chunk"], "left")
    return filled.select(
        *[F.coalesce(F.col(c), F.col(f"_carry_{c}")).alias(c) if c in cols else F.col(c) for c in out_cols]
    )
