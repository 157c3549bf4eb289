"""Distributed row order: dense indices, halo chunks, carries and running sums.

Telemetry operators count rows, not time, and one series may hold most of the
data. Nothing here puts a series into one task: work is keyed by
``(series, chunk of rows)`` and only per-chunk summaries cross chunk borders.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vigilseries.session import materialize

ROW_IDX = "row_idx"
SERIES_ID = "series_id"
CHUNK = "_chunk"
CHUNK_ROWS = 4096
LEVELS = 2
BROADCAST_ROWS = 50_000
_NOTE = "vigilseries"


def as_list(cols: str | Sequence[str] | None) -> list[str]:
    if cols is None:
        return []
    return [cols] if isinstance(cols, str) else list(cols)


def series_key(series_cols: Sequence[str] | None) -> list[str]:
    """The never-null number that stands for a series in joins and windows; none for a single series."""
    return [SERIES_ID] if as_list(series_cols) else []


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches null keys and keeps the left copy of each key."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_r_{k}" for k in keys])


def spread_by(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition once; a following join or window on the same keys reuses this shuffle."""
    return df.repartition(*keys)


def index_rows(df: DataFrame, order_cols: str | Sequence[str], series_cols: Sequence[str] | None = None,
               index_col: str = ROW_IDX) -> DataFrame:
    """Add a dense 0-based position per series without gathering any series.

    Rows are range-partitioned on (series, order), sorted, and written once with
    their partition number and place in it; offsets come from one row per
    (series, partition). Equal order values fall back to a row hash and then to
    arrival order, so copies spread over partitions too. With series columns a
    number per series, ``series_id``, is added as well. The index column carries
    a note of its order and series, by which ``ensure_index`` knows it again.
    """
    series, order = as_list(series_cols), as_list(order_cols)
    hashed = [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    keys = [*series, *order, "_tie", "_seen"]
    placed = (
        df.withColumns({"_tie": F.xxhash64(*hashed), "_seen": F.monotonically_increasing_id()})
        .repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .drop("_tie", "_seen")
        .withColumns({
            "_part": F.spark_partition_id(),
            "_pos": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)),
        })
    )
    placed = materialize(placed, "indexed")
    base = _part_offsets(placed)
    if not series:
        return _noted(placed.withColumn(index_col, base + F.col("_pos")).drop("_part", "_pos"), index_col, order, series)
    starts = placed.groupBy(*series, "_part").agg(F.min("_pos").alias("_first")).withColumn("_at", base + F.col("_first"))
    starts = starts.select(*series, "_part", F.min("_at").over(Window.partitionBy(*series)).alias(SERIES_ID))
    joined = null_safe_join(placed, starts, [*series, "_part"]).withColumn(
        index_col, base + F.col("_pos") - F.col(SERIES_ID)).drop("_part", "_pos")
    return _noted(joined, index_col, order, series)


def _noted(df: DataFrame, index_col: str, order: Sequence[str], series: Sequence[str]) -> DataFrame:
    return df.withMetadata(index_col, {_NOTE: {"order": list(order), "series": list(series)}})


def _part_offsets(placed: DataFrame) -> Column:
    """Rows in all earlier partitions; one number per written partition passes through the driver."""
    sizes = dict(placed.groupBy("_part").count().collect())
    before = [0, *accumulate(sizes.get(p, 0) for p in range(max(sizes, default=0)))]
    return F.element_at(F.expr(f"CAST(split('{','.join(map(str, before))}', ',') AS ARRAY<BIGINT>)"), F.col("_part") + 1)


def ensure_index(df: DataFrame, order_cols: str | Sequence[str], series_cols: Sequence[str] | None = None,
                 dense: bool = True) -> DataFrame:
    """Reuse ``row_idx`` if it can be trusted, else compute it.

    It must have been made by ``index_rows`` for the same order and series, and
    with ``dense`` every series must still hold the places 0..n-1 (one small
    aggregate over the index); a frame filtered since is numbered again. A column
    ``row_idx`` of other origin is an error, for it would be overwritten.
    """
    if ROW_IDX not in df.columns:
        return index_rows(df, order_cols, series_cols)
    note = df.schema[ROW_IDX].metadata.get(_NOTE)
    if note is None:
        raise ValueError(f"{ROW_IDX} was not made by index_rows; rename the column")
    fits = note == {"order": as_list(order_cols), "series": as_list(series_cols)} and (SERIES_ID in df.columns) == bool(as_list(series_cols))
    if fits and (not dense or _is_dense(df, series_key(series_cols))):
        return df
    return index_rows(df.drop(ROW_IDX, SERIES_ID), order_cols, series_cols)


def _is_dense(df: DataFrame, keys: Sequence[str]) -> bool:
    each = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.min(ROW_IDX).alias("lo"), F.max(ROW_IDX).alias("hi"))
    return each.where("lo <> 0 OR hi <> n - 1").isEmpty()


def group_of(idx: str, rows: int | None) -> Column:
    return F.expr(f"{idx} div {rows or CHUNK_ROWS}")


def with_halo(df: DataFrame, keys: Sequence[str], before: int, after: int = 0, rows: int | None = None,
              idx: str = ROW_IDX) -> DataFrame:
    """Assign rows to chunks and copy the border rows that neighbours need.

    ``before``/``after`` are the rows a frame reaches back/forward.
    """
    rows = rows or CHUNK_ROWS
    if rows < max(before, after):
        raise ValueError("a chunk must hold at least as many rows as its halo")
    own, off = group_of(idx, rows), F.col(idx) % F.lit(rows)
    borders = []
    if before:
        borders.append((off >= rows - before, own + 1))
    if after:
        borders.append((off < after, own - 1))
    target = own
    if borders:
        target = F.explode(F.array_compact(F.array(own, *[F.when(c, to) for c, to in borders])))
    return spread_by(df.withColumn(CHUNK, target), *keys, CHUNK)


def drop_halo(df: DataFrame, rows: int | None = None, idx: str = ROW_IDX) -> DataFrame:
    return df.where(F.col(CHUNK) == group_of(idx, rows)).drop(CHUNK)


def chunk_window(keys: Sequence[str] = (), idx: str = ROW_IDX):
    return Window.partitionBy(*keys, CHUNK).orderBy(idx)


def chunk_over(keys: Sequence[str] = (), idx: str = ROW_IDX) -> str:
    """``chunk_window`` as SQL text."""
    return f"PARTITION BY {', '.join(f'`{k}`' for k in [*keys, CHUNK])} ORDER BY `{idx}`"


def _group_over(keys: Sequence[str], group: str | None, idx: str, inclusive: bool, descending: bool = False) -> str:
    part = ", ".join(f"`{k}`" for k in [*keys, *([group] if group else [])]) or "0"
    end = "CURRENT ROW" if inclusive else "1 PRECEDING"
    return f"OVER (PARTITION BY {part} ORDER BY `{idx}`{' DESC' if descending else ''} ROWS BETWEEN UNBOUNDED PRECEDING AND {end})"


def carry(df: DataFrame, prev: dict[str, str] | None = None, following: dict[str, str] | None = None,
          idx: str = ROW_IDX, keys: Sequence[str] = (), rows: int | None = None, levels: int = LEVELS,
          inclusive: bool = True) -> DataFrame:
    """Add, per row, the nearest non-null value at or before / at or after it.

    ``prev`` and ``following`` map new names to SQL text. Each level summarises
    ``rows`` positions into one, so no window sorts more than ``rows`` rows
    except over the (tiny) top level.
    """
    prev, following = prev or {}, following or {}
    names = [*prev, *following]
    group = f"_g{levels}" if levels else None
    asc, desc = (_group_over(keys, group, idx, inclusive, d) for d in (False, True))
    near = {n: f"last_value({e}) IGNORE NULLS {over}" for part, over in ((prev, asc), (following, desc)) for n, e in part.items()}
    if levels == 0:
        return df.selectExpr("*", *[f"{e} AS `{n}`" for n, e in near.items()])
    grouped = df.withColumn(group, group_of(idx, rows))
    outer = {n: f"{n}_o{levels}" for n in names}
    summary = grouped.groupBy(*keys, group).agg(*[
        F.expr(f"{pick}({e}, CASE WHEN ({e}) IS NOT NULL THEN `{idx}` END) AS `{n}_e{levels}`")
        for part, pick in ((prev, "max_by"), (following, "min_by")) for n, e in part.items()])
    edges = carry(
        summary, {outer[n]: f"`{n}_e{levels}`" for n in prev}, {outer[n]: f"`{n}_e{levels}`" for n in following},
        group, keys, rows, levels - 1, inclusive=False,
    ).select(*keys, group, *outer.values())
    joined = spread_by(grouped, *keys, group).join(edges, [*keys, group])
    return joined.selectExpr("*", *[f"coalesce({near[n]}, `{outer[n]}`) AS `{n}`" for n in names]).drop(group, *outer.values())


def running_sum(df: DataFrame, sums: dict[str, str], idx: str = ROW_IDX, keys: Sequence[str] = (),
                rows: int | None = None, levels: int = LEVELS, inclusive: bool = True) -> DataFrame:
    """Add per-series running totals (name -> SQL text) by summing chunks first."""
    group = f"_g{levels}" if levels else None
    over = _group_over(keys, group, idx, inclusive)
    here = {n: f"coalesce(sum({e}) {over}, 0)" for n, e in sums.items()}
    if levels == 0:
        return df.selectExpr("*", *[f"{e} AS `{n}`" for n, e in here.items()])
    grouped = df.withColumn(group, group_of(idx, rows))
    summary = grouped.groupBy(*keys, group).agg(*[F.expr(f"sum({e}) AS `{n}_e{levels}`") for n, e in sums.items()])
    edges = running_sum(summary, {f"{n}_o{levels}": f"`{n}_e{levels}`" for n in sums}, group, keys, rows, levels - 1, False)
    edges = edges.select(*keys, group, *[f"{n}_o{levels}" for n in sums])
    joined = spread_by(grouped, *keys, group).join(edges, [*keys, group])
    return joined.selectExpr("*", *[f"{e} + `{n}_o{levels}` AS `{n}`" for n, e in here.items()]).drop(group, *[f"{n}_o{levels}" for n in sums])


def attach(df: DataFrame, facts: DataFrame, keys: Sequence[str] = (), rows: int | None = None, idx: str = ROW_IDX) -> DataFrame:
    """Add facts kept per series to every row.

    Without keys the single row of facts becomes literals. Few facts are
    broadcast after counting them. Many meet the list of chunks first and the
    rows on (series, chunk), so a series holding most rows stays spread out.
    """
    if not keys:
        row = facts.first()
        return df.withColumns({f.name: F.lit(row[f.name]).cast(f.dataType) for f in facts.schema.fields})
    facts = materialize(facts, "facts")
    if facts.count() <= BROADCAST_ROWS:
        return df.join(F.broadcast(facts), list(keys))
    chunked = df.withColumn("_at", group_of(idx, rows))
    pieces = chunked.select(*keys, "_at").distinct().join(facts, list(keys))
    return chunked.join(pieces, [*keys, "_at"]).drop("_at")


def series_length(df: DataFrame, keys: Sequence[str] = (), name: str = "_n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
