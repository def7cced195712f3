"""Rolling mean, deviation and extremes in constant work per row.

Spark aggregates a sliding frame anew for each row, so a 1,440-row frame costs
1,440 updates per row.  Here the rows are cut into blocks as long as the frame:
each frame is then the tail of one block plus the head of the next, and both come
from running aggregates.  Head and tail are merged with the pairwise formula for
counts, means and squared deviations, which does not cancel digits the way
differences of running sums do; extremes are the greater or smaller of the two.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.series import rolling_avg, rolling_std, safe_divide

# Frames from this many rows on are computed block-wise; at 60 rows, the shortest frame
# of the feature set, that measured faster than sliding.
BLOCK_FROM = 32
# Extremes of so many short frames, side by side, make those of a longer one without a sort.
MOST_TILES = 8


#: Running extremes, and how those of two parts are merged; both skip NULLs.
EXTREMES = {"max": (F.max, F.greatest), "min": (F.min, F.least)}


@dataclass(frozen=True)
class Rolling:
    """``stat`` ('std', 'avg', 'max' or 'min') of ``column`` over the last ``rows`` rows."""

    name: str
    stat: str
    column: str
    rows: int


def _triple(label: str) -> tuple[str, str, str]:
    """Column names for count, mean and sum of squared deviations of one part."""
    return f"_{label}_n", f"_{label}_m", f"_{label}_q"


def _top(label: str, rows: int, column: str, stat: str) -> str:
    """Column name for the extreme of one part."""
    return f"_{label}{rows}_{column}_{stat}"


def _running(column: str, label: str, w) -> tuple[dict[str, Column], dict[str, Column]]:
    """Running aggregates over ``w``, and the triple made of them.

    The mean of a part whose values are all equal is that value, not sum / count:
    a flat frame then has a deviation of exactly zero.
    """
    n, m, q = _triple(label)
    raw = {
        n: F.count(column).over(w),
        f"{n}_sum": F.sum(column).over(w),
        f"{n}_var": F.var_pop(column).over(w),
        f"{n}_any": F.first(column, ignorenulls=True).over(w),
    }
    mean = F.when(F.col(f"{n}_var") == 0, F.col(f"{n}_any")).otherwise(
        safe_divide(f"{n}_sum", n)
    )
    return raw, {
        m: F.coalesce(mean, F.lit(0.0)),
        q: F.coalesce(F.col(f"{n}_var") * F.col(n), F.lit(0.0)),
    }


def _merged(stat: str, tail: str, head: str) -> Column:
    n1, m1, q1 = map(F.col, _triple(tail))
    n2, m2, q2 = map(F.col, _triple(head))
    n = n1 + n2
    if stat == "avg":
        return safe_divide(n1 * m1 + n2 * m2, n)
    gap = m2 - m1
    squares = q1 + q2 + safe_divide(gap * gap * n1 * n2, n)
    return F.when(n > 1, F.sqrt(squares / (n - 1)))


def with_rolling(
    df: DataFrame,
    specs: list[Rolling],
    keys: list[str],
    ts: str = "ts",
    block_from: int = BLOCK_FROM,
) -> DataFrame:
    """Add one column per spec, each over ``keys`` ordered by ``ts``.

    Frames shorter than ``block_from`` rows stay plain sliding windows: there the
    two extra sorts cost more than the repeated updates.  Frames that divide each
    other share those sorts.  Extremes that a few short frames cover are made of these.
    """
    keys = list(keys)
    base = df.columns
    plain = {"std": rolling_std, "avg": rolling_avg}
    w = Window.partitionBy(*keys).orderBy(ts)
    tops = [s for s in specs if s.stat in EXTREMES]
    tile = {(s.column, s.stat): s.rows for s in sorted(tops, key=lambda s: -s.rows)}
    covered = {k: MOST_TILES * rows if rows < block_from else 0 for k, rows in tile.items()}
    short = [s for s in tops if s.rows < block_from or s.rows <= covered[s.column, s.stat]]
    slid = [s for s in specs if s.rows < block_from and s not in tops]
    out = _tiled(df, short, w).withColumns({s.name: plain[s.stat](s.column, s.rows, w) for s in slid})
    blocked = [s for s in specs if s not in short and s not in slid]
    sizes = sorted({s.rows for s in blocked}, reverse=True)
    if sizes:
        out = out.withColumn("_pos", F.row_number().over(w) - 1)
    for chain in _chains(sizes):
        out = _blocked(out, [s for s in blocked if s.rows in chain], chain, keys, ts)
    return out.select(*base, *[s.name for s in specs])


def _tiled(df: DataFrame, specs: list[Rolling], w: WindowSpec) -> DataFrame:
    """Extremes of the shortest frame slide; a longer frame is a few of those, side by side."""
    slid, made, tiles = {}, {}, {}
    for s in sorted(specs, key=lambda s: s.rows):
        first = tiles.setdefault((s.column, s.stat), s)
        if s is first or s.rows > MOST_TILES * first.rows:
            slid[s.name] = EXTREMES[s.stat][0](s.column).over(w.rowsBetween(1 - s.rows, 0))
        else:
            steps = [*range(0, s.rows - first.rows, first.rows), s.rows - first.rows]
            parts = [F.lag(first.name, k).over(w) if k else F.col(first.name) for k in steps]
            made[s.name] = EXTREMES[s.stat][1](*parts) if len(parts) > 1 else parts[0]
    return df.withColumns(slid).withColumns(made)


def _chains(sizes: list[int]) -> list[list[int]]:
    """Sizes, longest first, grouped so that each divides the one before: they share sorts."""
    chains: list[list[int]] = []
    for size in sizes:
        fitting = [chain for chain in chains if chain[-1] % size == 0]
        if fitting:
            fitting[0].append(size)
        else:
            chains.append([size])
    return chains


def _blocked(
    df: DataFrame, specs: list[Rolling], chain: list[int], keys: list[str], ts: str
) -> DataFrame:
    pairs = sorted({(s.rows, s.column) for s in specs if s.stat not in EXTREMES}, reverse=True)
    tops = sorted({(s.rows, s.column, s.stat) for s in specs if s.stat in EXTREMES}, reverse=True)
    # a block is named by its first position; the negative name sorts from the end
    start = {n: F.col("_pos") - F.col("_pos") % n for n in chain}
    blocks, backs = ([f"_{way}{n}" for n in chain] for way in ("block", "back"))
    out = df.withColumns(
        {b: start[n] for b, n in zip(blocks, chain)} | {b: -start[n] for b, n in zip(backs, chain)}
    )

    def parts(df: DataFrame, label: str, names: list[str], order: Column, upto: int) -> DataFrame:
        def frame(rows: int):
            depth = chain.index(rows) + 1
            return (
                Window.partitionBy(*keys, *names[:depth])
                .orderBy(*names[depth:], order)
                .rowsBetween(Window.unboundedPreceding, upto)
            )

        raw, derived = {}, {}
        for rows, column in pairs:
            r, d = _running(column, f"{label}{rows}_{column}", frame(rows))
            raw |= r
            derived |= d
        for rows, column, stat in tops:
            raw[_top(label, rows, column, stat)] = EXTREMES[stat][0](column).over(frame(rows))
        return df.withColumns(raw).withColumns(derived)

    # rows after the current one in its block, read by the row one frame later
    out = parts(out, "tail", backs, F.col(ts).desc(), -1)
    out = parts(out, "head", blocks, F.col(ts).asc(), Window.currentRow)
    # block names grow with time: the same order as ts, and no further sort
    w = Window.partitionBy(*keys).orderBy(*blocks, ts)
    out = out.withColumns(
        {
            t: F.lag(t, rows, 0).over(w)
            for rows, column in pairs
            for t in _triple(f"tail{rows}_{column}")
        }
        | {t: F.lag(t, top[0]).over(w) for top in tops for t in [_top("tail", *top)]}
    )

    def both(s: Rolling) -> Column:
        if s.stat in EXTREMES:
            ends = [F.col(_top(label, s.rows, s.column, s.stat)) for label in ("tail", "head")]
            return EXTREMES[s.stat][1](*ends)
        return _merged(s.stat, f"tail{s.rows}_{s.column}", f"head{s.rows}_{s.column}")

    merged = {s.name: both(s) for s in specs}
    return out.select(*df.columns, *[c.alias(name) for name, c in merged.items()])
