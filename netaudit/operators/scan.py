"""Running values over ordered rows, without one task holding a whole sequence.

A sequence (a file, a month of log lines) is cut into chunks whose size is bounded, for text
files the input splits. Windows run inside chunks only. What a chunk needs from its
neighbours is one summary row per chunk, and the same is done again over those rows, one
level up. So a file may hold any share of the data and still spread over all tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

Columns = Mapping[str, Column]


def ordered_scan(
    df: DataFrame,
    within: Sequence[str],
    levels: Sequence[str],
    order: str,
    *,
    carry: Columns | None = None,
    carry_before: Columns | None = None,
    total: Columns | None = None,
    total_before: Columns | None = None,
    ahead: Columns | None = None,
    since: Mapping[str, tuple[Column, Column]] | None = None,
) -> DataFrame:
    """Add running columns to rows ordered by ``(*levels, order)`` within ``within``.

    ``carry``         last non-null value up to and including the row
    ``carry_before``  last non-null value before the row
    ``total``         sum up to and including the row
    ``total_before``  sum before the row
    ``ahead``         value in the next row, null after the last
    ``since``         ``(value, reset)``: sum of the values before the row and after the last
                      row before it where ``reset`` holds (give zero as that row's value)

    ``within`` and ``levels`` must not hold nulls. The input is read twice, once for the rows
    and once for the chunk summaries, so write it out first where it is costly to make.
    """
    carry, carry_before = dict(carry or {}), dict(carry_before or {})
    total, total_before, ahead = dict(total or {}), dict(total_before or {}), dict(ahead or {})
    since = dict(since or {})
    part = [*within, *levels]
    rows = Window.partitionBy(*part).orderBy(order)
    through = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = rows.rowsBetween(Window.unboundedPreceding, -1)

    counted = _counted_since(df, part, order, rows, through, since)
    scanned = counted.withColumns(
        {name: F.last(value, ignorenulls=True).over(through) for name, value in carry.items()}
        | {name: F.last(value, ignorenulls=True).over(before) for name, value in carry_before.items()}
        | {name: F.sum(value).over(through) for name, value in total.items()}
        | {name: F.coalesce(F.sum(value).over(before), F.lit(0)) for name, value in total_before.items()}
        # The struct tells "the next row holds null" from "there is no next row here".
        | {name: F.lead(F.struct(value.alias("value"))).over(rows) for name, value in ahead.items()}
        | {name: F.coalesce(F.lag(f"{name}__sum").over(rows), F.lit(0)) for name in since}
        | {f"{name}__cut": F.coalesce(F.lag(f"{name}__resets").over(rows), F.lit(0)) > 0 for name in since}
    )
    cuts = [f"{name}__{kind}" for name in since for kind in ("sum", "resets", "cut")]
    if not levels:
        return scanned.withColumns({name: F.col(name)["value"] for name in ahead}).drop(*cuts)

    carried, summed = carry | carry_before, total | total_before
    summary = counted.groupBy(*part).agg(
        *[F.max_by(value, F.when(value.isNotNull(), F.col(order))).alias(f"{name}__in") for name, value in carried.items()],
        *[F.sum(value).alias(f"{name}__in") for name, value in summed.items()],
        *[F.min_by(F.struct(value.alias("value")), F.col(order)).alias(f"{name}__in") for name, value in ahead.items()],
        *[F.max_by(f"{name}__sum", order).alias(f"{name}__in") for name in since],
        *[(F.max(f"{name}__resets") > 0).alias(f"{name}__reset") for name in since],
    )
    outer = ordered_scan(
        summary,
        within,
        levels[:-1],
        levels[-1],
        carry_before={f"{name}__out": F.col(f"{name}__in") for name in carried},
        total_before={f"{name}__out": F.col(f"{name}__in") for name in summed},
        ahead={f"{name}__out": F.col(f"{name}__in") for name in ahead},
        since={f"{name}__out": (F.col(f"{name}__in"), F.col(f"{name}__reset")) for name in since},
    )
    outs = [f"{name}__out" for name in [*carried, *summed, *ahead, *since]]
    # The rows stand in their chunks already. By the size of a compressed table Spark may take them for few and broadcast them.
    joined = scanned.join(outer.select(*part, *outs).hint("merge"), part)
    return joined.withColumns(
        {name: F.coalesce(F.col(name), F.col(f"{name}__out")) for name in carried}
        | {name: F.col(name) + F.col(f"{name}__out") for name in summed}
        | {name: F.coalesce(F.col(name), F.col(f"{name}__out"))["value"] for name in ahead}
        | {
            name: F.when(F.col(f"{name}__cut"), F.col(name)).otherwise(F.col(name) + F.col(f"{name}__out"))
            for name in since
        }
    ).drop(*outs, *cuts)


def _counted_since(df, part, order, rows, through, since) -> DataFrame:
    """Sums since the last reset, through the row itself.

    A row's reset starts a new stretch. In a chunk summary the reset chunk's own sum already
    belongs to the new stretch; a single row's value does not, so the caller passes it as zero.
    """
    if not since:
        return df
    marked = df.withColumns(
        {f"{name}__resets": F.sum(reset.cast("int")).over(through) for name, (_, reset) in since.items()}
    )
    for name, (value, _) in since.items():
        stretch = Window.partitionBy(*part, f"{name}__resets").orderBy(order)
        marked = marked.withColumn(
            f"{name}__sum", F.sum(value).over(stretch.rowsBetween(Window.unboundedPreceding, Window.currentRow))
        )
    return marked


def lines_since(mark: Column) -> tuple[Column, Column]:
    """``since`` argument that counts the rows after the last mark."""
    return F.when(mark, 0).otherwise(1), mark
