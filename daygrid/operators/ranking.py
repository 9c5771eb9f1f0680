"""Row numbers within groups of any size.

A window sorts each of its groups in one task. Groups here are divided into pieces by
the leading sort keys: rows are numbered within their piece, and each piece begins after
the rows of the pieces before it, whose counts are combined before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Positions in a piece of a group that has dense positions.
BLOCK_ROWS = 65_536
# Rows drawn to divide a hot piece, for each share of it.
SAMPLE_ROWS = 50


def ascending(columns: Sequence[str]) -> list[Column]:
    """Sort keys with nulls last."""
    return [F.col(c).asc_nulls_last() for c in columns]


def block_of(position: str) -> Column:
    """The piece that a position belongs to."""
    return F.floor(F.col(position) / BLOCK_ROWS)


def sort_key(order: Sequence[str]) -> Column:
    """A struct that compares as rows sort by ``order``, nulls last."""
    return F.struct(
        *[part for c in order for part in (F.col(c).isNull().alias(f"no_{c}"), F.col(c).alias(c))]
    )


def hot_pieces(frame: DataFrame, piece: Sequence[str], parts: int) -> DataFrame:
    """Pieces that hold more than their share, one of ``parts``, of all rows, with ``shares``, how
    many they hold; fewer than ``parts`` pieces."""
    counts = frame.groupBy(*piece).agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n")).scalar()
    shares = F.ceil(F.col("n") * parts / total).cast("int").alias("shares")
    return counts.where(F.col("n") * parts > total).select(*piece, shares)


def cut_points(
    frame: DataFrame, hot: DataFrame, piece: Sequence[str], order: Sequence[str], parts: int
) -> DataFrame:
    """Where to divide the ``hot`` pieces: one row each with ``cuts``, sort keys of ``order`` drawn
    from a sample of some SAMPLE_ROWS rows a share, so that about a share lies between two of
    them. A sample decides about balance only; whatever it holds, rows keep their numbers.
    """
    total = frame.agg(F.count("*")).scalar()
    drawn = frame.where(F.rand(7) * total < SAMPLE_ROWS * parts)
    keys = drawn.select(*piece, sort_key(order).alias("key"))
    sampled = (
        null_safe_join(keys, hot, piece)
        .groupBy(*piece, "shares")
        .agg(F.array_sort(F.collect_list("key")).alias("keys"))
    )
    shares = F.least(F.col("shares"), F.size("keys"))
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("shares")),
        lambda i: F.element_at("keys", ((i * F.size("keys")) / (F.col("shares") + 1)).cast("int") + 1),
    )
    return sampled.withColumn("shares", shares).select(*piece, cuts.alias("cuts"))


def with_share(frame: DataFrame, cuts: DataFrame, piece: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Adds ``share``, the number of a row's piece's cuts that are not after the row."""
    cut = null_safe_join(frame, cuts, piece, "left").withColumn("key", sort_key(order))
    above = F.filter(F.col("cuts"), lambda c: c <= F.col("key"))
    return cut.withColumn("share", F.coalesce(F.size(above), F.lit(0))).drop("cuts", "key")


def running_state(
    frame: DataFrame,
    order: Sequence[str],
    pieces: Sequence[str],
    sums: Mapping[str, tuple[Sequence[str], str]],
    tops: Mapping[str, tuple[str, str]] | None = None,
) -> DataFrame:
    """Adds running sums and what they were at the last row of a kind, in one pass.

    ``sums`` maps a name to (keys, number): the sum of the numbers up to a row, over the rows
    with its keys in ``order``, nulls last. ``tops`` maps a name to (sum, condition): the sum at the
    last row so far that meets the condition, null before the first one. Numbers are not negative,
    so this is the greatest sum at such a row. Numbers, conditions and pieces are SQL.

    ``pieces`` never decrease in this order, nulls last. Null keys are a group like others.
    """
    tops = tops or {}
    keys = list(dict.fromkeys(key for group, _ in sums.values() for key in group))
    parts = [f"part_{i}" for i in range(len(pieces))]
    piece = ", ".join([*keys, *[f"{p} AS {name}" for p, name in zip(pieces, parts)]])
    rising = ", ".join(f"{c} NULLS LAST" for c in order)
    through = (
        f"OVER (PARTITION BY _piece ORDER BY {rising} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    )
    local = frame.selectExpr("*", f"struct({piece}) AS _piece")
    local = local.selectExpr("*", *[f"sum({number}) {through} AS _{n}" for n, (_, number) in sums.items()])
    if tops:
        local = local.selectExpr(
            "*", *[f"max(if({kind}, _{total}, null)) {through} AS _{n}" for n, (total, kind) in tops.items()]
        )
    names = [*sums, *tops]
    starts = local.groupBy("_piece").agg(*[F.expr(f"max(_{n}) AS _{n}") for n in names])

    def earlier(group: Sequence[str]) -> str:
        by = ", ".join(f"_piece.{key}" for key in group)
        on = ", ".join(f"_piece.{name} NULLS LAST" for name in parts)
        return f"OVER (PARTITION BY {by} ORDER BY {on} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"

    # Fewer keys first: what is dealt by them needs no further exchange for more.
    for group in sorted({tuple(group) for group, _ in sums.values()}, key=len):
        own = [n for n, (keys_of, _) in sums.items() if tuple(keys_of) == group]
        starts = starts.selectExpr(
            "*", *[f"coalesce(sum(_{n}) {earlier(group)}, 0) AS _before_{n}" for n in own]
        )
    if tops:
        starts = starts.selectExpr(
            "*",
            *[
                f"max(_before_{total} + _{n}) {earlier(sums[total][0])} AS _before_{n}"
                for n, (total, _) in tops.items()
            ],
        )
    joined = local.join(starts.select("_piece", *[f"_before_{n}" for n in names]), "_piece")
    return joined.selectExpr(
        *[f"`{c}`" for c in frame.columns],
        *[f"_before_{n} + _{n} AS {n}" for n in sums],
        *[f"greatest(_before_{n}, _before_{total} + _{n}) AS {n}" for n, (total, _) in tops.items()],
    )


def row_numbers(
    frame: DataFrame,
    numbers: Mapping[str, Sequence[str]],
    order: Sequence[str],
    pieces: Sequence[str],
) -> DataFrame:
    """``row_number() over (partition by keys order by order nulls last)`` for each
    (name, keys) of ``numbers``; ``pieces`` as in `running_state`."""
    numbered = running_state(frame, order, pieces, {n: (keys, "1") for n, keys in numbers.items()})
    return numbered.withColumns({n: F.col(n).cast("int") for n in numbers})


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Equi-join in which null keys match; the result has the left side's keys."""
    renamed = right.select(
        *[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns]
    )
    matched = None
    for key in keys:
        same = left[key].eqNullSafe(renamed[f"_r_{key}"])
        matched = same if matched is None else matched & same
    return left.join(renamed, matched, how).drop(*[f"_r_{key}" for key in keys])
