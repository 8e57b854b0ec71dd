"""Operators over ordered series: previous row, change, moving average, first rows.

A series is all rows with the same key, in the order of `order_by`. One window
per series is the natural plan, and the one used for ordinary series. A window
sorts each series in a single task, though, so a series that holds a large share
of all rows is cut along its order into pieces of about `hot_rows` rows. Each piece
carries a copy of the few rows before it, which makes every result equal to that
of the one large window.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Window
from pyspark.sql import functions as F

# Rows of one series that a single task may sort.
HOT_ROWS = 5_000_000
# Rows of a piece that may become boundaries, about; more make pieces more even.
_MARKS_PER_PIECE = 64
# Boundaries that a row is compared with at once.
_BOUNDS_PER_GROUP = 256

_PIECE, _COPY, _BOUNDS, _BEFORE = "__piece", "__copy", "__bounds", "__before_all"
_WHOLE = -1


def previous(df, columns, keys, order_by, hot_rows=HOT_ROWS, before=None):
    """Add, for each `{new: source}`, the source value of the row before; NULL on the first."""
    return over_series(
        df,
        keys,
        order_by,
        lambda window: {new: F.lag(source).over(window) for new, source in columns.items()},
        lookback=1,
        hot_rows=hot_rows,
        before=before,
    )


def daily_delta(df, columns, keys, order_by, clamp=True, hot_rows=HOT_ROWS, before=None):
    """Add, for each `{new: source}`, the change since the row before.

    The first row, and any row where either value is missing, gives 0. With
    `clamp` a fall gives 0 as well. Rows are compared, not days: a change across
    missing days covers all of them.
    """

    def change(source, window):
        step = F.col(source) - F.lag(source).over(window)
        return F.greatest(step, F.lit(0)) if clamp else F.coalesce(step, F.lit(0))

    return over_series(
        df,
        keys,
        order_by,
        lambda window: {new: change(source, window) for new, source in columns.items()},
        lookback=1,
        hot_rows=hot_rows,
        before=before,
    )


def moving_avg(df, columns, keys, order_by, rows=7, hot_rows=HOT_ROWS, before=None):
    """Add, for each `{new: source}`, the mean of the last `rows` rows.

    NULL until `rows` rows are there, and while any of them is NULL.
    """

    def mean(source, window):
        last = window.rowsBetween(1 - rows, Window.currentRow)
        return F.when(F.count(source).over(last) == rows, F.avg(source).over(last))

    return over_series(
        df,
        keys,
        order_by,
        lambda window: {new: mean(source, window) for new, source in columns.items()},
        lookback=rows - 1,
        hot_rows=hot_rows,
        before=before,
    )


def first_n(df, keys, order_by, n, salts=64):
    """The first `n` rows of every series.

    Taken in two steps, first within `salts` hash groups of each series, so the
    last step sees at most `salts * n` rows of a series however long it is.
    """
    return _ranked(df, keys, order_by, order_by, n, salts)


def _ranked(df, keys, order, salted_by, n, salts):
    salt, rank = "__salt", "__rank"
    salted = df.withColumn(salt, F.pmod(F.xxhash64(*salted_by), F.lit(salts)))
    for group in ([*keys, salt], keys):
        window = Window.partitionBy(*group).orderBy(*order)
        salted = salted.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)
    return salted.drop(salt, rank)


def last_n(df, keys, order_by, n, salts=64):
    """The last `n` rows of every series, taken in two steps like the first ones."""
    return _ranked(df, keys, [F.desc(name) for name in order_by], order_by, n, salts)


def tail(df, keys, order_by, rows, before=None):
    """What later rows need of `df` and of the tail `before` it: the last `rows` rows of every series."""
    if before is not None:
        df = df.unionByName(before.select(*df.columns))
    return last_n(df, keys, order_by, rows)


def late(df, before, keys, order_by):
    """Rows of `df` that do not come after all rows of `before` of their series.

    Values that follow from earlier rows cannot be told for them without the rows after them.
    """
    place, last = F.struct(*order_by), "__last"
    ends = before.groupBy(*[F.col(key).alias(f"__{key}") for key in keys]).agg(F.max(place).alias(last))
    same = reduce(
        lambda left, right: left & right, [F.col(key).eqNullSafe(F.col(f"__{key}")) for key in keys]
    )
    return df.join(ends, same).where(place <= F.col(last)).select(*df.columns)


def over_series(df, keys, order_by, build, lookback, hot_rows=HOT_ROWS, before=None):
    """Add the columns of `build(window)`, a dict of windowed Columns.

    `lookback` is how many rows before its own a column may read. Rows are counted by key first, in a
    job of its own that reads the keys alone: where no series is long the plan is one plain window.
    `hot_rows=None` says that every series is known to be short and skips that. `before` are
    rows that come before those of `df` (see `tail`).
    """
    if before is not None:
        # Rows of before lend their values and are not given back.
        both = df.withColumn(_BEFORE, F.lit(False)).unionByName(
            before.select(*df.columns).withColumn(_BEFORE, F.lit(True))
        )
        result = over_series(both, keys, order_by, build, lookback, hot_rows)
        return result.where(~F.col(_BEFORE)).drop(_BEFORE)
    if hot_rows is None or _hot_keys(df, keys, hot_rows).isEmpty():
        return df.withColumns(build(Window.partitionBy(*keys).orderBy(*order_by)))

    columns = df.columns
    pieces = _cut(df, columns, keys, order_by, hot_rows)
    copies = _rows_before_pieces(pieces, columns, keys, order_by, lookback)
    built = build(Window.partitionBy(*keys, _PIECE).orderBy(*order_by))
    kept = [name for name in columns if name not in built]
    return (
        pieces.unionByName(copies)
        .select(*kept, _COPY, *[column.alias(name) for name, column in built.items()])
        .where(~F.col(_COPY))
        .select(*kept, *built)
    )


def _cut(df, columns, keys, order_by, hot_rows):
    """Tag rows with their piece; series within `hot_rows` stay whole.

    Boundaries are rows of the series itself, compared by all order columns, so pieces are
    even whatever the values look like. Which rows may become boundaries is decided by a
    hash of the row: that chooses where to cut, never what is answered.
    """
    count, place = "__count", "__place"
    hot = _hot_keys(df, keys, hot_rows)
    same_key = reduce(
        lambda left, right: left & right,
        [F.col(key).eqNullSafe(F.col(f"__{key}")) for key in keys],
    )
    every = max(hot_rows // _MARKS_PER_PIECE, 1)
    marks = (
        # Rows that are equal in these columns stay together anyway.
        df.where(F.pmod(F.xxhash64(*keys, *order_by), F.lit(every)) == 0)
        .join(hot, same_key, "left_semi")
        .select(*keys, F.struct(*order_by).alias(place))
    )
    in_series = Window.partitionBy(*keys).orderBy(place)
    per_piece = max(hot_rows // every, 1)
    rank = "__rank"
    bounds = (
        marks.withColumn(rank, F.row_number().over(in_series))
        .where(F.col(rank) % per_piece == 0)
        # Two levels, so that a row finds its piece among the many of a very long series.
        .groupBy(*keys, F.floor(F.col(rank) / (per_piece * _BOUNDS_PER_GROUP)).alias(count))
        .agg(F.array_sort(F.collect_set(place)).alias(place))
        .select(*keys, F.struct(F.element_at(place, 1).alias("first"), F.col(place).alias("all")).alias(place))
        .groupBy(*[F.col(key).alias(f"__{key}") for key in keys])
        .agg(F.array_sort(F.collect_list(place)).alias(_BOUNDS))
    )
    at = F.struct(*order_by)
    group = F.size(F.filter(F.col(_BOUNDS), lambda bound: bound["first"] <= at))
    tagged = df.join(bounds, same_key, "left").select(
        *columns, _BOUNDS, F.when(F.col(_BOUNDS).isNotNull(), group).alias(place)
    )
    within = F.size(
        F.filter(F.get(F.col(_BOUNDS), F.col(place) - 1)["all"], lambda bound: bound <= at)
    )
    piece = (
        F.when(F.col(_BOUNDS).isNull(), F.lit(_WHOLE))
        .when(F.col(place) == 0, F.lit(0))
        .otherwise((F.col(place) - 1) * F.lit(_BOUNDS_PER_GROUP + 1) + within)
    )
    return tagged.select(
        *columns, piece.cast("long").alias(_PIECE), F.lit(False).alias(_COPY)
    )


def _hot_keys(df, keys, hot_rows):
    """Keys, under other names, of the series with more than `hot_rows` rows."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__count"))
    return counted.where(F.col("__count") > hot_rows).select(*[F.col(key).alias(f"__{key}") for key in keys])


def _rows_before_pieces(pieces, columns, keys, order_by, lookback):
    """Copies of the `lookback` rows that come before each piece of a cut series."""
    rank, before, follows = "__rank", "__before", "__follows"
    from_end = Window.partitionBy(*keys, _PIECE).orderBy(*[F.desc(name) for name in order_by])
    # The ends of all pieces before a piece hold its last `lookback` rows before it.
    series = Window.partitionBy(*keys).orderBy(*order_by)
    return (
        pieces.where(F.col(_PIECE) != _WHOLE)
        .withColumn(rank, F.row_number().over(from_end))
        .where(F.col(rank) <= lookback)
        .select(
            _PIECE,
            F.collect_list(F.struct(*columns))
            .over(series.rowsBetween(-lookback, -1))
            .alias(before),
            (F.lag(_PIECE).over(series) != F.col(_PIECE)).alias(follows),
        )
        .where(follows)
        .select(_PIECE, F.explode(before).alias(before))
        .select(f"{before}.*", _PIECE, F.lit(True).alias(_COPY))
    )
