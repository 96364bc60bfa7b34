"""Order-dependent operators that never put a whole table, or a whole hot key, in one task.

A plain ``Window`` without ``partitionBy`` moves the table into one task, and one with
``partitionBy(key)`` moves each key into one task. Both break when the table, or a single key,
holds terabytes. So the operators here look first:

1. ``split_points`` draws a bounded uniform sample of (key, order), sorted, and keeps evenly spaced
   tuples. A key that owns several of them is hot: it alone would fill several tasks.
2. Without hot keys the operator is the plain window per key.
3. Hot keys (or the table, when there is no key) are cut at the split points into slices of similar
   size. The points are literals in the plan, so every branch and every retried task sees the same
   slices. Only these rows are summarised, one aggregate row per (hot key, slice), and the
   summaries are folded in order into a carry: at most one row per split point, small enough to
   broadcast by construction.
4. Rows are ordered inside their own (key, slice) and the carry is added. This window is the only
   shuffle of the rows.

The order must be unique within a key (append an id): then ties cannot fill a slice.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

SLICE = "__slice"
#: Sampled rows per slice; more gives evener slices.
ROWS_PER_SLICE = 32
#: Rows a slice is meant to hold at most, and an upper bound on slices, which keeps the sample, the
#: literal array and the carry tables small.
SLICE_ROWS, MAX_SLICES = 4_000_000, 16_384
#: Hot keys up to which a scan of the list beats a binary search.
LINEAR_KEYS = 16


def as_columns(keys: Sequence[str | Column]) -> list[Column]:
    return [F.col(k) if isinstance(k, str) else k for k in keys]


def order_struct(keys: Sequence[str | Column]) -> Column:
    """The order key as one comparable value; nulls sort first, as in an ascending sort."""
    return F.struct(*[c.alias(f"k{i}") for i, c in enumerate(as_columns(keys))])


def slice_count(df: DataFrame) -> int:
    """Slices to aim for: twice the shuffle partitions, within ``MAX_SLICES``."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(2, min(MAX_SLICES, 2 * partitions))


def sort_sample(rows: list) -> list:
    """The keys in Spark's order: nulls first, NaN last."""

    def place(value):
        if value is None:
            return (0,)
        if isinstance(value, float) and value != value:
            return (2,)
        return (1, value.encode() if isinstance(value, str) else value)

    return sorted((r["key"] for r in rows), key=lambda k: [place(v) for v in k])


def split_points(df: DataFrame, keys: Sequence[str | Column], slices: int | None = None, least: int = 0) -> list:
    """Ascending key tuples that cut ``df`` into slices of similar size.

    Unless ``slices`` says how many, there are enough for the tasks, for slices of ``SLICE_ROWS`` rows
    and for ``least``. An empty list means the table has fewer rows than the sample, so one slice is
    enough. Only the sample, about ``slices * ROWS_PER_SLICE`` rows, reaches the driver.
    """
    rows = df.select(order_struct(keys).alias("key"))
    wanted = slices or min(MAX_SLICES, max(least, slice_count(df)))
    # one pass counts the rows and keeps those with the least draws, a bounded number per task
    seen = Observation()
    counted = rows.observe(seen, F.count(F.lit(1)).alias("n"))
    sample = counted.withColumn("draw", F.rand(7)).orderBy("draw").limit(wanted * ROWS_PER_SLICE).select("key").collect()
    total = seen.get["n"]
    if total <= wanted * ROWS_PER_SLICE:
        return []
    many = min(MAX_SLICES, -(-total // SLICE_ROWS))
    if slices is None and many > wanted:
        # a larger sample is drawn row by row: no sort and no single task
        wanted = many
        sample = rows.sample(fraction=wanted * ROWS_PER_SLICE / total, seed=7).collect()
    slices, sample = wanted, sort_sample(sample)
    step = max(1, len(sample) // slices)
    picked = [sample[i] for i in range(step, len(sample), step)]
    return [p for i, p in enumerate(picked) if i == 0 or p != picked[i - 1]]


class Slices:
    """Where hot keys, or a whole table, are cut. ``points`` are sorted (by..., order...) tuples."""

    def __init__(self, df: DataFrame, by: Sequence[str], order: Sequence[str | Column], points: list):
        self.by, order = list(by), as_columns(order)
        width = len(self.by)
        owned: dict[tuple, list] = {}
        for p in points:
            owned.setdefault(tuple(p[:width]), []).append(tuple(p[width:]))
        if by:
            owned = {k: cuts for k, cuts in owned.items() if len(cuts) > 1}
        if all(len({c[0] for c in cuts}) == len(cuts) for cuts in owned.values()):
            # the leading order column alone tells the slices apart
            order, owned = order[:1], {k: [c[:1] for c in cuts] for k, cuts in owned.items()}
        self.order, self.cuts = order, owned
        if owned:
            fields = df.select(order_struct([*by, *order]).alias("key")).schema["key"].dataType.fields
            self.by_types, self.order_types = [f.dataType for f in fields[:width]], [f.dataType for f in fields[width:]]

    @staticmethod
    def _cells(values: tuple, types: list) -> list[Column]:
        # wall-clock times go through text: a plain literal would pass through the local time zone
        as_text = [isinstance(t, TimestampNTZType) and v is not None for v, t in zip(values, types)]
        return [F.lit(str(v) if s else v).cast(t) for v, t, s in zip(values, types, as_text)]

    def _literal(self, values: tuple, types: list) -> Column:
        cells = self._cells(values, types)
        return cells[0] if len(cells) == 1 else order_struct(cells)

    def _hot_number(self) -> Column:
        """1-based number of the row's hot key, 0 or null for other keys."""
        plain = len(self.by) == 1 and (None,) not in self.cuts
        key = F.col(self.by[0]) if plain else order_struct(self.by)
        # a composite key is never null itself, so null parts match
        known = F.array(
            *[self._literal(k, self.by_types) if plain else order_struct(self._cells(k, self.by_types)) for k in self.cuts]
        )
        if len(self.cuts) <= LINEAR_KEYS:
            return F.array_position(known, key)
        found = lambda k: _once(
            _at_or_below(known, len(self.cuts), k), lambda n: F.when(F.get(known, n - 1) == k, n).otherwise(0)
        )
        return _once(key, found)

    def sliced(self) -> Column:
        """Whether the row's key is cut at all."""
        if not self.cuts:
            return F.lit(False)
        return self._hot_number() > 0 if self.by else F.lit(True)

    def assign(self, df: DataFrame) -> DataFrame:
        """Add the slice: how many of its key's cuts lie at or below the row, by binary search."""
        if not self.cuts:
            return df.withColumn(SLICE, F.lit(0))
        key = self.order[0] if len(self.order) == 1 else order_struct(self.order)
        per_key = [F.array(*[self._literal(c, self.order_types) for c in cuts]) for cuts in self.cuts.values()]
        longest = max(len(cuts) for cuts in self.cuts.values())
        cuts = F.get(F.array(*per_key), self._hot_number() - 1) if self.by else per_key[0]

        def number(args: Column) -> Column:
            found = _at_or_below(args["cuts"], longest, args["key"])
            return F.when(args["cuts"].isNotNull(), found).otherwise(0)

        return df.withColumn(SLICE, _once(F.struct(cuts.alias("cuts"), key.alias("key")), number))


def _once(value: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(value)`` with the value computed once per row, however often ``fn`` refers to it."""
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _at_or_below(ascending: Column, length: int, key: Column) -> Column:
    """How many entries of an ascending array of at most ``length`` are <= key, by binary search."""
    steps = F.array(*[F.lit(1 << i) for i in range(length.bit_length() - 1, -1, -1)])
    return F.aggregate(
        steps,
        F.lit(0),
        lambda pos, step: F.when(F.get(ascending, pos + step - 1) <= key, pos + step).otherwise(pos),
    )


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join that also matches null keys; the right copies of the keys are dropped."""
    renamed = right.withColumnsRenamed({c: f"__r_{c}" for c in on})
    cond = [F.col(c).eqNullSafe(F.col(f"__r_{c}")) for c in on]
    return left.join(renamed, cond, how).drop(*[f"__r_{c}" for c in on])


def with_carry(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    partials: dict[str, Column],
    folds: dict[str, Callable[[Column, object], Column]],
    slices: int | None = None,
    points: list | None = None,
) -> DataFrame:
    """Add, per row, ``partials`` folded over all earlier slices of the row's key.

    ``partials`` summarise one (key, slice); ``folds`` combine the summaries of earlier slices; both
    are null for keys that are not cut.
    The slice column stays on the result. ``points`` takes split points drawn before: from the
    source of a derived table, or shared by several operators over the same key and order.
    """
    if points is None:
        points = split_points(df, [*by, *order], slices)
    cuts = Slices(df, by, order, points)
    sliced = cuts.assign(df)
    keys = [*by, SLICE]
    totals = (
        sliced.filter(cuts.sliced()).groupBy(*keys).agg(*[c.alias(n) for n, c in partials.items()])
    )
    earlier = Window.partitionBy(*by).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, *[folds[n](F.col(n), earlier).alias(n) for n in partials])
    if not cuts.cuts:
        # no hot key, or a table smaller than the sample: nothing to carry
        return sliced.withColumns({n: F.lit(None).cast(carry.schema[n].dataType) for n in partials})
    # about one row per split point: bounded by MAX_SLICES, not by the data
    return null_safe_join(sliced, F.broadcast(carry), keys)


def local_window(by: Sequence[str], order: Sequence[str | Column]):
    return Window.partitionBy(*by, SLICE).orderBy(*as_columns(order))


def positions(
    df: DataFrame,
    order: Sequence[str | Column],
    by: Sequence[str] = (),
    name: str = "pos",
    **cut,
) -> DataFrame:
    """0-based row positions in ``order``, over the table or within each group."""
    carried = with_carry(
        df, by, order, {"__before": F.count(F.lit(1))}, {"__before": lambda c, w: F.sum(c).over(w)}, **cut
    )
    rank = F.row_number().over(local_window(by, order))
    return carried.withColumn(
        name, F.coalesce("__before", F.lit(0)) + rank - F.lit(1)
    ).drop(SLICE, "__before")


def running_sum(
    df: DataFrame,
    value: str | Column,
    order: Sequence[str | Column],
    by: Sequence[str] = (),
    name: str = "running_sum",
    **cut,
) -> DataFrame:
    """Cumulative sum in ``order``; nulls add nothing, as in a cumulative sum that skips them."""
    value = F.col(value) if isinstance(value, str) else value
    carried = with_carry(
        df, by, order, {"__before": F.sum(value)}, {"__before": lambda c, w: F.sum(c).over(w)}, **cut
    )
    local = local_window(by, order).rowsBetween(Window.unboundedPreceding, 0)
    total = F.coalesce("__before", F.lit(0)) + F.coalesce(F.sum(value).over(local), F.lit(0))
    return carried.withColumn(name, total).drop(SLICE, "__before")


def previous_value(
    df: DataFrame,
    value: str,
    order: Sequence[str | Column],
    by: Sequence[str] = (),
    name: str = "previous",
    **cut,
) -> DataFrame:
    """The value of the preceding row (null on the first row of a group)."""
    carried = with_carry(
        df, by, order,
        {"__before": F.max_by(F.col(value), order_struct(order))},
        {"__before": lambda c, w: F.last(c).over(w)},
        **cut,
    )
    local = local_window(by, order)
    first = F.row_number().over(local) == 1
    return carried.withColumn(
        name, F.when(first, F.col("__before")).otherwise(F.lag(value).over(local))
    ).drop(SLICE, "__before")


def difference(
    df: DataFrame,
    value: str,
    order: Sequence[str | Column],
    by: Sequence[str] = (),
    name: str = "diff",
    **cut,
) -> DataFrame:
    """Change against the preceding row."""
    out = previous_value(df, value, order, by, "__prev", **cut)
    return out.withColumn(name, F.col(value) - F.col("__prev")).drop("__prev")


def forward_fill(
    df: DataFrame,
    value: str,
    order: Sequence[str | Column],
    by: Sequence[str] = (),
    name: str | None = None,
    **cut,
) -> DataFrame:
    """Carry the last non-null value forward."""
    known = F.when(F.col(value).isNotNull(), order_struct(order))
    carried = with_carry(
        df, by, order,
        {"__before": F.max_by(F.col(value), known)},
        {"__before": lambda c, w: F.last(c, ignorenulls=True).over(w)},
        **cut,
    )
    local = local_window(by, order).rowsBetween(Window.unboundedPreceding, 0)
    filled = F.coalesce(F.last(value, ignorenulls=True).over(local), F.col("__before"))
    return carried.withColumn(name or value, filled).drop(SLICE, "__before")


def longest_streak(
    df: DataFrame,
    flag: Column,
    order: Sequence[str | Column],
    by: Sequence[str] = (),
    name: str = "longest",
    **cut,
) -> DataFrame:
    """Longest run of consecutive rows with ``flag`` true, per group.

    Every row without the flag starts a new island; islands are counted with map-side
    combining, so a run that spans most of the table is still many small partial counts.
    """
    flagged = df.select(*[c for c in df.columns], F.coalesce(flag, F.lit(False)).alias("__flag"))
    islands = running_sum(
        flagged, F.when(F.col("__flag"), 0).otherwise(1), order, by, "__island", **cut
    )
    runs = islands.groupBy(*by, "__island").agg(F.count_if("__flag").alias("__run"))
    return runs.groupBy(*by).agg(F.max("__run").alias(name))


def value_ranks(
    df: DataFrame, value: str, by: Sequence[str] = (), weight: str | None = None, **cut
) -> DataFrame:
    """One row per distinct value: count, rows strictly below, rows at or below, and group size.

    Equal values are combined before anything is ordered, so ties cost one row each. With ``weight``
    a row stands for that many.
    """
    rows = df.filter(F.col(value).isNotNull())
    if "points" not in cut:
        # drawn from the rows, not from their counts: no aggregate runs for the sample
        cut = {"points": split_points(rows, [*by, value], cut.get("slices"))}
    counts = rows.groupBy(*by, value).agg((F.sum(weight) if weight else F.count(F.lit(1))).alias("cnt"))
    carried = with_carry(
        counts, by, [value],
        {"__before": F.sum("cnt"), "__all": F.sum("cnt")},
        {
            "__before": lambda c, w: F.sum(c).over(w),
            "__all": lambda c, w: F.sum(c).over(Window.partitionBy(*by)),
        },
        **cut,
    )
    local = local_window(by, [value]).rowsBetween(Window.unboundedPreceding, 0)
    own = Window.partitionBy(*by, SLICE)
    ranked = carried.withColumns(
        {
            "at_or_below": F.coalesce("__before", F.lit(0)) + F.sum("cnt").over(local),
            "n": F.coalesce(F.col("__all"), F.sum("cnt").over(own)),
        }
    ).drop(SLICE, "__before", "__all")
    return ranked.withColumn("below", F.col("at_or_below") - F.col("cnt"))


def ecdf(df: DataFrame, value: str, by: Sequence[str] = (), **cut) -> DataFrame:
    """Empirical distribution: share at or below, share above, and cumulative count per value."""
    ranks = value_ranks(df, value, by, **cut)
    share = F.col("at_or_below") / F.col("n")
    return ranks.select(
        *by, value, share.alias("ecdf"), (F.lit(1.0) - share).alias("complement"),
        F.col("at_or_below").alias("cum_count"),
    )


def average_ranks(
    df: DataFrame, value: str, by: Sequence[str] = (), weight: str | None = None, **cut
) -> DataFrame:
    """1-based rank per distinct value, ties sharing their mean rank."""
    ranks = value_ranks(df, value, by, weight, **cut)
    return ranks.select(
        *by, value, "cnt", (F.col("below") + (F.col("cnt") + 1) / F.lit(2.0)).alias("avg_rank")
    )


def folds(
    df: DataFrame, order: Sequence[str | Column], k: int, name: str = "fold", **cut
) -> DataFrame:
    """k consecutive parts of near-equal size (1..k); the first parts take the remainder."""
    numbered = positions(df, order, name="__pos", **cut)
    n = df.agg(F.count(F.lit(1))).scalar()
    base, extra = F.floor(n / F.lit(k)), F.pmod(n, F.lit(k))
    cut = extra * (base + 1)
    pos = F.col("__pos")
    fold = F.when(pos < cut, F.floor(pos / (base + 1))).otherwise(
        extra + F.floor((pos - cut) / F.greatest(base, F.lit(1)))
    )
    return numbered.withColumn(name, (fold + 1).cast("int")).drop("__pos")


def batches(
    df: DataFrame, order: Sequence[str | Column], size: int, name: str = "batch", **cut
) -> DataFrame:
    """Number of the consecutive batch of ``size`` rows a row falls in (0-based)."""
    numbered = positions(df, order, name="__pos", **cut)
    return numbered.withColumn(name, F.floor(F.col("__pos") / size)).drop("__pos")
