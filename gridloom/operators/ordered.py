"""Ordered per-key operations that never put a whole key into one task.

A key (a component, a market interval) may hold a large part of all rows, so a plain
`Window.partitionBy(key)` would send that part to one task. Here every key is cut into
blocks by `block`, a column expression that never falls as the order rises (a day number,
a price band); without one, the cuts are drawn from the data, so that a dense day takes many blocks and a key that fits
a task is not cut.
Rows are windowed inside `(key, block)`; one pre-aggregated row per block
carries the state across, and only those few rows are windowed per key. Results are the
same as those of the plain window, where null keys are one key and null orders come first. Ordering
columns should be unique within a key, as for any window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

from gridloom.session import fresh_path

_CARRY = "__block_carry"
#: Rows of a block that is drawn, the most blocks of a key, and the rows drawn for each cut.
ROWS_PER_BLOCK = 1 << 18
MOST_BLOCKS = 1024
DRAWN_PER_CUT = 16


def _order_key(order: Sequence[str]) -> Column:
    return F.col(order[0]) if len(order) == 1 else F.struct(*order)


def _last(source: str, order: Sequence[str], where: Column | None = None) -> Column:
    """The `source` of the row that is last in order, of the rows that are `where`.

    With a single plain column that is found by a hash aggregation, a struct would need a sort. A null is lowest: it
    counts where there is nothing else.
    """
    key = _order_key(order)
    known, any_ = (key, F.lit(1)) if where is None else (F.when(where, key), F.when(where, F.lit(1)))
    return F.max_by(source, known) if len(order) > 1 else F.when(F.count(known) > 0, F.max_by(source, known)).otherwise(F.max_by(source, any_))


def draw_blocks(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows: int | None = None) -> tuple[DataFrame, Column | None]:
    """`df` with the cuts of its large keys, and the block expression over them, for blocks of about `rows` rows.

    Keys are counted first; if none has more rows than a block, there is nothing to cut and the expression is None. Of
    the large ones, rows drawn by a hash of their order are sorted per key, and every sixteenth is a cut: an
    array per large key, which its rows look up. Cuts are values of all ordering columns, so that equal prices, say,
    are cut by unit. The cuts are written; `df` is read up to three times.
    """
    spark, rows = df.sparkSession, rows or ROWS_PER_BLOCK
    parts = {f"__key{i}": F.col(k) for i, k in enumerate(keys)}
    solid, names = _solid(df.select(*keys, *(c for c in order if c not in keys)), parts, "__key_nulls")
    large = _written(solid.groupBy(*names).agg(F.count(F.lit(1)).alias("__rows")).where(F.col("__rows") > rows), "large-keys")
    if large.isEmpty():
        return df, None
    value = F.struct(*(F.col(c).alias(f"c{i}") for i, c in enumerate(order)))
    step = F.greatest(F.lit(rows), F.ceil(F.col("__rows") / MOST_BLOCKS))
    drawn = solid.join(large, names).where(F.pmod(F.xxhash64(F.lit("cut"), *names, *order), step) < DRAWN_PER_CUT)
    cuts = drawn.groupBy(*names).agg(F.sort_array(F.collect_list(value)).alias("__drawn"))
    each = F.transform(F.sequence(F.lit(0), F.floor(F.size("__drawn") / DRAWN_PER_CUT).cast("int")), lambda i: F.get("__drawn", i * DRAWN_PER_CUT - 1))
    cuts = _written(cuts.select(*names, F.filter(each, lambda c: c.isNotNull()).alias("__cuts")), "cuts")
    met, _ = _solid(df, parts, "__key_nulls")
    met = met.join(cuts, names, "left").select(*df.columns, "__cuts")
    steps = F.array(*(F.lit(2 * MOST_BLOCKS >> i) for i in range(1, (2 * MOST_BLOCKS).bit_length())))
    below = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get("__cuts", at + step - 1) <= value, at + step).otherwise(at))
    return met, F.when(F.col("__cuts").isNull(), F.lit(0)).otherwise(below)


def _written(df: DataFrame, label: str) -> DataFrame:
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stand_in(kind: DataType) -> Column | None:
    """A value of a type, to stand for a null that is marked elsewhere."""
    if isinstance(kind, StringType):
        return F.lit("")
    if isinstance(kind, NumericType):
        return F.lit(0).cast(kind)
    return F.lit("2000-01-01").cast(kind) if isinstance(kind, DateType | TimestampType | TimestampNTZType) else None


def _solid(df: DataFrame, parts: dict[str, Column], nulls: str) -> tuple[DataFrame, list[str]]:
    """`df` with columns that are equal where `parts` are, nulls included, and never null: a plain join on them meets nulls, too.

    They take the place of the parts in windows and groups, so the join finds its rows where the window left them.
    """
    kinds = df.select(*(c.alias(n) for n, c in parts.items())).schema
    added, mark = {}, F.lit(0)
    for i, (name, column) in enumerate(parts.items()):
        stand_in = _stand_in(kinds[name].dataType)
        added[name] = F.struct(column.alias("of")) if stand_in is None else F.coalesce(column, stand_in)
        mark = mark if stand_in is None else mark + F.when(column.isNull(), F.lit(1 << i)).otherwise(F.lit(0))
    return df.withColumns(added | {nulls: mark}), [*parts, nulls]


def _blocked(df: DataFrame, keys: Sequence[str], order: Sequence[str], block: Column | None) -> tuple[DataFrame, list[str], list[str] | None]:
    """(rows with solid keys and blocks, names of the keys, names of the block, None if every key is one block)."""
    rows = df
    if block is None:
        rows, block = draw_blocks(df, keys, order)
        if block is None:
            return df, list(keys), None
    rows, key = _solid(rows, {f"__key{i}": F.col(k) for i, k in enumerate(keys)}, "__key_nulls")
    rows, at = _solid(rows, {"__block": block}, "__block_null")
    return rows, key, at


def _over_blocks(key: list[str]):
    """The blocks of a key in order, the one of null first."""
    return Window.partitionBy(*key).orderBy(F.desc("__block_null"), "__block")


def previous_values(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], values: dict[str, str], block: Column | None = None
) -> DataFrame:
    """Add the previous row's `values` ({new column: source column}) within each key."""
    order = list(order)
    blocked, key, at = _blocked(df, keys, order, block)
    if at is None:
        whole = Window.partitionBy(*key).orderBy(*order)
        return df.select("*", *(F.lag(source).over(whole).alias(new) for new, source in values.items()))
    carried = {f"{_CARRY}{i}": source for i, source in enumerate(values.values())}
    carry = blocked.groupBy(*key, *at).agg(*[_last(source, order).alias(name) for name, source in carried.items()])
    carry = carry.withColumns({name: F.lag(name).over(_over_blocks(key)) for name in carried})
    inside = Window.partitionBy(*key, *at).orderBy(*order)
    before = {f"__block_prev{i}": F.lag(source).over(inside) for i, source in enumerate(values.values())}
    chosen = [
        F.when(F.col("__block_start"), F.col(f"{_CARRY}{i}")).otherwise(F.col(f"__block_prev{i}")).alias(new)
        for i, new in enumerate(values)
    ]
    return (
        blocked.withColumns({**before, "__block_start": F.row_number().over(inside) == 1})
        .join(carry, [*key, *at], "left")
        .select(*df.columns, *chosen)
    )


def running_total(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str | Column, block: Column | None, out: str
) -> DataFrame:
    """Add the running sum of `value` within each key, current row included."""
    order = list(order)
    blocked, key, at = _blocked(df, keys, order, block)
    amount = F.col(value) if isinstance(value, str) else value
    if at is None:
        return df.select("*", F.sum(amount).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)).alias(out))
    blocked = blocked.withColumn("__value", amount)
    carry = blocked.groupBy(*key, *at).agg(F.sum("__value").alias(_CARRY))
    carry = carry.withColumn(_CARRY, F.sum(_CARRY).over(_over_blocks(key).rowsBetween(Window.unboundedPreceding, -1)))
    inside = Window.partitionBy(*key, *at).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    inner, before = F.col("__sum"), F.col(_CARRY)
    total = F.when(before.isNull(), inner).when(inner.isNull(), before).otherwise(inner + before)
    return (
        blocked.withColumn("__sum", F.sum("__value").over(inside))
        .join(carry, [*key, *at], "left")
        .select(*df.columns, total.alias(out))
    )


def carry_forward(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, block: Column | None, out: str
) -> DataFrame:
    """Add the last non-null `value` at or before each row within each key."""
    order = list(order)
    blocked, key, at = _blocked(df, keys, order, block)
    if at is None:
        return df.select("*", F.last(value, ignorenulls=True).over(Window.partitionBy(*key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)).alias(out))
    carry = blocked.groupBy(*key, *at).agg(_last(value, order, F.col(value).isNotNull()).alias(_CARRY))
    carry = carry.withColumn(_CARRY, F.last(_CARRY, ignorenulls=True).over(_over_blocks(key).rowsBetween(Window.unboundedPreceding, -1)))
    inside = Window.partitionBy(*key, *at).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        blocked.withColumn("__last", F.last(value, ignorenulls=True).over(inside))
        .join(carry, [*key, *at], "left")
        .select(*df.columns, F.coalesce("__last", _CARRY).alias(out))
    )
