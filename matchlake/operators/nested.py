"""Nested-data operators (arrays of structs, structs, maps).

All of them are built-in higher-order functions or generators, evaluated
per row inside whole-stage code; none needs a shuffle.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def nth(arr: ColumnOrName, i: int) -> Column:
    """0-based element; NULL past the end (plain ``[i]`` raises under ANSI)."""
    return F.get(_c(arr), i)


def unnest(df: DataFrame, arr: ColumnOrName, alias: str, *keep: str) -> DataFrame:
    """Inner unnest -- a NULL or empty array drops the row."""
    return df.select(*keep, F.explode(_c(arr)).alias(alias))


def expand(df: DataFrame, struct: str, *keep: str) -> DataFrame:
    """All fields of a struct as columns."""
    return df.select(*keep, f"{struct}.*")


def or_empty(arr: ColumnOrName) -> Column:
    """A NULL array as an empty one, so that concatenation keeps the others."""
    return F.coalesce(_c(arr), F.array())


def concat_arrays(*arrs: ColumnOrName) -> Column:
    """One array of all elements; a NULL input contributes nothing
    (as unnesting it separately would)."""
    return F.concat(*[or_empty(a) for a in arrs])


def keep(arr: ColumnOrName, pred: Callable[[Column], Column]) -> Column:
    """Elements satisfying the predicate; NULL counts as false."""
    return F.filter(_c(arr), lambda x: F.coalesce(pred(x), F.lit(False)))


def tail(arr: ColumnOrName, skip: int = 1) -> Column:
    """Drop the first ``skip`` elements (header rows); empty when shorter."""
    return F.slice(_c(arr), skip + 1, 1 << 30)  # a slice stops at the end


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once, however often it is used:
    inside lambdas Spark shares no common subexpressions."""
    return F.get(F.transform(F.array(value), use), 0)


def first_where(arr: ColumnOrName, pred: Callable[[Column], Column]) -> Column:
    """The first element satisfying the predicate, else NULL."""
    return F.get(F.filter(_c(arr), pred), 0)


def attach_first(
    left: ColumnOrName, right: ColumnOrName, on: str, field: str, as_field: str
) -> Column:
    """For every element of ``left``, add ``as_field`` = ``field`` of the
    first element of ``right`` whose ``on`` equals the left element's ``on``
    (NULL if none)."""
    return F.transform(
        _c(left),
        lambda l: l.withField(
            as_field, first_where(right, lambda r: r[on] == l[on])[field]
        ),
    )


def zip_positions(df: DataFrame, arrs: dict[str, ColumnOrName], *keep: str) -> DataFrame:
    """Pair parallel arrays by position; one row per position with the
    0-based position ``pos``. The shorter arrays are padded with NULL."""
    names = list(arrs)
    zipped = F.arrays_zip(*[_c(a).alias(n) for n, a in arrs.items()])
    x = df.select(*keep, F.posexplode(zipped).alias("pos", "_z"))
    return x.select(*keep, "pos", *[F.col(f"_z.{n}").alias(n) for n in names])


def last_value_of(keys: ColumnOrName, values: ColumnOrName, key: str) -> Column:
    """Value for ``key`` in parallel key / value arrays where a repeated
    key keeps the later value (dict assignment order)."""
    pairs = F.arrays_zip(_c(keys).alias("k"), _c(values).alias("v"))
    return F.element_at(F.filter(pairs, lambda e: e["k"] == key), -1)["v"]


def last_wins_map(keys: ColumnOrName, values: ColumnOrName) -> Column:
    """A map from parallel arrays; a repeated key keeps the later value
    and NULL keys are skipped. Earlier duplicates are filtered out first, so
    no session setting (mapKeyDedupPolicy) is involved."""
    pairs = F.arrays_zip(_c(keys).alias("k"), _c(values).alias("v"))
    n = F.size(pairs)
    kept = F.filter(
        pairs,
        lambda e, i: e["k"].isNotNull()
        & ~F.exists(
            F.slice(pairs, i + 2, F.greatest(n - i - 1, F.lit(0))),
            lambda later: later["k"] == e["k"],
        ),
    )
    return F.map_from_entries(
        F.transform(kept, lambda e: F.struct(e["k"].alias("key"), e["v"].alias("value")))
    )


def split_by(arr: ColumnOrName, pred: Callable[[Column], Column]) -> tuple[Column, Column]:
    """(elements where pred holds, elements where it does not)."""
    a = _c(arr)
    return F.filter(a, pred), F.filter(a, lambda x: ~F.coalesce(pred(x), F.lit(False)))


def sorted_structs(arr: ColumnOrName) -> Column:
    """Stable order of a collected list (field order decides)."""
    return F.sort_array(_c(arr))
