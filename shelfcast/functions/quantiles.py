"""Exact interpolated quantiles of a distributed column.

The built-in exact ``percentile`` keeps every distinct value of a group in one
buffer, which a hot group outgrows, so it serves only inputs whose row count
has been checked. Beyond that a mergeable sketch proposes a narrow bracket
around each wanted rank; counts against the bracket make the rank exact, and
only the values inside the bracket are sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.session import broadcast_if_small, materialize

# Row count up to which all values of the input may share one aggregation buffer.
BUFFERED_ROWS = 2_000_000
_INF = float("inf")


def attach(df: DataFrame, small: DataFrame, by: Sequence[str], name: str) -> DataFrame:
    """Add the columns of ``small`` to ``df`` as the struct ``name``.

    ``small`` has one row per ``by`` group and is joined on it (by broadcast
    while its counted rows are few); without ``by`` it is a single row and becomes a
    scalar subquery.
    """
    packed = F.struct(*[c for c in small.columns if c not in by]).alias(name)
    if by:
        return df.join(broadcast_if_small(small.select(*by, packed)), list(by))
    return df.withColumn(name, small.select(packed).scalar())


def exact_quantiles(
    df: DataFrame,
    value: str,
    probs: Sequence[float] | None = None,
    by: Sequence[str] = (),
    parts: int | None = None,
    accuracy: int = 10_000,
    stored: bool = False,
    buffered_rows: int = BUFFERED_ROWS,
) -> DataFrame:
    """Linear-interpolated quantiles per group: columns ``by`` and ``edges`` (array).

    Give either ``probs``, or ``parts`` for the edges of ``q`` equal parts where
    ``q`` is the least of ``parts``, the group's row count and its number of
    distinct values. NULL and NaN values are ignored.

    The values are written once to the shared folder unless the caller says the
    input is ``stored`` already: the passes below then read columns, not plans.
    """
    by = list(by)
    rows = df.select(*by, F.col(value).cast("double").alias("v")).where("v is not null and not isnan(v)")
    if not stored:
        rows = materialize(rows, "quantile-values")
    if rows.count() <= buffered_rows:
        return _buffered(rows, by, probs, parts)
    return _bracketed(rows, by, probs, parts, accuracy)


def _buffered(rows: DataFrame, by: list[str], probs: Sequence[float] | None, parts: int | None) -> DataFrame:
    if parts is None:
        return rows.groupBy(*by).agg(F.percentile("v", list(probs)).alias("edges"))
    fractions = sorted({i / q for q in range(1, parts + 1) for i in range(q + 1)})
    picks = F.create_map(*[
        x for q in range(1, parts + 1)
        for x in (F.lit(q), F.array(*[F.lit(fractions.index(i / q)) for i in range(q + 1)]))
    ])
    q = F.least(F.lit(parts), F.col("total"), F.col("n_unique")).cast("int")
    return (
        rows.groupBy(*by, "v").agg(F.count(F.lit(1)).alias("n")).groupBy(*by)
        .agg(F.percentile("v", fractions, F.col("n")).alias("at"), F.sum("n").alias("total"), F.count("v").alias("n_unique"))
        .withColumn("pick", F.element_at(picks, q))
        .select(*by, F.transform("pick", lambda i: F.get("at", i)).alias("edges"))
    )


def _between(a: str, z: str, t: str) -> Column:
    """Interpolation as the built-in percentile does it, term by term, so that both roads give equal bits."""
    low, high, at = F.col(f"{t}.first"), F.col(f"{t}.last"), F.col(f"{t}.position")
    mixed = (high - at) * F.col(a) + (at - low) * F.col(z)
    return F.when((low == high) | (F.col(a) == F.col(z)), F.col(a)).otherwise(mixed)


def _bracketed(
    rows: DataFrame, by: list[str], probs: Sequence[float] | None, parts: int | None, accuracy: int
) -> DataFrame:
    wanted = list(probs) if probs is not None else [i / parts for i in range(parts + 1)]
    margin = 3.0 / accuracy
    asked = [max(p - margin, 0.0) for p in wanted] + [min(p + margin, 1.0) for p in wanted]
    sketch = rows.groupBy(*by).agg(
        F.percentile_approx("v", asked, accuracy).alias("s"), F.count("v").alias("total")
    )
    if parts is not None:
        distinct = rows.distinct().groupBy(*by).agg(F.count("v").alias("n_unique"))
        sketch = attach(sketch, distinct, by, "d").withColumn("q", F.greatest(
            F.lit(1), F.least(F.lit(parts), F.col("total"), F.col("d.n_unique")).cast("int")))
    else:
        sketch = sketch.withColumn("q", F.lit(None).cast("int"))
    k = len(wanted)
    # With fewer parts than asked the group has few distinct values: no bracket needed.
    whole = F.coalesce(F.col("q") < F.lit(parts or 0), F.lit(False))

    def low(i: int) -> Column:
        if wanted[i] - margin <= 0:
            return F.lit(-_INF)
        return F.when(whole, F.lit(-_INF)).otherwise(F.get("s", F.lit(i)))

    def high(i: int) -> Column:
        if wanted[i] + margin >= 1:
            return F.lit(_INF)
        return F.when(whole, F.lit(_INF)).otherwise(F.get("s", F.lit(k + i)))

    def prob(i: int) -> Column:
        return F.lit(wanted[i]) if parts is None else F.when(F.col("q") >= i, F.lit(float(i)) / F.col("q"))

    brackets = sketch.select(
        *by, "total",
        *[low(i).alias(f"lo{i}") for i in range(k)],
        *[high(i).alias(f"hi{i}") for i in range(k)],
        *[prob(i).alias(f"p{i}") for i in range(k)],
    )
    counted = attach(rows, brackets, by, "b").groupBy(*by).agg(
        *[F.count_if(F.col("v") < F.col(f"b.lo{i}")).alias(f"below{i}") for i in range(k)],
        *[F.count_if(F.col("v") <= F.col(f"b.hi{i}")).alias(f"upto{i}") for i in range(k)],
    )

    def target(i: int) -> Column:
        position = F.col(f"p{i}") * (F.col("total") - 1)
        first = F.floor(position)
        last = F.ceil(position)
        holds = (F.col(f"c.below{i}") <= first) & (last < F.col(f"c.upto{i}"))
        return F.struct(
            F.lit(i).alias("i"),
            F.when(holds, F.col(f"lo{i}")).otherwise(F.lit(-_INF)).alias("lo"),
            F.when(holds, F.col(f"hi{i}")).otherwise(F.lit(_INF)).alias("hi"),
            F.when(holds, F.col(f"c.below{i}")).otherwise(F.lit(0)).alias("below"),
            first.alias("first"), last.alias("last"), position.alias("position"),
        )

    targets = attach(brackets, counted, by, "c").select(
        *by,
        F.filter(F.array(*[target(i) for i in range(k)]), lambda t: t["first"].isNotNull()).alias("targets"),
    )
    inside = (
        attach(rows, targets, by, "t")
        .select(*by, "v", F.explode(F.filter("t.targets", lambda t: (F.col("v") >= t["lo"]) & (F.col("v") <= t["hi"]))).alias("t"))
        .groupBy(*by, "t", "v").agg(F.count(F.lit(1)).alias("n"))
    )
    running = Window.partitionBy(*by, "t").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    reached = inside.withColumn("upto", F.col("t.below") + F.sum("n").over(running))
    edges = (
        reached.groupBy(*by, "t").agg(
            F.min(F.when(F.col("upto") > F.col("t.first"), F.col("v"))).alias("a"),
            F.min(F.when(F.col("upto") > F.col("t.last"), F.col("v"))).alias("z"),
        )
        .select(*by, F.struct(F.col("t.i").alias("i"), _between("a", "z", "t").alias("e")).alias("e"))
    )
    return edges.groupBy(*by).agg(F.transform(F.sort_array(F.collect_list("e")), lambda e: e["e"]).alias("edges"))
