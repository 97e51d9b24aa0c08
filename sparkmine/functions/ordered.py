"""Order statistics that never gather a whole column in one task."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sparkmine.functions.joins import null_safe_join, side_table
from sparkmine.lineage import cut

ROWS_PER_WINDOW = 1_000_000
MAX_RANGES = 256  # ranges of fewer rows than ``ROWS_PER_WINDOW``: one more range costs a task and a file
SMALL_GROUP = 1_000_000
ACCURACY = 10_000


def running_sums(
    df: DataFrame,
    by: Sequence[str],
    order: str,
    sums: Sequence[str],
    *,
    descending: bool = False,
    rows_per_window: int = ROWS_PER_WINDOW,
) -> DataFrame:
    """Add ``cum_<c>`` (inclusive running sum in ``order``) for each column in ``sums``.

    Input has one row per (``by``, ``order``). A group larger than
    ``rows_per_window`` is cut into value ranges: each range is summed in its own
    task and shifted by the total of the ranges before it. A range holds about half of
    ``rows_per_window``, or more where that would make over ``MAX_RANGES`` of them, up to
    half of ``ROWS_PER_WINDOW``. Null groups and null values are kept, and ``order`` may
    have any sortable type.
    """
    df = cut(df)
    by = list(by)
    sort = F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_first()
    biggest = df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    if biggest <= rows_per_window:
        # the size of the largest window has just been checked
        w = Window.partitionBy(*by).orderBy(sort).rowsBetween(Window.unboundedPreceding, 0)
        return df.select("*", *[F.sum(c).over(w).alias(f"cum_{c}") for c in sums])

    total = df.count()
    ranges = lambda rows: 2 * math.ceil(total / rows) + 1
    parts = min(ranges(rows_per_window), max(MAX_RANGES, ranges(ROWS_PER_WINDOW)))
    # ranges of any type, over groups and values together, so a large group takes several and a null group is one of them
    ranged = cut(df.repartitionByRange(parts, *[F.col(c) for c in by], sort).withColumn("_range", F.spark_partition_id()))
    totals = ranged.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    # one row per group and range
    before = Window.partitionBy(*by).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *by, "_range", *[F.coalesce(F.sum(f"_t_{c}").over(before), F.lit(0)).alias(f"_o_{c}") for c in sums]
    )
    w = Window.partitionBy(*by, "_range").orderBy(sort).rowsBetween(Window.unboundedPreceding, 0)
    within = ranged.select("*", *[F.sum(c).over(w).alias(f"_w_{c}") for c in sums])
    return null_safe_join(within, offsets, [*by, "_range"]).select(
        *df.columns, *[(F.col(f"_w_{c}") + F.col(f"_o_{c}")).alias(f"cum_{c}") for c in sums]
    )


def exact_quantiles(
    df: DataFrame,
    columns: Sequence[str],
    qs: Sequence[float],
    by: str | None = None,
    *,
    small: int = SMALL_GROUP,
    accuracy: int = ACCURACY,
    rows_per_window: int = ROWS_PER_WINDOW,
) -> dict[tuple, list]:
    """``{(group, column): [value per q]}`` with linear interpolation; nulls are skipped.

    Groups up to ``small`` rows use the built-in exact percentile. Larger ones are
    bracketed by an approximate percentile first, and only values inside the
    brackets are counted and ranked.
    """
    by_cols = [by] if by else []
    slack = 4.0 / accuracy  # wider than the approximation error plus two ranks
    small = max(small, accuracy)  # below, the brackets would not be narrower than the column
    probes = [p for q in qs for p in (max(0.0, q - slack), min(1.0, q + slack))]
    first = df.groupBy(*by_cols).agg(
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(columns)],
        *[F.percentile_approx(c, probes, accuracy).alias(f"b_{i}") for i, c in enumerate(columns)],
    ).collect()
    group_of = (lambda r: r[by]) if by else (lambda r: None)
    if max((r[f"n_{i}"] for r in first for i in range(len(columns))), default=0) <= small:
        rows = df.groupBy(*by_cols).agg(
            *[F.percentile(c, list(qs)).alias(f"p_{i}") for i, c in enumerate(columns)]
        ).collect()
        return {
            (group_of(r), c): list(r[f"p_{i}"]) if r[f"p_{i}"] is not None else [None] * len(qs)
            for r in rows for i, c in enumerate(columns)
        }

    result: dict[tuple, list] = {}
    brackets, ranks = [], {}
    for r in first:
        for i, c in enumerate(columns):
            n = r[f"n_{i}"]
            result[(group_of(r), c)] = [None] * len(qs)
            if not n:
                continue
            for j, q in enumerate(qs):
                brackets.append((group_of(r), c, j, float(r[f"b_{i}"][2 * j]), float(r[f"b_{i}"][2 * j + 1])))
                ranks[(group_of(r), c, j)] = (n - 1) * q
    group_type = df.schema[by].dataType.simpleString() if by else "string"
    spark = df.sparkSession
    ranges = side_table(spark, brackets, f"g {group_type}, c string, j int, lo double, hi double")
    melted = df.select(
        (F.col(by) if by else F.lit(None).cast("string")).alias("g"),
        F.explode(F.array(*[F.struct(F.lit(c).alias("c"), F.col(c).cast("double").alias("x")) for c in columns])).alias("m"),
    ).select("g", "m.c", "m.x").filter("x IS NOT NULL")
    on = F.expr("a.c = b.c AND a.g <=> b.g")
    counted = (
        melted.alias("a").join(ranges.alias("b"), on).filter("x <= hi")
        .select("b.g", "b.c", "b.j", F.expr("CASE WHEN x >= lo THEN x END").alias("x"))
        .groupBy("g", "c", "j", "x").agg(F.count(F.lit(1)).alias("n"))
    )
    placed = running_sums(counted, ["g", "c", "j"], "x", ["n"], rows_per_window=rows_per_window)
    wanted = side_table(spark,
        [(g, c, j, math.floor(h), math.floor(h) + 1) for (g, c, j), h in ranks.items()],
        f"g {group_type}, c string, j int, r0 bigint, r1 bigint",
    )
    at = lambda r: F.max(F.expr(f"CASE WHEN cum_n - n <= {r} AND {r} < cum_n THEN x END"))
    hits = (
        placed.alias("a")
        .join(wanted.alias("b"), F.expr("a.c = b.c AND a.j = b.j AND a.g <=> b.g"))
        .groupBy("b.g", "b.c", "b.j").agg(at("r0").alias("v0"), at("r1").alias("v1")).collect()
    )
    for r in hits:
        h = ranks[(r["g"], r["c"], r["j"])]
        v0 = r["v0"]
        v1 = r["v1"] if r["v1"] is not None else v0
        result[(r["g"], r["c"])][r["j"]] = v0 + (v1 - v0) * (h - math.floor(h))
    return result


def key_cuts(df: DataFrame, key: str, wanted: dict, by: str | None = None, *, bits: int, small: int = 100_000) -> dict:
    """Per group the ``n``-th smallest integer key, for ``wanted = {group: n}``.

    Each pass histograms 12 more bits of the key, so a group is never sorted as a
    whole; the last step ranks only the keys of one narrow bucket per group.
    """
    group = F.col(by) if by else F.lit(0)
    frame = df.select(group.alias("g"), F.col(key).alias("k"))
    cuts = {g: -1 for g, n in wanted.items() if n <= 0}
    state = {g: (0, n) for g, n in wanted.items() if n > 0}  # group -> (prefix, rank inside it)
    shift = bits
    spark = df.sparkSession
    group_type = df.schema[by].dataType.simpleString() if by else "int"
    while state:
        prefixes = side_table(spark, [(g, p) for g, (p, _) in state.items()], f"g {group_type}, p bigint")
        inside = null_safe_join(frame, prefixes, ["g"]).filter(F.shiftright("k", shift) == F.col("p"))
        step = max(0, shift - 12)
        hist = inside.groupBy("g", F.shiftright("k", step).alias("b")).count().collect()
        per_group: dict = {}
        for r in hist:
            per_group.setdefault(r["g"], []).append((r["b"], r["count"]))
        ready, nxt = [], {}
        for g, (_, n) in state.items():
            seen, found = 0, None
            for b, c in sorted(per_group.get(g, [])):
                if seen + c >= n:
                    found = (b, n - seen, c)
                    break
                seen += c
            if found is None:
                cuts[g] = (1 << bits)  # fewer rows than asked for: keep them all
            elif step == 0:
                cuts[g] = found[0]
            elif found[2] <= small:
                ready.append((g, found[0], found[1]))
            else:
                nxt[g] = (found[0], found[1])
        if ready:
            buckets = side_table(spark, ready, f"g {group_type}, p bigint, n bigint")
            w = Window.partitionBy("g").orderBy("k")
            picked = (
                null_safe_join(frame, buckets, ["g"]).filter(F.shiftright("k", step) == F.col("p"))
                .withColumn("rn", F.row_number().over(w)).filter("rn = n").collect()
            )
            cuts.update({r["g"]: r["k"] for r in picked})
        state, shift = nxt, step
    return cuts
