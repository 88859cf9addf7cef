"""History look-ups along the time line of a key, linear in the rows for a key of any length.

One key (a user, a device) may hold a large share of all rows, and a window partitioned by it
would be a single endless task. The ``sliced_*`` functions handle every key alike:

* rows are first reduced to one row per (key, instant), which partial aggregation does
  before the shuffle, so copies of one instant never meet in one task;
* instants are grouped by (key, minute) and scanned inside the minute;
* each minute's summary is carried to the later minutes by a window over minutes, of which
  a key has as many as the data has, however many rows there are.

Results are keyed by (key, instant) and joined back on both, which spreads a frequent key.
Rows without a key get one of their own (``own_key``), so they have no history.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from risklake.functions.scalars import MICROS

NOW = Window.currentRow
START = Window.unboundedPreceding
SLICE_US = 60 * MICROS
# Sums of money are exact, so they do not depend on the order of adding. With six decimals
# Spark keeps the scale through sums and differences of this type.
MONEY = "decimal(38,6)"


def own_key(column: str) -> Column:
    """The value as a key; for a row without one, a key that no other transaction has."""
    return F.coalesce(
        F.concat(F.lit("k:"), F.col(column)), F.concat(F.lit("t:"), F.col("transaction_id"))
    )


def slice_start(us: Column) -> Column:
    return us - F.pmod(us, F.lit(SLICE_US))


def sliced(
    entries: DataFrame, keys: Sequence[str], sums: Sequence[str] = (), lasts: Sequence[str] = (), inclusive: bool = False,
) -> DataFrame:
    """Per (key, instant) that asks: sum of each of ``sums`` and greatest of each of ``lasts`` over earlier
    instants; of ``lasts`` also over the instant itself, if ``inclusive``.

    ``entries`` has a boolean ``_asks``, false on rows that only contribute. ``lasts`` are orderable structs that
    start with the instant, NULL on rows that have none. All that is asked of one time line goes through here at
    once: rows are reduced and moved as often for many values as for one.
    """
    at = entries.withColumn("_slice", slice_start(F.col("_us")))
    merged = [F.sum(m).alias(m) for m in sums] + [F.max(v).alias(v) for v in lasts]
    instants = at.groupBy(*keys, "_slice", "_us").agg(F.max("_asks").alias("_asks"), *merged)
    inside = Window.partitionBy(*keys, "_slice").orderBy("_us")
    before, seen = inside.rowsBetween(START, -1), inside.rowsBetween(START, NOW if inclusive else -1)
    across = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(START, -1)
    # A slice that doesn't ask has done its part once it is summed up; it need not move to where it would be looked up.
    carried = at.groupBy(*keys, "_slice").agg(F.max("_asks").alias("_asks"), *merged).select(
        *keys, "_slice", "_asks",
        *[F.sum(m).over(across).alias(f"_carry_{m}") for m in sums],
        *[F.max(v).over(across).alias(f"_carry_{v}") for v in lasts],
    ).filter("_asks").drop("_asks")
    scanned = instants.select(
        *keys, "_us", "_slice", "_asks", *[F.sum(m).over(before).alias(m) for m in sums], *[F.max(v).over(seen).alias(v) for v in lasts],
    ).filter("_asks")
    return scanned.join(carried, [*keys, "_slice"], "left").select(
        *keys,
        "_us",
        *[(F.coalesce(F.col(m), F.lit(0)) + F.coalesce(F.col(f"_carry_{m}"), F.lit(0))).alias(m) for m in sums],
        *[F.coalesce(v, f"_carry_{v}").alias(v) for v in lasts],
    )


def sliced_last(entries: DataFrame, keys: Sequence[str], value: str, inclusive: bool) -> DataFrame:
    """``sliced`` for one of ``lasts`` and entries that all ask."""
    return sliced(entries.withColumn("_asks", F.lit(True)), keys, lasts=(value,), inclusive=inclusive)


def trailing_entries(
    rows: DataFrame, keys: Sequence[str], measures: Sequence[str], windows: dict[str, int], also: Sequence[str] = (),
) -> DataFrame:
    """Entries whose sums over earlier instants are sums over trailing windows, ``<measure>_<window>``.

    A row adds its amounts to each window at once and takes them out again when the window has passed, so a
    trailing sum is a running sum of entries and exits. Columns ``also`` stay with the row itself.
    """

    def signed(m: str, by: int) -> Column:
        # No product: it would change the type of a decimal.
        zero = F.lit(0).cast(rows.schema[m].dataType)
        return {1: F.col(m), -1: -F.col(m), 0: zero}[by]

    def step(shift_us: int, sign: Callable[[str], int]) -> Column:
        here = shift_us == 0
        return F.struct(
            (F.col("_us") + F.lit(shift_us)).alias("_us"),
            F.lit(here).alias("_asks"),
            *[signed(m, sign(w)).alias(f"{m}_{w}") for w in windows for m in measures],
            *[(F.col(c) if here else F.lit(None).cast(rows.schema[c].dataType)).alias(c) for c in also],
        )

    steps = [step(0, lambda w: 1)]
    for name, seconds in windows.items():
        steps.append(step(seconds * MICROS, lambda w, name=name: -1 if w == name else 0))
    return rows.select(*keys, F.inline(F.array(*steps)))


def sliced_trailing(
    rows: DataFrame,
    keys: Sequence[str],
    measures: Sequence[str],
    windows: dict[str, int],
) -> DataFrame:
    """Per (key, instant): sums over trailing windows, as ``<measure>_<window>``."""
    return sliced(trailing_entries(rows, keys, measures, windows), keys, [f"{m}_{w}" for w in windows for m in measures])
