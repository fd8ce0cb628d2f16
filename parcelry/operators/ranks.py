"""Rows chosen by exact rank, without ordering the table.

The order is a whole number drawn from each row's key, ties by the key. The
wanted ranks are narrowed down by histograms of its leading bits: each pass
counts only the bins that a wanted rank lies in, combines on the map side and
leaves at most BINS numbers for each rank, so a few passes over the key columns
find the order number of every rank. Rows that share it are told apart by
their keys: few of them are ordered on the driver, many by a range-dealt table.
"""

import math

from pyspark.sql import functions as F

from parcelry.session import written

#: Bits of the order number, and those that one pass looks at.
BITS, STEP = 40, 12
#: Rows with one order number that are ordered on the driver.
FEW = 4096


def order_number(unit):
    """A number in [0, 1) as a whole number of BITS bits."""
    return F.floor(unit * F.lit(float(1 << BITS))).cast("long")


class Threshold:
    """The place of a row in the order: its number and its key."""

    def __init__(self, number, key):
        self.number, self.key = number, key

    def reached(self, number, keys, schema):
        """Whether a row stands at this place or before it."""
        if self.key is None:
            return F.lit(self.number >= 0)
        own = F.struct(*[F.col(f"`{k}`").alias(f"k{i}") for i, k in enumerate(keys)])
        mine = F.struct(*[F.lit(v).cast(schema[k].dataType).alias(f"k{i}") for i, (k, v) in enumerate(zip(keys, self.key))])
        return (number < self.number) | ((number == self.number) & (own <= mine))


def thresholds(df, unit, keys, ranks):
    """(rows, {rank: Threshold}): the row that has each of ``ranks`` (from 1) in the order of ``unit`` and ``keys``.

    Rank 0 is before all rows; ranks above the number of rows are at the last one. A missing unit or key comes first.
    """
    number = F.coalesce(order_number(unit), F.lit(0).cast("long"))
    rows = df.select(number.alias("__number"), *[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)])
    found, open_, total, shift = {0: Threshold(-1, None)}, None, None, BITS
    while shift > 0:
        shift = max(shift - STEP, 0)
        counted = rows if open_ is None else rows.where((F.shiftright("__number", shift + STEP_OF[shift])).isin(sorted(open_)))
        bins = counted.groupBy(F.shiftright("__number", shift).alias("bin")).count().collect()
        bins = sorted((r["bin"], r["count"]) for r in bins)
        if open_ is None:
            total = sum(n for _, n in bins)
            if not total:
                return 0, {r: found[0] for r in ranks}
            # prefix of the bins so far: {prefix: [(rank left within it, rank)]}
            wanted = sorted({min(r, total) for r in ranks} - {0})
            open_ = {0: [(r, r) for r in wanted]}
        inner = {}
        for prefix, held in open_.items():
            before, own = 0, [(b, n) for b, n in bins if b >> STEP_OF[shift] == prefix]
            held = sorted(held)
            for b, n in own:
                while held and held[0][0] <= before + n:
                    left, rank = held.pop(0)
                    inner.setdefault(b, []).append((left - before, rank))
                before += n
        open_ = inner
    sizes = {r["__number"]: r["count"] for r in rows.where(F.col("__number").isin(sorted(open_))).groupBy("__number").count().collect()} if open_ else {}
    for value, held in open_.items():
        tied = rows.where(F.col("__number") == value).drop("__number")
        for (left, rank), key in zip(sorted(held), _keys_at(tied, [left for left, _ in sorted(held)], sizes[value])):
            found[rank] = Threshold(value, key)
    return total, {r: found[min(r, total)] for r in ranks}


#: Bits that the pass that ends at a shift has looked at.
STEP_OF = {}
_shift = BITS
while _shift > 0:
    STEP_OF[max(_shift - STEP, 0)] = min(STEP, _shift)
    _shift = max(_shift - STEP, 0)


def _keys_at(tied, places, size):
    """The keys at ``places`` (from 1, ascending) of the ordered rows of ``tied``."""
    order = [F.col(c).asc_nulls_first() for c in tied.columns]
    if size <= FEW:
        rows = tied.orderBy(*order).collect()
        return [tuple(rows[p - 1]) for p in places]
    dealt = written(tied.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__part", F.spark_partition_id()), "tied")
    parts, out, before = sorted((r["__part"], r["count"]) for r in dealt.groupBy("__part").count().collect()), [], 0
    for part, n in parts:
        while len(out) < len(places) and places[len(out)] <= before + n:
            own = dealt.where(F.col("__part") == part).drop("__part").orderBy(*order).limit(places[len(out)] - before)
            last = own.orderBy(*[F.col(c).desc_nulls_last() for c in tied.columns]).first()
            out.append(tuple(last))
        before += n
    return out


def with_order_class(df, unit, keys, sizes_of, name):
    """``df`` with the number of the class that a row's rank falls into.

    ``sizes_of(n)`` gives the sizes of the classes in order, for n rows. Keys that stand for one row each give classes of
    exactly these sizes; rows that share a key stay together.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    n = df.count()
    ends = [sum(sizes_of(n)[: k + 1]) for k in range(len(sizes_of(n)) - 1)]
    _, at = thresholds(df, unit, keys, ends)
    number = F.coalesce(order_number(unit), F.lit(0).cast("long"))
    passed = [(~at[e].reached(number, keys, df.schema)).cast("int") for e in ends]
    return df.withColumn(name, sum(passed, F.lit(0)))


def exact_sample(df, unit, keys, fraction):
    """The share ``fraction`` of the rows, rounded to a whole number of them: those that come first in the order."""
    return with_order_class(df, unit, keys, lambda n: [round(fraction * n), n - round(fraction * n)], "__class").where("__class = 0").drop("__class")


def exact_split(df, unit, keys, test_size=0.2):
    """(train, test), the test part of exactly the share ``test_size`` of the rows, rounded up."""
    part = lambda n: min(n, math.ceil(round(test_size * n, 9)))
    marked = with_order_class(df, unit, keys, lambda n: [part(n), n - part(n)], "__class")
    return marked.where("__class = 1").drop("__class"), marked.where("__class = 0").drop("__class")


def exact_folds(df, unit, keys, folds=5, name="fold"):
    """Fold numbers whose counts differ by at most one, the first folds having the one more."""
    return with_order_class(df, unit, keys, lambda n: [n // folds + (k < n % folds) for k in range(folds)], name)
