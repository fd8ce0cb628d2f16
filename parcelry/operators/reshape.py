"""Top-k, sampling, splits, resampling and reshaping."""

import math

from pyspark.sql import functions as F

_SPACE = 1_000_000
#: Bits of the unit that resampling draws; Poisson counts go as far as it can tell apart.
UNIT_BITS = 40


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def column_rows(df, columns, name, value):
    """Wide to long: one row per column of ``columns``, other columns dropped."""
    cells = [F.struct(F.lit(c).alias(name), F.col(f"`{c}`").alias(value)) for c in columns]
    return df.select(F.inline(F.array(*cells)))


def melt(df, id_columns, value_columns, name="variable", value="value"):
    return df.unpivot(_keys(id_columns), _keys(value_columns), name, value)


def top_k(df, keys, k):
    """The k most frequent values; ties by value."""
    keys = _keys(keys)
    return df.dropna(subset=keys).groupBy(*keys).count().orderBy(F.desc("count"), *keys).limit(k)


def random_k(df, keys, k, seed=42):
    """k rows in the order of a seeded hash of their key: the same rows under any partitioning."""
    keys = _keys(keys)
    return df.orderBy(F.xxhash64(*keys, F.lit(seed)), *keys).limit(k)


def hash_unit(keys, seed=42):
    """A number in [0, 1) fixed by the key and the seed."""
    return F.pmod(F.xxhash64(*_keys(keys), F.lit(seed)), F.lit(_SPACE)) / F.lit(_SPACE)


def sample_fraction(df, keys, fraction, seed=42):
    """Rows whose key hashes below the fraction; repeated runs give the same rows."""
    return df.filter(hash_unit(keys, seed) < fraction)


def id_unit(ident, seed=42):
    """Like ``hash_unit`` for whole-number ids, by plain arithmetic: congruences with shifted bits in between, the seed in each.

    Without the shifts, another seed would only add a constant to every unit.
    """
    state = F.pmod(F.col(ident), F.lit(1 << 31))
    for multiplier, shift in UNIT_STEPS:
        state = F.pmod(state * F.lit(multiplier) + F.lit(unit_offset(seed, multiplier)), F.lit(1 << 31))
        state = state.bitwiseXOR(F.shiftright(state, shift))
    return F.shiftright(state, 7) / F.lit(1 << 24)


UNIT_STEPS = ((1103515245, 15), (739982445, 12), (1540483477, 14))


def unit_offset(seed, multiplier):
    return (seed * 2654435761 + 1) * multiplier % (1 << 31)


def id_unit_sql(ident, seed=42):
    """The same number in SQL."""
    state = f"({ident} % {1 << 31})"
    for multiplier, shift in UNIT_STEPS:
        state = f"(({state} * {multiplier} + {unit_offset(seed, multiplier)}) % {1 << 31})"
        state = f"xor({state}, {state} >> {shift})"
    return f"(({state} >> 7) / {1 << 24})"


def train_test_split(df, unit, test_size=0.2):
    """(train, test): rows whose unit number is below ``test_size`` go to the test part."""
    return df.filter(unit >= test_size), df.filter(unit < test_size)


def with_fold(df, unit, folds=5, name="fold"):
    return df.withColumn(name, F.floor(unit * folds).cast("int"))


def poisson_one(unit):
    """Poisson(1) count of a uniform number: how often a row is drawn when resampling with replacement."""
    count, step, below, k = F.lit(0), math.exp(-1), 0.0, 0
    while below + step <= 1 - 2.0**-UNIT_BITS:
        below += step
        count = count + (unit >= below).cast("int")
        k += 1
        step /= k
    return count


def bootstrap_weights(df, keys, replicates, seed=42, name="replicate", weight="weight"):
    """One row per drawn (row, replicate) with its multiplicity.

    Meant to feed an aggregation by replicate directly, which combines on the
    map side, so the expanded rows are never shuffled.
    """
    expanded = df.withColumn("__h", F.xxhash64(*_keys(keys), F.lit(seed))).withColumn(name, F.explode(F.sequence(F.lit(0), F.lit(replicates - 1))))
    unit = F.pmod(F.xxhash64("__h", name), F.lit(1 << UNIT_BITS)) / F.lit(float(1 << UNIT_BITS))
    return expanded.withColumn(weight, poisson_one(unit)).filter(F.col(weight) > 0).drop("__h")
