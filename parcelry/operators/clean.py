"""Cleaning: projections, row filters, missing values, duplicates, dates."""

import re
from functools import reduce

from pyspark.sql import functions as F, types as T

from parcelry.functions.scalar import non_negative, strip
from parcelry.operators.quantiles import column_quantiles
from parcelry.schema import NON_MEASURES, numeric_columns, require_columns, string_columns
from parcelry.sources.files import write_table

FILL_METHODS = ("zero", "mean", "median", "mode")


def strip_strings(df):
    """Trim white space in every string column."""
    return df.withColumns({c: strip(F.col(f"`{c}`")) for c in string_columns(df)})


def mask_negatives(df, exclude=NON_MEASURES):
    """Negative measurements become NULL."""
    return df.withColumns({c: non_negative(F.col(f"`{c}`")) for c in numeric_columns(df, exclude)})


def split_column(df, column, names, sep=", "):
    """Split on every ``sep``; missing parts are NULL, more parts than names is an error."""
    require_columns(df, [column])
    literal = "\\Q" + sep + "\\E"
    parts = F.split(F.col(f"`{column}`"), literal)
    checked = F.when(
        F.size(parts) > len(names),
        F.raise_error(F.lit(f"{column} splits into more than {len(names)} parts")).cast("array<string>"),
    ).otherwise(parts)
    return df.withColumns({name: F.get(checked, F.lit(i)) for i, name in enumerate(names)})


def missing_count(columns):
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in columns])


def drop_all_missing(df, columns):
    return df.dropna(how="all", subset=list(columns))


def drop_sparse_where_missing(df, lead, columns, limit=2):
    """Drop a row if ``lead`` is missing and so are at least ``limit`` of ``columns``."""
    return df.filter(~(F.col(lead).isNull() & (missing_count(columns) >= limit)))


def cap_at_quantiles(df, caps):
    """Keep rows not above the column quantiles in ``caps`` ({column: p}); NULLs stay."""
    probs = sorted(set(caps.values()))
    found = column_quantiles(df, list(caps), probs)
    cuts = {c: found[c][probs.index(p)] for c, p in caps.items()}
    return df.filter(reduce(lambda a, b: a & b, [(F.col(c) <= cut) | F.col(c).isNull() for c, cut in cuts.items()]))


def add_missing_flags(df, columns):
    return df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in columns})


# Codes of percent formats and the patterns they stand for, with two digits and with one or two.
DATE_CODES = {"Y": ("yyyy", "yyyy"), "y": ("yy", "yy"), "m": ("MM", "M"), "d": ("dd", "d"), "H": ("HH", "H"), "I": ("hh", "h"), "M": ("mm", "m"), "S": ("ss", "s"), "p": ("a", "a"), "b": ("MMM", "MMM"), "B": ("MMMM", "MMMM"), "j": ("DDD", "D"), "f": ("SSSSSS", "SSSSSS")}


def date_pattern(fmt):
    """A percent format such as ``%Y-%m-%d`` as a pattern; a pattern is returned as it is.

    Numbers may have one digit less where nothing but a separator stands beside them. Two-digit years are of this century.
    """
    if "%" not in fmt:
        return fmt
    pieces = re.findall(r"%.|[^%]+", fmt, re.DOTALL)
    out = []
    for k, piece in enumerate(pieces):
        if piece[0] != "%" or piece == "%%":
            text = "%" if piece == "%%" else piece
            out.append("".join("''" if c == "'" else f"'{c}'" if c.isalpha() else c for c in text))
            continue
        if piece[1] not in DATE_CODES:
            raise ValueError(f"date format code {piece} is not supported")
        beside = [p for p in pieces[max(k - 1, 0) : k + 2] if p is not piece and p[0] == "%" and p != "%%"]
        out.append(DATE_CODES[piece[1]][0 if beside else 1])
    return "".join(out)


def parse_dates(df, column, fmt="%Y-%m-%d"):
    """Text to timestamp by a percent format or a pattern; what does not fit it becomes NULL."""
    require_columns(df, [column])
    fmt = date_pattern(fmt)
    return df.withColumn(column, F.try_to_timestamp(F.col(column), F.lit(fmt)).cast("timestamp_ntz"))


def modes(df, columns):
    """{column: most frequent value, the smallest on ties}, by counting rather than by collecting groups."""
    found = {}
    for c in columns:
        top = df.filter(F.col(c).isNotNull()).groupBy(c).count().orderBy(F.desc("count"), F.asc(c)).limit(1).collect()
        found[c] = top[0][0] if top else None
    return found


def fill_values(df, method, columns=None):
    """The value each column with missing cells is to be filled with."""
    if method not in FILL_METHODS:
        raise ValueError(f"unknown fill method {method!r}: use one of {', '.join(FILL_METHODS)}")
    columns = list(columns or df.columns)
    require_columns(df, columns)
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in columns if isinstance(types[c], T.NumericType)]
    wanted = [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]
    if method == "mean":
        wanted += [F.avg(c).alias(f"m{i}") for i, c in enumerate(columns) if c in numeric]
    stats = df.agg(*wanted).first().asDict()
    gaps = [c for i, c in enumerate(columns) if stats[f"n{i}"]]
    if method in ("mean", "median"):
        wrong = [c for c in gaps if c not in numeric]
        if wrong:
            raise TypeError(f"{method} needs numeric columns, not {wrong}")
    if method == "zero":
        return {c: 0 for c in gaps}
    if method == "mean":
        return {c: stats[f"m{columns.index(c)}"] for c in gaps}
    if method == "median":
        return {c: q[0] for c, q in column_quantiles(df, gaps, [0.5]).items()} if gaps else {}
    return modes(df, gaps)


def fill_missing(df, method, columns=None):
    """Fill with zero, mean, median or mode; integers become doubles where the fill is fractional."""
    types = {f.name: f.dataType for f in df.schema.fields}
    filled = {}
    for c, v in fill_values(df, method, columns).items():
        if v is None:
            continue
        if method in ("mean", "median"):
            filled[c] = F.coalesce(F.col(c).cast("double"), F.lit(float(v)))
        else:
            filled[c] = F.coalesce(F.col(c), F.lit(v).cast(types[c]))
    return df.withColumns(filled) if filled else df


def drop_duplicate_rows(df):
    """Distinct rows; NULLs count as equal."""
    return df.dropDuplicates()


def duplicate_rows(df, name="duplicates"):
    """Number of rows beyond the first of each group of equal rows."""
    return df.groupBy(*[F.col(f"`{c}`") for c in df.columns]).agg(F.count(F.lit(1)).alias("__n")).agg(
        F.coalesce(F.sum(F.col("__n") - 1), F.lit(0)).cast("bigint").alias(name)
    )


class DataCleaner:
    """Chained cleaning of one table; every method returns the cleaner."""

    def __init__(self, df, interim_dir=None):
        self.df = df
        self.interim_dir = interim_dir
        self.dropped = None

    def format_dates(self, column, date_format="%Y-%m-%d"):
        self.df = parse_dates(self.df, column, date_format)
        return self

    def drop_duplicates(self):
        """``dropped`` then is a table of one number, how many rows went; it is counted when it is read."""
        self.dropped = duplicate_rows(self.df, "dropped")
        self.df = drop_duplicate_rows(self.df)
        return self

    def dropped_rows(self):
        """How many rows the last ``drop_duplicates`` took away."""
        return 0 if self.dropped is None else self.dropped.first()[0]

    def handle_nan(self, method, columns=None):
        self.df = fill_missing(self.df, method, columns)
        return self

    def split_composite_columns(self, column, new_columns, sep=", "):
        self.df = split_column(self.df, column, new_columns, sep)
        return self

    def strip_spaces(self):
        self.df = strip_strings(self.df)
        return self

    def export(self, filename, format="csv"):
        """Write the table below the interim folder and return its path."""
        if self.interim_dir is None:
            raise ValueError("the cleaner was built without an interim folder")
        return write_table(self.df, f"{self.interim_dir.rstrip('/')}/{filename}", format)

    def get_cleaned_data(self):
        return self.df
