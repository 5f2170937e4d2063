"""Feature preparation: imputation, encoding, scaling, splits, outlier rules.

Every step is ``fit(train_df) -> params`` (one aggregate pass; the params
are d numbers or a category list, never row-sized) and
``params.transform(df) -> df`` (pure column expressions, no join, no
shuffle).  Fit on the training split only, so no test row leaks in.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeline.functions.exprs import md5_unit, present
from lakeline.operators.keys import exact_quantiles, ordinal
from lakeline.operators.profile import numeric_columns, text_columns
from lakeline.functions import fixed
from lakeline.session import stored


def _round(c: Column, digits: int | None) -> Column:
    return c if digits is None else F.round(c, digits)


# --- imputation -----------------------------------------------------------

@dataclass
class Fill:
    values: dict

    def transform(self, df: DataFrame) -> DataFrame:
        kinds = dict(df.dtypes)
        known = {c: present(c) if kinds[c] in ("double", "float") else F.col(c) for c in self.values}
        return df.withColumns({c: F.coalesce(known[c], F.lit(v)) for c, v in self.values.items() if v is not None})


def fit_median(df: DataFrame, columns: list[str]) -> Fill:
    """Exact medians (interpolated, as pandas / scikit-learn), distributed."""
    q = exact_quantiles(df, columns, [0.5]).collect()  # one row per column
    got = {r["column"]: r["value"] for r in q}
    return Fill({c: got.get(c) for c in columns})


def fit_mode(df: DataFrame, columns: list[str]) -> Fill:
    """Most frequent non-null value per column; ties go to the smallest value."""
    values = {}
    for c in columns:
        top = (df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias("n"))
               .orderBy(F.desc("n"), F.asc(c)).first())
        values[c] = None if top is None else top[c]
    return Fill(values)


# --- encoding -----------------------------------------------------------

def categories(df: DataFrame, column: str) -> list:
    """Sorted distinct non-null values: one for each column that dummies or
    one-hot encoding will make, so no longer than the result is wide."""
    return [r[0] for r in df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column).collect()]


def _counts(df: DataFrame, column: str) -> dict:
    """Rows of each non-null value, in value order: as many as one-hot columns."""
    found = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n")).orderBy(column).collect()
    return {r[0]: r[1] for r in found}


@dataclass
class Ordinal:
    column: str
    codes: DataFrame  # (value, code)

    def transform(self, df: DataFrame, out: str | None = None) -> DataFrame:
        name = out or self.column
        codes = self.codes.select(F.col("value").alias("__value"), F.col("code").alias("__code"))
        joined = df.join(codes, F.col(self.column) == F.col("__value"), "left")
        return joined.withColumn(name, F.col("__code")).drop("__value", "__code")


def fit_ordinal(df: DataFrame, column: str) -> Ordinal:
    """Codes from 0 in value order, as a table that is joined back: any number
    of categories; an unseen or NULL value has no code.  The table is stored, so
    plans know its size (not guess that of the rows it was made from): few codes
    are broadcast, and no row moves to the task of its value."""
    values = df.select(F.col(column).alias("value")).filter("value IS NOT NULL").distinct()
    codes = ordinal(values, [F.col("value")], None, "n").select("value", (F.col("n") - 1).cast("int").alias("code"))
    return Ordinal(column, stored(codes, "ordinal-codes"))


@dataclass
class OneHot:
    column: str
    categories: list
    drop_first: bool = False
    prefix: str = ""
    as_bool: bool = False

    def names(self) -> list[str]:
        cats = self.categories[1:] if self.drop_first else self.categories
        return [f"{self.prefix}{self.column}_{v}" for v in cats]

    def transform(self, df: DataFrame, keep_source: bool = False) -> DataFrame:
        cats = self.categories[1:] if self.drop_first else self.categories
        cols = {}
        for v, name in zip(cats, self.names()):
            hit = F.coalesce(F.col(self.column) == F.lit(v), F.lit(False))  # NULL / unknown -> all false
            cols[name] = hit if self.as_bool else hit.cast("double")
        out = df.withColumns(cols)
        return out if keep_source else out.drop(self.column)


def fit_dummies(df: DataFrame, column: str) -> OneHot:
    """Boolean dummy columns, first category dropped."""
    return OneHot(column, categories(df, column), drop_first=True, as_bool=True)


def fit_onehot(df: DataFrame, column: str, prefix: str = "") -> OneHot:
    """0/1 columns for every training category; an unseen value is all zeros."""
    return OneHot(column, categories(df, column), prefix=prefix)


@dataclass
class Sparse:
    """One-hot as one sparse column: (size, indices, values), the fields of a
    sparse vector.  ``codes``: (value, code), a table."""
    column: str
    codes: DataFrame
    size: int

    def transform(self, df: DataFrame, out: str) -> DataFrame:
        codes = self.codes.select(F.col("value").alias("__value"), F.col("code").alias("__code"))
        joined = df.join(codes, F.col(self.column) == F.col("__value"), "left")
        hit = F.col("__code").isNotNull()
        none = F.array()
        vector = F.struct(F.lit(self.size).alias("size"), F.when(hit, F.array("__code")).otherwise(none.cast("array<int>")).alias("indices"),
                          F.when(hit, F.array(F.lit(1.0))).otherwise(none.cast("array<double>")).alias("values"))
        return joined.withColumn(out, vector).drop("__value", "__code")


def fit_sparse(df: DataFrame, column: str) -> Sparse:
    """One-hot for any number of categories: they are numbered and joined back
    as a table, none is collected; an unseen or NULL value is the empty vector."""
    codes = fit_ordinal(df, column).codes
    return Sparse(column, codes, codes.agg(F.coalesce(F.max("code") + 1, F.lit(0))).first()[0])


# --- scaling --------------------------------------------------------------

@dataclass
class Affine:
    """x -> (x - shift) * factor + offset per column."""
    params: dict  # column -> (shift, factor, offset)
    digits: int | None = None
    prefix: str = ""

    def transform(self, df: DataFrame) -> DataFrame:
        cols = {}
        for c, (shift, factor, offset) in self.params.items():
            cols[self.prefix + c] = _round((F.col(c) - F.lit(shift)) * F.lit(factor) + F.lit(offset), self.digits)
        out = df.withColumns(cols)
        if self.prefix:
            out = out.drop(*self.params)
        return out


def fit_minmax(df: DataFrame, columns: list[str], lo: float = fixed.MINMAX_RANGE[0], hi: float = fixed.MINMAX_RANGE[1],
               digits: int | None = None) -> Affine:
    """Scale to [lo, hi]; a constant column maps to ``lo``."""
    row = df.agg(*[F.min(present(c)).alias(f"{c}|min") for c in columns], *[F.max(present(c)).alias(f"{c}|max") for c in columns]).first()
    params = {}
    for c in columns:
        mn, mx = row[f"{c}|min"], row[f"{c}|max"]
        rng = (mx - mn) if (mn is not None and mx != mn) else 1.0
        params[c] = (mn if mn is not None else 0.0, (hi - lo) / rng, lo)
    return Affine(params, digits)


def fit_standard(df: DataFrame, columns: list[str], digits: int | None = None) -> Affine:
    """Mean 0, *population* deviation 1; a constant column gets factor 1."""
    row = df.agg(*[F.avg(present(c)).alias(f"{c}|mean") for c in columns],
                 *[F.stddev_pop(present(c)).alias(f"{c}|std") for c in columns]).first()
    params = {}
    for c in columns:
        mean, std = row[f"{c}|mean"], row[f"{c}|std"]
        params[c] = (mean if mean is not None else 0.0, 1.0 / std if std else 1.0, 0.0)
    return Affine(params, digits)


@dataclass
class Steps:
    """A fitted sequence of steps (impute, then scale, ...)."""
    steps: list = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        for s in self.steps:
            df = s.transform(df)
        return df


def fit_numeric(df: DataFrame, columns: list[str], digits: int | None = None) -> Steps:
    """Median imputation, then standardisation (fit on the imputed frame)."""
    imp = fit_median(df, columns)
    scale = fit_standard(imp.transform(df), columns, digits)
    return Steps([imp, scale])


def fit_mixed(df: DataFrame, leave: list[str], digits: int | None = None) -> Steps:
    """Column groups by type: numbers imputed + scaled as ``num__``, text
    imputed by mode + one-hot encoded as ``cat__``.  ``leave``: keys and labels
    that are no features; columns of other types stay as they are."""
    rest = df.drop(*leave)
    numeric, categorical = numeric_columns(rest), text_columns(rest)
    imp_n = fit_median(df, numeric)
    x = imp_n.transform(df)
    scale = fit_standard(x, numeric, digits)
    scale.prefix = "num__"
    # One count of its values gives a text column's mode and its categories.
    counts = {c: _counts(x, c) for c in categorical}
    imp_c = Fill({c: max(n, key=n.get) if n else None for c, n in counts.items()})
    encs = [OneHot(c, list(n), prefix="cat__") for c, n in counts.items()]
    return Steps([imp_n, scale, imp_c, *encs])


# --- split and outlier rules ---------------------------------------------

def split_three(df: DataFrame, key: str, test: float = fixed.SPLIT_TEST,
                valid: float = fixed.SPLIT_VALID) -> DataFrame:
    """Deterministic train / valid / test label from md5 of a key.

    The same row always lands in the same split, whatever the partitioning,
    executor count or rerun; sizes are close to, not exactly, the fractions."""
    u = md5_unit(key)
    return df.withColumn("split", F.when(u < test, "test").when(u < test + valid, "valid").otherwise("train"))


def zscore_flags(df: DataFrame, column: str, limit: float = fixed.ZSCORE_LIMIT, digits: int = 9) -> DataFrame:
    """z = (x - mean) / population std; outlier when |z| > limit."""
    row = df.agg(F.avg(present(column)).alias("m"), F.stddev_pop(present(column)).alias("s")).first()
    z = (present(column) - F.lit(row["m"])) / F.lit(row["s"] or 1.0)
    return df.withColumns({"zscore": F.round(z, digits), "is_outlier": F.abs(z) > F.lit(limit)})


def iqr_flags(df: DataFrame, column: str, whisker: float = fixed.IQR_WHISKER) -> DataFrame:
    """Outlier when outside [Q1 - 1.5 IQR, Q3 + 1.5 IQR] (exact quartiles).

    A missing value (NULL or NaN) has no flag (NULL), nor has any row of a
    table without values."""
    q = {r["p"]: r["value"] for r in exact_quantiles(df, [column], [0.25, 0.75]).collect()}
    if not q:
        return df.withColumn("is_outlier", F.lit(None).cast("boolean"))
    q1, q3 = q[0.25], q[0.75]
    lo, hi = q1 - whisker * (q3 - q1), q3 + whisker * (q3 - q1)
    x = present(column)
    return df.withColumn("is_outlier", (x < F.lit(lo)) | (x > F.lit(hi)))
