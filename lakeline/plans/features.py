"""Feature-preparation queries (B16-B18, G1-G14, F12) on the housing-shaped view."""

from __future__ import annotations

from pyspark.sql import functions as F

from lakeline.operators import prepare as pp
from lakeline.operators import profile as pf
from lakeline.plans.profiles import HOUSING_SQL, _exact_mean, housing
from lakeline.plans.registry import query
from lakeline.functions import fixed

TEST, VALID = fixed.SPLIT_TEST, fixed.SPLIT_VALID
D = 9  # digits kept on scaled outputs


def split_rows(t):
    """housing + a nullable category (flag missing where tax is) + a split label."""
    h = housing(t).withColumn("flag_n", F.when(F.col("tax").isNotNull(), F.col("flag")))
    return pp.split_three(h, "row_key", TEST, VALID)


def feats(t, *columns):
    """``split_rows`` with these columns (default: all), for queries that fit.

    Written once per query: each fit step (medians, moments, modes, categories)
    is another pass over it, so the hashed split is computed on all cores
    and written once instead of recomputed per pass."""
    cache = t.__dict__.setdefault("_built", {})
    key = ("feats", *columns)
    if key not in cache:
        rows = split_rows(t)
        cache[key] = (rows.select(*columns, "split") if columns else rows).checkpoint(eager=True)
    return cache[key]


FEATS_SQL = HOUSING_SQL + f"""
, feats AS (
  SELECT *, CASE WHEN tax IS NOT NULL THEN flag END AS flag_n,
         CASE WHEN u < {TEST!r} THEN 'test' WHEN u < {TEST + VALID!r} THEN 'valid' ELSE 'train' END AS split
  FROM (SELECT *, CAST(('0x' || substr(md5(row_key), 1, 8))::BIGINT AS DOUBLE) / 4294967296.0 AS u FROM housing))
, train AS (SELECT * FROM feats WHERE split = 'train')
"""


def train(t):
    return feats(t).filter(F.col("split") == "train")


@query("split_three", FEATS_SQL + "SELECT row_key, split FROM feats")
def q_split_three(t):
    return split_rows(t).select("row_key", "split")  # one projection: nothing to write


@query("rows_missing", FEATS_SQL + "SELECT row_key, quantity, price, tax FROM feats WHERE tax IS NULL OR isnan(tax)")
def q_rows_missing(t):
    h = housing(t)
    return h.filter(F.col("tax").isNull() | F.isnan("tax")).select("row_key", "quantity", "price", "tax")


@query("drop_missing", FEATS_SQL + "SELECT row_key, quantity, price, tax FROM feats WHERE tax IS NOT NULL")
def q_drop_missing(t):
    return housing(t).na.drop(subset=["tax"]).select("row_key", "quantity", "price", "tax")


@query("drop_column", HOUSING_SQL + "SELECT row_key, quantity, price, discount, tax, flag FROM housing")
def q_drop_column(t):
    return housing(t).drop("status")


@query("impute_median", FEATS_SQL + """
SELECT row_key, round(coalesce(tax, (SELECT quantile_cont(tax, 0.5) FROM train)), 9) AS tax,
       round(coalesce(price, (SELECT quantile_cont(price, 0.5) FROM train)), 9) AS price
FROM feats""")
def q_impute_median(t):
    fill = pp.fit_median(train(t), ["tax", "price"])
    out = fill.transform(feats(t))
    return out.select("row_key", F.round("tax", 9).alias("tax"), F.round("price", 9).alias("price"))


@query("impute_mode", FEATS_SQL + """
SELECT row_key, coalesce(flag_n, (SELECT flag_n FROM train WHERE flag_n IS NOT NULL
                                  GROUP BY flag_n ORDER BY count(*) DESC, flag_n LIMIT 1)) AS flag_n
FROM feats""")
def q_impute_mode(t):
    return pp.fit_mode(train(t), ["flag_n"]).transform(feats(t)).select("row_key", "flag_n")


@query("encode_ordinal", FEATS_SQL + """
SELECT f.row_key, f.flag, CAST(c.code AS INTEGER) AS flag_code FROM feats f
LEFT JOIN (SELECT flag, row_number() OVER (ORDER BY flag) - 1 AS code FROM (SELECT DISTINCT flag FROM train)) c
ON f.flag = c.flag""")
def q_encode_ordinal(t):
    rows = split_rows(t).select("row_key", "flag", "split")  # cheaper to read twice than to write
    return pp.fit_ordinal(rows.filter("split = 'train'"), "flag").transform(rows, "flag_code").select("row_key", "flag", "flag_code")


@query("encode_dummies", FEATS_SQL + """
SELECT row_key, coalesce(flag_n = 'N', false) AS flag_n_N, coalesce(flag_n = 'R', false) AS flag_n_R FROM feats""")
def q_encode_dummies(t):
    enc = pp.fit_dummies(train(t), "flag_n")
    return enc.transform(feats(t).select("row_key", "flag_n"))


@query("encode_onehot", FEATS_SQL + """
SELECT row_key, CASE WHEN flag_n = 'A' THEN 1.0 ELSE 0.0 END AS flag_n_A,
       CASE WHEN flag_n = 'N' THEN 1.0 ELSE 0.0 END AS flag_n_N,
       CASE WHEN flag_n = 'R' THEN 1.0 ELSE 0.0 END AS flag_n_R FROM feats""")
def q_encode_onehot(t):
    enc = pp.fit_onehot(train(t), "flag_n")
    return enc.transform(feats(t).select("row_key", "flag_n"))


CUT = "1996-01-01"  # customers of earlier orders are the known categories


@query("encode_sparse", f"""
WITH known AS (SELECT o_custkey, CAST(row_number() OVER (ORDER BY o_custkey) - 1 AS INTEGER) AS code
               FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < TIMESTAMP '{CUT}'))
SELECT o_orderkey, CAST((SELECT count(*) FROM known) AS INTEGER) AS size, code AS hot, CASE WHEN code IS NULL THEN 0 ELSE 1 END AS entries
FROM orders LEFT JOIN known USING (o_custkey)""")
def q_encode_sparse(t):
    """Each order's customer as a sparse one-hot vector."""
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    enc = pp.fit_sparse(o.filter(F.col("o_orderdate") < F.lit(CUT).cast("timestamp_ntz")), "o_custkey")
    v = enc.transform(o, "v")
    return v.select("o_orderkey", "v.size", F.get("v.indices", 0).alias("hot"), F.size("v.values").alias("entries"))


def _minmax_sql(c):
    return (f"round(({c} - (SELECT min({c}) FROM train)) * (2.0 / ((SELECT max({c}) FROM train) - "
            f"(SELECT min({c}) FROM train))) + -1.0, {D}) AS {c}")


@query("scale_minmax", FEATS_SQL + f"SELECT row_key, {_minmax_sql('price')}, {_minmax_sql('quantity')} FROM feats")
def q_scale_minmax(t):
    sc = pp.fit_minmax(train(t), ["price", "quantity"], digits=D)
    return sc.transform(feats(t)).select("row_key", "price", "quantity")


def _std_sql(c, src="train", expr=None, alias=None):
    e = expr or c
    return (f"round(({e} - (SELECT avg({c}) FROM {src})) * (1.0 / (SELECT stddev_pop({c}) FROM {src})) + 0.0, {D}) "
            f"AS {alias or c}")


@query("scale_standard", FEATS_SQL + f"SELECT row_key, {_std_sql('price')}, {_std_sql('quantity')} FROM feats")
def q_scale_standard(t):
    sc = pp.fit_standard(train(t), ["price", "quantity"], digits=D)
    return sc.transform(feats(t)).select("row_key", "price", "quantity")


PREP_SQL = FEATS_SQL + """
, med AS (SELECT quantile_cont(tax, 0.5) AS tax_med, quantile_cont(quantity, 0.5) AS q_med FROM train)
, train_imp AS (SELECT coalesce(tax, (SELECT tax_med FROM med)) AS tax,
                       coalesce(quantity, (SELECT q_med FROM med)) AS quantity, flag_n FROM train)
, all_imp AS (SELECT row_key, coalesce(tax, (SELECT tax_med FROM med)) AS tax,
                     coalesce(quantity, (SELECT q_med FROM med)) AS quantity, flag_n FROM feats)
"""


@query("prep_numeric", PREP_SQL + f"""
SELECT row_key, {_std_sql('tax', 'train_imp')}, {_std_sql('quantity', 'train_imp')} FROM all_imp""")
def q_prep_numeric(t):
    steps = pp.fit_numeric(train(t), ["tax", "quantity"], digits=D)
    return steps.transform(feats(t)).select("row_key", "tax", "quantity")


@query("prep_mixed", PREP_SQL + f"""
, mode AS (SELECT flag_n FROM train_imp WHERE flag_n IS NOT NULL GROUP BY flag_n ORDER BY count(*) DESC, flag_n LIMIT 1)
, cat AS (SELECT row_key, tax, quantity, coalesce(flag_n, (SELECT flag_n FROM mode)) AS flag_n FROM all_imp)
SELECT row_key, {_std_sql('tax', 'train_imp', alias='num__tax')}, {_std_sql('quantity', 'train_imp', alias='num__quantity')},
       CASE WHEN flag_n = 'A' THEN 1.0 ELSE 0.0 END AS cat__flag_n_A,
       CASE WHEN flag_n = 'N' THEN 1.0 ELSE 0.0 END AS cat__flag_n_N,
       CASE WHEN flag_n = 'R' THEN 1.0 ELSE 0.0 END AS cat__flag_n_R
FROM cat""")
def q_prep_mixed(t):
    cols = ["row_key", "tax", "quantity", "flag_n"]
    rows = feats(t, *cols)
    steps = pp.fit_mixed(rows.filter(F.col("split") == "train").select(cols), leave=["row_key"], digits=D)
    return steps.transform(rows.select(cols))


@query("outlier_zscore", FEATS_SQL + f"""
SELECT row_key, round((quantity - (SELECT avg(quantity) FROM feats)) / (SELECT stddev_pop(quantity) FROM feats), {D}) AS zscore,
       abs((quantity - (SELECT avg(quantity) FROM feats)) / (SELECT stddev_pop(quantity) FROM feats)) > 3.0 AS is_outlier
FROM feats""")
def q_outlier_zscore(t):
    return pp.zscore_flags(feats(t), "quantity", 3.0, D).select("row_key", "zscore", "is_outlier")


@query("outlier_iqr", FEATS_SQL + """
, q AS (SELECT quantile_cont(price, 0.25) AS q1, quantile_cont(price, 0.75) AS q3 FROM feats)
SELECT row_key, (price < (SELECT q1 - 1.5 * (q3 - q1) FROM q)) OR (price > (SELECT q3 + 1.5 * (q3 - q1) FROM q)) AS is_outlier
FROM feats""")
def q_outlier_iqr(t):
    return pp.iqr_flags(feats(t), "price").select("row_key", "is_outlier")


STATS = ["count", "mean", "std", "min", "q25", "q50", "q75", "max"]


def _describe_sql(src, c="price", exact=False):
    mean = _exact_mean(c) if exact else f"round(avg({c}), 6)"
    return (f"SELECT CAST(count({c}) AS DOUBLE) AS count, {mean} AS mean, round(stddev_samp({c}), 6) AS std, "
            f"round(min({c}), 6) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, "
            f"round(quantile_cont({c}, 0.5), 6) AS q50, round(quantile_cont({c}, 0.75), 6) AS q75, "
            f"round(max({c}), 6) AS max FROM {src}")


@query("scaling_compare", FEATS_SQL + f"""
, mm AS (SELECT (price - (SELECT min(price) FROM train)) * (2.0 / ((SELECT max(price) FROM train) - (SELECT min(price) FROM train))) + -1.0 AS price FROM feats)
, st AS (SELECT (price - (SELECT avg(price) FROM train)) * (1.0 / (SELECT stddev_pop(price) FROM train)) + 0.0 AS price FROM feats)
, r AS ({_describe_sql('feats', exact=True)}), m AS ({_describe_sql('mm')}), s AS ({_describe_sql('st')})
""" + "\nUNION ALL\n".join(
    f"SELECT '{st}' AS statistic, (SELECT {st} FROM r) AS raw, (SELECT {st} FROM m) AS minmax, (SELECT {st} FROM s) AS standard"
    for st in STATS))
def q_scaling_compare(t):
    """describe() of the raw, min-max and standardised price, side by side."""
    f = feats(t).select("price")
    tr = train(t)
    mm = pp.fit_minmax(tr, ["price"]).transform(f)
    st = pp.fit_standard(tr, ["price"]).transform(f)
    parts = {"raw": pf.describe_numeric(f, ["price"], decimals=2), "minmax": pf.describe_numeric(mm, ["price"]),
             "standard": pf.describe_numeric(st, ["price"])}
    longs = [d.withColumn("count", F.col("count").cast("double"))
             .unpivot(["column"], STATS, "statistic", name).drop("column") for name, d in parts.items()]
    out = longs[0]
    for nxt in longs[1:]:
        out = out.join(nxt, "statistic")  # 8 rows a side: statistics aligned by name
    return out
