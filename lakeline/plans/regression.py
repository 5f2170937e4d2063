"""Regression queries (R1-R7) and the isolation-forest outlier query (G12)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from lakeline.operators import forest
from lakeline.operators import prepare as pp
from lakeline.operators import regress as rg
from lakeline.plans.profiles import HOUSING_SQL, housing
from lakeline.plans.registry import query
from lakeline.functions import fixed

# price explained by quantity (one feature, so SQL's regr_* functions check it)
X, Y = "quantity", "price"


@query("ols_normal", HOUSING_SQL + f"""
SELECT 'intercept' AS term, round(regr_intercept({Y}, {X}), 6) AS coef FROM housing
UNION ALL SELECT '{X}', round(regr_slope({Y}, {X}), 6) FROM housing""")
def q_ols_normal(t):
    return rg.fit_normal(housing(t), [X], Y).frame(t.spark)


@query("ols_library", HOUSING_SQL + f"""
SELECT 'intercept' AS term, round(regr_intercept({Y}, {X}), 6) AS coef FROM housing
UNION ALL SELECT '{X}', round(regr_slope({Y}, {X}), 6) FROM housing""")
def q_ols_library(t):
    """The same fit by Spark's own regression, as a cross-check."""
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    rows = VectorAssembler(inputCols=[X], outputCol="features").transform(housing(t).select(X, Y).dropna())
    model = LinearRegression(featuresCol="features", labelCol=Y, solver="normal", regParam=0.0).fit(rows)
    return rg.Linear(["intercept", X], np.array([model.intercept, *model.coefficients])).frame(t.spark)


@query("ols_pinv", HOUSING_SQL + f"""
SELECT 'intercept' AS term, round(regr_intercept({Y}, {X}), 6) AS coef FROM housing
UNION ALL SELECT '{X}', round(regr_slope({Y}, {X}) / 5, 6) FROM housing
UNION ALL SELECT '{X}_x2', round(2 * regr_slope({Y}, {X}) / 5, 6) FROM housing""")
def q_ols_pinv(t):
    """Collinear design (x and 2x): the pseudo-inverse gives the minimum-norm
    solution, slope split 1:2 between the copies."""
    h = housing(t).withColumn(f"{X}_x2", F.col(X) * 2)
    return rg.fit_pinv(h, [X, f"{X}_x2"], Y).frame(t.spark)


@query("ols_gd", HOUSING_SQL + f"""
SELECT 'intercept' AS term, round(avg({Y}), 6) AS coef FROM housing
UNION ALL SELECT '{X}', round(regr_slope({Y}, {X}) * stddev_pop({X}), 6) FROM housing""")
def q_ols_gd(t):
    """Batch descent (rate 0.1, 1000 epochs) on the standardised feature."""
    h = housing(t)
    scaled = pp.fit_standard(h, [X]).transform(h)
    return rg.fit_gd(scaled, [X], Y).frame(t.spark)


@query("ols_minibatch")
def q_ols_minibatch(t):
    """Mini-batch descent, 50 epochs of batches of 20 rows, each in a new order,
    t0/(t+t1) schedule, on the standardised feature.  Stochastic: tests compare
    it with the serial loop and the closed form, not SQL."""
    h = housing(t)
    scaled = pp.fit_standard(h, [X]).transform(h)
    return rg.fit_minibatch(scaled, "row_key", [X], Y).frame(t.spark)


@query("ols_predict", HOUSING_SQL + f"""
SELECT row_key, round(regr_intercept_all + regr_slope_all * {X}, 3) AS prediction
FROM housing, (SELECT regr_intercept({Y}, {X}) AS regr_intercept_all, regr_slope({Y}, {X}) AS regr_slope_all FROM housing)""")
def q_ols_predict(t):
    h = housing(t)
    model = rg.fit_normal(h, [X], Y)
    return model.predict(h, "prediction", digits=3).select("row_key", "prediction")


FOREST_FEATURES = ["quantity", "price", "discount"]


@query("outlier_forest")
def q_outlier_forest(t):
    """Isolation-forest score and flag (contamination 1 %) per row."""
    h = housing(t)
    model = forest.fit(h, "row_key", FOREST_FEATURES, seed=42)
    # scored once: the contamination cut and the output both read it
    scored = model.score(h.select("row_key", *FOREST_FEATURES)).checkpoint(eager=True)
    return forest.flag(scored, contamination=fixed.FOREST_CONTAMINATION).select("row_key", F.round("score", 6).alias("score"),
                                                          "is_outlier")
