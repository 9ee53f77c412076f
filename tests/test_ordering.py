import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelloom.operators import ordering
from panelloom.operators.ordering import number_rows, percent_rank_average, running_weight
from panelloom.operators.radix import exact_quantiles, from_ordered_bits, ordered_bits
from panelloom.session import materialize


@pytest.fixture(scope="module", params=["ties", "spread"])
def sample(request):
    """A table in which one group holds most rows; a NULL group and NULL values included."""
    rng = random.Random(3)
    draw = (lambda: float(rng.randint(0, 40))) if request.param == "ties" else (lambda: rng.gauss(0, 100))
    rows = [
        (i, rng.choice(["hot", "hot", "hot", "cold", None]), None if rng.random() < 0.1 else draw())
        for i in range(3000)
    ]
    rows.append((3000, "empty", None))
    return rows


def _pandas(sample):
    return pd.DataFrame(sample, columns=["id", "g", "v"]).astype({"v": float})


def _spark(spark, sample):
    return spark.createDataFrame(sample, "id long, g string, v double").repartition(6)


@pytest.mark.parametrize("values", [1 << 20, 3])
def test_percent_rank_matches_average_rank(spark, sample, values):
    pdf = _pandas(sample)
    want = pdf.groupby("g", dropna=False)["v"].rank(pct=True, method="average")
    got = percent_rank_average(_spark(spark, sample), ["g"], {"v": "p"}, values).toPandas()
    got = got.sort_values("id")["p"].to_numpy(dtype=float)
    np.testing.assert_allclose(got, want.to_numpy(), rtol=1e-12)


def test_several_columns_move_the_rows_once(spark, sample):
    df = _spark(spark, sample).selectExpr("*", "-v AS w", "v % 7 AS x", "CAST(NULL AS double) AS y", "'payload' AS z")
    pdf = _pandas(sample)
    columns = {c: f"p_{c}" for c in "vwxy"}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        ranked = percent_rank_average(df, ["g"], columns, 3)
        plan = ranked._jdf.queryExecution().executedPlan().toString()
        got = ranked.toPandas().sort_values("id")
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum("Exchange" in line for line in plan.splitlines()) == 2  # the rows once, the gathered ranks once
    pdf = pdf.assign(w=-pdf["v"], x=np.fmod(pdf["v"], 7), y=np.nan)
    for c in "vwxy":
        want = pdf.groupby("g", dropna=False)[c].rank(pct=True, method="average")
        np.testing.assert_allclose(got[f"p_{c}"].to_numpy(dtype=float), want.to_numpy(), rtol=1e-12)


def test_rows_without_a_value_are_spread(spark):
    """Ten thousand NULLs of one group do not meet in one partition."""
    df = spark.range(10_000).select("id", F.lit("g").alias("g"), F.when(F.col("id") < 9, F.col("id").cast("double")).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ranked = percent_rank_average(df, ["g"], {"v": "p"})
        sizes = [r["count"] for r in ranked.groupBy(F.spark_partition_id().alias("at")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) == 8 and max(sizes) < 2000 and ranked.filter("p IS NOT NULL").count() == 9


def test_ranges_follow_the_size(spark, monkeypatch):
    table = materialize(spark.range(50_000).withColumn("w", F.lit(1)), "sized")
    assert ordering.ranges_for(table) == 1
    monkeypatch.setattr(ordering, "RANGE_BYTES", 10_000)
    assert ordering.ranges_for(table) > 5
    placed = running_weight(table, [], [F.col("id")], "w", stored=True)
    assert placed.filter("below <> id OR total <> 50000").count() == 0


@pytest.mark.parametrize("ranges", [None, 1, 5])
def test_number_rows_descending_with_tie_break(spark, sample, ranges):
    pdf = _pandas(sample).sort_values(["v", "id"], ascending=[False, True], na_position="last")
    want = (pdf.groupby("g", dropna=False).cumcount() + 1).sort_index()
    order = [F.col("v").desc_nulls_last(), F.col("id")]
    got = number_rows(_spark(spark, sample), ["g"], order, "at", ranges=ranges).toPandas()
    assert got.sort_values("id")["at"].tolist() == want.tolist()


def test_ranges_of_one_hot_group(spark):
    """Many ranges inside one group add up to one numbering."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.range(0, 5000).select(F.lit("g").alias("g"), ((F.col("id") * 7919) % 5003).alias("v"))
        placed = running_weight(df.withColumn("w", F.lit(2)), ["g"], [F.col("v")], "w")
        got = placed.toPandas().sort_values("v")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got["below"].tolist() == list(range(0, 10_000, 2))
    assert set(got["total"]) == {10_000}


QUANTILES = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p90": 0.9, "p100": 1.0}


def _expected(sample):
    pdf = _pandas(sample).dropna(subset=["v"])
    return {
        (None if pd.isna(g) else g): {name: part["v"].quantile(q) for name, q in QUANTILES.items()}
        for g, part in pdf.groupby("g", dropna=False)
    }


def _check(found, want):
    got = {r["g"]: r for r in found.collect()}
    assert set(got) == set(want)
    for g, values in want.items():
        for name, x in values.items():
            assert got[g][name] == pytest.approx(x, rel=1e-12, abs=1e-12)


def test_quantiles_interpolate(spark, sample):
    _check(exact_quantiles(_spark(spark, sample), ["g"], "v", QUANTILES), _expected(sample))


def test_quantiles_send_histograms_only(spark, sample):
    """Two aggregates over the rows, both combined in the tasks; nothing is ranged or sorted."""
    found = exact_quantiles(_spark(spark, sample), ["g"], "v", QUANTILES)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Python" not in plan


def test_ordered_bits_order_like_doubles(spark):
    rng = np.random.default_rng(0)
    bits = rng.integers(-(2**63), 2**63 - 1, 4000)
    values = bits.view(np.float64)
    edges = [0.0, -0.0, 5e-324, -5e-324, 2.0**-1022, 2.0**-1022 - 5e-324, 1.7976931348623157e308, np.inf, -np.inf, 1.0, np.nextafter(1.0, 0), np.nextafter(1.0, 2)]
    powers = [f(2.0**e, 0) if f else 2.0**e for e in range(-1070, 1024, 7) for f in (None, np.nextafter)]
    values = [float(v) for v in [*values[np.isfinite(values)], *edges, *powers]]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", ordered_bits(F.col("v")).alias("k"))
    got = rows.select("v", "k", from_ordered_bits(F.col("k")).alias("back")).collect()
    for r in got:
        want = int(np.float64(abs(r["v"])).view(np.int64))
        assert r["k"] == (-want if r["v"] < 0 else want) and r["back"] == r["v"]
    odd = spark.createDataFrame([(float("nan"),), (None,), (float("inf"),)], "v double").select(ordered_bits(F.col("v")).alias("k"))
    nan, none, inf = [r["k"] for r in odd.collect()]
    assert nan > inf and none is None


def test_quantiles_of_wide_and_tied_values(spark):
    pick = random.Random(9)
    rows = [(pick.choice("ab"), pick.choice([pick.gauss(0, 1), 10.0 ** pick.randint(-300, 300), -(10.0 ** pick.randint(-300, 300)), 7.0, 0.0, 5e-324])) for _ in range(4000)]
    found = {r["g"]: r for r in exact_quantiles(spark.createDataFrame(rows, "g string, v double"), ["g"], "v", QUANTILES).collect()}
    for g in "ab":
        own = sorted(v for k, v in rows if k == g)
        for name, q in QUANTILES.items():
            at = q * (len(own) - 1)
            lo, hi = own[int(np.floor(at))], own[int(np.ceil(at))]
            assert found[g][name] == lo + (hi - lo) * (at - np.floor(at))


def test_quantile_of_one_row_and_without_groups(spark):
    df = spark.createDataFrame([(4.0,)], "v double")
    assert exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"] == 4.0
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    assert exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"] == 2.5
