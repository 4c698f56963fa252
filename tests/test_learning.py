"""Feature views, splits, training and scoring."""

from pyspark.sql import functions as F

from rillstream.plans import features as ft, ml


def test_classifier_learns_and_scores(spark, tmp_path):
    df = spark.range(3000).selectExpr(
        "id", "id % 17 AS a", "id * 7 % 31 AS b", "CASE WHEN id % 3 = 0 THEN 'x' ELSE 'y' END AS c",
        "CAST(id % 17 > 12 AND id % 3 = 0 AS INT) AS y", "CASE WHEN id % 50 <> 0 THEN CAST(id AS DECIMAL(10,2)) END AS d")
    train, test = ft.split(df, "id", 0.2)
    assert train.count() + test.count() == 3000 and 450 < test.count() < 750
    model = ml.train(train, ["a", "b", "c", "d"], "y", categorical=["c"], depth=4, rounds=5)
    scored = ml.predict(model, test)
    assert scored.schema["d"].dataType == df.schema["d"].dataType
    m = ml.evaluate(scored, "y").first()
    assert m.f1 > 0.95 and m.macro_f1 > 0.95 and m.tn + m.fp + m.fn + m.tp == test.count()
    path = str(tmp_path / "model")
    model.write().overwrite().save(path)
    again = ml.predict(ml.PipelineModel.load(path), test)
    assert again.exceptAll(scored).isEmpty()


def test_metrics_without_positives(spark):
    r = ml.evaluate(spark.createDataFrame([(0, 0), (0, 1), (1, 0)], "y int, prediction int"), "y").first()
    assert (r.tn, r.fp, r.fn, r.tp) == (1, 1, 1, 0)
    assert r.precision is None and r.recall is None and r.f1 is None


def test_time_split_is_chronological(spark):
    df = spark.range(101).selectExpr("id", "timestamp_seconds(id)::timestamp_ntz AS ts")
    train, test = ft.split(df, "id", 0.2, "time", ts="ts")
    assert train.agg(F.max("id")).first()[0] == 80 and test.agg(F.min("id")).first()[0] == 81


def test_category_codes(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("a",)], "c string")
    assert {(r.c, r.c_code) for r in ft.encode_category(df, "c").collect()} == {("a", 0), ("b", 1), ("c", 2)}


def test_percentiles_and_codes_over_ranges(spark):
    import numpy as np
    from rillstream.operators.relational import percentiles
    values = [float(x) for x in np.random.default_rng(0).integers(0, 50, 333)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "v double")
    r = percentiles(df, "v", [0, 12.5, 50, 99, 100]).first()
    assert np.allclose(list(r)[:5], np.percentile(values, [0, 12.5, 50, 99, 100])) and r["max"] == max(values)
    names = spark.createDataFrame([(f"n{k % 40:03d}",) for k in range(200)] + [(None,)], "c string")
    got = {(r.c, r.c_code) for r in ft.encode_category(names, "c").collect()}
    assert got == {(f"n{k:03d}", k) for k in range(40)} | {(None, None)}


def test_percentiles_per_key(spark):
    """Equal to numpy per key, NULL key included."""
    import numpy as np
    from rillstream.operators import relational as rel
    rng = np.random.default_rng(1)
    rows = [("hot", float(x)) for x in rng.normal(size=4000)] + [(k, float(x)) for k in ("a", "b", None)
            for x in rng.integers(0, 9, 30)] + [("one", 3.0), ("none", None)]
    df = spark.createDataFrame(rows, "k string, v double")
    ps = [0, 12.5, 50, 90, 100]
    got = {r.k: list(r)[1:] for r in rel.percentiles(df, "v", ps, ["k"]).collect()}
    assert set(got) == {"hot", "a", "b", None, "one"}
    for k, found in got.items():
        values = [v for key, v in rows if key == k]
        assert np.allclose(found, [*np.percentile(values, ps, method="linear"), max(values)])


def test_running_totals_spread_a_hot_key(spark):
    from rillstream.operators import relational as rel
    df = spark.range(4000).select(F.lit("hot").alias("k"), F.rand(1).alias("v"))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so few rows would be one partition
    run = rel.running_total(df, ["k", "v"], F.lit(1), "n")
    share = [len(p) for p in run.filter("k = 'hot'").select("n").rdd.glom().collect() if p]
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(share) > 1 and max(share) < 4000
