import random
from collections import Counter

import pytest
from helpers import rows_of
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from tidemark.operators import reports, split


@pytest.mark.parametrize("n", [1, 2, 5, 99, 1000])
def test_exact_split_size(spark, n):
    df = spark.range(n).select(F.col("id").cast("string").alias("k"))
    sided = split.with_exact_side(df, "k")
    sizes = Counter(r.side for r in sided.collect())
    assert sizes["test"] == -(-n // 5) and sum(sizes.values()) == n


def test_rows_of_a_key_stay_on_one_side(spark):
    df = spark.range(300).select((F.col("id") % 50).cast("string").alias("k"), "id")
    sided = split.with_exact_side(df, "k")
    assert sided.select("k", "side").distinct().count() == 50
    assert 220 <= sided.filter("side = 'train'").count() <= 240
    assert split.with_exact_side(df.limit(0), "k").count() == 0
    plan = sided._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_splits_do_not_depend_on_partitions(spark):
    df = spark.range(500).select(F.col("id").cast("string").alias("k"))
    for sided in (split.with_side, split.with_exact_side):
        assert rows_of(sided(df.repartition(7), "k")) == rows_of(sided(df.coalesce(1), "k"))
    train, test = split.train_and_test(df, "k")
    assert train.count() + test.count() == 500 and 350 < train.count() < 450
    assert train.join(test, "k").count() == 0


def test_frequency_index_is_the_string_indexer(spark):
    from pyspark.ml.feature import StringIndexer

    df = spark.createDataFrame([(s,) for s in "bbaacd"], "s string")
    labels = StringIndexer(inputCol="s", outputCol="i").fit(df).labels
    got = {r.s: r["index"] for r in split.frequency_index(df, "s").collect()}
    assert got == {s: float(i) for i, s in enumerate(labels)}


def _results(spark):
    draw = random.Random(3)
    rows = [
        (draw.choice("xy"), float(draw.randrange(3)), float(draw.choice([0, 0, 1, 2])))
        for _ in range(300)
    ]
    return spark.createDataFrame(rows, "g string, label double, prediction double")


def test_metrics_equal_the_evaluators(spark):
    df = _results(spark)
    got = {r.g: r for r in reports.accuracy_and_f1(df, ["g"]).collect()}
    for group in "xy":
        part = df.filter(F.col("g") == group)
        for name in ("accuracy", "f1"):
            want = MulticlassClassificationEvaluator(metricName=name).evaluate(part)
            assert got[group][name] == pytest.approx(want)


def test_report_rows(spark):
    df = spark.createDataFrame(
        [("a", 0.0, 0.0)] * 3 + [("a", 1.0, 0.0)] + [("b", 0.0, 0.0)],
        "c string, label double, prediction double",
    )
    got = {(r.c, r.row): r for r in reports.classification_report(df, ["c"]).collect()}
    assert len(got) == 5 + 4
    zero, one = got["a", "0"], got["a", "1"]
    assert (zero.precision, zero.recall, zero.support) == (0.75, 1.0, 3)
    assert (one.precision, one.recall, one.f1, one.support) == (0.0, 0.0, 0.0, 1)
    assert got["a", "accuracy"].f1 == 0.75
    assert got["a", "macro avg"].precision == 0.375
    assert got["a", "weighted avg"].recall == 0.75
    counts = reports.confusion(df, ["c"])
    assert counts.agg(F.sum("n")).first()[0] == 5
