import random
from collections import Counter, defaultdict

import pytest
from helpers import HOUR, make_log, rows_of
from pyspark.sql import functions as F

from tidemark.functions import device_name, epoch_millis_text, paid_flag, second_part, state_code
from tidemark.operators import activity, explore, quality
from tidemark.operators.quantiles import exact_quantiles
from tidemark.operators.ranking import row_number_by_bucket
from tidemark.plans import churn
from tidemark.sources import driver_tables as views

PAGES = ["Home", "NextSong", "Cancel", "Cancellation Confirmation"]


def test_two_devices_give_one_row_or_all_combinations(spark):
    log = make_log(
        spark,
        [
            {"ts": 1, "location": "Austin, TX", "userAgent": "M (iPhone; x)"},
            {"ts": 2, "location": "Fresno, CA", "userAgent": "M (Macintosh; x)"},
        ],
    )
    assert rows_of(churn.user_features(log, PAGES), "state", "device") == [("CA", "Macintosh")]
    spread = churn.user_features(log, PAGES, grain="reference")
    assert len(rows_of(spread, "state", "device")) == 4
    with pytest.raises(ValueError):
        churn.user_features(log, PAGES, grain="other")


def test_latest_row_without_event_id(spark):
    log = make_log(spark, [{"ts": 5, "gender": "F"}, {"ts": 5, "gender": "M"}]).drop("event_id")
    assert rows_of(churn.user_features(log, PAGES), "gender") == [("M",)]


def test_tie_for_most_active_hour_takes_the_earlier(spark):
    log = make_log(spark, [{"ts": h * HOUR + i} for h in (5, 3) for i in range(2)])
    assert rows_of(activity.most_active_hour(log), "hour", "num_pages") == [(3, 2)]


def test_user_without_songs(spark):
    log = make_log(spark, [{}, {}, {}])
    features = churn.user_features(log, PAGES)
    row = features.first()
    assert row.sum_length is None and row.num_songs == 0 and row.avg_times_per_song == 3.0
    filled = churn.fill_song_measures(features).first()
    assert filled.sum_length == 0 and filled.median_length == 0 and filled.has_songs == 0
    only = activity.avg_times_per_song(log, songs_only=True).first()
    assert only.avg_times_per_song is None


def test_avg_times_per_song_counts_the_null_group(spark):
    songs = ["a", "a", "b", None, None, None]
    log = make_log(spark, [{"song": s} for s in songs])
    assert activity.avg_times_per_song(log).first().avg_times_per_song == 2.0
    assert activity.avg_times_per_song(log, songs_only=True).first().avg_times_per_song == 1.5


def test_absent_hours_are_zero(spark):
    log = make_log(spark, [{"ts": HOUR}, {"ts": HOUR + 1}])
    for table in (activity.hour_share(log), activity.hour_share_by_join(log)):
        row = table.first().asDict()
        assert row["num_pages_hr1"] == 1.0
        assert sum(v for k, v in row.items() if k.startswith("num_pages_hr")) == 1.0
        assert len(row) == 26


def test_null_user_is_left_out(spark):
    log = make_log(spark, [{"userId": None}, {"userId": "a", "page": "Cancellation Confirmation"}])
    assert rows_of(activity.churn_labels(log)) == [("a", 1)]
    assert rows_of(activity.churn_labels_union(log)) == [("a", 1)]


def test_user_who_only_cancelled_has_no_features(spark):
    log = make_log(
        spark,
        [
            {"userId": "a", "page": "Cancellation Confirmation"},
            {"userId": "b", "page": "Home"},
            {"userId": "c", "page": None},
        ],
    )
    assert rows_of(churn.user_features(log, PAGES), "userId") == [("b",)]
    assert rows_of(activity.page_pivot(log, PAGES), "userId") == [("b",)]


def test_pages_that_occur_and_their_counts(spark):
    log = make_log(spark, [{"page": "Thumbs Up"}, {"page": "Home"}, {"page": None}, {"page": "Cancel"}])
    assert rows_of(activity.page_values(log)) == [("Home",), ("Thumbs Up",)]
    counts = rows_of(activity.page_counts(log.filter("page is not null")), "page", "num_events")
    assert counts == [("Home", 1), ("Thumbs Up", 1)]
    row = activity.page_pivot(log, ["Home", "Thumbs Up", "Cancel"]).first().asDict()
    assert {k: v for k, v in row.items() if k.endswith("_pagecnt")} == {"home_pagecnt": 1, "thumbsup_pagecnt": 1}


def test_string_functions(spark):
    df = spark.createDataFrame(
        [("Austin, TX", "M (a;b c) (d)", "paid", "x / y  "), ("T", "none", None, "xy"), (None, None, "free", None)],
        "location string, ua string, level string, place string",
    )
    got = df.select(
        state_code("location"), device_name("ua"), paid_flag("level"), second_part("place")
    ).collect()
    assert [tuple(r) for r in got] == [("TX", "a", 1, "y"), ("T", None, 0, None), (None, None, 0, None)]


def test_epoch_text_is_cut_to_seconds(spark):
    row = spark.range(1).select(epoch_millis_text(F.lit(1_538_352_117_999))).first()
    assert row[0] == "2018-10-01 00:01:57"


def test_quality_checks(spark):
    df = spark.createDataFrame([(1, None), (None, None), (1, "x"), (1, "x")], "a int, b string")
    assert quality.null_counts(df).first().asDict() == {"a": 1, "b": 2}
    assert quality.nulls_where_null(df, "a", ["b"]).first().asDict() == {"b": 1}
    assert quality.duplicate_count(df).first()[0] == 1
    assert quality.duplicate_count(df.limit(0)).first()[0] == 0
    assert quality.shape(df).first().asDict() == {"n_rows": 4, "n_columns": 2}
    assert quality.columns_by_rule(spark.sql("SELECT 1 reg_a, 2 reg_datetime, 3 z"), "reg_", "datetime") == ["reg_a"]
    assert quality.columns_except(["c", "a", "b"], ["a"]) == ["c", "b"]


def test_row_numbers_of_a_hot_key(spark):
    draw = random.Random(5)
    rows = [("hot" if draw.random() < 0.6 else f"k{i % 7}", draw.randrange(400), i) for i in range(3000)]
    df = spark.createDataFrame(rows, "k string, t int, i int").withColumn("b", F.floor(F.col("t") / 9))
    got = {
        (r.k, r.i): r.rn for r in row_number_by_bucket(df, ["k"], "b", ["t", "i"], "rn").collect()
    }
    groups = defaultdict(list)
    for k, t, i in rows:
        groups[k].append((t, i))
    want = {(k, i): n for k, g in groups.items() for n, (_, i) in enumerate(sorted(g), 1)}
    assert got == want


@pytest.mark.parametrize("buckets", [2, 8, 64])
def test_exact_quantiles_against_brute_force(spark, buckets):
    draw = random.Random(9)
    rows = [("a", 0.0 if draw.random() < 0.4 else draw.expovariate(0.01)) for _ in range(2000)]
    rows += [("b", float(draw.randrange(5))) for _ in range(501)] + [("c", 3.5), ("d", None)]
    rows += [(None, float(i)) for i in range(10)]
    df = spark.createDataFrame(rows, "k string, v double")
    ps = [0.0, 1 / 32, 0.25, 0.5, 0.9, 1.0]
    got = {(r.k, r.probability): r.quantile for r in exact_quantiles(df, ["k"], "v", ps, buckets).collect()}
    groups = defaultdict(list)
    for k, v in rows:
        if v is not None:
            groups[k].append(v)
    assert len(got) == len(groups) * len(ps)
    for k, values in groups.items():
        values.sort()
        for p in ps:
            place = p * (len(values) - 1)
            low = int(place)
            high = min(low + (place > low), len(values) - 1)
            want = values[low] + (values[high] - values[low]) * (place - low)
            assert got[k, p] == pytest.approx(want, abs=1e-9)


def test_properties_on_the_driver_tables(spark, sf_dir):
    log = activity.clean_log(views.activity_log(spark, sf_dir)).cache()
    labels = activity.churn_labels(log)
    users = log.select("userId").distinct().count()
    assert labels.count() == users
    assert rows_of(labels) == rows_of(activity.churn_labels_union(log))

    features = churn.user_features(log, views.PAGES).cache()
    others = log.filter(~F.col("page").isin(activity.CANCEL_PAGES))
    assert features.count() == others.select("userId").distinct().count()
    pages = [c for c in features.columns if c.endswith("_pagecnt")]
    counted = features.select(sum((F.col(c) for c in pages), F.lit(0)).alias("n")).agg(F.sum("n"))
    assert counted.first()[0] == others.count()
    hours = [f"num_pages_hr{h}" for h in range(24)]
    total = F.round(sum((F.col(h) for h in hours), F.lit(0.0)), 9)
    assert features.filter(total != 1.0).count() == 0
    assert rows_of(features, "userId", *pages) == rows_of(
        activity.page_pivot(log, views.PAGES), "userId", *pages
    )
    shares = explore.gender_by_label(log).groupBy("gender").agg(F.round(F.sum("share"), 9))
    assert all(r[1] == 1.0 for r in shares.collect())


def test_median_is_a_value_of_the_group(spark):
    lengths = [5.0, 1.0, 3.0, None, 9.0]
    log = make_log(spark, [{"length": v} for v in lengths])
    row = activity.length_stats(log).first()
    assert (row.sum_length, row.min_length, row.max_length, row.median_length) == (18.0, 1.0, 9.0, 3.0)


def test_registration_counts_add_up(spark):
    log = make_log(spark, [{"userId": f"u{i}", "registration": i * HOUR * 30} for i in range(9)])
    got = Counter()
    for row in explore.registration_counts(log).collect():
        got[row.part] += row.num_users
    assert set(got.values()) == {9} and len(got) == 6


def test_features_against_plain_counts_with_a_hot_user(spark, sf_dir):
    log = activity.clean_log(views.activity_log(spark, sf_dir))
    hot = F.when(F.col("event_id") % 3 == 0, "hot").otherwise(F.col("userId"))
    log = log.withColumn("userId", hot).cache()
    features = churn.user_features(log, views.PAGES)
    got = {r.userId: r for r in features.collect()}
    rows: dict = {}
    for row in log.collect():
        rows.setdefault(row.userId, []).append(row)
    kept = {u: own for u, own in rows.items() if any(r.page not in activity.CANCEL_PAGES for r in own)}
    assert got.keys() == kept.keys() and "hot" in got
    for user, own in kept.items():
        found, songs = got[user], [r.song for r in own if r.song is not None]
        assert found.label == int(any(r.page == activity.CHURN_PAGE for r in own))
        assert found.num_songs == len(songs) and found.num_unique_songs == len(set(songs))
        assert found.num_artists == len({r.artist for r in own if r.artist is not None})
        groups = len(set(songs)) + any(r.song is None for r in own)
        assert found.avg_times_per_song == pytest.approx(len(own) / groups)
        lengths = [r.length for r in own if r.length is not None]
        assert (found.max_length, found.min_length) == (max(lengths, default=None), min(lengths, default=None))
        last = max(own, key=lambda r: (r.ts, r.event_id))
        assert (found.gender, found.state) == (last.gender, last.location[-2:])
    assert features.filter("userId = 'hot'").count() == 1


@pytest.mark.parametrize("registration", [False, True])
def test_users_of_the_log_do_not_go_through_the_driver(spark, sf_dir, registration):
    log = views.activity_log(spark, sf_dir, registration=registration)
    log.count()
    joins = [line for line in log._jdf.queryExecution().executedPlan().toString().splitlines() if "user_id" in line and "Join" in line]
    assert joins
    assert not [line for line in joins if "Broadcast" in line]
