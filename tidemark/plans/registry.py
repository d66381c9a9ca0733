"""Every registered query: (spark, folder) -> DataFrame over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.ml.classification import LinearSVC
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions import clean_text, display_name
from tidemark.functions import split_words as words_of
from tidemark.operators import (
    activity,
    explore,
    messages,
    models,
    multilabel,
    prices,
    quality,
    reports,
    split,
    terms,
)
from tidemark.operators import quantiles as q
from tidemark.plans import churn, roundtrips, training, wording
from tidemark.session import WORD_SETTINGS, configure, scratch_path
from tidemark.sources import driver_tables as views
from tidemark.sources import stored
from tidemark.sources.driver_tables import CATEGORY_NAMES, PAGES

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DIGITS = 6
USER = "8"

_DUPLICATE_COLUMNS = ["message", "original", "genre", "categories"]


def tidy(df: DataFrame) -> DataFrame:
    """Numbers as the SQL check returns them: 64-bit counts, doubles to 6 digits.

    Sums of doubles depend on the order of rows in their last digits. Going
    through a decimal first rounds values halfway between two results alike.
    """
    columns = []
    for name, kind in df.dtypes:
        column = F.col(f"`{name}`")
        if kind in ("int", "smallint", "boolean"):
            column = column.cast("bigint") if kind != "boolean" else column.cast("int").cast("bigint")
        elif kind == "double":
            column = F.round(column.cast("decimal(38,9)"), DIGITS).cast("double")
        elif kind == "date":
            column = column.cast("string")
        columns.append(column.alias(name))
    return df.select(*columns)


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return tidy(function(configure(spark), sf_dir))

    QUERIES[function.__name__] = run
    return run


def raw_log(spark, sf_dir, **parts):
    return views.activity_log(spark, sf_dir, **parts)


def log(spark, sf_dir, registration=False, items=False):
    return activity.clean_log(raw_log(spark, sf_dir, registration=registration, items=items))


def merged(spark, sf_dir):
    return messages.merge_messages(
        views.messages(spark, sf_dir), views.categories(spark, sf_dir)
    )


def cleaned(spark, sf_dir):
    return messages.clean_messages(
        views.messages(spark, sf_dir), views.categories(spark, sf_dir), CATEGORY_NAMES
    )


# --- quality ----------------------------------------------------------------


@query
def null_counts(spark, sf_dir):
    return quality.null_counts(raw_log(spark, sf_dir, items=True))


@query
def null_cooccurrence(spark, sf_dir):
    """Nulls that go with a missing artist, and with a missing first name."""
    return quality.null_cooccurrence(
        raw_log(spark, sf_dir),
        {
            "artist": ["length", "song"],
            "firstName": ["gender", "lastName", "location", "registration", "userAgent"],
        },
    )


@query
def pages_when_null(spark, sf_dir):
    return quality.values_where(raw_log(spark, sf_dir, registration=False), "page", "firstName", null=True)


@query
def pages_when_not_null(spark, sf_dir):
    return quality.values_where(raw_log(spark, sf_dir, registration=False), "page", "artist", null=False)


@query
def describe_items(spark, sf_dir):
    return quality.summary(log(spark, sf_dir, items=True), "itemInSession")


@query
def schema_listing(spark, sf_dir):
    return quality.schema_listing(views.calendar(spark, sf_dir))


@query
def row_count(spark, sf_dir):
    return quality.shape(views.calendar(spark, sf_dir))


@query
def listing_nunique(spark, sf_dir):
    return quality.distinct_count(views.calendar(spark, sf_dir), "listing_id", "n_listings")


@query
def duplicate_rows(spark, sf_dir):
    """Copies among the merged messages, whose ids are left aside."""
    return quality.duplicate_count(merged(spark, sf_dir), _DUPLICATE_COLUMNS)


@query
def dedup_messages(spark, sf_dir):
    return merged(spark, sf_dir).select(*_DUPLICATE_COLUMNS).dropDuplicates()


@query
def preview_events(spark, sf_dir):
    return quality.preview(
        log(spark, sf_dir, items=True),
        order=["ts", "event_id"],
        n=100,
        columns=["userId", "page", "ts", "sessionId", "itemInSession"],
    )


# --- activity log -----------------------------------------------------------


@query
def clean_log(spark, sf_dir):
    return log(spark, sf_dir, registration=True)


@query
def log_dateparts(spark, sf_dir):
    events = activity.add_time_text(log(spark, sf_dir, registration=True))
    parts = activity.event_parts()
    return events.withColumns(parts).select("event_id", "userId", "ts", "datetime", *parts)


@query
def registration_dateparts(spark, sf_dir):
    events = activity.add_date_parts(log(spark, sf_dir, registration=True))
    names = quality.columns_by_rule(events, prefix="reg_")
    return events.select("event_id", "userId", "registration", *names)


@query
def churn_labels(spark, sf_dir):
    return activity.churn_labels(log(spark, sf_dir))


@query
def churn_labels_union(spark, sf_dir):
    return activity.churn_labels_union(log(spark, sf_dir))


@query
def label_balance(spark, sf_dir):
    return activity.label_balance(activity.churn_labels(log(spark, sf_dir)))


@query
def churn_rate(spark, sf_dir):
    return activity.churn_rate(activity.churn_labels(log(spark, sf_dir)))


@query
def labelled_log(spark, sf_dir):
    events = activity.add_labels(log(spark, sf_dir))
    return events.select("event_id", "userId", "page", "label")


@query
def artists_per_user(spark, sf_dir):
    return activity.artists_per_user(log(spark, sf_dir))


@query
def length_stats(spark, sf_dir):
    return activity.length_stats(log(spark, sf_dir))


@query
def song_counts(spark, sf_dir):
    return activity.song_counts(log(spark, sf_dir))


@query
def avg_times_per_song(spark, sf_dir):
    return activity.avg_times_per_song(log(spark, sf_dir))


@query
def avg_times_per_song_songs_only(spark, sf_dir):
    return activity.avg_times_per_song(log(spark, sf_dir), songs_only=True)


@query
def lifetime_days(spark, sf_dir):
    return activity.lifetime_days(log(spark, sf_dir, registration=True))


@query
def page_pivot(spark, sf_dir):
    return activity.page_pivot(log(spark, sf_dir), PAGES)


@query
def page_values(spark, sf_dir):
    return activity.page_values(log(spark, sf_dir))


@query
def page_counts(spark, sf_dir):
    return activity.page_counts(log(spark, sf_dir))


@query
def hour_pivot(spark, sf_dir):
    return activity.hour_pivot(log(spark, sf_dir))


@query
def hour_pivot_share(spark, sf_dir):
    return activity.hour_share(log(spark, sf_dir))


@query
def hour_share_joined(spark, sf_dir):
    return activity.hour_share_by_join(log(spark, sf_dir))


@query
def active_hours(spark, sf_dir):
    return activity.active_hours(log(spark, sf_dir))


@query
def most_active_hour(spark, sf_dir):
    return activity.most_active_hour(log(spark, sf_dir))


@query
def user_features(spark, sf_dir):
    return churn.user_features(log(spark, sf_dir, registration=True), PAGES)


@query
def user_features_fanout(spark, sf_dir):
    return churn.user_features(log(spark, sf_dir, registration=True), PAGES, grain="reference")


# --- exploration ------------------------------------------------------------


@query
def sessions_of_user(spark, sf_dir):
    return explore.sessions_of_user(log(spark, sf_dir, items=True), USER)


@query
def sessions_per_user(spark, sf_dir):
    return explore.sessions_per_user(log(spark, sf_dir, items=True))


@query
def events_of_user(spark, sf_dir):
    return explore.events_of_user(log(spark, sf_dir, items=True), USER)


@query
def gender_by_label(spark, sf_dir):
    return explore.gender_by_label(log(spark, sf_dir))


@query
def level_by_label(spark, sf_dir):
    return explore.level_by_label(log(spark, sf_dir))


@query
def state_by_label(spark, sf_dir):
    return explore.state_by_label(log(spark, sf_dir))


@query
def device_by_label(spark, sf_dir):
    return explore.device_by_label(log(spark, sf_dir))


@query
def user_agents(spark, sf_dir):
    return log(spark, sf_dir).select("userAgent").dropDuplicates()


@query
def registration_counts(spark, sf_dir):
    return explore.registration_counts(log(spark, sf_dir, registration=True))


@query
def hour_label_crosstab(spark, sf_dir):
    return explore.hour_label_crosstab(log(spark, sf_dir))


@query
def churn_by_hour(spark, sf_dir):
    return explore.churn_by_hour(log(spark, sf_dir))


@query
def measure_quantiles_by_label(spark, sf_dir):
    features = churn.user_features(log(spark, sf_dir, registration=True), PAGES)
    return q.measure_quantiles_by_label(features, churn.charted_measures(PAGES))


# --- prices -----------------------------------------------------------------


def parsed(spark, sf_dir):
    return prices.parse_calendar(views.calendar(spark, sf_dir))


def by_district(spark, sf_dir):
    return prices.price_by_district_date(parsed(spark, sf_dir), views.listings(spark, sf_dir))


@query
def price_parsed(spark, sf_dir):
    return prices.sorted_calendar(parsed(spark, sf_dir))


@query
def price_by_date(spark, sf_dir):
    return prices.price_by_date(parsed(spark, sf_dir))


@query
def calendar_with_district(spark, sf_dir):
    return prices.with_district(parsed(spark, sf_dir), views.listings(spark, sf_dir))


@query
def price_by_district_date(spark, sf_dir):
    return by_district(spark, sf_dir)


@query
def districts(spark, sf_dir):
    return prices.districts(by_district(spark, sf_dir))


@query
def district_series(spark, sf_dir):
    chosen = ["Brand#1 District", "Brand#2 District"]
    return prices.district_series(by_district(spark, sf_dir), highlighted=chosen)


@query
def one_district_series(spark, sf_dir):
    return prices.district_series(by_district(spark, sf_dir), "Brand#3 District")


# --- messages ---------------------------------------------------------------


@query
def messages_merged(spark, sf_dir):
    return merged(spark, sf_dir)


@query
def categories_wide(spark, sf_dir):
    wide = messages.expand_categories(merged(spark, sf_dir), CATEGORY_NAMES)
    return quality.columns_from(wide, 0).drop("message")


@query
def label_matrix(spark, sf_dir):
    """The label columns by position: all after the fourth."""
    return quality.columns_from(cleaned(spark, sf_dir), 4)


@query
def categories_long(spark, sf_dir):
    return messages.categories_long(views.categories(spark, sf_dir))


@query
def categories_name_check(spark, sf_dir):
    """Rows whose names, in order, are not the expected ones."""
    return messages.name_mismatches(views.categories(spark, sf_dir), CATEGORY_NAMES)


@query
def category_names(spark, sf_dir):
    return messages.category_names(views.categories(spark, sf_dir))


@query
def clean_messages(spark, sf_dir):
    return cleaned(spark, sf_dir)


@query
def clean_merged_messages(spark, sf_dir):
    return messages.clean_merged(merged(spark, sf_dir), CATEGORY_NAMES)


@query
def genre_counts(spark, sf_dir):
    return messages.genre_counts(cleaned(spark, sf_dir))


@query
def category_totals(spark, sf_dir):
    return messages.category_totals(cleaned(spark, sf_dir), CATEGORY_NAMES)


@query
def category_display(spark, sf_dir):
    return messages.assigned_labels(cleaned(spark, sf_dir), CATEGORY_NAMES)


# --- text -------------------------------------------------------------------


def tokenised(spark, sf_dir, profile="train"):
    configure(spark, WORD_SETTINGS)
    return terms.tokens(views.messages(spark, sf_dir, with_urls=True), profile=profile)


@query
def cleaned_text(spark, sf_dir):
    source = views.messages(spark, sf_dir, with_urls=True)
    return source.select("id", clean_text("message").alias("clean_text"))


@query
def tokens(spark, sf_dir):
    source = views.messages(spark, sf_dir, with_urls=True)
    words = words_of(clean_text("message"))
    return source.select("id", F.array_join(words, " ").alias("tokens"))


@query
def tokens_no_stop(spark, sf_dir):
    words = tokenised(spark, sf_dir)
    return words.select("id", F.array_join("tokens", " ").alias("tokens"))


@query
def noun_lemmas(spark, sf_dir):
    return wording.corpus_terms(tokenised(spark, sf_dir))[1]


@query
def lemma_tokens(spark, sf_dir):
    words = wording.lemmatised(tokenised(spark, sf_dir))
    return words.select("id", F.array_join("tokens", " ").alias("tokens"))


@query
def serving_tokens(spark, sf_dir):
    """The serving tokeniser: no URL, punctuation or stop-word step."""
    words = tokenised(spark, sf_dir, "serve")
    words = wording.lemmatised(words, lower_after=True)
    return words.select("id", F.array_join("tokens", " ").alias("tokens"))


@query
def doc_frequency(spark, sf_dir):
    counts, lemmas = wording.corpus_terms(tokenised(spark, sf_dir))
    return terms.document_frequency(terms.lemma_counts(counts, lemmas))


@query
def tfidf_long(spark, sf_dir):
    return wording.message_tfidf(tokenised(spark, sf_dir), views.messages(spark, sf_dir))


# --- splits, indexes and reports ---------------------------------------------


def feature_table(spark, sf_dir):
    return churn.user_features(log(spark, sf_dir, registration=True), PAGES)


@query
def index_states(spark, sf_dir):
    return split.frequency_index(churn.latest_attributes(log(spark, sf_dir)), "state")


@query
def feature_vectors(spark, sf_dir):
    """The assembled vectors of all users, with string indexes fitted on training users."""
    filled = churn.fill_song_measures(feature_table(spark, sf_dir))
    _, train, test = models.prepare(filled)
    return models.long_vectors(train.unionByName(test))


@query
def tfidf_vectors(spark, sf_dir):
    """The vectors a forest gets, turned back into terms and weights."""
    words = stored(tokenised(spark, sf_dir).select("id", "tokens"), "tokens")
    vectoriser = multilabel.fit_vectors(words)
    cells = multilabel.long_rows(vectoriser.rows(words))
    return cells.join(vectoriser.numbers, "position").select("id", "term", "weight")


@query
def genre_ranking(spark, sf_dir):
    """Genres by number of messages, most first, with their place in that order."""
    counts = messages.genre_counts(cleaned(spark, sf_dir))
    ordered = counts.orderBy(F.desc("num_messages"), "genre")
    # One row per genre.
    place = F.row_number().over(Window.orderBy(F.desc("num_messages"), "genre"))
    return ordered.withColumn("place", place)


@query
def split_users(spark, sf_dir):
    users = activity.churn_labels(log(spark, sf_dir))
    return split.with_side(users, "userId")


@query
def split_users_exact(spark, sf_dir):
    users = activity.churn_labels(log(spark, sf_dir))
    return split.with_exact_side(users, "userId")


def _paired_labels(spark, sf_dir):
    """Label ``quality`` as the truth and ``related`` capped at 1 as the guess."""
    rows = cleaned(spark, sf_dir)
    return rows.select(
        F.lit("quality").alias("category"),
        F.col("quality").alias("label"),
        F.col("related").alias("prediction"),
    ).unionByName(
        rows.select(
            F.lit("toxic").alias("category"),
            F.col("toxic").alias("label"),
            F.col("related").alias("prediction"),
        )
    )


@query
def confusion_counts(spark, sf_dir):
    return reports.confusion(_paired_labels(spark, sf_dir), ["category"])


@query
def report_from_labels(spark, sf_dir):
    return reports.classification_report(_paired_labels(spark, sf_dir), ["category"])


@query
def accuracy_and_f1(spark, sf_dir):
    return reports.accuracy_and_f1(_paired_labels(spark, sf_dir), ["category"])


# --- sources and sinks ------------------------------------------------------


@query
def json_roundtrip(spark, sf_dir):
    return roundtrips.json_events(raw_log(spark, sf_dir, items=True))


@query
def csv_roundtrip(spark, sf_dir):
    return roundtrips.csv_calendar(views.calendar(spark, sf_dir))


@query
def csv_messages_roundtrip(spark, sf_dir):
    return roundtrips.csv_messages(views.messages(spark, sf_dir))


@query
def table_roundtrip(spark, sf_dir):
    return stored(cleaned(spark, sf_dir), "table")


# --- models -----------------------------------------------------------------



@lru_cache(maxsize=1)
def _search(application: str, sf_dir: str) -> training.ChurnRun:
    spark = SparkSession.getActiveSession()
    return training.tune_churn(feature_table(spark, sf_dir), models.NOTEBOOK_GRID)


def _tuned(spark, sf_dir):
    """The whole search, once for all queries that show a side of it."""
    return _search(spark.sparkContext.applicationId, sf_dir)


@lru_cache(maxsize=1)
def _saved(application: str, sf_dir: str) -> multilabel.MessageModel:
    spark = SparkSession.getActiveSession()
    return training.saved_message_model(cleaned(spark, sf_dir), CATEGORY_NAMES)


def _message_model(spark, sf_dir):
    """Whole forests on all rows, fitted once for all queries that score with them."""
    return _saved(spark.sparkContext.applicationId, sf_dir)


# Results of fitted models are no SQL. Their queries say of every row whether it holds
# to what can be computed another way; functions of the same names in ``training`` and
# ``models`` give the values.


@query
def compare_models(spark, sf_dir):
    """Per model: test users scored, and whether predictions and metrics are right."""
    _, _, train, test = training.churn_parts(feature_table(spark, sf_dir))
    return training.checked_metrics(models.predictions(models.fit_models(train), test))


@query
def tune_svc(spark, sf_dir):
    """The same for the tuned model."""
    run = _tuned(spark, sf_dir)
    return training.checked_metrics(models.predictions({"linear_svm": run.tuned}, run.test))


@query
def svc_grid_scores(spark, sf_dir):
    """Per grid point: is the score the mean F1 of its predictions for the folds it did not see?"""
    run = _tuned(spark, sf_dir)
    by_fold = reports.accuracy_and_f1(models.fold_predictions(run.tuned, run.train), ["params", "fold"])
    means = by_fold.groupBy("params").agg(F.count(F.lit(1)).alias("folds"), F.avg("f1").alias("mean"))
    same = (F.abs(F.col("f1") - F.col("mean")) < 1e-9).alias("same")
    return models.grid_scores(spark, run.tuned).join(means, "params").select("params", "folds", same)


@query
def svc_best_params(spark, sf_dir):
    """Per parameter: is it that of the best grid point, or else the default?"""
    tuned = _tuned(spark, sf_dir).tuned
    scores = tuned.avgMetrics
    best = tuned.getEstimatorParamMaps()[scores.index(max(scores))]
    defaults = LinearSVC()
    expected = {p.name: str(defaults.getOrDefault(p)) for p in defaults.params if defaults.hasDefault(p)}
    expected.update({param.name: str(value) for param, value in best.items()})
    wanted = spark.createDataFrame(list(expected.items()), "param string, expected string")
    found = models.best_parameters(spark, tuned).join(wanted, "param", "left")
    return found.select("param", F.col("value").eqNullSafe(F.col("expected")).alias("as_expected"))


@query
def svc_coefficients(spark, sf_dir):
    """Per input: its position, and whether the table gives the coefficient of that position."""
    run = _tuned(spark, sf_dir)
    svc = run.tuned.bestModel.stages[-1]
    inputs = list(zip(run.inputs, range(len(run.inputs)), map(float, svc.coefficients.toArray()), strict=True))
    placed = spark.createDataFrame(inputs, "feature string, position int, expected double")
    table = models.coefficients(spark, svc, run.inputs)
    return table.join(placed, "feature").select("feature", "position", (F.col("coefficient") == F.col("expected")).alias("same"))


@query
def churn_scores(spark, sf_dir):
    """All users scored by the saved and loaded model: binary, and by the sign of the margin?

    The margin is the sum of coefficients times values in long form.
    """
    features = churn.fill_song_measures(feature_table(spark, sf_dir))
    path = scratch_path(spark, "churn-model")
    models.save_model(_tuned(spark, sf_dir).model, path)
    loaded = models.load_model(path)
    scored = stored(loaded.transform(features).select("userId", "label", "features", "prediction"), "scores")
    margins = models.linear_margins(models.long_vectors(scored), loaded.stages[-1])
    return scored.join(margins, "userId").select(
        "userId",
        "label",
        F.col("prediction").isin(0.0, 1.0).alias("binary"),
        ((F.col("margin") > 0) == (F.col("prediction") == 1)).alias("by_margin"),
    )


@query
def churn_scores_check(spark, sf_dir):
    """For every user: is the loaded model's score one of 0 and 1, and that of the fitted model?"""
    features = churn.fill_song_measures(feature_table(spark, sf_dir))
    path = scratch_path(spark, "churn-model")
    fitted = _tuned(spark, sf_dir).model
    models.save_model(fitted, path)
    loaded = models.load_model(path).transform(features).select("userId", "label", "prediction")
    first = fitted.transform(features).select("userId", F.col("prediction").alias("fitted"))
    joined = loaded.join(first, "userId")
    return joined.select(
        "userId",
        "label",
        F.col("prediction").isin(0.0, 1.0).alias("binary"),
        (F.col("prediction") == F.col("fitted")).alias("same"),
    )


@query
def svc_search_check(spark, sf_dir):
    """Grid points scored, whether the chosen one is the highest, inputs with a coefficient."""
    run = _tuned(spark, sf_dir)
    scores = models.grid_scores(spark, run.tuned)
    names = models.coefficients(spark, run.tuned.bestModel.stages[-1], run.inputs)
    best = scores.agg(F.max("f1")).scalar()
    svc = run.tuned.bestModel.stages[-1]
    points = run.tuned.getEstimatorParamMaps()
    won = [all(svc.getOrDefault(p.name) == v for p, v in point.items()) for point in points].index(True)
    chosen = float(run.tuned.avgMetrics[won])
    inputs = names.agg(F.count_distinct("feature")).scalar()
    return scores.agg(
        F.count(F.lit(1)).alias("points"),
        F.max(F.lit(chosen) == best).alias("best_is_highest"),
        F.max(inputs).alias("inputs"),
    )


@query
def message_report(spark, sf_dir):
    """Whole forests on words as they are: does each report row follow from its predictions?"""
    return training.checked_report(cleaned(spark, sf_dir), CATEGORY_NAMES, lemmatise=False)


@query
def message_report_lemmas(spark, sf_dir):
    return training.checked_report(cleaned(spark, sf_dir), CATEGORY_NAMES)


@query
def message_grid(spark, sf_dir):
    """The script's whole grid and folds: fits per point, and whether its score follows from them."""
    return training.checked_search(cleaned(spark, sf_dir), CATEGORY_NAMES, multilabel.SCRIPT_GRID)


@query
def message_grid_notebook(spark, sf_dir):
    """The same for the notebook's grid."""
    return training.checked_search(cleaned(spark, sf_dir), CATEGORY_NAMES, multilabel.NOTEBOOK_GRID)


@query
def score_batch(spark, sf_dir):
    """Per message and label: is the score 0 or 1, and shown under the label's display name?"""
    model = _message_model(spark, sf_dir)
    source = views.messages(spark, sf_dir)
    shown = messages.assigned_from_map(multilabel.score_messages(model, source))
    wide = model.score(source).select("id", *[F.col(multilabel.prediction_column(n)).alias(n) for n in CATEGORY_NAMES])
    values = wide.unpivot(["id"], CATEGORY_NAMES, "category", "value")
    values = values.select("id", display_name("category").alias("display_name"), "value")
    return shown.join(values, ["id", "display_name"]).select(
        "id",
        "display_name",
        F.col("value").isin(0.0, 1.0).alias("binary"),
        (F.col("assigned") == (F.col("value") == 1)).alias("same"),
    )


@query
def stream_check(spark, sf_dir):
    """For every document: are the scores of the stream binary and those of the batch?"""
    model = _message_model(spark, sf_dir)
    flags = [multilabel.prediction_column(name) for name in CATEGORY_NAMES]
    batch = model.score(views.messages(spark, sf_dir)).select("id", F.array(*flags).alias("batch"))
    streamed = training.stream_scores(views.message_stream(spark, sf_dir), model)
    joined = streamed.select("id", F.array(*flags).alias("streamed")).join(batch, "id")
    return joined.select(
        "id",
        F.forall("streamed", lambda p: p.isin(0.0, 1.0)).alias("binary"),
        (F.col("streamed") == F.col("batch")).alias("same"),
    )


@query
def score_stream(spark, sf_dir):
    """The documents as a stream of messages: how often each came out, and with a score for every label?"""
    model = _message_model(spark, sf_dir)
    streamed = training.stream_scores(views.message_stream(spark, sf_dir), model)
    scored = F.array(*[F.col(multilabel.prediction_column(name)) for name in CATEGORY_NAMES])
    every = F.every(F.forall(scored, lambda p: p.isNotNull())).alias("scored")
    return streamed.groupBy("id", "genre").agg(F.count(F.lit(1)).alias("times"), every)
