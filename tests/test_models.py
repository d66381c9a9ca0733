import pytest
from helpers import rows_of
from pyspark.errors import StreamingQueryException
from pyspark.ml.feature import HashingTF
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tidemark.operators import models, multilabel, reports, terms
from tidemark.plans import training
from tidemark.sources import MESSAGE_SCHEMA, Units
from tidemark.streaming import scoring

FOREST = {"numTrees": 3, "maxDepth": 4}
NAMES = ["water", "none"]


@pytest.fixture(scope="module")
def features(spark):
    """Users whose churn follows one measure."""
    base = spark.range(60).select(
        (F.col("id") % 3 == 0).cast("int").alias("label"),
        F.col("id").cast("string").alias("userId"),
        F.when(F.col("id") % 2 == 0, "F").otherwise("M").alias("gender"),
        F.lit("TX").alias("state"),
        F.when(F.col("id") != 7, "iPhone").alias("device"),
        *[F.lit(None).cast("double").alias(f"{m}_length") for m in ("sum", "mean", "max", "min", "median")],
        F.lit(0).alias("num_songs"),
    )
    return base.withColumn("visits", F.col("label") * 10 + F.col("userId").cast("int") % 4)


@pytest.fixture(scope="module")
def run(features):
    return training.tune_churn(features, {"maxIter": [10], "regParam": [0.01, 0.1]}, folds=2)


def test_inputs_are_ordered_and_explained(spark, run):
    assert run.inputs[-3:] == ["gender_idx", "state_idx", "device_idx"]
    assert "userId" not in run.inputs and "label" not in run.inputs
    svc = run.tuned.bestModel.stages[-1]
    table = models.coefficients(spark, svc, run.inputs)
    assert table.first().feature == "visits"
    assert len(rows_of(table)) == len(run.inputs) == run.train.first().features.size
    params = dict(rows_of(models.best_parameters(spark, run.tuned)))
    assert params["maxIter"] == "10" and params["regParam"] in ("0.01", "0.1")
    assert len(rows_of(models.grid_scores(spark, run.tuned))) == 2


def test_model_beats_the_majority_and_survives_saving(features, run, tmp_path):
    from tidemark.plans.churn import fill_song_measures

    results = run.tuned.transform(run.test)
    for name, evaluator in models.evaluators().items():
        sql = reports.accuracy_and_f1(results.withColumn("m", F.lit(1)), ["m"]).first()[name]
        assert evaluator.evaluate(results) == pytest.approx(sql)
        assert sql > 0.7
    path = str(tmp_path / "model")
    models.save_model(run.model, path)
    filled = fill_song_measures(features)
    columns = ["userId", "prediction"]
    before = rows_of(run.model.transform(filled), *columns)
    assert rows_of(models.load_model(path).transform(filled), *columns) == before


def test_margins_by_a_join_are_those_of_the_model(run):
    scored = run.tuned.transform(run.test)
    margins = models.linear_margins(models.long_vectors(scored), run.tuned.bestModel.stages[-1])
    got = dict(rows_of(margins, "userId", "margin"))
    want = {r.userId: float(r.rawPrediction[1]) for r in scored.collect()}
    assert got == pytest.approx(want)


def test_fold_predictions_give_the_search_its_scores(spark, run):
    rows = models.fold_predictions(run.tuned, run.train)
    assert rows.count() == 2 * run.train.count()
    by_fold = reports.accuracy_and_f1(rows, ["params", "fold"]).groupBy("params").agg(F.avg("f1")).collect()
    assert dict(map(tuple, by_fold)) == pytest.approx(dict(rows_of(models.grid_scores(spark, run.tuned))))


def test_split_has_no_user_on_both_sides(run):
    assert run.train.join(run.test, "userId").count() == 0
    assert run.train.count() + run.test.count() == 60


def test_compare_models(run):
    few = {n: m for n, m in models.classifiers().items() if n in ("decision_tree", "linear_svm")}
    assert set(models.classifiers()) == {
        "logistic_regression",
        "linear_svm",
        "decision_tree",
        "random_forest",
        "gradient_boosting",
    }
    got = models.compare_models(run.train, run.test, few)
    assert {r.model for r in got.collect()} == set(few)


def test_one_class_is_refused(spark):
    df = spark.createDataFrame([(0, Vectors.dense(1.0), "a")], ["label", "features", "userId"])
    with pytest.raises(ValueError, match="two are needed"):
        models.tune_svc(df)


@pytest.fixture(scope="module")
def messages(spark):
    texts = ["need water now", "water bottles please", "send waters", "road blocked", "storm road", "lights out"]
    rows = [(i, texts[i % 6], None, "direct", float(i % 6 < 3), 0.0) for i in range(48)]
    return spark.createDataFrame(
        rows, "id bigint, message string, original string, genre string, water double, none double"
    )


@pytest.fixture(scope="module")
def message_model(messages):
    return multilabel.fit_messages(messages, NAMES, FOREST, lemmatise=True)


def term_weights(vectoriser, vectors):
    """{id: {term: weight}} of vectors."""
    names = {r.position: r.term for r in vectoriser.numbers.collect()}
    rows = vectors.select("id", "features").collect()
    return {r.id: {names[i]: v for i, v in zip(r.features.indices, r.features.values)} for r in rows}


def test_vectors_have_unit_length_and_the_long_form_weights(messages):
    words = multilabel.tokenise(messages)
    vectoriser = multilabel.fit_vectors(words)
    vectors = vectoriser.transform(words)
    assert vectors.columns == [c for c in words.columns if c != "tokens"] + ["features"]
    row = vectors.filter("id = 1").first().features
    assert row.norm(2) == pytest.approx(1.0) and row.size == vectoriser.size
    long = terms.tfidf(terms.term_counts(terms.exploded(words)), messages)
    want: dict = {}
    for r in long.collect():
        want.setdefault(r.id, {})[r.term] = r.weight
    got = term_weights(vectoriser, vectors)
    assert got.keys() == want.keys()
    assert all(got[i] == pytest.approx(want[i]) for i in want)


def test_terms_are_numbered_by_frequency_then_name(messages):
    numbers = multilabel.number_terms(multilabel.tokenise(messages)).orderBy("position").collect()
    assert [r.position for r in numbers] == list(range(len(numbers)))
    assert [r.term for r in numbers] == [r.term for r in sorted(numbers, key=lambda r: (-r.df, r.term))]
    few = multilabel.number_terms(multilabel.tokenise(messages), min_df=9).collect()
    assert {r.term for r in few} == {r.term for r in numbers if r.df >= 9} and len(few) < len(numbers)


def test_vectors_of_odd_lists(spark):
    rows = [(1, ["a", "b", "a"]), (1, ["b"]), (1, ["b"]), (2, []), (3, None), (None, ["a", None]), (4, ["unseen"])]
    words = spark.createDataFrame(rows, "id bigint, tokens array<string>")
    vectoriser = multilabel.fit_vectors(words.filter("id is null or id < 4"))
    found = vectoriser.transform(words).collect()
    assert len(found) == 7 and {r.features.size for r in found} == {2}
    lists = sorted((r.id or 0, len(r.features.indices), round(float(sum(r.features.values**2)), 9)) for r in found)
    assert lists == [(0, 1, 1.0), (1, 1, 1.0), (1, 1, 1.0), (1, 2, 1.0), (2, 0, 0.0), (3, 0, 0.0), (4, 0, 0.0)]
    nothing = words.limit(0)
    assert multilabel.fit_vectors(nothing).transform(nothing).count() == 0


def test_features_are_terms_unless_asked(messages):
    words = multilabel.tokenise(messages)
    hashed = multilabel.fit_vectors(words, features="hashing")
    assert isinstance(hashed.pipeline.stages[0], HashingTF)
    assert hashed.transform(words).first().features.norm(2) == pytest.approx(1.0)
    with pytest.raises(ValueError, match="unknown"):
        multilabel.fit_vectors(words, features="other")


def test_more_terms_than_hashed_positions(spark):
    rows = [(i, " ".join(f"w{i}x{k}" for k in range(2000)) + (" good" if i % 2 else " bad")) for i in range(150)]
    messages = spark.createDataFrame(rows, "id bigint, message string")
    words = multilabel.tokenise(messages)
    vectoriser = multilabel.fit_vectors(words)
    assert vectoriser.size == 300_002 > multilabel.NUM_FEATURES
    vectors = vectoriser.transform(words).collect()
    assert all(len(r.features.indices) == 2001 and r.features.norm(2) == pytest.approx(1.0) for r in vectors)
    # Every position but two occurs once, so no two terms share one.
    used = [i for r in vectors for i in r.features.indices]
    assert len(set(used)) == 300_002
    hashed = multilabel.fit_vectors(words, features="hashing").transform(words).first()
    assert 100_000 < hashed.features.size < multilabel.NUM_FEATURES


def test_null_labels_and_empty_folds(spark, message_model, messages):
    scored = message_model.score(messages)
    unknown = scored.withColumn("water", F.lit(None).cast("double"))
    assert multilabel.subset_accuracy(unknown, ["water"]).first()[0] == 1.0
    with pytest.raises(ValueError, match="folds"):
        multilabel.grid_search(messages.filter("id = 1"), NAMES, [FOREST], folds=2)


def test_scores_reports_and_one_class_labels(message_model, messages):
    scored = message_model.score(messages)
    report = {(r.category, r.row): r for r in multilabel.label_reports(scored, NAMES).collect()}
    assert report["water", "accuracy"].f1 > 0.9
    assert report["none", "0"].support == 48 and report["none", "0"].recall == 1.0
    assert multilabel.subset_accuracy(scored, NAMES).first()[0] > 0.9
    new = messages.select("id", "message").limit(1)
    labels = multilabel.score_messages(message_model, new).first().labels
    assert set(labels) == set(NAMES) and labels["none"] == 0


def test_saved_model_scores_batch_and_stream_alike(spark, message_model, messages, tmp_path):
    path = str(tmp_path / "model")
    message_model.save(path)
    loaded = multilabel.MessageModel.load(spark, path)
    assert loaded.names == NAMES and loaded.lemmas is not None
    plain = messages.select("id", "message", "original", "genre")
    want = rows_of(message_model.score(plain))
    assert rows_of(loaded.score(plain)) == want

    source = str(tmp_path / "in")
    plain.repartition(3).write.parquet(source)
    stream = scoring.read_message_stream(spark, source, MESSAGE_SCHEMA, maxFilesPerTrigger="2")
    target, checkpoint = str(tmp_path / "out"), str(tmp_path / "log")
    scoring.score_stream(stream, loaded, target, checkpoint).awaitTermination()
    assert rows_of(scoring.read_scores(spark, target)) == want
    # Nothing new: a second run adds nothing.
    scoring.score_stream(stream, loaded, target, checkpoint).awaitTermination()
    assert rows_of(scoring.read_scores(spark, target)) == want


def test_grid_search(messages):
    grid = [{**FOREST, "minInstancesPerNode": 2}, {"numTrees": 1, "maxDepth": 1, "minInstancesPerNode": 40}]
    best, scores = multilabel.grid_search(messages, NAMES, grid, folds=2)
    assert best == grid[0] and len(rows_of(scores)) == 2
    assert len(multilabel.SCRIPT_GRID) == 4 and len(multilabel.NOTEBOOK_GRID) == 6


class Lost(Exception):
    pass


@pytest.fixture
def fits(monkeypatch):
    """Counts forests that are fitted, and ends the job after ``limit`` of them."""
    state = {"done": 0, "limit": None}
    plain = multilabel._forest

    class Counted:
        def __init__(self, forest):
            self.forest = forest

        def fit(self, rows):
            if state["limit"] is not None and state["done"] >= state["limit"]:
                raise Lost
            state["done"] += 1
            return self.forest.fit(rows)

    monkeypatch.setattr(multilabel, "_forest", lambda name, params: Counted(plain(name, params)))
    return state


def test_a_search_that_was_stopped_goes_on(messages, tmp_path, fits):
    grid = [{**FOREST, "minInstancesPerNode": 2}, {"numTrees": 1, "maxDepth": 1, "minInstancesPerNode": 40}]
    options = {"folds": 2, "parallelism": 1}
    _, whole = multilabel.grid_search(messages, NAMES, grid, **options)
    assert fits["done"] == 2 * 2 * 2
    work = str(tmp_path / "work")
    fits.update(done=0, limit=5)
    with pytest.raises(Lost):
        multilabel.grid_search(messages, NAMES, grid, work=work, **options)
    assert fits["done"] == 5
    fits.update(done=0, limit=None)
    best, resumed = multilabel.grid_search(messages, NAMES, grid, work=work, **options)
    assert fits["done"] == 3 and best == grid[0]
    assert rows_of(resumed) == rows_of(whole)
    # All is finished: nothing is fitted. Other rows or points are another search.
    multilabel.grid_search(messages, NAMES, grid, work=work, **options)
    assert fits["done"] == 3
    for other, points in ((messages.filter("id > 0"), grid), (messages, grid[:1])):
        with pytest.raises(ValueError, match="another job"):
            multilabel.grid_search(other, NAMES, points, work=work, **options)


def test_a_fit_that_was_stopped_goes_on(messages, message_model, tmp_path, fits):
    work = str(tmp_path / "work")
    fits["limit"] = 1
    with pytest.raises(Lost):
        multilabel.fit_messages(messages, NAMES, FOREST, parallelism=1, work=work)
    fits.update(done=0, limit=None)
    resumed = multilabel.fit_messages(messages, NAMES, FOREST, parallelism=1, work=work)
    assert fits["done"] == 1
    assert rows_of(resumed.score(messages)) == rows_of(message_model.score(messages))


def test_readers_see_finished_batches_only(spark, message_model, messages, tmp_path):
    plain = messages.select("id", "message", "original", "genre")
    source, target, checkpoint = (str(tmp_path / name) for name in ("in", "out", "log"))
    plain.repartition(4, "id").write.parquet(source)
    stream = scoring.read_message_stream(spark, source, MESSAGE_SCHEMA, maxFilesPerTrigger="1")
    want = rows_of(message_model.score(plain))
    seen = []

    class Dying:
        """A model whose third batch writes some rows, and dies."""

        names = NAMES

        def score(self, batch):
            seen.append(scoring.read_scores(spark, target).count())
            if len(seen) == 3:
                place = Units(spark, target).location("batch=2")
                message_model.score(batch).limit(1).write.parquet(place)
                raise Lost("third batch")
            return message_model.score(batch)

    with pytest.raises(StreamingQueryException):
        scoring.score_stream(stream, Dying(), target, checkpoint).awaitTermination()
    half = rows_of(scoring.read_scores(spark, target))
    # Before each batch, and after the death, exactly the batches before it.
    assert seen[0] == 0 and 0 < seen[1] < seen[2] == len(half) < len(want)
    assert set(half) < set(want)
    scoring.score_stream(stream, message_model, target, checkpoint).awaitTermination()
    assert rows_of(scoring.read_scores(spark, target)) == want
    assert len(Units(spark, target).names()) == 5


@pytest.mark.parametrize("parts", [0, 3])
def test_stream_reads_one_file_or_a_folder_of_parts(spark, message_model, tmp_path, sf_dir, parts):
    import shutil

    from tidemark.sources import driver_tables

    target = str(tmp_path / "documents.parquet")
    if parts:
        spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(parts).write.parquet(target)
    else:
        shutil.copyfile(f"{sf_dir}/documents.parquet", target)
    stream = driver_tables.message_stream(spark, str(tmp_path))
    scored = training.stream_scores(stream, message_model)
    assert scored.count() == driver_tables.messages(spark, str(tmp_path)).count() > 0
