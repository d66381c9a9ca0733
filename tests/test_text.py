import math
from collections import Counter

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from tidemark.functions import clean_text, drop_stop_words, serving_words, split_words, training_words
from tidemark.operators import multilabel, terms
from tidemark.plans import registry, wording


def _one(spark, text, function):
    return spark.createDataFrame([(text,)], "t string").select(function(F.col("t"))).first()[0]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("HTTP://X y", "urlplaceholder y"),
        ("a b c", "a b c"),
        ("¿Qué? ", "qué"),
        ("it's  #1!\n", "it s 1"),
        ("", ""),
    ],
)
def test_clean_text(spark, text, want):
    assert _one(spark, text, clean_text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("$5 a<b", ["$", "5", "a", "<", "b"]),
        ("cannot cannot gonna", ["can", "not", "can", "not", "gon", "na"]),
        ("wanna go wanna", ["wan", "na", "go", "wan", "na"]),
        ("wannabe iwanna", ["wannabe", "iwanna"]),
        ("scannot cannots", ["scannot", "cannots"]),
        ("``x", ["``", "x"]),
        ("", []),
    ],
)
def test_split_words(spark, text, want):
    assert _one(spark, text, split_words) == want


def test_stop_words_and_serving_form(spark):
    assert _one(spark, "The cars don't stop at http://a.b/c now", training_words) == [
        "cars",
        "stop",
        "urlplaceholder",
    ]
    words = spark.createDataFrame([(["the", "x", "x"],)], "t array<string>")
    assert words.select(drop_stop_words("t")).first()[0] == ["x", "x"]
    assert _one(spark, "Cars, at 10:30 (now).", serving_words) == [
        "Cars",
        ",",
        "at",
        "10:30",
        "(",
        "now",
        ")",
        ".",
    ]


DOCS = ["cars car boxes box", "wolves ladies lady men", "the", "man car buses bus"]


def _docs(spark):
    rows = [(i, t) for i, t in enumerate(DOCS)]
    return spark.createDataFrame(rows, "id bigint, message string")


def test_lemmas_need_a_known_term(spark):
    words = terms.tokens(_docs(spark))
    lemmas = terms.noun_lemmas(terms.vocabulary(words))
    assert dict(rows_of(lemmas)) == {
        "cars": "car",
        "boxes": "box",
        "ladies": "lady",
        "men": "man",
        "buses": "bus",
    }
    wolf = spark.createDataFrame([("wolf",)], "term string")
    assert dict(rows_of(terms.noun_lemmas(terms.vocabulary(words), wolf))) == {"wolves": "wolf"}


def test_lemmatised_lists_keep_order_and_empty_lists(spark):
    got = dict(rows_of(wording.lemmatised(terms.tokens(_docs(spark))), "id", "tokens"))
    assert got == {
        0: ["car", "car", "box", "box"],
        1: ["wolves", "lady", "lady", "man"],
        2: [],
        3: ["man", "car", "bus", "bus"],
    }


def test_serving_lemmas_are_looked_up_before_lower_case(spark):
    docs = spark.createDataFrame([(1, "Cars cars car Car")], "id bigint, message string")
    words = wording.lemmatised(terms.tokens(docs, profile="serve"), lower_after=True)
    assert words.first().tokens == ["car", "car", "car", "car"]


def test_tfidf_against_brute_force(spark):
    docs = _docs(spark)
    words = terms.tokens(docs)
    forms = terms.term_counts(terms.exploded(words))
    counts = terms.lemma_counts(forms, terms.noun_lemmas(forms))
    got = {(r.id, r.term): r.weight for r in terms.tfidf(counts, docs).collect()}
    stored = {(r.id, r.term): r.weight for r in wording.message_tfidf(words).collect()}
    assert stored == pytest.approx(got)
    lists = {0: "car car box box", 1: "wolves lady lady man", 3: "man car bus bus"}
    counted = {i: Counter(t.split()) for i, t in lists.items()}
    frequency = Counter(t for c in counted.values() for t in c)
    want = {}
    for i, c in counted.items():
        raw = {t: n * (math.log(5 / (1 + frequency[t])) + 1) for t, n in c.items()}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        want.update({(i, t): w / norm for t, w in raw.items()})
    assert got == pytest.approx(want)
    assert rows_of(terms.document_frequency(counts), "term", "df") == sorted(frequency.items())


def test_all_kinds_of_blank_part_words(spark):
    assert _one(spark, "a\u0085b\x1cc\x1fd e", clean_text) == "a b c d e"


def test_terms_of_one_document_are_not_looked_up(spark, monkeypatch):
    tables = {}

    def stored(df, name):
        tables[name] = df.collect()
        return spark.createDataFrame(tables[name], df.schema)

    monkeypatch.setattr(wording, "stored", stored)
    docs = spark.createDataFrame([(1, "storm road road"), (2, "storm roof"), (None, "storm gate")], "id int, message string")
    got = {(r.id, r.term): r.weight for r in wording.message_tfidf(terms.tokens(docs)).collect()}
    assert [tuple(row) for row in tables["document-frequency"]] == [("storm", 3)]
    rare = math.log(4 / 2) + 1
    assert got[1, "road"] == pytest.approx(2 * rare / math.hypot(2 * rare, 1)) and len(got) == 6
    assert got[None, "gate"] == pytest.approx(rare / math.hypot(rare, 1))


def test_messages_that_share_an_id_keep_their_own_lemmas(spark):
    docs = spark.createDataFrame(
        [(1, "cars stop"), (1, "storm road"), (2, "car roads"), (None, "roads"), (3, "")],
        "id int, message string",
    )
    got = rows_of(wording.lemmatised(terms.tokens(docs)), "id", "tokens")
    assert sorted(tokens for _, tokens in got) == [[], ["car", "road"], ["car", "stop"], ["road"], ["storm", "road"]]


def _optimized(df):
    return df._jdf.queryExecution().optimizedPlan().toString().splitlines()


def test_list_digests_are_computed_once_per_list(spark):
    lists = spark.createDataFrame([(1, ["cats", "cat", "cats"]), (2, []), (None, ["dogs"])], "id long, tokens array<string>")
    lemmas = spark.createDataFrame([("cats", "cat"), ("dogs", "dog")], "form string, lemma string")
    assert sorted(r.term for r in terms.listed_terms(lists).collect()) == ["cat", "cats", "cats", "dogs"]
    for df in (terms.listed_terms(lists), terms.lemmatise(lists, lemmas)):
        plan = _optimized(df)
        explode = next(i for i, line in enumerate(plan) if "Generate" in line)
        assert not [line for line in plan[max(0, explode - 3) : explode] if "xxhash64(" in line]
        assert "xxhash64(" in plan[explode + 1]
    got = {r.id: r.tokens for r in terms.lemmatise(lists, lemmas).collect()}
    assert got == {1: ["cat", "cat", "cat"], 2: [], None: ["dog"]}


def test_norms_are_computed_once_per_vector(spark):
    lists = spark.createDataFrame([(1, ["a", "b", "a"]), (2, []), (None, ["b"])], "id long, tokens array<string>")
    vectoriser = multilabel.fit_vectors(lists)
    rows = multilabel.long_rows(vectoriser.rows(lists))
    assert not [line for line in _optimized(rows) if "Filter" in line and "aggregate(" in line]
    squares = rows.groupBy("id").agg(F.sum(F.col("weight") * F.col("weight")).alias("s"), F.count("weight").alias("n"))
    assert {r.id: (round(r.s, 9), r.n) for r in squares.collect()} == {1: (1.0, 2), None: (1.0, 1)}


def test_tasks_of_word_jobs_do_not_grow_with_the_input(spark, sf_dir):
    counts = terms.term_counts(terms.exploded(registry.tokenised(spark, sf_dir)))
    assert ", 1000)" in counts._jdf.queryExecution().executedPlan().toString()
    merged = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert (merged, spark.conf.get("spark.sql.files.maxPartitionBytes")) == ("16m", "32m")
