import json

from helpers import rows_of
from pyspark.sql import functions as F

from tidemark.operators import terms
from tidemark.plans import jobs


def test_log_to_model(spark, tmp_path):
    lines = []
    for user in range(40):
        churned = user % 3 == 0
        pages = ["Home"] * (9 if churned else 1) + ["NextSong"] * 3
        if churned:
            pages.append("Cancellation Confirmation")
        for item, page in enumerate(pages):
            song = page == "NextSong"
            lines.append(
                {
                    "userId": str(user), "sessionId": user, "itemInSession": item, "ts": 1_600_000_000_000 + item * 1000,
                    "registration": 1_500_000_000_000, "page": page, "level": "free", "firstName": "A", "lastName": "B",
                    "gender": "F", "location": "X, CA", "userAgent": "M (iPad; x)",
                    **({"artist": "a", "song": f"s{item}", "length": 2.5} if song else {}),
                }
            )
    lines.append({"userId": "", "page": "Login", "ts": 1, "level": "free"})
    source = tmp_path / "log.json"
    source.write_text("\n".join(map(json.dumps, lines)))
    log = jobs.ingest_log(spark, str(source), str(tmp_path / "log"))
    assert log.count() == len(lines) - 1
    scores = jobs.churn_job(log, ["Home", "NextSong"], str(tmp_path / "model"), {"maxIter": [10], "regParam": [0.01]})
    row = scores.first()
    assert row.accuracy > 0.8 and row.f1 > 0.8


def test_files_to_message_model(spark, tmp_path):
    texts = ["water needed", "send water", "roads closed", "storm damage"]
    ids = range(80)
    rows = [f'{i},"{texts[i % 4]}, {i}",,direct' for i in ids] + ['0,"water needed, 0",,direct']
    (tmp_path / "m.csv").write_text("id,message,original,genre\n" + "\n".join(rows) + "\n")
    packed = [f"{i},related-{2 if i == 5 else 1};water-{int(i % 4 < 2)}" for i in ids]
    (tmp_path / "c.csv").write_text("id,categories\n" + "\n".join(packed) + "\n")
    table = jobs.message_etl(spark, str(tmp_path / "m.csv"), str(tmp_path / "c.csv"), ["related", "water"], str(tmp_path / "t"))
    assert table.columns == ["id", "message", "original", "genre", "related", "water"]
    assert table.count() == 80 and table.agg(F.max("related")).first()[0] == 1.0
    grid = [{"numTrees": 3, "maxDepth": 4}]
    report = jobs.message_training(table, str(tmp_path / "model"), grid, folds=2)
    scores = {(r.category, r.row): r.f1 for r in report.collect()}
    assert scores["water", "accuracy"] > 0.9 and scores["related", "accuracy"] == 1.0


def test_price_files(spark, tmp_path):
    (tmp_path / "c.csv").write_text('listing_id,date,price,adjusted_price\n1,2021-12-01,"$1,000.00",$9.00\n1,2021-12-02,$50.00,\n')
    (tmp_path / "l.csv").write_text("id,name,neighbourhood\n1,n,浦东 / Pudong\n")
    by_date, by_district = jobs.price_job(spark, str(tmp_path / "c.csv"), str(tmp_path / "l.csv"))
    assert rows_of(by_date, "price") == [(1000.0,), (50.0,)]
    assert rows_of(by_district, "neighbourhood", "price") == [("Pudong", 1000.0), ("Pudong", 50.0)]


def test_own_tokeniser(spark):
    df = spark.createDataFrame([(1, "A-b")], "id int, message string")
    assert terms.tokens(df, profile=lambda text: F.split(text, "-")).first().tokens == ["A", "b"]
