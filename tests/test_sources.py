"""CSV records over many blocks, units of work, row numbers."""

from __future__ import annotations

import csv
import os
import random
import subprocess
import sys

import pytest
from helpers import rows_of
from pyspark.sql import functions as F

from tidemark.operators import ranking, split
from tidemark.sources import MESSAGE_SCHEMA, Units, read_messages, read_table, write_csv
from tidemark.sources.files import csv_records

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


@pytest.fixture
def small_blocks(spark):
    """Blocks of a few hundred bytes, each read by a task of its own."""
    names = ["spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"]
    before = [spark.conf.get(name) for name in names]
    spark.conf.set(names[0], "300b")
    spark.conf.set(names[1], "0b")
    yield
    for name, value in zip(names, before, strict=True):
        spark.conf.set(name, value)


def message_rows(seed, many):
    rng = random.Random(seed)
    parts = ["word ", "line\n", 'quote" ', '""', ", ", "\r\n", "é日", "x" * 40, "\n\n"]
    rows = []
    for i in range(many):
        text = "t" + "".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) + "t"
        rows.append((i, text, rng.choice([None, "o\n" * 30 + "o"]), rng.choice(["direct", "news"])))
    return rows


@pytest.mark.parametrize("ending", ["\n", "\r\n"])
def test_records_of_one_file_in_many_tasks(spark, tmp_path, small_blocks, ending):
    rows = message_rows(1, 200)
    path = str(tmp_path / "m.csv")
    with open(path, "w", newline="") as out:
        writer = csv.writer(out, lineterminator=ending)
        writer.writerow(["id", "message", "original", "genre"])
        writer.writerows(rows)
    lines = spark.read.text(path, lineSep="\n")
    assert lines.select("_metadata.file_block_start").distinct().count() > 20
    assert lines.rdd.getNumPartitions() > 20
    assert csv_records(spark, path).count() == len(rows)
    assert rows_of(read_messages(spark, path)) == sorted(rows, key=repr)


def test_records_of_many_files_are_those_of_sparks_reader(spark, tmp_path, small_blocks):
    path = str(tmp_path / "m")
    rows = spark.createDataFrame(message_rows(2, 150), MESSAGE_SCHEMA)
    write_csv(rows.repartition(4), path)
    reader = spark.read.option("header", True).option("multiLine", True).option("escape", '"')
    want = reader.csv(path).withColumn("id", F.col("id").cast("bigint"))
    assert rows_of(read_messages(spark, path)) == rows_of(want) == rows_of(rows)


def test_odd_csv_files(spark, tmp_path, small_blocks):
    texts = {
        "header only": "id,message,original,genre\n",
        "no last line end": 'id,message,original,genre\n1,"a\nb",,x',
        "blank lines": "id,message,original,genre\n\n1,a,,x\n\n\n2,b,,x\n\n",
        "header over two lines": '"id","message","original","genre","more\nof it"\n1,a,,x,\n',
        "other order": "genre,id,more,message,original\nx,1,z,a,\n",
    }
    found = {}
    for k, (name, text) in enumerate(texts.items()):
        path = tmp_path / f"{k}.csv"
        path.write_text(text)
        found[name] = rows_of(read_messages(spark, str(path)))
    one = [(1, "a", None, "x")]
    assert found == {
        "header only": [],
        "no last line end": [(1, "a\nb", None, "x")],
        "blank lines": [*one, (2, "b", None, "x")],
        "header over two lines": one,
        "other order": one,
    }


# Units -------------------------------------------------------------------------------


def test_units_are_made_once_and_only_if_they_are_not_listed(spark, tmp_path):
    path, made = str(tmp_path / "work"), []

    def make(value):
        made.append(value)
        return spark.createDataFrame([(value,)], "v int")

    first = Units(spark, path)
    assert rows_of(first.table("a/b", lambda: make(1))) == [(1,)]
    with pytest.raises(RuntimeError):
        first.run("c", lambda place: (make(2).write.parquet(place), (_ for _ in ()).throw(RuntimeError("lost"))))
    again = Units(spark, path)
    assert again.has("a/b") and not again.has("c")
    assert rows_of(again.table("a/b", lambda: make(3))) == [(1,)]
    # What the lost job left is replaced.
    assert rows_of(again.table("c", lambda: make(4))) == [(4,)]
    assert made == [1, 2, 4] and Units(spark, path).names() == ["a/b", "c"]


def test_a_folder_of_another_job_is_refused(spark, tmp_path):
    path = str(tmp_path / "work")
    Units(spark, path, "one")
    Units(spark, path, "one")
    with pytest.raises(ValueError, match="another job"):
        Units(spark, path, "two")


def test_scratch_is_released_for_this_application_only(tmp_path):
    """In a process of its own: the folder goes, with nothing beside it."""
    script = f"""
import sys
sys.path.insert(0, {ROOT!r})
from tidemark.session import build_session, release_scratch
from tidemark.sources import stored
spark = build_session(master="local[1]", settings={{"spark.ui.enabled": "false", "spark.checkpoint.dir": {str(tmp_path)!r}}})
spark.range(3).write.parquet({str(tmp_path / "tidemark" / "other")!r})
assert stored(spark.range(5), "some").count() == 5
assert release_scratch(spark) and not release_scratch(spark)
"""
    subprocess.run([sys.executable, "-c", script], check=True, capture_output=True)
    assert [p.name for p in (tmp_path / "tidemark").iterdir()] == ["other"]


# Numbers -------------------------------------------------------------------------------


def test_numbers_follow_the_order_over_all_parts(spark):
    rows = spark.range(10_000).select(((F.col("id") * 7919) % 10_007).alias("v"))
    found = ranking.numbered(rows, [F.desc("v")], "place")
    want = sorted((r.v for r in rows.collect()), reverse=True)
    assert [r.v for r in found.orderBy("place").collect()] == want
    assert rows_of(found.select("place")) == rows_of(spark.range(10_000))
    assert ranking.numbered(rows.limit(0), [F.asc("v")], "place").count() == 0


def test_index_of_many_values_has_no_window_over_them_all(spark):
    many = 100_000
    rows = spark.range(many * 2).select(F.concat(F.lit("v"), F.least(F.col("id"), F.lit(many - 1)).cast("string")).alias("s"))
    found = split.frequency_index(rows, "s")
    assert "Window" not in found._jdf.queryExecution().toString()
    assert found.count() == many == found.select("index").distinct().count()
    top = found.orderBy("index").limit(3).collect()
    assert [(r.s, r["count"], r["index"]) for r in top] == [(f"v{many - 1}", many + 1, 0.0), ("v0", 1, 1.0), ("v1", 1, 2.0)]


def test_tables_are_read_with_the_schema_given(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    from pyspark.sql.types import LongType, StructField, StructType

    assert read_table(spark, path, StructType([StructField("id", LongType()), StructField("no", LongType())])).columns == ["id", "no"]
