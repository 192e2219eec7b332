"""The sink of named text files."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from veilmark.plans import redact
from veilmark.sources import named


def contents(folder):
    return {n: (folder / n).read_bytes().decode() for n in os.listdir(folder) if n != named.DONE}


def test_one_file_a_row(spark, tmp_path):
    out = tmp_path / "out"
    out.mkdir()
    (out / "old.txt").write_text("stale")
    texts = {f"d{i}.txt": ("" if i == 3 else f"line {i}\r\nünïcode — {i}\n" * (i % 4)) for i in range(60)}
    texts["long.txt"] = "0123456789" * 300_000
    rows = [(n, None if n == "d3.txt" else t, 1) for n, t in texts.items()]
    df = spark.createDataFrame(rows, "n string, value string, name int").repartition(7)  # clashing names
    named.write_named(df, str(out), F.col("n"), F.col("value"))
    assert contents(out) == texts
    assert (out / named.DONE).exists() and not (out / named.STAGED).exists()
    named.write_named(df.limit(0), f"file:{out}", F.col("n"), F.col("value"))
    assert contents(out) == {}


def test_append_replaces_and_keeps(spark, tmp_path):
    out = tmp_path / "out"
    named.register(spark)
    for rows in ([("a.txt", "1"), ("b.txt", "1")], [("b.txt", "2"), ("c.txt", "2")]):
        spark.createDataFrame(rows, "name string, value string").write.format("named_text").mode("append").save(str(out))
    assert contents(out) == {"a.txt": "1", "b.txt": "2", "c.txt": "2"}


def test_names_that_cannot_be_files(spark, tmp_path):
    out, schema = tmp_path / "out", "name string, value string"
    for bad in (None, "", "a/b", ".hidden", "_x"):
        df = spark.createDataFrame([("ok.txt", "1"), (bad, "2")], schema).coalesce(1)
        with pytest.raises(Exception, match="no name of a file"):
            named.write_named(df, str(out), F.col("name"), F.col("value"))
        assert contents(out) == {}  # what the failed attempts wrote is gone
    twice = spark.createDataFrame([("a", "1"), ("b", "2"), ("a", "3")], schema).repartition(3)
    with pytest.raises(ValueError, match="repeat"):
        named.write_named(twice, str(out), F.col("name"), F.col("value"))


def test_a_repeated_attempt_changes_nothing(tmp_path):
    writer = named.NamedTextWriter(str(tmp_path / "out"))
    rows = [("a.txt", "1"), ("b.txt", "2")]
    lost = writer.write(iter(rows))  # its executor is lost after the renames
    again = writer.write(iter(rows))
    assert lost.files == again.files == 2
    writer.commit([None, again])
    assert contents(tmp_path / "out") == {"a.txt": "1", "b.txt": "2"}


def test_other_jobs_keep_their_attempts(tmp_path):
    one, two = (named.NamedTextWriter(str(tmp_path / "out")) for _ in range(2))
    open_attempt = tmp_path / "out" / named.STAGED / two.job
    open_attempt.mkdir(parents=True)
    one.commit([one.write(iter([("a", "1")]))])
    assert open_attempt.exists()
    two.abort([])
    assert not open_attempt.exists()


def test_folder_job_with_named_files(spark, tmp_path):
    box, out = tmp_path / "in", tmp_path / "out"
    box.mkdir()
    (box / "a.txt").write_text("mail a.b@example.com\n")
    (box / "b.v2.txt").write_text("nothing")
    (box / "bad.txt").write_bytes(b"\xff\xfe")
    redact.redact_folder(spark, str(box), str(out), style="category_specific", named_files=True).collect()
    assert contents(out / "named_files") == {"a_redacted.txt": "mail [EMAIL]\n", "b.v2_redacted.txt": "nothing"}
