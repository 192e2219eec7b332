"""Files in, files out, and the folder stream."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from veilmark.functions import labels as lb
from veilmark.operators import profile
from veilmark.plans import corpus, redact
from veilmark.sources import files, synth
from veilmark.streaming import folder


@pytest.fixture
def inbox(tmp_path):
    box = tmp_path / "in"
    box.mkdir()
    (box / "a.txt").write_text("mail a.b@example.com\nline two\n", encoding="utf-8")
    (box / "b.v2.txt").write_text("ip 10.20.30.40 — ünïcode", encoding="utf-8")
    (box / "broken.txt").write_bytes(b"\xff\xfe broken 1.2.3.4")
    (box / "empty.txt").write_text("")
    (box / "skip.md").write_text("a.b@example.com")
    return box


def test_one_file(spark, inbox):
    row = files.read_text(spark, str(inbox / "a.txt")).first()
    assert row["text"] == "mail a.b@example.com\nline two\n" and row["doc_id"] == "a" and row["error"] is None


def test_folder_job(spark, inbox, tmp_path):
    out = tmp_path / "out"
    summary = redact.redact_folder(spark, str(inbox), str(out), style="category_specific", text_files=True).first()
    names = {r["name"] for r in spark.read.text(str(out / "text_files")).collect()}
    assert names and all("_redacted" in n for n in names)
    assert tuple(summary) == (3, 2, 1, 2)
    texts = {r["output_file"].rsplit("/", 1)[1]: r["value"] for r in spark.read.json(f"{out}/text").collect()}
    assert texts == {"a_redacted.txt": "mail [EMAIL]\nline two\n", "b.v2_redacted.txt": "ip [IP_ADDRESS] — ünïcode"}
    details = {r["details_file"].rsplit("/", 1)[1]: r for r in spark.read.json(f"{out}/details").collect()}
    assert set(details) == {"a_redaction_details.json", "b.v2_redaction_details.json"}
    assert details["a_redaction_details.json"]["statistics"]["entity_count"] == 1
    assert spark.read.json(f"{out}/files").agg(F.sum("entity_count")).first()[0] == 2


def test_stream_picks_up_new_files_once(spark, inbox, tmp_path):
    args = (spark, str(inbox), str(tmp_path / "sink"), str(tmp_path / "state"), "category_specific")
    folder.redact_stream(*args, max_files=1).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "sink"))
    assert rows.count() == 3 and rows.where("error IS NOT NULL").count() == 1
    (inbox / "late.txt").write_text("call 555-123-4567")
    folder.redact_stream(*args).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "sink"))
    got = {r["doc_id"]: r["result"]["redacted_text"] for r in rows.where("error IS NULL").collect()}
    assert rows.count() == 4 and got["late"] == "call [PHONE]" and got["a"] == "mail [EMAIL]\nline two\n"


def test_table_stream(spark, tmp_path):
    source = tmp_path / "events"
    spark.createDataFrame([(1, "a.b@example.com"), (2, "none")], "id long, text string").write.parquet(str(source))
    stream = spark.readStream.schema("id long, text string").parquet(str(source))
    folder.redact_table_stream(stream, str(tmp_path / "o"), str(tmp_path / "c")).awaitTermination()
    assert {r["id"]: r["result"]["redacted_text"] for r in spark.read.parquet(str(tmp_path / "o")).collect()} == {1: "[REDACTED]", 2: "none"}


RAW = '''id,Filled Template,Tokens
1," Ann lives, here ","['B-NAME', 'O', 'O']"
2,"two
lines","['O', 'O']"
3,extra,"['O']",too,many
4,short
5,"bad literal","not a list"
6,"quote ""x"" end",""
'''


def test_raw_corpus(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text(RAW)
    raw = files.read_raw_corpus(spark, str(path), ["id", "Filled Template", "Tokens"])
    rows = {r["text"]: r["labels"] for r in files.clean_corpus(files.map_corpus(raw)).collect()}
    assert rows == {
        "Ann lives, here": ["B-NAME", "O", "O"], "two\nlines": ["O", "O"], "short": [], "bad literal": [], 'quote "x" end': [],
    }
    with pytest.raises(ValueError, match="Tokens"):
        files.map_corpus(raw.drop("Tokens"))


def test_corpus_job_and_split_readers(spark, tmp_path):
    path = tmp_path / "raw.csv"
    lines = ["Filled Template,Tokens"] + [f"\"text number {i}\",\"['O', 'B-X', 'I-X']\"" for i in range(40)]
    path.write_text("\n".join(lines) + "\n")
    reports = corpus.run(spark, str(path), ["Filled Template", "Tokens"], str(tmp_path / "out"))
    stats = {r["split"]: (r["n_rows"], r["total_pii"]) for r in reports["split_statistics"].collect()}
    assert stats == {"train": (28, 56), "val": (6, 12), "test": (6, 12)}
    assert spark.read.json(str(tmp_path / "out" / "pii_types")).first()["percent"] == 100.0
    rows = spark.read.parquet(str(tmp_path / "out" / "splits"))
    files.write_splits(rows, str(tmp_path / "csv"), as_csv=True)
    back = files.read_labelled_split(spark, str(tmp_path / "csv" / "split=train"))
    assert back.count() == 28 and back.first()["labels"] == ["O", "B-X", "I-X"]
    assert files.read_split(spark, str(tmp_path / "csv" / "split=train"), max_rows=5).count() == 5
    assert files.read_split(spark, str(tmp_path / "nowhere")).count() == 0


def test_small_sample_of_a_corpus(spark):
    raw = spark.createDataFrame([(f"t{i}", "['O']") for i in range(30)], "`Filled Template` string, Tokens string")
    assert corpus.prepare(raw, 10).count() == 10 and corpus.prepare(raw, None).count() == 30


def test_tokenised_dataset(spark, tmp_path):
    df = spark.createDataFrame([("a b c", ["O", "B-X", "O"]), ("d", ["I-X"])], "text string, labels array<string>")
    done = files.tokenised(df, profile.label_ids(df), 1000, 4)
    done.write.parquet(str(tmp_path / "t"))
    back = spark.read.parquet(str(tmp_path / "t"))
    assert dict(back.dtypes) == {"labels": "array<bigint>", "input_ids": "array<int>", "attention_mask": "array<tinyint>"}
    rows = sorted((r["labels"], r["attention_mask"]) for r in back.collect())
    assert rows == [([1], [1, 0, 0, 0]), ([2, 0, 2], [1, 1, 1, 0])]


def test_json_readers(spark, tmp_path):
    (tmp_path / "history.json").write_text(json.dumps({m: [0.1, 0.2] for m in files.HISTORY_METRICS}, indent=1))
    rows = files.read_history(spark, str(tmp_path / "history.json")).orderBy("epoch").collect()
    assert [(r["epoch"], r["val_f1"]) for r in rows] == [(0, 0.1), (1, 0.2)]
    side = {"id": "D", "type": "letter", "pii_count": 1, "pii_entities": [{"entity": "SSN", "value": "1", "start": 3, "end": 4}]}
    (tmp_path / "meta.json").write_text(json.dumps(side, indent=1))
    row = files.read_sidecars(spark, str(tmp_path / "meta.json")).first()
    assert (row["id"], row["entity"], row["start"], row["end"]) == ("D", "SSN", 3, 4)
    assert files.read_record(spark, str(tmp_path / "meta.json")).first()["pii_count"] == 1


def test_names_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([("/x/a.txt",), ("/x.y/b",), ("/x/c.v1.txt",)], "p string")
    got = [tuple(r) for r in df.select(files.redacted_name(F.col("p")), files.details_name(F.col("p"))).collect()]
    assert got == [
        ("/x/a_redacted.txt", "/x/a_redaction_details.json"), ("/x.y/b_redacted", "/x.y/b_redaction_details.json"),
        ("/x/c.v1_redacted.txt", "/x/c.v1_redaction_details.json"),
    ]
    files.write_text(spark.createDataFrame([("one",)], "redacted_text string"), str(tmp_path / "t"))
    assert spark.read.text(str(tmp_path / "t")).first()["value"] == "one"


PATTERNS = {
    "email": r"^[a-z]+([._][a-z]+)?\d*@[a-z.]+$", "phone": r"^(\(\d{3}\) \d{3}-\d{4}|\d{3}-\d{3}-\d{4}|\+1 \d{3} \d{3} \d{4}|\d{3}\.\d{3}\.\d{4})$",
    "ssn": r"^\d{3}([- ]?)\d{2}\1\d{4}$", "card": r"^([456]\d{15}|3\d{14})$", "ipv4": r"^\d{1,3}(\.\d{1,3}){3}$",
    "ipv6": r"^[1-9a-f][0-9a-f]{3}(:[1-9a-f][0-9a-f]{3}){7}$", "mac": r"^[0-9a-f]{2}(:[0-9a-f]{2}){5}$", "url": r"^https?://([a-z]+\.)?example\.(com|org|net)(/[a-z]+/\d{1,3})?$",
    "bitcoin": r"^1[1-9A-HJ-NP-Za-km-z]{33}$", "ethereum": r"^0x[0-9a-f]{40}$", "iban": r"^[A-Z]{2}\d{2} \d{8} \d{10}$", "bic": r"^[A-Z]{11}$",
    "account": r"^(\d{8}|\d{10}|\d{12})$", "gps": r"^-?\d{1,2}\.\d{6}, -?\d{1,3}\.\d{6}$", "date": r"^20(1\d|2[0-4])-\d\d-\d\d$",
    "address": r"^\d{3,4} [A-Z][a-z]+ (St|Rd|Ave|Ln|Dr|Blvd), [A-Za-z ]+, [A-Z]{2} \d{5}$", "body": r"^.+(\n\n.+){1,3}$", "filler": r"^.+(\n.+){1,2}$",
    "name": r"^[A-Z][a-z]+( [A-Z][a-z]+)? [A-Z][a-z]+$",
}


@pytest.mark.parametrize("value", PATTERNS)
def test_generated_values(spark, value):
    made = getattr(synth.Draw("id"), value)("slot")
    rows = spark.range(300).select(made.alias("v"), made.rlike(PATTERNS[value].replace("\\1", "\\1")).alias("ok")).collect()
    assert all(r["ok"] for r in rows), [r["v"] for r in rows if not r["ok"]][:3]
    assert len({r["v"] for r in rows}) > 20


def test_generated_documents(spark):
    one = {r["id"]: r for r in synth.generate(spark, 60).collect()}
    ids = spark.createDataFrame([(i,) for i in sorted(one)], "id string").repartition(7)
    again = {r["id"]: r for r in synth.documents(ids).collect()}
    assert one == again and len(one) == 60
    assert {r["doc_type"] for r in one.values()} == set(synth.KINDS)
    assert {r["text"] for r in synth.generate(spark, 5, seed=1).collect()}.isdisjoint({r["text"] for r in one.values()})
    for r in one.values():
        assert r["text"] and 1 <= len(r["planted"]) <= 5
        for p in r["planted"]:
            piece = r["text"][p["start"] : p["end"]]
            if p["category"] in ("BITCOIN_ADDRESS", "ETHEREUM_ADDRESS"):
                assert piece.startswith(("1", "0x"))
            if p["category"] in ("SSN", "CREDIT_CARD"):
                assert piece.replace("-", "").replace(" ", "").isdigit()
    table = {(r["what"], r["name"]): r["n"] for r in synth.summary(synth.generate(spark, 60)).collect()}
    assert sum(n for (what, _), n in table.items() if what == "document_type") == 60
    assert table["total", "pii_entities"] == sum(n for (what, _), n in table.items() if what == "pii_type")


def test_feature_matrix(spark):
    rows = synth.feature_matrix(spark.range(4000), "id", 3, 0.3).collect()
    mean = sum(r["features"][1] for r in rows) / 4000
    spread = sum(r["features"][1] ** 2 for r in rows) / 4000
    assert abs(mean) < 0.06 and abs(spread - 1) < 0.1 and abs(sum(r["label"] for r in rows) / 4000 - 0.3) < 0.04


def test_label_functions(spark):
    df = spark.createDataFrame(
        [("['O', 'B-X']",), ("[]",), ("",), (None,), ("oops",)], "s string"
    ).select(lb.parse(F.col("s")).alias("p"))
    assert [r["p"] for r in df.collect()] == [["O", "B-X"], [], [], [], []]
    row = spark.createDataFrame([(["a", "b", "c"], ["O", "B-X", "I-Y-Z", "O", "O"])], "t array<string>, y array<string>").select(
        lb.align(F.col("y"), F.col("t")).alias("cut"), lb.align(F.col("t"), F.col("y")).alias("fill"),
        lb.classes(F.col("y"), 6).alias("cls"), lb.padded_tokens(F.col("t"), 4).alias("pad"),
        lb.attention_mask(F.col("t"), 4).alias("m"), lb.demo_tags(F.col("t")).alias("demo"),
        F.transform("y", lb.entity_type).alias("types"), lb.render(F.col("t")).alias("lit"),
    ).first()
    assert row["cut"] == ["O", "B-X", "I-Y-Z"] and row["fill"] == ["a", "b", "c", "O", "O"]
    assert row["cls"] == [0, 1, 2, 0, 0, 0] and row["pad"] == ["a", "b", "c", "[PAD]"] and row["m"] == [1, 1, 1, 0]
    assert row["demo"] == ["B-PERSON", "I-PERSON", "O"] and row["types"] == [None, "X", "Y", None, None]
    assert row["lit"] == "['a', 'b', 'c']"


def test_tagger(spark):
    tokens = ["Ann", "NASA", "A", "x@y.z", "555-123-4567x", "123-45-6789", "word", "McDonald", "Ünal", "x@y"]
    got = spark.createDataFrame([(tokens,)], "t array<string>").select(lb.tags(F.col("t")).alias("y")).first()["y"]
    assert got == ["B-PERSON", "O", "O", "B-EMAIL", "B-PHONE", "B-SSN", "O", "B-PERSON", "B-PERSON", "O"]


def test_raw_rows_with_too_many_fields(spark, tmp_path):
    path = tmp_path / "raw.csv"
    path.write_text('a,b\nlong,,extra\nlong,x,\n"q,""r",s\nshort\n"two\nlines, x",\nlonger,,,,\n')
    rows = files.read_raw_corpus(spark, str(path), ["a", "b"]).collect()
    assert sorted(tuple(r) for r in rows) == sorted([('q,"r', "s"), ("short", None), ("two\nlines, x", None)], key=str)
