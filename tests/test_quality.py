import json

import pytest
from pyspark.sql import functions as F

from spanveil import Policy
from spanveil.config import CATEGORIES
from spanveil.functions.masking import mask_text
from spanveil.functions.names import mask_listed_names
from spanveil.operators.quality import coverage, leak_scan, recall
from spanveil.operators.redact import redact_logs, redact_spans
from spanveil.sources.prompts import prompts_to_spans, read_prompts
from spanveil.sources.samples import logs_from_documents, notes_from_orders, spans_from_events


def test_nothing_leaks_from_redacted_columns(table):
    policy = Policy(CATEGORIES)
    for redacted in (redact_spans(spans_from_events(table("events")), policy),
                     redact_logs(logs_from_documents(table("documents")), policy)):
        found = leak_scan(redacted, policy, "t")
        assert found.where("rows_with_hit > 0").count() == 0
        assert found.count() >= 8 * 10


def test_leak_scan_sees_passed_through_columns(table):
    spans = redact_spans(spans_from_events(table("events")), Policy()).withColumn("name", F.lit("for a@b.co"))
    hits = {(r.column_name, r.category) for r in leak_scan(spans, Policy(), "spans").where("rows_with_hit > 0").collect()}
    assert hits == {("name", "email")}


def test_coverage_counts_what_masking_replaces(table):
    policy = Policy(CATEGORIES)
    notes = notes_from_orders(table("orders")).withColumn("date", F.lit("2024-01-01").cast("date"))
    counted = {r.category: r.matches for r in coverage(notes, "text", policy, "notes").collect()}
    masked = notes.select(mask_text(F.col("text"), policy).alias("m"))
    for category in CATEGORIES:
        tokens = masked.agg(F.sum(F.regexp_count("m", F.lit(rf"\[{category.upper()}\]")))).first()[0]
        assert counted[category] == tokens > 0


def test_recall_with_copies(spark):
    truth = spark.createDataFrame([(1, "email", "a@b.co", True), (1, "email", "a@b.co", True),
                                   (2, "email", "gone", True), (2, "id", "EMP", False)],
                                  "k int, category string, value string, sensitive boolean")
    text = spark.createDataFrame([(1, "has a@b.co"), (1, "has a@b.co"), (2, "EMP here")], "k int, t string")
    rows = {r.category: r.asDict() for r in recall(truth, text, "k", "t").collect()}
    assert (rows["email"]["sensitive_values"], rows["email"]["masked_values"], rows["email"]["recall"]) == (3, 1, 0.3333)
    assert rows["id"]["kept_share"] == 1.0 and rows["id"]["recall"] is None


def test_recall_counts_missing_records(spark):
    truth = spark.createDataFrame([(1, "email", "a@b.co", True), (2, "email", "c@d.co", True)],
                                  "k int, category string, value string, sensitive boolean")
    text = spark.createDataFrame([(1, "[EMAIL]")], "k int, t string")
    row = recall(truth, text, "k", "t").first()
    assert (row["sensitive_values"], row["masked_values"], row["missing_values"], row["recall"]) == (2, 1, 1, 0.5)


@pytest.mark.parametrize("max_literals", [0, 100])
def test_listed_names(spark, max_literals):
    df = spark.createDataFrame([
        (1, "We met Ann Lee and Joann Lee, then ANN LEE."), (2, "Found Mary Jane Watson today"), (3, None),
        (4, "nothing here"), (5, "Ann Lee Ann Lee")], "id int, t string")
    names = spark.createDataFrame([("ann lee",), ("Mary Jane Watson",), ("Watson",), (" ",), (None,)], "name string")
    out = {r.id: r.t for r in mask_listed_names(df, "t", names, Policy(()), "id", max_literals).collect()}
    assert out == {1: "We met [NAME] and Joann Lee, then [NAME].", 2: "Found [NAME] today", 3: None,
                   4: "nothing here", 5: "[NAME] [NAME]"}


@pytest.mark.parametrize("slice_names", [2, 1000])
def test_listed_names_of_any_length(spark, slice_names):
    texts = {
        "Dr. Anna van der Berg's flat": "Dr. [NAME]'s flat", "ANNA VAN DER BERG": "[NAME]", "anna van der berg": "anna van der berg",
        "Maria del Carmen  Lopez\nGarcia Ruiz left": "[NAME] left", "Anna. Van der Berg": "Anna. Van der Berg", "J. R. Smith, J.R. Smith": "[NAME], [NAME]",
        "Bob Ray Ann": "[NAME]", "Zoe\u0301 O\u2019Hara": "[NAME]", "Zo\u00e9 O'Hara2": "[NAME]2", "王小明": "[NAME]", "Joann Lee": "Joann Lee", "": ""}
    rows = [(None if i % 2 else i, t, "x") for i, t in enumerate(texts)] + [(None, None, "x")]
    df = spark.createDataFrame(rows, "id int, text string, text_places string")
    names = spark.createDataFrame([(n,) for n in ("Anna van der Berg", "Maria del Carmen Lopez Garcia Ruiz", "J R Smith", "Bob Ray", "Ray Ann",
                                                  "zoé o'hara", "王小明", "Ann Lee", "Ann Lee", " ", None, "42")], "name string")
    out = mask_listed_names(df, "text", names, Policy(()), slice_names=slice_names)
    assert out.columns == df.columns
    assert sorted(r["text"] for r in out.collect() if r["text"] is not None) == sorted(texts.values())
    hashed = mask_listed_names(df, "text", names, Policy((), mode="hash", salt="s"), slice_names=slice_names)
    values = {r["text"] for r in hashed.collect()}
    assert not any("Anna van der" in (v or "") for v in values)
    assert mask_listed_names(df, "text", names.limit(0), Policy(())) is df


def test_listed_names_in_a_stream(spark, tmp_path):
    spark.createDataFrame([("Call Anna van der Berg.",), (None,)], "text string").write.parquet(str(tmp_path / "in"))
    letters = "abcdefghij"
    names = spark.createDataFrame([(f"Given van N{letters[i // 10]}{letters[i % 10]}",) for i in range(50)] + [("Anna van der Berg",)], "name string")
    stream = spark.readStream.schema("text string").parquet(str(tmp_path / "in"))
    query = (mask_listed_names(stream, "text", names, Policy(()), slice_names=20).writeStream.format("parquet")
             .option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert {r["text"] for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {"Call [NAME].", None}


def test_prompt_lines(spark, tmp_path):
    records = [{"prompt": f"p{i} a@b.co", "response": f"r{i}\n(415) 555-0{i % 1000:03d}"} for i in range(1, 4001)]
    folder = tmp_path / "prompts"
    folder.mkdir()
    (folder / "one.jsonl").write_text("\n".join(json.dumps(r) for r in records) + "\n")
    (folder / "two.jsonl").write_text(json.dumps(records[0]))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        lines = read_prompts(spark, str(folder))
        rows = lines.collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(rows) == 4001
    for r in rows:
        assert r.prompt == f"p{r.line_number} a@b.co"

    spans = prompts_to_spans(lines, F.concat("file", "line_number"), F.lit("2024-01-01").cast("timestamp"),
                             input_key="in", output_key="out")
    assert spans.select("trace_id").distinct().count() == 4001
    row = redact_spans(spans, Policy()).where("get_json_object(attributes, '$.in') like '%p17 %'").first()
    attributes = json.loads(row.attributes)
    assert json.loads(attributes["in"]) == {"prompt": "p17 [EMAIL]"}
    assert json.loads(attributes["out"]) == {"response": "r17\n[PHONE]"}
    assert attributes["test.line_number"] == 17
