"""Trace tables derived from plain tables (events, documents, labels, orders).

Every row of the input gives rows of the output, so the work grows with the data.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schemas import ANNOTATIONS, LOGS, SPANS


def _as(df: DataFrame, schema: T.StructType, known: dict[str, Column]) -> DataFrame:
    return df.select(*(known.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields))


def _json(**fields: Column) -> Column:
    return F.parse_json(F.to_json(F.struct(*(c.alias(n.replace("__", ".")) for n, c in fields.items()))))


def _text(*parts) -> Column:
    return F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))


def spans_from_events(events: DataFrame) -> DataFrame:
    """One span per event; a trace is a user. Every fifth span holds personal data."""
    number = F.col("event_id")
    text = number.cast("string")
    time = F.col("ts").cast("timestamp")
    start = F.unix_micros(time) * 1000
    service = _text("svc-", (number % 5).cast("string"))
    count = F.get_json_object("props", "$.k").cast("int")
    plain = _json(http__status_code=F.lit(200), k=count, service__name=service)
    personal = _json(
        app__user=_text("user", F.col("user_id").cast("string"), "@mail.example.com"),
        http__status_code=F.lit(200), k=count,
        nested=F.struct(_text("10.1.2.", (number % 200).cast("string")).alias("client"),
                        F.array(F.lit("first"), _text("u", text, "@corp.example.org")).alias("copies")),
        note=_text("Call (555) 201-", F.lpad((number % 10000).cast("string"), 4, "0"),
                   "\nfor EMP-", F.lpad((number % 1000000).cast("string"), 6, "0")),
        service__name=service)
    failure = F.struct(
        start.alias("time_unix_nano"), F.lit("exception").alias("name"),
        _json(message=_text("no mail for bob", text, "@shop.example.com")).alias("attributes"),
        F.lit(0).alias("dropped_attributes_count"))
    owner = _json(owner=_text("ops", (number % 100).cast("string"), "@corp.example.com"),
                  service__name=service)
    return _as(events, SPANS, {
        "record_id": _text("rec-", text), "time": time, "date": F.to_date(time),
        "service_name": service, "trace_id": F.col("user_id"), "span_id": text,
        "parent_span_id": F.when(number % 4 != 0, (number - 1).cast("string")),
        "flags": F.lit(1), "name": F.col("event_type"),
        "kind": F.when(number % 3 == 0, "SERVER").otherwise("CLIENT"),
        "start_time_unix_nano": start,
        "end_time_unix_nano": start + F.round(F.col("value") * 1000000).cast("long"),
        "attributes": F.when(number % 10 == 0, None).when(number % 5 == 1, personal).otherwise(plain),
        "dropped_attributes_count": F.lit(0),
        "events": F.when(number % 3 == 1, F.array().cast(SPANS["events"].dataType))
                   .when(number % 3 == 2, F.array(failure)),
        "dropped_events_count": F.lit(0), "dropped_links_count": F.lit(0),
        "status": F.struct(F.lit(None).cast("string").alias("message"), F.lit("OK").alias("code")),
        "resource": F.when(number % 7 == 1, F.struct(
            F.lit(None).cast("variant").alias("attributes"),
            F.lit(1).alias("dropped_attributes_count"))).when(number % 7 > 1, F.struct(
                owner.alias("attributes"), F.lit(0).alias("dropped_attributes_count"))),
    })


def logs_from_documents(documents: DataFrame) -> DataFrame:
    """One log record per document, with the whole text as body."""
    number = F.col("doc_id")
    date = F.date_add(F.lit("2024-01-01").cast("date"), (number % 30).cast("int"))
    time = date.cast("timestamp")
    return _as(documents, LOGS, {
        "record_id": _text("log-", number.cast("string")), "time": time, "date": date,
        "service_name": F.col("source"), "event_name": F.lit("document"),
        "trace_id": number, "span_id": number, "time_unix_nano": F.unix_micros(time) * 1000,
        "observed_time_unix_nano": F.unix_micros(time) * 1000, "severity_number": F.lit(9),
        "severity_text": F.lit("INFO"), "body": F.col("text").cast("variant"),
        "attributes": _json(lang=F.col("lang"), n_chars=F.col("n_chars"),
                            reviewer=_text("rev", number.cast("string"), "@mail.example.com")),
        "dropped_attributes_count": F.lit(0), "flags": F.lit(0),
        "resource": F.struct(_json(host=F.lit("10.0.0.1")).alias("attributes"),
                             F.lit(0).alias("dropped_attributes_count")),
    })


def annotations_from_labels(labels: DataFrame) -> DataFrame:
    """Two annotations per labelled document, attached to the trace with the same number."""
    entries = F.explode(F.array(
        F.struct(F.lit("quality").alias("label"), F.col("quality").alias("score")),
        F.struct(F.lit("toxic").alias("label"), F.col("toxic").alias("score"))))
    rows = labels.select("doc_id", entries.alias("entry")).select("doc_id", "entry.*")
    return _as(rows, ANNOTATIONS, {
        "target_id": F.col("doc_id"),
        "annotation_id": _text(F.col("doc_id").cast("string"), "-", F.col("label")),
        "annotation_type": F.lit("assessment"), "name": F.col("label"),
        "value": F.col("score").cast("variant"),
        "comment": _text("scored ", F.col("label")),
        "created_at": F.lit("2024-02-01 00:00:00").cast("timestamp"),
        "created_by": F.lit("rater"),
    })


def tags_from_labels(labels: DataFrame) -> DataFrame:
    """Annotations in the earlier form, with some rows delivered twice."""
    return labels.select(
        F.col("doc_id").cast("string").alias("target_id"),
        _text("quality=", F.col("quality").cast("string")).alias("tags"),
        _text("toxic=", F.col("toxic").cast("string")).alias("assessments"),
        F.explode(F.sequence(F.lit(0), (F.col("doc_id") % 2).cast("int"))).alias("delivery"),
    ).drop("delivery")


# The names and streets used in the notes.
FIRST_NAMES = ("Alice", "Bruno", "Carla", "Dmitri", "Elena", "Farid", "Grace", "Hiro")
LAST_NAMES = ("Archer", "Bennett", "Castillo", "Dawson", "Eriksen", "O'Brien", "Fontaine")
STREETS = ("Oak Street", "Harbor Blvd", "Maple Lane", "De Anza Blvd", "K Street NW")
CITIES = ("Springfield, CA 90210", "New York, NY 10005", "San Francisco, CA 94107")


def _pick(values: tuple[str, ...], number: Column) -> Column:
    return F.element_at(F.array(*(F.lit(v) for v in values)), (number % len(values) + 1).cast("int"))


def notes_from_orders(orders: DataFrame) -> DataFrame:
    """A case note per order with one known value of each category, and look-alikes.

    Columns: note_id, note_kind, text, and one column per value, for use as ground truth.
    """
    number, customer = F.col("o_orderkey"), F.col("o_custkey")

    def digits(value: Column, width: int) -> Column:
        return F.lpad((value % 10 ** width).cast("string"), width, "0")

    person = _text(_pick(FIRST_NAMES, number), " ", _pick(LAST_NAMES, customer))
    values = {
        "email": _text("user.", customer.cast("string"), "@mail", (number % 7).cast("string"), ".example.com"),
        "phone": F.when(number % 3 == 0, _text("(555) ", digits(customer + 100, 3), "-", digits(number, 4)))
                  .when(number % 3 == 1, _text("555.", digits(customer + 100, 3), ".", digits(number, 4)))
                  .otherwise(_text("+1 555-", digits(customer + 100, 3), "-", digits(number, 4))),
        "ssn": _text(digits(customer + 900, 3), "-", digits(number, 2), "-", digits(number * 7, 4)),
        "credit_card": F.when(number % 2 == 0, _text(
            "4532-", digits(number, 4), "-", digits(customer, 4), "-4242")).otherwise(_text(
                "3782-", digits(number, 6), "-", digits(customer, 5))),
        "date_of_birth": _text(digits(number % 12 + 1, 2), "/", digits(number % 28 + 1, 2), "/19",
                               digits(customer % 60 + 40, 2)),
        "ip_address": _text("10.20.", (number % 256).cast("string"), ".", (customer % 256).cast("string")),
        "address": _text((number % 9000 + 1).cast("string"), " ", _pick(STREETS, number),
                         F.when(number % 4 == 0, ", Apt 4B").otherwise(""), ", ", _pick(CITIES, customer)),
        "name": person,
        "account": _text("0918-", digits(number, 4), "-", digits(customer, 4)),
        "employee": _text("EMP-", digits(number, 6)),
    }
    rows = orders.select(number.alias("note_id"), *(v.alias(n) for n, v in values.items()))
    c = F.col
    text = F.when(c("note_id") % 3 == 0, _text(
        "Profile of customer ", c("name"), ", DOB: ", c("date_of_birth"), ", SSN: ", c("ssn"),
        ". Phone: ", c("phone"), ". Address: ", c("address"), ". Account ", c("account"), ".")
    ).when(c("note_id") % 3 == 1, _text(
        "Found account for ", c("name"), " (", c("email"), "), card ", c("credit_card"),
        ", last seen from ", c("ip_address"), " on 2026-05-28 by ", c("employee"), ".")
    ).otherwise(_text(
        "Order by Dr. ", c("name"), "; ship to: ", c("address"), "; call ", c("phone"),
        " or mail ", c("email"), ". Tracking 1Z999AA10123456784, account ", c("account"), "."))
    return rows.select("note_id", (c("note_id") % 3).cast("int").alias("note_kind"),
                       text.alias("text"), *values)
