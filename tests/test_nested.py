import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from spanveil import Policy
from spanveil.config import CATEGORIES
from spanveil.functions.nested import mask_json_text, mask_variant_to_text
from spanveil.operators.redact import redact, redact_spans
from spanveil.plans.masked_view import masked_spans_view
from spanveil.schemas import SPANS
from spanveil.sources.samples import spans_from_events

DOCUMENT = {"a": "bob@x.com", "n": 4155550123, "f": 1.5, "b": True, "z": None,
            "o": {"m": "tel (415) 555-0123", "k": [1, "x@y.zz", {"q": "l1\nbob@x.com"}]},
            "inner": "{\"response\": \"hi\\nbob@x.com\"}", "safe.key": "x@y.com"}


def variant_rows(spark, documents):
    df = spark.createDataFrame([(i, d) for i, d in enumerate(documents)], "i int, s string")
    return df.select("i", "s", F.parse_json("s").alias("v")).select(
        "*", F.col("v").cast("string").alias("t"))


def masked(spark, documents, policy):
    df = variant_rows(spark, documents)
    rows = df.select("i", mask_variant_to_text(F.col("v"), F.col("t"), policy).alias("v"),
                     mask_json_text(F.col("s"), policy).alias("s")).orderBy("i").collect()
    return [(r.v, r.s) for r in rows]


def expected(value, allow=()):
    if isinstance(value, dict):
        return {k: (v if k in allow else expected(v)) for k, v in value.items()}
    if isinstance(value, list):
        return [expected(v) for v in value]
    if isinstance(value, str):
        for raw, token in (("bob@x.com", "[EMAIL]"), ("x@y.zz", "[EMAIL]"), ("x@y.com", "[EMAIL]"),
                           ("(415) 555-0123", "[PHONE]")):
            value = value.replace(raw, token)
    return value


@pytest.mark.parametrize("custom", [{}, {"never": "no such text"}])
@pytest.mark.parametrize("allow", [(), ("safe.key",)])
def test_values_are_masked_and_types_stay(spark, allow, custom):
    policy = Policy(CATEGORIES, custom, allowlisted_keys=allow)
    ((from_variant, from_text),) = masked(spark, [json.dumps(DOCUMENT)], policy)
    assert json.loads(from_variant) == expected(DOCUMENT, allow)
    assert json.loads(from_text) == expected(DOCUMENT, allow)
    assert json.loads(json.loads(from_variant)["inner"]) == {"response": "hi\n[EMAIL]"}


def test_other_shapes(spark):
    documents = ['"plain bob@x.com"', "12", "null", '["a@b.cc", 1]', "{}", "[]", "true"]
    results = [v for v, _ in masked(spark, documents, Policy())]
    assert results == ["plain [EMAIL]", "12", None, '["[EMAIL]",1]', "{}", "[]", "true"]


def test_text_that_is_no_json(spark):
    df = spark.createDataFrame([("{broken bob@x.com",), (None,)], "s string")
    rows = df.select(mask_json_text(F.col("s"), Policy()).alias("m")).collect()
    assert [r.m for r in rows] == ["{broken [EMAIL]", None]


def test_a_pattern_cannot_break_json(spark):
    policy = Policy((), {"greedy": r".*secret.*"})
    ((v, _),) = masked(spark, [json.dumps({"a": 'x "secret" \\ y', "b": "ok", "c": {"d": "my secret"}})], policy)
    assert json.loads(v) == {"a": "[GREEDY]", "b": "ok", "c": {"d": "[GREEDY]"}}


def test_long_values(spark):
    document = {"a": "\n\"" * 100_000 + " bob@x.com", "b": ["x" * 200_000] * 3, "c": {"d": "\\" * 100_000}}
    ((v, s),) = masked(spark, [json.dumps(document)], Policy(CATEGORIES))
    assert json.loads(v) == json.loads(s) == {**document, "a": "\n\"" * 100_000 + " [EMAIL]"}
    nested = json.dumps({"inner": json.dumps(document)})
    ((v, _),) = masked(spark, [nested], Policy(CATEGORIES))
    assert json.loads(json.loads(v)["inner"])["a"].endswith(" [EMAIL]")


def test_many_values(spark):
    document = {"list": [f"user{i}@x.com" for i in range(20_000)], **{f"k{i}": i for i in range(1000)}}
    ((v, _),) = masked(spark, [json.dumps(document)], Policy(CATEGORIES))
    assert json.loads(v) == {**document, "list": ["[EMAIL]"] * 20_000}


_TEXT = st.one_of(st.text(max_size=20), st.sampled_from(["bob@x.com", "a\nbob@x.com", '"bob@x.com"', "\\bob@x.com",
                                                         "(415) 555-0123", "\\n415-555-0123"]))
_JSON = st.recursive(st.one_of(_TEXT, st.integers(-10**15, 10**15), st.booleans(), st.none()),
                     lambda c: st.one_of(st.lists(c, max_size=3), st.dictionaries(st.text(max_size=5), c, max_size=3)),
                     max_leaves=8)


def shape(value):
    if isinstance(value, dict):
        return {k: shape(v) for k, v in value.items()}
    if isinstance(value, list):
        return [shape(v) for v in value]
    return "text" if isinstance(value, str) else value


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dictionaries(st.text(max_size=6), _JSON, max_size=4), min_size=25, max_size=40))
def test_result_is_json_of_the_same_shape(spark, documents):
    documents = [d for d in documents if not _has_surrogate(json.dumps(d))]
    if not documents:
        return
    results = masked(spark, [json.dumps(d) for d in documents], Policy(CATEGORIES))
    for document, (v, _) in zip(documents, results):
        assert shape(json.loads(v)) == shape(document)
        assert "bob@x.com" not in json.dumps([x for x in _values(json.loads(v))])


def _has_surrogate(text):
    return "\\ud" in text.lower()


def _values(value):
    if isinstance(value, dict):
        for v in value.values():
            yield from _values(v)
    elif isinstance(value, list):
        for v in value:
            yield from _values(v)
    elif isinstance(value, str):
        yield value


def span_rows(spark, rows):
    base = spans_from_events(spark.createDataFrame(
        [(i, 1, "x", 1.0, '{"k": 1}') for i in range(len(rows))],
        "event_id long, user_id long, event_type string, value double, props string").withColumn(
        "ts", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
    changes = spark.createDataFrame([(str(i), *r) for i, r in enumerate(rows)],
                                    "span_id string, r string, ra string")
    return base.drop("resource").join(changes, "span_id").withColumn(
        "resource", F.when(F.col("r").isNotNull(), F.struct(
            F.parse_json("ra").alias("attributes"), F.lit(3).alias("dropped_attributes_count")))).select(*SPANS.names)


def test_resource(spark):
    spans = span_rows(spark, [(None, None), ("x", None), ("x", '{"o":"a@b.co"}'), ("x", "null")])
    out = redact_spans(spans, Policy()).orderBy("span_id").collect()
    assert [r.resource and r.resource.asDict() for r in out] == [
        None, {"attributes": None, "dropped_attributes_count": 3},
        {"attributes": '{"o":"[EMAIL]"}', "dropped_attributes_count": 3},
        {"attributes": None, "dropped_attributes_count": 3}]
    view = masked_spans_view(spans, Policy()).orderBy("span_id").collect()
    assert view[0].resource.asDict() == {"attributes": None, "dropped_attributes_count": None}


def test_other_columns_pass_through(spark, table):
    raw = spans_from_events(table("events"))
    out = redact_spans(raw, Policy(CATEGORIES))
    assert out.columns == raw.columns
    same = [c for c in raw.columns if c not in ("attributes", "events", "resource", "links", "instrumentation_scope")]
    assert raw.select(same).exceptAll(out.select(same)).isEmpty() and out.count() == raw.count()


def test_further_fields(spark, table):
    raw = spans_from_events(table("events")).withColumn("status", F.struct(
        F.lit("sent to a@b.co").alias("message"), F.lit("OK").alias("code"))).withColumn("name", F.lit("for c@d.co"))
    row = redact(raw, ("name", "status", "links"), Policy()).first()
    assert row.name == "for [EMAIL]" and row.status.message == "sent to [EMAIL]" and row.links is None
    assert redact(raw, ("status.message",), Policy()).first().status.message == "sent to [EMAIL]"
    with pytest.raises(ValueError):
        redact(raw, ("missing",), Policy())
    with pytest.raises(ValueError):
        redact(raw, ("status", "status.code"), Policy())


@pytest.mark.parametrize("options", [{}, {"mode": "hash", "salt": "s"}, {"allowlisted_keys": ("k",)}])
def test_model_hook(spark, table, options):
    def broken_json_model():
        return lambda texts: texts.str.replace("svc", '"', regex=False)

    raw = spans_from_events(table("events"))
    out = redact_spans(raw, Policy(model=broken_json_model, **options))
    bad = out.where("attributes is not null and try_parse_json(attributes) is null").count()
    assert bad == 0 and out.where("attributes is null").count() == raw.where("attributes is null").count()
    assert out.where("attributes like '%svc%'").count() == 0


def test_view_prunes_unused_masks(spark, table, tmp_path):
    spans_from_events(table("events")).write.parquet(str(tmp_path / "spans"))
    view = masked_spans_view(spark.read.parquet(str(tmp_path / "spans")), Policy())
    plan = view.where("date = '2024-01-02'").select("trace_id", "events")._jdf.queryExecution().executedPlan().toString()
    assert "attributes" not in plan.split("ReadSchema")[1].split("events")[0]
    assert "EqualTo(date,2024-01-02)" in plan and "resource" not in plan.split("ReadSchema")[1]


@pytest.mark.parametrize("paths, kept", [
    (("a.b",), {"a.b"}), (("a.list[*].c", "a"), {"a.b", "c0", "c1", "d", "deep"}), (("a.list[*].c",), {"c0", "c1"}),
    (("a.list[*]",), {"c0", "c1", "d"}), (('"x.y"."q\\"z"',), {"xyz"}), (("plain[*]", "plain[*].c"), {"p0", "p1"}),
    (("plain.c", "a[*]", "a.b.c", "none.at.all"), set()), (("many[*][*].e",), {"e0", "e1"}), (("a.deep.er",), {"deep"})])
def test_only_values_at_allowed_paths_stay(spark, paths, kept):
    def document(value):
        return {"a": {"b": value("a.b"), "list": [{"c": value("c0"), "d": value("d")}, {"c": value("c1")}, 3, None],
                      "deep": {"er": value("deep")}, "n": None},
                "x.y": {'q"z': value("xyz")}, "plain": [value("p0"), value("p1"), True],
                "many": [[{"e": value("e0")}], [{"e": value("e1"), "f": value("f")}], []], "note": value("note")}

    raw = document(lambda name: f"{name.replace('.', '')}@x.com")
    ((from_variant, from_text),) = masked(spark, [json.dumps(raw)], Policy(allowlisted_paths=paths))
    right = document(lambda name: f"{name.replace('.', '')}@x.com" if name in kept else "[EMAIL]")
    assert json.loads(from_variant) == json.loads(from_text) == right


def test_paths_on_other_shapes(spark):
    documents = ['"plain bob@x.com"', "12", "null", '["a@b.cc", 1]', "{}", "[]"]
    results = [v for v, _ in masked(spark, documents, Policy(allowlisted_paths=("a.b", "c[*].d")))]
    assert results == ["plain [EMAIL]", "12", None, '["[EMAIL]",1]', "{}", "[]"]


@pytest.mark.parametrize("path", ["", ".a", "a.", "a..b", "a[0]", "a[*]b", 'a"b', '"a', "a.[*]"])
def test_what_is_no_path(path):
    with pytest.raises(ValueError):
        Policy(allowlisted_paths=(path,))
