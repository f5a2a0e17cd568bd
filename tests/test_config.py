import pytest

from spanveil import PipelineConfig, Policy, parse_categories, parse_retention
from spanveil.streaming import pipeline


def config(**changed):
    base = dict(source_root="/in", source_schema="raw", target_root="/out", target_schema="clean",
                table_prefix="app")
    return PipelineConfig(**{**base, **changed})


def test_names():
    c = config()
    assert c.raw_path("spans") == "/in/raw/app_otel_spans"
    assert c.redacted_name("logs") == "redacted_logs"
    assert c.unified_name == "app_trace_unified"
    assert c.retention_days == 90


@pytest.mark.parametrize("changed", [
    {"source_schema": "a-b"}, {"target_schema": ""}, {"table_prefix": "a b"}, {"source_root": ""},
    {"mode": "sometimes"}, {"retention_days": "-1"}, {"max_bytes_per_trigger": "5g"}, {"fields": {"metrics": ()}}])
def test_bad_settings(changed):
    with pytest.raises(ValueError):
        config(**changed)


@pytest.mark.parametrize("options", [
    {"categories": ("email", "shoe_size")}, {"mode": "encrypt"}, {"mode": "hash"},
    {"mask_character": "$"}, {"mask_character": '"'}, {"mask_character": "\\"}, {"mask_character": "**"},
    {"custom_patterns": {"a b": "x"}}, {"custom_patterns": {"a": ""}}, {"custom_patterns": {"a": "a*"}}, {"events_as": "xml"}])
def test_bad_policies(options):
    with pytest.raises(ValueError):
        Policy(**options)


def test_categories():
    assert parse_categories("'email', 'phone'") == ("email", "phone")
    assert parse_categories("  ") == ()
    for bad in ("email", "'email','", "'nothing'"):
        with pytest.raises(ValueError):
            parse_categories(bad)


def test_retention():
    assert parse_retention("30") == 30 and parse_retention(7) == 7
    assert [parse_retention(v) for v in ("", "0", 0, "None", "never", None)] == [None] * 6
    for bad in ("-3", "1.5", "ten", "²"):
        with pytest.raises(ValueError):
            parse_retention(bad)


def test_the_mark_of_a_policy_tells_salts_and_paths_apart():
    def mark(**options):
        return pipeline._policy_mark(config(policy=Policy(**options)))

    marks = [mark(), mark(mode="hash", salt="one"), mark(mode="hash", salt="two"),
             mark(allowlisted_paths=("a.b",)), mark(allowlisted_keys=("a.b",))]
    assert len(set(marks)) == 5
    assert mark(mode="hash", salt="one") == marks[1]
    assert mark(allowlisted_paths=("a.b", "c")) == mark(allowlisted_paths=("c", "a.b"))
