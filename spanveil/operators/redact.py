"""Row-local redaction of whole tables; the same code serves batch and streaming."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import DEFAULT_FIELDS, Policy
from ..functions.model import apply_model
from ..functions.masking import mask_text
from ..functions.nested import (mask_array_to_text, mask_json_text, mask_typed,
                                mask_variant_to_text)
from ..schemas import LOGS, SPANS

_JSON_COLUMNS = ("attributes", "events")


def _data_type(schema: T.StructType, field: str) -> T.DataType:
    data_type: T.DataType = schema
    for part in field.split("."):
        if not isinstance(data_type, T.StructType) or part not in data_type.names:
            raise ValueError(f"field {field!r} is not in the table")
        data_type = data_type[part].dataType
    return data_type


def _is_json(field: str, data_type: T.DataType) -> bool:
    return isinstance(data_type, T.ArrayType) or field.split(".")[-1] in _JSON_COLUMNS


def _plain_text(value: Column, data_type: T.DataType, policy: Policy) -> Column:
    if isinstance(data_type, T.ArrayType) and policy.events_as == "json":
        return F.to_json(value)
    return value.cast("string")


def _masked(field: str, data_type: T.DataType, text: Column, policy: Policy) -> Column:
    value = F.col(field)
    if isinstance(data_type, T.VariantType):
        return mask_variant_to_text(value, text, policy)
    if isinstance(data_type, T.ArrayType):
        return mask_array_to_text(value, text, data_type, policy)
    if isinstance(data_type, T.StringType):
        if field.split(".")[-1] in _JSON_COLUMNS:
            return mask_json_text(text, policy)
        return mask_text(text, policy)
    return mask_typed(value, data_type, policy)


def _open_variants(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Turn a resource that arrives as one VARIANT into its struct form."""
    for name in {f.split(".")[0] for f in fields if "." in f}:
        if name not in df.columns or not isinstance(df.schema[name].dataType, T.VariantType):
            continue
        whole = F.col(name)
        df = df.withColumn(name, F.when(whole.isNotNull(), F.struct(
            F.try_variant_get(whole, "$.attributes", "variant").alias("attributes"),
            F.try_variant_get(whole, "$.dropped_attributes_count", "int").alias(
                "dropped_attributes_count"))))
    return df


def redact(df: DataFrame, fields: tuple[str, ...], policy: Policy) -> DataFrame:
    """Mask the given fields (``column`` or ``column.field``) and pass all others through.

    VARIANT and array fields become strings. A struct keeps its other fields, and a null
    struct stays null.
    """
    df = _open_variants(df, fields)
    types = {field: _data_type(df.schema, field) for field in fields}
    nested = {f for f in fields if "." in f}
    if any(f.count(".") > 1 for f in fields):
        raise ValueError("a field may be a column or a field of a struct column")
    clash = nested & {f for f in nested if f.split(".")[0] in fields}
    if clash:
        raise ValueError(f"{sorted(clash)} are already covered by their column")

    # The plain text of a field is used several times, so it gets a projection of its own.
    texts = {field: f"_text_{i}" for i, field in enumerate(fields)
             if not isinstance(types[field], T.StructType)}
    staged = df.select("*", *(_plain_text(F.col(f), types[f], policy).alias(t)
                              for f, t in texts.items()))

    def column(name: str) -> Column:
        def masked(field: str) -> Column:
            text = F.col(texts[field]) if field in texts else None
            return _masked(field, types[field], text, policy)

        if name in fields:
            return masked(name).alias(name)
        result = F.col(name)
        for field in (f for f in fields if f in nested and f.split(".")[0] == name):
            result = result.withField(field.split(".")[1], masked(field))
        return result.alias(name)

    redacted = staged.select(*(column(name) for name in df.columns))
    if policy.model is None or not texts:
        return redacted
    return apply_model(redacted, {f: _is_json(f, types[f]) for f in texts}, policy.model)


def _project(df: DataFrame, schema: T.StructType, where: Column | None) -> DataFrame:
    if where is not None:
        df = df.where(where)
    return df.select(*schema.names)


def redact_spans(df: DataFrame, policy: Policy, fields=DEFAULT_FIELDS["spans"],
                 where: Column | None = None) -> DataFrame:
    return redact(_project(df, SPANS, where), tuple(fields), policy)


def redact_logs(df: DataFrame, policy: Policy, fields=DEFAULT_FIELDS["logs"],
                where: Column | None = None) -> DataFrame:
    return redact(_project(df, LOGS, where), tuple(fields), policy)


def redact_annotations(df: DataFrame, policy: Policy, fields=DEFAULT_FIELDS["annotations"],
                       where: Column | None = None) -> DataFrame:
    """All columns, whatever they are; masked only where ``fields`` says so."""
    if where is not None:
        df = df.where(where)
    return redact(df, tuple(fields), policy) if fields else df


REDACTORS = {"spans": redact_spans, "logs": redact_logs, "annotations": redact_annotations}
