"""Masking of VARIANT, JSON text, struct and array columns.

Only string values are masked. Keys, numbers, booleans and nulls keep their type, and the
result is valid JSON whatever a pattern matches.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import EACH, Policy, path_steps
from .detectors import detectors
from .masking import any_hit, bind, mask_text, replace_each

_STRING_LITERAL = r'"(?:[^"\\]++|\\.)*+"(?:\s*:)?'


def _mask_literals(json: Column, policy: Policy) -> Column:
    """Mask the string values of a JSON text at any depth; keys end in a colon and stay.

    The built-in patterns match neither quotes nor backslashes, so a value without escapes is
    masked as it stands. Others are decoded first and encoded again.
    """
    def change(literal: Column) -> Column:
        decoded = F.from_json(F.concat(F.lit("["), literal, F.lit("]")), "array<string>")[0]
        encoded = F.to_json(F.array(bind(decoded, lambda t: mask_text(t, policy))))
        recoded = encoded.substr(F.lit(2), F.length(encoded) - 2)
        kept = F.when(F.endswith(literal, F.lit(":")), literal)
        if policy.custom_patterns:
            return kept.otherwise(recoded)
        return kept.when(F.contains(literal, F.lit("\\")), recoded).otherwise(
            mask_text(literal, policy))
    return replace_each(json, _STRING_LITERAL, change)


def _mask_value(value: Column, policy: Policy) -> Column:
    """Mask one variant in which nothing is allow-listed."""
    kind = F.schema_of_variant(value)
    return (F.when(kind == "STRING",
                   bind(value.cast("string"), lambda t: mask_text(t, policy)).cast("variant"))
            .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"),
                  F.parse_json(bind(value.cast("string"), lambda t: _mask_literals(t, policy))))
            .otherwise(value))


def _allowed(policy: Policy) -> dict:
    """Allow-listed paths as a tree of steps; None stands for a value that stays whole."""
    tree = {}
    for steps in (*((key,) for key in policy.allowlisted_keys), *map(path_steps, policy.allowlisted_paths)):
        node = tree
        for step in steps[:-1]:
            node = node.setdefault(step, {})
            if node is None:
                break  # a shorter path keeps all of it
        else:
            node[steps[-1]] = None
    return tree


def _mask_below(value: Column, policy: Policy, kept: dict | None) -> Column:
    """Mask the string values of a variant except at the paths in ``kept``."""
    if kept is None:
        return value
    masked = _mask_value(value, policy)
    if not kept:
        return masked
    kind = F.schema_of_variant(value)
    whole = [key for key, below in kept.items() if key is not EACH and below is None]
    parts = {key: below for key, below in kept.items() if key is not EACH and below is not None}

    def change(key: Column, item: Column) -> Column:
        choice = F.when(key.isin(whole), item) if whole else F.when(F.lit(False), item)
        for name, below in parts.items():
            choice = choice.when(key == name, _mask_below(item, policy, below))
        return choice.otherwise(_mask_value(item, policy))

    result = F.when(value.isNull(), value)
    if whole or parts:
        entries = F.try_variant_get(value, "$", "map<string,variant>")
        result = result.when(kind.startswith("OBJECT"), F.to_variant_object(F.transform_values(entries, change)))
    if EACH in kept:
        items = F.try_variant_get(value, "$", "array<variant>")
        result = result.when(kind.startswith("ARRAY"), F.to_variant_object(
            F.transform(items, lambda item: _mask_below(item, policy, kept[EACH]))))
    return result.otherwise(masked)


def mask_variant(value: Column, policy: Policy) -> Column:
    """Mask the string values of a variant; the result is a variant.

    Values under allow-listed keys of the root and at allow-listed paths stay. A path that meets
    a value of another kind (a key on an array, ``[*]`` on an object) keeps nothing of it.
    """
    return _mask_below(value, policy, _allowed(policy))


def needs_masking(json: Column, policy: Policy) -> Column:
    """False only if no string value inside this JSON text can match a detector.

    Without a backslash every value stands in the text as it is. A custom pattern may be
    anchored to the start or end of a value, so it cannot be tried on the whole text.
    """
    if not detectors(policy):
        return F.lit(False)
    if policy.custom_patterns:
        return json.isNotNull()
    return F.contains(json, F.lit("\\")) | any_hit(json, policy)


def mask_variant_to_text(value: Column, text: Column, policy: Policy) -> Column:
    """Masked text of a variant; ``text`` is its plain cast. Most rows have no hit and stop there."""
    if _allowed(policy):
        masked = mask_variant(value, policy).cast("string")
    else:
        kind = F.schema_of_variant(value)
        masked = (F.when(kind == "STRING", mask_text(text, policy))
                  .when(kind.startswith("OBJECT") | kind.startswith("ARRAY"),
                        _mask_literals(text, policy)).otherwise(text))
    return F.when(needs_masking(text, policy), masked).otherwise(text)


def mask_json_text(text: Column, policy: Policy) -> Column:
    """Mask a JSON document held as text; text that is no JSON is masked as plain text."""
    masked = bind(F.try_parse_json(text), lambda v: F.when(
        v.isNotNull(), F.coalesce(mask_variant(v, policy).cast("string"), text)).otherwise(
            mask_text(text, policy)))
    return F.when(needs_masking(text, policy), masked).otherwise(text)


def has_variant(data_type: T.DataType) -> bool:
    if isinstance(data_type, T.VariantType):
        return True
    if isinstance(data_type, T.ArrayType):
        return has_variant(data_type.elementType)
    if isinstance(data_type, T.StructType):
        return any(has_variant(f.dataType) for f in data_type.fields)
    if isinstance(data_type, T.MapType):
        return has_variant(data_type.valueType)
    return False


def mask_typed(value: Column, data_type: T.DataType, policy: Policy) -> Column:
    """Mask every string inside a value and keep its type."""
    if isinstance(data_type, T.StringType):
        return mask_text(value, policy)
    if isinstance(data_type, T.VariantType):
        return mask_variant(value, policy)
    if isinstance(data_type, T.ArrayType):
        return F.transform(value, lambda item: mask_typed(item, data_type.elementType, policy))
    if isinstance(data_type, T.MapType):
        return F.transform_values(
            value, lambda _, item: mask_typed(item, data_type.valueType, policy))
    if isinstance(data_type, T.StructType):
        changed = [(f.name, mask_typed(value[f.name], f.dataType, policy))
                   for f in data_type.fields if _holds_text(f.dataType)]
        for name, masked in changed:
            value = value.withField(f"`{name}`", masked)
        return value
    return value


def _holds_text(data_type: T.DataType) -> bool:
    if isinstance(data_type, (T.StringType, T.VariantType)):
        return True
    if isinstance(data_type, T.ArrayType):
        return _holds_text(data_type.elementType)
    if isinstance(data_type, T.MapType):
        return _holds_text(data_type.valueType)
    if isinstance(data_type, T.StructType):
        return any(_holds_text(f.dataType) for f in data_type.fields)
    return False


def mask_array_to_text(value: Column, text: Column, data_type: T.DataType, policy: Policy) -> Column:
    """Mask the string values in an array and write it as JSON; ``text`` is its plain form."""
    if policy.events_as == "cast":
        return mask_text(text, policy)
    masked = (F.to_json(mask_typed(value, data_type, policy)) if _allowed(policy)
              else _mask_literals(text, policy))
    return F.when(needs_masking(text, policy), masked).otherwise(text)
