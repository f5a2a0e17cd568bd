"""Masking of plain text as native column expressions."""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..config import Policy
from .detectors import Detector, detectors

_FIXED_LENGTH = 8  # a mask of one length does not tell the length of the value
_HASH_LETTERS = 20
_MARK = "\uffff"  # no character, so hardly any text holds it


def token(detector: Detector, policy: Policy) -> str:
    if policy.mode == "remove":
        return ""
    if policy.mask_character:
        return policy.mask_character * _FIXED_LENGTH
    return f"[{detector.name.upper()}]"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and use it several times in ``body``."""
    return F.transform(F.array(value), body)[0]


def replace_each(text: Column, pattern: str, change: Callable[[Column], Column]) -> Column:
    """Replace each match by a function of the match; a text costs one search.

    Matches are set between marks and the pieces taken apart at them: a split at one character
    compiles no pattern, one at ``pattern`` would for every text. A text that holds the mark itself
    is split at the pattern. ``text`` is used more than once, see ``bind``.
    """
    def changed(match: Column) -> Column:
        return F.coalesce(change(match), F.lit(""))

    def at_marks(marked: Column) -> Column:
        return F.array_join(F.transform(F.split(marked, _MARK, -1), lambda piece, i: F.when(
            i % 2 == 1, changed(piece)).otherwise(piece)), "")

    def at_pattern(matches: Column) -> Column:
        return F.array_join(F.flatten(F.zip_with(
            F.split(text, pattern, -1), F.transform(matches, change),
            lambda piece, match: F.array(piece, F.coalesce(match, F.lit(""))))), "")

    marked = F.regexp_replace(text, F.lit(pattern), F.lit(f"{_MARK}$0{_MARK}"))
    with_mark = bind(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
                     lambda matches: F.when(F.size(matches) > 0, at_pattern(matches)).otherwise(text))
    return F.when(F.contains(text, F.lit(_MARK)), with_mark).otherwise(
        bind(marked, lambda m: F.when(F.contains(m, F.lit(_MARK)), at_marks(m)).otherwise(text)))


def _normal_form(value: Column, form: str) -> Column:
    if form == "lower":
        return F.lower(value)
    if form == "digits":
        return F.regexp_replace(value, r"\D", "")
    if form == "phone":
        return F.regexp_replace(F.regexp_replace(value, r"\D", ""), r"^1(?=\d{10}$)", "")
    return value


def _digest(detector: Detector, policy: Policy) -> Callable[[Column], Column]:
    """A tagged hash without digits, so that no detector finds it again."""
    def change(value: Column) -> Column:
        hexadecimal = F.sha2(F.concat(F.lit(policy.salt), _normal_form(value, detector.normal_form)),
                             256)
        letters = F.translate(hexadecimal, "0123456789abcdef", "abcdefghijklmnop")
        return F.concat(F.lit(f"[{detector.name.upper()}:"), F.substring(letters, 1, _HASH_LETTERS),
                        F.lit("]"))
    return change


def apply_detector(text: Column, detector: Detector, policy: Policy) -> Column:
    if policy.mode != "hash":
        return F.regexp_replace(text, F.lit(detector.pattern), F.lit(token(detector, policy)))
    return bind(text, lambda t: replace_each(t, detector.pattern, _digest(detector, policy)))


def may_match(text: Column, detector: Detector) -> Column:
    """A cheap test that is true for every text in which the detector finds something."""
    if detector.needs == "@":
        return F.contains(text, F.lit("@"))
    return text.rlike("[0-9]") if detector.needs == "digit" else F.lit(True)


def mask_text(text: Column, policy: Policy) -> Column:
    """Mask a text column; null stays null.

    ``text`` is used more than once, so pass a column or a lambda variable (see ``bind``).
    """
    found = detectors(policy)

    def chain(*present: str) -> Column:
        masked = text
        for detector in found:
            if not detector.needs or detector.needs in present:
                masked = apply_detector(masked, detector, policy)
        return masked

    # Most texts lack the sign or the digits that most patterns need.
    gates = {d.needs: may_match(text, d) for d in found}

    def by_digit(*present: str) -> Column:
        if "digit" not in gates:
            return chain(*present)
        return F.when(gates["digit"], chain(*present, "digit")).otherwise(chain(*present))

    if not found:
        return text
    if "@" not in gates:
        return by_digit()
    return F.when(gates["@"], by_digit("@")).otherwise(by_digit())


def any_hit(text: Column, policy: Policy) -> Column:
    """True if some detector finds something in the text."""
    hit = F.lit(False)
    for need in ("", "@", "digit"):
        group = [d for d in detectors(policy) if d.needs == need]
        if group:
            found = reduce(or_, (text.rlike(d.pattern) for d in group))
            hit = hit | (may_match(text, group[0]) & found)
    return hit
