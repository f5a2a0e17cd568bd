"""Secrets in texts: fixed forms, and strings that are too random to be words."""
from __future__ import annotations

import math
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from spanveil.llm.text import map_texts

KINDS = ("assign", "access", "hex", "entropy")
WINDOW = 20
#: Least bits per character in a window, by the characters that a candidate is made of.
LEAST_BITS = {"hex": 3.1, "upper": 3.6, "alnum": 3.75, "base64": 3.8}
#: Marks of samples, which excuse the windows that they touch, and forms of known identifiers, which excuse a whole candidate. Fixed values.
ALLOWED = (r"example|sample|dummy|placeholder|changeme|xxxx|0000000|1234567|abcdef",
           r"[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}",
           r"[A-Za-z]+([-_/=+][A-Za-z]+)*[-_/=+]*", r"[-_/=+0-9]+", r"([A-Za-z]+|[0-9]+)([-_/=+]+([A-Za-z]+|[0-9]+))*")
_SPANS = ArrayType(StructType([StructField("kind", StringType(), False), StructField("start", IntegerType(), False),
                               StructField("end", IntegerType(), False)]), False)


def _patterns():
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                        re.IGNORECASE | re.ASCII)
    access = re.compile(r"AKIA[A-Z0-9]+")
    hexadecimal = re.compile(r"(?<![0-9a-f])[0-9a-f]{24,}")
    candidate = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{%d,}" % WINDOW)
    sample = re.compile(f"(?=({ALLOWED[0]}))", re.IGNORECASE)
    whole = [re.compile(p, re.IGNORECASE) for p in ALLOWED[1:]]
    return assign, access, hexadecimal, candidate, sample, lambda s: any(p.fullmatch(s) for p in whole)


def character_class(text: str) -> str:
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text):
        return "hex"
    if re.fullmatch(r"[A-Z0-9]+", text):
        return "upper"
    return "alnum" if text.isalnum() else "base64"


def random_spans(text: str, least: float, window: int = WINDOW, marks: list[tuple[int, int]] = ()) -> list[tuple[int, int]]:
    """Unions of all windows whose Shannon entropy reaches ``least`` bits and that mix letters and digits.

    Windows that overlap one of ``marks`` (start, end), ordered by start, don't count.

    Counts, and with them the sum of n * log2(n), change by one character out and one in.
    """
    table = [0.0] + [n * math.log2(n) for n in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, digits, letters = 0.0, 0, 0
    found: list[tuple[int, int]] = []
    mark, clear = 0, 0
    for i, c in enumerate(text):
        while mark < len(marks) and marks[mark][0] <= i:
            clear = max(clear, marks[mark][1])
            mark += 1
        if i >= window:
            old = text[i - window]
            n = counts[old]
            counts[old] = n - 1
            total -= table[n] - table[n - 1]
            digits -= old.isdigit()
            letters -= old.isalpha()
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += table[n + 1] - table[n]
        digits += c.isdigit()
        letters += c.isalpha()
        if i + 1 >= window + clear and digits > 1 and letters > 1 and math.log2(window) - total / window >= least:
            start = i + 1 - window
            if found and start <= found[-1][1]:
                found[-1] = (found[-1][0], i + 1)
            else:
                found.append((start, i + 1))
    return found


def finder():
    """A function from a text to its spans (kind, start, end), by start and then kind."""
    assign, access, hexadecimal, candidate, sample, allowed = _patterns()

    def find(text: str | None) -> list[tuple[str, int, int]]:
        text = text or ""
        base = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 6]
        base += [("access", *m.span()) for m in access.finditer(text) if len(m[0]) >= 20]
        base += [("hex", *m.span()) for m in hexadecimal.finditer(text)]
        more = []
        for m in candidate.finditer(text):
            if not allowed(m[0]):
                marks = [x.span(1) for x in sample.finditer(m[0])]
                for start, end in random_spans(m[0], LEAST_BITS[character_class(m[0])], marks=marks):
                    start, end = start + m.start(), end + m.start()
                    if not any(s <= start and end <= e for _, s, e in base):
                        more.append(("entropy", start, end))
        return sorted(base + more, key=lambda x: (x[1], KINDS.index(x[0]), x[2]))

    return find


def scan_secrets(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Adds ``secrets``: kind, start and end (exclusive) of each secret, in code points.

    Kinds ``assign``, ``access`` and ``hex`` have fixed forms. ``entropy`` spans are windows of
    20 characters with many different ones, inside a run of letters, digits and ``+/_=-`` that
    is no known identifier as a whole. Windows that touch the mark of a sample, and spans that
    another secret covers, don't count. A null or empty text has none.
    Each row is judged by itself, whatever its id; texts are read whole.
    """
    def make():
        find = finder()
        return lambda texts: {"secrets": [[{"kind": k, "start": s, "end": e} for k, s, e in find(t)] for t in texts]}

    return map_texts(docs, text, make, [StructField("secrets", _SPANS, False)], keep)


def redact_secrets(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """The documents with each secret replaced by ``mark``; overlapping secrets become one mark.

    Texts without a secret, and null, stay as they are. ``n_chars``, if there, follows the text.
    """
    def make():
        find = finder()

        def clean(text):
            spans = find(text)
            if not spans:
                return text
            out, at = [], 0
            for start, end in _united(spans):
                out += [text[at:start], mark]
                at = end
            return "".join(out) + text[at:]

        def work(texts):
            done = [clean(t) for t in texts]
            return {"text": done, "n_chars": [None if t is None else len(t) for t in done]}

        return work

    fields = [StructField("text", StringType())]
    if "n_chars" in docs.columns:
        fields.append(StructField("n_chars", LongType()))
    return map_texts(docs, "text", make, fields)


def _united(spans):
    out = []
    for _, start, end in spans:
        if out and start < out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return out


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind and the spans as text, from the result of ``scan_secrets``."""
    def joined(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def count(kind):
        return F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("secrets", lambda s: s["kind"] != "entropy")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
                        joined(F.col("secrets")).alias("spans"))
