"""Licence notices and identifier tags in texts."""
from __future__ import annotations

import bisect
import itertools
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, IntegerType, LongType, StringType, StructField, StructType

from spanveil.llm.text import map_texts, words

#: Phrases whose places are counted, with their labels. Fixed values.
BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
#: More notice phrases, as words, and the tag before an expression.
NOTICES = {
    "bsd license": "bsd", "isc license": "isc", "mozilla public license": "mpl", "eclipse public license": "epl",
    "lesser general public license": "lgpl", "affero general public license": "agpl", "cc by": "cc-by",
    "cc by sa": "cc-by-sa", "cc by nc": "cc-by-nc", "cc by nd": "cc-by-nd", "cc by nc sa": "cc-by-nc-sa",
    "cc by nc nd": "cc-by-nc-nd", "cc0": "cc0", "public domain": "public-domain", "unlicense": "unlicense",
    "all rights reserved": "proprietary",
}
TAG = "spdx license identifier"
#: How freely a text under a licence may be used, from 0 to 1.
FREEDOM = {
    "mit": 1.0, "apache": 1.0, "bsd": 1.0, "isc": 1.0, "cc0": 1.0, "public-domain": 1.0, "unlicense": 1.0, "cc-by": 0.9,
    "mpl": 0.6, "epl": 0.6, "lgpl": 0.5, "cc-by-sa": 0.5, "gpl": 0.3, "agpl": 0.2, "cc-by-nd": 0.2, "cc-by-nc": 0.1,
    "cc-by-nc-sa": 0.1, "cc-by-nc-nd": 0.05, "proprietary": 0.0,
}
UNKNOWN = 0.2
_BINDING = {"or": 1, "and": 2, "with": 3}


def label_of(identifier: str) -> str:
    """The label of an identifier: versions and the marks for later versions go."""
    name = identifier.lower().rstrip("+")
    name = re.sub(r"-(only|or-later)$", "", name)
    name = re.sub(r"-v?\d+(\.\d+)*(-clause)?$", "", name)
    return "cc0" if name.startswith("cc0") else name


def postfix(expression: str) -> list[str] | None:
    """A licence expression in postfix order, by a shunting yard; None if it is malformed.

    WITH binds closest, then AND, then OR. Equal operators group from the left.
    """
    out: list[str] = []
    waiting: list[str] = []
    operand = False
    for token in re.findall(r"[()]|[A-Za-z0-9.+:-]+|\S", expression):
        low = token.lower()
        if token == "(":
            if operand:
                return None
            waiting.append(token)
        elif token == ")":
            if not operand:
                return None
            while waiting and waiting[-1] != "(":
                out.append(waiting.pop())
            if not waiting:
                return None
            waiting.pop()
        elif low in _BINDING:
            if not operand:
                return None
            while waiting and _BINDING.get(waiting[-1], 0) >= _BINDING[low]:
                out.append(waiting.pop())
            waiting.append(low)
            operand = False
        elif operand or not re.match(r"[A-Za-z0-9]", token):
            return None
        else:
            out.append(token)
            operand = True
    if not operand or "(" in waiting:
        return None
    return out + waiting[::-1]


def evaluate(expression: str) -> tuple[set[str], float] | None:
    """Labels and freedom of an expression: OR lets choose the freest part, AND binds to the strictest.

    WITH adds an exception to a licence, which makes it freer by half of what it lacks.
    """
    order = postfix(expression)
    if order is None:
        return None
    stack: list[tuple[set[str], float]] = []
    for token in order:
        if token not in _BINDING:
            label = label_of(token)
            stack.append(({label}, FREEDOM.get(label, UNKNOWN)))
            continue
        right, left = stack.pop(), stack.pop()
        if token == "with":
            stack.append((left[0], (1 + left[1]) / 2))
        else:
            stack.append((left[0] | right[0], (max if token == "or" else min)(left[1], right[1])))
    return stack[0]


_OUT = [StructField("n_words", LongType(), False),
        StructField("places", ArrayType(StructType([StructField("label", StringType()), StructField("start", IntegerType()),
                                                    StructField("base", IntegerType()), StructField("end", IntegerType())])), False),
        StructField("expressions", ArrayType(StructType([StructField("expression", StringType()), StructField("labels", ArrayType(StringType())),
                                                         StructField("freedom", DoubleType())])), False)]


def scan_licenses(docs: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Adds ``n_words``, ``places`` (label, first word, 1 for a base phrase) and ``expressions``.

    One automaton finds all phrases in the words of a text; a notice inside a longer phrase
    doesn't count, a base phrase does. After the words of the tag, the rest of the line is an expression. A
    malformed expression has the label ``unparsed`` and the freedom of an unknown licence. Null
    and empty texts have no words, places or expressions. Rows are taken one by one.
    """
    def make():
        import ahocorasick

        phrases = {**{p: (label, 1) for p, label in BASE.items()}, **{p: (label, 0) for p, label in NOTICES.items()}, TAG: ("", 0)}
        automaton = ahocorasick.Automaton()
        for phrase, (label, base) in phrases.items():
            automaton.add_word(f" {phrase} ", (len(phrase) + 1, label, base))
        automaton.make_automaton()
        phrase_words = {(label, base): len(phrase.split()) for phrase, (label, base) in phrases.items()}

        def near(places, place):
            at = bisect.bisect_left(places, place["start"] - 8, key=lambda p: p["end"])
            return itertools.takewhile(lambda p: p["end"] <= place["end"] + 8, places[at:at + 64])

        tag = re.compile(r"spdx[\W_]+license[\W_]+identifier[\x20\t]*:[\x20\t]*([^\r\n]*)", re.IGNORECASE | re.ASCII)
        expression = re.compile(r"[\sA-Za-z0-9.+:()-]+", re.ASCII)

        def expressions(text):
            out = []
            for m in tag.finditer(text):
                found = expression.match(m[1])
                if found and found[0].strip(" .-"):
                    value = evaluate(found[0].strip(" .-"))
                    labels, freedom = value or ({"unparsed"}, UNKNOWN)
                    out.append({"expression": found[0].strip(" .-"), "labels": sorted(labels), "freedom": freedom})
            return out

        def work(texts):
            out = {"n_words": [], "places": [], "expressions": []}
            for text in texts:
                tokens = words(text)
                line = (b" " + b" ".join(tokens) + b" ").decode("latin-1")
                places, at, number, tagged = [], 0, 0, False
                for end, (size, label, base) in automaton.iter(line):
                    start = end - size
                    number += line.count(" ", at, start) if start >= at else -line.count(" ", start, at)
                    at = start
                    if label:
                        places.append({"label": label, "start": number, "base": base, "end": number + phrase_words[label, base]})
                    else:
                        tagged = True
                out["n_words"].append(len(tokens))
                out["places"].append([p for p in places if p["base"] or not any(
                    q["start"] <= p["start"] and p["end"] <= q["end"] and q["end"] - q["start"] > p["end"] - p["start"] for q in near(places, p))])
                out["expressions"].append(expressions(text) if tagged else [])
            return out

        return work

    return map_texts(docs, "text", make, _OUT, keep)


def digest(found: DataFrame) -> DataFrame:
    """Counts, labels and a score from the result of ``scan_licenses``.

    The score is the freedom of the strictest licence found, and 0 without any.
    """
    def joined(*lists):
        return F.array_join(F.array_sort(F.array_distinct(F.concat(*lists))), ",")

    base = F.filter("places", lambda p: p["base"] == 1)
    starts = F.transform(base, lambda p: p["start"].cast("long"))
    freedom = F.create_map(*[F.lit(x) for pair in FREEDOM.items() for x in pair])
    free = F.concat(F.transform("places", lambda p: F.coalesce(F.try_element_at(freedom, p["label"]), F.lit(UNKNOWN))),
                    F.transform("expressions", lambda e: e["freedom"]))
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), joined(F.transform(base, lambda p: p["label"])).alias("base_labels"),
        joined(F.transform("places", lambda p: p["label"]), F.flatten(F.transform("expressions", lambda e: e["labels"]))).alias("labels"),
        F.coalesce(F.array_min(free), F.lit(0.0)).alias("score"))
