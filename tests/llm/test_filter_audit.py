"""The audit of filters against a plain count over all orders."""
from fractions import Fraction
from itertools import permutations
from math import factorial

from spanveil.llm import filter_audit


def small(text):
    """Failed filters of one text, but for E."""
    words = text.replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    return {"A": len(words) < 50, "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * sum("A" <= c <= "Z" for c in text) > 5 * len(text), "D": any(c in "#$%&*|" for c in text)}


def plain(rows, labels):
    """All result rows, by applying the filters one after the other in each order."""
    docs = []
    for doc_id, text, source in rows:
        text = text or ""
        failed = {f for f, x in small(text).items() if x}
        if doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows):
            failed.add("E")
        marks = [(q, t) for i, q, t in labels if i is not None and i == doc_id]
        docs.append((source or "", failed, any(q == 1 for q, _ in marks), any(t == 1 for _, t in marks)))
    out, total = {}, {}
    for part in {d[0] for d in docs}:
        for order in permutations("ABCDE"):
            left = [d[1:] for d in docs if d[0] == part]
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[0]]
                left = [d for d in left if f not in d[0]]
                fails = [d[1] for d in docs if d[0] == part and f in d[1]]
                total[part, f] = total.get((part, f), 0) + len(gone)
                out[part, "".join(order), step] = [len(left), len(gone), len(fails) - len(gone), sum(x == {f} for x in fails),
                                                   sum(d[1] for d in gone), sum(d[2] for d in gone)]
    return {k: (*v, total[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


def test_audit_counts_as_filters_applied_in_turn(spark):
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, long, "a"), (2, long, "b"), (2, long, "a"), (3, None, None), (4, "", ""), (None, "", "a"), (None, long, "b"),
            (5, "SHOUT # " * 30, "a"), (6, "SHOUT # " * 30, "a"), (7, " x\ty\nz " * 9, "b"), (8, long + " 5%", "b"),
            (9, "same " * 20_000, "a"), (10, long.upper(), "c"), (11, "\U0001f600 " * 70, "c"), (1, "A" * 60, "c")]
    labels = [(1, 1, 0), (1, 0, 1), (2, 1, None), (5, 0, 1), (6, 1, 1), (None, 1, 1), (77, 1, 1), (10, None, 1)]
    docs = spark.createDataFrame([(*r, "x", 5) for r in rows], "doc_id long, text string, source string, failed string, words int")
    got = filter_audit.audit(filter_audit.failures(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))).collect()
    want = plain(rows, labels)
    assert len(got) == len(want) == 4 * 600
    assert {(r["part"], r["filter_order"], r["step"]): tuple(r)[3:] for r in got} == want


def test_audit_of_nothing_and_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.failures(none, labels)).count() == 0
    one = spark.createDataFrame([(1, "clean", "s")], "doc_id long, text string, source string")
    rows = filter_audit.audit(filter_audit.failures(one, labels)).collect()
    assert len(rows) == 600 and sum(r["removed"] for r in rows) == 120 and {r["good_lost"] for r in rows} == {0}


def test_weights_give_shapley_values():
    weights = filter_audit.shapley_weights(4)
    value = [Fraction((s * 37 + s * s * 11) % 101) for s in range(16)]
    value[0] = Fraction(0)
    for i in range(4):
        mean = sum(value[sum(1 << j for j in order[:order.index(i) + 1])] - value[sum(1 << j for j in order[:order.index(i)])]
                   for order in permutations(range(4))) / factorial(4)
        assert sum(w * v for w, v in zip(weights[i], value)) == mean
