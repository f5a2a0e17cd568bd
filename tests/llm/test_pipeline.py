"""The stages of the corpus pipeline on small tables, each on what the one before it kept."""
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline


@pytest.fixture
def folder(spark, tmp_path):
    """Writes the tables of a small corpus and returns their folder."""
    def write(rows, more=()):
        kind = "doc_id long, text string, lang string, source string, n_chars long" + "".join(f", {c} string" for c in more)
        spark.createDataFrame([(*r, "en", "s", 0, *more) for r in rows], kind).write.parquet(str(tmp_path / "documents.parquet"))
        labels = [(i, 1 if i < 60 else 0, 0) for i in range(120)] if rows else []
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
        items = [("q1", " ".join(f"item{k}" for k in range(15))), (None, "unnamed " + " ".join(f"thing{k}" for k in range(15))), ("e", None)]
        spark.createDataFrame(items, "item_id string, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
        return str(tmp_path)

    return write


def prose(i):
    return f"The quiet river number {i} runs past the fields of village {i * 7}, and nobody there counts its {i * 3} old mills."


def test_pipeline_on_odd_rows(spark, folder):
    rows = [(i, prose(i)) for i in range(60)] + [(i, f"BUY!! NOW!! {i}!! CHEAP!! CLICK!! {i * 3}!! HERE!!") for i in range(60, 120)]
    passage, unnamed = " ".join(f"item{k}" for k in range(15)), "unnamed " + " ".join(f"thing{k}" for k in range(15))
    rows += [(200, prose(200)), (201, prose(200)), (202, prose(202)), (202, prose(202)), (None, prose(203)), (None, None), (210, None), (211, ""),
             (220, prose(220) + " " + passage + " " + prose(221)), (221, passage), (222, prose(222) + " " + unnamed),
             (230, prose(230) + " password: hunter2secret " + prose(231)), (240, "".join(prose(k) + " " for k in range(300, 700)))]
    result = corpus_pipeline.run(spark, folder(rows, ("score", "stays_", "hits_before", "row"))).collect()
    tokenizer = Tokenizer.from_file(corpus_pipeline.VOCABULARY)
    texts = {}
    for r in sorted(result, key=lambda r: (r["doc_id"] is None, r["doc_id"], r["piece"])):
        ids = np.frombuffer(r["ids"], "<u4")
        assert len(ids) == r["length"] <= 2048 and zlib.crc32(r["ids"]) == r["ids_crc32"]
        texts[r["doc_id"]] = texts.get(r["doc_id"], []) + ids.tolist()

    def packed(text):
        return tokenizer.encode(text, add_special_tokens=False).ids + [0]

    assert all(texts[i] == packed(prose(i)) for i in range(60)) and not any(i in texts for i in range(60, 120))
    assert texts[200] == packed(prose(200)) and 201 not in texts and texts[202] == packed(prose(202))
    assert texts[220] == packed(prose(220) + " \n " + prose(221)) and 221 not in texts
    assert not set(tokenizer.encode("unnamed thing3", add_special_tokens=False).ids[-2:]) <= set(texts[222])
    assert "hunter" not in tokenizer.decode(texts[230]) and texts[240] == packed("".join(prose(k) + " " for k in range(300, 700)))
    assert None in texts


def test_pipeline_on_nothing(spark, folder):
    assert corpus_pipeline.run(spark, folder([])).count() == 0
