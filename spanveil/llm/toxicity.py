"""Toxicity of texts: boosted trees over a few dense features, with isotonic calibration."""
from __future__ import annotations

import re

import numpy as np
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType, StructField

from spanveil.llm.text import labelled_sample, map_texts, written

#: Labelled documents to learn from, and terms of the learned lexicon, at most.
SAMPLE = 12_000
TERMS = 2_000
FOLDS, HELD_OUT = 3, 1
PREFIXES = (4, 5, 6, 7)
#: Insults, and words of the second person, in the languages of the corpus. Fixed values.
INSULTS = frozenset("""idiot idiots moron morons loser losers stupid pathetic worthless scum trash clown disgusting dumb
dumbass fool freak garbage jerk lunatic maggot pig retard shut sucker vermin bastard
idiota idiotas imbécil estúpido estúpida basura payaso asqueroso inútil escoria imbécile crétin crétine débile ordure
minable pitoyable abruti dummkopf trottel versager abschaum dreck widerlich erbärmlich blöd dumm""".split())
SECOND = frozenset("""you your yours yourself u ur du dich dir dein deine euch ihr sie tu te ti tú tus usted ustedes vosotros
toi vous votre vos ton ta tes""".split())
_LEET = str.maketrans("013457@$", "oieastas")
_MIXED = re.compile(r"(?<![A-Za-z])[A-Za-z]++[0-9@$*!]++[A-Za-z]++")
_SPACED = re.compile(r"\b(?:[A-Za-z][ .\-_]){3,}[A-Za-z]\b")
_STRETCHED = re.compile(r"([A-Za-z])\1{2,}")
_WORD = re.compile(r"[^\W_]+(?:[@$*!][^\W_]+)*")
NAMES = ("insult_share", "insult_count", "learned_share", "learned_count", "learned_best", "near_second", "capitals",
         "shouted", "exclaimed", "obfuscated", "stretched", "length")


def terms_of(word: str) -> list[str]:
    """A word and its beginnings, marked with ``*``."""
    return [word, *(word[:n] + "*" for n in PREFIXES if n <= len(word))]


def plain(word: str) -> str:
    """A word without disguise: small letters, digits and signs read as letters, stretched letters once."""
    word = word.lower()
    if not word.isalpha():
        word = word.translate(_LEET)
    return _STRETCHED.sub(r"\1", word)


class _Odds(dict):
    """Evidence of a word: log-odds of its strongest learned term (0 if none), whether it is an insult or second person."""

    def __init__(self, lexicon: dict[str, tuple[int, int]], prior: float):
        super().__init__()
        self.lexicon, self.prior = lexicon, prior

    def odds(self, toxic: int, clean: int) -> float:
        return float(np.log((toxic + 0.5) / (clean + 0.5)) - self.prior)

    def __missing__(self, token: str) -> tuple[tuple, bool, bool]:
        if len(self) > 500_000:
            self.clear()
        word = plain(token)
        found = [self.lexicon[t] for t in terms_of(word) if t in self.lexicon]
        value = self[token] = (tuple(found), word in INSULTS or token.lower() in INSULTS, token.lower() in SECOND)
        return value


def dense(text: str | None, odds: _Odds, own: int | None = None) -> list[float]:
    """The features of a text. ``own`` is the label of a text that the lexicon was counted on:
    its own share in the counts is taken out first."""
    text = text or ""
    tokens = _WORD.findall(text)
    n = len(tokens)
    insults, learned, best, near, last_you, last_bad = 0, 0, 0.0, 0, -9, -9
    kept = map(odds.__getitem__, tokens)
    for i, (found, insult, second) in enumerate(kept):
        if not (found or insult or second):
            continue
        strongest = 0.0
        for toxic, clean in found:
            if own is not None:
                toxic, clean = toxic - own, clean - (1 - own)
                if toxic <= 0:
                    continue
            strongest = max(strongest, odds.odds(toxic, clean))
        bad = insult or strongest > 2.0
        insults += insult
        learned += strongest > 2.0
        best = max(best, strongest)
        if second:
            near += i - last_bad <= 5
            last_you = i
        if bad:
            near += i - last_you <= 5
            last_bad = i
    letters = sum(map(len, tokens))
    upper = len(re.findall(r"[A-Z]", text))
    rate = 100.0 / max(n, 1)
    return [insults * rate, float(insults), learned * rate, float(learned), best, near * rate, upper / max(letters, 1),
            len(re.findall(r"\b[A-Z]{3,}\b", text)) * rate, (text.count("!") + text.count("?")) * rate,
            (len(_MIXED.findall(text)) + len(_SPACED.findall(text))) * rate, len(_STRETCHED.findall(text)) * rate,
            float(np.log1p(n))]


def learn_lexicon(sample: DataFrame, terms: int = TERMS) -> dict[str, tuple[int, int]]:
    """Terms that mark toxic texts, with the numbers of toxic and of other texts that hold them.

    A term stands in three toxic texts or more and in at most a tenth as many others; the
    strongest ``terms`` are taken.
    """
    def make():
        def work(texts):
            out = []
            for text in texts:
                words = {plain(w) for w in set(_WORD.findall(text or ""))}
                out.append(list({t for w in words for t in terms_of(w)}))
            return {"terms": out}

        return work

    held = map_texts(sample, "text", make, [StructField("terms", ArrayType(StringType(), False), False)], ["label"])
    counts = (held.select("label", F.explode("terms").alias("term")).groupBy("term")
              .agg(F.sum("label").alias("toxic"), F.sum(1 - F.col("label")).alias("clean")))
    rows = (counts.where("toxic >= 3 and clean * 10 <= toxic")
            .orderBy(F.desc(F.col("toxic") / (F.col("clean") + 1)), "term").limit(terms).collect())
    return {r["term"]: (int(r["toxic"]), int(r["clean"])) for r in rows}


def _featured(docs: DataFrame, lexicon: dict, prior: float, keep: list[str] | None) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast((lexicon, prior))

    def make():
        odds = _Odds(*shared.value)
        return lambda texts: {"dense": [dense(t, odds) for t in texts]}

    return map_texts(docs, "text", make, [StructField("dense", ArrayType(DoubleType(), False), False)], keep)


def _left_out(sample: DataFrame, lexicon: dict, prior: float) -> DataFrame:
    """Features of the sample, each text without its own part of the lexicon's counts."""
    shared = sample.sparkSession.sparkContext.broadcast((lexicon, prior))

    def make():
        odds = _Odds(*shared.value)
        return lambda texts: {"as_toxic": [dense(t, odds, 1) for t in texts], "as_clean": [dense(t, odds, 0) for t in texts]}

    kind = ArrayType(DoubleType(), False)
    both = map_texts(sample, "text", make, [StructField("as_toxic", kind, False), StructField("as_clean", kind, False)], ["doc_id", "label"])
    return both.select("doc_id", F.col("label").cast("double").alias("label"),
                       F.when(F.col("label") == 1, F.col("as_toxic")).otherwise(F.col("as_clean")).alias("dense"))


class Model:
    """Lexicon, trees and calibration. Without labels of both classes, only a constant."""

    def __init__(self, lexicon, prior, trees=None, curve=None, constant=0.5):
        self.lexicon, self.prior, self.trees, self.curve, self.constant = lexicon, prior, trees, curve, constant


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, terms: int = TERMS) -> Model:
    """A model from the labelled documents outside the held-out fold, ``sample`` of them at most.

    Trees learn from three quarters of them, the isotonic curve from the rest.
    """
    chosen = written(labelled_sample(docs, labels, "toxic", sample, FOLDS, HELD_OUT))
    n, toxic = chosen.agg(F.count("*"), F.coalesce(F.sum("label"), F.lit(0))).first()
    if not 0 < toxic < n:
        return Model({}, 0.0, constant=(toxic + 1) / (n + 2))
    prior = float(np.log((toxic + 0.5) / (n - toxic + 0.5)))
    lexicon = learn_lexicon(chosen, terms)
    rows = written(_left_out(chosen, lexicon, prior).withColumn("features", array_to_vector("dense"))
                   .withColumn("turn", F.row_number().over(_by_class()) % 4).drop("dense"))
    learn, check = rows.where("turn <> 3"), rows.where("turn = 3")
    if min(check.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()) == 0:
        learn = check = rows
    trees = GBTClassifier(maxIter=20, maxDepth=3, stepSize=0.2, seed=5, maxBins=64).fit(learn)
    curve = IsotonicRegression(featuresCol="probability", featureIndex=1, predictionCol="calibrated").fit(
        trees.transform(check).select("probability", "label"))
    return Model(lexicon, prior, trees, curve)


def _by_class():
    return Window.partitionBy("label").orderBy(F.xxhash64("doc_id"), "doc_id")


def score_toxicity(docs: DataFrame, model: Model, keep: list[str] | None = None) -> DataFrame:
    """Adds ``score``: the probability of label 1, from the whole text alone. Null counts as empty.

    Rows are scored one by one, whatever their ids. Equal calibrated scores are common, as the
    curve has steps.
    """
    columns = docs.columns if keep is None else keep
    if model.trees is None:
        return docs.select(*[c for c in columns if c != "score"], F.lit(float(model.constant)).alias("score"))
    found = _featured(docs, model.lexicon, model.prior, [c for c in columns if c != "score"])
    judged = model.trees.transform(found.withColumn("features", array_to_vector("dense")))
    judged = model.curve.transform(judged)
    score = F.least(F.greatest(F.col("calibrated"), F.lit(0.0)), F.lit(1.0))
    return judged.select(*[c for c in columns if c != "score"], score.alias("score"))
