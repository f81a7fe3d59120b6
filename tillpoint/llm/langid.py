"""Language identification by error-correcting output codes.

Every language gets a codeword; one binary classifier per bit tells the
languages whose bit is 1 from those whose bit is 0 by hashed character n-grams.
The classifiers are fitted on a bounded sample of labelled rows
(``sample_per_language`` distinct texts of each language in the mean): the sample's
n-gram counts are summed in Spark, and only counts per language and feature come
to the driver (languages x ``FEATURES`` numbers).  A text's bits have margins;
decoding adds up, for each codeword, the loss of every bit weighted by how well
that bit separates the sample's languages, and takes the codeword of least loss.
A small gap to the next one flags the text as ambiguous.
"""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillpoint.llm.common import text_batches, text_of, unit_hash

FEATURES = 1 << 14
SAMPLE = 2000
UND = "und"
_LETTERS = re.compile(r"[^\W\d_]+")
_STEPS = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77), np.uint32(0xC2B2AE3D))


def features(text: str) -> np.ndarray | None:
    """Counts of hashed 1-, 2- and 3-grams over the lower-cased words; None without a letter."""
    words = _LETTERS.findall(text.lower())
    if not any(c.isalpha() for w in words for c in w):
        return None
    code = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    one = code * _STEPS[0]
    two = (one[:-1] ^ np.uint32(0x27D4EB2F)) + code[1:] * _STEPS[1]
    three = (two[:-1] ^ np.uint32(0x165667B1)) + code[2:] * _STEPS[2]
    at = np.concatenate([(x * np.uint32(0x2545F491)) >> np.uint32(18) for x in (one, two, three)])
    return np.bincount(at, minlength=FEATURES).astype(np.float32)


def codewords(n: int, seed: int = 5) -> np.ndarray:
    """(n, bits) of 0/1: all splits of up to 5 languages; beyond, 10*log2(n) balanced columns chosen for row distance."""
    if n <= 5:
        splits = [(1, *rest) for rest in itertools.product((0, 1), repeat=max(0, n - 1)) if 0 in rest]
        return np.array(splits, np.int8).reshape(len(splits), n).T
    bits = int(np.ceil(10 * np.log2(n)))
    pick = np.random.default_rng(seed)
    best, far = None, -1
    for _ in range(40):
        code = np.stack([pick.permutation(np.arange(n) % 2) for _ in range(bits)], 1).astype(np.int8)
        alike = (2.0 * code - 1) @ (2.0 * code - 1).T          # bits minus twice the distance, for all pairs at once
        np.fill_diagonal(alike, -np.inf)
        near = int((bits - alike.max()) / 2)
        if near > far:
            best, far = code, near
    if far < 1:
        raise ValueError(f"no {n} different codewords of {bits} bits were drawn")
    return best


@dataclass
class Ecoc:
    languages: list[str]
    code: np.ndarray
    weights: np.ndarray      # (bits, FEATURES)
    trust: np.ndarray        # (bits,)
    gap: float = 0.15

    @classmethod
    def fit(cls, languages: list[str], counts: np.ndarray) -> Ecoc:
        """``counts``: (languages, FEATURES) of n-grams in the sample."""
        code = codewords(len(languages))
        # every language counts alike, however much of it there is
        dist = (counts + 0.5) / (counts.sum(1, keepdims=True) + 0.5 * counts.shape[1]) if len(languages) else counts
        weights, trust = [], []
        for b in range(code.shape[1]):
            yes, no = dist[code[:, b] == 1].mean(0), dist[code[:, b] == 0].mean(0)
            w = np.log(yes) - np.log(no)
            weights.append(w)
            sep = dist @ w * np.where(code[:, b] == 1, 1.0, -1.0)   # mean margin of each language on its side
            trust.append(max(1e-3, float(sep.min())))
        weights = np.array(weights, np.float32).reshape(code.shape[1], FEATURES)
        trust = np.array(trust)
        return cls(languages, code, weights, trust / trust.sum() if len(trust) else trust)

    def predict(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score from 0 to 1, ambiguous)."""
        x = features(text) if text and self.languages else None
        if x is None:
            return UND, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        margin = (self.weights @ x) / np.sqrt(x.sum())
        signs = np.where(self.code == 1, 1.0, -1.0)
        loss = (np.logaddexp(0.0, -signs * margin[None, :]) * self.trust[None, :]).sum(1)
        odds = np.exp((loss.min() - loss) * len(self.trust))
        score = float(odds.max() / odds.sum())
        best = int(np.argmin(loss))   # ties: the first language in order
        rest = np.partition(loss, 1)[1] - loss[best]
        return self.languages[best], score, bool(rest < self.gap)


def fit(labelled: DataFrame, text_col: str = "text", lang_col: str = "lang", sample_per_language: int = SAMPLE, seed: int = 23) -> Ecoc:
    """Fit on rows with a text and a language: a draw by text hash of ``sample_per_language`` texts each in the mean.

    Copies count as one text, so a text that a third of the rows repeat neither fills the sample nor thins it out.
    """
    rows = labelled.select(text_of(labelled, text_col).alias("t"), F.col(f"`{lang_col}`").cast("string").alias("l")).filter("l is not null")
    texts = rows.select("l", F.xxhash64("t").alias("h")).distinct()
    sizes = {r["l"]: r["n"] for r in texts.groupBy("l").agg(F.count("*").alias("n")).collect()}   # a row per language
    languages = sorted(sizes)
    counts = np.zeros((len(languages), FEATURES))
    if not languages:
        return Ecoc.fit(languages, counts)
    spark = labelled.sparkSession
    rate = spark.createDataFrame([(k, min(1.0, sample_per_language / n)) for k, n in sizes.items()], "k string, p double")
    drawn = rows.join(F.broadcast(rate), F.col("l") == F.col("k")).filter(unit_hash(F.col("t"), seed=seed) < F.col("p")).select("t", "l").distinct()

    def count(batches):
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for t, lang in zip(batch["t"], batch["l"]):
                x = features(t)
                if x is not None:
                    total[lang] = total.get(lang, 0) + x.astype(np.float64)
        for lang, x in total.items():
            at = np.flatnonzero(x)
            yield pd.DataFrame({"l": lang, "f": at.astype(np.int32), "n": x[at].astype(np.int64)})

    summed = drawn.mapInPandas(count, "l string, f int, n long").groupBy("l", "f").agg(F.sum("n").alias("n"))
    got = summed.toPandas()   # at most languages x FEATURES rows
    place = {k: i for i, k in enumerate(languages)}
    counts[got["l"].map(place).to_numpy(np.int64), got["f"].to_numpy(np.int64)] = got["n"].to_numpy(np.float64)
    return Ecoc.fit(languages, counts)


def predictor(spark: SparkSession, model: Ecoc):
    """text column -> struct(lang_pred, score, ambiguous).  Null texts, and texts without a letter, are ``und``, score 0."""
    shared = spark.sparkContext.broadcast(model)   # languages' codewords and bits x FEATURES weights

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predict(text: pd.Series) -> pd.DataFrame:
        model = shared.value
        return pd.DataFrame([model.predict(t) for t in text], columns=["lang_pred", "score", "ambiguous"])

    return lambda text: predict(text.cast("string"))


def identify(docs: DataFrame, train: Column, keep: dict, text_col: str = "text", lang_col: str = "lang", **options) -> DataFrame:
    """Fit on the rows where ``train`` holds, predict every row: the columns ``keep``, lang_pred, score, ambiguous.

    Defined results: a null language teaches nothing; without any labelled row every text is ``und``; repeated rows
    are predicted alike; an empty table gives an empty table; no other column is looked at.
    """
    text_batches(docs.sparkSession)
    model = fit(docs.filter(train), text_col, lang_col, **options)
    predict = predictor(docs.sparkSession, model)
    made = predict(F.col(f"`{text_col}`"))
    rows = docs.select(*[c.alias(n) for n, c in keep.items()], made.alias("p"))
    return rows.select(*keep, "p.lang_pred", "p.score", "p.ambiguous")
