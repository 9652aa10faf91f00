"""Language identification in two steps: the family first, then one-versus-one linear SVMs within it.

Texts become hashed byte n-gram counts (square roots, length one).  One-versus-one support vector
machines tell the families apart; a document's votes then pick its family, and only the machines
between that family's languages decide the rest.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailcast.llm.common import batch_of, filter_rows, hashed_ngrams, slices, text_bytes

ORDERS, BITS = (2, 3), 12
PARTS = 64  # in which a language's candidates are limited first
PER_LANGUAGE = 400  # labelled documents per language that the machines are fitted on, at most
COST, ROUNDS = 4.0, 15
LETTER = re.compile(r"[^\W\d_]")  # or one of a few numerals, which isalpha() sorts out
# Families of ISO 639-1 codes; any other label is a family of its own
FAMILIES = {
    "germanic": ("de", "en", "nl", "sv", "da", "no", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl"),
    "slavic": ("ru", "uk", "pl", "cs", "sk", "bg", "sr", "hr", "sl"),
}
PREDICTION = "doc_id long, lang_pred string, score double, family string"


def family_of(lang: str, families: dict[str, tuple[str, ...]] = FAMILIES) -> str:
    return next((f for f, codes in families.items() if lang in codes), lang)


def features(text: bytes, orders: tuple[int, ...] = ORDERS, bits: int = BITS) -> np.ndarray:
    """Square roots of hashed n-gram counts, scaled to length one, and a constant 1 for the bias."""
    out = np.ones((1 << bits) + 1, dtype=np.float32)
    n = np.bincount(np.concatenate([hashed_ngrams(text.lower(), k, bits) for k in orders]), minlength=1 << bits)
    root = np.sqrt(n)
    out[:-1] = root / max(1.0, float(np.sqrt(n.sum())))
    return out


def fit_svm(x: np.ndarray, y: np.ndarray, cost: float = COST, rounds: int = ROUNDS) -> np.ndarray:
    """Weights of a linear SVM with hinge loss, by dual coordinate descent (Hsieh et al. 2008).

    ``y`` is +1 or -1.  Rows are visited in a fixed shuffled order, so equal input gives equal weights.
    """
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    size, order = (x.astype(np.float64) ** 2).sum(axis=1), np.random.default_rng(7)
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            new = min(max(alpha[i] - (y[i] * (w @ x[i]) - 1) / size[i], 0.0), cost)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


def training_rows(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, data) of at most ``per_language`` documents of each language, those first in hash order.

    ``docs`` has doc_id, text, lang; rows without any of them, and texts without a letter, are not learned from.
    """
    fit = docs.where("doc_id is not null and lang is not null and text is not null").where(F.col("text").rlike("\\p{L}"))
    chosen = fit.select("doc_id", "lang", F.pmod(F.xxhash64(F.lit(1), "doc_id"), F.lit(PARTS)).alias("part"))
    for keys in (("lang", "part"), ("lang",)):  # in two steps, so that no task meets the candidates of all other tasks
        order = Window.partitionBy(*keys).orderBy(F.xxhash64("doc_id"), "doc_id")  # Spark limits each group before the shuffle
        chosen = chosen.withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language).drop("n")
    ids = chosen.select("doc_id").distinct()
    # at most per_language ids for each language: small beside the texts
    return (fit.join(F.broadcast(ids) if _small(ids) else ids, "doc_id", "left_semi")
            .select("doc_id", "lang", text_bytes().alias("data")))


def _small(ids: DataFrame, most: int = 200_000) -> bool:
    return ids.limit(most + 1).count() <= most


def _fit(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values(["own", "doc_id", "x"])
    x = np.vstack([np.frombuffer(b, np.float32) for b in pdf["x"]])
    y = np.where(pdf["own"] == pdf["one"], 1, -1)
    return pd.DataFrame({"grp": [pdf["grp"].iloc[0]], "one": [pdf["one"].iloc[0]], "two": [pdf["two"].iloc[0]],
                         "w": [fit_svm(x, y).astype(np.float32).tobytes()]})


class Languages:
    """Learned machines: ``pairs[group]`` lists (one, two, weights); the empty group holds the families."""

    def __init__(self, pairs: dict[str, list[tuple[str, str, np.ndarray]]], langs: dict[str, list[str]]):
        self.pairs, self.langs = pairs, langs

    def choose(self, group: str, names: list[str], x: np.ndarray) -> tuple[str, float]:
        """Most votes, then the largest sum of margins; the score is the least sure of the winner's machines."""
        if len(names) == 1:
            return names[0], 1.0
        votes, margin, least = dict.fromkeys(names, 0), dict.fromkeys(names, 0.0), dict.fromkeys(names, 1.0)
        for one, two, w in self.pairs[group]:
            m = float(w @ x)
            votes[one if m >= 0 else two] += 1
            for name, side in ((one, m), (two, -m)):
                margin[name] += side
                least[name] = min(least[name], 1 / (1 + np.exp(-4 * np.clip(side, -50, 50))))
        best = max(names, key=lambda n: (votes[n], margin[n], n))
        return best, least[best]

    def predict(self, text: bytes) -> tuple[str, float, str | None]:
        if not self.langs or not any(m[0].isalpha() for m in LETTER.finditer(text.decode("utf-8", "replace"))):
            return "und", 0.0, None
        x = features(text)
        family, sure = self.choose("", sorted(self.langs), x)
        lang, more = self.choose(family, self.langs[family], x)
        return lang, float(sure * more), family


def fit_languages(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Languages:
    """Fit all machines on ``docs`` (doc_id, text, lang), one machine a task.  No labelled text: no language."""
    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch_of("doc_id long, lang string, x binary", [
                (i, lang, features(t.as_py()).tobytes())
                for i, lang, t in zip(batch.column("doc_id").to_pylist(), batch.column("lang").to_pylist(), batch.column("data"))])

    spark = docs.sparkSession
    rows = training_rows(docs, per_language).mapInArrow(vectors, "doc_id long, lang string, x binary").persist()
    seen = sorted(r[0] for r in rows.select("lang").distinct().collect())
    langs: dict[str, list[str]] = {}
    for lang in seen:
        langs.setdefault(family_of(lang), []).append(lang)
    jobs = [("", a, b, lang, a if lang in langs[a] else b)
            for a, b in combinations(sorted(langs), 2) for lang in (*langs[a], *langs[b])]
    jobs += [(f, a, b, lang, lang) for f, names in langs.items() for a, b in combinations(names, 2) for lang in (a, b)]
    pairs: dict[str, list[tuple[str, str, np.ndarray]]] = {}
    if jobs:
        table = spark.createDataFrame(jobs, "grp string, one string, two string, lang string, own string")
        fitted = (rows.join(F.broadcast(table), "lang").groupBy("grp", "one", "two")
                  .applyInPandas(_fit, "grp string, one string, two string, w binary").collect())
        for r in sorted(fitted, key=lambda r: (r["grp"], r["one"], r["two"])):
            pairs.setdefault(r["grp"], []).append((r["one"], r["two"], np.frombuffer(r["w"], np.float32)))
    rows.unpersist()
    return Languages(pairs, langs)


def _predict(model: Languages):
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch):
                yield batch_of(PREDICTION, [(i, *model.predict(t.as_py()))
                                            for i, t in zip(some.column("doc_id").to_pylist(), some.column("data"))])
    return predict


def predict_languages(docs: DataFrame, model: Languages) -> DataFrame:
    """The PREDICTION columns for every row of ``doc_id, text``, from the whole text only.

    Null text, text without a letter, or a model without languages: lang_pred ``und``, score 0, family
    null.  Rows that repeat or lack an id are predicted each on its own; a text of any length counts
    as a whole; other columns are left out.
    """
    rows = docs.select(F.col("doc_id").cast("long"), text_bytes().alias("data"))
    return rows.mapInArrow(_predict(model), PREDICTION)


def keep_known(docs: DataFrame, model: Languages, least: float) -> DataFrame:
    """The rows of ``docs`` in a learned language with a score of ``least`` or more, with all their columns."""
    def known(text: bytes) -> bool:
        lang, score, _ = model.predict(text)
        return lang != "und" and score >= least
    return filter_rows(docs, known)


def held_out(doc_id: str = "doc_id") -> F.Column:
    """True for the third of the documents that no machine learns from (null id: false)."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))
