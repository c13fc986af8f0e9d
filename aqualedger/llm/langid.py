"""Language identification in two steps: the family first, then, within the family, linear
support vector machines for every two of its languages, which vote.

Features are hashed letter 1- to 3-grams of the whole text, as square roots of their
shares.  The machines are fitted on a bounded sample of labelled texts (by stochastic
sub-gradients on the squared hinge loss, averaged), each in a task of its own: a pair of
languages on their texts, a family on its texts against a pool that all families share.
Everything is predicted where the text lies."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .util import materialize, whole_text

WORD = re.compile(r"[^\W\d_]+")
CHARS_AT_ONCE = 1_000_000
UNKNOWN = "und"

# Families of languages by ISO 639-1 code; a language not listed here is a
# family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk sl hr sr bs mk bg",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk tt",
    "semitic": "ar he am mt",
    "indo-aryan": "hi bn ur pa mr gu ne si",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}


@dataclass(frozen=True)
class Settings:
    buckets: int = 4096
    sample_per_lang: int = 600
    pool: int = 6000  # texts of the sample, the first by hash, that every family is told apart from
    max_langs: int = 8192  # a machine has a row of 32 KB in the model; about 7,000 languages are spoken
    epochs: int = 30
    ridge: float = 1e-4
    families: dict[str, str] = field(default_factory=lambda: dict(FAMILY_OF))


def features(text: str, buckets: int) -> np.ndarray | None:
    """Unit vector of hashed 1- to 3-grams of the text's letters; None without a letter."""
    counts, any_letter, tail = np.zeros(buckets), False, " "
    for at in range(0, len(text), CHARS_AT_ONCE):
        words = WORD.findall(text[at : at + CHARS_AT_ONCE].lower())
        if not words:
            continue
        # a run of word characters may hold other numerals only
        any_letter = any_letter or any(c.isalpha() for w in words for c in w)
        joined = tail + " ".join(words) + " "
        code = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
        h = code * np.uint64(0x9E3779B97F4A7C15)
        for n in range(3):
            if n:
                h = (h[:-1] ^ code[n:]) * np.uint64(0x9E3779B97F4A7C15)
            counts += np.bincount((h >> np.uint64(40)) % np.uint64(buckets), minlength=buckets)
    if not any_letter:
        return None
    return np.sqrt(counts / counts.sum())


def fit_svm(x: np.ndarray, y: np.ndarray, epochs: int, ridge: float) -> tuple[np.ndarray, float]:
    """Weights and intercept of a linear machine on y = +1 or -1, classes weighted alike."""
    weight = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum())) * len(y)
    w, b = np.zeros(x.shape[1]), 0.0
    mean_w, mean_b, seen = np.zeros(x.shape[1]), 0.0, 0
    rng = np.random.default_rng(0)
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for at in range(0, len(y), 32):
            i = order[at : at + 32]
            gap = np.maximum(0, 1 - y[i] * (x[i] @ w + b)) * weight[i] * y[i]
            rate = 4.0 / (1 + 0.2 * epoch)
            w += rate * (gap @ x[i] / len(i) - ridge * w)
            b += 0.1 * rate * gap.mean()
            if epoch >= epochs // 2:
                mean_w, mean_b, seen = mean_w + w, mean_b + b, seen + 1
    return mean_w / max(1, seen), mean_b / max(1, seen)


@dataclass(frozen=True)
class Machines:
    """One-versus-rest machines, which tell families apart: rows of ``weights`` with ``names``."""

    names: list[str]
    weights: np.ndarray
    intercepts: np.ndarray

    def shares(self, x: np.ndarray) -> np.ndarray:
        """Margins as shares that add up to 1, the larger the likelier."""
        m = x @ self.weights.T + self.intercepts
        e = np.exp(3 * (m - m.max(axis=1, keepdims=True)))
        return e / e.sum(axis=1, keepdims=True)


@dataclass(frozen=True)
class Pairs:
    """One-versus-one machines: row k of ``weights`` is for the k-th two of ``names`` (in the order
    of itertools.combinations) and positive for the first of them."""

    names: list[str]
    weights: np.ndarray
    intercepts: np.ndarray

    def decide(self, x: np.ndarray) -> tuple[str, float]:
        """The language with the most votes (ties: the larger sum of its margins, then the first
        name), and how surely, 0 to 1, it beats the others on average (1 if it is alone)."""
        k = len(self.names)
        if k == 1:
            return self.names[0], 1.0
        first, second = np.array(list(combinations(range(k), 2))).T
        margins = self.weights @ x + self.intercepts
        votes = np.bincount(np.where(margins >= 0, first, second), minlength=k)
        sums = np.bincount(first, margins, k) - np.bincount(second, margins, k)
        best = max(range(k), key=lambda i: (votes[i], sums[i], -i))
        against = np.concatenate([margins[first == best], -margins[second == best]])
        return self.names[best], float(np.mean(1 / (1 + np.exp(-6 * np.clip(against, -50, 50)))))


@dataclass(frozen=True)
class Model:
    family: Machines
    languages: dict[str, Pairs]
    buckets: int

    def predict(self, texts: list[str]) -> tuple[list[str], list[float]]:
        langs, scores = [], []
        for text in texts:
            x = features(text, self.buckets)
            if x is None:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            p = self.family.shares(x[None])[0]
            f = int(p.argmax())
            lang, sure = self.languages[self.family.names[f]].decide(x)
            langs.append(lang)
            scores.append(float(p[f]) * sure)
        return langs, scores


def held_out(id_col: str = "doc_id", folds: int = 4, fold: int = 2) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def train(labelled: DataFrame, s: Settings) -> Model | None:
    """Fit on at most ``sample_per_lang`` texts per language of ``labelled`` (text, lang), those
    the first by text hash.  None if no labelled text has a letter."""
    rows = labelled.where("lang is not null").select("lang", "text", F.xxhash64("text").alias("h"))
    # the hash bucket up to which each language has enough distinct texts
    by = W.partitionBy("lang").orderBy("b")
    buckets = rows.select("lang", "h").distinct().groupBy("lang", F.pmod("h", F.lit(4096)).alias("b")).count()
    before = buckets.withColumn("before", F.sum("count").over(by) - F.col("count"))
    cuts = materialize(before.where(F.col("before") < s.sample_per_lang).groupBy("lang").agg(F.max("b").alias("cut")), "lang-cuts")
    if cuts.count() > s.max_langs:
        raise ValueError(f"more than {s.max_langs} languages")
    thinned = rows.join(F.broadcast(cuts), "lang").where(F.pmod("h", F.lit(4096)) <= F.col("cut")).dropDuplicates(["lang", "h"])
    ranked = thinned.withColumn("r", F.row_number().over(W.partitionBy("lang").orderBy(F.pmod("h", F.lit(4096)), "h")))
    chosen = ranked.where(F.col("r") <= s.sample_per_lang)

    def vectors(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = [(lang, h, features(t, s.buckets)) for lang, h, t in zip(pdf["lang"], pdf["h"], pdf["text"])]
            kept = [(s.families.get(lang, lang), lang, h, packed(x)) for lang, h, x in found if x is not None]
            yield pd.DataFrame(kept, columns=["family", "lang", "h", "x"])

    sample = chosen.select("lang", "h", "text").mapInPandas(vectors, "family string, lang string, h long, x binary")
    return fit_sample(materialize(sample, "lang-sample"), s)


def packed(x: np.ndarray) -> bytes:
    """A vector as the places and values of its few components."""
    at = np.flatnonzero(x)
    return at.astype("<u4").tobytes() + x[at].astype("<f4").tobytes()


def unpacked(rows: pd.Series, buckets: int) -> np.ndarray:
    out = np.zeros((len(rows), buckets), np.float32)
    for i, row in enumerate(rows):
        n = len(row) // 8
        out[i, np.frombuffer(row, "<u4", n)] = np.frombuffer(row, "<f4", n, 4 * n)
    return out


def fit_sample(sample: DataFrame, s: Settings) -> Model | None:
    """The model of a sample (family, lang, h, x); every machine is fitted in a task of its own, on
    at most ``sample_per_lang`` texts of each of its languages and, for families, ``pool`` more."""
    spark = sample.sparkSession
    langs = sample.select("family", "lang").distinct().toPandas()  # a row per language
    if langs.empty:
        return None
    own = {f: sorted(of) for f, of in langs.groupby("family")["lang"]}
    families = sorted(own)
    machine = "a string, b string, w binary, intercept double"

    def fit(name: tuple[str, str], rows: pd.DataFrame, positive: pd.Series) -> pd.DataFrame:
        rows = rows.assign(y=np.where(positive, 1.0, -1.0)).sort_values(["lang", "x"])  # one order in every run
        w, intercept = fit_svm(unpacked(rows["x"], s.buckets), rows["y"].to_numpy(), s.epochs, s.ridge)
        return pd.DataFrame({"a": [name[0]], "b": [name[1]], "w": [w.astype("<f8").tobytes()], "intercept": [intercept]})

    def weights(found: dict, keys: list) -> tuple[np.ndarray, np.ndarray]:
        fits = [found[k] for k in keys]
        return np.array([np.frombuffer(w, "<f8") for w, _ in fits]).reshape(len(fits), s.buckets), np.array([b for _, b in fits])

    def fitted(machines: DataFrame) -> dict:
        return {(r.a, r.b): (bytes(r.w), r.intercept) for r in machines.collect()}  # a row per machine

    # every two languages of a family, on the texts of the two alone
    pairs = [(lang, a, b) for of in own.values() for a, b in combinations(of, 2) for lang in (a, b)]
    between = {}
    if pairs:
        two = sample.select("lang", "x").join(spark.createDataFrame(pairs, "lang string, a string, b string"), "lang")
        between = fitted(two.groupBy("a", "b").applyInPandas(lambda key, rows: fit(key, rows, rows["lang"] == key[0]), machine))

    # every family, on its texts against those of the pool that are not its own
    apart = {(f, ""): (np.zeros(s.buckets).tobytes(), 0.0) for f in families}
    if len(families) > 1:
        pool = spark.sparkContext.broadcast(sample.orderBy("h", "lang").limit(s.pool).select("family", "lang", "x").toPandas())

        def one_family(key: tuple[str], rows: pd.DataFrame) -> pd.DataFrame:
            rest = pool.value[pool.value["family"] != key[0]]
            both = pd.concat([rows[["family", "lang", "x"]], rest])
            return fit((key[0], ""), both, both["family"] == key[0])

        apart = fitted(sample.groupBy("family").applyInPandas(one_family, machine))
    languages = {f: Pairs(of, *weights(between, list(combinations(of, 2)))) for f, of in own.items()}
    return Model(Machines(families, *weights(apart, [(f, "") for f in families])), languages, s.buckets)


def predict_language(docs: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: (doc_id, held_out, lang_pred, score).

    Learns from the texts with a lang whose id is not held out.  Null texts, texts without a
    letter, and all texts if nothing could be learnt are ``und`` with score 0.  A null doc_id is
    predicted, not learnt from, and not held out.  Repeated rows are each predicted and learnt
    from once.  Languages that get equally many votes are told apart by their margins, then by
    name.  Whole texts are read, however long; an empty table gives no rows; other columns are
    not read."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
    model = train(rows.where(F.col("doc_id").isNotNull() & ~held_out()), s)
    spread = docs.sparkSession.sparkContext.broadcast(model)  # languages x buckets numbers

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts = pdf["text"].tolist()
            langs, scores = spread.value.predict(texts) if spread.value else ([UNKNOWN] * len(texts), [0.0] * len(texts))
            yield pd.DataFrame({"doc_id": pdf["doc_id"], "held_out": pdf["held_out"], "lang_pred": langs, "score": scores})

    return rows.select("doc_id", held_out().alias("held_out"), "text").mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double")
