"""Toxicity by class-conditional Kneser-Ney models over the letters of words.

Toxic and ordinary texts each get a letter n-gram model.  Both discount their own counts
and back off to shared ones: Kneser-Ney continuation counts of the two classes' n-grams
pooled.  Where a class has seen a context rarely, ``prior`` more shared counts keep its
estimate near the shared one, so expressions that only the larger class had room to show
do not count against the smaller.

A text is scored by two length-normalised comparisons of its toxic and its ordinary
log-likelihood: over all letters, and over its words as far as their log-ratio exceeds
``threshold`` (the rest of a text's words say more about its language than about its tone).
A logistic function of them is fitted on texts scored by models that have not seen them.

Letters fold into 64 classes, so an n-gram is an integer below 64^n and every table is
bounded at any input size, while its counts grow with the corpus."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .util import batches_of, fresh, materialize, order_id, whole_text

WORD = re.compile(r"[^\W\d_]+")
BITS = 6
EDGE = 0  # class of the space around words; a-z are 1 to 26, all other letters share 27 to 63
CHARS_AT_ONCE = 500_000  # letters of the words that a task holds as Python strings at once
TEXTS_AT_ONCE = 500  # texts that a task gets, and holds, at once
COUNTS_AT_ONCE = 250_000  # n-gram counts that a task gathers before it hands them on
FEATURES = ["letters", "words", "root"]


@dataclass(frozen=True)
class Settings:
    order: int = 4
    discount: float = 0.75
    prior: float = 100.0
    threshold: float = 2.0
    smooth: float = 3.0  # words added to a text's length when normalising, and 8 letters for each
    calibration_rows: int = 20_000  # labelled rows that the logistic function is fitted on


def letter_classes(text: str) -> np.ndarray:
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")
    out = 27 + (code * np.uint32(2654435761) >> np.uint32(8)) % 37
    plain = (code >= 97) & (code <= 122)
    out[plain] = code[plain] - 96
    out[code == 32] = EDGE
    return out.astype(np.int64)


def grams(words: list[str], order: int) -> tuple[np.ndarray, np.ndarray]:
    """(n-gram id, index of its word) for every letter of the words and each word's end."""
    cls = letter_classes(" " * (order - 1) + (" " * (order - 1)).join(words) + " ")
    gram = np.zeros(len(cls) - order + 1, np.int64)
    for j in range(order):
        gram = gram << BITS | cls[j : j + len(gram)]
    # one window per letter and one for the first blank after a word
    last = cls[order - 1 :]
    before = cls[order - 2 : -1]
    real = (last != EDGE) | (before != EDGE)
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 1
    return gram[real], np.repeat(np.arange(len(words)), lengths)


def tokens(texts: Iterable[str]) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Blocks of texts as (distinct words, word index, text index); a long text is split into
    several blocks, all of them read."""
    words: list[str] = []
    owner: list[tuple[int, int]] = []
    size = 0

    def block():
        idx, distinct = pd.factorize(np.array(words, dtype=object))
        return list(distinct), idx, np.repeat([i for i, _ in owner], [n for _, n in owner])

    for i, text in enumerate(texts):
        found = WORD.findall(text.lower())
        for at in range(0, len(found), CHARS_AT_ONCE // 8):
            part = found[at : at + CHARS_AT_ONCE // 8]
            words += part
            owner.append((i, len(part)))
            size += sum(map(len, part))
            if size >= CHARS_AT_ONCE:
                yield block()
                words, owner, size = [], [], 0
    if words:
        yield block()


def count_grams(texts: list[str], group: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, gram, n) summed over the texts; group is a small integer per text."""
    found = []
    for distinct, idx, text in tokens(texts):
        gram, word = grams(distinct, order)
        for g in np.unique(group):
            n = np.bincount(idx[group[text] == g], minlength=len(distinct))[word]
            ids, inv = np.unique(gram[n > 0], return_inverse=True)
            found.append((np.full(len(ids), g), ids, np.bincount(inv, weights=n[n > 0]).astype(np.int64)))
    if not found:
        return tuple(np.empty(0, np.int64) for _ in range(3))
    return tuple(np.concatenate(x).astype(np.int64) for x in zip(*found))


def _sums(keys: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    ids, inv = np.unique(keys, return_inverse=True)
    return ids, np.bincount(inv, weights=weights, minlength=len(ids)).astype(np.float64)


def _look(ids: np.ndarray, values: np.ndarray, keys: np.ndarray) -> np.ndarray:
    if not len(ids):
        return np.zeros(len(keys))
    at = np.minimum(np.searchsorted(ids, keys), len(ids) - 1)
    return np.where(ids[at] == keys, values[at], 0.0)


class Model:
    """The two class-conditional models from n-gram counts (gram, ordinary n, toxic n)."""

    def __init__(self, gram: np.ndarray, ordinary: np.ndarray, toxic: np.ndarray, s: Settings):
        self.s = s
        seen = (ordinary + toxic) > 0
        gram, own = gram[seen], (ordinary[seen].astype(float), toxic[seen].astype(float))
        self.shared = []  # levels 1 .. order: (grams, n, contexts, total, types) of pooled counts
        level = np.unique(gram)
        n = _sums(gram, own[0] + own[1])[1]
        for m in range(s.order, 0, -1):
            ctx, total = _sums(level >> BITS, n)
            types = _sums(level >> BITS)[1]
            self.shared.insert(0, (level, n, ctx, total, types))
            level, n = _sums(level & ((1 << BITS * (m - 1)) - 1))  # how many letters it continues
        self.own = []
        for count in own:
            there = count > 0
            ids, n = _sums(gram[there], count[there])
            ctx, total = _sums(ids >> BITS, n)
            self.own.append((ids, n, ctx, total, _sums(ids >> BITS)[1]))

    def log_likelihoods(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Natural log of each letter's probability in the ordinary and in the toxic model."""
        d, p = self.s.discount, np.full(len(gram), 2.0**-BITS)
        for m, (ids, n, ctx, total, types) in enumerate(self.shared, 1):
            key = gram & ((1 << BITS * m) - 1)
            t, k = _look(ctx, total, key >> BITS), _look(ctx, types, key >> BITS)
            p = np.where(t > 0, (np.maximum(_look(ids, n, key) - d, 0) + d * k * p) / np.maximum(t, 1), p)
        out = []
        for ids, n, ctx, total, types in self.own:
            t, k = _look(ctx, total, gram >> BITS), _look(ctx, types, gram >> BITS)
            out.append(np.log((np.maximum(_look(ids, n, gram) - d, 0) + (d * k + self.s.prior) * p) / (t + self.s.prior)))
        return out[0], out[1]


def score_texts(texts: list[str], models: list[Model]) -> np.ndarray:
    """[model, feature, text]: both length-normalised comparisons, and the second's root."""
    s = models[0].s
    letters, words = np.full(len(texts), 8 * s.smooth), np.full(len(texts), s.smooth)
    found = np.zeros((len(models), 2, len(texts)))
    for distinct, idx, text in tokens(texts):
        gram, word = grams(distinct, s.order)
        length = np.bincount(word, minlength=len(distinct))
        letters += np.bincount(text, weights=length[idx], minlength=len(texts))
        words += np.bincount(text, minlength=len(texts))
        ids, inv = np.unique(gram, return_inverse=True)
        for m, model in enumerate(models):
            ordinary, toxic = model.log_likelihoods(ids)
            ratio = np.bincount(word, weights=(toxic - ordinary)[inv], minlength=len(distinct))
            found[m, 0] += np.bincount(text, weights=ratio[idx], minlength=len(texts))
            excess = np.maximum(ratio - s.threshold, 0)
            found[m, 1] += np.bincount(text, weights=excess[idx], minlength=len(texts))
    words_over = found[:, 1] / words
    return np.stack([found[:, 0] / letters, words_over, np.sqrt(words_over)], axis=1)


def fit_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Weights of the columns of x and, last, the intercept, by Newton's method with a small
    ridge; half a text of each class is added, so empty and one-sided inputs have a solution."""
    scale = np.maximum(x.std(axis=0), 1e-9) if len(x) else np.ones(x.shape[1])
    z = np.concatenate([x / scale, np.zeros((2, x.shape[1]))])
    z = np.concatenate([z, np.ones((len(z), 1))], axis=1)
    target, count = np.concatenate([y, [0, 1]]), np.concatenate([np.ones(len(y)), [0.5, 0.5]])
    ridge = np.diag([1e-5 * len(z) + 1e-3] * x.shape[1] + [0.0])

    def loss(w: np.ndarray) -> float:
        return float(count @ (np.logaddexp(0, z @ w) - target * (z @ w)) + w @ ridge @ w / 2)

    w = np.zeros(z.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -35, 35)))
        step = np.linalg.solve((z * (count * p * (1 - p))[:, None]).T @ z + ridge + np.eye(len(w)) * 1e-9, z.T @ (count * (p - target)) + ridge @ w)
        rate = 1.0
        while loss(w - rate * step) > loss(w) and rate > 1e-6:
            rate /= 2
        w = w - rate * step
        if np.abs(rate * step).max() < 1e-8:
            break
    return np.append(w[:-1] / scale, w[-1])


def held_out(id_col: str = "doc_id", folds: int = 5, fold: int = 0) -> Column:
    """Whether crc32 of the id as text leaves ``fold``; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % folds == fold, F.lit(False))


def _fold(text: pd.Series) -> np.ndarray:
    """Two folds by the text alone, so that copies share a fold."""
    return (pd.util.hash_array(text.to_numpy(dtype=object), categorize=False) & np.uint64(1)).astype(np.int64)


def train(labelled: DataFrame, s: Settings) -> list[Model]:
    """The models of all labelled texts, of fold 0 and of fold 1.  ``labelled``: (text, toxic).
    All labelled texts are counted; at most 64^order table rows come to the driver."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found = (np.empty(0, np.int64), np.empty(0, np.int64))  # group and n-gram as one key, n
        for pdf in batches:
            group = _fold(pdf["text"]) * 2 + pdf["toxic"].to_numpy(np.int64)
            g, gram, n = count_grams(pdf["text"].tolist(), group, s.order)
            keys, sums = _sums(np.append(found[0], g << BITS * s.order | gram), np.append(found[1], n))
            found = (keys, sums.astype(np.int64))
            if len(keys) >= COUNTS_AT_ONCE:
                yield counted(*found)
                found = (keys[:0], found[1][:0])
        yield counted(*found)

    def counted(keys: np.ndarray, n: np.ndarray) -> pd.DataFrame:
        return pd.DataFrame({"g": (keys >> BITS * s.order).astype(np.int32), "gram": keys & ((1 << BITS * s.order) - 1), "n": n})

    rows = labelled.mapInPandas(count, "g int, gram long, n long").groupBy("gram")
    with batches_of(labelled.sparkSession, TEXTS_AT_ONCE):
        table = rows.agg(*[F.sum(F.when(F.col("g") == g, F.col("n")).otherwise(0)).alias(f"n{g}") for g in range(4)]).toArrow()
    gram, n00, n01, n10, n11 = (table.column(c).to_numpy().astype(np.int64) for c in ("gram", "n0", "n1", "n2", "n3"))
    return [Model(gram, n00 + n10, n01 + n11, s), Model(gram, n00, n01, s), Model(gram, n10, n11, s)]


def compared(docs: DataFrame, models: list[Model], id_col: str, text_col: str) -> DataFrame:
    """(id, null_id, tag, FEATURES by the full models, FEATURES with suffix 2 by the models of the
    fold that the text is not in), for every whole text."""
    spread = docs.sparkSession.sparkContext.broadcast(models)  # a few tables of at most 64^order rows

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        full, *folds = spread.value
        for pdf in batches:
            found = score_texts(pdf["text"].tolist(), [full, *folds])
            other = np.where(_fold(pdf["text"]) == 0, found[2], found[1])
            yield pd.DataFrame(
                {"id": pdf["id"], "null_id": pdf["null_id"], "tag": pdf["tag"]}
                | dict(zip(FEATURES, found[0])) | {f"{f}2": x for f, x in zip(FEATURES, other)}
            )

    rows = docs.select(order_id(id_col).alias("id"), F.col(id_col).isNull().alias("null_id"), F.xxhash64(whole_text(text_col)).alias("tag"), whole_text(text_col).alias("text"))
    return rows.mapInPandas(run, "id long, null_id boolean, tag long, " + ", ".join(f"{f} double" for f in [*FEATURES, *(f"{f}2" for f in FEATURES)]))


def toxicity_scores(
    docs: DataFrame, labels: DataFrame, s: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """One row per row of ``docs``: (doc_id, held_out, score, predicted).

    Learns from every labelled row (``labels``: doc_id, toxic 0 or 1; other labels are left out)
    whose id is not held out.  Null and empty texts and texts without letters are scored by the
    intercept alone; a null doc_id is scored, never learnt from, and not held out.  Repeated
    rows are each scored; repeated label rows count once; other columns are not read."""
    return judged_rows(docs, labels, s, id_col, text_col, label_col).select("doc_id", "held_out", "score", "predicted")


def judged_rows(docs: DataFrame, labels: DataFrame, s: Settings, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``toxicity_scores`` with the hash of the whole text, tag."""
    known = labels.where(F.col(label_col).isin(0, 1)).where(~held_out(id_col)).select(
        F.col(id_col).cast("long").alias("label_id"), F.col(label_col).cast("long").alias("toxic")
    ).distinct()
    own = docs.where(F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).cast("long").alias("label_id"), whole_text(text_col).alias("text"))
    # labels grow with the corpus, so they are never broadcast to the texts
    models = train(own.join(known.hint("merge"), "label_id").select("text", "toxic"), s)
    with batches_of(docs.sparkSession, TEXTS_AT_ONCE):
        rows = materialize(compared(docs, models, id_col, text_col), "toxicity")
    judged = rows.where("not null_id").join(known, F.col("id") == F.col("label_id"))
    sample = judged.orderBy(F.xxhash64("id"), "toxic").limit(s.calibration_rows).select("toxic", *[f"{f}2" for f in FEATURES]).toPandas()
    *weights, intercept = fit_logistic(sample[[f"{f}2" for f in FEATURES]].to_numpy(float), sample["toxic"].to_numpy(float)).tolist()
    z = F.lit(intercept)
    for f, w in zip(FEATURES, weights):
        z = z + F.col(f) * w
    return rows.select(F.when(~F.col("null_id"), F.col("id")).alias("doc_id"), "tag", (1 / (1 + F.exp(-z))).alias("score")).select(
        "doc_id", "tag", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, s: Settings = Settings()) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns.  Rows are told
    apart by id (null is one, too) and text, so of several texts with one id only the toxic go."""
    bad_id, bad_tag = fresh(docs.columns, "bad_id", "bad_tag")
    gone = judged_rows(docs, labels, s).where("predicted = 1").select(F.col("doc_id").alias(bad_id), F.col("tag").alias(bad_tag)).distinct()
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(bad_id)) & (F.xxhash64(whole_text("text")) == F.col(bad_tag))
    return docs.join(gone, same, "left_anti")
