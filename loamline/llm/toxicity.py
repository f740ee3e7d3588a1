"""Toxicity by non-negative positive-unlabelled learning.

A linear model over the presence of words and word beginnings is trained with numpy from texts known to be toxic
(positive) and texts of unknown label. The risk of the negative class is estimated from the unlabelled texts less the
share of it that the class prior says are positive, held at zero from below (Kiryo et al., 2017): where the estimate is
negative, a step goes up it instead. The prior is the toxic share of the labelled rows, so labels have to be a random
draw: where toxic texts are labelled more often than others, too much is called toxic. The fit takes about
`positives` and `unlabelled` texts of up to `longest` characters, and about `characters` characters of either kind,
chosen by a hash of id and text, so that reruns agree; the class prior comes from all labelled rows.
Every document is scored over its whole text, where it lies, without a shuffle.

Defined cases: null or empty texts score as a text without known words; without positives every score is 0; repeated
rows score alike; null labels count as unlabelled; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loamline.llm.common import columns

WORD = re.compile(r"[^\W\d_]+")
#: Lengths of the word beginnings that are features beside the words.
STARTS = (4, 5, 6)


@dataclass(frozen=True)
class Settings:
    positives: int = 3_000
    unlabelled: int = 9_000
    longest: int = 200_000
    characters: int = 60_000_000
    features: int = 4_000
    least_texts: int = 5
    rounds: int = 400
    rate: float = 0.05
    decay: float = 1e-4
    threshold: float = 0.3
    seed: int = 11


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float
    trained: bool = True


def features(text: str | None) -> set[str]:
    words = set(WORD.findall((text or "").lower()))
    return words | {f"{w[:k]}~" for w in words for k in STARTS if len(w) > k}


def slopes(scores: np.ndarray, n: int, prior: float) -> np.ndarray:
    """The slope of the risk by each score; the first n texts are positive, the others unlabelled."""
    s = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
    m, loss = len(scores) - n, np.logaddexp(0, scores)
    if loss[n:].mean() - prior * loss[:n].mean() >= 0:
        return np.append(-prior * np.ones(n) / n, s[n:] / m)
    return np.append(prior * s[:n] / n, -s[n:] / m)  # the estimate of a risk is below zero: step back from what overfits


def fit(positive: list[str], unlabelled: list[str], prior: float, settings: Settings = Settings()) -> Model:
    """nnPU with the logistic loss by full-batch Adam steps; features are those most frequent among positives
    relative to the unlabelled texts (and some the other way)."""
    if not positive or not unlabelled or prior <= 0:
        return Model({}, 0.0, False)
    counts: list[Counter] = [Counter(), Counter()]
    for count, texts in zip(counts, (positive, unlabelled), strict=True):
        for t in texts:
            count.update(features(t))
    n, m = len(positive), len(unlabelled)

    def gain(x: str) -> float:
        p, u = (counts[0][x] + 0.5) / (n + 1), (counts[1][x] + 0.5) / (m + 1)
        return abs(p - u) / np.sqrt(u * (1 - u) / min(n, m) + 1e-12)

    known = sorted((x for x in counts[0].keys() | counts[1].keys() if counts[0][x] + counts[1][x] >= settings.least_texts), key=lambda x: (-gain(x), x))[: settings.features]
    place = {x: k for k, x in enumerate(known)}
    del counts
    each_text = [np.array(sorted(place[x] for x in features(t) if x in place), np.int32) for t in positive + unlabelled]
    rows_, cols_ = np.repeat(np.arange(n + m, dtype=np.int32), [len(x) for x in each_text]), np.concatenate(each_text)
    w, b = np.zeros(len(known)), float(np.log(prior / (1 - prior))) if prior < 1 else 0.0
    m1, m2 = np.zeros(len(known) + 1), np.zeros(len(known) + 1)
    for step in range(1, settings.rounds + 1):
        g = b + np.bincount(rows_, weights=w[cols_], minlength=n + m)
        each = slopes(g, n, prior)
        grad = np.append(np.bincount(cols_, weights=each[rows_], minlength=len(known)) + settings.decay * w, each.sum())
        m1, m2 = 0.9 * m1 + 0.1 * grad, 0.999 * m2 + 0.001 * grad**2
        move = settings.rate * (m1 / (1 - 0.9**step)) / (np.sqrt(m2 / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - float(move[-1])
    return Model({x: float(v) for x, v in zip(known, w, strict=True) if abs(v) > 1e-6}, b)


def train(docs: DataFrame, labels: DataFrame, usable: Column | None = None, settings: Settings = Settings()) -> Model:
    """Fits on docs' texts with labels' `toxic` by doc_id; `usable` (over doc_id) says which rows may be learned from."""
    usable = F.lit(True) if usable is None else usable
    known = columns(labels, "doc_id", "toxic").groupBy("doc_id").agg(F.max("toxic").alias("toxic")).filter("doc_id is not null")
    text = columns(docs, "doc_id", "text").filter(usable).filter(F.length("text").between(1, settings.longest))
    order = lambda *c: F.pmod(F.xxhash64(F.lit(settings.seed), *c), F.lit(1 << 30)) / float(1 << 30)
    share = known.filter(usable).agg(F.avg(F.when(F.col("toxic").isNotNull(), (F.col("toxic") == 1).cast("double"))).alias("p")).first().p
    toxic = known.filter("toxic = 1").orderBy(order("doc_id"), "doc_id").limit(settings.positives).select("doc_id")
    # the rest is unlabelled text, told toxic or not: the risk estimator takes it as a mixture by the prior
    chosen = []
    for part, most, key in ((text.join(F.broadcast(toxic), "doc_id", "left_semi"), settings.positives, "text"), (text, settings.unlabelled, "text")):
        size = part.agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars")).first()
        taken = min(1.0, 1.2 * most / max(size.n, 1), settings.characters / max(size.chars or 0, 1))
        chosen.append(sorted({r.text for r in part.filter(order(key, "doc_id") < taken).select("text").collect()}))
    return fit(chosen[0], chosen[1], float(share or 0.0), settings)


def score(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """docs with `score` (0 to 1) and `predicted` (1 if score >= threshold)."""
    told = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def scored(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = told.value
        weights, bias = model.weights, model.bias
        starts = {x[:-1] for x in weights if x[-1] == "~"}

        def one(text: str | None) -> float:
            if not model.trained:
                return 0.0
            words = set(WORD.findall((text or "").lower()))
            found = [weights[w] for w in words if w in weights]
            begun = {w[:k] for w in words for k in STARTS if len(w) > k and w[:k] in starts}
            found += [weights[f"{x}~"] for x in begun]
            return 1 / (1 + math.exp(-min(max(math.fsum(found) + bias, -500), 500)))

        for texts in parts:
            yield texts.map(one, na_action=None)

    value = scored(F.col("text"))
    return docs.drop("score", "predicted").withColumn("score", value).withColumn("predicted", (F.col("score") >= settings.threshold).cast("int"))


def clean(docs: DataFrame, model: Model, settings: Settings = Settings()) -> DataFrame:
    """The rows of docs that the model doesn't call toxic, with their own columns, whatever the names."""
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), docs["`text`"].alias("text"))
    return score(rows, model, settings).filter("predicted = 0").select("row.*")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))
