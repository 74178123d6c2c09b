"""Toxicity by weak supervision: many lexicon and pattern voters, a label model of them, and a linear classifier.

Fitting works on a bounded sample of documents outside the held-out fold, in one task; scoring works on all rows.
"""

from __future__ import annotations

import json
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import chunks, text_column
from .wordcache import TwoGenerations

#: Bounds of the sample that is fitted on: documents labelled toxic, documents labelled clean, and characters of their texts in all.
SAMPLE, SAMPLE_CHARS = (2000, 4000), 40_000_000
#: Voters, and features of the classifier, at most; Fitted.dropped tells how many candidates were left out.
VOTERS, FEATURES = 128, 600
#: A voter's word or stem stands in so many different contexts at least, in documents labelled toxic; copies of a text count once.
LEAST_CONTEXTS = 3
#: Its rate in documents labelled toxic is so many times that in clean ones.
LEAST_LIFT = 12.0
STEMS = (4, 5, 6, 7)
THRESHOLD = 0.3
_LETTERS = re.compile(r"[^\W\d_]+")


def features_of(word: str) -> list[str]:
    """A word in lower case and its stems: '=word' for the lexicon, 'stem*' for the patterns."""
    return [f"={word}", *[f"{word[:k]}*" for k in STEMS if len(word) > k]]


def with_repeats(features: Iterable[str]) -> set[str]:
    """Features of the different words of a text; a stem of two words or more is also the feature 'stem**'."""
    found: set[str] = set()
    for f in features:
        if f in found and f[-1] == "*":
            found.add(f + "*")
        found.add(f)
    return found


def held_out(doc_id) -> "F.Column":
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(4)) == 2


def sample_of(docs: DataFrame, labels: DataFrame, sizes: tuple[int, int] = SAMPLE) -> DataFrame:
    """A bounded sample (text, toxic) of labelled documents outside the held-out fold, chosen by hash of doc_id; one row of each doc_id, the least by hash of its text."""
    known = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    known = known.join(docs.where("doc_id is not null").select("doc_id").distinct(), "doc_id", "left_semi")
    pick = lambda kind, n: known.where(F.col("toxic") == kind).orderBy(F.xxhash64("doc_id", F.lit(9)), "doc_id").limit(n)
    chosen = pick(1, sizes[0]).unionAll(pick(0, sizes[1]))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(F.broadcast(chosen), "doc_id")
    return rows.groupBy("doc_id", "toxic").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("least")).select(F.col("least.text").alias("text"), "toxic")


def label_model(votes: np.ndarray, known: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of each document, accuracy of each voter, and weight of each voter after correlations.

    A generative model with a hidden class: a voter says toxic or abstains, and one more voter says clean where all
    abstain. Rates of votes given the class are estimated by expectation and maximisation; known (1, 0 or nan) anchors
    the class of labelled documents while rates are estimated, the posteriors returned are of the votes alone. Voters
    whose votes correlate within a class share their evidence: each counts by one over the sum of its correlations.
    """
    n, m = votes.shape
    x = np.hstack([votes, ~votes.any(axis=1, keepdims=True)]).astype(np.float64)
    p = np.where(votes.any(axis=1), 0.9, 0.02)
    anchored = ~np.isnan(known)
    weight = np.ones(m + 1)
    for step in range(rounds):
        p = np.where(anchored, 0.01 + 0.98 * np.nan_to_num(known), p)
        prior = np.clip(p.mean(), 1e-3, 1 - 1e-3)
        rate1 = (p @ x + 0.5) / (p.sum() + 1.0)
        rate0 = ((1 - p) @ x + 0.5) / ((1 - p).sum() + 1.0)
        if step % 10 == 0:
            centred = (x - rate1) * np.sqrt(p)[:, None]
            cov = centred.T @ centred
            sd = np.sqrt(np.maximum(np.diag(cov), 1e-9))
            weight = 1 / np.maximum(1.0, np.clip(cov / np.outer(sd, sd), 0, 1).sum(axis=1))
        odds = np.log(prior / (1 - prior)) + x @ (weight * np.log(rate1 / rate0))
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    accuracy = (rate1 * prior) / (rate1 * prior + rate0 * (1 - prior))
    return p, accuracy[:m], weight[:m]


def fit_linear(rows: list[np.ndarray], y: np.ndarray, m: int, l1: float = 2e-4, rounds: int = 300) -> tuple[np.ndarray, float]:
    """Weights and bias of a logistic regression on soft labels, with an L1 penalty, by accelerated proximal gradient."""
    x = np.zeros((len(rows), m + 1), np.float32)
    for i, r in enumerate(rows):
        x[i, r] = 1
    x[:, m] = 1
    balance = np.where(y > 0.5, 0.5 / max(y.mean(), 1e-3), 0.5 / max(1 - y.mean(), 1e-3))
    step = 4.0 / (np.mean(balance * (x * x).sum(axis=1)) + 1e-9)
    balance, y = balance.astype(np.float32), y.astype(np.float32)
    w = z = np.zeros(m + 1, np.float32)
    t = 1.0
    for _ in range(rounds):
        g = x.T @ (balance * (1 / (1 + np.exp(-np.clip(x @ z, -30, 30))) - y)) / len(y)
        new = (z - step * g).astype(np.float32)
        new[:m] = np.sign(new[:m]) * np.maximum(np.abs(new[:m]) - step * l1, 0)
        t, before = (1 + np.sqrt(1 + 4 * t * t)) / 2, t
        z, w = (new + (before - 1) / t * (new - w)).astype(np.float32), new
    return w[:m], float(w[m])


@dataclass
class Fitted:
    """Weights of features, the classifier's bias, the voters, documents and characters fitted on, and candidates left out by a bound."""

    weights: dict[str, float] = field(default_factory=dict)
    bias: float = -6.0
    voters: list[str] = field(default_factory=list)
    documents: int = 0
    chars: int = 0
    dropped: int = 0


class Sample:
    """Labelled documents as numbers of their words: those of toxic ones in order, of others each word once. Texts are not kept."""

    def __init__(self, most_chars: int = SAMPLE_CHARS):
        self.most_chars, self.chars, self.vocabulary, self.docs, self.toxic = most_chars, 0, {}, [], []

    def add(self, text: str, toxic: int | None) -> None:
        if self.chars >= self.most_chars:
            return
        self.chars += len(text)
        numbers = np.array([self.vocabulary.setdefault(w, len(self.vocabulary)) for w in _LETTERS.findall(text.lower())], np.int32)
        self.docs.append(numbers if toxic == 1 else np.unique(numbers))
        self.toxic.append(np.nan if toxic is None else float(toxic))


def fit(sample: Sample, most_voters: int = VOTERS, most_features: int = FEATURES) -> Fitted:
    """Mine voters, fit the label model and the classifier. Without voters, no feature has a weight and every score is near 0.

    Only features of words in documents labelled toxic are looked at.
    """
    docs, y, names = sample.docs, np.array(sample.toxic), list(sample.vocabulary)
    n1, n0 = int((y == 1).sum()), int((y == 0).sum())
    fitted = Fitted(documents=len(docs), chars=sample.chars)
    ids: dict[str, int] = {}
    for w in sorted({int(w) for d, v in zip(docs, y, strict=True) if v == 1 for w in np.unique(d)}):
        for f in features_of(names[w]):
            ids.setdefault(f, len(ids))
    if not ids or not n0:
        return fitted
    table = np.full((len(names), 1 + len(STEMS)), -1, np.int32)
    for w, name in enumerate(names):
        own = [ids.get(f, -1) for f in features_of(name)]
        table[w, : len(own)] = own
    m = len(ids)  # feature i of two words or more is feature m + i

    def present(doc: np.ndarray) -> np.ndarray:
        found, counts = np.unique(table[np.unique(doc)], return_counts=True)
        keep = found >= 0
        return np.concatenate([found[keep], found[keep & (counts > 1)] + m])

    seen1, seen0 = np.zeros(2 * m, np.int32), np.zeros(2 * m, np.int32)
    for d, v in zip(docs, y, strict=True):
        if v == 1:
            seen1[present(d)] += 1
        elif v == 0:
            seen0[present(d)] += 1
    lift = (seen1 + 0.5) / (n1 + 1) / ((seen0 + 0.5) / (n0 + 1))
    candidate = (seen1 >= LEAST_CONTEXTS) & (lift >= LEAST_LIFT)
    contexts: dict[int, set[int]] = defaultdict(set)
    for d, v in zip(docs, y, strict=True):
        if v == 1:
            around = np.concatenate([[-1], d, [-1]]).astype(np.int64)
            key = around[:-2] * (len(names) + 2) + around[2:]
            for column in range(table.shape[1]):
                f = table[d, column]
                for shift in (0, m):
                    hit = np.flatnonzero((f >= 0) & candidate[np.maximum(f, 0) + shift])
                    for i in hit.tolist():
                        contexts[int(f[i]) + shift].add(int(key[i]))
    name_of = list(ids)
    show = lambda i: name_of[i] if i < m else name_of[i - m] + "*"
    usable = [i for i, c in contexts.items() if len(c) >= LEAST_CONTEXTS and not (i >= m and name_of[i - m][-1] != "*")]
    usable.sort(key=lambda i: (-min(len(contexts[i]), int(seen1[i])) * np.log(lift[i]), show(i)))
    kept = np.array(usable[:most_features], np.int64)
    if not len(kept):
        return fitted
    place = np.full(2 * m, -1)
    place[kept] = np.arange(len(kept))
    rows = [(p := place[present(d)])[p >= 0] for d in docs]
    votes = np.zeros((len(docs), min(most_voters, len(kept))), bool)
    for i, r in enumerate(rows):
        votes[i, r[r < votes.shape[1]]] = True
    posterior, _, _ = label_model(votes, y)
    weights, fitted.bias = fit_linear(rows, posterior, len(kept))
    fitted.weights = {show(i): float(x) for i, x in zip(kept, weights, strict=True) if abs(x) > 1e-3}
    fitted.voters, fitted.dropped = [show(i) for i in kept[: votes.shape[1]]], len(usable) - len(kept)
    return fitted


def train(docs: DataFrame, labels: DataFrame, sizes: tuple[int, int] = SAMPLE, most_chars: int = SAMPLE_CHARS, most_voters: int = VOTERS, most_features: int = FEATURES) -> Fitted:
    """Fit on the sample in one task; the model, of most_features weights at most, comes back to the driver.

    The sample holds at most `sizes` toxic and clean documents, by hash of doc_id, and ends after the document in which
    its texts reach most_chars characters, in order of a hash of their texts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sample = Sample(most_chars)
        for batch in batches:
            for t, y in zip(batch.column(0), batch.column(1), strict=True):
                sample.add(t.as_py(), y.as_py())
        yield pa.RecordBatch.from_pydict({"model": [json.dumps(asdict(fit(sample, most_voters, most_features)))]})

    sample = sample_of(docs, labels, sizes).orderBy(F.xxhash64("text"))  # the order does not depend on how rows are dealt
    rows = sample.coalesce(1).mapInArrow(run, "model string").collect()
    return Fitted(**json.loads(rows[0]["model"])) if rows else Fitted()


def score_toxicity(docs: DataFrame, labels: DataFrame | None, carry: tuple[str, ...] = (), text: str = "text", threshold: float = THRESHOLD, fitted: Fitted | None = None) -> DataFrame:
    """One row for each row of docs (doc_id, text): doc_id, the carried columns, held_out, score, predicted.

    labels (doc_id, toxic) are read outside the held-out fold alone: crc32 of doc_id as text, mod 4, is not 2. Null
    toxic is no label; repeated labels count as toxic if one is. Null text is empty and scores by the bias; a null
    doc_id is outside the held-out fold and never fitted on. Without labels every score is near 0. Repeated rows are
    scored each; an empty table gives no rows; language, source and ids are not read by the score.
    With carried columns, `text` names the text among them. The model is fitted on a sample with the bounds SAMPLE and
    SAMPLE_CHARS, unless one is given that train() fitted with others.
    """
    fitted = fitted or train(docs.select("doc_id", F.col(text).alias("text")), labels)
    model, bias = fitted.weights, fitted.bias

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache, used = TwoGenerations(), {f.replace("**", "*") for f in model}

        def found(tokens: list[str]) -> list[tuple[str, ...]]:
            return [tuple((w, tuple(f for f in features_of(w) if f in used)) for w in _LETTERS.findall(t.lower()) if any(f in used for f in features_of(w))) for t in tokens]

        for batch in batches:
            odds = []
            for _, texts in chunks(text_column(batch, text)):
                split = [set(t.split()) for t in texts]
                every = set().union(*split)
                known = cache.hold(every, found)
                voting = {t for t in every if known[t]}
                for s in split:
                    words = {w: fs for t in s & voting for w, fs in known[t]}
                    odds.append(bias + sum(sorted(model.get(f, 0.0) for f in with_repeats(f for fs in words.values() for f in fs))))
            score = 1 / (1 + np.exp(-np.clip(np.array(odds, float), -30, 30)))
            kept = [i for i, name in enumerate(batch.schema.names) if name in names]
            yield pa.RecordBatch.from_arrays([*[batch.column(i) for i in kept], pa.array(score)], names=[*[batch.schema.names[i] for i in kept], "score"])

    names = ("doc_id", *carry, "held_out")
    inner = docs.select("doc_id", *carry, held_out(F.col("doc_id")).alias("held_out"), *([] if carry else [text]))
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in inner.schema.fields if f.name in names)
    return inner.mapInArrow(run, f"{kinds}, score double").withColumn("predicted", (F.col("score") >= threshold).cast("int"))
