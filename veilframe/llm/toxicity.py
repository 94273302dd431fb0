"""Toxicity by a counterfactually regularised classifier.

A logistic model over the presence of words and of word beginnings. For every labelled sentence that
names a group, a twin is made in which each identity term is swapped for another one of its kind, and
the squared difference of the two scores is added to the loss: a group name by itself can then carry
little weight, so neutral mentions aren't punished, while insults still count.

Fit (bounded): the labelled rows with the smallest hashes, at most ``max_labelled`` of them, are the
sample. Executors count in how many toxic and clean sample texts each feature occurs, in partial sums
before the shuffle; the ``max_features`` features of the largest weight of evidence are the vocabulary. Each
sample text becomes the list of its vocabulary features, and the driver fits the weights by gradient
descent on those lists. Scoring is one narrow Arrow pass over whole texts, Arrow batch by Arrow batch (bounded by the session's
arrow.maxRecordsPerBatch and its byte limit), with the weights in the closure. ``max_features`` and ``min_texts`` bound the
vocabulary, which is a model's size and not a cut of data: what lies beyond has no weight; identity terms are always in it.

Labels, language, source and id are never inputs of a score. Defined results: null and empty texts get the
score of the bias; a null label is no label; with no labelled rows, or one class only, the weights
are zero, the bias is the smoothed share and ``drop_toxic`` drops nothing; repeated rows count each; a document labelled twice gives
two sample rows; empty tables give empty results; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .common import Cut, text_of

WORD = re.compile(r"\w+")
PREFIXES = (3, 4, 5, 6)
#: Identity terms by language and kind; a term is swapped for the next of its kind.
IDENTITY_TERMS = {
    "en": (
        ("women", "men", "girls", "boys"),
        ("woman", "man", "girl", "boy"),
        ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
        ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
        ("black", "white", "asian", "african", "european", "latino", "arab"),
        ("gay", "lesbian", "straight", "bisexual", "transgender", "queer"),
        ("american", "german", "french", "spanish", "mexican", "chinese", "indian", "turkish"),
        ("immigrants", "refugees", "natives", "foreigners"),
        ("disabled", "deaf", "blind", "elderly", "young", "old"),
    ),
    "de": (
        ("frauen", "männer", "mädchen", "jungen"),
        ("frau", "mann"),
        ("christen", "muslime", "juden", "hindus", "buddhisten", "atheisten"),
        ("christlich", "muslimisch", "jüdisch", "hinduistisch", "buddhistisch", "atheistisch"),
        ("schwarze", "weiße", "asiaten", "afrikaner", "europäer", "araber"),
        ("schwul", "lesbisch", "heterosexuell", "bisexuell", "queer"),
        ("amerikaner", "deutsche", "franzosen", "spanier", "mexikaner", "chinesen", "inder", "türken"),
        ("einwanderer", "flüchtlinge", "einheimische", "ausländer"),
        ("behinderte", "gehörlose", "blinde", "alte", "junge"),
    ),
    "fr": (
        ("femmes", "hommes", "filles", "garçons"),
        ("femme", "homme", "fille", "garçon"),
        ("chrétiens", "musulmans", "juifs", "hindous", "bouddhistes", "athées"),
        ("chrétien", "musulman", "juif", "hindou", "bouddhiste", "athée"),
        ("noirs", "blancs", "asiatiques", "africains", "européens", "arabes"),
        ("gays", "lesbiennes", "hétérosexuels", "bisexuels", "transgenres"),
        ("américains", "allemands", "français", "espagnols", "mexicains", "chinois", "indiens", "turcs"),
        ("immigrés", "réfugiés", "autochtones", "étrangers"),
        ("handicapés", "sourds", "aveugles", "vieux", "jeunes"),
    ),
    "es": (
        ("mujeres", "hombres", "niñas", "niños"),
        ("mujer", "hombre", "niña", "niño"),
        ("cristianos", "musulmanes", "judíos", "hindúes", "budistas", "ateos"),
        ("cristiano", "musulmán", "judío", "hindú", "budista", "ateo"),
        ("negros", "blancos", "asiáticos", "africanos", "europeos", "árabes"),
        ("gais", "lesbianas", "heterosexuales", "bisexuales", "transexuales"),
        ("americanos", "alemanes", "franceses", "españoles", "mexicanos", "chinos", "indios", "turcos"),
        ("inmigrantes", "refugiados", "nativos", "extranjeros"),
        ("discapacitados", "sordos", "ciegos", "viejos", "jóvenes"),
    ),
}
#: A word of two languages keeps the swap of the first.
SWAP = {term: kind[(i + 1) % len(kind)] for kinds in reversed(IDENTITY_TERMS.values()) for kind in kinds for i, term in enumerate(kind)}
#: More labelled rows than this aren't broadcast.
MAX_BROADCAST_LABELS = 100_000


def features(word: str) -> list[str]:
    return [f"={word}", *(word[:n] for n in PREFIXES if len(word) > n)]


def text_features(text: str) -> set[str]:
    out: set[str] = set()
    for w in set(WORD.findall(text.lower())):
        out.update(features(w))
    return out


def swapped(text: str) -> str | None:
    """The text with its identity terms swapped; None where it has none."""
    words = WORD.findall(text.lower())
    if SWAP.keys().isdisjoint(words):
        return None
    return " ".join(SWAP.get(w, w) for w in words)


def fit_weights(rows: list[np.ndarray], twins: list[np.ndarray | None], labels: np.ndarray, k: int, penalty: float, l2: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """rows[i]: features present; twins[i]: of the swapped text. Full-batch Adam on mean log loss +
    l2 * |w|^2 / 2 + penalty * mean squared score difference of the twins."""
    n = len(labels)
    share = (labels.sum() + 0.5) / (n + 2)
    w, b = np.zeros(k), float(np.log(share / (1 - share)))
    if n == 0 or labels.min() == labels.max():
        return w, b
    lens = np.fromiter(map(len, rows), np.int64, n)
    at, col = np.repeat(np.arange(n), lens), np.concatenate([*rows, np.zeros(0, np.int64)]).astype(np.int64)
    pairs = [(np.setdiff1d(r, t), np.setdiff1d(t, r)) for r, t in zip(rows, twins, strict=True) if t is not None]
    p_at = np.concatenate([np.full(len(a) + len(c), i) for i, (a, c) in enumerate(pairs)] or [np.zeros(0)]).astype(np.int64)
    p_col = np.concatenate([x for pair in pairs for x in pair] or [np.zeros(0)]).astype(np.int64)
    p_sign = np.concatenate([np.r_[np.ones(len(a)), -np.ones(len(c))] for a, c in pairs] or [np.zeros(0)])
    m, v, rate = np.zeros(k + 1), np.zeros(k + 1), 0.1
    for step in range(1, steps + 1):
        z = np.bincount(at, w[col], n) + b
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - labels) / n
        grad = np.bincount(col, g[at], k) + l2 * w
        if pairs:
            diff = np.bincount(p_at, p_sign * w[p_col], len(pairs))
            grad += np.bincount(p_col, p_sign * diff[p_at] * (2 * penalty / len(pairs)), k)
        full = np.r_[grad, g.sum()]
        m, v = 0.9 * m + 0.1 * full, 0.999 * v + 0.001 * full**2
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1], b - float(move[-1])
    return w, b


class Model:
    """Weights of features and the bias; from how many sample rows, and how many of them had a twin."""

    def __init__(self, weights: dict[str, float], bias: float, n_rows: int = 0, n_twins: int = 0):
        self.weights, self.bias, self.n_rows, self.n_twins = weights, bias, n_rows, n_twins

    def score_texts(self, texts: list[str], known: dict[str, tuple[str, ...]] | None = None) -> list[float]:
        """known: a cache from a word to its features that have weight."""
        weights, known = self.weights, {} if known is None else known
        if len(known) > 500_000:
            known.clear()
        out = []
        for text in texts:
            found: set[str] = set()
            for word in set(WORD.findall(text.lower())):
                have = known.get(word)
                if have is None:
                    have = tuple(f for f in features(word) if f in weights)
                    if len(word) < 64:
                        known[word] = have
                if have:
                    found.update(have)
            z = self.bias + sum(weights[f] for f in sorted(found))
            out.append(float(1 / (1 + np.exp(-min(30.0, max(-30.0, z))))))
        return out


def fit(labelled: DataFrame, penalty: float = 1.0, l2: float = 1e-4, max_labelled: int = 8000, max_features: int = 4096, min_texts: int = 3) -> Model:
    """labelled(text, toxic 0/1) -> Model."""
    rows = labelled.select(text_of().alias("text"), F.col("toxic").cast("int").alias("toxic")).filter(F.col("toxic").isNotNull())
    sample = rows.orderBy(F.xxhash64("text", "toxic"), "text").limit(max_labelled)
    # the sample is bounded; one table in the shared folder feeds both passes
    held = Cut(sample.repartition(12))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        toxic: Counter = Counter()
        clean: Counter = Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                (toxic if label else clean).update(text_features(text))
        names = list(toxic.keys() | clean.keys())
        for i in range(0, len(names), 10_000):
            part = names[i : i + 10_000]
            yield pa.RecordBatch.from_pydict({"feature": part, "t": [toxic[x] for x in part], "c": [clean[x] for x in part]})

    sums = held.df.groupBy("toxic").count().collect()
    n_toxic = sum(r["count"] for r in sums if r["toxic"])
    n_clean = sum(r["count"] for r in sums if not r["toxic"])
    evidence = F.log((F.col("t") + 0.5) * (n_clean + 1) / ((F.col("c") + 0.5) * (n_toxic + 1))) / F.sqrt(1 / (F.col("t") + 0.5) + 1 / (F.col("c") + 0.5))
    counted = held.df.mapInArrow(count, "feature string, t bigint, c bigint").groupBy("feature").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    best = counted.filter(F.col("t") + F.col("c") >= min_texts).orderBy(F.abs(evidence).desc(), "feature").limit(max_features)
    vocabulary = {r["feature"]: i for i, r in enumerate(best.select("feature").collect())}
    # swapped terms have to be features, or the penalty can't see them
    for term in SWAP:
        vocabulary.setdefault(f"={term}", len(vocabulary))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = lambda text: sorted(vocabulary[f] for f in text_features(text) if f in vocabulary)
        for batch in batches:
            texts = batch.column(0).to_pylist()
            twins = [swapped(t) for t in texts]
            yield pa.RecordBatch.from_arrays(
                [pa.array([ids(t) for t in texts], pa.list_(pa.int32())), pa.array([None if t is None else ids(t) for t in twins], pa.list_(pa.int32())), batch.column(1)],
                names=["x", "twin", "toxic"],
            )

    found = held.df.mapInArrow(encode, "x array<int>, twin array<int>, toxic int").collect()
    found.sort(key=lambda r: (r["x"], r["toxic"]))  # the sums below don't depend on the order of tasks
    whole = lambda x: np.asarray(x, np.int64)
    w, b = fit_weights(
        [whole(r["x"]) for r in found], [None if r["twin"] is None else whole(r["twin"]) for r in found],
        np.array([1.0 if r["toxic"] else 0.0 for r in found]), len(vocabulary), penalty, l2,
    )
    held.drop()
    return Model({f: float(w[i]) for f, i in vocabulary.items()}, b, len(found), sum(r["twin"] is not None for r in found))


def score_of(text: Column, model: Model) -> Column:
    """The score as a column: only texts go through Arrow, once; all other columns stay in the JVM."""
    weights, bias = model.weights, model.bias

    def run(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own, known = Model(weights, bias), {}
        for part in parts:
            scores: list[float] = []
            for i in range(0, len(part), 500):
                scores += own.score_texts(part.iloc[i : i + 500].tolist(), known)
            yield pd.Series(scores, dtype="float64")

    run.__annotations__ = {"parts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(run, DoubleType())(text_of(text))


def score(docs: DataFrame, model: Model, keep: tuple[str, ...] = ("doc_id",), name: str = "score") -> DataFrame:
    """docs with text -> the columns ``keep`` and the score under ``name``, which none of them may have."""
    if name in keep:
        raise ValueError(f"{name} is a column already")
    return docs.select(*keep, score_of(F.col("text"), model).alias(name))


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0


def train(documents: DataFrame, labels: DataFrame, **options) -> Model:
    """Learns from the labelled documents that are not held out."""
    marks = labels.select(F.col("doc_id").alias("__id"), "toxic").filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull())
    limit = options.get("max_labelled", 8000)
    # the same bounded choice as in fit, made on ids before any text is joined
    marks = marks.orderBy(F.xxhash64("__id"), "__id", "toxic").limit(limit)
    marks = F.broadcast(marks) if limit <= MAX_BROADCAST_LABELS else marks
    joined = documents.select("doc_id", "text").join(marks, F.col("doc_id") == F.col("__id"))
    return fit(joined.select("text", "toxic"), **options)


def toxicity_scores(documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(documents.select("doc_id", "text"), train(documents, labels))
    return scored.select(
        "doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def drop_toxic(documents: DataFrame, labels: DataFrame, threshold: float = 0.5, **options) -> DataFrame:
    """The rows of documents scored below the threshold, with all their columns. A model that had nothing to learn from (no
    labels, or of one class only) drops nothing."""
    names, model = documents.columns, train(documents, labels, **options)
    if not any(model.weights.values()):
        return documents
    return documents.filter(score_of(F.col("text"), model) < threshold).select(*names)
