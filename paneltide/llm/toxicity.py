"""Counterfactual-regularised toxicity classifier (operator 8).

A logistic model over the words of a text and their stems (prefixes of 4 to 8 letters). Every labelled text
gets counterfactual twins: its own identity terms are swapped for others of their list, and into a text
without any one is mentioned and then swapped (which ones is dealt in turn, alike for both labels). The twins
are learnt under the text's label, and the squared change of the score's logit between the twins, and
between a text and its twin with a mention, is penalised, so a neutral mention of a group moves the score
little.

Fitted on a bounded sample of labelled rows: about ``per_class`` rows of each label in the order of their
hash, and of these as many as ``max_total`` characters a label hold, whatever their lengths (the first
always counts; both are parameters). Every text is scored whole.

Defined results: a null or empty text gets the score of a text without any feature; very long texts are
scored whole; repeated rows are each scored (a sampled id counts once, with its least text); repeated labels of a row count
as toxic if one is; without labels of both kinds the score is nearly 0 (the logistic of -40); an empty table gives an empty result; a column
of the output's name is replaced, any other stays.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from .common import crc_mod, cut, pieces, take_turn, unused

#: Identity terms that are swapped within a list.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "gays", "lesbians", "transgender", "straight"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"),
    ("black", "white", "asian", "latino", "african", "european", "arab", "indian"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("femmes", "hommes", "musulmans", "juifs", "chrétiens", "noirs", "blancs", "arabes"),
    ("frauen", "männer", "muslime", "juden", "christen", "ausländer", "schwarze", "weiße"),
    ("mujeres", "hombres", "musulmanes", "judíos", "cristianos", "negros", "blancos", "árabes"),
)
_WORD = re.compile(r"[^\W\d_]+")
_TWINS = {w: (group, i) for group in IDENTITY_TERMS for i, w in enumerate(group)}


def word_features(word: str) -> list[str]:
    return [word, *(word[:k] + "*" for k in (4, 5, 6, 7, 8) if len(word) > k)]


def features(text: str | None) -> set[str]:
    return {f for w in set(_WORD.findall((text or "").lower())) for f in word_features(w)}


def swapped(words: list[str], by: int) -> list[str]:
    """Words with each identity term replaced by the one ``by`` places on in its list."""
    return [_TWINS[w][0][(_TWINS[w][1] + by) % len(_TWINS[w][0])] if w in _TWINS else w for w in words]


def mention(turn: int) -> tuple[str, str]:
    """The identity term that the twin of a text without any mentions, and the one that it is swapped for."""
    group = IDENTITY_TERMS[turn % len(IDENTITY_TERMS)]
    term = group[turn // len(IDENTITY_TERMS) % len(group)]
    return term, swapped([term], 1 + turn % 3)[0]


class Model:
    def __init__(self, names: list[str], weights: np.ndarray, bias: float):
        self.weights, self.bias = {n: float(w) for n, w in zip(names, weights, strict=True) if w}, float(bias)
        self.index = {n: i for i, n in enumerate(self.weights)}
        self.values = np.array([*self.weights.values(), 0.0])
        self.cache: dict[str, tuple] = {}

    def __getstate__(self):
        return self.__dict__ | {"cache": {}}

    def score(self, text: str | None) -> float:
        found: set[int] = set()
        cache = self.cache
        for w in set(_WORD.findall((text or "").lower())):
            own = cache.get(w)
            if own is None:
                if len(cache) > 200_000:
                    cache.clear()
                own = cache[w] = tuple(self.index[f] for f in word_features(w) if f in self.index)
            if own:
                found.update(own)
        z = self.bias + sum(float(self.values[i]) for i in sorted(found))
        return float(1 / (1 + np.exp(-np.clip(z, -40, 40))))


def fit(texts: list[str], labels: list[int], n_features: int = 2048, least_z: float = 2.5, penalty: float = 5.0, l2: float = 1e-3, steps: int = 400) -> Model:
    """Weights by Adam on logistic loss of texts and twins + ``l2`` + ``penalty`` times the mean squared logit change between twins."""
    y = np.array(labels, np.float32)
    pos, neg = int(y.sum()), int(len(y) - y.sum())
    if not pos or not neg:
        return Model([], np.zeros(0), -40.0)
    seen: dict[str, int] = {}  # feature -> number; texts are held as arrays of numbers
    by_word: dict[str, list[int]] = {}

    def numbered(words: Iterable[str]) -> np.ndarray:
        own: set[int] = set()
        for w in set(words):
            if w not in by_word:
                by_word[w] = [seen.setdefault(f, len(seen)) for f in word_features(w)]
            own.update(by_word[w])
        return np.fromiter(sorted(own), np.int32, len(own))

    # texts first, so that what only twins hold doesn't count as evidence of a label; turns run through each label
    turn, turns, rows, named = {0: 0, 1: 0}, [], [], []
    for i, (text, label) in enumerate(zip(texts, labels, strict=True)):
        words = set(_WORD.findall(text.lower()))
        rows.append(numbered(words))
        if not words.isdisjoint(_TWINS):
            named.append(i)
        turns.append(turn[label])
        turn[label] += 1
    n_own = len(seen)
    count = [np.bincount(np.concatenate([r for r, own in zip(rows, labels, strict=True) if own == label]), minlength=n_own) for label in (1, 0)]
    # smoothed log odds of a feature between the classes; kept where it stands ``least_z`` standard errors from 0
    a, b = count[0] + 0.5, count[1] + 0.5
    odds = np.log(a / (pos + 1 - a)) - np.log(b / (neg + 1 - b))
    z = np.where(a + b >= 4, np.abs(odds) / np.sqrt(1 / a + 1 / b + 1 / (pos + 1 - a) + 1 / (neg + 1 - b)), 0)
    others = {i: numbered(swapped(_WORD.findall(texts[i].lower()), 1 + turns[i] % 3)) for i in named}
    mentioned = {w: numbered([w]) for w in _TWINS}
    all_names = np.array([*seen], dtype=object)
    chosen = [i for i in np.argsort(-z, kind="stable")[: 4 * n_features].tolist() if z[i] >= least_z]
    chosen = sorted(chosen, key=lambda i: (-z[i], all_names[i]))[:n_features]
    # features of identity terms are always in the model: those that are evidence as they are, the others at unit scale
    mentions = sorted({seen[f] for w in _TWINS for f in word_features(w) if f in seen} - set(chosen))
    names = [all_names[i] for i in chosen + mentions]
    scale = np.concatenate([odds[chosen], np.ones(len(mentions))]).astype(np.float32)
    place = np.full(len(seen), -1, np.int32)
    place[chosen + mentions] = np.arange(len(names))

    def placed(own: np.ndarray) -> np.ndarray:
        own = place[own]
        return np.sort(own[own >= 0])

    x = np.zeros((len(rows), len(names)), np.float32)
    # changes touch few columns, so twins are kept as (pair, column, value) against their texts, then against each other
    of: list[int] = []
    against_text, against_twin = [], []  # (columns gone, columns come)
    for i, own in enumerate(rows):
        mine = placed(own)
        x[i, mine] = scale[mine]  # evidence as the unit: rare features start small
        if i in others:
            new = placed(others[i])
            of.append(i)
            against_text.append((np.setdiff1d(mine, new, True), np.setdiff1d(new, mine, True)))
        else:
            first, second = (np.setdiff1d(placed(mentioned[w]), mine, True) for w in mention(turns[i]))
            of += [i, i]
            against_text += [(first[:0], first), (first[:0], second)]
            against_twin.append((np.setdiff1d(first, second, True), np.setdiff1d(second, first, True)))
    del rows, others
    pair, column, value = [], [], []
    for k, (gone, come) in enumerate(against_text + against_twin):
        pair.append(np.full(len(gone) + len(come), k))
        column.append(np.concatenate([gone, come]))
        value.append(np.concatenate([-scale[gone], scale[come]]))
    pair, column, value = (np.concatenate(c) for c in (pair, column, value))
    of, n_pairs, n_twins = np.array(of), len(against_text) + len(against_twin), len(of)
    weight = np.where(y == 1, 0.25 / pos, 0.25 / neg)
    each = np.bincount(of, minlength=len(y))
    twin_weight = weight[of] / each[of]  # a text and all its twins weigh the same
    w, b = np.zeros(len(names), np.float32), np.float32(0)
    m, v = np.zeros(len(names) + 1), np.zeros(len(names) + 1)
    miss = lambda z, y: 1 / (1 + np.exp(-np.clip(z, -40, 40))) - y
    for step in range(1, steps + 1):
        logit = x @ w + b
        moved = np.bincount(pair, value * w[column], n_pairs)
        err = miss(logit, y) * weight
        twin_err = miss(logit[of] + moved[:n_twins], y[of]) * twin_weight
        pull = moved * (2 * penalty / n_pairs)
        pull[:n_twins] += twin_err
        g = x.T @ (err + np.bincount(of, twin_err, len(y))).astype(np.float32) + l2 * w + np.bincount(column, value * pull[pair], len(names))
        g = np.append(g, err.sum() + twin_err.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        d = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, b = (w - d[:-1]).astype(np.float32), np.float32(b - d[-1])
    return Model(names, w * scale, b)


def train(docs: DataFrame, labels: DataFrame, per_class: int = 2500, max_total: int = 20_000_000, exclude: str = "false", penalty: float = 5.0) -> Model:
    """Fit on a bounded sample: of each label about the ``per_class`` ids of least hash, up to ``max_total`` characters."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~F.expr(exclude)).groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
    sizes = known.groupBy("toxic").count().collect()
    if not sizes:
        return fit([], [])
    least = F.lit(0)
    for r in sizes:  # the share of each label's hash range that holds about per_class rows
        least = F.when(F.col("toxic") == r["toxic"], F.lit(int(min(1.0, per_class / r["count"]) * (1 << 30)))).otherwise(least)
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30))
    chosen = {r["doc_id"]: (int(r["toxic"]), r["h"]) for r in known.where(place < least).select("doc_id", "toxic", place.alias("h")).collect()}
    if not chosen:
        return fit([], [])
    texts = cut(docs.where(F.col("doc_id").isin(list(chosen)) & F.col("text").isNotNull()).groupBy("doc_id").agg(F.min("text").alias("text")))
    picked, total = [], {0: 0, 1: 0}
    for r in sorted(texts.select("doc_id", F.length("text").alias("n")).collect(), key=lambda r: (chosen[r["doc_id"]][1], r["doc_id"])):
        label = chosen[r["doc_id"]][0]
        if not total[label] or total[label] + r["n"] <= max_total:
            picked.append(r["doc_id"])
            total[label] += r["n"]
    found = {r["doc_id"]: r["text"] for r in texts.where(F.col("doc_id").isin(picked)).collect()} if picked else {}
    return fit([found[i] for i in picked], [chosen[i][0] for i in picked], penalty=penalty)


def score(docs: DataFrame, model: Model, text_col: str = "text", out: str = "score") -> DataFrame:
    """``docs`` with the toxicity score of each whole text; a column of that name is replaced."""
    docs = docs.drop(out)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # n_features weights

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        take_turn("toxicity")
        for batch, texts in pieces(batches, text_col, 2_000_000):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([shared.value.score(t) for t in texts], pa.float64())], [*batch.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))


def score_held_out(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score, predicted; learnt from labels of rows that aren't held out."""
    held = f"{crc_mod('doc_id', 3)} = 1"
    scored = score(docs.select("doc_id", F.expr(held).alias("held_out"), "text"), train(docs, labels, exclude=held))
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_civil(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Rows of ``docs`` that score under ``threshold``; the columns stay as they are."""
    name = unused(docs, "toxicity")
    return score(docs, train(docs, labels), out=name).where(F.col(name) < threshold).drop(name)
