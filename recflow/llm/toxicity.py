"""Toxicity: a linear-chain conditional random field over words.

Labels are of documents, so tokens get theirs from the labelled sample: a word (or prefix of
one) that occurs in toxic documents far more often than chance allows marks its tokens in
toxic documents; all other tokens are clean.  The chain (two states, weights of the word,
its prefixes and suffix, transitions) is fitted to these by its likelihood gradient.
Scoring runs forward-backward over every whole document; the marginals add up to an
expected number of toxic words, which a logistic curve turns into the score, and words with
a marginal of one half or more are the offending spans.

Defined results: null and empty texts have no words and the score of no toxic word; ids
whose labels differ count as toxic if any label is 1; null labels are no examples; without
examples of both classes every score is the share of toxic examples (0 without any); a
null id is not held out; rows that repeat are scored each by itself; extra columns stay.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import asdict, dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import ship, text_of

ship(__name__)

#: Labelled rows that fit the model at most, picked by a hash of the id.
MAX_TOXIC, MAX_CLEAN = 1_500, 4_500
#: Words in a training segment, and segments with a toxic word at most.
SEGMENT, MAX_SEGMENTS = 64, 2_000
PREFIXES = (3, 4, 5, 6)
#: Share of toxic documents among those with a feature that marks toxic words.
PRECISION = 0.97
FOLDS = 5

_WORD = re.compile(r"\w+")


def held_out(id_col: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def features(word: str) -> list[str]:
    word = word.lower()
    return [word, *(f"{word[:n]}*" for n in PREFIXES if len(word) > n), f"*{word[-3:]}"]


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    bias: float = 0.0
    step: list[list[float]] = field(default_factory=lambda: [[1.0, 1.0], [1.0, 1.0]])
    start: float = 0.0
    slope: float = 0.0
    offset: float = 0.0
    fixed: float | None = None  # the score where nothing could be learned


class _Emissions(dict):
    def __init__(self, model: Model):
        super().__init__()
        self.model = model

    def __missing__(self, word):
        if len(self) > 300_000:
            self.clear()
        w = self.model.weights
        value = self[word] = self.model.bias + sum([w.get(f, 0.0) for f in features(word)])
        return value


def forward_backward(e: np.ndarray, mask: np.ndarray, step: np.ndarray, start: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Marginals of state 1, forward probabilities and backward ratios; all (time, row).
    ``e``: log-odds of state 1 from the words; ``step``: exponentials of the transitions."""
    x = np.exp(np.clip(e, -30, 30))
    n = len(e)
    f, r = np.empty_like(x), np.ones_like(x)
    odds = np.exp(start) * x[0]
    f[0] = odds / (1 + odds)
    for t in range(1, n):
        p = f[t - 1]
        odds = ((1 - p) * step[0, 1] + p * step[1, 1]) / ((1 - p) * step[0, 0] + p * step[1, 0]) * x[t]
        f[t] = odds / (1 + odds)
    for t in range(n - 2, -1, -1):
        ahead = x[t + 1] * r[t + 1]
        r[t] = np.where(mask[t + 1], (step[1, 0] + step[1, 1] * ahead) / (step[0, 0] + step[0, 1] * ahead), 1.0)
    top = f * r
    return np.where(mask, top / (top + 1 - f), 0.0), f, r


def _seeds(toxic_docs: np.ndarray, clean_docs: np.ndarray, rate: float) -> np.ndarray:
    """Which features occur in toxic documents beyond chance, over all features tried."""
    n = toxic_docs + clean_docs
    with np.errstate(divide="ignore", invalid="ignore"):
        share = toxic_docs / n
        rest = np.where(share < 1, (1 - share) * np.log((1 - share) / (1 - rate)), 0.0)
        evidence = n * (share * np.log(share / rate) + rest)
    return (share >= PRECISION) & (evidence > math.log(len(n) + 1) + 3)


class _Index:
    """Words and features of the sample as numbers; a row of feature numbers for each word
    (0: none), so that the sample's texts are kept as arrays of word numbers."""

    def __init__(self):
        self.word: dict[str, int] = {}
        self.feature: dict[str, int] = {"": 0}
        self.rows: list[list[int]] = []

    def of(self, text: str) -> np.ndarray:
        out = np.empty(0, np.int32) if not text else np.fromiter(map(self._number, _WORD.findall(text)), np.int32)
        return out

    def _number(self, word: str) -> int:
        n = self.word.get(word)
        if n is None:
            n = self.word[word] = len(self.rows)
            row = [self.feature.setdefault(f, len(self.feature)) for f in features(word)]
            self.rows.append(row + [0] * (len(PREFIXES) + 2 - len(row)))
        return n


def fit_texts(texts: list[str], toxic: np.ndarray, rounds: int = 60, rate: float = 0.2, decay: float = 1e-3, seed: int = 11) -> Model:
    """Fits the chain and the curve to labelled texts."""
    toxic = np.asarray(toxic, bool)
    if not toxic.any() or toxic.all():
        return Model(fixed=float(toxic.mean()) if len(toxic) else 0.0)
    of_text: dict[str, bool] = {}
    for text, y in zip(texts, toxic, strict=True):  # copies of a text are one example
        of_text[text] = of_text.get(text, False) or bool(y)
    toxic = np.array(list(of_text.values()))
    if toxic.all() or not toxic.any():
        return Model(fixed=float(toxic.mean()))
    index = _Index()
    words = [index.of(t) for t in of_text]
    table = np.array(index.rows, np.int32).reshape(len(index.rows), len(PREFIXES) + 2)
    spread = np.zeros((2, len(index.feature)))
    for ws, y in zip(words, toxic, strict=True):
        spread[int(y), np.unique(table[np.unique(ws)])] += 1
    spread[:, 0] = 0
    marked = _seeds(spread[1], spread[0], toxic.mean())[table].any(axis=1)
    rng = np.random.default_rng(seed)
    segments: list[tuple[np.ndarray, bool]] = []
    clean: list[tuple[np.ndarray, bool]] = []
    for ws, y in zip(words, toxic, strict=True):
        for k in range(0, len(ws), SEGMENT):
            part = ws[k:k + SEGMENT]
            if y and marked[part].any():
                segments.append((part, True))
            elif not y:
                clean.append((part, False))
    if not segments:
        return Model(fixed=float(toxic.mean()))
    segments = [segments[i] for i in rng.permutation(len(segments))[:MAX_SEGMENTS]]
    segments += [clean[i] for i in rng.permutation(len(clean))[:2 * len(segments)]]
    kept = spread.sum(axis=0) >= 3
    ids = np.where(kept, np.cumsum(kept), 0)  # 0: no feature
    size = int(kept.sum()) + 1
    n, width = len(segments), len(PREFIXES) + 2
    grid = np.zeros((SEGMENT, n, width), np.int32)
    mask, gold = np.zeros((SEGMENT, n), bool), np.zeros((SEGMENT, n))
    for j, (part, y) in enumerate(segments):
        grid[:len(part), j] = ids[table[part]]
        mask[:len(part), j] = True
        gold[:len(part), j] = marked[part] if y else 0
    theta = np.zeros(size + 5)  # feature weights, then bias, start, transitions 00 01 10 (11 is 0)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    pair_gold = np.array([((gold[:-1] == a) & (gold[1:] == b) & mask[1:]).sum() for a in (0, 1) for b in (0, 1)], float)
    for it in range(1, rounds + 1):
        e = theta[:size][grid].sum(axis=2) + theta[size]
        step = np.exp(np.append(theta[size + 2:size + 5], 0.0)).reshape(2, 2)
        p, f, r = forward_backward(e, mask, step, theta[size + 1])
        x = np.exp(np.clip(e[1:], -30, 30)) * r[1:]
        q = np.stack([(1 - f[:-1]) * step[0, 0], (1 - f[:-1]) * step[0, 1] * x, f[:-1] * step[1, 0], f[:-1] * step[1, 1] * x])
        pairs = (q / q.sum(axis=0) * mask[1:]).sum(axis=(1, 2))
        miss = np.where(mask, gold - p, 0.0)
        g = np.zeros_like(theta)
        g[:size] = np.bincount(grid.ravel(), np.repeat(miss.ravel(), width), minlength=size)
        g[size], g[size + 1] = miss.sum(), miss[0].sum()
        g[size + 2:size + 5] = (pair_gold - pairs)[:3]
        g = g / n - decay * theta
        g[0] = 0
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        theta += rate * (m / (1 - 0.9 ** it)) / (np.sqrt(v / (1 - 0.999 ** it)) + 1e-8)
    model = Model(weights={f: float(theta[ids[k]]) for f, k in index.feature.items() if ids[k] and abs(theta[ids[k]]) > 1e-4},
                  bias=float(theta[size]), start=float(theta[size + 1]),
                  step=np.exp(np.append(theta[size + 2:size + 5], 0.0)).reshape(2, 2).tolist())
    emissions = theta[:size][ids[table]].sum(axis=1) + model.bias
    model.slope, model.offset = _curve(np.array([_measure(p) for p in marginals(model, words, emissions)]), toxic)
    return model


def _measure(p: np.ndarray) -> float:
    """Log of the expected number of toxic words, each weighted by its own marginal, so that
    the small marginals of a long clean text don't add up to a toxic word."""
    return math.log(float(p @ p) + 0.01)


def _curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Logistic curve by Newton steps, with a small penalty."""
    a = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        h = (a * (p * (1 - p))[:, None]).T @ a + 0.1 * np.eye(2)
        w = w + np.linalg.solve(h, a.T @ (y - p) - 0.1 * w)
    return float(w[0]), float(w[1])


def marginals(model: Model, docs: list, emissions) -> list[np.ndarray]:
    """Marginals of each document's words; documents of like length go together.
    ``emissions``: the log-odds by word, for documents as lists of words, or by number."""
    step, out = np.array(model.step), [np.zeros(0)] * len(docs)
    order = sorted((i for i in range(len(docs)) if len(docs[i])), key=lambda i: len(docs[i]))
    at = 0
    while at < len(order):
        n = min(512, max(1, 1_000_000 // len(docs[order[min(at + 511, len(order) - 1)]])))
        part = order[at:at + n]
        at += n
        longest = len(docs[part[-1]])
        e, mask = np.zeros((longest, len(part))), np.zeros((longest, len(part)), bool)
        for j, i in enumerate(part):
            k = len(docs[i])
            e[:k, j] = emissions[docs[i]] if isinstance(emissions, np.ndarray) else np.fromiter(
                map(emissions.__getitem__, docs[i]), float, k)
            mask[:k, j] = True
        p, _, _ = forward_backward(e, mask, step, model.start)
        for j, i in enumerate(part):
            out[i] = p[:len(docs[i]), j]
    return out


def score_texts(model: Model, texts: list[str], emissions: _Emissions | None = None) -> list[tuple[float, list[tuple[int, int]]]]:
    """(score, offending spans in code points) of each text."""
    if model.fixed is not None:
        return [(model.fixed, []) for _ in texts]
    out = []
    emissions = _Emissions(model) if emissions is None else emissions
    for text, p in zip(texts, marginals(model, [_WORD.findall(t) for t in texts], emissions), strict=True):
        z = model.slope * _measure(p) + model.offset
        spans: list[tuple[int, int]] = []
        if len(p) and p.max() >= 0.5:
            bad = p >= 0.5
            for k, m in enumerate(_WORD.finditer(text)):
                if bad[k]:
                    if spans and k and bad[k - 1]:
                        spans[-1] = (spans[-1][0], m.end())
                    else:
                        spans.append((m.start(), m.end()))
        out.append((1 / (1 + math.exp(-max(-30.0, min(30.0, z)))), spans))
    return out


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        max_toxic: int = MAX_TOXIC, max_clean: int = MAX_CLEAN) -> Model:
    """The model of a bounded sample of labelled rows outside the held-out fold."""
    marks = (labels.where(~held_out(id_col)).select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).dropna()
             .groupBy("_id").agg(F.max("_y").alias("_y")))
    picked = None
    for y, most in ((1, max_toxic), (0, max_clean)):
        part = marks.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(most)
        picked = part if picked is None else picked.unionByName(part)
    # at most max_toxic + max_clean ids are broadcast, and as many texts fit the model on the driver
    rows = (docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text")).join(F.broadcast(picked), "_id")
            .select("_id", "_text", "_y").toPandas().sort_values(["_id", "_text"]))
    return fit_texts(rows["_text"].tolist(), rows["_y"].to_numpy() == 1)


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with the struct ``_toxic``: score and spans (start:end, comma-joined)."""
    shared = docs.sparkSession.sparkContext.broadcast(asdict(model))  # plain values, bounded by the sample

    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = _Emissions(Model(**shared.value))
        for texts in batches:
            found = []
            for k in range(0, len(texts), 2000):
                found += score_texts(known.model, texts.iloc[k:k + 2000].tolist(), known)
            yield pd.DataFrame([(s, ",".join(f"{a}:{b}" for a, b in spans)) for s, spans in found], columns=["score", "spans"])

    return docs.withColumn("_toxic", F.pandas_udf(run, "score double, spans string")(text_of(text_col)))
