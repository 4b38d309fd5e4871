"""Quality rules: a learned decision list over text statistics.

Sequential covering: a rule (a conjunction of thresholds) is grown on two thirds of the
labelled statistics by information gain, pruned on the last third, and kept if it is
precise there; the rows it covers are taken out and the next rule is grown.  The list is
emitted as one ordered ``CASE WHEN`` over the statistics, so scoring is a Spark expression.

Defined results: null or empty text has zero words and fails the base rule; a row whose
label is null is no example; several labels of one id count as the smallest; with no
examples of either class the list is empty and only the base rule decides; repeated rows
are judged each by itself; extra columns are left alone.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recflow.llm.common import packed, ship, text_of, unpacked

ship(__name__)

#: At most so many labelled rows fit the list; they are picked by a hash of the id.
MAX_LABELLED = 20_000

STATS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
         "n_lines", "n_upper", "n_digits", "n_stops", "n_distinct", "n_adjacent", "n_shouts")

#: Interpretable features: name -> (statistic, statistic it is divided by).
FEATURES = {
    "words": ("n_words", None),
    "chars_per_word": ("word_chars", "n_words"),
    "symbols_per_word": ("n_symbols", "n_words"),
    "dup_lines_per_line": ("n_dup_lines", "n_lines"),
    "repeat_per_word": ("n_repeat_words", "n_words"),
    "upper_per_char": ("n_upper", "word_chars"),
    "digits_per_char": ("n_digits", "word_chars"),
    "stops_per_word": ("n_stops", "n_words"),
    "distinct_per_word": ("n_distinct", "n_words"),
    "adjacent_per_word": ("n_adjacent", "n_words"),
    "shouts_per_word": ("n_shouts", "n_words"),
    "words_per_line": ("n_words", "n_lines"),
}

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
_UPPER = bytes(range(65, 91))
_DIGITS = b"0123456789"


def repeated_words(words: list) -> int:
    """Words that lie in a three-word window found at least twice in the list."""
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    seen = Counter(windows)
    covered = reach = 0
    for i, window in enumerate(windows):
        if seen[window] > 1:
            covered += i + 3 - max(reach, i)
            reach = i + 3
    return covered


def text_stats(text: str) -> tuple:
    """The values of STATS for one whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    count = lambda chars: len(raw) - len(raw.translate(None, chars))
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x.strip()]
    return (len(words), len(text) - count(_SPACE), count(_SYMBOLS), len(lines) - len(set(lines)),
            repeated_words(words), len(lines), count(_UPPER), count(_DIGITS), raw.count(b"."),
            len(set(words)), sum(a == b for a, b in zip(words, words[1:], strict=False)), raw.count(b"!"))


def _stats_batches(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for texts in batches:
        rows = np.array([text_stats(t.as_py()) for t in texts], np.int64).reshape(len(texts), len(STATS))
        yield pa.StructArray.from_arrays([pa.array(rows[:, k]) for k in range(len(STATS))], names=list(STATS))


def stats_column(text: Column) -> Column:
    """One struct of STATS for each text (Arrow batches; one text at a time in memory)."""
    udf = F.arrow_udf(_stats_batches, ", ".join(f"{s} long" for s in STATS))
    return udf(text)


def base_failed(stats: str = "_stats") -> Column:
    n, r = F.col(f"{stats}.n_words"), F.col(f"{stats}.n_repeat_words")
    return (n < 50) | (100 * r > 50 * n)


# ---------------------------------------------------------------- decision list


@dataclass(frozen=True)
class Condition:
    feature: str
    at_least: bool
    threshold: float

    def holds(self, x: dict[str, np.ndarray]) -> np.ndarray:
        return x[self.feature] >= self.threshold if self.at_least else x[self.feature] <= self.threshold

    def column(self, stats: str) -> Column:
        value = feature_column(self.feature, stats)
        return value >= self.threshold if self.at_least else value <= self.threshold

    def __str__(self) -> str:
        return f"{self.feature} {'>=' if self.at_least else '<='} {self.threshold:.6g}"


def feature_column(name: str, stats: str = "_stats") -> Column:
    top, below = FEATURES[name]
    value = F.col(f"{stats}.{top}").cast("double")
    return value if below is None else value / F.greatest(F.col(f"{stats}.{below}"), F.lit(1))


def feature_arrays(stats: pd.DataFrame) -> dict[str, np.ndarray]:
    return {k: (stats[a].to_numpy("float64") if b is None
                else stats[a].to_numpy("float64") / np.maximum(stats[b].to_numpy("float64"), 1))
            for k, (a, b) in FEATURES.items()}


def _grow(x: dict, bad: np.ndarray, most: int) -> list[Condition]:
    """Add the condition of the largest gain until no good row is covered."""
    rule: list[Condition] = []
    inside = np.ones(len(bad), bool)
    while len(rule) < most:
        p0, n0 = (inside & bad).sum(), (inside & ~bad).sum()
        if not p0 or not n0:
            break
        best, best_gain = None, 1e-9
        for name, values in x.items():
            cuts = np.unique(np.quantile(values[inside & bad], np.linspace(0, 1, 65)))
            order = np.argsort(values[inside], kind="stable")
            v, b = values[inside][order], bad[inside][order]
            pos = np.concatenate([[0], np.cumsum(b)])
            neg = np.concatenate([[0], np.cumsum(~b)])
            low, high = np.searchsorted(v, cuts, "left"), np.searchsorted(v, cuts, "right")
            for at_least, p, n in ((True, pos[-1] - pos[low], neg[-1] - neg[low]), (False, pos[high], neg[high])):
                with np.errstate(divide="ignore", invalid="ignore"):
                    gain = np.where(p > 0, p * (np.log2(p / (p + n)) - np.log2(p0 / (p0 + n0))), -1)
                k = int(np.argmax(gain))
                if gain[k] > best_gain:
                    best, best_gain = Condition(name, at_least, float(cuts[k])), gain[k]
        if best is None:
            break
        rule.append(best)
        inside &= best.holds(x)
    return rule


def _covered(rule: list[Condition], x: dict, n: int) -> np.ndarray:
    inside = np.ones(n, bool)
    for c in rule:
        inside &= c.holds(x)
    return inside


def _prune(rule: list[Condition], x: dict, bad: np.ndarray) -> list[Condition]:
    """The prefix of the rule that is worth most on the pruning rows."""
    def worth(r):
        inside = _covered(r, x, len(bad))
        p, n = (inside & bad).sum(), (inside & ~bad).sum()
        return ((p - n) / (p + n) if p + n else -1, p)
    return max((rule[:k] for k in range(1, len(rule) + 1)), key=lambda r: (*worth(r), -len(r)))


def learn(stats: pd.DataFrame, bad: np.ndarray, max_rules: int = 16, max_conditions: int = 4,
          min_precision: float = 0.95, min_covered: int = 3, seed: int = 17) -> list[list[Condition]]:
    """The ordered rules that reject; what none of them covers is kept."""
    rules: list[list[Condition]] = []
    rng = np.random.default_rng(seed)
    part = rng.permutation(len(bad)) % 3 == 0
    left = np.ones(len(bad), bool)
    x = feature_arrays(stats)
    while len(rules) < max_rules:
        grow, prune = left & ~part, left & part
        if not (grow & bad).any() or not (prune & bad).any():
            break
        rule = _grow({k: v[grow] for k, v in x.items()}, bad[grow], max_conditions)
        if not rule:
            break
        rule = _prune(rule, {k: v[prune] for k, v in x.items()}, bad[prune])
        inside = _covered(rule, x, len(bad)) & left
        held = inside & prune
        if (held & bad).sum() < min_covered or (held & bad).sum() < min_precision * held.sum():
            break
        rules.append(rule)
        left &= ~inside
    return rules


def rule_column(rules: list[list[Condition]], stats: str = "_stats") -> Column:
    """The number of the first rule that rejects the row (from 1), 0 if none does."""
    out = None
    for k, rule in enumerate(rules, 1):
        test = rule[0].column(stats)
        for c in rule[1:]:
            test = test & c.column(stats)
        out = F.when(test, k) if out is None else out.when(test, k)
    return F.lit(0) if out is None else out.otherwise(0)


def labelled_stats(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   label_col: str = "quality", max_labelled: int = MAX_LABELLED) -> pd.DataFrame:
    """Statistics and labels of a bounded sample of labelled rows that pass the base rule."""
    picked = (labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label"))
              .dropna().groupBy("_id").agg(F.min("_label").alias("_label"))
              .orderBy(F.xxhash64("_id"), "_id").limit(max_labelled))
    # at most max_labelled ids are broadcast
    return (docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
            .join(F.broadcast(picked), "_id")
            .select("_id", "_label", stats_column(F.col("_text")).alias("_stats"))
            .where(~base_failed()).select("_id", "_label", "_stats.*").toPandas().sort_values("_id", ignore_index=True))


def fit(docs: DataFrame, labels: DataFrame, **options) -> list[list[Condition]]:
    sample = labelled_stats(docs, labels, **options)
    return learn(sample[list(STATS)], (sample["_label"] == 0).to_numpy()) if len(sample) else []


def judge(docs: DataFrame, rules: list[list[Condition]], text_col: str = "text") -> DataFrame:
    """``docs`` with the struct ``_quality``: the statistics, base_failed, rule and kept."""
    failed = base_failed()
    return (docs.withColumn("_stats", stats_column(text_of(text_col)))
            .withColumn("_rule", rule_column(rules))
            .withColumn("_quality", F.struct("_stats.*", failed.alias("base_failed"), F.col("_rule").alias("rule"),
                                             (~failed & (F.col("_rule") == 0)).alias("kept")))
            .drop("_stats", "_rule"))


def filter_quality(docs: DataFrame, labels: DataFrame, text_col: str = "text", **options) -> DataFrame:
    """The documents that the base rule and the learned list keep, with all their columns."""
    rules = fit(docs, labels, text_col=text_col, **options)
    return unpacked(judge(packed(docs, text=F.col(text_col)), rules).where("_quality.kept"))
