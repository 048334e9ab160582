"""Quality classifier: a sparse ensemble of rules taken from trees, compiled into column expressions."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEATURES = (
    "log_bytes",
    "log_words",
    "word_bytes",
    "symbols",
    "bangs",
    "pipes",
    "capitals",
    "digits",
    "stops_per_word",
    "distinct_words",
    "distinct_lines",
    "line_words",
)
TRAIN_ROWS = 8000
TREES, DEPTH, BINS = 30, 3, 32
PENALTY = 0.002
_SYMBOLS = b"#$%&*@^~<>{}[]=\\_"
_UPPER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def measures(text: str | None) -> list[float]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    lines = raw.split(b"\n")
    n, w = max(1, len(raw)), max(1, len(words))
    without = lambda chars: (len(raw) - len(raw.translate(None, chars))) / n
    return [
        float(np.log1p(len(raw))),
        float(np.log1p(len(words))),
        sum(map(len, words)) / w,
        without(_SYMBOLS),
        raw.count(b"!") / n,
        raw.count(b"|") / n,
        without(_UPPER),
        without(b"0123456789"),
        raw.count(b".") / w,
        len(set(words)) / w,
        len(set(lines)) / len(lines),
        len(words) / len(lines),
    ]


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The id and ``FEATURES`` of every row, over whole texts; null counts as empty."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def work(batches):
        for batch in batches:
            found = np.array([measures(t) for t in batch.column("text").to_pylist()], np.float64).reshape(-1, len(FEATURES))
            columns = [pa.array(np.ascontiguousarray(c)) for c in found.T]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *FEATURES])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(work, f"doc_id {kind}, " + ", ".join(f"{f} double" for f in FEATURES))


Condition = tuple[int, bool, float]  # feature, whether above, threshold
Rule = tuple[Condition, ...]


class Ensemble(NamedTuple):
    bias: float
    rules: list[tuple[Rule, float]]

    def score(self) -> Column:
        """The probability of label 1 as a column over ``FEATURES``."""
        total = F.lit(self.bias)
        for rule, weight in self.rules:
            held = None
            for feature, above, threshold in rule:
                value = F.col(FEATURES[feature])
                test = value > threshold if above else value <= threshold
                held = test if held is None else held & test
            total = total + F.when(held, weight).otherwise(0.0)
        return 1 / (1 + F.exp(-total))


def holds(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([(x[:, f] > t) if above else (x[:, f] <= t) for f, above, t in rule])


def _sigmoid(v: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(v, -30, 30)))


def tree_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """Paths of boosted trees, to inner nodes and leaves alike, as conjunctions; each once, in order found."""
    cuts = [np.unique(np.quantile(c, np.linspace(0, 1, BINS + 1)[1:-1])) for c in x.T]
    binned = np.stack([np.searchsorted(c, v, "left") for c, v in zip(cuts, x.T)], axis=1)
    rules: dict[Rule, None] = {}
    margin = np.zeros(len(y))
    least = max(5, len(y) // 200)

    def grow(rows: np.ndarray, gradient: np.ndarray, curve: np.ndarray, path: Rule) -> None:
        best = (1e-9, None)
        g, h = gradient[rows], curve[rows]
        if len(path) < DEPTH and len(rows) >= 2 * least:
            whole = g.sum() ** 2 / (h.sum() + 1)
            for f, c in enumerate(cuts):
                b = binned[rows, f]
                size = np.cumsum(np.bincount(b, minlength=len(c) + 1))[:-1]
                left, lh = (np.cumsum(np.bincount(b, w, len(c) + 1))[:-1] for w in (g, h))
                gain = left**2 / (lh + 1) + (g.sum() - left) ** 2 / (h.sum() - lh + 1) - whole
                gain[(size < least) | (len(rows) - size < least)] = -1
                if len(gain) and gain.max() > best[0]:
                    best = (gain.max(), (f, int(gain.argmax())))
        if best[1] is None:
            margin[rows] += 0.3 * g.sum() / (h.sum() + 1)
            return
        f, at = best[1]
        for above in (False, True):
            side = rows[(binned[rows, f] > at) == above]
            step = (*path, (f, above, float(cuts[f][at])))
            rules.setdefault(tuple(sorted(step)))
            grow(side, gradient, curve, step)

    for _ in range(TREES):
        p = _sigmoid(margin)
        grow(np.arange(len(y)), y - p, p * (1 - p), ())
    return list(rules)


def lasso_logistic(z: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 400) -> tuple[float, np.ndarray]:
    """Bias and weights by accelerated proximal gradient; columns of ``z`` count in units of their deviation."""
    scale = np.maximum(z.std(axis=0), 0.05)
    a = ((z - z.mean(axis=0)) / scale).astype(np.float32)
    probe = np.ones(a.shape[1], np.float32)
    for _ in range(20):  # the largest curvature, by power iteration
        probe = a.T @ (a @ probe)
        probe /= max(np.linalg.norm(probe), 1e-12)
    step = 4 * len(y) / max(float(np.linalg.norm(a @ probe) ** 2), 1.0)
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    bias, w = float(np.log(share / (1 - share))), np.zeros(a.shape[1], np.float32)
    ahead, momentum = w.copy(), 1.0
    for _ in range(rounds):
        off = (_sigmoid(a @ ahead + bias) - y).astype(np.float32)
        new = ahead - step * (a.T @ off) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * penalty, 0)
        bias -= 4 * float(off.mean())
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        ahead = (new + (momentum - 1) / after * (new - w)).astype(np.float32)
        w, momentum = new, after
    weights = w / scale
    return bias - float(weights @ z.mean(axis=0)), weights


def fit(x: np.ndarray, y: np.ndarray, penalty: float = PENALTY) -> Ensemble:
    """A constant where there is nothing to tell apart."""
    if len(y) == 0:
        return Ensemble(0.0, [])
    share = (y.sum() + 1) / (len(y) + 2)
    rules = tree_rules(x, y) if 0 < y.sum() < len(y) else []
    if not rules:
        return Ensemble(float(np.log(share / (1 - share))), [])
    bias, weights = lasso_logistic(np.stack([holds(r, x) for r in rules], axis=1).astype(np.float32), y, penalty)
    return Ensemble(bias, [(r, float(w)) for r, w in zip(rules, weights) if w])


def learn(docs: DataFrame, labels: DataFrame, usable: Column, train_rows: int = TRAIN_ROWS) -> Ensemble:
    """Fit on about ``train_rows`` labelled documents for which ``usable`` holds, chosen by a hash of the id.

    Only their ids are sent to the tasks and only their statistics to the driver: bounded by the parameter.
    A label row that repeats, or a document that does, weighs as often as it is there.
    """
    known = labels.select("doc_id", F.col("quality").cast("double").alias("label")).where(usable & F.col("label").isNotNull())
    share = min(1.0, train_rows / max(1, known.count()))
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit("learn")), F.lit(1_000_000)) < int(share * 1_000_000))
    rows = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    measured = statistics(rows.select(F.struct("doc_id", "label").alias("doc_id"), "text"))
    found = measured.select("doc_id.doc_id", "doc_id.label", *FEATURES).toPandas().sort_values(["doc_id", *FEATURES])
    return fit(found[list(FEATURES)].to_numpy(), found["label"].to_numpy())


def score(docs: DataFrame, ensemble: Ensemble, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, score)`` per input row: the probability that the text is of good quality.

    Null and empty texts are scored like any other, from their statistics. A null id is carried along,
    repeated rows give repeated results, an empty table gives no rows. Other columns are never looked at. The
    statistics of a very long text are taken over all of it.
    """
    return statistics(docs, id_col, text_col).select("doc_id", ensemble.score().alias("score"))
