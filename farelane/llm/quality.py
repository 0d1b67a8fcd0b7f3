"""Quality scores by positive-unlabelled learning.

Trusted positives are documents labelled 1; the unlabelled set are documents
without a label.  A small network is fitted to the non-negative unbiased risk

    pi R_p(+) + max(0, R_u(-) - pi R_p(-))

with logistic loss, where the class prior pi is estimated from the scores of a
first fit: the largest share of positives that the unlabelled scores allow.

Features come from the whole text: the shares of characters by class, the
transitions between classes, and repetition, length and case of words and
lines.  At most ``max_rows`` rows of each set are collected for the fit."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelane.llm.common import fresh, quoted, unit

CLASSES = 9  # lower, upper, other letter, digit, space, line end, sentence sign, other sign, other


def _class_table() -> np.ndarray:
    import unicodedata
    kinds = {"Ll": 0, "Lu": 1, "Lt": 1, "Lm": 2, "Lo": 2, "Nd": 3, "Nl": 3, "No": 3, "Zs": 4, "Zl": 5, "Zp": 5}
    out = np.array([kinds.get(unicodedata.category(chr(i)), 7 if unicodedata.category(chr(i))[0] in "PS" else 8)
                    for i in range(0x10000)], np.uint8)
    out[[9]], out[[10, 13]] = 4, 5
    out[[ord(c) for c in ".,;:?'\"-"]] = 6
    return out


_TABLE: list[np.ndarray] = []
N_FEATURES = CLASSES + CLASSES * CLASSES + 14


def features(text: str | None) -> np.ndarray:
    """Feature vector of a whole text (zeros for null or empty)."""
    out = np.zeros(N_FEATURES, np.float32)
    if not text:
        return out
    if not _TABLE:
        _TABLE.append(_class_table())
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    k = _TABLE[0][np.minimum(c, 0xFFFF)].astype(np.int64)
    out[:CLASSES] = np.bincount(k, minlength=CLASSES) / len(k)
    if len(k) > 1:
        pairs = np.bincount(k[:-1] * CLASSES + k[1:], minlength=CLASSES * CLASSES)
        out[CLASSES:CLASSES + CLASSES * CLASSES] = np.sqrt(pairs / (len(k) - 1))
    words, lines = text.split(), [x.strip() for x in text.split("\n")]
    lines = [x for x in lines if x]
    out[-14:-12] = np.log1p(len(text)) / 10, np.log1p(len(words)) / 10
    if words:
        n, seen = len(words), Counter(words)
        length = np.fromiter(map(len, words), np.float64, n)
        most = seen.most_common(3)
        two = len(set(zip(words, words[1:]))) / max(1, n - 1)
        same = sum(a == b for a, b in zip(words, words[1:])) / max(1, n - 1)
        upper = sum(map(str.isupper, words)) / n
        alpha = sum(map(str.isalpha, words)) / n
        out[-12:-3] = (len(seen) / n, len(seen) / n ** 0.75, two, same, most[0][1] / n, sum(x[1] for x in most) / n,
                       length.mean() / 10, upper, alpha)
    if lines:
        out[-3:] = len(set(lines)) / len(lines), np.log1p(len(text) / len(lines)) / 10, sum(len(x) < 30 for x in lines) / len(lines)
    return out


@F.pandas_udf(T.ArrayType(T.FloatType()))
def _features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([features(t) for t in texts], dtype=object)


class Network:
    """One hidden layer on standardised features; ``score`` is in (0, 1)."""

    def __init__(self, mean, scale, w1, b1, w2, b2):
        self.mean, self.scale, self.w1, self.b1, self.w2, self.b2 = mean, scale, w1, b1, w2, b2

    def logit(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.tanh(z @ self.w1 + self.b1) @ self.w2 + self.b2

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logit(x), -30, 30)))


def fit_nnpu(pos: np.ndarray, unl: np.ndarray, prior: float, hidden: int = 24, epochs: int = 60, batch: int = 512,
             rate: float = 0.003, decay: float = 1e-3, seed: int = 3) -> Network:
    """Minimise the non-negative risk with Adam; a batch whose negative part is
    below zero takes a step that raises it."""
    rng = np.random.default_rng(seed)
    both = np.concatenate([pos, unl])
    mean, scale = both.mean(axis=0), both.std(axis=0) + 1e-3
    w1 = rng.normal(0, (1 / both.shape[1]) ** 0.5, (both.shape[1], hidden))
    net = Network(mean, scale, w1, np.zeros(hidden), rng.normal(0, 0.1, hidden), np.zeros(1))
    p, u = np.clip((pos - mean) / scale, -8, 8), np.clip((unl - mean) / scale, -8, 8)
    params = [net.w1, net.b1, net.w2, net.b2]
    m, v, t = [np.zeros_like(x) for x in params], [np.zeros_like(x) for x in params], 0
    sig = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for _ in range(epochs):
        up, pp = rng.permutation(len(u)), rng.permutation(len(p))
        for i in range(0, len(u), batch):
            xu = u[up[i:i + batch]]
            j = (i * len(p)) // len(u)
            xp = p[pp[np.arange(j, j + min(batch, len(p))) % len(p)]]
            x = np.concatenate([xp, xu])
            h = np.tanh(x @ net.w1 + net.b1)
            z = h @ net.w2 + net.b2
            zp, zu = z[:len(xp)], z[len(xp):]
            negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
            gp, gu = np.zeros(len(zp)), np.zeros(len(zu))
            if negative >= 0:
                gp += prior * (-(1 - sig(zp)) - sig(zp)) / len(zp)
                gu += sig(zu) / len(zu)
            else:
                gp += prior * sig(zp) / len(zp)
                gu -= sig(zu) / len(zu)
            g = np.concatenate([gp, gu])
            gh = np.outer(g, net.w2) * (1 - h * h)
            grads = [x.T @ gh + decay * net.w1, gh.sum(axis=0), h.T @ g + decay * net.w2, np.array([g.sum()])]
            t += 1
            for k, (par, gr) in enumerate(zip(params, grads)):
                m[k] = 0.9 * m[k] + 0.1 * gr
                v[k] = 0.999 * v[k] + 0.001 * gr * gr
                par -= rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    return net


def estimate_prior(pos_scores: np.ndarray, unl_scores: np.ndarray) -> float:
    """Largest share of positives that the unlabelled scores allow: the least
    ratio of the two sets' shares above a threshold, thresholds with at least
    5 % of the positives above, with a margin for their sampling error."""
    if not len(pos_scores) or not len(unl_scores):
        return 0.5
    cuts = np.quantile(pos_scores, np.linspace(0.0, 0.95, 96))
    p = np.array([(pos_scores >= c).mean() for c in cuts])
    u = np.array([(unl_scores >= c).mean() for c in cuts])
    err = np.sqrt(p * (1 - p) / len(pos_scores)) + np.sqrt(u * (1 - u) / len(unl_scores))
    return float(np.clip(((u + err) / np.maximum(p, 1e-9)).min(), 0.05, 0.99))


def bounded_sample(docs: DataFrame, ids: DataFrame, key: str = "doc_id", max_rows: int = 20_000, seed: int = 3) -> DataFrame:
    """The rows of ``docs`` whose key is among about ``max_rows`` of ``ids``,
    chosen by a hash of the key.  Only keys are counted and sampled; the sample
    is bounded by ``max_rows``, so it is broadcast and no text is shuffled."""
    n = ids.count()
    if n > max_rows:
        ids = ids.filter(unit(F.xxhash64(F.lit(seed), quoted(key))) < max_rows / n)
    return docs.join(F.broadcast(ids), key, "left_semi")


def fit(positives: DataFrame, unlabelled: DataFrame, text: str = "text", max_rows: int = 20_000,
        epochs: int = 60, seed: int = 3) -> Network | None:
    """Fit on at most about ``max_rows`` rows of each set, chosen by a hash of
    the text; None if either is empty."""
    def collect(df):
        n = df.count()
        df = df.select(quoted(text).alias("t"))
        if n > max_rows:
            df = df.filter(unit(F.xxhash64(F.lit(seed), F.monotonically_increasing_id(), "t")) < max_rows / n)
        got = df.select(_features("t").alias("x")).toPandas()["x"]
        return np.stack(got.to_list()).astype(np.float64) if len(got) else np.empty((0, N_FEATURES))
    pos, unl = collect(positives), collect(unlabelled)
    if not len(pos) or not len(unl):
        return None
    first = fit_nnpu(pos, unl, 0.5, epochs=max(5, epochs // 3), seed=seed)
    prior = estimate_prior(first.score(pos), first.score(unl))
    return fit_nnpu(pos, unl, prior, epochs=epochs, seed=seed)


def scored(docs: DataFrame, net: Network | None, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (double, 0 to 1, higher: better) and
    ``predicted`` (1 if score >= 0.5); names get ``_`` appended if taken.  Null
    texts score as empty ones; without a model every score is 0.5."""
    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            if net is None or not len(texts):
                yield pd.Series(np.full(len(texts), 0.5))
            else:
                yield pd.Series(net.score(np.stack([features(t) for t in texts])))
    s, p = fresh(docs, "score", "predicted")
    return docs.withColumn(s, score(quoted(text))).withColumn(p, (quoted(s) >= 0.5).cast("int"))
