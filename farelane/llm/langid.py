"""Language identification by multilingual mixture inference.

Training counts letter trigrams (within words, with word ends, lower-cased and
hashed to ``BUCKETS``) per language over all labelled rows; tasks emit partial
counts, an aggregation sums them, and at most BUCKETS x languages counts come
to the driver.  A word's log-likelihood under a language is the sum of its
smoothed trigram log-probabilities.

A document is a mixture: each word comes from one of the languages, with the
document's unknown proportions, which expectation-maximisation estimates over
the whole text.  The set of languages is the one of least penalised likelihood,
-2 log L + (languages - 1) log(words).  The prediction is the language with the
largest proportion, the score is that proportion.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.common import fresh, quoted

BUCKETS = 1 << 16
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")
#: Letters that are worked on at once; a longer text is on its own.
CHUNK = 500_000


def chunks(texts: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about CHUNK characters."""
    start = size = 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each letter's trigram, first trigram of each word, document
    of each word) of cleaned texts (letters, words parted by one space)."""
    joined = " " + " ".join(f"{t}\u0001" if t else "\u0001" for t in texts) + " "
    c = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32).copy()
    mark = c == 1
    doc = np.cumsum(mark) - mark
    c[mark] = 32
    mid = np.flatnonzero(c[1:-1] != 32) + 1
    x = c.astype(np.uint64)
    h = (x[mid - 1] * np.uint64(0x9E3779B97F4A7C15)) ^ (x[mid] * np.uint64(0xC2B2AE3D27D4EB4F)) ^ (x[mid + 1] * np.uint64(0x165667B19E3779F9))
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    first = np.flatnonzero(c[mid - 1] == 32)
    return (h >> np.uint64(48)).astype(np.int64), first, doc[mid[first]]


def cleaned(text: str | None) -> str:
    return _NOT_LETTERS.sub(" ", text.lower()).strip() if text else ""


def _counts(langs: list[str]):
    index = {x: i for i, x in enumerate(langs)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(langs), BUCKETS), np.int64)
        for pdf in batches:
            for lang, part in pdf.groupby("y"):
                texts = [cleaned(t) for t in part["t"]]
                for a, b in chunks(texts):
                    total[index[lang]] += np.bincount(trigrams(texts[a:b])[0], minlength=BUCKETS)
        li, bi = np.nonzero(total)
        if len(li):
            yield pd.DataFrame({"l": li.astype(np.int32), "g": bi.astype(np.int32), "n": total[li, bi]})
    return run


class LanguageModel:
    """Trigram log-probabilities, one row per language (sorted names)."""

    def __init__(self, langs: list[str], counts: np.ndarray, alpha: float = 0.5):
        self.langs = langs
        p = counts.astype(np.float64) + alpha
        self.logp = np.log(p / p.sum(axis=1, keepdims=True)).astype(np.float32).T.copy()  # bucket x language


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", max_langs: int | None = None) -> LanguageModel:
    """Learn from all rows with a language and a text; any number of languages,
    unless ``max_langs`` is given, which more languages than that raise."""
    rows = docs.select(quoted(lang).alias("y"), quoted(text).alias("t")).filter("y is not null and t is not null")
    found = rows.select("y").distinct()
    langs = sorted(r[0] for r in (found if max_langs is None else found.limit(max_langs + 1)).collect())
    if max_langs is not None and len(langs) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    counts = np.zeros((len(langs), BUCKETS), np.int64)
    if langs:
        got = rows.mapInPandas(_counts(langs), "l int, g int, n long").groupBy("l", "g").agg(F.sum("n").alias("n")).toPandas()
        counts[got["l"].to_numpy(), got["g"].to_numpy()] = got["n"].to_numpy()
    return LanguageModel(langs, counts)


def _em(p: np.ndarray, at: np.ndarray, n: np.ndarray, allowed: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Proportions and log-likelihood (up to the words' own scale) of each
    document.  p: word x language likelihoods; at: first word of each document;
    allowed: document x language."""
    pi = allowed / allowed.sum(axis=1, keepdims=True)
    for _ in range(rounds):
        w = np.repeat(pi, n, axis=0)
        w *= p
        w /= np.maximum(w.sum(axis=1, keepdims=True), 1e-300)
        pi = np.add.reduceat(w, at, axis=0) / n[:, None]
    like = (np.repeat(pi, n, axis=0) * p).sum(axis=1)
    return pi, np.add.reduceat(np.log(np.maximum(like, 1e-300)), at)


def infer(words_ll: np.ndarray, doc: np.ndarray, docs: int, rounds: int = 6, more: int = 20) -> np.ndarray:
    """Proportions (document x language, 0 for languages outside the chosen
    set) from word log-likelihoods; documents without words get zeros."""
    out = np.zeros((docs, words_ll.shape[1]))
    if not len(doc):
        return out
    ids, at, n = np.unique(doc, return_index=True, return_counts=True)
    p = np.exp(words_ll - words_ll.max(axis=1, keepdims=True)).astype(np.float64)
    p = np.maximum(p, 1e-12)
    langs = p.shape[1]
    pi, ll = _em(p, at, n, np.ones((len(ids), langs)), rounds)
    top = pi.argmax(axis=1)
    one = np.add.reduceat(np.log(p), at, axis=0)
    best = one.argmax(axis=1)
    penalty = np.log(n)
    chosen = np.zeros_like(pi)
    chosen[np.arange(len(ids)), best] = 1
    # one language is best unless all together gain more than one penalty
    open_ = np.flatnonzero((2 * (ll - one.max(axis=1)) > 0.9 * penalty) | (top != best))
    owner = np.repeat(np.arange(len(ids)), n)
    order = np.argsort(-pi, axis=1, kind="stable")
    least = -2 * one.max(axis=1)
    for k in range(2, langs + 1):
        if not len(open_):
            break
        m = n[open_]
        allowed = np.zeros((len(open_), langs))
        np.put_along_axis(allowed, order[open_, :k], 1, axis=1)
        got, value = _em(p[np.isin(owner, open_)], np.concatenate([[0], np.cumsum(m)[:-1]]), m, allowed, more)
        crit = -2 * value + (k - 1) * penalty[open_]
        better = crit < least[open_]
        # a document's search ends when it doesn't gain, whatever the others do
        open_, got = open_[better], got[better]
        chosen[open_], least[open_] = got, crit[better]
    out[ids] = chosen
    return out


RESULT = "struct<lang_pred:string,score:double,languages:array<struct<lang:string,share:double>>>"


def predictor(model: LanguageModel):
    """A column function: text -> struct of lang_pred, score and languages."""
    langs, logp = model.langs, model.logp

    @F.pandas_udf(RESULT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for raw in batches:
            texts = [cleaned(t) for t in raw]
            pred, score = np.full(len(texts), "und", object), np.zeros(len(texts))
            found: list[list[dict]] = [[] for _ in texts]
            for a, b in chunks(texts) if langs else ():
                g, first, doc = trigrams(texts[a:b])
                ll = np.add.reduceat(logp[g], first, axis=0) if len(first) else np.empty((0, len(langs)), np.float32)
                pi = infer(ll, doc, b - a)
                for i in np.flatnonzero(pi.sum(axis=1) > 0):
                    if not _LETTER.search(texts[a + i]):
                        continue
                    k = int(pi[i].argmax())
                    pred[a + i], score[a + i] = langs[k], min(1.0, float(pi[i, k]))
                    found[a + i] = [{"lang": langs[j], "share": float(pi[i, j])}
                                    for j in np.argsort(-pi[i], kind="stable") if pi[i, j] > 0]
            yield pd.DataFrame({"lang_pred": pred, "score": score, "languages": found})
    return predict


def identify(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` (0 to 1: the share of that
    language) and ``languages`` (array of lang and share, largest first); names
    get ``_`` appended if ``docs`` has them.  Only the text is looked at.  A
    null text, one without a letter, or a model without languages gives
    ``und``, 0 and no languages.  Ties go to the first language by name."""
    got, pred, score, langs = fresh(docs, "got", "lang_pred", "score", "languages")
    out = docs.withColumn(got, predictor(model)(quoted(text)))
    return out.select(*[quoted(c) for c in docs.columns], F.col(f"{got}.lang_pred").alias(pred),
                      F.col(f"{got}.score").alias(score), F.col(f"{got}.languages").alias(langs))


def identified_only(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` (all columns) without the rows whose language can't be told
    (``und``): null texts and texts without a letter.  The model is learned
    from the rows with a language."""
    pred, = fresh(docs, "lang_pred")
    model = fit(docs, text, lang)
    if not model.langs:  # nothing to learn from: the letters alone decide
        return docs.filter(quoted(text).rlike(r"\p{L}"))
    marked = docs.withColumn(pred, predictor(model)(quoted(text))["lang_pred"])
    return marked.filter(quoted(pred) != "und").drop(pred)


def labelled(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """``docs`` (all columns) without the rows whose language can't be told
    (``und``: null texts and texts without a letter), with ``lang`` put right:
    a label stays if it is among the languages inferred from the text; a null
    label, or one that the text has nothing of, becomes the text's first language.
    The model is learned from the rows with a label.  Repeated rows all stay; very
    long texts are read whole; an empty table gives an empty one."""
    got, = fresh(docs, "got")
    model = fit(docs, text, lang)
    if not model.langs:  # nothing to learn from: the letters alone decide
        return docs.filter(quoted(text).rlike(r"\p{L}"))
    # exploded, so that the filter and the label below read one result of the model
    marked = docs.withColumn(got, F.explode(F.array(predictor(model)(quoted(text))))).filter(F.col(f"{got}.lang_pred") != "und")
    known = F.exists(F.col(f"{got}.languages"), lambda x: x["lang"] == quoted(lang))
    right = F.when(F.coalesce(known, F.lit(False)), quoted(lang)).otherwise(F.col(f"{got}.lang_pred"))
    return marked.select(*[right.alias(c) if c == lang else quoted(c) for c in docs.columns])
