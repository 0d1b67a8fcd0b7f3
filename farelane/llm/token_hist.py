"""Token counts as an exact histogram of encoded lengths.

Whole texts are encoded in tasks by a public tokenizer; documents are counted
by length, and suffix sums over the histogram answer every context limit: how
many documents are longer, how many tokens are kept if each is cut there, and
the share of documents up to it.  The histogram has as many rows as there are
lengths, at most the longest text's."""

from __future__ import annotations

import base64
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from farelane.llm.common import quoted
from farelane.session import materialize

#: Ranks file of a byte-level BPE vocabulary; installed alike on every machine.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How text is cut into pieces before the merges (fixed value of that vocabulary).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_LOADED: dict = {}


def encoder(path: str, pattern: str = PATTERN):
    """The tokenizer of a ranks file; loaded once in each worker process."""
    if (path, pattern) not in _LOADED:
        import tiktoken
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _LOADED[path, pattern] = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return _LOADED[path, pattern]


def token_counter(path: str = VOCABULARY):
    """A column function: text -> number of tokens (0 for null and empty)."""
    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        enc = encoder(path)
        for texts in batches:
            yield pd.Series([len(enc.encode_ordinary(t)) if t else 0 for t in texts], dtype="int64")
    return count


def length_histogram(docs: DataFrame, text: str = "text", path: str = VOCABULARY) -> DataFrame:
    """One row per encoded length that occurs, also as a context limit:

    ``n_tokens``; ``docs`` and ``tokens`` of that length; ``docs_from`` and
    ``tokens_from`` of that length or more (suffix sums); ``docs_to``,
    ``share_to`` up to that length (a quantile q is the first n_tokens with
    share_to >= q); ``truncated_tokens``: the corpus total if every document is
    cut to n_tokens.

    Null and empty texts have 0 tokens.  Repeated rows all count.  An empty
    table gives an empty one."""
    hist = docs.select(token_counter(path)(quoted(text)).alias("n_tokens")).groupBy("n_tokens").agg(
        F.count(F.lit(1)).alias("docs"))
    hist = materialize(hist.withColumn("tokens", F.col("n_tokens") * F.col("docs"))
                       .withColumn("page", F.floor(F.col("n_tokens") / 1024)))
    # suffix sums by pages of 1024 lengths: no window over all lengths
    pages = hist.groupBy("page").agg(F.sum("docs").alias("pd"), F.sum("tokens").alias("pt"))
    later = Window.orderBy(F.desc("page")).rowsBetween(Window.unboundedPreceding, -1)
    pages = pages.select(F.col("page").alias("p"), F.coalesce(F.sum("pd").over(later), F.lit(0)).alias("later_docs"),
                         F.coalesce(F.sum("pt").over(later), F.lit(0)).alias("later_tokens"))
    total = hist.agg(F.sum("docs").alias("all_docs"), F.sum("tokens").alias("all_tokens"))
    own = Window.partitionBy("page").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, 0)
    out = hist.join(pages, F.col("page") == F.col("p")).join(F.broadcast(total))  # one row
    out = out.withColumns({"docs_from": F.sum("docs").over(own) + F.col("later_docs"),
                           "tokens_from": F.sum("tokens").over(own) + F.col("later_tokens")})
    return out.select("n_tokens", "docs", "tokens", "docs_from", "tokens_from",
                      (F.col("all_docs") - F.col("docs_from") + F.col("docs")).alias("docs_to"),
                      ((F.col("all_docs") - F.col("docs_from") + F.col("docs")) / F.col("all_docs")).alias("share_to"),
                      (F.col("all_tokens") - F.col("tokens_from") + F.col("n_tokens") * F.col("docs_from")).alias("truncated_tokens"))


def total_tokens(hist: DataFrame) -> int:
    return hist.agg(F.sum("tokens")).first()[0] or 0


def quantile(hist: DataFrame, q: float) -> int | None:
    """Smallest length that a share ``q`` of the documents doesn't exceed."""
    return hist.filter(F.col("share_to") >= q).agg(F.min("n_tokens")).first()[0]


def truncated_total(hist: DataFrame, limit: int) -> int:
    """Tokens left if each document is cut to ``limit``, for any limit."""
    return hist.agg(F.sum(F.least(F.col("n_tokens"), F.lit(limit)) * F.col("docs"))).first()[0] or 0
