"""Quality classifier: hashed word n-gram logistic regression by FTRL.

Features of a whole text, hashed into ``2 ** bits`` places: word 1- and
2-grams (lower-cased words and runs of punctuation), and 1- to 3-grams of word
shapes (lower, capitalised, upper case, digits, the punctuation run itself),
each marked when the word repeats the one before it or its 2-gram has occurred
before. Within each of the two families a feature's value is the square root
of its share, so texts of every length have the same norm.

Training: at most about ``max_train`` labelled rows (a documented bound: rows
are kept by a hash of the id at the rate that gives this number) are dealt over
up to ``SHARDS`` tasks; each runs follow-the-regularised-leader updates (FTRL
proximal) over its rows, and the weights are averaged. The model is a vector of
fixed size, broadcast for scoring; scoring is one pass without a shuffle, a
sparse dot product per document.

Defined cases: null and empty texts have no features and score by the bias
alone; a null id counts as the empty string in the fold rule; labels with a
null id or label are not learned; rows labelled twice are two examples; without
any labelled row every score is 0.5; input columns that clash with ``score``
get underscores added.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import table, written

BITS = 18
MAX_TRAIN = 12_000
SHARDS = 4
SHARD_ROWS = 3000
UPDATES = 40_000
THRESHOLD = 0.3
TOKEN = re.compile(r"[^\W_]+|[^\w\s]+|_+")
A, B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


class TokenCodes(dict):
    """token -> hash of the lower-cased token | shape << 32, computed once per
    token; emptied when it has grown large, so its memory is bounded."""

    def __missing__(self, token: str) -> int:
        if len(self) >= 200_000:
            self.clear()
        h = zlib.crc32(token.lower().encode("utf-8", "surrogatepass"))
        if token[0].isalnum():
            shape = 0 if token.islower() else 2 if token.isupper() and len(token) > 1 else 3 if token.isdigit() else 1
        else:
            shape = 8 + (h & 0xFFFF)
        code = self[token] = h | shape << 32
        return code


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * B
    return x ^ (x >> np.uint64(32))


def features(text: str | None, codes: TokenCodes, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of the text's features."""
    tokens = TOKEN.findall(text) if text else []
    if not tokens:
        return np.empty(0, np.int64), np.empty(0, np.float32)
    code = np.fromiter(map(codes.__getitem__, tokens), np.int64, len(tokens)).astype(np.uint64)
    h, shape = code & np.uint64(0xFFFFFFFF), code >> np.uint64(32)
    mask = np.uint64((1 << bits) - 1)
    out_i, out_v = [], []
    with np.errstate(over="ignore"):
        two = _mix(h[:-1] * A + h[1:])
        repeat = np.zeros(len(h), np.uint64)
        repeat[1:] = (h[1:] == h[:-1]).astype(np.uint64)
        seen = np.ones(len(two), np.uint64)
        seen[np.unique(two, return_index=True)[1]] = 0
        repeat[1:] += seen << np.uint64(1)
        s = shape * np.uint64(4) + repeat + np.uint64(1)
        words = np.concatenate((_mix(h * A), two))
        shapes = np.concatenate((_mix(s * B + np.uint64(11)), _mix((s[:-1] * A + s[1:]) * B + np.uint64(12)),
                                 _mix(((s[:-2] * A + s[1:-1]) * A + s[2:]) * B + np.uint64(13))))
    for family in (words, shapes):
        place, count = np.unique(family & mask, return_counts=True)
        out_i.append(place.astype(np.int64))
        out_v.append(np.sqrt(count / len(family)).astype(np.float32))
    return np.concatenate(out_i), np.concatenate(out_v)


def ftrl(examples: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, alpha: float = 2.0,
         beta: float = 1.0, l1: float = 1e-3, l2: float = 1e-3, seed: int = 1) -> np.ndarray:
    """Weights after FTRL-proximal updates; the last place is the bias. Small
    sets are passed over more often, up to 16 times."""
    epochs = min(16, max(4, UPDATES // max(1, len(examples))))
    size = (1 << bits) + 1
    z, n = np.zeros(size), np.zeros(size)
    weight = lambda i: np.where(np.abs(z[i]) <= l1, 0.0, -(z[i] - np.sign(z[i]) * l1)
                                / ((beta + np.sqrt(n[i])) / alpha + l2))
    order = np.random.default_rng(seed)
    for _ in range(epochs):
        for k in order.permutation(len(examples)):
            place, value, y = examples[k]
            w = weight(place)
            p = 1 / (1 + np.exp(-np.clip(w @ value, -35, 35)))
            g = (p - y) * value
            sigma = (np.sqrt(n[place] + g * g) - np.sqrt(n[place])) / alpha
            z[place] += g - sigma * w
            n[place] += g * g
    return weight(np.arange(size)).astype(np.float32)


def _with_bias(f, bits):
    return np.append(f[0], 1 << bits), np.append(f[1], np.float32(1))


def fold(id_col: Column, mod: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def train(labelled: DataFrame, bits: int = BITS, shards: int = SHARDS) -> np.ndarray:
    """Averaged weights learned from ``doc_id, text, label`` rows."""
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        codes = TokenCodes()
        rows = rows.sort_values(["doc_id", "label"])
        data = [(*_with_bias(features(t, codes, bits), bits), int(y)) for t, y in
                zip(rows["text"], rows["label"], strict=True)]
        return pd.DataFrame({"n": [len(data)], "w": [ftrl(data, bits).tobytes()]})

    labelled = written(labelled)
    tasks = min(shards, -(-labelled.count() // SHARD_ROWS) or 1)  # a small set is not split
    dealt = labelled.withColumn("shard", F.pmod(F.xxhash64(F.lit(5), "doc_id"), F.lit(tasks)))
    parts = dealt.groupBy("shard").applyInPandas(fit, "n long, w binary").collect()  # `shards` vectors
    total = sum(p["n"] for p in parts)
    w = np.zeros((1 << bits) + 1, np.float32)
    for p in sorted(parts, key=lambda p: p["w"]):
        w += np.frombuffer(p["w"], np.float32) * (p["n"] / total)
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> DataFrame:
    """About ``max_train`` rows of ``labels`` at most, with their texts."""
    known = labels.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull()).select("doc_id", "label")
    rate = min(1.0, max_train / max(1, known.count()))
    u = F.pmod(F.xxhash64(F.lit(3), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    some = known.where(u < rate).withColumnRenamed("doc_id", "l_id")  # bounded by max_train
    return (docs.select("doc_id", "text").join(F.broadcast(some), F.col("doc_id") == F.col("l_id"))
            .select("doc_id", "text", "label"))


def score_quality(docs: DataFrame, weights: np.ndarray, text_col: str = "text", bits: int = BITS) -> DataFrame:
    """``docs`` plus ``score``, the probability of label 1."""
    shared = docs.sparkSession.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w, codes = shared.value, TokenCodes()
        for texts in batches:
            out = []
            for t in texts:
                place, value = features(t, codes, bits)
                out.append(float(w[place] @ value + w[-1]))
            yield pd.Series(1 / (1 + np.exp(-np.clip(np.array(out, float), -35, 35))))

    base = docs.select(*[F.col(f"`{c}`").alias(c + "_" if c.lower() == "score" else c) for c in docs.columns])
    return base.withColumn("score", score(F.col(f"`{text_col}`")))


def op1_quality_classifier(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = (table(spark, sf_dir, "labels").where(fold(F.col("doc_id"), 5) != 0)
              .select("doc_id", F.col("quality").alias("label")))
    weights = train(labelled_sample(docs, labels))
    return score_quality(docs, weights).select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
