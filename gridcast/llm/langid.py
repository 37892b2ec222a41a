"""Language identification by a linear-chain conditional random field.

Words are runs of letters, lower-cased. A word's state score is the sum of
learned weights of its hashed character n-grams (1 to 4, with the word's
borders as a character, so that they cover prefixes and suffixes) and of its
lexicon entry (the ``LEXICON`` most frequent words of each language in the
training sample). Transitions between the labels of neighbouring words are
learned, too. Forward-backward gives every word's label probabilities, so
code-switched text is labelled word by word; a document's language is the one
with the largest mean probability, and that mean is its score.

Forward-backward is exact on whole texts: sequences are cut into blocks of
``BLOCK`` words whose transfer matrices are computed side by side, chained per
document, and then refined inside the blocks. Long texts are scored in slices
cut between words.

Training: about ``PER_LANGUAGE`` documents of each language at most (a
documented bound, kept by a hash of id and text at the rate that gives this
number) are dealt over ``SHARDS`` tasks. Each task splices runs of words from
documents of different languages into code-switched sequences, maximises their
conditional likelihood by AdaGrad, and the parameters are averaged. The model
has a fixed size and is broadcast; prediction is one pass without a shuffle.

Defined cases: a null text or one without letters is ``und`` with score 0; so
is every text if nothing could be learned; a null id counts as the empty string
in the fold rule; repeated rows are predicted alike; input columns that clash
with ``lang_pred`` or ``lang_score`` get underscores added.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import bound_batches, fresh, give_back, set_aside, table
from gridcast.llm.quality import fold

BITS = 16
NGRAM = 4
LEXICON = 300
PER_LANGUAGE = 1500
SHARDS = 4
EPOCHS = 3
SEQUENCE = 48
RUN = 12
BLOCK = 64
SLICE = 1 << 17
MULT = np.uint64(0x9E3779B97F4A7C15)
_LETTER: dict[int, np.ndarray] = {}


def letters(codes: np.ndarray) -> np.ndarray:
    """True where the code point is a letter."""
    if 0 not in _LETTER:
        _LETTER[0] = np.array([chr(i).isalpha() for i in range(1 << 16)])
    out = _LETTER[0][np.minimum(codes, 0xFFFF)]
    high = codes > 0xFFFF
    if high.any():
        out[high] = [chr(c).isalpha() for c in codes[high].tolist()]
    return out


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)


class Words:
    """The words of a code-point array: n-gram places, offsets and hashes."""

    def __init__(self, codes: np.ndarray):
        is_letter = letters(codes)
        c = np.where(is_letter, codes, 0).astype(np.uint64)
        # 0 stands for a word border; as many in front as grams reach back, so that a word's
        # grams are the same wherever it stands
        c = np.concatenate((np.zeros(NGRAM, np.uint64), c, [0])).astype(np.uint64)
        inside = c > 0
        first = np.flatnonzero(inside[1:] & ~inside[:-1]) + 1
        end = np.flatnonzero(inside[:-1] & ~inside[1:]) + 1
        self.n = len(first)
        if not self.n:
            return
        # a word's positions: its letters and the border after it
        take = inside.copy()
        take[end] = True
        at = np.flatnonzero(take)
        self.first = np.searchsorted(at, first)
        self.length = end - first
        with np.errstate(over="ignore"):
            grams, h, past = [], np.zeros(len(c), np.uint64), np.zeros(len(c), bool)
            for k in range(NGRAM):
                if k > 1:
                    past[k - 1:] |= c[:len(c) - k + 1] == 0  # a border lies between: the word ends there
                h = h * MULT
                h[k:] += np.where(past[k:], 0, c[:len(c) - k]).astype(np.uint64) + np.uint64(k + 1)
                g = (h ^ (h >> np.uint64(31))) * MULT
                grams.append((g >> np.uint64(64 - BITS)).astype(np.min_scalar_type((1 << BITS) - 1))[at])
            w = (c[at] + np.uint64(7)) * MULT
            place = np.arange(len(at)) - np.repeat(self.first, np.diff(np.append(self.first, len(at))))
            power = np.cumprod(np.full(64, MULT | np.uint64(2), np.uint64))
            self.hash = np.add.reduceat((w ^ (w >> np.uint64(29))) * power[place % 64] + place.astype(np.uint64), self.first)
        self.grams = grams

    def rows(self, weights: np.ndarray, lexicon: np.ndarray) -> np.ndarray:
        """State scores of all words, (n, labels)."""
        s = weights[self.grams[0]]
        for g in self.grams[1:]:
            s = s + weights[g]
        e = np.add.reduceat(s, self.first, axis=0) / np.sqrt(self.length + 1.0)[:, None]
        if len(lexicon):
            at = self.entry(lexicon)
            e = e + np.where((at >= 0)[:, None], weights[(1 << BITS) + np.maximum(at, 0)], 0)
        return e

    def entry(self, lexicon: np.ndarray) -> np.ndarray:
        """Place in the (sorted) lexicon, or -1."""
        i = np.minimum(np.searchsorted(lexicon, self.hash), len(lexicon) - 1)
        return np.where(lexicon[i] == self.hash, i, -1)


def slices(codes: np.ndarray, size: int = SLICE) -> Iterator[np.ndarray]:
    """Parts of about ``size`` code points, cut where a word ends."""
    at = 0
    while len(codes) - at > size:
        step = 1024
        while True:  # the last code point of the window that is no letter
            gap = np.flatnonzero(~letters(codes[at + size - min(step, size):at + size]))
            if len(gap):
                end = at + size - min(step, size) + int(gap[-1]) + 1
                break
            if step >= size:  # one word fills the slice: go on to its end
                rest = np.flatnonzero(~letters(codes[at + size:]))
                end = at + size + int(rest[0]) + 1 if len(rest) else len(codes)
                break
            step *= 8
        yield codes[at:end]
        at = end
    yield codes[at:]


def marginals(e: np.ndarray, lengths: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Label probabilities of every word by forward-backward, exactly.

    ``e``: state scores of all sequences one after the other; ``lengths``: words
    of each (at least 1); ``trans``: log transition scores."""
    n, k = e.shape
    a = np.exp(trans - trans.max())
    blocks = -(-lengths // BLOCK)
    first_block = np.concatenate(([0], np.cumsum(blocks)))
    nb = int(first_block[-1])
    start = np.concatenate(([0], np.cumsum(lengths)))
    seq = np.repeat(np.arange(len(lengths)), lengths)
    pos = np.arange(n) - start[seq]
    row, col = first_block[seq] + pos // BLOCK, pos % BLOCK
    x = np.ones((nb, BLOCK, k))
    x[row, col] = np.exp(e - e.max(axis=1, keepdims=True))
    live = np.zeros((nb, BLOCK), bool)
    live[row, col] = True
    width = int(col.max()) + 1
    # 1. transfer matrix of every block: what a forward message becomes behind it
    m = np.broadcast_to(np.eye(k), (nb, k, k)).copy()
    for t in range(width):
        step = (m.reshape(-1, k) @ a).reshape(nb, k, k) * x[:, t, None, :]
        step /= step.max(axis=(1, 2), keepdims=True)
        m = step if live[:, t].all() else np.where(live[:, t, None, None], step, m)
    # 2. messages at the block borders, chained over the blocks of each sequence
    fwd, bwd = np.empty((nb, k)), np.ones((nb, k))
    order = np.argsort(-blocks, kind="stable")
    many = blocks[order]
    f = np.full((len(lengths), k), 1.0 / k)
    for b in range(int(many[0])):
        on = order[:np.searchsorted(-many, -b, side="left")]  # sequences with more than b blocks
        i = first_block[on] + b
        fwd[i] = f[on]
        g = np.einsum("ij,ijk->ik", f[on], m[i])
        f[on] = g / g.sum(axis=1, keepdims=True)
    g = np.ones((len(lengths), k))
    for b in range(1, int(many[0])):
        on = order[:np.searchsorted(-many, -b, side="left")]
        i = first_block[on] + blocks[on] - b
        h = np.einsum("ijk,ik->ij", m[i], g[on])
        g[on] = h / h.sum(axis=1, keepdims=True)
        bwd[i - 1] = g[on]
    # 3. inside the blocks
    alpha = np.empty((nb, width, k))
    cur = fwd
    for t in range(width):
        cur = (cur @ a) * x[:, t]
        cur /= cur.sum(axis=1, keepdims=True)
        alpha[:, t] = cur
    cur = bwd
    for t in range(width - 1, -1, -1):
        alpha[:, t] *= cur
        step = (x[:, t] * cur) @ a.T
        step /= step.sum(axis=1, keepdims=True)
        cur = step if live[:, t].all() else np.where(live[:, t, None], step, cur)
    p = alpha[row, col]
    return p / p.sum(axis=1, keepdims=True)


# ---------------------------------------------------------------- training


def pair_marginals(x: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Node marginals and summed pair marginals of equally long sequences."""
    n, t_max, k = x.shape
    alpha, beta = np.empty_like(x), np.empty_like(x)
    cur = np.full((n, k), 1.0 / k)
    for t in range(t_max):
        cur = (cur @ a) * x[:, t]
        cur /= cur.sum(axis=1, keepdims=True)
        alpha[:, t] = cur
    cur = np.ones((n, k))
    pairs = np.zeros((k, k))
    for t in range(t_max - 1, -1, -1):
        beta[:, t] = cur
        z = x[:, t] * cur
        if t:
            p = alpha[:, t - 1, :, None] * a * z[:, None, :]
            pairs += (p / p.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        cur = z @ a.T
        cur /= cur.sum(axis=1, keepdims=True)
    node = alpha * beta
    return node / node.sum(axis=2, keepdims=True), pairs


def fit(texts: list[str], labels: np.ndarray, k: int, lexicon: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights and transitions from whole texts with one label each.

    A sequence's start scores follow from the transitions (a step from a uniform
    label); a gradient step holds them as they are."""
    rng = np.random.default_rng(seed)
    parts = [(Words(c), y) for t, y in zip(texts, labels, strict=True) for c in slices(code_points(t))]
    parts = [(w, y) for w, y in parts if w.n]
    size = (1 << BITS) + len(lexicon)
    w, trans = np.zeros((size, k)), np.zeros((k, k))
    if not parts:
        return w, trans
    # all words one after the other, each with its gram positions
    g_first, g_count, grams, y, entry, root = [], [], [], [], [], []
    base = 0
    for p, lab in parts:
        total = len(p.grams[0])
        g_first.append(p.first + base)
        g_count.append(np.diff(np.append(p.first, total)))
        grams.append(np.stack(p.grams, axis=1))
        y.append(np.full(p.n, lab))
        entry.append(p.entry(lexicon) if len(lexicon) else np.full(p.n, -1))
        root.append(np.sqrt(p.length + 1.0))
        base += total
        p.grams = []  # held once
    g_first, g_count, grams, y, entry, root = map(np.concatenate, (g_first, g_count, grams, y, entry, root))
    # code-switched sequences: runs of neighbouring words, in random order, one after the other
    runs, at = [], 0
    for p, _ in parts:
        cuts = np.cumsum(rng.geometric(1.0 / RUN, p.n))
        cuts = np.concatenate(([0], cuts[cuts < p.n], [p.n])) + at
        runs += [np.arange(a, b) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
        at += p.n
    sq_w, sq_t = np.full((size, k), 1e-6), np.full((k, k), 1e-6)
    for _ in range(EPOCHS):
        stream = np.concatenate([runs[i] for i in rng.permutation(len(runs))])
        if len(stream) < SEQUENCE:
            stream = np.resize(stream, SEQUENCE)
        seqs = stream[:len(stream) // SEQUENCE * SEQUENCE].reshape(-1, SEQUENCE)
        for b in range(0, len(seqs), 64):
            words = seqs[b:b + 64]
            flat = words.ravel()
            count = g_count[flat]
            off = np.concatenate(([0], np.cumsum(count)[:-1]))
            gi = grams[np.repeat(g_first[flat] - off, count) + np.arange(int(count.sum()))]
            e = np.add.reduceat(w[gi].sum(axis=1), off, axis=0) / root[flat][:, None]
            lex = entry[flat]
            e += np.where((lex >= 0)[:, None], w[(1 << BITS) + np.maximum(lex, 0)] if len(lexicon) else 0.0, 0.0)
            e = e.reshape(words.shape + (k,))
            x, a = np.exp(e - e.max(axis=2, keepdims=True)), np.exp(trans)
            node, pairs = pair_marginals(x, a)
            want = np.eye(k)[y[words]]
            real = np.einsum("ntj,ntk->jk", want[:, :-1], want[:, 1:])
            grad = ((want - node) / len(words)).reshape(-1, k)
            per_gram = np.repeat(grad / root[flat][:, None], count, axis=0)
            gw = np.stack([np.bincount(gi.ravel(), np.repeat(per_gram[:, j], NGRAM), size) for j in range(k)], axis=1)
            if len(lexicon):
                here = lex >= 0
                np.add.at(gw, (1 << BITS) + lex[here], grad[here])
            gw -= 1e-5 * w
            sq_w += gw * gw
            w += 0.3 * gw / np.sqrt(sq_w)
            gt = (real - pairs) / len(words) - 1e-3 * trans
            sq_t += gt * gt
            trans += 0.1 * gt / np.sqrt(sq_t)
    return w, trans


class Model:
    """Labels, weights, transitions and lexicon; fixed size."""

    def __init__(self, labels: list[str], weights: np.ndarray, trans: np.ndarray, lexicon: np.ndarray):
        self.labels, self.weights, self.trans, self.lexicon = labels, weights.astype(np.float32), trans, lexicon

    def word_probabilities(self, text: str) -> np.ndarray:
        """Label probabilities of each word of the text (words, labels)."""
        parts = [Words(c) for c in slices(code_points(text))]
        e = [p.rows(self.weights, self.lexicon) for p in parts if p.n]
        if not e:
            return np.empty((0, len(self.labels)))
        e = np.concatenate(e).astype(float)
        return marginals(e, np.array([len(e)]), self.trans)

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        out: list[tuple[str, float]] = [("und", 0.0)] * len(texts)
        if not self.labels:
            return out
        group, held = [], 0

        def flush():
            if not group:
                return
            lengths = np.array([len(e) for _, e in group])
            p = marginals(np.concatenate([e for _, e in group]).astype(float), lengths, self.trans)
            mean = np.add.reduceat(p, np.concatenate(([0], np.cumsum(lengths)[:-1])), axis=0) / lengths[:, None]
            for (i, _), m in zip(group, mean, strict=True):
                j = int(m.argmax())
                out[i] = (self.labels[j], float(min(1.0, max(0.0, m[j]))))
            group.clear()

        short: list[tuple[int, np.ndarray]] = []

        def score(items):
            """State scores of many short texts at once: a border between texts keeps their words apart."""
            codes = np.concatenate([np.append(c, 0).astype(np.uint32) for _, c in items])
            ends = np.cumsum([len(c) + 1 for _, c in items])
            w = Words(codes)
            if not w.n:
                return
            e = w.rows(self.weights, self.lexicon)
            here = letters(codes)
            starts = np.flatnonzero(here & ~np.concatenate(([False], here[:-1])))
            cut = np.searchsorted(starts, ends)
            last = 0
            for (i, _), to in zip(items, cut.tolist(), strict=True):
                if to > last:
                    group.append((i, e[last:to]))
                last = to

        for i, t in enumerate(texts):
            if not t:
                continue
            c = code_points(t)
            if len(c) <= SLICE // 2:
                short.append((i, c))
                held += len(c)
            else:
                e = [w.rows(self.weights, self.lexicon) for w in map(Words, slices(c)) if w.n]
                if e:
                    group.append((i, np.concatenate(e)))
                    held += len(c)
            if held >= SLICE:
                if short:
                    score(short)
                    short.clear()
                flush()
                held = 0
        if short:
            score(short)
        flush()
        return out


def train(rows: DataFrame, per_language: int = PER_LANGUAGE, shards: int = SHARDS) -> Model:
    """Model learned from ``text, lang`` rows with non-null lang."""
    rows = rows.where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = rows.groupBy("lang").count().collect()  # one row per language
    if not sizes:
        return Model([], np.zeros((1, 1)), np.zeros((1, 1)), np.empty(0, np.uint64))
    labels = sorted(r["lang"] for r in sizes)
    rate = F.create_map(*[F.lit(x) for r in sizes for x in (r["lang"], min(1.0, per_language / r["count"]))])
    h = F.xxhash64(F.lit(9), "doc_id", "text")
    u = F.pmod(h, F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = (rows.where(u < rate[F.col("lang")])
              .select("text", "lang", F.pmod(F.xxhash64(F.lit(10), h), F.lit(shards)).alias("shard")))
    k = len(labels)

    def words(part: pd.DataFrame) -> pd.DataFrame:
        """The shard's most frequent word hashes by language."""
        out = []
        for lang, texts in part.groupby("lang")["text"]:
            hashes = [w.hash for t in texts for w in map(Words, slices(code_points(t))) if w.n]
            if hashes:
                value, count = np.unique(np.concatenate(hashes), return_counts=True)
                top = np.argsort(-count, kind="stable")[:LEXICON * 2]
                out += [(lang, int(v) - (1 << 63), int(c)) for v, c in zip(value[top].tolist(), count[top].tolist(), strict=True)]
        return pd.DataFrame(out, columns=["lang", "h", "n"])

    top = sample.groupBy("shard").applyInPandas(words, "lang string, h long, n long").toPandas()
    top = top.groupby(["lang", "h"], as_index=False)["n"].sum().sort_values(["lang", "n", "h"], ascending=[True, False, True])
    best = top.groupby("lang").head(LEXICON)["h"].tolist()
    lexicon = np.array(sorted({v + (1 << 63) for v in best}), np.uint64)

    def learn(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["lang", "text"])
        y = part["lang"].map({lang: j for j, lang in enumerate(labels)}).to_numpy()
        w, t = fit(part["text"].tolist(), y, k, lexicon, 3)
        give_back()
        return pd.DataFrame({"n": [len(part)], "m": [pickle.dumps((w.astype(np.float32), t))]})

    parts = sample.groupBy("shard").applyInPandas(learn, "n long, m binary").collect()  # `shards` models
    total = sum(p["n"] for p in parts)
    w, t = np.zeros(((1 << BITS) + len(lexicon), k)), np.zeros((k, k))
    for p in sorted(parts, key=lambda p: p["m"]):
        pw, pt = pickle.loads(p["m"])
        w += pw * (p["n"] / total)
        t += pt * (p["n"] / total)
    return Model(labels, w, t, lexicon)


def identify(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` plus ``lang_pred`` and ``lang_score``."""
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame(shared.value.predict(texts), columns=["lang", "score"])
            del texts
            give_back()

    base = set_aside(docs, "lang_pred", "lang_score")
    own, = fresh(base, "lid")
    d = base.withColumn(own, run(F.col(f"`{text_col}`")))
    return d.select(*[F.col(f"`{c}`") for c in base.columns], F.col(own)["lang"].alias("lang_pred"), F.col(own)["score"].alias("lang_score"))


def training_rows(docs: DataFrame) -> DataFrame:
    return docs.where(fold(F.col("doc_id"), 4) != 2).select("doc_id", "text", "lang")


def op10_language_id(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(training_rows(docs))
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", F.col("lang_score").alias("score"))
