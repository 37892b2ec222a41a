"""The learned operators against plain loops: features, FTRL updates, the CRF's expectations
and gradient, and the registered queries over a whole small table. The columns of op4 too."""

import itertools
import math
import zlib

import duckdb
import numpy as np
import pytest

from gridcast.llm import langid, quality, sharding

SMALL = "/root/testdata/sf0.001"
M64 = (1 << 64) - 1


def rows_of(name, columns):
    return duckdb.sql(f"select {columns} from '{SMALL}/{name}.parquet'").fetchall()


# ------------------------------------------------------------------ quality


def plain_features(text, bits):
    """Word 1- and 2-grams and shape 1- to 3-grams as dictionaries, hashed with Python integers."""
    a, b, mask = int(quality.A), int(quality.B), (1 << bits) - 1

    def mix(x):
        x = ((x ^ (x >> 29)) * b) & M64
        return x ^ (x >> 32)

    tokens = quality.TOKEN.findall(text or "")
    h = [zlib.crc32(t.lower().encode()) for t in tokens]
    shapes, pairs = [], set()
    for i, t in enumerate(tokens):
        if t[0].isalnum():
            s = 0 if t.islower() else 2 if t.isupper() and len(t) > 1 else 3 if t.isdigit() else 1
        else:
            s = 8 + (h[i] & 0xFFFF)
        mark = 0
        if i:
            mark = int(h[i] == h[i - 1]) + 2 * int((h[i - 1], h[i]) in pairs)
            pairs.add((h[i - 1], h[i]))
        shapes.append(s * 4 + mark + 1)
    words = [mix(x * a & M64) for x in h] + [mix((x * a + y) & M64) for x, y in zip(h, h[1:])]
    forms = [mix((x * b + 11) & M64) for x in shapes]
    forms += [mix(((x * a + y) * b + 12) & M64) for x, y in zip(shapes, shapes[1:])]
    forms += [mix((((x * a + y) * a + z) * b + 13) & M64) for x, y, z in zip(shapes, shapes[1:], shapes[2:])]
    out = []
    for family in (words, forms):
        count = {}
        for g in family:
            count[g & mask] = count.get(g & mask, 0) + 1
        out += [(p, math.sqrt(n / len(family))) for p, n in sorted(count.items())]
    return out


@pytest.mark.parametrize("text", [None, "", " \n", "one", "One TWO two two 3 !! __ two two", "a b a b a b a b, c. c. c.", "é À 你好 x1 !?!"])
def test_features_equal_a_plain_count(text):
    place, value = quality.features(text, quality.TokenCodes(), 12)
    want = plain_features(text, 12)
    assert place.tolist() == [p for p, _ in want] and np.allclose(value, [v for _, v in want], atol=1e-7)


def test_features_of_a_table():
    codes = quality.TokenCodes()
    for _, text in rows_of("documents", "doc_id, text")[::5]:
        place, value = quality.features(text, codes)
        want = plain_features(text, quality.BITS)
        assert place.tolist() == [p for p, _ in want] and np.allclose(value, [v for _, v in want], atol=1e-6)


def test_ftrl_equals_a_plain_loop():
    rng, bits = np.random.default_rng(4), 5
    examples = []
    for _ in range(30):
        place = np.sort(rng.choice(1 << bits, 6, replace=False))
        examples.append((np.append(place, 1 << bits), np.append(rng.random(6), 1.0), int(rng.integers(0, 2))))
    alpha, beta, l1, l2 = 2.0, 1.0, 1e-3, 1e-3
    z, n = {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        return 0.0 if abs(zi) <= l1 else -(zi - math.copysign(l1, zi)) / ((beta + math.sqrt(n.get(i, 0.0))) / alpha + l2)

    order = np.random.default_rng(1)
    for _ in range(16):
        for k in order.permutation(len(examples)):
            place, value, y = examples[k]
            p = 1 / (1 + math.exp(-sum(weight(i) * v for i, v in zip(place, value))))
            for i, v in zip(place, value):
                g, w, old = (p - y) * v, weight(i), n.get(i, 0.0)
                z[i] = z.get(i, 0.0) + g - (math.sqrt(old + g * g) - math.sqrt(old)) / alpha * w
                n[i] = old + g * g
    got = quality.ftrl(examples, bits)
    assert np.allclose(got, [weight(i) for i in range((1 << bits) + 1)], atol=1e-6) and (got != 0).sum() > 10


def test_quality_query_equals_a_plain_run(spark):
    """The query's scores from labels dealt and documents scored in plain Python."""
    docs, bias, codes = dict(rows_of("documents", "doc_id, text")), 1 << quality.BITS, quality.TokenCodes()
    known = sorted((d, q) for d, q in rows_of("labels", "doc_id, quality") if zlib.crc32(str(d).encode()) % 5 and q is not None)
    parts = lambda t: [(*quality.features(t, codes),)][0]
    data = [(np.append(p, bias), np.append(v, np.float32(1)), q) for d, q in known for p, v in [parts(docs[d])]]
    w = quality.ftrl(data).astype(float)
    got = {r["doc_id"]: r for r in quality.op1_quality_classifier(spark, SMALL).collect()}
    assert got.keys() == docs.keys()
    for d, text in docs.items():
        want = 1 / (1 + math.exp(-(sum(w[p] * v for p, v in plain_features(text, quality.BITS)) + w[bias])))
        assert abs(got[d]["score"] - want) < 1e-5
        assert got[d]["held_out"] == (zlib.crc32(str(d).encode()) % 5 == 0)
        assert got[d]["predicted"] == int(got[d]["score"] >= 0.3)


# ---------------------------------------------------------------- languages


def enumerate_crf(x, a, start):
    """log Z, node and pair expectations over all label sequences."""
    t_max, k = x.shape
    z, node, pairs = 0.0, np.zeros((t_max, k)), np.zeros((k, k))
    for y in itertools.product(range(k), repeat=t_max):
        p = start[y[0]] * math.prod(x[t, y[t]] for t in range(t_max)) * math.prod(a[i, j] for i, j in zip(y, y[1:]))
        z += p
        for t in range(t_max):
            node[t, y[t]] += p
        for i, j in zip(y, y[1:]):
            pairs[i, j] += p
    return math.log(z), node / z, pairs / z


@pytest.mark.parametrize("t_max", [1, 2, 5])
def test_training_expectations_equal_enumeration(t_max):
    rng = np.random.default_rng(t_max)
    x, a = np.exp(rng.normal(size=(4, t_max, 3))), np.exp(rng.normal(size=(3, 3)))
    node, pairs = langid.pair_marginals(x, a)
    plain = [enumerate_crf(s, a, a.sum(axis=0) / 3) for s in x]
    assert np.allclose(node, [n for _, n, _ in plain]) and np.allclose(pairs, sum(p for _, _, p in plain))


def test_gradient_equals_finite_differences():
    """Of the log-likelihood in the words' scores and the transitions, the start scores held as they are."""
    rng, k, eps = np.random.default_rng(0), 3, 1e-6
    e, trans, y = rng.normal(size=(5, k)), rng.normal(size=(k, k)), [0, 2, 2, 1, 0]
    start = np.exp(trans).sum(axis=0) / k

    def likelihood(e, trans):
        gold = math.log(start[y[0]]) + sum(e[t, y[t]] for t in range(5)) + sum(trans[i, j] for i, j in zip(y, y[1:]))
        return gold - enumerate_crf(np.exp(e), np.exp(trans), start)[0]

    node, pairs = langid.pair_marginals(np.exp(e)[None], np.exp(trans))
    real = np.zeros((k, k))
    for i, j in zip(y, y[1:]):
        real[i, j] += 1
    for got, base, which in ((np.eye(k)[y] - node[0], e, 0), (real - pairs, trans, 1)):
        for at in np.ndindex(base.shape):
            step = np.zeros_like(base)
            step[at] = eps
            up, down = [(e + s, trans) if which == 0 else (e, trans + s) for s in (step, -step)]
            assert abs((likelihood(*up) - likelihood(*down)) / (2 * eps) - got[at]) < 1e-6


def test_a_word_has_the_same_grams_wherever_it_stands():
    alone = langid.Words(langid.code_points("abcdef"))
    behind = langid.Words(langid.code_points("x 1, abcdef"))
    assert all(np.array_equal(a, b[-7:]) for a, b in zip(alone.grams, behind.grams)) and alone.hash[0] == behind.hash[1]


def test_predictions_do_not_depend_on_the_batch():
    rng = np.random.default_rng(2)
    lexicon = np.unique(langid.Words(langid.code_points("the der le of und")).hash)
    model = langid.Model(["a", "b", "c"], rng.normal(size=((1 << langid.BITS) + len(lexicon), 3)), rng.normal(size=(3, 3)), lexicon)
    texts = [t for _, t in rows_of("documents", "doc_id, text")] + [None, "", "x", "12", "der the x"]
    alone = [model.predict([t])[0] for t in texts]
    for batch in (model.predict(texts), model.predict(texts[::-1])[::-1]):
        assert [a for a, _ in batch] == [a for a, _ in alone]
        assert np.allclose([b for _, b in batch], [b for _, b in alone], atol=1e-6)


def test_language_query_equals_a_plain_run(spark):
    """Predictions of the query from its model's word scores by a plain forward-backward."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = langid.train(langid.training_rows(docs))
    got = {r["doc_id"]: r for r in langid.op10_language_id(spark, SMALL).collect()}
    a, k = np.exp(model.trans), len(model.labels)
    rows = rows_of("documents", "doc_id, text")
    assert got.keys() == {d for d, _ in rows}
    for d, text in rows:
        r = got[d]
        assert r["held_out"] == (zlib.crc32(str(d).encode()) % 4 == 2)
        words = langid.Words(langid.code_points(text or ""))
        if not words.n:
            assert (r["lang_pred"], r["score"]) == ("und", 0.0)
            continue
        x = np.exp(words.rows(model.weights, model.lexicon).astype(float))
        f, cur = [], np.full(k, 1 / k)
        for s in x:
            cur = (cur @ a) * s
            cur = cur / cur.sum()
            f.append(cur)
        total, cur = np.zeros(k), np.ones(k)
        for t in range(len(x) - 1, -1, -1):
            p = f[t] * cur
            total += p / p.sum()
            cur = a @ (x[t] * cur)
            cur = cur / cur.sum()
        mean = total / len(x)
        assert r["lang_pred"] == model.labels[int(mean.argmax())] and abs(r["score"] - mean.max()) < 1e-5


# ----------------------------------------------------------------- sharding


def test_sharding_query_columns(spark):
    got = sharding.op4_sharding(spark, SMALL).collect()
    texts = dict(rows_of("documents", "doc_id, text"))
    assert sorted(r["doc_id"] for r in got) == sorted(texts)
    slots = {}
    for r in got:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(data) + 16, zlib.crc32(data), "rows", None)
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) == set(range(40)) and all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
