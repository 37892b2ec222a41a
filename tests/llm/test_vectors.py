"""SimHash classes, hard negatives and whitening against brute force."""

import random
from fractions import Fraction

import duckdb
import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from gridcast.llm import exact_algebra, hard_negatives, simhash, whitening

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# ------------------------------------------------------------------- SimHash

def brute_print(text, k=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or ([" ".join(words)] if words else [])
    h = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_classes(prints, distance=3):
    """Least id per component of (id, fingerprint) rows; null ids last."""
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= distance:
                root[find(i)] = find(j)
    out = {}
    for i, (d, _) in enumerate(prints):
        if d is not None:
            out[find(i)] = min(d, out.get(find(i), d))
    return [out.get(find(i)) for i in range(len(prints))]


def brute_simhash(rows):
    prints = [(d, brute_print(t)) for d, t in rows]
    return sorted([(d, f"{p:016x}", c) for (d, p), c in zip(prints, brute_classes(prints), strict=True)], key=str)


def test_simhash_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert rows_of(simhash.op11_simhash(spark, SF)) == brute_simhash([tuple(r) for r in docs])


def test_simhash_edges(spark, edge_docs):
    rows = [tuple(r) for r in edge_docs.select("doc_id", "text").collect()]
    clash = edge_docs.withColumn("id", F.lit("x")).withColumn("fp", F.lit("x")).withColumn("text_", F.lit("x"))
    assert rows_of(simhash.simhash_components(clash)) == brute_simhash(rows)
    assert simhash.simhash_components(edge_docs.where("false")).collect() == []
    nulls = spark.createDataFrame([(None, "a b c d"), (None, "a b c d"), (None, "")], "doc_id long, text string")
    assert {r["component_id"] for r in simhash.simhash_components(nulls).collect()} == {None}


def test_long_text_is_hashed_in_pieces(monkeypatch):
    text = " ".join(random.Random(2).choice(["ab", "\tCde", "é", "x" * 40, "你好\n"]) for _ in range(3000))
    whole = simhash.fingerprint(text.encode())
    assert whole & (2 ** 64 - 1) == brute_print(text)
    for piece in (1, 7, 64, 1000):
        monkeypatch.setattr(simhash, "PIECE", piece)
        assert simhash.fingerprint(text.encode()) == whole


def planted_prints(rng, centres, near, far):
    out = set()
    for _ in range(centres):
        c = rng.getrandbits(64)
        out.add(c)
        for _ in range(near):
            x = c
            for b in rng.sample(range(64), rng.choice([1, 2, 3, 3, 4])):
                x ^= 1 << b
            out.add(x)
    shared = rng.getrandbits(20) << 44  # a subtree that holds a third of all
    out |= {shared | rng.getrandbits(44) for _ in range(far)} | {rng.getrandbits(64) for _ in range(2 * far)}
    return sorted(out)


@pytest.mark.parametrize("leaf", [4, 50, 1 << 15])
def test_trie_join_against_all_pairs(spark, leaf):
    prints = planted_prints(random.Random(leaf), 12, 8, 120)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    df = spark.createDataFrame([(p,) for p in signed], "fp long")
    edges = simhash.hamming_forest(df, 3, leaf).collect()
    a = np.array(prints, np.uint64)
    links = np.bitwise_count(a[:, None] ^ a[None, :]) <= 3
    place = {p: i for i, p in enumerate(signed)}
    root = np.arange(len(prints))
    for e in edges:
        root[root == root[place[e["a"]]]] = root[place[e["b"]]]
    want = np.arange(len(prints))
    for i, j in zip(*np.nonzero(links), strict=True):
        want[want == want[i]] = want[j]
    assert len(set(zip(root.tolist(), want.tolist(), strict=True))) == len(set(root.tolist())) == len(set(want.tolist()))


@pytest.mark.parametrize("same", [True, False])
def test_trie_links_are_all_pairs(same):
    rng = random.Random(9)
    keys = np.array(planted_prints(rng, 6, 10, 60), np.uint64)
    a = keys if same else keys[: len(keys) // 2]
    b = keys if same else keys[len(keys) // 2:]
    got = set()
    for i, j in simhash.trie_links(a, b, 0, 3, same):
        got |= set(zip(i.tolist(), j.tolist(), strict=True))
    d = np.bitwise_count(a[:, None] ^ b[None, :])
    high = np.bitwise_count((a[:, None] ^ b[None, :]) >> np.uint64(32))
    want = {(i, j) for i, j in zip(*np.nonzero((d <= 3) & (high <= 1)), strict=True) if not same or i < j}
    most = {(i, j) for i, j in zip(*np.nonzero(d <= 3), strict=True) if not same or i < j}
    assert want <= got <= most


# ------------------------------------------------------------ hard negatives

def brute_negatives(rows, k=5, m=10, low=30, high=90):
    """Rows (id, vector, label); anchors are ids divisible by 100."""
    rows = [(i, [int(np.floor(256 * np.float64(x))) for x in v], la) for i, v, la in rows
            if i is not None and la is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (a, va, la) in enumerate(rows):
        if a % 100:
            continue
        score = [(-sum(x * y for x, y in zip(va, v)), i, la == other, at) for at, (i, v, other) in enumerate(rows)]
        for sp, p, _, _ in sorted(s for s in score if s[2] and s[3] != n)[:k]:
            window = sorted(s[:2] for s in score if not s[2] and low * -sp <= 100 * -s[0] <= high * -sp)
            out += [(a, p, r, i, -sp, -s) for r, (s, i) in enumerate(window[:m], 1)]
    return sorted(out)


def test_hard_negatives_query_against_sql(spark):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{SF}/embeddings.parquet'")
    got = hard_negatives.op12_hard_negatives(spark, SF)
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert got.columns == cols
    assert sorted(map(tuple, got.collect())) == sorted(con.execute(f"select {', '.join(cols)} from ({hard_negatives.OP12_SQL})").fetchall())


@pytest.mark.parametrize("blocks", [(2, 7), (4096, 4096)])
def test_hard_negatives_against_brute_force(spark, blocks):
    rng = np.random.default_rng(5)
    centre = rng.normal(size=(4, 6))
    rows = [(i, (centre[i % 4] + rng.normal(size=6) * (0.1 if i % 3 else 1.5)).tolist(), i % 4) for i in range(0, 1500, 10)]
    rows += [(100, rows[10][1], 2), (100, rows[10][1], 2), (None, [1.0] * 6, 1), (7, None, 1), (8, [1.0, None], 1), (9, [float("nan")] * 6, 1),
             (11, [float("inf")] * 6, 1), (12, [1.0] * 6, None), (1600, [], 3), (1700, [0.5], 3), (1701, [0.5], 0), (1702, [0.25, 0.0], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("q", F.lit("clash")).withColumn(
        "at", F.lit("clash"))
    got = hard_negatives.hard_negatives(df, "vec_id", "embedding", "label", F.col("vec_id") % 100 == 0, anchor_block=blocks[0],
                                        row_block=blocks[1])
    assert sorted(map(tuple, got.collect())) == brute_negatives(rows)
    for none in ("false", "vec_id = 20"):
        assert hard_negatives.hard_negatives(df.where(none), "vec_id", "embedding", "label", F.col("vec_id") % 100 == 0).collect() == []


def test_hard_negatives_of_huge_values(spark):
    rows = [(0, [1e30, 1e5], 0), (1, [1e9, 1e9], 0), (2, [3e5, 5e5], 1), (3, [-1e300, 1.0], 1), (100, [6e5, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = hard_negatives.hard_negatives(df, "vec_id", "embedding", "label", F.col("vec_id") % 100 == 0).collect()
    clipped = [(i, [max(min(x, 2.0 ** 20), -2.0 ** 20) for x in v], la) for i, v, la in rows]
    assert sorted(map(tuple, got)) == brute_negatives(clipped) != []


def test_spanning_tree_is_minimal_and_light_first():
    rng = np.random.default_rng(1)
    v = np.round(rng.normal(size=(40, 3)) * 10)
    walk, parent, edge = hard_negatives.spanning_tree(v)
    place = {int(x): i for i, x in enumerate(walk)}
    assert sorted(place) == list(range(40)) and all(parent[x] < 0 or place[int(parent[x])] < place[x] for x in place)
    whole = np.vstack([v, np.zeros(3)])
    dist = np.sqrt(((whole[:, None] - whole[None]) ** 2).sum(-1))
    inside, total = {40}, 0.0
    while len(inside) < 41:
        d, x = min((dist[i, j], j) for i in inside for j in range(41) if j not in inside)
        inside.add(x)
        total += d
    assert edge.sum() == pytest.approx(total)


# ----------------------------------------------------------------- whitening

def check_whitening(rows, got, k=8):
    """``got`` against a decomposition in doubles of the exactly centred rows."""
    kept = [(i, v) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    width = max(len(v) for _, v in kept)
    x = np.array([[int(np.floor(1024 * np.float64(c))) + 100_000 for c in v] + [100_000] * (width - len(v)) for _, v in kept], object)
    n, s = len(x), x.sum(axis=0)
    z = n * x - s
    cov = ((z.T @ z).astype(float)) / float(n) ** 3
    e, vec = np.linalg.eigh(cov)
    e, vec = e[::-1], vec[:, ::-1]
    k = min(k, int((e > 1e-9 * e[0]).sum()))
    assert sorted(r["component"] for r in got) == sorted(list(range(1, k + 1)) * n)
    w = z.astype(float) / n @ vec[:, :k] / np.sqrt(e[:k])
    dev = (z * z).sum(axis=1)
    for c in range(1, k + 1):
        here = sorted((r for r in got if r["component"] == c), key=lambda r: (str(r["vec_id"]), r["whitened"]))
        explained, = {r["explained"] for r in here}
        assert explained == pytest.approx(e[c - 1] / e.sum(), rel=1e-6)
        assert sum(r["whitened"] ** 2 for r in here) == pytest.approx(n, rel=1e-9)
        assert sorted(int(r["deviation_exact"]) for r in here) == sorted(dev.tolist())
        assert [r["deviation"] for r in here] == [int(r["deviation_exact"]) if r["deviation_exact"] < 2 ** 63 else None for r in here]
        gap = min(abs(e[c - 1] - e[j]) for j in range(len(e)) if j != c - 1) / e[0] if len(e) > 1 else 1
        if gap > 1e-6:
            one = np.array([r["whitened"] for r in here])
            two = np.array([a for _, a in sorted(((str(i), a) for (i, _), a in zip(kept, w[:, c - 1], strict=True)))])
            two_neg = np.array([a for _, a in sorted(((str(i), -a) for (i, _), a in zip(kept, w[:, c - 1], strict=True)))])
            assert min(np.abs(one - two).max(), np.abs(one - two_neg).max()) < 1e-7
    assert {r["n"] for r in got} == {n} and len({r["identity_error"] for r in got}) == 1 and got[0]["identity_error"] < 1e-9


def test_whitening_query_against_eigh(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/embeddings.parquet").select("vec_id", "embedding").collect()]
    got = whitening.op13_whitening(spark, SF).collect()
    check_whitening(rows, got)
    assert {r["identity_error"] for r in got}.pop() < 1e-12


def test_whitening_edges(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=3).tolist()) for i in range(20)] + [(20, [0.5]), (21, []), (22, None), (23, [None, 1.0]),
            (24, [float("nan")]), (25, [float("inf"), 0.0]), (None, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0]), (1, [1.0, 2.0, 3.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("w", F.lit("x")).withColumn("n", F.lit("x"))
    check_whitening(rows, whitening.whiten(df, "vec_id", "embedding").collect())
    for few in ("false", "vec_id = 3", "vec_id = 21", "vec_id = 22"):
        assert whitening.whiten(df.where(few), "vec_id", "embedding").collect() == []
    equal = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(5)], "vec_id long, embedding array<float>")
    assert whitening.whiten(equal, "vec_id", "embedding").collect() == []
    big = [(0, [1e12, 0.0]), (1, [-1e9, 5.0]), (2, [3.0, 1e10])]
    got = whitening.whiten(spark.createDataFrame(big, "vec_id long, embedding array<double>"), "vec_id", "embedding").collect()
    clip = 2.0 ** 30
    check_whitening([(i, [max(min(x, clip), -clip) for x in v]) for i, v in big], got)


def test_whitening_of_equal_eigenvalues(spark):
    cube = [(i, [float(2 * (i >> b & 1) - 1) for b in range(3)] + [3.0 * (i >> 3 & 1)]) for i in range(16)]
    got = whitening.whiten(spark.createDataFrame(cube, "vec_id long, embedding array<double>"), "vec_id", "embedding").collect()
    check_whitening(cube, got)
    assert len(got) == 64


def test_characteristic_polynomial_and_roots(spark):
    rng = np.random.default_rng(8)
    for d, rank in ((1, 1), (2, 2), (6, 6), (7, 3), (5, 0)):
        b = rng.integers(-50, 50, (d, max(rank, 1))).astype(object) * (rank > 0)
        m = b @ b.T
        poly = whitening.characteristic_polynomial(spark, m)
        # Faddeev and LeVerrier, in fractions
        c, want, acc = Fraction(1), [Fraction(1)], np.zeros((d, d), object) + Fraction(0)
        for k in range(1, d + 1):
            acc = m @ acc + c * np.eye(d, dtype=int).astype(object)
            c = -sum((m @ acc)[i, i] for i in range(d)) / Fraction(k)
            want.append(c)
        assert poly == [int(x) for x in reversed(want)]
        found = [m / 2 ** t for m, t, n in exact_algebra.largest_roots(poly, d) for _ in range(n)] if rank else []
        eig = sorted(np.linalg.eigvalsh(m.astype(float)), reverse=True)[:rank]
        assert len(found) == rank and found == pytest.approx(eig, rel=1e-9)


def test_coefficients_obey_their_bound_and_primes_are_prime():
    rng = np.random.default_rng(4)
    b = rng.integers(-9, 9, (5, 9)).astype(object)
    m = b @ b.T
    assert all(abs(int(round(x))) <= exact_algebra.coefficient_bound(m) for x in np.poly(m.astype(float)))
    assert all(exact_algebra.is_prime(n) == all(n % q for q in range(2, int(n ** 0.5) + 1)) for n in range(3, 2000, 2))
    assert np.prod([int(p) for p in exact_algebra.primes_for(10 ** 30)], dtype=object) > 2 * 10 ** 30


def test_bounds_spare_most_scores(monkeypatch):
    """Anchors in tight clusters: a child's bounds leave few rows of far clusters to score, and the hits stay whole."""
    rng = np.random.default_rng(7)
    centre = rng.normal(size=(20, 16)) * 100
    q = np.floor(np.repeat(centre, 40, axis=0) + rng.normal(size=(800, 16))).astype(int)
    rows = hard_negatives.pd.DataFrame({"at": range(800), "id": range(800), "label": np.arange(800) % 2, "q": list(q)})
    anchors = hard_negatives._tree_rows(rows[rows["id"] % 4 == 0])
    scores = q[anchors["at"]] @ q.T
    anchors["windows"] = [[int(0.9 * s.max())] for s in scores]
    seen, score = [], hard_negatives._Walk.score
    monkeypatch.setattr(hard_negatives._Walk, "score", lambda w, i, at: (seen.append(len(at)), score(w, i, at))[1])
    got = hard_negatives._negatives(10, 30, 90)(anchors, rows)
    want = []
    for a, s, (p,) in zip(anchors["at"], scores, anchors["windows"], strict=True):
        hits = sorted((-int(s[j]), j) for j in range(800) if j % 2 != a % 2 and 30 * p <= 100 * s[j] <= 90 * p)[:10]
        want += [(a, p, j, -x) for x, j in hits]
    assert sorted(map(tuple, got.to_numpy().tolist())) == sorted(want)
    assert 0 < sum(seen) < 0.5 * 400 * len(anchors)
