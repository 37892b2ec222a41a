"""N-gram Jaccard join by MinHash banding, verified on the full n-gram sets.

Documents are linked if the Jaccard similarity of their sets of five-word
shingles (words: runs of ASCII letters and digits and of all characters above
ASCII, A-Z lower-cased; a shorter text is one shingle) is at least 0.8.

1. One pass over the texts gives every document the 128-bit hash of its set, the
   set's size and its band hashes. Band and row counts follow from the target
   recall at the threshold (:func:`band_shape`).
2. Documents with equal sets form a class; all that follows works on classes,
   so groups of copies cost one row.
3. Classes are shuffled on their band hashes. A bucket of up to ``TINY_BUCKET``
   members gives its pairs as rows. Members of larger buckets are dealt into
   blocks of about ``BLOCK`` classes by the largest bucket in reach of two steps
   over shared buckets; two blocks meet if some bucket has members in both. A task gets the full sets of two blocks and
   returns only their links' counts per class and a spanning forest, so a large
   group costs blocks, not pairs, and no bucket is ever cut.
4. Every candidate pair is verified on the full sets, once: a pair whose blocks
   meet is verified there, any other as a row. Links are joined to components
   by alternating stars.

Hot keys (a bucket, a class of copies, a component's root with very many rows) are
found by their counts and joined by broadcast; as hot means over a thousandth of
the rows, there are at most a thousand of them.

Result per document: ``class_id`` (least id of its component), ``n_links`` (the
number of other texts, copies counted once, that its text is linked to) and ``class_size`` (documents in the
component). Defined cases: texts without words have no shingles, link to
nothing and stand alone, with their own id as class; null ids count after all
others, a component of null ids has a null class; repeated rows are copies; an
empty table gives no rows; input columns of these names get underscores added.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import BROADCAST_ROWS, bound_batches, fresh, give_back, join_hot, table, written, written_with
from gridcast.llm.decontaminate import KEEP

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.999
MAX_HASHES = 96
TINY_BUCKET = 8
BLOCK = 256
BLOCK_GRAMS = 1 << 21  # shingles of a block, about: a task that gets two blocks holds 32 MB of hashes and a few copies of them
COLUMNS = 8192
CLIMBS = 2
STEP_BYTES = 1 << 19
_T = np.random.default_rng(42).integers(0, 1 << 63, (256, 64), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
M1, M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def band_shape(threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows per band for which the bands that reach
    ``recall`` at ``threshold`` need at most ``max_hashes`` hashes."""
    best = None
    for rows in range(1, max_hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-threshold ** rows))
        if bands * rows > max_hashes:
            break  # more rows need still more bands
        best = (bands, rows)
    if best is None:
        raise ValueError("max_hashes is too small for this recall")
    return best


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * M1
    x = (x ^ (x >> np.uint64(29))) * M2
    return x ^ (x >> np.uint64(32))


def shingle_hashes(texts: list[bytes], k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles and, for each, the number of its text."""
    joined = b" ".join(t.translate(KEEP) for t in texts) + b" "
    b = np.frombuffer(joined, np.uint8)
    inside = b != 32
    edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
    if inside[0]:
        edge = np.concatenate(([0], edge))
    first, end = edge[::2], edge[1::2]
    if not len(first):
        return np.empty(0, np.uint64), np.empty(0, np.int64)
    ends = np.cumsum([len(t) + 1 for t in texts])
    doc = np.searchsorted(ends, first, side="right")
    at = np.flatnonzero(inside)
    count = end - first
    offset = np.concatenate(([0], np.cumsum(count)[:-1]))
    place = np.arange(len(at)) - np.repeat(offset, count)
    with np.errstate(over="ignore"):
        h = np.add.reduceat(_T[b[at], place & 63] * (np.uint64(1) + (place >> 6).astype(np.uint64) * np.uint64(2)), offset)
        h = mix(h + count.astype(np.uint64))
        words = np.bincount(doc, minlength=len(texts))
        # a shingle starts at each word that has k - 1 more of its text behind it, or at the first word of a short text
        start = np.concatenate(([0], np.cumsum(words)[:-1]))
        nth = np.arange(len(h)) - start[doc]
        length = np.minimum(words[doc], k)
        i = np.flatnonzero(nth + length <= words[doc])
        i = i[(nth[i] == 0) | (words[doc[i]] >= k)]
        s = np.zeros(len(i), np.uint64)
        for j in range(k):
            ok = length[i] > j
            s = s * M2 + np.where(ok, h[np.minimum(i + j, len(h) - 1)], np.uint64(j + 1))
    return mix(s), doc[i]


def unique_sets(s: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.lexsort((s, doc))
    s, doc = s[order], doc[order]
    new = np.ones(len(s), bool)
    new[1:] = (s[1:] != s[:-1]) | (doc[1:] != doc[:-1])
    return s[new], doc[new]


def in_steps(texts: list[str | None]) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``STEP_BYTES``, with the number of the first."""
    run, held, at = [], 0, 0
    for i, t in enumerate(texts):
        run.append(t.encode("utf-8", "surrogatepass") if t else b"")
        held += len(run[-1])
        if held >= STEP_BYTES:
            yield at, run
            run, held, at = [], 0, i + 1
    if run:
        yield at, run


def signatures(texts: list[str | None], bands: int, rows: int, k: int = SHINGLE) -> pd.DataFrame:
    """Per text: ``c1, c2`` (hash of its set), ``n`` and ``bands``; n = 0
    without words."""
    n_all = len(texts)
    c1, c2, n = np.zeros(n_all, np.int64), np.zeros(n_all, np.int64), np.zeros(n_all, np.int32)
    keys: list = [[]] * n_all
    rng = np.random.default_rng(2024)
    mul = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    add = rng.integers(0, 1 << 63, bands * rows, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for base, run in in_steps(texts):
            s, doc = unique_sets(*shingle_hashes(run, k))
            if not len(s):
                continue
            here, first, count = np.unique(doc, return_index=True, return_counts=True)
            at = base + here
            n[at] = count
            c1[at] = np.add.reduceat(mix(s ^ M1), first).view(np.int64)
            c2[at] = np.add.reduceat(mix(s ^ M2), first).view(np.int64)
            out = np.empty((len(here), bands), np.uint64)
            for band in range(bands):
                h = np.full(len(here), np.uint64(band + 1))
                for r in range(band * rows, band * rows + rows):
                    h = mix(h * M1 + np.minimum.reduceat((s ^ add[r]) * mul[r], first))
                out[:, band] = h
            for i, x in zip(at.tolist(), out.view(np.int64), strict=True):
                keys[i] = x
    return pd.DataFrame({"c1": c1, "c2": c2, "n": n, "bands": keys})


def gram_sets(texts: list[str | None], k: int = SHINGLE) -> list[np.ndarray]:
    out: list[np.ndarray] = [np.empty(0, np.int64)] * len(texts)
    for base, run in in_steps(texts):
        s, doc = unique_sets(*shingle_hashes(run, k))
        cuts = np.searchsorted(doc, np.arange(len(run) + 1))
        for i in range(len(run)):
            out[base + i] = s[cuts[i]:cuts[i + 1]].view(np.int64)
    return out


def components(links: DataFrame) -> DataFrame:
    """``c, root`` of every node of the links ``a, b`` by alternating stars."""
    state = dict(n=F.count(F.lit(1)), x=F.bit_xor(F.xxhash64("u", "v")))
    e, last = written_with(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), **state)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("deg"))
        large, seen = written_with(join_hot(both, least, "u", "deg", 2 * last["n"]).where(F.col("v") > F.col("u"))
                                   .select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct(), **state)
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("deg"))
        small = (join_hot(large, least, "u", "deg", seen["n"])
                 .select(F.explode(F.when(F.col("v") == F.col("m"), F.array(F.struct("u", "v"))).otherwise(
                     F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v"))))).alias("x")).select("x.u", "x.v"))
        e, now = written_with(small.distinct(), **state)
        if now == last:
            break
        last = now
    roots = e.select(F.col("v").alias("c")).distinct()
    return e.select(F.col("u").alias("c"), F.col("v").alias("root")).unionByName(roots.withColumn("root", F.col("c")))


def _block_links(threshold: float):
    """Links between the classes of two blocks (or inside one): rows with ``n``
    count a class's links, rows without are the edges of a spanning forest."""
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["c1", "c2"], ignore_index=True)
        sizes = np.array([len(g) for g in rows["grams"]])
        ids, at = np.unique(np.concatenate(rows["grams"].to_list()), return_inverse=True)
        doc = np.repeat(np.arange(len(rows)), sizes)
        shared = np.bincount(at)[at] > 1  # a gram of one class adds to no intersection
        doc, at = doc[shared], at[shared]
        at = np.unique(at, return_inverse=True)[1]
        first = rows["first"].to_numpy()
        one = first.all()
        left = np.arange(len(rows)) if one else np.flatnonzero(first)
        right = left if one else np.flatnonzero(~first)
        common = np.zeros((len(left), len(right)), np.float32)
        order = np.argsort(at, kind="stable")
        doc, at = doc[order], at[order]
        for low in range(0, int(at[-1]) + 1 if len(at) else 0, COLUMNS):
            here = slice(*np.searchsorted(at, (low, low + COLUMNS)))
            m = np.zeros((len(rows), COLUMNS), np.float32)
            m[doc[here], at[here] - low] = 1
            common += m[left] @ m[right].T
        linked = common >= threshold * (sizes[left][:, None] + sizes[right][None, :] - common) - 1e-4
        if one:
            linked = np.triu(linked, 1)
        i, j = np.nonzero(linked)
        i, j = left[i], right[j]
        count = np.bincount(np.concatenate((i, j)), minlength=len(rows))
        root = list(range(len(rows)))

        def find(x):
            while root[x] != x:
                root[x] = root[root[x]]
                x = root[x]
            return x

        forest = []
        for x, y in zip(i.tolist(), j.tolist(), strict=True):
            p, q = find(x), find(y)
            if p != q:
                root[max(p, q)] = min(p, q)
                forest.append((x, y))
        c1, c2 = rows["c1"].to_numpy(), rows["c2"].to_numpy()
        f = np.array(forest, np.int64).reshape(-1, 2)
        has = np.flatnonzero(count)
        out = pd.DataFrame({"c1": np.concatenate((c1[has], c1[f[:, 0]])), "c2": np.concatenate((c2[has], c2[f[:, 0]])),
                            "d1": np.concatenate((c1[has], c1[f[:, 1]])), "d2": np.concatenate((c2[has], c2[f[:, 1]]))})
        out["n"] = pd.array([*count[has].tolist(), *[None] * len(f)], dtype="Int64")
        return out

    return run


class NearDuplicates:
    """The steps of the join over one table of documents."""

    def __init__(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                 threshold: float = THRESHOLD, recall: float = RECALL, max_hashes: int = MAX_HASHES):
        self.shingle, self.threshold = shingle, threshold
        self.bands, self.rows = band_shape(threshold, recall, max_hashes)
        bound_batches(docs.sparkSession)
        self.text = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"),
                                F.xxhash64(F.col(f"`{text_col}`")).alias("th"))
        bands, rows = self.bands, self.rows

        @F.pandas_udf("c1 long, c2 long, n int, bands array<long>")
        def sign(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            for texts in batches:
                yield signatures(texts, bands, rows, shingle)
                del texts
                give_back()

        s = self.text.withColumn("s", sign("text"))
        s = s.select("id", "th", F.struct("s.c1", "s.c2").alias("c"), F.col("s.n").alias("n"), F.col("s.bands").alias("bands"))
        self.signed, seen = written_with(s, n=F.count(F.lit(1)))  # no text
        self.total = seen["n"]
        # classes of equal sets; the copy with the least id stands for the class
        first = F.min(F.struct(F.col("id").isNull().alias("null"), "id", "th"))
        self.classes, seen = written_with(self.signed.where("n > 0").groupBy("c").agg(
            first.alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("bands").alias("bands")),
            most=F.max("copies"))
        self.most_copies = seen["most"]

    def sets(self, need: DataFrame, few: bool) -> DataFrame:
        """``need`` (``c`` and more columns, one row per class) plus the class's
        full set ``grams``. The texts are found by the id and hash of the class's
        first copy; ``few``: ``need`` was counted and may be broadcast."""
        small = F.broadcast if few else (lambda df: df)
        wanted = small(need).join(self.classes.select("c", F.col("rep.id").alias("r_id"), F.col("rep.th").alias("r_th")), "c")
        k = self.shingle

        @F.pandas_udf("array<long>")
        def grams(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for texts in batches:
                yield pd.Series(gram_sets(texts, k), dtype=object)
                del texts
                give_back()

        found = self.text.join(small(wanted), F.col("id").eqNullSafe(F.col("r_id")) & (F.col("th") == F.col("r_th")))
        return found.select(*need.columns, grams("text").alias("grams")).dropDuplicates(["c"])

    def verify(self, pairs: DataFrame) -> DataFrame:
        """The pairs ``a, b, na, nb`` (each once) whose similarity reaches the threshold."""
        pairs, seen = written_with(pairs, n=F.count(F.lit(1)))
        if not seen["n"]:
            return pairs.select("a", "b")
        need, used = written_with(pairs.select(F.explode(F.array("a", "b")).alias("c")).groupBy("c").agg(
            F.count(F.lit(1)).alias("uses")), n=F.count(F.lit(1)), most=F.max("uses"))
        sets = written(self.sets(need, used["n"] <= BROADCAST_ROWS))
        one = sets.select(F.col("c").alias("b"), F.col("grams").alias("gb"), F.col("uses").alias("ub"))
        two = sets.select(F.col("c").alias("a"), F.col("grams").alias("ga"), F.col("uses").alias("ua"))
        full = join_hot(join_hot(pairs, one, "b", "ub", seen["n"], most=used["most"]), two, "a", "ua", seen["n"], most=used["most"])
        common = F.size(F.array_intersect("ga", "gb"))
        return full.where(common >= F.lit(self.threshold) * (F.col("na") + F.col("nb") - common) - 1e-9).select("a", "b")

    def links(self) -> tuple[DataFrame, DataFrame]:
        """Links ``a, b`` that join the components, and ``c, n_links``."""
        held = dict(n=F.sum("members"), most=F.max("members"))
        members = self.classes.select(F.explode("bands").alias("bucket"), "c", "n")
        heads, got = written_with(members.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1"), **held)
        m = written(join_hot(members, heads, "bucket", "members", got["n"], most=got["most"]))

        # blocks of the members of large buckets, and which blocks meet
        large = m.where(F.col("members") > TINY_BUCKET)
        home = large.groupBy("c").agg(F.max(F.struct("members", "bucket")).alias("home"), F.first("n").alias("n"))
        for _ in range(CLIMBS):  # towards the largest bucket nearby, so that a group's members share few homes
            tops = large.join(home.drop("n"), "c").groupBy("bucket").agg(F.max("home").alias("home"), F.max("members").alias("w"))
            home = (join_hot(large.select("bucket", "c", "n"), tops, "bucket", "w", got["n"], most=got["most"])
                    .groupBy("c").agg(F.max("home").alias("home"), F.first("n").alias("n")))
        home, placed = written_with(home.select("c", "n", F.col("home.bucket").alias("home")), n=F.count(F.lit(1)))
        size, big = written_with(home.groupBy("home").agg(F.count(F.lit(1)).alias("w"), F.sum("n").alias("grams")), most=F.max("w"))
        blocks = F.ceil(F.greatest(F.col("w") / F.lit(BLOCK), F.col("grams") / F.lit(BLOCK_GRAMS))).cast("long")
        place = written(join_hot(home, size, "home", "w", placed["n"], most=big["most"]).select("c", F.struct("home", F.pmod(
            F.xxhash64("c"), blocks).alias("k")).alias("block")))
        held_by = large.select("bucket", "c").join(place, "c").select("bucket", "block").distinct()
        meet = written(held_by.join(held_by.withColumnRenamed("block", "block2"), "bucket")
                       .where(F.col("block") <= F.col("block2")).select("block", "block2").distinct())

        # pairs of tiny buckets, but for those whose blocks meet
        after = Window.partitionBy("bucket").orderBy("c").rowsBetween(1, TINY_BUCKET - 1)
        near = F.least("na", "nb") >= F.ceil(F.greatest("na", "nb") * F.lit(self.threshold - 1e-9))
        pairs = (m.where(F.col("members") <= TINY_BUCKET)
                 .select("c", "n", F.collect_list(F.struct("c", "n")).over(after).alias("later"))
                 .select("c", "n", F.explode("later").alias("d"))
                 .select(F.col("c").alias("a"), F.col("d.c").alias("b"), F.col("n").alias("na"), F.col("d.n").alias("nb"))
                 .where(near).distinct())
        if placed["n"]:
            side = lambda c, x: place.select(F.col("c").alias(c), F.col("block").alias(x))
            pairs = pairs.join(side("a", "x"), "a", "left").join(side("b", "y"), "b", "left")
            pairs = (pairs.withColumns({"block": F.least("x", "y"), "block2": F.greatest("x", "y")})
                     .withColumn("both", F.col("x").isNotNull() & F.col("y").isNotNull()))
            pairs = pairs.where("not both").unionByName(pairs.where("both").join(meet, ["block", "block2"], "left_anti"))
        links = written(self.verify(pairs.select("a", "b", "na", "nb")))
        degree = links.select(F.explode(F.array("a", "b")).alias("c")).groupBy("c").agg(F.count(F.lit(1)).alias("n_links"))
        if not placed["n"]:
            return links, degree

        # the blocks' sets, two blocks to a group
        met = meet.select(F.struct("block", "block2").alias("pair"), F.explode(F.array_distinct(F.array("block", "block2"))).alias("block"))
        sets = written(self.sets(place, placed["n"] <= BROADCAST_ROWS))
        found = written(sets.join(met, "block").select("pair", F.col("c.c1").alias("c1"), F.col("c.c2").alias("c2"),
                                                       (F.col("block") == F.col("pair.block")).alias("first"), "grams")
                        .groupBy("pair").applyInPandas(_block_links(self.threshold), "c1 long, c2 long, d1 long, d2 long, n long"))
        this, that = F.struct("c1", "c2"), F.struct(F.col("d1").alias("c1"), F.col("d2").alias("c2"))
        links = links.unionByName(found.where("n is null").select(F.greatest(this, that).alias("a"), F.least(this, that).alias("b")))
        degree = (degree.unionByName(found.where("n is not null").select(this.alias("c"), F.col("n").alias("n_links")))
                  .groupBy("c").agg(F.sum("n_links").alias("n_links")))
        return written(links.distinct()), degree

    def judged(self) -> DataFrame:
        """``id, th, n, rep`` (least copy of the component), ``n_links``,
        ``class_size``, one row per document."""
        links, degree = self.links()
        comps = components(links)
        cl = self.classes.select("c", "rep", "copies")
        linked = written(comps.join(cl, "c").join(degree, "c"))
        whole, got = written_with(linked.groupBy("root").agg(F.min("rep").alias("best"), F.sum("copies").alias("class_size"),
                                                             F.count(F.lit(1)).alias("texts")), most=F.max("texts"))
        linked = join_hot(linked.select("c", "root", "n_links"), whole, "root", "texts", self.total, most=got["most"])
        cl = cl.join(linked.select("c", "best", "n_links", "class_size"), "c", "left").select(
            "c", "copies", F.coalesce("best", "rep").alias("best"),
            F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("class_size", "copies").alias("class_size"))
        d = join_hot(self.signed.where("n > 0").select("id", "th", "n", "c"), cl, "c", "copies", self.total, most=self.most_copies)
        alone = self.signed.where("n = 0").select("id", "th", "n", F.struct(F.col("id").isNull().alias("null"), "id", "th").alias("best"),
                                                  F.lit(0).cast("long").alias("n_links"), F.lit(1).cast("long").alias("class_size"))
        return d.select(*alone.columns).unionByName(alone)


def ngram_jaccard_join(docs: DataFrame, **kw) -> DataFrame:
    """``doc_id, class_id, n_links, class_size``, one row per document."""
    return NearDuplicates(docs, **kw).judged().select(F.col("id").alias("doc_id"), F.col("best.id").alias("class_id"),
                                                      "n_links", "class_size")


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **kw) -> DataFrame:
    """The columns of ``docs``, one document of each component: the one with
    the least id. Documents without words all stay."""
    j = written(NearDuplicates(docs, id_col, text_col, **kw).judged().where("n > 0"))
    key = ["id", "th"]
    gone = j.where(~(F.col("best.id").eqNullSafe(F.col("id")) & (F.col("best.th") == F.col("th")))).select(*key).distinct()
    twice = (j.where(F.col("best.id").eqNullSafe(F.col("id")) & (F.col("best.th") == F.col("th")))
             .groupBy(*key).count().where("count > 1").select(*key))
    gone, twice = written(gone), written(twice)
    small = lambda df: F.broadcast(df) if df.count() <= BROADCAST_ROWS else df
    th, = fresh(docs, "th")
    d = docs.withColumn(th, F.xxhash64(F.col(f"`{text_col}`")))
    g = gone.withColumnsRenamed({"id": "_g_id", "th": "_g_th"})
    on = F.col(f"`{id_col}`").eqNullSafe(F.col("_g_id")) & (F.col(th) == F.col("_g_th"))
    d = d.join(small(g), on, "left_anti")
    if not twice.isEmpty():
        t = small(twice.withColumnsRenamed({"id": "_g_id", "th": "_g_th"}))
        d = d.join(t, on, "left_anti").unionByName(d.join(t, on, "left_semi").dropDuplicates([id_col, th]))
    return d.select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents").select("doc_id", "text"))
