"""Hard-negative mining with anchor spanning-tree score bounds.

For every anchor row, the positives are the ``positives`` rows of its label that
score highest, itself left out; for each positive, the hard negatives are the first ``negatives``
rows of other labels whose score lies in the window from ``low`` to ``high`` per
cent of the positive's score. Scores are integer inner products of the vectors
``floor(scale * x)``; higher scores come first, ties by smaller id.

Anchors are dealt into blocks, each with a minimum spanning tree over its
anchors and the origin (Euclidean edges, rooted at the origin, where every score
is 0). Rows are dealt into blocks too, and a task gets one block of each: a
stated set of queries against all rows, in blocks. It walks the tree from the root.
By Cauchy-Schwarz a row's score at a child anchor is its score at the
parent, known exactly or as an interval, plus or minus edge length times the
row's norm. Only rows whose interval overlaps the anchor's window are scored, and
their exact scores are the tighter start for the anchor's children. The children with the
largest subtree come last, so at most log2(block) anchors' intervals are held at a time.
A first pass finds the positives (window: from the least of the best scores so far),
a second one the negatives. Tasks return at most ``positives`` rows per anchor and
``negatives`` rows per anchor and positive's score; the final ranks are taken over these.

Defined cases: rows with a null id or label, a null vector or a vector with a null or non-finite
component take no part; shorter vectors are padded with zeros, an empty vector is the zero vector; components
beyond 2^28 in size after scaling count as 2^28 (so that scores of up to 64 such dimensions fit a long; beyond, they
count as its end); repeated rows are rows of their own (a copy of an anchor is a positive of it
and an anchor itself); ties of equal ids are exchangeable; an empty table, or one without
anchors, gives no rows; input columns of any further name are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import finite_vector, table, written, written_with

POSITIVES, NEGATIVES = 5, 10
LOW, HIGH = 30, 90  # per cent of the positive's score
SCALE = 256
LARGEST = 1 << 28
ANCHOR_BLOCK = 4096
ROW_BLOCK = 4096
FIRST = 64  # rows scored before the rest of the rows of the label is compared with their best


def _matrix(vectors, width: int) -> np.ndarray:
    """Integer vectors, padded with zeros, as one matrix."""
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def spanning_tree(v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Minimum spanning tree of the rows of ``v`` and the origin: the rows in
    walking order (parents first, largest subtree last), each row's parent (-1: the
    origin) and the length of the edge to it."""
    n = len(v)
    near, parent, out = np.sqrt((v * v).sum(axis=1)), np.full(n, -1), np.ones(n, bool)
    joined = []
    for _ in range(n):
        x = int(np.argmin(np.where(out, near, np.inf)))
        out[x] = False
        joined.append(x)
        d = np.sqrt(((v - v[x]) ** 2).sum(axis=1))
        closer = out & (d < near)
        near[closer], parent[closer] = d[closer], x
    weight = np.ones(n, np.int64)
    for x in reversed(joined):
        if parent[x] >= 0:
            weight[parent[x]] += weight[x]
    children: dict[int, list[int]] = {}
    for x in joined:
        children.setdefault(int(parent[x]), []).append(x)
    walk, todo = [], [-1]
    while todo:
        x = todo.pop()
        if x >= 0:
            walk.append(x)
        todo += sorted(children.get(x, ()), key=lambda c: -weight[c])  # the last one is taken next
    return np.array(walk, np.int64), parent, near


def _tree_rows(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("at", ignore_index=True)
    walk, parent, edge = spanning_tree(_matrix(rows["q"], max(map(len, rows["q"]))).astype(np.float64))
    place = np.empty(len(rows), np.int64)
    place[walk] = np.arange(len(rows))
    up = np.where(parent < 0, -1, place[parent])
    return rows.assign(place=place, parent=up, edge=edge)


class _Walk:
    """One anchor block against one block of rows: intervals along the tree."""

    def __init__(self, anchors: pd.DataFrame, rows: pd.DataFrame):
        width = max(1, max(map(len, anchors["q"])), max(map(len, rows["q"])))
        self.a, self.c = _matrix(anchors["q"], width), _matrix(rows["q"], width)
        af, cf = self.a.astype(np.float64), self.c.astype(np.float64)
        big = float(np.abs(af).max()) * float(np.abs(cf).max()) * width
        # up to 2^45, scores and their hundredfold are exact in floats; beyond, Python's own integers
        self.a, self.c = (af, cf) if big < 2 ** 45 else (self.a.astype(object), self.c.astype(object))
        self.norm = np.sqrt((cf * cf).sum(axis=1))
        self.slack = 1e-9 * np.sqrt((af * af).sum(axis=1)).max()
        self.parent, self.edge = anchors["parent"].to_numpy(), anchors["edge"].to_numpy()
        self.left = np.bincount(self.parent[self.parent >= 0], minlength=len(anchors))
        self.held: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def interval(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Bounds of all rows' scores at anchor ``i``, from its parent's."""
        p = self.parent[i]
        lo, hi = self.held[p] if p >= 0 else (0.0, 0.0)
        wide = (self.edge[i] * (1 + 1e-9) + self.slack) * self.norm + 1e-6
        if p >= 0:
            self.left[p] -= 1
            if not self.left[p]:
                del self.held[p]
        return lo - wide, hi + wide

    def score(self, i: int, at: np.ndarray) -> np.ndarray:
        return self.c[at] @ self.a[i]

    def keep(self, i: int, lo: np.ndarray, hi: np.ndarray, at: np.ndarray, score: np.ndarray) -> None:
        """Exact scores in place of bounds, for the children of anchor ``i``."""
        if self.left[i]:
            lo[at] = hi[at] = score.astype(np.float64)
            self.held[i] = lo, hi


def _frame(parts: list[tuple], names: list[str]) -> pd.DataFrame:
    whole = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [[]] * len(names)
    out = pd.DataFrame(dict(zip(names, whole, strict=True)))
    return out.astype("int64")


def _as_long(score: np.ndarray) -> np.ndarray:
    if score.dtype == object:
        return np.array([min(max(int(s), -(1 << 63)), (1 << 63) - 1) for s in score], np.int64)
    return score.astype(np.int64)


def _ranked(score: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Places by falling score, ties by id."""
    if score.dtype == object:
        return np.array(sorted(range(len(score)), key=lambda j: (-score[j], ids[j])), np.int64)
    return np.lexsort((ids, -score))


def _positives(k: int):
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(anchors) and len(rows):
            anchors = anchors.sort_values("place", ignore_index=True)
            w = _Walk(anchors, rows)
            label, at, ids = rows["label"].to_numpy(), rows["at"].to_numpy(), rows["id"].to_numpy()
            for i, (key, mine) in enumerate(zip(anchors["at"].to_numpy(), anchors["label"].to_numpy(), strict=True)):
                lo, hi = w.interval(i)
                here = np.flatnonzero((label == mine) & (at != key))
                if len(here) > max(FIRST, k):
                    first = here[np.argpartition(-hi[here], max(FIRST, k))[:max(FIRST, k)]]
                    least = np.sort(w.score(i, first))[-k]
                    here = here[hi[here] >= float(least)]
                s = w.score(i, here)
                w.keep(i, lo, hi, here, s)
                best = _ranked(s, ids[here])[:k]
                parts.append((np.full(len(best), key), ids[here][best], _as_long(s[best])))
        return _frame(parts, ["anchor_at", "positive_id", "positive_score"])

    return run


def _negatives(k: int, low: int, high: int):
    def run(anchors: pd.DataFrame, rows: pd.DataFrame) -> pd.DataFrame:
        parts = []
        if len(anchors) and len(rows):
            anchors = anchors.sort_values("place", ignore_index=True)
            w = _Walk(anchors, rows)
            label, ids = rows["label"].to_numpy(), rows["id"].to_numpy()
            for i, (key, mine, windows) in enumerate(zip(anchors["at"].to_numpy(), anchors["label"].to_numpy(), anchors["windows"],
                                                         strict=True)):
                lo, hi = w.interval(i)
                windows = [int(x) for x in windows]
                need = np.zeros(len(rows), bool)
                for p in windows:
                    need |= (hi >= p * (low / 100) - 1e-9 * abs(p)) & (lo <= p * (high / 100) + 1e-9 * abs(p))
                here = np.flatnonzero(need & (label != mine))
                s = w.score(i, here)
                w.keep(i, lo, hi, here, s)
                order = _ranked(s, ids[here])
                s, here = s[order], here[order]
                for p in windows:
                    hit = np.flatnonzero((low * p <= 100 * s) & (100 * s <= high * p))[:k]
                    n = len(hit)
                    parts.append((np.full(n, key), np.full(n, p), ids[here[hit]], _as_long(s[hit])))
        return _frame(parts, ["anchor_at", "positive_score", "negative_id", "negative_score"])

    return run


def hard_negatives(rows: DataFrame, id_col: str, vector_col: str, label: Column | str, is_anchor: Column,
                   positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH,
                   scale: int = SCALE, anchor_block: int = ANCHOR_BLOCK, row_block: int = ROW_BLOCK) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``."""
    label = F.col(label) if isinstance(label, str) else label
    v = F.col(f"`{vector_col}`")
    q = F.transform(v, lambda x: F.least(F.greatest(F.floor(x.cast("double") * scale), F.lit(-float(LARGEST))),
                                         F.lit(float(LARGEST))).cast("long"))
    taken = rows.where(F.col(f"`{id_col}`").isNotNull() & label.isNotNull() & finite_vector(v)).select(
        F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"), q.alias("q"),
        F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    # a number for every row, fixed by writing it
    taken, seen = written_with(taken.withColumn("at", F.monotonically_increasing_id()),
                               n=F.count(F.lit(1)), anchors=F.count_if("is_anchor"))
    n_a, n_r = (max(1, -(-seen[x] // size)) for x, size in (("anchors", anchor_block), ("n", row_block)))
    a_block, r_block = (F.pmod(F.xxhash64("at"), F.lit(n).cast("long")) for n in (n_a, n_r))
    tree = written(taken.where("is_anchor").select("at", "id", "label", "q", a_block.alias("a_block")).groupBy("a_block").applyInPandas(
        _tree_rows, "at long, id long, label long, q array<long>, a_block long, place long, parent long, edge double"))
    right = (taken.select("at", "id", "label", "q", r_block.alias("r_block"))
             .withColumn("a_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_a - 1).cast("long")))).groupBy("a_block", "r_block"))

    def met(anchors: DataFrame, run, schema: str) -> DataFrame:
        left = anchors.withColumn("r_block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_r - 1).cast("long"))))
        return written(left.groupBy("a_block", "r_block").cogroup(right).applyInPandas(run, schema))

    found = met(tree, _positives(positives), "anchor_at long, positive_id long, positive_score long")
    best = Window.partitionBy("anchor_at").orderBy(F.desc("positive_score"), "positive_id")
    found = written(found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives))
    windows = found.groupBy(F.col("anchor_at").alias("at")).agg(F.collect_set("positive_score").alias("windows"))  # at most `positives`
    schema = "anchor_at long, positive_score long, negative_id long, negative_score long"
    hits = met(tree.join(windows, "at"), _negatives(negatives, low, high), schema)
    first = Window.partitionBy("anchor_at", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    hits = hits.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= negatives)
    names = tree.select(F.col("at").alias("anchor_at"), F.col("id").alias("anchor_id"))
    return (found.drop("place").join(hits, ["anchor_at", "positive_score"]).join(names, "anchor_at")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def op12_hard_negatives(spark, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    label = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"), "vec_id", "embedding", label,
                          F.col("vec_id") % 100 == 0)


OP12_SQL = """
with e as (
  select vec_id, case when vec_id % 7 = 0 then (label::bigint + 1) % 10 else label::bigint end as label,
    list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as q
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
pairs as (
  select a.vec_id as anchor_id, r.vec_id as id, a.label = r.label as same,
    cast(list_sum(list_transform(list_zip(a.q, r.q), lambda z: z[1] * z[2])) as bigint) as score
  from e a join e r on a.vec_id <> r.vec_id where a.vec_id % 100 = 0),
p as (
  select anchor_id, id as positive_id, score as positive_score from pairs where same
  qualify row_number() over (partition by anchor_id order by score desc, id) <= 5),
n as (
  select p.anchor_id, p.positive_id, p.positive_score, r.id as negative_id, r.score as negative_score,
    cast(row_number() over (partition by p.anchor_id, p.positive_id order by r.score desc, r.id) as integer) as rank
  from p join pairs r on r.anchor_id = p.anchor_id and not r.same
  where 30 * p.positive_score <= 100 * r.score and 100 * r.score <= 90 * p.positive_score)
select anchor_id, positive_id, rank, negative_id, positive_score, negative_score from n where rank <= 10
"""
