r"""Benchmark decontamination with a broadcast hash set of test n-grams.

Words are runs of ASCII letters and digits and of all characters above ASCII,
with A-Z lower-cased. An item's windows are its runs of ``window`` consecutive
words (an item with fewer words, but not none, is one window). A document is
scanned once: words outside the benchmark's vocabulary break it into runs, the
windows inside a run are hashed and looked up, and every hit is verified word
by word. A document word inside any occurrence of a window is hit.

The hash set is broadcast only up to ``max_windows`` distinct windows; the
windows of a larger benchmark are split by hash into as many passes as needed,
which hand on the hit spans, so the result is the same.

Defined cases: null and empty texts have no words and are clean; null and empty
items have no windows; repeated items with one id count once; items with a null
id hit words and count as one item whose id is the empty string; an empty
benchmark leaves every document clean; input columns that clash with the added
names get underscores added.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.llm.common import bound_batches, fresh, give_back, set_aside, table, written

WINDOW = 10
MAX_WINDOWS = 200_000
KEEP = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
WORD = re.compile(r"[0-9A-Za-z\x80-\U0010FFFF]+")
ADDED = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "hit_spans")


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(KEEP).split() if text else []


def windows_of(text: str | None, window: int = WINDOW) -> list[tuple[bytes, ...]]:
    w = words_of(text)
    if not w:
        return []
    return [tuple(w[i:i + window]) for i in range(max(1, len(w) - window + 1))]


class WindowIndex:
    """Word ids, and per window length the sorted hashes of the windows."""

    def __init__(self, rows: list[tuple[str, list[str]]]):
        self.items = {key.encode("utf-8", "surrogatepass"): ids for key, ids in rows}
        self.vocab: dict[bytes, int] = {}
        by_length: dict[int, list[list[int]]] = {}
        for key in self.items:
            words = key.split(b" ")
            by_length.setdefault(len(words), []).append([self.vocab.setdefault(w, len(self.vocab)) for w in words])
        self.random = np.random.default_rng(7).integers(1, 1 << 63, len(self.vocab) + 1, dtype=np.uint64) | np.uint64(1)
        self.hashes = {k: np.unique(self.mixed(np.array(ids).T)) for k, ids in sorted(by_length.items())}

    def mixed(self, columns) -> np.ndarray:
        total = np.uint64(0)
        with np.errstate(over="ignore"):
            for ids in columns:
                total = total * np.uint64(6364136223846793005) + self.random[ids]
        return total

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged hit spans (first word, end) and the ids of the items."""
        n, spans, found = len(words), [], set()
        ids = np.fromiter(map(self.vocab.get, words, [-1] * n), np.int64, n)
        known = np.concatenate(([0], np.cumsum(ids >= 0)))
        for k, hashes in self.hashes.items():
            if n < k:
                continue
            at = np.flatnonzero(known[k:] - known[:-k] == k)
            if not len(at):
                continue
            h = self.mixed(ids[at + j] for j in range(k))
            near = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            for i in at[hashes[near] == h].tolist():
                hit = self.items.get(b" ".join(words[i:i + k]))
                if hit is not None:
                    spans.append((i, i + k))
                    found.update(hit)
        return merged(spans), found


def merged(spans) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def benchmark_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """One row per distinct window: ``key`` (words joined by a space), ``ids``."""
    @F.pandas_udf("array<string>")
    def keys(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: [b" ".join(w).decode("utf-8", "surrogatepass") for w in windows_of(t, window)])

    return (benchmark.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"),
                             F.explode(keys(F.col(f"`{text_col}`"))).alias("key"))
            .groupBy("key").agg(F.array_sort(F.collect_set("id")).alias("ids")))


def find_contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                       item_text_col: str = "text", window: int = WINDOW,
                       max_windows: int = MAX_WINDOWS) -> DataFrame:
    """``docs`` plus ``n_words, n_hit, n_items, items_sha256, contaminated``
    and ``hit_spans`` (first and end word of each merged hit)."""
    sc = docs.sparkSession.sparkContext
    bound_batches(docs.sparkSession)
    wins = written(benchmark_windows(benchmark, item_id_col, item_text_col, window))
    passes = max(1, -(-wins.count() // max_windows))
    df = set_aside(docs, *ADDED, "hit_spans")
    kept, (own,) = df.columns, fresh(df, "state")
    text = F.col(f"`{text_col}`")
    state = F.lit(None).cast("struct<n:long,spans:array<long>,items:array<string>>")

    def one_pass(shared):
        @F.pandas_udf("n long, spans array<long>, items array<string>")
        def scan(batches: Iterator[tuple[pd.Series, pd.DataFrame]]) -> Iterator[pd.DataFrame]:
            index = shared.value
            for texts, before in batches:
                out = []
                for t, spans0, items0 in zip(texts, before["spans"], before["items"], strict=True):
                    words = words_of(t)
                    spans, items = index.scan(words) if index.items else ([], set())
                    if spans0 is not None:
                        flat = list(spans0)
                        spans = merged([*spans, *zip(flat[::2], flat[1::2], strict=True)])
                        items |= set(items0)
                    out.append((len(words), [x for s in spans for x in s], sorted(items)))
                yield pd.DataFrame(out, columns=["n", "spans", "items"])
                del texts, before, out
                give_back()
        return scan

    part = F.pmod(F.xxhash64("key"), F.lit(passes))
    for p in range(passes):
        rows = [(r["key"], list(r["ids"])) for r in wins.where(part == p).collect()]  # max_windows rows on average
        shared = sc.broadcast(WindowIndex(rows))
        df = df.withColumn(own, one_pass(shared)(text, state if p == 0 else F.col(own)))
        if passes > 1:  # one index at a time in memory
            df = written(df)
            shared.destroy()

    s = F.col(own)
    spans = F.transform(F.sequence(F.lit(0), F.floor(F.size(s["spans"]) / 2).cast("int") - 1), lambda i: F.struct(
        s["spans"][i * 2].alias("first"), s["spans"][i * 2 + 1].alias("end")))
    df = df.withColumn("hit_spans", F.when(F.size(s["spans"]) > 0, spans).otherwise(
        F.array().cast("array<struct<first:long,end:long>>")))
    hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["first"])
    return df.select(*[F.col(f"`{c}`") for c in kept], s["n"].alias("n_words"),
                     hit.alias("n_hit"), F.size(s["items"]).cast("long").alias("n_items"),
                     F.sha2(F.array_join(s["items"], ","), 256).alias("items_sha256"),
                     (F.size(s["spans"]) > 0).alias("contaminated"), "hit_spans")


def remove_spans(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the given word spans."""
    at = [m.span() for m in WORD.finditer(text)]
    out, last = [], 0
    for a, b in spans:
        out.append(text[last:at[a][0]])
        last = at[b - 1][1]
    return "".join(out) + text[last:]


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", text_col: str = "text",
                  **kw) -> DataFrame:
    """The columns of ``docs`` without contaminated documents, or (``remove =
    "spans"``) with the hit spans cut out of the texts."""
    aside = set_aside(docs, *ADDED, "hit_spans")  # the judged columns are dropped again
    d = find_contamination(aside, benchmark, text_col=text_col, **kw)
    if remove == "documents":
        d = d.where(~F.col("contaminated"))
    else:
        @F.pandas_udf("string")
        def cut(texts: pd.Series, spans: pd.Series) -> pd.Series:
            return pd.Series([t if t is None or not len(s) else remove_spans(t, [(x["first"], x["end"]) for x in s])
                              for t, s in zip(texts, spans, strict=True)], dtype=object)

        d = d.withColumn(text_col, F.when(F.col("contaminated"), cut(F.col(f"`{text_col}`"), "hit_spans"))
                         .otherwise(F.col(f"`{text_col}`")))
    return d.select(*[F.col(f"`{a}`").alias(c) for a, c in zip(aside.columns, docs.columns, strict=True)])


def op7_benchmark_decontamination(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    d = find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return d.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP7_SQL = r"""
with low as (select doc_id, row_number() over () as r, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select coalesce(item_id::varchar, '') as id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
win as (select distinct id, least(len(w), 10) as k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as key
        from (select *, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as i from b where len(w) > 0)),
ks as (select distinct k from win),
occ as (select r, i, k, array_to_string(w[i:i + k - 1], ' ') as key
        from (select r, w, k, unnest(range(1, len(w) - k + 2)) as i from low, ks where len(w) >= k)),
hit as (select r, i, occ.k, id from occ join win on occ.key = win.key and occ.k = win.k),
pos as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + k)) as p from hit) group by r),
it as (select r, count(*) as n_items, string_agg(id, ',' order by id) as ids from (select distinct r, id from hit) group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from low left join pos using (r) left join it using (r)
"""
