"""SimHash near-duplicates by a binary-trie self-join.

A text's shingles are its runs of three words (words: ``[^\\x20\\x09-\\x0D]+``, A-Z
lower-cased; joined by one space; repeats count; a shorter text is one shingle).
A fingerprint bit is 1 if it is set in over half of the shingles' XXH64 hashes
(seed 42). Fingerprints that differ in at most ``distance`` bits are linked;
components of links are classes.

The fingerprints, each once, stand in two binary tries: one over the bits from
the highest on, one over the fingerprint with its halves exchanged. Of two
fingerprints with at most ``distance`` different bits, one half has at most
``distance // 2`` of them, so in one of the tries the error budget of the first 32
levels is ``distance // 2``; it is ``distance`` below. Pairs of nodes are traversed
together from the root pair on, ``STEP`` levels a round as one join of the pairs
with the next level's nodes; pairs over the budget are pruned, and pairs with both nodes
at most ``leaf`` fingerprints leave the traversal. The fingerprints of such a
pair meet in one task, which goes on level by level in NumPy over sorted
ranges and returns a spanning forest of the links it finds, never the links of a
dense group one by one. Large nodes are split however skewed they are, because
fingerprints are distinct; copies of a text cost one row.

Result per document: ``doc_id``, ``fingerprint`` (16 hex digits) and ``component_id``
(the least id of its component). Defined cases: null and empty texts and texts of white
space have fingerprint zero, linked like any other; null ids count after all others
(a component of null ids has a null class); repeated rows are copies; very long
texts are hashed in pieces of ``PIECE`` bytes, whole; an empty table gives no rows;
further input columns of any name are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from gridcast.llm.common import join_hot, table, written, written_with
from gridcast.llm.near_dup import components

SHINGLE, SEED, DISTANCE = 3, 42, 3
LEAF = 1 << 15  # fingerprints of a node that is not split any more
STEP = 4  # levels a round
PIECE = 1 << 20
PAIRS = 64  # pairs of a node pair that are compared without further descent
FRONTIER = 1 << 16  # node pairs handled at a time in a task


def _word_lists(text: bytes) -> Iterator[list[bytes]]:
    """The words of a lower-cased text, piece by piece."""
    rest = b""
    for at in range(0, len(text), PIECE):
        piece = rest + text[at:at + PIECE].lower()
        words = piece.split()  # of bytes: at the six white space characters of the definition
        rest = words.pop() if at + PIECE < len(text) and words and not piece[-1:].isspace() else b""
        yield words


def fingerprint(text: bytes | None, k: int = SHINGLE, seed: int = SEED) -> int:
    """The fingerprint of a UTF-8 text as a signed 64-bit integer."""
    counts, n, held = np.zeros(64, np.int64), 0, []

    def add(shingles: list[bytes]) -> None:
        h = np.fromiter(map(xxh64_intdigest, shingles, repeat(seed)), ">u8", len(shingles))
        counts[:] += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)

    for words in _word_lists(text or b""):
        held += words
        if len(held) >= k:
            add([b" ".join(w) for w in zip(*(held[i:] for i in range(k)), strict=False)])
            n += len(held) - k + 1
            held = held[len(held) - k + 1:]
    if not n and held:
        add([b" ".join(held)])
        n = 1
    return int(np.packbits(2 * counts > n).view(">i8")[0])


def _budget(depth: int, distance: int) -> int:
    return distance // 2 if depth <= 32 else distance


def _swap(x):
    """A fingerprint with its halves exchanged."""
    if isinstance(x, Column):
        return F.shiftleft(x, 32).bitwiseOR(F.shiftrightunsigned(x, 32))
    return (x << np.uint64(32)) | (x >> np.uint64(32))


def _prefix(key: Column, depth: int) -> Column:
    return F.shiftrightunsigned(key, 64 - depth) if depth else F.lit(0).cast("long")


def trie_links(a: np.ndarray, b: np.ndarray, depth: int, distance: int, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of linked keys of two trie nodes of one ``depth``, given as their
    sorted keys; ``same``: both are one node. Node pairs are ranges of the
    sorted keys; a level splits each range at its next bit."""
    if not len(a) or not len(b):
        return
    first = int(np.bitwise_count((a[0] ^ b[0]) >> np.uint64(64 - depth))) if depth else 0
    todo = [(depth, *(np.array([x], np.int64) for x in (0, len(a), 0, len(b), first)))]
    while todo:
        d, *part = todo.pop()
        if len(part[0]) > FRONTIER:
            cut = len(part[0]) // 2
            todo += [(d, *(x[:cut] for x in part)), (d, *(x[cut:] for x in part))]
            continue
        alo, ahi, blo, bhi, diff = part
        size = (ahi - alo) * (bhi - blo)
        end = size <= PAIRS if d < 64 else np.ones(len(size), bool)
        if end.any():
            at = np.repeat(np.flatnonzero(end), size[end])
            nth = np.arange(len(at)) - np.repeat(np.cumsum(size[end]) - size[end], size[end])
            wide = (bhi - blo)[at]
            i, j = alo[at] + nth // wide, blo[at] + nth % wide
            ok = np.bitwise_count(a[i] ^ b[j]) <= distance
            if same:
                ok &= i < j
            yield i[ok], j[ok]
        go = ~end
        if not go.any():
            continue
        alo, ahi, blo, bhi, diff = (x[go] for x in (alo, ahi, blo, bhi, diff))
        high = np.uint64(((1 << d) - 1) << (64 - d) if d else 0)
        bit = np.uint64(1 << (63 - d))
        am = np.clip(np.searchsorted(a, (a[alo] & high) | bit), alo, ahi)
        bm = np.clip(np.searchsorted(b, (b[blo] & high) | bit), blo, bhi)
        inside = same & (alo == blo)
        parts = [(alo, am, blo, bm, diff), (am, ahi, bm, bhi, diff), (alo, am, bm, bhi, diff + 1),
                 (am, np.where(inside, am, ahi), blo, bm, diff + 1)]
        alo, ahi, blo, bhi, diff = (np.concatenate(x) for x in zip(*parts, strict=True))
        keep = (ahi > alo) & (bhi > blo) & (diff <= _budget(d + 1, distance))
        if keep.any():
            todo.append((d + 1, *(x[keep] for x in (alo, ahi, blo, bhi, diff))))


def _forest(n: int, links: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of ``n`` nodes the least node of its component."""
    root = np.arange(n)
    for i, j in links:
        while True:
            p, q = root[i], root[j]
            apart = p != q
            if not apart.any():
                break
            i, j, p, q = i[apart], j[apart], p[apart], q[apart]
            np.minimum.at(root, np.maximum(p, q), np.minimum(p, q))
            while (root != root[root]).any():
                root = root[root]
    return root


def _block_links(distance: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        t, depth = rows["t"].iat[0], int(rows["depth"].iat[0])
        key, second = rows["key"].to_numpy().view(np.uint64), rows["second"].to_numpy()
        a = np.sort(key[~second])
        same = rows["a"].iat[0] == rows["b"].iat[0]
        b = a if same else np.sort(key[second])
        nodes = a if same else np.concatenate((a, b))
        off = 0 if same else len(a)
        root = _forest(len(nodes), ((i, j + off) for i, j in trie_links(a, b, depth, distance, same)))
        nodes = _swap(nodes) if t else nodes
        child = np.flatnonzero(root != np.arange(len(root)))
        return pd.DataFrame({"a": nodes[child].view(np.int64), "b": nodes[root[child]].view(np.int64)})

    return run


def hamming_forest(prints: DataFrame, distance: int = DISTANCE, leaf: int = LEAF) -> DataFrame:
    """Links ``a, b`` that join the components of the fingerprints ``fp`` (a
    written table of distinct longs) that differ in at most ``distance`` bits."""
    keys = prints.select("fp", F.explode(F.array(
        F.struct(F.lit(0).alias("t"), F.col("fp").alias("key")), F.struct(F.lit(1).alias("t"), _swap(F.col("fp")).alias("key")))).alias("k"))
    keys = keys.select("k.t", "k.key")

    def nodes(depth: int) -> DataFrame:
        return keys.groupBy("t", _prefix(F.col("key"), depth).alias("node")).agg(F.count(F.lit(1)).alias("n"))

    top = nodes(0)
    pairs = top.select("t", F.col("node").alias("a"), F.col("node").alias("b"), F.col("n").alias("na"), F.col("n").alias("nb"))
    depth, done = 0, []
    while True:
        big = F.greatest("na", "nb") > leaf
        pairs, seen = written_with(pairs, big=F.count_if(big), all=F.count(F.lit(1)))
        if seen["all"] > seen["big"]:
            done.append((depth, pairs.where(~big).select("t", F.lit(depth).alias("depth"), "a", "b")))
        if not seen["big"]:
            break
        depth += STEP
        below = written(nodes(depth).withColumn("up", F.shiftrightunsigned("node", STEP)))
        side = lambda x: below.select("t", F.col("up").alias(x), F.col("node").alias("c" + x), F.col("n").alias("n" + x))
        pairs = (pairs.where(big).select("t", "a", "b").join(side("a"), ["t", "a"]).join(side("b"), ["t", "b"])
                 .where((F.col("a") < F.col("b")) | (F.col("ca") <= F.col("cb")))
                 .where(F.bit_count(F.col("ca").bitwiseXOR(F.col("cb"))) <= _budget(depth, distance))
                 .select("t", F.col("ca").alias("a"), F.col("cb").alias("b"), "na", "nb"))
    if not done:
        return prints.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    blocks = done[0][1]
    for _, more in done[1:]:
        blocks = blocks.unionByName(more)
    sides = blocks.select("*", F.explode(F.when(F.col("a") == F.col("b"), F.array(F.struct(F.col("a").alias("node"), F.lit(False).alias(
        "second")))).otherwise(F.array(F.struct(F.col("a").alias("node"), F.lit(False).alias("second")),
                                       F.struct(F.col("b").alias("node"), F.lit(True).alias("second"))))).alias("s"))
    sides = sides.select("t", "depth", "a", "b", "s.node", "s.second")
    places = keys.select("t", "key", F.explode(F.array(*[
        F.struct(F.lit(d).alias("depth"), _prefix(F.col("key"), d).alias("node")) for d, _ in done])).alias("p")).select("t", "key", "p.*")
    return (places.join(sides, ["t", "depth", "node"]).groupBy("t", "depth", "a", "b")
            .applyInPandas(_block_links(distance), "a long, b long"))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``id, fp`` of every row; ``fp`` is the fingerprint as a long."""
    @F.pandas_udf("long")
    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint(t, shingle, seed) for t in texts], dtype="int64")

    return docs.select(F.col(f"`{id_col}`").alias("id"), sign(F.col(f"`{text_col}`").cast("binary")).alias("fp"))


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                       seed: int = SEED, distance: int = DISTANCE, leaf: int = LEAF) -> DataFrame:
    """``doc_id, fingerprint, component_id``, one row per document."""
    signed, seen = written_with(fingerprints(docs, id_col, text_col, shingle, seed), n=F.count(F.lit(1)))
    prints, copies = written_with(signed.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("copies")),
                                  most=F.max("copies"))
    comps = components(written(hamming_forest(prints, distance, leaf)))
    linked = written(comps.join(prints.withColumnRenamed("fp", "c"), "c"))
    whole, got = written_with(linked.groupBy("root").agg(F.min("least").alias("component"), F.count(F.lit(1)).alias("members")),
                              most=F.max("members"), n=F.sum("members"))
    linked = join_hot(linked.select("c", "root"), whole, "root", "members", got["n"], most=got["most"])
    prints = (prints.join(linked.select(F.col("c").alias("fp"), "component"), "fp", "left")
              .select("fp", "copies", F.coalesce("component", "least").alias("component")))
    out = join_hot(signed, prints, "fp", "copies", seen["n"], most=copies["most"], least=1000)
    return out.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                      F.col("component").alias("component_id"))


def op11_simhash(spark, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents").select("doc_id", "text"))
