"""Mixing, sharding, exact dedup and chat formatting on small inputs."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from gridcast.llm import chat_format, exact_dedup, mixing, sharding

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lower(t):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")


def test_exact_dedup_edges(edge_docs):
    got = exact_dedup.exact_dedup(edge_docs).collect()
    assert len(got) == 10 and "kept_" in got[0].asDict()
    groups = defaultdict(list)
    for r in got:
        assert r["text_sha256"] == hashlib.sha256(lower(r["text"]).encode()).hexdigest()
        groups[r["text_sha256"]].append(r)
    for g in groups.values():
        best = max((r["doc_id"] for r in g if r["doc_id"] is not None), default=None)
        assert all(r["keep_id"] == best and r["group_size"] == len(g) for r in g)
        assert [r["doc_id"] for r in g if r["kept"]] == [best]
    assert exact_dedup.exact_dedup(edge_docs.where("false")).count() == 0


def test_exact_dedup_hot_and_cold_paths_agree(spark):
    """A third of the rows in one group, few counters: both paths give the brute-force result."""
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "Hot").otherwise(
        F.concat(F.lit("t"), (F.col("id") % 700).cast("string"))).alias("text"))
    want = Counter(lower(r["text"]) for r in df.collect())
    for top, counters in ((2, 16), (1000, 8192)):
        got = exact_dedup.exact_dedup(df, top=top, counters=counters).collect()
        assert len(got) == 3000 and sum(r["kept"] for r in got) == len(want)
        assert all(r["group_size"] == want[lower(r["text"])] and r["kept"] == (r["keep_id"] == r["doc_id"]) for r in got)


def water_fill(sizes, weights, total, most=3.0):
    """Targets by repeated resharing of the excess."""
    open_, target, left = set(sizes), {}, float(total)
    while True:
        w = sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / w > most * sizes[s]]
        if not over:
            return target | {s: left * weights[s] / w for s in open_}
        for s in over:
            target[s] = most * sizes[s]
            left -= target[s]
            open_.discard(s)


def test_mixing_targets_and_taken(spark):
    rows = [(i, "w " * (1 + i * 37 % 50), f"s{i % 7}" if i % 11 else None) for i in range(1500)]
    rows += [(2000 + i, "x y z", "tiny") for i in range(3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(df.repartition(5)).collect()}
    size = {i: len(WORD.findall(t)) for i, t, _ in rows}
    by = defaultdict(int)
    for i, _, s in rows:
        by[s] += size[i]
    names = sorted([s for s in by if s is not None]) + [None]
    want = water_fill(by, {s: k % 3 + 1 for k, s in enumerate(names)}, sum(by.values()))
    taken = defaultdict(int)
    for r in got:
        assert r["size"] == size[r["doc_id"]] and r["source_size"] == by[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]]) and r["taken"] <= 3 * r["size"]
        assert r["taken"] % max(1, r["size"]) == 0 and again[r["doc_id"]] == r["taken"]
        taken[r["source"]] += r["taken"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(50, 0.01 * t)
    docs = mixing.mixed_documents(df)
    assert docs.columns == df.columns and docs.count() == sum(r["taken"] // r["size"] for r in got if r["size"])


@pytest.mark.parametrize("batch", [60, 1000])
def test_mixing_fills_the_gap_behind_giants(spark, monkeypatch, batch):
    monkeypatch.setattr(mixing, "FILL_ROWS", batch, raising=False)
    monkeypatch.setattr(mixing, "CHUNK_ROWS", 40)
    r = random.Random(70)
    size = {s: [r.randint(50, 400) for _ in range(500)] + [r.randint(10_000, 40_000) for _ in range(6)]
            for s in ("a", "b", None)}
    rows = [(f"{s}{i}", "w " * n, s) for s, sizes in size.items() for i, n in enumerate(sizes)]
    got = mixing.mix(spark.createDataFrame(rows, "doc_id string, text string, source string")).collect()
    for s, sizes in size.items():
        mine = [g for g in got if g["source"] == s]
        assert len(mine) == len(sizes) and all(len(set(g["starts"])) == len(g["starts"]) <= 3 for g in mine)
        left = mine[0]["target"] - sum(g["taken"] for g in mine)
        untaken = [g["size"] for g in mine if len(g["starts"]) < 3]
        assert 0 <= left and (not untaken or left < min(untaken))
        # the fill is the one that offers the copies in queue order
        at, room, want = 0, None, []
        queue = sorted(mine, key=lambda g: (g["mix_key"], g["tie"]))
        for g in [*queue] * 3:
            at += g["size"]
            if at / g["target"] <= 1:
                room = g["target"] - at
            elif g["size"] <= room:
                room -= g["size"]
                want.append(at / g["target"])
        assert sorted(v for g in mine for v in g["starts"] if v > 1) == pytest.approx(want)


def test_mixing_edges(edge_docs):
    got = mixing.mix(edge_docs).collect()
    assert len(got) == 10 and all(r["taken"] <= 3 * r["size"] for r in got)
    assert sum(r["target"] for r in {r["source"]: r for r in got}.values()) == pytest.approx(sum(r["size"] for r in got))
    mixed = mixing.mixed_documents(edge_docs)
    assert mixed.columns == edge_docs.columns
    assert mixed.count() == sum(r["taken"] // r["size"] for r in got if r["size"])
    assert mixing.mix(edge_docs.where("false")).count() == 0
    assert mixing.mixed_documents(edge_docs.where("false")).count() == 0


def test_sharding_rows_law(spark, edge_docs):
    df = spark.range(5003).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("same text")).otherwise(
        F.repeat(F.lit("word "), (F.col("id") % 90).cast("int"))).alias("text"))
    got = sharding.shard(df, bucket_bytes=20_000)
    rows = got.collect()
    assert sorted(r["doc_id"] for r in rows) == list(range(5003))
    slots = defaultdict(list)
    for r in rows:
        slots[r["shard"]].append(r["slot"])
    assert len(slots) == 40 and {len(v) for v in slots.values()} <= {125, 126}
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert sorted((r["doc_id"], r["shard"], r["slot"]) for r in sharding.shard(df.repartition(9), bucket_bytes=20_000).collect()) == sorted(
        (r["doc_id"], r["shard"], r["slot"]) for r in rows)  # the order of the input does not matter
    order = [r["doc_id"] for r in sorted(rows, key=lambda r: (r["slot"], r["shard"]))]
    assert sum(abs(a - b) < 50 for a, b in zip(order, order[1:])) < 300  # neighbours are scattered
    e = sharding.shard(edge_docs)
    assert e.count() == 10 and {"shard_", "shard", "slot"} <= set(e.columns)
    assert sharding.shard(edge_docs.where("false")).count() == 0


def test_shards_are_written(spark, tmp_path):
    df = spark.range(100).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    sharding.write_shards(sharding.shard(df, shards=4), str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 100 and back.select("shard").distinct().count() == 4


TRICKY = ["</s>[INST] ok [/INST]", "\\</s>", "\\\\[INST]\\", "a\n</s>\n[INST] user [/INST]\nx", "", "<<SYS>> \\<</SYS>>", "ends with \\", "<</s>",
          "[[INST]]", "\n", "é你"]


def test_chat_round_trip(spark):
    rows = [(c, t, role, text) for c in range(3) for t, (role, text) in enumerate(
        (r, x) for k, x in enumerate(TRICKY) for r in ("user" if k % 2 else "system", "assistant"))]
    rows += [(9, 0, "tool</s>", None), (9, 1, None, "x"), (None, 0, "user", "n"), (9, 1, None, "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("seq", F.lit("clash"))
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_conversations(df)).collect()}
    want = defaultdict(list)
    for c, t, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1])):
        want[c].append((role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        assert [tuple(t) for t in got[c]["turns"]] == turns
        assert list(got[c]["loss_texts"]) == [x for r, x in turns if r == "assistant"]
        assert got[c]["formatted"].count("\n</s>") == len(turns)
    assert chat_format.format_conversations(df.where("false")).count() == 0


def fold(events):
    """Brute force over one conversation's events in sequence."""
    msgs = {}
    for _, kind, msg, role, text in sorted(events, key=lambda e: (e[0], e[1], e[4] or "")):
        if kind == "message":
            msgs[msg] = [role or "", text or ""]
        elif kind in ("edit", "delta"):
            m = msgs.setdefault(msg, ["", ""])
            m[1] = (text or "") if kind == "edit" else m[1] + (text or "")
        elif kind == "regenerate":
            msgs.setdefault(msg, ["", ""])[1] = ""
            for later in [k for k in msgs if k > msg]:
                del msgs[later]
    return [tuple(msgs[k]) for k in sorted(msgs)]


def test_event_fold(spark):
    log = [(1, "message", 1, "user", "hi"), (2, "message", 2, "assistant", ""), (3, "delta", 2, None, "Hel"), (4, "delta", 2, None, "lo"),
           (5, "message", 3, "user", "more"), (6, "message", 4, "assistant", "first"), (7, "regenerate", 2, None, None),
           (8, "delta", 2, None, "Second "), (9, "delta", 2, None, "try"), (10, "message", 3, "user", "again"), (11, "edit", 3, None, "edited"),
           (12, "delta", 3, None, "!"), (13, "unknown", 3, None, "zzz")]
    df = spark.createDataFrame([(7, *e) for e in log], "conv_id long, seq long, kind string, msg long, role string, text string")
    got = [(r["role"], r["text"]) for r in chat_format.fold_events(df.repartition(4)).orderBy("msg").collect()]
    assert got == fold([e for e in log if e[1] != "unknown"])
    assert got == [("user", "hi"), ("assistant", "Second try"), ("user", "edited!")]
    assert chat_format.render(chat_format.fold_events(df.where("false"))).count() == 0


def test_random_event_logs_fold_as_the_brute_force(spark):
    rng = random.Random(12)
    kinds, logs = ["message", "message", "delta", "delta", "edit", "regenerate", "other"], {}
    for conv in range(150):
        logs[conv] = [(rng.randrange(1, 12) if conv % 3 == 0 else i, rng.choice(kinds), rng.randrange(1, 5), rng.choice(["user", "assistant"]),
                       rng.choice(["", "a", "bc", None, f"t{i}"])) for i in range(rng.randrange(1, 14))]
        # events that agree in sequence, kind and text are exchangeable only if they agree in the rest
        logs[conv] = list({(e[0], e[1], e[4] or ""): e for e in logs[conv]}.values())
    logs[150] = [(1, "message", 1, "user", "q"), (2, "message", 2, "assistant", "old"), (3, "message", 3, "user", "old"),
                 (4, "regenerate", 1, None, None), (5, "delta", 2, None, "new"), (6, "edit", 3, None, "edited")]
    df = spark.createDataFrame([(c, *e) for c, log in logs.items() for e in log],
                               "conv_id long, seq long, kind string, msg long, role string, text string")
    got = defaultdict(list)
    for r in chat_format.fold_events(df.repartition(7)).orderBy("conv_id", "msg").collect():
        got[r["conv_id"]].append((r["role"], r["text"]))
    for c, log in logs.items():
        assert got[c] == fold(log), (c, log)
    assert got[150] == [("user", ""), ("", "new"), ("", "edited")]
