"""Mixing sources to target weights by weighted fair queueing (native).

Every source gets a target number of words: its weight's share of the budget,
at most ``max_repeat`` times its own words, with the excess shared again by
weight (water filling on the table of sources). Each source's documents are
shuffled by a seeded digest and queued once per pass over the source; a queued
copy's *virtual finish time* is the source's cumulative words up to and
including it, divided by the source's target. Serving copies in order of
virtual finish time keeps all sources in proportion at every point of the mix,
and the budget is spent at virtual time 1: the queue is range-sorted on the
virtual finish time and cut there. The one document per source that straddles
the cut is left out, and the words it leaves unspent are filled: the copies
behind the cut are offered in queue order and each that still fits is taken,
until no untaken copy behind the cut fits. They are offered in batches of at
most ``FILL_ROWS`` rows a source, found by counts per range.

Cumulative sums never meet in one task: a source is dealt into ranges of its
digest (``CHUNK_ROWS`` rows each), summed within a range and carried over the
small table of ranges, so a source with a third of all rows spreads out.

Defined cases: a null text has size 0; a null source is a source of its own,
the last; documents without words are never taken; ties (repeated rows) are
exchangeable; an empty table gives an empty mix; input columns that clash with
the added names get underscores.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import fresh, join_sized, table, written

WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1"
CHUNK_ROWS = 1000
FILL_ROWS = 1000
MAX_REPEAT = 3


def mix_key(text_digest: Column, row_id: Column, seed: str) -> Column:
    """Digest that orders a source's queue; rows without an id spread by their texts."""
    return F.md5(F.concat_ws("|", F.lit(seed), F.coalesce(row_id.cast("string"), F.lit("-")), text_digest).cast("binary"))


def text_digest(text: Column) -> Column:
    return F.md5(F.coalesce(text, F.lit("")).cast("binary"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0,
                   max_repeat: int = MAX_REPEAT) -> DataFrame:
    """One row per source: ``source, source_size, source_rows, target``.

    ``weights`` repeat over the sources in code-point order, null last. With
    sources ordered by ``cap / weight``, the first k are capped, where k is the
    least number whose level ``(budget - their caps) / (other weights)`` is not
    above the next source's ``cap / weight``."""
    s = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("source_rows"))
    rank = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())) - 1
    s = (s.withColumn("rank", rank)
         .withColumn("w", F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                                       (F.col("rank") % len(weights) + 1).cast("int")))
         .withColumn("cap", F.col("source_size").cast("double") * F.lit(float(max_repeat)))
         .withColumn("ratio", F.col("cap") / F.col("w")))
    whole, by = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy("ratio", "rank")
    before = by.rowsBetween(Window.unboundedPreceding, -1)
    after = by.rowsBetween(0, Window.unboundedFollowing)
    s = s.withColumn("budget", F.sum("source_size").over(whole).cast("double") * F.lit(float(share)))
    level = (F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(after)
    s = s.withColumn("level", F.when(F.col("ratio") >= level, level))  # the first such row has the true level
    s = s.withColumn("level", F.first("level", ignorenulls=True).over(
        by.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("w") * F.col("level")))
    return s.select("source", "source_size", "source_rows", target.alias("target"))


def queue(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """The sized rows with ``source_size, target`` and ``done``: the words of
    the source up to and including the row, in the source's shuffled order."""
    u = F.conv(F.substring("mix_key", 1, 8), 16, 10).cast("long")
    chunks = F.ceil(F.col("source_rows") / F.lit(CHUNK_ROWS))
    q = (join_sized(sized.withColumn("by", F.struct("source")), targets.select(F.struct("source").alias("by"), "source_size",
                                                                              "source_rows", "target"), "by", "source_rows")
         .withColumn("chunk", F.floor(u * chunks / F.lit(float(1 << 32)))))
    q = written(q)
    carry = (q.groupBy("source", "chunk").agg(F.sum("size").alias("n"))
             .withColumn("carry", F.coalesce(F.sum("n").over(
                 Window.partitionBy("source").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)),
                 F.lit(0))).select(F.col("source").alias("c_source"), F.col("chunk").alias("c_chunk"), "carry"))
    inside = (Window.partitionBy("source", "chunk").orderBy("mix_key", "tie")
              .rowsBetween(Window.unboundedPreceding, 0))
    q = q.repartition("source", "chunk").withColumn("inside", F.sum("size").over(inside))
    q = q.join(carry, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("chunk") == F.col("c_chunk")))
    return q.withColumn("done", F.col("inside") + F.col("carry")).drop("c_source", "c_chunk", "carry", "inside")


def refilled(q: DataFrame, spent: DataFrame, max_repeat: int) -> DataFrame | None:
    """The copies behind the cut that fill the gaps, ``f_source, f_done, more``
    per row of ``q`` with any. ``spent`` has ``by, rows`` and ``gap``. A round
    offers each source its next ``FILL_ROWS`` copies that fit the gap by
    themselves; a source is through when a round has offered all of these."""
    behind = (q.where((F.col("size") > 0) & (F.col("target") > 0))
              .select(F.struct("source").alias("by"), "chunk", "size", "done", "target", "source_size")
              .withColumn("e", F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1))))
              .withColumn("place", F.col("done") + F.col("e") * F.col("source_size"))
              .where(F.col("place").cast("double") / F.col("target") > 1.0))
    state = written(spent.select("by", "rows", F.floor("gap").alias("room"), F.lit(-1).cast("long").alias("seen"))
                    .where(F.col("room") > 0))
    took = []
    while not state.isEmpty():
        fits = (join_sized(behind, state, "by", "rows")
                .where((F.col("size") <= F.col("room")) & (F.col("place") > F.col("seen"))))
        ranges = fits.groupBy("by", "e", "chunk").agg(F.count(F.lit(1)).alias("n"), F.max("rows").alias("rows"))
        order = Window.partitionBy("by").orderBy("e", "chunk")
        ranges = written(ranges.withColumn("ahead", F.sum("n").over(order) - F.col("n")))
        total = ranges.groupBy("by").agg(F.sum("n").alias("offered"))
        near = (ranges.where(F.col("ahead") < FILL_ROWS)
                .select(F.struct("by", "e", "chunk").alias("range"), "ahead", F.col("n").alias("in_range")))
        place = Window.partitionBy("range").orderBy("place")
        batch = (join_sized(fits.withColumn("range", F.struct("by", "e", "chunk")), written(near), "range", "in_range")
                 .withColumn("nth", F.col("ahead") + F.row_number().over(place)).where(F.col("nth") <= FILL_ROWS))
        batch = batch.groupBy("by").agg(
            F.array_sort(F.collect_list(F.struct("place", "size", "done", "target"))).alias("offer"),
            F.first("room").alias("room"), F.first("rows").alias("rows"))
        one = "struct<place:bigint,size:bigint,done:bigint,target:double>"
        start = F.struct(F.col("room").alias("room"), F.array().cast(f"array<{one}>").alias("took"))
        fold = F.aggregate("offer", start, lambda a, x: F.when(
            x["size"] <= a["room"], F.struct((a["room"] - x["size"]).alias("room"),
                                             F.concat(a["took"], F.array(x)).alias("took"))).otherwise(a))
        batch = written(batch.join(total, "by").select(
            "by", "rows", "offered", F.size("offer").alias("seen_rows"), F.element_at("offer", -1)["place"].alias("seen"),
            fold.alias("fold")))
        took.append(batch.select("by", F.explode("fold.took").alias("x")))
        state = written(batch.where((F.col("offered") > F.col("seen_rows")) & (F.col("fold.room") > 0))
                        .select("by", "rows", F.col("fold.room").alias("room"), "seen"))
    if not took:
        return None
    return (reduce(DataFrame.unionByName, took)
            .groupBy(F.col("by.source").alias("f_source"), F.col("x.done").alias("f_done"))
            .agg(F.collect_list(F.col("x.place") / F.col("x.target")).alias("more")))


def mix(docs: DataFrame, weights: tuple[int, ...] = (1, 2, 3), share: float = 1.0, max_repeat: int = MAX_REPEAT,
        seed: str = SEED, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The plan of the mix, one row per document: ``doc_id, size, source,
    source_size, target, starts`` and ``taken``. ``starts`` holds the virtual
    finish time of each copy that the mix takes; ``taken`` the words taken."""
    size = word_count(F.col(f"`{text_col}`"))
    sized = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{source_col}`").alias("source"),
                        size.alias("size"), text_digest(F.col(f"`{text_col}`")).alias("tie"))
    sized = sized.withColumn("mix_key", mix_key(F.col("tie"), F.col("doc_id"), seed))
    sized = written(sized)  # the texts are read once; all that follows works on this narrow table
    targets = source_targets(sized, weights, share, max_repeat)
    q = written(queue(sized, written(targets)))

    # virtual finish time of each copy; the range sort's cut lies at virtual time 1
    copies = F.transform(F.sequence(F.lit(0), F.lit(max_repeat - 1)),
                         lambda e: (F.col("done") + e * F.col("source_size")).cast("double") / F.col("target"))
    served = F.when((F.col("size") > 0) & (F.col("target") > 0), F.filter(copies, lambda v: v <= 1.0)) \
        .otherwise(F.array().cast("array<double>"))
    q = q.withColumn("starts", served)
    spent = (q.groupBy("source").agg(F.sum(F.size("starts") * F.col("size")).alias("spent"),
                                     F.max("size").alias("largest"), F.first("target").alias("g_target"),
                                     F.count(F.lit(1)).alias("rows"))
             .select(F.struct("source").alias("by"), "spent", "largest", "rows", (F.col("g_target") - F.col("spent")).alias("gap")))
    spent = written(spent)
    out = ["doc_id", "mix_key", "tie", "size", "source", "source_size", "target", "starts",
           (F.size("starts") * F.col("size")).cast("long").alias("taken")]
    fill = refilled(q, spent, max_repeat)
    if fill is not None:  # places of rows with words are distinct within a source
        q = q.join(fill, F.col("source").eqNullSafe(F.col("f_source")) & (F.col("done") == F.col("f_done"))
                   & (F.col("size") > 0), "left")
        q = q.withColumn("starts", F.concat("starts", F.coalesce("more", F.array().cast("array<double>"))))
    return q.select(*out)


def mixed_documents(docs: DataFrame, range_sort: bool = True, **kw) -> DataFrame:
    """The mix itself: the columns of ``docs``, one row per copy taken, range
    sorted by virtual finish time."""
    seed = kw.get("seed", SEED)
    idc, txt = kw.get("id_col", "doc_id"), kw.get("text_col", "text")
    plan = (mix(docs, **kw).groupBy(F.col("mix_key").alias("p_key"), F.col("tie").alias("p_tie"),
                                    F.col("source").alias("p_source"))
            .agg(F.count(F.lit(1)).alias("p_rows"),
                 F.array_sort(F.flatten(F.collect_list("starts"))).alias("starts")).where(F.size("starts") > 0))
    k, t, n, v, s = fresh(docs, "mk", "mt", "mn", "mv", "ms")
    d = docs.withColumn(t, text_digest(F.col(f"`{txt}`"))).withColumn(k, mix_key(F.col(t), F.col(f"`{idc}`"), seed))
    d = d.withColumn(s, F.col(f"`{kw.get('source_col', 'source')}`"))
    out = d.join(plan, (F.col(k) == F.col("p_key")) & (F.col(t) == F.col("p_tie"))
                 & F.col(s).eqNullSafe(F.col("p_source")))
    # repeated rows share a key: the n-th of m takes every m-th copy (the window sits on the join's partitioning)
    out = out.withColumn(n, F.row_number().over(Window.partitionBy(k, t, s).orderBy(F.lit(1))) - 1)
    out = out.withColumn("starts", F.filter("starts", lambda x, i: i % F.col("p_rows") == F.col(n)))
    out = out.withColumn(v, F.explode("starts"))
    if range_sort:
        out = out.orderBy(v, k, t)
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def op3_mixing(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs).select("doc_id", "size", "source_size", "target", "taken")


OP3_SQL = r"""
with recursive d as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size,
         md5(coalesce(text, '')) as tie, md5('mix-1|' || coalesce(doc_id::varchar, '-') || '|' || md5(coalesce(text, ''))) as k
  from documents),
s0 as (select source, sum(size)::double as source_size, row_number() over (order by source nulls last) - 1 as rk
       from d group by source),
s1 as (select *, (rk % 3 + 1)::double as w, source_size * 3e0 as cap from s0),
s2 as (select *, cap / w as ratio, sum(source_size) over () as budget from s1),
s3 as (select *, (budget - coalesce(sum(cap) over (order by ratio, rk rows between unbounded preceding and 1 preceding), 0e0))
              / sum(w) over (order by ratio, rk rows between current row and unbounded following) as lv from s2),
s4 as (select *, first_value(case when ratio >= lv then lv end ignore nulls) over (order by ratio, rk
              rows between unbounded preceding and unbounded following) as level from s3),
s as (select source, source_size, case when level is null then cap else least(cap, w * level) end as target from s4),
q as (select d.*, s.source_size, s.target, row_number() over () as nr,
             sum(d.size) over (partition by d.source order by k, tie rows unbounded preceding) as done
      from d join s on d.source is not distinct from s.source),
c as (select nr, source, size, target, done + e * source_size as place from q, (values (0), (1), (2)) t(e)
      where size > 0 and target > 0),
served as (select * from c where place / target <= 1e0),
behind as (select * from c where place / target > 1e0),
gaps as (select s.source, floor(s.target - coalesce(sum(v.size), 0))::bigint as room from s
         left join served v on v.source is not distinct from s.source group by s.source, s.target),
-- the copies behind the cut in queue order, each taken if it fits what the earlier ones left
took(source, room, place) as (
  select source, room, -1e0 from gaps
  union all
  select t.source, t.room - arg_min(b.size, b.place), min(b.place) from took t
  join behind b on b.source is not distinct from t.source and b.place > t.place and b.size <= t.room group by t.source, t.room),
taken as (select nr from served union all
          select b.nr from behind b join took t on t.source is not distinct from b.source and t.place = b.place),
n as (select nr, count(*) as n from taken group by nr)
select q.doc_id, q.size, q.source_size::bigint as source_size, q.target, (coalesce(n, 0) * q.size)::bigint as taken
from q left join n using (nr)
"""
