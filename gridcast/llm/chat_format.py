r"""Chat formatting by event-sourced reconstruction (native).

Input is a log of events ``conv_id, seq, kind, msg, role, text``:

* ``message`` opens message ``msg`` with a role and a text;
* ``delta`` appends streamed text to it;
* ``edit`` replaces its text; later deltas append to the new text;
* ``regenerate`` empties it for a new stream, and discards every later
  message that had been opened before.

The fold drops a message's events up to the last regeneration of an earlier message,
keeps what came since its last opening event, and joins the pieces in sequence order;
what comes after such a regeneration makes a new message. Deltas are folded per message before the conversation
is put together, so only final messages meet in the conversation's row; the
windows per conversation are sorts that spill, not collections. One
conversation is one training example and so one row of the output.

Template, per turn: ``[INST] role [/INST]\ntext\n</s>``. In roles and texts
each control string gets a backslash in front (and so does a run of
backslashes before one); :func:`unescape` takes it away again. Template
markers are always preceded by a space or a line break, never by a backslash.
The loss mask lists ``(turn, start, length)`` in code points inside the turn.

Defined cases: a null text or role counts as empty; null conversation ids are
one conversation; events with equal ``seq`` fold in the order of kind and
text; deltas or edits of a message that was never opened, or not since it was discarded, give an empty role;
an unknown kind is ignored; an empty log gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridcast.llm.common import table

CONTROL = r"(</?s>|\[/?INST\]|<</?SYS>>)"
OPEN, CLOSE, END = "[INST] ", " [/INST]\n", "\n</s>"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"(\\*)" + CONTROL, r"\\$1$2")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(\\*)" + CONTROL, r"$1$2")


def fold_events(log: DataFrame) -> DataFrame:
    """Final messages: ``conv_id, msg, role, text``."""
    e = log.select("conv_id", "seq", "kind", "msg", F.coalesce("role", F.lit("")).alias("role"),
                   F.coalesce("text", F.lit("")).alias("text"))
    order = ["seq", "kind", "text"]
    opening = F.col("kind").isin("message", "edit", "regenerate")
    per_msg = Window.partitionBy("conv_id", "msg")
    run = per_msg.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    at = F.struct(*order)
    earlier = Window.partitionBy("conv_id").orderBy("msg").rangeBetween(Window.unboundedPreceding, -1)
    e = (e.where(opening | (F.col("kind") == "delta"))
         .withColumn("cut", F.max(F.when(F.col("kind") == "regenerate", at)).over(earlier))
         .where(F.col("cut").isNull() | (at > F.col("cut")))
         .withColumn("epoch", F.sum(F.when(opening, 1).otherwise(0)).over(run))
         .withColumn("last", F.max("epoch").over(per_msg)))
    # text of the last epoch; role of the message's own opening
    live = F.col("epoch") == F.col("last")
    piece = F.when(live & (F.col("kind") != "regenerate"), F.struct("seq", "kind", "text"))
    return (e.groupBy("conv_id", "msg")
            .agg(F.array_join(F.transform(F.array_sort(F.collect_list(piece)), lambda x: x["text"]), "").alias("text"),
                 F.max_by("role", F.when(F.col("kind") == "message", at)).alias("role"))
            .select("conv_id", "msg", F.coalesce("role", F.lit("")).alias("role"), "text"))


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_mask``."""
    role, text = escape(F.col("role")), escape(F.col("text"))
    m = messages.select("conv_id", "msg", F.concat(F.lit(OPEN), role, F.lit(CLOSE)).alias("head"),
                        text.alias("body"), (F.col("role") == "assistant").alias("learn"))
    m = m.withColumn("piece", F.struct("msg", F.concat("head", "body", F.lit(END)).alias("turn"),
                                       "learn", F.char_length("head").alias("start"),
                                       F.char_length("body").alias("length")))
    g = m.groupBy("conv_id").agg(F.array_sort(F.collect_list("piece")).alias("p"))
    spans = F.filter(F.transform("p", lambda x, i: F.struct(i.alias("turn"), x["start"].alias("start"),
                                                            x["length"].alias("length"), x["learn"].alias("learn"))),
                     lambda x: x["learn"])
    return g.select("conv_id", F.array_join(F.transform("p", lambda x: x["turn"]), "").alias("formatted"),
                    F.transform(spans, lambda x: F.struct(x["turn"], x["start"], x["length"])).alias("loss_mask"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Parse ``formatted`` again: ``conv_id, formatted, turns`` (role, text)
    and ``loss_texts``, the unescaped texts under the loss mask."""
    # END and CLOSE never occur inside escaped text, which has a backslash before the marker
    pieces = F.split(F.col("formatted"), r"\n</s>")
    f = formatted.withColumn("pieces", F.slice(pieces, 1, F.greatest(F.size(pieces) - 1, F.lit(0))))
    head = lambda p: F.substring_index(p, CLOSE, 1)
    turns = F.transform("pieces", lambda p: F.struct(
        unescape(F.substring(head(p), F.lit(len(OPEN) + 1), F.char_length(p))).alias("role"),
        unescape(F.substring(p, F.char_length(head(p)) + len(CLOSE) + 1, F.char_length(p))).alias("text")))
    loss = F.transform("loss_mask", lambda x: unescape(F.substring(
        F.element_at(F.col("pieces"), x["turn"] + 1), x["start"] + 1, x["length"])))
    return f.select("conv_id", "formatted", turns.alias("turns"), loss.alias("loss_texts"))


def conversation_log(rows: DataFrame) -> DataFrame:
    """Event log of whole messages ``conv_id, turn, role, text``: assistant
    rows are opened empty and streamed as one delta, others are complete. Every
    row is a message of its own, in the order of turn, role and text."""
    at = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), "role", "text")
    r = rows.select("conv_id", "role", F.coalesce("text", F.lit("")).alias("text"),
                    F.row_number().over(at).cast("long").alias("msg"))
    whole = F.array(F.struct((F.col("msg") * 2).alias("seq"), F.lit("message").alias("kind"), F.col("text").alias("t")))
    streamed = F.array(F.struct((F.col("msg") * 2).alias("seq"), F.lit("message").alias("kind"), F.lit("").alias("t")),
                       F.struct((F.col("msg") * 2 + 1).alias("seq"), F.lit("delta").alias("kind"),
                                F.col("text").alias("t")))
    return (r.withColumn("e", F.explode(F.when(F.col("role") == "assistant", streamed).otherwise(whole)))
            .select("conv_id", "e.seq", "e.kind", "msg", "role", F.col("e.t").alias("text")))


def format_conversations(rows: DataFrame) -> DataFrame:
    return render(fold_events(conversation_log(rows)))


def op6_chat_format(spark, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
                                  F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
                                  F.lit(probe).alias("text"))
    b = read_back(format_conversations(rows.unionByName(extra)))
    flat = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    b = b.withColumn("loss", F.array_join("loss_texts", ""))
    return b.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
                    F.char_length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
                    F.char_length("formatted").cast("long").alias("formatted_chars"))


OP6_SQL = r"""
with r as (select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e as (select *, '[INST] ' || regexp_replace(role, '(\\*)(</?s>|\[/?INST\]|<</?SYS>>)', '\\\1\2', 'g') || ' [/INST]' || chr(10)
             || regexp_replace(text, '(\\*)(</?s>|\[/?INST\]|<</?SYS>>)', '\\\1\2', 'g') || chr(10) || '</s>' as f from r),
a as (select conv_id, count(*) as n_turns, string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text) as t,
             coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '') as loss,
             sum(length(f))::bigint as formatted_chars from e group by conv_id)
select conv_id, n_turns, sha256(t) as turns_sha256, length(loss)::bigint as loss_chars, sha256(loss) as loss_sha256,
       formatted_chars from a
"""
