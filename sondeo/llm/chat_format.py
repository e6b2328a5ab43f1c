"""Chat formatting from event logs, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: The template's control strings.
START, END, NEWLINE = "<|im_start|>", "<|im_end|>\n", "<|nl|>"


def escape(text: Column) -> Column:
    r"""No escaped text holds "<|": a backslash doubles, and "<|" becomes "<\|"."""
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescape(text: Column) -> Column:
    r"""The inverse: runs of backslashes from a text are of even length, so "<\|" with one can only be an escaped "<|"."""
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    """A role ends at the first line feed, so its own ones are written as a control string."""
    return F.replace(escape(role), F.lit("\n"), F.lit(NEWLINE))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit(NEWLINE), F.lit("\n")))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages of a log: conv_id, turn, message, role, text.

    events: conv_id, turn, seq, kind, role, text. By turn and in the order of seq, `message` opens a message, `delta` adds
    text, `edit` replaces the text so far, `regenerate` starts it anew. A delta, edit or regeneration without a message
    opens one. Unknown or null kinds count as `message`; null text is empty; the role is that of the opening event.
    Ties of seq: message first, then regenerate, edit, delta, then by role and text. Two messages of one turn both stay.

    Rows meet by (conv_id, turn), never by conversation, so a conversation with a third of all rows is spread out.
    """
    kind = F.coalesce(F.when(F.col("kind").isin("delta", "edit", "regenerate"), F.col("kind")), F.lit("message"))
    rows = events.select("conv_id", "turn", "seq", kind.alias("kind"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("kind_order", F.expr("array_position(array('message', 'regenerate', 'edit', 'delta'), kind)"))
    order = Window.partitionBy("conv_id", "turn").orderBy("seq", "kind_order", "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("at", F.row_number().over(order))
    rows = rows.withColumn("message", F.sum(F.when((F.col("kind") == "message") | (F.col("at") == 1), 1).otherwise(0)).over(upto))
    rows = rows.withColumn("reset", F.max(F.when(F.col("kind") != "delta", F.col("at"))).over(Window.partitionBy("conv_id", "turn", "message")))
    rows = rows.withColumn("opening", F.min("at").over(Window.partitionBy("conv_id", "turn", "message")))
    live = F.when(F.col("at") >= F.coalesce("reset", "opening"), F.struct("at", "text"))
    return rows.groupBy("conv_id", "turn", "message").agg(
        F.min_by("role", "at").alias("role"),
        F.array_join(F.transform(F.sort_array(F.collect_list(live)), lambda x: x["text"]), "").alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_spans.

    messages: conv_id, turn, message, role, text. A message is START, its escaped role, a line feed, its escaped text and
    END. loss_spans lists the texts of assistant messages as (segment, start, length): segments are what stands after each
    START, counted from 0; start and length count code points.
    """
    role, text = escape_role(F.col("role")), escape(F.col("text"))
    rows = messages.select("conv_id", F.struct("turn", "message", "role", F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END)).alias("out"), (F.length(role) + 1).alias("start"), F.length(text).alias("length")).alias("m"))
    rows = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("m")).alias("m"))
    spans = F.filter(F.transform("m", lambda x, i: F.struct(i.alias("segment"), x["start"].alias("start"), x["length"].alias("length"), (x["role"] == "assistant").alias("learned"))), lambda s: s["learned"])
    return rows.select("conv_id", F.array_join(F.transform("m", lambda x: x["out"]), "").alias("formatted"), F.transform(spans, lambda s: F.struct(s["segment"].alias("segment"), s["start"].alias("start"), s["length"].alias("length"))).alias("loss_spans"))


def parse(formatted: DataFrame) -> DataFrame:
    """Back from render(): conv_id, turns (role, text), learned (unescaped texts under the loss mask), formatted_chars."""
    segments = F.slice(F.split("formatted", r"<\|im_start\|>", -1), F.lit(2), F.lit(2**31 - 1))
    rows = formatted.select("conv_id", "formatted", "loss_spans", segments.alias("segments"))
    role = lambda s: F.substring_index(s, "\n", 1)
    turns = F.transform("segments", lambda s: F.struct(unescape_role(role(s)).alias("role"), unescape(s.substr(F.length(role(s)) + 2, F.length(s) - F.length(role(s)) - 1 - len(END))).alias("text")))
    learned = F.transform("loss_spans", lambda x: unescape(F.get("segments", x["segment"]).substr(x["start"] + 1, x["length"])))
    return rows.select("conv_id", turns.alias("turns"), learned.alias("learned"), F.length("formatted").cast("long").alias("formatted_chars"))


def format_log(events: DataFrame) -> DataFrame:
    """fold_events() and render(). An empty log gives no rows; columns besides those named are not read."""
    return render(fold_events(events))
