"""Chat formatting in budgeted windows, in DataFrame functions only.

Each conversation's turns are put into windows of whole turns by prefix sums
of their tokens: with ``step`` half of what the budget leaves beside the
system turn and the history, turns that begin in the same ``step`` share a
window, so its new turns never exceed the budget; a turn longer than
``step`` is a window of its own (``over_budget`` tells where one alone is
more than the budget, as turns are never cut). A window opens with the
system turn in force, then the last turns of the window before it, up to
``history`` tokens; these are context only. The loss mask has every
assistant turn once, in the window where it is new, so repeated targets are
masked out.

A turn is written as ``<|role:NAME|>``, a line end, its text, ``<|end|>`` and
a line end. Control strings inside names and texts (those marks, and the
common ``</s>``, ``[INST]`` and ``<<SYS>>`` kinds) get a backslash after their
first character, and backslashes are doubled, so texts never hold a mark and
are read back as they were.

One shuffle, by conversation; a conversation is sorted and summed up by one
task, which spills, and a window's rows are bounded by its budget.

Defined cases: a null text or role is the empty one; turns are ordered by
number (null first), equal numbers by role and text, and repeated rows stay;
rows without a conversation form one; an empty table gives no window.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

OPEN, NAMED, END = "<|role:", "|>\n", "<|end|>\n"
TURN_TOKENS = 4
# a control string is known by its first character and what follows
_FIRST_OF_CONTROL = r"(<(?=\||/?s>|</?SYS>>)|\[(?=/?INST\])|\|(?=>))"
_ESCAPED_CONTROL = r"(<)\\(?=\||/?s>|</?SYS>>)|(\[)\\(?=/?INST\])|(\|)\\(?=>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), _FIRST_OF_CONTROL, r"$1\\")


def unescape(text: Column) -> Column:
    # of the three groups the two that did not match are empty
    return F.replace(F.regexp_replace(text, _ESCAPED_CONTROL, "$1$2$3"), F.lit("\\\\"), F.lit("\\"))


def count_tokens(text: Column) -> Column:
    """Words and marks, and what a turn's own marks cost."""
    return F.regexp_count(text, F.lit(r"\w+|[^\w\s]")) + TURN_TOKENS


def format_chat(
    turns: DataFrame, *, budget: int = 512, history: int = 128, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
    loss_role: str = "assistant", system_role: str = "system",
) -> DataFrame:
    """One row a window: conv, ``window`` (from 1), ``formatted``,
    ``n_repeated`` (turns at its beginning that are context only),
    ``loss_spans`` (code points of ``formatted``, end excluded), ``n_tokens``
    and ``over_budget``."""
    text, role = F.coalesce(F.col(text_col), F.lit("")), F.coalesce(F.col(role_col), F.lit(""))
    rows = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    rows = rows.withColumn("tokens", count_tokens(F.col("text")).cast("long"))
    lined = Window.partitionBy("conv").orderBy("turn", "role", "text")
    numbered = rows.withColumn("i", F.row_number().over(lined))
    by_i = Window.partitionBy("conv").orderBy("i")
    whole = Window.partitionBy("conv").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = by_i.rowsBetween(Window.unboundedPreceding, -1)
    system = F.when(F.col("role") == system_role, F.struct("text", "tokens"))
    upto = by_i.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = numbered.withColumn("ends", F.sum("tokens").over(upto)).withColumn("starts", F.col("ends") - F.col("tokens"))
    summed = summed.withColumn("in_force", F.last(system, ignorenulls=True).over(before)).withColumn("most", F.coalesce(F.max(system["tokens"]).over(whole), F.lit(0)))
    step = F.greatest(F.lit(1), F.floor((F.lit(budget - history) - F.col("most")) / 2))
    slotted = summed.withColumn("slot", F.floor(F.col("starts") / step)).withColumn("long", F.col("tokens") > step)
    first = (F.col("i") == 1) | (F.col("slot") != F.lag("slot").over(by_i)) | F.col("long") | F.lag("long").over(by_i)
    opened = slotted.withColumn("first", first).withColumn("window", F.sum(F.col("first").cast("long")).over(upto))
    own = Window.partitionBy("conv", "window")
    ended = opened.withColumn("last_end", F.max("ends").over(own)).withColumn("windows", F.max("window").over(whole))

    # where each turn appears: new; as history of the next window; the system turn before a window's first
    place = lambda window, kind, role, text, tokens: F.struct(window.alias("window"), F.lit(kind).alias("kind"), role.alias("role"), text.alias("text"), tokens.alias("tokens"))
    c = F.col
    again = (c("window") < c("windows")) & (c("last_end") - c("starts") <= history) & (c("role") != system_role)
    kept = c("first") & c("in_force").isNotNull()
    places = F.array(
        place(c("window"), 2, c("role"), c("text"), c("tokens")),
        F.when(again, place(c("window") + 1, 1, c("role"), c("text"), c("tokens"))),
        F.when(kept, place(c("window"), 0, F.lit(system_role), c("in_force.text"), c("in_force.tokens"))),
    )
    placed = ended.select("conv", "i", F.explode(F.filter(places, lambda p: p.isNotNull())).alias("p")).select("conv", "i", "p.*")
    head = F.concat(F.lit(OPEN), escape(c("role")), F.lit(NAMED))
    written = placed.withColumn("head", head).withColumn("body", escape(c("text")))
    written = written.withColumn("piece", F.concat("head", "body", F.lit(END)))
    inside = Window.partitionBy("conv", "window").orderBy("kind", "i")
    at = F.coalesce(F.sum(F.length("piece")).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)) + F.length("head")
    target = (c("kind") == 2) & (c("role") == loss_role)
    spanned = written.withColumn("at", at).withColumn("span", F.when(target, F.struct(c("at").alias("start"), (c("at") + F.length("body")).alias("end"))))
    grouped = spanned.groupBy("conv", "window").agg(
        F.array_sort(F.collect_list(F.struct("kind", "i", "piece", "span"))).alias("parts"), F.sum((c("kind") < 2).cast("int")).alias("n_repeated"), F.sum("tokens").alias("n_tokens")
    )
    return grouped.select(
        c("conv").alias(conv_col), "window", F.array_join(F.transform("parts", lambda p: p.piece), "").alias("formatted"), "n_repeated",
        F.filter(F.transform("parts", lambda p: p.span), lambda s: s.isNotNull()).alias("loss_spans"), "n_tokens", (c("n_tokens") > budget).alias("over_budget"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """``windows`` with ``turns`` (role and text of every new turn, parsed
    and unescaped) and ``targets`` (the unescaped text of each loss span)."""
    parts = F.split("formatted", r"<\|end\|>\n")
    new = F.slice(parts, F.col("n_repeated") + 1, F.size(parts) - 1 - F.col("n_repeated"))

    def turn(part: Column) -> Column:
        close = F.instr(part, NAMED)
        name = F.substr(part, F.lit(len(OPEN) + 1), close - F.lit(len(OPEN) + 1))
        return F.struct(unescape(name).alias("role"), unescape(F.substr(part, close + len(NAMED))).alias("text"))

    targets = F.transform("loss_spans", lambda s: unescape(F.substr(F.col("formatted"), (s.start + 1).cast("int"), (s.end - s.start).cast("int"))))
    return windows.withColumn("turns", F.transform(new, turn)).withColumn("targets", targets)


def digest(windows: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """Per conversation, what its windows hold, read back from them."""
    back = read_back(windows)
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    rows = back.select(conv_col, "window", turns.alias("t"), F.array_join("targets", "").alias("l"), F.size("turns").alias("n"), F.length("formatted").alias("chars"))
    held = F.array_sort(F.collect_list(F.struct("window", "t", "l")))
    conv = rows.groupBy(conv_col).agg(held.alias("w"), F.sum("n").cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"))
    joined = lambda name: F.array_join(F.transform("w", lambda x: x[name]), "")
    return conv.select(
        conv_col, "n_turns", F.sha2(joined("t"), 256).alias("turns_sha256"), F.length(joined("l")).cast("long").alias("loss_chars"), F.sha2(joined("l"), 256).alias("loss_sha256"), "formatted_chars"
    )
