"""Chat formatting in budgeted windows.

Prefix sums of turn costs cut a conversation into spans of whole turns. Each span becomes one window:
the conversation's leading system turn, a limited history of the turns just before, then the span. Loss
falls on the span's assistant texts; system and history are repeated and masked, so that each assistant
text is trained on once.

A text's control strings are broken by an escape that can be undone, so marks appear in the output only
where the template sets them.

Windows are built from bounded spans, whatever a conversation's length. Only the running sum and, in
`digests`, a conversation's own digest need one conversation's turns in order in one task.

Costs are tokens: `with_token_costs` counts those of each turn as the template renders it, marks and escapes
included. No estimate stands in for them.

Defined cases: a null text or role is empty; a null conversation id is a conversation like any other;
turns that share a number are ordered by role and text; repeated rows are turns each; a single turn over
the budget is a window of its own; a system turn that leaves no room for others still goes into every window,
each of which then holds one turn more; an empty table gives no windows; further columns are ignored,
whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rowan.llm.bpe import encode_texts

OPEN, MIDDLE, CLOSE = "<|turn|>", "<|says|>", "<|end|>"
#: Costs that a window may hold, and how much of that history may take.
BUDGET = 1024
HISTORY = 128


def escaped(text: Column) -> Column:
    """A backslash after each backslash and each character that begins a control string."""
    return F.regexp_replace(text, r"([\\<\[])", r"$1\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<\[])\\", "$1")


def with_token_costs(turns: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """conv_id, turn, role, text and cost: the tokens of the rendered turn, its marks as plain text.

    Where two turns meet, a window encoded as a whole may merge over the border, so the sum of its
    turns' costs is what it holds or a little more.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    shown = turns.select("conv_id", "turn", "role", "text", _rendered(role, text)["whole"].alias("__shown"))
    coded = encode_texts(shown, ["conv_id", "turn", "role", "text"], ranks_path, pattern, text="__shown")
    return coded.select("row.*", F.size("ids").cast("long").alias("cost"))


def _rendered(role: Column, text: Column) -> Column:
    """One turn in the template, and where its text is."""
    return F.struct(
        F.concat(F.lit(OPEN), escaped(role), F.lit(MIDDLE), escaped(text), F.lit(CLOSE)).alias("whole"),
        F.char_length(F.concat(F.lit(OPEN), escaped(role), F.lit(MIDDLE))).alias("before"),
        F.char_length(escaped(text)).alias("length"),
        (role == "assistant").alias("trained"),
    )


def _laid_out(pieces: Column) -> Column:
    """at (the length of all pieces) and loss: where trained texts begin and end."""
    span = "array<struct<start:int,stop:int>>"
    start = F.struct(F.lit(0).alias("at"), F.array().cast(span).alias("loss"))

    def step(a: Column, p: Column) -> Column:
        begin = a["at"] + p["before"]
        mark = F.struct(begin.alias("start"), (begin + p["length"]).alias("stop"))
        loss = F.when(p["trained"], F.array_append(a["loss"], mark)).otherwise(a["loss"])
        return F.struct((a["at"] + F.char_length(p["whole"])).alias("at"), loss.alias("loss"))

    return F.aggregate(pieces, start, step)


def chat_windows(
    turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, cost: str = "cost"
) -> DataFrame:
    """turns: conv_id, turn, role, text and a column of costs. Gives conv_id, window (from 0), formatted, new_from (where the
    window's own turns begin), loss (stretches of characters trained on), n_new and cost."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.col(cost).cast("long").alias("c"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = rows.withColumn("n", F.row_number().over(order)).withColumn(
        "system", (F.col("n") == 1) & (F.col("role") == "system")
    )
    conversation = Window.partitionBy("conv_id").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    summed = placed.withColumns(
        {
            "head": F.first(F.when(F.col("system"), F.struct("role", "text")), ignorenulls=True).over(conversation),
            "head_cost": F.sum(F.when(F.col("system"), F.col("c")).otherwise(0)).over(conversation),
            "stop": F.sum(F.when(F.col("system"), 0).otherwise(F.col("c"))).over(conversation),
        }
    ).withColumn("start", F.col("stop") - F.when(F.col("system"), 0).otherwise(F.col("c")))
    room = F.greatest(F.lit(budget - history) - F.col("head_cost"), F.lit(1))
    part = F.floor(F.col("start") / room)
    # A turn that reaches over a border of its part is a span of its own; so no span exceeds its room
    # unless a single turn does.
    crosses = F.col("stop") > (part + 1) * room
    joins = F.coalesce(F.lead(crosses).over(Window.partitionBy("conv_id").orderBy("n")), F.lit(False))
    before = Window.partitionBy("conv_id").orderBy("start").rangeBetween(-history, -1)
    # The system turn goes with the turn after it.
    alone = F.when(F.col("system"), joins).otherwise(crosses)
    spans = summed.withColumns({"part": part, "crosses": alone}).withColumn(
        "past", F.collect_list(F.when(~F.col("system"), F.struct("n", "role", "text"))).over(before)
    )
    turn = F.struct("n", "role", "text", "system")
    first = F.struct("start", "n")
    grouped = spans.groupBy("conv_id", "part", "crosses").agg(
        F.sort_array(F.collect_list(turn)).alias("own"),
        F.min("n").alias("first"),
        F.min_by("past", first).alias("past"),
        F.first("head", ignorenulls=True).alias("head"),
        F.sum("c").alias("own_cost"),
    )
    numbered = grouped.withColumn(
        "window", F.row_number().over(Window.partitionBy("conv_id").orderBy("first")).cast("int") - 1
    )
    return _formatted(numbered)


def _formatted(windows: DataFrame) -> DataFrame:
    masked = lambda p: p.withField("trained", F.lit(False))
    said = lambda t: _rendered(t["role"], t["text"])
    again = F.when(
        (F.col("window") > 0) & F.col("head").isNotNull(),
        F.array(masked(_rendered(F.col("head.role"), F.col("head.text")))),
    )
    shown = windows.select(
        "conv_id",
        "window",
        "own_cost",
        F.size("own").alias("n_new"),
        F.transform("own", said).alias("own"),
        F.concat(
            F.coalesce(again, F.array()), F.transform(F.sort_array("past"), lambda t: masked(said(t)))
        ).alias("repeated"),
    )
    joined = shown.select("*", F.concat("repeated", "own").alias("pieces"))
    laid = joined.withColumns(
        {
            "formatted": F.array_join(F.transform("pieces", lambda p: p["whole"]), ""),
            "new_from": F.char_length(F.array_join(F.transform("repeated", lambda p: p["whole"]), "")),
            "loss": _laid_out(F.col("pieces"))["loss"],
        }
    )
    return laid.select("conv_id", "window", "formatted", "new_from", "loss", "n_new", F.col("own_cost").alias("cost"))


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted stretch as role and text, escapes undone."""
    whole = F.filter(F.split(formatted, r"<\|end\|>"), lambda s: s != "")

    def parsed(shown: Column) -> Column:
        parts = F.split(shown, r"<\|says\|>")
        role = F.substr(parts[0], F.lit(len(OPEN) + 1))
        return F.struct(unescaped(role).alias("role"), unescaped(parts[1]).alias("text"))

    return F.transform(whole, parsed)


def digests(windows: DataFrame) -> DataFrame:
    """What the windows hold, read back from them, by conversation."""
    new = F.expr("substring(formatted, new_from + 1)")
    part = lambda s: F.substr(F.col("formatted"), s["start"] + 1, s["stop"] - s["start"])
    lost = F.transform("loss", lambda s: unescaped(part(s)))
    back = windows.select(
        "conv_id",
        "window",
        F.char_length("formatted").cast("long").alias("chars"),
        read_turns(new).alias("turns"),
        F.array_join(lost, "").alias("lost"),
    )
    told = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    window = F.struct("window", told.alias("told"), "lost").alias("w")
    pieces = back.select("conv_id", "chars", F.size("turns").alias("n"), window)
    gathered = pieces.groupBy("conv_id").agg(
        F.sum("n").cast("long").alias("n_turns"),
        F.sort_array(F.collect_list("w")).alias("w"),
        F.sum("chars").alias("formatted_chars"),
    )
    loss = F.array_join("w.lost", "")
    return gathered.select(
        "conv_id",
        "n_turns",
        F.sha2(F.array_join("w.told", ""), 256).alias("turns_sha256"),
        F.char_length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
