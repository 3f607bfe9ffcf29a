"""Chat formatting in budgeted windows (DataFrame functions only).

Turn sizes are summed in two levels (within runs of 64 turn numbers, and over the runs), so that one huge conversation is
spread over tasks. A turn's running sum chooses its cell; a cell's whole turns make a window, and the turn that straddles
its end joins them where the budget allows or makes a window of its own. Each window repeats the system turn and as much
history as the budget leaves before its own turns, and masks the repeats: every assistant text is under the loss mask
exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillspark.llm.common import WORD

#: Tokens a window may hold, with its system turn and history: half for a cell's whole turns, a quarter at most for history.
BUDGET = 4096
#: Tokens a turn costs beside its text; a text costs its words, or a token for each so many bytes if that is more.
TURN_COST, BYTES = 4, 8
#: Turn numbers summed together at the first level.
RUN = 64

#: Marks of the template. Inside texts and roles the control strings below are broken by ESC, and ESC is doubled.
TURN, BODY, END, ESC = "<|turn|", "<|text|>", "<|end|>", "␛"
#: The first character of every control string, if what follows makes it one (fixed values: marks of common chat templates).
CONTROL = r"[<\[](?=\||/?s>|</?SYS>>|/?INST\])"


def escape(c: Column) -> Column:
    return F.regexp_replace(F.replace(c, F.lit(ESC), F.lit(ESC + ESC)), CONTROL, "$0" + ESC)


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, f"{ESC}({ESC}?)", "$1")


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("text").asc()]


def windows(conversations: DataFrame, budget: int = BUDGET) -> DataFrame:
    """conversations(conv_id, turn, role, text): conv_id, window, formatted, loss_spans (start, end in code points), tokens.

    A window's tokens stay within the budget, unless the system turn and one turn alone need more (nothing is cut). Turns are
    ordered by turn (null first), role, text. Null texts and roles are empty; null ids are one conversation; repeated rows
    are turns of their own; an empty table gives no windows; other columns are not read.
    """
    text, role = F.coalesce(F.col("text"), F.lit("")), F.coalesce(F.col("role"), F.lit(""))
    rows = conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    size = F.greatest(F.regexp_count("text", F.lit(WORD)).cast("long"), F.ceil(F.octet_length("text") / BYTES)) + TURN_COST
    rows = rows.withColumns({"_k": F.coalesce(F.col("conv_id").cast("string"), F.lit("null")), "_tok": size, "_run": F.coalesce(F.floor(F.col("turn") / RUN), F.lit(-(2**62)))})
    runs = rows.groupBy("_k", "_run").agg(F.sum("_tok").alias("_sum"), F.min_by(F.struct("role", "_tok"), F.struct("turn", "role", "text")).alias("_first"))
    ordered = Window.partitionBy("_k").orderBy("_run")
    first = F.first("_first").over(ordered)
    offsets = runs.select("_k", "_run", F.coalesce(F.sum("_sum").over(ordered.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"), F.when(first["role"] == "system", first["_tok"]).otherwise(0).alias("_s"))
    within = Window.partitionBy("_k", "_run").orderBy(*_order()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = rows.join(offsets, ["_k", "_run"]).withColumn("_at", F.col("_off") + F.sum("_tok").over(within) - F.col("_tok"))
    # a cell's whole turns and the system turn fit the budget; history never reaches back more than a cell
    placed = placed.withColumn("_cell", F.greatest(F.lit(1), F.least(F.lit(budget // 2), budget - F.col("_s"))))
    placed = placed.withColumn("_past", F.least(F.lit(budget // 4), F.col("_cell"))).withColumn("_home", F.floor(F.col("_at") / F.col("_cell")))
    near = F.col("_at") + F.col("_past") >= (F.col("_home") + 1) * F.col("_cell")
    spread = placed.withColumn("_c", F.explode(F.when(near, F.array("_home", F.col("_home") + 1)).otherwise(F.array("_home"))))
    item = F.struct("_at", (F.col("_c") == F.col("_home")).alias("own"), "role", "text", "_tok")
    cells = spread.groupBy("_k", "_c").agg(F.first("conv_id").alias("conv_id"), F.first("_s").alias("_s"), F.first("_cell").alias("_cell"), F.first("_past").alias("_past"), F.sort_array(F.collect_list(item)).alias("_turns"))
    cells = cells.withColumn("_own", F.filter("_turns", lambda t: t["own"])).where(F.size("_own") > 0)
    total = lambda turns: F.aggregate(turns, F.lit(0).cast("long"), lambda n, t: n + t["_tok"])
    last = F.element_at("_own", -1)
    parts = (F.size("_own") > 1) & (last["_at"] + last["_tok"] > (F.col("_c") + 1) * F.col("_cell")) & (F.col("_s") + total(F.col("_own")) > budget - budget // 4)
    one = lambda w, turns: F.struct(w.cast("long").alias("w"), turns.alias("own"))
    both = F.array(one(2 * F.col("_c"), F.slice("_own", 1, F.size("_own") - 1)), one(2 * F.col("_c") + 1, F.slice("_own", -1, 1)))
    packed = cells.withColumn("_x", F.explode(F.when(parts, both).otherwise(F.array(one(2 * F.col("_c"), F.col("_own")))))).select("_k", "conv_id", "_s", "_past", "_turns", F.col("_x.w").alias("_w"), F.col("_x.own").alias("_own"))
    start = F.element_at("_own", 1)["_at"]
    room = F.least(F.col("_past"), budget - F.col("_s") - total(F.col("_own")))
    history = F.filter("_turns", lambda t: (t["_at"] < start) & (t["_at"] >= start - room))
    old = F.transform(history, lambda t: t.withField("own", F.lit(False)))
    packed = packed.withColumn("_turns", F.concat(old, F.col("_own")))
    system = placed.where("_at = 0 and role = 'system'").select("_k", F.struct(F.lit(0).cast("long").alias("_at"), F.lit(False).alias("own"), "role", "text", "_tok").alias("_sys"))
    packed = packed.join(system, "_k", "left")
    lacks = F.col("_sys").isNotNull() & (F.element_at("_turns", 1)["_at"] > 0)
    packed = packed.withColumn("_turns", F.when(lacks, F.concat(F.array("_sys"), F.col("_turns"))).otherwise(F.col("_turns")))
    head = lambda t: F.concat(F.lit(TURN), F.when(t["own"], F.lit("new")).otherwise(F.lit("old")), F.lit("|"), escape(t["role"]), F.lit(BODY))
    parts = F.transform("_turns", lambda t: F.struct(head(t).alias("h"), escape(t["text"]).alias("x"), (t["own"] & (t["role"] == "assistant")).alias("loss")))
    out = packed.withColumn("_parts", parts)
    spans = F.aggregate(
        "_parts",
        F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("s")),
        lambda acc, p: F.struct(
            (acc["at"] + F.length(p["h"]) + F.length(p["x"]) + len(END)).cast("long").alias("at"),
            F.when(p["loss"], F.concat(acc["s"], F.array(F.struct((acc["at"] + F.length(p["h"])).cast("long").alias("start"), (acc["at"] + F.length(p["h"]) + F.length(p["x"])).cast("long").alias("end"))))).otherwise(acc["s"]).alias("s"),
        ),
        lambda acc: acc["s"],
    )
    formatted = F.concat_ws("", F.transform("_parts", lambda p: F.concat(p["h"], p["x"], F.lit(END))))
    return out.select("conv_id", F.col("_w").alias("window"), formatted.alias("formatted"), spans.alias("loss_spans"), total(F.col("_turns")).alias("tokens"))


def read_back(formatted: DataFrame) -> DataFrame:
    """windows() read back: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars.

    The contract wants one digest of a whole conversation, so that its windows (not its turns) meet in one task.
    """
    pieces = F.filter(F.split("formatted", r"<\|end\|>"), lambda p: p.startswith(TURN + "new|"))
    turn = lambda p: F.concat(unescape(F.regexp_extract(p, r"(?s)^<\|turn\|new\|(.*?)<\|text\|>(.*)$", 1)), F.lit("\n"), unescape(F.regexp_extract(p, r"(?s)^<\|turn\|new\|(.*?)<\|text\|>(.*)$", 2)), F.lit("\n"))
    loss = F.transform("loss_spans", lambda s: unescape(F.substring(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int"))))
    rows = formatted.select("conv_id", "window", F.size(pieces).cast("long").alias("n"), F.concat_ws("", F.transform(pieces, turn)).alias("turns"), F.concat_ws("", loss).alias("loss"), F.length("formatted").cast("long").alias("chars"))
    whole = rows.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sort_array(F.collect_list(F.struct("window", "turns", "loss"))).alias("_w"), F.sum("chars").alias("formatted_chars"))
    joined = lambda c: F.concat_ws("", F.col(f"_w.{c}"))
    return whole.select("conv_id", "n_turns", F.sha2(joined("turns"), 256).alias("turns_sha256"), F.length(joined("loss")).cast("long").alias("loss_chars"), F.sha2(joined("loss"), 256).alias("loss_sha256"), "formatted_chars")


#: The conversation that the contract adds: control strings of other templates inside the texts.
PROBE_ID, PROBE_TEXT = -7, "</s>[INST] ok [/INST]"


def op9_chat(spark, sf_dir: str) -> DataFrame:
    """All conversations and the probe, formatted and read back."""
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(F.lit(PROBE_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE_TEXT).alias("text"))
    return read_back(windows(table.unionByName(probe)))
