"""Chat formatting into budgeted, turn-aligned training windows, as Column expressions.

Template: each turn is ``### Role:\\n`` + text + ``</turn>\\n``. Inside roles and texts a backslash
becomes ``\\\\``, ``#`` becomes ``\\h`` and ``</turn>`` becomes ``\\l/turn>`` (roles also escape ``:`` and
line feeds), so no text can look like a control string, and ``unescape`` restores it exactly.

Windows come from prefix sums of turn tokens: a window starts where the last one ends and takes turns, in order, as long as they fit into
``tokens`` beside what it repeats: the conversation's system turn, where that has at most ``system_tokens``, and before the first new turn
up to ``history_turns`` earlier turns of ``history_tokens`` in all. So no window is above its budget, but for one case: a turn that is
larger than the budget is never cut and is a window alone. Where a window's first new turn doesn't fit beside the repeated ones, the history is left
out, then the system turn. Repeated turns stay outside the loss mask, so each assistant text is a target once.

Defined results: turns sort by turn (null first), then role and text; a null role or text is empty; a null
conv_id is a conversation of its own; repeated rows are turns of their own; an empty table gives an empty
result; extra columns are ignored. One shuffle, by conversation: prefix sums stream over sorted turns and spill. Spans are
chosen within blocks of ``block`` budgets of a conversation's tokens, so what is gathered in memory is bounded by the rule (or one turn)
however long a conversation is; a window ends with its block.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import WORD

END = "</turn>\n"


@dataclass(frozen=True)
class Budget:
    """Tokens are words plus a fixed overhead for each turn's markers. system_tokens and history_tokens: the most that is repeated."""

    tokens: int = 2048
    history_tokens: int = 512
    history_turns: int = 2
    system_tokens: int = 1024
    overhead: int = 4
    block: int = 16


def escape(c: Column) -> Column:
    for plain, code in (("\\", "\\\\"), ("#", "\\h"), ("</turn>", "\\l/turn>")):
        c = F.replace(c, F.lit(plain), F.lit(code))
    return c


def escape_role(c: Column) -> Column:
    for plain, code in ((":", "\\c"), ("\n", "\\n")):
        c = F.replace(escape(c) if plain == ":" else c, F.lit(plain), F.lit(code))
    return c


def unescape(c: Column) -> Column:
    """A run of backslashes starts at a code's first character, so pairs taken from the left are escaped backslashes."""

    def part(x: Column) -> Column:
        for plain, code in (("#", "\\h"), ("<", "\\l"), (":", "\\c"), ("\n", "\\n")):
            x = F.replace(x, F.lit(code), F.lit(plain))
        return x

    return F.when(F.instr(c, "\\") == 0, c).otherwise(F.array_join(F.transform(F.split(c, r"\\\\", -1), part), "\\"))


def windows(df: DataFrame, budget: Budget = Budget()) -> DataFrame:
    """conv_id, window (number of its first new turn), n_repeated, n_new, tokens, formatted, loss (spans of code points, ends exclusive)."""
    empty, deep = F.lit(""), budget.history_turns
    t = df.select("conv_id", "turn", F.coalesce("role", empty).alias("role"), F.coalesce("text", empty).alias("text"))
    t = t.withColumn("tokens", F.regexp_count("text", F.lit(WORD)).cast("long") + budget.overhead)
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    one = F.struct("role", "text", "tokens")
    t = t.select(
        "conv_id", "role", "text", "tokens", F.row_number().over(order).alias("idx"), F.sum("tokens").over(upto).alias("stop"),
        *[F.lag(one, k).over(order).alias(f"back{k}") for k in range(1, deep + 1)], F.first(one).over(upto).alias("head"),
    )
    block = lambda begin: F.floor(begin / F.lit(budget.block * budget.tokens))
    t = t.withColumn("block", block(F.col("stop") - F.col("tokens")))

    # What a window that starts at this turn repeats: nearest turns first, while they fit, and the system turn once.
    system = (F.col("head.role") == "system") & (F.col("idx") > 1)
    used, held, fits, count = F.lit(0).cast("long"), F.lit(0).cast("long"), F.lit(True), F.lit(0)
    for k in range(1, deep + 1):
        back = F.col(f"back{k}")
        used = used + F.coalesce(back["tokens"], F.lit(0))
        fits = fits & back.isNotNull() & (used <= budget.history_tokens) & ~(system & (F.col("idx") - k == 1))
        held, count = F.when(fits, used).otherwise(held), F.when(fits, F.lit(k)).otherwise(count)
    kept = F.when(system & (F.col("head.tokens") <= budget.system_tokens), F.col("head.tokens")).otherwise(F.lit(0).cast("long"))
    t = t.withColumns({"kept": kept, "held": held, "n_back": count})
    both, alone = F.col("tokens") + F.col("kept") + F.col("held") <= budget.tokens, F.col("tokens") + F.col("kept") <= budget.tokens
    t = t.withColumns({"n_back": F.when(both, F.col("n_back")).otherwise(0), "held": F.when(both, F.col("held")).otherwise(F.lit(0).cast("long")), "kept": F.when(both | alone, F.col("kept")).otherwise(F.lit(0).cast("long"))})
    # Turns of the block before are carried only where a window may still reach back to them.
    earlier = sum((F.coalesce(F.col(f"back{k}.tokens"), F.lit(0)) for k in range(1, deep + 1)), F.lit(0).cast("long"))
    near_edge = (F.col("idx") <= deep) | (block(F.col("stop") - F.col("tokens") - earlier) != F.col("block"))
    backs = F.array(*[F.struct(F.col(f"back{k}.role").alias("role"), F.col(f"back{k}.text").alias("text")) for k in range(deep, 0, -1)])
    t = t.withColumn("backs", F.when(near_edge, backs))

    g = t.groupBy("conv_id", "block").agg(
        F.array_sort(F.collect_list(F.struct("idx", "tokens", "kept", "held", "n_back", "role", "text", "backs"))).alias("turns"),
        F.first(F.struct("head.role", "head.text")).alias("head"),
    )
    starts = F.expr(
        f"aggregate(turns, named_struct('used', {budget.tokens + 1}L, 'at', cast(array() as array<int>), 'k', 1, 'sums', cast(array() as array<bigint>)), (a, x) -> named_struct("
        f"'used', IF(a.used + x.tokens > {budget.tokens}, x.kept + x.held, a.used) + x.tokens, "
        f"'at', IF(a.used + x.tokens > {budget.tokens}, array_append(a.at, a.k), a.at), 'k', a.k + 1, "
        f"'sums', IF(a.used + x.tokens > {budget.tokens} AND a.k > 1, array_append(a.sums, a.used), a.sums)))"
    )
    g = g.withColumn("s", starts)
    cut = F.expr(
        "transform(s.at, (p, k) -> named_struct('first', turns[p - 1], 'tokens', coalesce(get(s.sums, k), s.used), 'new', slice(turns, p, coalesce(get(s.at, k + 1), size(turns) + 1) - p), "
        "'back', IF(p > turns[p - 1].n_back, transform(slice(turns, greatest(p - turns[p - 1].n_back, 1), turns[p - 1].n_back), x -> named_struct('role', x.role, 'text', x.text)), "
        f"slice(turns[p - 1].backs, {deep} - turns[p - 1].n_back + 1, turns[p - 1].n_back))))"
        if deep else
        "transform(s.at, (p, k) -> named_struct('first', turns[p - 1], 'tokens', coalesce(get(s.sums, k), s.used), 'new', slice(turns, p, coalesce(get(s.at, k + 1), size(turns) + 1) - p), "
        "'back', cast(array() as array<struct<role:string,text:string>>)))"
    )
    g = g.select("conv_id", "head", F.explode(cut).alias("w"))
    piece = lambda x, new: F.struct(x["role"].alias("role"), x["text"].alias("text"), F.lit(new).alias("new"))
    system_turn = F.when(F.col("w.first.kept") > 0, F.array(piece(F.col("head"), False))).otherwise(F.array().cast("array<struct<role:string,text:string,new:boolean>>"))
    before = F.concat(system_turn, F.transform("w.back", lambda x: piece(x, False)))
    g = g.select(
        "conv_id", F.col("w.first.idx").cast("long").alias("window"), F.size(before).alias("n_repeated"), F.size("w.new").alias("n_new"), F.col("w.tokens").alias("tokens"),
        F.concat(before, F.transform("w.new", lambda x: piece(x, True))).alias("all"),
    )
    parts = F.transform(
        "all",
        lambda x: F.struct(
            F.concat(F.lit("### "), escape_role(x["role"]), F.lit(":\n")).alias("header"),
            escape(x["text"]).alias("body"), (x["new"] & (x["role"] == "assistant")).alias("target"),
        ),
    )
    g = g.select("conv_id", "window", "n_repeated", "n_new", "tokens", parts.alias("parts"))
    spans = F.expr(
        f"aggregate(parts, named_struct('pos', 0L, 'out', cast(array() as array<struct<start:bigint,end:bigint>>)), (a, x) -> named_struct("
        f"'pos', a.pos + length(x.header) + length(x.body) + {len(END)}, 'out', IF(x.target, concat(a.out, array(named_struct("
        f"'start', a.pos + length(x.header), 'end', a.pos + length(x.header) + length(x.body)))), a.out))).out"
    )
    text = F.array_join(F.transform("parts", lambda x: F.concat(x["header"], x["body"], F.lit(END))), "")
    return g.select("conv_id", "window", "n_repeated", "n_new", "tokens", text.alias("formatted"), spans.alias("loss"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The conversations as the windows hold them: one row of digests for each conversation.

    A digest needs all of a conversation's text in one value, so this, unlike ``windows``, gathers conversations.
    """
    pieces = F.slice(F.split("formatted", END, -1), F.col("n_repeated") + 1, F.col("n_new"))
    turn = lambda x: F.concat(
        unescape(F.substring_index(x, ":\n", 1).substr(F.lit(5), F.lit(2**31 - 1))), F.lit("\n"),
        unescape(x.substr(F.instr(x, ":\n") + 2, F.lit(2**31 - 1))), F.lit("\n"),
    )
    target = lambda s: unescape(F.substring("formatted", (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
    w = formatted.select(
        "conv_id", "window", F.transform(pieces, turn).alias("turns"), F.array_join(F.transform("loss", target), "").alias("loss_text"), F.length("formatted").alias("chars"),
    ).select("conv_id", "chars", F.size("turns").alias("n"), F.struct("window", F.array_join("turns", "").alias("turns"), F.col("loss_text")).alias("w"))
    g = w.groupBy("conv_id").agg(F.sum("n").cast("long").alias("n_turns"), F.array_sort(F.collect_list("w")).alias("ws"), F.sum("chars").cast("long").alias("formatted_chars"))
    g = g.select("conv_id", "n_turns", F.array_join("ws.turns", "").alias("turns"), F.array_join("ws.loss_text", "").alias("loss_text"), "formatted_chars")
    return g.select(
        "conv_id", "n_turns", F.sha2(F.col("turns").cast("binary"), 256).alias("turns_sha256"), F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )
