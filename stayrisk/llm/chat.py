"""Chat formatting into budgeted windows, in DataFrame functions only.

A conversation's turns are rendered by a template that marks turns and escapes
control strings in roles and texts reversibly. Prefix sums of the turns' tokens
place each turn in the window ``floor((tokens up to its end - 1) / span)``, so
windows are turn-aligned and every turn is the target of exactly one window. A
window shows, in this order: the conversation's system turn (unless it is one
of the window's own turns), as many of the last turns before the window as fit
into ``history`` tokens, and its own turns. Only the assistants' texts among
the own turns are under the loss mask: what is repeated is masked.

``span`` is half of what system turn and history leave of ``budget``: turns of
at most ``span`` tokens give windows within the budget. A longer turn is never
cut; its window is marked ``over_budget``. Tokens are an estimate by characters
(``CHARS_PER_TOKEN``), markers included.

Prefix sums are taken in two levels, within runs of ``RUN`` turn numbers and
over the runs, so a huge conversation does not become one task's sort.

Defined results: a null text or role is empty; rows with a null ``conv_id`` are
the conversation null; turns are ordered by turn (nulls first), then role, then
text, and repeated rows are separate turns; several system turns: the first is
retained. Empty texts are turns too. Other columns are ignored. An empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUDGET, HISTORY, CHARS_PER_TOKEN, RUN = 1024, 192, 4, 256
# The template's markers.
TURN, BODY, END = "<|turn|>", "<|text|>", "<|end|>\n"


def escape(c: Column) -> Column:
    """Break every control string by a backslash after its first character; backslashes are doubled."""
    doubled = F.regexp_replace(c, r"\\", r"\\\\")
    return F.regexp_replace(doubled, r"<(?=\||/?s>)|\[(?=/?INST\])|\|(?=>)", r"$0\\")


def unescape(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(TURN), escape(role), F.lit(BODY), escape(text), F.lit(END))


def turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
          text_col: str = "text") -> DataFrame:
    """``conv_id, seq, role, piece, tokens, upto``: rendered turns in order with the prefix sum of their tokens."""
    rows = conversations.select(
        F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).cast("long").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    piece = render(F.col("role"), F.col("text"))
    rows = rows.withColumn("piece", piece).withColumn("tokens", F.ceil(F.length("piece") / CHARS_PER_TOKEN))
    rows = rows.withColumn("run", F.floor(F.col("turn") / RUN))
    in_run = Window.partitionBy("conv_id", "run").orderBy("turn", "role", "text")
    before = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = rows.groupBy("conv_id", "run").agg(F.sum("tokens").alias("t"), F.count("*").alias("n"))
    runs = runs.select("conv_id", "run", F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"))
    local = rows.withColumn("k", F.row_number().over(in_run)).withColumn(
        "t", F.sum("tokens").over(in_run.rowsBetween(Window.unboundedPreceding, 0)))
    same = local["conv_id"].eqNullSafe(runs["conv_id"]) & local["run"].eqNullSafe(runs["run"])
    return local.join(runs, same).select(
        local["conv_id"], (F.col("n0") + F.col("k") - 1).alias("seq"), "role", "piece", "tokens", (F.col("t0") + F.col("t")).alias("upto"))


def windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, **columns: str) -> DataFrame:
    """One row per window: ``conv_id, window, formatted, loss, n_repeated, n_own, tokens, over_budget``.

    ``loss`` holds ``[start, end)`` code points of ``formatted``; the first
    ``n_repeated`` turns of a window are repeated from earlier ones.
    """
    rows = turns(conversations, **columns).checkpoint()  # read by every branch below
    system = rows.filter(F.col("role") == "system").groupBy(F.col("conv_id").alias("c")).agg(
        F.min_by(F.struct("seq", "piece", "tokens"), "seq").alias("system"))
    # what the system turn leaves; at least an eighth of the budget even beside a huge one
    span = F.greatest(F.floor((F.lit(budget - history) - F.coalesce("t", F.lit(0))) / 2), F.lit(max(1, budget // 8)))
    rows = rows.join(system.select("c", F.col("system.tokens").alias("t")), F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    rows = rows.withColumn("span", span).withColumn("window", F.floor((F.col("upto") - 1) / F.col("span"))).drop("t")
    first = rows.groupBy("conv_id", "window").agg(F.min(F.col("upto") - F.col("tokens")).alias("start"), F.min("seq").alias("first_seq"))
    first = first.join(system, F.col("conv_id").eqNullSafe(F.col("c")), "left").drop("c")
    # a turn may be history of the windows that start within `history` tokens after its start
    last = F.floor((F.col("upto") - F.col("tokens") + history) / F.col("span")) + 1
    past = rows.filter(F.col("tokens") <= history).select(
        "conv_id", "seq", "role", "piece", "tokens", "upto", F.explode(F.sequence(F.col("window") + 1, F.greatest(last, F.col("window") + 1))).alias("window"))
    past = past.alias("p").join(first.alias("f"), F.expr("p.conv_id <=> f.conv_id AND p.window = f.window"))
    past = past.filter((F.col("start") - F.col("upto") + F.col("tokens") <= history) & (F.col("upto") <= F.col("start")))
    past = past.filter("system.seq IS NULL OR p.seq != system.seq")
    shown = ["conv_id", "window", "seq", "role", "piece", "tokens", "own"]
    past = past.select("p.conv_id", "p.window", "p.seq", "p.role", "p.piece", "p.tokens", F.lit(False).alias("own"))
    kept = first.filter("system IS NOT NULL AND system.seq < first_seq").select(
        "conv_id", "window", "system.seq", F.lit("system").alias("role"), "system.piece", "system.tokens", F.lit(False).alias("own"))
    every = rows.withColumn("own", F.lit(True)).select(shown).unionByName(past).unionByName(kept)
    turn = F.struct("seq", "role", "piece", "tokens", "own")
    out = every.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    pieces = F.transform("turns", lambda t: t["piece"])
    # start of each turn in the window, by a running sum over the window's few turns
    starts = F.aggregate(F.transform(pieces, F.length), F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))
    marked = F.filter(F.transform("turns", lambda t, i: F.struct(
        (t["own"] & (t["role"] == "assistant")).alias("learn"),
        (F.element_at(F.col("starts"), i + 1) + F.lit(len(TURN) + len("assistant") + len(BODY))).cast("long").alias("start"),
        (F.element_at(F.col("starts"), i + 2) - F.lit(len(END))).cast("long").alias("end"))), lambda m: m["learn"])
    total = F.aggregate(F.transform("turns", lambda t: t["tokens"]), F.lit(0).cast("long"), lambda a, n: a + n)
    return out.withColumn("starts", starts).select(
        "conv_id", "window", F.array_join(pieces, "").alias("formatted"),
        F.transform(marked, lambda m: F.struct(m["start"].alias("start"), m["end"].alias("end"))).alias("loss"),
        F.size(F.filter("turns", lambda t: ~t["own"])).alias("n_repeated"), F.size(F.filter("turns", lambda t: t["own"])).alias("n_own"),
        total.alias("tokens"), (total > budget).alias("over_budget"))


def read_back(formatted: DataFrame) -> DataFrame:
    """The conversations as the windows tell them: ``conv_id, n_turns, turns, loss, n_windows, formatted_chars``.

    ``turns``: role, line feed, text, line feed of every turn in order;
    ``loss``: the unescaped texts under the loss masks in order. Repeated turns
    are skipped by their number, everything else is parsed from ``formatted``.
    """
    parts = F.split("formatted", F.lit(r"<\|end\|>\n"), -1)
    own = F.slice(parts, F.col("n_repeated") + 1, F.greatest(F.size(parts) - 1 - F.col("n_repeated"), F.lit(0)))

    def told(p: Column) -> Column:
        two = F.split(F.substring(p, len(TURN) + 1, 2**31 - 1), F.lit(r"<\|text\|>"), 2)
        return F.concat(unescape(two[0]), F.lit("\n"), unescape(two[1]), F.lit("\n"))

    learned = F.transform("loss", lambda m: unescape(F.substring("formatted", m["start"].cast("int") + 1, (m["end"] - m["start"]).cast("int"))))
    per = formatted.select("conv_id", "window", F.size(own).alias("n"), F.array_join(F.transform(own, told), "").alias("turns"),
                           F.array_join(learned, "").alias("loss"), F.length("formatted").alias("chars"))
    ordered = F.array_sort(F.collect_list(F.struct("window", "turns", "loss")))
    return per.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), ordered.alias("w"), F.count("*").alias("n_windows"), F.sum("chars").alias("formatted_chars")).select(
        "conv_id", "n_turns", F.array_join(F.transform("w", lambda x: x["turns"]), "").alias("turns"),
        F.array_join(F.transform("w", lambda x: x["loss"]), "").alias("loss"), "n_windows", "formatted_chars")
