"""Chat formatting into budgeted windows, in SQL alone.

Each turn is written as ``<|im_start|>role``, a line break, the text and ``<|im_end|>``.
Inside roles and texts a backslash goes before every backslash and inside every ``<|``, so
control strings cannot occur there and the escape can be undone; in roles line breaks are
escaped as well.

A conversation becomes windows of whole turns. Prefix sums of the turns' tokens choose the
spans: a window's new turns are those whose start falls into the same stretch of
``budget - system - history - longest turn`` tokens, so a window stays within the budget
unless a single turn does not fit it. Each window begins with the system turn, repeats
the last turns before it that fit ``history`` tokens, and then brings its new turns. The
loss covers each assistant text once, in the window where the turn is new.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BUDGET, HISTORY = 2048, 512
START, END = "<|im_start|>", "<|im_end|>\\n"
#: Tokens of a formatted turn: a quarter of its characters, rounded up.
TOKENS = "CAST(ceil(length(turn_text) / 4) AS BIGINT)"

ESCAPE = r"replace(replace({0}, '\\', '\\\\'), '<|', '<\\|')"
UNESCAPE = r"regexp_replace({0}, '(?s)\\\\(.)', '$1')"


def escaped(text: str) -> str:
    return ESCAPE.format(f"coalesce({text}, '')")


def escaped_role(role: str) -> str:
    return f"replace({escaped(role)}, '\\n', '\\\\\\n')"


def unescaped(text: str) -> str:
    return UNESCAPE.format(text)


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """(conv_id, window_no, n_repeated, formatted, loss) of every conversation.

    ``loss`` is an array of (start, size): code points of ``formatted`` from 0 under the
    loss mask. n_repeated counts the leading turns that are not new. Rows are ordered by
    turn (null first), rows that share a turn by role and text; null roles and texts count
    as empty, rows with a null conv_id are one conversation. Other columns are not read.
    A conversation is formatted as a whole, so one task holds a whole conversation.
    """
    in_order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    whole = Window.partitionBy("conv_id")
    head = f"concat('{START}', {escaped_role('role')}, '\\n')"
    turns = conversations.selectExpr(
        "conv_id", "turn", "coalesce(role, '') AS role", "coalesce(text, '') AS text"
    ).selectExpr(
        "conv_id", "turn", "role", "text",
        f"length({head}) AS head", f"length({escaped('text')}) AS size",
        f"concat({head}, {escaped('text')}, '{END}') AS turn_text",
    )
    turns = turns.withColumn("tokens", F.expr(TOKENS)).withColumn("no", F.row_number().over(in_order))
    turns = turns.withColumn("is_system", F.expr("no = 1 AND role = 'system'"))
    before = Window.partitionBy("conv_id").orderBy("no").rowsBetween(Window.unboundedPreceding, -1)
    turns = (
        turns.withColumn("start", F.coalesce(F.sum(F.when(~F.col("is_system"), F.col("tokens"))).over(before), F.lit(0)))
        .withColumn("system", F.max(F.when(F.col("is_system"), F.col("tokens")).otherwise(0)).over(whole))
        .withColumn("longest", F.max(F.when(F.col("is_system"), 0).otherwise(F.col("tokens"))).over(whole))
        .withColumn("span", F.expr(f"start div greatest(1, {budget} - system - {history} - longest)"))
    )
    # The first turn that starts at most ``history`` tokens before this one.
    back = Window.partitionBy("conv_id").orderBy("start").rangeBetween(-history, Window.currentRow)
    turns = turns.withColumn("from_no", F.min(F.when(~F.col("is_system"), F.col("no"))).over(back))
    turns = turns.withColumn("at", F.coalesce(F.sum(F.length("turn_text")).over(before), F.lit(0)))
    turn = F.struct("no", "span", "from_no", "is_system", "role", "at", "head", "size", "turn_text")
    whole_conv = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("t"))
    # One entry per window: its first new turn, and the first turn of the next window.
    opens = whole_conv.selectExpr(
        "conv_id", "t",
        "filter(t, x -> x.no = 1 OR x.span <> t[x.no - 2].span) AS opened",
    )
    rows = opens.selectExpr(
        "conv_id", "t", "posexplode(transform(opened, (x, i) -> named_struct("
        "'new', x.no, 'next', coalesce(get(opened, i + 1).no, size(t) + 1),"
        "'back', CASE WHEN x.no = 1 THEN 1 ELSE coalesce(x.from_no, x.no) END))) AS (window_no, w)",
    )
    rows = rows.selectExpr(
        "conv_id", "window_no", "w.new AS new",
        # Whether the system turn stands before the slice, and the slice.
        "t[0].is_system AND w.new > 1 AS led", "t[0].turn_text AS system_text",
        "slice(t, w.back, w.next - w.back) AS s",
    )
    rows = rows.withColumn("shift", F.expr("IF(led, length(system_text), 0) - s[0].at"))
    return rows.selectExpr(
        "conv_id", "window_no",
        "size(filter(s, x -> x.no < new)) + IF(led, 1, 0) AS n_repeated",
        "concat(IF(led, system_text, ''), array_join(s.turn_text, '')) AS formatted",
        "transform(filter(s, x -> x.role = 'assistant' AND x.no >= new),"
        " x -> named_struct('start', x.at + shift + x.head, 'size', x.size)) AS loss",
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_text, formatted_chars): each conversation back from its windows.

    ``turns`` is an array of (role, text) without the repeated ones, loss_text the text
    under the loss mask, unescaped, in order.
    """
    parsed = windows.selectExpr(
        "conv_id", "window_no", "length(formatted) AS chars",
        # A turn ends at each end mark; the first piece of a role runs to the first
        # line break that is not escaped.
        f"slice(split(formatted, '\\\\Q{END.replace(chr(92) + 'n', '')}\\\\E\\n'), n_repeated + 1, 1000000000) AS pieces",
        "transform(loss, x -> substring(formatted, x.start + 1, x.size)) AS masked",
    )
    role = r"regexp_extract(p, '(?s)^<\\|im_start\\|>((?:[^\\\\\n]++|\\\\.)*+)\n', 1)"
    turns = parsed.selectExpr(
        "conv_id", "window_no", "chars", "masked",
        f"transform(filter(pieces, p -> p <> ''), p -> named_struct('p', p, 'r', {role})) AS pieces",
    ).selectExpr(
        "conv_id", "window_no", "chars", "masked",
        f"transform(pieces, q -> named_struct('role', {unescaped('q.r')}, 'text', "
        f"{unescaped('substring(q.p, length(q.r) + 14)')})) AS turns",
    )
    whole = turns.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("window_no", "turns", "masked"))).alias("w"),
        F.sum("chars").alias("formatted_chars"),
    )
    return whole.selectExpr(
        "conv_id", "flatten(w.turns) AS turns",
        f"array_join(transform(flatten(w.masked), m -> {unescaped('m')}), '') AS loss_text",
        "formatted_chars",
    )
