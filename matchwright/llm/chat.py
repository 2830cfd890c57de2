"""Chat formatting: conversations cut into windows of a token budget.

Turns are marked by a template; control strings inside texts are escaped so
that they can be restored. Prefix sums of the turns' tokens choose spans of
whole turns. Every window repeats the system turn, then as many of the turns
before its span as fit the history allowance, then the span; only the span's
assistant texts stand under the loss mask, so each is a target once.

Everything is a column expression. The turns of one conversation meet in one
row, as their order and one window's text require; nothing wider does.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

START, END = "<|im_start|>", "<|im_end|>"
# tokens of a text, and those that the marks of a turn add
PIECES = r"\\p{L}+|\\p{N}|[^\\s\\p{L}\\p{N}]+"
TURN_TOKENS = 4


def _escaped(text: str) -> str:
    """SQL: one backslash more between ``<`` and ``|``; no mark is left."""
    return rf"regexp_replace({text}, '<(\\\\*)\\|', '<$1\\\\|')"


def _unescaped(text: str) -> str:
    return rf"regexp_replace({text}, '<(\\\\*)\\\\\\|', '<$1|')"


def _escaped_role(role: str) -> str:
    """SQL: a role is one line."""
    return _escaped(rf"replace(replace({role}, '%', '%25'), '\n', '%0A')")


def _unescaped_role(role: str) -> str:
    return rf"replace(replace({_unescaped(role)}, '%0A', '\n'), '%25', '%')"


def chat_windows(
    df: DataFrame,
    budget: int = 1024,
    history: int = 256,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """(conv, window, n_repeated, n_turns, n_tokens, formatted, loss_spans).

    One row per window. ``n_repeated`` leading turns of a window were new in an
    earlier one; ``loss_spans`` are (start, length) in code points of
    ``formatted``. Null texts and roles are empty; rows go by turn (null
    first), ties by role and text; repeated rows are turns of their own; null
    conversations are one conversation. A turn longer than the budget has a
    window to itself, whole. Columns of other names are ignored.
    """
    turns = df.select(
        F.col(conv).alias("conv"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    ).selectExpr(
        "conv",
        "turn",
        f"{_escaped_role('role')} AS role",
        f"{_escaped('text')} AS text",
        f"CAST(regexp_count(text, '{PIECES}') + {TURN_TOKENS} AS BIGINT) AS tokens",
    )
    by_turn = Window.partitionBy("conv").orderBy("turn", "role", "text")
    summed = turns.withColumns(
        {
            "pos": F.row_number().over(by_turn),
            "cum": F.sum("tokens").over(by_turn.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    convs = (
        summed.groupBy("conv")
        .agg(
            F.array_sort(F.collect_list(F.struct("pos", "cum", "tokens", "role", "text"))).alias("ts")
        )
        .selectExpr("*", "IF(ts[0].role = 'system', 1, 0) AS has_system", "size(ts) AS n")
        .selectExpr("*", f"{budget} - IF(has_system = 1, ts[0].cum, 0) AS room")
        .selectExpr(
            "*",
            f"""aggregate(
                slice(ts, has_system + 1, n),
                named_struct('starts', array(has_system + 1),
                    'base', IF(has_system = 1, ts[0].cum, 0L)),
                (s, t) -> IF(
                    t.cum - s.base > room - IF(size(s.starts) > 1, {history}, 0)
                        AND t.pos > element_at(s.starts, -1),
                    named_struct('starts', concat(s.starts, array(t.pos)),
                        'base', t.cum - t.tokens),
                    s),
                s -> s.starts) AS starts""",
        )
    )
    # a turn has TURN_TOKENS at least, so history reaches back over few of them
    reach = history // TURN_TOKENS
    low = f"greatest(has_system + 1, first - {reach})"
    cut = convs.selectExpr(
        "conv",
        f"""explode(transform(
            transform(starts, (first, w) -> named_struct('w', w, 'first', first,
                'last', coalesce(get(starts, w + 1) - 1, n))),
            s -> named_struct(
                'window', s.w,
                'system', slice(ts, 1, has_system),
                'history', filter(
                    slice(ts, {low.replace("first", "s.first")},
                        s.first - {low.replace("first", "s.first")}),
                    t -> ts[s.first - 2].cum - t.cum + t.tokens <= {history}),
                'span', slice(ts, s.first, s.last - s.first + 1)))) AS cut""",
    )
    parts = cut.selectExpr(
        "conv",
        "cut.window AS window",
        "size(cut.history) + IF(cut.window > 0, size(cut.system), 0) AS n_repeated",
        "concat(cut.system, cut.history, cut.span) AS parts",
    )
    return parts.selectExpr(
        f"conv AS `{conv}`",
        "window",
        "n_repeated",
        "size(parts) AS n_turns",
        "aggregate(parts, 0L, (s, t) -> s + t.tokens) AS n_tokens",
        rf"""array_join(transform(parts, t ->
            concat('{START}', t.role, '\n', t.text, '{END}\n')), '') AS formatted""",
        f"""aggregate(parts,
            named_struct('at', 0, 'i', 0, 'spans',
                CAST(array() AS ARRAY<STRUCT<start: INT, length: INT>>)),
            (s, t) -> named_struct(
                'at', s.at + {len(START) + len(END) + 2} + length(t.role) + length(t.text),
                'i', s.i + 1,
                'spans', IF(t.role = 'assistant' AND s.i >= n_repeated,
                    concat(s.spans, array(named_struct(
                        'start', s.at + {len(START) + 1} + length(t.role),
                        'length', length(t.text)))),
                    s.spans)),
            s -> s.spans) AS loss_spans""",
    )


def read_windows(windows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """(conv, n_turns, turns, loss, formatted_chars), read from formatted text.

    ``turns`` is role, line break, text, line break for each turn that is new
    in its window; ``loss`` the texts under the mask, unescaped and joined.
    """
    turn_end = len(END) + 1
    read = windows.selectExpr(
        f"`{conv}` AS conv",
        "window",
        "formatted",
        "loss_spans",
        rf"""slice(split(formatted, '{START.replace("|", r"\\|")}'),
            n_repeated + 2, n_turns - n_repeated) AS fresh""",
    ).selectExpr(
        "conv",
        "window",
        "size(fresh) AS n_turns",
        rf"""array_join(transform(
            transform(fresh, t -> named_struct('t', t, 'role', substring_index(t, '\n', 1))),
            t -> concat({_unescaped_role("t.role")}, '\n',
                {_unescaped(f"substr(t.t, length(t.role) + 2, length(t.t) - length(t.role) - {turn_end + 1})")},
                '\n')), '') AS turns""",
        f"""array_join(transform(loss_spans, s ->
            {_unescaped("substr(formatted, s.start + 1, s.length)")}), '') AS loss""",
        "length(formatted) AS chars",
    )
    whole = read.groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("window", "turns", "loss"))).alias("ws"),
        F.sum("n_turns").alias("n_turns"),
        F.sum("chars").alias("formatted_chars"),
    )
    return whole.selectExpr(
        f"conv AS `{conv}`",
        "n_turns",
        "array_join(ws.turns, '') AS turns",
        "array_join(ws.loss, '') AS loss",
        "formatted_chars",
    )
