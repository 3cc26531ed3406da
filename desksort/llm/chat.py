"""Format conversations into budgeted training windows.

Prefix sums of turn tokens choose spans of whole turns. Each window repeats the
system turn and as many of the turns before it as fit the history budget; what
is repeated is not a target again. Everything is DataFrame functions.

Template: a turn is ``<s>role LF text</s>``, a window is its turns one after the
other. Inside texts and roles each control string (``<s> </s> [INST] [/INST]
<<SYS>> <</SYS>>``, also with backslashes after its bracket) gets one more
backslash after its bracket, so a control string never stands in a text, and
taking one backslash away restores the text. In roles, line feeds and
backslashes are escaped as well.

Budget: a turn costs its words plus ``TURN_COST``. New turns fill cells of half
the budget that is left beside system turn and history, so a window's new turns
cost at most two cells. A turn beyond a cell has a window of its own and is kept
whole, over the budget if need be (``over_budget`` says so).

Defined cases: null texts and roles are empty; turns with equal numbers follow
in the order of role and text, null numbers come first; rows with a null
conv_id are one conversation; only the first turn can be the retained system
turn; an empty assistant text is a target of no characters; no rows give no
rows. Only the named columns are read, so extra columns may have any names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound, word_count

TURN_COST = 3
OPEN, CLOSE = "<s>", "</s>"
PLAIN = r"(<<|<|\[)(\\*)(/?(?:s>|INST\]|SYS>>))"
ESCAPED = r"(<<|<|\[)\\(\\*)(/?(?:s>|INST\]|SYS>>))"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, PLAIN, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def escape_role(role: Column) -> Column:
    safe = F.replace(role, F.lit("\\"), F.lit("\\e"))
    return escape(F.replace(safe, F.lit("\n"), F.lit("\\l")))


def unescape_role(role: Column) -> Column:
    plain = F.replace(unescape(role), F.lit("\\l"), F.lit("\n"))
    return F.replace(plain, F.lit("\\e"), F.lit("\\"))


def _spans(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """Turns with the window each is new in, and where the next two begin."""
    conv = Window.partitionBy("conv_id")
    order = conv.orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    by_window = conv.orderBy("window")
    return (
        turns.withColumn("pos", F.row_number().over(order) - 1)
        .withColumn("is_system", (F.col("pos") == 0) & (F.col("role") == "system"))
        .withColumn("tokens", word_count("text") + word_count("role") + F.lit(TURN_COST))
        .withColumn("system_tokens", F.sum(F.when(F.col("is_system"), F.col("tokens"))).over(conv))
        .withColumn("system_tokens", F.coalesce("system_tokens", F.lit(0)))
        .withColumn("cost", F.when(F.col("is_system"), 0).otherwise(F.col("tokens")))
        .withColumn("start", F.coalesce(F.sum("cost").over(before), F.lit(0)))
        .withColumn(
            "cell_size",
            F.greatest(F.lit(1), F.floor((F.lit(budget - history) - F.col("system_tokens")) / 2)),
        )
        .withColumn("cell", F.floor(F.col("start") / F.col("cell_size")))
        .withColumn("is_long", F.col("cost") > F.col("cell_size"))
        .withColumn(
            "breaks",
            (F.col("pos") > (F.col("system_tokens") > 0).cast("int"))
            & (
                (F.col("cell") != F.lag("cell").over(order))
                | F.col("is_long")
                | F.lag("is_long").over(order)
            ),
        )
        .withColumn("window", F.sum(F.col("breaks").cast("int")).over(order).cast("int"))
        .withColumn("last_window", F.max("window").over(conv))
        .withColumn("start_1", F.min("start").over(by_window.rangeBetween(1, 1)))
        .withColumn("start_2", F.min("start").over(by_window.rangeBetween(2, 2)))
    )


def format_chats(
    conversations: DataFrame,
    budget: int = 1024,
    history: int = 256,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """One row per window: conv_id, window, formatted, n_context (turns at the
    front that are repeated), loss_spans (code point start and length of each
    target in ``formatted``), n_tokens, over_budget."""
    turns = conversations.select(
        F.col(conv_id).alias("conv_id"),
        F.col(turn).alias("turn"),
        F.coalesce(F.col(role), F.lit("")).alias("role"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    # No more than a cell of history: then no turn is repeated further than two
    # windows on, as of three windows in a row one costs more than a cell.
    reach = F.least(F.lit(history), F.col("cell_size"))

    def again(next_start: str, step: int) -> Column:
        near = F.col(next_start) - F.col("start") <= reach
        return F.when(
            near, F.struct((F.col("window") + step).alias("window"), F.lit(True).alias("repeated"))
        )

    new = F.struct(F.col("window"), F.lit(False).alias("repeated"))
    everywhere = F.transform(
        F.sequence(F.lit(0), F.col("last_window")),
        lambda i: F.struct(i.alias("window"), (i > 0).alias("repeated")),
    )
    places = F.when(F.col("is_system"), everywhere).otherwise(
        F.filter(F.array(new, again("start_1", 1), again("start_2", 2)), lambda p: p.isNotNull())
    )
    in_window = Window.partitionBy("conv_id", "window").orderBy("pos")
    placed = (
        _spans(turns, budget, history)
        .withColumn("role_written", escape_role(F.col("role")))
        .withColumn("written", escape(F.col("text")))
        .select(
            "conv_id", "pos", "tokens",
            (F.col("role") == "assistant").alias("is_target"),
            F.concat(F.lit(OPEN), "role_written", F.lit("\n"), "written", F.lit(CLOSE)).alias("piece"),
            (F.length("role_written") + len(OPEN) + 1).alias("lead"),
            F.length("written").alias("length"),
            F.explode(places).alias("place"),
        )
        .select("*", "place.window", "place.repeated")
        .withColumn(
            "offset",
            F.coalesce(
                F.sum(F.length("piece")).over(in_window.rowsBetween(Window.unboundedPreceding, -1)),
                F.lit(0),
            ),
        )
    )
    part = F.struct(
        "pos", "piece", "repeated",
        (F.col("is_target") & ~F.col("repeated")).alias("is_target"),
        (F.col("offset") + F.col("lead")).alias("start"),
        F.col("length").cast("long").alias("length"),
    )
    # A window's turns are bounded by the budget, as each costs TURN_COST.
    grouped = placed.groupBy("conv_id", "window").agg(
        F.array_sort(F.collect_list(part)).alias("parts"), F.sum("tokens").alias("n_tokens")
    )
    return grouped.select(
        "conv_id", "window",
        F.array_join(F.col("parts.piece"), "").alias("formatted"),
        F.size(F.filter("parts", lambda p: p["repeated"])).alias("n_context"),
        F.transform(
            F.filter("parts", lambda p: p["is_target"]),
            lambda p: F.struct(p["start"].alias("start"), p["length"].alias("length")),
        ).alias("loss_spans"),
        "n_tokens",
        (F.col("n_tokens") > budget).alias("over_budget"),
    )


def read_back(windows: DataFrame) -> DataFrame:
    """The new turns and the target texts of each window, out of its text."""
    written = F.split("formatted", CLOSE)
    new = F.slice(written, F.col("n_context") + 1, F.size(written) - 1 - F.col("n_context"))

    def turn(piece: Column) -> Column:
        body = F.substr(piece, F.lit(len(OPEN) + 1))
        return bound(
            body,
            lambda b: bound(
                F.substring_index(b, "\n", 1),
                lambda r: F.struct(
                    unescape_role(r).alias("role"),
                    unescape(F.substr(b, F.length(r) + 2)).alias("text"),
                ),
            ),
        )

    return windows.select(
        "*",
        F.transform(new, turn).alias("turns"),
        F.transform(
            "loss_spans",
            lambda s: unescape(F.substr("formatted", (s["start"] + 1).cast("int"), s["length"].cast("int"))),
        ).alias("targets"),
    )
