"""Chat formatting by quotation linking. DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import drop, join_hot, running_total, stage

#: The marks before a line's content, up to the last. No group repeats and no run of blanks is looked at again from each of its
#: places, here and below: a matcher's stack and time stay bounded on any line.
QUOTE_MARKS = r"^([ \t>]*>)"
#: A line that introduces the quotation below it.
ATTRIBUTION = r"(?i)\b(?:wrote|writes|said)\s*:\s*$"


def quote_lines(text: Column) -> Column:
    """The lines of a text: an array of (level, content). The level is the number of `>` marks before the content."""
    marks = lambda line: F.regexp_extract(line, QUOTE_MARKS, 1)
    return F.transform(
        F.split(F.coalesce(text, F.lit("")), "\r\n|\r|\n"),
        lambda line: F.struct(
            F.length(F.regexp_replace(marks(line), "[^>]", "")).alias("level"),
            F.when(line.rlike(QUOTE_MARKS), F.trim(F.regexp_replace(line, QUOTE_MARKS, ""))).otherwise(line).alias("content"),
        ),
    )


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value that is made once, however often `use` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def without_quotes(lines: Column) -> Column:
    """The text of a message's own lines, less those that introduce a quotation, trimmed."""

    def own_text(lines: Column) -> Column:
        quoted_next = lambda i: F.coalesce(F.get(lines, i + 1)["level"] > 0, F.lit(False))
        own = F.filter(lines, lambda x, i: (x.level == 0) & ~(x.content.rlike(ATTRIBUTION) & quoted_next(i)))
        return F.regexp_replace(F.concat_ws("\n", F.transform(own, lambda x: x.content)), r"^\s+|(?<!\s)\s+$", "")

    return _once(lines, own_text)


def normalised(text: Column) -> Column:
    """Lower case, with runs of white space as one space and none at the ends."""
    return F.trim(F.regexp_replace(F.lower(text), r"\s+", " "))


def passages(lines: Column) -> Column:
    """What can be quoted, level by level: an array of (level, size, hash) with each level's whole text, its paragraphs
    and its lines. Where another level stands between, a paragraph ends."""

    def of_level(level: Column) -> Column:
        text = F.concat_ws("\n", F.transform(lines, lambda x: F.when(x.level == level, x.content).otherwise("")))
        parts = _once(text, lambda t: F.flatten(F.array(F.array(t), F.split(t, r"\n\s*\n"), F.split(t, "\n"))))
        parts = F.array_distinct(F.filter(F.transform(parts, normalised), lambda p: p != ""))
        return F.transform(parts, lambda p: F.struct(level.alias("level"), F.length(p).alias("size"), F.xxhash64(p).alias("hash")))

    return F.flatten(F.transform(F.array_distinct(F.transform(lines, lambda x: x.level)), of_level))


def _roots(replies: DataFrame) -> DataFrame:
    """For replies (row, parent): row, root. Each round doubles the way up, so a chain takes a logarithmic number."""
    ways = stage(replies.select("row", F.col("parent").alias("root")))
    while True:
        up = ways.select(F.col("row").alias("root"), F.col("root").alias("higher"))
        up = stage(join_hot(ways, up, "root", "left").select("row", F.coalesce("higher", "root").alias("root"), F.col("higher").isNotNull().alias("moved")))
        drop(ways)
        if up.where("moved").isEmpty():
            return up
        ways = up


def link_quotations(
    messages: DataFrame, *, conversation_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """Rebuild conversations from quotations: one row a message, with conversation_id, turn, role, text (without
    quotations), reply_to (the turn of the message it quotes), root_turn, position (from 0 in its conversation, in reply
    order) and formatted (the turn marked up for training).

    A quotation's whole text, paragraphs and lines are normalised and hashed, as are those of every message's own
    text. In each conversation the first message of a text is its original. A message replies to the earlier original that
    it quotes: at the lowest level that has one, then by the longest passage, then the earliest. Reply order puts threads in
    the order of their first messages, and each thread's messages by turn, so a reply comes after what it answers.

    Nulls: messages of a null conversation form one; a null turn comes first and takes no part in links; a null text is
    empty and a null role is `unknown` in formatted. Repeated rows are messages each; of equal originals in one turn
    either may be taken, which gives the same turns. An empty table gives no rows. Other columns are not looked at.
    """
    rows = messages.select(
        F.col(conversation_col).alias("conversation_id"), F.coalesce(F.concat(F.lit("="), F.col(conversation_col).cast("string")), F.lit("")).alias("key"),
        F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("raw"), F.monotonically_increasing_id().alias("row"),
    )
    rows = stage(rows.withColumn("lines", quote_lines(F.col("raw"))).withColumn("text", without_quotes(F.col("lines"))))
    found = rows.select("key", "turn", "row", F.inline(passages(F.col("lines"))))
    originals = found.where("level = 0 and turn is not null").groupBy("key", "hash").agg(F.min(F.struct("turn", "row")).alias("original"))
    quoted = found.where("level > 0").select("key", "hash", "row", F.col("turn").alias("at"), "level", "size")
    links = quoted.join(originals, ["key", "hash"]).where(F.col("original.turn") < F.col("at"))
    links = links.groupBy("row").agg(F.min(F.struct("level", -F.col("size"), "original")).alias("best"))
    links = stage(links.select("row", F.col("best.original.row").alias("parent"), F.col("best.original.turn").alias("reply_to")))
    roots = _roots(links)
    turns = rows.select(F.col("row").alias("root"), F.col("turn").alias("root_turn"))
    threads = join_hot(roots, turns, "root").join(links, "row").select("row", "reply_to", "root", "root_turn")
    narrow = rows.select("key", "turn", "row").join(threads, "row", "left").select(
        "row", "key", "turn", "reply_to", F.coalesce("root_turn", "turn").alias("root_turn"), F.coalesce("root", "row").alias("root"), F.lit(1).cast("long").alias("one")
    )
    placed = running_total(stage(narrow), ["key"], ["root_turn", "root", "turn", "row"], {"position": "one"})
    out = rows.join(placed.select("row", "reply_to", "root_turn", "position"), "row")
    role = F.coalesce("role", F.lit("unknown"))
    formatted = F.concat(F.lit("<|"), role, F.lit("|>\n"), F.col("text"), F.lit("\n<|end|>\n"))
    return out.select("conversation_id", "turn", "role", "text", "reply_to", "root_turn", "position", formatted.alias("formatted"))
