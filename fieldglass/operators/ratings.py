"""Rating histories from compact event logs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fieldglass.operators.relational import densify
from fieldglass.staging import carry, drop, running_total, stage

#: The log's tokens. A match moves points from the second team to the first, a rename moves a rating to
#: another code (`XX`: the team is dissolved), an adjustment adds points.
MATCH, RENAME, ADJUST = r"[A-Z]{2}[A-Z]{2}-?\d+", r"[A-Z]{2}[A-Z]{2}(?!-?\d)", r"[A-Z]{2}-?\d+"
GONE = "XX"
#: Lives of codes that are sent to all tasks; more are joined by a shuffle.
FEW_LIVES = 100_000


def parse_log(lines: DataFrame, line_no: str = "line_no", text: str = "value") -> DataFrame:
    """Events (seq, month, kind, a, b, points) of lines whose date prefix (YYYYMMDD, MMDD or DD) inherits from the lines
    before what it leaves out. Tokens are read from the left up to the first that can't be. What a line inherits is carried from
    task to task; line numbers tell lines apart."""
    line = F.trim(F.col(text))
    digits = F.regexp_extract(line, r"^(\d*)", 1)
    full, short = F.length(digits) >= 8, F.length(digits).between(3, 4)
    year = F.when(full, F.substring(digits, 1, 4).cast("int"))
    month = F.when(full, F.substring(digits, 5, 2).cast("int")).when(short, F.expr("CAST(left(d, length(d) - 2) AS INT)"))
    #: Each token begins where the one before ended, so no group repeats: on that a matcher's stack grows with the line.
    found = F.regexp_extract_all(line, F.lit(rf"(?:^\d*|\G(?!^))({MATCH}|{RENAME}|{ADJUST})"), F.lit(1))
    rows = lines.where(F.length(line) > 0).withColumn("d", digits).select(line_no, found.alias("found"), year.alias("own year"), month.alias("own month"))
    rows = carry(rows, [], [line_no], {"y": "own year", "m": "own month"})
    tokens = rows.select(line_no, F.make_date("y", "m", F.lit(1)).alias("month"), F.posexplode("found").alias("place", "token"))
    kind = F.when(F.col("token").rlike(f"^{MATCH}$"), "match").when(F.col("token").rlike("^[A-Z]{4}$"), "rename").otherwise("adjust")
    points = F.regexp_extract("token", r"(-?\d+)$", 1).try_cast("long")
    return tokens.select(F.struct(F.col(line_no).alias("line"), "place").alias("seq"), "month", kind.alias("kind"), F.substring("token", 1, 2).alias("a"), F.when(kind != "adjust", F.substring("token", 3, 2)).alias("b"), points.alias("points"))


def lives(moves: DataFrame, renames: DataFrame) -> DataFrame:
    """The lives of codes that renames touch: (code, since, lineage, alive). A code's life goes from one rename that it takes part
    in to the next; `since` is the seq of the rename that begins it (null for the first). `alive` tells whether it holds a
    rating at its end, and `lineage` names the rating that it holds, which renames hand from life to life.

    `moves` (code, seq, delta) and `renames` (seq, a, b) are staged. A rename of a code that holds no rating does nothing, so
    whether a life begins with another's rating depends on whether that one is alive: on a move in it, or on what it began
    with in turn. That spreads in rounds, as many as renames follow upon each other without a move between. A life hands its
    rating to one other at most, so that lineages are chains, joined up by pointer doubling.
    """
    real = renames.where("a <> b")
    #: Each rename cuts its first code's life, which ends, and (unless it dissolves) its second's.
    cuts = real.select(F.col("a").alias("code"), "seq", F.lit(None).cast("string").alias("taken")).unionByName(real.where(F.col("b") != GONE).select(F.col("b").alias("code"), "seq", F.col("a").alias("taken")))
    cuts = stage(cuts)
    touched = moves.join(cuts.select("code").distinct(), "code", "left_semi").select("code", "seq", F.lit(None).cast(cuts.schema["seq"].dataType).alias("cut"))
    scanned = touched.withColumn("kind", F.lit(1)).unionByName(cuts.select("code", "seq", F.col("seq").alias("cut")).withColumn("kind", F.lit(0)))
    played = carry(scanned, ["code"], ["seq", "kind"], {"since": "cut"}).where("kind = 1").select("code", "since").distinct()
    #: Of a cut: the life that it begins, the code's life before it, and the life of the code that it takes over.
    before = carry(cuts.select("code", "seq", F.col("seq").alias("cut"), "taken"), ["code"], ["seq"], {"previous": "cut"}, own=False)
    of_taken = before.where("taken is null").select(F.col("code").alias("taken"), "seq", F.col("previous").alias("taken since"))
    born = before.join(of_taken, ["taken", "seq"], "left").select(_life("code", "seq").alias("life"), _life("code", "previous").alias("previous"), F.when(F.col("taken").isNotNull(), _life("taken", "taken since")).alias("from"))
    first = cuts.select("code").distinct().select(_life("code", F.lit(None)).alias("life"), F.lit(None).cast("string").alias("previous"), F.lit(None).cast("string").alias("from"))
    every = born.unionByName(first).join(played.select(_life("code", "since").alias("life"), F.lit(True).alias("own")), "life", "left")
    every = stage(every.withColumn("alive", F.coalesce("own", F.lit(False))))
    while True:  # what is alive makes alive whatever begins with it
        heirs = every.where("not alive and from is not null").select("life", F.explode(F.array("from", "previous")).alias("other"))
        more = stage(heirs.join(every.where("alive").select(F.col("life").alias("other")), "other", "left_semi").select("life").distinct().withColumn("now", F.lit(True)))
        if more.isEmpty():
            break
        old, every = every, stage(every.join(more, "life", "left").withColumn("alive", F.col("alive") | F.coalesce("now", F.lit(False))).drop("now"))
        drop(old)
    of = lambda c, out: every.select(F.col("life").alias(c), F.col("alive").alias(out))
    chains = every.join(of("from", "from alive"), "from", "left").join(of("previous", "previous alive"), "previous", "left")
    #: A life that begins by another's end begins with nothing.
    parent = F.when(F.col("from").isNull(), F.lit(None)).when(F.col("from alive"), F.col("from")).when(F.col("previous alive"), F.col("previous"))
    chains = stage(chains.select("life", "alive", F.coalesce(parent, "life").alias("root")))
    while True:
        jumps = chains.select(F.col("life").alias("root"), F.col("root").alias("further"))
        longer = stage(chains.join(jumps, "root").select("life", "alive", F.col("further").alias("root"), (F.col("further") != F.col("root")).alias("moved")))
        drop(chains)
        chains = longer.drop("moved")
        if longer.where("moved").isEmpty():
            break
    names = cuts.select("code", F.col("seq").alias("since")).unionByName(cuts.select("code", F.lit(None).cast(cuts.schema["seq"].dataType).alias("since"))).distinct()
    return names.withColumn("life", _life("code", "since")).join(chains, "life").select("code", "since", "life", F.col("root").alias("lineage"), "alive")


def _life(code: str, since):
    since = F.col(since) if isinstance(since, str) else since
    return F.concat_ws(" ", F.col(code), F.coalesce(since.cast("string"), F.lit("first")))


def month_ends(events: DataFrame) -> DataFrame:
    """(code, month, rating) at the end of each month in which a code changed; a null rating means that it is gone.

    Points add up by the rating that they move: a running sum over the lineage of the code's life at that time (see `lives`),
    which for a code that no rename touches is the code itself. `events` is staged. A game of a code with itself moves nothing.
    """
    side = lambda code, delta, n: F.struct(F.col(code).alias("code"), delta.alias("delta"), F.lit(n).alias("side"))
    both = F.explode(F.array(side("a", F.col("points"), 0), side("b", -F.col("points"), 1)))
    moves = events.where("kind <> 'rename'").select("seq", "month", both.alias("s")).select(F.struct("seq.line", "seq.place", "s.side").alias("seq"), "month", "s.code", "s.delta").where("code is not null")
    moves = stage(moves.withColumn("delta", F.coalesce("delta", F.lit(0)).cast("long")))
    renames = stage(events.where("kind = 'rename'").select(F.struct("seq.line", "seq.place", F.lit(0).alias("side")).alias("seq"), "month", "a", "b"))
    if renames.isEmpty():
        scored = running_total(moves, ["code"], ["seq"], {"before": "delta"})
        changes = scored.select("code", "month", "seq", (F.col("before") + F.col("delta")).alias("rating"))
        return changes.groupBy("code", "month").agg(F.max_by("rating", "seq").alias("rating"))
    found = stage(lives(moves, renames))
    real = renames.where("a <> b")
    nothing = F.lit(None).cast(renames.schema["seq"].dataType)
    #: Moves with the cuts of their code, so that each knows the life it falls in; a cut is a move by nothing in the life it begins.
    ends = real.select("seq", "month", F.col("a").alias("code")).unionByName(real.where(F.col("b") != GONE).select("seq", "month", F.col("b").alias("code")))
    rows = moves.select("code", "seq", "month", "delta", nothing.alias("cut")).unionByName(ends.select("code", "seq", "month", F.lit(0).cast("long").alias("delta"), F.col("seq").alias("cut")))
    rows = carry(rows.withColumn("kind", F.when(F.col("cut").isNull(), 1).otherwise(0)), ["code"], ["seq", "kind"], {"since": "cut"})
    rows = rows.withColumn("life", _life("code", "since")).join(F.broadcast(found.select("life", "lineage")) if found.count() <= FEW_LIVES else found.select("life", "lineage"), "life", "left")
    rows = stage(rows.select("code", "seq", "month", "delta", "kind", "since", F.coalesce("lineage", F.concat(F.lit("="), "code")).alias("lineage")))
    scored = running_total(rows, ["lineage"], ["seq", "kind"], {"before": "delta"})
    scored = scored.select("code", "month", "seq", "kind", "since", (F.col("before") + F.col("delta")).alias("rating"))
    #: What a rename did depends on whether its first code held a rating just then: that life is named by the cut before.
    first = carry(ends.select("code", "seq", F.col("seq").alias("cut")), ["code"], ["seq"], {"previous": "cut"}, own=False)
    held = first.select("code", "seq", _life("code", "previous").alias("life")).join(found.select("life", "alive"), "life").where("alive").select(F.col("code").alias("a"), "seq")
    done = real.join(held, ["a", "seq"], "left_semi")
    gone = done.select(F.col("a").alias("code"), "month", "seq", F.lit(None).cast("long").alias("rating"))
    handed = scored.where("kind = 0").join(done.where(F.col("b") != GONE).select(F.col("b").alias("code"), "seq"), ["code", "seq"], "left_semi").select("code", "month", "seq", "rating")
    changes = reduce(DataFrame.unionByName, [scored.where("kind = 1").select("code", "month", "seq", "rating"), gone, handed])
    last = F.max_by(F.struct("rating"), "seq")
    return changes.groupBy("code", "month").agg(last.alias("last")).select("code", "month", "last.rating")


def rating_history(lines: DataFrame, line_no: str = "line_no", text: str = "value") -> DataFrame:
    """(code, month, rating) for every month from a code's first to the log's last, as long as the code exists."""
    ends = stage(month_ends(stage(parse_log(lines, line_no, text))))  # the log is read once
    dense = densify(ends.select("code", "month", F.struct("rating").alias("held")), "code", "month", "held")
    return dense.select("code", "month", F.col("held.rating").alias("rating")).where("rating is not null")


def running_rating(rows: DataFrame, key: str, order: list[str], delta: str, start: float = 0.0) -> DataFrame:
    """Each row's rating after it: the start and all deltas of its key so far."""
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("rating", F.lit(start) + F.sum(delta).over(w))


def parse_rankings(lines: DataFrame, special: DataFrame, overrides: DataFrame, codes: DataFrame, members: DataFrame, text: str = "value", line_no: str = "line_no") -> DataFrame:
    """Rankings from tab-separated lines (rank, -, code, points): rank, id, name, points, member, flagged; the first line of
    an id counts.

    `special` (code, name) are teams without an id; else `overrides` (code, iso2) go before the code's own lower case; `codes`
    (iso2, id, name) resolve them, and an unknown code is flagged. `members` (iso2) tell who is a member. Lines of fewer than
    four fields, or whose rank or points are no whole numbers, are left out.
    """
    f = F.split(F.col(text), "\t")
    field = lambda i: F.trim(F.get(f, F.lit(i)))
    rows = lines.where(F.size(f) >= 4).select(line_no, field(0).try_cast("int").alias("rank"), field(2).alias("code"), field(3).try_cast("int").alias("points")).where("rank is not null and points is not null")
    rows = rows.join(special.select("code", F.col("name").alias("special name")), "code", "left").join(overrides.select("code", F.col("iso2").alias("other")), "code", "left")
    rows = rows.withColumn("iso2", F.when(F.col("special name").isNull(), F.coalesce("other", F.lower("code"))))
    rows = rows.join(codes.select("iso2", "id", F.col("name").alias("own name")), "iso2", "left").join(members.select("iso2", F.lit(True).alias("is member")), "iso2", "left")
    first = Window.partitionBy(F.coalesce(F.concat(F.lit("id "), F.col("id").cast("string")), F.concat(F.lit("code "), F.col("code")))).orderBy(line_no)
    out = rows.withColumn("n", F.row_number().over(first)).where("n = 1")
    return out.select("rank", "id", "iso2", F.coalesce("special name", "own name", "code").alias("name"), "points", F.coalesce("is member", F.lit(False)).alias("member"), F.col("id").isNull().alias("flagged"), line_no)
