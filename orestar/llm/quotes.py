"""Quotation linking: which message answers which, told by the passages they quote.

Lines are parsed for nested quote marks. Runs of lines of one level are
passages; the unquoted ones are what the message itself says. Passages are
normalised and hashed, together with the passage they answer and alone. A quoted
passage is joined to the earliest message that says it in answer to the same, or
else to the earliest that says it; the shallowest quote of a message names its
parent, and the chain of parents is followed by pointer doubling to the message that began the
conversation. The result is ordered by replies and free of quotes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orestar.llm.text import SPACE_CHARS, SPACE_CLASS, ascii_lower, present, same
from orestar.workspace import materialise

# Fixed value: the marks a quoted line begins with.
QUOTE_MARKS = "^(?:> ?)*"
# A line of a quote is looked up on its own, if its passage is not found, from
# this many characters on.
LEAST_LINE = 20


def normalised(text: Column) -> Column:
    """ASCII letters lower-cased, white space runs as one space, none at the ends."""
    return F.trim(F.regexp_replace(ascii_lower(text), f"[{SPACE_CLASS}]+", " "))


def _hash(text: Column) -> Column:
    return F.unhex(F.substring(F.sha2(text, 256), 1, 32))


def passages(messages: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, own (the unquoted lines), and parts: runs of lines of one level, as (place, level, said)."""
    marks = f"transform(lines, x -> regexp_extract(x, '{QUOTE_MARKS}', 0))"
    rows = (
        messages.select(F.col(id_col).alias("id"), F.split(present(F.col(text_col)), "\n").alias("lines"))
        .withColumn("marks", F.expr(marks))
        .withColumn("levels", F.expr("transform(marks, m -> length(replace(m, ' ', '')))"))
        .withColumn("bare", F.expr("zip_with(lines, marks, (x, m) -> substring(x, length(m) + 1))"))
        # Where runs begin, and one past the end.
        .withColumn("starts", F.expr("filter(sequence(1, size(lines)), i -> i = 1 OR levels[i - 1] <> levels[greatest(i, 2) - 2])"))
        .withColumn("ends", F.expr("concat(slice(starts, 2, size(starts)), array(size(lines) + 1))"))
    )
    parts = F.expr(
        "transform(arrays_zip(starts, ends), (r, place) -> struct(place, levels[r.starts - 1] AS level,"
        " array_join(slice(bare, r.starts, r.ends - r.starts), '\\n') AS said))"
    )
    own = F.expr("array_join(transform(filter(arrays_zip(bare, levels), x -> x.levels = 0), x -> x.bare), '\\n')")
    return rows.select("id", F.trim(own, F.lit(SPACE_CHARS)).alias("own"), parts.alias("parts"))


def _in_context(parts: str) -> Column:
    """The parts that are not blank, as (place, level, said, whole, deeper): ``deeper`` is the part beside it one level deeper, if any."""
    each = F.transform(parts, lambda p: F.struct(p.place, p.level, p.said, normalised(p.said).alias("whole")))
    each = F.filter(each, lambda p: p.whole != "")

    def placed(kept: Column) -> Column:
        def deeper(p: Column, other: Column) -> Column:
            return F.when(other.level == p.level + 1, other.whole)

        # What is answered stands above the answer; where it does not, below.
        return F.transform(
            kept,
            lambda p, i: F.struct(
                p.place, p.level, p.said, p.whole,
                F.coalesce(deeper(p, F.get(kept, i - 1)), deeper(p, F.get(kept, i + 1))).alias("deeper"),
            ),
        )

    # A lambda over one element gives a value a name.
    return F.transform(F.array(each), placed)[0]


def _keys(rows: DataFrame, quoted: bool) -> DataFrame:
    """Hashes by which passages are compared: whole passages (by_line 0) and their longer lines (by_line 1).

    Each comes with the passage it answers (single 0), if there is one, and by itself (single 1).
    """
    wanted = "level > 0" if quoted else "level = 0"
    parts = rows.select("id", F.inline(_in_context("parts"))).where(wanted)
    whole = parts.select("id", "level", "place", F.lit(0).alias("by_line"), F.col("whole").alias("text"), "deeper")
    line = parts.select("id", "level", "place", "deeper", F.explode(F.split("said", "\n")).alias("line"))
    line = line.withColumn("line", normalised(F.col("line"))).where(F.char_length("line") >= LEAST_LINE)
    texts = whole.unionAll(line.select("id", "level", "place", F.lit(1).alias("by_line"), F.col("line").alias("text"), "deeper"))
    # Normalised texts have no line ends.
    chain = F.struct(F.lit(0).alias("single"), _hash(F.concat("text", F.lit("\n"), "deeper")).alias("hash"))
    alone = F.struct(F.lit(1).alias("single"), _hash(F.col("text")).alias("hash"))
    return texts.select("id", "level", "place", "by_line", F.inline(F.array(chain, alone))).where("hash IS NOT NULL")


def parents(rows: DataFrame) -> DataFrame:
    """id and parent of every message that quotes an earlier one."""
    key = ["by_line", "single", "hash"]
    said = _keys(rows, quoted=False)
    own = rows.where("own <> ''").select("id", F.lit(0).alias("by_line"), F.lit(1).alias("single"), _hash(normalised(F.col("own"))).alias("hash"))
    # However many messages say the same, one row per hash is left.
    first = said.select("id", *key).unionAll(own).groupBy(*key).agg(F.min("id").alias("origin"), F.max("id").alias("latest"))
    quoted = _keys(rows, quoted=True).where("id IS NOT NULL").distinct()
    found = quoted.join(first, key).where("origin < id")
    # A passage alone that several say names no conversation: it comes after all others.
    found = found.withColumn("doubt", F.expr("if(single = 1 AND origin <> latest, 1, 0)"))
    best = F.min(F.struct("doubt", "level", "single", "by_line", "place", "origin"))
    return found.groupBy("id").agg(best.alias("best")).select("id", F.col("best.origin").alias("parent"))


def roots(links: DataFrame) -> DataFrame:
    """id, root and depth of every message in ``links`` (id, parent).

    Every round doubles the distance a pointer spans, so the rounds are the
    logarithm of the longest chain, and only messages that have not arrived
    take part. Parents are smaller than their replies: there are no cycles.
    """
    tops = links.select(F.col("parent").alias("id")).join(links.select("id"), "id", "left_anti").distinct()
    tops = materialise(tops, "thread_tops")
    found = links.select("id", F.col("parent").alias("up"), F.lit(1).alias("depth"))
    arrived = tops.select(F.col("id").alias("up"), F.lit(True).alias("is_top"))
    now = materialise(found.join(arrived, "up", "left").selectExpr("id", "up", "depth", "is_top IS NOT NULL AS done"), "threads")
    settled = tops.select("id", F.col("id").alias("up"), F.lit(0).alias("depth"), F.lit(True).alias("done"))
    while True:
        settled, moving = settled.unionAll(now.where("done")), now.where("NOT done")
        if moving.isEmpty():
            return settled.select("id", F.col("up").alias("root"), "depth")
        # Whatever a moving pointer points at has a pointer itself, settled or moving.
        step = settled.unionAll(moving).select(
            F.col("id").alias("up"), F.col("up").alias("further"), F.col("depth").alias("more"), "done"
        )
        met = moving.drop("done").join(step, "up")
        now = materialise(met.select("id", F.col("further").alias("up"), (F.col("depth") + F.col("more")).alias("depth"), "done"), "threads")


def link_quotations(messages: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """One row per message: id, root, parent, depth, own.

    Sorted by (root, depth, id) the rows are conversations in the order of their
    replies. Ids rise with time and may be of any type that has an order. A
    passage and the one beside it that is quoted one level deeper belong to the
    earliest message that says the one and quotes the other. Where there is none,
    the passage alone belongs to the earliest message that says it; if several
    say it, quotes that leave no such doubt go first, whatever their level. If a
    quote is not found whole, its longer lines are looked up; if the shallowest
    level is not found, the next deeper one gives the nearest ancestor that is.

    Null and empty texts say and quote nothing, and so do passages of white
    space. Rows that share an id are one message, of which the smallest text
    counts. Rows without an id are left as they are, each without root. Other
    columns are ignored.
    """
    named = messages.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(F.min(F.col(text_col)).alias("body"))
    rows = materialise(passages(named, "id", "body"), "quote_parts")
    links = materialise(parents(rows), "quote_links")
    threads = roots(links).withColumnRenamed("id", "thread_id")
    linked = rows.select("id", "own").join(links.withColumnRenamed("id", "link_id"), same(F.col("id"), F.col("link_id")), "left")
    placed = linked.join(threads, same(F.col("id"), F.col("thread_id")), "left").select(
        "id", F.coalesce("root", "id").alias("root"), "parent", F.coalesce("depth", F.lit(0)).alias("depth"), "own"
    )
    nameless = passages(messages.where(F.col(id_col).isNull()), id_col, text_col)
    nothing = F.lit(None).cast(placed.schema["id"].dataType)
    return placed.unionAll(nameless.select("id", nothing.alias("root"), nothing.alias("parent"), F.lit(0).alias("depth"), "own"))


def mails_of(conversations: DataFrame) -> DataFrame:
    """Conversations as they would be mailed: id (conv_id, turn) and text.

    A turn quotes the turn before it at one level and the one before that at two,
    above its own words. Lines that look like quotes are indented, as mail does.
    """

    def quoted(text: str, marks: str) -> str:
        return f"concat('{marks}', replace({text}, '\\n', '\\n{marks}'), '\\n')"

    plain = r"regexp_replace(coalesce(text, ''), '(?m)^(?=>)', ' ')"
    turns = conversations.where("conv_id IS NOT NULL AND turn IS NOT NULL").groupBy("conv_id", "turn").agg(F.min(F.expr(plain)).alias("said"))
    before = [
        turns.select("conv_id", (F.col("turn") + i).alias("turn"), F.col("said").alias(f"said_{i}")) for i in (1, 2)
    ]
    met = turns.join(before[0], ["conv_id", "turn"], "left").join(before[1], ["conv_id", "turn"], "left")
    text = f"concat(coalesce({quoted('said_2', '> > ')}, ''), coalesce({quoted('said_1', '> ')}, ''), said)"
    return met.selectExpr("struct(conv_id, turn) AS id", f"{text} AS text")
