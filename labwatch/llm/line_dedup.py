"""Line dedup by a segment-partition edit join.

A line goes if it, or a line within the edit threshold of it, occurs earlier.
Two lines within ``t`` edits share one of ``t + 1`` segments of the shorter
one, at a place that lengths and earlier segments narrow down. So every line
is indexed by its segments and probes with the few substrings of its own that
can be such a segment, per length. What meets is verified by a banded
bit-parallel edit distance: for each number of edits one bit for each diagonal
of the band, folded over the characters.

Decisions need existence, not pairs. Each probe first meets only the earliest
line of its key, which a partial aggregate finds, however many lines share the
key. Only lines that stay undecided meet the rest, where the key has more, and
only lines whose character counts allow it. Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch.llm.common import kept, table

#: Edits, and code points that a line must have to be judged; shorter lines are left alone.
THRESHOLD, LEAST = 2, 20
NO_ID = -(1 << 63)


def segment(length: Column, i: int, parts: int) -> tuple[Column, Column]:
    """Start (from 1) and size of the i-th of ``parts`` segments; the last ones take what doesn't divide."""
    base, short = F.floor(length / parts), parts - length % parts
    size = base + F.when(F.lit(i) > short, 1).otherwise(0)
    start = 1 + base * (i - 1) + F.greatest(F.lit(i - 1) - short, F.lit(0))
    return start.cast("int"), size.cast("int")


def key(i: int, length: Column, text: Column) -> Column:
    return F.xxhash64(F.lit(i), length, text)


def index_keys(line: Column, length: Column, t: int) -> list[Column]:
    return [key(i, length, F.substring(line, *segment(length, i, t + 1))) for i in range(1, t + 2)]


def probe_keys(line: Column, length: Column, t: int) -> list[Column]:
    """Keys of the substrings that can be a segment of another line, shorter by 0 to ``t``, other than the line's own segments.

    Lines that share a segment in its place share a key of the index already.
    Of two lines of one length within two edits that share none, one has lost
    a character before the middle and won one behind it: its middle segment
    stands one place on in the other, so every line looks to one side only.
    """
    out = []
    for shorter in range(t + 1):
        own = length - shorter
        for i in range(1, t + 2):
            start, size = segment(own, i, t + 1)
            low, high = max(-(i - 1), shorter - (t + 1 - i)), min(i - 1, shorter + (t + 1 - i))
            if not shorter and t <= 2:
                low = 1
            out += [key(i, own, F.substring(line, start + shift, size)) for shift in range(low, high + 1) if shorter or shift]
    return out


def within(a: Column, b: Column, t: int) -> Column:
    """Whether two arrays of characters are within ``t`` edits.

    Bit ``k`` of level ``e`` says that the first ``j + k - t`` characters of
    ``a`` and the first ``j`` of ``b`` are within ``e`` edits.
    """
    full = (1 << (2 * t + 1)) - 1
    start = F.struct(*(F.lit(((1 << (e + 1)) - 1) << t & full).alias(f"r{e}") for e in range(t + 1)))

    def step(s: Column, j: Column) -> Column:
        same = F.lit(0)
        for k in range(2 * t + 1):
            same = same.bitwiseOR(F.when(F.get(a, j + (k - t - 1)) == F.get(b, j - 1), F.lit(1 << k)).otherwise(F.lit(0)))
        levels = [s["r0"].bitwiseAND(same)]
        for e in range(1, t + 1):
            before = s[f"r{e - 1}"]
            new = s[f"r{e}"].bitwiseAND(same).bitwiseOR(before).bitwiseOR(F.shiftright(before, 1)).bitwiseOR(F.shiftleft(levels[-1], 1))
            levels.append(new.bitwiseAND(F.lit(full)))
        return F.struct(*(x.alias(f"r{e}") for e, x in enumerate(levels)))

    last = F.aggregate(F.when(F.size(b) > 0, F.sequence(F.lit(1), F.size(b))).otherwise(F.array().cast("array<int>")), start, step, lambda s: s[f"r{t}"])
    gap = F.size(a) - F.size(b)
    return F.when(F.abs(gap) <= t, F.getbit(last, gap + t) == 1).otherwise(F.lit(False))


def trimmed(a: Column, b: Column) -> Column:
    """``a`` and ``b`` without most of what they have in common at either end; their distance stays the same.

    Widths halve, so less than the last one is left in common before a line's
    first difference, unless lines are longer than all widths together.
    """
    widths = F.array(*(F.lit(1 << k) for k in range(16, 2, -1)))

    def front(s: Column, w: Column) -> Column:
        x, y = s["x"], s["y"]
        return F.when((F.length(x) >= w) & (F.length(y) >= w) & (F.left(x, w) == F.left(y, w)), F.struct(F.substr(x, w + 1).alias("x"), F.substr(y, w + 1).alias("y"))).otherwise(s)

    def back(s: Column, w: Column) -> Column:
        x, y = s["x"], s["y"]
        return F.when((F.length(x) >= w) & (F.length(y) >= w) & (F.right(x, w) == F.right(y, w)), F.struct(F.left(x, F.length(x) - w).alias("x"), F.left(y, F.length(y) - w).alias("y"))).otherwise(s)

    chars = lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, ""))
    cut = F.aggregate(widths, F.struct(a.alias("x"), b.alias("y")), front)
    return F.aggregate(widths, cut, back, lambda s: F.struct(chars(s["x"]).alias("x"), chars(s["y"]).alias("y")))


#: Sixteen classes of characters, by how often European texts use them.
CLASSES = ("a", "e", "i", "o", "u", "t", "n", "s", "r", "h", "d", "l", "cmfp", "bgvw", "jkqxyz", " .,")


def histogram(line: Column) -> Column:
    """Counts of the classes, four bits each."""
    total = F.lit(0).cast("long")
    for k, chars in enumerate(CLASSES):
        n = (F.length(line) - F.length(F.translate(line, chars, ""))) % 16
        total = total.bitwiseOR(F.shiftleft(n.cast("long"), 4 * k))
    return total


def may_be_within(a: Column, b: Column, t: int) -> Column:
    """An edit changes two counts by one at most."""
    apart = F.lit(0).cast("long")
    for k in range(len(CLASSES)):
        part = lambda x: F.shiftrightunsigned(x, 4 * k).bitwiseAND(F.lit(15).cast("long"))  # noqa: E731, B023
        gap = F.abs(part(a) - part(b))
        apart = apart + F.least(gap, 16 - gap)
    return apart <= 2 * t


def lines_of(docs: DataFrame, text: str, least: int) -> DataFrame:
    """``d, th, pos, line``: every line that is judged. ``d`` and ``th`` (a hash of the text) tell documents apart."""
    rows = docs.filter(F.col(text).isNotNull()).select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("d"), F.xxhash64(text).alias("th"), F.col(text).alias("text"))
    return rows.select("d", "th", F.posexplode(F.split("text", "\n")).alias("pos", "line")).filter(F.length(F.trim("line")) >= least)


def removed_lines(docs: DataFrame, text: str = "text", t: int = THRESHOLD, least: int = LEAST) -> DataFrame:
    """``d, th, pos, exact``: the lines that go; ``exact`` if the very line occurs earlier."""
    lines = lines_of(docs, text, least).withColumn("h", F.xxhash64("line"))
    place = F.struct("d", "pos", "th")
    # each distinct line by its hash, with its first place; the rest are exact repeats
    first = kept(lines.select("h", place.alias("at")).groupBy("h").agg(F.min("at").alias("at")))

    measured = lines.select("h", "line", "d", "pos", F.length("line").alias("n"))
    index = measured.select("h", "d", "pos", F.explode(F.array(*index_keys(F.col("line"), F.col("n"), t))).alias("key"))
    earliest = index.groupBy("key").agg(F.min(F.struct("d", "pos", "h")).alias("e"), F.min("h").alias("low"), F.max("h").alias("high"))
    more = F.col("low") != F.col("high")
    # keys under which a probe finds another line, and, without a probe, those that several lines have
    hits = earliest.filter(more).select(F.lit(None).cast("long").alias("h"), "key", F.col("e.h").alias("x"), F.lit(True).alias("more"))
    if own := probe_keys(F.col("line"), F.col("n"), t):
        probes = measured.select("h", F.explode(F.array(*own)).alias("key"))
        found = probes.join(earliest, "key").filter(more | (F.col("low") != F.col("h")))
        hits = found.select("h", "key", F.col("e.h").alias("x"), more.alias("more")).unionAll(hits)
    hits = kept(hits.distinct())
    members = kept(index.select("h", "key").join(hits.filter("h is null").select("key", "x"), "key").select("h", "key", "x").distinct())
    met = hits.filter("h is not null").unionAll(members.withColumn("more", F.lit(True)))

    # all lines that pairs can hold: where a key has more lines than the earliest one, they meet one another
    wanted = met.select("h").unionAll(met.select("x")).distinct()
    text = lines.select("h", "line").join(wanted, "h", "left_semi").groupBy("h").agg(F.first("line").alias("line"))
    text = kept(text.withColumn("counts", histogram(F.col("line"))).join(first, "h"))
    known = text.drop("line")

    pairs = met.filter("x != h").select(F.least("x", "h").alias("a"), F.greatest("x", "h").alias("b")).distinct()
    later = kept(similar(pairs, text, t).distinct())

    undecided = met.filter("more").select("h", "key").join(known, "h").join(later.withColumn("gone", F.lit(True)), "h", "left")
    others = members.select("key", "h").join(known, "h").join(later.withColumn("gone", F.lit(True)), "h", "left")
    others = others.select("key", F.col("h").alias("x"), F.col("at").alias("x_at"), F.col("counts").alias("x_counts"), F.col("gone").alias("x_gone"))
    # the later one of the two must be undecided
    open_ = F.when(F.col("at") > F.col("x_at"), F.col("gone").isNull()).otherwise(F.col("x_gone").isNull())
    rest = undecided.join(others, (undecided["key"] == others["key"]) & (F.col("h") != F.col("x")) & may_be_within(F.col("counts"), F.col("x_counts"), t) & open_)
    rest = rest.select(F.least("x", "h").alias("a"), F.greatest("x", "h").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti")
    gone = later.unionAll(similar(rest, text, t)).distinct()

    similar_at = first.join(gone, "h", "left_semi").select("at.d", "at.th", "at.pos", F.lit(False).alias("exact"))
    exact = lines.select("h", place.alias("at")).join(first.select("h", F.col("at").alias("first")), "h").filter(F.col("at") != F.col("first"))
    return exact.select("at.d", "at.th", "at.pos", F.lit(True).alias("exact")).distinct().unionAll(similar_at)


def similar(pairs: DataFrame, text: DataFrame, t: int) -> DataFrame:
    """``h`` of the later line of every pair within the threshold."""
    side = lambda c: text.select(F.col("h").alias(c), *(F.col(x).alias(f"{c}_{x}") for x in ("line", "counts", "at")))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(may_be_within(F.col("a_counts"), F.col("b_counts"), t))
    chars = both.select("a", "b", "a_at", "b_at", F.explode(F.array(trimmed(F.col("a_line"), F.col("b_line")))).alias("c"))
    close = chars.filter(within(F.col("c.x"), F.col("c.y"), t))
    return close.select(F.when(F.col("a_at") > F.col("b_at"), F.col("a")).otherwise(F.col("b")).alias("h"))


def line_dedup(docs: DataFrame, text: str = "text", t: int = THRESHOLD, least: int = LEAST) -> DataFrame:
    """``doc_id, n_lines, n_exact, n_similar, removed`` for every row; ``removed`` holds positions (from 0), joined by commas.

    A line is judged if it has ``least`` code points between its outer blanks.
    It goes if an equal line, or one within ``t`` edits, stands earlier, by
    ``doc_id``, then position, then a hash of the text; decisions refer to the
    input, not to what is left. Rows that repeat a document (equal id and
    text) are one document and get equal results; a null id comes first. Null
    texts have no lines, an empty text has one. Other columns are not read.
    """
    gone = removed_lines(docs, text, t, least).groupBy("d", "th").agg(F.sort_array(F.collect_list(F.struct("pos", "exact"))).alias("gone"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("d"), F.xxhash64(text).alias("th"), F.coalesce(F.size(F.split(text, "\n")), F.lit(0)).cast("long").alias("n_lines"))
    rows = rows.withColumn("n_lines", F.greatest("n_lines", F.lit(0).cast("long"))).join(gone, ["d", "th"], "left")
    count = lambda exact: F.coalesce(F.size(F.filter("gone", lambda g: g["exact"] == F.lit(exact))), F.lit(0)).cast("long")
    positions = F.array_join(F.transform("gone", lambda g: g["pos"].cast("string")), ",")
    none = F.col("gone").isNull()
    zero = F.lit(0).cast("long")
    return rows.select("doc_id", "n_lines", F.when(none, zero).otherwise(count(True)).alias("n_exact"), F.when(none, zero).otherwise(count(False)).alias("n_similar"), F.coalesce(positions, F.lit("")).alias("removed"))


def without_repeats(docs: DataFrame, text: str = "text", t: int = THRESHOLD, least: int = LEAST) -> DataFrame:
    """``docs`` with repeated lines taken out of the text; a document none of whose words is left goes.

    All other columns stay as they are. Texts without a removed line, null and
    empty ones included, are untouched.
    """
    gone = removed_lines(docs, text, t, least).groupBy("d", "th").agg(F.collect_list("pos").alias("gone"))
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    rows = rows.withColumns({"d": F.coalesce(F.col("row.doc_id").cast("long"), F.lit(NO_ID)), "th": F.xxhash64(f"row.{text}")}).join(gone, ["d", "th"], "left")
    left = F.array_join(F.filter(F.split(f"row.{text}", "\n"), lambda line, i: ~F.array_contains("gone", i)), "\n")
    rows = rows.withColumn("left", F.when(F.col("gone").isNull(), F.col(f"row.{text}")).otherwise(left))
    rows = rows.filter(F.col("gone").isNull() | F.col("left").rlike("[^\\x20\\x09-\\x0D]"))
    return rows.select(*((F.col("left") if c == text else F.col(f"row.`{c}`")).alias(c) for c in docs.columns))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents"))
