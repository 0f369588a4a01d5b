"""Line-first cleaning.

Rules for punctuation, navigation and boilerplate are evaluated line by line,
failing lines are removed, and a document that loses too much of its text is
rejected. Beside the verdict stand whole-text counts. Built-in functions only;
each intermediate array is passed through a generator, so that it is computed
once instead of once for every place that reads it.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch.llm.common import table

SPACE = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 50, 50, 3
#: A document is rejected when removed lines hold more than so many percent of its words' characters.
MAX_LOST_PERCENT = 30
#: A line with fewer words needs an end mark.
FRAGMENT_WORDS = 4
MAX_SYMBOL_PERCENT = 10
END_MARKS = "[.!?…:;,\"'”’»)\\]。！？]$"
NAVIGATION = "(?i)^(home|menu|search|log ?in|log ?out|sign ?(in|up)|register|next|previous|prev|back( to top)?|top|share|print|contact( us)?|about( us)?|site ?map|read more|more|skip to (main )?content)$|( [|>»•·] .*){2,}"
BOILERPLATE = "(?i)(all rights reserved|terms of (use|service)|privacy policy|cookie (policy|settings)|use of cookies|enable javascript|lorem ipsum|click here|subscribe to our|sign up for our|copyright (©|\\(c\\))|powered by )"
#: As many words as a fragment lacks.
ENOUGH_WORDS = "^[^ ]+" + " +[^ ]+" * (FRAGMENT_WORDS - 1)
#: What a text must hold, in lower case, for a line of it to match ``NAVIGATION`` beyond its words, or ``BOILERPLATE``.
NAVIGATION_MARKS = ("|", ">", "»", "•", "·")
BOILERPLATE_PARTS = ("all rights reserved", "terms of ", "privacy policy", "cookie ", "use of cookies", "enable javascript", "lorem ipsum", "click here", "subscribe to our", "sign up for our", "copyright ", "powered by ")
#: Characters of the longest navigation word, "skip to main content", and of a line end that ``$`` passes over.
LONGEST_NAVIGATION = 22


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """Add columns that are computed once, whatever reads them later."""
    return df.select("*", F.explode(F.array(F.struct(*(c.alias(k) for k, c in columns.items())))).alias("once__")).select(*df.columns, *(F.col(f"once__.{k}").alias(k) for k in columns))


def holds_any(text: Column, parts: tuple[str, ...]) -> Column:
    return reduce(or_, [F.contains(text, F.lit(x)) for x in parts])


def line_fails(line: Column, solid: Column, plain: Column, blank: Column, marks: Column, phrases: Column) -> Column:
    """Whether a line with a word breaks a rule. ``solid`` is the line without blanks, ``plain`` without symbols, ``blank`` with spaces for tabs.

    Where the text has none of ``NAVIGATION_MARKS`` (``marks``) or of
    ``BOILERPLATE_PARTS`` (``phrases``), no line of it can hold what their
    patterns look for, but for a short line that is a navigation word.
    """
    bare = F.trim(blank)
    symbols = F.length(line) - F.length(plain)
    fragment = ~bare.rlike(ENOUGH_WORDS) & ~bare.rlike(END_MARKS)
    navigation = (marks | (F.length(bare) <= LONGEST_NAVIGATION)) & bare.rlike(NAVIGATION)
    return (symbols * 100 > F.length(solid) * MAX_SYMBOL_PERCENT) | fragment | navigation | (phrases & bare.rlike(BOILERPLATE))


def quality_rules(docs: DataFrame, text: str = "text") -> DataFrame:
    """Counts, ``base_failed``, ``kept``, ``lost_chars`` and ``clean_text`` (failing lines removed) for every row.

    A null text has no words: all counts are zero, it fails the base rule and
    is not kept; its clean text is empty. Repeated rows give repeated rows;
    other columns are not read. The work is narrow and in proportion to the
    text (``n log n`` for its windows).
    """
    source = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), source.alias("text"))
    # a text is translated and cut whole, not line by line: each array has an entry for each line
    cut = lambda t: F.split(t, "\n")
    df = once(
        df, w=F.array_remove(F.split("text", SPACE), ""), cut=cut(F.col("text")), solid=cut(F.translate("text", " \t\x0b\f\r", "")), plain=cut(F.translate("text", SYMBOLS, "")),
        blank=cut(F.translate("text", "\t\x0b\f\r", "    ")), marks=holds_any(F.col("text"), NAVIGATION_MARKS), phrases=holds_any(F.lower("text"), BOILERPLATE_PARTS),
    )
    has_word = lambda i: F.length(F.get("solid", i)) > 0
    fails = F.transform("cut", lambda x, i: has_word(i) & line_fails(x, *(F.get(c, i) for c in ("solid", "plain", "blank")), F.col("marks"), F.col("phrases")))
    df = once(df, lines=F.filter("cut", lambda x, i: has_word(i)), fails=fails)
    total = lambda lengths: F.aggregate(lengths, F.lit(0).cast("long"), lambda n, x: n + x)
    df = once(
        df, n_words=F.size("w").cast("long"), word_chars=total(F.transform("solid", F.length)), n_symbols=F.length("text") - total(F.transform("plain", F.length)) - F.size("cut") + 1,
        n_dup_lines=(F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        lost_chars=total(F.transform("solid", lambda x, i: F.when(F.get("fails", i), F.length(x)).otherwise(0))),
        clean_text=F.when(F.array_contains("fails", True), F.array_join(F.filter("cut", lambda x, i: ~F.get("fails", i)), "\n")).otherwise(F.col("text")),
        windows=F.sort_array(F.transform(F.slice("w", 1, F.greatest(F.size("w") - (WINDOW - 1), F.lit(0))), lambda x, i: F.struct(F.xxhash64(x, *(F.get("w", i + k) for k in range(1, WINDOW))).alias("h"), i.alias("i")))),
    ).drop("w", "cut", "solid", "plain", "blank", "marks", "phrases", "lines", "fails", "text")
    same = lambda x, i, k: F.coalesce(x["h"] == F.get("windows", i + k)["h"], F.lit(False))
    df = once(df, at=F.sort_array(F.transform(F.filter("windows", lambda x, i: same(x, i, -1) | same(x, i, 1)), lambda x: x["i"]))).drop("windows")
    covered = F.aggregate(F.transform("at", lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get("at", i + 1) - p, F.lit(WINDOW)))), F.lit(0).cast("long"), lambda n, x: n + x)
    df = once(df, n_repeat_words=covered).drop("at")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    df = df.withColumn("base_failed", failed)
    kept = ~F.col("base_failed") & (100 * F.col("lost_chars") <= MAX_LOST_PERCENT * F.col("word_chars"))
    return df.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "lost_chars", "clean_text")


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents")).drop("clean_text")


def sql() -> str:
    """The same rows in DuckDB: words, windows and lines as rows, rules by the same expressions."""
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    blanks = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    letters_ = lambda x: f"length(translate({x}, {blanks}, ''))"
    symbols = lambda x: f"(length({x}) - length(translate({x}, '{SYMBOLS}', '')))"
    fails = (
        f"({symbols('line')} * 100 > {letters_('line')} * {MAX_SYMBOL_PERCENT} OR (len(regexp_split_to_array(bare, ' +')) < {FRAGMENT_WORDS} AND NOT regexp_matches(bare, {quoted(END_MARKS)})) "
        f"OR regexp_matches(bare, {quoted(NAVIGATION)}) OR regexp_matches(bare, {quoted(BOILERPLATE)}))"
    )
    return f"""
    WITH d AS MATERIALIZED (SELECT row_number() OVER () AS id, doc_id::BIGINT AS doc_id, coalesce(text, '') AS t FROM documents),
    w AS MATERIALIZED (SELECT id, list_filter(regexp_split_to_array(t, '{SPACE}'), lambda x: x <> '') AS w FROM d),
    places AS (SELECT id, w, unnest(range(1, len(w) - {WINDOW - 2})) AS i FROM w),
    windows AS MATERIALIZED (SELECT id, i, array_to_string(w[i:i + {WINDOW - 1}], ' ') AS k FROM places),
    twice AS (SELECT id, k FROM windows GROUP BY ALL HAVING count(*) > 1),
    covered AS (SELECT id, count(DISTINCT p) AS n FROM (SELECT id, unnest(range(i, i + {WINDOW})) AS p FROM windows JOIN twice USING (id, k)) GROUP BY id),
    lines AS (SELECT id, line, trim(translate(line, chr(9) || chr(11) || chr(12) || chr(13), '    '), ' ') AS bare FROM (SELECT id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE {letters_('line')} > 0),
    l AS (SELECT id, count(*) - count(DISTINCT line) AS dup, sum(CASE WHEN {fails} THEN {letters_('line')} ELSE 0 END) AS lost FROM lines GROUP BY id),
    r AS (SELECT doc_id, len(w) AS n_words, {letters_('t')} AS word_chars, {symbols('t')} AS n_symbols, coalesce(dup, 0) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words, coalesce(lost, 0)::BIGINT AS lost_chars
          FROM d JOIN w USING (id) LEFT JOIN l USING (id) LEFT JOIN covered USING (id)),
    b AS (SELECT *, n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed FROM r)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND 100 * lost_chars <= {MAX_LOST_PERCENT} * word_chars AS kept, lost_chars FROM b"""
