"""Personal data: expressions propose spans, validators confirm them, nearby words adjust the score.

Every kind has one expression. A proposal that its validator refuses (octets of
an address, Luhn's sum of a card, mod-97 of an account number, digit counts) is
dropped; the rest get points: some by kind, some for a checksum that fits, some
for words near by that speak for or against the kind. The base kinds stay
whatever their points; those the method adds need ``THRESHOLD``.

Built-in functions only, and narrow. Spark's expressions give matches without
places, so a text is cut at a kind's matches: the places are running sums of
the lengths of gaps and matches. Those sums are made in two levels, chunks and
then totals of chunks, so that a text with very many matches takes time in
proportion to them. Cheap tests on the whole text come first; most texts hold
none of a kind. Quantifiers are possessive where that changes no match: a long
run of letters or digits is then read once, and no expression recurses.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from labwatch.llm.common import table, whole_text
from labwatch.llm.quality_rules import once

#: Code points before and after a span that are searched for context words, up to the kind's next proposal.
BEFORE, AFTER = 48, 24
FOR, AGAINST, CHECKSUM, THRESHOLD = 30, 20, 30, 60
CHUNK = 256

# Lengths of international bank account numbers by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AT": 20, "BE": 16, "BG": 22, "BR": 29, "CH": 21, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "EE": 20, "ES": 24, "FI": 18, "FR": 27, "GB": 22,
    "GR": 27, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IS": 26, "IT": 27, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "MC": 27, "MT": 31, "NL": 18, "NO": 15, "PL": 28,
    "PT": 25, "RO": 24, "SA": 24, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "TR": 26, "UA": 29,
}


@dataclass(frozen=True)
class Kind:
    """``plain`` is the expression as specified, ``fast`` one with the same matches that never goes back."""

    name: str
    plain: str
    fast: str
    #: A test on the whole text that is true wherever the expression can match.
    hint: str
    points: int
    words: str
    against: str


def bank_account(word: str, end: str, optional: str, times: str) -> str:
    countries = "|".join(f"{c}[0-9]{{2}}(?:{optional}[A-Z0-9]){{{n - 4}}}{times}" for c, n in IBAN_LENGTHS.items())
    return f"{word}(?:{countries}){end}"


START, END = "(?<![A-Za-z0-9_])", "(?![A-Za-z0-9_])"
KINDS = (
    Kind(
        "email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        # a match starts where its run of letters does, or where the last match ended
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", r"@[A-Za-z0-9-]++\.[A-Za-z0-9-]", 60,
        "e-?mail|mail|contact|kontakt|contacto|correo|courriel|write to|reach", "example|noreply|no-reply",
    ),
    Kind(
        "ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", r"[0-9]\.[0-9]++\.[0-9]++\.[0-9]", 40,
        "ip|address|host|server|client|login|adresse", "version|release|v|section|chapter",
    ),
    Kind(
        "card", r"[0-9]([\x20-]?[0-9])+", r"[0-9](?:[\x20-]?+[0-9]){13,}+", r"[0-9](?:[\x20-]?+[0-9]){13}", 60,
        "card|credit|debit|visa|mastercard|amex|payment|karte|tarjeta|carte", "order|invoice|isbn|tracking|serial|article",
    ),
    Kind(
        "phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9][\x20().0-9-]", 40,
        "phone|tel|call|fax|mobile|cell|whatsapp|telefon|handy", "version|score|plus",
    ),
    Kind("iban", bank_account(r"\b", r"\b", "[ ]?", ""), bank_account(START, END, "[ ]?+", "+"), r"[A-Z]{2}[0-9]{2}[ ]?[A-Z0-9]", 40, "iban|account|bank|konto|cuenta|compte|transfer", "serial|part"),
    Kind(
        "ssn", r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", rf"{START}[0-9]{{3}}-[0-9]{{2}}-[0-9]{{4}}{END}", r"[0-9]{3}-[0-9]{2}-[0-9]{4}", 30,
        "ssn|social security|social insurance|taxpayer", "order|invoice|part|model|serial",
    ),
)
BASE = 4
OCTETS = r"^0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])(?:\.0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])){3}$"
ISSUED = "^(?:00[1-9]|0[1-9][0-9]|[1-578][0-9]{2}|6[0-57-9][0-9]|66[0-57-9])-(?:0[1-9]|[1-9][0-9])-(?:000[1-9]|00[1-9][0-9]|0[1-9][0-9]{2}|[1-9][0-9]{3})$"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def luhn(digits: Column) -> Column:
    """Whether the digits' last one is their check digit."""

    def worth(c: Column, i: Column) -> Column:
        twice = c.cast("int") * 2
        return F.when(i % 2 == 0, c.cast("int")).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), worth), F.lit(0), lambda n, x: n + x) % 10 == 0


def mod97(account: Column) -> Column:
    """Whether an account number of A-Z and 0-9, its first four moved to the end, leaves 1."""
    moved = F.split(F.concat(F.substr(account, F.lit(5)), F.left(account, F.lit(4))), "")

    def step(left: Column, c: Column) -> Column:
        code = F.ascii(c)
        return F.when(code < 58, (left * 10 + code - 48) % 97).otherwise((left * 100 + code - 55) % 97).cast("int")

    return F.aggregate(moved, F.lit(0), step) == 1


def confirmed(kind: str, m: Column) -> Column:
    digits = lambda drop: F.translate(m, drop, "")
    if kind == "ip":
        return m.rlike(OCTETS)
    if kind == "card":
        return F.length(digits(" -")).between(14, 19) & luhn(digits(" -"))
    if kind == "phone":
        return F.length(digits("+ ().-")).between(10, 15)
    if kind == "iban":
        return mod97(digits(" "))
    return m.rlike(ISSUED) if kind == "ssn" else F.lit(True)


def near(words: str) -> str:
    return f"(^|[^a-z])({words})([^a-z]|$)"


def points(kind: Kind, before: Column, after: Column) -> Column:
    says = lambda words: before.rlike(near(words)) | after.rlike(near(words))
    sure = CHECKSUM if kind.name in ("card", "iban") else 0
    score = F.lit(kind.points + sure) + F.when(says(kind.words), FOR).otherwise(0) - F.when(says(kind.against), AGAINST).otherwise(0)
    return F.least(score, F.lit(100)).cast("int")


def sums(steps: Column) -> Column:
    """``t`` (the total) and ``b`` (the sum before each element) of an array of longs."""
    start = F.struct(F.lit(0).cast("long").alias("t"), F.array().cast("array<bigint>").alias("b"))
    return F.aggregate(steps, start, lambda s, x: F.struct((s["t"] + x).alias("t"), F.array_append(s["b"], s["t"]).alias("b")))


def findings(docs: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` and ``found array<struct<start, rank, kind, end, score>>`` for every row of ``docs``.

    Places are in code points, ends exclusive; ``rank`` is the kind's place in
    ``KINDS``. Found spans are in order of start, then kind; spans of
    different kinds may overlap. Null and empty texts have none. Repeated rows
    give repeated rows, an empty table none; other columns are not read.
    """
    df = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text(text).alias("text"))
    some = {k.name: F.col("text").rlike(k.hint) for k in KINDS}
    df = once(
        df, **{f"gap_{k.name}": F.when(some[k.name], F.split("text", k.fast)) for k in KINDS},
        **{f"match_{k.name}": F.when(some[k.name], F.regexp_extract_all("text", F.lit(k.fast), F.lit(0))) for k in KINDS},
    ).drop("text")

    def chunks(k: Kind) -> Column:
        gaps, steps = F.col(f"gap_{k.name}"), F.col(f"match_{k.name}")
        lengths = lambda c: F.transform(F.slice(steps, c * CHUNK + 1, CHUNK), lambda m, i: (F.length(m) + F.length(F.get(gaps, c * CHUNK + i))).cast("long"))
        return F.when(F.size(steps) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / CHUNK).cast("int")), lambda c: sums(lengths(c))))

    df = once(df, **{f"chunk_{k.name}": chunks(k) for k in KINDS})
    df = once(df, **{f"base_{k.name}": sums(F.transform(f"chunk_{k.name}", lambda c: c["t"]))["b"] for k in KINDS})

    def spans(rank: int, k: Kind) -> Column:
        gaps, chunk, base = (F.col(f"{x}_{k.name}") for x in ("gap", "chunk", "base"))
        small = lambda x: F.translate(x, UPPER, LOWER)

        def span(m: Column, i: Column) -> Column:
            c = F.floor(i / CHUNK).cast("int")
            gap = F.get(gaps, i)
            start = F.get(base, c) + F.get(F.get(chunk, c)["b"], i % CHUNK) + F.length(gap)
            score = points(k, small(F.right(gap, F.lit(BEFORE))), small(F.left(F.get(gaps, i + 1), F.lit(AFTER))))
            score = F.when(confirmed(k.name, m), score)
            return F.struct(start.alias("start"), F.lit(rank).alias("rank"), F.lit(k.name).alias("kind"), (start + F.length(m)).alias("end"), score.alias("score"))

        keep = (lambda s: s["score"].isNotNull()) if rank < BASE else (lambda s: s["score"] >= THRESHOLD)
        empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint,score:int>>")
        return F.coalesce(F.filter(F.transform(f"match_{k.name}", span), keep), empty)

    return once(df, found=F.sort_array(F.concat(*(spans(i, k) for i, k in enumerate(KINDS))))).select("doc_id", "found")


def listed(found: Column, scores: bool = False) -> Column:
    """``kind:start:end``, or ``kind:start:end=score``, joined by commas."""
    tail = lambda s: (F.lit("="), s["score"].cast("string")) if scores else ()
    return F.array_join(F.transform(found, lambda s: F.concat(s["kind"], F.lit(":"), s["start"].cast("string"), F.lit(":"), s["end"].cast("string"), *tail(s))), ",")


def pii(docs: DataFrame, text: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts of the base kinds, the digest of their spans, all spans, and their scores.

    A text without spans (null and empty ones included) has zero counts, the
    digest of the empty string and empty lists.
    """
    df = findings(docs, text)
    df = once(df, base=F.filter("found", lambda s: s["rank"] < BASE))
    count = lambda rank: F.size(F.filter("base", lambda s: s["rank"] == rank)).cast("long")
    return df.select(
        "doc_id", *(count(i).alias(f"n_{k.name}") for i, k in enumerate(KINDS[:BASE])),
        F.sha2(listed(F.col("base")), 256).alias("base_sha256"), listed(F.col("found")).alias("spans"), listed(F.col("found"), True).alias("scores"),
        (F.size("found") - F.size("base")).cast("long").alias("n_added"),
    )


def op11_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii(table(spark, sf_dir, "documents"))


def sql() -> str:
    """The same rows in DuckDB, from the expressions as specified."""
    quoted = lambda s: s.replace("'", "''")
    luhn_sum = "list_sum(list_transform(string_split(reverse(d), ''), lambda c, i: CASE WHEN i % 2 = 1 THEN c::INT ELSE c::INT * 2 - CASE WHEN c::INT > 4 THEN 9 ELSE 0 END END)) % 10 = 0"
    left = "list_reduce(list_prepend(0, list_transform(string_split(substr(d, 5) || left(d, 4), ''), lambda c: CASE WHEN ascii(c) < 58 THEN ascii(c) - 48 ELSE ascii(c) - 55 END)), lambda a, b: (a * CASE WHEN b > 9 THEN 100 ELSE 10 END + b) % 97) = 1"
    test = {
        "email": "true", "ip": f"regexp_matches(m, '{OCTETS}')", "card": f"CASE WHEN length(d) BETWEEN 14 AND 19 THEN {luhn_sum} ELSE false END", "phone": "length(d) BETWEEN 10 AND 15",
        "iban": left, "ssn": f"regexp_matches(m, '{ISSUED}')",
    }
    parts = []
    for rank, k in enumerate(KINDS):
        says = lambda words: f"(regexp_matches(b, '{quoted(near(words))}') OR regexp_matches(a, '{quoted(near(words))}'))"
        base = k.points + (CHECKSUM if k.name in ("card", "iban") else 0)
        small = lambda x: f"translate({x}, '{UPPER}', '{LOWER}')"
        parts.append(f"""
        SELECT id, {rank} AS rank, '{k.name}' AS kind, start, start + length(m) AS stop, least(100, {base} + CASE WHEN {says(k.words)} THEN {FOR} ELSE 0 END - CASE WHEN {says(k.against)} THEN {AGAINST} ELSE 0 END) AS score
        FROM (SELECT *, sum(length(g) + length(m)) OVER (PARTITION BY id ORDER BY i) - length(m) AS start, translate(m, '+ ().-', '') AS d, {small(f"right(g, {BEFORE})")} AS b, {small(f"left(n, {AFTER})")} AS a
              FROM (SELECT id, i, gaps[i] AS g, matches[i] AS m, gaps[i + 1] AS n
                    FROM (SELECT *, unnest(range(1, len(matches) + 1)) AS i
                          FROM (SELECT id, regexp_split_to_array(text, '{quoted(k.plain)}') AS gaps, regexp_extract_all(text, '{quoted(k.plain)}') AS matches FROM t)))) WHERE {test[k.name]}""")
    rows = " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)
    text = lambda tail="": f"kind || ':' || start || ':' || stop{tail}"
    joined = lambda tail, where: f"coalesce(string_agg({text(tail)}, ',' ORDER BY start, rank) FILTER (WHERE {where}), '')"
    counts = ", ".join(f"count(*) FILTER (WHERE rank = {i})::BIGINT AS n_{k.name}" for i, k in enumerate(KINDS[:BASE]))
    return f"""
    WITH t AS (SELECT row_number() OVER () AS id, doc_id::BIGINT AS doc_id, coalesce(text, '') AS text FROM documents),
    spans AS (SELECT * FROM ({rows}) WHERE rank < {BASE} OR score >= {THRESHOLD})
    SELECT any_value(doc_id) AS doc_id, {counts}, sha256({joined("", f"rank < {BASE}")}) AS base_sha256, {joined("", "rank IS NOT NULL")} AS spans,
           {joined(" || '=' || score", "rank IS NOT NULL")} AS scores, count(*) FILTER (WHERE rank >= {BASE})::BIGINT AS n_added
    FROM t LEFT JOIN spans USING (id) GROUP BY id"""
