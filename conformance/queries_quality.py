"""Registered queries of the data checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import datetime

from conformance import frames, oracle_base as ob, oracle_labs
from conformance import testbed as tb
from conformance.queries_io import scratch
from conformance.queries_operators import HOT, LONG, PANEL, RES, SAMPLES, col, query
from labwatch import vocab
from labwatch.operators import joins, quality
from labwatch.plans import facts, suites
from labwatch.plans.labs import LABS
from labwatch.operators.reshape import unpivot_results

R = vocab.RESULT_COLUMNS
_ALL = lambda v: " AND ".join(f"{c} = {v}" for c in R)


@query("quality_accepted_states", f"{SAMPLES} SELECT sample_id, state FROM samples WHERE state NOT IN {ob.in_list([*vocab.STATE_NAMES.values(), 'NOT_REPORTED'])}")
def accepted_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.accepted_states(frames.samples(spark, sf_dir)).select("sample_id", "state")


@query("quality_no_result_codes", f"{HOT} SELECT sample_id, analyte, result FROM hot WHERE {_ALL('-1')}")
def no_result_codes(spark, sf_dir):
    return quality.no_result(frames.hot(spark, sf_dir), -1).select("sample_id", "analyte", "result")


@query("quality_no_result_text", f"{SAMPLES} SELECT sample_id FROM samples WHERE {_ALL(chr(39) + 'NT' + chr(39))}")
def no_result_text(spark, sf_dir):
    return quality.no_result(frames.samples(spark, sf_dir)).select("sample_id")


@query("quality_one_result", f"{HOT} SELECT sample_id, analyte, result FROM hot WHERE NOT ({' + '.join(R)}) IN (-11, -10)")
def one_result(spark, sf_dir):
    return quality.not_exactly_one_result(frames.hot(spark, sf_dir)).select("sample_id", "analyte", "result")


@query("quality_repeated_groups", f"{LONG} SELECT COUNT(*) AS repeated FROM (SELECT test_id, analyte FROM long_rows GROUP BY ALL HAVING COUNT(*) > 1) HAVING COUNT(*) > 100")
def repeated_groups(spark, sf_dir):
    return quality.repeated_groups(tb.long_results(spark, sf_dir), ["test_id", "analyte"], 100)


@query("quality_unique_share", f"{LONG} SELECT CAST((SELECT COUNT(*) FROM (SELECT DISTINCT test_id, analyte, sex FROM long_rows)) AS DOUBLE) / COUNT(*) AS share FROM long_rows")
def unique_share(spark, sf_dir):
    return quality.unique_share(tb.long_results(spark, sf_dir), ["test_id", "analyte", "sex"])


@query("quality_unique_share_outside", f"{LONG}, s AS (SELECT CAST((SELECT COUNT(*) FROM (SELECT DISTINCT test_id, sex FROM long_rows)) AS DOUBLE) / COUNT(*) AS share FROM long_rows) SELECT * FROM s WHERE share < 0.9 OR share > 1.0")
def unique_share_outside(spark, sf_dir):
    return quality.unique_share_outside(tb.long_results(spark, sf_dir), ["test_id", "sex"], 0.9, 1.0)


_FRESH = " UNION ALL ".join(f"SELECT '{p}' AS pathogen, MAX(date_testing) AS max_date_testing FROM samples WHERE {p}_test_result != 'NT'" for p in vocab.PATHOGENS)


@query("quality_freshness", f"{SAMPLES} SELECT * FROM ({_FRESH}) WHERE max_date_testing < DATE '2026-03-20' - 5")
def freshness(spark, sf_dir):
    return quality.stale_pathogens(frames.samples(spark, sf_dir), "2026-03-20")


@query("quality_minimum_rows", f"{SAMPLES} SELECT COUNT(*) AS rows FROM samples HAVING COUNT(*) < 100000000000")
def minimum_rows(spark, sf_dir):
    return quality.fewer_rows_than(frames.samples(spark, sf_dir), 100_000_000_000)


@query("quality_repetitions", f"{LONG} SELECT test_id, COUNT(*) AS repetitions FROM long_rows GROUP BY test_id HAVING NOT COUNT(*) BETWEEN 2 AND 6")
def repetitions(spark, sf_dir):
    return quality.repetitions_outside(tb.long_results(spark, sf_dir), "test_id", 2, 6)


@query("quality_weekly_rows", f"{SAMPLES}, {ob.EPIWEEKS}, w AS (SELECT * FROM epiweeks WHERE start_date >= {ob.AS_OF} - 30 AND start_date <= {ob.AS_OF}), d AS (SELECT date_testing, COUNT(*) AS n FROM samples GROUP BY ALL), c AS (SELECT w.start_date, w.end_date, w.week_num, CAST(COALESCE(SUM(d.n), 0) AS BIGINT) AS test_count FROM d RIGHT JOIN w ON d.date_testing >= w.start_date AND d.date_testing <= w.end_date GROUP BY ALL) SELECT * FROM c WHERE NOT (test_count >= 3000 AND test_count <= 4000)")
def weekly_rows(spark, sf_dir):
    return quality.weekly_rows_outside(frames.samples(spark, sf_dir), joins.calendar(spark), tb.AS_OF, 3000, 4000)


@query("quality_lost_lines", f"{SAMPLES}, x AS (SELECT CAST(SUM(qty_original_lines) - (SELECT COUNT(*) FROM orders) AS BIGINT) AS diff_qty_lines FROM samples) SELECT * FROM x WHERE diff_qty_lines > 0")
def lost_lines(spark, sf_dir):
    """Compared with the orders, which are fewer, so that the check has something to report."""
    return quality.lost_lines(frames.samples(spark, sf_dir), tb.table(spark, sf_dir, "orders"))


def _kit_broken() -> str:
    def rule(kit: str, names: list[str]) -> str:
        test = " AND ".join(f"{p}_test_result IS DISTINCT FROM 'NT'" if p in names else f"{p}_test_result IS NOT DISTINCT FROM 'NT'" for p in vocab.PATHOGENS)
        return f"WHEN '{kit}' THEN {test}"

    cases = " ".join(rule(k, n) for k, n in vocab.KIT_PATHOGENS.items())
    return f"NOT (CASE test_kit {cases} ELSE FALSE END)"


_KIT_BROKEN = _kit_broken()


@query("quality_kit_pathogens", f"{SAMPLES} SELECT sample_id, test_kit FROM samples WHERE {_KIT_BROKEN}")
def kit_pathogens(spark, sf_dir):
    return quality.kit_mismatches(frames.samples(spark, sf_dir)).select("sample_id", "test_kit")


@query("quality_not_null", f"{LONG} SELECT test_id, analyte FROM long_rows WHERE sex IS NULL")
def not_null(spark, sf_dir):
    return quality.nulls(tb.long_results(spark, sf_dir), "sex").select("test_id", "analyte")


@query("quality_unique", f"{LONG} SELECT test_id, COUNT(*) AS occurrences FROM long_rows WHERE test_id IS NOT NULL GROUP BY test_id HAVING COUNT(*) > 1")
def unique(spark, sf_dir):
    return quality.duplicates(tb.long_results(spark, sf_dir), "test_id")


@query("quality_values", f"{LONG} SELECT test_id, analyte, test_kit FROM long_rows WHERE test_kit NOT IN {ob.in_list(vocab.ALL_REPORTED_KITS)} OR age < 0 OR age > 110 OR lab_id IN ('DASA')")
def values(spark, sf_dir):
    """Accepted values, a range and forbidden values in one pass."""
    rows = tb.long_results(spark, sf_dir)
    bad = [
        quality.not_accepted(rows, "test_kit", vocab.ALL_REPORTED_KITS),
        quality.outside_range(rows, "age", 0, 110),
        quality.forbidden(rows, "lab_id", ["DASA"]),
    ]
    keys = ["test_id", "analyte", "test_kit"]
    distinct_rows = [b.withColumn("_why", F.lit(i)) for i, b in enumerate(bad)]
    first = distinct_rows[0]
    second = distinct_rows[1].where(col("test_kit").isin(vocab.ALL_REPORTED_KITS))
    third = distinct_rows[2].where(col("test_kit").isin(vocab.ALL_REPORTED_KITS) & (col("age").isNull() | col("age").between(0, 110)))
    return first.unionByName(second).unionByName(third).select(*keys)


@query("quality_not_null_share", f"{LONG}, s AS (SELECT AVG(CASE WHEN sex IS NOT NULL THEN 1 ELSE 0 END) AS share FROM long_rows) SELECT * FROM s WHERE share < 0.95")
def not_null_share(spark, sf_dir):
    return quality.not_null_share_below(tb.long_results(spark, sf_dir), "sex", 0.95)


@query("quality_orphans", "SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def orphans(spark, sf_dir):
    """Documents without a label."""
    child = tb.table(spark, sf_dir, "documents").select("doc_id", "lang", "source")
    return quality.orphans(child, "doc_id", tb.table(spark, sf_dir, "labels"))


@query("quality_equal_rows", f"{SAMPLES} SELECT (SELECT COUNT(*) FROM samples) AS rows, (SELECT COUNT(*) FROM long_rows) AS other_rows WHERE (SELECT COUNT(*) FROM samples) != (SELECT COUNT(*) FROM long_rows)")
def equal_rows(spark, sf_dir):
    return quality.unequal_rows(frames.samples(spark, sf_dir), tb.long_results(spark, sf_dir))


_MATCH = " OR ".join(f"(pathogen = '{p}' AND result = {p}_test_result)" for p in vocab.PATHOGENS)


@query("quality_expression", f"WITH {ob.UNPIVOTED} SELECT sample_id, pathogen FROM up WHERE ({_MATCH}) IS NOT TRUE")
def expression(spark, sf_dir):
    """Unpivoted results equal their wide column; those without a label cannot be confirmed."""
    rows = unpivot_results(facts.rows(frames.full_panel(spark, sf_dir), tb.AS_OF))
    return quality.violates(rows, F.expr(_MATCH)).select("sample_id", "pathogen")


_REPORT = f"""{SAMPLES}, f AS (
SELECT 'null sex' AS "check", (SELECT COUNT(*) FROM samples WHERE sex IS NULL) AS failures, 0 AS w, 1000000000 AS e
UNION ALL SELECT 'age range', (SELECT COUNT(*) FROM samples WHERE age < 0 OR age > 120), 1000000000, 0
UNION ALL SELECT 'unique key', (SELECT COUNT(*) FROM (SELECT sample_id FROM samples GROUP BY ALL HAVING COUNT(*) > 1)), 0, 0)
SELECT "check", 'samples' AS model, failures, CASE WHEN failures > e THEN 'error' WHEN failures > w THEN 'warn' ELSE 'pass' END AS status FROM f"""


@query("quality_report", _REPORT)
def report(spark, sf_dir):
    rows = frames.samples(spark, sf_dir)
    return quality.report(
        [
            quality.Check("null sex", "samples", quality.nulls(rows, "sex"), warn_above=0, error_above=1_000_000_000),
            quality.Check("age range", "samples", quality.outside_range(rows, "age", 0, 120), warn_above=1_000_000_000),
            quality.Check("unique key", "samples", quality.duplicates(rows, "sample_id"), warn_above=0),
        ]
    )


# -- suites of the models -----------------------------------------------------


def _rule_sql(r: suites.Rule) -> str:
    """Failures of a rule over the table ``t``."""
    today, c = ob.AS_OF, f'"{r.column}"'
    rows = {
        "not_null": f"{c} IS NULL" + (f" AND date_testing > {today} - {r.days}" if r.days else ""),
        "accepted": f"{c} NOT IN {ob.in_list(r.values)}",
        "forbidden": f"{c} IN {ob.in_list(r.values)}",
        "range": f"{c} < {r.low} OR {c} > {r.high}",
        "past": f"{c} > {today}",
        "any_result": _ALL("'NT'"),
        "kit": _KIT_BROKEN,
    }
    if r.kind in rows:
        return f"(SELECT COUNT(*) FROM t WHERE {rows[r.kind]})"
    if r.kind == "unique":
        return f"(SELECT COUNT(*) FROM (SELECT {c} FROM t WHERE {c} IS NOT NULL GROUP BY {c} HAVING COUNT(*) > 1))"
    if r.kind == "share":
        return f"(SELECT CASE WHEN AVG(CASE WHEN {c} IS NULL THEN 0.0 ELSE 1.0 END) < {r.low} THEN 1 ELSE 0 END FROM t)"
    if r.kind == "fresh":
        newest = " UNION ALL ".join(f"SELECT MAX(date_testing) AS d FROM t WHERE {p}_test_result <> 'NT'" for p in r.values)
        return f"(SELECT COUNT(*) FROM ({newest}) WHERE d < {today} - 5)"
    days = f"(SELECT DISTINCT start_date FROM epiweeks WHERE start_date >= {today} - 30 AND start_date <= {today})"
    return f"(SELECT COUNT(*) FROM (SELECT start_date, COUNT(t.date_testing) AS n FROM {days} LEFT JOIN t ON t.date_testing >= start_date AND t.date_testing < start_date + 7 GROUP BY ALL) WHERE n < {r.low} OR n > {r.high})"


def _suite_sql(suite: suites.Suite, table: str) -> str:
    never = 10**18
    lines = " UNION ALL ".join(
        f"SELECT '{r.name}' AS c, {_rule_sql(r)} AS n, {never if r.warn is None else r.warn} AS w, {never if r.error is None else r.error} AS e" for r in suite.rules
    )
    return f"WITH t AS MATERIALIZED ({table}), {ob.EPIWEEKS} SELECT c AS \"check\", '{suite.model}' AS model, CAST(n AS BIGINT) AS failures, CASE WHEN n > e THEN 'error' WHEN n > w THEN 'warn' ELSE 'pass' END AS status FROM ({lines})"


def _suite(lab_id: str) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return suites.grade(LABS[lab_id].wide(tb.raw(spark, sf_dir, lab_id)), suites.SUITES[lab_id], tb.AS_OF)

    query(f"suite_{lab_id.lower()}", _suite_sql(suites.SUITES[lab_id], oracle_labs.lab_sql(lab_id)))(run)


for _lab in LABS:
    _suite(_lab)


@query("suite_panel", _suite_sql(suites.SUITES["PANEL"], f"{PANEL} SELECT * FROM panel"))
def suite_panel(spark, sf_dir):
    """The panel graded by what was seen while it was written."""
    return suites.write_checked(frames.full_panel(spark, sf_dir), scratch(spark, "panel"), suites.SUITES["PANEL"], datetime.date.fromisoformat(tb.AS_OF))
