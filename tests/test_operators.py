import random
from datetime import date

from pyspark.sql import functions as F

from labwatch import vocab
from labwatch.functions.dates import as_date
from labwatch.operators import collapse, filters, joins, reshape, upsert, windows

from .helpers import frame, tuples

P = vocab.PATHOGENS


def skewed_rows(n=3000):
    """A third of all rows share one key."""
    rng = random.Random(7)
    keys = ["hot" if rng.random() < 0.34 else f"k{rng.randrange(400)}" for _ in range(n)]
    return [(k, rng.choice([1, 0, -1, -2, None]), rng.choice([1, 0, -1]), f"f{rng.randrange(5)}", rng.randrange(90)) for k in keys]


def brute_fill(rows):
    out = {}
    for key, a, b, file, age in rows:
        s = out.setdefault(key, {"a": [], "b": [], "n": 0, "least": (file, age)})
        s["a"].append(a)
        s["b"].append(b)
        s["n"] += 1
        s["least"] = min(s["least"], (file, age))
    label = {1: "Pos", 0: "Neg", -1: "NT"}
    top = lambda xs: label.get(max((x for x in xs if x is not None), default=None))
    return sorted((k, *v["least"], top(v["a"]), top(v["b"]), v["n"]) for k, v in out.items())


def test_collapse_with_a_hot_key(spark):
    rows = skewed_rows()
    df = frame(spark, "sample_id string, a int, b int, file_name string, age int", *rows).repartition(5)
    got = collapse.fill_and_keep_one(df, ["file_name", "age"], results=["a", "b"])
    assert sorted(map(tuple, got.collect()), key=lambda r: r[0]) == brute_fill(rows)


def test_fill_keeps_every_row(spark):
    rows = skewed_rows(600)
    df = frame(spark, "sample_id string, a int, b int, file_name string, age int", *rows)
    got = collapse.fill(df, results=["a", "b"])
    want = {k: (a, b, n) for k, _, _, a, b, n in brute_fill(rows)}
    assert got.count() == 600
    assert all((r.a, r.b, r.qty_original_lines) == want[r.sample_id] for r in got.collect())


def test_keep_one_does_not_depend_on_partitions(spark):
    rows = skewed_rows(500)
    df = frame(spark, "sample_id string, a int, b int, file_name string, age int", *rows)
    assert tuples(collapse.keep_one(df.repartition(7), "sample_id")) == tuples(collapse.keep_one(df.coalesce(1), "sample_id"))


def test_unpivot_then_collapse_is_identity(spark):
    rng = random.Random(3)
    rows = [(f"s{i}", *[rng.choice([1, 0, -1]) for _ in P]) for i in range(40)]
    df = frame(spark, "sample_id string, " + ", ".join(f"{p}_test_result int" for p in P), *rows)
    long = reshape.unpivot_results(df, ["sample_id"])
    again = collapse.one_hot(long, {p: [p] for p in P}, "pathogen").groupBy("sample_id").agg(*[F.max(f"{p}_test_result").alias(f"{p}_test_result") for p in P])
    assert tuples(again, *df.columns) == tuples(df)


def test_split_combined_test(spark):
    df = frame(
        spark, "id string, pathogen string, result string",
        ("1", "AB", "A+"), ("1", "AB", "A+"), ("2", "AB", "?"), ("3", "AB", "INC"), ("4", "X", "POS"), ("5", None, "POS"),
    )
    got = reshape.split_combined_test(
        df, (F.col("pathogen") == "AB") & (F.col("result") != "INC"), F.col("pathogen") != "AB", {"A+": ("POS", "NEG")}, ("A", "B")
    )
    assert tuples(got, "id", "pathogen", "result") == [
        ("1", "A", "POS"), ("1", "B", "NEG"), ("2", "A", "UNKNOWN"), ("2", "B", "UNKNOWN"), ("4", "X", "POS"),
    ]


def test_complete_buckets(spark):
    cells = frame(spark, "place string, week int, n int", ("a", 1, 5), ("b", 3, 7))
    weeks = reshape.calendar_values(frame(spark, "week int", (1,), (2,), (3,)), "week")
    got = reshape.complete_buckets(cells, ["place"], "week", weeks, fill=0)
    assert tuples(got, "place", "week", "n") == [("a", 1, 5), ("a", 2, 0), ("a", 3, 0), ("b", 1, 0), ("b", 2, 0), ("b", 3, 7)]


def test_pivot_values(spark):
    df = frame(spark, "x string", ("b",), ("a",), (None,))
    assert reshape.distinct_values(df, "x") == ["a", "b"]


def test_three_valued_filters(spark):
    df = frame(spark, "a string, b string", ("INCONCLUSIVO", None), ("X", None), (None, None))
    assert df.where(filters.any_informative(["a", "b"])).count() == 1
    wide = frame(spark, "x string, y string", ("NT", "NT"), ("NT", None), ("NT", "Pos"))
    assert wide.where(filters.not_all_untested(["x", "y"])).count() == 1


def test_routing_takes_the_first_branch(spark):
    df = frame(spark, "sc2 boolean, flua boolean, kit string", (True, True, "flu"), (False, True, "flu"), (False, False, "flu"), (True, False, "covid"))
    kept = df.where(filters.routed([(F.col("sc2"), F.col("kit") == "covid"), (F.col("flua"), F.col("kit") == "flu")]))
    assert tuples(kept) == [(False, True, "flu"), (True, False, "covid")]


def test_recent_and_latest(spark):
    df = frame(spark, "d date", (date(2024, 1, 1),), (date(2024, 1, 8),), (date(2024, 1, 15),))
    assert filters.recent(df, "d", 14).count() == 2
    assert filters.latest(df, "d").count() == 1


def test_band_join_equals_expression(spark):
    df = frame(spark, "age int", *[(a,) for a in (-2, -1, 0, 4, 5, 80, 1000, 1001, None)])
    table = joins.literal_table(spark, ["age_group", "min_age", "max_age"], vocab.AGE_BANDS)
    assert tuples(joins.attach_band(df, table)) == tuples(joins.attach_band(df, vocab.AGE_BANDS))


def test_fix_places_both_ways(spark):
    rows = [("Uberba", "MG"), ("uberba ", "Minas Gerais"), ("UBERBA", "GO"), ("Recife", "Value"), (None, None), ("Salvadorba", "BA")]
    df = frame(spark, "location string, state string", *rows)
    states = joins.literal_table(spark, ["source_state", "target_state"], list(vocab.STATE_FIXES.items()))
    places = joins.literal_table(spark, ["source_location", "source_state", "target_location"], [(a, b, c) for (a, b), c in vocab.LOCATION_FIXES.items()])
    want = tuples(joins.fix_places(df, vocab.STATE_FIXES, vocab.LOCATION_FIXES))
    assert tuples(joins.fix_places(df, states, places)) == want
    assert ("UBERABA", "MINAS GERAIS") in want and ("RECIFE", "NOT REPORTED") in want and ("UBERBA", "GOIAS") in want


def test_dimension_headers_are_trimmed(spark, tmp_path):
    (tmp_path / "bands.csv").write_text("age_group, min_age, max_age\n00-04, -1, 4\n")
    assert joins.read_dimension(spark, str(tmp_path / "bands.csv")).first().asDict() == {"age_group": "00-04", "min_age": "-1", "max_age": "4"}


def stamped(spark, *rows):
    return frame(spark, "sample_id string, r_test_result string, created_at string, updated_at string", *rows)


def test_merge(spark):
    target = stamped(spark, ("a", "NT", "t0", "t0"), ("b", "Pos", "t0", "t0"))
    source = stamped(spark, ("b", "Neg", "t1", "t1"), ("c", "Neg", "t1", "t1"))
    merged = upsert.merge(target, source)
    assert tuples(merged) == [("a", "NT", "t0", "t0"), ("b", "Neg", "t0", "t1"), ("c", "Neg", "t1", "t1")]
    assert tuples(upsert.merge(merged, source)) == tuples(merged)
    assert tuples(upsert.merge(None, source)) == tuples(source)


def test_decisive_results_stay(spark):
    target = stamped(spark, ("a", "Pos", "t0", "t0"), ("b", "NT", "t0", "t0"), ("c", None, "t0", "t0"))
    source = stamped(spark, ("a", "Neg", "t1", "t1"), ("b", "Neg", "t1", "t1"), ("c", "Pos", "t1", "t1"), ("d", "NT", "t1", "t1"))
    got = upsert.keep_decisive(target, source, results=["r_test_result"])
    assert tuples(got, "sample_id", "r_test_result") == [("a", "Pos"), ("b", "Neg"), ("c", "Pos"), ("d", "NT")]


def test_top_k_breaks_ties_by_name(spark):
    df = frame(spark, "g string, n string, s int", ("x", "b", 5), ("x", "a", 5), ("x", "c", 9))
    assert tuples(windows.top_k(df, ["g"], "s", 2, ["n"]), "n", "rank") == [("a", 2), ("c", 1)]


def test_null_order(spark):
    df = frame(spark, "a int", (1,), (None,), (2,))
    assert [r.a for r in windows.sort_like_postgres(df, ("a", "asc")).collect()] == [1, 2, None]
    assert [r.a for r in windows.sort_like_postgres(df, ("a", "desc")).collect()] == [None, 2, 1]


def test_empty_weeks_are_counted(spark):
    weeks = joins.calendar(spark).where(F.col("start_date").between(as_date("2024-01-07"), as_date("2024-01-21")))
    df = frame(spark, "date_testing date", (date(2024, 1, 7),), (date(2024, 1, 13),), (date(2024, 1, 22),))
    assert tuples(joins.counts_per_week(df, weeks), "test_count") == [(0,), (1,), (2,)]
