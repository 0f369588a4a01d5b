"""Operators that compare rows, against brute force."""

import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from labwatch.llm import line_dedup, mixing, multi_index, ngram_join, suffix_dedup


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def changed(draw, items, fresh, most):
    out = list(items)
    for _ in range(draw.randint(0, most)):
        at = draw.randrange(len(out) + 1)
        kind = draw.random()
        if kind < 0.35:
            out.insert(at, fresh())
        elif out and kind < 0.7:
            out.pop(min(at, len(out) - 1))
        elif out:
            out[min(at, len(out) - 1)] = fresh()
    return out


# mixing


def laid_out(plan, blocks):
    """The source of each slot of a schedule."""
    out = {}
    rounds = {}
    for r in plan:
        rounds.setdefault(r["s"], []).append(r)
    for s, phases in rounds.items():
        for j in range(blocks[s]):
            r = max((p for p in phases if p["first"] <= j), key=lambda p: (p["first"], p["phase"]))
            turn = j - r["first"]
            slot = r["base"] + turn // len(r["places"]) * r["size"] + r["places"][turn % len(r["places"])]
            assert slot not in out
            out[slot] = s
    assert sorted(out) == list(range(len(out)))
    return [out[i] for i in range(len(out))]


def test_schedule_stays_within_a_block_of_the_given_weights():
    """At every slot until a source ends, for weights with and without a common measure."""
    cases = (
        {"a": 1, "b": 1, "c": 1}, {"a": 0.9996, "b": 0.0004}, {"a": math.sqrt(2), "b": math.pi, "c": math.e}, {"a": 5, "b": 3, "c": 1, "d": 0.5},
        {f"s{i}": 1 for i in range(7)}, {"a": 1000, "b": 1}, {f"s{i}": 1 / (i + 1) for i in range(12)}, {"a": 1e-9, "b": 1},
    )
    for weights in cases:
        total = sum(map(Fraction, weights.values()))
        blocks = {k: int(100_000 * Fraction(w) / total) + 2 for k, w in weights.items()}
        order = laid_out(mixing.schedule(blocks, weights), blocks)
        done = dict.fromkeys(weights, 0)
        for i, s in enumerate(order, 1):
            done[s] += 1
            if i % 97 == 0 or i < 2_000:
                assert all(abs(done[k] - i * Fraction(w) / total) < 1 for k, w in weights.items())
            if done[s] == blocks[s]:
                break
        assert i > 50_000


def test_sources_without_weight_come_last():
    blocks = {"a": 5, "b": 7, "c": 3, "d": 4}
    order = laid_out(mixing.schedule(blocks, {"a": 2, "b": 1, "c": 0, "d": 0}), blocks)
    assert set(order[:12]) == {"a", "b"} and order[12:] == ["c", "d", "c", "d", "c", "d", "d"]
    assert mixing.schedule({}, {}) == []
    with pytest.raises(ValueError):
        mixing.schedule({"a": 1}, {"a": -1})


def test_mix_keeps_every_row_and_its_share(spark):
    rows = [(i, "a" if i % 3 == 0 else "b" if i % 3 == 1 else None, f"t{i}", i) for i in range(3_000)] + [(1, "b", "t1", 1)] * 5
    df = spark.createDataFrame(rows, "doc_id long, source string, text string, position long")
    out = mixing.mix(df, {"a": 3.0, "b": 1.0}, block=8, bucket_rows=100).collect()
    assert len(out) == len(rows) and len({r["position"] for r in out}) == len(rows)
    slots = {}
    for r in out:
        assert slots.setdefault(r["slot"], r["row"]["source"]) == r["row"]["source"]
    assert sorted(slots) == list(range(len(slots)))
    first = [slots[i] for i in range(100)]
    assert abs(first.count("a") - 75) <= 1
    mixed = mixing.mixed(df, {"a": 3.0, "b": 1.0}, block=8)
    assert mixed.columns == df.columns and sorted(map(tuple, mixed.collect()), key=repr) == sorted(rows, key=repr)
    assert mixing.mix(df.limit(0)).count() == 0
    assert mixing.mix(df.limit(0).unionAll(df.filter("source is null")), {"a": 1.0}).count() == 1000


# lines


def test_bit_parallel_distance(spark):
    from pyspark.sql import functions as F

    draw = random.Random(3)
    pairs = []
    for _ in range(300):
        a = draw.choices("abé", k=draw.randint(1, 9))
        pairs.append(("".join(a), "".join(changed(draw, a, lambda: draw.choice("abé"), 4)) or "a"))
    df = spark.createDataFrame(pairs, "a string, b string")
    for t in (1, 2, 3):
        got = df.select("a", "b", line_dedup.within(F.split("a", ""), F.split("b", ""), t).alias("w")).collect()
        assert all(r["w"] == (edits(r["a"], r["b"]) <= t) for r in got)


def test_line_dedup(spark):
    from pyspark.sql import functions as F

    draw = random.Random(8)
    base = ["".join(draw.choices("abcde ", k=draw.randint(20, 30))) for _ in range(25)]
    docs = []
    for i in range(80):
        lines = ["".join(changed(draw, draw.choice(base), lambda: draw.choice("abcde"), 4)) if draw.random() < 0.8 else draw.choice(["", "x", "  "]) for _ in range(draw.randint(0, 6))]
        docs.append((i, "\n".join(lines)))
    docs += [(None, docs[3][1]), (5, docs[5][1]), (7, "another text that is long enough"), (300, None), (301, ""), (302, "long line " * 9_000)]
    df = spark.createDataFrame([(i, t, "x") for i, t in docs], "doc_id long, text string, gone string")
    hashes = {r["text"]: r["h"] for r in df.select("text", F.xxhash64("text").alias("h")).collect()}
    lines = sorted({(line_dedup.NO_ID if d is None else d, p, hashes[t], x) for d, t in docs if t is not None for p, x in enumerate(t.split("\n")) if len(x.strip(" ")) >= 20})
    gone = {}
    for k, (d, p, h, x) in enumerate(lines):
        exact = any(y[3] == x for y in lines[:k])
        if exact or any(abs(len(y[3]) - len(x)) <= 2 and edits(y[3], x) <= 2 for y in lines[:k]):
            gone.setdefault((d, h), []).append((p, exact))
    expected = []
    for d, t in docs:
        own = sorted(gone.get((line_dedup.NO_ID if d is None else d, hashes[t]), []))
        expected.append((d, len(t.split("\n")) if t is not None else 0, sum(e for _, e in own), sum(not e for _, e in own), ",".join(str(p) for p, _ in own)))
    got = [tuple(r) for r in line_dedup.line_dedup(df).collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    left = {(r["doc_id"], r["gone"]): r["text"] for r in line_dedup.without_repeats(df).collect()}
    for (d, t), e in zip(docs, expected, strict=True):
        rest = "\n".join(x for p, x in enumerate((t or "").split("\n")) if str(p) not in e[4].split(","))
        if e[4] and not rest.strip(" \n"):
            assert (d, "x") not in left or d in (5, 7)
        elif d not in (5, 7):
            assert left[d, "x"] == (rest if t is not None else None)
    assert line_dedup.line_dedup(df.limit(0)).count() == 0


def test_lines_probe_one_side(spark):
    """Eight probes a line find every near line that shares no segment in its place (five of equal length, own segments among them, were dealt out before)."""
    from pyspark.sql import functions as F

    draw = random.Random(88)
    pairs = []
    for _ in range(400):
        a = "".join(draw.choices("ab", k=draw.randint(20, 24)))
        b = a
        for kind in draw.choice(["-+", "+-", "--", "++", "=-", "+=", "==", "-", "+"]):
            at = draw.randint(0, len(b) - 1)
            b = b[:at] + ("" if kind == "-" else draw.choice("ab")) + b[at + (kind != "+") :]
        pairs += [(a, b)] * (a != b)
    df = spark.createDataFrame(pairs, "a string, b string")
    keys = lambda of, c: F.array(*of(F.col(c), F.length(c), 2))
    rows = df.select("a", "b", *(keys(of, c).alias(f"{n}{c}") for n, of in (("own", line_dedup.index_keys), ("probe", line_dedup.probe_keys)) for c in "ab")).collect()
    assert rows and all(len(r["probea"]) == 8 for r in rows)
    for r in rows:
        own_a, own_b = set(r["owna"]), set(r["ownb"])
        assert own_a & own_b or own_a & set(r["probeb"]) or own_b & set(r["probea"]), (r["a"], r["b"])


# passages


def brute_repeats(docs):
    first = {}
    for i, t in docs:
        b = (t or "").encode()
        for k in range(len(b) - 49):
            first[b[k : k + 50]] = min(first.get(b[k : k + 50], i), i)
    out = {}
    for i, t in docs:
        b = (t or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for k in range(len(b) - 49):
            if first[b[k : k + 50]] < i:
                gone[k : k + 50] = True
        rest = np.frombuffer(b, np.uint8)[~gone[:-1]].tobytes()
        out[i] = (len(b), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(rest).hexdigest())
    return out


def test_suffix_array_and_prefixes():
    draw = random.Random(4)
    for t in (b"banana" * 30, bytes(draw.choices(b"ab", k=2_000)), b"a" * 400, b"ab\0\0", b"x"):
        raw = np.frombuffer(t, np.uint8)
        order = suffix_dedup.suffix_array(raw)
        assert [t[i:] for i in order] == sorted(t[i:] for i in range(len(t)))
        common = suffix_dedup.common_prefixes(raw, order, 50)
        for k in range(1, len(order)):
            a, b = t[order[k - 1] :][:50], t[order[k] :][:50]
            n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert common[k] == n


def test_merging_of_arrays_by_binary_search():
    draw = random.Random(6)
    base = bytes(draw.choices(b"abc", k=300))
    stretches = [base[a : a + draw.randint(50, 120)] for a in (draw.randint(0, 180) for _ in range(40))]
    low = np.array(draw.sample(range(1000), 40))
    assert all(np.array_equal(a, b) for a, b in zip(suffix_dedup.least_documents(stretches, low), suffix_dedup.least_documents(stretches, low, 200), strict=True))


def test_suffixes_that_start_whole_strings_are_sorted_alone():
    draw = random.Random(5)
    for letters in (b"a", b"ab", bytes(range(256))):
        t = bytes(draw.choices(letters, k=3_000))
        at = np.array(sorted(draw.sample(range(len(t) - 49), 500)))
        order = suffix_dedup.suffix_array(np.frombuffer(t, np.uint8), at, 50)
        assert sorted(order) == at.tolist()
        assert [t[i : i + 50] for i in order] == sorted(t[i : i + 50] for i in at)


def test_shards_give_runs_without_a_join(spark, monkeypatch):
    """A shard puts copies together as they come, and its places take the runs; copies of places meet no join."""
    df = spark.createDataFrame([(i, "a passage that is long enough to be removed wherever it stands. " * 2) for i in range(40)], "doc_id long, text string")
    assert "Join" not in suffix_dedup.repeats(df)._jdf.queryExecution().executedPlan().toString()
    monkeypatch.setattr(suffix_dedup, "PART_BYTES", 64)
    monkeypatch.setattr(suffix_dedup, "RUNS", 7)
    draw = random.Random(9)
    base = bytes(draw.choices(b"abc", k=300))
    rows, texts, sizes = [], {}, []
    for block in range(60):
        cuts = [draw.randint(0, 180) for _ in range(3)]
        data = b"".join(base[a : a + 76] for a in cuts)
        first, one = np.arange(3) * 76, np.arange(3)
        texts |= {block * 3 + k: base[a : a + 76] for k, a in enumerate(cuts)}
        rows.append((0, suffix_dedup.STRETCHES, block, suffix_dedup.packed(data, block * 3 + one, first, first + 76, np.full(3, 20))))
        rows.append((0, suffix_dedup.PLACES, block, suffix_dedup.places(one, 0 * one, one, block * 3 + one, 7 + one)))
    rows.sort(key=lambda r: r[1])
    shard = suffix_dedup.Shard(0)
    for _, kind, block, data in rows:
        if kind == suffix_dedup.STRETCHES:
            shard.add(block, data)
            sizes.append(len(shard.new))
    assert max(sizes) < 60 and shard.single
    table = pa.Table.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int64(), pa.binary()), strict=True)], ["part", "kind", "block", "data"])
    out = list(suffix_dedup.judged(iter(table.to_batches(max_chunksize=11)), 3))
    assert len(out) > 1
    got = {}
    for part in range(3):
        group = [b.filter(pa.array([p == part for p in b.column(0).to_pylist()])) for b in out]
        for b in suffix_dedup.by_document(iter(group)):
            got |= {r["d"]: np.frombuffer(r["runs"], "<i8").reshape(-1, 2).tolist() for r in b.to_pylist()}
    first = {}
    for d, t in texts.items():
        for k in range(27):
            first.setdefault(t[k : k + 50], d)
    for d, t in texts.items():
        gone = np.zeros(77, bool)
        for k in range(27):
            if first[t[k : k + 50]] < d:
                gone[k : k + 50] = True
        edge = np.flatnonzero(np.diff(np.r_[False, gone]))
        assert got.get(d, []) == edge.reshape(-1, 2).tolist()


def test_suffix_dedup(spark):
    draw = random.Random(2)
    base = ["".join(draw.choices("abcdé \n", k=draw.randint(40, 400))) for _ in range(15)]
    docs = []
    for i in range(120):
        docs.append((i * 3, "".join(draw.choice(base)[draw.randint(0, 60) :][: draw.randint(20, 300)] + "".join(draw.choices("abcdé \n", k=draw.randint(0, 30))) for _ in range(draw.randint(0, 4)))))
    docs += [(1000, None), (1001, ""), (1002, "a" * 50_000), (1003, "a" * 49), (1004, "a" * 50), (1005, "ab" * 300)]
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, start int")
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.suffix_dedup(df).collect()}
    assert got == brute_repeats(docs)
    kept = {r["doc_id"]: (r["kept_sha256"], hashlib.sha256(bytes(r["kept_bytes"])).hexdigest()) for r in suffix_dedup.suffix_dedup(df, texts_kept=True).collect()}
    assert all(a == b for a, b in kept.values()) and len(kept) == len(docs)
    assert suffix_dedup.suffix_dedup(df.limit(0)).count() == 0


def test_strings_of_frequent_anchors_are_dealt_one_by_one(spark):
    """One notice in every document, between random letters: no shard gets more than twice its share, and results stay the same."""
    draw = random.Random(12)
    letters = "abcdefghijklmnopqrstuvwxyz"
    notice = "All rights reserved. All rights reserved. "
    docs = [(i, "".join(draw.choices(letters, k=60)) + notice + "".join(draw.choices(letters, k=60))) for i in range(3_000)]
    docs += [(5_000 + i, "x" * i + "The very same passage stands in many documents, word for word, line for line.") for i in range(500)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    expected = brute_repeats(docs)
    for most in (100, suffix_dedup.HOT):
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.suffix_dedup(df, most=most).collect()}
        assert got == expected
    total = sum(len(t) for _, t in docs)
    codes = suffix_dedup.repeated_anchors(df, "text", total, 100).cache()
    field = lambda c: suffix_dedup.bloom(c.select("code"), c.count())
    _, distinct = suffix_dedup.contexts(df, "text", suffix_dedup.dealt_bits(total), field(codes), field(codes.filter("hot")), 16)
    blocks = {}
    for r in distinct.collect():
        blocks.setdefault(r["part"], []).append(bytes(r["stretches"]))
    sizes = sorted(len(suffix_dedup.Stretches(x).low) for x in blocks.values())
    assert sizes[-1] <= 2 * sizes[len(sizes) // 2]


def test_rows_with_equal_ids_spare_each_other(spark):
    text = "a passage that is long enough to be removed wherever it stands twice."
    df = spark.createDataFrame([(1, text), (1, text), (1, "x" + text), (2, text), (None, text), (None, text)], "doc_id long, text string")
    got = sorted((r["doc_id"] or 9, r["n_removed"]) for r in suffix_dedup.suffix_dedup(df).collect())
    n = len(text)
    assert got == [(1, 0), (1, 0), (1, 0), (2, n), (9, n), (9, n)]


def test_large_tables_are_dealt_to_buckets(spark, monkeypatch):
    """Where a field can't hold the anchors that may repeat, buckets get bits of their own; results stay the same, and only what repeats is dealt out."""
    monkeypatch.setattr(suffix_dedup, "SMALL_BYTES", 0)
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", 30_000)
    draw = random.Random(21)
    letters = "abcdefghijklmnopqrstuvwxyz é\n"
    passages = ["".join(draw.choices(letters, k=draw.randint(40, 300))) for _ in range(30)]
    docs = [(i, "".join(draw.choices(letters, k=draw.randint(0, 200))) + "".join(draw.choice(passages)[draw.randint(0, 40) :] for _ in range(draw.randint(0, 2))) + "All rights reserved. " * draw.randint(0, 6)) for i in range(900)]
    docs += [(2_000, None), (2_001, ""), (2_002, "a" * 20_000), (2_003, "a" * 49), (2_004, "a" * 50)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    expected = brute_repeats(docs)
    for most in (100, suffix_dedup.HOT):
        got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffix_dedup.suffix_dedup(df, most=most).collect()}
        assert got == expected
    plan = suffix_dedup.repeats(df)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan
    assert suffix_dedup.suffix_dedup(df.limit(0)).count() == 0
    text = passages[0] + "b" * 50
    same = spark.createDataFrame([(1, text), (1, text), (1, "x" + text), (2, text), (None, text), (None, text)], "doc_id long, text string")
    n = len(text.encode())
    assert sorted((r["doc_id"] or 9, r["n_removed"]) for r in suffix_dedup.suffix_dedup(same).collect()) == [(1, 0), (1, 0), (1, 0), (2, n), (9, n), (9, n)]
    alone = spark.createDataFrame([(i, "".join(draw.choices(letters, k=500))) for i in range(400)] + [(500 + i, passages[0][:200] + passages[1][:40]) for i in range(2)], "doc_id long, text string")
    texts = suffix_dedup.bucketed(alone, "text", 7)
    repeated = suffix_dedup.repeated_in_buckets(texts, 4).cache()
    assert {r["bucket"] for r in repeated.collect()} == set(range(7))
    rows = suffix_dedup.bucket_contexts(texts, 4, repeated, 16).collect()
    places = [suffix_dedup.unpacked(pa.py_buffer(bytes(r["data"]))) for r in rows if r["kind"] == suffix_dedup.PLACES]
    assert {int(d) for x in places for d in x[0][x[2]]} == {500, 501}


def test_a_task_deals_stretches_out_together(spark, monkeypatch):
    """Batches don't make rows of their own for each shard, and documents share parts larger than shards."""
    monkeypatch.setattr(suffix_dedup, "BATCH_BYTES", 2_000)
    draw = random.Random(22)
    passages = ["".join(draw.choices("abcdefgh ", k=200)) for _ in range(50)]
    df = spark.createDataFrame([(i, "".join(draw.sample(passages, 3))) for i in range(600)], "doc_id long, text string").coalesce(1)
    bits = suffix_dedup.dealt_bits(360_000)
    codes = suffix_dedup.repeated_anchors(df, "text", 360_000).cache()
    field = lambda c: suffix_dedup.bloom(c.select("code"), c.count())
    dealt, _ = suffix_dedup.contexts(df, "text", bits, field(codes), field(codes.filter("hot")), 16)
    rows = dealt.collect()
    assert len(rows) == len({(r["part"], r["kind"]) for r in rows}) == 32


# near copies


def brute_components(docs):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = []
    for _, t in docs:
        w = [x for x in "".join(" " if c in "\t\n\x0b\f\r" else c for c in (t or "").translate(lower)).split(" ") if x]
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    up = list(range(len(docs)))

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            n = len(sets[a] & sets[b])
            if n and 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
                up[max(top(a), top(b))] = min(top(a), top(b))
    return {i: (len(sets[k]), min(j for m, (j, _) in enumerate(docs) if top(m) == top(k)) if sets[k] else i) for k, (i, _) in enumerate(docs)}


def near_copies(seed, n):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(200)]
    base = [draw.choices(vocabulary, k=draw.randint(3, 80)) for _ in range(12)]
    docs = [(i, draw.choice([" ", "\n", "\t "]).join(changed(draw, draw.choice(base), lambda: draw.choice(vocabulary).upper(), 3))) for i in range(n)]
    return docs + [(900, None), (901, ""), (902, " \n"), (903, "A b"), (904, "a  B"), (905, "long text " * 20_000)]


def components(spark, docs):
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id long, text string, cls int")
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.ngram_join(df).collect()}


def test_ngram_join(spark):
    docs = near_copies(1, 250)
    assert components(spark, docs) == brute_components(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = {r["doc_id"] for r in ngram_join.one_of_each(df).collect()}
    assert kept == {i for i, (_, c) in brute_components(docs).items() if i == c}
    assert ngram_join.ngram_join(df.limit(0)).count() == 0


@pytest.mark.parametrize("leaf, growth", [(1_500, 4.0), (1_500, 0.0), (10**6, 2.0)])
def test_ngram_join_splits_dense_regions(spark, monkeypatch, leaf, growth):
    """By pivots, block by block, and at once."""
    monkeypatch.setattr(ngram_join, "RARE", 3)
    monkeypatch.setattr(ngram_join.dense_links, "__defaults__", (leaf, 4, growth))
    docs = near_copies(2, 250)
    assert components(spark, docs) == brute_components(docs)


def test_region_of_near_copies():
    """Thousands of sets around one, many of them further apart than a link, against all pairs."""
    import pyarrow as pa

    draw = np.random.default_rng(8)
    base = draw.choice(1 << 20, 60, replace=False)
    sets = [np.unique(np.r_[draw.choice(base, draw.integers(40, 60), replace=False), draw.choice(1 << 20, draw.integers(0, 12))]).astype(np.uint64) for _ in range(500)]
    core = draw.random(500) < 0.9
    comp = draw.integers(0, 300, 500)
    batch = pa.record_batch({"cls": pa.array(np.arange(500)), "comp": pa.array(comp), "core": pa.array(core), "n": pa.array([len(s) for s in sets]), "tokens": pa.array([s.tobytes() for s in sets])})
    up = {int(c): int(c) for c in comp}
    top = lambda k: k if up[k] == k else top(up[k])
    mine = dict(up)
    mine_top = lambda k: k if mine[k] == k else mine_top(mine[k])
    for i in range(500):
        for j in range(i):
            inter = len(np.intersect1d(sets[i], sets[j]))
            if (core[i] or core[j]) and 100 * inter >= 80 * (len(sets[i]) + len(sets[j]) - inter):
                up[top(comp[i])] = top(comp[j])
    for out in ngram_join.join_region(iter([batch])):
        for a, b in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True):
            assert mine_top(comp[a]) != mine_top(comp[b])  # no link is given twice
            mine[mine_top(comp[a])] = mine_top(comp[b])
    groups = lambda t: {frozenset(c for c in up if t(c) == r) for r in {t(c) for c in up}}
    assert groups(top) == groups(mine_top) and len(groups(top)) < 250


# vectors


def test_multi_index(spark):
    draw = np.random.default_rng(3)
    x = draw.normal(size=(600, 8))
    x[100:140] = x[100]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(700, None, 0), (720, [0.0] * 8, 0), (740, [1.0] * 7 + [float("nan")], 0), (760, [1.0] * 7 + [None], 0), (None, [1.0] * 8, 0), (780, [1.0, 2.0], 0), (20, x[20].tolist(), 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, cell int")
    out = multi_index.search(df, centroids=8, shard=100, queries=7)
    ids = np.r_[np.arange(600), 20]
    full = np.vstack([x, x[20]])
    got = {}
    for r in out.collect():
        got.setdefault(r["query_id"], {})[r["rank"]] = (r["vec_id"], r["score"])
    assert sorted(got) == list(range(0, 600, 20))
    hit = 0
    for q, found in got.items():
        assert sorted(found) == list(range(1, 21))
        score = (full * x[q]).sum(1)
        score[ids == q] = -np.inf
        best = np.lexsort((ids, -score))[:20]
        hit += len({ids[b] for b in best} & {v for v, _ in found.values()})
        assert all(np.isclose(s, (x[v] * x[q]).sum()) for v, s in found.values())
        order = [(-s, v) for v, s in (found[k] for k in range(1, 21))]
        assert order == sorted(order)
    assert hit >= 0.9 * 20 * len(got)
    assert multi_index.search(df.limit(0)).count() == 0
    few = multi_index.search(spark.createDataFrame(rows[:5], df.schema), centroids=8)
    assert few.count() == 4
