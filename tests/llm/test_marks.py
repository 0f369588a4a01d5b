"""Personal data and fill-in-the-middle against plain Python."""

import hashlib
import random
import re

import pytest

from labwatch.llm import fill_middle, pii

SPACE = " "
IBANS = ["DE89370400440532013000", "GB29 NWBK 6016 1331 9268 19", "FR14 2004 1010 0505 0001 3M02 606"]
CASES = [
    None, "", " ", "plain words", "mail me at jane.doe+x@mail.example.com, or a@b.c.d.e. or a@b", "a@b.c_x@d.e and @x.y a@.b a@b..c", "x@y.z@w.v", "é.ü@mail.de ñandú@x.org 日本a@b.co🎉 c@d.ee",
    "1.2.3.4 256.1.1.1 1.2.3.4.5.6.7.8 0000255.1.1.1 1.2.3 1.2.3.999 10.0.0.1.", "version 1.2.3.4 of host 10.1.2.3",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111 11111 111 1111", "4111111111111111 4111111111111111", "card 378282246310005 x 30569309025904 y 36 1 2", "4111  1111 1111 1111 1 1 1 1", "0" * 14, "0" * 20, "79927398713",
    "+1 (743) 555-3824 +49 30 1234567 +1234567890123456 +12 +1-- +1()5 ++1 222 333 4444", "call +1 (743) 555-3824) please, +1 (743) 555-3824.", "+1 222 333 4444+1 222 333 4444",
    *IBANS, f"my account {IBANS[1]} AND MORE {IBANS[0]}", "DE89370400440532013001", "xDE89370400440532013000", "ssn 123-45-6789, 123-45-6789", "order 123-45-6789 " + "word " * 12 + "social security 000-45-6789 666-45-6789 912-45-6789 078-05-1120",
    "a" * 60_000 + " a@b.de", "a@" + "b." * 30_000 + "c", "1" * 60_000 + " 4111111111111111", "+1" + "(" * 60_000 + "2", "1." * 30_000, ("x@y.org " * 700) + "+1 222 333 4444", "1 " * 30_000,
]


def luhn(digits):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    """The base spans, by the expressions as specified."""
    out = [(m.start(), 0, "email", m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)] if "@" in text else []
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(x) <= 255 for x in m[0].split("."))] if "." in text else []
    for m in re.finditer(r"[0-9](?:[\x20-]?[0-9])+", text):
        digits = re.sub("[ -]", "", m[0])
        out += [(m.start(), 2, "card", m.end())] if 14 <= len(digits) <= 19 and luhn(digits) else []
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        out += [(m.start(), 3, "phone", m.end())] if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15 else []
    return sorted(out)


def listed(spans):
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)


def frame(spark, texts):
    rows = [(i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "c@d.ee", "y", 2), (1, texts[-1], None, None), (1, texts[-1], None, None)]
    return spark.createDataFrame(rows, "doc_id long, text string, found string, gap_email int")


@pytest.fixture(scope="module")
def drawn():
    """Random strings over the characters that the expressions care about."""
    draw = random.Random(11)
    parts = ["a", "Z", "é", "@", ".", "..", "-", "+", " ", "(", ")", "_", "%", "1", "25", "256", "+1", "x@y", ".de", "4111 1111 1111 111", "日"]
    return ["".join(draw.choices(parts, k=draw.randrange(3, 60))) for _ in range(4_000)]


def test_base_spans(spark, drawn):
    for texts in (CASES, drawn):
        docs = frame(spark, texts)
        expected = []
        for r in docs.collect():
            spans = brute(r["text"] or "")
            expected.append((r["doc_id"], *(sum(s[1] == k for s in spans) for k in range(4)), hashlib.sha256(listed(spans).encode()).hexdigest()))
        out = pii.pii(docs)
        got = [tuple(r) for r in out.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256").collect()]
        assert sorted(got, key=repr) == sorted(expected, key=repr)


def test_added_spans_and_scores(spark):
    texts = ["", *IBANS, "DE89370400440532013001", "ssn 123-45-6789", "123-45-6789", "order 123-45-6789, ssn", "social security 666-45-6789", "call +1 (743) 555-3824", "version 1.2.3.4"]
    rows = {r["doc_id"]: r for r in pii.pii(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert [rows[i]["scores"] for i in range(len(texts))] == [
        "", *(f"iban:0:{len(x)}=70" for x in IBANS), "", "ssn:4:15=60", "", "", "", "phone:5:22=70", "ip:8:15=20",
    ]
    assert [rows[i]["n_added"] for i in (0, 1, 4, 5)] == [0, 1, 0, 1]


def test_places_beyond_a_chunk(spark):
    """Running sums over more matches than a chunk holds."""
    text = "ä b@c.de " * (3 * pii.CHUNK + 5)
    found = pii.findings(spark.createDataFrame([(1, text)], "doc_id long, text string")).collect()[0]["found"]
    assert [(s["start"], s["end"]) for s in found] == [(m.start(), m.end()) for m in re.finditer("b@c.de", text)]
    assert pii.pii(spark.createDataFrame([], "doc_id long, text string")).collect() == []


TEXTS = [None, "", "a", "ab", "x<P>y", "<S", "line\nline", "日本語テキスト🎉ñandú" * 40, "word " * 30_000, "🎉" * 20_000, *(f"text number {i} é🎉 of some length" for i in range(300))]


def brute_middle(doc_id, text):
    draw = [int(hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()[i : i + 8], 16) for i in range(0, 32, 8)]
    n = len(text)
    if not text or re.search("<[PSM]>", text) or draw[2] % 100 >= 90:
        return "plain", None, None, text
    a, b = sorted((draw[0] % (n + 1), draw[1] % (n + 1)))
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if draw[3] % 100 < 20:
        return "spm", a, b - a, f"<S>{suffix}<P>{prefix}<M>{middle}"
    return "psm", a, b - a, f"<P>{prefix}<S>{suffix}<M>{middle}"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("size", [7, 1_000, fill_middle.FRAME_BYTES])
def test_fill_middle(spark, size):
    texts = TEXTS if size > 7 else [t and t[:400] for t in TEXTS]
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(None, "no id " * 30, "y"), (1, "twice", None), (1, "twice", None)], "doc_id long, text string, form string")
    rows = [(r["doc_id"], r["text"] or "") for r in docs.collect()]
    expected = []
    for i, t in rows:
        form, prefix, middle, output = brute_middle(i, t)
        expected.append((i, len(t), form, prefix, middle, digest(output), digest(t)))
    out = fill_middle.fill_middle(docs, frame_bytes=size)
    got = [tuple(r) for r in out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256").collect()]
    assert sorted(got, key=repr) == sorted(expected, key=repr)
    assert {r["form"] for r in out.collect()} == {"plain", "psm", "spm"}
    back = [(r["doc_id"], r["output"]) for r in fill_middle.output_text(out).collect()]
    assert sorted(back, key=repr) == sorted(((i, brute_middle(i, t)[3]) for i, t in rows), key=repr)
    assert fill_middle.fill_middle(docs.limit(0)).count() == 0


def test_frames_seek():
    text = ("aé日🎉" * 500)
    for size in (1, 5, 64, 10_000):
        stored = fill_middle.Frames.of(text.encode(), size)
        assert stored.units[-1] == len(text) and b"".join(stored.read()).decode() == text
        for unit in (0, 1, 2, 3, 4, 777, 1_999, 2_000, 5_000):
            assert stored.place(unit) == len(text[:unit].encode())
        mark = "日🎉a".encode()
        assert stored.find(mark, 10) == text.encode().find(mark, 10) and stored.find(b"<P>") == -1
