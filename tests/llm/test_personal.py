"""Personal data: base spans against the plain patterns, and what contexts add."""

import hashlib
import random
import re
import time

from talentlake.llm.personal import CONTEXT, base_spans, luhn, personal_data, scan
from talentlake.llm.queries import QUERIES

DATA = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, found string, row int, spans int, added int, value string, pattern string"


def plain(text):
    """(start, kind, end) by the patterns as they are stated."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(part) <= 255 for part in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_base_spans_of_random_texts():
    chosen = random.Random(4)
    kinds = set()
    for _ in range(30_000):
        alphabet = chosen.choice(["0123456789.", "01 -+().", "ab.@-_", "1.@a+ ", "é1.2@ \n"])
        text = "".join(chosen.choices(alphabet, k=chosen.randrange(0, 40)))
        assert base_spans(text) == plain(text), text
        kinds |= {kind for _, kind, _ in plain(text)}
    assert kinds == {0, 1, 2, 3}


def test_query_against_plain_patterns(spark):
    names = ["email", "ip", "card", "phone"]
    rows = QUERIES["op13_bootstrapped_pii"](spark, DATA).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        found = plain(texts[r["doc_id"]])
        spans = [f"{names[kind]}:{start}:{end}" for start, kind, end in found]
        assert r["base_sha256"] == hashlib.sha256(",".join(spans).encode()).hexdigest()
        assert [r[f"n_{name}"] for name in names] == [sum(kind == k for _, kind, _ in found) for k in range(4)]
        assert set(spans) <= set(r["spans"].split(",")) or not spans


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "f", 1, 2, 3, "v", "p") for i, t in rows], SCHEMA)


def added(df, text_of):
    return {
        (r["doc_id"], text_of[r["doc_id"]][s["start"] : s["end"]]) for r in df.collect() for s in r["spans"] if s["kind"] == CONTEXT
    }


def test_contexts_of_seeds_find_unseen_values(spark):
    rows = [(i, f"words here. Please dial us +1 (555) 010-00{i:02d} today") for i in range(10, 20)]
    rows += [(30, "Please dial us 555-0199 today"), (31, "elsewhere 555-0199, once more"), (32, "é ext 555-0142 alone")]
    rows += [(i, f"tel:+1 (555) 010-01{i:02d}") for i in range(40, 50)] + [(50, "my tel:5550123456."), (51, "tel: 77-88-99-00")]
    # A common context is no proof, nor are copies of one value.
    rows += [(i, f"one of the +1 (555) 010-03{i}") for i in range(60, 70)]
    rows += [(i, f"end of the road, end of the line {i}") for i in range(70, 99)] + [(99, "one of the 1234567")]
    rows += [(100 + i, "ring at +1 (555) 010-0999") for i in range(9)] + [(120, "ring at 555-0777")]
    rows += [(130, None), (131, ""), (None, "Please dial us 555-0188")]
    found = added(personal_data(frame(spark, rows)), dict(rows))
    assert found == {
        (30, "555-0199"),
        (31, "555-0199"),
        (50, "5550123456"),
        (51, "77-88-99-00"),
        (None, "555-0188"),
    }


def test_believed_values_make_further_patterns(spark):
    rows = [(i, f"call this number +1 (555) 010-02{i:02d}") for i in range(10, 30)]
    rows += [(100 + i, f"call this number 555-01{i:02d} and fax over 555-01{i:02d}") for i in range(10, 20)]
    rows += [(200, "then fax over 555-0777")]
    assert (200, "555-0777") in added(personal_data(frame(spark, rows)), dict(rows))
    assert (200, "555-0777") not in added(personal_data(frame(spark, rows), rounds=1), dict(rows))


def test_repeated_rows_and_empty_table(spark):
    rows = [(5, "mail a.b@example.com")] * 3
    out = personal_data(frame(spark, rows)).collect()
    assert [[tuple(s) for s in r["spans"]] for r in out] == [[(5, 0, 20)]] * 3
    assert personal_data(frame(spark, [])).collect() == []


def test_long_texts_take_linear_time():
    start = time.perf_counter()
    for unit in ("1", "a", "1.", "a@", "+1 ", "1 ", "a.b@c.de ", "555-0199 ", "x:1234567 ", "(", "a1=#"):
        scan(unit * (400_000 // len(unit)))
    assert time.perf_counter() - start < 60
