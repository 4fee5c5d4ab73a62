"""Secret scans against plain loops."""

import hashlib
import random
import re
import time

from talentlake.llm.queries import QUERIES
from talentlake.llm.secrets import KINDS, candidates, cover, redact, secrets

DATA = "/root/testdata/sf0.01"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, found string, spans int, key int"
HEX = "0123456789abcdef" * 3
RANDOM = "aB3dE5gH7jK9mN1pQ4sT6vX8"


def base(text):
    """(start, kind order, kind, end) of the base spans."""
    found = []
    keyword = re.compile(
        "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
        "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
        "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    )
    for m in keyword.finditer(text):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, "assign", m.end()))
    for order, kind, pattern, least in ((1, "access", "AKIA[A-Z0-9]+", 20), (2, "hex", "[0-9a-f]+", 24)):
        for m in re.finditer(pattern, text):
            if len(m[0]) >= least:
                found.append((m.start(), order, kind, m.end()))
    return sorted(found)


def digest(found):
    return hashlib.sha256(",".join(f"{kind}:{s}:{e}" for s, _, kind, e in found).encode()).hexdigest()


def test_query_against_plain_patterns(spark):
    rows = QUERIES["op10_ownership_frequency"](spark, DATA).collect()
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    for r in rows:
        found = base(texts[r["doc_id"]])
        assert r["base_sha256"] == digest(found)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == tuple(
            sum(kind == k for _, _, kind, _ in found) for k in ("assign", "access", "hex")
        )
        assert {f"{kind}:{s}:{e}" for s, _, kind, e in found} <= set(r["spans"].split(","))


def row(i, text, source="a"):
    return (i, text, "en", source, 0, "f", 1, 2)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_ownership_separates_examples_from_live_ones(spark):
    rows = [row(i, f"see {RANDOM} and token={HEX}", f"s{i}") for i in range(3)]
    rows += [row(10, f"é {RANDOM.swapcase()} end", "s1"), row(11, None), row(12, ""), row(None, f"key {HEX[1:]}", None)]
    rows += [row(13, "😀 password = 'hunter22'")] * 2
    out = {r["doc_id"]: [(s["kind"], s["start"], s["live"]) for s in r["spans"]] for r in secrets(frame(spark, rows)).collect()}
    assert out[0] == [("assign", 33, False), ("hex", 39, False)]
    assert out[10] == [("token", 2, True)]
    assert out[11] == out[12] == []
    assert out[None] == [("hex", 4, True)]
    assert out[13] == [("assign", 2, True)]
    assert len(secrets(frame(spark, rows)).collect()) == len(rows)


def test_redaction_keeps_rows_and_columns(spark):
    rows = [row(1, f"é a token={HEX} b {HEX[2:]}"), row(2, "clean"), row(3, None), row(4, f"x{HEX}")]
    docs = frame(spark, rows)
    out = redact(docs)
    assert out.columns == docs.columns
    assert {r["doc_id"]: r["text"] for r in out.collect()} == {1: "é a [secret] b [secret]", 2: "clean", 3: None, 4: "x[secret]"}
    assert redact(docs.limit(0)).collect() == []


def test_long_text_and_leftmost_rule(spark):
    text = "secret: token:abcdefgh " + "w " * 100_000 + f"AKIA{'Z' * 16} AKIA{'Z' * 15}"
    (r,) = secrets(frame(spark, [row(1, text)])).collect()
    assert [(s["kind"], s["start"], s["end"]) for s in r["spans"]] == [(k, s, e) for s, _, k, e in base(text)]


def test_ownership_against_plain_counting(spark):
    chosen = random.Random(6)
    values = ["".join(chosen.choices("abcdefghijkmnpqrstuvwxyzABCDEFGHJKLMNP23456789", k=28)) for _ in range(25)]
    rows = []
    for i in range(160):
        parts = [chosen.choice(["see {}", "token={}", "password: '{}'", "{}"]).format(chosen.choice(values[: chosen.choice([2, 25])])) for _ in range(3)]
        rows.append((chosen.choice([i, i // 2, None]), " - ".join(parts), chosen.choice(["a", "b", "c", None])))
    owners, repositories = {}, {}
    for doc_id, text, source in rows:
        for _, _, _, value in candidates(text):
            owners.setdefault(value, set()).add(source)
            repositories.setdefault(value, set()).add((source, doc_id))
    live = lambda value: len(owners[value]) <= 2 and len(repositories[value]) <= 9
    expected = sorted(
        (
            str(doc_id),
            [(KINDS[kind], s, e, live(v), len(owners[v]), len(repositories[v])) for kind, s, e, v in candidates(text) if kind < 3 or live(v)],
        )
        for doc_id, text, _ in rows
    )
    docs = frame(spark, [row(doc_id, text, source) for doc_id, text, source in rows])
    found = sorted((str(r["doc_id"]), [tuple(s) for s in r["spans"]]) for r in secrets(docs).collect())
    assert found == expected
    assert {x[3] for _, spans in expected for x in spans} == {True, False}


def test_cover():
    assert cover("abcdef", [(1, 3), (2, 4), (5, 6)]) == "a[secret]e[secret]"
    assert cover("abc", []) == "abc"


def test_long_texts_take_linear_time():
    text = " ".join(f"token={i:08d}{RANDOM} {RANDOM}{i:06d}" for i in range(40_000))
    assert len(text) > 2_500_000
    start = time.perf_counter()
    found = candidates(text)
    assert len(found) > 60_000
    assert len(cover(text, [(s, e) for _, s, e, _ in found])) < len(text)
    assert time.perf_counter() - start < 30
