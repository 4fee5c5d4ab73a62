"""Line frequency rules against plain loops, and their corner cases."""

import random
import re
from collections import Counter

from talentlake.llm.line_frequency import line_frequency

SCHEMA = "doc_id bigint, text string, source string, row string, line string, host int, lines int, docs int"
NUMBERS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
WORD = re.compile("[^\x20\x09-\x0d]+")


def normal(line):
    return re.sub("[\x20\x09-\x0d]+", " ", line.lower().translate(str.maketrans("123456789", "0" * 9))).strip(" ")


def plain(rows, max_docs):
    """Per row its numbers, verdict and the words and lines that are boilerplate."""
    lines_of = [[line for line in (text or "").split("\n") if WORD.search(line)] for _, text, _ in rows]
    seen = {(host, doc_id, normal(line)) for (doc_id, _, host), lines in zip(rows, lines_of) for line in lines}
    docs = Counter((host, line) for host, _, line in seen)
    out = []
    for (doc_id, text, host), lines in zip(rows, lines_of):
        words = WORD.findall(text or "")
        windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
        covered = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
        failed = len(words) < 50 or 100 * len(covered) > 50 * len(words)
        gone = [normal(line) for line in lines if docs[host, normal(line)] > max_docs]
        gone_words = sum(len(line.split(" ")) for line in gone)
        left = len(words) - gone_words
        depleted = gone_words > 0 and (left < 50 or left < 0.5 * len(words))
        numbers = [len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(covered)]
        out.append((doc_id, *numbers, failed, not failed and not depleted, gone_words, len(gone)))
    return sorted(out, key=repr)


def found(df, max_docs):
    rows = line_frequency(df, max_docs=max_docs).collect()
    return sorted(
        ((r["doc_id"], *[r[n] for n in NUMBERS], r["base_failed"], r["kept"], r["removed_words"], r["removed_lines"]) for r in rows),
        key=repr,
    )


def frame(spark, rows):
    return spark.createDataFrame([(*r, "r", "l", 1, 2, 3) for r in rows], SCHEMA)


def corpus(seed):
    chosen = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)] + ["é#", "<b>", "日本", " ", "ÀB"]
    boilerplate = ["Share this page 12 times", "  all RIGHTS reserved 2024 ", "a\tb"]
    rows = []
    for i in range(80):
        lines = [" ".join(chosen.choices(vocabulary, k=chosen.randrange(0, 25))) for _ in range(chosen.randrange(1, 9))]
        for line in boilerplate:
            if chosen.random() < 0.4:
                lines.insert(chosen.randrange(len(lines) + 1), line.replace("12", str(chosen.randrange(10, 99))))
        if chosen.random() < 0.2:
            lines += lines[:2]
        rows.append((i, chosen.choice(["\n", "\r\n"]).join(lines), chosen.choice(["a", "a", "b", None])))
    return rows


def test_against_plain_loops(spark):
    rows = corpus(2)
    rows += [(None, "x y z " * 40, "a"), (None, "Share this page 77 times\n" * 30, "a"), (900, None, "a"), (901, "", None)]
    rows += [(902, " \n\t\n", "b"), (903, " ".join(f"v{i}" for i in range(60_000)), "b"), (904, "one two", "b")]
    rows += rows[:5]  # repeated rows count as one document
    for max_docs in (3, 12):
        expected = plain(rows, max_docs)
        assert any(r[8] for r in expected) and any(r[7] for r in expected)
        assert found(frame(spark, rows), max_docs) == expected


def test_a_line_at_the_limit_stays(spark):
    own = lambda i: " ".join("wxyz"[i] + "abcdefghij"[j // 10] + "abcdefghij"[j % 10] for j in range(60))
    rows = [(i, f"same line\n{own(i)}", "a") for i in range(4)]
    assert {r[8] for r in found(frame(spark, rows), 4)} == {0}
    assert {r[8] for r in found(frame(spark, rows), 3)} == {2}


def test_empty_table(spark):
    assert line_frequency(frame(spark, [])).collect() == []
