"""Collocations and their tries against plain counting."""

import random
import re
from collections import Counter

import numpy as np

from talentlake.llm.collocations import Trie, collocations

SCHEMA = "doc_id bigint, text string, lang string, words string, codes int, id int, phrase string, n int, rank int"


def plain(rows, min_count, max_words=4, top=2000):
    """What the ranking is, by counting every phrase."""
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", lowered):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + size])] += 1
    out = []
    for lang, found in counts.items():
        kept = {p: a for p, a in found.items() if a >= min_count and len(p) > 1}
        ranked = []
        for p, a in kept.items():
            if any(
                100 * b >= 80 * a and len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1))
                for q, b in kept.items()
            ):
                continue
            cuts = [(2_000_000 * a // (found[p[:k]] + found[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            ranked.append((-score, -a, " ".join(p).encode(), a, found[p[:k]], found[p[k:]], score))
        for rank, (_, _, phrase, a, l, r, score) in enumerate(sorted(ranked)[:top], 1):
            out.append((lang, rank, phrase.decode(), a, l, r, totals[lang], score))
    return sorted(out)


def rows_of(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


def frame(spark, rows):
    full = [(i % 3 or None, text, lang, "w", 1, 2, "p", 3, 4) for i, (text, lang) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA)


def texts(seed, n=60):
    chosen = random.Random(seed)
    vocabulary = ["the", "The", "of", "old", "house", "é b", "ÀB", "x\x1f", "日本", "a-b", "1"]
    out = []
    for _ in range(n):
        parts = []
        for _ in range(chosen.randrange(0, 40)):
            parts.append(chosen.choices(vocabulary, weights=range(len(vocabulary), 0, -1))[0])
            parts.append(chosen.choice([" ", " ", " ", " ", "\t", "  ", ", ", ".", "\n", "\r\n"]))
        out.append(("".join(parts), chosen.choice(["en", "en", "de", None, "und"])))
    return out


def test_against_plain_counting(spark):
    rows = texts(1) + [(None, "en"), ("", None), (" \t", "de"), ("the of " * 3000, "en")] + texts(2)[:5] * 2
    expected = plain(rows, 4)
    assert len(expected) > 50
    df = frame(spark, rows)
    assert rows_of(collocations(df, min_count=4)) == expected
    # Several tries, blocks and partitions give the same.
    assert rows_of(collocations(df.repartition(7), min_count=4, per_trie=40, block_bytes=500)) == expected


def test_ranking_is_cut_and_ties_go_by_phrase(spark):
    rows = [("b c. a b. a c", "en")] * 5 + [("é z", "en")] * 5
    expected = plain(rows, 5, top=2)
    assert rows_of(collocations(frame(spark, rows), min_count=5, top=2)) == expected


def test_empty_table(spark):
    assert collocations(frame(spark, [])).collect() == []
    assert collocations(frame(spark, [(None, None), ("", "en")])).collect() == []


def test_trie_finds_all_phrases_and_no_others():
    chosen = np.random.default_rng(3)
    for n_words, n_phrases in ((3, 20), (300, 2000), (70_000, 5000)):
        phrases = sorted({tuple(chosen.integers(0, n_words, chosen.integers(2, 5)).tolist()) for _ in range(n_phrases)})
        # One word with many successors.
        phrases = sorted({*phrases, *((1 % n_words, w) for w in range(min(n_words, 3000)))})
        trie = Trie(phrases, n_words)
        number = {p: i for i, p in enumerate(phrases)}
        text = np.concatenate([np.array(p) for p in phrases] + [chosen.integers(-1, n_words, 2000)]).astype(np.int32)
        expected = Counter()
        for size in (2, 3, 4):
            for i in range(len(text) - size + 1):
                p = tuple(text[i : i + size].tolist())
                if p in number:
                    expected[number[p]] += 1
        assert Counter(np.concatenate(list(trie.hits(text, 4))).tolist()) == expected


def test_trie_without_phrases():
    assert [len(h) for h in Trie([], 0).hits(np.array([0, 1], dtype=np.int32), 4)] == [0, 0, 0]
