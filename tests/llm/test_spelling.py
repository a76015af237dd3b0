"""Spelling variants against a plain version."""

import random
import re
import zlib
from collections import Counter

import pytest
from helpers import messy, table

from supplyscope.llm import spelling

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def counted(rows, least=6, often=5, lot=None):
    found = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            if lot and doc_id is not None and (h := zlib.crc32(f"{doc_id}:{word}".encode())) % lot == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1 :]
            if len(word) >= least:
                found[word] += 1
    return {w: n for w, n in found.items() if n >= often}


def is_near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain(counts, ratio=5):
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and is_near(w, v)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return {(w, form[w], root(w), n, len(near[w]), counts.get(form[w])) for w, n in counts.items()}


COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def edited(rng, word):
    at, kind = rng.randrange(len(word)), rng.randrange(4)
    letter = rng.choice("abcxyzéß×A")
    return [word[:at] + word[at + 1 :], word[:at] + letter + word[at:], word[:at] + letter + word[at + 1 :], word[::-1]][kind]


def texts(seed=3, n=250):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abcdeéñlo") for _ in range(rng.randrange(7, 11))) for _ in range(25)]
    once = [edited(rng, rng.choice(base)) for _ in range(60)]
    twice = [edited(rng, rng.choice(once)) for _ in range(90)]
    weights = [600] * len(base) + [60] * len(once) + [5] * len(twice)
    base += once + twice
    return [rng.choice(", . \n").join(rng.choices(base, weights, k=rng.randrange(1, 120))) for _ in range(n)]


@pytest.mark.parametrize(("classes", "size"), [(6, 1000), (3, 7)])
def test_equals_a_plain_version(spark, monkeypatch, classes, size):
    monkeypatch.setattr(spelling, "CLASSES", classes)
    monkeypatch.setattr(spelling, "SLICE", size)
    docs = [*texts(), None, "", "  ", "x" * 70_000, ("y" * 80 + "1") * 6, "tail" * 3]
    df = table(spark, docs)
    got = spelling.spelling_variants(df, lot=19)
    assert got.columns == COLUMNS
    want = plain(counted(enumerate(docs), lot=19))
    assert len(want) > 60 and any(r[1] and r[2] != r[1] for r in want)
    assert {tuple(r) for r in got.collect()} == want
    assert got.count() == len(want)


def test_counts_of_runs(spark, rows):
    docs = ["Äpfel ÄPFEL äpfel", "a×b÷c_d", "cafésłow 中文abcdefg中abcdefg", "Étudeabc"]
    got = spelling.word_counts(table(spark, docs), min_length=3, min_count=1)
    assert dict(rows(got)) == counted(enumerate(docs), 3, 1)


def test_nulls_and_repeated_rows(spark, rows):
    df = messy(spark)
    pairs = [(r.doc_id, r.text) for r in df.collect()]
    got = spelling.spelling_variants(df, min_length=1, min_count=2, lot=3)
    assert {tuple(r) for r in got.collect()} == plain(counted(pairs, 1, 2, 3))
    assert rows(spelling.spelling_variants(df.limit(0))) == []


def test_near_words_of_short_and_odd_words(spark):
    words = ["", "a", "b", "ab", "ba", "abc", "\U0001f600b", "\U0001f600", "b\U0001f600"]
    df = spark.createDataFrame([(w, 1) for w in words], "word string, n long")
    got = {(r.word, r.other) for r in spelling.near_words(df).collect()}
    want = {(a, b) for a in words for b in words if a and b and is_near(a, b)}
    assert got == want
