import random

import numpy as np
from helpers import LONG, SCHEMA, messy, sentence, table, words

from supplyscope.llm import line_dedup as ld


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    p = 0
    while p < min(len(a), len(b)) and a[p] == b[p]:
        p += 1
    return a[p + 1 :] == b[p + 1 :] if len(a) == len(b) else (a[p + 1 :] == b[p:] if len(a) > len(b) else a[p:] == b[p + 1 :])


def brute(texts):
    want, seen, earlier = {}, {}, []
    for d, text in enumerate(texts):
        for k, line in enumerate(text.split("\n") if text is not None else []):
            w = words(line)
            if not w:
                want[d, k] = None
            elif tuple(w) in seen:
                want[d, k] = ("exact", *seen[tuple(w)])
            else:
                seen[tuple(w)] = (d, k)
                near = [(x, y) for x, y, v in earlier if len(w) >= ld.MIN_WORDS <= len(v) and one_edit(w, v)]
                want[d, k] = ("near", *min(near)) if near else None
                earlier.append((d, k, w))
    return want


def lines(seed, n=60):
    rng, pool, out = random.Random(seed), [sentence(random.Random(k), 4 + k % 9, 30) for k in range(12)], []
    for _ in range(n):
        rows = []
        for _ in range(rng.randrange(1, 6)):
            w = rng.choice(pool).split()
            kind = rng.randrange(5)
            if kind == 1:
                w[rng.randrange(len(w))] = f"n{rng.randrange(3)}"
            elif kind == 2:
                del w[rng.randrange(len(w))]
            elif kind == 3:
                w.insert(rng.randrange(len(w) + 1), f"n{rng.randrange(3)}")
            rows.append(" ".join(w).upper() if rng.random() < 0.1 else " ".join(w))
        out.append("\n".join([*rows, ""] if rng.random() < 0.2 else rows))
    return out


def test_decisions_equal_brute_force(spark):
    for seed in (1, 2):
        texts = lines(seed)
        rows = ld.line_decisions(table(spark, texts)).collect()
        got = {(r.doc_id, r.line): (r.reason, r.first_doc, r.first_line) if r.reason else None for r in rows}
        assert got == brute(texts) and len(rows) == len(got)


def test_texts_without_the_dropped_lines(spark):
    texts = lines(3)
    docs = table(spark, texts)
    want = brute(texts)
    cleaned = ld.without_repeated_lines(docs)
    assert cleaned.columns == docs.columns
    for r in cleaned.collect():
        assert r.text == "\n".join(x for k, x in enumerate(texts[r.doc_id].split("\n")) if want[r.doc_id, k] is None)
    for r in ld.summary(docs).collect():
        gone = sorted(k for (d, k), w in want.items() if d == r.doc_id and w)
        assert (r.n_lines, r.n_exact + r.n_near, r.dropped) == (len(texts[r.doc_id].split("\n")), len(gone), gone)


def test_messy_rows(spark):
    rows = ld.line_decisions(messy(spark)).collect()
    got = {(r.doc_id, r.n, r.line): r.reason for r in rows}
    assert len(rows) == 12 and got[4, len(LONG.split()), 0] is None and got[5, 12, 0] is None
    # Of the texts with id 7 the one of lower hash has the earlier lines; "x" is there twice.
    assert sorted(r.reason or "" for r in rows if r.doc_id == 7) == ["", "", "", "", "exact"]
    texts = {(r.doc_id, r.text) for r in ld.without_repeated_lines(messy(spark)).collect()}
    assert {(None, None), (1, ""), (2, " \n\t "), (5, "a b c d e f g h i j k l")} <= texts
    assert ld.without_repeated_lines(messy(spark)).count() == 9


def test_null_ids_come_last(spark):
    docs = table(spark, ["a b c d e", "a b c d e", "a b c d x"], doc_id=[None, 8, None])
    got = {(r.doc_id, r.reason) for r in ld.line_decisions(docs).collect()}
    assert got == {(8, None), (None, "exact"), (None, "near")}


def test_empty_table(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert ld.line_decisions(empty).collect() == [] == ld.without_repeated_lines(empty).collect()


def test_one_edit():
    rng = random.Random(1)
    for _ in range(400):
        a, b = ([rng.randrange(3) for _ in range(rng.randrange(1, 7))] for _ in range(2))
        assert ld.within_one_edit(np.array(a), np.array(b)) == one_edit(a, b)
