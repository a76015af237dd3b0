from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from helpers import LONG, SCHEMA, messy, near_copies, table, words

from supplyscope.llm import ngram_join
from supplyscope.llm.graph import components
from supplyscope.llm.words import text_slices, word_hashes


def brute(ids, texts):
    sets = {}
    for k, text in zip(ids, texts, strict=True):
        w = words(text)
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
    root = {k: k for k in sets}

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    keys = sorted(sets)
    for i, a in enumerate(keys):
        for b in keys[i + 1 :]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 75 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: (len(sets[k]), find(k)) for k in keys}


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_brute_force(spark, seed):
    texts = near_copies(seed)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(table(spark, texts)).collect()}
    want = brute(range(len(texts)), texts)
    assert got == want
    assert max(Counter(c for _, c in want.values()).values()) > 5


def test_many_slices_and_parts_find_the_same(spark, monkeypatch):
    texts = near_copies(3)
    monkeypatch.setattr(ngram_join, "_MEMBER_LOAD", 200)
    monkeypatch.setattr(ngram_join, "_QUERY_LOAD", 200)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.near_duplicates(table(spark, texts)).collect()}
    assert got == brute(range(len(texts)), texts)


def test_messy_rows(spark):
    got = Counter(tuple(r) for r in ngram_join.near_duplicates(messy(spark)).collect())
    assert got == Counter(
        [(None, 0, None), (1, 0, 1), (2, 0, 2), (3, 1, 3), (4, len(LONG.split()) - 4, 4), (5, 8, 5), (5, 8, 5), (7, 1, 7), (7, 1, 7)]
    )


def test_null_ids_join_their_text(spark):
    docs = table(spark, ["a b c d e f"] * 3 + ["only here"], doc_id=[None, 9, 4, None])
    assert Counter(tuple(r) for r in ngram_join.near_duplicates(docs).collect()) == Counter([(None, 2, 4), (9, 2, 4), (4, 2, 4), (None, 1, None)])


def test_empty_table(spark):
    assert ngram_join.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []
    assert ngram_join.one_of_each(spark.createDataFrame([], SCHEMA)).collect() == []


def test_one_of_each_keeps_rows_and_columns(spark):
    texts = near_copies(1)
    docs = table(spark, texts)
    kept = ngram_join.one_of_each(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, (_, c) in brute(range(len(texts)), texts).items() if k == c)


def test_one_of_each_with_null_and_reused_ids(spark):
    docs = table(spark, ["a b c d e f", "a b c d e f", "", "x y", "x y", "p q"], doc_id=[1, None, None, 3, 3, None])
    got = Counter((r.doc_id, r.text) for r in ngram_join.one_of_each(docs).collect())
    assert got == Counter([(1, "a b c d e f"), (None, ""), (3, "x y"), (None, "p q")])


def test_components_of_a_chain_and_a_star(spark):
    links = [(k, k + 1) for k in range(30)] + [(100, k) for k in range(101, 140)] + [(7, 7), (None, 1)]
    got = {r.vertex: r.root for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == {k: 0 for k in range(31)} | {k: 100 for k in range(100, 140)}


def test_word_hashes_follow_the_words():
    texts = ["Ab c\tab", None, "", " ", "ab", "É é x AB", "c"]
    seen: dict[str, int] = {}
    found = []
    for _, _, data, offsets in text_slices(pa.array(texts), 8):
        hashes, start, end, first = word_hashes(data, offsets)
        for a, b in zip(first, first[1:], strict=False):
            found.append([(data[s:e].tobytes().decode().translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), h) for s, e, h in zip(start[a:b], end[a:b], hashes[a:b], strict=True)])
    assert [[w for w, _ in row] for row in found] == [words(t) for t in texts]
    for w, h in (x for row in found for x in row):
        assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)
    assert isinstance(h, np.uint64)


def test_texts_without_ids_link_and_bridge(spark):
    """A text without id that is near two others makes them one component; near copies without any id are one, too."""
    w = [f"b{k}" for k in range(60)]
    far = [f"c{k}" for k in range(60)]
    x, y = (" ".join(f"{c}{k}" for k in range(5)) for c in "xy")
    texts = [" ".join(w), " ".join([x, *w[5:]]), " ".join([x, *w[5:-5], y])]
    want = brute(range(3), texts)
    assert {c for _, c in want.values()} == {0} and len({c for _, c in brute([0, 2], texts[::2]).values()}) == 2
    texts += [" ".join(far), " ".join([*far[:-1], "z"]), "an other text of its own"]
    docs = table(spark, texts, doc_id=[7, None, 4, None, None, None])
    got = Counter(tuple(r) for r in ngram_join.near_duplicates(docs).collect())
    assert got == Counter([(7, 56, 4), (None, 56, 4), (4, 56, 4), (None, 56, None), (None, 56, None), (None, 2, None)])
    kept = ngram_join.one_of_each(docs).collect()
    assert sorted((r.doc_id or 0 for r in kept)) == [0, 0, 4] and sum(r.text.startswith("c0") for r in kept) == 1
