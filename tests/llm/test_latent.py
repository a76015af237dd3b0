import math
import random

import numpy as np
import pyarrow as pa
from helpers import SCHEMA, messy, sentence, table, words

from supplyscope.llm import latent
from supplyscope.llm.words import PUNCTUATION, text_slices, word_hashes

BENCH = "item_id long, text string, extra string"


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b):
            new.append(row[k] + 1 if x == y else max(new[k], row[k + 1]))
        row = new
    return row[-1]


def fixture(spark):
    """Items in texts: whole, paraphrased, only half, without the answer; in long and short texts, across passages."""
    rng = random.Random(11)
    items = [sentence(rng, rng.randrange(15, 45)).replace("w1", "q1") + ". " + sentence(rng, rng.randrange(6, 12)) + "." for _ in range(30)]
    texts, want = [], set()
    for k in range(240):
        body = sentence(rng, rng.choice([0, 5, 40, 150, 600])).split()
        if k % 4 == 0:
            item = items[k % len(items)].split()
            kind = k // 4 % 4
            if kind == 1:  # one word in ten put otherwise
                item = [w if i % 10 else f"other{i}" for i, w in enumerate(item)]
            elif kind == 2:
                item = item[: len(item) // 2]
            elif kind == 3:
                item = item[len(item) * 2 // 3 :]
            if kind < 2:
                want.add((k, k % len(items)))
            at = rng.randrange(len(body) + 1)
            body = body[:at] + item + body[at:]
        texts.append(" ".join(body))
    return table(spark, texts), spark.createDataFrame([(k, t, "x") for k, t in enumerate(items)], BENCH), want, texts, items


def test_leaks_equal_the_plan(spark):
    docs, bench, want, texts, items = fixture(spark)
    rows = latent.leaks(docs, bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == want
    for r in rows:
        assert r.item_words == len(words(items[r.item_id])) and r.common <= lcs(words(items[r.item_id]), words(texts[r.doc_id]))
        assert r.common >= 0.6 * r.item_words and 0 <= r.first_word < len(words(texts[r.doc_id])) and r.cosine > 0.3
    clean = latent.without_leaks(docs, bench)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == sorted(set(range(240)) - {d for d, _ in want})


def test_blocks_of_items_find_the_same(spark, monkeypatch):
    docs, bench, want, *_ = fixture(spark)
    monkeypatch.setattr(latent, "MOST_ITEMS", 8)
    assert {(r.doc_id, r.item_id) for r in latent.leaks(docs, bench).collect()} == want


def test_sums_do_not_depend_on_partitions(spark):
    docs, bench, *_ = fixture(spark)
    one, many = (next(latent._blocks(d, bench)) for d in (docs.coalesce(1), docs.repartition(7)))
    both = [np.abs(b["projection"] @ b["vectors"].T) for b in (one, many)]
    assert np.allclose(*both, atol=1e-3)


def test_messy_texts_and_items(spark):
    docs = messy(spark)
    bench = spark.createDataFrame([(None, "a b c d e f g h i j k l", None), (2, None, "x"), (3, "", "x"), (4, " \n", "x"), (None, "a b c d e f g h i j k l", None)], BENCH)
    rows = latent.leaks(docs, bench).collect()
    assert [(r.doc_id, r.item_id) for r in rows] == [(5, None)] * 4
    assert sorted(r.doc_id or -1 for r in latent.without_leaks(docs, bench).collect()) == [-1, 1, 2, 3, 4, 7, 7]
    for d, b in ((docs, bench.limit(0)), (spark.createDataFrame([], SCHEMA), bench)):
        assert latent.leaks(d, b).collect() == []
        assert latent.without_leaks(d, b).count() == d.count()


def test_common_subsequence():
    rng = random.Random(2)
    for _ in range(50):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 20))] for _ in range(2))
        masks = {}
        for k, x in enumerate(a):
            masks[x] = masks.get(x, 0) | 1 << k
        assert latent._lcs(masks, b, len(a)) == lcs(a, b)
    assert latent._prepared([1], [" "]) is None and isinstance(pa.array([1]), pa.Array)


def test_items_of_all_lengths_are_found(spark):
    """Copies, word for word and with one word in ten put otherwise, of items of 5 to 1000 words in Zipf text.

    What a plain comparison of every item with every stretch of every text finds is found: all of it for items of more than 12 words,
    and at least nine in ten for shorter ones, most of which are there by chance.
    """
    rng = random.Random(5)
    often = [1 / (k + 1) for k in range(4000)]

    def zipf(n):
        return [f"w{k}" for k in rng.choices(range(4000), often, k=n)]

    lengths = [5, 6, 7, 8, 10, 12, 13, 16, 20, 24, 25, 40, 64, 65, 96, 130, 160, 214, 300, 400, 700, 1000] * 2
    items = [zipf(n) for n in lengths]
    texts, planted = [], set()
    for k in range(2 * len(items)):
        item = list(items[k % len(items)])
        if k >= len(items):
            item = [w if i % 10 != 3 else f"other{i}" for i, w in enumerate(item)]
        body = zipf(rng.choice([0, 50, 600]))
        at = rng.randrange(len(body) + 1)
        texts.append(" ".join(body[:at] + item + body[at:]))
        planted.add((k, k % len(items)))
    bench = spark.createDataFrame([(k, " ".join(t), "x") for k, t in enumerate(items)], BENCH)
    rows = latent.leaks(table(spark, texts), bench).collect()
    got = {(r.doc_id, r.item_id) for r in rows}
    brute = {(d, k) for d, text in enumerate(texts) for k, item in enumerate(items) if plainly_there(text.split(), item)}
    assert planted <= brute
    assert planted <= got, sorted((d, lengths[k]) for d, k in planted - got)
    for low, high, least in ((5, 8, 0.9), (9, 12, 0.9), (13, 1000, 1.0)):
        there = {(d, k) for d, k in brute if low <= lengths[k] <= high}
        assert len(there & got) >= least * len(there) > 0, (low, len(there), len(there & got))
    # Nothing is found that is not there.
    assert got <= brute


def plainly_there(text, item):
    """Whether a stretch of one and a half times the item's length has its share of the item's words, in order. All of it is the answer here."""
    m, least = len(item), (0.8 if len(item) < 13 else 0.6) * len(item)
    span, masks = math.ceil(1.5 * m), {}
    for k, word in enumerate(item):
        masks[word] = masks.get(word, 0) | 1 << k
    known = [w in masks for w in text]
    if sum(known) < least:
        return False
    count = sum(known[:span])
    for at in range(0, max(1, len(text) - span + 1)):
        # Long items are tried at every tenth place: one word more or less in a hundred does not matter there.
        if count >= least and (m < 100 or at % 10 == 0) and latent._lcs(masks, text[at : at + span], m) >= least:
            return True
        if at + span < len(text):
            count += known[at + span] - known[at]
    return False


def test_short_and_altered_answers(spark):
    """One changed last word or full stop does not hide a copy; without its longer answer, half an item is none."""
    rng = random.Random(21)
    item = sentence(rng, 25) + " is it? N."
    other = sentence(rng, 20) + " 3.14 units. " + sentence(rng, 8) + "."
    assert latent._prepared([0, 1], [item, other])["answer"] == [28, 8]
    body = sentence(rng, 60)
    texts = [f"{body} {item[:-2]}{end} {body}" for end in ("N.", "N", "(N),", "K.", "")]
    texts += [f"{body} {other[:-1]}", f"{body} {' '.join(other.split()[:22])} {body}"]
    bench = spark.createDataFrame([(0, item, "x"), (1, other, "x")], BENCH)
    rows = latent.leaks(table(spark, texts), bench).collect()
    assert {(r.doc_id, r.item_id) for r in rows} == {(0, 0), (1, 0), (2, 0), (3, 0), (4, 0), (5, 1)}
    assert {r.doc_id: r.common for r in rows if r.item_id == 0} == {0: 28, 1: 28, 2: 28, 3: 27, 4: 27}


def test_edges_of_words():
    texts = ["(Ab), ... c.d! -5", "", "'x'", "..."]
    _, _, data, offsets = next(text_slices(pa.array(texts)))
    _, start, end, first = word_hashes(data, offsets, edges=PUNCTUATION)
    assert [data[a:b].tobytes().decode() for a, b in zip(start, end, strict=True)] == ["Ab", "...", "c.d", "-5", "x", "..."]
    assert first.tolist() == [0, 4, 4, 5, 6]


def test_row_sums():
    rng = np.random.default_rng(3)
    rows, group = rng.normal(size=(20, 5)), np.sort(rng.integers(0, 9, 40))
    pick = rng.integers(0, 20, 40)
    want = np.zeros((10, 5))
    np.add.at(want, group, rows[pick])
    assert np.allclose(latent._row_sums(rows, pick, group, 10), want)
    assert not latent._row_sums(rows, pick[:0], group[:0], 3).any()


def test_axes_equal_a_whole_decomposition(spark, monkeypatch):
    docs, bench, *_ = fixture(spark)
    items = latent._prepared([r.item_id for r in bench.collect()], [r.text for r in bench.collect()])
    monkeypatch.setattr(latent, "_STRIP", 100)
    n, rng = len(items["vocabulary"]), np.random.default_rng(1)
    corpus, idf = rng.normal(size=(4, n)), rng.uniform(0.1, 5, n)
    axes, s = latent._axes(corpus, idf, items)
    own = np.zeros((len(items["item"]), n))
    np.add.at(own, (items["query"], items["term"]), 1)
    own *= idf
    own *= np.sqrt((corpus**2).sum() / (own**2).sum())
    _, values, v = np.linalg.svd(np.vstack([corpus, own]), full_matrices=False)
    assert np.allclose(values[: len(s)], s) and np.allclose(np.abs((v[: len(s)] * axes.T).sum(1)), 1)


def test_an_item_of_very_many_words(spark, monkeypatch):
    """One item has more queries than a block: some fit the axes, all are searched."""
    monkeypatch.setattr(latent, "MOST_ITEMS", 20)
    rng = random.Random(3)
    item = sentence(rng, 3000, 9000)
    texts = [item, f"{sentence(rng, 200, 9000)} {item} {sentence(rng, 90, 9000)}", item[: len(item) // 3], sentence(rng, 3000, 9000)]
    rows = latent.leaks(table(spark, texts), spark.createDataFrame([(7, item, "x"), (8, " ".join(texts[3].split()[:16]), "x")], BENCH)).collect()
    assert sorted((r.doc_id, r.item_id) for r in rows) == [(0, 7), (1, 7), (3, 8)]
