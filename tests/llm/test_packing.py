"""Packing against the tokenizer itself and a plain best fit."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from helpers import messy, table
from tokenizers import Tokenizer

from supplyscope.llm import packing
from supplyscope.llm.packing import Capacity, plan

PATH = public_tokenizers.path("word_bpe_49k.json")


def encoded(text):
    return [*Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids, 1]


def spread(places):
    """The pieces in each sequence as (offset, length), and the numbers that each length gives."""
    bins, numbers = defaultdict(list), defaultdict(list)
    for p in places:
        for k in range(p.n):
            bins[p.sequence + k // p.per].append((p.at + k % p.per * p.length, p.length))
            numbers[p.length].append(p.first + k)
    return bins, numbers


def check_plan(counts, capacity):
    places = plan(counts, capacity)
    bins, numbers = spread(places)
    assert {x: sorted(n) for x, n in numbers.items()} == {x: list(range(n)) for x, n in counts.items() if n}
    assert sorted(bins) == list(range(len(bins)))
    tokens, documents, attention = capacity.most()
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= tokens and len(content) <= documents and sum(x * x for _, x in content) <= attention
    return len(bins)


def plain_best_fit(counts, tokens):
    free = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fits = [(f, k) for k, f in enumerate(free) if f >= length]
            if fits:
                free[min(fits)[1]] -= length
            else:
                free.append(tokens - length)
    return len(free)


@pytest.mark.parametrize("seed", range(12))
def test_plan_opens_as_many_as_plain_best_fit(seed):
    rng = random.Random(seed)
    tokens = rng.choice((10, 64, 100))
    counts = {rng.randrange(1, tokens + 1): rng.choice((1, 2, 7, 40)) for _ in range(rng.randrange(1, 25))}
    assert check_plan(counts, Capacity(tokens)) == plain_best_fit(counts, tokens)


@pytest.mark.parametrize("seed", range(12))
def test_plan_holds_every_constraint(seed):
    rng = random.Random(seed)
    rule = ("norm", "dot")[seed % 2]
    capacity = Capacity(100, rng.choice((3, 8, 100)), rng.choice((10_000, 2_500)), (1.0, rng.random(), rng.random()), rule)
    counts = {rng.randrange(1, 51): rng.choice((0, 1, 2, 7, 40)) for _ in range(rng.randrange(1, 25))}
    used = check_plan(counts, capacity)
    demands = [(x * n, n, x * x * n) for x, n in counts.items()]
    least = max(-(-sum(d[k] for d in demands) // int(capacity.most()[k])) for k in range(3))
    assert least <= used <= 2 * least + 1


def test_vector_rules_differ_and_bounds_bind():
    counts = {60: 4, 30: 8, 10: 12}
    assert check_plan(counts, Capacity(100, documents=1)) == 24
    assert check_plan(counts, Capacity(100, attention=3600)) > check_plan(counts, Capacity(100))
    with pytest.raises(ValueError, match="101 tokens"):
        plan({101: 1}, Capacity(100))


def test_the_plan_does_not_grow_with_the_counts():
    rng = random.Random(1)
    few = {x: rng.randrange(1, 50) for x in range(1, 4097)}
    many = {x: n * 10**9 + rng.randrange(1000) for x, n in few.items()}
    places = plan(many, Capacity())
    assert len(places) < 6 * 4096
    total = sum(x * n for x, n in many.items())
    assert max(p.sequence + -(-p.n // p.per) for p in places) <= total / 4096 * 1.005


def test_ids_are_the_tokenizers(spark):
    rng = random.Random(5)
    odd = ["Word", "it's", "WE'LL", "'S", "-'s", "''t", "i''M", "Æß÷", "ſ", "K", "<|endoftext|>", "a<|startoftext|>b", "é", "́x", "İΣΣ", " ", "　y", "\x1c", "\x85", "日本", "ß.", "12a", "--", "\x0b", "\r\n", "\t", " ", "  ", "🙂"]
    texts = ["".join(rng.choices(odd, k=rng.randrange(1, 20))) for _ in range(200)] + ["Two words, and more.\nNext"]
    texts += [" ".join(rng.choices(odd, k=30)) for _ in range(50)]
    found = packing.pieces(table(spark, texts), PATH).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in found} == {k: encoded(t) for k, t in enumerate(texts)}


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 20)
    monkeypatch.setattr(packing, "_TOGETHER", 3)
    rng = random.Random(8)
    texts = [" ".join(rng.choices(["One", "two,", "it's", "ÉTÉ", "x9y", "(a)b", "日", "<|endoftext|>"], k=rng.randrange(0, 15))) for _ in range(60)]
    known = packing.Remembered(PATH)
    for at in range(0, 60, 7):
        ids, bound = known.ids(texts[at : at + 7])
        assert [ids[i:j].tolist() for i, j in zip(bound[:-1], bound[1:], strict=True)] == [encoded(t)[:-1] for t in texts[at : at + 7]]


def check_packed(rows, docs, limit):
    own = defaultdict(list)
    for doc_id, text in docs:
        ids = encoded(text)
        for piece, at in enumerate(range(0, len(ids), limit)):
            part = ids[at : at + limit]
            own[doc_id].append((piece, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())))
    got = defaultdict(list)
    bins = defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    assert {k: Counter(v) for k, v in got.items()} == {k: Counter(v) for k, v in own.items()}
    for content in bins.values():
        at = 0
        for offset, length in sorted(content):
            assert offset == at
            at += length
        assert at <= limit
    lengths = Counter(r.length for r in rows)
    assert len(bins) == plain_best_fit(lengths, limit)


def test_packs_whole_documents(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choices(["one", "two", "Three,", "fourteen"], k=rng.choice((1, 3, 30, 130)))) for _ in range(200)]
    texts += ["same text"] * 60 + ["x " * 1000, ""]
    df = table(spark, texts).repartition(5)
    rows = packing.best_fit(df, PATH, Capacity(64)).collect()
    check_packed(rows, list(enumerate(texts)), 64)


def test_nulls_and_repeated_rows(spark, rows):
    df = messy(spark)
    check_packed(packing.best_fit(df, PATH).collect(), [(r.doc_id, r.text) for r in df.collect()], 4096)
    assert rows(packing.best_fit(df.limit(0), PATH)) == []


def test_sequences_hold_the_pieces_ids(spark):
    texts = ["one two three", "four", "five six", "", "seven " * 20]
    found = packing.packed(packing.pieces(table(spark, texts), PATH, 16), Capacity(16))
    whole = {r.sequence_id: np.frombuffer(r.ids, "<u4").tolist() for r in packing.sequences(found).collect()}
    for r in found.collect():
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == encoded(texts[r.doc_id])[r.start : r.start + r.length]
    assert sum(map(len, whole.values())) == sum(len(encoded(t)) for t in texts)
