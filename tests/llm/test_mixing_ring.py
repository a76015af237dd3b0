from collections import Counter, defaultdict

import pytest
from helpers import LONG, MESSY, SCHEMA, messy, table, words

from supplyscope.llm import mixing, ring
from supplyscope.llm.order import copies, numbered


def filled(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    """Targets by handing out the budget and taking back what is above, again and again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    budget, full, out = share * sum(sizes.values()), set(), {}
    while True:
        left = [s for s in order if s not in full]
        rest = budget - sum(most * sizes[s] for s in full)
        out = {s: most * sizes[s] for s in full} | {s: rest * weight[s] / sum(weight[x] for x in left) for s in left}
        above = {s for s in left if out[s] > most * sizes[s]}
        if not above:
            return out
        full |= above


def test_targets_and_words_taken(spark):
    texts = [" ".join(["w"] * (1 + (37 * k) % 90)) for k in range(300)]
    sources = [None if k % 10 == 0 else f"s{k % 7 if k % 3 else 0}" for k in range(300)]
    docs = table(spark, texts, source=sources)
    got = mixing.manifest(docs).collect()
    sizes = defaultdict(int)
    for text, source in zip(texts, sources, strict=True):
        sizes[source] += len(words(text))
    want, taken = filled(sizes), defaultdict(int)
    for r in got:
        assert r.size == len(words(texts[r.doc_id])) and r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        assert 0 <= r.taken <= 2 * r.size and r.taken == r.copies * r.size
        taken[r.source] += r.taken
    assert len(got) == 300
    assert all(abs(taken[s] - want[s]) <= 45 for s in sizes)
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.manifest(docs.repartition(5)).collect()), key=str)


def test_one_point_for_many_rows(spark):
    docs = table(spark, ["a b c"] * 40 + ["q r s t"] * 4, doc_id=[1] * 40 + [2] * 4, source=["a"] * 40 + ["b"] * 4)
    got = mixing.manifest(docs).collect()
    taken = Counter()
    for r in got:
        taken[r.source] += r.taken
    aims = {r.source: r.target for r in got}
    assert len(got) == 44 and all(abs(taken[s] - aims[s]) <= 2 for s in aims)
    assert mixing.mixed(docs).count() == sum(r.copies for r in got)


def test_messy_rows_of_the_mix(spark):
    got = mixing.manifest(messy(spark)).collect()
    assert Counter(r.size for r in got) == Counter(len(words(t)) for t in MESSY)
    assert all(r.taken == 0 for r in got if r.size == 0)
    mixed = mixing.mixed(messy(spark))
    assert mixed.columns == messy(spark).columns
    assert sum(len(words(r.text)) for r in mixed.collect()) == sum(r.taken for r in got)


def test_mix_and_shards_of_nothing(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.manifest(empty).collect() == [] == mixing.mixed(empty).collect()
    assert ring.manifest(empty).collect() == []
    blank = table(spark, [None, ""])
    assert [r.taken for r in mixing.manifest(blank).collect()] == [0, 0]


def check_shards(rows, count, shards):
    assert len(rows) == count
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert max(sizes) - min(sizes) <= 1
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())


def test_shards_are_level_and_move_little(spark):
    docs = table(spark, [f"t{k}" for k in range(500)])
    old = {r.doc_id: r.shard for r in ring.manifest(docs).collect()}
    check_shards(ring.manifest(docs).collect(), 500, 24)
    new = {r.doc_id: r.shard for r in ring.manifest(docs.repartition(3), 25).collect()}
    assert sum(old[k] == new[k] for k in old) > 350
    assert old == {r.doc_id: r.shard for r in ring.manifest(docs.repartition(4)).collect()}


def test_shards_follow_the_walk(spark):
    """Against one walk, row by row: each row goes to the first node at or after it whose shard has room."""
    docs = table(spark, [f"t{k}" for k in range(60)])
    got = Counter(r.shard for r in ring.assign(docs, 4, 3).collect())
    assert got == Counter({0: 15, 1: 15, 2: 15, 3: 15})
    pieces = ring.fill([5, 0, 9, 1], [0, 1, 2, 0], [4, 6, 5])
    assert pieces == [(0, 0, 4, 0, 0), (2, 0, 5, 2, 0), (0, 4, 5, 1, 0), (3, 0, 1, 1, 1), (2, 5, 9, 1, 2)]


def test_messy_rows_of_the_shards(spark):
    rows = ring.manifest(messy(spark)).collect()
    check_shards(rows, 9, 24)
    assert Counter(r.size for r in rows) == Counter(len((t or "").encode()) + 8 for t in MESSY)
    assert {r.text_crc32 is None for r in rows if r.size == 8} == {True, False}
    assert all(r.law == "rows" and r.grown_shard is None for r in rows)
    check_shards(ring.manifest(table(spark, ["same"] * 100, doc_id=[None] * 50 + [3] * 50)).collect(), 100, 24)


def test_numbers_and_copies(spark):
    rows = spark.createDataFrame([(k % 7, k) for k in range(100)], "a int, b int")
    got = numbered(rows, [rows.a, rows.b], "at").collect()
    assert [(r.a, r.b) for r in sorted(got, key=lambda r: r["at"])] == sorted((k % 7, k) for k in range(100))
    assert sorted(r["at"] for r in got) == list(range(100))
    many = copies(spark.createDataFrame([(1, 5), (2, 0), (3, 1)], "a int, m long"), "m", "k", ["a"], piece=2)
    assert sorted(map(tuple, many.collect())) == [(1, k) for k in range(5)] + [(3, 0)]
    assert len(LONG) > 100_000


def test_every_shard_has_a_node(monkeypatch):
    for shards, per_shard in ((24, 64), (2000, 64), (16_384, 2)):
        found = ring.nodes(shards, per_shard)
        assert {s for _, s in found} == set(range(shards)) and len({p for p, _ in found}) == len(found)
    counts = [3] * len(found)
    pieces = ring.fill(counts, [s for _, s in found], [3] * 16_384)
    assert sum(hi - lo for _, lo, hi, _, _ in pieces) == sum(counts)
    with pytest.raises(ValueError, match="places"):
        ring.nodes(16_385, 1)


def test_many_shards(spark):
    rows = ring.manifest(table(spark, [f"text {k}" for k in range(3000)]), 2000).collect()
    check_shards(rows, 3000, 2000)
