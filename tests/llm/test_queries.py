"""The registered queries over the small test tables, and the pipeline against a plain version."""

import hashlib
import math
from collections import Counter, defaultdict

import duckdb
import pytest
from helpers import words
from test_mixing_ring import check_shards, filled
from test_ngram_join import brute
from test_quality import plain

import corpus_pipeline
from supplyscope.llm import decision_list as dl
from supplyscope.llm import queries
from supplyscope.sources import materialise

SMALL = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SMALL}/documents.parquet'")
    found = con.execute(queries.oracle_sql()[name])
    columns = [c[0] for c in found.description]
    want = Counter(found.fetchall())
    df = queries.queries()[name](spark, SMALL)
    assert Counter(tuple(r[c] for c in columns) for r in df.collect()) == want


def test_every_operator_has_a_query():
    names = list(queries.queries())
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


def leaking(text, items):
    """Items of which a span of one and a half times their length has 60 % of the words, and half of the answer, in order."""
    w = words(text)
    return any(common_enough(w, item) for item in items if set(item) & set(w))


def common_enough(w, item):
    m, span = len(item), math.ceil(1.5 * len(item))
    for at in range(0, max(1, len(w) - span + 1)):
        part = w[at : at + span]
        if len(set(item) & set(part)) >= 0.5 * len(set(item)) and lcs(item, part) >= 0.6 * m:
            return True
    return False


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for k, y in enumerate(b):
            new.append(row[k] + 1 if x == y else max(new[k], row[k + 1]))
        row = new
    return row[-1]


def test_pipeline_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    labels = spark.read.parquet(f"{SMALL}/labels.parquet")
    rules = dl.judged(docs, labels)[1]
    items = [words(r.text) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
    rows, out = docs.collect(), {}
    kept = []
    for r in rows:
        n, chars, symbols, dup, repeat = plain(r.text)
        values = {"words": n, "symbols": symbols / max(n, 1), "word_length": chars / max(n, 1), "repeats": repeat / max(n, 1)}
        assert all(f in values for rule in rules for f, _, _ in rule.conditions)
        bad = any(all((values[f] <= t) == below for f, below, t in rule.conditions) for rule in rules)
        if n >= 10 and 100 * repeat <= 20 * n and not bad:
            kept.append(r)
    out["quality_rules"] = Counter(r.doc_id for r in kept)
    roots = brute([r.doc_id for r in kept], [r.text for r in kept])
    kept = [r for r in kept if roots[r.doc_id][1] == r.doc_id]
    out["ngram_jaccard_join"] = Counter(r.doc_id for r in kept)
    kept = [r for r in kept if not leaking(r.text, items)]
    out["benchmark_decontamination"] = Counter(r.doc_id for r in kept)
    sizes, taken = defaultdict(int), Counter()
    for r in kept:
        sizes[r.source] += len(words(r.text))
    aims = filled(sizes)
    for source, total in sizes.items():
        whole = math.floor(aims[source] / total)
        rest, below = aims[source] - whole * total, 0
        mine = [(int(hashlib.md5(f"{r.doc_id}:{len(words(r.text))}".encode()).hexdigest()[:15], 16), len(words(r.text)), r.doc_id) for r in kept if r.source == source]
        for _, size, doc_id in sorted(mine):
            taken[doc_id] = whole + max(0, min(1, math.floor((rest - below) / size + 0.5)))
            below += size
    out["source_mixing"] = +taken

    got = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        got = materialise(stage(spark, got, SMALL), name)
        assert got.columns == docs.columns
        assert Counter(r.doc_id for r in got.collect()) == out[name], name
    shards = corpus_pipeline.STAGES[-1][1](spark, got, SMALL).collect()
    check_shards(shards, sum(taken.values()), 24)
    assert Counter(r.doc_id for r in shards) == +taken
    assert Counter(map(tuple, shards)) == Counter(map(tuple, corpus_pipeline.run(spark, SMALL).collect()))
