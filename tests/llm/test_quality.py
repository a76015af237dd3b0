import random
from collections import Counter

import pytest
from helpers import MESSY, SCHEMA, messy, sentence, table, words

from supplyscope.llm import decision_list as dl


def plain(text):
    text = text or ""
    w = words(text, lower=False)
    lines = [x for x in text.split("\n") if words(x)]
    grams = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {k for i in range(len(w) - 4) if grams[tuple(w[i : i + 5])] > 1 for k in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_statistics_equal_a_plain_count(spark):
    rng = random.Random(3)
    texts = [*MESSY, "a b c d e f a b c d e", "x " * 30, "p q r s t\n" * 3 + "\n \n", "#a *b $c|<>&% d", "1 2 3 4 5 6 7 1 2 3 4 5 9 3 4 5 6 7"]
    texts += ["\n".join(rng.choice([sentence(rng, 6, 5), "", "ß é\t日本"]) for _ in range(rng.randrange(9))) for _ in range(40)]
    rows = dl.text_statistics(table(spark, texts)).collect()
    assert {r.doc_id: tuple(r[c] for c in dl.BASE) for r in rows} == {k: plain(t) for k, t in enumerate(texts)}


def labelled(spark, seed=5, n=400):
    """Symbols make a text bad, unless it is long; a few short repeated texts fail without a rule."""
    rng, texts, labels = random.Random(seed), [], []
    for k in range(n):
        bad = k % 4 == 0
        w = sentence(rng, rng.randrange(30, 200)).split()
        texts.append(" ".join(f"{x}###" if bad and rng.random() < 0.7 else x for x in w))
        labels.append((k, 0 if bad else 1, 0))
    texts += ["a b c", "z " * 50]
    return table(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_rules_are_learned_and_applied(spark):
    docs, labels = labelled(spark)
    rows, rules = dl.judged(docs, labels)
    assert 1 <= len(rules) <= 3 and rules[0].conditions[0][0] == "symbols" and rules[0].precision >= 0.95
    got = {r.doc_id: (r.base_failed, r.kept) for r in rows.collect()}
    assert [got[400], got[401]] == [(True, False)] * 2
    right = sum(got[k][1] == (k % 4 != 0) for k in range(400))
    assert right >= 396
    kept = dl.keep_good(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(k for k, (_, x) in got.items() if x)
    assert sorted(map(tuple, kept.where("doc_id < 30").collect())) == sorted(tuple(r) for r in docs.where("doc_id < 30").collect() if got[r.doc_id][1])


def test_clean_and_unlabelled_texts_stay(spark):
    docs, labels = labelled(spark, n=80)
    for few in (labels.where("quality = 1"), labels.where("quality = 0"), labels.limit(0), labels.selectExpr("CAST(NULL AS LONG) AS doc_id", "quality")):
        rows, rules = dl.judged(docs, few)
        assert rules == [] and all(r.kept != r.base_failed for r in rows.collect())


def test_labels_that_contradict(spark):
    docs, labels = labelled(spark)
    noisy = labels.unionByName(labels.withColumn("quality", 1 - labels.quality)).unionByName(labels)
    assert dl.judged(docs, noisy)[1] == dl.judged(docs, labels)[1]


@pytest.mark.parametrize("make", [messy, lambda spark: spark.createDataFrame([], SCHEMA)])
def test_messy_and_empty_tables(spark, make):
    docs = make(spark)
    labels = spark.createDataFrame([(1, None, 0), (None, 1, None), (5, 0, 0)], "doc_id long, quality int, toxic int")
    rows, _ = dl.judged(docs, labels)
    assert rows.count() == docs.count()
    assert dl.keep_good(docs, labels).count() == rows.where("kept").count()
