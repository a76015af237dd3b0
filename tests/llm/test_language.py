import random
import zlib

import numpy as np
import pytest
from helpers import MESSY, SCHEMA, messy, table

from supplyscope.llm import ecoc

PARTS = {"de": "sch ein ung ber keit", "en": "th ing ed er ly", "fr": "eau oi tion ment é", "es": "ción os ado que ñ", "it": "zione gli che issimo", "pl": "szcz ów ie przy ść", "nl": "ij oe aan heid", "fi": "ää yö nen ssa"}


def corpus(spark, languages, n=240):
    rng, texts, langs = random.Random(4), [], []
    for k in range(n):
        lang = languages[k % len(languages)]
        parts = PARTS[lang].split()
        texts.append(" ".join("".join(rng.choices(parts, k=rng.randrange(1, 4))) for _ in range(rng.randrange(4, 60))))
        langs.append(lang)
    return table(spark, texts, lang=langs), langs


@pytest.mark.parametrize("languages", [["de", "en", "fr", "es"], list(PARTS)])
def test_held_out_texts_are_told_apart(spark, languages):
    docs, langs = corpus(spark, languages)
    rows = ecoc.identified(docs).collect()
    assert len(rows) == 240
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) and 0 <= r.score <= 1
    held = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert len(held) > 50 and np.mean(held) >= 0.97


def test_held_out_labels_are_not_used(spark):
    docs, langs = corpus(spark, ["de", "en", "fr", "es"])
    other = [("xx" if zlib.crc32(str(k).encode()) % 3 == 1 else x) for k, x in enumerate(langs)]
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    a = {r.doc_id: tuple(r) for r in ecoc.identified(docs).collect()}
    b = {r.doc_id: tuple(r) for r in ecoc.identified(table(spark, texts, lang=other)).collect()}
    assert a == b


def test_codewords_correct_errors():
    for n in range(2, 12):
        code = ecoc.codewords(n)
        gap = min((code[i] != code[j]).sum() for i in range(n) for j in range(i))
        assert gap >= max(1, 2 ** (min(n, 6) - 2)) if n <= 6 else gap >= 5
    model = ecoc.Model(["a", "b", "c", "d"], np.ones((4, ecoc.BUCKETS)))
    for k in range(4):
        for wrong in range(model.code.shape[1]):
            margins = model.code[k] * 2.0
            margins[wrong] *= -1
            best, _, lead = model.decoded(margins[None].astype(np.float32))
            assert best[0] == k and lead[0] > 0


def test_a_text_between_two_languages_is_ambiguous(spark):
    docs, _ = corpus(spark, ["de", "en"])
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    langs = [r.lang for r in docs.orderBy("doc_id").collect()]
    rows = ecoc.identified(table(spark, [*texts, "zzz xxx qqq"], lang=[*langs, None])).collect()
    assert sum(r.ambiguous for r in rows) <= 3
    assert {r.doc_id: r.ambiguous for r in rows}[240]


def test_messy_rows(spark):
    rows = ecoc.identified(messy(spark)).collect()
    assert len(rows) == len(MESSY)
    by = {r.doc_id: r for r in rows}
    assert all(by[k].lang_pred == "und" and by[k].score == 0 for k in (None, 1, 2))
    assert {by[k].lang_pred for k in (3, 4, 5, 7)} <= {"de", "en", "fr"}


def test_without_training_rows_and_with_one_language(spark):
    assert ecoc.identified(spark.createDataFrame([], SCHEMA)).collect() == []
    none = table(spark, ["abc def", None], lang=[None, None])
    assert [r.lang_pred for r in ecoc.identified(none).collect()] == ["und", "und"]
    one = ecoc.identified(table(spark, ["abc def", "12", "x"])).collect()
    assert [(r.lang_pred, r.score) for r in sorted(one, key=lambda r: r.doc_id)] == [("en", 1.0), ("und", 0.0), ("en", 1.0)]
