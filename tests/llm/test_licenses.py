import random

import pytest
from helpers import SCHEMA, messy, sentence, table

from supplyscope.llm import licenses


@pytest.fixture(scope="module")
def model():
    rng = random.Random(8)
    return licenses.Model([sentence(rng, rng.randrange(5, 40)) for _ in range(300)])


def test_notices_are_found_in_texts(spark):
    rng, texts, want = random.Random(9), [], set()
    listed = [(f, n) for f, notices in licenses.NOTICES.items() for n in notices]
    for k in range(120):
        rows = [sentence(rng, rng.randrange(5, 30)) for _ in range(rng.randrange(1, 5))]
        if k % 2 == 0:
            family, notice = listed[k // 2 % len(listed)]
            at = rng.randrange(len(rows) + 1)
            rows.insert(at, notice + ".")
            want.add((k, at, family))
        texts.append("\n".join(rows))
    rows = licenses.licences(table(spark, texts)).collect()
    got = {(r.doc_id, r.line, r.family) for r in rows}
    assert len(got - want) == 0 and len(want - got) <= 2
    assert all(0.4 <= r.probability <= 1 and r.similarity >= licenses.SIMILAR for r in rows)


def test_held_out_wordings(model):
    right = {
        "Portions of this file are licensed under the Apache License, Version 2.0 (the License);": "Apache-2.0",
        "(c) 2019 A. Nother. All rights reserved.": "proprietary",
        "Our code is released under the MIT License!": "MIT",
        "this document is licensed under the GNU General Public License version 3 or later": "GPL-3.0",
        "Text licensed under CC BY-NC 4.0, figures excluded": "CC-BY-NC-4.0",
    }
    assert {x: model.judged(x)[0] for x in right} == right


def test_words_without_a_notice_are_unknown(model):
    for x in ["the driver's license was not at home", "mit der Lizenz", "public version 3", "no rights", "General Foundation software copy", ""]:
        assert model.judged(x)[0] == licenses.UNKNOWN
    assert 0.4 <= model.least <= 1


def test_messy_and_empty_tables(spark):
    assert licenses.licences(messy(spark)).collect() == []
    assert licenses.licences(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = table(spark, [("w " * 20_000) + "Released under the MIT License. " + ("v " * 20_000), None, "All rights reserved.", "All rights reserved."], doc_id=[4, None, None, None])
    got = sorted(((r.doc_id, r.line, r.family) for r in licenses.licences(docs).collect()), key=str)
    assert got == [(4, 0, "MIT"), (None, 0, "proprietary"), (None, 0, "proprietary")]


def test_wrapped_notices_and_two_families_in_a_line(spark):
    bsd = "# Redistribution and use in source and binary forms, with or without\n# modification, are permitted provided that"
    gpl = " * under the terms of the GNU General Public License as published by\n * the Free Software Foundation, either version 2 of it"
    both = "Released under the MIT License or licensed under the Apache License, Version 2.0"
    texts = [bsd, "/*\n" + gpl + "\n */", both, "Redistribution and use in source and binary\n\nforms, with or without modification, are permitted"]
    got = sorted((r.doc_id, r.line, r.family) for r in licenses.licences(table(spark, texts)).collect())
    assert got == [(0, 0, "BSD-3-Clause"), (1, 1, "GPL-2.0"), (2, 0, "Apache-2.0"), (2, 0, "MIT")]
