"""Small tables and plain versions for the corpus operators."""

from __future__ import annotations

import random
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, mark string, token int, size string, c0 int, n long"


def words(text, lower=True):
    text = text or ""
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text) if lower else text)


def table(spark, texts, **columns):
    """``documents`` with further columns whose names operators use inside."""
    rows = []
    for k, text in enumerate(texts):
        row = {"doc_id": k, "text": text, "lang": "en", "source": "a", "n_chars": 1, "mark": "x", "token": 1, "size": "s", "c0": 7, "n": 3}
        row |= {name: values[k] for name, values in columns.items()}
        rows.append(tuple(row.values()))
    return spark.createDataFrame(rows, SCHEMA)


def sentence(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


LONG = " ".join(f"l{k}" for k in range(30_000))
MESSY = [None, "", " \n\t ", "one two", LONG, "a b c d e f g h i j k l", "a b c d e f g h i j k l", "ÉÈ ß 日本  x", "x\n\nx\ny z"]


def messy(spark):
    """Nulls in any column, empty and very long texts, repeated rows and reused ids."""
    ids = [None, 1, 2, 3, 4, 5, 5, 7, 7]
    langs = [None, "en", "en", None, "en", "de", "de", "fr", "fr"]
    sources = [None, "a", "a", "b", None, "b", "b", "ü", "Z"]
    return table(spark, MESSY, doc_id=ids, lang=langs, source=sources, n_chars=[None] * 9)


def near_copies(seed=1, groups=4, size=14, length=60):
    """Texts edited more and more, so that links lie on both sides of the bound, with passages in common."""
    rng = random.Random(seed)
    shared = sentence(rng, 25)
    out = []
    for _ in range(groups):
        base = sentence(rng, length).split()
        for _ in range(size):
            text = list(base)
            for _ in range(rng.randrange(5)):
                text[rng.randrange(len(text))] = f"e{rng.randrange(6)}"
            out.append((shared + " " if rng.random() < 0.4 else "") + " ".join(text))
    out += [shared + " " + sentence(rng, rng.randrange(3, 30)) for _ in range(20)]
    out += [sentence(rng, 3), out[0], out[0].upper(), "one", "ONE", None, ""]
    return out
