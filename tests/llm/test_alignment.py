"""Alignment of tokenizers against the tokenizers themselves and a plain comparison of spans."""

import hashlib
import random
from collections import Counter

import public_tokenizers
import pytest
import sentencepiece
from helpers import messy, table
from tokenizers import Tokenizer

from supplyscope.llm import alignment

PATHS = tuple(public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
A = Tokenizer.from_file(PATHS[0])
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
LETTERS = {c: b for b, c in alignment._byte_letters().items()}
ODD = ["word", "it's", "Über", " ", "  ", "\n", " \n ", "\t", "\xa0", "　", "\x1c", "日本語", "🙂", "é", "é", "<|endoftext|>", "<s>", "<0x41>", "12345", "--", "...", "ß", "\r\n", "\x00", "unbelievably"]


def tokens(text):
    """Ids of both and the bytes of each token; none where they differ from a space and the text."""
    if not text:
        return [], [], [], []
    a = A.encode(" " + text, add_special_tokens=False).ids
    b = B.encode(text)
    ab = [bytes(LETTERS[c] for c in A.id_to_token(k)) for k in a]
    bb = [bytes([int(B.id_to_piece(k)[3:5], 16)]) if B.is_byte(k) else B.id_to_piece(k).replace("▁", " ").encode() for k in b]
    whole = (" " + text).encode()
    return (a, b, ab, bb) if b"".join(ab) == whole == b"".join(bb) else ([], [], [], [])


def spans(parts):
    at, out = 0, []
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def plain(text):
    a, b, ab, bb = tokens(text)
    sa, sb = spans(ab), spans(bb)
    links = [(i, j) for i, x in enumerate(sa) for j, y in enumerate(sb) if x[0] < y[1] and y[0] < x[1]]
    cuts = sorted({e for _, e in sa} & {e for _, e in sb})
    groups, low = [], 0
    for cut in cuts:
        own = ([str(k) for k, (s, e) in zip(a, sa, strict=True) if low <= s and e <= cut], [str(k) for k, (s, e) in zip(b, sb, strict=True) if low <= s and e <= cut])
        groups.append("|".join(",".join(x) for x in own))
        low = cut
    return a, b, links, cuts, ";".join(groups)


def odd_texts(seed=4, n=150):
    rng = random.Random(seed)
    texts = ["".join(rng.choices(ODD, k=rng.randrange(1, 25))) for _ in range(n)]
    return texts + [" ".join(rng.choices(ODD, k=12)) for _ in range(n)] + ["plain words, and more of them.", "a▁b", None, "", " "]


def test_tokens_links_and_cuts(spark):
    texts = odd_texts()
    found = {r.doc_id: r for r in alignment.aligned(table(spark, texts), *PATHS).collect()}
    some = 0
    for k, text in enumerate(texts):
        a, b, links, cuts, _ = plain(text)
        r = found[k]
        assert (r.a, r.b, r.cuts) == (a, b, cuts), repr(text)
        assert list(zip(r.link_a, r.link_b, strict=True)) == links
        some += len(links) > len(a)
    assert some > 20


def check_digests(rows, texts):
    parts = [plain(t) for t in texts]
    pairs = [[(a[i], b[j]) for i, j in links] for a, b, links, _, _ in parts]
    counts = Counter(p for own in pairs for p in set(own))
    most = {}
    for (a, _), n in counts.items():
        most[a] = max(n, most.get(a, 0))
    want = Counter()
    for (a, b, links, cuts, groups), own, k in zip(parts, pairs, [r[0] for r in rows], strict=True):
        digest = hashlib.sha256(groups.encode()).hexdigest() if groups else ""
        want[(k, len(a), len(b), len(cuts), len(links), sum(counts[p] == most[p[0]] for p in own), sum(counts[p] for p in own), digest)] += 1
    return want


@pytest.mark.parametrize(("lane", "block"), [(256, alignment.BLOCK_LINKS), (20, 300)])
def test_digests_equal_a_plain_version(spark, monkeypatch, lane, block):
    monkeypatch.setattr(alignment, "LANE", lane)
    monkeypatch.setattr(alignment, "_TRIED", min(lane - 1, 32))
    texts = odd_texts(seed=lane) + ["same text here"] * 5 + [" ".join(random.Random(1).choices(ODD + ["tokenizers", "alignment"], k=900))]
    got = alignment.alignment_digests(table(spark, texts).repartition(3), *PATHS, block_links=block)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert Counter(map(tuple, got.collect())) == check_digests([(k,) for k in range(len(texts))], texts)


def test_nulls_and_repeated_rows(spark, rows):
    df = messy(spark)
    source = [(r.doc_id, (r.text or "")[:3000]) for r in df.collect()]
    short = table(spark, [t for _, t in source], doc_id=[k for k, _ in source])
    got = alignment.alignment_digests(short, *PATHS)
    assert Counter(map(tuple, got.collect())) == check_digests(source, [t for _, t in source])
    assert rows(alignment.alignment_digests(df.limit(0), *PATHS)) == []
    assert alignment.alignment_digests(df, *PATHS).count() == df.count()


def test_pair_counts(spark):
    texts = ["one two three", "one two", "one", None]
    got = {(r.a, r.b): r.n for r in alignment.pair_counts(table(spark, texts), *PATHS).collect()}
    want = Counter(p for t in texts for a, b, links, _, _ in [plain(t)] for p in {(a[i], b[j]) for i, j in links})
    assert got == want


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 10)
    monkeypatch.setattr(alignment, "_TOGETHER", 3)
    tok = alignment.Tokenizers(*PATHS)
    texts = [x or "" for x in odd_texts(seed=9)]
    for at in range(0, len(texts), 7):
        own = texts[at : at + 7]
        for side, (ids, bound) in enumerate(tok.ids(own)):
            assert [ids[i:j].tolist() for i, j in zip(bound[:-1], bound[1:], strict=True)] == [tokens(x)[side] for x in own]
    tok.separable = False
    (ids, _), _ = tok.ids(texts)
    assert ids.tolist() == [k for x in texts for k in tokens(x)[0]]
