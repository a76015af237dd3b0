import gzip
import hashlib
import zlib
from collections import defaultdict
from pathlib import Path

import pytest

from supplyscope.llm import fixity, link_trust
from supplyscope.sources import scratch_dir

PAGES = "page_id long, url string, html string, host string, rank int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], PAGES)


def linked(*urls):
    return "".join(f'<a class=x HREF="{u}">x</a> <a href=\'/local\'>y</a>' for u in urls)


def brute(links, seeds, rounds=20, damping=0.85):
    """``links``: {(src, dst): n}; ``seeds``: {host: weight}."""
    outs = defaultdict(int)
    for (a, _), n in links.items():
        outs[a] += n
    rank = {h: w * (1 - damping) for h, w in seeds.items()}
    for _ in range(rounds):
        new = {h: w * (1 - damping) for h, w in seeds.items()}
        for (a, b), n in links.items():
            new[b] = new.get(b, 0) + damping * rank.get(a, 0) * n / outs[a]
        rank = new
    return rank


def test_ranks_and_verdicts_equal_a_plain_walk(spark):
    hosts = [f"h{k}.net" for k in range(20)] + ["good.org", "x.good.org", "bad.com", "www.example.org"]
    rows, links = [], defaultdict(int)
    for k, host in enumerate(hosts):
        to = [hosts[(k * 7 + j * 5) % len(hosts)] for j in range(1 + k % 3)]
        for t in to:
            if t != host:
                links[host, t] += 1
        path = {"bad.com": "/de/x", "www.example.org": "/es/q"}.get(host, "/p")
        rows.append((k, f"https://{host.upper() if k % 2 else host}{path}?a=://b", linked(*(f"http://{t}/z" if k % 2 else f"//{t}" for t in to))))
    got = {r.host: r for r in link_trust.judged(pages(spark, rows)).collect()}
    trust = brute(links, {"good.org": 1, "x.good.org": 1})
    distrust = brute({(b, a): n for (a, b), n in links.items()}, {"bad.com": 1, "www.example.org": 1})
    for host, r in got.items():
        assert r.trust == pytest.approx(trust.get(host, 0)) and r.distrust == pytest.approx(distrust.get(host, 0))
        if not r.rule:
            bad = distrust.get(host, 0) > 0 and distrust.get(host, 0) >= 2 * trust.get(host, 0)
            assert r.verdict == ("block" if bad else "allow")
    assert {r.verdict for r in got.values() if not r.rule} == {"allow", "block"}


def test_rules_and_parts_of_urls(spark):
    rows = {
        "http://A.org/": ("a.org", "/", "org/", "allow"),
        "http://example.org/es/1#/en/": ("example.org", "/es/1", "example.org/es/", "block"),
        "x://m.example.org/en/12?q": ("m.example.org", "/en/12", "example.org/en/1", "block"),
        "http://example.org/en/2": ("example.org", "/en/2", "org/", "allow"),
        "http://notexample.org/es/": ("notexample.org", "/es/", "org/", "allow"),
        "http://a.com/fr/": ("a.com", "/fr/", "com/fr/", "allow"),
        "http://É.NET/FR/": ("É.net", "/FR/", None, "allow"),
        "http://z.org?/x": ("z.org", "", None, "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "http://": ("", "", None, "allow"),
    }
    got = link_trust.judged(pages(spark, [(k, u, None) for k, u in enumerate(rows)])).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == dict(enumerate(rows.values()))


def test_hosts_of_very_many_labels(spark):
    host = "a." * 40_000
    rows = [(1, f"http://{host}org/x", None), (2, f"http://{host}example.org/es/", None), (3, f"http://{host}", None)]
    got = {r.page_id: (r.rule, r.verdict, len(r.host)) for r in link_trust.judged(pages(spark, rows)).collect()}
    assert got == {1: ("org/", "allow", 80_003), 2: ("example.org/es/", "block", 80_011), 3: (None, "allow", 80_000)}


def test_the_longest_rule_wins(spark):
    rules = (("b.c/x", "allow"), ("c/", "block"), ("b.c/xy", "block"), ("a.b.c", "allow"), ("a.b.c/x", "block"))
    urls = {"//b.c/x": "b.c/x", "//q.b.c/xyz": "b.c/xy", "//a.b.c/": "a.b.c", "//a.b.c/xy": "a.b.c/x", "//b.c/": "c/", "//bb.c": None, "//c": None, "//d": None}
    got = link_trust.judged(pages(spark, [(k, f"s:{u}", None) for k, u in enumerate(urls)]), rules).collect()
    assert {r.page_id: r.rule for r in got} == dict(enumerate(urls.values()))


def test_messy_and_empty_pages(spark):
    rows = [(None, None, None), (1, "http://a.net/", None), (1, "http://a.net/", None), (2, "http://a.net/", "<a href=" + "x" * 200_000 + ">")]
    assert link_trust.judged(pages(spark, rows)).count() == 4
    assert link_trust.judged(pages(spark, rows), rules=()).count() == 4
    assert link_trust.judged(pages(spark, rows[:0])).collect() == []


def replicas(spark, rows, change=None, volume_bytes=600):
    paths = [scratch_dir(spark, f"test-{k}") for k in (1, 2)]
    fixity.write_warc(pages(spark, rows).repartition(3), paths[0], volume_bytes)
    fixity.copy_warc(spark, *paths, change)
    return paths


FAKE = "\r\n\r\nWARC/1.1\r\n"


def some(n):
    return [(k, f"http://a.net/{k}", f"<p>ß {k}{'' if k % 2 else FAKE}{'x' * k}") for k in range(n)]


def records_of(path):
    """What the files hold, by volume and id, read plainly: blocks are as long as their heads say."""
    found = {}
    for file in Path(path.removeprefix("file:")).glob("part-*"):
        data, at, volume = gzip.decompress(file.read_bytes()), 0, None
        while at < len(data):
            head = data.index(b"\r\n\r\n", at)
            fields = dict(x.split(b": ", 1) for x in data[at:head].split(b"\r\n")[1:])
            end = head + 8 + int(fields[b"Content-Length"])
            volume = volume or fields[b"WARC-Filename"]
            assert (volume, fields[b"WARC-Record-ID"]) not in found
            found[volume, fields[b"WARC-Record-ID"]] = data[at:end]
            at = end
    return found


def page_of(name):
    return name.split(":")[2]


def test_records_are_the_pages(spark):
    paths = replicas(spark, some(50))
    one, two = map(records_of, paths)
    assert one == two and len({v for v, _ in one}) > 3
    blocks = {x.split(b"\r\n\r\n", 1)[1][:-4] for (_, name), x in one.items() if name.startswith(b"<urn:page")}
    assert blocks == {html.encode() for _, _, html in some(50)}
    read = fixity.read_warc(spark, paths[0]).collect()
    assert {(str(r.volume).encode(), f"<{r.id}>".encode(), r.digest) for r in read} == {(v, n, hashlib.sha256(x).hexdigest()) for (v, n), x in one.items()}


def test_findings_equal_a_plain_diff(spark):
    """Records changed in their blocks and lost, by hashes of their ids."""

    def change(name, record):
        lot = zlib.crc32(name) % 5
        if not name.startswith(b"urn:page:") or lot > 1:
            return record
        return record[:-5] + b"~" + record[-4:] if lot else None

    paths = replicas(spark, some(150), change)
    one, two = map(records_of, paths)
    want = {(int(v), n.decode().strip("<>"), "changed" if (v, n) in two else "missing") for (v, n), x in one.items() if two.get((v, n)) != x}
    got = [(r.volume, r.id, r.damage) for r in fixity.audit(spark, *paths).collect()]
    assert len(want) > 30 and set(got) == want and len(got) == len(want)
    back = [(r.volume, r.other_id, r.damage) for r in fixity.audit(spark, *paths[::-1]).collect()]
    assert set(back) == {(v, n, {"missing": "extra"}.get(d, d)) for v, n, d in want}


def test_all_damage_is_located(spark):
    def change(name, record):
        page = name.decode().split(":")[2] if name.startswith(b"urn:page:") else ""
        if page in ("3", "71", "72"):
            return None
        if page in ("5", "40"):
            return record[:-5] + b"#" + record[-4:]
        return record[8:] if page == "99" else record + record.replace(name, name + b"x") if page == "2" else record

    paths = replicas(spark, some(120), change)
    found = fixity.audit(spark, *paths).collect()
    by = defaultdict(set)
    for r in found:
        by[r.damage].add(page_of(r.id or r.other_id))
    assert by == {"missing": {"3", "71", "72"}, "changed": {"5", "40", "99"}, "extra": {"2"}} and len(found) == 7


def test_equal_and_empty_replicas(spark):
    for rows in (some(40), some(1), []):
        assert fixity.audit(spark, *replicas(spark, rows)).collect() == []
    paths = replicas(spark, some(40))
    gone = sorted(Path(paths[1].removeprefix("file:")).glob("part-*"))[0]
    lost = records_of(str(gone.parent)).keys()
    gone.unlink()
    lost -= records_of(str(gone.parent)).keys()
    found = fixity.audit(spark, *paths).collect()
    assert {(str(r.volume).encode(), f"<{r.id}>".encode(), r.damage) for r in found} == {(*k, "missing") for k in lost}


def test_files_damaged_as_a_whole(spark):
    """A file cut short within its compression loses its last records; one without its first record is no known volume."""
    paths = replicas(spark, some(60), volume_bytes=3000)
    cut, headless = sorted(Path(paths[1].removeprefix("file:")).glob("part-*"))[:2]
    one = records_of(paths[0])
    cut.write_bytes(cut.read_bytes()[:-60])
    data = gzip.decompress(headless.read_bytes())
    headless.write_bytes(gzip.compress(data[data.index(b"WARC/1.1", 8) :]))
    for crc in Path(cut.parent).glob(".*.crc"):
        crc.unlink()
    found = fixity.audit(spark, *paths).collect()
    assert {r.damage for r in found} >= {"missing", "extra"}
    assert {r.id for r in found if r.damage != "extra"} <= {n.decode().strip("<>") for _, n in one}


def test_messy_records(spark):
    rows = [(None, None, None), (None, None, None), (1, "http://a\r\nb/", ""), (1, "http://a/", "x" * 300_000), (1, "http://a/", "x" * 300_000)]
    paths = replicas(spark, rows)
    read = fixity.read_warc(spark, paths[0]).collect()
    assert len({r.id for r in read if r.id.startswith("urn:page")}) == 5 and fixity.audit(spark, *paths).collect() == []
    assert any(b"WARC-Target-URI: http://ab/" in x for x in records_of(paths[0]).values())
