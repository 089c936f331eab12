"""WARC archives and host trust against plain Python."""

import base64
import gzip
import hashlib
from collections import Counter

import pytest

from candlestream.llm import host_trust, warc

SCHEMA = "page_id bigint, url string, html string, host string, digest string, first string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], SCHEMA).repartition(3)


PAGES = [
    (5, "http://a.net/1", "<p>one</p>"), (3, "http://b.net/", "<p>one</p>"), (9, None, ""), (4, "", None),
    (7, "http://c.net/\r\nX: y", "two\r\n\r\nWARC/1.1"), (8, "http://d.net/ü", "ü" * 200_000),
    (None, "http://e.net/", "nobody"), (3, "http://b.net/", "<p>one</p>"),
    *[(100 + k, f"http://h.net/{k}", f"text {k} " * (k * 50)) for k in range(40)],
]


def base32(html):
    return base64.b32encode(hashlib.sha1((html or "").encode()).digest()).decode()


@pytest.mark.parametrize("least", [0, 5])
def test_archive_gives_back_every_page(spark, tmp_path, least):
    folder = f"file://{tmp_path}/warc"
    manifest = warc.write(pages(spark, PAGES), folder, revisit_bytes=least, shard_bytes=100_000, file_bytes=5_000).collect()
    first = {}
    for page, _, html in PAGES:
        if page is not None and len((html or "").encode()) >= least:
            first[html or ""] = min(first.get(html or "", page), page)
    want = Counter()
    for page, _, html in PAGES:
        to = first.get(html or "", page)
        later = page is not None and page > to
        want[page, len((html or "").encode()), base32(html), "revisit" if later else "response", to if later else None] += 1
    got = warc.read(spark, folder).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert all(r.payload.decode() in {h or "" for p, _, h in PAGES if p == r.page_id}
               for r in got if r.record_type == "response")
    assert len(manifest) > 3 and sum(r.records for r in manifest) == len(PAGES)
    for r in manifest:
        data = (tmp_path / "warc" / r.name).read_bytes()
        assert len(data) == r.bytes and hashlib.sha1(data).hexdigest() == r.digest
        assert r.bytes <= 5_000 or r.records == 1
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\n")


def test_a_page_without_id_hides_no_revisits(spark, tmp_path):
    rows = [(None, "http://n.net/", ""), (4, "http://a.net/", ""), (9, "http://b.net/", None), (None, None, ""),
            (None, None, "x"), (None, None, "x")]
    folder = f"file://{tmp_path}/warc"
    warc.write(pages(spark, rows), folder)
    got = Counter((r.page_id, r.record_type, r.refers_to) for r in warc.read(spark, folder).collect())
    assert got == Counter({(None, "response", None): 4, (4, "response", None): 1, (9, "revisit", 4): 1})


def test_shards_of_hot_ids_are_of_equal_size(spark, tmp_path):
    """A third of the pages have no id, a third are one page that repeats, and some are larger than others."""
    rows = [(None, f"http://n.net/{k}", f"page {k} " + "n" * 900) for k in range(300)]
    rows += [(7, "http://r.net/", "same" * 250)] * 300
    rows += [(1000 + k, f"http://i.net/{k}", f"{k} " + "i" * (20 * (k % 100))) for k in range(300)]
    folder = f"file://{tmp_path}/warc"
    manifest = warc.write(pages(spark, rows), folder, shard_bytes=40_000, file_bytes=1 << 30).collect()
    got = warc.read(spark, folder).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == Counter(
        (page, len(html), base32(html), "response", None) for page, _, html in rows)
    held = {}
    for r in manifest:
        data = gzip.decompress((tmp_path / "warc" / r.name).read_bytes())
        held[r.name] = sum(int(f["X-Payload-Length"]) + warc.HEAD_BYTES for f, _ in warc.parse(
            iter([(tmp_path / "warc" / r.name).read_bytes()])))
        assert data.count(b"WARC/1.1\r\n") == r.records
    sizes = [held[name] for name in sorted(held)]
    total = sum(len(html) + warc.HEAD_BYTES for _, _, html in rows)
    assert len(sizes) == -(-total // 40_000) and max(sizes) < 43_000 and min(sizes[:-1]) > 37_000
    order = [r.page_id for name in sorted(held) for r in spark.createDataFrame([(name,)], "name string").mapInArrow(
        warc._reader(folder, False), warc.RECORD).collect()]
    assert order == sorted(order, key=lambda x: (x is not None, x or 0))


def test_archives_of_one_table_are_equal(spark, tmp_path):
    made = []
    for k in range(2):
        manifest = warc.write(pages(spark, PAGES).repartition(1 + 4 * k), f"file://{tmp_path}/{k}", shard_bytes=100_000)
        made.append(sorted((r.name, r.digest) for r in manifest.collect()))
    assert made[0] == made[1]
    assert not (tmp_path / "0" / "_temporary").exists()


def test_archive_of_nothing(spark, tmp_path):
    warc.write(pages(spark, []), f"file://{tmp_path}/none")
    assert warc.read(spark, f"file://{tmp_path}/none").collect() == []


def test_a_broken_record_is_noticed():
    good = warc.record(1, "http://a.net/", b"payload", None, None)
    assert next(warc.parse(iter([warc.gzip_member(good)])))[1].endswith(b"payload")
    with pytest.raises(ValueError, match="digest"):
        next(warc.parse(iter([warc.gzip_member(good.replace(b"payload", b"peyload"))])))
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.parse(iter([warc.gzip_member(good)[:-9]])))


URLS = [
    (1, "https://x.org/a", "x.org", "/a", "org/", "allow"),
    (2, "https://EXAMPLE.org/es/1?q=1", "example.org", "/es/1", "example.org/es/", "block"),
    (3, "http://m.example.org/en/15#t", "m.example.org", "/en/15", "example.org/en/1", "block"),
    (4, "http://m.example.org/en/25", "m.example.org", "/en/25", "org/", "allow"),
    (5, "http://a.com/fr/", "a.com", "/fr/", "com/fr/", "allow"),
    (6, "http://b.com/de/x", "b.com", "/de/x", "com/de/", "block"),
    (7, "http://notorg/", "notorg", "/", None, "allow"), (8, None, "", "", None, "allow"),
    (9, "no scheme", "", "", None, "allow"), (10, "http://x.org?p=/", "x.org", "", None, "allow"),
    (11, "http://b.com/en/", "b.com", "/en/", None, "block"),
]


def test_rules_and_verdicts(spark):
    got = host_trust.judge(pages(spark, [(k, url, None) for k, url, *_ in URLS]))
    rows = {r.page_id: r for r in got.collect()}
    assert {k: (r.host, r.path, r.rule, r.verdict) for k, r in rows.items()} == {
        k: tuple(rest) for k, _, *rest in URLS}


def pagerank(links, seeds, damping, rounds):
    total = sum(seeds.values())
    start = {h: w / total for h, w in seeds.items()}
    out = Counter()
    for (a, _), n in links.items():
        out[a] += n
    score = dict(start)
    for _ in range(rounds):
        new = {h: (1 - damping) * w for h, w in start.items()}
        for (a, b), n in links.items():
            if a in score:
                new[b] = new.get(b, 0) + damping * score[a] * n / out[a]
        score = new
    mass = sum(score.values())
    return {h: s / mass for h, s in score.items()}


def test_trust_and_distrust_follow_links(spark):
    def links(*to):
        return "".join(f'<a href="{t}">x</a>' for t in to)

    rows = [
        (1, "http://good.org/", links("http://friend.net/", "//Friend.net/2", "/own", "http://mixed.net/")),
        (2, "http://friend.net/", links("https://deep.net/x")),
        (3, "http://spammer.net/", links("http://bad.com/de/", "http://bad.com/de/2")),
        (4, "http://bad.com/de/", None), (5, "http://mixed.net/", links("http://spammer.net/", "http://deep.net")),
        (6, "http://far.net/", links("http://spammer.net/")), (7, "http://alone.net/", ""),
    ]
    got = {r.page_id: r for r in host_trust.judge(pages(spark, rows)).collect()}
    edges = Counter({("good.org", "friend.net"): 2, ("good.org", "mixed.net"): 1, ("friend.net", "deep.net"): 1,
                     ("spammer.net", "bad.com"): 2, ("mixed.net", "spammer.net"): 1, ("mixed.net", "deep.net"): 1,
                     ("far.net", "spammer.net"): 1})
    trust = pagerank(edges, {"good.org": 1}, 0.85, 30)
    distrust = pagerank({(b, a): n for (a, b), n in edges.items()}, {"bad.com": 1}, 0.85, 30)
    for r in got.values():
        assert r.trust == pytest.approx(trust.get(r.host, 0)) and r.distrust == pytest.approx(distrust.get(r.host, 0))
    assert [got[k].verdict for k in (1, 2, 3, 4, 6, 7)] == ["allow", "allow", "block", "block", "block", "allow"]


def test_scores_settle_and_reach_every_host(spark):
    """A cycle, which 30 rounds leave unsettled, and a chain of more links than that."""
    edges = Counter({("c0", "c1"): 2, ("c1", "c2"): 1, ("c2", "c0"): 1, ("c1", "c0"): 3})
    edges.update({(f"h{k}", f"h{k + 1}"): 1 for k in range(40)})
    links = spark.createDataFrame([(a, b, n) for (a, b), n in edges.items()], "src string, dst string, n bigint")
    seeds = {"c0": 3.0, "h0": 1.0}
    got = {r.host: r.score for r in host_trust.spread(
        links.coalesce(1), spark.createDataFrame(list(seeds.items()), "host string, weight double").coalesce(1)
    ).collect()}
    want = pagerank(edges, seeds, 0.85, 400)
    assert got.keys() == want.keys() and len(got) == 44
    assert all(got[h] == pytest.approx(want[h], abs=1e-8) for h in want) and got["h40"] > 0


def test_a_host_beyond_the_tolerance_is_reached(spark):
    """Far hosts get so little that the change is below the tolerance long before they are reached."""
    links = spark.createDataFrame([(f"h{k}", f"h{k + 1}", 1) for k in range(12)], "src string, dst string, n bigint")
    seeds = spark.createDataFrame([("h0", 1.0)], "host string, weight double")
    got = host_trust.spread(links.coalesce(1), seeds, tolerance=0.5).collect()
    assert len(got) == 13 and all(r.score > 0 for r in got)


def test_no_pages(spark):
    assert host_trust.judge(pages(spark, [])).collect() == []
