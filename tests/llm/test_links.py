"""SimHash links, nearest neighbours, audio, WARC and the pipeline."""

import random
import uuid

import numpy as np
import pytest
import xxhash
from chronokey.llm import ann, audio, simhash, warc
from chronokey.llm.queries import op4_chroma_fingerprints
from pyspark.sql import functions as F


def slow_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    bits = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for b in range(64):
            bits[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * bits[b] > len(shingles))


def slow_components(rows):
    """rows (doc_id, fingerprint) -> smallest id reachable, by comparing all pairs."""
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if (rows[i][1] ^ rows[j][1]).bit_count() <= 4:
                a, b = top(i), top(j)
                up[max(a, b)] = min(a, b)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[top(i)] = min(d, low.get(top(i), d))
    return [low.get(top(i)) for i in range(len(rows))]


def test_fingerprints():
    for t in (None, "", " \t\n", "One", "one TWO three", "a b c d", "É é Σ a a a a a", "x " * 40_000, "a\x0bb c　d e\xa0f g"):
        assert simhash.fingerprint(t) == slow_fingerprint(t)


def near_texts():
    rng = random.Random(8)
    words = ["".join(rng.choice("abcdefgh") for _ in range(5)) for _ in range(400)]
    out = []
    for g in range(12):
        base = [rng.choice(words) for _ in range(250)]
        for _ in range(rng.choice([1, 3, 40])):
            own = list(base)
            for _ in range(rng.randint(0, 2)):
                own[rng.randrange(len(own))] = rng.choice(words)
            out.append(" ".join(own))
    rng.shuffle(out)
    return out


def test_components(spark):
    texts = near_texts()
    rows = [(100 + i, t, "r") for i, t in enumerate(texts)] + [(None, texts[0], "r"), (3, None, None), (2, "", None), (None, " ", None), (100, texts[0], "r"), (7, "only one", None), (None, "alone here", None)]
    d = spark.createDataFrame(rows, "doc_id long, text string, root string")
    got = simhash.near_duplicates(d).collect()
    assert len(got) == len(rows)
    want = slow_components([(i, simhash.fingerprint(t)) for i, t, _ in rows])
    assert sorted(map(str, [(i, simhash.signed(simhash.fingerprint(t)), c) for (i, t, _), c in zip(rows, want)])) == sorted(map(str, [(r["doc_id"], r["fp"], r["component_id"]) for r in got]))
    kept = simhash.one_of_each(d, simhash.near_duplicates(d))
    assert kept.columns == d.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert sorted(x for x in ids if x is not None) == sorted(set(want) - {None}) and ids.count(None) == 1
    assert simhash.near_duplicates(d.limit(0)).count() == 0


def test_pieces_cover():
    """The pieces take each bit outside a segment once, so 4 differing bits leave one of five equal."""
    taken = [b for at, width in simhash.PIECES for b in range(at, at + width)]
    assert taken == list(range(43)) and all(width <= 9 for _, width in simhash.PIECES)
    assert len(simhash.PIECES) > simhash.MOST and 1 + 512 * len(simhash.PIECES) <= 1 << simhash.SPLIT


@pytest.mark.parametrize("segment", range(3))
def test_split_groups_brute_force(spark, segment):
    """Thousands of unlike fingerprints that share a segment, with links of 1 to 4 bits anywhere: no link is lost."""
    rng = random.Random(segment)
    first, width = simhash.SEGMENTS[segment]
    mask = (1 << width) - 1 << first
    common = rng.getrandbits(64) & mask
    fps = {rng.getrandbits(64) & ~mask | common for _ in range(1500)} | {0, (1 << 64) - 1}
    for x in rng.sample(sorted(fps), 300):
        fps.add(x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4))))
    rows = list(enumerate(sorted(fps)))
    d = spark.createDataFrame([(simhash.signed(x),) for _, x in rows], "fp long")
    want = slow_components(rows)
    sizes = simhash.grouped(d, 100).groupBy("key").count().agg({"count": "max"}).first()[0]
    assert sizes < 100 < simhash.grouped(d, 5000).groupBy("key").count().agg({"count": "max"}).first()[0]
    for hot in (0, 100):
        found = {r["node"]: r["root"] for r in simhash.components(simhash.links(d, hot=hot)).collect()}
        groups = {}
        for (i, x), w in zip(rows, want):
            groups.setdefault(found.get(simhash.signed(x), simhash.signed(x)), set()).add(w)
        assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_dense_group(spark):
    """Thousands of linked fingerprints of one group: all connected, few links given."""
    rng = random.Random(5)
    base = rng.getrandbits(64)
    free = rng.sample(range(64), 14)
    fps = {base ^ sum(1 << b for b in rng.sample(free, rng.randint(0, 8))) for _ in range(3000)} | {rng.getrandbits(64) for _ in range(500)}
    rows = [(i, x) for i, x in enumerate(sorted(fps))]
    d = spark.createDataFrame([(simhash.signed(x),) for _, x in rows], "fp long")
    edges = simhash.links(d)
    assert edges.count() < 20 * len(rows)
    found = {r["node"]: r["root"] for r in simhash.components(edges).collect()}
    want = slow_components(rows)
    groups = {}
    for (i, x), w in zip(rows, want):
        groups.setdefault(found.get(simhash.signed(x), simhash.signed(x)), set()).add(w)
    assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(want))


def test_variants_meet(spark):
    """Any two fingerprints at 4 bits or fewer share a variant, and each pair is canonical for one only."""
    rng = random.Random(6)
    pairs = []
    for _ in range(300):
        a = rng.getrandbits(64)
        pairs.append((a, a ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))))
    flat = sorted({simhash.signed(x) for p in pairs for x in p})
    keys = {}
    for r in simhash.variants(spark.createDataFrame([(x,) for x in flat], "fp long")).collect():
        keys.setdefault(r["fp"], set()).add(r["key"])
    for a, b in pairs:
        both = sorted(keys[simhash.signed(a)] & keys[simhash.signed(b)])
        assert both
        one = simhash._canonical(np.array(both) << simhash.SPLIT, np.full(len(both), a, np.uint64), np.full(len(both), b, np.uint64))
        assert one.sum() == 1


def test_nearest(spark):
    rng = np.random.default_rng(1)
    m = rng.standard_normal((1500, 12)).astype(np.float32)
    m[100:140] = m[100]  # one class of copies
    rows = [(i, [float(x) for x in v], "s") for i, v in enumerate(m)]
    bad = [(5000, None, None), (5050, [0.0] * 12, None), (5100, [float("nan")] + [1.0] * 11, None), (5150, [None] + [1.0] * 11, None), (5200, [float("inf")] + [1.0] * 11, None), (None, rows[0][1], None), (rows[3][0], rows[3][1], "repeat")]
    d = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, score string")
    got = {}
    for r in ann.nearest(d, F.col("vec_id") % 50 == 0).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 1500, 50))
    e = m.astype(np.float64)
    hits = 0
    for q, found in got.items():
        s = (e * e[q]).sum(axis=1) / np.sqrt((e * e).sum(axis=1)) / np.sqrt((e[q] * e[q]).sum())
        s[q] = -9
        best = np.lexsort((np.arange(1500), -s))[:5]
        found.sort()
        assert [x[0] for x in found] == [1, 2, 3, 4, 5] and all(abs(x[2] - s[x[1]]) < 1e-12 for x in found)
        hits += len({x[1] for x in found} & set(best.tolist()))
    assert hits / (5 * len(got)) >= 0.9
    assert [x[1] for x in got[100]] == [101, 102, 103, 104, 105]
    tiny = ann.nearest(d.where("vec_id < 3"), F.col("vec_id") == 0).collect()
    assert [r["rank"] for r in sorted(tiny, key=lambda r: r["rank"])] == [1, 2]
    assert ann.nearest(d.limit(0), F.lit(True)).count() == 0 and ann.nearest(d.where("vec_id = 5000"), F.lit(True)).count() == 0


def test_nearest_any_scale_and_length(spark):
    """Vectors of the smallest and largest doubles take part; each length is searched among its own."""
    rng = np.random.default_rng(6)
    m = rng.standard_normal((300, 8))
    scale = np.ones(300)
    scale[1::6], scale[2::6], scale[3::6] = 1e-200, 1e200, 1e-300
    other = rng.standard_normal((70, 3))
    rows = [(i, (v * z).tolist()) for i, (v, z) in enumerate(zip(m, scale))] + [(1000 + i, v.tolist()) for i, v in enumerate(other)] + [(5000, [5.0])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(d, F.col("vec_id") % 10 == 0).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert set(got) == {*range(0, 300, 10), *range(1000, 1070, 10)}
    for base, e in ((0, m), (1000, other)):
        u = e / np.linalg.norm(e, axis=1, keepdims=True)
        for q in range(0, len(e), 10):
            s = u @ u[q]
            s[q] = -9
            best = np.argsort(-s)[:5]
            assert [x for x, _ in got[base + q]] == (best + base).tolist() and np.allclose([x for _, x in got[base + q]], s[best], atol=1e-12)


def test_budget_follows_the_data():
    """On clusters a few leaves are enough, without structure many are needed; either number is measured."""
    rng = np.random.default_rng(7)
    centres = rng.standard_normal((400, 32))
    clustered = ann._unit(np.repeat(centres, 10, axis=0) + 0.05 * rng.standard_normal((4000, 32)))
    loose = ann._unit(rng.standard_normal((4000, 32)))
    tight, wide = (ann.budget(x, 4000, ann.TREES, 6, 5) / (4000 / 64) for x in (clustered, loose))
    assert tight < 8 and wide > 40 and ann.budget(loose[:50], 50, ann.TREES, 1, 5) == 50 * ann.TREES


def test_queries_of_a_leaf_are_dealt(spark, monkeypatch):
    """Results don't depend on how a leaf's queries and rows are dealt over tasks."""
    rng = np.random.default_rng(8)
    d = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.standard_normal((400, 6)))], "vec_id long, embedding array<double>")
    want = sorted(map(tuple, ann.nearest(d, F.col("vec_id") % 3 == 0).collect()))
    monkeypatch.setattr(ann, "BLOCK", 7)
    monkeypatch.setattr(ann, "SLICE", 30)
    assert sorted(map(tuple, ann.nearest(d, F.col("vec_id") % 3 == 0).collect())) == want


def tones(rng, n):
    t = np.arange(2048) / audio.RATE
    return np.concatenate([0.4 * np.sin(2 * np.pi * 220 * 2 ** (rng.integers(0, 24) / 12) * t) for _ in range(n)])


def test_audio_alignment():
    rng = np.random.default_rng(2)
    x = tones(rng, 80)
    whole = audio.fingerprint(x)
    part = audio.fingerprint(x[audio.HOP * 20 : audio.HOP * 75] + rng.normal(0, 0.01, audio.HOP * 55))
    off, votes, wrong = audio.align(whole, part)
    assert off == 20 and votes > 10 and wrong < 0.05
    other = audio.align(whole, audio.fingerprint(tones(rng, 80)))
    assert other is None or other[2] > 0.15
    assert audio.align(whole, whole)[0] == 0 and audio.align(whole, whole)[2] == 0.0
    assert len(audio.fingerprint(np.zeros(1000))) == 0 == len(audio.fingerprint(np.empty(0)))


@pytest.mark.parametrize("expand", [1 << 20, 7])
def test_votes_brute_force(monkeypatch, expand):
    """Votes by expansion and by correlation are those of all pairs."""
    from collections import Counter

    monkeypatch.setattr(audio, "EXPAND", expand)
    rng = np.random.default_rng(4)
    for a_len, b_len, kinds in ((40, 70, 5), (300, 200, 2), (600, 900, 1), (5, 3, 50), (1, 400, 1)):
        a, b = (rng.integers(0, kinds, n).astype(np.uint32) * 9 for n in (a_len, b_len))
        a[::7], b[::5] = 1, 2
        want = Counter(i - j for i in range(a_len) for j in range(b_len) if a[i] == b[j])
        assert dict(zip(*(x.tolist() for x in audio.votes(a, b)))) == want


def test_steady_tone():
    """An hour of one tone against another is counted without writing out its 800 million pairs, alone and in a block."""
    import time

    a = np.full(29_000, 77, dtype=np.uint32)
    b = np.concatenate([np.arange(100, 600, dtype=np.uint32), a[:28_000]])
    began = time.time()
    assert audio.align(a, b)[1] == 28_000 and audio.align(a, b)[0] == 0
    block = audio._Block([1, 2], [a, np.arange(100, 600, dtype=np.uint32)])
    block.see(9, b)
    assert [x[2:] for x in block.best] == [(9, 0, 1), (9, 0, 1)] and time.time() - began < 5


def test_audio_filters_by_hand():
    """Integral images against plain sums over the picture."""
    x = tones(np.random.default_rng(3), 30)
    picture, codes = audio.chroma(x), audio.fingerprint(x)
    for t in (0, 3, len(codes) - 1):
        code = 0
        for kind, y, h, w, *bounds in audio.FILTERS:
            box = picture[t : t + w, y : y + h]
            one = np.zeros((w, h), bool)
            if kind == 0:
                one[:] = True
            elif kind == 1:
                one[:, h // 2 :] = True
            elif kind == 2:
                one[w // 2 :, :] = True
            elif kind == 3:
                one[: w // 2, h // 2 :] = one[w // 2 :, : h // 2] = True
            elif kind == 4:
                one[:, h // 3 : 2 * (h // 3)] = True
            else:
                one[w // 3 : 2 * (w // 3), :] = True
            v = np.log1p(box[one].sum()) - np.log1p(box[~one].sum())
            level = sum(v >= b for b in bounds)
            code = code << 2 | (0, 1, 3, 2)[level]
        assert code == int(codes[t])


def test_wav():
    x = tones(np.random.default_rng(4), 6)
    assert np.abs(audio.samples(audio.wav(x)) - x).max() < 1e-3
    stereo = np.repeat(x, 2)
    raw = bytearray(audio.wav(stereo))
    raw[22:24] = b"\x02\x00"
    assert np.abs(audio.samples(bytes(raw)) - x).max() < 1e-3
    assert len(audio.samples(audio.wav(x, 22_050))) == -(-len(x) // 2)
    for bad in (None, b"", b"RIFFxxxxWAVE", b"something else entirely"):
        assert len(audio.samples(bad)) == 0


def test_audio_search(spark, tmp_path):
    rng = np.random.default_rng(5)
    v = [rng.normal(0, 0.13, 64).tolist() for _ in range(60)]
    rows = [(i, x) for i, x in enumerate(v)] + [(200, v[3]), (300, v[5][:32] + v[6][32:]), (400, None), (500, []), (600, [float("nan")] * 64), (None, v[3]), (700, v[7])]
    d = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    d.write.parquet(str(tmp_path / "embeddings.parquet"))
    got = op4_chroma_fingerprints(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    prints = {i: audio.fingerprint(audio.samples(audio.tone_row(x))) for i, x in rows}
    by = {r["vec_id"]: r for r in got}
    assert by[200]["class_id"] == 3 == by[3]["class_id"] and by[3]["copies"] == 3 and by[400]["n_codes"] == 0 and by[400]["match_class"] is None
    for q in (0, 200, 300, 700):
        best = (2.0, 0, 0)
        for i in {r["class_id"] for r in got if r["n_codes"]} - {by[q]["class_id"]}:
            if a := audio.align(prints[q], prints[i]):
                best = min(best, (a[2], -a[1], i))
        assert (by[q]["match_class"], by[q]["bit_error"]) == ((best[2], best[0]) if best[0] < 2 else (None, None))
    assert by[300]["match_class"] in (5, 6)
    assert op4_chroma_fingerprints.__name__ and all(r["match_class"] is None for r in got if r["vec_id"] is None or r["vec_id"] % 100)


HTML = """<!DOCTYPE html><html lang="EN"><head><title>A &amp; B</title><style>p{a>b}</style></head><body><!-- c <p>no</p> --><script>var t="</p>";</script>
<h1 data-x="a>b">Head</h1><p>One <b>bold</b>&nbsp;word<br>next</p><a href='/x?a=1&amp;b=2'>link</a><ul><li>i</li></ul><noscript>no</noscript></body></html>"""


def test_plain_text():
    assert warc.plain_text(HTML) == "Head\nOne bold word\nnext\nlink\ni"
    assert warc.plain_text("") == "" and warc.plain_text("a < b & c") == "a < b & c" and warc.plain_text("<script>open") == ""
    assert warc.plain_text("<p>x</p>" * 20_000).count("x") == 20_000


def parsed(payload):
    """Text, title, language and links by the standard library's parser."""
    from html.parser import HTMLParser

    class P(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.out, self.links, self.title, self.lang, self.hidden, self.raw, self.said = [], [], None, None, None, None, []

        def handle_starttag(self, tag, attrs):
            attrs = {k: v for k, v in reversed(attrs)}
            if self.hidden == "head" and tag == "body":
                self.hidden = None
            if tag == "a" and "href" in attrs:
                self.links.append(attrs["href"] or "")
            if tag == "html" and self.lang is None and attrs.get("lang"):
                self.lang = attrs["lang"].strip().lower()
            if tag in ("script", "style", "title"):
                self.raw, self.said = tag, []
            elif self.hidden is None and tag in warc.HIDDEN:
                self.hidden = tag
            if self.hidden is None and (tag in warc.BLOCKS or tag in warc.RAW):
                self.out.append("\n")

        def handle_startendtag(self, tag, attrs):
            self.handle_starttag(tag, attrs)

        def handle_endtag(self, tag):
            if tag == self.raw:
                if tag == "title" and self.title is None:
                    self.title = " ".join("".join(self.said).split())
                self.raw = None
            if tag == self.hidden:
                self.hidden = None
            elif self.hidden is None and tag in warc.BLOCKS:
                self.out.append("\n")

        def handle_data(self, data):
            if self.raw:
                self.said.append(data)
            elif self.hidden is None:
                self.out.append(data.replace("\n", " ").replace("\r", " "))

    p = P()
    p.feed(payload)
    p.close()
    return "\n".join(x for line in "".join(p.out).split("\n") if (x := " ".join(line.split()))), p.title, p.lang, p.links


def test_scan_equals_a_parser():
    import random

    rng = random.Random(8)
    pieces = ["word", " two words ", "&amp;", "a &lt; b", "<p>", "</p>", "<br/>", "<b class=x>", "</b>", "<a href='/one?a=1&amp;b=2'>", '<a title="x>y" href="/two">', "<a href=/three>", "<a name=n>", "</a>", "<!-- <p>note</p> -->", "<script>if (a < b) { '<p>' }</script>", "<style>p > a {}</style>", "<template><p>no</p></template>", "<noscript>no <a href=n></a></noscript>", "<title>T &amp; t</title>", "\n", "\r\n", "é", "1 < 2", "<H1 data-x=\"a'b\">", "</H1 >", "<td\tid = 'q'>", "<input disabled value=>", "<!DOCTYPE html>", "<li>"]
    for _ in range(1500):
        body = "".join(rng.choice(pieces) for _ in range(rng.randint(0, 25)))
        page = f'<html lang="{rng.choice(["en", "DE"])}"><head><title>Name</title><meta charset=utf-8></head><body>{body}</body></html>' if rng.random() < 0.5 else body
        got = warc.scan(page)
        assert (got.text, got.title, got.language, got.links) == parsed(page), page


def test_scan_is_linear():
    """Markup that never ends, and every other repetition, costs time in proportion to the payload."""
    import time

    for one in ("<a", "<html ", "<title>", "<a ", "<a href=\"", "<a href='x", "<!--", "<!", "</p", "<script>", "<a b='>", "<p \"'", "<template>", "&lt", "< ", "<a =\"' ="):
        payload = one * ((1 << 20) // len(one))
        began = time.time()
        warc.scan(payload)
        assert time.time() - began < 3, one


def test_record_of_a_ragged_id():
    rows = warc.derive("<urn:1>\r\nX: y", "u", "2024-01-01T00:00:00Z", None, None)
    assert all("X" not in warc.parse(r[9])[0] and r[3] == "<urn:1>%20X:%20y" for r in rows)


def test_records():
    meta, text = warc.derive("<urn:1>", "http://a/b c\r\nX: y", "2024-01-01T00:00:00Z", "HTTP/1.1 200 OK\r\nServer: s", HTML)
    for row in (meta, text):
        headers, block = warc.parse(row[9])
        assert headers["WARC-Refers-To"] == "<urn:1>" and headers["WARC-Type"] == row[1] and block.decode() == row[8]
        assert headers["WARC-Block-Digest"] == warc.digest(block) == row[6] and int(headers["Content-Length"]) == len(block) == row[7]
        assert headers["WARC-Source-Payload-Digest"] == warc.digest(HTML.encode()) and "X" not in headers
        uuid.UUID(row[2].removeprefix("<urn:uuid:").removesuffix(">"))
    assert warc.parse(meta[9])[0]["WARC-Concurrent-To"] == text[2] and warc.parse(text[9])[0]["WARC-Concurrent-To"] == meta[2]
    import json

    said = json.loads(meta[8])
    assert said["title"] == "A & B" and said["language"] == "en" and said["outlinks"] == ["/x?a=1&b=2"] and said["source-http-headers"] == ["HTTP/1.1 200 OK", "Server: s"]
    assert warc.digest(b"") == "sha1:3I42H3S6NNFQ2MSVX7XZKYAYSCX5QBYJ"


def test_derivatives(spark):
    rows = [(1, "http://a", HTML, "x"), (2, None, None, None), (None, "http://b", "", None), (1, "http://a", HTML, "x"), (3, "http://c", "<p>w</p>" * 50_000, None)]
    d = spark.createDataFrame(rows, "page_id long, url string, html string, record_id string")
    got = warc.derivatives(d, F.col("page_id").cast("string"), F.col("url"), F.col("html"), keep=["page_id"]).collect()
    assert len(got) == 10 and {r["warc_type"] for r in got} == {"metadata", "conversion"}
    assert len({r["record_id"] for r in got if r["page_id"] == 1}) == 2 and all(r["refers_to"] for r in got)
    assert warc.derivatives(d.limit(0), F.col("page_id"), F.col("url"), F.col("html")).count() == 0


def test_pipeline(spark, tmp_path):
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(3)
    words = ["".join(rng.choice("lmnrst") + rng.choice("aeiou") for _ in range(3)) for _ in range(300)]
    docs, labels = [], []
    for i in range(240):
        own = [rng.choice(words) for _ in range(80)]
        bad, toxic = i % 6 == 1, i % 6 == 2
        if bad:
            own = [w + "###" for w in own]
        if toxic:
            own[3] = own[40] = "vilegob"
        docs.append((i, " ".join(own), "en", f"s{i % 4}", 0))
        labels.append((i, int(not bad), int(toxic)))
    docs += [(1000 + i, docs[0][1], "en", "s0", 0) for i in range(30)] + [(2000, None, None, None, None), (2001, "", "en", "s1", 0)]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for k, (name, stage) in enumerate(pipeline.STAGES):
        out = stage(spark, d, str(tmp_path))
        assert k == len(pipeline.STAGES) - 1 or out.columns == d.columns
        out.write.parquet(str(tmp_path / f"out{k}"))
        d = spark.read.parquet(str(tmp_path / f"out{k}"))
        seen.append(sorted(r["doc_id"] for r in d.select("doc_id").collect()))
    good = [i for i in range(240) if i % 6 != 1]
    assert [i for i in seen[0] if i < 240] == good
    assert [i for i in seen[1] if i < 240] == [i for i in good if i % 6 != 2]
    assert [i for i in seen[2] if i < 1000] == [i for i in good if i % 6 != 2] and not any(1000 <= i < 2000 for i in seen[2]) and sum(i >= 2000 for i in seen[2]) == 1
    assert seen[3] == seen[4] and set(seen[3]) <= set(seen[2]) and d.where("NOT decodes").count() == 0
    assert pipeline.run(spark, str(tmp_path)).count() == d.count()


def test_pipeline_near_copies(spark):
    """Near copies at a 5-word Jaccard of 0.8 or more leave one document, wherever their SimHash bits lie; others stay."""
    pipeline = pytest.importorskip("corpus_pipeline")
    rng = random.Random(8)
    words = ["".join(rng.choice("lmnrst") + rng.choice("aeiou") for _ in range(3)) for _ in range(900)]
    docs = []
    for i in range(40):
        own = [rng.choice(words) for _ in range(rng.choice((3, 60, 100, 400)))]
        docs.append((100 * i, " ".join(own)))
        for k in range(1, 6):
            near = list(own)
            for _ in range(max(1, len(own) * k // 200)):
                near[rng.randrange(len(near))] = rng.choice(words)
            docs.append((100 * i + k, " ".join(near).upper() if k == 3 else " ".join(near)))
    docs += [(9000, None), (9001, ""), (9002, " \n")]

    def shingles(text):
        w = (text or "").lower().split()
        return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()

    sets, up = {i: shingles(t) for i, t in docs}, {i: i for i, _ in docs}
    apart = 0
    for i, a in sets.items():
        for j, b in sets.items():
            if i < j and (a == b or 5 * len(a & b) >= 4 * len(a | b)):
                low, high = sorted((up[i], up[j]))
                up = {x: low if r == high else r for x, r in up.items()}
                apart += (simhash.fingerprint(dict(docs)[i]) ^ simhash.fingerprint(dict(docs)[j])).bit_count() > simhash.MOST
    d = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in docs], "doc_id long, text string, lang string, source string, n_chars long")
    kept = sorted(r["doc_id"] for r in pipeline.near_duplicate_stage(spark, d, "").collect())
    assert kept == sorted(set(up.values())) and apart > 20 and len(set(up.values())) < len(docs) - 50
    assert pipeline.near_duplicate_stage(spark, d.limit(0), "").count() == 0


@pytest.mark.parametrize("segment", range(4))
def test_wide_links_brute_force(spark, segment):
    """Fingerprints that share a segment, with links of 1 to 7 bits anywhere, whole and split groups: no link is lost."""
    rng = random.Random(segment)
    first, width = simhash.WIDE_SEGMENTS[segment]
    assert [b for at, n in simhash.WIDE_SEGMENTS for b in range(at, at + n)] == list(range(64)) and [b for at, n in simhash.WIDE_PIECES for b in range(at, at + n)] == list(range(64 - width))
    mask = (1 << width) - 1 << first
    common = rng.getrandbits(64) & mask
    fps = {rng.getrandbits(64) & ~mask | common for _ in range(600)} | {0, (1 << 64) - 1}
    for x in rng.sample(sorted(fps), 200):
        fps.add(x ^ sum(1 << b for b in rng.sample(range(64), rng.randint(1, simhash.WIDE))))
    fps = sorted(fps)
    d = spark.createDataFrame([(simhash.signed(x),) for x in fps], "fp long")
    up = list(range(len(fps)))
    for i, a in enumerate(fps):
        for j in range(i):
            if (a ^ fps[j]).bit_count() <= simhash.WIDE and up[i] != up[j]:
                low, high = sorted((up[i], up[j]))
                up = [low if x == high else x for x in up]
    for hot in (0, simhash.HOT):
        found = {r["node"]: r["root"] for r in simhash.components(simhash.links(d, simhash.WIDE, hot, simhash.WIDE_SEGMENTS, simhash.WIDE_PIECES)).collect()}
        groups = {}
        for x, w in zip(fps, up):
            groups.setdefault(found.get(simhash.signed(x), simhash.signed(x)), set()).add(w)
        assert all(len(g) == 1 for g in groups.values()) and len(groups) == len(set(up))
    with pytest.raises(ValueError):
        simhash.links(d, simhash.WIDE)


def test_near_copies_by_fingerprint(spark, monkeypatch):
    """The pipeline's near copies come from SimHash links first: they are found without any MinHash band, and checked."""
    monkeypatch.setattr(simhash, "bands", lambda s: [])
    rng = random.Random(4)
    words = ["".join(rng.choice("lmnrst") + rng.choice("aeiou") for _ in range(3)) for _ in range(900)]
    docs = []
    for i in range(30):
        own = [rng.choice(words) for _ in range(200)]
        one = own[:100] + ["other"] + own[101:]
        turned = " ".join(own[100:] + own[:100]).split()  # near by fingerprint and by shingles
        half = [w if k % 12 else "other" for k, w in enumerate(own)]  # its shingles are too few alike
        docs += [(10 * i + k, " ".join(t)) for k, t in enumerate((own, one, turned, half))]
    sets = {i: simhash.shingle_set(t) for i, t in docs}
    sims = {i: simhash.fingerprint(t, simhash.WIDE_SHINGLE) for i, t in docs}
    want = {(i, j) for i in sets for j in sets if i < j and (sims[i] ^ sims[j]).bit_count() <= simhash.WIDE and simhash.similar(sets[i], sets[j])}
    assert len(want) > 50 and not any(simhash.similar(sets[i], sets[i + 3]) for i in sets if i % 10 == 0)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    root = {r["doc_id"]: r["root"] for r in simhash.near_copies(d).collect()}
    linked = sum(root[i] == root[j] for i, j in want)
    assert linked > 0.9 * len(want)  # a link by way of a third text that isn't similar to both is left to the bands
    assert all(root[i] != root[j] for i in root for j in root if i // 10 != j // 10) and all(root[i] != root[i + 3] for i in root if i % 10 == 0)
