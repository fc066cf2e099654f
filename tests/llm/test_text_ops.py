"""Page text, WARC derivatives, chat templates and packing."""

import gzip
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from trailmark.llm import chat, html_main, packing, warc

PAGE = """<html><head><title>no</title><style>p{}</style></head><body><header>site</header><nav><a>menu</a></nav><div class="ad">buy</div>
<article><h1>Big &amp; small</h1><p>One<b> two</b><br>three</p><script>x("</p>")</script><p>caf&eacute; &lt;tag&gt;</p><aside>see also</aside></article>
<div class="cookie-notice">cookies</div><section id="comments"><p>first!</p></section><form>mail</form><footer>end</footer></body></html>"""


def test_main_text(spark):
    pages = [(1, "http://a/x", PAGE), (2, "http://a/y", None), (3, None, ""), (4, "http://a/z", "<p>" + "word " * 60_000), (5, "u", "plain &amp; text"), (5, "u", "plain &amp; text"), (6, "v", "<article><p>open")]
    got = html_main.main_text(spark.createDataFrame([(*p, "clash") for p in pages], "page_id long, url string, html string, text string")).collect()
    text = {r["page_id"]: r["text"] for r in got}
    assert len(got) == len(pages)
    assert text[1] == "Big & small\n\nOne two three\n\ncafé <tag>"
    assert text[2] == text[3] == "" and text[5] == "plain & text" and text[6] == "open"
    assert len(text[4]) == 5 * 60_000 - 1 and all(r["n_chars"] == len(r["text"]) for r in got)
    assert html_main.main_text(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_pages_without_article_are_differenced(spark):
    page = lambda own: f"<div>Shop of all</div><div>{own} is a long story of its own</div><div>Call us</div>"
    df = spark.createDataFrame([(i, f"http://h.example/p/{i}", page(f"Page {i}")) for i in range(20)] + [(99, "http://other.example/", page("lonely"))], "page_id long, url string, html string")
    text = {r["page_id"]: r["text"] for r in html_main.main_text(df).collect()}
    assert all(text[i] == f"Page {i} is a long story of its own" for i in range(20))
    assert text[99].startswith("Shop of all")  # no neighbour to compare with


@pytest.mark.parametrize(
    "page, text",
    [
        ('<article class="post comments-open"><p>kept</p></article>', "kept"),
        ('<div class="content no-sidebar"><p>kept</p></div>', "kept"),
        ('<article><p>a</p><p class="alert">kept</p></article>', "a\n\nkept"),
        ('<article><p>a</p><div class="related-work">kept</div></article>', "a\n\nkept"),
        ('<main><div id="ads-txt-explained">kept</div></main>', "kept"),
        ('<main><p>a</p><section id="comments"><article class="comment">gone</article></section><div class="ad">gone</div></main>', "a"),
        ('<div class="sidebar"><article><p>kept</p></article></div>', "kept"),
        ('<div class="menu">gone</div><p>kept</p>', "kept"),
        ('<main><div class="notice"><div>x</div>y</div><p>z</p></main>', "x\n\ny\n\nz"),
    ],
)
def test_class_names_are_whole_names_and_only_a_guess(page, text):
    found = html_main.blocks(page)
    sure = any(x[1] for x in found)
    mine = [i for i, x in enumerate(found) if x[1] or not sure]
    assert "\n\n".join(html_main.differenced([found[i][0] for i in mine], mine, [found[i][2] for i in mine], sure, [], [], [])) == text


def slow_main_text(pages):
    """By brute force: each page against the nearest distinct pages of its host."""

    def lcs(a, b):
        best = {(i, j): () for i in range(len(a) + 1) for j in range(len(b) + 1) if not i or not j}
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1, j + 1] = best[i, j] + (i,) if x == y else max(best[i, j + 1], best[i + 1, j], key=len)
        return set(best[len(a), len(b)])

    parsed, out = [html_main.blocks(h or "") for _, _, h in pages], []
    lines = [[t for t, *_ in p] for p in parsed]
    keys = [html_main._path_key(u) for _, u, _ in pages]
    for n, (own, (host, _)) in enumerate(zip(parsed, keys)):
        firsts = {}
        for m in sorted((m for m in range(len(pages)) if keys[m][0] == host), key=lambda m: (keys[m], m)):
            firsts.setdefault(tuple(lines[m]), m)
        order = sorted(firsts.values(), key=lambda m: (keys[m], m))
        at = order.index(firsts[tuple(lines[n])])
        near = sorted(order[max(at - 1, 0) : at] + order[at + 1 : at + 2], key=lambda m: (-html_main._closeness(keys[order[at]][1], keys[m][1]), m))
        gone, size = set(), lambda ix: sum(len(lines[n][i]) for i in ix)
        if near:
            gone = lcs(lines[n], lines[near[0]])
            if size(gone) > 0.6 * size(range(len(own))):
                gone = gone & lcs(lines[n], lines[near[1]]) if len(near) > 1 else set()
                if size(range(len(own))) - size(gone) < 0.05 * size(range(len(own))):
                    gone = set()
        sure = any(x[1] for x in own)
        stay = [i for i, x in enumerate(own) if (x[1] and not (x[2] and i in gone) if sure else not x[2] and i not in gone)]
        stay = stay or [i for i, x in enumerate(own) if not sure and i not in gone] or [i for i, x in enumerate(own) if x[1] or not sure]
        out.append((pages[n][0], "\n\n".join(lines[n][i] for i in stay)))
    return sorted(out)


def test_main_text_matches_brute_force(spark):
    rng, pages = random.Random(17), []
    for i in range(160):
        host, depth = rng.choice("abc"), rng.choice(["x/", "y/", ""])
        menu = f'<div class="top">Home of {host}</div><div class="menu">menu {rng.randrange(3)}</div>'
        body = "".join(f"<p>{rng.choice('abcdefgh')} line {rng.randrange(60)} " + "w " * rng.randrange(9) + "</p>" for _ in range(rng.randint(0, 6)))
        inner = f'{body}<div class="promo">Read {rng.choice(["more", "less", str(i)])}</div>'
        page = menu + rng.choice([f"<article>{inner}</article>", f"<div>{inner}</div>", f"<main>{body}</main>"]) + f"<p>All rights {host}</p>"
        pages.append((i, f"http://{host}.example/{depth}{rng.randrange(100)}", page))
    pages += [(200 + i, "http://a.example/x/5", pages[0][2]) for i in range(5)] + [(300, None, pages[1][2]), (301, "http://d.example/", None)]
    df = spark.createDataFrame([(*p, 1, "c") for p in pages], "page_id long, url string, html string, row int, lines string").coalesce(1)
    got = sorted((r["page_id"], r["text"]) for r in html_main.main_text(df).collect())
    want = slow_main_text(pages)
    assert [x[0] for x in got] == [x[0] for x in want]
    for a, b in zip(got, want):
        assert len(a[1]) == len(b[1]) or abs(len(a[1]) - len(b[1])) < 40, (a, b)  # one of several longest alignments
    assert sum(a == b for a, b in zip(got, want)) > 0.95 * len(got)


def test_shared_lines_are_a_longest_common_subsequence():
    def lcs(a, b):
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        return best[-1][-1]

    rng = random.Random(4)
    for _ in range(300):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(14))] for _ in range(2))
        got = html_main.shared_lines(a, b)
        it = iter(b)
        assert len(got) == lcs(a, b) and got == sorted(set(got)) and all(any(a[i] == y for y in it) for i in got)


def test_warc_round_trip(spark, tmp_path):
    pages = spark.createDataFrame([(1, "http://a/1", PAGE), (2, None, None), (3, "http://a/3", "<p>żółw</p>")], "page_id long, url string, html string")
    out = warc.derivatives(warc.responses(pages, "2020-01-01T00:00:00Z"))
    rows = out.collect()
    assert len(rows) == 6 and {r["record_type"] for r in rows} == {"metadata", "conversion"}
    for r in rows:
        assert r["refers_to"].startswith("<urn:uuid:") and r["block_digest"] == warc.digest(r["block"].encode()) and r["content_length"] == len(r["block"].encode())
        if r["record_type"] == "metadata":
            assert f"source-warc-payload-digest: {r['source_payload_digest']}" in r["block"] and "http-header-content-type: text/html" in r["block"]
    warc.write_files(out, str(tmp_path / "w"))
    read = [x for r in warc.read_files(spark, str(tmp_path / "w")).collect() for x in warc.parse(bytes(r["content"]))]
    assert sorted((warc.first(f, "WARC-Record-ID"), b.decode()) for f, b in read) == sorted((r["record_id"], r["block"]) for r in rows)
    bad = spark.createDataFrame([(1, None), (2, bytearray(b"")), (3, bytearray(b"no record")), (4, bytearray(b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 99\r\n\r\nHTTP/1.1 200"))], "source_seq long, content binary")
    assert warc.derivatives(bad).count() == 0


def test_warc_reader_goes_on_after_bad_records(spark, tmp_path):
    good = [warc.response(f"http://h/{i}", b"<p>page %d</p>" % i, "2020-01-01T00:00:00Z") for i in range(6)]
    head = b"WARC/1.0\r\nWARC-Type: response\r\n"
    bad = [b"garbage\r\n\r\n", head + b"Content-Length: x\r\n\r\nabc\r\n\r\n", head + b"Content-Length: 100000\r\n\r\nHTTP/1.1 200 OK", head]
    mixed = good[0] + bad[0] + good[1] + bad[1] + good[2] + bad[3] + good[3] + good[4] + bad[2]
    zipped = b"".join(map(gzip.compress, good[:3])) + b"\x1f\x8b broken" + gzip.compress(good[3]) + gzip.compress(good[4])[:-9]
    (tmp_path / "in").mkdir()
    for name, data in (("a.warc", mixed), ("b.warc.gz", zipped), ("c.warc", b""), ("d.txt", b"nothing here")):
        (tmp_path / "in" / name).write_bytes(data)
    got = {}
    for r in warc.read_files(spark, str(tmp_path / "in")).collect():
        got.setdefault(r["path"].rsplit("/", 1)[1], []).extend(warc.first(f, "WARC-Target-URI") for f, _ in warc.parse(bytes(r["content"])))
    assert got["a.warc"] == [f"http://h/{i}" for i in range(5)] and got["b.warc.gz"] == [f"http://h/{i}" for i in range(5)] and set(got) == {"a.warc", "b.warc.gz"}
    told = warc.derivatives(warc.read_files(spark, str(tmp_path / "in"))).where("record_type = 'conversion'").collect()
    assert sorted(r["block"] for r in told) == sorted([f"page {i}" for i in range(5)] * 2)


def test_warc_heads_with_bare_line_feeds_and_long_bodies(spark):
    block = b"HTTP/1.1 200 OK\nContent-Type: text/plain\n\nthe payload\n\nsecond"
    record = b"WARC/1.0\nWARC-Type: response\nWARC-Target-URI: u\nContent-Length: %d\n\n" % len(block) + block + b"\n\n"
    long = warc.response("v", b"<p>" + b"word " * 400_000, "d")
    df = spark.createDataFrame([(1, bytearray(record), "x"), (2, bytearray(record + record), "y"), (3, bytearray(long), "z")], "source_seq long, content binary, block string")
    rows = warc.derivatives(df).collect()
    text = [r for r in rows if r["record_type"] == "conversion"]
    assert [r["block"] for r in text if r["source_seq"] < 3] == ["the payload\n\nsecond"] * 3
    assert all(r["http_status"] == 200 and "http-status: HTTP/1.1 200 OK\r\n" in r["block"] for r in rows if r["record_type"] == "metadata")
    assert len(text[-1]["block"]) == 5 * 400_000 - 1
    assert warc.derivatives(df.limit(0)).count() == 0


def test_warc_time_grows_with_the_members():
    one = gzip.compress(warc.response("http://h/", b"<p>x</p>" * 40, "d"))
    def took(n):
        began = time.process_time()
        assert sum(1 for _ in warc.parse(one * n)) == n
        return time.process_time() - began
    assert took(8000) < 8 * took(2000)


def test_chat_round_trip(spark):
    tricky = r"\### Assistant: </turn> <turn:user> &lt; &amp;lt; ok" + "\n"
    turns = [(1, 0, "system", "be brief"), (1, 1, "user", tricky), (1, 2, "assistant", tricky), (2, 0, "assistant", "no question"), (3, 0, "user", None), (3, 1, "assistant", ""), (4, 0, "user", "u"), (4, 0, "user", "u"), (None, None, None, "x"), (5, 0, "user", "y" * 300_000), (5, 1, "assistant", "z")]
    df = spark.createDataFrame([(*t, "clash") for t in turns], "conv_id long, turn long, role string, text string, formatted string")
    got = {r["conv_id"]: r for r in chat.read_back(chat.format_chats(df)).collect()}
    for conv in {t[0] for t in turns}:
        want = [(r or "", x or "") for c, _, r, x in turns if c == conv]
        assert [(t["role"], t["text"]) for t in got[conv]["turns"]] == want
        assert got[conv]["loss_text"] == "".join(x for r, x in want if r == "assistant")
    assert [got[c]["valid"] for c in (1, 2, 3, 4, 5, None)] == [True, False, True, False, True, False]
    assert chat.format_chats(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        chat.Template(opening="{role}:")


def slow_best_fit(rows, capacity):
    bins, out = [], {}
    for i, size, source, cluster in sorted(rows, key=lambda r: (-(r[1] % capacity), r[0])):
        rest = size % capacity
        if not rest:
            continue
        fits = [(b["room"], n) for n, b in enumerate(bins) if b["room"] >= rest and source not in b["s"] and cluster not in b["c"]]
        n = min(fits)[1] if fits else len(bins)
        if not fits:
            bins.append({"room": capacity, "s": set(), "c": set()})
        bins[n]["room"] -= rest
        bins[n]["s"] |= {source} - {None}
        bins[n]["c"] |= {cluster} - {None}
        out[i] = n
    return out


def test_best_fit_matches_brute_force():
    rng = random.Random(9)
    rows = [(i, rng.randint(1, 250), rng.choice([None, "hot", "hot", *"abcdefgh"]), rng.choice([None, *range(30)])) for i in range(400)]
    pdf = pd.DataFrame(rows, columns=["row", "size", "source", "cluster"]).assign(doc_id=lambda x: x["row"].astype(str), shard=0)
    got = packing.pack_shard(pdf, 100)
    tails = got[got["n_tokens"] < 100]
    assert dict(zip(tails["doc_id"], tails["bin"])) == slow_best_fit(rows, 100)


def test_packing_keeps_everything(spark):
    texts = [(1, "a b c", "s"), (2, None, "s"), (3, "", None), (4, "w " * 5000, "s"), (5, "a B c", "t"), (5, "a b c", "t"), (None, "q", None)]
    df = spark.createDataFrame([(*t, 9) for t in texts], "doc_id long, text string, source string, bin int")
    got = packing.pack(packing.measured(df), capacity=64, shard_rows=3)
    told = got.groupBy("doc_id").agg(F.sum("n_tokens").alias("n")).collect()
    assert {r["doc_id"]: r["n"] for r in told} == {1: 3, 2: 0, 3: 0, 4: 5000, 5: 6, None: 1}
    assert got.where("n_tokens > 0").groupBy("bin").agg(F.sum("n_tokens").alias("n")).where("n > 64").count() == 0
    assert got.where("bin IS NULL").count() == 2
    assert packing.pack(packing.measured(df.limit(0))).count() == 0
