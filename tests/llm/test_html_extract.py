import random

import numpy as np

from tradewatch.llm import html_extract as h


def text(page):
    found = h.blocks(page)
    best = max((z for z, _ in found), default=0)
    return [t for z, t in found if z == best and z]


def test_zones():
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
    <nav><ul><li><a href="/">Home</a></ul></nav><div class="cookie-notice">We use cookies</div>
    <main><article><header><h1>Real &amp; title</h1></header><p>One <b>bold
      word</b> &lt;tag&gt;&nbsp;x<br>after</p><script>var t = "</p>";</script><div class="ad">Buy</div><p>Two<ul><li>a<li>b</ul>
    <form><p>Name</p><input></form><section id="comments"><p>First!</p></section><footer>by me</footer></article>
    <aside>Other</aside></main><footer>&copy; me</footer></body></html>"""
    assert text(page) == ["Real & title", "One bold word <tag> x after", "Two", "a", "b"]


def test_odd_markup():
    assert text("<article><p>a<p>b<div>c</div>d</article>") == ["a", "b", "c", "d"]
    assert text("<article><p>open <b>bold<br><p>next &amp;amp; 1 < 2 <") == ["open bold", "next &amp; 1 < 2 <"]
    assert text("<article><p>cut<!-- never closed <p>x") == ["cut"]
    assert text("<article><p>cut</p><a href='x") == ["cut"]
    assert text("<article><script>never closed <p>x") == []
    assert text("") == [] and text("just text") == ["just text"]
    assert text('<div class="post-content"><p>p</p></div><p>rest</p>') == ["p"]
    assert text('<article><p title="a > b">ok</p><p hidden>no</p><div role="alert">no</div></article>') == ["ok"]


def test_suffix_classes_match_sorting():
    rng = np.random.default_rng(0)
    for _ in range(30):
        s = rng.integers(0, 3, rng.integers(1, 60))
        k = int(rng.integers(1, 9))
        order, label = h.suffix_classes(s, k)
        keys = [tuple(s[i:i + k]) for i in range(len(s))]
        assert [keys[i] for i in order] == sorted(keys)
        assert all((keys[a] == keys[b]) == (x == y) for a, b, x, y in zip(order, order[1:], label, label[1:]))


def test_repeated_runs_match_plain_counting(spark, monkeypatch):
    random.seed(1)
    rows, plain = [], {}
    for i in range(60):
        host = f"h{i % 3}.example"
        words = [random.choice("ab") for _ in range(random.randint(0, 40))]
        tokens = h.token_hashes(" ".join(words))
        rows.append((host, bytearray(tokens.tobytes()), i, len(words)))
        for r in set(h.run_hashes(tokens).tolist()):
            plain.setdefault((host, r), set()).add(tokens.tobytes())
    df = spark.createDataFrame(rows, "host string, tokens binary, sign long, n long")
    monkeypatch.setattr(h, "CHUNK_TOKENS", 100)                     # several chunks a host
    got = {(r.host, r.run) for r in h.repeated_runs(df).collect()}
    assert got == {k for k, v in plain.items() if len(v) >= h.PAGES}


def test_boilerplate_without_markup_goes(spark):
    random.seed(2)
    say = lambda n: " ".join(random.choice("abcdefghij") + str(random.randint(0, 99)) for _ in range(n))
    bar, foot = say(12), say(15)
    own = [say(40) for _ in range(8)]
    pages = [(i, "http://Site.example:80/p", f"<div>{bar}</div><p>{t}</p><p>{foot}</p>") for i, t in enumerate(own)]
    pages += [(100 + i, "http://copy.example/", f"<p>{own[0]}</p>") for i in range(5)]        # copies of one page
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in h.extract(df).collect()}
    assert got == {i: t for i, t in enumerate(own)} | {100 + i: own[0] for i in range(5)}


def test_edge_cases(spark):
    rows = [(1, "http://a/b", "<article><p>x y</p></article>", "clash"), (1, "http://a/b", "<article><p>x y</p></article>", "clash"),
            (None, None, None, None), (2, "no host", "", ""), (3, None, "<nav>menu</nav>", ""), (4, "http://a", "<p>" + "z " * 300_000, "")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((str(r.page_id), r.url, r.text[:5], r.n_chars) for r in h.extract(df).collect())
    assert got == sorted([("1", "http://a/b", "x y", 3), ("1", "http://a/b", "x y", 3), ("None", None, "", 0), ("2", "no host", "", 0),
                          ("3", None, "", 0), ("4", "http://a", "z z z", 599_999)], key=lambda r: (r[0], r[1], r[2], r[3]))
    assert h.extract(df.limit(0)).count() == 0


def test_hosts():
    assert h.host_of("https://u:p@WWW.Ex.org:8080/x?y#z") == "www.ex.org"
    assert h.host_of("//cdn.ex/x") == "cdn.ex" and h.host_of("x/y") == "" and h.host_of(None) == ""


def test_class_words_of_containers_keep_the_page():
    for tag in ("<body class='home has-sidebar'>", "<body class='search'>", "<main class='search-results'>",
                "<div id='page' class='fixed-header'>", "<article class='post comments-open'>", "<article class='widget'>"):
        assert text(f"<html class='no-search'>{tag}<p>kept</p><div class='sidebar'>gone</div>") == ["kept"], tag
    for tag in ("div class='site-footer'", "div class='adBanner x'", "ul id='nav-list'", "div class='widget'"):
        assert text(f"<p>kept</p><{tag}><p>gone <nav>menu</nav></p>") == ["kept"], tag


def test_a_page_of_doubtful_blocks_alone_is_decided_by_its_host(spark):
    random.seed(4)
    say = lambda n: " ".join(random.choice("abcdefghij") + str(random.randint(0, 99)) for _ in range(n))
    bar, own = say(12), [say(40) for _ in range(6)]
    pages = [(i, "http://s/p", f"<nav>menu</nav><div class='widget'><p>{bar}</p><p>{t}</p></div>") for i, t in enumerate(own)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    assert {r.page_id: r.text for r in h.extract(df).collect()} == dict(enumerate(own))


def test_copies_of_a_page_do_not_meet_in_a_chunk(spark, monkeypatch):
    own = [h.token_hashes(" ".join(f"w{i}x{k}" for k in range(30))) for i in range(20)]
    rows = [("a", bytearray(t.tobytes()), i, 30) for i, t in enumerate(own)] + [("a", bytearray(own[0].tobytes()), 0, 30)] * 500
    df = spark.createDataFrame(rows, "host string, tokens binary, sign long, n long")
    seen, real = [], h.written

    def spy(frame, name):
        out = real(frame, name)
        seen.append((name, out.count(), out.agg({"n": "sum"}).first()[0]))
        return out

    monkeypatch.setattr(h, "written", spy)
    assert h.repeated_runs(df).count() == 0
    assert seen == [("streams", 20, 600)]


CHROME = ("post-comments user-comments comment-thread commentlist entry-comments sidebar-left main-nav breadcrumb-trail "
          "ad-banner-top related-posts post-footer article-sidebar").split()


def test_compound_names_of_page_furniture():
    for name in CHROME:
        gone = f"<div class='{name}'><p>gone</p></div>"
        assert text(f"<article><p>kept</p>{gone}</article>") == ["kept"], name
        assert text(f"<p>kept</p>{gone}") == ["kept"], name
        assert text(f"<div id='content'><p>kept</p>{gone}</div>") == ["kept"], name
    for name in ("post-header", "entry-content", "post", "story-body", "text-center", "article-wrapper"):
        assert text(f"<article><div class='{name}'><p>kept</p></div><p>too</p></article>") == ["kept", "too"], name
    assert text("<div class='post-meta'>a</div><div class='text-center'>b</div>") == ["a", "b"]


def test_repeated_blocks_of_a_main_part_go(spark):
    random.seed(7)
    say = lambda n: " ".join(random.choice("abcdefghij") + str(random.randint(0, 99)) for _ in range(n))
    bar, own = say(14), [say(40) for _ in range(9)]
    pages = [(i, f"http://{'ab'[i % 2]}/p", f"<main><p>{bar}</p><p>{t}</p></main>") for i, t in enumerate(own)]
    pages += [(50, "http://a/p", f"<article><p>{bar}</p><p>{own[0]}</p></article>")]      # articles keep theirs
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in h.extract(df).collect()}
    assert got == dict(enumerate(own)) | {50: f"{bar}\n{own[0]}"}


def test_whole_result_matches_a_plain_pass(spark):
    """Blocks of all hosts' pages, their runs counted page by page in plain Python."""
    rng = random.Random(11)
    say = lambda n: " ".join(rng.choice("abcdefghij") + str(rng.randint(0, 60)) for _ in range(n))
    shared = [say(rng.randint(6, 20)) for _ in range(6)]
    rows = []
    for i in range(80):
        around = rng.choice(["<main>{}</main>", "{}", "<article>{}</article>", "<div class='widget'>{}</div>", "<nav>{}</nav>"])
        parts = [f"<p>{rng.choice(shared) if rng.random() < .5 else say(rng.randint(1, 25))}</p>" for _ in range(rng.randint(0, 5))]
        rows.append((i, f"http://h{i % 4}/x", around.format("".join(parts))))
    rows += [(100 + k, *rows[k % 3][1:]) for k in range(30)]                               # copies count once
    on = {}
    for _, url, page in rows:
        words = " ".join(t for _, t in h.blocks(page)).split()
        for a in range(len(words) - h.RUN + 1):
            on.setdefault((url, *words[a:a + h.RUN]), set()).add(tuple(words))
    plain = {}
    for i, url, page in rows:
        found = h.blocks(page)
        words = " ".join(t for _, t in found).split()
        hit = set()
        for a in range(len(words) - h.RUN + 1):
            if len(on[url, *words[a:a + h.RUN]]) >= h.PAGES:
                hit.update(range(a, a + h.RUN))
        best, at, inside, unique = h.best_zone([z for z, _ in found]), 0, [], []
        for zone, t in found:
            n = len(t.split())
            if zone == best != h.OUT:
                inside.append(t)
                if best == h.ARTICLE or len(hit & set(range(at, at + n))) < h.COVERED * n:
                    unique.append(t)
            at += n
        plain[i] = "\n".join(unique or inside)
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in h.extract(df).collect()}
    assert got == plain
    assert any("\n".join(t for _, t in h.blocks(p)) != plain[i] for i, _, p in rows)


def test_trimmed_streams_keep_the_runs_asked_for():
    rng = np.random.default_rng(9)
    for n in (0, 5, 8, 60):
        tokens = rng.integers(1, 1 << 32, n).astype(np.uint32)
        runs = h.run_hashes(tokens)
        asked = rng.random(len(runs)) < 0.1
        got = h.trimmed(tokens, asked)
        assert set(runs[asked].tolist()) <= set(h.run_hashes(got).tolist()) and len(got) <= n
        assert not len(h.trimmed(tokens, np.zeros(len(runs), bool)))
