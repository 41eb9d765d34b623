import hashlib
import os
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from adlake.llm import bpe_backtrack as B
from adlake.llm import hilbert_ann as H
from adlake.llm import html_consensus as X
from adlake.llm import mixing_ipf as I
from adlake.llm import pii_feistel as P
from adlake.llm import toxicity_ftrl as T
from adlake.llm.textgrams import chunks
from test_dedup import brute

PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var x="</p>";</script></head><body>
<nav><ul><li><a href="/a">menu</a></ul></nav><div class="ad-7">buy</div><div class="sidebar"><p>side text that is rather long</p></div>
<article class="post-12"><header>head</header><h1>Tit&amp;le</h1><p><b>One  two<br>three<p>A &lt;b&gt; &eacute; &#233;&nbsp;x</p><div class="notice">note</div><ul><li>item<li>last</ul>
<form><p>your name</p></form><!-- hidden --><section class="comments"><p>nice post</p></section></article><footer>&copy; f</footer></body></html>"""
TEXT = "Tit&le\nOne two three\nA <b> é é x\nitem\nlast"


def pages(spark, rows):
    return spark.createDataFrame([(k, *r) for k, r in enumerate(rows)], "page_id long, url string, html string").selectExpr("*", "'z' AS host", "'z' AS paths", "1 AS salt")


def test_extraction(spark):
    cut = PAGE[: PAGE.index("<footer>")]
    rows = [("http://h.example/1", PAGE)] * 4 + [("https://user@H.example:80/2", PAGE), (None, PAGE), ("u", None), ("u", ""), ("u", "plain < text & more"), ("http://h.example/3", cut), ("http://h.example/4", "<div><p>only this</p></div>"), ("u", "<p>" + "w " * 100_000)]
    for hosts in (X.BROADCAST_HOSTS, 0):
        got = {r.page_id: r for r in X.extract_pages(pages(spark, rows), broadcast_hosts=hosts).collect()}
        assert len(got) == len(rows)
        assert {got[k].text for k in (0, 1, 2, 3, 4, 5, 9)} == {TEXT}
        assert got[0].path == "html/body/article.post-"
        assert (got[6].text, got[7].text, got[8].text, got[10].text) == ("", "", "plain < text & more", "only this")
        assert got[11].text == " ".join(["w"] * 100_000)
    assert X.extract_pages(pages(spark, rows).limit(0)).count() == 0


def test_names_that_speak_of_other_parts():
    kept = "<body class='has-sidebar'><div class='page with-sidebar'><article class='post alert'><p>kept text</p></article><div id='cookie-banner'>x</div></div></body>"
    assert X.main_text(kept, [])[0] == "kept text"
    assert X.main_text("<body><main><p>a</p><article class='comment'><p>b</p></article></main></body>", [])[0] == "a"


def test_consensus_beats_a_page_of_its_own(spark):
    """A page whose side block is longer than its article still yields the article, by its host's votes."""
    good = "<body><div class='c1'><p>" + "main words " * 30 + "</p></div><div class='c2x'><p>short</p></div></body>"
    odd = "<body><div class='c1'><p>brief</p></div><div class='c2x'><p>" + "much longer text " * 50 + "</p></div></body>"
    got = X.extract_pages(pages(spark, [("http://a/", good)] * 5 + [("http://a/", odd)])).orderBy("page_id").collect()
    assert got[-1].text == "brief" and got[-1].path.endswith("div.c")


LONG, SHORT = "long words " * 80, "short words " * 16
SPLIT = {
    "parts of an article": f"<article><div class='c-one'><p>{SHORT}</p></div><div class='c-two text'><p>{LONG}</p></div></article>",
    "a long quote": f"<div class='x'><p>{SHORT}</p><blockquote><p>{LONG}</p></blockquote></div>",
    "a long table": f"<div class='x'><p>{SHORT}</p><table><tr><td>{LONG}</td><td>{LONG}</td></tr></table></div>",
    "a quote deep in an article": f"<article><p>{SHORT}</p><div class='a'><div class='b'><blockquote>{LONG}</blockquote></div></div></article>",
}


def test_split_articles_are_read_whole(spark):
    for k, body in enumerate(SPLIT.values()):
        page = f"<body><nav><a href='/'>menu</a></nav>{body}<div class='links'><a href='/'>{SHORT}</a></div></body>"
        (winners,) = [r.paths for r in X.host_winners(pages(spark, [("http://a/", page)] * 3)).collect()]
        for chosen in (winners, []):
            text, _ = X.main_text(page, chosen)
            assert SHORT.strip() in text and text.count(LONG.strip()) == (2 if k == 2 else 1) and "menu" not in text


def test_linked_text_around_the_content_stays_out():
    page = f"<body><div class='wrap'><div class='c'><p>{LONG}</p></div><div class='more'><a href='/'>{SHORT}</a></div></div></body>"
    assert X.main_text(page, [])[0] == LONG.strip()


LOST = {
    "<article><p>one</p><button>go<p>two</p></article><p>rest</p>": "one\ntwo",
    "<article><p>one <button>go</button> more</p><select><option>a<option>b<p>two</p>": "one more\ntwo",
    "<p>a<svg><g><text>z</text></g></svg>b</p><p>c": "ab\nc",
    "<video src=x><p>t</p></video><p>u</p><noscript><p>on</p></noscript><p>v": "t\nu\nv",
    "<ul><li>a<button>b<li>c</ul>d": "a\nc\nd",
    "<p>a<canvas>b<audio>c": "a",
}


def test_open_elements_lose_no_text_behind_them():
    for page, want in LOST.items():
        assert X.main_text(page, [])[0] == want, page


@pytest.mark.parametrize("name", ["share-price", "search", "related", "login-guide"])
def test_a_doubtful_name_drops_no_main_text(name):
    page = f"<body><nav><a href='/'>menu</a></nav><div class='{name}'><p>{LONG}</p></div><p>end</p></body>"
    assert LONG.strip() in X.main_text(page, [])[0]
    # but it does beside a main text, or where its text is linked
    assert X.main_text(f"<body><article><p>{LONG}</p></article><div class='{name}'><p>{LONG} more</p></div></body>", [])[0] == LONG.strip()
    assert "short" not in X.main_text(f"<body><p>end</p><div class='{name}'><a href='/'>{SHORT * 4}</a></div></body>", [])[0]


def prose(seed, n):
    r = random.Random(seed)
    return " ".join(f"p{r.randrange(999)}" for _ in range(n // 5))


@pytest.mark.parametrize("size", [90, 900])
@pytest.mark.parametrize("box", ["article class='promo-story'", "div class='main-footer-fix'", "div class='comments-policy'", "article class='ad-review'", "form id='aspnetForm'", "div class='login-guide'"])
def test_a_page_of_one_doubtful_block_keeps_its_text(box, size):
    tag, text = box.split()[0], prose(size, size)
    page = f"<html><body><nav><a href='/'>menu</a></nav><{box}><header>top</header><div class='row'><p>{text}</p></div><div class='newsletter'><p>your mail</p></div></{tag}><footer>end</footer></body></html>"
    assert X.main_text(page, [])[0] == text
    assert X.main_text(page, ["html/body/div.else"])[0] == text
    # beside an article the block is what its name says
    assert X.main_text(f"<body><article><p>{prose(1, 500)}</p></article><{box}><p>{text}</p></{tag}></body>", [])[0] == prose(1, 500)


HALVES = {
    "two halves": ("<div class='alpha'><p>{}</p></div><div class='beta'><p>{}</p></div>", ["html/body/div.alpha", "html/body/div.beta"]),
    "halves of halves": ("<div class='w'><div class='ra'><div class='alpha'><p>{}</p></div></div><div class='rb'><div class='beta'><p>{}</p></div></div></div>", ["html/body/div.w/div.ra/div.alpha", "html/body/div.w/div.rb/div.beta"]),
}


@pytest.mark.parametrize("kind", HALVES)
def test_an_article_in_two_containers_is_read_whole(spark, kind):
    body, paths = HALVES[kind]
    page = lambda k: "<html><body><nav><a href='/'>menu</a></nav>" + body.format(prose(k, 300), prose(k + 50, 240)) + "<footer>f</footer></body></html>"
    for winners in ([], paths, paths[:1] + ["html/body/div.none"], paths[::-1]):
        assert X.main_text(page(1), winners)[0] == (f"{prose(1, 300)}\n{prose(51, 240)}" if len(winners) != 2 or "none" not in winners[1] else prose(1, 300))
    got = X.extract_pages(pages(spark, [("http://a/", page(k)) for k in range(6)])).orderBy("page_id").collect()
    assert [r.text for r in got] == [f"{prose(k, 300)}\n{prose(k + 50, 240)}" for k in range(6)]


def test_a_short_winner_does_not_hide_a_page_of_its_own():
    page = f"<html><body><div class='teaser'>in short</div><div class='unknown'><p>{prose(3, 600)}</p></div></body></html>"
    assert prose(3, 600) in X.main_text(page, ["html/body/div.teaser"])[0]
    assert X.main_text(page, ["html/body/div.teaser"], ["html/body/div.unknown"])[0] == "in short"


INSIDE = {
    "<p>one <span class='ad'>buy <b>now</b></span> two</p>": "one two",
    "<p>one <span hidden>secret <span>more</span></span>two</p>": "one two",
    "<p>one <em style='display: none'>x</em>two <span class='ad-box'>tell all": "one two",
    "<p>one <span class='ad'>never closed</p><p>two</p>": "one\ntwo",
    "<p>one</p><section id='disqus_thread'><p>reader says</p></section>": "one",
    "<p>one</p><div class='discussion'><p>reader says so, and at length, again and again</p></div>": "one",
    "<p>one</p><div class='notice'><p>long notice of many words, longer than the text</p></div>": "one",
    "<p>one</p><div class='notice-board'><p>long notice of many words, longer than the text</p></div><p>two</p>": "one\ntwo",
    "<p>one</p><form><p>your name, your mail, and your thoughts on this</p></form>": "one",
    "<p>one <span class='highlight'>two</span> <a class='ref' href='/'>three</a></p>": "one two three",
}


@pytest.mark.parametrize("body", INSIDE)
def test_parts_inside_an_article(body):
    assert X.main_text(f"<html><body><article>{body}</article><div class='newsletter'><p>{prose(1, 90)}</p></div></body></html>", [])[0] == INSIDE[body]


def test_hosts_of_several_containers_equal_a_plain_version(spark):
    """Votes, winners and texts of generated hosts, from the known containers of each page."""
    r = random.Random(21)
    rows, boxes_of = [], []
    for k in range(120):
        host = k % 4
        names = {0: ("lead", "body-x", "side-y"), 1: ("alpha", "beta"), 2: ("only",), 3: ("aa", "bb", "cc", "dd")}[host]
        sizes = {0: (200, 900, 60), 1: (300, 240), 2: (500,), 3: (400, 300, 200, 40)}[host]
        here = [(n, prose(r.randrange(10**6), s + r.randrange(40))) for n, s in zip(names, sizes) if r.random() < 0.9] or [(names[0], prose(k, 50))]
        page = "".join(f"<div class='{n}'><p>{t}</p></div><div class='ad'>buy</div>" for n, t in here)
        rows.append((f"http://h{host}.example/{k}", f"<html><body><nav>menu</nav>{page}<aside>x</aside></body></html>"))
        boxes_of.append((host, here))
    votes, count = {}, {}
    for host, here in boxes_of:
        scores = {f"html/body/div.{n}": len(t) * (1.5 if n == "body-x" else 1.0) for n, t in here}
        scores["html/body"] = 0.5 * 0.5 * sum(len(t) for _, t in here)
        for p, x in scores.items():
            votes[host, p] = votes.get((host, p), 0) + x / sum(scores.values())
            count[host, p] = count.get((host, p), 0) + 1
    winners = {}
    for host in range(4):
        mine = sorted((p for h, p in votes if h == host), key=lambda p: (-round(votes[host, p], 6), p))
        mean = {p: votes[host, p] / count[host, p] for p in mine}
        winners[host] = [p for p in mine if 3 * mean[p] >= mean[mine[0]]]
    found = {x.host: list(x.paths) for x in X.host_winners(pages(spark, rows)).collect()}
    assert found == {f"h{h}.example": w for h, w in winners.items()}
    got = {x.page_id: x.text for x in X.extract_pages(pages(spark, rows)).collect()}
    for k, (host, here) in enumerate(boxes_of):
        read = [t for n, t in here if f"html/body/div.{n}" in winners[host]]
        assert got[k] == "\n".join(read or [t for _, t in here]), k


def test_built_pages_are_read_back(spark):
    """Pages built from known blocks, in random order with random boilerplate, broken and whole."""
    r = random.Random(11)
    rows, want = [], []
    for k in range(120):
        text = [" ".join(f"w{r.randrange(99)}" for _ in range(r.randrange(8, 60))) for _ in range(r.randrange(2, 9))]
        kinds = [r.choice(("p", "li", "h2", "quote", "cell")) for _ in text]
        close = r.random() < 0.7
        tags = {"p": "<p>{}" + "</p>" * close, "li": "<ul><li>{}</ul>", "h2": "<h2>{}</h2>", "quote": "<blockquote>{}</blockquote>", "cell": "<table><tr><td>{}</table>"}
        noise = ["<div class='ad-3'>buy now</div>", "<button>more", "<script>if (a < b) { '<p>' }</script>", "<aside><p>other</p></aside>", "<!-- x --><form><input><p>mail</p></form>", "<svg><title>i</title><path d='M0'/></svg>", "", ""]
        body = "".join(tags[kind].format(t.replace(" ", r.choice((" ", "\n", "&nbsp;", "<b> </b>")), 1)) + r.choice(noise) for t, kind in zip(text, kinds))
        box = r.choice(("<article class='post-{}'>{}</article>", "<main><div class='row'>{1}</div></main>", "<div class='page'><div class='content'>{1}</div></div>"))
        rows.append((f"http://h{k % 5}.example/{k}", f"<html><body><header><p>top</p></header>{box.format(k, body)}<footer><p>end</p></footer></body></html>"))
        want.append("\n".join(text))
    got = {x.page_id: x.text for x in X.extract_pages(pages(spark, rows)).collect()}
    assert [got[k] for k in range(120)] == want


def test_raking_in_numpy_equals_frames_and_reports_its_gap(spark, make_docs):
    cells = spark.createDataFrame([(s, l, (k * 37) % 91 + 5) for k, (s, l) in enumerate((s, l) for s in ("a", "b", None) for l in "xyz")], "source string, lang string, tokens long")
    goal = lambda n, d: spark.createDataFrame(list(d.items()), f"{n} string, target double")
    goals = {"source": goal("source", {"a": 0.3, "b": 0.7}), "lang": goal("lang", {"x": 0.5, "y": 0.2, "z": 0.3})}
    a, b = ({(r.source, r.lang): (r.w, r.gap) for r in I.rake(cells.dropna(), goals, local_cells=n).collect()} for n in (100, 0))
    assert a.keys() == b.keys() and all(a[k] == pytest.approx(b[k], abs=1e-12) for k in a) and all(g < 1e-12 for _, g in a.values())
    only = cells.filter("source = 'a' AND lang = 'x' OR source = 'b' AND lang = 'y'")
    for n in (100, 0):
        assert I.rake(only, goals, 5, local_cells=n).first().gap > 0.1
    docs = make_docs(["a b c"] * 3, lang="x")
    with pytest.raises(ValueError, match="differ from their targets"):
        I.mix(docs, F.lit("t"), targets={"source": goal("source", {"s": 0.5, "t": 0.5}), "lang": goal("lang", {"x": 1.0}), "topic": goal("topic", {"t": 1.0})})


def test_mixing_equals_sql_and_meets_targets(spark, make_docs):
    for sf in ("/root/testdata/sf0.001",):
        con = duckdb.connect()
        for n in os.listdir(sf):
            con.sql(f"CREATE VIEW {n.split('.')[0]} AS SELECT * FROM '{sf}/{n}'")
        got, want = I.query(spark, sf).toPandas(), con.sql(I.ORACLE_SQL).df()
        key = lambda d: sorted(map(repr, d[sorted(d.columns)].astype(object).itertuples(index=False, name=None)))
        assert key(got) == key(want)
    cells = spark.createDataFrame([(s, l, t, (k * 37) % 91 + 5) for k, (s, l, t) in enumerate((s, l, t) for s in "ab" for l in "xyz" for t in "pq")], "source string, lang string, topic string, tokens long")
    goals = {n: spark.createDataFrame(list(v.items()), f"{n} string, target double") for n, v in {"source": {"a": 0.3, "b": 0.7}, "lang": {"x": 0.5, "y": 0.2, "z": 0.3}, "topic": {"p": 0.6, "q": 0.4}}.items()}
    raked = I.rake(cells, goals, 12).toPandas()
    for n, g in goals.items():
        assert raked.groupby(n)["w"].sum().to_dict() == pytest.approx({r[0]: r[1] for r in g.collect()}, abs=1e-6)
    odd = I.mix(make_docs([None, "", (None, "a b"), (9, "c " * 50_000), (9, "d")]), I.form_topic(F.col("text")))
    assert odd.count() == 5 and not odd.filter("_kept IS NULL").count()
    assert I.mix(make_docs(["x"]).limit(0), F.lit("t")).count() == 0


def test_hilbert_curve_visits_neighbours():
    for d, bits in ((2, 4), (3, 3)):
        n = 1 << bits
        grid = np.stack(np.meshgrid(*[np.arange(n)] * d, indexing="ij"), -1).reshape(-1, d)
        order = grid[np.argsort(H.hilbert_keys(grid, bits))]
        assert sorted(H.hilbert_keys(grid, bits)) == list(range(n**d))
        assert (np.abs(np.diff(order, axis=0)).sum(axis=1) == 1).all()


def test_search(spark, sample):
    e = spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet")
    asks = F.col("vec_id") % 50 == 0
    found = H.nearest(e, asks)
    assert H.recall(found, e, asks) >= 0.9
    vectors = {r.vec_id: np.array(r.embedding, float) for r in e.collect()}
    for r in found.collect():
        a, b = vectors[r.query_id], vectors[r.vec_id]
        assert r.score == pytest.approx(a @ b / np.linalg.norm(a) / np.linalg.norm(b), abs=1e-12) and r.query_id != r.vec_id
    small = H.nearest(e, asks, block=16)
    assert H.recall(small, e, asks) >= 0.9
    assert found.exceptAll(small).count() == 0


def test_recall_of_the_regime_of_large_tables(spark):
    """Ranges of more rows than a query meets at least: the vectors of sf0.1, and noisy copies of them."""
    e = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet").select("vec_id", "embedding")
    more = e.select((F.col("vec_id") + 100_000).alias("vec_id"), F.transform("embedding", lambda x, k: (x + F.sin(F.col("vec_id") * 31 + k * 17) * 0.9).cast("float")).alias("embedding"))
    e, asks = e.union(more), F.col("vec_id") % 50 == 0
    assert e.count() >= H.BESIDE * H.WINDOWS
    assert H.recall(H.nearest(e, asks), e, asks) >= 0.9


def test_recall_is_alike_at_every_size(spark):
    e, asks = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet"), F.col("vec_id") % 50 == 0
    for n in (60, 500, 1500):
        some = e.filter(F.col("vec_id") < n)
        assert H.recall(H.nearest(some, asks), some, asks) >= 0.9


def test_neighbouring_ranges_hold_enough_rows():
    rows = np.array([[5, 0, 0, 70, 3, 200, 64, 1], [0, 0, 0, 0, 0, 0, 0, 9]])
    first, last = H.neighbours(rows, 64)
    assert first.tolist() == [[0, 0, 0, 0, 3, 3, 5, 6], [0] * 8]
    assert last.tolist() == [[3, 3, 3, 5, 5, 6, 7, 7], [7] * 8]


def test_search_vectors_of_extreme_length(spark):
    rng = np.random.default_rng(0)
    rows = [(k, (v * s).tolist()) for k, (v, s) in enumerate(zip(rng.normal(size=(5, 8)), (1.0, 1e-200, 1e-200, 1e200, 1e-300)))]
    plain = [(k, (np.array(v) / np.abs(v).max()).tolist()) for k, v in rows]
    found = [{r.rank: (r.vec_id, round(r.score, 9)) for r in H.nearest(spark.createDataFrame(x, "vec_id long, embedding array<double>"), F.col("vec_id") == 0, k=3).collect()} for x in (rows, plain)]
    assert len(found[0]) == 3 and found[0] == found[1]


def test_search_odd_vectors(spark):
    one = [1.0, 0.0]
    rows = [(0, one), (1, one), (2, one), (3, [0.0, 1.0]), (4, None), (5, [0.0, 0.0]), (6, [1.0, None]), (7, [1.0, float("nan")]), (8, [float("inf"), 1.0]), (9, [1.0]), (None, one), (50, [1.0, 1.0]), (2, one)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS curve", "2 AS part")
    got = [(r.query_id, r.rank, r.vec_id) for r in H.nearest(df, F.col("vec_id") % 50 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1), (0, 2, 2), (0, 3, 50), (0, 4, 3), (50, 1, 0), (50, 2, 1), (50, 3, 2), (50, 4, 3)]
    assert H.nearest(df.limit(0), F.lit(True)).count() == 0


@pytest.fixture(scope="module")
def tokenizers():
    sentencepiece = pytest.importorskip("sentencepiece")
    return B.Pieces(B.load_model(B.model_path()), cache_size=500), sentencepiece.SentencePieceProcessor(model_file=B.model_path())


def test_encoding_and_decoding_equal_the_library(tokenizers, sample):
    own, library = tokenizers
    r = random.Random(5)
    texts = ["", " ", "  a  b ", "\n", "a\nb\t c", "▁x ▁", "é́😀�\x00z", "<s> x</s><unk>", "ＡＢ ﬁ x\r\n", " " * 70, "a" * 200, "1" * 90, "ab " * 40_000, "x" * 20_000]
    texts += ["".join(r.choice("  \n\tabcdeé▁😀中\x00\"'12.,<>$#ñAI") for _ in range(r.randint(0, 40))) for _ in range(2000)]
    texts += ["".join(own.pieces[r.randrange(259, 32000)] for _ in range(r.randint(1, 8))) for _ in range(2000)]
    texts += [d.text for d in sample("documents").collect()]
    for t in texts:
        ids = library.encode(t)
        assert own.encode(t) == ids
        assert own.decode(ids) == library.decode(ids)
        assert own.digest(t) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
    for _ in range(2000):
        ids = [r.choice((r.randrange(32000), r.randrange(3, 259))) for _ in range(r.randint(0, 10))]
        assert own.decode(ids) == library.decode(ids)


def test_encode_documents(make_docs, tokenizers):
    docs = make_docs([None, "", "a b", (2, "a b")])
    model = B.load_model(B.model_path())
    rows = B.encode_documents(docs, model).collect()
    assert [list(r.ids) for r in rows] == [[], [], tokenizers[1].encode("a b"), tokenizers[1].encode("a b")]
    assert B.digest_documents(docs.limit(0), model).count() == 0


def test_pipeline(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_dedup", "pii", "mixing", "tokens"]
    stage, counts = docs, [docs.count()]
    for name, f in corpus_pipeline.STAGES:
        stage = f(spark, stage, sf).persist()
        counts.append(stage.count())
        if name != "tokens":
            assert stage.columns == docs.columns
    assert counts[0] > counts[1] > counts[2] == counts[3] > counts[4] == counts[5]
    again = corpus_pipeline.run(spark, sf)
    assert sorted(r.doc_id for r in again.collect()) == sorted(r.doc_id for r in stage.collect())
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "x y z", "en", "s", 5), (2, "", "en", "s", 0)], docs.schema)
    for _, f in corpus_pipeline.STAGES[:-1]:
        assert f(spark, odd, sf).columns == docs.columns
        assert f(spark, odd.limit(0), sf).count() == 0


def test_pipeline_stages(spark, tokenizers):
    """Each stage against a plain version on the rows that its predecessor kept."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    rows = lambda df: {r.doc_id: r for r in df.collect()}
    kept = stages["toxicity"](spark, docs, sf).persist()
    weights = T.fit(docs, spark.read.parquet(f"{sf}/labels.parquet"))
    total = lambda t: sum(weights.get(b, 0.0) for b in {int(x) for x in T.features(next(chunks(pa.array([t or ""]), lower=True))[2])[1]}) + weights.get(-1, 0.0)
    before, after = rows(docs), rows(kept)
    assert {i for i, r in before.items() if total(r.text) < 0} == set(after) and all(before[i] == r for i, r in after.items())
    deduped = stages["near_dedup"](spark, kept, sf).persist()
    groups = brute([(i, r.text) for i, r in after.items()], 5)
    assert set(rows(deduped)) == {i for i, (_, c) in groups.items() if i == c}
    masked = stages["pii"](spark, deduped, sf).persist()
    hidden = rows(P.mask_pii(deduped, corpus_pipeline.pii_key(spark)))
    assert {i: (r.text, r.n_chars) for i, r in rows(masked).items()} == {i: (r.text, r.text and len(r.text)) for i, r in hidden.items()}
    mixed = stages["mixing"](spark, masked, sf).persist()
    con, documents = duckdb.connect(), masked.select("doc_id", "text", "lang", "source").toPandas()
    con.register("documents", documents)
    assert set(rows(mixed)) == {r[0] for r in con.sql(f"SELECT doc_id FROM ({I.ORACLE_SQL}) WHERE kept").fetchall()}
    for r in stages["tokens"](spark, mixed, sf).join(mixed.select("doc_id", "text"), "doc_id").collect():
        assert list(r.ids) == tokenizers[1].encode(r.text or "") and r.n_tokens == len(r.ids)
