"""Decontamination, URL filter, HTML extraction, near duplicates, quality
and language ID on small inputs."""

import random
import re
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from gridcast.llm import common, decontaminate, html_extract, langid, near_dup, quality, url_filter

SF = "/root/testdata/sf0.001"


# ------------------------------------------------------------ decontamination

def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute_hits(doc, items, n=10):
    w, hit, found = words(doc), set(), set()
    for iid, text in items:
        b = words(text)
        for i in range(max(1, len(b) - n + 1) if b else 0):
            win = b[i:i + n]
            for j in range(len(w) - len(win) + 1):
                if w[j:j + len(win)] == win:
                    hit.update(range(j, j + len(win)))
                    found.add("" if iid is None else str(iid))
    return len(w), len(hit), sorted(found)


def test_decontamination_against_brute_force(spark, edge_docs):
    rng = random.Random(4)
    vocab = [f"w{i}" for i in range(12)] + ["É", "你好"]
    text = lambda n: " ".join(rng.choice(vocab) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 9, 10, 11, 25]))) for i in range(8)] + [(3, "w1, W2; w3!"), (None, text(12)), (5, None), (6, "..."), (6, text(14))]
    docs = [(i, text(rng.randrange(0, 60)) + "-" + (rng.choice(items)[1] or "") + "." + text(5) if rng.random() < 0.6 and i % 7 else text(20))
            for i in range(60) if (items[i % 8][1])]
    docs = [(i, t) for i, t in docs] + [(100, None), (101, "")]
    d = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n_hit", F.lit("clash"))
    b = spark.createDataFrame(items, "item_id long, text string")
    for most in (1_000_000, 20):  # one pass, and the windows split over several
        for r in decontaminate.find_contamination(d, b, max_windows=most).collect():
            n, hit, found = brute_hits(r["text"], items)
            assert (r["n_words"], r["n_hit"], r["n_items"], r["contaminated"]) == (n, hit, len(found), hit > 0)
    clean = decontaminate.decontaminate(d, b)
    assert clean.columns == d.columns
    assert {r["doc_id"] for r in clean.collect()} == {i for i, t in docs if brute_hits(t, items)[1] == 0}
    for r in decontaminate.decontaminate(d, b, remove="spans").collect():
        t = dict(docs)[r["doc_id"]]
        assert len(words(r["text"])) == len(words(t)) - brute_hits(t, items)[1]
    assert decontaminate.find_contamination(edge_docs, b.where("false")).where("contaminated").count() == 0
    assert decontaminate.find_contamination(edge_docs.where("false"), b).count() == 0


def test_spans_are_cut():
    assert decontaminate.remove_spans("a, b c. d", [(1, 3)]) == "a, . d"


# ------------------------------------------------------------------ URL filter

def brute_url(u):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in u or "")
    host = path = ""
    if "://" in (u or ""):
        rest = u.split("://", 1)[1]
        m = re.match(r"([^/?#]*)([^?#]*)", rest)
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]
    best = None
    for rule, verdict in url_filter.RULES:
        h, _, p = rule.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(rule) > len(best[0])):
            best = (rule, verdict)
    inside = lambda t: any((m.start() == 0 or not low[m.start() - 1].isalnum()) and (m.end() == len(low) or not low[m.end()].isalnum())
                           for m in re.finditer(f"(?={re.escape(t)})", low) for m in [re.compile(re.escape(t)).match(low, m.start())])
    bad = any(inside(t) for t in url_filter.STRICT) or sum(inside(t) for t in url_filter.SOFT) >= 2
    return host, path, best and best[0], best[1] if best else "block" if bad else "allow"


def test_url_rules_and_vocabulary(spark):
    urls = [None, "", "no scheme/casino", "http://A.Example.NET/en/x?y", "https://example.net/en", "http://net/", "http://net", "http://xnet/",
            "http://a.example.com/de/casino", "http://example.com/dex", "http://x.org/fr/porn", "http://x.org/frx", "http://casinos.example.com/",
            "http://cheap-pills.example.com/", "http://cheapest-pills.example.com/", "http://free.example.com/free", "http://x.com/#ads?track",
            "ftp://u@h.example.com:80/win/bonus", "http://é.com/casinoé", "a://b://c.net/d", "http://x.net?q=/", "http://alphabets.com/free", "HTTP://X.COM/XXX"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("rule", F.lit("clash"))
    got = {r["page_id"]: r for r in url_filter.url_filter(df).collect()}
    for i, u in enumerate(urls):
        assert (got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) == brute_url(u), u
    assert url_filter.url_filter(df.where("false")).count() == 0


# ------------------------------------------------------------------------ HTML

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href=x>Menu</a></ul></nav>
<div class="cookie-notice">We use cookies on this site, please accept them now.</div><div class="sidebar"><p>Popular posts of the week, and some more.</p></div>
<div id="content"><h1>Big &amp; <i>title</i></h1><p>Short.<p>A long paragraph with <a href=y>one link</a> in it,&nbsp;and
 more   text that goes on.<br>After the break.<ul><li>item one<li>item two</ul><div class="ad">Buy this wonderful thing now, it is really cheap today.</div>
<!-- comment --><p>x &lt; y &#233;</p></div><section id="comments"><div class="comment"><p>I liked this long article very much, thanks for it all.</p></div></section>
<form>Name <input><button>Send</button></form><aside>Related</aside><footer>&copy; me</footer></body></html>"""


def test_main_text_of_a_mixed_page():
    assert html_extract.main_text(PAGE).split("\n") == [
        "Big & title", "Short.", "A long paragraph with one link in it, and more text that goes on. After the break.", "item one", "item two", "x < y é"]


def test_article_pages_of_the_table():
    """Generated pages: the article's blocks, whitespace collapsed, references decoded."""
    import html

    for (h,) in duckdb.sql(f"select html from '{SF}/pages.parquet'").fetchall():
        art = re.search(r"<article>(.*?)</article>", h, re.S).group(1).replace("<br>", " ").replace("<b>", "").replace("</b>", "")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", art)]
        assert html_extract.main_text(h) == "\n".join(b for b in blocks if b)


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 9).flatmap(lambda n: st.tuples(
    st.lists(st.integers(-6, 6), min_size=n, max_size=n),
    st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1), st.integers(0, 4)), max_size=14))))
def test_min_cut_is_minimal(case):
    score, edges = case
    n = len(score)

    def cost(lab):
        return sum(abs(s) for s, x in zip(score, lab, strict=True) if s and (s > 0) != x) + sum(
            w for i, j, w in edges if i != j and lab[i] != lab[j])
    best = min(cost([bool(m >> i & 1) for i in range(n)]) for m in range(1 << n))
    assert cost(html_extract.min_cut([float(s) for s in score], [(i, j, float(w)) for i, j, w in edges])) == best


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="<>/!-p\"'= abdivscrt&;#\n", max_size=120))
def test_any_markup_is_read(page):
    html_extract.main_text(page)


@pytest.mark.parametrize("raw", [
    "<script>for(var i=0;i<n;i++){f(i);}</script>", "<script>if(a<b){x=1}</script>", "<SCRIPT>if(a<b){x='it}</script\n>",
    "<script>var a='<!-- ';</script>", '<script>var a="<b title=\\"";</script/>', "<style>a{content:'<!--'}</style x>",
    "<textarea><!-- <i</textarea>", "<script>'</scripts>';i<n</script>", "<template><script>a<b+\"'</script></template>",
    "<svg><title>t<b</title><style>/*<x '*/</style></svg>"])
def test_raw_text_ends_at_its_own_end_tag(raw):
    assert html_extract.main_text(raw + "<article><p>Hello it's me</p></article>") == "Hello it's me"
    assert html_extract.main_text(f"<article><p>One</p>{raw}<p>Two</p></article>" + raw) == "One\nTwo"


STORY = "The council met on Monday evening and agreed to repair the old bridge before the winter storms arrive. " * 3


@pytest.mark.parametrize("wrap", [
    '<div class="layout has-sidebar">{}</div>', '<div class="no-sidebar">{}</div>', '<div class="header-fixed">{}</div>',
    '<div class="search-page">{}</div>', "<form id=aspnetForm>{}</form>", '<div class="layout sidebar"><form>{}</form></div>',
    '<div id="banner-wrap"><div class="search">{}</div></div>', '<div class="navOpen with-banner">{}</div>'])
def test_a_wrapper_does_not_condemn_the_page(wrap):
    nav, foot = "<nav><a href=x>Home</a> <a href=y>News</a></nav>", "<footer><p>All rights reserved by us.</p></footer>"
    side = '<div class="sidebar"><p>Subscribe to our weekly letter.</p></div><div class="related"><article>More</article></div>'
    for tag in ("article", "main", "div"):
        page = wrap.format(f"{nav}<{tag}><h1>Bridge</h1><p>{STORY}</p><p>{STORY}</p></{tag}>{side}") + foot
        assert html_extract.main_text(page).split("\n")[-2:] == [STORY.strip()] * 2
        page = "<p>We use cookies on this site.</p>" + page
        assert html_extract.main_text(page).split("\n")[-2:] == [STORY.strip()] * 2
    assert html_extract.main_text(wrap.format("<article><p>Hello it's me</p></article>")) == "Hello it's me"


def test_boilerplate_is_no_wrapper():
    short, long = "<p>The bridge will be repaired before winter, the council said.</p>", f"<p>{STORY * 4}</p>"
    text = re.sub("<.*?>", "", short)
    for rest in (f'<div id="comments"><article class="comment-body">{long}</article></div>', f"<aside><article>{long}</article></aside>",
                 f'<div class="sidebar">{long}</div>', f"<div hidden><article>{long}</article></div>", f"<form>{long}</form>",
                 f"<footer><main>{long}</main></footer>", f'<div class="comments">{long}</div>'):
        assert html_extract.main_text(f"<article>{short}</article>{rest}") == text
    assert html_extract.main_text(f'{short}<div class="comments">{long}</div>') == text


def test_math_and_object_text_is_kept():
    page = "<article><p>Let <math><mi>x</mi><mo>=</mo><mn>1</mn><annotation>x</annotation></math>.</p><object data=a><p>Plain</p></object></article>"
    assert html_extract.main_text(page).split("\n") == ["Let x=1.", "Plain"]


def test_html_edges(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "<p>"), (4, "<script>" + "x" * 300_000), (4, "<article><p>" + "w " * 50_000)],
                               "page_id long, html string").withColumn("main_text", F.lit("clash"))
    got = html_extract.extract(df).collect()
    assert [len(r["main_text"]) for r in sorted(got, key=lambda r: (r["page_id"], len(r["html"] or "")))][:3] == [0, 0, 0]
    assert sorted(len(r["main_text"]) for r in got)[-1] == 99_999 and all(r["main_text_"] == "clash" for r in got)
    assert html_extract.extract(df.where("false")).count() == 0


# -------------------------------------------------------------- near duplicates

def gram_set(t, k=5):
    w = words(t)
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute_classes(rows, links=None):
    """Component of each row; ``links`` gets the linked sets of each set."""
    sets = [(i, gram_set(t)) for i, t in rows]
    par = list(range(len(rows)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x
    inv, shared = defaultdict(list), Counter()
    for k, (_, s) in enumerate(sets):
        for g in s:
            shared.update((j, k) for j in inv[g])
            inv[g].append(k)
    for (a, b), n in shared.items():
        if n / (len(sets[a][1]) + len(sets[b][1]) - n) >= 0.8:
            par[max(find(a), find(b))] = min(find(a), find(b))
            x, y = frozenset(sets[a][1]), frozenset(sets[b][1])
            if links is not None and x != y:
                links[x].add(y)
                links[y].add(x)
    return [find(k) for k in range(len(rows))]


@pytest.mark.parametrize("tiny,block", [(8, 256), (2, 4)])
def test_near_duplicates_against_brute_force(spark, monkeypatch, tiny, block):
    """Components, link counts and kept documents; the second case sends all
    larger buckets through many small blocks."""
    monkeypatch.setattr(near_dup, "TINY_BUCKET", tiny)
    monkeypatch.setattr(near_dup, "BLOCK", block)
    monkeypatch.setattr(near_dup, "COLUMNS", 50)
    rng = random.Random(8)
    rows, vocab = [], [f"v{i}" for i in range(400)]
    for fam in range(12):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 8, 60, 150]))]
        for copy in range(rng.choice([1, 2, 30])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4])):
                w[rng.randrange(len(w))] = rng.choice(vocab)
            rows.append((fam * 100 + copy, " ".join(w)))
    chain = [rng.choice(vocab) for _ in range(200)]  # neighbours are similar, the ends are not
    rows += [(5000 + s, " ".join(chain[s * 6:s * 6 + 120])) for s in range(12)]
    rng.shuffle(rows)
    rows += [(9000, None), (9001, ""), (9002, "?!")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    links = defaultdict(set)
    root = brute_classes(rows, links)
    least = defaultdict(lambda: 1 << 60)
    for (i, _), r in zip(rows, root, strict=True):
        least[r] = min(least[r], i)
    got = {r["doc_id"]: r for r in near_dup.ngram_jaccard_join(df, recall=0.999999, max_hashes=300).collect()}
    for (i, _), r in zip(rows, root, strict=True):
        assert got[i]["class_id"] == least[r], i
        assert got[i]["class_size"] == root.count(r)
    for i, t in rows:
        assert got[i]["n_links"] == len(links[frozenset(gram_set(t))]), i
    kept = near_dup.drop_near_duplicates(df, recall=0.999999, max_hashes=300)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(least.values())


def test_blocks_are_bounded_by_shingles(spark, monkeypatch):
    """No group of two blocks holds much more than the bound, and nothing is lost."""
    bound, links_of = 4_000, near_dup._block_links
    monkeypatch.setattr(near_dup, "BLOCK_GRAMS", bound, raising=False)

    def watched(threshold):
        run = links_of(threshold)

        def checked(rows):
            held = sum(len(g) for g in rows["grams"])
            if held > 4 * bound:
                raise ValueError(f"a group holds {held} shingles")
            return run(rows)
        return checked

    monkeypatch.setattr(near_dup, "_block_links", watched)
    rng = random.Random(4)
    base = [f"v{rng.randrange(5000)}" for _ in range(400)]
    rows = []
    for i in range(120):
        w = list(base)
        w[rng.randrange(400)] = f"x{i}"
        rows.append((i, " ".join(w)))
    links = defaultdict(set)
    brute_classes(rows, links)
    got = {r["doc_id"]: r for r in near_dup.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert all(got[i]["n_links"] == len(links[frozenset(gram_set(t))]) and got[i]["class_id"] == 0 for i, t in rows)


def test_near_duplicate_query_against_brute_force(spark):
    """The registered query with its own bands: classes and link counts."""
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    links = defaultdict(set)
    root = brute_classes(rows, links)
    least = defaultdict(lambda: 1 << 60)
    for (i, _), r in zip(rows, root, strict=True):
        least[r] = min(least[r], i)
    got = {r["doc_id"]: r for r in near_dup.op2_ngram_jaccard_join(spark, SF).collect()}
    assert len(got) == len(rows)
    for (i, t), r in zip(rows, root, strict=True):
        assert (got[i]["class_id"], got[i]["class_size"]) == (least[r], root.count(r)), i
        assert got[i]["n_links"] == len(links[frozenset(gram_set(t))]), i


def test_links_near_the_threshold_are_found(spark):
    """Pairs of similarity 0.80 to 0.82 under the query's own bands."""
    rng, rows = random.Random(11), []
    while len(rows) < 2000:
        w = [f"v{rng.randrange(10 ** 6)}" for _ in range(95)]
        other = list(w)
        for at in (10, 50):
            other[at] = f"y{rng.randrange(10 ** 6)}"
        a, b = gram_set(" ".join(w)), gram_set(" ".join(other))
        if 0.8 <= len(a & b) / len(a | b) <= 0.82:
            rows += [(len(rows), " ".join(w)), (len(rows) + 1, " ".join(other))]
    got = near_dup.ngram_jaccard_join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    share = sum(r["n_links"] for r in got) / len(rows)
    print("share of links found:", share)
    assert all(r["n_links"] <= 1 for r in got) and share >= 0.995


def test_band_shape_reaches_the_recall():
    bands, rows = near_dup.band_shape()
    assert bands * rows <= near_dup.MAX_HASHES and 1 - (1 - 0.8 ** rows) ** bands >= near_dup.RECALL


def test_near_duplicate_edges(edge_docs):
    kept = near_dup.drop_near_duplicates(edge_docs)
    ids = sorted((r["doc_id"] or -1) for r in kept.collect())
    assert kept.columns == edge_docs.columns and ids == [-1, 1, 2, 3, 5, 6, 7, 8]
    assert near_dup.ngram_jaccard_join(edge_docs).count() == 10
    assert near_dup.drop_near_duplicates(edge_docs.where("false")).count() == 0


def test_components_and_hot_joins(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_LEAST", 20)
    n = spark.range(400)
    c = lambda x: F.struct(x.cast("long").alias("c1"), F.lit(0).cast("long").alias("c2"))
    star = n.where("id > 0 and id < 200").select(c(F.col("id")).alias("a"), c(F.lit(0)).alias("b"))
    path = n.where("id > 200").select(c(F.col("id")).alias("a"), c(F.col("id") - 1).alias("b"))
    got = {r["c"]["c1"]: r["root"]["c1"] for r in near_dup.components(star.unionByName(path)).collect()}
    assert got == {i: 0 if i < 200 else 200 for i in range(400)}


# ---------------------------------------------------------------------- quality

def test_quality_held_out(spark):
    rows = {r["doc_id"]: r for r in quality.op1_quality_classifier(spark, "/root/testdata/sf0.01").collect()}
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows.values())
    labels = duckdb.sql("select doc_id, quality from '/root/testdata/sf0.01/labels.parquet'").fetchall()
    held = [(rows[i]["predicted"], q) for i, q in labels if rows[i]["held_out"]]
    assert len(held) > 50 and sum(p == q for p, q in held) / len(held) > 0.95


def test_quality_edges(spark, edge_docs):
    w = quality.train(spark.createDataFrame([], "doc_id long, text string, label int"))
    got = quality.score_quality(edge_docs, w).collect()
    assert len(got) == 10 and all(r["score"] == 0.5 and r["score_"] == "clash" for r in got)
    labelled = spark.createDataFrame([(1, "a b", 1), (2, None, 0), (2, None, 0), (3, "", 1)], "doc_id long, text string, label int")
    assert quality.score_quality(edge_docs.where("false"), quality.train(labelled)).count() == 0


# ------------------------------------------------------------------- language ID

def test_languages_held_out(spark):
    rows = langid.op10_language_id(spark, "/root/testdata/sf0.01").collect()
    lang = dict(duckdb.sql("select doc_id, lang from '/root/testdata/sf0.01/documents.parquet'").fetchall())
    held = [r["lang_pred"] == lang[r["doc_id"]] for r in rows if r["held_out"]]
    assert len(rows) == 1000 and sum(held) / len(held) > 0.97 and all(0 <= r["score"] <= 1 for r in rows)


def test_code_switched_words_and_edges(spark, edge_docs):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.train(langid.training_rows(docs))
    by = {r["lang"]: r["t"] for r in docs.where("n_chars > 400").groupBy("lang").agg(F.max("text").alias("t")).collect()}
    cut = {k: [w for w in re.findall(r"[^\W\d_]+", v.lower()) if len(w) > 2][:40] for k, v in by.items() if k in ("de", "es")}
    p = model.word_probabilities(" ".join(cut["de"] + cut["es"]))
    names = [model.labels[j] for j in p.argmax(axis=1)]
    assert sum(n == "de" for n in names[:40]) >= 32 and sum(n == "es" for n in names[40:]) >= 32
    got = {(r["doc_id"], r["text"]): r for r in langid.identify(edge_docs, model).collect()}
    assert all((r["lang_pred"] == "und") == (not re.search(r"[^\W\d_]", t or "")) for (_, t), r in got.items())
    assert langid.identify(edge_docs.where("false"), model).count() == 0
    assert {r["lang_pred"] for r in langid.identify(edge_docs, langid.train(docs.where("false"))).collect()} == {"und"}


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(1)
    lengths = np.array([1, 3, 150, 64, 65])
    e, trans = rng.normal(size=(int(lengths.sum()), 3)), rng.normal(size=(3, 3))
    got, at, a = langid.marginals(e, lengths, trans), 0, np.exp(trans)
    for n in lengths:
        x = np.exp(e[at:at + n])
        f, b = np.zeros((n, 3)), np.ones((n, 3))
        cur = np.full(3, 1 / 3)
        for t in range(n):
            cur = (cur @ a) * x[t]
            cur /= cur.sum()
            f[t] = cur
        cur = np.ones(3)
        for t in range(n - 1, -1, -1):
            b[t] = cur
            cur = a @ (x[t] * cur)
            cur /= cur.sum()
        p = f * b
        assert np.allclose(got[at:at + n], p / p.sum(axis=1, keepdims=True))
        at += n


def test_long_texts_are_scored_like_short_ones(monkeypatch):
    text = "Zug und Straße, été à Paris; x1y ²³ " * 40
    whole = langid.Words(langid.code_points(text))
    monkeypatch.setattr(langid, "SLICE", 50)
    parts = [langid.Words(c) for c in langid.slices(langid.code_points(text), 50)]
    assert sum(p.n for p in parts) == whole.n
    assert np.array_equal(np.concatenate([p.hash for p in parts if p.n]), whole.hash)


# ------------------------------------------------ html: words inside the article

LONG = "This paragraph of the article is long enough, with commas, to be read as running text by any classifier. " * 2


@pytest.mark.parametrize("inner", [
    f'<section id="legal-status"><p>{LONG}</p></section>', f'<h3 id="social-history">Social history</h3><p>{LONG}</p>',
    f'<p id="search-methods">{LONG}</p>', f'<div class="share-price"><p>{LONG}</p></div>', f'<blockquote class="reply-quote">{LONG}</blockquote>'])
def test_topic_words_inside_the_article_condemn_nothing(inner):
    text = html_extract.main_text(f"<html><body><nav><a href=x>Home</a></nav><article><p>{LONG}</p>{inner}<p>{LONG}</p></article></body></html>")
    assert text.count("This paragraph of the article") == 6 and "Home" not in text
    if "Social" in inner:
        assert "Social history" in text


@pytest.mark.parametrize("inner", [
    '<span style="display:none">Gone words</span>', '<span class="ad">Gone words</span>', '<div class="share-buttons">Gone words</div>',
    '<ol class="commentlist"><li>Gone words</li></ol>', '<div class="werbung">Gone words</div>', '<section id="kommentare"><p>Gone words</p></section>',
    '<p hidden>Gone words</p>', '<div class="related-posts"><p>Gone words</p></div>'])
def test_clear_boilerplate_inside_the_article_goes(inner):
    text = html_extract.main_text(f"<html><body><article><p>{LONG}</p>{inner}<p>{LONG}</p></article></body></html>")
    assert "Gone" not in text and text.count("This paragraph of the article") == 4
