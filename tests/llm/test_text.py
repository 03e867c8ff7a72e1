"""Repeated passages, licenses, toxicity and web pages, against plain Python."""

import hashlib
import json
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lurewatch.llm import html_wrappers, licenses, suffix_dedup, toxicity

DOC = "doc_id long, text string, row string, score double, toxic int"


def docs(spark, rows, parts=3):
    return spark.createDataFrame([(*r, "x", 0.0, 1) for r in rows], DOC).repartition(parts)


# --- repeated passages --------------------------------------------------------------------------

def brute(rows, depth=50):
    ident = lambda i: 2 ** 63 - 1 if i is None else i
    first = {}
    for i, t in rows:
        t = (t or "").encode()
        for at in range(len(t) - depth + 1):
            w = t[at:at + depth]
            first[w] = min(first.get(w, ident(i)), ident(i))
    out = []
    for i, t in rows:
        t = (t or "").encode()
        gone = bytearray(len(t))
        for at in range(len(t) - depth + 1):
            if first[t[at:at + depth]] < ident(i):
                gone[at:at + depth] = b"\1" * depth
        kept = bytes(b for b, g in zip(t, gone) if not g)
        spans = sum(1 for k, g in enumerate(gone) if g and (k == 0 or not gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def passages():
    rng = random.Random(5)
    text = lambda n: "".join(rng.choice("abcdefgh é\n") for _ in range(n))
    shared, other = text(120), text(50)
    rows = [(i, text(rng.randrange(0, 300)) + shared[rng.randrange(60):rng.randrange(60, 120)] + text(40) + other * (i % 2))
            for i in range(60)]
    rows += [(100, None), (101, ""), (102, other[:-1]), (103, other), (None, shared), (None, shared + "x"), (104, "a" * 400),
             (105, "b" + "a" * 200), (5, shared), (106, "ab" * 100), (107, "ba" * 100), (108, rows[3][1]), (109, rows[3][1])]
    return rows


def removed(df, **options):
    rows = suffix_dedup.remove_repeats(df, **options)
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in rows.collect()), key=repr)


def test_repeated_passages(spark):
    assert removed(docs(spark, passages(), 5)) == brute(passages())


def test_repeated_passages_of_another_depth(spark):
    assert removed(docs(spark, passages(), 2), depth=24) == brute(passages(), 24)


def test_kept_bytes_and_empty_table(spark):
    passage = "".join(random.Random(1).choices("abcdef", k=60))
    got = {r["doc_id"]: r["kept"] for r in suffix_dedup.remove_repeats(docs(spark, [(1, passage), (2, "<" + passage + ">")])).collect()}
    assert got == {1: passage.encode(), 2: b"<>"}
    assert removed(docs(spark, [])) == []


@settings(max_examples=80, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), min_size=3, max_size=3), max_size=40))
def test_radix_groups(rows):
    import numpy as np
    group = suffix_dedup.radix_groups(np.array(rows, np.uint64).reshape(-1, 3))
    for i, a in enumerate(rows):
        for j, b in enumerate(rows):
            assert (a == b) == (group[i] == group[j])


# --- licenses -----------------------------------------------------------------------------------

def lcs(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
    return best[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcdefg"), max_size=25), st.lists(st.sampled_from("abcdefg"), max_size=12))
def test_patience_is_a_common_subsequence(text, template):
    pairs = licenses.patience(text, template)
    assert all(text[i] == template[j] for i, j in pairs)
    assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))
    assert len(pairs) <= lcs(text, template)
    assert licenses.common(list(enumerate(text)), template, 0, len(template)).__len__() == lcs(text, template)


def test_scan(spark):
    mit, apache = licenses.TEMPLATES["MIT"], licenses.TEMPLATES["Apache-2.0 header"]
    changed = mit.replace("person", "human").replace("charge", "any charge")
    filler = "the of to and work is under a " * 400
    rows = [(1, f"{filler}\n{mit}\n{filler}"), (2, changed), (3, filler), (4, None), (5, ""),
            (6, "Released under the MIT License. " * 3), (7, f"x {apache} y"), (8, "licensed under"), (None, mit),
            (9, mit[:len(mit) // 2]), (9, mit[:len(mit) // 2])]
    got = {}
    for r in licenses.scan(docs(spark, rows)).collect():
        got[r["doc_id"]] = r
    name = {k: r["license"] for k, r in got.items()}
    assert name == {1: "MIT", 2: "MIT", 3: None, 4: None, 5: None, 6: "MIT notice", 7: "Apache-2.0 header", 8: None, None: "MIT", 9: None}
    assert got[1]["coverage"] == 1.0 and 0.9 < got[2]["coverage"] < 1.0
    assert rows[0][1][got[1]["first_char"]:got[1]["end_char"]].split() == mit.rstrip(".").split()
    assert licenses.scan(docs(spark, [])).count() == 0


def every_window(words, template, coverage):
    """The best of all windows of the text, each aligned by itself."""
    best = None
    for s in range(len(words)):
        for e in range(s, len(words)):
            pairs = licenses.patience(words[s:e + 1], template)
            n = len(pairs)
            if not n or n / len(template) < coverage or n < licenses.TIGHT * (e - s + 1):
                continue
            places = [i for i, _ in pairs]
            if places[0] or places[-1] != e - s or n > 1 and max(
                    places[1] - places[0], places[-1] - places[-2]) > licenses.NEAR:
                continue
            if best is None or (-n, e, -s) < best[0]:
                best = (-n, e, -s), (n, s, e)
    return best and best[1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from("abcdefxy"), max_size=24), st.lists(st.sampled_from("abcdef"), min_size=1, max_size=8),
       st.integers(0, 24), st.booleans())
def test_notice_is_the_best_window(around, template, at, verbatim):
    words = around[:at] + template * verbatim + around[at:]
    got = licenses.Scanner({"t": " ".join(template)}, 0.8).scan(" ".join(words))
    want = every_window(words, template, 0.8)
    assert (got and (got[2], got[3] // 2, got[4] // 2)) == (want and (want[0], want[1], want[2]))


@pytest.mark.parametrize("own,name", [
    ("Released under the MIT License. Please read the full text of the license before use.", "MIT notice"),
    ("Licensed under the Apache License, Version 2.0. Some of these files are older; they need version 2.0 too.",
     "Apache-2.0 notice"),
    ("The license is short. Released under the MIT License. It is the license of all parts under the main folder.",
     "MIT notice")])
def test_a_notice_followed_by_its_own_words(own, name):
    got = licenses.Scanner(licenses.TEMPLATES, 0.8).scan(own)
    assert got[0] == name and got[1] == 1.0
    assert licenses.WORD.findall(own[got[3]:got[4]].lower()) == licenses.WORD.findall(licenses.TEMPLATES[name].lower())


# --- toxicity -----------------------------------------------------------------------------------

def near(a, b):
    """At most one edit apart."""
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) <= 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1:] == a for i in range(len(b)))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="abcx", max_size=9))
def test_automaton_equals_brute_force(word):
    terms = {"abcab": (3.0, 1.0), "cab": (2.0, 1.5), "bcabc*": (4.0, 2.0), "aaaaaa": (1.0, 0.5)}
    best = 0.0
    for term, (exact, fuzzy) in terms.items():
        stem = term.rstrip("*")
        heads = [word[:n] for n in range(len(word) + 1)] if term.endswith("*") else [word]
        if stem in heads:
            best = max(best, exact)
        if len(stem) >= toxicity.FUZZY_LENGTH and any(near(stem, h) for h in heads):
            best = max(best, fuzzy)
    assert toxicity.Lexicon(terms).find(word)[0] == best


def test_context_separates_quotation_from_abuse():
    lexicon = toxicity.Lexicon({"scoundrel": (4.0, 2.0)})
    hits = lambda t: lexicon.hits(t)[1]
    assert hits("what a scoundrel there") == [(4.0, False, 0, 1.0)]
    assert hits("the headline has the scoundrel in it")[0][3] == toxicity.QUOTED
    assert hits('in 1900 "scoundrel" was common')[0][3] == toxicity.QUOTED
    assert hits("you scoundrel")[0][3] == toxicity.ADDRESSED
    assert hits("a scoundel and a sco*ndrel")[0][1] and len(hits("a scoundel and a sco*ndrel")) == 2


def sample(n):
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=6)) for _ in range(300)]
    rows = []
    for i in range(n):
        text = rng.choices(words, k=rng.randrange(20, 200))
        if i % 4 == 0:
            for _ in range(3 + len(text) // 20):
                text.insert(rng.randrange(len(text)), rng.choice(["villain", "scoundrel", "rotter", "scoundrl"]))
        rows.append((i, " ".join(text)))
    return rows


def test_held_out_toxicity(spark):
    rows = sample(800)
    labels = [(i, int(i % 4 == 0), None) for i, _ in rows] + [(None, 1, None), (1, None, None)]
    labels = spark.createDataFrame(labels, "doc_id long, toxic int, quality int")
    train = toxicity.training_rows(labels, docs(spark, rows), lambda c: c % 5 != 0)
    assert train.count() == 640
    model = toxicity.fit(train)
    edge = [(9000, None), (9001, ""), (9002, "villain " * 30_000), (None, "rotter"), (9003, "x"), (9003, "x")]
    got = toxicity.score(docs(spark, rows + edge), model).collect()
    assert len(got) == len(rows) + len(edge)
    held = [r for r in got if r["doc_id"] is not None and r["doc_id"] % 5 == 0 and r["doc_id"] < 9000]
    assert sum((r["score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in held) >= 0.97 * len(held)
    scores = {r["doc_id"]: r["score"] for r in got}
    assert scores[9000] == scores[9001] < 0.5 < scores[9002]
    clean = toxicity.keep_clean(docs(spark, rows + edge), model)
    assert clean.columns == docs(spark, []).columns and 590 < clean.count() < 615


def test_no_labels_and_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.fit(toxicity.training_rows(labels, docs(spark, [(1, "a")]), lambda c: F.lit(True))) is None
    assert [r["score"] for r in toxicity.score(docs(spark, [(1, "a")]), None).collect()] == [0.0]
    assert toxicity.score(docs(spark, []), None).count() == 0


# --- web pages ----------------------------------------------------------------------------------

def page(body, extra=""):
    return (f"<!DOCTYPE html><html><head><title>T</title><script>var a='</p><article>x</article>';</script></head><body>"
            f"<nav><ul><li><a href='/'>Home</a></li></ul></nav>{body}<footer>&copy; foot</footer>{extra}</body></html>")


ARTICLES = [
    (page("<article><h1>A &amp; B</h1><p>one <b>two</b>\n three<p>four<br>five</article>"), "A & B\none two three\nfour five"),
    (page("<article><p>x</p><div class='ad box'>Buy</div><aside>side</aside><p>y&nbsp;z</p><form>f</form></article>"), "x\ny z"),
    (page("<div class='cookie-notice'>We use cookies</div><main><ul><li>i<li>j</ul><pre>k\n l</pre></main>"), "i\nj\nk l"),
    (page("<article><p>body</p><section id='comments'><p>first!</p></section></article>"), "body"),
    (page("<div class='ad'>unclosed ad<article><p>text</p></article>"), "text"),
    (page("<article><p>cut off here <b>and"), "cut off here and ©"),
    (page("<article><p>&lt;p&gt; &#233; &amp;amp;</p><!-- <p>no</p> --><style>p{}</style></article>"), "<p> é &amp;"),
    ("", ""), (None, ""),
]


def test_main_text(spark):
    rows = [(i, "http://a.example/x" if i % 2 else None, h, "e") for i, (h, _) in enumerate(ARTICLES)]
    rows += [(100, "no url", "<p>plain</p><p>text</p>", "e"), (100, "no url", "<p>plain</p><p>text</p>", "e")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string").repartition(3)
    got = html_wrappers.main_text(frame).collect()
    assert len(got) == len(rows) and all(r["n_chars"] == len(r["text"]) for r in got)
    text = {r["page_id"]: r["text"] for r in got}
    wrong = {i: (text[i], want) for i, (_, want) in enumerate(ARTICLES) if text[i] != want and i != 5}
    assert not wrong
    assert text[5].startswith("cut off here and")
    assert text[100] == "plain\ntext"
    assert html_wrappers.main_text(frame.limit(0)).count() == 0


def test_wrapper_without_a_main_element_drops_links_and_template(spark):
    rows = [(i, "http://b.example/", f"<div><a href='#'>More news</a></div><div class='x'><p>story number {i}</p></div>"
             "<div class='y'>All rights reserved by us</div>", "e") for i in range(5)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, extra string")
    assert {r["text"] for r in html_wrappers.main_text(frame).collect()} == {f"story number {i}" for i in range(5)}


def texts_of(spark, rows):
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    return [r["text"] for r in html_wrappers.main_text(frame).orderBy("page_id").collect()]


def test_copies_of_a_page_are_one_page(spark):
    story = "<div class='x'><p>the only story of this host, in a few words</p><blockquote>said once</blockquote></div>"
    rows = [(f"http://c.example/?utm_source={i}", story) for i in range(4)] + [("http://d.example/", story)] * 4
    rows += [(f"http://e.example/{i}", f"<div class='x'><p>story number {i}</p></div>") for i in range(4)]
    rows += [(f"http://e.example/q?utm_source={i}", story) for i in range(4)]
    rows += [(f"http://g.example/{i}", story + f"<i>{i} views</i>") for i in range(4)]
    whole = "the only story of this host, in a few words\nsaid once"
    assert texts_of(spark, rows) == [whole] * 8 + [f"story number {i}" for i in range(4)] + [whole] * 4 + [
        f"{whole}\n{i} views" for i in range(4)]


def test_links_are_judged_on_their_own_page(spark):
    links = "<div><p><a href='#'>one</a></p><p><a href='#'>two and three and four and five and six</a></p></div>"
    rows = [(f"http://f.example/{i}", links) for i in range(4)] + [("http://f.example/s", "<div><p>an unlinked story</p></div>")]
    rows += [("http://f.example/t", links + "<div><p>told below links</p></div>")]
    assert texts_of(spark, rows) == [""] * 4 + ["an unlinked story", "told below links"]


def test_template_inside_the_main_element_is_left_out(spark):
    rows = [(f"http://h.example/{i}", page(f"<article><h1>Title {i}</h1><p>story number {i} is told here</p>" + "<hr><ul><li>x</ul>" * (i % 2)
             + "<div class='box'>Read it in our app</div></article>")) for i in range(5)]
    rows += [("http://h.example/none", page("<p>nothing found</p>"))]
    told = [f"Title {i}\nstory number {i} is told here" + "\nx" * (i % 2) for i in range(5)]
    assert texts_of(spark, rows)[:5] == told
    parts = [("http://i.example/", page(f"<article><p>story number {i}</p>" + "<table><td>a table of some pages</table>" * (i < 4)
              + "</article>")) for i in range(6)]
    assert texts_of(spark, parts) == [f"story number {i}" + "\na table of some pages" * (i < 4) for i in range(6)]


def test_article_text_is_never_left_out(spark):
    """Neither because it repeats on a host nor because a class word looks like a box of another kind."""
    rows = [("http://j.example/", page(f"<article><h1>Dish {i}</h1><h2>Ingredients</h2><p>number {i}</p><blockquote>so they say"
             "</blockquote><ul><li>salt</ul><div class='box'>Get the app</div></article>")) for i in range(6)]
    assert texts_of(spark, rows) == [f"Dish {i}\nIngredients\nnumber {i}\nso they say\nsalt" for i in range(6)]
    names = ["social-science", "notice-to-mariners", "comment-on-law", "article-share-price", "promo-code-guide",
             "header-image caption", "advert", "menu"]
    rows = [("http://k.example/", page(f"<article><p class='{n}'>told {i}</p></article>")) for i, n in enumerate(names)]
    rows += [("http://k.example/", page(f"<article><p>kept</p><div class='{n}'>other {i}</div></article>"))
             for i, n in enumerate(["cookie-notice", "ad-slot", "share-buttons", "social", "comments-area", "related links"])]
    rows += [("http://k.example/", page(f"<article><div class='{n}'>told {i}</div></article>"))
             for i, n in enumerate(["notice-to-mariners", "social-science", "adverse", "shared-work"])]
    assert texts_of(spark, rows) == [f"told {i}" for i in range(8)] + ["kept"] * 6 + [f"told {i}" for i in range(4)]


@pytest.mark.parametrize("own,want", [
    ("<article><p title=don't>hello</p></article>", "hello"), ("<article><!--><p>x</p></article>", "x"),
    ("<article><!---><p>x</p><!-- a --!><p>y</p></article>", "x\ny"), ("<article>&am<b>p;</b> &amp;lt;</article>", "&amp; &lt;"),
    ("<article><p a='>' b=\"x>y\" c=d'e>z</p></article>", "z"), ("<article><a href=x>one</a> <a href=y>two</a></article>", "one two"),
    ("<article>a </> b </ c> d</article>", "a b d"), ("<article><p>1 < 2 and 3 > 2</p></article>", "1 < 2 and 3 > 2"),
    ("<article><x-y.z>in</x-y.z> odd</article>", "in odd")])
def test_markup_as_browsers_read_it(own, want):
    assert html_wrappers.extract(own, html_wrappers.fold(html_wrappers.parse(own))) == want


def test_pages_nest_as_deep_as_they_like(spark):
    deep = [f"<div><i>{'<div>' * n}<p>deep {n}</p>{'</div>' * (n - 3)}" for n in (1_200, 30_000)]
    rows = [("http://l.example/", page(f"<article>{d}</article>")) for d in deep] + [("http://l.example/", "<ul><li>" * 20_000 + "x")]
    rows += [("http://l.example/", page("<article>" + "".join(f"<div class='k{'abcdefghij'[i % 10] * (i % 97)}'>w</div>"
                                                               for i in range(3_000)) + "</article>"))]
    got = texts_of(spark, rows)
    assert got[:3] == ["deep 1200", "deep 30000", "x"] and got[3] == "\n".join(["w"] * 3_000)


def test_layouts_as_text():
    items = html_wrappers.fold(html_wrappers.parse(page("<article><h1>a</h1><p>b<p>c<dl><dt>a<dd>b<dt>c<dd>d</dl></article>")))
    assert html_wrappers.load(html_wrappers.dump(items)) == items
    assert html_wrappers.load(html_wrappers.dump([])) == []


def test_hosts_of_many_layouts(spark, monkeypatch):
    """Wrappers of parts are aligned again until a host has one; its template is found."""
    monkeypatch.setattr(html_wrappers, "FAN", 4)
    rows = [(f"http://m.example/{i}", page("<article>" + "".join(f"<{t}>{t} {i}</{t}>" for b, t in enumerate(
        ("h2", "p", "pre", "ul", "section", "table")) if i >> b & 1) + f"<p>end {i}</p><div>Same everywhere</div></article>"))
        for i in range(64)]
    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string")
    assert html_wrappers.wrappers(frame).count() == 1
    for i, text in enumerate(texts_of(spark, rows)):
        assert text.endswith(f"end {i}") and text.count("\n") == bin(i).count("1")


def test_generated_pages(spark):
    """Pages put together from known article text and known boxes around and within it."""
    rng = random.Random(11)
    words = "alder birch cedar dogwood elm fir ginkgo hazel iris juniper kapok larch maple nettle oak pine".split()
    say = lambda: " ".join(rng.choices(words, k=rng.randint(1, 12)))
    boxes = ["<nav><ul><li><a href=/>{}</a></ul></nav>", "<div class='ad'>{}</div>", "<aside><p>{}</p></aside>", "<footer>{}</footer>",
             "<form><label>{}</label><input></form>", "<div id=comments><p>{}</p></div>", "<script>'{}'</script>",
             "<style>{}</style>", "<!-- {} -->", "<div role='search'>{}</div>", "<section class='cookie-notice'><h3>{}</h3></section>"]
    rows, want = [], []
    for n in range(120):
        told, inside = [], ""
        for _ in range(rng.randint(0, 12)):
            kind, text = rng.choice(["p", "h2", "li", "pre", "quote", "inline", "table", "open", "box", "entity"]), say()
            if kind == "box":
                inside += rng.choice(boxes).format(text)
                continue
            inside += {"p": f"<p>{text}</p>", "h2": f"<h2 class='t{n}'>{text}</h2>", "li": f"<ul><li>{text}</ul>", "pre": f"<pre>{text}</pre>",
                       "quote": f"<blockquote><p>{text}</p></blockquote>", "inline": f"<p><b>{text}</b><i></i>&nbsp;",
                       "table": f"<table><tr><td>{text}</table>", "open": f"<p>{text}", "entity": f"<p>{text} &lt;&#97;&gt;</p>"}[kind]
            told.append(text + " <a>" * (kind == "entity"))
        main = f"<{'article' if n % 3 else 'main'}>{inside}</{'article' if n % 3 else 'main'}>"
        around = [rng.choice(boxes).format(say()) for _ in range(4)]
        rows.append((f"http://host{n % 5}.example/{n}", f"<html><head><title>{say()}</title></head><body>{''.join(around[:2])}"
                     f"<div>{main}</div>{''.join(around[2:])}</body></html>"))
        want.append("\n".join(told))
    assert texts_of(spark, rows) == want


def test_folding_and_alignment():
    fold = lambda h: html_wrappers.fold(html_wrappers.parse(h))
    once, many = fold("<h1>t</h1><p>a</p>"), fold("<h1>t</h1><p>a</p><p>b</p><p>c</p><hr>")
    both = html_wrappers.align(once, many)
    assert [(x[0], x[1], x[2]) for x in both] == [("h1", False, False), ("p", False, True), ("hr", True, False)]
    pairs = fold("<dl><dt>a<dd>b<dt>c<dd>d</dl>")
    assert pairs[0][3][0][0] == "()" and [x[0] for x in pairs[0][3][0][3]] == ["dt", "dd"]
    assert json.dumps(html_wrappers.align(both, once)) == json.dumps(both)


@pytest.mark.parametrize("junk", ["<", "<<p>>", "</div></div><p>x", "<p", "<!--", "<a href='", "<script>", "a<b"])
def test_broken_markup_does_not_fail(junk):
    html_wrappers.extract(junk, html_wrappers.fold(html_wrappers.parse(junk)))
