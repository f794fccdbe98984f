from zonalspark.llm import html_density as hd

LONG = "Some plain words that make a paragraph of a decent size, with a second clause and a third one. "


def page(main, before="", after=""):
    return f"<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style></head><body>{before}{main}{after}</body></html>"


def test_cuts():
    menu = "<nav><ul><li><a href='/'>Home page of ours</a></li></ul></nav><div class='ad'>" + LONG + "</div><header><h1>Site</h1></header>"
    after = "<aside>" + LONG + "</aside><div id='cookie-notice'>" + LONG + "</div><section class='comments'><p>" + LONG * 3 + "</p><p>" + LONG * 3 + "</p></section><form>Mail <input></form><footer>&copy; us</footer>"
    body = f"<article><h1>Title</h1><p>{LONG}<p><b>Bold</b>ly &amp; <a href='x'>linked</a> text<br>next <script>var t='</p>'</script> line<ul><li>one<li>two</ul></article>"
    want = " ".join(f"Title {LONG} Boldly & linked text next line one two".split())
    assert hd.extract(page(body, menu, after)) == want
    assert hd.extract(page(body, menu, after).replace("article>", "main>")) == want


def test_without_an_article():
    menu = "<div><a href='a'>aaaa</a> <a href='b'>bbbb</a> <a href='c'>cccc</a></div>"
    body = "<div><div><h2>Head</h2>" + f"<p>{LONG}</p>" * 4 + "</div></div>"
    got = hd.extract(page(body, menu, menu))
    assert got == " ".join(("Head " + LONG * 4).split())


def test_odd_pages():
    assert [hd.extract(x) for x in (None, "", " \n", "<p>", "<!-- never closed <p>x", "<script>x", "<html><body><nav>a</nav>")] == [""] * 7
    assert hd.extract("plain &lt;text&gt;\n of  a page") == "plain <text> of a page"
    assert hd.extract("<body><p title='a>b' class=\"x\">one</p><p>two") == "one two"
    assert hd.extract("<p>a < b and c</p>") == "a < b and c"
    assert hd.extract("<div>" * 3000 + "deep" + "</div>" * 3000) == "deep"
    assert len(hd.extract("<p>" + "word " * 200_000)) == 999_999


def test_report(spark):
    rows = [(1, "u", "<p>é &eacute;</p>"), (1, "u", "<p>é &eacute;</p>"), (None, None, None)]
    got = hd.report(spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("text", hd.F.lit(1)))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((r["text"], r["n_chars"]) for r in got.collect()) == [("", 0), ("é é", 3), ("é é", 3)]


def test_page_inside_a_form_and_named_headings():
    body = "".join(f"<p>Paragraph {i} has quite a few words about one subject.</p>" for i in range(8))
    for wrap in ("form", "fieldset", "header"):
        got = hd.extract(f"<html><body><{wrap}><div><h2 class='section-header'>Title here</h2>{body}</div></{wrap}><form><p>Search this site</p></form></body></html>")
        assert got.startswith("Title here Paragraph 0") and got.endswith("one subject.") and "Search" not in got
    got = hd.extract(f"<body><form><main><p>A main text that is the longer one.</p></main></form><form>{'<p>Pick one of these.</p>'}</form></body>")
    assert got == "A main text that is the longer one."


def test_deep_and_unclosed_pages_take_linear_time():
    import time

    kinds = ["<div>x ", "<b>x ", "<li>x ", "<ul><div>x ", "<ul><li>x ", "<p><b>x ", "<a>x ", "</b>x ", "<div class=ad>x ", "<option>x ", "<td>x ", "<b><div>x "]
    for kind in kinds:
        took = []
        for n in (2_000, 16_000):
            began = time.process_time()
            text = hd.extract(page(kind * n))
            took.append(time.process_time() - began)
            assert set(text) <= {"x", " "}
        assert took[1] < 24 * took[0] + 0.3, kind
    began = time.process_time()
    assert len(hd.extract("<div>x " * 150_000)) == 299_999
    assert time.process_time() - began < 6


def test_density_ties_and_empty_table(spark):
    same = f"<div><p>{LONG}</p><p>{LONG}</p></div>"
    assert hd.extract(page(same + same)) == " ".join((LONG * 4).split())
    pages = spark.createDataFrame([(1, "u", "<p>one", 5), (None, None, None, 5), (1, "u", "<p>one", 5)], "page_id long, url string, html string, text int")
    assert sorted((r["page_id"] or 0, r["text"], r["n_chars"]) for r in hd.report(pages).collect()) == [(0, "", 0), (1, "one", 3), (1, "one", 3)]
    assert hd.report(pages.limit(0)).count() == 0


def slow_text(html):
    """A plain reading of simple, well-formed pages: the text of the article, or of all paragraphs of the densest div."""
    import xml.etree.ElementTree as et

    article = next(et.fromstring(html).iter("article"))
    drop = {e for bad in ("nav", "aside", "form", "footer", "script") for top in article.iter(bad) for e in top.iter()}
    parts = []

    def walk(e):
        if e in drop:
            parts.append("" if e.tag == "script" else " ")
            return
        block = e.tag in ("p", "h1", "h2", "div", "li", "ul", "article", "section")
        parts.append(" " if block else "")
        parts.append(e.text or "")
        for c in e:
            walk(c)
            parts.append(c.tail or "")
        parts.append(" " if block else "")

    walk(article)
    return " ".join("".join(parts).split())


def test_random_pages_against_a_tree_walk():
    import random

    rng = random.Random(2)

    def inner(depth):
        if depth == 0 or rng.random() < 0.3:
            return rng.choice([LONG, "few words", "two &amp; three", ""])
        tag = rng.choice(["p", "div", "b", "i", "span", "ul", "section", "aside", "nav", "script"])
        body = "".join(inner(depth - 1) for _ in range(rng.randrange(1, 4))) if tag != "script" else "var x = 1"
        if tag == "p":
            body = rng.choice([LONG, "<b>bold</b> and <i>more</i>"])
        return f"<{tag}>{body}</{tag}>"

    for _ in range(200):
        html = f"<html><body><nav><ul><li>Home</li></ul></nav><article><h1>Title</h1>{''.join(inner(4) for _ in range(4))}</article><footer>{LONG}</footer></body></html>"
        assert hd.extract(html) == slow_text(html)


def test_quotes_that_open_no_value():
    assert hd.extract('<p class="a"">Text one is here</p><p class="b"">Text two is here</p>') == "Text one is here Text two is here"
    assert hd.extract("<p title=it's>Hello there</p><p title=it's>World out there</p>") == "Hello there World out there"
    assert hd.extract('<p "quoted" a=\'x>y\' b="1>0">one</p><p = >two</p><p a==b c= >three</p><p/ d>four</p>') == "one two three four"
    assert hd.extract('<p title="never closed>five</p><p>six</p>') == "five six"
    assert hd.extract("<p title = 'a' class=\"x\"y>seven</p>") == "seven"


def test_names_are_those_of_attributes():
    assert hd.extract('<div title="class=nav" data-x="id=menu hidden"><p>kept</p></div>') == "kept"
    assert hd.extract('<div CLASS = nav><p>gone</p></div><p>kept</p>') == "kept"
    assert hd.extract('<div class="a"class="nav"><p>gone</p></div><p>kept</p>') == "kept"


def test_content_with_a_name_of_something_else_is_spared():
    body = f"<p>{LONG}</p>" * 8
    text = " ".join((LONG + " ") * 8).replace("  ", " ").split() and " ".join((LONG + " ").split() * 8)
    for name in ("widget content", "legal", "search-results", "popular", "share", "related", "disclaimer"):
        assert hd.extract(f'<html><body><h1>Title</h1><div id="content" class="{name}">{body}</div><div class="{name}"><p>little</p></div></body></html>').endswith(text), name
    # not so menus, comments and sidebars, nor anything beside an article
    for name in ("comments", "sidebar widget", "nav", "widget comments"):
        assert hd.extract(f'<html><body><div><p>{LONG}</p></div><div class="{name}">{body}</div></body></html>') == " ".join(LONG.split()), name
    assert hd.extract(f'<html><body><article><p>{LONG}</p></article><div class="related">{body}</div></body></html>') == " ".join(LONG.split())


def test_choice_of_subtree_against_the_definition():
    """Trees of divs, paragraphs and links: densities by plain recursion, the subtree with the largest sum, and what stands beside it."""
    import math
    import random

    rng = random.Random(5)

    def tree(depth):
        tag = rng.choice(["div", "div", "p", "span", "a"]) if depth else rng.choice(["p", "span", "a"])
        words = " ".join("x" * rng.randrange(1, 9) for _ in range(rng.choice([0, 1, 5, 40])))
        inner = [tree(depth - 1) for _ in range(rng.randrange(1, 5))] if tag == "div" and depth else []
        return tag, words, inner

    def html(t):
        return f"<{t[0]}>{t[1]}{''.join(map(html, t[2]))}</{t[0]}>"

    def counts(t):
        """(characters, tags, link characters, link tags) of what is in t."""
        c, n, lc, ln = len(t[1].replace(" ", "")), 0, 0, 0
        if t[0] == "a":
            lc = c
        for child in t[2]:
            a, b, d, e = counts(child)
            c, n, lc, ln = c + a, n + b + 1, lc + d, ln + e + (child[0] == "a")
        return c, n, lc, ln

    def density(t, body):
        c, n, lc, ln = counts(t)
        if not c:
            return 0.0
        n, ratio = max(n, 1), body[2] / max(body[0], 1)
        base = math.log(math.log(c / max(c - lc, 1) * lc + ratio * c + math.e)) if math.log(c / max(c - lc, 1) * lc + ratio * c + math.e) > 1.001 else None
        log = math.log(max(c / max(lc, 1) * n / max(ln, 1), 1.0))
        return c / n * (log / base if base else log)

    def text(t):
        block = t[0] in ("div", "p")
        return (" " if block else "") + t[1] + "".join(map(text, t[2])) + (" " if block else "")

    chosen = 0
    for _ in range(150):
        top = ("body", "", [tree(3) for _ in range(rng.randrange(1, 4))])
        body = counts(top)
        nodes, stack = [], [(top, [])]
        while stack:
            t, above = stack.pop()
            nodes.append((t, above))
            stack += [(x, [*above, t]) for x in reversed(t[2])]
        sums = [sum(density(x, body) for x in t[2]) for t, _ in nodes]
        if not body[0]:
            assert hd.extract(f"<html>{html(top)}</html>") == ""
            continue
        if max(sums) == 0:
            continue
        best, above = nodes[sums.index(max(sums))]
        threshold = min(density(x, body) for x in [*above, best])
        pieces = []

        def take(t, inside):
            whole = inside or t is best
            on_path = any(t is x for x in above)
            if not whole and not on_path:
                if density(t, body) >= threshold and density(t, body) > 0 and t[0] == "p":
                    pieces.append(text(t))
                else:
                    pieces.append(" ")
                return
            if whole:
                pieces.append(text(t))
                return
            for x in t[2]:
                take(x, False)

        take(top, False)
        assert hd.extract(f"<html>{html(top)}</html>") == " ".join("".join(pieces).split())
        chosen += best is not top
    assert chosen > 20
