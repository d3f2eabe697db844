import random
import time

from locusframe.llm import htmltext as h

SCHEMA = "page_id long, url string, html string, text string, place string, id string"


def page(body, n=1):
    words = " ".join(f"word{k}" for k in range(40 * n))
    return f"<html><head><title>T t</title><script>var x='<p>no</p>';</script></head><body><nav><a href='/a'>Menu one</a></nav><div class='ad'>Buy now</div><article><h1>Head &amp; line</h1><p>{words}</p>{body}</article><aside>Side words here</aside><footer>&copy; foot</footer></body></html>", words


def test_extract(spark):
    html, words = page("<p>A<b>b</b> c&nbsp;&lt;d&gt;<br>e</p><div class='comments'><p>first comment</p></div><form>mail <input> go</form><!-- no --><ul><li>x</li><li>y</li></ul><p>open <b>end")
    plain = "<body><div class=menu>a b c</div><div class=content><p>" + "some text " * 30 + "</p></div><div id=footer>foot foot</div></body>"
    rows = [(1, "u", html), (2, "v", None), (3, "w", ""), (4, None, plain), (1, "u", html), (None, "n", "<"), (6, "x", page("", 2000)[0])]
    rows += [(10 + i, "z", page(f"<p>more {i}</p>")[0]) for i in range(5)]
    got = h.extract(spark.createDataFrame([(*r, "t", "p", "i") for r in rows], SCHEMA)).collect()
    assert len(got) == len(rows)
    text = {r["page_id"]: r["text"] for r in got}
    assert text[1] == f"Head & line\n{words}\nAb c <d> e\nx\ny\nopen end"
    assert text[2] == text[3] == "" and text[None] == "<"
    assert text[4] == ("some text " * 30).strip()
    assert text[12] == f"Head & line\n{words}\nmore 2" and len(text[6].split()) == 80_003


def test_tokens():
    """Quotes in unquoted values, unclosed and silent elements, quotes around >."""
    text = lambda p: h.main_text(p, {})
    assert text("<p><a title=it's href=x>one</a> two") == "one two"
    assert text("<datalist><option value=a>no</datalist><p>rest of it</p>") == "rest of it"
    assert text("<select><option>a<option>b</select><p>after</p>") == "after"
    assert text('<p title="a > b">x</p><p data-u=a/b/>y</p><p title=\'">\'>z</p>') == "x\ny\nz"
    assert text("<p>a<script>if (x < 1) '</p>'</script>b\n c</p><style>p{}") == "ab c"
    assert text("<p>1 < 2 &amp;&lt; <3</p>") == "1 < 2 &< <3"
    assert text("<article><p>kept so far</p><ul><li><a href=/x>two words</a><li><a href=/y>two more</a></ul></article>") == "kept so far\ntwo words\ntwo more"
    assert text("<article><p>kept as it is</p><div class=comments><p>not kept</p></div><p>kept too</p></article>") == "kept as it is\nkept too"
    assert text('<a b="' * 2000 + "x") is not None


def test_names_do_not_empty_pages():
    """Names that only contain a boilerplate word, and containers around the content, take nothing away."""
    text = lambda p: h.main_text(p, {})
    assert text('<body class="no-sidebar"><article><p>Hello world.</p></article></body>') == "Hello world."
    assert text('<body class="sidebar menu"><article class="post ad-free"><p>Hello world.</p></article></body>') == "Hello world."
    assert text('<main class="layout-with-sidebar" id="comments"><p>Hello world.</p></main>') == "Hello world."
    assert text('<div class="widget banner"><article><p>Hello world.</p><div class="comment-list"><p>said one</p></div></article></div>') == "Hello world."
    assert text('<article><p>Hello world.</p><section class="related-work"><p>Others did it.</p></section></article>') == "Hello world.\nOthers did it."
    assert text('<article><p>Some words of it</p></article><div class="comments"><article class="comment"><p>a reader said so</p></article></div>') == "Some words of it"
    names = [h._known(n) for n in ("ad", "ad-box", "site-footer", "comment-list", "share_buttons", "ad-free", "no-sidebar", "related-work", "post", "main-content", "")]
    assert names == [True] * 5 + [False] * 6


def test_broken_markup_is_linear():
    """Unclosed tags, quotes and elements: four times the page, about four times the time."""
    for unit in ("<a ", '<p a="', "<p a='\"", '<a b=">', "<div>", "<div><x>", "</x><div>", "<!", "<a =", "<b a=\"'<", "<script "):
        took = []
        for size in (60_000, 240_000):
            page = unit * (size // len(unit))
            began = time.process_time()
            h.main_text(page + ("</y>" * (size // 8) if unit == "<div>" else ""), {})
            took.append(time.process_time() - began)
        assert took[1] < 9 * took[0] + 0.5, (unit, took)
    began = time.process_time()
    h.main_text('<p a="' * 170_000, {})
    assert time.process_time() - began < 15


def test_broken_markup_is_read_as_before():
    """Stepping through a tag ends where the pattern for whole tags does."""
    rng = random.Random(3)
    for _ in range(3000):
        page = "".join(rng.choice(("<a", "<p ", "b=", '"', "'", ">", " ", "x", "=", "/", "<", "</p", "\n")) for _ in range(rng.randint(1, 25)))
        want, at = [], 0
        while at < len(page):
            m = h.TOKEN.match(page, at)
            want.append(m[0])
            at = m.end()
        got, broken = [], h.Broken(page)
        at = 0
        while at < len(page):
            head = h.NAME.match(page, at)
            end = broken.tag_end(head.end()) if head else 0
            end = end or (at + 1 if head else h.TOKEN.match(page, at).end())
            got.append(page[at:end])
            at = end
        assert got == want


def simple(page):
    """The main text by a parser of its own: blocks of the first article, without elements of known names."""
    from html.parser import HTMLParser

    class P(HTMLParser):
        def __init__(self):
            super().__init__(convert_charrefs=True)
            self.stack, self.out = [], [""]

        def handle_starttag(self, tag, attrs):
            if tag == "br":
                self.out[-1] += " "
                return
            if tag not in h.INLINE:
                self.out.append("")
            names = " ".join(v or "" for k, v in attrs if k in ("class", "id", "role")).split()
            drop = tag in ("nav", "aside", "footer", "form", "script", "style") or (tag == "div" and bool({"ad", "comments", "share-bar"} & set(names)))
            self.stack.append((tag, drop))

        def handle_endtag(self, tag):
            if tag not in h.INLINE:
                self.out.append("")
            while self.stack and self.stack.pop()[0] != tag:
                pass

        def handle_data(self, data):
            if any(t == "article" for t, _ in self.stack) and not any(d for _, d in self.stack):
                self.out[-1] += data

    p = P()
    p.feed(page)
    return "\n".join(b for b in (" ".join(x.split()) for x in p.out) if b)


def test_by_brute_force(spark):
    """Generated pages, with layout names that hold words of boilerplate, against a parser that knows the answer."""
    rng = random.Random(12)
    words = lambda n: " ".join(f"w{rng.randrange(500)}{rng.choice(['', '', '&amp;', ' <b>bold</b>', '<br>'])}" for _ in range(n))
    odd = lambda: rng.choice(["", "", ' class="no-sidebar"', ' class="with-comments post"', ' id="ad-free"', ' class="related-work"'])
    rows = []
    for i in range(400):
        blocks = [f"<p>{words(rng.randint(5, 30))}</p>" for _ in range(rng.randint(2, 6))]
        blocks.insert(rng.randrange(len(blocks)), f"<section{odd()}><h2>{words(3)}</h2><p>{words(9)}</p></section>")
        blocks.insert(rng.randrange(len(blocks)), rng.choice(["", '<div class="ad"><p>buy this now</p></div>', '<div class="share-bar">share it</div>', "<form>mail <input></form>"]))
        side = f"<aside{odd()}><p>{words(6)}</p></aside>"
        page = f"<html><body{odd()}><nav><a href=/>{words(4)}</a></nav>{rng.choice([side, ''])}<article{odd()}><h1>{words(4)}</h1>{''.join(blocks)}<div class=comments><p>{words(12)}</p></div></article>{rng.choice([side, ''])}<footer>{words(5)}</footer></body></html>"
        rows.append((i, "u", page, "t", "p", "i"))
    got = {r["page_id"]: r["text"] for r in h.extract(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert [i for i, _, page, *_ in rows if got[i] != simple(page)] == []


def test_region_is_the_best():
    rng = random.Random(1)
    for _ in range(200):
        scores = [rng.choice((-2.0, -1.0, -0.5, 1.0, 2.0)) for _ in range(rng.randrange(25))]
        start, end = h.best_region(scores)
        sums = [sum(scores[a:b]) for a in range(len(scores)) for b in range(a, len(scores) + 1)]
        assert sum(scores[start:end]) == max([0.0, *sums])


def test_learned_weights(spark):
    """Places and tags outside the marked content turn negative, and no tag is positive."""
    rows = [(i, "u", f"<body><div class=xq{i % 2}><em>left out {i}</em></div><article><p>some words {i} here</p></article><table><td>cell</table></body>", "t", "p", "i") for i in range(40)]
    weights = h.fit(spark.createDataFrame(rows, SCHEMA))
    assert weights["text", "article"] > 0 > max(weights["text", "div.xq0"], weights["text", "table"])
    tags = {w: x for (k, w), x in weights.items() if k == "tag"}
    assert all(x < 0 for x in tags.values()) and tags["article p"] > tags["table td"] == tags["div.xq0 em"]
    # The same places without the marks.
    assert h.main_text("<body><div class=xq1>no words here</div><section><p>yes these</p></section><table><td>nor this</table></body>", weights) == "yes these"


def test_empty(spark):
    assert h.extract(spark.createDataFrame([], SCHEMA)).collect() == []
