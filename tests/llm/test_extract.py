"""Main text in pages whose layout names and nesting are odd."""

import pytest

from roadloom.llm import html_extract


def text(page):
    nodes = html_extract.containers(page)
    return html_extract.text_at(nodes, html_extract.best(nodes).path)


BODY = "One sentence, and more. " * 20
NAMES = ["border-bottom", "align-bottom", "overflow-hidden", "content-sidebar-wrap", "right-sidebar-layout", "side-by-side", "search-results-list", "sidebar"]


@pytest.mark.parametrize("name", NAMES)
@pytest.mark.parametrize("inner", ["article", "main", "div"])
def test_layout_names_keep_the_text(name, inner):
    page = f"<body><div class='{name}'><{inner}><p>{BODY}</p></{inner}></div><div class=site-footer><p>Us, here.</p></div></body>"
    assert text(page) == BODY.strip()


@pytest.mark.parametrize("name", ["sidebar", "site-footer", "comment-list", "bottom", "hidden"])
def test_parts_by_name_stay_outside(name):
    for inner in ("article", "div"):
        assert text(f"<body><{inner}><p>{BODY}</p></{inner}><div class={name}><article><p>Not this, no.</p></article></div></body>") == BODY.strip()


def test_math_is_text():
    assert text(f"<article><p>{BODY}<math><mi>x</mi><mo>=</mo><mn>1</mn></math></p></article>") == BODY + "x=1"


PART = "A part, of the text. " * 50


@pytest.mark.parametrize("tag", ["div", "main"])
def test_nested_sections_are_whole(tag):
    inner = "".join(f"<section id=s{i}><section id=t{i}><section id=u{i}><p>{PART}</p></section></section><section id=v{i}><p>{PART}</p></section></section>" for i in "bc")
    page = f"<body><div id=top><a href=x>Go, on</a></div><{tag}><section id=a>{inner}</section></{tag}></body>"
    assert text(page) == (PART * 4).strip()


def test_mixed_block_classes_are_whole():
    blocks = "".join(f"<div class={c}><div class=inner><div class=deep><p>{PART}</p></div></div></div>" for c in ("paragraph", "quote", "paragraph", "figure"))
    assert text(f"<body><div class=page>{blocks}</div><div class=sidebar><p>Side.</p></div></body>") == (PART * 4).strip()


def test_all_classes_are_in_the_path():
    nodes = html_extract.containers(f"<body><div class='d c b a'><p>{BODY}</p></div></body>")
    assert html_extract.best(nodes).path.endswith("div.a.b.c.d")


def test_elements_that_close_themselves_hold_nothing():
    for tag in ("svg", "math", "path", "use"):
        assert text(f'<p>One <{tag} class="i"/> two</p><p>Three.') == "One two Three."
    assert text("<p>One <svg><title>no</title><path/><svg/></svg> two</p><p>Three.") == "One two Three."
    assert text("<template><p>no</p><template>no</template></template><p>yes") == "yes"


def test_a_form_around_the_page_is_no_part():
    for name in ("", " class='search'", " id='aspnetForm' class='form'"):
        page = f"<body><form{name}><div id=a><p>{BODY}</p><input></div></form></body>"
        assert text(page) == BODY.strip()
    assert text(f"<body><div><p>{BODY}</p></div><form><label>Your name, please.</label></form></body>") == BODY.strip()
    assert text(f"<body><form><article><p>{BODY}</p></article></form></body>") == BODY.strip()


@pytest.mark.parametrize("name", ["article-side-image", "form-text", "bottom-line", "border-bottom"])
def test_names_of_content_keep_their_paragraph(name):
    assert text(f"<body><div><p>{BODY}</p><div class={name}><p>One more, here.</p></div></div></body>") == BODY + "One more, here."


def test_references_are_decoded_within_a_run_of_text():
    assert text("<p>a &<b>lt;</b> c &amp;lt; &#65;&copy") == "a &lt; c &lt; A©"


def test_headers_in_articles_go():
    assert text(f"<article><header><h1>Title</h1></header><p>{BODY}</p></article>") == BODY.strip()


def test_deep_pages_take_linear_time_and_memory():
    import time
    import tracemalloc

    for page in ("<div>" * 20_000 + "x", "<div>" * 3000 + "<p>short. one</p>" * 9000 + "</div>" * 3000, "<div class=sidebar>" * 20_000 + "y", "<b>" * 20_000 + "<p>z"):
        began = time.perf_counter()
        html_extract.text_at(nodes := html_extract.containers(page), html_extract.path_key(html_extract.best(nodes).path))
        assert time.perf_counter() - began < 5
        tracemalloc.start()
        html_extract.vote(page)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 100 << 20


def test_path_keys_of_steps():
    nodes = html_extract.containers(f"<body><div class='w-1/2 x'><div id='é 9'><p>{BODY}</p></div></div></body>")
    for node in nodes:
        assert html_extract.text_at(nodes, html_extract.path_key(node.path)) == html_extract.text_at(nodes, node.path)


#: Page layouts without an article element: what stands around the text, and how it is nested.
LAYOUTS = [
    ("<div id=page><div class='post post-{i}'>", "</div></div>"), ("<main>", "</main>"), ("<div class='content-sidebar-wrap'><div class=entry-content><section>", "</section></div></div>"),
    ("<table><tr><td class=left><a href=x>Go</a></td><td class=text>", "</td></tr></table>"), ("<form id=f><div class=body>", "</div></form>"), ("<div><div><div><div id=story{i}>", "</div></div></div></div>"),
]
SPLIT = [("", ""), ("<div class=part>", "</div>"), ("<section id=s{k}>", "</section>")]
CLUTTER = "<div class=sidebar><h3>More</h3><p>Read this too, and that, they say.</p></div><div class='comments'><p>I agree, with all of it. Nice, really.</p></div><div class=cookie-notice>We use cookies.</div>"


def test_recall_and_precision_without_articles(spark, sf_dir):
    """The fixture's pages, their article elements replaced by each host's own layout: words found and words wrong."""
    import re
    import zlib
    from collections import Counter

    from pyspark.sql import functions as F

    pages = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/pages.parquet")
    whole = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    rows = []
    for r in pages.collect():
        host = zlib.crc32(re.sub("^[a-z]+://([^/]*).*", r"\1", r.url or "").encode())
        (before, after), (head, tail) = LAYOUTS[host % 6], SPLIT[host // 6 % 3]
        k = iter(range(10**6))
        html = re.sub("(<p>.*?</p>)", lambda m: head.format(k=next(k)) + m[1] + tail, r.html or "", flags=re.DOTALL)
        html = html.replace("<article>", "<div class=top><a href=a>Home</a></div>" + before.format(i=r.page_id)).replace("</article>", after + CLUTTER)
        rows.append((r.page_id, r.url, html))
    got = html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).withColumn("n", F.length("text")).collect()
    found = told = there = exact = 0
    for r in got:
        a, b = Counter(r.text.split()), Counter(whole[r.page_id].split())
        found, told, there, exact = found + (a & b).total(), told + a.total(), there + b.total(), exact + (r.text == whole[r.page_id])
    print("pages", len(got), "word recall", found / there, "word precision", found / told, "pages equal", exact / len(got))
    assert found >= 0.98 * there and found >= 0.98 * told


COMMENT = "<div class=comment><p>I read this twice, and I don't agree at all. What about the others, please?</p></div>"


@pytest.mark.parametrize("before, after", [("<div id=comments>", "</div>"), ("<ol class=commentlist>", "</ol>"), ("<section id=comments><h2>Comments</h2>", "</section>"), ("<div class='comments-area'>", "</div>"), ("<div id=disqus_thread>", "</div>"), ("<div class=post-comments>", "</div>")])
@pytest.mark.parametrize("entry", ["<div class=entry><p>{}</p></div>", "<div class=post><div class=body><p>{}</p></div></div>", "<p>{}</p>"])
def test_comments_longer_than_the_article_stay_outside(before, after, entry):
    article = "Only one paragraph, which is the whole of the article. It has two sentences, or three. This is it."
    for n in (3, 6, 60):
        assert text(f"<body><div id=page>{entry.format(article)}{before}{COMMENT * n}{after}</div></body>") == article


@pytest.mark.parametrize("name", ["related-work", "search-trees", "linear-search", "social-impact", "comment-syntax", "navigation", "widgets", "the-menu", "advertising-and-law", "cookies"])
@pytest.mark.parametrize("before, after", [("<section id='{}'>", "</section>"), ("<div class='section' id='{}'>", "</div>"), ("<section id='{}' class='level2'>", "</section>")])
def test_ids_made_from_headings_keep_their_sections(name, before, after):
    """As documentation tools and converters write them."""
    inner = f"{before.format(name)}<h2 id='{name}-1'>A heading</h2><p id='share-prices-fell'>{BODY}</p>{after}"
    for outer in ("article", "main", "div"):
        assert text(f"<body><{outer}><p>{BODY}</p>{inner}</{outer}><div class=site-footer><p>Us, here.</p></div></body>") == f"{BODY}A heading {BODY}".strip()


@pytest.mark.parametrize("part", ["<div class='cookie-recipe'>{}</div>", "<div class='ad-hoc-networks'>{}</div>", "<p class='menu-item'>{}</p>", "<h2 id='social-impact'>{}</h2>", "<p id='share-prices-fell'>{}</p>", "<span class='comment'>{}</span>", "<h3><span id='Related_topics'>{}</span></h3>"])
def test_names_of_content_in_articles_stay(part):
    assert text(f"<body><article><p>{BODY}</p>{part.format('One more, here.')}</article></body>") == BODY + "One more, here."


@pytest.mark.parametrize("part", ["<section id=related><a href=a>One story here</a> <a href=b>Another one</a></section>", "<div class='search-our-archive'><input name=q>Find it</div>", "<div class='social-networks-bar'><a href=x>Ours, there</a></div>", "<p class=advertisement>Buy this, now.</p>", "<div class='share-buttons'><p>Share this.</p></div>", "<ul class='footer-links'><li>Us</li></ul>"])
def test_parts_in_articles_go(part):
    assert text(f"<body><article><p>{BODY}</p>{part}</article></body>") == BODY.strip()


@pytest.mark.parametrize("comment", ["<!-->", "<!--->", "<!-- a --!>", "<!-- a > b -->", "<!---- -->", "<!-- <p>no</p> -->"])
def test_comments_of_the_markup_end_as_in_html(comment):
    assert text(f"<body><article><p>{BODY}</p>{comment}<p>One more.</p><!-- x --></article></body>") == BODY + "One more."


@pytest.mark.parametrize("tag", ["script", "style", "textarea"])
@pytest.mark.parametrize("end", ["</{}>", "</{} >", "</{}\n>", "</{} foo>", "</{}/>", "</{} a='b'>"])
def test_raw_elements_end_as_in_html(tag, end):
    page = f"<body><article><p>{BODY}</p><{tag}>var a = '</{tag}x>' + '<p>no</p>';{end.format(tag.upper())}<p>One more.</p></article></body>"
    assert text(page) == BODY + "One more."


def test_recall_with_long_comments_and_ids_from_headings(spark, sf_dir):
    """The fixture's pages without article elements: sections named after their words, comments longer than the article."""
    import re
    from collections import Counter

    from pyspark.sql import functions as F

    pages = spark.read.parquet(f"{sf_dir.replace('0.001', '0.01')}/pages.parquet")
    whole = {r.page_id: r.text for r in html_extract.extract(pages).collect()}
    kinds = {"markup": "<section id='{}'>", "converter": "<div class='section level2' id='{}'>", "wiki": "<h2><span id='{}'></span></h2><div>"}
    words = ["related-work", "search-trees", "social-impact", "share-prices", "cookie-law", "header-files", "on-navigation", "menu-planning"]
    for name, head in kinds.items():
        rows = []
        for r in pages.collect():
            k = iter(range(10**6))
            tail = "</section>" if head.startswith("<section") else "</div>"
            html = re.sub("(<p>.*?</p>)", lambda m, k=k, head=head, tail=tail: head.format(words[next(k) % 8]) + m[1] + tail, r.html or "", flags=re.DOTALL)
            size = max(1, 2 * len(whole[r.page_id]) // len(COMMENT))
            rows.append((r.page_id, r.url, html.replace("<article>", "<div class=entry>").replace("</article>", f"</div><div id=comments>{COMMENT * size}</div>")))
        got = html_extract.extract(spark.createDataFrame(rows, "page_id bigint, url string, html string")).withColumn("n", F.length("text")).collect()
        found = told = there = 0
        for r in got:
            a, b = Counter(r.text.split()), Counter(whole[r.page_id].split())
            found, told, there = found + (a & b).total(), told + a.total(), there + b.total()
        print(name, "pages", len(got), "word recall", found / there, "word precision", found / told)
        assert found >= 0.98 * there and found >= 0.98 * told
