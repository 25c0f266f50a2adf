import random
import time

from tidemark.llm.html_extract import digest_of, digest_of_path, extract, parse, path_of, text_of

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{margin:0}</style><script>var t="</p>";</script></head><body class="c12">
<nav><ul><li><a href="/x">menu</a></li></ul></nav><!-- ad --><div class="ad">buy &amp; go</div><header><h2>Site</h2></header>
<div class="post-7 body"><article><h1>Title &lt;one&gt;</h1><p><b>First
  part&nbsp;here.<br><p>Second <a href='a>b'>link</a> &#233;<ul><li>one<li>two</ul><form><input value="x">send</form>
<aside>side</aside><div class="commentList"><p>reader</p></div><table><tr><td>c1<td>c2</table></article></div>
<div id="cookie-notice">we use</div><footer>&copy; end</footer>"""
WANT = "Title <one>\nFirst part here.\nSecond link é\none\ntwo\nc1\nc2"


def test_blocks():
    assert text_of(parse(PAGE), None) == WANT


def test_broken_pages():
    for page in ("", "<", "<p", "plain", "</p></div>x", "<p>a<p", "<!-- open", "<script>x", "<article><p>a</article></article><p>", "<div " * 50, "<a<b<c>>>" * 20, "<div>" * 3000 + "deep", "&#xD800;&#0;&bogus;"):
        text_of(parse(page), None)
    assert text_of(parse("plain"), None) == "plain" and text_of(parse("<p>a &amp;lt; b"), None) == "a &lt; b"


def test_host_votes_decide(spark):
    usual = "<body><div class='main1'><p>{}</p></div><div class='extra'><p>{}</p></div></body>"
    rows = [(i, "https://a.org/%d" % i, usual.format("long text " * 20, "x")) for i in range(4)]
    rows += [(9, "https://a.org/odd", usual.format("short", "a long note that is no article " * 20)), (10, "http://b.org", "<p>only"), (11, None, None), (12, "x", ""), (None, "https://a.org/1", usual.format("t", "u"))]
    pages = spark.createDataFrame([(h, i, u, "q") for i, u, h in rows], "html string, page_id long, url string, path string").repartition(3)
    got = {(r.page_id, r.url): r.text for r in extract(spark, pages).collect()}
    assert len(got) == len(rows)
    assert got[9, "https://a.org/odd"] == "short" and got[10, "http://b.org"] == "only" and got[11, None] == "" == got[12, "x"] and got[None, "https://a.org/1"] == "t"
    assert extract(spark, pages.filter("page_id = 77")).collect() == []


def test_given_pages(spark):
    import re
    from html import unescape

    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    html = {r.page_id: r.html for r in pages.collect()}
    for r in extract(spark, pages).collect():
        inner = re.search(r"<article>(.*?)</article>", html[r.page_id], re.S)[1]
        blocks = [" ".join(unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", inner)]
        assert r.text == "\n".join(b for b in blocks if b)


def test_title_and_lead_of_a_long_text_stay(spark):
    page = "<body><div class=menu2><a href=/>home</a> <a href=/b>all of the posts</a></div><div class=post><h1>Title {0}</h1><p>Lead {0}</p><div class=wrap><div class=body>{1}</div></div></div><div class=links><a href=/c>one more post</a></div></body>"
    long = "".join(f"<p>{'many words ' * 30}{k}</p>" for k in range(20))
    rows = [(i, f"http://a.org/{i}", page.format(i, long if i else "<p>short</p>")) for i in range(4)]
    got = {r.page_id: r.text.split("\n") for r in extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[0] == ["Title 0", "Lead 0", "short"]
    assert all(got[i][:2] == [f"Title {i}", f"Lead {i}"] and len(got[i]) == 22 for i in (1, 2, 3))
    assert text_of(parse(f"<h1>Title</h1><p>Lead</p><div>{long}</div>"), None).startswith("Title\nLead\nmany")


LONG = "".join(f"<p>{'many words of an article ' * 8}{k}</p>" for k in range(6))
LONG_TEXT = "\n".join(f"{'many words of an article ' * 8}{k}" for k in range(6))


def test_names_of_states_and_wrappers_keep_the_article():
    for page in (
        f'<div class="site no-sidebar"><h1>T</h1>{LONG}</div>',
        f'<main class="has-sidebar"><h1>T</h1>{LONG}<div class="sidebar">x</div></main>',
        f'<article class="post comments-open"><h1>T</h1>{LONG}<section class="comments"><p>reader</p></section></article>',
        f'<form id="aspnetForm"><div id="nav-menu">m</div><div class="page"><h1>T</h1>{LONG}</div><input><button>go</button></form>',
        f'<div class="promo-theme"><div class="main"><h1>T</h1>{LONG}</div><div class="promo">buy</div></div>',
        f'<head><title>t</title><body><div id="sidebar-left-page"><article><h1>T</h1>{LONG}</article><div class="related-posts">r</div></div>',
        f'<div class="post"><header class="entry-header"><h1>T</h1></header>{LONG}</div><header class="site-header">Site</header>',
    ):
        assert text_of(parse(page), None) == f"T\n{LONG_TEXT}", page[:60]
    assert text_of(parse(f"<article><p class='promotion'>To a higher rank</p>{LONG}<p class='ad'>buy</p></article>"), None) == f"To a higher rank\n{LONG_TEXT}"
    assert text_of(parse("<article></article><div class='cookie-notice'><p>We use cookies.</p></div>"), None) == ""


def test_hosts_with_long_comments(spark):
    comments = "".join(f"<article class='comment-body'><p>{'a reader says much ' * 20}</p></article>" for _ in range(20))
    page = "<div id=page{0}><div class='content'><h1>T{0}</h1><p>Short post number {0}.</p></div><div id='comments' class='comments-area'>{1}</div></div>"
    rows = [(i, f"http://a.org/{i}", page.format(i, comments if i % 3 == 0 else "")) for i in range(9)]
    got = {r.page_id: r.text for r in extract(spark, spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got == {i: f"T{i}\nShort post number {i}." for i in range(9)}


def generated(r):
    """A page of random wrappers and noise, and the text that its article has."""
    words = lambda n: " ".join(r.choice("alpha beta gamma delta epsilon zeta".split()) for _ in range(n))
    blocks, source = [], ""
    for _ in range(r.randint(3, 9)):
        kind, text = r.choice(["p", "h2", "blockquote", "li", "pre", "div"]), words(r.randint(5, 40))
        inner = text.replace("beta", r.choice(["<b>beta</b>", "<a href='/x'>beta</a>", "be&#116;a", "<span>be</span>ta"])).replace(" zeta", r.choice(["<br>zeta", "  zeta", "\n\tzeta", "&nbsp;zeta"]))
        source += f"<ul><li>{inner}</ul>" if kind == "li" else f"<{kind}>{inner}</{kind}>"
        blocks.append(text)
        if r.random() < 0.3:
            source += r.choice(["<aside>aside text</aside>", "<div class='share-buttons'>tweet</div>", "<form><label>mail</label><input>now</form>", "<script>var x = '<p>';</script>", "<div class='ad-slot'><p>buy</p></div>", "<!-- <p>no</p> -->", "<figure><img src=x></figure>"])
    core = r.choice(["<article>{}</article>", "<main class='has-sidebar'>{}</main>", "<div class='entry-content'>{}</div>", "<div class='story no-comments'><div class='body'>{}</div></div>"]).format(source)
    comments = r.choice(["", "<section id='comments'><p>one reader</p><p>other</p></section>", "<ol class='comment-list'><li>a reader</ol>"])
    for _ in range(r.randint(0, 3)):
        core = r.choice(["<div class='site with-sidebar'>{}</div>", "<form id='f'>{}</form>", "<div id='wrap-{}'>{{}}</div>".format(r.randint(1, 99)), "<section class='layout-sidebar'>{}</section>", "<table><tr><td>{}</td></tr></table>"]).format(core)
    before = r.choice(["", "<nav><a href=/>home</a></nav>", "<header><p>Site name</p></header>", "<div class='top-menu'><a href=/a>one</a></div>"])
    after = r.choice(["", "<footer>the end</footer>", "<div id='footer'>the end</div>", "<div class='sidebar'><p>about us</p></div>"])
    return f"<html><head><title>x</title></head><body>{before}{core}{comments}{after}</body></html>", "\n".join(blocks)


def test_generated_pages():
    r = random.Random(21)
    for _ in range(400):
        page, want = generated(r)
        assert text_of(parse(page), None) == want, page


def test_paths_and_digests_agree():
    r = random.Random(22)
    for _ in range(50):
        page = parse(generated(r)[0])
        for k in range(len(page.regions)):
            e = page.regions[k].element
            assert digest_of(e) == digest_of_path(path_of(e))


def test_hostile_pages_take_linear_time():
    for part in ("<b>", "<div>", "<div class='a b c'>", "<i></b>", "<b><hr>", "<div></dd>", "<dd><div></dt>", '<a ">" ', "<a '", "<td></i><i>", "<li><div>", "a=", "<p x ", "&#", "</script ", "<script ", "<p " + "a" * 50 + " "):
        for page in (part * (600_000 // len(part)), "<p " + part * (600_000 // len(part)) + ">x"):
            began = time.time()
            text_of(parse(page), None)
            assert time.time() - began < 6, part
    assert text_of(parse("<p>a &#" + "9" * 6000 + "; b &#x" + "F" * 9000 + ";"), None).startswith("a ")
