"""Main text of pages of many shapes, each with the blocks that must be kept."""

import pytest

from loadbay.llm import maintext

A = "The harbour was quiet in the early morning, and only two of the boats had already left for the open sea."
B = "Nobody had expected the weather to turn so quickly, but the older fishermen had seen the signs days before."
C = "In the end everyone came home, and the council decided that the light on the pier should be repaired."
NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/news">News</a></li><li><a href="/about">About us</a></li></ul></nav>'
HEAD = f'<header class="site-header"><a href="/">My Site</a>{NAV}</header>'
FOOT = '<footer class="site-footer"><p>Copyright 2020 My Site. All rights reserved.</p><a href="/privacy">Privacy policy</a></footer>'
SIDE = '<aside class="sidebar"><h3>Popular posts</h3><ul><li><a href="/1">One story</a></li><li><a href="/2">Another</a></li></ul></aside>'
COMMENTS = ('<section id="comments"><h3>2 comments</h3><article class="comment"><p>I was there that morning and I can tell you that it was'
            ' a fine sight to see, all those boats.</p></article><article class="comment"><p>Thanks for the story, it was good'
            ' to read about the old harbour again.</p></article></section>')
P = f"<p>{A}</p><p>{B}</p><p>{C}</p>"
ABC = [A, B, C]


def page(body, around=True):
    return f"<html><head><title>T</title></head><body>{HEAD if around else ''}{body}{FOOT if around else ''}</body></html>"


SHAPES = {
    "article": (page(f"<article><h1>Harbour</h1>{P}</article>{SIDE}"), ["Harbour", *ABC]),
    "main": (page(f"<main><h1>Harbour</h1>{P}</main>{SIDE}"), ["Harbour", *ABC]),
    "no tags of meaning": (page(f'<div id="content"><h2>Harbour</h2>{P}</div><div id="sidebar"><a href="/">One</a></div>'), ["Harbour", *ABC]),
    "paragraphs only": (page(P, around=False), ABC),
    "one paragraph": (page(f"<p>{A}</p>", around=False), [A]),
    "comments open": (page(f'<article class="post hentry comments-open">{P}</article>'), ABC),
    "tag in the class": (page(f'<article class="post tag-privacy category-social">{P}</article>'), ABC),
    "search in the id": (page(f'<article id="binary-search">{P}</article>'), ABC),
    "privacy section": (page(f'<main><section id="privacy"><h2>Privacy</h2>{P}</section></main>'), ["Privacy", *ABC]),
    "page builder": (page(f'<main><div class="elementor-widget elementor-widget-text-editor">{P}</div></main>'), ABC),
    "page builder in article": (page(f'<article><div class="elementor-widget-container">{P}</div></article>'), ABC),
    "heading ids": (page(f'<article><h2 id="related-work">Related work</h2>{P}<h2 id="comments">Comments on method</h2>{P}</article>'),
                    ["Related work", *ABC, "Comments on method", *ABC]),
    "math": (page(f"<article><p>We know that <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds for every boat of the fleet.</p>{P}</article>"),
             ["We know that x=2 holds for every boat of the fleet.", *ABC]),
    "comments": (page(f"<article><h1>Harbour</h1>{P}</article>{COMMENTS}"), ["Harbour", *ABC]),
    "comments inside": (page(f"<article><h1>Harbour</h1>{P}{COMMENTS}</article>"), ["Harbour", *ABC]),
    "own header": (page(f'<article><header class="entry-header"><h1>Harbour at dawn</h1></header>{P}</article>'), ["Harbour at dawn", *ABC]),
    "share bar": (page(f'<article>{P}<div class="social-share"><a href="#">Tweet</a> <a href="#">Share this</a></div></article>'), ABC),
    "related posts": (page(f'<article>{P}</article><div class="related-posts"><h3>Related posts</h3><a href="/x">The lighthouse keeper</a></div>'), ABC),
    "related posts inside": (page(f'<article>{P}<section class="related-articles"><p><a href="/x">The lighthouse keeper and his dog</a></p></section></article>'), ABC),
    "cookie notice": (page(f'<div class="cookie-banner"><p>We use cookies to make this site work and to measure how it is used by people.</p><button>Accept</button></div><article>{P}</article>'), ABC),
    "advert": (page(f'<article><p>{A}</p><div class="ad-unit"><p>Buy our new boats now, with low prices all week long and free delivery.</p></div><p>{B}</p></article>'), [A, B]),
    "newsletter": (page(f'<article>{P}</article><div id="newsletter-signup"><p>Sign up for our newsletter and never miss a story about the sea again.</p><form><input></form></div>'), ABC),
    "form": (page(f"<article>{P}</article><form><label>Your name</label><p>Please fill in all of the fields below before you send the form to us.</p></form>"), ABC),
    "script and style": (page(f"<article><script>var a = '<p>no</p>';</script><style>p {{ color: red }}</style>{P}</article>"), ABC),
    "hidden": (page(f'<article>{P}<div style="display: none"><p>{B} Hidden copy of the text for machines.</p></div><p hidden>{A} Not shown.</p></article>'), ABC),
    "lists and quotes": (page(f"<article><p>{A}</p><ul><li>The first of the boats was built by hand.</li><li>The second of them came from the north.</li></ul><blockquote>{B}</blockquote></article>"),
                         [A, "The first of the boats was built by hand.", "The second of them came from the north.", B]),
    "code": (page(f"<article><p>{A}</p><pre>for x in boats:   launch(x)</pre><p>{B}</p></article>"), [A, "for x in boats: launch(x)", B]),
    "table": (page(f"<article><p>{A}</p><table><tr><td>The number of boats in the year</td><td>Twelve boats were counted here</td></tr></table><p>{B}</p></article>"),
              [A, "The number of boats in the year", "Twelve boats were counted here", B]),
    "links in text": (page(f'<article><p>{A} <a href="/more">Read the report of the council</a> for all the details of that night.</p>{P}</article>'),
                      [f"{A} Read the report of the council for all the details of that night.", *ABC]),
    "references": (page(f"<article><p>Tom &amp; Ann&#39;s boat &mdash; caf&eacute; &lt;old&gt; was out on the water all day long.</p>{P}</article>"),
                   ["Tom & Ann's boat — café <old> was out on the water all day long.", *ABC]),
    "breaks": (page(f"<article><p>One line of the long text here,<br>and  another\n line of it, with more words.</p>{P}</article>"),
               ["One line of the long text here, and another line of it, with more words.", *ABC]),
    "sidebar layout": (page(f'<div class="has-sidebar"><div class="content-sidebar-wrap"><main class="content">{P}</main></div></div>{SIDE}'), ABC),
    "breadcrumbs and pages": (page(f'<div class="breadcrumbs"><a href="/">Home</a> &gt; <a href="/n">News</a></div><article>{P}</article><div class="pagination"><a href="/2">Next page</a></div>'), ABC),
    "roles": (page(f'<div role="banner">My Site</div><div role="main">{P}</div><div role="contentinfo">All rights reserved.</div>', around=False), ABC),
    "camel case": (page(f'<div id="siteHeader"><a href="/">Home</a> Welcome to the site</div><div id="mainContent">{P}</div><div id="pageFooter">Copyright 2020 by all of us</div>', around=False), ABC),
    "old tables": (page(f'<table><tr><td class="menu"><a href="/">Home</a><br><a href="/n">News</a></td><td class="text">{P}</td></tr></table>', around=False), ABC),
    "unclosed": (f'<body><div class="nav"><a href="/">Home</a></div><div class="post"><p>{A}<p>{B}<p>{C}', ABC),
    "foreign": (page("<article><p>Der Hafen war am frühen Morgen ganz still, nur zwei der Boote waren schon hinausgefahren.</p></article>"),
                ["Der Hafen war am frühen Morgen ganz still, nur zwei der Boote waren schon hinausgefahren."]),
    "notice inside": (page(f'<article><div class="notice"><p>{A} {B}</p></div>{P}</article>'), ABC),
    "entry footer": (page(f'<article>{P}<div class="entry-footer">Posted in <a href="/n">News</a></div></article>'), ABC),
}


@pytest.mark.parametrize("shape", SHAPES)
def test_shape(shape):
    html, want = SHAPES[shape]
    assert maintext.main_text(html).split("\n\n") == want


def test_there_are_enough_shapes():
    assert len(SHAPES) >= 30
