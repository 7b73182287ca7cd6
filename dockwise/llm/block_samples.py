"""The small labelled table for block classification: pages whose blocks were marked by hand.

Each sample is (page, marks): one mark per text block in page order, 1 for main text and 0
for the rest. The words mean nothing; lengths, links and surroundings do.
"""

from __future__ import annotations

_LONG = "The river rose again in the second week and the lower fields stood under water until the wind turned to the east. "
_MID = "Nobody had expected the bridge to hold for so long."
_NAV = '<nav><ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">About us</a></li></ul></nav>'
_FOOT = "<footer>&copy; example.org &middot; All rights are reserved by the owner of this site and its partners.</footer>"

SAMPLES = [
    # article with menu, advert and footer
    (f"{_NAV}<div class='ad'>Buy two pairs of boots and get one free today only.</div><article><h1>Water in the fields</h1>"
     f"<p>{_LONG * 3}</p><p>{_MID}</p><p>Then it held.</p><p>{_LONG}</p></article>{_FOOT}",
     "000 0 1 1111 0"),
    # very short article
    (f"{_NAV}<div class='ad banner'>{_LONG}</div><article><h1>Short</h1><p>Yes.</p></article>{_FOOT}", "000 0 11 0"),
    (f"{_NAV}<article><h2>One line</h2></article>{_FOOT}", "000 1 0"),
    # title in a header of the article, site header and long footer
    (f"<header><div>The Valley Paper</div>{_NAV}</header><main><article><header><h1>High water</h1></header><p>{_LONG * 2}</p>"
     f"<p>No one was hurt.</p><footer>Filed under weather and rivers</footer></article></main><footer>{_LONG}</footer>",
     "0000 1 11 0 0"),
    # sidebar, notice, newsletter form, comments
    (f"<div class='cookie-notice'>We use cookies to improve what you see here. <a href='#'>More</a></div><main><h1>Harvest</h1>"
     f"<p>{_LONG}</p><p>{_MID} <a href='/w'>See the map</a> of the valley for the fields that were lost.</p></main>"
     f"<aside><h3>Most read</h3><p>{_LONG}</p></aside><form><label>Your address</label><p>Write to us</p></form>"
     f"<section class='comments'><h3>Comments</h3><p>{_LONG}</p><p>I was there too.</p></section>",
     "0 1 11 00 00 000"),
    (f"<main><article><h1>Bridges</h1><p>{_MID}</p><ul><li>stone</li><li>iron and wood</li></ul><p>{_LONG}</p>"
     f"<div class='share'>Share this</div><div class='related'><a href='/1'>Older bridges</a></div></article>"
     f"<div id='comments'><p>{_MID}</p><p>{_LONG * 2}</p></div></main>",
     "1 1 11 1 0 0 00"),
    # no article element: words and links decide
    (f"<div><a href='/'>Home</a> <a href='/n'>News</a> <a href='/x'>Sport</a></div><div><p>{_LONG * 2}</p><p>{_LONG}</p>"
     f"<p>{_MID} {_MID}</p></div><div><a href='/i'>Imprint</a> <a href='/p'>Privacy</a></div><div>Version 3</div>",
     "0 111 0 0"),
    (f"<table><tr><td><a href='/1'>One</a></td><td><a href='/2'>Two</a></td></tr></table><p>{_LONG}</p><p>{_LONG * 4}</p>"
     f"<p>{_MID} {_LONG}</p><p><a href='/3'>Read the next part of this long story here</a></p><div>Tel. 12 34</div>",
     "00 111 0 0"),
    (f"<ul><li><a href='/1'>{_MID}</a></li><li><a href='/2'>{_MID}</a></li><li><a href='/3'>{_MID}</a></li></ul>"
     f"<h1>On the water</h1><p>{_LONG * 2}</p><p>{_LONG}</p><div>Login</div>",
     "000 1 11 0"),
    # links and long texts inside boilerplate, links inside the article
    (f"<div class='sidebar'><p>{_LONG * 2}</p><p>{_MID}</p></div><article><h1>Links</h1><p><a href='/l'>A list of all mills</a></p>"
     f"<p>{_LONG}</p><h2>Mills</h2><p>{_MID}</p></article><div class='menu'><p>{_MID}</p></div>",
     "00 1 1 1 1 1 0"),
    (f"<div class='promo'>{_LONG}</div><main><h1>Tides</h1><p>{_MID}</p><blockquote>{_MID}</blockquote><p>End.</p></main>"
     f"<div>{_MID}</div><div>{_LONG * 2}</div>{_FOOT}",
     "0 1 1 1 1 0 0 0"),
    # nothing after the article, or nothing but it; cut off before its end
    (f"{_NAV}<article><h1>Last</h1><p>{_LONG}</p><p>{_MID}</p></article>", "000 1 1 1"),
    (f"<article><h1>Only this</h1><p>{_MID}</p><p>So.</p></article>", "1 1 1"),
    (f"<div class='ad'>{_MID}</div><main><p>{_LONG * 2}</p><p>And so the", "0 1 1"),
    (f"<main><p>So.</p></main><div>{_LONG}</div><div>{_MID}</div>", "1 0 0"),
    (f"<p>{_LONG}</p><p>{_LONG * 2}</p>", "1 1"),
    (f"<div><a href='/'>Home</a></div><h1>Plain page</h1><p>{_LONG}</p><p>{_MID} {_LONG}</p>", "0 1 1 1"),
    # wrappers named after their layout or a search; unwritten ends; an apostrophe in a value
    (f"{_NAV}<div class='content with-sidebar'><p>{_LONG}</p><p>{_MID} {_LONG}</p></div><div class='sidebar'><p>{_LONG}</p></div>",
     "000 11 0"),
    (f"{_NAV}<div class='search share'><main><h1>Mills</h1><p title=don't>{_LONG}</p><p>{_MID}</p></main></div>{_FOOT}",
     "000 1 11 0"),
    (f"<article><p>{_MID}</p><svg class='i'/><p>{_LONG}</p><datalist><option value=a>A<option value=b>B</datalist><p>{_LONG}</p>"
     f"<svg><p>{_MID}</p></article><section class='comments'><article><p>{_LONG}</p></article></section>",
     "1 1 1 1 0"),
    # no article or main element: short paragraphs, lists, tables, code, captions
    ("<p>One short line.</p>", "1"),
    ("<p>Yes.</p><p>No.</p>", "1 1"),
    (f"<div><a href='/'>Home</a> <a href='/n'>News</a></div><h1>Tools</h1><p>{_MID}</p><ul><li>a saw</li><li>two planes</li></ul>"
     f"<pre>cut --twice board</pre><p>So.</p><div><a href='/i'>Imprint</a></div><div>Version 3</div>",
     "0 1 1 1 1 1 1 0 0"),
    (f"<ul><li><a href='/1'>Home</a></li><li><a href='/2'>Shop</a></li></ul><h2>Heights</h2><table><tr><th>mill</th><th>feet</th></tr>"
     f"<tr><td>upper</td><td>12</td></tr><tr><td>lower</td><td>4</td></tr></table><p>{_LONG}</p>",
     "00 1 11 11 11 1"),
    (f"<div class='menu'><p>Home</p><p>Shop</p></div><blockquote>{_MID}</blockquote><dl><dt>Weir</dt><dd>a low dam</dd></dl>"
     f"<figure><figcaption>The weir in May</figcaption></figure><p>{_LONG * 2}</p><div class='footer'><p>Made in the valley</p></div>",
     "00 1 1 1 1 1 0"),
    (f"<h1>Notes</h1><p>{_LONG}</p><ol><li>{_MID}</li><li>Rest.</li></ol><p>{_MID}</p><div><a href='/up'>Back to the top</a></div>",
     "1 1 11 1 0"),
    (f"<div>{_LONG * 2}</div><div>{_LONG}</div><div>Tel. 12 34</div>", "1 1 0"),
]
