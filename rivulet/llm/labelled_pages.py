"""Labelled pages from which the extraction model is trained.

``x-main`` marks an element whose blocks are main text, ``x-not`` one within it whose
blocks are not. Invented pages of the common layouts; the attributes are labels only
and never features.
"""

_S = "The council met on Tuesday to discuss the new bridge, which had been closed for repairs since March. "
_L = "Residents said that the detour had added half an hour to their commute, and several shops reported fewer customers. "
_M = "An engineer told the meeting that the work would be finished by autumn, provided that the weather holds. "
_P = _S + _L + _M
_NAV = '<nav><ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li><li><a href="/s">Sport</a></li><li><a href="/c">Culture</a></li></ul></nav>'
_FOOT = '<footer><p>&copy; 2024 The Daily Example. All rights reserved.</p><ul><li><a href="/p">Privacy</a></li><li><a href="/t">Terms</a></li></ul></footer>'

PAGES = [
    f'<html><body>{_NAV}<div class="ad">Buy the best shoes of the season now, with free delivery.</div><article x-main><h1>Bridge repairs</h1><p>{_S}</p><p>{_P}</p><p>{_L}</p></article>{_FOOT}</body></html>',
    f'<html><body>{_NAV}<p class="sponsored">{_S}</p><article x-main><h2>Short note</h2><p><em>Words.<p>{_M}<p>The.</article><footer>Printed by Example, {_L}</footer></body></html>',
    f'<html><body><div class="advert">Of it and on.</div><article x-main><h1>A title of some words</h1><p>{_M}<p>{_S}<p>One more.</article>{_NAV}<footer>Since 1901: news of the day.</footer></body></html>',
    f'<html><body><header><div class="logo"><a href="/">Example</a></div><p>News since 1901, every morning for you.</p></header>{_NAV}<main x-main><h1>Opening</h1><p>{_P}</p><blockquote>{_L}</blockquote><h2>Next steps</h2><p>{_S}</p><ul><li>The north lane opens first, in June.</li><li>The south lane follows when the rails are set.</li></ul></main><aside><h3>Related</h3><ul><li><a href="/1">Old bridge closes</a></li><li><a href="/2">Ferry returns</a></li></ul></aside>{_FOOT}</body></html>',
    f'<html><body><div id="header"><h1><a href="/">My blog</a></h1><p class="tagline">Thoughts on rivers and roads</p></div><div id="menu"><a href="/a">About</a> | <a href="/b">Archive</a> | <a href="/c">Contact</a></div><div id="content" x-main><h2>On bridges</h2><div class="post-body"><p>{_S}</p><p>{_P}</p></div></div><div id="comments"><h3>3 comments</h3><div class="comment"><p>Great post, thank you for sharing this with all of us!</p></div><div class="comment"><p>{_L}</p></div><form><label>Name</label><input><textarea></textarea><button>Send</button></form></div><div id="sidebar"><h3>Tags</h3><ul><li><a href="/t">rivers</a></li></ul></div><div id="footer">Powered by Example</div></body></html>',
    f'<html><body><div class="cookie-notice"><p>We use cookies to improve your experience. By using the site you accept our policy.</p><button>Accept</button></div>{_NAV}<div class="container"><div class="row"><div class="col main-content" x-main><h1>Report</h1><p>{_P}</p><div class="ad-slot" x-not><p>Advertisement: {_M}</p></div><p>{_L}</p><figure><img><figcaption>The bridge in winter, seen from the east bank.</figcaption></figure><p>{_M}</p></div><div class="col sidebar"><div class="widget"><h4>Most read</h4><ol><li><a href="/1">Weather</a></li><li><a href="/2">Elections in the north</a></li></ol></div><div class="promo"><p>Subscribe to our newsletter for weekly stories.</p></div></div></div></div>{_FOOT}</body></html>',
    f'<html><body>{_NAV}<section class="article" x-main><h1>Long read</h1><p>{_P}</p><p>{_P}</p><h3>Costs</h3><table><tr><th>Year</th><th>Cost</th></tr><tr><td>2022</td><td>1.2 million</td></tr></table><p>{_S}</p><pre>load = span * weight</pre></section><section class="comments"><h2>Reader comments</h2><ul><li><p>{_S}</p></li><li><p>I do not agree with this at all.</p></li></ul></section>{_FOOT}</body></html>',
    f'<html><body><table class="nav"><tr><td><a href="/1">One</a></td><td><a href="/2">Two</a></td></tr></table><div><p x-main>{_P}</p><p x-main>{_S}</p><p x-main>{_L}</p></div><div class="footer"><a href="/i">Imprint</a> <a href="/d">Data</a></div></body></html>',
    f'<html><body>{_NAV}<div class="breadcrumb"><a href="/">Home</a> &gt; <a href="/n">News</a></div><div class="alert">This page was moved. Please update your bookmarks.</div><article x-main><header><h1>Inside story</h1><p>{_M}</p></header><p>{_S}</p><p>{_L} <a href="/x">an earlier story</a> {_M}</p><div class="share" x-not><a href="/f">Share</a> <a href="/m">Mail</a></div><footer x-not><p>Filed under <a href="/r">roads</a></p></footer></article><div class="related"><h3>See also</h3><p><a href="/o">Old bridge closes after 90 years</a></p></div>{_FOOT}</body></html>',
    f'<html><body><form class="search"><label>Search</label><input><button>Go</button></form><div role="navigation"><ul><li><a href="/">Start</a></li><li><a href="/w">World</a></li></ul></div><div role="main" x-main><h1>Plain</h1><div>{_P}</div><div>{_L}</div></div><div role="complementary"><p>About the author: writes on roads.</p></div><div role="contentinfo">Contact us at the office.</div></body></html>',
    f'<html><body>{_NAV}<div class="banner"><p>Sale! {_M}</p></div><div class="entry" x-main><h1>Words</h1><p>Short.</p><p>{_S}</p><p>No.</p><p>{_L}</p><dl><dt>Span</dt><dd>The length between two piers of a bridge.</dd></dl></div><div class="newsletter"><form><p>Sign up for the weekly letter and never miss a story.</p><input></form></div>{_FOOT}</body></html>',
    f'<html><body>{_NAV}<div class="ad">{_P}</div><article x-main><h1>Heading</h1><p>{_P}</p></article><aside class="notice">{_S}</aside><section id="reader-comments"><article class="comment"><p>{_L}</p></article><article class="comment"><p>{_M}</p></article></section><footer>{_P}</footer></body></html>',
    f'<html><body><header><h1>The Example</h1>{_NAV}</header><article x-main><h2>Story</h2><section><h3>One</h3><p>{_S}</p></section><section><h3>Two</h3><p>{_M}</p><ol><li>{_L}</li><li>First of all.</li></ol></section></article><div class="sidebar"><p>{_S}</p><ul><li><a href="/a">More</a></li></ul></div>{_FOOT}</body></html>',
    f'<html><body>{_NAV}<article x-main><h1>Signs !! and ###</h1><p>AND!! THE!! OF!!<p>la la la la la la<p>{_S}</article><div class="promo-box"><p>Now!!</p></div><footer>{_S}</footer></body></html>',
    f'<html><body>{_NAV}<div class="message-box"><p>{_M}</p></div><div class="story-text" x-main><p>{_S}</p><p>{_M}</p></div><div class="disqus_thread"><p>{_S}</p><p>Nice.</p></div><div class="login-form"><form><p>Log in to reply</p></form></div>{_FOOT}</body></html>',
    f'<html><body><header><h2>The Example Times</h2><p>{_M}</p></header>{_NAV}<div class="adslot">{_S}</div><article x-main><h1>Bridge</h1><p><strong>{_P}</p><p>{_L}</p></article><footer>{_M}</footer></body></html>',
    f'<html><body><header><p>{_S}</p></header>{_NAV}<main x-main><h1>Bridge</h1><p>{_L}</p><p>{_P}</p><p>Short.</p></main>{_FOOT}</body></html>',
    f'<html><body>{_NAV}<article x-main><h1>Road</h1><p>{_P}</p><p>{_S}</p></article><aside><h3>Related</h3><p>{_L}</p></aside><aside><p>{_M}</p></aside><footer>&copy; example.org &middot; {_S}</footer></body></html>',
    f'<html><body>{_NAV}<article x-main><h1>Road</h1><p>{_P}</p><aside x-not><p>{_M}</p></aside><p>{_S}</p><form x-not class="newsletter"><p>{_L}</p><input></form></article>{_FOOT}</body></html>',
    f'<html><body>{_NAV}<article x-main><h1>Road</h1><p>{_M}</p><p>{_P}</p><form x-not><label>Mail</label><p>{_S}</p><input></form></article><form><p>{_M}</p><label>Name</label></form>{_FOOT}</body></html>',
    f'<html><body>{_NAV}<form><p>{_L}</p><input></form><section x-main><h1>Road</h1><p>{_P}</p><p>{_S}</p><nav x-not><p>{_M}</p></nav></section><aside>{_P}</aside>{_FOOT}</body></html>',
    f'<html><body><div class="header"><p>{_L}</p></div><div class="nav"><p>{_S}</p></div><div class="text" x-main><p>{_P}</p><p>{_M}</p><ul><li>{_S}</li></ul></div><div class="footer"><p>{_P}</p></div></body></html>',
    # Pages of few or no blocks.
    f'<body x-main>{_P}',
    f'<body x-main>{_S}<br><br>{_L}',
    f'<body x-main>{_S}<p>{_M}</p></body>',
    f'<body x-main>{_NAV.replace("<nav>", "<nav x-not>")}{_P}{_FOOT.replace("<footer>", "<footer x-not>")}</body>',
    f'<body><div x-main><div>{_P}</div></div></body>',
    f'<body><div x-main>{_L}<div>{_M}</div></div></body>',
    f'<body><div><div x-main>{_S}</div></div></body>',
    f'<body><p x-main>{_S}</p><p x-main>{_M}</p></body>',
    f'<body><h1 x-main>Bridge</h1><p x-main>{_S}</p></body>',
    f'<body>{_NAV}<div x-main>{_P}</div>{_FOOT}</body>',
    '<body><a href="/">Home</a> | <a href="/n">News</a> | <a href="/c">Contact</a></body>',
    f'<body><div><a href="/">Home</a> <a href="/n">News</a></div><div x-main>{_S}{_M}</div><div><a href="/i">Imprint</a></div></body>',
]
