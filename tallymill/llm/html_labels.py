"""The labelled table of the block classifier: small pages made up for it, and a mark per block.

`+` is main text, `-` is not; one mark for each text block in page order.
"""

_LONG = "The river rose slowly during the night, and by the morning most of the lower fields had been covered by brown water again."
_MID = "Nobody in the village had expected it to come so early."
_SHORT = "They waited."
_LINKS = "".join(f'<li><a href="/{w}">{w}</a></li>' for w in ("Home", "News", "Travel", "About us"))

PAGES = [
    (f'<body><nav><ul>{_LINKS}</ul></nav><article><h1>High water</h1><p>{_LONG}</p><p>{_MID}</p><p>{_SHORT}</p><p>{_LONG}</p></article><footer>&copy; 2020 The Valley Paper</footer></body>', "----+++++-"),
    (f'<body><nav><ul>{_LINKS}</ul></nav><div class="ad">Buy two pairs of boots and get the third one free this week.</div><article><h1>Boots</h1><p>{_MID}</p><p>{_LONG}</p><p>{_SHORT}</p></article><footer>example.org &middot; {_MID}</footer></body>', "-----++++-"),
    (f'<body><header><p>The Valley Paper, every day since 1901</p></header><main><h1>Bridge closed</h1><p>{_LONG}</p><p>{_LONG}</p><p>{_SHORT}</p></main><aside><h3>More</h3><p>{_MID}</p><p>{_LONG}</p></aside><footer><p>All rights reserved.</p></footer></body>', "-++++----"),
    (f'<body><div id="menu">{_LINKS}</div><div id="content"><h2>A new school</h2><p>{_LONG}</p><p>{_MID}</p><ul><li>Two halls</li><li>One garden</li></ul><p>{_SHORT}</p></div><div id="sidebar"><h4>Popular</h4><a href="/1">{_MID}</a><p>{_LONG}</p></div></body>', "----++++++---"),
    (f'<body><div class="cookie-notice"><p>We use cookies. By reading on you agree to their use on this and other pages.</p></div><div class="post"><h1>Harvest</h1><p>{_LONG}</p><p>{_LONG}</p></div><div class="comments"><h3>Comments</h3><p>{_LONG}</p><p>{_MID}</p></div></body>', "-+++---"),
    (f'<body><p>{_LONG}</p><p>{_LONG}</p><p>{_LONG}</p><p><a href="/">Home</a> <a href="/next">Next page</a></p></body>', "+++-"),
    (f'<body><table><tr><td><a href="/a">One</a></td><td><a href="/b">Two</a></td><td><a href="/c">Three</a></td></tr></table><h1>Old style</h1><p>{_LONG}</p><p>{_LONG}</p><p>{_MID}</p><p>Copyright 2004</p></body>', "---++++-"),
    (f'<body><article><h1>Quiet</h1><p>{_SHORT}</p><p>{_SHORT}</p><p>{_MID}</p><p>Yes.</p></article><section class="related"><h3>Read next</h3><p>{_MID}</p></section></body>', "+++++--"),
    (f'<body><article><h1>Short day</h1><p>{_LONG}</p><form><p>Your name</p><p>Write to us and we shall answer within the week.</p></form><p>{_LONG}</p></article></body>', "++--+"),
    (f'<body><article><header><h1>Night trains</h1></header><p>{_LONG}</p><div class="advert"><p>{_LONG}</p></div><p>{_MID}</p><p>No</p><div class="share"><p>Share this page</p></div></article></body>', "++-++-"),
    (f'<body><div><a href="/">Home</a></div><div><a href="/x">Weather</a> | <a href="/y">Sport</a></div><div>{_LONG} {_LONG}</div><div>{_LONG}</div><div>{_MID}</div><div><a href="/imprint">Imprint</a></div></body>', "--+++-"),
    (f'<body><article><p>{_MID}</p><blockquote>{_LONG}</blockquote><p>word</p><p>{_LONG} <a href="/s">see here</a></p></article><footer><ul>{_LINKS}</ul></footer></body>', "++++----"),
    (f'<body><nav>{_LINKS}</nav><article><h1>One</h1><p>One line</p></article><footer>{_LONG}</footer></body>', "----++-"),
    (f'<body><article><p><b>Bold head<br><p>{_LONG}</p><p>Three words here</p><p>and</p></article><div class="banner">{_LONG}</div></body>', "++++-"),
    (f'<body><div role="navigation"><p>{_MID}</p></div><div role="main"><p>{_LONG}</p><p>{_MID}</p><p>{_SHORT}</p></div><div class="newsletter"><p>{_LONG}</p></div></body>', "-+++-"),
    (f'<body><p>Log in</p><p>Register</p><p>{_LONG}</p><p>{_LONG}</p><p>Contact</p><p>Terms</p></body>', "--++--"),
    (f'<body><nav>{_LINKS}</nav><article><h1>Cut off</h1><p>{_LONG}</p><p>{_MID}', "----+++"),
    (f'<article><p>{_MID}</p></article>', "+"),
    (f'<article><p>{_SHORT}</p></article>', "+"),
    (f'<main><h1>One thing</h1><p>{_LONG}</p></main>', "++"),
    (f'<body><main><p>{_LONG}</p><p>{_SHORT}</p></main></body>', "++"),
    (f'<p>{_LONG}</p>', "+"),
    (f'<p>{_LONG}</p><p>{_MID}</p>', "++"),
    (f'<body><nav>{_LINKS}</nav><div>{_LONG}</div><div>{_MID}</div></body>', "----++"),
    (f'<body><footer>{_MID}</footer></body>', "-"),
    (f'<body><p><a href="/next">Next</a></p></body>', "-"),
    (f'<article><p>Words</p><p>{_SHORT}</p><p>end</p></article>', "+++"),
    (f'<body><nav>{_LINKS}</nav><div class="wrap right-sidebar"><h1>Low tide</h1><p>{_LONG}</p><p>{_SHORT}</p><p>{_MID}</p><p>{_LONG}</p></div></body>', "----+++++"),
    (f'<body><div class="page menu-left"><div class="text"><p>{_LONG}</p><p>{_LONG}</p><p>{_MID}</p></div></div><div class="promo"><p>{_LONG}</p></div></body>', "+++-"),
    (f'<body><div id="search-page"><p>{_MID}</p><p>{_LONG}</p><p>{_SHORT}</p></div><footer>{_MID}</footer></body>', "+++-"),
    (f'<body><div class="footer"><p>{_MID}</p><p>{_LONG}</p></div><div class="post"><p>{_LONG}</p><p>{_LONG}</p><p>{_LONG}</p></div></body>', "--+++"),
]
