"""Small pages whose article is marked by hand (``<!--text-->`` to
``<!--/text-->``), for layouts that do not mark it in their own tags.
Each stands for a kind of layout; the words are filler."""

_LINE = "The first of many words on this matter were put down here, and others followed in the same way until all was said. "
_MORE = "Another part of it adds what was left out before, with some <a href='/x'>words</a> that lead to other pages. "

LABELLED = (
    # Generic blocks with speaking classes, a list and a quotation
    f"""<html><head><title>T</title></head><body><div id="masthead"><a href="/">Site</a> <span>Words of the day</span></div>
<div class="menu"><ul><li><a href="/a">One</a></li><li><a href="/b">Two</a></li></ul></div><div class="post-content"><!--text-->
<h1>A title of some words</h1><p>{_LINE}</p><ul><li>First thing in a list of things</li><li>Second thing in it</li></ul>
<div class="advert"><p>Buy this now</p></div><p>{_MORE}</p><blockquote>{_LINE}</blockquote><!--/text--></div>
<div class="comments"><h3>Comments</h3><p>{_LINE}</p><p>{_LINE}</p></div><div class="footer">Rights reserved</div></body></html>""",
    # Paragraphs in the body, with a form and a notice
    f"""<body><div class="cookie-notice">We keep cookies. <button>Fine</button></div><header><h1>Site</h1><a href="/">Home</a></header>
<form><label>Search</label><input name=q><button>Go</button></form><!--text--><h1>Words</h1><p>{_LINE}<p>{_MORE}<h2>Next</h2>
<p>{_LINE}</p><p>Short one.</p><table><tr><th>Name of it</th><td>Some words in a cell</td></tr></table><p>A last line of text.</p><!--/text-->
<form action="/r"><p>Leave a reply</p><textarea>text</textarea></form><footer><p>Words at the end</p></footer>""",
    # A table as layout
    f"""<table><tr><td><a href="1">Home</a><br><a href="2">News</a><br><a href="3">About</a><br><a href="4">Links</a></td><td>
<!--text--><h2>A heading of words</h2><p>{_LINE}</p><p>Few words.</p><p>{_MORE}</p><p>{_LINE}</p><!--/text--></td><td><a href="5">More</a> <a
href="6">Last</a></td></tr><tr><td>Page made by us</td></tr></table>""",
    # Plain divs with line breaks, links around
    f"""<div><div><a href="1">Start</a> <a href="2">Archive</a> <a href="3">Contact</a></div><div><!--text--><div>{_LINE}<br><br>{_LINE}
</div><div>{_MORE}</div><div>{_LINE}</div><!--/text--></div><div><a href="4">Up</a> <a href="5">Next page</a></div><div>Made by us</div></div>""",
    # An article element beside other text in the body
    f"""<body><p>Sign in to read more</p><div>Weather today</div><main><p>You are here</p><article class="has-sidebar"><!--text--><header>
<h1>A title</h1></header><p>{_LINE}</p><aside>Aside of it</aside><pre>some lines of code</pre><h3>Sub</h3><p>{_MORE}</p><dl><dt>A term
</dt><dd>Its meaning in words</dd></dl><!--/text--><footer>Tags of it</footer></article></main><div><p>Other news of the day</p></div>
<section id="related-posts"><article><p>{_LINE}</p></article></section></body>""",
    # A side column and shares, sections inside the text
    f"""<div class="navbar"><a href="1">One</a></div><div class="row"><div class="sidebar"><h4>Latest</h4><p>{_LINE}</p></div><div>
<!--text--><section><h1>Words</h1><p>{_LINE}</p><div class="share">Share this</div><p>{_MORE}</p></section><section><h2>More words</h2>
<p>{_LINE}</p><p>No more.</p><ol><li><a href="4">One thing</a></li><li>{_LINE}</li><li>{_MORE}</li></ol></section><!--/text--></div></div><div class="newsletter"><p>Get our letter</p></div>""",
)
