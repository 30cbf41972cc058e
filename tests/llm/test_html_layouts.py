"""Hand-written pages of layouts that the training families do not hold, with the text that must come out."""

import time

import numpy as np
import pytest

from heronlake.llm import html_extract, html_pages

PAGES = [
    (
        'tiny article',
        '<body><article><p>a<b>b</b> c&#8217;s</p><p>xy</p><div>bare <p>para</p> tail</div></article></body>',
        ['ab c’s', 'xy', 'bare', 'para', 'tail'],
    ),
    (
        'classless divs',
        '<html><body><div><a href="/">Home</a> <a href="/a">About</a> <a href="/c">Contact</a></div><div><h1>How tides work</h1></div><div>The moon pulls on the sea. The sea follows it around the earth twice a day.</div><div>&copy; 2021 Tide Society</div></body></html>',
        ['How tides work', 'The moon pulls on the sea. The sea follows it around the earth twice a day.'],
    ),
    (
        'wordpress',
        '<body class="home blog"><div id="page" class="site"><a class="skip-link" href="#content">Skip to content</a><header id="masthead" class="site-header"><div class="site-branding"><p class="site-title"><a href="/">My Garden</a></p><p class="site-description">Notes from the shed</p></div><nav id="site-navigation" class="main-navigation"><ul id="primary-menu" class="menu"><li class="menu-item"><a href="/">Home</a></li><li class="menu-item"><a href="/about">About</a></li></ul></nav></header><div id="content" class="site-content"><main id="main" class="site-main"><article id="post-7" class="post-7 post type-post status-publish hentry"><header class="entry-header"><h1 class="entry-title">Growing beans</h1><div class="entry-meta"><span class="posted-on">Posted on <a href="/x">May 3, 2020</a></span> <span class="byline">by <a href="/u">anna</a></span></div></header><div class="entry-content"><p>Beans like warm soil and a bit of patience.</p><ul><li>Runner beans</li><li>French beans</li></ul><p>Sow them in May.</p></div><footer class="entry-footer"><span class="cat-links">Posted in <a href="/v">Vegetables</a></span></footer></article><nav class="navigation post-navigation"><a href="/p">Older post</a></nav><div id="comments" class="comments-area"><h2 class="comments-title">3 thoughts on &ldquo;Growing beans&rdquo;</h2><ol class="comment-list"><li id="comment-1" class="comment even"><article class="comment-body"><footer class="comment-meta"><b class="fn">Joe</b> <span class="says">says:</span></footer><div class="comment-content"><p>I always sow mine too early, thanks for the tip.</p></div></article></li></ol><div id="respond" class="comment-respond"><h3>Leave a Reply</h3><form><p>Your email address will not be published.</p><textarea></textarea></form></div></div></main></div><aside id="secondary" class="widget-area"><section class="widget widget_recent_entries"><h2 class="widget-title">Recent Posts</h2><ul><li><a href="/1">Hello world</a></li></ul></section></aside><footer id="colophon" class="site-footer"><div class="site-info">Proudly powered by WordPress</div></footer></div></body>',
        ['Growing beans', 'Beans like warm soil and a bit of patience.', 'Runner beans', 'French beans', 'Sow them in May.'],
    ),
    (
        'comments section without class',
        '<body><header><a href="/">Daily</a></header><article><h1>New bridge opens</h1><p>The bridge over the river opened on Monday after two years of work.</p><p>Traffic was light.</p></article><section><h2>Comments</h2><div><b>Mia</b><p>About time, I have been waiting for this bridge for years.</p></div><div><b>Tom</b><p>It looks great from the hill.</p></div></section><footer>&copy; Daily</footer></body>',
        ['New bridge opens', 'The bridge over the river opened on Monday after two years of work.', 'Traffic was light.'],
    ),
    (
        'form in article',
        '<body><nav><a href="/">Home</a></nav><article><h1>Baking bread</h1><p>Mix the flour with water and leave it for an hour.</p><form action="/s"><p>Get our recipes by mail</p><input type="email"><button>Go</button></form><p>Then knead it well and let it rise again.</p></article></body>',
        ['Baking bread', 'Mix the flour with water and leave it for an hour.', 'Then knead it well and let it rise again.'],
    ),
    (
        'table layout',
        '<body><table width="100%"><tr><td width="150"><a href="a.html">Home</a><br><a href="b.html">Products</a><br><a href="c.html">Links</a></td><td><h1>Old clocks</h1><p>We have repaired clocks since 1950 in the same small shop.</p><p>Come and see us.</p></td></tr></table></body>',
        ['Old clocks', 'We have repaired clocks since 1950 in the same small shop.', 'Come and see us.'],
    ),
    (
        'bootstrap',
        '<body><nav class="navbar navbar-expand"><a class="navbar-brand" href="/">Acme</a><ul class="navbar-nav"><li class="nav-item"><a class="nav-link" href="/d">Docs</a></li></ul></nav><div class="container"><div class="row"><div class="col-md-8"><h1>Release notes</h1><p class="lead">Version two is here and it is faster than before.</p><h2>Fixes</h2><ul><li>No more crashes on start</li><li>Smaller files</li></ul></div><div class="col-md-4"><div class="card"><div class="card-header">Latest posts</div><ul class="list-group"><li><a href="/1">One</a></li><li><a href="/2">Two</a></li></ul></div></div></div></div><footer class="footer"><div class="container"><span class="text-muted">© 2022 Acme Inc.</span></div></footer></body>',
        ['Release notes', 'Version two is here and it is faster than before.', 'Fixes', 'No more crashes on start', 'Smaller files'],
    ),
    (
        'blogger',
        '<body><div id="header-wrapper"><h1 class="title"><a href="/">Cats and more</a></h1><p class="description">A blog about cats</p></div><div class="main section" id="main"><div class="date-outer"><h2 class="date-header"><span>Sunday, March 4, 2012</span></h2><div class="post hentry"><h3 class="post-title entry-title"><a href="/p">The grey one</a></h3><div class="post-body entry-content">She came in through the window again.<br><br>I gave her some milk and she went to sleep on the chair.</div><div class="post-footer"><span class="post-author">Posted by Kim</span> <span class="post-timestamp">at 9:12 PM</span></div></div></div></div><div id="sidebar-right-1" class="sidebar"><div class="widget"><h2>Blog Archive</h2><ul><li><a href="/2012">2012</a></li></ul></div></div></body>',
        ['The grey one', 'She came in through the window again. I gave her some milk and she went to sleep on the chair.'],
    ),
    (
        'news',
        '<body><div class="cookie-banner"><p>We use cookies to make this site work.</p><button>OK</button></div><header class="site-header"><a href="/">The Post</a><nav><ul><li><a href="/w">World</a></li><li><a href="/s">Sport</a></li></ul></nav></header><main><article class="story"><header><h1>Council votes on park</h1><p class="byline">By Jane Roe, 4 May 2021</p></header><div class="story-body"><p>The council voted on Tuesday to keep the old park open.</p><div class="ad-slot">Advertisement</div><p>About two hundred people came to the meeting, most of them in favour.</p><aside class="related"><h3>Related</h3><ul><li><a href="/r">Park closed for winter</a></li></ul></aside><blockquote>It is our park, said one.</blockquote><p>A second vote follows in June.</p></div><div class="share"><a href="/f">Facebook</a> <a href="/t">Twitter</a></div></article><section class="newsletter"><h2>Newsletter</h2><p>Get the news every morning.</p><form><input><button>Sign up</button></form></section></main><footer><p>© The Post 2021. All rights reserved.</p></footer></body>',
        ['Council votes on park', 'The council voted on Tuesday to keep the old park open.', 'About two hundred people came to the meeting, most of them in favour.', 'It is our park, said one.', 'A second vote follows in June.'],
    ),
    (
        'docs',
        '<body><div class="sphinxsidebar"><h3>Table of Contents</h3><ul><li><a href="#a">Install</a></li><li><a href="#b">Usage</a></li></ul></div><div class="document"><div class="body"><h1>Install</h1><p>Run the following command in a shell:</p><pre>pip install thing</pre><p>After that the tool is ready.</p></div></div><div class="related"><a href="n">next</a> <a href="p">previous</a></div><div class="footer">© Copyright 2019. Created using Sphinx.</div></body>',
        ['Install', 'Run the following command in a shell:', 'pip install thing', 'After that the tool is ready.'],
    ),
    (
        'bare text',
        '<html><body><h1>Notes</h1>First line of the notes.<p>Second line, in a paragraph.<p>Third line.<hr><a href="index.html">Back</a></body></html>',
        ['Notes', 'First line of the notes.', 'Second line, in a paragraph.', 'Third line.'],
    ),
    (
        'medium-like',
        '<body><div><div><a href="/">Site</a><a href="/in">Sign in</a></div></div><div><section><div><div><h1>Why I walk</h1><p>Walking is the one thing that I do every day.</p><p>It costs nothing and it clears the head.</p><h2>The route</h2><p>I go down to the river and back.</p></div></div></section></div><div><div><a href="/h">Help</a><a href="/t">Terms</a><a href="/p">Privacy</a></div></div></body>',
        ['Why I walk', 'Walking is the one thing that I do every day.', 'It costs nothing and it clears the head.', 'The route', 'I go down to the river and back.'],
    ),
    (
        'main only',
        '<body><header><h1>Town library</h1><nav><a href="/">Start</a> <a href="/k">Katalog</a></nav></header><main><h2>Opening hours</h2><p>We are open from nine to five on weekdays.</p><table><tr><th>Day</th><th>Hours</th></tr><tr><td>Monday</td><td>9 to 5</td></tr></table></main><aside><p>Buy our calendar now!</p></aside><footer><address>Main street 1</address></footer></body>',
        ['Opening hours', 'We are open from nine to five on weekdays.', 'Day', 'Hours', 'Monday', '9 to 5'],
    ),
    (
        'german',
        '<body><div id="kopf"><a href="/">Startseite</a> | <a href="/i">Impressum</a></div><div id="inhalt"><h1>Der alte Turm</h1><p>Der Turm steht seit dem zwölften Jahrhundert am Fluss.</p><p>Man kann ihn am Sonntag besuchen.</p></div><div id="fuss">© Heimatverein</div></body>',
        ['Der alte Turm', 'Der Turm steht seit dem zwölften Jahrhundert am Fluss.', 'Man kann ihn am Sonntag besuchen.'],
    ),
    (
        'nested article with list and code',
        '<body><div class="wrapper"><div class="breadcrumbs"><a href="/">Home</a> &gt; <a href="/h">Howto</a></div><div class="content"><div class="inner"><h1>Set a clock</h1><ol><li>Open the back.</li><li>Turn the wheel.</li></ol><p>Done.</p></div></div></div><div class="footer"><ul><li><a href="/c">Contact</a></li><li><a href="/p">Privacy</a></li></ul></div></body>',
        ['Set a clock', 'Open the back.', 'Turn the wheel.', 'Done.'],
    ),
    (
        'discussion class-less at the end',
        '<body><h1>Rain again</h1><p>It rained for the whole of last week, and the fields are under water.</p><p>Nobody knows when it will stop.</p><h3>2 Comments</h3><ul><li>Ann: It is the same here, my garden is a lake.</li><li>Bob: Stay dry everyone!</li></ul></body>',
        ['Rain again', 'It rained for the whole of last week, and the fields are under water.', 'Nobody knows when it will stop.'],
    ),
    (
        'chinese',
        '<body><div class="nav"><a href="/">首页</a> <a href="/n">新闻</a></div><div class="article"><h1>大桥通车</h1><p>经过两年的建设，大桥于周一正式通车。</p><p>当天车辆不多。</p></div><div class="footer">版权所有 © 日报</div></body>',
        ['大桥通车', '经过两年的建设，大桥于周一正式通车。', '当天车辆不多。'],
    ),
    (
        'deep',
        '<body><div id="root"><div><div><div><div class="Layout-sc1"><div><main><div><div><h1>Deep page</h1><div><p>The text sits far inside of many boxes.</p></div><div><p>And another part of it here.</p></div></div></div></main></div></div></div></div></div></div><footer><nav><a href="/a">A</a><a href="/b">B</a></nav></footer></body>',
        ['Deep page', 'The text sits far inside of many boxes.', 'And another part of it here.'],
    ),
    (
        'old uppercase',
        '<HTML><HEAD><TITLE>x</TITLE></HEAD><BODY BGCOLOR=white><CENTER><H1>Model trains</H1></CENTER><P>I have built model trains for thirty years.<P>My favourite one is the <B>Blue Arrow</B>, which I built in 1988.<HR><A HREF="index.html">Back to the index</A><ADDRESS>webmaster@example.com</ADDRESS></BODY></HTML>',
        ['Model trains', 'I have built model trains for thirty years.', 'My favourite one is the Blue Arrow, which I built in 1988.'],
    ),
    (
        'wiki',
        '<body><div id="mw-navigation"><ul><li><a href="/m">Main page</a></li><li><a href="/r">Random article</a></li></ul></div><div id="content" class="mw-body"><h1 id="firstHeading" class="firstHeading">Heron</h1><div id="bodyContent"><div id="mw-content-text"><p>Herons are long-legged <a href="/b">birds</a> that live by fresh water and on coasts.</p><h2>Food</h2><p>They eat <a href="/f">fish</a>, <a href="/fr">frogs</a> and <a href="/i">insects</a>.</p><ul><li>Grey heron</li><li>Purple heron</li></ul></div></div></div><div id="footer"><ul><li>This page was last edited on 3 May 2020.</li></ul></div></body>',
        ['Heron', 'Herons are long-legged birds that live by fresh water and on coasts.', 'Food', 'They eat fish, frogs and insects.', 'Grey heron', 'Purple heron'],
    ),
    (
        'recipe',
        '<body><header class="top"><div class="logo"><a href="/">Yum</a></div><form class="search"><input><button>Search</button></form></header><div class="recipe"><h1>Pancakes</h1><h2>Ingredients</h2><ul><li>2 eggs</li><li>200 g flour</li><li>Milk</li></ul><h2>Method</h2><ol><li>Mix everything well.</li><li>Fry in butter.</li></ol></div><div class="sidebar"><h3>Popular recipes</h3><ul><li><a href="/w">Waffles</a></li></ul></div><div class="copyright">Copyright 2020 Yum</div></body>',
        ['Pancakes', 'Ingredients', '2 eggs', '200 g flour', 'Milk', 'Method', 'Mix everything well.', 'Fry in butter.'],
    ),
    (
        'sidebar first, generic names',
        '<body><div class="c1"><div class="c2"><a href="/">Start</a></div><div class="c2"><a href="/p">People</a></div><div class="c2"><a href="/w">Work</a></div></div><div class="c3"><h2>Our office dog</h2><div class="c4">Everyone likes the office dog. She sleeps under the big table all day.</div><div class="c4">On Fridays she gets a bone.</div></div></body>',
        ['Our office dog', 'Everyone likes the office dog. She sleeps under the big table all day.', 'On Fridays she gets a bone.'],
    ),
    (
        'author box and related at the end',
        '<body><article><h1>Ten hills</h1><p>These are the hills that I liked most this year.</p><h3>1. Low Hill</h3><p>It is low.</p><h3>2. High Hill</h3><p>It is high, and the view from the top is wide.</p><div class="author-box"><h4>About the author</h4><p>Lee walks a lot.</p></div><div class="related-posts"><h4>You may also like</h4><ul><li><a href="/r">Ten rivers</a></li></ul></div></article></body>',
        ['Ten hills', 'These are the hills that I liked most this year.', '1. Low Hill', 'It is low.', '2. High Hill', 'It is high, and the view from the top is wide.'],
    ),
    (
        'details comments',
        '<body><main><h1>Slow news</h1><p>Nothing happened in town today, and nobody was surprised by that.</p></main><details><summary>Show comments</summary><div class="comment"><p>First!</p></div></details></body>',
        ['Slow news', 'Nothing happened in town today, and nobody was surprised by that.'],
    ),
]


@pytest.mark.parametrize("name,page,want", PAGES, ids=[p[0] for p in PAGES])
def test_layouts(name, page, want):
    assert html_extract.extract(page, html_extract.default_model()).split("\n") == want


@pytest.mark.parametrize("family,least", [("blog", 0.95), ("divs", 0.93), ("grid", 0.95), ("docs", 0.95)])
def test_families_held_out_of_the_training(family, least):
    model = html_extract.Model.train(html_pages.labelled_pages(900, families=tuple(f for f in html_pages.FAMILIES if f != family)))
    right = []
    for page in html_pages.labelled_pages(60, seed=5, families=(family,)):
        nodes = html_extract.parse(page)
        right += [(p[html_extract.C] > 0.5) == (n.label == "c") for n, p in zip(nodes, model.marginals(nodes)) if n.text]
    assert np.mean(right) > least


def test_deep_and_hostile_pages_take_linear_time():
    model = html_extract.default_model()
    began = time.perf_counter()
    html_extract.parse("<div>" * 8000 + "</p>" * 8000)
    assert time.perf_counter() - began < 0.2
    for unit in ("<form><li>x", "<tr><td><form>y", "<li><dt>z", "<div>a</span>", "<h2><p>b", "<a href=x><div>c"):
        began = time.perf_counter()
        text = html_extract.extract("<body>" + unit * 10_000, model)
        assert time.perf_counter() - began < 10 and set(text.replace("\n", "")) <= set("xyzabc")
    began = time.perf_counter()
    long = "<article>" + "<p>A sentence that is part of a long page.</p>" * 50_000 + "</article>"
    assert html_extract.extract(long, model).count("\n") == 49_999 and time.perf_counter() - began < 30


def test_training_on_nothing_prefers_nothing():
    model = html_extract.Model.train([])
    nodes = html_extract.parse("<p>x</p>")
    assert np.allclose(model.marginals(nodes), 1 / 3)
