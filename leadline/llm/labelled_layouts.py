"""Labelled page layouts from which the weights of main-text extraction are learned.

``@n`` stands for n words of the article and a full stop, ``~n`` for n words of anything else;
a following ``-`` leaves the stop out. The words themselves carry no meaning.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

LAYOUTS = (
    """<html><head><title>~5-</title></head><body><nav><ul><li><a>~1-</a></li><li><a>~1-</a></li><li><a>~2-</a></li></ul></nav>
    <div class="ad">~9</div><article><h1>@6-</h1><p>@40</p><p>@1</p><p>@25</p><p><b>@4</b><br></p><p>@3</p></article>
    <footer>&copy; ~3- &middot; ~7</footer></body></html>""",
    """<body><header class="site-header masthead"><h1><a>~2-</a></h1><p class="tagline">~6</p></header>
    <div class="menu navbar"><a>~1-</a> <a>~1-</a> <a>~1-</a></div><main><article class="post"><header><h1>@7-</h1>
    </header><p>@55</p><h2>@3-</h2><p>@30 <a>@2-</a> @9</p><ul><li>@8</li><li>@4-</li></ul>
    <blockquote><p>@15</p></blockquote><p>@2</p></article></main><aside class="sidebar"><h3>~2-</h3><p>~20</p>
    <ul><li><a>~4-</a></li><li><a>~5-</a></li></ul></aside><footer class="site-footer"><p>~12</p><a>~1-</a></footer></body>""",
    """<body><div id="header"><div id="logo">~2-</div><div id="topnav"><a>~1-</a><a>~1-</a></div></div>
    <div id="content"><h1>@5-</h1><p>@60</p><p>@33</p><div class="advert banner">~14</div><p>@21</p><p>@5</p></div>
    <div id="sidebar"><div class="widget"><h4>~2-</h4><p>~18</p></div><div class="widget"><a>~3-</a></div></div>
    <div id="comments" class="comments"><h3>~2-</h3><div class="comment"><p class="author">~2-</p><p>~25</p></div>
    <div class="comment"><p>~40</p></div><div class="comment-reply"><p>~9</p></div></div>
    <div id="footer"><p>~10</p></div></body>""",
    """<body><div class="cookie notice" role="dialog"><p>~16</p><button>~1-</button></div><div class="container"><div class="entry">
    <h1 class="title">@8-</h1><p>@48</p><p>@37</p><table><tr><th>@1-</th><th>@2-</th></tr><tr><td>@1-</td><td>@3-</td></tr></table>
    <pre>@12-</pre><p>@28</p></div><form class="newsletter subscribe"><label>~3-</label><p>~11</p><input><button>~1-</button></form>
    <div class="related"><h3>~2-</h3><ul><li><a>~6-</a></li><li><a>~7-</a></li></ul><p>~13</p></div></div></body>""",
    """<body><nav role="navigation" class="breadcrumb"><a>~1-</a> / <a>~2-</a> / ~3-</nav><section class="story"><h1>@6-</h1>
    <p>@20</p><p>@44</p><figure><figcaption>@7</figcaption></figure><p>@31</p><h3>@4-</h3><p>@17</p></section>
    <div class="social share"><a>~1-</a><a>~1-</a><span>~3-</span></div><section class="responses"><h2>~2-</h2>
    <article class="comment"><p>~22</p></article><article class="comment"><p>~35</p><p>~6</p></article></section>
    <footer><ul><li><a>~1-</a></li><li><a>~2-</a></li></ul><p>~8-</p></footer></body>""",
    """<body><div class="wrapper"><div class="alert notification">~12</div><div class="post-body article-text"><h2>@5-</h2>
    <p>@52</p><ol><li>@14</li><li>@19</li><li>@2-</li></ol><p>@8</p><aside class="promo sponsored"><p>~24</p></aside><p>@46</p>
    <dl><dt>@2-</dt><dd>@11</dd></dl></div><div class="tags meta"><a>~1-</a> <a>~1-</a></div>
    <div class="author bio"><p>~19</p></div><div class="pagination pager"><a>~1-</a> <a>~1-</a></div></div></body>""",
    """<body><form role="search" class="search"><input><button>~1-</button></form><div>@7-</div><div>@62</div><div>@39</div>
    <div>@11</div><div class="disclaimer legal copyright">~17</div></body>""",
    """<body><div id="menu"><ul><li><a>~1-</a><ul><li><a>~2-</a></li></ul></li><li><a>~1-</a></li></ul></div>
    <div id="main"><h1>@4-</h1><p>@5</p><p>@71</p><p>@3-</p><p>@14</p></div><div id="ads"><p>~10</p></div>
    <div class="popup modal overlay"><p>~13</p></div><div id="disqus_thread" class="discussion"><ul><li><p>~16</p></li><li>~28</li></ul></div>
    <div id="bottom" class="foot"><p>~6-</p></div></body>""",
    """<body><section class="hero banner"><p>~7-</p></section><section class="text body"><p>@28</p><p>@33 <em>@2-</em> @5</p><p>@9</p></section>
    <section id="user-comments" class="reviews replies"><p>~31</p><p>~12</p></section><section class="login signup"><form><p>~5</p>
    <select><option>~1-</option><option>~1-</option></select></form></section><div hidden><p>~15</p></div></body>""",
    """<body><div class="toolbar"><span>~2-</span></div><article><h1>@9-</h1><div class="byline date">~4-</div><p>@36</p>
    <div class="ad-slot"><p>~21</p></div><p>@41</p><div class="share"><a>~1-</a></div><p>@4</p><footer><p>~6</p></footer>
    <nav><a>~2-</a> <a>~2-</a></nav><section class="comments"><p>~26</p></section></article><aside><p>~14</p></aside></body>""",
    """<body><center><font>@12-</font></center><font>@45</font><p>@30</p><p>@22</p><hr><font><a>~1-</a> | <a>~1-</a> | <a>~2-</a></font></body>""",
    """<body><header><nav><a>~1-</a><a>~1-</a></nav><div class="notice">~8</div></header><main><h1>@3-</h1><p>@2</p><p>@50</p>
    <details><summary>@3-</summary><p>@18</p></details><address>~6-</address></main><footer><form><label>~4-</label></form>
    <p>~9</p></footer></body>""",
    """<body><p class="skip"><a>~3-</a></p><div class="sponsor advertisement"><p>~15</p></div><div class="page"><h1>@2-</h1><h2>@6-</h2><p>@24</p>
    <p>@1-</p><p>@58</p></div><div class="recommended teaser"><h4><a>~5-</a></h4><p>~11</p></div><div class="warning privacy gdpr consent"><p>~20</p></div>
    <noscript><p>~9</p></noscript></body>""",
    """<body class="home user"><div id="page" class="site wrapper"><header id="top" class="header"><p>~7</p><ul><li><a>~1-</a></li></ul></header>
    <div class="row container"><div class="column left sidebar"><p>~22</p></div><div class="column main"><div class="section"><h1 class="title">@5-</h1>
    <p class="date time">@3-</p><p class="lead summary">@16</p><p>@49</p><p>@1-</p><h2>@2-</h2><p>@27</p></div></div>
    <div class="column right"><aside><p>~33</p></aside></div></div><footer id="footer"><div>~5-</div><div>~11</div></footer></div></body>""",
    """<body><div class="wrapper"><div class="inner"><section><div><p>@43</p><p>@6</p><p>@38</p></div></section><section class="comments"><div>
    <p>~19</p><p>~44</p></div><form><textarea>~2-</textarea><p>~4</p></form></section></div></div><div class="footer"><p>~18</p></div></body>""",
    """<html><body><div class="notice">~11</div><aside class="sidebar">~26</aside><article><h1>@4-</h1><p>@3</p><p>@66</p><div class="ad">~12</div>
    <p>@20</p><p>@2</p></article><section class="comments"><div class="comment"><b>~1-</b> ~27</div><div class="comment">~4</div></section>
    <form action="x">~3- <input> <button>~1-</button></form><footer>~9</footer></body></html>""",
    """<body><div class="layout"><div class="nav-list"><a>~2-</a><a>~1-</a></div><div class="wrapper"><div class="text"><div><h3>@4-</h3>
    <p>@35</p></div><div><p>@4</p><p>@51</p></div></div></div><div class="box"><h3>~3-</h3><a>~5-</a><a>~4-</a></div></div></body>""",
)

# Elements that hold an article, and what else pages hold; every pair meets, the second both
# around the first and inside it.
HOLDERS = (
    "<article>", "<main>", "<main><article class='post'>", "<div id='content'>", "<div class='article'>", "<div class='main'>",
    "<div class='page'><div class='entry'>", "<div class='post-body'>", "<section class='story text'>", "<section>", "<div>",
    "<div class='wrapper'><div class='container'>", "<div id='main' class='column'><article>", "<table><tr><td class='content body'>",
    "<div class='story body'>", "<div class='blog text'><div>", "<div><div>", "<div id='primary'><div class='content area'>", "<body>",
)
OTHERS = (
    "<nav><a>~1-</a> <a>~2-</a></nav>", "<nav>~6-</nav>", "<ul class='menu'><li><a>~1-</a></li><li><a>~2-</a></li></ul>",
    "<div class='menu nav navigation navbar'>~9</div>", "<div class='breadcrumb breadcrumbs'>~4-</div>", "<header>~6-</header>",
    "<header><h1>~3-</h1><p>~12</p></header>", "<div class='header masthead'><h1>~2-</h1><p>~9</p></div>", "<div class='top topbar'>~8</div>",
    "<footer>~14</footer>", "<footer><p>~30</p></footer>", "<div class='footer foot bottom'><p>~20</p></div>", "<aside>~25</aside>",
    "<aside><h3>~2-</h3><p>~30</p></aside>", "<div class='sidebar'>~30</div>", "<div class='side widget'><p>~28</p></div>",
    "<div class='notice'>~12</div>", "<p class='notice notification'>~15</p>", "<div class='cookie cookies consent'><p>~20</p></div>",
    "<div class='alert warning'>~14</div>", "<div class='privacy gdpr legal disclaimer'><p>~18</p></div>", "<div class='banner'>~12</div>",
    "<div class='ad'>~14</div>", "<div class='ads'><p>~24</p></div>", "<div class='advert'>~16</div>", "<div class='advertisement'><p>~11</p></div>",
    "<div class='adverts adsense'>~13</div>", "<div class='sponsor sponsored'><p>~22</p></div>", "<div class='promo promotion'>~13</div>",
    "<form><label>~3-</label><p>~9</p><button>~1-</button></form>", "<form>~12</form>", "<div class='form search login'>~8</div>",
    "<div class='newsletter subscribe signup'><p>~13</p></div>", "<section class='comments'><h2>~2-</h2><p>~40</p></section>",
    "<div class='comments'><div>~26</div><div>~5-</div></div>", "<div class='comment'><p>~35</p></div>", "<article class='comment'><p>~45</p></article>",
    "<ul class='comments replies responses'><li>~18</li><li><p>~33</p></li></ul>", "<div class='discussion disqus thread'><p>~38</p></div>",
    "<div class='reviews reply'><p>~22</p></div>", "<div class='share social sharing'><a>~1-</a> ~2-</div>", "<div class='tags tag'><a>~1-</a> ~3-</div>",
    "<div class='related recommended'><p>~13</p></div>", "<div class='teaser teasers more'><h4><a>~5-</a></h4><p>~14</p></div>",
    "<div class='pagination pager'><a>~1-</a> ~3-</div>", "<div class='popup modal overlay'><p>~16</p></div>", "<div class='copyright'>&copy; ~7</div>",
    "<div role='navigation'>~5-</div>", "<div role='complementary'><p>~21</p></div>", "<div role='contentinfo banner'>~8</div>", "<div hidden><p>~15</p></div>",
    "<div class='author bio'><p>~19</p></div>", "<div class='toolbar skip'>~4-</div>", "<button>~2-</button>", "<address>~6-</address>", "<noscript>~9</noscript>",
    "<select><option>~1-</option></select>", "<ul><li><a>~3-</a></li><li><a>~5-</a></li></ul>", "<p><a>~6-</a></p>",
)
ARTICLE = (
    "<h1>@5-</h1>", "<p>@38</p>", "<p>@2</p>", "<h2>@3-</h2>", "<p>@60 <a>@2-</a> @9</p>", "<ul><li>@6</li><li>@3-</li></ul>", "<p>@1-</p>",
    "<blockquote>@18</blockquote>", "<div>@24</div>", "<p>@12</p>", "<ol><li>@15</li></ol>", "<div><p>@20</p></div>", "<pre>@9-</pre>",
    "<figure><figcaption>@7</figcaption></figure>", "<table><tr><td>@2-</td><td>@4</td></tr></table>", "<h3>@4-</h3>", "<p>@80</p>", "<p>@4</p>",
)

# The same pages with texts half and three times as long.
STRETCH = (1.0, 0.5, 3.0)


def _composed() -> Iterator[str]:
    for holder in HOLDERS:
        names = re.findall(r"<(\w+)", holder)
        end = "".join(f"</{name}>" for name in reversed(names))
        half = len(OTHERS) // 2
        yield "<body>" + "".join(OTHERS[:half]) + holder + "".join(ARTICLE) + end + "".join(OTHERS[half:]) + "</body>"
        # Inside, the article's blocks come between the others, again and again.
        inside = "".join(ARTICLE[i % len(ARTICLE)] + other for i, other in enumerate(OTHERS) if other[:7] != "<header")
        yield "<html><body>" + holder + inside + ARTICLE[1] + end + "</body></html>"


def labelled_pages() -> Iterator[tuple[str, Callable[[str], bool]]]:
    """Pages, and which of their blocks are the article's: those that keep the mark ``@``."""
    for layout in (*LAYOUTS, *_composed()):
        for times in STRETCH:

            def words(found: re.Match, times: float = times) -> str:
                count = max(1, round(int(found[2]) * times))
                return f"{found[1]}{' '.join(['word'] * count)}{'' if found[3] else '.'}"

            yield re.sub(r"([@~])(\d+)(-?)", words, layout), _marked


def _marked(text: str) -> bool:
    return "@" in text
