"""Hand-written pages in layouts that the training generator was not made from: (name, html, story)."""

P = (
    "The harbour office opened a second counter on Monday, and the queue of skippers was gone before noon.",
    "A spokesman said that the old building would be kept, since its walls are sound and its roof was mended last year.",
    "Nobody expected the tide to rise that far; three boats were moved to the upper basin during the night.",
    "In the end the council voted for the longer pier, by nine votes to four, with two members away.",
)
LAYOUTS = [
    (
        "tables and fonts of the nineties",
        f"""<HTML><HEAD><TITLE>Harbour news</TITLE></HEAD><BODY BGCOLOR="#ffffff"><CENTER><IMG SRC="logo.gif"><BR><FONT SIZE=1><A HREF="/">Home</A> | <A HREF="/n">News</A> | <A HREF="/c">Contact us</A></FONT></CENTER>
<TABLE BORDER=0 CELLPADDING=4><TR><TD WIDTH=140><FONT SIZE=2><A HREF="1">Weather</A><BR><A HREF="2">Tides</A><BR><A HREF="3">Ferries</A><BR><A HREF="4">Archive</A></FONT></TD>
<TD WIDTH=460><H2>Second counter at the harbour</H2><P>{P[0]}<P>{P[1]}<P>{P[2]}<P>{P[3]}</TD></TR></TABLE></BODY></HTML>""",
        "\n".join(("Second counter at the harbour", *P)),
    ),
    (
        "bare divisions and line breaks",
        f"""<html><body><div><a href="/">start</a> <a href="/a">all texts</a> <a href="/b">pictures</a></div><div><div><h1>The longer pier</h1><div>{P[0]}<br><br>{P[1]}<br><br>{P[2]}<br><br>{P[3]}</div></div></div>
<div><a href="/imprint">imprint</a> <a href="/privacy">privacy</a></div></body></html>""",
        "\n".join(("The longer pier", " ".join(P))),
    ),
    (
        "a blog system",
        f"""<!doctype html><html><body class="home blog"><div id="page" class="hfeed site"><header id="masthead" class="site-header"><div class="site-branding"><p class="site-title"><a href="/" rel="home">Quay notes</a></p><p class="site-description">Things seen from a quay</p></div>
<nav id="site-navigation" class="main-navigation"><ul id="primary-menu" class="menu"><li class="menu-item"><a href="/">Home</a></li><li class="menu-item"><a href="/about">About</a></li></ul></nav></header>
<div id="content" class="site-content"><main id="main" class="site-main"><article id="post-12" class="post-12 post type-post"><header class="entry-header"><h1 class="entry-title">A night of high water</h1></header>
<div class="entry-content"><p>{P[2]}</p><p>{P[0]}</p><blockquote><p>{P[1]}</p></blockquote><p>{P[3]}</p></div></article></main></div>
<aside id="secondary" class="widget-area"><section class="widget widget_search"><form role="search"><label>Search for: <input type="search"></label></form></section><section class="widget widget_recent"><h2>Recent posts</h2><ul><li><a href="/1">Fog again</a></li><li><a href="/2">New ropes</a></li></ul></section></aside>
<div id="comments" class="comments-area"><h2>2 thoughts</h2><ol class="comment-list"><li class="comment"><p>My boat was one of the three, thank you for the help that night.</p></li><li class="comment"><p>When will the upper basin be dredged?</p></li></ol></div>
<footer id="colophon" class="site-footer"><div class="site-info">Proudly run from a shed.</div></footer></div></body></html>""",
        "\n".join(("A night of high water", P[2], P[0], P[1], P[3])),
    ),
    (
        "a table cell without names",
        f"""<html><body><table><tr><td><a href=a>one</a></td><td><a href=b>two</a></td><td><a href=c>three</a></td></tr></table><table><tr><td><p>{P[0]}</p><p>{P[1]}</p><p>{P[2]}</p></td></tr></table></body></html>""",
        "\n".join(P[:3]),
    ),
    (
        "an encyclopaedia",
        f"""<html><body><div id="mw-page-base"></div><div id="content" class="mw-body" role="main"><h1 id="firstHeading">Pier (structure)</h1><div id="bodyContent"><div id="mw-content-text"><p>{P[0]} <sup>[1]</sup></p><h2>History</h2><p>{P[1]}</p><ul><li>{P[2]}</li><li>{P[3]}</li></ul></div></div></div>
<div id="mw-navigation"><div id="p-personal"><ul><li><a href="/talk">Talk</a></li><li><a href="/login">Log in</a></li></ul></div><div id="p-navigation"><h3>Navigation</h3><ul><li><a href="/main">Main page</a></li><li><a href="/random">Random page</a></li></ul></div></div>
<div id="footer"><ul><li>This page was last changed in March.</li><li><a href="/privacy">Privacy</a></li></ul></div></body></html>""",
        "\n".join(("Pier (structure)", P[0] + " [1]", "History", P[1], P[2], P[3])),
    ),
    (
        "hashed class names",
        f"""<html><body><div class="css-1a2b3c"><div class="css-9f8e7d"><a class="css-0" href="/">World</a><a class="css-0" href="/b">Business</a><a class="css-0" href="/s">Sport</a></div></div>
<main class="css-77aa"><section class="css-4d4d"><h1 class="css-h1h1">Nine votes to four</h1><div class="css-byby"><p class="css-p0p0">{P[3]}</p><p class="css-p0p0">{P[0]}</p><figure class="css-fgfg"><img src="a.jpg"><figcaption class="css-capc">The pier at dusk.</figcaption></figure><p class="css-p0p0">{P[1]}</p><p class="css-p0p0">{P[2]}</p></div></section></main>
<footer class="css-ff00"><a href="/t">Terms</a><a href="/j">Jobs</a><span>A harbour paper</span></footer></body></html>""",
        "\n".join(("Nine votes to four", P[3], P[0], "The pier at dusk.", P[1], P[2])),
    ),
    (
        "documentation with code",
        f"""<html><body><nav class="toc-sidebar"><ul><li><a href="#a">Install</a><ul><li><a href="#b">From source</a></li></ul></li></ul></nav><div class="document"><div class="body" role="main"><section id="a"><h1>Installing the tide table</h1><p>{P[1]}</p><pre>tide --install
tide --check</pre><p>{P[2]}</p><dl><dt>--check</dt><dd>{P[3]}</dd></dl></section></div></div><div class="footer">Built with a builder.</div></body></html>""",
        "\n".join(("Installing the tide table", P[1], "tide --install tide --check", P[2], "--check", P[3])),
    ),
    (
        "advert and sign-up set into a story",
        f"""<html><body><div class="topnav"><a href="/">Paper</a></div><div class="story-wrap"><h1>Walls are sound</h1><p>{P[0]}</p><div class="ad-container"><p>Ropes at half price, this week only!</p></div><p>{P[1]}</p><div class="newsletter-signup"><form><p>Get our letter every morning.</p><input type=email><button>Go</button></form></div><p>{P[2]}</p><p>{P[3]}</p></div>
<div class="cookie-banner"><p>We use cookies to make this site work, and some others to count visits.</p><button>Fine</button></div></body></html>""",
        "\n".join(("Walls are sound", *P)),
    ),
    (
        "no article",
        """<html><body><nav><a href="/">Home</a><a href="/join">Join</a></nav><form class="login-form"><label>User</label><input name=u><label>Password</label><input name=p type=password><button>Log in</button></form><footer>&copy; Harbour</footer></body></html>""",
        "",
    ),
]
