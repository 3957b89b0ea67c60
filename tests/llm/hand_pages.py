"""Pages written by hand, none of them from the trainer's templates: name, page, texts of the article, texts beside it."""

PAGES = [
    (
        "travel",
        """<!doctype html><html><head><title>Night train</title></head><body class="home-page">
<div id="topbar"><a href="/">Rail Notes</a> <a href="/about">About</a> <a href="/contact">Contact</a></div>
<main id="maincol"><h1>By night train to the coast</h1>
<p class=lead>The night train leaves the capital at nine and is at the sea by breakfast.</p>
<p title=it's>There are two kinds of compartments, and both can be booked online.</p>
<h2>Stops</h2><ul><li>Nine stops</li><li>Two border checks</li><li>One change of engine, which takes an hour and wakes everybody up</li></ul>
<table><tr><th>Stop</th><th>Time</th></tr><tr><td>Hillford</td><td>21:40</td></tr><tr><td>Port Anne</td><td>06:55</td></tr></table>
<p>Bring earplugs: the old cars are loud, and the line has many curves.</p></main>
<div id="disqus_thread"><div><p>Took this train last year with my kids, loved every minute of the ride!</p></div></div>
<div>Copyright 2022 Rail Notes. All rights reserved.</div></body></html>""",
        ["By night train to the coast", "The night train leaves the capital at nine and is at the sea by breakfast.", "There are two kinds of compartments, and both can be booked online.",
         "Stops", "Nine stops", "Two border checks", "One change of engine, which takes an hour and wakes everybody up", "Stop", "Time", "Hillford", "21:40", "Port Anne", "06:55",
         "Bring earplugs: the old cars are loud, and the line has many curves."],
        ["Rail Notes", "About", "Contact", "Took this train last year", "All rights reserved"],
    ),
    (
        "recipe",
        """<html><body><nav class="nav-main"><a href="/soups">Soups</a><a href="/cakes">Cakes</a></nav>
<div class="recipe-wrapper"><article class="recipe"><h1>Plum cake</h1><p>A cake for late summer, when the plums are ripe and cheap.</p>
<h3>You need</h3><ul class="ingredients"><li>500 g plums<li>200 g flour<li>3 eggs</ul>
<h3>How to</h3><ol><li>Stone the plums and cut them in halves.</li><li>Beat the eggs with the sugar until the mass is white.</li><li>Bake for forty minutes.</li></ol>
<blockquote>My grandmother took butter, never oil.</blockquote></article></div>
<aside><h4>More cakes</h4><ul><li><a href="/c1">Apple cake</a></li><li><a href="/c2">Cheese cake</a></li></ul></aside>
<section class="comments-area"><h3>3 comments</h3><p>Made it twice this week and everyone at work wanted the recipe.</p></section>
<footer><p>Made with love. <a href="/privacy">Privacy policy</a></p></footer></body></html>""",
        ["Plum cake", "A cake for late summer, when the plums are ripe and cheap.", "You need", "500 g plums", "200 g flour", "3 eggs", "How to", "Stone the plums and cut them in halves.",
         "Beat the eggs with the sugar until the mass is white.", "Bake for forty minutes.", "My grandmother took butter, never oil."],
        ["Soups", "More cakes", "Apple cake", "3 comments", "Made it twice", "Made with love."],
    ),
    (
        "news",
        """<html><body><header class="masthead"><div class="logo">The Daily Post</div><form><input><button>Search</button></form></header>
<div class="cookie-bar">We use cookies. <button>OK</button></div>
<div class="article-body"><h1>Council votes for new bridge</h1><div class="byline">By A. Writer</div>
<p>The council voted on Monday to build a new bridge over the river, ending ten years of debate.</p>
<p>Work is to begin in spring, and the bridge should be open three years later, the mayor said.</p>
<div class="advert"><p>Buy two, get one free: only this week at the garden centre.</p></div>
<figure><img src=b.jpg alt=""><figcaption>The old bridge in winter</figcaption></figure>
<p>&ldquo;It was about time,&rdquo; said a shop owner from the north bank.</p></div>
<div class="related-links"><h3>Read more</h3><ul><li><a href=1>River level falls</a><li><a href=2>Old bridge closed again</a></ul></div>
<div id="footer">Imprint | Terms of use</div></body></html>""",
        ["Council votes for new bridge", "By A. Writer", "The council voted on Monday to build a new bridge over the river, ending ten years of debate.",
         "Work is to begin in spring, and the bridge should be open three years later, the mayor said.", "The old bridge in winter", "“It was about time,” said a shop owner from the north bank."],
        ["The Daily Post", "We use cookies.", "Buy two", "Read more", "River level falls", "Imprint"],
    ),
    (
        "manual",
        """<html><body><div class="sidebar-nav"><ul><li><a href="#i">Install</a></li><li><a href="#u">Use</a></li></ul></div>
<div class="content-area"><h1>Install the pump</h1><p>Shut the main valve before you begin, and let the pipe run dry.</p>
<dl><dt>Valve</dt><dd>The red wheel under the sink.</dd><dt>Filter</dt><dd>A sieve that must be cleaned twice a year.</dd></dl>
<pre>pump --start   --slow</pre><h2>If it fails</h2><p>Look at the lamp. If it is <b>red</b>, call the service.</p></div>
<div class="breadcrumbs"><a href="/">Home</a> / <a href="/m">Manuals</a></div></body></html>""",
        ["Install the pump", "Shut the main valve before you begin, and let the pipe run dry.", "Valve", "The red wheel under the sink.", "Filter", "A sieve that must be cleaned twice a year.",
         "pump --start --slow", "If it fails", "Look at the lamp. If it is red, call the service."],
        ["Install", "Use", "Home / Manuals"],
    ),
    (
        "blog",
        """<html><body><div id="header"><h1><a href="/">My garden blog</a></h1></div><div id="content"><div class="post">
<h2>Tomatoes in the rain</h2><p>It rained for three weeks and the tomatoes did not like it at all.<p>What helped was a roof of old windows, which I found behind the shed.
<ul><li>Keep the leaves dry</li><li>Water from below</li></ul><p>Next year I will build a proper house for them.</div></div>
<div id="respond"><h3>Leave a reply</h3><form><label>Name</label><textarea></textarea></form></div>
<ol class="commentlist"><li>Anna: Same here, we lost all of ours in one night, what a summer.</li><li>Ben: Try an older sort next time.</li></ol>
<div id="sidebar"><h3>Archive</h3><ul><li><a href=a>May</a><li><a href=b>June</a></ul></div><p>Powered by a small shop</p></body></html>""",
        ["Tomatoes in the rain", "It rained for three weeks and the tomatoes did not like it at all.", "What helped was a roof of old windows, which I found behind the shed.", "Keep the leaves dry",
         "Water from below", "Next year I will build a proper house for them."],
        ["My garden blog", "Leave a reply", "Anna: Same here", "Ben: Try", "Archive", "Powered by"],
    ),
    (
        "plain",
        """<html><body><div><a href="/">Start</a> | <a href="/list">List</a></div><div><h1>The lighthouse</h1><p>The lighthouse was built in 1863 from grey stone that came by ship.</p>
<p>It has 211 steps, and whoever climbs them sees two islands and the old harbour.</p><p>Today nobody lives there any more.</p></div><div>&copy; 2021 Harbour Society. All rights reserved.</div></body></html>""",
        ["The lighthouse", "The lighthouse was built in 1863 from grey stone that came by ship.", "It has 211 steps, and whoever climbs them sees two islands and the old harbour.",
         "Today nobody lives there any more."],
        ["Start | List", "Harbour Society"],
    ),
]
