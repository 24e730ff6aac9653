"""Labelled pages from which the block classifier of ``html.py`` is trained.

Each entry is a page written for this purpose and the texts of its content blocks.
"""

PAGES = (
    (
        """<!DOCTYPE html><html><head><title>River</title><script>var a = "<p>no</p>";</script></head><body>
<nav><ul><li><a href="/a">News</a></li><li><a href="/b">Sport and games</a></li><li><a href="/c">Weather</a></li></ul></nav>
<div class="ad">Buy a boat today and save a lot of money on every trip you make.</div>
<article><h1>The river rises</h1><p><b>Rain has fallen for three days in the hills above the town.<br>Nobody was hurt.</b></p>
<p>Yes.</p><p>People near the bridge were asked to leave their houses before the evening, the mayor said.</p><p>More soon</p></article>
<footer>&copy; 2020 River Times. All rights reserved by the owners of this paper.</footer></body></html>""",
        (
            "The river rises",
            "Rain has fallen for three days in the hills above the town. Nobody was hurt.",
            "Yes.",
            "People near the bridge were asked to leave their houses before the evening, the mayor said.",
            "More soon",
        ),
    ),
    (
        """<html><body><header><div class="logo"><a href="/">Garden Weekly</a></div><p>Everything about plants since 1950</p></header>
<div id="cookie-notice"><p>We use cookies to make this site better for you, and to count visits.</p><button>Accept</button></div>
<main><h1>Roses in winter</h1><p>Cut them back in <a href="/march">March</a> and cover the roots with leaves until the frost is over.</p>
<h2>Soil</h2><p>Loose soil is best.</p><ul><li>Sand</li><li>Compost from last year</li></ul>
<aside><h3>Related</h3><p>Tulips need a cold winter as well, as our test has shown.</p></aside>
<div class="newsletter-signup"><p>Get our letter each week with tips for the garden and more.</p></div>
<p>Water them once a week.</p></main>
<section class="comments"><h3>2 comments</h3><p>I did this last year and all of my roses came back, thank you.</p><p>Nice</p></section>
<footer><p>Contact us</p><p>Garden Weekly is printed on paper from forests that are managed well.</p></footer></body></html>""",
        (
            "Roses in winter",
            "Cut them back in March and cover the roots with leaves until the frost is over.",
            "Soil",
            "Loose soil is best.",
            "Sand",
            "Compost from last year",
            "Water them once a week.",
        ),
    ),
    (
        """<html><body><div id="header"><h1><a href="/">My trips</a></h1></div><div class="navbar"><a href="/1">Home</a> <a href="/2">About me</a></div>
<div class="post-content"><h2>Two weeks on the coast</h2><p>We took the train on a Monday and reached the sea in the afternoon.</p>
<p>Sun!</p><blockquote>The sea is never the same for two days.</blockquote><p>On the last day we walked back along the cliffs and saw seals.</p></div>
<div class="sidebar"><h3>Archive</h3><ul><li><a href="/5">May</a></li><li><a href="/6">June</a></li></ul><p>I write about trips by train and on foot.</p></div>
<div id="comments"><p>Great pictures, I want to go there next summer with my family.</p></div>
<div class="copyright">All pictures were taken by me and may be used with my name.</div></body></html>""",
        (
            "Two weeks on the coast",
            "We took the train on a Monday and reached the sea in the afternoon.",
            "Sun!",
            "The sea is never the same for two days.",
            "On the last day we walked back along the cliffs and saw seals.",
        ),
    ),
    (
        """<html><body><p><a href="/">Index</a> | <a href="/n">Next page</a> | <a href="/p">Previous page</a></p>
<h1>How the clock was built</h1><p>The first wheels were cut by hand in a small shop near the market, and it took a year.</p>
<p>The bell came later. It was cast from old cannons that nobody needed any more after the war.</p>
<p>Today the clock is wound once a week by the same family that has done it since then.</p>
<p><a href="/x">Map of the site</a></p><p><a href="/y">Write to us</a></p></body></html>""",
        (
            "How the clock was built",
            "The first wheels were cut by hand in a small shop near the market, and it took a year.",
            "The bell came later. It was cast from old cannons that nobody needed any more after the war.",
            "Today the clock is wound once a week by the same family that has done it since then.",
        ),
    ),
    (
        """<html><body><table><tr><td><a href="/1">Start</a></td><td><a href="/2">Shop for tools</a></td></tr>
<tr><td class="menu"><p>Choose a topic from the list to see what we have on it.</p></td>
<td><p>A plane should be sharp enough to cut the hair on your arm, or it will tear the wood.</p>
<p>Grind it, hone it on a fine stone, and draw it over leather until the burr is gone.</p></td></tr></table>
<form><p>Search all pages of this site:</p><input name="q"><select><option>Tools</option><option>Wood</option></select></form></body></html>""",
        (
            "A plane should be sharp enough to cut the hair on your arm, or it will tear the wood.",
            "Grind it, hone it on a fine stone, and draw it over leather until the burr is gone.",
        ),
    ),
    (
        """<html><body><div class="banner">This site is read only tonight while we move it to new machines.</div>
<nav><a href="/">Front page</a><p>Choose your town from the list of towns that we serve each day.</p></nav>
<article><header><h1>New school opens</h1></header><p>Lessons start on Monday.</p>
<div class="advertisement"><p>Shoes for school at half the price, only this week and in all shops.</p></div>
<figure><img src="x.png"><figcaption>The new hall</figcaption></figure>
<p>There is room for six hundred children in a building that was once a mill.</p>
<div class="share-buttons"><a href="#">Share</a> <a href="#">Send</a></div>
<ul><li>Twelve rooms</li><li>One hall that seats all of the children at once</li></ul>
<section id="reader-comments"><h2>What readers say</h2><article class="comment"><p>My children will go there and we are very happy about it.</p></article>
<article class="comment"><p>Finally!</p></article></section></article>
<aside class="sidebar"><h2>Most read</h2><ol><li><a href="/1">Bridge closed for repairs until the autumn</a></li><li><a href="/2">Cat saved</a></li></ol></aside>
<footer><ul><li><a href="/i">Imprint</a></li><li><a href="/t">Terms of use</a></li></ul></footer></body></html>""",
        (
            "New school opens",
            "Lessons start on Monday.",
            "The new hall",
            "There is room for six hundred children in a building that was once a mill.",
            "Twelve rooms",
            "One hall that seats all of the children at once",
        ),
    ),
    (
        """<html><body><div>Skip to the text</div><div>Menu</div><main><p>Salt keeps food from going bad, which is why ships carried so much of it.</p>
<p>Cheap</p><p>See also <a href="/s">sugar</a>, <a href="/p">pepper</a>.</p><form><label>Your mail</label><input><p>We send at most one letter each month to you.</p></form>
<div role="complementary"><p>Three books on salt that we have read and liked this year.</p></div></main>
<div>Text and pictures belong to their authors and may not be copied without asking them.</div><div>Up</div></body></html>""",
        ("Salt keeps food from going bad, which is why ships carried so much of it.", "Cheap", "See also sugar, pepper."),
    ),
    (
        """<html><body><ul><li><a href="/a">Alpha</a></li><li><a href="/b">Beta</a></li></ul>
<div class="entry"><h1>Notes on bread</h1><div>Flour, water, salt and time are all that is needed for a good loaf.</div><div>Wait.</div>
<div>Bake it hot for the first ten minutes, then turn the oven down and let it dry.</div></div>
<div class="related"><div>Notes on butter and how it is made on small farms today</div></div><div class="cookies">Cookies help us. Do you accept them?</div>
<div class="popup"><p>Before you leave: would you like to read one more story from us?</p></div></body></html>""",
        (
            "Notes on bread",
            "Flour, water, salt and time are all that is needed for a good loaf.",
            "Wait.",
            "Bake it hot for the first ten minutes, then turn the oven down and let it dry.",
        ),
    ),
    (
        """<html><body><article><p>Short</p><p>One line more</p><p>No</p><h2>End</h2></article><div>Read more stories like this one on our front page every day of the week.</div>
<p>Follow us</p><div class="social">Tell your friends about this page with one click</div></body></html>""",
        ("Short", "One line more", "No", "End"),
    ),
    (
        """<html><body><nav><p>You are here and can go back to the list of all the towns in this part</p></nav><div><p>Log in</p><p><a href="/r">Register for free</a></p></div>
<p>Bees fly up to three miles from the hive when there is little to find close to it.</p><p>They tell each other where to go by a dance.</p>
<aside><p>Honey from our own bees can be bought in the shop on Fridays.</p></aside>
<p>The dance gives the direction and how far it is, and other bees can read it in the dark.</p>
<footer><p>This page was last changed in the spring and is kept by friends of the bees.</p></footer></body></html>""",
        (
            "Bees fly up to three miles from the hive when there is little to find close to it.",
            "They tell each other where to go by a dance.",
            "The dance gives the direction and how far it is, and other bees can read it in the dark.",
        ),
    ),
    (
        """<html><body><div>Menu</div><div>Page 3 of 9</div><div>Log in</div>
<div>Ships leave the harbour twice a day, at dawn and when the tide turns in the evening.</div><div>The trip takes four hours, and there is hot soup on board for all who feel cold.</div>
<div>In winter the sea can be rough and some of the ships stay in the harbour for days.</div><div>Up</div><div>Print this</div><div>Contact</div></body></html>""",
        (
            "Ships leave the harbour twice a day, at dawn and when the tide turns in the evening.",
            "The trip takes four hours, and there is hot soup on board for all who feel cold.",
            "In winter the sea can be rough and some of the ships stay in the harbour for days.",
        ),
    ),
    (
        """<html><body><p>Home</p><p>Shop</p><p>Help</p><p>Wool from mountain sheep is coarse but very warm, and it lasts for many years.</p>
<p>Wash it by hand.</p><p>Dry it flat on a towel, away from the sun, and never hang it up while it is wet.</p><p>Share</p><p>Terms</p></body></html>""",
        (
            "Wool from mountain sheep is coarse but very warm, and it lasts for many years.",
            "Wash it by hand.",
            "Dry it flat on a towel, away from the sun, and never hang it up while it is wet.",
        ),
    ),
)
