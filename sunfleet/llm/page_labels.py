"""Hand-labelled pages for the block model. ``data-label`` marks main text (1) and what lies inside it but is not (0)."""

_P1 = "The committee met on Tuesday to discuss the new plan, which had been delayed for several months by the storm."
_P2 = "Residents said they were relieved, although some of them still had questions about the cost. The mayor promised answers."
_P3 = "Work will begin in spring, and the first part should be open by the end of the year, officials said."
_SHORT = "It was over."

LABELLED_PAGES = (
    f"""<html><head><title>News</title></head><body><header class="site-header"><div class="logo"><a href="/">Daily News</a></div>
<nav><ul><li><a href="/a">World</a></li><li><a href="/b">Sports</a></li><li><a href="/c">Opinion</a></li></ul></nav></header>
<div class="breadcrumbs"><a href="/">Home</a> &raquo; <a href="/city">City</a></div>
<div id="content" data-label="1"><h1>Plan for the bridge</h1><p>{_P1}</p><p>{_P2}</p><h2>What is next</h2><p>{_P3}</p>
<div class="ad" data-label="0">Buy two, get one free. Only this week.</div><p>{_SHORT}</p></div>
<aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Ten ways to save</a></li><li><a href="/2">The best soup</a></li></ul></aside>
<div id="comments"><h3>2 comments</h3><div class="comment"><p>I think this is a bad idea, but nobody asks us.</p></div><div class="comment"><p>Great news for the town!</p></div></div>
<footer><p>&copy; 2020 Daily News. All rights reserved.</p><a href="/terms">Terms</a></footer></body></html>""",
    f"""<html><body><div class="cookie-notice"><p>We use cookies to improve your visit. By using this site you agree.</p><a href="#">Accept</a></div>
<div class="menu"><a href="/">Start</a> <a href="/blog">Blog</a> <a href="/about">About</a></div>
<div class="post"><div class="entry" data-label="1"><h2>My week</h2><p>{_P2}</p><blockquote><p>{_P1}</p></blockquote><ul><li>We packed the tent and the food.</li><li>We drove until it was dark.</li></ul><p>{_P3}</p></div>
<div class="share"><a href="/t">Tweet</a> <a href="/f">Share</a></div></div>
<form action="/sub"><p>Subscribe to our newsletter and never miss a post.</p><label>Email</label><input name="e"></form>
<div class="footer">Powered by a blog engine</div></body></html>""",
    f"""<!DOCTYPE html><html><body><nav><a href="/">Home</a><a href="/docs">Docs</a></nav><main data-label="1"><article><header data-label="1"><h1>Release notes</h1></header>
<p>{_P3}<br>{_SHORT}<p>{_P1}<table><tr><th>Name</th><th>Size</th></tr><tr><td>First part</td><td>12</td></tr></table><pre>run the job again</pre>
<section class="comments" data-label="0"><h4>Leave a reply</h4><p>Thanks, this helped me a lot. I had the same problem.</p></section></article></main>
<aside><p>Related: how to install the tool, and what to do when it fails.</p></aside><footer><small>Copyright 2019</small></footer></body></html>""",
    f"""<html><body><table><tr><td class="nav"><ul><li><a href="1">News</a><li><a href="2">Archive</a><li><a href="3">Links</a></ul></td>
<td class="main" data-label="1"><h1>History of the mill</h1><p>{_P1}<p>{_P2}<p>{_P3}</td><td class="right"><p>Advertisement</p><p>Win a trip to the sea today!</p></td></tr></table>
<p class="copyright">(c) the authors, 2004. Contact us.</p></body></html>""",
    f"""<html><body><div class="banner">Notice: the site will be down on Sunday.</div><div role="navigation"><a href="/x">Index</a> | <a href="/y">Next</a></div>
<article data-label="1"><h1>A short story</h1><p><em>{_SHORT}</em> {_P1}</p><p>{_P2}</p><figure><figcaption>The mill in 1920.</figcaption></figure></article>
<div class="related-posts"><h3>You may also like</h3><a href="/q">Another story</a><a href="/r">The last train</a></div>
<div class="author-bio"><p>The author lives in a small town and writes about trains, food and rivers.</p></div>
<div class="comment-list"><ul><li>First! I loved it, and I read it twice.</li><li>Me too, it made me think.</li></ul></div><footer><p>Imprint. Privacy. All rights reserved.</p></footer></body></html>""",
    f"""<html><body><div id="header"><h1><a href="/">Site name</a></h1></div><div id="main"><div class="article-body" data-label="1"><h2>Repairs at the station</h2><div>{_P1}</div><div>{_P2}</div><div>{_P3}</div></div>
<div class="tags">Tags: <a href="/t1">station</a>, <a href="/t2">repairs</a></div></div><div id="sidebar"><div class="widget"><h4>Weather</h4>Rain, 12 degrees</div><div class="widget"><h4>Search</h4><form><input></form></div></div>
<div id="footer">About us, contact, jobs. Copyright 2011 the station paper.</div></body></html>""",
)
