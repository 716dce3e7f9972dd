"""Labelled page layouts for training the block labeller.

Each layout lists its leaf blocks in page order: label (1 main text, 0 not),
path of open elements (``tag.class``), text, and ``L`` if all of it is a link.
The layouts differ in what the main part is called and in which boilerplate
stands before, inside and after it; the sentences are fillers.
"""

from __future__ import annotations

LONG = ("The council met on Tuesday evening and agreed, after three hours of talk, to rebuild the old bridge before "
        "the winter floods arrive again. Work is to begin in May.")
MIDDLE = "Nobody in the village remembers a warmer spring than this one."
SHORT = "It rained."

LAYOUTS = """
0|body/nav/ul/li|Home|L
0|body/nav/ul/li|World|L
0|body/nav/ul/li|Sport|L
1|body/article/h1|A bridge for the winter|
1|body/article/p|{long}|
1|body/article/p|{middle}|
1|body/article/p|{short}|
1|body/article/p|{long}|
0|body/footer|© 2024 The Daily. All rights reserved.|

0|body/header.site-header/div.logo|The Daily|L
0|body/header.site-header/nav/ul.menu/li|Politics|L
0|body/header.site-header/nav/ul.menu/li|Contact|L
0|body/div.cookie-notice|We use cookies to make this site better.|
1|body/main/article/header/h1|A warm spring|
0|body/main/article/header/p.byline|By A. Writer|
1|body/main/article/p|{middle}|
1|body/main/article/p|{long}|
0|body/main/article/div.ad|Buy two, get one free this week only!|
1|body/main/article/p|{long}|
1|body/main/article/ul/li|bring a coat|
1|body/main/article/ul/li|bring good shoes|
1|body/main/article/p|{short}|
0|body/main/article/div.share|Share this|
0|body/main/section.comments/h2|2 comments|
0|body/main/section.comments/div.comment/p|I do not believe a word of this, it was colder last year where I live.|
0|body/main/section.comments/div.comment/p|{middle}|
0|body/main/section.comments/form|Leave a comment|
0|body/aside.sidebar/h3|Most read|
0|body/aside.sidebar/ul/li|Ten ways to save water at home|L
0|body/aside.sidebar/ul/li|Why the bridge fell|L
0|body/footer/ul/li|Privacy|L
0|body/footer/p|© The Daily|

0|head/title|Notes on rivers|
0|body/div.header|Notes on rivers|L
0|body/div.nav/ul/li|About|L
0|body/div.nav/ul/li|Archive|L
1|body/div.post/h2|High water|
0|body/div.post/div.meta|Posted on 3 May|
1|body/div.post/div.entry/p|{long}|
1|body/div.post/div.entry/p|{short}|
1|body/div.post/div.entry/blockquote/p|{middle}|
1|body/div.post/div.entry/p|{long}|
0|body/div.post/div.tags|rivers, floods|L
0|body/div.related/h4|Related posts|
0|body/div.related/ul/li|Low water|L
0|body/div.comments/h3|Comments|
0|body/div.comments/ol/li/p|Thank you for this, I walked there yesterday and saw the same.|
0|body/div.comments/ol/li/p|{short}|
0|body/div.sidebar/div.widget|Search this site|
0|body/div.sidebar/div.widget/p|{middle}|
0|body/div.footer|Powered by a small engine|

0|head/title|Report|
0|body/div.topbar|Skip to content|L
0|body/table/tbody/tr/td.menu|Index|L
1|body/div.content/h1|Report of the year|
1|body/div.content/p|{long}|
1|body/div.content/h2|Costs|
1|body/div.content/table/tbody/tr/td|Steel|
1|body/div.content/table/tbody/tr/td|1200|
1|body/div.content/p|{middle}|
1|body/div.content/pre|a = b + c|
1|body/div.content/p|{long}|
0|body/div.bottom/p|Terms of use and privacy policy|

0|body/header/p|{middle}|
0|body/div.banner|Win a holiday: click here to sign up for our newsletter|
0|body/form|Log in|
0|body/form/label|Password|
0|body/form/button|Send|
1|body/section.story/h1|The quiet street|
1|body/section.story/p|{short}|
1|body/section.story/p|{middle}|
1|body/section.story/figure/figcaption|The street at noon.|
1|body/section.story/p|{long}|
0|body/section.story/aside|Read more: the loud street|L
1|body/section.story/p|{long}|
0|body/div.newsletter/p|Subscribe to our newsletter and never miss a story from your town.|
0|body/footer/p|{middle}|
0|body/footer/p|{long}|

0|body/nav/ul/li|start|L
0|body/nav/ul/li|end|L
0|body/div.ad|{middle}|
1|body/article/h1|word word word|
1|body/article/p|word word word ### word *** word %%%|
1|body/article/p|{long}|
1|body/article/p|WORD!! WORD!! WORD!!|
1|body/article/p|a , b|
0|body/footer|© www.example.com · {middle} {long}|

0|body/nav/ul/li|one|L
0|body/div.ads|{long}|
1|body/article/h1|{middle}|
1|body/article/p|{middle}|
0|body/footer|© example · {short}|

0|body/nav.breadcrumb/ol/li|Shop|L
0|body/div.alert|Delivery may be late this week. Sorry!|
1|body/div#main/h1|The blue kettle|
1|body/div.main/p|{middle}|
1|body/div.main/ul/li|holds two litres|
1|body/div.main/p|{long}|
0|body/div.reviews/p|{long}|
0|body/div.reviews/p|I like it a lot, but the lid is loose.|
0|body/div.promo/p|{middle}|
0|body/footer/nav/ul/li|Returns|L

0|body/div.modal/p|{long}|
0|body/div.consent/button|Accept|
0|body/header/nav/ul/li|News|L
1|body/main/p|{long}|
1|body/main/p|{middle}|
1|body/main/h2|Next steps|
1|body/main/p|{long}|
1|body/main/ol/li|{middle}|
1|body/main/ol/li|{short}|
0|body/main/div.subscribe|Sign up|
0|body/main/aside/p|{long}|
0|body/footer/address|12 Mill Lane|

0|body/div.header/h1|Example site|L
0|body/p|Menu|L
1|body/p|{long}|
1|body/p|{long}|
1|body/p|{middle}|
1|body/p|{long}|
0|body/p|copyright 2020|
""".format(long=LONG, middle=MIDDLE, short=SHORT)


def labelled_pages() -> list[list[tuple[int, str, str, bool]]]:
    """(label, path, text, is a link) of every block, page by page."""
    pages = []
    for layout in LAYOUTS.strip().split("\n\n"):
        blocks = []
        for line in layout.split("\n"):
            label, path, text, link = line.split("|")
            blocks.append((int(label), path.replace("#", "."), text, link == "L"))
        pages.append(blocks)
    return pages
