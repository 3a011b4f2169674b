"""Pages with their main text between BEGIN and END, from which html_extract counts its weights.

They cover pages with and without semantic elements; the prose is invented. Most are made by rule: each word that
names what stands around or inside a text gets a page where it does.
"""

BEGIN, END = "<!--main-->", "<!--/main-->"

#: Words of class and id of what isn't main text, by kind, and a text that such an element holds.
AROUND = {
    "Home News Sport Weather About us": "nav navbar navigation menu menus breadcrumb breadcrumbs toolbar skip pagination pager",
    "The Valley Paper since 1901": "masthead banner header",
    "Printed in the valley, all rights reserved by the paper and its friends.": "footer copyright legal disclaimer",
    "We use cookies to make this site better for you. Read more or agree.": "cookie cookies consent gdpr notice notices alert popup modal overlay",
    "Buy boots now at half the price, this week only.": "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion",
    "Get the letter every morning, enter your address here.": "newsletter subscribe subscription signup login",
    "Most read: rye harvest, the new mill, a bridge in spring": "sidebar sidebars widget widgets related recommended recommendations",
    "Tell your friends about this page": "share sharing social",
    "I was there too and saw the water come up to the door. Thank you for telling it so well.": "comment comments disqus reply replies respond",
}
#: Words of class and id inside a main text, those that tell of what a wrapper has besides, and those that say nothing.
INSIDE = "article post entry story piece headline title lead chapter essay report prose hentry"
BESIDES = "with has no without layout page"
NEUTRAL = "content container wrapper body text box inner block section list item"

_LONG = "The river rose for three days and the mill stood still while people carried sand along the bank at night and slept in the school by day. "
_MORE = "Nobody could say when the bridge would open again, and the baker walked the long way round with bread for both sides of the town. "
_MENU = "".join(f'<li><a href="/{x}">{x}</a></li>' for x in ("Home", "News", "Sport", "Weather", "About us", "Contact"))

_BY_HAND = (
    # an article element with menu, notice and footer around it
    f"<html><head><title>Flood</title></head><body><nav><ul>{_MENU}</ul></nav><div class='ad'>Buy boots now at half the price.</div>"
    f"<article>{BEGIN}<h1>Flood at the mill</h1><p>{_LONG}<p>{_MORE}<a href='/map'>map of the bank</a> {_LONG}</p><p>Rain fell.</p>{END}</article>"
    f"<aside><h3>Most read</h3><ul>{_MENU}</ul></aside><footer>Copyright by the paper, all rights reserved.</footer></body></html>",
    # a main element; a comment section inside it; list and quotation in the text
    f"<body><header><div class='logo'>The Paper</div><form><input><button>Search</button></form></header><div>Tuesday edition</div>"
    f"<main class='page'>{BEGIN}<h1>Bread for both sides</h1><p><b>{_MORE}</b><br>{_LONG}</p><ul><li>{_MORE}</li><li>Rye</li></ul><blockquote>{_LONG}</blockquote><h2>After</h2><p>{_MORE}</p>{END}"
    f"<section id='comments'><h3>3 comments</h3><div class='comment'><p>First! I was there too.</p></div></section></main><footer><p>Imprint</p></footer></body>",
    # divisions without semantic elements
    f"<html><body><div>The Valley Paper</div><div>Tuesday edition</div><div id='top'><a href='/'>Start</a> | <a href='/a'>Archive</a> | <a href='/l'>Links</a></div><div><div>{BEGIN}<h2>Sand</h2><p>{_LONG}</p><p>{_MORE}</p><p>Then it stopped.</p><p>{_LONG}{_MORE}</p>{END}"
    f"</div></div><div><ul>{_MENU}</ul></div><div><a href='/x'>Back</a><a href='/y'>Print</a></div><div>Printed in the valley</div></body></html>",
    # text in divisions only, with a cookie notice and a sidebar
    f"<html><body><div>Weather: rain</div><div class='cookie-notice'>We use cookies to improve this site. <a href='/c'>More</a></div><table><tr><td><a href='/1'>One</a></td><td><a href='/2'>Two</a></td></tr></table>"
    f"<div>{BEGIN}<div>{_LONG}{_MORE}</div><div>{_MORE}</div><div>{_LONG}</div>{END}</div><div class='sidebar'>Related: <ul>{_MENU}</ul></div></body></html>",
    # an article with an advertisement in the middle
    f"<body><div class='site-header'>Daily news from the valley</div><article>{BEGIN}<header><h1>Bridge opens</h1><p>By a reporter</p></header><p>{_LONG}</p>{END}<div class='ad-slot'>Ten percent off all umbrellas this week.</div>{BEGIN}<p>{_MORE}{_LONG}</p>{END}</article>"
    f"<div>Next story</div><div class='newsletter'>Get the letter <form><input></form></div><footer><ul>{_MENU}</ul></footer></body>",
)


def _by_rule() -> list[str]:
    around = [(word, text) for text, words in AROUND.items() for word in words.split()]
    inside, neutral = INSIDE.split(), NEUTRAL.split()
    made = []
    for i, (word, text) in enumerate(around):
        own, more = inside[i % len(inside)], neutral[i % len(neutral)]
        other, other_text = around[(7 * i + 3) % len(around)]
        tag = ("div", "article", "main", "section")[i % 4]
        # A word alone, with one that says nothing, and with one of the text beside it, as in related-posts.
        for j, outer in enumerate((f"<div class='{word}'><p>{text}</p></div>", f"<div id='{word}-{more}'>{text}</div>", f"<section class='{own}-{word}'><p>{text}</p></section>")):
            inner = f"<div class='{other} {more}'>{other_text}</div>" if j else ""
            body = f"{BEGIN}<h1>{_LONG[: 20 + i]}</h1><div class='{own}-{more}'><p>{_LONG}</p><p>{_MORE}{_LONG}</p></div>{END}{inner}{BEGIN}<p>{_MORE}</p><p>Rain fell.</p>{END}"
            made.append(f"<html><body><div class='{more}'>{text}</div>{outer if j else ''}<{tag} class='{own} {more}'>{body}</{tag}>{'' if j else outer}<div><a href='/'>{other_text}</a></div></body></html>")
    for word in BESIDES.split():  # wrappers that tell what they have besides the text
        for other in "toc rail gutter extras".split():
            made.append(f"<body><div class='{word}-{other}'>{BEGIN}<p>{_LONG}</p><p>{_MORE}</p>{END}</div><div>Next story</div></body>")
    for word in "comment comments reply related teaser promo sponsored advert ad".split():  # elements of their own that are no articles
        made.append(f"<body><article class='{INSIDE.split()[len(word) % 5]}'>{BEGIN}<p>{_LONG}{_MORE}</p>{END}<article class='{word}'><p>{_MORE}</p></article></article></body>")
    for name in "nav footer aside form button dialog menu search fieldset".split():  # elements that hold no text, inside one and around it
        made.append(f"<body><article>{BEGIN}<h1>Sand</h1><p>{_LONG}</p>{END}<{name}>Something else here.</{name}>{BEGIN}<p>{_MORE}</p>{END}</article><{name}>{_MORE}</{name}></body>")
        made.append(f"<body><div>{BEGIN}<p>{_LONG}{_MORE}</p>{END}</div><{name}>Something else here.</{name}></body>")
    for role in "navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split():
        made.append(f"<body><div role='{role}'>{_MORE}</div><article>{BEGIN}<p>{_LONG}</p>{END}</article></body>")
    made.append(f"<body><p hidden>{_LONG}</p><p style='display:none'>{_MORE}</p><header>{_MORE}</header><article><header>{BEGIN}<h1>Sand</h1>{END}</header>{BEGIN}<p>{_LONG}</p>{END}</article></body>")
    return made


PAGES = (*_BY_HAND, *_by_rule())
