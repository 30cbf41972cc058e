"""Labelled training pages for ``html_extract``: families of layouts with their main text marked.

An element with ``data-y="c"`` holds main text and one with ``data-y="b"`` boilerplate; what is inside inherits the mark of
the nearest marked element. Words of prose are random letters, so nothing can be learned from them; the words of menus,
headings of side blocks, notices and the like are the usual ones.
"""

from __future__ import annotations

import random
from collections.abc import Callable

MENU = "Home,About,About us,Contact,Contact us,Blog,News,Products,Services,Shop,Support,Help,FAQ,Login,Log in,Sign in,Sign up,Register,Search,Archive,Categories,Forum,Docs,Pricing,Careers,Team,Events,Gallery,Menu,Privacy,Privacy policy,Terms,Terms of use,Sitemap,RSS,Next,Previous,Skip to content,Sports,World,Politics,Business,Culture,Cart,My account".split(",")
SIDE = "Related posts,Related articles,Recent posts,Recent comments,Popular posts,Most read,Most popular,Trending,Trending now,You may also like,Read more,Read next,More from us,More stories,Recommended,Recommended for you,Categories,Archives,Tags,Links,Blogroll,About me,About the author,Follow us,Share this,In this section,On this page,Table of contents,See also our other pages,Latest news,Editor's picks,Navigation,Meta,Calendar,Sponsors,Advertisement".split(",")
TALK = "Comments,Reader comments,Leave a comment,Leave a reply,Responses,Discussion,Join the discussion,What readers say,3 comments,12 comments,2 responses,3 thoughts on this,One thought on this,Post a comment,Add your comment,Replies,User comments,Conversation,View comments,5 replies".split(",")
ASK = "Newsletter,Subscribe,Subscribe to our newsletter,Sign up for updates,Stay informed,Join our mailing list,Get the latest in your inbox,Search,Log in,Contact us,Enter your email".split(",")
NOTICE = "We use cookies to improve your experience.,This site uses cookies.,By continuing you accept our use of cookies.,Please enable JavaScript.,You have read all your free articles this month.,Subscribe now to continue reading.,Your privacy matters to us.,Accept all cookies.,Download our app.".split(",")
LEGAL = "All rights reserved.,All rights reserved,Copyright,Powered by,Proudly powered by,Terms of service,Privacy policy,Imprint,Legal notice,Contact,Designed by,Last modified".split(",")
META = "Posted on,Published,Written by,By,Posted by,Filed under,Posted in,Tagged,Updated,Share,Tweet,Print,Email,min read,views,Reply,Permalink,Edit,Leave a comment".split(",")
MONTHS = "January,February,March,April,May,June,July,August,September,October,November,December".split(",")
GLUE = "the of and to in a is that for on with as it was by at from this be are or an which not has have were but their its".split()


class Maker:
    """Draws pieces of pages; ``bare`` is the share of class names left out."""

    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.bare = 0.3

    def word(self) -> str:
        return self.r.choice(GLUE) if self.r.random() < 0.25 else "".join(self.r.choice("etaoinshrdlucmfwypvbgk") for _ in range(self.r.randint(2, 9)))

    def words(self, lo: int, hi: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(lo, hi)))

    def name(self) -> str:
        return " ".join(self.word().title() for _ in range(self.r.randint(1, 2)))

    def sentence(self, lo: int = 4, hi: int = 24) -> str:
        return self.words(lo, hi).capitalize() + self.r.choice([".", ".", ".", ".", ".", "!", "?", ":", ""])

    def sentences(self, lo: int, hi: int) -> str:
        return " ".join(self.sentence() for _ in range(self.r.randint(lo, hi)))

    def named(self, tag: str, names: str, body: str, y: str = "", keep: bool = False) -> str:
        """An element with one of the comma-separated names as class or id, now and then without, or spelled otherwise."""
        name = self.r.choice(names.split(","))
        at = f' data-y="{y}"' if y else ""
        if name and (keep or self.r.random() > self.bare):
            way = self.r.random()
            name = name.replace(" ", "-" if way < 0.5 else "_" if way < 0.6 else " ") if way < 0.9 else "".join(x.title() for x in name.split())
            at += f' {self.r.choice(["class", "class", "id"])}="{name}"'
        elif self.r.random() < 0.1:
            at += f' class="{"".join(self.r.choice("bcdfghjk") for _ in range(5))}"'
        return f"<{tag}{at}>{body}</{tag}>"

    def any(self, *choices: Callable[[], str]) -> str:
        return self.r.choice(choices)()

    def some(self, make: Callable[[], str], lo: int, hi: int, glue: str = "") -> str:
        return glue.join(make() for _ in range(self.r.randint(lo, hi)))

    def date(self) -> str:
        return self.r.choice([f"{self.r.choice(MONTHS)} {self.r.randint(1, 28)}, {self.r.randint(1999, 2025)}", f"{self.r.randint(1999, 2025)}-0{self.r.randint(1, 9)}-{self.r.randint(10, 28)}", f"{self.r.randint(1, 28)}.{self.r.randint(1, 12)}.{self.r.randint(1999, 2025)}"])

    def link(self, text: str | None = None) -> str:
        return f'<a href="/{self.r.randint(1, 99)}">{text or (self.r.choice(MENU) if self.r.random() < 0.6 else self.words(1, 3))}</a>'

    # main text

    def block(self) -> str:
        """A block of main text."""
        k = self.r.random()
        if k < 0.05:
            return f"<blockquote>{self.any(lambda: f'<p>{self.sentences(1, 3)}</p>', lambda: self.sentences(1, 2))}</blockquote>"
        if k < 0.13:
            tag = self.r.choice(["ul", "ol"])
            return f"<{tag}>" + self.some(lambda: f"<li>{self.any(lambda: self.words(1, 12), lambda: self.sentence(), lambda: self.words(1, 6) + ' ' + self.link(self.words(1, 3)))}</li>", 2, 6) + f"</{tag}>"
        if k < 0.23:
            return f"<{(t := self.r.choice(['h2', 'h2', 'h3', 'h4']))}>{self.words(1, 7).capitalize()}</{t}>{self.para()}"
        if k < 0.27:
            return "<table>" + self.some(lambda: "<tr>" + self.some(lambda: f"<td>{self.words(1, 6)}</td>", 2, 3) + "</tr>", 1, 4) + "</table>"
        if k < 0.30:
            return f"<figure><img src=x><figcaption>{self.any(self.sentence, lambda: self.words(2, 8))}</figcaption></figure>"
        if k < 0.33:
            return f"<pre>{self.words(3, 30)}</pre>"
        if k < 0.36:
            return f"<dl><dt>{self.words(1, 3)}</dt><dd>{self.sentence()}</dd></dl>"
        if k < 0.39:
            return f"<div>{self.sentence()} <p>{self.sentence()}</p> {self.words(1, 6)}</div>"
        if k < 0.42:
            return self.named("section", ",,intro,part,chapter", f"<h2>{self.words(1, 5).capitalize()}</h2>" + self.some(self.para, 1, 3))
        return self.para()

    def para(self) -> str:
        k = self.r.random()
        if k < 0.12:
            return f"<p>{self.any(lambda: self.words(1, 5), lambda: self.words(1, 3) + '.', lambda: self.sentence(2, 6))}</p>"
        if k < 0.25:
            return f"<p>{self.sentences(1, 2)} {self.link(self.words(1, 4))} {self.sentences(0, 2)}</p>"
        if k < 0.3:
            return f"<p>{self.sentence()}<br>{self.sentence()}<br>{self.sentence()}</p>"
        if k < 0.315:  # an article may say such things too
            return f"<p>{self.any(lambda: self.r.choice(LEGAL), lambda: 'All rights reserved.', lambda: 'Licensed under the ' + self.name() + ' License.', lambda: self.r.choice(NOTICE), lambda: self.r.choice(META) + ' ' + self.words(2, 8) + '.')}</p>"
        return f"<p>{self.sentences(1, 6)}</p>"

    def title(self) -> str:
        return f"<h1>{self.words(1, 10).capitalize()}</h1>"

    def story(self, inside: float = 0.5) -> str:
        """Blocks of main text, with marked boilerplate among them."""
        k = self.r.random()
        if k < 0.08:
            parts = [f"<p>{self.words(1, 3)}</p>" for _ in range(self.r.randint(1, 3))]
        elif k < 0.16:
            parts = [f"<p>{self.sentence(2, 9)}</p>" for _ in range(self.r.randint(1, 2))]
        elif k < 0.3:
            parts = [self.para() for _ in range(self.r.randint(1, 3))]
        else:
            parts = [self.block() for _ in range(self.r.randint(2, 12))]
        for _ in range(self.r.choice([1, 1, 2, 3]) if self.r.random() < inside else 0):
            extra = self.any(self.ad, self.form, self.side, self.share, self.meta, self.notice, lambda: self.named("div", "related,inset,read more", self.link(self.words(3, 9)), "b"))
            parts.insert(self.r.randint(0, len(parts)), extra)
        return "".join(parts)

    # boilerplate

    def menu(self) -> str:
        items = self.any(lambda: f"<ul>{self.some(lambda: f'<li>{self.link()}</li>', 2, 9)}</ul>", lambda: self.some(self.link, 2, 9, self.r.choice([" ", " | ", " · ", "<br>"])), lambda: self.some(lambda: f"<div>{self.link()}</div>", 2, 7), lambda: f"<p>{self.some(self.link, 2, 8, ' ')}</p>")
        return self.named(self.r.choice(["nav", "nav", "div", "div", "ul" if items.startswith("<li") else "div"]), "nav,menu,main menu,navbar,navigation,site nav,main navigation,menu main container,breadcrumb,breadcrumbs,top nav,tabs,nav links,post navigation,toc,pagination,skip link,sub nav", items, "b")

    def header(self) -> str:
        body = self.any(self.name, lambda: f"<div>{self.link(self.name())}</div>", lambda: f"<p>{self.link(self.name())}</p><p>{self.words(2, 7)}</p>", lambda: f"<h1>{self.link(self.name())}</h1><h2>{self.words(2, 7)}</h2>", lambda: f"<span>{self.name()}</span> <span>{self.words(1, 5)}</span>")
        return self.named(self.r.choice(["header", "header", "div"]), "header,site header,masthead,banner,top bar,branding,site branding,logo,page header,site title,topbar,brand", body + (self.menu() if self.r.random() < 0.4 else ""), "b")

    def footer(self) -> str:
        c = lambda: f"{self.r.choice(['&copy;', '&copy;', '©', 'Copyright', '(c)'])} {self.r.choice([str(self.r.randint(1999, 2025)), ''])} {self.name()}{self.r.choice(['', '.', ' &middot; ' + self.words(1, 9) + '.', '. ' + self.r.choice(LEGAL)])}"
        body = self.any(c, lambda: f"<p>{c()}</p>", lambda: f"<div>{c()}</div>{self.some(self.link, 1, 4, ' ')}", lambda: f"<p>{self.r.choice(LEGAL)} {self.name()}</p>", lambda: f"<ul>{self.some(lambda: f'<li>{self.link()}</li>', 2, 6)}</ul><p>{c()}</p>", lambda: f"<p>{self.sentence()}</p><p>{c()}</p>", lambda: f"{self.r.choice(LEGAL)} {self.link(self.name())}")
        return self.named(self.r.choice(["footer", "footer", "footer", "div", "div", "address", "p" if not body.startswith("<") else "div"]), "footer,site footer,colophon,copyright,legal,site info,bottom,credits,page footer,foot", body, "b")

    def side(self) -> str:
        links = f"<ul>{self.some(lambda: f'<li>{self.link(self.words(2, 8))}</li>', 1, 7)}</ul>"
        h = f"<{(t := self.r.choice(['h2', 'h3', 'h4', 'h3', 'strong', 'div']))}>{self.r.choice(SIDE)}</{t}>"
        body = self.any(lambda: h + links, lambda: h + links, lambda: links, lambda: f"{h}<p>{self.sentences(1, 3)}</p>", lambda: f"<p>{self.sentences(1, 2)}</p><p>{self.sentence()}</p>", lambda: h + self.some(lambda: f"<div>{self.link(self.words(3, 8))}<p>{self.sentence()}</p></div>", 1, 4), lambda: self.words(2, 14))
        return self.named(self.r.choice(["aside", "aside", "div", "section"]), "sidebar,side bar,rail,widget,widget area,related,related posts,recommended,trending,popular,tags,more,author box,author bio,secondary,sidebar right,recent posts,promo box,column side,see also,toc", body, "b", keep=not body.startswith(h) and self.r.random() < 0.8)

    def ad(self) -> str:
        body = self.any(lambda: self.sentences(1, 2), lambda: self.words(2, 10), lambda: self.link(self.words(2, 8)), lambda: f"<span>Advertisement</span> {self.words(2, 12)}", lambda: f"<p>Advertisement</p><p>{self.sentence()}</p>")
        return self.named(self.r.choice(["div", "div", "aside", "section", "p" if "<p" not in body else "div"]), "ad,ads,advert,advertisement,sponsored,promo,promotion,ad slot,banner ad,sponsor,adsense,ad box,ad container,ad unit", body, "b", keep=True)

    def notice(self) -> str:
        s = self.r.choice(NOTICE)
        body = self.any(lambda: s, lambda: f"<p>{s}</p>", lambda: f"<p>{s} {self.sentence()}</p><button>ok</button>", lambda: f"{s} {self.link('Learn more')}", lambda: f"<p>{self.sentences(1, 3)}</p>")
        return self.named(self.r.choice(["div", "div", "section", "aside", "dialog"]), "cookie,cookies,cookie notice,cookie banner,consent,gdpr,notice,alert,popup,modal,overlay,paywall,announcement,disclaimer,message bar", body, "b", keep=s not in body)

    def form(self) -> str:
        ask = self.r.choice(ASK)
        body = self.any(lambda: f"<label>{ask}</label> <input><button>go</button>", lambda: f"<h3>{ask}</h3><p>{self.sentence()}</p><input><input type=submit>", lambda: f"<p>{ask}</p><input>", lambda: f"<fieldset>{self.words(1, 4)}<textarea></textarea></fieldset><input>", lambda: f"<input placeholder=x><button>{ask}</button>{self.words(0, 5)}", lambda: f"<p>{self.sentence()}</p><label>Email</label><input>")
        form = self.named("form", ",,,search,login,signup,subscribe,newsletter,contact,comment form,search form", body, "b")
        return form if self.r.random() < 0.7 else self.named(self.r.choice(["div", "section", "aside"]), "newsletter,subscribe,signup,search,widget,,", self.r.choice(["", f"<h3>{ask}</h3>", f"<p>{self.sentence()}</p>"]) + form, "b")

    def share(self) -> str:
        body = self.any(lambda: self.some(self.link, 2, 5, " "), lambda: f"<ul>{self.some(lambda: f'<li>{self.link(self.r.choice(META))}</li>', 2, 5)}</ul>", lambda: f"<span>Share</span> {self.some(self.link, 1, 4, ' ')}")
        return self.named(self.r.choice(["div", "ul" if body.startswith("<li") else "div", "p" if "<ul" not in body else "div"]), "share,social,share buttons,social links,follow,toolbar,pager,sharing,sharedaddy,actions,tools", body, "b")

    def meta(self) -> str:
        body = self.any(lambda: f"{self.r.choice(META)} {self.date()}", lambda: f"By {self.link(self.name())} {self.date()}", lambda: f"<span>{self.date()}</span> <span>{self.r.choice(META)} {self.name()}</span>", lambda: f"{self.r.choice(META)} {self.some(self.link, 1, 3, ', ')}", lambda: f"<time>{self.date()}</time>", lambda: f"{self.r.choice(META)} {self.name()}")
        return self.named(self.r.choice(["div", "div", "p", "footer"]), "meta,entry meta,post meta,byline,posted on,date,entry footer,post info,author,dateline,cat links,post footer,article meta,tags links", body, "b", keep=self.r.random() < 0.7)

    def comments(self) -> str:
        head = self.r.choice(TALK)
        heading = f"<{(t := self.r.choice(['h2', 'h3', 'h3', 'h4']))}>{head}{self.r.choice(['', '', ' (' + str(self.r.randint(1, 40)) + ')'])}</{t}>"
        tag = self.r.choice(["div", "div", "li", "article", "p"])
        who = lambda: self.any(lambda: f"<b>{self.name()}</b>", lambda: f"<b>{self.name()}</b> says:", lambda: f"<h4>{self.name()}</h4>" if tag != "p" else self.name(), lambda: f"<div>{self.name()} {self.date()}</div>" if tag != "p" else self.name(), lambda: "", lambda: f"<cite>{self.name()}</cite>")
        one = lambda: self.named(tag, "comment,comment body,reply,response,comment even,user comment,", who() + (f"<p>{self.sentences(1, 4)}</p>" if tag != "p" else " " + self.sentences(1, 3)) + self.r.choice(["", "", self.link("Reply")]))
        body = self.some(one, 1, 6)
        if tag == "li":
            body = self.named("ol", "comment list,commentlist,,", body)
        bare, self.bare = self.bare, self.bare * 1.3
        titled = self.r.random() < 0.85
        out = self.named(self.r.choice(["div", "section", "section", "aside"]), "comments,comment list,reader comments,discussion,replies,responses,disqus thread,user comments,comments area,comment section", (heading if titled else "") + body + (self.form() if self.r.random() < 0.4 else ""), "b", keep=not titled)
        self.bare = bare
        return out

    def talk(self) -> str:
        """Comments without a box of their own: a heading, then one element for each."""
        tag = self.r.choice(["div", "p", "li"])
        one = lambda: f'<{tag} data-y="b">{self.any(lambda: self.name() + ": ", lambda: f"<b>{self.name()}</b> ", lambda: f"{self.name()} {self.date()}<br>", lambda: "")}{self.sentences(1, 3)}</{tag}>'
        h = self.r.choice(["h2", "h3", "h3", "h4"])
        items = self.some(one, 1, 5)
        return f'<{h} data-y="b">{self.r.choice(TALK)}</{h}>' + (f'<{(t := self.r.choice(["ul", "ol"]))} data-y="b">{items}</{t}>' if tag == "li" else items)

    # pages

    def top(self, lo: int = 0, hi: int = 3) -> str:
        return self.some(lambda: self.any(self.menu, self.menu, self.header, self.header, self.notice, self.ad, self.ad, self.form, self.share), lo, hi)

    def bottom(self, lo: int = 0, hi: int = 3) -> str:
        return self.some(lambda: self.any(self.comments, self.comments, self.side, self.share, self.ad, self.form, self.notice, self.menu), lo, max(lo, hi - 1)) + (self.footer() if self.r.random() < 0.8 else "")

    def semantic(self) -> str:
        title = self.title() if self.r.random() < 0.8 else ""
        if self.r.random() < 0.3:
            title = f"<header>{title}{self.meta() if self.r.random() < 0.6 else ''}</header>"
        inner = title + self.story() + (self.any(self.comments, self.talk) if self.r.random() < 0.2 else "") + (self.meta() if self.r.random() < 0.15 else "")
        inner = inner if self.r.random() < 0.7 else title + self.named("div", "article body,entry content,content,text,body,story body", inner.removeprefix(title))
        main = f'<{(t := self.r.choice(["article", "article", "article", "main"]))} data-y="c">{inner}</{t}>'
        main = main if self.r.random() < 0.7 else f"<main>{main}{self.bottom(0, 2) if self.r.random() < 0.4 else ''}</main>"
        if self.r.random() < 0.4:
            side = f"<aside data-y='b'>{self.some(self.side, 1, 3)}</aside>" if self.r.random() < 0.4 else self.some(self.side, 1, 2)
            main = self.r.choice([side + main, main + side])
        return self.top() + (self.named("div", "wrapper,container,page,layout,row,site", main) if self.r.random() < 0.4 else main) + self.bottom()

    def divs(self) -> str:
        """Nothing but divs, mostly without names."""
        self.bare = self.r.choice([0.3, 0.7, 1.0])
        div = lambda x, y="": f"<div{f' data-y={chr(34)}{y}{chr(34)}' if y else ''}>{x}</div>"
        text = self.any(lambda: self.title() + self.story(0.3), lambda: div(self.title()) + div(self.story(0.3)), lambda: self.title() + div(self.sentences(2, 8)) + div(self.sentences(1, 6)), lambda: self.title() + self.sentences(2, 6), lambda: f"<h2>{self.words(2, 7)}</h2>{self.some(self.para, 1, 5)}", lambda: self.some(lambda: div(self.sentences(1, 4)), 1, 6), lambda: div(div(self.title() + self.some(self.para, 2, 6))))
        middle = self.named("div", "content,main,post,page content,main content,col main,body,article,text", text, "c")
        if self.r.random() < 0.35:
            side = div(self.any(lambda: f"<h3>{self.r.choice(SIDE)}</h3><ul>{self.some(lambda: f'<li>{self.link()}</li>', 2, 6)}</ul>", lambda: self.some(self.link, 3, 9, "<br>")), "b")
            middle = self.r.choice([side + middle, middle + side])
            middle = middle if self.r.random() < 0.5 else div(middle)
        links = div(self.any(lambda: self.some(self.link, 2, 8, self.r.choice([" ", " | "])), lambda: f"<ul>{self.some(lambda: f'<li>{self.link()}</li>', 2, 8)}</ul>"), "b") if self.r.random() < 0.8 else ""
        page = (div(self.name(), "b") if self.r.random() < 0.3 else "") + links + middle + (self.any(self.comments, self.talk) if self.r.random() < 0.3 else "") + (self.footer() if self.r.random() < 0.75 else "")
        return div(page) if self.r.random() < 0.3 else page

    def blog(self) -> str:
        """The usual blog themes."""
        self.bare = 0.05
        title = self.any(lambda: f'<h1 class="entry-title">{self.words(2, 9)}</h1>', lambda: f'<h2 class="post-title">{self.link(self.words(2, 9))}</h2>', lambda: f'<h1 class="title">{self.words(2, 9)}</h1>')
        head = f'<header class="entry-header">{title}{self.meta() if self.r.random() < 0.7 else ""}</header>' if self.r.random() < 0.6 else title + (self.meta() if self.r.random() < 0.5 else "")
        body = self.named("div", "entry content,post content,post body,entry,post entry,td post content,single content,the content", self.story(0.35), "c", keep=True)
        foot = self.any(lambda: "", self.meta, lambda: f'<footer class="entry-footer" data-y="b">{self.r.choice(META)} {self.some(self.link, 1, 3, ", ")}</footer>', self.share)
        post = f'<{(t := self.r.choice(["article", "article", "div"]))} class="{self.r.choice(["post type-post status-publish format-standard hentry", "post", "hentry post", "blog-post"])}" data-y="c">{head}{body}{foot}</{t}>'
        inner = post + (self.menu() if self.r.random() < 0.4 else "") + (self.comments() if self.r.random() < 0.75 else "")
        main = self.named("main", "site main,main", inner) if self.r.random() < 0.6 else inner
        area = self.named("div", "content area,site content,primary,content,main wrap", main, keep=True)
        side = self.named(self.r.choice(["aside", "div"]), "widget area,sidebar,secondary,sidebar primary", self.some(self.side, 1, 4) + (self.form() if self.r.random() < 0.4 else ""), "b", keep=True) if self.r.random() < 0.7 else ""
        page = self.header() + (self.menu() if self.r.random() < 0.4 else "") + (area + side if self.r.random() < 0.8 else side + area) + self.footer()
        return self.named("div", "page,site,hfeed site,wrapper,outer wrapper,container", page) if self.r.random() < 0.7 else page

    def tables(self) -> str:
        """Layout by tables."""
        self.bare = 0.8
        cell = lambda x, y, more="": f'<td data-y="{y}"{more}>{x}</td>'
        links = self.any(lambda: self.some(self.link, 3, 10, "<br>"), lambda: self.some(self.link, 3, 8, " | "), lambda: f"<ul>{self.some(lambda: f'<li>{self.link()}</li>', 3, 8)}</ul>", lambda: self.some(lambda: f"<p>{self.link()}</p>", 3, 8))
        text = self.any(lambda: self.title() + self.story(0.1), lambda: self.some(self.para, 1, 6), lambda: self.sentences(3, 9), lambda: f"<h2>{self.words(2, 6)}</h2>{self.some(self.para, 1, 4)}", lambda: f"<b>{self.words(2, 5)}</b><br>{self.sentences(2, 6)}")
        row = [cell(links, "b", self.r.choice(["", ' width="150"', ' valign="top"'])), cell(text, "c", self.r.choice(["", ' width="600"']))]
        if self.r.random() < 0.3:
            row.append(cell(self.any(lambda: self.words(3, 12), lambda: self.some(self.link, 2, 5, "<br>"), lambda: f"<b>{self.r.choice(SIDE)}</b><br>{self.some(self.link, 2, 5, '<br>')}"), "b"))
        if self.r.random() < 0.2:
            row.reverse()
        rows = [f"<tr>{''.join(row)}</tr>"]
        if self.r.random() < 0.5:
            rows.insert(0, f"<tr>{cell(self.any(self.name, lambda: self.some(self.link, 2, 7, ' | '), lambda: f'<h1>{self.name()}</h1>'), 'b', ' colspan=2')}</tr>")
        if self.r.random() < 0.6:
            rows.append(f"<tr>{cell(self.any(lambda: f'&copy; {self.name()}', lambda: self.some(self.link, 2, 6, ' | '), lambda: f'{self.r.choice(LEGAL)} {self.name()}'), 'b', ' colspan=2')}</tr>")
        return f"{self.top(0, 1)}<table{self.r.choice(['', ' border=0', ' width=100%'])}>{''.join(rows)}</table>{self.footer() if self.r.random() < 0.4 else ''}"

    def plain(self) -> str:
        """Old pages and fragments: text straight in the page, and tiny articles."""
        self.bare = 0.9
        k = self.r.random()
        if k < 0.3:
            return f'<article data-y="c">{self.any(lambda: self.title(), lambda: "")}{self.some(lambda: self.any(lambda: f"<p>{self.words(1, 3)}</p>", lambda: f"<p>{self.sentence(1, 5)}</p>", lambda: f"<div>{self.word()} <p>{self.word()}</p> {self.word()}</div>", self.para), 1, 4)}</article>'
        if k < 0.6:
            mark = lambda html: "".join(x.replace(">", ' data-y="c">', 1) for x in html)
            body = mark([f"<p>{self.sentences(1, 4)}</p>" for _ in range(self.r.randint(1, 6))])
            return (f'<h1 data-y="c">{self.words(1, 6)}</h1>' if self.r.random() < 0.7 else "") + body + (self.talk() if self.r.random() < 0.5 else "") + ("<hr>" + self.any(self.footer, lambda: f'<p data-y="b">{self.link()}</p>') if self.r.random() < 0.5 else "")
        if k < 0.8:
            return f'<center data-y="c"><h1>{self.words(1, 6)}</h1></center><div data-y="c">{self.some(self.para, 1, 6)}</div><hr><p data-y="b">{self.some(self.link, 1, 5, " | ")}</p>' + (f'<address data-y="b">{self.name()}, {self.date()}</address>' if self.r.random() < 0.6 else "")
        return f'<div data-y="c">{self.any(lambda: self.sentences(1, 8), lambda: self.some(self.para, 1, 4), lambda: self.words(1, 5))}</div>'

    def docs(self) -> str:
        """Manuals: a tree of links, breadcrumbs, text with code, next and previous."""
        self.bare = 0.2
        tree = self.named(self.r.choice(["nav", "div", "aside"]), "sidebar,sphinxsidebar,toc tree,menu,docs nav,side nav", f"<ul>{self.some(lambda: f'<li>{self.link(self.words(1, 4))}<ul>{self.some(lambda: f'<li>{self.link(self.words(1, 4))}</li>', 1, 4)}</ul></li>', 2, 6)}</ul>", "b")
        text = self.title() + self.some(lambda: self.any(self.block, lambda: f"<pre><code>{self.words(3, 25)}</code></pre>", lambda: f"<h2>{self.words(1, 4)}</h2>{self.para()}"), 3, 10)
        near = self.named("div", "prev next,pager,pagination,footer nav,page nav", self.some(self.link, 1, 3, " "), "b")
        body = self.named(self.r.choice(["div", "main", "article", "section"]), "document,body,content,markdown body,docs content,section", text, "c")
        return self.header() + self.r.choice([tree + body, body + tree]) + near + self.footer()

    def grid(self) -> str:
        """Rows and columns of style frameworks."""
        self.bare = 0.1
        text = self.any(lambda: self.title() + self.story(0.4), lambda: f"<div>{self.title()}</div><div>{self.story(0.3)}</div>")
        main = f'<div class="{self.r.choice(["col-md-8", "col-8", "col-lg-9", "column is-two-thirds", "grid__main", "main"])}"><div class="{self.r.choice(["card-body", "inner", "panel", "article-body", "box", "text-block"])}" data-y="c">{text}</div>{self.bottom(0, 1) if self.r.random() < 0.3 else ""}</div>'
        side = f'<div class="{self.r.choice(["col-md-4", "col-4", "col-lg-3", "column", "grid__side"])}">{self.some(self.side, 1, 3)}</div>' if self.r.random() < 0.6 else ""
        return f'{self.top(1, 2)}<div class="container"><div class="row">{main}{side}</div></div>{self.bottom(0, 2)}'


#: The families of layouts, as often as they are drawn.
FAMILIES = ("semantic", "semantic", "semantic", "divs", "divs", "blog", "blog", "tables", "plain", "docs", "grid")


def labelled_pages(n: int = 1500, seed: int = 7, families: tuple[str, ...] = FAMILIES) -> list[str]:
    """n generated pages of the families."""
    m = Maker(seed)
    out = []
    for i in range(n):
        m.bare = m.r.choice([0.1, 0.3, 0.6])
        page = getattr(m, families[i % len(families)])()
        whole = f"<html><head><title>{m.words(2, 5)}</title></head><body>{page}</body></html>" if m.r.random() < 0.93 else page
        out.append(whole)
    return out
