"""Operators on single texts: chat formatting, PII, HTML text."""

import hashlib
import math
import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from factspan.llm import chat, extract, pii

PIECES = st.lists(st.sampled_from(["\\", "### ", "</turn>", "User: ", "Assistant: ", "a", "\n", ": ", "role=", "é", " ", "\U0001f600"]), max_size=12).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "tool"]) | PIECES, PIECES), max_size=4))
def test_every_conversation_reads_back(turns):
    assert chat.parse("".join(chat.render(r, x) for r, x in turns)) == (turns, True)


def test_texts_without_control_strings_stay_as_they_are():
    assert chat.render("user", "a \\ b # c") == "### User: a \\ b # c</turn>\n"
    assert chat.parse("### User: a</turn>") == ([], False) and chat.parse("x") == ([], False)


def chat_digest(turns):
    text = "".join(f"{r}\n{x}\n" for r, x in turns)
    said = "".join(x for r, x in turns if r == "assistant")
    return len(turns), hashlib.sha256(text.encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest()


def test_op1(spark, frame):
    rows = [(1, 0, "user", "hé"), (1, 1, "assistant", "</turn> x"), (1, 1, "assistant", "a"), (1, 1, "assistant", "a"), (2, None, None, None), (None, 5, "user", ""), (1, 10, "assistant", "z" * 100_000)]
    df = frame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as rendered", "1 as _c")
    got = {r.conv_id: tuple(r)[1:5] for r in chat.op1(df).collect()}
    want = {1: [("user", "hé"), ("assistant", "</turn> x"), ("assistant", "a"), ("assistant", "a"), ("assistant", "z" * 100_000)], 2: [("", "")], None: [("user", "")], -7: [(r, r"\### Assistant: </turn> ok") for r in ("user", "assistant")]}
    one = {k: chat_digest(v) for k, v in want.items()}
    want[1][1:4] = sorted(want[1][1:4], key=lambda t: chat.render(*t))
    one[1] = chat_digest(want[1])
    assert got == one
    assert chat.op1(df.limit(0)).count() == 1
    text = {r.conv_id: r.formatted for r in chat.format_conversations(df).collect()}
    assert chat.parse(text[1])[0][0] == ("user", "hé")


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def base(text):
    out = []
    for kind, p in PATTERNS.items():
        for m in re.finditer(p, text):
            digits = re.sub("[^0-9]", "", m[0])
            doubled = [int(d) * 2 if i % 2 else int(d) for i, d in enumerate(reversed(digits))]
            luhn = sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
            if kind == "ip" and any(int(x) > 255 for x in m[0].split(".")) or kind == "card" and not (16 <= len(digits) <= 19 and luhn) or kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, m.start(), m.end()))
    return out


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(["a", "@", ".", "b.c", "1", "22", "256", "192.168.0.1", "4785380592391139", " ", "-", "+4", "(0)", "x@y.z", "é", "\n", "%", "00001.2.3.4"]), max_size=14).map("".join))
def test_base_spans_are_the_patterns(text):
    assert pii.base_spans(text) == base(text)


def test_patterns_take_linear_time():
    for text in ("a" * 200_000, "1" * 200_000, "a." * 100_000, "@" * 200_000, "+1" + " " * 200_000, "1." * 100_000):
        pii.base_spans(text)


def test_op2(spark, frame):
    """A term that stands beside one address only, in enough documents, gives it away; common words don't."""
    near = [(i, f"{w} report about Zanzibar by joe@x.org {w} today") for i, w in enumerate(["first", "second", "third", "fourth", "fifth", "sixth"])]
    rest = [(100 + i, f"report about weather by p{i}@y.org today") for i in range(40)] + [(200, None), (201, ""), (202, "call +1 555 123 4567, card 4785-3805-9239-1139, host 10.0.0.1"), (None, "x"), (0, near[0][1])]
    df = frame(near + rest, "doc_id long, text string").selectExpr("*", "1 as row", "2 as base")
    got = pii.op2(df).collect()
    assert len(got) == len(near) + len(rest)
    by = {r.doc_id: r for r in got}
    marked = lambda i, t: [t[int(s):int(e)] for k, s, e in (x.split(":") for x in by[i].spans.split(",") if x) if k == "term"]
    assert marked(1, near[1][1]) == ["Zanzibar"] and marked(100, rest[0][1]) == []
    assert (by[202].n_phone, by[202].n_card, by[202].n_ip) == (1, 1, 1) and by[202].spans == ",".join(f"{k}:{s}:{e}" for k, s, e in base(rest[42][1])) and by[200].spans == ""
    assert by[1].base_sha256 == hashlib.sha256(f"email:{near[1][1].index('joe')}:{near[1][1].index('joe') + 9}".encode()).hexdigest()
    copies = frame([(i, "copied words about Ruritania by ann@z.org") for i in range(9)] + rest[:40], "doc_id long, text string")
    assert not any("term" in r.spans for r in pii.op2(copies).where("doc_id < 9").collect())
    clean = {r.doc_id: r.text for r in pii.sanitised(df.where("doc_id in (1, 202)")).collect()}
    assert "joe@x.org" not in clean[1] and clean[202] == "call [phone], card [card], host [ip]"
    assert pii.op2(df.limit(0)).count() == 0


def test_op2_counts_one_unit_and_marks_every_occurrence(spark, frame):
    """Signatures count once a document, copies once in all, and a flagged term is a span wherever it stands."""
    r = random.Random(3)
    prose = lambda n=40: " ".join("".join(r.choices("bcdfghklmnprst", k=6)) for _ in range(n))
    signed = [(i, f"{prose()} yours truly Zanzibar Q7 joe@x.org best wishes") for i in range(5)]
    other = [(100 + i, f"{prose()} yours truly p{i}@y.org best wishes") for i in range(30)]
    thrice = [(200 + i, f"{prose()} from Ruritania ann@z.org {prose(2)}") for i in range(3)]
    copied = [(300 + i, thrice[0][1]) for i in range(40)] + [(400, thrice[0][1] + " again")]
    far = [(500, f"Zanzibar {prose(60)} q7")]
    rows = signed + other + thrice + copied + far
    df = frame(rows, "doc_id long, text string")
    texts = dict(rows)
    for options in ({}, {"broadcast_terms": 0}):
        found = {x.doc_id: [texts[x.doc_id][y.s : y.f] for y in x.terms or []] for x in pii.find(df, **options).collect()}
        assert len(found) == len(rows)
        assert all(found[i] == ["Zanzibar", "Q7"] for i, _ in signed) and found[500] == ["Zanzibar", "q7"]
        assert all("Ruritania" in found[i] for i, _ in thrice + copied) and not any(found[i] for i, _ in other)
    assert dict(pii.sanitised(df).where("doc_id = 500").collect())[500].count("Zanzibar") == 0


ARTICLE = "<h1>On  tests</h1><p>First, a long paragraph with commas, and stops. It goes on.</p><p>Short.<br>Still short.</p><p>Caf&eacute; &amp; more &lt;b&gt;"
PAGES = {
    "plain": (f"<html><body><nav><a href=/>Home</a></nav><article>{ARTICLE}</article><footer>(c) me, all rights.</footer></body></html>", None),
    "divs": (f"<body><div class='sidebar'><p>Side, with text. More.</p></div><div id=content>{ARTICLE}</div><div class='comments'><p>I, too, agree. Long comment.</p></div><form>Mail: <input></form></body>", None),
    "scripts": (f"<script>var a='<p>no</p>'</script><style>p{{}}</style><main>{ARTICLE}<!-- <p>no</p> --></main><aside>no, no. no.</aside>", None),
    "notice": (f"<body><div class='cookie-notice'>We use cookies, as all do. Accept?</div><header>Site name, slogan.</header><article>{ARTICLE}<section class=comments><p>Nice, very nice. Really.</p></section></article></body>", None),
    "upper": (f"<BODY><NAV>Menu</NAV><ARTICLE>{ARTICLE}</ARTICLE></BODY>", None),
    "nothing": ("<body><nav><a>x</a></nav></body>", ""), "empty": ("", ""), "null": (None, ""),
    "text": ("Just some words, no markup.", "Just some words, no markup."), "broken": ("<p>Open <b>bold <a href='x", "Open bold"),
}
WANT = "On tests\nFirst, a long paragraph with commas, and stops. It goes on.\nShort. Still short.\nCafé & more <b>"


@pytest.mark.parametrize("name", PAGES)
def test_main_text(name):
    page, want = PAGES[name]
    assert extract.main_text(page) == (WANT if want is None else want)


def test_all_content_is_kept_beside_one_long_section():
    section = lambda n, word: "<div>" + f"<p>{(word + ', and so on. ') * 8}</p>" * n + "</div>"
    for page in (f"<body><div>{section(24, 'long')}{section(1, 'short')}</div></body>", f"<body><div><article>{section(24, 'long')}</article>{section(1, 'short')}</div></body>"):
        said = extract.main_text(page)
        assert said.count("long,") == 24 * 8 and said.count("short,") == 8


LONG = "<p>" + "Words follow words, as they do here, and sentences end. " * 6 + "</p>"


@pytest.mark.parametrize("page, kept, gone", [
    (f"<article>{LONG * 3}<section id='related-work'><p>{'Others did the same, years ago, and better. ' * 8}</p></section></article>", ["Others did"], []),
    (f"<article>{LONG}<div class='notice'>{LONG}</div>{LONG}<p>End.</p></article>", ["End."], []),
    (f"<body class='no-sidebar'><div class='notice'>{LONG}<p>Small, but there.</p></div></body>", ["Words follow", "Small, but"], []),
    (f"<body><div>{LONG * 4}</div><div><p>Copyright 2020</p></div><div class='top-ad'><p>Buy, buy. Now!</p></div></body>", ["Words follow"], ["Buy"]),
    (f"<body><div>{LONG * 40}</div><div class=comments>{'<p>I, too, agree with it. All of it, truly, and more.</p>' * 3}</div></body>", ["Words follow"], ["I, too"]),
])
def test_ratios_decide(page, kept, gone):
    said = extract.main_text(page)
    assert all(x in said for x in kept) and not any(x in said for x in gone)


def test_path_weights_by_hand(monkeypatch):
    """The fused weight of each path from its definition, and what becomes of a page without it."""
    page = f"<body><ul><li><a href=/>One</a><li><a href=/>Two</a></ul><div>{LONG}<p>Short, too.</p></div><footer>Me, myself.</footer></body>"
    found = [(b, " ".join("".join(b.parts).split())) for b in extract.blocks(page)]
    own = []
    for b, _ in found:
        same = [(x, said) for x, said in found if x.path == b.path]
        linked = sum(x.linked for x, _ in same)
        plain, stops = sum(len(said) for _, said in same) - linked, sum(said.count(",") + said.count(".") for _, said in same)
        own.append(0 if linked > plain else plain / len(same) * (1 + stops / len(same)) * plain / (plain + linked))
    near = [sum(own[j] * math.exp(-((i - j) ** 2) / 2) for j in range(len(own)) if abs(i - j) <= 2) / sum(math.exp(-((i - j) ** 2) / 2) for j in range(len(own)) if abs(i - j) <= 2) for i in range(len(own))]
    got = extract.path_weights(found)
    for i, (b, _) in enumerate(found):
        around = [near[j] for j, (x, _) in enumerate(found) if x.path == b.path]
        assert got[b.path] == pytest.approx(b.path[1] * math.sqrt(own[i] * max(own[i], sum(around) / len(around))))
    text = extract.main_text(page)
    assert "One" not in text and "Me," not in text and text.endswith("Short, too.")
    monkeypatch.setattr(extract, "path_weights", lambda found: dict.fromkeys((b.path for b, _ in found), 1.0))
    assert extract.main_text(page) != text


def test_long_and_deep_pages():
    assert extract.main_text("<div>" * 3000 + "word, word." + "</div>" * 3000) == "word, word."
    assert len(extract.main_text("<article>" + "<p>" + "word, " * 10 + "</p>" * 1 + "<p>x.</p>" * 5000 + "</article>").split("\n")) == 5001


def test_op7(spark, frame):
    rows = [(i, n, p) for i, (n, (p, _)) in enumerate(PAGES.items())] + [(0, "plain", PAGES["plain"][0])]
    df = frame(rows, "page_id long, url string, html string").selectExpr("*", "'t' as text")
    got = extract.op7(df).collect()
    assert len(got) == len(rows) and all(r.text == extract.main_text(PAGES[r.url][0]) and r.n_chars == len(r.text) for r in got)
    assert extract.op7(df.limit(0)).count() == 0


def test_links_inside_an_article_stay():
    words = "Some running text of an essay, with commas, that goes on and on. " * 4
    cited = "<h2>References</h2><ul><li><a href=a>First work, 1999</a></li><li><a href=b>Second work, 2004</a></li></ul>"
    menu = "<ul><li><a href=x>Home</a></li><li><a href=y>News</a></li></ul>"
    page = f"<body>{menu}<article><h1>Title</h1><p>{words}</p><p>{words}</p>{cited}</article><div>{menu}</div></body>"
    assert extract.main_text(page).split("\n") == ["Title", words.strip(), words.strip(), "References", "First work, 1999", "Second work, 2004"]
    # around an element that doesn't say what it is a list of links may be a menu
    plain = extract.main_text(page.replace("article", "div"))
    assert "Home" not in plain and words.strip() in plain
    assert extract.main_text(f"<body>{menu}<main><article><a href=z>All the text is a link</a></article></main></body>") == "All the text is a link"
    assert extract.main_text(f"<body>{menu}</body>") == ""
