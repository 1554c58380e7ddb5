import base64
import hashlib
import html
import random
import re

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
import pytest
import tiktoken

from cases import LONG, awkward, documents, rows
from clickloom.llm import bpe, html_text, pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base_spans(text):
    """The base kinds by their patterns over the whole text."""
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    for m in CARD.finditer(text):
        d = [int(c) for c in m.group() if c.isdigit()]
        if 16 <= len(d) <= 19 and sum(x if i % 2 == 0 else (2 * x - 9 if x > 4 else 2 * x) for i, x in enumerate(d[::-1])) % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15]


def test_pii_base_equals_patterns():
    draw, find = random.Random(7), pii.Finder().spans
    for _ in range(20_000):
        text = "".join(draw.choice("0123456789..--  ()++@@abZ_%é\n4000") for _ in range(draw.randint(0, 40)))
        assert find(text)[0] == base_spans(text), text


@pytest.mark.parametrize("text, kind, found", [
    ("IBAN: DE89370400440532013000 ok", "account", "DE89370400440532013000"),
    ("IBAN: DE89 3704 0044 0532 0130 00 ok", "account", "DE89 3704 0044 0532 0130 00"),
    ("IBAN: DE88370400440532013000", "account", None),
    ('the token = "908038b7daaf91e7" x', "account", "908038b7daaf91e7"),
    ("token words only here", "account", None),
    ("call at 12 Main Street, x", "address", "12 Main Street"),
    ("Hauptstraße 12 b", "address", "Hauptstraße 12"),
    ("the street was long", "address", None),
    ("an müller@example.com b", "email_ext", "müller@example.com"),
    ("see https://bob:pw@example.com/x", "url_auth", "bob:pw"),
    ("see https://example.com/x", "url_auth", None),
    # no greatest length
    ("secret: " + "0a9f" * 32 + " end", "account", "0a9f" * 32),
    ("secret: " + "0a9f-" * 2000 + " end", "account", "0a9f-" * 1999 + "0a9f"),
    ("token a1b2c3", "account", None),
    ("x https://" + "u" * 400 + ":" + "p4" * 300 + "@example.com/ y", "url_auth", "u" * 400 + ":" + "p4" * 300),
    ("at 77b, Saint" + "e" * 90 + " O'Hara-" + "x" * 50 + " Avenue, x", "address", "77b, Saint" + "e" * 90 + " O'Hara-" + "x" * 50 + " Avenue"),
    ("rue Sainte" + "e" * 100 + " 12 b", "address", "rue Sainte" + "e" * 100 + " 12"),
    ("at 5 one two three four Road", "address", None), ("at 123456 Main Road", "address", None), ("at x7 Main Road", "address", None),
    ("(12 Main Street)", "address", "12 Main Street"),
])
def test_pii_added(text, kind, found):
    assert [text[s:e] for k, s, e in pii.Finder().spans(text)[1] if k == kind] == ([found] if found else [])


def test_pii_long_runs_stay_linear():
    find = pii.Finder().spans
    for text in ("1" * 200_000, "1." * 100_000, "@a." * 50_000, "a@" * 100_000, "+1 " * 90_000, "token " * 40_000,
                 "token " + "a-" * 200_000, "street " * 40_000, "a" * 300_000 + " street" * 20_000, "://" * 60_000, "://a:" * 60_000, "street" + " a" * 200_000):
        find(text)


def test_pii_table_and_redaction(spark):
    out = {r[0]: r for r in rows(pii.find(awkward(spark)))}
    empty = hashlib.sha256(b"").hexdigest()
    assert out[1][1:] == out[2][1:] == out[7][1:] == (0, 0, 0, 0, empty, "")
    assert rows(pii.find(awkward(spark, []))) == []
    docs = documents(spark, ["mail a.b@c.de or +1 (377) 555-0271 now", None, "", "a a@b.c a@b.c"])
    got = rows(pii.redact(docs))
    assert [r[1] for r in got] == ["mail [EMAIL] or [PHONE] now", None, "", "a [EMAIL] [EMAIL]"]
    assert [r[4] for r in got] == [27, 0, 0, 17]
    clash = pii.redact(awkward(spark))
    assert clash.columns == awkward(spark).columns and clash.count() == awkward(spark).count()


def _tiktoken():
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    return path, tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


TEXTS = ["", "a  b\n\n c\t\t", "<unk> </s> ⁇ ▁x", "日本語 emoji \U0001f600 \x00\x01", "\x1c\x1f a b​ c　", "x" * 5000,
         " " * 3000 + "a", "don't I'LL we've", "été Über ñandú", "<|endoftext|>", "123 456,789.0", "\r\n\r\n x"]


def test_bpe_equals_tiktoken_and_round_trips():
    path, enc = _tiktoken()
    own = bpe.ByteBpe(bpe.model_bytes(bpe.read_ranks(path)), public_tokenizers.PATTERN)
    draw = random.Random(3)
    texts = TEXTS + ["".join(chr(draw.choice([draw.randrange(32, 127), draw.randrange(128, 0x800), draw.randrange(0x4E00, 0x4F00), 10, 32]))
                             for _ in range(draw.randint(1, 60))) for _ in range(400)]
    for text, ids in zip(texts, own.encode_all(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == enc.encode_ordinary(text), text
        assert own.decode(ids) == text.encode()


def test_bpe_memo_may_empty(monkeypatch):
    path, enc = _tiktoken()
    monkeypatch.setattr(bpe, "MEMO", 5)
    monkeypatch.setattr(bpe, "RUN_CHARS", 4)
    own = bpe.ByteBpe(bpe.model_bytes(bpe.read_ranks(path)), public_tokenizers.PATTERN)
    texts = ["one two three four five six", "seven eight", "one nine ten eleven"] * 2
    assert [np.frombuffer(i, "<u4").tolist() for i in own.encode_all(texts)] == [enc.encode_ordinary(t) for t in texts]


def test_bpe_tables(spark):
    path, enc = _tiktoken()
    docs = awkward(spark)
    got = {r[0]: r[1:] for r in rows(bpe.round_trip(docs, path, public_tokenizers.PATTERN))}
    for doc, text in {r[0]: r[1] for r in rows(docs)}.items():
        ids = enc.encode_ordinary(text or "")
        assert got[doc] == (len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                            hashlib.sha256((text or "").encode()).hexdigest())
    encoded = bpe.encode_documents(docs, path, public_tokenizers.PATTERN)
    back = {r[0]: bytes(r[1]) for r in rows(bpe.decode_documents(encoded, path, public_tokenizers.PATTERN))}
    assert back[7] == LONG.encode() and back[1] == b""
    assert rows(bpe.round_trip(awkward(spark, []), path, public_tokenizers.PATTERN)) == []


SAID, SLOGAN = "Some words that make up a paragraph of the article, long enough to be a surge. ", "The site that tells you all you want to know"


@pytest.mark.parametrize("page, text", [
    (None, ""), ("", ""), ("plain words", "plain words"),
    ("<html><head><title>T</title><style>p{}</style><script>var t='</p>';</script></head><body><nav><ul><li><a href=x>m</a></li></ul></nav>"
     "<div class='ad'>buy now</div><article><h1>Head &amp; all</h1><p>One\n two<br>three.</p><p>Be.</p></article><footer>&copy; x</footer>",
     "Head & all\nOne two three.\nBe."),
    # no article element: surge and dive, an advert between, comments after
    ("<div class=menu><a>a</a></div><div><h1>Title</h1><p>The first paragraph is long enough to be a surge.</p><div class='ads'>buy</div>"
     "<p>So is the second paragraph, which follows the advert.</p></div><div id='comments'><p>I am a reader and I write a very long comment.</p></div>",
     "Title\nThe first paragraph is long enough to be a surge.\nSo is the second paragraph, which follows the advert."),
    ("<article><header><h1>A</h1></header><p>b c</p><aside>z</aside><form>f<input></form><p>d</p></article>", "A\nb c\nd"),
    # an element apart that never ends is a line of its own page, not the rest of it
    ("<article><p>before</p><div class='ad'>x <p>after</p></article>", "before\nx\nafter"),
    ("<main><p>x &lt;b&gt; &#233; &nbsp; y</p></main>", "x <b> é y"),
    ("<article><p>kept</p><section class='comments'><article><p>a comment</p></article></section></article>", "kept"),
    ("<article><p>cut off &am", "cut off &am"),
    # an article that is a box of the page only; linked blocks between and after an article's own; names about such words
    (f"<div><p>{SAID * 3}</p><p>{SAID}</p></div><article>Teaser box</article>", f"{(SAID * 3).strip()}\n{SAID.strip()}\nTeaser box"),
    (f"<article><p>{SAID}</p><p><a href=x>one</a></p><p><a href=x>two</a></p><p><a>three</a></p><p>b</p></article>", f"{SAID.strip()}\none\ntwo\nthree\nb"),
    (f"<article><p><a>first</a></p><p>{SAID}</p><ul><li><a>r 1</a></li><li><a>r 2</a></li><li><a>r 3</a></li><li><a>r 4</a></li></ul></article>",
     f"first\n{SAID.strip()}\nr 1\nr 2\nr 3\nr 4"),
    (f"<div id='menu-planning'><p>{SAID}</p></div>", SAID.strip()), (f"<section id='search-methods'><p>{SAID}</p></section>", SAID.strip()),
    (f"<div class=menu><p>{SAID}</p></div>", SAID.strip()),
    # outside an article: linked lines between two texts, a menu between a slogan and the text, boxes by compound names
    (f"<div><p>{SAID}</p><p><a>one</a></p><p><a>two</a></p><p><a>three</a></p><p>{SAID}</p></div>", f"{SAID.strip()}\none\ntwo\nthree\n{SAID.strip()}"),
    (f"<div>{SLOGAN}</div>" + "<div><a>A menu of this site</a></div>" * 9 + f"<div><p>{SAID * 9}</p></div>", f"{SLOGAN}\n{(SAID * 9).strip()}"),
    (f"<div class='site-header'>{SLOGAN}</div><div class='article-header'><h1>Head</h1></div><p>{SAID}</p><ul id=post-comments><li>{SAID}</ul>"
     f"<div class='x left-sidebar'>{SAID}</div>", f"Head\n{SAID.strip()}"),
])
def test_html_main_text(page, text):
    assert html_text.main_text(page) == text


def line_blocks(length, surge):
    """The distribution by its definition: a line belongs to a text if it lies
    between two text lines less than a window apart, or is one; a text is kept if
    a window in it reaches the surge."""
    n, w = len(length), html_text.WINDOW
    block = [sum(length[i:i + w]) for i in range(n)]
    out = []
    for i in range(n):
        if length[i] and not any(length[max(0, i - w + 1):i]):
            j = last = i
            while (j := next((x for x in range(last + 1, min(n, last + w)) if length[x]), None)) is not None:
                last = j
            if max(block[i:last + 1]) >= surge:
                out.append((i, last + 1))
    return out


def test_line_blocks_equal_their_definition():
    draw = random.Random(31)
    for _ in range(3000):
        length = [draw.choice([0, 0, 0, 5, 12, 60]) for _ in range(draw.randrange(0, 25))]
        for surge in (1, 20, 70):
            assert list(html_text.between(length, surge)) == line_blocks(length, surge), (length, surge)


def test_given_pages_keep_their_articles():
    pages = pq.read_table("/root/testdata/sf0.01/pages.parquet", columns=["html"])["html"].to_pylist()
    for page in pages:
        inside = re.search(r"<article[^>]*>(.*)</article>", page, re.S)
        text = html_text.main_text(page)
        assert text and inside
        # every kept line is one of the article's, and every paragraph outside a marked box is kept
        own = " ".join(html.unescape(re.sub(r"<[^>]*>", " ", inside[1])).split())
        assert all(" ".join(re.sub(r"\s+", " ", line).split())[:20] in own for line in text.split("\n"))


@pytest.mark.parametrize("part", [
    '<h2 id="related-work">own</h2>', '<section id="search-methods"><p>own</p></section>', '<section id="social-history"><p>own</p></section>',
    '<div class="side-by-side"><p>own</p></div>', '<h3 id="search">own</h3>', '<p id="alert-levels" class="first">own</p>',
])
def test_html_article_keeps_parts_about_such_words(part):
    page = f"<article><p>before</p>{part}<div class='x ad'>buy</div><div id=comments>reader</div><div class='share-buttons'>tweet</div><p>after</p></article>"
    assert html_text.main_text(page) == "before\nown\nafter"


def test_html_odd_markup_stays_linear():
    for page in ("<" * 50_000, '<a "' * 20_000, "<!--" * 20_000, "<div " * 20_000, "<div class=ad>" * 300, "<p>" * 50_000):
        html_text.main_text(page)


def test_html_table(spark):
    page = "<article><p>" + "word " * 50_000 + "</p></article>"
    pages = spark.createDataFrame([(1, None, None, 1), (2, "u", "", 1), (3, "u", page, 1), (3, "u", page, 1)],
                                  "page_id long, url string, html string, text long")
    got = rows(html_text.extract(pages))
    assert got[0] == (1, None, "", 0) and got[1] == (2, "u", "", 0)
    assert got[2] == got[3] and got[2][3] == len(page) - len("<article><p></p></article>") - 1
    assert rows(html_text.extract(pages.limit(0))) == []
