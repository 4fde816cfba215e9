import random

from docweave.sources import html as ht

ROWS = "".join(f"<tr><td>{i}</td><td>A| {i}</td><td><b>s</b> {i}</td></tr>\n" for i in range(3))
PAGE = f'<p>Order 1</p><table><tr><th>line<th>part</tr>{ROWS}</table><ul><li>one<p>two</p></li><li><h2>In 1</h2></li></ul><img src="../i/1.png" alt=" a \n b ">'


def by_library(page):
    tokens = ht._Tokens()
    tokens.feed(page)
    tokens.close()
    return tokens.parts, tokens.attrs, ht._walk(tokens.parts, tokens.marks)


def test_plain_pages_need_no_library(monkeypatch):
    def feed(self, data):
        raise AssertionError("the library reads a plain page")

    monkeypatch.setattr(ht.HTMLParser, "feed", feed)
    found = ht.parse_elements(PAGE, "http://h.org/x/y")
    assert [e[1:3] for e in found] == [("p", "Order 1"), ("table", "line part 0 A| 0 s 0 1 A| 1 s 1 2 A| 2 s 2"), ("ul", "one two In 1"), ("h2", "In 1"), ("img", "")]
    assert found[1][3] == PAGE[PAGE.index("<table>") : PAGE.index("<ul>")]
    assert found[1][4].split("\n")[:3] == ["| line | part |  |", "| --- | --- | --- |", "| 0 | A\\| 0 | s 0 |"]
    assert found[4][5:] == ("http://h.org/i/1.png", "a b", "")


def test_plain_pages_read_as_by_the_library(monkeypatch):
    rng = random.Random(1)
    tags = ["p", "P", "h1", "H3", "ul", "ol", "li", "table", "Table", "tr", "td", "th", "blockquote", "pre", "div", "img", "br", "span", "dl", "dt", "dd", "script", "noscript", "template", "title"]
    texts = ["x", " y  z ", "\n", "", "a|b", "&amp;", "&lt;p&gt;", "&nbsp;", "&am", "1 < 2", "<!-- c <p> -->", "a<b", "\x1c"]
    attrs = ["", "", "", ' src="a.png"', " ALT='q \"x\"'", ' src="a?x=1&amp;y=2"', " alt", " width=3", ' title="a>b"', ' src="x"alt="y"', '\nsrc="v" src="w"']
    plain = 0
    for _ in range(4000):
        page = ""
        for _ in range(rng.randrange(30)):
            tag, turn, odd = rng.choice(tags if rng.random() < 0.1 else tags[:21]), rng.random(), rng.random() < 0.1
            page += f"<{tag}{rng.choice(attrs if odd else attrs[:5])}{rng.choice(['', '', '/', ' '])}>" if turn < 0.4 else f"</{tag}{' ' * odd}>" if turn < 0.7 else rng.choice(texts if odd else texts[:9])
        got = ht.parse_elements(page, "http://h.org/a/b")
        plain += ht._walk(parts, parts[1::2], plain=True) is not None if (parts := ht._plain_parts(page)) is not None else False
        with monkeypatch.context() as m:
            m.setattr(ht, "_read", by_library)
            assert got == ht.parse_elements(page, "http://h.org/a/b"), page
    assert plain > 1000


def test_known_steps_are_bounded(monkeypatch):
    monkeypatch.setattr(ht, "MOST_STEPS", 50)
    for i in range(200):
        ht.parse_elements(f"<t{i}><p>x</p></t{i}>", None)
        assert ht._Open.learned <= 60
