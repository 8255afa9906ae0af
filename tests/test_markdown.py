"""Markdown of nested pages: golden rows, broken nesting, depth."""
import random

import pytest

from feedloom.operators.enrich import main_markdown, markdown_of

CASES = [
    ("<h1>A <em>b</em></h1><p>x  y\n z</p>", "# A *b*\n\nx y z"),
    ("<ul><li>one<ul><li>two <b>bold</b><ol start=3><li>three<li>four</ol></li></ul></li><li>five</li></ul>",
     "* one\n  + two **bold**\n    3. three\n    4. four\n* five"),
    ("<ol><li><p>a</p><p>b</p></li><li>c</li></ol>", "1. a\n\n   b\n2. c"),
    ("<p>a <strong> b </strong> c <i><b>d</b></i> <b><strong>e</strong></b> <em> </em>f</p>", "a **b** c ***d*** **e** f"),
    ("<p><b>X<br></p><p>y", "**X**\n\ny"),
    ("<b>a<p>b</p>c</b> d", "**a**\n\n**b**\n\n**c** d"),
    ("<a href='https://x/1' title='t \"q\"'> go <b>there</b></a>, <a href=https://x/2>https://x/2</a>, <a>none</a>, <a href='/e'></a>",
     "[go **there**](https://x/1 \"t \\\"q\\\"\"), <https://x/2>, none,"),
    ("<table><tr><th>k<th>v</tr><tr><td>a|b<td>c<br>d</tr><tr><td><ul><li>x</ul></tr></table>", "| k | v |\n| --- | --- |\n| a\\|b | c d |\n| * x |  |"),
    ("<table><thead><tr><td>h</td></tr></thead><tbody><tr><td>1</td><td>2</td></tr></tbody></table>", "| h |  |\n| --- | --- |\n| 1 | 2 |"),
    ("<pre>  a *b*\n <code>c_d</code>\n\n\ne</pre><p>t", "```\n  a *b*\n c_d\n\n\ne\n```\n\nt"),
    ("<pre>x ``` y</pre>", "````\nx ``` y\n````"),
    ("use <code>a * b</code>, <code>`t`</code> and <code> </code>.", "use `a * b`, `` `t` `` and ."),
    ("<blockquote><p>a</p><blockquote>b</blockquote><ul><li>c</ul></blockquote>d", "> a\n>\n> > b\n>\n> * c\n\nd"),
    ("5 * 3 = 15, snake_case, back\\slash `tick`", "5 \\* 3 = 15, snake\\_case, back\\\\slash \\`tick\\`"),
    ("<p># no head</p><p>- no item</p><p>1. no list</p><p>> no quote</p><p>2024 yes</p>", "\\# no head\n\n\\- no item\n\n1\\. no list\n\n\\> no quote\n\n2024 yes"),
    ("a<hr>b<br>c<img src=i.png alt=pic><h2>h<img src=j.png alt=in></h2>", "a\n\n---\n\nb  \nc![pic](i.png)\n\n## hin"),
    ("<p>A &amp; B &lt;tag&gt;</p><script>x<y</script><style>p{}</style>", "A & B <tag>"),
    ("<dl><dt>t<dd>d1<dd>d2</dl><div><div>deep</div> end</div>", "t\n\nd1\n\nd2\n\ndeep\n\nend"),
    ("</p></b>x<p>y</i></p></div>", "x\n\ny"),
    ("", ""), ("<p> \n </p><ul><li></li></ul><table></table><pre>\n</pre>", ""),
    ("<li>a<li>b", "* a\n* b"),
]


@pytest.mark.parametrize("html,want", CASES)
def test_golden(html, want):
    lines = lambda t: "\n".join(x.rstrip() if x.strip() == ">" else x for x in t.split("\n"))
    assert lines(markdown_of(html)) == want


def test_the_main_block_and_the_whole_page():
    page = "<head><title>t</title></head><nav>menu</nav><main><article><h1>Dev</h1><ul><li>Go<ul><li>gRPC</ul></ul></article></main><footer>f</footer>"
    assert main_markdown(page) == "# Dev\n\n* Go\n  + gRPC"
    assert main_markdown("<article>related jobs</article>") == "related jobs"
    assert main_markdown("<nav>only a menu</nav>") == "only a menu"


def test_any_nesting_ends_and_loses_no_word():
    rnd = random.Random(2)
    tags = ["p", "b", "i", "a href=x", "ul", "ol", "li", "div", "table", "tr", "td", "th", "blockquote", "pre", "code", "h2", "span", "br", "hr", "em", "dl", "dd"]
    for n in range(400):
        words, out = [], []
        for _ in range(rnd.randrange(40)):
            x = rnd.random()
            if x < .45:
                out.append(f"<{rnd.choice(tags)}>")
            elif x < .7:
                out.append(f"</{rnd.choice(tags).split()[0]}>")
            else:
                words.append(f"w{n}x{len(words)}")
                out.append(f" {words[-1]} ")
        md = markdown_of("".join(out))
        table = "<t" in "".join(out)  # words between a table's rows and cells are not its content
        assert table or [w for w in words if w not in md] == [], ("".join(out), md)
        assert md.count("**") % 2 == 0


def test_depth_is_no_recursion():
    assert markdown_of("<div>" * 20000 + "x").strip() == "x"
    deep = markdown_of("<ul><li>" * 300 + "x")
    assert deep.endswith(" x") and deep.count("\n") == 0
