"""Markup is recognised by construct, its structure kept, and look-alike signs left alone."""

import pytest

from folioloom.llm import markup as M


@pytest.mark.parametrize(
    ("text", "clean", "kind"),
    [
        ("<p>One</p><p>Two</p>", "One\n\nTwo", "html"),
        ("<h2>Head</h2>body", "## Head\n\nbody", "html"),
        ("<ul><li>a</li><li>b<ol><li>c</li></ol></li></ul>", "- a\n- b\n\n  1. c", "html"),
        ("<table><tr><th>a</th><th>b</th></tr><tr><td>1</td><td>2</td></tr></table>", "| a | b |\n| 1 | 2 |", "html"),
        ("<pre>x <b>\n  y</pre>", None, "html"),
        ("a<br/>b <script>x()</script>c", "a\nb c", "html"),
        ("5 &lt; 6 &amp; &nbsp;x", "5 < 6 & \xa0x", "entity"),
        ("&lt;b&gt;bold&lt;/b&gt; rest", "bold rest", "escaped html"),
        ("text<!-- page 3 --> more", "text more", "html comment"),
        ("## Head\n\nbody", "## Head\n\nbody", "markdown"),
        ("Head\n====\n\nbody", "# Head\n\nbody", "markdown"),
        ("a **b** __c__ *d* ~~e~~ `f_g`", "a b c d e f_g", "markdown"),
        ("[t](http://x.invalid/a) ![alt](i.png)", "t alt", "markdown"),
        ("| a | b |\n|---|:-:|\n| 1 | 2 |", "| a | b |\n| 1 | 2 |", "markdown"),
        ("```py\nx = a*b*c\n```", "x = a*b*c", "markdown"),
        ("> quoted\n> text", "quoted\ntext", "markdown"),
        ("- [x] done\n- [ ] open", "- done\n- open", "markdown"),
        ("see.[^1]\n\n[^1]: the note", "see.\n\nthe note", "markdown"),
        ("'''Bold''' and ''it''", "Bold and it", "wiki"),
        ("== Head ==\nx {{cite|no=2}}[[Category:y]]", "# Head\nx ", "wiki"),
        ("[[a|b]] [http://x.invalid c d]", "b c d", "wiki"),
        ("* [[a]]\n** [[a 1]]", "- a\n  - a 1", "wiki"),
        ('{| class="w"\n! s !! v\n|-\n| a || 1\n|}', "| s | v |\n| a | 1 |", "wiki"),
        ("\\section{Head}\nx \\emph{y} 5\\%~\\cite{z}", "# Head\nx y 5%", "latex"),
        ("\\begin{itemize}\n\\item a\n\\item b\n\\end{itemize}", "- a\n- b", "latex"),
        ("\\begin{tabular}{ll}\na & 1 \\\\\nb & 2\n\\end{tabular}", "| a | 1 |\n| b | 2 |", "latex"),
        ("\\begin{verbatim}\nset *x* 1\n\\end{verbatim}", "set *x* 1", "latex"),
        ("so $a_{1} = \\frac{b}{c}$ holds", "so $a_{1} = \\frac{b}{c}$ holds", "latex formula"),
        ("\\[ x^2 \\] end", "$$x^2$$ end", "latex formula"),
    ],
)
def test_recognised(text, clean, kind):
    got, kinds = M.convert(text)
    assert kind in kinds
    if clean is not None:
        assert got.strip() == clean.strip()


PLAIN = [
    "Costs rose from $5 to $12 per unit.",
    "$5 – $70;",
    "* 5 %, ** 1 %; text",
    "Marks: * significant at 5 %, ** at 1 %.",
    "C:\\data\\set87 and D:\\new\\text",
    "(C# 55) Item #57, #15;",
    "3 < 5 and 9 > 7",
    "R&D {87}, x|y; AT&T",
    "The field max_row_count is 13",
    "a/b = 67 ~ b/a",
    "desk19@office.invalid == front desk?",
    "- 2 -",
    "• item",
    "1) item\n2) item",
    "(a) item",
    "[1] Name, A.: Title. [2] see [12] and [15]",
    "2 * 3 * 4 = 24",
    "it's 'quoted' text",
    "f(x) [y](z)",
    "",
    "plain",
]


@pytest.mark.parametrize("text", PLAIN)
def test_plain_text_is_untouched(text):
    assert M.convert(text) == (text, [])


@pytest.mark.parametrize("text", ["<", "<<b>", "</", "&#;", "&#xffffffff;", "{|", "\\begin{tabular}", "$", "```", "[", "<table><td>x", "\\", "|\n|", "<![CDATA[", "<b " + "a" * 50_000, "*" * 5000, "[" * 3000, "<div>" * 3000])
def test_broken_markup_does_not_fail(text):
    clean, _ = M.convert(text)
    assert isinstance(clean, str)


PAGE = '<html><body><div class="nav"><a href="/">Home of all</a> <a href="/x">More of it</a></div><div class="text{i}"><p>{body}</p></div><div class="foot">small print</div></body></html>'


def test_host_paths_vote_and_extract(spark):
    rows = [(i, "h1" if i % 3 else "h2", "text", None, PAGE.format(i=i, body="many words of real content here " * (1 + i % 4))) for i in range(30)]
    rows += [(100, None, "text", "x **y**", None), (101, "h1", "code", "`a`", "<b>frag</b>"), (102, "h1", None, "", None), (102, "h1", None, "", None)]
    df = spark.createDataFrame(rows, "block_id long, doc_id string, type string, content string, html string")
    paths = {r.host: r.path for r in M.consensus_paths(df, "doc_id", "html").collect()}
    assert paths == {"h1": "html/body/div.text/p", "h2": "html/body/div.text/p"}
    out = {(r.block_id, r.field_name): (r.clean, r.kinds) for r in M.clean_fields(df).collect()}
    assert M.clean_fields(df).count() == 30 + 1 + 2 + 2
    assert all("Home" not in out[i, "html"][0] and "small print" not in out[i, "html"][0] and "real content" in out[i, "html"][0] for i in range(30))
    assert out[100, "content"] == ("x y", ["markdown"]) and out[101, "html"] == ("frag", ["html"]) and out[102, "content"] == ("", [])
    assert M.clean_fields(df.limit(0)).count() == 0


def test_code_and_formulas_are_kept(spark):
    formula, code = "\\frac { T } { 75 } - \\lambda ^ { 2 }", 'def f(x):\n    print("<b>21</b>")\n    return `x` * *y*  # **no** markup\n'
    rows = [(1, "d", "interline_equation", formula, None), (2, "d", "code", code, "<b>x</b>"), (3, "d", "code", None, None), (4, "d", "text", code, None)]
    df = spark.createDataFrame(rows, "block_id long, doc_id string, type string, content string, html string")
    out = {(r.block_id, r.field_name): (r.clean, r.kinds) for r in M.clean_fields(df).collect()}
    assert out.pop((4, "content"))[1]
    assert out == {(1, "content"): (formula, []), (2, "content"): (code, []), (2, "html"): ("x", ["html"])}


def test_signs_of_latex_are_kept():
    assert M.convert("the mean \\lambda of 5 \\times 3") == ("the mean λ of 5 × 3", ["latex"])
    assert M.convert("\\section{Head}\nup to \\alpha \\leq \\infty.")[0] == "# Head\nup to α ≤ ∞."


def test_path_decides_what_is_judged(spark):
    """Boilerplate of a host holds wiki markup, its articles none: only the consensus path tells."""
    page = "<html><body><div class='nav{k}'><a href='/'>[[Start|Home]] '''menu'''</a></div><div class='text{k}'><p>{words}</p></div></body></html>"
    rows = [(k, "h", "text", None, page.format(k=k, words=f"word {k} of the article " * 5)) for k in range(6)]
    # a page of the same host whose menu is longer than its article: by itself it would choose the menu
    rows.append((9, "h", "text", None, "<html><body><div class='nav9'><p>" + "[[Start|Home]] of many things to see " * 4 + "</p></div><div class='text9'><p>short article</p></div></body></html>"))
    df = spark.createDataFrame(rows, "block_id long, doc_id string, type string, content string, html string")
    got = {r.block_id: r for r in M.clean_fields(df).collect()}
    assert {r.path for r in got.values()} == {"html/body/div.text/p"}
    assert all(list(r.kinds) == ["html"] and "Home" not in r.clean for r in got.values()) and got[9].clean == "short article"
    alone = M.clean_fields(df.where("block_id = 9")).first()
    assert alone.path == "html/body/div.nav/p" and "wiki" in alone.kinds and "short article" not in alone.clean
