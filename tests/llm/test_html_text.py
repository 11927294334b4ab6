import random
import string

from wayfuse.llm.common import settings
from wayfuse.llm.html_text import extract_text, html_to_text


def test_blocks_and_implied_tags():
    assert html_to_text("<title>no</title><p>One  two<p>three<br>four</p>five") == "One two\n\nthree\nfour\n\nfive"
    assert html_to_text("<div>a</div><div>b</div>") == "a\nb"
    assert html_to_text("<p>x &amp; y &lt;z&gt; <b>bold</b>text") == "x & y <z> boldtext"
    assert html_to_text("a < b and c") == "a < b and c"


def test_unseen_parts():
    page = ("<html><head><meta charset=u><title>t</title><style>p{}</style></head><body><script>var t='</p>';</script>"
            "<p hidden>h</p><p style='color:red; display: none'>n</p><!-- c --><template>x</template>"
            "<details><summary>s</summary>inside</details><details open><summary>s2</summary>shown</details>ok</body></html>")
    assert html_to_text(page) == "s\ns2\nshown\nok"


def test_lists():
    assert html_to_text("<ul><li>a<li>b<ol start=3><li>c</li><li>d</ol><li>e</ul>after") == (
        "- a\n- b\n  3. c\n  4. d\n- e\n\nafter")


def test_tables_align():
    page = "<table><tr><th>Name<th>No<tr><td>alpha<td>1<tr><td colspan=2>all of it<tr><td>b<td>22<td>x</table>"
    assert html_to_text(page) == "Name   No\nalpha  1\nall of it\nb      22  x"
    assert html_to_text("<table><td>a<table><td>i<td>j</table><td>b</table>") == "a     b\ni  j"


def test_pre_and_quotes():
    assert html_to_text("<pre>a\n  b</pre><blockquote>q<p>r</blockquote>") == "a\n  b\n\n  q\n\n  r"


def test_any_input_ends():
    rng = random.Random(3)
    pieces = ["<p>", "</p>", "<table>", "<tr>", "<td>", "</table>", "<li>", "<ul>", "</ul>", "<a href='", "<!--", "-->", "<br/>",
              "</div>", "<div x=\"", "&amp;", "&#x;", "<script>", "</script>", "<", ">", "text ", "\n", "<pre>", "<ol>"]
    for _ in range(400):
        html_to_text("".join(rng.choice(pieces + list(string.ascii_letters[:4])) for _ in range(60)))
    assert html_to_text("<div>" * 30_000 + "deep") == "deep"
    assert html_to_text("<table><tr><td>" * 3_000 + "deep").strip() == "deep"
    assert len(html_to_text("<a " + "x" * 200_000)) > 0


def test_as_a_table(spark):
    settings(spark)
    rows = [(1, "u", "<p>a<p>b"), (2, None, None), (3, "v", ""), (1, "u", "<p>a<p>b")]
    got = extract_text(spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 AS text", "2 AS n_lines"))
    assert sorted((r.page_id, r.text, r.n_lines) for r in got.collect()) == [(1, "a\n\nb", 2), (1, "a\n\nb", 2), (2, "", 0), (3, "", 0)]
