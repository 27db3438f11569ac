import html
import random
import re
from collections import Counter

import pandas as pd
import pytest

from tripmill.llm import template as T
from tripmill.llm.common import table

FORM = "page_id long, url string, html string"


def pages(spark, rows, clash=False):
    df = spark.createDataFrame(rows, FORM)
    return df.selectExpr("*", *[f"'x' as {c}" for c in ("host", "text", "n_chars", "token", "of", "elements")]) if clash else df


def texts(df):
    return {r.page_id: r.text for r in df.collect()}


def words(seed, n):
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghij") for _ in range(5)) for _ in range(n))


def test_marked_articles_of_the_given_pages(spark, sf_dir):
    df = table(spark, sf_dir, "pages")
    got = texts(T.main_text(df))
    for r in df.collect():
        body = re.search(r"<article>(.*?)</article>", r.html, re.S).group(1)
        parts = (" ".join(html.unescape(re.sub(r"<[^>]*>", " ", x)).split()) for x in re.split(r"</?(?:p|h1)>", body))
        assert got[r.page_id] == "\n".join(x for x in parts if x)


def blank_page(k, notice=True):
    """A page whose classes say nothing: only the host's other pages tell what is template."""
    title, paragraphs = words(k, 4), [words(100 * k + m, 30) for m in range(2 + k % 3)]
    body = "".join(f"<p>{p}</p>" for p in paragraphs)
    links = "".join(f'<a href="/{m}">{words(m, 1)}</a> ' for m in range(6))
    said = "<p>All rights belong to the people of this place.</p>" if notice else ""
    page = (
        f"<html><body><div class=q1>{links}</div><div class=q2><div class=q3><h1>{title}</h1>{said}{body}</div></div>"
        f"<div class=q4>{words(7 * k, 5)}</div><div class=q5>Printed on line {k}, by hand and with care</div></body></html>"
    )
    return page, "\n".join([title, *paragraphs])


def test_template_of_a_host_without_marks(spark):
    made = {k: blank_page(k) for k in range(1, 21)}
    rows = [(k, f"http://h.example/{k}", page) for k, (page, _) in made.items()]
    got = texts(T.main_text(pages(spark, rows, clash=True)))
    assert got == {k: want for k, (_, want) in made.items()}
    # few pages have no template; each page shows its main container by itself, the notice stays
    got = texts(T.main_text(pages(spark, rows[:3])))
    for k in (1, 2, 3):
        assert got[k].replace("All rights belong to the people of this place.\n", "") == made[k][1]


def test_copies_are_no_template(spark):
    """Most pages of a host are copies of one article: its text stays on all of them."""
    page, want = blank_page(3, notice=False)
    rows = [(k, "http://h.example/x", page) for k in range(30)]
    rows += [(k, "http://h.example/y", blank_page(k, notice=False)[0]) for k in range(30, 36)]
    got = texts(T.main_text(pages(spark, rows)))
    assert {got[k] for k in range(30)} == {want}


PARTS = [
    "<nav><ul><li><a href=/a>menu entry</a></li></ul></nav>", "<header><h2>Site name</h2></header>",
    "<aside>beside it</aside>", "<footer>at the end</footer>", "<div class='ad-slot'>buy this</div>",
    "<div id=cookie-notice>we use cookies</div>", "<form><p>your name</p><input></form>",
    "<section class='comments'><p>I think so too</p></section>", "<script>var x = '<p>no</p>';</script>",
    "<style>p { color: red }</style>", "<!-- <p>hidden</p> -->", "<div hidden>not shown</div>",
    "<div style='display: none'>nor this</div>", "<ul class=breadcrumbs><li>Home</li></ul>",
]


@pytest.mark.parametrize("around", ["<article>{}</article>", "<main>{}</main>", "<div role=main>{}</div>", "<div class=content>{}</div>"])
def test_what_is_not_the_article_goes(around):
    body = "<h1>A title &amp; more</h1><p>First   paragraph,\n with <b>bold</b> <a href=x>link</a>.<p>Second &lt;one&gt;&nbsp;here"
    rest = "".join(PARTS)
    within = "".join(part for part in PARTS if "<header>" not in part)  # an article's own header is its own
    page = f"<html><head><title>t</title></head><body>{rest}{around.format(body + within)}{rest}</body></html>"
    assert T.extract(page) == "A title & more\nFirst paragraph, with bold link.\nSecond <one> here"


def test_broken_markup():
    assert T.extract("<article><p>one<p>two <i>three</article>") == "one\ntwo three"
    assert T.extract("<article><p>one</p><p class='x") == "one"
    assert T.extract("<article><ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == "a\nb\nc\nd"
    assert T.extract("plain text only") == "plain text only"
    assert T.extract("<article>a < b and c</article>") == "a < b and c"
    assert T.extract("<article><script>never ends <p>x") == ""
    assert T.extract("") == ""


def test_classes_against_occurrence_vectors():
    """Classes by hashes are those of the vectors themselves."""
    found = [T._tokens(*T.parse(blank_page(k)[0])) for k in range(1, 21)]
    vectors, rows = {}, {}
    for page, tokens in enumerate(found):
        for token, (parent, is_text, heading, n, chars, links, place) in tokens.items():
            vectors.setdefault(token, Counter())[page] += n
            r = rows.setdefault(token, [parent, is_text, heading, 0, 0, 0, 0, 0, []])
            r[3] ^= T._hash(page, str(n))
            r[4] += 1
            r[5] += n
            r[6] += chars
            r[7] += links
            r[8].append(place)
    classes = {}
    for token, r in rows.items():
        classes.setdefault((r[3], r[4], r[5]), set()).add(token)
    exact = {}
    for token, v in vectors.items():
        exact.setdefault(frozenset(v.items()), set()).add(token)
    assert sorted(map(sorted, classes.values())) == sorted(map(sorted, exact.values()))
    names = ["parent", "is_text", "heading", "vector", "pages", "n", "chars", "links", "place"]
    frame = pd.DataFrame([[t, *r[:8], sum(r[8]) / len(r[8])] for t, r in rows.items() if r[4] >= 16], columns=["token", *names])
    order, fixed, container = T.deduce(frame, T.Template())
    assert len(fixed) >= 1 and container in order


def test_edge_rows(spark):
    page, want = blank_page(2, notice=False)
    long = "<article>" + "".join(f"<p>{words(k, 50)}</p>" for k in range(4000)) + "</article>"
    deep = "<div>" * 3000 + "deep" + "</div>" * 3000
    rows = [(None, None, None), (1, None, page), (1, None, page), (2, "http://h/", None), (3, "no address", ""), (4, "http://h/", long), (5, "http://h/", deep)]
    df = pages(spark, rows, clash=True)
    got = T.main_text(df).collect()
    assert len(got) == 7 and all(r.n_chars == len(r.text) for r in got)
    by = {(r.page_id, r.url): r.text for r in got}
    assert by[(1, None)] == want and by[(None, None)] == by[(2, "http://h/")] == by[(3, "no address")] == ""
    assert by[(4, "http://h/")].count("\n") == 3999 and by[(5, "http://h/")] == "deep"
    assert T.main_text(pages(spark, [])).collect() == []
