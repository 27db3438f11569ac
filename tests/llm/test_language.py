from helpers import documents, fold

from tripmill.llm import language as L

PAGES = "page_id long, url string, html string, host string, logs string, prior string"
WORDS = {"en": "the of and with that is are to", "de": "der die und nicht ein zu mit sich", "fr": "le la de et pour dans qui un"}


def text(lang, k):
    words = WORDS[lang].split()
    return " ".join(words[(k + j * j) % len(words)] for j in range(25))


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x") for r in rows], PAGES)


def model(spark, m=L.LanguageModel()):
    docs = [(k, text(lang, k), lang.upper() if k % 7 == 0 else lang, "s") for k, lang in enumerate(list(WORDS) * 30)]
    return L.train(documents(spark, docs + [(None, "x", "en"), (900, None, "en"), (901, "x", None), (902, "x", " ")]), m)


def test_parts_of_a_page(spark):
    rows = [
        (1, "https://User@Blog.A.Example.COM:80/fr/8?x", "<HTML dir=x lang='FR-ca'>"), (2, "http://a.de", "<html>"), (3, None, None),
        (4, "nonsense", "lang=en"), (5, "http://x.org/english/fr", "<html lang=de >"), (6, "http://x.org/de", "<html\nxml:lang='xx' lang=en>"),
    ]
    got = {r.id: r for r in L.evidence_from_pages(pages(spark, rows)).collect()}
    assert [got[k].host for k in range(1, 7)] == ["blog.a.example.com", "a.de", "", "", "x.org", "x.org"]
    assert [got[k].domain for k in (1, 2, 3)] == ["example.com", "a.de", ""]
    assert [got[k].suffix for k in range(1, 7)] == ["/fr", ".de", "", "", ".org", "/de"]
    assert [got[k].declared for k in range(1, 6)] == ["fr", "", "", "", "de"]
    assert L.plain("<p>a&eacute;<script>var x='</p>';</script><!-- c --> b<style>q") .split() == ["aé", "b"]


def test_evidence_decides_where_the_text_does_not(spark):
    names, logs = model(spark)
    assert names == ["de", "en", "fr"]
    rows = []
    for k in range(120):
        lang = ["en", "de", "fr"][k % 3]
        rows.append((k, f"http://{lang}site.example.com/{lang}/{k}", f'<html lang="{lang}"><p>{text(lang, k)}</p>'))
    rows += [
        (500, "http://other.example.net/fr/1", "<p>123</p>"), (501, "http://other.example.net/x", '<html lang="de"><p>...</p>'),
        (502, "http://frsite.example.com/", ""), (503, None, None), (None, None, None), (504, "http://ensite.example.com/en/1", f"<html lang=en>{text('de', 3) * 3}"),
    ]
    m = L.LanguageModel()
    got = L.identify(L.evidence_from_pages(pages(spark, rows)), names, logs, m).collect()
    assert len(got) == len(rows)
    by_id = {r.id: r for r in got}
    assert all(by_id[k].lang == ["en", "de", "fr"][k % 3] for k in range(120))
    assert [by_id[k].lang for k in (500, 501, 502, 504)] == ["fr", "de", "fr", "de"]
    assert by_id[503].lang in names and 0 < by_id[503].confidence < 0.9
    assert L.identify(L.evidence_from_pages(pages(spark, [])), names, logs).collect() == []
    none = L.identify(L.evidence_from_pages(pages(spark, rows[:1])), *L.train(documents(spark, [])))
    assert none.first().lang is None and none.first().confidence == 0.0


def test_held_out_accuracy_on_the_given_documents(spark, table):
    docs = table("documents")
    names, logs = L.train(docs)
    true = {r.doc_id: (r.lang, len(r.text)) for r in docs.collect()}
    got = L.identify(L.evidence_from_documents(docs), names, logs, markup=False).collect()
    held = [r for r in got if fold(r.id, 5) == 1]
    assert held and sum(r.lang == true[r.id][0] for r in held) >= 0.95 * len(held)
