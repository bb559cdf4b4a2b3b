import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from kestrel.llm import crf, extract, langid, toxicity
from kestrel.llm.queries import QUERIES

from .helpers import EDGE, documents

SF = "/root/testdata/sf0.01"


def rows_of(spark, name, sf=SF):
    return spark.read.parquet(f"{sf}/{name}.parquet")


def held_out(i):
    return zlib.crc32(str("" if i is None else i).encode()) % 5 == 0


def test_toxicity_held_out(spark):
    got = {r.doc_id: r for r in QUERIES["op5_toxicity"](spark, SF).collect()}
    gold = {r.doc_id: r.toxic for r in rows_of(spark, "labels").collect()}
    assert len(got) == rows_of(spark, "documents").count()
    assert all(r.held_out == held_out(i) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for i, r in got.items())
    own = [(got[i].predicted, y) for i, y in gold.items() if held_out(i)]
    assert np.mean([p == y for p, y in own]) >= 0.93
    assert sum(p > y for p, y in own) <= 0.03 * len(own)


def test_sentences_are_located(spark):
    bad, ok = ["you vile toad", "what a vile toad", "vile toads all"], ["the sun is out", "a calm day", "birds sing here"]
    calm = "Here is a long and quite calm sentence about the weather of day"
    rows = [(f"{calm} {i}. {calm} again {ok[i % 3]}. " + (f"Now {bad[i % 3]} and more words than eight of them. "
             if i % 2 else "") + calm, i % 2) for i in range(200)]
    model = toxicity.fit_rows(rows)
    got = toxicity.locate_sentences(documents(spark, [(i, t) for i, (t, _) in enumerate(rows)]), model).collect()
    assert {r.doc_id for r in got} == {i for i, (_, y) in enumerate(rows) if y}
    assert all("vile" in r.sentence_text and rows[r.doc_id][0][r.start:].startswith(r.sentence_text) for r in got)


def test_toxicity_edges(spark):
    docs = documents(spark, EDGE, ["score", "held_out", "y"])
    labels = spark.createDataFrame([(1, 1), (3, 0), (None, 1), (4, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = toxicity.score_documents(docs, model).collect()
    assert len(got) == len(EDGE) and all(0 <= r.score <= 1 for r in got)
    assert toxicity.score_documents(docs.limit(0), model).count() == 0
    assert toxicity.fit(docs, labels.limit(0)).weights == {}
    kept = toxicity.keep_clean(docs, toxicity.Model({}, -10.0))
    assert kept.columns == docs.columns and kept.count() == len(EDGE)


def test_noisy_or():
    m = toxicity.Model({"=bad": 3.0}, -2.0)
    p = lambda z: 1 / (1 + np.exp(-z))
    eight = "a b c d e f g"
    text = f"{eight} bad. {eight} h. {eight} bad"
    assert abs(m.score(text) - (1 - (1 - p(1)) ** 2 * (1 - p(-2)))) < 1e-12
    assert abs(m.score("") - p(-2)) < 1e-12


def test_scoring_leaves_no_words_on_the_shared_model():
    """A worker keeps a broadcast model after its task: the memo of a task must not grow on it."""
    class Shared:
        value = toxicity.Model({"=bad": 3.0}, -2.0)

    batch = pa.RecordBatch.from_arrays([pa.array([1, 2]), pa.array(["bad words here", "other ones."])], ["doc_id", "text"])
    got = [x for b in toxicity._scores(Shared, "score")([batch]) for x in b.column("score").to_pylist()]
    assert got == [Shared.value.own().score(t) for t in ("bad words here", "other ones.")]
    assert sum(b.num_rows for b in toxicity._located(Shared)([batch])) == 1
    assert Shared.value.memo == {}


def test_language_held_out(spark):
    got = QUERIES["op9_language_id"](spark, SF).collect()
    gold = {r.doc_id: (r.lang, r.text) for r in rows_of(spark, "documents").collect()}
    assert len(got) == len(gold)
    own = [r for r in got if r.held_out and gold[r.doc_id][0]]
    assert np.mean([r.lang_pred == gold[r.doc_id][0] for r in own]) >= 0.97
    assert all(r.held_out == held_out(r.doc_id) and 0 <= r.score <= 1 for r in got)


def test_words_of_switched_text_and_edges(spark):
    docs = rows_of(spark, "documents")
    model = langid.fit(docs)
    texts = {r.lang: " ".join(re.findall(r"[^\W\d_]+", r.text)[:40]) for r in
             docs.where(F.length("text") > 1500).collect()}
    for a, b in (("en", "de"), ("fr", "es")):
        both = f"{texts[a]}, {texts[b]}"
        best = [model.labels[k] for k in langid.word_posteriors(both, model).argmax(axis=1)]
        n = len(texts[a].split())
        right = [x == a for x in best[:n]] + [x == b for x in best[n:]]
        assert np.mean(right) > 0.9
    edge = [*EDGE, (20, "123 !? 456"), (21, "x" * 50_000), (22, texts["de"] + " \0 " + texts["de"])]
    got = langid.identify_languages(documents(spark, edge, ["score", "lang_pred"]), model=model).collect()
    assert len(got) == len(edge)
    none = {i for i, t in edge if not any(c.isalpha() for c in t or "")}
    assert all((r.lang_pred == "und") == (r.doc_id in none) for r in got if r.doc_id is not None)
    assert {r.doc_id: r.lang_pred for r in got}[22] == "de"
    empty = documents(spark, edge).limit(0)
    assert langid.identify_languages(empty).count() == 0
    nameless = documents(spark, [(1, "hello", None)])
    assert langid.identify_languages(nameless).first().lang_pred == "und"


def test_mean_posteriors_equal_plain_forward_backward():
    rng = np.random.default_rng(0)
    model = crf.Model(["a", "b", "c"], np.zeros((1, 3)), rng.normal(size=(3, 3)), rng.normal(size=3))
    lengths = np.array([0, 1, 5, 64, 65, 0, 200, 3])
    e = rng.normal(size=(lengths.sum(), 3)).astype(np.float32)
    got = crf.mean_posteriors(e, lengths, model, width=16)
    at = 0
    for k, n in enumerate(lengths):
        if n:
            one = crf.forward_backward(e[None, at:at + n].astype(float), np.ones((1, n), bool), model.transitions,
                                       model.start)[0][0].mean(axis=0)
            assert np.abs(got[k] - one).max() < 1e-4
        else:
            assert (got[k] == 0).all()
        at += n


def test_posteriors_and_viterbi_equal_enumeration():
    from itertools import product
    rng = np.random.default_rng(1)
    t, s, e = rng.normal(size=(2, 2)), rng.normal(size=2), rng.normal(size=(5, 2))
    score = {p: s[p[0]] + sum(e[i][y] for i, y in enumerate(p)) + sum(t[a][b] for a, b in zip(p, p[1:]))
             for p in product((0, 1), repeat=5)}
    assert crf.viterbi(e, t, s) == list(max(score, key=score.get))
    z = sum(np.exp(v) for v in score.values())
    post = crf.forward_backward(e[None], np.ones((1, 5), bool), t, s)[0][0]
    for i in range(5):
        want = sum(np.exp(v) for p, v in score.items() if p[i] == 1) / z
        assert abs(post[i, 1] - want) < 1e-9


def test_extraction_held_out_pages():
    model, right, n = extract.trained(), 0, 0
    for page, labels in extract.labelled_pages(150, seed=1234):
        got = model.labels(extract.blocks(page))
        right += sum(a == b for a, b in zip(got, labels))
        n += len(labels)
    assert right / n > 0.98


PAGE = """<html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
<header class="site-header"><h1>My Site</h1><ul><li><a href=/>Home</a><li><a href=/b>News</a></ul></header>
<div id="cookie-notice">We use cookies. <button>OK</button></div><nav><a href="/x">one</a> <a href="/y">two</a></nav>
<div class="ad">Buy now!</div><article><h1>The  title &amp; more</h1><p><b>First&nbsp;line<br>goes on &eacute; &#x4e2d; &lt;x&gt;.
<p>Second <a href=z>linked</a> one.</p><div class="advert">Sponsored words here.</div><ul><li>item one<li>item two</ul>
<aside class="related"><p>Read this other thing too.</p></aside></article>
<form action=/s><label>Your mail</label><input><button>Subscribe</button></form>
<section class="comments"><h3>Comments</h3><article class="comment"><p>I think this is a great article indeed.</p></article></section>
<aside class="sidebar"><p>Popular stories of the week are here.</p></aside><footer>&copy; 2020 Someone &middot; All rights.</footer></body></html>"""


def test_extraction_of_a_page():
    text = extract.trained().main_text(PAGE)
    assert text == ("The title & more\n\nFirst line goes on é 中 <x>.\n\nSecond linked one.\n\nitem one\n\nitem two")


def test_extraction_of_given_pages_and_edges(spark):
    got = {r.page_id: r for r in QUERIES["op10_html_extraction"](spark, SF).collect()}
    for r in rows_of(spark, "pages").collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", r.html, re.S)[1]
        assert got[r.page_id].text.startswith(extract.blocks(inner)[0].text) and got[r.page_id].url == r.url
        assert got[r.page_id].text == "\n\n".join(b.text for b in extract.blocks(inner))
        assert got[r.page_id].n_chars == len(got[r.page_id].text)
    odd = [(1, "u", None), (2, None, ""), (None, "u", "<p"), (3, "u", "<article><p>x" + "<div>" * 3000 + "deep words here."),
           (4, "u", "plain words only & no tags < here"), (4, "u", "<!-- never closed"), (5, "u", "<script>never closed"),
           (6, "u", "<article><p>" + "long text " * 50_000), (7, "u", "</div></p><a b='c><p>quote")]
    df = spark.createDataFrame([(*r, "x") for r in odd], "page_id long, url string, html string, text string")
    rows = extract.extract_text(df).collect()
    assert len(rows) == len(odd) and all(r.n_chars == len(r.text) for r in rows)
    by = {r.page_id: r.text for r in rows}
    assert by[1] == by[2] == by[5] == "" and len(by[6]) == 499_999
    assert extract.extract_text(df.limit(0)).count() == 0


def test_every_language_is_learned_from(spark, monkeypatch):
    rows = [(k * 12 + i, f"w{k} " * 2000, f"l{k:02d}") for k in range(90) for i in range(12)]
    docs = documents(spark, rows)
    found = langid._sample(docs, 600, 60)
    assert {lang for lang, _, _ in found} == {f"l{k:02d}" for k in range(90)}
    assert all(cut and len(span) == 60 * langid.SPAN for _, span, cut in found)
    assert len(found) == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, _, _ in rows)
    monkeypatch.setattr(langid, "MAX_DOCS", 180)
    few = langid._sample(docs, 600, 60)
    assert len(few) <= 360 and len({lang for lang, _, _ in few}) > 64


ARTICLE = ["The council met on Tuesday to discuss the plan for the new bridge, which had been delayed twice. Members spoke "
           "for two hours.", "Residents said that they welcomed the change but asked for more time. A second hearing will "
           "follow in May.", "The mayor thanked everyone for coming and closed the meeting at nine. Work should begin next year."]


def test_articles_without_telling_markup():
    ps, model = "".join(f"<p>{p}</p>" for p in ARTICLE), extract.trained()
    links = '<ul><li><a href="/">Home</a></li><li><a href="/n">News</a></li></ul>'
    comment = "<p>I was there and it was a very long meeting, thanks for the report.</p>"
    for body in (ps, f"<div>{ps}</div>", f'<div class="xyz">{ps}</div>', f"<nav>{links}</nav>{ps}",
                 f"<table><tr><td>{links}</td><td>{ps}</td></tr></table>",
                 f'<table><tr><td><a href="/">Home</a><br><a href="/n">News</a></td><td>{ps}</td></tr></table>',
                 f'<article>{ps}</article><div id="disqus_thread">{comment}</div>',
                 f'<div>{ps}</div><div id="disqus_thread">{comment}</div>'):
        assert model.main_text(f"<html><body>{body}</body></html>") == "\n\n".join(ARTICLE), body


def test_formulas_and_listings_are_text():
    page = (f"<article><p>{ARTICLE[0]}<p>The area is <math><mi>x</mi>+<mi>y</mi></math> units.<xmp>a <b> &amp; c</xmp>"
            f"<p>{ARTICLE[1]} <canvas>Shown instead.</canvas></article>")
    assert extract.trained().main_text(page) == "\n\n".join(
        [ARTICLE[0], "The area is x+y units.", "a <b> &amp; c", ARTICLE[1] + " Shown instead."])
