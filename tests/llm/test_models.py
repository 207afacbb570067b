import html
import math
import re
import zlib
from collections import Counter

import numpy as np
from llm.data import ODD_TEXTS, SF, given, no_documents, odd_documents

import corpus_pipeline
from parcelflow.llm import language, language_model, quality
from parcelflow.llm.columns import fold
from parcelflow.llm.html_content import extract, main_text, merged, packed, parse, shape, unpacked
from parcelflow.llm.queries import QUERIES


def crc(doc_id, folds):
    return zlib.crc32(str(doc_id).encode()) % folds


def test_quality_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in given(spark, "labels", sf).collect()}
    rows = QUERIES["op1_quality_classifier"](spark, sf).collect()
    assert len(rows) == given(spark, "documents", sf).count()
    assert all(r.held_out == (crc(r.doc_id, 3) == 1) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95


def test_quality_of_odd_rows(spark):
    docs, none = odd_documents(spark), no_documents(spark)
    labels = spark.createDataFrame([(3, 1, 0), (6, 0, 0), (6, 0, 0), (7, None, 0), (None, 1, 1), (99, 1, 0)], "doc_id long, quality int, toxic int")
    model = quality.fit(docs, labels)
    scored = quality.with_scores(docs, model, "_quality")
    assert scored.columns == [*docs.columns, "_quality"]
    got = [(r.doc_id, r._quality) for r in scored.collect()]
    assert len(got) == len(ODD_TEXTS) and all(0 <= s <= 1 for _, s in got)
    by = dict(got)
    assert by[3] > 0.5 > by[6] and by[1] == by[2]
    empty = quality.fit(none, labels)
    assert {r.s for r in quality.with_scores(docs, empty, "s").collect()} == {0.5}
    assert quality.with_scores(none, model, "s").collect() == []


def test_quality_that_shows_in_the_wording_only(spark):
    rng = np.random.default_rng(1)
    words = [[a + b + c for a in first for b in "aeiou" for c in "lmnr"] for first in ("bdfg", "kpst")]
    texts = [" ".join(rng.choice(words[k % 2], 30)) + "." for k in range(400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(200)], "doc_id long, quality int")
    scored = quality.with_scores(docs, quality.fit(docs.where("doc_id < 200"), labels), "s").where("doc_id >= 200").collect()
    assert np.mean([(r.s >= 0.5) == r.doc_id % 2 for r in scored]) > 0.95


def test_languages_of_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in given(spark, "documents", sf).collect()}
    rows = QUERIES["op8_language_id"](spark, sf).collect()
    assert len(rows) == len(truth) and all(r.held_out == (crc(r.doc_id, 4) == 2) for r in rows)
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in rows if r.held_out]) > 0.97


def test_languages_of_odd_rows_and_spans(spark):
    model = language.fit(given(spark, "documents"))
    texts = {r.lang: r.text for r in given(spark, "documents").where("length(text) > 900").collect()}
    mixed = texts["de"][:400] + "\n" + texts["es"][:200]
    (found,) = language.label([mixed], model).to_pylist()
    assert found["lang"] == "de" and 0.5 < found["score"] < 0.8
    assert {s["lang"] for s in found["spans"]} == {"de", "es"}
    assert all(mixed[s["start"]].isalpha() and mixed[s["stop"] - 1].isalpha() for s in found["spans"])
    got = {(r.doc_id, r.f.lang, r.f.score) for r in language.with_languages(odd_documents(spark), model, "f").collect()}
    assert {i for i, lang, score in got if lang == "und" and score == 0} == {1, 2, 5, 6}
    assert language.with_languages(no_documents(spark), model, "f").collect() == []
    nothing = language.fit(no_documents(spark))
    assert {r.f.lang for r in language.with_languages(odd_documents(spark), nothing, "f").collect()} == {"und"}


def test_the_path_is_the_best_of_all_paths():
    rng = np.random.default_rng(0)
    text = np.repeat([0, 2, 3], [5, 1, 3])
    scores = rng.normal(size=(9, 3)).astype(np.float32)
    path = language.best_path(scores, text, 0.7)
    for of in (0, 2, 3):
        at = np.flatnonzero(text == of)
        worth = lambda p: scores[at, p].sum() - 0.7 * (np.diff(p) != 0).sum()
        every = np.stack(np.meshgrid(*[range(3)] * len(at)), -1).reshape(-1, len(at))
        assert math.isclose(worth(path[at]), max(map(worth, every)), rel_tol=1e-6)


def test_base_scores_are_by_counts_and_the_model_beats_them(spark):
    rows = QUERIES["op4_lm_scores"](spark, SF).collect()
    docs = given(spark, "documents").collect()
    counts = Counter(w for r in docs if crc(r.doc_id, 7) != 2 for w in language_model.tokens(r.text or ""))
    n, v = counts.total(), len(counts)
    texts = {r.doc_id: language_model.tokens(r.text or "") for r in docs}
    for r in rows:
        own = texts[r.doc_id]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(own), sum(w in counts for w in own), n)
        assert math.isclose(r.base_score, base, rel_tol=1e-9) and r.held_out == (crc(r.doc_id, 7) == 2)
    held = [r for r in rows if r.held_out]
    assert sum(r.score for r in held) > 0.97 * sum(r.base_score for r in held)


def test_language_model_of_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(language_model, "HEAD", 3)  # most words are joined
    docs = odd_documents(spark).select("doc_id", "text")
    got = language_model.language_scores(docs, docs).collect()
    counts = Counter(w for _, t, _ in ODD_TEXTS for w in language_model.tokens(t or ""))
    assert sorted((r.n_tokens, r.n_known) for r in got) == sorted((len(w), len(w)) for w in (language_model.tokens(t or "") for _, t, _ in ODD_TEXTS))
    assert {r.train_tokens for r in got} == {counts.total()} and all(r.score < 0 for r in got)
    untaught = language_model.language_scores(no_documents(spark).select("doc_id", "text"), docs).collect()
    assert {(r.n_known, r.train_tokens, r.score) for r in untaught} == {(0, 0, 0.0)}
    assert language_model.language_scores(docs, no_documents(spark).select("doc_id", "text")).collect() == []


def small_corpus(spark):
    """Documents of sf0.001 by their number, and a model of them with few words."""
    docs = given(spark, "documents").select("doc_id", "text")
    counts = language_model.word_counts(docs)
    known = language_model.vocabulary(counts, counts.count())
    return docs, counts, known, language_model.learned(docs, known)


def test_model_probabilities_sum_to_one(spark, monkeypatch):
    monkeypatch.setattr(language_model, "HEAD", 300)
    _, counts, known, model = small_corpus(spark)
    n = len(model.classes) - 1
    of, words = model.of[:-1], len(known.share)
    for far, near in ((n, n), (0, n), (3, 1), (n - 1, n - 1)):
        each = 10.0 ** (model.classes[far, near][of] + model.words[near])  # words and buckets
        assert math.isclose(each.sum(), 1, rel_tol=1e-4)
    inside = np.zeros(len(known.sizes))
    for r in counts.collect():
        if bytes(r.word) not in known.ids:
            inside[known.bucket(bytes(r.word))] += r.n + 1
    assert (inside + 1 == known.sizes).all() and words == len(known.ids) + len(inside)


def test_scores_by_brute_force(spark, monkeypatch):
    """Counts by plain loops, the same learning step, and every score word by word; equal for any split of the texts."""
    monkeypatch.setattr(language_model, "HEAD", 300)
    docs, counts, known, model = small_corpus(spark)
    of, n, words, ids = model.of, len(model.classes) - 1, len(known.share), known.ids
    texts = {r.doc_id: [None, None, *language_model.tokens(r.text or "")] for r in docs.collect()}
    number = lambda w: words if w is None else ids[w] if w in ids else len(ids) + known.bucket(w)
    two, one = np.zeros((n + 1, n + 1, n)), np.zeros((n + 1, words))
    for text in texts.values():
        for far, near, word in zip(text, text[1:], text[2:]):
            two[of[number(far)], of[number(near)], of[number(word)]] += 1
            one[of[number(near)], number(word)] += 1
    classes = language_model.fit(two, language_model.CLASS_SIZE, language_model.CLASS_ROUNDS) / math.log(10)
    logs = np.empty_like(one)
    for k in range(n):
        own = np.flatnonzero(of[:-1] == k)
        logs[:, own] = language_model.fit(one[None][:, :, own], language_model.WORD_SIZE, language_model.WORD_ROUNDS)[0] / math.log(10)
    seen = {bytes(r.word): r.n for r in counts.collect()}

    def plain(text):
        total = 0.0
        for far, near, word in zip(text, text[1:], text[2:]):
            w = number(word)
            total += classes[of[number(far)], of[number(near)], of[w]] + logs[of[number(near)], w]
            if word not in ids:
                total += math.log10((seen.get(word, 0) + 1) / known.sizes[known.bucket(word)])
        return total

    for split in (1, 7):
        got = language_model.language_scores(docs.repartition(split), docs).collect()
        assert all(math.isclose(r.score, plain(texts[r.doc_id]), rel_tol=1e-4, abs_tol=1e-3) for r in got)


def test_learning_finds_what_follows(monkeypatch):
    monkeypatch.setattr(language_model, "RATE", 0.05)
    counts = np.zeros((2, 3, 3))
    for far in range(2):
        for near in range(3):
            counts[far, near, near] = 900
            counts[far, near, (near + 1 + far) % 3] = 100
    learned = np.exp(language_model.fit(counts, 8, 800))
    assert np.abs(learned - counts / 1000).max() < 0.06


def test_the_head_is_bounded_when_all_words_are_equally_frequent(spark, monkeypatch):
    monkeypatch.setattr(language_model, "HEAD", 100)
    even = spark.range(1000).selectExpr("cast(cast(id as string) as binary) as word", "3L as n")
    assert 50 < len(language_model._head(even)) < 200


def plain_text(page):
    """Blocks of the article by patterns alone; enough for the given pages."""
    body = re.search(r"<article>(.*?)(?:</article>|<footer>|$)", page or "", re.S)
    blocks = re.split(r"</?(?:p|h1)>", body[1]) if body else []
    blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " " if "<br" in b else "", b)).split()) for b in blocks]
    return "\n".join(b for b in blocks if b)


def test_text_of_the_given_pages(spark):
    pages = given(spark, "pages")
    want = {r.page_id: plain_text(r.html) for r in pages.collect()}
    rows = extract(pages).collect()
    assert {r.page_id: r.text for r in rows} == want and len(rows) == len(want)
    assert all(r.n_chars == len(r.text) for r in rows)


def site(n, menu="Home News About", extra=""):
    return f"<html><body><div><span>{menu}</span></div><div class=x><h2>Title {n}</h2><p>First {n} &amp; more<br>line<p>Second\n  {n}</div>{extra}<div>All rights kept</div></body></html>"


def test_constant_nodes_of_a_host_are_frame(spark):
    pages = [(k, f"http://a.org/{k}", site(k)) for k in range(6)] + [(10, "http://b.org/1", site(1)), (11, None, site(2)), (12, "http://a.org/x", None), (13, "http://a.org/y", "")]
    pages += [(14, "https://u@B.org:80/2", "<main><p>One</p><aside>no</aside><form>no</form><div id=comments>no</div><table><tr><td>a<td>b</table></main><p>out</p>")]
    got = {r.page_id: r.text for r in extract(spark.createDataFrame(pages, "page_id long, url string, html string").withColumn("_main", spark.range(1).select("id").scalar())).collect()}
    assert got[3] == "Title 3\nFirst 3 & more line\nSecond 3"
    assert got[10] == "Home News About\nTitle 1\nFirst 1 & more line\nSecond 1\nAll rights kept"
    assert got[12] == got[13] == "" and got[14] == "One\na\nb"
    assert extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


def test_templates_align_inserted_nodes():
    pages = [shape(parse(site(k, extra="<section>new</section>" if k % 2 else ""))) for k in range(4)]
    template = pages[0]
    for page in pages[1:]:
        template = merged(template, page)
    assert "section" not in main_text(site(9), template) and main_text(site(9, extra="<section>new</section>"), template).endswith("Second 9\nnew")


def test_pipeline_stages_keep_columns_and_repeat_the_operators(spark):
    docs = given(spark, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, docs, SF)
        assert kept.schema == docs.schema, name
        assert 0 < kept.count() <= docs.count()
    good = {r.doc_id for r in QUERIES["op1_quality_classifier"](spark, SF).collect() if r.predicted}
    assert {r.doc_id for r in corpus_pipeline.quality_classifier(spark, docs, SF).collect()} == good
    packed = corpus_pipeline.run(spark, SF)
    assert packed.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"] and packed.count() > 0


def test_folds(spark):
    rows = spark.createDataFrame([(k,) for k in [*range(50), None]], "doc_id long").select("doc_id", fold(7).alias("f")).collect()
    assert all(r.f == (crc(r.doc_id, 7) if r.doc_id is not None else 0) for r in rows)


def induced(pages):
    template = shape(parse(pages[0]))
    for page in pages[1:]:
        template = merged(template, shape(parse(page)))
    return template


def test_constant_boxes_inside_an_article_are_frame():
    page = "<article><h1>Title {0}</h1><p>First of {0}<p>Second of {0}<p>Sign up today</p><div><b>Our</b> offer</div><p>Last of {0}</article>".format
    pages = [page(k) for k in range(40)]
    odd = page(41).replace("<b>Our</b> offer", "A part of this page alone")
    template = induced([*pages, odd])
    assert main_text(page(3), template) == "Title 3\nFirst of 3\nSecond of 3\nLast of 3"
    assert main_text(odd, template).split("\n")[-2:] == ["A part of this page alone", "Last of 41"]
    copies = induced([*["<article><p>The same long text everywhere</p></article>"] * 30, "<article><p>Another</p></article>"])
    assert main_text("<article><p>The same long text everywhere</p></article>", copies) == "The same long text everywhere"


def test_a_small_article_does_not_hide_the_main_text():
    text = "Long main text of the page, in a box of its own. " * 5
    assert text.strip() in main_text(f"<div><p>{text}</p></div><article>Teaser</article>", None)


def test_class_words_alone_drop_no_main_text():
    text = "<h2 id=related-work>Related work</h2><section id=discussion><p>We discuss</section><p id=notice-period>Three months"
    want = "Related work\nWe discuss\nThree months"
    assert main_text(f'<article class="post category-social comments-open">{text}</article>', None) == want
    assert main_text(f'<div class="layout no-sidebar sidebar"><article>{text}</article></div>', None) == want
    assert main_text(f'<div class="widget comments">{text}</div><p>x', None).startswith(want)
    more = '<div class="Ad x">Buy</div><div class=related>See <a href=1>The first</a> <a href=2>The second</a></div><div id=comments>no</div>'
    assert main_text(f"<article>{text}</p>{more}</article>", None) == want


def test_deep_nesting_is_read_whole(spark):
    deep = ["".join(f"<{tag}>{k} " for k in range(5000)) for tag in ("font", "div", "section", "b><div")]
    pages = [(k, "http://deep.org/", f"<p>{k}</p><div>Constant</div>{d}{k}") for k, d in enumerate(deep * 2)] + [(9, "http://deep.org/9", "<p>One</p><div>Constant</div>")]
    got = {r.page_id: r.text.split() for r in extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert all(got[k][1:-1] == [str(n) for n in range(5000)] and got[k][-1] == str(k) for k in range(8)), {k: got[k][:5] for k in range(8)}
    assert got[9] == ["One"]


def test_templates_of_mixed_markup_are_bounded_and_keep_the_frame():
    rng = np.random.default_rng(4)

    def page(k):
        boxes = "".join(f"<div class=box{'abcdefghijklmnopqrstuvwxyz'[a]}{'abcdefghijklmnopqrstuvwxyz'[b]}>Own text {k} {a} {b}</div>" for a, b in rng.integers(0, 26, (12, 2)))
        return f"<div class=top>Our site</div><div class=body>{boxes}<div class=offer>Sign up today</div></div><div class=end>All rights kept</div>"

    def widest(node):
        return max([len(node[3]), *map(widest, node[3])])

    pages = [page(k) for k in range(400)]
    template, seen = shape(parse(pages[0])), []
    for own in pages[1:]:
        template = merged(template, shape(parse(own)))
        seen.append(widest(template))
    assert max(seen) <= 128 + 2 * 16 and max(seen[200:]) <= max(seen[:200])
    for own in pages[:5]:
        text = main_text(own, template)
        assert text.count("Own text") == 12 and not any(t in text for t in ("Our site", "Sign up", "All rights"))


def test_the_frame_below_very_long_articles_is_found():
    def page(k):
        parts = "".join(f"<h2>Part {n} of {k}</h2><p>Text {n} of {k}</p>" for n in range(60 + 40 * (k % 5)))
        return f"<article>{parts}<div class=offer>Sign up today</div></article>"

    template = induced([page(k) for k in range(20)])
    for k in (3, 4, 9):
        text = main_text(page(k), template)
        assert "Sign up" not in text and text.count("\n") == 2 * (60 + 40 * (k % 5)) - 1


def test_comments_adverts_and_side_columns_of_compound_names():
    note = "<div class=note><cite>Ann {0}</cite><time>May {0}</time><p>I think so {0}, and at some length, more than the article.</p></div>".format
    notes = "".join(map(note, range(9)))
    short = "<article><h1>Title</h1><p>Short text.</p>{0}</article>".format
    assert main_text(short("<div class='comment-section'><div class=c><b>Ann</b><p>Nice</p></div></div>"), None) == "Title\nShort text."
    assert main_text(short(f"<section id=commentList><h2>Said</h2>{notes}</section>"), None) == "Title\nShort text."
    assert main_text(short(notes), None) == "Title\nShort text."
    for beside in (f"<section id='user-comments'><h2>Comments</h2>{notes}</section>", f"<div class='reader-notes'>{notes}</div>", "<div class='right-rail'><h3>More</h3><p>A note on other things, at length.</p></div>"):
        assert main_text(short("") + beside, None) == "Title\nShort text."
        assert main_text(f"<div><h1>Title</h1><p>Short text.</p></div>{beside}", None) in ("Title\nShort text.", "Title\nShort text.\nComments")
    assert main_text(short("<div class='ad-slot'><p>Buy this</p></div>"), None) == "Title\nShort text."
    # Names that only say something about comments or adverts, and records of the text itself, stay.
    kept = "<section id=comments-in-python><h2>Comments in Python</h2><p>One<p>Two</section><div class=ad-free>Free</div><section id=ad-hoc><h2>Ad hoc</h2><p>x</section>"
    assert main_text(short(kept), None).endswith("Comments in Python\nOne\nTwo\nFree\nAd hoc\nx")
    turns = "".join(f"<div class=turn><b class=who>Q{k}</b><p>Answer {k}</p></div>" for k in range(3))
    assert main_text(short(turns), None).count("Answer") == 3


def test_regions_are_chosen_by_structure_at_any_length():
    article = "<article><h2>Title</h2><p>Text.</p></article>"
    for more in (1, 1000):
        assert main_text(f"<h1>Site</h1>{article}<div><p>{'Other words. ' * more}</p></div>", None) == "Title\nText."
        assert "Other" in main_text(f"<div><h1>Title</h1><p>{'Other words. ' * more}</p></div><article><h3><a href=1>Next</a></h3><p>Read on</p></article>", None)
        assert "Other" in main_text(f"<div><h1>Title</h1><p>{'Other words. ' * more}</p></div><article><h3>Next</h3><p>Read on</p></article>", None)


def test_constant_openings_stay_and_copies_keep_their_text():
    page = "<div class=logo>Site</div><article><h1>Title {0}</h1><p>The same opening sentence.</p><p>Text {0}</p><p>All rights kept</p></article>".format
    template = induced([page(k) for k in range(20)])
    assert main_text(page(3), template) == "Title 3\nThe same opening sentence.\nText 3"
    bare = "<p>Site</p><h1>Title {0}</h1><p>The same opening sentence.</p><p>Text {0}</p><p>All rights kept</p>".format
    assert main_text(bare(3), induced([bare(k) for k in range(20)])) == "Title 3\nThe same opening sentence.\nText 3"
    copy = "<article><h1>Title {0}</h1><p>A copied text.</p></article>".format
    assert main_text(copy(3), induced([copy(k) for k in range(20)])) == "Title 3\nA copied text."


def test_frame_texts_in_long_runs_are_found():
    def page(k):
        return "<article>" + "".join(f"<p>Text {n} of {k}</p>" for n in range(400)) + "<p>Sign up today</p></article>"

    text = main_text(page(3), induced([page(k) for k in range(40)]))
    assert "Sign up" not in text and text.count("\n") == 399


def test_trees_come_back_from_their_packed_form():
    def flat(node):
        out, todo = [], [node]
        while todo:
            child = todo.pop()
            out.append(child if isinstance(child, str) else (child.tag, child.name, bool(child.frame), bool(child.in_article)))
            todo += [] if isinstance(child, str) else [c for c in child.children if isinstance(c, str) or c.tag not in ("script", "style")]
        return out

    for html in ("", "a\ud800<p class='x y'>\u00e9 &amp; <b>0</b><script>0</script><br></p>0", "<div>" * 3000 + "0"):
        assert flat(unpacked(packed(parse(html)))) == flat(parse(html))
