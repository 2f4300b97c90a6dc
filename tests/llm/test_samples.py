"""What the fitted operators learn from."""

import numpy as np

from snapledger.llm import decontam, html, langid, linecrf

from .frames import documents, prose, sf


def test_quality_is_learned_from_long_texts(spark):
    """All labelled texts are longer than a sample of one may be."""
    good = "\n".join(prose(k, 12) for k in range(200))
    bad = "\n".join("#$% BUY !!! 100% *** " + str(k) * 9 for k in range(300))
    assert min(map(len, (good, bad))) > linecrf.SAMPLE_BYTES
    df = documents(spark, [(k, (bad, good)[k % 2] + f"\n{prose(k, 10)}") for k in range(12)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(12)], "doc_id long, quality int")
    rows = linecrf.score(df, linecrf.learn(df, labels)).collect()
    assert all((r.score >= 0.5) == r.doc_id % 2 for r in rows)


def test_runs_of_lines_reach_every_line():
    rng = np.random.default_rng(1)
    length = rng.integers(1, 90, 400).astype(float)
    length[7] = 9_000
    seen = np.zeros(400, dtype=bool)
    for code in rng.integers(-(1 << 63), 1 << 63, 3_000):
        cut = linecrf.run_of(length, int(code), 900)
        assert cut.stop > cut.start
        assert length[cut].sum() <= 900 or cut.stop == cut.start + 1
        seen[cut] = True
    assert seen.all()
    assert linecrf.run_of(length, 5, 10**6) == slice(0, 400)


def test_many_short_lines_are_bounded(spark):
    df = documents(spark, [(k, ("a\n" if k % 2 else "$ $ $\n") * 6000) for k in range(40)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, quality int")
    seen = []
    whole = linecrf.fit_lines
    try:
        linecrf.fit_lines = lambda found, marks: (seen.append(len(found.length)), whole(found, marks))[1]
        model = linecrf.learn(df, labels)
    finally:
        linecrf.fit_lines = whole
    assert seen[0] <= 40 * linecrf.SAMPLE_LINES
    assert all((r.score >= 0.5) == r.doc_id % 2 for r in linecrf.score(df, model).collect())


def test_every_sampled_document_is_in_the_dictionary(spark):
    """400 documents longer than their share, each of a word of its own."""
    name = lambda k: "".join(chr(97 + int(c)) for c in f"{k:04d}") * 2
    df = spark.createDataFrame([(k, f"{name(k)} " * 400, "xx") for k in range(langid.SAMPLE)],
                               "doc_id long, text string, lang string")
    data = langid.learn(df)["xx"]
    assert len(data) <= langid.DICTIONARY
    assert all(name(k).encode() in data for k in range(langid.SAMPLE))


def test_language_is_that_of_the_smallest_output(spark):
    """Every document against plain calls of the library, one for each language and block."""
    import zstandard
    docs = sf(spark)
    data = langid.learn(docs)
    found = {r.doc_id: r for r in langid.identify(docs, docs).collect()}
    checked = 0
    for r in docs.collect():
        if not r.text or not any(c.isalpha() for c in r.text):
            assert found[r.doc_id].lang_pred == "und"
            continue
        raw, sizes = langid.normal(r.text), {}
        for lang, content in data.items():
            book = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            sizes[lang] = sum(len(zstandard.ZstdCompressor(
                dict_data=book, level=langid.LEVEL, write_content_size=False).compress(
                raw[k:k + langid.BLOCK])) for k in range(0, len(raw), langid.BLOCK))
        order = sorted(sizes, key=lambda k: (sizes[k], k))
        assert found[r.doc_id].lang_pred == order[0]
        score = 1 - sizes[order[0]] / sizes[order[1]]
        assert abs(found[r.doc_id].score - score) < 1e-12
        checked += 1
    assert checked > 100


def test_ends_of_long_texts_are_learned(spark):
    df = spark.createDataFrame([(k, "a " * 3000 + "zebra " * 3000, "xx") for k in range(60)],
                               "doc_id long, text string, lang string")
    data = langid.learn(df)["xx"]
    assert b"zebra zebra" in data and b"a a a" in data
    short = spark.createDataFrame([(1, "one", "xx"), (2, "word " * 5, "xx")],
                                  "doc_id long, text string, lang string")
    assert sorted(langid.learn(short)["xx"].split()) == [b"one"] + [b"word"] * 5


def test_pages_are_learned_whole(spark):
    """Articles that begin after 20,000 characters, followed by comments."""
    page = ("<html><head><title>t</title></head><body><div>" + "<p>menu</p>" * 3000 + "</div><article><p>"
            + prose(4, 80) + "</p></article><div class='comments'><p>" + prose(5, 60) + "</p></div></body></html>")
    pages = spark.createDataFrame([(k, "u", page) for k in range(4)], "page_id long, url string, html string")
    prior, model = html.fit([]), html.learn(pages)
    assert not np.allclose(model.weight, prior.weight)
    whole = html.fit([page] * 4)
    assert np.allclose(model.weight, whole.weight) and np.allclose(model.coupling, whole.coupling)


def test_an_id_shared_by_many_rows_sends_one_text(spark, monkeypatch):
    """Every text and every page has the same id."""
    n = 40
    df = spark.createDataFrame([(1, prose(k), "xx") for k in range(n)],
                               "doc_id long, text string, lang string")
    assert sum(langid.normal(prose(k)) in langid.learn(df)["xx"] for k in range(n)) == 1
    taken = []
    monkeypatch.setattr(linecrf, "fit_lines", lambda found, labels: taken.append(labels))
    linecrf.learn(df, spark.createDataFrame([(1, 1)], "doc_id long, quality int"))
    monkeypatch.setattr(html, "fit_trees", lambda known: taken.append(known))
    html.learn(spark.createDataFrame([(1, f"<article>{prose(k)}</article>") for k in range(n)],
                                     "page_id long, html string"))
    assert [len(x) for x in taken] == [1, 1]


def test_repeated_items_stay_in_a_block(spark, monkeypatch):
    """An item that a third of the benchmark's rows repeat counts once."""
    sizes = []
    scanner = decontam._scanner
    monkeypatch.setattr(decontam, "_scanner", lambda blocks, *rest: sizes.extend(
        [len(t) for _, t in block.value] for block in blocks) or scanner(blocks, *rest))
    items = spark.createDataFrame([(0, prose(0))] * 30 + [(k, prose(k)) for k in range(1, 61)],
                                  "item_id long, text string")
    docs = documents(spark, [(1, prose(0)), (2, "none of them")])
    found = decontam.find_passages(docs, items, block_bytes=len(prose(0)) * 10).collect()
    assert sum(map(len, sizes)) == 61
    assert {r.doc_id: "0" in r["items"] for r in found} == {1: True, 2: False}
