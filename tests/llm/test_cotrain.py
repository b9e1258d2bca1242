import numpy as np

from fieldbook.llm import cotrain
from tests.llm.conftest import ODD


def test_the_table_is_told_apart(table):
    docs, labels, pages = (table(name) for name in ("documents", "labels", "pages"))
    model = cotrain.fit(docs, labels, pages)
    rows = {r.doc_id: r for r in cotrain.score(docs, pages, model).collect()}
    truth = {r.doc_id: r.quality for r in labels.where("quality is not null").collect()}
    assert len(rows) == docs.count()
    assert np.mean([rows[i].keep == (q == 1) for i, q in truth.items()]) > 0.93
    assert all(rows[i].keep for i, q in truth.items() if q == 1)


def views(n, seed=4):
    make = np.random.default_rng(seed)
    y = make.integers(0, 2, n)
    text = np.stack([np.ones(n), y * 4 - 2 + make.normal(size=n)], 1)
    meta = np.stack([np.ones(n), y * 4 - 2 + make.normal(size=n), make.normal(size=n)], 1)
    return [text, meta], y


def test_views_teach_each_other():
    both, y = views(4000)
    label = np.where(np.arange(4000) < 200, y, -1)
    held = np.arange(4000) % 2 == 0
    model = cotrain.learn(both, label, held)
    assert model.passed_on and all(n > 0 for n in model.passed_on[0])
    score = model.score(both[0] @ model.text, both[1] @ model.meta)
    assert np.mean((score >= 0.5) == y) > 0.99


def test_a_view_of_noise_passes_nothing_on():
    both, y = views(4000)
    both[1][:, 1] = np.random.default_rng(1).normal(size=4000)
    model = cotrain.learn(both, np.where(np.arange(4000) < 400, y, -1), np.arange(4000) % 2 == 0)
    assert all(told[1] == 0 for told in model.passed_on)
    assert np.mean((model.score(both[0] @ model.text, both[1] @ model.meta) >= 0.5) == y) > 0.95


def test_page_facts(spark):
    urls = ["https://a.example.com/en/17?x=1", "http://a.example.com/en/17/", "https://b.example.org/5.html", "nothing", None, "http://c.example.net/fr/8#top"]
    rows = cotrain.page_facts(spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], "page_id long, url string, html string")).collect()
    assert {r.page_of: (r.pages, r.host, r.form) for r in rows} == {
        17: (2, "a.example.com", "folder"), 5: (1, "b.example.org", "html"), 8: (1, "c.example.net", "fragment")}


def test_odd_rows_and_no_labels(docs, table):
    frame, pages = docs(ODD), table("pages")
    model = cotrain.fit(table("documents"), table("labels"), pages)
    told = cotrain.score(frame, pages, model)
    assert told.columns == ["doc_id", "text_score", "meta_score", "score", "keep"] and told.count() == len(ODD)
    assert all(0 <= r.score <= 1 for r in told.collect())
    bare = cotrain.fit(frame, table("labels").limit(0), pages)
    assert {r.score for r in cotrain.score(frame, pages.limit(0), bare).collect()} == {0.5}
    empty = cotrain.fit(frame.limit(0), table("labels"), pages)
    assert cotrain.score(frame.limit(0), pages, empty).count() == 0
