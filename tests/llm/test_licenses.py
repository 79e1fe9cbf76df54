import re

import numpy as np
import pytest

from layerspark.llm import licenses

PLANTED = {
    "apache": r"Licensed under the Apache License, Version 2\.0\.",
    "mit": r"Released under the MIT License\.",
    "gpl": r"licensed under the GNU General Public License",
    "cc-by-nc": r"Licensed under CC BY-NC 4\.0\.",
    "reserved": r"All rights reserved\.",
}


@pytest.fixture(scope="module")
def model(docs):
    return licenses.fit(docs)


def test_planted_lines(docs, model):
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in licenses.scan(docs, model=model).collect():
        text = texts[r.doc_id]
        assert r.licences.split(",") == (sorted(f for f, p in PLANTED.items() if re.search(p, text, re.I)) or [""])
        for span in filter(None, r.found.split(",")):
            family, a, b = span.rsplit(":", 2)
            assert family == "unknown" or re.search(PLANTED[family], text[int(a) : int(b)], re.I)


def test_held_out_accuracy(docs, model):
    """Fresh variants of the templates, and lines that are no licence."""
    rng = np.random.default_rng(99)
    plain = [x for r in docs.limit(50).collect() for x in r.text.split("\n") if len(x) > 20]
    plain = [x for x in plain if all(licenses.resemblance(x, f) < 0.1 for f in licenses.TEMPLATES)]
    right = total = 0
    for family, templates in licenses.TEMPLATES.items():
        for t in templates:
            for _ in range(5):
                got = model.classify(licenses._variant(t, plain, rng))[0]
                right, total = right + (got == family), total + 1
                assert got in (family, "unknown", "none")
    assert right / total > 0.8
    assert sum(model.classify(x)[0] != "none" for x in plain) / len(plain) < 0.01
    assert all(model.classify(x)[0] == "none" for x in licenses.HARMLESS)


def test_unknown_licences_are_not_named(model):
    assert model.classify("Licensed under the Foo Bar License version 7.")[0] == "unknown"
    assert model.classify("Licensed under the Apache License, Version 2.0.")[0] == "apache"


def test_odd_documents(odd_docs, no_docs, clashing, model):
    got = licenses.scan(odd_docs, model=model).collect()
    assert len(got) == odd_docs.count() and {r.licences for r in got} == {""}
    assert {r.n_paragraphs for r in got if r.doc_id in (1, 2, 3)} == {0}
    assert licenses.scan(clashing, model=model).columns[0] == "doc_id"
    assert licenses.scan(no_docs, model=model).count() == 0
    assert licenses.train([]).classify("Released under the MIT License.")[0] == "mit"
