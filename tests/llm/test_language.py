from __future__ import annotations

import zlib

import numpy as np
from shapes import documents, hard_rows

from ridelake.llm import langid

SENTENCES = {
    "en": "the weather is nice and we are going to the beach with our friends this morning",
    "de": "das wetter ist schön und wir gehen heute morgen mit unseren freunden an den strand",
    "fr": "il fait beau et nous allons à la plage avec nos amis pendant cette matinée",
}


def rows_of_languages(n):
    out = []
    for i in range(n):
        lang = list(SENTENCES)[i % 3]
        own = SENTENCES[lang].split()
        out.append((i, " ".join(own[(i + k * 5) % len(own)] for k in range(12)), lang, "a"))
    return out


def test_learns_and_keeps_to_the_fold(spark):
    rows = rows_of_languages(300) + [(1000, None, "en", "a"), (1001, "123 !!", "en", "a"), (1002, "", None, "a"), (None, "the beach", "xx", "a")]
    df = documents(spark, rows)
    out = {r.doc_id: r for r in langid.train_and_identify(df, bits=12).collect()}
    assert len(out) == len(rows)
    for i, text, lang, _ in rows:
        assert out[i].held_out == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0)
        if i is not None and i < 1000:
            assert out[i].lang_pred == lang and 0.4 < out[i].score <= 1
    assert [(out[i].lang_pred, out[i].score) for i in (1000, 1001, 1002)] == [("und", 0.0)] * 3
    assert out[None].lang_pred == "en"  # learned from rows with an id only, so xx is unknown


def test_held_out_labels_change_nothing(spark):
    rows = rows_of_languages(150)
    lie = [(i, t, "de" if zlib.crc32(str(i).encode()) % 5 == 0 else c, s) for i, t, c, s in rows]
    a, b = (sorted((r.doc_id, r.lang_pred, r.score) for r in langid.train_and_identify(documents(spark, x), bits=12).collect()) for x in (rows, lie))
    assert a == b


def test_weights_are_sparse_and_temperature_fits():
    random = np.random.default_rng(0)
    rows = []
    for i in range(600):
        c = i % 2
        at = np.sort(random.choice(np.arange(2, 200), 10, replace=False))
        at[0] = c if random.random() < 0.95 else 1 - c
        rows.append((at, np.full(10, 10**-0.5), c))
    w = langid.fit_weights(rows, 2, 200, epochs=3, alpha=0.5, beta=1.0, l1=1.0, l2=0.001)
    assert w[0, 0] > 0 > w[0, 1] and (w[:, 2:200] == 0).mean() > 0.5
    scores = np.array([w[:, a] @ x + w[:, 200] for a, x, _ in rows])
    own = np.array([c for *_, c in rows])
    t = langid.fit_temperature(scores * 10, own)
    assert abs(t / langid.fit_temperature(scores, own) - 10) < 1
    assert langid.fit_temperature(scores[:0], own[:0]) == 1.0


def test_hard_rows(spark):
    df = documents(spark, hard_rows())
    out = langid.train_and_identify(df, bits=10)
    assert out.count() == df.count()
    assert out.where("lang_pred = 'und' AND score <> 0").count() == 0


def test_no_labels_and_no_rows(spark):
    unlabelled = documents(spark, [(1, "some text", None, "a"), (2, None, None, "a")])
    assert {(r.lang_pred, r.score) for r in langid.train_and_identify(unlabelled, bits=10).collect()} == {("und", 0.0)}
    assert langid.train_and_identify(documents(spark, []), bits=10).count() == 0


def test_registered_query_is_accurate_on_the_held_out_fold(spark):
    from ridelake.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    held = [r for r in QUERIES["op8_ftrl_language"](spark, folder).collect() if r.held_out and truth[r.doc_id]]
    assert held and np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.97


def test_a_filter_on_the_answer_asks_once(spark):
    model = langid.Model(["en", "de"], np.zeros((2, 1 << 10)), np.zeros(2), np.ones(1 << 10), 1.0, 10)
    rows = documents(spark, [(1, "some text", "en", "a"), (2, None, "en", "a"), (3, "1", "en", "a")])
    kept = langid.identify(rows, model).where("lang_pred <> 'und' AND score >= 0.3")
    assert [(r.doc_id, r.lang_pred) for r in kept.collect()] == [(1, "en")]
    assert kept._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
