from __future__ import annotations

import math
import random
import zlib

import numpy as np
import pytest
import zstandard
from shapes import documents, hard_rows

from ridelake.llm import compression

LABELS = "doc_id long, quality int, toxic int, score string, held_out string, n string"


def labels(spark, rows):
    return spark.createDataFrame([(i, q, None, None, None, None) for i, q in rows], LABELS)


def texts(n, seed=1):
    """Good texts are sentences of one vocabulary, bad ones tables of another with the same letters."""
    random_ = random.Random(seed)
    good = ["".join(random_.choice("abcdefgh") for _ in range(6)) for _ in range(80)]
    rows, known = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = [random_.choice(good) for _ in range(random_.randrange(20, 200))]
        rows.append((i, (" | " if bad else " ").join(w.upper() if bad else w for w in words), "en", "a"))
        known.append((i, int(not bad)))
    return rows, known


def test_scores_are_those_of_the_method(spark):
    """A plain loop over the model's dictionaries gives the same scores; held-out rows are told apart."""
    rows, known = texts(400)
    df, marks = documents(spark, rows), labels(spark, known)
    model = compression.train(df, marks, learnable=~compression.held_out(), piece_bytes=256)
    out = {r.doc_id: r for r in compression.score(df, model).collect()}
    pair = [zstandard.ZstdCompressor(3, dict_data=zstandard.ZstdCompressionDict(d), write_checksum=False, write_content_size=False, write_dict_id=False) for d in (model.good, model.bad)]
    for i, text, *_ in rows:
        raw = text.encode()
        cuts = [raw[at : at + 256] for at in range(0, len(raw), 256)]
        g, b = (sum(len(c.compress(p)) for p in cuts) for c in pair)
        assert out[i].score == pytest.approx(1 / (1 + math.exp(-(model.slope * (b - g) / len(raw) + model.intercept))), abs=0.02)
        assert out[i].predicted == int(out[i].score >= 0.5)
    held = [i for i, _ in known if zlib.crc32(str(i).encode()) % 3 == 1]
    assert np.mean([out[i].predicted == q for i, q in known if i in held]) > 0.97


def test_held_out_labels_teach_nothing(spark):
    rows, known = texts(300)
    lie = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q) for i, q in known]
    a, b = (sorted(map(tuple, compression.train_and_score(documents(spark, rows), labels(spark, x)).select("doc_id", "held_out", "score").collect())) for x in (known, lie))
    assert a == b
    assert all(h == (zlib.crc32(str(i).encode()) % 3 == 1) for i, h, _ in a)


def test_odd_labels_and_hard_rows(spark):
    rows, known = texts(200)
    base = hard_rows() + [(1000 + i, *r) for i, *r in rows]
    marks = [(1000 + i, q) for i, q in known] + [(None, 1), (1001, None), (1002, 7), (999_999, 0), (1003, 0), (1003, 1), (1003, 1), (1, 1), (2, 0)]
    out = compression.train_and_score(documents(spark, base), labels(spark, marks))
    assert out.count() == len(base)
    assert out.where("score IS NULL OR score < 0 OR score > 1 OR predicted IS NULL").count() == 0
    assert out.where("doc_id IS NULL AND held_out").count() == 0
    same = out.where("text IS NULL OR text = ''").select("score").distinct().count()
    assert same == 1


@pytest.mark.parametrize("known, share", [([], 0.5), ([(i, 1) for i in range(50)], None), ([(i, 0) for i in range(50)], None)])
def test_one_label_or_none(spark, known, share):
    rows, _ = texts(50)
    scores = {r.score for r in compression.train_and_score(documents(spark, rows), labels(spark, known)).collect()}
    assert len(scores) == 1
    if share is None:
        share = 1 - 1 / (2 + sum(zlib.crc32(str(i).encode()) % 3 != 1 for i, _ in known))
        share = share if known[0][1] else 1 - share
    assert scores.pop() == pytest.approx(share)


def test_no_rows(spark):
    assert compression.train_and_score(documents(spark, []), labels(spark, [])).count() == 0


def test_curve_finds_its_parameters():
    random_ = np.random.default_rng(2)
    x = random_.normal(size=20_000) * 0.01
    label = (random_.random(20_000) < 1 / (1 + np.exp(-(300 * x + 1)))).astype(int)
    slope, intercept = compression.fit_curve(x, label, np.ones(len(x)), 0.5)
    assert abs(slope - 300) < 15 and abs(intercept - 1) < 0.1
    # Half of one label left out and weighted twice is the same curve.
    keep = (label == 0) | (np.arange(len(x)) % 2 == 0)
    again = compression.fit_curve(x[keep], label[keep], np.where(label[keep] == 1, 2.0, 1.0), 0.5)
    assert abs(again[0] - 300) < 20 and abs(again[1] - 1) < 0.1
    apart = compression.fit_curve(np.array([-1.0, -1.0, 1.0, 1.0]), np.array([0, 0, 1, 1]), np.ones(4), 0.5)
    assert 0 < apart[0] < 50
    assert compression.fit_curve(x, 1 - label, np.ones(len(x)), 0.3)[0] == 0.0


def test_registered_query_on_the_held_out_fold(spark):
    from ridelake.llm.queries import QUERIES

    folder = "/root/testdata/sf0.01"
    truth = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    held = [r for r in QUERIES["op12_dictionary_quality"](spark, folder).collect() if r.held_out and r.doc_id in truth]
    assert held and np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.95
