from __future__ import annotations

import os
import re
import subprocess
import sys
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from shapes import documents, words
from test_language import rows_of_languages
from test_near import brute as near_groups

import corpus_pipeline
from ridelake.llm import pfair
from ridelake.llm.tokens import Encoder, vocabulary_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def raw():
    rows = rows_of_languages(90)
    body = rows[3][1]
    rows += [(200, None, "en", "a"), (201, "", "en", "b"), (202, "123 456 !!", "de", "a"), (203, body, "en", None), (204, body.upper(), "fr", "b")]
    rows += [(300 + i, f"{rows[i][1]} write to person{i}@mail.example.com or call +1 (017) 555-77{i:02d}", rows[i][2], "bc"[i % 2]) for i in range(12)]
    rows += [(400, " ".join([rows[0][1]] * 300), "en", "a"), (401, " ".join(words(1, 3000)) + " the weather", "en", "a")]
    return rows


@pytest.fixture(scope="module")
def stages(spark, raw):
    """What every stage returned, by name, with the raw table first."""
    from ridelake.session import scratch_path

    docs = documents(spark, raw).select(*COLUMNS)
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "pipeline-test")
        stage(spark, docs, "unused").write.parquet(path)
        docs = out[name] = spark.read.parquet(path)
    return out


def test_stages_are_the_ordered_operators(stages):
    assert list(stages) == ["documents", "language ID", "MinHash near-dedup", "PII", "mixing", "packing"]
    assert all(stages[name].columns == COLUMNS for name in list(stages)[:-1])


def test_language_keeps_what_has_letters(stages, raw):
    kept = {r.doc_id: r for r in stages["language ID"].collect()}
    with_letters = {i for i, t, *_ in raw if t and any(c.isalpha() for c in t)}
    assert kept.keys() <= with_letters and len(with_letters - kept.keys()) <= 2
    assert all(kept[i].lang == lang and kept[i].text == text for i, text, lang, _ in raw[:90])


def test_one_of_each_group_stays(stages):
    before = [(r.doc_id, r.text) for r in stages["language ID"].collect()]
    group = near_groups(before, 5, 80)
    assert {r.doc_id for r in stages["MinHash near-dedup"].collect()} == {i for i, (_, c) in group.items() if c == i}


def test_personal_data_is_replaced_and_nothing_else(stages):
    before = {r.doc_id: r for r in stages["MinHash near-dedup"].collect()}
    after = {r.doc_id: r for r in stages["PII"].collect()}
    assert before.keys() == after.keys()
    private = r"person\d+@mail\.example\.com|\+1 \(017\) 555-\d{4}"
    for i, r in before.items():
        assert not re.search(private, after[i].text)
        assert after[i].n_chars == len(after[i].text)
        pattern = re.escape(re.sub(private, "\0", r.text)).replace("\0", r"\S+@\S+|\+1 \(\d{3}\) \d{3}-\d{4}") if re.search(private, r.text) else re.escape(r.text)
        if not re.search(private, r.text):
            assert re.fullmatch(pattern, after[i].text)


def test_mixing_orders_all_rows(spark, stages):
    before, after = stages["PII"], stages["mixing"]
    assert Counter(map(tuple, before.collect())) == Counter(map(tuple, after.collect()))
    place = {r.doc_id: r.place for r in pfair.mix(before).collect()}
    files = after.selectExpr("_metadata.file_name AS f", "doc_id").collect()
    in_files = defaultdict(list)
    for r in files:
        in_files[r.f].append(place[r.doc_id])
    bounds = sorted((min(p), max(p)) for p in in_files.values())
    assert all(a[1] < b[0] for a, b in zip(bounds, bounds[1:]))
    assert all(p == sorted(p) for p in in_files.values())


def test_packing_holds_every_id_once(stages):
    encoder = Encoder(vocabulary_path("byte_bpe_50k.json"), True)
    pieces = defaultdict(list)
    for r in stages["packing"].collect():
        pieces[r.doc_id].append((r.start, r.length, r.ids_crc32))
    texts = {r.doc_id: r.text for r in stages["mixing"].collect()}
    assert pieces.keys() == texts.keys()
    for i, text in texts.items():
        ids = np.array(encoder.tokenizer.encode(text, add_special_tokens=False).ids + [0], "<u4")
        want = [(at, len(ids[at : at + 1024]), zlib.crc32(ids[at : at + 1024].tobytes())) for at in range(0, len(ids), 1024)]
        assert sorted(pieces[i]) == want


def test_packing_follows_the_mixture(spark, monkeypatch):
    """One source has most rows: sequences have its weighted share as long as all sources last, and its own only without mixing."""
    from ridelake.session import scratch_path

    rows = [(i, f"{' '.join(words(i, 20 + i % 37))} .", "en", "hot" if i < 600 else f"s{i % 2}") for i in range(1000)]
    monkeypatch.setattr(corpus_pipeline, "SPAN_ROWS", 100)
    source = {r[0]: r[3] for r in rows}
    docs, stages = documents(spark, rows).select(*COLUMNS), dict(corpus_pipeline.STAGES)

    def packed(mix):
        path = scratch_path(spark, "pipeline-test")
        mix(docs).write.parquet(path)
        out = stages["packing"](spark, spark.read.parquet(path), "unused").collect()
        assert sorted(r.doc_id for r in out if not r.start) == sorted(source)
        used = defaultdict(int)
        for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
            assert r.offset == used[r.sequence_id]
            used[r.sequence_id] += r.length
        assert sorted(used) == list(range(len(used))) and max(used.values()) <= 1024
        early = Counter(source[r.doc_id] for r in out if r.sequence_id < 0.4 * len(used))
        return early["hot"] / early.total(), {r.doc_id: r.sequence_id for r in out}

    def weighted(weights):
        return lambda df: pfair.in_order(pfair.mix(df, weights=weights)).select(*COLUMNS)

    default, a = packed(lambda df: stages["mixing"](spark, df, "unused"))
    even, b = packed(weighted({"hot": 1, "s0": 1, "s1": 1}))
    little, c = packed(weighted({"hot": 0.2, "s0": 0.4, "s1": 0.4}))
    _, without = packed(lambda df: df)
    root = 600**0.5 / (600**0.5 + 2 * 200**0.5)
    assert abs(default - root) < 0.1 and abs(even - 1 / 3) < 0.1 and abs(little - 0.2) < 0.1
    assert a != b and a != c and a != without


def test_packing_numbers_rows_of_any_table(spark, folder):
    from ridelake.llm import packing

    df = spark.range(1000).repartitionByRange(7, "id").sortWithinPartitions("id")
    df.write.parquet(folder)
    for table in (df, spark.read.parquet(folder)):
        assert all(r.id == r.n for r in packing.numbered(table, "n").collect())


def test_an_empty_table_passes_through(spark, folder):
    documents(spark, []).select(*COLUMNS).write.parquet(f"{folder}/documents.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_all_are_registered():
    import __spark_entry__ as entry

    names = entry.queries()
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names
    assert set(entry.oracle_sql()) <= set(names)


def test_the_rest_does_without_this_folder(tmp_path):
    """The entry file with a copy of the package that lacks ``llm``."""
    import shutil

    root = os.path.dirname(os.path.abspath(corpus_pipeline.__file__))
    shutil.copytree(f"{root}/ridelake", tmp_path / "ridelake", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(f"{root}/__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'upsert' in q and not [n for n in q if n.startswith('op1_')]; e.oracle_sql()"
    subprocess.run([sys.executable, "-B", "-c", code], cwd=tmp_path, env={**os.environ, "PYTHONPATH": ""}, check=True)
