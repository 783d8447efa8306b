from __future__ import annotations

import random
import zlib
from collections import Counter, defaultdict
from itertools import product

import numpy as np
import pytest
from shapes import documents, hard_rows

from ridelake.llm import packing, wavelet
from ridelake.llm.queries import QUERIES
from ridelake.llm.tokens import Encoder, vocabulary_path

VOCABULARIES = {"word_bpe_49k.json": False, "byte_bpe_50k.json": True}


@pytest.mark.parametrize("name", VOCABULARIES)
def test_remembered_pieces_encode_like_whole_texts(name):
    encoder, random_ = Encoder(vocabulary_path(name), VOCABULARIES[name], limit=300), random.Random(1)
    letters = " \n\t\r'sdtABé́!1,.<|>\x1f\xa0 İΣς日"
    texts = ["".join(random_.choice(letters) for _ in range(40)) for _ in range(1500)]
    texts += ["<|endoftext|> a<|endoftext|>b", " lead", "trail  ", "\n", "", "it's  we'LL don 't"]
    for text in texts:
        assert encoder.encode(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.encode(None).tolist() == []


def expected(rows, name, end):
    encoder = Encoder(vocabulary_path(name), VOCABULARIES[name])
    return [(i, np.array(encoder.tokenizer.encode(t or "", add_special_tokens=False).ids + [end], "<u4")) for i, t, *_ in rows]


# Wavelet matrices


@pytest.mark.parametrize("n,top", [(0, 1), (1, 5), (1000, 3), (200_000, 49_407)])
def test_wavelet_file_answers(n, top):
    ids = np.random.default_rng(n).integers(0, top + 1, n).astype(np.uint16)
    data = wavelet.matrix_bytes(ids, 16, np.arange(1), np.array([n]))
    file = wavelet.WaveletFile(lambda o, s: data[o : o + s])
    assert (file.decode() == ids).all()
    random_ = random.Random(n)
    for _ in range(20 if n else 0):
        i, a, b = (random_.randrange(n) for _ in range(3))
        token = int(ids[i])
        assert file.access(i) == token
        assert file.count(token, min(a, b), max(a, b)) == int((ids[min(a, b) : max(a, b)] == token).sum())
        places = np.flatnonzero(ids == token)
        k = random_.randrange(len(places))
        assert file.select(token, k) == places[k] and file.select(token, len(places)) is None
    assert file.count(65_535, 0, n) == int((ids == 65_535).sum()) and file.select(70_000, 0) is None


def test_shards_round_trip(spark, folder):
    rows = hard_rows()
    shards = wavelet.write_shards(documents(spark, rows), folder, path=vocabulary_path("word_bpe_49k.json"), shard_bytes=20_000)
    assert shards.count() > 3
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in wavelet.read_shards(shards).collect())
    want = expected(rows, "word_bpe_49k.json", 1)
    assert Counter((i, n, c) for _, i, n, c in got) == Counter((i, len(x), zlib.crc32(x.tobytes())) for i, x in want)
    at = 0
    for start, _, n, _ in got:
        assert start == at
        at += n
    ids = [i for _, i, _, _ in got]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    ends = wavelet.occurrences(shards, 1).collect()
    assert len(ends) == sum(int((x == 1).sum()) for _, x in want)
    assert {s + n - 1 for s, _, n, _ in got} <= {r.place for r in ends}


def test_no_rows(spark, folder):
    path = vocabulary_path("word_bpe_49k.json")
    assert wavelet.read_shards(wavelet.write_shards(documents(spark, []), folder, path=path)).count() == 0
    assert packing.pack(documents(spark, []), path=path, keeps_space=False).count() == 0


def test_registered_wavelet_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect())
    got = sorted(tuple(r) for r in QUERIES["op6_wavelet_matrix"](spark, folder).select("doc_id", "start", "n_tokens", "ids_crc32").collect())
    at, want = 0, []
    for i, x in expected(rows, "word_bpe_49k.json", 1):
        want.append((i, at, len(x), zlib.crc32(x.tobytes())))
        at += len(x)
    assert got == want


# Packing


def test_fullest_against_all_choices():
    random_ = random.Random(2)
    for _ in range(200):
        counts = {random_.randrange(1, 30): random_.randrange(1, 4) for _ in range(4)}
        capacity = random_.randrange(0, 60)
        sums = [sum(k * n for k, n in zip(counts, some)) for some in product(*[range(c + 1) for c in counts.values()])]
        chosen = packing.fullest(counts, capacity)
        assert sum(k * n for k, n in chosen.items()) == max(s for s in sums if s <= capacity)
        assert all(n <= counts[k] for k, n in chosen.items())


def test_plan_places_every_piece_once():
    random_ = random.Random(3)
    counts = {k: random_.randrange(1, 200 // k + 2) for k in range(1, 65)}
    tables, windows = packing.plan(counts, 64), defaultdict(list)
    for size, n in counts.items():
        for s, o in zip(*packing.place(tables[size], size, np.arange(n))):
            windows[int(s)].append((int(o), size))
    assert sorted(windows) == list(range(len(windows)))
    for held in windows.values():
        at = 0
        for offset, size in sorted(held):
            assert offset == at
            at += size
        assert at <= 64
    total = sum(k * n for k, n in counts.items())
    assert len(windows) <= -(-total // 64) + 3


def check_packed(rows, packed, end):
    ids = defaultdict(list)
    for i, x in expected(rows, "byte_bpe_50k.json", end):
        ids[i].append(x)
    got, windows = defaultdict(list), defaultdict(list)
    for r in packed:
        got[r.doc_id].append((r.start, r.length, r.doc_tokens, r.ids_crc32))
        windows[r.sequence_id].append((r.offset, r.length))
    for i, each in ids.items():
        want = [(at, len(x[at : at + 1024]), len(x), zlib.crc32(x[at : at + 1024].tobytes())) for x in each for at in range(0, len(x), 1024)]
        assert sorted(got[i]) == sorted(want)
    assert got.keys() == ids.keys() and sorted(windows) == list(range(len(windows)))
    for held in windows.values():
        at = 0
        for offset, size in sorted(held):
            assert offset == at
            at += size
        assert at <= 1024


def test_hard_rows_packed(spark):
    rows = hard_rows()
    packed = packing.pack(documents(spark, rows), path=vocabulary_path("byte_bpe_50k.json"), cell_rows=7)
    check_packed(rows, packed.collect(), 0)
    whole = packing.sequences(packed, pad_id=9).collect()
    assert all(len(r.ids) == packing.padded_length(r.used) and set(r.ids[r.used :]) <= {9} for r in whole)
    assert sum(r.used for r in whole) == sum(len(x) for _, x in expected(rows, "byte_bpe_50k.json", 0))


def test_registered_packing_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    check_packed(rows, QUERIES["op7_minimum_bin_slack"](spark, folder).collect(), 0)


@pytest.mark.parametrize("name, keeps_space", [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_texts_with_added_tokens_are_encoded_as_the_library_does(name, keeps_space):
    encoder = Encoder(vocabulary_path(name), keeps_space)
    added = [t.content for t in encoder.tokenizer.get_added_tokens_decoder().values()]
    random_ = random.Random(6)
    parts = [*added[:3], "\n", "\n\n", " ", "word", "The", ".", "<", "|"]
    for _ in range(400):
        text = "".join(random_.choice(parts) for _ in range(random_.randrange(1, 8)))
        assert encoder.encode(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids, text


def test_packing_in_order_whatever_columns_are_called(spark, folder):
    rows = [(i, "some words " * (i + 1)) for i in range(30)]
    plain = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = sorted(map(tuple, packing.pack_in_order(plain, path=vocabulary_path("byte_bpe_50k.json")).drop("ids").collect()))
    clashing = plain.selectExpr("*", "1 AS _metadata", "2 AS _file", "3 AS _row", "4 AS _n", "5 AS _base", "6 AS _at", "7 AS _span", "8 AS length", "9 AS ids")
    clashing.write.parquet(folder)
    for df in (clashing, spark.read.parquet(folder)):
        got = packing.pack_in_order(df, path=vocabulary_path("byte_bpe_50k.json")).drop("ids")
        assert sorted(map(tuple, got.collect())) == want


@pytest.mark.parametrize("name", VOCABULARIES)
def test_texts_encoded_together_are_as_each_by_itself(name):
    keeps_space, random_ = VOCABULARIES[name], random.Random(8)
    some = ["the", "The", "LES", "élan", "Éluard", "İt", "Ɓa", "ȺB", "é", "H̱", "日本", "x2", "37", "½", "'s", "'LL", "it's", "don't.", "a.", "b,", "§", "×", "µª"]
    some += ["%%%", "...", "|", "!.", ".\n", "\n", "\nThe", "\n'd", "\x00", "<|StartOfText|>", "<|EndOfText|>§", "<|endoftext|>", "\x85", "  ", "\n\n", "\t"]
    texts = [None, "", " ", "\n", *[random_.choice(("", " ")).join(random_.choices(some, k=random_.randrange(1, 12))) for _ in range(3000)]]
    texts += [" ".join(random_.choices(some[:24], k=30)) for _ in range(500)]
    encoder = Encoder(vocabulary_path(name), keeps_space, limit=100, together=2_000)
    for text, ids in zip(texts, encoder.encode_all(texts), strict=True):
        assert ids.tolist() == encoder.tokenizer.encode(text or "", add_special_tokens=False).ids, text


@pytest.mark.parametrize("name", VOCABULARIES)
def test_a_piece_of_many_texts_is_learned_once(name, monkeypatch):
    encoder = Encoder(vocabulary_path(name), VOCABULARIES[name], limit=200)
    texts = [" ".join(f"{x}{y}" for x in "abcdefghij" for y in "klmnopqrstuvwxyz") + "%%%" for _ in range(50)]
    told, plain = [], encoder._plain
    monkeypatch.setattr(encoder, "_plain", lambda asked: told.extend(asked) or plain(asked))
    list(encoder.encode_all(texts) if hasattr(encoder, "encode_all") else map(encoder.encode, texts))
    assert len(told) == 0
    assert len(encoder.known) + len(encoder.older) <= 400


@pytest.mark.parametrize("name", VOCABULARIES)
def test_signs_behind_words_make_no_new_pieces(name):
    encoder = Encoder(vocabulary_path(name), VOCABULARIES[name])
    words, signs = [f"{x}{y}" for x in "abcdefghij" for y in "klmnopqrst"], [".", ",", "...", "!?", ")", ":7", "-x"]
    text = " ".join(word + sign for word in words for sign in signs)
    assert encoder.encode(text).tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert len(encoder.known) + len(encoder.older) < 200
