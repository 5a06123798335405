"""Registered text queries against their check SQL, or against brute force."""

import zlib

import duckdb
import numpy as np
import pytest

from basketlens.llm.check_sql import CHECK_SQL
from basketlens.llm.queries import QUERIES, vocabulary
from compare import difference, open_tables


@pytest.fixture(scope="module")
def con(folder):
    return open_tables(folder)


@pytest.fixture(scope="module")
def texts(folder):
    return duckdb.sql(
        f"SELECT doc_id, text, source, lang FROM '{folder}/documents.parquet' ORDER BY doc_id"
    ).fetchall()


@pytest.fixture(scope="module")
def library_ids(texts):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(vocabulary("word_bpe_49k.json"))
    found = library.encode_batch([t or "" for _, t, _, _ in texts], add_special_tokens=False)
    return [e.ids for e in found]


def rows_of(spark, folder, name):
    return sorted(map(tuple, QUERIES[name](spark, folder).collect()))


@pytest.mark.parametrize("name", sorted(CHECK_SQL))
def test_query_matches_sql(spark, folder, con, name):
    assert difference(QUERIES[name](spark, folder), con, CHECK_SQL[name]) is None


def test_one_query_per_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_token_files_match_the_library(spark, folder, texts, library_ids):
    expected, before = [], 0
    for (doc_id, *_), ids in zip(texts, library_ids):
        ids = np.array([*ids, 2], "<u4")
        expected.append((doc_id, before, len(ids), zlib.crc32(ids.tobytes())))
        before += len(ids)
    assert rows_of(spark, folder, "op2_token_files") == expected


def test_token_counts_match_the_library(spark, folder, texts, library_ids):
    expected = [
        (doc_id, len((text or "").encode()), len(ids), len(ids) > 2048)
        for (doc_id, text, *_), ids in zip(texts, library_ids)
    ]
    assert rows_of(spark, folder, "op6_token_counts") == expected


def test_languages_are_learned(spark, folder, texts):
    lang = {doc_id: label for doc_id, _, _, label in texts}
    held = []
    for doc_id, held_out, pred, score, _ in rows_of(spark, folder, "op1_language_id"):
        assert held_out == (zlib.crc32(str(doc_id).encode()) % 4 == 2)
        assert 0.0 <= score <= 1.0
        if held_out and lang[doc_id] is not None:
            held.append(pred == lang[doc_id])
    assert len(held) > 20 and np.mean(held) > 0.97


def test_mix_is_near_its_targets(spark, folder, texts):
    source = {doc_id: s for doc_id, _, s, _ in texts}
    rows = rows_of(spark, folder, "op8_source_mix")
    assert rows == rows_of(spark, folder, "op8_source_mix")
    words = {doc_id: len((text or "").encode().split()) for doc_id, text, _, _ in texts}
    assert {doc_id: size for doc_id, size, *_ in rows} == words
    # Targets by raising the common level until they add up.
    sizes = {}
    for doc_id, s in source.items():
        sizes[s] = sizes.get(s, 0) + words[doc_id]
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    full: set = set()
    while True:
        rest = 1.5 * sum(sizes.values()) - sum(2 * sizes[s] for s in full)
        level = rest / sum(weight[s] for s in names if s not in full)
        over = {s for s in names if s not in full and weight[s] * level > 2 * sizes[s]}
        if not over:
            break
        full |= over
    target = {s: 2 * sizes[s] if s in full else weight[s] * level for s in names}
    taken = dict.fromkeys(names, 0)
    largest = dict.fromkeys(names, 0)
    for doc_id, size, source_size, aim, took in rows:
        s = source[doc_id]
        assert source_size == sizes[s] and aim == pytest.approx(target[s])
        assert took in (0, size, 2 * size)
        taken[s] += took
        largest[s] = max(largest[s], size)
    for s in names:
        assert abs(taken[s] - target[s]) <= largest[s] + 1


def test_shards_follow_the_rows_law(spark, folder, texts):
    size = {d: len((t or "").encode()) + 1 for d, t, _, _ in texts}
    crc = {d: zlib.crc32((t or "").encode()) for d, t, _, _ in texts}
    slots, curves = {}, {}
    for doc_id, n, text_crc, law, shard, slot, grown, curve in rows_of(spark, folder, "op9_hilbert_shards"):
        assert (n, text_crc, law, grown) == (size[doc_id], crc[doc_id], "rows", None)
        slots.setdefault(shard, []).append(slot)
        curves.setdefault(shard, []).append((curve, doc_id))
    assert sorted(slots) == list(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(s) for s in slots.values()]
    assert max(counts) - min(counts) <= 1 and sum(counts) == len(texts)
    for k in range(7):
        assert max(curves[k]) < min(curves[k + 1])
