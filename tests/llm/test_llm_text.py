"""Token files and counts, similarity, decontamination, mixing, language, pipeline on small cases."""

import io
import pathlib
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from basketlens.llm import decontaminate, jaccard_groups, language_id, source_mix, token_counts, token_files
from basketlens.llm.pfor import Reader, Writer
from basketlens.llm.pretokens import Units
from basketlens.llm.queries import vocabulary
from basketlens.sources.staging import Workspace, shared_folder

WORDS = "word_bpe_49k.json"
ODD = [
    None, "", " \n\t", "it's I'LL 'sting !'s don't’s", "<|endoftext|> a<|startoftext|>b",
    "É İstanbul ΑΣ ΣΑΣ. ä K ½ x²3", "a\x1cb a\x85b a\xa0b 　z\x0bq\x00 µª", "日本語 テスト ﬁ ǅ 1,234.5 Á",
    "x" * 3000, "word " * 20_000, "ÀÉÎ ßÞ ×÷", "<|ENDOFTEXT|>",
]


def docs(spark, rows, schema="doc_id bigint, text string, lang string, source string, n_tokens bigint, row int"):
    return spark.createDataFrame([(*r, 5, 6) for r in rows], schema)


def from_texts(spark, texts):
    return docs(spark, [(k, t, "en", f"s{k % 3}") for k, t in enumerate(texts)])


# -- token files and counts ------------------------------------------------------


@given(st.lists(st.lists(st.integers(0, 2**32 - 1), max_size=700), max_size=6), st.sampled_from([1, 200, 2**16, 2**32]))
@settings(max_examples=60, deadline=None)
def test_packed_file_round_trip(documents, below):
    sink = io.BytesIO()
    writer = Writer(sink)
    arrays = [np.array([x % below for x in ids], np.uint32) for ids in documents]
    for k, ids in enumerate(arrays):
        writer.add(None if k == 1 else k, ids)
    writer.finish()
    back = [(key, start, ids.tolist()) for key, start, ids in Reader(io.BytesIO(sink.getvalue()))]
    before = np.cumsum([0, *map(len, arrays)]).tolist()
    assert back == [(None if k == 1 else k, before[k], ids.tolist()) for k, ids in enumerate(arrays)]


def test_blocks_decode_alone_and_outliers_are_patched():
    values = np.arange(1000, 1000 + 256 * 5, dtype=np.uint32)
    values[[3, 300, 700]] = 4_000_000_000
    sink = io.BytesIO()
    writer = Writer(sink)
    writer.add(0, values)
    writer.finish()
    reader = Reader(io.BytesIO(sink.getvalue()))
    assert reader.index["width"].max() == 8 and len(reader.patches) == 3
    assert reader.blocks(2, 4).tolist() == values[512:1024].tolist()
    with pytest.raises(ValueError):
        Reader(io.BytesIO(b"x" * 200))


def test_split_texts_encode_as_the_library_does():
    units, rng = Units.opened(vocabulary(WORDS)), random.Random(4)
    texts = [t or "" for t in ODD]
    texts += ["".join(rng.choice("aZ'sSt.!9 é É ß×÷²\n\t\x1f\x1c\x0b\x00<|_-") for _ in range(50)) for _ in range(400)]
    texts += ["".join(rng.choice("aZ.!9 é É ßÞ\n\t\x1f\x0b\x00<|_-") for _ in range(50)) for _ in range(400)]
    library = Tokenizer.from_file(vocabulary(WORDS))
    expected = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    found = units.encode_column(pa.array(texts), {})
    assert [np.frombuffer(x, units.dtype).tolist() for x in found] == expected


def test_token_operators_on_odd_rows(spark):
    library = Tokenizer.from_file(vocabulary(WORDS))
    ids = [library.encode(t or "", add_special_tokens=False).ids for t in ODD]
    frame = from_texts(spark, ODD).union(docs(spark, [(None, "null key", "en", "s"), (0, None, "en", "s")]))
    counted = sorted(
        (tuple(r) for r in token_counts.token_counts(frame, vocabulary(WORDS), head=20).collect()),
        key=lambda r: (r[0] is not None, r[0] or 0),
    )
    expected = [(k, len((t or "").encode()), len(i), len(i) > 2048) for (k, t), i in zip(enumerate(ODD), ids)]
    assert counted == [(None, 8, 2, False), (0, 0, 0, False), *expected]
    read = [tuple(r) for r in token_files.token_file_digest(frame, vocabulary(WORDS), 2).collect()]
    read.sort(key=lambda r: r[1])
    assert [r[0] for r in read] == [None, 0, 0, *range(1, len(ODD))]
    assert [r[2] for r in read[3:]] == [len(i) + 1 for i in ids[1:]]
    crc = zlib.crc32(np.array([*ids[3], 2], "<u4").tobytes())
    assert [r[3] for r in read if r[0] == 3] == [crc]


def test_token_files_are_cut_by_key(spark, monkeypatch):
    monkeypatch.setattr(token_files, "FILE_ROWS", 16)
    keys = random.Random(2).sample(range(-500, 500), 200)
    frame = docs(spark, [(k, f"text {k}", "en", "s") for k in keys]).repartition(5)
    space = Workspace(spark, "t")
    files = token_files.write_files(frame, vocabulary(WORDS), 2, space.path("f"), space.path("i"))
    assert files.count() > 8
    back = sorted((tuple(r) for r in token_files.read_files(files).collect()), key=lambda r: r[1])
    assert [r[0] for r in back] == sorted(keys)
    assert [r[1] for r in back] == np.cumsum([0, *[r[2] for r in back]])[:-1].tolist()


def test_token_operators_on_nothing(spark):
    assert token_counts.token_counts(docs(spark, []), vocabulary(WORDS)).count() == 0
    assert token_files.token_file_digest(docs(spark, []), vocabulary(WORDS), 2).count() == 0


# -- similarity ------------------------------------------------------------------


def brute_components(texts, percent):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        take = min(4, len(w))
        sets.append({tuple(w[k : k + take]) for k in range(len(w) - take + 1)} if w else set())
    parent = list(range(len(texts)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(sets)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return {k: (len(sets[k]), root(k)) for k in range(len(texts))}


def family(rng, base, members, edits):
    out = []
    for _ in range(members):
        words = list(base)
        for _ in range(rng.randrange(edits)):
            words[rng.randrange(len(words))] = f"edit{rng.randrange(10_000)}"
        out.append(" ".join(words))
    return out


@pytest.mark.parametrize("seed,percent", [(1, 85), (2, 60)])
def test_components_match_brute_force(spark, seed, percent, monkeypatch):
    monkeypatch.setattr(jaccard_groups, "COMMON_IN_BATCH", 2)
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(60)]
    passage = [f"p{k}" for k in range(50)]
    texts = [None, "", " \n", "one", "One", "one two", "one two three", "a b c d", "A B C d"]
    for size in (30, 60, 120, 400):
        texts += family(rng, rng.choices(words, k=size), 40, size // 8)
    texts += [" ".join(passage + rng.choices(words, k=rng.randrange(5, 60))) for _ in range(40)]
    texts += [texts[20]] * 30 + [" ".join(rng.choices(words, k=30)) for _ in range(40)]
    rng.shuffle(texts)
    frame = from_texts(spark, texts).repartition(6)
    found = jaccard_groups.similarity_components(frame, percent=percent).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_components(texts, percent)


def test_similarity_of_repeated_and_unnamed_rows(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(7, text, "en", "a"), (7, text, "en", "a"), (None, text, "de", "b"), (3, text, "en", "c"), (4, None, "en", "c"), (4, None, "en", "c")]
    found = Counter(tuple(r) for r in jaccard_groups.similarity_components(docs(spark, rows)).collect())
    assert found == Counter({(7, 37, 3): 2, (None, 37, 3): 1, (3, 37, 3): 1, (4, 0, 4): 2})
    kept = jaccard_groups.one_per_component(docs(spark, rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_tokens", "row"]
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter({3: 1, 4: 2})
    twice = docs(spark, [(7, text, "en", "a"), (7, text, "de", "b")])
    assert jaccard_groups.one_per_component(twice).count() == 1
    assert jaccard_groups.similarity_components(docs(spark, [])).count() == 0


def test_similarity_leaves_only_its_result_staged(spark):
    folder = pathlib.Path(shared_folder(spark)) / "basketlens"
    before = set(folder.glob("*")) if folder.exists() else set()
    out = jaccard_groups.one_per_component(docs(spark, [(1, "a b c d e", "en", "s"), (2, "a b c d e", "en", "s"), (3, "q", "en", "s")]))
    new = [p for p in folder.glob("*") if p not in before]
    assert [sorted(p.name for p in f.glob("*")) for f in new] == [["rows"]]
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 3]



# -- decontamination -------------------------------------------------------------


def brute_hits(text, items):
    words = decontaminate.words_of((text or "").encode())
    hit, names = set(), set()
    for name, item in items:
        own = decontaminate.words_of((item or "").encode())
        size = min(13, len(own))
        strings = {tuple(own[k : k + size]) for k in range(len(own) - size + 1)} if own else set()
        for k in range(len(words) - size + 1):
            if strings and tuple(words[k : k + size]) in strings:
                hit |= set(range(k, k + size))
                if name is not None:
                    names.add(str(name))
    return len(words), len(hit), sorted(names)


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_hits_match_brute_force(spark, block_bytes):
    rng = random.Random(6)
    vocabulary_ = ["a", "B", "ü", "x1", "THE", "of"]
    items = [(k, " ".join(rng.choices(vocabulary_, k=rng.randrange(10, 40)))) for k in range(12)]
    items += [(20, "solo"), (21, "two words"), (22, None), (23, " .,"), (None, "three odd words"), (1, items[1][1]), (101, items[2][1])]
    texts = [None, "", "solo", "Solo, two!words", "three odd words"]
    for _ in range(60):
        words = rng.choices(vocabulary_, k=rng.randrange(60))
        if rng.random() < 0.6:
            words += (items[rng.randrange(12)][1]).replace(" ", ", ").split(" ")[: rng.randrange(10, 40)]
        texts.append(" ".join(words + rng.choices(vocabulary_, k=rng.randrange(200))))
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = decontaminate.judged(decontaminate.searched(from_texts(spark, texts), bench, block_bytes=block_bytes))
    for r in found.collect():
        n, hit, names = brute_hits(texts[r["row"]["doc_id"]], items)
        assert (r["n_words"], r["n_hit"], r["items"]) == (n, hit, names)
        assert r["contaminated"] == (hit > 0 and 20 * hit >= n)


def test_clean_rows_keep_their_columns(spark):
    bench = spark.createDataFrame([(1, " ".join(f"b{k}" for k in range(20)))], "item_id bigint, text string")
    texts = [None, " ".join(f"b{k}" for k in range(20)), "fine " * 30, " ".join(f"b{k}" for k in range(12))]
    kept = decontaminate.clean_rows(from_texts(spark, texts), bench)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_tokens", "row"]
    assert sorted(r["doc_id"] for r in kept.collect()) == [0, 2, 3]
    assert decontaminate.clean_rows(from_texts(spark, texts), bench.limit(0)).count() == 4
    assert decontaminate.clean_rows(docs(spark, []), bench).count() == 0


# -- mixing ----------------------------------------------------------------------


def test_tree_of_pairs_keeps_words_and_is_repeatable(spark):
    rng = random.Random(8)
    rows = [(k, "w " * rng.randrange(1, 30), "en", rng.choice(["a", "b", "c", None])) for k in range(1500)]
    rows += [(9000, None, "en", "a"), (9001, "", "en", "empty"), (9002, "x", "en", ""), (9002, "x", "en", "")]
    found = [tuple(r) for r in source_mix.mix_report(docs(spark, rows), leaf=40, fan=3).collect()]
    again = [tuple(r) for r in source_mix.mix_report(docs(spark, rows).repartition(7), leaf=40, fan=3).collect()]
    assert Counter(found) == Counter(again) and len(found) == len(rows)
    source = {r[0]: r[3] for r in rows}
    taken, target = Counter(), {}
    for doc_id, size, source_size, aim, took in found:
        assert took in (0, size, 2 * size) if size else took == 0
        taken[source[doc_id]] += took
        target[source[doc_id]] = (aim, source_size)
    for s, (aim, source_size) in target.items():
        assert abs(taken[s] - aim) <= 30 and aim <= 2 * source_size
    assert target["empty"] == (0.0, 0) and target[""][1] == 2
    assert sum(aim for aim, _ in target.values()) == pytest.approx(1.5 * sum(n for _, n in target.values()))


def test_every_document_can_be_drawn(spark):
    rows = [(k, "w " * (5 + k % 4), "en", "abc"[k % 3]) for k in range(60)]
    seen = Counter()
    for seed in range(6):
        got = source_mix.mix_report(docs(spark, rows), seed=seed).collect()
        seen.update(r["doc_id"] for r in got if r["taken"] > 0)
    assert len(seen) >= 50


def test_mixed_rows_repeat(spark):
    rows = [(1, "a b c", "en", "x"), (1, "a b c", "en", "x"), (2, None, "de", None)]
    out = source_mix.mix_rows(docs(spark, rows))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_tokens", "row"]
    assert 2 <= out.count() <= 4 and out.where("doc_id = 2").count() == 0
    assert source_mix.mix_rows(docs(spark, [])).count() == 0


def test_mixed_rows_are_the_mix_of_sizes_and_stage_no_text(spark, monkeypatch):
    staged, save = [], source_mix.Workspace.save
    monkeypatch.setattr(source_mix.Workspace, "save", lambda self, df, name: staged.append(df.schema.simpleString()) or save(self, df, name))
    rng = random.Random(9)
    rows = [(k % 290, "w " * rng.randrange(1, 6), "en", rng.choice(["a", "b", "c", None])) for k in range(300)]
    rows += [(None, "x y", "en", "a"), (5, None, "en", "a")] + [(7, "p q r", "en", "b")] * 4
    want, found = Counter(), Counter()
    for r in source_mix.mix_report(docs(spark, rows)).collect():
        want[r["doc_id"], r["size"]] += r["taken"]
    staged.clear()
    for r in source_mix.mix_rows(docs(spark, rows)).collect():
        size = len((r["text"] or "").split())
        found[r["doc_id"], size] += size
    assert +found == +want
    assert staged and not any("text" in s or "row:" in s for s in staged)


# -- language --------------------------------------------------------------------


def sentence(rng, lang):
    parts = {"aa": ["ba", "bo", "bi", "da"], "zz": ["tszk", "krsz", "glü", "szö"], "qq": ["quoi", "eau", "oie", "aux"]}[lang]
    return " ".join("".join(rng.choices(parts, k=3)) for _ in range(rng.randrange(3, 60)))


def test_language_learns_rejects_nothing_clean_and_marks_the_rest(spark):
    rng = random.Random(9)
    rows = [(k, sentence(rng, lang), lang, "s") for k, lang in enumerate(rng.choices(["aa", "zz", "qq"], k=900))]
    odd = [(2000, None, "aa", "s"), (2001, "", "aa", "s"), (2002, "12 34 !?", "aa", "s"), (None, sentence(rng, "zz"), None, "s"), (5, sentence(rng, "qq") * 500, None, None)]
    got = language_id.languages(docs(spark, rows + odd)).collect()
    assert len(got) == len(rows) + len(odd)
    by = {r["doc_id"]: r for r in got}
    good = [by[k]["lang_pred"] == lang for k, _, lang, _ in rows if k != 5]
    assert np.mean(good) > 0.99 and sum(by[k]["rejected"] for k, *_ in rows) <= 3
    for k in (2000, 2001, 2002):
        assert (by[k]["lang_pred"], by[k]["score"], by[k]["rejected"]) == ("und", 0.0, True)
    assert by[None]["lang_pred"] == "zz" and not by[None]["held_out"]
    assert by[1]["held_out"] == (zlib.crc32(b"1") % 4 == 2)
    kept = language_id.accepted_rows(docs(spark, rows + odd))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_tokens", "row"]


def test_the_held_out_fold_is_not_learned_from(spark):
    rng = random.Random(10)
    held = [k for k in range(400) if zlib.crc32(str(k).encode()) % 4 == 2]
    free = [k for k in range(400) if k not in held]
    rows = [(k, sentence(rng, "aa"), "aa", "s") for k in free] + [(k, sentence(rng, "zz"), "zz", "s") for k in held]
    assert {r["lang_pred"] for r in language_id.languages(docs(spark, rows)).collect()} == {"aa"}


PARTS = {
    "aa": ["ba", "bo", "bi", "da"], "zz": ["tszk", "krsz", "glü", "szö"], "qq": ["quoi", "eau", "oie", "aux"],
    "hh": ["hwn", "yll", "gwy", "ddh"], "vv": ["vele", "jnum", "fexo", "pim"],
}


@pytest.mark.parametrize("learned", [["aa"], ["aa", "qq"], ["aa", "zz", "qq", "hh"]])
def test_a_language_that_was_not_learned_is_rejected(spark, learned):
    rng = random.Random(11)

    def said(lang, words):
        return " ".join("".join(rng.choices(PARTS[lang], k=3)) for _ in range(words))

    known = [(k, said(lang, rng.randrange(3, 60)), lang, "s") for k, lang in enumerate(rng.choices(learned, k=250 * len(learned)))]
    other = [(5000 + k, said("vv", rng.randrange(20, 400)), None, "s") for k in range(60)]
    by = {r["doc_id"]: r["rejected"] for r in language_id.languages(docs(spark, known + other)).collect()}
    assert all(by[k] for k, *_ in other)
    assert sum(by[k] for k, *_ in known) <= len(known) // 100
    kept = {r["doc_id"] for r in language_id.accepted_rows(docs(spark, known + other)).collect()}
    assert kept == {k for k, rejected in by.items() if not rejected}


def test_every_label_is_learned(spark):
    rows = [(k, f"{chr(0x4E00 + k % 230) * 3} {chr(0x4E00 + k % 230) * 5}", f"l{k % 230}", "s") for k in range(230 * 12)]
    got = language_id.languages(docs(spark, rows)).collect()
    assert {r["lang_pred"] for r in got} == {f"l{k}" for k in range(230)}


def test_many_labels_share_the_sample(spark, monkeypatch):
    monkeypatch.setattr(language_id, "ALL_TEXTS", 400)
    rng = random.Random(12)
    rows = [(k, sentence(rng, "aa"), f"l{k % 10}", "s") for k in range(4000)]
    _, _, texts = language_id.sample(docs(spark, rows), "doc_id", "text", "lang")
    by_label = Counter(label for label, _ in texts)
    assert len(by_label) == 10 and 250 < len(texts) < 550


def test_repeated_and_null_keys_are_sampled_by_text(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_TEXTS", 40)
    rng = random.Random(13)
    same = [(key, sentence(rng, "aa"), f"of {key}", "s") for key in (None, 1, 3, 5, 8) for _ in range(400)]
    copies = [(901, sentence(rng, "zz"), "copies", "s")] * 300 + [(k, sentence(rng, "zz"), "copies", "s") for k in range(1000, 1020)]
    learned, calibration, texts = language_id.sample(docs(spark, same + copies), "doc_id", "text", "lang")
    by_label = Counter(label for label, _ in texts)
    for key in (None, 1, 3, 5, 8):
        if key is None or zlib.crc32(str(key).encode()) % 4 != 2:
            assert 15 < by_label.pop(f"of {key}") < 75
    free = [k for k in (901, *range(1000, 1020)) if zlib.crc32(str(k).encode()) % 4 != 2]
    assert by_label == {"copies": len(free)}
    assert {label for label, _, _ in learned} == {label for label, _, _ in calibration}


def test_long_blanks_in_a_labelled_text_are_learned_around(spark):
    rows = [(k, "ba" + " \n" * language_id.SAMPLE_BYTES * 20 + "bo bi", "aa", "s") for k in range(12)]
    _, _, texts = language_id.sample(docs(spark, rows), "doc_id", "text", "lang")
    assert len(texts) == sum(zlib.crc32(str(k).encode()) % 4 != 2 for k in range(12))
    assert {r["lang_pred"] for r in language_id.languages(docs(spark, rows)).collect()} == {"aa"}


def test_language_without_labels(spark):
    got = language_id.languages(docs(spark, [(1, "text", None, "s")])).collect()
    assert [(r["lang_pred"], r["score"]) for r in got] == [("und", 0.0)]
    assert language_id.languages(docs(spark, [])).count() == 0


# -- pipeline --------------------------------------------------------------------


def test_pipeline_stages_hand_documents_on(spark, folder):
    given_docs = spark.read.parquet(f"{folder}/documents.parquet")
    space, frames = Workspace(spark, "t"), {"start": given_docs}
    now = given_docs
    for name, stage in corpus_pipeline.STAGES:
        now = frames[name] = space.save(stage(spark, now, folder), name)
        if name != "shards":
            assert now.columns == given_docs.columns
    texts = {r["doc_id"]: r["text"] for r in frames["language"].collect()}
    kept = sorted(texts)
    brute = brute_components([texts[k] for k in kept], 85)
    expected = sorted(kept[i] for i, (n, low) in brute.items() if n == 0 or low == i)
    assert sorted(r["doc_id"] for r in frames["similar"].collect()) == expected
    bench = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    clean = []
    for k in expected:
        n, hit, _ = brute_hits(texts[k], bench)
        if not (hit > 0 and 20 * hit >= n):
            clean.append(k)
    assert sorted(r["doc_id"] for r in frames["benchmark"].collect()) == clean
    copies = Counter(r["doc_id"] for r in frames["mix"].collect())
    assert set(copies) <= set(clean) and max(copies.values()) <= 2
    sharded = frames["shards"].collect()
    assert Counter(r["doc_id"] for r in sharded) == copies
    assert sorted((r["shard"], r["slot"]) for r in sharded) == sorted(set((r["shard"], r["slot"]) for r in sharded))
    assert len(given_docs.columns) + 2 == len(now.columns)
    assert len(texts) >= 0.97 * given_docs.count()
