"""Manifest, language-model scores and lexical search against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from basketlens.llm import attention_lm as lm
from basketlens.llm import lexical_search, lm_scores, merkle_manifest
from basketlens.llm.id_tree import Ids
from basketlens.llm.queries import QUERIES, vocabulary
from basketlens.sources.staging import Workspace


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((x is not None, x) for x in r))


# -- manifest ---------------------------------------------------------------------

DOCUMENT = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def tree(nodes):
    """Root, and per leaf its siblings (left, right) level by level."""
    paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        above, owners = [], []
        for k in range(0, len(nodes), 8):
            run = nodes[k : k + 8]
            for d in range(len(run)):
                for leaf in below[k + d]:
                    paths[leaf].append((run[:d], run[d + 1 :]))
            above.append(h(*run))
            owners.append(sum(below[k : k + 8], []))
        nodes, below = above, owners
    return (nodes[0] if nodes else None), paths


def brute_manifest(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, h(*map(field, r)), r))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    inner = {g: (sorted(groups[g], key=lambda x: x[:3]),) for g in names}
    inner = {g: (leaves, *tree([x[2] for x in leaves])) for g, (leaves,) in inner.items()}
    root, outer = tree([inner[g][1] for g in names])
    out = []
    for g, top in zip(names, outer):
        leaves, subroot, paths = inner[g]
        for (_, _, leaf, r), path in zip(leaves, paths):
            path = path + top
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
            node = h(*map(field, (*r[:4], r[4] and lower(r[4])))) if tampered else leaf
            for left, right in path:
                node = h(*left, node, *right)
            proof = h(*[s for left, right in path for s in left + right])
            out.append((r[0], leaf, subroot, root, proof, node, node == root))
    return out


ODD = [
    (None, None, None, None, None), (1, "a", "x", 1, "A"), (1, "a", "x", 1, "A"), (1, "a", "x", 2, "B"),
    (5, None, "", 0, ""), (7, "q", "é", 3, "É" * 10), (3, "q", "é", 3, None), (4, "s", "long", 1, "Ab" * 200_000),
    *[(i, "s", "many", i, "Text" * i) for i in range(70)], *[(9, "d", "same", 1, "Same")] * 30,
]


def test_manifest_equals_brute_force(spark):
    df = spark.createDataFrame(ODD, DOCUMENT).selectExpr("*", "1 AS tree", "2 AS idx", "3 AS key", "4 AS digest")
    assert ordered(merkle_manifest.verified_rows(df).collect()) == ordered(brute_manifest(ODD))


@pytest.mark.parametrize("rows", [[], [(7, "q", "x", 3, "Y")], [(i, "q", "x", 3, "Y") for i in range(9)]])
def test_small_manifests(spark, rows):
    df = spark.createDataFrame(rows, DOCUMENT)
    assert ordered(merkle_manifest.verified_rows(df).collect()) == ordered(brute_manifest(rows))


def test_asked_leaves_only(spark):
    rows = [(i, "s", f"l{i % 3}", i, "t") for i in range(200)]
    leaves = spark.createDataFrame(rows, DOCUMENT).selectExpr(
        "lang AS tree", "doc_id AS key", "unhex(sha2(CAST(doc_id AS STRING), 256)) AS leaf", "CAST(NULL AS BINARY) AS changed"
    )
    built = merkle_manifest.manifest(leaves, Workspace(spark, "asked"))
    wanted = spark.createDataFrame([("l0", 0), ("l0", 66), ("l2", 40)], "tree string, idx bigint")
    everyone = {(r.tree, r.idx): r for r in merkle_manifest.proofs(built).collect()}
    some = {(r.tree, r.idx): r for r in merkle_manifest.proofs(built, wanted).collect()}
    assert len(everyone) == 200 and set(some) == {("l0", 0), ("l0", 66), ("l2", 40)}
    assert all(everyone[k] == r for k, r in some.items())


# -- lexical search -----------------------------------------------------------------

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def brute_search(docs, items):
    terms = [(k, Counter(lower(x) for x in TERM.findall(t or ""))) for k, t in docs]
    n_docs, n_terms = sum(1 for _, c in terms if c), sum(sum(c.values()) for _, c in terms)
    df = Counter(w for _, c in terms for w in c)
    asked, out = {}, []
    for item, text in items:
        asked.setdefault(item, set()).update(lower(x) for x in TERM.findall(text or ""))
    for item, words in asked.items():
        scores = []
        for key, c in terms:
            n = sum(c.values())
            m = 100 - 90 + (90 * n * n_docs) // max(1, n_terms)
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[w] + 1))) * ((10**9 * c[w]) // (1000 * c[w] + 8 * m))
                for w in words if c[w]
            )
            if score > 0:
                scores.append((-score, key is not None, key or 0, key))
        best = sorted(scores, key=lambda s: s[:3])[:10]
        out += [(item, rank, s[3], -s[0]) for rank, s in enumerate(best, 1)]
    return out


def odd_search_tables():
    pick = random.Random(3)
    words = "a B c É éé 9 z日本 x1 q-w".split()
    docs = [
        (pick.choice([None, 1, 2, 3, i]), pick.choice([None, "", " ".join(pick.choices(words, k=pick.randint(0, 12)))]))
        for i in range(300)
    ]
    docs += [(5000 + i, "same Text again") for i in range(200)] + [(9000, "a b " * 20_000)]
    items = [
        (1, "same text"), (2, None), (3, ""), (4, "a b c"), (4, "é É"), (None, "x1 9"), (5, "zzz unknown"),
        (6, "Same again again q"),
    ]
    return docs, items


@pytest.mark.parametrize("docs_in_block,items_in_block", [(4_096, 1_024), (16, 2)])
def test_search_equals_brute_force(spark, monkeypatch, docs_in_block, items_in_block):
    monkeypatch.setattr(lexical_search, "BLOCK_DOCS", docs_in_block)
    monkeypatch.setattr(lexical_search, "BLOCK_ITEMS", items_in_block)
    docs, items = odd_search_tables()
    d = spark.createDataFrame(docs, "doc_id bigint, text string").selectExpr("*", "1 AS key", "2 AS n", "3 AS terms")
    i = spark.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "7 AS item", "8 AS position")
    found = lexical_search.ranked_documents(d, i).collect()
    assert ordered(found) == ordered(brute_search(docs, items))


def test_search_of_empty_tables(spark):
    docs, items = odd_search_tables()
    d = spark.createDataFrame(docs, "doc_id bigint, text string")
    i = spark.createDataFrame(items, "item_id bigint, text string")
    for left, right in ((d.where("false"), i), (d, i.where("false"))):
        found = lexical_search.ranked_documents(left, right)
        assert found.columns == ["item_id", "rank", "doc_id", "score"] and found.collect() == []


@pytest.mark.parametrize("waiting", [1 << 23, 64])
def test_tree_gives_back_its_cells_and_finds_the_best(monkeypatch, waiting):
    monkeypatch.setattr(lexical_search, "WAITING_NODES", waiting)
    random_ = np.random.default_rng(5)
    cells = np.unique(random_.integers(0, [300, 900], (4_000, 2)), axis=0)
    impact = random_.integers(1, 10**10, len(cells)) >> random_.integers(0, 30, len(cells))
    impact = np.maximum(impact, 1)
    shuffled = random_.permutation(len(cells))
    stored = lexical_search.packed(cells[shuffled, 0], cells[shuffled, 1], impact[shuffled])
    opened = lexical_search.Tree(stored)
    assert opened.highest[0] == impact.max()
    assert sorted(opened.highest[-len(cells) :].tolist()) == sorted(impact.tolist())
    keys = np.arange(900) * 3
    for rows in ([0], [5, 17, 200], list(range(0, 300, 7))):
        best = lexical_search.Best(10)
        lexical_search.searched(opened, np.array(rows), keys, best)
        total = np.zeros(900, np.int64)
        mine = np.isin(cells[:, 0], rows)
        np.add.at(total, cells[mine, 1], impact[mine])
        want = sorted(((-s, k) for s, k in zip(total.tolist(), keys.tolist()) if s > 0))[:10]
        assert [(-s, k) for s, k in zip(best.scores.tolist(), best.keys.tolist())] == want


# -- language-model scores ---------------------------------------------------------------


def pieces():
    import public_tokenizers

    return vocabulary("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def held(key):
    return zlib.crc32(("" if key is None else str(key)).encode()) % 5 == 1


def brute_base(rows):
    words = [(k, [*re.findall(r"[^\x20\x09-\x0D]+", lower(t or "")), "\n"]) for k, t in rows]
    c = Counter(w for k, ws in words if not held(k) for w in ws)
    n, v = sum(c.values()), len(c)
    return [
        (k, held(k), len(ws), sum(1 for w in ws if c[w]), n,
         math.fsum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws))
        for k, ws in words
    ]


def assert_base(found, rows):
    def order(r):
        return (r[0] is not None, r[0] or 0, r[2], round(r[5], 6))

    found, want = sorted(map(tuple, found), key=order), sorted(brute_base(rows), key=order)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    assert np.allclose([r[5] for r in found], [r[5] for r in want], rtol=1e-9, atol=1e-9)
    assert all(r[6] <= 0 and math.isfinite(r[6]) for r in found)


@pytest.fixture(scope="module")
def scored(spark, folder):
    return [tuple(r) for r in QUERIES["op12_lm_scores"](spark, folder).collect()]


def test_base_scores_equal_brute_force(spark, folder, scored):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    assert_base(scored, rows)


def test_rare_words_and_odd_rows(spark, monkeypatch):
    monkeypatch.setattr(lm_scores, "HEAD", 2)
    rows = [
        (None, None), (1, ""), (2, "  \n"), (3, "One two"), (3, "One two"), (None, "x É日本 <|endoftext|> \x00 z"),
        (7, "w" * 50_000), (8, "a b " * 30_000), (9, "\xa0 \xa0 q　r x\x1cy"),
    ]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").selectExpr("*", "1 AS row", "2 AS word", "3 AS key")
    assert_base(lm_scores.document_scores(df, *pieces()).collect(), rows)
    assert lm_scores.document_scores(df.where("false"), *pieces()).collect() == []
    only_held = [(k, "a b") for k in range(30) if held(k)]
    df = spark.createDataFrame(only_held, "doc_id bigint, text string")
    assert_base(lm_scores.document_scores(df, *pieces()).collect(), only_held)


def plain_log_probability(flat, classes):
    """One position after the other, as the docstring of the model has it."""
    p = lm.opened(flat.astype(np.float64))
    inputs, total, step = [lm.START, *classes[:-1]], 0.0, lm.WINDOW - lm.OVERLAP
    for t, target in enumerate(classes):
        window = 0 if t < lm.WINDOW else -(-(t + 1 - lm.WINDOW) // step)
        x = inputs[window * step : t + 1]
        e = p["embedding"][x]
        s = (e @ p["key"]) @ (e[-1] @ p["query"]) / math.sqrt(lm.HEAD) + p["distance"][len(x) - 1 - np.arange(len(x))]
        w = np.exp(s - s.max())
        seen = (w / w.sum()) @ (e @ p["value"])
        logits = e[-1] @ p["direct"] + seen @ p["mixed"] + p["bias"]
        total += logits[target] - logits.max() - math.log(np.exp(logits - logits.max()).sum())
    return total


def test_windows_score_every_position_once():
    random_ = np.random.default_rng(2)
    flat = lm.initial(random_.normal(0, 1, lm.CLASSES)) + random_.normal(0, 0.5, lm.PARAMETERS).astype(np.float32)
    lengths = np.array([1, 0, lm.WINDOW, lm.WINDOW + 1, 5, 3 * lm.WINDOW + 7])
    classes = random_.integers(0, lm.CLASSES, lengths.sum()).astype(np.uint8)
    found = lm.Scorer(flat).log_probabilities(classes, lengths)
    ends = np.cumsum(lengths)
    want = [plain_log_probability(flat, classes[e - n : e].tolist()) for e, n in zip(ends, lengths)]
    assert np.allclose(found, want, rtol=1e-4, atol=1e-4)


def test_gradient_equals_differences():
    random_ = np.random.default_rng(4)
    inputs = random_.integers(0, lm.CLASSES + 1, (3, lm.WINDOW))
    targets = random_.integers(-1, lm.CLASSES, (3, lm.WINDOW))
    flat = lm.initial(np.zeros(lm.CLASSES)).astype(np.float64)
    _, grad = lm.gradient(flat, inputs, targets)
    at = 0
    for shape in lm.SHAPES.values():
        size = int(np.prod(shape))
        place = at + int(np.abs(grad[at : at + size]).argmax())
        up, down = flat.copy(), flat.copy()
        up[place] += 1e-5
        down[place] -= 1e-5
        slope = (lm.gradient(up, inputs, targets)[0] - lm.gradient(down, inputs, targets)[0]) / 2e-5
        assert slope == pytest.approx(grad[place], rel=1e-3, abs=1e-9)
        at += size


def test_model_beats_the_classes_alone_on_held_out_texts(spark, folder, scored):
    """The trained model against the same classes without context."""
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()]
    opened = lm_scores.Pieces.opened(*pieces())

    def ids(text):
        import pyarrow as pa

        _, codes, names = lm_scores.split_words(pa.array([text]))
        found, sizes = opened.ids(names)
        parts = np.split(found, np.cumsum(sizes)[:-1]) if len(sizes) else []
        return np.concatenate([parts[c] for c in codes]) if len(codes) else np.zeros(0, np.int64)

    counts = np.zeros(opened.size, np.int64)
    for key, text in rows:
        if not held(key):
            np.add.at(counts, ids(text or ""), 1)
    classes, shares = lm_scores.classes_of(counts)
    smoothed = np.bincount(classes, counts + 0.5, lm.CLASSES)
    smoothed[lm.END] = sum(not held(k) for k, _ in rows) + 0.5
    log_shares = np.log10(smoothed / smoothed.sum())
    model = {r[0]: r[6] for r in scored if r[1]}
    alone = {k: float((log_shares[classes[i]] + shares[i]).sum() + log_shares[lm.END]) for k, t in rows if held(k) for i in [ids(t or "")]}
    assert model.keys() == alone.keys() and len(model) > 20
    assert sum(model.values()) > 0.97 * sum(alone.values())
    assert np.mean([model[k] > alone[k] for k in model]) > 0.9


def test_words_of_one_batch_are_encoded_as_alone():
    import pyarrow as pa

    opened = lm_scores.Pieces.opened(*pieces())
    words = ["the", "x\xa0y", "don't", "日本語", "a" * 700, "\x1c", "q9!", "naïve"]
    found, sizes = opened.ids(pa.array(words))
    alone = [opened.ids(pa.array([w])) for w in words]
    assert sizes.tolist() == [int(s[0]) for _, s in alone]
    assert found.tolist() == [i for ids, _ in alone for i in ids.tolist()]


def test_common_words_are_found_as_if_each_were_looked_up(monkeypatch):
    import pyarrow as pa

    random_ = np.random.default_rng(6)
    opened = lm_scores.Pieces.opened(*pieces())
    classes, shares = lm_scores.classes_of(random_.integers(0, 9, opened.size))
    lookup = lm_scores.Lookup(opened, classes, shares)
    common = ["the", "x\xa0y", "日本語", "q9!", "\x1c", "of", "naïve"]
    words = ["of", "rare", "a" * 700, "q9!", "日本", "naïve", "the", "x\xa0y", "thee", "\x00"]
    plain = lm_scores.word_hashes
    for hashes in (plain, lambda data: (np.zeros_like(plain(data)[0]), plain(data)[1])):
        monkeypatch.setattr(lm_scores, "word_hashes", hashes)
        monkeypatch.setattr(lm_scores, "HASHED", 3)
        for given, head_words in ((words, common), (words, []), ([], common), (common, common)):
            asked = []
            encode = lm_scores.Pieces.ids
            head = lm_scores.Head(pa.array(head_words, pa.string()), lookup.find(pa.array(head_words, pa.string())))
            names = pa.array(given, pa.string())
            places = head.places(names)
            monkeypatch.setattr(lm_scores.Pieces, "ids", lambda self, w: asked.extend(w.to_pylist()) or encode(self, w))
            flat, starts, lengths, inner = head.find(names, places, lookup)
            monkeypatch.setattr(lm_scores.Pieces, "ids", encode)
            known = [w for w in given if w in head_words]
            if hashes is plain:
                assert places.tolist() == [head_words.index(w) if w in head_words else len(head_words) for w in given]
                assert not set(asked) & set(known)
            else:  # all of one hash: one is found, none is taken for another
                assert all(p == len(head_words) or head_words[p] == w for p, w in zip(places, given))
            want, sizes, shares_of = lookup.find(names)
            assert lengths.tolist() == sizes.tolist() and np.array_equal(inner, shares_of)
            assert [c for s, n in zip(starts, lengths) for c in flat[s : s + n]] == want.tolist()


def test_gradient_is_the_same_without_its_loss_and_in_used_room():
    random_ = np.random.default_rng(7)
    flat, room = lm.initial(np.zeros(lm.CLASSES)), lm.Room()
    for rows in (5, 3, 5):
        inputs = random_.integers(0, lm.CLASSES + 1, (rows, lm.WINDOW)).astype(np.uint8)
        targets = random_.integers(-1, lm.CLASSES, (rows, lm.WINDOW)).astype(np.int16)
        loss, fresh = lm.gradient(flat, inputs, targets)
        none, again = lm.gradient(flat, inputs, targets, room, with_loss=False)
        assert loss > 0 and none == 0.0 and np.array_equal(fresh, again)


def test_training_takes_every_class_of_every_text_once():
    random_ = np.random.default_rng(5)
    lengths = [1, lm.WINDOW, lm.WINDOW + 1, 3, 2 * lm.WINDOW + 9]
    lines = [bytes([lm.START, *random_.integers(0, lm.CLASSES, n).tolist()]) for n in lengths]
    inputs, targets = lm_scores.windows_of(lines)
    assert targets[targets >= 0].tolist() == [c for line in lines for c in line[1:]]
    assert inputs[targets >= 0].tolist() == [c for line in lines for c in line[:-1]]


def test_blocks_of_long_texts_hold_all_classes(spark, monkeypatch):
    monkeypatch.setattr(lm_scores, "BLOCK", 4)
    texts = {1: b"abcdefghij", 2: b"k", 3: b"lmno"}
    df = spark.createDataFrame([(r, bytearray(t)) for r, t in texts.items()], "row bigint, classes binary")
    found = sorted(map(tuple, lm_scores.training_blocks(df).collect()))
    for row, text in texts.items():
        lines = [bytes(line) for r, _, line in found if r == row]
        assert b"".join(line[1:] for line in lines) == text
        assert [line[:1] for line in lines] == [bytes([lm.START]), *[line[-1:] for line in lines[:-1]]]


def test_model_learns_from_whole_texts(spark):
    """A cut of some length would break every word here; what follows what is learned from whole ones."""
    rows = [(k, " ".join(["x1y2z3" * 50] * 5)) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = [r for r in lm_scores.document_scores(df, *pieces()).collect() if r["held_out"]]
    # Six signs that come equally often: log10(1 / 6) each, were they not learned in their order.
    assert found and all(r["score"] > -0.1 * 1500 for r in found)


def test_gradient_and_scores_are_the_same_in_parts(monkeypatch):
    """Logits are handled a few inputs at a time, and windows are cut out some at a time."""
    random_ = np.random.default_rng(8)
    inputs = random_.integers(0, lm.CLASSES + 1, (9, lm.WINDOW)).astype(np.uint8)
    inputs[0], inputs[1:3] = 7, inputs[1:3] // 12
    targets = random_.integers(-1, lm.CLASSES, inputs.shape).astype(np.int8)
    flat = lm.initial(np.zeros(lm.CLASSES)).astype(np.float64)
    lengths = np.array([0, 1, lm.WINDOW, 0, 5 * lm.WINDOW + 3, 2, 17 * lm.WINDOW])
    classes = random_.integers(0, lm.CLASSES, lengths.sum()).astype(np.uint8)
    loss, grad = lm.gradient(flat, inputs, targets)
    scores = lm.Scorer(flat).log_probabilities(classes, lengths)
    for size in (1, 3, 100_000):
        for name in ("TOGETHER", "PREPARED", "SCORED"):
            monkeypatch.setattr(lm, name, size)
        again = lm.gradient(flat, inputs, targets)
        assert again[0] == pytest.approx(loss) and np.allclose(again[1], grad, rtol=1e-9, atol=1e-12)
        assert np.allclose(lm.Scorer(flat).log_probabilities(classes, lengths), scores, rtol=1e-5)


# -- ids below the classes -----------------------------------------------------------------


def some_ids(size=400):
    counts = np.random.default_rng(9).zipf(1.3, size).clip(0, 10_000) - 1
    classes, shares = lm_scores.classes_of(counts)
    ids = Ids(counts, classes, (lm.END, lm.START), lm_scores.SINGLES, lm.WIDTH, lm.HEAD)
    return counts, classes, shares, ids


def rough(ids, seed):
    random_ = np.random.default_rng(seed)
    new = ids.copy()
    new.own, new.choices = (a.astype(np.float64) + random_.normal(0, 0.3, a.shape) for a in (ids.own, ids.choices))
    return new


def test_choices_are_probabilities_of_the_ids_of_a_class():
    counts, classes, shares, ids = some_ids()
    some = np.flatnonzero(ids.lengths[ids.code])
    start = ids.log_probabilities(ids.code[some], np.zeros((len(some), lm.HEAD), np.float32)) / math.log(10)
    assert np.allclose(start, shares[some], atol=1e-5) and np.allclose(np.delete(shares, some), 0)
    seen = np.random.default_rng(1).normal(0, 1, lm.HEAD)
    p = np.exp(rough(ids, 2).log_probabilities(ids.code[some], np.repeat(seen[None], len(some), axis=0)))
    sums = np.bincount(classes[some], p)
    assert len(sums[sums > 0]) > 6 and np.allclose(sums[sums > 0], 1)


def test_all_ids_may_share_or_have_classes():
    for counts in (np.arange(3), np.zeros(500, np.int64), 2 ** np.arange(50).repeat(8)):
        classes, shares = lm_scores.classes_of(counts)
        ids = Ids(counts, classes, (lm.END, lm.START), lm_scores.SINGLES, lm.WIDTH, lm.HEAD)
        some = np.flatnonzero(ids.lengths[ids.code])
        found = ids.log_probabilities(ids.code[some], np.zeros((len(some), lm.HEAD), np.float32)) if len(some) else []
        assert np.allclose(found, shares[some] * math.log(10), atol=1e-4)
    wide = np.ones(70_000, np.int64)
    assert Ids(wide, lm_scores.classes_of(wide)[0], (lm.END, lm.START), lm_scores.SINGLES, 2, 2).type == np.uint32


def test_gradient_of_ids_equals_differences():
    _, _, _, ids = some_ids()
    random_ = np.random.default_rng(3)
    inputs = random_.integers(0, ids.size + 2, (4, lm.WINDOW)).astype(ids.type)
    targets = random_.integers(-1, ids.size + 1, (4, lm.WINDOW))
    flat, ids = lm.initial(np.zeros(lm.CLASSES)).astype(np.float64), rough(ids, 4)
    learned = {}
    loss, grad = lm.gradient(flat, inputs, targets, ids=ids, learned=learned)

    def slope(array, place):
        kept, losses = array[place], []
        for change in (1e-5, -1e-5):
            array[place] = kept + change
            losses.append(lm.gradient(flat, inputs, targets, ids=ids, learned={})[0])
        array[place] = kept
        return (losses[0] - losses[1]) / 2e-5

    at = 0
    for shape in lm.SHAPES.values():
        size = int(np.prod(shape))
        place = at + int(np.abs(grad[at : at + size]).argmax())
        assert grad[place] != 0 and slope(flat, place) == pytest.approx(grad[place], rel=1e-3)
        at += size
    for name in ("own", "choices"):
        rows, slopes = learned[name]
        assert len(set(rows.tolist())) == len(rows) > 20
        for column in (0, slopes.shape[1] - 1):
            i = int(np.abs(slopes[:, column]).argmax())
            assert slope(getattr(ids, name), (rows[i], column)) == pytest.approx(slopes[i, column], rel=1e-3)
    # The score of a short text is the loss of its window.
    text = random_.integers(0, ids.size + 1, 30).astype(ids.type)
    row = np.r_[ids.start, text[:-1], np.zeros(lm.WINDOW - 30, ids.type)].astype(ids.type)[None]
    want = lm.gradient(flat, row, np.r_[text.astype(int), np.full(lm.WINDOW - 30, -1)][None], ids=ids, learned={})[0]
    assert lm.Scorer(flat, ids).log_probabilities(text, np.array([30])) == pytest.approx([-30 * want], rel=1e-4)


def test_scores_stay_finite_where_inputs_differ_much():
    random_ = np.random.default_rng(11)
    flat = lm.initial(np.zeros(lm.CLASSES)) + random_.normal(0, 0.5, lm.PARAMETERS).astype(np.float32)
    for name, input_, size in (("embedding", 5, 40), ("embedding", 9, -40), ("mixed", 3, 60), ("direct", 2, 60)):
        p = lm.opened(own := flat.copy())
        p[name][input_] *= size
        classes = random_.integers(0, 12, 2 * lm.WINDOW).astype(np.uint8)
        found = lm.Scorer(own).log_probabilities(classes, np.array([len(classes)]))
        assert np.allclose(found, plain_log_probability(own, classes.tolist()), rtol=1e-3)
        inputs, targets = classes[: lm.WINDOW][None], classes[1 : lm.WINDOW + 1][None]
        loss, grad = lm.gradient(own, inputs, targets.astype(np.int16))
        assert math.isfinite(loss) and np.isfinite(grad).all()


def test_wide_codes_are_cut_into_blocks_and_windows(spark, monkeypatch):
    monkeypatch.setattr(lm_scores, "BLOCK", 2 * lm.WINDOW)
    texts = {1: np.arange(300, 300 + 2 * lm.WINDOW + 5), 2: np.array([65_000])}
    start = np.uint16(65_001)
    df = spark.createDataFrame([(r, bytearray(t.astype(np.uint16).tobytes())) for r, t in texts.items()], "row bigint, classes binary")
    for row, text in texts.items():
        lines = [bytes(line) for r, _, line in sorted(map(tuple, lm_scores.training_blocks(df, start).collect())) if r == row]
        inputs, targets = lm_scores.windows_of(lines, np.dtype(np.uint16))
        assert targets[targets >= 0].tolist() == text.tolist()
        assert inputs[targets >= 0].tolist() == [int(start), *text[:-1].tolist()]


def test_rows_of_tasks_are_averaged_by_their_use(spark):
    def value(*numbers):
        return bytearray(np.array(numbers, np.float32).tobytes())

    rows = [(0, 0, 3.0, value(1, 2, 3)), (0, 0, 1.0, value(5, 2, 3)), (1, 7, 1.0, value(1)), (1, 7, 1.0, value(2)), (2, 7, 5.0, value(9, 8))]
    found = lm_scores.merged(spark.createDataFrame(rows, "kind int, row int, weight double, value binary")).to_pylist()
    assert sorted((r["kind"], r["row"], np.frombuffer(r["value"], np.float32).tolist()) for r in found) == [
        (0, 0, [2, 2, 3]), (1, 7, [1.5]), (2, 7, [9, 8])
    ]


def test_model_learns_which_id_of_a_class_comes_next(spark):
    """Equally common words in a fixed order: a model that knows each class, but not which id of it, can't reach this score."""
    import pyarrow as pa

    opened = lm_scores.Pieces.opened(*pieces())
    letters = [a + b + c for a in "bcdfghlmnprst" for b in "aeiou" for c in "dlmnprst"]
    found, sizes = opened.ids(pa.array(letters))
    words = [w for w, n in zip(letters, sizes) if n == 1][:200]
    assert len(words) == 200
    random.Random(3).shuffle(words)
    rows = [(k, " ".join((words[k % 7 * 20 :] + words[: k % 7 * 20]) * 10)) for k in range(100)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    scores = [r["score"] for r in lm_scores.document_scores(df, *pieces()).collect() if r["held_out"]]
    counts = np.zeros(opened.size, np.int64)
    counts[opened.ids(pa.array(words))[0]] = 10 * sum(not held(k) for k, _ in rows)
    shares = lm_scores.classes_of(counts)[1]
    assert scores and min(scores) > 10 * float(shares[counts > 0].sum())
