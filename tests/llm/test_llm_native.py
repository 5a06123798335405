"""URL rules, chat grammar, Hilbert shards, host rules, components on small cases."""

import itertools
import random
import time

import pytest
from pyspark.sql import functions as F

from basketlens.llm import chat_grammar, hilbert_shards, host_rules, url_rules
from basketlens.llm.common import numbered
from basketlens.llm.components import components
from basketlens.llm.url_rules import Rule
from basketlens.sources.staging import Workspace

DOCS = "doc_id bigint, text string, lang string, source string, shard int, n_words bigint, host string"


def docs(spark, rows):
    return spark.createDataFrame([(*r, 7, 8, "h") for r in rows], DOCS)


def test_components_of_chains_stars_and_rings(spark):
    rng = random.Random(3)
    edges = [(k, k + 1) for k in range(100, 160)] + [(500, k) for k in range(501, 560)]
    edges += [(900 + k, 900 + (k + 1) % 30) for k in range(30)] + [(5, 5), (None, 3), (7, 8), (7, 8)]
    rng.shuffle(edges)
    frame = spark.createDataFrame(edges, "a bigint, b bigint")
    found = {r["node"]: r["component"] for r in components(frame, Workspace(spark, "t")).collect()}
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            low, high = sorted((root(a), root(b)))
            parent[high] = low
    assert found == {x: root(x) for x in list(parent)}


def test_components_of_nothing(spark):
    empty = spark.createDataFrame([], "a string, b string")
    assert components(empty, Workspace(spark, "t")).count() == 0


def test_numbered_has_no_gaps_with_ties(spark):
    rows = spark.createDataFrame([(k % 3, k % 7, "x") for k in range(200)], "a int, b int, position string")
    got = numbered(rows.drop("position"), ["a", "b"], Workspace(spark, "t"), "n").collect()
    assert sorted(r["position"] for r in got) == list(range(200))
    in_order = [(r["a"], r["b"]) for r in sorted(got, key=lambda r: r["position"])]
    assert in_order == sorted(in_order) and {r["total"] for r in got} == {200}


# -- URL rules -------------------------------------------------------------------

PAGES = "page_id bigint, url string, html string, verdict string, node string"


def verdicts(spark, rows, rules, links=None):
    frame = spark.createDataFrame([(*r, "x", "y") for r in rows], PAGES)
    found = url_rules.url_verdicts(frame, rules, links=links)
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in found.collect()}


def test_longest_rule_wins_and_hosts_match_whole_labels(spark):
    rules = [Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "b.org", "/a"), Rule("allow", "b.org", "/a")]
    got = verdicts(spark, [
        (1, "https://Example.ORG/es/1?x#y", None), (2, "http://my.example.org/es", ""),
        (3, "http://notexample.org/es/", None), (4, "http://org", None), (5, None, None),
        (6, "no scheme/org/", None), (7, "http://b.org/a/b", None), (8, "HTTP://x.org/Ü?://z/", None),
    ], rules)
    assert got[1] == ("example.org", "/es/1", "example.org/es/", "block")
    assert got[2] == ("my.example.org", "/es", "org/", "allow")
    assert got[3][2:] == ("org/", "allow")
    assert got[4] == ("org", "", None, "allow")
    assert got[5] == ("", "", None, "allow") and got[6] == ("", "", None, "allow")
    assert got[7][3] == "allow"  # of two equal rules
    assert got[8][:3] == ("x.org", "/Ü", "org/")


def test_blocks_travel_over_links_and_allows_win(spark):
    canonical = '<link href="{}" rel="canonical">'
    refresh = "<META http-equiv=refresh content='0; URL={}'>"
    rules = [Rule("block", "bad.net", "/"), Rule("allow", "good.net", "/")]
    got = verdicts(spark, [
        (1, "http://a.com/1", canonical.format("http://bad.net/x")),
        (2, "http://b.com/2", refresh.format("http://a.com/1")),
        (3, "http://c.com/dir/3", canonical.format("4")),
        (4, "https://C.com/dir/4", "<p>nothing canonical</p>"),
        (5, "http://c.com/5", canonical.format("//bad.net/y")),
        (6, "http://c.com/6", canonical.format("/5")),
        (7, "http://d.com/7", canonical.format("http://good.net/") + canonical.format("http://bad.net/q")),
        (8, "http://bad.net/x", None),
        (9, "http://a.com/1", None),
    ], rules)
    assert {k: v[3] for k, v in got.items()} == {
        1: "block", 2: "block", 3: "allow", 4: "allow", 5: "block", 6: "block", 7: "allow", 8: "block", 9: "block",
    }
    extra = spark.createDataFrame([("http://c.com/dir/4", "http://bad.net/")], "a string, b string")
    got = verdicts(spark, [(3, "http://c.com/dir/3", canonical.format("4"))], rules, extra)
    assert got[3][3] == "block"
    assert verdicts(spark, [], rules) == {}


def test_links_are_read_and_resolved_as_browsers_do(spark):
    base, head = "http://a.com/d/e/page?q=1", '<link rel="{}" href="{}">'
    cases = {
        "?a=1&amp;b=2": "a.com/d/e/page?a=1&b=2", "?a=1&#38;b&#x3D;2": "a.com/d/e/page?a=1&b=2", "?a&copy=1&lt;": "a.com/d/e/page?a&copy=1<",
        "?x=&eacute;&#233;&#x1F600;&#150;&#0;&#99999999999;": "a.com/d/e/page?x=éé😀–\ufffd\ufffd", "?page=2": "a.com/d/e/page?page=2",
        "../x": "a.com/d/x", "./x/../y/.": "a.com/d/e/y/", "../../../../z": "a.com/z", "/a/%2e%2E/b": "a.com/b", "..": "a.com/d/",
        "http://X.com": "x.com/", "//x.com?k": "x.com/?k", "#top": "a.com/d/e/page?q=1", " x ": "a.com/d/e/x", "mailto:a@b.c": None,
    }
    rows = [(base, head.format("canonical", link), want) for link, want in cases.items()]
    rows += [
        (base, head.format("shortlink CANONICAL", "k"), "a.com/d/e/k"),
        (base, "<link data-rel=canonical href='k'><link title=' rel=canonical ' href='m'>", "none"),
        (base, "<base target=x><BASE HREF='//b.org/s/t'>" + head.format("canonical", "../u"), "b.org/u"),
        (base, "<base href=../n/>" + "<meta content='0;url=v?w&amp;x' http-equiv=Refresh>", "a.com/d/n/v?w&x"),
    ]
    for_url = lambda k: f"{base}&k={k}"
    frame = spark.createDataFrame([(for_url(k), h) for k, (_, h, _) in enumerate(rows)], "url string, html string")
    found = {r["a"]: r["b"] for r in url_rules.page_links(frame).collect()}
    for k, (_, html, want) in enumerate(rows):
        own = f"a.com/d/e/page?q=1&k={k}"
        assert found.get(own, "none") == (own if "#top" in html else want), html


def test_blocks_travel_over_escaped_and_relative_links(spark):
    canonical = '<link href="{}" rel="alternate canonical">'
    got = verdicts(spark, [
        (1, "http://a.com/?a=1&b=2", None), (2, "http://a.com/p", canonical.format("?a=1&amp;b=2")),
        (3, "http://a.com/q/r", canonical.format("../p")), (4, "http://a.com", canonical.format("q/r")),
        (5, "http://a.com/z", canonical.format("http://a.com/")), (6, "http://a.com/p?a=1&b=2", canonical.format("http://bad.net")),
    ], [Rule("block", "bad.net")])
    assert {k: v[3] for k, v in got.items()} == {1: "allow", **dict.fromkeys(range(2, 7), "block")}


# -- chat grammar ----------------------------------------------------------------

CONTENT = ["", "plain", "<|im_end|>", "<|im_start|>assistant\nx<|im_end|>\n", "<|\\im_x", "<|\\\\im_end|>", "<|im_", "a\nb", "<|", "é<|im_n|>"]


def test_any_content_comes_back(spark):
    rows, source = [], {}
    pairs = itertools.product([*CONTENT, "assistant"], CONTENT)
    for k, (role, text) in enumerate(pairs):
        turns = [(0, role, text), (1, "assistant", text), (2, "user", "x")]
        rows += [(k, t, r, c, 1) for t, r, c in turns]
        source[k] = [(r, c) for _, r, c in turns]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, segments int")
    out = chat_grammar.formatted(frame)
    for r in chat_grammar.read_back(out).collect():
        assert [(t["role"], t["text"]) for t in r["turns"]] == source[r["conv_id"]]
        assert r["loss_text"] == "".join(c for role, c in source[r["conv_id"]] if role == "assistant")
    plain = out.where("conv_id = 11").first()["formatted"]
    assert plain.count("<|im_start|>") == 3


def test_chat_nulls_ties_and_nothing(spark):
    schema = "conv_id bigint, turn bigint, role string, text string"
    rows = [(None, 0, "user", "a"), (1, 0, None, None), (1, None, "user", "z"), (1, 0, "a", "b"), (1, 0, "a", "b")]
    back = {r["conv_id"]: r["turns"] for r in chat_grammar.read_back(chat_grammar.formatted(spark.createDataFrame(rows, schema))).collect()}
    assert [tuple(t) for t in back[1]] == [("user", "z"), ("", ""), ("a", "b"), ("a", "b")]
    assert [tuple(t) for t in back[None]] == [("user", "a")]
    assert chat_grammar.formatted(spark.createDataFrame([], schema)).count() == 0


def test_parser_refuses_broken_text(spark):
    broken = ["", "x<|im_start|>a\nb<|im_end|>\n", "<|im_start|>a\nb", "<|im_start|>a b<|im_end|>\n", "<|im_start|>a\nb<|im_end|><|im_end|>\n"]
    frame = spark.createDataFrame([(b,) for b in broken], "t string")
    turns = [r[0] for r in frame.select(chat_grammar.parse(F.col("t"))).collect()]
    assert turns[0] == [] or turns[0] is None
    assert turns[1:] == [None] * 4


# -- Hilbert shards --------------------------------------------------------------


@pytest.mark.parametrize("dims,bits", [(2, 3), (3, 2)])
def test_curve_visits_every_cell_by_single_steps(spark, dims, bits):
    side = 1 << bits
    cells = list(itertools.product(range(side), repeat=dims))
    frame = spark.createDataFrame(cells, ", ".join(f"d{k} int" for k in range(dims)))
    index = hilbert_shards.hilbert_index([F.col(f"d{k}") for k in range(dims)], bits)
    path = [r[:dims] for r in sorted((tuple(r) for r in frame.select("*", index).collect()), key=lambda r: r[-1])]
    assert len(set(path)) == side**dims
    assert all(sum(abs(a - b) for a, b in zip(x, y)) == 1 for x, y in zip(path, path[1:]))


def test_shards_follow_the_curve_without_gaps(spark):
    rows = [(k % 190, "x" * (k * 7 % 300), "en" if k % 3 else None, "s") for k in range(203)]
    found = sorted(
        hilbert_shards.sharded(docs(spark, rows).repartition(5)).collect(), key=lambda r: (r["shard"], r["slot"])
    )
    order = [(r["curve"], r["doc_id"], r["text_crc32"], r["size"]) for r in found]
    assert order == sorted(order) and len(order) == 203
    counts = [sum(r["shard"] == s for r in found) for s in range(8)]
    assert max(counts) - min(counts) <= 1
    assert [r["slot"] for r in found] == [k for n in counts for k in range(n)]


def test_shards_of_odd_rows(spark):
    rows = [(1, None, None, None), (1, None, None, None), (None, "", "en", "s"), (2, "x" * 100_000, "en", "s")]
    found = hilbert_shards.sharded(docs(spark, rows)).collect()
    assert sorted(r["size"] for r in found) == [1, 1, 1, 100_001]
    assert sorted(r["shard"] for r in found) == [0, 2, 4, 6] and {r["slot"] for r in found} == {0}
    whole = hilbert_shards.sharded_rows(docs(spark, rows))
    assert whole.columns == ["doc_id", "text", "lang", "source", "in_shard", "n_words", "host", "shard", "slot"]
    assert whole.where("in_shard = 7").count() == 4
    # Whole rows are numbered where they are written, not dealt and sorted once more.
    assert "row_number" not in whole._jdf.queryExecution().toString()
    assert hilbert_shards.sharded(docs(spark, [])).count() == 0
    ranges = hilbert_shards.shard_ranges(whole, ["source", "lang"]).collect()
    assert sum(r["n_rows"] for r in ranges) == 4


def test_whole_rows_stage_no_text_and_get_the_places_of_the_operator(spark, monkeypatch):
    staged, save = [], hilbert_shards.Workspace.save
    monkeypatch.setattr(hilbert_shards.Workspace, "save", lambda self, df, name: staged.append(df.schema.simpleString()) or save(self, df, name))
    rows = [(None if k % 50 == 0 else k % 190, "x" * (k * 7 % 300), "en" if k % 3 else None, "s") for k in range(203)]
    frame = docs(spark, rows + [(7, "same", "en", "s")] * 40).repartition(5)
    ranges = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "4", "23"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        try:
            staged.clear()
            found = hilbert_shards.sharded_rows(frame).selectExpr(
                "doc_id", "octet_length(text) + 1L AS size", "shard", "slot", "spark_partition_id() AS part", "monotonically_increasing_id() AS at"
            ).collect()
            assert staged and not any("text:" in s or "row:" in s for s in staged)
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", ranges)
        want = hilbert_shards.sharded(frame).select("doc_id", "size", "shard", "slot").collect()
        assert sorted(map(str, (tuple(r[:4]) for r in found))) == sorted(map(str, map(tuple, want)))
        in_order = [(r["shard"], r["slot"]) for r in sorted(found, key=lambda r: r["at"])]
        assert in_order == sorted(in_order) and len({r["part"] for r in found}) > int(n) // 2


def test_a_staged_write_leaves_no_shuffle_behind(spark):
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {str(disk.getAllFiles().apply(k)) for k in range(disk.getAllFiles().size()) if "shuffle_" in str(disk.getAllFiles().apply(k))}

    cleaning = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, session = shuffles(), spark.conf.get(cleaning)
    saved = Workspace(spark, "t").save(spark.range(1000).repartition(3, "id"), "rows")
    for _ in range(50):
        if not shuffles() - before:
            break
        time.sleep(0.1)
    assert not shuffles() - before
    assert saved.count() == 1000 and spark.conf.get(cleaning) == session


# -- host rules ------------------------------------------------------------------


def brute(text):
    words = (text or "").encode().split()
    windows = {}
    for k in range(len(words) - 4):
        windows.setdefault(tuple(words[k : k + 5]), []).append(k)
    hit = {k + d for ks in windows.values() if len(ks) > 1 for k in ks for d in range(5)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(words), len(b"".join(words).decode()), sum(c in "#*$%&|<>" for c in text or ""),
        len(lines) - len(set(lines)), len(hit),
    )


def test_rule_counts_match_brute_force(spark):
    rng = random.Random(5)
    texts = [None, "", " \n\t", "a b a b a b a b a b a b", "é# $x\n\n a\n a\né# $x", "w " * 20_000]
    texts += ["".join(rng.choice("ab \n#") for _ in range(rng.randrange(200))) for _ in range(60)]
    texts += [" ".join(rng.choice(["x", "yy", "z\x0b"]) for _ in range(40)) for _ in range(40)]
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)]
    for r in host_rules.host_filtered(docs(spark, rows)).collect():
        expected = brute(texts[r["doc_id"]])
        assert tuple(r)[1:6] == expected
        n, _, _, _, repeated = expected
        assert r["base_failed"] == (n < 10 or 100 * repeated > 20 * n)


def test_bad_hosts_take_their_documents_along(spark):
    good = "one two three four five six seven eight nine ten eleven"
    rows = [(k, "short", "en", "bad") for k in range(40)] + [(100, good, "en", "bad"), (101, good, "en", None)]
    rows += [(200 + k, good, "en", f"ok{k % 5}") for k in range(60)] + [(300, None, "en", "ok1")] * 2
    kept = {r["doc_id"]: r["kept"] for r in host_rules.host_filtered(docs(spark, rows)).collect()}
    assert not kept[100] and kept[101] and kept[200] and not kept[300] and not kept[0]
    assert host_rules.host_filtered(docs(spark, [])).count() == 0


