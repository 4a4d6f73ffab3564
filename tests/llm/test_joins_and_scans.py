"""Jaccard join, decontamination, licenses, hosts, pages and the pipeline, against brute force."""

from __future__ import annotations

import os
import random
import re
import sys

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from listenlytics.llm import benchmarks, hosts, jaccard, licenses, pages, queries
from listenlytics.llm.components import components

ASCII_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark, sf_dir, name):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Jaccard join


def brute_components(rows, percent=90, size=3):
    sets = {}
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(ASCII_LOWER))
        many = len(words) >= size
        sets[i] = {tuple(words[k : k + size]) for k in range(len(words) - size + 1)} if many else {tuple(words)} - {()}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            x, y = sets[a], sets[b]
            small, large = sorted((len(x), len(y)))
            if small and 100 * small >= percent * large:
                common = len(x & y)
                if 100 * common >= percent * (len(x) + len(y) - common):
                    a_root, b_root = root(a), root(b)
                    parent[max(a_root, b_root)] = min(a_root, b_root)
    return {i: (len(sets[i]), root(i)) for i in sets}


def check_components(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, "r") for i, t in rows], "doc_id long, text string, key int, region string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.jaccard_components(docs).collect()}
    assert got == brute_components(rows)


def test_given_documents(spark, sf_dir):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, sf_dir, "documents").collect()]
    check_components(spark, rows)


def near_copies(rng, base, n, most):
    for _ in range(n):
        words = list(base)
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(len(words))] = f"new{rng.randrange(10**9)}"
        yield " ".join(words)


@pytest.mark.parametrize("pairs_per_member", [0, 16])
def test_crowded_regions(spark, monkeypatch, pairs_per_member):
    """Far more near copies than a region may compare in pairs, in chains and next to each other."""
    monkeypatch.setattr(jaccard, "SMALL", 4)
    monkeypatch.setattr(jaccard, "GROWTH", 3)
    monkeypatch.setattr(jaccard, "PAIRS_PER_MEMBER", pairs_per_member)
    rng = random.Random(6)
    base = [f"w{k}" for k in range(120)]
    other = [f"v{k}" for k in range(60)] + base[:60]
    texts = [*near_copies(rng, base, 70, 6), *near_copies(rng, other, 30, 3)]
    texts += [" ".join(base[:60] + [f"u{i}_{k}" for k in range(20)]) for i in range(30)]  # one shared passage
    texts += [" ".join(base[k : k + 100]) for k in range(0, 20, 2)]  # a chain
    rng.shuffle(texts)
    check_components(spark, list(enumerate(texts)))


def test_pairs_of_a_crowd_grow_with_its_members(spark, monkeypatch):
    """Near copies of one text meet the pivots, not one another, however few the crowds are for the input."""
    made = []

    def counted(df, folder, write=jaccard.written):
        table = write(df, folder)
        if "/pairs-" in folder:
            made.append(table.count())
        return table

    monkeypatch.setattr(jaccard, "written", counted)
    rng = random.Random(5)
    pairs = []
    for n in (30, 90):
        base = [f"w{k}" for k in range(150)]
        twins = [f"{end} " + " ".join(f"l{i}_{k}" for k in range(60)) for i in range(600) for end in "xy"]
        check_components(spark, list(enumerate([" ".join(base), *near_copies(rng, base, n, 3), *twins])))
        pairs.append(sum(made) - 600)
        made.clear()
    assert pairs[1] <= 5 * pairs[0] and pairs[1] < 90 * 12


def test_few_rows_are_written_as_few_files(spark, monkeypatch, tmp_path):
    """Tables of a small join do not become a file for each shuffle partition, though Spark merges none."""
    files = {}

    def listed(df, folder, write=jaccard.written):
        table = write(df, folder)
        files[os.path.basename(folder).rsplit("-", 1)[0], len(files)] = len(table.inputFiles())
        return table

    for module in (jaccard, sys.modules[components.__module__]):
        monkeypatch.setattr(module, "written", listed)
    monkeypatch.setattr(jaccard, "SMALL", 4)
    monkeypatch.setattr(jaccard, "PAIRS_PER_MEMBER", 0)
    rng = random.Random(8)
    base = [f"w{k}" for k in range(100)]
    rows = list(enumerate([*near_copies(rng, base, 40, 3), *(f"a{i // 2} b c d e f" for i in range(200))]))
    settings = {"spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {name: spark.conf.get(name) for name in settings}
    try:
        for name, value in settings.items():
            spark.conf.set(name, value)
        found = jaccard.jaccard_components(spark.createDataFrame(rows, "doc_id long, text string"))
        found.write.parquet(str(tmp_path / "found"))
        jaccard.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).count()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found.collect()} == brute_components(rows)
    files["result", 0] = len(list((tmp_path / "found").glob("*.parquet")))
    assert {name for name, _ in files} >= {"classes", "regions", "members", "pairs", "found", "near", "links", "judged"}
    by_texts = ("described", "windows", "sets")  # as many as the tasks that read the texts
    assert {place: n for place, n in files.items() if n > 1 and place[0] not in by_texts} == {}


def test_small_regions_pair_each_member_once(spark):
    rows = [(1, b"a", 20, 0), (1, b"b", 20, 1), (1, b"c", 20, 0), (1, b"a", 20, 0), (2, b"d", 20, 0), (2, b"e", 10, 0),
            (3, b"f", 20, 0), (3, b"g", 20, 9), (4, b"h", 20, 0)]
    windows = spark.createDataFrame(rows, "region long, key binary, n long, place long")
    regions = spark.createDataFrame([(1,), (2,), (3,)], "region long")
    pairs = jaccard._pairs_of_small(windows, regions, 90).collect()
    got = sorted((bytes(r["key_a"]), bytes(r["key_b"])) for r in pairs)
    assert got == [(b"a", b"b"), (b"a", b"c"), (b"b", b"c")]


def test_signatures_rule_out_no_link():
    rng = np.random.default_rng(4)
    passed = 0
    for n in (1, 2, 63, 64, 65, 120, 128, 129, 1000, 4100):
        for share in (0.0, 0.5, 0.8, 0.85, 0.9, 0.95, 1.0):
            a = np.unique(rng.integers(0, 1 << 63, n).astype(np.uint64))
            b = np.union1d(a[: int(n * share)], rng.integers(0, 1 << 63, n // 20).astype(np.uint64))
            if not len(b):
                continue
            sides = [pa.scalar(jaccard._signature(x), pa.binary()) for x in (a, b)]
            common = len(np.intersect1d(a, b))
            for percent in (80, 90):
                passes = jaccard._signature_passes(*sides, len(a) + len(b), percent)
                assert passes or 100 * common < percent * (len(a) + len(b) - common)
                assert not (passes and n >= 1000 and share == 0.5)  # long texts are told apart as well
                passed += passes
    assert passed


def test_short_texts_and_ties(spark):
    texts = ["", None, " ", "a", "A", "a b", "a b", "a b c", "A B C", "a b c a b c", "b a", "é É", "x" * 50, "a b c d"]
    check_components(spark, list(enumerate(texts)))


def test_repeated_rows_null_ids_and_empty(spark):
    text = " ".join(f"w{k}" for k in range(50))
    docs = spark.createDataFrame([(3, text), (3, text), (None, text), (5, text), (7, None)], "doc_id long, text string")
    got = sorted((tuple(r) for r in jaccard.jaccard_components(docs).collect()), key=str)
    assert got == sorted([(3, 48, 3), (3, 48, 3), (None, 48, None), (5, 48, 3), (7, 0, 7)], key=str)
    assert sorted(r["doc_id"] or 0 for r in jaccard.one_of_each(docs).collect()) == [0, 3, 7]
    assert jaccard.jaccard_components(docs.limit(0)).count() == 0


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 101), (5, 5), (None, 3)], "a long, b long")
    found = {r["node"]: r["component"] for r in components(links).collect()}
    assert found == {**dict.fromkeys(range(1, 41), 1), 100: 100, 101: 100}


# Decontamination


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(ASCII_LOWER))


def brute_distance(item, text):
    """Least word edit distance of the item to any stretch of the text."""
    row = [0] * (len(text) + 1)
    for i, word in enumerate(item, 1):
        new = [i]
        for j, other in enumerate(text, 1):
            new.append(min(row[j - 1] + (word != other), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)


def test_best_stretch():
    rng = np.random.default_rng(7)
    for _ in range(200):
        item, text = rng.integers(0, 6, rng.integers(1, 9)), rng.integers(0, 6, rng.integers(0, 25))
        edits, start, end = benchmarks.best_stretch(item.astype(np.uint64), text.astype(np.uint64))
        assert edits == brute_distance(item.tolist(), text.tolist())
        assert edits == brute_distance(item.tolist(), text[start:end].tolist()) and 0 <= start <= end <= len(text)


def test_given_items_are_found(spark, sf_dir):
    items = [(r["item_id"], words_of(r["text"])) for r in table(spark, sf_dir, "benchmark").collect()]
    docs = [(r["doc_id"], words_of(r["text"])) for r in table(spark, sf_dir, "documents").collect()]
    wanted = {}
    for doc, text in docs:
        for item, words in items:
            shared = {tuple(words[k : k + 3]) for k in range(len(words) - 2)}
            if any(tuple(text[k : k + 3]) in shared for k in range(len(text) - 2)):
                distance = brute_distance(words, text)
                if distance <= benchmarks.max_edits(len(words)):
                    wanted[doc, item] = distance
    found = queries.op5_benchmark_decontamination(spark, sf_dir).collect()
    assert wanted and {(r["doc_id"], r["item_id"]): r["edits"] for r in found} == wanted


def test_edited_items_reach_the_recall():
    rng = random.Random(8)
    vocabulary = [f"w{k}" for k in range(400)]
    items = [[rng.choice(vocabulary) for _ in range(rng.randint(12, 60))] for _ in range(60)]
    texts, truth = [], set()
    for number, item in enumerate(items):
        for _ in range(4):
            words = list(item)
            for _ in range(benchmarks.max_edits(len(item))):
                place, kind = rng.randrange(len(words)), rng.randrange(3)
                words[place : place + (kind > 0)] = [] if kind == 2 else [f"x{rng.randrange(10**9)}"]
            around = [[rng.choice(vocabulary) for _ in range(rng.randint(0, 80))] for _ in range(2)]
            truth.add((len(texts), number))
            texts.append(" ".join([*around[0], *words, *around[1]]))
    rows = list(benchmarks.word_rows(pa.array([" ".join(item) for item in items])))
    index = benchmarks.build_index(list(range(60)), rows, benchmarks.SHARE, benchmarks.RECALL)
    found = benchmarks.find_items(pa.array(texts), index)
    got = {(text, item) for text, one in enumerate(found) for item, *_ in one}
    assert len(got & truth) / len(truth) >= 0.9


@pytest.mark.parametrize("edit", ["delete", "insert", "replace"])
@pytest.mark.parametrize("n_words", [12, 60, 200])
def test_one_kind_of_edits_at_the_limit(n_words, edit):
    """Deletions let foreign words into the window, so a sampler must be measured on them alone."""
    rng = random.Random(n_words)
    items = [[f"w{rng.randrange(3000)}" for _ in range(n_words)] for _ in range(40)]
    texts = []
    for item in items:
        words = list(item)
        for _ in range(benchmarks.max_edits(n_words)):
            place = rng.randrange(len(words))
            words[place : place + (edit != "insert")] = [] if edit == "delete" else [f"x{rng.randrange(10**9)}"]
        around = [f"w{rng.randrange(3000)}" for _ in range(200)]
        texts.append(" ".join([*around[:100], *words, *around[100:]]))
    rows = list(benchmarks.word_rows(pa.array([" ".join(item) for item in items])))
    index = benchmarks.build_index(list(range(len(items))), rows, benchmarks.SHARE, benchmarks.RECALL)
    found = benchmarks.find_items(pa.array(texts), index)
    assert sum(number in {item for item, *_ in one} for number, one in enumerate(found)) >= 0.95 * len(items)


def test_long_items_reach_the_recall_beside_short_ones():
    rng = random.Random(12)
    lengths = [rng.randint(4, 12) for _ in range(190)] + [100, 130, 170, 200, 250, 300]
    items = [[f"w{rng.randrange(3000)}" for _ in range(n)] for n in lengths]
    rows = list(benchmarks.word_rows(pa.array([" ".join(item) for item in items])))
    index = benchmarks.build_index(list(range(len(items))), rows, benchmarks.SHARE, benchmarks.RECALL)
    assert min(index.recalls.values()) >= benchmarks.RECALL
    texts, truth = [], []
    for number in range(190, 196):
        for _ in range(5):
            words = list(items[number])
            for place in rng.sample(range(len(words)), benchmarks.max_edits(len(words))):
                words[place] = f"x{rng.randrange(10**9)}"
            texts.append(" ".join(words))
            truth.append(number)
    found = benchmarks.find_items(pa.array(texts), index)
    hits = sum(number in [f[0] for f in one] for number, one in zip(truth, found, strict=True))
    assert hits >= 0.95 * len(truth)


def test_items_cut_off_at_a_texts_edge():
    rng = random.Random(10)
    items = [[f"w{n}x{k}" for k in range(rng.randint(20, 50))] for n in range(40)]
    rows = list(benchmarks.word_rows(pa.array([" ".join(item) for item in items])))
    index = benchmarks.build_index(list(range(40)), rows, benchmarks.SHARE, benchmarks.RECALL)
    for first_in_block in (True, False):
        for cut, at_start in ((2, True), (3, True), (5, True), (3, False), (5, False)):
            hits = 0
            for number, item in enumerate(items):
                other = " ".join(f"o{k}" for k in range(60))
                text = [*item[cut:], *other.split()] if at_start else [*other.split(), *item[:-cut]]
                texts = [" ".join(text), other] if first_in_block else [other, " ".join(text), other]
                found = benchmarks.find_items(pa.array(texts), index)
                assert not any(one for k, one in enumerate(found) if k != (not first_in_block))
                wanted = cut if cut <= benchmarks.max_edits(len(item)) else None
                hits += [f[:2] for f in found[not first_in_block]] == ([(number, wanted)] if wanted else [])
            assert hits >= 0.95 * len(items)


def test_odd_documents_and_items(spark):
    item = "the quick brown fox jumps over the lazy dog near the river bank today"
    docs = spark.createDataFrame(
        [(1, f"x {item.upper()}! y", 0), (1, f"x {item.upper()}! y", 0), (2, None, 0), (3, "", 0), (None, item, 0),
         (4, "pad " * 100_000 + item + " pad" * 1000, 0), (5, item[: len(item) // 2], 0)],
        "doc_id long, text string, found int",
    )
    benchmark = spark.createDataFrame(
        [(7, item), (7, item), (8, None), (9, ""), (None, item), (10, "fox")], "item_id long, text string"
    )
    rows = [tuple(r) for r in benchmarks.contaminations(docs, benchmark).collect()]
    assert sorted(r for r in rows if r[1] == 7 and r[0]) == [(1, 7, 0, 1, 15), (1, 7, 0, 1, 15), (4, 7, 0, 100_000, 100_014)]
    assert {r[0] for r in rows if r[1] == 10} == {1, None, 4, 5}
    left = benchmarks.without_contaminated(docs, benchmark.where("item_id = 7"))
    assert sorted(r["doc_id"] for r in left.collect()) == [2, 3, 5] and left.columns == docs.columns
    assert benchmarks.contaminations(docs, benchmark.limit(0)).count() == 0
    assert benchmarks.contaminations(docs.limit(0), benchmark).count() == 0


def test_many_items_take_several_passes(spark, monkeypatch, sf_dir):
    once = {tuple(r) for r in queries.op5_benchmark_decontamination(spark, sf_dir).collect()}
    monkeypatch.setattr(benchmarks, "MAX_ITEMS", 7)
    assert {r[:2] for r in once} == {tuple(r)[:2] for r in queries.op5_benchmark_decontamination(spark, sf_dir).collect()}


# Licenses


def test_base_phrases_and_notices(spark):
    texts = [
        (1, "Under the GNU General Public License. The gnu-general public   license!"),
        (2, "Released under the MIT License."), (3, "CC BY-NC 4.0, licensed under CC BY-NC 4.0."),
        (4, None), (5, ""), (None, "apache license"), (6, "mit LICENSE mit license mitlicense"),
        (6, "mit LICENSE mit license mitlicense"), (7, "x " * 100_000 + "Apache License"),
        (8, "Licensed under the very Apache License, Version 2.0."), (9, "gnu public license é"),
    ]
    docs = spark.createDataFrame([(i, t, 1, "z") for i, t in texts], "doc_id long, text string, place int, _row string")
    rows = licenses.license_scan(docs).collect()
    assert len(rows) == 11
    by_id = {r["doc_id"]: r for r in rows}
    base = {i: (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) for i, r in by_id.items()}
    assert base[1] == (11, 2, 2, 7, "gpl")
    assert base[2] == (5, 1, 3, 3, "mit")
    assert base[3][1:] == (2, 0, 7, "cc-by") and by_id[3]["labels"] == "cc-by,cc-by-nc"
    assert base[4] == base[5] == (0, 0, None, None, "")
    assert base[None][1] == 1 and base[6] == (5, 2, 0, 2, "mit") and base[7][:3] == (100_002, 1, 100_000)
    assert by_id[8]["labels"] == "apache,apache-2.0" and by_id[8]["score"] == 1.0
    assert base[9] == (4, 0, None, None, "")
    assert licenses.license_scan(docs.limit(0)).count() == 0


def test_native_plans(spark, sf_dir):
    for query in (queries.op1_url_filter, queries.op10_license_scans):
        plan = query(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Pandas|Arrow", plan)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_against_sql(spark, sf_dir, name):
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for view in ("documents", "pages", "labels", "benchmark", "conversations"):
        con.sql(f"CREATE VIEW {view} AS SELECT * FROM '{sf_dir}/{view}.parquet'")
    got = queries.QUERIES[name](spark, sf_dir)
    wanted = con.sql(queries.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(wanted.columns)
    order = [wanted.columns.index(c) for c in got.columns]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str(tuple(r[k] for k in order)) for r in wanted.fetchall())


# Hosts


def test_hosts_paths_and_rules(spark):
    urls = [
        (1, "https://A.Example.NET/en/x?q=1#f", "example.net/en/", "allow"), (2, "http://example.net", None, "allow"),
        (3, "http://x.net/?a", "net/", "block"), (4, "ftp://example.com/de/1", "example.com/de/", "block"),
        (5, "http://notexample.com/de/", None, "allow"), (6, "http://wiki.org/fr/a://b", "org/fr/", "allow"),
        (7, None, None, "allow"), (8, "no scheme/net/", None, "allow"), (None, "http://x.net/a", "net/", "block"),
        (1, "https://A.Example.NET/en/x?q=1#f", "example.net/en/", "allow"),
    ]
    frame = spark.createDataFrame([(i, u, "h", "p") for i, u, _, _ in urls], "page_id long, url string, host string, path string")
    outcomes = spark.createDataFrame([(1, True), (2, None), (None, True)], "page_id long, good boolean")
    for known in (outcomes, outcomes.limit(0)):
        rows = hosts.judge_urls(frame, known).collect()
        got = sorted(((r["page_id"], r["rule"], r["verdict"]) for r in rows), key=str)
        assert got == sorted(((i, rule, verdict) for i, _, rule, verdict in urls), key=str)
    by_id = {r["page_id"]: (r["host"], r["path"]) for r in rows}
    assert by_id[1] == ("a.example.net", "/en/x") and by_id[2] == ("example.net", "") and by_id[7] == ("", "")
    assert by_id[6] == ("wiki.org", "/fr/a://b") and by_id[8] == ("", "")
    assert hosts.judge_urls(frame.limit(0), outcomes).count() == 0


def test_bad_hosts_are_blocked_and_shrunk(spark):
    pages_rows = [(h * 1000 + k, f"http://h{h}.a.com/{k}") for h in range(20) for k in range(60)]
    pages_rows += [(50_000 + k, f"http://new.a.com/{k}") for k in range(3)]
    labels = [(h * 1000 + k, h != 3) for h in range(20) for k in range(40 if h else 1)]
    frame = spark.createDataFrame(pages_rows, "page_id long, url string")
    outcomes = spark.createDataFrame(labels, "page_id long, good boolean")
    verdicts = {r["host"]: r["verdict"] for r in hosts.judge_urls(frame, outcomes).collect()}
    assert [h for h, v in verdicts.items() if v == "block"] == ["h3.a.com"]
    shares = {r["host"]: r for r in hosts.host_reputation(frame, outcomes).collect()}
    assert shares["h0.a.com"]["mean"] < shares["h1.a.com"]["mean"]
    assert shares["new.a.com"]["n"] == 0 and shares["new.a.com"]["lower"] < shares["h1.a.com"]["lower"]


# Pages

PAGE = (
    "<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a='</p>';</script></head>"
    "<body class='has-sidebar'><header>Site</header><nav><ul><li><a href='/'>Home</a></li></ul></nav>"
    "<div class='cookie-notice'>We use cookies</div><!-- <p>gone</p> --><article id=post-1><h1>Head &amp; line</h1>"
    "<p>First&nbsp;<b>bold<i>er</b> text<br>next<p>Second &lt;p&gt; &#8212; done</p><form><input>Send</form>"
    "<ul><li>one<li>two</ul><aside>Side</aside><div class=ad>Buy</div><section class='comments'>Nice!</section>"
    "</article><div id='sidebar'>Links</div><footer>&copy; x</footer></body></html>"
)
TEXT = "Head & line First bolder text next Second <p> — done one two"


def test_one_page():
    page = pages.read_page(PAGE)
    assert pages.best_container(page)[0] == "/body.has-sidebar/article"
    assert pages.text_on_path(page, [])[0] == TEXT
    assert pages.text_on_path(pages.read_page(None), ["/body"]) == ("", None)
    assert pages.text_on_path(pages.read_page("plain < text"), []) == ("plain < text", None)


@pytest.mark.parametrize("wrapper", ["class='content has-sidebar'", "class=no-comments", "id=page-search", "class=widget"])
@pytest.mark.parametrize("inside", ["<article>{}</article>", "<h1>Head</h1>{}", "{}"])
def test_wrappers_with_side_words_keep_the_article(wrapper, inside):
    text = "<p>The story goes on</p><div class=share>Share this</div>"
    rest = "<div class=sidebar>Other pages</div>"
    page = pages.read_page(f"<body><div {wrapper}>{inside.format(text)}</div>{rest}</body>")
    got = pages.text_on_path(page, [])[0]
    assert got == ("Head " if "h1" in inside else "") + "The story goes on"
    only = pages.read_page(f"<body><span {wrapper}><p>Story</p></span></body>")
    assert pages.text_on_path(only, [])[0] == "Story"
    comments = "<section class=comments><article><p>Nice</p></article></section>"
    page = pages.read_page(f"<body><article><h1>Head</h1><p>A long story</p>{comments}</article></body>")
    assert pages.text_on_path(page, [])[0] == "Head A long story"
    same = pages.read_page("<body><div class=ad>Buy</div><div class=menu>See</div></body>")
    assert pages.text_on_path(same, [])[0] == "Buy See"


def test_lead_and_tail_belong_to_the_article(spark):
    """A container inside counts only when it holds all unlinked blocks of the one round it."""
    body = "<p>" + "long body " * 500 + "</p>"
    whole = "<body><div class=post><p>The lead stands above</p><div class=entry>{}</div><p>The tail below</p></div></body>"
    bare = "<body><div class=post><p><a href='/'>All posts</a></p><div class=entry>{}</div></div></body>"
    assert pages.best_container(pages.read_page(whole.format(body)))[0] == "/body/div.post"
    assert pages.best_container(pages.read_page(bare.format(body)))[0] == "/body/div.post/div.entry"
    rows = [(k, f"http://h.org/{k}", (bare if k % 2 else whole).format(body)) for k in range(9)]
    rows += [(k, f"http://h.org/{k}", bare.format(body)) for k in range(9, 14)]
    rows.append((20, "http://h.org/20", whole.format("<p>Short body here</p>")))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    found = {r["page_id"]: r["text"] for r in pages.extract_pages(frame).collect()}
    assert found[20] == "The lead stands above Short body here The tail below"
    assert all(("lead" in found[k] and "tail" in found[k]) == (k < 9 and k % 2 == 0) for k in range(14))


def test_hosts_agree_on_a_path(spark):
    """A page whose own best container is a list of links follows its host's other pages."""
    good = "<body><div class=main>{}</div><div class=list>{}</div></body>"
    rows = [(k, f"http://h.org/{k}", good.format("<p>" + "text " * 50, "short")) for k in range(30)]
    rows += [(90, "http://h.org/90", good.format("brief", "<p>" + "teaser " * 60)), (91, None, None), (92, "x", "")]
    rows += [(None, "http://h.org/n", good.format("brief", "<p>" + "teaser " * 60)), (90, "http://h.org/90", rows[30][2])]
    frame = spark.createDataFrame([(i, u, h, "t") for i, u, h in rows], "page_id long, url string, html string, paths string")
    found = pages.extract_pages(frame).collect()
    assert len(found) == len(rows)
    by_id = {r["page_id"]: r for r in found}
    assert by_id[90]["text"] == "brief" and by_id[None]["n_chars"] == 5
    assert by_id[91]["text"] == by_id[92]["text"] == "" and by_id[91]["n_chars"] == 0
    assert pages.extract_pages(frame.limit(0)).count() == 0


def test_given_pages_give_their_articles(spark, sf_dir):
    import html

    found = {r["page_id"]: r["text"] for r in queries.op2_html_extraction(spark, sf_dir).collect()}
    for row in table(spark, sf_dir, "pages").collect():
        article = re.search("<article>(.*)</article>", row["html"], re.S)[1]
        bare = html.unescape(re.sub("<[^>]*>", " ", article))
        assert found[row["page_id"]] == " ".join(bare.split())


# Pipeline


def test_pipeline(spark, sf_dir):
    stages = corpus_pipeline.STAGES
    assert len(stages) == 5
    docs = table(spark, sf_dir, "documents")
    columns, before = docs.columns, docs.count()
    for place, (_, stage) in enumerate(stages):
        docs = stage(spark, docs, sf_dir).cache()
        if place < 4:
            assert docs.columns == columns
        if place < 3:
            now = docs.count()
            assert 0 < now < before
            before = now
        if place == 3:
            texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert len(texts) == before
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} == set(texts)
    tiktoken, public_tokenizers = pytest.importorskip("tiktoken"), pytest.importorskip("public_tokenizers")
    from listenlytics.llm.bpe import read_ranks

    path, pattern = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=read_ranks(path), special_tokens={})
    for row in rows:
        assert np.frombuffer(row["ids"], "<u4").tolist() == library.encode_ordinary(texts[row["doc_id"]])


def test_pipeline_keeps_one_of_near_copies(spark, sf_dir):
    """The stage links by five-word shingles at 0.8, wider than op6 does."""
    rng = random.Random(9)
    texts = [r["text"] for r in table(spark, sf_dir, "documents").collect()]
    for k in range(10):
        base = [f"b{k}_{j}" for j in range(200)]
        texts += [" ".join(base), *near_copies(rng, base, 4, 6), " ".join([*base, *(f"t{k}_{j}" for j in range(30))])]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    left = {r["doc_id"] for r in corpus_pipeline.jaccard_join(spark, docs, sf_dir).collect()}
    wide, narrow = (
        {i for i, (_, root) in brute_components(enumerate(texts), *limits).items() if root == i}
        for limits in ((80, 5), (90, 3))
    )
    assert left == wide and len(narrow) > len(wide)


def test_pipeline_on_an_empty_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf_dir)
    assert docs.count() == 0
