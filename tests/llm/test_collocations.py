"""Collocations against their SQL and brute force, and the automata they are counted by."""

import random
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from listenlytics.llm import collocations as c
from listenlytics.llm.collocations import COLLOCATIONS_SQL, Transducer, collocations, sorted_transducer
from listenlytics.llm.queries import op13_phrase_collocations


def brute_force(rows, least, max_words, top):
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in range(1, max_words + 1):
                for i in range(len(words) - k + 1):
                    counts.setdefault(lang, Counter())[tuple(words[i : i + k])] += 1
    found = []
    for lang, f in counts.items():
        chosen = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in chosen.items():
            longer = (q for q in chosen if len(q) > len(p) and chosen[q] >= a)
            if any(p == q[i : i + len(p)] for q in longer for i in range(len(q) - len(p) + 1)):
                continue
            score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            found.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(found)


def some_rows(rnd, n):
    vocabulary = ["a", "B", "b", "cé", "d", "e", "zß", "x-y", "日本", "f"]
    rows = []
    for _ in range(n):
        words = []
        for _ in range(rnd.choice([0, 1, 3, 40])):
            words += rnd.choice([[rnd.choice(vocabulary)], ["new", "York", "City"], ["of", "the", "same", "old", "kind"]])
            words.append(rnd.choice([" ", "  ", "\t", " ", ". ", "\n", "?"]))
        text = "".join(w if w.strip(" \t.\n?") == "" else w + " " for w in words)
        rows.append((rnd.choice(["en", "en", "de", None, "und", ""]), rnd.choice([text, text, None]) if rnd.random() < 0.2 else text))
    return rows


@pytest.mark.parametrize(("least", "max_words", "portion"), [(3, 5, 1 << 19), (20, 5, 50), (2, 3, 1 << 19)])
def test_equal_brute_force(spark, monkeypatch, least, max_words, portion):
    monkeypatch.setattr(c, "PORTION", portion)  # small ones give a task many transducers
    rows = some_rows(random.Random(least), 150)
    docs = spark.createDataFrame([(*row, 1) for row in rows], "lang string, text string, phrase long")
    found = collocations(docs.repartition(5), min_count=least, max_words=max_words, top=40)
    assert sorted(tuple(r) for r in found.collect()) == brute_force(rows, least, max_words, 40)


def test_query_equals_sql(spark):
    sf_dir = "/root/testdata/sf0.01"  # the smallest one has few phrases a hundred times
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    expected = con.sql(COLLOCATIONS_SQL)
    found = op13_phrase_collocations(spark, sf_dir)
    assert found.columns == expected.columns
    rows = sorted(tuple(r) for r in found.collect())
    assert rows and rows == sorted(expected.fetchall())


def test_products_beyond_64_bits(spark, monkeypatch):
    from pyspark.sql import functions as F

    big = 10**12
    counts = spark.createDataFrame(
        [("en", "a b", big + 7, 2), ("en", "a", 3 * big + 1, 1), ("en", "b", big + 11, 1), ("en", None, 10**13 - 3, 1)],
        "lang string, phrase string, f long, k int",
    )
    monkeypatch.setattr(c, "phrase_counts", lambda *_: counts)
    row = collocations(spark.range(1).select(F.lit("en").alias("lang"), F.lit("").alias("text"))).first()
    assert row.score == 1000 * (big + 7) * (10**13 - 3) // ((3 * big + 1) * (big + 11))


def test_odd_rows(spark):
    docs = spark.createDataFrame([(None, None), ("en", ""), ("en", " .,\n"), ("en", "a b " * 300)], "lang string, text string")
    rows = [(None, None), ("en", "a b " * 300)]
    assert sorted(tuple(r) for r in collocations(docs).collect()) == brute_force(rows, 100, 5, 2000)
    assert collocations(docs.limit(0)).count() == 0
    broken = spark.sql("SELECT 'en' AS lang, cast(unhex(repeat('ff20', 200)) AS string) AS text")
    assert sorted(row.phrase.split(" ") for row in collocations(broken).collect()) == [["�"] * k for k in range(2, 6)]


def some_phrases(rnd, n):
    labels = [b"", b"a", b"ab", b"b", "é".encode(), b"z"]
    rows = {tuple(rnd.randrange(len(labels)) for _ in range(rnd.randrange(1, 6))) for _ in range(n)}
    padded = np.array([list(r) + [-1] * (5 - len(r)) for r in rows], np.int64)
    weights = np.array([rnd.choice([1, 1, 2, 10**12]) for _ in rows], np.int64)
    words = {tuple(labels[i] for i in r): w for r, w in zip(rows, weights.tolist(), strict=True)}
    return sorted_transducer(labels, padded, weights), words


def read(transducer):
    rows, weights = transducer.paths()
    return {
        tuple(transducer.labels[i] for i in row if i >= 0): w for row, w in zip(rows.tolist(), weights.tolist(), strict=True)
    }


def test_transducers_hold_their_phrases():
    rnd = random.Random(1)
    for n in (1, 5, 60, 600):
        given, words = some_phrases(rnd, n)
        assert read(given) == words
        assert read(Transducer.from_bytes(given.to_bytes())) == words
        other, others = some_phrases(rnd, n)
        here, there = given.composed(other)
        assert sorted(zip(here.tolist(), there.tolist(), strict=True)) == sorted(
            (w, others[p]) for p, w in words.items() if p in others
        )


def test_equal_futures_are_one_state():
    # the continuations of all first words are the same, so they share their states
    rows = np.array([[i, 10, 11] for i in range(10)] + [[i, 10, 12] for i in range(10)], np.int64)
    labels = [b"%02d" % i for i in range(13)]
    made = sorted_transducer(labels, rows, np.ones(20, np.int64))
    assert len(made.weights) == 10 + 1 + 2 and len(made.offsets) - 1 == 4
