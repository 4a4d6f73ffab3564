"""Periodic runs against brute force, and chats against their SQL and round trips."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from listenlytics.llm import chats
from listenlytics.llm.chats import CHATS_SQL, PART, chat_digests, escape, format_chats, read_chats, unescape
from listenlytics.llm.periodic import Grammar, periodic_runs, run_digests
from listenlytics.llm.queries import op11_periodic_runs, op12_chat_formatting

# Periodic runs


def runs_of(words, least=6, exponent=4):
    found = {}
    for q in range(1, len(words) // exponent + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(least, exponent * q):
                found.setdefault((i, j + q - i), q)
            i = j
    return sorted((start, length, q) for (start, length), q in found.items())


def collapsed_of(words, runs):
    gone = {i for start, length, q in runs for i in range(start + q, start + length)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def some_words(rnd):
    alphabet = "abcdefgh"[: rnd.choice([1, 2, 3, 8])]
    words = [rnd.choice(alphabet) for _ in range(rnd.choice([0, 1, 6, 20, 90, 300]))]
    if words and rnd.random() < 0.6:
        a = rnd.randrange(len(words))
        p = 1 + (len(words) - a) // rnd.choice([3, 4, 5, 6, 9])
        words = words[:a] + [words[a + i % p] for i in range(len(words) - a)]
    return words


@pytest.mark.parametrize("exponent", [2, 4])
def test_runs_equal_brute_force(spark, exponent):
    rnd = random.Random(exponent)
    texts = [some_words(rnd) for _ in range(300)] + [["x"] * 5000, list("ab") * 3000 + ["c"] + list("ab") * 9]
    rows = [(i, "  ".join(words), "extra") for i, words in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string")
    found = {row.doc_id: row for row in periodic_runs(docs, min_exponent=exponent).collect()}
    for i, words in enumerate(texts):
        expected = runs_of(words, exponent=exponent)
        assert [tuple(run) for run in found[i].runs] == expected
        assert found[i].collapsed == collapsed_of(words, expected) and found[i].n_words == len(words)


def test_runs_of_odd_rows(spark):
    rows = [(None, "a a a a a a"), (1, None), (1, ""), (2, "a a a a a a"), (2, "a a a a a a"), (3, " \t\n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = sorted((row.doc_id or 0, len(row.runs), row.collapsed) for row in periodic_runs(docs).collect())
    assert found == [(0, 1, "a"), (1, 0, ""), (1, 0, ""), (2, 1, "a"), (2, 1, "a"), (3, 0, "")]
    assert periodic_runs(docs.limit(0)).count() == 0 and run_digests(docs.limit(0)).count() == 0


def test_runs_of_texts_that_are_not_utf8(spark):
    docs = spark.sql("SELECT 1 AS doc_id, cast(unhex('ff20ff20ff20ff20ff20ff') AS string) AS text")
    assert periodic_runs(docs).first().runs[0].length == 6


def test_extensions_equal_direct_comparison():
    import numpy as np

    rnd = random.Random(3)
    for _ in range(60):
        n = rnd.choice([2, 5, 40, 400])
        symbols = np.array([100, *[rnd.randrange(rnd.choice([1, 2, 4])) for _ in range(n)], 101])
        pairs = [rnd.sample(range(1, n + 1), 2) for _ in range(50)]
        a, b = (np.array(side) for side in zip(*pairs, strict=True))
        grammar = Grammar(symbols)
        for step in (1, -1):
            expected = []
            for x, y in pairs:
                k = 0
                while symbols[x + step * k] == symbols[y + step * k]:
                    k += 1
                expected.append(k)
            assert grammar.extension(a, b, step).tolist() == expected


def test_run_query_equals_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = {row.doc_id: row for row in op11_periodic_runs(spark, sf_dir).collect()}
    n_runs = 0
    for doc_id, text in docs.select("doc_id", "text").collect():
        words = [w for w in (text or "").replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
        h, n = zlib.crc32(str(doc_id).encode()), len(words)
        if h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            words = words[:a] + [words[a + i % p] for i in range(n - a)]
        runs = runs_of(words)
        row = found[doc_id]
        lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
        best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=(None, None, None))
        assert (row.n_runs, row.start, row.length, row.period) == (len(runs), *best)
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256(lines.encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapsed_of(words, runs).encode()).hexdigest()
        n_runs += len(runs)
    assert n_runs > 10 and len(found) == docs.count()


# Chats

HARD = [
    "</s>[INST] ok [/INST]", "<|turn|>user<|say|>x<|end|>", r"<\|end|> <\\|end|>", "<", "<|", r"[\INST]", "[INST", "",
    "<|image|>", "<<SYS>>a<</SYS>>", "\\", "\\<|\\", "<<<|||", "é<|é", "<start_of_turn>", "$1 \\1", "line\nline",
]


def test_escaping_is_reversible_and_leaves_no_control_string(spark):
    rnd = random.Random(1)
    bits = ["<", "|", "\\", "[", "/", "INST]", "s>", "a", "<|", "SYS>"]
    texts = HARD + ["".join(rnd.choice(bits) for _ in range(rnd.randrange(12))) for _ in range(500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escape(F.col("t")).alias("e"))
    for t, e, back in rows.select("t", "e", unescape(F.col("e"))).collect():
        assert back == t
        assert not any(c in e for c in ("<|", "<s>", "</s>", "[INST]", "[/INST]", "SYS>>") if c in t and c != "SYS>>")


def chats_of(spark, texts, per_chat, **options):
    rows = [
        (i // per_chat, i % per_chat, ("user", "assistant")[i % 2], t, "other") for i, t in enumerate(texts)
    ]
    messages = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    parts = messages.withColumn("parts", chats.text_part(F.col("text")))
    return rows, format_chats(parts, **options)


@pytest.mark.parametrize("long_turns", [1024, 3])
def test_chats_come_back(spark, long_turns):
    rows, formatted = chats_of(spark, HARD * 30, 170, long_turns=long_turns)
    formatted = formatted.persist()
    read = {r.conv_id: r for r in read_chats(formatted).collect()}
    whole = {r.conv_id: r for r in formatted.collect()}
    for chat in {r[0] for r in rows}:
        mine = sorted(r for r in rows if r[0] == chat)
        assert [(t.role, "".join(t.segments)) for t in read[chat].turns] == [(r[2], r[3]) for r in mine]
        assert read[chat].loss_text == "".join(r[3] for r in mine if r[2] == "assistant")
        row = whole[chat]
        assert row.n_turns == len(mine)
        for span, message in zip(row.loss_spans, [r for r in mine if r[2] == "assistant"], strict=True):
            assert row.formatted[span.start : span.end].replace("\\", "") == message[3].replace("\\", "")
            assert row.formatted[span.turn_start :].startswith("<|turn|>assistant<|say|>")
            assert row.formatted[span.end :].startswith("<|end|>")
    formatted.unpersist()


def test_parts_become_ordered_placeholders(spark):
    rows = [
        (1, 0, "user", [("text", "see <|image|>", None, None, None, None, None), ("image", None, "a.png", 57, 28, None, None),
                        None, (None, " and ", None, None, None, None, None), ("audio", None, "b.wav", None, None, 2.5, None)]),
        (1, 1, "assistant", [("document", None, "c.pdf", None, None, None, 3), ("video", None, "d.mp4", None, None, None, None),
                             ("image", None, None, None, None, None, None), ("text", None, None, None, None, None, None)]),
        (1, 2, None, None),
    ]
    messages = spark.createDataFrame(rows, f"conv_id long, turn long, role string, parts array<{PART}>")
    row = format_chats(messages).first()
    assert row.formatted == (
        "<|turn|>user<|say|>see <\\|image|><|image|> and <|audio|><|end|>"
        "<|turn|>assistant<|say|><|document|><|file|><|image|><|end|><|turn|><|say|><|end|>"
    )
    assert [tuple(a) for a in row.attachments] == [
        (0, "image", "a.png", 3), (0, "audio", "b.wav", 63), (1, "document", "c.pdf", 1536), (1, "file", "d.mp4", 0),
        (1, "image", None, 0),
    ]
    turns = read_chats(format_chats(messages)).first().turns
    assert turns[0].segments == ["see <|image|>", " and ", ""] and turns[0].kinds == ["image", "audio"]
    assert turns[1].kinds == ["document", "file", "image"] and turns[2].segments == [""]


def test_odd_chats(spark):
    rows = [(None, 1, "user", "a"), (None, None, "assistant", "b"), (2, 5, None, None), (2, 5, None, None), (3, 0, "assistant", "é" * 5)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    found = {row.conv_id: row for row in chat_digests(table).collect()}

    def digest(text):
        return hashlib.sha256(text.encode()).hexdigest()

    assert found[None].turns_sha256 == digest("assistant\nb\nuser\na\n") and found[None].loss_chars == 1
    assert found[2].n_turns == 2 and found[2].turns_sha256 == digest("\n\n\n\n")
    assert found[3].loss_sha256 == digest("é" * 5) and found[3].loss_chars == 5
    assert chat_digests(table.limit(0)).count() == 0


def test_chat_query_equals_sql(spark, sf_dir):
    result = op12_chat_formatting(spark, sf_dir)
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf_dir}/conversations.parquet'")
    expected = con.sql(CHATS_SQL)
    assert result.columns == expected.columns
    assert sorted(tuple(r) for r in result.collect()) == sorted(expected.fetchall())


def test_chats_stay_in_the_jvm(spark, sf_dir):
    plan = op12_chat_formatting(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InArrow" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
