"""Operators on texts against brute force, with nulls, empty texts, ties, repeated rows, empty tables, clashing columns."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lotwise.llm import chat, decontamination, lines, repeats, scoring, token_output, toxicity
from lotwise.llm.base import held_out, scratch_path
from lotwise.llm.queries import byte_bpe

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
DOCS = "doc_id long, text string"


def frame(spark, texts, schema=DOCS):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], schema)


# Token output

def test_tokens_equal_the_tokenizer(spark):
    from tokenizers import Tokenizer
    tokenizer = Tokenizer.from_file(byte_bpe())
    draw = random.Random(1)
    texts = [None, "", " ", "  a\n  b\t\tc \n", "a\x1cb !\x1c x", "　x　 y  ", "it's I'll  've\n\n\nx", "<|endoftext|> a", "b. <|endoftext|>", "<|endoftext|>", "x <|endoftext|><|endoftext|>.\n<|endoftext", "\x85 \xa0b",
             "÷a\n×b\nÀb.c,d", "Und die Über-\nZeile. " * 3000]
    texts += ["".join(draw.choice(" \n\t\r\x1c\x85\xa0ab'sé1!_ ​÷×.,À中") for _ in range(14)) for _ in range(400)]
    docs = frame(spark, texts).unionByName(spark.createDataFrame([(3, "twice"), (3, "twice"), (None, "no id")], DOCS))
    folder = scratch_path(spark, "t")
    token_output.write_tokens(docs.selectExpr("*", "1 as part", "2 as start", "'x' as segment"), folder, byte_bpe())
    got = sorted(token_output.read_tokens(spark, folder, with_ids=True).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got][:3] == [None, 0, 1] and len(got) == len(texts) + 3
    place = 0
    left = Counter((i, t) for i, t in [(None, "no id"), *enumerate(texts), (3, "twice"), (3, "twice")])
    coded = {(i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [2])): (i, t) for i, t in left}
    for r in got:
        left[coded[r.doc_id, tuple(r.ids)]] -= 1
        assert r.start == place and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        place += r.n_tokens
    assert not +left


def test_tokens_of_an_empty_table(spark):
    assert token_output.tokenized(spark.createDataFrame([], DOCS), byte_bpe()).collect() == []


# Chat formatting

def _turns(spark, conversations):
    rows = [(c, t, role, text) for c, turns in conversations.items() for t, (role, text) in enumerate(turns)]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


def test_chats_round_trip(spark):
    tricky = "</s>[INST] ok [/INST]"
    control = ["<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]", "[/ROLE]", "[END]", "\\", "<", "[", "/", " ", "x", "é", "\n", "s>", "INST]"]
    draw = random.Random(2)
    made = {k: [(draw.choice(["user", "assistant", "system", "tool", "[END]", "", "as\\sistant"]), "".join(draw.choices(control, k=draw.randint(0, 9))))
                for _ in range(draw.randint(1, 12))] for k in range(60)}
    made[-1] = [("user", tricky), ("assistant", tricky)]
    made[100] = [("user" if k % 2 else "assistant", f"turn {k}") for k in range(3000)]
    made[101] = [("user", None), ("assistant", ""), (None, "nobody")]
    made[None] = [("user", "a"), ("assistant", "b")]
    folder = scratch_path(spark, "chats")
    chat.write_chats(_turns(spark, made).selectExpr("*", "1 as part", "'x' as sequence"), folder)
    pieces, examples = chat.read_chats(spark, folder), chat.read_examples(spark, folder)
    got = {r.conv_id: r for r in chat.chat_digests(pieces, examples).collect()}
    assert set(got) == set(made)
    cut = pieces.groupBy("conv_id").agg(F.countDistinct("part").alias("n")).where("n > 1")
    assert cut.where("conv_id = 100").count() == 1
    full = {}
    for r in chat.expanded(pieces.where("conv_id is null or conv_id <> 100"), examples).collect():
        full.setdefault(r.conv_id, []).append((r.example, r.context, r.reply))
    for conv, turns in made.items():
        turns = [(role or "", text or "") for role, text in turns]
        replies = [text for role, text in turns if role == "assistant"]
        r = got[conv]
        assert r.n_turns == len(turns)
        assert r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for a, b in turns).encode()).hexdigest()
        assert (r.loss_chars, r.loss_sha256) == (len("".join(replies)), hashlib.sha256("".join(replies).encode()).hexdigest())
        assert r.n_examples == len(replies)
        own = F.col("conv_id").eqNullSafe(F.lit(conv))
        if conv in (100, 101, None):     # cut by task borders, nulls, no id
            lengths = [len(chat.formatted(*t)[0]) for t in turns]
            assert [tuple(e) for e in examples.where(own).orderBy("example").select("example", "context_chars").collect()] == [
                (e, sum(lengths[:k]) + len("<s>")) for e, k in enumerate(k for k, (role, _) in enumerate(turns) if role == "assistant")]
        assert r.formatted_chars == sum(len(chat.formatted(a, b)[0]) for a, b in turns)
        if conv != 100 and replies:
            places = [k for k, (role, _) in enumerate(turns) if role == "assistant"]
            want = [(e, "".join(chat.formatted(*t)[0] for t in turns[:k]) + "<s>", chat.escaped(turns[k][1])) for e, k in enumerate(places)]
            assert sorted(full[conv]) == want


def test_repeated_turns_and_no_turns(spark):
    rows = spark.createDataFrame([(1, 0, "user", "a")] * 3, "conv_id long, turn long, role string, text string")
    for table, n in ((rows, [3]), (rows.where("false"), [])):
        folder = scratch_path(spark, "chats")
        chat.write_chats(table, folder)
        assert [r.n_turns for r in chat.chat_digests(chat.read_chats(spark, folder), chat.read_examples(spark, folder)).collect()] == n


def test_pieces_cut_by_size(spark, monkeypatch):
    monkeypatch.setattr(chat, "PIECE_CHARS", 50)
    turns = [("user", "x" * 40)] * 5 + [("assistant", "y" * 200)] + [("user", "z")] * 30 + [("assistant", "w")]
    folder = scratch_path(spark, "chats")
    chat.write_chats(_turns(spark, {1: turns}), folder)
    pieces, examples = chat.read_chats(spark, folder), chat.read_examples(spark, folder)
    assert pieces.count() > 6
    texts = [chat.formatted(*t)[0] for t in turns]
    got = [(r.context, r.reply) for r in chat.expanded(pieces, examples).orderBy("example").collect()]
    assert got == [("".join(texts[:k]) + "<s>", turns[k][1]) for k in (5, 36)]


# Decontamination

def _hits(texts, items):
    find = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+").findall
    patterns = {}
    for item, text in items:
        w = find((text or "").translate(LOWER))
        n = min(10, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            patterns.setdefault(tuple(w[k:k + n]), set()).add(str(item) if item is not None else "")
    out = []
    for text in texts:
        w = find((text or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(p) for p in patterns}:
            for k in range(len(w) - n + 1):
                p = tuple(w[k:k + n])
                if p in patterns:
                    hit.update(range(k, k + n))
                    found |= patterns[p]
        out.append((len(w), len(hit), sorted(found)))
    return out


@pytest.mark.parametrize(("block_bytes", "scans"), [(1 << 21, 8), (200, 100), (600, 2)])   # one block; one scan of many; several scans
def test_decontamination_equals_brute_force(spark, monkeypatch, block_bytes, scans):
    monkeypatch.setattr(decontamination, "ITEM_BLOCK_BYTES", block_bytes)
    monkeypatch.setattr(decontamination, "BLOCKS_A_SCAN", scans)
    draw = random.Random(3)
    words = ["a", "the", "of", "Übung", "x9", "THE", "né"]
    say = lambda n: "".join(draw.choice(words) + draw.choice([" ", ", ", "\n", "-"]) for _ in range(n))
    items = [(k, say(draw.randint(8, 16))) for k in range(30)] + [(40, "!!!"), (41, None), (42, "zebra"), (43, "Zebra crossing"), (42, "lion"), (None, "tiger")]
    texts = [None, "", "zebra", "lion. TIGER", "the zebra crossing", say(4000)] + [say(draw.randint(0, 40)) + (draw.choice(items)[1] or "") + say(5) for _ in range(60)]
    texts += texts[10:14]
    docs = frame(spark, texts).selectExpr("*", "'kept' as n_words", "7 as extra")
    found = decontamination.contamination(docs, spark.createDataFrame(items, "item_id long, text string"), ["doc_id", "extra", "n_words"])
    got = {r.doc_id: (r.n_words, r.n_hit, r.hit_items) for r in found.collect()}
    assert [got[k] for k in range(len(texts))] == _hits(texts, items)
    for spans in (r.hit_spans for r in found.collect()):
        assert all(a.end < b.start for a, b in zip(spans, spans[1:]))
    none = decontamination.contamination(docs, spark.createDataFrame([], "item_id long, text string"), ["doc_id"])
    assert none.where("contaminated").count() == 0 and none.count() == len(texts)
    assert decontamination.contamination(docs.where("false"), spark.createDataFrame(items, "item_id long, text string"), ["doc_id"]).count() == 0


# Repeated strings

def _cover(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for b in data:
        mark = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                mark[i:i + length] = b"\1" * length
        kept = bytes(x for x, m in zip(b, mark, strict=True) if not m)
        runs = sum(1 for i in range(len(b)) if mark[i] and (not i or not mark[i - 1]))
        out.append((len(b), sum(mark), runs, hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("length", [25, 40, 64])
def test_repeats_equal_brute_force(spark, length):
    draw = random.Random(length)
    base = ["".join(draw.choice("abé ") for _ in range(draw.randint(30, 200))) for _ in range(6)]
    texts = [None, "", "a" * 300, "a" * 24, "ab" * 100]
    for _ in range(50):
        text = ""
        for _ in range(draw.randint(0, 4)):
            x = draw.choice(base)
            a = draw.randint(0, len(x))
            text += x[a:a + draw.randint(5, 150)] + "".join(draw.choice("xyzab") for _ in range(draw.randint(0, 30)))
        texts.append(text)
    texts += texts[10:14]
    ids = [3 if k % 9 == 0 else None if k == 8 else k for k in range(len(texts))]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), DOCS).selectExpr("*", "1 as print", "2 as spans")
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.without_repeats(docs, length).collect())
    assert got == Counter((i, *x) for i, x in zip(ids, _cover(texts, length), strict=True))


def test_repeats_of_an_empty_table(spark):
    assert repeats.without_repeats(spark.createDataFrame([], DOCS)).count() == 0


# Lines

def test_lines(spark):
    head, foot = "one\ntwo\nthree", "x\ny\nz\nw"
    texts = [None, "", f"{head}\nfour", f"a\n{head}\nb", f"{head}\n{head}", f"{foot}\n{head}", f"q\n{foot}", "one\ntwo", f"a\n{head}\nb"]
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in lines.without_repeated_lines(frame(spark, texts).selectExpr("*", "1 as lines")).collect()}
    assert got[0] == got[1] == (1, 0, "") and got[2] == (4, 0, texts[2]) and got[3] == (5, 3, "a\nb")
    assert got[4] == (6, 6, "") and got[5] == (7, 3, foot) and got[6] == (5, 4, "q") and got[7] == (2, 0, texts[7])
    assert got[8] == (5, 5, "")
    assert lines.without_repeated_lines(spark.createDataFrame([], DOCS)).count() == 0


# Language model

def test_scores(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(-5, None), (-6, ""), (-7, " \n"), (None, "the The"), (-8, "x" * 5000)], DOCS)).selectExpr("*", "1 as block")
    rows = docs.collect()
    got = {r.doc_id: r for r in scoring.score_documents(docs, held_out(F.col("doc_id"), 7, 2)).collect()}
    words = {r.doc_id: re.findall(r"[^\x20\x09-\x0D]+", (r.text or "").translate(LOWER)) + ["\0"] for r in rows}
    out = {i: zlib.crc32(b"" if i is None else str(i).encode()) % 7 == 2 for i in words}
    seen = Counter(w for i, x in words.items() if not out[i] for w in x)
    total, distinct = sum(seen.values()), len(seen)
    for i, x in words.items():
        r = got[i]
        base = sum(np.log10((seen[w] + 1) / (total + distinct + 1)) for w in x)
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (out[i], len(x), sum(seen[w] > 0 for w in x), total)
        assert abs(r.base_score - base) < 1e-6 * abs(base)
    unseen = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in unseen) > sum(r.base_score for r in unseen)
    assert scoring.score_documents(docs.where("false"), held_out(F.col("doc_id"), 7, 2)).count() == 0


# Toxicity

def test_toxicity_learns_words_and_finds_sentences(spark):
    draw = random.Random(5)
    words = [f"w{k}" for k in range(300)]
    sentence = lambda: " ".join(draw.choices(words, k=8)) + ". "
    rows, marks = [], []
    for k in range(900):
        toxic = k % 9 == 0
        said = [sentence() for _ in range(draw.randint(1, 12))]
        if toxic:
            said[draw.randrange(len(said))] = f"You {draw.choice(['grumbolt', 'snarvle', 'Snarvle'])} w1. "
        rows.append((k, "".join(said)))
        marks.append((k, int(toxic), 0.5))
    marks += [(0, 0, 0.1), (5, None, 0.2), (99999, 1, 0.3), (None, 1, 0.0)]
    rows += [(1000, None), (1001, ""), (None, "fine words"), (1002, rows[0][1])]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'kept' as score")
    labels = spark.createDataFrame(marks, "doc_id long, toxic int, quality double")
    out = held_out(F.col("doc_id"), 3, 1)
    model = toxicity.fit_toxicity(docs.drop("score"), labels, ~held_out(F.col("doc_id"), 3, 1))
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model, ["doc_id", "text"]).withColumn("out", out).collect()}
    unseen = [r for r in got.values() if r.out and r.doc_id is not None and r.doc_id < 900]
    assert all(r.predicted == int(r.doc_id % 9 == 0) for r in unseen)
    assert got[1000].score == got[1001].score == 0 and got[1002].score == got[0].score
    for r in unseen:
        for s in r.toxic_sentences:
            assert re.search("grumbolt|snarvle", r.text.encode()[s.start:s.end].decode(), re.IGNORECASE)
    nobody = toxicity.fit_toxicity(docs.drop("score"), labels.where("false"), ~held_out(F.col("doc_id"), 3, 1))
    assert toxicity.score_toxicity(docs, nobody, ["doc_id"]).where("score > 0.001").count() == 0
    assert toxicity.score_toxicity(docs.where("false"), model, ["doc_id"]).count() == 0
    # Giant documents are passed over wherever they stand in the sample, and the others still teach both labels.
    giants = spark.createDataFrame([(2000 + k, "w1 w2 w3. " * 2500) for k in range(20)], DOCS)
    marked = labels.unionByName(giants.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic", "0.5 as quality"))
    model = toxicity.fit_toxicity(docs.drop("score").unionByName(giants), marked, ~held_out(F.col("doc_id"), 3, 1), features_limit=500_000)
    told = {r.doc_id: r.predicted for r in toxicity.score_toxicity(docs, model, ["doc_id"]).collect()}
    assert all(told[r.doc_id] == int(r.doc_id % 9 == 0) for r in unseen)
    with pytest.raises(ValueError, match="one label"):
        only = labels.where("toxic = 0").unionByName(marked.where("doc_id = 2001"))
        toxicity.fit_toxicity(docs.drop("score").unionByName(giants), only, F.lit(True), features_limit=500_000)
