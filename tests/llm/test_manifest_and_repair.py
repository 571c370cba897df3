"""Exact dedup, the Merkle manifest and conversation repair against plain versions."""

import hashlib
import itertools
import random
import zlib

import pytest
from pyspark.sql import functions as F

from lotwise.llm import base, exact, merkle, queries, repair
from tests.compare import difference, duck

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# Exact dedup

def _dedup_rows():
    long = "Ä long Text. " * 200_000
    texts = [None, "", " ", "A", "a", "Ä", "ä", "ab", "AB", "Ba", "x" * 64 + "1", "x" * 64 + "2", "X" * 64 + "1", long, long.upper(), long.translate(LOWER), long + "."]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "A"), (7, "other"), (None, "ab"), (None, "alone"), (None, "alone"), (90, ""), (2, " ")]
    return rows + [(100 + i, "copy") for i in range(400)]


@pytest.mark.parametrize("bits", [64, 1 << 23])
def test_exact_duplicates(spark, monkeypatch, bits):
    monkeypatch.setattr(exact, "SIEVE_BITS", bits)
    rows = _dedup_rows()
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'mine' as keep_id", "doc_id as _word", "'d' as digest", "text as `_bits`")
    groups = {}
    for i, t in rows:
        groups.setdefault((t or "").translate(LOWER), []).append(i)
    want = []
    for i, t in rows:
        ids = groups[(t or "").translate(LOWER)]
        best = max((x for x in ids if x is not None), default=None)
        want.append((i, best, len(ids), i == best, sha((t or "").translate(LOWER))))
    got = exact.exact_duplicates(docs, ["text", "_word", "keep_id"], digest_all=True)
    assert got.columns == ["doc_id", "text", "_word", "keep_id", "group_size", "kept", "digest"]
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept, r.digest.hex()) for r in got.collect()), key=repr) == sorted(want, key=repr)
    few = exact.exact_duplicates(docs).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.kept) for r in few), key=repr) == sorted((w[:4] for w in want), key=repr)
    if bits > 64:   # only texts of one length and prefix are hashed in vain
        assert [r.doc_id for r in few if r.group_size == 1 and r.digest is not None] == [11]
    assert exact.exact_duplicates(docs.where("false")).collect() == []


def test_hot_keys_join_like_others(spark, monkeypatch):
    monkeypatch.setattr(base, "HOT_ROWS", 3)
    rows = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 1), ("b", 2), ("c", 3), (None, 4)], "k string, v int")
    groups = spark.createDataFrame([("a", 50, "hot"), ("b", 2, "cold")], "k string, n long, name string")
    got = base.join_counted(rows, groups, "k", "n")
    assert got.columns == ["k", "v", "n", "name"]
    assert sorted((r.k or "", r.v, r.name or "") for r in got.collect()) == sorted(
        [("a", i, "hot") for i in range(50)] + [("b", 1, "cold"), ("b", 2, "cold"), ("c", 3, ""), ("", 4, "")])


def test_places_in_groups(spark, monkeypatch):
    monkeypatch.setattr(base, "PLACED_ROWS", 7)
    rows = [(g, v) for g, n in (("a", 3), ("b", 60), ("c", 1), ("d", 20)) for v in range(n)]
    random.Random(3).shuffle(rows)
    got = base.placed(spark.createDataFrame(rows, "g string, v int"), "g", ["v"], "at", "t").collect()
    assert len(got) == len(rows) and all(r.at == r.v for r in got)


# Merkle manifest

def _plain_tree(nodes, fan):
    """(root, proof of each node) of one tree; a proof is a list of (place, siblings)."""
    paths, level, at = [[] for _ in nodes], list(nodes), list(range(len(nodes)))
    while len(level) > 1:
        for i, k in enumerate(at):
            run = level[k // fan * fan:][:fan]
            paths[i].append((k % fan, run[:k % fan] + run[k % fan + 1:]))
        level = [sha("".join(level[k:k + fan])) for k in range(0, len(level), fan)]
        at = [k // fan for k in at]
    return level[0], paths


def _plain_manifest(rows, claimed, fan):
    def leaf(row):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))
    sources = {}
    for row in rows:
        sources.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(row), row))
    order = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: sorted(sources[s], key=lambda t: t[:3]) for s in order}
    inner = {s: _plain_tree([t[2] for t in trees[s]], fan) for s in order}
    root, outer = _plain_tree([inner[s][0] for s in order], fan)
    out = []
    for s, above in zip(order, outer, strict=True):
        for (_, _, own, row), path in zip(trees[s], inner[s][1], strict=True):
            now = leaf((*row[:4], claimed(row)))
            for place, others in path + above:
                now = sha("".join(others[:place] + [now] + others[place:]))
            proof = sha("".join(x for _, others in path + above for x in others))
            out.append((row[0], own, inner[s][0], root, proof, now, now == root))
    return sorted(out, key=repr)


def _manifest(docs):
    got = merkle.merkle_proofs(docs, F.when(F.col("doc_id") % 5 == 0, F.translate("text", "AB", "ab")).otherwise(F.col("text")))
    return sorted(((r.doc_id, r.leaf.hex(), r.subroot.hex(), r.root.hex(), r.proof.hex(), r.folded.hex(), r.verified) for r in got.collect()), key=repr)


def _claimed(row):
    return row[4] and (row[4].replace("A", "a").replace("B", "b") if row[0] is not None and row[0] % 5 == 0 else row[4])


DOCS = "doc_id long, source string, lang string, n_chars long, text string"


@pytest.mark.parametrize(("fan", "levels"), [(16, 3), (2, 1), (3, 2)])
def test_merkle_manifest(spark, monkeypatch, fan, levels):
    monkeypatch.setattr(merkle, "FAN", fan)
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", fan ** levels)
    monkeypatch.setattr(base, "PLACED_ROWS", 40)
    draw = random.Random(5)
    n = 300 if fan == 16 else 60
    rows = [(i, draw.choice(["src1", "src1", "src2", "Ä", "z", None, ""]), draw.choice(["en", None]), draw.choice([None, 5]),
             draw.choice([None, "", "AB", "ab", "ÄB 🙂", "AB " * 40_000])) for i in range(n)]
    rows += [(n + i, "hot", "en", 1, "A") for i in range(fan ** levels if fan < 16 else 17)] + [(4, "src1", "en", 1, "A"), (4, "src1", "en", 1, "A"), (None, "src2", None, None, None)]
    docs = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' as leaf", "1 as position", "'y' as tree").repartition(3)
    assert _manifest(docs) == _plain_manifest(rows, _claimed, fan)


def test_merkle_of_few_rows(spark):
    for rows in ([], [(5, "s", "en", 1, "AB")], [(1, "s", None, None, None), (2, "s", "en", 1, "B")], [(1, None, "en", 1, "B"), (2, "", "en", 1, "B")]):
        assert _manifest(spark.createDataFrame(rows, DOCS)) == (_plain_manifest(rows, _claimed, 16) if rows else [])


def test_merkle_of_a_superblock_and_one_more(spark):
    rows = [(i, "s", "en", 1, f"Text {i}") for i in range(merkle.BLOCK + 1)]
    assert _manifest(spark.createDataFrame(rows, DOCS)) == _plain_manifest(rows, _claimed, 16)


def test_merkle_proofs_in_full(spark):
    docs = spark.createDataFrame([(i, f"s{i % 3}", "en", 1, "t") for i in range(50)], DOCS)
    for r in merkle.merkle_proofs(docs, F.col("text"), in_full=True).collect():
        assert merkle.fold(bytes(r.leaf), r.places, [bytes(s) for s in r.siblings]) == r.root and r.verified


# Conversation repair

def _cheapest(rows):
    """(cost, audit) by trying all edits; rows are (initial, must go, truncated). At most two inserts stand in one place."""
    best = None

    def go(i, roles, cost, audit, inserts):
        nonlocal best
        body = roles[1:] if roles[:1] == "s" else roles
        if any(c != "ua"[k % 2] for k, c in enumerate(body)):
            return
        if i == len(rows) and len(body) % 2 == 0 and (body or not roles):
            best = min(best or (cost, audit), (cost, audit))
        if inserts < 2:
            go(i, roles + "u", cost + 2, audit + "I", inserts + 1)
            go(i, roles + "a", cost + 2, audit + "I", inserts + 1)
        if i < len(rows):
            initial, must_go, cut = rows[i]
            go(i + 1, roles, cost + 3, audit + "D", 0)
            if not must_go:
                go(i + 1, roles + initial, cost + cut, audit + "K", 0) if initial in "sua" else None
                for role in "ua":
                    go(i + 1, roles + role, cost + 2 + cut, audit + "R", 0)
    go(0, "", 0, "", 0)
    return best


def test_weights_equal_all_edits():
    kinds = [(i, gone, cut) for i in "suax" for gone, cut in ((True, False), (False, False), (False, True))]
    draw = random.Random(2)
    cases = [list(c) for n in (0, 1, 2) for c in itertools.product(kinds, repeat=n)] + [draw.choices(kinds, k=draw.choice([3, 4, 5])) for _ in range(150)]
    for case in cases:
        rows = [(*r, 1) for r in case]
        assert repair.chosen(repair.matrix(rows)) == _cheapest(case), case
        cut = len(rows) // 2
        assert repair.chosen(repair.product([repair.matrix(rows[:cut]), repair.matrix(rows[cut:])])) == _cheapest(case), case


def test_copies_are_deleted_rows():
    for first, rest in itertools.product("sua", repeat=2):
        rows = [(first, False, False, 3), (rest, False, True, 2)]
        plain = [(first, False, False), (first, True, False), (first, True, False), (rest, False, True), (rest, True, False)]
        assert repair.chosen(repair.matrix(rows)) == _cheapest(plain)


def _plain_report(rows):
    """Per conversation of (conv, turn, role, text) the report, with a plain forward search."""
    moves = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}
    turn_of = {0: 2, 1: 2, 2: 3, 3: 2}
    out = {}
    for conv in {r[0] for r in rows}:
        mine = sorted(((t is not None, t or 0, role or " " if role is None else role, sha(" " if text is None else text), " " if text is None else text)
                       for c, t, role, text in rows if c == conv), key=lambda r: r[:4])
        seen, marked, turns = set(), [], [r[1] for r in mine if r[0]]
        for _, _, role, _, text in mine:
            body = text.rstrip(" \t\n\x0b\x0c\r")
            marked.append((role, text, "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""))
            seen.add((role, text))

        def closed(ways):
            for _ in range(2):
                for q, (cost, audit, done) in list(ways.items()):
                    to = turn_of[q]
                    new = (cost + 2, audit + "I", (*done, ("user" if to == 2 else "assistant", "")))
                    if to not in ways or new[:2] < ways[to][:2]:
                        ways[to] = new
            return ways

        ways = closed({0: (0, "", ())})
        for role, text, fault in marked:
            after = {}

            def offer(q, way):
                if q not in after or way[:2] < after[q][:2]:
                    after[q] = way
            cut = fault == "truncated"
            for q, (cost, audit, done) in ways.items():
                offer(q, (cost + 3, audit + "D", done))
                if fault in ("blank", "duplicate"):
                    continue
                to = turn_of[q]
                offer(to, (cost + 2 + cut, audit + "R", (*done, ("user" if to == 2 else "assistant", text))))
                if role[:1] in moves[q]:
                    offer(moves[q][role[:1]], (cost + cut, audit + "K", (*done, (role, text))))
            ways = closed(after)
        cost, audit, done = min(ways[q] for q in (0, 3) if q in ways)
        initials = [m[0][:1] for m in marked]
        faults = [m[2] for m in marked]
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
                     sum(a + b not in ("su", "ua", "au") for a, b in itertools.pairwise(initials)), cost, audit,
                     sha("\n".join(f"{r}:{t}" for r, t in done)), list(done))
    return out


def _conversations():
    draw = random.Random(9)
    rows = []
    for conv in range(25):
        for turn in range(draw.choice([1, 2, 4, 7])):
            rows.append((conv, draw.choice([turn, turn, turn, None, 3]), draw.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]),
                         draw.choice([f"Text {turn}.", "Same.", "cut off", "", None, " \x0b\n", "Ends! \n", "🙂"])))
    for turn in range(90):   # one long conversation, with copies of a turn
        rows.append((77, turn // 2, draw.choice(["user", "assistant", "system"]), draw.choice([f"{turn}.", f"{turn} and", "Same.", ""])))
    rows += [(77, 5, "user", "Copy.")] * 30 + [(78, 1, "user", "long " * 200_000 + ".")] + [(None, 0, "user", "No id."), (None, 1, "assistant", "None.")]
    return rows


@pytest.mark.parametrize(("segment", "group"), [(1024, 16), (3, 2)])
def test_repair_report(spark, monkeypatch, segment, group):
    monkeypatch.setattr(repair, "SEGMENT", segment)
    monkeypatch.setattr(repair, "GROUP", group)
    monkeypatch.setattr(base, "PLACED_ROWS", 20)
    rows = _conversations()
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' as conv", "1 as audit").repartition(3)
    want = _plain_report(rows)
    got = {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired.hex()) for r in repair.repair_report(frame).collect()}
    assert got == {c: w[:-1] for c, w in want.items()}
    turns = {}
    for r in sorted(repair.repaired_turns(frame).collect(), key=lambda r: (r.conv_id or -1, r.place)):
        turns.setdefault(r.conv_id, []).append((r.role, r.text))
    assert turns == {c: w[-1] for c, w in want.items() if w[-1]}
    assert repair.repair_report(frame.where("false")).collect() == []


def test_conversations_without_rows_are_reported(spark, tmp_path):
    rows = [(c, t, role, text) for c in range(40) for t, role, text in ((0, "user", "A?"), (1, "assistant", None))] + [(None, None, None, None)]
    gone = next(c for c in range(100, 200) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows.append((gone, 0, "user", "Dropped."))
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'z' as conv").toPandas().astype(
        {"conv_id": "Int64", "turn": "Int64"}).to_parquet(tmp_path / "conversations.parquet")
    got = queries.op11_conversation_repair(spark, str(tmp_path))
    assert difference(got, duck(str(tmp_path)), queries.ORACLES["op11_conversation_repair"]) is None
    rows = {r.conv_id: r for r in got.collect()}
    assert len(rows) == 42 and tuple(rows[gone])[1:] == (0, 0, 0, 0, 0, 0, "", sha(""))
