"""Conversation repair, prefix trie and suffix repeats against brute force."""

import hashlib
import random
import zlib
from itertools import product

import pytest
from conftest import tuples
from llm.conftest import ODD
from pyspark.sql import functions as F

from ratestrata.llm import conversation_repair as repair, prefix_trie as trie, suffix_repeats as suffixes

TURNS = "conv_id long, turn long, role string, text string"


@pytest.fixture
def conversations(spark):
    def make(*rows):
        df = spark.createDataFrame(list(rows), TURNS)
        return df.withColumns({name: F.lit("x") for name in ("position", "segment", "codes", "edit", "node", "turns", "copies")})

    return make


def grammatical(initials):
    rest = initials[1:] if initials[:1] == "s" else initials
    return initials == "" or (rest != "" and len(rest) % 2 == 0 and rest == "ua" * (len(rest) // 2))


def all_repairs(rows):
    """Every audit of at most two inserted rows a gap, by its cost: the cheapest, then the ASCII-least."""
    best = None
    gaps = [[""], ["I"], ["II"]]
    for inserted in product(range(3), repeat=len(rows) + 1):
        if sum(inserted) > 3:
            continue
        for edits in product("DKR", repeat=len(rows)):
            cost, audit, initials, fits = 5 * sum(inserted), "", "", True
            for n, edit, (initial, must, truncated) in zip(inserted, edits, rows):
                audit += gaps[n][0] + edit
                initials += "?" * n
                if edit == "D":
                    cost += 2
                    continue
                fits &= not must
                cost += (edit == "R") + 5 * truncated
                initials += initial if edit == "K" else "?"
            audit += gaps[inserted[-1]][0]
            initials += "?" * inserted[-1]
            if not fits:
                continue
            if any(grammatical("".join(x)) for x in product(*("ua" if c == "?" else c for c in initials))):
                if best is None or (cost, audit) < best:
                    best = cost, audit
    return best


def test_search_equals_all_repairs():
    rng = random.Random(5)
    for _ in range(150):
        rows = [(rng.choice("suuuaaat"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.randrange(5))]
        assert repair.cheapest(rows, repair.START, repair.ENDS, True) == all_repairs(rows), rows


def forward(rows):
    """The cheapest repair by a plain table over rows and states."""
    best = {repair.START: (0, "")}

    def inserted(table):
        for _ in range(2):
            for state, (cost, audit) in list(table.items()):
                to = repair.NEXT[state][1]
                if (cost + 5, audit + "I") < table.get(to, (1 << 30, "")):
                    table[to] = cost + 5, audit + "I"
        return table

    for initial, must, truncated in rows:
        best, before = {}, inserted(best)
        for state, (cost, audit) in before.items():
            ways = [(state, cost + 2, "D")]
            if not must:
                ways.append((repair.NEXT[state][1], cost + 1 + 5 * truncated, "R"))
                if (state, initial) in repair.STEPS:
                    ways.append((repair.STEPS[state, initial], cost + 5 * truncated, "K"))
            for to, more, letter in ways:
                best[to] = min(best.get(to, (1 << 30, "")), (more, audit + letter))
    return min(v for k, v in inserted(best).items() if k in repair.ENDS)


@pytest.mark.parametrize("n", [5, 40, 64])
def test_search_of_long_segments(n):
    rng = random.Random(n)
    for kinds in ("ua", "suat", "u", "t", "s", "uuua"):
        rows = [(rng.choice(kinds), rng.random() < 0.1, rng.random() < 0.1) for _ in range(n)]
        assert repair.cheapest(rows, repair.START, repair.ENDS, True) == forward(rows)


def damaged_by_hand(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fault == 0:
            continue
        text = "" if fault == 1 else "".join(c for c in text if c not in ".!?") if fault == 2 else text
        role = "user" if fault == 4 else role
        out.setdefault(conv, []).extend([(turn, role, text)] * (2 if fault == 3 else 1))
    return out


def repaired_by_hand(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, codes, counts = set(), [], dict(blank=0, duplicate=0, truncated=0)
    for _, role, text in rows:
        bare = text.strip(" \t\n\x0b\f\r")
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
        seen.add((role, text))
        if fault:
            counts[fault] += 1
        codes.append((role[:1], fault in ("blank", "duplicate"), fault == "truncated"))
    cost, audit = forward(codes)
    lines, state, i = [], repair.START, 0
    for edit in audit:
        role, text = (None, "") if edit == "I" else rows[i][1:]
        initial = None if edit == "I" else codes[i][0]
        i += edit != "I"
        if edit == "D":
            continue
        if edit == "K":
            state = repair.STEPS[state, initial]
        else:
            role, state = repair.NEXT[state]
        lines.append(f"{role}:{text}")
    turns = {t for t, _, _ in rows if t is not None}
    illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(codes, codes[1:]))
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    return gaps, counts["blank"], counts["duplicate"], counts["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()


def odd_conversations():
    rng = random.Random(13)
    roles, texts = ["user", "assistant", "system", "tool", "", None, "user", "assistant"], ["Fine.", "So", " \t", "", None, "Yes!", "No?  ", "é… ", "Fine.", "x" * 50_000 + "."]
    rows = []
    for conv in [*range(40), None]:
        for turn in range(rng.choice([1, 2, 5, 9])):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), rng.choice(roles), rng.choice(texts)))
    rows += [(77, t, ("user", "assistant", "user")[t % 3], f"Turn {t % 90}.") for t in range(400)] + [rows[3]] * 150
    return rows


def test_repairs_equal_brute_force(spark, conversations, tmp_path):
    rows = odd_conversations()
    conversations(*rows).write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r[0]: tuple(r)[1:] for r in repair.op13_conversation_repair(spark, str(tmp_path)).collect()}
    hands = damaged_by_hand(rows)
    empty = (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert got == {conv: repaired_by_hand(hands[conv]) if conv in hands else empty for conv in {r[0] for r in rows}}


def test_repair_keeps_what_it_deletes_and_marks_what_it_adds(conversations):
    found = repair.repair(conversations((1, 0, "user", "Hi."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Hello."), (1, 3, "user", "And?")))
    assert tuples(found.summary) == [(1, 0, 0, 1, 0, 1, 4, "KDKD")]
    assert [tuple(r)[3:] for r in found.steps.orderBy("segment", "step").collect()] == [
        ("K", 0, "user", "Hi."), ("D", 1, "user", "Hi."), ("K", 2, "assistant", "Hello."), ("D", 3, "user", "And?"),
    ]
    assert repair.repair(conversations().where("false")).summary.count() == 0


def nodes_by_hand(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn, role or "", text or ""))
    for conv, turns in own.items():
        turns.sort(key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5(f"{len(r[1])}:{r[1]}{r[2]}".encode()).digest()))
    whole = {}
    for conv in own:
        h = zlib.crc32(str(conv).encode()) % 6
        lead = own.get(conv - conv % 100, [])
        whole[conv] = tuple((r, t) for _, r, t in lead[:h] + own[conv][h:])
    members = {}
    for conv, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(conv)
    out = []
    for prefix, convs in members.items():
        below = [p for p in members if p[: len(prefix)] == prefix]
        children = [p for p in below if len(p) == len(prefix) + 1]
        leaves = [p for p in below if not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in below)]
        saved = sum((len(members[p]) - 1) * len(p[-1][1]) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in convs if len(whole[c]) == len(prefix))))
        out.append((min(convs), len(prefix), min(members[prefix[:-1]]) if prefix else None, len(convs), len(children), len(leaves), saved,
                    hashlib.sha256(ends.encode()).hexdigest()))
    return out


def shared_conversations():
    rng = random.Random(11)
    words = ["a", "b", None, "", "é", "longer text"]
    rows = []
    for conv in [*range(60), 100, 101, 150, 205, 317, None]:
        for turn in range(rng.randrange(1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, None]), rng.choice(["user", "assistant", None]), rng.choice(words)))
    copy = [(t, "user", f"copied {t}") for t in range(3)]
    rows += [(1000 + i, *turn) for i in range(80) for turn in copy]
    return rows + [(500, t, "user", "on and on") for t in range(120)] + rows[:5]


@pytest.mark.parametrize("per_tree", [7, 100_000])
def test_trie_equals_brute_force(spark, conversations, tmp_path, monkeypatch, per_tree):
    """In many small ranges, whose shared paths are merged, and in one."""
    rows = shared_conversations()
    monkeypatch.setattr(trie, "TURNS_PER_TREE", per_tree)
    conversations(*rows).write.parquet(str(tmp_path / "conversations.parquet"))
    assert tuples(trie.op11_prefix_trie(spark, str(tmp_path))) == sorted(nodes_by_hand(rows), key=str)


def test_trie_of_no_conversations(conversations):
    empty = trie.prefix_trie(trie.sequences(conversations().where("false")))
    assert empty.nodes.count() == 0 and empty.ends.count() == 0


def test_radix_nodes_of_every_size():
    rng = random.Random(2)
    keys = {bytes(rng.choices(range(256), k=trie.ID)) * rng.randrange(3) + bytes([i % 256]) * trie.ID for i in range(700)} | {b""}
    keys |= {bytes(trie.ID - 1) + bytes([i]) for i in range(n)} if (n := 30) else set()
    tree = trie.Tree()
    for i, key in enumerate(sorted(keys, key=lambda k: rng.random())):
        tree.insert(key, i)
    kinds, stack = set(), [tree.root]
    while stack:
        node = stack.pop()
        kinds.add(node.kind)
        stack += [child for _, child in node.items()]
    assert kinds == {4, 16, 48, 256} or kinds == {4, 48, 256}
    wanted = {key[:d] for key in keys for d in range(0, len(key) + 1, trie.ID)}
    path, got, ends = [], [], set()
    for depth, turn, own in tree.turns():
        del path[depth - 1 if depth else 0 :]
        path += [turn] if depth else []
        got.append(b"".join(path))
        ends |= {b"".join(path)} if own else set()
    assert got == sorted(wanted) and ends == keys


def cut_by_hand(rows):
    first = {}
    texts = [(i, (t or "").encode()) for i, t in rows]
    for i, text in texts:
        if i is not None:
            for a in range(len(text) - 49):
                window = text[a : a + 50]
                first[window] = min(first.get(window, i), i)
    out = []
    for i, text in texts:
        gone = bytearray(len(text))
        if i is not None:
            for a in range(len(text) - 49):
                if first[text[a : a + 50]] < i:
                    gone[a : a + 50] = b"\1" * 50
        spans = sum(1 for a, b in zip(b"\0" + bytes(gone), gone) if b and not a)
        out.append((i, len(text), sum(gone), spans, hashlib.sha256(bytes(c for c, g in zip(text, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def repeating(n, seed):
    rng = random.Random(seed)
    line = "é" + "".join(rng.choice("abcdefgh é") for _ in range(90))
    out = []
    for i in range(n):
        text = "".join(rng.choice("abcdefghij klm") for _ in range(rng.choice([0, 30, 49, 50, 51, 200, 700])))
        if out and rng.random() < 0.5:
            other = rng.choice(out)[1]
            a = rng.randrange(len(other) + 1)
            text = text[: len(text) // 2] + other[a : a + rng.choice([49, 50, 120])] + text[len(text) // 2 :]
        if rng.random() < 0.4:
            text += line + str(i)
        out.append((300 + i, text))
    return out


ODD_BYTES = [(i, t if t is None or len(t) < 5000 else t[:5000]) for i, t in ODD]


@pytest.mark.parametrize("block_bytes, hot_blocks", [(1 << 22, 256), (3000, 2), (700, 0)])
def test_suffix_repeats_equal_brute_force(documents, block_bytes, hot_blocks):
    rows = ODD_BYTES + repeating(90, 3) + [(301, "again " * 30), (299, "again " * 30)]
    docs = suffixes.marked_repeats(documents(*rows).repartition(3), block_bytes, hot_blocks)
    found = docs.mapInArrow(suffixes._digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    assert tuples(found) == cut_by_hand(rows)


def test_suffix_repeats_of_very_long_and_no_texts(documents, no_documents):
    long = "".join(random.Random(4).choices("abcd ", k=300_000))
    kept = {r.doc_id: bytes(r.kept) for r in suffixes.without_repeats(documents((1, long), (2, "x" + long[100_000:]), (3, "z" * 200_000), (4, "z" * 60))).collect()}
    assert kept == {1: long.encode(), 2: b"x", 3: b"z" * 200_000, 4: b""}
    assert suffixes.marked_repeats(no_documents).count() == 0


def test_suffixes_are_sorted():
    import numpy as np

    rng = random.Random(6)
    text = bytes(rng.choices(b"ab", k=3000)) + b"ab" * 300
    places = np.arange(len(text) - suffixes.SHALLOW)
    order, deep = suffixes.shallow_sort(np.frombuffer(text + bytes(64), np.uint8), places, np.array([1000, len(places) - 1000]), np.arange(len(places)))
    shared = {i for begin, size in deep for i in range(begin, begin + size)}
    for a, b in ((0, 1000), (1000, len(places))):
        keys = [text[p : p + suffixes.SHALLOW] for p in order[a:b].tolist()]
        assert keys == sorted(keys)
        assert all(len({keys[i - a] for i in range(begin, begin + size)}) == 1 for begin, size in deep if a <= begin < b)
        assert all((i + 1 - a < len(keys) and keys[i - a] == keys[i + 1 - a]) <= (i in shared) for i in range(a, b - 1))
    strings = [text[p : p + 12] for p in rng.sample(range(2900), 500)]
    groups = suffixes.blind_trie(strings)
    assert [strings[g[0]] for g in groups] == sorted(set(strings)) and all(len({strings[i] for i in g}) == 1 for g in groups)
    assert sorted(i for g in groups for i in g) == list(range(500))
