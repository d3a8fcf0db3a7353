import hashlib
import random
import re
import zlib

from layerwell.llm.prefix_trie import conversation_trie, number_turns, rebuild, shared_turns, trie_nodes

SCHEMA = "conv_id long, turn long, role string, text string, depth int, slice string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    turns = {}
    for conv, turn, role, text in (r[:4] for r in rows):
        if conv is not None:
            turns.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    turns = {c: [t[2:] for t in sorted(v)] for c, v in turns.items()}
    members, ends = {}, {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        path = tuple(turns.get(c - c % 20, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = children.get(path, [])
        leaves[path] = sum(leaves[p] for p in below) or 1
        words = len(WORD.findall(path[-1][1])) if path else 0
        saved[path] = (len(members[path]) - 1) * words + sum(saved[p] for p in below)
    return sorted(
        (min(m), len(p), min(members[p[:-1]]) if p else -1, len(m), len(children.get(p, [])), leaves[p], saved[p],
         hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest())
        for p, m in members.items()
    )


def got(df):
    return sorted((r[0], r[1], -1 if r[2] is None else r[2], *r[3:]) for r in map(tuple, df.collect()))


def conversations(seed, convs, texts):
    rng = random.Random(seed)
    rows = []
    for c in range(convs):
        if rng.random() < 0.1:
            continue
        for turn in range(rng.choice([1, 1, 2, 3, 5, 9])):
            rows.append((c, turn, rng.choice("ab"), " ".join(rng.choices(["x", "yé🙂", "z"], k=rng.randrange(texts))), 1, "s"))
    return rows


def test_equals_brute_force(spark):
    for seed, texts in ((1, 2), (2, 3), (3, 5)):
        rows = conversations(seed, 150, texts)
        assert got(conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(5))) == brute(rows)


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (0, None, "u", "early", 1, "s"), (0, 0, None, None, 1, "s"), (0, 0, "a", "tie", 1, "s"), (0, 0, "a", "tie", 1, "s"), (0, 3, "", "", 1, "s"),
        (1, 0, "u", None, None, None), (2, None, None, None, 1, "s"), (None, 1, "u", "nobody's", 1, "s"), (-20, 1, "u", "below zero", 1, "s"),
        (21, 5, "u", "a:b", 1, "s"), (22, 5, "u:a", "b", 1, "s"), (40, 1, "a", "b", 1, "s"), (41, 1, "ab", "", 1, "s"),
    ]
    assert got(conversation_trie(spark.createDataFrame(rows, SCHEMA))) == brute(rows)


def test_a_long_conversation_and_many_copies(spark):
    rows = [(c, t, "ab"[t % 2], f"turn {t}", 1, "s") for c in (20, 60) for t in range(1500)]
    rows += [(100 + c, 0, "u", "the same", 1, "s") for c in range(2000)] + [(3000, 0, "u", "z" * 300_000, 1, "s")]
    assert got(conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(9))) == brute(rows)


def test_shared_turns_are_written_once(spark):
    rows = [(c, t, "u", f"t{t}" if t < 2 else f"own {c}", 1, "s") for c in range(20, 24) for t in range(3)]
    sequences, convs = rebuild(number_turns(spark.createDataFrame(rows, SCHEMA)))
    shared = shared_turns(trie_nodes(sequences, convs), sequences)
    assert sorted((r.conv_id, r.depth, r.n_convs, r.text) for r in shared.collect())[:2] == [(20, 1, 4, "t0"), (20, 2, 4, "t1")]


def test_no_rows(spark):
    assert conversation_trie(spark.createDataFrame([], SCHEMA)).collect() == []
    assert conversation_trie(spark.createDataFrame([(None, 1, "u", "x", 1, "s")], SCHEMA)).collect() == []
