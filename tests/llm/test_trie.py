"""The prefix trie against a brute-force trie of the rebuilt conversations."""

import hashlib
import random
import zlib
from collections import defaultdict

from riskframe.llm import prefix_trie

COLUMNS = "conv_id long, turn long, role string, text string, depth int, k1 string, stretch long"


def frame(spark, rows):
    """Columns named as the operator's own take no part."""
    return spark.createDataFrame([(*r, 1, "k", 2) for r in rows], COLUMNS).repartition(3)


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [(r, t) for _, _, r, t in sorted(v)] for c, v in own.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        built[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, convs in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(convs) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (min(convs), len(node), min(members[node[:-1]]) if node else -1, len(convs), children[node], leaves[node], saved[node],
         hashlib.sha256(",".join(map(str, sorted(c for c in convs if built[c] == node))).encode()).hexdigest())
        for node, convs in members.items())


def result(spark, rows):
    return sorted((r.conv_id, r.depth, -1 if r.parent_conv_id is None else r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves,
                   r.saved_tokens, r.ends_sha256) for r in prefix_trie.trie(frame(spark, rows)).collect())


def sample():
    rng = random.Random(5)
    words = ["yes", "no", "naïve 😀", "", None]
    rows = []
    for c in [*range(60), *range(100, 140), *range(301, 330), -5, -105, 700]:
        for t in range(rng.randint(1, 9)):
            rows.append((c, t, rng.choice(["user", "assistant", None]), rng.choice(words)))
    for c in range(400, 460):  # equal conversations, and their prefixes
        rows += [(c, t, "user", f"turn {t} " * 40) for t in range(6 + c % 4)]
    rows += [(500, None, "user", "null turn"), (500, None, "a", "another"), (500, 0, "user", "zero"), (500, 0, "user", "zero"),
             (None, 1, "user", "nobody"), (501, 1, None, None)]
    rows += [(600, t, "user", "same") for t in range(300)] + [(601, t, "user", "same") for t in range(299)]
    return rows


def test_trie_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "STRETCH", 7)  # long conversations and groups in many pieces
    monkeypatch.setattr(prefix_trie, "RUN", 4)
    rows = sample()
    assert result(spark, rows) == brute(rows)


def test_empty_null_and_single(spark):
    assert result(spark, []) == [] and result(spark, [(None, 1, "user", "x")]) == []
    rows = [(7, 3, None, None)]
    assert result(spark, rows) == brute(rows)


def test_turnless_conversations_end_at_the_root(spark):
    c = next(c for c in range(1, 100) if zlib.crc32(str(c).encode()) % 6 == 5)
    rows = [(c, 0, "user", "alone")]  # its only turn is replaced by an absent base
    (root,) = result(spark, rows)
    assert root[1] == 0 and root[3] == 1 and root[7] == hashlib.sha256(str(c).encode()).hexdigest()


def test_running_values_within_a_hot_key(spark):
    from pyspark.sql import functions as F
    df = spark.range(5000).select((F.col("id") % 50 * (F.col("id") % 3 == 0).cast("int")).alias("k"), "id")
    got = prefix_trie.running(df, ["k"], [F.col("id")], {"n": ("sum", F.lit(1)), "x": ("bit_xor", F.col("id"))}).collect()
    seen = defaultdict(lambda: [0, 0])
    for r in sorted(got, key=lambda r: r.id):
        s = seen[r.k]
        s[0], s[1] = s[0] + 1, s[1] ^ r.id
        assert (r.n, r.x) == tuple(s)
    assert len(got) == 5000
