"""Importance resampling against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np

from riskframe.llm import resampling

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
RNG = random.Random(8)
COMMON = ["the", "of", "And", "naïve", "2024", "日本"]


def runs(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return words, [zlib.crc32(" ".join(words[i:i + n]).encode()) % 10000 for n in (1, 2, 3) for i in range(len(words) - n + 1)]


def brute(docs, goal):
    s, t = Counter(), Counter()
    for _, text in docs:
        s.update(runs(text)[1])
    for text in goal:
        t.update(runs(text)[1])
    S, T = sum(s.values()), sum(t.values())
    rows = []
    for d, text in docs:
        words, features = runs(text)
        weight = sum(math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in features)
        h = int(hashlib.sha256(f"42:{'' if d is None else d}".encode()).hexdigest()[:8], 16)
        rows.append([d, len(features), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(words) >= 20])
    able = sorted((r for r in rows if r[5]), key=lambda r: (-r[3], r[0] is None, r[0], r[1]))
    for k, r in enumerate(able[:5 * len(able) // 100]):
        r[4] = k + 1
    return sorted((tuple(-1 if x is None else x for x in r[:5]) for r in rows))


def result(spark, docs, goal):
    d = spark.createDataFrame([(*r, "x", 1, b"") for r in docs], "doc_id long, text string, word string, n long, buckets binary").repartition(3)
    b = spark.createDataFrame([(i, t, 1) for i, t in enumerate(goal)], "item_id long, text string, doc_id int")
    return sorted(tuple(-1 if x is None else x for x in r) for r in resampling.resample(d, b).collect())


def prose(n):
    tail = ["w%d" % RNG.randint(0, 500), "ÀÉ" + "x" * RNG.randint(1, 5), "Mixed%d" % RNG.randint(0, 9)]
    return RNG.choice([" ", "  ", ", ", "-"]).join(RNG.choice(COMMON + tail) for _ in range(n))


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(resampling, "SLAB", 700)  # texts of many slabs
    docs = [(i, prose(RNG.randint(1, 60))) for i in range(300)]
    docs += [(300, None), (301, ""), (302, " .,!"), (303, "one"), (304, "one Two"), (305, "z" * 3000 + " a " + "z" * 48 + " b " + "é" * 30 + " c"),
             (306, prose(4000)), (None, prose(30)), (None, None), (5, docs[5][1]), (5, docs[5][1]), (-7, prose(25)), (307, "q" * 5000)]
    goal = [prose(40) for _ in range(8)] + [None, "", "the of and the of"]
    assert result(spark, docs, goal) == brute(docs, goal)


def test_empty_tables(spark):
    assert result(spark, [], ["a b"]) == []
    docs = [(i, prose(30)) for i in range(40)]
    assert result(spark, docs, []) == brute(docs, [])
    assert result(spark, [(1, None)], []) == brute([(1, None)], [])


def test_head_and_tail_give_the_same_states():
    words = [w.encode() for w in prose(500).replace(",", " ").replace("-", " ").lower().split()] + [b"k" * 100, b"the", b"k" * 49, b"of"]
    none, some = resampling.Head([]), resampling.Head(sorted(set(words[:60]))[:40])
    place = np.arange(len(words))
    for a, b, n in zip(none.states(words, place), some.states(words, place), (1, 2, 3)):
        want = [zlib.crc32(b" ".join(words[i - n + 1:i + 1])) for i in range(n - 1, len(words))]
        assert a[n - 1:].tolist() == b[n - 1:].tolist() == want
