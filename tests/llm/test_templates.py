"""Near duplicates among pages that share a template."""

import random

import numpy as np
import pytest

from riskframe.llm import near_dedup


def components(n, edges):
    name = list(range(n))

    def find(x):
        while name[x] != x:
            x = name[x]
        return x

    for a, b in edges:
        name[max(find(a), find(b))] = min(find(a), find(b))
    return [find(x) for x in range(n)]


@pytest.mark.parametrize("threshold", [0.8, 0.9])
def test_rare_links_equal_brute_force(spark, monkeypatch, threshold):
    monkeypatch.setattr(near_dedup, "BLOCK", 4)  # cells of several blocks
    r = random.Random(5)
    common, rare = range(100, 140), range(1000, 1400)
    sets = []
    for _ in range(60):  # a template and some own elements; few or many of them changed in a second set
        one = set(r.sample(common, r.randrange(30, 40))) | set(r.sample(rare, r.randrange(1, 12)))
        other = set(one)
        for x in r.sample(sorted(one), r.randrange(0, 6)):
            other.discard(x)
        sets += [one, other | set(r.sample(rare, r.randrange(0, 3)))]
    n = len(sets)
    wanted = [(i, j) for i in range(n) for j in range(i)
              if len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j]) - 1e-9]
    known = wanted[::3]  # a part of the links is known before
    root = components(n, known)
    rows = [(i, root[i], bytearray(np.array(sorted(s), np.int64).tobytes())) for i, s in enumerate(sets)]
    frame = spark.createDataFrame(rows, "node long, root long, elements binary")
    found = [(x["a"], x["b"]) for x in near_dedup.rare_links(frame, threshold).collect()]
    assert found and set(map(frozenset, found)) <= set(map(frozenset, wanted))
    assert components(n, known + found) == components(n, wanted)
    assert near_dedup.rare_links(frame.where("false"), threshold).count() == 0


def test_pages_of_one_template_are_no_candidates(spark, monkeypatch):
    compared = []
    real = near_dedup.rare_links

    def counting(nodes, threshold):
        out = real(nodes, threshold)
        compared.append((nodes.count(), out.count()))
        return out

    monkeypatch.setattr(near_dedup, "rare_links", counting)
    template = " ".join(f"t{i}" for i in range(104))
    rows = []
    for i in range(0, 600, 2):  # similarity 0.67 within the template, over 0.9 within a pair
        own = [f"u{i}w{j}" for j in range(26)]
        rows += [(i, f"{template} {' '.join(own)}"), (i + 1, f"{template} {' '.join(own[:-1])} x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: x["class_id"] for x in near_dedup.near_duplicates(docs).collect()}
    assert got == {i: i // 2 * 2 for i in range(600)}
    assert compared and compared[0][0] == 600  # all lie in wide buckets


def test_equal_pages_beside_a_template(spark):
    template = " ".join(f"t{i}" for i in range(104))
    rows = [(i, f"{template} " + " ".join(f"u{i % 150}w{j}" for j in range(26))) for i in range(400)]
    rows += [(None, None), (900, ""), (901, template)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {x["doc_id"]: x["class_id"] for x in near_dedup.near_duplicates(docs).collect()}
    # the bare template: 100 shingles of 126, under the threshold
    assert got == {**{i: i % 150 for i in range(400)}, None: None, 900: 900, 901: 901}
