"""The corpus operators against brute force on small fixtures, with nulls, empty
and long texts, ties, repeated rows, empty tables and clashing column names."""

import hashlib
import math
import random
import re
import unicodedata
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from riskframe.llm import (crf, decontaminate, html_extract, langid, lm_score, near_dedup, packing, pii,
                           shingles, topk)

RNG = random.Random(3)
VOCAB = ["".join(RNG.choice("abcdefghij") for _ in range(RNG.randint(2, 7))) for _ in range(400)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCAB) for _ in range(n))


def docs_frame(spark, rows):
    """doc_id, text and columns whose names the operators use themselves."""
    return spark.createDataFrame(
        [(d, t, "en", 1, 2.0, "b", 3) for d, t in rows],
        "doc_id long, text string, lang string, node long, score double, bands string, n long").repartition(3)


# ---- near duplicates ----------------------------------------------------------

def shingle_set(text):
    w = (text or "").lower().split()
    return frozenset(zip(*[w[i:] for i in range(5)])) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_classes(rows, weigh=shingle_set):
    sets = [weigh(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]) - 1e-9:
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)].append(d)
    return sorted(((d, min(least[find(i)], default=None)) for i, (d, _) in enumerate(rows)),
                  key=lambda r: tuple((x is not None, x or 0) for x in r))


def mutated(text, rate, rng):
    return " ".join(rng.choice(VOCAB) if rng.random() < rate else w for w in text.split())


@pytest.fixture(scope="module")
def near_rows():
    rng = random.Random(11)
    base = prose(120, rng)
    # one group larger than a block, at all distances from its base
    rows = [(i, mutated(base, rng.choice([0.0, 0.004, 0.01, 0.02, 0.05]), rng)) for i in range(300)]
    for i in range(300, 360, 3):
        t = prose(rng.randint(6, 80), rng)
        rows += [(i, t), (i + 1, t.upper()), (i + 2, mutated(t, 0.02, rng))]
    rows += [(400, None), (401, ""), (402, "  "), (403, "one two"), (404, "one two"), (405, "one two three"),
             (None, base), (None, prose(30, rng)), (406, "same row x y z"), (406, "same row x y z"),
             (406, prose(40, rng)), (407, prose(30_000, rng)), (408, "la " * 500), (409, "la " * 900)]
    return rows


def result(df):
    return sorted(((r.doc_id, r.class_id) for r in df.collect()),
                  key=lambda r: tuple((x is not None, x or 0) for x in r))


def test_classes_equal_brute_force(spark, near_rows):
    assert result(near_dedup.near_duplicates(docs_frame(spark, near_rows))) == brute_classes(near_rows)


def test_counted_classes(spark):
    rows = [(1, "la " * 500), (2, "la " * 900), (3, "la " * 950), (4, "x y z u v w"), (5, "x y z u v w")]

    def counted(t):
        c = Counter(zip(*[t.split()[i:] for i in range(5)]))
        return frozenset((g, i) for g, n in c.items() for i in range(n))

    got = result(near_dedup.near_duplicates(docs_frame(spark, rows), counted=True))
    assert got == brute_classes(rows, counted) == [(1, 1), (2, 2), (3, 2), (4, 4), (5, 4)]


def test_one_of_each_class_stays(spark, near_rows):
    frame = docs_frame(spark, near_rows)
    kept = near_dedup.one_of_each(frame)
    assert kept.columns == frame.columns
    keyed = [(i, t) for i, (_, t) in enumerate(near_rows)]
    assert kept.count() == len({c for _, c in brute_classes(keyed)})
    assert near_dedup.one_of_each(frame.where("false")).count() == 0
    assert near_dedup.near_duplicates(frame.where("false")).count() == 0


def test_one_of_each_when_files_are_packed_anew(spark, near_rows, tmp_path, monkeypatch):
    """Rows keep their numbers if a later job packs the files into other partitions."""
    import corpus_pipeline

    docs_frame(spark, near_rows).repartition(6).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    setting, real = "spark.sql.files.minPartitionNum", near_dedup.near_duplicates

    def then_packed_anew(*args, **options):
        out = real(*args, **options)
        spark.conf.set(setting, "1")
        return out

    monkeypatch.setattr(near_dedup, "near_duplicates", then_packed_anew)
    spark.conf.set(setting, "100")
    try:
        kept = [r.text for r in corpus_pipeline.near_duplicates(spark, docs, "").collect()]
    finally:
        spark.conf.unset(setting)
    keyed = [(i, t) for i, (_, t) in enumerate(near_rows)]
    assert len(kept) == len({c for _, c in brute_classes(keyed)})


def test_signatures_estimate_weighted_similarity():
    rng = np.random.default_rng(4)
    e = near_dedup.mix(np.arange(1, 61, dtype=np.uint64))
    a, b = rng.integers(1, 9, 60).astype(float), rng.integers(1, 9, 60).astype(float)
    b[:40] = a[:40]
    sig = near_dedup.dart_signatures(np.concatenate((e, e)), np.concatenate((a, b)),
                                     np.repeat([0, 1], 60), 2, 4000)
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs((sig[0] == sig[1]).mean() - want) < 0.03
    assert (sig != 0).all()


def test_shingles_are_those_of_plain_python():
    texts = ["a b c d e f", "", "x y", "a  b\tc\nd e f", "Ä b c d e", "ä B C D E"]
    h, owner = shingles.shingle_hashes(texts)
    sets = [frozenset(h[owner == i].tolist()) for i in range(len(texts))]
    plain = [shingle_set(t) for t in texts]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert (sets[i] == sets[j]) == (plain[i] == plain[j])


def test_connected_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 130)] + \
        [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[max(find(a), find(b))] = min(find(a), find(b))
    roots = {r.node: r.root for r in near_dedup.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(roots.get(x, x) == find(x) for x in parent)


# ---- conditional random fields ------------------------------------------------

def test_forward_backward_and_viterbi_by_enumeration():
    from itertools import product
    rng = np.random.default_rng(1)
    lengths = [3, 1, 4, 0, 2]
    scores, begin, move = rng.normal(size=(10, 3)), rng.normal(size=3), rng.normal(size=(3, 3))
    p, log_z, counts = crf.marginals(scores, np.array(lengths), begin, move)
    path = crf.viterbi(scores, np.array(lengths), begin, move)
    at, want_z, want_counts = 0, 0.0, np.zeros((3, 3))
    for n in lengths:
        s = scores[at:at + n]
        if n:
            all_ = {y: begin[y[0]] + sum(s[i, k] for i, k in enumerate(y)) + sum(move[a, b] for a, b in zip(y, y[1:]))
                    for y in product(range(3), repeat=n)}
            z = math.log(sum(map(math.exp, all_.values())))
            want_z += z
            for y, v in all_.items():
                for a, b in zip(y, y[1:]):
                    want_counts[a, b] += math.exp(v - z)
            for i in range(n):
                for k in range(3):
                    assert abs(p[at + i, k] - sum(math.exp(v - z) for y, v in all_.items() if y[i] == k)) < 1e-9
            assert tuple(path[at:at + n]) == max(all_, key=all_.get)
        at += n
    assert abs(log_z - want_z) < 1e-9 and np.allclose(counts, want_counts)


# ---- language -----------------------------------------------------------------

WORDS = {"en": "the of and thing with ing that tion is ed".split(), "fr": "le de que ment aux eau é ou la pas".split(),
         "de": "der und die heit keit nicht ung sch ö ein".split()}


@pytest.fixture(scope="module")
def languages():
    rng = random.Random(8)
    rows = []
    for i in range(240):
        lang = rng.choice(sorted(WORDS))
        rows.append((i, " ".join(rng.choice(WORDS[lang]) + rng.choice(["", rng.choice(WORDS[lang])])
                                 for _ in range(rng.randint(5, 60))), lang))
    return rows


def test_language_accuracy_and_odd_rows(spark, languages):
    odd = [(900, None, "en"), (901, "", "fr"), (902, "12 + 3 = ½ !", "de"), (903, "the of and", None),
           (None, "le de que eau", "fr"), (904, "abc123 the1", "en"), (905, "the of " * 40_000, "en")]
    frame = spark.createDataFrame([(d, t, g, 1.0, "x") for d, t, g in languages + odd],
                                  "doc_id long, text string, lang string, score double, held_out string")
    rows = {r.doc_id: r for r in langid.identify(frame).collect()}
    right = [rows[d].lang_pred == g for d, _, g in languages if rows[d].held_out]
    assert len(right) > 50 and sum(right) / len(right) > 0.97
    for d, _, _ in languages:
        assert rows[d].held_out == (zlib.crc32(str(d).encode()) % 3 == 1)
    assert [rows[d].lang_pred for d in (900, 901, 902)] == ["und"] * 3
    assert rows[900].score == 0.0 and rows[904].lang_pred in WORDS
    assert rows[None].lang_pred == "fr" and rows[None].held_out is False
    assert all(0 <= r.score <= 1 for r in rows.values())
    kept = langid.accepted(frame)
    assert kept.columns == frame.columns
    assert {r.doc_id for r in kept.collect()} >= {d for d, _, _ in languages}
    assert not {900, 901, 902} & {r.doc_id for r in kept.collect()}
    assert langid.identify(frame.where("false")).count() == 0


def test_words_do_not_depend_on_length():
    ids = "abc1 de2f hello "
    for text in (ids, ids * 300_000):
        assert {w for part in langid.words_of(text) for w in part} == {"hello"}
    for n in (1, 9, 3_000_000):
        assert not list(langid.words_of("\u00bd \u00b2 " * n))
    assert [w for part in langid.words_of("\u00bd m\u00b2 ab1 " * 10) for w in part] == ["m\u00b2"] * 10
    assert [w for part in langid.words_of("\u00bd ab1") for w in part] == ["ab"]


def test_words_of_code_switched_text(languages):
    model = langid.fit([(g, t) for _, t, g in languages if t])
    rng = random.Random(1)
    text, gold = [], []
    for lang in ("en", "de", "fr"):
        for _ in range(15):
            text.append(rng.choice(WORDS[lang]))
            gold.append(lang)
    emitted = np.frombuffer(model.scores(text), np.float32).reshape(-1, 3).astype(float)
    p, _, _ = crf.marginals(emitted, np.array([45]), model.crf.begin, model.crf.move)
    found = [model.languages[k] for k in p.argmax(axis=1)]
    assert sum(a == b for a, b in zip(found, gold)) >= 42


def test_a_long_document_leaves_runs_to_other_languages():
    rng = random.Random(4)
    def text(lang, n):
        return " ".join(rng.choice(WORDS[lang]) for _ in range(n))

    rows = [("en", text("en", 200_000))] + [(g, text(g, 40)) for g in ("de", "fr") for _ in range(4)]
    model = langid.fit(rows, runs=30)
    assert model.predict([text(g, 60) for g in ("de", "en", "fr")])[0] == ["de", "en", "fr"]


def test_held_out_rows_are_never_learned_from(spark, languages):
    frame = spark.createDataFrame(languages, "doc_id long, text string, lang string")
    texts = {t for _, t in langid.training_rows(frame, per_language=10**6)}
    assert texts == {t for d, t, _ in languages if zlib.crc32(str(d).encode()) % 3 != 1}


# ---- personal data ------------------------------------------------------------

SLOW = {"email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
        "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        "card": re.compile(r"[0-9]([\x20-]?[0-9])+"), "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")}


def slow_base(text):
    out = []
    for k, (kind, pattern) in enumerate(SLOW.items()):
        for m in pattern.finditer(text):
            digits = [int(c) for c in m[0] if c in "0123456789"]
            luhn = sum(d if i % 2 == 0 else sum(divmod(2 * d, 10)) for i, d in enumerate(reversed(digits))) % 10 == 0
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 14 <= len(digits) <= 19 and luhn or kind == "phone" and 10 <= len(digits) <= 15):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(6)
    parts = ["a.b@c.de", "@", ".", "x@y", "1.2.3.4", "256.1.1.1", "00001.2.3.4.5", "4111111111111111", "4111 1111-1111 1111",
             "+1 (743) 555-3824", "+", "+12", " ", "-", "٣", "é", "\n", "a@b.c_d@e.f", "%", "12.34", "4465758382889437"]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        assert pii.base_spans(text) == slow_base(text), text


def test_base_patterns_take_linear_time():
    for text in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "@" * 100_000, "+1" * 100_000, "1 " * 150_000):
        pii.base_spans(text)


def test_field_adds_spans_and_keeps_base_ones(spark):
    rows = [(1, "call (743) 555-3824 today, or mail joe (at) example.com now"), (2, None), (3, ""),
            (4, "x a.b@c.org 10.0.0.1 y"), (None, "tel +1 (743) 555-3824 x"), (5, "plain words only, in 1999."),
            (6, "+1 (269) 555-3296 4524132264652876 an"), (4, "x a.b@c.org 10.0.0.1 y"), (7, "w " * 50_000 + "a.b@c.org")]
    frame = docs_frame(spark, rows)
    got = defaultdict(list)
    for r in pii.find(frame).collect():
        got[r.doc_id].append(r)
    for d, t in rows:
        base = slow_base(t or "")
        joined = ",".join(f"{pii.KINDS[k]}:{s}:{e}" for s, k, e in base)
        for r in got[d]:
            assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
            assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(x[1] == k for x in base) for k in range(4)]
            assert set(joined.split(",")) <= set(r.spans.split(",")) or not joined
    assert got[1][0].spans == "phone:5:19,email:35:55"
    assert got[5][0].spans == "" and got[2][0].spans == ""
    assert got[6][0].spans == "phone:0:17,card:18:34"
    masked = {r.doc_id: r.text for r in pii.mask(frame).collect()}
    assert masked[4] == "x <EMAIL> <IP> y" and masked[2] is None and masked[5] == rows[5][1]
    assert pii.mask(frame).columns == frame.columns
    assert pii.find(frame.where("false")).count() == 0


def test_labelled_table_is_learned():
    model = pii.PiiModel()
    rows = pii.labelled_rows(4, seed=77)
    found = model.labels([w for ws, _ in rows for w in ws], [len(ws) for ws, _ in rows])
    assert (found == [y for _, ys in rows for y in ys]).mean() > 0.99


# ---- benchmark ----------------------------------------------------------------

@pytest.fixture(scope="module")
def benchmark():
    rng = random.Random(21)
    items = [(i, prose(rng.randint(8, 60), rng).capitalize() + ". " + prose(rng.randint(3, 9), rng) + "?") for i in range(60)]
    items += [(60, None), (61, ""), (62, items[3][1]), (None, prose(20, rng)), (63, "Word"), (64, prose(300, rng))]
    docs = [(d, prose(rng.randint(0, 300), rng)) for d in range(80)]
    for d in range(0, 60):
        at = rng.randint(0, len(docs[d][1]))
        docs[d] = (d, f"{docs[d][1][:at]} {items[d][1].upper()} {docs[d][1][at:]}")
    docs += [(80, None), (81, ""), (None, items[5][1]), (82, items[6][1]), (82, items[6][1]),
             (83, prose(30_000, rng) + " " + items[7][1]), (84, items[64 + 1][1])]
    return items, docs


def contained(items, docs):
    n = lambda t: f" {' '.join(re.findall(r'\w+', (t or '').lower()))} "
    return {(d, i) for d, t in docs for i, x in items if x and len(n(x).split()) > 7 and n(x) in n(t)}


def test_leaks_of_whole_items(spark, benchmark):
    items, docs = benchmark
    frame = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    got = decontaminate.leaks(docs_frame(spark, docs), frame).collect()
    found = {(r.doc_id, r.item_id) for r in got if r.item_id != 63}
    assert found == contained(items, docs)
    assert sum(r.doc_id == 82 for r in got) == 2
    flagged = decontaminate.matches(docs_frame(spark, docs), frame, into="__x")
    assert flagged.count() == len(docs)
    empty = docs_frame(spark, docs).where("false")
    assert decontaminate.leaks(empty, frame).count() == 0
    assert decontaminate.leaks(docs_frame(spark, docs), frame.where("false")).count() == 0


def test_long_item_of_another_script_is_found(spark):
    """The passages are as long as the longest item, whatever its letters."""
    rng = random.Random(21)

    def words(n):
        return ["".join(rng.choice("абвгдежзиклмнопрстуфхцчшыэюя") for _ in range(7)) for _ in range(n)]

    item = " ".join(words(150)) + ". " + " ".join(words(50)) + "."
    items = spark.createDataFrame([(1, item), (2, "a short item. with latin letters")], "item_id long, text string")
    rows = [(i, " ".join(words(40 * i)) + " " + item + " " + " ".join(words(90))) for i in range(4)]
    rows += [(9, " ".join(words(300)))]
    got = decontaminate.leaks(docs_frame(spark, rows), items).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(i, 1) for i in range(4)]


def test_items_with_combining_marks_are_found(spark):
    """Item and passage are cut into words by one rule."""
    hindi = "भारत की राजधानी कौन सी है और वहाँ कितने लोग रहते हैं? दिल्ली में करोड़ों लोग रहते हैं और काम करते हैं।"
    nfd = unicodedata.normalize("NFD", "Où êtes-vous né, à Orléans où près de Besançon, là-bas? Né à Sète, élevé à Nîmes.")
    items = spark.createDataFrame([(1, hindi), (2, nfd)], "item_id long, text string")
    rows = [(1, prose(90) + " " + hindi + " " + prose(50)), (2, prose(30) + " " + nfd), (3, prose(80))]
    got = decontaminate.leaks(docs_frame(spark, rows), items).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 1), (2, 2)]
    assert all(abs(r.score - 1) < 0.5 and r.question == r.answer == 1 for r in got)


def test_search_equals_exhaustive_scoring(spark, benchmark):
    items, docs = benchmark
    frame = spark.createDataFrame(items, "item_id long, text string")
    index = decontaminate.Index(decontaminate.postings(frame).collect(), 0.2, 0.5, 64)
    weights = [dict() for _ in index.items]
    for word, t in index.terms.items():
        for e in range(index.start[t], index.start[t + 1]):
            weights[index.item[e]][word] = index.weight[e]
    rng = random.Random(2)
    passages = [[rng.choice(VOCAB) for _ in range(64)] for _ in range(150)] + [decontaminate.words_of(t) for _, t in items if t]
    pairs = sorted({(p, index.terms[w]) for p, ws in enumerate(passages) for w in ws if w in index.terms})
    p, t = np.array(pairs).T
    got = {(a, b): s for a, b, s in zip(*map(np.ndarray.tolist, index.search(p, t)))}
    want = {}
    for a, ws in enumerate(passages):
        for b, w in enumerate(weights):
            s = sum(w.get(x, 0.0) for x in set(ws))
            if s >= 0.2 - 1e-9:
                want[a, b] = s
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)


# ---- top k --------------------------------------------------------------------

def test_top_k_equals_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, [rng.gauss(0, 1) for _ in range(8)]) for i in range(0, 700)]
    same = [0.5, -0.25, 1.0, 0.0, 0.0, -1.0, 0.125, 2.0]
    rows += [(i, same) for i in range(700, 800)]
    rows += [(801, None), (802, [None, 1.0]), (803, [float("nan")] * 8), (804, [float("inf")] * 8), (None, same),
             (900, []), (1000, [0.0] * 8), (1100, same), (1100, same), (1200, [1.0])]
    frame = spark.createDataFrame([(i, v, 5, 6) for i, v in rows], "vec_id long, embedding array<float>, x int, rank int")
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            good[i] = [math.floor(1024 * float(np.float32(c))) for c in v]
    want = []
    for q, v in good.items():
        if q % 100 == 0:
            found = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good.items() if i != q)[:10]
            want += [(q, r, i, -s) for r, (s, i) in enumerate(found, 1)]
    got = topk.top_k(frame, topk.F.col("vec_id") % 100 == 0)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert topk.top_k(frame.where("false"), topk.F.col("vec_id") % 100 == 0).count() == 0
    assert topk.top_k(frame.where("vec_id = 1000"), topk.F.col("vec_id") % 100 == 0).count() == 0


def test_reading_stops_early_and_stays_exact():
    rng = np.random.default_rng(3)
    vectors = np.floor(rng.normal(size=(1000, 6)) * np.array([3000, 300, 30, 3, 3, 3])).astype(np.int64)
    lists = topk.Lists(np.arange(1000), vectors)
    for q in range(0, 1000, 97):
        ids, scores = lists.top(q, vectors[q], 10)
        s = vectors @ vectors[q]
        s[q] = -2**62
        order = np.lexsort((np.arange(1000), -s))[:10]
        assert ids.tolist() == order.tolist() and scores.tolist() == s[order].tolist()


# ---- language model -----------------------------------------------------------

def brute_lm(rows, vocabulary, hot):
    words = [(t or "").lower().split() for _, t in rows]
    uni = Counter(w for ws in words for w in ws)
    level = {w: math.floor(math.log2(n) * lm_score.STEPS) for w, n in uni.items()}
    least = min((v for v in level.values() if sum(x >= v for x in level.values()) <= vocabulary), default=10**9)
    kept = {w for w in uni if level[w] >= least}
    words = [[w if w in kept else None for w in ws] for ws in words]
    uni = Counter(w for ws in words for w in ws)
    total = max(1, sum(uni.values()))
    pairs = [Counter(zip(ws, ws[1:])) for ws in words]
    all_pairs = sum(pairs, Counter())
    out = []
    for (d, _), ws, own in zip(rows, words, pairs):
        s, back = (math.log(uni[ws[0]] / total) if ws else 0.0), 0
        for (v, w), n in own.items():
            if all_pairs[v, w] > n:
                s += n * math.log(all_pairs[v, w] / uni[v])
            else:
                s += n * math.log(lm_score.ALPHA * uni[w] / total)
                back += n
        out.append((d, len(ws), back, round(s, 4)))
    return sorted(out, key=lambda r: ((r[0] is not None, r[0] or 0), r[1:]))


@pytest.mark.parametrize("vocabulary,hot", [(60, 10), (5000, 1), (5000, 500)])
def test_scores_equal_brute_force(spark, vocabulary, hot):
    rng = random.Random(13)
    common = VOCAB[:30]
    rows = [(i, " ".join(rng.choice(common if rng.random() < 0.8 else VOCAB) for _ in range(rng.randint(0, 60))))
            for i in range(80)]
    rows += [(100, None), (101, ""), (102, "one"), (None, prose(20, rng)), (103, "a b a b a b"), (103, "a b a b a b"),
             (104, prose(20_000, rng))]
    got = lm_score.score(docs_frame(spark, rows), vocabulary=vocabulary, hot_words=hot).collect()
    key = lambda r: ((r[0] is not None, r[0] or 0), r[1:])
    found = sorted(((r.doc_id, r.n_words, r.n_backoff, round(r.log_score, 4)) for r in got), key=key)
    want = brute_lm(rows, vocabulary, hot)
    assert [r[:3] for r in found] == [r[:3] for r in want]
    assert all(abs(a[3] - b[3]) < 1e-3 for a, b in zip(found, want))
    assert lm_score.score(docs_frame(spark, rows).where("false")).count() == 0


@pytest.mark.parametrize("numbered,hot", [(60, 10), (1, 1)])
def test_scores_tell_every_word_apart(spark, numbered, hot):
    """However few words have numbers, rare ones are counted for themselves."""
    rng = random.Random(14)
    rows = [(i, " ".join(rng.choice(VOCAB[:30] if rng.random() < 0.6 else VOCAB) for _ in range(rng.randint(0, 60))))
            for i in range(80)]
    rows += [(2**60 + 1, "rare1 rare1 rare2"), (None, "rare2 rare3 rare2 rare3"), (103, "rare2 rare3"), (103, "rare4"), (104, None)]
    got = lm_score.score(docs_frame(spark, rows), numbered=numbered, hot_words=hot).collect()
    key = lambda r: ((r[0] is not None, r[0] or 0), r[1:])
    found = sorted(((r.doc_id, r.n_words, r.n_backoff, round(r.log_score, 4)) for r in got), key=key)
    want = brute_lm(rows, 10**6, hot)
    assert [r[:3] for r in found] == [r[:3] for r in want]
    assert all(abs(a[3] - b[3]) < 1e-3 for a, b in zip(found, want))


# ---- pages --------------------------------------------------------------------

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body
class="has-sidebar"><header class="top"><a href="/">Home</a></header><nav><ul><li><a href="/a">A</a></ul></nav>
<div class="cookie-notice">We use cookies.</div><div id="wrap"><%s class="post-%d main-text"><header><h1>Title &amp; more</h1></header>
<p><b>First   line<br>goes&nbsp;on.<br><p>Second with <a href="x">a link</a> and <i>more</i> words here.</p>
<div class="ad">Buy!</div><ul><li>one<li>two</ul><form><input><p>Send</p></form>%s
<div class="comments"><p>Nice article, thank you very much indeed for writing it all down for us.</p></div></%s>
<aside>Side</aside><div class="sidebar"><p>More and more text stands here.</p></div></div><footer>&copy; me</footer></body></html>"""
MAIN = "Title & more\n\nFirst line goes on.\n\nSecond with a link and more words here.\n\none\n\ntwo"


def test_main_text_of_odd_pages(spark):
    filler = "<p>" + "Some words of the text. " * 8 + "</p>"
    extra = "\n\n" + ("Some words of the text. " * 8).strip()
    rows = [(i, f"http://Host{i % 2}.example/p/{i}", PAGE % (tag, i, filler, tag), 1)
            for i, tag in enumerate(["div", "div", "div", "article", "div", "section"])]
    rows += [(10, "http://host0.example/x", None, 1), (11, None, "", 1), (None, "no url", "plain &lt;text&gt; 1 < 2", 1),
             (12, "https://u@other.example:80/?q", "<article><p>Cut off <b>page", 1),
             (13, "https://other.example/", "<p>a</p><!-- x", 1), (14, "http://z/", "<div><p>x</p></div><foo", 1),
             (15, "http://big/", "<article><p>" + "word " * 300_000 + "</p></article>", 1), (1, rows[1][1], rows[1][2], 1)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text int").repartition(2)
    got = defaultdict(list)
    for r in html_extract.extract(frame).collect():
        assert r.n_chars == len(r.text)
        got[r.page_id].append(r.text)
    for i in range(6):
        assert set(got[i]) == {MAIN + extra}, i
    assert len(got[1]) == 2
    assert got[10] == got[11] == [""]
    assert got[None] == ["plain <text> 1 < 2"] and got[12] == ["Cut off page"]
    assert got[13] == ["a"] and got[14] == ["x"] and len(got[15][0]) == 1_499_999
    assert html_extract.extract(frame.where("false")).count() == 0


def test_host_vote_decides_for_a_poor_page(spark, monkeypatch):
    good = '<body><div class="story"><p>%s</p></div><div class="box"><p>%s</p></div></body>'
    rows = [(i, "http://h/x", good % ("long text " * 30, "short")) for i in range(5)]
    rows.append((9, "http://h/y", good % ("tiny", "this box is longer than the story")))
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in html_extract.extract(frame).collect()}
    assert texts[9] == "tiny"
    monkeypatch.setattr(html_extract, "BROADCAST_ROWS", -1)  # the salted join
    assert {r.page_id: r.text for r in html_extract.extract(frame).collect()} == texts


# ---- pipeline -----------------------------------------------------------------

def test_pipeline_on_a_small_corpus(spark, tmp_path, languages):
    import corpus_pipeline

    rows = sorted(languages, key=lambda r: -len(r[1]))[:80]
    item = "the thing of the land is that it with and hand tion ed ing the of. and that is with the"
    rows += [(500, rows[0][1], "en"), (501, None, None), (502, "", "en"), (503, "123", "en"),
             (504, rows[1][1] + " " + item, "en"), (505, rows[2][1].replace(" ", "  ") + " a.b@c.org", "en"), (None, None, None)]
    frame = spark.createDataFrame([(d, t, g, "s", len(t or "")) for d, t, g in rows],
                                  "doc_id long, text string, lang string, source string, n_chars long")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = [docs]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, seen[-1], str(tmp_path)).write.parquet(str(tmp_path / f"out{k}"))
        seen.append(spark.read.parquet(str(tmp_path / f"out{k}")))
        if k < 4:
            assert seen[-1].columns == docs.columns
    ids = [sorted(r.doc_id for r in s.select("doc_id").collect() if r.doc_id is not None) for s in seen[:5]]
    assert set(ids[0]) - set(ids[1]) == {501, 502, 503}
    assert len(set(ids[1]) - set(ids[2])) == 2 and set(ids[2]) - set(ids[3]) == {504}
    assert ids[3] == ids[4]
    text = {r.doc_id: r for r in seen[4].collect()}
    assert any("<EMAIL>" in r.text and r.n_chars == len(r.text) for r in text.values()) or 505 not in ids[4]
    total = seen[5].groupBy("doc_id").agg({"length": "sum", "doc_tokens": "max"}).collect()
    assert sorted(r.doc_id for r in total) == ids[4] and all(r[1] == r[2] for r in total)
    run = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, seen[5].collect()))
    empty = docs.where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_stages_keep_columns_named_like_their_own(spark, tmp_path):
    import corpus_pipeline

    extra = {"__language": "a", "__row": "b", "__leaks": "c", "__length": "d", "__LEAKS_": "e"}
    text = "the thing of the land is that it with and hand tion ed ing the of and is was for on are as they at be this have from"
    frame = spark.createDataFrame([(1, text, "en", "s", len(text), *extra.values())],
                                  "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in extra))
    spark.createDataFrame([(1, "nothing like it " * 8)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, frame, str(tmp_path))
        assert out.columns == frame.columns, name
        if name != "language":  # one text teaches no languages apart
            assert [r[c] for r in out.collect() for c in extra] == list(extra.values()), name
