"""Token files, packing and token counts against plain library calls."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from riskframe.llm import packing, token_counts, token_files
from riskframe.llm.common import in_order
from riskframe.llm.encode import Encoder

WORD, BYTE = (public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json"))
PIECE = public_tokenizers.path("piece_bpe_32k.model")
ODD = ["", " ", "\n\n a.\t b,, c", "it's we're  'S.", "<|endoftext|>a.<|startoftext|>", "naïve ÉÇÀ ß,",
       "漢字 かな。 ², 3.14", "İ, Σσς.", "ab́.́c", "\x1c\x85 x", "🙂🙂 ok", "### word.$$$ x,%%%"]


@pytest.fixture(scope="module")
def docs(spark):
    """Nulls in key and text, an empty text, a very long one, repeated rows and
    columns whose names clash with the operators' own."""
    rng = random.Random(1)
    long = " ".join(rng.choice(["the", "ofer", "thnd,", "ing."]) for _ in range(60_000))
    flat = "x" * 9_000
    rows = [(i, t) for i, t in enumerate(ODD)] + [(50, None), (None, "no key here."), (51, long), (52, flat),
                                                  (53, "same row."), (53, "same row."), (53, "other text.")]
    return spark.createDataFrame([(d, t, 7, "s", b"x") for d, t in rows],
                                 "doc_id long, text string, start long, shard string, ids binary").repartition(3)


@pytest.fixture(scope="module")
def expected(docs):
    from tokenizers import Tokenizer

    rows = sorted(((r.doc_id, r.text or "") for r in docs.collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1]))

    def of(path, end):
        tok = Tokenizer.from_file(path)
        return [(d, [*tok.encode(t, add_special_tokens=False).ids, end]) for d, t in rows]

    return of


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("ab .,\n\té€漢²ñ'sSİΣ́<|>_019#\x1c\x85 "), max_size=30))
def test_pieces_encode_like_whole_texts(text):
    for enc in ENCODERS:
        whole = enc.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(enc.ids(text), enc.dtype).tolist() == whole


ENCODERS = [Encoder(open(p, encoding="utf-8").read()) for p in (WORD, BYTE)]


def test_variable_length_code_round_trip():
    rng = np.random.default_rng(0)
    for n in (0, 1, 3, 4, 5, 1000):
        v = (rng.integers(0, 2**32, n, dtype=np.uint64) >> rng.integers(0, 32, n).astype(np.uint64)).astype(np.uint32)
        control, data = token_files.pack(v)
        assert len(control) == -(-n // 4)
        assert token_files.unpack(control, data, n).tolist() == v.tolist()


def test_token_files_round_trip(spark, docs, expected, tmp_path):
    path = str(tmp_path / "files")
    token_files.write_token_files(docs, path, WORD)
    got = sorted(((r.start, r.n_tokens, np.frombuffer(r.ids, "<u4").tolist(), r.doc_id, r.ids_crc32)
                  for r in token_files.read_token_files(spark, path).collect()))
    at = 0
    for (start, n, ids, doc_id, crc), (d, want) in zip(got, expected(WORD, 1), strict=True):
        assert (start, n, ids, doc_id) == (at, len(want), want, d)
        assert crc == zlib.crc32(np.array(want, "<u4"))
        at += len(want)
    vocab = spark.read.parquet(f"{path}/vocabulary").orderBy("rank").collect()
    assert [r.n for r in vocab] == sorted((r.n for r in vocab), reverse=True)


def test_token_files_of_an_empty_table(spark, docs, tmp_path):
    path = str(tmp_path / "none")
    token_files.write_token_files(docs.where("false"), path, WORD)
    assert token_files.read_token_files(spark, path).count() == 0


def brute_cost(cuts, penalty, width):
    pos, best = [0, *cuts], [0.0]
    for j in range(1, len(pos)):
        fits = []
        for i in range(j):
            n = pos[j] - pos[i]
            if n <= width:
                pad = 0 if n & (n - 1) == 0 else width - n
                fits.append(best[i] + pad + packing.WINDOW + penalty[j - 1])
        best.append(min(fits))
    return best[-1]


def test_cuts_are_the_cheapest():
    rng = random.Random(2)
    for _ in range(200):
        width = rng.choice([16, 32, 64])
        cuts = np.cumsum([rng.randint(1, width // 2) for _ in range(rng.randint(1, 40))]).tolist()
        penalty = [rng.choice([0.0, 2.0, 24.0]) for _ in cuts]
        ends = packing.choose_cuts(cuts, penalty, width)
        cost = 0.0
        for a, b in zip([0, *ends], ends):
            n = b - a
            assert 0 < n <= width
            cost += (0 if n & (n - 1) == 0 else width - n) + packing.WINDOW + penalty[cuts.index(b)]
        assert ends[-1] == cuts[-1] and cost == brute_cost(cuts, penalty, width)


def check_pieces(rows, want, width=1024):
    """Every id in exactly one piece; windows gapless, in order and not over width."""
    found, windows = {}, {}
    for r in rows:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert len(ids) == r.length and zlib.crc32(r.ids) == r.ids_crc32
        found.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, ids))
        windows.setdefault(r.sequence_id, []).append((r.offset, r.length))
    total = {}
    for d, ids in want:
        total.setdefault((d, len(ids)), []).append(ids)
    assert found.keys() == total.keys()
    for k, parts in found.items():
        copies = total[k]
        flat = sorted((s + i, x) for s, ids in parts for i, x in enumerate(ids))
        assert flat == sorted((i, x) for ids in copies for i, x in enumerate(ids))
    padding = 0
    for parts in windows.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= width
        padding += 0 if at & (at - 1) == 0 else width - at
    return padding, sum(len(ids) for _, ids in want)


def test_packing_keeps_every_id_once(docs, expected, monkeypatch):
    rows = packing.pack(docs, BYTE).collect()
    padding, tokens = check_pieces(rows, expected(BYTE, 0))
    assert padding < 0.02 * tokens
    assert packing.pack(docs.where("false"), BYTE).count() == 0


def test_packing_in_short_runs(monkeypatch):
    monkeypatch.setattr(packing, "RUN_TOKENS", 3_000)
    enc = ENCODERS[1]
    packer = packing.Packer(packing.sentence_ends(enc), 1024, 0)
    texts = ["word. " * n for n in (5_000, 1, 700, 3_000)] + ["x" * 20_000]
    rows, want = [], []
    for d, t in enumerate(texts):
        ids = np.frombuffer(enc.ids(t) + b"\0\0", enc.dtype)
        want.append((d, ids.tolist()))
        rows += packer.add(d, ids)
    rows += packer.close()
    from collections import namedtuple
    P = namedtuple("P", "doc_id start length doc_tokens sequence_id offset ids ids_crc32")
    check_pieces([P(*r[:6], w, zlib.crc32(w)) for r in rows for w in [r[6].astype("<u4").tobytes()]], want)


def test_token_counts_equal_the_library(docs):
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=PIECE)
    rows = token_counts.token_counts(docs, PIECE, limit=100).collect()
    texts = {}
    for r in docs.collect():
        texts.setdefault(r.doc_id, []).append(r.text or "")
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.n_bytes, r.n_tokens, r.over_limit))
    want = {d: sorted((len(t.encode()), len(sp.encode(t)), len(sp.encode(t)) > 100) for t in ts) for d, ts in texts.items()}
    assert {d: sorted(x) for d, x in got.items()} == want
    assert token_counts.token_counts(docs.where("false"), PIECE).count() == 0


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abe .,\n\té€漢²ñ'▁<s>019́"), max_size=40))
def test_merge_counts_of_odd_strings(text):
    assert COUNTER.count(text) == len(SP.encode(text))


def _models():
    import sentencepiece
    with open(PIECE, "rb") as f:
        return token_counts.MergeCounter(f.read()), sentencepiece.SentencePieceProcessor(model_file=PIECE)


COUNTER, SP = _models()


def test_one_id_with_many_rows_spreads_over_tasks(spark):
    rows = [(None if i % 3 else i, f"{'shared start ' * 8}{i}") for i in range(2_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    joined = "spark.sql.adaptive.coalescePartitions.enabled"  # small partitions would be joined again
    spark.conf.set(joined, "false")
    try:
        parts = in_order(docs.repartition(4)).withColumn("part", F.spark_partition_id())
        sizes = [r["count"] for r in parts.where("doc_id is null").groupBy("part").count().collect()]
    finally:
        spark.conf.unset(joined)
    assert len(sizes) > 1 and sum(sizes) == sum(d is None for d, _ in rows)
    assert max(sizes) < 1_000


def test_a_line_break_before_letters_goes_to_the_merges():
    """Words that open a line are as common as lines: they do not pass the whole tokenizer."""
    import public_tokenizers
    from riskframe.llm.encode import Encoder
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
        enc = Encoder(f.read())
    through, enc._through = enc._through, lambda words: pytest.fail(f"whole tokenizer for {words}")
    assert enc.ids("The\nend and\nThen") == through(["The\nend and\nThen"])[0]
    enc._through = through
    for text in ("\n", "a\n\nAbc", "x \nAbc", "\nAb1", "\nÄb c", " \nAb", "\n Ab\nc"):
        assert enc.ids(text) == through([text])[0]
