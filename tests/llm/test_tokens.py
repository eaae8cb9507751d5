"""Encoding, packing, length histogram and packed files against the tokenizers library and brute force."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from edge import ROWS, documents
from stratum.llm import bitpack, lengths, packing, tokens

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))


def ids(path, text, end=None):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids + ([] if end is None else [end])


def crc(x):
    return zlib.crc32(np.array(x, "<u4").tobytes())


@pytest.mark.parametrize("path", [BYTE, WORD])
def test_encoder_equals_library(path):
    rng, letters = random.Random(2), "abZ'.,!é\n\t  1\x00<|>́streß0-()\xa0\x1c"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    texts += ["<|endoftext|> a<|ENDOFTEXT|>b", "", None, "x" * 3000, "foo bar, " * 150_000]
    enc = tokens.Encoder(path)
    for t, got in zip(texts, enc.encode(texts)):
        assert np.frombuffer(got, "<u4").tolist() == enc.tokenizer.encode(t or "", add_special_tokens=False).ids


def best_fit_decreasing(sizes, capacity):
    rooms, n = Counter(), 0
    for s in sorted(sizes, reverse=True):
        r = next((r for r in range(s, capacity + 1) if rooms[r]), None)
        if r is None:
            n, r = n + 1, capacity
        else:
            rooms[r] -= 1
        rooms[r - s] += 1
    return n


@pytest.mark.parametrize("n", [0, 1, 40, 3000])
def test_plan_is_a_packing_as_good_as_best_fit(n):
    rng = np.random.default_rng(n)
    sizes = np.clip(rng.lognormal(5.5, 1.0, n).astype(int), 1, 1024)
    counts = Counter(sizes.tolist())
    plan = packing.best_plan(counts, 1024)
    used, ranks = defaultdict(list), defaultdict(list)
    for length, rank, count, seq, per, offset in plan.rows:
        ranks[length].append((rank, count))
        for i in range(count):
            used[seq + i // per].append((offset + i % per * length, length))
    for length, runs in ranks.items():
        at = 0
        for rank, count in sorted(runs):
            assert rank == at
            at += count
        assert at == counts[length]
    for placed in used.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 1024
    assert len(used) == plan.sequences <= best_fit_decreasing(sizes.tolist(), 1024)


def test_linear_grouping_uses_configurations():
    found = packing.configurations([600, 400, 300], [10, 10, 10], 1000)
    assert sum(t for _, t in found) == pytest.approx(10 + 10 / 3)


def test_pack_documents(docs):
    rows = packing.pack(packing.pieces(docs, BYTE, 2, 1024).withColumnRenamed("ids", "offset_ids"), 1024).collect()
    want = defaultdict(list)
    for d, t, *_ in ROWS:
        x, at = ids(BYTE, t, 2), 0
        while at < len(x):
            size = (len(x) - 1) % 1024 + 1 if at == 0 else 1024
            want[d].append((at, size, crc(x[at:at + size])))
            at += size
    got, seqs = defaultdict(list), defaultdict(list)
    for r in rows:
        got[r.doc_id].append((r.start, r.length, zlib.crc32(bytes(r.offset_ids))))
        seqs[r.sequence_id].append((r.offset, r.length))
    assert {d: sorted(v) for d, v in got.items()} == {d: sorted(v) for d, v in want.items()}
    for placed in seqs.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= 1024


def test_pack_empty_and_wrong_lengths(spark, docs):
    assert packing.pack(packing.pieces(docs.limit(0), BYTE, 2, 1024), 1024).count() == 0
    with pytest.raises(ValueError):
        packing.pack(spark.createDataFrame([(0,), (5,)], "length int"), 4)


def test_length_histogram(spark, docs):
    sizes = [len(ids(BYTE, t)) for _, t, *_ in ROWS]
    hist = lengths.length_histogram(docs, BYTE)
    rows = {r.context_limit: r for r in lengths.limits(hist).collect()}
    assert set(rows) == set(sizes)
    for c, r in rows.items():
        assert r.docs == sizes.count(c) and r.docs_longer == sum(s > c for s in sizes)
        assert r.tokens_longer == sum(s for s in sizes if s > c)
        assert r.tokens_kept == sum(min(s, c) for s in sizes) and r.tokens_lost == sum(max(0, s - c) for s in sizes)
        assert r.quantile == pytest.approx(sum(s <= c for s in sizes) / len(sizes))
    got = {r.context_limit: r.tokens_kept for r in lengths.truncated_totals(hist, [1, 100, 10 ** 6]).collect()}
    assert got == {c: sum(min(s, c) for s in sizes) for c in (1, 100, 10 ** 6)}
    half = lengths.quantile_lengths(hist, [0.5]).first()["length"]
    assert half == sorted(sizes)[(len(sizes) - 1) // 2]
    assert lengths.limits(lengths.length_histogram(docs.limit(0), BYTE)).count() == 0


@pytest.mark.parametrize("width", [1, 3, 8, 13, 16, 17, 20, 32])
def test_bits_round_trip(width):
    a = np.random.default_rng(width).integers(0, 1 << width, 1003, dtype=np.uint64).astype(np.uint32)
    assert (bitpack.unpack(bitpack.pack(a, width), width, len(a)) == a).all()
    assert bitpack.bits_for((1 << width) - 1) == width


def test_file_random_access(tmp_path):
    rng = np.random.default_rng(0)
    data = [rng.integers(0, 5000, n).astype("<u4") for n in (0, 5, 9000, 1, 0, 4096, 777)]
    out = bitpack.Writer(f"file://{tmp_path}/x.ids", 13, 100)
    out.add([3, None, 5, 6, 7], [a.tobytes() for a in data[:5]])
    out.add([8, 9], [a.tobytes() for a in data[5:]])
    out.close()
    r, flat = bitpack.Reader(f"file://{tmp_path}/x.ids"), np.concatenate(data)
    for a, b in ((0, 1), (99, 101), (4, 9003), (13000, 99999), (7, 7)):
        assert (r.ids(a, b) == flat[a:b]).all()
    assert [(d, len(x)) for d, _, x in r.documents(step=50)] == list(zip([3, None, 5, 6, 7, 8, 9], map(len, data)))


def test_packed_documents(docs):
    files = bitpack.write_ids(docs, WORD, 1)
    got = sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in bitpack.read_ids(files, digest=True).collect())
    at = 0
    for (start, d, n, c), (doc, t, *_) in zip(got, sorted(ROWS, key=lambda r: (r[0] is not None, r[0]))):
        want = ids(WORD, t, 1)
        assert (start, d, n, c) == (at, doc, len(want), crc(want))
        at += n
    assert len(got) == len(ROWS)
    whole = {r.start: list(r.ids) for r in bitpack.read_ids(files).where("doc_id = 9").collect()}
    assert list(whole.values()) == [ids(WORD, ROWS[10][1], 1)]


def test_packed_empty_table(spark):
    assert bitpack.read_ids(bitpack.write_ids(documents(spark).limit(0), WORD, 1), digest=True).count() == 0
