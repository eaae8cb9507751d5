"""Collocations, the conversation trie and personal data against brute force."""
import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from edge import LONG, WORD
from stratum.llm import collocations, pii, prefix_trie, queries

BREAK, PHRASE_WORD = re.compile(r"[.,;:!?\x0A-\x0D]"), re.compile(r"[^\x20\x09]+")


# ------------------------------------------------------------------ collocations

def phrase_rows(rows, least, top=2000):
    """rows: (text, lang). Brute force of the query's contract with another minimum."""
    counts, total = Counter(), Counter()
    for text, lang in rows:
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in BREAK.split(low):
            w = PHRASE_WORD.findall(piece)
            total[lang or "und"] += len(w)
            for n in range(1, 6):
                counts.update((lang or "und", tuple(w[i:i + n])) for i in range(len(w) - n + 1))
    often = {k: a for k, a in counts.items() if a >= least and len(k[1]) > 1}
    found = {}
    for (lang, p), a in often.items():
        inside = any(b >= a and lang == g and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q))) for (g, q), b in often.items())
        if not inside:
            cuts = [(1000 * a * total[lang] // (counts[lang, p[:k]] * counts[lang, p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            found.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), counts[lang, p[:k]], counts[lang, p[k:]]))
    out = []
    for lang, v in found.items():
        out += [(lang, i + 1, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(v)[:top])]
    return sorted(out)


def phrase_table(spark, rows, clash=True):
    df = spark.createDataFrame(rows, "text string, lang string")
    return df.withColumns({c: F.lit(1) for c in ("a", "h", "phrase", "words", "rank")}) if clash else df


def small_corpus():
    rng = random.Random(5)
    vocabulary = ["alpha", "Beta", "gamma", "delta", "épsilon", "zeta", "漢字", "x" * 300]
    rows = [(" ".join(rng.choice(vocabulary) for _ in range(rng.randint(0, 40))).replace("delta ", rng.choice(["delta ", "delta. ", "delta\n", "delta \t"])),
             rng.choice(["en", "en", "en", "de", None])) for _ in range(300)]
    return rows + [(None, "en"), ("", "fr"), (" \t\n", "fr"), ("y" * 100_000, "en"), (LONG[:50_000], "en")] + [("one two three four five six seven", "en")] * 60


@pytest.mark.parametrize("shard", [50, 1 << 22])
def test_collocations_equal_brute_force(spark, shard):
    """A table of few bits has many false hits; results stay exact."""
    rows = small_corpus()
    for least, top in ((25, 2000), (12, 7)):
        got = collocations.collocations(collocations.frequent_phrases(phrase_table(spark, rows).repartition(5), least, shard_words=shard, bits=1 << 12), top)
        assert sorted(tuple(r) for r in got.collect()) == phrase_rows(rows, least, top)


def test_tasks_add_shards_up_before_they_report(spark):
    """What passes a shard's support but not the task's is not reported; a frequent phrase still is."""
    rows = [("en", " ".join([f"p{i} q{i}"] * 6 + ["common word"] * 3)) for i in range(40)]
    texts, totals = spark.createDataFrame(rows, "lang string, t string").coalesce(1), {"en": sum(len(t) for _, t in rows)}
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 5)  # a shard is five texts
    try:
        every, beyond = (collocations._reports(texts, [1], 80, totals, None, 90, slack).collect() for slack in (0.0, collocations.SLACK))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert len(every) == 82 and len(beyond) == 2
    assert all(r.over > 80 * (0.5 - collocations.SLACK) for r in beyond)


def test_counts_beyond_64_bits(spark):
    big = 3 * 10 ** 12
    rows = [("en", 0, "", 7 * big), ("en", 1, "a", 2 * big), ("en", 1, "b", big), ("en", 2, "a b", big - 1)]
    got = collocations.collocations(spark.createDataFrame(rows, "lang string, words int, phrase string, a long")).first()
    assert got.score == 1000 * (big - 1) * 7 * big // (2 * big * big)


def test_no_phrases(spark):
    for df in (phrase_table(spark, small_corpus()).limit(0), phrase_table(spark, [(None, None), ("", "en")])):
        assert collocations.collocations(collocations.frequent_phrases(df, 2)).count() == 0


# ------------------------------------------------------------------ trie

def trie_rows(rows):
    """rows: (conv_id, turn, role, text)."""
    conv = {}
    for c, turn, role, text in rows:
        if c is not None:
            conv.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    conv = {c: [x[2:] for x in sorted(v)] for c, v in conv.items()}
    built = {}
    for c, seq in conv.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(conv.get(c - int(math.fmod(c, 20)), [])[:h] + seq[h:])
    members, children = {}, {}
    for c, seq in built.items():
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append(c)
    for k in members:
        if k:
            children.setdefault(k[:-1], []).append(k)
    leaves, saved, out = {}, {}, []
    for k in sorted(members, key=len, reverse=True):
        below = children.get(k, [])
        leaves[k] = sum(leaves[c] for c in below) if below else 1
        saved[k] = sum(saved[c] for c in below) + ((len(members[k]) - 1) * len(WORD.findall(k[-1][1])) if k else 0)
        ends = ",".join(str(c) for c in sorted(c for c in members[k] if len(built[c]) == len(k)))
        out.append((min(members[k]), len(k), min(members[k[:-1]]) if k else None, len(members[k]), len(below), leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def conversation_rows():
    rng = random.Random(9)
    rows = [(c, t, rng.choice(["user", "bot", None]), rng.choice(["", None, "a b", "c  d\ne", "f"])) for c in range(-45, 400) for t in range(rng.randint(1, 6))]
    rows += [(c, t, "user", f"same {t}") for c in range(1000, 1400) for t in range(3)]                 # copies
    rows += [(2000, t, "user", f"long {t}") for t in range(3000)] + [(2001, t, "user", f"long {t}") for t in range(2999)]
    rows += [(3001, None, "user", "first"), (3001, 0, "bot", "next"), (3001, 0, "bot", "next"), (3002, 7, None, None)]
    return rows + [(None, 0, "user", "nobody's")] + rows[:20]


def conversation_table(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn int, role string, text string").withColumns({c: F.lit(1) for c in ("h", "seq", "base", "k1", "w")})


@pytest.mark.parametrize("block", [5, 1 << 18])
def test_trie_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(prefix_trie, "HOT_PARENTS", 20)
    rows = conversation_rows()
    got = prefix_trie.trie(prefix_trie.rebuild(prefix_trie.sequences(conversation_table(spark, rows))), block)
    assert sorted((tuple(r) for r in got.collect()), key=str) == trie_rows(rows)


def test_trie_query(spark, sf_dir):
    got = queries.op12_conversation_trie(spark, sf_dir)
    rows = [tuple(r) for r in queries.table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").collect()]
    assert sorted((tuple(r) for r in got.collect()), key=str) == trie_rows(rows)


def test_trie_without_conversations(spark):
    df = conversation_table(spark, conversation_rows()[:3])
    for some in (df.limit(0), df.withColumn("conv_id", F.lit(None).cast("long"))):
        assert prefix_trie.trie(prefix_trie.rebuild(prefix_trie.sequences(some))).count() == 0


def test_binary_searches():
    rng = np.random.default_rng(3)
    v = rng.integers(0, 5, 200)
    table = prefix_trie.RangeMin(v)
    at, bound = rng.integers(0, 200, 500), rng.integers(0, 6, 500)
    for i, b, lo, hi in zip(at, bound, table.left(at, bound), table.right(at, bound)):
        l, r = i, i
        while l >= 1 and v[l] >= b:
            l -= 1
        while r + 1 < 200 and v[r + 1] >= b:
            r += 1
        assert (lo, hi) == (l, r)
    lo, hi = np.minimum(at, 199 - bound), np.minimum(at, 199 - bound) + bound
    assert table.least(lo, hi).tolist() == [v[a:b + 1].min() for a, b in zip(lo, hi)]


# ------------------------------------------------------------------ personal data

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    def good_luhn(m):
        d = [int(c) for c in m if c.isdigit()][::-1]
        return 12 <= len(d) <= 19 and (sum(d[::2]) + sum(sum(divmod(2 * x, 10)) for x in d[1::2])) % 10 == 0
    tests = [(EMAIL, lambda m: True), (IP, lambda m: all(int(p) <= 255 for p in m.split("."))), (CARD, good_luhn),
             (PHONE, lambda m: 9 <= sum(c.isdigit() for c in m) <= 15)]
    return sorted(((k, m.start(), m.end()) for k, (pattern, ok) in enumerate(tests) for m in pattern.finditer(text) if ok(m[0])), key=lambda x: (x[1], x[0]))


def test_base_spans_equal_the_patterns():
    rng = random.Random(8)
    for alphabet, n in (("ab@.-1 ", 20), ("0123456789. -+()", 60), ("a1@.%+", 25), ("125.", 30), ("4 -", 40), ("+ 12()é", 30)):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, n)))
            assert pii.base_spans(text) == plain_spans(text), text


def test_base_spans_of_the_table(spark, sf_dir):
    rows = queries.table(spark, sf_dir, "documents").collect()
    got = {r.doc_id: r for r in queries.op13_personal_data(spark, sf_dir).collect()}
    assert len(got) == len(rows)
    for r in rows:
        want, g = plain_spans(r.text or ""), got[r.doc_id]
        assert [g.n_email, g.n_ip, g.n_card, g.n_phone] == [sum(k == i for k, _, _ in want) for i in range(4)]
        assert g.base_sha256 == hashlib.sha256(pii.joined(want).encode()).hexdigest()
        assert set(pii.joined(want).split(",")) <= set(g.spans.split(","))


@pytest.mark.parametrize("text", ["7" * 300_000, "x@" * 100_000, "1." * 100_000, "+1 " * 100_000, "+1" + " " * 200_000, "a" * 300_000 + "@", "1 " * 150_000, "(1)\n" * 50_000])
def test_long_texts_take_linear_time(text):
    import time
    t = time.time()
    base = pii.base_spans(text)
    pii.Graph(text, base)
    pii._cases(text)
    assert time.time() - t < 20


HEAD = "Reach me: +1 (784) 555-8120 or jo.doe77@mail3.example.com; host 17.57.238.115, card 4418452524842581. "


@pytest.fixture(scope="module")
def weights(spark, sf_dir):
    return pii.fit(queries.table(spark, sf_dir.replace("0.001", "0.01"), "documents"))


@pytest.mark.parametrize("mention,kind", [("784.555.8120", "phone"), ("(784) 555-8120", "phone"), ("784-555-8120", "phone"), ("jo.doe77@mail3", "email"), ("jo.doe77", "email")])
def test_repeats_of_a_found_mention_are_added(weights, mention, kind):
    text = HEAD + "Some words between, 12 of 34 items in 2024. " * 30 + f"Then {mention} again."
    got = pii.added_spans([text], [pii.base_spans(text)], weights)[0]
    assert [(pii.KINDS[k], text[s:e]) for k, s, e in got] == [(kind, mention)]


@pytest.mark.parametrize("text", [
    HEAD + "In 2024 we sold 1234 of 5678 units, room 784, version 17.57, 555 calls; 2024 again, 1234 again.",
    "No mention: 7845558120 twice 7845558120, 4418452524842580 4418452524842580, 1.2.3.900 1.2.3.900, joe@local joe@local.",
    "§ 12 (3) 12 (3) 100-200 100-200 item 100.200.3 item 100.200.3", ""])
def test_nothing_else_is_added(weights, text):
    assert pii.added_spans([text], [pii.base_spans(text)], weights) == [[]]


def test_messages_are_exact_on_trees():
    """On a tree, loopy messages give the exact marginals."""
    rng = np.random.default_rng(0)
    n = pii.LABELS
    w = {"chain": rng.normal(size=(n, n)), "skip": (lambda a: a + a.T)(rng.normal(size=(n, n)))}
    unary, chain, skip = rng.normal(size=(4, n)), np.array([[0, 1], [1, 2]]), np.array([[0, 3]])
    joint = np.zeros((n,) * 4)
    for x in np.ndindex(*joint.shape):
        joint[x] = sum(unary[i, x[i]] for i in range(4)) + sum(w["chain"][x[a], x[b]] for a, b in chain) + sum(w["skip"][x[a], x[b]] for a, b in skip)
    joint = np.exp(joint)
    want = np.stack([joint.sum(axis=tuple(j for j in range(4) if j != i)) for i in range(4)]) / joint.sum()
    assert np.allclose(pii.beliefs(unary, chain, skip, w), want, atol=1e-2)


def test_personal_data_edges(spark, docs):
    w = pii.fit(docs)
    out = pii.find(docs.withColumn("spans", F.lit(1)).withColumn("N_email", F.lit("clash")), w)
    rows = out.collect()
    assert len(rows) == docs.count() and {"spans", "base_sha256", "n_phone"} <= set(out.columns)
    assert all(r.base_sha256 == hashlib.sha256(pii.joined(plain_spans(r.text or "")).encode()).hexdigest() for r in rows)
    assert pii.find(docs.limit(0), pii.fit(docs.limit(0))).count() == 0
