"""A small table of documents with every awkward case, and brute-force helpers."""
import random
import re

from pyspark.sql import functions as F, types as T

WORD = re.compile(r"[^\x20\x09-\x0D]+")
_rng = random.Random(4)
LONG = " ".join("".join(_rng.choice("abcdefgh") for _ in range(_rng.randint(1, 7))) for _ in range(60_000))
BASE = " ".join("".join(_rng.choice("klmnopqrst") for _ in range(5)) for _ in range(80))
ROWS = [
    (1, BASE, "en", "src0"), (2, None, "en", "src1"), (3, "", "de", "src0"), (None, "a text without an id", "en", "src2"),
    (4, "x" * 200_000, "fr", "src0"), (5, LONG, "en", "src0"), (6, BASE, "en", "src3"), (6, BASE, "en", "src3"),
    (7, "!!! 123 ...", None, None), (8, BASE + "\nand a second line", "en", "src0"), (9, "Ünïcödé ñandú größe 漢字", "de", "src0"),
    (10, "one", "es", "src4"), (11, "ONE", "es", "src4"), (12, BASE.upper(), "en", "src0"), (13, "\n\n \t", "en", "src0"),
]
CLASH = ["score", "predicted", "lang_pred", "piece", "start", "length", "ids", "offset", "epoch", "sentence_ids", "_text", "_part", "_size", "key", "Tokens"]


def documents(spark, rows=ROWS, clash=True):
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                           T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])
    df = spark.createDataFrame(rows, schema).withColumn("n_chars", F.length("text").cast("long"))
    return df.withColumns({c: F.lit("clash") for c in CLASH}) if clash else df


def shingle_set(text, k):
    w = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def components(sets, num, den):
    """Smallest reachable key of each key, comparing all pairs of sets."""
    keys, root = list(sets), {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if x and y and num * max(len(x), len(y)) <= den * min(len(x), len(y)) and den * len(x & y) >= num * len(x | y):
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {d: find(d) for d in keys}
