"""Queries over the documents, embeddings, labels and conversations tables: one per operation of this package.

Each reads its whole table and derives the digest columns of its result from the operation's
own output. ``ORACLES`` holds DuckDB SQL where SQL can express a query.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import ann, bitpack, collocations, fingerprint, jaccard, langid, lengths, licences, mixing, packing, pii, prefix_trie, toxicity
from .common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def tokenizer(name: str) -> str:
    """Path of a public tokenizer file."""
    import public_tokenizers
    return public_tokenizers.path(name)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens: one row per piece."""
    pieces = packing.pieces(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), end_id=2, capacity=1024)
    return packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"), capacity=1024)


@query
def op2_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts, with likenesses."""
    return fingerprint.compare_next(table(spark, sf_dir, "documents"))


@query
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 3-word shingles have similarity 0.9 or more."""
    return jaccard.join(table(spark, sf_dir, "documents"), k=3, num=9, den=10)


# every pair with a common shingle is counted, and links are followed until nothing new is reached
ORACLES["op3_jaccard_join"] = r"""WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(words[i:i + 2], ' ') AS shingle
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM w WHERE len(words) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 90 * (x.n + y.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(r.least, doc_id) AS component_id
FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS least FROM reach GROUP BY a) r USING (doc_id)"""


@query
def op4_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct encoded length of the documents as a context limit, with exact totals."""
    return lengths.limits(lengths.length_histogram(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json")))


def fold(parts: int):
    """crc32 of the id as text, modulo the number of parts."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels of four of five folds."""
    docs, labels = table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.where(fold(5) != 0))
    scored = toxicity.score(docs.withColumn("held_out", F.coalesce(fold(5) == 0, F.lit(True))), model)
    return scored.select("doc_id", "held_out", "score", "predicted")


@query
def op6_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences recognised in every document from its known licence sentences."""
    found = licences.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licences", ",").alias("licences"), "unmatched")


ORACLES["op6_licence_scan"] = licences.scan_sql()


@query
def op7_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest found, by inner product, of every vector whose id is divisible by 20."""
    return ann.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


#: Target weights among siblings: domain, then language, then source (others weigh 1).
MIX_WEIGHTS = {"domain": {"web": 5, "books": 3, "code": 2}, "lang": {"en": 6, "de": 2, "fr": 2, "es": 1},
               "source": {"src0": 1, "src1": 2, "src2": 3}}
WORDS = r"[^\x20\x09-\x0D]+"


def mix_levels() -> dict:
    """The tree of the documents: the source's number gives the domain."""
    number = F.try_to_number(F.regexp_extract("source", "([0-9]+)$", 1), F.lit("999999")) % 3
    domain = F.when(number == 0, "web").when(number == 1, "books").otherwise("code")
    return {"domain": domain, "lang": F.col("lang"), "source": F.col("source")}


def word_count():
    return F.size(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(WORDS), F.lit(0)))


@query
def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents chosen, epoch by epoch, to meet the weights of their domain, language and source."""
    docs = table(spark, sf_dir, "documents").withColumns({"domain": mix_levels()["domain"], "tokens": word_count()})
    docs = docs.select("doc_id", "domain", "lang", "source", "tokens")
    return mixing.mix(docs, {k: F.col(k) for k in ("domain", "lang", "source")}, F.col("tokens"), MIX_WEIGHTS)


def _level_sql(i: int, levels: list[str]) -> str:
    """SQL of one level of budgets: table b<i> from b<i-1> (columns: levels so far, got)."""
    here, above = ", ".join(levels[:i + 1]), ", ".join(levels[:i])
    w = " ".join(f"WHEN '{k}' THEN {v}" for k, v in MIX_WEIGHTS[levels[i]].items())
    part = f"PARTITION BY {above}" if above else ""
    on = " AND ".join(f"c{i}.{c} IS NOT DISTINCT FROM p.{c}" for c in levels[:i]) or "TRUE"
    return f"""c{i} AS (SELECT {here}, SUM(tokens) * 4 AS c, MAX(CASE coalesce({levels[i]}, '') {w} ELSE 1 END) AS w FROM leaf GROUP BY {here}),
f{i} AS (SELECT c{i}.*, CAST(c AS DOUBLE) / w AS r, p.got AS b FROM c{i} JOIN b{i} p ON {on}),
l{i} AS (SELECT *, CAST(b - coalesce(SUM(c) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
           / SUM(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS v FROM f{i} WINDOW o AS ({part} ORDER BY r, {levels[i]} NULLS FIRST)),
m{i} AS (SELECT *, min(CASE WHEN r >= v THEN {{'r': r, 'v': v}} END) OVER ({part}) AS m FROM l{i}),
b{i + 1} AS (SELECT {here}, CASE WHEN m IS NULL THEN c ELSE least(c, CAST(floor(m.v * w + 1e-6) AS HUGEINT)) END AS got FROM m{i})"""


_LEVELS = ["domain", "lang", "source"]
ORACLES["op8_source_mixing"] = """WITH d AS (
  SELECT doc_id, CASE TRY_CAST(regexp_extract(source, '([0-9]+)$', 1) AS BIGINT) % 3 WHEN 0 THEN 'web' WHEN 1 THEN 'books' ELSE 'code' END AS domain,
         lang, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS INTEGER) AS tokens FROM documents),
leaf AS (SELECT domain, lang, source, SUM(tokens) AS tokens FROM d GROUP BY ALL),
b0 AS (SELECT SUM(tokens) AS got FROM leaf),
""" + ",\n".join(_level_sql(i, _LEVELS) for i in range(3)) + """,
e AS (SELECT d.*, CASE WHEN leaf.tokens > 0 THEN got // leaf.tokens ELSE 0 END AS fulls,
             got - (CASE WHEN leaf.tokens > 0 THEN got // leaf.tokens ELSE 0 END) * leaf.tokens AS rest
      FROM d JOIN leaf ON d.domain IS NOT DISTINCT FROM leaf.domain AND d.lang IS NOT DISTINCT FROM leaf.lang AND d.source IS NOT DISTINCT FROM leaf.source
      JOIN b3 ON d.domain IS NOT DISTINCT FROM b3.domain AND d.lang IS NOT DISTINCT FROM b3.lang AND d.source IS NOT DISTINCT FROM b3.source),
p AS (SELECT *, SUM(tokens) OVER (PARTITION BY domain, lang, source
        ORDER BY CAST('0x' || substr(md5('7|' || CAST(fulls AS BIGINT) || '|' || doc_id), 1, 15) AS BIGINT), doc_id, tokens ROWS UNBOUNDED PRECEDING) AS upto FROM e)
SELECT doc_id, domain, lang, source, tokens, CAST(epoch AS INTEGER) AS epoch FROM (
  SELECT *, unnest(range(CAST(fulls AS BIGINT))) AS epoch FROM e
  UNION ALL SELECT * EXCLUDE (upto), CAST(fulls AS BIGINT) FROM p WHERE rest > 0 AND upto <= rest)"""


@query
def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the languages of two of three folds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs, fold(3) != 1)
    named = langid.predict(docs.select("doc_id", "text").withColumn("held_out", F.coalesce(fold(3) == 1, F.lit(True))), model)
    return named.select("doc_id", "held_out", "lang_pred", "score")


@query
def op10_bit_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents in packed files, read back: doc_id, start, n_tokens, ids_crc32."""
    files = bitpack.write_ids(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"), end_id=1)
    return bitpack.read_ids(files, digest=True)


@query
def op11_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's 2,000 strongest phrases of 2 to 5 words that occur 100 times or more."""
    return collocations.collocations(collocations.frequent_phrases(table(spark, sf_dir, "documents"), min_count=100, max_words=5), top=2000)


ORACLES["op11_phrase_collocations"] = r"""WITH p AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                                     '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
g AS (SELECT lang, m, unnest(list_transform(range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) AS phrase
      FROM p, (VALUES (1), (2), (3), (4), (5)) v(m) WHERE len(w) >= m),
f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY lang),
c AS (SELECT * FROM f WHERE m > 1 AND NOT EXISTS (SELECT 1 FROM f AS b WHERE b.lang = f.lang AND b.m > f.m AND b.a >= f.a
        AND contains(' ' || b.phrase || ' ', ' ' || f.phrase || ' '))),
k AS (SELECT c.*, unnest(range(1, m)) AS k, string_split(phrase, ' ') AS w FROM c),
s AS (SELECT k.lang, k.phrase, k.a, x.a AS l, y.a AS r, n.n, k.k, CAST(CAST(1000 AS HUGEINT) * k.a * n.n // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score
      FROM k JOIN f AS x ON x.lang = k.lang AND x.phrase = array_to_string(k.w[1:k.k], ' ')
      JOIN f AS y ON y.lang = k.lang AND y.phrase = array_to_string(k.w[k.k + 1:], ' ') JOIN n ON n.lang = k.lang),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b QUALIFY rank <= 2000"""


@query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct opening of the rebuilt conversations, with its members, children, leaves and words saved."""
    return prefix_trie.trie(prefix_trie.rebuild(prefix_trie.sequences(table(spark, sf_dir, "conversations"))))


# a node is (smallest member, depth); crc32 goes bit by bit (fixed values: its reversed polynomial and mask)
ORACLES["op12_conversation_trie"] = r"""WITH t AS (
  SELECT conv_id, list({'role': coalesce(role, ''), 'text': coalesce(text, '')} ORDER BY turn NULLS FIRST, role, text) AS seq
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
c AS (SELECT conv_id, seq, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda ch: CAST(ascii(ch) AS BIGINT))),
        lambda acc, byte: list_reduce([xor(acc, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))) AS crc FROM t),
h AS (SELECT conv_id, seq, xor(crc, 4294967295) % 4 AS h FROM c),
r AS (SELECT h.conv_id, list_concat(coalesce(base.seq, [])[1:h], h.seq[h + 1:]) AS seq FROM h LEFT JOIN t base ON base.conv_id = h.conv_id - h.conv_id % 20),
p AS (SELECT conv_id, d, seq[1:d] AS prefix, d = len(seq) AS ends, CASE WHEN d > 0 THEN len(regexp_extract_all(seq[d].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS words
      FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM r)),
m AS (SELECT conv_id, d, ends, words, min(conv_id) OVER (PARTITION BY d, prefix) AS owner FROM p),
node AS (SELECT owner, d, count(*) AS n, max(words) AS words, sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS sha
         FROM m GROUP BY owner, d),
link AS (SELECT node.*, up.owner AS parent FROM node LEFT JOIN m up ON up.conv_id = node.owner AND up.d = node.d - 1),
kids AS (SELECT parent AS owner, d - 1 AS d, count(*) AS n_children FROM link WHERE parent IS NOT NULL GROUP BY ALL),
full_node AS (SELECT link.*, coalesce(n_children, 0) AS n_children FROM link LEFT JOIN kids USING (owner, d)),
sub AS (SELECT m.owner, m.d, count(*) FILTER (WHERE x.n_children = 0) AS n_leaves, CAST(sum((x.n - 1) * x.words) AS BIGINT) AS saved_tokens
        FROM full_node x JOIN m ON m.conv_id = x.owner AND m.d <= x.d GROUP BY ALL)
SELECT owner AS conv_id, d AS depth, parent AS parent_conv_id, n AS n_convs, n_children, n_leaves, saved_tokens, sha AS ends_sha256
FROM full_node JOIN sub USING (owner, d)"""


@query
def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: spans of the patterns and those that the skip-chain CRF adds."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.find(docs, pii.fit(docs)).drop("text")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
