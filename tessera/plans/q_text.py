"""Catalogue: text operators on documents (whole texts), labels and part names."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import scalar as S
from tessera.functions.text import TOKEN_FILTERS, pad_sequence
from tessera.operators import dictionary, joins, semi, text
from tessera.plans.registry import query
from tessera.session import cut_lineage, table

_PLAIN = TOKEN_FILTERS.replace("\t", "").replace("\n", "")
_FROM = f"'{_PLAIN}' || chr(9) || chr(10)"
_TO = f"'{' ' * len(TOKEN_FILTERS)}'"
_TOKENS_SQL = f"list_filter(string_split(translate(lower(text), {_FROM}, {_TO}), ' '), lambda t: t <> '')"
_GLUED_SQL = f"""list_filter(string_split(regexp_replace(regexp_replace(regexp_replace(
    array_to_string({_TOKENS_SQL}, ' '), '^(?:''(?: |$))+', ''), ' '' ', '', 'g'), ' ''$', ''), ' '),
    lambda t: t <> '')"""

TOK_CTE = f"tok AS (SELECT doc_id, {_GLUED_SQL} AS tokens FROM documents)"
VOCAB_CTE = """vocab AS (SELECT word, COUNT(*) AS n FROM (SELECT unnest(tokens) AS word FROM tok) u
                GROUP BY word HAVING COUNT(*) >= 3)"""
POS_CTE = """ex AS (SELECT doc_id, unnest(tokens) AS word, unnest(range(len(tokens))) AS pos FROM tok)"""


def _tokens(spark, d):
    return text.tokens_of(table(spark, d, "documents"), "doc_id", "text")


@query("q_tokens", "T1, T2, F34", f"""
WITH {TOK_CTE}
SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens, array_to_string(tokens, ' ') AS joined FROM tok
""")
def q_tokens(spark, d):
    t = _tokens(spark, d)
    return t.select("doc_id", F.size("tokens").alias("n_tokens"), F.array_join("tokens", " ").alias("joined"))


@query("q_vocab", "A12, T3", f"""
WITH {TOK_CTE}, {VOCAB_CTE}
SELECT word, n FROM vocab
""")
def q_vocab(spark, d):
    return text.vocabulary(_tokens(spark, d), "doc_id", "tokens", 3)


@query("q_oov", "T4", f"""
WITH {TOK_CTE}, {VOCAB_CTE}
SELECT DISTINCT doc_id FROM (SELECT doc_id, unnest(tokens) AS word FROM tok) u
WHERE word NOT IN (SELECT word FROM vocab)
""")
def q_oov(spark, d):
    return text.rare_docs(_tokens(spark, d), "doc_id", "tokens", 3)


@query("q_filter_vocab", "T5, J4", f"""
WITH {TOK_CTE}, {VOCAB_CTE}, {POS_CTE},
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS joined, COUNT(*) AS n
         FROM ex WHERE word IN (SELECT word FROM vocab) GROUP BY doc_id)
SELECT t.doc_id, COALESCE(k.joined, '') AS joined, CAST(COALESCE(k.n, 0) AS INTEGER) AS n_kept
FROM tok t LEFT JOIN kept k ON t.doc_id = k.doc_id
""")
def q_filter_vocab(spark, d):
    f = text.drop_rare(_tokens(spark, d), "doc_id", "tokens", 3)
    return f.select("doc_id", F.array_join("tokens", " ").alias("joined"), F.size("tokens").alias("n_kept"))


@query("q_filter_given", "J4, T4, T5 (a given vocabulary)", f"""
WITH {TOK_CTE}, {POS_CTE},
given AS (SELECT DISTINCT unnest(string_split(p_name, ' ')) AS word FROM part UNION SELECT unnest(tokens) FROM tok WHERE doc_id % 7 = 0),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS joined, COUNT(*) AS n FROM ex WHERE word IN (SELECT word FROM given) GROUP BY doc_id),
oov AS (SELECT DISTINCT doc_id FROM ex WHERE word NOT IN (SELECT word FROM given))
SELECT t.doc_id, COALESCE(k.joined, '') AS joined, CAST(COALESCE(k.n, 0) AS INTEGER) AS n_kept, o.doc_id IS NOT NULL AS has_oov
FROM tok t LEFT JOIN kept k ON t.doc_id = k.doc_id LEFT JOIN oov o ON t.doc_id = o.doc_id
""")
def q_filter_given(spark, d):
    t = _tokens(spark, d)
    names = table(spark, d, "part").select(F.explode(F.split("p_name", " ")).alias("word"))
    given = names.unionByName(text.exploded(t.filter("doc_id % 7 = 0"), "doc_id", "tokens")\
                              .select("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    unknown = cut_lineage(text.unknown_words(t, "doc_id", "tokens", given, rows="n"))
    oov = text.oov_docs(t, "doc_id", "tokens", given, unknown=unknown).withColumn("has_oov", F.lit(True))
    f = text.filter_vocab(t, "doc_id", "tokens", given, unknown=unknown).join(oov, "doc_id", "left")
    return f.select("doc_id", F.array_join("tokens", " ").alias("joined"), F.size("tokens").alias("n_kept"), F.coalesce("has_oov", F.lit(False)).alias("has_oov"))


@query("q_pad", "T6, F19, W5", f"""
WITH {TOK_CTE}, {VOCAB_CTE}, {POS_CTE},
idx AS (SELECT word, row_number() OVER (ORDER BY word) AS idx FROM vocab),
ids AS (SELECT ex.doc_id, list(idx.idx ORDER BY ex.pos) AS l FROM ex JOIN idx ON ex.word = idx.word GROUP BY ex.doc_id),
full_ids AS (SELECT t.doc_id, COALESCE(i.l, []) AS l FROM tok t LEFT JOIN ids i ON t.doc_id = i.doc_id)
SELECT doc_id, array_to_string(list_concat(list_transform(range(greatest(40 - len(l[1:40]), 0)), lambda i: 0),
                                           l[1:40]), ',') AS padded
FROM full_ids
""")
def q_pad(spark, d):
    t = _tokens(spark, d)
    index = text.word_index(text.vocabulary(t, "doc_id", "tokens", 3))
    ids = text.encode_tokens(t, "doc_id", "tokens", index)
    return ids.select("doc_id", F.array_join(pad_sequence("ids", 40, 0), ",").alias("padded"))


@query("q_tfidf", "T9", f"""
WITH {TOK_CTE},
tf AS (SELECT doc_id, word, COUNT(*) AS tf FROM (SELECT doc_id, unnest(tokens) AS word FROM tok) u GROUP BY 1, 2),
df AS (SELECT word, COUNT(*) AS df, SUM(tf) AS cf FROM tf GROUP BY word),
n AS (SELECT COUNT(DISTINCT doc_id) AS n FROM tok)
SELECT tf.doc_id, tf.word, tf.tf, df.df, CAST(df.cf AS BIGINT) AS cf,
       round(tf.tf * ln((n.n + 1.0) / (df.df + 1.0)), 6) AS tfidf
FROM tf JOIN df ON tf.word = df.word, n
""")
def q_tfidf(spark, d):
    out = text.tf_idf(_tokens(spark, d), "doc_id", "tokens")
    return out.select("doc_id", "word", "tf", "df", "cf", F.round("tfidf", 6).alias("tfidf"))


@query("q_doc_embed_sum", "J5, F31", f"""
WITH {TOK_CTE}, {VOCAB_CTE},
w AS (SELECT word, ln(CAST(n AS DOUBLE)) AS weight FROM vocab),
s AS (SELECT doc_id, SUM(w.weight) AS total FROM (SELECT doc_id, unnest(tokens) AS word FROM tok) u
      JOIN w ON u.word = w.word GROUP BY doc_id)
SELECT t.doc_id, round(COALESCE(s.total, 0.0), 6) AS total FROM tok t LEFT JOIN s ON t.doc_id = s.doc_id
""")
def q_doc_embed_sum(spark, d):
    t = _tokens(spark, d)
    weights = text.vocabulary(t, "doc_id", "tokens", 3).select("word", "n", F.log(F.col("n").cast("double")).alias("weight"))
    out = text.sum_lookup(t, "doc_id", "tokens", weights, "word", "weight", rows="n")
    return out.select("doc_id", F.round("total", 6).alias("total"))


@query("q_split_encode_pad", "F17, F19, F20, U3, F30", """
WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS words FROM part),
dict AS (SELECT word, row_number() OVER (ORDER BY word) - 1 AS tok
         FROM (SELECT DISTINCT unnest(words) AS word FROM w) u),
k AS (SELECT COUNT(*) AS n FROM dict),
ex AS (SELECT p_partkey, unnest(words) AS word, unnest(range(len(words))) AS pos FROM w),
enc AS (SELECT ex.p_partkey, list(dict.tok ORDER BY ex.pos) AS toks FROM ex JOIN dict ON ex.word = dict.word
        GROUP BY ex.p_partkey)
SELECT p_partkey, array_to_string(toks, ',') AS tokens,
       array_to_string(list_concat(list_transform(range(greatest(4 - len(toks), 0)), lambda i: k.n), toks), ',') AS padded,
       array_to_string(list_transform(range(k.n), lambda i: CAST(list_contains(toks, i) AS INTEGER)), ',') AS hot
FROM enc, k
""")
def q_split_encode_pad(spark, d):
    p = table(spark, d, "part").select("p_partkey", S.split_array("p_name", " ").alias("words"))
    words = dictionary.distinct_elements(p, "words", "word")
    dic = dictionary.dictionary(words, "word", token="tok").cache()
    n = dic.count()
    enc = dictionary.encode_array(p, "p_partkey", "words", dic, "word", "tok", out="toks")
    return enc.select(
        "p_partkey", F.array_join("toks", ",").alias("tokens"),
        F.array_join(S.left_pad("toks", 4, n), ",").alias("padded"),
        F.array_join(S.multi_hot("toks", n), ",").alias("hot"),
    )


_P0_SQL = "1.0 / (1.0 + exp(-(ln(CAST(d.n_chars AS DOUBLE)) - 7.5)))"


@query("q_pseudo_label", "M22, U4, J9", f"""
WITH s AS (
  SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'semi' ELSE 'train' END AS pool,
         CAST(l.quality AS VARCHAR) AS label, {_P0_SQL} AS p0
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
SELECT doc_id,
       CASE WHEN pool = 'semi' AND (p0 >= 0.87 OR p0 <= 1.0 - 0.87) THEN 'train' ELSE pool END AS pool,
       CASE WHEN pool = 'semi' AND p0 >= 0.87 THEN '0' WHEN pool = 'semi' AND p0 <= 1.0 - 0.87 THEN '1'
            ELSE label END AS label
FROM s
""")
def q_pseudo_label(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars")
    lab = table(spark, d, "labels").select("doc_id", "quality")
    j = joins.attach_labels(docs, lab, "doc_id")
    j = j.select("doc_id", F.when(F.col("quality").isNull(), F.lit("semi")).otherwise(F.lit("train")).alias("pool"),
                 F.col("quality").cast("string").alias("label"),
                 S.sigmoid(F.log(F.col("n_chars").cast("double")) - 7.5).alias("p0"))
    return semi.promote(j, "p0", threshold=0.87).select("doc_id", "pool", "label")


@query("q_attach_labels", "J9", """
SELECT d.doc_id, d.lang, l.quality, l.toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def q_attach_labels(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    return joins.attach_labels(docs, table(spark, d, "labels"), "doc_id").select("doc_id", "lang", "quality", "toxic")


@query("q_counts", "A18, A15", """
SELECT COUNT(*) AS n_docs, COUNT(DISTINCT d.lang) AS n_langs, CAST(count_if(l.quality IS NOT NULL) AS BIGINT) AS n_labeled,
       CAST(count_if(l.toxic = 1) AS BIGINT) AS n_toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
""")
def q_counts(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "lang")
    j = joins.attach_labels(docs, table(spark, d, "labels"), "doc_id")
    return j.agg(F.count(F.lit(1)).alias("n_docs"), F.count_distinct("lang").alias("n_langs"),
                 F.count_if(F.col("quality").isNotNull()).alias("n_labeled"),
                 F.count_if(F.col("toxic") == 1).alias("n_toxic"))
