"""The operators as registered queries, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import chat, pii, quality_lm, toxicity, vector_codes
from tessera.llm.bpe import round_trip
from tessera.llm.chat import format_chats
from tessera.llm.decontaminate import find_contamination
from tessera.llm.fingerprints import fingerprint_with_next
from tessera.llm.jaccard_join import jaccard_components
from tessera.llm.ranked_search import rank
from tessera.llm.suffix_dedup import remove_repeats
from tessera.llm.token_files import crc32, new_folder, read_tokens, write_tokens
from tessera.llm.warc import read_archives, write_archives

VOCABULARY = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return add


#: Lower-cased words of a text as the contract of decontamination has them.
_WORDS_1 = r"regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


@query(
    f"""
WITH d AS (SELECT doc_id, coalesce({_WORDS_1.format("text")}, []::VARCHAR[]) w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) item, {_WORDS_1.format("text")} w FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT item, w, least(len(w), 10) k, unnest(range(greatest(len(w) - 9, 1))) a FROM i WHERE len(w) > 0),
v AS (SELECT DISTINCT item, k, list_slice(w, a + 1, a + k) win FROM p),
ks AS (SELECT DISTINCT k FROM v),
o AS (SELECT doc_id, w, k, unnest(range(len(w) - k + 1)) a FROM d, ks WHERE len(w) >= k),
h AS (SELECT doc_id, a, o.k, item FROM o JOIN v ON v.k = o.k AND v.win = list_slice(o.w, o.a + 1, o.a + o.k)),
hw AS (SELECT doc_id, count(DISTINCT pos) n_hit FROM (SELECT doc_id, unnest(range(a, a + k)) pos FROM h) GROUP BY doc_id),
hi AS (SELECT doc_id, count(*) n_items, string_agg(item, ',' ORDER BY item) items FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) n_words, CAST(coalesce(n_hit, 0) AS BIGINT) n_hit, CAST(coalesce(n_items, 0) AS BIGINT) n_items,
  sha256(coalesce(items, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
FROM d LEFT JOIN hw USING (doc_id) LEFT JOIN hi USING (doc_id)
"""
)
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return found.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (n_hit > 0).alias("contaminated"),
    )


@query()
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path(VOCABULARY))


def bpe_digests(docs: DataFrame, path: str) -> DataFrame:
    """Ids and decoded text of each row as digests."""
    coded = round_trip(docs, path)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query()
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "token-files")
    files = write_tokens(table(spark, sf_dir, "documents"), folder, public_tokenizers.path(VOCABULARY))
    return read_tokens(spark, folder, files, digest=crc32).withColumnRenamed("digest", "ids_crc32")


@query()
def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_with_next(table(spark, sf_dir, "documents"))


@query(
    """
WITH p AS (SELECT page_id, coalesce(html, '') html FROM pages),
d AS (SELECT page_id, html, CAST(octet_length(encode(html)) AS BIGINT) payload_bytes, unhex(sha1(html)) h, max(page_id) OVER (PARTITION BY html) largest FROM p),
b AS (SELECT *, list_transform(range(32), lambda i: (
    (CAST(get_bit(CAST(h AS BIT), CAST(5 * i AS INTEGER)) AS INTEGER) * 16) + (CAST(get_bit(CAST(h AS BIT), CAST(5 * i + 1 AS INTEGER)) AS INTEGER) * 8)
    + (CAST(get_bit(CAST(h AS BIT), CAST(5 * i + 2 AS INTEGER)) AS INTEGER) * 4) + (CAST(get_bit(CAST(h AS BIT), CAST(5 * i + 3 AS INTEGER)) AS INTEGER) * 2)
    + CAST(get_bit(CAST(h AS BIT), CAST(5 * i + 4 AS INTEGER)) AS INTEGER))) digits FROM d)
SELECT page_id, payload_bytes, list_aggregate(list_transform(digits, lambda x: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', x + 1, 1)), 'string_agg', '') payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END record_type, CASE WHEN page_id = largest THEN NULL ELSE largest END refers_to
FROM b
"""
)
def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "archives")
    files = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(spark, folder, files, with_payload=False).drop("url")


#: Of the digests of a formatted conversation; per conversation, on what was read back.
_CHAT = "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long"


@query(
    r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') role, coalesce(text, '') text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))),
f AS (SELECT *, replace(replace(role, '\', '\\'), '<|', '<\|') r, replace(replace(text, '\', '\\'), '<|', '<\|') t FROM c)
SELECT conv_id, count(*) n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) loss_sha256,
  CAST(sum(length(r) + length(t) + 4 + 1 + 13 + 13 + 1) AS BIGINT) formatted_chars
FROM f GROUP BY conv_id
"""
)
def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", probe), (-7, 1, "assistant", probe)], chats.schema)
    done = format_chats(chats.unionByName(extra), public_tokenizers.path(VOCABULARY))

    def digests(batches):
        for batch in batches:
            rows = []
            for conv_id, formatted, spans in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "formatted", "spans")), strict=True):
                turns = chat.parse(formatted)
                loss = "".join(chat.unescape(formatted[s["start"] : s["end"]]) for s in spans)
                whole = "".join(f"{role}\n{text}\n" for role, text in turns)
                rows.append((conv_id, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(formatted)))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [[]] * 6, kinds, strict=True)], names=[x.split()[0] for x in _CHAT.split(", ")])

    return done.select("conv_id", "formatted", "spans").mapInArrow(digests, _CHAT)


@query(
    r"""
WITH w AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []::VARCHAR[]) w FROM documents),
g AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 5 THEN w ELSE list_slice(w, a + 1, a + 5) END s FROM (SELECT doc_id, w, unnest(range(greatest(len(w) - 4, 1))) a FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) n FROM g GROUP BY doc_id),
o AS (SELECT x.doc_id a, y.doc_id b, count(*) o FROM g x JOIN g y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 80 * (x.n + y.n - o)),
r AS (WITH RECURSIVE r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a) SELECT * FROM r)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) n_shingles, least(w.doc_id, coalesce(m, w.doc_id)) component_id
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a doc_id, min(b) m FROM r GROUP BY a) USING (doc_id)
"""
)
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0


def toxicity_model(docs: DataFrame, labels: DataFrame):
    return toxicity.fit(docs, labels.filter(~held_out(F.col("doc_id"))))


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted", "evidence")


@query()
def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find(docs, pii.fit(docs))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("base_spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(k) for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(F.col("base_spans")).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


@query()
def op4_quality_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_lm.classify(docs, table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id"))


@query()
def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    code = F.array_join(F.transform("code", lambda e: F.lower(F.lpad(F.hex(e), 2, "0"))), "")
    return coded.select("vec_id", code.alias("code"), "error", "label_error", F.lit(vector_codes.codebooks_digest(codebooks)).alias("codebooks_sha256"))


@query()
def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return cut.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: Terms of ranked search: only A-Z are lower-cased, whole texts.
_TERMS = r"coalesce(regexp_extract_all(translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), []::VARCHAR[])"


@query(
    f"""
WITH d AS (SELECT row_number() OVER () r, doc_id, {_TERMS.format("text")} w FROM documents),
g AS (SELECT CAST(count(*) FILTER (len(w) > 0) AS BIGINT) nn, CAST(sum(len(w)) AS BIGINT) ll FROM d),
i AS (SELECT item_id, t, count(*) c FROM (SELECT item_id, unnest({_TERMS.format("text")}) t FROM benchmark) GROUP BY ALL),
p AS (SELECT r, t, count(*) tf FROM (SELECT r, unnest(w) t FROM d) WHERE t IN (SELECT t FROM i) GROUP BY ALL),
f AS (SELECT t, CAST(floor(1000 * ln(CAST(2 * (SELECT nn FROM g) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) wt FROM p GROUP BY t),
m AS (SELECT r, doc_id, 75 + (25 * len(w) * nn) // ll m FROM d, g),
s AS (SELECT item_id, r, doc_id, CAST(sum(c * wt * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) score FROM i JOIN p USING (t) JOIN f USING (t) JOIN m USING (r) GROUP BY ALL),
o AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) rank, doc_id, score FROM o WHERE rank <= 20
"""
)
def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
