"""The queries of this subpackage and their SQL, by name."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .attention_lm import attention_scores
from .common import scratch, table
from .decontaminate import contamination
from .licenses import license_scan
from .line_dedup import line_dedup
from .ngram_join import link_components
from .packing import pack
from .quality import compression_bands
from .quality_pu import quality
from .spelling import spelling_variants
from .token_cache import fill, token_counts
from .toxicity import toxicity
from .vector_codes import vector_codes
from .warc import round_trip


def op1_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = round_trip(table(spark, sf_dir, "pages"))
    return captures.select("page_id", "response.payload_bytes", "response.payload_digest", "response.record_type", "response.refers_to")


def op2_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compression_bands(table(spark, sf_dir, "documents"))


def op4_attention_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return attention_scores(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op5_digest_cache(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Half of the rows, by a hash of the id, fill the cache first; then all rows meet it."""
    docs, tokenizer, cache = table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), scratch(spark, "token_counts")
    fill(docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(2)) == 0), tokenizer, cache)
    return token_counts(docs, tokenizer, cache)


def op6_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_components(table(spark, sf_dir, "documents"), n=3, percent=90)


def op7_line_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), counts=True)


def op8_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_noisy_channel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_signature_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(table(spark, sf_dir, "documents"))


def op11_errata_tries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op12_yinyang_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(table(spark, sf_dir, "embeddings"))


def op13_positive_unlabelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}


OP1_SQL = """SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to FROM (
SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST((CAST('0x' || substr(sha1(coalesce(html, '')) || '00', 1 + CAST(i * 5 // 4 AS INTEGER), 3) AS BIGINT) >> CAST(7 - (i * 5) % 4 AS BIGINT)) & 31 AS INTEGER), 1)), '') AS payload_digest FROM pages))"""

OP6_SQL = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS x FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(x) >= 3 THEN list_transform(range(1, len(x) - 1), lambda i: array_to_string(x[i:i + 2], ' ')) WHEN len(x) > 0 THEN [array_to_string(x, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
l AS (SELECT a.doc_id AS p, b.doc_id AS q FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id JOIN n m ON m.doc_id = a.doc_id JOIN n k ON k.doc_id = b.doc_id GROUP BY 1, 2, m.n, k.n HAVING 100 * count(*) >= 90 * (m.n + k.n - count(*))),
e AS (SELECT p, q FROM l UNION ALL SELECT q, p FROM l),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT r.doc_id, e.q FROM r JOIN e ON r.c = e.p)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, d.c AS component_id FROM (SELECT doc_id, min(c) AS c FROM r GROUP BY 1) d LEFT JOIN n USING (doc_id)"""

OP8_SQL = r"""WITH f AS (SELECT 'd' AS kind, CAST(doc_id AS VARCHAR) AS id, text FROM documents UNION ALL SELECT 'b', CAST(item_id AS VARCHAR), text FROM benchmark),
w AS (SELECT kind, id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS x FROM f),
lens AS (SELECT DISTINCT least(10, len(x)) AS k FROM w WHERE kind = 'b' AND len(x) > 0),
b AS (SELECT id AS item, least(10, len(x)) AS k, unnest(range(1, len(x) - least(10, len(x)) + 2)) AS j, unnest(list_transform(range(1, len(x) - least(10, len(x)) + 2), lambda i: array_to_string(x[i:i + least(10, len(x)) - 1], ' '))) AS g FROM w WHERE kind = 'b' AND len(x) > 0),
d AS (SELECT id, k, unnest(range(1, len(x) - k + 2)) AS i, unnest(list_transform(range(1, len(x) - k + 2), lambda i: array_to_string(x[i:i + k - 1], ' '))) AS g FROM w, lens WHERE kind = 'd' AND len(x) >= k),
h AS (SELECT DISTINCT d.id, d.i, d.k, b.item, b.j FROM d JOIN b ON d.g = b.g AND d.k = b.k),
c AS (SELECT id, count(DISTINCT p) AS n_hit FROM (SELECT id, unnest(range(i, i + k)) AS p FROM h) GROUP BY 1),
t AS (SELECT id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM h GROUP BY 1),
m AS (SELECT id, item, min(i) - 1 AS i, min(j) - 1 AS j, count(*) + max(k) - 1 AS n FROM (SELECT *, i - row_number() OVER (PARTITION BY id, item, i - j ORDER BY i) AS run FROM h) GROUP BY id, item, i - j, run),
l AS (SELECT id, n, i, item, j FROM m QUALIFY row_number() OVER (PARTITION BY id ORDER BY n DESC, i, item, j) = 1)
SELECT CAST(w.id AS BIGINT) AS doc_id, CAST(len(x) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated, CAST(l.n AS BIGINT) AS longest_match, l.item AS longest_item, CAST(l.i AS BIGINT) AS longest_at, CAST(l.j AS BIGINT) AS longest_item_at FROM w LEFT JOIN c ON c.id = w.id LEFT JOIN t ON t.id = w.id LEFT JOIN l ON l.id = w.id WHERE kind = 'd'"""


OP11_SQL = r"""WITH RECURSIVE tab AS MATERIALIZED (SELECT list(c ORDER BY b) AS t FROM (SELECT b, list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) AS c FROM (SELECT unnest(range(256)) AS b))),
r AS (SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS k FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]{7,}')) AS run FROM documents) GROUP BY 1, 2),
h AS (SELECT run, k, xor(list_reduce(list_transform(range(strlen(id || ':' || run)), lambda i: CAST('0x' || substr(hex(id || ':' || run), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)), lambda c, x: xor(c >> 8, t[CAST((xor(c, x) & 255) + 1 AS INTEGER)]), 4294967295), 4294967295) AS h FROM r, tab),
w AS MATERIALIZED (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM (SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS INTEGER)) || substr(run, CAST(h % length(run) AS INTEGER) + 2) ELSE run END AS word, k FROM h) WHERE length(word) >= 7 GROUP BY 1 HAVING sum(k) >= 2),
d AS MATERIALIZED (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, CAST(unnest(range(1, length(word) + 1)) AS INTEGER) AS i FROM w)),
p AS (SELECT a.word AS a, a.n AS an, b.word AS b, b.n AS bn FROM d a JOIN d b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word UNION SELECT a.word, a.n, b.word, b.n FROM d a JOIN w b ON a.rest = b.word UNION SELECT b.word, b.n, a.word, a.n FROM d a JOIN w b ON a.rest = b.word),
f AS MATERIALIZED (SELECT a AS word, count(*) AS n_near, arg_min(b, (-bn, encode(b))) AS b, max(bn) AS bn FROM p GROUP BY 1),
x AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN bn >= 10 * n THEN b END AS form, CASE WHEN bn >= 10 * n THEN bn END AS form_n FROM w LEFT JOIN f USING (word)),
s AS (SELECT word, word AS root, form AS nxt FROM x UNION ALL SELECT s.word, s.nxt, x.form FROM s JOIN x ON x.word = s.nxt)
SELECT x.word, x.form, s.root, x.n, x.n_near, x.form_n FROM x JOIN s ON s.word = x.word AND s.nxt IS NULL"""

#: Entries of a round from those before: nearest entry of each part, then floors of means.
OP12_ROUND = """, a{r} AS MATERIALIZED (SELECT v, p, min({{'d': list_inner_product(y, y) - 2 * list_inner_product(y, e) + list_inner_product(e, e), 'j': j}}) AS m FROM y JOIN c{r} USING (p) GROUP BY v, p),
c{s} AS MATERIALIZED (SELECT p, j, coalesce(n.e, c.e) AS e FROM c{r} c LEFT JOIN (SELECT p, j, list(s ORDER BY i) AS e FROM (SELECT p, m.j AS j, i, floor(sum(z) / count(*)) AS s FROM (SELECT v, p, generate_subscripts(y, 1) AS i, unnest(y) AS z FROM y) JOIN a{r} USING (v, p) GROUP BY 1, 2, 3) GROUP BY 1, 2) n USING (p, j))"""

OP12_SQL = (
    """WITH k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id) AS v, vec_id, label, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS x FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: coalesce(isfinite(x), false))) = len(embedding)),
y AS MATERIALIZED (SELECT v, p, x[p * len(x) // 4 + 1 : (p + 1) * len(x) // 4] AS y FROM k, range(4) t(p)),
c0 AS MATERIALIZED (SELECT p, v - 1 AS j, y AS e FROM y WHERE v <= 256)"""
    + "".join(OP12_ROUND.format(r=r, s=r + 1) for r in range(5))
    + """, g AS (SELECT v, string_agg(printf('%02x', CAST(m.j AS INTEGER)), '' ORDER BY p) AS code, CAST(sum(m.d) AS BIGINT) AS error FROM a4 GROUP BY 1)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT sha256(string_agg(array_to_string(list_transform(e, lambda x: CAST(CAST(x AS BIGINT) AS VARCHAR)), ','), ',' ORDER BY p, j)) FROM c4) AS codebooks_sha256 FROM k JOIN g USING (v)"""
)


def oracle_sql() -> dict[str, str]:
    """Where SQL can express a query: not models, compressors, tokenizers or packings."""
    return {"op1_warc_transactions": OP1_SQL, "op6_ngram_jaccard": OP6_SQL, "op8_suffix_arrays": OP8_SQL, "op11_errata_tries": OP11_SQL, "op12_yinyang_codes": OP12_SQL}
