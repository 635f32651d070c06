"""The registered queries of the text operators, and the SQL of those that SQL can express."""

import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from downfold.llm import decontaminate, exact_dedup, hard_negatives, line_dedup, lm_scoring, mixing, ngram_join, periodic_runs
from downfold.llm import pii, token_counts, toxicity, url_filter, wavelet
from downfold.llm.common import read_table

TOKENIZER = "byte_bpe_50k.json"
UP, LOW = string.ascii_uppercase, string.ascii_lowercase


def _sha(text):
    return F.sha2(text.cast("binary"), 256)


def op1_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_lengths(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op2_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mixed(read_table(spark, sf_dir, "documents"))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "source")


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN text IS NULL THEN 0
    ELSE len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) END::BIGINT AS size,
    (('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13))::BIGINT::DOUBLE + 0.5)
      / 4503599627370496.0 AS u
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size,
    row_number() OVER (ORDER BY source ASC NULLS LAST) AS place
  FROM d GROUP BY source),
w AS (
  SELECT *, CASE (place - 1) % 3 WHEN 0 THEN 5.0 WHEN 1 THEN 2.0 ELSE 1.0 END::DOUBLE AS weight,
    source_size::DOUBLE * 2 AS cap, (sum(source_size) OVER ())::DOUBLE * 1.5 AS all_words FROM s),
l AS (
  SELECT *, (all_words - (sum(cap) OVER (ORDER BY cap / weight, place) - cap))
    / sum(weight) OVER (ORDER BY cap / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w),
t AS (
  SELECT source, source_size, least(cap, coalesce(
    (max(CASE WHEN level <= cap / weight THEN level END) OVER ()) * weight, cap)) AS target FROM l),
r AS (
  SELECT d.*, source_size, target,
    CASE WHEN source_size > 0 THEN least(target / source_size, 2.0) ELSE 0.0 END AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
q AS (
  SELECT *, floor(rate)::BIGINT AS certain, rate - floor(rate) AS f FROM r),
o AS (
  SELECT *, target - sum(certain * size) OVER (PARTITION BY source) AS wanted,
    CASE WHEN f > 0 THEN (u / (1 - u)) / (f / (1 - f)) ELSE 'inf'::DOUBLE END AS odds FROM q),
c AS (
  SELECT *, sum(size) OVER (PARTITION BY source ORDER BY odds, doc_id, size
    ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size / 2.0 AS middle FROM o)
SELECT doc_id, size, source_size, target, source,
  ((certain + CASE WHEN certain < 2 AND size > 0 AND middle <= wanted THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM c
"""


def op3_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.encoded(read_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))


def op4_wu_manber(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items", _sha(F.array_join("items", ",")).alias("items_sha256"), "contaminated"
    )


OP4_SQL = rf"""
WITH b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
    regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
pat AS (
  SELECT DISTINCT item, least(len(ws), 10) AS k,
    array_to_string(list_slice(ws, i, i + least(len(ws), 10) - 1), ' ') AS win
  FROM (SELECT item, ws, unnest(generate_series(1, greatest(1, len(ws) - 9))) AS i FROM b WHERE len(ws) > 0)),
d AS (
  SELECT doc_id,
    regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
dw AS (
  SELECT doc_id, i, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS win
  FROM (SELECT doc_id, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i
        FROM d, (SELECT DISTINCT k FROM pat) WHERE len(ws) >= k)),
hit AS (SELECT doc_id, i, dw.k, item FROM dw JOIN pat ON dw.k = pat.k AND dw.win = pat.win),
words AS (
  SELECT doc_id, count(DISTINCT p)::BIGINT AS n_hit
  FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM hit) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(item, ',' ORDER BY item) AS names
  FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op5_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(read_table(spark, sf_dir, "documents"))


def op6_toxicity_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_groups(read_table(spark, sf_dir, "documents"))


OP7_SQL = rf"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UP}', '{LOW}'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 3), ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(generate_series(1, greatest(1, len(ws) - 3))) AS i FROM d WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*)::BIGINT AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (
  SELECT a, b FROM p JOIN n x ON a = x.doc_id JOIN n y ON b = y.doc_id
  WHERE 100 * common >= 85 * (x.n + y.n - common)),
r AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.b) AS component_id,
  (SELECT count(*) FROM e WHERE e.a = d.doc_id) AS n_links
FROM d JOIN r ON r.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY ALL
"""


def op8_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(read_table(spark, sf_dir, "documents"))


OP8_SQL = f"""
WITH n AS (SELECT doc_id, translate(coalesce(text, ''), '{UP}', '{LOW}') AS norm FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256 FROM n
"""


def op9_line_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.dedup_lines(read_table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", _sha(F.col("kept_text")).alias("kept_sha256"))


OP9_SQL = f"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    unnest(generate_series(1, len(string_split(coalesce(text, ''), chr(10))))) AS pos FROM documents),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UP}', '{LOW}') AS key
  FROM l),
r AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3)
SELECT doc_id, count(*)::BIGINT AS n_lines,
  count(*) FILTER (WHERE keeper IS NOT NULL AND keeper <> doc_id)::BIGINT AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE keeper IS NULL OR keeper = doc_id), ''))
    AS kept_sha256
FROM k LEFT JOIN r USING (key) GROUP BY doc_id
"""

def op10_cross_entropy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The target is the documents labelled as of good quality, the background all documents.

    Labels grow with the documents, so they are joined by a sort and never broadcast.
    """
    docs = read_table(spark, sf_dir, "documents")
    good = read_table(spark, sf_dir, "labels").filter(F.col("quality") == 1).select("doc_id")
    return lm_scoring.difference_to_marked(docs, good)


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """(doc_id, text) where a tenth of the texts, chosen by the checksum h of doc_id, end in a loop.

    With g = h / 10 and n words, words from a = g % n on repeat the first p of them, p being
    1 + (n - a) / (3 + g % 8); words are then joined by one space. Others stay as they are,
    also texts without a word or a doc_id.
    """
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    rows = docs.select("doc_id", "text", F.crc32(F.col("doc_id").cast("string").cast("binary")).alias("h"))
    rows = rows.withColumn("words", F.when(F.col("h") % 10 == 0, words)).withColumn("g", F.expr("h div 10"))
    rows = rows.withColumn("n", F.when(F.size("words") > 0, F.size("words").cast("long")))
    rows = rows.withColumn("a", F.expr("g % n")).withColumn("p", F.expr("1 + (n - a) div (3 + g % 8)"))
    loop = F.expr(
        "slice(concat(slice(words, 1, int(a)), flatten(array_repeat(slice(words, int(a) + 1, int(p)),"
        " int((n - a) div p + 1)))), 1, int(n))"
    )
    text = F.when(F.col("n").isNotNull(), F.array_join(loop, " ")).otherwise(F.col("text"))
    return rows.select("doc_id", text.alias("text"))


def op11_synchronising_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(with_repeated_tails(read_table(spark, sf_dir, "documents")))


URL_RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]


def op12_url_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(read_table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _url_level(order: int) -> str:
    """Smoothed probabilities of both kinds after ``order`` characters."""
    below = "1.0::DOUBLE / 256" if order == 0 else None
    some = ", ".join(
        f"CASE WHEN sum({c}) OVER w > 0 THEN ({c} + (count(*) FILTER ({c} > 0) OVER w) * {below or 'q.less_' + c})::DOUBLE"
        f" / (sum({c}) OVER w + count(*) FILTER ({c} > 0) OVER w) ELSE {below or 'q.less_' + c} END AS less_{c}"
        for c in "ab"
    )
    joined = "" if order == 0 else f" JOIN p{order - 1} q ON substr(c{order}.piece, 2) = q.piece"
    return f"p{order} AS (SELECT c{order}.piece, {some} FROM c{order}{joined} WINDOW w AS (PARTITION BY left(c{order}.piece, {order})))"


OP12_SQL = rf"""
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, row_number() OVER () AS r,
    strpos(coalesce(url, ''), '://') AS cut FROM pages),
h AS (
  SELECT *, translate(CASE WHEN cut > 0 THEN regexp_extract(substr(url, cut + 3), '^[^/?#]*') ELSE '' END, '{UP}', '{LOW}') AS host,
    CASE WHEN cut > 0 THEN regexp_extract(substr(url, cut + 3), '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path FROM u),
rules(verdict, rule, name, rest) AS (VALUES
  ('allow', 'com/', 'com', '/'), ('block', 'example.com/en/', 'example.com', '/en/'),
  ('allow', 'www.example.com/en/', 'www.example.com', '/en/'), ('block', 'net/es/', 'net', '/es/'),
  ('block', 'net/fr/', 'net', '/fr/')),
d AS (
  SELECT r, page_id, url, host, path, max_by(rule, length(rule)) AS rule, max_by(verdict, length(rule)) AS ruled,
    ('0x' || substr(md5(url), 1, 8))::BIGINT % 5 = 0 AS held
  FROM h LEFT JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, rest)
  GROUP BY r, page_id, url, host, path),
e AS (
  SELECT r, ruled, held, substr(repeat(chr(2), 4) || translate(url, '123456789', '000000000') || chr(3), i, 5) AS piece
  FROM (SELECT *, unnest(generate_series(1, length(url) + 1)) AS i FROM d)),
c4 AS (
  SELECT piece, count(*) FILTER (ruled = 'allow' AND NOT held) AS a, count(*) FILTER (ruled = 'block' AND NOT held) AS b
  FROM e GROUP BY piece),
{"".join(f"c{k} AS (SELECT substr(piece, 2) AS piece, sum(a) AS a, sum(b) AS b FROM c{k + 1} GROUP BY 1), " for k in (3, 2, 1, 0))}
{", ".join(map(_url_level, range(5)))},
w AS (SELECT piece, floor((ln(less_a) - ln(less_b)) * 1048576 + 0.5)::BIGINT AS ratio FROM p4),
s AS (
  SELECT r, greatest(-2000, least(2000, floor(sum(ratio)::DOUBLE * 100.0 / (count(*) * 1048576.0::DOUBLE))))::INT AS bin
  FROM e JOIN w USING (piece) WHERE ruled IS NULL OR held GROUP BY r),
b AS (
  SELECT bin, count(*) FILTER (ruled = 'allow') AS a, count(*) FILTER (ruled = 'block') AS b
  FROM d JOIN s USING (r) WHERE held AND ruled IS NOT NULL GROUP BY bin),
k AS (
  SELECT bin, bin - (bin - coalesce(lag(bin) OVER o, bin)) // 2 AS least_, (sum(a) OVER () - (sum(a) OVER o - a)) * (sum(b) OVER ()) + (sum(b) OVER o - b) * (sum(a) OVER ()) AS right_,
    sum(a) OVER () * sum(b) OVER () AS both_ FROM b WINDOW o AS (ORDER BY bin)),
t AS (SELECT coalesce((SELECT least_ FROM k WHERE both_ > 0 ORDER BY right_ DESC, abs(bin), bin LIMIT 1), 0) AS least_)
SELECT page_id, host, path, rule,
  coalesce(ruled, CASE WHEN bin >= (SELECT least_ FROM t) THEN 'allow' ELSE 'block' END) AS verdict
FROM d LEFT JOIN s USING (r)
"""


def op13_hilbert_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors are rows whose vec_id is divisible by 50; labels of every seventh row are moved on by one."""
    rows = read_table(spark, sf_dir, "embeddings")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vector = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    rows = rows.filter(finite).select(F.col("vec_id").alias("id"), label.alias("label"), vector.alias("vector"))
    return hard_negatives.mine(rows, F.col("id") % 50 == 0)


OP13_SQL = """
WITH v AS (
  SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, list_inner_product(a.v, b.v)::BIGINT AS score
  FROM v a JOIN v b ON a.id <> b.id WHERE a.id % 50 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank,
  id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


QUERIES = {
    "op1_length_histogram": (op1_length_histogram, None),
    "op2_pareto_mix": (op2_pareto_mix, OP2_SQL),
    "op3_wavelet_shards": (op3_wavelet_shards, None),
    "op4_wu_manber": (op4_wu_manber, OP4_SQL),
    "op5_weak_supervision": (op5_weak_supervision, None),
    "op6_toxicity_trees": (op6_toxicity_trees, None),
    "op7_ngram_join": (op7_ngram_join, OP7_SQL),
    "op8_block_naming": (op8_block_naming, OP8_SQL),
    "op9_line_bitmaps": (op9_line_bitmaps, OP9_SQL),
    "op10_cross_entropy": (op10_cross_entropy, None),
    "op11_synchronising_runs": (op11_synchronising_runs, None),
    "op12_url_models": (op12_url_models, OP12_SQL),
    "op13_hilbert_negatives": (op13_hilbert_negatives, OP13_SQL),
}
