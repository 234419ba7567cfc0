"""The operators over the test tables, by query name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickloom.llm import conversations, decontaminate, fingerprints, hard_negatives, language, licences, line_dedup, main_text, neighbours, packing, quality, simhash, token_files
from tickloom.llm.sampling import remainder
from tickloom.workspace import new_folder

Run = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Run] = {}
ORACLES: dict[str, str] = {}


def query(run: Run) -> Run:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op4_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"), tokenizer_file("byte_bpe_50k.json"), end_id=0)


@query
def op7_rans_token_files(spark: SparkSession, folder: str) -> DataFrame:
    path = new_folder(spark, "token-files")
    token_files.write_ids(table(spark, folder, "documents"), tokenizer_file("word_bpe_49k.json"), path, end_id=1)
    return token_files.read_documents(spark, path)


@query
def op10_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = line_dedup.dedup_lines(table(spark, folder, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


ORACLES["op10_line_dedup"] = """
WITH cut AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), numbered AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM cut
), keyed AS (
  SELECT *, translate(
      trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM numbered
), repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
  SELECT k.*, r.key IS NOT NULL AND k.doc_id <> r.keeper AS lost FROM keyed k LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT lost), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query
def op6_suffix_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    found = decontaminate.find_matches(docs, table(spark, folder, "benchmark"))
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.n_hit(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = f"regexp_extract_all({_FOLDED}, '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')"
ORACLES["op6_suffix_decontamination"] = f"""
WITH item AS (
  SELECT item_id, {_WORDS} AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, list_aggregate(w[k : k + least(10, len(w)) - 1], 'string_agg', ' ') AS win, least(10, len(w)) AS size
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS k FROM item WHERE len(w) > 0)
), doc AS (
  SELECT doc_id, {_WORDS} AS w FROM documents
), sizes AS (
  SELECT DISTINCT size FROM windows
), spot AS (
  SELECT doc_id, k, size, list_aggregate(w[k : k + size - 1], 'string_agg', ' ') AS win
  FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM doc, sizes WHERE len(w) >= size)
), found AS (
  SELECT doc_id, k, s.size, item_id FROM spot s JOIN windows USING (win, size)
), hit AS (
  SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM found) GROUP BY doc_id
), owned AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN owned USING (doc_id)
"""


@query
def op5_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"))


def _is(doc_id: Column, divisor: int, value: int) -> Column:
    return F.coalesce(remainder(doc_id, divisor) == value, F.lit(False))


@query
def op1_byte_cnn_quality(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = _is(F.col("doc_id"), 5, 0)
    net = quality.learn(docs, table(spark, folder, "labels"), ~held_out & F.col("doc_id").isNotNull())
    scored = quality.score(docs, net)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query
def op3_rank_order_language(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    held_out = _is(F.col("doc_id"), 4, 2)
    profiles = language.learn(docs, ~held_out & F.col("doc_id").isNotNull())
    return language.identify(docs.select("doc_id", "text"), profiles).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op8_multi_index_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return neighbours.nearest(vectors.where("vec_id % 20 = 0"), vectors, k=20)


@query
def op2_boosted_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return main_text.extract(table(spark, folder, "pages")).select("page_id", "url", "text", "n_chars")


@query
def op9_licence_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licences.scan(table(spark, folder, "documents").select("doc_id", "text"))
    names = F.array_join(F.array_sort(F.array_distinct("notices.license")), ",")
    return found.select("doc_id", "license", "dice", F.size("notices").cast("long").alias("n_notices"), names.alias("licenses"))


def _bag(source: str) -> str:
    """Bigrams of `words` with their counts, by the keys of a source (key, words)."""
    return f"SELECT key, words[k] || ' ' || words[k + 1] AS pair, count(*) AS n FROM (SELECT key, words, unnest(range(1, len(words))) AS k FROM {source}) GROUP BY ALL"


def _licence_sql() -> str:
    quoted = ", ".join(f"""({k}, '{name}', '{text.replace("'", "''")}')""" for k, (name, text) in enumerate(licences.TEMPLATES))
    return f"""
WITH template AS (
  SELECT key, license, {_WORDS} AS words FROM (VALUES {quoted}) t(key, license, text)
), part AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS text FROM documents
  UNION ALL
  SELECT * FROM (SELECT doc_id, unnest(regexp_split_to_array(text, '\n[ \t\r]*\n')) AS text FROM documents) WHERE contains(text, chr(10))
), segment AS (
  SELECT row_number() OVER () AS key, doc_id, {_WORDS} AS words FROM part
), common AS (
  SELECT s.key, t.key AS template, sum(least(s.n, t.n)) AS c FROM ({_bag("segment")}) s JOIN ({_bag("template")}) t USING (pair) GROUP BY ALL
), judged AS (
  SELECT s.doc_id, s.key, t.license, 2.0::DOUBLE * c / (len(s.words) - 1 + len(t.words) - 1) AS dice
  FROM common JOIN segment s USING (key) JOIN template t ON t.key = template
), notice AS (
  SELECT * FROM judged WHERE dice >= {licences.THRESHOLD}::DOUBLE QUALIFY row_number() OVER (PARTITION BY key ORDER BY dice DESC, license) = 1
), best AS (
  SELECT doc_id, license, dice FROM notice QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY dice DESC, license) = 1
), total AS (
  SELECT doc_id, count(*) AS n_notices, string_agg(DISTINCT license, ',' ORDER BY license) AS licenses FROM notice GROUP BY doc_id
)
SELECT doc_id, coalesce(license, '') AS license, coalesce(dice, 0.0::DOUBLE) AS dice, coalesce(n_notices, 0) AS n_notices, coalesce(licenses, '') AS licenses
FROM documents LEFT JOIN best USING (doc_id) LEFT JOIN total USING (doc_id)
"""


ORACLES["op9_licence_scan"] = _licence_sql()


@query
def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    return conversations.repairs(conversations.damage(table(spark, folder, "conversations")))


@query
def op11_improbable_features(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints.compare_edits(table(spark, folder, "documents"))


def _repair_sql() -> str:
    """Least cost, audit and repaired text of every ending, for each state of the grammar, from the last row to the first."""
    onward = (2, 2, 3, 2)

    def way(cost: str, edit: str, q: int, line: str = "") -> str:
        return f"{{'c': {cost} + s{q}.c, 'a': '{edit}' || s{q}.a, 't': {line + ' || ' if line else ''}s{q}.t}}"

    def best(q: int) -> str:
        added = f"chr(10) || '{'assistant' if q == 2 else 'user'}:' || text"
        kept = {0: [("s", 1), ("u", 2)], 1: [("u", 2)], 2: [("a", 3)], 3: [("u", 2)]}[q]
        ways = [way("2", "D", q), f"CASE WHEN NOT gone THEN {way('1 + extra', 'R', onward[q], added)} END"]
        ways += [f"CASE WHEN NOT gone AND initial = '{i}' THEN {way('extra', 'K', to, 'chr(10) || role || chr(58) || text')} END" for i, to in kept]
        return f"least({', '.join(ways)})"

    def inserted(q: int, then: str) -> str:
        return f"{{'c': 5 + {then}.c, 'a': 'I' || {then}.a, 't': chr(10) || '{'assistant:' if q == 2 else 'user:'}' || {then}.t}}"

    return f"""
WITH RECURSIVE one AS (
  SELECT list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS step
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(key) + 1), lambda i: ascii(substr(key, i, 1))::BIGINT)),
    lambda a, b: xor(a >> 8, step[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS k FROM keyed, one
), damaged AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
    CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
    unnest(range(CASE k WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) FROM hashed
), placed AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS k FROM damaged
), judged AS (
  SELECT *, CASE WHEN body = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'd'
      WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    lag(initial) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM placed
), marked AS (
  SELECT *, fault IN ('b', 'd') AS gone, CASE fault WHEN 't' THEN 5 ELSE 0 END AS extra FROM judged
), figures AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps,
    count(*) FILTER (WHERE fault = 'b') AS blank, count(*) FILTER (WHERE fault = 'd') AS duplicate, count(*) FILTER (WHERE fault = 't') AS truncated,
    count(*) FILTER (WHERE before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM marked GROUP BY conv_id
), ending AS (
  SELECT conv_id, n AS k, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s0, {{'c': 10::BIGINT, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS s1,
    {{'c': 5::BIGINT, 'a': 'I', 't': chr(10) || 'assistant:'}} AS s2, {{'c': 0::BIGINT, 'a': '', 't': ''}} AS s3 FROM figures
  UNION ALL
  SELECT conv_id, k - 1, least(b0, {inserted(0, 'c2')}), least(b1, {inserted(1, 'c2')}), c2, c3 FROM (
    SELECT *, least(b2, {inserted(2, 'b3')}) AS c2, least(b3, {inserted(3, 'b2')}) AS c3 FROM (
      SELECT m.conv_id, m.k, {best(0)} AS b0, {best(1)} AS b1, {best(2)} AS b2, {best(3)} AS b3
      FROM ending e JOIN marked m ON m.conv_id IS NOT DISTINCT FROM e.conv_id AND m.k = e.k))
), repaired AS (
  SELECT conv_id, s0.c AS cost, s0.a AS audit, sha256(substr(s0.t, 2)) AS repaired_sha256 FROM ending WHERE k = 0
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN figures f ON f.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN repaired r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""


ORACLES["op13_conversation_repair"] = _repair_sql()


@query
def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "embeddings").select("vec_id", F.expr("IF(vec_id % 7 = 0, (label + 1) % 10, label)").alias("label"), "embedding")
    return hard_negatives.mine(hard_negatives.integer_rows(rows), F.col("vec_id") % 50 == 0)


ORACLES["op12_hard_negatives"] = """
WITH whole AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM whole a JOIN whole b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
), positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
), ranked AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
  FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM ranked WHERE rank <= 3
"""
