"""The registered queries of the operators in this folder, and their reference SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyops.llm import (chat_format, decontaminate, host_rules, html_text, jaccard_join, language_id, line_dedup, merkle,
                        periodic_runs, sentencepiece_codec, token_counts, toxicity, url_filters)
from skyops.session import prepare

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

PIECES = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096


def query(name: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame`` with SQL for the same rows, if SQL can express it."""

    def add(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(prepare(spark), str(sf_dir).rstrip("/"))
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return add


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pieces_digests(docs: DataFrame) -> DataFrame:
    """Ids and decoded texts of all documents, with their digests."""
    both = sentencepiece_codec.encode_and_decode(docs.select("doc_id", "text"), public_tokenizers.path(PIECES))
    return both.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op3_sentencepiece")
def op3_sentencepiece(spark, sf_dir):
    return pieces_digests(table(spark, sf_dir, "documents"))


@query("op6_token_counts")
def op6_token_counts(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path(PIECES))
    return counted.select("doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"),
                          "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


_JACCARD_SQL = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i : array_to_string(w[i : i + 4], ' ')) END) AS s FROM words),
grams AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY 1, 2, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS x, doc_id AS y FROM sets UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS component_id FROM reach GROUP BY x)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, l.component_id FROM sets s JOIN least l ON l.x = s.doc_id
"""


@query("op9_jaccard_join", _JACCARD_SQL)
def op9_jaccard_join(spark, sf_dir):
    return jaccard_join.join(table(spark, sf_dir, "documents"))


_QUALITY_SQL = r"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
words AS MATERIALIZED (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w FROM docs),
grams AS (SELECT r, unnest(range(1, len(w) - 3)) AS i, unnest(list_transform(range(1, len(w) - 3),
  lambda i : array_to_string(w[i : i + 4], ' '))) AS g FROM words WHERE len(w) >= 5),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM grams) WHERE c > 1),
covered AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM again) GROUP BY r),
lines AS (SELECT r, list_filter(string_split(text, chr(10)), lambda l : regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM docs),
counts AS MATERIALIZED (
  SELECT d.doc_id, d.source, CAST(len(d.w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(d.text, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(d.text) - length(regexp_replace(d.text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(l.l) - len(list_distinct(l.l)) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n, 0) AS BIGINT) AS n_repeat_words
  FROM words d JOIN lines l USING (r) LEFT JOIN covered c USING (r)),
judged AS MATERIALIZED (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts),
hosts AS (SELECT source, count(*) AS n, count(*) FILTER (base_failed) AS f FROM judged WHERE source IS NOT NULL GROUP BY source),
fitted AS (SELECT sum(f) / sum(n) AS m, var_samp(f / n) AS v, avg(1.0 / n) AS c FROM hosts),
prior AS (SELECT m, CASE WHEN v - m * (1 - m) * c > 0
  THEN greatest(least(m * (1 - m) / (v - m * (1 - m) * c) - 1, 1000.0), 2.0) ELSE 1000.0 END AS k FROM fitted),
verdicts AS (SELECT source, (f + m * k) / (n + k) <= 0.5 AS ok FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND coalesce(ok, true) AS kept FROM judged LEFT JOIN verdicts USING (source)
"""


@query("op10_host_rules", _QUALITY_SQL)
def op10_host_rules(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return host_rules.judge(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                                         "n_repeat_words", "base_failed", "kept")


URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
             ("net", "/es/", "block"), ("net", "/fr/", "block")]

_URL_SQL = """
WITH rules(h, p, v) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
  ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
urls AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN instr(url, '://') > 0
  THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT r, page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM urls),
fits AS (SELECT r, h || p AS rule, v, row_number() OVER (PARTITION BY r ORDER BY length(h || p) DESC, length(h) DESC) AS k
  FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p))
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict FROM parts LEFT JOIN (FROM fits WHERE k = 1) USING (r)
"""


@query("op8_url_filters", _URL_SQL)
def op8_url_filters(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op5_line_dedup")
def op5_line_dedup(spark, sf_dir):
    return line_dedup.line_components(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query("op4_decontaminate")
def op4_decontaminate(spark, sf_dir):
    items = decontaminate.with_answers(table(spark, sf_dir, "benchmark"))
    return decontaminate.find(table(spark, sf_dir, "documents"), items)


def held_out(doc_id: str = "doc_id"):
    """Rows that no classifier learns from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def toxicity_model(docs: DataFrame, labels: DataFrame) -> toxicity.Model:
    return toxicity.fit(docs, labels.where(~held_out()))


@query("op1_toxicity")
def op1_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query("op2_language_id")
def op2_language_id(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.fit(docs.where(~held_out()))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query("op7_html_text")
def op7_html_text(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


_CONTROL = r"[<\[]\\*(?:\|[A-Za-z0-9_]+\|>|/?(?:s|SYS|unk|pad)>|/?INST\])"

_CHAT_SQL = rf"""
WITH every AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL
  SELECT -1, t, r, '</s>[INST] ok [/INST]' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM every),
kept AS (SELECT *, replace(replace(role, '\', '\\'), chr(10), '\n') AS line,
  length(text) + len(regexp_extract_all(text, '{_CONTROL}')) AS n FROM turns)
SELECT CAST(conv_id AS BIGINT) AS conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, sha256(text))) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, sha256(text)) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>') + length(line) + 1 + n + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM kept GROUP BY conv_id
"""


@query("op11_chat_format", _CHAT_SQL)
def op11_chat_format(spark, sf_dir):
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame([(-1, 0, "user", text), (-1, 1, "assistant", text)], rows.schema)
    return chat_format.digests(chat_format.format(rows.unionByName(more), chat_format.text_part("text")))


LEAF = ["doc_id", "source", "lang", "n_chars", "text"]

#: unsigned crc32 of a text column of ASCII characters, bit by bit
_CRC = """xor(list_reduce(list_transform(range(1, length({0}) + 1), lambda i : CAST(ascii(substr({0}, i, 1)) AS BIGINT)),
  lambda c, b : list_reduce(range(8), lambda x, k : CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)),
  4294967295), 4294967295)"""


def _leaf_sql(text: str) -> str:
    parts = [text if c == "text" else f"CAST({c} AS VARCHAR)" for c in LEAF]
    return "sha256(" + " || ".join(f"coalesce(strlen({p}) || ':' || {p}, '-')" for p in parts) + ")"


_MERKLE_SQL = f"""
WITH RECURSIVE leaves AS MATERIALIZED (
  SELECT doc_id, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS t, {_leaf_sql("text")} AS d,
    {_leaf_sql("CASE WHEN " + _CRC.format("CAST(doc_id AS VARCHAR)") + " % 2 = 0 THEN replace(text, chr(10), '') ELSE text END")} AS now
  FROM documents),
placed AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY t ORDER BY doc_id NULLS FIRST, d) - 1 AS i,
  count(*) OVER (PARTITION BY t) AS n FROM leaves),
low AS (SELECT 0 AS level, t, i, n, d FROM placed UNION ALL
  SELECT level + 1, t, i // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY i)) FROM low WHERE n > 1 GROUP BY level, t, i // 3, n),
subroots AS MATERIALIZED (SELECT t, d FROM low WHERE n = 1),
high AS (SELECT 0 AS level, t AS i, (SELECT count(*) FROM subroots) AS n, d FROM subroots UNION ALL
  SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY i)) FROM high WHERE n > 1 GROUP BY level, i // 3, n),
nodes AS (SELECT level, t, i, n, d FROM low WHERE n > 1 UNION ALL SELECT 1000 + level, -1, i, n, d FROM high WHERE n > 1),
beside AS MATERIALIZED (SELECT level, t, i,
  coalesce(string_agg(d, '') OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS before,
  coalesce(string_agg(d, '') OVER (f ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS after
  FROM nodes WINDOW f AS (PARTITION BY level, t, i // 3 ORDER BY i)),
paths AS (SELECT p.t, p.i, list(before || '|' || after ORDER BY level) AS path FROM placed p JOIN beside b
  ON CASE WHEN level < 1000 THEN b.t = p.t AND b.i = p.i // CAST(pow(3, level) AS BIGINT)
    ELSE b.i = p.t // CAST(pow(3, level - 1000) AS BIGINT) END GROUP BY p.t, p.i),
folded AS (SELECT p.doc_id, p.d AS leaf, s.d AS subroot, (SELECT d FROM high WHERE n = 1) AS root,
  sha256(replace(array_to_string(coalesce(path, []), ''), '|', '')) AS proof_sha256,
  list_reduce(coalesce(path, []), lambda x, s : sha256(split_part(s, '|', 1) || x || split_part(s, '|', 2)), now) AS folded_root
  FROM placed p JOIN subroots s USING (t) LEFT JOIN paths USING (t, i))
SELECT *, folded_root = root AS verified FROM folded
"""


@query("op12_merkle_manifest", _MERKLE_SQL)
def op12_merkle_manifest(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    changed = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    now = merkle.leaf([changed if c == "text" else F.col(c) for c in LEAF])
    lower, upper = merkle.manifest(docs, "source", "doc_id", LEAF, {"doc_id": F.col("doc_id"), "now": now})
    found = merkle.proofs(lower, upper).withColumn("folded_root", merkle.folded(F.col("now"), F.col("path")))
    return found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root",
                        merkle.proof_digest(F.col("path")).alias("proof_sha256"), "folded_root",
                        (F.col("folded_root") == F.col("root")).alias("verified"))


def planted_run(doc_id, words):
    """Words that repeat a stretch of themselves to the end, for one document in ten; else as they are."""
    h, n = F.crc32(doc_id.cast("string")), F.size(words)
    g = F.floor(h / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    again = F.flatten(F.array_repeat(F.slice(words, a + 1, p), F.ceil((n - a) / p).cast("int")))
    return F.when((h % 10 == 0) & (n > 0), F.concat(F.slice(words, F.lit(1), a), F.slice(again, F.lit(1), n - a))).otherwise(words)


@query("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string"))
    docs = docs.withColumn("words", F.when(h % 10 == 0, F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")))
    docs = docs.select("doc_id", F.coalesce(F.array_join(planted_run(F.col("doc_id"), F.col("words")), " "), "text").alias("text"))
    rows = periodic_runs.find(docs, "text").withColumn("longest", F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))))
    line = F.transform("runs", lambda r: F.concat(r["start"], F.lit(","), r["length"], F.lit(","), r["period"], F.lit("\n")))
    long = F.col("longest")
    return rows.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-long["start"]).alias("start"), long["length"].alias("length"),
        (-long["period"]).alias("period"), F.floor(1000 * long["length"] / -long["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
