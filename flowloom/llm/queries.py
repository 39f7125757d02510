"""The registered queries of these operators and, where SQL can express one, its twin."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import pii, quality
from .chat import expand, read_back
from .decontaminate import scan
from .extract import extract_text
from .langid import held_out, identify, learn
from .lexical import build_index, search
from .merkle import lower_ascii, manifest, verify
from .mixing import mix
from .neardup import near_duplicates
from .secrets import digest, scan_secrets
from .tokenfiles import token_digest
from .topk import top_k

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query(
    "op1_maxscore_topk",
    """
    WITH v AS (
        SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS c FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    ), s AS (
        SELECT q.vec_id AS query_id, e.vec_id, CAST(list_inner_product(q.c, e.c) AS BIGINT) AS score
        FROM v q JOIN v e ON q.vec_id <> e.vec_id WHERE q.vec_id % 100 = 0
    ), r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
)
def op1(spark: SparkSession, sf: str) -> DataFrame:
    return top_k(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0, k=10, scale=1024.0)


WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""


@query(
    "op10_suffix_automaton_decontamination",
    f"""
    WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
    b AS (SELECT * FROM (SELECT item_id, {WORDS} AS w FROM benchmark) WHERE len(w) > 0),
    win AS (SELECT item_id, least(10, len(w)) AS n, list_slice(w, i, i + least(10, len(w)) - 1) AS g FROM (SELECT *, unnest(generate_series(1, len(w) - least(10, len(w)) + 1)) AS i FROM b)),
    dw AS (SELECT doc_id, i, n, list_slice(w, i, i + n - 1) AS g FROM (SELECT d.*, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT n FROM win))),
    hit AS (SELECT DISTINCT doc_id, i, n, item_id FROM dw JOIN win USING (n, g)),
    words AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + n - 1)) AS p FROM hit) GROUP BY doc_id),
    items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS s FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM hit) GROUP BY doc_id)
    SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
           sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
)
def op10(spark: SparkSession, sf: str) -> DataFrame:
    found = scan(table(spark, sf, "documents").select("doc_id", "text"), table(spark, sf, "benchmark"), window=10)
    names = F.transform("items", lambda i: i.cast("string"))
    return found.select(
        "doc.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join(names, ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated")
    )


@query(
    "op2_bottom_k_near_duplicates",
    r"""
    WITH RECURSIVE d AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
    ), s AS (
        SELECT DISTINCT doc_id, list_slice(w, i, i + least(4, len(w)) - 1) AS g
        FROM (SELECT *, unnest(generate_series(1, len(w) - least(4, len(w)) + 1)) AS i FROM d WHERE len(w) > 0)
    ), size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    common AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
    link AS (SELECT a, b FROM common JOIN size p ON a = p.doc_id JOIN size q ON b = q.doc_id WHERE 100 * c >= 80 * (p.n + q.n - c)),
    reach AS (SELECT doc_id, doc_id AS other FROM d UNION SELECT r.doc_id, b FROM reach r JOIN link ON r.other = a),
    root AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM root LEFT JOIN size USING (doc_id)
    """,
)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    return near_duplicates(table(spark, sf, "documents"), width=4, percent=80)


@query("op3_token_id_files")
def op3(spark: SparkSession, sf: str) -> DataFrame:
    # white space is dropped and separates words in this vocabulary's pre-tokenizer; its ids fit two bytes
    return token_digest(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"), end=2, vocabulary=49_408, splits=True)


@query(
    "op8_weighted_mix",
    r"""
    WITH d AS (
        SELECT doc_id, source, md5(coalesce(text, '')) AS tie, length(coalesce(text, '')) AS chars,
               CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents
    ), k AS (
        SELECT doc_id, source, tie, size,
               -ln((CAST(('0x' || substr(md5(concat_ws('|', 'mix', coalesce(CAST(doc_id AS VARCHAR), ''), tie)), 1, 12)) AS BIGINT) + 0.5) / 281474976710656.0::DOUBLE)
               / ((CASE WHEN size < 50 THEN 0.5 ELSE 1.0 END::DOUBLE) * (CASE WHEN chars < 4 * size OR chars > 9 * size THEN 0.5 ELSE 1.0 END::DOUBLE)) AS key FROM d
    ), s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS r FROM k GROUP BY source),
    w AS (SELECT source, source_size, [5.0, 2.0, 1.0][1 + r % 3]::DOUBLE AS w, (2 * source_size)::DOUBLE AS cap FROM s),
    l AS (
        SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
        FROM w WINDOW b AS (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
    ), t AS (
        SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, cap / w) FROM l WHERE level * w <= cap) * w, cap)) AS target FROM l
    ), e AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS epochs FROM t),
    c AS (SELECT k.*, source_size, target, epochs, sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id, tie ROWS UNBOUNDED PRECEDING) AS upto FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
    SELECT doc_id, size, source_size, target,
           CAST(size * (epochs + CASE WHEN upto - size / 2.0 <= target - epochs * source_size THEN 1 ELSE 0 END) AS BIGINT) AS taken FROM c
    """,
)
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return mix(table(spark, sf, "documents"))


ESCAPED = r"""replace(replace(replace(replace(replace({0}, '\', '\\'), '<s>', '<\s>'), '</s>', '<\/s>'), '[INST]', '[\INST]'), '[/INST]', '[\/INST]')"""
ODD_TURN = "</s>[INST] ok [/INST]"


@query(
    "op6_prefix_target_chat",
    f"""
    WITH t AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL VALUES (-1, 0, 'user', '{ODD_TURN}'), (-1, 1, 'assistant', '{ODD_TURN}')
    ), p AS (
        SELECT *, sum(20 + length({ESCAPED.format('role')}) + length({ESCAPED.format('text')})) OVER w AS upto, row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS is_last
        FROM t WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING)
    )
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(upto) FILTER (role = 'assistant' OR is_last) AS BIGINT) AS formatted_chars
    FROM p GROUP BY conv_id
    """,
)
def op6(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    odd = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ODD_TURN).alias("text"))
    return read_back(expand(rows.unionByName(odd)))


@query("op5_owned_secrets")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return digest(scan_secrets(table(spark, sf, "documents")))


@query("op9_language_mixture")
def op9(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    out = held_out(F.col("doc_id"), 5, 0)
    model = learn(docs.where(~out))
    return identify(docs, model).select("doc_id", out.alias("held_out"), "lang_pred", "score", "languages", "shares")


@query("op7_naive_bayes_svm_quality")
def op7(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("doc_id", "text")
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    out = held_out(F.col("doc_id"), 3, 1)
    model = quality.learn(quality.labelled_texts(docs.where(~out), labels.where(~out)))
    scored = quality.score_quality(docs, model)
    return scored.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


TERMS = r"""regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""


@query(
    "op11_hybrid_lexical_search",
    f"""
    WITH d AS (SELECT row_number() OVER () AS k, doc_id, {TERMS} AS t FROM documents WHERE text IS NOT NULL),
    full_docs AS (SELECT *, len(t) AS n FROM d WHERE len(t) > 0),
    total AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_tokens FROM full_docs),
    posted AS (SELECT k, doc_id, n, term, count(*) AS tf FROM (SELECT k, doc_id, n, unnest(t) AS term FROM full_docs) GROUP BY ALL),
    asked AS (SELECT DISTINCT item_id, unnest({TERMS}) AS term FROM benchmark),
    weighed AS (
        SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
        FROM posted, total WHERE term IN (SELECT term FROM asked) GROUP BY term
    ), scored AS (
        SELECT item_id, k, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_tokens)))) AS BIGINT) AS score
        FROM asked JOIN weighed USING (term) JOIN posted USING (term), total GROUP BY item_id, k, doc_id
    )
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS FIRST) AS INTEGER) AS rank, doc_id, score
    FROM scored WHERE score > 0 QUALIFY rank <= 10
    """,
)
def op11(spark: SparkSession, sf: str) -> DataFrame:
    return search(build_index(table(spark, sf, "documents")), table(spark, sf, "benchmark"), k=10)


CRC32 = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [ascii(c), -1, -1, -1, -1, -1, -1, -1, -1]))),
               lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END), 4294967295)"""


def leaf_sql(text: str) -> str:
    fields = ["doc_id", "source", "lang", "n_chars", text]
    return "sha256(" + " || ".join(f"coalesce(CAST(strlen(CAST({f} AS VARCHAR)) AS VARCHAR) || ':' || CAST({f} AS VARCHAR), '-')" for f in fields) + ")"


@query(
    "op12_merkle_manifest",
    f"""
    WITH RECURSIVE f AS (
        SELECT doc_id, source, {leaf_sql("text")} AS leaf,
               CASE WHEN {CRC32} % 5 = 0 THEN {leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS claimed FROM documents
    ), l AS (
        SELECT *, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS s, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p, count(*) OVER (PARTITION BY source) AS n FROM f
    ), node AS (
        SELECT s, 0 AS lvl, p, leaf AS d, n FROM l
        UNION ALL
        SELECT s, lvl + 1, p // 16, sha256(string_agg(d, '' ORDER BY p)), (any_value(n) + 15) // 16 FROM node WHERE n > 1 GROUP BY s, lvl, p // 16
    ), sub AS (SELECT s, d, lvl FROM node WHERE n = 1), top AS (
        SELECT 0 AS lvl, s AS p, d, count(*) OVER () AS n FROM sub
        UNION ALL
        SELECT lvl + 1, p // 16, sha256(string_agg(d, '' ORDER BY p)), (any_value(n) + 15) // 16 FROM top WHERE n > 1 GROUP BY lvl, p // 16
    ), run AS (
        SELECT s, lvl, p // 16 AS r, list(d ORDER BY p) AS ds FROM node WHERE n > 1 GROUP BY ALL
        UNION ALL SELECT sub.s, sub.lvl + t.lvl, NULL, t.ds FROM sub, (SELECT lvl, p // 16 AS r, list(d ORDER BY p) AS ds FROM top WHERE n > 1 GROUP BY ALL) t WHERE t.r = (sub.s // CAST(16 ** (t.lvl + 1) AS BIGINT))
    ), walk AS (
        SELECT row_number() OVER () AS k, doc_id, leaf, l.s, p, 0 AS lvl, sub.lvl AS h, sub.d AS subroot, coalesce(claimed, leaf) AS cur, '' AS proof FROM l JOIN sub USING (s)
        UNION ALL
        SELECT k, doc_id, leaf, w.s, p, w.lvl + 1, h, subroot, sha256(list_aggregate(list_transform(ds, lambda x, i: CASE WHEN i = o + 1 THEN cur ELSE x END), 'string_agg', '')),
               proof || coalesce(list_aggregate(list_filter(ds, lambda x, i: i <> o + 1), 'string_agg', ''), '')
        FROM (SELECT *, (CASE WHEN lvl < h THEN p // CAST(16 ** lvl AS BIGINT) ELSE s // CAST(16 ** (lvl - h) AS BIGINT) END) % 16 AS o FROM walk) w
        JOIN run ON run.s = w.s AND run.lvl = w.lvl AND (run.r IS NULL OR run.r = w.p // CAST(16 ** (w.lvl + 1) AS BIGINT))
    ), root AS (SELECT d AS root FROM top WHERE n = 1)
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, cur AS folded_root, cur = root AS verified
    FROM (SELECT * FROM walk QUALIFY row_number() OVER (PARTITION BY k ORDER BY lvl DESC) = 1), root
    """,
)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    made = manifest(table(spark, sf, "documents"), ("doc_id", "source", "lang", "n_chars", "text"), "source", "doc_id", {"text": lower_ascii(F.col("text"))}, tampered)
    return verify(made).select(
        F.col("id").alias("doc_id"), *(F.lower(F.hex(c)).alias(c) for c in ("leaf", "subroot", "root")), F.lower(F.hex("proof")).alias("proof_sha256"), F.lower(F.hex("folded")).alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified")
    )


EMAIL_SQL = "[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+"
IP_SQL, CARD_SQL, PHONE_SQL = "[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+", r"[0-9](?:[\x20-]?[0-9])+", r"[+][0-9][\x20().0-9-]+[0-9]"
TERM_SQL = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]{3,}"
TOKEN_SQL = rf"{PHONE_SQL}|{IP_SQL}|[0-9](?:[\x20-]?[0-9]){{12,}}|{TERM_SQL}"
LOW_SQL = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
DIGITS_SQL = "regexp_replace({0}, '[^0-9]', '', 'g')"
IS_TERM_SQL = f"(regexp_full_match({{0}}, '{TERM_SQL.replace('{', '{{').replace('}', '}}')}') AND NOT regexp_full_match({{0}}, '[0-9]{{{{13,}}}}'))"
IP_VALID_SQL = "len(list_filter(string_split({0}, '.'), lambda p: length(ltrim(p, '0')) > 3 OR coalesce(TRY_CAST(right('000' || p, 3) AS INTEGER), 999) > 255)) = 0"
LUHN_SQL = "list_sum(list_transform(generate_series(1, length({0})), lambda j: CASE WHEN j % 2 = 0 THEN (2 * CAST({0}[-j] AS INTEGER)) // 10 + (2 * CAST({0}[-j] AS INTEGER)) % 10 ELSE CAST({0}[-j] AS INTEGER) END)) % 10 = 0"
CARD_VALID_SQL = f"(length({DIGITS_SQL}) BETWEEN 13 AND 19 AND {LUHN_SQL.replace('{0}', DIGITS_SQL)})"
PHONE_VALID_SQL = f"(length({DIGITS_SQL}) BETWEEN 9 AND 15)"


@query(
    "op13_information_theoretic_pii",
    f"""
    WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
    cut AS (SELECT rid, string_split_regex(text, '{EMAIL_SQL}') AS g, regexp_extract_all(text, '{EMAIL_SQL}') AS m FROM d),
    tok AS (SELECT rid, flatten(list_transform(generate_series(1, len(g)), lambda i: list_concat(regexp_extract_all(g[i], '{TOKEN_SQL}'), m[i:i]))) AS t FROM cut),
    near AS (
        SELECT rid, t[i] AS x, list_transform(list_filter(t[greatest(i - 8, 1):i + 8], lambda y: {IS_TERM_SQL.format("y")}), lambda y: {LOW_SQL.format("y")}) AS terms
        FROM (SELECT *, unnest(generate_series(1, len(t))) AS i FROM tok) WHERE NOT {IS_TERM_SQL.format("t[i]")}
    ), found AS (
        SELECT rid, CASE WHEN x LIKE '%@%' THEN 'email:' || {LOW_SQL.format("x")} WHEN x LIKE '+%' THEN CASE WHEN {PHONE_VALID_SQL.format("x")} THEN 'phone:' || {DIGITS_SQL.format("x")} END
               WHEN x LIKE '%.%' THEN CASE WHEN {IP_VALID_SQL.format("x")} THEN 'ip:' || x END WHEN {CARD_VALID_SQL.format("x")} THEN 'card:' || {DIGITS_SQL.format("x")} END AS entity,
               md5(array_to_string(terms, ' ')) AS context, list_distinct(terms) AS terms FROM near
    ), both_in AS (
        SELECT entity, term, rid, min(context) AS context FROM (SELECT rid, entity, context, unnest(terms) AS term FROM found WHERE entity IS NOT NULL) GROUP BY ALL
    ), pair AS (SELECT entity, term, count(*) AS together FROM both_in GROUP BY ALL HAVING count(DISTINCT context) >= 3),
    held AS (SELECT DISTINCT rid, {LOW_SQL.format("y")} AS term FROM (SELECT rid, unnest(t) AS y FROM tok) WHERE {IS_TERM_SQL.format("y")} AND term IN (SELECT term FROM pair)),
    of_entity AS (SELECT entity, count(DISTINCT rid) AS ne FROM found WHERE entity IS NOT NULL GROUP BY entity), of_term AS (SELECT term, count(*) AS nt FROM held GROUP BY term),
    told AS (
        SELECT term FROM pair JOIN of_entity USING (entity) JOIN of_term USING (term), (SELECT CAST(count(*) AS DOUBLE) AS n FROM d)
        WHERE ne < n GROUP BY term HAVING max(ln(together * n / (CAST(ne AS DOUBLE) * nt)) / ln(n / ne)) >= 0.9
    ), way AS (SELECT * FROM (VALUES (0, 'email', '{EMAIL_SQL}'), (1, 'ip', '{IP_SQL}'), (2, 'card', '{CARD_SQL}'), (3, 'phone', '{PHONE_SQL}')) w(o, kind, p)),
    matched AS (
        SELECT rid, o, kind, 0 AS base_at, regexp_extract_all(text, p) AS m, string_split_regex(text, p) AS g FROM d, way
        UNION ALL
        SELECT rid, 4, 'term', coalesce(list_sum(list_transform(list_concat(g[1:i - 1], m[1:i - 1]), lambda y: length(y))), 0), regexp_extract_all(g[i], '{TOKEN_SQL}'), string_split_regex(g[i], '{TOKEN_SQL}')
        FROM (SELECT *, unnest(generate_series(1, len(g))) AS i FROM cut WHERE rid IN (SELECT rid FROM held JOIN told USING (term)))
    ), span AS (
        SELECT rid, o, kind, m[i] AS v, base_at + CAST(list_sum(list_transform(g[1:i], lambda y: length(y))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda y: length(y))), 0) AS BIGINT) AS s
        FROM (SELECT *, unnest(generate_series(1, len(m))) AS i FROM matched)
    ), kept AS (
        SELECT rid, o, kind, s, kind || ':' || s || ':' || (s + length(v)) AS shown FROM span
        WHERE CASE kind WHEN 'email' THEN true WHEN 'ip' THEN {IP_VALID_SQL.format("v")} WHEN 'card' THEN {CARD_VALID_SQL.format("v")} WHEN 'phone' THEN {PHONE_VALID_SQL.format("v")}
              ELSE {IS_TERM_SQL.format("v")} AND {LOW_SQL.format("v")} IN (SELECT term FROM told) END
    ), per AS (
        SELECT rid, count(*) FILTER (o = 0) AS n_email, count(*) FILTER (o = 1) AS n_ip, count(*) FILTER (o = 2) AS n_card, count(*) FILTER (o = 3) AS n_phone,
               string_agg(shown, ',' ORDER BY o, s) FILTER (o < 4) AS base, string_agg(shown, ',' ORDER BY o, s) AS spans FROM kept GROUP BY rid
    )
    SELECT doc_id, coalesce(n_email, 0) AS n_email, coalesce(n_ip, 0) AS n_ip, coalesce(n_card, 0) AS n_card, coalesce(n_phone, 0) AS n_phone, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN per USING (rid)
    """,
)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return pii.digest(pii.sanitise(table(spark, sf, "documents")))


@query("op4_recurrent_html_text")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return extract_text(table(spark, sf, "pages"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf)
