"""The registered queries of this subpackage, with production parameters.

Each takes (spark, sf_dir), reads its whole tables and derives the contract's columns from
what the operator returns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import formatted_digests
from .common import LOWER, UPPER, crc_mod, table
from .digest import edited_fingerprints
from .html import main_text
from .language import identify, train
from .lexical import lexical_search
from .licenses import TEMPLATES, bigrams, normalised_words, scan_licenses
from .line_dedup import drop_common_lines
from .maxent import lm_scores
from .near_dup import near_duplicates
from .packing import pack
from .tiling import overlaps
from .toxicity import score as score_toxicity
from .toxicity import train as train_toxicity
from .vector_codes import compressed


def op1_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = edited_fingerprints(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


def tokenizer_path() -> str:
    """The tokenizer file: a parameter of the operator, never copied into the repository."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=2048, end_id=1)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), min_coverage=0.5, min_tile=3)


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = crc_mod(F.col("doc_id"), 4) == 2
    model = train(docs.filter(~held_out))
    return identify(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), percent=75)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    labels = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("labelled"), "toxic")
    labelled = docs.filter(~held_out).join(labels, F.col("doc_id") == F.col("labelled")).select("doc_id", "text", "toxic")
    scored = score_toxicity(docs, train_toxicity(labelled))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_common_lines(table(spark, sf_dir, "documents").select("doc_id", "text"), min_docs=10, min_chars=1)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"), threshold=0.75)


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = lm_scores(docs, train=crc_mod(F.col("doc_id"), 7) != 2)
    return scored.select("doc_id", (~F.col("train")).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


def op11_vector_code_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = compressed(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024)
    return coded.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    added = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return formatted_digests(turns.unionByName(added))


def op13_ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


QUERIES = {
    "op3_benchmark_decontamination": op3_benchmark_decontamination,
    "op4_language_id": op4_language_id,
    "op1_document_fingerprints": op1_document_fingerprints,
    "op2_packing": op2_packing,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_toxicity": op6_toxicity,
    "op7_line_dedup": op7_line_dedup,
    "op8_license_scan": op8_license_scan,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_html_extraction": op10_html_extraction,
    "op11_vector_code_compression": op11_vector_code_compression,
    "op12_chat_formatting": op12_chat_formatting,
    "op13_ranked_lexical_search": op13_ranked_lexical_search,
}

_BLANK_SQL = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"



def _template_rows() -> str:
    words = {name: normalised_words(text) for name, text in sorted(TEMPLATES.items())}
    return ", ".join(f"('{name}', {len(w) - 1}, [{', '.join(repr(x) for x in bigrams(w))}])" for name, w in words.items())


def _codes_sql(rounds: int = 4) -> str:
    """The codes of ``embeddings``: codebooks from the 256 smallest ids, then ``rounds``."""
    near = """near{r} AS MATERIALIZED (
    SELECT vec_id, p, any_value(x) AS x, min({{'d': d, 'e': e}}) AS best FROM (
        SELECT vec_id, p, x, e, CAST(list_sum([(x[i] - c[i]) * (x[i] - c[i]) for i in range(1, len(x) + 1)]) AS BIGINT) AS d
        FROM parts JOIN book{r} USING (p)
    ) GROUP BY vec_id, p
)"""
    book = """sums{r} AS MATERIALIZED (
    SELECT p, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
        SELECT p, best.e AS e, i, sum(x[i]) AS s, count(*) AS n FROM near{q}, sizes, range(1, size + 1) AS g(i) GROUP BY p, best.e, i
    ) GROUP BY p, e
), book{r} AS MATERIALIZED (
    SELECT book{q}.p, book{q}.e, coalesce(sums{r}.c, book{q}.c) AS c FROM book{q} LEFT JOIN sums{r} USING (p, e)
)"""
    steps = [near.format(r=0)]
    for r in range(1, rounds + 1):
        steps += [book.format(r=r, q=r - 1), near.format(r=r)]
    return f"""
WITH kept AS MATERIALIZED (
    SELECT vec_id, label, [CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT) for x in embedding] AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
), sizes AS MATERIALIZED (
    SELECT max(len(v)) // 4 AS size FROM kept
), parts AS MATERIALIZED (
    SELECT vec_id, p, v[p * size + 1 : (p + 1) * size] AS x FROM kept, sizes, range(4) AS t(p)
), firsts AS MATERIALIZED (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 256
), book0 AS MATERIALIZED (
    SELECT p, e, x AS c FROM parts JOIN firsts USING (vec_id)
), {", ".join(steps)}, coded AS MATERIALIZED (
    SELECT vec_id, string_agg(lower(printf('%02x', best.e)), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM near{rounds} GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""


ORACLE_SQL = {
    "op12_chat_formatting": r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), escaped AS (
    SELECT *, regexp_replace(regexp_replace(role, '(\\*)(### |</turn>|: )', '\1\1\\\2', 'g'), '(\\*)$', '\1\1') AS r,
           regexp_replace(regexp_replace(text, '(\\*)(### |</turn>)', '\1\1\\\2', 'g'), '(\\*)$', '\1\1') AS t
    FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, md5(text))) AS turns_sha256,
       CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, md5(text)) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('### ' || r || ': ' || t || '</turn>' || chr(10))) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id""",
    "op11_vector_code_compression": _codes_sql(),
    "op13_ranked_lexical_search": f"""
WITH tokens AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term FROM documents
), sizes AS (
    SELECT doc_id, count(*) AS n FROM tokens GROUP BY doc_id
), corpus AS (
    SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM sizes
), asked AS (
    SELECT item_id, term, count(*) AS repeats FROM (
        SELECT item_id, unnest(regexp_extract_all(translate(text, '{UPPER}', '{LOWER}'), '[0-9a-z\\x{{80}}-\\x{{10FFFF}}]+')) AS term FROM benchmark
    ) GROUP BY item_id, term
), counted AS (
    SELECT doc_id, term, count(*) AS tf FROM tokens WHERE term IN (SELECT term FROM asked) GROUP BY doc_id, term
), weights AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w
    FROM (SELECT term, count(*) AS df FROM counted GROUP BY term), corpus
), factors AS (
    SELECT doc_id, 100 - 75 + (75 * n * n_docs) // n_terms AS m FROM sizes, corpus
), scored AS (
    SELECT item_id, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM asked JOIN counted USING (term) JOIN weights USING (term) JOIN factors USING (doc_id) GROUP BY item_id, doc_id
), ranked AS (
    SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM scored WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10""",
    "op8_license_scan": f"""
WITH templates(license, span, found) AS (VALUES {_template_rows()}), worded AS (
    SELECT row_number() OVER () AS r, doc_id, [x FOR x IN string_split(regexp_replace(lower(text), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g'), ' ') IF x <> ''] AS w FROM documents
), paired AS (
    SELECT r, doc_id, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] AS pairs FROM worded
), placed AS (
    SELECT r, unnest(pairs) AS pair, unnest(range(len(pairs))) AS start FROM paired
), hits AS (
    SELECT r, license, start FROM placed JOIN (SELECT license, unnest(found) AS pair FROM templates) USING (pair)
), windows AS (
    SELECT r, doc_id, license, start, found, pairs[start + 1 : start + span] AS own FROM hits JOIN templates USING (license) JOIN paired USING (r)
), scored AS (
    SELECT r, doc_id, license, start, len(own) + 1 AS n_words, 2.0::DOUBLE * len(list_intersect(own, found)) / (len(list_distinct(own)) + len(found)) AS dice FROM windows
)
SELECT doc_id, license, CAST(start AS INT) AS start, CAST(n_words AS INT) AS n_words, dice FROM scored WHERE dice >= 0.75
QUALIFY row_number() OVER (PARTITION BY r, license ORDER BY dice DESC, start) = 1""",
    "op7_line_dedup": f"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents
), lines AS (
    SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM split
), keyed AS (
    SELECT *, translate(trim(line, {_BLANK_SQL}), '{UPPER}', '{LOWER}') AS key FROM lines
), common AS (
    SELECT key AS common_key FROM keyed WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT doc_id, count(*) AS n_lines, count(common_key) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE common_key IS NULL), '')) AS kept_sha256
FROM keyed LEFT JOIN common ON key = common_key
GROUP BY doc_id""",
}
