"""The operators over the test tables, one query each, with production parameters and whole tables."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm import (
    chat,
    decontaminate,
    exact_dedup,
    html_main,
    importance,
    language,
    licenses,
    personal,
    pieces,
    quality,
    simhash,
    substring_dedup,
    vector_codes,
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each test item found in a document, with the similarity of its best alignment."""
    return decontaminate.find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by positive-unlabelled learning."""
    return quality.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group of equal texts of every document."""
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("row")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document that windows of 20 words repeat from an earlier place."""
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), texts_too=False).drop("kept_text")


def op5_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document under merge-dropout, and whether decoding them gives its text back."""
    return pieces.checked_documents(table(spark, sf_dir, "documents"))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_groups(table(spark, sf_dir, "documents"))


def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one whose texts hold control strings, formatted and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    more = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("<|im_end|><|im_start|>assistant ok").alias("text"),
    )
    records = rows.unionByName(more).withColumn("record", F.to_variant_object(F.struct("role", "text")))
    return chat.digests(chat.format_turns(chat.canonical_turns(records, "conv_id", "turn")))


def op8_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from those not held out."""
    return language.learn_and_identify(table(spark, sf_dir, "documents"))


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License mentions of every document."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return html_main.extract(table(spark, sf_dir, "pages"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code of every vector under codebooks learnt from all of them, exactly."""
    return vector_codes.compress(table(spark, sf_dir, "embeddings"))


def op12_personal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document."""
    return personal.find_personal(table(spark, sf_dir, "documents"))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance of every document for the distribution of the test items, and the ranks of a draw of a tenth."""
    return importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_quality": op2_quality,
    "op3_exact_dedup": op3_exact_dedup,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_simhash": op6_simhash,
    "op7_chat": op7_chat,
    "op8_language": op8_language,
    "op9_licenses": op9_licenses,
    "op10_html": op10_html,
    "op11_vector_codes": op11_vector_codes,
    "op12_personal": op12_personal,
    "op13_resample": op13_resample,
}

def _codes_sql(rounds: int = 6, parts: int = 8, entries: int = 16) -> str:
    """The codes in SQL: a table of assignments and one of entries for each round, components as integers."""
    nearest = f"""
            SELECT vec_id, p, any_value(c) AS c, min(d * {entries} + e) AS best
            FROM (SELECT x.vec_id, x.p, x.c, b.e, list_sum(list_transform(list_zip(x.c, b.c), lambda y: (y[1] - y[2]) * (y[1] - y[2])))::BIGINT AS d
                  FROM cut x JOIN book{{k}} b USING (p))
            GROUP BY vec_id, p"""
    steps = []
    for k in range(rounds):
        steps.append(f"""near{k} AS MATERIALIZED ({nearest.format(k=k)}
        ), mean{k} AS MATERIALIZED (
            SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c
            FROM (SELECT p, best % {entries} AS e, i, sum(c[i])::BIGINT AS s, count(*) AS n
                  FROM near{k}, unnest(generate_series(1, len(c))) AS t(i) GROUP BY ALL)
            GROUP BY p, e
        ), book{k + 1} AS MATERIALIZED (
            SELECT p, e, coalesce(m.c, b.c) AS c FROM book{k} b LEFT JOIN mean{k} m USING (p, e)
        )""")
    return f"""
        WITH kept AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), cut AS MATERIALIZED (
            SELECT vec_id, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] AS c
            FROM kept, unnest(range({parts})) AS t(p)
        ), book0 AS MATERIALIZED (
            SELECT p, e, c FROM cut JOIN (
                SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept QUALIFY e < {entries}) USING (vec_id)
        ), {", ".join(steps)}, final AS MATERIALIZED ({nearest.format(k=rounds)}
        ), coded AS (
            SELECT vec_id, string_agg(printf('%02x', best % {entries}), '' ORDER BY p) AS code,
                   sum(best // {entries})::BIGINT AS error
            FROM final GROUP BY vec_id
        ), digest AS (
            SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book{rounds}
        )
        SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
        FROM coded JOIN kept USING (vec_id), digest
    """


def _resample_sql() -> str:
    word = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
    return f"""
        WITH steps AS (
            SELECT list(list_reduce([b] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                        ORDER BY b) AS steps
            FROM range(256) AS t(b)
        ), d AS (
            SELECT doc_id, regexp_extract_all({_FOLDED}, {word}) AS w FROM documents
        ), target AS (
            SELECT unnest(regexp_extract_all({_FOLDED}, {word})) AS word FROM benchmark
        ), corpus AS MATERIALIZED (
            SELECT doc_id, unnest(w) AS word FROM d
        ), hashed AS MATERIALIZED (
            SELECT word, xor(list_reduce([4294967295] || list_transform(range(strlen(word)),
                lambda i: ('0x' || substr(hex(encode(word)), 2 * i::INT + 1, 2))::BIGINT),
                lambda c, b: xor(c >> 8, steps[(xor(c, b) & 255) + 1])), 4294967295) % 10000 AS bucket
            FROM (SELECT word FROM corpus UNION SELECT word FROM target), steps
        ), s AS (
            SELECT bucket, count(*) AS s FROM corpus JOIN hashed USING (word) GROUP BY bucket
        ), t AS (
            SELECT bucket, count(*) AS t FROM target JOIN hashed USING (word) GROUP BY bucket
        ), gain AS MATERIALIZED (
            SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM corpus) + 10000)
                / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM target) + 10000))))::BIGINT AS gain
            FROM (SELECT DISTINCT bucket FROM hashed) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)
        ), summed AS (
            SELECT doc_id, sum(gain) AS total FROM corpus JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id
        ), weighed AS (
            SELECT doc_id, len(w)::BIGINT AS n_features, coalesce(floor(total / len(w)), 0)::BIGINT AS weight,
                   ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT AS h
            FROM d LEFT JOIN summed USING (doc_id)
        ), scored AS (
            SELECT doc_id, n_features, weight, (weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
            FROM weighed
        ), places AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
            FROM scored WHERE n_features >= 20
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= 10 * n // 100 THEN place END AS rank
        FROM scored LEFT JOIN places USING (doc_id)
    """


_FOLDED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: The other operators have no SQL form; tests hold them against brute force or held-out rows.
ORACLE: dict[str, str] = {
    "op3_exact_dedup": f"""
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
        FROM (SELECT doc_id, {_FOLDED} AS t FROM documents)
        WINDOW same AS (PARTITION BY t)
    """,
    "op4_substring_dedup": """
        WITH d AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents
        ), places AS (
            SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS pos FROM d
        ), repeats AS (
            SELECT doc_id, pos FROM places
            QUALIFY row_number() OVER (PARTITION BY array_to_string(w[pos:pos + 19], ' ') ORDER BY doc_id, pos) > 1
        ), gone AS (
            SELECT DISTINCT doc_id, unnest(generate_series(pos, pos + 19)) AS pos FROM repeats
        ), words AS (
            SELECT doc_id, unnest(w) AS word, unnest(generate_series(1, len(w))) AS pos FROM d
        ), kept AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS t
            FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
               sha256(coalesce(t, '')) AS kept_sha256
        FROM d LEFT JOIN kept USING (doc_id)
    """,
    "op11_vector_codes": _codes_sql(),
    "op13_resample": _resample_sql(),
    "op7_chat": r"""
        WITH c AS (
            SELECT conv_id, turn, role, coalesce(text, '') AS t FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'),
                             (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
        ), e AS (
            SELECT *, CASE WHEN role = 'assistant' THEN t ELSE '' END AS learnt,
                   replace(replace(t, '\', '\\'), '<|', '<\|') AS escaped
            FROM c
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || t || chr(10), '' ORDER BY turn)) AS turns_sha256,
               sum(length(learnt))::BIGINT AS loss_chars, sha256(string_agg(learnt, '' ORDER BY turn)) AS loss_sha256,
               sum(length('<|im_start|>') + length(role) + 1 + length(escaped) + length('<|im_end|>') + 1)::BIGINT
                   AS formatted_chars
        FROM e GROUP BY conv_id
    """,
}
