"""The operators of this package as queries on whole tables, with SQL twins where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from driftwell.llm import (
    chat,
    contamination,
    language,
    licenses,
    merkle,
    minhash,
    neighbours,
    packing,
    quality,
    recompression,
    simhash,
    suffixes,
    whitening,
)
from driftwell.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(build: Callable[[SparkSession, str], DataFrame]):
        QUERIES[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return register


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query()
def op1_quality_classifier(spark: SparkSession, directory: str) -> DataFrame:
    return quality.quality_scores(table(spark, directory, "documents"), table(spark, directory, "labels"))


@query()
def op2_simhash(spark: SparkSession, directory: str) -> DataFrame:
    found = simhash.simhash_duplicates(table(spark, directory, "documents"))
    hexadecimal = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return found.select("doc_id", hexadecimal.alias("fingerprint"), "component_id", "component_size")


@query()
def op3_license_scan(spark: SparkSession, directory: str) -> DataFrame:
    found = licenses.license_scan(table(spark, directory, "documents"))
    return found.withColumn("spans", F.array_join("spans", ","))


@query()
def op4_fingerprints(spark: SparkSession, directory: str) -> DataFrame:
    found = minhash.edited_neighbours(table(spark, directory, "documents"))
    return found.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


@query()
def op5_language_id(spark: SparkSession, directory: str) -> DataFrame:
    return language.identify_languages(table(spark, directory, "documents"))


_ADDED = (-1, ("user", "assistant"), "<|im_end|><|im_start|>assistant ok")


@query(
    r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
        UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
        UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
    ), written AS (
        SELECT *,
            length(replace(replace(text, '\', '\\'), '<|', '<\|')) AS text_chars,
            length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n')) AS role_chars,
            lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before
        FROM turns
    )
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
        CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
        CAST(sum(length('<|im_start|>') + role_chars + 1 + text_chars + length('<|im_end|>') + 1) AS BIGINT) AS formatted_chars,
        bool_and(CASE
            WHEN before IS NULL THEN role IN ('system', 'user')
            WHEN before = 'system' THEN role = 'user'
            WHEN before = 'user' THEN role = 'assistant'
            WHEN before = 'assistant' THEN role IN ('user', 'tool')
            WHEN before = 'tool' THEN role = 'assistant'
            ELSE false END) AS in_order
    FROM written GROUP BY conv_id
    """
)
def op6_chat_format(spark: SparkSession, directory: str) -> DataFrame:
    conversation, roles, text = _ADDED
    added = spark.createDataFrame(
        [(conversation, turn, role, text) for turn, role in enumerate(roles)], "conv_id long, turn long, role string, text string"
    )
    rows = table(spark, directory, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    return chat.digest_segments(chat.format_conversations(rows))


@query()
def op7_packing(spark: SparkSession, directory: str) -> DataFrame:
    pieces = packing.pack_documents(table(spark, directory, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query()
def op8_decontamination(spark: SparkSession, directory: str) -> DataFrame:
    return contamination.find_contamination(table(spark, directory, "documents"), table(spark, directory, "benchmark"))


# Windows by their start; repeated ones that touch or overlap make a run; what is kept lies between runs.
_RUNS = """
    repeated AS (
        SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM windows WHERE repeated
    ), numbered AS (
        SELECT doc_id, pos, sum(CASE WHEN before + {window} >= pos THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS run
        FROM repeated
    ), runs AS (
        SELECT doc_id, min(pos) AS first, max(pos) + {window} AS past FROM numbered GROUP BY doc_id, run
    ), gaps AS (
        SELECT doc_id, first, past, coalesce(lag(past) OVER (PARTITION BY doc_id ORDER BY first), 0) AS since FROM runs
    )"""


@query(
    f"""
    WITH texts AS (
        SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits, octet_length(encode(coalesce(text, ''))) AS n FROM documents
    ), starts AS (
        SELECT doc_id, digits, unnest(range(n - 49)) AS pos FROM texts WHERE n >= 50
    ), named AS (
        SELECT doc_id, pos, substr(digits, 2 * pos + 1, 100) AS content FROM starts
    ), firsts AS (
        SELECT content, min(doc_id) AS first_doc FROM named GROUP BY content HAVING count(*) > 1
    ), windows AS (
        SELECT n.doc_id, n.pos, n.doc_id > f.first_doc AS repeated FROM named n JOIN firsts f USING (content)
    ), {_RUNS.format(window=50)}, sums AS (
        SELECT doc_id, CAST(sum(past - first) AS BIGINT) AS n_removed, count(*) AS n_spans, max(past) AS past,
            string_agg(substr(digits, 2 * since + 1, 2 * (first - since)), '' ORDER BY first) AS kept
        FROM gaps JOIN texts USING (doc_id) GROUP BY doc_id
    )
    SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
        sha256(unhex(coalesce(kept, '') || substr(digits, 2 * coalesce(past, 0) + 1))) AS kept_sha256
    FROM texts LEFT JOIN sums USING (doc_id)
    """
)
def op9_suffix_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return suffixes.remove_repeated_bytes(table(spark, directory, "documents")).drop("kept")


@query(
    rf"""
    WITH texts AS (
        SELECT doc_id, [x FOR x IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS words FROM documents
    ), starts AS (
        SELECT doc_id, words, unnest(range(len(words) - 34)) AS pos FROM texts WHERE len(words) >= 35
    ), named AS (
        SELECT doc_id, pos, array_to_string(words[pos + 1:pos + 35], ' ') AS content FROM starts
    ), several AS (
        SELECT content FROM named GROUP BY content HAVING count(*) > 1
    ), windows AS (
        SELECT n.doc_id, n.pos, true AS repeated FROM named n SEMI JOIN several USING (content)
    ), {_RUNS.format(window=35)}, pieces AS (
        SELECT doc_id, first, past, words[since + 1:first] AS kept FROM gaps JOIN texts USING (doc_id)
    ), sums AS (
        SELECT doc_id, CAST(sum(past - first) AS BIGINT) AS n_removed, max(past) AS past, flatten(list(kept ORDER BY first)) AS kept
        FROM pieces GROUP BY doc_id
    )
    SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
        sha256(array_to_string(list_concat(coalesce(kept, []), words[coalesce(past, 0) + 1:]), ' ')) AS kept_sha256
    FROM texts LEFT JOIN sums USING (doc_id)
    """
)
def op10_substring_dedup(spark: SparkSession, directory: str) -> DataFrame:
    return recompression.remove_repeated_words(table(spark, directory, "documents")).drop("kept")


@query()
def op11_neighbours(spark: SparkSession, directory: str) -> DataFrame:
    vectors = table(spark, directory, "embeddings")
    return neighbours.nearest_neighbours(vectors, vectors.where("vec_id % 100 = 0"))


# A text field as a leaf takes it in; crc32 by its polynomial, eight steps for each byte.
_FIELD = "coalesce(octet_length(encode(CAST({0} AS VARCHAR))) || ':' || CAST({0} AS VARCHAR), '-')"
_CRC32 = """xor(4294967295, list_reduce(
    list_prepend(CAST(4294967295 AS BIGINT),
        flatten([[CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0] FOR c IN string_split(CAST(doc_id AS VARCHAR), '')])),
    lambda crc, byte: xor(xor(crc, byte) >> 1, 3988292384 * (xor(crc, byte) & 1))))"""


def _leaf_sql(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(f) for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _tree_sql(name: str, leaves: str) -> str:
    """All nodes ``g, level, idx, n, digest`` above ``leaves``."""
    return f"""{name} AS (
        SELECT g, 0 AS level, idx, n, digest FROM {leaves}
        UNION ALL
        SELECT g, level + 1, idx // 8, CAST(ceil(max(n) / 8) AS BIGINT), sha256(string_agg(digest, '' ORDER BY idx))
        FROM {name} WHERE n > 1 GROUP BY g, level, idx // 8
    )"""


@query(
    f"""
    WITH RECURSIVE described AS (
        SELECT doc_id, coalesce('=' || lang, '-') AS g, {_leaf_sql("text")} AS digest,
            CASE WHEN ({_CRC32}) % 3 = 0
                THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS altered
        FROM documents
    ), leaves AS (
        SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, digest) - 1 AS idx,
            count(*) OVER (PARTITION BY g) AS n
        FROM described
    ), {_tree_sql("nodes", "leaves")}, subroots AS (
        SELECT g, digest, 0 AS one, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1
    ), named AS (
        SELECT one AS g, idx, n, digest FROM subroots
    ), {_tree_sql("uppers", "named")}, places AS (
        SELECT l.doc_id, l.g, l.idx AS row, k.level, l.idx // CAST(power(8, k.level) AS BIGINT) AS idx, 0 AS upper
        FROM leaves l JOIN (SELECT DISTINCT g, level FROM nodes WHERE n > 1) k USING (g)
        UNION ALL
        SELECT l.doc_id, l.g, l.idx, k.level, s.idx // CAST(power(8, k.level) AS BIGINT), 1
        FROM leaves l JOIN subroots s USING (g) CROSS JOIN (SELECT DISTINCT level FROM uppers WHERE n > 1) k
    ), beside AS (
        SELECT p.g, p.row, 0 AS upper, p.level, x.idx - p.idx AS place, x.digest
        FROM places p JOIN nodes x ON p.upper = 0 AND x.g = p.g AND x.level = p.level AND x.idx // 8 = p.idx // 8 AND x.idx <> p.idx
        UNION ALL
        SELECT p.g, p.row, 1, p.level, x.idx - p.idx, x.digest
        FROM places p JOIN uppers x ON p.upper = 1 AND x.level = p.level AND x.idx // 8 = p.idx // 8 AND x.idx <> p.idx
    ), steps AS (
        SELECT p.g, p.row, row_number() OVER (PARTITION BY p.g, p.row ORDER BY p.upper, p.level) AS step,
            coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place < 0), '') AS before,
            coalesce(string_agg(b.digest, '' ORDER BY b.place) FILTER (b.place > 0), '') AS behind
        FROM places p LEFT JOIN beside b USING (g, row, upper, level) GROUP BY p.g, p.row, p.upper, p.level
    ), proofs AS (
        SELECT g, row, sha256(string_agg(before || behind, '' ORDER BY step)) AS proof FROM steps GROUP BY g, row
    ), folds AS (
        SELECT g, idx AS row, CAST(0 AS BIGINT) AS step, coalesce(altered, digest) AS folded FROM leaves
        UNION ALL
        SELECT f.g, f.row, s.step, sha256(s.before || f.folded || s.behind)
        FROM folds f JOIN steps s ON s.g = f.g AND s.row = f.row AND s.step = f.step + 1
    ), ends AS (
        SELECT g, row, max_by(folded, step) AS folded_root FROM folds GROUP BY g, row
    )
    SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, r.digest AS root,
        coalesce(p.proof, sha256('')) AS proof_sha256, e.folded_root, e.folded_root = r.digest AS verified
    FROM leaves l JOIN subroots s USING (g) JOIN ends e ON e.g = l.g AND e.row = l.idx
    LEFT JOIN proofs p ON p.g = l.g AND p.row = l.idx CROSS JOIN (SELECT digest FROM uppers WHERE n = 1) r
    """
)
def op12_merkle(spark: SparkSession, directory: str) -> DataFrame:
    return merkle.merkle_manifest(table(spark, directory, "documents")).drop("path")


@query()
def op13_whitening(spark: SparkSession, directory: str) -> DataFrame:
    return whitening.whiten_embeddings(table(spark, directory, "embeddings"))
