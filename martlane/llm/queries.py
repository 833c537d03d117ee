"""Registered queries ``opN_<name>`` and, where SQL can express them, their DuckDB text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from martlane.llm.common import table


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License labels of every document: counts and places of the base phrases, all labels, a score."""
    from martlane.llm.license_scan import scan
    return scan(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__n_base").alias("n_base"),
        F.col("__first_word").alias("first_word"), F.col("__last_word").alias("last_word"),
        F.array_join("__base_labels", ",").alias("base_labels"), F.array_join("__labels", ",").alias("labels"),
        F.col("__score").alias("score"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, group size and kept row of every document, by its text with white space made one space."""
    from martlane.llm.exact_dedup import exact_duplicates
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    from martlane.llm.simhash_dedup import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"))


def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each benchmark item that a document holds."""
    from martlane.llm.decontaminate import find_leaks
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_leaks(docs, table(spark, sf_dir, "benchmark")).select(
        "doc_id", F.explode("__leaks").alias("x")).select("doc_id", "x.item_id", "x.start", "x.edits")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language, score and rejection of every document, learned from those that are not held out."""
    from martlane.llm.language_id import predict_languages, train
    docs = table(spark, sf_dir, "documents")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    return predict_languages(docs.select("doc_id", "text"), train(docs)).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col("__lang").alias("lang_pred"), F.col("__score").alias("score"),
        F.col("__rejected").alias("rejected"))


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from martlane.llm.html_extract import extract, train
    pages = table(spark, sf_dir, "pages")
    return extract(pages, train(pages))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document before and after, and the hash of what stays."""
    from martlane.llm.line_dedup import drop_repeated_lines
    return drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"),
        F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and hash of every document's ids, and the hash of their decoded text."""
    from martlane.llm.bpe import encode_documents
    return encode_documents(table(spark, sf_dir, "documents"), vocabulary_path(), keep_ids=False).drop("ids")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical message, order and tool-call problems of every turn."""
    from martlane.llm.chat_format import format_chats
    return format_chats(table(spark, sf_dir, "conversations")).withColumn("problems", F.array_join("problems", "; "))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity and its probabilities of every document."""
    from martlane.llm.toxicity import predict, train
    docs = table(spark, sf_dir, "documents")
    return predict(docs, train(docs, table(spark, sf_dir, "labels")))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged conversations repaired; one row for each conversation of the table."""
    from martlane.llm.conversation_repair import damage, repair
    conversations = table(spark, sf_dir, "conversations")
    found = repair(damage(conversations)).drop("repaired")
    ids = conversations.select(F.col("conv_id").alias("original")).distinct()
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return ids.join(found, ids["original"].eqNullSafe(found["conv_id"]), "left").select(
        F.col("original").alias("conv_id"), *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 16 whitened components of every whole vector."""
    from martlane.llm.whitening import whiten
    return whiten(table(spark, sf_dir, "embeddings"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents and where they lie in the sequences."""
    from martlane.llm.packing import pack
    packed = pack(table(spark, sf_dir, "documents"), vocabulary_path(), vocabulary_path("byte_bpe_50k.tiktoken"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_license_scan": op1_license_scan,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_benchmark_decontamination": op4_benchmark_decontamination,
    "op5_language_id": op5_language_id,
    "op6_html_extraction": op6_html_extraction,
    "op7_line_dedup": op7_line_dedup,
    "op8_bpe": op8_bpe,
    "op9_chat_format": op9_chat_format,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_packing": op13_packing,
}

#: An edit before a suffix, whose cost is its first twelve signs and whose audit is the rest: so
#: the least text is the cheapest, and of equally cheap ones the ASCII-least.
_EDIT = "lpad(CAST(CAST(left({v}, 12) AS BIGINT) + {cost} AS VARCHAR), 12, '0') || '{letter}' || substr({v}, 13)"
_NEVER = "'9'"


def _edits(state: int) -> str:
    to = 3 if state == 2 else 2
    more = "CASE WHEN fault = 3 THEN 3 ELSE 0 END"
    kept = {0: ("letter = 'u'", 2), 1: ("letter = 'u'", 2), 2: ("letter = 'a'", 3), 3: ("letter = 'u'", 2)}[state]
    ways = [_EDIT.format(v=f"v{state}", cost=4, letter="D"),
            f"CASE WHEN fault IN (1, 2) THEN {_NEVER} ELSE " + _EDIT.format(v=f"v{to}", cost=f"3 + {more}", letter="R") + " END",
            f"CASE WHEN fault NOT IN (1, 2) AND {kept[0]} THEN " + _EDIT.format(v=f"v{kept[1]}", cost=more, letter="K") + f" ELSE {_NEVER} END"]
    if state == 0:
        ways.append("CASE WHEN fault NOT IN (1, 2) AND letter = 's' THEN " + _EDIT.format(v="v1", cost=more, letter="K") + f" ELSE {_NEVER} END")
    return f"least({', '.join(ways)}) AS g{state}"


SQL: dict[str, str] = {
    "op11_conversation_repair": f"""
        WITH RECURSIVE
        named AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
            coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations),
        -- crc32 bit by bit: a byte, then eight shifts
        drawn AS (SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(name, ''),
                lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
            lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, CAST(3988292384 AS BIGINT)) ELSE c >> 1 END),
            CAST(4294967295 AS BIGINT)) % 20 AS k FROM named),
        damaged AS (SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
            CASE k WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
            unnest(CASE WHEN k = 3 THEN [0, 1] ELSE [0] END) AS copy FROM drawn WHERE k <> 0),
        placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role,
            sha256(CAST(length(role) AS VARCHAR) || ':' || role || text), copy) AS i FROM damaged),
        judged AS (SELECT *, left(role, 1) AS letter, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS before,
            CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 1
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 2
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 3 ELSE 0 END AS fault FROM placed),
        totals AS (SELECT conv_id, count(*) AS n,
            coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
            count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate, count(*) FILTER (fault = 3) AS truncated,
            count(*) FILTER (i > 1 AND before || letter NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
        -- the best edits of the rows from i on, from each of the states nothing, s, u, a
        best AS (
            SELECT conv_id, n + 1 AS i, '000000000000' AS v0, '000000000006II' AS v1, '000000000003I' AS v2, '000000000000' AS v3 FROM totals
            UNION ALL
            SELECT conv_id, i, least(g0, {_EDIT.format(v='w2', cost=3, letter='I')}), least(g1, {_EDIT.format(v='w2', cost=3, letter='I')}), w2, w3
            FROM (SELECT *, least(g2, {_EDIT.format(v='g3', cost=3, letter='I')}) AS w2, least(g3, {_EDIT.format(v='g2', cost=3, letter='I')}) AS w3
                FROM (SELECT best.conv_id, j.i, {', '.join(_edits(state) for state in range(4))}
                    FROM best JOIN judged j ON best.conv_id IS NOT DISTINCT FROM j.conv_id AND j.i = best.i - 1))),
        solved AS (SELECT conv_id, CAST(left(v0, 12) AS BIGINT) AS cost, substr(v0, 13) AS audit FROM best WHERE i = 1),
        letters AS (SELECT conv_id, unnest(string_split(audit, '')) AS edit, generate_subscripts(string_split(audit, ''), 1) AS p
            FROM solved WHERE audit <> ''),
        steps AS (SELECT *, count(*) FILTER (edit <> 'I') OVER w AS i, count(*) FILTER (edit <> 'D') OVER w AS e
            FROM letters WINDOW w AS (PARTITION BY conv_id ORDER BY p)),
        edited AS (SELECT s.conv_id, s.p, s.edit, s.e, j.role, j.text,
                max(CASE WHEN s.e = 1 AND s.edit = 'K' AND j.letter = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY s.conv_id) AS shift
            FROM steps s LEFT JOIN judged j ON s.edit <> 'I' AND s.conv_id IS NOT DISTINCT FROM j.conv_id AND s.i = j.i),
        lines AS (SELECT conv_id, p, CASE WHEN edit = 'K' THEN role WHEN (e - shift) % 2 = 1 THEN 'user' ELSE 'assistant' END
            || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END AS line FROM edited WHERE edit <> 'D'),
        texts AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY p) AS body FROM lines GROUP BY conv_id),
        ids AS (SELECT DISTINCT conv_id FROM conversations)
        SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
            coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost,
            coalesce(audit, '') AS audit, sha256(coalesce(body, '')) AS repaired_sha256
        FROM ids LEFT JOIN totals t ON ids.conv_id IS NOT DISTINCT FROM t.conv_id
        LEFT JOIN solved s ON ids.conv_id IS NOT DISTINCT FROM s.conv_id
        LEFT JOIN texts x ON ids.conv_id IS NOT DISTINCT FROM x.conv_id""",

    "op2_exact_dedup": """
        WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS body
                   FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, sha256(body) AS text_sha256
        FROM t WINDOW g AS (PARTITION BY body)""",
    "op7_line_dedup": """
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS body FROM documents),
        pieces AS (SELECT r, doc_id, string_split(body, chr(10)) AS lines FROM d),
        l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM pieces),
        k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''),
                                                 '[\x20\x09-\x0D]+$', ''),
                                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
        bad AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 40
                GROUP BY key HAVING count(DISTINCT r) >= 5),
        j AS (SELECT k.r, k.doc_id, k.line, k.i, bad.key IS NOT NULL AND k.doc_id <> bad.keeper AS lost
              FROM k LEFT JOIN bad ON k.key = bad.key)
        SELECT any_value(doc_id) AS doc_id, count(*) AS n_lines, count(*) FILTER (lost) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT lost), '')) AS kept_sha256
        FROM j GROUP BY r""",
}
