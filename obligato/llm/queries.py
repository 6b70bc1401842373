"""The text operators' registered queries over the given tables, and their SQL where SQL can express them."""

import uuid

from obligato.llm import (
    alignment, ann, bpe, conversation_repair, language, line_dedup, packing, quality, secrets, simhash, syncmers, token_counts, token_files)
from obligato.llm.common import shared_folder, table


def op1_bpe_roundtrip(spark, sf_dir):
    return bpe.roundtrip_digests(table(spark, sf_dir, "documents"))


def op2_multi_index_neighbours(spark, sf_dir):
    return ann.nearest(table(spark, sf_dir, "embeddings"))


def op3_secret_scan(spark, sf_dir):
    return secrets.scan(table(spark, sf_dir, "documents"))


def op4_syncmer_fingerprints(spark, sf_dir):
    return syncmers.compare_with_edits(table(spark, sf_dir, "documents"))


def op5_simhash_components(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op6_token_files(spark, sf_dir):
    folder = f"{shared_folder(spark)}/token-files-{uuid.uuid4().hex}"
    token_files.write_token_files(table(spark, sf_dir, "documents"), folder)
    return token_files.TokenFiles(spark, folder).documents()


def op7_line_dedup(spark, sf_dir):
    return line_dedup.line_digests(table(spark, sf_dir, "documents"))


def op8_language_id(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return language.identify(documents, language.learn(documents))


def op9_cutting_stock_packing(spark, sf_dir):
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op10_prefix_token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op11_tokenizer_alignment(spark, sf_dir):
    return alignment.Alignment(table(spark, sf_dir, "documents")).documents()


def op12_lightest_repair(spark, sf_dir):
    return conversation_repair.repair(conversation_repair.damage(table(spark, sf_dir, "conversations")))


def op13_nbsvm_quality(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return quality.score(documents, quality.learn(documents, table(spark, sf_dir, "labels")))


QUERIES = {f.__name__: f for f in (
    op1_bpe_roundtrip, op2_multi_index_neighbours, op3_secret_scan, op4_syncmer_fingerprints, op5_simhash_components,
    op6_token_files, op7_line_dedup, op8_language_id, op9_cutting_stock_packing, op10_prefix_token_counts,
    op11_tokenizer_alignment, op12_lightest_repair, op13_nbsvm_quality)}

_SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

ORACLES = {
    "op7_line_dedup": f"""
        WITH lines AS (
          SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS no FROM documents),
        keyed AS (
          SELECT *, translate(trim(line, {_SPACE}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
        repeated AS (
          SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
        marked AS (
          SELECT k.doc_id, k.no, k.line, r.key IS NOT NULL AND k.doc_id <> r.keeper AS lost
          FROM keyed k LEFT JOIN repeated r ON r.key = k.key)
        SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE lost) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY no) FILTER (WHERE NOT lost), '')) AS kept_sha256
        FROM marked GROUP BY doc_id""",
    # The table of edits is worked row by row: the lightest (cost, audit) of every state of the roles.
    "op12_lightest_repair": f"""
        WITH RECURSIVE keyed AS (
          SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
        kinds AS (
          SELECT *, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT))),
              lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
                lambda x, bit: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295) % 20 AS kind FROM keyed),
        damaged AS (
          SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                 CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
          FROM kinds, LATERAL (SELECT unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy)),
        placed AS (
          SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place,
                 trim(text, {_SPACE}) AS said FROM damaged),
        faults AS (
          SELECT *, CASE WHEN said = '' THEN 'blank'
                         WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY place) > 1 THEN 'duplicate'
                         WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                 lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) || left(role, 1) AS neighbours FROM placed),
        grammar(state, initial, after) AS (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('a', 'u', 'u'), ('u', 'a', 'a')),
        names(initial, name) AS (VALUES ('u', 'user'), ('a', 'assistant')),
        once AS (SELECT state, after, name || ':' AS written FROM grammar JOIN names USING (initial)),
        inserts AS (
          SELECT state, state AS after, '' AS letters, [] AS written FROM (SELECT DISTINCT state FROM grammar) UNION ALL
          SELECT state, after, 'I', [written] FROM once UNION ALL
          SELECT one.state, two.after, 'II', [one.written, two.written] FROM once one JOIN once two ON two.state = one.after),
        steps AS (
          SELECT conv_id, place, state, state AS after, 'D' AS letter, 3 AS price, CAST([] AS VARCHAR[]) AS written
          FROM faults, (SELECT DISTINCT state FROM grammar) UNION ALL
          SELECT conv_id, place, state, after, 'K', CAST(fault = 'truncated' AS INTEGER), [role || ':' || text]
          FROM faults JOIN grammar ON initial = left(role, 1) WHERE fault NOT IN ('blank', 'duplicate') UNION ALL
          SELECT conv_id, place, state, after, 'R', 2 + CAST(fault = 'truncated' AS INTEGER), [name || ':' || text]
          FROM faults, grammar JOIN names USING (initial) WHERE fault NOT IN ('blank', 'duplicate')),
        moves AS (
          SELECT conv_id, place, i.state, s.after, letters || letter AS letters, 2 * length(letters) + price AS price, list_concat(i.written, s.written) AS written
          FROM steps s JOIN inserts i ON i.after = s.state),
        best AS (
          SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS place, '' AS state,
                 struct_pack(cost := CAST(0 AS BIGINT), audit := '', written := CAST([] AS VARCHAR[])) AS v FROM conversations
          UNION ALL
          SELECT b.conv_id, m.place, m.after,
                 min(struct_pack(cost := v.cost + price, audit := v.audit || letters, written := list_concat(v.written, m.written)))
          FROM best b JOIN moves m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.place = b.place + 1 AND m.state = b.state
          GROUP BY b.conv_id, m.place, m.after),
        counted AS (
          SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                 count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
                 count(*) FILTER (WHERE fault = 'truncated') AS truncated,
                 count(*) FILTER (WHERE place > 1 AND neighbours NOT IN ('su', 'ua', 'au')) AS illegal
          FROM faults GROUP BY conv_id),
        ended AS (
          SELECT b.conv_id, min(struct_pack(cost := v.cost + 2 * length(letters), audit := v.audit || letters, written := list_concat(v.written, i.written))) AS v
          FROM best b LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM b.conv_id JOIN inserts i ON i.state = b.state AND i.after IN ('', 'a')
          WHERE place = coalesce(n, 0) GROUP BY b.conv_id)
        SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(v.cost AS BIGINT) AS cost, v.audit AS audit,
               sha256(array_to_string(v.written, chr(10))) AS repaired_sha256
        FROM ended e LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM e.conv_id""",
}
