"""Registered queries of this package: each applies one operator to its whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadline.config import prepare_session
from leadline.llm import crf_quality, gated_lm, language_mixture
from leadline.llm.containment import find_contained
from leadline.llm.cuckoo import exact_groups
from leadline.llm.hard_negatives import mine_negatives
from leadline.llm.license_rules import scan_licenses
from leadline.llm.main_text import extract_text
from leadline.llm.mixing import mix_sizes, sizes_of
from leadline.llm.ngram_join import similar_components
from leadline.llm.prefix_free import remove_repeated_strings
from leadline.llm.recompression import remove_repeated_passages
from leadline.llm.turn_repair import damage, repair_conversations


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    prepare_session(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def remainder(of: int, ident: str = "doc_id"):
    """crc32 of the id as text, modulo ``of``; null ids have none."""
    return F.crc32(F.col(ident).cast("string").cast("binary")) % of


def op1_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    """Components of documents whose 4-word shingle sets are 85 % similar."""
    return similar_components(table(spark, folder, "documents"), size=4, percent=85)


def op2_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Groups of equal texts from the cuckoo index; the least id of each stays."""
    found = exact_groups(table(spark, folder, "documents"))
    digest = F.lower(F.hex("digest")).alias("text_sha256")
    return found.select("doc_id", "keep_id", "group_size", "kept", digest)


def op3_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Largest language of each document's mixture; learned where the remainder is not 2."""
    documents = table(spark, folder, "documents")
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    model = language_mixture.train(documents, "lang", "text", ~held_out)
    found = language_mixture.identify(documents, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op4_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words removed because their 13-word window also starts in an earlier document."""
    found = remove_repeated_passages(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op5_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document that the mix takes."""
    found = mix_sizes(sizes_of(table(spark, folder, "documents")))
    return found.select("doc_id", "size", "source_size", "target", "taken")


def op6_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Documents that contain a test item, with the share of its shingles they hold."""
    found = find_contained(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.withColumn("containment", F.col("n_shared") / F.col("n_item"))


def op7_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and labels of each document."""
    return scan_licenses(table(spark, folder, "documents")).drop("detections")


def op8_suffix_array_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes removed because their 200-byte string starts elsewhere too."""
    found = remove_repeated_strings(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op9_lm_scores(spark: SparkSession, folder: str) -> DataFrame:
    """Log10 probabilities of each document; learned where the remainder is not 2."""
    documents = table(spark, folder, "documents")
    held_out = F.coalesce(remainder(7) == 2, F.lit(False))
    found = gated_lm.score_documents(documents, ~held_out)
    return found.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op10_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    """Quality of each document; learned from labels where the remainder is not 0."""
    documents = table(spark, folder, "documents")
    held_out = F.coalesce(remainder(5) == 0, F.lit(False))
    model = crf_quality.train(documents, table(spark, folder, "labels"), ~held_out)
    found = crf_quality.score_documents(documents, model)
    predicted = (F.col("score") >= crf_quality.THRESHOLD).cast("int")
    return found.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op11_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    found = extract_text(table(spark, folder, "pages"), "html", "page_id", "url")
    return found.select("page_id", "url", "text", "n_chars")


def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Faults of damaged conversations and their cheapest repair."""
    return repair_conversations(damage(table(spark, folder, "conversations")), gone=F.col("gone"))


def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Hard negatives of every hundredth vector, a seventh of the labels moved on by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_negatives(table(spark, folder, "embeddings"), F.col("vec_id") % 100 == 0, label=moved)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_join": op1_ngram_join,
    "op2_exact_dedup": op2_exact_dedup,
    "op3_language_id": op3_language_id,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_source_mix": op5_source_mix,
    "op6_benchmark_decontamination": op6_benchmark_decontamination,
    "op7_license_scan": op7_license_scan,
    "op8_suffix_array_dedup": op8_suffix_array_dedup,
    "op9_lm_scores": op9_lm_scores,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_html_extraction": op11_html_extraction,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_hard_negatives": op13_hard_negatives,
}

_TEXT = "coalesce(text, '')"
_GAP = r"[\x20\x09-\x0D]+"

OP1_SQL = f"""
WITH RECURSIVE listed AS (
    SELECT doc_id, list_filter(
        string_split_regex(translate({_TEXT}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_GAP}'),
        lambda w: w <> ''
    ) AS words FROM documents
), shingle AS (
    SELECT DISTINCT doc_id, md5(array_to_string(words[pos:pos + 3], ' ')) AS shingle
    FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 3, 1) + 1)) AS pos FROM listed WHERE len(words) > 0)
), sizes AS (
    SELECT doc_id, count(*)::BIGINT AS n FROM shingle GROUP BY doc_id
), shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM shingle AS x JOIN shingle AS y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
    SELECT a, b FROM shared JOIN sizes AS s ON s.doc_id = a JOIN sizes AS t ON t.doc_id = b
    WHERE 100 * common >= 85 * (s.n + t.n - common)
), reached AS (
    SELECT doc_id AS a, doc_id AS b FROM documents
    UNION
    SELECT reached.a, links.b FROM reached JOIN links ON reached.b = links.a
)
SELECT listed.doc_id, coalesce(n, 0) AS n_shingles, least AS component_id
FROM listed LEFT JOIN sizes USING (doc_id)
JOIN (SELECT a AS doc_id, min(b) AS least FROM reached GROUP BY a) USING (doc_id)
"""

OP2_SQL = f"""
WITH digests AS (
    SELECT doc_id, sha256(regexp_replace({_TEXT}, '{_GAP}', ' ', 'g')) AS text_sha256 FROM documents
)
SELECT doc_id,
       min(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id) = 1 AS kept,
       text_sha256
FROM digests WINDOW same AS (PARTITION BY text_sha256)
"""

OP4_SQL = f"""
WITH listed AS (
    SELECT doc_id, list_filter(string_split_regex({_TEXT}, '{_GAP}'), lambda w: w <> '') AS words FROM documents
), windows AS (
    SELECT doc_id, pos, md5(array_to_string(words[pos:pos + 12], ' ')) AS content
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS pos FROM listed)
), repeated AS (
    SELECT doc_id, pos FROM (SELECT *, min(doc_id) OVER (PARTITION BY content) AS least FROM windows)
    WHERE least < doc_id
), covered AS (
    SELECT doc_id, list_sort(list(DISTINCT place)) AS places
    FROM (SELECT doc_id, unnest(range(pos, pos + 13)) AS place FROM repeated) GROUP BY doc_id
), single AS (
    SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM listed
), gone AS (
    SELECT doc_id, unnest(places) AS place FROM covered
), kept AS (
    SELECT doc_id, string_agg(word, ' ' ORDER BY place) AS kept_text
    FROM single ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id
)
SELECT doc_id,
       len(words)::BIGINT AS n_words,
       coalesce(len(places), 0)::BIGINT AS n_removed,
       sha256(coalesce(kept_text, '')) AS kept_sha256
FROM listed LEFT JOIN covered USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

OP5_SQL = f"""
WITH sizes AS (
    SELECT doc_id, source, len(list_filter(string_split_regex({_TEXT}, '{_GAP}'), lambda w: w <> ''))::BIGINT AS size
    FROM documents
), summed AS (
    SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source
), ranked AS (
    SELECT *, place, [3, 1, 2][(place % 3) + 1]::BIGINT AS weight
    FROM (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM summed)
), stepped AS (
    SELECT *,
           4 * source_size AS cap,
           3 * (sum(source_size) OVER ()) AS budget,
           coalesce(sum(4 * source_size) OVER before, 0) AS cap_before,
           sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS weight_left
    FROM ranked
    WINDOW before AS (
        ORDER BY source_size / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
    )
), flagged AS (
    SELECT *, (budget - cap_before) * weight > cap * weight_left AS full_up FROM stepped
), targets AS (
    SELECT source, source_size,
           CASE WHEN full_up THEN cap::DOUBLE / 2.0
                ELSE ((budget - coalesce(sum(cap) FILTER (full_up) OVER (), 0)) * weight)::DOUBLE
                     / (2 * sum(weight) FILTER (NOT full_up) OVER ())::DOUBLE END AS target
    FROM flagged
), drawn AS (
    SELECT doc_id, sizes.source, size, source_size, target,
           CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate,
           ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, 'null')), 1, 13))::BIGINT / 4503599627370496.0 AS draw
    FROM sizes JOIN targets ON sizes.source IS NOT DISTINCT FROM targets.source
), turned AS (
    SELECT *, CASE WHEN draw + shift / 32.0::DOUBLE >= 1 THEN draw + shift / 32.0::DOUBLE - 1
                   ELSE draw + shift / 32.0::DOUBLE END AS moved
    FROM drawn, range(32) AS shifts(shift)
), taken AS (
    SELECT *, size * (floor(rate)::BIGINT + CASE WHEN moved < rate - floor(rate) THEN 1 ELSE 0 END) AS taken FROM turned
), nearest AS (
    SELECT source, shift FROM taken GROUP BY source, shift
    QUALIFY row_number() OVER (PARTITION BY source ORDER BY abs(sum(taken)::DOUBLE - any_value(target)), shift) = 1
)
SELECT doc_id, size, source_size, target, taken
FROM taken JOIN nearest ON taken.source IS NOT DISTINCT FROM nearest.source AND taken.shift = nearest.shift
"""

_PLAIN = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _shingles_sql(ident: str, name: str) -> str:
    """Distinct five-word shingles of a table; a shorter text is one shingle."""
    words = f"list_filter(string_split_regex({_PLAIN.format(_TEXT)}, '{_BETWEEN}'), lambda w: w <> '')"
    return f"""
    SELECT DISTINCT {ident}, array_to_string(words[pos:pos + 4], ' ') AS shingle
    FROM (
        SELECT {ident}, words, unnest(range(1, greatest(len(words) - 4, 1) + 1)) AS pos
        FROM (SELECT {ident}, {words} AS words FROM {name}) WHERE len(words) > 0
    )"""


OP6_SQL = f"""
WITH doc AS ({_shingles_sql("doc_id", "documents")}
), item AS ({_shingles_sql("item_id", "benchmark")}
), sizes AS (
    SELECT item_id, count(*)::BIGINT AS n_item FROM item GROUP BY item_id
), shared AS (
    SELECT doc_id, item_id, count(*)::BIGINT AS n_shared FROM doc JOIN item USING (shingle) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, n_item, n_shared, n_shared / n_item AS containment
FROM shared JOIN sizes USING (item_id) WHERE 100 * n_shared >= 80 * n_item
"""

OP8_SQL = f"""
WITH coded AS (
    SELECT doc_id, hex(encode({_TEXT})) AS code FROM documents
), windows AS (
    SELECT doc_id, pos, md5(substr(code, 2 * pos + 1, 400)) AS content
    FROM (SELECT doc_id, code, unnest(range(0, len(code) // 2 - 199)) AS pos FROM coded)
), repeated AS (
    SELECT doc_id, pos FROM (SELECT *, count(*) OVER (PARTITION BY content) AS places FROM windows)
    WHERE places > 1
), stepped AS (
    SELECT doc_id, pos, lag(pos) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM repeated
), numbered AS (
    SELECT doc_id, pos,
           sum(CASE WHEN pos - before <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY pos) AS span
    FROM stepped
), spans AS (
    SELECT doc_id, span, min(pos) AS first, max(pos) + 200 AS last FROM numbered GROUP BY doc_id, span
), gaps AS (
    SELECT doc_id, span, first, last,
           coalesce(lag(last) OVER (PARTITION BY doc_id ORDER BY span), 0) AS resume
    FROM spans
), kept AS (
    SELECT doc_id,
           string_agg(substr(code, 2 * resume + 1, 2 * (first - resume)), '' ORDER BY span)
               || substr(any_value(code), 2 * max(last) + 1) AS code,
           sum(last - first)::BIGINT AS n_removed,
           count(*) AS n_spans
    FROM gaps JOIN coded USING (doc_id) GROUP BY doc_id
)
SELECT coded.doc_id,
       (len(coded.code) // 2)::BIGINT AS n_bytes,
       coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(coalesce(kept.code, coded.code))) AS kept_sha256
FROM coded LEFT JOIN kept ON coded.doc_id = kept.doc_id
"""

OP12_SQL = """
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           list_transform(
               string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT
           ) AS bytes
    FROM conversations
), drawn AS (
    SELECT *, xor(list_reduce(
        list_prepend(4294967295::BIGINT, bytes),
        lambda crc, byte: list_reduce(
            list_prepend(xor(crc, byte), [0::BIGINT for i in range(8)]),
            lambda c, none: xor(c >> 1, 3988292384 * (c & 1))
        )
    ), 4294967295) % 20 AS kind FROM keyed
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
           CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
           unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM drawn WHERE kind <> 0
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS place,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
           rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare
    FROM damaged
), judged AS (
    SELECT *, CASE WHEN bare = '' THEN 'blank' WHEN again THEN 'duplicate'
                   WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'fine' END AS fault,
           left(role, 1) AS initial,
           lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY place) || left(role, 1) AS pair
    FROM ordered
), listed AS (
    SELECT conv_id,
           coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
           list({'role': role, 'text': text, 'initial': initial, 'gone': fault IN ('blank', 'duplicate'),
                 'more': CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END} ORDER BY place) AS turns
    FROM judged GROUP BY conv_id
), walk AS (
    SELECT conv_id, turns, 1 AS place,
           {'c': 0::BIGINT, 'a': '', 't': []::VARCHAR[]} AS l0,
           {'c': 1000000000::BIGINT, 'a': '', 't': []::VARCHAR[]} AS l1,
           {'c': 1000000000::BIGINT, 'a': '', 't': []::VARCHAR[]} AS l2,
           {'c': 1000000000::BIGINT, 'a': '', 't': []::VARCHAR[]} AS l3
    FROM listed
    UNION ALL
    SELECT conv_id, turns, place + 1,
           {'c': m0.c + 2, 'a': m0.a || 'D', 't': m0.t},
           list_min([{'c': m1.c + 2, 'a': m1.a || 'D', 't': m1.t},
                     {'c': m0.c + keep + CASE WHEN initial = 's' THEN 0 ELSE 1000000000 END, 'a': m0.a || 'K', 't': list_append(m0.t, line)}]),
           list_min([{'c': m2.c + 2, 'a': m2.a || 'D', 't': m2.t}] || [
               {'c': m.c + keep + CASE WHEN initial = 'u' THEN 0 ELSE 1 END,
                'a': m.a || CASE WHEN initial = 'u' THEN 'K' ELSE 'R' END,
                't': list_append(m.t, CASE WHEN initial = 'u' THEN line ELSE 'user:' || text END)} for m in [m0, m1, m3]]),
           list_min([{'c': m3.c + 2, 'a': m3.a || 'D', 't': m3.t},
                     {'c': m2.c + keep + CASE WHEN initial = 'a' THEN 0 ELSE 1 END,
                      'a': m2.a || CASE WHEN initial = 'a' THEN 'K' ELSE 'R' END,
                      't': list_append(m2.t, CASE WHEN initial = 'a' THEN line ELSE 'assistant:' || text END)}])
    FROM (
        SELECT conv_id, turns, place, l0 AS m0, l1 AS m1, m2,
               list_min([l3, {'c': m2.c + 5, 'a': m2.a || 'I', 't': list_append(m2.t, 'assistant:')}]) AS m3,
               turns[place].initial AS initial, turns[place].text AS text,
               turns[place].role || ':' || turns[place].text AS line,
               turns[place].more + CASE WHEN turns[place].gone THEN 1000000000 ELSE 0 END AS keep
        FROM (
            SELECT *, list_min([l2] || [{'c': l.c + 5, 'a': l.a || 'I', 't': list_append(l.t, 'user:')} for l in [l0, l1, l3]]) AS m2
            FROM walk WHERE place <= len(turns)
        )
    )
), ended AS (
    SELECT conv_id, list_min([l0, l3, {'c': m2.c + 5, 'a': m2.a || 'I', 't': list_append(m2.t, 'assistant:')}]) AS best
    FROM (
        SELECT *, list_min([l2] || [{'c': l.c + 5, 'a': l.a || 'I', 't': list_append(l.t, 'user:')} for l in [l0, l1, l3]]) AS m2
        FROM walk WHERE place = len(turns) + 1
    )
)
SELECT ids.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS ids
LEFT JOIN listed ON listed.conv_id IS NOT DISTINCT FROM ids.conv_id
LEFT JOIN ended ON ended.conv_id IS NOT DISTINCT FROM ids.conv_id
"""

OP13_SQL = """
WITH prepared AS (
    SELECT row_number() OVER () AS number, vec_id,
           CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
    SELECT a.number AS anchor, a.vec_id AS anchor_id, a.label AS anchor_label, b.number AS other, b.vec_id, b.label,
           list_inner_product(a.vec, b.vec)::BIGINT AS score
    FROM prepared AS a JOIN prepared AS b ON a.vec_id % 100 = 0 AND a.number <> b.number
), near AS (
    SELECT anchor, anchor_id, anchor_label, other AS positive, vec_id AS positive_id, score AS positive_score
    FROM scored WHERE label = anchor_label
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, other) <= 5
), ranked AS (
    SELECT anchor_id, positive_id, vec_id AS negative_id, positive_score, score AS negative_score,
           row_number() OVER (PARTITION BY anchor, positive ORDER BY score DESC, vec_id, other) AS rank
    FROM near JOIN scored USING (anchor, anchor_id, anchor_label)
    WHERE label <> anchor_label AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
)
SELECT anchor_id, positive_id, rank::INTEGER AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 10
"""

ORACLE_SQL: dict[str, str] = {
    "op1_ngram_join": OP1_SQL,
    "op2_exact_dedup": OP2_SQL,
    "op4_substring_dedup": OP4_SQL,
    "op5_source_mix": OP5_SQL,
    "op6_benchmark_decontamination": OP6_SQL,
    "op8_suffix_array_dedup": OP8_SQL,
    "op12_conversation_repair": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
