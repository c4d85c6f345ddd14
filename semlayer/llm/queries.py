"""The registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import written
from .context_tree import score_texts
from .decontamination import contamination
from .kneser_ney import score_toxicity, train, training_share
from .licenses import license_scan
from .merkle import fingerprints_of_edits
from .mixing import taken_words
from .ngram_jaccard import near_duplicates
from .packing import packed
from .pii import personal_data
from .repair import audits, damaged, repaired_digests
from .spelling import spelling_forms, vocabulary
from .substring_dedup import remove_repeated_windows
from .token_counts import token_counts


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bootstrapped_pii(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(table(spark, folder, "documents"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = remove_repeated_windows(table(spark, folder, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op4_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan(table(spark, folder, "documents"))


def op5_hilbert_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packed(table(spark, folder, "documents"), tokenizer_path())


def op6_context_tree_score(spark: SparkSession, folder: str) -> DataFrame:
    held_out = F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(7)) == 2
    scored = score_texts(table(spark, folder, "documents").withColumn("train", ~held_out))
    return scored.withColumn("held_out", held_out).drop("train")


def op7_trie_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(table(spark, folder, "documents"), tokenizer_path("piece_bpe_32k.model"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def labelled(spark: SparkSession, documents: DataFrame, folder: str) -> DataFrame:
    """(text, toxic) of the documents whose labels may be learnt from, or of as many as training takes.

    Labels meet hashes of texts, the sample is drawn among distinct hashes, and only its texts are
    fetched: at most MOST_TRAINING hashes, which is what bounds the broadcast.
    """
    labels = table(spark, folder, "labels").where(~fold()).where("toxic in (0, 1)").select("doc_id", "toxic")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    light = documents.select("doc_id", F.xxhash64(text).alias("code"), F.octet_length(text).alias("size")).join(labels, "doc_id")
    distinct = written(light.groupBy("code").agg(F.max("toxic").alias("toxic"), F.max("size").alias("size")), "labelled")
    share = training_share(distinct.agg(F.count("*").alias("n"), F.sum("size").alias("bytes")).first())
    sample = distinct.where(F.pmod("code", F.lit(1 << 32)) < int(share * (1 << 32))).select("code", "toxic")
    return documents.select(text.alias("text"), F.xxhash64(text).alias("code")).join(F.broadcast(sample), "code").select("text", "toxic")


def fold() -> Column:
    """Whether a row is held out; a null doc_id counts as an empty string."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(5)) == 0


def op9_kneser_ney_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    model = train(labelled(spark, documents, folder))
    return score_toxicity(documents, model).withColumn("held_out", fold())


def op10_merkle_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    return fingerprints_of_edits(table(spark, folder, "documents"))


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling_forms(written(vocabulary(table(spark, folder, "documents")), "vocabulary"))


def op12_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    return taken_words(table(spark, folder, "documents"))


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = damaged(table(spark, folder, "conversations"))
    found = written(audits(rows), "audits")
    digests = repaired_digests(rows, found).withColumnRenamed("conv_id", "repaired_id")
    return found.join(digests, F.col("conv_id").eqNullSafe(F.col("repaired_id")), "left").drop("repaired_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bootstrapped_pii": op1_bootstrapped_pii,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_license_scan": op4_license_scan,
    "op5_hilbert_packing": op5_hilbert_packing,
    "op6_context_tree_score": op6_context_tree_score,
    "op7_trie_token_counts": op7_trie_token_counts,
    "op8_decontamination": op8_decontamination,
    "op9_kneser_ney_toxicity": op9_kneser_ney_toxicity,
    "op10_merkle_fingerprint": op10_merkle_fingerprint,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_source_mix": op12_source_mix,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE: dict[str, str] = {
    "op2_substring_dedup": r"""
        WITH words AS (
            SELECT doc_id, [x FOR x IN regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+') IF x <> ''] AS w
            FROM documents
        ), starts AS (
            SELECT doc_id, unnest(range(1, len(w) - 33)) AS k, w FROM words WHERE len(w) >= 35
        ), windows AS (
            SELECT doc_id, k, array_to_string(w[k:k + 34], ' ') AS seq FROM starts
        ), repeated AS (
            SELECT seq FROM windows GROUP BY seq HAVING count(*) > 1
        ), gone AS (
            SELECT doc_id, list_sort(list_distinct(flatten(list(range(k, k + 35))))) AS ks
            FROM windows JOIN repeated USING (seq) GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ks), 0)::BIGINT AS n_removed,
               sha256(coalesce(array_to_string(
                   CASE WHEN ks IS NULL THEN w
                        ELSE [w[k] FOR k IN range(1, len(w) + 1) IF NOT list_contains(ks, k)] END, ' '), '')) AS kept_sha256
        FROM words LEFT JOIN gone USING (doc_id)""",
    "op3_ngram_jaccard": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, [x FOR x IN regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x20\x09-\x0D]+') IF x <> ''] AS w
            FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[k:k + 4], ' ') AS s
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS k FROM words WHERE len(w) > 0)
        ), sizes AS (
            SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
        ), links AS (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
            JOIN sizes x ON x.doc_id = a.doc_id JOIN sizes y ON y.doc_id = b.doc_id
            GROUP BY a.doc_id, b.doc_id, x.n, y.n
            HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
        ), reached AS (
            SELECT doc_id AS a, doc_id AS b FROM documents
            UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b
        )
        SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least AS component_id
        FROM documents LEFT JOIN sizes USING (doc_id)
        JOIN (SELECT a AS doc_id, min(b) AS least FROM reached GROUP BY a) USING (doc_id)""",
    "op8_decontamination": r"""
        WITH texts AS (
            SELECT 'document' AS kind, doc_id::VARCHAR AS id, text FROM documents
            UNION ALL SELECT 'item', item_id::VARCHAR, text FROM benchmark
        ), words AS (
            SELECT kind, id, [x FOR x IN regexp_split_to_array(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> ''] AS w
            FROM texts
        ), windows AS (
            SELECT DISTINCT id AS item_id, least(len(w), 10) AS n, array_to_string(w[k:k + least(len(w), 10) - 1], ' ') AS seq
            FROM (SELECT *, unnest(range(1, greatest(len(w) - 8, 2))) AS k FROM words WHERE kind = 'item' AND len(w) > 0)
        ), places AS (
            SELECT id, k, n, array_to_string(w[k:k + n - 1], ' ') AS seq
            FROM (SELECT id, w, n, unnest(range(1, len(w) - n + 2)) AS k
                  FROM words, (SELECT DISTINCT n FROM windows) WHERE kind = 'document' AND len(w) >= n)
        ), hits AS (
            SELECT id, k, n, item_id FROM places JOIN windows USING (n, seq)
        ), found AS (
            SELECT id, len(list_distinct(flatten(list(range(k, k + n))))) AS n_hit, count(DISTINCT item_id) AS n_items,
                   array_to_string(list_sort(list(DISTINCT item_id)), ',') AS items
            FROM hits GROUP BY id
        )
        SELECT id::BIGINT AS doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
               coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM words LEFT JOIN found USING (id) WHERE kind = 'document'""",
    "op11_spelling_variants": r"""
        WITH RECURSIVE crc_table AS (
            SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
                        ORDER BY i) AS t
            FROM range(0, 256) AS r(i)
        ), runs AS (
            SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[a-z\x{00C0}-\x{00FF}]+')) AS run FROM documents
        ), counted AS (
            SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY doc_id, run
        ), coded AS (
            SELECT run, n, xor(list_reduce(flatten([CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [192 | (ord(x) >> 6), 128 | (ord(x) & 63)]::BIGINT[] END
                                                FOR x IN string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, '')]),
                                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) AS h
            FROM counted, crc_table
        ), words AS (
            SELECT word, sum(n)::BIGINT AS n
            FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n
                  FROM coded)
            WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
        ), cut AS (
            SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b
            FROM (SELECT *, unnest(range(1, length(word) + 1))::INT AS i FROM words)
        ), near AS (
            SELECT x.word, y.word AS other, y.n FROM cut x JOIN cut y ON x.a = y.a AND x.b = y.b AND x.word <> y.word
            UNION SELECT x.word, y.word, y.n FROM cut x JOIN words y ON y.word = x.a || x.b
            UNION SELECT y.word, x.word, x.n FROM cut x JOIN words y ON y.word = x.a || x.b
        ), best AS (
            SELECT word, count(*) AS n_near, min({'n': -n, 'w': other}) AS best FROM near GROUP BY word
        ), forms AS (
            SELECT word, CASE WHEN -best.n >= 5 * n THEN best.w END AS form, n, coalesce(n_near, 0)::BIGINT AS n_near,
                   CASE WHEN -best.n >= 5 * n THEN -best.n END::BIGINT AS form_n
            FROM words LEFT JOIN best USING (word)
        ), steps AS (
            SELECT word, word AS at FROM forms
            UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.at WHERE f.form IS NOT NULL
        )
        SELECT f.word, f.form, s.at AS root, f.n, f.n_near, f.form_n
        FROM forms f JOIN steps s USING (word) JOIN forms e ON e.word = s.at WHERE e.form IS NULL""",
    "op12_source_mix": r"""
        WITH docs AS (
            SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                   md5(coalesce(doc_id::VARCHAR, '') || ':' || coalesce(md5(text), '')) AS key
            FROM documents
        ), sizes AS (
            SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS id,
                   (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
            FROM docs GROUP BY source
        ), limits AS (
            SELECT *, row_number() OVER by_limit AS place,
                   (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER (by_limit ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
                   / (sum(weight) OVER (by_limit ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
            FROM sizes WINDOW by_limit AS (ORDER BY 3 * source_size / weight, id)
        ), targets AS (
            SELECT *, CASE WHEN place < min(place) FILTER (free) OVER () THEN 3.0::DOUBLE * source_size
                           ELSE least(3.0::DOUBLE * source_size, arg_min(level, place) FILTER (free) OVER () * weight) END AS target
            FROM (SELECT *, 3 * source_size >= level * weight AS free FROM limits)
        ), blocks AS (
            SELECT *, greatest(ceil(source_size / 1024), least(source_size,
                       coalesce(ceil(512.0::DOUBLE * source_size / nullif(target, 0)), 0)))::BIGINT AS blocks FROM targets
        ), quotas AS (
            SELECT *, least(floor(coalesce(target * blocks / nullif(source_size, 0), 0) + 0.5)::BIGINT, 3 * blocks) AS slots FROM blocks
        ), owned AS (
            SELECT *, (sum(slots) OVER (ORDER BY id) - slots)::BIGINT AS first_point,
                   greatest(1, len(bin(greatest(sum(slots) OVER () - 1, 0)::BIGINT))) AS bits FROM quotas
        ), slots AS (
            SELECT slot, list_sum([((slot >> i) & 1) << (bits - 1 - i) FOR i IN range(0, bits)])::BIGINT AS point
            FROM (SELECT max(bits) AS bits, unnest(range(0, 1::BIGINT << max(bits))) AS slot FROM owned)
        ), repeats AS (
            SELECT id, block, count(*) AS repeats
            FROM (SELECT id, (row_number() OVER (PARTITION BY id ORDER BY slot) - 1) % blocks AS block
                  FROM slots JOIN owned ON point >= first_point AND point < first_point + slots)
            GROUP BY id, block
        ), lines AS (
            SELECT d.*, o.id, source_size, target, blocks, source_size // greatest(blocks, 1) AS base, source_size % greatest(blocks, 1) AS longer,
                   (sum(size) OVER (PARTITION BY o.id ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size)::BIGINT AS first_word
            FROM docs d JOIN owned o ON d.source IS NOT DISTINCT FROM o.source
        ), cut AS (
            SELECT id, i AS block, i * base + least(i, longer) AS low, i * base + least(i, longer) + base + CASE WHEN i < longer THEN 1 ELSE 0 END AS high
            FROM (SELECT DISTINCT id, base, longer, blocks FROM lines), unnest(range(0, blocks)) AS t(i)
        ), taken AS (
            SELECT l.id, l.key, l.doc_id, sum((least(high, first_word + size) - greatest(low, first_word)) * repeats) AS taken
            FROM lines l JOIN cut c ON l.id = c.id AND low < first_word + size AND high > first_word
            JOIN repeats r ON r.id = c.id AND r.block = c.block
            WHERE size > 0 GROUP BY l.id, l.key, l.doc_id
        )
        SELECT l.doc_id, l.size, source_size, target, coalesce(taken, 0)::BIGINT AS taken
        FROM lines l LEFT JOIN taken t ON l.id = t.id AND l.key = t.key AND l.doc_id IS NOT DISTINCT FROM t.doc_id""",
    "op13_conversation_repair": r"""
        WITH RECURSIVE crc_table AS (
            SELECT list(list_reduce(range(0, 8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
                        ORDER BY i) AS t
            FROM range(0, 256) AS r(i)
        ), keyed AS (
            SELECT *, xor(list_reduce([ord(x)::BIGINT FOR x IN string_split(
                          coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), '')],
                      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295), 4294967295) % 20 AS f
            FROM conversations, crc_table
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN f = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
                   CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g') ELSE coalesce(text, ' ') END AS text,
                   unnest(range(0, CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
            FROM keyed
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
                   row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
                   NOT regexp_matches(text, '[^\x20\x09-\x0D]') AS is_blank,
                   NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') AS open
            FROM damaged
        ), faults AS (
            SELECT *, is_blank OR again AS must_go, open AND NOT is_blank AND NOT again AS cut, role[1] AS k,
                   lag(role[1]) OVER (PARTITION BY conv_id ORDER BY i) AS before
            FROM numbered
        ), moves(g, ins, b) AS (
            VALUES ('', '', ''), ('s', '', 's'), ('u', '', 'u'), ('a', '', 'a'), ('', 'I', 'u'), ('s', 'I', 'u'), ('u', 'I', 'a'), ('a', 'I', 'u')
        ), edits(b, e, k, g) AS (
            VALUES ('', 'D', NULL, ''), ('s', 'D', NULL, 's'), ('u', 'D', NULL, 'u'), ('a', 'D', NULL, 'a'), ('', 'K', 's', 's'), ('', 'K', 'u', 'u'),
                   ('s', 'K', 'u', 'u'), ('u', 'K', 'a', 'a'), ('a', 'K', 'u', 'u'), ('', 'R', NULL, 'u'), ('s', 'R', NULL, 'u'), ('u', 'R', NULL, 'a'), ('a', 'R', NULL, 'u')
        ), paths AS (
            SELECT DISTINCT conv_id, 0::BIGINT AS i, '' AS g, {'c': 0::BIGINT, 'a': '', 't': ''} AS best FROM conversations
            UNION ALL
            SELECT p.conv_id, p.i + 1, e.g, min({
                'c': p.best.c + CASE m.ins WHEN 'I' THEN 3 ELSE 0 END + CASE e.e WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END
                     + CASE WHEN f.cut AND e.e <> 'D' THEN 3 ELSE 0 END,
                'a': p.best.a || m.ins || e.e,
                't': p.best.t || CASE WHEN m.ins = '' THEN '' WHEN m.b = 'u' THEN chr(10) || 'user:' ELSE chr(10) || 'assistant:' END
                     || CASE e.e WHEN 'D' THEN '' WHEN 'K' THEN chr(10) || f.role || ':' || f.text
                        ELSE chr(10) || CASE e.g WHEN 'u' THEN 'user:' ELSE 'assistant:' END || f.text END})
            FROM paths p JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1
            JOIN moves m ON m.g = p.g JOIN edits e ON e.b = m.b AND (e.k IS NULL OR e.k = f.k) AND (e.e = 'D' OR NOT f.must_go)
            GROUP BY p.conv_id, p.i, e.g
        ), counts AS (
            SELECT c.conv_id, count(f.i) AS n, coalesce(max(f.turn) - min(f.turn) + 1 - count(DISTINCT f.turn), 0)::BIGINT AS gaps,
                   count(*) FILTER (f.is_blank) AS blank, count(*) FILTER (f.again AND NOT f.is_blank) AS duplicate,
                   count(*) FILTER (f.cut) AS truncated,
                   count(*) FILTER (f.before IS NOT NULL AND f.before || f.k NOT IN ('su', 'ua', 'au')) AS illegal
            FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id
            GROUP BY c.conv_id
        ), ends AS (
            SELECT c.conv_id, min({'c': best.c + CASE g WHEN 'u' THEN 3 ELSE 0 END, 'a': best.a || CASE g WHEN 'u' THEN 'I' ELSE '' END,
                                   't': best.t || CASE g WHEN 'u' THEN chr(10) || 'assistant:' ELSE '' END}) AS best
            FROM counts c JOIN paths p ON p.conv_id IS NOT DISTINCT FROM c.conv_id AND p.i = c.n WHERE g <> 's' GROUP BY c.conv_id
        )
        SELECT c.conv_id, gaps, blank, duplicate, truncated, illegal, best.c AS cost, best.a AS audit, sha256(substr(best.t, 2)) AS repaired_sha256
        FROM counts c JOIN ends e ON e.conv_id IS NOT DISTINCT FROM c.conv_id""",
}
