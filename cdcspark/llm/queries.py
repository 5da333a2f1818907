"""The registered queries of this package, each over its whole table, and their SQL."""

from __future__ import annotations

import zlib

from pyspark.sql import functions as F

from cdcspark.llm import chat, decontaminate, html, langid, neardup, packing, pii, repeats, runs, shards, spelling, vectors, warc
from cdcspark.llm.common import read_table, vocabulary


def op10_decontaminate(spark, sf_dir):
    found = decontaminate.contamination(
        read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), "contaminated",
    )


def op1_gzip_normaliser(spark, sf_dir):
    return warc.archived_pages(spark, read_table(spark, sf_dir, "pages"))


def op2_nearest_centroid(spark, sf_dir):
    return langid.identify(read_table(spark, sf_dir, "documents"))


def op3_coordinate_join(spark, sf_dir):
    return neardup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op4_bin_packing(spark, sf_dir):
    return shards.shard(read_table(spark, sf_dir, "documents"))


def op5_product_quantisation(spark, sf_dir):
    return vectors.near_vectors(read_table(spark, sf_dir, "embeddings"))


def op6_consensus_paths(spark, sf_dir):
    return html.main_text(read_table(spark, sf_dir, "pages"))


def op7_radix_repeats(spark, sf_dir):
    return repeats.remove_repeats(read_table(spark, sf_dir, "documents"))


def op8_deobfuscation(spark, sf_dir):
    return pii.find(read_table(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark, sf_dir):
    pieces = packing.tokenize(read_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))
    return packing.pack(pieces)


def _looped(doc_id, words):
    """Words of every tenth document from some place on repeated with a period that the document's checksum gives."""
    h = zlib.crc32(b"%d" % doc_id)
    if h % 10 or not words:
        return words
    n, g = len(words), h // 10
    first = g % n
    period = 1 + (n - first) // (3 + g % 8)
    return words[:first] + [words[first + (i - first) % period] for i in range(first, n)]


def op11_lyndon_runs(spark, sf_dir):
    found = runs.collapse_runs(read_table(spark, sf_dir, "documents"), before=_looped)
    # Runs are sorted, so of equal ones the first stays.
    best = F.reduce(
        "runs", F.get("runs", F.lit(0)),
        lambda a, b: F.when(b["length"] * a["period"] > a["length"] * b["period"], b).otherwise(a),
    )
    lines = F.transform("runs", lambda x: F.concat(F.concat_ws(",", x["start"], x["length"], x["period"]), F.lit("\n")))
    found = found.select("doc_id", "runs", "text", best.alias("best"), F.array_join(lines, "").alias("lines"))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.col("lines").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_gram_variants(spark, sf_dir):
    return spelling.spelling_variants(read_table(spark, sf_dir, "documents"))


def op13_relational_chat(spark, sf_dir):
    """The digests are of what is read back from the formatted conversations."""
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"),
    )
    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.read_back(chat.format_conversations(turns))


#: Text of the conversation that is added: it holds strings of templates.
PROBE = r"\### Assistant: </turn> ok"

QUERIES = {
    "op1_gzip_normaliser": op1_gzip_normaliser,
    "op2_nearest_centroid": op2_nearest_centroid,
    "op3_coordinate_join": op3_coordinate_join,
    "op4_bin_packing": op4_bin_packing,
    "op5_product_quantisation": op5_product_quantisation,
    "op6_consensus_paths": op6_consensus_paths,
    "op7_radix_repeats": op7_radix_repeats,
    "op8_deobfuscation": op8_deobfuscation,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_decontaminate": op10_decontaminate,
    "op11_lyndon_runs": op11_lyndon_runs,
    "op12_gram_variants": op12_gram_variants,
    "op13_relational_chat": op13_relational_chat,
}

_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

SQL = {
    "op12_gram_variants": f"""
WITH RECURSIVE bits AS (SELECT list(list_reduce([x] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
                                    ORDER BY x) AS t FROM range(256) r(x)),
runs AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[a-z\u00C0-\u00FF]+')) AS w FROM documents)
         GROUP BY doc_id, w),
raw AS (SELECT doc_id, w, n, hex(encode(doc_id::VARCHAR || ':' || w)) AS x FROM runs),
crc AS (SELECT doc_id, w, n, xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(range(1, len(x), 2),
          lambda i: (strpos('0123456789ABCDEF', x[i]) - 1) * 16 + strpos('0123456789ABCDEF', x[i + 1]) - 1),
          lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM raw, bits),
damaged AS (SELECT n, CASE WHEN h % 97 = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM crc),
v AS (SELECT word, sum(n)::BIGINT AS n FROM damaged WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) AS pre, substr(word, i + 1) AS post
        FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
pairs AS (SELECT p.word AS a, q.word AS b, q.n AS nb FROM cut p JOIN cut q ON p.pre = q.pre AND p.post = q.post AND p.i = q.i WHERE p.word <> q.word
          UNION SELECT c.word, v.word, v.n FROM cut c JOIN v ON v.word = c.pre || c.post
          UNION SELECT v.word, c.word, c.n FROM cut c JOIN v ON v.word = c.pre || c.post),
best AS (SELECT a, count(*) AS n_near, min(struct_pack(less := -nb, b := b)) AS m FROM pairs GROUP BY a),
f AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -m.less >= 2 * v.n THEN m.b END AS form,
             CASE WHEN -m.less >= 2 * v.n THEN -m.less END AS form_n FROM v LEFT JOIN best ON a = v.word),
way AS (SELECT word, word AS at FROM f UNION SELECT way.word, f.form FROM way JOIN f ON f.word = way.at WHERE f.form IS NOT NULL)
SELECT f.word, f.form, way.at AS root, f.n, f.n_near, f.form_n::BIGINT AS form_n
FROM f JOIN way ON way.word = f.word JOIN f last ON last.word = way.at AND last.form IS NULL""",
    "op13_relational_chat": f"""
WITH all_turns AS (SELECT conv_id, turn, role, text FROM conversations
                   UNION ALL VALUES (-7, 0, 'user', '{PROBE}'), (-7, 1, 'assistant', '{PROBE}')),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM all_turns),
e AS (SELECT *, length(regexp_replace(text, '<(/?)(\\\\*)turn', '<\\1\\\\\\2turn', 'g')) AS n_text,
             length(regexp_replace(role, '<(/?)(\\\\*)turn', '<\\1\\\\\\2turn', 'g')) AS n_role,
             lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n_text + CASE WHEN role = before THEN 7 ELSE n_role + 21 END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id""",
    "op5_product_quantisation": """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings),
ok AS (SELECT vec_id, x FROM v WHERE len(x) > 0 AND len(list_filter(x, lambda c: c IS NULL OR NOT isfinite(c))) = 0
       AND len(list_filter(x, lambda c: c <> 0)) > 0),
pairs AS (SELECT p.vec_id AS a, q.vec_id AS b FROM ok p JOIN ok q ON p.vec_id < q.vec_id AND len(p.x) = len(q.x)
          WHERE list_cosine_similarity(p.x, q.x) >= 0.95),
e AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
c AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
n AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id""",
    "op3_coordinate_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(0, len(w) - 4), lambda i: array_to_string(w[i + 1 : i + 5], ' ')) END) AS g FROM d),
x AS (SELECT doc_id, len(g) AS n, unnest(g) AS t FROM s),
pairs AS (SELECT p.doc_id AS a, q.doc_id AS b FROM x p JOIN x q ON p.t = q.t AND p.doc_id < q.doc_id
          GROUP BY p.doc_id, q.doc_id, p.n, q.n HAVING 100 * count(*) >= 75 * (p.n + q.n - count(*))),
e AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
SELECT s.doc_id, len(g)::BIGINT AS n_shingles, c.c AS component_id, s.doc_id = c.c AS kept
FROM s JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) c ON c.a = s.doc_id""",
    "op1_gzip_normaliser": """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
r AS (SELECT payload, max(page_id) AS response_id FROM p WHERE strlen(payload) >= 1000 GROUP BY payload)
SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest,
       CASE WHEN response_id IS NULL OR response_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN response_id <> page_id THEN response_id END AS refers_to
FROM p LEFT JOIN r USING (payload)""",
    "op10_decontaminate": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER}, '{_WORD}') AS w FROM benchmark),
bw AS (SELECT item_id, least(13, len(w)) AS len, unnest(list_transform(range(0, len(w) - least(13, len(w)) + 1),
         lambda i: array_to_string(w[i + 1 : i + least(13, len(w))], ' '))) AS t FROM b WHERE len(w) > 0),
lens AS (SELECT DISTINCT len FROM bw),
dw AS (SELECT doc_id, len, unnest(range(0, len(w) - len + 1)) AS pos, unnest(list_transform(range(0, len(w) - len + 1),
         lambda i: array_to_string(w[i + 1 : i + len], ' '))) AS t FROM d, lens WHERE len(w) >= len),
hits AS (SELECT doc_id, pos, dw.len AS len, item_id FROM dw JOIN bw ON dw.len = bw.len AND dw.t = bw.t),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + len)) AS p FROM hits) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item_id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)""",
}
