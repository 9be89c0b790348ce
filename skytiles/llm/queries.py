"""The registered query of each operator: whole tables in, one digest row
per document, page or query vector out. ``ORACLES`` holds DuckDB SQL where
SQL can say the same; the other queries are tested against brute force."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import (alignment, decontaminate, htmltext, language, neardup, packing, prefixtrie,
               quality, secrets, sentencepieces, topk, urlfilter, warc)
from .common import read_table

PIECE_MODEL = "piece_bpe_32k.model"
BYTE_VOCABULARY = "byte_bpe_50k.json"
WORD_VOCABULARY = "word_bpe_49k.json"


def op1_sentencepiece(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    pieces = sentencepieces.encode_documents(docs, public_tokenizers.path(PIECE_MODEL))
    return pieces.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


def op2_secret_scan(spark, sf_dir):
    spans = secrets.secret_spans(read_table(spark, sf_dir, "documents"))

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    def joined(col):
        return F.array_join(F.transform(col, lambda s: F.concat_ws(
            ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return spans.select(
        "doc_id", count("assign").alias("n_assign"), count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"))


def _held_out():
    return F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2


def op3_language(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = language.fit(docs, ~_held_out())
    return language.predict_languages(docs, model).select(
        "doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score",
        "rejected")


def op4_html_text(spark, sf_dir):
    return htmltext.extract(read_table(spark, sf_dir, "pages")).select(
        "page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_warc(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    records = warc.read_archives(warc.archive_pages(pages), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type",
                          "refers_to")


def op6_decontamination(spark, sf_dir):
    found = decontaminate.contamination(read_table(spark, sf_dir, "documents"),
                                        read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"))


def op7_quality(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, read_table(spark, sf_dir, "labels"), ~_held_out())
    return quality.score_quality(docs, model).select(
        "doc_id", F.coalesce(_held_out(), F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).alias("good"))


def op8_url_filter(spark, sf_dir):
    return urlfilter.judge_urls(read_table(spark, sf_dir, "pages")).select(
        "page_id", "host", "path", "rule", "verdict", "ratio")


def op9_near_duplicates(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    return neardup.near_duplicates(docs, shingle=4).select(
        F.col("id").alias("doc_id"), "n_shingles", F.col("component").alias("component_id"),
        "kept")


def op10_top_k(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, F.pmod("id", F.lit(50)) == 0, k=5).select(
        "query_id", "rank", F.col("id").alias("vec_id"), "score")


def op11_alignment(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    aligned = alignment.align_documents(docs, public_tokenizers.path(BYTE_VOCABULARY),
                                        public_tokenizers.path(PIECE_MODEL))
    stored = alignment.store_alignment(aligned.withColumn("groups_sha256", F.when(
        F.col("n_groups") > 0, F.sha2(F.col("groups").cast("binary"), 256)).otherwise(""))
        .drop("groups"))
    scored = alignment.score_documents(stored, alignment.pair_counts(stored))
    return scored.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum",
                         "groups_sha256")


def op12_packing(spark, sf_dir):
    packed = packing.pack_documents(read_table(spark, sf_dir, "documents"),
                                    public_tokenizers.path(WORD_VOCABULARY), with_ids=False)
    return packed.select("doc_id", "piece", "start", "length", F.col("crc").alias("ids_crc32"),
                         "sequence_id", "offset")


def op13_prefix_trie(spark, sf_dir):
    turns = prefixtrie.ordered_turns(read_table(spark, sf_dir, "conversations"))
    return prefixtrie.prefix_trie(*prefixtrie.shared_heads(turns))


QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_secret_scan": op2_secret_scan,
    "op3_language": op3_language,
    "op4_html_text": op4_html_text,
    "op5_warc": op5_warc,
    "op6_decontamination": op6_decontamination,
    "op7_quality": op7_quality,
    "op8_url_filter": op8_url_filter,
    "op9_near_duplicates": op9_near_duplicates,
    "op10_top_k": op10_top_k,
    "op11_alignment": op11_alignment,
    "op12_packing": op12_packing,
    "op13_prefix_trie": op13_prefix_trie,
}

_LOWER = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
          "'abcdefghijklmnopqrstuvwxyz')")

ORACLES = {
    "op5_warc": """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                  sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100
      GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)""",
    "op6_decontamination": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER},
                  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_LOWER},
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT item_id, w, least(10, len(w)) AS n,
                    unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
             FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens
             WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, i, dw.n FROM dw JOIN bw ON dw.s = bw.s AND dw.n = bw.n),
words AS (SELECT doc_id, count(DISTINCT p) AS n_hit
          FROM (SELECT doc_id, unnest(range(i, i + n)) AS p
                FROM (SELECT DISTINCT doc_id, i, n FROM hit)) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS l
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(l, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op9_near_duplicates": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER},
                '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + n - 1], ' ') AS g
      FROM (SELECT doc_id, w, least(4, len(w)) AS n,
                   unnest(range(1, len(w) - least(4, len(w)) + 2)) AS i
            FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
      FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM c JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
      WHERE 100 * k >= 80 * (p.n + q.n - k)),
r AS (SELECT doc_id AS x, doc_id AS root FROM d
      UNION SELECT l.y, r.root FROM r JOIN l ON l.x = r.x)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id,
       doc_id = min(root) AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.x = d.doc_id GROUP BY doc_id""",
    "op10_top_k": """
WITH v AS (SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)
                           FOR x IN embedding] AS e
           FROM embeddings
           WHERE embedding IS NOT NULL
             AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id,
             CAST(coalesce(list_sum([q.e[i] * c.e[i] FOR i IN range(1, len(q.e) + 1)]), 0) AS BIGINT) AS score
      FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
      FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5""",
    # A turn is one text, so that a path is a list of texts; the checksum of
    # an id is worked out bit by bit.
    "op13_prefix_trie": """
WITH own AS (SELECT conv_id AS c, hex(coalesce(role, '')) || ':' || hex(coalesce(text, '')) AS t,
                    length(coalesce(text, '')) AS chars,
                    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                                       coalesce(role, ''), coalesce(text, '')) AS k
             FROM conversations WHERE conv_id IS NOT NULL),
ids AS (SELECT c, xor(list_reduce(
            list_concat([4294967295], list_transform(string_split(CAST(c AS VARCHAR), ''),
                                                     lambda x: CAST(ascii(x) AS BIGINT))),
            lambda a, b: list_reduce(list_concat([xor(a, b)], CAST(range(8) AS BIGINT[])),
                                  lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 6 AS h
        FROM (SELECT DISTINCT c FROM own)),
parts AS (SELECT ids.c, 0 AS part, k, t FROM ids JOIN own ON own.c = ids.c - ids.c % 100 AND k <= h
          UNION ALL SELECT c, 1, k, t FROM ids JOIN own USING (c) WHERE k > h),
seqs AS (SELECT ids.c, coalesce(list(t ORDER BY part, k) FILTER (t IS NOT NULL),
                                CAST([] AS VARCHAR[])) AS s
         FROM ids LEFT JOIN parts USING (c) GROUP BY ids.c),
chars AS (SELECT DISTINCT t, chars FROM own),
steps AS (SELECT c, s[1:d] AS path, d, len(s) AS n FROM (
            SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM seqs)),
nodes AS (SELECT path, d, min(c) AS conv_id, count(*) AS n_convs,
                 sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)
                                 FILTER (d = n), '')) AS ends_sha256
          FROM steps GROUP BY path, d),
kids AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
shares AS (SELECT path, d, n_children IS NULL AS leaf,
                  (n_convs - 1) * coalesce(chars, 0) AS saved
           FROM nodes LEFT JOIN kids USING (path) LEFT JOIN chars ON chars.t = path[d]),
sums AS (SELECT path[1:e] AS path, count(*) FILTER (leaf) AS n_leaves,
                CAST(sum(saved) AS BIGINT) AS saved_tokens
         FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM shares) GROUP BY 1)
SELECT nodes.conv_id, nodes.d AS depth, up.conv_id AS parent_conv_id, nodes.n_convs,
       coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, nodes.ends_sha256
FROM nodes JOIN sums ON sums.path = nodes.path LEFT JOIN kids ON kids.path = nodes.path
LEFT JOIN nodes up ON nodes.d > 0 AND up.path = nodes.path[1:nodes.d - 1]""",
}
