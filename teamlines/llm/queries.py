"""Registered queries of the corpus operators and the SQL twins of those that SQL can express."""

from pyspark.sql import functions as F

from teamlines.llm import alignment, decontam, exact, langid, lines, merkle, nearest, neardup, packing, quality, secrets, tokens, warc
from teamlines.llm.common import read_table


def op1_separator_scan(spark, sf_dir):
    """Tokens of each document, counted between the separators of flat token files."""
    found = tokens.token_counts(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "tokens")


def op2_warc_packages(spark, sf_dir):
    files = warc.write_packages(read_table(spark, sf_dir, "pages"))
    found = warc.read_records(files)
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_exact_dedup(spark, sf_dir):
    found = exact.duplicate_groups(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op4_secret_scan(spark, sf_dir):
    found = secrets.find_secrets(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op5_language_id(spark, sf_dir):
    found = langid.languages(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op6_quality_classifier(spark, sf_dir):
    found = quality.scores(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))
    return found.select("doc_id", "held_out", "score", "predicted")


def op7_mixture_packing(spark, sf_dir):
    found = packing.pack(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op8_benchmark_decontamination(spark, sf_dir):
    """A row per document and benchmark item found in it."""
    found = decontam.leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "windows", "edits", "start", "end")


def op9_line_dedup(spark, sf_dir):
    found = lines.remove_boilerplate(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_removed", F.sha2("clean_text", 256).alias("text_sha256"))


def op10_minhash_near_dedup(spark, sf_dir):
    found = neardup.near_duplicates(read_table(spark, sf_dir, "documents"), width=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_merkle_manifest(spark, sf_dir):
    """Proofs of all documents, checked with a copy in which some rows' ``n_chars`` is one more."""
    docs = read_table(spark, sf_dir, "documents")
    struck = F.crc32(docs["doc_id"].cast("string")) % 7 == 0
    more = F.when(struck, F.try_add(docs["n_chars"].cast("long"), F.lit(1))).otherwise(docs["n_chars"].cast("long"))
    found = merkle.proofs(docs, {"n_chars": more})
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


def op12_projection_forest(spark, sf_dir):
    found = nearest.nearest(read_table(spark, sf_dir, "embeddings"), k=20, every=20)
    return found.select("query_id", "rank", "vec_id", "score")


def op13_tokenizer_alignment(spark, sf_dir):
    found = alignment.alignments(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


QUERIES = {
    f.__name__: f
    for f in (
        op1_separator_scan,
        op2_warc_packages,
        op3_exact_dedup,
        op4_secret_scan,
        op5_language_id,
        op6_quality_classifier,
        op7_mixture_packing,
        op8_benchmark_decontamination,
        op9_line_dedup,
        op10_minhash_near_dedup,
        op11_merkle_manifest,
        op12_projection_forest,
        op13_tokenizer_alignment,
    )
}

EXACT_SQL = r"""
WITH n AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS content FROM documents
)
SELECT doc_id,
       min(doc_id) OVER (PARTITION BY content) AS keep_id,
       count(*) OVER (PARTITION BY content) AS group_size,
       doc_id = min(doc_id) OVER (PARTITION BY content) AS kept,
       sha256(content) AS text_sha256
FROM n
"""


def _either_case(words):
    letters = lambda w: "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
    return "(" + "|".join(letters(w) for w in words) + ")"


def secrets_sql():
    assign = (
        _either_case(["password", "passwd", "secret", "token", "api_?key"])
        + r"""[\"'']?\x20*[:=]\x20*[\"'']?([A-Za-z0-9+/_.=-]+)"""
    )
    rules = [
        ("assign", assign, 2, 12),
        ("access", "AKIA[A-Z0-9]+", 0, 18),
        ("hex", "[0-9a-f]{16,}", 0, 16),
        ("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
        ("github", "gh[pousr]_[A-Za-z0-9]{36,}", 0, 1),
    ]
    parts = " UNION ALL ".join(
        f"""SELECT doc_id, {place} AS place, '{kind}' AS kind, regexp_extract_all(t, '{pattern}') AS whole,
        string_split_regex(t, '{pattern}') AS gaps, regexp_extract_all(t, '{pattern}', {group}) AS told, {least} AS least FROM d"""
        for place, (kind, pattern, group, least) in enumerate(rules)
    )
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
m AS ({parts}),
e AS (SELECT *, unnest(range(1, len(whole) + 1)) AS i FROM m WHERE len(whole) > 0),
s AS (
  SELECT doc_id, place, kind, length(whole[i]) AS chars,
         list_sum(list_transform(gaps[1:i], lambda x: length(x)))
           + coalesce(list_sum(list_transform(whole[1:i-1], lambda x: length(x))), 0) AS start
  FROM e WHERE length(told[i]) >= least
),
g AS (
  SELECT doc_id, count(*) FILTER (WHERE place = 0) AS n_assign, count(*) FILTER (WHERE place = 1) AS n_access,
         count(*) FILTER (WHERE place = 2) AS n_hex,
         string_agg(concat_ws(':', kind, CAST(start AS BIGINT), CAST(start + chars AS BIGINT)), ',' ORDER BY start, place) AS spans,
         string_agg(concat_ws(':', kind, CAST(start AS BIGINT), CAST(start + chars AS BIGINT)), ',' ORDER BY start, place)
           FILTER (WHERE place < 3) AS base
  FROM s GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g USING (doc_id)
"""


LINES_SQL = f"""
WITH l AS (
  SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
  FROM documents
),
b AS (
  SELECT trim(line) AS key FROM l WHERE trim(line) <> '' GROUP BY 1 HAVING count(DISTINCT source) >= {lines.MIN_SITES}
)
SELECT doc_id, count(*) AS n_lines, count(b.key) AS n_removed,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE b.key IS NULL), '')) AS text_sha256
FROM l LEFT JOIN b ON trim(l.line) = b.key
GROUP BY doc_id
"""

# DuckDB has SHA-1 in hex only: base32 is taken from the bits of the digest, five at a time.
WARC_SQL = r"""
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS hex FROM pages
),
g AS (SELECT *, min(page_id) OVER (PARTITION BY payload) AS first FROM p),
b AS (
  SELECT *, array_to_string(list_transform(string_split(hex, ''), lambda c:
    lpad(bin(CAST(instr('0123456789abcdef', c) - 1 AS INTEGER)), 4, '0')), '') AS bits
  FROM g
)
SELECT page_id, octet_length(payload) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                CAST(list_sum(list_transform(range(0, 5), lambda j:
                  CAST(substr(bits, CAST(5 * i + j + 1 AS INTEGER), 1) AS INTEGER) * (1 << CAST(4 - j AS INTEGER)))) AS INTEGER) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""

# DuckDB has no CRC-32: it is taken from the characters' codes, eight shifts each.
MERKLE_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, lang, n_chars,
         xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
           lambda s: [ascii(s)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
           lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END), 4294967295::BIGINT) AS crc,
         coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-')
           || coalesce(octet_length(encode(source)) || ':' || source, '-') || coalesce(octet_length(encode(lang)) || ':' || lang, '-') AS head,
         coalesce(octet_length(encode(text)) || ':' || text, '-') AS tail
  FROM documents
),
h AS (
  SELECT *, sha256(head || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') || tail) AS leaf,
         sha256(head || coalesce(octet_length(encode(CAST(n_chars + 1 AS VARCHAR))) || ':' || (n_chars + 1), '-') || tail) AS copy
  FROM d
),
l AS (
  SELECT doc_id, leaf, CASE WHEN crc % 7 = 0 THEN copy ELSE leaf END AS copy,
         dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
         row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n
  FROM h
),
nodes AS (
  SELECT tree, 0 AS level, idx, leaf AS digest, n FROM l
  UNION ALL
  SELECT tree, level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM nodes WHERE n > 1 GROUP BY tree, level, idx // 2
),
subroots AS (SELECT tree, level AS height, digest FROM nodes WHERE n = 1),
joining AS (
  SELECT 0 AS level, tree AS idx, digest, (SELECT count(*) FROM subroots) AS n FROM subroots
  UNION ALL
  SELECT level + 1, idx // 2, sha256(string_agg(digest, '' ORDER BY idx)), (any_value(n) + 1) // 2
  FROM joining WHERE n > 1 GROUP BY level, idx // 2
),
steps AS (
  SELECT l.tree, l.idx, p.level, l.idx >> p.level AS spot, s.digest
  FROM l JOIN (SELECT DISTINCT tree, level FROM nodes WHERE n > 1) p ON p.tree = l.tree
  LEFT JOIN nodes s ON s.tree = l.tree AND s.level = p.level AND s.idx = xor(l.idx >> p.level, 1)
  UNION ALL
  SELECT l.tree, l.idx, 1000 + p.level, l.tree >> p.level, s.digest
  FROM l, (SELECT DISTINCT level FROM joining WHERE n > 1) p
  LEFT JOIN joining s ON s.level = p.level AND s.idx = xor(l.tree >> p.level, 1)
),
proofs AS (
  SELECT tree, idx, sha256(coalesce(string_agg(digest, '' ORDER BY level), '')) AS proof_sha256,
         list(CASE WHEN spot % 2 = 1 THEN 'L' ELSE 'R' END || coalesce(digest, '') ORDER BY level) AS path
  FROM steps GROUP BY tree, idx
),
f AS (
  SELECT l.doc_id, l.leaf, s.digest AS subroot, (SELECT digest FROM joining WHERE n = 1) AS root,
         coalesce(p.proof_sha256, sha256('')) AS proof_sha256,
         list_reduce(list_prepend(l.copy, coalesce(p.path, [])),
           lambda a, e: sha256(CASE WHEN e[1] = 'L' THEN e[2:] || a ELSE a || e[2:] END)) AS folded_root
  FROM l JOIN subroots s ON s.tree = l.tree LEFT JOIN proofs p ON p.tree = l.tree AND p.idx = l.idx
)
SELECT *, folded_root = root AS verified FROM f
"""

ORACLES = {
    "op11_merkle_manifest": MERKLE_SQL,
    "op2_warc_packages": WARC_SQL,
    "op3_exact_dedup": EXACT_SQL,
    "op4_secret_scan": secrets_sql(),
    "op9_line_dedup": LINES_SQL,
}
