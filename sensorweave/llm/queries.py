"""Registered queries of the text operators, with DuckDB SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.llm import (byte_bpe, fill_in_middle, fingerprints, language, line_dedup, near_dedup, packing, pii, piece_lattice, quality_rules, sharding,
                             token_counts, vector_codes)
from sensorweave.llm.common import read_table, stored

#: Shards of the registered sharding query.
SHARDS = tuple(f"shard-{i:04d}" for i in range(256))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(read_table(spark, sf_dir, "documents"))


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the base kinds, digest of the base spans, all spans, and counts of the added kinds."""
    found = pii.find_pii(read_table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.BASE_KINDS))
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *[count(k) for k in pii.BASE_KINDS],
                        F.sha2(pii.digest(base).cast("binary"), 256).alias("base_sha256"), pii.digest(F.col("spans")).alias("spans"),
                        *[count(k) for k in pii.ADDED_KINDS])


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rules = quality_rules.learn_rules(docs, read_table(spark, sf_dir, "labels"))
    return quality_rules.judge(docs, rules).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return language.predict(docs.drop("lang"), language.fit(docs))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


def op6_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The library's encoding and the three best segmentations of every text:
    sizes, scores, checksums, round trips."""
    found = piece_lattice.summarise_nbest(read_table(spark, sf_dir, "documents"), n=3)
    return found.select("doc_id", "n_tokens", "encoded_crc32", "n_pieces", F.element_at("scores", 1).alias("best_score"),
                        *[F.get("scores", i).alias(f"score_{i + 1}") for i in (1, 2)],
                        *[F.get("ids_crc32", i).alias(f"ids_crc32_{i + 1}") for i in range(3)], "round_trip")


def op7_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text; for ids divisible by 50
    also the other rows within ``fingerprints.RADIUS`` bits: their number, and
    their fingerprints with distance, smallest doc_id and number of rows."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = stored(fingerprints.edited_pairs(docs), "fingerprints")
    return fingerprints.near_lists(marked, F.col("doc_id") % 50 == 0)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What stays of every text, and the runs of lines deleted (from-to, comma-joined)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = F.transform("runs", lambda r: F.concat_ws("-", r["first_line"], r["last_line"]))
    return line_dedup.dedup_lines(docs).select(
        "row.doc_id", "n_lines", "n_deleted", F.coalesce(F.array_join(spans, ","), F.lit("")).alias("deleted_runs"), "text")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard of every document, by its id (by its text where the id is null)."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "n_chars", "text")
    table = sharding.table_frame(spark, SHARDS)
    return sharding.assign_shards(docs, table, ["doc_id"], fallback=["text"]).select(
        "doc_id", "source", "lang", F.octet_length("text").cast("long").alias("n_bytes"), "slot", "shard")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes and errors of all usable vectors, errors by label, and a digest of the codebooks."""
    rows, books = vector_codes.compress(read_table(spark, sf_dir, "embeddings"))
    return rows.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def _sha256(column) -> Column:
    return F.sha2(column.cast("binary"), 256)


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every text is cut, digests of the rearranged text and of the one rebuilt from it."""
    done = fill_in_middle.rearrange(read_table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", _sha256(F.col("output")).alias("output_sha256"),
                       _sha256(fill_in_middle.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every text's ids, and a digest of the bytes they decode to."""
    coded = byte_bpe.encode_documents(read_table(spark, sf_dir, "documents"), decode=True)
    ids = F.array_join(F.col("ids").cast("array<string>"), ",")
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), _sha256(ids).alias("ids_sha256"),
                        _sha256(F.col("decoded")).alias("decoded_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_pii": op2_pii,
    "op3_quality_rules": op3_quality_rules,
    "op4_language": op4_language,
    "op5_near_dedup": op5_near_dedup,
    "op6_piece_lattice": op6_piece_lattice,
    "op7_fingerprints": op7_fingerprints,
    "op8_line_dedup": op8_line_dedup,
    "op9_packing": op9_packing,
    "op10_sharding": op10_sharding,
    "op11_vector_codes": op11_vector_codes,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_byte_bpe": op13_byte_bpe,
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = r"'[^\x20\x09-\x0D]+'"

#: All pairs of different shingle sets by their common shingles, then everything reachable.
_NEAR_DEDUP = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_UPPER.lower()}'), {_WORDS}) AS words FROM documents),
g AS (SELECT doc_id, list_distinct(CASE WHEN len(words) >= 5 THEN list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
             WHEN len(words) > 0 THEN [array_to_string(words, ' ')] ELSE [] END) AS grams FROM w),
c AS (SELECT doc_id, len(grams) AS n, list_sort(grams) AS grams, min(doc_id) OVER (PARTITION BY list_sort(grams)) AS lead FROM g),
s AS (SELECT doc_id, n, unnest(grams) AS gram FROM c WHERE doc_id = lead),
p AS (SELECT a.doc_id AS u, b.doc_id AS v FROM s a JOIN s b ON a.gram = b.gram AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
r AS (SELECT DISTINCT u AS node, u AS seen FROM p UNION SELECT r.node, p.v FROM r JOIN p ON p.u = r.seen),
m AS (SELECT node, min(seen) AS comp FROM r GROUP BY node)
SELECT c.doc_id, CAST(c.n AS BIGINT) AS n_shingles,
       CASE WHEN c.n = 0 THEN c.doc_id ELSE coalesce(m.comp, c.lead) END AS component_id,
       c.doc_id = CASE WHEN c.n = 0 THEN c.doc_id ELSE coalesce(m.comp, c.lead) END AS kept
FROM c LEFT JOIN m ON m.node = c.lead"""

#: Every shortest stretch of 50 words from a line and up to a line, by its content.
_LINE_DEDUP = f"""
WITH t AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM documents),
a AS (SELECT doc_id, unnest(range(0, len(lines))) AS line_no, unnest(lines) AS line FROM t),
w AS (SELECT *, len(regexp_extract_all(line, {_WORDS})) AS words FROM a),
l AS (SELECT *, row_number() OVER d AS pos, sum(words) OVER d AS upto, sum(words) OVER d - words AS before
      FROM w WHERE words > 0 WINDOW d AS (PARTITION BY doc_id ORDER BY line_no)),
x AS (SELECT s.doc_id, s.pos AS b, min(e.pos) AS e FROM l s JOIN l e ON e.doc_id = s.doc_id AND e.upto >= s.before + 50 AND e.pos >= s.pos GROUP BY s.doc_id, s.pos
      UNION SELECT e.doc_id, max(s.pos), e.pos FROM l e JOIN l s ON s.doc_id = e.doc_id AND s.before <= e.upto - 50 AND s.pos <= e.pos GROUP BY e.doc_id, e.pos),
k AS (SELECT x.doc_id, x.b, min(line_no) AS lo, max(line_no) AS hi, list(line ORDER BY pos) AS content
      FROM x JOIN l ON l.doc_id = x.doc_id AND l.pos BETWEEN x.b AND x.e GROUP BY x.doc_id, x.b, x.e),
f AS (SELECT *, first_value(doc_id) OVER c AS fd, first_value(b) OVER c AS fb FROM k WINDOW c AS (PARTITION BY content ORDER BY doc_id, b)),
z AS (SELECT DISTINCT a.doc_id, a.line_no FROM a JOIN f ON f.doc_id = a.doc_id AND a.line_no BETWEEN f.lo AND f.hi WHERE f.doc_id <> f.fd OR f.b <> f.fb),
i AS (SELECT doc_id, min(line_no) AS lo, max(line_no) AS hi FROM (
        SELECT *, line_no - row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS isle FROM z) GROUP BY doc_id, isle),
q AS (SELECT doc_id, string_agg(CAST(lo AS VARCHAR) || '-' || CAST(hi AS VARCHAR), ',' ORDER BY lo) AS runs, CAST(sum(hi - lo + 1) AS BIGINT) AS gone FROM i GROUP BY doc_id),
y AS (SELECT a.doc_id, string_agg(a.line, chr(10) ORDER BY a.line_no) AS text FROM a ANTI JOIN z ON z.doc_id = a.doc_id AND z.line_no = a.line_no GROUP BY a.doc_id)
SELECT t.doc_id, CAST(len(t.lines) AS BIGINT) AS n_lines, coalesce(q.gone, 0) AS n_deleted, coalesce(q.runs, '') AS deleted_runs, coalesce(y.text, '') AS text
FROM t LEFT JOIN q ON q.doc_id = t.doc_id LEFT JOIN y ON y.doc_id = t.doc_id"""


def _vector_codes_sql() -> str:
    """Rounds of comparing every part with every entry, one after the other."""
    rounds = []
    for i in range(vector_codes.ROUNDS + 1):
        rounds.append(f"""a{i} AS MATERIALIZED (
  SELECT rid, k, min_by(e, d * 1024 + e) AS e, min(d) AS d FROM (
    SELECT p.rid, p.k, c.e, list_sum(list_transform(range(1, len(p.x) + 1), lambda j: (p.x[j] - c.x[j]) * (p.x[j] - c.x[j]))) AS d
    FROM p JOIN c{i} c ON c.k = p.k) GROUP BY rid, k)""")
        if i < vector_codes.ROUNDS:
            rounds.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.k, c.e, coalesce(m.x, c.x) AS x FROM c{i} c LEFT JOIN (
    SELECT k, e, list(CAST(floor(s::DOUBLE / n) AS BIGINT) ORDER BY j) AS x FROM (
      SELECT a.k, a.e, j, sum(p.x[j]) AS s, count(*) AS n FROM a{i} a JOIN p ON p.rid = a.rid AND p.k = a.k, range(1, (SELECT max(len(x)) FROM p) + 1) t(j)
      GROUP BY a.k, a.e, j) GROUP BY k, e) m ON m.k = c.k AND m.e = c.e)""")
    last, parts = vector_codes.ROUNDS, vector_codes.PARTS
    return f"""
WITH v AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS rid, vec_id, label, len(embedding) // {parts} AS w,
         list_transform(embedding, lambda x: CAST(floor({vector_codes.SCALE}::DOUBLE * x) AS BIGINT)) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS MATERIALIZED (SELECT rid, k, x[k * w + 1 : (k + 1) * w] AS x FROM v, range({parts}) t(k)),
c0 AS MATERIALIZED (SELECT k, rid - 1 AS e, x FROM p WHERE rid <= {vector_codes.ENTRIES}),
{", ".join(rounds)},
h AS (SELECT sha256(string_agg(CAST(v AS VARCHAR), ',' ORDER BY k, e, j)) AS digest FROM (
        SELECT k, e, unnest(x) AS v, generate_subscripts(x, 1) AS j FROM c{last})),
r AS (SELECT rid, string_agg(printf('%02x', e), '' ORDER BY k) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{last} GROUP BY rid)
SELECT v.vec_id, r.code, r.error, CAST(sum(r.error) OVER (PARTITION BY v.label) AS BIGINT) AS label_error, h.digest AS codebooks_sha256
FROM v JOIN r ON r.rid = v.rid, h"""


#: Units are taken one after the other; their lengths up to a cut are added up.
_FILL_IN_MIDDLE = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT doc_id, text, regexp_extract_all(text, '[^\n]*\n|[^\n]+') AS units,
             CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM t),
c AS (SELECT *, least(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS lo, greatest(h1 % (len(units) + 1), h2 % (len(units) + 1)) AS hi FROM u),
f AS (SELECT *, array_to_string(units[1:lo], '') AS p, array_to_string(units[lo + 1:hi], '') AS m, array_to_string(units[hi + 1:], '') AS s,
             CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 100 THEN 'plain'
                  WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM c)
SELECT doc_id, CAST(len(units) AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM f"""

#: The others need a tokenizer, a learned model, positions of matches or turn-taking.
ORACLE: dict[str, str] = {"op5_near_dedup": _NEAR_DEDUP, "op8_line_dedup": _LINE_DEDUP, "op11_vector_codes": _vector_codes_sql(),
                          "op12_fill_in_middle": _FILL_IN_MIDDLE}
