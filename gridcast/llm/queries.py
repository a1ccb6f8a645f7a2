"""The catalogue of the operators' queries and, where SQL can state them, their equivalents for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from gridcast.llm import (
    alignment, bpe, exact_dedup, extract, language, lines, merkle, minhash, mixing, neighbours, packing, substrings, warc,
)
from gridcast.llm.tables import stage, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


#: A-Z as a-z, nothing else; null is empty.
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@query
def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens along the Hilbert curve."""
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, with_ids=False)


@query
def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The decision on every document: MSD radix groups of equal texts, the largest doc_id stays."""
    found = exact_dedup.equal_groups(table(spark, sf_dir, "documents"), carried=["doc_id"])
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
                        "text_sha256")


SQL["op2_exact_dedup"] = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER same AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, {LOWER} AS t FROM documents)
WINDOW same AS (PARTITION BY t)"""


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as its capture reads after a round trip through WARC archives."""
    captures = warc.archive(table(spark, sf_dir, "pages"))
    rows = captures.select(
        F.regexp_extract(F.decode("metadata.block", "UTF-8"), r"pageId: ([^\r\n]*)", 1).try_cast("long").alias("page_id"),
        # A response tells by its payload, a revisit, which has none, by its headers.
        F.coalesce("response.measured_bytes", F.regexp_extract(
            F.substring(F.col("response.block").cast("string"), 1, 300), r"(?i)\r\ncontent-length: *(\d+)", 1).cast("long")).alias("payload_bytes"),
        F.regexp_replace(F.coalesce("response.measured_digest", "response.payload_digest"), "^sha1:", "").alias("payload_digest"),
        F.col("response.type").alias("record_type"))
    rows = stage(rows, "captures")
    held = rows.where("record_type = 'response'").groupBy("payload_digest", "payload_bytes").agg(F.max("page_id").alias("held_by"))
    return rows.join(stage(held, "held").hint("merge"), ["payload_digest", "payload_bytes"], "left").select(
        "page_id", "payload_bytes", "payload_digest", "record_type",
        F.when(F.col("record_type") == "revisit", F.col("held_by")).alias("refers_to"))


SQL["op3_warc"] = """
SELECT page_id, strlen(t) AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1 + ((
         CAST('0x' || substr(sha1(t), CAST(5 * (i // 4) + 1 AS BIGINT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = max(page_id) OVER same THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> max(page_id) OVER same THEN max(page_id) OVER same END AS refers_to
FROM (SELECT page_id, coalesce(html, '') AS t FROM pages)
WINDOW same AS (PARTITION BY t)"""


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of at least 50 words that an earlier document holds too: spans of words in both."""
    found = substrings.repeats(table(spark, sf_dir, "documents"))
    return found.withColumnsRenamed({"doc": "doc_id", "holder": "holder_id"})


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The predicted language of every document."""
    docs = table(spark, sf_dir, "documents")
    model = language.train(docs.where(language.learnable()))
    found = language.identify(docs, model, carried=["doc_id"])
    return found.select(F.col("row.doc_id").alias("doc_id"),
                        F.coalesce(F.crc32(F.col("row.doc_id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"),
                        "lang_pred", "score", "accepted")


@query
def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every document's token ids, and digest of the text decoded from them."""
    return bpe.round_trip(table(spark, sf_dir, "documents"), TOKENIZER).withColumnRenamed("id", "doc_id")


@query
def op7_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page by its host's consensus path."""
    found = extract.main_texts(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


@query
def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest vectors of every row whose id is divisible by 20."""
    rows = stage(neighbours.usable(table(spark, sf_dir, "embeddings")), "vectors")
    return neighbours.nearest(rows.where("id % 20 = 0"), rows)


SQL["op8_neighbours"] = """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0
             AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
             AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
          FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 20"""


@query
def op9_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of at least 0.75 between sets of five-word shingles."""
    found = minhash.near_groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id",
                        F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


SQL["op9_minhash_dedup"] = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM words),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b USING (s)
           WHERE a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
          WHERE 100 * c >= 75 * (p.n + q.n - c)),
reach AS (SELECT doc_id AS x, doc_id AS y FROM documents
          UNION SELECT r.x, l.y FROM reach r JOIN links l ON l.x = r.y)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, m.component_id, d.doc_id = m.component_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x) m USING (doc_id)"""


@query
def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every document, those dropped as recurring templates, and the digest of the text that is left."""
    found = lines.without_templates(table(spark, sf_dir, "documents"), carried=["doc_id"])
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


SQL["op10_line_dedup"] = r"""
WITH rows AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
split AS (SELECT t, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS n
          FROM (SELECT DISTINCT t FROM rows WHERE t <> '')),
tokens AS (SELECT t, n, list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'),
                                       lambda x: CASE WHEN regexp_matches(x, '[0-9@]|://') THEN '<*>' ELSE x END) AS k FROM split),
keyed AS (SELECT t, n, k, len(k) AS size, array_to_string(k[1:3], ' ') AS head FROM tokens WHERE len(k) > 0),
leaves AS (SELECT size, head FROM keyed GROUP BY size, head HAVING count(DISTINCT t) >= 5),
cells AS (SELECT t, n, size, head, unnest(k) AS token, generate_subscripts(k, 1) AS place FROM keyed JOIN leaves USING (size, head)),
constants AS (SELECT size, head, place, token FROM cells WHERE token <> '<*>' GROUP BY ALL HAVING count(DISTINCT t) >= 5),
templates AS (SELECT t, n, string_agg(CASE WHEN c.token IS NULL THEN '<*>' ELSE x.token END, ' ' ORDER BY x.place) AS template
              FROM cells x LEFT JOIN constants c ON x.size = c.size AND x.head = c.head AND x.place = c.place AND x.token = c.token
              GROUP BY t, n, x.size HAVING count(c.token) >= 0.6 * x.size),
often AS (SELECT template FROM templates GROUP BY template HAVING count(DISTINCT t) >= 5),
gone AS (SELECT t, n FROM templates JOIN often USING (template)),
kept AS (SELECT s.t, count(*) AS n_lines, count(g.n) AS n_dropped,
                coalesce(string_agg(s.line, chr(10) ORDER BY s.n) FILTER (WHERE g.n IS NULL), '') AS left_over
         FROM split s LEFT JOIN gone g ON s.t = g.t AND s.n = g.n GROUP BY s.t)
SELECT doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_dropped, 0) AS n_dropped, sha256(coalesce(left_over, '')) AS text_sha256
FROM rows LEFT JOIN kept ON rows.t = kept.t"""


@query
def op11_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix of all sources takes of every document."""
    found = mixing.plan(table(spark, sf_dir, "documents"), carried=["doc_id"])
    return found.select("row.doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


SQL["op11_mixing"] = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size FROM documents),
weighted AS (SELECT source, sum(size) AS size, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)] AS w
             FROM d GROUP BY source),
summed AS (SELECT *, sum(size) OVER () AS total, sum(size) OVER onward AS size_left, sum(w) OVER onward AS w_left FROM weighted
           WINDOW onward AS (ORDER BY size * (10 // w), source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
filled AS (SELECT *, 3 * size * w_left <= w * (total - 3 * (total - size_left)) AS full_up FROM summed),
targets AS (SELECT source, CAST(size AS BIGINT) AS source_size, CASE WHEN full_up THEN CAST(3 * size AS DOUBLE)
              ELSE CAST(total - coalesce(sum(3 * size) FILTER (WHERE full_up) OVER (), 0) AS DOUBLE) * w
                   / CAST(sum(w) FILTER (WHERE NOT full_up) OVER () AS DOUBLE) END AS target FROM filled),
rated AS (SELECT *, CASE WHEN source_size = 0 THEN 0.0::DOUBLE ELSE target / source_size END AS rate FROM targets),
drawn AS (SELECT d.source, doc_id, size, unnest(range(32)) AS seed FROM d),
copied AS (SELECT drawn.*, CAST(floor(rate) AS BIGINT) + CAST(CAST(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || '|' || size
             || '|' || seed), 1, 12) AS BIGINT) AS DOUBLE) / 281474976710656 < rate - floor(rate) AS BIGINT) AS copies, source_size, target
           FROM drawn JOIN rated ON drawn.source IS NOT DISTINCT FROM rated.source),
seeded AS (SELECT source, seed, abs(CAST(sum(size * copies) AS DOUBLE) - any_value(target)) AS off FROM copied GROUP BY source, seed),
chosen AS (SELECT source, seed FROM seeded QUALIFY row_number() OVER (PARTITION BY source ORDER BY off, seed) = 1)
SELECT doc_id, size, source_size, target, size * copies AS taken
FROM copied JOIN chosen ON copied.source IS NOT DISTINCT FROM chosen.source AND copied.seed = chosen.seed"""


def _lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@query
def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, and what its root becomes if a third of the texts are lower-cased afterwards."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(docs["doc_id"].cast("string")) % 3 == 0
    claimed = F.when(tampered, merkle.leaf([_lowered(docs[c]) if c == "text" else docs[c] for c in merkle.FIELDS]))
    return merkle.manifest(docs, claimed).withColumnRenamed("id", "doc_id")


def _manifest_sql(group_levels: int = 7, upper_levels: int = 3) -> str:
    """Trees level by level, for up to 8 ** levels leaves."""
    def field(x: str) -> str:
        return f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || CAST({x} AS VARCHAR), '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(text if c == "text" else c) for c in merkle.FIELDS) + ")"

    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = ("xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), "
           "lambda c: CAST(ascii(c) AS BIGINT))), lambda s, b: list_reduce(list_prepend(xor(s, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), "
           "lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)")
    steps = [f"d AS (SELECT doc_id, coalesce('=' || lang, '') AS tree, {leaf('text')} AS leaf, "
             f"CASE WHEN {crc} % 3 = 0 THEN {leaf(low)} END AS claimed FROM documents)",
             "p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, "
             "count(*) OVER (PARTITION BY tree) AS n FROM d)",
             "a0 AS (SELECT tree, place AS spot, n, leaf AS h FROM p)"]

    def climb(name: str, levels: int) -> str:
        for i in range(levels):
            steps.append(f"{name}run{i} AS (SELECT tree, spot // 8 AS up, any_value(n) AS n, list(h ORDER BY spot) AS run FROM {name}{i} "
                         "WHERE n > 1 GROUP BY tree, spot // 8)")
            steps.append(f"{name}{i + 1} AS (SELECT tree, up AS spot, (n + 7) // 8 AS n, sha256(array_to_string(run, '')) AS h FROM {name}run{i})")
        return " UNION ALL ".join(f"SELECT tree, h FROM {name}{i} WHERE n = 1" for i in range(levels + 1))

    steps.append(f"subroots AS ({climb('a', group_levels)})")
    steps.append("b0 AS (SELECT '' AS tree, row_number() OVER (ORDER BY s.tree) - 1 AS spot, count(*) OVER () AS n, h, s.tree AS lang_tree FROM subroots s)")
    steps.append(f"roots AS ({climb('b', upper_levels)})")
    steps.append("f0 AS (SELECT p.*, b0.spot AS lang_place, coalesce(claimed, leaf) AS cur, '' AS siblings FROM p JOIN b0 ON lang_tree = p.tree)")
    at = 0
    for name, levels, tree, place in (("a", group_levels, "f.tree", "place"), ("b", upper_levels, "''", "lang_place")):
        for i in range(levels):
            k = f"CAST(({place} >> {3 * i}) & 7 AS BIGINT)"
            before, after = f"array_to_string(run[1:{k}], '')", f"array_to_string(run[{k} + 2:], '')"
            steps.append(f"f{at + 1} AS (SELECT f.doc_id, f.tree, leaf, place, lang_place, CASE WHEN run IS NULL THEN cur ELSE "
                         f"sha256({before} || cur || {after}) END AS cur, siblings || coalesce({before} || {after}, '') AS siblings "
                         f"FROM f{at} f LEFT JOIN {name}run{i} r ON r.tree = {tree} AND r.up = f.{place} >> {3 * (i + 1)})")
            at += 1
    return "WITH " + ",\n".join(steps) + f"""
SELECT doc_id, leaf, s.h AS subroot, r.h AS root, sha256(siblings) AS proof_sha256, cur AS folded_root, cur = r.h AS verified
FROM f{at} f JOIN subroots s ON s.tree = f.tree, roots r"""


SQL["op12_manifest"] = _manifest_sql()


@query
def op13_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers in every document."""
    return alignment.aligned(table(spark, sf_dir, "documents"), TOKENIZER, PIECES).withColumnRenamed("id", "doc_id")
