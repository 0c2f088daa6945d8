"""The operators of this subpackage over their whole tables, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from sheetspark.llm.byte_bpe import decode, digests, encode
from sheetspark.llm.collocations import collocations
from sheetspark.llm.common import read_table
from sheetspark.llm.decontaminate import contamination
from sheetspark.llm.language import identify_language, labelled_windows, train
from sheetspark.llm.license_scan import find_licenses
from sheetspark.llm.line_dedup import deduplicate_lines
from sheetspark.llm.manifest import manifest
from sheetspark.llm.near_duplicates import near_duplicates
from sheetspark.llm.neighbours import nearest_neighbours
from sheetspark.llm.packing import pack
from sheetspark.llm.secret_scan import find_secrets
from sheetspark.llm.tokens import count_tokens
from sheetspark.llm.warc import rewritten
from sheetspark.llm.words import LOWER, UPPER
from sheetspark.plans.registry import Query
from sheetspark.runtime import fresh_path

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


@query
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return count_tokens(read_table(spark, sf_dir, "documents"), model)


@query
def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(read_table(spark, sf_dir, "documents"))


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = read_table(spark, sf_dir, "documents")
    return identify_language(documents, train(labelled_windows(documents)))


@query
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read_table(spark, sf_dir, "documents"), shingle=3, percent=85)

ORACLE["op8_minhash_near_dedup"] = f"""
WITH RECURSIVE words AS (
    SELECT doc_id, regexp_extract_all(
        translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), shingles AS (
    SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS i
          FROM words WHERE len(w) > 0)
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
    FROM shingles a JOIN shingles b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
    SELECT x, y FROM pairs JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
    WHERE 100 * k >= 85 * (a.n + b.n - k)
), reached AS (
    SELECT doc_id AS x, doc_id AS y FROM documents
    UNION
    SELECT reached.x, links.y FROM reached JOIN links ON reached.y = links.x
), least AS (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM least LEFT JOIN sizes USING (doc_id)
"""


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(
        read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")
    )


_WORDS = f"""regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
        '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

ORACLE["op7_decontamination"] = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
item_windows AS (
    SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
          FROM (SELECT *, least(10, len(w)) AS n FROM b) WHERE n > 0)
), lengths AS (SELECT DISTINCT n FROM item_windows),
windows AS (
    SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS g
    FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths
          WHERE len(w) >= n)
), hits AS (SELECT doc_id, i, n, item_id FROM windows JOIN item_windows USING (n, g)),
covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hits) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items,
           sha256(string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR)) AS items_sha256
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items,
       coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""


@query
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicate_lines(read_table(spark, sf_dir, "documents"))


ORACLE["op1_line_dedup"] = r"""
WITH l AS (
    SELECT doc_id, a, list_transform(a, lambda x: len(regexp_extract_all(x,
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS n
    FROM (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents WHERE text IS NOT NULL)
), places AS (
    SELECT doc_id, a, n, k, unnest(range(1, len(a) - k + 2)) AS i
    FROM l, (SELECT unnest([1, 2, 3]) AS k) WHERE len(a) >= k
), runs AS (
    SELECT doc_id, i, k, array_to_string(a[i:i + k - 1], chr(10)) AS g
    FROM places WHERE k = 3 OR list_sum(n[i:i + k - 1]) >= 50
), later AS (
    SELECT *, row_number() OVER (PARTITION BY k, g ORDER BY doc_id, i) AS r FROM runs
), gone AS (
    SELECT doc_id, list(DISTINCT p) AS ps
    FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM later WHERE r > 1) GROUP BY doc_id
)
SELECT documents.doc_id, coalesce(len(a), 0)::BIGINT AS n_lines,
       coalesce(len(ps), 0)::BIGINT AS n_removed,
       CASE WHEN ps IS NULL THEN text ELSE coalesce(array_to_string(list_transform(
           list_filter(range(1, len(a) + 1), lambda i: NOT list_contains(ps, i)), lambda i: a[i]), chr(10)),
           '') END AS text
FROM documents LEFT JOIN l USING (doc_id) LEFT JOIN gone USING (doc_id)
"""


@query
def op9_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return pack(read_table(spark, sf_dir, "documents"), path)


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_licenses(read_table(spark, sf_dir, "documents"))


@query
def op6_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rewritten(read_table(spark, sf_dir, "pages"), fresh_path(spark, "warc"))


@query
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(read_table(spark, sf_dir, "embeddings"))


@query
def op11_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ids = encode(read_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return digests(decode(ids, path))


@query
def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


ORACLE["op12_collocations"] = f"""
WITH pieces AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
    FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
              translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
          FROM documents)
), phrases AS (
    SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase, count(*) AS f
    FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i
          FROM pieces, (SELECT unnest(range(1, 6)) AS m) WHERE len(w) >= m)
    GROUP BY ALL
), sizes AS (SELECT lang, sum(f)::BIGINT AS n FROM phrases WHERE m = 1 GROUP BY lang),
candidates AS (
    SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS w
    FROM phrases WHERE m >= 2 AND f >= 100
), cuts AS (
    SELECT lang, m, phrase, a, k, l.f AS l, r.f AS r, n,
           ((1000::HUGEINT * a * n) // (l.f::HUGEINT * r.f))::BIGINT AS score
    FROM (SELECT *, unnest(range(1, m)) AS k FROM candidates) c
    JOIN sizes USING (lang)
    JOIN (SELECT lang, phrase AS lp, f FROM phrases) l USING (lang)
    JOIN (SELECT lang, phrase AS rp, f FROM phrases) r USING (lang)
    WHERE lp = array_to_string(w[1:k], ' ') AND rp = array_to_string(w[k + 1:], ' ')
), best AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), kept AS (
    SELECT * FROM best WHERE NOT EXISTS (
        SELECT 1 FROM candidates x
        WHERE x.lang = best.lang AND x.m > best.m AND x.a >= best.a
          AND contains(' ' || x.phrase || ' ', ' ' || best.phrase || ' '))
)
SELECT * FROM (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
           phrase, a, l, r, n, score
    FROM kept) WHERE rank <= 2000
"""


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest(read_table(spark, sf_dir, "documents")).drop("path")


def _field(name: str) -> str:
    return f"coalesce(octet_length(encode({name}::VARCHAR))::VARCHAR || ':' || {name}::VARCHAR, '-')"


def _leaf(chars: str) -> str:
    return "sha256(" + " || ".join(map(_field, ("doc_id", "source", "lang", chars, "text"))) + ")"


# CRC-32 bit by bit; list_reduce begins with the first item of its list.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)),
            lambda x, i: xor(x >> 1, 3988292384::BIGINT * (x & 1)))))"""

ORACLE["op13_merkle_manifest"] = f"""
WITH RECURSIVE leaves AS (
    SELECT doc_id, lang, {_leaf("n_chars")} AS leaf,
           CASE WHEN {_CRC32} % 7 = 0 THEN {_leaf("(n_chars::HUGEINT + 1)")} END AS tampered
    FROM documents
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i,
           dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
    FROM leaves
), nodes AS (
    SELECT tree, 0 AS level, i, leaf AS h FROM placed
    UNION ALL
    SELECT tree, level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i))
    FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM nodes)
    WHERE n > 1 GROUP BY tree, level, i // 2
), subroots AS (SELECT tree, arg_max(h, level) AS subroot, max(level) AS height FROM nodes GROUP BY tree),
tops AS (
    SELECT 0 AS level, tree AS i, subroot AS h FROM subroots
    UNION ALL
    SELECT level + 1, i // 2, sha256(string_agg(h, '' ORDER BY i))
    FROM (SELECT *, count(*) OVER () AS n FROM tops) WHERE n > 1 GROUP BY level, i // 2
), steps AS (
    SELECT doc_id, leaf, tree, level, (i >> level) AS spot
    FROM (SELECT *, unnest(range(height)) AS level FROM placed JOIN subroots USING (tree))
), top_steps AS (
    SELECT doc_id, leaf, (tree >> level) AS spot, level, height FROM (
        SELECT *, unnest(range((SELECT max(level) FROM tops))) AS level
        FROM placed JOIN subroots USING (tree))
), siblings AS (
    SELECT steps.doc_id, steps.leaf, steps.level AS k, spot, coalesce(h, '') AS h
    FROM steps LEFT JOIN nodes n
      ON n.tree = steps.tree AND n.level = steps.level AND n.i = xor(spot, 1)
    UNION ALL
    SELECT s.doc_id, s.leaf, s.height + s.level, spot, coalesce(h, '')
    FROM top_steps s LEFT JOIN tops t ON t.level = s.level AND t.i = xor(spot, 1)
), paths AS (
    SELECT doc_id, leaf, string_agg(h, '' ORDER BY k) AS joined,
           list({{'h': h, 'left': spot % 2 = 1}} ORDER BY k) AS path
    FROM siblings GROUP BY doc_id, leaf
), folds AS (
    SELECT doc_id, leaf, coalesce(tampered, leaf) AS node, path, joined, 1 AS k, tree
    FROM placed LEFT JOIN paths USING (doc_id, leaf)
    UNION ALL
    SELECT doc_id, leaf, sha256(CASE WHEN path[k].left THEN path[k].h || node ELSE node || path[k].h END),
           path, joined, k + 1, tree
    FROM folds WHERE k <= len(path)
)
SELECT doc_id, leaf, subroot, root, sha256(coalesce(joined, '')) AS proof_sha256,
       node AS folded_root, node = root AS verified
FROM folds JOIN subroots USING (tree), (SELECT arg_max(h, level) AS root FROM tops)
WHERE k = coalesce(len(path), 0) + 1
"""
