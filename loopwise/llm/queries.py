"""The registered queries of this subpackage: thin calls of the operators on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality_rules

    return quality_rules(_table(spark, sf_dir, "documents")).drop("covered_words", "longest_repeat", "n_maximal_repeats")


def op2_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import simhash_components

    return simhash_components(_table(spark, sf_dir, "documents"))


def op3_relative_lempel_ziv(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substrings import rlz_dedup

    return rlz_dedup(_table(spark, sf_dir, "documents")).drop("n_factors", "longest_factor")


def op4_factorisation_machine(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .classifier import quality_scores

    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substrings import suffix_dedup

    return suffix_dedup(_table(spark, sf_dir, "documents"))


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan_licenses

    return scan_licenses(_table(spark, sf_dir, "documents"))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(_table(spark, sf_dir, "documents"))


def op8_soft_membership_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .mixing import label_domains, mixing_rates

    return mixing_rates(_table(spark, sf_dir, "documents"), label_domains(_table(spark, sf_dir, "labels")))


def op9_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .neighbours import nearest

    return nearest(_table(spark, sf_dir, "embeddings"))


def op10_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import scan_secrets

    return scan_secrets(_table(spark, sf_dir, "documents"))


def op11_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pages import extract_articles

    return extract_articles(_table(spark, sf_dir, "pages"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .codes import vector_codes

    return vector_codes(_table(spark, sf_dir, "embeddings"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whitened_embeddings

    return whitened_embeddings(_table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {f.__name__: f for f in (op1_quality_rules, op2_simhash_near_dedup, op3_relative_lempel_ziv, op4_factorisation_machine, op5_suffix_array_dedup, op6_license_scans, op7_best_fit_packing, op8_soft_membership_mixing, op9_nearest_neighbours, op10_secret_scans, op11_html_extraction, op12_vector_codes, op13_embedding_whitening)}


_DOCS = r"docs AS MATERIALIZED (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)"
_OVER = "OVER (PARTITION BY doc_id ORDER BY i)"


def _doubled(upto: int) -> str:
    """Relations h1, h2, h4 ... with one row for each word and hashes of the 1, 2, 4 ... words from it on."""
    out, k = ["h1 AS (SELECT *, hash(word) AS h1 FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i, len(w) AS n FROM docs))"], 1
    while 2 * k <= upto:
        out.append(f"h{2 * k} AS (SELECT *, hash(h{k}, lead(h{k}, {k}) {_OVER}) AS h{2 * k} FROM h{k})")
        k *= 2
    return ",\n".join(out)


_QUALITY = rf"""WITH {_DOCS},
{_doubled(64)},
grams AS MATERIALIZED (SELECT doc_id, i, n, hash(h4, lead(h1, 4) {_OVER}) AS g5, hash(h16, lead(h4, 16) {_OVER}) AS g20, hash(h64, lead(h32, 64) {_OVER}, lead(h4, 96) {_OVER}, lead(h1, 100) {_OVER}) AS g101 FROM h64),
five AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g5) AS c FROM grams WHERE i <= n - 4),
rep AS (SELECT doc_id, count(DISTINCT j) AS n_rep FROM (SELECT doc_id, unnest(range(i, i + 5)) AS j FROM five WHERE c > 1) GROUP BY doc_id),
twenty AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g20) AS c FROM grams WHERE i <= n - 19),
cover AS (SELECT doc_id, count(DISTINCT j) AS n_cover FROM (SELECT doc_id, unnest(range(i, i + 20)) AS j FROM twenty WHERE c > 1) GROUP BY doc_id),
long_ AS (SELECT DISTINCT doc_id FROM (SELECT doc_id FROM grams WHERE i <= n - 100 GROUP BY doc_id, g101 HAVING count(*) > 1)),
line AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM docs),
dup AS (SELECT doc_id, count(*) - count(DISTINCT x) AS n_dup FROM line WHERE regexp_matches(x, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (SELECT s.doc_id, len(w) AS n_words, cast(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS bigint) AS word_chars,
  length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup, 0) AS n_dup_lines, coalesce(n_rep, 0) AS n_repeat_words,
  l.doc_id IS NOT NULL OR coalesce(n_cover, 0) > 0.1 * len(w) AS repeats
  FROM docs s LEFT JOIN rep r ON r.doc_id = s.doc_id LEFT JOIN long_ l ON l.doc_id = s.doc_id LEFT JOIN cover c ON c.doc_id = s.doc_id LEFT JOIN dup d ON d.doc_id = s.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT repeats AS kept FROM base"""

_WORDS = rf"""WITH {_DOCS},
{_doubled(32)},
grams AS MATERIALIZED (SELECT doc_id, i, n, word, hash(h32, lead(h16, 32) {_OVER}, lead(h2, 48) {_OVER}) AS g50 FROM h32),
win AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g50) AS first FROM grams WHERE i <= n - 49),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM win WHERE first < doc_id),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS kept, count(*) AS n FROM grams ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id"""

_BYTES = r"""WITH h AS MATERIALIZED (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
part AS MATERIALIZED (SELECT doc_id, 1000 * k AS base, substr(x, 2000 * k + 1, 2198) AS x FROM h, unnest(range(0, length(x) // 2000 + 1)) AS u(k)),
win AS MATERIALIZED (SELECT doc_id, base + i AS s, md5_number(substr(x, 2 * i + 1, 200)) AS w FROM part, unnest(range(0, least(1000, length(x) // 2 - 99))) AS u(i)),
late AS MATERIALIZED (SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY w ORDER BY doc_id, s) AS n FROM win) WHERE n > 1),
run AS (SELECT doc_id, s, sum(first) OVER (PARTITION BY doc_id ORDER BY s) AS g FROM (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100 THEN 0 ELSE 1 END AS first FROM late)),
gone AS MATERIALIZED (SELECT doc_id, g, min(s) AS a, max(s) + 100 AS b FROM run GROUP BY doc_id, g),
keep AS (SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM gone UNION ALL SELECT doc_id, max(b), 1000000000 FROM gone GROUP BY doc_id),
kept AS (SELECT k.doc_id, string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS x FROM keep k JOIN h USING (doc_id) GROUP BY k.doc_id),
n AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans FROM gone GROUP BY doc_id)
SELECT doc_id, cast(length(h.x) // 2 AS bigint) AS n_bytes, cast(coalesce(n_removed, 0) AS bigint) AS n_removed, cast(coalesce(n_spans, 0) AS bigint) AS n_spans, sha256(unhex(coalesce(kept.x, h.x))) AS kept_sha256
FROM h LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""



def _codes_sql(rounds: int = 4, parts: int = 4, entries: int = 256) -> str:
    """Product codes: whole numbers as doubles, whose inner products are exact."""
    cut = [f"v[{p} * len(v) // {parts} + 1:{p + 1} * len(v) // {parts}]" for p in range(parts)]
    steps = [
        f"""x AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda c: floor(1024 * cast(c AS double))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0)""",
        "part AS MATERIALIZED (" + " UNION ALL ".join(f"SELECT vec_id, label, {p} AS p, {cut[p]} AS v FROM x" for p in range(parts)) + ")",
        f"book0 AS MATERIALIZED (SELECT p, n - 1 AS k, v FROM (SELECT *, row_number() OVER (PARTITION BY p ORDER BY vec_id) AS n FROM part) WHERE n <= {entries})",
    ]
    near = "SELECT vec_id, a.p, k, a.v, list_inner_product(a.v, a.v) - 2 * list_inner_product(a.v, b.v) + list_inner_product(b.v, b.v) AS d FROM part a JOIN book{r} b ON a.p = b.p"
    first = "SELECT vec_id, p, any_value(v) AS v, min(k) AS k, min(d) AS d FROM (SELECT *, min(d) OVER (PARTITION BY vec_id, p) AS best FROM (" + near + ")) WHERE d = best GROUP BY vec_id, p"
    for r in range(rounds):
        steps.append(f"near{r} AS MATERIALIZED ({first.format(r=r)})")
        steps.append(f"mean{r} AS (SELECT p, k, list(m ORDER BY i) AS v FROM (SELECT p, k, i, floor(sum(c) / count(*)) AS m FROM (SELECT p, k, unnest(v) AS c, generate_subscripts(v, 1) AS i FROM near{r}) GROUP BY p, k, i) GROUP BY p, k)")
        steps.append(f"book{r + 1} AS MATERIALIZED (SELECT b.p, b.k, coalesce(m.v, b.v) AS v FROM book{r} b LEFT JOIN mean{r} m ON m.p = b.p AND m.k = b.k)")
    steps.append(f"last AS MATERIALIZED ({first.format(r=rounds)})")
    steps.append(f"sha AS (SELECT sha256(string_agg(cast(cast(c AS bigint) AS varchar), ',' ORDER BY p, k, i)) AS codebooks_sha256 FROM (SELECT p, k, unnest(v) AS c, generate_subscripts(v, 1) AS i FROM book{rounds}))")
    steps.append("code AS (SELECT vec_id, string_agg(format('{:02x}', k), '' ORDER BY p) AS code, cast(sum(d) AS bigint) AS error FROM last GROUP BY vec_id)")
    return "WITH " + ",\n".join(steps) + "\nSELECT vec_id, code, error, cast(sum(error) OVER (PARTITION BY label) AS bigint) AS label_error, codebooks_sha256 FROM code JOIN x USING (vec_id), sha"


def oracle_sql() -> dict[str, str]:
    """SQL for those whose results it can express; the others are held against brute force in the tests."""
    return {"op1_quality_rules": _QUALITY, "op3_relative_lempel_ziv": _WORDS, "op5_suffix_array_dedup": _BYTES, "op12_vector_codes": _codes_sql()}
