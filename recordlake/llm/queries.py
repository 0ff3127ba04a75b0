"""One query for each operator, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .decontaminate import contaminated
from .exact_dedup import exact_dedup
from .html_text import extract_pages
from .language_model import language_scores
from .license_scan import STRIDE, clauses, scan_licenses
from .merkle import manifest_proofs
from .ngram_join import ngram_join
from .packing import pack_tokens
from .prefix_trie import conversation_trie
from .quality import quality
from .substring_dedup import cut_repeats
from .token_counts import DELETE, INSERT, REVISE, new_rollup
from .toxicity import toxicity


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(table(spark, sf_dir, "documents"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after a load, revised texts, deletes, a batch given twice, and batches that set both right again: those of documents as they are."""
    rollup, docs = new_rollup(spark), table(spark, sf_dir, "documents")
    some = lambda k: docs.filter(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(20)) == k)
    rollup.commit("load", docs.withColumn("op", F.lit(INSERT)))
    wrong = some(1).withColumns({"op": F.lit(REVISE), "text": F.concat("text", F.lit(" revised"))})
    rollup.commit("revise", wrong)
    rollup.commit("delete", some(2).withColumn("op", F.lit(DELETE)))
    rollup.commit("revise", wrong)  # it is committed already
    rollup.compact()
    right = some(1).withColumn("op", F.lit(REVISE)).unionByName(some(2).withColumn("op", F.lit(INSERT)))
    rollup.commit("restore", right)
    return rollup.totals()


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cut_repeats(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op8_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_scores(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_tokens(table(spark, sf_dir, "documents"))


def op11_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(table(spark, sf_dir, "documents"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest_proofs(table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"), rebuilt=True)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k.startswith("op") and callable(f)}


#: unsigned crc32 of decimal digits, byte by byte with the table of its polynomial.
CRC_TABLE_SQL = """SELECT list(list_reduce([k, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY k) AS tab
    FROM (SELECT unnest(range(256))::BIGINT AS k)"""


def crc_sql(digits: str) -> str:
    steps = f"list_prepend(4294967295::BIGINT, list_transform(string_split({digits}, ''), lambda x: ascii(x)::BIGINT))"
    return f"xor(list_reduce({steps}, lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"


def merkle_sql(levels: int = 8, group_levels: int = 3) -> str:
    """The manifest level by level: nodes, the runs that they are in, and digests folded along the runs. Up to 8 ** levels rows of a language."""
    part = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(part(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes = [
        f"crc AS ({CRC_TABLE_SQL})",
        f"d AS (SELECT doc_id, lang, {leaf('text')} AS h, CASE WHEN {crc_sql('doc_id::VARCHAR')} % 3 = 0 THEN {leaf(lower)} END AS bad FROM documents, crc)",
        "p0 AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i, coalesce(bad, h) AS c, '' AS s FROM d)",
        "t0 AS (SELECT lang AS g, i, h FROM p0)",
    ]

    def climb(t: str, p: str, g: str, k: int, out_t: str, out_p: str) -> None:
        """The level above t, and the paths of p with what the run adds."""
        ctes.append(f"{out_t}r AS (SELECT g, i // 8 AS i, string_agg(h, '' ORDER BY i) AS run, sum(count(*)) OVER (PARTITION BY g) AS n FROM {t} GROUP BY 1, 2)")
        ctes.append(f"{out_t} AS (SELECT g, i, CASE WHEN n = 1 THEN run ELSE sha256(run) END AS h FROM {out_t}r)")
        j = f"(i >> {3 * k})"
        left, right = f"substr(run, 1, 64 * ({j} % 8)::INT)", f"substr(run, 64 * ({j} % 8)::INT + 65)"
        ctes.append(f"{out_p} AS (SELECT p.* REPLACE (CASE WHEN n = 1 THEN c ELSE sha256({left} || c || {right}) END AS c, CASE WHEN n = 1 THEN s ELSE s || {left} || {right} END AS s) FROM (SELECT *, {j} // 8 AS up FROM {p}) p JOIN {out_t}r r ON p.up = r.i AND p.{g} IS NOT DISTINCT FROM r.g)".replace("p.*", "p.* EXCLUDE (up)").replace("(i >>", "(p.i >>").replace("(SELECT *, (p.i >>", "(SELECT *, (i >>"))

    for k in range(levels):
        climb(f"t{k}", f"p{k}", "lang", k, f"t{k + 1}", f"p{k + 1}")
    ctes.append(f"q0 AS (SELECT p.* REPLACE (l.i AS i), l.h AS subroot, true AS every FROM p{levels} p JOIN (SELECT g, h, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i FROM t{levels}) l ON p.lang IS NOT DISTINCT FROM l.g)")
    ctes.append("u0 AS (SELECT DISTINCT true AS g, i, subroot AS h FROM q0)")
    for k in range(group_levels):
        climb(f"u{k}", f"q{k}", "every", k, f"u{k + 1}", f"q{k + 1}")
    return f"WITH {', '.join(ctes)} SELECT doc_id, q.h AS leaf, subroot, u.h AS root, sha256(s) AS proof_sha256, c AS folded_root, c = u.h AS verified FROM q{group_levels} q, u{group_levels} u"


def license_sql() -> str:
    """Phrases by position, and every block of every document against every clause, word by word."""
    wanted = clauses()
    rows = ", ".join(f"({k}, '{c.label}', {len(c.words)}, {c.need}, '{w}')" for k, c in enumerate(wanted) for w in c.words)
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
        WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all({lower}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
        c AS (SELECT * FROM (VALUES {rows}) AS x(clause, label, n, need, word)),
        t AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS p FROM d),
        base AS (SELECT r, p, CASE WHEN word = 'mit' AND next = 'license' THEN 'mit' WHEN word = 'apache' AND next = 'license' THEN 'apache' WHEN word = 'general' AND next = 'public' AND later = 'license' THEN 'gpl' END AS label
            FROM (SELECT *, lead(word) OVER o AS next, lead(word, 2) OVER o AS later FROM t WINDOW o AS (PARTITION BY r ORDER BY p)) WHERE label IS NOT NULL),
        b AS (SELECT r, count(*) AS n_base, min(p) AS first_word, max(p) AS last_word, string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels FROM base GROUP BY 1),
        m AS (SELECT r, p // {STRIDE} - back AS block, word FROM t, (VALUES (0), (1)) AS x(back) WHERE p // {STRIDE} >= back),
        o AS (SELECT r, block, clause, label, count(DISTINCT word) / any_value(n) AS held FROM m JOIN c USING (word) GROUP BY 1, 2, 3, 4 HAVING count(DISTINCT word) >= any_value(need)),
        l AS (SELECT r, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM (SELECT r, label FROM base UNION ALL SELECT r, label FROM o) GROUP BY 1),
        s AS (SELECT r, max(held) AS best FROM o GROUP BY 1)
        SELECT doc_id, len(w) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
            CASE WHEN n_base > 0 THEN 1.0::DOUBLE ELSE coalesce(best, 0.0::DOUBLE) END AS score
        FROM d LEFT JOIN b USING (r) LEFT JOIN l USING (r) LEFT JOIN s USING (r)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op9_exact_dedup": """
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
                   doc_id IS NOT DISTINCT FROM max(doc_id) OVER w AS kept, sha256(coalesce(text, '')) AS text_sha256
            FROM documents WINDOW w AS (PARTITION BY coalesce(text, ''))""",
        "op11_license_scan": license_sql(),
        "op12_merkle_manifest": merkle_sql(),
        "op13_prefix_trie": f"""
            WITH crc AS ({CRC_TABLE_SQL}),
            t AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, id) - 1 AS i FROM
                (SELECT conv_id, turn, strlen(coalesce(text, '')) AS size, substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS id FROM conversations WHERE conv_id IS NOT NULL)),
            c AS (SELECT conv_id, conv_id - conv_id % 5 AS base, {crc_sql('conv_id::VARCHAR')} % 9 AS h FROM (SELECT DISTINCT conv_id FROM t), crc),
            r AS (SELECT c.conv_id, 0 AS part, i, id, size FROM c JOIN t ON t.conv_id = base WHERE i < h UNION ALL SELECT conv_id, 1, i, id, size FROM c JOIN t USING (conv_id) WHERE i >= h),
            s AS (SELECT c.conv_id, coalesce(list(id ORDER BY part, i) FILTER (id IS NOT NULL), []) AS ids, coalesce(list(size ORDER BY part, i) FILTER (id IS NOT NULL), []) AS sizes FROM c LEFT JOIN r USING (conv_id) GROUP BY 1),
            p AS (SELECT conv_id, ids, d, array_to_string(ids[1:d], '') AS p, array_to_string(ids[1:d - 1], '') AS up, coalesce(sizes[d], 0) AS size, len(ids) = d AS ends FROM (SELECT *, unnest(range(len(ids) + 1)) AS d FROM s)),
            n AS (SELECT d, p, any_value(CASE WHEN d > 0 THEN up END) AS up, any_value(ids) AS ids, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256 FROM p GROUP BY 1, 2),
            k AS (SELECT up AS p, count(*) AS n_children FROM n WHERE up IS NOT NULL GROUP BY 1),
            a AS (SELECT unnest(list_transform(range(d + 1), lambda x: array_to_string(ids[1:x], ''))) AS p, n_children IS NULL AS leaf, (n_convs - 1) * size AS saved FROM n LEFT JOIN k USING (p)),
            b AS (SELECT p, count(*) FILTER (leaf) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM a GROUP BY 1)
            SELECT n.conv_id, n.d AS depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
            FROM n LEFT JOIN n u ON n.up = u.p LEFT JOIN k ON k.p = n.p JOIN b ON b.p = n.p""",
    }
