"""Registered queries of the training-data operators, over whole tables, with oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import work_dir
from . import (class_lm, host_rules, language_id, license_scan, line_dedup, link_trust, merkle, minhash, mixing, packing,
               ranked_search, token_files, vector_dedup)
from .shared import crc_mod, table

LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
LLM_ORACLE_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def wrap(fn):
        LLM_QUERIES[name] = fn
        if sql:
            LLM_ORACLE_SQL[name] = sql.strip()
        return fn

    return wrap


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def held_out(modulus: int, remainder: int):
    return F.coalesce(crc_mod("doc_id", modulus) == remainder, F.lit(False))


_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

OP1_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
grams AS (SELECT r, unnest([array_to_string(w[i:i+7], ' ') FOR i IN range(1, len(w) - 6)]) AS g,
                 unnest(range(1, len(w) - 6)) AS i FROM d WHERE len(w) >= 8),
again AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM grams) WHERE n > 1),
covered AS (SELECT r, count(DISTINCT i + k) AS n_repeat FROM again, (SELECT unnest(range(0, 8)) AS k) GROUP BY r),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d WHERE text IS NOT NULL),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup FROM lines
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r),
base AS (
  SELECT d.r, d.doc_id, d.source AS host, CAST(len(d.w) AS BIGINT) AS n_words,
         CAST(coalesce(list_sum([length(x) FOR x IN d.w]), 0) AS BIGINT) AS word_chars,
         CAST(coalesce(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')), 0) AS BIGINT) AS n_symbols,
         CAST(coalesce(dup.n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(c.n_repeat, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN dup USING (r) LEFT JOIN covered c USING (r)),
judged AS (SELECT *, n_words < {host_rules.MIN_WORDS} OR 100 * n_repeat_words > {host_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM base),
hosts AS (SELECT host, CAST(count(*) AS DOUBLE) AS n, CAST(sum(CAST(base_failed AS INT)) AS DOUBLE) AS f FROM judged GROUP BY host),
sums AS (SELECT sum(n) AS n, sum(f) / sum(n) AS mean, sum(f * f / n) AS sq, count(*) AS h FROM hosts),
spread AS (SELECT *, mean * (1 - mean) AS noise, sq / n - mean * mean - mean * (1 - mean) * h / n AS spread FROM sums),
prior AS (SELECT mean, CASE WHEN spread > 1e-12 THEN least(greatest(noise / spread - 1, {host_rules.MIN_STRENGTH}),
          {host_rules.MAX_STRENGTH}) ELSE {host_rules.MAX_STRENGTH} END AS strength FROM spread),
rates AS (SELECT host, (mean * strength + f) / (strength + n) >= {host_rules.MAX_HOST_RATE} AS host_failed FROM hosts, prior)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, j.host, host_failed,
       NOT base_failed AND NOT host_failed AS kept
FROM judged j JOIN rates ON j.host IS NOT DISTINCT FROM rates.host
"""

OP3_SQL = f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce({_WORDS.format("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}, []) AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN w
      ELSE list_distinct([w[i] || ' ' || w[i+1] FOR i IN range(1, len(w))]) END AS s FROM w),
n AS (SELECT doc_id, s, CAST(len(s) AS BIGINT) AS n FROM s),
x AS (SELECT doc_id, n, unnest(s) AS g FROM n),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, a.n AS na, b.n AS nb, count(*) AS k FROM x a JOIN x b USING (g)
           WHERE a.doc_id < b.doc_id AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n) GROUP BY ALL),
l AS (SELECT a, b FROM common WHERE 100 * k >= 80 * (na + nb - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS node, doc_id AS seen FROM n UNION SELECT r.node, e.b FROM r JOIN e ON e.a = r.seen),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node)
SELECT n.doc_id, n.n AS n_shingles, c.component_id, n.doc_id = c.component_id AS kept FROM n JOIN c ON c.node = n.doc_id
"""


@register("op1_host_rules", OP1_SQL)
def op1(spark, sf_dir):
    return host_rules.judge_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host",
        "host_failed", "kept")


@register("op2_mix_sources")
def op2(spark, sf_dir):
    return mixing.mix_plan(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", "size", "source_size", "target", "taken")


@register("op3_minhash_near_dedup", OP3_SQL)
def op3(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle_words=2)


@register("op4_class_language_model")
def op4(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    test = held_out(5, 1)
    model, vocabulary = class_lm.train(docs.filter(~test))
    scored = class_lm.score_texts(docs, model, vocabulary)
    return scored.withColumn("held_out", test).select(
        "doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@register("op5_language_id")
def op5(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    test = held_out(4, 2)
    model = language_id.train(docs.filter(~test))
    found = docs.select("doc_id", test.alias("held_out"),
                        language_id.language_of(spark, model, F.col("text")).alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score")


@register("op6_license_scan", license_scan.oracle_sql())
def op6(spark, sf_dir):
    return license_scan.scan(table(spark, sf_dir, "documents"))


@register("op7_fuzzy_line_dedup")
def op7(spark, sf_dir):
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "line_count", "removed_count", "text")


@register("op8_pack_sequences")
def op8(spark, sf_dir):
    pieces = packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@register("op9_token_files")
def op9(spark, sf_dir):
    manifest = token_files.write_token_files(
        table(spark, sf_dir, "documents"), work_dir(spark, "llm", "token_files"), tokenizer_path())
    return token_files.read_token_files(spark, manifest).withColumn("ids_crc32", F.crc32("ids")).select(
        "doc_id", "start", "n_tokens", "ids_crc32")


@register("op10_vector_near_dedup", """
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x FOR x IN embedding IF x <> 0]) > 0
),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
      WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
r AS (SELECT vec_id AS node, vec_id AS seen FROM embeddings UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.seen),
c AS (SELECT node, min(seen) AS component_id FROM r GROUP BY node),
n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT e.vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, c.component_id, e.vec_id = c.component_id AS kept
FROM embeddings e JOIN c ON c.node = e.vec_id LEFT JOIN n ON n.a = e.vec_id
""")
def op10(spark, sf_dir):
    return vector_dedup.near_duplicate_vectors(table(spark, sf_dir, "embeddings"))


def _op11_sql(rounds: int = link_trust.ROUNDS) -> str:
    fits = " ".join(
        f"WHEN (host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}') THEN '{h}{p}={v}'"
        for h, p, v in sorted(link_trust.RULES, key=lambda r: -len(r[0] + r[1])))
    href = link_trust._HREF.replace("'", "''")
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')".format
    moved = "\n".join(f"""m{k} AS (SELECT e.way, dst AS host, CAST(mass AS BIGINT) * {link_trust.DAMPING} // (100 * degree) AS mass
  FROM e JOIN r{k - 1} r ON r.way = e.way AND r.host = src),
r{k} AS MATERIALIZED (SELECT way, host, sum(mass) AS mass FROM
  (SELECT * FROM m{k} UNION ALL SELECT way, host, mass * {100 - link_trust.DAMPING} // 100 FROM r0) GROUP BY way, host HAVING sum(mass) > 0),"""
                     for k in range(1, rounds + 1))
    return f"""
WITH p AS (SELECT page_id, html, coalesce({lower("regexp_extract(url, '://([^/?#]*)', 1)")}, '') AS host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
j AS MATERIALIZED (SELECT page_id, html, host, path, CASE {fits} END AS f FROM p),
d AS (SELECT page_id, html, host, path, string_split(f, '=')[1] AS rule, string_split(f, '=')[2] AS verdict FROM j),
l AS (SELECT DISTINCT host AS src, dst FROM (SELECT host, {lower(f"unnest(regexp_extract_all(html, '{href}', 1))")} AS dst FROM d)
      WHERE host <> dst AND host <> '' AND dst <> ''),
b AS (SELECT 'allow' AS way, src, dst FROM l UNION ALL SELECT 'block', dst, src FROM l),
e AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY way, src) AS degree FROM b),
h AS (SELECT host, count(*) AS n, count(*) FILTER (verdict = 'allow') AS a, count(*) FILTER (verdict = 'block') AS b
      FROM d WHERE host <> '' GROUP BY host),
s AS (SELECT CASE WHEN 2 * a > n THEN 'allow' WHEN 2 * b > n THEN 'block' END AS way, host FROM h),
r0 AS MATERIALIZED (SELECT way, host, CAST({link_trust.MASS} // (count(*) OVER (PARTITION BY way)) AS BIGINT) AS mass FROM s WHERE way IS NOT NULL),
{moved}
v AS (SELECT host, coalesce(sum(mass) FILTER (way = 'allow'), 0) * (SELECT count(*) FROM r0 WHERE way = 'allow') AS t,
  coalesce(sum(mass) FILTER (way = 'block'), 0) * (SELECT count(*) FROM r0 WHERE way = 'block') AS d FROM r{rounds} GROUP BY host)
SELECT page_id, d.host, path, rule, coalesce(verdict,
  CASE WHEN v.d * 100 >= {link_trust.MASS * link_trust.MIN_DISTRUST} AND v.d > v.t THEN 'block' ELSE 'allow' END) AS verdict
FROM d LEFT JOIN v ON v.host = d.host
"""


@register("op11_link_trust", _op11_sql())
def op11(spark, sf_dir):
    return link_trust.judge_pages(table(spark, sf_dir, "pages"))


_BITS = "list_reduce([{}, 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))"
_CRC = ("xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), [CAST(ascii(c) AS BIGINT) FOR c IN string_split(CAST({} AS VARCHAR), '')]), "
        f"lambda a, c: {_BITS.format('xor(a, c)')}), 4294967295)")


def _tree_sql(name: str, source: str) -> str:
    """Levels of trees over ``source`` (grp, i, h), and of every leaf the siblings' text (p), the leaf's changed digest and the root."""
    return f"""
{name}_level AS (
  SELECT 0 AS k, grp, i, h, count(*) OVER (PARTITION BY grp) AS n FROM {source}
  UNION ALL
  SELECT k + 1, grp, i // 2, sha256(h || coalesce(lead(h) OVER (PARTITION BY grp ORDER BY i), '')), (n + 1) // 2 FROM {name}_level
  WHERE n > 1 QUALIFY i % 2 = 0),
{name}_step AS MATERIALIZED (SELECT a.k, a.grp, a.i, a.n, coalesce(b.h, '') AS sibling FROM {name}_level a
  LEFT JOIN {name}_level b ON b.k = a.k AND b.grp IS NOT DISTINCT FROM a.grp AND b.i = xor(a.i, 1)),
{name}_fold AS (
  SELECT 0 AS k, grp, i AS leaf, i, changed AS h, '' AS p FROM {source}
  UNION ALL
  SELECT f.k + 1, f.grp, f.leaf, f.i // 2, sha256(CASE WHEN f.i % 2 = 0 THEN f.h || s.sibling ELSE s.sibling || f.h END), f.p || s.sibling
  FROM {name}_fold f JOIN {name}_step s ON s.k = f.k AND s.grp IS NOT DISTINCT FROM f.grp AND s.i = f.i WHERE s.n > 1),
{name}_top AS (SELECT grp, leaf, arg_max(h, k) AS h, arg_max(p, k) AS p FROM {name}_fold GROUP BY grp, leaf),
{name}_root AS (SELECT grp, arg_max(h, k) AS h FROM {name}_level GROUP BY grp)"""


def _leaf_sql(*columns: str) -> str:
    return "sha256(" + " || ".join(
        f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR) END" for c in columns) + ")"


OP12_SQL = f"""
WITH RECURSIVE d AS (SELECT *, {_leaf_sql("doc_id", "source", "lang", "n_chars", "text")} AS h,
  CASE WHEN {_CRC.format("doc_id")} % 7 = 0 THEN {_leaf_sql("doc_id", "source", "lang", "(n_chars + 1)", "text")}
       ELSE {_leaf_sql("doc_id", "source", "lang", "n_chars", "text")} END AS changed FROM documents),
leaves AS MATERIALIZED (SELECT doc_id, lang AS grp, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h) - 1 AS i, h, changed FROM d),
{_tree_sql("low", "leaves")},
langs AS MATERIALIZED (SELECT 0 AS grp, grp AS lang, row_number() OVER (ORDER BY grp NULLS FIRST) - 1 AS i, h, h AS changed FROM low_root),
{_tree_sql("high", "langs")},
folded AS (
  SELECT l.doc_id, l.h AS leaf, langs.h AS subroot, sha256(t.p || u.p) AS proof_sha256, t.h AS changed_subroot, langs.i
  FROM leaves l JOIN low_top t ON t.grp IS NOT DISTINCT FROM l.grp AND t.leaf = l.i
  JOIN langs ON langs.lang IS NOT DISTINCT FROM l.grp JOIN high_top u ON u.leaf = langs.i),
climb AS (
  SELECT 0 AS k, doc_id, leaf, i, changed_subroot AS h FROM folded
  UNION ALL
  SELECT c.k + 1, c.doc_id, c.leaf, c.i // 2, sha256(CASE WHEN c.i % 2 = 0 THEN c.h || s.sibling ELSE s.sibling || c.h END)
  FROM climb c JOIN high_step s ON s.k = c.k AND s.i = c.i WHERE s.n > 1),
ends AS (SELECT doc_id, leaf, arg_max(h, k) AS folded_root FROM climb GROUP BY doc_id, leaf)
SELECT f.doc_id, f.leaf, f.subroot, r.h AS root, f.proof_sha256, e.folded_root, e.folded_root = r.h AS verified
FROM folded f JOIN ends e ON e.doc_id IS NOT DISTINCT FROM f.doc_id AND e.leaf = f.leaf, high_root r
"""


@register("op12_merkle_manifest", OP12_SQL)
def op12(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    parts = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    leaf = merkle.leaf_digest(*parts)
    parts[3] = F.col("n_chars") + 1
    tampered = F.coalesce(crc_mod("doc_id", 7) == 0, F.lit(False))
    found = merkle.manifest(docs, leaf, F.when(tampered, merkle.leaf_digest(*parts)).otherwise(leaf))
    return merkle.verified(found).withColumnRenamed("id", "doc_id")


_TERMS = (r"regexp_extract_all(translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
          r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

OP13_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS.format("text")} AS t FROM documents WHERE text IS NOT NULL),
live AS (SELECT r, doc_id, t, CAST(len(t) AS BIGINT) AS n FROM d WHERE len(t) > 0),
whole AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM live),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM live) GROUP BY r, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, whole GROUP BY term),
m AS (SELECT r, doc_id, 100 - 90 + (90 * n * docs) // terms AS m FROM live, whole),
q AS (SELECT DISTINCT item_id, unnest({_TERMS.format("text")}) AS term FROM benchmark WHERE text IS NOT NULL),
s AS (SELECT q.item_id, m.r, m.doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
      FROM q JOIN tf USING (term) JOIN w USING (term) JOIN m USING (r) GROUP BY q.item_id, m.r, m.doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST) AS INT) AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= {ranked_search.TOP}
"""


@register("op13_ranked_search", OP13_SQL)
def op13(spark, sf_dir):
    return ranked_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
