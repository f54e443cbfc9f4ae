"""Registered queries of this folder: each applies its operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from agentlake.llm import (
    bpe, centroids, digests, embedding_dedup, html_text, langid, licenses, merkle, mixing, quality, secrets, simhash, suffix_dedup,
)
from agentlake.llm.rows import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return add


@query(
    "op1_embedding_pairs",
    """
    WITH RECURSIVE v AS (
      SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings
    ), u AS (
      SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v
      WHERE e IS NOT NULL AND len(e) > 0 AND list_count(e) = len(e) AND len(list_filter(e, lambda x: NOT isfinite(x))) = 0
    ), l AS (
      SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id
      WHERE a.n > 0 AND b.n > 0 AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.9
    ), r AS (
      SELECT a AS s, b AS t FROM l UNION SELECT r.s, l.b FROM r JOIN l ON r.t = l.a
    ), c AS (
      SELECT s, min(t) AS low FROM r GROUP BY s
    ), d AS (
      SELECT a, count(*) AS n FROM l GROUP BY a
    )
    SELECT vec_id, coalesce(d.n, 0)::BIGINT AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
           vec_id <= coalesce(low, vec_id) AS kept
    FROM v LEFT JOIN d ON d.a = vec_id LEFT JOIN c ON c.s = vec_id
    """,
)
def op1_embedding_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    out = bpe.round_trip(table(spark, sf_dir, "documents"), path)
    return out.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256")
    )


@query("op3_language")
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), "doc_id")


@query("op4_secret_links")
def op4_secret_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secrets.scan(table(spark, sf_dir, "documents"))
    base = F.col("base")
    return out.select(
        "doc_id", *[secrets.count_kind(base, k).alias(f"n_{k}") for k in secrets.KINDS],
        F.sha2(F.encode(secrets.listed(base), "UTF-8"), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans"),
    )


@query("op5_cube_mix")
def op5_cube_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = mixing.mix(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("times")).alias("taken"), "source", "times")


@query(
    "op6_host_rules",
    r"""
    WITH d AS (
      SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents
    ), w AS (
      SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d
    ), win AS (
      SELECT r, i, array_to_string(words[i:i + 4], ' ') AS g FROM (SELECT r, words, unnest(range(1, len(words) - 3)) AS i FROM w)
    ), rep AS (
      SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1
    ), cov AS (
      SELECT r, count(DISTINCT i + k) AS n FROM rep, (SELECT unnest(range(0, 5)) AS k) GROUP BY r
    ), c AS (
      SELECT doc_id, source, len(words)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines
      FROM w LEFT JOIN cov USING (r)
    ), f AS (
      SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, n_symbols > n_words AS symbols,
             100 * n_dup_lines > 30 * n_lines AS dup, word_chars < 2 * n_words OR word_chars > 100 * n_words AS odd FROM c
    ), fails AS (
      SELECT source AS s, 0 AS rule, base_failed AS failed FROM f UNION ALL SELECT source, 1, symbols FROM f
      UNION ALL SELECT source, 2, dup FROM f UNION ALL SELECT source, 3, odd FROM f
    ), h AS (
      SELECT s, rule, count(*) AS n, sum(failed::INT) AS k FROM fails WHERE s IS NOT NULL GROUP BY s, rule
    ), m AS (
      SELECT rule, count(*) AS hosts, sum(k) / sum(n) AS m, avg(n) AS size,
             var_samp(k / n) - sum(k) / sum(n) * (1 - sum(k) / sum(n)) * avg(1 / n) AS beyond
      FROM h GROUP BY rule
    ), p AS (
      SELECT rule, m, CASE WHEN hosts > 2 AND beyond > 0 AND m * (1 - m) / beyond - 1 > 0 THEN m * (1 - m) / beyond - 1 ELSE size END AS wt FROM m
    ), v AS (
      SELECT s, max(rate) > 0.6 AS refused, max(CASE WHEN rule = 1 THEN rate END) > 0.3 AS s1, max(CASE WHEN rule = 2 THEN rate END) > 0.3 AS s2,
             max(CASE WHEN rule = 3 THEN rate END) > 0.3 AS s3
      FROM (SELECT s, rule, (k + m * wt) / (n + wt) AS rate FROM h JOIN p USING (rule)) GROUP BY s
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
           NOT (base_failed OR coalesce(refused, false) OR (symbols AND coalesce(s1, false)) OR (dup AND coalesce(s2, false))
                OR (odd AND coalesce(s3, false))) AS kept
    FROM f LEFT JOIN v ON s = source
    """,
)
def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), "doc_id").drop("shrunk_rate")


@query("op7_simhash_groups")
def op7_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query("op8_suffix_repeats")
def op8_suffix_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), "doc_id")
    return out.select(
        "doc_id", "n_bytes", suffix_dedup.removed_bytes(F.col("spans")).alias("n_removed"), F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def _license_sql() -> str:
    """The scan as SQL: phrases by position; template grams joined by their words, diagonals merged by gaps."""
    text = lambda x: "'" + x.replace("'", "''") + "'"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    words = lambda x: rf"regexp_extract_all(translate({x}, '{upper}', '{lower}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    phrases = " UNION ALL ".join(
        f"SELECT r, i - 1 AS place, {text(label)} AS label FROM spots WHERE "
        + " AND ".join(f"w[i + {k}] = {text(w)}" for k, w in enumerate(phrase.split()))
        for phrase, label in licenses.PHRASES.items()
    )
    wordings = ", ".join(f"({text(label)}, {n}, {text(t)})" for label, many in licenses.TEMPLATES.items() for n, t in enumerate(many))
    k = licenses.GRAM - 1
    return f"""
    WITH d AS (SELECT row_number() OVER () AS r, doc_id, {words("coalesce(text, '')")} AS w FROM documents),
    spots AS (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM d),
    p AS ({phrases}),
    b AS (SELECT r, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word, list_sort(list(DISTINCT label)) AS labels FROM p GROUP BY r),
    t AS (SELECT label, n, {words("t")} AS w FROM (VALUES {wordings}) AS v(label, n, t)),
    tg AS (SELECT label, n, j, w[j:j + {k}] AS g, len(w) - {k} AS size FROM (SELECT *, unnest(range(1, len(w) - {k} + 1)) AS j FROM t)),
    dg AS (SELECT r, i, w[i:i + {k}] AS g FROM spots WHERE i + {k} <= len(w)),
    h AS (SELECT r, label, n, size, j, i - j AS diagonal FROM dg JOIN tg USING (g)),
    e AS (SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, label, n ORDER BY diagonal, j) <= {licenses.SLACK} THEN 0 ELSE 1 END AS new FROM h),
    f AS (SELECT *, sum(new) OVER (PARTITION BY r, label, n ORDER BY diagonal, j ROWS UNBOUNDED PRECEDING) AS run FROM e),
    c AS (SELECT r, label, count(DISTINCT j) / any_value(size) AS covered FROM f GROUP BY r, label, n, run),
    m AS (SELECT r, list(DISTINCT label) AS more, max(covered) AS covered FROM c WHERE covered >= {licenses.COVERED} GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word, last_word::BIGINT AS last_word,
           array_to_string(coalesce(labels, []), ',') AS base_labels,
           array_to_string(list_sort(list_distinct(list_concat(coalesce(labels, []), coalesce(more, [])))), ',') AS labels,
           CASE WHEN n_base > 0 THEN 1.0 ELSE coalesce(covered, 0.0) END::DOUBLE AS score
    FROM d LEFT JOIN b USING (r) LEFT JOIN m USING (r)"""


@query("op9_license_diagonals", _license_sql())
def op9_license_diagonals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"), "doc_id").drop("spans")


@query("op10_main_text")
def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"), "page_id", "url")


def _centroid_sql(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """Rounds written out: assign all, then the floor of sums over counts; sums and distances are whole numbers."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
    d{r} AS MATERIALIZED (
      SELECT r, vec_id, kept.v, c,
             list_sum(list_transform(list_zip(kept.v, c{r}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
      FROM kept CROSS JOIN c{r}
    ), a{r} AS MATERIALIZED (
      SELECT r, vec_id, v, c, d FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY d, c) AS nth FROM d{r}) WHERE nth = 1
    )""")
        if r < rounds:
            steps.append(f"""
    c{r + 1} AS MATERIALIZED (
      SELECT c, coalesce(m.v, c{r}.v) AS v FROM c{r} LEFT JOIN (
        SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY i)::BIGINT[] AS v
        FROM (SELECT c, i, sum(x) AS s, count(*) AS n FROM (SELECT c, unnest(v) AS x, unnest(range({dim})) AS i FROM a{r}) GROUP BY c, i) GROUP BY c
      ) m USING (c)
    )""")
    return f"""
    WITH kept AS MATERIALIZED (
      SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE len(embedding) = {dim} AND list_count(embedding) = {dim} AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0
    ), c0 AS MATERIALIZED (
      SELECT row_number() OVER (ORDER BY h NULLS LAST, v) - 1 AS c, v FROM (SELECT sha256('2:' || vec_id) AS h, v FROM kept) ORDER BY 1 LIMIT {k}
    ), {",".join(steps)}
    SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
           (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
    FROM a{rounds} JOIN c{rounds} USING (c)"""


@query("op11_centroid_clusters", _centroid_sql())
def op11_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings")).drop("scans")


def _manifest_sql(fanout: int = 8) -> str:
    """Levels by recursion, then every path by recursion over the strings of the siblings."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    step = "list_reduce(list_concat([xor(c, x)], repeat([0::BIGINT], 8)), lambda a, b: xor(a >> 1, 3988292384 * (a & 1)))"
    crc = f"""xor(4294967295, list_reduce(list_concat([4294967295::BIGINT],
              list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)), lambda c, x: {step}))"""

    def tree(name: str, source: str) -> str:
        return f"""
    {name} AS (
      SELECT g, 0 AS lv, pos, h, n FROM {source}
      UNION ALL
      SELECT g, lv + 1, pos // {fanout}, sha256(string_agg(h, '' ORDER BY pos)), (any_value(n) + {fanout - 1}) // {fanout}
      FROM {name} WHERE n > 1 GROUP BY g, lv, pos // {fanout}
    ), {name}_s AS (
      SELECT a.g, a.lv, a.pos, coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS lo,
             coalesce(string_agg(b.h, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS hi
      FROM {name} a JOIN {name} b ON a.g IS NOT DISTINCT FROM b.g AND a.lv = b.lv AND a.pos // {fanout} = b.pos // {fanout}
      WHERE a.n > 1 GROUP BY a.g, a.lv, a.pos
    )"""

    def climb(name: str, sides: str, source: str) -> str:
        return f"""
    {name} AS (
      SELECT r, g, pos, 0 AS lv, proof, h FROM {source}
      UNION ALL
      SELECT r, p.g, p.pos // {fanout}, p.lv + 1, proof || lo || hi, sha256(lo || h || hi)
      FROM {name} p JOIN {sides} s ON p.g IS NOT DISTINCT FROM s.g AND p.lv = s.lv AND p.pos = s.pos
    )"""

    return f"""
    WITH RECURSIVE d AS MATERIALIZED (
      SELECT row_number() OVER () AS r, doc_id, lang AS g, {leaf("text")} AS leaf,
             CASE WHEN doc_id IS NOT NULL AND {crc} % 3 = 0 THEN {leaf(f"translate(text, '{upper}', '{lower}')")} ELSE {leaf("text")} END AS other
      FROM documents
    ), l AS MATERIALIZED (
      SELECT r, g, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM d
    ), {tree("low", "l")}, sub AS MATERIALIZED (
      SELECT true AS g, row_number() OVER (ORDER BY low.g NULLS FIRST) - 1 AS pos, low.g AS lang, h, count(*) OVER () AS n FROM low WHERE n = 1
    ), {tree("top", "(SELECT g, pos, h, n FROM sub)")}, {climb("up", "low_s", "(SELECT l.r, l.g, pos, '' AS proof, other AS h FROM l JOIN d USING (r))")},
    arrived AS (
      SELECT r, true AS g, sub.pos, proof, up.h FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY lv DESC) AS last FROM up) up
      JOIN sub ON up.g IS NOT DISTINCT FROM sub.lang WHERE last = 1
    ), {climb("over", "top_s", "arrived")}, done AS (
      SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY lv DESC) AS last FROM over) WHERE last = 1
    )
    SELECT doc_id, leaf, sub.h AS subroot, top.h AS root, sha256(proof) AS proof_sha256, done.h AS folded_root, done.h = top.h AS verified
    FROM d JOIN done USING (r) JOIN sub ON d.g IS NOT DISTINCT FROM sub.lang JOIN top ON top.n = 1"""


@query("op12_merkle_manifest", _manifest_sql())
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, columns = table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"]
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    tampered = F.when(hit, merkle.leaf_hash([*map(F.col, columns[:-1]), F.translate("text", upper, lower)]))
    out = merkle.manifest(docs, columns, "doc_id", "lang", {"tampered": tampered})
    left, right = F.col("left"), F.col("right")
    found = out.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_hash(left, right).alias("proof_sha256"),
        merkle.fold(F.coalesce("tampered", "leaf"), left, right).alias("folded_root"),
    )
    return found.select("*", (F.col("folded_root") == F.col("root")).alias("verified"))


@query("op13_improbable_digest")
def op13_improbable_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = digests.spliced(table(spark, sf_dir, "documents"))
    shown = [F.lower(F.hex(c)).alias(c) for c in ("fingerprint", "edited_fingerprint")]
    return out.select("doc_id", "n_chars", "edited_sha256", *shown, "near_edited", "near_next")
