"""The registered queries of this package and their SQL for DuckDB, by name."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventmart.llm import (
    decontamination, fill_in_middle, jaccard_join, language_id, merkle, packing, pii, quality_model,
    quality_rules, secrets, toxicity, url_filters, warc)
from eventmart.llm.common import remainder, table
from eventmart.session import run_dir

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PATTERN = public_tokenizers.PATTERN


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_compression_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.compression_verdicts(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.withColumn("items_sha256", F.sha2(
        F.array_join("items", ",").cast("binary"), 256)).drop("items")


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_spans(table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.similar_documents(table(spark, sf_dir, "documents"))


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, PATTERN)
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), run_dir(spark, "warc"))


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as captures of the year 2024 by page id, against lists that all the pages' hosts,
    domains and first path segments make up: each is listed on a day that its smallest page id
    gives, some are taken off 60 days later, and some of these come back after 90 more."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", "url", F.expr("date_add(DATE'2024-01-01', CAST(page_id * 7 % 366 AS INT))"
                                 ).alias("fetched"))
    host, segments = url_filters.host_of(F.col("url")), url_filters.segments_of(F.col("url"))
    named = pages.select(
        "page_id", host.alias("host"), F.get(segments, 0).alias("segment")).where("host <> ''")
    sources = named.select("page_id", F.inline(F.array(
        F.struct(F.lit("hosts").alias("list"), F.lit("block").alias("action"),
                 F.lit("domain").alias("kind"), F.col("host").alias("pattern")),
        F.struct(F.lit("domains").alias("list"), F.lit("block").alias("action"),
                 F.lit("domain").alias("kind"),
                 F.substring_index("host", ".", -2).alias("pattern")),
        F.struct(F.lit("sections").alias("list"), F.lit("allow").alias("action"),
                 F.lit("prefix").alias("kind"),
                 F.concat("host", F.lit("/"), "segment").alias("pattern"))))).where(
        "pattern IS NOT NULL").groupBy("list", "action", "kind", "pattern").agg(
        F.min("page_id").alias("first"))
    changes = sources.select("*", F.inline(F.expr(
        "filter(array(struct('add' AS change, 0 AS later, TRUE AS made), "
        "struct('remove' AS change, 60 AS later, first % 2 = 0 AS made), "
        "struct('add' AS change, 150 AS later, first % 4 = 0 AS made)), c -> c.made)"))).select(
        "list", "action", "kind", "pattern", "change",
        F.expr("date_add(DATE'2024-01-01', CAST(first * 11 % 200 AS INT) + later)").alias("dated"))
    return url_filters.evaluate(pages, changes)


def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(secrets.secret_spans(table(spark, sf_dir, "documents")))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of the documents by language, and the documents held against it after one in seven
    had its n_chars changed."""
    changed = F.when(remainder("doc_id", 7) == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = merkle.manifest(table(spark, sf_dir, "documents"), ("doc_id", "source", "lang", "n_chars", "text"),
                            "lang", "doc_id", {"n_chars": changed})
    return merkle.verified(found, "doc_id")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digests(fill_in_middle.transform(table(spark, sf_dir, "documents")))


def _random_sql(kind: secrets.CharacterClass) -> str:
    """Windows of a class with enough entropy, each counted from nothing."""
    width, run = kind.window, "lower(run)" if kind.fold else "run"
    weights = ", ".join(str(secrets.weight(n)) for n in range(1, width + 1))
    signs = kind.alphabet.replace("-", "\\-")
    return f"""
        SELECT doc_id, place, run, '{kind.kind}' AS kind, {width} AS width, i
        FROM (SELECT doc_id, place, run, i, substr({run}, i + 1, {width}) AS part
              FROM (SELECT *, unnest(range(length(run) - {width} + 1)) AS i FROM runs))
        WHERE regexp_full_match(part, '[{signs}]+') AND list_sum(list_transform(
            list_distinct(string_split(part, '')),
            lambda c: ([{weights}])[{width} - length(replace(part, c, ''))])) <= {kind.limit}"""


def _shape_sql(kind: str, pattern: str, group: int, least: int) -> str:
    """Matches of a base kind; RE2 folds case beyond ASCII and has no look-behind, so both are spelt out."""
    if kind == "assign":
        head, tail = pattern.removeprefix("(?i:").split(")", 1)
        pattern = "(?:" + "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in head) + ")" + tail
    pattern = pattern.removeprefix("(?<![0-9a-f])").replace("'", "''")
    return f"""
        SELECT doc_id, '{kind}' AS kind,
               CAST(list_sum(list_transform(gaps[:i], lambda g: length(g))) + coalesce(
                 list_sum(list_transform(found[:i - 1], lambda m: length(m))), 0) AS BIGINT) AS a,
               a + length(found[i]) AS b
        FROM (SELECT *, unnest(range(1, len(found) + 1)) AS i
              FROM (SELECT doc_id, string_split_regex(body, '{pattern}') AS gaps,
                           regexp_extract_all(body, '{pattern}') AS found,
                           regexp_extract_all(body, '{pattern}', {group}) AS parts FROM texts))
        WHERE length(parts[i]) >= {least}"""


def _field(value: str) -> str:
    return (f"coalesce(octet_length(encode(CAST({value} AS VARCHAR))) || ':' || CAST({value} AS VARCHAR), '-')")


_KINDS = [*secrets.BASE_KINDS, *(c.kind for c in secrets.CLASSES)]
_ALLOWED = "|".join(f"(?:{p})" for p in secrets.ALLOWED)
_RUN_LENGTH = min(c.window for c in secrets.CLASSES)

QUERIES = {f.__name__: f for f in (
    op1_quality, op2_compression_rules, op3_toxicity, op4_language, op5_decontamination,
    op6_personal_data, op7_jaccard_join, op8_packing, op9_warc, op10_url_filters,
    op11_secrets, op12_merkle, op13_fill_in_middle)}
SQL = {
    "op5_decontamination": r"""
        WITH document_words AS (
            SELECT doc_id, regexp_extract_all(translate(
                coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM documents),
        item_words AS (
            SELECT item_id, regexp_extract_all(translate(
                coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
            FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, words[i:i + 12] AS gram
            FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i
                  FROM item_words WHERE len(words) > 0)),
        sizes AS (SELECT DISTINCT len(gram) AS n FROM windows),
        runs AS (
            SELECT doc_id, n, i, words[i:i + n - 1] AS gram
            FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
                  FROM document_words, sizes WHERE len(words) >= n)),
        found AS (SELECT doc_id, item_id, i, n FROM runs JOIN windows USING (gram)),
        hits AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM found) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found)
            GROUP BY doc_id)
        SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
        FROM document_words LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)""",
    "op10_url_filters": r"""
        WITH captures AS (
            SELECT page_id, DATE '2024-01-01' + CAST(page_id * 7 % 366 AS INT) AS day,
                   regexp_replace(lower(regexp_extract(
                       url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)', 1)),
                       '\.$', '') AS host,
                   list_filter(string_split(regexp_extract(
                       url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'),
                       lambda x: x <> '') AS segments
            FROM pages),
        named AS (
            SELECT page_id, 'hosts' AS list, 'block' AS action, 'domain' AS kind,
                   host AS pattern FROM captures WHERE host <> ''
            UNION ALL SELECT page_id, 'domains', 'block', 'domain',
                   regexp_extract(host, '[^.]*\.?[^.]*$') FROM captures WHERE host <> ''
            UNION ALL SELECT page_id, 'sections', 'allow', 'prefix', host || '/' || segments[1]
            FROM captures WHERE host <> '' AND len(segments) > 0),
        sources AS (
            SELECT list, action, kind, lower(pattern) AS pattern, first
            FROM (SELECT list, action, kind, pattern, min(page_id) AS first FROM named
                  GROUP BY ALL)),
        changes AS (
            SELECT *, 'add' AS change, 0 AS later FROM sources
            UNION ALL SELECT *, 'remove', 60 FROM sources WHERE first % 2 = 0
            UNION ALL SELECT *, 'add', 150 FROM sources WHERE first % 4 = 0),
        days AS (
            SELECT list, action, kind, pattern, max(change) AS change,
                   DATE '2024-01-01' + CAST(first * 11 % 200 AS INT) + later AS since
            FROM changes GROUP BY list, action, kind, pattern, since),
        valid AS (
            SELECT * FROM (
                SELECT *, lead(since) OVER (
                    PARTITION BY list, action, kind, pattern ORDER BY since) AS until
                FROM days) WHERE change = 'add'),
        held AS (
            SELECT page_id, list, action, pattern FROM captures JOIN valid
            ON day >= since AND (until IS NULL OR day < until) AND host <> '' AND CASE kind
                WHEN 'domain' THEN ends_with('.' || host, '.' || pattern)
                ELSE starts_with(lower(host || '/' || array_to_string(segments, '/')) || '/',
                                 pattern || '/') END),
        found AS (
            SELECT page_id, max({'length': length(pattern), 'action': action,
                                 'pattern': pattern}) AS top,
                   count(*) AS n_entries,
                   array_to_string(list_sort(list_distinct(list(list))), ',') AS lists
            FROM held GROUP BY page_id)
        SELECT page_id, host, day, coalesce(top.action, 'none') AS verdict, top.pattern AS pattern,
               coalesce(n_entries, 0) AS n_entries, coalesce(lists, '') AS lists
        FROM captures LEFT JOIN found USING (page_id)""",
    "op9_warc": """
        WITH made AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest
            FROM pages),
        firsts AS (
            SELECT payload_digest, min(page_id) AS first_id FROM made
            WHERE payload_bytes >= 100 GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN first_id < page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN first_id < page_id THEN first_id END AS refers_to
        FROM made LEFT JOIN firsts USING (payload_digest)""",
    "op11_secrets": f"""
        WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS body FROM documents),
        base AS ({" UNION ALL ".join(_shape_sql(*shape) for shape in secrets.SHAPES)}),
        runs AS (
            SELECT doc_id, a AS place, substr(body, a + 1, b - a) AS run
            FROM ({_shape_sql("run", f"{secrets.RUN}{{{_RUN_LENGTH},}}", 0, 1)}) JOIN texts USING (doc_id)
            WHERE NOT regexp_full_match(run, '{_ALLOWED}')),
        windows AS ({" UNION ALL ".join(_random_sql(c) for c in secrets.CLASSES)}),
        joined AS (
            SELECT doc_id, kind, place, run, island, min(i) AS a, max(i) + any_value(width) AS b
            FROM (SELECT *, sum(opens) OVER (PARTITION BY doc_id, kind, place ORDER BY i) AS island
                  FROM (SELECT *, CASE WHEN i <= lag(i) OVER (
                            PARTITION BY doc_id, kind, place ORDER BY i) + width THEN 0 ELSE 1 END AS opens
                        FROM windows))
            GROUP BY ALL),
        spans AS (
            SELECT doc_id, kind, a, b FROM base
            UNION ALL SELECT doc_id, kind, place + a, place + b FROM joined
            WHERE NOT regexp_full_match(substr(run, a + 1, b - a), '{_ALLOWED}')),
        ranked AS (SELECT *, list_position({_KINDS!r}, kind) AS rank FROM spans),
        kept AS (
            SELECT *, kind || ':' || a || ':' || b AS entry FROM ranked x
            WHERE kind IN {secrets.BASE_KINDS!r} OR NOT EXISTS (
                SELECT 1 FROM ranked y WHERE y.doc_id = x.doc_id AND y.rank < x.rank
                AND y.a <= x.a AND x.b <= y.b)),
        texted AS (
            SELECT doc_id, string_agg(entry, ',' ORDER BY a, rank) AS spans,
                   string_agg(entry, ',' ORDER BY a, rank) FILTER (kind IN {secrets.BASE_KINDS!r}) AS base,
                   {", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in secrets.BASE_KINDS)}
            FROM kept GROUP BY doc_id)
        SELECT doc_id, {", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in secrets.BASE_KINDS)},
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM texts LEFT JOIN texted USING (doc_id)""",
    "op12_merkle": f"""
        WITH RECURSIVE given AS (
            SELECT doc_id, lang, list_reduce(
                       list_prepend(CAST(4294967295 AS BIGINT), list_transform(
                           string_split(coalesce(CAST(doc_id AS VARCHAR), ''), ''),
                           lambda c: CAST(ascii(c) AS BIGINT))),
                       lambda crc, b: list_reduce(
                           list_prepend(xor(crc, b), CAST([0, 0, 0, 0, 0, 0, 0, 0] AS BIGINT[])),
                           lambda x, _: CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))
                     AS crc,
                   {_field("doc_id")} || {_field("source")} || {_field("lang")} AS head,
                   n_chars, {_field("text")} AS tail FROM documents),
        leaves AS (
            SELECT doc_id, coalesce('+' || lang, '') AS tree, sha256(head || {_field("n_chars")} || tail) AS leaf,
                   CASE WHEN xor(crc, 4294967295) % 7 = 0
                        THEN sha256(head || {_field("(n_chars + 1)")} || tail) ELSE leaf END AS claimed
            FROM given),
        places AS (
            SELECT *, row_number() OVER () AS row,
                   row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                   count(*) OVER (PARTITION BY tree) AS n FROM leaves),
        nodes(tree, level, pos, n, digest) AS (
            SELECT tree, 0, pos, n, leaf FROM places
            UNION ALL SELECT tree, level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
            FROM nodes WHERE n > 1 GROUP BY tree, level, pos // 2, n),
        trees AS (
            SELECT tree, digest AS subroot, row_number() OVER (ORDER BY tree) - 1 AS pos, count(*) OVER () AS n
            FROM nodes WHERE n = 1),
        tops(level, pos, n, digest) AS (
            SELECT 0, pos, n, subroot FROM trees
            UNION ALL SELECT level + 1, pos // 2, (n + 1) // 2, sha256(string_agg(digest, '' ORDER BY pos))
            FROM tops WHERE n > 1 GROUP BY level, pos // 2, n),
        levels AS (
            SELECT DISTINCT tree, level, 0 AS upper, n FROM nodes WHERE n > 1),
        steps AS (
            SELECT row, l.level, 0 AS upper, (p.pos >> l.level) % 2 AS child, s.digest
            FROM places p JOIN levels l USING (tree)
            LEFT JOIN nodes s ON s.tree = p.tree AND s.level = l.level AND s.pos = xor(p.pos >> l.level, 1)
            UNION ALL SELECT row, l.level, 1, (t.pos >> l.level) % 2, s.digest
            FROM places p JOIN trees t USING (tree) CROSS JOIN (SELECT DISTINCT level FROM tops WHERE n > 1) l
            LEFT JOIN tops s ON s.level = l.level AND s.pos = xor(t.pos >> l.level, 1)),
        proofs AS (
            SELECT row, string_agg(coalesce(digest, ''), '' ORDER BY upper, level) AS siblings,
                   list(CASE WHEN digest IS NULL THEN '*' WHEN child = 1 THEN digest || '*'
                             ELSE '*' || digest END ORDER BY upper, level) AS proof
            FROM steps GROUP BY row)
        SELECT doc_id, leaf, subroot, root, sha256(coalesce(siblings, '')) AS proof_sha256,
               list_reduce(list_prepend(claimed, coalesce(proof, [])),
                           lambda node, step: sha256(replace(step, '*', node))) AS folded_root,
               folded_root = root AS verified
        FROM places JOIN trees USING (tree) LEFT JOIN proofs USING (row),
             (SELECT digest AS root FROM tops WHERE n = 1)""",
    "op13_fill_in_middle": """
        WITH drawn AS (
            SELECT doc_id, coalesce(text, '') AS body, length(body) AS n,
                   sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
                   CAST('0x' || h[1:8] AS BIGINT) % (n + 1) AS h1,
                   CAST('0x' || h[9:16] AS BIGINT) % (n + 1) AS h2,
                   CAST('0x' || h[17:24] AS BIGINT) % 100 AS h3,
                   CAST('0x' || h[25:32] AS BIGINT) % 100 AS h4 FROM documents),
        formed AS (
            SELECT *, CASE WHEN n = 0 OR contains(body, '<P>') OR contains(body, '<S>')
                                OR contains(body, '<M>') OR h3 >= 90 THEN 'plain'
                           WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form,
                   least(h1, h2) AS a, greatest(h1, h2) AS b FROM drawn),
        parts AS (
            SELECT *, substr(body, 1, a) AS p, substr(body, a + 1, b - a) AS m, substr(body, b + 1) AS s
            FROM formed)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN body
                      WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                      ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
               sha256(body) AS restored_sha256
        FROM parts""",
}
