"""Registered queries of this package and their SQL."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartlake.llm import (
    bpe,
    conversation_trie,
    exact_dedup,
    line_dedup,
    merkle,
    mixing,
    passage_dedup,
    quality,
    sharding,
    simhash,
    suffix_dedup,
    url_filter,
    vector_dedup,
)
from cartlake.llm.common import ship
from cartlake.sources.scratch import materialize

SHARDS = 24
TOKENIZERS = os.environ.get("TOKENIZER_FOLDER", "/opt/tokenizers")
VOCABULARY = "byte_bpe_50k.json"

# A leaf whose id's checksum is a multiple of this counts as changed.
CHANGED_EVERY = 5

URL_RULES = (
    url_filter.Rule("allow", "org", "/"),
    url_filter.Rule("block", "example.org", "/es/"),
    url_filter.Rule("block", "example.org", "/en/1"),
    url_filter.Rule("allow", "com", "/fr/"),
    url_filter.Rule("block", "com", "/de/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that are on five sources or more."""
    clean = line_dedup.remove_boilerplate(_table(spark, sf_dir, "documents"))
    return clean.select(
        "doc_id", "source", "n_lines", "n_removed", F.sha2("clean_text", 256).alias("clean_sha256"), "clean_text"
    )


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"),
        "keep_id",
        "group_size",
        "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = passage_dedup.shared_passages(_table(spark, sf_dir, "documents"))
    return found.withColumnsRenamed({"id": "doc_id", "other_id": "other_doc_id"})


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op7_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))
    return left.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = bpe.read_spec(f"{TOKENIZERS}/{VOCABULARY}")
    coded = bpe.encode_documents(_table(spark, sf_dir, "documents"), spec, summary=True)
    return coded.withColumnRenamed("id", "doc_id")


def op9_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_dedup.near_vectors(_table(spark, sf_dir, "embeddings"))
    return found.withColumnRenamed("id", "vec_id")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, _table(spark, sf_dir, "labels"))
    graded = quality.grade_documents(docs.select("doc_id", "text"), model)
    return graded.drop("text")


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, some of which are folded from a changed leaf."""
    docs = _table(spark, sf_dir, "documents")
    picked = F.crc32(F.col("doc_id").cast("string").cast("binary")) % CHANGED_EVERY == 0
    changed = merkle.leaf_digest(text=merkle.lower_ascii(F.col("text")))
    manifest = merkle.build(docs, carry={"changed": F.when(picked, changed)})
    proved = merkle.proofs(manifest, ("changed",))
    return proved.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        merkle.proof_digest().alias("proof_sha256"),
        merkle.fold(F.coalesce("changed", "leaf")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = conversation_trie.order_turns(_table(spark, sf_dir, "conversations"))
    turns, convs = conversation_trie.rebuild(ordered)
    nodes, _ = conversation_trie.trie(turns, materialize(convs, "conversations")[0])
    return nodes.drop("k1", "k2").withColumnRenamed("saved_chars", "saved_tokens")


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdicts on all pages. Labels carry ids of documents and are read as those of the page of that id."""
    labels = _table(spark, sf_dir, "labels")
    outcomes = labels.select(F.col("doc_id").alias("id"), F.expr("quality = 0 OR toxic = 1").alias("bad"))
    judged = url_filter.judge(_table(spark, sf_dir, "pages"), outcomes, URL_RULES)
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "n", "bad")


QUERIES = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_simhash,
        op3_exact_dedup,
        op4_sharding,
        op5_passages,
        op6_mixing,
        op7_suffix_array,
        op8_bpe,
        op9_vectors,
        op10_quality,
        op11_merkle,
        op12_conversation_trie,
        op13_url_filter,
    )
}

# CRC-32 of a number written in decimal digits, bit by bit.
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(string_split({}::VARCHAR, ''), lambda digit: ord(digit)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
        lambda bits, step: xor(bits >> 1, 3988292384 * (bits & 1)))))"""


def _leaf(text: str) -> str:
    """SHA-256 of the fields of a document in SQL."""
    field = "CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}::VARCHAR) || ':' || {0}::VARCHAR END"
    return f"sha256({' || '.join(field.format(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"


def _rules() -> str:
    return ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)


def _estimate(level: str, above: str, on: str) -> str:
    """A level's counts with prior, weight and posterior mean in SQL."""
    return f"""
        {level}_p AS (SELECT c.*, a.mean AS prior FROM {level} c JOIN {above} a ON {on}),
        {level}_w AS (SELECT 1 / least(greatest(coalesce(
            sum((bad - n * prior) ** 2 - n * prior * (1 - prior))
                / nullif(sum(n::DOUBLE * (n - 1) * prior * (1 - prior)), 0), {url_filter.MOST_SPREAD}),
            {url_filter.LEAST_SPREAD}::DOUBLE), {url_filter.MOST_SPREAD}::DOUBLE) - 1 AS weight FROM {level}_p),
        {level}_e AS (SELECT *, (bad + weight * prior) / (n + weight) AS mean FROM {level}_p, {level}_w)"""


ORACLES = {
    "op1_line_dedup": f"""
        WITH lines AS (
            SELECT doc_id, source, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS pos
            FROM documents
        ), spread AS (
            SELECT trim(line, ' ') AS bare FROM lines WHERE trim(line, ' ') <> ''
            GROUP BY 1 HAVING count(DISTINCT source) >= {line_dedup.MIN_SITES}
        ), marked AS (
            SELECT l.*, s.bare IS NOT NULL AS bad
            FROM lines l LEFT JOIN spread s ON trim(l.line, ' ') = s.bare
        ), clean AS (
            SELECT doc_id, any_value(source) AS source, count(*) AS n_lines,
                count(*) FILTER (WHERE bad) AS n_removed,
                coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT bad), '') AS clean_text
            FROM marked GROUP BY doc_id
        )
        SELECT doc_id, source, n_lines, n_removed, sha256(clean_text) AS clean_sha256, clean_text FROM clean
    """,
    "op3_exact_dedup": """
        WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
            doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY text)
    """,
    "op6_mixing": f"""
        WITH t AS (
            SELECT doc_id, source, coalesce(text, '') AS text,
                len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
            FROM documents
        ), d AS (
            SELECT doc_id, source, size, text,
                -ln((('0x' || substr(md5(concat_ws(':', doc_id::VARCHAR, md5(text))), 1, 13))::BIGINT + 1)
                    / {1 << 52}::DOUBLE)
                / (1 / (1 + abs((length(text) - size) / greatest(size, 1) - 5) / 5)) AS key,
                sum(size) OVER (PARTITION BY source) AS source_size
            FROM t
        ), sources AS (
            SELECT source, sum(size) AS source_size,
                CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
                    WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w,
                row_number() OVER (ORDER BY source NULLS LAST) AS turn
            FROM t GROUP BY source
        ), levels AS (
            SELECT *, 2 * source_size AS most,
                (1.5::DOUBLE * sum(source_size) OVER ()
                    - coalesce(sum(2 * source_size) OVER (up ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                / sum(w) OVER (up ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM sources WINDOW up AS (ORDER BY 2 * source_size / w, turn)
        ), targets AS (
            SELECT source, CASE WHEN most <= level * w THEN most::DOUBLE
                ELSE (SELECT arg_min(level, (most / w, turn)) FROM levels WHERE most > level * w) * w END AS target
            FROM levels
        ), cut AS (
            SELECT d.*, target,
                CASE WHEN d.source_size > 0 THEN floor(target / d.source_size)::BIGINT ELSE 0 END AS whole,
                coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY key, doc_id, md5(text)
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
            FROM d JOIN targets g ON d.source IS NOT DISTINCT FROM g.source
        )
        SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
            (size * (whole + CASE WHEN size > 0 AND before + size / 2 <= target - whole * source_size
                THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM cut
    """,
    "op11_merkle": f"""
        WITH RECURSIVE leaves AS (
            SELECT doc_id, source, {_leaf('text')} AS leaf,
                CASE WHEN {_CRC32.format('doc_id')} % {CHANGED_EVERY} = 0
                    THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}
                    END AS changed,
                row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS i,
                count(*) OVER (PARTITION BY source) AS n
            FROM documents
        ), tree AS (
            SELECT source, 0 AS level, i, n, leaf AS digest FROM leaves
            UNION ALL
            SELECT source, level + 1, i // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY i))
            FROM tree WHERE n > 1 GROUP BY source, level, i // 16
        ), subroots AS (
            SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n
            FROM tree WHERE n = 1
        ), top AS (
            SELECT 0 AS level, i, n, digest FROM subroots
            UNION ALL
            SELECT level + 1, i // 16, (any_value(n) + 15) // 16, sha256(string_agg(digest, '' ORDER BY i))
            FROM top WHERE n > 1 GROUP BY level, i // 16
        ), frames AS (
            SELECT source, level, i, i // 16 AS run,
                coalesce(string_agg(digest, '' ORDER BY i) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '')
                    AS l,
                coalesce(string_agg(digest, '' ORDER BY i) OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')
                    AS r
            FROM tree WHERE n > 1 WINDOW r AS (PARTITION BY source, level, i // 16 ORDER BY i)
        ), top_frames AS (
            SELECT level, i,
                coalesce(string_agg(digest, '' ORDER BY i) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '')
                    AS l,
                coalesce(string_agg(digest, '' ORDER BY i) OVER (r ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '')
                    AS r
            FROM top WHERE n > 1 WINDOW r AS (PARTITION BY level, i // 16 ORDER BY i)
        ), ways AS (
            SELECT l.doc_id, l.leaf, l.changed, s.digest AS subroot,
                (SELECT digest FROM top WHERE n = 1) AS root,
                list_concat(
                    coalesce((SELECT list({{'l': f.l, 'r': f.r}} ORDER BY f.level) FROM frames f
                        WHERE f.source IS NOT DISTINCT FROM l.source AND f.i = l.i // (16 ** f.level)::BIGINT), []),
                    coalesce((SELECT list({{'l': f.l, 'r': f.r}} ORDER BY f.level) FROM top_frames f
                        WHERE f.i = s.i // (16 ** f.level)::BIGINT), [])) AS way
            FROM leaves l JOIN subroots s ON s.source IS NOT DISTINCT FROM l.source
        ), folded AS (
            SELECT *, sha256(list_aggregate(list_transform(way, lambda f: f.l || f.r), 'string_agg', '')) AS proof_sha256,
                list_reduce(list_prepend({{'l': '', 'r': coalesce(changed, leaf)}}, way),
                    lambda acc, f: {{'l': '', 'r': sha256(f.l || acc.r || f.r)}}).r AS folded_root
            FROM ways
        )
        SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
    """,
    "op12_conversation_trie": f"""
        WITH t AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS i
            FROM conversations WHERE conv_id IS NOT NULL
        ), sizes AS (
            SELECT c, count(*) AS n, {_CRC32.format('c')} % {conversation_trie.HEADS} AS h FROM t GROUP BY c
        ), convs AS (
            SELECT s.c, s.h, s.c - s.c % {conversation_trie.BLOCK} AS base, least(s.h, coalesce(b.n, 0)) AS head
            FROM sizes s LEFT JOIN sizes b ON b.c = s.c - s.c % {conversation_trie.BLOCK}
        ), turns AS (
            SELECT v.c, t.i - v.h + v.head AS i, role, text FROM convs v JOIN t ON t.c = v.c AND t.i >= v.h
            UNION ALL
            SELECT v.c, t.i, role, text FROM convs v JOIN t ON t.c = v.base AND t.i < v.h
        ), places AS (
            SELECT c, 0 AS depth, [] AS path, '' AS text FROM convs
            UNION ALL
            SELECT c, i + 1, list(md5(strlen(role) || ':' || role || text)) OVER (
                PARTITION BY c ORDER BY i ROWS UNBOUNDED PRECEDING), text FROM turns
        ), lengths AS (
            SELECT c, max(depth) AS n FROM places GROUP BY c
        ), nodes AS (
            SELECT depth, path, min(p.c) AS conv_id, count(*) AS n_convs, any_value(length(text)) AS chars,
                string_agg(p.c::VARCHAR, ',' ORDER BY p.c) FILTER (WHERE depth = n) AS ends
            FROM places p JOIN lengths l ON p.c = l.c GROUP BY depth, path
        ), kids AS (
            SELECT depth - 1 AS depth, path[1:depth - 1] AS path, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL
        ), kin AS (
            SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON n.depth = k.depth AND n.path = k.path
        ), above AS (
            SELECT unnest(range(depth + 1)) AS depth, path, n_children, (n_convs - 1) * chars AS saved FROM kin
        ), below AS (
            SELECT depth, path[1:depth] AS path, count(*) FILTER (WHERE n_children = 0) AS n_leaves, sum(saved) AS saved
            FROM above GROUP BY ALL
        )
        SELECT k.conv_id, k.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, k.n_convs, k.n_children, b.n_leaves,
            b.saved::BIGINT AS saved_tokens, sha256(coalesce(k.ends, '')) AS ends_sha256
        FROM kin k JOIN below b ON k.depth = b.depth AND k.path = b.path
            LEFT JOIN nodes u ON u.depth = k.depth - 1 AND u.path = k.path[1:k.depth - 1]
    """,
    "op13_url_filter": f"""
        WITH rules AS (
            SELECT * FROM (VALUES {_rules()}) r(verdict, host, path)
        ), urls AS (
            SELECT page_id, CASE WHEN contains(url, '://') THEN url[strpos(url, '://') + 3:] ELSE '' END AS rest FROM pages
        ), places AS (
            SELECT page_id, lower(regexp_extract(rest, '^([^/?#]*)', 1)) AS host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
            FROM urls
        ), labelled AS (
            SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE quality = 0 OR toxic = 1) AS bad FROM labels
            WHERE doc_id IS NOT NULL AND (quality = 0 OR toxic = 1) IS NOT NULL GROUP BY doc_id
        ), hosts AS (
            SELECT host, string_split(host, '.')[-1] AS suffix, array_to_string(string_split(host, '.')[-2:], '.') AS domain,
                coalesce(sum(n), 0)::BIGINT AS n, coalesce(sum(bad), 0)::BIGINT AS bad
            FROM places LEFT JOIN labelled ON page_id = doc_id GROUP BY host
        ), domains AS (
            SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM hosts GROUP BY ALL
        ), suffixes AS (
            SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM domains GROUP BY ALL
        ), everywhere AS (
            SELECT (sum(bad) + 0.5::DOUBLE) / (sum(n) + 1) AS mean FROM suffixes
        ), {_estimate('suffixes', 'everywhere', 'true')}, {_estimate('domains', 'suffixes_e', 'a.suffix = c.suffix')},
        {_estimate('hosts', 'domains_e', 'a.suffix = c.suffix AND a.domain = c.domain')},
        known AS (
            SELECT host, n, bad, mean - {url_filter.DEVIATIONS}::DOUBLE * sqrt(mean * (1 - mean) / (n + weight + 1))
                <= {url_filter.MAX_BAD} AS kept
            FROM hosts_e
        ), ruled AS (
            SELECT u.host, u.path, arg_min(r.host || r.path, (-length(r.host || r.path), r.host || r.path)) AS rule,
                arg_min(r.verdict, (-length(r.host || r.path), r.host || r.path)) AS verdict
            FROM (SELECT DISTINCT host, path FROM places) u
            JOIN rules r ON starts_with(u.path, r.path) AND ends_with('.' || u.host, '.' || r.host)
            GROUP BY ALL
        )
        SELECT page_id, p.host, p.path, rule, coalesce(r.verdict, if(kept, 'allow', 'block')) AS verdict, n, bad
        FROM places p JOIN known k ON p.host = k.host LEFT JOIN ruled r ON r.host = p.host AND r.path = p.path
    """,
}
