"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import (
    bpe,
    decontaminate,
    exact_dedup,
    jaccard_join,
    line_dedup,
    merkle,
    pii,
    prefix_trie,
    quality,
    secrets,
    simhash,
    token_counts,
    warc,
)
from gaugeworks.llm.common import table
from gaugeworks.session import written


def op1_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secrets.secret_spans(docs, secrets.infer(docs))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    made = written(quality.feature_table(docs), "features")
    ranking = quality.learn(docs, labels.filter(~quality.held_out(labels["doc_id"])), made=made)
    scored = quality.quality_scores(docs, ranking, made=made)
    return scored.withColumn("held_out", quality.held_out(scored["doc_id"]))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), path)


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archive = warc.write_archive(table(spark, sf_dir, "pages"))
    return warc.described(warc.read_archive(spark, archive))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256")
    return docs.select("doc_id", "n_lines", "n_dropped", digest)


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.bpe_digests(table(spark, sf_dir, "documents"), path)


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.contaminated(docs, items).drop("text_key")


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_classes(table(spark, sf_dir, "documents"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    changed = merkle.one_more_where(docs["n_chars"], docs["doc_id"])
    return merkle.manifest(docs, tampered={"n_chars": changed})


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.conversations(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie_nodes(prefix_trie.rebuilt(written(own, "conversations")))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        op1_secrets,
        op2_quality,
        op3_token_counts,
        op4_exact_dedup,
        op5_warc,
        op6_jaccard_join,
        op7_line_dedup,
        op8_pii,
        op9_bpe,
        op10_decontaminate,
        op11_simhash,
        op12_merkle,
        op13_prefix_trie,
        pipeline,
    )
    return {f.__name__: f for f in registered}


def _crc32(digits: str) -> str:
    """The unsigned CRC-32 of ASCII text in SQL, bit by bit."""
    bits = f"list_transform(range(8 * length({digits})), lambda k: (ascii(substr({digits}, k // 8 + 1, 1)) >> (k % 8)) & 1)"
    step = "xor(a >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384 ELSE 0 END)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}), lambda a, b: {step}), 4294967295)"


def _field(column: str) -> str:
    text = f"({column})::VARCHAR"
    return f"coalesce(octet_length(encode({text})) || ':' || {text}, '-')"


def _climb(name: str, source: str, group: str) -> str:
    """A recursive table of a tree's nodes: level, place, nodes of the level, digest."""
    return f"""{name} AS (
              SELECT {group}, 0 AS lvl, r AS i, n, d FROM {source}
              UNION ALL
              SELECT {group}, lvl + 1, i // 2, (n + 1) // 2, sha256(string_agg(d, '' ORDER BY i))
              FROM {name} WHERE n > 1 GROUP BY {group}, lvl, i // 2, n)"""


def _merkle_oracle() -> str:
    n_chars = f"CASE WHEN {_crc32('doc_id::VARCHAR')} % 7 = 0 THEN n_chars + 1 ELSE n_chars END"
    own, shown = (
        " || ".join(_field(c) for c in ("doc_id", "source", "lang", n, "text")) for n in ("n_chars", n_chars)
    )
    step = "CASE WHEN s.d IS NULL THEN '0' WHEN (x.r >> k.lvl) & 1 = 0 THEN '1' || s.d ELSE '2' || s.d END"
    return f"""
            WITH RECURSIVE digests AS (
              SELECT coalesce('1' || lang, '0') AS g, doc_id, sha256({own}) AS d, sha256({shown}) AS shown
              FROM documents),
            leaf AS (
              SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, d, shown) - 1 AS r,
                count(*) OVER (PARTITION BY g) AS n
              FROM digests),
            {_climb("tree", "leaf", "g")},
            sub AS (
              SELECT g, '' AS a, d, row_number() OVER (ORDER BY g) - 1 AS r, count(*) OVER () AS n
              FROM tree WHERE n = 1),
            {_climb("crown", "sub", "a")},
            low AS (
              SELECT x.g, x.r, list({step} ORDER BY k.lvl) AS p
              FROM leaf x JOIN (SELECT DISTINCT g, lvl FROM tree WHERE n > 1) k USING (g)
              LEFT JOIN tree s ON s.g = x.g AND s.lvl = k.lvl AND s.i = xor(x.r >> k.lvl, 1)
              GROUP BY ALL),
            high AS (
              SELECT x.g, list({step} ORDER BY k.lvl) AS p
              FROM sub x CROSS JOIN (SELECT DISTINCT lvl FROM crown WHERE n > 1) k
              LEFT JOIN crown s ON s.lvl = k.lvl AND s.i = xor(x.r >> k.lvl, 1)
              GROUP BY ALL),
            paths AS (
              SELECT leaf.*, sub.d AS subroot, list_concat(coalesce(low.p, []), coalesce(high.p, [])) AS p,
                (SELECT d FROM crown WHERE n = 1) AS root
              FROM leaf JOIN sub USING (g) LEFT JOIN low ON low.g = leaf.g AND low.r = leaf.r
              LEFT JOIN high ON high.g = leaf.g),
            folds AS (
              SELECT *, list_reduce(list_prepend(shown, p), lambda acc, x:
                CASE x[1] WHEN '0' THEN sha256(acc) WHEN '1' THEN sha256(acc || x[2:]) ELSE sha256(x[2:] || acc) END
              ) AS folded_root
              FROM paths)
            SELECT doc_id, d AS leaf, subroot, root,
              sha256(array_to_string(list_transform(p, lambda x: x[2:]), '')) AS proof_sha256,
              folded_root, folded_root = root AS verified
            FROM folds"""


def _trie_oracle() -> str:
    return f"""
            WITH own AS (
              SELECT conv_id, turn, coalesce(role, '') AS role, octet_length(encode(coalesce(text, ''))) AS bytes,
                sha256(octet_length(encode(coalesce(role, ''))) || ':' || coalesce(role, '') || coalesce(text, '')) AS symbol
              FROM conversations WHERE conv_id IS NOT NULL),
            turns AS (
              SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, symbol) AS pos FROM own),
            sizes AS (SELECT conv_id, count(*) AS n FROM turns GROUP BY 1),
            plans AS (
              SELECT conv_id, conv_id - conv_id % 5 AS base, {_crc32("conv_id::VARCHAR")} % 9 AS h FROM sizes),
            made AS (
              SELECT p.conv_id, t.pos AS d, t.symbol, t.bytes
              FROM plans p JOIN turns t ON t.conv_id = p.base AND t.pos <= p.h
              UNION ALL
              SELECT p.conv_id, t.pos - p.h + least(p.h, coalesce(b.n, 0)), t.symbol, t.bytes
              FROM plans p JOIN turns t ON t.conv_id = p.conv_id AND t.pos > p.h
              LEFT JOIN sizes b ON b.conv_id = p.base),
            strings AS (
              SELECT p.conv_id, coalesce(list(m.symbol ORDER BY m.d) FILTER (m.d IS NOT NULL), []) AS s
              FROM plans p LEFT JOIN made m USING (conv_id) GROUP BY 1),
            prefixes AS (
              SELECT conv_id, d, sha256(array_to_string(s[1:d], ',')) AS k, len(s) = d AS ends
              FROM strings, unnest(range(len(s) + 1)) AS u(d)),
            nodes AS (
              SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs,
                sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
              FROM prefixes GROUP BY 1, 2),
            linked AS (
              SELECT n.*, up.k AS up_k, coalesce(n.n_convs - 1, 0) * coalesce(m.bytes, 0) AS saved
              FROM nodes n LEFT JOIN prefixes up ON up.conv_id = n.conv_id AND up.d = n.d - 1
              LEFT JOIN made m ON m.conv_id = n.conv_id AND m.d = n.d),
            kids AS (SELECT d - 1 AS d, up_k AS k, count(*) AS n_children FROM linked WHERE d > 0 GROUP BY ALL),
            told AS (
              SELECT l.*, coalesce(c.n_children, 0) AS n_children
              FROM linked l LEFT JOIN kids c ON c.d = l.d AND c.k = l.k),
            sums AS (
              SELECT p.d, p.k, sum(t.saved)::BIGINT AS saved_tokens, count(*) FILTER (t.n_children = 0) AS n_leaves
              FROM told t JOIN prefixes p ON p.conv_id = t.conv_id AND p.d <= t.d GROUP BY 1, 2)
            SELECT t.conv_id, t.d AS depth, up.conv_id AS parent_conv_id, t.n_convs, t.n_children, s.n_leaves,
              s.saved_tokens, t.ends_sha256
            FROM told t JOIN sums s ON s.d = t.d AND s.k = t.k
            LEFT JOIN nodes up ON up.d = t.d - 1 AND up.k = t.up_k"""


def all_oracles() -> dict[str, str]:
    return {
        "op4_exact_dedup": r"""
            WITH own AS (
              SELECT doc_id, sha256(regexp_replace(coalesce(text, ''),
                '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
              FROM documents),
            g AS (
              SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size
              FROM own GROUP BY 1)
            SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
            FROM own JOIN g USING (text_sha256)""",
        "op12_merkle": _merkle_oracle(),
        "op13_prefix_trie": _trie_oracle(),
    }
