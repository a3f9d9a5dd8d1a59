"""The operators as queries over the driver's tables, and their SQL where it can say them."""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from promolens.llm import (
    byte_bpe,
    collocations,
    jaccard_join,
    language_id,
    license_scan,
    line_dedup,
    lz_fingerprint,
    packing,
    quality,
    speculative_bpe,
    suffix_dedup,
    treap_search,
    warc,
)
from promolens.llm.common import prepared

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(step: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: step(table(spark, sf_dir, "documents"))


def _quality(docs: DataFrame) -> DataFrame:
    judged = quality.quality_rules(docs)
    return judged.withColumn("n_removed_lines", F.size("removed_lines")).drop("removed_lines")


def _line_dedup(docs: DataFrame) -> DataFrame:
    return line_dedup.dedup_lines(docs).select(
        "doc_id", "source", "n_lines", "n_dropped", F.sha2("clean_text", 256).alias("clean_sha256")
    )


def _packing(docs: DataFrame) -> DataFrame:
    return packing.pack_documents(
        docs, packing.word_count(F.col("text")), packing.copy_cluster(F.col("text"))
    )


def _warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_round_trip(spark, table(spark, sf_dir, "pages"))


def _jaccard(docs: DataFrame) -> DataFrame:
    return jaccard_join.near_duplicates(docs).select("doc_id", "n_shingles", "component_id")


def _language_id(docs: DataFrame) -> DataFrame:
    labelled = language_id.predict(docs, language_id.fit(docs))
    return labelled.select("doc_id", "held_out", "lang_pred", "score")


def _byte_bpe(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    table = docs.sparkSession.sparkContext.broadcast(byte_bpe.token_table(ranks))

    def digests(batches):
        for batch in batches:
            lists = batch.column("ids")
            packed = [x.values.to_numpy().astype("<u4").tobytes() for x in lists]
            decoded = byte_bpe.decode_lists(lists, table.value)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(x) // 4 for x in packed], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in packed]),
                    pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    encoded = byte_bpe.encode(docs, ranks, public_tokenizers.PATTERN)
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return encoded.mapInArrow(digests, schema)


def _speculative_bpe(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    table = speculative_bpe.load_table(public_tokenizers.path("byte_bpe_50k.json"))
    shared = docs.sparkSession.sparkContext.broadcast(table)

    def digests(batches):
        spelled = list(map(str, range(shared.value.size)))
        for batch in batches:
            lists = batch.column("ids")
            ends = lists.offsets.to_numpy().tolist()
            words = list(map(spelled.__getitem__, lists.values.to_numpy().tolist()))
            joined = [",".join(words[a:b]).encode() for a, b in itertools.pairwise(ends)]
            decoded = [t.encode() for t in speculative_bpe.decode_texts(lists, shared.value)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([b - a for a, b in itertools.pairwise(ends)], pa.int64()),
                    pa.array([hashlib.sha256(x).hexdigest() for x in joined]),
                    pa.array([hashlib.sha256(x).hexdigest() for x in decoded]),
                ],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return speculative_bpe.encode(docs, table).mapInArrow(digests, schema)


def _treap_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = treap_search.build_index(table(spark, sf_dir, "documents"))
    return treap_search.search(index, table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Query] = {
    "op1_quality_rules": _documents(_quality),
    "op2_license_scan": _documents(license_scan.scan_licenses),
    "op3_lz_fingerprint": _documents(lz_fingerprint.compare_with_next),
    "op4_line_dedup": _documents(_line_dedup),
    "op5_packing": _documents(_packing),
    "op6_warc": _warc,
    "op7_jaccard_join": _documents(_jaccard),
    "op8_language_id": _documents(_language_id),
    "op9_byte_bpe": _documents(_byte_bpe),
    "op10_suffix_dedup": _documents(suffix_dedup.repeat_digests),
    "op11_speculative_bpe": _documents(_speculative_bpe),
    "op12_treap_search": _treap_search,
    "op13_collocations": _documents(collocations.collocations),
}


_WORD = r"[^\x20\x09-\x0D]+"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

SQL: dict[str, str] = {
    "op1_quality_rules": f"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS text FROM documents
), w AS (
  SELECT doc_id, text, regexp_extract_all(text, '{_WORD}') AS ws,
         string_split(text, chr(10)) AS ls FROM d
), base AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)
           AS word_chars,
         length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols
  FROM w
), word AS (
  SELECT doc_id, unnest(ws) AS x, unnest(range(1, len(ws) + 1)) AS i FROM w
), win AS (
  SELECT doc_id, i, x, lead(x, 1) OVER o AS y, lead(x, 2) OVER o AS z
  FROM word WINDOW o AS (PARTITION BY doc_id ORDER BY i)
), twice AS (
  SELECT doc_id, i FROM win WHERE z IS NOT NULL
  QUALIFY count(*) OVER (PARTITION BY doc_id, x, y, z) > 1
), rep AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY 1
), line AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM d
), dup AS (
  SELECT doc_id, sum(c - 1) AS n FROM (
    SELECT doc_id, line, count(*) AS c FROM line WHERE regexp_matches(line, '{_WORD}')
    GROUP BY ALL) GROUP BY 1
), norm AS (
  SELECT doc_id, source, regexp_extract_all(regexp_replace(translate(line, '{_UPPER}',
    '{_LOWER}'), '[1-9]', '0', 'g'), '{_WORD}') AS ws FROM line
), keyed AS (
  SELECT doc_id, source, array_to_string(ws, ' ') AS k, len(ws) AS c FROM norm WHERE len(ws) > 0
), hosts AS (
  SELECT source, count(*) AS n FROM documents GROUP BY 1
), above AS (
  SELECT k, keyed.source FROM keyed JOIN hosts ON keyed.source IS NOT DISTINCT FROM hosts.source
  GROUP BY k, keyed.source, hosts.n
  HAVING count(DISTINCT doc_id) >= {quality.MIN_DOCS}
     AND count(DISTINCT doc_id) > {quality.MAX_SHARE}::DOUBLE * hosts.n
), lost AS (
  SELECT doc_id, sum(c) AS n, count(*) AS lines FROM keyed JOIN above
    ON keyed.k = above.k AND keyed.source IS NOT DISTINCT FROM above.source GROUP BY 1
), done AS (
  SELECT doc_id, n_words, word_chars, n_symbols, coalesce(dup.n, 0) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, n_words - coalesce(lost.n, 0) AS n_words_left,
         coalesce(lost.lines, 0)::INTEGER AS n_removed_lines
  FROM base LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id)
       LEFT JOIN lost USING (doc_id)
), failed AS (
  SELECT *, n_words < {quality.MIN_WORDS}
    OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM done
)
SELECT *, NOT base_failed AND 100 * n_words_left >= {quality.MIN_LEFT_PERCENT} * n_words AS kept
FROM failed""",
    "op4_line_dedup": f"""
WITH line AS (
  SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line,
         unnest(range(1, len(string_split(text, chr(10))) + 1)) AS pos
  FROM documents
), keyed AS (
  SELECT *, lower(trim(line)) AS k FROM line
), hosts AS (
  SELECT source, count(*) AS n FROM documents GROUP BY 1
), bad AS (
  SELECT k, keyed.source FROM keyed JOIN hosts ON keyed.source IS NOT DISTINCT FROM hosts.source
  WHERE k <> '' GROUP BY k, keyed.source, hosts.n
  HAVING count(DISTINCT doc_id) >= {line_dedup.MIN_PAGES}
     AND count(DISTINCT doc_id) > {line_dedup.MAX_RATIO}::DOUBLE * hosts.n
), marked AS (
  SELECT doc_id, pos, line, bad.k IS NOT NULL AS gone FROM keyed LEFT JOIN bad
    ON keyed.k = bad.k AND keyed.source IS NOT DISTINCT FROM bad.source
), clean AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY 1
)
SELECT d.doc_id, d.source, coalesce(n, 0) AS n_lines, coalesce(dropped, 0) AS n_dropped,
       sha256(clean.text) AS clean_sha256
FROM documents d LEFT JOIN clean USING (doc_id)""",
    "op6_warc": f"""
WITH p AS (
  SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (
  SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p
), g AS (
  SELECT *, payload_bytes >= {warc.MIN_REVISIT_BYTES} AND page_id <> first_id AS again FROM f
)
SELECT page_id, payload_bytes, payload_digest, url AS target_uri,
       CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN first_id END AS refers_to
FROM g""",
    "op7_jaccard_join": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '{_WORD}') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN []
    WHEN len(ws) < 3 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 1), 
      lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])
    END) AS shingle FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY 1
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * c >= 90 * (x.n + y.n - c)
), e AS (
  SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r(node, root) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node
), c AS (
  SELECT node AS doc_id, min(root) AS component_id FROM r GROUP BY 1
)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, component_id
FROM documents JOIN c USING (doc_id) LEFT JOIN n USING (doc_id)""",
    "op12_treap_search": f"""
WITH held AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'),
    '{_TERM}')) AS term FROM documents
), sizes AS (
  SELECT doc_id, count(*) AS n FROM held GROUP BY 1
), corpus AS (
  SELECT count(*) AS docs, sum(n)::BIGINT AS terms FROM sizes
), asked AS (
  SELECT item_id, term, count(*) AS k FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}',
      '{_LOWER}'), '{_TERM}')) AS term FROM benchmark) GROUP BY ALL
), tf AS (
  SELECT doc_id, term, count(*) AS tf FROM held SEMI JOIN asked USING (term) GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM tf, corpus GROUP BY term, docs
), worth AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf
           + 12 * (100 - 25 + ((25 * n * docs) // terms)))) AS x
  FROM tf JOIN sizes USING (doc_id) JOIN weights USING (term), corpus
), scored AS (
  SELECT item_id, doc_id, sum(k * x)::BIGINT AS score FROM asked JOIN worth USING (term)
  GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER
         AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= {treap_search.TOP}""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
