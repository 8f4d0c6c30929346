"""The registered query of each operator: its rows in the form that is agreed for them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coursetide.llm import (
    bpe,
    decontaminate,
    html_text,
    langid,
    pii,
    prefix_trie,
    quality,
    repair,
    secrets,
    simhash,
    spotsigs,
    substrings,
    toxicity,
)
from coursetide.llm.inputs import cut_lineage, in_fold, read

RANKS = "byte_bpe_50k.tiktoken"
#: For tests only: whoever runs this on personal data takes a key of their own.
PII_KEY = "not a secret"


#: All windows that hold a shingle of an item, compared with it outright. A document of fewer shingles is one window.
_OP2 = r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM documents),
items AS (
  SELECT item_id, w, least(5, len(w)) AS k FROM (
    SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') AS w FROM benchmark) WHERE len(w) > 0),
item_shingles AS (
  SELECT item_id, k, a, s, count(*) AS times FROM (
    SELECT item_id, k, len(w) - k + 1 AS a, array_to_string(w[p : p + k - 1], ' ') AS s FROM (
      SELECT item_id, k, w, unnest(range(1, len(w) - k + 2)) AS p FROM items)) GROUP BY ALL),
doc_shingles AS (
  SELECT doc_id, k, len(w) - k + 1 AS b, p, array_to_string(w[p : p + k - 1], ' ') AS s FROM (
    SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS p FROM doc_words, (SELECT DISTINCT k FROM items))),
hits AS (
  SELECT doc_id, b, p, item_id, a, least(a, b) AS size, k, s, times
  FROM doc_shingles JOIN item_shingles USING (k, s)),
starts AS (
  SELECT DISTINCT doc_id, item_id, size, start FROM (
    SELECT doc_id, item_id, size, b, unnest(range(greatest(1, p - size + 1), p + 1)) AS start FROM hits)
  WHERE start + size - 1 <= b),
common AS (
  SELECT doc_id, item_id, start, size, a, CAST(sum(least(found, times)) AS BIGINT) AS met FROM (
    SELECT doc_id, item_id, start, starts.size, h.s, any_value(a) AS a, any_value(times) AS times, count(*) AS found
    FROM starts JOIN hits AS h USING (doc_id, item_id) WHERE p BETWEEN start AND start + starts.size - 1
    GROUP BY doc_id, item_id, start, starts.size, h.s) GROUP BY doc_id, item_id, start, size, a),
alike AS (
  SELECT doc_id, item_id, start, met / (a + size - met) AS similarity FROM common WHERE met / (a + size - met) >= 0.8)
SELECT doc_id, item_id, CAST(arg_min(start, (-similarity, start)) AS INTEGER) AS start,
  round(max(similarity), 6) AS similarity
FROM alike GROUP BY doc_id, item_id"""


#: Every window, and every word of a window that also starts in a document of a smaller id.
_OP9 = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, p, md5(array_to_string(w[p : p + 49], ' ')) AS h FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM docs)),
sources AS (SELECT h, min(doc_id) AS source FROM windows GROUP BY h),
gone AS (
  SELECT DISTINCT doc_id, unnest(range(p, p + 50)) AS p FROM windows JOIN sources USING (h) WHERE source < doc_id),
placed AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM docs),
kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)"""


#: CRC-32 of text of ASCII characters, bit by bit: each byte is put in and followed by eight shifts.
_CRC = """xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split({0}, ''),
    lambda ch: list_prepend(CAST(ascii(ch) AS BIGINT), [CAST(-1 AS BIGINT) for _ in range(8)])))),
  lambda c, x: CASE WHEN x >= 0 THEN xor(c, x) WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END), 4294967295)"""


#: Every beginning of every rebuilt conversation as a list of its turns, grouped.
_OP12 = f"""
WITH own AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
hashed AS (SELECT conv_id, t, {_CRC.format("CAST(conv_id AS VARCHAR)")} % 9 AS h FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(p.t[1:c.h], []), c.t[c.h + 1:]) AS t
  FROM hashed AS c LEFT JOIN own AS p ON p.conv_id = c.conv_id - c.conv_id % 5),
nodes AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n, any_value(coalesce(strlen(k[d].t), 0)) AS bytes,
    coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (d = size), '') AS ends
  FROM (SELECT conv_id, len(t) AS size, d, t[1:d] AS k FROM (SELECT conv_id, t, unnest(range(0, len(t) + 1)) AS d FROM rebuilt))
  GROUP BY k, d),
children AS (SELECT k[1:d - 1] AS k, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY 1),
trees AS (
  SELECT k, sum((n - 1) * bytes) AS saved, count(*) FILTER (leaf) AS leaves FROM (
    SELECT nodes.k[1:a] AS k, n, bytes, leaf FROM (
      SELECT nodes.k, n, bytes, n_children IS NULL AS leaf, unnest(range(0, d + 1)) AS a
      FROM nodes LEFT JOIN children ON nodes.k = children.k) AS nodes) GROUP BY k)
SELECT v.conv_id, v.d AS depth, u.conv_id AS parent_conv_id, v.n AS n_convs, coalesce(n_children, 0) AS n_children,
  leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(v.ends) AS ends_sha256
FROM nodes AS v JOIN trees ON v.k = trees.k LEFT JOIN children ON v.k = children.k
LEFT JOIN nodes AS u ON v.d > 0 AND u.k = v.k[1:v.d - 1]"""


def op1_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).withColumn("n_chars", F.length("text").cast("long"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"), short=True)
    return found.select("doc_id", "item_id", "start", F.round("similarity", 6).alias("similarity"))


def op3_pii_feistel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymise(docs, PII_KEY, count="n_replaced")


def op4_cross_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = in_fold("doc_id", 3, 1)
    sample = langid.learn(docs.where(~held_out))
    found = langid.identify(docs.select("doc_id", "text"), sample)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.with_neighbours(read(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, pattern = public_tokenizers.path(RANKS), public_tokenizers.PATTERN
    encoded = bpe.encode(read(spark, sf_dir, "documents"), path, pattern)
    return bpe.decode(encoded, path).select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_bradley_terry(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels")
    ranking = quality.learn(docs, labels.where(~in_fold("doc_id", 3, 1)))
    scored = quality.score(docs, ranking)
    return scored.select(
        "doc_id",
        in_fold("doc_id", 3, 1).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    prints = cut_lineage(simhash.fingerprints(read(spark, sf_dir, "documents")))
    return simhash.near_duplicates(prints).select(
        "doc_id",
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )


def op9_de_bruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    kept = substrings.without_repeats(docs, substrings.repeated(docs))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_clause_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.learn(docs, read(spark, sf_dir, "labels").where(~in_fold("doc_id", 4, 2)))
    return toxicity.score(docs, model).select(
        "doc_id",
        in_fold("doc_id", 4, 2).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op11_branch_and_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repair.audits(repair.damaged(read(spark, sf_dir, "conversations")), counted=True)
    return found.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"
    )


def op12_z_fast_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = prefix_trie.own_turns(read(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_nodes(prefix_trie.with_shared_beginnings(own))


def op13_decoding_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secrets(read(spark, sf_dir, "documents"))

    def listed(spans: str) -> F.Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def number(kind: str) -> F.Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.sha2(listed("base"), 256).alias("base_sha256")
    return found.select("doc_id", *map(number, secrets.KINDS), base, listed("spans").alias("spans"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    registered = (
        op1_text_density,
        op2_decontaminate,
        op3_pii_feistel,
        op4_cross_parsing,
        op5_spotsigs,
        op6_byte_bpe,
        op7_bradley_terry,
        op8_simhash,
        op9_de_bruijn,
        op10_clause_grammar,
        op11_branch_and_bound,
        op12_z_fast_trie,
        op13_decoding_worklist,
    )
    return {query.__name__: query for query in registered}


def oracle_sql() -> dict[str, str]:
    return {"op2_decontaminate": _OP2, "op9_de_bruijn": _OP9, "op12_z_fast_trie": _OP12}
