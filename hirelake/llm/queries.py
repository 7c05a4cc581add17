"""The registered queries of the dealt operators and their DuckDB twins."""

import zlib

import numpy as np
from public_tokenizers import path as tokenizer_path
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hirelake.llm.boosting import judge_documents, train_rules
from hirelake.llm.chat import format_conversations, read_formatted
from hirelake.llm.cotraining import score_documents, train_quality
from hirelake.llm.fingerprints import fingerprint_documents
from hirelake.llm.manifest import FANOUT, leaf_digest, merkle_manifest
from hirelake.llm.mixing import mix_sources
from hirelake.llm.packing import Limits, pack_documents
from hirelake.llm.parity import jaccard_components
from hirelake.llm.pii import KINDS, find_personal_data, spans_text
from hirelake.llm.repeats import remove_repeats
from hirelake.llm.runs import periodic_runs
from hirelake.llm.subspace import near_components
from hirelake.llm.wavelet import read_shards, write_shards
from hirelake.scratch import materialise, scratch_path

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_documents(_table(spark, sf_dir, "documents"))


@query
def op10_mixed_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(_table(spark, sf_dir, "documents"), (5, 2, 1), 1.5, 2)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query
def op3_wavelet_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "wavelet")
    write_shards(
        _table(spark, sf_dir, "documents"), path, tokenizer_path("word_bpe_49k.json"), 2, 16, by_word=True
    )
    return read_shards(spark, path)


@query
def op7_packed_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return pack_documents(docs, tokenizer_path("word_bpe_49k.json"), 1, Limits(2048, 64, 2048), by_word=True)


@query
def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_table(spark, sf_dir, "documents"), 4, 85)


@query
def op2_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(_table(spark, sf_dir, "embeddings"), 0.9)


@query
def op4_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(_table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[count(k) for k in KINDS],
        F.sha2(spans_text(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        spans_text(F.col("spans")).alias("spans"),
    )


@query
def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    turns = _table(spark, sf_dir, "conversations").select(more.columns).unionByName(more)
    return read_formatted(materialise(format_conversations(turns), "formatted"))


@query
def op9_quality_cotraining(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return score_documents(docs, train_quality(docs, _table(spark, sf_dir, "labels")))


@query
def op8_repeat_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(_table(spark, sf_dir, "documents"), 100)


@query
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    text, upper = F.col("text"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    rest = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    shown = F.when(tampered, leaf_digest([*rest, F.translate(text, upper, upper.lower())]))
    return merkle_manifest(docs, leaf_digest([*rest, text]), shown)


def planted_period(doc_id: int | None, n: int) -> np.ndarray | None:
    """In one document of ten the words from some place on repeat a beginning of them."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 or not n:
        return None
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    i = np.arange(n)
    return np.where(i >= a, a + (i - a) % p, i)


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(_table(spark, sf_dir, "documents"), planted_period, texts=False)
    return found.drop("runs", "collapsed")


@query
def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return judge_documents(docs, train_rules(docs, _table(spark, sf_dir, "labels")))


# Smallest node reachable over the links (a, b), both directions.
_REACHED = """reached AS (
  SELECT {id} AS a, {id} AS b FROM {nodes}
  UNION SELECT r.a, l.b FROM reached r
    JOIN (SELECT a, b FROM links UNION ALL SELECT b, a FROM links) l ON l.a = r.b),
component AS (SELECT a, min(b) AS component_id FROM reached GROUP BY a)"""

ORACLES["op2_embedding_join"] = f"""WITH RECURSIVE
fine AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
  WHERE len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (SELECT x.vec_id AS a, y.vec_id AS b FROM fine x JOIN fine y
  ON x.vec_id < y.vec_id AND len(x.v) = len(y.v) AND list_cosine_similarity(x.v, y.v) >= 0.9),
{_REACHED.format(id="vec_id", nodes="embeddings")}
SELECT vec_id, (SELECT count(*) FROM links WHERE vec_id IN (links.a, links.b)) AS n_links,
  component_id, vec_id = component_id AS kept
FROM embeddings JOIN component ON a = vec_id"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ORACLES["op5_jaccard_join"] = rf"""WITH RECURSIVE
worded AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'),
  '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM worded WHERE len(w) > 0)),
sized AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM shingle x JOIN shingle y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sized p ON p.doc_id = a JOIN sized q ON q.doc_id = b
  WHERE 100 * c >= 85 * (p.n + q.n - c)),
{_REACHED.format(id="doc_id", nodes="documents")}
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id
FROM documents LEFT JOIN sized USING (doc_id) JOIN component ON a = doc_id"""

ORACLES["op6_chat_format"] = r"""WITH
turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
guarded AS (SELECT *, '\[\\*/?(INST|ROLE)\]|\[\\*TEXT\]|<\\*/s>' AS control FROM turns),
sized AS (SELECT *, length(text) + len(regexp_extract_all(text, control)) + CASE role
    WHEN 'user' THEN length('[INST]  [/INST]') WHEN 'assistant' THEN length('</s>')
    ELSE length(role) + len(regexp_extract_all(role, control)) + length('[ROLE][TEXT][/ROLE]') END AS size
  FROM guarded)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id"""


def _crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text, by the table of its polynomial's bytes."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = byte >> 1 ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    step = f"list_extract({table}, 1 + (xor(a, b) & 255))"
    return f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda a, b: xor(a >> 8, {step})))"


def _manifest_sql(heights: int) -> str:
    """Trees of up to ``FANOUT ** heights`` leaves, the tree over the groups among them."""

    def field(c: str) -> str:
        return f"coalesce(concat(strlen(CAST({c} AS VARCHAR)), ':', CAST({c} AS VARCHAR)), '-')"

    def leaf(text: str) -> str:
        return f"sha256(concat({', '.join(map(field, ('doc_id', 'source', 'lang', 'n_chars', text)))}))"

    def levels(name: str, first: str) -> str:
        """Tables name0, name1, ...: (g, r, h, m nodes in all) with the siblings l and x."""
        run = f"(PARTITION BY g, r // {FANOUT} ORDER BY r ROWS BETWEEN"
        parts, source = [], first
        for k in range(heights + 1):
            parts.append(f"""{name}{k} AS (SELECT g, r, h, m,
              coalesce(string_agg(h, '') OVER {run} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
              coalesce(string_agg(h, '') OVER {run} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS x FROM ({source}))""")
            source = f"""SELECT g, r // {FANOUT} AS r, CASE WHEN max(m) > 1 THEN sha256(string_agg(h, '' ORDER BY r))
              ELSE any_value(h) END AS h, (max(m) + {FANOUT - 1}) // {FANOUT} AS m FROM {name}{k} GROUP BY ALL"""
        return ", ".join(parts)

    def climb(name: str, g: str, r: str, node: str) -> tuple[str, str, str]:
        """Joins of a node's levels, its siblings and its fold."""
        joins, proof, fold = "", [], node
        for k in range(heights):
            t = f"{name}{k}"
            joins += f" JOIN {t} ON {t}.g = {g} AND {t}.r = {r} // {FANOUT**k}"
            proof.append(f"CASE WHEN {t}.m > 1 THEN {t}.l || {t}.x ELSE '' END")
            fold = f"CASE WHEN {t}.m > 1 THEN sha256({t}.l || {fold} || {t}.x) ELSE {fold} END"
        return joins, " || ".join(proof), fold

    below, proof, _ = climb("n", "p.g", "p.r", "h")
    above, top_proof, _ = climb("t", "''", "s.r", "h")
    fold, steps = "shown", []
    for name, k in [*(("n", k) for k in range(heights)), *(("t", k) for k in range(heights))]:
        steps.append(f"f{len(steps)} AS (SELECT *, CASE WHEN {name}{k}_m > 1 THEN sha256({name}{k}_l || {fold} || {name}{k}_x) ELSE {fold} END AS v{len(steps)} FROM {f'f{len(steps) - 1}' if steps else 'whole'})")
        fold = f"v{len(steps) - 1}"
    columns = ", ".join(f"{t}{k}.{c} AS {t}{k}_{c}" for t in "nt" for k in range(heights) for c in "mlx")
    tampered = f"CASE WHEN {_crc32('CAST(doc_id AS VARCHAR)')} % 3 = 0 THEN translate(text, '{_UPPER}', '{_UPPER.lower()}') ELSE text END"
    return f"""WITH p AS (SELECT doc_id, coalesce('=' || lang, '') AS g, {leaf('text')} AS leaf, {leaf('given')} AS shown,
      row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS r, count(*) OVER (PARTITION BY lang) AS m
      FROM (SELECT *, {tampered} AS given FROM documents)),
    {levels('n', 'SELECT g, r, leaf AS h, m FROM p')},
    s AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS r, count(*) OVER () AS m FROM n{heights}),
    {levels('t', "SELECT '' AS g, r, h, m FROM s")},
    whole AS (SELECT doc_id, leaf, shown, s.h AS subroot, (SELECT h FROM t{heights}) AS root,
      sha256({proof} || {top_proof}) AS proof_sha256, {columns}
      FROM p JOIN s ON s.g = p.g {below}{above}),
    {', '.join(steps)}
    SELECT doc_id, leaf, subroot, root, proof_sha256, {fold} AS folded_root, {fold} = root AS verified FROM f{len(steps) - 1}"""


ORACLES["op11_merkle_manifest"] = _manifest_sql(7)
