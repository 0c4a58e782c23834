"""Queries of the text operators, for the driver's entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from terraloom.llm.bpe import bpe_encode
from terraloom.llm.embeddings import near_vectors
from terraloom.llm.licences import licences
from terraloom.llm.line_dedup import line_dedup
from terraloom.llm.merkle import folded, leaf_digest, merkle_manifest, siblings
from terraloom.llm.minhash import near_duplicates
from terraloom.llm.mixing import mixed
from terraloom.llm.neighbours import fit_votes, vote_scores
from terraloom.llm.pii import ADDRESS, KINDS, SECRET, joined, personal_data
from terraloom.llm.quality import fit_crf, quality_rules
from terraloom.llm.runs import highest, looped, periodic_runs
from terraloom.llm.shared import drop, fresh_path, remove
from terraloom.llm.token_files import read_token_files, write_token_files
from terraloom.llm.warc import normalise, read_records, revisits, write_archives

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup(docs).select("doc_id", "n_lines", "n_removed", F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed"))


def op2_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licences(table(spark, sf_dir, "documents"))
    names = F.array_join(F.array_sort(F.array_distinct("matches.licence")), ",")
    return found.select("doc_id", F.size("matches").cast("long").alias("n_matches"), names.alias("licences"), F.array_max("matches.dice").alias("best_dice"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_rules(docs, fit_crf(docs, table(spark, sf_dir, "labels")))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe_encode(table(spark, sf_dir, "documents"), TOKENIZER, decoded_col="decoded")
    ids = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return encoded.select("doc_id", F.size("token_ids").cast("long").alias("n_tokens"), F.sha2(ids.cast("binary"), 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "tokens")
    write_token_files(table(spark, sf_dir, "documents"), TOKENIZER, path, end_id=1)
    return read_token_files(spark, path)


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixed(docs).select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = fresh_path(spark, "warc-raw")
    raw = write_archives(revisits(table(spark, sf_dir, "pages")), at)
    members = normalise(raw, fresh_path(spark, "warc"))
    drop(raw)
    remove(spark, at)  # the members hold all of it
    return read_records(members)


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings"), least=0.9)


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(table(spark, sf_dir, "documents"), fresh_path(spark, "pii"))
    base = F.filter("spans", lambda s: s["base"])
    counts = [F.size(F.array_compact(F.transform(base, lambda s: F.nullif(s["kind"] == F.lit(kind), F.lit(False))))) for kind in range(4)]
    counts = [n.cast("long").alias(f"n_{KINDS[kind]}") for kind, n in enumerate(counts)]
    added = [F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{KINDS[kind]}") for kind in (SECRET, ADDRESS)]
    return found.select("doc_id", *counts, *added, F.size("spans").cast("long").alias("n_spans"), F.sha2(joined(base).cast("binary"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


OP6_SQL = r"""
WITH d AS (SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight FROM s),
f AS (SELECT *, source_size * 2.0::DOUBLE AS cap, source_size * 2.0::DOUBLE / weight AS fill FROM w),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(cap) OVER (ORDER BY fill, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
  / sum(weight) OVER (ORDER BY fill, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM f),
t AS (SELECT source, source_size, least(cap, coalesce((SELECT arg_min(level, fill) FROM l WHERE level <= fill) * weight, cap)) AS target FROM l),
r AS (SELECT doc_id, size, source_size, target, least(2.0, CASE WHEN source_size = 0 THEN 0 ELSE target / source_size END) AS rate
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, size * (floor(rate) + CASE WHEN
  CAST(CAST('0x' || substr(md5('0:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 8) AS UBIGINT) AS DOUBLE) / 4294967296 < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS taken
FROM r
"""


OP7_SQL = """
WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY 1)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first IS NOT NULL AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id <> first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


def _tree(name: str, by: str, levels: int) -> tuple[str, str, str]:
    """SQL of a tree of 16 over rows ``name`` (tree, rank, total, x: the digest to fold): CTEs, joins of its levels to ``t``, and of each level
    the pieces (before, after) of a witness."""
    ctes = [f"{name}0 AS (SELECT tree, rank AS i, total AS c, {by} AS digest FROM {name})"]
    joins = []
    for k in range(levels):
        ctes.append(f"{name}g{k} AS (SELECT tree, i // 16 AS p, any_value(c) AS c, list(digest ORDER BY i) AS ds FROM {name}{k} GROUP BY 1, 2)")
        ctes.append(f"{name}{k + 1} AS (SELECT tree, p AS i, (c + 15) // 16 AS c, CASE WHEN c = 1 THEN ds[1] ELSE sha256(array_to_string(ds, '')) END AS digest FROM {name}g{k})")
        joins.append(f"JOIN {name}g{k} ON {name}g{k}.tree = t.{name}_tree AND {name}g{k}.p = t.{name}_rank // {16 ** (k + 1)}")
    return ", ".join(ctes), " ".join(joins), f"{name}{levels}"


def _op12_sql(levels: int = 6, crowns: int = 3) -> str:
    """Levels of a source's tree and of the tree of sources: for up to 16 ** levels rows a source."""
    field = lambda c: f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"
    leaf = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    crc = "xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, len(doc_id::VARCHAR) + 1), lambda i: ascii(substr(CAST(doc_id AS VARCHAR), i, 1))::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda s, z: xor(s >> 1, CASE WHEN s % 2 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))), 4294967295::BIGINT)"
    own, own_joins, tip = _tree("a", "leaf", levels)
    top, top_joins, root = _tree("r", "digest", crowns)
    steps, folded = [], "x"
    for name, n in (("a", levels), ("r", crowns)):
        for k in range(n):
            g, at = f"{name}g{k}", f"(t.{name}_rank // {16**k}) % 16"
            before, after = (f"CASE WHEN {g}.c = 1 THEN '' ELSE array_to_string({g}.ds[{span}], '') END" for span in (f"1:({at})", f"({at}) + 2:16"))
            steps.append((f"{before} AS b{len(steps)}", f"{after} AS e{len(steps)}", f"{g}.c AS c{len(steps)}"))
    n = len(steps)
    chain = []
    for k in range(n):
        chain.append(f"f{k + 1} AS (SELECT *, CASE WHEN c{k} = 1 THEN y{k} ELSE sha256(b{k} || y{k} || e{k}) END AS y{k + 1} FROM f{k})")
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""WITH d AS (SELECT *, coalesce('=' || source, '-') AS tree, {leaf("text")} AS leaf, coalesce({crc} % 5 = 0, false) AS hit FROM documents),
a AS (SELECT *, CASE WHEN hit THEN {leaf(lower)} ELSE leaf END AS x, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS rank, count(*) OVER (PARTITION BY tree) AS total FROM d),
{own}, r AS (SELECT '' AS tree, tree AS name, digest, row_number() OVER (ORDER BY tree) - 1 AS rank, count(*) OVER () AS total FROM {tip}), {top},
t AS (SELECT a.doc_id, a.leaf, a.x, a.tree AS a_tree, a.rank AS a_rank, r.tree AS r_tree, r.rank AS r_rank, r.digest AS subroot, (SELECT digest FROM {root}) AS root FROM a JOIN r ON r.name = a.tree),
f0 AS (SELECT t.doc_id, t.leaf, t.subroot, t.root, t.x AS y0, {', '.join(c for step in steps for c in step)} FROM t {own_joins} {top_joins}), {', '.join(chain)}
SELECT doc_id, leaf, subroot, root, sha256({' || '.join(f'b{k} || e{k}' for k in range(n))}) AS proof_sha256, y{n} AS folded_root, y{n} = root AS verified FROM f{n}"""


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), k=2, percent=80)


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(looped(table(spark, sf_dir, "documents").select("doc_id", "text"))).withColumn("top", highest(F.col("runs")))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    runs = F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise("")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "top.start",
        "top.length",
        "top.period",
        F.expr("1000 * top.length div top.period").alias("exponent_milli"),
        F.sha2(runs.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    changed = F.when(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, leaf_digest(*fields, lower))
    leaves = docs.select("doc_id", "source", leaf_digest(*fields, F.col("text")).alias("leaf"), changed.alias("changed"))
    found = merkle_manifest(leaves, leaf="leaf", tree="source", order="doc_id").withColumn("folded_root", folded(F.coalesce("changed", "leaf"), F.col("witness")))
    proof = F.sha2(siblings(F.col("witness")).cast("binary"), 256).alias("proof_sha256")
    return found.select("doc_id", "leaf", "subroot", "root", proof, "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_quality_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    scores = vote_scores(docs, fit_votes(docs, labels.where(~out)))
    return scores.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_licences": op2_licences,
    "op3_quality": op3_quality,
    "op4_bpe": op4_bpe,
    "op5_token_files": op5_token_files,
    "op6_mixing": op6_mixing,
    "op7_warc": op7_warc,
    "op8_embeddings": op8_embeddings,
    "op9_pii": op9_pii,
    "op10_minhash": op10_minhash,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_merkle": op12_merkle,
    "op13_quality_votes": op13_quality_votes,
    "pipeline": pipeline,
}
ORACLES: dict[str, str] = {"op6_mixing": OP6_SQL, "op7_warc": OP7_SQL, "op12_merkle": _op12_sql()}
