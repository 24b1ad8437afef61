"""One query for each operator: over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import centroids, chat, line_dedup, manifest, mixing, pieces, quality, secret_scan, sharding, simhash, toxicity, url_trust, vectors
from .common import LOWER, UPPER

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}


def query(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def tokenizer(name: str = "piece_bpe_32k.model") -> str:
    """The path of a public tokenizer's file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


#: Rules of the URL query.
URL_RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]


@query
def op1_url_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's verdict, by rule or by its host's place in the link graph."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    out = url_trust.judged(pages, URL_RULES, "url_verdict")
    return out.select("page_id", "url_verdict.*")


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's counts, base verdict and line-first verdict."""
    out = quality.judged(documents(spark, sf_dir), "quality")
    return out.select("doc_id", *[f"quality.{c}" for c in quality.KIND.fieldNames() if c != "clean_text"])


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's fingerprint and near-duplicate group."""
    return simhash.components(documents(spark, sf_dir), shingle=4, max_bits=4)


#: A conversation that says the template's own marks.
SELF_QUOTING = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


@query
def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation formatted, then read back from its formatted text and its loss mask."""
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    values = ", ".join(f"({c}L, {t}L, '{r}', '{x}')" for c, t, r, x in SELF_QUOTING)
    quoting = spark.sql(f"SELECT * FROM VALUES {values} AS t(conv_id, turn, role, text)")
    out = chat.formatted(given.unionByName(quoting))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = out.withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss_text", chat.read_loss(F.col("segments")))
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("bigint").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"), F.col("first_bad").cast("bigint").alias("first_bad"), "ended",
    )


CHECKS["op4_chat_format"] = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), o AS (
  SELECT *, row_number() OVER w - 1 AS place, lag(role) OVER w AS prior, lead(role) OVER w AS later,
    CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 20 + length(role) END
      + length(regexp_replace(text, '([<\[])(\\*)(/SYS>>|<SYS>>|</SYS>>|s>|/s>|INST\]|/INST\]|ROLE\]|/ROLE\]|/TURN\])', '\1\\\2\3', 'g')) AS chars
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(chars) AS BIGINT) AS formatted_chars,
  CAST(min(place) FILTER (coalesce(prior, '') || '>' || role NOT IN ('>system', '>user', 'system>user', 'user>assistant', 'assistant>user')) AS BIGINT) AS first_bad,
  bool_or(later IS NULL AND role = 'assistant') AS ended
FROM o GROUP BY conv_id
"""


@query
def op6_vector_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's links and near-duplicate group."""
    return vectors.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), threshold=0.9)


@query
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's share in the mixture."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source")
    mix = mixing.plan(docs)
    return mix.select("doc_id", "mix.size", "mix.source_size", "mix.target", (F.col("mix.copies") * F.col("mix.size")).alias("taken"))


@query
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and the text decoded from them, as digests."""
    model = tokenizer()
    ids = pieces.encoded(documents(spark, sf_dir), model, "ids").select("doc_id", "ids")
    back = pieces.decoded(ids, model, "ids", "decoded")
    return back.select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of every text: fixed patterns and high entropy."""
    out = secret_scan.scanned(documents(spark, sf_dir), "secrets")
    base = F.sha2(F.col("secrets.base").cast("binary"), 256).alias("base_sha256")
    return out.select("doc_id", "secrets.n_assign", "secrets.n_access", "secrets.n_hex", base, "secrets.spans")


@query
def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's lines that repeat an earlier one, or nearly."""
    return line_dedup.per_document(documents(spark, sf_dir))


@query
def op10_shard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards 0 to 7 of near equal bytes, copies together."""
    out = sharding.shard(documents(spark, sf_dir), 8)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity, learned from labels of the other folds."""
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    out = toxicity.scored(docs, toxicity.learned(docs, labels, sample=20_000), "toxicity")
    predicted = (F.col("toxicity.score") >= 0.5).cast("int").alias("predicted")
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "toxicity.score", predicted, "toxicity.hits", "toxicity.quoted")


FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof of inclusion, checked on what is presented: a third of the texts come in lower case."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select(*FIELDS)
    low = [F.translate("text", UPPER, LOWER) if f == "text" else F.col(f) for f in FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    made = manifest.build(docs, FIELDS, "lang", "doc_id", presented=F.when(tampered, manifest.digest_of(low)))
    root = F.lit(made.root).cast("string")
    back = manifest.folded(F.coalesce("kept.presented", "leaf"), F.col("path"))
    return manifest.proofs(made).select(
        F.col("key").alias("doc_id"), "leaf", "subroot", root.alias("root"), manifest.proof_digest(F.col("path")).alias("proof_sha256"),
        back.alias("folded_root"), (back == root).alias("verified"),
    )


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every usable vector's cluster after three rounds."""
    return centroids.described(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding"), k=16, rounds=3, size=64, scale=64, seed=1)


CHECKS["op5_mix_sources"] = r"""
WITH d AS (SELECT doc_id, text, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, ([5.0, 2.0, 1.0])[CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)]::DOUBLE AS w
      FROM d GROUP BY source),
c AS (SELECT *, source_size * 3.0::DOUBLE AS cap, sum(source_size) OVER () AS total FROM s),
f AS (SELECT *, cap / w AS bound, (CAST(total AS DOUBLE) - coalesce(sum(cap) OVER (ORDER BY cap / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(w) OVER (ORDER BY cap / w, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM c),
t AS (SELECT source, source_size, least(cap, w * (SELECT min_by(level, bound) FROM f WHERE level <= bound)) AS target FROM f),
r AS (SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
             CAST('0x' || substr(md5('17' || chr(1) || doc_id || chr(1) || md5(coalesce(text, ''))), 1, 13) AS BIGINT) / 4503599627370496.0::DOUBLE AS u
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target, CAST((floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM r
"""

CHECKS["op6_vector_duplicates"] = """
WITH RECURSIVE e AS (SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM e a JOIN e b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
r AS (SELECT vec_id AS n, vec_id AS m FROM e UNION SELECT l.b, r.m FROM r JOIN l ON l.a = r.n),
k AS (SELECT n AS vec_id, min(m) AS component_id FROM r GROUP BY n)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = k.vec_id) AS n_links, component_id, vec_id = component_id AS kept FROM k
"""


def _centroid_sql(rounds: int = 3) -> str:
    """The rounds one after the other: each vector against the centroids, then floored means by component."""
    parts = ["""e AS (SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: CAST(floor(64 * x) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
             "c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS k, v AS c FROM e QUALIFY k < 16)"]
    for r in range(rounds + 1):
        parts.append(f"""a{r} AS (SELECT vec_id, any_value(v) AS v, min({{'d': d, 'k': k}}) AS best FROM (
  SELECT vec_id, v, k, CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM e, c{r}) GROUP BY vec_id)""")
        if r < rounds:
            parts.append(f"""m{r} AS (SELECT k, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM (
  SELECT a.best.k AS k, i, sum(v[i]) AS s, count(*) AS n FROM a{r} a, range(1, 65) t(i) GROUP BY 1, 2) GROUP BY k),
c{r + 1} AS (SELECT c{r}.k, coalesce(m{r}.c, c{r}.c) AS c FROM c{r} LEFT JOIN m{r} USING (k))""")
    return "WITH " + ",\n".join(parts) + f"""
SELECT vec_id, CAST(best.k AS INTEGER) AS cluster, best.d AS distance, CAST(sum(best.d) OVER (PARTITION BY best.k) AS BIGINT) AS cluster_inertia,
  CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON best.k = c{rounds}.k"""


CHECKS["op13_centroids"] = _centroid_sql()


def _manifest_sql(levels: int = 6, top_levels: int = 3) -> str:
    """The trees level by level, for groups of 8 ** 6 rows and 8 ** 3 groups at most; DuckDB has no crc32, so its bits are shifted here."""
    def coded(column: str) -> str:
        return f"CASE WHEN {column} IS NULL THEN '-' ELSE strlen(CAST({column} AS VARCHAR)) || ':' || CAST({column} AS VARCHAR) END"

    def digest(text: str) -> str:
        return "sha256(" + " || ".join(coded(text if f == "text" else f) for f in FIELDS) + ")"

    bit = "xor(a >> 1, (a & 1) * 3988292384)"
    byte = f"list_reduce([xor(c, b)] || [0::BIGINT, 0, 0, 0, 0, 0, 0, 0], lambda a, z: {bit})"
    codes = "list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))"
    crc = f"xor(list_reduce([4294967295::BIGINT] || {codes}, lambda c, b: {byte}), 4294967295)"
    low = f"translate(text, '{UPPER}', '{LOWER}')"
    parts = [f"d AS (SELECT doc_id, lang, {digest('text')} AS leaf, CASE WHEN {crc} % 3 = 0 THEN {digest(low)} ELSE {digest('text')} END AS shown FROM documents)",
             "f0 AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS w, shown AS acc, '' AS proof FROM d)",
             "l0 AS (SELECT lang, idx, leaf AS h, w FROM f0)"]

    def climb(k: int, node: str, rows: str, to: str, group: str) -> None:
        parts.append(f"""{node}s{k} AS (SELECT a.lang, a.idx, any_value(a.w) AS w, coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS before,
  coalesce(string_agg(b.h, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS after FROM {node}{k} a JOIN {node}{k} b ON {group} a.idx // 8 = b.idx // 8 GROUP BY a.lang, a.idx)""")
        key, other = ("f.lang IS NOT DISTINCT FROM s.lang", "lang, idx // 8") if node == "l" else ("true", "idx // 8")
        parts.append(f"""{to} AS (SELECT f.* REPLACE (f.idx // 8 AS idx, CASE WHEN s.w > 1 THEN sha256(before || acc || after) ELSE acc END AS acc, proof || before || after AS proof)
  FROM {rows} f JOIN {node}s{k} s ON {key} AND f.idx = s.idx)""")
        parts.append(f"""{node}{k + 1} AS (SELECT {"lang" if node == "l" else "NULL AS lang"}, idx // 8 AS idx, CASE WHEN max(w) = 1 THEN min(h) ELSE sha256(string_agg(h, '' ORDER BY idx)) END AS h,
  (max(w) + 7) // 8 AS w FROM {node}{k} GROUP BY {other})""")

    for k in range(levels):
        climb(k, "l", f"f{k}", f"f{k + 1}", "a.lang IS NOT DISTINCT FROM b.lang AND")
    parts.append(f"t0 AS (SELECT lang, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, h, count(*) OVER () AS w FROM l{levels})")
    parts.append(f"g0 AS (SELECT f.* REPLACE (t0.idx AS idx), t0.h AS subroot FROM f{levels} f JOIN t0 ON f.lang IS NOT DISTINCT FROM t0.lang)")
    for k in range(top_levels):
        climb(k, "t", f"g{k}", f"g{k + 1}", "")
    return "WITH " + ",\n".join(parts) + f"""
SELECT doc_id, leaf, subroot, h AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = h AS verified FROM g{top_levels}, t{top_levels}"""


CHECKS["op12_merkle_manifest"] = _manifest_sql()
