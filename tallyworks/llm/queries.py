"""Every operator of this subpackage over its whole table, by query name."""

from __future__ import annotations

from collections.abc import Callable

from public_tokenizers import path as vocabulary
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyworks.llm import (
    bpe_counts,
    chat_format,
    decontamination,
    forced_boundary,
    html_content,
    merkle,
    ngram_join,
    packing,
    pseudo_likelihood,
    quality_rules,
    residue_gemm,
    secret_scan,
    toxicity,
    words,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        QUERIES[build.__name__] = build
        if sql:
            ORACLES[build.__name__] = sql
        return build

    return add


@query()
def op1_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = words.read(spark, folder, "documents")
    lexicon = toxicity.learn(docs, words.read(spark, folder, "labels"))
    return toxicity.score_documents(docs, lexicon)


@query(r"""
    WITH RECURSIVE worded AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x20\x09-\x0D]+') AS w
        FROM documents),
    sets AS (
        SELECT doc_id, CASE
            WHEN len(w) = 0 THEN []
            WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
            ELSE list_distinct(list_transform(range(1, len(w) - 3),
                                              lambda i: array_to_string(w[i:i + 4], ' '))) END AS s
        FROM worded),
    shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
    links AS (
        SELECT a.doc_id AS x, b.doc_id AS y
        FROM shingles a JOIN shingles b ON a.g = b.g AND a.doc_id <> b.doc_id
        GROUP BY a.doc_id, b.doc_id, a.n, b.n
        HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
    reached AS (
        SELECT doc_id, doc_id AS r FROM documents
        UNION
        SELECT doc_id, y FROM reached JOIN links ON x = r)
    SELECT doc_id, any_value(CAST(len(s) AS BIGINT)) AS n_shingles, min(r) AS component_id
    FROM sets JOIN reached USING (doc_id) GROUP BY doc_id
""")
def op2_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    joined = ngram_join.similarity_join(words.read(spark, folder, "documents"))
    return joined.select("doc_id", "n_shingles", "component_id")


@query()
def op3_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = words.read(spark, folder, "documents")
    return bpe_counts.count_tokens(docs, vocabulary("word_bpe_49k.json"))


@query()
def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contaminated(
        words.read(spark, folder, "documents"), words.read(spark, folder, "benchmark")
    )


@query()
def op6_packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack_documents(
        words.read(spark, folder, "documents"), vocabulary("byte_bpe_50k.tiktoken")
    )
    return packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


@query()
def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = words.read(spark, folder, "documents")
    found = secret_scan.scan_documents(docs, secret_scan.learn(docs))

    def line(kinds: tuple[str, ...]) -> Column:
        kept = F.filter("spans", lambda s: s["kind"].isin(*kinds))
        return F.array_join(
            F.transform(kept, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *(number(kind).alias(f"n_{kind}") for kind in secret_scan.KINDS[:3]),
        F.sha2(line(secret_scan.KINDS[:3]), 256).alias("base_sha256"),
        line(secret_scan.KINDS).alias("spans"),
    )


#: A conversation whose texts hold the control strings of a common template.
MARKED = "SELECT -7L AS conv_id, t AS turn, r AS role, '</s>[INST] ok [/INST]' AS text"


@query(r"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
        FROM conversations
        UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
        UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
    placed AS (
        SELECT *, row_number() OVER (
                   PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS spot,
               len(regexp_extract_all(text, '[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\r\f]')) + 4 AS tokens,
               length(replace(replace(replace(role, '\', '\\'), '<|', '<\|'),
                              chr(10), '\' || chr(10)))
                   + length(replace(replace(text, '\', '\\'), '<|', '<\|')) + 24 AS chars
        FROM turns),
    led AS (SELECT *, spot = 1 AND role = 'system' AS is_lead FROM placed),
    begun AS (
        SELECT *, CASE WHEN is_lead THEN -1 ELSE
                   sum(CASE WHEN is_lead THEN 0 ELSE tokens END) OVER (
                       PARTITION BY conv_id ORDER BY spot) - tokens END AS begins,
               greatest(2, 768 - coalesce(max(CASE WHEN is_lead THEN tokens END) OVER (
                   PARTITION BY conv_id), 0)) // 2 AS half,
               max(CASE WHEN is_lead THEN chars END) OVER (PARTITION BY conv_id) AS system_chars
        FROM led),
    slotted AS (
        SELECT *, greatest(begins, 0) // half AS slot, NOT is_lead AND tokens > half AS is_long
        FROM begun),
    opened AS (
        SELECT *, coalesce(lag(slot) OVER c <> slot
                           OR (is_long OR lag(is_long) OVER c) AND NOT lag(is_lead) OVER c, false) AS opens,
               sum(CASE WHEN NOT is_lead THEN chars END) OVER (
                   PARTITION BY conv_id ORDER BY begins RANGE BETWEEN 256 PRECEDING AND 1 PRECEDING)
                   AS earlier
        FROM slotted WINDOW c AS (PARTITION BY conv_id ORDER BY spot))
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY spot)) AS turns_sha256,
           length(coalesce(string_agg(text, '' ORDER BY spot) FILTER (role = 'assistant'), ''))
               AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY spot) FILTER (role = 'assistant'), ''))
               AS loss_sha256,
           CAST(sum(chars + CASE WHEN opens THEN coalesce(earlier, 0) + coalesce(system_chars, 0)
                                 ELSE 0 END) AS BIGINT) AS formatted_chars
    FROM opened GROUP BY conv_id
""")
def op5_chat_format(spark: SparkSession, folder: str) -> DataFrame:
    marked = spark.sql(f"{MARKED} FROM VALUES (0L, 'user'), (1L, 'assistant') AS v(t, r)")
    turns = words.read(spark, folder, "conversations").unionByName(marked)
    windows = chat_format.format_windows(turns)
    read_back = windows.select(
        "conv_id",
        F.length("text").alias("chars"),
        F.struct(
            "window",
            chat_format.turns_of(F.col("text"), F.col("n_context")).alias("turns"),
            chat_format.loss_text(F.col("text"), F.col("loss")).alias("loss"),
        ).alias("w"),
    )
    whole = read_back.groupBy("conv_id").agg(
        F.sum("chars").alias("formatted_chars"), F.sort_array(F.collect_list("w")).alias("w")
    )
    turn_list = F.flatten(F.col("w.turns"))
    written = F.transform(
        turn_list, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    loss = F.array_join("w.loss", "")
    return whole.select(
        "conv_id",
        F.size(turn_list).cast("long").alias("n_turns"),
        F.sha2(F.array_join(written, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


@query()
def op8_pseudo_likelihood(spark: SparkSession, folder: str) -> DataFrame:
    return pseudo_likelihood.learn_and_score(words.read(spark, folder, "documents"))


@query()
def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = words.read(spark, folder, "documents")
    return quality_rules.judge_documents(
        docs, quality_rules.learn(docs, words.read(spark, folder, "labels"))
    )


@query()
def op10_html_content(spark: SparkSession, folder: str) -> DataFrame:
    pages = words.read(spark, folder, "pages")
    return html_content.extract_pages(pages, html_content.learn(pages))


@query(r"""
    WITH clean AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    scored AS (
        SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
               CAST(list_dot_product(a.v, r.v) AS BIGINT) AS score
        FROM clean a JOIN clean r ON a.vec_id % 100 = 0 AND a.vec_id <> r.vec_id),
    positives AS (
        SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
    SELECT anchor_id, positive_id, positive_score, vec_id AS negative_id, score AS negative_score,
           CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
                AS INTEGER) AS rank
    FROM positives JOIN scored USING (anchor_id)
    WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
    QUALIFY rank <= 10
""")
def op11_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    vectors = words.read(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return residue_gemm.hard_negatives(
        vectors.withColumn("label", moved), F.col("vec_id") % 100 == 0
    )


def _merkle_sql(levels: int = 7, levels_of_sources: int = 5) -> str:
    """The tree and its proofs level by level; 16 ** 7 documents a source, 16 ** 5 sources."""
    ctes = []

    def grown(nodes: str, at: int) -> str:
        return f"""
            {nodes}{at + 1} AS (
                SELECT *, len(kids) = 1 AND i = 0 AS alone,
                       CASE WHEN alone THEN kids[1] ELSE sha256(array_to_string(kids, '')) END AS d
                FROM (SELECT src, i // 16 AS i, list(d ORDER BY {nodes}{at}.i) AS kids
                      FROM {nodes}{at} GROUP BY src, {nodes}{at}.i // 16))"""

    def climbed(paths: str, nodes: str, at: int) -> str:
        return f"""
            {paths}{at + 1} AS (
                SELECT p.doc_id, p.d, p.own_source, p.src, p.i // 16 AS i, n.d AS top,
                       coalesce(array_to_string(n.kids[1:p.i % 16], ''), '') AS l{at},
                       coalesce(array_to_string(n.kids[p.i % 16 + 2:], ''), '') AS r{at},
                       CASE WHEN n.alone THEN p.proof ELSE p.proof || l{at} || r{at} END AS proof,
                       CASE WHEN n.alone THEN p.cur ELSE sha256(l{at} || p.cur || r{at}) END AS cur
                FROM {paths}{at} p JOIN {nodes}{at + 1} n
                     ON n.src IS NOT DISTINCT FROM p.src AND n.i = p.i // 16)"""

    def field(value: str) -> str:
        return f"coalesce(strlen({value}) || ':' || {value}, '-')"

    def leaf(text: str) -> str:
        others = [field(f"CAST({c} AS VARCHAR)") for c in ("doc_id", "source", "lang", "n_chars")]
        return f"sha256({' || '.join([*others, field(text)])})"

    # One bit of a CRC-32 at a time over the digits of the id.
    word = "(CASE WHEN k % 8 = 0 THEN xor(x, ascii(substr(CAST(doc_id AS VARCHAR), k // 8 + 1, 1))) ELSE x END)"
    crc = (
        "xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), range(0, 8 * len(CAST(doc_id AS VARCHAR)))), "
        f"lambda x, k: xor({word} >> 1, ({word} & 1) * 3988292384)), 4294967295)"
    )
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    ctes.append(f"""
        l0 AS (
            SELECT doc_id, source AS src, {leaf("text")} AS d,
                   CASE WHEN {crc} % 5 = 0 THEN {leaf(lowered)} ELSE {leaf("text")} END AS cur,
                   row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, d) - 1 AS i
            FROM documents),
        p0 AS (SELECT doc_id, d, src AS own_source, src, i, cur, '' AS proof FROM l0)""")
    for at in range(levels):
        ctes += [grown("l", at), climbed("p", "l", at)]
    ctes.append(f"""
        s0 AS (SELECT 0 AS src, src AS name, d, row_number() OVER (ORDER BY src NULLS FIRST) - 1 AS i
               FROM l{levels}),
        q0 AS (SELECT p.doc_id, p.d, p.own_source, 0 AS src, s.i, p.proof, p.cur
               FROM p{levels} p JOIN s0 s ON s.name IS NOT DISTINCT FROM p.src)""")
    for at in range(levels_of_sources):
        ctes += [grown("s", at), climbed("q", "s", at)]
    return f"""
        WITH {",".join(ctes)}
        SELECT q.doc_id, q.d AS leaf, s.d AS subroot, q.top AS root, sha256(q.proof) AS proof_sha256,
               q.cur AS folded_root, q.cur = q.top AS verified
        FROM q{levels_of_sources} q JOIN s0 s ON s.name IS NOT DISTINCT FROM q.own_source"""


@query(_merkle_sql())
def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = words.read(spark, folder, "documents")
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    lowered = merkle.leaf([*fields, words.ascii_lower(F.col("text"))])
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, lowered)
    proved = merkle.manifest_documents(docs, tampered)
    return proved.select(
        "doc_id", "leaf", "subroot", "root",
        merkle.digest(merkle.above(F.col("path"))).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@query()
def op13_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    coded = forced_boundary.encode_documents(
        words.read(spark, folder, "documents"), vocabulary("byte_bpe_50k.json")
    )
    return coded.select(
        "doc_id", "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
