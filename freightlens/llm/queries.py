"""The numbered queries: each applies its operator to the whole of its table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from freightlens.llm.exact_dedup import exact_groups

    return exact_groups(table(spark, folder, "documents").select("doc_id", "text"))


def decontamination(spark: SparkSession, folder: str) -> DataFrame:
    from freightlens.llm.decontamination import contamination, is_contaminated

    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), is_contaminated().alias("contaminated"),
    )


TOKEN_LIMIT = 512


def token_count(spark: SparkSession, folder: str) -> DataFrame:
    from freightlens.llm.token_counts import token_counts

    return token_counts(table(spark, folder, "documents").select("doc_id", "text")).withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def packing(spark: SparkSession, folder: str) -> DataFrame:
    from freightlens.llm.packing import pack_documents

    return pack_documents(table(spark, folder, "documents").select("doc_id", "text"))


def toxicity(spark: SparkSession, folder: str) -> DataFrame:
    from freightlens.llm.toxicity import THRESHOLD, toxicity_scores

    scored = toxicity_scores(table(spark, folder, "documents").select("doc_id", "text"), table(spark, folder, "labels"))
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    from freightlens.llm.html_extraction import extract

    return extract(table(spark, folder, "pages").select("page_id", "url", "html"))


def near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    from freightlens.llm.near_dedup import near_classes

    return near_classes(table(spark, folder, "documents").select("doc_id", "text"))


def repeats(spark: SparkSession, folder: str) -> DataFrame:
    from freightlens.llm.repeats import remove_repeats

    cut = remove_repeats(table(spark, folder, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    from freightlens.llm.lm_scoring import lm_scores

    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) == 2, F.lit(False))
    scored = lm_scores(docs, docs.where(~held_out).select("text"))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def surrogates(spark: SparkSession, folder: str) -> DataFrame:
    from freightlens.llm.surrogates import with_surrogates

    # The key of the test data; other callers keep theirs secret.
    return with_surrogates(table(spark, folder, "documents").select("doc_id", "text"), key="surrogates")


def merkle(spark: SparkSession, folder: str) -> DataFrame:
    from freightlens.llm.merkle import folded, merkle_manifest, proof_digest

    odd = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2, F.lit(1))
    tampered = F.when(odd == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    m = merkle_manifest(table(spark, folder, "documents"), shown={"text": tampered})
    m = m.withColumn("proof_sha256", proof_digest(F.col("path"))).withColumn("folded_root", folded(F.col("path"), F.coalesce("shown", "leaf")))
    return m.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def top_k(spark: SparkSession, folder: str) -> DataFrame:
    from freightlens.llm.topk import exact_top_k

    return exact_top_k(table(spark, folder, "embeddings"), F.col("vec_id") % 20 == 0, 20).withColumnRenamed("id", "vec_id")


def collocation(spark: SparkSession, folder: str) -> DataFrame:
    from freightlens.llm.collocations import collocations

    return collocations(table(spark, folder, "documents"))


QUERIES = {
    "op11_merkle": merkle,
    "op12_top_k": top_k,
    "op13_collocations": collocation,
    "op8_surrogates": surrogates,
    "op1_lm_scoring": lm_scoring,
    "op6_repeats": repeats,
    "op7_near_dedup": near_dedup,
    "op3_html_extraction": html_extraction,
    "op9_toxicity": toxicity,
    "op10_packing": packing,
    "op2_token_counts": token_count,
    "op4_decontamination": decontamination,
    "op5_exact_dedup": exact_dedup,
}

def _merkle_sql(levels: int = 12, upper: int = 8) -> str:
    """Trees of up to 3**levels leaves a source and 3**upper sources, level by level."""

    def field(x):
        return f"coalesce(octet_length(encode(({x})::VARCHAR))::VARCHAR || ':' || ({x})::VARCHAR, '-')"

    def leaf(text):
        return "sha256(" + " || ".join(field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    def tree(name, below, depth):
        sql = [f"{name}0 AS MATERIALIZED ({below})"]
        for k in range(depth):
            run = "(PARTITION BY tree, pos // 3 ORDER BY pos)"
            sql.append(f"""{name}s{k} AS MATERIALIZED (SELECT tree, pos, digest, count(*) OVER (PARTITION BY tree) > 1 AS up,
                coalesce(lag(digest, 2) OVER {run}, '') || coalesce(lag(digest, 1) OVER {run}, '') AS before,
                coalesce(lead(digest, 1) OVER {run}, '') || coalesce(lead(digest, 2) OVER {run}, '') AS after FROM {name}{k})""")
            sql.append(f"""{name}{k + 1} AS MATERIALIZED (SELECT tree, pos // 3 AS pos,
                CASE WHEN bool_or(up) THEN sha256(string_agg(digest, '' ORDER BY pos)) ELSE min(digest) END AS digest FROM {name}s{k} GROUP BY tree, pos // 3)""")
        return sql

    def fold(name, start, at, depth, key, tree):
        sql, last = [], start
        for k in range(depth):
            sql.append(f"""{start}{k} AS MATERIALIZED (SELECT w.* EXCLUDE (proof, walked), proof || CASE WHEN up THEN before || after ELSE '' END AS proof,
                CASE WHEN up THEN sha256(before || walked || after) ELSE walked END AS walked
                FROM {last} w JOIN {name}s{k} s ON s.tree = w.{tree} AND s.pos = w.{at} // {3**k})""")
            last = f"{start}{k}"
        return sql, last

    parts = [
        """bits AS (SELECT doc_id, list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
            lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, ignored: xor(x >> 1, 3988292384::BIGINT * (x & 1)))) AS crc
            FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL))""",
        f"""d AS MATERIALIZED (SELECT doc_id, coalesce('=' || source, '') AS tree, {leaf('text')} AS leaf,
            CASE WHEN xor(crc, 4294967295::BIGINT) % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} ELSE {leaf('text')} END AS shown
            FROM documents LEFT JOIN bits USING (doc_id))""",
        "r AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM d)",
        *tree("n", "SELECT tree, pos, leaf AS digest FROM r", levels),
        f"roots AS MATERIALIZED (SELECT '' AS tree, n{levels}.tree AS name, digest, row_number() OVER (ORDER BY encode(n{levels}.tree)) - 1 AS pos FROM n{levels})",
        *tree("t", "SELECT tree, pos, digest FROM roots", upper),
        "w AS (SELECT *, '' AS proof, shown AS walked FROM r)",
    ]
    sql, last = fold("n", "w", "pos", levels, "doc_id", "tree")
    parts += sql + [f"x AS (SELECT w.doc_id, w.leaf, w.proof, w.walked, roots.digest AS subroot, roots.pos AS top, '' AS above FROM {last} w JOIN roots ON roots.name = w.tree)"]
    sql, last = fold("t", "x", "top", upper, "doc_id", "above")
    return "WITH " + ", ".join(parts + sql) + f""" SELECT doc_id, leaf, subroot, t{upper}.digest AS root, sha256(proof) AS proof_sha256, walked AS folded_root, walked = t{upper}.digest AS verified
        FROM {last} CROSS JOIN t{upper}"""


#: DuckDB forms, where SQL can say it.
ORACLE_SQL = {
    "op11_merkle": _merkle_sql(),
    "op12_top_k": """
        WITH v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS w FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
        s AS (SELECT q.vec_id AS query_id, c.vec_id, coalesce(list_sum(list_transform(range(1, least(len(q.w), len(c.w)) + 1), lambda i: q.w[i] * c.w[i])), 0)::BIGINT AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 20
    """,
    "op13_collocations": """
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, list_filter(string_split_regex(piece, '[ \\t]+'), lambda w: w <> '') AS w
            FROM (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents)),
        g AS (SELECT lang, unnest(flatten(list_transform(range(1, len(w) + 1), lambda i: list_transform(range(1, least(5, len(w) - i + 1) + 1), lambda k: array_to_string(w[i:i + k - 1], ' '))))) AS phrase FROM pieces),
        f AS MATERIALIZED (SELECT lang, phrase, len(string_split(phrase, ' ')) AS k, count(*) AS c FROM g GROUP BY lang, phrase),
        t AS (SELECT lang, sum(c) AS n FROM f WHERE k = 1 GROUP BY lang),
        p AS MATERIALIZED (SELECT lang, phrase, string_split(phrase, ' ') AS w, k, c FROM f WHERE k > 1 AND c >= 100),
        cuts AS (SELECT lang, phrase, w, k, c, unnest(range(1, k)) AS cut FROM p),
        scored AS (SELECT cuts.lang, cuts.phrase, cuts.c AS a, cut, x.c AS l, y.c AS r, t.n::BIGINT AS n, ((1000 * cuts.c::HUGEINT * t.n::HUGEINT) // (x.c::HUGEINT * y.c::HUGEINT))::BIGINT AS score
            FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(w[1:cut], ' ')
            JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(w[cut + 1:], ' ') JOIN t ON t.lang = cuts.lang),
        lowest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM scored) WHERE nth = 1),
        kept AS (SELECT * FROM lowest s WHERE NOT EXISTS (SELECT 1 FROM p WHERE p.lang = s.lang AND len(p.phrase) > len(s.phrase)
            AND contains(' ' || p.phrase || ' ', ' ' || s.phrase || ' ') AND 100 * p.c >= 100 * s.a))
        SELECT lang, rank, phrase, a, l, r, n, score FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept) WHERE rank <= 2000
    """,
    "op5_exact_dedup": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size, sha256(t) AS text_sha256 FROM d GROUP BY t)
        SELECT d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id AS kept, g.text_sha256
        FROM d JOIN g USING (t)
    """,
}
