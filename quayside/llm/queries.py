"""The registered queries of the operators, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quayside.llm import alignment, collocations, decontaminate, language, license_scan, line_dedup, mixing, permutation, quality, simhash, suffix_dedup, token_files, topk

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.line_dedup(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return rows.select(
        "doc_id",
        "n_lines",
        removed.alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"),
    )


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_table(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op6_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", "copy", "shuffle_key")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = license_scan.license_scan(table(spark, sf_dir, "documents"))
    return rows.select(
        "doc_id",
        F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"),
    )


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language.identify(docs, language.train(docs))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, tokenizer_path(), tokenizer_path("piece_bpe_32k.model")).scored()


def op13_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return permutation.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_line_dedup,
        op2_suffix_dedup,
        op3_token_files,
        op4_quality,
        op5_decontaminate,
        op6_mix,
        op7_license_scan,
        op8_top_k,
        op9_simhash,
        op10_language,
        op11_collocations,
        op12_alignment,
        op13_permutation_index,
        pipeline,
    )
}

LINE_SQL = """
WITH texts AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents WHERE doc_id IS NOT NULL
), line AS (
    SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS nr FROM texts
), three AS (
    SELECT doc_id, nr, line AS a, lead(line) OVER w AS b, lead(line, 2) OVER w AS c, lead(nr, 2) OVER w AS last
    FROM line WINDOW w AS (PARTITION BY doc_id ORDER BY nr)
), later AS (
    SELECT doc_id, nr FROM (
        SELECT doc_id, nr, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, nr) AS place
        FROM three WHERE last IS NOT NULL
    ) WHERE place > 1
), covered AS (
    SELECT DISTINCT doc_id, nr + i AS nr FROM later, (VALUES (0), (1), (2)) AS step(i)
), marked AS (
    SELECT l.doc_id, l.nr, l.line, c.nr IS NOT NULL AS gone
    FROM line l LEFT JOIN covered c ON l.doc_id = c.doc_id AND l.nr = c.nr
), edged AS (
    SELECT *, gone AND NOT coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY nr), false) AS head FROM marked
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed, count(*) FILTER (head) AS n_spans,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY nr) FILTER (NOT gone), '')) AS kept_sha256
FROM edged GROUP BY doc_id
"""

MIX_SQL = f"""
WITH RECURSIVE sizes AS (
    SELECT source, sum(length(coalesce(text, '')) + 1) AS size FROM documents GROUP BY source
), rates AS (
    SELECT source, pow(size::DOUBLE, {mixing.POWER}) / (SELECT sum(pow(size::DOUBLE, {mixing.POWER})) FROM sizes)
        * (SELECT sum(size)::DOUBLE FROM sizes) / size AS rate
    FROM sizes
), parted AS (
    SELECT source, greatest(ceil(rate / {mixing.PART})::INT, 1) AS parts,
        rate / greatest(ceil(rate / {mixing.PART})::INT, 1) AS part
    FROM rates
), poisson AS (
    SELECT source, part, 0 AS k, exp(-part) AS p, exp(-part) AS c FROM parted
    UNION ALL
    SELECT source, part, k + 1, p * part / (k + 1), c + p * part / (k + 1) FROM poisson WHERE k < {mixing.COUNTS - 1}
), cdf AS (
    SELECT source, list(c ORDER BY k) AS cdf FROM poisson GROUP BY source
), draws AS (
    SELECT d.doc_id, d.source, list_sum(list_transform(range(p.parts), lambda j: len(list_filter(cdf.cdf, lambda c: c <=
        ('0x' || substr(md5('{mixing.SEED}:' || coalesce(d.doc_id::VARCHAR, '') || ':' || j::VARCHAR), 1, 13))::BIGINT / {1 << 52}.0::DOUBLE)))) AS n
    FROM documents d JOIN parted p ON d.source IS NOT DISTINCT FROM p.source
    JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source
)
SELECT doc_id, source, copy, md5('{mixing.SEED}-order:' || coalesce(doc_id::VARCHAR, '') || ':' || copy::VARCHAR) AS shuffle_key
FROM (SELECT doc_id, source, unnest(range(1, n::BIGINT + 1))::INT AS copy FROM draws WHERE n > 0)
"""


def license_sql() -> str:
    """The same sentences and rules as a chain of replacements."""
    known = ", ".join(f"'{s}': '{i}'" for s, i in license_scan.SENTENCES.items())
    run, steps, matched = "run", [], []
    for n, (name, rule) in enumerate(license_scan.RULES):
        stated = "<" + "><".join(rule) + ">"
        steps.append(f"r{n} AS (SELECT *, replace({run}, '{stated}', '<>') AS run{n} FROM {f'r{n - 1}' if n else 'runs'})")
        matched.append(f"CASE WHEN contains({run}, '{stated}') THEN '{name}' END")
        run = f"run{n}"
    first = {name: n for n, (name, _) in reversed(list(enumerate(license_scan.RULES)))}
    listed = ", ".join(
        f"CASE WHEN coalesce({', '.join(matched[n] for n, (x, _) in enumerate(license_scan.RULES) if x == name)}) IS NOT NULL THEN '{name}' END"
        for name in sorted(first, key=first.get)
    )
    return f"""
WITH sentences AS (
    SELECT doc_id, list_transform(string_split(regexp_replace(lower(coalesce(text, '')), '[.!?;:]+([ \\t\\r\\n]|\\z)', chr(10), 'g'), chr(10)),
        lambda s: trim(regexp_replace(s, '[^a-z0-9]+', ' ', 'g'))) AS found
    FROM documents WHERE doc_id IS NOT NULL
), runs AS (
    SELECT doc_id, list_filter(list_transform(found, lambda s: MAP {{{known}}}[s]), lambda x: x IS NOT NULL) AS ids,
        '<' || array_to_string(list_filter(list_transform(found, lambda s: MAP {{{known}}}[s]), lambda x: x IS NOT NULL), '><') || '>' AS run
    FROM sentences
), {", ".join(steps)}
SELECT doc_id, array_to_string(ids, ',') AS sentence_ids,
    array_to_string(list_filter([{listed}], lambda x: x IS NOT NULL), ',') AS licenses
FROM r{len(steps) - 1}
"""


TOP_SQL = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
        list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i]))::BIGINT AS score
    FROM usable q JOIN usable c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0
)
SELECT query_id, rank::INT AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
) WHERE rank <= 10
"""

COLLOCATION_SQL = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), words AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), one AS (
    SELECT lang, w, count(*) AS f FROM (SELECT lang, unnest(w) AS w FROM words) GROUP BY ALL
), two AS (
    SELECT lang, w, count(*) AS f FROM (
        SELECT lang, unnest(list_transform(range(1, len(w)), lambda i: w[i:i+1])) AS w FROM words
    ) GROUP BY ALL HAVING count(*) >= {collocations.LEAST}
), three AS (
    SELECT lang, w, count(*) AS f FROM (
        SELECT lang, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i:i+2])) AS w FROM words
    ) GROUP BY ALL HAVING count(*) >= {collocations.LEAST}
), longer AS (
    SELECT lang, w, max(f) AS f FROM (
        SELECT lang, w[1:2] AS w, f FROM three UNION ALL SELECT lang, w[2:3], f FROM three
    ) GROUP BY ALL
), parts AS (
    SELECT t.lang, t.w, t.f, 1 AS k, l.f AS l, r.f AS r FROM two t
    JOIN one l ON l.lang = t.lang AND l.w = t.w[1] JOIN one r ON r.lang = t.lang AND r.w = t.w[2]
    LEFT JOIN longer x ON x.lang = t.lang AND x.w = t.w WHERE coalesce(100 * x.f < {collocations.INSIDE} * t.f, true)
    UNION ALL
    SELECT t.lang, t.w, t.f, 1, l.f, r.f FROM three t
    JOIN one l ON l.lang = t.lang AND l.w = t.w[1] JOIN two r ON r.lang = t.lang AND r.w = t.w[2:3]
    UNION ALL
    SELECT t.lang, t.w, t.f, 2, l.f, r.f FROM three t
    JOIN two l ON l.lang = t.lang AND l.w = t.w[1:2] JOIN one r ON r.lang = t.lang AND r.w = t.w[3]
), scored AS (
    SELECT *, ((1000000 * f::HUGEINT * f) // (l::HUGEINT * r))::BIGINT AS score FROM parts
), lowest AS (
    SELECT *, array_to_string(w, ' ') AS phrase FROM scored QUALIFY row_number() OVER (PARTITION BY lang, w ORDER BY score, k) = 1
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, f DESC, phrase) AS rank FROM lowest
), sizes AS (
    SELECT lang, sum(f)::BIGINT AS n FROM one GROUP BY lang
)
SELECT lang, rank, phrase, f AS a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= {collocations.FIRST}
"""

ORACLES: dict[str, str] = {
    "op1_line_dedup": LINE_SQL,
    "op6_mix": MIX_SQL,
    "op7_license_scan": license_sql(),
    "op8_top_k": TOP_SQL,
    "op11_collocations": COLLOCATION_SQL,
}
